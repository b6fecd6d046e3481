"""Tuning of tree ensembles over whole grids, and model-based search.

Trees need of the rows only how many there are in each cell (rows with the same values, or
bins of them, and the same fold), their sum and their sum of squares.  One Spark pass over all
rows makes the cell table; there are no more cells than the values multiply to, nor than rows,
and the number is checked.  The cells are to trees what the moments of ``modeling.fold_moments``
are to linear models: every (setting, fold) is then a Spark task of its own that needs nothing else.

An ensemble is fitted once at its longest and scored at every prefix of its trees by running
sums; a forest's trees, grown level by level, are scored at every depth as well.  So the grid
of 180 forest settings needs 9 fits a fold, the one of 125 boosted settings 25.

The model-based search is a tree-structured Parzen estimator: settings of the better part
of the trials and of the rest each give a density per parameter, and of a number of draws
from the better one the draw with the highest ratio is tried next.
"""

from __future__ import annotations

import json
import math
import random
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tilth.operators.modeling import fold_column, grid

MAX_CELLS = 1 << 22      # some 50 bytes each, at the driver and in every fit
MAX_VALUES = 1000        # values of a categorical column
BINS = 32
DEEPEST = 30
PACKED = 128             # codes of features that are summed together
DENSE = 16               # sums a cell that a level may hold


# ---- cells: what trees need of the rows --------------------------------------------------

def tree_cells(rows: DataFrame, categorical: list[str], numeric: list[str], key: str, label: str = "target",
               k: int = 3, seed: int = 7, bins: int | None = BINS, bags: int = 1, fold: Column | None = None) -> dict[str, np.ndarray]:
    """The cell table of all rows with a label: ``codes`` (cells x features), ``kinds`` (values of
    a categorical feature, 0 for a numeric one), ``fold``, ``n``, ``s``, ``q`` (rows, sum and sum
    of squares of the label less ``mean``).

    Numeric features are cut at up to ``bins`` - 1 quantiles (nulls and NaN in a bin below); with
    ``bins`` None nothing is cut: every value has a code, so trees may split between any two.  A
    category is its place among the sorted values (null first).  Folds are ``k`` key hashes, or
    what ``fold`` says.  With ``bags`` above 1 the
    rows of a cell are dealt into that many by key hash, so that bootstrap weights differ
    inside large cells.  More than ``MAX_CELLS`` cells or ``MAX_VALUES`` values raise."""
    rows = rows.where(F.col(label).isNotNull())
    numbers = [F.when(~F.isnan(c), F.col(c).cast("double")) for c in numeric]
    shares = None if bins is None else F.array(*[F.lit((i + 1) / bins) for i in range(bins - 1)])
    stats = rows.agg(F.avg(label).alias("mean"),
                     *[F.percentile_approx(x, shares, 10_000).alias(f"cut{i}") for i, x in enumerate(numbers) if bins is not None],
                     *[F.array_sort(F.collect_set(c)).alias(f"set{i}") for i, c in enumerate(categorical)]).first()
    if stats["mean"] is None:
        raise ValueError("no rows with a label")
    values = [stats[f"set{i}"] for i in range(len(categorical))]
    for c, v in zip(categorical, values, strict=True):
        if len(v) > MAX_VALUES:
            raise ValueError(f"{c} has {len(v)} values; at most {MAX_VALUES} can be tuned over")
    codes = []
    for i, c in enumerate(numeric):
        if bins is None:
            codes.append(numbers[i].alias(f"f{i}"))      # the value itself; numbered below
            continue
        cuts = sorted(set(stats[f"cut{i}"] or []))
        above = sum((F.when(F.col(c) > x, 1).otherwise(0) for x in cuts), F.lit(1))
        codes.append(F.when(F.col(c).isNull() | F.isnan(c), 0).otherwise(above).cast("int").alias(f"f{i}"))
    for i, (c, v) in enumerate(zip(categorical, values, strict=True)):
        place = F.array_position(F.array(*[F.lit(x) for x in v]), F.col(c)) if v else F.lit(0)
        codes.append(F.coalesce(place, F.lit(0)).cast("int").alias(f"f{len(numeric) + i}"))
    names = [f"f{i}" for i in range(len(codes))]
    y = F.col(label) - F.lit(stats["mean"])
    part = fold_column(key, k, seed) if fold is None else fold.cast("int").alias("fold")
    cells = rows.select(part, F.pmod(F.xxhash64(key), F.lit(bags)).alias("bag"), *codes, y.alias("y")).groupBy(
        "fold", "bag", *names).agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum("y").alias("s"), F.sum(F.col("y") * F.col("y")).alias("q"))
    cells = cells.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if cells.count() > MAX_CELLS:
            raise ValueError(f"more than {MAX_CELLS} cells; take fewer bins or features")
        table = cells.toArrow().to_pandas()
    finally:
        cells.unpersist()
    for c in names[:len(numeric)] if bins is None else []:
        known = table[c].notna()
        place = np.zeros(len(table), np.int32)
        place[known] = np.unique(table[c][known], return_inverse=True)[1] + 1
        table[c] = place
    table = table.sort_values(["fold", "bag", *names])
    return {"codes": table[names].to_numpy(np.int32), "fold": table["fold"].to_numpy(np.int32),
            **{c: table[c].to_numpy(np.float64) for c in "nsq"}, "mean": np.float64(stats["mean"]),
            "kinds": np.array([0] * len(numeric) + [len(v) + 1 for v in values], np.int32)}


# ---- trees on cells ----------------------------------------------------------------------------

def _best_split(ln, ls, categories: int, least: float):
    """Best split of every node on one feature from its counts and sums by code: (gain, code).
    Numeric: codes up to it go left; categorical: the one value goes left."""
    tn, ts = ln.sum(axis=1, keepdims=True), ls.sum(axis=1, keepdims=True)
    if not categories:
        ln, ls = np.cumsum(ln, axis=1), np.cumsum(ls, axis=1)
    gain = _gain(ln, ls, tn, ts, least)
    code = gain.argmax(axis=1)
    return gain[np.arange(len(gain)), code], code


def _best_listed(node, code, ln, ls, categories: int, least: float):
    """``_best_split`` where only the codes that occur are listed, by node and code (every node
    has some): for features of so many values that a full table would outgrow the cells."""
    first = np.flatnonzero(np.diff(node, prepend=-1))
    tn, ts = np.add.reduceat(ln, first)[node], np.add.reduceat(ls, first)[node]
    if not categories:
        ln, ls = [np.cumsum(x) - np.append(0.0, np.cumsum(x))[first][node] for x in (ln, ls)]
    gain = _gain(ln, ls, tn, ts, least)
    most = np.maximum.reduceat(gain, first)
    at = np.flatnonzero(gain == most[node])[::-1]
    best = np.zeros(len(first), np.int64)
    best[node[at]] = code[at]                     # the first of equals is written last
    return most, best


def _gain(ln, ls, tn, ts, least: float):
    rn, rs = tn - ln, ts - ls
    ok = (ln >= least) & (rn >= least)
    return np.where(ok, ls * ls / np.where(ok, ln, 1) + rs * rs / np.where(ok, rn, 1) - ts * ts / np.maximum(tn, 1e-300), 0.0)


def _packs(codes: np.ndarray, kinds: np.ndarray) -> list[list[tuple]]:
    """The features in packs of at most ``PACKED`` joint codes (a wider feature is alone), each
    as one feature or more: (features, widths, joint code of every cell).  A pack is followed by its
    features one by one.  Sums by joint code give the sums of all its features in one go."""
    widths = [max(2, c or int(codes[:, f].max(initial=0)) + 1) for f, c in enumerate(kinds)]
    packs: list[list[int]] = []
    for f in sorted(range(len(kinds)), key=lambda f: -widths[f]):
        fits = [p for p in packs if math.prod(widths[g] for g in p) * widths[f] <= PACKED]
        if fits:
            fits[0].append(f)
        else:
            packs.append([f])
    out = []
    for p in packs:
        single = [([f], [widths[f]], np.ascontiguousarray(codes[:, f])) for f in p]
        joint = np.ravel_multi_index([c for _, _, c in single], [widths[f] for f in p])
        out.append([(p, [widths[f] for f in p], joint), *single])
    return out


def grow_tree(codes: np.ndarray, kinds: np.ndarray, n: np.ndarray, s: np.ndarray, depths: list[int], min_leaf: float,
              n_features: int, rng: np.random.Generator, packs: list | None = None) -> list[np.ndarray]:
    """The value of every cell's node at each of the depths, of one least-squares tree grown
    level by level on weights ``n`` and sums ``s`` (cells of weight 0 are only carried along).
    ``packs`` are the ``_packs`` of the codes, if known."""
    cells, least, p = len(n), max(min_leaf, 1e-9), len(kinds)
    packs = _packs(codes, kinds) if packs is None else packs
    node, value = np.zeros(cells, np.int64), np.full(cells, s.sum() / max(n.sum(), 1e-300))
    live = None if cells else np.arange(0)        # cells in nodes that may still split; None: all
    out, n_nodes = [], 1

    def means():
        return np.bincount(node, s, n_nodes) / np.maximum(np.bincount(node, n, n_nodes), 1e-300)
    for level in range(max(depths) + 1):
        if level in depths:
            if level and n_nodes:
                value[slice(None) if live is None else live] = means()[node]
            out.append(value.copy())
        if level == max(depths) or not len(node):
            continue
        tried = np.ones((n_nodes, p), bool)
        if n_features < p:
            tried = rng.random((n_nodes, p)).argsort(axis=1) < n_features
        found, summed = {}, []
        for pack, *single in packs:
            for fs, ws, code in [pack] if n_nodes * math.prod(pack[1]) <= min(DENSE, 1) * len(node) else single:
                width = math.prod(ws)
                at = node * width + (code if live is None else code[live])
                if n_nodes * width <= DENSE * len(node):
                    ln, ls = [np.bincount(at, x, n_nodes * width).reshape(n_nodes, *ws) for x in (n, s)]
                    for i, f in enumerate(fs):
                        others = tuple(j + 1 for j in range(len(fs)) if j != i)
                        found[f] = _best_split(ln.sum(axis=others), ls.sum(axis=others), kinds[f], least)
                    listed = None
                else:
                    listed, at = np.unique(at, return_inverse=True)
                    listed = np.divmod(listed, width)
                    found[fs[0]] = _best_listed(*listed, np.bincount(at, n), np.bincount(at, s), kinds[fs[0]], least)
                summed.append((fs, ws, at, listed))
        gain, feature, code = np.zeros(n_nodes), np.full(n_nodes, -1), np.zeros(n_nodes, np.int64)
        for f in range(p):
            g, x = found[f]
            better = tried[:, f] & (g > gain * (1 + 1e-9) + 1e-9)     # the first of equals, whatever the order of sums
            gain[better], feature[better], code[better] = g[better], f, x[better]
        splits = gain > 1e-9
        right = np.zeros(len(node), bool)
        for fs, ws, at, listed in summed:
            here = [(i, f, np.flatnonzero(feature == f)) for i, f in enumerate(fs)]
            if not any(len(at_nodes) for _, _, at_nodes in here):
                continue
            if listed is not None:
                whose, c = listed
                goes = (feature[whose] == fs[0]) & (c != code[whose] if kinds[fs[0]] else c > code[whose])
            else:
                goes = np.zeros((n_nodes, *ws), bool)
                for i, f, at_nodes in here:
                    c, x = np.arange(ws[i]), code[at_nodes, None]
                    goes[at_nodes] = (c != x if kinds[f] else c > x).reshape(-1, *[ws[i] if j == i else 1 for j in range(len(fs))])
            right |= goes.ravel()[at]
        if not splits.all():
            keep = splits[node]
            done = np.flatnonzero(~keep)
            value[done if live is None else live[done]] = means()[node[done]]
            live = np.flatnonzero(keep) if live is None else live[keep]
            node, n, s, right = node[keep], n[keep], s[keep], right[keep]
        node = (2 * (np.cumsum(splits) - 1))[node] + right
        n_nodes = 2 * int(splits.sum())
    return out


def _loss(cells, held: np.ndarray, prediction: np.ndarray) -> float:
    """Sum of squared errors of the held-out rows."""
    p = prediction[held]
    return float((cells["n"][held] * p * p - 2 * p * cells["s"][held] + cells["q"][held]).sum())


def _tried(kinds: np.ndarray, share) -> int:
    """Features tried at a node."""
    p = len(kinds)
    return {"sqrt": max(1, math.isqrt(p)), "log2": max(1, int(math.log2(p)))}.get(share) or max(1, int(share * p))


def forest_losses(cells, fold: int, stages: list[int], depths: list[int], min_leaf: int, max_features, seed: int = 42) -> dict:
    """{(trees, depth): held-out sum of squares} of bagged trees, from one fit: tree i is the
    same in every ensemble, and at depth d it is the deeper tree cut off there."""
    held = cells["fold"] == fold
    depths = sorted(set(depths))
    total = [np.zeros(len(held)) for _ in depths]
    out, packs = {}, _packs(cells["codes"], cells["kinds"])
    for i in range(max(stages)):
        rng = np.random.default_rng([seed, i])
        weight = rng.poisson(1.0, len(held)) * ~held
        grown = grow_tree(cells["codes"], cells["kinds"], cells["n"] * weight, cells["s"] * weight, depths, min_leaf,
                          _tried(cells["kinds"], max_features), rng, packs)
        for t, g in zip(total, grown, strict=True):
            t += g
        if i + 1 in stages:
            out |= {(i + 1, d): _loss(cells, held, t / (i + 1)) for d, t in zip(depths, total, strict=True)}
    return out


def boosted_losses(cells, fold: int, stages: list[int], depth: int, rate: float, min_leaf: float = 1, subsample: float = 1.0,
                   seed: int = 0) -> dict:
    """{trees: held-out sum of squares} of least-squares boosting, from one fit.  The trees are
    grown on the combinations of codes, each with the sums of its cells."""
    held = cells["fold"] == fold
    n, s = cells["n"] * ~held, cells["s"] * ~held
    codes, combination = _combinations(cells["codes"])
    packs = _packs(codes, cells["kinds"])

    def over(x):
        return np.bincount(combination, x, len(codes))
    held_n, held_s, held_q = over(cells["n"] * held), over(cells["s"] * held), cells["q"][held].sum()
    part_n, part_s = over(n), over(s)
    prediction = np.full(len(codes), s.sum() / n.sum())
    out = {}
    for i in range(max(stages)):
        rng = np.random.default_rng([seed, i])
        if subsample < 1:
            part = rng.random(len(held)) < subsample
            part_n, part_s = over(n * part), over(s * part)
        if i == 0 or part_n.any():
            prediction = prediction + rate * grow_tree(codes, cells["kinds"], part_n, part_s - part_n * prediction, [depth], min_leaf,
                                                       len(cells["kinds"]), rng, packs)[0]
        if i + 1 in stages:
            out[i + 1] = float((held_n * prediction * prediction - 2 * prediction * held_s).sum() + held_q)
    return out


def _combinations(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different rows of codes, and which of them every row is."""
    key = np.zeros(len(codes), np.int64)
    for c in codes.T:
        # renumbered at every step, so that the product stays below rows times codes
        key = np.unique(key * (int(c.max(initial=0)) + 1) + c, return_inverse=True)[1]
    first = np.unique(key, return_index=True)[1]
    return codes[first], key


# ---- the grids as Spark tasks ----------------------------------------------------------------

def _fit(shipped, seed: int):
    def run(batches):
        cells = shipped.value
        for batch in batches:
            rows = []
            for job in batch.column("job").to_pylist():
                j = json.loads(job)
                if j["model"] == "forest":
                    found = forest_losses(cells, j["fold"], j["stages"], [d or DEEPEST for d in j["depths"]], j["min_samples_leaf"],
                                          j["max_features"], seed)
                    rows += [(job, t, d, x) for (t, d), x in found.items()]
                else:
                    found = boosted_losses(cells, j["fold"], j["stages"], j["max_depth"], j["learning_rate"],
                                           j.get("min_samples_leaf", 1), j.get("subsample", 1.0), seed)
                    rows += [(job, t, j["max_depth"], x) for t, x in found.items()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (
                pa.string(), pa.int32(), pa.int32(), pa.float64()), strict=True)], names=["job", "trees", "depth", "sse"])
    return run


def _run_jobs(spark: SparkSession, cells, jobs: list[dict], seed: int, shipped=None) -> list:
    """All fits, each a task of its own; the cell table (at most ``MAX_CELLS`` rows) is broadcast,
    unless it has been (``shipped``)."""
    shipped = spark.sparkContext.broadcast(cells) if shipped is None else shipped
    heavy_first = sorted(jobs, key=lambda j: -max(j["stages"]) * (max(d or DEEPEST for d in j["depths"]) if "depths" in j else j["max_depth"]))
    text = [(json.dumps(j, sort_keys=True),) for j in heavy_first]
    table = spark.createDataFrame(spark.sparkContext.parallelize(text, len(text)), "job string")
    found = table.mapInArrow(_fit(shipped, seed), "job string, trees int, depth int, sse double").collect()
    return [(json.loads(r["job"]), r["trees"], r["depth"], r["sse"]) for r in found]


def _fold_sizes(cells) -> dict[int, float]:
    return {int(f): float(cells["n"][cells["fold"] == f].sum()) for f in np.unique(cells["fold"])}


def _mean_mse(cells, parts: Iterable[tuple[int, float]]) -> float:
    sizes = _fold_sizes(cells)
    return float(np.mean([sse / sizes[f] for f, sse in sorted(parts)]))


def held_out_baseline(cells, fold: int) -> float:
    """Mean squared error on a fold of the mean of the others."""
    held = cells["fold"] == fold
    return _loss(cells, held, np.full(len(held), cells["s"][~held].sum() / cells["n"][~held].sum())) / cells["n"][held].sum()


def mean_baseline(cells) -> float:
    """Cross-validated loss of predicting the training mean."""
    return float(np.mean([held_out_baseline(cells, f) for f in _fold_sizes(cells)]))


_COLUMNS = ("n_estimators int, max_depth int, min_samples_leaf int, max_features string, learning_rate double, "
            "folds int, cv_mse double, best boolean")


def search_forest(spark: SparkSession, cells, space: dict[str, list], seed: int = 42) -> DataFrame:
    """Every setting of a forest grid with its cross-validated loss (mean over folds of the
    held-out mean squared error); a depth of None means ``DEEPEST``."""
    folds = sorted(_fold_sizes(cells))
    jobs = [{"model": "forest", "fold": f, "stages": sorted(space["n_estimators"]), "depths": space["max_depth"],
             "min_samples_leaf": leaf, "max_features": m}
            for f in folds for leaf in space["min_samples_leaf"] for m in space["max_features"]]
    losses: dict[tuple, list] = {}
    for j, trees, depth, sse in _run_jobs(spark, cells, jobs, seed):
        losses.setdefault((trees, depth, j["min_samples_leaf"], j["max_features"]), []).append((j["fold"], sse))
    rows = [(s, losses[s["n_estimators"], s["max_depth"] or DEEPEST, s["min_samples_leaf"], s["max_features"]]) for s in grid(space)]
    return _trial_table(spark, cells, rows)


def search_boosted(spark: SparkSession, cells, space: dict[str, list], seed: int = 0) -> DataFrame:
    """Every setting of a boosted-tree grid with its cross-validated loss."""
    folds = sorted(_fold_sizes(cells))
    jobs = [{"model": "boosted", "fold": f, "stages": sorted(space["n_estimators"]), "max_depth": d, "learning_rate": r}
            for f in folds for d in space["max_depth"] for r in space["learning_rate"]]
    losses: dict[tuple, list] = {}
    for j, trees, depth, sse in _run_jobs(spark, cells, jobs, seed):
        losses.setdefault((trees, depth, j["learning_rate"]), []).append((j["fold"], sse))
    rows = [(s, losses[s["n_estimators"], s["max_depth"], s["learning_rate"]]) for s in grid(space)]
    return _trial_table(spark, cells, rows)


def _trial_table(spark, cells, rows: list[tuple[dict, list]]) -> DataFrame:
    scored = [(s, len(parts), _mean_mse(cells, parts)) for s, parts in rows]
    least = min(m for _, _, m in scored)
    return spark.createDataFrame([
        (s["n_estimators"], s["max_depth"], s.get("min_samples_leaf"), str(s["max_features"]) if "max_features" in s else None,
         s.get("learning_rate"), k, m, m == least) for s, k, m in scored], _COLUMNS)


# ---- model-based search -------------------------------------------------------------------------

LINEAR_SPACE = {"alpha": ("loguniform", 1e-4, 1e3)}


def inside(space: dict[str, tuple], setting: dict) -> bool:
    """Whether a setting lies in the space (quantised entries on their steps)."""
    return set(setting) == set(space) and all(
        e[1] <= setting[c] <= e[2] and (e[0] != "quniform" or setting[c] == round(setting[c] / e[3]) * e[3]) for c, e in space.items())


def _warp(entry: tuple, x: float) -> float:
    return math.log(x) if entry[0] == "loguniform" else x


def _unwarp(entry: tuple, z: float) -> float:
    kind, low, high = entry[:3]
    x = math.exp(z) if kind == "loguniform" else z
    if kind == "quniform":
        return int(min(max(round(x / entry[3]) * entry[3], low), high))
    return min(max(x, low), high)


def _density(centres: list[float], low: float, high: float):
    """A mixture of one normal per centre and the uniform over the range, all weighing alike."""
    width = (high - low) / max(1.0, math.sqrt(len(centres)))
    spread = max(width / 2, (high - low) / 50)

    def at(z: float) -> float:
        bumps = sum(math.exp(-0.5 * ((z - c) / spread) ** 2) for c in centres) / (spread * math.sqrt(2 * math.pi))
        return (bumps + 1 / (high - low)) / (len(centres) + 1)

    def draw(rng: random.Random) -> float:
        c = rng.randrange(len(centres) + 1)
        z = rng.uniform(low, high) if c == len(centres) else rng.gauss(centres[c], spread)
        return min(max(z, low), high)
    return at, draw


def suggest(space: dict[str, tuple], history: list[tuple[dict, float]], seed: int = 42, start: int = 6, better: float = 0.25,
            draws: int = 24) -> dict:
    """The next setting to try, from all trials so far; hangs on seed, space and history only.

    The first ``start`` are drawn from the space; after that each parameter takes the draw
    from the density of the ``better`` part of the trials at which that density most exceeds
    the one of the others."""
    rng = random.Random(f"{seed}:{len(history)}")
    ranked = sorted(history, key=lambda h: (math.isnan(h[1]), h[1]))
    n_good = max(2, math.ceil(better * len(ranked)))
    out = {}
    for name, entry in space.items():
        low, high = _warp(entry, entry[1]), _warp(entry, entry[2])
        if len(history) < start:
            out[name] = _unwarp(entry, rng.uniform(low, high))
            continue
        good, _draw = _density([_warp(entry, h[0][name]) for h in ranked[:n_good]], low, high)
        bad, _ = _density([_warp(entry, h[0][name]) for h in ranked[n_good:]], low, high)
        tries = [_draw(rng) for _ in range(draws)]
        out[name] = _unwarp(entry, max(tries, key=lambda z: good(z) / bad(z)))
    return out


def model_search(space: dict[str, tuple], loss: Callable[[dict], float], n_trials: int = 20, seed: int = 42,
                 history: list[tuple[dict, float]] | None = None) -> list[tuple[dict, float]]:
    """``n_trials`` more trials after those in ``history``; the whole list comes back."""
    trials = list(history or [])
    for _ in range(n_trials):
        setting = suggest(space, trials, seed)
        trials.append((setting, float(loss(setting))))
    return trials


def save_trials(spark: SparkSession, trials: list[tuple[dict, float]], path: str) -> None:
    """The trial table (trial, setting as JSON, loss) as Parquet, for a later run to go on from."""
    spark.createDataFrame([(i, json.dumps(s, sort_keys=True), x) for i, (s, x) in enumerate(trials)],
                          "trial int, setting string, loss double").coalesce(1).write.mode("overwrite").parquet(path)


def load_trials(spark: SparkSession, path: str) -> list[tuple[dict, float]]:
    return [(json.loads(r["setting"]), r["loss"]) for r in spark.read.parquet(path).orderBy("trial").collect()]


def refit_loss(spark: SparkSession, cells, setting: dict, fold: int = 1, seed: int = 0) -> float:
    """Mean squared error on one fold (the test rows) of a setting fitted on all other rows."""
    ((_, _, _, sse),) = _run_jobs(spark, cells, [_boosted_job(setting, fold)], seed)
    return sse / _fold_sizes(cells)[fold]


def _boosted_job(setting: dict, fold: int) -> dict:
    return {"model": "boosted", "fold": fold, "stages": [int(setting["n_estimators"])], "max_depth": int(setting["max_depth"]),
            "learning_rate": setting["learning_rate"], "subsample": setting.get("subsample", 1.0),
            "min_samples_leaf": int(setting.get("min_samples_leaf", 1))}


def boosted_loss(spark: SparkSession, cells, seed: int = 0) -> Callable[[dict], float]:
    """Cross-validated loss of one boosted-tree setting; its folds are fitted side by side."""
    shipped = spark.sparkContext.broadcast(cells)

    def loss(setting: dict) -> float:
        jobs = [_boosted_job(setting, f) for f in sorted(_fold_sizes(cells))]
        return _mean_mse(cells, [(j["fold"], sse) for j, _, _, sse in _run_jobs(spark, cells, jobs, seed, shipped)])
    return loss
