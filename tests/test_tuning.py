"""Tree tuning on cells, and the model-based search."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tilth.operators import modeling as ML
from tilth.operators import tuning as TU


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(4)
    out = []
    for i in range(900):
        a, b, c = rnd.randint(0, 9), rnd.randint(0, 5), rnd.choice("xyz")
        out.append((f"k{i}", a, float(b), c, 3.0 * a + (b > 2) * 7 - (c == "y") * 11 + rnd.gauss(0, 1)))
    return spark.createDataFrame(out, "key string, a int, b double, c string, target double")


@pytest.fixture(scope="module")
def cells(rows):
    return TU.tree_cells(rows, ["c"], ["a", "b"], "key")


def test_cells_hold_all_rows(rows, cells):
    own = rows.agg(F.count(F.lit(1)), F.sum("target")).first()
    assert cells["n"].sum() == own[0] and abs(cells["s"].sum() + cells["mean"] * own[0] - own[1]) < 1e-6
    assert len(set(cells["fold"])) == 3 and cells["kinds"].tolist() == [0, 0, 4]


def test_cells_bags_nulls_and_bounds(spark, rows, monkeypatch):
    bagged = TU.tree_cells(rows, ["c"], ["a", "b"], "key", bags=3)
    assert len(bagged["n"]) > 500 and bagged["n"].sum() == 900
    odd = spark.createDataFrame([("1", None, "x", 1.0), ("2", float("nan"), None, 2.0), ("3", 5.0, "x", None), ("4", 5.0, None, 4.0)],
                                "key string, a double, c string, target double")
    got = TU.tree_cells(odd, ["c"], ["a"], "key", k=1)
    assert got["n"].sum() == 3 and sorted(map(tuple, got["codes"].tolist())) == [(0, 0), (0, 1), (1, 0)]
    with pytest.raises(ValueError):
        TU.tree_cells(odd.where("target < 0"), ["c"], ["a"], "key")
    monkeypatch.setattr(TU, "MAX_CELLS", 10)
    with pytest.raises(ValueError):
        TU.tree_cells(rows, ["c"], ["a", "b"], "key")


def test_cells_of_all_values(spark):
    """Without bins every value has a code, however rare or close to the next it is."""
    values = [None, float("nan"), *[0.0] * 500, *[1 + i / 1000 for i in range(90)], *[50.0] * 400, -3.0]
    own = spark.createDataFrame([(f"k{i}", a, i % 7, "xy"[i % 2], float(i)) for i, a in enumerate(values)],
                                "key string, a double, b int, c string, target double").repartition(5)
    got = TU.tree_cells(own, ["c"], ["a", "b"], "key", bins=None)
    ranks = {v: i + 1 for i, v in enumerate(sorted({v for v in values if v is not None and v == v}))}
    want = {}
    for i, a in enumerate(values):
        at = (ranks.get(a, 0), i % 7 + 1, i % 2 + 1)
        n, s = want.get(at, (0, 0.0))
        want[at] = (n + 1, s + i - got["mean"])
    found = {}
    for code, n, s in zip(map(tuple, got["codes"].tolist()), got["n"], got["s"], strict=True):
        was = found.get(code, (0, 0.0))
        found[code] = (was[0] + n, was[1] + s)
    assert max(c[0] for c in found) == 93 and found.keys() == want.keys()
    assert all(found[c][0] == want[c][0] and np.isclose(found[c][1], want[c][1]) for c in want)


def test_more_cells_than_quantiles_would_make(spark):
    own = spark.range(270_000).selectExpr("string(id) AS key", "id % 300 AS a", "id div 300 AS b", "double(id % 11) AS target")
    got = TU.tree_cells(own, [], ["a", "b"], "key", bins=None)
    assert len(got["n"]) == got["n"].sum() == 270_000 and got["codes"].max(axis=0).tolist() == [300, 900]
    assert (np.diff(got["fold"]) >= 0).all() and set(got["fold"]) == {0, 1, 2}


def test_model_search_splits_between_all_values(spark, tmp_dir, monkeypatch):
    """The query's trees see every quantity, discount and tax, so they find a band that lies
    between the quartiles."""
    from tilth.plans import q_tuning as Q
    rnd = random.Random(8)
    items = [(i, i % 40, i % 10, i % 7 + 1, rnd.choice("ANR"), rnd.choice("FO"), float(rnd.randint(1, 50)), rnd.randint(0, 10) / 100,
              rnd.randint(0, 8) / 100, 0.0) for i in range(1500)]
    items = [(*x[:-1], 1e7 if 15 <= x[6] <= 17 else 0.0) for x in items]
    spark.createDataFrame(items, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_returnflag string, l_linestatus string, "
                          "l_quantity double, l_discount double, l_tax double, l_extendedprice double").write.parquet(f"{tmp_dir}/lineitem.parquet")
    made, own = [], TU.tree_cells
    monkeypatch.setattr(TU, "tree_cells", lambda *a, **k: made.append(own(*a, **k)) or made[-1])
    monkeypatch.setattr(Q, "_TRIALS", 2)
    got = {r["model"]: r for r in Q.model_search_checks(spark, tmp_dir).collect()}
    assert got["boosted"]["n_trials"] == 2 and got["boosted"]["refit_beats_mean"] and got["boosted"]["beats_mean"]
    for cells in made:
        assert cells["codes"].max(axis=0)[:3].tolist() == [50, 11, 9]
    assert [c["n"].sum() for c in made] == [got["boosted"]["n_rows"], 1500]
    one = TU.boosted_losses(made[0], 0, [40], 3, 0.3)[40] / TU._fold_sizes(made[0])[0]
    assert one < 0.02 * TU.held_out_baseline(made[0], 0)


def test_sums_by_joint_or_listed_codes_are_the_same_tree(cells, monkeypatch):
    n, s, rng = cells["n"], cells["s"], np.random.default_rng
    for depth, leaf, m in ((3, 1, 3), (12, 2, 3), (30, 1, 2)):
        want = TU.grow_tree(cells["codes"], cells["kinds"], n, s, [1, depth], leaf, m, rng(5))
        for packed, dense in ((1, 16), (10_000, 16), (1, 0), (128, 0)):
            monkeypatch.setattr(TU, "PACKED", packed)
            monkeypatch.setattr(TU, "DENSE", dense)
            for a, b in zip(want, TU.grow_tree(cells["codes"], cells["kinds"], n, s, [1, depth], leaf, m, rng(5)), strict=True):
                assert np.allclose(a, b, rtol=1e-9)
        monkeypatch.undo()


def test_tree_equals_spark_tree(rows):
    """One tree without bootstrap has the training loss of Spark ML's on the same splits."""
    from pyspark.ml.regression import DecisionTreeRegressor
    cells = TU.tree_cells(rows, [], ["a", "b"], "key", k=1)
    for depth, leaf in ((2, 1), (4, 1), (4, 40)):
        value = TU.grow_tree(cells["codes"], cells["kinds"], cells["n"], cells["s"], [depth], leaf, 2, np.random.default_rng(0))[0]
        ours = TU._loss(cells, np.ones(len(value), bool), value) / 900
        data = ML.ml_encoder([], ["a", "b"]).fit(rows).transform(rows)
        model = DecisionTreeRegressor(featuresCol="features", labelCol="target", maxDepth=depth, minInstancesPerNode=leaf).fit(data)
        theirs = model.transform(data).agg(F.avg((F.col("target") - F.col("prediction")) ** 2)).first()[0]
        assert abs(ours - theirs) < 1e-6 * theirs


def test_staged_scores_equal_separate_fits(cells):
    for m in (1.0, "sqrt"):
        staged = TU.forest_losses(cells, 1, [2, 5, 9], [2, 4, 30], 2, m)
        for trees, depth in ((2, 4), (5, 2), (9, 30)):
            assert np.isclose(TU.forest_losses(cells, 1, [trees], [depth], 2, m)[trees, depth], staged[trees, depth], rtol=1e-12)
    staged = TU.boosted_losses(cells, 0, [3, 10, 25], 3, 0.2, subsample=0.7)
    for trees in (3, 10):
        assert TU.boosted_losses(cells, 0, [trees], 3, 0.2, subsample=0.7)[trees] == staged[trees]
    assert staged[25] < staged[10] < staged[3]


def test_boosting_by_hand(cells):
    """Stumps on one feature, step by step from the definition."""
    only = cells | {"codes": cells["codes"][:, :1], "kinds": cells["kinds"][:1]}
    held = only["fold"] == 2
    n, s, code = only["n"][~held], only["s"][~held], only["codes"][~held, 0]
    f = {c: s.sum() / n.sum() for c in range(40)}
    for _ in range(4):
        r = s - n * np.array([f[c] for c in code])
        options = []
        for cut in range(1, 12):
            left = code <= cut
            if n[left].sum() and n[~left].sum():
                options.append((r[left].sum() ** 2 / n[left].sum() + r[~left].sum() ** 2 / n[~left].sum(), -cut))
        cut = -max(options)[1]
        left = code <= cut
        f = {c: v + 0.5 * (r[left].sum() / n[left].sum() if c <= cut else r[~left].sum() / n[~left].sum()) for c, v in f.items()}
    want = TU._loss(only, held, np.array([f[c] for c in only["codes"][:, 0]]))
    assert np.isclose(TU.boosted_losses(only, 2, [4], 1, 0.5)[4], want)


def test_grids_in_spark(spark, cells):
    forest = TU.search_forest(spark, cells, {"n_estimators": [2, 6], "max_depth": [None, 2, 30], "min_samples_leaf": [1, 3],
                                             "max_features": [1.0, "log2"]}).collect()
    assert len(forest) == 24 and sum(r["best"] for r in forest) >= 1 and {r["folds"] for r in forest} == {3}
    by = {(r["n_estimators"], r["max_depth"], r["min_samples_leaf"], r["max_features"]): r["cv_mse"] for r in forest}
    assert by[6, None, 1, "1.0"] == by[6, 30, 1, "1.0"] != by[6, 2, 1, "1.0"]
    sizes = TU._fold_sizes(cells)
    want = np.mean([TU.forest_losses(cells, f, [6], [2], 3, "log2")[6, 2] / sizes[f] for f in sizes])
    assert np.isclose(by[6, 2, 3, "log2"], want)
    boosted = TU.search_boosted(spark, cells, {"learning_rate": [0.1, 0.5], "n_estimators": [5, 20], "max_depth": [1, 3]}).collect()
    assert len(boosted) == 8
    best = min(boosted, key=lambda r: r["cv_mse"])
    assert best["best"] and best["cv_mse"] < TU.mean_baseline(cells) / 4


SPACE = {"x": ("uniform", -5.0, 5.0), "y": ("loguniform", 0.01, 100.0), "n": ("quniform", 10, 50, 10)}


def bowl(s):
    return (s["x"] - 1.5) ** 2 + np.log(s["y"] / 2) ** 2 + ((s["n"] - 30) / 10) ** 2


def test_model_search_beats_random_draws():
    ours, chance = [], []
    for seed in range(12):
        trials = TU.model_search(SPACE, bowl, 40, seed)
        assert all(TU.inside(SPACE, s) for s, _ in trials) and len(trials) == 40
        ours.append(min(x for _, x in trials))
        chance.append(min(bowl(s) for s in ML.draw(SPACE, 40, seed)))
    assert np.mean(ours) < 0.6 * np.mean(chance)


def test_model_search_goes_on_from_stored_trials(spark, tmp_dir):
    whole = TU.model_search(SPACE, bowl, 15, 3)
    assert whole == TU.model_search(SPACE, bowl, 15, 3)
    TU.save_trials(spark, whole[:9], f"{tmp_dir}/trials")
    again = TU.model_search(SPACE, bowl, 6, 3, TU.load_trials(spark, f"{tmp_dir}/trials"))
    assert again == whole


def test_inside():
    assert TU.inside(SPACE, {"x": 0.0, "y": 1.0, "n": 20})
    assert not TU.inside(SPACE, {"x": 6.0, "y": 1.0, "n": 20}) and not TU.inside(SPACE, {"x": 0.0, "y": 1.0, "n": 25})
