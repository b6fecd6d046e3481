"""Survey compositions.

The column names of the reference survey are kept here as fixed values; every
composition takes them as arguments so any table can be prepared the same way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tilth.operators import cleaning as C

# The reference survey's selected raw columns, in order.
SURVEY_COLUMNS = ["Education", "Gender", "Age bracket", "Household size", "Acreage",
                  "Fertilizer amount", "Laborers", "Yield", "Main credit source", "Farm records",
                  "Main advisory source", "Extension provider", "Advisory format",
                  "Advisory language"]
# The significant features kept for modelling, in order.
SIGNIFICANT = ["education", "age_bracket", "household_size", "laborers", "main_advisory_source",
               "acreage", "fertilizer_amount", "yield"]
# The fill label for missing education.
NO_EDUCATION = "No educated"


def prepare_survey(raw: DataFrame, subset: list[str] = SURVEY_COLUMNS,
                   required: str = "acreage", fill_col: str = "education",
                   fill_value: str = NO_EDUCATION) -> DataFrame:
    """Select, normalise names, drop rows missing ``required``, fill ``fill_col``."""
    df = C.normalize_names(C.project(raw, subset))
    df = C.drop_null_rows(df, [required])
    return C.fill_null(df, fill_col, fill_value)


def prepare_survey_strict(raw: DataFrame, subset: list[str], key: str, target: str,
                          required: str, trigger: str, fill_value: str,
                          first_segments: tuple[str, list], second_segments: tuple[str, list],
                          to_text: list[str]) -> DataFrame:
    """The extended clean: whole-row fill, numeric-to-text recasts and two rounds of
    per-segment IQR outlier removal (the second round sees the first round's result)."""
    df = C.normalize_names(C.project(raw, subset))
    df = C.drop_null_rows(df, [required])
    df = C.fill_row_when_null(df, trigger, fill_value)
    var1, labels1 = first_segments
    # fences are per segment, so one pass over all labels equals the union of per-label sets
    df = C.drop_iqr_outliers(df, target, var1, labels1)
    var2, labels2 = second_segments
    df = C.drop_iqr_outliers(df, target, var2, labels2)
    return C.recast_text(df, to_text)


def prepare_for_model(df: DataFrame, key: str, target: str, categorical: list[str],
                      numeric: list[str], test_size: float = 0.2, val_size: float = 0.25,
                      seed: int = 42) -> DataFrame:
    """Load-to-split in one lazy plan: select, drop rows without a target, learn the
    vocabulary, split by key hash; report rows and target sum per split."""
    from pyspark.sql import functions as F

    from tilth.operators import encode as E

    clean = C.drop_null_rows(C.project(df, [key] + categorical + numeric + [target]), [target])
    n_features = E.vocabulary(clean, categorical, numeric).count()
    s = E.split(clean, key, test_size, val_size, seed)
    return s.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum(target).alias("target_sum")) \
        .withColumn("n_features", F.lit(n_features).cast("long"))
