"""Sources and sinks.

CSV is read with an explicit schema: every column is read as text, missing
tokens are normalised to null, then values are cast.  Directories are read
whole (every matching file), never "the first file found".  Intermediate
tables go under the shared checkpoint folder, never a machine-local temp dir.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilth.operators.cleaning import NA_TOKENS


# Standard CSV: a quote inside quotes is doubled, blanks belong to the value.
_CSV = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def read_csv(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",", glob: str | None = None,
             multi_line: bool = False, corrupt_col: str | None = None) -> DataFrame:
    """Header CSV with missing-value tokens -> typed columns, found by their header name.

    ``path`` may be a file or a directory (all files, optionally filtered by ``glob``), all
    with the same header; a file with another header raises, as does a missing column
    (ValueError) or path (AnalysisException [PATH_NOT_FOUND]).  ``multi_line`` allows line
    breaks inside quotes; such files cannot be split, so it is off by default.  Blanks stay
    part of a text; only the test for missing tokens ignores them.  ``corrupt_col`` adds an
    array with the names of the columns whose value does not fit its type (``*``: the whole
    line is malformed), empty for sound rows; ``count_corrupt`` counts them."""
    r = spark.read.options(**_CSV, sep=sep, multiLine=multi_line)
    if glob:
        r = r.option("pathGlobFilter", glob)
    names = r.csv(path).columns
    absent = [f.name for f in schema.fields if f.name not in names]
    if absent:
        raise ValueError(f"{path} has no column {', '.join(absent)}; it has {', '.join(names)}")
    line = "_malformed_line"
    text = T.StructType([T.StructField(n, T.StringType(), True) for n in [*names, line]])
    raw = r.schema(text).option("enforceSchema", False).option("mode", "PERMISSIVE").option(
        "columnNameOfCorruptRecord", line).csv(path)
    tokens = F.array(*[F.lit(t) for t in NA_TOKENS])
    cols, broken = [], [F.when(F.col(line).isNotNull(), F.lit("*"))]
    for f in schema.fields:
        c = F.col(f"`{f.name}`")
        bare = F.trim(c)
        present = c.isNotNull() & ~F.array_contains(tokens, bare)
        val = F.when(present, c if isinstance(f.dataType, T.StringType) else bare.try_cast(f.dataType))
        broken.append(F.when(present & val.isNull(), F.lit(f.name)))
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            val = F.when(F.isnan(val), F.lit(None)).otherwise(val)
        cols.append(val.alias(f.name))
    if corrupt_col:
        cols.append(F.array_compact(F.array(*broken)).alias(corrupt_col))
    return raw.select(*cols)


def count_corrupt(df: DataFrame, corrupt_col: str) -> DataFrame:
    """Rows, and rows with at least one value that could not be read."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.size(corrupt_col) > 0).alias("n_corrupt"))


def write_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite") -> None:
    df.write.mode(mode).options(**_CSV, sep=sep).csv(path)


def write_splits(df: DataFrame, path: str, split_col: str = "split", fmt: str = "parquet") -> None:
    """One folder per split (train/val/test), features and ``target`` together."""
    df.write.mode("overwrite").partitionBy(split_col).format(fmt).option("header", True).save(path)


def read_splits(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


MONTH_IN_NAME = r"(\d{4})[_-](\d{2})(?:\.[A-Za-z]+)?$"


def files_by_month(spark: SparkSession, folder: str, pattern: str = MONTH_IN_NAME) -> dict[str, list[str]]:
    """The entries of a folder (files, or folders that Spark wrote) by the month (yyyy_MM) in
    their name; names without one are left out.  Only the folder is listed; nothing is read."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out: dict[str, list[str]] = {}
    for entry in fs.listStatus(path):
        found = re.search(pattern, entry.getPath().getName())
        if found:
            out.setdefault(f"{found[1]}_{found[2]}", []).append(entry.getPath().toString())
    return out


def read_months(spark: SparkSession, folder: str, months: list[str], schema: T.StructType, sep: str = ",",
                pattern: str = MONTH_IN_NAME, month_col: str = "month") -> DataFrame:
    """The monthly CSV files of a folder as they lie, chosen by the month in their names; files
    of other months are not opened.  A month without a file raises (FileNotFoundError)."""
    there = files_by_month(spark, folder, pattern)
    absent = [m for m in months if m not in there]
    if absent:
        raise FileNotFoundError(f"{folder} has no file for {', '.join(absent)}; it has {', '.join(sorted(there))}")
    parts = [read_csv(spark, path, schema, sep).withColumn(month_col, F.lit(m)) for m in sorted(set(months)) for path in sorted(there[m])]
    return reduce(DataFrame.unionByName, parts)


def write_month_partitioned(df: DataFrame, ts_col: str, path: str, month_col: str = "month") -> None:
    """Monthly files become one table partitioned by month (yyyy_MM), so selecting a
    month prunes every other partition at planning time."""
    (df.withColumn(month_col, F.date_format(ts_col, "yyyy_MM"))
     .write.mode("overwrite").partitionBy(month_col).parquet(path))


def read_month(spark: SparkSession, path: str, month: str, month_col: str = "month") -> DataFrame:
    return spark.read.parquet(path).where(F.col(month_col) == month)


def choose_source(base: DataFrame, monthly: DataFrame | None, retraining: bool) -> DataFrame:
    """The workflow switch: retrain on the base set, or evaluate a monthly set."""
    if retraining or monthly is None:
        return base
    return monthly


def write_one_file_per_key(df: DataFrame, key: str, text_col: str, path: str) -> None:
    """Each key's document in its own folder (key=<value>/part-*.txt)."""
    df.select(key, text_col).repartition(key).write.mode("overwrite").partitionBy(key).text(path)


def read_json_documents(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One JSON document per file, typed by ``schema``; keeps the source file name."""
    return (spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE").json(path)
            .withColumn("source_file", F.col("_metadata.file_name")))


RUN_INFO = T.StructType([
    T.StructField("run_id", T.StringType()), T.StructField("model_name", T.StringType()),
    T.StructField("model_version", T.LongType()),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("validation_metrics", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("parameters", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("model_path", T.StringType()),
    T.StructField("_corrupt_record", T.StringType())])


def read_run_info(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Run-info JSON, one document per file (``multi_line``) or one record per line (as
    ``write_json`` writes a runs table); a malformed document gives a row with only
    ``_corrupt_record`` set, a missing path raises (callers treat both as 'no run')."""
    df = (spark.read.schema(RUN_INFO).option("multiLine", multi_line).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", "_corrupt_record").json(path))
    return df.withColumn("valid", F.col("_corrupt_record").isNull() & F.col("run_id").isNotNull())


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_pipeline_model(path: str):
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)
