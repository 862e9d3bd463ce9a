"""Scans, sinks and table hygiene: CSV with missing-value tokens, header
renaming, token/blank normalisation, numeric type inference, versions."""

from __future__ import annotations

import datetime as _dt
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values (must equal the reference for equal results):
# tokens read as missing, and the pandas default missing set that applies on top.
MISSING_TOKENS = ["?", "NA", "N/A", "null", "None", "MISSING", "-", ""]
PANDAS_DEFAULT_NA = [
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null", "",
]
BLANK_PATTERN = r"^\s*$"


def read_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{name}.parquet")


def _string_cols(df: DataFrame, cols: Sequence[str] | None = None) -> list[str]:
    names = cols if cols is not None else df.columns
    types = dict(df.dtypes)
    return [c for c in names if types[c] == "string"]


def normalize_missing(df: DataFrame, tokens: Sequence[str] = MISSING_TOKENS, cols: Sequence[str] | None = None) -> DataFrame:
    """S3: whole-cell tokens -> null in every string column."""
    targets = set(_string_cols(df, cols))
    toks = list(tokens)
    return df.select(
        *[
            (F.when(~F.col(f"`{c}`").isin(toks), F.col(f"`{c}`")).alias(c) if c in targets else F.col(f"`{c}`"))
            for c in df.columns
        ]
    )


def blank_to_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Cells that are empty or only whitespace -> null."""
    targets = set(_string_cols(df, cols))
    return df.select(
        *[
            (F.when(~F.col(f"`{c}`").rlike(BLANK_PATTERN), F.col(f"`{c}`")).alias(c) if c in targets else F.col(f"`{c}`"))
            for c in df.columns
        ]
    )


def rename_unnamed(df: DataFrame) -> DataFrame:
    """Headers that are blank, pandas 'Unnamed*' or Spark '_c<i>' -> feature_<i>."""
    names = []
    for i, c in enumerate(df.columns):
        if c.strip() == "" or c.startswith("Unnamed") or re.fullmatch(r"_c\d+", c):
            names.append(f"feature_{i}")
        else:
            names.append(c)
    return df.toDF(*names)


def infer_numeric(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A string column becomes BIGINT (or DOUBLE) when every non-null cell
    parses. One aggregate pass decides all columns, one projection casts."""
    targets = _string_cols(df, cols)
    if not targets:
        return df
    aggs = []
    for i, c in enumerate(targets):
        col = F.trim(F.col(f"`{c}`"))
        aggs += [
            F.count(col).alias(f"n{i}"),
            F.count(F.expr(f"try_cast(trim(`{c}`) AS DOUBLE)")).alias(f"d{i}"),
            F.count(F.expr(f"try_cast(trim(`{c}`) AS BIGINT)")).alias(f"l{i}"),
        ]
    row = df.agg(*aggs).first()
    kinds = {}
    for i, c in enumerate(targets):
        n, d, l_ = row[f"n{i}"], row[f"d{i}"], row[f"l{i}"]
        if n > 0 and l_ == n:
            kinds[c] = "bigint"
        elif n > 0 and d == n:
            kinds[c] = "double"
    return df.select(
        *[
            (F.expr(f"try_cast(trim(`{c}`) AS {kinds[c].upper()})").alias(c) if c in kinds else F.col(f"`{c}`"))
            for c in df.columns
        ]
    )


def read_table_csv(
    spark: SparkSession,
    path: str,
    header: bool = True,
    missing_tokens: Sequence[str] = MISSING_TOKENS,
    pandas_defaults: bool = True,
    blank_rule: bool = False,
) -> DataFrame:
    """CSV read as strings, tokens nulled, headers renamed, then typed.
    Spark's ``nullValue`` takes one token, so the token set is applied as a
    projection after the scan (still one pass, fused by codegen)."""
    raw = spark.read.option("header", header).option("inferSchema", False).csv(path)
    raw = rename_unnamed(raw)
    tokens = list(dict.fromkeys(list(missing_tokens) + (PANDAS_DEFAULT_NA if pandas_defaults else [])))
    df = normalize_missing(raw, tokens)
    if blank_rule:
        df = blank_to_null(df)
    return infer_numeric(df)


def read_upload(spark: SparkSession, path: str) -> DataFrame:
    """Dispatch on the extension. CSV uploads also get the blank rule."""
    low = path.lower()
    if low.endswith(".csv"):
        return read_table_csv(spark, path, blank_rule=True)
    if low.endswith(".parquet"):
        return spark.read.parquet(path)
    if low.endswith(".json"):
        return spark.read.json(path)
    raise ValueError("unsupported format: expected .csv, .parquet or .json (convert Excel files first)")


# ---- S6: catalogue of named datasets ---------------------------------------

CATALOG_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("target", T.StringType()),
        T.StructField("header", T.BooleanType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("n_features", T.LongType()),
        T.StructField("n_classes", T.LongType()),
        T.StructField("has_missing", T.BooleanType()),
        T.StructField("recommended_for", T.ArrayType(T.StringType())),
    ]
)
#: Distinct target values up to which a numeric target counts as classes.
MAX_TARGET_CLASSES = 50


def _describe(df: DataFrame, target: str | None) -> tuple[int, int, int | None, bool, list[str]]:
    """Rows, features, classes of the target, whether a cell is null, and what the table is good for:
    classification with a class target, clustering with a numeric feature and no nulls."""
    features = [f.name for f in df.schema.fields if f.name != target]
    aggs = [F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(f"`{x}`").isNull()).alias(f"m{i}") for i, x in enumerate(df.columns)]]
    if target is not None:
        aggs.append(F.count_distinct(F.col(f"`{target}`")).alias("k"))
    row = df.agg(*aggs).first()
    classes = None if target is None else int(row["k"])
    missing = any(row[f"m{i}"] for i in range(len(df.columns)))
    numeric = [f.name for f in df.schema.fields if f.name in features and isinstance(f.dataType, T.NumericType)]
    good = ["clustering"] if numeric and not missing else []
    if classes is not None and (classes <= MAX_TARGET_CLASSES or not isinstance(df.schema[target].dataType, T.NumericType)):
        good.append("classification")
    return int(row["n"]), len(features), classes, missing, good


def dataset_catalog(spark: SparkSession, entries: Sequence[tuple[str, str, str | None, bool]]) -> DataFrame:
    """One row per (name, path, target, header), with rows, features, classes, missing flag and
    recommended uses counted from the table."""
    rows = [(*e, *_describe(_load(spark, e[1], e[3]), e[2])) for e in entries]
    return spark.createDataFrame(rows, CATALOG_SCHEMA)


def _load(spark: SparkSession, path: str, header: bool) -> DataFrame:
    return spark.read.parquet(path) if path.endswith(".parquet") else read_table_csv(spark, path, header=header)


def load_dataset(spark: SparkSession, catalog: DataFrame, name: str) -> DataFrame:
    rows = catalog.where(F.col("name") == name).limit(1).collect()
    if not rows:
        raise ValueError(f"unknown dataset {name!r}")
    return _load(spark, rows[0]["path"], rows[0]["header"])


# ---- S8: preprocessed versions ---------------------------------------------

def version_name(steps: Sequence[str], when: _dt.datetime | None = None) -> str:
    when = when or _dt.datetime.now(_dt.timezone.utc)
    return f"[{' + '.join(steps)}] {when:%H%M%S}"


def save_version(df: DataFrame, root: str, version: str, steps: Sequence[str]) -> str:
    """Write a preprocessed table under ``root/data/version=<v>`` and append a
    catalogue row (all steps recorded, normalisation included)."""
    spark = df.sparkSession
    safe = re.sub(r"[^A-Za-z0-9_.+-]", "_", version)
    out = f"{root}/data/version={safe}"
    df.write.mode("overwrite").parquet(out)
    spark.createDataFrame(
        [(version, safe, list(steps), _dt.datetime.now(_dt.timezone.utc))],
        "version string, dir string, steps array<string>, ts timestamp",
    ).write.mode("append").parquet(f"{root}/versions")
    return out


def list_versions(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/versions")


def load_version(spark: SparkSession, root: str, version: str | None = None) -> DataFrame:
    """Load a version; by default the last one saved (R6-style pick)."""
    cat = list_versions(spark, root)
    if version is None:
        row = cat.agg(F.max_by("dir", "ts").alias("d")).first()
    else:
        row = cat.where(F.col("version") == version).agg(F.max_by("dir", "ts").alias("d")).first()
    if row is None or row["d"] is None:
        raise ValueError("no such version")
    return spark.read.parquet(f"{root}/data/version={row['d']}")
