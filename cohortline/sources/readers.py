"""Reading observation tables and run records."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortline.defaults import RUN_METRICS
from cohortline.sources.arrays import scan_array

SUFFIXES = (".csv", ".json", ".jsonl", ".parquet")

# Column and field names of observation tables and run records.
OBSERVATION_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("patient_id", "event_id")]
    + [T.StructField(c, T.TimestampType()) for c in ("observation_date", "admission_date", "discharge_date")]
    + [T.StructField("age", T.IntegerType())]
    + [T.StructField(c, T.DoubleType()) for c in (
        "bmi", "blood_pressure_systolic", "blood_pressure_diastolic", "heart_rate", "respiratory_rate",
        "oxygen_saturation", "temperature", "white_blood_cell_count", "hemoglobin", "platelet_count",
        "creatinine", "glucose")]
    + [T.StructField(c, T.IntegerType()) for c in (
        "length_of_stay", "num_prior_admissions", "num_medications", "num_procedures", "num_diagnoses")]
    + [T.StructField(c, T.StringType()) for c in (
        "gender", "race", "admission_type", "insurance_type", "primary_diagnosis", "discharge_disposition", "icu_stay")]
    + [T.StructField(c, T.IntegerType()) for c in (
        "has_diabetes", "has_hypertension", "has_chd", "has_copd", "has_renal_disease", "smoker", "readmission_30day")]
)

_METRICS = T.StructType([T.StructField(m, T.DoubleType()) for m in RUN_METRICS])
_TEXT_MAP = T.MapType(T.StringType(), T.StringType())
_CURVE = T.ArrayType(T.DoubleType())
RUN_SCHEMA = T.StructType([
    T.StructField("experiment_type", T.StringType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("run_name", T.StringType()),
    T.StructField("model_type", T.StringType()),
    T.StructField("parameter_count", T.LongType()),
    T.StructField("training_time_seconds", T.DoubleType()),
    T.StructField("config", T.MapType(T.StringType(), _TEXT_MAP)),
    T.StructField("overrides", T.MapType(T.StringType(), _TEXT_MAP)),
    T.StructField("history", T.StructType([
        T.StructField(c, _CURVE) for c in ("train_loss", "val_loss", "train_acc", "val_acc")])),
    T.StructField("metrics", _METRICS),
    T.StructField("timestamp", T.StringType()),
    # Summaries of sweeps, ablations and comparisons.
    T.StructField("metric_to_optimize", T.StringType()),
    T.StructField("total_runs", T.LongType()),
    T.StructField("successful_runs", T.LongType()),
    T.StructField("best_score", T.DoubleType()),
    T.StructField("best_config", _TEXT_MAP),
    T.StructField("best_model", T.StringType()),
    T.StructField("all_results", T.ArrayType(T.StructType([
        T.StructField("run_index", T.LongType()), T.StructField("run_name", T.StringType()),
        T.StructField("params", _TEXT_MAP), T.StructField("score", T.DoubleType()),
        T.StructField("metrics", _METRICS), T.StructField("training_time", T.DoubleType()),
        T.StructField("error", T.StringType())]))),
    T.StructField("ablation_results", T.MapType(T.StringType(), T.StructType([
        T.StructField("metrics", _METRICS), T.StructField("training_time", T.DoubleType()),
        T.StructField("parameter_count", T.LongType())]))),
])


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN counts as missing everywhere, while Spark would sort it above all numbers."""
    floating = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    if not floating:
        return df
    q = lambda c: F.col(f"`{c}`")
    return df.select([
        F.when(~F.isnan(q(c)), q(c)).alias(c) if c in floating else q(c) for c in df.columns
    ])


def _checked(read, path) -> DataFrame:
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise FileNotFoundError(f"no data at {path}") from error
        raise


def _reader(spark: SparkSession, schema, glob: str | None):
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.option("pathGlobFilter", glob) if glob else reader


def _suffix_glob(suffix: str) -> str:
    """File names with this suffix, in any case."""
    return "*." + "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in suffix.lstrip("."))


def scan_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, glob: str | None = None) -> DataFrame:
    """CSV with a header. Without a schema types are inferred by an extra pass."""
    reader = _reader(spark, schema, glob).option("header", True)
    if schema is None:
        reader = reader.option("inferSchema", True)
    return nan_to_null(_checked(lambda: reader.csv(path), path))


def scan_json(
    spark: SparkSession, path: str | list[str], schema: T.StructType | None = None, lines: bool = False,
    glob: str | None = None, mode: str = "PERMISSIVE",
) -> DataFrame:
    """A JSON array of records per file, or with ``lines`` one record per line.

    Lines, and arrays read by a schema, are cut into byte ranges for many tasks; an array
    without a schema is one task per file, as its types are inferred first.
    A record that cannot be parsed is a row of nulls; with mode DROPMALFORMED
    it is left out, with FAILFAST it ends the job.
    """
    if schema is not None and not lines:
        rows = _checked(lambda: scan_array(spark, path, schema, glob, mode), str(path))
        if rows is not None:
            return nan_to_null(rows)
    reader = _reader(spark, schema, glob).option("multiLine", not lines).option("mode", mode)
    return nan_to_null(_checked(lambda: reader.json(path), str(path)))


def flatten(df: DataFrame) -> DataFrame:
    """Struct fields as columns with dotted names, at every depth; arrays stay."""
    def leaves(fields, path):
        for f in fields:
            here = (*path, f.name)
            if isinstance(f.dataType, T.StructType):
                yield from leaves(f.dataType.fields, here)
            else:
                yield here
    return df.select([
        F.col(".".join(f"`{p}`" for p in leaf)).alias(".".join(leaf)) for leaf in leaves(df.schema.fields, ())
    ])


def scan_json_nested(
    spark: SparkSession, path: str | list[str], schema: T.StructType | None = None, lines: bool = False,
    glob: str | None = None, mode: str = "PERMISSIVE",
) -> DataFrame:
    """One nested object per file (or line), flattened to dotted columns."""
    return flatten(scan_json(spark, path, schema, lines, glob, mode))


def scan_parquet(
    spark: SparkSession, path: str, schema: T.StructType | None = None, glob: str | None = None,
    nan_as_null: bool = True,
) -> DataFrame:
    """Parquet. Where the files hold no NaN, ``nan_as_null=False`` lets filters
    on floating columns reach the scan as well."""
    rows = _checked(lambda: _reader(spark, schema, glob).parquet(path), path)
    return nan_to_null(rows) if nan_as_null else rows


def _scan_json_any(spark: SparkSession, path: str, schema, glob: str | None) -> DataFrame:
    """Array, object or lines, told apart for each file by its first line."""
    reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    rows = _checked(lambda: reader.text(path), path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("at"))
    # Within a file rows are numbered in order; parts of a large file keep their order among partitions.
    first = rows.filter(F.trim("value") != "").groupBy("file").agg(F.min_by(F.trim("value"), "at").alias("head"))
    layout = (
        F.when(F.col("head").startswith("["), "array")
        .when(F.col("head").startswith("{") & F.col("head").endswith("}"), "lines").otherwise("object"))
    files: dict[str, list[str]] = {}
    for row in first.select("file", layout.alias("layout")).orderBy("file").collect():  # names only, as in any listing
        files.setdefault(row["layout"], []).append(row["file"])
    if not files:
        return scan_json(spark, path, schema, glob=glob)
    parts = [
        scan_json(spark, names, schema) if kind == "array" else scan_json_nested(spark, names, schema, lines=kind == "lines")
        for kind, names in sorted(files.items())
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


_SCANS = {
    ".csv": scan_csv, ".json": _scan_json_any, ".parquet": scan_parquet,
    ".jsonl": lambda spark, path, schema, glob: scan_json(spark, path, schema, lines=True, glob=glob),
}


def scan_auto(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Format by suffix; a path without one is a folder whose supported files are all read.

    Unknown suffix: ValueError. Nothing there: FileNotFoundError.
    """
    suffix = os.path.splitext(path.rstrip("/"))[1].lower()
    if suffix in _SCANS:
        return _SCANS[suffix](spark, path, schema, None)
    if suffix:
        raise ValueError(f"unsupported file format: {suffix}")
    # Listing only: without the content column no file is opened.
    listing = spark.read.format("binaryFile").option(
        "pathGlobFilter", "{" + ",".join(map(_suffix_glob, _SCANS)) + "}")
    names = _checked(lambda: listing.load(path), path).select(
        F.lower(F.regexp_extract("path", r"(\.[A-Za-z]+)$", 1)).alias("suffix")
    )
    found = sorted(row["suffix"] for row in names.distinct().collect())
    if not found:
        raise FileNotFoundError(f"no supported data files in {path}")
    parts = [_SCANS[s](spark, path, schema, _suffix_glob(s)) for s in found if s in _SCANS]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def read_run_results(
    spark: SparkSession, path: str, names: Sequence[str] | None = None, lines: bool = False, corrupt: bool = False,
) -> DataFrame:
    """Run records of a folder, all or by file name.

    A record that is no JSON is left out; with ``corrupt`` it is kept and its
    text is in ``_corrupt_record``. A record without a name takes its file's.
    """
    schema = T.StructType([*RUN_SCHEMA.fields, T.StructField("_corrupt_record", T.StringType())])
    glob = "{" + ",".join(f"{n}.json" for n in names) + "}" if names else "*.json"
    texts = _checked(lambda: _reader(spark, None, glob).text(path, wholetext=not lines), path)
    parsed = texts.select(
        F.from_json("value", schema, {"columnNameOfCorruptRecord": "_corrupt_record"}).alias("_r"),
        F.regexp_replace(F.col("_metadata.file_name"), r"\.json$", "").alias("_stem"),
    )
    out = parsed.select("_r.*", "_stem").withColumn(
        "run_name", F.coalesce("run_name", F.when(F.col("experiment_type").isNull(), F.col("_stem")))
    ).drop("_stem")
    return out if corrupt else out.filter(F.col("_corrupt_record").isNull()).drop("_corrupt_record")
