"""Registry of checkable queries: a Spark callable plus, where possible, SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def register(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, folder)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


# Rounding at a small offset: exact halves (common with cent amounts) do not
# depend on the last bit of a floating sum, so both engines round alike.
_OFFSET = 1.3e-7


def settle(column, digits: int = 6):
    return F.round(column + F.lit(_OFFSET), digits)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Settle all floating columns so that sums in another order compare equal."""
    return df.select([
        settle(F.col(f"`{f.name}`").cast("double"), digits).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def r(expression: str, name: str | None = None, digits: int = 6) -> str:
    """SQL counterpart of ``settle``, with the column name."""
    return f"round(CAST({expression} AS DOUBLE) + {_OFFSET}, {digits}) AS {name or expression}"


def rs(columns, digits: int = 6) -> str:
    return ", ".join(r(c, digits=digits) for c in columns)


# Columns of the wide table by kind, for writing SQL lists.
NUMERIC = (
    "age", "bmi", "blood_pressure_systolic", "heart_rate", "oxygen_saturation",
    "creatinine", "glucose", "length_of_stay", "num_prior_admissions", "num_diagnoses",
)
DOUBLES = ("bmi", "blood_pressure_systolic", "heart_rate", "oxygen_saturation", "creatinine", "glucose")
CATEGORICAL = ("admission_type", "primary_diagnosis", "discharge_disposition")
INDICATORS = ("has_diabetes", "has_hypertension", "has_chd", "has_copd", "has_renal_disease", "smoker")
