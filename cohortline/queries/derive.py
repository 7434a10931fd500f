"""F*, W*, TS*: scalar features, timeline windows, resampling, sequences."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortline import defaults as D
from cohortline import fixtures as X
from cohortline.functions.scalar import charlson_index, elixhauser_score, interactions
from cohortline.operators import resample as rs_
from cohortline.operators import timeline as tl
from cohortline.operators.rolling import rolling_time
from cohortline.plans.features import FeatureSet, interaction_features, polynomial_features, risk_scores
from cohortline.plans.preprocess import Preprocessor
from cohortline.queries._registry import CATEGORICAL, DOUBLES, NUMERIC, query, r, rounded
from cohortline.queries.prepare import nearest_sql

ENC = f"WITH {X.ENCOUNTERS_SQL} "
OBS = f"WITH {X.OBSERVATIONS_SQL} "
VITALS = ("heart_rate", "blood_pressure_systolic", "oxygen_saturation")

_CHARLSON = ("CAST(" + " + ".join(f"{c} * {w}" for c, w in D.CHARLSON_WEIGHTS.items())
             + " + CASE WHEN age > 40 THEN floor(CAST(age - 40 AS DOUBLE) / 10) ELSE 0 END AS INTEGER)")
_ELIXHAUSER = " + ".join(D.ELIXHAUSER_INDICATORS)


def _enc(spark, sf, *columns):
    return X.encounters(spark, sf).select("event_id", *columns)


@query("f1_charlson_index", ENC + f"SELECT event_id, {_CHARLSON} AS charlson_index FROM encounters")
def _(spark, sf):
    wide = X.encounters(spark, sf)
    return wide.select("event_id", charlson_index(wide.columns).alias("charlson_index"))


@query("f2_elixhauser_score", ENC + f"SELECT event_id, {_ELIXHAUSER} AS elixhauser_score FROM encounters")
def _(spark, sf):
    wide = X.encounters(spark, sf)
    return wide.select("event_id", elixhauser_score(wide.columns).alias("elixhauser_score"))


def _interaction(name):
    def run(spark, sf):
        wide = risk_scores(X.encounters(spark, sf))
        return rounded(wide.select("event_id", interactions(wide.columns)[name].alias(name)))
    return run


_INTERACTIONS = {
    "f3_age_charlson_interaction": ("age_charlson_interaction", f"age * {_CHARLSON} AS age_charlson_interaction"),
    "f4_bmi_diabetes_interaction": ("bmi_diabetes_interaction", r("bmi * has_diabetes", "bmi_diabetes_interaction")),
    "f5_rate_pressure_product": (
        "rate_pressure_product", r("heart_rate * blood_pressure_systolic / 1000", "rate_pressure_product")),
    "f6_utilization_burden": (
        "utilization_burden", "length_of_stay * (1 + num_prior_admissions) AS utilization_burden"),
    "f7_metabolic_stress_index": ("metabolic_stress_index", r("creatinine * glucose / 100", "metabolic_stress_index")),
}
for _name, (_column, _sql) in _INTERACTIONS.items():
    query(_name, ENC + f"SELECT event_id, {_sql} FROM encounters")(_interaction(_column))

_POLY = ("age", "bmi", "creatinine", "glucose", "length_of_stay")


@query("f8_polynomial", ENC + "SELECT event_id, " + ", ".join(
    r(f"pow({c}, {d})", f"{c}_pow{d}") for c in _POLY for d in (2, 3)) + " FROM encounters")
def _(spark, sf):
    made = polynomial_features(_enc(spark, sf, *_POLY), degree=3)
    return rounded(made.drop(*_POLY))


_W = "PARTITION BY patient_id ORDER BY observation_date, event_id"


def _frame(n: int) -> str:
    return f"OVER ({_W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


_STAT = {
    "mean": lambda c, over: f"avg({c}) {over}",
    "std": lambda c, over: f"coalesce(stddev_samp({c}) {over}, 0)",
    "min": lambda c, over: f"min({c}) {over}",
    "max": lambda c, over: f"max({c}) {over}",
}


def _rolling_sql(stats) -> list[str]:
    return [r(_STAT[s](c, _frame(n)), f"{c}_rolling_{s}_{n}") for n in D.ROLLING_WINDOWS for c in VITALS for s in stats]


def _rolling(spark, sf, stats):
    wide = _enc(spark, sf, "patient_id", "observation_date", *VITALS)
    return rounded(tl.rolling_features(wide, VITALS, stats=stats).drop("observation_date", *VITALS))


for _stats, _name in ((("mean",), "w1_rolling_mean"), (("std",), "w2_rolling_std"), (("min", "max"), "w3_rolling_min_max")):
    query(_name, ENC + f"SELECT event_id, patient_id, {', '.join(_rolling_sql(_stats))} FROM encounters")(
        lambda spark, sf, stats=_stats: _rolling(spark, sf, stats))


def _hours(stat: str, c: str, n: int) -> str:
    return _STAT[stat](c, f"""OVER (PARTITION BY patient_id ORDER BY epoch_us(observation_date)
        RANGE BETWEEN {n * 3_600_000_000 - 1} PRECEDING AND CURRENT ROW)""")


_MEASURED = ("heart_rate", "num_medications")   # all numeric columns of the observations


@query("w4_rolling_time", OBS + "SELECT event_id, patient_id, " + ", ".join(
    r(_hours(s, c, n), f"{c}_rolling_{s}_{n}h") for n in D.ROLLING_WINDOWS for c in _MEASURED for s in ("mean", "std"))
    + " FROM observations")
def _(spark, sf):
    rows = X.observations(spark, sf).select("event_id", "patient_id", "observation_date", *_MEASURED)
    return rounded(rolling_time(rows, _MEASURED, D.ROLLING_WINDOWS).drop("observation_date", *_MEASURED))


_DIFFS = ("heart_rate", "blood_pressure_systolic", "oxygen_saturation", "creatinine", "glucose")


def _diff(c: str) -> str:
    return f"coalesce({c} - lag({c}) OVER ({_W}), 0)"


@query("w5_diff", ENC + "SELECT event_id, " + ", ".join(r(_diff(c), f"{c}_diff") for c in _DIFFS) + " FROM encounters")
def _(spark, sf):
    wide = _enc(spark, sf, "patient_id", "observation_date", *_DIFFS)
    made = tl.diff_features(wide, absolute=False)
    return rounded(made.select("event_id", *[f"{c}_diff" for c in _DIFFS]))


@query("w6_abs_diff", ENC + "SELECT event_id, " + ", ".join(
    r(f"abs({_diff(c)})", f"{c}_abs_diff") for c in _DIFFS) + " FROM encounters")
def _(spark, sf):
    wide = _enc(spark, sf, "patient_id", "observation_date", *_DIFFS)
    return rounded(tl.diff_features(wide).select("event_id", *[f"{c}_abs_diff" for c in _DIFFS]))


_FEATURE_SQL = (
    [f"CASE WHEN age >= {lo} AND age < {hi} THEN 1 ELSE 0 END AS age_grp_{n}"
     for lo, hi, n in zip(D.AGE_EDGES, D.AGE_EDGES[1:], D.AGE_LABELS)]
    + [f"{_CHARLSON} AS charlson_index", f"{_ELIXHAUSER} AS elixhauser_score"]
    + [sql for _, sql in _INTERACTIONS.values()]
    + _rolling_sql(("mean", "std"))
    + [sql for c in _DIFFS for sql in (r(_diff(c), f"{c}_diff"), r(f"abs({_diff(c)})", f"{c}_abs_diff"))]
)


@query("f9_feature_set", ENC + f"SELECT event_id, {', '.join(_FEATURE_SQL)} FROM encounters")
def _(spark, sf):
    wide = X.encounters(spark, sf)
    made = FeatureSet().transform(wide)
    return rounded(made.drop(*[c for c in wide.columns if c != "event_id"]))


def _preprocess_sql(near: str | None = None) -> str:
    """Median (or the mean of the nearest rows), clip at 1.5 IQR, target mean, standard score, stage by stage."""
    nulls = ("bmi", "blood_pressure_systolic", "oxygen_saturation", "creatinine", "glucose", "admission_type")
    fills = ", ".join(f"quantile_cont({c}, 0.5) AS m_{c}" for c in NUMERIC)
    modes = ", ".join(
        f"(SELECT {c} FROM encounters WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS m_{c}"
        for c in CATEGORICAL)
    best = {c: f"k_{c}" if near and c in DOUBLES else f"m_{c}" for c in (*NUMERIC, *CATEGORICAL)}
    filled = ", ".join(f"coalesce({c}, {best[c]}) AS {c}" for c in best)
    source = "encounters LEFT JOIN near USING (event_id)" if near else "encounters"
    flags = ", ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END AS {c}_missing" for c in nulls)
    ends = ", ".join(
        f"quantile_cont({c}, 0.25) - 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS lo_{c}, "
        f"quantile_cont({c}, 0.75) + 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS hi_{c}" for c in NUMERIC)
    clips = ", ".join(f"CASE WHEN {c} < lo_{c} THEN lo_{c} WHEN {c} > hi_{c} THEN hi_{c} ELSE {c} END AS {c}" for c in NUMERIC)
    names = ", ".join(f"{c}_missing" for c in nulls)
    stats = ", ".join(f"avg({c}) AS a_{c}, stddev_pop({c}) AS s_{c}" for c in NUMERIC)
    rates = ", ".join(f"avg(readmission_30day) OVER (PARTITION BY {c}) AS t_{c}" for c in CATEGORICAL)
    out = ", ".join(
        [r(f"({c} - a_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END", c) for c in NUMERIC]
        + [r(f"t_{c}", c) for c in CATEGORICAL])
    return f"""{ENC}, {near + ',' if near else ''}
    f AS (SELECT {fills} FROM encounters), g AS (SELECT {modes}),
    filled AS (SELECT event_id, readmission_30day, {filled}, {flags} FROM {source} CROSS JOIN f CROSS JOIN g),
    b AS (SELECT {ends} FROM filled),
    clipped AS (SELECT event_id, readmission_30day, {clips}, {', '.join(CATEGORICAL)}, {names} FROM filled, b),
    z AS (SELECT {stats} FROM clipped),
    coded AS (SELECT *, {rates} FROM clipped)
    SELECT event_id, {names}, {out} FROM coded, z"""


@query("f10_preprocess", _preprocess_sql())
def _(spark, sf):
    wide = _enc(spark, sf, *NUMERIC, *CATEGORICAL, D.LABEL)
    return rounded(Preprocessor().fit_transform(wide).drop(D.LABEL))


@query("f10_preprocess_knn", _preprocess_sql(nearest_sql(NUMERIC)))
def _(spark, sf):
    wide = _enc(spark, sf, *NUMERIC, *CATEGORICAL, D.LABEL)
    return rounded(Preprocessor(strategy="knn").fit_transform(wide).drop(D.LABEL))


def _removal_sql() -> str:
    """Mean, removal beyond 2.5 deviations column after column, frequency, minimum to maximum."""
    means = ", ".join(f"avg({c}) AS m_{c}" for c in NUMERIC)
    modes = ", ".join(
        f"(SELECT {c} FROM encounters WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS m_{c}"
        for c in CATEGORICAL)
    filled = ", ".join(f"coalesce({c}, m_{c}) AS {c}" for c in (*NUMERIC, *CATEGORICAL))
    steps, source = [], "filled"
    for n, c in enumerate(NUMERIC):
        steps.append(f"b{n} AS (SELECT avg({c}) AS mean, stddev_samp({c}) AS std FROM {source}), "
                     f"k{n} AS (SELECT s.* FROM {source} s, b{n} WHERE NOT ({c} < mean - 2.5 * std OR {c} > mean + 2.5 * std))")
        source = f"k{n}"
    spans = ", ".join(f"min({c}) AS lo_{c}, max({c}) - min({c}) AS w_{c}" for c in NUMERIC)
    shares = ", ".join(f"CAST(count(*) OVER (PARTITION BY {c}) AS DOUBLE) / count(*) OVER () AS t_{c}" for c in CATEGORICAL)
    out = ", ".join(
        [r(f"({c} - lo_{c}) / CASE WHEN w_{c} = 0 THEN 1 ELSE w_{c} END", c) for c in NUMERIC]
        + [r(f"t_{c}", c) for c in CATEGORICAL])
    return f"""{ENC}, f AS (SELECT {means} FROM encounters), g AS (SELECT {modes}),
    filled AS (SELECT event_id, {filled} FROM encounters, f, g), {', '.join(steps)},
    z AS (SELECT {spans} FROM {source}), coded AS (SELECT *, {shares} FROM {source})
    SELECT event_id, {out} FROM coded, z"""


@query("f10_preprocess_remove", _removal_sql())
def _(spark, sf):
    wide = _enc(spark, sf, *NUMERIC, *CATEGORICAL, D.LABEL)
    chosen = Preprocessor(
        strategy="mean", indicator_features=False, outlier_method="zscore", outlier_action="remove",
        outlier_options={"threshold": 2.5}, sequential_outliers=True, encoding="frequency", scaling="minmax")
    return rounded(chosen.fit_transform(wide).drop(D.LABEL))


# Time series: hourly means of a vital, last label and last category per hour.
HOW = {"heart_rate": "mean", "num_medications": "mean", "readmission_30day": "last", "admission_type": "last"}
GRID_SQL = X.OBSERVATIONS_SQL + """,
hourly AS (
  SELECT patient_id, date_trunc('hour', observation_date) AS hour, avg(heart_rate) AS heart_rate,
         avg(num_medications) AS num_medications,
         arg_max(readmission_30day, (observation_date, event_id)) AS readmission_30day,
         arg_max(admission_type, (observation_date, event_id)) AS admission_type
  FROM observations GROUP BY 1, 2),
spans AS (SELECT patient_id, min(hour) AS first, max(hour) AS last FROM hourly GROUP BY 1),
grid AS (SELECT patient_id, unnest(generate_series(first, last, INTERVAL 1 HOUR)) AS observation_date FROM spans),
resampled AS (
  SELECT g.patient_id, g.observation_date, heart_rate, num_medications, readmission_30day, admission_type
  FROM grid g LEFT JOIN hourly h ON g.patient_id = h.patient_id AND g.observation_date = h.hour)"""


def _line(c: str) -> str:
    return (f"CASE WHEN l_{c} IS NULL OR n_{c} IS NULL OR lp_{c} = np_{c} THEN coalesce(l_{c}, n_{c}) "
            f"ELSE l_{c} + (n_{c} - l_{c}) / (np_{c} - lp_{c}) * (pos - lp_{c}) END")


_GRID_COLUMNS = tuple(HOW)
FILLED_SQL = GRID_SQL + """,
placed AS (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY observation_date) AS pos FROM resampled),
around AS (SELECT *, """ + ", ".join(
    f"last_value({c} IGNORE NULLS) OVER back AS l_{c}, first_value({c} IGNORE NULLS) OVER ahead AS n_{c}, "
    f"last_value(CASE WHEN {c} IS NOT NULL THEN pos END IGNORE NULLS) OVER back AS lp_{c}, "
    f"first_value(CASE WHEN {c} IS NOT NULL THEN pos END IGNORE NULLS) OVER ahead AS np_{c}"
    for c in _GRID_COLUMNS) + """ FROM placed
  WINDOW back AS (PARTITION BY patient_id ORDER BY observation_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         ahead AS (PARTITION BY patient_id ORDER BY observation_date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""
_FILLED_OUT = ", ".join(
    [f"{_line(c)} AS {c}" for c in ("heart_rate", "num_medications")]
    + [f"coalesce(l_{c}, n_{c}) AS {c}" for c in ("readmission_30day", "admission_type")])
SERIES_SQL = FILLED_SQL + f""",
series AS (SELECT patient_id, observation_date, {_FILLED_OUT} FROM around)"""


@query("ts1_resample", f"WITH {GRID_SQL} SELECT patient_id, observation_date, {r('heart_rate')}, "
       f"{r('num_medications')}, readmission_30day, admission_type FROM resampled")
def _(spark, sf):
    return rounded(rs_.resample(X.observations(spark, sf), HOW))


def _vital_grid(spark, sf):
    return rs_.resample(X.observations(spark, sf), {"heart_rate": "mean", "admission_type": "last"})


@query("w8_ffill_bfill", f"""WITH {FILLED_SQL}
SELECT patient_id, observation_date, {r('coalesce(l_heart_rate, n_heart_rate)', 'heart_rate')},
       coalesce(l_admission_type, n_admission_type) AS admission_type FROM around""")
def _(spark, sf):
    grid = _vital_grid(spark, sf)
    return rounded(tl.fill_gaps(grid, ("heart_rate", "admission_type"), "both", order=("observation_date",)))


@query("w9_interpolate_linear", f"""WITH {FILLED_SQL}
SELECT patient_id, observation_date, {r(_line('heart_rate'), 'heart_rate')} FROM around""")
def _(spark, sf):
    grid = _vital_grid(spark, sf).drop("admission_type")
    return rounded(tl.interpolate(grid, ("heart_rate",), order=("observation_date",)))


@query("ts3_resample_interpolate_fill", f"""WITH {SERIES_SQL}
SELECT patient_id, observation_date, {r('heart_rate')}, {r('num_medications')}, readmission_30day, admission_type
FROM series""")
def _(spark, sf):
    return rounded(rs_.resample_fill(X.observations(spark, sf), HOW))


def _windows_sql(source: str, order: str, columns, label: str, lookback: int, horizon: int) -> str:
    """Per window its first value and sum of every feature, and the label."""
    span = lookback + horizon
    frame = f"OVER (PARTITION BY patient_id ORDER BY {order} ROWS BETWEEN {span - 1} PRECEDING AND {horizon} PRECEDING)"
    picks = ", ".join(
        f"first_value(CAST(CAST({c} AS FLOAT) AS DOUBLE)) {frame} AS first_{c}, sum(CAST(CAST({c} AS FLOAT) AS DOUBLE)) {frame} AS sum_{c}" for c in columns)
    outs = ", ".join(r(e, e, 4) for c in columns for e in (f"first_{c}", f"sum_{c}"))
    return f"""SELECT patient_id, label_time, CAST(target AS INTEGER) AS target, {outs} FROM (
      SELECT patient_id, observation_date AS label_time, {label} AS target, {picks},
             row_number() OVER (PARTITION BY patient_id ORDER BY {order}) AS pos FROM {source})
      WHERE pos >= {span}"""


def _window_sums(made, columns):
    total = lambda i: F.aggregate(
        "sequence", F.lit(0.0), lambda acc, row: acc + F.coalesce(row[i].cast("double"), F.lit(0.0)))
    outs = []
    for i, c in enumerate(columns):
        outs += [F.round(F.col("sequence")[0][i].cast("double") + 1.3e-7, 4).alias(f"first_{c}"),
                 F.round(total(i) + 1.3e-7, 4).alias(f"sum_{c}")]
    return made.select("patient_id", "label_time", F.col("target").cast("int").alias("target"), *outs)


@query("w11_sliding_sequences", OBS + _windows_sql(
    "(SELECT *, coalesce(heart_rate, 0) AS hr FROM observations)", "observation_date, event_id",
    ("hr", "num_medications"), "readmission_30day", 48, 24))
def _(spark, sf):
    rows = X.observations(spark, sf).withColumn("hr", F.coalesce("heart_rate", F.lit(0.0)))
    made = tl.sliding_sequences(
        rows, ("hr", "num_medications"), order=D.TIMELINE)
    return _window_sums(made, ("hr", "num_medications"))


@query("ts4_sequence_dataset", f"WITH {SERIES_SQL} " + _windows_sql(
    "series", "observation_date", ("heart_rate", "num_medications"), "readmission_30day", 48, 24))
def _(spark, sf):
    made = rs_.sequence_dataset(
        X.observations(spark, sf), HOW, ("heart_rate", "num_medications"))
    return _window_sums(made, ("heart_rate", "num_medications"))
