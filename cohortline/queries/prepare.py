"""J1, I*, O*, E*, N*, G*: lookups, imputation, outliers, encodings, scaling, bands."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortline import defaults as D
from cohortline import fixtures as X
from cohortline.operators import chained as ch
from cohortline.operators import encode as en
from cohortline.operators import impute as im
from cohortline.operators import knn as kn
from cohortline.operators import outliers as ou
from cohortline.operators import scale as sc
from cohortline.operators.lookup import map_lookup
from cohortline.operators.profile import group_mean
from cohortline.session import kept
from cohortline.queries._registry import CATEGORICAL, DOUBLES, NUMERIC, query, r, rounded, rs

ENC = f"WITH {X.ENCOUNTERS_SQL} "


def _cross(stats: str) -> str:
    return f"{ENC}, s AS (SELECT {stats} FROM encounters) "


@query("j1_map_lookup_join", ENC + f""",
s AS (SELECT admission_type AS k, avg(readmission_30day) AS mean FROM encounters WHERE admission_type <> '1-URGENT' GROUP BY 1)
SELECT event_id, admission_type, {r('coalesce(mean, -1)', 'rate')}
FROM encounters LEFT JOIN s ON admission_type = k""")
def _(spark, sf):
    wide = X.encounters(spark, sf).select("event_id", "admission_type", "readmission_30day")
    stats = group_mean(wide.filter("admission_type <> '1-URGENT'"), "admission_type")
    found = map_lookup(wide.drop("readmission_30day"), stats, "admission_type", {"mean": -1.0})
    return rounded(found.withColumnRenamed("mean", "rate"))


def _imputed(stat: str, kind: str = "DOUBLE") -> str:
    stats = ", ".join(f"{stat.format(c=c)} AS m_{c}" for c in DOUBLES)
    return _cross(stats) + "SELECT event_id, " + ", ".join(
        r(f"coalesce({c}, m_{c})", c) for c in DOUBLES) + " FROM encounters, s"


@query("i1_impute_mean", _imputed("avg({c})"))
def _(spark, sf):
    wide = X.encounters(spark, sf).select("event_id", *DOUBLES)
    return rounded(im.Imputer.fit(wide, DOUBLES, strategy="mean").transform(wide))


@query("i2_impute_median", _imputed("quantile_cont({c}, 0.5)"))
def _(spark, sf):
    wide = X.encounters(spark, sf).select("event_id", *DOUBLES)
    return rounded(im.Imputer.fit(wide, DOUBLES, strategy="median").transform(wide))


def _mode(c: str) -> str:
    return (f"(SELECT {c} FROM encounters WHERE {c} IS NOT NULL GROUP BY {c} "
            f"ORDER BY count(*) DESC, {c} LIMIT 1)")


@query("i3_impute_mode", ENC + "SELECT event_id, " + ", ".join(
    [f"coalesce({c}, {_mode(c)}) AS {c}" for c in CATEGORICAL]
    + [r(f"coalesce({c}, {_mode(c)})", c) if c in DOUBLES else f"coalesce({c}, {_mode(c)}) AS {c}" for c in NUMERIC])
    + " FROM encounters")
def _(spark, sf):
    wide = X.encounters(spark, sf).select("event_id", *CATEGORICAL, *NUMERIC)
    fitted = im.Imputer.fit(wide, NUMERIC, CATEGORICAL, strategy="mode")
    return rounded(fitted.transform(wide))


def nearest_sql(columns) -> str:
    """CTE ``near``: for each row with a gap the mean of its five nearest rows, over all pairs."""
    square = (f"{len(columns)} / (" + " + ".join(f"CASE WHEN a.{c} IS NOT NULL AND b.{c} IS NOT NULL THEN 1 ELSE 0 END" for c in columns)
              + ") * (" + " + ".join(f"coalesce((a.{c} - b.{c}) * (a.{c} - b.{c}), 0)" for c in columns) + ")")
    means = ", ".join(
        f"CASE WHEN any_value(a.{c}) IS NULL THEN list_avg(arg_min(b.{c}, {square}, 5) FILTER (WHERE b.{c} IS NOT NULL)) END AS k_{c}"
        for c in DOUBLES)
    gap = " OR ".join(f"{c} IS NULL" for c in DOUBLES)
    return f"near AS (SELECT a.event_id, {means} FROM (SELECT * FROM encounters WHERE {gap}) a, encounters b GROUP BY a.event_id)"


@query("i4_impute_knn", ENC + f""",
{nearest_sql(DOUBLES)}
SELECT encounters.event_id, {', '.join(r(f'coalesce({c}, k_{c})', c) for c in DOUBLES)}
FROM encounters LEFT JOIN near ON encounters.event_id = near.event_id""")
def _(spark, sf):
    wide = X.encounters(spark, sf).select("event_id", *DOUBLES)
    return rounded(kn.impute_knn(wide, DOUBLES))


@query("i5_impute_iterative")
def _(spark, sf):
    wide = X.encounters(spark, sf).select("event_id", *DOUBLES)
    return rounded(ch.impute_iterative(wide, DOUBLES))


# Two columns: a filled value is a line over the other column, so the rounds need sums by gap pattern only.
# a = p + q * b where only a is a gap, b = r + s * a where only b is, u and v where both are.
_PAIR = f"""{ENC.replace('WITH', 'WITH RECURSIVE', 1)}, mean AS (SELECT avg(glucose) AS ma, avg(bmi) AS mb, 1e-3 * max(greatest(abs(glucose), abs(bmi))) AS lim FROM encounters),
c AS (SELECT event_id, glucose - ma AS a, bmi - mb AS b FROM encounters, mean),
m AS (
  SELECT lim, {', '.join(f"CAST(count(*) FILTER ({w}) AS DOUBLE) AS n{i}, " + ', '.join(
    f"coalesce(sum({e}) FILTER ({w}), 0) AS {k}{i}" for k, e in (('a', 'a'), ('b', 'b'), ('aa', 'a * a'), ('bb', 'b * b'), ('ab', 'a * b')))
    for i, w in enumerate(('a IS NOT NULL AND b IS NOT NULL', 'a IS NULL AND b IS NOT NULL', 'a IS NOT NULL AND b IS NULL', 'a IS NULL AND b IS NULL')))},
    min(b) FILTER (a IS NULL) AS b_lo, max(b) FILTER (a IS NULL) AS b_hi, min(a) FILTER (b IS NULL) AS a_lo, max(a) FILTER (b IS NULL) AS a_hi
  FROM c, mean GROUP BY lim),
st AS (
  SELECT 1 AS turn, 0 AS f, 0 AS it, 0.0::DOUBLE AS alpha, 1.0::DOUBLE AS lam, 0.0::DOUBLE AS old, 0.0::DOUBLE AS p, 0.0::DOUBLE AS q,
         0.0::DOUBLE AS r, 0.0::DOUBLE AS s, 0.0::DOUBLE AS u, 0.0::DOUBLE AS v, [0.0, 0.0, 0.0, 0.0, 0.0, 0.0]::DOUBLE[] AS was, FALSE AS done
  UNION ALL
  SELECT CASE WHEN conv AND f = 1 THEN turn + 1 ELSE turn END, CASE WHEN conv THEN 1 - f ELSE f END, CASE WHEN conv THEN 0 ELSE it + 1 END,
         CASE WHEN conv THEN 0 ELSE alpha2 END, CASE WHEN conv THEN 1 ELSE lam2 END, w, p2, q2, r2, s2, u2, v2,
         CASE WHEN conv AND f = 1 THEN [p2, q2, r2, s2, u2, v2] ELSE was END,
         conv AND f = 1 AND (turn = 10 OR greatest(
           CASE WHEN n1 > 0 THEN greatest(abs(p2 - was[1] + (q2 - was[2]) * b_lo), abs(p2 - was[1] + (q2 - was[2]) * b_hi)) ELSE 0 END,
           CASE WHEN n2 > 0 THEN greatest(abs(r2 - was[3] + (s2 - was[4]) * a_lo), abs(r2 - was[3] + (s2 - was[4]) * a_hi)) ELSE 0 END,
           CASE WHEN n3 > 0 THEN greatest(abs(u2 - was[5]), abs(v2 - was[6])) ELSE 0 END) < lim)
  FROM (
    SELECT *, CASE WHEN conv AND f = 0 THEN shift ELSE p END AS p2, CASE WHEN conv AND f = 0 THEN w2 ELSE q END AS q2,
           CASE WHEN conv AND f = 1 THEN shift ELSE r END AS r2, CASE WHEN conv AND f = 1 THEN w2 ELSE s END AS s2,
           CASE WHEN conv AND f = 0 THEN shift + w2 * v ELSE u END AS u2, CASE WHEN conv AND f = 1 THEN shift + w2 * u ELSE v END AS v2
    FROM (
      SELECT *, y / n - w2 * x / n AS shift FROM (
        SELECT *, cxy / (cxx + lam2 / alpha2) AS w2, (it > 0 AND abs(old - w) < 1e-3) OR it = 299 AS conv FROM (
          SELECT *, (gamma + 2e-6) / (w * w + 2e-6) AS lam2, (n - gamma + 2e-6) / (greatest(cyy - 2 * w * cxy + w * w * cxx, 0) + 2e-6) AS alpha2 FROM (
            SELECT *, cxy / (cxx + lam / al) AS w, al * cxx / (lam + al * cxx) AS gamma FROM (
              SELECT *, CASE WHEN it = 0 THEN 1 / (cyy / n + 2.220446049250313e-16) ELSE alpha END AS al FROM (
                SELECT *, xx - x * x / n AS cxx, xy - x * y / n AS cxy, yy - y * y / n AS cyy FROM (
                  SELECT *, CASE f WHEN 0 THEN n0 + n2 ELSE n0 + n1 END AS n,
                         CASE f WHEN 0 THEN b0 + r * n2 + s * a2 ELSE a0 + p * n1 + q * b1 END AS x,
                         CASE f WHEN 0 THEN bb0 + r * r * n2 + 2 * r * s * a2 + s * s * aa2 ELSE aa0 + p * p * n1 + 2 * p * q * b1 + q * q * bb1 END AS xx,
                         CASE f WHEN 0 THEN a0 + a2 ELSE b0 + b1 END AS y, CASE f WHEN 0 THEN aa0 + aa2 ELSE bb0 + bb1 END AS yy,
                         CASE f WHEN 0 THEN ab0 + r * a2 + s * aa2 ELSE ab0 + p * b1 + q * bb1 END AS xy
                  FROM st, m WHERE NOT done)))))))))
"""


@query("i5_impute_iterative_pair", _PAIR + f"""
SELECT event_id, {r('ma + coalesce(a, CASE WHEN b IS NULL THEN u ELSE p + q * b END)', 'glucose')},
       {r('mb + coalesce(b, CASE WHEN a IS NULL THEN v ELSE r + s * a END)', 'bmi')}
FROM c, mean, (SELECT * FROM st WHERE done)""")
def _(spark, sf):
    wide = X.encounters(spark, sf).select("event_id", "glucose", "bmi")
    return rounded(ch.impute_iterative(wide, ("glucose", "bmi")))


_BOUNDS = {
    "iqr": lambda c: (f"quantile_cont({c}, 0.25) - 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25))",
                      f"quantile_cont({c}, 0.75) + 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25))"),
    "zscore": lambda c: (f"avg({c}) - 3 * stddev_samp({c})", f"avg({c}) + 3 * stddev_samp({c})"),
    "winsorize": lambda c: (f"quantile_cont({c}, 0.01)", f"quantile_cont({c}, 0.99)"),
}


def _bounds_sql(method: str) -> str:
    return ENC + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {r(_BOUNDS[method](c)[0], 'low')}, {r(_BOUNDS[method](c)[1], 'high')} FROM encounters"
        for c in NUMERIC)


def _bounds(spark, sf, method):
    found = method(X.encounters(spark, sf), NUMERIC)
    rows = [(c, lo, hi) for c, (lo, hi) in found.items()]
    return rounded(spark.createDataFrame(rows, "column_name string, low double, high double"))


@query("o1_bounds_iqr", _bounds_sql("iqr"))
def _(spark, sf):
    return _bounds(spark, sf, ou.bounds_iqr)


@query("o2_bounds_zscore", _bounds_sql("zscore"))
def _(spark, sf):
    return _bounds(spark, sf, ou.bounds_zscore)


@query("o3_bounds_winsorize", _bounds_sql("winsorize"))
def _(spark, sf):
    return _bounds(spark, sf, ou.bounds_winsorize)


def _bounded(method: str) -> str:
    return _cross(", ".join(
        f"{_BOUNDS[method](c)[0]} AS lo_{c}, {_BOUNDS[method](c)[1]} AS hi_{c}" for c in DOUBLES))


@query("o4_outlier_clip", _bounded("iqr") + "SELECT event_id, " + ", ".join(
    r(f"CASE WHEN {c} < lo_{c} THEN lo_{c} WHEN {c} > hi_{c} THEN hi_{c} ELSE {c} END", c) for c in DOUBLES)
    + " FROM encounters, s")
def _(spark, sf):
    wide = X.encounters(spark, sf).select("event_id", *DOUBLES)
    return rounded(ou.Outliers.fit(wide, DOUBLES).transform(wide))


@query("o5_outlier_flag", _bounded("winsorize") + "SELECT event_id, " + ", ".join(
    f"CASE WHEN {c} < lo_{c} OR {c} > hi_{c} THEN 1 ELSE 0 END AS {c}_outlier" for c in DOUBLES)
    + " FROM encounters, s")
def _(spark, sf):
    wide = X.encounters(spark, sf).select("event_id", *DOUBLES)
    flagged = ou.Outliers.fit(wide, DOUBLES, "winsorize", "flag").transform(wide)
    return flagged.select("event_id", *[f"{c}_outlier" for c in DOUBLES])


def _sequential() -> str:
    steps, source = [], "encounters"
    for n, c in enumerate(DOUBLES):
        low, high = _BOUNDS["iqr"](c)
        steps.append(f"b{n} AS (SELECT {low} AS lo, {high} AS hi FROM {source})")
        steps.append(f"k{n} AS (SELECT e.* FROM {source} e, b{n} WHERE {c} IS NULL OR NOT ({c} < lo OR {c} > hi))")
        source = f"k{n}"
    return f"{ENC}, {', '.join(steps)} SELECT event_id, {rs(DOUBLES)} FROM {source}"


@query("o6_outlier_remove", _sequential())
def _(spark, sf):
    wide = X.encounters(spark, sf).select("event_id", *DOUBLES)
    with kept(wide) as rows:
        fitted = ou.Outliers.fit(rows, DOUBLES, action="remove", sequential=True)
    return rounded(fitted.transform(wide))


_STATUS = ("F", "O", "P")
_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


@query("e1_encode_onehot", ENC + "SELECT event_id, patient_id, " + ", ".join(
    [f"CASE WHEN discharge_disposition = '{v}' THEN 1 ELSE 0 END AS discharge_disposition_{v}" for v in _STATUS]
    + [f"CASE WHEN primary_diagnosis = '{v}' THEN 1 ELSE 0 END AS primary_diagnosis_{v}" for v in _SEGMENTS])
    + " FROM encounters")
def _(spark, sf):
    columns = ("discharge_disposition", "primary_diagnosis", "patient_id")
    wide = X.encounters(spark, sf).select("event_id", *columns)
    return en.OneHot.fit(wide, columns).transform(wide)


def _encoded(code: str, miss: str, integer: bool = False) -> str:
    """One lookup CTE per column; ``code`` is an expression over the grouped rows."""
    tables = ", ".join(
        f"t_{c} AS (SELECT {c} AS k, {code.format(c=c)} AS code FROM encounters WHERE {c} IS NOT NULL GROUP BY {c})"
        for c in CATEGORICAL)
    values = ", ".join(
        f"CAST(coalesce(t_{c}.code, {miss}) AS INTEGER) AS {c}" if integer
        else r(f"coalesce(t_{c}.code, {miss})", c) for c in CATEGORICAL)
    joins = " ".join(f"LEFT JOIN t_{c} ON encounters.{c} = t_{c}.k" for c in CATEGORICAL)
    return f"{ENC}, {tables} SELECT event_id, {values} FROM encounters {joins}"


@query("e2_encode_label", _encoded("row_number() OVER (ORDER BY {c}) - 1", "-1", integer=True))
def _(spark, sf):
    wide = X.encounters(spark, sf).select("event_id", *CATEGORICAL)
    return en.fit_label(wide, CATEGORICAL).transform(wide)


@query("e3_encode_frequency", _encoded("CAST(count(*) AS DOUBLE) / sum(count(*)) OVER ()", "0"))
def _(spark, sf):
    wide = X.encounters(spark, sf).select("event_id", *CATEGORICAL)
    return rounded(en.fit_frequency(wide, CATEGORICAL).transform(wide))


@query("e4_encode_target", _encoded("avg(readmission_30day)", "(SELECT avg(readmission_30day) FROM encounters)"))
def _(spark, sf):
    wide = X.encounters(spark, sf).select("event_id", D.LABEL, *CATEGORICAL)
    return rounded(en.fit_target(wide, CATEGORICAL).transform(wide).drop(D.LABEL))


@query("e5_encode_target_oof", ENC + f""",
folded AS (
  SELECT event_id, admission_type AS k, readmission_30day AS y,
         CAST(('0x' || substr(md5(CAST(event_id AS VARCHAR) || ':42'), 1, 8)) AS BIGINT) % 5 AS fold FROM encounters),
parts AS (SELECT k, fold, sum(y) AS s, count(*) AS n FROM folded GROUP BY k, fold),
whole AS (SELECT k, sum(s) AS s, sum(n) AS n FROM parts GROUP BY k),
prior AS (SELECT fold, ((SELECT sum(s) FROM parts) - sum(s)) / ((SELECT sum(n) FROM parts) - sum(n)) AS p
          FROM parts GROUP BY fold)
SELECT event_id, f.k AS admission_type,
       {r('CASE WHEN w.n - p.n > 0 THEN CAST(w.s - p.s AS DOUBLE) / (w.n - p.n) ELSE prior.p END', 'admission_type_oof')}
FROM folded f LEFT JOIN whole w ON f.k = w.k LEFT JOIN parts p ON f.k = p.k AND f.fold = p.fold
JOIN prior ON f.fold = prior.fold""")
def _(spark, sf):
    wide = X.encounters(spark, sf).select("event_id", "admission_type", D.LABEL)
    return rounded(en.encode_target_oof(wide, "admission_type").drop(D.LABEL))


def _scaled(center: str, width: str) -> str:
    stats = ", ".join(f"{center.format(c=c)} AS a_{c}, {width.format(c=c)} AS w_{c}" for c in NUMERIC)
    return _cross(stats) + "SELECT event_id, " + ", ".join(
        r(f"({c} - a_{c}) / CASE WHEN w_{c} = 0 THEN 1 ELSE w_{c} END", c) for c in NUMERIC) + " FROM encounters, s"


def _scale(spark, sf, method):
    wide = X.encounters(spark, sf).select("event_id", *NUMERIC)
    return rounded(sc.Scaler.fit(wide, NUMERIC, method).transform(wide))


@query("n1_scale_standard", _scaled("avg({c})", "stddev_pop({c})"))
def _(spark, sf):
    return _scale(spark, sf, "standard")


@query("n2_scale_minmax", _scaled("min({c})", "CAST(max({c}) - min({c}) AS DOUBLE)"))
def _(spark, sf):
    return _scale(spark, sf, "minmax")


@query("n3_scale_robust", _scaled("quantile_cont({c}, 0.5)", "quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)"))
def _(spark, sf):
    return _scale(spark, sf, "robust")


def _inverse_normal(p: str) -> str:
    """The published approximation, from the fixed values of the operator."""
    power = lambda c, x: "0" + "".join(f" + {v!r} * pow({x}, {len(c) - 1 - i})" for i, v in enumerate(c))
    root = f"sqrt(-2 * ln(least({p}, 1 - {p})))"
    middle = f"({p} - 0.5) * ({power(sc._A, f'({p} - 0.5) * ({p} - 0.5)')}) / ({power(sc._B, f'({p} - 0.5) * ({p} - 0.5)')})"
    tail = f"({power(sc._C, root)}) / ({power(sc._D, root)})"
    return f"CASE WHEN {p} >= {sc._TAIL} AND {p} <= 1 - {sc._TAIL} THEN {middle} WHEN {p} < 0.5 THEN {tail} ELSE -({tail}) END"


# Each column's 1000 interpolated quantiles; a value equal to some of them takes the middle of their levels.
_LANDMARKS = f"""long AS (UNPIVOT (SELECT event_id, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in NUMERIC)} FROM encounters)
  ON {', '.join(NUMERIC)} INTO NAME c VALUE x),
marks AS (SELECT c, unnest(q) AS mark, generate_subscripts(q, 1) - 1 AS k FROM (
  SELECT c, quantile_cont(x, list_transform(range(1000), lambda i: CAST(i AS DOUBLE) / 999)) AS q FROM long GROUP BY c)),
steps AS (SELECT c, mark, min(k) AS first, max(k) AS last,
                 lead(mark) OVER (PARTITION BY c ORDER BY mark) AS next FROM marks GROUP BY c, mark),
shares AS (
  SELECT event_id, l.c, CASE WHEN x = mark AND first = 0 THEN 0 WHEN next IS NULL THEN 1
         WHEN x = mark THEN (first + last) / 2.0 / 999 ELSE (last + (x - mark) / (next - mark)) / 999 END AS share
  FROM long l ASOF JOIN steps s ON l.c = s.c AND l.x >= s.mark),
clipped AS (SELECT event_id, c, greatest(1e-7, least(share, 1 - 1e-7)) AS p FROM shares)"""


@query("n4_scale_quantile_normal", f"""{ENC}, {_LANDMARKS}, normal AS (SELECT event_id, c, {_inverse_normal('p')} AS z FROM clipped)
SELECT e.event_id, {', '.join(r(f"max(z) FILTER (c = '{c}')", c) for c in NUMERIC)}
FROM encounters e LEFT JOIN normal n ON e.event_id = n.event_id GROUP BY e.event_id""")
def _(spark, sf):
    wide = X.encounters(spark, sf).select("event_id", *NUMERIC)
    return rounded(sc.QuantileNormal.fit(wide, NUMERIC).transform(wide))


_BANDS = list(zip(D.AGE_EDGES, D.AGE_EDGES[1:], D.AGE_LABELS))
_BAND_CASE = "CASE " + " ".join(f"WHEN age >= {lo} AND age < {hi} THEN '{n}'" for lo, hi, n in _BANDS) + " END"


@query("g1_age_band", ENC + f"SELECT event_id, age, {_BAND_CASE} AS age_group FROM encounters")
def _(spark, sf):
    return en.age_band(X.encounters(spark, sf).select("event_id", "age"))


@query("g2_age_band_onehot", ENC + "SELECT event_id, age, " + ", ".join(
    f"CASE WHEN age >= {lo} AND age < {hi} THEN 1 ELSE 0 END AS age_grp_{n}" for lo, hi, n in _BANDS)
    + " FROM encounters")
def _(spark, sf):
    return en.age_band_onehot(X.encounters(spark, sf).select("event_id", "age"))
