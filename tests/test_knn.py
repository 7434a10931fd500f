"""Nearest-row imputation fitted on one table and applied to another, against brute force."""

from __future__ import annotations

import duckdb
import numpy as np
import pandas as pd
import pytest

from cohortline.operators.knn import KnnImputer, _Boxes, _first_cells, _further_cells, _nearest, _patterns, _within

COLUMNS = list("abcd")
K = 5


def table(rng, n, gaps=0.2):
    data = rng.normal(size=(n, 4)) * [1, 3, 10, 0.1]
    data[rng.random((n, 4)) < gaps] = np.nan
    return data


def frame(spark, data):
    rows = [(i, *[None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(data)]
    return spark.createDataFrame(rows, "i long, " + ", ".join(f"{c} double" for c in COLUMNS))


def by_sql(train, test):
    """Brute force over all pairs in SQL; distances here have no ties."""
    fit, new = (pd.DataFrame(d, columns=COLUMNS).reset_index(names="i") for d in (train, test))  # noqa: F841
    con = duckdb.connect()
    con.execute("CREATE TABLE fit_ AS SELECT i, " + ", ".join(f"nullif({c}, 'nan'::DOUBLE) AS {c}" for c in COLUMNS) + " FROM fit")
    con.execute("CREATE TABLE new_ AS SELECT i, " + ", ".join(f"nullif({c}, 'nan'::DOUBLE) AS {c}" for c in COLUMNS) + " FROM new")
    shared = " + ".join(f"CASE WHEN n.{c} IS NOT NULL AND f.{c} IS NOT NULL THEN 1 ELSE 0 END" for c in COLUMNS)
    square = " + ".join(f"coalesce((n.{c} - f.{c}) * (n.{c} - f.{c}), 0)" for c in COLUMNS)
    con.execute(f"CREATE TABLE pairs AS SELECT n.i, 4 * ({square}) / ({shared}) AS dist, f.* EXCLUDE (i) FROM new_ n, fit_ f WHERE ({shared}) > 0")
    values = ", ".join(
        f"coalesce(n.{c}, (SELECT avg({c}) FROM (SELECT {c} FROM pairs p WHERE p.i = n.i AND {c} IS NOT NULL ORDER BY dist LIMIT {K})), "
        f"(SELECT avg({c}) FROM fit_)) AS {c}" for c in COLUMNS)
    return con.execute(f"SELECT n.i, {values} FROM new_ n ORDER BY n.i").fetchall()


@pytest.mark.parametrize(("rows", "cells"), [(900, 20_000), (900, 3), (12, 20_000)])
def test_fit_on_one_table_transform_another(spark, rows, cells):
    rng = np.random.default_rng(rows + cells)
    train, test = table(rng, rows), table(rng, 150, 0.35)
    test[0] = np.nan
    fitted = KnnImputer.fit(frame(spark, train), COLUMNS, K, max_cells=cells)
    for new in (test, train[:100]):
        got = [tuple(r) for r in fitted.transform(frame(spark, new), slice_rows=30).orderBy("i").collect()]
        assert got == [(i, *map(pytest.approx, v)) for i, *v in by_sql(train, new)]


def test_donors_without_a_value_and_columns_of_gaps(spark):
    train = np.array([[1.0, 2.0, np.nan, np.nan], [1.5, np.nan, np.nan, 4.0], [9.0, 8.0, np.nan, 6.0]])
    fitted = KnnImputer.fit(frame(spark, train), COLUMNS, 2)
    got = {r["i"]: tuple(r)[1:] for r in fitted.transform(frame(spark, np.array([[1.0, np.nan, np.nan, np.nan], [np.nan] * 4]))).collect()}
    assert got[0] == (1.0, 5.0, None, 5.0) and got[1] == (pytest.approx(23 / 6), 5.0, None, 5.0)
    assert fitted.transform(frame(spark, train).limit(0)).count() == 0


def test_search_leaves_most_cells_out(spark):
    rng = np.random.default_rng(4)
    data = rng.random((20_000, 2))
    order = np.lexsort((data[:, 1], np.floor(data[:, 0] * 60)))
    cells = np.array_split(data[order], 400)
    boxes = _Boxes(np.arange(400), np.array([c.min(0) for c in cells]), np.array([c.max(0) for c in cells]),
                   np.ones((400, 2), bool), np.full((400, 2), 50.0))
    points = np.column_stack([rng.random(50), np.full(50, np.nan)])
    seen = _first_cells(boxes, boxes.above(), points, 5)
    limits = np.full((50, 2), 1e-8)
    further = _further_cells(boxes, boxes.above(), points, limits, seen)
    for point, first, rest in zip(points, seen, further):
        inside = {i for i, c in enumerate(cells) if ((c[:, 0] - point[0]) ** 2 * 2 <= 1e-8).any()}
        assert len(first) == 1 and inside <= {*first, *rest} and len(rest) < 40


def test_pairs_within_reach_hold_all_nearest_rows():
    """Boxes of a cell leave out rows that are too far, never one of the nearest, ties included."""
    rng = np.random.default_rng(8)
    y = np.round(rng.normal(size=(4000, 3)) * [10, 3, 0.1], 1)
    x = np.round(rng.normal(size=(700, 3)) * [10, 3, 0.1], 1)
    square = np.square(x[:, None] - y[None]).sum(2)
    fifth = np.sort(square, axis=1)[:, 4]
    for reach in (np.full(700, np.inf), np.full(700, 2.0), fifth):
        pairs = set(zip(*_within(x, y, reach, 5)))
        wanted = np.argwhere((square <= fifth[:, None]) & (square <= reach[:, None]))
        assert len(wanted) and {tuple(p) for p in wanted} <= pairs and len(pairs) < 700 * 100


def test_search_keeps_to_the_distance_found_before():
    rows = pd.DataFrame({"_id": [7], "a": [0.0], "b": [np.nan], "_limit0": [np.nan], "_limit1": [2.0]})
    donors = pd.DataFrame({"a": [0.5, 1.0, 3.0], "b": [1.0, 2.0, 3.0], "_from": [0, 1, 2], "_m": [1, 1, 1]})
    found = _nearest(["a", "b"], 5)(rows, donors)
    assert list(zip(found["_d"], found["_value"])) == [(0.5, 1.0), (2.0, 2.0)]
    assert len(_nearest(["a", "b"], 5)(rows.assign(_limit1=np.nan), donors)) == 3


@pytest.mark.parametrize("wide", [3, 8, 9, 20])
def test_patterns_of_any_number_of_columns(wide):
    rng = np.random.default_rng(wide)
    values = np.where(rng.random((300, wide)) < 0.2, np.nan, 1.0)
    found = _patterns(values)
    assert sorted(i for _, rows in found for i in rows) == list(range(300))
    assert all((~np.isnan(values[rows]) == known).all() for known, rows in found)
    assert len(found) == len(np.unique(np.isnan(values), axis=0)) and _patterns(values[:0]) == []


def test_narrow_cells_come_before_wide_ones_around_them():
    """A cell that joins two far ends of the curve holds no rows in between."""
    ends = np.array([[[0.0, 0.0], [100.0, 100.0]], [[40.0, 40.0], [44.0, 60.0]]])
    boxes = _Boxes(np.arange(2), ends[:, 0], ends[:, 1], np.ones((2, 2), bool), np.full((2, 2), 50.0))
    points = np.array([[43.9, np.nan], [np.nan, 50.0], [90.0, np.nan]])
    assert [list(c) for c in _first_cells(boxes, boxes.above(), points, 5)] == [[1], [1], [0]]


def test_one_cell_gives_at_most_k_rows_for_a_gap():
    """Whatever the number of gap patterns among its rows."""
    rng = np.random.default_rng(3)
    rows = pd.DataFrame(table(rng, 40, 0.3), columns=COLUMNS).dropna(how="all").reset_index(names="_id")
    rows = rows.assign(**{f"_limit{i}": np.nan for i in range(4)})
    donors = pd.DataFrame(table(rng, 300, 0.3), columns=COLUMNS).reset_index(names="_from").assign(_m=1)
    found = _nearest(COLUMNS, K)(rows, donors)
    assert found.groupby(["_id", "_feature"]).size().max() == K
    for (row, gap), some in found.groupby(["_id", "_feature"]):
        here, there = rows.set_index("_id").loc[row, COLUMNS].to_numpy(float), donors[COLUMNS].to_numpy()
        square = np.square(here - there)
        shared = (~np.isnan(square)).sum(axis=1)
        apart = np.where((shared > 0) & ~np.isnan(there[:, gap]), np.nansum(square, axis=1) * 4 / np.maximum(shared, 1), np.inf)
        assert list(some["_d"]) == pytest.approx(sorted(apart)[:K])


def test_rows_answered_once_are_not_searched_again(spark, monkeypatch):
    rng = np.random.default_rng(6)
    train, more = table(rng, 200), table(rng, 40, 0.4)
    fitted, met = KnnImputer.fit(frame(spark, train), COLUMNS, K), KnnImputer._met
    asked = []
    monkeypatch.setattr(KnnImputer, "_met", lambda self, visitors, slice_rows: asked.append(visitors.count()) or met(self, visitors, slice_rows))
    answer = lambda data: [tuple(r) for r in fitted.transform(frame(spark, data)).orderBy("i").collect()]
    first = answer(train)
    assert sum(asked) and answer(train) == first
    searched = len(asked)
    both = answer(np.concatenate([train, more]))
    gaps = np.isnan(more).any(axis=1).sum()
    assert both[:200] == first and asked[:searched] == asked[:2] and asked[2:] == [gaps, gaps]
    assert [r[1:] for r in both[200:]] == [tuple(map(pytest.approx, v)) for _, *v in by_sql(train, more)]
