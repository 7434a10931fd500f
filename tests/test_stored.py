"""Sources, sinks, run records, metrics and streamed scoring."""

from __future__ import annotations

import datetime as dt
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import plan_of, rows
from cohortline import defaults as D
from cohortline import fixtures as X
from cohortline.operators import events as ev
from cohortline.plans import evaluation as evl
from cohortline.plans import runs as rn
from cohortline.plans import scoring as scr
from cohortline.plans import training as tr
from cohortline.queries.stored import WEIGHTS
from cohortline.sources import readers as rd
from cohortline.sources import writers as wr
from cohortline.streaming.events import event_stream
from cohortline.streaming.serving import score_stream, serve


def test_formats_by_suffix(spark, tmp_path):
    (tmp_path / "a.csv").write_text("patient_id,age\np1,30\np2,\n")
    (tmp_path / "b.json").write_text(json.dumps([{"patient_id": "p3", "age": 40}, {"patient_id": "p4"}], indent=1))
    (tmp_path / "c.jsonl").write_text('{"patient_id": "p5", "age": 50}\n{"patient_id": "p6", "age": 51}\n')
    (tmp_path / "d.json").write_text(json.dumps({"run": {"id": "x", "depth": {"n": 1}}, "tags": [1, 2]}, indent=2))
    spark.createDataFrame([("p7", float("nan")), ("p8", 1.5)], "patient_id string, v double").write.parquet(str(tmp_path / "e.parquet"))
    (tmp_path / "f.xlsx").write_text("x")
    at = lambda n: str(tmp_path / n)
    assert rows(rd.scan_auto(spark, at("a.csv")), "patient_id") == [("p1", 30), ("p2", None)]
    assert {r["patient_id"] for r in rd.scan_auto(spark, at("b.json")).collect()} == {"p3", "p4"}
    assert rd.scan_auto(spark, at("c.jsonl")).count() == 2
    nested = rd.scan_auto(spark, at("d.json"))
    assert nested.columns == ["run.depth.n", "run.id", "tags"] and nested.first()["run.depth.n"] == 1
    assert rows(rd.scan_auto(spark, at("e.parquet")), "patient_id") == [("p7", None), ("p8", 1.5)]
    with pytest.raises(ValueError):
        rd.scan_auto(spark, at("f.xlsx"))
    with pytest.raises(FileNotFoundError):
        rd.scan_auto(spark, at("missing.csv"))


def test_folder_is_read_whole(spark, tmp_path):
    (tmp_path / "one.csv").write_text("patient_id,age\np1,30\n")
    (tmp_path / "two.csv").write_text("patient_id,age\np2,31\n")
    (tmp_path / "three.jsonl").write_text('{"patient_id": "p3", "bmi": 22.5}\n')
    found = rd.scan_auto(spark, str(tmp_path))
    assert {(r["patient_id"], r["age"], r["bmi"]) for r in found.collect()} == {("p1", 30, None), ("p2", 31, None), ("p3", None, 22.5)}
    empty = tmp_path / "empty"
    empty.mkdir()
    with pytest.raises(FileNotFoundError):
        rd.scan_auto(spark, str(empty))


@pytest.mark.parametrize("format", ["csv", "json", "parquet"])
def test_round_trip(spark, tmp_path, format):
    df = spark.createDataFrame([("a", 1, 1.5, None), ("b", None, None, "x,\"y\"")], "s string, n int, v double, t string")
    path = str(tmp_path / "deep" / f"t.{format}")
    wr.write_table(df, path, format)
    scan = {"csv": rd.scan_csv, "json": lambda *a: rd.scan_json(*a, lines=True), "parquet": rd.scan_parquet}[format]
    assert rows(scan(spark, path, df.schema), "s") == rows(df, "s")
    assert rd.scan_auto(spark, path, df.schema).count() == 2
    with pytest.raises(ValueError):
        wr.write_table(df, path, "xml")


def test_event_layout(spark, folder, tmp_path):
    events = ev.to_events(X.encounters(spark, folder)).cache()
    wr.write_events(events, str(tmp_path), buckets=4, files=6)
    wr.write_metadata(events, str(tmp_path))
    assert rows(wr.read_events(spark, str(tmp_path)).groupBy("code").count(), "code") == rows(events.groupBy("code").count(), "code")
    subject = events.first()["subject_id"]
    one = wr.read_subject_events(spark, str(tmp_path), subject)
    assert one.count() == events.filter(F.col("subject_id") == subject).count()
    assert "PartitionFilters: [isnotnull(bucket" in plan_of(one)
    meta = spark.read.json(str(tmp_path / "metadata")).first()
    assert meta["total_events"] == events.count() and " to " in meta["date_range"]
    assert wr.event_metadata(events, approximate=True).first()["total_events"] == events.count()
    assert wr.event_metadata(events.limit(0)).first()["total_events"] == 0


def _record(name, f1, **extra):
    metrics = {"accuracy": 0.9, "precision": 0.8, "recall": 0.7, "f1_score": f1, "specificity": 0.6, "balanced_accuracy": 0.65}
    return {"run_name": name, "model_type": name.split("_")[0], "parameter_count": 10, "training_time_seconds": 1.5,
            "metrics": metrics, "config": {"training": {"lr": "0.1"}}, "timestamp": f"2024-01-0{extra.pop('day', 1)}",
            "history": {"val_loss": [1.0, 0.5, 0.6, 0.7, 0.4]}, **extra}


@pytest.fixture
def records(tmp_path):
    files = {
        "mlp_a": _record("mlp_a", 0.7), "lstm_b": _record("lstm_b", 0.8, day=2), "lstm_c": _record("lstm_c", 0.8, day=3),
        "sweep": {"experiment_type": "hyperparameter_sweep", "model_type": "mlp", "metric_to_optimize": "f1_score", "all_results": [
            {"run_index": 1, "run_name": "s1", "params": {"lr": "0.1"}, "score": 0.5, "metrics": {"f1_score": 0.5}},
            {"run_index": 2, "run_name": "s2", "params": {"lr": "0.2"}, "error": "failed"},
            {"run_index": 3, "run_name": "s3", "params": {"lr": "0.3"}, "score": 0.5, "metrics": {"f1_score": 0.5}}]},
        "ablation": {"experiment_type": "ablation_study", "model_type": "mlp", "ablation_results": {
            "full_model": {"metrics": {"f1_score": 0.80}}, "no_a": {"metrics": {"f1_score": 0.74}},
            "no_b": {"metrics": {"f1_score": 0.77}}, "no_c": {"metrics": {"f1_score": 0.79}}, "no_d": {"metrics": {"f1_score": 0.81}}}},
        "comparison": {"experiment_type": "model_comparison", "best_model": "mlp"},
    }
    del files["mlp_a"]["metrics"]["accuracy"]
    for name, content in files.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(content, indent=2))
    (tmp_path / "broken.json").write_text('{"run_name": "bro')
    unnamed = _record("x", 0.1)
    del unnamed["run_name"]
    (tmp_path / "unnamed.json").write_text(json.dumps(unnamed))
    return str(tmp_path)


def test_reading_run_records(spark, records):
    found = rd.read_run_results(spark, records)
    assert found.count() == 7
    assert rd.read_run_results(spark, records, corrupt=True).filter("_corrupt_record is not null").count() == 1
    assert {r["run_name"] for r in found.filter("metrics is not null").collect()} == {"mlp_a", "lstm_b", "lstm_c", "unnamed"}
    some = rd.read_run_results(spark, records, names=["mlp_a", "lstm_b"])
    assert some.count() == 2 and some.first()["config"]["training"]["lr"] == "0.1"


def test_run_analytics(spark, records):
    found = rd.read_run_results(spark, records).cache()
    single = found.filter("metrics is not null")
    assert [r["run_name"] for r in rn.top_n_runs(single, 2).collect()] == ["lstm_b", "lstm_c"]
    assert [r["run_name"] for r in rn.runs_newest_first(single).collect()][:2] == ["lstm_c", "lstm_b"]
    assert rn.argmax_run(single, ["lstm_c", "lstm_b"]).first()["run_name"] == "lstm_c"
    compared = {r["run_name"]: r for r in rn.compare_runs(single, ["mlp_a", "lstm_b"]).collect()}
    assert compared["lstm_b"]["is_best"] and compared["mlp_a"]["accuracy"] == 0.0 and compared["mlp_a"]["auc_roc"] is None
    assert {r["auc_roc"] for r in rn.comparison_table(single).collect()} == {0.0}
    sweep = rn.sweep_rows(found)
    assert [(r["rank"], r["run_name"], r["is_best"]) for r in rn.top_n_sweep(sweep).orderBy("rank").collect()] == [(1, "s1", True), (2, "s3", False)]
    summary = rn.sweep_summary(sweep).first()
    assert (summary["total_runs"], summary["successful_runs"], summary["best_config"]) == (3, 2, {"lr": "0.1"})
    impact = [(r["component"], r["delta_f1"], r["impact"]) for r in rn.ablation_impact(rn.ablation_rows(found)).collect()]
    assert impact == [("no_a", -0.06, "critical"), ("no_b", -0.03, "significant"), ("no_c", -0.01, "minor"), ("no_d", 0.01, "neutral")]
    report = rn.report(found).first()
    assert (report["total_experiments"], report["total_single_runs"], report["best_f1"], report["worst_f1"]) == (7, 4, 0.8, 0.1)
    assert report["models_tested"] == "lstm,mlp,x"


@pytest.mark.parametrize("patience, want", [(1, (0.5, 2, 3)), (2, (0.5, 2, 4)), (5, (0.4, 5, None))])
def test_early_stop_from_history(spark, records, patience, want):
    runs = rd.read_run_results(spark, records, names=["mlp_a"])
    assert tuple(rn.best_epoch(runs, patience=patience).first())[1:] == want


@pytest.fixture(scope="module")
def scores(spark):
    rng = np.random.default_rng(4)
    y = rng.integers(0, 2, 3000)
    p = np.round(np.clip(0.3 * y + rng.normal(0.4, 0.25, 3000), 0, 1), 2)
    p[:5] += 1e-7  # several scores inside one coarse bucket
    df = spark.createDataFrame([(int(a), float(min(b, 1.0))) for a, b in zip(y, p)], "label int, probability double").repartition(4)
    return df, y, np.minimum(p, 1.0)


def test_curves_match_brute_force(spark, scores):
    df, y, p = scores
    pos, neg = p[y == 1], p[y == 0]
    auc = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    assert evl.auc_roc(df).first()[0] == pytest.approx(auc, abs=1e-12)
    average = sum(((p >= s) & (y == 1)).sum() / (p >= s).sum() * ((p == s) & (y == 1)).sum() for s in np.unique(p)) / len(pos)
    assert evl.auc_pr(df).first()[0] == pytest.approx(average, abs=1e-12)


def test_thresholds_match_brute_force(spark, scores):
    df, y, p = scores
    for r in evl.threshold_analysis(df, steps=100).collect():
        hit = p >= r["threshold"]
        assert (r["tp"], r["fp"]) == ((hit & (y == 1)).sum(), (hit & (y == 0)).sum()), r["threshold"]
    best = evl.optimal_threshold_by_f1(df, steps=100).first()
    table = {r["threshold"]: r["f1_score"] for r in evl.threshold_analysis(df, steps=100).collect()}
    assert best["f1_score"] == max(table.values())
    assert best["threshold"] == min(t for t, f in table.items() if f == best["f1_score"])


def test_loss_and_degenerate_metrics(spark):
    df = spark.createDataFrame([(1, 1000.0), (0, -1000.0), (1, 0.0)], "label int, logit double")
    assert evl.log_loss(df).first()[0] == pytest.approx(np.log(2) / 3)
    none = spark.createDataFrame([(0, 0.1), (0, 0.2)], "label int, probability double")
    found = evl.classification_metrics(none).first()
    assert found["precision"] == 0 and found["f1_score"] == 0 and found["accuracy"] == 1
    assert evl.auc_roc(none).first()[0] is None


def test_calibration_closes_last_bin(spark):
    df = spark.createDataFrame([(1, 1.0), (0, 0.95), (0, 0.05)], "label int, probability double")
    assert {r["bin"]: r["n"] for r in evl.calibration_curve(df).collect()} == {9: 2, 0: 1}


def test_models_learn_and_logits_agree(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(600, 2))
    y = (x[:, 0] - x[:, 1] + rng.normal(scale=0.3, size=600) > 0).astype(int)
    df = spark.createDataFrame([(i, float(a), float(b) if i % 50 else None, int(c)) for i, ((a, b), c) in enumerate(zip(x, y))],
                               "event_id long, a double, b double, readmission_30day int").cache()
    for model in (tr.fit_logistic(df, ("a", "b"), positive_weight=1.5), tr.fit_mlp(df, ("a", "b"), hidden=(4,), iterations=60)):
        out = tr.predict(model, df, ("a", "b"))
        assert out.filter(F.abs(scr.sigmoid(F.col("logit")) - F.col("probability")) > 1e-6).count() == 0
        assert evl.auc_roc(out, label="readmission_30day").first()[0] > 0.9
    top = tr.feature_importance(tr.fit_logistic(df, ("a", "b")), ("a", "b"), spark).collect()
    assert {r["feature"] for r in top} == {"a", "b"} and top[0]["importance"] >= top[1]["importance"]
    sweep = tr.grid_sweep(df, ("a", "b"), {"regParam": [0.01, -1.0]}, metric="f1_score").orderBy("run_index").collect()
    assert sweep[0]["score"] > 0.8 and sweep[0]["error"] is None
    assert sweep[1]["score"] is None and "regParam" in sweep[1]["error"] and sweep[1]["metrics"] is None
    found = sweep[0]["metrics"]
    assert set(found) == set(D.RUN_METRICS) and found["f1_score"] == sweep[0]["score"]
    assert found["balanced_accuracy"] == pytest.approx((found["recall"] + found["specificity"]) / 2) and found["auc_roc"] > 0.8


def test_stream_equals_batch(spark, folder, tmp_path):
    wide = X.encounters(spark, folder).drop("patient_id", "observation_date", "discharge_date")
    wide.repartition(5).write.parquet(str(tmp_path / "in"))
    running = score_stream(spark, str(tmp_path / "in"), wide.schema, str(tmp_path / "out"), str(tmp_path / "state"),
                           WEIGHTS, intercept=-2.0, files_per_trigger=2)
    running.awaitTermination()
    streamed = spark.read.parquet(str(tmp_path / "out"))
    batch = serve(wide, WEIGHTS, intercept=-2.0)
    assert rows(streamed, "event_id") == rows(batch, "event_id") and 0 < batch.count() < wide.count()


def test_predictions_on_disk(spark, folder, tmp_path):
    scored = X.scored(spark, folder)
    wr.write_predictions(scored, str(tmp_path), threshold=0.5)
    written = spark.read.json(str(tmp_path / "predictions"))
    summary = spark.read.json(str(tmp_path / "summary")).first()
    assert written.count() == summary["total_samples"] == scored.count()
    assert summary["predicted_positive"] + summary["predicted_negative"] == summary["total_samples"]
    assert set(written.columns) == {"sample_index", "prediction", "probability", "risk_level", "patient_id"}


def test_event_stream_equals_batch_over_restarts(spark, tmp_path):
    """Copies in several files and in any order; a restart; late, pending and untimed rows."""
    schema = "patient_id string, event_id long, observation_date timestamp, heart_rate double, admission_type string"
    start = dt.datetime(2024, 1, 1)
    hour = lambda n: start + dt.timedelta(hours=n)
    files = [
        [("a", 9, hour(0), 90.0, "urgent"), ("b", 8, hour(2), None, None), (None, 7, hour(1), 70.0, None), ("a", 5, None, 50.0, None)],
        [("a", 3, hour(0), 30.0, "urgent"), ("a", None, hour(0), 10.0, None), ("b", 2, hour(2), 20.0, "elective"), ("a", 6, None, 50.0, None)],
        [("c", 1, hour(40), 10.0, None)],                                          # the watermark passes hour 2
        [("a", 0, hour(0), 1.0, "late"), ("c", 11, hour(41), 11.0, None)],          # hour 0 is late now
        [("d", 12, hour(200), 12.0, None)],                                        # stays in the state
    ]
    frames = [spark.createDataFrame(f, schema).coalesce(1) for f in files]
    at = {n: str(tmp_path / n) for n in ("in", "out", "state")}

    def run(*parts):
        for part in parts:      # a file and a run each
            frames[part].write.mode("append").parquet(at["in"])
            event_stream(spark, at["in"], frames[0].schema, at["out"], at["state"]).awaitTermination()

    run(0, 1)
    assert spark.read.parquet(at["out"]).where("timestamp IS NOT NULL").count() == 0
    run(2, 3, 4)
    found = spark.read.parquet(at["out"])
    on_time = [r for k, f in enumerate(files) for r in f if r[4] != "late" and r[0] != "d"]
    batch = ev.to_events(spark.createDataFrame(on_time, schema))
    by = ("subject_id", "timestamp", "code")
    assert rows(found.where("timestamp IS NOT NULL"), *by) == rows(batch.where("timestamp IS NOT NULL"), *by)
    assert [r[3] for r in rows(found.where("timestamp IS NULL"), *by)] == [50.0, 50.0]


def test_event_state_holds_one_row_per_subject_and_time(spark, tmp_path):
    """However many codes a row has; codes that several columns may give are one event, that of the first row."""
    schema = "patient_id string, event_id long, observation_date timestamp, heart_rate double, bmi double, primary_diagnosis string, has_chd int"
    at = dt.datetime(2024, 1, 1)
    data = [("a", 4, at, 4.0, 1.0, "CHD", 0), ("a", 2, at, None, 2.0, "RENAL", 1), ("b", 5, at, 5.0, None, "CHD", 1),
            ("b", 3, at, 3.0, None, "CHD", 0), ("c", 1, at, 1.0, 1.0, "x", 1), ("d", 6, at + dt.timedelta(days=9), 1.0, 1.0, "x", 1)]
    frame = spark.createDataFrame(data, schema).coalesce(1)
    frame.write.parquet(str(tmp_path / "in"))
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    running = event_stream(spark, str(tmp_path / "in"), frame.schema, str(tmp_path / "out"), str(tmp_path / "state"))
    running.awaitTermination()
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before
    assert max(s["numRowsTotal"] for p in running.recentProgress for s in p["stateOperators"]) == 4
    by = ("subject_id", "code")
    batch = ev.to_events(frame.where("patient_id <> 'd'"))
    assert rows(spark.read.parquet(str(tmp_path / "out")), *by) == rows(batch, *by)
