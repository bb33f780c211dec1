"""The three batch stages end to end on the smallest tables (tiny forests), run more than once."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from clinrisk import config as C
from clinrisk.fixtures import simulated_responses
from clinrisk.operators import explain as EX
from clinrisk.plans import pipeline as P
from clinrisk.session import path_exists, remove_scratch, scratch_path, shared_dir
from clinrisk.sources.sinks import KeyCollision, ScoreStore, append_guarded, with_defaults
from clinrisk.streaming.explanations import start_merge_stream
from small import SMALL


def _pending(spark, out):
    star, store = P._stored(spark, out), ScoreStore(spark, f"{out}/scores")
    return EX.pending(store.current(), star.patients, star.admissions, star.vitals, star.diagnoses)


def test_load_score_explain_twice(spark, capsys, monkeypatch):
    monkeypatch.setattr(C, "AS_OF", C.AS_OF)
    out = scratch_path(spark, "test-pipeline")
    P.run_load(spark, SMALL, out)
    P.run_score(spark, out, trees=3)
    store = ScoreStore(spark, f"{out}/scores")
    one = store.current()
    n = one.count()
    assert n == spark.read.parquet(f"{out}/features/run=1").count() > 0
    assert one.where("model_version != 'rf_v1.0' OR mortality_risk != 0.0").count() == 0
    lists = json.loads(one.first().top_features)
    assert set(lists) == set(C.TARGETS) and len(lists["readmission"]) == 5 and lists["mortality"] == []

    pending = _pending(spark, out)
    half = pending.where("admission_id % 2 = 0")
    simulated_responses(EX.prompts(half)).write.parquet(f"{out}/answers-1")
    P.run_explain(spark, out, f"{out}/answers-1")
    left = _pending(spark, out)
    assert left.where("admission_id % 2 = 0").isEmpty() and left.count() == pending.where("admission_id % 2 = 1").count()
    simulated_responses(EX.prompts(left)).write.parquet(f"{out}/answers-2")
    P.run_explain(spark, out, f"{out}/answers-2")           # the first answers are still there
    assert _pending(spark, out).isEmpty()

    P.run_score(spark, out, trees=3, as_of=dt.date(2002, 2, 1))
    both = store.current()
    assert both.count() == 2 * n and both.agg(F.max("score_id")).first()[0] == 2 * n
    assert both.where("run = 2").agg(F.min("score_id"), F.max("scored_at")).first()[:] == (n + 1, dt.datetime(2002, 2, 1))
    assert _pending(spark, out).count() > 0                # the new rows wait for answers of their own
    text = capsys.readouterr().out
    assert "AUC" in text and "prompts ok" in text and "no rows need an explanation" in text


SCORES = "score_id long, patient_id long, admission_id long, scored_at timestamp_ntz, ai_explanation string"


def test_late_first_answer_and_restarted_stream(spark):
    store = ScoreStore(spark, scratch_path(spark, "test-store"))
    store.add_run(spark.createDataFrame([(1, 7, 70, None, None), (2, 8, 80, None, "old")], SCORES))
    inbox = scratch_path(spark, "test-inbox")

    def send(*rows):
        spark.createDataFrame(list(rows), "patient_id long, admission_id long, seq int, explanation string").coalesce(1).write.mode("append").parquet(inbox)
        start_merge_stream(store, inbox).awaitTermination()
        return {r.score_id: r.ai_explanation for r in store.current().collect()}
    assert send((7, 70, 2, "second")) == {1: "second", 2: "old"}
    assert send((7, 70, 1, "first"), (8, 80, 1, "new")) == {1: "second", 2: "new"}      # a new stream, the same store
    store.add_run(spark.createDataFrame([(3, 7, 70, None, None)], SCORES))
    assert {r.score_id: r.ai_explanation for r in store.current().collect()}[3] is None
    assert send((7, 70, 3, "third")) == {1: "third", 2: "new", 3: "third"}


def test_guard_rejects_repeats_nulls_and_stored_keys(spark):
    path = scratch_path(spark, "test-table")
    df = spark.range(5).withColumnRenamed("id", "k")
    assert append_guarded(df, path, "k") == 5
    with pytest.raises(KeyCollision):
        append_guarded(df, path, "k")
    assert append_guarded(spark.range(7).withColumnRenamed("id", "k"), path, "k", "skip") == 2
    for rows in ([(9,), (9,)], [(None,)]):
        with pytest.raises(KeyCollision):
            append_guarded(spark.createDataFrame(rows, "k long"), path, "k", "skip")
    assert spark.read.parquet(path).count() == 7


def test_defaults_fill_nulls_and_absent_columns(spark):
    df = spark.createDataFrame([(1, None), (2, True)], "alert_id long, is_acknowledged boolean")
    rows = with_defaults(df, "alerts").orderBy("alert_id").collect()
    assert [r.is_acknowledged for r in rows] == [False, True] and all(r.created_at == dt.datetime(2002, 1, 1) for r in rows)


class _Cluster:
    """A session whose master is a cluster and whose folder is unset."""
    class conf:
        get = staticmethod(lambda k, d=None: None)

    class sparkContext:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(_Cluster)


def test_scratch_is_removed(spark, monkeypatch):
    from clinrisk import session
    monkeypatch.setattr(session, "_scratch_root", lambda s: f"{shared_dir(s)}/clinrisk/test-removal")
    path = scratch_path(spark, "x")
    spark.range(3).write.parquet(path)
    assert path_exists(spark, path)
    remove_scratch(spark)
    assert not path_exists(spark, path)
