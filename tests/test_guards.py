"""Constraints at the write, key filters, stores over several runs, SQL text."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from clinrisk.operators.quality import PRIMARY_KEYS, RULES
from clinrisk.plans.catalog import Catalog, feature_sql
from clinrisk.session import path_exists, scratch_path
from clinrisk.sources import guards as G
from clinrisk.sources import keyfilter as K
from clinrisk.sources.sinks import AlertStore, ScoreStore, append_guarded

PATIENTS = "patient_id bigint, full_name string, date_of_birth date, gender string, blood_type string, contact_number string, email string, emergency_contact string"
ADMISSIONS = ("admission_id bigint, patient_id bigint, admission_date timestamp_ntz, admission_type string, discharge_status string, "
              "department string, ward string, attending_doctor string")
BORN, NOW = dt.date(1950, 1, 1), dt.datetime(2001, 1, 1)


def patients(spark, *rows):
    return spark.createDataFrame([(*r, *[None] * (8 - len(r))) for r in rows], PATIENTS)


def admissions(spark, *rows):
    return spark.createDataFrame([(*r, *[None] * (8 - len(r))) for r in rows], ADMISSIONS)


def held(spark, root, table):
    return sorted(r[0] for r in spark.read.parquet(f"{root}/{table}").select(PRIMARY_KEYS[table]).collect())


def put_aside(spark, root, table):
    return sorted(((r[0], r[1]) for r in G.rejected_rows(spark, root, table).select(PRIMARY_KEYS[table], "reasons").collect()), key=str)


# --- Key filters ------------------------------------------------------------------

def test_a_filter_holds_all_its_keys_and_few_others(spark, monkeypatch):
    f = K.KeyFilter(spark, scratch_path(spark, "filter"))
    keys = spark.range(20_000).withColumnRenamed("id", "k")
    assert f.candidates(keys).count() == 0
    f.add(keys.where("k < 9000"))
    f.add(keys.where("k >= 9000 AND k < 10000"))
    assert [b for _, b in f.layers()] == [211, 24]
    for limit in (K.BROADCAST_BYTES, 0):
        monkeypatch.setattr(K, "BROADCAST_BYTES", limit)
        found = f.candidates(keys)
        assert found.where("k < 10000").count() == 10_000 and found.where("k >= 10000").count() < 400


def test_many_layers_become_one(spark, monkeypatch):
    monkeypatch.setattr(K, "MAX_LAYERS", 2)
    f = K.KeyFilter(spark, scratch_path(spark, "filter"))
    keys = spark.range(100).withColumnRenamed("id", "k")
    for i in range(3):
        f.add(keys.where(f"k % 3 = {i}"), keys.where(f"k % 3 <= {i}"))
    assert len(f.layers()) == 1 and f.candidates(keys).count() == 100


def test_no_scan_of_the_table_without_hits(spark, tmp_path):
    f = K.KeyFilter(spark, scratch_path(spark, "filter"))
    f.add(spark.range(50).withColumnRenamed("id", "k"))
    missing = str(tmp_path / "not-there")           # reading it would fail
    keys = spark.createDataFrame([(10**6 + i,) for i in range(20)], "k bigint")
    assert K.known_keys(keys, f, missing, "k").where("known").count() == 0
    path = scratch_path(spark, "table")
    spark.range(50).withColumnRenamed("id", "k").write.parquet(path)
    plan = K.known_keys(keys.union(spark.range(3)), f, path, "k")
    assert sorted(r.k for r in plan.where("known").collect()) == [0, 1, 2]


# --- Appends -------------------------------------------------------------------------

def test_a_batch_is_split_by_its_reasons(spark):
    root = scratch_path(spark, "guarded")
    batch = patients(spark, (1, "A", BORN, "Male"), (2, None, None, "Male"), (3, "C" * 151, BORN, "none"), (4, "D", BORN), (4, "E", BORN), (None, "F", BORN))
    assert G.append_checked(batch, root, "patients", on_violation="quarantine") == (1, 5)
    assert held(spark, root, "patients") == [1]
    assert put_aside(spark, root, "patients") == sorted([
        (2, "date_of_birth_not_null,full_name_not_null"), (3, "full_name_len,gender_enum"), (4, "key_repeated"), (4, "key_repeated"), (None, "key_null")], key=str)
    again = patients(spark, (1, "A", BORN), (7, "G", BORN))
    assert G.append_checked(again, root, "patients", on_violation="quarantine") == (1, 1)
    assert (1, "key_present") in put_aside(spark, root, "patients") and held(spark, root, "patients") == [1, 7]
    assert G.append_checked(again, root, "patients", present="skip") == (0, 0)
    stay = spark.read.parquet(f"{root}/patients").collect()
    assert all(r.created_at is not None for r in stay)          # the default of an absent column


def test_an_error_appends_nothing(spark):
    root = scratch_path(spark, "guarded")
    with pytest.raises(G.ConstraintViolation, match="2 rows of patients: full_name_not_null"):
        G.append_checked(patients(spark, (1, "A", BORN), (2, None, BORN), (3, None, BORN)), root, "patients")
    assert not path_exists(spark, f"{root}/patients")
    assert G.append_checked(patients(spark), root, "patients") == (0, 0) and held(spark, root, "patients") == []


def test_children_wait_for_their_parents(spark):
    root = scratch_path(spark, "guarded")
    G.append_checked(patients(spark, *[(i, "P", BORN) for i in range(0, 40, 2)]), root, "patients")
    rows = admissions(spark, *[(100 + i, i % 40, NOW) for i in range(400)], (900, None, NOW))
    assert G.append_checked(rows, root, "admissions", on_violation="quarantine") == (200, 201)
    assert {r for _, r in put_aside(spark, root, "admissions")} == {"fk_patient_id", "patient_id_not_null"}
    G.append_checked(patients(spark, *[(i, "P", BORN) for i in range(1, 40, 2)]), root, "patients")
    assert G.append_checked(rows, root, "admissions", on_violation="quarantine", present="skip") == (200, 1)
    assert held(spark, root, "admissions") == list(range(100, 500))


def test_every_rule_has_a_bit(spark):
    for table in RULES:
        names = G.reason_names(table)
        assert len(names) == len(set(names)) < 63
        masks = spark.range(len(names)).select(G.reasons(F.expr("shiftleft(1L, int(id))"), table).alias("r")).collect()
        assert sorted(r.r for r in masks) == sorted(names)


def test_a_load_may_be_repeated(spark):
    from clinrisk.plans import pipeline as P
    from small import SMALL
    out = scratch_path(spark, "loads")
    first = {n: df.count() for n, df in P.run_load(spark, SMALL, out).tables().items()}
    assert {n: df.count() for n, df in P.run_load(spark, SMALL, out).tables().items()} == first and first["patients"] > 0


# --- Stores over several runs -----------------------------------------------------------

SCORES = "score_id bigint, patient_id bigint, admission_id bigint, scored_at timestamp_ntz, ai_explanation string"
ANSWERS = "patient_id long, admission_id long, seq int, explanation string"


def explanations(store):
    return {(r.run, r.score_id): r.ai_explanation for r in store.current().collect()}


def test_compaction_changes_no_row_and_survives_a_failure(spark, monkeypatch):
    store = ScoreStore(spark, scratch_path(spark, "store"))
    store.add_run(spark.createDataFrame([(1, 7, 70, None, None), (2, 8, 80, None, "old")], SCORES))
    store.add_answers(spark.createDataFrame([(7, 70, 2, "second"), (8, 80, 1, "new")], ANSWERS))
    store.add_run(spark.createDataFrame([(3, 7, 70, None, None)], SCORES))
    before, reader = explanations(store), store.current()
    assert before == {(1, 1): "second", (1, 2): "new", (2, 3): None}
    create = spark.createDataFrame
    monkeypatch.setattr(type(spark), "createDataFrame", lambda *a, **b: 1 / 0)          # fails before the switch
    with pytest.raises(ZeroDivisionError):
        store.compact()
    monkeypatch.setattr(type(spark), "createDataFrame", lambda self, *a, **b: create(*a, **b))
    assert store.head() == 0 and explanations(store) == before
    assert store.compact() == 1 and explanations(store) == before
    assert store.answers().count() == 0 and store.next_score_id() == 4
    store.add_answers(create([(7, 70, 1, "late first"), (8, 80, 3, "third")], ANSWERS))
    assert explanations(store) == {(1, 1): "second", (1, 2): "third", (2, 3): "late first"}
    store.add_run(create([(4, 8, 80, None, None)], SCORES))
    after = explanations(store)
    assert store.compact() == 2 and explanations(store) == after and after[3, 4] is None
    assert {(r.run, r.score_id): r.ai_explanation for r in reader.collect()} == before          # an earlier reader keeps its version
    store.vacuum()
    assert explanations(store) == after


def test_alert_ids_go_on_and_lab_alerts_are_raised_once(spark):
    store = AlertStore(spark, scratch_path(spark, "alerts"))
    tiers = "score_id bigint, patient_id bigint, admission_id bigint, " + ", ".join(f"{r}_tier string, {r}_risk double" for r in ("readmission", "deterioration", "mortality"))

    def scores(*rows):
        return spark.createDataFrame([(*r, "High", 0.8, "Low", 0.1, "Low", 0.1) for r in rows], tiers)
    labs = spark.createDataFrame([(10, 1, True), (11, 1, True), (10, 1, False)], "admission_id bigint, patient_id bigint, is_abnormal boolean")
    store.add_run(scores((1, 1, 10)), labs.where("admission_id = 10"))
    store.add_run(scores((2, 1, 10), (3, 1, 11)), labs)
    rows = store.current().collect()
    assert sorted(r.alert_id for r in rows) == [1, 2, 3, 4, 5]
    assert sum(r.alert_type == "Abnormal Lab" for r in rows) == 2


def test_explaining_an_empty_store_says_so(spark, capsys):
    from clinrisk.plans import load as L, pipeline as P
    from small import SMALL
    star = L.stored_star(spark, SMALL)
    out = scratch_path(spark, "explain")
    for name, df in {**star.tables(), "base": star.base}.items():
        df.limit(5).write.parquet(f"{out}/{name}")
    ScoreStore(spark, f"{out}/scores").add_run(L.stored_rule_scores(spark, SMALL).limit(0))
    P.run_explain(spark, out)
    assert "no rows need an explanation" in capsys.readouterr().out


# --- SQL text --------------------------------------------------------------------------

def test_catalogs_do_not_disturb_each_other(spark):
    from clinrisk.plans import load as L, registry as R
    from small import SMALL
    star = L.stored_star(spark, SMALL)
    tables = R._checked_tables(star)
    whole = Catalog(tables)
    frame = whole.sql(feature_sql())
    few = Catalog({**tables, "admissions": tables["admissions"].where("admission_id < 10")})
    assert few.sql("SELECT * FROM v_patient_risk_summary WHERE admission_id IS NOT NULL").count() == 9
    assert frame.count() == L.stored_features(spark, SMALL).count()
    # Children are summed up before the join: no plan node multiplies them.
    assert "CartesianProduct" not in frame._jdf.queryExecution().toString()


def test_a_table_is_built_for_the_texts_that_name_it(spark):
    built = []
    def scores():
        built.append("scores")
        return spark.sql("SELECT 1L AS score_id, 1L AS patient_id, DATE '2002-01-01' AS scored_at")
    held = Catalog({"vitals": spark.sql("SELECT 1L AS vital_id, 1L AS patient_id, DATE '2002-01-01' AS recorded_at"), "risk_scores": scores})
    held.spark.sql("SELECT 7 AS score_id").createOrReplaceTempView("risk_scores")       # another's
    assert held.sql("SELECT * FROM V_Latest_Vitals").count() == 1 and not built
    assert held.sql("SELECT score_id FROM v_latest_risk").first().score_id == 1 and built == ["scores"]
    assert held.sql("SELECT score_id FROM risk_scores").first().score_id == 1 and built == ["scores"]


def test_the_sql_feature_frame_builds_no_scores(spark, monkeypatch):
    from clinrisk.plans import load as L, registry as R
    from small import SMALL
    for name in ("stored_rule_scores", "stored_alerts", "stored_features"):
        monkeypatch.setattr(L, name, lambda *a, name=name: pytest.fail(name))
    assert R.QUERIES["sql_feature_frame"](spark, SMALL).count() == 1470


def test_whole_rows_meet_the_key_bits_in_one_join(spark, monkeypatch):
    root, joined, frames = scratch_path(spark, "guarded"), [], type(spark.range(0))
    G.append_checked(patients(spark, (1, "A", BORN), (2, "B", BORN)), root, "patients")
    rows = admissions(spark, (1, 1, NOW), (2, 9, NOW), (3, 2, NOW), (3, 1, NOW), (None, 9, NOW))
    plain = frames.join
    monkeypatch.setattr(frames, "join", lambda self, *a, **k: joined.append("attending_doctor" in self.columns) or plain(self, *a, **k))
    assert G.append_checked(rows, root, "admissions", on_violation="quarantine") == (1, 4)
    assert sum(joined) == 1
    assert put_aside(spark, root, "admissions") == sorted([(2, "fk_patient_id"), (3, "key_repeated"), (3, "key_repeated"), (None, "fk_patient_id,key_null")], key=str)


def test_a_batch_of_new_keys_is_appended_without_a_join_of_whole_rows(spark, monkeypatch):
    frames = type(spark.range(0))
    path, joined, plain = scratch_path(spark, "table"), [], frames.join

    def rows(*keys):
        return spark.createDataFrame([(k, f"v{k}") for k in keys], "k bigint, v string")
    assert append_guarded(rows(1, 2), path, "k", on_conflict="skip") == 2
    monkeypatch.setattr(frames, "join", lambda self, *a, **k: joined.append("v" in self.columns) or plain(self, *a, **k))
    assert append_guarded(rows(3, 4), path, "k", on_conflict="skip") == 2 and not any(joined)
    assert append_guarded(rows(4, 5), path, "k", on_conflict="skip") == 1 and sum(joined) == 1
    assert append_guarded(rows(4, 5), path, "k", on_conflict="skip") == 0
    assert sorted(r.k for r in spark.read.parquet(path).collect()) == [1, 2, 3, 4, 5]


def test_an_append_leaves_no_scratch(spark, tmp_path):
    from clinrisk.session import _scratch_root, folders
    root = str(tmp_path / "guarded")
    before = folders(spark, _scratch_root(spark))
    G.append_checked(patients(spark, (1, "A", BORN), (2, None, BORN)), root, "patients", on_violation="quarantine")
    G.append_checked(admissions(spark, (1, 1, NOW), (2, 9, NOW)), root, "admissions", on_violation="quarantine")
    with pytest.raises(G.ConstraintViolation):
        G.append_checked(patients(spark, (3, None, BORN)), root, "patients")
    assert folders(spark, _scratch_root(spark)) == before
    assert held(spark, root, "patients") == [1] and put_aside(spark, root, "admissions") == [(2, "fk_patient_id")]


def test_what_lasts_stays_within_a_short_lived_block(spark):
    from clinrisk.session import lasting, short_lived
    with pytest.raises(KeyError), short_lived(spark):
        gone = scratch_path(spark, "gone")
        with lasting():
            stays = scratch_path(spark, "stays")
        with short_lived(spark):
            inner = scratch_path(spark, "inner")
            spark.range(1).write.parquet(inner)
        assert not path_exists(spark, inner)
        for path in (gone, stays):
            spark.range(1).write.parquet(path)
        raise KeyError
    assert not path_exists(spark, gone) and path_exists(spark, stays)


def test_a_filters_words_are_the_bits_of_its_keys(spark):
    f = K.KeyFilter(spark, scratch_path(spark, "filter"))
    keys = spark.range(100).withColumnRenamed("id", "k")
    f.add(keys)
    ((folder, blocks),) = f.layers()
    got = {r.block: [r[f"w{i}"] & (2**64 - 1) for i in range(K.WORDS)] for r in spark.read.parquet(f"{f.root}/{folder}").collect()}
    want = {}
    for r in keys.select(F.pmod(F.xxhash64("k"), F.lit(blocks)).alias("block"), F.xxhash64(F.lit(1), "k").alias("h")).collect():
        words = want.setdefault(r.block, [0] * K.WORDS)
        for j in range(K.HASHES):
            place = ((r.h & (2**64 - 1)) >> 9 * j) & 511
            words[place >> 6] |= 1 << (place & 63)
    assert got == want
