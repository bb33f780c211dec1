"""Query registry: one callable ``(spark, sf_dir) -> DataFrame`` per checked key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clinrisk.operators.star import Star
from clinrisk.plans.load import stored_star
from clinrisk.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(stored_star(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return wrap


@query("encounters")
def q_encounters(s: Star) -> DataFrame:
    return s.encounters


@query("patients_dim")
def q_patients(s: Star) -> DataFrame:
    return s.patients


@query("admissions_fact")
def q_admissions(s: Star) -> DataFrame:
    return s.admissions


@query("diagnoses_fact")
def q_diagnoses(s: Star) -> DataFrame:
    return s.diagnoses


@query("medications_fact")
def q_medications(s: Star) -> DataFrame:
    return s.medications


@query("vitals_fact")
def q_vitals(s: Star) -> DataFrame:
    return s.vitals


@query("labs_fact")
def q_labs(s: Star) -> DataFrame:
    return s.labs


# --- F: feature query -------------------------------------------------------
from clinrisk.operators import features as FT  # noqa: E402


@query("feature_frame")
def q_feature_frame(s: Star) -> DataFrame:
    """Flagship: one row per discharged admission (and distinct vitals reading)."""
    return FT.feature_frame(s)


@query("feature_table")
def q_feature_table(s: Star) -> DataFrame:
    """The feature frame as written by the scoring stage (read back)."""
    return L.stored_features(s.spark, s.sf_dir).select(*FEATURE_OUT)


@query("readmitted_30d")
def q_readmitted(s: Star) -> DataFrame:
    return FT.readmission_flags(s.admissions)


@query("lab_pivot")
def q_lab_pivot(s: Star) -> DataFrame:
    return FT.lab_pivot(s)


@query("distinct_counts")
def q_distinct_counts(s: Star) -> DataFrame:
    return FT.distinct_counts(s)


@query("age_years")
def q_age_years(s: Star) -> DataFrame:
    return FT.patient_ages(s)


@query("length_of_stay")
def q_length_of_stay(s: Star) -> DataFrame:
    return FT.lengths_of_stay(s)


@query("abnormal_lab_count")
def q_abnormal_lab_count(s: Star) -> DataFrame:
    return FT.abnormal_lab_counts(s)


# --- A: sources and sinks -----------------------------------------------------
from pyspark.sql import functions as F  # noqa: E402

from clinrisk import config as C  # noqa: E402
from clinrisk import fixtures as FX  # noqa: E402
from clinrisk.operators import evaluate as EV  # noqa: E402
from clinrisk.operators import explain as EX  # noqa: E402
from clinrisk.operators import model as M  # noqa: E402
from clinrisk.operators import prefix as P  # noqa: E402
from clinrisk.operators import prepare as PR  # noqa: E402
from clinrisk.operators import quality as Q  # noqa: E402
from clinrisk.operators import views as V  # noqa: E402
from clinrisk.operators.scoring import RISKS, rule_probabilities, rule_scores  # noqa: E402
from clinrisk.plans import load as L  # noqa: E402

FEATURE_OUT = ["patient_id", "age", "gender", "blood_type", "admission_id", "department", "admission_type",
               "discharge_status", "los_days", *FT.VITAL_MEASURES, "diagnosis_count", "medication_count",
               *[c for _, c in FT.LAB_PIVOT], "abnormal_labs", "readmitted_30d", "deteriorated", "mortality"]


def _features(s: Star) -> DataFrame:
    return L.stored_features(s.spark, s.sf_dir)


def _split(s: Star) -> DataFrame:
    return L.stored_split(s.spark, s.sf_dir)


def _scores(s: Star) -> DataFrame:
    return L.stored_rule_scores(s.spark, s.sf_dir)


@query("load_audit")
def q_load_audit(s: Star) -> DataFrame:
    return L.load_audit(s)


# --- D: generated columns, constraints, alerts -----------------------------------

@query("bmi")
def q_bmi(s: Star) -> DataFrame:
    return s.vitals.select("vital_id", "weight_kg", "height_cm", "bmi")


@query("lab_abnormal")
def q_lab_abnormal(s: Star) -> DataFrame:
    return s.labs.select("lab_id", "test_value", "reference_min", "reference_max", "is_abnormal")


def _checked_tables(s: Star) -> dict[str, DataFrame]:
    return {**s.tables(), "risk_scores": _scores(s), "alerts": L.stored_alerts(s.spark, s.sf_dir)}


@query("dq_checks")
def q_dq_checks(s: Star) -> DataFrame:
    return Q.rule_violations(_checked_tables(s))


@query("dq_pk")
def q_dq_pk(s: Star) -> DataFrame:
    return Q.duplicate_keys(_checked_tables(s))


@query("dq_fk_orphans")
def q_dq_fk(s: Star) -> DataFrame:
    return Q.orphan_rows(_checked_tables(s))


@query("alerts")
def q_alerts(s: Star) -> DataFrame:
    return L.stored_alerts(s.spark, s.sf_dir)


# --- E: views ----------------------------------------------------------------------

@query("latest_vitals")
def q_latest_vitals(s: Star) -> DataFrame:
    return V.latest_vitals(s.vitals)


@query("latest_risk")
def q_latest_risk(s: Star) -> DataFrame:
    return V.latest_risk(_scores(s))


@query("patient_risk_summary")
def q_patient_risk_summary(s: Star) -> DataFrame:
    return V.patient_risk_summary(s.patients, s.admissions, s.vitals, _scores(s))


# --- G/H: preparation, evaluation, models ---------------------------------------------

@query("label_encode")
def q_label_encode(s: Star) -> DataFrame:
    return PR.label_encode(_features(s)).select("feature_row_id", "admission_id", *C.CATEGORICAL_FEATURES)


@query("label_mapping")
def q_label_mapping(s: Star) -> DataFrame:
    """The stored codes of every category, 'Unknown' for NULL."""
    return PR.label_mapping(_features(s))


@query("derived_features")
def q_derived_features(s: Star) -> DataFrame:
    return PR.derived_features(PR.label_encode(_features(s))).select(
        "feature_row_id", "admission_id", *C.FEATURE_COLUMNS)


@query("stratified_split")
def q_stratified_split(s: Star) -> DataFrame:
    return _split(s)


@query("impute_median")
def q_impute_median(s: Star) -> DataFrame:
    return PR.medians(PR.model_frame(_features(s)), _split(s))


@query("class_weights")
def q_class_weights(s: Star) -> DataFrame:
    return PR.class_weights(_split(s))


def _rule_eval_rows(s: Star) -> DataFrame:
    """(target, label, score, prediction) of the unrounded rule scores on every target's held-out rows."""
    feats = _features(s)
    probs = rule_probabilities(feats)
    long = probs.select("feature_row_id", F.explode(F.array(*[
        F.struct(F.lit(n).alias("target"), F.col(f"p_{n}").alias("score")) for n in C.TARGETS])).alias("x"))
    rows = long.select("feature_row_id", "x.target", "x.score").where("score IS NOT NULL")
    rows = rows.join(_split(s).where("is_test"), ["feature_row_id", "target"])
    return rows.select("target", "label", "score", (F.col("score") > 0.5).cast("bigint").alias("prediction"))


@query("roc_auc")
def q_roc_auc(s: Star) -> DataFrame:
    return EV.roc_auc(_rule_eval_rows(s))


@query("classification_report")
def q_classification_report(s: Star) -> DataFrame:
    """A target with one class over all rows is not evaluated (its model is a constant)."""
    real = M.degenerate_targets(_features(s)).where("NOT is_degenerate").select("target")
    return EV.classification_report(_rule_eval_rows(s).join(F.broadcast(real), "target", "left_semi"))     # three targets


@query("risk_tiers")
def q_risk_tiers(s: Star) -> DataFrame:
    return _scores(s).select("score_id", "admission_id", "readmission_risk", "deterioration_risk",
                             "mortality_risk", "readmission_tier", "deterioration_tier", "mortality_tier")


@query("degenerate_target")
def q_degenerate(s: Star) -> DataFrame:
    return M.degenerate_targets(_features(s))


def _models(s: Star):
    return L.fitted_models(s.spark, s.sf_dir, C.FULL_NUM_TREES)


def _model_frame(s: Star) -> DataFrame:
    return PR.model_frame(_features(s), _models(s).mapping)


@query("risk_model")
def q_risk_model(s: Star) -> DataFrame:
    """H4-H8: the forests on their held-out rows: classes and AUC (no SQL: forests differ between engines)."""
    return M.evaluation(_models(s), _model_frame(s))[0]


@query("risk_model_rows")
def q_risk_model_rows(s: Star) -> DataFrame:
    """The part of ``risk_model`` that does not depend on the trees."""
    auc, _ = M.evaluation(_models(s), _model_frame(s))
    return auc.select("target", "n_pos", "n_neg", F.col("auc").isNull().alias("one_class"))


@query("risk_scores")
def q_risk_scores(s: Star) -> DataFrame:
    """The forests' score rows, whole (no SQL: forests differ between engines)."""
    return M.risk_scores(_models(s), _model_frame(s))


@query("risk_score_rows")
def q_risk_score_rows(s: Star) -> DataFrame:
    """The part of ``risk_scores`` that does not depend on the trees: ids, version, the constant target."""
    return M.risk_scores(_models(s), _model_frame(s)).select(
        "score_id", "patient_id", "admission_id", "scored_at", "model_version", "mortality_risk", "mortality_tier", "ai_explanation")


@query("top_features")
def q_top_features(s: Star) -> DataFrame:
    """Per score row, each target's five largest contributions (no SQL: forests differ between engines)."""
    return M.top_features(_models(s), _model_frame(s))


# --- I: explanation queue ------------------------------------------------------------

def _pending(s: Star) -> DataFrame:
    return EX.pending(_scores(s), s.patients, s.admissions, s.vitals, s.diagnoses)


@query("explain_queue")
def q_explain_queue(s: Star) -> DataFrame:
    return EX.next_batch(_pending(s))


@query("explain_prompts")
def q_explain_prompts(s: Star) -> DataFrame:
    return EX.prompts(_pending(s))


def _merged(s: Star) -> DataFrame:
    prompt_rows = EX.prompts(_pending(s))
    return EX.merge_explanations(_scores(s), FX.simulated_responses(prompt_rows))


@query("merge_explanations")
def q_merge(s: Star) -> DataFrame:
    return _merged(s)


@query("merge_audit")
def q_merge_audit(s: Star) -> DataFrame:
    return EX.merge_audit(EX.prompts(_pending(s)))


@query("explained_sample")
def q_explained_sample(s: Star) -> DataFrame:
    return EX.explained_sample(_merged(s))


# --- The score store over several runs ---------------------------------------------
from clinrisk.session import scratch_path  # noqa: E402
from clinrisk.sources import csv_ingest as CSV  # noqa: E402
from clinrisk.sources.sinks import ScoreStore, append_guarded, with_defaults  # noqa: E402
from clinrisk.streaming import explanations as STREAM  # noqa: E402


def _store(s: Star) -> ScoreStore:
    store = ScoreStore(s.spark, scratch_path(s.spark, "score-store"))
    store.add_run(_scores(s))
    return store


@query("score_runs")
def q_score_runs(s: Star) -> DataFrame:
    """Two scoring runs, 30 days apart; ids go on, and the later run is the latest."""
    store = _store(s)
    later = F.lit(C.AS_OF.isoformat() + " 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(days=F.lit(30))
    store.add_run(rule_scores(_features(s), scored_at=later, first_id=store.next_score_id()))
    rows = store.current()
    newest = V.latest_risk(rows).select("score_id", F.lit(True).alias("is_latest"))
    return (rows.join(newest, "score_id", "left")
            .select("score_id", "patient_id", "admission_id", "scored_at", F.col("run").cast("bigint").alias("run"),
                    F.coalesce("is_latest", F.lit(False)).alias("is_latest")))


@query("explain_second_run")
def q_explain_second(s: Star) -> DataFrame:
    """After answers for the even scores, the next queue holds the rest only."""
    store = _store(s)
    store.add_answers(FX.simulated_responses(EX.prompts(_pending(s)).where("score_id % 2 = 0")))
    rest = EX.pending(store.current(), s.patients, s.admissions, s.vitals, s.diagnoses)
    return rest.select("score_id", "patient_id", "admission_id", "diagnosis_name")


@query("merge_out_of_order")
def q_merge_out_of_order(s: Star) -> DataFrame:
    """Revisions (sequence 2) arrive before the first answers; the highest sequence stays."""
    store = _store(s)
    answers = FX.simulated_responses(EX.prompts(_pending(s)))
    store.add_answers(answers.where("seq = 2"))
    store.add_answers(answers.where("seq = 1"))
    return store.current().drop("run")


@query("merge_explanations_stream")
def q_merge_stream(s: Star) -> DataFrame:
    """I6 as a Structured Streaming job: answers arrive as files; each
    micro-batch is a small answer batch of the score store."""
    return STREAM.run_merge_stream(_scores(s), FX.simulated_responses(EX.prompts(_pending(s))))


# --- A: CSV ingest, guarded appends, defaults ------------------------------------------

@query("csv_ingest")
def q_csv_ingest(s: Star) -> DataFrame:
    """Encounters exported as a raw CSV (padded headers) and ingested back."""
    path = scratch_path(s.spark, "encounters-csv")
    CSV.write_raw_csv(s.encounters, path)
    return CSV.read_raw_csv(s.spark, path)


@query("csv_ingest_raw")
def q_csv_ingest_raw(s: Star) -> DataFrame:
    """The original's header, without an id: ids are row positions over the files."""
    path = scratch_path(s.spark, "encounters-csv")
    CSV.write_raw_csv(s.encounters, path, with_id=False)
    return CSV.read_raw_csv(s.spark, path)


@query("append_guarded")
def q_append_guarded(s: Star) -> DataFrame:
    """Load patients into a table, then re-run the same load: the guarded
    append skips every already-stored key, so the table is unchanged."""
    path = scratch_path(s.spark, "patients-table")
    append_guarded(s.patients, path, "patient_id", table="patients")
    append_guarded(s.patients, path, "patient_id", on_conflict="skip", table="patients")
    return s.spark.read.parquet(path)


@query("append_guarded_all")
def q_append_guarded_all(s: Star) -> DataFrame:
    """A3: the seven tables that the original fills, each loaded twice: rows and distinct keys."""
    parts = []
    for name, df in {**s.tables(), "risk_scores": _scores(s)}.items():
        key, path = Q.PRIMARY_KEYS[name], scratch_path(s.spark, f"table-{name}")
        append_guarded(df.where(F.pmod(key, F.lit(3)) == 0), path, key, table=name)
        append_guarded(df, path, key, on_conflict="skip", table=name)
        stored = s.spark.read.parquet(path)
        parts.append(stored.agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct(key).alias("n_keys"))
                     .select(F.lit(name).alias("table_name"), "row_count", "n_keys"))
    return Q._union(parts)


@query("defaults_applied")
def q_defaults(s: Star) -> DataFrame:
    """NULLs in default columns are filled at the write; other values stay."""
    odd = F.col("vital_id") % 3 == 0
    holes = s.vitals.select("vital_id", "patient_id", F.when(~odd, F.col("recorded_at")).alias("recorded_at"))
    return with_defaults(holes, "vitals")


# --- Tables with several children and with damage -----------------------------------------

@query("feature_frame_fanout")
def q_feature_frame_fanout(s: Star) -> DataFrame:
    """0 to 7 diagnoses and medications per admission, several vitals readings, some equal."""
    return FT.feature_frame(FX.FannedStar(s))


@query("distinct_counts_direct")
def q_distinct_counts_direct(s: Star) -> DataFrame:
    """F7 with repeated ids among the children."""
    return FT.distinct_counts_direct(FX.RepeatedStar(s))


def _damaged_tables(s: Star) -> dict[str, DataFrame]:
    return FX.damaged(_checked_tables(s), Q.PRIMARY_KEYS)


@query("dq_checks_dirty")
def q_dq_checks_dirty(s: Star) -> DataFrame:
    return Q.rule_violations(_damaged_tables(s))


@query("dq_pk_dirty")
def q_dq_pk_dirty(s: Star) -> DataFrame:
    return Q.duplicate_keys(_damaged_tables(s))


@query("dq_fk_dirty")
def q_dq_fk_dirty(s: Star) -> DataFrame:
    return Q.orphan_rows(_damaged_tables(s))


# --- Constraints at the write ----------------------------------------------------------
from clinrisk.sources import guards as G  # noqa: E402


def _guarded_load(s: Star) -> str:
    """The damaged tables appended in the order of their keys, refused rows put aside; the folder."""
    def build() -> str:
        root = scratch_path(s.spark, "guarded")
        for name, df in _damaged_tables(s).items():
            G.append_checked(df, root, name, on_violation="quarantine")
        return root
    return L.memo("guarded", s.spark, s.sf_dir, build)


@query("append_checked")
def q_append_checked(s: Star) -> DataFrame:
    """D3-D8 at the write: the rows of every table that its constraints admit."""
    root = _guarded_load(s)
    return Q._union([s.spark.read.parquet(f"{root}/{t}").select(F.lit(t).alias("table_name"), F.col(k).alias("key_value"))
                     for t, k in Q.PRIMARY_KEYS.items()])


@query("append_rejects")
def q_append_rejects(s: Star) -> DataFrame:
    """D3-D8 at the write: every refused row with all of its reasons."""
    root = _guarded_load(s)
    return Q._union([G.rejected_rows(s.spark, root, t).select(F.lit(t).alias("table_name"), F.col(k).alias("key_value"), "reasons")
                     for t, k in Q.PRIMARY_KEYS.items()])


@query("append_fk")
def q_append_fk(s: Star) -> DataFrame:
    """Admissions before half of their patients are there, and again after; which load took each."""
    root = scratch_path(s.spark, "guarded-fk")
    odd = F.col("patient_id") % 2 == 1
    G.append_checked(s.patients.where(~odd), root, "patients")
    taken = []
    for load in (1, 2):
        G.append_checked(s.admissions, root, "admissions", on_violation="quarantine", present="skip")
        held = s.spark.read.parquet(f"{root}/admissions").select("admission_id", "patient_id")
        before = taken[0] if taken else held.limit(0)
        taken.append(held.join(before.select("admission_id"), "admission_id", "left_anti").withColumn("load", F.lit(load).cast("bigint")))
        if load == 1:
            taken[0] = P.stored(taken[0], "first-load")
            G.append_checked(s.patients, root, "patients", present="skip")
    return taken[0].union(taken[1])


# --- SQL text over the schema -------------------------------------------------------------
from clinrisk.plans.catalog import Catalog, feature_sql  # noqa: E402


def _catalog(s: Star) -> Catalog:
    """All eight tables; the two of the scoring stage are built for the texts that read them."""
    return Catalog({**s.tables(), "risk_scores": lambda: _scores(s), "alerts": lambda: L.stored_alerts(s.spark, s.sf_dir)})


@query("sql_feature_frame")
def q_sql_feature_frame(s: Star) -> DataFrame:
    """A4/F: the feature frame from SQL text over the named tables."""
    return _catalog(s).sql(feature_sql())


@query("sql_latest_vitals")
def q_sql_latest_vitals(s: Star) -> DataFrame:
    return _catalog(s).sql("SELECT * FROM v_latest_vitals")


@query("sql_latest_risk")
def q_sql_latest_risk(s: Star) -> DataFrame:
    return _catalog(s).sql("SELECT * FROM v_latest_risk")


@query("sql_patient_risk_summary")
def q_sql_summary(s: Star) -> DataFrame:
    return _catalog(s).sql("SELECT * FROM v_patient_risk_summary")


# --- Several runs: alerts, compaction, failed prompts ------------------------------------------
from clinrisk.sources.sinks import AlertStore  # noqa: E402


@query("alerts_two_runs")
def q_alerts_two_runs(s: Star) -> DataFrame:
    """D9 over two scoring runs, the first with the lab results of even admissions only: ids are keys over
    both, and an admission's lab results raise one alert."""
    store = AlertStore(s.spark, scratch_path(s.spark, "alert-store"))
    store.add_run(_scores(s), s.labs.where("admission_id % 2 = 0"))
    first = store.runs.next_id()
    store.add_run(rule_scores(_features(s), first_id=L.stored_features(s.spark, s.sf_dir).count() + 1), s.labs)
    return store.current().withColumn("is_second", F.col("alert_id") >= first)


@query("score_compaction")
def q_score_compaction(s: Star) -> DataFrame:
    """A5: first answers are folded into a new version of the runs, then revisions arrive."""
    store = _store(s)
    answers = FX.simulated_responses(EX.prompts(_pending(s)))
    store.add_answers(answers.where("seq = 1"))
    store.compact()
    store.add_answers(answers.where("seq = 2"))
    return store.current().drop("run")


@query("merge_audit_failed")
def q_merge_audit_failed(s: Star) -> DataFrame:
    """I7 where the birth date of every fifth patient is unknown: their prompts fail."""
    known = s.patients.withColumn("date_of_birth", F.when(F.col("patient_id") % 5 != 0, F.col("date_of_birth")))
    return EX.merge_audit(EX.prompts(EX.pending(_scores(s), known, s.admissions, s.vitals, s.diagnoses)))


@query("label_encode_wide")
def q_label_encode_wide(s: Star) -> DataFrame:
    """G2 over a column with about as many values as rows: the admissions' notes."""
    rows = s.admissions.select("admission_id", "notes")
    return PR.encode_by_join(rows, "notes", P.stored(PR.code_table(rows, "notes"), "note-codes"))
