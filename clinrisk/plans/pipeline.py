"""The three batch stages as one program: load, score, explain.

    python -m clinrisk load    --sf-dir DIR [--csv PATH] --out OUT
    python -m clinrisk score   --out OUT [--trees 200] [--as-of 2002-01-31]
    python -m clinrisk explain --out OUT [--responses PATH]

Each stage reads what the previous one wrote under ``OUT`` (default: a folder
under ``spark.checkpoint.dir``).  Scoring appends a run to the score store,
with ids and a time of its own; explaining adds answers to it.  Both can be
repeated, and the next run sees what the last one left.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from clinrisk import config as C
from clinrisk.operators import explain as EX
from clinrisk.operators import model as M
from clinrisk.operators import prepare as PR
from clinrisk.operators.features import feature_frame
from clinrisk.operators.ids import dense_ids
from clinrisk.operators.scoring import feature_row_order
from clinrisk.operators.star import as_of_ts
from clinrisk.plans.load import StoredStar, load_audit, load_star
from clinrisk.session import build_session, remove_scratch, shared_dir
from clinrisk.sources.csv_ingest import read_raw_csv
from clinrisk.sources.guards import append_checked
from clinrisk.sources.sinks import AlertStore, ScoreStore, append_guarded


def run_load(spark: SparkSession, sf_dir: str, out: str, csv: str | None = None) -> StoredStar:
    """Stage 1: encounters (driver tables, or a raw CSV) -> star schema, built
    in the scratch folder and appended to ``out`` under every table's
    constraints.  Rows whose key is there already are left out, so a second load of the same
    encounters adds nothing; rows that a constraint refuses are put aside."""
    built = load_star(spark, sf_dir, enc=read_raw_csv(spark, csv) if csv else None)
    append_guarded(built.base, f"{out}/base", "admission_id", "skip")
    for name, df in built.tables().items():
        added, refused = append_checked(df, out, name, on_violation="quarantine", present="skip")
        print(f"  {name}: {added} rows added, {refused} refused")
    star = _stored(spark, out)
    for r in load_audit(star).collect():
        print(f"  {r.table_name}: {r.row_count} rows")
    return star


def _stored(spark: SparkSession, out: str) -> StoredStar:
    r = spark.read.parquet
    tables = {"patients": r(f"{out}/patients"), "base": r(f"{out}/base"), "admissions": r(f"{out}/admissions"),
              "diagnoses": r(f"{out}/diagnoses"), "vitals": r(f"{out}/vitals"),
              "lab_results": r(f"{out}/lab_results"), "medications": r(f"{out}/medications")}
    return StoredStar(spark, out, out, tables)


def run_score(spark: SparkSession, out: str, trees: int = C.FULL_NUM_TREES, as_of: dt.date | None = None,
              max_train_rows: int | None = None) -> int:
    """Stage 2: feature frame -> three forests -> evaluation -> a new run of
    the score store (with each row's top features) and its alerts."""
    with C.run_as_of(as_of):
        return _score(spark, out, trees, max_train_rows)


def _score(spark: SparkSession, out: str, trees: int, max_train_rows: int | None) -> int:
    star, store = _stored(spark, out), ScoreStore(spark, f"{out}/scores")
    first = store.next_score_id()
    run = max(store.runs(), default=0) + 1
    place = f"{out}/features/run={run}"
    dense_ids(feature_frame(star, keep_extra=True), feature_row_order(), "feature_row_id").write.mode("overwrite").parquet(place)
    feats = spark.read.parquet(place)
    print(f"  {feats.count()} feature rows")
    rm = M.fit(feats, num_trees=trees, max_train_rows=max_train_rows)
    rm.mapping.write.mode("overwrite").parquet(f"{out}/label_mapping/run={run}")
    frame = PR.model_frame(feats, rm.mapping)
    auc, report = M.evaluation(rm, frame)
    for r in auc.collect():
        print(f"  {r.target}: AUC {'N/A' if r.auc is None else round(r.auc, 4)} "
              f"(positives {r.n_pos}, negatives {r.n_neg})")
    report.orderBy("target", "label").show(truncate=False)
    now = as_of_ts()
    scores = M.risk_scores(rm, frame, scored_at=now, first_id=first, keep_row=True)
    store.add_run(M.with_top_features(scores, M.top_features(rm, frame)).drop("feature_row_id"))
    mine = store.current().where(F.col("run") == run).drop("run")
    AlertStore(spark, f"{out}/alerts").add_run(mine, star.labs, now)
    print(f"  run {run}: wrote {mine.count()} risk scores; {json.loads(M.describe(rm))['trained']}")
    return run


def run_explain(spark: SparkSession, out: str, responses: str | None = None) -> None:
    """Stage 3: queue + prompts of the rows without an explanation; returned
    text is added to the score store."""
    star, store = _stored(spark, out), ScoreStore(spark, f"{out}/scores")
    if responses:
        store.add_answers(spark.read.parquet(responses))
        print("  answers added")
        EX.explained_sample(store.current()).show(truncate=80)
    pending = EX.pending(store.current(), star.patients, star.admissions, star.vitals, star.diagnoses)
    if pending.isEmpty():
        print("  no rows need an explanation")
        return
    target = f"{out}/prompts"
    EX.prompts(pending).write.mode("overwrite").parquet(target)
    for r in EX.merge_audit(spark.read.parquet(target)).collect():
        print(f"  prompts {r.status}: {r.n}")
    EX.next_batch(pending).show(truncate=False)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="clinrisk")
    ap.add_argument("stage", choices=["load", "score", "explain"])
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    ap.add_argument("--csv")
    ap.add_argument("--out")
    ap.add_argument("--trees", type=int, default=C.FULL_NUM_TREES)
    ap.add_argument("--responses")
    ap.add_argument("--as-of", type=dt.date.fromisoformat)
    ap.add_argument("--max-train-rows", type=int)
    ap.add_argument("--master")
    a = ap.parse_args(argv)
    spark = build_session(a.master)
    out = a.out or f"{shared_dir(spark)}/clinrisk-pipeline"
    print(f"{a.stage}: {out}")
    with C.run_as_of(a.as_of):
        if a.stage == "load":
            run_load(spark, a.sf_dir, out, a.csv)
        elif a.stage == "score":
            run_score(spark, out, a.trees, a.as_of, a.max_train_rows)
        else:
            run_explain(spark, out, a.responses)
    remove_scratch(spark)
    spark.stop()


__all__ = ["run_load", "run_score", "run_explain", "main"]
