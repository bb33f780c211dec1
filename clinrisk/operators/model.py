"""Risk models: class-balanced random forests.

Per target: an exact stratified 80/20 split, median imputation fitted on the
target's training rows, balanced class weights, a forest (``numTrees``, depth
10, sqrt feature subsets, bootstrap, seed 42), evaluation on the held-out rows,
then every row -- training rows included -- is scored.  A target whose
training rows have a single class gets a constant 0 model (the original's
fallback also yields probability 0 for the only class).  Training (``grow``) and scoring
are distributed; only the medians, the label codes, the class
weights and the fitted trees live on the driver.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinrisk import config as C
from clinrisk.operators import evaluate as EV
from clinrisk.operators import prepare as PR
from clinrisk.operators.forest import Forest
from clinrisk.operators.grow import grow
from clinrisk.operators.prefix import stored
from clinrisk.operators.scoring import RISKS, score_table
from clinrisk.session import remove_path, scratch_path, ship


#: Rows of a fit's partition at most, and below which a further one does not pay.
FIT_ROWS, SMALL_ROWS = 500_000, 20_000


@dataclass
class RiskModels:
    """Per target: its features, medians and fitted forest (None: constant 0);
    the stored split and label codes that a later batch uses again."""
    features: dict[str, list[str]]
    medians: dict[str, dict[str, float | None]]
    models: dict[str, Forest | None]
    split: DataFrame
    mapping: DataFrame


def fit(features: DataFrame, num_trees: int = C.FULL_NUM_TREES, max_depth: int = C.MAX_DEPTH,
        seed: int = C.SEED, max_train_rows: int | None = None, split: DataFrame | None = None) -> RiskModels:
    """Train one forest per target on the feature table.  ``max_train_rows``
    bounds the rows of one fit by a seeded sample (default: all rows);
    ``split``: the stored split, if there is one."""
    mapping = stored(PR.label_mapping(features), "label-mapping")
    frame = PR.model_frame(features, mapping)
    split = stored(PR.stratified_split(frame), "split") if split is None else split
    med: dict[str, dict[str, float | None]] = {n: {} for n in C.TARGETS}
    for r in PR.medians(frame, split).collect():
        med[r["target"]][r["feature"]] = r["median"]
    weights = {(r["target"], r["label"]): (r["weight"], r["n"]) for r in PR.class_weights(split).collect()}
    cols = {n: [c for c in C.FEATURE_COLUMNS if med[n].get(c) is not None] for n in C.TARGETS}

    # The label codes and derived columns are worked out once.  The targets' fits run side by side while the rows are
    # few; each holds its rows with a count for every tree, so larger ones follow one another.
    frame = stored(frame, "model-frame")
    spark = frame.sparkSession
    most = max([weights[n, 0][1] + weights[n, 1][1] for n in C.TARGETS if {(n, 0), (n, 1)} <= set(weights)], default=0)

    def fit_one(name: str) -> Forest | None:
        label = C.TARGETS[name]
        if not {(name, 0), (name, 1)} <= set(weights):
            return None
        rows = PR.impute(PR.training_rows(frame, split, name), med[name])
        n = weights[name, 0][1] + weights[name, 1][1]
        if max_train_rows and n > max_train_rows:
            rows = rows.sample(max_train_rows / n, seed=seed)
        # A fit reads its rows twice (split candidates, bins): they are joined and imputed once.
        held = rows.select("feature_row_id", F.col(label).cast("int").alias(label), *cols[name])
        path = scratch_path(spark, "fit-rows")
        held.repartition(_whole_rounds(_fit_partitions(n, spark), spark), "feature_row_id").write.parquet(path)
        forest = grow(spark.read.parquet(path), cols[name], label, (weights[name, 0][0], weights[name, 1][0]), num_trees, max_depth, seed)
        remove_path(spark, path)
        return forest
    with ThreadPoolExecutor(len(C.TARGETS) if most <= FIT_ROWS else 1) as pool:
        models = dict(zip(C.TARGETS, pool.map(fit_one, C.TARGETS)))
    return RiskModels(cols, med, models, split, mapping)


def _fit_partitions(rows: int, spark: SparkSession) -> int:
    """Partitions of a fit's rows: the cores while they have work, and more only past ``FIT_ROWS`` rows each."""
    return max(min(spark.sparkContext.defaultParallelism, -(-rows // SMALL_ROWS)), -(-rows // FIT_ROWS), 1)


def _whole_rounds(partitions: int, spark: SparkSession) -> int:
    """So many partitions, or as many more as keep every core at work in the last round of tasks too: a fit waits for
    the last task of every level."""
    cores = spark.sparkContext.defaultParallelism
    return partitions if partitions <= cores else -(-partitions // cores) * cores


def probabilities(rm: RiskModels, frame: DataFrame) -> DataFrame:
    """H6/H9: positive-class probability of every target for every row; 0 without a model or where a fit saw no
    positive row.  Each target fills missing values with its own medians."""
    spark, out = frame.sparkSession, {}
    for name, forest in forests(rm).items():
        cols, med = rm.features[name], rm.medians[name]
        filled = [F.coalesce(F.col(c).cast("double"), F.lit(float(med[c]))) for c in cols]
        out[f"p_{name}"] = F.lit(0.0) if forest is None else _scorer(spark, forest, len(cols))(F.array(*filled))
    return frame.withColumns(out)


def _scorer(spark: SparkSession, forest: Forest, width: int):
    """A column function: the forest's probability of a row of features."""
    ship(spark)
    sent = spark.sparkContext.broadcast(forest)

    def score(rows: pa.Array) -> pa.Array:
        return pa.array(sent.value.probability(rows.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)))
    return F.arrow_udf(score, "double")


def risk_scores(rm: RiskModels, frame: DataFrame, **run) -> DataFrame:
    """The score table written by the scoring stage."""
    return score_table(probabilities(rm, frame), C.MODEL_VERSION, **run)


def evaluation_rows(rm: RiskModels, frame: DataFrame) -> DataFrame:
    """(target, label, score, prediction) of every target's held-out rows.  The
    score is the raw probability; a tie goes to class 0, the first of equals."""
    held = rm.split.where("is_test")
    probs = probabilities(rm, frame.join(held.select("feature_row_id").distinct(), "feature_row_id", "left_semi"))
    long = probs.select("feature_row_id", F.explode(F.array(*[
        F.struct(F.lit(n).alias("target"), F.col(f"p_{n}").alias("score")) for n in C.TARGETS])).alias("x"))
    rows = long.select("feature_row_id", "x.target", "x.score").join(held, ["feature_row_id", "target"])
    return rows.select("target", "label", "score", (F.col("score") > 0.5).cast("bigint").alias("prediction"))


def evaluation(rm: RiskModels, frame: DataFrame) -> tuple[DataFrame, DataFrame]:
    """AUC and classification report on the held-out rows; a target without a
    model has no report."""
    rows = stored(evaluation_rows(rm, frame), "evaluation")
    trained = [n for n, m in rm.models.items() if m is not None]
    return EV.roc_auc(rows), EV.classification_report(rows.where(F.col("target").isin(trained)))


def degenerate_targets(frame: DataFrame) -> DataFrame:
    """H5: which targets have a single class (constant-0 model)."""
    per = frame.select(*[F.count_distinct(col).alias(name) for name, col in C.TARGETS.items()],
                       F.count(F.lit(1)).alias("n_rows"))
    stack = ", ".join(f"'{n}', `{n}`" for n in C.TARGETS)
    out = per.selectExpr("n_rows", f"stack(3, {stack}) AS (target, n_classes)")
    return out.select("target", F.col("n_rows").cast("bigint"), F.col("n_classes").cast("bigint"),
                      (F.col("n_classes") < 2).alias("is_degenerate"),
                      F.when(F.col("n_classes") < 2, F.lit(0.0)).alias("constant_risk"))


def forests(rm: RiskModels) -> dict[str, Forest | None]:
    """The targets' fitted trees; None where the model is a constant."""
    return {n: m if m is not None and m.value[m.roots].any() else None for n, m in rm.models.items()}


def top_features(rm: RiskModels, frame: DataFrame, k: int = 5, exact: bool = False) -> DataFrame:
    """H12 (ours): (feature_row_id, admission_id, top_features): a JSON object with a list per target, the ``k``
    features that add or take most (ties by name), each with its contribution to the row's probability.

    One pass over the rows: each batch is imputed with the targets' medians and
    walks down their trees (``forest.attributions``; ``exact``: Shapley values)."""
    sent = frame.sparkSession.sparkContext.broadcast({n: (f, rm.features[n], [float(rm.medians[n][c]) for c in rm.features[n]])
                                                      for n, f in forests(rm).items() if f is not None})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = sent.value
        for batch in batches:
            lists: dict[str, list] = {}
            for name, (forest, cols, medians) in held.items():
                x = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in cols]) if batch.num_rows else np.zeros((0, len(cols)))
                x = np.where(np.isnan(x), medians, x)
                added = forest.shapley(x) if exact else forest.attributions(x)
                by_name = np.argsort(cols)
                order = by_name[np.argsort(-np.abs(added[:, by_name]).round(6), axis=1, kind="stable")][:, :k]
                parts = np.take_along_axis(added, order, axis=1).round(6).tolist()
                lists[name] = [[{"feature": cols[i], "contribution": v} for i, v in zip(row, part)] for row, part in zip(order.tolist(), parts)]
            text = [json.dumps({n: lists[n][i] if n in lists else [] for n in C.TARGETS}) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column("feature_row_id"), batch.column("admission_id"), pa.array(text, pa.string())],
                                             names=["feature_row_id", "admission_id", "top_features"])
    ship(frame.sparkSession)
    return frame.select("feature_row_id", "admission_id", *C.FEATURE_COLUMNS).mapInArrow(run, "feature_row_id bigint, admission_id bigint, top_features string")


def with_top_features(scores: DataFrame, top: DataFrame) -> DataFrame:
    """The score table with the stored lists (score_id is the feature row's id of this run)."""
    lists = top.select(F.col("feature_row_id").alias("__row"), F.col("top_features").alias("__top"))
    joined = scores.join(lists, F.col("feature_row_id") == F.col("__row"), "left")
    return joined.withColumn("top_features", F.coalesce("__top", "top_features")).drop("__row", "__top")


def describe(rm: RiskModels) -> str:
    return json.dumps({"trained": {k: v is not None for k, v in rm.models.items()}})


__all__ = ["RiskModels", "fit", "probabilities", "risk_scores", "evaluation", "evaluation_rows", "degenerate_targets",
           "forests", "top_features", "with_top_features", "RISKS"]
