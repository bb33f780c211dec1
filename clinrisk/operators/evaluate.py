"""Model evaluation on (target, label, score) rows: ROC AUC and the
classification report (H7, H8).  Both reduce the rows with a map-side
partial aggregation first; only aggregated rows are shuffled."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinrisk.operators.prefix import prefix_sums


def roc_auc(scored: DataFrame) -> DataFrame:
    """Exact ROC AUC per target on the scores as they are, by the rank-sum
    identity with ties at mid-rank: sum over distinct scores s of pos(s) *
    (neg below s + neg(s)/2), divided by P*N.  NULL when a target has one
    class (the original prints N/A).

    The negatives below a score are a running sum over range partitions, so a
    target may have any number of distinct scores."""
    per_score = (scored.groupBy("target", "score")
                 .agg(F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg")))
    ranked = prefix_sums(per_score, ["target"], ["score"], {"neg_below": F.col("neg")})
    agg = ranked.groupBy("target").agg(
        F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"),
        F.sum((F.col("pos") * (F.col("neg_below") * 2 + F.col("neg"))).cast("decimal(38,0)")).alias("twice_u"))
    auc = F.when((F.col("n_pos") > 0) & (F.col("n_neg") > 0),
                 F.round(F.col("twice_u").cast("double") / (F.lit(2.0) * F.col("n_pos") * F.col("n_neg")), 10))
    return agg.select("target", F.col("n_pos").cast("bigint"), F.col("n_neg").cast("bigint"), auc.alias("auc"))


def classification_report(predicted: DataFrame) -> DataFrame:
    """Per class precision / recall / F1 / support, accuracy, macro and
    support-weighted averages, from (target, label, prediction) rows.  A class
    that is in neither the labels nor the predictions of a target has no row
    and no part in its averages.  An undefined ratio (0/0) reports 0, as the
    original's library does."""
    # One row per class: its hits, its labels and its predictions.
    sides = predicted.select("target", F.explode(F.array(
        F.struct(F.col("label").alias("c"), F.lit(1).alias("is_label"), (F.col("label") == F.col("prediction")).cast("int").alias("hit")),
        F.struct(F.col("prediction").alias("c"), F.lit(0).alias("is_label"), F.lit(0).alias("hit")))).alias("s"))
    per = (sides.groupBy("target", F.col("s.c").cast("string").alias("label"))
           .agg(F.sum("s.hit").alias("hits"), F.sum("s.is_label").alias("support"),
                F.count(F.when(F.col("s.is_label") == 0, 1)).alias("called")))

    def ratio(a, b):
        return F.when(b > 0, a.cast("double") / b).otherwise(F.lit(0.0))

    p, r = ratio(F.col("hits"), F.col("called")), ratio(F.col("hits"), F.col("support"))
    per = per.withColumn("p", p).withColumn("r", r)
    f1 = F.when(F.col("p") + F.col("r") > 0, 2.0 * F.col("p") * F.col("r") / (F.col("p") + F.col("r"))).otherwise(F.lit(0.0))
    per = per.withColumn("f", f1)
    n = F.sum("support")

    def weighted(c):
        return F.when(n > 0, F.sum(F.col(c) * F.col("support")) / n).otherwise(F.lit(0.0))

    # At most two rows per target from here on.
    whole = per.groupBy("target").agg(
        n.cast("bigint").alias("support"), ratio(F.sum("hits"), n).alias("accuracy"),
        *[F.avg(c).alias(f"m{c}") for c in "prf"], *[weighted(c).alias(f"w{c}") for c in "prf"])
    null = F.lit(None).cast("double")

    def row(frame, label, p, r, f):
        return frame.select("target", label.alias("label"), F.round(p, 10).alias("precision"), F.round(r, 10).alias("recall"),
                            F.round(f, 10).alias("f1_score"), F.col("support").cast("bigint").alias("support"))
    return (row(per, F.col("label"), F.col("p"), F.col("r"), F.col("f"))
            .unionByName(row(whole, F.lit("accuracy"), null, null, F.col("accuracy")))
            .unionByName(row(whole, F.lit("macro avg"), F.col("mp"), F.col("mr"), F.col("mf")))
            .unionByName(row(whole, F.lit("weighted avg"), F.col("wp"), F.col("wr"), F.col("wf"))))
