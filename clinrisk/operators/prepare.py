"""Feature preparation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clinrisk import config as C
from clinrisk.functions.hashing import uniform
from clinrisk.operators.prefix import prefix_sums, running_count, stored

#: Share of rows held out for evaluation.
TEST_FRACTION = 0.2
UNKNOWN = "Unknown"
#: Cells of the draw in which the split's rows are counted.
SPLIT_CELLS = 1 << 14


def label_mapping(features: DataFrame, columns=C.CATEGORICAL_FEATURES) -> DataFrame:
    """(feature, value, code): code = rank of the value among the column's
    sorted distinct values, from 0 (code-point order), NULL counting as
    'Unknown'.  Stored with the models, so that later batches get the same
    codes."""
    pairs = features.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.coalesce(F.col(c), F.lit(UNKNOWN)).alias("value")) for c in columns])).alias("x"))
    distinct = pairs.select("x.feature", "x.value").distinct()
    code = F.row_number().over(Window.partitionBy("feature").orderBy("value")) - 1      # a few values per column
    return distinct.withColumn("code", code.cast("bigint"))


def label_encode(features: DataFrame, columns=C.CATEGORICAL_FEATURES, mapping: DataFrame | None = None) -> DataFrame:
    """NULL -> 'Unknown', then the value's code of ``mapping`` (fitted
    on ``features`` itself by default).  A value that the mapping lacks gets
    the code of 'Unknown', or else the next free one."""
    mapping = label_mapping(features, columns) if mapping is None else mapping
    rows = mapping.collect()                                    # the vocabulary of four columns
    encoded = features
    for c in columns:
        codes = {r["value"]: r["code"] for r in rows if r["feature"] == c}
        other = codes.get(UNKNOWN, max(codes.values(), default=-1) + 1)
        known = F.create_map(*[F.lit(x) for kv in codes.items() for x in kv]) if codes else None
        value = F.coalesce(F.col(c), F.lit(UNKNOWN))
        code = F.coalesce(F.try_element_at(known, value), F.lit(other)) if codes else F.lit(other)
        encoded = encoded.withColumn(c, code.cast("bigint"))
    return encoded


def code_table(rows: DataFrame, column: str) -> DataFrame:
    """G2 for a column with any number of values: (value, code), the code being
    the value's rank in code-point order, NULL counting as 'Unknown'.  Ranks
    are running counts over range partitions; nothing passes the driver."""
    values = rows.select(F.coalesce(F.col(column), F.lit(UNKNOWN)).alias("value")).distinct()
    return running_count(values, ["value"], "code")


def encode_by_join(rows: DataFrame, column: str, codes: DataFrame) -> DataFrame:
    """``column`` replaced by its code.  A value that ``codes`` lacks gets the
    code of 'Unknown', or else the next free one.  A value that most rows hold is one row of ``codes``: Spark splits it as a skewed join."""
    other = codes.agg(F.coalesce(F.max(F.when(F.col("value") == UNKNOWN, F.col("code"))), F.max("code") + 1, F.lit(0))).first()[0]
    held = codes.select(F.col("value").alias("__value"), F.col("code").alias("__code"))
    joined = rows.join(held, F.coalesce(F.col(column), F.lit(UNKNOWN)) == F.col("__value"), "left")
    return joined.withColumn(column, F.coalesce("__code", F.lit(other)).cast("bigint")).drop("__value", "__code")


def derived_features(encoded: DataFrame) -> DataFrame:
    """Pulse pressure, shock index (SBP 0 -> missing), age over 65."""
    return encoded.select(
        "*",
        (F.col("systolic_bp") - F.col("diastolic_bp")).alias("pulse_pressure"),
        (F.col("heart_rate") / F.nullif(F.col("systolic_bp"), F.lit(0.0))).alias("shock_index"),
        F.coalesce(F.col("age") > 65, F.lit(False)).cast("bigint").alias("age_risk"),
    )


def model_frame(features: DataFrame, mapping: DataFrame | None = None) -> DataFrame:
    """Ids, labels and the 23 model features in model order, as doubles (a
    median filled in later is never cut to an integer)."""
    prepared = derived_features(label_encode(features, mapping=mapping))
    labels = list(C.TARGETS.values())
    return prepared.select("feature_row_id", "patient_id", "admission_id", *labels,
                           *[F.col(c).cast("double").alias(c) for c in C.FEATURE_COLUMNS])


def stratified_split(frame: DataFrame, row_id: str = "feature_row_id") -> DataFrame:
    """H2: (row id, target, label, is_test).  Per target and class exactly
    ``floor(0.2 n + 0.5)`` of the ``n`` rows are held out: those first in the
    order of a seeded draw of the row.  The rows are counted by class and cell
    of the draw; running counts of the cells say in which one the last row held
    out lies, and only that cell's rows are ranked (by range partitions)."""
    u = uniform("split", F.col(row_id), 0)
    long = frame.select(F.col(row_id), u.alias("u"), F.explode(F.array(*[
        F.struct(F.lit(n).alias("target"), F.col(lbl).cast("bigint").alias("label")) for n, lbl in C.TARGETS.items()])).alias("x"))
    long = long.select(row_id, "u", "x.target", "x.label").where("label IS NOT NULL")
    long = long.withColumn("cell", F.floor(F.col("u") * SPLIT_CELLS))
    cells = long.groupBy("target", "label", "cell").agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("target", "label")                       # SPLIT_CELLS rows each
    earlier = whole.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    at = cells.select("target", "label", F.col("cell").alias("edge"), "n", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("skipped"),
                      F.floor(F.sum("n").over(whole) * TEST_FRACTION + 0.5).alias("n_test"))
    edges = stored(at.where((F.col("skipped") <= F.col("n_test")) & (F.col("n_test") < F.col("skipped") + F.col("n"))).drop("n"), "split-edges")
    rows = long.join(F.broadcast(edges), ["target", "label"])           # two classes of three targets
    sure = rows.where(F.col("cell") != F.col("edge")).select(row_id, "target", "label", (F.col("cell") < F.col("edge")).alias("is_test"))
    ranked = prefix_sums(rows.where(F.col("cell") == F.col("edge")), ["target", "label"], ["u", row_id], {"before": F.lit(1).cast("bigint")})
    return sure.union(ranked.select(row_id, "target", "label", (F.col("skipped") + F.col("before") < F.col("n_test")).alias("is_test")))


def training_rows(frame: DataFrame, split: DataFrame, target: str, row_id: str = "feature_row_id") -> DataFrame:
    rows = split.where((F.col("target") == target) & ~F.col("is_test")).select(row_id)
    return frame.join(rows, row_id, "left_semi")


def medians(frame: DataFrame, split: DataFrame, columns=C.FEATURE_COLUMNS, row_id: str = "feature_row_id") -> DataFrame:
    """H1: (target, feature, median): the exact median (interpolated) of every
    feature over each target's training rows, NULL without values.

    A row is counted once for the set of targets that train on it (a bit
    each); values are counted first, and the two middle ones found by running
    counts over range partitions."""
    targets = sorted(r["target"] for r in split.select("target").distinct().collect())      # a few
    bit = F.coalesce(*[F.when(F.col("target") == t, F.lit(1 << i)) for i, t in enumerate(targets)], F.lit(0)).cast("bigint")
    train = split.where(~F.col("is_test")).groupBy(row_id).agg(F.bit_or(bit).alias("held"))
    cells = frame.join(train, row_id).select("held", F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), F.col(c).cast("double").alias("value")) for i, c in enumerate(columns)])).alias("x")).select("held", "x.i", "x.value")
    by_set = cells.where("value IS NOT NULL").groupBy("held", "i", "value").agg(F.count(F.lit(1)).alias("n"))
    each = F.explode(F.array_compact(F.array(*[F.when(F.col("held").bitwiseAND(F.lit(1 << i)) != 0, F.lit(t)) for i, t in enumerate(targets)], F.lit(None).cast("string"))))
    counts = (by_set.select(each.alias("target"), "i", "value", "n").groupBy("target", "i", "value").agg(F.sum("n").alias("n"))
              .select("target", F.get(F.array(*[F.lit(c) for c in columns]), F.col("i")).alias("feature"), "value", "n"))
    ranked = prefix_sums(counts, ["target", "feature"], ["value"], {"before": F.col("n")})
    total = ranked.groupBy("target", "feature").agg(F.sum("n").alias("total"))
    at = ranked.join(F.broadcast(total), ["target", "feature"])         # 23 features of three targets
    low, high = F.floor((F.col("total") - 1) / 2), F.floor(F.col("total") / 2)

    def holds(k):
        return (F.col("before") <= k) & (k < F.col("before") + F.col("n"))
    middle = at.groupBy("target", "feature").agg(((F.max(F.when(holds(low), F.col("value"))) + F.max(F.when(holds(high), F.col("value")))) / 2).alias("median"))
    names = split.select("target").distinct().withColumn("feature", F.explode(F.array(*[F.lit(c) for c in columns])))
    return names.join(middle, ["target", "feature"], "left")


def impute(frame: DataFrame, med: dict[str, float | None]) -> DataFrame:
    """Fill missing values with the training medians, as doubles; all-missing
    columns are dropped by the caller (their median is NULL)."""
    fills = {c: v for c, v in med.items() if v is not None}
    return frame.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(float(v))) for c, v in fills.items()})


def class_weights(split: DataFrame) -> DataFrame:
    """H3: balanced weights n / (2 * n_c) per target and class, on the
    target's training rows."""
    counts = split.where(~F.col("is_test")).groupBy("target", "label").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy("target"))  # <= 2 rows per target
    return counts.select("target", "label", "n",
                         (total.cast("double") / (F.lit(2.0) * F.col("n"))).alias("weight"))
