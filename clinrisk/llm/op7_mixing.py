"""Mixing sources to target weights by capped water-filling.

Every source has a weight and a capacity (``max_epochs`` times its words).
All words of the corpus are shared out by weight; a source whose share passes
its capacity is clamped there and the excess is shared again among the others
by weight, round after round, until no share is above its capacity.  A round
is one small aggregate over the table of sources; two numbers come back.

A source's target is then sampled: every document is taken ``target div
source_size`` whole times, and the fractional repetition is a seeded sample:
documents in the order of a seeded hash ``u`` until the source's remaining
words are reached; the last one is taken whole or not at all, whichever ends
nearer the target.  The cut is found without sorting a
source in one task: word sums over 4,096 hash bins, then over 4,096 bins of
the boundary bin (a third of all rows may be one source; 2**24 bins leave a
handful of documents), and only that last bin is ordered.

Only DataFrame functions run.  Defined cases: a null text has no words; a null
source is a source (last in order); sources without words have target 0;
repeated rows (one id and text) stand or fall together at a boundary; an empty table gives
no rows; other columns are carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clinrisk.llm.common import n_words, stored, table

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = 7
BROADCAST_SOURCES = 10_000     # a cut row is under 200 bytes
_BIN_BITS = 12
_U_BITS = 52


def seeded_u(id_col: Column, text_col: Column, seed: int = SEED) -> Column:
    """52 seeded bits of the id and the text: an id that many rows share (null, say) is no hot spot of the hash."""
    text = F.md5(F.coalesce(text_col, F.lit("")).cast("binary"))
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(id_col.cast("string"), F.lit("")), text))
    return F.conv(F.substring(digest, 1, _U_BITS // 4), 16, 10).cast("bigint")


def items(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(id, th, source, size, u) of every row."""
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("th"), F.col(source_col).alias("source"),
                       n_words(F.col(text_col)).alias("size"), seeded_u(F.col(id_col), F.col(text_col)).alias("u"))


def weighted_sources(rows: DataFrame, weights: tuple = WEIGHTS) -> DataFrame:
    """(source, source_size, weight): weights repeat along the sources in code
    point order, null last.  Ranks come from a range-partitioned, stored table
    and the row counts of its partitions, not from one sorted task."""
    spark = rows.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = [F.col("source").isNull(), F.col("source")]
    ranged = stored(sums.repartitionByRange(n, *order).withColumn("part", F.spark_partition_id()), "sources")
    before = (ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
              .withColumn("before", F.sum("n").over(Window.orderBy("part")) - F.col("n")).select("part", "before"))
    rank = F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1 + F.col("before")
    ranked = ranged.join(before, "part").withColumn("rank", rank)
    weight = F.get(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights)).cast("int"))
    return ranked.select("source", "source_size", weight.cast("bigint").alias("weight"))


def water_fill(sources: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Adds ``target``: shares of all words by weight, clamped at ``max_epochs`` sizes."""
    cap = F.col("source_size") * max_epochs
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    clamped, share = -1, F.lit(0.0)
    while True:
        over = cap.cast("double") < share
        r = sources.agg(F.count(F.when(over, 1)).alias("n"), F.sum(F.when(over, cap)).alias("full"),
                        F.sum(F.when(~over, F.col("weight"))).alias("w")).first()
        if r.n == clamped or not r.w:
            return sources.withColumn("target", F.when(over, cap.cast("double")).otherwise(share))
        clamped = r.n
        share = (F.col("weight") * F.lit(total - (r.full or 0))).cast("double") / F.lit(float(r.w))


def _boundary(sums: DataFrame, bin_col: str, need: str) -> DataFrame:
    """The one bin of each source in which the running sum passes ``need``
    words: (source, bin, left = words still needed in it)."""
    running = F.sum("words").over(Window.partitionBy("source").orderBy(bin_col))
    return (sums.withColumn("before", running - F.col("words"))
            .where((F.col("before") < F.col(need)) & (F.col("before") + F.col("words") > F.col(need)))
            .select("source", bin_col, (F.col(need) - F.col("before")).alias("left")))


def cuts(rows: DataFrame, sources: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Per source: source_size, target, whole (repetitions of every document),
    and what is taken once more: documents with ``u`` under ``below``, and those
    up to ``upto`` in the order (u, id, th)."""
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = sources.withColumn("whole", F.least(F.floor(rate), F.lit(max_epochs)).cast("bigint"))
    plan = plan.withColumn("extra", (F.round("target") - F.col("whole") * F.col("source_size")).cast("bigint"))
    plan = plan.withColumn("s", F.col("source"))

    def same(a: str, b: str) -> Column:
        return F.col(a).eqNullSafe(F.col(b))
    b1 = F.col("u").bitwiseAND(F.lit((1 << _U_BITS) - 1))
    sized = rows.where("size > 0").withColumn("b1", F.shiftright(b1, _U_BITS - _BIN_BITS))
    sized = sized.withColumn("b2", F.shiftright(b1, _U_BITS - 2 * _BIN_BITS))
    sums1 = sized.groupBy("source", "b1").agg(F.sum("size").alias("words"))
    sums1 = sums1.join(plan.select("s", "extra"), same("source", "s")).select("source", "b1", "words", "extra")
    edge1 = stored(_boundary(sums1, "b1", "extra").select(F.col("source").alias("s"), F.col("b1").alias("e1"), "left"), "edge1")
    inside1 = sized.join(edge1, same("source", "s") & (F.col("b1") == F.col("e1")))
    sums2 = inside1.groupBy("source", "b2").agg(F.sum("size").alias("words"), F.first("left").alias("left"))
    edge2 = _boundary(sums2, "b2", "left").select(F.col("source").alias("s"), F.col("b2").alias("e2"), "left")
    last = sized.join(edge2, same("source", "s") & (F.col("b2") == F.col("e2")))
    alike = last.groupBy("source", "u", "id", "th", "e2", "left").agg(F.sum("size").alias("words"))
    running = F.sum("words").over(Window.partitionBy("source").orderBy("u", "id", "th")) - F.col("words")
    # The boundary's document is in if at least half of its words are wanted.
    taken = F.when(2 * (F.col("left") - running) >= F.col("words"), F.struct("u", "id", "th"))
    edges = (alike.withColumn("in", taken).groupBy("source").agg(F.max("e2").alias("e2"), F.max("in").alias("upto"))
             .select(F.col("source").alias("es"), "e2", "upto"))
    # Where a running sum meets the need exactly there is no inner boundary: the bin edges themselves cut.
    step1, step2 = 1 << (_U_BITS - _BIN_BITS), 1 << (_U_BITS - 2 * _BIN_BITS)
    all1 = (sums1.withColumn("upto", F.sum("words").over(Window.partitionBy("source").orderBy("b1")))
            .where("upto <= extra").groupBy("source").agg(F.max("b1").alias("f1")).select(F.col("source").alias("s1"), "f1"))
    all2 = (sums2.withColumn("upto", F.sum("words").over(Window.partitionBy("source").orderBy("b2")))
            .where("upto <= left").groupBy("source").agg(F.max("b2").alias("f2")).select(F.col("source").alias("s2"), "f2"))
    out = (plan.join(edges, same("s", "es"), "left").join(all1, same("s", "s1"), "left").join(all2, same("s", "s2"), "left"))
    below = F.greatest(F.col("e2") * step2, (F.col("f2") + 1) * step2, (F.col("f1") + 1) * step1, F.lit(0))
    return out.select("s", "source_size", "target", "whole", "upto", below.cast("bigint").alias("below"))


def with_taken(rows: DataFrame, cut: DataFrame, n_sources: int) -> DataFrame:
    """``rows`` (columns id, th, source, size, u and any others under a struct)
    with source_size, target and taken."""
    cut = F.broadcast(cut) if n_sources <= BROADCAST_SOURCES else cut
    upto = F.coalesce(F.struct("u", "id", "th") <= F.col("upto"), F.lit(False))
    extra = F.when((F.col("u") < F.col("below")) | upto, F.col("size")).otherwise(0)
    joined = rows.join(cut, F.col("source").eqNullSafe(F.col("s")), "left")
    return joined.withColumn("taken", (F.col("whole") * F.col("size") + extra).cast("bigint")).drop("s", "whole", "upto", "below")


def allotment(docs: DataFrame, weights: tuple = WEIGHTS, max_epochs: int = MAX_EPOCHS, **columns) -> tuple[DataFrame, DataFrame, int]:
    """(rows with sizes, cuts, number of sources), the first two stored."""
    rows = stored(items(docs, **columns), "mix-items")
    sources = stored(weighted_sources(rows, weights), "mix-sources")
    filled = stored(water_fill(sources, max_epochs), "mix-targets")
    return rows, stored(cuts(rows, filled, max_epochs), "mix-cuts"), filled.count()


def mix(docs: DataFrame, **params) -> DataFrame:
    """The mixed corpus in the input's columns: a row for every repetition of a
    document, whole each time.  Documents that are not taken, and those without
    words, leave."""
    _, cut, n = allotment(docs, **params)
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("th"), "source",
                       n_words(F.col("text")).alias("size"), seeded_u(F.col("doc_id"), F.col("text")).alias("u"))
    taken = with_taken(rows, cut, n).where("taken > 0")
    copies = (F.col("taken") / F.col("size")).cast("int")
    out = taken.select("row", F.explode(F.sequence(F.lit(1), copies)).alias("copy"))
    return out.select(*[F.col("row")[c].alias(c) for c in docs.columns])


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, cut, n = allotment(table(spark, sf_dir, "documents"))
    out = with_taken(rows, cut, n)
    return out.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, ('0x' || substr(md5('{SEED}|' || doc_id || '|' || md5(coalesce(text, ''))), 1, 13))::BIGINT AS u,
                  len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, {MAX_EPOCHS} * sum(size)::BIGINT AS cap,
             [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight FROM d GROUP BY source),
p AS (SELECT *, sum(cap) OVER w AS filled, sum(weight) OVER () - sum(weight) OVER w AS open_weight
      FROM s WINDOW w AS (ORDER BY cap / weight, source)),
k AS (SELECT total - filled AS rest, open_weight FROM p, (SELECT sum(source_size) AS total FROM s)
      WHERE open_weight > 0 UNION ALL SELECT sum(source_size), sum(weight) FROM s),
b AS (SELECT rest, open_weight FROM k ORDER BY rest::DOUBLE / open_weight DESC LIMIT 1),
t AS (SELECT s.*, least(cap::DOUBLE, (weight * rest)::DOUBLE / open_weight::DOUBLE) AS target FROM s, b),
e AS (SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), {MAX_EPOCHS}) ELSE 0 END::BIGINT AS whole FROM t),
x AS (SELECT d.*, source_size, target, whole, (round(target) - whole * source_size)::BIGINT AS extra,
             sum(size) OVER (PARTITION BY d.source ORDER BY u, doc_id ROWS UNBOUNDED PRECEDING) - size AS before
      FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target,
       (whole * size + CASE WHEN extra > before AND 2 * (extra - before) >= size THEN size ELSE 0 END)::BIGINT AS taken FROM x
"""
