"""Line dedup: repeated lines across documents, as compressed keep bitmaps.

A line's key is the line stripped of ``[\\x20\\x09-\\x0D]`` at both ends, A-Z
lower-cased.  Keys of at least ``min_chars`` code points that occur in at
least ``min_docs`` documents lose all their lines except in the largest
``doc_id`` that holds them.

How it runs (DataFrame functions only):

1. every long line becomes (128-bit key hash, doc_id, position), written once;
2. the hashes are range-partitioned by (hash, document, position), the largest
   document first, so a hash held by a third of all lines spans many tasks.  A
   scan in that order (``prefix_scan``: what a task must know of the slices
   before its own is carried into it) tells every row which documents its hash
   has shown so far: the first row of a document is its first occurrence, and
   the rows of the first document of all are the keeper's;
3. first occurrences are counted per hash.  Occurrences of repeated hashes that
   are not the keeper's set bits of 64-line words.  Only words with a dropped line are kept (all-ones words are
   implied), one short array per document: the compressed keep bitmap;
4. ``apply_bitmaps`` cuts the texts, one join by document.

Defined cases: a null or empty text is one empty line; a null ``doc_id`` is
one id below all others (ids are integers); rows repeated with the same id count as one document
and each is returned; rows sharing an id but not the text have bitmaps of
their own (the text's hash is part of the row key); an empty table gives no
rows; other columns are carried untouched whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clinrisk.llm.common import WS, ascii_lower, bit, stored, table
from clinrisk.operators.prefix import prefix_scan

MIN_CHARS = 40
MIN_DOCS = 5


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_occurrences(docs: DataFrame, min_chars: int = MIN_CHARS, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """(id, th, pos, h1, h2) of every line whose key is long enough."""
    lines = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("th"),
                        F.posexplode(_lines(F.col(text_col))).alias("pos", "line"))
    keys = lines.select("id", "th", "pos", F.btrim("line", F.lit(WS)).alias("key"))
    keys = keys.where(F.char_length("key") >= min_chars).withColumn("key", ascii_lower(F.col("key")))
    return keys.select("id", "th", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document with a dropped line: id, th (hash of the text), n_dropped
    and ``keep``, the words of the bitmap that are not all ones as
    array<struct<word, bits>>: bit i of word w is line 64 w + i."""
    occ = stored(line_occurrences(docs, min_chars, id_col, text_col), "line-hashes")
    doc = F.coalesce(F.col("id").cast("bigint"), F.lit(-(1 << 63)))
    seen = prefix_scan(occ, ["h1", "h2"], [doc.desc(), "th", "pos"], {"last": ("min", doc), "top": ("max", doc)}, once=False)
    first = F.col("last").isNull() | (doc < F.col("last"))
    keeper = F.col("top").isNull() | (doc == F.col("top"))
    seen = stored(seen.select("id", "th", "pos", "h1", "h2", first.alias("first"), keeper.alias("keeper")), "line-runs")
    repeated = seen.where("first").groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs")).where(F.col("n_docs") >= min_docs)
    # Both sides of the join are stored tables: a hash that a third of all lines share is split as a skewed join.
    repeated = stored(repeated.select("h1", "h2"), "repeated-lines")
    dropped = seen.where("NOT keeper").join(repeated, ["h1", "h2"], "left_semi")
    words = (dropped.groupBy("id", "th", F.floor(F.col("pos") / 64).cast("int").alias("word"))
             .agg(F.bit_or(bit(F.col("pos") % 64)).alias("gone")))
    return (words.groupBy("id", "th")
            .agg(F.sort_array(F.collect_list(F.struct("word", F.bitwise_not("gone").alias("bits")))).alias("keep"),
                 F.sum(F.bit_count("gone")).cast("bigint").alias("n_dropped")))


def _flags(keep: Column) -> Column:
    """The bitmap as an array of '0'/'1' characters up to its last stored
    word; later lines are kept."""
    before = lambda i: F.when(i == 0, F.lit(-1)).otherwise(F.get(keep, i - 1)["word"])
    part = F.transform(keep, lambda w, i: F.concat(
        F.repeat(F.lit("1"), F.lit(64) * (w["word"] - before(i) - 1)),
        F.reverse(F.lpad(F.bin(w["bits"]), 64, "0"))))
    return F.split(F.array_join(part, ""), "")


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, lines, kept_text, n_dropped) with ``row`` the input row as a
    struct, so no column name of the input can clash."""
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("rid"), F.xxhash64(text_col).alias("rth"))
    joined = rows.join(bitmaps.hint("shuffle_hash"), F.col("rid").eqNullSafe(F.col("id")) & (F.col("rth") == F.col("th")), "left")
    text = F.coalesce(F.col("row")[text_col], F.lit(""))
    cut = joined.select("row", "keep", "n_dropped", F.when(F.col("keep").isNotNull(), _flags(F.col("keep"))).alias("flags"))
    kept = F.array_join(F.filter(_lines(text), lambda x, i: F.coalesce(F.get("flags", i), F.lit("1")) == "1"), "\n")
    return cut.select("row", F.size(_lines(text)).cast("bigint").alias("n_lines"),
                      F.coalesce("n_dropped", F.lit(0).cast("bigint")).alias("n_dropped"),
                      F.when(F.col("keep").isNull(), text).otherwise(kept).alias("kept_text"))


def drop_repeated_lines(docs: DataFrame, **params) -> DataFrame:
    """The documents with the repeated lines cut from ``text`` and ``n_chars``
    renewed, in the input's columns.  Texts without a dropped line (null too)
    stay as they are."""
    out = apply_bitmaps(docs, keep_bitmaps(docs, **params))
    changed = F.col("n_dropped") > 0
    fresh = {"text": F.when(changed, F.col("kept_text")).otherwise(F.col("row")["text"]),
             "n_chars": F.when(changed, F.char_length("kept_text").cast("bigint")).otherwise(F.col("row")["n_chars"])
             if "n_chars" in docs.columns else None}
    return out.select(*[(fresh[c] if fresh.get(c) is not None else F.col("row")[c]).alias(c) for c in docs.columns])


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = apply_bitmaps(docs, keep_bitmaps(docs))
    return out.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped",
                      F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
l AS (SELECT rid, doc_id, unnest(string_split(text, chr(10))) AS line,
             generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
r AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40
      GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.*, r.key IS NOT NULL AND k.doc_id <> r.keeper AS gone FROM k LEFT JOIN r ON k.key = r.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY rid, doc_id
"""
