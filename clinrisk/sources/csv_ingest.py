"""Raw encounter CSV: write (for exchange) and ingest (A1, A2).

Every field is read as text under the file's header, white space is stripped
from the header names, and each field is cast to its declared type.  Quotes
follow RFC 4180 (a doubled quote inside a quoted field).  Strict reading fails
on malformed fields and on rows with too few or too many of them; tolerant reading lists both as rejects.

An encounter's id is its row's position, as in the original, unless the file
has an ``Encounter Id`` column.  Positions come from the order (file name,
start of the file split, row in the split), numbered by range partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinrisk.operators.ids import dense_ids
from clinrisk.sources.encounters import RAW_COLUMNS

ID_HEADER = "Encounter Id"
_BAD = "__corrupt"


def write_raw_csv(enc: DataFrame, path: str, pad_headers: bool = True, with_id: bool = True) -> None:
    """Write encounters with the raw CSV header names (padded with spaces, as
    hand-made exports often are), in id order."""
    pad = " " if pad_headers else ""
    cols = [F.col("enc_id").alias(f"{pad}{ID_HEADER}{pad}")] if with_id else []
    cols += [F.col(c).alias(f"{pad}{h}{pad}") for h, c, _ in RAW_COLUMNS]
    ordered = enc.repartitionByRange("enc_id").sortWithinPartitions("enc_id")
    ordered.select(*cols).write.option("header", True).option("escape", '"').mode("errorifexists").csv(path)


def read_raw_csv(spark: SparkSession, path: str, tolerant: bool = False, multi_line: bool = False):
    """Ingest the raw CSV.  Strict (default): a malformed field or row fails
    the job.  Tolerant: returns ``(rows, rejects)`` -- fields that do not parse
    are NULL in ``rows``, and every such row is also listed in ``rejects`` with
    the names of its bad fields; a row with too few or too many fields is only
    in ``rejects``, as '(row)'.  ``multi_line`` allows line breaks in quotes (a file
    is then one split)."""
    options = {"header": True, "quote": '"', "escape": '"', "multiLine": multi_line, "columnPruning": False}
    header = spark.read.options(**options, inferSchema=False).csv(path).columns
    names = [c.strip() for c in header]
    types = {h: (c, t) for h, c, t in RAW_COLUMNS}
    missing = [h for h in types if h not in names]
    if missing:
        raise ValueError(f"CSV lacks columns: {missing}")
    fields = [(h, c, t) for h, (c, t) in types.items()]
    if ID_HEADER in names:
        fields.insert(0, (ID_HEADER, "enc_id", T.LongType()))
    schema = T.StructType([T.StructField(c, T.StringType()) for c in names] + ([T.StructField(_BAD, T.StringType())] if tolerant else []))
    raw = spark.read.options(**options, mode="PERMISSIVE" if tolerant else "FAILFAST", columnNameOfCorruptRecord=_BAD).schema(schema).csv(path)
    if ID_HEADER not in names:
        raw = raw.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__start"),
                         F.monotonically_increasing_id().alias("__row"))
        raw = dense_ids(raw, ["__file", "__start", "__row"], "__enc_id").drop("__file", "__start", "__row")
        raw = raw.withColumn(ID_HEADER, F.col("__enc_id").cast("string")).drop("__enc_id")
        fields.insert(0, (ID_HEADER, "enc_id", T.LongType()))
    if not tolerant:
        return raw.select(*[F.col(f"`{h}`").cast(t).alias(c) for h, c, t in fields])
    ragged = F.col(_BAD).isNotNull()
    wrong = F.array_compact(F.array(*[
        F.when(F.col(f"`{h}`").isNotNull() & F.col(f"`{h}`").try_cast(t).isNull(), F.lit(c)) for h, c, t in fields]))
    parsed = raw.select(*[F.col(f"`{h}`").try_cast(t).alias(c) for h, c, t in fields],
                        F.when(ragged, F.array(F.lit("(row)"))).otherwise(wrong).alias("bad_fields"), ragged.alias("__ragged"))
    rows = parsed.where("NOT __ragged").drop("bad_fields", "__ragged")
    rejects = parsed.where(F.size("bad_fields") > 0).select("enc_id", "bad_fields")
    return rows, rejects
