"""Token-id output: binary files of concatenated ids with Elias-Fano boundaries.

Documents are encoded and an end id follows each; files hold the ids one after
another in ascending ``doc_id`` order.  A file is a row of segments.  A
segment closes once it holds ``SEGMENT`` ids (so at most that and one
document), and is

    "EFT1", id width, partition, number in it, documents, ids, null ids, crc32
    Elias-Fano sequence of the documents' ends in the segment
    Elias-Fano sequence of the doc_ids
    the ids, little-endian, 2 bytes each while the vocabulary fits in 2**16
    "\\n1TFE"

Nothing else gives an offset: document i of a segment lies between the ends
i - 1 and i, found by select.  ``manifest`` lists the segments with their running sum of
ids; ``read_documents`` opens only the files that can hold the wanted ids.

On Spark: one pass over ids and text lengths gives bounded quantiles of
``doc_id`` and the number of partitions; the scan's tasks number their rows by
range, texts are shuffled once to their range and sorted there, and
each task streams its rows into segments.  An id that spans several quantiles
(a third of all rows, say) is dealt over their partitions.  Spark's own
writer and readers make and open the files, in any store; a task that is lost
leaves nothing behind.

Defined cases: a null or empty text is the end id alone; a null ``doc_id``
comes before all others; documents sharing an id follow one another in the
order of the scan; an empty table gives no segment; other columns are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clinrisk.llm.bpe import encoder
from clinrisk.llm.common import map_arrow, slices, stored, table
from clinrisk.llm.elias_fano import EliasFano
from clinrisk.operators.prefix import prefix_sums
from clinrisk.session import scratch_path

VOCABULARY = "byte_bpe_50k"
END_ID = 0
SEGMENT = 1 << 21               # ids of a segment
SEGMENTS_A_FILE = 8
BOUND_ROWS = 100                # sampled rows a partition
PARTITION_BYTES = 64 << 20      # text of a partition
_MAGIC, _TAIL = b"EFT1", "\n1TFE"
_HEAD = struct.Struct("<4sIIIQQQI")
_LOWEST = -(1 << 63)


class Segment:
    """One segment, over the bytes of a file."""

    def __init__(self, data: memoryview, at: int):
        magic, self.width, self.part, self.seq, self.n_docs, self.n_ids, self.nulls, crc = _HEAD.unpack_from(data, at)
        if magic != _MAGIC:
            raise ValueError("not a segment")
        body = at + _HEAD.size
        self.ends, place = EliasFano.from_bytes(data, body)
        self.keys, place = EliasFano.from_bytes(data, place)
        stop = place + self.n_ids * self.width
        if zlib.crc32(data[body:stop]) != crc:
            raise ValueError("a segment is damaged")
        self.ids = np.frombuffer(data, f"<u{self.width}", self.n_ids, place)
        self.stop = stop + len(_TAIL)

    def span(self, i: int) -> tuple[int, int]:
        """Where the ids of document i lie."""
        return (self.ends[i - 1] if i else 0), self.ends[i]

    def find(self, doc_id: int) -> range:
        """The documents with this id."""
        return range(max(self.nulls, self.keys.first_at_least(doc_id)), self.keys.first_at_least(doc_id + 1))

    @staticmethod
    def all(data: bytes) -> Iterator["Segment"]:
        at, view = 0, memoryview(data)
        while at < len(view):
            segment = Segment(view, at)
            yield segment
            at = segment.stop


def pack_segment(part: int, seq: int, width: int, doc_ids: list[int | None], ids: list[bytes]) -> bytes:
    nulls = sum(d is None for d in doc_ids)
    lengths = np.array([len(b) // width for b in ids], np.int64)
    keys = np.array([_LOWEST if d is None else d for d in doc_ids], np.int64)
    body = EliasFano.of(np.cumsum(lengths)).to_bytes() + EliasFano.of(keys).to_bytes() + b"".join(ids)
    return _HEAD.pack(_MAGIC, width, part, seq, len(ids), int(lengths.sum()), nulls, zlib.crc32(body)) + body


def _bounds(keys: DataFrame, rows: int, n: int) -> list[int]:
    """n - 1 keys that part the rows evenly, from a seeded sample of some BOUND_ROWS rows a partition.  They decide
    only how even the partitions are."""
    if n < 2 or not rows:
        return []
    part = min(1.0, BOUND_ROWS * n / rows)
    some = keys.where(F.pmod(F.xxhash64("mark"), F.lit(1 << 30)) < int(part * (1 << 30)) + 1)
    return some.agg(F.percentile_approx("key", [i / n for i in range(1, n)], BOUND_ROWS * n)).first()[0] or []


def _partition(key: Column, mark: Column, bounds: list[int]) -> Column:
    """The range of a key.  One that equals several bounds is dealt over their ranges."""
    if not bounds:
        return F.lit(0)
    held = F.array(*[F.lit(b).cast("bigint") for b in bounds])
    below = F.size(F.filter(held, lambda b: b < key))
    equal = F.size(F.filter(held, lambda b: b == key))
    return (below + F.when(equal > 0, F.pmod(F.xxhash64(mark), equal + 1)).otherwise(0)).cast("int")


def write_tokens(docs: DataFrame, path: str, vocabulary: str = VOCABULARY, end_id: int = END_ID, segment: int = SEGMENT,
                 partition_bytes: int = PARTITION_BYTES, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the token files of ``docs`` under ``path``."""
    spark = docs.sparkSession
    key = F.coalesce(F.col(id_col).cast("bigint"), F.lit(_LOWEST))
    size = docs.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length(text_col)).alias("bytes")).first()
    n = slices(size["bytes"] or 0, spark, partition_bytes)
    bounds = _bounds(docs.select(key.alias("key"), F.monotonically_increasing_id().alias("mark")), size["rows"], n)
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"), F.monotonically_increasing_id().alias("mark"))
    rows = rows.withColumn("part", _partition(F.coalesce("id", F.lit(_LOWEST)), F.col("mark"), bounds))
    ranged = rows.repartitionById(n, F.col("part")).sortWithinPartitions(F.asc_nulls_first("id"), "mark").select("id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(vocabulary)
        part, seq = TaskContext.get().partitionId(), 0
        end = np.array([end_id], f"<u{bpe.width}").tobytes()
        doc_ids: list[int | None] = []
        held: list[bytes] = []
        size = 0

        def close() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([pack_segment(part, seq, bpe.width, doc_ids, held)], pa.binary())], names=["segment"])
        for batch in batches:
            texts = (t.as_py() or "" for t in batch.column(1))
            for doc_id, ids in zip(batch.column(0).to_pylist(), bpe.encode(texts)):
                doc_ids.append(doc_id)
                held.append(ids + end)
                size += len(ids) // bpe.width + 1
                if size >= segment:
                    yield close()
                    doc_ids, held, size, seq = [], [], 0, seq + 1
        if held:
            yield close()
    made = map_arrow(ranged, write, "segment binary", keep=True)
    # The text writer adds the tail to a row's bytes, and changes nothing in them.
    made.select(F.col("segment").cast("string").alias("value")).write.option("lineSep", _TAIL).option("compression", "none") \
        .option("maxRecordsPerFile", SEGMENTS_A_FILE).text(path)


def _files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return spark.read.format("binaryFile").load(paths).select("path", "content")


def token_rows(spark: SparkSession, path: str) -> DataFrame:
    """Per document, read from the files: path, part, seq, place (its number in
    the segment), doc_id, begin (ids before it in the segment), n_tokens, ids_crc32."""
    schema = ("path string, part bigint, seq bigint, place bigint, doc_id bigint, begin bigint, n_tokens bigint, ids_crc32 bigint")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                for s in Segment.all(content.as_buffer()):
                    ends = s.ends.all()
                    begins = np.concatenate([np.zeros(1, np.int64), ends[:-1]])
                    keys = s.keys.all()
                    crcs = [zlib.crc32(s.ids[a:b].astype("<u4").tobytes()) for a, b in zip(begins.tolist(), ends.tolist())]
                    n = s.n_docs
                    yield pa.RecordBatch.from_arrays([
                        pa.array([name] * n, pa.string()), pa.array(np.full(n, s.part, np.int64)), pa.array(np.full(n, s.seq, np.int64)),
                        pa.array(np.arange(n)), pa.array(keys, mask=np.arange(n) < s.nulls), pa.array(begins), pa.array(ends - begins),
                        pa.array(crcs, pa.int64())], names=[c.split()[0] for c in schema.split(", ")])
    return map_arrow(_files(spark, path), read, schema, keep=True)


def manifest(rows: DataFrame) -> DataFrame:
    """Per segment of ``token_rows``: path, part, seq, n_docs, n_ids, first_id, last_id, base (ids before it in all files)."""
    found = rows.groupBy("path", "part", "seq").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("n_tokens").alias("n_ids"), F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
    return prefix_sums(found, [], ["part", "seq"], {"base": F.col("n_ids")})


def documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    rows = stored(token_rows(spark, path), "token-rows")
    base = manifest(rows).select("part", "seq", "base")
    return rows.join(base, ["part", "seq"]).select("doc_id", (F.col("base") + F.col("begin")).alias("start"), "n_tokens", "ids_crc32")


def read_documents(spark: SparkSession, listed: DataFrame, doc_ids: list[int]) -> DataFrame:
    """(doc_id, ids) of the documents with one of ``doc_ids`` (a bounded list), from the files that ``listed`` (a stored
    ``manifest``) names for them: each is found by select, without decoding the segment."""
    schema = "doc_id bigint, ids array<bigint>"
    held = F.array(*[F.lit(d).cast("bigint") for d in doc_ids])
    some = listed.where(F.exists(held, lambda d: d.between(F.col("first_id"), F.col("last_id")))) if doc_ids else listed.limit(0)
    paths = [r.path for r in some.select("path").distinct().collect()]
    if not paths:
        return spark.createDataFrame([], schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(1):
                for s in Segment.all(content.as_buffer()):
                    found = [(d, s.ids[slice(*s.span(i))].tolist()) for d in sorted(set(doc_ids)) for i in s.find(d)]
                    yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in found], pa.int64()), pa.array([x for _, x in found], pa.list_(pa.int64()))],
                                                     names=["doc_id", "ids"])
    return map_arrow(_files(spark, paths), read, schema, keep=True)


def op13_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "llm-token-files")
    write_tokens(table(spark, sf_dir, "documents"), path)
    return documents(spark, path)
