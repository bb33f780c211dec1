"""Helpers shared by the operators: table access, the byte classes of the
contracts, row keys, and stored intermediate tables."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Callable, Hashable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import clinrisk

from clinrisk.session import scratch_path

#: White space of the contracts: \x20 and \x09-\x0D.
WS = " \t\n\x0b\x0c\r"
WS_CLASS = r"[\x20\x09-\x0D]"
WORD_RE = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only.  For pure ASCII text ``lower`` does the same and
    works on bytes; ``translate`` walks code points."""
    return (F.when(F.octet_length(col) == F.char_length(col), F.lower(col))
            .otherwise(F.translate(col, UPPER, LOWER)))


def bit(i: Column) -> Column:
    """The 64-bit word with bit ``i`` set."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), i.cast("int"))


def n_words(col: Column) -> Column:
    """Number of white-space separated words; 0 for null."""
    return F.coalesce(F.regexp_count(col, F.lit(WORD_RE)), F.lit(0)).cast("bigint")


def id_crc(id_col: Column) -> Column:
    """crc32 of the id as text (a null id counts as empty text)."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared folder of ``spark.checkpoint.dir``
    and read it back: lineage is cut, and a lost executor re-reads files."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()
_BATCH_BYTES, _DEFAULT_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"
ARROW_BYTES = 8 << 20           # text in a worker at once, unless the session asks for something else


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, for those that
    do not have it on their path (Spark serves the file from the driver), and
    keep Arrow batches small: rows may hold very long texts."""
    if spark.conf.get(_BATCH_BYTES, _DEFAULT_BATCH_BYTES) == _DEFAULT_BATCH_BYTES:
        spark.conf.set(_BATCH_BYTES, f"{ARROW_BYTES}b")
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    top = os.path.dirname(os.path.abspath(clinrisk.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="clinrisk-ship-"), "clinrisk.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                z.write(full, os.path.relpath(full, os.path.dirname(top)))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


_KEPT: dict[Hashable, object] = {}


def kept(key: Hashable, make: Callable[[], object]) -> object:
    """What a worker keeps for further tasks of one operator; only the last one."""
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def let_go() -> None:
    """Drop what is ``kept`` and give free memory back to the system: Spark uses a
    worker again for other operators, and what one left would stand beside the next."""
    _KEPT.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # only the GNU C library has it
    if trim:
        trim(0)


def map_arrow(df: DataFrame, function, schema, keep: bool = False) -> DataFrame:
    """``mapInArrow`` with this package at hand on the executors.  With ``keep`` a
    worker still has at its next task what it has ``kept``; other tasks begin and end without."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        yield from function(batches)
        let_go()
    return df.mapInArrow(function if keep else run, schema)


def slices(rows: int, spark: SparkSession, per_task: int) -> int:
    """Partitions for ``rows`` of a stored table: by size, at least the
    session's shuffle partitions."""
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-rows // per_task))
