"""The corpus pipeline: documents to packed training sequences.

``STAGES`` are applied in order.  Every stage works on all rows that its
predecessor kept, each by one operator of ``clinrisk.llm``:

1. ``quality``: documents that the byte network scores under its threshold go;
2. ``line_dedup``: lines repeated across documents are cut from the texts;
3. ``near_duplicates``: of each component of near-duplicate documents one stays;
4. ``mixing``: documents are taken as often as the source's target weight asks;
5. ``packing``: the rows that say which token ids lie where in which sequence.

All but the last return the columns of ``documents``.  ``run`` writes each
stage's rows as Parquet in the shared folder and reads them again for the
next one, so a lost executor never sends the work back more than one stage.

Defined cases, by stage: a null or empty text is scored as padding, has no long line, is no near duplicate of
anything, and has no words, so ``mixing`` leaves it out; a null ``doc_id`` keeps its row up to the packed pieces;
a null ``source`` is a source, last in order; rows repeated with one id and text are one near-duplicate class, of which one
row stays; rows sharing an id but not the text are judged each by its own text; texts of any length and any run of
blanks are packed whole; further columns are carried up to ``mixing``, whatever their names; without labels every document is
kept; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clinrisk.llm.common import stored, table
from clinrisk.llm.op1_line_dedup import drop_repeated_lines
from clinrisk.llm.op4_quality_cnn import keep_good
from clinrisk.llm.op6_packing import pack
from clinrisk.llm.op7_mixing import mix
from clinrisk.llm.op8_ngram_jaccard import one_of_each


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_repeated_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs)


#: Runs that a worker of the last stage remembers: fewer than ``op6_packing`` alone,
#: as the executors' heaps have grown to their limit by then.
REMEMBERED = 200_000


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, cached=REMEMBERED)


STAGES = [("quality", quality), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates),
          ("mixing", mixing), ("packing", packing)]

#: The first stage's fitted network is beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
