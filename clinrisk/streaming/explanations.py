"""Incremental write-back of returned explanations (Structured Streaming).

The original loops over at-risk rows, calls a hosted model per row and runs
an UPDATE per answer.  Here the answers arrive as files in a folder; a
streaming query picks them up in micro-batches, and each batch becomes one
small answer batch of the score store, which merges on read.  The batch's
number is the query's own epoch, so a batch replayed after a failure replaces
itself; the query's checkpoint lies beside the store it belongs to, so a
restarted stream goes on with the next epoch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from clinrisk.session import scratch_path
from clinrisk.sources.sinks import ANSWER_SCHEMA, ScoreStore


def start_merge_stream(store: ScoreStore, responses_dir: str, files_per_batch: int | None = None):
    """Take every available file as answers, then stop (``availableNow``)."""
    reader = store.spark.readStream.schema(ANSWER_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def add(batch: DataFrame, epoch: int) -> None:
        store.add_answers(batch, "stream", epoch)
    return (reader.parquet(responses_dir).writeStream.foreachBatch(add)
            .option("checkpointLocation", f"{store.root}/stream-checkpoint")
            .trigger(availableNow=True).start())


def run_merge_stream(scores: DataFrame, responses: DataFrame) -> DataFrame:
    """Drive the stream over ``responses`` written as files, and return the
    merged score table."""
    spark = scores.sparkSession
    store = ScoreStore(spark, scratch_path(spark, "score-store"))
    store.add_run(scores)
    inbox = scratch_path(spark, "explain-inbox")
    responses.write.parquet(inbox)
    start_merge_stream(store, inbox, files_per_batch=4).awaitTermination()
    return store.current().select(*scores.columns)
