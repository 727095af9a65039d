"""I1 streaming form: envelope files -> foreachBatch -> the batch ingest.

A file source feeds micro-batches to the same ``ingest`` function used in
batch mode (incremental flavour: exactly the pending documents that
arrived).  Progress lives in the stream checkpoint; delivery state lives in
the store's append-only tables, each micro-batch adding its own rows.  A
restarted query re-delivers at most one micro-batch.  Its parts are named by
the query's id, which the checkpoint keeps, and the epoch, so a replay
completes the parts that the first attempt began and adds none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from textlens.operators.ingest import IngestStore, ingest
from textlens.operators.labeler import DEFAULT_MODEL_VERSION
from textlens.operators.scoring import Scorer


def start_ingest_stream(spark: SparkSession, source_dir: str, schema: StructType, scorer: Scorer,
                        store: IngestStore, checkpoint_location: str,
                        model_version: str = DEFAULT_MODEL_VERSION,
                        max_files_per_trigger: int | None = None,
                        available_now: bool = True, doc_id: str | None = None) -> StreamingQuery:
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.parquet(source_dir)

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        if batch.isEmpty():
            return
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        ingest(batch, scorer, store, model_version, incremental=True, doc_id=doc_id, token=f"{query}-{epoch_id}")

    writer = (stream.writeStream.foreachBatch(on_batch)
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
