"""Incremental landing ingest with Structured Streaming (S6, file by file).

The batch ingest re-reads a whole landing folder every run.  The streaming
form reads only files it has not seen before: a CSV file source under the
declared schema, written to the lake table by the file sink, whose commit log
makes every file land exactly once even when a run is interrupted and
restarted.  ``Trigger.AvailableNow`` processes what is there and stops, so the
weekly refresh stays a batch job on the cluster's schedule.

Use it for datasets delivered as increments (new rows in new files).  A
dataset delivered as a full snapshot per file must go through the batch
ingest, which replaces the table: appending a new snapshot would duplicate
every row that did not change.
"""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.types import StructType

from ..sources.tables import Lake


def ingest_new_files(spark: SparkSession, landing_dir: str, schema: StructType, lake: Lake,
                     table: str, checkpoint: str, rfc_quotes: bool = False,
                     max_files_per_trigger: int | None = None, wait_s: float = 300.0) -> dict:
    """Append the rows of new CSV files in ``landing_dir`` to ``table``.

    The table stays a plain one (the file sink's commit log names its files).
    Returns the rows and batches of this run, counted as each batch ends: the
    query itself keeps the progress of its last batches only.  Raises
    ``TimeoutError`` if the count is not complete ``wait_s`` after the query's end.
    """
    reader = (spark.readStream.schema(schema).option("header", True)
              .option("mode", "PERMISSIVE"))
    if rfc_quotes:
        reader = reader.option("escape", '"')
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.csv(landing_dir)
    name = f"landing-{uuid.uuid4().hex}"
    counted, ended = {"rows": 0, "batches": 0, "run": None}, threading.Event()

    class Progress(StreamingQueryListener):
        def onQueryStarted(self, event):
            if event.name == name:
                counted["run"] = str(event.runId)

        def onQueryProgress(self, event):
            if event.progress.name == name:
                counted["rows"] += event.progress.numInputRows
                counted["batches"] += 1

        def onQueryIdle(self, event):
            pass

        def onQueryTerminated(self, event):
            if str(event.runId) == counted["run"]:
                ended.set()

    listener = Progress()
    spark.streams.addListener(listener)
    try:
        query = (stream.writeStream.format("parquet").queryName(name)
                 .option("path", lake.path(table))
                 .option("checkpointLocation", checkpoint)
                 .outputMode("append")
                 .trigger(availableNow=True)
                 .start())
        query.awaitTermination()
        # events come in order: all progress is in once the end is reported
        if not ended.wait(wait_s):
            raise TimeoutError(f"the rows of {table} are appended, but their count was not reported within {wait_s} s")
    finally:
        spark.streams.removeListener(listener)
    return {"rows": counted["rows"], "batches": counted["batches"]}
