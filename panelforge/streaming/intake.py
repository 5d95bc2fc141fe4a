"""A streaming front door for files: new paths go through the same loading as a batch.

The file source knows files by path. Changed bytes at a known path are found by
the next batch run, which compares hashes; the manifest keeps both idempotent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from panelforge.config import Settings
from panelforge.plans import ingest
from panelforge.sources import files

BINARY = "path string, modificationTime timestamp, length long, content binary"


def start(spark: SparkSession, raw: str, lake: str, checkpoint: str, settings: Settings | None = None, once: bool = True) -> StreamingQuery:
    """Loads what arrives below raw; once: all that is there now, then stops."""

    def load(batch: DataFrame, number: int) -> None:
        # the batch's own rows; nothing else below raw is listed or read
        ingest.run(batch.sparkSession, raw, lake, settings, run_id=f"stream-{number}", discovered=files.described(batch, raw))

    stream = spark.readStream.format("binaryFile").schema(BINARY).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{csv,xlsx,CSV,XLSX}").load(raw)
    writer = stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 minute")).start()
