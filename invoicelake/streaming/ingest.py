"""Registry runs fed by a file stream: the incremental ingest as Structured Streaming.

Spark's file source remembers which files it has handed out, so a run lists only what arrived since the last
one. Deduplication by content stays with the registry, which every micro-batch reads and extends.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from invoicelake.plans.flow import Lake, register_batch
from invoicelake.session import cut_lineage
from invoicelake.sources import files

BINARY_FILE = "path string, modificationTime timestamp, length long, content binary"


def ingest_available(lake: Lake, folder: str, source: str = "scanner_folder") -> StreamingQuery:
    """Register everything that has arrived in ``folder`` and stop.

    A batch that is repeated after a failure changes nothing: its files are in the registry already.
    """
    def one_batch(batch: DataFrame, _: int) -> None:
        prints = cut_lineage(files.fingerprint_files(batch))
        register_batch(lake, prints, source)

    arrived = (lake.spark.readStream.format("binaryFile").schema(BINARY_FILE).load(folder)
               .filter(files.suffix_of("path").isin(files.SUFFIXES)).select("path", "length"))
    return (arrived.writeStream.foreachBatch(one_batch).trigger(availableNow=True)
            .option("checkpointLocation", f"{lake.root}/stream").start())
