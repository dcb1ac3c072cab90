"""Tables that keep their history: an append-only folder of changes, merged snapshots, and a small commit log.

``<path>/data/v=N`` holds the changed rows of version N (``op`` is UPSERT or DELETE) and ``<path>/commits``
one row per finished version. A version counts only once its commit row exists, so a crashed write is
invisible and its folder is simply written again. One writer at a time. Merges never rewrite old files.

Every ``snapshot_every`` versions the whole table is written once more as ``<path>/snapshots/v=N``, finished when
``<path>/snapshot_log`` has its row. A read as of a version takes the newest snapshot up to it (the changes of version 0 are one) and
the folders of the versions in between, at most ``snapshot_every``, whatever the length of the history. Only the keys that changed since the
snapshot are looked for in it; Spark broadcasts them when their files are small, so the snapshot is then read without a shuffle.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from invoicelake.operators.merge import applied, require_unique, unseen

COMMITS = "version long, committed_at timestamp, operation string, upserts long, deletes long"
SNAPSHOTS = "version long"
SNAPSHOT_EVERY = 10


class ChangeTable:
    def __init__(self, spark: SparkSession, path: str, key: str = "doc_id", snapshot_every: int = SNAPSHOT_EVERY):
        self.spark, self.path, self.key, self.snapshot_every = spark, path.rstrip("/"), key, snapshot_every

    # reading

    def _log(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def history(self) -> DataFrame:
        """(version, committed_at, operation, upserts, deletes), one row per commit."""
        return self._log("commits", COMMITS)

    def version(self) -> int:
        """Newest finished version, -1 for a table that does not exist yet."""
        newest = self.history().agg(F.max("version")).first()[0]
        return -1 if newest is None else newest

    def snapshots(self) -> DataFrame:
        """The versions that are also stored as a whole."""
        return self._log("snapshot_log", SNAPSHOTS).distinct()

    def _changes(self, first: int, last: int) -> DataFrame:
        """The changes of some versions, with ``v``; only their folders are listed and read."""
        created = self.spark.read.parquet(f"{self.path}/data/v=0").schema
        folders = [f"{self.path}/data/v={v}" for v in range(first, last + 1)]
        return (self.spark.read.schema(StructType([*created.fields]).add("v", IntegerType()))
                .option("basePath", f"{self.path}/data").parquet(*folders))

    def read(self, version: int | None = None) -> DataFrame:
        """Rows as of ``version`` (newest when left out)."""
        newest = self.version()
        wanted = newest if version is None else version
        if not 0 <= wanted <= newest:
            raise ValueError(f"{self.path} has no version {wanted}; newest is {newest}")
        base = self.snapshots().filter(F.col("version") <= wanted).agg(F.max("version")).first()[0] or 0
        if base:
            rows = self.spark.read.parquet(f"{self.path}/snapshots/v={base}")
        else:
            rows = self._changes(0, 0).filter("op = 'UPSERT'").drop("op", "v")
        return rows if base == wanted else applied(rows, self._changes(base + 1, wanted), self.key)

    # changing

    def _commit(self, changes: DataFrame, operation: str) -> None:
        version = self.version() + 1
        folder = f"{self.path}/data/v={version}"
        changes.write.mode("overwrite").parquet(folder)
        written = self.spark.read.parquet(folder)
        row = written.agg(F.count_if(F.col("op") == "UPSERT").alias("upserts"),
                          F.count_if(F.col("op") == "DELETE").alias("deletes"))
        (row.select(F.lit(version).cast("long").alias("version"), F.current_timestamp().alias("committed_at"),
                    F.lit(operation).alias("operation"), "upserts", "deletes")
         .write.mode("append").parquet(f"{self.path}/commits"))
        if version and version % self.snapshot_every == 0:
            self.snapshot()

    def snapshot(self) -> None:
        """Store the newest version as a whole. A crash on the way leaves no log row, and reads go on from the snapshot before."""
        version = self.version()
        if version > 0 and not self.snapshots().filter(F.col("version") == version).count():
            self.read(version).write.mode("overwrite").parquet(f"{self.path}/snapshots/v={version}")
            self.spark.range(1).select(F.lit(version).cast("long").alias("version")).write.mode("append").parquet(f"{self.path}/snapshot_log")

    def merge(self, source: DataFrame, update: bool = True) -> None:
        """Insert unseen keys; with ``update`` replace rows whose key is known, else leave them untouched."""
        require_unique(source, self.key)
        exists = self.version() >= 0
        changed = unseen(source, self.read(), self.key) if exists and not update else source
        self._commit(changed.withColumn("op", F.lit("UPSERT")), "MERGE" if exists else "CREATE")

    def delete(self, keys: DataFrame) -> None:
        """Remove the rows whose key is in ``keys``; keys the table does not hold are ignored."""
        gone = self.read().join(keys.select(self.key).distinct(), self.key, "left_semi")
        self._commit(gone.withColumn("op", F.lit("DELETE")), "DELETE")
