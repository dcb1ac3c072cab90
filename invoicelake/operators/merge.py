"""Merges as pure functions of two DataFrames. All of them are one join on the key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def require_unique(source: DataFrame, key: str) -> None:
    """A merge source with two rows for one key has no defined result."""
    twice = source.groupBy(key).count().filter("count > 1").limit(5).collect()
    if twice:
        raise ValueError(f"more than one source row for {key} in {sorted(str(r[0]) for r in twice)}")


def unseen(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Source rows whose key the target does not hold."""
    return source.join(target.select(key), key, "left_anti")


def insert_only(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Known keys stay as they are, new keys are added."""
    return target.unionByName(unseen(source, target, key))


def upsert(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Known keys take the source row, new keys are added."""
    return unseen(target, source, key).unionByName(source)


def delete(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Target rows without a partner in the source."""
    return unseen(target, source, key)


def newest_per_key(changes: DataFrame, key: str, version: str) -> DataFrame:
    """The row with the largest version of every key."""
    newest = F.max_by(F.struct(*changes.columns), F.col(version)).alias("row")
    return changes.groupBy(key).agg(newest).select("row.*")


def applied(target: DataFrame, changes: DataFrame, key: str, at: str = "v") -> DataFrame:
    """``target`` after ``changes`` (rows with ``op`` and the version in ``at``). Rows whose key did not change are only read past the changed
    keys; a NULL key is a key like any other."""
    newest = newest_per_key(changes, key, at).filter("op = 'UPSERT'").drop("op", at)
    keys = changes.select(F.col(key).alias("__changed"))
    return target.join(keys, F.col(key).eqNullSafe(F.col("__changed")), "left_anti").unionByName(newest)


def as_of(changes: DataFrame, key: str, version: int, at: str = "v") -> DataFrame:
    """The table after ``version``, from its changes: rows with ``op`` (UPSERT or DELETE) and the version in ``at``."""
    newest = newest_per_key(changes.filter(F.col(at) <= version), key, at)
    return newest.filter("op = 'UPSERT'").drop("op", at)


def history(changes: DataFrame, at: str = "v") -> DataFrame:
    """(version, operation, upserts, deletes), one row per version of the changes."""
    upserts, deletes = F.count_if(F.col("op") == "UPSERT"), F.count_if(F.col("op") == "DELETE")
    return (changes.groupBy(F.col(at).cast("long").alias("version"))
            .agg(upserts.alias("upserts"), deletes.alias("deletes"))
            .select("version", F.when(F.col("version") == 0, "CREATE").when(F.col("deletes") > 0, "DELETE").otherwise("MERGE").alias("operation"),
                    "upserts", "deletes"))
