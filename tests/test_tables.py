import random

import pytest
from pyspark.sql import functions as F

from invoicelake import schemas
from invoicelake.operators import merge
from invoicelake.plans.queries import quarter_spend
from invoicelake.sources import tables
from invoicelake.sources.change_table import ChangeTable

KV = "doc_id string, x int"


def frame(spark, **pairs):
    return spark.createDataFrame(list(pairs.items()), KV)


def test_pure_merges(spark, rows):
    target, source = frame(spark, a=1, b=2), frame(spark, b=20, c=30)
    assert rows(merge.insert_only(target, source, "doc_id")) == [("a", 1), ("b", 2), ("c", 30)]
    assert rows(merge.upsert(target, source, "doc_id")) == [("a", 1), ("b", 20), ("c", 30)]
    assert rows(merge.delete(target, source, "doc_id")) == [("a", 1)]


def test_same_batch_twice_changes_nothing(spark, rows):
    target, source = frame(spark, a=1), frame(spark, a=5, b=6)
    once = merge.upsert(target, source, "doc_id")
    assert rows(merge.upsert(once, source, "doc_id")) == rows(once)


def test_history_and_versions(spark, rows, tmp_path):
    table = ChangeTable(spark, str(tmp_path / "t"))
    assert table.version() == -1
    table.merge(frame(spark, a=1, b=2))
    table.merge(frame(spark, b=20, c=30))
    table.merge(frame(spark, a=100, d=4), update=False)
    table.delete(frame(spark, a=0, zz=0))
    table.merge(frame(spark, a=7))
    assert rows(table.read(0)) == [("a", 1), ("b", 2)]
    assert rows(table.read(1)) == [("a", 1), ("b", 20), ("c", 30)]
    assert rows(table.read(2)) == [("a", 1), ("b", 20), ("c", 30), ("d", 4)]
    assert rows(table.read(3)) == [("b", 20), ("c", 30), ("d", 4)]
    assert rows(table.read()) == [("a", 7), ("b", 20), ("c", 30), ("d", 4)]
    assert rows(table.history(), "version", "operation", "upserts", "deletes") == [
        (0, "CREATE", 2, 0), (1, "MERGE", 2, 0), (2, "MERGE", 1, 0), (3, "DELETE", 0, 1), (4, "MERGE", 1, 0)]
    with pytest.raises(ValueError):
        table.read(9)


def scanned(df):
    """The version folders that the plan of a read names."""
    return sorted({part.rsplit("/", 2)[-2] + "/" + part.rsplit("/", 1)[-1] for file in df.inputFiles() for part in [file.rsplit("/", 1)[0]]})


def test_snapshots_bound_what_a_read_touches(spark, rows, tmp_path):
    """Every version equals a plain dictionary, and no read goes behind the snapshot before it."""
    rng, table, plain, states = random.Random(3), ChangeTable(spark, str(tmp_path / "t"), snapshot_every=3), {}, []
    for version in range(8):
        keys = rng.sample("abcdefghij", 4)
        if version % 4 == 3:
            table.delete(frame(spark, **{k: 0 for k in keys}))
            plain = {k: v for k, v in plain.items() if k not in keys}
        else:
            update = version % 4 != 2
            table.merge(frame(spark, **{k: version for k in keys}), update=update)
            plain = {**plain, **{k: version for k in keys if update or k not in plain}}
        states.append(sorted(plain.items()))
    assert [r[0] for r in sorted(table.snapshots().collect())] == [3, 6]
    for version, state in enumerate(states):
        assert rows(table.read(version)) == state
    assert scanned(table.read(2)) == ["data/v=0", "data/v=1", "data/v=2"]
    assert scanned(table.read(5)) == ["data/v=4", "data/v=5", "snapshots/v=3"]
    assert scanned(table.read()) == ["data/v=7", "snapshots/v=6"]
    assert scanned(table.read(6)) == ["snapshots/v=6"]
    plan = table.read()._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and plan.count("Exchange hashpartitioning") == 1  # only the changes are shuffled, not the snapshot


def test_an_unfinished_snapshot_is_not_read(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    table = ChangeTable(spark, path, snapshot_every=100)
    table.merge(frame(spark, a=1))
    table.merge(frame(spark, b=2))
    frame(spark, zz=9).write.parquet(f"{path}/snapshots/v=1")   # no log row
    assert rows(table.read()) == [("a", 1), ("b", 2)]
    table.snapshot()
    table.snapshot()
    assert scanned(table.read()) == ["snapshots/v=1"] and rows(table.read()) == [("a", 1), ("b", 2)] and table.snapshots().count() == 1


def test_a_null_key_is_a_key(spark, rows, tmp_path):
    table = ChangeTable(spark, str(tmp_path / "t"))
    table.merge(spark.createDataFrame([(None, 1), ("a", 1)], KV))
    table.merge(spark.createDataFrame([(None, 2)], KV))
    assert rows(table.read()) == [("a", 1), (None, 2)]


def test_calendar_filter_prunes_partitions_at_run_time(spark, tmp_path):
    days = spark.range(0, 720).select(F.expr("date_add(date '1996-01-01', int(id))").alias("o_orderdate"), F.col("id").alias("o_orderkey"),
                                      F.lit(1.5).alias("o_totalprice"))
    fact = days.withColumn("order_month", F.trunc("o_orderdate", "month"))
    tables.write_partitioned(fact, str(tmp_path / "f"), "order_month")
    months = fact.select("order_month").distinct().withColumns({"year": F.year("order_month"), "quarter": F.quarter("order_month"),
                                                                "month_name": F.date_format("order_month", "MMMM")})
    tables.overwrite(months, str(tmp_path / "c"))
    out = quarter_spend(tables.snapshot(spark, str(tmp_path / "f")), tables.snapshot(spark, str(tmp_path / "c")), 2)
    assert sum(r["n"] for r in out.collect()) == 2 * 91
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and "PartitionFilters: [isnotnull(order_month" in plan


def test_duplicate_keys_are_rejected_on_create_and_merge(spark, tmp_path):
    table = ChangeTable(spark, str(tmp_path / "t"))
    twice = spark.createDataFrame([("a", 1), ("a", 2)], KV)
    with pytest.raises(ValueError):
        table.merge(twice)
    table.merge(frame(spark, a=1))
    with pytest.raises(ValueError):
        table.merge(twice)


def test_crashed_write_is_invisible(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    table = ChangeTable(spark, path)
    table.merge(frame(spark, a=1))
    frame(spark, a=66, q=1).withColumn("op", F.lit("UPSERT")).write.parquet(f"{path}/data/v=1")   # no commit row
    assert rows(table.read()) == [("a", 1)]
    table.merge(frame(spark, b=2))
    assert rows(table.read()) == [("a", 1), ("b", 2)]


def test_csv_truth_and_nan(spark, tmp_path):
    (tmp_path / "t.csv").write_text("file,invoice_no,vendor_id,vendor_name,gstin,invoice_date,subtotal,gst,total,is_duplicate,"
                                    "is_anomaly\nf.png,INV-1,V1,\"A, B\",27X,2026-01-01,NaN,1.5,2.5,0,1\n")
    r = tables.read_truth_csv(spark, str(tmp_path / "t.csv")).first()
    assert r.vendor_name == "A, B" and r.subtotal is None and r.total == 2.5 and r.is_anomaly == 1


def test_sinks(spark, rows, tmp_path):
    df = frame(spark, a=1, b=2).withColumn("ingest_date", F.lit("2026-01-02").cast("date"))
    tables.write_partitioned(df, str(tmp_path / "p"))
    assert (tmp_path / "p" / "ingest_date=2026-01-02").is_dir()
    tables.overwrite(df, str(tmp_path / "o"))
    tables.overwrite(frame(spark, z=9).withColumnRenamed("x", "y"), str(tmp_path / "o"))     # schema may change
    assert rows(tables.snapshot(spark, str(tmp_path / "o"))) == [("z", 9)]
    tables.write_csv(frame(spark, a=1), str(tmp_path / "c"))
    assert rows(tables.read_typed(spark, str(tmp_path / "c"), KV, "csv", header="true")) == [("a", 1)]
    joined = tables.path_sql(spark, "SELECT p.doc_id, o.y FROM {p} p CROSS JOIN {o} o WHERE p.x = 2",
                             p=str(tmp_path / "p"), o=str(tmp_path / "o"))
    assert rows(joined) == [("b", 9)]
    assert "flags string" in schemas.EXTRACTED
