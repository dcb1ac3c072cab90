"""The registered queries: one per operator, over whole tables of a folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from invoicelake import schemas
from invoicelake.plans import fixtures as fx
from invoicelake.functions import text as T
from invoicelake.operators import (anomalies, classify, duplicates, evaluation, extract, gold, images, labels, merge,
                                   metrics, ocr, registry, silver, splits)
from invoicelake.plans import flow
from invoicelake.session import cut_lineage, shared_folder
from invoicelake.sources import files, registry_store, tables
from invoicelake.sources.change_table import ChangeTable

AS_OF = "2000-01-01"
CALENDAR = ("1995-01-01", "2001-12-31")
RUN_TIME = "2026-01-02T03:04:05+00:00"
FIRST_SOURCES = ["src0", "src1", "src2"]       # sources registered by an earlier run
Z_SCORES = ["global_z", "vendor_z"]

QUERIES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def scratch(spark: SparkSession) -> str:
    """A new folder below the shared checkpoint folder of the session."""
    return f"{shared_folder(spark)}/invoicelake-{uuid.uuid4().hex}"


# ---- inputs shared by several queries

def silver_checked(spark, d) -> DataFrame:
    joined = silver.join_bronze(fx.extracted(spark, d), fx.registry(spark, d), fx.image_quality(spark, d))
    return silver.with_reasons(joined, AS_OF)


def invoices(spark, d) -> DataFrame:
    return silver.good_rows(silver_checked(spark, d))


def graded(spark, d) -> DataFrame:
    truth = fx.truth(spark, d).drop("k", "c", "d", "sub_c", "gst_c", "doc_id")
    return evaluation.with_truth(fx.extracted(spark, d), fx.registry(spark, d), truth)


def loaded(spark, d) -> DataFrame:
    return evaluation.labelled(fx.extracted(spark, d), fx.registry(spark, d), fx.truth(spark, d))


def fields(spark, d) -> DataFrame:
    rows = fx.ocr_text(spark, d)
    return rows.select("doc_id", *[c.alias(n) for n, c in extract.printed_fields().items()])


def document_files(spark, d) -> DataFrame:
    path = F.concat("source", F.lit("/"), F.lpad(F.col("doc_id").cast("string"), 8, "0"), F.lit(".PDF"))
    return fx.table(spark, d, "documents").select(path.alias("path"), F.encode("text", "UTF-8").alias("content"), "source")


def prints_and_registry(spark, d) -> tuple[DataFrame, DataFrame]:
    """Fingerprints of all documents, and the registry an earlier run over some sources left behind."""
    rows = document_files(spark, d)
    prints = cut_lineage(files.fingerprint_content(rows))
    earlier = files.fingerprint_content(rows.filter(F.col("source").isin(FIRST_SOURCES)))
    empty = spark.createDataFrame([], "doc_id string, source_path string, sha256 string, status string")
    return prints, cut_lineage(registry.register(earlier, empty, run_time=RUN_TIME))


def registered(spark, d) -> DataFrame:
    prints, known = prints_and_registry(spark, d)
    return registry.register(prints, known, run_time=RUN_TIME)


def order_batches(spark, d) -> tuple[DataFrame, DataFrame]:
    """Orders up to 1998 as the target; a later load from 1997 on with changed totals."""
    orders = fx.table(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"), "o_orderstatus",
                                                 "o_totalprice")
    later = orders.filter("year >= 1997").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    return orders.filter("year <= 1998"), later


def order_changes(spark, d) -> DataFrame:
    """The changes of three versions: create, upsert, delete of the orders with status F."""
    target, later = order_batches(spark, d)
    steps = [(target, "UPSERT"), (later, "UPSERT"), (later.filter("o_orderstatus = 'F'"), "DELETE")]
    out = None
    for version, (rows, op) in enumerate(steps):
        rows = rows.withColumn("op", F.lit(op)).withColumn("v", F.lit(version))
        out = rows if out is None else out.unionByName(rows)
    return out


def quality_scores(spark, d) -> DataFrame:
    docs = fx.table(spark, d, "documents").select("doc_id", F.col("n_chars").cast("double").alias("score"))
    return docs.join(fx.table(spark, d, "labels").select("doc_id", "quality"), "doc_id")


def class_predictions(spark, d) -> DataFrame:
    vec = fx.table(spark, d, "embeddings")
    return vec.select(
        F.concat(F.lit("cond"), (F.col("vec_id") % 2).cast("string")).alias("condition"),
        F.concat(F.lit("model"), (F.col("vec_id") % 3 % 2).cast("string")).alias("model"),
        (F.col("vec_id") % 5).cast("string").alias("seed"), "label",
        F.expr("CASE WHEN vec_id % 6 = 0 THEN (label + 1) % 10 ELSE label END").alias("prediction"))


def prepared(spark, d) -> DataFrame:
    return cut_lineage(duplicates.prepare(loaded(spark, d)))


def anomaly_features(spark, d) -> DataFrame:
    return cut_lineage(anomalies.features(anomaly_rows(spark, d)))


def anomaly_rows(spark, d) -> DataFrame:
    """Amounts of all scans as a stored table; missing fields are left to the filter."""
    return cut_lineage(loaded(spark, d).select("doc_id", "vendor_id", "total", "is_duplicate", "is_anomaly"))


# ---- sources, tables, merges

@query
def src_typed_table(spark, d):
    schema = "l_orderkey long, l_returnflag string, l_discount double, l_quantity double"
    rows = tables.read_typed(spark, f"{d}/lineitem.parquet", schema)
    gaps = tables.nan_to_null(rows.withColumn("l_discount", F.expr("if(l_discount = 0, double('NaN'), l_discount)")))
    return gaps.groupBy("l_returnflag").agg(F.count("*").alias("n"), F.count("l_discount").alias("with_discount"),
                                            F.min("l_discount").alias("smallest"), F.max("l_quantity").alias("largest"))


@query
def src_snapshot(spark, d):
    return tables.snapshot(spark, f"{d}/orders.parquet").groupBy("o_orderstatus").agg(
        F.count("*").alias("n"), F.max("o_totalprice").alias("largest"))


@query
def src_path_sql(spark, d):
    return tables.path_sql(spark, """
        SELECT c_mktsegment AS segment, count(*) AS orders, CAST(sum(CAST(o_totalprice AS decimal(24, 2))) AS double) AS spend
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey GROUP BY c_mktsegment""",
        orders=f"{d}/orders.parquet", customer=f"{d}/customer.parquet")


def truth_columns(spark, d) -> DataFrame:
    return fx.truth(spark, d).select("file", "invoice_no", "vendor_id", "vendor_name", "gstin", "invoice_date", "subtotal",
                                     "gst", "total", "is_duplicate", "is_anomaly")


@query
def src_csv_truth(spark, d):
    """The answer key written as CSV and read back with its declared schema."""
    path = scratch(spark)
    tables.write_csv(truth_columns(spark, d), path)
    return tables.read_truth_csv(spark, path)


@query
def src_csv_quarantine(spark, d):
    """The answer key as CSV with copies' lines once more, their subtotal unreadable: rows that fit, and the lines that do not."""
    path = scratch(spark)
    rows = truth_columns(spark, d)
    tables.write_csv(rows, path)
    bad = rows.filter("is_duplicate = 1").withColumn("subtotal", F.concat(F.lit("Rs "), F.col("subtotal").cast("string")))
    bad.write.mode("append").csv(path, header=True)
    good, quarantine = tables.read_csv_checked(spark, path, schemas.TRUTH)
    return good.select("file", "subtotal", F.lit(True).alias("kept"), F.lit(False).alias("told")).unionByName(quarantine.select(
        F.element_at(F.split("line", ","), 1).alias("file"), F.lit(None).cast("double").alias("subtotal"), F.lit(False).alias("kept"),
        F.contains("line", F.lit(",Rs ")).alias("told")))


@query
def snk_csv(spark, d):
    """A report per file and version, written as CSV and read back."""
    path = scratch(spark)
    report = ev_ocr_contains(spark, d)
    tables.write_csv(report, path)
    return spark.read.schema(report.schema).csv(path, header=True)


@query
def snk_partitioned(spark, d):
    path = scratch(spark)
    rows = fx.registry(spark, d).withColumn("ingest_date", silver.ingest_date())
    tables.write_partitioned(rows, path)
    return tables.snapshot(spark, path).groupBy("ingest_date").agg(F.count("*").alias("n"))


@query
def snk_partitioned_pruned(spark, d):
    """A star join over a table stored by month: the filter on the calendar's quarter prunes the months at run time."""
    fact, calendar = scratch(spark), scratch(spark)
    month = F.trunc("o_orderdate", "month")
    orders = fx.table(spark, d, "orders")
    tables.write_partitioned(orders.select("o_orderkey", "o_totalprice", "o_orderdate", month.alias("order_month")), fact, "order_month")
    days = gold.dim_date(spark, "1990-01-01", "2005-12-31")
    tables.overwrite(days.filter(F.dayofmonth("date") == 1).select(F.col("date").alias("order_month"), "year", "quarter", "month_name"), calendar)
    return quarter_spend(tables.snapshot(spark, fact), tables.snapshot(spark, calendar), 4)


def quarter_spend(fact, calendar, quarter: int) -> DataFrame:
    return (fact.join(calendar.filter(F.col("quarter") == quarter), "order_month").groupBy("year", "month_name")
            .agg(F.count("*").alias("n"), F.sum(F.col("o_totalprice").cast("decimal(24, 2)")).cast("double").alias("spend")))


@query
def snk_overwrite(spark, d):
    """A rebuilt table replaces the old rows and columns."""
    path = scratch(spark)
    tables.overwrite(fx.extracted(spark, d), path)
    tables.overwrite(fx.extracted(spark, d).filter("needs_review = 1").select("doc_id", "flags"), path)
    return tables.snapshot(spark, path)


@query
def merge_insert_only(spark, d):
    return merge.insert_only(*order_batches(spark, d), "o_orderkey")


@query
def merge_upsert(spark, d):
    return merge.upsert(*order_batches(spark, d), "o_orderkey")


@query
def merge_delete(spark, d):
    return merge.delete(*order_batches(spark, d), "o_orderkey")


@query
def table_history(spark, d):
    return merge.history(order_changes(spark, d))


@query
def table_version_as_of(spark, d):
    changes, out = order_changes(spark, d), None
    for version in range(3):
        rows = merge.as_of(changes, "o_orderkey", version).agg(
            F.count("*").alias("n"), F.max("o_totalprice").alias("largest"), F.sum("o_orderkey").alias("keys"))
        rows = rows.select(F.lit(version).alias("version"), "*")
        out = rows if out is None else out.unionByName(rows)
    return out


def stored_orders(spark, d) -> ChangeTable:
    """Five versions of a stored table: created, updated, deleted from, missing rows added, updated again; a snapshot after every second."""
    target, later = order_batches(spark, d)
    orders = fx.table(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"), "o_orderstatus", "o_totalprice")
    stored = ChangeTable(spark, scratch(spark), "o_orderkey", snapshot_every=2)
    stored.merge(target)
    stored.merge(later)
    stored.delete(later.filter("o_orderstatus = 'F'"))
    stored.merge(orders, update=False)
    stored.merge(orders.filter("o_orderstatus = 'P'").withColumn("o_totalprice", F.col("o_totalprice") + 1))
    return stored


@query
def table_stored_history(spark, d):
    """The commit log of the stored table, and which versions are stored as a whole."""
    stored = stored_orders(spark, d)
    whole = stored.snapshots().select("version", F.lit(True).alias("whole"))
    return (stored.history().drop("committed_at").join(whole, "version", "left")
            .withColumn("whole", F.coalesce("whole", F.lit(False))))


@query
def table_stored_as_of(spark, d):
    """Every version read back, from the snapshot before it and the changes since."""
    stored, out = stored_orders(spark, d), None
    for version in range(stored.version() + 1):
        rows = stored.read(version).groupBy("o_orderstatus").agg(
            F.count("*").alias("n"), F.max("o_totalprice").alias("largest"), F.sum("o_orderkey").alias("keys"),
            F.sum(F.col("o_totalprice").cast("decimal(24, 2)")).cast("double").alias("spend"))
        rows = rows.select(F.lit(version).alias("version"), "*")
        out = rows if out is None else out.unionByName(rows)
    return out


# ---- registry and OCR words

@query
def ing_fingerprint(spark, d):
    return files.fingerprint_content(document_files(spark, d)).select("path", "length", "sha256")


@query
def ing_skip_seen(spark, d):
    return registry.skip_seen(*prints_and_registry(spark, d)).select("path", "sha256")


@query
def ing_skip_seen_stored(spark, d):
    """The new files against a registry stored by digest prefix: only the partitions a batch touches are read."""
    prints, known = prints_and_registry(spark, d)
    path = scratch(spark)
    registry_store.append(known, path)
    return registry.skip_seen(prints, registry_store.touched(spark, path, prints)).select("path", "sha256")


@query
def ing_register_stored(spark, d):
    """The files registered in two runs through the stored registry; what it holds after each, by status."""
    path, out = scratch(spark), None
    first = F.col("source").isin(FIRST_SOURCES)
    prints = cut_lineage(files.fingerprint_content(document_files(spark, d)))
    earlier = files.fingerprint_content(document_files(spark, d).filter(first))
    registry_store.append(spark.createDataFrame([], schemas.DOCUMENTS), path)
    for run, batch in enumerate((earlier, prints)):
        registry_store.append(registry.register(batch, registry_store.touched(spark, path, batch), run_time=RUN_TIME), path)
        held = cut_lineage(registry_store.read(spark, path).groupBy("status").agg(F.count("*").alias("n"), F.countDistinct("sha256").alias("contents"),
                                                                       F.countDistinct("duplicate_of").alias("originals")))
        held = held.select(F.lit(run).alias("run"), "*")
        out = held if out is None else out.unionByName(held)
    return out


@query
def ing_exact_duplicate(spark, d):
    return registered(spark, d).select("source_path", "status", "duplicate_of")


@query
def ing_registry_row(spark, d):
    return registered(spark, d)


@query
def ing_counts(spark, d):
    prints, known = prints_and_registry(spark, d)
    return registry.run_counts(prints, cut_lineage(registry.register(prints, known, run_time=RUN_TIME)))


@query
def inc_pending(spark, d):
    return registry.pending(fx.registry(spark, d), fx.image_quality(spark, d)).select("doc_id", "bronze_path")


@query
def ocr_aggregate(spark, d):
    documents = fx.table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("doc_id"))
    return ocr.aggregate_words(fx.words(spark, d), documents).withColumn("mean_conf", F.round("mean_conf", 9))


# ---- files on disk: the texts of all documents, written by the tasks

def written_files(spark, d) -> str:
    """A new shared folder with one file per document; half of them a folder deeper."""
    folder = f"{scratch(spark)}/scans"
    rows = document_files(spark, d).select("path", "content")
    files.write_files(rows.withColumn("path", F.concat(F.lit(f"{folder}/"), F.regexp_replace("path", "/0", "/a b/0"))))
    return folder


def below(folder, column="path"):
    """Path below ``folder``, as the listing gives it."""
    return F.substring(F.col(column), len(files.normal_path(folder)) + 2, 1000)


@query
def src_files(spark, d):
    folder = written_files(spark, d)
    return files.list_files(spark, folder).select(below(folder).alias("path"), "length")


@query
def ing_failed_row(spark, d):
    """Files on disk and one per source that has gone; the gone ones keep a FAILED row."""
    folder = written_files(spark, d)
    gone = document_files(spark, d).select("source").distinct().select(
        F.concat(F.lit(f"{files.normal_path(folder)}/"), "source", F.lit("/gone.pdf")).alias("path"), F.lit(1).cast("long").alias("length"))
    prints = files.fingerprint_files(files.list_files(spark, folder).unionByName(gone))
    empty = spark.createDataFrame([], "doc_id string, source_path string, sha256 string, status string")
    rows = registry.register(cut_lineage(prints), empty, run_time=RUN_TIME)
    return rows.select(below(folder, "source_path").alias("path"), "status", "sha256", F.col("error_message").isNotNull().alias("has_error"))


@query
def snk_landing(spark, d):
    """The bytes of new files, landed twice: the second time changes nothing."""
    folder, landing = written_files(spark, d), scratch(spark)
    prints = cut_lineage(files.fingerprint_files(files.list_files(spark, folder)))
    empty = spark.createDataFrame([], "doc_id string, source_path string, sha256 string, status string")
    rows = cut_lineage(registry.register(prints, empty, run_time=RUN_TIME))
    for _ in range(2):
        files.land(rows, landing)
    landed = files.landed(spark, landing).join(rows.select("doc_id", "source_path"), "doc_id")
    return landed.select(below(folder, "source_path").alias("path"), F.sha2("content", 256).alias("sha256"), "ingest_date")


# ---- image measurements

@query
def src_images(spark, d):
    """Pictures written as files and read by Spark's image source; one file is no picture and keeps a row."""
    folder = f"{scratch(spark)}/pictures"
    rows = fx.pictures(spark, d).select(F.concat(F.lit(f"{folder}/"), "vec_id", F.lit(".png")).alias("path"), fx.png("height", "width", "data").alias("content"))
    broken = spark.range(1).select(F.lit(f"{folder}/broken.png").alias("path"), F.lit(b"no picture").alias("content"))
    files.write_files(rows.unionByName(broken))
    found = files.read_images(spark, folder).withColumns({"h": F.col("height"), "w": F.col("width")})
    return images.measure(found, "gray").select(files.file_name_of("path").alias("file"), F.col("h").alias("height"), F.col("w").alias("width"),
                                                "gray_sum", "gray_mark", F.col("error").isNotNull().alias("broken"))


@query
def img_gray(spark, d):
    """Grey pages, half of them from coloured ones."""
    return images.measure(fx.pages(spark, d), "gray").select("page", "gray_sum", "gray_mark")


@query
def img_contrast(spark, d):
    return images.measure(fx.pages(spark, d), "contrast").select("page", "contrast_sum", "contrast_mark")


@query
def img_skew_angle(spark, d):
    """Pages whose lines rise or fall."""
    return images.measure(fx.turned(spark, d), "skew_angle").select("page", "skew_angle")


@query
def img_blur_score(spark, d):
    return images.measure(fx.pictures(spark, d), "blur_score").select("vec_id", F.round("blur_score", 6).alias("blur_score"))


@query
def img_otsu(spark, d):
    """Threshold of the stretched grey picture."""
    return images.measure(fx.pictures(spark, d), "otsu").select("vec_id", "otsu")


@query
def img_content_box(spark, d):
    return images.measure(fx.pictures(spark, d), "content_box").select("vec_id", "x0", "y0", "x1", "y1")


@query
def img_pool_features(spark, d):
    measured = images.measure(fx.pictures(spark, d), "features").select("vec_id", F.posexplode("features").alias("cell", "ink"))
    return measured.select("vec_id", "cell", F.round(F.col("ink").cast("double"), 4).alias("ink"))


@query
def img_page_box(spark, d):
    """Composed pages with margins, half of them coloured."""
    return images.measure(fx.pages(spark, d), "otsu", "content_box").select("page", "otsu", "x0", "y0", "x1", "y1")


@query
def img_page_features(spark, d):
    """The pages reduced by area from 256 to 128 pixels a side."""
    measured = images.measure(fx.pages(spark, d), "features").select("page", F.posexplode("features").alias("cell", "ink"))
    return measured.select("page", "cell", F.round(F.col("ink").cast("double"), 4).alias("ink"))


@query
def img_quality_job(spark, d):
    """Vectors with label 0 have been measured before."""
    rows = fx.pictures(spark, d).withColumnRenamed("vec_id", "doc_id")
    all_vectors = fx.table(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), "label")
    registry_rows = all_vectors.select("doc_id", F.lit("INGESTED").alias("status"))
    good, _ = images.quality_job(registry_rows, rows, all_vectors.filter("label = 0"))
    return good.select("doc_id", "skew_angle", F.round("blur_score", 6).alias("blur_score"))


@query
def img_quality_rows(spark, d):
    """The exact part of ``img_quality_job``: which pictures are measured, and their blur."""
    return img_quality_job(spark, d).select("doc_id", "blur_score")


# ---- field extraction

def _field(name):
    def run(spark, d):
        return fields(spark, d).select("doc_id", name)
    run.__name__ = f"fx_{name}"
    query(run)


for _name in ("invoice_no", "invoice_date", "gstin", "subtotal", "gst", "total"):
    _field(_name)


@query
def fx_amount(spark, d):
    printed = F.concat(F.lit("x Rs. "), T.printed_amount(F.col("l_extendedprice")))
    return fx.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber",
                                                 T.first_amount(printed, r"x\s*").alias("amount"))


@query
def fx_vendor_match(spark, d):
    rows = fx.ocr_text(spark, d).select("doc_id", T.vendor_header(F.col("text")).alias("header"))
    found = extract.match_vendors(rows, "header", extract.vendor_master(fx.truth(spark, d)))
    return found.select("doc_id", "vendor_id", "vendor_name", F.round("vendor_match", 9).alias("vendor_match"))


@query
def fx_vendor_match_spellings(spark, d):
    rows = fx.headers(spark, d).select("header_id", T.vendor_header(F.col("text")).alias("header"))
    return extract.match_vendors(rows, "header", fx.part_vendors(spark, d)).drop("header")


@query
def fx_vendor_match_exact(spark, d):
    """Every header: its vendor where it is spelled like a name apart from case and the invoice title, otherwise only that it has a score below 1."""
    rows = fx.headers(spark, d).select("header_id", T.vendor_header(F.col("text")).alias("header"))
    found = extract.match_vendors(rows, "header", fx.part_vendors(spark, d))
    certain = F.col("vendor_match") == 1
    return found.select("header_id", F.when(certain, F.col("vendor_id")).alias("vendor_id"), certain.alias("certain"),
                        F.col("vendor_match").between(0, 1).alias("scored"))


@query
def fx_vendor_match_none(spark, d):
    """Headers that resemble no name: no vendor, and a score below the threshold."""
    rows = fx.table(spark, d, "part").select(F.col("p_partkey").alias("header_id"), F.concat(F.lit("98-76 "), "p_partkey", F.lit(" 54-32")).alias("header"))
    found = extract.match_vendors(rows, "header", fx.part_vendors(spark, d))
    return found.select("header_id", "vendor_id", (F.col("vendor_match") < extract.VENDOR_THRESHOLD).alias("low"))


@query
def fx_vendor_match_in_parts(spark, d):
    """The same search split into more and smaller tasks."""
    rows = fx.ocr_text(spark, d).select("doc_id", T.vendor_header(F.col("text")).alias("header"))
    found = extract.match_vendors(rows, "header", extract.vendor_master(fx.truth(spark, d)), names_per_task=500, headers_per_task=500)
    return found.select("doc_id", "vendor_id", "vendor_name", F.round("vendor_match", 9).alias("vendor_match"))


@query
def fx_vendor_master(spark, d):
    return extract.vendor_master(fx.truth(spark, d))


@query
def fx_flags(spark, d):
    return fx.extracted(spark, d).select("doc_id", F.array_join(extract.flags(), ",").alias("flags"))


@query
def fx_record(spark, d):
    rows = extract.records(fx.ocr_text(spark, d), extract.vendor_master(fx.truth(spark, d)))
    return rows.withColumn("vendor_match", F.round("vendor_match", 9))


# ---- silver

@query
def slv_filter_ingested(spark, d):
    return silver.ingested_only(fx.registry(spark, d)).select("doc_id", "file_name", "status")


@query
def slv_join(spark, d):
    return silver.join_bronze(fx.extracted(spark, d), fx.registry(spark, d), fx.image_quality(spark, d)).select(
        "doc_id", "file_name", "sha256", "ingest_date", "skew_angle", "blur_score", "invoice_no", "total")


@query
def slv_parse_date(spark, d):
    return fx.extracted(spark, d).select("doc_id", silver.parse_date("invoice_date").alias("invoice_date"))


@query
def slv_ingest_date(spark, d):
    return fx.registry(spark, d).select("doc_id", silver.ingest_date().alias("ingest_date"))


@query
def slv_stamp(spark, d):
    """The stamp is the time of the run; told is whether a row has it."""
    return silver.stamped(fx.extracted(spark, d).select("doc_id")).select("doc_id", F.col("processed_at").isNotNull().alias("stamped"))


@query
def slv_dq_reasons(spark, d):
    return silver_checked(spark, d).select("doc_id", "dq_reasons")


@query
def slv_split(spark, d):
    checked = silver_checked(spark, d)
    good = silver.good_rows(checked).select("doc_id", F.lit("invoices").alias("side"))
    return good.unionByName(silver.bad_rows(checked).select("doc_id", F.lit("quarantine").alias("side")))


@query
def slv_release(spark, d):
    """Rows held back on the given day, without those that pass two years later."""
    joined = silver.join_bronze(fx.extracted(spark, d), fx.registry(spark, d), fx.image_quality(spark, d))
    held = silver.bad_rows(silver.with_reasons(joined, AS_OF))
    good = silver.good_rows(silver.with_reasons(joined, "2002-01-01"))
    return silver.release(held, good).select("doc_id", "dq_reasons")


@query
def slv_preview(spark, d):
    return silver.preview(silver.bad_rows(silver_checked(spark, d)))


# ---- gold

@query
def gld_fact(spark, d):
    return gold.fact_invoices(invoices(spark, d))


@query
def gld_dim_vendor(spark, d):
    return gold.dim_vendor(invoices(spark, d))


@query
def gld_dim_date(spark, d):
    days = fx.table(spark, d, "orders").agg(F.min("o_orderdate").cast("date"), F.max("o_orderdate").cast("date")).first()
    return gold.dim_date(spark, days[0], days[1])


@query
def gld_vendor_monthly(spark, d):
    return gold.vendor_monthly(gold.fact_invoices(invoices(spark, d)), gold.dim_date(spark, *CALENDAR))


@query
def rpt_top_vendors(spark, d):
    good = invoices(spark, d)
    return gold.top_vendors(gold.fact_invoices(good), gold.dim_vendor(good))


@query
def rpt_spend_from_text(spark, d):
    """The whole way from printed text to the report."""
    master = extract.vendor_master(fx.truth(spark, d))
    return flow.spend_report(fx.ocr_text(spark, d), master, fx.registry(spark, d), fx.image_quality(spark, d), AS_OF)


# ---- duplicates

@query
def ml_load(spark, d):
    return loaded(spark, d).select("doc_id", "file_name", "invoice_no", "invoice_no_gt", "total", "is_duplicate", "is_anomaly")


@query
def dup_prepare(spark, d):
    return duplicates.prepare(loaded(spark, d))


@query
def dup_block_pairs(spark, d):
    rows = duplicates.vendor_pairs(duplicates.prepare(loaded(spark, d)))
    return rows.select("vendor_id", "documents", F.col("pairs").cast("long").alias("pairs"),
                       F.col("true_pairs").cast("long").alias("true_pairs"))


@query
def dup_features(spark, d):
    """Pairs of records with the number of document pairs behind them; a repeated record is paired with itself."""
    rows = cut_lineage(duplicates.profiles(duplicates.prepare(loaded(spark, d))))
    return duplicates.counted_pairs(rows, 0.2, 60).select(
        "doc_a", "doc_b", F.col("pairs").cast("long").alias("pairs"), F.round("amount_diff", 9).alias("amount_diff"), "date_gap", "is_dup")


@query
def dup_gap_classes(spark, d):
    """All pairs by date gap and answer key."""
    return duplicates.gap_classes(prepared(spark, d)).select("date_gap", "is_dup", F.col("pairs").cast("long").alias("pairs"))


@query
def dup_features_similarity(spark, d):
    rows = cut_lineage(duplicates.profiles(duplicates.prepare(loaded(spark, d))))
    return duplicates.counted_pairs(rows, 0.5, 365)


@query
def dup_exact_rule(spark, d):
    return duplicates.exact_rule_groups(duplicates.prepare(loaded(spark, d)))


@query
def dup_report(spark, d):
    report = duplicates.exact_rule_report(prepared(spark, d))
    whole = [F.col(c).cast("long").alias(c) for c in ("pairs", "true_pairs", "caught", "false_alarms", "missed")]
    return report.select(*whole, *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")])


@query
def dup_training_weights(spark, d):
    """What the model is fitted on stands for all pairs: their number and the number of true ones."""
    rows = cut_lineage(duplicates.profiles(prepared(spark, d)))
    pairs = duplicates.with_weights(duplicates.training_pairs(rows), duplicates.profile_pairs(rows))
    return pairs.agg(F.round(F.sum("weight")).cast("long").alias("pairs"),
                     F.round(F.sum(F.when(F.col("is_dup") == 1, F.col("weight")))).cast("long").alias("true_pairs"))


@query
def dup_flagged_copies(spark, d):
    """Every planted copy and whether the flagged pairs hold it, with the numbers of planted, caught and missed ones and whether other flagged pairs are few."""
    docs = prepared(spark, d)
    original, copy = docs.select(F.col("doc_id").alias("doc_a"), F.concat("doc_id", F.lit("C")).alias("doc_b")), docs.select(F.col("doc_id").alias("doc_b"))
    planted = original.join(copy, "doc_b")
    flagged = cut_lineage(duplicates.detect(docs).flagged)
    copied = F.col("doc_b") == F.concat("doc_a", F.lit("C"))

    def share(kind):
        """Other pairs count once per pair of records, however many documents are behind it."""
        return F.coalesce(F.sum(F.when(kind, F.when(copied, 1.0).otherwise(1 / (F.col("docs_a") * F.col("docs_b"))))), F.lit(0.0))

    found = flagged.filter(copied).select("doc_a", "doc_b", F.lit(True).alias("hit")).distinct()
    marked = cut_lineage(planted.join(found, ["doc_a", "doc_b"], "left").select("doc_a", "doc_b", F.col("hit").isNotNull().alias("flagged")))
    counts = marked.agg(F.count("*").alias("planted"), F.count_if("flagged").alias("caught")).join(
        flagged.agg(share(F.lit(True)).alias("all"), share(~copied).alias("others")))
    return marked.join(F.broadcast(counts)).select("doc_a", "doc_b", "flagged", "planted", "caught", (F.col("planted") - F.col("caught")).alias("missed"),
                                                   (F.col("others") * 20 <= F.col("all")).alias("few_others"))


@query
def dup_model_cv(spark, d):
    return duplicates.detect(prepared(spark, d)).report


@query
def dup_flagged(spark, d):
    return duplicates.detect(prepared(spark, d)).flagged


# ---- anomalies

@query
def ano_filter(spark, d):
    return anomalies.filter_counts(anomaly_rows(spark, d))


@query
def ano_log_total(spark, d):
    rows = anomalies.with_log_total(anomalies.scorable(anomaly_rows(spark, d)))
    return rows.select("doc_id", F.round("log_total", 9).alias("log_total"))


@query
def ano_vendor_z(spark, d):
    rows = anomalies.with_vendor_z(anomalies.with_log_total(anomalies.scorable(anomaly_rows(spark, d))))
    return rows.select("doc_id", F.round("vendor_z", 6).alias("vendor_z"))


@query
def ano_global_z(spark, d):
    return anomalies.with_global_z(anomalies.scorable(anomaly_rows(spark, d))).select(
        "doc_id", F.round("global_z", 6).alias("global_z"))


def iso_scored(spark, d) -> DataFrame:
    """Rows with iso_score; features and scores in fixed digits, so that cuts and ranks do not hang on the last bit of a logarithm."""
    rows = anomaly_features(spark, d).withColumns({c: F.round(c, 6) for c in ("log_total", *Z_SCORES)})
    return cut_lineage(anomalies.with_iso_score(cut_lineage(rows)).withColumn("iso_score", F.round("iso_score", 9)))


@query
def ano_isolation_forest(spark, d):
    return iso_scored(spark, d).select("doc_id", "is_anomaly", "iso_score")


@query
def ano_review_budget(spark, d):
    rows = anomalies.with_global_z(anomalies.scorable(anomaly_rows(spark, d)))
    return metrics.within_budget(rows, "global_z", anomalies.REVIEW_BUDGET).select("doc_id", "flagged")


@query
def ano_scores(spark, d):
    return anomalies.scores(iso_scored(spark, d))


@query
def ano_compare(spark, d):
    rows = anomalies.features(anomaly_rows(spark, d))
    rows = cut_lineage(rows.withColumns({c: F.round(c, 6) for c in Z_SCORES}))
    table = anomalies.compare(rows, Z_SCORES)
    return table.select("score", "k", "budget", *[F.round(c, 9).alias(c) for c in
                                                  ("roc_auc", "avg_precision", "precision_at_k", "recall_at_budget")])


@query
def ano_compare_forest(spark, d):
    table = anomalies.compare(iso_scored(spark, d), [*Z_SCORES, "iso_score"])
    return table.select("score", "k", "budget", *[F.round(c, 9).alias(c) for c in
                                                  ("roc_auc", "avg_precision", "precision_at_k", "recall_at_budget")])


# ---- metrics

@query
def met_roc_auc(spark, d):
    return metrics.roc_auc(quality_scores(spark, d), "score", "quality").select(F.round("roc_auc", 9).alias("roc_auc"))


@query
def met_avg_precision(spark, d):
    return metrics.average_precision(quality_scores(spark, d), "score", "quality").select(
        F.round("avg_precision", 9).alias("avg_precision"))


@query
def met_precision_at_k(spark, d):
    return metrics.precision_at_k(quality_scores(spark, d), "score", "quality", "doc_id").select(
        "k", F.round("precision_at_k", 9).alias("precision_at_k"))


@query
def met_recall_at_budget(spark, d):
    return metrics.recall_at_budget(quality_scores(spark, d), "score", "quality", "doc_id", 0.05).select(
        "budget", F.round("recall_at_budget", 9).alias("recall_at_budget"))


@query
def met_accuracy_macro_f1(spark, d):
    return metrics.accuracy_macro_f1(class_predictions(spark, d), ["model", "condition", "seed"]).select(
        "model", "condition", "seed", F.round("acc", 9).alias("acc"), F.round("macro_f1", 9).alias("macro_f1"))


@query
def met_confusion(spark, d):
    return metrics.confusion(class_predictions(spark, d), by=["condition"])


@query
def met_confusion_matrix(spark, d):
    return metrics.confusion_matrix(class_predictions(spark, d), list(range(10)))


@query
def met_mean_std(spark, d):
    runs = metrics.accuracy_macro_f1(class_predictions(spark, d), ["model", "condition", "seed"])
    return metrics.mean_std(runs, ["acc", "macro_f1"], ["model", "condition"])


@query
def met_improvement(spark, d):
    runs = metrics.accuracy_macro_f1(class_predictions(spark, d), ["model", "condition", "seed"])
    table = metrics.improvement(runs, "model", "acc", "model0")
    return table.select("model", *[F.round(c, 6).alias(c) for c in table.columns if c != "model"])


# ---- evaluation reports

@query
def ev_counts(spark, d):
    return evaluation.stage_counts(fx.registry(spark, d), fx.image_quality(spark, d), fx.ocr_text(spark, d))


@query
def ev_missing_share(spark, d):
    return evaluation.missing_share(fx.extracted(spark, d))


@query
def ev_top_flags(spark, d):
    return evaluation.top_flags(fx.extracted(spark, d))


@query
def ev_describe(spark, d):
    return evaluation.describe(fx.extracted(spark, d), "mean_conf")


@query
def ev_describe_amounts(spark, d):
    return evaluation.describe(fx.table(spark, d, "lineitem"), "l_quantity")


@query
def ev_failing_example(spark, d):
    return evaluation.failing_example(fx.extracted(spark, d), fx.ocr_text(spark, d))


@query
def ev_mismatches(spark, d):
    return evaluation.mismatch_counts(graded(spark, d))


@query
def ev_mismatch_examples(spark, d):
    return evaluation.mismatch_examples(graded(spark, d)).select("field", "doc_id")


@query
def ev_field_accuracy(spark, d):
    return evaluation.field_accuracy(graded(spark, d))


@query
def ev_straight_through(spark, d):
    table = evaluation.straight_through(graded(spark, d))
    return table.select(*[F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in table.dtypes])


@query
def ev_hybrid(spark, d):
    return evaluation.hybrid(fx.extracted(spark, d), fx.second_model(spark, d))


@query
def ev_prediction_normalise(spark, d):
    return evaluation.normalise_entities(fx.entities(spark, d))


@query
def ev_prediction_vendors(spark, d):
    return evaluation.normalise_entities(fx.entities(spark, d), extract.vendor_master(fx.truth(spark, d)))


@query
def ev_model_compare(spark, d):
    rules, other, truth = fx.extracted(spark, d), fx.second_model(spark, d), fx.truth(spark, d)
    models = {"rules": rules, "other": other, "hybrid": evaluation.hybrid(rules, other)}
    table = evaluation.compare_models(models, truth, splits.group_split(truth))
    return table.select("model", *[F.round(c, 9).alias(c) for c in table.columns if c != "model"])


def _ocr_versions(spark, d):
    versions = {"dirty": "true", "cleaned": "k % 20 < 10", "perfect": "false"}
    out = None
    for name, condition in versions.items():
        rows = fx.ocr_text(spark, d, condition).select("file", F.lit(name).alias("version"), "text")
        out = rows if out is None else out.unionByName(rows)
    return out


@query
def ev_ocr_contains(spark, d):
    return evaluation.ocr_contains(_ocr_versions(spark, d), fx.truth(spark, d))


@query
def ev_ocr_versions(spark, d):
    truth = fx.truth(spark, d).filter("is_duplicate = 0")
    table = evaluation.ocr_versions(evaluation.ocr_contains(_ocr_versions(spark, d), truth))
    return table.select("version", *[F.round(c, 9).alias(c) for c in table.columns if c != "version"])


@query
def ev_ocr_versions_sample(spark, d):
    sample = evaluation.sample_files(fx.truth(spark, d))
    table = evaluation.ocr_versions(evaluation.ocr_contains(_ocr_versions(spark, d), sample))
    return table.select("version", *[F.round(c, 9).alias(c) for c in table.columns if c != "version"])


# ---- splits, labels, classifier

@query
def spl_group(spark, d):
    return splits.group_split(fx.truth(spark, d))


@query
def spl_three_way(spark, d):
    return splits.three_way(fx.table(spark, d, "embeddings"), "vec_id")


def _labelled_text(spark, d):
    truth = fx.truth(spark, d).drop("file")
    return fx.ocr_text(spark, d).select("doc_id", "text").join(truth, "doc_id")


@query
def lab_find_spans(spark, d):
    spans = labels.find_spans(_labelled_text(spark, d))
    return spans.select("doc_id", F.explode("spans").alias("x")).select("doc_id", "x.label", "x.s", "x.e")


@query
def lab_resolve_overlaps(spark, d):
    spans = labels.resolve_overlaps(labels.find_spans(_labelled_text(spark, d)))
    return spans.select("doc_id", F.explode("spans").alias("x")).select("doc_id", "x.label", "x.s", "x.e")


@query
def lab_complete_only(spark, d):
    return labels.completeness(labels.resolve_overlaps(labels.find_spans(_labelled_text(spark, d))))


@query
def clf_split_counts(spark, d):
    """What the baseline classifier is fitted and measured on: rows per split and class."""
    vec = fx.table(spark, d, "embeddings")
    parts = vec.join(splits.three_way(vec, "vec_id"), "vec_id")
    return parts.groupBy("split", "label").agg(F.count("*").alias("n"))


@query
def clf_baseline(spark, d):
    vec = fx.table(spark, d, "embeddings")
    vec = vec.withColumn("condition", F.expr("if(vec_id % 2 = 0, 'normal', 'hard')"))
    return classify.baseline_scores(vec, splits.three_way(vec, "vec_id"), "vec_id", "embedding", condition="condition")
