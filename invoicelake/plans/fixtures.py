"""Invoice-shaped views over the TPC-H-like tables, used by the registered queries and the tests.

The SQL texts run unchanged on Spark and on DuckDB, so a query and its oracle start from the same rows.
Money is built from whole cents, which keeps every double identical in both engines.
"""

from __future__ import annotations

import math
import struct
import zlib

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

# The damage planted in a document, by o_orderkey % 10, and what extraction must then report.
DAMAGE = {
    1: "number line left out",
    2: "date 2026-13-45",
    3: "1Z read as IZ in the tax number",
    4: "TOTAL line left out",
    5: "tax 1.00 too high",
    6: "confidence 40",
    7: "S U B T O T A L",
    9: "one letter of the vendor misread",
}

TRUTH_SQL = """
WITH base AS (
  SELECT o_orderkey AS k, o_custkey AS c, CAST(o_orderdate AS date) AS d,
         CAST(round(o_totalprice * 100) AS bigint) * (CASE WHEN o_orderkey % 33 = 0 THEN 15 ELSE 1 END) AS sub_c
  FROM {orders}),
amt AS (
  SELECT *, CAST(floor((sub_c * 18 + 50) / 100.0) AS bigint) AS gst_c FROM base),
orig AS (
  SELECT k, c, d, sub_c, gst_c, concat('D', lpad(CAST(k AS string), 8, '0')) AS doc_id,
    concat('INV-', CAST(2000 + CAST(floor(k / 100000.0) AS int) AS string), '-',
           lpad(CAST(k % 100000 AS string), 5, '0')) AS invoice_no,
    concat('V', lpad(CAST(c AS string), 6, '0')) AS vendor_id,
    concat('Customer#', lpad(CAST(c AS string), 9, '0')) AS vendor_name,
    concat('27ABCD', substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ', CAST(1 + c % 26 AS int), 1),
           lpad(CAST(c % 10000 AS string), 4, '0'),
           CASE WHEN k % 50 = 0 THEN 'Q' ELSE 'F' END, '1Z', CAST(c % 10 AS string)) AS gstin,
    CAST(d AS string) AS invoice_date,
    CAST(sub_c AS double) / 100 AS subtotal, CAST(gst_c AS double) / 100 AS gst,
    CAST(sub_c + gst_c AS double) / 100 AS total,
    0 AS is_duplicate, CASE WHEN k % 33 = 0 THEN 1 ELSE 0 END AS is_anomaly
  FROM amt),
scans AS (
  SELECT * FROM orig
  UNION ALL
  SELECT k, c, d, sub_c, gst_c, concat(doc_id, 'C'), concat(invoice_no, '-COPY'), vendor_id, vendor_name,
         gstin, invoice_date, subtotal, gst, total, 1, is_anomaly
  FROM orig WHERE k % 20 = 0)
SELECT k, c, d, sub_c, gst_c, doc_id, concat(invoice_no, '.png') AS file, invoice_no, vendor_id, vendor_name,
       gstin, invoice_date, subtotal, gst, total, is_duplicate, is_anomaly
FROM scans
"""

# What extraction must find in the damaged text (same columns as the stored table).
EXTRACTED_SQL = """
WITH seen AS (
  SELECT k, doc_id, CASE WHEN k % 10 = 1 THEN NULL ELSE invoice_no END AS invoice_no,
         CASE WHEN k % 10 = 2 THEN '2026-13-45' ELSE invoice_date END AS invoice_date,
         CASE WHEN k % 10 = 3 THEN NULL ELSE gstin END AS gstin,
         vendor_id, vendor_name,
         CASE WHEN k % 10 = 9 THEN 34.0e0 / 36.0e0 ELSE 1.0e0 END AS vendor_match,
         CASE WHEN k % 10 = 7 THEN NULL ELSE subtotal END AS subtotal,
         CASE WHEN k % 10 = 5 THEN CAST(gst_c + 100 AS double) / 100 ELSE gst END AS gst,
         CASE WHEN k % 10 = 4 THEN NULL ELSE total END AS total,
         CASE WHEN k % 10 = 6 THEN 40.0e0 ELSE 90.0e0 END AS mean_conf,
         CASE WHEN k % 10 = 1 THEN 'missing_invoice_no' WHEN k % 10 = 3 THEN 'missing_gstin'
              WHEN k % 10 = 4 THEN 'missing_total' WHEN k % 10 = 5 THEN 'total_mismatch,gst_rate_mismatch'
              WHEN k % 10 = 6 THEN 'low_ocr_confidence' WHEN k % 10 = 7 THEN 'missing_subtotal'
              ELSE '' END AS flags
  FROM {truth})
SELECT doc_id, invoice_no, invoice_date, gstin, vendor_id, vendor_name, vendor_match, subtotal, gst, total,
       mean_conf, flags, CAST(CASE WHEN flags = '' THEN 0 ELSE 1 END AS bigint) AS needs_review
FROM seen
"""

# Registry rows of the scanned files, ingested once a month; some failed, some were byte-for-byte copies.
REGISTRY_SQL = """
SELECT doc_id, file AS file_name, concat('scanner/', file) AS source_path,
       CASE WHEN k % 30 IN (18, 28) THEN NULL ELSE concat('bronze/', doc_id, '.png') END AS bronze_path,
       md5(doc_id) AS sha256, CAST(1000 + k % 5000 AS bigint) AS size_bytes, 'scanner_folder' AS source,
       concat(substr(CAST(d AS string), 1, 8), '01T08:30:00+00:00') AS ingested_at,
       CASE WHEN k % 30 = 18 THEN 'FAILED' WHEN k % 30 = 28 THEN 'DUPLICATE_EXACT' ELSE 'INGESTED' END AS status,
       CAST(NULL AS string) AS duplicate_of, CAST(NULL AS string) AS error_message
FROM {truth}
"""

# Small invoices have not been measured yet.
QUALITY_SQL = """
SELECT doc_id, CAST(k % 41 - 20 AS double) / 2 AS skew_angle, CAST(100 + k % 900 AS double) AS blur_score,
       concat('processed/', doc_id, '.png') AS processed_path
FROM {truth} WHERE subtotal >= 20000
"""

# A second extraction model with other mistakes, for the comparison reports.
SECOND_MODEL_SQL = """
SELECT doc_id, CASE WHEN k % 7 = 1 THEN NULL ELSE invoice_no END AS invoice_no,
       CASE WHEN k % 7 = 2 THEN '1999-99-99' ELSE invoice_date END AS invoice_date,
       CASE WHEN k % 7 = 3 THEN NULL ELSE gstin END AS gstin,
       CASE WHEN k % 7 = 4 THEN 'V999999' ELSE vendor_id END AS vendor_id,
       CASE WHEN k % 7 = 5 THEN NULL ELSE subtotal END AS subtotal,
       CASE WHEN k % 7 = 6 THEN CAST(gst_c + 5 AS double) / 100 ELSE gst END AS gst,
       CASE WHEN k % 7 = 0 THEN NULL ELSE total END AS total
FROM {truth}
"""

# Raw entities of a tagger: numbers carry spaces and lower case, amounts a currency mark, TOTAL comes twice.
ENTITIES_SQL = """
SELECT doc_id, CAST(1 AS bigint) AS pos, 'INV_NO' AS label, concat(lower(substr(invoice_no, 1, 8)), ' ', substr(invoice_no, 9)) AS text FROM {truth}
UNION ALL SELECT doc_id, CAST(2 AS bigint), 'DATE', invoice_date FROM {truth} WHERE k % 10 <> 2
UNION ALL SELECT doc_id, CAST(3 AS bigint), 'DATE', '1901-01-01' FROM {truth}
UNION ALL SELECT doc_id, CAST(4 AS bigint), 'GSTIN', gstin FROM {truth} WHERE k % 10 <> 3
UNION ALL SELECT doc_id, CAST(5 AS bigint), 'VENDOR', vendor_name FROM {truth}
UNION ALL SELECT doc_id, CAST(6 AS bigint), 'SUBTOTAL', CASE WHEN k % 10 = 7 THEN 'Rs. 1.2.3' ELSE concat('Rs ', CAST(CAST(sub_c / 100.0 AS decimal(18, 2)) AS string)) END FROM {truth}
UNION ALL SELECT doc_id, CAST(7 AS bigint), 'GST', concat(CAST(CAST(gst_c / 100.0 AS decimal(18, 2)) AS string), '/-') FROM {truth}
UNION ALL SELECT doc_id, CAST(8 AS bigint), 'TOTAL', '0.00' FROM {truth}
UNION ALL SELECT doc_id, CAST(9 AS bigint), 'TOTAL', CAST(CAST((sub_c + gst_c) / 100.0 AS decimal(18, 2)) AS string) FROM {truth} WHERE k % 10 <> 4
"""

# OCR word rows: confidences run from -3 to 99, some are not numbers at all.
WORDS_SPARK = """
SELECT CAST(doc_id AS string) AS doc_id, CAST(pos AS bigint) AS pos, word,
       CASE WHEN (doc_id * 7 + pos) % 103 = 50 THEN 'n/a'
            ELSE CAST((doc_id * 7 + pos) % 103 - 3 AS string) END AS conf
FROM (SELECT doc_id, posexplode(split(text, ' ')) AS (pos, word) FROM {documents})
"""
WORDS_DUCK = """
SELECT CAST(doc_id AS varchar) AS doc_id, pos - 1 AS pos, parts[pos] AS word,
       CASE WHEN (doc_id * 7 + pos - 1) % 103 = 50 THEN 'n/a'
            ELSE CAST((doc_id * 7 + pos - 1) % 103 - 3 AS varchar) END AS conf
FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS pos
      FROM (SELECT doc_id, string_split(text, ' ') AS parts FROM documents))
"""

# Vendor headers as a scanner would print them; p_partkey % 4 picks the kind of change.
HEADERS_SQL = """
SELECT p_partkey AS header_id,
       CASE WHEN p_partkey % 4 = 1 THEN concat('X', upper(substr(p_name, 2)))
            WHEN p_partkey % 4 = 2 THEN concat(upper(p_name), ' TAX INVOICE')
            WHEN p_partkey % 4 = 3 THEN reverse(p_name)
            ELSE upper(p_name) END AS text
FROM {part}
"""


# Every vector of 64 numbers as a grey picture of 8 x 8 pixels.
PICTURES_SQL = """
SELECT vec_id, 8 AS height, 8 AS width, 1 AS channels,
       unhex(array_join(transform(embedding, x -> lpad(hex(CAST(greatest(0, least(255, floor((CAST(x AS double) + 1) * 128))) AS int)), 2, '0')), '')) AS data
FROM {embeddings}
"""
# A page of 256 x 256 pixels from 100 vectors: 10 x 10 tiles of 8 x 8 pixels on white, moved a little from page to page. Pages with
# an odd number are coloured (blue and green as the tile, no red).
PAGES_SQL = """
WITH tiles AS (
  SELECT CAST(floor(vec_id / 100) AS int) AS page, CAST(vec_id % 100 AS int) AS tile,
         transform(embedding, x -> CAST(greatest(0, least(255, floor((CAST(x AS double) + 1) * 128))) AS int)) AS p
  FROM {embeddings}),
pages AS (
  SELECT page, 60 + page % 7 * 9 AS ox, 45 + page % 5 * 16 AS oy, map_from_entries(collect_list(struct(tile, p))) AS tiles FROM tiles GROUP BY page),
spots AS (
  SELECT page, tiles, transform(sequence(0, 65535), i -> named_struct('x', CAST(i % 256 AS int) - ox, 'y', CAST(floor(i / 256) AS int) - oy)) AS spots FROM pages),
grey AS (
  SELECT page, transform(spots, s -> CASE WHEN s.x BETWEEN 0 AND 79 AND s.y BETWEEN 0 AND 79 THEN
    tiles[CAST(floor(s.y / 8) * 10 + floor(s.x / 8) AS int)][CAST(s.y % 8 * 8 + s.x % 8 AS int)] END) AS p FROM spots)
SELECT page, 256 AS height, 256 AS width, CASE WHEN page % 2 = 1 THEN 3 ELSE 1 END AS channels,
       unhex(array_join(transform(p, v -> CASE WHEN page % 2 = 0 THEN lpad(hex(coalesce(v, 255)), 2, '0') WHEN v IS NULL THEN 'FFFFFF'
                                               ELSE concat(lpad(hex(v), 2, '0'), lpad(hex(v), 2, '0'), '00') END), '')) AS data
FROM grey
"""
# Lines of text, 12 pixels wide, that rise or fall by -8 to 8 degrees on a page of 128 x 128 pixels; the ink is a vector's.
SLOPES = ", ".join(f"{math.tan(math.radians(2 * k - 8))!r}e0" for k in range(9))
TURNED_SQL = f"""
WITH pages AS (
  SELECT CAST(floor(vec_id / 100) AS int) AS page, transform(embedding, x -> CAST(greatest(0, least(255, floor((CAST(x AS double) + 1) * 128))) AS int)) AS p,
         element_at(array({SLOPES}), CAST(floor(vec_id / 100) % 9 AS int) + 1) AS slope
  FROM {{embeddings}} WHERE vec_id % 100 = 0)
SELECT page, 128 AS height, 128 AS width, 1 AS channels, unhex(array_join(transform(sequence(0, 16383), i ->
  CASE WHEN pmod(floor((floor(i / 128) + i % 128 * slope) / 12), 2) = 0 THEN lpad(hex(CAST(floor(p[i % 64] / 4) AS int)), 2, '0') ELSE 'FF' END), '')) AS data
FROM pages
"""
TURNED_PIXELS_DUCK = f"""
SELECT page, i % 128 AS x, i // 128 AS y, CASE WHEN CAST(floor((i // 128 + i % 128 * slope) / 12) AS int) % 2 = 0 THEN p // 4 ELSE 255 END AS p
FROM (SELECT page, unnest(range(16384)) AS i, [{SLOPES}][page % 9 + 1] AS slope FROM (SELECT vec_id // 100 AS page FROM embeddings WHERE vec_id % 100 = 0))
JOIN (SELECT vec_id // 100 AS page, i AS cell, p FROM pixels WHERE vec_id % 100 = 0) USING (page) WHERE cell = i % 64
"""
PAGE_PIXELS_DUCK = """
SELECT page AS vec_id, x, y, CASE WHEN p IS NULL THEN 255 WHEN page % 2 = 1 THEN CAST(floor(p * 0.114e0 + p * 0.587e0 + 0.5) AS int) ELSE p END AS p
FROM (SELECT page, i % 256 AS x, i // 256 AS y FROM (SELECT page, unnest(range(65536)) AS i FROM (SELECT DISTINCT vec_id // 100 AS page FROM embeddings)))
LEFT JOIN (SELECT vec_id // 100 AS page, 60 + vec_id // 100 % 7 * 9 + vec_id % 10 * 8 + i % 8 AS x, 45 + vec_id // 100 % 5 * 16 + vec_id % 100 // 10 * 8 + i // 8 AS y, p
           FROM pixels) USING (page, x, y)
"""
PIXELS_DUCK = """
SELECT vec_id, i, CAST(greatest(0, least(255, floor((CAST(embedding[i + 1] AS double) + 1) * 128))) AS int) AS p
FROM (SELECT vec_id, embedding, unnest(range(64)) AS i FROM embeddings)
"""


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame, finer: int = 0) -> DataFrame:
    """The test tables are single small files; real ones arrive in many. Used where text is built from them; ``finer`` parts per part of
    the stored table at least, where a part grows in the task that reads it."""
    parts = finer * df.rdd.getNumPartitions() if finer else 0
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, parts))


def truth(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(TRUTH_SQL, orders=table(spark, folder, "orders"))


def extracted(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(EXTRACTED_SQL, truth=truth(spark, folder))


def registry(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(REGISTRY_SQL, truth=truth(spark, folder))


def image_quality(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(QUALITY_SQL, truth=truth(spark, folder))


def second_model(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(SECOND_MODEL_SQL, truth=truth(spark, folder))


def entities(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(ENTITIES_SQL, truth=truth(spark, folder))


def words(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(WORDS_SPARK, documents=spread(table(spark, folder, "documents").select("doc_id", "text"), finer=8))


def headers(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(HEADERS_SQL, part=table(spark, folder, "part"))


def part_vendors(spark: SparkSession, folder: str) -> DataFrame:
    """Every distinct part name as a vendor master; the name is its own id."""
    return spark.sql("SELECT DISTINCT p_name AS vendor_id, p_name AS vendor_name FROM {part}",
                     part=table(spark, folder, "part"))


def pictures(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(PICTURES_SQL, embeddings=table(spark, folder, "embeddings"))


def pages(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(PAGES_SQL, embeddings=table(spark, folder, "embeddings"))


def turned(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(TURNED_SQL, embeddings=table(spark, folder, "embeddings"))


@F.pandas_udf(BinaryType())
def png(height: pd.Series, width: pd.Series, data: pd.Series) -> pd.Series:
    """Grey pixels as the bytes of a PNG file."""
    def part(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    def file(h: int, w: int, pixels: bytes) -> bytes:
        lines = b"".join(b"\0" + pixels[y * w:(y + 1) * w] for y in range(h))
        return (b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 0, 0, 0, 0)) + part(b"IDAT", zlib.compress(lines))
                + part(b"IEND", b""))
    return pd.Series([file(int(h), int(w), bytes(d)) for h, w, d in zip(height, width, data)])


def ocr_text(spark: SparkSession, folder: str, damaged: str = "true") -> DataFrame:
    """Printed invoice text with the damage of ``DAMAGE``; ``damaged`` is a SQL condition on ``k``."""
    return spark.sql(f"""
        WITH t AS (SELECT *, CASE WHEN {damaged} THEN k % 10 ELSE 0 END AS m FROM {{truth}})
        SELECT doc_id, file, concat_ws('\\n',
            concat(CASE WHEN m = 9 THEN replace(vendor_name, 'Customer', 'Custoner') ELSE vendor_name END,
                   ' TAX INVOICE'),
            concat('Pune GSTIN: ', CASE WHEN m = 3 THEN replace(gstin, '1Z', 'IZ') ELSE gstin END),
            CASE WHEN m <> 1 THEN concat('Invoice No: ', invoice_no) END,
            concat('Date: ', CASE WHEN m = 2 THEN '2026-13-45' ELSE invoice_date END),
            concat(CASE WHEN m = 7 THEN 'S U B T O T A L: Rs. ' ELSE 'Subtotal: Rs. ' END,
                   format_number(subtotal, 2)),
            concat('GST 18%:  Rs. ', format_number(CASE WHEN m = 5 THEN gst + 1 ELSE gst END, 2)),
            CASE WHEN m <> 4 THEN concat('TOTAL:    Rs. ', format_number(total, 2)) END) AS text,
            CASE WHEN m = 6 THEN 40.0D ELSE 90.0D END AS mean_conf
        FROM t""", truth=spread(truth(spark, folder)))
