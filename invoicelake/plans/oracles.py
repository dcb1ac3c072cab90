"""DuckDB twins of the registered queries, written from the definition of each operator."""

from __future__ import annotations

import math

from invoicelake.plans import fixtures as fx

ORACLES: dict[str, str] = {}



def _forest_tables() -> dict[str, str]:
    """The isolation forest level by level: ``rows_d`` in their nodes, ``nodes_d`` with a feature (0: none) and cut, ``at_d`` all documents on their way."""
    from invoicelake.operators import forest
    from invoicelake.operators.anomalies import SEED

    def number(digits: int, *what: str) -> str:
        return f"('0x' || substr(md5(concat_ws(':', {SEED}, {', '.join(what)})), 1, {digits}))::BIGINT"

    def chance(*what: str) -> str:
        return f"({number(forest.DIGITS, *what)} / {float(16 ** forest.DIGITS)!r}::DOUBLE)"
    deepest = math.ceil(math.log2(forest.SUBSAMPLE))
    order = ", ".join(f"{number(forest.DIGITS, 'tree', repr(c))} >> {4 * (forest.DIGITS - forest.ORDER_DIGITS)} AS {c}" for c in "abc")
    keys = ", ".join(f"('0x' || substr(md5(doc_id), {1 + i * forest.ORDER_DIGITS}, {forest.ORDER_DIGITS}))::BIGINT AS k{i}" for i in range(2))
    out = {
        "trees": f"SELECT tree, {order} FROM (SELECT unnest(range({forest.TREES})) AS tree)",
        "keyed": f"SELECT doc_id, log_total AS x1, vendor_z AS x2, {keys} FROM z_scores",
        "rows_0": f"""
            SELECT tree, 1::BIGINT AS node, x1, x2 FROM (SELECT *, row_number() OVER (
              PARTITION BY tree ORDER BY (a * k0 + b * k1 + c) % {forest.PRIME}, doc_id) AS r FROM keyed, trees) WHERE r <= {forest.SUBSAMPLE}""",
        "sizes": "SELECT tree, count(*) AS size FROM rows_0 GROUP BY tree",
        "at_0": "SELECT doc_id, tree, 1::BIGINT AS node, x1, x2 FROM keyed, trees",
    }
    for d in range(deepest + 1):
        out[f"nodes_{d}"] = f"""
            SELECT tree, node, n, f, CASE WHEN cut >= high THEN low ELSE cut END AS cut FROM (
              SELECT *, low + {chance("tree", "node", "'cut'")} * (high - low) AS cut FROM (
                SELECT *, CASE f WHEN 1 THEN l1 ELSE l2 END AS low, CASE f WHEN 1 THEN h1 ELSE h2 END AS high FROM (
                  SELECT *, CASE WHEN n < 2 OR {d} >= ceil(log2(greatest(size, 2))) OR (h1 <= l1 AND h2 <= l2) THEN 0 WHEN h2 <= l2 THEN 1 WHEN h1 <= l1 THEN 2
                    ELSE 1 + CAST(floor(2 * {chance("tree", "node", "'feature'")}) AS int) END AS f
                  FROM (SELECT tree, node, count(*) AS n, min(x1) AS l1, max(x1) AS h1, min(x2) AS l2, max(x2) AS h2 FROM rows_{d} GROUP BY ALL) JOIN sizes USING (tree))))"""
        for kind, extra in (("rows", ""), ("at", "doc_id, ")):
            if d < deepest:
                out[f"{kind}_{d + 1}"] = f"""
                    SELECT {extra}tree, 2 * node + CAST(CASE f WHEN 1 THEN x1 ELSE x2 END > cut AS int) AS node, x1, x2
                    FROM {kind}_{d} JOIN nodes_{d} USING (tree, node) WHERE f > 0"""
    path = f"CASE WHEN n > 2 THEN 2 * (ln(n - 1) + {forest.EULER}) - 2 * (n - 1) / n WHEN n = 2 THEN 1 ELSE 0 END"
    ends = " UNION ALL ".join(f"SELECT doc_id, {d} + {path} AS path FROM at_{d} JOIN nodes_{d} USING (tree, node) WHERE f = 0" for d in range(deepest + 1))
    out["iso_scores"] = f"""
        SELECT doc_id, is_anomaly, vendor_z, global_z, round(pow(2, -(total / (SELECT count(*) FROM trees)) / (SELECT {path} FROM (SELECT max(size)::DOUBLE AS n FROM sizes))), 9) AS iso_score
        FROM (SELECT doc_id, sum(path) AS total FROM ({ends}) GROUP BY doc_id) JOIN z_scores USING (doc_id)"""
    return out


TABLES = {
    "truth": fx.TRUTH_SQL.format(orders="orders"),
    "extracted": fx.EXTRACTED_SQL.format(truth="truth"),
    "registry": fx.REGISTRY_SQL.format(truth="truth"),
    "quality": fx.QUALITY_SQL.format(truth="truth"),
    "second": fx.SECOND_MODEL_SQL.format(truth="truth"),
    "entities": fx.ENTITIES_SQL.format(truth="truth"),
    "words": fx.WORDS_DUCK,
    "joined": """
        SELECT e.* REPLACE (TRY_CAST(CASE WHEN e.invoice_date LIKE '____-__-__' THEN e.invoice_date END AS date) AS invoice_date),
               r.file_name, r.sha256, CAST(substr(r.ingested_at, 1, 10) AS date) AS ingest_date, q.skew_angle, q.blur_score
        FROM extracted e JOIN registry r USING (doc_id) LEFT JOIN quality q USING (doc_id)
        WHERE r.status = 'INGESTED'""",
    "checked": """
        SELECT *, concat_ws(',',
            CASE WHEN invoice_no IS NULL THEN 'missing_invoice_no' END,
            CASE WHEN vendor_id IS NULL THEN 'missing_vendor' END,
            CASE WHEN invoice_date IS NULL THEN 'bad_date' END,
            CASE WHEN invoice_date > DATE '2000-01-01' THEN 'future_date' END,
            CASE WHEN total IS NULL OR total <= 0 THEN 'bad_total' END) AS dq_reasons
        FROM joined""",
    "invoices": "SELECT * FROM checked WHERE dq_reasons = ''",
    "fact": """
        SELECT doc_id, invoice_no, vendor_id, CAST(strftime(invoice_date, '%Y%m%d') AS int) AS date_key, subtotal, gst, total,
               needs_review, mean_conf, skew_angle, blur_score
        FROM invoices""",
    "vendors": """
        SELECT vendor_id, vendor_name, gstin FROM (
          SELECT vendor_id, vendor_name, gstin,
                 row_number() OVER (PARTITION BY vendor_id ORDER BY count(*) DESC, vendor_name, gstin NULLS FIRST) AS r
          FROM invoices GROUP BY vendor_id, vendor_name, gstin) WHERE r = 1""",
    "graded": """
        SELECT e.*, t.invoice_no AS invoice_no_gt, t.invoice_date AS invoice_date_gt, t.gstin AS gstin_gt,
               t.vendor_id AS vendor_id_gt, t.subtotal AS subtotal_gt, t.gst AS gst_gt, t.total AS total_gt,
               t.is_duplicate, t.is_anomaly, t.file
        FROM extracted e JOIN registry r USING (doc_id) JOIN truth t ON r.file_name = t.file""",
    "marks": """
        SELECT *, coalesce(invoice_no = invoice_no_gt, false) AS ok_invoice_no,
               coalesce(invoice_date = invoice_date_gt, false) AS ok_invoice_date,
               coalesce(gstin = gstin_gt, false) AS ok_gstin, coalesce(vendor_id = vendor_id_gt, false) AS ok_vendor_id,
               coalesce(abs(subtotal - subtotal_gt) < 0.01, false) AS ok_subtotal,
               coalesce(abs(gst - gst_gt) < 0.01, false) AS ok_gst, coalesce(abs(total - total_gt) < 0.01, false) AS ok_total
        FROM graded""",
    "prepared": """
        SELECT doc_id, vendor_id, TRY_CAST(invoice_date AS date) AS date, total,
               replace(invoice_no, '-COPY', '') AS inv_clean, replace(invoice_no_gt, '-COPY', '') AS true_base
        FROM graded
        WHERE vendor_id IS NOT NULL AND invoice_date IS NOT NULL AND total IS NOT NULL AND invoice_no IS NOT NULL
          AND TRY_CAST(invoice_date AS date) IS NOT NULL""",
    "couples": """
        SELECT a.vendor_id, a.true_base = b.true_base AS same, a.total = b.total AND a.date = b.date AS predicted
        FROM prepared a JOIN prepared b ON a.vendor_id = b.vendor_id AND a.doc_id < b.doc_id""",
    "scorable": """
        SELECT doc_id, vendor_id, total, is_anomaly, ln(1 + total) AS log_total
        FROM graded WHERE is_duplicate = 0 AND total > 0 AND vendor_id IS NOT NULL""",
    "with_median": "SELECT *, median(log_total) OVER (PARTITION BY vendor_id) AS med FROM scorable",
    "with_mad": "SELECT *, median(abs(log_total - med)) OVER (PARTITION BY vendor_id) AS mad FROM with_median",
    "z_scores": """
        SELECT doc_id, is_anomaly, round(log_total, 6) AS log_total, round((log_total - med) / (greatest(mad, 0.1) * 1.4826), 6) AS vendor_z,
               round((total - avg(total) OVER ()) / stddev_samp(total) OVER (), 6) AS global_z
        FROM with_mad""",
    **_forest_tables(),
    "docs": """
        SELECT source || '/' || lpad(CAST(doc_id AS varchar), 8, '0') || '.PDF' AS path, strlen(text) AS length,
               sha256(text) AS sha256, source IN ('src0', 'src1', 'src2') AS earlier
        FROM documents""",
    "ided": "SELECT *, sha256(path || '#' || sha256) AS doc_id FROM docs",
    "originals": """
        SELECT sha256, arg_min(doc_id, struct_pack(later := NOT earlier, path := path)) AS original,
               arg_min(doc_id, path) FILTER (WHERE earlier) AS stored_id
        FROM ided GROUP BY sha256""",
    "new_rows": """
        SELECT i.*, CASE WHEN original = doc_id THEN 'INGESTED' ELSE 'DUPLICATE_EXACT' END AS status,
               CASE WHEN original <> doc_id THEN original END AS duplicate_of
        FROM ided i JOIN originals USING (sha256) WHERE NOT earlier""",
    "pixels": fx.PIXELS_DUCK,
    "turned_pixels": fx.TURNED_PIXELS_DUCK,
    "page_pixels": fx.PAGE_PIXELS_DUCK,
    "clear": """
        SELECT vec_id, i, CAST(round_even(CAST(p AS float) * scale - CAST(low AS float) * scale, 0) AS int) AS p
        FROM pixels JOIN (SELECT vec_id, min(p) AS low, CAST(255.0e0 / (max(p) - min(p)) AS float) AS scale
                          FROM pixels GROUP BY vec_id HAVING max(p) > min(p)) USING (vec_id)""",
    "target": "SELECT o_orderkey, CAST(year(o_orderdate) AS int) AS year, o_orderstatus, o_totalprice FROM orders WHERE year(o_orderdate) <= 1998",
    "later": "SELECT o_orderkey, CAST(year(o_orderdate) AS int) AS year, o_orderstatus, o_totalprice * 2 AS o_totalprice FROM orders WHERE year(o_orderdate) >= 1997",
    "scores": "SELECT doc_id, CAST(n_chars AS double) AS score, quality FROM documents JOIN labels USING (doc_id)",
    "predictions": """
        SELECT 'cond' || vec_id % 2 AS condition, 'model' || vec_id % 3 % 2 AS model, CAST(vec_id % 5 AS varchar) AS seed,
               label, CASE WHEN vec_id % 6 = 0 THEN (label + 1) % 10 ELSE label END AS prediction
        FROM embeddings""",
    "runs": """
        SELECT model, condition, seed, acc, macro_f1 FROM (
          SELECT model, condition, seed, avg(CASE WHEN label = prediction THEN 1.0e0 ELSE 0.0e0 END) AS acc
          FROM predictions GROUP BY ALL) JOIN (
          SELECT model, condition, seed, avg(2.0e0 * tp / (t + q)) AS macro_f1 FROM (
            SELECT model, condition, seed, class, sum(tp) AS tp, sum(t) AS t, sum(q) AS q FROM (
              SELECT model, condition, seed, label AS class, CAST(label = prediction AS int) AS tp, 1 AS t, 0 AS q FROM predictions
              UNION ALL SELECT model, condition, seed, prediction, 0, 0, 1 FROM predictions)
            GROUP BY ALL) GROUP BY ALL) USING (model, condition, seed)""",
    "split": """
        SELECT doc_id, CASE WHEN r <= floor(0.2 * n) THEN 'test' ELSE 'train' END AS split
        FROM (SELECT doc_id, replace(invoice_no, '-COPY', '') AS base FROM truth) JOIN (
          SELECT base, row_number() OVER (ORDER BY sha256(base || '#42'), base) AS r, count(*) OVER () AS n
          FROM (SELECT DISTINCT replace(invoice_no, '-COPY', '') AS base FROM truth)) USING (base)""",
    "hybrid": """
        SELECT e.doc_id, coalesce(e.invoice_no, s.invoice_no) AS invoice_no, coalesce(e.invoice_date, s.invoice_date) AS invoice_date,
               coalesce(e.gstin, s.gstin) AS gstin, coalesce(e.vendor_id, s.vendor_id) AS vendor_id,
               coalesce(e.subtotal, s.subtotal) AS subtotal, coalesce(e.gst, s.gst) AS gst, coalesce(e.total, s.total) AS total
        FROM extracted e LEFT JOIN second s USING (doc_id)""",
    # printed values a version of the text shows or hides, by the planted damage m
    "shown": """
        SELECT t.*, v.version, CASE WHEN v.version = 'dirty' OR (v.version = 'cleaned' AND k % 20 < 10) THEN k % 10 ELSE 0 END AS m
        FROM truth t CROSS JOIN (VALUES ('dirty'), ('cleaned'), ('perfect')) v(version)""",
    # the amount is found where a printed line or another printed amount ends with the same digits
    "hits": """
        SELECT file, version, is_duplicate, m <> 1 AS invoice_no, m <> 2 AS date, m <> 3 AS gstin,
               m <> 4 OR contains('SUBTOTAL:RS.' || format('{:,.2f}', subtotal), format('{:,.2f}', total)) AS total
        FROM shown""",
    "texts": """
        SELECT *, concat_ws(chr(10),
            CASE WHEN k % 10 = 9 THEN replace(vendor_name, 'Customer', 'Custoner') ELSE vendor_name END || ' TAX INVOICE',
            'Pune GSTIN: ' || CASE WHEN k % 10 = 3 THEN replace(gstin, '1Z', 'IZ') ELSE gstin END,
            CASE WHEN k % 10 <> 1 THEN 'Invoice No: ' || invoice_no END,
            'Date: ' || CASE WHEN k % 10 = 2 THEN '2026-13-45' ELSE invoice_date END,
            CASE WHEN k % 10 = 7 THEN 'S U B T O T A L: Rs. ' ELSE 'Subtotal: Rs. ' END || format('{:,.2f}', subtotal),
            'GST 18%:  Rs. ' || format('{:,.2f}', CASE WHEN k % 10 = 5 THEN gst + 1 ELSE gst END),
            CASE WHEN k % 10 <> 4 THEN 'TOTAL:    Rs. ' || format('{:,.2f}', total) END) AS text FROM truth""",
    "found": """
        SELECT doc_id, label, CAST(s AS int) AS s, CAST(s + length(value) AS int) AS e
        FROM (SELECT doc_id, label, value,
                     CASE WHEN last THEN length(text) - strpos(reverse(text), reverse(value)) - length(value) + 1
                          ELSE strpos(text, value) - 1 END AS s
              FROM (SELECT doc_id, text, unnest([
                      {'label': 'INV_NO', 'value': invoice_no, 'last': false}, {'label': 'DATE', 'value': invoice_date, 'last': false},
                      {'label': 'GSTIN', 'value': gstin, 'last': false}, {'label': 'VENDOR', 'value': vendor_name, 'last': false},
                      {'label': 'SUBTOTAL', 'value': format('{:,.2f}', subtotal), 'last': true},
                      {'label': 'GST', 'value': format('{:,.2f}', gst), 'last': true},
                      {'label': 'TOTAL', 'value': format('{:,.2f}', total), 'last': true}], recursive := true) FROM texts)
              WHERE contains(text, value))""",
    # at most seven spans per document: each one stays unless a kept earlier one reaches into it
    "kept_spans": """
        SELECT doc_id, unnest(list_reduce(sorted, lambda kept, x:
                 CASE WHEN x[1].s >= kept[-1].e THEN list_concat(kept, x) ELSE kept END), recursive := true)
        FROM (SELECT doc_id, list([{'s': s, 'e': e, 'label': label}] ORDER BY s, e, label) AS sorted FROM found GROUP BY doc_id)""",
}

NEEDS = {
    "extracted": ["truth"], "registry": ["truth"], "quality": ["truth"], "second": ["truth"], "entities": ["truth"],
    "joined": ["extracted", "registry", "quality"], "checked": ["joined"], "invoices": ["checked"], "fact": ["invoices"],
    "vendors": ["invoices"], "graded": ["extracted", "registry", "truth"], "marks": ["graded"], "prepared": ["graded"],
    "couples": ["prepared"], "scorable": ["graded"], "with_median": ["scorable"], "with_mad": ["with_median"],
    "z_scores": ["with_mad"], "ided": ["docs"], "originals": ["ided"], "new_rows": ["ided", "originals"],
    "clear": ["pixels"], "page_pixels": ["pixels"], "turned_pixels": ["pixels"], "runs": ["predictions"], "split": ["truth"], "hybrid": ["extracted", "second"], "shown": ["truth"], "hits": ["shown"],
    "texts": ["truth"], "found": ["texts"], "kept_spans": ["found"],
    "keyed": ["z_scores"], "rows_0": ["keyed", "trees"], "sizes": ["rows_0"], "at_0": ["keyed", "trees"],
    "iso_scores": [name for name in TABLES if name.startswith(("nodes_", "at_"))],
}
for _name in TABLES:
    _kind, _, _level = _name.rpartition("_")
    if _kind == "nodes":
        NEEDS[_name] = [f"rows_{_level}", "sizes"]
    elif _kind in ("rows", "at") and _level != "0":
        NEEDS[_name] = [f"{_kind}_{int(_level) - 1}", f"nodes_{int(_level) - 1}"]


def _with(*names: str) -> str:
    order: list[str] = []

    def visit(name: str) -> None:
        for needed in NEEDS.get(name, []):
            visit(needed)
        if name not in order:
            order.append(name)

    for name in names:
        visit(name)
    return "WITH " + ",\n".join(f"{n} AS ({TABLES[n]})" for n in order) + "\n"


def oracle(name: str, body: str, *tables: str) -> None:
    ORACLES[name] = (_with(*tables) if tables else "") + body


FIELDS = ["invoice_no", "invoice_date", "gstin", "vendor_id", "subtotal", "gst", "total"]

# ---- sources, tables, merges

oracle("src_typed_table", """
    SELECT l_returnflag, count(*) AS n, count(nullif(l_discount, 0)) AS with_discount,
           min(nullif(l_discount, 0)) AS smallest, max(l_quantity) AS largest
    FROM lineitem GROUP BY l_returnflag""")
oracle("src_snapshot", "SELECT o_orderstatus, count(*) AS n, max(o_totalprice) AS largest FROM orders GROUP BY 1")
oracle("src_path_sql", """
    SELECT c_mktsegment AS segment, count(*) AS orders, CAST(sum(CAST(o_totalprice AS decimal(24, 2))) AS double) AS spend
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""")
oracle("src_csv_truth", """
    SELECT file, invoice_no, vendor_id, vendor_name, gstin, invoice_date, subtotal, gst, total, is_duplicate, is_anomaly
    FROM truth""", "truth")
oracle("src_csv_quarantine", """
    SELECT file, subtotal, true AS kept, false AS told FROM truth
    UNION ALL SELECT file, NULL, false, true FROM truth WHERE is_duplicate = 1""", "truth")
oracle("snk_partitioned", "SELECT CAST(date_trunc('month', d) AS date) AS ingest_date, count(*) AS n FROM truth GROUP BY 1", "truth")
oracle("snk_overwrite", "SELECT doc_id, flags FROM extracted WHERE needs_review = 1", "extracted")
oracle("merge_insert_only", """
    SELECT * FROM target UNION ALL
    SELECT * FROM later WHERE o_orderkey NOT IN (SELECT o_orderkey FROM target)""", "target", "later")
oracle("merge_upsert", """
    SELECT * FROM later UNION ALL
    SELECT * FROM target WHERE o_orderkey NOT IN (SELECT o_orderkey FROM later)""", "target", "later")
oracle("merge_delete", """
    SELECT * FROM target WHERE o_orderkey NOT IN (SELECT o_orderkey FROM later)""", "target", "later")
oracle("table_history", """
    SELECT CAST(0 AS bigint) AS version, 'CREATE' AS operation, (SELECT count(*) FROM target) AS upserts, CAST(0 AS bigint) AS deletes
    UNION ALL SELECT 1, 'MERGE', (SELECT count(*) FROM later), 0
    UNION ALL SELECT 2, 'DELETE', 0, (SELECT count(*) FROM later WHERE o_orderstatus = 'F')""", "target", "later")
oracle("table_version_as_of", """
    , merged AS (SELECT * FROM later UNION ALL SELECT * FROM target WHERE o_orderkey NOT IN (SELECT o_orderkey FROM later)),
    kept AS (SELECT * FROM merged WHERE o_orderkey NOT IN (SELECT o_orderkey FROM later WHERE o_orderstatus = 'F'))
    SELECT 0 AS version, count(*) AS n, max(o_totalprice) AS largest, CAST(sum(o_orderkey) AS bigint) AS keys FROM target
    UNION ALL SELECT 1, count(*), max(o_totalprice), CAST(sum(o_orderkey) AS bigint) FROM merged
    UNION ALL SELECT 2, count(*), max(o_totalprice), CAST(sum(o_orderkey) AS bigint) FROM kept""", "target", "later")

oracle("table_stored_history", """
    SELECT CAST(0 AS bigint) AS version, 'CREATE' AS operation, (SELECT count(*) FROM target) AS upserts, CAST(0 AS bigint) AS deletes, false AS whole
    UNION ALL SELECT 1, 'MERGE', (SELECT count(*) FROM later), 0, false
    UNION ALL SELECT 2, 'DELETE', 0, (SELECT count(*) FROM later WHERE o_orderstatus = 'F'), true
    UNION ALL SELECT 3, 'MERGE', (SELECT count(*) FROM later WHERE o_orderstatus = 'F'), 0, false
    UNION ALL SELECT 4, 'MERGE', (SELECT count(*) FROM orders WHERE o_orderstatus = 'P'), 0, true""", "target", "later")
oracle("table_stored_as_of", """
    , o AS (SELECT o_orderkey, year(o_orderdate) AS y, o_orderstatus, o_totalprice AS p FROM orders),
    r AS (SELECT v AS version, o_orderkey, o_orderstatus, CASE
            WHEN v = 4 AND o_orderstatus = 'P' THEN p + 1
            WHEN v = 0 OR y < 1997 OR v >= 3 AND o_orderstatus = 'F' THEN p ELSE p * 2 END AS price
          FROM o, (SELECT unnest(range(5)) AS v)
          WHERE NOT (v = 0 AND y > 1998) AND NOT (v = 2 AND y >= 1997 AND o_orderstatus = 'F'))
    SELECT CAST(version AS int) AS version, o_orderstatus, count(*) AS n, max(price) AS largest, CAST(sum(o_orderkey) AS bigint) AS keys,
           CAST(sum(CAST(price AS decimal(24, 2))) AS double) AS spend
    FROM r GROUP BY version, o_orderstatus""", "target")
oracle("snk_partitioned_pruned", """
    SELECT CAST(year(o_orderdate) AS int) AS year, monthname(o_orderdate) AS month_name, count(*) AS n,
           CAST(sum(CAST(o_totalprice AS decimal(24, 2))) AS double) AS spend
    FROM orders WHERE quarter(o_orderdate) = 4 GROUP BY 1, 2""")

# ---- registry and OCR words

_DISK = "regexp_replace(path, '/0', '/a b/0') AS path"
oracle("src_files", f"SELECT {_DISK}, length FROM docs", "docs")
oracle("ing_failed_row", f"""
    , d AS (SELECT {_DISK}, sha256 FROM docs),
    g AS (SELECT DISTINCT source || '/gone.pdf' AS path FROM documents)
    SELECT path, CASE WHEN path = min(path) OVER (PARTITION BY sha256) THEN 'INGESTED' ELSE 'DUPLICATE_EXACT' END AS status, sha256,
           false AS has_error FROM d
    UNION ALL SELECT path, 'FAILED', NULL, true FROM g""", "docs")
oracle("snk_landing", f"""
    , d AS (SELECT {_DISK}, sha256 FROM docs)
    SELECT min(path) AS path, sha256, DATE '2026-01-02' AS ingest_date FROM d GROUP BY sha256""", "docs")
oracle("ing_fingerprint", "SELECT path, length, sha256 FROM docs", "docs")
oracle("ing_skip_seen", "SELECT path, sha256 FROM docs WHERE NOT earlier", "docs")
oracle("ing_skip_seen_stored", "SELECT path, sha256 FROM docs WHERE NOT earlier", "docs")
oracle("ing_register_stored", """
    , first AS (SELECT path, sha256, 0 AS run, path <> min(path) OVER (PARTITION BY sha256) AS copy, min(path) OVER (PARTITION BY sha256) AS original
                FROM docs WHERE earlier),
    new AS (SELECT d.path, d.sha256, 1 AS run, coalesce(f.original, min(d.path) OVER (PARTITION BY d.sha256)) AS original
            FROM docs d LEFT JOIN (SELECT DISTINCT sha256, original FROM first) f USING (sha256) WHERE NOT earlier),
    everything AS (SELECT path, sha256, run, original, copy FROM first UNION ALL SELECT path, sha256, run, original, path <> original FROM new)
    SELECT CAST(r.run AS int) AS run, CASE WHEN copy THEN 'DUPLICATE_EXACT' ELSE 'INGESTED' END AS status, count(*) AS n,
           count(DISTINCT sha256) AS contents, count(DISTINCT CASE WHEN copy THEN original END) AS originals
    FROM everything e JOIN (SELECT unnest(range(2)) AS run) r ON e.run <= r.run GROUP BY 1, 2""", "docs")
oracle("ing_exact_duplicate", "SELECT path AS source_path, status, duplicate_of FROM new_rows", "new_rows")
oracle("ing_registry_row", """
    SELECT doc_id, split_part(path, '/', 2) AS file_name, path AS source_path,
           CASE WHEN status = 'INGESTED' THEN 'bronze/ingest_date=2026-01-02/' || doc_id || '.pdf' END AS bronze_path,
           sha256, length AS size_bytes, 'scanner_folder' AS source, '2026-01-02T03:04:05+00:00' AS ingested_at, status,
           duplicate_of, CAST(NULL AS varchar) AS error_message
    FROM new_rows""", "new_rows")
oracle("ing_counts", """
    SELECT s.status, coalesce(n, 0) AS n
    FROM (VALUES ('INGESTED'), ('DUPLICATE_EXACT'), ('SKIPPED'), ('FAILED')) s(status)
    LEFT JOIN (SELECT status, count(*) AS n FROM new_rows GROUP BY 1
               UNION ALL SELECT 'SKIPPED', count(*) FROM docs WHERE earlier) c USING (status)""", "new_rows")
oracle("inc_pending", """
    SELECT doc_id, bronze_path FROM registry
    WHERE status = 'INGESTED' AND NOT EXISTS (SELECT 1 FROM quality q WHERE q.doc_id = registry.doc_id)""",
       "registry", "quality")
oracle("ocr_aggregate", r"""
    , kept AS (SELECT doc_id, pos, regexp_replace(word, '^\s+|\s+$', '', 'g') AS word, TRY_CAST(conf AS double) AS conf FROM words),
    sums AS (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS text, round(avg(conf), 9) AS mean_conf, count(*) AS n
             FROM kept WHERE conf >= 0 AND word <> '' GROUP BY doc_id)
    SELECT CAST(d.doc_id AS varchar) AS doc_id, coalesce(s.text, '') AS text, coalesce(mean_conf, 0.0e0) AS mean_conf,
           coalesce(n, 0) AS n_words
    FROM documents d LEFT JOIN sums s ON s.doc_id = CAST(d.doc_id AS varchar)""", "words")

# ---- image measurements

oracle("img_blur_score", """
    , lists AS (SELECT vec_id, list(p ORDER BY i) AS v FROM pixels GROUP BY vec_id),
    around AS (
      SELECT vec_id, v, i // 8 AS r, i % 8 AS c FROM (SELECT vec_id, v, unnest(range(64)) AS i FROM lists)),
    lap AS (
      SELECT vec_id, v[8 * (CASE WHEN r = 0 THEN 1 ELSE r - 1 END) + c + 1] + v[8 * (CASE WHEN r = 7 THEN 6 ELSE r + 1 END) + c + 1]
                     + v[8 * r + CASE WHEN c = 0 THEN 1 ELSE c - 1 END + 1] + v[8 * r + CASE WHEN c = 7 THEN 6 ELSE c + 1 END + 1]
                     - 4 * v[8 * r + c + 1] AS x
      FROM around)
    SELECT vec_id, round(var_pop(x), 6) AS blur_score FROM lap GROUP BY vec_id""", "pixels")
oracle("img_quality_rows", ORACLES["img_blur_score"].replace("SELECT vec_id, round(var_pop(x), 6) AS blur_score FROM lap",
                                                         "SELECT vec_id AS doc_id, round(var_pop(x), 6) AS blur_score FROM lap WHERE vec_id IN (SELECT vec_id FROM embeddings WHERE label <> 0)"))
oracle("img_otsu", """
    , cuts AS (SELECT vec_id, t, count(*) FILTER (WHERE p <= t) AS below, count(*) FILTER (WHERE p > t) AS above,
                      avg(p) FILTER (WHERE p <= t) AS dark, avg(p) FILTER (WHERE p > t) AS light
               FROM clear JOIN (SELECT DISTINCT vec_id, p AS t FROM clear) USING (vec_id) GROUP BY vec_id, t)
    SELECT vec_id, t AS otsu FROM cuts WHERE above > 0
    QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY round(below * above * (dark - light) * (dark - light), 6) DESC, t) = 1""", "clear")
oracle("img_content_box", "SELECT DISTINCT vec_id, 0 AS x0, 0 AS y0, 8 AS x1, 8 AS y1 FROM clear", "clear")
_CLEAR = """
    , clear AS (
      SELECT {key}, x, y, CAST(round_even(CAST(p AS float) * scale - CAST(low AS float) * scale, 0) AS int) AS p
      FROM {table} JOIN (SELECT {key}, min(p) AS low, CAST(255.0e0 / (max(p) - min(p)) AS float) AS scale FROM {table} GROUP BY {key}) USING ({key}))"""
oracle("src_images", """
    SELECT vec_id || '.png' AS file, 8 AS height, 8 AS width, CAST(sum(p) AS bigint) AS gray_sum, CAST(sum(p * i) AS bigint) AS gray_mark, false AS broken FROM pixels GROUP BY vec_id
    UNION ALL SELECT 'broken.png', NULL, NULL, NULL, NULL, true""", "pixels")
oracle("img_gray", "SELECT vec_id AS page, CAST(sum(p) AS bigint) AS gray_sum, CAST(sum(p * ((y * 256 + x) % 251)) AS bigint) AS gray_mark FROM page_pixels GROUP BY vec_id",
       "page_pixels")
oracle("img_contrast", _CLEAR.format(key="vec_id", table="page_pixels") + """
    SELECT vec_id AS page, CAST(sum(p) AS bigint) AS contrast_sum, CAST(sum(p * ((y * 256 + x) % 251)) AS bigint) AS contrast_mark FROM clear GROUP BY vec_id""", "page_pixels")
# the ink of every angle per row of the shrunk page, and the angle at which the rows differ most
oracle("img_skew_angle", _CLEAR.format(key="page", table="turned_pixels") + """,
    small AS (SELECT page, x // 4 AS x, y // 4 AS y, CAST(round_even(avg(p), 0) AS int) AS p FROM clear GROUP BY ALL),
    h AS (SELECT page, p, count(*) AS n FROM small GROUP BY ALL),
    cuts AS (SELECT a.page, a.p AS t, sum(b.n) FILTER (WHERE b.p <= a.p) AS below, sum(b.n) FILTER (WHERE b.p > a.p) AS above,
                    sum(b.n * b.p) FILTER (WHERE b.p <= a.p) AS low, sum(b.n * b.p) FILTER (WHERE b.p > a.p) AS high
             FROM h a JOIN h b USING (page) GROUP BY a.page, a.p),
    o AS (SELECT page, t FROM cuts WHERE above > 0 QUALIFY row_number() OVER (
      PARTITION BY page ORDER BY round(below::DOUBLE * above * pow(low / below::DOUBLE - high / above::DOUBLE, 2), 3) DESC, t) = 1),
    ink AS (SELECT page, x - 16 AS x, y - 16 AS y FROM small JOIN o USING (page) WHERE p <= t),
    moved AS (SELECT page, angle, round_even(x * cos(radians(angle)) - y * sin(radians(angle)) + 16, 0) AS across,
                     round_even(16 - (x * sin(radians(angle)) + y * cos(radians(angle))), 0) AS down
              FROM ink, (SELECT unnest(range(41)) * 0.5e0 - 10 AS angle)),
    profile AS (SELECT page, angle, down, count(*) AS n FROM moved WHERE across BETWEEN 0 AND 31 AND down BETWEEN 0 AND 31 GROUP BY ALL),
    spread AS (SELECT page, angle, sum(n * n) / 32.0e0 - pow(sum(n) / 32.0e0, 2) AS v FROM profile GROUP BY ALL)
    SELECT page, angle AS skew_angle FROM spread QUALIFY row_number() OVER (PARTITION BY page ORDER BY round(v, 6) DESC, angle) = 1""", "turned_pixels")
oracle("img_page_box", """
    , clear AS (
      SELECT vec_id, x, y, CAST(round_even(CAST(p AS float) * scale - CAST(low AS float) * scale, 0) AS int) AS p
      FROM page_pixels JOIN (SELECT vec_id, min(p) AS low, CAST(255.0e0 / (max(p) - min(p)) AS float) AS scale FROM page_pixels GROUP BY vec_id) USING (vec_id)),
    h AS (SELECT vec_id, p, count(*) AS n FROM clear GROUP BY ALL),
    cuts AS (SELECT a.vec_id, a.p AS t, sum(b.n) FILTER (WHERE b.p <= a.p) AS below, sum(b.n) FILTER (WHERE b.p > a.p) AS above,
                    sum(b.n * b.p) FILTER (WHERE b.p <= a.p) AS low, sum(b.n * b.p) FILTER (WHERE b.p > a.p) AS high
             FROM h a JOIN h b USING (vec_id) GROUP BY a.vec_id, a.p),
    o AS (SELECT vec_id, t AS otsu FROM cuts WHERE above > 0 QUALIFY row_number() OVER (
      PARTITION BY vec_id ORDER BY round(below::DOUBLE * above * pow(low / below::DOUBLE - high / above::DOUBLE, 2), 3) DESC, t) = 1)
    SELECT vec_id AS page, any_value(otsu) AS otsu, CAST(greatest(min(x) - 40, 0) AS int) AS x0, CAST(greatest(min(y) - 40, 0) AS int) AS y0,
           CAST(least(max(x) + 40, 256) AS int) AS x1, CAST(least(max(y) + 40, 256) AS int) AS y1
    FROM clear JOIN o USING (vec_id) WHERE p <= otsu GROUP BY vec_id""", "page_pixels")
oracle("img_page_features", """
    , half AS (SELECT vec_id, y // 2 AS r, x // 2 AS c, round_even(avg(p), 0) AS v FROM page_pixels GROUP BY ALL)
    SELECT vec_id AS page, CAST(r // 4 * 32 + c // 4 AS int) AS cell, round(avg(1 - v / 255.0e0), 4) AS ink FROM half GROUP BY 1, 2""", "page_pixels")
oracle("img_pool_features", """
    SELECT vec_id, CAST((4 * (i // 8) + a) * 32 + 4 * (i % 8) + b AS int) AS cell, round(1 - p / 255.0e0, 4) AS ink
    FROM pixels, range(4) x(a), range(4) y(b)""", "pixels")

# ---- field extraction

for _name in ("invoice_no", "invoice_date", "gstin", "subtotal", "gst", "total"):
    oracle(f"fx_{_name}", f"SELECT doc_id, {_name} FROM extracted", "extracted")
oracle("fx_amount", "SELECT l_orderkey, l_linenumber, l_extendedprice AS amount FROM lineitem")
for _name in ("fx_vendor_match", "fx_vendor_match_in_parts"):
    oracle(_name, "SELECT doc_id, vendor_id, vendor_name, round(vendor_match, 9) AS vendor_match FROM extracted", "extracted")
oracle("fx_vendor_master", "SELECT DISTINCT vendor_id, vendor_name FROM truth", "truth")
oracle("fx_flags", "SELECT doc_id, flags FROM extracted", "extracted")
oracle("fx_record", "SELECT * REPLACE (round(vendor_match, 9) AS vendor_match) FROM extracted", "extracted")

# ---- silver

oracle("slv_filter_ingested", "SELECT doc_id, file_name, status FROM registry WHERE status = 'INGESTED'", "registry")
oracle("slv_join", """
    SELECT doc_id, file_name, sha256, ingest_date, skew_angle, blur_score, invoice_no, total FROM joined""", "joined")
oracle("slv_parse_date", "SELECT doc_id, TRY_CAST(invoice_date AS date) AS invoice_date FROM extracted", "extracted")
oracle("slv_ingest_date", "SELECT doc_id, CAST(date_trunc('month', d) AS date) AS ingest_date FROM truth", "truth")
oracle("slv_dq_reasons", "SELECT doc_id, dq_reasons FROM checked", "checked")
oracle("slv_split", """
    SELECT doc_id, CASE WHEN dq_reasons = '' THEN 'invoices' ELSE 'quarantine' END AS side FROM checked""", "checked")
oracle("slv_release", """
    SELECT doc_id, dq_reasons FROM checked
    WHERE dq_reasons <> '' AND NOT (invoice_no IS NOT NULL AND vendor_id IS NOT NULL AND coalesce(total > 0, false)
                                    AND coalesce(invoice_date <= DATE '2002-01-01', false))""", "checked")
oracle("slv_preview", """
    SELECT file_name, dq_reasons FROM checked WHERE dq_reasons <> '' ORDER BY file_name LIMIT 10""", "checked")

# ---- gold

oracle("gld_fact", "SELECT * FROM fact", "fact")
oracle("gld_dim_vendor", "SELECT * FROM vendors", "vendors")
oracle("gld_dim_date", """
    SELECT CAST(strftime(d, '%Y%m%d') AS int) AS date_key, CAST(d AS date) AS date, CAST(year(d) AS int) AS year,
           CAST(month(d) AS int) AS month, monthname(d) AS month_name, CAST(quarter(d) AS int) AS quarter,
           strftime(d, '%a') AS weekday
    FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS d FROM orders)""")
oracle("gld_vendor_monthly", """
    SELECT vendor_id, CAST(date_key // 10000 AS int) AS year, CAST(date_key // 100 % 100 AS int) AS month, count(*) AS invoice_count,
           CAST(sum(CAST(total AS decimal(24, 2))) AS double) AS total_spend,
           CAST(floor((2 * sum(CAST(round(total * 100) AS bigint)) + count(*)) / (2 * count(*))) AS double) / 100 AS avg_invoice
    FROM fact WHERE date_key BETWEEN 19950101 AND 20011231 GROUP BY 1, 2, 3""", "fact")
_TOP = """
    SELECT vendor_name, count(*) AS invoices, CAST(sum(CAST(total AS decimal(24, 2))) AS double) AS spend
    FROM fact JOIN vendors USING (vendor_id) GROUP BY vendor_name ORDER BY spend DESC, vendor_name LIMIT 5"""
oracle("rpt_top_vendors", _TOP, "fact", "vendors")
oracle("rpt_spend_from_text", _TOP, "fact", "vendors")

# ---- duplicates

oracle("ml_load", """
    SELECT doc_id, file AS file_name, invoice_no, invoice_no_gt, total, is_duplicate, is_anomaly FROM graded""", "graded")
oracle("dup_prepare", "SELECT * FROM prepared", "prepared")
oracle("dup_block_pairs", """
    SELECT vendor_id, (SELECT count(*) FROM prepared p WHERE p.vendor_id = v.vendor_id) AS documents,
           count(c.same) AS pairs, count(*) FILTER (WHERE c.same) AS true_pairs
    FROM (SELECT DISTINCT vendor_id FROM prepared) v LEFT JOIN couples c USING (vendor_id) GROUP BY vendor_id""", "couples")
oracle("dup_features", """
    , docs AS (SELECT *, min(doc_id) OVER (PARTITION BY vendor_id, date, total, inv_clean, true_base) AS head FROM prepared),
    pairs AS (
      SELECT least(a.head, b.head) AS doc_a, greatest(a.head, b.head) AS doc_b, abs(a.total - b.total) / greatest(a.total, b.total) AS diff,
             abs(date_diff('day', a.date, b.date)) AS gap, a.true_base = b.true_base AS same
      FROM docs a JOIN docs b ON a.vendor_id = b.vendor_id AND a.doc_id < b.doc_id)
    SELECT doc_a, doc_b, count(*) AS pairs, round(diff, 9) AS amount_diff, CAST(gap AS int) AS date_gap, CAST(same AS int) AS is_dup
    FROM pairs WHERE diff <= 0.2 AND gap <= 60 GROUP BY doc_a, doc_b, diff, gap, same""", "prepared")
oracle("dup_gap_classes", """
    SELECT CAST(abs(date_diff('day', a.date, b.date)) AS int) AS date_gap, CAST(a.true_base = b.true_base AS int) AS is_dup, count(*) AS pairs
    FROM prepared a JOIN prepared b ON a.vendor_id = b.vendor_id AND a.doc_id < b.doc_id GROUP BY 1, 2""", "prepared")
oracle("dup_training_weights", "SELECT count(*) AS pairs, count(*) FILTER (WHERE same) AS true_pairs FROM couples", "couples")
oracle("dup_flagged_copies", """
    SELECT a.doc_id AS doc_a, b.doc_id AS doc_b, true AS flagged, count(*) OVER () AS planted, count(*) OVER () AS caught, 0::BIGINT AS missed, true AS few_others
    FROM prepared a JOIN prepared b ON b.doc_id = a.doc_id || 'C'""", "prepared")
oracle("dup_exact_rule", """
    SELECT vendor_id, date, total, count(*) AS documents, min(doc_id) AS first_id FROM prepared
    GROUP BY 1, 2, 3 HAVING count(*) > 1""", "prepared")
oracle("dup_report", """
    , c AS (SELECT count(*) AS pairs, count(*) FILTER (WHERE same) AS true_pairs, count(*) FILTER (WHERE predicted AND same) AS caught,
                   count(*) FILTER (WHERE predicted AND NOT same) AS false_alarms,
                   count(*) FILTER (WHERE same AND NOT predicted) AS missed FROM couples)
    SELECT *, round(caught / (caught + false_alarms), 9) AS precision, round(caught / (caught + missed), 9) AS recall,
           round(2 * caught / (2 * caught + false_alarms + missed), 9) AS f1 FROM c""", "couples")

# ---- anomalies

oracle("ano_filter", """
    SELECT count(*) FILTER (WHERE ok) AS scored, count(*) FILTER (WHERE NOT ok) AS excluded
    FROM (SELECT coalesce(is_duplicate = 0 AND total > 0 AND vendor_id IS NOT NULL, false) AS ok FROM graded)""", "graded")
oracle("ano_log_total", "SELECT doc_id, round(log_total, 9) AS log_total FROM scorable", "scorable")
oracle("ano_vendor_z", "SELECT doc_id, vendor_z FROM z_scores", "z_scores")
oracle("ano_global_z", "SELECT doc_id, global_z FROM z_scores", "z_scores")
oracle("ano_review_budget", """
    , ranked AS (SELECT doc_id, rank() OVER w + (count(*) OVER (PARTITION BY total) - 1) / 2.0 AS r, count(*) OVER () AS n
                 FROM scorable WINDOW w AS (ORDER BY total DESC))
    SELECT doc_id, CAST(r <= greatest(1, floor(0.05 * n)) AS int) AS flagged FROM ranked""", "scorable")


def _compare(score: str, table: str = "z_scores") -> str:
    return f"""
    SELECT '{score}' AS score, k, CAST(greatest(1, floor(0.05 * n)) AS bigint) AS budget,
           round(auc, 9) AS roc_auc, round(ap, 9) AS avg_precision, round(top_k / k, 9) AS precision_at_k,
           round(top_b / k, 9) AS recall_at_budget
    FROM (SELECT CAST(sum(y) AS bigint) AS k, count(*) AS n, sum(CASE WHEN r <= p THEN y END) AS top_k,
                 sum(CASE WHEN r <= greatest(1, floor(0.05 * m)) THEN y END) AS top_b
          FROM (SELECT is_anomaly AS y, row_number() OVER (ORDER BY {score} DESC, sha256(doc_id || '#tie'), doc_id) AS r,
                       sum(is_anomaly) OVER () AS p, count(*) OVER () AS m FROM {table})),
         (SELECT sum(y * (below + ties / 2.0)) / (sum(y) * sum(1 - y)) AS auc
          FROM (SELECT is_anomaly AS y, sum(1 - is_anomaly) OVER (ORDER BY {score} RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
                         - sum(1 - is_anomaly) OVER (PARTITION BY {score}) AS below,
                       sum(1 - is_anomaly) OVER (PARTITION BY {score}) AS ties FROM {table})),
         (SELECT sum(y * tp / seen) / sum(y) AS ap
          FROM (SELECT is_anomaly AS y, sum(is_anomaly) OVER w AS tp, count(*) OVER w AS seen FROM {table}
                WINDOW w AS (ORDER BY {score} DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)))"""


oracle("ano_compare", _compare("global_z") + " UNION ALL " + _compare("vendor_z"), "z_scores")
oracle("ano_compare_forest", " UNION ALL ".join(_compare(score, "iso_scores") for score in ("global_z", "vendor_z", "iso_score")), "iso_scores")
oracle("ano_isolation_forest", "SELECT doc_id, is_anomaly, iso_score FROM iso_scores", "iso_scores")
oracle("ano_scores", """
    , ranked AS (SELECT *, rank() OVER w + (count(*) OVER (PARTITION BY iso_score) - 1) / 2.0 AS r, count(*) OVER () AS n
                 FROM iso_scores WINDOW w AS (ORDER BY iso_score DESC))
    SELECT doc_id, iso_score, vendor_z, CAST(r <= greatest(1, floor(0.05 * n)) AS int) AS flagged FROM ranked""", "iso_scores")

# ---- metrics

oracle("met_roc_auc", """
    SELECT round(sum(quality * (below + ties / 2.0)) / (sum(quality) * sum(1 - quality)), 9) AS roc_auc
    FROM (SELECT quality, (SELECT count(*) FROM scores o WHERE o.quality = 0 AND o.score < s.score) AS below,
                 (SELECT count(*) FROM scores o WHERE o.quality = 0 AND o.score = s.score) AS ties FROM scores s)""", "scores")
oracle("met_avg_precision", """
    SELECT round(sum(quality * tp / seen) / sum(quality), 9) AS avg_precision
    FROM (SELECT quality, sum(quality) OVER w AS tp, count(*) OVER w AS seen FROM scores
          WINDOW w AS (ORDER BY score DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""", "scores")
_RANKED = """(SELECT quality, row_number() OVER (ORDER BY score DESC, sha256(doc_id || '#tie'), doc_id) AS r,
                     sum(quality) OVER () AS p, count(*) OVER () AS n FROM scores)"""
oracle("met_precision_at_k", f"""
    SELECT CAST(max(p) AS bigint) AS k, round(sum(quality) / max(p), 9) AS precision_at_k FROM {_RANKED} WHERE r <= p""", "scores")
oracle("met_recall_at_budget", f"""
    SELECT CAST(max(greatest(1, floor(0.05 * n))) AS bigint) AS budget, round(sum(quality) / max(p), 9) AS recall_at_budget
    FROM {_RANKED} WHERE r <= greatest(1, floor(0.05 * n))""", "scores")
oracle("met_accuracy_macro_f1", """
    SELECT model, condition, seed, round(acc, 9) AS acc, round(macro_f1, 9) AS macro_f1 FROM runs""", "runs")
oracle("met_confusion", "SELECT condition, label, prediction, count(*) AS n FROM predictions GROUP BY ALL", "predictions")
oracle("met_confusion_matrix", "SELECT label, " + ", ".join(
    f"count(*) FILTER (WHERE prediction = {c}) AS p_{c}" for c in range(10)) + " FROM predictions GROUP BY label", "predictions")
oracle("met_mean_std", """
    SELECT model, condition, round(avg(acc), 3) AS acc_mean, round(stddev_samp(acc), 3) AS acc_std,
           round(avg(macro_f1), 3) AS macro_f1_mean, round(stddev_samp(macro_f1), 3) AS macro_f1_std
    FROM runs GROUP BY model, condition""", "runs")
oracle("met_improvement", """
    , m AS (SELECT model, avg(acc) AS v FROM runs GROUP BY model), b AS (SELECT v AS base FROM m WHERE model = 'model0')
    SELECT model, round(base, 6) AS base, round(v, 6) AS value, round((v - base) * 100, 6) AS absolute_points,
           round((v - base) / nullif(base, 0) * 100, 6) AS relative_pct,
           round((v - base) / nullif(1 - base, 0) * 100, 6) AS error_reduction_pct
    FROM m, b WHERE model <> 'model0'""", "runs")

# ---- evaluation reports

oracle("ev_counts", """
    SELECT (SELECT count(*) FROM registry WHERE status = 'INGESTED') AS ingested, (SELECT count(*) FROM quality) AS cleaned,
           (SELECT count(*) FROM truth) AS ocr""", "registry", "quality", "truth")
oracle("ev_missing_share", " UNION ALL ".join(
    f"SELECT '{f}' AS field, round(avg(CASE WHEN {f} IS NULL THEN 1.0e0 ELSE 0.0e0 END), 3) AS missing FROM extracted"
    for f in FIELDS), "extracted")
oracle("ev_top_flags", """
    SELECT flag, count(*) AS n FROM (SELECT unnest(string_split(flags, ',')) AS flag FROM extracted)
    GROUP BY flag ORDER BY n DESC, flag LIMIT 8""", "extracted")


def _describe(column: str, table: str) -> str:
    return f"""
    SELECT CAST(count({column}) AS double) AS count, round(avg({column}), 1) AS mean, round(stddev_samp({column}), 1) AS std,
           round(min({column}), 1) AS min, round(quantile_cont({column}, 0.25), 1) AS p25, round(median({column}), 1) AS p50,
           round(quantile_cont({column}, 0.75), 1) AS p75, round(max({column}), 1) AS max FROM {table}"""


oracle("ev_describe", _describe("mean_conf", "extracted"), "extracted")
oracle("ev_describe_amounts", _describe("l_quantity", "lineitem"))
oracle("ev_failing_example", """
    SELECT doc_id, flags, text FROM texts
    JOIN (SELECT doc_id, flags FROM extracted WHERE needs_review = 1 ORDER BY doc_id LIMIT 1) USING (doc_id)""",
       "texts", "extracted")

_WRONG = " UNION ALL ".join(
    f"SELECT doc_id, '{f}' AS field FROM marks WHERE " + (
        f"coalesce(abs({f} - {f}_gt), 1) > 0.01" if f in ("subtotal", "gst", "total") else f"NOT ok_{f}") for f in FIELDS)
oracle("ev_mismatches", f"SELECT field, count(*) AS wrong FROM ({_WRONG}) GROUP BY field", "marks")
oracle("ev_mismatch_examples", f"""
    SELECT field, doc_id FROM ({_WRONG}) QUALIFY row_number() OVER (PARTITION BY field ORDER BY doc_id) <= 5""", "marks")
oracle("ev_field_accuracy", " UNION ALL ".join(
    f"SELECT '{f}' AS field, round(avg(CAST(ok_{f} AS int)), 3) AS accuracy FROM marks" for f in FIELDS), "marks")
oracle("ev_straight_through", f"""
    , m AS (SELECT {' AND '.join(f'ok_{f}' for f in FIELDS)} AS ok, needs_review = 0 AS auto FROM marks)
    SELECT count(*) AS documents, round(avg(CAST(ok AS int)), 9) AS fully_correct, round(avg(CAST(auto AS int)), 9) AS straight_through,
           round(avg(CAST(ok AS int)) FILTER (WHERE auto), 9) AS auto_accuracy, count(*) FILTER (WHERE NOT auto) AS sent_to_review,
           count(*) FILTER (WHERE NOT auto AND NOT ok) AS reviewed_wrong,
           count(*) FILTER (WHERE auto AND NOT ok) AS unflagged_wrong FROM m""", "marks")
oracle("ev_hybrid", "SELECT * FROM hybrid", "hybrid")
_NORMAL = """
    SELECT doc_id, invoice_no, CASE WHEN k % 10 = 2 THEN '1901-01-01' ELSE invoice_date END AS invoice_date,
           CASE WHEN k % 10 = 3 THEN NULL ELSE gstin END AS gstin{vendor},
           CASE WHEN k % 10 = 7 THEN NULL ELSE subtotal END AS subtotal, gst,
           CASE WHEN k % 10 = 4 THEN 0.0e0 ELSE total END AS total FROM truth"""
oracle("ev_prediction_normalise", _NORMAL.replace("{vendor}", ""), "truth")
oracle("ev_prediction_vendors", _NORMAL.replace("{vendor}", ", vendor_id"), "truth")


def _model(name: str, table: str) -> str:
    ok = {f: (f"coalesce(abs(p.{f} - t.{f}) < 0.01, false)" if f in ("subtotal", "gst", "total")
              else f"coalesce(p.{f} = t.{f}, false)") for f in FIELDS}
    cells = ", ".join(f"avg(CAST({c} AS int)) AS {f}" for f, c in ok.items())
    return (f"SELECT '{name}' AS model, {cells}, avg(CAST({' AND '.join(ok.values())} AS int)) AS every "
            f"FROM {table} p JOIN truth t USING (doc_id) JOIN split s USING (doc_id) WHERE s.split = 'test'")


oracle("ev_model_compare", f"""
    , r AS ({_model('rules', 'extracted')} UNION ALL {_model('other', 'second')} UNION ALL {_model('hybrid', 'hybrid')})
    SELECT model, {', '.join(f'round({f}, 9) AS {f}' for f in FIELDS)}, round(every, 9) AS all_fields_correct,
           round(({' + '.join(FIELDS)}) / 7, 9) AS avg_field_accuracy FROM r""",
       "extracted", "second", "hybrid", "split", "truth")
oracle("ev_ocr_contains", "SELECT file, version, invoice_no, date, gstin, total FROM hits", "hits")


def _versions(source: str) -> str:
    parts = ["invoice_no", "date", "gstin", "total"]
    means = {p: f"avg(CAST(h.{p} AS int))" for p in parts}
    return (f"SELECT version, {', '.join(f'round({m}, 9) AS {p}' for p, m in means.items())}, "
            f"round(({' + '.join(means.values())}) / 4, 9) AS overall FROM {source} h GROUP BY version")


oracle("ev_ocr_versions", _versions("(SELECT * FROM hits WHERE is_duplicate = 0)"), "hits")
oracle("ev_ocr_versions_sample", _versions("""(SELECT * FROM hits JOIN (
        SELECT file FROM truth WHERE is_duplicate = 0 ORDER BY sha256(file || '#1'), file LIMIT 50) USING (file))"""), "hits", "truth")

# ---- splits and labels

oracle("spl_group", "SELECT doc_id, split FROM split", "split")
_THREE_WAY = """
    SELECT vec_id, label, CASE WHEN r <= floor(n * 0.7 + 1e-9) THEN 'train'
                               WHEN r <= floor(n * 0.7 + 1e-9) + floor(n * 0.15 + 1e-9) THEN 'val' ELSE 'test' END AS split
    FROM (SELECT vec_id, label, row_number() OVER (ORDER BY sha256(vec_id || '#42'), vec_id) AS r, count(*) OVER () AS n FROM embeddings)"""
oracle("clf_split_counts", f"SELECT split, label, count(*) AS n FROM ({_THREE_WAY}) GROUP BY split, label")
oracle("slv_stamp", "SELECT doc_id, true AS stamped FROM extracted", "extracted")
oracle("fx_vendor_match_none", "SELECT p_partkey AS header_id, CAST(NULL AS varchar) AS vendor_id, true AS low FROM part")
oracle("fx_vendor_match_exact", """
    WITH h AS (SELECT p_partkey AS header_id, CASE p_partkey % 4 WHEN 1 THEN 'x' || lower(substr(p_name, 2)) WHEN 3 THEN lower(reverse(p_name)) ELSE lower(p_name) END AS header FROM part),
    n AS (SELECT lower(p_name) AS header, min(p_name) AS vendor_id FROM part GROUP BY 1)
    SELECT header_id, vendor_id, vendor_id IS NOT NULL AS certain, true AS scored FROM h LEFT JOIN n USING (header)""")
oracle("spl_three_way", """
    SELECT vec_id, CASE WHEN r <= floor(n * 0.7 + 1e-9) THEN 'train'
                        WHEN r <= floor(n * 0.7 + 1e-9) + floor(n * 0.15 + 1e-9) THEN 'val' ELSE 'test' END AS split
    FROM (SELECT vec_id, row_number() OVER (ORDER BY sha256(vec_id || '#42'), vec_id) AS r, count(*) OVER () AS n FROM embeddings)""")
oracle("lab_find_spans", "SELECT doc_id, label, s, e FROM found", "found")
oracle("lab_resolve_overlaps", "SELECT doc_id, label, s, e FROM kept_spans", "kept_spans")
oracle("lab_complete_only", """
    SELECT count(*) FILTER (WHERE n = 7) AS kept, count(*) FILTER (WHERE n < 7) AS skipped
    FROM (SELECT doc_id, count(*) AS n FROM kept_spans GROUP BY doc_id)""", "kept_spans")
ORACLES["snk_csv"] = ORACLES["ev_ocr_contains"]
