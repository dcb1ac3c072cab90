import random
from collections import Counter
from difflib import SequenceMatcher

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from invoicelake.functions import similarity
from invoicelake.functions import text as T
from invoicelake.functions.similarity import NameIndex, ratio
from invoicelake.operators import extract, ocr
from invoicelake.plans import fixtures

GOOD = ("Acme Ltd TAX INVOICE\nPune GSTIN: 27ABCDE1234F1Z5\nInvoice No: INV-2026-00042-COPY\nDate: 2026-02-03\n"
        "Subtotal: Rs. 1,000.00\nGST 18%:  Rs. 180.00\nTOTAL:    Rs. 1,180.00")
MASTER = [("V2", "Acme Ltd"), ("V1", "Acme Ltd"), ("V3", "Bolt & Sons"), ("V4", "")]


def record(spark, text, conf=90.0, **options):
    docs = spark.createDataFrame([("d", text, conf)], "doc_id string, text string, mean_conf double")
    master = spark.createDataFrame(MASTER, "vendor_id string, vendor_name string")
    return extract.records(docs, master, **options).first()


def test_complete_document(spark):
    r = record(spark, GOOD)
    assert (r.invoice_no, r.invoice_date, r.gstin) == ("INV-2026-00042-COPY", "2026-02-03", "27ABCDE1234F1Z5")
    assert (r.vendor_id, r.vendor_name, r.vendor_match) == ("V1", "Acme Ltd", 1.0)
    assert (r.subtotal, r.gst, r.total, r.flags, r.needs_review) == (1000.0, 180.0, 1180.0, "", 0)


def test_empty_and_missing_text(spark):
    for text in ("", None):
        r = record(spark, text)
        assert r.invoice_no is None and r.total is None
        assert r.flags == ("missing_invoice_no,missing_invoice_date,missing_gstin,missing_subtotal,missing_gst,missing_total"
                           if r.vendor_id else "missing_invoice_no,missing_invoice_date,missing_gstin,missing_vendor_id,"
                           "missing_subtotal,missing_gst,missing_total")
        assert r.needs_review == 1


def test_last_total_wins_and_subtotal_is_no_total(spark):
    assert record(spark, GOOD + "\nTotal 99.00").total == 99.0
    assert record(spark, "SUBTOTAL: 5.00").total is None
    assert record(spark, "sub total: Rs. 7.50").total == 7.5         # a space makes it a TOTAL, as defined


def test_flags_in_order(spark):
    assert record(spark, GOOD.replace("180.00", "181.00", 1), conf=40.0).flags == "total_mismatch,gst_rate_mismatch,low_ocr_confidence"
    assert record(spark, GOOD, conf=None).flags == "low_ocr_confidence"
    assert record(spark, GOOD, conf=60.0).flags == ""


@pytest.mark.parametrize("header, expected", [
    ("Acme Ltd tax  invoice", "acme ltd"), ("  Acme Ltd \t", "acme ltd"), ("Acme\rLtd", "acme"),
    ("Acme\u2028Ltd", "acme"), ("TAX INVOICE", ""), ("Acme\x1cLtd", "acme")])
def test_header(spark, header, expected):
    df = spark.createDataFrame([(header,)], "t string").select(T.vendor_header(F.col("t")))
    assert df.first()[0] == expected


def test_score_below_threshold_is_kept(spark):
    r = record(spark, GOOD.replace("Acme Ltd", "Zzz Acme Corp"))
    assert r.vendor_id is None and 0 < r.vendor_match < 0.8


def brute(master, text):
    best = (None, None, 0.0)
    for i, n in sorted(master):
        score = SequenceMatcher(None, n.lower(), text).ratio()
        if score > best[2]:
            best = (i, n, score)
    return best


words = st.text(alphabet="abcd 1", max_size=12)


@settings(max_examples=200, deadline=None)
@given(st.lists(words, min_size=1, max_size=12), words)
def test_bounded_search_equals_full_search(names, text):
    master = [(f"v{i}", n) for i, n in enumerate(names)]
    assert NameIndex(master).best(text) == brute(master, text)


def test_long_header_with_common_letters():
    master = [("a", "steel works"), ("b", "iron works")]
    text = "iron works " * 40
    assert NameIndex(master).best(text) == brute(master, text)


def test_parts_equal_whole(spark, rows):
    names = [(f"V{i:03d}", f"vendor {w} {i % 7}") for i, w in enumerate(["north", "south", "east", "west", "mid"] * 12)]
    heads = [(i, h) for i, h in enumerate(["vendor north 0", "vemdor south 3", "xyz", "", None, "vendor mid", "vendor eest 6"])]
    master = spark.createDataFrame(names, "vendor_id string, vendor_name string")
    docs = spark.createDataFrame(heads, "id int, header string")
    whole = extract.match_vendors(docs, "header", master)
    parts = extract.match_vendors(docs, "header", master, names_per_task=7, headers_per_task=5)
    assert rows(whole) == rows(parts)
    for r in whole.collect():
        if r.header:
            want = brute(names, r.header)
            assert r.vendor_match == want[2] and r.vendor_id == (want[0] if want[2] >= 0.8 else None)


def matched_blocks(a, b):
    return sum(block.size for block in SequenceMatcher(None, a, b).get_matching_blocks())


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab1 ", max_size=14), st.text(alphabet="ab1 ", max_size=14))
def test_shared_pieces_are_a_lower_bound(a, b):
    best = SequenceMatcher(None, a, b).ratio()
    for q in similarity.PIECES:
        def grams(text):
            return Counter(text[i:i + q] for i in range(len(text) - q + 1))
        assert sum((grams(a) & grams(b)).values()) >= similarity.shared_pieces(len(b), best, q)


def test_index_equals_full_search(spark):
    """Headers that resemble names, nothing, or have odd characters; names with the same spelling, few and many pieces met."""
    draw = random.Random(5)
    stems = ["north star", "alpha works", "müller & söhne", "东方贸易公司", "a", "zz", "steel steel steel"]
    names = [(f"V{k:03d}", f"{draw.choice(stems)} {draw.randint(0, 400)}".title() if k % 9 else draw.choice(stems)) for k in range(300)]
    heads = []
    for k in range(160):
        text = list(draw.choice(names)[1].lower())
        for _ in range(draw.randint(0, 4)):
            place = draw.randrange(len(text) + 1)
            text[place:place + draw.randint(0, 2)] = draw.choice(["", "x", "0", "ab"])
        heads.append((k, "".join(text)))
    heads += [(1000, "qqqq"), (1001, ""), (1002, None), (1003, "9 8 7 6"), (1004, "north " * 400)]
    master = spark.createDataFrame(names, "vendor_id string, vendor_name string")
    found = extract.match_vendors(spark.createDataFrame(heads, "id int, header string"), "header", master).collect()
    assert len(found) == len(heads)
    for r in found:
        want = brute(names, r.header) if r.header is not None else (None, None, 0.0)
        assert r.vendor_match == pytest.approx(want[2], abs=1e-12)
        assert (r.vendor_id, r.vendor_name) == (want[:2] if want[2] >= 0.8 else (None, None)), r


def test_close_names_need_no_pieces(spark, monkeypatch):
    """One letter misread in names that differ in few digits: settled without the postings of their common pieces."""
    def never(*_):
        raise AssertionError("the index of pieces was asked")
    monkeypatch.setattr(extract, "_by_pieces", never)
    names = [(f"V{n:04d}", f"Customer#{n:09d}") for n in range(0, 900, 7)]
    heads = [name.lower().replace("customer", "custoner") for _, name in names] + ["customer#00000001", "customer#0000000077", None]
    found = extract.match_vendors(spark.createDataFrame([(h,) for h in heads], "header string"), "header", spark.createDataFrame(names, "vendor_id string, vendor_name string"))
    for row in found.collect():
        expected = (None, None, 0.0) if row["header"] is None else brute(names, row["header"])
        assert (row["vendor_id"], row["vendor_name"], row["vendor_match"]) == expected


def test_deletions_equal_full_search(spark):
    """Short strings of few letters, many of them close to each other, with equal scores and lengths from 1 to beyond ``LONGEST``."""
    draw = random.Random(3)

    def word(n):
        return "".join(draw.choice("ab1") for _ in range(n))
    texts = [word(draw.randint(1, 9)) for _ in range(60)] + [word(draw.randint(60, 70)) for _ in range(8)]
    names = [(f"V{draw.randint(0, 30)}", text.upper()) for text in texts]
    heads = {word(draw.randint(1, 9)) for _ in range(60)} | {t[:k] + draw.choice(["", "b", "z1"]) + t[k + 1:] for t in texts for k in (0, len(t) // 2)} | {""}
    found = extract.match_vendors(spark.createDataFrame([(h,) for h in heads], "header string"), "header",
                                  spark.createDataFrame(names, "vendor_id string, vendor_name string"), threshold=0.0)
    result = {row["header"]: (row["vendor_id"], row["vendor_match"]) for row in found.collect()}
    assert len(result) == len(heads)
    for head in heads:
        vendor, _, score = brute(names, head)
        assert result[head] == (vendor, pytest.approx(score, abs=1e-12)), head


@pytest.mark.parametrize("text, number, expected", [("abca", 0, 1), ("abca", 1, 4), ("aab", 1, 2), ("abcd", 2, 6), ("a", 1, 1), ("a", 2, 0), ("", 1, 0)])
def test_left_out(spark, text, number, expected):
    kept = spark.createDataFrame([(text,)], "t string").select(similarity.left_out(F.col("t"), number)).first()[0]
    assert len(kept) == len(set(kept)) == expected


def test_ratio_of_nulls(spark):
    df = spark.createDataFrame([("ab", "ab"), ("abc", "abd"), (None, "a"), ("", "")], "a string, b string")
    assert [r[0] for r in df.select(ratio("a", "b")).collect()] == [1.0, pytest.approx(2 / 3), None, 1.0]


def test_words_to_text(spark, rows):
    data = [("1", 2, "world ", "80"), ("1", 1, " hello", "90"), ("1", 3, "x", "-1"), ("1", 4, "  ", "99"),
            ("1", 5, "y", "n/a"), ("2", 1, "z", None)]
    words = spark.createDataFrame(data, "doc_id string, pos long, word string, conf string")
    docs = spark.createDataFrame([("1",), ("2",), ("3",)], "doc_id string")
    assert rows(ocr.aggregate_words(words, docs)) == [("1", "hello world", 85.0, 2), ("2", "", 0.0, 0), ("3", "", 0.0, 0)]
    lined = words.withColumn("line", F.when(F.col("pos") < 2, 1).otherwise(2))
    assert ocr.aggregate_words(lined, line="line").first().text == "hello\nworld"


@pytest.mark.parametrize("kind", ["long", "int", "string"])
def test_words_in_order(spark, kind):
    """Scattered rows, words without a position first, equal positions by their text; positions and words leave as two lists."""
    data = [("1", p, w, "90") for p, w in [("2", "c"), (None, "b"), ("0", "z"), ("2", "a"), (None, "a"), ("1", "m")]]
    words = spark.createDataFrame(data, "doc_id string, pos string, word string, conf string").withColumn("pos", F.col("pos").cast(kind)).repartition(4)
    found = ocr.aggregate_words(words)
    assert [tuple(r) for r in found.collect()] == [("1", "a b z m a c", 90.0, 6)]
    assert "struct(p, pos" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_spread_grows_with_the_parts_of_the_input(spark):
    cores = spark.sparkContext.defaultParallelism
    df = spark.range(10).repartition(cores + 1)
    assert fixtures.spread(df, 8).rdd.getNumPartitions() == 8 * (cores + 1) and fixtures.spread(df).rdd.getNumPartitions() == cores
