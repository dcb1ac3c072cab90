import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from invoicelake.llm import packing, token_file
from invoicelake.llm.common import new_folder, stored
from invoicelake.llm.tokens import Encoder

PATH = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, start string, ids string"
ROWS = [(3, "Hello world, it's  two\n\n spaces "), (1, None), (2, ""), (9, " \t\n "), (7, "word " * 30_000), (8, "é😀<|endoftext|> x"),
        (5, "a\x85 b\xa0 c  　d"), (4, "x" * 50_000), (6, "Hello world, it's  two\n\n spaces "), (7, "again"), (None, "none")]


def direct(texts):
    found = Encoder.of(PATH).tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [np.array([*x.ids, 0], "<u4") for x in found]


def encoded(texts):
    out = []
    for _, _, ids, counts in Encoder.of(PATH).encode(pa.array(texts, pa.string())):
        out += np.split(ids, np.cumsum(counts)[:-1])
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from(" \n\tab'st1!é\x1c\x85\xa0 "), st.characters(codec="utf-8")), max_size=40), max_size=6))
def test_parts_give_the_ids_of_the_whole_text(texts):
    for own, want in zip(encoded(texts), direct(texts), strict=True):
        assert own.tolist() == want.tolist()


def test_cached_parts_survive_and_are_dropped(monkeypatch):
    texts = [t for _, t in ROWS]
    for _ in range(3):
        assert [x.tolist() for x in encoded(texts)] == [x.tolist() for x in direct(texts)]
    monkeypatch.setattr("invoicelake.llm.tokens.MOST_PARTS", 1)
    assert [x.tolist() for x in encoded(texts)] == [x.tolist() for x in direct(texts)]


def test_new_parts_are_encoded_a_few_at_a_time():
    """2 MB of distinct words: neither the work arrays nor the answers of the library are held for all of them."""
    column = pa.array([" ".join(f"w{i}x{k}" for k in range(300)) for i in range(800)])
    encoder, calls = Encoder(PATH), []

    class Counted:
        def encode_batch_fast(self, parts, add_special_tokens):
            calls.append(len(parts))
            return own.encode_batch_fast(parts, add_special_tokens=add_special_tokens)
    own, encoder.tokenizer = encoder.tokenizer, Counted()
    tracemalloc.start()
    groups = [(last - first, len(ids), counts.sum()) for first, last, ids, counts in encoder.encode(column)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(rows for rows, _, _ in groups) == 800 and all(ids == counts for _, ids, counts in groups)
    assert max(calls) <= 4_096 and sum(calls) >= 230_000 and peak < 60e6, peak


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


@pytest.mark.parametrize("length", [64, 2048])
def test_files_round_trip(spark, length):
    folder = new_folder(spark, "tokens")
    shards = token_file.write(frame(spark, ROWS).repartition(3), folder, PATH, length)
    got = [tuple(r) for r in token_file.read(spark, folder, shards).orderBy("start").collect()]
    rows = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    at, want = 0, []
    for (doc, _), ids in zip(rows, direct([t for _, t in rows])):
        want.append((doc, at, len(ids), zlib.crc32(ids)))
        at += len(ids)
    assert got == want


def test_sequences_and_masks(spark):
    folder = new_folder(spark, "tokens")
    shards = token_file.write(frame(spark, ROWS).coalesce(1), folder, PATH, 128)
    for shard, total in [(r["shard"], r["n_tokens"]) for r in shards.collect()]:
        file, all_ids = token_file.Shard(folder, shard), []
        for i in range(-(-total // 128)):
            ids, mask = file.sequence(i)
            assert len(ids) == len(mask) == 128 and ids.dtype == np.uint16
            all_ids.append(ids[mask])
        assert sum(map(len, all_ids)) == total
        assert np.concatenate(all_ids).tolist() == np.concatenate(list(file.ids(0, total))).tolist()


def test_ids_and_masks_are_views_of_the_file(spark):
    folder = new_folder(spark, "tokens")
    shards = token_file.write(frame(spark, [(1, "word " * 4_000)]), folder, PATH, 128)
    file, last = token_file.Shard(folder, shards.first()["shard"]), -(-shards.first()["n_tokens"] // 128) - 1
    first, before = file.sequence(0), pa.total_allocated_bytes()
    held = [file.sequence(i) for i in (0, 1, last)]
    assert np.shares_memory(first[0], held[0][0]) and not np.shares_memory(first[0], held[1][0])
    assert np.shares_memory(first[1], held[0][1]) and np.shares_memory(first[1], held[1][1])  # one mask for all full sequences
    assert pa.total_allocated_bytes() == before and first[1].dtype == bool and first[1].all()
    assert held[2][1].sum() == shards.first()["n_tokens"] - 128 * last < 128


def test_one_id_of_many_rows_is_cut_and_keeps_its_order(spark):
    texts = sorted(f"{k:03d} {'x' * (k % 7)}" for k in range(400))
    folder = new_folder(spark, "tokens")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        shards = token_file.write(frame(spark, [(7, t) for t in reversed(texts)]).repartition(3), folder, PATH)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert shards.count() > 1
    got = token_file.read(spark, folder, shards).orderBy("start").select("ids_crc32").collect()
    assert [r[0] for r in got] == [zlib.crc32(ids) for ids in direct(texts)]


def test_writing_again_leaves_the_same_files(spark):
    folder = new_folder(spark, "tokens")
    first = token_file.write(frame(spark, ROWS), folder, PATH).collect()
    assert token_file.write(frame(spark, ROWS), folder, PATH).collect() == first
    files, root = token_file.filesystem(folder)
    names = [f.base_name for f in files.get_file_info(token_file.pafs.FileSelector(root))]
    assert len(names) == 2 * len(first)


def test_empty_table(spark):
    folder = new_folder(spark, "tokens")
    assert token_file.read(spark, folder, token_file.write(frame(spark, []), folder, PATH)).count() == 0
    assert packing.pack(frame(spark, []), PATH).count() == 0


def check_pieces(rows, pieces, capacity):
    want = {doc: ids for (doc, _), ids in zip(rows, direct([t for _, t in rows]))}
    by_doc, by_window = {}, {}
    for p in pieces:
        by_doc.setdefault(p["doc_id"], []).append(p)
        by_window.setdefault(p["sequence_id"], []).append(p)
    assert by_doc.keys() == want.keys()
    for doc, own in by_doc.items():
        own.sort(key=lambda p: p["start"])
        assert [p["start"] for p in own] == np.cumsum([0, *(p["length"] for p in own)])[:-1].tolist()
        assert b"".join(bytes(p["ids"]) for p in own) == want[doc].tobytes()
        assert {p["doc_tokens"] for p in own} == {len(want[doc])}
    for own in by_window.values():
        own.sort(key=lambda p: p["offset"])
        assert [p["offset"] for p in own] == np.cumsum([0, *(p["length"] for p in own)])[:-1].tolist()
        assert sum(p["length"] for p in own) <= capacity
    return sorted(sum(p["length"] for p in own) for own in by_window.values())


def test_packing_keeps_every_id_once(spark):
    rows = [r for r in ROWS if r != (7, "again")]
    for capacity in (8, 1024):
        fills = check_pieces(rows, stored(packing.pack(frame(spark, rows).coalesce(1), PATH, capacity), "pieces").collect(), capacity)
        assert sum(f < capacity for f in fills) <= 1
    many = [(i, "a b c d " * (i % 40)) for i in range(500)]
    check_pieces(many, packing.pack(frame(spark, many).repartition(3), PATH, 64).collect(), 64)


def test_level_is_the_sum_of_squares_choice():
    rng = np.random.default_rng(3)
    packer = packing.Packer(32)
    for _ in range(300):
        size = int(rng.integers(1, 32))
        counts = packer.count.copy()
        best = None
        for h in range(32 - size, -1, -1):
            if h and not counts[h]:
                continue
            after = counts.copy()
            after[h] -= h > 0
            after[h + size] += h + size < 32
            value = int((after[1:32] ** 2).sum())
            if best is None or value < best[0]:
                best = (value, h)
        assert packer.level(size) == best[1]
        packer.add(0, np.arange(size, dtype=np.uint32))


def test_open_windows_are_bounded():
    packer = packing.Packer(1024, most_open=50)
    for i in range(5_000):
        packer.add(i, np.full(600, i, np.uint32))
        assert packer.opened <= 51
    packer.finish()
    assert sum(r[2] for r in packer.done) == 3_000_000 and packer.closed <= 3_000_000 // 1024 + 1


def test_native_checksum_of_ids(spark):
    row = packing.pack(frame(spark, [(1, "some words")]), PATH).select(F.crc32("ids").alias("c")).first()
    assert row["c"] == zlib.crc32(direct(["some words"])[0])
