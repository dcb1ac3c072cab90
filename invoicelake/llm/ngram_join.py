"""Jaccard join of documents on word n-grams by vertical partitioning.

Words are ``[^\\x20\\x09-\\x0D]+`` after A-Z are lower-cased; a document is the set of its distinct ``SHINGLE``-word sequences (with fewer words, the
whole sequence), held as 64-bit hashes. Two documents link when ``100 * intersection >= 75 * union``. Equal sets are one class.

1. *Hash order.* Every set sends its ``SHARE`` smallest hashes, and a set that shares fewer of them than any partner's cut-off
   allows (``_needed``) has no partner. The order is cut into fragments; each counts, for its part of every set, how many hashes some other set has too, and the counts are summed
   per document. Most documents end here. Hashes that repeat within a batch are sent once.
2. *Frequency order.* The remaining sets are ordered by (documents that have the n-gram, hash). Linked sets meet in their
   rare beginnings (prefix filter). Of each meeting place all documents are first paired with its most central one only.
3. *Verification.* The frequency order is cut into ``FRAGMENTS`` ranges of equal weight, the overlap of a pair is counted in each of
   them separately and summed.
4. Documents that meet but lie in different components yet are then paired in full. Only n-grams that lie in several components
   count here, and what cannot reach the threshold by its size, their number and a bitmap of them is not paired. So a group of
   thousands of near copies costs pairs in proportion to its size, and no link between components is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from invoicelake.llm.common import byte_rows, give_back, later_copies, mixed, row_groups, stored, texts, with_row, without_rows, word_codes

SHINGLE = 5
SHARE = 0.4
FRAGMENTS = 8
BITMAP = 16
BATCH_BYTES = 4 << 20
STEP = 1.05  # ratio of neighbouring size classes
_WORD = np.ones(256, bool)
_WORD[[9, 10, 11, 12, 13, 32]] = False
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def hash_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of every row of some bytes."""
    codes, counts = word_codes(data, offsets, _WORD)
    grams = np.zeros(len(codes), np.uint64)
    full = max(len(codes) - SHINGLE + 1, 0)
    total = np.zeros(full, np.uint64)
    for k in range(SHINGLE):
        total = total * _FACTOR + codes[k:full + k]
    grams[:full] = mixed(total)
    ends, out = np.cumsum(counts).tolist(), []
    for start, end in zip([0, *ends], ends):
        if end - start >= SHINGLE:
            out.append(np.unique(grams[start:end - SHINGLE + 1]))
        elif end > start:
            short = np.zeros(1, np.uint64)
            for k in range(start, end):
                short = mixed(short * _FACTOR + codes[k:k + 1] + np.uint64(end - start))
            out.append(short)
        else:
            out.append(np.empty(0, np.uint64))
    return out


def signature(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def _least(n: np.ndarray) -> np.ndarray:
    """Fewest n-grams that a set of ``n`` shares with any partner: ceil(0.75 n)."""
    return (3 * n + 3) // 4


def _taken(n: np.ndarray) -> np.ndarray:
    """How many of its smallest hashes a set of ``n`` sends in step 1."""
    return np.ceil(SHARE * n).astype(np.int64)


def _needed(n: np.ndarray) -> np.ndarray:
    """Fewest of its sent hashes that a set of ``n`` finds among those that a partner of m sends.

    The two share o >= 3/7 (n + m) hashes. At worst the hashes that only one of them has come first in its order: it then sends the first
    taken - (size - o) = o - (size - taken) of the shared ones, and both send the shorter beginning. The set's own is at least
    taken - (n - ceil(0.75 n)). The partner's is at least 3/7 (n + m) - (1 - SHARE) m, which is smallest for m = 4/3 n: (4 SHARE - 1) / 3 n.
    """
    return np.minimum(_taken(n) - (n - _least(n)), np.ceil((4 * SHARE - 1) / 3 * n - 1e-6).astype(np.int64))


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[np.ndarray]]]:
    for batch in batches:
        data, offsets = byte_rows(batch.column("text"))
        for first, last in row_groups(offsets, BATCH_BYTES):
            yield batch.column("doc_id")[first:last], hash_sets(data, offsets[first:last + 1])
    give_back()


_PARTS = "batch long, fragment int, doc_ids binary, known binary, sizes binary, signatures binary, counts binary, hashes binary"
_NAMES = [part.split()[0] for part in _PARTS.split(", ")]


def _parts(docs: DataFrame, fragments: int) -> DataFrame:
    """One row per batch of documents (fragment -1: ids, set sizes, signatures, hashes known to be shared) and one per batch and
    fragment: how many hashes of each document it holds, and the hashes. A hash that repeats in the batch is sent once, for no document."""
    def row(**cells) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([cells.get(n)], pa.int64() if n == "batch" else pa.int32() if n == "fragment" else pa.binary())
                                           for n in _NAMES], _NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, (ids, sets) in enumerate(_batches(batches)):
            batch = (TaskContext.get().partitionId() << 32) + k
            sizes = np.array([len(s) for s in sets], np.int64)
            taken = _taken(sizes)
            of = np.repeat(np.arange(len(sets)), taken)
            hashes = np.concatenate([s[:n] for s, n in zip(sets, taken)])
            distinct, place, copies = np.unique(hashes, return_inverse=True, return_counts=True)
            shared = copies[place] > 1
            yield row(batch=batch, fragment=-1, doc_ids=pa.array(ids).fill_null(0).to_numpy().astype(np.int64).tobytes(),
                      known=np.concatenate([np.asarray(ids.is_valid()).astype(np.int64), np.bincount(of[shared], minlength=len(sets))]).tobytes(),
                      sizes=sizes.tobytes(), signatures=b"".join(map(signature, sets)))
            once = np.flatnonzero(~shared)
            values = np.concatenate([distinct[copies > 1], hashes[once]])
            owner = np.concatenate([np.full(int((copies > 1).sum()), -1), of[once]])
            cut = ((values >> np.uint64(32)) * np.uint64(2 * fragments) >> np.uint64(32)).astype(np.int64)  # long texts fill the lower half
            order = np.lexsort((owner, cut))
            values, owner, cut = values[order].astype(np.uint32), owner[order], cut[order]
            for fragment in np.unique(cut).tolist():
                own = slice(*np.searchsorted(cut, [fragment, fragment + 1]).tolist())
                yield row(batch=batch, fragment=fragment, hashes=values[own].tobytes(),
                          counts=np.bincount(owner[own] + 1, minlength=len(sets) + 1).astype(np.uint32).tobytes())
    return docs.mapInArrow(run, _PARTS)


def _shared_in_fragment(table: pa.Table) -> pa.Table:
    """For every batch of a fragment, how many hashes of each document also lie in another batch. All low 32 bits of a
    fragment are compared: a chance match keeps a document for the next step and does no harm."""
    values = [np.frombuffer(b.as_buffer(), np.uint32) for b in table.column("hashes")]
    everything = np.sort(np.concatenate(values))
    shared = everything[1:][everything[1:] == everything[:-1]]
    out = []
    for own, cell in zip(values, table.column("counts")):
        counts = np.frombuffer(cell.as_buffer(), np.uint32).astype(np.int64)
        place = np.searchsorted(shared, own)
        hit = np.zeros(len(own), bool)
        inside = place < len(shared)
        hit[inside] = shared[place[inside]] == own[inside]
        of = np.repeat(np.arange(len(counts)), counts)
        out.append(np.bincount(of[hit], minlength=len(counts))[1:].astype(np.int64).tobytes())
    return pa.table({"batch": table.column("batch"), "counts": pa.array(out, pa.binary())})


def _sum_batch(table: pa.Table) -> pa.Table:
    """Rows of one batch: its own (with the ids) and one per fragment. Sums the counts of each document."""
    head = next(i for i, b in enumerate(table.column("doc_ids")) if b.is_valid)
    cell = lambda name: np.frombuffer(table.column(name)[head].as_buffer(), np.int64)
    ids, sizes = cell("doc_ids"), cell("sizes")
    valid, total = cell("known")[:len(ids)], cell("known")[len(ids):].copy()
    for counts in table.column("counts"):
        if counts.is_valid:
            total += np.frombuffer(counts.as_buffer(), np.int64)
    alive = (sizes > 0) & (total >= _needed(sizes))
    marks = table.column("signatures")[head].as_py()
    return pa.table({"doc_id": pa.array(ids, pa.int64(), mask=valid == 0), "n": pa.array(sizes),
                     "signature": pa.array([marks[i:i + 16] for i in range(0, len(marks), 16)], pa.binary()), "alive": pa.array(alive)})


def _described(docs: DataFrame) -> DataFrame:
    """``doc_id, n, signature, alive`` per row; ``alive`` is false when step 1 rules out every partner of another set."""
    spark = docs.sparkSession
    fragments = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = stored(_parts(docs, fragments), "ngram-fragments")
    counted = (parts.filter("fragment >= 0").select("batch", "fragment", "counts", "hashes").groupBy("fragment")
               .applyInArrow(_shared_in_fragment, "batch long, counts binary"))
    heads = parts.filter("fragment < 0").select("batch", "doc_ids", "known", "sizes", "signatures", F.lit(None).cast("binary").alias("counts"))
    rows = heads.unionByName(counted, allowMissingColumns=True)
    return stored(rows.groupBy("batch").applyInArrow(_sum_batch, "doc_id long, n long, signature binary, alive boolean"), "ngram-sizes")


def _hashes(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sets in _batches(batches):
            values = np.concatenate(sets).view(np.int64)
            ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array([signature(s) for s in sets], pa.binary()),
                                              pa.ListArray.from_arrays(pa.array(ends), pa.array(values))], ["signature", "grams"])
    return docs.mapInArrow(run, "signature binary, grams array<long>")


def _sets(docs: DataFrame, described: DataFrame) -> DataFrame:
    """``node, signature, n, c, ranked`` of the classes that may still have partners: the n-grams that another class has too, as
    (frequency, hash) in that order; c is their number."""
    classes = described.filter("alive").groupBy("signature").agg(F.min("doc_id").alias("first"))
    chosen = classes.filter(F.col("first").isNotNull()).select("first").distinct()
    nameless = described.filter("alive AND doc_id IS NULL").limit(1).count() > 0
    # the same plan at every size: texts are dealt out by id and not sorted
    rows = docs.join(chosen.hint("shuffle_hash"), F.col("doc_id") == F.col("first"), "left_semi")
    if nameless:
        rows = rows.unionByName(docs.filter("doc_id IS NULL"))
    sets = stored(_hashes(rows).dropDuplicates(["signature"]).withColumn("node", F.monotonically_increasing_id()), "ngram-sets")
    tokens = sets.select("node", F.explode("grams").alias("gram"))
    known = tokens.groupBy("gram").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    ranked = (tokens.join(known, "gram").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("df", "gram"))).alias("ranked"))
              .withColumn("c", F.size("ranked")))
    sized = sets.select("node", "signature", F.size("grams").alias("n"))
    return stored(ranked.join(sized, "node").filter(4 * F.col("c") >= 3 * F.col("n")), "ngram-ranked")


def _may_link(a: str, b: str) -> Column:
    """No pair that fails this can link: the sizes are too far apart, or fewer n-grams can be shared than are needed."""
    na, nb, least = F.col(f"n{a}"), F.col(f"n{b}"), F.least(f"c{a}", f"c{b}")
    return (7 * F.least(least, na, nb) >= 3 * (na + nb))


def _bitmap(ranked: Column) -> Column:
    """A set of n-grams as ``BITMAP`` numbers of 64 bits, one bit per n-gram by its hash."""
    def number(k: int) -> Column:
        own = F.filter(ranked, lambda g: F.shiftright(g["gram"], 6).bitwiseAND(F.lit(BITMAP - 1)) == k)
        bit = lambda g: F.call_function("shiftleft", F.lit(1).cast("long"), g["gram"].bitwiseAND(F.lit(63)).cast("int"))
        return F.aggregate(own, F.lit(0).cast("long"), lambda total, g: total.bitwiseOR(bit(g)))
    return F.struct(*(number(k).alias(f"b{k}") for k in range(BITMAP)))


def _bits_allow(a: str, b: str) -> Column:
    """Every bit that differs stands for an n-gram only one of the two sets has; what is left must suffice for a link."""
    apart = sum((F.bit_count(F.col(f"bits{a}.b{k}").bitwiseXOR(F.col(f"bits{b}.b{k}"))) for k in range(BITMAP)), F.lit(0))
    return 7 * (F.col(f"c{a}") + F.col(f"c{b}") - apart) >= 6 * (F.col(f"n{a}") + F.col(f"n{b}"))


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (x, y) that link: partial overlaps per fragment of the frequency order, summed per pair."""
    key = lambda g: g["df"].cast("double") + (g["gram"].cast("double") / 2.0**64 + 0.5)
    shares = [k / FRAGMENTS for k in range(1, FRAGMENTS)]
    pivots = sets.select(F.explode("ranked").alias("g")).select(F.percentile_approx(key(F.col("g")), shares).alias("p")).first()["p"] or []
    bounds = [None, *pivots, None]

    def segment(low: float | None, high: float | None) -> Column:
        inside = lambda g: (F.lit(True) if low is None else key(g) >= low) & (F.lit(True) if high is None else key(g) < high)
        return F.transform(F.filter("ranked", inside), lambda g: g["gram"])
    segments = sets.select("node", "n", F.posexplode(F.array(*(segment(a, b) for a, b in zip(bounds, bounds[1:])))).alias("fragment", "grams"))
    segments = stored(segments.filter(F.size("grams") > 0), "ngram-segments")
    left = segments.select(F.col("node").alias("x"), F.col("n").alias("nx"), "fragment", F.col("grams").alias("gx"))
    right = segments.select(F.col("node").alias("y"), F.col("n").alias("ny"), "fragment", F.col("grams").alias("gy"))
    partial = (pairs.join(left, "x").join(right, ["y", "fragment"])
               .select("x", "y", "nx", "ny", F.size(F.array_intersect("gx", "gy")).alias("overlap")))
    summed = partial.groupBy("x", "y").agg(F.first("nx").alias("nx"), F.first("ny").alias("ny"), F.sum("overlap").alias("overlap"))
    return stored(summed.filter(7 * F.col("overlap") >= 3 * (F.col("nx") + F.col("ny"))).select("x", "y"), "ngram-links")


def components(links: DataFrame) -> DataFrame:
    """``node, component``: the smallest node reachable over links (x, y); nodes without links are left out.

    Alternating stars: every node hands its larger neighbours, then its smaller ones, to the smallest it knows; logarithmically
    many rounds, each two joins on aggregated minima, so no neighbourhood is ever gathered.
    """
    edges = stored(links.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).filter("u > v").distinct(), "edges")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v").distinct()
        large = stored(large, "edges")
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(small_least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(
            F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").filter("u > v").distinct()
        small = stored(small, "edges")
        changed = small.join(edges, ["u", "v"], "left_anti").limit(1).count() + edges.join(small, ["u", "v"], "left_anti").limit(1).count()
        edges = small
        if not changed:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _size_class(n: Column) -> Column:
    return F.floor(F.log(n.cast("double")) / F.log(F.lit(STEP)))


def _places(sets: DataFrame) -> DataFrame:
    """The meeting places of each set: its n-grams in frequency order as far as a partner must have one of them. The n - c
    n-grams that nobody shares stand before all others."""
    prefix = F.col("n") - F.ceil(F.col("n") * 3 / 4) + 1 - (F.col("n") - F.col("c"))
    own = [k for k in ("node", "n", "c", "component", "bits") if k in sets.columns]
    return sets.select(*own, F.explode(F.slice("ranked", F.lit(1), prefix.cast("int"))).alias("g")).select(*own, F.col("g.gram").alias("gram"))


def _crossing(sets: DataFrame, known: DataFrame) -> DataFrame:
    """The sets by the n-grams that lie in several components: only these count for a pair from two components."""
    tokens = stored(sets.select("node", F.explode("ranked").alias("g")).select("node", "g.*").join(known, "node", "left")
                    .withColumn("component", F.coalesce("component", "node")), "ngram-tokens")
    several = tokens.groupBy("gram").agg(F.min("component").alias("a"), F.max("component").alias("b")).filter("a != b").select("gram")
    crossing = (tokens.join(several, "gram", "left_semi").groupBy("node")
                .agg(F.first("component").alias("component"), F.sort_array(F.collect_list(F.struct("df", "gram"))).alias("ranked")))
    crossing = crossing.withColumn("c", F.size("ranked")).join(sets.select("node", "n"), "node").filter(4 * F.col("c") >= 3 * F.col("n"))
    return crossing.withColumn("bits", _bitmap(F.col("ranked")))


def _links(sets: DataFrame) -> DataFrame:
    """Links (x, y) between nodes that give the same components as all links."""
    places = stored(_places(sets), "ngram-places")
    heads = places.groupBy("gram").agg(F.count(F.lit(1)).alias("met"), F.max(F.struct(
        (F.col("c") / F.col("n")).alias("central"), "n", "c", "node")).alias("head")).filter("met > 1")
    heads = stored(heads, "ngram-heads")  # tables of their own, so that Spark can split a place with many sets in the joins
    stars = (places.join(heads, "gram").select(F.col("node").alias("x"), F.col("n").alias("nx"), F.col("c").alias("cx"), F.col("head.node").alias("y"),
                                               F.col("head.n").alias("ny"), F.col("head.c").alias("cy"))
             .filter("x != y").filter(_may_link("x", "y")).select("x", "y").distinct())
    first = _verified(stored(stars, "ngram-stars"), sets)
    known = components(first)
    placed = stored(_places(_crossing(sets, known)), "ngram-placed")
    parts = placed.groupBy("gram", "component").agg(F.count(F.lit(1)).alias("size"))
    mixed_places = (parts.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds"), F.max(F.struct("size", "component")).alias("largest"))
                    .filter("kinds > 1").select("gram", F.col("largest.component").alias("major")))
    mixed_places = stored(mixed_places, "ngram-mixed")
    rows = placed.join(mixed_places, "gram").withColumn("class", _size_class(F.col("n")))
    # partners of a set of n with c shared n-grams have between 0.75 n and 7/3 c - n, and at most 4/3 n of them
    low, high = F.greatest(F.floor(F.col("n") * 3 / 4), F.lit(1)), F.least(F.ceil(F.col("n") * 4 / 3), F.floor(F.col("c") * 7 / 3) - F.col("n") + 1)
    few = (rows.filter("component != major").withColumn("low", low).withColumn("high", high).filter("high >= low")
           .select("gram", F.col("node").alias("x"), F.col("n").alias("nx"), F.col("c").alias("cx"), F.col("component").alias("kx"),
                   F.col("bits").alias("bitsx"),
                   F.explode(F.sequence(_size_class(F.col("low")), _size_class(F.col("high")))).alias("class")))
    all_rows = rows.select("gram", "class", F.col("node").alias("y"), F.col("n").alias("ny"), F.col("c").alias("cy"), F.col("component").alias("ky"),
                           F.col("bits").alias("bitsy"))
    cross = (few.join(all_rows, ["gram", "class"]).filter("kx != ky").filter(_may_link("x", "y")).filter(_bits_allow("x", "y"))
             .select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).distinct())
    return first.unionByName(_verified(stored(cross, "ngram-cross"), sets))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id``, the smallest doc_id reachable over links.

    NULL and blank texts have no n-grams and link with nothing. Rows are compared by their texts, so rows that share an id may lie in
    different components; a NULL id is named only by a component without other ids.
    """
    rows = texts(docs)
    described = _described(rows)
    sets = _sets(rows, described)
    linked = components(_links(sets)).join(sets.select("node", "signature"), "node").select("signature", "component")
    classes = described.filter("n > 0").groupBy("signature").agg(F.min("doc_id").alias("first")).join(linked, "signature", "left")
    named = stored(classes, "ngram-classes")
    lowest = named.filter("component IS NOT NULL").groupBy("component").agg(F.min("first").alias("lowest"))
    named = named.join(lowest, "component", "left").select("signature", F.coalesce("lowest", "first").alias("component_id"))
    return described.join(named, "signature", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def one_per_group(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component, the one with the smallest doc_id (rows without an id last), then the first in the table; all columns as
    they are. Every row has its own verdict; texts without words stay. ``docs`` is a table read from files.
    """
    rows, row = with_row(docs)
    near = near_duplicates(rows.select(F.col(row).alias("doc_id"), "text")).filter("n_shingles > 0")
    near = stored(near.select("doc_id", F.col("component_id").alias("group")), "near")
    several = near.groupBy("group").count().filter("count > 1").select("group")
    return without_rows(rows, row, later_copies(rows, row, near.join(several, "group", "left_semi")))
