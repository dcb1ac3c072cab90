"""Cheapest repair of conversation structure by a parallel Viterbi search.

A repaired conversation has the roles ``(s?(ua)+)?`` by initials: maybe a system turn, then user and assistant in turn. The edits of a row are Keep (0), Rerole to user
or assistant (2) and Delete (3; blank and duplicate rows have no other), an empty user or assistant row may be Inserted anywhere (2), and a truncated row
that stays costs 1. ``audit`` is the initials of the cheapest edits in order; of several the least in ASCII.

Rows are sorted by (conv_id, turn, role, text), NULL turns first, over as many tasks as there are, and cut into chunks of ``CHUNK`` rows, so a
conversation may be of any length. The costs to come are a vector over four states (nothing yet, system, user, assistant last):

1. Every chunk runs backwards from a speculative vector at its end; the last one of a conversation knows its own.
2. Fix-up passes: a chunk whose right neighbour now begins with another vector than it was run with runs again. Vectors count as equal when they differ by a
   constant only, since constants do not change which edits are cheapest; a run stops as soon as its vector equals the old one there.
   Where rows have roles, vectors converge within a few rows whatever they began with. Long stretches of foreign roles need not converge at all; what
   has not after ``PASSES`` passes is finished exactly: such a chunk becomes a matrix (cost from each state to each), and the matrices of a conversation are applied
   one behind the other.
3. The least audit is traced forwards along the stitched vectors: all states that cheapest audits with the same letters so far may be in form a set, and each step
   takes the least letter that some member allows. Chunks tell for every set at their beginning the set at their end; these short tables are composed
   per conversation, and then every chunk writes its letters and rows.

The role of an inserted or reroled row follows from its distance to the end, where the last row is an assistant's.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from invoicelake.llm.common import stored

CHUNK = 256
CHUNK_CHARS = 1 << 20
PASSES = 6
INITIALS = "sua"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
START, SYSTEM, USER, ASSISTANT = range(4)
_FAR = 1 << 40
_NEXT = (USER, USER, ASSISTANT, USER)  # where a user or assistant row leads from a state
_KEPT = ({START: SYSTEM}, {START: USER, SYSTEM: USER, ASSISTANT: USER}, {USER: ASSISTANT}, {})  # by the row's initial; the last for any other
LEGAL = {(0, 1), (1, 2), (2, 1)}  # su, ua, au
SOUND, CUT, GONE = range(3)  # a row's fault: none, truncated, blank or duplicate
Vector = tuple[int, int, int, int]


def _with_inserts(costs: list[int]) -> Vector:
    for _ in range(2):  # two inserts lead anywhere
        costs = [min(cost, INSERT + costs[_NEXT[state]]) for state, cost in enumerate(costs)]
    return tuple(min(cost, _FAR) for cost in costs)


FINAL = _with_inserts([0, _FAR, _FAR, 0])
SPECULATIVE = (0, 0, 0, 0)


def _moves(code: int) -> list[tuple[str, int, dict[int, int]]]:
    """(letter, cost, state -> state) of the edits of a row with this code, by letter."""
    initial, fault = divmod(code, 3)
    out = [("D", DELETE, {state: state for state in range(4)})]
    if fault != GONE:
        extra = TRUNCATED if fault == CUT else 0
        out += [("K", KEEP + extra, _KEPT[initial]), ("R", REROLE + extra, dict(enumerate(_NEXT)))]
    return out


_MOVES = [_moves(code) for code in range(12)]


def relative(costs: Vector) -> Vector:
    """A vector without its constant."""
    least = min(costs)
    return tuple(min(cost - least, _FAR) for cost in costs)


@lru_cache(maxsize=1 << 14)
def step(after: Vector, code: int) -> Vector:
    """Costs to come before a row from those behind it, both without their constants."""
    costs = [min((cost + after[moves[state]] for _, cost, moves in _MOVES[code] if state in moves), default=_FAR) for state in range(4)]
    return relative(_with_inserts(costs))


def matrix(codes: bytes) -> list[Vector]:
    """Per state behind some rows the costs from every state before them to it."""
    columns = []
    for state in range(4):
        costs = tuple(0 if other == state else _FAR for other in range(4))
        for code in reversed(codes):
            costs = _with_inserts([min((cost + costs[moves[x]] for _, cost, moves in _MOVES[code] if x in moves), default=_FAR) for x in range(4)])
        columns.append(costs)
    return columns


def sweep(codes: bytes, after: Vector, old: Vector | None = None) -> tuple[Vector, bool]:
    """The vector before some rows, and whether it differs from the one for ``old`` behind them."""
    after = relative(after)
    before = relative(old) if old is not None else None
    for code in reversed(codes):
        after = step(after, code)
        if before is not None:
            before = step(before, code)
            if before == after:
                return after, False  # equal from here on
    return after, before is None or before != after


@lru_cache(maxsize=1 << 14)
def _least_step(here: Vector, after: Vector | None, code: int, states: int) -> tuple[str, int]:
    """The least letter on a cheapest way from a set of states (bits), and the states it leads to. ``after`` is None where no row is left."""
    if after is None:
        ends: list[tuple[str, int, dict[int, int]]] = []
        least = 0
    else:
        ends = _MOVES[code]
        # both vectors lack their constants: the cheapest edit of a state on a cheapest way restores the difference
        raw = _with_inserts([min((cost + after[moves[state]] for _, cost, moves in ends if state in moves), default=_FAR) for state in range(4)])
        least = min(raw)
    steps = [*ends, ("I", INSERT, dict(enumerate(_NEXT)))]
    for letter, cost, moves in sorted(steps, key=lambda s: s[0]):
        target = 0
        for state in range(4):
            if states >> state & 1 and state in moves:
                to_come = here[moves[state]] if letter == "I" else after[moves[state]] - least
                if here[state] == cost + to_come and here[state] < _FAR:
                    target |= 1 << moves[state]
        if target:
            return letter, target
    raise ValueError("no cheapest way from these states")


def trace(codes: bytes, after: Vector, states: int, last: bool) -> tuple[str, int]:
    """The least audit over some rows from a set of states at their beginning, and the set at their end."""
    vectors = [after if last else relative(after)]
    for code in reversed(codes):
        vectors.append(step(relative(vectors[-1]), code))
    vectors.reverse()
    letters = []
    for row, code in enumerate(codes):
        letter = "I"
        while letter == "I":
            letter, states = _least_step(vectors[row], relative(vectors[row + 1]), code, states)
            letters.append(letter)
    while last and not any(states >> state & 1 and after[state] == 0 for state in (START, ASSISTANT)):
        letter, states = _least_step(after, None, 0, states)
        letters.append(letter)
    return "".join(letters), states


def _chunks(rows: DataFrame) -> DataFrame:
    """Sorted rows of (conv_id, role, text, code, again) as chunks; ``again`` further copies of a row are duplicates."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq, part, conv = 0, 0, None
        codes, roles, texts, chars = bytearray(), [], [], 0

        def taken() -> dict[str, object]:
            nonlocal seq, chars, codes, roles, texts
            record = {"conv_id": conv, "part": part, "seq": seq, "codes": bytes(codes), "roles": roles, "texts": texts}
            seq, chars, codes, roles, texts = seq + 1, 0, bytearray(), [], []
            return record
        schema = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("seq", pa.int64()), ("codes", pa.binary()),
                            ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))])
        for batch in batches:
            out, waiting = [], 0
            for row in batch.to_pylist():
                if codes and row["conv_id"] != conv:
                    waiting += chars
                    out.append(taken())
                conv, part = row["conv_id"], row["part"]
                copies = row["again"] + 1
                while copies:
                    if len(codes) >= CHUNK or chars >= CHUNK_CHARS:
                        waiting += chars
                        out.append(taken())
                    if waiting >= CHUNK_CHARS:
                        yield pa.RecordBatch.from_pylist(out, schema)
                        out, waiting = [], 0
                    first = copies == row["again"] + 1
                    gone = not first or row["code"] % 3 == GONE
                    codes.append(row["code"] if first else row["code"] // 3 * 3 + GONE)
                    roles.append("" if gone else row["role"])
                    texts.append("" if gone else row["text"])
                    chars += 0 if gone else len(row["text"])
                    copies -= 1
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
        if codes:
            yield pa.RecordBatch.from_pylist([taken()], schema)
    return rows.mapInArrow(run, "conv_id long, part long, seq long, codes binary, roles array<string>, texts array<string>")


def _faults(turns: DataFrame) -> DataFrame:
    """Distinct rows with their code and the number of further copies."""
    rows = turns.groupBy("conv_id", "turn", "role", "text").count()
    rows = rows.withColumn("said", F.sha2(F.concat_ws(":", F.octet_length("role").cast("string"), "role", "text"), 256))
    place = F.struct(F.col("turn").isNotNull().alias("has"), "turn")
    # only what is said in several turns needs a look at its first place; a stored table, so that Spark can split the rows of a frequent one
    again = (rows.groupBy("conv_id", "said").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("turns")).filter("turns > 1")
             .select(F.col("conv_id").alias("in_conv"), F.col("said").alias("what"), "first"))
    again = stored(again, "repeated-turns")
    rows = rows.join(again, F.col("conv_id").eqNullSafe(F.col("in_conv")) & (F.col("said") == F.col("what")), "left")
    seen = F.coalesce(F.col("first") < place, F.lit(False))
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    fault = F.when(blank | seen, GONE).when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), CUT).otherwise(SOUND)
    initial = F.instr(F.lit(INITIALS), F.left("role", F.lit(1)))
    initial = F.when((F.col("role") != "") & (initial > 0), initial - 1).otherwise(3)
    return rows.select("conv_id", "turn", "role", "text", (initial * 3 + fault).alias("code"), blank.alias("blank"), (F.col("count") - 1).alias("again"))


def _indexed(chunks: DataFrame) -> DataFrame:
    """Number of each chunk in its conversation (from 0) and whether it is the last; chunks are a small fraction of the rows."""
    inside = Window.partitionBy("conv_id").orderBy("part", "seq")
    return chunks.select("conv_id", "part", "seq", "codes", (F.row_number().over(inside) - 1).alias("at"),
                         F.lead("part").over(inside).isNull().alias("last"))


def _run_backwards(chunks: DataFrame) -> DataFrame:
    """``chunks`` with (conv_id, at, last, codes, used, before, wanted): runs those again whose ``wanted`` vector is not the one used."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            used, before = [], []
            for codes, old, start, wanted in zip(frame["codes"], frame["used"], frame["before"], frame["wanted"]):
                if old is not None and tuple(old) == tuple(wanted):
                    used.append(old)
                    before.append(start)
                    continue
                vector, changed = sweep(codes, tuple(wanted), None if old is None else tuple(old))
                used.append(list(wanted))
                before.append(list(vector) if changed else start)
            yield frame.assign(used=used, before=before)[["conv_id", "at", "last", "codes", "used", "before"]]
    return chunks.mapInPandas(run, "conv_id long, at int, last boolean, codes binary, used array<long>, before array<long>")


def _vector(values: Vector) -> Column:
    return F.array(*(F.lit(value).cast("long") for value in values))


def _stitched(chunks: DataFrame) -> DataFrame:
    """Of conversations of several chunks: every chunk's vector behind it (``used``), by fix-up passes until none changes."""
    nothing = F.lit(None).cast("array<long>")
    state = stored(_run_backwards(chunks.select("conv_id", "at", "last", "codes", nothing.alias("used"), nothing.alias("before"),
                                                F.when(F.col("last"), _vector(FINAL)).otherwise(_vector(SPECULATIVE)).alias("wanted"))), "vectors")
    for _ in range(PASSES):
        right = state.select(F.col("conv_id").alias("in_conv"), (F.col("at") - 1).alias("left_at"), F.col("before").alias("next"))
        joined = state.join(right, F.col("conv_id").eqNullSafe(F.col("in_conv")) & (F.col("at") == F.col("left_at")), "left").withColumn(
            "wanted", F.when(F.col("last"), F.col("used")).otherwise(F.col("next"))).drop("in_conv", "left_at", "next")
        if not joined.filter(F.col("used") != F.col("wanted")).limit(1).count():
            return state
        state = stored(_run_backwards(joined), "vectors")
    return stored(_applied(state), "vectors")


def _applied(state: DataFrame) -> DataFrame:
    """The vectors by matrices: exact, whether or not they converge."""
    def matrices(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.assign(used=[[cost for column in matrix(codes) for cost in column] for codes in frame["codes"]])[["conv_id", "at", "last", "codes", "used"]]

    def applied(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("at", ascending=False)
        after, used, before = relative(FINAL), [], []
        for flat in frame["used"]:
            used.append(list(after))
            after = relative(tuple(min(flat[4 * y + x] + after[y] for y in range(4)) for x in range(4)))
            before.append(list(after))
        used[0] = list(FINAL)
        return frame.assign(used=used, before=before)
    kind = "conv_id long, at int, last boolean, codes binary, used array<long>"
    return state.mapInPandas(matrices, kind).groupBy("conv_id").applyInPandas(applied, kind + ", before array<long>")


def _entries(state: DataFrame) -> DataFrame:
    """For chunks of long conversations: the set of states at their beginning and how many rows (mod 2) the chunks behind them leave."""
    def tables(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for codes, used, before, last, at in zip(frame["codes"], frame["used"], frame["before"], frame["last"], frame["at"]):
                table = [0] * 16
                for states in [1 << START] if at == 0 else range(1, 16):
                    costs = {before[state] for state in range(4) if states >> state & 1}
                    if len(costs) == 1 and costs.pop() < _FAR:
                        audit, end = trace(codes, tuple(used), states, last)
                        table[states] = end | (len(audit) - audit.count("D")) % 2 << 4
                out.append(bytes(table))
            yield frame.assign(table=out)[["conv_id", "at", "table"]]

    def composed(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("at")
        states, entry, odd = 1 << START, [], []
        for table in frame["table"]:
            entry.append(states)
            odd.append(table[states] >> 4)
            states = table[states] & 15
        behind = 0
        for k in range(len(odd) - 1, -1, -1):
            odd[k], behind = behind, (behind + odd[k]) % 2
        return pd.DataFrame({"in_conv": frame["conv_id"], "in_at": frame["at"], "states": entry, "odd_behind": odd})
    short = state.mapInPandas(tables, "conv_id long, at int, table binary")
    return short.groupBy("conv_id").applyInPandas(composed, "in_conv long, in_at int, states int, odd_behind int")


def _pieces(chunks: DataFrame) -> DataFrame:
    """What every chunk adds to its conversation."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                codes, cost = row["codes"], 0
                audit, _ = trace(codes, tuple(row["used"]), row["states"], row["last"])
                left = len(audit) - audit.count("D") + row["odd_behind"]
                lines, at = [], 0
                for letter in audit:
                    if letter != "D":
                        left -= 1
                        role = ("assistant", "user")[left % 2] if letter in "IR" else row["roles"][at]
                        lines.append(f"{role}:{'' if letter == 'I' else row['texts'][at]}")
                    if letter in "KR" and codes[at] % 3 == CUT:
                        cost += TRUNCATED
                    cost += {"D": DELETE, "I": INSERT, "K": KEEP, "R": REROLE}[letter]
                    at += letter != "I"
                initials = [code // 3 for code in codes]
                out.append({"conv_id": row["conv_id"], "at": row["at"], "audit": audit, "lines": "\n".join(lines) if lines else None, "cost": cost,
                            "illegal": sum(pair not in LEGAL for pair in zip(initials, initials[1:])), "head": initials[0], "tail": initials[-1]})
            yield pa.RecordBatch.from_pylist(out, schema)
    schema = pa.schema([("conv_id", pa.int64()), ("at", pa.int32()), ("audit", pa.string()), ("lines", pa.string()), ("cost", pa.int64()),
                        ("illegal", pa.int64()), ("head", pa.int32()), ("tail", pa.int32())])
    return chunks.mapInArrow(run, "conv_id long, at int, audit string, lines string, cost long, illegal long, head int, tail int")



def repaired(turns: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired.

    Reads conv_id, turn, role and text; NULL role and text are one space, a NULL conv_id is a conversation like any other. Rows go by (turn, role, text),
    NULL turns first; equal rows follow each other. A row's first fault counts: blank (only ``[\\x20\\x09-\\x0D]``), duplicate (role and text seen earlier),
    truncated (last other character not ``[.!?]``). ``gaps`` are missing turn numbers, ``illegal`` the neighbours whose role initials are not su, ua
    or au; an empty role has no initial and can only be reroled or deleted. ``repaired`` is ``role:text`` of the rows left, joined by newlines.
    """
    space = F.lit(" ")
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"))
    faults = stored(_faults(rows), "faults")
    fault, copies = F.col("code") % 3, F.col("again") + 1
    counts = faults.groupBy("conv_id").agg(
        F.max("turn").alias("highest"), F.min("turn").alias("lowest"), F.count_distinct("turn").alias("turns"),
        F.sum(F.when(F.col("blank"), copies).otherwise(0)).alias("blank"),
        F.sum(F.when(~F.col("blank"), F.when(fault == GONE, copies).otherwise(F.col("again"))).otherwise(0)).alias("duplicate"),
        F.sum(F.when(fault == CUT, 1).otherwise(0)).alias("truncated"))
    in_order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text"]
    spread = faults.repartitionByRange(*in_order).sortWithinPartitions(*in_order)
    chunks = stored(_chunks(spread.select("conv_id", "role", "text", "code", "again", F.spark_partition_id().cast("long").alias("part"))), "chunks")
    index = stored(_indexed(chunks), "chunk-index")
    alone = (F.col("at") == 0) & F.col("last")
    long = index.filter(~alone)
    state = _stitched(long)
    entries = state.select("conv_id", "at", "used").join(
        _entries(state), F.col("conv_id").eqNullSafe(F.col("in_conv")) & (F.col("at") == F.col("in_at"))).select(
        F.col("in_conv"), F.col("in_at"), "used", "states", "odd_behind")
    where = index.select("part", "seq", "at", "last", "conv_id").join(
        entries, F.col("conv_id").eqNullSafe(F.col("in_conv")) & (F.col("at") == F.col("in_at")), "left").select(
        "part", "seq", "at", "last", F.coalesce("used", _vector(FINAL)).alias("used"),
        F.coalesce("states", F.lit(1 << START)).alias("states"), F.coalesce("odd_behind", F.lit(0)).alias("odd_behind"))
    pieces = _pieces(chunks.join(where, ["part", "seq"]).select("conv_id", "at", "last", "codes", "roles", "texts", "used", "states", "odd_behind"))
    joined = pieces.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("at", "audit", "lines", "head", "tail"))).alias("parts"),
                                           F.sum("cost").alias("cost"), F.sum("illegal").alias("illegal"))
    seams = F.size(F.filter(F.zip_with(F.slice("parts", F.lit(2), F.size("parts")), F.slice("parts", F.lit(1), F.size("parts") - 1),
                                       lambda b, a: (a["tail"] * 4 + b["head"]).isin([a * 4 + b for a, b in LEGAL])), lambda ok: ~ok))
    joined = joined.select(F.col("conv_id").alias("in_conv"), "cost", (F.col("illegal") + seams).alias("illegal"),
                           F.array_join(F.transform("parts", lambda p: p["audit"]), "").alias("audit"),
                           F.array_join(F.transform("parts", lambda p: p["lines"]), "\n").alias("repaired"))
    gaps = F.coalesce(F.col("highest") - F.col("lowest") + 1 - F.col("turns"), F.lit(0))
    return counts.join(joined, F.col("conv_id").eqNullSafe(F.col("in_conv"))).select(
        "conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired")


def damaged(turns: DataFrame) -> DataFrame:
    """Rows with faults planted by the checksum of ``conv_id:turn``."""
    space = F.lit(" ")
    kind = F.crc32(F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space), F.coalesce(F.col("turn").cast("string"), space))) % 20
    rows = turns.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = rows.filter("kind <> 0").select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                                           F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"))
    return rows.drop("copy")


def report(turns: DataFrame) -> DataFrame:
    """Damage, repair, and digests for every conversation of ``turns``, those without rows after the damage included."""
    fixed = repaired(damaged(turns)).withColumnRenamed("conv_id", "of")
    every = turns.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return every.join(fixed, F.col("conv_id").eqNullSafe(F.col("of")), "left").select(
        "conv_id", *(F.coalesce(F.col(n), F.lit(0)).cast("long").alias(n) for n in numbers), F.coalesce("audit", F.lit("")).alias("audit"),
        F.sha2(F.coalesce("repaired", F.lit("")), 256).alias("repaired_sha256"))
