"""Conversation repair against a plain search over all edits."""

import hashlib
import heapq
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from invoicelake.llm import repair as rp

GOOD = re.compile(r"(s?(ua)+)?")
PREFIX = re.compile(r"s?(ua)*u?")


def cheapest(rows):
    """(cost, audit) by a search over whole audits; ``rows`` are (role initial, truncated, must go)."""
    # state: cost, audit, rows used, role initials so far cut to what matters
    heap, done = [(0, "", 0, "")], {}
    best = None
    while heap:
        cost, audit, used, roles = heapq.heappop(heap)
        if best is not None and cost > best[0]:
            break
        if used == len(rows) and GOOD.fullmatch(roles):
            best = min(best, (cost, audit)) if best else (cost, audit)
        key = (used, roles[:1] if len(roles) < 2 else "+" + roles[-1])
        if done.setdefault(key, (cost, [])) [0] < cost:
            continue
        if audit in done[key][1]:
            continue
        done[key][1].append(audit)
        for initial in "ua":
            if PREFIX.fullmatch(roles + initial):
                heapq.heappush(heap, (cost + 2, audit + "I", used, roles + initial))
        if used < len(rows):
            initial, truncated, gone = rows[used]
            heapq.heappush(heap, (cost + 3, audit + "D", used + 1, roles))
            if not gone:
                if initial and PREFIX.fullmatch(roles + initial):
                    heapq.heappush(heap, (cost + truncated, audit + "K", used + 1, roles + initial))
                for other in "ua":
                    if PREFIX.fullmatch(roles + other):
                        heapq.heappush(heap, (cost + 2 + truncated, audit + "R", used + 1, roles + other))
    return best


def expected(turns):
    """The report of one conversation of (turn, role, text) rows after damage."""
    rows = sorted(((t is not None, t or 0, r, x, t) for t, r, x in turns))
    seen, coded, faults = set(), [], [0, 0, 0]
    for _, _, role, text, _ in rows:
        blank = not re.search(r"[^\x20\x09-\x0D]", text)
        again = not blank and (role, text) in seen
        seen.add((role, text))
        cut = not blank and not again and re.findall(r"[^\x20\x09-\x0D]", text)[-1] not in ".!?"
        for k, fault in enumerate((blank, again, cut)):
            faults[k] += fault
        coded.append((role[:1], int(cut), blank or again))
    pairs = [(a[0] + b[0]) for a, b in zip(coded, coded[1:])]
    numbers = {r[4] for r in rows if r[4] is not None}
    gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
    cost, audit = cheapest(coded) if coded else (0, "")
    out, left = [], iter(rows)
    kept = len(audit) - audit.count("D")
    for letter in audit:
        row = next(left) if letter != "I" else None
        if letter != "D":
            kept -= 1
            role = row[2] if letter == "K" else ("assistant", "user")[kept % 2]
            out.append(f"{role}:{row[3] if row else ''}")
    return (gaps, *faults, sum(pair not in ("su", "ua", "au") for pair in pairs), cost, audit, "\n".join(out))


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def expected_report(rows):
    after, out = damage(rows), []
    for conv in {r[0] for r in rows}:
        *numbers, audit, text = expected([r[1:] for r in after if r[0] == conv])
        out.append((conv, *numbers, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


coded_rows = st.lists(st.tuples(st.sampled_from(["s", "u", "a", "x"]), st.integers(0, 1), st.sampled_from([False, False, False, True])), max_size=9)


def code(row):
    return rp.INITIALS.find(row[0]) % 4 * 3 + (rp.GONE if row[2] else rp.CUT if row[1] else rp.SOUND)


@settings(max_examples=300, deadline=None)
@given(coded_rows, st.integers(1, 4))
def test_chunks_and_sets_give_the_least_audit(rows, size):
    codes = bytes(code(row) for row in rows)
    whole, _ = rp.trace(codes, rp.FINAL, 1, True)
    assert whole == cheapest(rows)[1]
    parts = [codes[k:k + size] for k in range(0, len(codes), size)] or [b""]
    behind, vectors = rp.FINAL, []
    for part in reversed(parts):
        vectors.append(behind)
        behind, _ = rp.sweep(part, behind)
    states, audit = 1, ""
    for k, (part, after) in enumerate(zip(parts, reversed(vectors))):
        letters, states = rp.trace(part, after, states, k == len(parts) - 1)
        audit += letters
    assert audit == whole


def test_speculation_converges():
    codes = bytes([3, 6] * 50)
    assert rp.sweep(codes, rp.SPECULATIVE)[0] == rp.sweep(codes, rp.FINAL)[0]
    assert not rp.sweep(codes, rp.FINAL, rp.SPECULATIVE)[1]
    foreign = bytes([9] * 50)  # nothing tells which of these are the user's
    assert rp.sweep(foreign, rp.FINAL, rp.SPECULATIVE)[1]


def test_foreign_roles_over_many_chunks(spark, monkeypatch):
    """Vectors that do not converge are finished by matrices."""
    monkeypatch.setattr(rp, "CHUNK", 4)
    rows = [(conv, k, "tool", f"{k}.") for conv, n in ((None, 61), (1, 90), (2, 3)) for k in range(n)]
    rows += [(3, k, "uas"[k % 7 % 3], f"{k}") for k in range(70)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: (r["cost"], r["audit"]) for r in rp.repaired(table).collect()}
    for conv in (None, 1, 2, 3):
        coded = [(r[2][0], int(not r[3].endswith(".")), False) for r in rows if r[0] == conv]
        audit, _ = rp.trace(bytes(code(c) for c in coded), rp.FINAL, 1, True)
        costs = {"D": 3, "R": 2, "I": 2, "K": 0}
        kept = sum(c[1] for c, letter in zip(coded, audit.replace("I", "")) if letter != "D")
        assert got[conv] == (sum(costs[letter] for letter in audit) + kept, audit)


TEXTS = [None, "", "  \n", "Hello.", "What is it?", "cut of", "Fine!  \n", "x", "ok.", "né"]
ROLES = ["user", "assistant", "system", "user", "assistant", None, "", "tool", "s2"]


@pytest.mark.parametrize(("seed", "chunk"), [(1, 256), (2, 3), (3, 2)])
def test_report_against_brute_force(spark, monkeypatch, seed, chunk):
    monkeypatch.setattr(rp, "CHUNK", chunk)
    draw = random.Random(seed)
    rows = []
    for conv in [None, *range(60)]:
        turn = draw.randint(-2, 5)
        for _ in range(draw.randint(1, 9)):
            role, text = draw.choice(ROLES), draw.choice(TEXTS)
            rows.append((conv, None if draw.random() < 0.1 else turn, role, text if text is None or draw.random() < 0.5 else f"{text} {draw.random()}."))
            turn += draw.choice([0, 1, 1, 1, 1, 3])
    rows += rows[:7]
    table = spark.createDataFrame([(*row, "x", 1) for row in rows], "conv_id long, turn long, role string, text string, audit string, cost int")
    got = sorted((tuple(r) for r in rp.report(table).collect()), key=repr)
    assert got == expected_report(rows)


def test_long_conversation(spark, monkeypatch):
    """One conversation over many chunks, with a text that returns all the time and equal rows."""
    monkeypatch.setattr(rp, "CHUNK", 16)
    rows = [(5, k // 2, ("user", "assistant")[k % 3 % 2], "ok." if k % 4 else f"number {k}.") for k in range(300)] + [(5, 7, "user", "same.")] * 40
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    row = rp.repaired(table).first()
    codes = []
    seen = set()
    for turn, role, text in sorted(r[1:] for r in rows):
        codes.append((role[0], 0, (role, text) in seen))
        seen.add((role, text))
    audit, _ = rp.trace(bytes(code(c) for c in codes), rp.FINAL, 1, True)
    assert row["audit"] == audit
    assert len(audit) - audit.count("I") == 340 and row["duplicate"] == sum(c[2] for c in codes)


def test_empty_table_and_all_dropped(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert rp.report(none).collect() == []
    dropped = next(k for k in range(1000) if zlib.crc32(f"{k}:1".encode()) % 20 == 0)
    rows = spark.createDataFrame([(dropped, 1, "user", "hi.")], none.schema)
    assert [tuple(r) for r in rp.report(rows).collect()] == [(dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
