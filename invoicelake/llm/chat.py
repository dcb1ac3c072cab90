"""Chat formatting with Spark expressions only, and reading the result back.

Template: ``<s>``, then for every run of turns of one role an opening mark, the texts joined by ``[SEP]``, a closing mark.

=========  =====================  =========
role       opens with             closes with
=========  =====================  =========
system     ``[SYS]``              ``[/SYS]``
user       ``[INST]``             ``[/INST]``
assistant  ``[OUT]``              ``</s>``
any other  ``[ROLE]name[/ROLE]``  ``[/TURN]``
=========  =====================  =========

Control strings inside texts and names are escaped: a backslash is doubled, and one is put behind the first character of
a control string. No escaped text contains a control string, and no control string has ``<`` or ``[`` behind its first
character, so splitting at control strings finds the real ones only.

Turns are ordered by (turn, role, text), NULL first; a repeated row is a turn like any other. NULL role and text are empty. A
conversation is sorted and formatted in segments of ``SEGMENT`` turn numbers, which may lie on different machines; only the
finished segments of a conversation meet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEGMENT = 256
MARKS = {"system": ("[SYS]", "[/SYS]"), "user": ("[INST]", "[/INST]"), "assistant": ("[OUT]", "</s>")}
_CONTROL = r"(<)(/?s>)|(\[)(/?(?:SYS|INST|OUT|SEP|ROLE|TURN)\])"
_BLOCK = (r"(?s)\[SYS\].*?\[/SYS\]|\[INST\].*?\[/INST\]|\[OUT\].*?</s>|\[ROLE\].*?\[/ROLE\].*?\[/TURN\]")


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, _CONTROL, r"$1$3\\$2$4")


def unescape(text: Column) -> Column:
    """The inverse of ``escape``: a backslash goes, what follows it stays."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _opening(role: Column) -> Column:
    out = F.concat(F.lit("[ROLE]"), escape(role), F.lit("[/ROLE]"))
    for name, (mark, _) in MARKS.items():
        out = F.when(role == name, mark).otherwise(out)
    return out


def _closing(role: Column) -> Column:
    out = F.lit("[/TURN]")
    for name, (_, mark) in MARKS.items():
        out = F.when(role == name, mark).otherwise(out)
    return out


def _segments(turns: DataFrame, size: int) -> DataFrame:
    """Per conversation and range of turn numbers: its runs of one role as (role, inside, loss), inside being the joined
    escaped texts and loss the places (start, length) of the assistant's texts in it."""
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
                        F.coalesce("text", F.lit("")).alias("text"))
    grouped = (rows.withColumn("part", F.floor(F.col("turn") / size))
               .groupBy("conv_id", "part").agg(F.array_sort(F.collect_list(F.struct(
                   F.col("turn").isNotNull().alias("has"), "turn", "role", "text"))).alias("turns")))
    flat = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), escape(t["text"]).alias("inside")))
    none = F.array().cast("array<struct<role:string,texts:array<string>>>")
    merged = F.aggregate(flat, none, lambda runs, t: F.when(
        F.get(runs, F.size(runs) - 1)["role"] == t["role"],
        F.concat(F.slice(runs, 1, F.size(runs) - 1),
                 F.array(F.struct(t["role"].alias("role"), F.concat(F.get(runs, F.size(runs) - 1)["texts"], F.array(t["inside"])).alias("texts")))))
        .otherwise(F.concat(runs, F.array(F.struct(t["role"].alias("role"), F.array(t["inside"]).alias("texts"))))))
    return grouped.select("conv_id", "part", F.size("turns").alias("n_turns"), merged.alias("runs"))


def _offsets(parts: Column, length) -> Column:
    """Start of every part when the parts stand one behind the other."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<bigint>").alias("starts"))
    return F.aggregate(parts, start, lambda acc, p: F.struct((acc["at"] + length(p)).alias("at"),
                                                             F.concat(acc["starts"], F.array(acc["at"])).alias("starts")))["starts"]


def format_chats(turns: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """``conv_id, formatted, loss`` per conversation; loss holds (start, length) in code points, one per assistant text.

    The columns conv_id, turn, role and text are read, others are ignored. A NULL conv_id is a conversation like any other.
    """
    rows = _segments(turns, segment)
    first, last = F.element_at("runs", 1)["role"], F.element_at("runs", -1)["role"]
    bodies = F.transform("runs", lambda r: F.struct(
        r["role"].alias("role"), F.array_join(r["texts"], "[SEP]").alias("inside"),
        F.transform(r["texts"], lambda t: F.char_length(t).cast("long")).alias("lengths")))
    rows = rows.select("conv_id", "part", first.alias("first"), last.alias("last"), bodies.alias("bodies"))
    # the first opening and the last closing mark depend on the neighbours and are put between the segments
    pieces = F.transform("bodies", lambda b, i: F.struct(
        F.when(i > 0, _opening(b["role"])).otherwise("").alias("opening"), b["inside"].alias("inside"),
        F.when(i < F.size("bodies") - 1, _closing(b["role"])).otherwise("").alias("closing"),
        F.when(b["role"] == "assistant", b["lengths"]).otherwise(F.array().cast("array<bigint>")).alias("lengths")))
    rows = rows.withColumn("pieces", pieces)

    def width(p: Column) -> Column:
        return (F.char_length(p["opening"]) + F.char_length(p["inside"]) + F.char_length(p["closing"])).cast("long")
    rows = rows.withColumn("starts", _offsets(F.col("pieces"), width))
    # arrays used inside a function are referenced a second time, so that Spark computes them once per row
    loss = F.when(F.size("starts") > 0, F.flatten(F.transform("pieces", lambda p, i: F.zip_with(
        p["lengths"], _offsets(p["lengths"], lambda n: n + len("[SEP]")),
        lambda n, at: F.struct((F.get("starts", i) + F.char_length(p["opening"]) + at).alias("start"), n.alias("length"))))))
    rows = rows.select("conv_id", "part", "first", "last", loss.alias("loss"), F.array_join(F.transform(
        "pieces", lambda p: F.concat(p["opening"], p["inside"], p["closing"])), "").alias("body"))
    joined = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(
        F.col("part").isNotNull().alias("has"), "part", "first", "last", "body", "loss"))).alias("segments"))
    glue = F.transform("segments", lambda s, i: F.when(i == 0, F.concat(F.lit("<s>"), _opening(s["first"]))).otherwise(F.when(
        F.get("segments", i - 1)["last"] == s["first"], "[SEP]").otherwise(F.concat(
            _closing(F.get("segments", i - 1)["last"]), _opening(s["first"])))))
    joined = joined.select("conv_id", "segments", glue.alias("glue"), _closing(F.element_at("segments", -1)["last"]).alias("end"))
    parts = F.zip_with("segments", "glue", lambda s, g: F.struct(g.alias("glue"), s["body"].alias("body"), s["loss"].alias("loss")))
    joined = joined.select("conv_id", "end", parts.alias("parts"))
    joined = joined.withColumn("starts", _offsets(F.col("parts"), lambda p: (F.char_length(p["glue"]) + F.char_length(p["body"])).cast("long")))
    spans = F.when(F.size("starts") > 0, F.flatten(F.transform("parts", lambda p, i: F.transform(p["loss"], lambda x: F.struct(
        (F.get("starts", i) + F.char_length(p["glue"]) + x["start"]).alias("start"), x["length"].alias("length"))))))
    text = F.concat(F.array_join(F.transform("parts", lambda p: F.concat(p["glue"], p["body"])), ""), F.col("end"))
    return joined.select("conv_id", text.alias("formatted"), spans.alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """``conv_id, turns, learned``: the (role, text) turns found in ``formatted`` and the unescaped texts under ``loss``."""
    def split(inside: Column, role: Column) -> Column:
        return F.transform(F.split(inside, r"\[SEP\]", -1), lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    def turns(block: Column) -> Column:
        out = split(F.regexp_extract(block, r"(?s)^\[ROLE\](.*?)\[/ROLE\](.*)\[/TURN\]$", 2),
                    unescape(F.regexp_extract(block, r"(?s)^\[ROLE\](.*?)\[/ROLE\]", 1)))
        for role, (opening, closing) in MARKS.items():
            inside = F.substr(block, F.lit(len(opening) + 1), F.char_length(block) - len(opening) - len(closing))
            out = F.when(F.startswith(block, F.lit(opening)), split(inside, F.lit(role))).otherwise(out)
        return out
    blocks = F.regexp_extract_all(F.substr("formatted", F.lit(len("<s>") + 1)), F.lit(_BLOCK), F.lit(0))
    learned = F.transform("loss", lambda x: unescape(F.substr(F.col("formatted"), (x["start"] + 1).cast("int"), x["length"].cast("int"))))
    return formatted.select("conv_id", "formatted", F.flatten(F.transform(blocks, turns)).alias("turns"),
                            F.array_join(learned, "").alias("learned"))


def digests(formatted: DataFrame) -> DataFrame:
    """Counts and checksums of what is read back, one row per conversation."""
    rows = read_back(formatted)
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return rows.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
                       F.char_length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
                       F.char_length("formatted").cast("long").alias("formatted_chars"))
