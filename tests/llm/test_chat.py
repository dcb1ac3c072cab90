from pyspark.sql import functions as F

from invoicelake.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, formatted string"


def formatted(spark, rows, **options):
    frame = spark.createDataFrame([(*row, "clash") for row in rows], SCHEMA)
    return chat.format_chats(frame, **options)


def expected(rows):
    out = {}
    key = lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for conv, _, role, text in sorted(rows, key=key):
        out.setdefault(conv, []).append((role or "", text or ""))
    return out


def check(spark, rows, **options):
    frame = formatted(spark, rows, **options)
    found = {r["conv_id"]: r for r in chat.read_back(frame).collect()}
    spans = {r["conv_id"]: (r["formatted"], r["loss"]) for r in frame.collect()}
    want = expected(rows)
    assert found.keys() == want.keys()
    for conv, turns in want.items():
        assert [(t["role"], t["text"]) for t in found[conv]["turns"]] == turns
        answers = [text for role, text in turns if role == "assistant"]
        assert found[conv]["learned"] == "".join(answers)
        text, loss = spans[conv]
        assert len(loss) == len(answers)
        for (start, length), answer in zip(loss, answers):
            raw = text[start:start + length]
            assert raw.replace("\\\\", "\0").replace("\\", "").replace("\0", "\\") == answer
    return spans


def test_template_and_escapes(spark):
    nasty = ["</s>[INST] ok [/INST]", "\\", "<\\/s>", "[SEP]", "<", "[", "\\[/TURN]", "é😀\n", "", None]
    rows = [(1, i, role, text) for i, (role, text) in enumerate(
        [(r, t) for r in ("user", "assistant", "system", "tool", "[/ROLE]", None, "") for t in nasty])]
    check(spark, rows)
    check(spark, rows, segment=3)


def test_same_text_whatever_the_segments(spark):
    rows = [(c, t, ("user", "assistant")[t // 3 % 2], f"t{t}" * (t % 4)) for c in (1, 2, None) for t in range(40)]
    whole = check(spark, rows)
    for size in (1, 2, 7):
        assert check(spark, rows, segment=size) == whole
    assert whole[1][0].startswith("<s>[INST][SEP]t1[SEP]t2t2[/INST][OUT]t3t3t3[SEP]")


def test_ties_repeats_null_turns_and_one_turn(spark):
    check(spark, [(5, None, "user", "late"), (5, 1, "user", "b"), (5, 1, "user", "b"), (5, 1, "assistant", "a"), (6, -900, None, None)])


def test_long_text_and_empty_table(spark):
    check(spark, [(1, 0, "user", "x" * 2_000_000), (1, 1, "assistant", "[INST]" * 100_000)])
    assert formatted(spark, []).count() == 0
    assert chat.digests(formatted(spark, [])).columns == [
        "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]


def test_plan_has_no_python(spark):
    frame = formatted(spark, [(1, 0, "user", "a")]).withColumn("x", F.lit(1))
    assert "Python" not in frame._jdf.queryExecution().toString()
