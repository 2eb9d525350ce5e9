from __future__ import annotations

import random

from pyspark.sql import functions as F

from chainfold.llm.chat import format_chats, read_loss, read_turns


def expected(rows):
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn, role or "", text or ""))
    return {c: sorted(t, key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2])) for c, t in convs.items()}


def test_reads_back_exactly(spark):
    rnd = random.Random(2)
    parts = ["</s>", "[INST]", "[/INST]", "[INST+]", "[ROLE=x]", "~", "~0", "~1", "[", "<", "é\U0001f600", "\n", " ", "ok", "\\", "$1"]
    rows = [
        (c, t, rnd.choice(["user", "assistant", "system", "assistant", "tool]", "", "a+", "~3[x", "user+", None]), rnd.choice([None, "", "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 9)))]))
        for c in range(150)
        for t in range(rnd.randint(1, 9))
    ]
    rows += [(None, 0, "user", "x"), (None, 1, "assistant", "y"), (7, 3, "user", "again"), (7, 3, "user", "again"), (8, None, "user", "no turn")]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    read = format_chats(df).select(
        "conv_id", "formatted", "loss_mask", read_turns(F.col("formatted")).alias("turns"), read_loss(F.col("formatted"), F.col("loss_mask")).alias("loss")
    )
    want = expected(rows)
    got = read.collect()
    assert len(got) == len(want)
    for r in got:
        turns = [(role, text) for _, role, text in want[r["conv_id"]]]
        assert [tuple(t) for t in r["turns"]] == turns
        assert r["loss"] == "".join(text for role, text in turns if role == "assistant")
        assert sum(m["n_chars"] for m in r["loss_mask"]) == len(r["formatted"])


def test_layout_merges_adjacent_turns(spark):
    rows = [(1, 0, "system", "s"), (1, 2, "user", "b"), (1, 1, "user", "a"), (1, 3, "assistant", "c<d"), (1, 4, "tool", "t")]
    got = format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).first()
    assert got["formatted"] == "[SYS]s[/SYS][INST]a[INST+]b[/INST][OUT]c~2d</s>[ROLE=tool]t[/ROLE]"
    assert [m["n_chars"] for m in got["loss_mask"] if m["in_loss"]] == [4]


def test_native_plan_and_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    out = format_chats(df)
    assert out.collect() == []
    assert "Python" not in out._jdf.queryExecution().toString()


def test_long_conversation(spark):
    df = spark.range(2000).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 3 == 0, "user").otherwise("assistant").alias("role"), F.lit("x").alias("text"))
    got = format_chats(df).select(F.size(read_turns(F.col("formatted"))).alias("n"), F.length(read_loss(F.col("formatted"), F.col("loss_mask"))).alias("loss")).first()
    assert tuple(got) == (2000, 1333)
