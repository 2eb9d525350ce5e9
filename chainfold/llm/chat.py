"""Chat formatting as a relational plan, in Spark expressions only.

A conversation's turns are collected as structs and sorted, adjacent turns of
one role become one block by array functions, and blocks are concatenated:

    [SYS]text[/SYS][INST]text[INST+]text[/INST][OUT]text</s>

A role other than system, user and assistant is ``[ROLE=name]...[/ROLE]``.
``[INST+]`` goes on with the same role, so a merged block still holds its
turns. Inside texts and names ``~``, ``[`` and ``<`` are written ``~0``,
``~1`` and ``~2``, in names also ``]`` and ``+`` as ``~3`` and ``~4``: a ``[`` or ``<`` of the output is always the template's,
and reading back gives the exact turns, control strings in texts included.

``loss_mask`` runs over the formatted string as (n_chars, in_loss) segments;
under it lies the text of the assistant turns (escaped, as formatted), each
once, without marks.

Edge cases: null texts and roles are empty; turns are ordered by (turn, role,
text), a null turn first, so repeated rows stay, in a defined order; rows
with a null conversation form one conversation with the id null; no rows, no
output. A conversation is the unit of output and is held by one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Role, its mark, its end.
MARKS = (("system", "SYS", "[/SYS]"), ("user", "INST", "[/INST]"), ("assistant", "OUT", "</s>"))
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("~"), F.lit("~0")), F.lit("["), F.lit("~1")), F.lit("<"), F.lit("~2"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("~2"), F.lit("<")), F.lit("~1"), F.lit("[")), F.lit("~0"), F.lit("~"))


def _mark(role: Column) -> Column:
    name = F.replace(F.replace(escape(role), F.lit("]"), F.lit("~3")), F.lit("+"), F.lit("~4"))
    out = F.concat(F.lit("ROLE="), name)
    for name, mark, _ in MARKS:
        out = F.when(role == name, F.lit(mark)).otherwise(out)
    return out


def _end(role: Column) -> Column:
    out = F.lit("[/ROLE]")
    for name, _, end in MARKS:
        out = F.when(role == name, F.lit(end)).otherwise(out)
    return out


def format_chats(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """conv_id, formatted (string), loss_mask (array of n_chars, in_loss) of every conversation."""
    rows = turns.select(
        F.col(conv_col).alias("conv_id"),
        F.struct(
            F.col(turn_col).alias("turn"),
            F.coalesce(F.col(role_col), F.lit("")).alias("role"),
            F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        ).alias("t"),
    )
    sorted_turns = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    # the first turn of each block, and after the last block the end
    starts = F.filter(
        F.sequence(F.lit(0), F.size("turns") - 1),
        lambda i: (i == 0) | (F.get("turns", i).getField("role") != F.get("turns", i - 1).getField("role")),
    )
    cuts = sorted_turns.withColumn("starts", F.concat(starts, F.array(F.size("turns"))))
    merged = cuts.select(
        "conv_id",
        F.transform(
            F.slice("starts", F.lit(1), F.size("starts") - 1),
            lambda s, k: F.struct(
                F.get("turns", s).getField("role").alias("role"),
                F.transform(F.slice("turns", s + 1, F.get("starts", k + 1) - s), lambda t: escape(t.getField("text"))).alias("texts"),
            ),
        ).alias("blocks"),
    )

    def segments(block: Column) -> Column:
        role, mark = block.getField("role"), _mark(block.getField("role"))
        body = F.flatten(
            F.transform(
                block.getField("texts"),
                lambda text, k: F.array(
                    F.struct(F.concat(F.lit("["), mark, F.when(k > 0, "+").otherwise(""), F.lit("]")).alias("text"), F.lit(False).alias("in_loss")),
                    F.struct(text.alias("text"), (role == LOSS_ROLE).alias("in_loss")),
                ),
            )
        )
        return F.concat(body, F.array(F.struct(_end(role).alias("text"), F.lit(False).alias("in_loss"))))

    parts = merged.select("conv_id", F.flatten(F.transform("blocks", segments)).alias("parts"))
    return parts.select(
        "conv_id",
        F.array_join(F.transform("parts", lambda p: p.getField("text")), "").alias("formatted"),
        F.transform("parts", lambda p: F.struct(F.length(p.getField("text")).alias("n_chars"), p.getField("in_loss").alias("in_loss"))).alias("loss_mask"),
    )


def read_turns(formatted: Column) -> Column:
    """array of (role, text), read back from a formatted string."""
    pieces = F.filter(F.split(formatted, r"(?=[\[<])"), lambda p: ~p.startswith("[/") & ~p.startswith("<") & (p != ""))

    def turn(piece: Column) -> Column:
        mark = F.regexp_extract(piece, r"^\[([^\]]*?)\+?\]", 1)
        name = F.regexp_replace(mark, "^ROLE=", "")
        role = unescape(F.replace(F.replace(name, F.lit("~4"), F.lit("+")), F.lit("~3"), F.lit("]")))
        for name, known, _ in MARKS:
            role = F.when(mark == known, F.lit(name)).otherwise(role)
        return F.struct(role.alias("role"), unescape(F.regexp_replace(piece, r"^\[[^\]]*\]", "")).alias("text"))

    return F.transform(pieces, turn)


def read_loss(formatted: Column, loss_mask: Column) -> Column:
    """The text under the mask, unescaped."""
    begin = F.struct(F.lit(1).alias("at"), F.array().cast("array<string>").alias("texts"))
    found = F.aggregate(
        loss_mask,
        begin,
        lambda s, m: F.struct(
            (s.getField("at") + m.getField("n_chars")).alias("at"),
            F.when(m.getField("in_loss"), F.array_append(s.getField("texts"), F.substring(formatted, s.getField("at"), m.getField("n_chars"))))
            .otherwise(s.getField("texts"))
            .alias("texts"),
        ),
        lambda s: s.getField("texts"),
    )
    return unescape(F.array_join(found, ""))
