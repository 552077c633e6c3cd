"""Chat formatting with Spark expressions only.

A conversation becomes one string::

    <s>[INST user]text[SEP]text[/INST][INST assistant]text[/INST]</s>

Turn structs are collected and sorted; adjacent turns of one role are merged by array
functions into one ``[INST role]`` block whose texts are separated by ``[SEP]``.  Inside
roles and texts a backslash, ``[``, ``]`` and ``<`` are written as a backslash and a
letter, so no control string can occur there and the original turns can be read back.
The loss mask lists the character ranges of every text of the trained role.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

LOSS_ROLE = "assistant"


def escape(c: Column) -> Column:
    for char, code in (("\\", "\\\\"), ("[", "\\b"), ("]", "\\c"), ("<", "\\a")):
        c = F.replace(c, F.lit(char), F.lit(code))
    return c


def unescape(c: Column) -> Column:
    """Inverse of ``escape``: text between double backslashes holds the other codes only."""
    def plain(part: Column) -> Column:
        for char, code in (("[", "\\b"), ("]", "\\c"), ("<", "\\a")):
            part = F.replace(part, F.lit(code), F.lit(char))
        return part
    return F.array_join(F.transform(F.split(c, r"\\\\"), plain), "\\")


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text", loss_role: str = LOSS_ROLE) -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted``, ``loss_spans`` (1-based start and
    length in characters of each masked text, escaped form), ``n_blocks`` (merged turns).

    Turns are ordered by (turn, role, text); a null turn number comes first.  Null role or
    text counts as empty; a row given twice is two turns; rows with a null conversation id
    form one conversation; an empty table gives an empty table; other columns are not read.
    One conversation is one value, so it is collected in one task like any string of its size.
    """
    t = turns.select(F.col(conv_col).alias("conv_id"), F.struct(
        F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).alias("t"))
    t = t.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    # first turn of every run of one role
    t = t.withColumn("heads", F.expr(
        "filter(sequence(0, size(turns) - 1), i -> i = 0 OR turns[i].role <> get(turns, i - 1).role)"))
    t = t.withColumn("blocks", F.expr(
        """transform(heads, (h, k) -> named_struct('role', turns[h].role, 'texts',
             transform(slice(turns, h + 1, coalesce(get(heads, k + 1), size(turns)) - h), x -> x.text)))"""))
    pieces = F.flatten(F.transform("blocks", lambda b: F.transform(b["texts"], lambda x, j: F.struct(
        F.when(j == 0, F.concat(F.lit("[INST "), escape(b["role"]), F.lit("]"))).otherwise("[SEP]").alias("before"),
        escape(x).alias("text"),
        F.when(j == F.size(b["texts"]) - 1, "[/INST]").otherwise("").alias("after"),
        (b["role"] == loss_role).alias("loss")))))
    t = t.select("conv_id", F.size("blocks").alias("n_blocks"), pieces.alias("pieces"))
    return t.select(
        "conv_id",
        F.concat(F.lit("<s>"), F.array_join(F.transform("pieces", lambda p: F.concat(p["before"], p["text"], p["after"])),
                                            ""), F.lit("</s>")).alias("formatted"),
        F.expr("""aggregate(pieces,
                    named_struct('at', 4, 'spans', cast(array() AS array<struct<start: int, length: int>>)),
                    (acc, p) -> named_struct(
                      'at', acc.at + length(p.before) + length(p.text) + length(p.after),
                      'spans', CASE WHEN p.loss THEN concat(acc.spans, array(named_struct(
                                 'start', acc.at + length(p.before), 'length', length(p.text)))) ELSE acc.spans END),
                    acc -> acc.spans)""").alias("loss_spans"),
        "n_blocks")


def read_turns(formatted: Column) -> Column:
    """The original turns, array of (role, text), read back from a formatted conversation."""
    body = F.substring(formatted, F.lit(4), F.length(formatted) - 7)
    blocks = F.filter(F.split(body, r"\[/INST\]"), lambda b: b != "")
    return F.flatten(F.transform(blocks, lambda b: F.transform(
        F.split(F.substring(b, F.instr(b, F.lit("]")) + 1, F.length(b)), r"\[SEP\]"),
        lambda x: F.struct(unescape(F.substring(F.substring_index(b, "]", 1), F.lit(7), F.length(b))).alias("role"),
                           unescape(x).alias("text")))))


def masked_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"], s["length"]))), "")
