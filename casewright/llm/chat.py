"""Chat formatting with Spark expressions only (operator 5).

A conversation's turns are collected as structs and sorted; an array
aggregation merges adjacent turns of one role into blocks; the blocks are
written as

    <|im_start|>role NEWLINE text <|im_sep|> text ... <|im_end|> NEWLINE

where ``<|im_sep|>`` parts the turns merged into a block. In roles and texts
``<|`` is written ``<\\|``, ``<\\|`` is written ``<\\\\|`` and so on (one backslash
more), so no marker can come from a text and the way back is exact. In roles
newlines and per cent signs are written ``%0A`` and ``%25``.

``loss_spans`` gives the assistant texts as code point offsets in the output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
LEARNED = "assistant"


def escape(c: Column) -> Column:
    return F.regexp_replace(c, r"<(\\*)\|", r"<\\$1|")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"<\\(\\*)\|", r"<$1|")


def _escape_role(c: Column) -> Column:
    return escape(F.replace(F.replace(c, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def _unescape_role(c: Column) -> Column:
    return F.replace(F.replace(unescape(c), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def _merge(blocks: Column, turn: Column) -> Column:
    """Add a turn to the last block if the role is the same, else open a block."""
    last = F.element_at(blocks, -1)
    new = F.struct(turn["role"].alias("role"), F.array(turn["text"]).alias("texts"))
    longer = F.struct(last["role"].alias("role"), F.array_append(last["texts"], turn["text"]).alias("texts"))
    same = (F.size(blocks) > 0) & (F.try_element_at(blocks, F.lit(-1))["role"] == turn["role"])
    return F.when(same, F.array_append(F.slice(blocks, 1, F.size(blocks) - 1), longer)).otherwise(
        F.array_append(blocks, new)
    )


def format_chats(
    turns: DataFrame,
    *,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """``(id, formatted, loss_spans)``, one row per conversation.

    Turns are sorted by turn, then role, then text (nulls first), so ties and
    repeated rows have one order. Null texts and roles are empty. Rows with a
    null id form one conversation. Other columns are not read.
    """
    rows = turns.select(
        F.col(id_col).alias("id"),
        F.struct(
            F.col(turn_col).cast("bigint").alias("turn"),
            F.coalesce(F.col(role_col), F.lit("")).alias("role"),
            F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        ).alias("t"),
    )
    sorted_ = rows.groupBy("id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    escaped = sorted_.select(
        "id",
        F.transform(
            "turns", lambda t: F.struct(_escape_role(t["role"]).alias("role"), escape(t["text"]).alias("text"))
        ).alias("turns"),
    )
    none = F.array().cast("array<struct<role:string,texts:array<string>>>")
    merged = escaped.select("id", F.aggregate("turns", none, _merge).alias("blocks"))
    head = lambda b: F.concat(F.lit(START), b["role"], F.lit("\n"))
    written = merged.select(
        "id",
        "blocks",
        F.array_join(
            F.transform("blocks", lambda b: F.concat(head(b), F.array_join(b["texts"], SEP), F.lit(END))), ""
        ).alias("formatted"),
    )
    # Offsets: a running end over the blocks, then over the texts of learned ones.
    sized = F.transform(
        "blocks",
        lambda b: F.struct(
            b["role"].alias("role"),
            F.length(head(b)).alias("head"),
            F.transform(b["texts"], lambda x: F.length(x)).alias("sizes"),
        ),
    )
    spans_type = "array<struct<start:int,length:int>>"
    state = F.struct(F.lit(0).alias("at"), F.array().cast(spans_type).alias("spans"))

    def block(acc, b):
        inner = F.struct((acc["at"] + b["head"]).alias("at"), acc["spans"].alias("spans"))

        def text(a, n):
            span = F.struct((a["at"] + 1).alias("start"), n.alias("length"))
            spans = F.when(b["role"] == LEARNED, F.array_append(a["spans"], span)).otherwise(a["spans"])
            return F.struct((a["at"] + n + F.lit(len(SEP))).alias("at"), spans.alias("spans"))

        done = F.aggregate(b["sizes"], inner, text)
        return F.struct((done["at"] - len(SEP) + len(END)).alias("at"), done["spans"].alias("spans"))

    return written.select(
        F.col("id").alias(id_col), "formatted", F.aggregate(sized, state, block)["spans"].alias("loss_spans")
    )


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation: ``array<struct<role, text>>``."""
    blocks = F.slice(F.split(formatted, r"<\|im_end\|>\n", -1), 1, F.size(F.split(formatted, r"<\|im_end\|>\n", -1)) - 1)

    def turns(b):
        body = F.substring(b, F.lit(len(START) + 1), F.length(b))
        cut = F.instr(body, "\n")
        role = _unescape_role(F.substring(body, F.lit(1), cut - 1))
        texts = F.split(F.substring(body, cut + 1, F.length(body)), r"<\|im_sep\|>", -1)
        return F.transform(texts, lambda x: F.struct(role.alias("role"), unescape(x).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(
        F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"], s["length"]))), ""
    )
