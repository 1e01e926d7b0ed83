"""Chat formatting that is read back: rendered conversations, their parser, and the loss mask.

DataFrame functions only. A turn is rendered as

    <|im_start|>ROLE\\nTEXT<|im_end|>\\n

Where a role or text holds a control string, or what looks like an escaped
one, a backslash is put after its first two characters; one such backslash
is taken away on reading. In a role, line feeds are written as \\n and
backslashes doubled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: the template's control strings -------------------------
START, END = "<|im_start|>", "<|im_end|>"
# --------------------------------------------------------------------------

_CONTROL = "<\\|(\\\\*)(im_start|im_end)\\|>"
_ESCAPED = "<\\|\\\\(\\\\*)(im_start|im_end)\\|>"


def escape(text: Column) -> Column:
    """One more backslash in every control string, escaped or not: never the same as a control string."""
    return F.regexp_replace(text, _CONTROL, "<|\\\\$1$2|>")


def unescape(text: Column) -> Column:
    """One backslash less in every escaped control string."""
    return F.regexp_replace(text, _ESCAPED, "<|$1$2|>")


def _escape_role(role: Column) -> Column:
    lines = F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))
    return F.replace(lines, F.lit("<|"), F.lit("<\\p"))


def _unescape_role(role: Column) -> Column:
    """Pairs are read from the left: a doubled backslash first hides itself."""
    parts = F.split(role, "\\\\\\\\", -1)  # at doubled backslashes
    plain = F.transform(
        parts, lambda part: F.replace(F.replace(part, F.lit("<\\p"), F.lit("<|")), F.lit("\\n"), F.lit("\n"))
    )
    return F.array_join(plain, "\\")


def _rendered(turns: Column, escaped: bool) -> Column:
    def one(turn: Column) -> Column:
        role, text = turn["role"], turn["text"]
        if escaped:
            role, text = _escape_role(role), escape(text)
        return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(END + "\n"))

    return F.array_join(F.transform(turns, one), "")


def parse(formatted: Column | str) -> Column:
    """The turns (role, text) of a formatted conversation.

    A deterministic reading from the left: each start marker opens a turn, the
    first line feed ends its role, the first end marker its text. Only what
    `render` writes is sure to be read back as it was.
    """
    formatted = F.col(formatted) if isinstance(formatted, str) else formatted
    pieces = F.split(formatted, "\\Q" + START + "\\E", -1)

    def one(piece: Column) -> Column:
        role = F.substring_index(piece, "\n", 1)
        rest = F.substr(piece, F.length(role) + 2)
        text = F.substring_index(rest, END, 1)
        return F.struct(_unescape_role(role).alias("role"), unescape(text).alias("text"))

    return F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), one)


def render(conversations: DataFrame) -> DataFrame:
    """Add `formatted` and `escaped` to conversations (conv_id, turns: array of role and text).

    The plain form is read back and compared with the source; a conversation
    that isn't the same, as its content conflicts with the template, is
    rendered again with escapes, which always are read back.
    """
    plain = conversations.withColumn("_plain", _rendered(F.col("turns"), False))
    same = parse("_plain") == F.col("turns")
    # as the output of a generator the comparison is made once
    chosen = plain.select("*", F.explode(F.array(~same)).alias("escaped"))
    formatted = F.when(F.col("escaped"), _rendered(F.col("turns"), True)).otherwise(F.col("_plain"))
    return chosen.withColumn("formatted", formatted).drop("_plain")


def loss_spans(formatted: Column) -> Column:
    """Where the assistant's texts lie in the formatted conversation: (first character from 0, characters)."""
    pieces = F.split(formatted, "\\Q" + START + "\\E", -1)

    def add(state: Column, piece: Column) -> Column:
        role = F.substring_index(piece, "\n", 1)
        text = F.substring_index(F.substr(piece, F.length(role) + 2), END, 1)
        first = state["at"] + len(START) + F.length(role) + 1
        span = F.struct(first.alias("first"), F.length(text).alias("chars"))
        kept = F.when(_unescape_role(role) == "assistant", F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct((state["at"] + len(START) + F.length(piece)).alias("at"), kept.alias("spans"))

    empty = F.array().cast("array<struct<first:int,chars:int>>")
    begin = F.struct(F.lit(0).alias("at"), empty.alias("spans"))
    return F.aggregate(F.slice(pieces, F.lit(2), F.size(pieces)), begin, add, lambda state: state["spans"])


def gather_turns(rows: DataFrame) -> DataFrame:
    """One row per conversation: its turns in order. Null roles and texts count as empty, ties go by role and text."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    in_order = F.array_sort(F.collect_list(turn))
    turns = F.transform(in_order, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return rows.groupBy("conv_id").agg(turns.alias("turns"))


def format_conversations(rows: DataFrame) -> DataFrame:
    """conv_id, turns, formatted, escaped and loss_spans of every conversation of (conv_id, turn, role, text).

    Rows of a conversation go by turn; null turns come first, rows of one turn
    go by role and text, repeated rows are turns of their own. Rows without a
    conv_id form one conversation with a null id. Null texts and roles count
    as empty. An empty table gives no rows; further columns are ignored.
    """
    done = render(gather_turns(rows))
    return done.withColumn("loss_spans", loss_spans(F.col("formatted")))


def round_trip_digests(formatted: DataFrame) -> DataFrame:
    """What is read back from `formatted`: turns, and the text under the loss mask, as counts and digests."""
    read = formatted.select(
        "conv_id", "formatted", "loss_spans", F.explode(F.array(parse("formatted"))).alias("read")
    )
    lines = F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    masked = F.transform(
        "loss_spans", lambda s: unescape(F.substr("formatted", s["first"] + 1, s["chars"]))
    )
    return read.select(
        "conv_id",
        F.size("read").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.explode(F.array(F.array_join(masked, ""))).alias("loss"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    ).select(
        "conv_id",
        "n_turns",
        "turns_sha256",
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
