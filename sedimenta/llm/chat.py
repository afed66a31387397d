"""Chat formatting: turns are marked, control strings inside texts escaped, and the rendered text is parsed again.

A turn is `### <Role>:`, a line break, the text, a line break and `</turn>` with a line break. A backslash
before a control string (`###` or `</turn>`, after any number of backslashes) marks it as part of a text, so
unescaping takes one backslash off. Text that a parser would not read back identically is escaped; rendering is
repeated on it and compared again. Only column functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HEAD, COLON, END = "### ", ":\n", "\n</turn>\n"
_ESCAPED = r"\\(\\*(?:###|</turn>))"
_CONTROL = r"(\\*(?:###|</turn>))"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL, r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1")


def _role_out(role: Column) -> Column:
    """A header is one line, so line breaks of a role are written as %0A and % as %25."""
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def _role_in(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def _segment(role: Column, text: Column) -> Column:
    return F.concat(F.lit(HEAD), role, F.lit(COLON), text, F.lit(END))


def parse(rendered: Column) -> Column:
    """The turns `array<struct<role, text>>` of a rendered text; a part without a header has a NULL role."""
    pieces = F.split(rendered, r"\n</turn>\n", -1)
    pieces = F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0)))

    def turn(piece: Column) -> Column:
        cut = F.instr(piece, COLON)
        headed = piece.startswith(HEAD) & (cut > 0)
        role = F.when(headed, F.substring(piece, F.lit(len(HEAD) + 1), cut - len(HEAD) - 1))
        text = F.when(headed, F.substring(piece, cut + len(COLON), F.length(piece))).otherwise(piece)
        return F.struct(_role_in(role).alias("role"), unescape(text).alias("text"))

    return F.transform(pieces, turn)


def render_turns(turns: DataFrame, role: str = "role", text: str = "text") -> DataFrame:
    """Adds `_role`, `_text`, `rendered`, `escaped` and `faithful` to every turn.

    The plain rendering is parsed again; where that gives other than the one source turn, or a control string
    of the content would stand bare, the content is escaped and rendered anew, and the result is compared once
    more. `faithful` is that outcome. It holds for every text: escaping leaves no control string without a
    backslash, and unescaping takes off exactly the one put on. NULL role or text reads as empty.
    """
    tidy = turns.withColumns({"_role": F.coalesce(F.col(role), F.lit("")), "_text": F.coalesce(F.col(text), F.lit(""))})
    source = F.array(F.struct(F.col("_role").alias("role"), F.col("_text").alias("text")))
    bare = F.col("_role").rlike(_CONTROL) | F.col("_text").rlike(_CONTROL)
    plain = _segment(F.col("_role"), F.col("_text"))
    safe = _segment(_role_out(F.col("_role")), escape(F.col("_text")))
    tried = tidy.withColumn("escaped", bare | ~(parse(plain) == source))
    tried = tried.withColumn("rendered", F.when(F.col("escaped"), safe).otherwise(plain))
    return tried.withColumn("faithful", parse(F.col("rendered")) == source)


def format_chats(turns: DataFrame, conversation: str = "conv_id", order: str = "turn", trained: str = "assistant") -> DataFrame:
    """`(conversation, formatted, mask, faithful)`, one row per conversation.

    Turns go by `order` (NULL first), equal ones by role, then text; repeated rows are repeated turns. `mask`
    has the start (0-based, in code points) and length of each trained turn's text in `formatted`, as escaped there.
    An empty table gives no rows; rows of a NULL conversation are one conversation. Further columns are ignored.
    """
    rendered = render_turns(turns.select(conversation, order, "role", "text"))
    by_turn = Window.partitionBy(conversation).orderBy(F.col(order).asc_nulls_first(), "_role", "_text")
    earlier = by_turn.rowsBetween(Window.unboundedPreceding, -1)
    placed = rendered.withColumns(
        {
            "_at": F.row_number().over(by_turn),
            "_start": F.coalesce(F.sum(F.length("rendered")).over(earlier), F.lit(0)),
        }
    )
    head = F.instr("rendered", COLON) + len(COLON) - 1
    span = F.struct((F.col("_start") + head).alias("start"), (F.length("rendered") - head - len(END)).cast("long").alias("length"))
    return (
        placed.groupBy(conversation)
        .agg(
            F.array_sort(F.collect_list(F.struct("_at", "rendered"))).alias("_parts"),
            F.array_sort(F.collect_list(F.when(F.col("_role") == trained, span))).alias("mask"),
            F.bool_and("faithful").alias("faithful"),
        )
        .select(
            conversation,
            F.array_join(F.transform("_parts", lambda p: p["rendered"]), "").alias("formatted"),
            "mask",
            "faithful",
        )
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Adds `turns`, parsed from `formatted`, and `loss_text`: what stands under the mask there, unescaped, one span after the other."""
    spans = F.transform("mask", lambda m: unescape(F.substring(F.col("formatted"), (m["start"] + 1).cast("int"), m["length"].cast("int"))))
    return formatted.withColumn("turns", parse(F.col("formatted"))).withColumn("loss_text", F.array_join(spans, ""))


def digests(formatted: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """Counts and hashes of what is read back from the formatted conversations."""
    back = read_back(formatted)
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        conversation,
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "faithful",
    )
