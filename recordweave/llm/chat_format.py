"""Chat formatting with typed content parts, in DataFrame operations only.

A turn's content is a list of parts: text, image, audio or document.  A visitor has one rule for each
type.  It walks the parts in order and writes text as it is, and for every other
part a placeholder with a running number.  Beside the formatted conversation it leaves the attachments in the
order of their placeholders, each with its reference and the number of tokens it will expand to.

A turn is written as ``<turn role>text</turn>``.  Texts, roles and references can hold any of these
marks, so ``\\`` and ``<`` are escaped inside them as ``\\b`` and ``\\l``: no ``<`` of a text is left, every mark that is
found was written by the template, and undoing the two in reverse order restores the text.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN_OPEN, TURN_HEAD_END, TURN_CLOSE = "<turn ", "<|>", "</turn>"
LOSS_ROLE = "assistant"
#: A part as it comes in: its type, a text (of text parts), a reference, and its extent (see ``TOKENS``).
PART_TYPE = "struct<type:string,text:string,ref:string,extent:double>"
#: Tokens that one unit of a part's extent expands to: pixels of an image, seconds of audio, pages of a document; and the least.
TOKENS = {"image": (1 / 784, 1), "audio": (25.0, 1), "document": (512.0, 1)}


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    """Undo ``escape``: after it every backslash begins one of the two codes, so the order is safe."""
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


Rule = Callable[[Column, Column], tuple[Column, Column, Column]]


def text_rule(part: Column, number: Column) -> tuple[Column, Column, Column]:
    """Text stands for itself, is no attachment, and expands to nothing beyond its own tokens."""
    return escape(F.coalesce(part["text"], F.lit(""))), F.lit(False), F.lit(0).cast("bigint")


def attachment_rule(kind: str) -> Rule:
    """A numbered placeholder; the tokens follow from the extent, a missing one counts as zero."""
    each, least = TOKENS[kind]

    def rule(part: Column, number: Column) -> tuple[Column, Column, Column]:
        tokens = F.ceil(F.greatest(F.coalesce(part["extent"], F.lit(0.0)) * each, F.lit(float(least)))).cast("bigint")
        return F.concat(F.lit(f"<{kind} "), number.cast("string"), F.lit(">")), F.lit(True), tokens

    return rule


#: The visitor's rules.
RULES: Mapping[str, Rule] = {"text": text_rule} | {kind: attachment_rule(kind) for kind in TOKENS}


def _visited(part: Column, number: Column, rules: Mapping[str, Rule]) -> Column:
    """What the rule of a part's type makes of it.  An unknown or missing type is treated as text."""

    def struct(rule: Rule) -> Column:
        shown, attached, tokens = rule(part, number)
        return F.struct(shown.alias("shown"), attached.alias("attached"), tokens.alias("tokens"))

    chosen = struct(rules["text"])
    for kind, rule in rules.items():
        if kind != "text":
            chosen = F.when(part["type"] == kind, struct(rule)).otherwise(chosen)
    return chosen


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), use)[0]


def _attached(part: Column, rules: Mapping[str, Rule]) -> Column:
    return F.coalesce(part["type"].isin([k for k in rules if k != "text"]), F.lit(False))


def flatten(parts: Column, before: Column, rules: Mapping[str, Rule] = RULES) -> Column:
    """The parts of one turn in order: an array of structs shown, attached, type, ref and tokens.

    Attachments are numbered from ``before``, the number of attachments of the turns before.
    """
    spots = F.filter(F.transform(parts, lambda p, i: F.when(_attached(p, rules), i)), lambda i: i.isNotNull())

    def visit(spots: Column) -> Column:
        def one(p: Column, i: Column) -> Column:
            seen = _visited(p, before + F.coalesce(F.array_position(spots, i), F.lit(0)) - 1, rules)
            return F.struct(
                seen["shown"].alias("shown"), seen["attached"].alias("attached"), p["type"].alias("type"),
                p["ref"].alias("ref"), seen["tokens"].alias("tokens"),
            )

        return F.transform(parts, one)

    return _with(spots, visit)


def format_conversations(
    turns: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    parts_col: str = "parts",
    loss_role: str = LOSS_ROLE,
    rules: Mapping[str, Rule] = RULES,
) -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted``, ``loss_mask``, ``attachments``, ``attachment_tokens``.

    ``turns`` has a row per turn; ``parts_col`` is an array of ``PART_TYPE``.  Turns are in the order of their number, nulls
    first; turns of one number in the order of role and content.  Repeated rows are turns each.  A null role is empty;
    null or empty parts give an empty text.  Rows with a null id are one conversation.  ``loss_mask`` lists the stretches of
    ``formatted`` (start from 0 and end, in code points) that hold what ``loss_role`` says, one for each such
    turn and without its marks.  ``attachments`` lists type, reference, turn, the place of the placeholder in ``formatted`` and tokens.
    A conversation becomes one string and must fit into one.  An empty table gives no rows; other columns are not read.
    """
    none = F.array().cast(f"array<{PART_TYPE}>")
    said = turns.select(
        F.col(f"`{id_col}`").alias("conv_id"),
        F.col(f"`{turn_col}`").alias("turn"),
        F.coalesce(F.col(f"`{role_col}`"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{parts_col}`"), none).alias("parts"),
    )
    # one shuffle: both running sums and the grouping need a conversation's turns together
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "parts")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    own = F.size(F.filter("parts", lambda p: _attached(p, rules))).cast("bigint")
    counted = said.select("*", F.row_number().over(order).alias("place"), F.coalesce(F.sum(own).over(earlier), zero).alias("before"))
    visited = counted.select(
        *counted.columns, F.concat(F.lit(TURN_OPEN), escape(F.col("role")), F.lit(TURN_HEAD_END)).alias("head"),
        flatten(F.col("parts"), F.col("before"), rules).alias("visited"),
    )
    written = visited.withColumn("body", F.array_join(F.transform("visited", lambda v: v["shown"]), ""))
    width = (F.length("head") + F.length("body") + len(TURN_CLOSE)).cast("bigint")
    start = F.coalesce(F.sum(width).over(earlier), zero) + F.length("head")
    laid = written.withColumn("start", start)
    attached = F.transform(
        F.filter("visited", lambda v: v["attached"]),
        lambda v: F.struct(
            v["type"].alias("type"), v["ref"].alias("ref"), F.col("turn").alias("turn"), v["shown"].alias("placeholder"),
            (F.col("start") + F.position(v["shown"], F.col("body")) - 1).alias("start"), v["tokens"].alias("tokens"),
        ),
    )
    entry = F.struct(
        "place", F.concat("head", "body", F.lit(TURN_CLOSE)).alias("written"), "role", "start",
        (F.col("start") + F.length("body")).alias("end"), attached.alias("attachments"),
    )
    gathered = laid.select("conv_id", entry.alias("entry")).groupBy("conv_id").agg(F.sort_array(F.collect_list("entry")).alias("turns"))
    mask = F.transform(
        F.filter("turns", lambda t: t["role"] == loss_role), lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"))
    )
    return gathered.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: t["written"]), "").alias("formatted"),
        mask.alias("loss_mask"),
        F.flatten(F.transform("turns", lambda t: t["attachments"])).alias("attachments"),
    ).withColumn("attachment_tokens", F.aggregate("attachments", zero, lambda done, a: done + a["tokens"]))


def text_parts(turns: DataFrame, text_col: str = "text", as_col: str = "parts") -> DataFrame:
    """``turns`` with its text as the only part of a turn; null is an empty text."""
    part = F.struct(
        F.lit("text").alias("type"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
        F.lit(None).cast("string").alias("ref"), F.lit(None).cast("double").alias("extent"),
    )
    return turns.withColumn(as_col, F.array(part.cast(PART_TYPE)))


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation: an array of structs role and text, unescaped, with placeholders as written."""
    pieces = F.split(formatted, TURN_CLOSE.replace("|", r"\|"), -1)
    turns = F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0)))
    parted = F.transform(turns, lambda t: F.split(t, r"<\|>", 2))
    return F.transform(
        parted, lambda p: F.struct(unescape(F.substring(p[0], len(TURN_OPEN) + 1, 1 << 30)).alias("role"), unescape(p[1]).alias("text"))
    )


def masked_texts(formatted: Column, mask: Column) -> Column:
    """The text under the loss mask, one entry for each stretch, unescaped."""
    return F.transform(
        mask, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))
    )


def read_back(conversations: DataFrame) -> DataFrame:
    """What the formatted output says: turns and their digest, text under the mask with its length and digest, and length."""
    turns = parse(F.col("formatted"))
    read = conversations.select(
        "conv_id", "formatted", turns.alias("turns"), F.array_join(masked_texts(F.col("formatted"), F.col("loss_mask")), "").alias("loss")
    )
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )
