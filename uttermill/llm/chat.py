"""Chat formatting: typed content parts, a reversible template, a loss mask and attachments.

Column expressions, one window and one aggregate by conversation; no Python code runs on rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A content part.  ``source`` is the text that an embedded part was cut out of.
PART = T.StructType(
    [
        T.StructField("kind", T.StringType()), T.StructField("text", T.StringType()), T.StructField("ref", T.StringType()),
        T.StructField("source", T.StringType()), T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType()),
        T.StructField("seconds", T.DoubleType()), T.StructField("pages", T.IntegerType()),
    ]
)
_RECORD = "struct<kind string, ref string, source string, tokens bigint>"

BEGIN, END = "<s>", "</s>"
START, MESSAGE, STOP = "<|start|>", "<|message|>", "<|end|>"
# What control strings of chat templates look like behind their first character.
TAIL = r"(?:\|[A-Za-z0-9_]+\|>|/?s>|/?SYS>|/?INST\])"
# File name endings by kind.
ENDINGS = {"image": "png|jpe?g|gif|webp|bmp", "audio": "mp3|wav|flac|ogg|m4a", "document": "pdf|docx|pptx|xlsx"}


def escape(text: Column) -> Column:
    r"""Put a backslash behind the first character of each control string.

    Control strings that already have backslashes there get one more, so that
    :func:`unescape` gives back any text exactly.  None of them holds another's
    first character, so no two overlap.
    """
    return F.regexp_replace(text, r"([<\[])(?=\\*" + TAIL + ")", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(?=\\*" + TAIL + ")", "$1")


def _embed(endings: str) -> str:
    return r"(?i:!\[[^\]]*\]\([^()\s]+\.(?:" + endings + r")\))"


EMBED = _embed("|".join(ENDINGS.values()))


def text_part(text: Column) -> Column:
    """A part of kind ``text``."""
    return _part(kind=F.lit("text"), text=text)


def _part(**fields: Column) -> Column:
    return F.struct(*[fields.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in PART.fields])


def typed_parts(text: Column | str) -> Column:
    """Parts of a plain text: ``![…](file)`` embeds of known endings are cut out, the rest is text.

    A null text has no part.  The texts and sources of the parts, in order, are the text.
    """
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))

    def embedded(source: Column) -> Column:
        kind = F.lit(None).cast("string")
        for name, endings in ENDINGS.items():
            kind = F.when(F.regexp_like(source, F.lit(_embed(endings))), F.lit(name)).otherwise(kind)
        ref = F.regexp_extract(source, r"\(([^()\s]+)\)$", 1)
        return F.when(source.isNotNull(), _part(kind=kind, ref=ref, source=source))

    between = F.split(text, EMBED, -1)
    cut = F.regexp_extract_all(text, F.lit(f"({EMBED})"), 1)
    mixed = F.flatten(F.zip_with(between, cut, lambda t, s: F.array(text_part(t), embedded(s))))
    several = F.filter(F.array_compact(mixed), lambda p: (p["kind"] != "text") | (p["text"] != ""))
    return F.when(text.contains("!["), several).when(text != "", F.array(text_part(text))).otherwise(F.array().cast(T.ArrayType(PART)))


@dataclass(frozen=True)
class Flatten:
    """Visitor that turns a part into its text in the template and its attachment record.

    A placeholder stands for ``tokens`` positions of the model's input: one for each patch of
    an image, each frame of a recording, each slot of a page.  Missing
    measures count as one patch row, second or page.
    """

    patch: int = 28
    frames_per_second: float = 12.5
    slots_per_page: int = 512

    def image(self, part: Column) -> Column:
        def side(pixels: Column) -> Column:
            return F.greatest(F.ceil(F.coalesce(pixels, F.lit(1)) / self.patch), F.lit(1))

        return side(part["width"]) * side(part["height"])

    def audio(self, part: Column) -> Column:
        return F.greatest(F.ceil(F.coalesce(part["seconds"], F.lit(1.0)) * self.frames_per_second), F.lit(1))

    def document(self, part: Column) -> Column:
        return F.greatest(F.coalesce(part["pages"], F.lit(1)), F.lit(1)) * self.slots_per_page

    def shown(self, part: Column) -> Column:
        """A part in the template: a placeholder, or escaped text for a text or a part of another kind."""
        out = escape(F.coalesce(part["text"], F.lit("")))
        for kind in ENDINGS:
            out = F.when(part["kind"] == kind, F.lit(placeholder(kind))).otherwise(out)
        return out

    def record(self, part: Column) -> Column:
        """The attachment of a part; null for text."""
        tokens = F.lit(None).cast("bigint")
        for kind in ENDINGS:
            tokens = F.when(part["kind"] == kind, getattr(self, kind)(part).cast("bigint")).otherwise(tokens)
        found = F.struct(part["kind"].alias("kind"), part["ref"].alias("ref"), part["source"].alias("source"), tokens.alias("tokens"))
        return F.when(part["kind"].isin(*ENDINGS), found)


def placeholder(kind: str) -> str:
    return f"<|{kind}|>"


def format_conversations(
    messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str | None = "text",
    parts: str | None = None, loss_roles: Sequence[str] = ("assistant",), visitor: Flatten | None = None,
) -> DataFrame:
    """One row per conversation: (conv, formatted, n_turns, loss_spans, attachments, expanded_tokens).

    The content of a message is the column ``parts`` (an array of :data:`PART`), or
    else the :func:`typed_parts` of ``text``.  Messages go by turn (null first), then by role
    and content, so that ties have an order and repeated rows stay.  Null roles,
    texts and parts count as empty.  Rows without a conversation id belong to no
    other row: each is a conversation of its own.  A conversation is one value,
    as every later step needs it whole; its messages are the only rows that meet in a task.
    An empty table gives an empty result; other columns are not read.

    ``loss_spans`` has (turn, start, length, first_byte, bytes) of the content of
    each message of a loss role, in code points and in UTF-8 bytes of ``formatted``, from 0.
    ``attachments`` has, for each turn, what its placeholders stand for, in order.
    """
    see = visitor or Flatten()
    content = F.coalesce(F.col(parts), F.array().cast(T.ArrayType(PART))) if parts else typed_parts(F.col(text))
    rows = messages.select(F.col(conv).alias("_conv"), F.col(turn).alias("_turn"), F.coalesce(F.col(role), F.lit("")).alias("_role"), content.alias("_parts"))
    rows = rows.select(
        "_conv", "_turn", "_role", F.concat_ws("", F.transform("_parts", see.shown)).alias("_body"),
        F.array_compact(F.transform("_parts", see.record)).alias("_files"), F.concat(F.lit(START), escape(F.col("_role")), F.lit(MESSAGE)).alias("_head"),
    )
    rows = rows.withColumn("_piece", F.concat("_head", "_body", F.lit(STOP)))
    order = ["_turn", "_role", "_body", F.to_json("_files")]
    alone = rows.where("_conv IS NULL").select("*", F.lit(1).alias("_seq"), *[F.lit(0).cast("bigint").alias(c) for c in ("_chars", "_bytes")])
    same = W.partitionBy("_conv").orderBy(*order)
    before = same.rowsBetween(W.unboundedPreceding, -1)
    placed = rows.where("_conv IS NOT NULL").select(
        "*", F.row_number().over(same).alias("_seq"),
        *[F.coalesce(F.sum(f("_piece")).over(before), F.lit(0)).cast("bigint").alias(c) for c, f in (("_chars", F.length), ("_bytes", F.octet_length))],
    )
    one = _message(loss_roles)
    joined = placed.groupBy("_conv").agg(F.sort_array(F.collect_list(one)).alias("_all"))
    every = joined.unionByName(alone.select("_conv", F.array(one).alias("_all")))
    formatted = F.concat(F.lit(BEGIN), F.concat_ws("", F.transform("_all", lambda m: m["piece"])), F.lit(END))
    total = F.aggregate(
        F.flatten(F.transform("_all", lambda m: m["files"])), F.lit(0).cast("bigint"), lambda acc, f: acc + f["tokens"],
    )
    return every.select(
        F.col("_conv").alias(conv), formatted.alias("formatted"), F.size("_all").cast("bigint").alias("n_turns"),
        F.array_compact(F.transform("_all", lambda m: m["span"])).alias("loss_spans"),
        F.transform("_all", lambda m: m["files"]).alias("attachments"), total.alias("expanded_tokens"),
    )


def _message(loss_roles: Sequence[str]) -> Column:
    """What the aggregate keeps of a placed message."""
    span = F.struct(
        F.col("_seq").alias("turn"),
        (F.lit(len(BEGIN)) + F.col("_chars") + F.length("_head")).alias("start"), F.length("_body").cast("bigint").alias("length"),
        (F.lit(len(BEGIN)) + F.col("_bytes") + F.octet_length("_head")).alias("first_byte"), F.octet_length("_body").cast("bigint").alias("bytes"),
    )
    return F.struct(
        F.col("_seq").alias("seq"), F.col("_piece").alias("piece"), F.when(F.col("_role").isin(*loss_roles), span).alias("span"),
        F.col("_files").cast(f"array<{_RECORD}>").alias("files"),
    )


def _plain(content: Column, files: Column) -> Column:
    """The text of formatted content: unescaped, each embed put back."""
    marks = "|".join(ENDINGS)
    between = F.transform(F.split(content, rf"<\|(?:{marks})\|>", -1), unescape)
    return F.concat_ws("", F.zip_with(between, F.transform(files, lambda f: f["source"]), lambda t, s: F.concat(F.coalesce(t, F.lit("")), F.coalesce(s, F.lit("")))))


def read_turns(formatted: Column | str = "formatted", attachments: Column | str = "attachments") -> Column:
    """Array of (role, text), read from a formatted conversation."""
    formatted, attachments = [F.col(c) if isinstance(c, str) else c for c in (formatted, attachments)]
    inner = F.substr(formatted, F.lit(len(BEGIN) + 1), F.length(formatted) - len(BEGIN) - len(END))
    # A string cannot contain a template mark but for those of the template: texts are escaped.
    pieces = F.split(inner, r"<\|end\|>", -1)
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)

    def turn(piece: Column, files: Column) -> Column:
        halves = F.transform(F.array(F.split(piece, r"<\|message\|>", 2)), lambda h: F.struct(
            unescape(F.substr(h[0], F.lit(len(START) + 1), F.length(h[0]))).alias("role"), _plain(h[1], files).alias("text"),
        ))
        return halves[0]

    return F.zip_with(pieces, attachments, turn)


def read_loss(formatted: Column | str = "formatted", spans: Column | str = "loss_spans", attachments: Column | str = "attachments") -> Column:
    """The text under the loss mask, one element for each span.

    Spans are cut out of the UTF-8 bytes, which takes time in proportion to the
    span and not to its place.
    """
    formatted, spans, attachments = [F.col(c) if isinstance(c, str) else c for c in (formatted, spans, attachments)]
    whole = F.array(F.struct(formatted.cast("binary").alias("bytes"), spans.alias("spans"), attachments.alias("files")))

    def texts(row: Column) -> Column:
        def cut(s: Column) -> Column:
            piece = F.substring(row["bytes"], (s["first_byte"] + 1).cast("int"), s["bytes"].cast("int")).cast("string")
            return _plain(piece, F.element_at(row["files"], s["turn"]))

        return F.transform(row["spans"], cut)

    return F.transform(whole, texts)[0]
