"""Chat formatting with typed content parts.

A turn is written as <|turn|>role<|body|>parts<|end|> and a newline, its parts in order with <|part|> between them: a
text is written escaped; an image, audio or document becomes a placeholder, and its reference, place and number of
tokens are recorded. Escaping puts a backslash after the first character of whatever would be a control string and adds
one where there are some already, so that it can be undone exactly and no control string comes from a text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .natives import let

TURN, BODY, PART, END = "<|turn|>", "<|body|>", "<|part|>", "<|end|>\n"
#: Tokens that a placeholder stands for where the part doesn't say.
PLACEHOLDER_TOKENS = {"image": 256, "audio": 128, "document": 512}
# The control strings of common chat templates without their first character.
CONTROL_REST = r"/s>|s>|/?INST\]|<SYS>>|</SYS>>|\|[A-Za-z0-9_]+\|>"
PARTS = "array<struct<type: string, text: string, ref: string, tokens: int>>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*)(?={CONTROL_REST})", r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*)(?={CONTROL_REST})", "$1$2")


def text_part(text: Column) -> Column:
    """A content of one text part; null counts as empty."""
    nothing = F.lit(None)
    return F.array(F.struct(F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text"), nothing.cast("string").alias("ref"), nothing.cast("int").alias("tokens")))


def _visit(part: Column) -> Column:
    """What a part is written as. A part of unknown or null type is written as its text."""
    kinds = F.coalesce(part["type"], F.lit("text"))
    return F.when(kinds.isin(*PLACEHOLDER_TOKENS), F.concat(F.lit("<|"), kinds, F.lit("|>"))).otherwise(escape(F.coalesce(part["text"], F.lit(""))))


def _attached(parts: Column) -> Column:
    """The attachments of a turn: place among its parts, type, reference, tokens."""
    default = lambda p: F.coalesce(p["tokens"], *(F.when(p["type"] == k, F.lit(n)) for k, n in PLACEHOLDER_TOKENS.items()))
    placed = F.transform(parts, lambda p, i: F.struct(i.alias("part"), p["type"].alias("type"), p["ref"].alias("ref"), default(p).cast("long").alias("tokens")))
    return F.filter(placed, lambda p: p["type"].isin(*PLACEHOLDER_TOKENS))


def format_turns(turns: DataFrame, learn: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """From conv_id, turn, role, parts: one row for each conversation.

    conv_id, n_turns, formatted, loss_spans (turn from 0, start and stop in code points: the bodies of roles to learn
    from), attachments (turn, part, type, ref, tokens), expanded_tokens (their sum). Turns are ordered by turn, equal
    ones by what they are written as; repeated rows stay; null roles and texts count as empty, a null turn comes first,
    null conv_ids are one conversation. A conversation is one string, so it must fit in a task; nothing else is gathered.
    """
    role = escape(F.coalesce("role", F.lit("")))
    parts = F.coalesce("parts", F.array().cast(PARTS))
    head = F.concat(F.lit(TURN), role, F.lit(BODY))
    written = turns.select("conv_id", "turn", F.coalesce(F.col("role").isin(*learn), F.lit(False)).alias("learn"), head.alias("head"), F.array_join(F.transform(parts, _visit), PART).alias("body"), _attached(parts).alias("attached"))
    whole = F.concat("head", "body", F.lit(END))
    written = written.select("conv_id", "turn", "learn", whole.alias("whole"), F.length("head").alias("head"), F.length("body").alias("body"), "attached")
    order = Window.partitionBy("conv_id").orderBy("turn", "whole")
    before = F.coalesce(F.sum(F.length("whole").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    placed = written.withColumns({"at": F.row_number().over(order) - 1, "start": before + F.col("head")})
    gathered = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("at", "whole", "learn", "start", "body", "attached"))).alias("t"))
    spans = F.transform(F.filter("t", lambda x: x["learn"]), lambda x: F.struct(x["at"].alias("turn"), x["start"].alias("start"), (x["start"] + x["body"]).alias("stop")))
    attachments = F.flatten(F.transform("t", lambda x: F.transform(x["attached"], lambda a: F.struct(x["at"].alias("turn"), a["part"].alias("part"), a["type"].alias("type"), a["ref"].alias("ref"), a["tokens"].alias("tokens")))))
    out = gathered.select("conv_id", F.size("t").cast("long").alias("n_turns"), F.array_join(F.transform("t", lambda x: x["whole"]), "").alias("formatted"), spans.alias("loss_spans"), attachments.alias("attachments"))
    return out.withColumn("expanded_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda s, a: s + F.coalesce(a["tokens"], F.lit(0))))


def read_parts(body: Column) -> Column:
    """The typed parts of a turn's body, in order: type and, of texts, text. A text can't look like a placeholder, as it is escaped."""

    def part(x: Column) -> Column:
        kind = F.coalesce(*(F.when(x == f"<|{k}|>", F.lit(k)) for k in PLACEHOLDER_TOKENS), F.lit("text"))
        return F.struct(kind.alias("type"), F.when(kind == "text", unescape(x)).alias("text"))

    return F.transform(F.split(body, PART.replace("|", r"\|")), part)


def read_turns(formatted: Column) -> Column:
    """Array of role, body (still escaped), text and parts, parsed from a formatted conversation. text: the texts alone, one after the other."""

    def turn(segment: Column) -> Column:
        role = F.substring_index(segment, BODY, 1)
        start = F.length(role) + len(BODY) + 1
        body = F.substring(segment, start, F.length(segment) - start + 1 - len(END))
        parts = read_parts(body)
        return F.struct(unescape(role).alias("role"), body.alias("body"), F.array_join(F.transform(parts, lambda p: p["text"]), "").alias("text"), parts.alias("parts"))

    segments = F.split(formatted, TURN.replace("|", r"\|"))
    return F.transform(F.slice(segments, 2, F.greatest(F.size(segments) - 1, F.lit(0))), turn)


def read_loss(formatted: Column, loss_spans: Column) -> Column:
    """The text under the loss mask: what stands in the output from each span's start to its stop, each part of it unescaped."""

    def read(f: Column, s: Column) -> Column:
        body = F.substring(f, (s["start"] + 1).cast("int"), (s["stop"] - s["start"]).cast("int"))
        return F.array_join(F.transform(F.split(body, PART.replace("|", r"\|")), unescape), "")

    return let(formatted, lambda f: F.array_join(F.transform(loss_spans, lambda s: read(f, s)), ""))
