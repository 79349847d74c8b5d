"""Chat formatting whose output can be read back.

Grammar (a conversation is its turns, nothing between):

    user       [INST] text [/INST]          with one space inside either mark
    system     <<SYS>>text<</SYS>>
    assistant  <s>text</s>
    any other  <<ROLE>>role<</ROLE>>text<</TURN>>

No mark overlaps itself, so reading each part up to the first closing mark is deterministic. Each turn is rendered,
reparsed and compared with its source; one that does not come back identical is escaped and tried again: in
texts, a backslash goes behind the bracket of anything that reads like a mark (also one with backslashes in it
already), and reading takes one away. The rendered conversation is parsed once more as a whole; if it would not
give back the source the query fails rather than returning it.

Only DataFrame operations are used. Null roles and texts count as empty; turns are ordered by turn, role and text,
nulls first, so ties and repeated rows have a fixed place; a null conversation id is a conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The marks of the template.
USER, SYSTEM, ASSISTANT = ("[INST] ", " [/INST]"), ("<<SYS>>", "<</SYS>>"), ("<s>", "</s>")
ROLE, TURN_END = ("<<ROLE>>", "<</ROLE>>"), "<</TURN>>"
_MARK = r"(/?(?:INST\]|s>|SYS>>|ROLE>>|TURN>>))"
_ESCAPE, _ESCAPED = (r"([\[<])(\\*)" + _MARK, r"$1\\$2$3"), (r"([\[<])\\(\\*)" + _MARK, r"$1$2$3")
_TURN = r"(?s)\[INST\] .*? \[/INST\]|<<SYS>>.*?<</SYS>>|<s>.*?</s>|<<ROLE>>.*?<</ROLE>>.*?<</TURN>>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, *_ESCAPE)


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, *_ESCAPED)


def _render(role: Column, text: Column) -> Column:
    wrapped = lambda marks: F.concat(F.lit(marks[0]), text, F.lit(marks[1]))
    other = F.concat(F.lit(ROLE[0]), escape(role), F.lit(ROLE[1]), text, F.lit(TURN_END))
    return F.when(role == "user", wrapped(USER)).when(role == "system", wrapped(SYSTEM)).when(role == "assistant", wrapped(ASSISTANT)).otherwise(other)


def _part(turn: Column) -> Column:
    """``struct<role, lead, body>`` of one rendered turn: its role, the length of what precedes the text, the text
    as it stands."""

    def inner(role: str, marks: tuple[str, str]) -> Column:
        body = F.substring(turn, F.lit(len(marks[0]) + 1), F.length(turn) - len(marks[0]) - len(marks[1]))
        return F.struct(F.lit(role).alias("role"), F.lit(len(marks[0])).alias("lead"), body.alias("body"))

    named = F.regexp_extract(turn, r"(?s)^<<ROLE>>(.*?)<</ROLE>>", 1)
    lead = F.length(named) + len(ROLE[0]) + len(ROLE[1])
    other = F.struct(unescape(named).alias("role"), lead.alias("lead"), F.substring(turn, lead + 1, F.length(turn) - lead - len(TURN_END)).alias("body"))
    return (
        F.when(turn.startswith(USER[0]), inner("user", USER)).when(turn.startswith(SYSTEM[0]), inner("system", SYSTEM))
        .when(turn.startswith(ASSISTANT[0]), inner("assistant", ASSISTANT)).otherwise(other)
    )


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation: ``array<struct<role, lead, body, size>>``."""
    def turn(seg: Column) -> Column:
        part = _part(seg)
        return F.struct(part["role"].alias("role"), part["lead"].alias("lead"), part["body"].alias("body"), F.length(seg).alias("size"))

    return F.transform(F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(0)), turn)


def recovered(parsed: Column) -> Column:
    """``array<struct<role, text>>`` with the escapes taken back."""
    return F.transform(parsed, lambda t: F.struct(t["role"].alias("role"), unescape(t["body"]).alias("text")))


def _whole(parsed: Column) -> Column:
    return F.aggregate(parsed, F.lit(0), lambda n, t: n + t["size"])


def _same(formatted: Column, source: Column) -> Column:
    """Whether parsing gives back the source turns and leaves nothing over."""
    parsed = parse(formatted)
    return (recovered(parsed) == source) & (_whole(parsed) == F.length(formatted))


def format_conversations(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, formatted, parsed, loss_spans``: the rendered conversation, its parse, and the places (start,
    length, in code points from 0) of the assistant texts in it, which a training loss covers."""
    role_, text_ = F.coalesce(F.col(role).cast("string"), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    turns = rows.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), role_.alias("role"), text_.alias("text"))
    plain = turns.withColumn("rendered", _render(F.col("role"), F.col("text")))
    source = F.array(F.struct("role", "text"))
    plain = plain.withColumn("same", F.coalesce(_same(F.col("rendered"), source), F.lit(False)))
    mended = F.when(F.col("same"), F.col("rendered")).otherwise(_render(F.col("role"), escape(F.col("text"))))
    each = plain.select("conv_id", F.struct("turn", "role", "text", mended.alias("rendered")).alias("t"))
    convs = each.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    convs = convs.withColumn("formatted", F.array_join(F.transform("turns", lambda t: t["rendered"]), ""))
    convs = convs.withColumn("source", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))))
    convs = convs.withColumn("parsed", parse(F.col("formatted")))
    exact = (recovered(F.col("parsed")) == F.col("source")) & (_whole(F.col("parsed")) == F.length("formatted"))
    kept = F.when(exact, F.col("formatted")).otherwise(F.raise_error(F.lit("a conversation does not survive its round trip")))
    convs = convs.withColumn("formatted", kept)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def step(seen: Column, t: Column) -> Column:
        span = F.struct((seen["at"] + t["lead"]).alias("start"), F.length(t["body"]).alias("length"))
        spans = F.when(t["role"] == "assistant", F.concat(seen["spans"], F.array(span))).otherwise(seen["spans"])
        return F.struct((seen["at"] + t["size"]).alias("at"), spans.alias("spans"))

    return convs.select("conv_id", "formatted", "parsed", F.aggregate("parsed", start, step, lambda s: s["spans"]).alias("loss_spans"))


def masked_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"]))), "")
