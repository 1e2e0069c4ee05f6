"""Chat formatting with a grammar round trip.

Method: a conversation is rendered, reparsed by a deterministic parser, and the
recovered turns are compared with the source. Text that conflicts with the template,
whatever looks like one of its control strings, is escaped; what is read back must then
be identical, which is checked for every conversation and not assumed.

The loss mask is spans of the output: where the assistant's texts stand in it. What a
model is trained on is read from there, and unescaped.

Template, a turn each: ``<s>text</s>`` for the assistant, ``[INST]role\\ntext[/INST]``
for any other role. Escaping puts one more backslash inside whatever looks like a
control string, with any number of backslashes in it (``[INST]`` -> ``[\\INST]``),
so it can be undone, and changes nothing else. Control strings hold ``[`` and ``<``
only as their first character, so none can arise across a text's edge.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ASSISTANT = "assistant"
_TURN = r"(?s)<s>.*?</s>|\[INST\].*?\[/INST\]"
_ESCAPE = (r"([\[<])(\\*)(/?INST\]|/?s>)", r"$1\\$2$3")
_UNESCAPE = (r"([\[<])\\(\\*)(/?INST\]|/?s>)", r"$1$2$3")


def escape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(_ESCAPE[0]), F.lit(_ESCAPE[1]))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(_UNESCAPE[0]), F.lit(_UNESCAPE[1]))


def _role(role: Column) -> Column:
    """A role on one line: backslash and line feed get a name."""
    return F.replace(F.replace(role, F.lit("\\"), F.lit("\\b")), F.lit("\n"), F.lit("\\n"))


def _unrole(role: Column) -> Column:
    return F.replace(F.replace(role, F.lit("\\n"), F.lit("\n")), F.lit("\\b"), F.lit("\\"))


def render(turns: Column) -> Column:
    """Text of an array of (role, text), with control strings in them escaped."""
    def turn(t: Column) -> Column:
        return F.when(t["role"] == ASSISTANT, F.concat(F.lit("<s>"), escape(t["text"]), F.lit("</s>"))).otherwise(
            F.concat(F.lit("[INST]"), escape(_role(t["role"])), F.lit("\n"), escape(t["text"]), F.lit("[/INST]"))
        )

    return F.array_join(F.transform(turns, turn), "")


def loss_spans(formatted: Column) -> Column:
    """Where the assistant's texts stand in a rendered text: an array of (start, end) in
    code points, end exclusive, in order."""
    none = F.expr("struct(0 as at, cast(array() as array<struct<start:int,end:int>>) as spans)")

    def add(done: Column, m: Column) -> Column:
        end = done["at"] + F.char_length(m)
        span = F.array(F.struct((done["at"] + 3).alias("start"), (end - 4).alias("end")))  # <s> and </s>
        return F.struct(end.alias("at"), F.when(m.startswith("<s>"), F.concat(done["spans"], span)).otherwise(done["spans"]).alias("spans"))

    return F.aggregate(F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(0)), none, add, lambda done: done["spans"])


def masked_text(formatted: Column, spans: Column) -> Column:
    """All text under a loss mask, unescaped, span after span."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["end"] - s["start"]))), "")


def parse(formatted: Column) -> Column:
    """The turns of a rendered text: an array of (role, text); null unless the whole text is turns."""
    found = F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(0))

    def turn(m: Column) -> Column:
        body = F.substring(m, F.lit(7), F.char_length(m) - 13)  # [INST] and [/INST]
        cut = F.instr(body, "\n")
        return F.when(m.startswith("<s>"), F.struct(F.lit(ASSISTANT).alias("role"), unescape(F.substring(m, F.lit(4), F.char_length(m) - 7)).alias("text"))).otherwise(
            F.struct(_unrole(unescape(F.substring(body, F.lit(1), cut - 1))).alias("role"), unescape(F.substring(body, cut + 1, F.char_length(body))).alias("text"))
        )

    return F.when(F.array_join(found, "") == formatted, F.transform(found, turn))


def format_conversations(rows: DataFrame) -> DataFrame:
    """conv_id, formatted, turns (as read back), loss_spans and n_escaped (turns with a
    control string in their role or text).

    One row per conv_id (null is one conversation). Rows are ordered by turn (nulls
    first), then role, then text; repeated rows are repeated turns; null role and text
    are empty. Other columns are ignored. A conversation is one value, so its rows meet.
    A conversation that does not read back identical raises an error.
    """
    clean = rows.select("conv_id", F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    grouped = clean.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list("t")), lambda t: F.struct(t["role"], t["text"])).alias("source"))
    shown = grouped.withColumn("formatted", render(F.col("source"))).withColumn("turns", parse(F.col("formatted")))
    kept = F.when(F.coalesce(F.col("turns") == F.col("source"), F.lit(False)), F.col("turns")).otherwise(F.raise_error(F.lit("a conversation does not read back")))
    conflicts = F.filter("source", lambda t: (escape(_role(t["role"])) != _role(t["role"])) | (escape(t["text"]) != t["text"]))
    return shown.select("conv_id", "formatted", kept.alias("turns"), loss_spans(F.col("formatted")).alias("loss_spans"), F.size(conflicts).alias("n_escaped"))


def op5_chat_formatting(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """The contract's digests of all conversations and of -1, read back from the output:
    turns by the parser, the loss from the mask's spans. Odd rows as above."""
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").cast("int").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise(ASSISTANT).alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    names = ["conv_id", "turn", "role", "text"]
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("int").alias("turn"), "role", "text").unionByName(extra.select(names))
    done = format_conversations(rows)
    digest = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return done.withColumn("loss", masked_text(F.col("formatted"), F.col("loss_spans"))).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(digest.cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


ORACLE = r"""
with rows as (
  select conv_id::bigint conv_id, turn::integer turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]' union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), shown as (
  select *, regexp_replace(text, '([\[<])(\\*)(/?INST\]|/?s>)', '\1\\\2\3', 'g') as safe from rows
)
select conv_id, count(*)::bigint as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
  sum(length(safe) + case when role = 'assistant' then 7 else 14 + length(role) end)::bigint as formatted_chars
from shown group by conv_id
"""
