"""Chat formatting by a grammar round trip, with DataFrame functions only.

A conversation becomes one string of turns in order::

    <s>[INST] role\\ntext [/INST]</s>      any role but assistant
    <s>text</s>                           assistant

A deterministic parser (:func:`parse`) reads it back: ``</s>`` ends a turn, a
turn that begins with ``[INST] `` has a role up to the first line feed, and a
backslash stands for the character after it.  A turn is first rendered as it is
and parsed again.  If the parser doesn't return the very role and text, or if a
control string occurs in the text, the text is escaped: backslashes are
doubled, and a backslash follows the first character of every control string.
Role names are always escaped, with ``\\n`` for a line feed.

The loss mask is a list of character spans of the formatted string: the
assistants' texts (as rendered).

A conversation is the unit of output: its turns meet in one row.  Turns are
rendered and checked before that shuffle, in parallel.

Defined cases: null role and null text are empty; turns with the same number are
ordered by role and text, and a null number comes first; null ids form one
conversation; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import table

# The control strings of the template.
OPEN, CLOSE, INST, END_INST = "<s>", "</s>", "[INST]", "[/INST]"
CONTROLS = (OPEN, CLOSE, INST, END_INST)
ASSISTANT = "assistant"
_ANY = r"<s>|</s>|\[INST\]|\[/INST\]"


def escape(text: Column) -> Column:
    """Reversibly free of control strings."""
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), r"([<\[])(?=s>|/s>|INST\]|/INST\])", r"$1\\")


def unescape(text: Column) -> Column:
    return F.when(F.contains(text, F.lit("\\")), F.regexp_replace(text, r"(?s)\\(.)", "$1")).otherwise(text)


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def _unescape_role(role: Column) -> Column:
    # pairs of backslashes are backslashes; between them \n is a line feed
    parts = F.transform(F.split(role, r"\\\\", -1),
                        lambda x: unescape(F.replace(x, F.lit("\\n"), F.lit("\n"))))
    return F.when(F.contains(role, F.lit("\\")), F.array_join(parts, "\\")).otherwise(role)


def render(role: Column, text: Column) -> Column:
    """One turn, of an escaped role and a text as given."""
    spoken = F.concat(F.lit(f"{OPEN}{INST} "), role, F.lit("\n"), text, F.lit(f" {END_INST}{CLOSE}"))
    return F.when(role == ASSISTANT, F.concat(F.lit(OPEN), text, F.lit(CLOSE))).otherwise(spoken)


def _parse_turn(body: Column) -> Column:
    """Struct ``(role, text)`` of what stands before a ``</s>``; null if it is no turn."""
    inner = F.substr(body, F.lit(len(OPEN) + 1), F.char_length(body))
    spoken = F.startswith(inner, F.lit(f"{INST} ")) & F.endswith(inner, F.lit(f" {END_INST}"))
    said = F.substr(inner, F.lit(len(INST) + 2), F.char_length(inner) - len(INST) - len(END_INST) - 2)
    at = F.locate("\n", said)
    turn = F.when(spoken & (at > 0), F.struct(
        _unescape_role(F.substr(said, F.lit(1), at - 1)).alias("role"),
        unescape(F.substr(said, at + 1, F.char_length(said))).alias("text"))).when(
        ~spoken, F.struct(F.lit(ASSISTANT).alias("role"), unescape(inner).alias("text")))
    return F.when(F.startswith(body, F.lit(OPEN)), turn)


def parse(formatted: Column) -> Column:
    """The turns, structs ``(role, text)``, of a formatted string."""
    bodies = F.split(formatted, CLOSE, -1)
    return F.transform(F.slice(bodies, 1, F.size(bodies) - 1), _parse_turn)


def format_conversations(df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text") -> DataFrame:
    """``(<id_col>, formatted, loss_spans, n_escaped)`` of every conversation; spans
    are ``(start, end)`` in characters from 0, end exclusive."""
    turns = df.select(F.col(id_col).alias("id"), F.col(turn_col).alias("turn"),
                      F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
                      F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    turns = turns.withColumn("safe_role", _escape_role(F.col("role")))
    turns = turns.withColumn("plain", render(F.col("safe_role"), F.col("text")))
    back = parse(F.col("plain"))
    same = (F.size(back) == 1) & F.endswith("plain", F.lit(CLOSE)) & (back[0]["role"].eqNullSafe(F.col("role"))) & (
        back[0]["text"].eqNullSafe(F.col("text"))) & ~F.rlike("text", F.lit(_ANY))
    turns = turns.withColumn("escaped", ~same)
    block = F.when(F.col("escaped"), render(F.col("safe_role"), escape(F.col("text")))).otherwise(F.col("plain"))
    turns = turns.select("id", "turn", "role", "text", "escaped", block.alias("block"))
    order = Window.partitionBy("id").orderBy("turn", "role", "text")
    before = F.sum(F.char_length("block")).over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.char_length("block")
    placed = turns.select("id", F.row_number().over(order).alias("nth"), "block", "escaped",
                          F.when(F.col("role") == ASSISTANT, before + len(OPEN)).alias("start"),
                          F.when(F.col("role") == ASSISTANT, before + F.char_length("block") - len(CLOSE)).alias("end"))
    whole = placed.groupBy("id").agg(
        F.sort_array(F.collect_list(F.struct("nth", "block", "start", "end"))).alias("t"),
        F.sum(F.col("escaped").cast("long")).alias("n_escaped"))
    spans = F.transform(F.filter("t", lambda x: x["start"].isNotNull()),
                        lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))
    return whole.select(F.col("id").alias(id_col), F.array_join(F.col("t.block"), "").alias("formatted"),
                        spans.alias("loss_spans"), "n_escaped")


def read_back(formatted: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """``(<id_col>, turns, formatted)``: the conversations that formatted strings hold."""
    return formatted.select(id_col, parse(F.col("formatted")).alias("turns"), "formatted")


# -- query -------------------------------------------------------------------------

def op7_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    given = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.sql("""select cast(-7 as bigint) as conv_id, turn, role, '</s>[INST] ok [/INST]' as text
                         from values (0, 'user'), (1, 'assistant') as t(turn, role)""")
    turns = read_back(format_conversations(given.unionByName(added)))
    line = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("turns", lambda t: t["role"] == ASSISTANT), lambda t: t["text"]), "")
    out = turns.select("conv_id", F.size("turns").cast("long").alias("n_turns"), line.alias("line"), loss.alias("loss"),
                       F.char_length("formatted").cast("long").alias("formatted_chars"))
    return out.select("conv_id", "n_turns", F.sha2(F.col("line").cast("binary"), 256).alias("turns_sha256"),
                      F.char_length("loss").cast("long").alias("loss_chars"),
                      F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"), "formatted_chars")


ORACLE = r"""
with c as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
           union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
           union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
t as (select *, regexp_matches(text, '<s>|</s>|\[INST\]|\[/INST\]') or contains(text, '\') as escaped,
             length(text) - length(replace(text, '\', ''))
             + len(regexp_extract_all(text, '<s>|</s>|\[INST\]|\[/INST\]')) as more from c)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
       cast(sum(length(text) + case when escaped then more else 0 end
                + case when role = 'assistant' then 7 else 23 + length(role) end) as bigint) as formatted_chars
from t group by conv_id"""
