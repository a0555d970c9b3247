"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it as
context, then its reply, which alone is trainable (``loss_start`` to
``loss_end``, code points of ``text``). Turns after the last reply, and
conversations without one, are kept in a last example that trains nothing.

A turn is written ``<s>role\\ntext</s>``. Inside roles and texts ``&``, ``<``
and ``[`` are written as entities (in roles line ends too), so that no control
string can occur there; :func:`read_turns` undoes it.

A conversation is put together in one row, as its context is one text; its
examples are cut from that row one after the other, so memory follows the
longest conversation and not the square of its turns. Only Spark's own
expressions are used.

Defined cases: null role or text count as empty; null turn numbers come first;
rows of equal turn are ordered by role, then text; repeated rows are turns of
their own; a null ``conv_id`` is one more conversation; other columns do not
matter; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spendgrid.llm.common import read_table

_ENTITIES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"))
_ROLE_ENTITIES = (*_ENTITIES, ("\n", "&#10;"))


def escape(text: Column, entities=_ENTITIES) -> Column:
    for raw, entity in entities:
        text = F.replace(text, F.lit(raw), F.lit(entity))
    return text


def unescape(text: Column, entities=_ENTITIES) -> Column:
    for raw, entity in reversed(entities):
        text = F.replace(text, F.lit(entity), F.lit(raw))
    return text


def format_examples(turns: DataFrame) -> DataFrame:
    """``conv_id, example, n_examples, text, loss_start, loss_end`` from rows
    ``conv_id, turn, role, text``; without a trainable reply both offsets are
    the length of the text."""
    rows = turns.select(
        "conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    parts = rows.select(
        "*", F.concat(F.lit("<s>"), escape(F.col("role"), _ROLE_ENTITIES), F.lit("\n")).alias("head"),
        escape(F.col("text")).alias("body"))
    # each turn's end is an offset into the one text
    so_far = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, 0)
    placed = parts.select("conv_id", F.struct(
        F.sum(F.length("head") + F.length("body") + 4).over(so_far).cast("int").alias("end"),
        (F.col("role") == "assistant").alias("reply"), F.length("body").alias("chars"),
        F.concat("head", "body", F.lit("</s>")).alias("written")).alias("part"))
    ends = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list("part")).alias("parts")).select(
        "conv_id", "parts", F.array_join(F.transform("parts", lambda p: p["written"]), "").alias("whole"))
    cuts = ends.select("conv_id", "whole", F.filter(
        F.transform("parts", lambda p, i: F.when(
            p["reply"] | (i == F.size("parts") - 1),
            F.struct(p["end"].alias("end"), F.when(p["reply"], p["chars"]).alias("reply")))),
        lambda c: c.isNotNull()).alias("cuts"))
    each = cuts.select("conv_id", "whole", F.size("cuts").alias("n_examples"), F.posexplode("cuts").alias("example", "cut"))
    loss_end = F.when(F.col("cut.reply").isNull(), F.col("cut.end")).otherwise(F.col("cut.end") - 4)
    return each.select(
        "conv_id", "example", "n_examples", F.substring("whole", F.lit(1), F.col("cut.end")).alias("text"),
        (loss_end - F.coalesce("cut.reply", F.lit(0))).alias("loss_start"), loss_end.alias("loss_end"))


def read_turns(text: Column) -> Column:
    """The turns of an example's text, array of (role, text)."""
    pieces = F.filter(F.split(text, "</s>"), lambda x: x != "")
    role = lambda x: F.substring_index(F.substring(x, F.lit(4), F.length(x)), "\n", 1)
    return F.transform(pieces, lambda x: F.struct(
        unescape(role(x), _ROLE_ENTITIES).alias("role"),
        unescape(F.substring(x, F.length(role(x)) + 5, F.length(x))).alias("text")))


def read_loss(text: Column, start: Column, end: Column) -> Column:
    """The text under the loss mask."""
    return unescape(F.substring(text, start + 1, end - start))


def digest(examples: DataFrame) -> DataFrame:
    """What the examples of each conversation say, read back from them."""
    last = F.col("example") == F.col("n_examples") - 1
    read = examples.select(
        "conv_id", F.length("text").cast("long").alias("chars"), F.when(last, read_turns(F.col("text"))).alias("turns"),
        F.struct("example", read_loss(F.col("text"), F.col("loss_start"), F.col("loss_end")).alias("loss")).alias("loss"))
    found = read.groupBy("conv_id").agg(
        F.sum("chars").alias("formatted_chars"), F.count("*").alias("n_examples"),
        F.get(F.collect_list("turns"), F.lit(0)).alias("turns"), F.sort_array(F.collect_list("loss")).alias("loss"))
    said = found.select("*", F.array_join(F.transform("loss", lambda x: x["loss"]), "").alias("said"))
    return said.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length("said").cast("long").alias("loss_chars"), F.sha2("said", 256).alias("loss_sha256"),
        "formatted_chars", "n_examples")


CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_TEXT).alias("text"))
    return digest(format_examples(turns.unionByName(control)))


ORACLE_SQL = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{CONTROL_TEXT}' UNION ALL SELECT -1, 1, 'assistant', '{CONTROL_TEXT}'),
e AS (SELECT *, replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&#91;') AS body,
  replace(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '[', '&#91;'), chr(10), '&#10;') AS head FROM t),
o AS (SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY conv_id) AS n,
  sum(length('<s>' || head || chr(10) || body || '</s>')) OVER (w ROWS UNBOUNDED PRECEDING) AS upto
  FROM e WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(upto) FILTER (role = 'assistant' OR i = n)::BIGINT AS formatted_chars,
  count(*) FILTER (role = 'assistant' OR i = n)::BIGINT AS n_examples
FROM o GROUP BY conv_id"""
