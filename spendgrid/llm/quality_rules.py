"""Quality rules: a threshold table compiled into one Spark projection.

Every rule bounds one ratio of a document. :func:`measure` adds the counts the
ratios are made of, and :func:`verdict` compiles the table into one boolean
column. Only Spark's own expressions are used; a document is measured where it
is read, nothing is shuffled.

Defined cases: a null text counts as empty; a document without words has all
counts 0 and fails ``n_words``; repeated rows are measured one by one; columns
of the input that are not ``doc_id`` or ``text`` do not matter; an empty table
gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendgrid.llm.common import WORD_SEPARATOR, read_table, text_of

SYMBOLS = r"[#*$%&|<>]"

#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "a", "is", "that", "for", "was", "on", "with", "as", "it",
    "der", "die", "das", "und", "den", "von", "zu", "mit", "ist", "des", "im", "dem", "ein", "eine",
    "le", "la", "les", "de", "et", "en", "un", "une", "du", "dans", "est", "que", "pour",
    "el", "los", "las", "y", "con", "por", "se", "del", "su", "no",
)


@dataclass(frozen=True)
class Rule:
    """Keep documents whose ``per_thousand * value <= 1000 * bound`` in the
    direction of ``keep``: "min" or "max". Ratios are compared as integers, so
    no rounding decides a case: ``numerator / denominator`` against
    ``bound / 1000``."""

    name: str
    numerator: str
    denominator: str | None
    keep: str
    bound: int

    def failed(self) -> Column:
        value = F.col(self.numerator) * F.lit(1000 if self.denominator else 1)
        limit = F.lit(self.bound) * (F.col(self.denominator) if self.denominator else F.lit(1))
        return value < limit if self.keep == "min" else value > limit


#: Rejected whatever else holds.
BASE_RULES = (
    Rule("too_short", "n_words", None, "min", 50),
    Rule("repeated_words", "n_repeat_words", "n_words", "max", 500),
)

#: Bounds in thousandths of the denominator.
RULES = (
    Rule("symbols", "n_symbols", "n_words", "max", 100),
    Rule("short_words", "word_chars", "n_words", "min", 2_000),
    Rule("long_words", "word_chars", "n_words", "max", 14_000),
    Rule("few_stop_words", "n_stop_words", "n_words", "min", 20),
    Rule("exclamation", "n_exclamations", "n_words", "max", 300),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", "max", 500),
)

_POSITION_BITS = 24
_MAX_FAST_WORDS = 1 << _POSITION_BITS


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id`` with the counts that rules refer to.

    Words in 3-word windows that occur twice or more are found by one sort of
    64-bit keys per document: 40 bits of the window's hash, 24 of its position.
    Neighbours of equal hash are compared as words; a document in which they
    differ, or that has too many words for the key, is counted from the sorted
    windows themselves.
    """
    words = F.filter(F.split("t", WORD_SEPARATOR), lambda w: w != "")
    lines = F.filter(F.split("t", "\n"), lambda s: s.rlike(r"[^\x20\x09-\x0D]"))
    parts = docs.select("doc_id", text_of(text).alias("t")).select(
        "doc_id", words.alias("w"), lines.alias("l"),
        (F.length("t") - F.length(F.regexp_replace("t", SYMBOLS, ""))).alias("n_symbols"),
        (F.length("t") - F.length(F.regexp_replace("t", "!", ""))).alias("n_exclamations"),
    )
    n = F.size("w")
    window = lambda i: F.struct(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2))
    key = lambda w, i: F.xxhash64(w, F.get("w", i + 1), F.get("w", i + 2)).bitwiseAND(
        F.lit(-_MAX_FAST_WORDS)).bitwiseOR(i.cast("long"))
    counted = parts.select(
        "doc_id", "w", "n_symbols", "n_exclamations",
        F.size("l").alias("n_lines"), (F.size("l") - F.size(F.array_distinct("l"))).alias("n_dup_lines"),
        F.length(F.array_join("w", "")).alias("word_chars"),
        F.size(F.filter("w", lambda w: F.lower(w).isin(*STOP_WORDS))).alias("n_stop_words"),
        F.when((n >= 3) & (n <= _MAX_FAST_WORDS), F.sort_array(F.transform(F.slice("w", F.lit(1), n - 2), key)))
        .otherwise(F.array().cast("array<bigint>")).alias("k"),
    )
    position = lambda x: x.bitwiseAND(F.lit(_MAX_FAST_WORDS - 1)).cast("int")
    paired = counted.withColumn("e", F.when(F.size("k") >= 2, F.filter(
        F.sequence(F.lit(0), F.size("k") - 2),
        lambda j: F.shiftright(F.get("k", j), _POSITION_BITS) == F.shiftright(F.get("k", j + 1), _POSITION_BITS)))
        .otherwise(F.array().cast("array<int>")))
    differ = F.exists("e", lambda j: window(position(F.get("k", j))) != window(position(F.get("k", j + 1))))
    fast = F.sort_array(F.array_distinct(F.concat(
        F.transform("e", lambda j: position(F.get("k", j))), F.transform("e", lambda j: position(F.get("k", j + 1))))))
    slow = F.transform(F.slice("w", F.lit(1), F.greatest(n - 2, F.lit(0))), lambda w, i: F.struct(window(i).alias("g"), i.alias("i")))
    placed = paired.select(
        "*", F.when((n > _MAX_FAST_WORDS) | differ, F.sort_array(slow)).alias("s")).select(
        "*", F.when(F.col("s").isNull(), fast).otherwise(F.sort_array(F.transform(
            F.filter(F.transform("s", lambda x, j: F.struct(x["i"].alias("i"), (
                F.coalesce(x["g"] == F.get("s", j + 1)["g"], F.lit(False))
                | F.coalesce(x["g"] == F.get("s", j - 1)["g"], F.lit(False))).alias("twice"))), lambda x: x["twice"]),
            lambda x: x["i"]))).alias("p"))
    covered = F.aggregate(
        F.transform("p", lambda p, j: F.least(F.lit(3), F.coalesce(F.get("p", j + 1) - p, F.lit(3)))),
        F.lit(0), lambda a, x: a + x)
    long = lambda c: F.col(c).cast("long").alias(c)
    return placed.select(
        "doc_id", n.cast("long").alias("n_words"), long("word_chars"), long("n_symbols"), long("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"), long("n_lines"), long("n_stop_words"), long("n_exclamations"))


def verdict(measured: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Adds ``base_failed``, ``kept`` and ``failed_rules`` (names, in order)."""
    base, more = [[(r.name, r.failed()) for r in part] for part in (BASE_RULES, rules)]
    any_of = lambda found: F.coalesce(F.exists(F.array(*[c for _, c in found]), lambda x: x), F.lit(False)) if found else F.lit(False)
    out = measured.select(
        "*", any_of(base).alias("base_failed"),
        F.array_compact(F.array(*[F.when(c, F.lit(name)) for name, c in [*base, *more]])).alias("failed_rules"))
    return out.withColumn("kept", F.size("failed_rules") == 0)


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """One row per row of ``docs``: the counts, ``base_failed``, ``kept``."""
    return verdict(measure(docs, text), rules)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_stop_words", "n_exclamations", "n_lines", F.array_join("failed_rules", ",").alias("failed_rules"))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that no rule rejects."""
    judged = quality_rules(docs.select(F.struct("*").alias("doc_id"), "text"))
    # a filter on a row number stays above the projections; pushed below them,
    # it would hold all their expressions once more for each that uses another
    return judged.withColumn("row_", F.monotonically_increasing_id()).where("kept and row_ >= 0").select("doc_id.*")


def _oracle_sql() -> str:
    failed = []
    for r in (*BASE_RULES, *RULES):
        left, right = (f"1000 * {r.numerator}", f"{r.bound} * {r.denominator}") if r.denominator else (r.numerator, r.bound)
        failed.append((r.name, f"{left} {'<' if r.keep == 'min' else '>'} {right}"))
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    names = ", ".join(f"CASE WHEN {sql} THEN '{name}' END" for name, sql in failed)
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM d),
g AS (SELECT r, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM g) WHERE n > 1),
rep AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY r),
m AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
  (length(t) - length(regexp_replace(t, '{SYMBOLS}', '', 'g')))::BIGINT AS n_symbols,
  (length(t) - length(replace(t, '!', '')))::BIGINT AS n_exclamations,
  len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
  coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
  len(list_filter(w, lambda x: lower(x) IN ({stop})))::BIGINT AS n_stop_words
  FROM w LEFT JOIN rep USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 50 OR 1000 * n_repeat_words > 500 * n_words) AS base_failed,
  NOT ({' OR '.join(sql for _, sql in failed)}) AS kept, n_stop_words, n_exclamations, n_lines,
  array_to_string(list_filter([{names}], lambda x: x IS NOT NULL), ',') AS failed_rules
FROM m"""


ORACLE_SQL = _oracle_sql()
