"""Quality rules as a bitmask ledger, with DataFrame functions only.

`measure` takes every measurement of a text once; `ledger` turns them into one bit for each
rule that the text fails. Policies are versioned masks over those bits, so a new policy or an
ablation reads the ledger and never the texts.

Null or empty text has no words: every count is 0 and the short-text bit is set. Very long
texts are measured whole. Repeated rows are judged alike, ties do not arise, null ids and
extra columns stay as they are (a column that has the name of an output is replaced), and
empty tables give empty results.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

SPACE = r"[\x20\x09-\x0D]"

#: Rules in bit order: name and the condition under which a text fails.
RULES: tuple[tuple[str, str], ...] = (
    ("short", "n_words < 50"),
    ("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("capitals", "10 * n_capitals > 3 * word_chars"),
    ("exclamations", "10 * n_exclamations > n_words"),
    ("repeated_lines", "100 * n_dup_lines > 40 * n_lines"),
    ("word_length", "word_chars < 2 * n_words OR word_chars > 15 * n_words"),
)
BIT = {name: 1 << k for k, (name, _) in enumerate(RULES)}

#: Versioned policies: the rules whose failure rejects a text.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("short", "repeated_words"),
    "v1": tuple(BIT),
}


def mask_of(policy: str) -> int:
    return reduce(lambda mask, name: mask | BIT[name], POLICIES[policy], 0)


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_capitals, n_exclamations.

    Windows of three words are compared by a 64-bit hash within their own text. A text without
    a repeated window, as most are, is done after one hash set; only the others are sorted.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    inner = F.btrim(whole, F.lit(" \t\n\x0b\x0c\r"))
    lines = F.filter(F.split(whole, "\n"), lambda line: F.btrim(line, F.lit(" \t\n\x0b\x0c\r")) != "")
    without = lambda pattern: F.length(F.regexp_replace(whole, pattern, ""))
    kept = [c for c in docs.columns if c not in MEASURES and not c.startswith("_rule_")]
    at = lambda i: F.get("_rule_words", i)
    first = docs.select(
        *kept,
        F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, f"{SPACE}+")).alias("_rule_words"),
        lines.alias("_rule_lines"),
        without(f"{SPACE}+").cast("long").alias("word_chars"),
        (F.length(whole) - without(r"[#*$%&|<>]+")).cast("long").alias("n_symbols"),
        (F.length(whole) - without(r"\p{Lu}+")).cast("long").alias("n_capitals"),
        (F.length(whole) - F.length(F.replace(whole, F.lit("!"), F.lit("")))).cast("long").alias("n_exclamations"),
    )
    second = first.select(
        *[c for c in first.columns if c != "_rule_words"],
        F.size("_rule_words").cast("long").alias("n_words"),
        F.when(F.size("_rule_words") > 3, F.transform(F.sequence(F.lit(0), F.size("_rule_words") - 3), lambda i: F.xxhash64(at(i), at(i + 1), at(i + 2)))).alias("_rule_windows"),
    )
    repeated = F.size(F.array_distinct("_rule_windows")) < F.size("_rule_windows")
    third = second.withColumn("_rule_sorted", F.when(repeated, F.sort_array(F.transform("_rule_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    same = lambda x, j: F.coalesce(F.get("_rule_sorted", j)["h"] == x["h"], F.lit(False))
    starts = F.sort_array(F.transform(F.filter("_rule_sorted", lambda x, j: same(x, j - 1) | same(x, j + 1)), lambda x: x["i"]))
    zero = F.struct(F.lit(-3).alias("before"), F.lit(0).cast("long").alias("n"))
    covered = F.aggregate(starts, zero, lambda a, x: F.struct(x.alias("before"), (a["n"] + F.least(F.lit(3), x - a["before"])).alias("n")), lambda a: a["n"])
    return third.select(
        *kept,
        "n_words",
        "word_chars",
        "n_symbols",
        F.size("_rule_lines").cast("long").alias("n_lines"),
        (F.size("_rule_lines") - F.size(F.array_distinct("_rule_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        "n_capitals",
        "n_exclamations",
    )


MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_capitals", "n_exclamations")


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """Measurements and failed_bits, one bit for each failed rule; each rule is evaluated once."""
    bits = [F.when(F.expr(condition), BIT[name]).otherwise(0) for name, condition in RULES]
    return measure(docs, text).withColumn("failed_bits", reduce(Column.bitwiseOR, bits).cast("int"))


def verdict(policy: str) -> Column:
    """True where a ledger row passes the policy."""
    return F.col("failed_bits").bitwiseAND(F.lit(mask_of(policy))) == 0


def ablations(entries: DataFrame, policy: str) -> DataFrame:
    """For each rule of a policy: texts it fails, texts that only it fails, texts kept without it.

    Counts by distinct bit pattern come first, so the shuffle carries at most 2 ** rules rows
    from each task, whatever the size of the ledger.
    """
    mask = mask_of(policy)
    patterns = entries.groupBy(F.col("failed_bits").bitwiseAND(F.lit(mask)).alias("bits")).agg(F.count("*").alias("n"))
    rules = F.explode(F.array(*[F.struct(F.lit(name).alias("rule"), F.lit(BIT[name]).alias("bit")) for name in POLICIES[policy]]))
    hit = lambda condition: F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).alias
    return patterns.select("bits", "n", rules.alias("r")).groupBy(F.col("r.rule").alias("rule")).agg(
        hit(F.col("bits").bitwiseAND(F.col("r.bit")) != 0)("n_failed"),
        hit(F.col("bits") == F.col("r.bit"))("n_failed_alone"),
        hit(F.col("bits").bitwiseAND(F.bitwise_not(F.col("r.bit"))) == 0)("n_kept_without"),
    )


def op3_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of every document, judged by policy v1; the base rules are two of its bits."""
    entries = ledger(common.read(spark, sf_dir, "documents").select("doc_id", "text"))
    base_failed = F.col("failed_bits").bitwiseAND(F.lit(mask_of("base"))) != 0
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return entries.select(*columns, base_failed.alias("base_failed"), verdict("v1").alias("kept"), "failed_bits")


OP3_SQL = r"""
WITH parts AS (
  SELECT doc_id, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents
), numbered AS (SELECT row_number() OVER () AS row_id, * FROM parts),
windows AS (
  SELECT row_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS k
  FROM (SELECT row_id, w, unnest(range(1, len(w) - 1)) AS i FROM numbered)
), repeats AS (SELECT row_id, i FROM (SELECT *, count(*) OVER (PARTITION BY row_id, k) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT row_id, count(DISTINCT i + j) AS n FROM repeats CROSS JOIN (SELECT unnest(range(0, 3)) AS j) GROUP BY row_id
), counts AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(length(t) - length(regexp_replace(t, '\p{Lu}', '', 'g')) AS BIGINT) AS n_capitals,
         CAST(length(t) - length(replace(t, '!', '')) AS BIGINT) AS n_exclamations
  FROM numbered LEFT JOIN covered c USING (row_id)
), bits AS (
  SELECT *, CAST((CASE WHEN n_words < 50 THEN 1 ELSE 0 END) | (CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END)
       | (CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END) | (CASE WHEN 10 * n_capitals > 3 * word_chars THEN 8 ELSE 0 END)
       | (CASE WHEN 10 * n_exclamations > n_words THEN 16 ELSE 0 END) | (CASE WHEN 100 * n_dup_lines > 40 * n_lines THEN 32 ELSE 0 END)
       | (CASE WHEN word_chars < 2 * n_words OR word_chars > 15 * n_words THEN 64 ELSE 0 END) AS INTEGER) AS failed_bits
  FROM counts
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (failed_bits & 3) <> 0 AS base_failed, failed_bits = 0 AS kept, failed_bits
FROM bits
"""
