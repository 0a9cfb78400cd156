"""Quality rules as a bitmask ledger: measure once, store failure bits, apply policies and ablations afterwards.

Only DataFrame functions; all work on a text happens inside its row, so there is no shuffle and no hot key.
Null and empty texts have no words: all measures are 0 and only the word-count rule fails. Repeated rows and rows with
a null id each keep their own ledger row. Other columns of the input are neither read nor returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import GAP, WORD

#: Rule name -> failure over the measures; the bit of a rule is its place in this list. New rules go to the end.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "repeated_lines": "10 * n_dup_lines > 6 * n_lines",
    "word_length": "word_chars < 2 * n_words or word_chars > 12 * n_words",
    "capitals": "2 * n_capitals > word_chars",
    "shouting": "10 * n_shouts > n_words",
}

BASE = ("few_words", "repeated_words")

#: Version -> rules that decide. Versions are never edited; a change is a new version.
POLICIES: dict[str, tuple[str, ...]] = {
    "v1": BASE,
    "v2": tuple(RULES),
}

MEASURES = ["n_words", "n_lines", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_capitals", "n_shouts"]


def bit(rule: str) -> int:
    return 1 << list(RULES).index(rule)


def mask(policy: str) -> int:
    return sum(bit(r) for r in POLICIES[policy])


def measured(docs: DataFrame, keep: list[str]) -> DataFrame:
    """`keep` and the measures of every whole text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.filter(F.split(text, GAP), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.rlike(x, F.lit(WORD)))
    count = lambda pattern: (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("long")
    rows = docs.select(
        *keep, words.alias("_words"),
        F.size(words).cast("long").alias("n_words"),
        F.size(lines).cast("long").alias("n_lines"),
        F.length(F.regexp_replace(text, GAP, "")).cast("long").alias("word_chars"),
        count(r"[#*$%&|<>]").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        count(r"\p{Lu}").alias("n_capitals"),
        (F.length(text) - F.length(F.replace(text, F.lit("!"), F.lit("")))).cast("long").alias("n_shouts"))
    # Hashes of the three-word windows in text order. Only a text in which one occurs twice goes on to the sorted
    # form, where equal windows stand side by side and one pass finds the places of the repeated ones.
    windows = F.when(F.size("_words") >= 3, F.expr(
        "transform(sequence(0, size(_words) - 3), i -> xxhash64(_words[i], _words[i + 1], _words[i + 2]))"))
    done = [*keep, *(m for m in MEASURES if m != "n_repeat_words")]
    rows = rows.select(*done, windows.alias("_h"))
    ordered = F.when(F.size(F.array_distinct("_h")) < F.size("_h"), F.sort_array(F.expr(
        "transform(_h, (h, i) -> struct(h, i))")))
    rows = rows.select(*done, ordered.alias("_sorted"))
    places = F.sort_array(F.expr(
        "transform(filter(_sorted, (x, k) -> (k > 0 and _sorted[k - 1].h = x.h)"
        " or (k + 1 < size(_sorted) and _sorted[k + 1].h = x.h)), x -> x.i)"))
    rows = rows.select(*done, places.alias("_at"))
    covered = F.coalesce(F.expr(
        "aggregate(_at, named_struct('n', 0L, 'last', -3), (a, x) -> named_struct("
        "'n', a.n + least(3, x - a.last), 'last', x), a -> a.n)"), F.lit(0).cast("long"))
    # A generator, so that a filter on a measure stays above and does not evaluate the arrays anew inside itself.
    values = F.struct(*[covered.alias(m) if m == "n_repeat_words" else F.col(m) for m in MEASURES])
    return rows.select(*keep, F.inline(F.array(values)))


def ledger(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """`keep` (the id), all measures and `failed`, the bits of the rules that the text breaks."""
    rows = measured(docs, keep or ["doc_id"])
    failed = F.lit(0).cast("long")
    for rule, broken in RULES.items():
        failed = failed.bitwiseOR(F.when(F.expr(broken), F.lit(bit(rule))).otherwise(F.lit(0)).cast("long"))
    return rows.withColumn("failed", failed)


def passes(policy: str) -> Column:
    """Of a ledger row, under one version of the policy."""
    return F.col("failed").bitwiseAND(F.lit(mask(policy))) == 0


def ablations(rows: DataFrame, policy: str) -> DataFrame:
    """Per rule of a policy: rows it breaks, rows only it rejects, rows kept without it.

    Rows are first counted per bit pattern, of which there are at most two to the number of rules.
    """
    decided = F.col("failed").bitwiseAND(F.lit(mask(policy)))
    patterns = rows.groupBy(decided.alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    names = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(bit(r)).cast("long").alias("bit"))
                      for r in POLICIES[policy]])
    each = patterns.withColumn("r", F.explode(names)).select("bits", "n", "r.rule", "r.bit")
    total = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))
    return each.groupBy("rule").agg(
        total(F.col("bits").bitwiseAND(F.col("bit")) != 0).alias("n_failed"),
        total(F.col("bits") == F.col("bit")).alias("n_only"),
        total((F.col("bits") == 0) | (F.col("bits") == F.col("bit"))).alias("n_kept_without"))


def digest(docs: DataFrame, policy: str = "v2") -> DataFrame:
    """Per document the measures of the contract, whether a base rule fails, and the verdict of the policy."""
    base = sum(bit(r) for r in BASE)
    failed = F.col("failed").bitwiseAND(F.lit(base)) != 0
    return ledger(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "failed",
        failed.alias("base_failed"), (~failed & passes(policy)).alias("kept"))


#: The same by SQL; regular expressions and lists instead of the functions above.
SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
m AS (
  SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM t),
g AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n
  FROM (SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM m))),
r AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM g WHERE n > 1) GROUP BY doc_id),
v AS (
  SELECT m.doc_id, len(w)::BIGINT AS n_words, len(l)::BIGINT AS n_lines,
         length(array_to_string(w, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         len(regexp_extract_all(text, '\p{Lu}'))::BIGINT AS n_capitals,
         len(regexp_extract_all(text, '!'))::BIGINT AS n_shouts
  FROM m LEFT JOIN r USING (doc_id)),
f AS (
  SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END
           + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
           + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END
           + CASE WHEN 10 * n_dup_lines > 6 * n_lines THEN 8 ELSE 0 END
           + CASE WHEN word_chars < 2 * n_words OR word_chars > 12 * n_words THEN 16 ELSE 0 END
           + CASE WHEN 2 * n_capitals > word_chars THEN 32 ELSE 0 END
           + CASE WHEN 10 * n_shouts > n_words THEN 64 ELSE 0 END)::BIGINT AS failed
  FROM v)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed,
       (failed & 3) <> 0 AS base_failed, failed = 0 AS kept
FROM f
"""
