"""Quality rules as a short-circuit cascade, all in native expressions.

Each rule rejects a text. On a bounded sample of texts that pass the base rules
every rule's cost (seconds a pass of a job that evaluates it alone, less a job
that evaluates nothing) and its selectivity (share rejected) are measured; rules run in falling order of
rejection per cost, and a text rejected by one is not given to the next (a
CASE evaluates its branches in turn). The order decides only the work: a text
is kept exactly when no rule rejects it.

Defined results: NULL and empty texts have no words, counts of 0 and fail the
base rules. Repeated rows are judged alike. Lines and words are compared as
they stand. Repeated windows are found by a 64-bit hash within one text.
"""

from __future__ import annotations

import time
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from titlecorpus.llm.common import let, stored, table

#: Rows of the sample that cost and selectivity are measured on.
SAMPLE_ROWS = 500
#: Seconds that a measuring job should take, and how often it repeats the sample for that at most.
SECONDS, MOST_TIMES = 0.2, 4096
SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[^#*$%&|<>]+"

#: Name -> condition on the text column under which a text is rejected. Each stands alone.
RULES: Mapping[str, str] = {
    # over a tenth as many symbols as words
    "symbols": rf"10 * length(regexp_replace({{t}}, '{SYMBOLS}', '')) > size(regexp_extract_all({{t}}, '[^\\x20\\x09-\\x0D]+', 0))",
    # over four fifths of the letters are capitals
    "capitals": r"length(regexp_replace({t}, '[^A-Z]+', '')) > 4 * length(regexp_replace({t}, '[^a-z]+', '')) ",
    # a mean word of over 25 or under 2 characters
    "word_length": r"length(regexp_replace({t}, '[\\x20\\x09-\\x0D]+', '')) not between 2 * size(regexp_extract_all({t}, '[^\\x20\\x09-\\x0D]+', 0)) and 25 * size(regexp_extract_all({t}, '[^\\x20\\x09-\\x0D]+', 0))",
    # over half of the lines with a word repeat an earlier one
    "duplicate_lines": r"size(array_distinct(filter(split({t}, '\n'), x -> x rlike '[^\\x20\\x09-\\x0D]'))) * 2 < size(filter(split({t}, '\n'), x -> x rlike '[^\\x20\\x09-\\x0D]'))",
    # no letter in over 30 % of the words
    "no_letters": r"10 * size(filter(regexp_extract_all({t}, '[^\\x20\\x09-\\x0D]+', 0), x -> not x rlike '\\p{{L}}')) > 3 * size(regexp_extract_all({t}, '[^\\x20\\x09-\\x0D]+', 0))",
    # over 30 % of the lines with a word end in an ellipsis
    "ellipses": r"10 * size(filter(split({t}, '\n'), x -> x rlike '(\\.\\.\\.|…)[\\x20\\x09-\\x0D]*$')) > 3 * size(filter(split({t}, '\n'), x -> x rlike '[^\\x20\\x09-\\x0D]'))",
}


def rejects(rule: str, text: str = "text") -> Column:
    return F.coalesce(F.expr(rule.format(t=f"`{text}`")), F.lit(True))


def rule_order(df: DataFrame, rules: Mapping[str, str], text: str = "text", rows: int = SAMPLE_ROWS) -> list[tuple[str, float, float]]:
    """(name, cost in seconds, selectivity) by falling rejection per cost, measured on those of at most ``rows`` texts that pass the base rules.

    The sample is the first rows of a 10 % Bernoulli sample, so it reads only
    as many input partitions as it needs; it is stored once and read by all.
    A job over a few hundred texts lasts no longer than its own start, so the
    texts are repeated until a job takes SECONDS, and the quickest of three
    such jobs counts (what compiling adds is no cost of the rule). Ties go by cost, then by name.
    """
    taken = base_columns(df.select(text).where(F.col(text).isNotNull()).sample(fraction=0.1, seed=7).limit(rows), text)
    sample = stored(taken.where("not base_failed").select(text), "quality_sample")

    def job(condition: Column, times: int) -> tuple[float, int, int]:
        again = sample.select(text, F.explode(F.sequence(F.lit(1), F.lit(times))).alias(f"{text} again"))
        began = time.perf_counter()
        seen = again.agg(F.count("*").alias("n"), F.coalesce(F.sum(condition.cast("long")), F.lit(0)).alias("k")).first()
        return time.perf_counter() - began, seen["n"] // times, seen["k"] // times

    idle = min(job(F.col(text).isNull(), 1)[0] for _ in range(3))  # the first run compiles
    found = []
    for name, rule in rules.items():
        condition, times = rejects(rule, text), 1
        seconds, n, k = job(condition, times)
        while n and seconds - idle < SECONDS and times < MOST_TIMES:
            times *= 4
            seconds = job(condition, times)[0]
        least = min([seconds, *(job(condition, times)[0] for _ in range(2 if n else 0))])
        found.append((name, max(least - idle, 1e-3) / times, k / max(n, 1)))
    return sorted(found, key=lambda r: (-r[2] / r[1], r[1], r[0]))


def cascade(rules: Mapping[str, str], order: list[str], text: str = "text", first: Column | None = None) -> Column:
    """Name of the first rule in ``order`` that rejects, NULL for a kept text. Under ``first`` no rule is evaluated."""
    chain = F.when(first, F.lit("base")) if first is not None else F
    for name in order:
        chain = chain.when(rejects(rules[name], text), F.lit(name))
    return chain


def base_columns(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with word, symbol, duplicate line and repeated word counts and ``base_failed``; clashing names are replaced."""
    given = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(given, SPACE), lambda w: w != "")
    lines = F.filter(F.split(given, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def repeated(ws: Column) -> Column:
        """Words covered by windows whose hash occurs twice: sort (hash, place), keep equal neighbours, sum the gaps up to 3."""
        windows = F.transform(F.sequence(F.lit(0), F.size(ws) - 3), lambda i: F.struct(
            F.xxhash64(F.get(ws, i), F.get(ws, i + 1), F.get(ws, i + 2)).alias("h"), i.alias("i")))

        def places(s: Column) -> Column:
            twice = F.filter(s, lambda x, j: (F.get(s, j - 1)["h"] == x["h"]) | (F.get(s, j + 1)["h"] == x["h"]))
            return F.array_sort(F.transform(twice, lambda x: x["i"]))

        def covered(p: Column) -> Column:
            gaps = F.transform(p, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(p, j + 1) - x, F.lit(3))))
            return F.aggregate(gaps, F.lit(0), lambda total, g: total + g)

        return F.when(F.size(ws) < 4, 0).otherwise(let(F.sort_array(windows), lambda s: let(places(s), covered)))

    counted = df.withColumns({
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.regexp_replace(given, SPACE, "")).cast("long"),
        "n_symbols": F.length(F.regexp_replace(given, SYMBOLS, "")).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": let(words, repeated).cast("long"),
    })
    return counted.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def judge_quality(df: DataFrame, text: str = "text", rules: Mapping[str, str] = RULES) -> DataFrame:
    """``df`` with the base columns, ``rejected_by`` (the first rule to reject in the measured order) and ``kept``."""
    order = [name for name, *_ in rule_order(df, rules, text)]
    judged = base_columns(df, text).withColumn("rejected_by", cascade(rules, order, text, F.col("base_failed")))
    return judged.withColumn("kept", F.col("rejected_by").isNull())


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge_quality(docs).select("doc_id", *BASE, "kept")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return judge_quality(docs).where("kept").select(docs.columns)


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, text IS NULL AS none, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM documents),
c AS MATERIALIZED (
  SELECT *, row_number() OVER () AS n, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
         list_transform(range(len(w) - 2), lambda i: w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3]) AS g FROM d),
p AS (SELECT doc_id, n, unnest(g) AS gram, unnest(range(len(g))) AS i FROM c),
r AS (
  SELECT n, i FROM (SELECT n, i, count(*) OVER (PARTITION BY n, gram) AS times FROM p) WHERE times > 1),
s AS (
  SELECT n, sum(least(3, coalesce(next - i, 3)))::BIGINT AS covered
  FROM (SELECT n, i, lead(i) OVER (PARTITION BY n ORDER BY i) AS next FROM r) GROUP BY 1),
b AS (
  SELECT c.*, coalesce(covered, 0)::BIGINT AS n_repeat_words
  FROM c LEFT JOIN s USING (n)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR none OR 10 * n_symbols > n_words
    OR length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 4 * length(regexp_replace(t, '[^a-z]+', '', 'g'))
    OR word_chars NOT BETWEEN 2 * n_words AND 25 * n_words
    OR 2 * (len(l) - n_dup_lines) < len(l)
    OR 10 * len(list_filter(w, lambda x: NOT regexp_matches(x, '\p{L}'))) > 3 * n_words
    OR 10 * len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) > 3 * len(l)) AS kept
FROM f
"""
