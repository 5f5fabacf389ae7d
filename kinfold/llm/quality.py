"""Quality rules as a bitmask ledger, in DataFrame functions alone.

Every rule is evaluated once; the ledger keeps measurements and a bit for each failed rule.  A
policy is a mask of the rules that reject: policies are versioned, applied to the ledger without
reading texts again, and compared by counts over the distinct bit patterns.

Words are runs of [^\\x20\\x09-\\x0D].  Windows of three words are compared by a 64-bit hash.

Defined results: a null text has no words and all measurements 0, and so fails ``few_words``
alone; shares of nothing are 0.  Columns named like the ledger are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
DIGITS = "0123456789"

#: Rules by bit; each holds for a ledger's measurements when a document fails it.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "repeated_lines": "100 * n_dup_lines > 40 * n_lines",
    "word_length": "n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 15 * n_words)",
    "digits": "100 * n_digits > 30 * word_chars",
}
#: Policies by version: the rules that reject.
POLICIES: dict[str, tuple[str, ...]] = {
    "base-1": ("few_words", "repeated_words"),
    "full-1": tuple(RULES),
}
MEASURES = ("n_words", "word_chars", "n_symbols", "n_digits", "n_lines", "n_dup_lines", "n_repeat_words")


def mask(policy: str | tuple[str, ...]) -> int:
    names = list(RULES)
    return sum(1 << names.index(r) for r in (POLICIES[policy] if isinstance(policy, str) else policy))


def _without(text: Column, characters: str) -> Column:
    return F.length(F.translate(text, characters, "")).cast("long")


def _repeated(words: Column) -> Column:
    """Words in three-word windows found twice or more, the first time included."""
    windows = F.transform(F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0))), lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))

    def starts(s: Column) -> Column:
        """Sorted starts of repeated windows, given (hash, start) in order."""
        same = lambda e, j: (F.get(s, j - 1)["h"] == e["h"]) | (F.get(s, j + 1)["h"] == e["h"])
        return F.array_sort(F.transform(F.filter(s, lambda e, j: F.coalesce(same(e, j), F.lit(False))), lambda e: e["i"]))

    def covered(at: Column) -> Column:
        first = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last"))
        return F.aggregate(at, first, lambda s, i: F.struct((s["n"] + F.least(F.lit(3), i - s["last"])).alias("n"), i.alias("last")), lambda s: s["n"])

    def count(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        # most texts repeat nothing, which a set of longs tells without a sort
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(_let(_let(ordered, starts), covered))

    return _let(windows, count)


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ledger(docs: DataFrame, *, text: str = "text", result: str = "ledger") -> DataFrame:
    """``docs`` with a struct column: all measurements, and ``failed`` with a bit for each rule."""
    whole = F.coalesce(F.col(text), F.lit(""))
    has_word = lambda x: F.length(F.translate(x, SPACES, "")) > 0
    lines = F.filter(F.split(whole, "\n"), has_word)
    words = F.filter(F.split(whole, SPACE), lambda w: w != "")
    measured = docs.withColumns({"__words": words, "__lines": F.when(F.contains(whole, F.lit("\n")), lines).otherwise(F.filter(F.array(whole), has_word))})
    values = {
        "n_words": F.size("__words").cast("long"),
        "word_chars": _without(whole, SPACES),
        "n_symbols": F.length(whole) - _without(whole, SYMBOLS),
        "n_digits": F.length(whole) - _without(whole, DIGITS),
        "n_lines": F.size("__lines").cast("long"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "n_repeat_words": _repeated(F.col("__words")),
    }
    measured = measured.withColumn("__m", F.struct(*[values[m].alias(m) for m in MEASURES])).drop("__words", "__lines")
    failed = sum((F.when(F.expr(_of("__m", rule)), F.lit(1 << i)).otherwise(F.lit(0)) for i, rule in enumerate(RULES.values())), F.lit(0)).cast("long")
    return measured.withColumn(result, F.struct(*[F.col(f"__m.{m}").alias(m) for m in MEASURES], failed.alias("failed"))).drop("__m")


def _of(struct: str, rule: str) -> str:
    for m in sorted(MEASURES, key=len, reverse=True):
        rule = rule.replace(m, f"{struct}.{m}")
    return rule


def kept(policy: str | tuple[str, ...], result: str = "ledger") -> Column:
    return F.col(f"{result}.failed").bitwiseAND(F.lit(mask(policy))) == 0


def ablations(ledgers: DataFrame, policy: str = "full-1", result: str = "ledger") -> DataFrame:
    """For each rule of a policy: documents that fail it, and those that fail it alone, which the
    policy without that rule would keep.  Rows are counted by bit pattern first."""
    patterns = ledgers.groupBy(F.col(f"{result}.failed").bitwiseAND(F.lit(mask(policy))).alias("failed")).agg(F.count("*").alias("n"))
    bits = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(mask((r,))).alias("bit")) for r in POLICIES[policy]])
    each = patterns.select("failed", "n", F.explode(bits).alias("b"))
    fails, alone = F.col("failed").bitwiseAND(F.col("b.bit")) != 0, F.col("failed") == F.col("b.bit")
    total = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0))
    return each.groupBy(F.col("b.rule").alias("rule")).agg(F.sum("n").alias("documents"), total(fails).alias("failed"), total(alone).alias("only_this"), total(F.col("failed") == 0).alias("kept"))


def keep_good(docs: DataFrame, *, policy: str = "full-1", text: str = "text") -> DataFrame:
    """The documents that a policy keeps.

    A row number, which the filter reads, keeps the filter above the ledger: pushed below it, every
    rule would measure the text again.
    """
    once = ledger(docs, text=text, result="__ledger").withColumn("__row", F.monotonically_increasing_id())
    return once.where(kept(policy, "__ledger") & (F.col("__row") >= 0)).select(*docs.columns)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ledger(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return found.select(
        "doc_id", *[F.col(f"ledger.{m}").alias(m) for m in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        (~kept("base-1")).alias("base_failed"), kept("full-1").alias("kept"), F.col("ledger.failed").alias("failed"),
    )


OP7_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), s AS (
  SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d
), k AS (
  SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS k FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM s)
), p AS (
  SELECT r, count(DISTINCT pos) AS n FROM (
    SELECT r, unnest([i, i + 1, i + 2]) AS pos FROM (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS c FROM k) WHERE c > 1
  ) GROUP BY r
), m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(regexp_extract_all(t, '[0-9]'))::BIGINT AS n_digits,
         len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM s LEFT JOIN p USING (r)
), f AS (
  SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END + CASE WHEN 100 * n_dup_lines > 40 * n_lines THEN 8 ELSE 0 END
    + CASE WHEN n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 15 * n_words) THEN 16 ELSE 0 END
    + CASE WHEN 100 * n_digits > 30 * word_chars THEN 32 ELSE 0 END)::BIGINT AS failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failed & 3) <> 0 AS base_failed, failed = 0 AS kept, failed FROM f
"""
