"""Personal data by bootstrapped contextual extraction, in DataFrame functions alone.

Base kinds are found by their patterns.  They seed a bipartite graph of lexical patterns (the words
before, after or around a base span of any kind, or a number-like token outside spans) and instances
(the span or token): a pattern is as reliable as the share of its instances that are believed, an
instance is believed as far as its most reliable pattern, and both are scored in turn.  Patterns
that end up reliable and well supported report the tokens in their place that no base pattern
knows, as kind ``context``.

Matches are rows of their own: positions are running sums of the lengths of matches and of what
stands between them, and what overlaps is told by running maxima and minima, so that a text of a
great many matches costs no more than a sort of them.

Defined results: a null text counts as empty and has no spans; positions are code points, ends
exclusive; equal texts and repeated rows get equal spans; spans that begin together stand in the
order of kinds; very long texts, addresses and numbers are read to their end; an empty table gives an
empty result.  Other columns stay as they are, except that one named like the result is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .store import forget, settle

KINDS = ("email", "ip", "card", "phone")

# Each pattern finds the same places as the plain one of its kind.  An e-mail's local part can only
# begin where a run of its characters does, or where the last match ended; a card can only begin
# and end where digits joined by single separators do.  Repeated groups are possessive, which Java
# runs as a loop: a plain repetition of a group recurses, and overflows the stack on long addresses.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: A token of at least five digits, and the words before and after it that make patterns.
NUMBER = r"(?<!\S)[^\s0-9]*+(?:[0-9][^\s0-9]*+){5,}+"
BEFORE, AFTER = r"(\S{1,40}\s+\S{1,40})\s+$", r"^\s+(\S{1,40}\s+\S{1,40})"
LABEL = r"(\S{1,40}[:=#])\s+$"
LAST, NEXT = r"(\S{1,40})\s+$", r"^\s+(\S{1,40})"
TAIL = 90

#: Rounds of scoring; what a pattern needs to be trusted.
ROUNDS, RELIABLE, SEEDS = 3, 0.8, 5

MATCH = "array<struct<kind:string,i:int,before:int,value:string,tail:string,head:string>>"


def matches(text: Column, kind: str, pattern: str) -> Column:
    """All matches in order: value, length and end of what stands before it, start of what follows."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.transform(F.split(text, pattern, -1), lambda b: F.struct(F.length(b).alias("n"), F.right(b, F.lit(TAIL)).alias("tail"), F.left(b, F.lit(TAIL)).alias("head")))
    rows = F.arrays_zip(found.alias("value"), F.slice(between, 1, F.size(found)).alias("b"), F.slice(between, 2, F.size(found)).alias("a"))
    each = lambda m, i: F.struct(F.lit(kind).alias("kind"), i.alias("i"), m["b"]["n"].alias("before"), m["value"].alias("value"), m["b"]["tail"].alias("tail"), m["a"]["head"].alias("head"))
    return F.transform(rows, each)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    each = F.split(F.reverse(_digits(value)), "(?!^)(?=.)")
    doubled = lambda d: F.when(d > 4, 2 * d - 9).otherwise(2 * d)
    points = F.transform(each, lambda c, i: F.when(i % 2 == 1, doubled(c.cast("int"))).otherwise(c.cast("int")))
    return F.aggregate(points, F.lit(0), lambda a, x: a + x) % 10 == 0


def _octets(value: Column) -> Column:
    part = lambda p: F.regexp_replace(p, "^0+(?=.)", "")
    return F.forall(F.split(value, r"\."), lambda p: F.when(F.length(part(p)) > 3, F.lit(False)).otherwise(part(p).cast("int") <= 255))


def _valid() -> Column:
    """Whether a match of a kind is one; matches that fail are dropped, positions stay."""
    kind, v = F.col("kind"), F.col("value")
    return F.when(kind == "ip", _octets(v)).when(kind == "card", _luhn(v)).when(kind == "phone", F.length(_digits(v)).between(9, 15)).otherwise(F.lit(True))


def _told(tail: Column, head: Column) -> Column:
    """Patterns by the words next to an instance, in lower case and with 0 for all digits."""
    plain = lambda c: F.lower(F.regexp_replace(c, r"[0-9]+", "0"))
    before, label, last = (F.regexp_extract(tail, p, 1) for p in (BEFORE, LABEL, LAST))
    after, following = (F.regexp_extract(head, p, 1) for p in (AFTER, NEXT))
    if_there = lambda c, out: F.when(c, plain(out))
    named = F.array(
        if_there(before != "", F.concat(before, F.lit(" _"))), if_there(label != "", F.concat(label, F.lit(" _"))), if_there(after != "", F.concat(F.lit("_ "), after)),
        if_there((last != "") & (following != ""), F.concat(last, F.lit(" _ "), following)),
    )
    return F.array_distinct(F.filter(named, lambda x: x.isNotNull()))


def scan(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """``docs`` with ``__m``: all matches of base kinds and number-like tokens, failing ones included.
    A text that can't hold a kind isn't searched for it."""
    whole = F.coalesce(F.col(text), F.lit(""))
    five = r"[0-9][^\s0-9]*+[0-9][^\s0-9]*+[0-9][^\s0-9]*+[0-9][^\s0-9]*+[0-9]"
    guarded = [
        (F.contains(whole, F.lit("@")), "email", EMAIL), (whole.rlike(r"[0-9]\.[0-9]"), "ip", IP), (whole.rlike(CARD), "card", CARD),
        (F.contains(whole, F.lit("+")), "phone", PHONE), (whole.rlike(five), "number", NUMBER),
    ]
    none = F.lit([]).cast(MATCH)
    return docs.withColumn("__m", F.concat(*[F.when(guard, matches(whole, kind, pattern)).otherwise(none) for guard, kind, pattern in guarded]))


def instances(scanned: DataFrame) -> DataFrame:
    """(row, kind, start, end, value, seed, patterns): base spans, and number-like tokens outside them.

    A base span that begins inside another is reported, but is no identifier of its own: it has no
    patterns.
    """
    order = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    m = scanned.select(F.col("__row").alias("row"), F.explode("__m").alias("m")).select("row", "m.*")
    m = m.withColumn("end", F.sum(F.col("before") + F.length("value")).over(order).cast("int")).where(_valid())
    m = m.withColumn("start", F.col("end") - F.length("value")).withColumn("seed", F.col("kind") != "number")
    # a token is what stands between its first and last letter or digit
    core = F.regexp_replace(F.regexp_replace("value", "^[^0-9A-Za-z+]+", ""), "[^0-9A-Za-z]+$", "")
    lead = F.length(F.regexp_extract("value", "^[^0-9A-Za-z+]*", 0))
    m = m.withColumns({"core": F.when(F.col("seed"), F.col("value")).otherwise(core), "lead": F.when(F.col("seed"), F.lit(0)).otherwise(lead)})
    m = m.withColumns({"start": F.col("start") + F.col("lead"), "value": F.col("core")}).withColumn("end", F.col("start") + F.length("value"))
    earlier = Window.partitionBy("row").orderBy("start", F.desc("seed"), F.desc("end"), "kind").rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy("row").orderBy(F.desc("start"), "seed", "end", F.desc("kind")).rowsBetween(Window.unboundedPreceding, -1)
    spans = lambda c: F.when(F.col("seed"), F.col(c))
    inside = F.coalesce(F.max(spans("end")).over(earlier) > F.col("start"), F.lit(False))
    cut = F.coalesce(F.min(spans("start")).over(later) < F.col("end"), F.lit(False))
    m = m.withColumns({"inside": inside, "cut": cut}).where("seed OR NOT (inside OR cut)")
    # what is joined to the value is none of the words next to it
    tail = F.when(F.col("seed"), F.regexp_replace("tail", r"\S+$", "")).otherwise(F.col("tail"))
    head = F.when(F.col("seed"), F.regexp_replace("head", r"^\S+", "")).otherwise(F.col("head"))
    patterns = F.when(~F.col("inside"), _told(tail, head)).otherwise(F.array().cast("array<string>"))
    return m.select("row", "kind", "start", "end", "value", "seed", patterns.alias("patterns")).where("seed OR size(patterns) > 0")


def reliable_patterns(found: DataFrame, *, rounds: int = ROUNDS, reliable: float = RELIABLE, seeds: int = SEEDS) -> DataFrame:
    """(pattern, score, seeds): patterns to trust, scored over the whole graph in ``rounds`` turns."""
    edges = found.select(F.explode("patterns").alias("pattern"), "value", F.col("seed").cast("int").alias("seed"))
    edges = settle(edges.groupBy("pattern", "value").agg(F.max("seed").alias("seed")))
    known = edges.groupBy("value").agg(F.max("seed").cast("double").alias("belief"))
    for turn in range(rounds):
        scored = edges.join(known, "value").groupBy("pattern").agg(F.avg("belief").alias("score"), F.sum("seed").alias("seeds"))
        scored = scored.where(F.col("seeds") >= seeds)
        if turn + 1 < rounds:
            told = edges.join(scored, "pattern", "left").groupBy("value").agg(F.max(edges["seed"]).alias("seed"), F.max("score").alias("best"))
            known = settle(told.select("value", F.greatest(F.col("seed").cast("double"), F.coalesce("best", F.lit(0.0))).alias("belief")))
    out = settle(scored.where(F.col("score") >= reliable))
    forget(found.sparkSession, edges, *([known] if rounds > 1 else []))
    return out


def find_pii(docs: DataFrame, *, text: str = "text", result: str = "pii", keep: list[str] | None = None, **options) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all of them) with a struct: counts by kind and all spans."""
    keep = [c for c in (keep or docs.columns) if c != result]
    scanned = settle(scan(docs, text=text).withColumn("__row", F.monotonically_increasing_id()).select(*keep, "__row", "__m"))
    found = settle(instances(scanned))
    trusted = reliable_patterns(found, **options).select("pattern")
    told = found.where("NOT seed").select("row", "start", "end", F.explode("patterns").alias("pattern"))
    told = told.join(trusted, "pattern", "left_semi").select("row", F.lit("context").alias("kind"), "start", "end").distinct()
    every = found.where("seed").select("row", "kind", "start", "end").union(told)
    rank = F.array_position(F.array(*[F.lit(k) for k in (*KINDS, "context")]), F.col("kind"))
    of = lambda k: F.count_if(F.col("kind") == k).alias(f"n_{k}")
    held = F.array_sort(F.collect_list(F.struct("start", rank.alias("rank"), "kind", "end")))
    grouped = every.groupBy(F.col("row").alias("__row")).agg(*[of(k) for k in KINDS], held.alias("__held"))
    spans = F.transform(F.coalesce("__held", F.lit([]).cast("array<struct<start:int,rank:bigint,kind:string,end:int>>")), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    counts = [F.coalesce(f"__g.n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS]
    grouped = grouped.select("__row", F.struct(*[f"n_{k}" for k in KINDS]).alias("__g"), "__held")
    return scanned.drop("__m").join(grouped, "__row", "left").withColumn(result, F.struct(*counts, spans.alias("spans"))).select(*keep, result)


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), keep=["doc_id"])
    spans = F.col("pii.spans")
    return found.select(
        "doc_id", *[F.col(f"pii.n_{k}").alias(f"n_{k}") for k in KINDS],
        F.sha2(joined(F.filter(spans, lambda s: s["kind"].isin(*KINDS))), 256).alias("base_sha256"), joined(spans).alias("spans"), F.size(spans).cast("long").alias("n_spans"),
    )


def _sql(rounds: int = ROUNDS) -> str:
    """The whole of op5 as SQL: matches, positions, the pattern graph and its turns."""
    w, b = r"[^ \t\n\x0B\f\r]", r"[ \t\n\x0B\f\r]"
    kinds = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)", "card": r"[0-9](?:[\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
        "number": r"[^ \t\n\x0B\f\r0-9]*(?:[0-9][^ \t\n\x0B\f\r0-9]*){5,}",
    }
    found = " UNION ALL ".join(f"SELECT r, '{k}' AS kind, regexp_extract_all(t, '{p}') AS m, string_split_regex(t, '{p}') AS b FROM d" for k, p in kinds.items())
    turns = ""
    for t in range(rounds):
        turns += f""", score{t} AS (
  SELECT pattern, avg(belief) AS score FROM edge JOIN known{t} USING (value) GROUP BY pattern HAVING sum(seed) >= {SEEDS}
), known{t + 1} AS (
  SELECT value, greatest(max(seed), coalesce(max(score), 0))::DOUBLE AS belief FROM edge LEFT JOIN score{t} USING (pattern) GROUP BY value
)"""
    plain = lambda x: f"lower(regexp_replace({x}, '[0-9]+', '0', 'g'))"
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), raw AS (
  SELECT r, kind, i, m[i] AS v, b[i] AS before, b[i + 1] AS after FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM ({found}))
), placed AS (
  SELECT *, sum(length(before) + length(v)) OVER (PARTITION BY r, kind ORDER BY i) AS e, regexp_replace(v, '[^0-9]', '', 'g') AS g FROM raw
), valid AS (
  SELECT r, kind, v, e - length(v) AS s, e, right(before, {TAIL}) AS tail, left(after, {TAIL}) AS head, kind <> 'number' AS seed FROM placed WHERE CASE kind
    WHEN 'ip' THEN len(list_filter(string_split(v, '.'), lambda x: coalesce(TRY_CAST(x AS HUGEINT), 256) > 255)) = 0
    WHEN 'card' THEN length(g) BETWEEN 12 AND 19 AND list_sum(list_transform(range(1, length(g) + 1), lambda k: CASE WHEN k % 2 = 1 THEN g[-k]::INT WHEN g[-k]::INT > 4 THEN 2 * g[-k]::INT - 9 ELSE 2 * g[-k]::INT END)) % 10 = 0
    WHEN 'phone' THEN length(g) BETWEEN 9 AND 15 ELSE TRUE END
), cored AS (
  SELECT * REPLACE (CASE WHEN seed THEN v ELSE regexp_replace(regexp_replace(v, '^[^0-9A-Za-z+]+', ''), '[^0-9A-Za-z]+$', '') END AS v, CASE WHEN seed THEN s ELSE s + length(regexp_extract(v, '^[^0-9A-Za-z+]*')) END AS s,
    CASE WHEN seed THEN regexp_replace(tail, '{w}+$', '') ELSE tail END AS tail, CASE WHEN seed THEN regexp_replace(head, '^{w}+', '') ELSE head END AS head) FROM valid
), told AS (
  SELECT r, kind, v, s, s + length(v) AS e, seed, tail, head FROM cored
), near AS (
  SELECT *, coalesce(max(CASE WHEN seed THEN e END) OVER (PARTITION BY r ORDER BY s, seed DESC, e DESC, kind ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) > s, FALSE) AS inside,
    coalesce(min(CASE WHEN seed THEN s END) OVER (PARTITION BY r ORDER BY s, seed DESC, e DESC, kind ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) < e, FALSE) AS cut FROM told
), cued AS (
  SELECT r, kind, v, s, e, seed, inside, regexp_extract(tail, '({w}{{1,40}}{b}+{w}{{1,40}}){b}+$', 1) AS before, regexp_extract(tail, '({w}{{1,40}}[:=#]){b}+$', 1) AS label, regexp_extract(tail, '({w}{{1,40}}){b}+$', 1) AS last,
    regexp_extract(head, '^{b}+({w}{{1,40}}{b}+{w}{{1,40}})', 1) AS after, regexp_extract(head, '^{b}+({w}{{1,40}})', 1) AS following FROM near WHERE seed OR NOT (inside OR cut)
), instance AS (
  SELECT r, kind, s, e, v, seed, CASE WHEN inside THEN [] ELSE list_distinct(list_filter([
    CASE WHEN before <> '' THEN {plain("before || ' _'")} END, CASE WHEN label <> '' THEN {plain("label || ' _'")} END, CASE WHEN after <> '' THEN {plain("'_ ' || after")} END,
    CASE WHEN last <> '' AND following <> '' THEN {plain("last || ' _ ' || following")} END], lambda x: x IS NOT NULL)) END AS patterns FROM cued
), edge AS (
  SELECT pattern, value, max(seed) AS seed FROM (SELECT unnest(patterns) AS pattern, v AS value, seed::INT AS seed FROM instance) GROUP BY pattern, value
), known0 AS (
  SELECT value, max(seed)::DOUBLE AS belief FROM edge GROUP BY value
){turns}, span AS (
  SELECT r, kind, s, e FROM instance WHERE seed
  UNION ALL SELECT DISTINCT r, 'context', s, e FROM (SELECT r, s, e, unnest(patterns) AS pattern FROM instance WHERE NOT seed) JOIN score{rounds - 1} USING (pattern) WHERE score >= {RELIABLE}
), held AS (
  SELECT r, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip, count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone, count(*) AS n_spans,
    string_agg(kind || ':' || s::BIGINT || ':' || e::BIGINT, ',' ORDER BY s, k, e) AS spans, string_agg(kind || ':' || s::BIGINT || ':' || e::BIGINT, ',' ORDER BY s, k, e) FILTER (kind <> 'context') AS base
  FROM (SELECT *, list_position(['email', 'ip', 'card', 'phone', 'context'], kind) AS k FROM span) GROUP BY r
)
SELECT doc_id, coalesce(n_email, 0)::BIGINT AS n_email, coalesce(n_ip, 0)::BIGINT AS n_ip, coalesce(n_card, 0)::BIGINT AS n_card, coalesce(n_phone, 0)::BIGINT AS n_phone, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans, coalesce(n_spans, 0)::BIGINT AS n_spans FROM d LEFT JOIN held USING (r)
"""


OP5_SQL = _sql()
