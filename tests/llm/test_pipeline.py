import re
from collections import Counter

import corpus_pipeline as c
from kinfold.llm import decontaminate, jaccard, mix, quality

from .cases import SCHEMA, documents, with_ids
from .test_quality import plain


def test_against_brute_force(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    out = c.run(spark, sf).collect()

    def good(t):
        n, chars, symbols, dup, repeat = plain(t)
        lines = [x for x in t.split("\n") if x.strip()]
        digits = len(re.findall("[0-9]", t))
        return not (n < 50 or 100 * repeat > 50 * n or 10 * symbols > n or 100 * dup > 40 * len(lines) or not 2 * n <= chars <= 15 * n or 100 * digits > 30 * chars)

    rows = [d for d in docs if good(d[1])]
    first = {d: x for d, _, x in jaccard.brute_force([(d[0], d[1]) for d in rows])}
    rows = [d for d in rows if first[d[0]] == d[0]]
    bad = {r[0] for r in decontaminate.brute_force([(d[0], d[1]) for d in rows], items) if r[5]}
    rows = [d for d in rows if d[0] not in bad]
    plan = mix.mix(spark.createDataFrame(rows, SCHEMA)).collect()
    want = Counter()
    for r in plan:
        want[r.id] += sum(1 for p in r.passes if p)
    assert Counter(r.doc_id for r in out) == +want
    held, slots = Counter(), {}
    for r in out:
        held[r.shard] += len(r.text.encode()) + 1
        slots.setdefault(r.shard, []).append(r.slot)
    mean = sum(held.values()) / len(held)
    assert len(held) == c.SHARDS and all(abs(v - mean) <= 0.2 * mean for v in held.values())
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_stages_bear_odd_rows(spark):
    docs = spark.createDataFrame(documents(), SCHEMA)
    empty = docs.limit(0)
    for name, stage in c.STAGES:
        for df in (docs, empty):
            out = stage(spark, df, "/root/testdata/sf0.001")
            assert name == c.STAGES[-1][0] or out.columns == docs.columns
            assert out.count() <= 2 * df.count()


def test_odd_rows_stage_by_stage(spark):
    """Which rows stay, by plain versions of the first three stages, with nulls and repeated rows."""
    rows = documents()
    docs = spark.createDataFrame(rows, SCHEMA)
    stages = dict(c.STAGES)
    good = [tuple(r) for r in stages["quality rules"](spark, docs, "").collect()]
    texts = Counter(r[:2] for r in good)
    assert texts == Counter(r[:2] for r in rows if r[:2] in texts) and all(len((r[1] or "").split()) >= 50 for r in good)
    kept = [tuple(r) for r in stages["n-gram Jaccard join"](spark, docs, "").collect()]
    first = {d: x for d, _, x in jaccard.brute_force([(r[0], r[1]) for r in with_ids(rows)])}
    assert {r[0] for r in kept if r[0] is not None} == {d for d, x in first.items() if d == x}
    clean = stages["benchmark decontamination"](spark, docs, "/root/testdata/sf0.001").collect()
    assert Counter(r.doc_id for r in clean) == Counter(r[0] for r in rows)


def test_the_filter_stays_above_the_ledger(spark):
    """Every rule measures a text once: the plan has one projection of the ledger below the filter."""
    docs = spark.createDataFrame(documents(), SCHEMA)
    plan = quality.keep_good(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp") <= 2 * plan.count("Project") and plan.index("Filter") < plan.index("monotonically_increasing_id")
