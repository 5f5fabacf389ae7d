import re
from collections import Counter

import duckdb

from kinfold.llm import quality as q

from .cases import SCHEMA, documents


def plain(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    many = {g for g, n in Counter(grams).items() if n > 1}
    hit = {i + k for i, g in enumerate(grams) if g in many for k in range(3)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit)


def test_measures(spark):
    texts = [t for _, t, *_ in documents()] + ["a b c a b c a b c", "# * | a\n\n b\nb\n b", "a b a b a b a", "q\x85w　e r t"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("ledger", q.F.lit(1)).withColumn("n_words", q.F.lit("x"))
    for r in q.ledger(docs).collect():
        x = r.ledger
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) == plain(texts[r.doc_id]), texts[r.doc_id]
        assert bool(x.failed & q.mask("base-1")) == (x.n_words < 50 or 100 * x.n_repeat_words > 50 * x.n_words)


def test_ablations(spark):
    docs = spark.createDataFrame([(1, "word " * 9), (2, " ".join(map(str, range(1000, 1100)))), (3, None)], "doc_id long, text string")
    got = {r.rule: r for r in q.ablations(q.ledger(docs)).collect()}
    assert got["few_words"].failed == 2 and got["few_words"].only_this == 1 and got["digits"].only_this == 1 and got["digits"].documents == 3
    assert [r.doc_id for r in q.keep_good(docs, policy="base-1").collect()] == [2]


def test_oracle(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS FROM '{sf}/documents.parquet'")
    assert sorted(map(tuple, q.op7_quality(spark, sf).collect())) == sorted(con.execute(q.OP7_SQL).fetchall())


def test_clean_documents_stay(spark):
    sf = "/root/testdata/sf0.01"
    both = q.op7_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    assert both.where("quality = 1 AND NOT kept AND NOT base_failed").count() == 0
    assert both.where("quality = 0 AND kept").count() == 0


def test_empty_table(spark):
    assert q.ledger(spark.createDataFrame([], SCHEMA)).collect() == []
