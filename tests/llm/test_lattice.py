import math

import numpy as np
import pytest

from kinfold.llm import lattice as q

from .cases import SCHEMA, documents


def test_forward_and_expected_counts():
    pieces, logp = q.read_vocabulary()
    assert abs(np.logaddexp.reduce(logp)) < 1e-9
    p, lattice = dict(zip(pieces, logp)), q.Lattice(pieces, logp)

    def slow(w):
        t = q.MARK + w
        a = [0.0] + [-math.inf] * len(t)
        for j in range(1, len(t) + 1):
            for i in range(j):
                if t[i:j] in p:
                    a[j] = np.logaddexp(a[j], a[i] + p[t[i:j]])
        return a[-1]

    words = [b"hello", b"hello", "größe".encode(), b"x" * 70, "😀a".encode(), b"the" * 30]
    out, expected = lattice.run(words, np.ones(len(words)))
    assert np.allclose(out, [slow(w) for w in words])
    # expected pieces spell the words: their bytes add up
    spelled = sum(n * len(x) for n, x in zip(expected, pieces))
    assert abs(spelled - sum(len(w) + len(q.MARK) for w in words)) < 1e-6


@pytest.mark.parametrize("head", [q.HEAD, 20, 0])
def test_base_model(spark, head):
    rows = documents()
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("lm", q.F.lit(1))
    got = q.score(docs, held_out=q.is_held_out(q.F.col("doc_id")), head=head).select("doc_id", "lm.*").collect()
    want = q.brute_force_base([(r[0], r[1]) for r in rows])
    key = lambda x: tuple(str(v) for v in x[:4])
    for g, w in zip(sorted(map(tuple, got), key=key), sorted(want, key=key)):
        assert g[:5] == w[:5] and abs(g[5] - w[5]) < 1e-6 and g[6] < 0


def test_fit_raises_held_out_likelihood(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    held = q.is_held_out(q.F.col("doc_id"))
    total = lambda out: out.selectExpr("sum(if(lm.held_out, lm.score, 0))").first()[0]
    assert total(q.score(docs, held_out=held)) > total(q.score(docs, held_out=q.F.lit(True)).withColumn("lm", q.F.struct(held.alias("held_out"), q.F.col("lm.score").alias("score"))))


def test_empty_table(spark):
    assert q.score(spark.createDataFrame([], SCHEMA), held_out=q.is_held_out(q.F.col("doc_id"))).collect() == []
