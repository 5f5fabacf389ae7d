import random

import numpy as np
import pytest

from kinfold.llm import repeats as r

from .cases import SCHEMA, documents, with_ids


def rows(spark, docs, **options):
    found = r.find_repeats(docs, **options)
    out = found.select("doc_id", r.F.coalesce(r.F.octet_length("text"), r.F.lit(0)), "repeats.n_removed", "repeats.n_spans", "repeats.kept_sha256")
    return sorted(map(tuple, out.collect()), key=str)


@pytest.mark.parametrize("options", [{}, {"split": 2}, {"shard": 2}, {"shard": 5, "split": 3}])
def test_brute_force(spark, options):
    data = documents()
    docs = spark.createDataFrame(data, SCHEMA).withColumn("repeats", r.F.lit(0))
    assert rows(spark, docs, **options) == sorted(r.brute_force([(d, t) for d, t, *_ in data]), key=str)


def test_empty_and_removal(spark):
    assert rows(spark, spark.createDataFrame([], SCHEMA)) == []
    passage = "ü" * 150
    docs = spark.createDataFrame([(1, "a" + passage + "b"), (2, "cc" + passage), (3, None), (4, "short")], "doc_id long, text string")
    assert {x.doc_id: x.text for x in r.remove_repeats(docs).collect()} == {1: "ab", 2: "cc", 3: None, 4: "short"}


def some_contexts(rng):
    """Rows of all columns that agree here and there, in blocks."""
    base = np.frombuffer(bytes(rng.choice(b"ab") for _ in range(r.WIDTH)), np.uint8)
    text = np.stack([base] * 120)
    for k in range(20, 120):
        for _ in range(rng.randint(0, 3)):
            text[k, rng.randrange(r.WIDTH)] = rng.choice(b"abc")
    return np.array(sorted(rng.randrange(3) for _ in text)), text


def test_transform_and_interleave():
    block, text = some_contexts(random.Random(2))
    starts = [r.LEFT + 8 * k for k in reversed(range(r.WORDS))] + list(reversed(range(r.LEFT)))
    for size in (7, 40, 1000):
        shard = np.arange(len(block)) % -(-len(block) // size)
        parts = []
        for k in range(shard.max() + 1):
            symbols, orders = r.transform(block[shard == k], text[shard == k])
            parts.append(symbols)
            rows, own = text[shard == k], block[shard == k]
            assert [(own[i], rows[i].tobytes()) for i in orders[-1]] == sorted((b, t.tobytes()) for b, t in zip(own, rows))
        first = np.lexsort((shard, block))
        flat = np.argsort(shard, kind="stable")  # suffixes by shard, as parts give them
        begin = np.argsort(block[flat], kind="stable")
        assert (flat[begin] == first).all()
        steps = (np.concatenate([p[k] for p in parts]) for k in range(len(starts)))
        for c, (order, common) in zip(starts, r.interleave(shard[flat][begin], block[flat][begin], steps)):
            if c % 29 and c != r.LEFT:
                continue
            who = flat[begin][order]
            keys = [(block[i], text[i, c:].tobytes()) for i in who]
            assert keys == sorted(keys)
            for (b0, x), (b1, y), n in zip(keys, keys[1:], common[1:].tolist()):
                assert n == (next((i for i in range(len(x)) if x[i] != y[i]), len(x)) if b0 == b1 else 0)


def test_nothing_goes_without_the_merge(spark, monkeypatch):
    """Several shards at sf0.01, and no removal that doesn't come from their interleave."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    shards, settle = [], r.settle

    def counted(df, **options):
        table = settle(df, **options)
        shards.extend(table.where("kind = 1").select("key").collect() if "key" in df.columns else [])
        return table

    monkeypatch.setattr(r, "settle", counted)
    table = docs.selectExpr("monotonically_increasing_id() AS __row", "text")
    want = {d: n for d, _, n, _, _ in r.brute_force([tuple(x) for x in docs.collect()])}
    got = {x.doc_id: x.repeats.n_removed for x in r.find_repeats(docs, shard=400).collect()}
    assert got == want and sum(want.values()) > 0 and len(set(shards)) > 2
    monkeypatch.setattr(r, "_merge", _merge_without)
    assert r.repeated_starts(table, shard=400).collect() == []


def _merge_without(table):
    import pyarrow as pa

    return pa.table({"key": pa.array([], pa.int64()), "kind": pa.array([], pa.int32()), "data": pa.array([], pa.binary())})


def test_far_branches(spark, monkeypatch):
    monkeypatch.setattr(r, "BROADCAST_BYTES", -1)
    data = documents()
    assert rows(spark, spark.createDataFrame(data, SCHEMA)) == sorted(r.brute_force([(d, t) for d, t, *_ in data]), key=str)


def test_driver_tables(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(x) for x in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, r.op2_repeats(spark, sf).collect())) == sorted(r.brute_force(docs))
