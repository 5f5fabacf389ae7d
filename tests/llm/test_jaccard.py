import random

import numpy as np
import pytest

from kinfold.llm import jaccard as j
from kinfold.llm.components import components

from .cases import SCHEMA, documents, with_ids


def pairs(rows):
    return [(r[0], r[1]) for r in rows]


@pytest.mark.parametrize("group", [1500, 3])
def test_brute_force(spark, monkeypatch, group):
    monkeypatch.setattr(j, "GROUP", group)
    monkeypatch.setattr(j, "PART", group)
    rows = with_ids(documents())
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("component_id", j.F.lit("clash"))
    got = sorted(map(tuple, j.similar(docs).collect()))
    assert got == sorted(j.brute_force(pairs(rows)))
    assert any(a != c for a, _, c in got)


def test_null_and_repeated_ids(spark):
    docs = spark.createDataFrame(documents(), SCHEMA)
    got = [tuple(r) for r in j.similar(docs).collect()]
    assert len(got) == len(documents())
    assert all(c is not None for i, n, c in got if n and i is not None)
    assert j.similar(docs.limit(0)).collect() == []


def test_keep_one(spark):
    rows = documents()
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = j.keep_one(docs)
    assert kept.columns == docs.columns
    named = with_ids(rows)
    left = {r.doc_id for r in kept.collect()}
    classes = {d: c for d, _, c in j.brute_force(pairs(named))}
    assert {c for c in classes.values()} - left <= {classes[next(r[0] for r in named if r[1] == rows[-2][1])]}
    assert len([r for r in kept.collect() if r.doc_id == rows[14][0]]) <= 1


def test_overlaps_from_a_similar_set():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 300, 120)).astype(np.uint64) for _ in range(20)]
    g = j.Group(sets)
    first = g.overlaps(0)
    for k in range(20):
        want = [len(np.intersect1d(sets[k], s)) for s in sets]
        assert g.overlaps(k).tolist() == want and g.overlaps(k, (0, first)).tolist() == want


def test_components(spark):
    edges = [(i, i + 1) for i in range(40) if i != 17] + [(100, k) for k in range(101, 130)] + [(5, 5)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {i: 0 if i <= 17 else 18 for i in range(41)} | {i: 100 for i in range(100, 130)}


def test_driver_tables(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, j.op3_jaccard(spark, sf).collect())) == sorted(j.brute_force(docs))


def test_blocks_are_skipped():
    rng = np.random.default_rng(7)
    e = np.empty(4000, j.ENTRY)
    e["key"], e["text"], e["n"] = rng.integers(0, 9, 4000), np.arange(4000), rng.integers(1, 60, 4000)
    e["at"] = rng.integers(0, 30, 4000)
    e, band = j._banded(e)
    stay, blocks, skipped = j._skip(e, band)
    least = {}
    for k, b, n in zip(e["key"].tolist(), band.tolist(), e["n"].tolist()):
        least[k, b] = min(n, least.get((k, b), n))
    n, at = e["n"].astype(int), e["at"].astype(int)
    low = np.array([least[k] for k in zip(e["key"].tolist(), band.tolist())])
    assert stay.tolist() == np.flatnonzero((j.NUM + j.DEN) * (n - at) - j.NUM * n >= j.NUM * low).tolist()
    assert 0 < skipped < blocks < len(e)


def test_hot_lists(spark, monkeypatch):
    monkeypatch.setattr(j, "BUCKET_BYTES", 64)
    monkeypatch.setattr(j, "HOT_LIST", 3)
    seen = []
    heavy = j._heavy

    def counted(index):
        cool, hot = heavy(index)
        seen.append(hot.count() if hot is not None else 0)
        return cool, hot

    monkeypatch.setattr(j, "_heavy", counted)
    rng = random.Random(1)
    base = [f"w{i}" for i in range(90)]
    near = [" ".join(w if rng.random() > 0.01 else f"x{rng.random()}" for w in base) for _ in range(60)]
    rows = with_ids(documents()) + [(5000 + i, t, "en", "src0", 1) for i, t in enumerate(near)]
    got = sorted(map(tuple, j.similar(spark.createDataFrame(rows, SCHEMA).coalesce(1)).collect()))
    assert got == sorted(j.brute_force(pairs(rows))) and seen[0] > 60


def test_far_branches(spark, monkeypatch):
    monkeypatch.setattr(j, "BROADCAST_ROWS", 0)
    rows = with_ids(documents())
    docs = spark.createDataFrame(rows, SCHEMA)
    want = sorted(j.brute_force(pairs(rows)))
    assert sorted(map(tuple, j.similar(docs).collect())) == want
    assert sorted(r.doc_id for r in j.keep_one(docs).collect()) == sorted(d for d, _, c in want if d == c)
