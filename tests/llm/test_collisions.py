"""Words and texts that blind a polynomial hash: a Thue-Morse word and its complement."""

import random

import numpy as np
import pytest

from kinfold.llm import decontaminate as d
from kinfold.llm import jaccard as j
from kinfold.llm import lattice as q
from kinfold.llm import textscan as ts

SIZES = (512, 1024, 2048, 4096)


def pair(n: int) -> tuple[str, str]:
    a = "".join("ab"[i.bit_count() & 1] for i in range(n))
    return a, a.translate(str.maketrans("ab", "ba"))


def texts() -> list[tuple]:
    rng = random.Random(2)
    out = []
    for n in SIZES:
        a, b = pair(n)
        fill = [rng.choice("cdefgh") * rng.randint(1, 5) for _ in range(9)]
        out += [a, b, a.upper(), f"{a} {b}", f"{b} {a}", " ".join([*fill, a]), " ".join([*fill, b])]
    return [(i, t) for i, t in enumerate(out)]


def test_runs():
    for n in SIZES:
        data = np.frombuffer("".join(pair(n)).encode(), np.uint8)
        for seed in (0, 1):
            h = ts.hash_runs(data, np.array([0, n, 0]), np.array([n, 2 * n, n]), seed)
            assert h[0] != h[1] and h[0] == h[2]


def test_jaccard(spark):
    docs = spark.createDataFrame(texts(), "doc_id long, text string")
    assert sorted(map(tuple, j.similar(docs).collect())) == sorted(j.brute_force(texts()))


def test_shared_names_are_told_apart(spark, monkeypatch):
    from .cases import SCHEMA, documents, with_ids

    rows = with_ids(documents())
    monkeypatch.setattr(j, "name", lambda t: j.F.coalesce(j.F.length(t), j.F.lit(7)).cast("long") % 50)
    got = sorted(map(tuple, j.similar(spark.createDataFrame(rows, SCHEMA)).collect()))
    assert got == sorted(j.brute_force([(r[0], r[1]) for r in rows]))


@pytest.mark.parametrize("head", [q.HEAD, 0])
def test_lattice(spark, head):
    docs = spark.createDataFrame(texts(), "doc_id long, text string")
    got = q.score(docs, held_out=q.is_held_out(q.F.col("doc_id")), head=head).select("doc_id", "lm.*").collect()
    for g, w in zip(sorted(map(tuple, got)), sorted(q.brute_force_base(texts()))):
        assert g[:5] == w[:5] and abs(g[5] - w[5]) < 1e-6


def test_decontamination(spark):
    items = [(k, pair(n)[0]) for k, n in enumerate(SIZES)]
    found = d.find_contamination(spark.createDataFrame(texts(), "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    got = {r.doc_id: (r.contamination.n_hit, len(r.contamination["items"])) for r in found.collect()}
    assert got == {r[0]: (r[2], r[3]) for r in d.brute_force(texts(), items)}
