import random
import re
import zlib
from collections import Counter

import pytest

from kinfold.llm import mix as m
from kinfold.llm import shard as s

from .cases import SCHEMA, documents


def waterfill(sizes, weights=(3, 1, 2), share=1.5, repeat=2):
    names = sorted(sizes, key=lambda x: (x is None, (x or "").encode()))
    w = {n: weights[i % 3] for i, n in enumerate(names)}
    target, open_, left = {}, list(names), share * sum(sizes.values())
    while open_:
        level = left / sum(w[n] for n in open_)
        over = [n for n in open_ if level * w[n] > repeat * sizes[n]]
        if not over:
            return target | {n: level * w[n] for n in open_}
        for n in over:
            target[n] = repeat * sizes[n]
            left -= target[n]
            open_.remove(n)
    return target


def size(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def test_mix(spark):
    rows = documents()
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("target", m.F.lit("clash"))
    got = m.mix(docs).collect()
    assert len(got) == len(rows)
    assert Counter((r.id, r.size) for r in got) == Counter((d, size(t)) for d, t, *_ in rows)
    sizes = Counter()
    for _, t, _, src, _ in rows:
        sizes[src] += size(t)
    want = waterfill(sizes)
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
        assert sum(r.passes) <= 2 * r.size and all(p <= r.size for p in r.passes)
        taken[r.source] += sum(r.passes)
    for name, t in want.items():
        assert t - 2 * m.BLOCK <= taken[name] <= t
    again = m.mix(docs).collect()
    assert Counter(map(str, got)) == Counter(map(str, again))


def test_mixed_documents(spark):
    docs = spark.createDataFrame(documents(), SCHEMA)
    out = m.mixed(docs)
    assert out.columns == docs.columns
    have = Counter()
    for r in out.collect():
        have[r.source] += size(r.text)
    want = Counter()
    for r in m.mix(docs).collect():
        want[r.source] += sum(r.passes)
    assert +have == +want
    assert m.mix(docs.limit(0)).collect() == [] and m.mixed(docs.limit(0)).collect() == []


def test_schedule_spreads(spark):
    goal = spark.createDataFrame([(0, 3000.0), (1, 1000.0), (2, 0.0)], "source_no int, target double")
    rows = sorted(m.schedule(goal, block=10).collect())
    for n in (40, 200, 400):
        part = [r for r in rows if r.slot < n]
        assert abs(sum(r.source_no == 0 for r in part) - 0.75 * n) <= 3
    for no, t in ((0, 3000), (1, 1000)):
        own = [r for r in rows if r.source_no == no]
        assert [r.block for r in own] == list(range(len(own))) and sum(r.words for r in own) == t


def test_shard(spark):
    rows = documents()
    hot = [(1000 + i, "a third of all rows is this", "en", "src0", 27) for i in range(len(rows) // 2)]
    docs = spark.createDataFrame(rows + hot, SCHEMA).withColumn("slot", m.F.lit("clash"))
    out = s.shard(docs, 4, key=s.text_key(), size=s.text_size()).collect()
    assert Counter((r.doc_id, r.text) for r in out) == Counter((r[0], r[1]) for r in rows + hot)
    slots = {}
    for r in out:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and set(slots) <= set(range(4))
    empty = s.shard(docs.limit(0), 4, key=s.text_key(), size=s.text_size())
    assert empty.collect() == [] and "shard" in empty.columns


def test_shards_are_even(spark):
    got = s.op9_shard(spark, "/root/testdata/sf0.01").collect()
    held = Counter()
    for r in got:
        held[r.shard] += r.size
    mean = sum(held.values()) / 8
    assert len(held) == 8 and all(abs(v - mean) < 0.05 * mean for v in held.values())
    together = {}
    for r in got:
        together.setdefault((r.text_crc32, r.size), set()).add(r.shard)
    assert all(len(v) == 1 for v in together.values())


@pytest.mark.parametrize("part_bytes", [s.PART_BYTES, 400])
def test_law_of_bytes(spark, tmp_path, monkeypatch, part_bytes):
    """Every column of op9 against plain Python: sizes, checksums, gapless slots, even shards, whole groups."""
    monkeypatch.setattr(s, "PART_BYTES", part_bytes)
    rng = random.Random(3)
    rows = documents() + [(2000 + i, "hot text " * 9, "en", "src0", 1) for i in range(300)] + [(3000 + i, f"{rng.random()} " * rng.randint(1, 30), "en", "src1", 1) for i in range(700)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = s.op9_shard(spark, str(tmp_path)).collect()
    plain = lambda t: (len((t or "").encode()) + 1, zlib.crc32((t or "").encode()))
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter((d, *plain(t)) for d, t, *_ in rows)
    assert {(r.law, r.grown_shard) for r in got} == {("bytes", None)}
    slots, held, together = {}, Counter(), {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
        held[r.shard] += r["size"]
        together.setdefault((r.text_crc32, r["size"]), Counter())[r.shard] += r["size"]
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and set(slots) == set(range(8))
    total = sum(held.values())
    longest = max(plain(t)[0] for _, t, *_ in rows)
    assert all(abs(v - total / 8) < 0.04 * total / 8 + longest for v in held.values())
    assert all(len(c) == 1 for c in together.values() if sum(c.values()) <= total / 8 / 32)


def test_sources_come_near_their_targets(spark):
    """300 sources of fewer than 100 words beside a large one: all within a tenth of their targets."""
    rows = [(i, " ".join(["w"] * 900), "big") for i in range(300)] + [(1000 + i, " ".join(["w"] * (1 + i % 99)), f"s{i:03d}") for i in range(300)]
    taken, target = Counter(), {}
    for r in m.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect():
        taken[r.source] += sum(r.passes)
        target[r.source] = r.target
    assert len(target) == 301 and all(0.9 * t <= taken[x] + 1 and taken[x] <= t for x, t in target.items())
