from collections import Counter

from kinfold.llm import mix as m


def test_small_sources_reach_their_targets(spark):
    rows = [(i, " ".join(["w"] * 400), "big") for i in range(100)] + [(1000 + i, " ".join(["w"] * (3 + 7 * i)), f"tiny{i:02d}") for i in range(40)]
    taken, target = Counter(), {}
    for r in m.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect():
        assert all(p <= r.size for p in r.passes)
        taken[r.source] += sum(r.passes)
        target[r.source] = r.target
    assert len(target) == 41
    for source, t in target.items():
        assert t - 1 < taken[source] <= t, source


def test_far_branch(spark, monkeypatch):
    """Sources and cells joined instead of broadcast give the same mix."""
    rows = [(i, " ".join(["w"] * (5 + i % 60)), f"s{i % 7}" if i % 9 else None) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    near = sorted(map(str, m.mix(docs).collect()))
    monkeypatch.setattr(m, "GRID_BROADCAST", 0)
    assert sorted(map(str, m.mix(docs).collect())) == near
