"""Pairs and lists made between classes of records, and features of whole chunks, against plain ones."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from kinfold.functions import crossing, text
from kinfold.operators import blocking, features
from kinfold.plans import queries as q
from kinfold.plans.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
KEYS = "entity_id string, country string, kind string, key string"


@pytest.fixture(scope="module")
def keyed(spark):
    """Keys of all, of a few and of one record, on one side and on both."""
    rng = random.Random(5)
    one = lambda p: [(f"{p}{i}", c, k, v) for i in range(80) for c in [rng.choice(["US", "India", ""])] for k, v in [("A", str(i % 3)), ("B", str(rng.randrange(30))), ("C", f"{p[0:2] if i % 2 else ''}{i}")]]
    a, b = one("S1-"), one("S2-")
    return a, b, {(x[0], y[0]) for x in a for y in b if x[2:] == y[2:] and (not x[1] or not y[1] or x[1] == y[1])}


def test_light_keys_do_not_part_classes(spark, keyed):
    a, b, want = keyed
    got = blocking.split_pairs(spark.createDataFrame(a, KEYS), spark.createDataFrame(b, KEYS)).collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_lists_of_classes(spark, keyed):
    a, b, want = keyed
    s1 = spark.createDataFrame([(f"S1-{i}",) for i in range(81)], "entity_id string")
    got = blocking.key_lists(spark.createDataFrame(a, KEYS), spark.createDataFrame(b, KEYS), s1).collect()
    assert {r.source1_entity_id: r.candidate_entity_ids for r in got} == {f"S1-{i}": sorted(y for x, y in want if x == f"S1-{i}") for i in range(81)}
    assert all(r.num_candidates == len(r.candidate_entity_ids) for r in got)


def agrees(spark, sf: str, name: str) -> None:
    con = duckdb.connect()
    for t in ("customer", "nation", "region", "documents"):
        con.execute(f"CREATE VIEW {t} AS FROM '{sf}/{t}.parquet'")
    want = con.execute(ORACLE_SQL[name])
    columns = [d[0] for d in want.description]
    got = [tuple(r[c] for c in columns) for r in QUERIES[name](spark, sf).collect()]
    assert got and sorted(map(str, got)) == sorted(map(str, want.fetchall()))


@pytest.mark.parametrize("name", ["addressed_candidates", "addressed_code_pairs", "addressed_features"])
def test_addressed_as_in_the_sql(spark, name):
    agrees(spark, SF, name)


def test_no_row_for_each_pair(spark):
    """Lists are gathered from arrays: no pair of records is a row."""
    plan = QUERIES["addressed_candidates"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_set(candidate_entity_id" not in plan


def test_edits_of_names():
    rng = random.Random(1)

    def plain(a, b):
        line = [*range(len(b) + 1)]
        for i, x in enumerate(a, 1):
            before, line = line, [i]
            for j, y in enumerate(b, 1):
                line.append(min(before[j] + 1, line[-1] + 1, before[j - 1] + (x != y)))
        return line[-1]

    for _ in range(2000):
        a, b = ("".join(rng.choice("abcé") for _ in range(rng.randrange(70))) for _ in range(2))
        assert crossing.levenshtein(a, b) == plain(a, b)


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """Equal and near names, with and without a country, empty addresses, parts of addresses, long texts in many words."""
    rng = random.Random(3)
    texts = [f"Alpha beta {n} {m} house no {i % 4}b main street, unit {i % 3}, po box {i % 5}, colorado {12345 + i % 2} " + " ".join(f"w{rng.randrange(9000)}" for _ in range(i * 13)) for i in range(40) for n, m in [(rng.choice(["gamma", "Gamma", "gamme"]), rng.choice(["ltd", "delta", "éta"]))]]
    texts += ["alpha beta", "alpha  beta gamma", "alpha", "", None, texts[0], texts[1], "omega psi chi phi 12 main road", "omega psi chi phi"]
    rows = [(i, t, rng.choice(["US", "India", "", None]), f"src{side}") for i, (t, side) in enumerate((t, s) for t in texts for s in (1, 7))]
    path = str(tmp_path_factory.mktemp("odd"))
    rows = [(i, t, lang, source, len(t or "")) for i, t, lang, source in rows]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"{path}/documents.parquet")
    return path


def test_pair_features_of_chunks(spark, odd):
    done = q.processed(spark, odd)
    a, b = q.sides(done)
    l, r = (q._keyed(x.withColumn("k", F.array_join(F.slice(text.tokens(F.col("name_clean")), 1, 2), " ")), ("HEAD", F.col("k"))) for x in (a, b))
    labelled = features.label(blocking.row_pairs(l, r, True), q.truth(spark, odd))
    plain = features.pair_features(features.hydrate(labelled, a, b), features.Tfidf.fit(a))
    got = QUERIES["pair_features"](spark, odd)
    assert got.columns == plain.columns and got.dtypes == plain.dtypes
    want = {(x[0], x[1]): x for x in plain.collect()}
    rows = got.collect()
    assert len(rows) == len(want) > 1000 and {x.label for x in rows} == {0, 1}
    for x in rows:
        y = want[x[0], x[1]]
        assert x[2:4] == y[2:4] and [*x[4:]] == pytest.approx([*y[4:]], abs=1e-12), (x, y)
    assert "levenshtein(name_clean_1" not in got._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["addr_token_jaccard", "apply_threshold", "best_threshold", "pair_metrics", "singleton_features", "threshold_grid"])
@pytest.mark.parametrize("whole", ["", "_whole"])
def test_addresses_of_chunks_as_in_the_sql(spark, odd, name, whole):
    """Empty addresses, and more words than a block of a matrix has."""
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS FROM '{odd}/documents.parquet/*.parquet'")
    want = con.execute(ORACLE_SQL[name + whole])
    columns = [d[0] for d in want.description]
    got = QUERIES[name + whole](spark, odd)
    assert sorted(map(str, (tuple(r[c] for c in columns) for r in got.collect()))) == sorted(map(str, want.fetchall()))
    assert "array_intersect" not in got._jdf.queryExecution().optimizedPlan().toString() or name == "singleton_features"
