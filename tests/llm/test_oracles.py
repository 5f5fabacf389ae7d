"""The operators' SQL beside their queries, on the driver's tables and on planted documents."""

import duckdb
import pytest

from kinfold.llm.queries import ORACLE_SQL, QUERIES

from .cases import SCHEMA, documents, with_ids
from .test_pii import TEXTS
from .test_pii_seeds import SEEDS


def held(con, spark, name, sf):
    for t in ("documents", "benchmark"):
        path = f"{sf}/{t}.parquet"
        con.execute(f"CREATE OR REPLACE VIEW {t} AS FROM read_parquet('{path}{'/*.parquet' if t == 'documents' and 'testdata' not in sf else ''}')")
    got, want = QUERIES[name](spark, sf), con.execute(ORACLE_SQL[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(got.columns)
    rows = sorted(tuple(r[c] for c in columns) for r in got.collect())
    assert rows == sorted(want.fetchall())
    return [dict(zip(columns, r)) for r in rows]


@pytest.mark.parametrize("name", ["op1_decontaminate", "op2_repeats", "op3_jaccard", "op5_pii"])
def test_driver_tables(spark, name):
    assert held(duckdb.connect(), spark, name, "/root/testdata/sf0.001")


def test_planted_patterns(spark, tmp_path):
    """The pattern graph learns cues before, after and around spans; SQL learns the same."""
    texts = [t for _, t, *_ in with_ids(documents())] + [t for t in TEXTS if len(t) < 5000]
    for cue, values in SEEDS.values():
        texts += [f"some words, {cue} {v} and more" for v in values] + [f"other words, {cue} 77-1234567, thanks"]
    texts += [f"row {i}: 10.0.{i}.7 is the gateway address" for i in range(9)] + ["row 9: 7777-888 is the gateway address", "node 5551212 here", "a 10.0.0.1 b 99999 c"]
    docs = spark.createDataFrame([(i, t, "en", "src0", 1) for i, t in enumerate(texts)], SCHEMA)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "x")], "item_id long, text string").coalesce(1).toPandas().to_parquet(f"{tmp_path}/benchmark.parquet")
    rows = held(duckdb.connect(), spark, "op5_pii", str(tmp_path))
    assert sum("context" in r["spans"] for r in rows) >= 4
