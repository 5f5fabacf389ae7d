import duckdb
import pytest

from kinfold.llm import decontaminate as d

DOCS = [
    (1, "A b c d e f g h i j k l m, n O p"), (2, None), (3, ""), (4, "x " * 500 + "short item here " + "y " * 30), (5, "ÄÖ ü1 zz " * 40),
    (None, "a B c d e f g h i j k l m"), (1, "A b c d e f g h i j k l m, n O p"), (7, "short\nITEM--here"), (8, "?! ..."), (9, "short item"),
    (10, "b c d e f g h i j k l m n o p q"),
]
ITEMS = [(0, "a b c d e f g h i j k l m n o p"), (1, "short item here"), (2, None), (3, ""), (4, "?"), (5, "ÄÖ ü1 zz " * 6), (None, "zz"), (1, "short item here"), (12, "Short, item here!")]


def rows(spark, docs, items, **options):
    docs = spark.createDataFrame(docs, "doc_id long, text string").withColumn("contamination", d.F.lit(7))
    items = spark.createDataFrame(items, "item_id long, text string")
    found = d.find_contamination(docs, items, **options)
    c = "contamination"
    out = found.select("doc_id", f"{c}.n_words", f"{c}.n_hit", d.F.size(f"{c}.items"), d.F.sha2(d.F.array_join(f"{c}.items", ","), 256), d.contaminated())
    return sorted(map(tuple, out.collect()), key=str)


@pytest.mark.parametrize("block", [d.BLOCK_BYTES, 20])
def test_brute_force(spark, block):
    items = [x for x in ITEMS if x[0] is not None]
    assert rows(spark, DOCS, items, block_bytes=block) == sorted(d.brute_force(DOCS, items), key=str)


def test_empty_tables(spark):
    assert rows(spark, [], ITEMS) == []
    assert all(r[2] == 0 for r in rows(spark, DOCS, []))


def test_null_item_hits_but_is_not_named(spark):
    got = {r[0]: r for r in rows(spark, [(1, "zz")], [(None, "zz")])}
    assert got[1][2:4] == (1, 0) and got[1][5]


def test_removal(spark):
    docs = spark.createDataFrame([(4, "x y short item here z"), (5, None), (6, "fine")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "short item here")], "item_id long, text string")
    assert sorted(r.doc_id for r in d.remove_contamination(docs, items).collect()) == [5, 6]
    cut = {r.doc_id: r.text for r in d.remove_contamination(docs, items, spans=True).collect()}
    assert cut == {4: "x y  z", 5: None, 6: "fine"}
    blocks = d.find_contamination(docs, spark.createDataFrame([(1, "x y"), (2, "short item")], "item_id long, text string"), block_bytes=4)
    assert [(s.start, s.end) for s in blocks.where("doc_id = 4").first().contamination.spans] == [(0, 14)]


def test_driver_tables(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    got = sorted(tuple(r)[:6] for r in d.op1_decontaminate(spark, sf).collect())
    assert got == sorted(d.brute_force(docs, items))
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS FROM '{sf}/{t}.parquet'")
    assert got == sorted(con.execute(d.OP1_SQL).fetchall())
    assert any(r[5] for r in got)


def test_clashing_columns_stay(spark):
    docs = spark.createDataFrame([(4, "x", "a"), (5, "short item here", "b")], "doc_id long, text string, contamination string")
    items = spark.createDataFrame([(1, "short item here")], "item_id long, text string")
    assert [tuple(r) for r in d.remove_contamination(docs, items).collect()] == [(4, "x", "a")]
    assert sorted(tuple(r) for r in d.remove_contamination(docs, items, spans=True).collect()) == [(4, "x", "a"), (5, "", "b")]
