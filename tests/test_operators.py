import pytest
from pyspark.sql import functions as F

from kinfold.config import BlockingConfig, Config, ModelConfig
from kinfold.operators import blocking, calibrate, evaluate, features, knn, model, postprocess, preprocess, validate
from kinfold.plans.pipeline import Linkage
from kinfold.schemas import PROCESSED
from kinfold.sources import tsv

RECORDS = [
    ("S1-1", "Waters & Millar Aimei P.C.", "6267 Passing Sky Drive, Security-widefield, CO 80911", "US"), ("S2-1", "Aimei Waters & Millar P.C.", "6267B PASSING SKY DR, SECURITY-WIDEFIELD, CO 80911", "US"),
    ("S2-2", "एसएस फूड प्राइवेट लिमिटेड", "AF-0684, NANDGRAM, GHAZIABAD, उत्तर प्रदेश", "India"), ("S3-9", None, None, None),
]
PAIR = "source1_entity_id string, candidate_entity_id string"


@pytest.fixture(scope="module")
def processed(spark):
    return preprocess.preprocess(spark.createDataFrame(RECORDS, tsv.SOURCE)).cache()


def test_preprocess(processed):
    rows = {r.entity_id: r for r in processed.collect()}
    assert processed.schema.fieldNames() == PROCESSED.fieldNames()
    assert rows["S1-1"].name_clean == "waters & millar aimei" and rows["S1-1"].metaphone_sorted == rows["S2-1"].metaphone_sorted and rows["S1-1"].postal_codes == ["80911"]
    assert rows["S2-2"].name_clean.isascii() and rows["S2-2"].state == "" and rows["S3-9"].name_clean == "" and rows["S3-9"].name_ngrams == []


def test_candidates(spark, processed):
    s1, others = processed.where("entity_id like 'S1%'"), processed.where("entity_id not like 'S1%'")
    found = blocking.candidates(s1, others).collect()
    assert {(r.source1_entity_id, r.candidate_entity_id) for r in found} == {("S1-1", "S2-1")} and found[0].is_exact
    assert blocking.repeated_ids(processed).count() == 0
    lists = blocking.candidate_lists(spark.createDataFrame([], PAIR), s1).first()
    assert lists.candidate_entity_ids == [] and lists.num_candidates == 0


def test_band_shape():
    assert blocking.band_shape(0.55) == (21, 6) and blocking.band_shape(0.7) == (14, 9)


@pytest.mark.parametrize("exact, fuzzy, kept", [(4, 5, (4, 0)), (1, 5, (1, 2)), (0, 2, (0, 2)), (3, 1, (3, 0))])
def test_cap(spark, exact, fuzzy, kept):
    df = lambda p, n: spark.createDataFrame([("S1-1", f"{p}{i}") for i in range(n)], PAIR)
    out = blocking.cap(blocking.tiered(df("e", exact), df("f", fuzzy)), 3).collect()
    assert (sum(r.is_exact for r in out), sum(not r.is_exact for r in out)) == kept


def test_country_restriction(spark):
    keys = "entity_id string, country string, kind string, key string"
    a = spark.createDataFrame([("S1-1", "US", "K", "x"), ("S1-2", None, "K", "x")], keys)
    b = spark.createDataFrame([("S2-1", "US", "K", "x"), ("S2-2", "France", "K", "x"), ("S2-3", "", "K", "x")], keys)
    got = {tuple(r) for r in blocking.key_pairs(a, b).collect()}
    assert got == {("S1-1", "S2-1"), ("S1-1", "S2-3"), ("S1-2", "S2-1"), ("S1-2", "S2-2"), ("S1-2", "S2-3")}


def test_features(spark, processed):
    s1, others = processed.where("entity_id like 'S1%'"), processed.where("entity_id not like 'S1%'")
    pairs = spark.createDataFrame([("S1-1", "S2-1"), ("S1-1", "S3-9"), ("S1-1", "gone")], PAIR)
    labelled = features.label(pairs, spark.createDataFrame([("S1-1", "S2-1")], PAIR))
    rows = {r.candidate_entity_id: r for r in features.pair_features(features.hydrate(labelled, s1, others), features.Tfidf.fit(processed)).collect()}
    a, b = rows["S2-1"], rows["S3-9"]
    assert set(rows) == {"S2-1", "S3-9"} and a.label == 1 and b.label == 0
    assert a.token_jaccard == 1 and a.first_token_match == 0 and a.pin_exact == 1 and 0 < a.tfidf_cosine <= 1 + 1e-9 and a.jaro_winkler == a.fuzz_wratio == 0.95
    assert all(b[f] == 0 for f in features.FEATURES)
    assert all(0 <= a[f] <= 1 + 1e-9 for f in features.FEATURES)


def test_numeric_tokens(spark):
    r = spark.range(1).select(features.numeric_tokens(F.lit("12-a 6267b 12/34")).alias("t")).first()
    assert set(r.t) == {"12-", "12/", "34"}


def test_recall(spark):
    truth = spark.createDataFrame([("S1-1", "a"), ("S1-1", "b")], PAIR)
    found = spark.createDataFrame([("S1-1", "a"), ("S1-1", "c"), ("S1-2", "a")], PAIR)
    r = evaluate.recall(truth, found, None).first()
    assert (r.overall_recall, r.macro_recall, r.avg_candidates, r.n_entities) == (0.5, 0.5, 2.0, 1)
    assert evaluate.recall(truth.limit(0), found, None).first().overall_recall == 0


def test_entity_f(spark):
    s1 = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "entity_id string")
    truth = spark.createDataFrame([("a", "x"), ("a", "z"), ("d", "x")], PAIR)
    found = spark.createDataFrame([("a", "x"), ("a", "y"), ("a", "z"), ("c", "x")], PAIR)
    got = {r.source1_entity_id: r.f_beta for r in evaluate.entity_scores(s1, truth, found).collect()}
    assert got["a"] == pytest.approx(0.714286, abs=1e-6) and (got["b"], got["c"], got["d"]) == (1, 0, 0)


def test_class_macro(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (0, 1), (0, 0)], "label int, predicted int")
    assert evaluate.pair_metrics(df).first().f_beta == pytest.approx(0.815217, abs=1e-6)


def test_thresholds(spark):
    rows = [("US", 0.9, 1), ("US", 0.8, 1), ("US", 0.295, 0), ("US", 0.2, 0), ("FR", 0.05, 1)]
    df = spark.createDataFrame(rows, "country string, probability double, label int")
    got = {r.country: (r.threshold, r.f_beta) for r in calibrate.best(calibrate.grid(df)).collect()}
    assert got["US"] == (0.3, 1.0) and got["FR"] == (0.5, 0.0)
    probe = spark.createDataFrame([("US", 0.3, "a"), ("US", 0.301, "b"), ("XX", 0.5, "c"), ("XX", 0.51, "d")], "country string, probability double, source1_entity_id string")
    c = calibrate.Calibrator().fit(df)
    assert {r.source1_entity_id: r.predicted for r in c.predict(probe).collect()} == {"a": 0, "b": 1, "c": 0, "d": 1}
    alone = spark.createDataFrame([("b", 0.9)], "source1_entity_id string, probability double")
    assert {r.source1_entity_id: r.predicted for r in c.predict(probe, alone).collect()}["b"] == 0


def test_thresholds_on_the_grid(spark):
    df = spark.createDataFrame([("c", i / 100, 1) for i in range(5, 96)], "country string, probability double, label int")
    got = {r.threshold: r.tp for r in calibrate.grid(df).collect()}
    assert got == {i / 100: sum(j / 100 > i / 100 for j in range(5, 96)) for i in range(10, 91)}


def test_calibrator_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("US", 0.9, 1), ("US", 0.2, 0)], "country string, probability double, label int")
    c = calibrate.Calibrator(fallback="global").fit(df)
    c.save(str(tmp_path / "t"))
    again = calibrate.Calibrator.load(spark, str(tmp_path / "t"))
    assert again.overall == c.overall and again.fallback == "global" and again.thresholds.collect() == c.thresholds.select("country", "threshold").collect()


def test_singletons(spark):
    s1 = spark.createDataFrame([("a",), ("b",)], "entity_id string")
    values = {c: 0.5 for c in ("fuzz_wratio", "addr_token_jaccard", "token_jaccard", "pin_exact", "city_exact", "house_number_match")}
    pairs = spark.createDataFrame([("a", "x")], PAIR).withColumns({c: F.lit(v) for c, v in values.items()})
    got = {r[0]: tuple(r)[1:] for r in model.singleton_features(s1, pairs).select("source1_entity_id", *model.SINGLETON_FEATURES).collect()}
    assert got == {"a": (0.5, 0.5, 0.5, 0.5, 0.5, 0.5, 1.0, 0.0), "b": (1.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0)}
    rows = model.singleton_features(s1, pairs).withColumn("is_singleton", (F.col("source1_entity_id") == "b").cast("int"))
    p = {r.source1_entity_id: r.probability for r in model.SingletonModel().train(rows).predict_proba(rows).collect()}
    assert p["b"] > p["a"]
    with pytest.raises(ValueError):
        model.MatchModel().predict_proba(rows)


def test_knn(spark):
    rows = [(i, i % 2, [float(i == j) for j in range(4)]) for i in range(4)] + [(9, 0, [0.9, 0.0, 0.1, 0.0])]
    v = spark.createDataFrame(rows, "id int, part int, vector array<float>")
    got = knn.topk(v.withColumnRenamed("id", "q"), v, 2, by=["part"], query="q", candidate="id", least=0.0)
    assert [(r.id, r.rank) for r in got.where("q = 0").orderBy("rank").collect()] == [(0, 1), (9, 2)]
    indexed, probe = knn.inverted_lists(v, lists=2)
    assert probe(v, 2).count() == 10 and indexed.count() == 5
    vectors = knn.hashed_ngrams(16)(["abcd", "abcd", ""])
    assert (vectors[0] == vectors[1]).all() and not vectors[2].any()
    texts = spark.createDataFrame([("a", "b", "x", "y")], "source1_entity_id string, candidate_entity_id string, text_1 string, text_2 string")
    assert knn.rerank(texts, lambda a, b: [0.25] * len(a)).first().probability == 0.25


def test_recall_of_inverted_lists(spark):
    e = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", F.col("embedding").alias("vector"), F.lit(1).alias("all"))
    q = e.where("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id")
    indexed, probe = knn.inverted_lists(e)
    top = lambda a, b, by: {tuple(r) for r in knn.topk(a, b, 10, by=[by], query="query_id", candidate="vec_id").select("query_id", "vec_id").collect()}
    exact = top(q, e, "all")
    assert len(top(probe(q, 0.7), indexed, "cell") & exact) >= 0.9 * len(exact)


def test_postprocess(spark):
    lists = spark.createDataFrame([(["b", "a", "b"],)], "matched_entity_ids array<string>")
    assert postprocess.deduplicate(lists).first()[0] == ["b", "a"]
    pairs, cands = spark.createDataFrame([("s", "a"), ("s", "b"), ("t", "a")], PAIR), spark.createDataFrame([("s", "a"), ("t", "a")], PAIR)
    alone = spark.createDataFrame([("t", 0.8)], "source1_entity_id string, probability double")
    assert [tuple(r) for r in postprocess.finish(pairs, cands, alone, 0.7).collect()] == [("s", "a")]
    assert len(postprocess.finish(pairs, cands, alone, 0.9).collect()) == 2


def test_validator(spark, tmp_path):
    required = spark.createDataFrame([("S1-1",), ("S1-2",)], "id string")

    def rules(content, candidates=None, valid=None):
        (tmp_path / "m.tsv").write_text(content)
        if candidates is not None:
            (tmp_path / "c.tsv").write_text(candidates)
        out = validate.validate(spark, str(tmp_path / "m.tsv"), required, str(tmp_path / "c.tsv") if candidates is not None else None, valid)
        return {(r.severity, r.rule, r.examples) for r in out.collect()}

    head = "source1_entity_id\tmatched_entity_ids\n"
    good = head + "S1-1\tS2-1,S3-1\nS1-2\t\n\n"
    assert rules(good) == set()
    assert {r for _, r, _ in rules("source1_entity_id,matched_entity_ids\n")} == {"comma-separated"}
    assert {r for _, r, _ in rules("a\tb\n")} == {"unexpected header"} and {r for _, r, _ in rules("")} == {"empty file"}
    assert rules(good + "no tab\n") == {("error", "malformed row", "line 5")}
    assert rules(good + "S1-1\t\n") == {("error", "duplicate row", "S1-1")}
    assert rules(head + "S1-1\tS2-1,S2-1\nS1-2\tS1-4,X-1\n") == {("error", "repeated id in list", "S1-1"), ("error", "self match", "S1-4"), ("error", "wrong prefix", "X-1")}
    assert rules(head + "S1-1\t\nS1-9\t\n") == {("error", "missing entity", "S1-2"), ("error", "extra entity", "S1-9")}
    assert rules(good, valid=spark.createDataFrame([("S2-1",)], "id string")) == {("error", "unknown id", "S3-1")}
    assert rules(good, candidates="source1_entity_id\tcandidate_entity_ids\nS1-1\tS2-1\nS1-2\t\n") == {("warning", "match outside candidates", "S1-1")}


def test_files_to_files(spark, tmp_path):
    """Sources in, two valid files out."""
    names = ["alpha foods", "beta mills", "gamma steel", "delta works", "epsilon labs", "zeta motors", "eta textiles", "theta glass", "iota paper", "kappa tools"]
    s1, s2, truth = [], [], []
    for i, n in enumerate(names * 3):
        s1.append((f"S1-{i}", f"{n} {i} inc", f"house no {i}, {n} road 6060{i % 10}", "US"))
        s2.append((f"S2-{i}", f"{n} {i} llc", f"house no {i}, {n} rd 6060{i % 10}", "US"))
        truth.append((f"S1-{i}", f"S2-{i}" if i % 7 else ""))
    s2 = [r for i, r in enumerate(s2) if i % 7]
    for split in ("train", "test"):
        d = tmp_path / "raw" / split
        d.mkdir(parents=True)
        rows = lambda header, data: header + "\n" + "".join("\t".join(r) + "\n" for r in data)
        header = "entity_id\tbusiness_name\tbusiness_address\tcountry"
        (d / f"{split}_source1.tsv").write_text(rows(header, s1))
        (d / f"{split}_source2.tsv").write_text(rows(header, s2))
        (d / f"{split}_ground_truth.tsv").write_text(rows("source1_entity_id\tmatched_entity_ids", truth))
    cfg = Config(*(str(tmp_path / x) for x in ("raw", "processed", "candidates", "models", "output")), blocking=BlockingConfig(max_candidates=10, knn_k=3), model=ModelConfig(rounds=5, depth=3, min_rows=1))
    link = Linkage(spark, cfg, knn.hashed_ngrams(64))
    link.run()
    required = spark.createDataFrame([(r[0],) for r in s1], "id string")
    assert validate.validate(spark, f"{cfg.output_dir}/matching_results.tsv", required, f"{cfg.output_dir}/candidate_pairs.tsv").count() == 0
    assert link.evaluate("train")["recall"].first().overall_recall == 1
    header, lines = validate.read_lines(spark, f"{cfg.output_dir}/matching_results.tsv")
    assert header == "source1_entity_id\tmatched_entity_ids" and lines.count() == len(s1)
    sampled = tsv.sample({k: v for k, v in tsv.read_sources(spark, cfg.raw_dir, "train").items()}, tsv.read_tsv(spark, f"{cfg.raw_dir}/train/train_ground_truth.tsv", tsv.TRUTH), 4)
    assert sampled["source1"].count() == 4 == sampled["source2"].count()


def test_address_library_where_it_is(monkeypatch):
    import sys
    from types import ModuleType

    from kinfold.operators import preprocess

    if preprocess._library() is None:
        assert preprocess.best_parser() is preprocess.parse_by_patterns
    package, expand, parser = (ModuleType(n) for n in ("postal", "postal.expand", "postal.parser"))
    package.expand, package.parser = expand, parser
    expand.expand_address = lambda a: [a.replace("st", "street")] if a != "odd" else []
    parser.parse_address = lambda a: [(a.split()[0], "house_number"), (" ".join(a.split()[1:]), "road"), ("75001", "postcode"), ("paris", "city")] if " " in a else []
    for m in (package, expand, parser):
        monkeypatch.setitem(sys.modules, m.__name__, m)
    assert preprocess.best_parser() is preprocess.parse_by_library
    empty = {"house_number": "", "road": "", "unit": "", "po_box": "", "postal_codes": []}
    assert preprocess.library_parts("5 main st", *preprocess._library()) == empty | {"house_number": "5", "road": "main street", "postal_codes": ["75001"]}
    assert preprocess.library_parts("odd", *preprocess._library()) == preprocess.library_parts("", *preprocess._library()) == empty
