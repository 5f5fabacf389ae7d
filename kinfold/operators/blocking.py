"""Candidate pairs: exact keys and MinHash bands exploded into equi-joins, and the cap by tiers."""

from __future__ import annotations

import json
from dataclasses import asdict
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import BlockingConfig

#: key family -> columns; all must be there for a key
NAME_CODES = {"META": "metaphone", "META_SORTED": "metaphone_sorted", "SOUNDEX": "soundex", "NYSIIS": "nysiis"}
ADDR_CODES = {f"ADDR_{k}": f"addr_{v}" for k, v in NAME_CODES.items()}


def exact_keys(records: DataFrame, cfg: BlockingConfig = BlockingConfig()) -> DataFrame:
    """(entity_id, country, kind, key), empty keys left out."""
    one = lambda kind, key: F.transform(F.array(key), lambda k: F.struct(F.lit(kind).alias("kind"), k.alias("key")))
    families: list[Column] = []
    if cfg.postal:
        families.append(F.transform("postal_codes", lambda k: F.struct(F.lit("PIN").alias("kind"), k.alias("key"))))
    if cfg.city_state:
        families.append(one("CITY_STATE", F.when((F.col("city") != "") & (F.col("state") != ""), F.concat_ws(":", "city", "state"))))
    if cfg.house_number:
        families.append(one("HOUSE", F.coalesce(F.nullif(F.col("house_number_norm"), F.lit("")), F.col("house_number"))))
    codes = (NAME_CODES if cfg.name_phonetic else {}) | (ADDR_CODES if cfg.addr_phonetic else {})
    families += [one(kind, F.col(c)) for kind, c in codes.items()]
    keys = records.select("entity_id", "country", F.explode(F.array_distinct(F.concat(*families))).alias("k"))
    return keys.select("entity_id", "country", "k.kind", "k.key").where("key <> ''")


@lru_cache
def _signer(permutations: int):
    """Least values of multiply-add permutations, over the hashes of a set."""
    rng = np.random.default_rng(42)
    odd, add = (rng.integers(0, 1 << 64, permutations, dtype=np.uint64) for _ in range(2))
    odd |= np.uint64(1)

    @F.pandas_udf("array<bigint>")
    def signed(hashes: pd.Series) -> pd.Series:
        def sign(h):
            if h is None or not len(h):
                return None
            u = np.asarray(h, dtype=np.int64).view(np.uint64)
            least = [(u[k : k + 4096, None] * odd + add).min(axis=0) for k in range(0, len(u), 4096)]
            return np.min(least, axis=0).view(np.int64)

        return hashes.map(sign)

    return signed


def minhash(ngrams: Column, permutations: int, hashed: str = "xxhash64") -> Column:
    """The least hash of a set under each permutation; with md5 any SQL engine gives the same."""
    if hashed != "md5":
        return _signer(permutations)(F.transform(ngrams, lambda g: F.xxhash64(g)))
    of = lambda seed: lambda g: F.md5(F.concat(seed.cast("string"), F.lit("|"), g))
    return F.transform(F.sequence(F.lit(0), F.lit(permutations - 1)), lambda seed: F.array_min(F.transform(ngrams, of(seed))))


def bands(records: DataFrame, ngrams: str, kind: str, n_bands: int, rows: int, hashed: str = "xxhash64") -> DataFrame:
    """(entity_id, country, kind, key): a key for each band of the signature; none for an empty set."""
    signed = records.where(F.size(ngrams) > 0).select("entity_id", "country", minhash(F.col(ngrams), n_bands * rows, hashed).alias("s"))
    each = F.transform(F.sequence(F.lit(0), F.lit(n_bands - 1)), lambda i: F.struct(i.alias("band"), F.array_join(F.slice(F.col("s").cast("array<string>"), i * rows + 1, F.lit(rows)), ",").alias("key")))
    out = signed.select("entity_id", "country", F.explode(each).alias("b"))
    return out.select("entity_id", "country", F.concat(F.lit(f"{kind}_"), F.col("b.band").cast("string")).alias("kind"), F.col("b.key").alias("key"))


@lru_cache
def band_shape(threshold: float, permutations: int = 128) -> tuple[int, int]:
    """(bands, rows) with the least sum of false positives and false negatives around a threshold."""
    s = np.linspace(0, 1, 2001)
    best = None
    for b in range(1, permutations + 1):
        for r in range(1, permutations // b + 1):
            hit = 1 - (1 - s**r) ** b
            wrong = np.trapezoid(np.where(s < threshold, hit, 0), s) + np.trapezoid(np.where(s >= threshold, 1 - hit, 0), s)
            if best is None or wrong < best[0] - 1e-12:
                best = (wrong, b, r)
    return best[1], best[2]


def fuzzy_keys(records: DataFrame, cfg: BlockingConfig = BlockingConfig()) -> DataFrame | None:
    parts = []
    if cfg.name_minhash:
        parts.append(bands(records, "name_ngrams", "NAME_LSH", *band_shape(cfg.name_threshold, cfg.permutations)))
    if cfg.addr_minhash:
        parts.append(bands(records, "addr_ngrams", "ADDR_LSH", *band_shape(cfg.addr_threshold, cfg.permutations)))
    return parts[0].union(parts[1]) if len(parts) == 2 else parts[0] if parts else None


def same_country(a: Column, b: Column) -> Column:
    """Equal countries, or one unknown."""
    unknown = lambda c: c.isNull() | (c == "")
    return unknown(a) | unknown(b) | (a == b)


#: Members of a class that stand in one row, about.
CHUNK = 512


def chunked(members: DataFrame, by: list[str], member: str | Column = "entity_id", rows: int = CHUNK) -> DataFrame:
    """(*by, chunk, members): rows that agree in ``by``, in arrays of about ``rows``, dealt by entity_id."""
    large = members.groupBy(*by).agg(F.ceil(F.count("*") / rows).alias("__parts")).where("__parts > 1")
    same = [F.col(f"m.{c}").eqNullSafe(F.col(f"n.{c}")) for c in by]
    dealt = members.alias("m").join(large.alias("n"), same, "left").select("m.*", F.coalesce(F.pmod(F.xxhash64("m.entity_id"), "__parts"), F.lit(0)).alias("chunk"))
    return dealt.groupBy(*by, "chunk").agg(F.collect_list(member).alias("members"))


def dealt(crossed: DataFrame, *by: str) -> DataFrame:
    """Pairs of chunks over all partitions: few rows that each stand for many, which AQE would take together."""
    return crossed.repartition(2 * int(crossed.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def crossed(pairs: DataFrame, left: DataFrame, right: DataFrame, l: str = "l", r: str = "r") -> DataFrame:  # noqa: E741
    """Pairs of classes with chunks of their members, from (class, chunk, members) of both sides."""
    one = left.select(F.col("class").alias("source1_entity_id"), F.col("chunk").alias("__c1"), F.col("members").alias(l))
    two = right.select(F.col("class").alias("candidate_entity_id"), F.col("chunk").alias("__c2"), F.col("members").alias(r))
    return dealt(pairs.join(one, "source1_entity_id").join(two, "candidate_entity_id"), "source1_entity_id", "candidate_entity_id", "__c1", "__c2")


def expanded(pairs: DataFrame, left: DataFrame, right: DataFrame, *keep: str) -> DataFrame:
    """Pairs of classes as pairs of their members, from (class, chunk, members) of both sides."""
    one = crossed(pairs, left, right, "__l", "__r").select(F.explode("__l").alias("source1_entity_id"), "__r", *keep)
    return one.select("source1_entity_id", F.explode("__r").alias("candidate_entity_id"), *keep)


def key_pairs(left: DataFrame, right: DataFrame, restrict: bool = True) -> DataFrame:
    """Distinct pairs that share a key.

    Records of one country with the same keys are a class: pairs are found and made distinct between
    classes, and only then written out for the members. The keys are read three times, so those that
    take a pass of Python over the records go to row_pairs() as they are.
    """
    (l, lk), (r, rk) = _classes(left), _classes(right)  # noqa: E741
    return expanded(row_pairs(lk, rk, restrict), l, r)


def _classed(keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(class, entity_id), and the keys with the class as their record; a class is named by a digest of all its keys."""
    each = keys.groupBy("entity_id", "country").agg(F.sort_array(F.collect_set(F.struct("kind", "key"))).alias("keys"))
    each = each.withColumn("class", F.sha2(F.to_json(F.struct("country", "keys")), 256))
    once = each.groupBy("class").agg(F.first("country").alias("country"), F.first("keys").alias("keys"))
    return each.select("class", "entity_id"), once.select(F.col("class").alias("entity_id"), "country", F.explode("keys").alias("k")).select("entity_id", "country", "k.kind", "k.key")


def _classes(keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(class, chunk, members), and the keys with the class as their record."""
    members, once = _classed(keys)
    return chunked(members, ["class"]), once


#: Pairs that a key makes at most to be joined by rows.
LIGHT = 64


def split_pairs(left: DataFrame, right: DataFrame, restrict: bool = True) -> DataFrame:
    """As key_pairs(), for kinds of keys of which some are nearly unique.

    Classes are of the heavy keys alone, so that a key of few records doesn't part those that agree in
    common ones.  Pairs of light keys are joined by rows, without those that two classes make already.
    Keys that stand on one side alone make no pair and are left out.
    """
    left, right = left.persist(), right.persist()
    count = lambda df, n: df.groupBy("kind", "key").agg(F.count("*").alias(n))
    sized = count(left, "__n").join(count(right, "__m"), ["kind", "key"]).select("kind", "key", (F.col("__n") * F.col("__m") > LIGHT).alias("__heavy"))
    of = lambda df, heavy: df.join(sized.where(F.col("__heavy") == heavy), ["kind", "key"], "left_semi").select("entity_id", "country", "kind", "key")
    (lm, lk), (rm, rk) = _classed(of(left, True)), _classed(of(right, True))
    classes = row_pairs(lk, rk, restrict)
    named = lambda m, id, c: m.select(F.col("entity_id").alias(id), F.col("class").alias(c))
    rest = row_pairs(of(left, False), of(right, False), restrict).join(named(lm, "source1_entity_id", "__a"), "source1_entity_id", "left").join(named(rm, "candidate_entity_id", "__b"), "candidate_entity_id", "left")
    known = classes.select(F.col("source1_entity_id").alias("__a"), F.col("candidate_entity_id").alias("__b"))
    rest = rest.join(known, ["__a", "__b"], "left_anti").select("source1_entity_id", "candidate_entity_id")
    return expanded(classes, chunked(lm, ["class"]), chunked(rm, ["class"])).union(rest)


def key_chunks(left: DataFrame, right: DataFrame, s1: DataFrame, others: DataFrame, restrict: bool = True) -> DataFrame:
    """(l, r): the pairs of key_pairs() as chunks of their records, from (entity_id, member)."""
    (lm, lk), (rm, rk) = _classed(left), _classed(right)
    of = lambda m, df: chunked(m.join(df, "entity_id"), ["class"], "member")
    return crossed(row_pairs(lk, rk, restrict), of(lm, s1), of(rm, others)).select("l", "r")


def key_lists(left: DataFrame, right: DataFrame, s1: DataFrame, restrict: bool = True) -> DataFrame:
    """As candidate_lists() of key_pairs(): a list is gathered and sorted once for all records with the same keys."""
    (lm, lk), (r, rk) = _classed(left), _classes(right)
    found = row_pairs(lk, rk, restrict).join(r.select(F.col("class").alias("candidate_entity_id"), "members"), "candidate_entity_id")
    lists = found.groupBy(F.col("source1_entity_id").alias("class")).agg(F.array_sort(F.flatten(F.collect_list("members"))).alias("candidate_entity_ids"))
    return _listed(s1.select("entity_id").join(lm, "entity_id", "left").join(lists, "class", "left").withColumnRenamed("entity_id", "source1_entity_id"))


def row_pairs(left: DataFrame, right: DataFrame, restrict: bool) -> DataFrame:
    """Distinct pairs of (entity_id, country, kind, key) that share a key.

    With countries, known ones are part of the join's key, so that a common key is split by them; only
    records without a country, which meet all countries, are joined on kind and key alone.
    """
    l = left.select(F.col("entity_id").alias("source1_entity_id"), F.col("country").alias("c1"), "kind", "key")  # noqa: E741
    r = right.select(F.col("entity_id").alias("candidate_entity_id"), F.col("country").alias("c2"), "kind", "key")
    ids = ["source1_entity_id", "candidate_entity_id"]
    if not restrict:
        return l.join(r, ["kind", "key"]).select(*ids).distinct()
    known = lambda df, c: df.where(F.col(c) != "")
    unknown = lambda df, c: df.where(F.coalesce(F.col(c), F.lit("")) == "")
    named = known(l, "c1").join(known(r, "c2").withColumnRenamed("c2", "c1"), ["kind", "key", "c1"])
    open_left, open_right = unknown(l, "c1").join(r, ["kind", "key"]), known(l, "c1").join(unknown(r, "c2"), ["kind", "key"])
    return named.select(*ids).union(open_left.select(*ids)).union(open_right.select(*ids)).distinct()


def tiered(exact: DataFrame, *fuzzy: DataFrame) -> DataFrame:
    """(pair, tier): 0 for exact pairs, then each further list, a pair at its first tier."""
    every = exact.withColumn("tier", F.lit(0))
    for i, f in enumerate(fuzzy, 1):
        every = every.union(f.select("source1_entity_id", "candidate_entity_id").withColumn("tier", F.lit(i)))
    return every.groupBy("source1_entity_id", "candidate_entity_id").agg(F.min("tier").alias("tier"))


def cap(pairs: DataFrame, most: int, seed: int = 42) -> DataFrame:
    """All exact pairs, and of the others as many as there is room for, by tier and then by hash.

    The others are ranked alone with a constant bound, which Spark limits before the shuffle; the
    room is taken off afterwards.
    """
    exact = pairs.where("tier = 0")
    order = Window.partitionBy("source1_entity_id").orderBy("tier", F.xxhash64(F.lit(seed), "source1_entity_id", "candidate_entity_id"), "candidate_entity_id")
    fuzzy = pairs.where("tier > 0").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    taken = exact.groupBy("source1_entity_id").agg(F.count("*").alias("n"))
    room = fuzzy.join(taken, "source1_entity_id", "left").where(F.col("rank") <= most - F.coalesce("n", F.lit(0)))
    columns = ["source1_entity_id", "candidate_entity_id", "tier"]
    return exact.select(*columns).union(room.select(*columns)).withColumn("is_exact", F.col("tier") == 0)


class KeyIndex:
    """All keys of the records that are searched, written once and read for any number of queries."""

    def __init__(self, exact: DataFrame, fuzzy: DataFrame | None, cfg: BlockingConfig):
        self.exact, self.fuzzy, self.cfg = exact, fuzzy, cfg

    @classmethod
    def build(cls, records: DataFrame, cfg: BlockingConfig = BlockingConfig()) -> KeyIndex:
        return cls(exact_keys(records, cfg), fuzzy_keys(records, cfg), cfg)

    def save(self, path: str) -> KeyIndex:
        """Bands are saved too, so that a loaded index finds what a fresh one does."""
        self.exact.write.mode("overwrite").partitionBy("kind").parquet(f"{path}/exact")
        if self.fuzzy is not None:
            self.fuzzy.write.mode("overwrite").parquet(f"{path}/fuzzy")
        settings = self.exact.sparkSession.createDataFrame([(json.dumps(asdict(self.cfg)),)], "settings string")
        settings.write.mode("overwrite").json(f"{path}/settings")
        return self.load(self.exact.sparkSession, path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> KeyIndex:
        cfg = BlockingConfig(**json.loads(spark.read.json(f"{path}/settings").first().settings))
        columns = ["entity_id", "country", "kind", "key"]
        exact = spark.read.parquet(f"{path}/exact").select(*columns)
        return cls(exact, spark.read.parquet(f"{path}/fuzzy").select(*columns) if cfg.name_minhash or cfg.addr_minhash else None, cfg)

    def candidates(self, s1: DataFrame, neighbours: DataFrame | None = None, capped: bool = True) -> DataFrame:
        exact = row_pairs(exact_keys(s1, self.cfg), self.exact, self.cfg.same_country)
        fuzzy = [neighbours] if neighbours is not None else []
        if self.fuzzy is not None:
            fuzzy.append(row_pairs(fuzzy_keys(s1, self.cfg), self.fuzzy, self.cfg.same_country))
        pairs = tiered(exact, *fuzzy)
        return cap(pairs, self.cfg.max_candidates, self.cfg.seed) if capped else pairs.withColumn("is_exact", F.col("tier") == 0)


def candidates(s1: DataFrame, others: DataFrame, cfg: BlockingConfig = BlockingConfig(), neighbours: DataFrame | None = None, capped: bool = True) -> DataFrame:
    """(source1_entity_id, candidate_entity_id, tier, is_exact) from all keys, and nearest neighbours if given."""
    return KeyIndex.build(others, cfg).candidates(s1, neighbours, capped)


def candidate_lists(pairs: DataFrame, s1: DataFrame) -> DataFrame:
    """A sorted list for every record of source 1, empty ones included."""
    lists = pairs.groupBy("source1_entity_id").agg(F.array_sort(F.collect_set("candidate_entity_id")).alias("candidate_entity_ids"))
    return _listed(s1.select(F.col("entity_id").alias("source1_entity_id")).join(lists, "source1_entity_id", "left"))


def _listed(out: DataFrame) -> DataFrame:
    ids = F.coalesce("candidate_entity_ids", F.array().cast("array<string>"))
    return out.select("source1_entity_id", ids.alias("candidate_entity_ids"), F.size(ids).alias("num_candidates"))


def key_counts(keys: DataFrame) -> DataFrame:
    return keys.groupBy("kind").agg(F.countDistinct("key").alias("n_keys"))


def repeated_ids(records: DataFrame) -> DataFrame:
    """Ids that aren't unique, which every join on ids presumes."""
    return records.groupBy("entity_id").count().where("count > 1")
