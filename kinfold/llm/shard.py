"""Sharding by sampled splitters: size-weighted key samples give quantile boundaries, records are
range-partitioned between them, and ranges that come out overfull are subdivided.

The law is ``bytes``: shards get nearly equal sizes.  The key is a hash of the text, so equal texts
are neighbours.  No task sorts more than a part of a range, of PART_BYTES at most: an overfull range
is cut by a second hash of the key, so that equal keys stay together, and a key that is too large by
itself is a range of its own, cut by id.  All of its parts go to one shard, unless they exceed a
thirtieth of a shard or so and have to be spread for the law to hold.

Defined results: a null text has size 1, as an empty one; rows that are equal in key and id are
interchangeable; slots follow part, key and id, null ids last; very long texts are ranges of their
own; an empty table gives an empty result.  Columns named like a result are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import ArrowUDFType

from .store import settle

#: Ranges for each shard, and sampled keys for each range; they bound what the driver sees.
RANGES, SAMPLES = 512, 64
#: Bytes that a task ranks at most; a key goes whole up to this share of a shard.
PART_BYTES, WHOLE = 256 << 20, 1 / 32


def _range_of(splitters: list[int]):
    def find(keys: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(np.array(splitters, np.int64), keys.to_numpy(zero_copy_only=False), "right").astype(np.int32))

    return F.arrow_udf(find, returnType="int", functionType=ArrowUDFType.SCALAR)


def _uniform(*columns: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.lit(0x5EED), *columns), 11) / F.lit(float(1 << 53))


def _parts(range_column: Column, by: Column, cut: dict[int, int]) -> Column:
    """The part of a row within an overfull range; 0 elsewhere."""
    if not cut:
        return F.lit(0)
    ways = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in sorted(cut.items()) for x in kv]), range_column), F.lit(1))
    return F.pmod(F.xxhash64(F.lit(7), by), ways.cast("long")).cast("int")


def shard(docs: DataFrame, shards: int = 8, *, key: Column, size: Column, id: str = "doc_id", ranges: int = RANGES) -> DataFrame:
    """``docs`` with ``shard`` and ``slot``, gapless from 0 in each shard.

    ``key`` must be a long that depends on a record alone.  Statistics run over keys and sizes,
    written once; the driver sees at most a few numbers for each range.
    """
    spark, n = docs.sparkSession, shards * ranges
    keyed = docs.withColumns({"__key": key, "__size": size})
    thin = settle(keyed.select("__key", "__size", F.col(id).alias("__id")))
    total = thin.agg(F.sum("__size")).first()[0] or 0
    if not total:
        return keyed.withColumns({"shard": F.lit(0), "slot": F.lit(0).cast("long")}).drop("__key", "__size")
    drawn = thin.where(_uniform(F.col("__key"), F.col("__id")) * total < F.col("__size") * float(n * SAMPLES))
    found = drawn.agg(F.percentile_approx("__key", [i / n for i in range(1, n)], 20 * n)).first()[0] or []
    find = _range_of(sorted(set(found)))

    # what a part holds at most: twice its share of the ranges, or what a task can rank
    full = min(2 * total / n, float(PART_BYTES))
    large = thin.groupBy("__key").agg(F.sum("__size").alias("b")).where(F.col("b") > full)
    large = sorted((r["__key"], int(-(-r.b // (full / 2)))) for r in large.collect())  # one for each ``full`` bytes at most
    alone = spark.createDataFrame([(k, n + i, w) for i, (k, w) in enumerate(large)], "__large long, __own int, __ways int")

    def ranged(rows: DataFrame) -> DataFrame:
        rows = rows.join(F.broadcast(alone), F.col("__key") == F.col("__large"), "left") if large else rows.withColumns({"__own": F.lit(None).cast("int"), "__ways": F.lit(1)})
        return rows.withColumn("__range", F.coalesce("__own", find("__key")))

    sizes = ranged(thin).groupBy("__range").agg(F.sum("__size").alias("b")).where((F.col("b") > full) & (F.col("__range") < n))
    cut = {r[0]: int(-(-r[1] // (full / 2))) for r in sizes.collect()}
    part = F.when(F.col("__own").isNull(), _parts(F.col("__range"), F.col("__key"), cut)).otherwise(F.pmod(F.xxhash64(F.lit(7), "__id"), F.col("__ways").cast("long")).cast("int"))
    held = ranged(thin).withColumn("__part", part).groupBy("__range", "__part").agg(F.sum("__size"), F.count("*")).collect()
    places = spark.createDataFrame(_assign(sorted(map(tuple, held)), total, shards, n), "__range int, __part int, shard int, __first long")

    rank = F.row_number().over(Window.partitionBy("__range", "__part").orderBy("__key", F.col("__id").asc_nulls_last()))
    at = ranged(keyed.withColumn("__id", F.col(id))).withColumn("__part", part)
    return (
        at.drop("shard", "slot").withColumn("__rank", rank)
        .join(F.broadcast(places), ["__range", "__part"])  # one row for each part
        .withColumn("slot", F.col("__first") + F.col("__rank") - 1)
        .drop("__key", "__size", "__id", "__large", "__own", "__ways", "__range", "__part", "__rank", "__first")
    )


def _assign(held: list[tuple[int, int, int, int]], total: int, shards: int, ranges: int) -> list[tuple[int, int, int, int]]:
    """Parts in order to shards by where the middle of each falls among all bytes; ranges from
    ``ranges`` on are those of one key, whose parts stay together if they are few."""
    whole: dict[int, int] = {}
    for r, _, b, _ in held:
        whole[r] = whole.get(r, 0) + b
    out, before, first, last, target = [], 0, [0] * shards, None, 0
    for r, p, b, c in held:
        if r < ranges or whole[r] > WHOLE * total / shards:
            target = min(shards - 1, int((before + b / 2) * shards / total))
        elif r != last:
            target = min(shards - 1, int((before + whole[r] / 2) * shards / total))
        last = r
        out.append((r, p, target, first[target]))
        first[target] += c
        before += b
    return out


def text_size(text: str = "text") -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def text_key(text: str = "text") -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def op9_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    thin = settle(docs.select("doc_id", text_size().alias("size"), F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), text_key().alias("text_key")))
    out = shard(thin, 8, key=F.col("text_key"), size=F.col("size"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
