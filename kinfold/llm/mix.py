"""Mixing sources to target weights by a low-discrepancy schedule.

Slot i of the schedule has the point frac(i / golden ratio); the cumulative shares of the sources
map points to sources, and a slot's rank among its source's slots names the block that it takes.
Blocks are runs of equally many words in the source's shuffled documents, laid end to end as often
as documents may repeat.

Targets: sources in code point order, null last, have the given weights in turn.  Of ``share``
times all words each gets a part by weight, but never more than ``repeat`` times its own words;
what it can't take goes to the others by weight.

Defined results: a null or empty text has size 0 and is never taken; rows that are equal in id and
text are interchangeable; a source without words has target 0; an empty table gives an empty
result.  Columns named like a result are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .store import settle

WORD = r"[^\x20\x09-\x0D]+"
#: Words of a block.
BLOCK = 64
#: Slots whose ranks one task counts; rows of the grid that a join broadcasts at most.
CHUNK, GRID_BROADCAST = 1 << 14, 100_000
GRID, BUCKETS = 1024, 1024
GOLDEN = 0.6180339887498949


def words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, *, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, repeat: int = 2) -> DataFrame:
    """(source, source_size) -> with number, weight and target; one row for each source.

    With caps in order of cap / weight, the level at which shares are cut is the largest
    (rest of the words) / (rest of the weights) that its own cap admits.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    t = sizes.withColumn("source_no", F.row_number().over(by_name) - 1)
    t = t.withColumn("weight", F.element_at(F.lit([float(w) for w in weights]), F.col("source_no") % len(weights) + 1))
    t = t.withColumns({"cap": F.lit(float(repeat)) * F.col("source_size"), "total": F.sum("source_size").over(everything) * F.lit(float(share))})
    t = t.withColumn("turn", F.col("cap") / F.col("weight"))
    before = Window.orderBy("turn", "source_no").rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.orderBy("turn", "source_no").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    t = t.withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(rest))
    level = F.max(F.when(F.col("level") <= F.col("turn"), F.col("level"))).over(everything)
    t = t.withColumn("target", F.least("cap", F.coalesce(level, F.lit(float("inf"))) * F.col("weight")))
    return t.select("source", "source_no", "source_size", "weight", "target")


def point(slot: Column) -> Column:
    """frac(slot * GOLDEN), in two steps so that the product keeps its fraction."""
    high, low = F.shiftright(slot, 20), slot.bitwiseAND((1 << 20) - 1)
    step = GOLDEN * (1 << 20) % 1
    return (((high * F.lit(step)) % 1) + ((low * F.lit(GOLDEN)) % 1)) % 1


def schedule(goal: DataFrame, *, block: int = BLOCK) -> DataFrame:
    """(slot, source_no, block): what each slot takes, for settled targets."""
    spark = goal.sparkSession
    total, most = goal.agg(F.sum("target"), F.count("*")).first()
    slots = int((total or 0) / block * 1.02) + 64 * bool(total)
    by_no = Window.orderBy("source_no")
    cells = goal.where("target > 0").withColumn("hi", F.sum("target").over(by_no) / F.lit(float(total or 1)))
    cells = cells.withColumn("lo", F.coalesce(F.lag("hi").over(by_no), F.lit(0.0)))
    cells = cells.withColumn("hi", F.when(F.lead("hi").over(by_no).isNull(), F.lit(2.0)).otherwise(F.col("hi")))
    edge = lambda c: F.least(F.lit(GRID - 1), F.floor(F.col(c) * GRID).cast("int"))
    cells = cells.select("source_no", "target", "lo", "hi", F.explode(F.sequence(edge("lo"), edge("hi"))).alias("cell"))
    if most + GRID <= GRID_BROADCAST:
        cells = F.broadcast(cells)
    points = spark.range(slots).withColumn("point", point(F.col("id") + 1)).withColumn("cell", F.floor(F.col("point") * GRID).cast("int"))
    taken = points.join(cells, "cell").where("lo <= point AND point < hi").select(F.col("id").alias("slot"), "source_no", "target", F.floor(F.col("id") / CHUNK).alias("chunk"))
    counts = taken.groupBy("source_no", "chunk").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("source_no").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    got = counts.groupBy("source_no").agg(F.sum("n").alias("got"))
    counts = counts.select("source_no", "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("ahead"))
    rank = F.row_number().over(Window.partitionBy("source_no", "chunk").orderBy("slot")) - 1
    ranked = taken.withColumn("rank", rank).join(counts, ["source_no", "chunk"])
    ranked = ranked.withColumn("block", F.col("ahead") + F.col("rank"))
    # what points have left out of a source, a block or two, comes after the last slot
    need, first = F.ceil(F.floor("target") / block), F.coalesce("got", F.lit(0))
    missing = goal.select("source_no", "target").join(got, "source_no", "left").where(need > first).select("source_no", "target", F.explode(F.sequence(first, need - 1)).alias("block"))
    missing = missing.select((F.lit(slots) + F.col("block") * most + F.col("source_no")).alias("slot"), "source_no", "target", "block")
    every = ranked.select("slot", "source_no", "target", "block").union(missing)
    # the schedule runs on a little so that few blocks are missing; what is beyond a target is left
    return every.withColumn("words", F.least(F.lit(block), F.floor("target") - F.col("block") * block)).where("words > 0").select("slot", "source_no", "block", "words")


def mix(docs: DataFrame, *, text: str = "text", source: str = "source", id: str = "doc_id", weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, repeat: int = 2, block: int = BLOCK) -> DataFrame:
    """A row for each document: id, size, source_size, target, and the words that each pass takes.

    Nothing of a source stands in one partition: offsets in a source come from sums by bucket of
    the shuffling hash, ranks of slots from sums by chunk.
    """
    rows = settle(docs.select(F.col(id).alias("id"), F.col(source).cast("string").alias("source"), words(text).alias("size"), F.xxhash64(F.col(id), F.col(text)).alias("h")))
    goal = settle(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights=weights, share=share, repeat=repeat))
    # only long sums decide offsets, so a rerun agrees
    named = F.broadcast(goal) if goal.count() <= GRID_BROADCAST else goal
    key = F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))
    own = rows.withColumn("key", key).join(named.withColumn("key", key).drop("source"), "key").drop("key")
    own = own.withColumn("bucket", F.shiftrightunsigned("h", 54))
    sums = own.groupBy("source_no", "bucket").agg(F.sum("size").alias("s"))
    earlier = Window.partitionBy("source_no").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("source_no", "bucket", F.coalesce(F.sum("s").over(earlier), F.lit(0)).alias("ahead"))
    inside = Window.partitionBy("source_no", "bucket").orderBy("h", "id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = own.withColumn("offset", F.sum("size").over(inside) - F.col("size")).join(sums, ["source_no", "bucket"])
    own = settle(own.withColumn("offset", F.col("offset") + F.col("ahead")).drop("ahead", "bucket"))

    begin = F.col("offset") + F.col("pass") * F.col("source_size")
    runs = own.where("size > 0 AND target >= 1").select("source_no", "offset", "size", "source_size", F.explode(F.sequence(F.lit(0), F.lit(repeat - 1))).alias("pass")).withColumn("begin", begin)
    runs = runs.select("source_no", "offset", "pass", "begin", (F.col("begin") + F.col("size")).alias("end"), F.explode(F.sequence(F.floor(begin / block), F.floor((begin + F.col("size") - 1) / block))).alias("block"))
    covered = F.least("end", F.col("block") * block + F.col("words")) - F.greatest("begin", F.col("block") * block)
    took = runs.join(schedule(goal, block=block), ["source_no", "block"]).withColumn("n", covered).where("n > 0")
    took = took.groupBy("source_no", "offset").agg(*[F.sum(F.when(F.col("pass") == p, F.col("n")).otherwise(0)).alias(f"p{p}") for p in range(repeat)])
    took = took.select("source_no", "offset", F.lit(1).alias("filled"), F.array(*[f"p{p}" for p in range(repeat)]).alias("passes"))
    out = own.withColumn("filled", F.when(F.col("size") > 0, 1).otherwise(0)).join(took, ["source_no", "offset", "filled"], "left")
    passes = F.coalesce("passes", F.array(*[F.lit(0).cast("long")] * repeat))
    return out.select("id", "h", "source", "size", "source_size", "target", passes.alias("passes"))


def mixed(docs: DataFrame, *, text: str = "text", id: str = "doc_id", **options) -> DataFrame:
    """The mix itself: ``docs`` with a row for each pass that takes words of a document.

    Where a source's target ends inside a document, its text ends there too.
    """
    plan = mix(docs, text=text, id=id, **options)
    same = Window.partitionBy("__h", "__id")
    plan = plan.select(F.col("h").alias("__h"), F.col("id").alias("__id"), F.col("size").alias("__size"), "passes").where(F.exists("passes", lambda n: n > 0))
    plan = plan.withColumn("__n", F.row_number().over(same.orderBy("passes")))
    rows = docs.withColumns({"__h": F.xxhash64(F.col(id), F.col(text)), "__id": F.col(id)})
    rows = rows.withColumn("__n", F.row_number().over(same.orderBy("__h")))
    on = (rows["__h"] == plan["__h"]) & rows["__id"].eqNullSafe(plan["__id"]) & (rows["__n"] == plan["__n"])
    out = rows.join(plan, on).select(*[rows[c] for c in docs.columns], "__size", F.explode(F.filter("passes", lambda n: n > 0)).alias("__words"))
    cut = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0)), 1, F.col("__words").cast("int")), "")
    return out.withColumn(text, F.when(F.col("__words") < F.col("__size"), cut).otherwise(F.col(text))).select(*docs.columns)


def op6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source"))
    taken = F.aggregate("passes", F.lit(0).cast("long"), lambda a, x: a + x)
    return out.select(F.col("id").alias("doc_id"), "size", "source_size", "target", taken.alias("taken"), "source")
