"""Benchmark decontamination: a broadcast set of normalised test n-grams scans training windows.

Words are runs of ASCII letters and digits and of all non-ASCII characters, with A-Z lower-cased.
Every run of ``window`` words of a benchmark item is a window; an item of fewer words, but not
none, is one window.  A document's words inside an occurrence of a window are hit.

Defined results: a null or empty text has no words and no hits; a null benchmark text has no
windows; items with equal windows are all reported; a null item id is reported nowhere, though
its windows hit; repeated benchmark rows count once; an empty benchmark hits nothing; repeated
documents are scanned one by one; ties don't arise, since every occurrence counts; very long texts
are scanned whole.  Columns of ``docs`` stay as they are, except that one named like the result is
replaced.

A benchmark beyond one broadcast is scanned for in blocks.  Documents are then written once, with
row numbers; a block settles the hits of documents that have any, and the last block's scan takes
them in.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import ArrowUDFType

from . import textscan as ts
from .store import settle

SHAPE = "struct<n_words:bigint,n_hit:bigint,words:array<struct<start:int,end:int>>,spans:array<struct<start:int,end:int>>,items:array<string>>"
#: Benchmark text broadcast at once; larger benchmarks are scanned in blocks of this size.
BLOCK_BYTES = 16 << 20


class Windows:
    """Sorted window hashes of a block of items, with what is needed to verify a hit."""

    def __init__(self, items: list[str | None], texts: list[str], window: int):
        piece = next(ts.pieces(pa.array(texts, pa.large_string()), 1 << 62), None)
        self.items, self.by_size = items, []
        if piece is None:
            return
        t = ts.tokens(piece, ts.ALNUM)
        hashes, doc, counts = t.hashes(), t.doc(), np.diff(t.bounds)
        self.text, self.start, self.end = t.lower.tobytes(), t.start, t.end
        for size in sorted({min(int(c), window) for c in counts if c}):
            at, h = ts.window_hashes(t, hashes, size)
            if size < window:
                keep = counts[doc[at]] == size
                at, h = at[keep], h[keep]
            order = np.argsort(h, kind="stable")
            at, h = at[order], h[order]
            # equal windows stand together: one is verified for all of their items
            edge = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            same: list[dict] = []
            for a, b in zip(edge.tolist(), [*edge[1:].tolist(), len(h)]):
                owners: dict[tuple, set] = {}
                for k in range(a, b):
                    owners.setdefault(tuple(self.words(int(at[k]), size)), set()).add(int(doc[at[k]]))
                same.append({w: sorted(x) for w, x in owners.items()})
            bits = np.zeros(1 << 20, bool)
            bits[(h >> np.uint64(44)).astype(np.int64)] = True
            self.by_size.append((size, h[edge], same, bits))

    def words(self, at: int, size: int) -> list[bytes]:
        return [self.text[a:b] for a, b in zip(self.start[at : at + size].tolist(), self.end[at : at + size].tolist())]


def _scan(piece: ts.Piece, known: Windows) -> tuple[ts.Tokens, list[tuple[int, int, int]]]:
    """Verified (first word, size, item) of all occurrences, first word in the piece."""
    t = ts.tokens(piece, ts.ALNUM)
    hashes, found, text = t.hashes(), [], None
    for size, h, same, bits in known.by_size:
        first, own = ts.window_hashes(t, hashes, size)
        maybe = bits[(own >> np.uint64(44)).astype(np.int64)]
        first, own = first[maybe], own[maybe]
        at = np.minimum(np.searchsorted(h, own), len(h) - 1)
        hit = h[at] == own
        for w, k in zip(first[hit].tolist(), at[hit].tolist()):
            text = t.lower.tobytes() if text is None else text
            here = tuple(text[a:b] for a, b in zip(t.start[w : w + size].tolist(), t.end[w : w + size].tolist()))
            found += [(w, size, i) for i in same[k].get(here, ())]
    return t, found


def _characters(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Code points before byte positions."""
    return np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[at]


def _documents(column: pa.Array, known: Windows) -> Iterator[dict]:
    for piece in ts.pieces(column):
        t, found = _scan(piece, known)
        if not found:
            yield from ({"n_words": n, "n_hit": 0, "words": [], "spans": [], "items": []} for n in np.diff(t.bounds).tolist())
            continue
        step = np.zeros(len(t.start) + 1, np.int64)
        for w, size, _ in found:
            step[w] += 1
            step[w + size] -= 1
        hit = np.cumsum(step)[:-1] > 0
        where = np.searchsorted(t.bounds, [w for w, _, _ in found], "right") - 1
        items: dict[int, set[str]] = {}
        for d, (_, _, i) in zip(where.tolist(), found):
            if known.items[i] is not None:
                items.setdefault(d, set()).add(known.items[i])
        touched = set(where.tolist())
        for d, (a, b) in enumerate(zip(t.bounds[:-1].tolist(), t.bounds[1:].tolist())):
            if d not in touched:
                yield {"n_words": b - a, "n_hit": 0, "words": [], "spans": [], "items": []}
                continue
            edge = np.diff(np.concatenate([[0], hit[a:b].astype(np.int8), [0]]))
            lo, hi = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
            base = piece.bounds[d]
            own = t.lower[base : piece.bounds[d + 1]]
            c0, c1 = _characters(own, t.start[a + lo] - base), _characters(own, t.end[a + hi - 1] - base)
            yield {
                "n_words": b - a, "n_hit": int(hit[a:b].sum()),
                "words": [{"start": x, "end": y} for x, y in zip(lo.tolist(), hi.tolist())],
                "spans": [{"start": x, "end": y} for x, y in zip(c0.tolist(), c1.tolist())],
                "items": sorted(items.get(d, ())),
            }


ARROW = pa.struct([
    ("n_words", pa.int64()), ("n_hit", pa.int64()),
    ("words", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
    ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
    ("items", pa.list_(pa.string())),
])


def _rows(benchmark: DataFrame, item: str, text: str) -> DataFrame:
    return benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).alias("text")).where("text IS NOT NULL").distinct().orderBy("item", "text")


def _sizes(benchmark: DataFrame, item: str, text: str, block_bytes: int) -> Iterator[int]:
    """Lengths of the blocks in items."""
    n = held = 0
    for row in _rows(benchmark, item, text).select(F.length("text").alias("n")).toLocalIterator():
        if n and held + row.n > block_bytes // 2:
            yield n
            n = held = 0
        n, held = n + 1, held + row.n
    yield n


def _blocks(benchmark: DataFrame, item: str, text: str, block_bytes: int) -> Iterator[tuple[list, list]]:
    """The benchmark in blocks of bounded size, one at a time on the driver; an item stays whole."""
    items, texts, held = [], [], 0
    for row in _rows(benchmark, item, text).toLocalIterator():
        if texts and held + len(row.text) > block_bytes // 2:
            yield items, texts
            items, texts, held = [], [], 0
        items.append(row.item)
        texts.append(row.text)
        held += len(row.text)
    yield items, texts


def find_contamination(docs: DataFrame, benchmark: DataFrame, *, window: int = 13, text: str = "text", item: str = "item_id", item_text: str = "text", result: str = "contamination", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with a struct column: words, words hit, hit runs by word and by character, items.

    One scan of ``docs`` without a shuffle for each block of the benchmark; blocks bound what is
    broadcast and what the driver holds.
    """
    spark = docs.sparkSession
    blocks = list(_sizes(benchmark, item, item_text, block_bytes))
    out = docs if len(blocks) == 1 else settle(docs.withColumn("__row", F.monotonically_increasing_id()))
    more = None
    for n, (items, texts) in enumerate(_blocks(benchmark, item, item_text, block_bytes)):
        known = spark.sparkContext.broadcast((items, texts, window))

        @ts.lean
        def scan(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
            windows = Windows(*known.value)
            for column in columns:
                yield pa.array(_documents(column, windows), ARROW)

        found = F.arrow_udf(scan, returnType=SHAPE, functionType=ArrowUDFType.SCALAR_ITER)(F.col(text))
        if n + 1 == len(blocks):
            break
        hits = settle(out.select("__row", found.alias("__f")).where("__f.n_hit > 0"))
        more = hits if more is None else more.union(hits)
    if more is None:
        return out.withColumn(result, found)
    # the word positions of a text don't depend on the block, so spans can be united
    more = more.groupBy("__row").agg(F.collect_list("__f").alias("__more"))
    merge = F.arrow_udf(_merged, returnType=SHAPE, functionType=ArrowUDFType.SCALAR)
    out = out.withColumn(result, found).join(more, "__row", "left")
    return out.withColumn(result, F.when(F.col("__more").isNull(), F.col(result)).otherwise(merge(F.col(result), F.col("__more")))).drop("__row", "__more")


def _united(spans: list[dict]) -> list[dict]:
    out: list[dict] = []
    for s in sorted(spans, key=lambda s: (s["start"], s["end"])):
        if out and s["start"] <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], s["end"])
        else:
            out.append(dict(s))
    return out


def _merged(last: pa.Array, others: pa.Array) -> pa.Array:
    rows = []
    for x, more in zip(last.to_pylist(), others.to_pylist()):
        each = [x, *(more or [])]
        runs, places = [w for y in each for w in y["words"]], [s for y in each for s in y["spans"]]
        words = _united(runs)
        items = sorted({i for y in each for i in y["items"]})
        rows.append({"n_words": x["n_words"], "n_hit": sum(w["end"] - w["start"] for w in words), "words": words, "spans": _joined(words, runs, places), "items": items})
    return pa.array(rows, ARROW)


def _joined(words: list[dict], runs: list[dict], spans: list[dict]) -> list[dict]:
    """Character spans of united word runs; runs that meet also cover what is between them."""
    out = []
    for w in words:
        own = [s for r, s in zip(runs, spans) if w["start"] <= r["start"] and r["end"] <= w["end"]]
        out.append({"start": min(s["start"] for s in own), "end": max(s["end"] for s in own)})
    return out


def contaminated(result: str = "contamination", share: int = 20):
    """At least one word in ``share`` is hit."""
    hit, words = F.col(f"{result}.n_hit"), F.col(f"{result}.n_words")
    return (hit > 0) & (hit * share >= words)


def remove_contamination(docs: DataFrame, benchmark: DataFrame, *, spans: bool = False, share: int = 20, text: str = "text", result: str = "__contamination", **options) -> DataFrame:
    """Drop contaminated documents, or with ``spans`` cut the hit passages out of every text.

    ``result`` names a column of the way only, so it must not be one of ``docs``.
    """
    found = find_contamination(docs, benchmark, text=text, result=result, **options)
    if not spans:
        return found.where(~contaminated(result, share)).select(*docs.columns)
    cut = F.aggregate(
        F.col(f"{result}.spans"),
        F.struct(F.lit("").alias("kept"), F.lit(0).alias("at")),
        lambda s, x: F.struct(F.concat(s["kept"], F.substring(F.col(text), s["at"] + 1, x["start"] - s["at"])).alias("kept"), x["end"].alias("at")),
        lambda s: F.concat(s["kept"], F.substring(F.col(text), s["at"] + 1, F.length(text))),
    )
    return found.withColumn(text, F.when(F.col(text).isNotNull(), cut)).select(*docs.columns)


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    c = "contamination"
    return found.select(
        "doc_id", F.col(f"{c}.n_words").alias("n_words"), F.col(f"{c}.n_hit").alias("n_hit"), F.size(f"{c}.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(f"{c}.items", ","), 256).alias("items_sha256"), contaminated().alias("contaminated"),
    )


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), bw AS (
  SELECT DISTINCT item, least(len(w), 13) AS n, array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS k
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS i FROM b WHERE len(w) > 0)
), dw AS (
  SELECT r, n, i, array_to_string(w[i : i + n - 1], ' ') AS k FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)
), hit AS (
  SELECT dw.r, dw.i, dw.n, bw.item FROM dw JOIN bw USING (n, k)
), words AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r
), items AS (
  SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM hit WHERE item IS NOT NULL GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""


def brute_force(docs: list[tuple], items: list[tuple], window: int = 13) -> list[tuple]:
    """The contract of op1 on plain Python values, for tests."""
    import re

    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    split = lambda s: word.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s or ""))
    grams = {}
    for i, s in items:
        w = split(s)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            grams.setdefault(tuple(w[k : k + window]), set()).add(str(i))
    out = []
    for d, s in docs:
        w, hit, ids = split(s), set(), set()
        for size in {len(g) for g in grams}:
            for k in range(len(w) - size + 1):
                if (g := tuple(w[k : k + size])) in grams:
                    hit |= set(range(k, k + size))
                    ids |= grams[g]
        out.append((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return out
