"""An exact n-gram Jaccard join that skips by set relations.

A document's set are its distinct shingles of five words.  Under one order of all shingles, two
sets that are similar enough share a shingle among the first fifth of each.  An index by shingle
of these prefixes keeps sizes and positions, by which whole blocks of a list are skipped: a shared
shingle at some position bounds the overlap.  What is left of a list forms a group around its
least member, the pivot.

A group is answered from the pivot's answers: overlaps with every member are counted once for the
pivot, and a similar set's overlaps follow from them by the postings of the shingles in which the
two sets differ.  Members linked with the pivot need no answers of their own for components.

Shingles that stand in many texts come last in the order.  They are counted batch by batch over
all texts; the order changes what is compared, never what is found.

Defined results: a null text or one without words has an empty set and is linked with nothing; a
text of fewer words than a shingle is one shingle; equal texts are one set; null ids are never a
component's name, unless all of its ids are null; ties don't arise, since only the least id names a
component; repeated rows are copies; very long texts are one set like all others; an empty table
gives an empty result.

Texts are named by a hash that is checked against a second one; texts that share the first are
named by the second.  Candidates come from hashes of shingles, and links are decided by the words
themselves, numbered within a group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import ArrowUDFType

from . import textscan as ts
from .components import components, lookup
from .store import forget, settle

SHINGLE = 5
#: A pair is linked from NUM / DEN on.
NUM, DEN = 4, 5
#: Shingles held as frequent at most, and the documents of a batch from which one counts as such.
FREQUENT, BATCH_COUNT = 100_000, 8
#: Texts of an Arrow batch.
BATCH = 2000
#: Bytes of index that one task gets; entries from which a list isn't gathered.
BUCKET_BYTES, HOT_LIST = 4 << 20, 500_000
#: Members of a group whose bitmaps one task compares, and whose texts it compares.
GROUP, PART = 1500, 300
#: Rows of candidates that are compared together, besides what one group has.
TASK_ROWS = 300
#: Rows of candidates up to which they are broadcast; beyond, texts are shuffled to them.
BROADCAST_ROWS = 1_000_000

ENTRY = np.dtype([("key", "<u8"), ("text", "<i8"), ("n", "<u4"), ("at", "<u4")])
NONE = np.zeros(0, np.uint64)


def shingle_sets(piece: ts.Piece, size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each document."""
    t = ts.tokens(piece, ts.SPACED)
    words = np.diff(t.bounds)
    if not len(t.start):
        return [NONE] * piece.count
    g = ts.prefix_hash(t.hashes(), ts.WORDS)
    length = np.minimum(words, size)
    runs = np.maximum(words - size + 1, np.minimum(words, 1))
    doc = np.repeat(np.arange(piece.count), runs)
    first = np.arange(len(doc)) - np.repeat(np.cumsum(runs) - runs, runs) + t.bounds[:-1][doc]
    h = ts.mix(ts.run_hash(g, first, first + length[doc], ts.WORDS) + length[doc].astype(np.uint64))
    edge = np.cumsum(np.concatenate([[0], runs])).tolist()
    return [np.unique(h[a:b]) if b > a else NONE for a, b in zip(edge[:-1], edge[1:])]


SHAPE = "struct<n:bigint,bits:binary,frequent:array<struct<h:bigint,n:bigint>>>"
ARROW = pa.struct([("n", pa.int64()), ("bits", pa.binary()), ("frequent", pa.list_(pa.struct([("h", pa.int64()), ("n", pa.int64())])))])


def bitmap(s: np.ndarray) -> bytes:
    """A bit for each shingle by the low bits of its hash, two to four bits a shingle."""
    size = max(64, 1 << int(2 * len(s) - 1).bit_length()) if len(s) else 64
    bits = np.zeros(size, np.uint8)
    bits[(s & np.uint64(size - 1)).astype(np.int64)] = 1
    return np.packbits(bits).tobytes()


@ts.lean
def _profile(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Set sizes and bitmaps; a batch's frequent shingles ride on its first row."""
    for column in columns:
        sizes, bits, held = [], [], []
        for p in ts.pieces(column):
            sets = shingle_sets(p)
            sizes += [len(s) for s in sets]
            bits += [bitmap(s) for s in sets]
            held.append(np.concatenate([NONE, *sets]))
        every = np.concatenate([NONE, *held])
        del held
        every.sort()
        # a shingle stands often if the same one is so many places further on
        often = every[: max(0, len(every) - BATCH_COUNT + 1)]
        often = np.unique(often[often == every[BATCH_COUNT - 1 :]])
        n = np.searchsorted(every, often, "right") - np.searchsorted(every, often, "left")
        del every
        rows = [{"n": k, "bits": x, "frequent": None} for k, x in zip(sizes, bits)]
        if rows:
            rows[0]["frequent"] = [{"h": h, "n": c} for h, c in zip(often.view(np.int64).tolist(), n.tolist())]
        yield pa.array(rows, ARROW)


def order_keys(s: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Keys of the common order: hashes, and above them all the frequent shingles by rank."""
    keys = s >> np.uint64(1)
    if len(frequent):
        rank = frequent[1]
        at = np.minimum(np.searchsorted(frequent[0], s), len(rank) - 1)
        hit = frequent[0][at] == s
        keys[hit] = rank[at[hit]] | np.uint64(1 << 63)
    return keys


def prefix(n: int) -> int:
    return n - -(-n * NUM // DEN) + 1


def _index(buckets: int, frequent):
    @ts.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = frequent.value
        for batch in batches:
            texts = batch.column(0).to_numpy(zero_copy_only=False)
            parts, seen = [], set()
            for p in ts.pieces(batch.column(1)):
                for k, s in enumerate(shingle_sets(p)):
                    text = int(texts[p.first + k])
                    if not len(s) or text in seen:
                        continue
                    seen.add(text)
                    keys = np.sort(order_keys(s, known))[: prefix(len(s))]
                    e = np.empty(len(keys), ENTRY)
                    e["key"], e["text"], e["n"], e["at"] = keys, text, len(s), np.arange(len(keys))
                    parts.append(e)
            if not parts:
                continue
            every = np.concatenate(parts)
            bucket = (ts.mix(every["key"].copy()) % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            every, bucket = every[order], bucket[order]
            edge = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
            data = [every[a:b].tobytes() for a, b in zip(edge.tolist(), [*edge[1:].tolist(), len(every)])]
            yield pa.RecordBatch.from_arrays([pa.array(bucket[edge]), pa.array(data, pa.binary())], names=["bucket", "data"])

    return run


def _starts(*columns: np.ndarray) -> np.ndarray:
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _skip(e: np.ndarray, band: np.ndarray, least: np.ndarray | None = None) -> tuple[np.ndarray, int, int]:
    """(entries that stay, blocks, blocks skipped), for entries in order of key, band, size and position.

    A first shared shingle at position i of a set of n leaves an overlap of n - i at most, so the
    other set has at most (1 + 1/t) (n - i) - n shingles.  For a block, sets of one size in one
    list, that and the list's least size give the last position to read.
    """
    n, at = e["n"].astype(np.int64), e["at"].astype(np.int64)
    lists, blocks = _starts(e["key"], band), _starts(e["key"], band, e["n"])
    if least is None:  # sizes ascend in a list
        least = n[lists][np.searchsorted(lists, blocks, "right") - 1]
    else:
        least = least[blocks]
    last = (DEN * n[blocks] - NUM * least) // (NUM + DEN)
    read = np.flatnonzero(at[blocks] <= last)
    begin, end = blocks[read], np.append(blocks[1:], len(e))[read]
    # bisection of all blocks at once
    lo, hi = begin.copy(), end.copy()
    while (lo < hi).any():
        mid = (lo + hi) // 2
        right = (lo < hi) & (at[np.minimum(mid, len(e) - 1)] <= last[read])
        lo, hi = np.where(right, mid + 1, lo), np.where(right | (lo >= hi), hi, mid)
    count = lo - begin
    stay = np.arange(count.sum()) + np.repeat(begin - np.cumsum(count) + count, count)
    return stay, len(blocks), len(blocks) - len(read)


def _entries(data: list[bytes]) -> np.ndarray:
    """Entries of packed rows, a text once in a list."""
    e = np.concatenate([np.empty(0, ENTRY), *[np.frombuffer(x, ENTRY) for x in data]])
    e = e[np.lexsort((e["text"], e["key"]))]
    return e[_starts(e["key"], e["text"])]


def _banded(e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lists by key and band of sizes, in order: sizes of linked sets differ by 1 / t at most, so
    they are in one band or in neighbouring ones, and every set stands in two."""
    band = np.floor(np.log(np.maximum(e["n"], 1)) / np.log(DEN / NUM) * (1 - 1e-12)).astype(np.int64)
    e, band = np.concatenate([e, e]), np.concatenate([band, band + 1])
    order = np.lexsort((e["text"], e["at"], e["n"], band, e["key"]))
    return e[order], band[order]


def _pairs(text: np.ndarray, pivot: np.ndarray) -> np.ndarray:
    return np.unique(np.stack([text, pivot], axis=1), axis=0) if len(text) else np.zeros((0, 2), np.int64)


@ts.lean
def _lists(buckets: pa.Table) -> pa.Table:
    """(text, pivot) for every list that can hold a linked pair."""
    e = _entries(buckets.column("data").to_pylist())
    n = np.diff(np.append(_starts(e["key"]), len(e)))
    e, band = _banded(e[np.repeat(n > 1, n)])
    for _ in range(2):
        stay, _, _ = _skip(e, band)
        e, band = e[stay], band[stay]
        n = np.diff(np.append(_starts(e["key"], band), len(e)))
        many = np.repeat(n > 1, n)
        e, band = e[many], band[many]
    starts = _starts(e["key"], band)
    pivot = np.repeat(np.minimum.reduceat(e["text"], starts), np.diff(np.append(starts, len(e)))) if len(e) else e["text"]
    pairs = _pairs(e["text"], pivot)
    return pa.table({"text": pairs[:, 0], "pivot": pairs[:, 1]})


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Least text, least size and count of each list in a packed row."""
    for batch in batches:
        for data in batch.column("data"):
            e, band = _banded(_entries([data.as_py()]))
            starts = _starts(e["key"], band)
            if len(starts):
                columns = [e["key"][starts].view(np.int64), band[starts], np.minimum.reduceat(e["text"], starts), e["n"][starts].astype(np.int64), np.diff(np.append(starts, len(e)))]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns)], names=["key", "band", "pivot", "least", "n"])


def _hot_pairs(hot):
    """(text, pivot) of entries in hot lists, read block by block where they lie."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, bands, pivots, leasts = hot.value
        for batch in batches:
            for data in batch.column("data"):
                e, band = _banded(_entries([data.as_py()]))
                at = _place(keys, bands, e["key"], band)
                e, band, at = e[at >= 0], band[at >= 0], at[at >= 0]
                if len(e):
                    stay, _, _ = _skip(e, band, leasts[at])
                    pairs = _pairs(e["text"][stay], pivots[at[stay]])
                    yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["text", "pivot"])

    return run


def _place(keys: np.ndarray, bands: np.ndarray, key: np.ndarray, band: np.ndarray) -> np.ndarray:
    """Places of (key, band) in a table of distinct ones, -1 where they aren't in it."""
    k, b = np.concatenate([keys, key]), np.concatenate([bands, band])
    order = np.lexsort((b, k))  # stable, so that the table's row comes first
    starts = _starts(k[order], b[order])
    first = np.empty(len(k), np.int64)
    first[order] = np.repeat(order[starts], np.diff(np.append(starts, len(order))))
    return np.where(first < len(keys), first, -1)[len(keys) :]


def _without(hot):
    """Packed rows without the entries of keys that have a hot list in each band they are in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, bands, _, _ = hot.value
        for batch in batches:
            rows = []
            for data in batch.column("data"):
                e = _entries([data.as_py()])
                band = np.floor(np.log(np.maximum(e["n"], 1)) / np.log(DEN / NUM) * (1 - 1e-12)).astype(np.int64)
                gone = (_place(keys, bands, e["key"], band) >= 0) & (_place(keys, bands, e["key"], band + 1) >= 0)
                rows.append(e[~gone].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("bucket"), pa.array(rows, pa.binary())], names=["bucket", "data"])

    return run


def exact_sets(bodies: pa.Array, size: int = SHINGLE) -> list[np.ndarray]:
    """The shingles of each text as sorted numbers; equal numbers are equal words, one by one."""
    words, bounds = [], [np.zeros(1, np.int64)]
    for p in ts.pieces(bodies):
        t = ts.tokens(p, ts.SPACED)
        words.append(ts.gather(t.lower, t.start, t.end))
        bounds.append(bounds[-1][-1] + t.bounds[1:])
    bounds = np.concatenate(bounds)
    if not bounds[-1]:
        return [NONE] * (len(bounds) - 1)
    coded = pa.chunked_array(words).dictionary_encode().combine_chunks()
    coded = coded if isinstance(coded, pa.DictionaryArray) else coded.chunk(0)
    ids = np.append(coded.indices.to_numpy().astype(np.int64), np.zeros(size, np.int64))
    n = np.diff(bounds)
    runs, length = np.maximum(n - size + 1, np.minimum(n, 1)), np.minimum(n, size)
    doc = np.repeat(np.arange(len(n)), runs)
    first = np.arange(len(doc)) - np.repeat(np.cumsum(runs) - runs, runs) + bounds[:-1][doc]
    name = length[doc]
    for k in range(size):  # numbers of runs, a word longer each round
        word = np.where(k < length[doc], ids[first + k] + 1, 0)
        name = np.unique(name * (len(coded.dictionary) + 2) + word, return_inverse=True)[1]
    edge = np.concatenate([[0], np.cumsum(runs)])
    return [np.unique(name[a:b]) for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())]


class Group:
    """Sets with a posting list for each shingle."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets])
        every = np.concatenate(sets)
        self.values, ids = np.unique(every, return_inverse=True)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        edge = np.concatenate([[0], np.cumsum(self.sizes)])
        self.ids = [ids[a:b] for a, b in zip(edge[:-1], edge[1:])]  # ascending, like the sets
        self.owners = owner[np.argsort(ids, kind="stable")]
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(ids, minlength=len(self.values)))])

    def _count(self, ids: np.ndarray) -> np.ndarray:
        """For each set, how many of these shingles it has."""
        n = self.starts[ids + 1] - self.starts[ids]
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - self.starts[ids], n)
        return np.bincount(self.owners[at], minlength=len(self.sizes))

    def overlaps(self, k: int, like: tuple[int, np.ndarray] | None = None) -> np.ndarray:
        """Overlaps of set k with all; from those of a similar set by what differs."""
        if like:
            less, more = np.setdiff1d(self.ids[like[0]], self.ids[k], True), np.setdiff1d(self.ids[k], self.ids[like[0]], True)
            if len(less) + len(more) < len(self.ids[k]):
                return like[1] - self._count(less) + self._count(more)
        return self._count(self.ids[k])

    def linked(self, k: int, overlap: np.ndarray) -> np.ndarray:
        union = self.sizes + self.sizes[k] - overlap
        return (DEN * overlap >= NUM * union) & (overlap > 0)


class Classes:
    """Classes of a group's members, by a label for each; links that join no classes are left out."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, k: int, to: np.ndarray) -> np.ndarray:
        """Join k's class with those of the members ``to``; one member of each class that was another."""
        label, one = np.unique(self.label[to], return_index=True)
        other = label != self.label[k]
        self.label[np.isin(self.label, label[other])] = self.label[k]
        return to[one[other]]


@ts.lean
def _near(table: pa.Table) -> pa.Table:
    """Groups of sets that their bitmaps don't keep apart, in place of the groups around pivots.

    A bit that one set has and the other hasn't stands for a shingle that they don't share.  Linked
    sets are in one class of what is left; sets that have nobody left are done.
    """
    pivot, text, n = (table.column(c).to_numpy() for c in ("pivot", "text", "n"))
    bits = table.column("bits").to_pylist()
    order = np.lexsort((text, pivot))
    edge = _starts(pivot[order])
    out = []
    for a, b in zip(edge.tolist(), [*edge[1:].tolist(), len(order)]):
        own = order[a:b]
        own = own[_starts(text[own])]
        if len(own) < 2:
            continue
        size, least = n[own], min(len(bits[k]) for k in own.tolist())
        maps = np.empty((len(own), least // 8), np.uint64)
        for i, k in enumerate(own.tolist()):  # a larger bitmap folds to a smaller one
            maps[i] = np.bitwise_or.reduce(np.frombuffer(bits[k], np.uint8).reshape(-1, least), axis=0).view(np.uint64)
        classes = Classes(len(own))
        for k in range(len(own) - 1):
            rest = np.arange(k + 1, len(own))
            rest = rest[classes.label[rest] != classes.label[k]]
            lacks = np.bitwise_count(maps[k] & ~maps[rest]).sum(axis=1, dtype=np.int64)
            most = size[k] - lacks
            more = np.bitwise_count(maps[rest] & ~maps[k]).sum(axis=1, dtype=np.int64)
            most = np.minimum(most, size[rest] - more)
            classes.join(k, rest[(NUM + DEN) * most >= NUM * (size[k] + size[rest])])
        label, inverse, many = np.unique(classes.label, return_inverse=True, return_counts=True)
        stay = many[inverse] > 1
        first = np.full(len(label), np.iinfo(np.int64).max)
        np.minimum.at(first, inverse, text[own])
        out.append(np.stack([text[own][stay], first[inverse][stay]], axis=1))
    pairs = np.unique(np.concatenate(out), axis=0) if out else np.zeros((0, 2), np.int64)
    return pa.table({"text": pairs[:, 0], "pivot": pairs[:, 1]})


@ts.lean
def _compare(table: pa.Table) -> pa.Table:
    """Links that suffice for the components of each group, and who is not linked with the pivot.

    role: 0 a member, 1 one to be compared with all members, 2 the pivot.  Where some are marked 1,
    only they ask; otherwise the pivot does, and then all that it isn't linked with.
    """
    role, text, pivot, part, block = (table.column(c).to_numpy() for c in ("role", "text", "pivot", "part", "block"))
    bodies = table.column("body").combine_chunks()
    order = np.lexsort((-role, text, block, part, pivot))
    order = order[_starts(pivot[order], part[order], block[order], text[order])]  # a text may stand in several documents
    edge = _starts(pivot[order], part[order], block[order])
    a, b, linked = [], [], []
    for i, j in zip(edge.tolist(), [*edge[1:].tolist(), len(order)]):
        own = order[i:j]
        if len(own) > 1:
            x, y, rest = _links(role[own], text[own], bodies.take(pa.array(own)))
            a += [*x, *[int(pivot[own[0]])] * len(rest)]
            b += [*y, *rest]
            linked += [True] * len(x) + [False] * len(rest)
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "linked": pa.array(linked, pa.bool_())})


def _links(role: np.ndarray, texts: np.ndarray, bodies: pa.Array) -> tuple[list[int], list[int], list[int]]:
    g = Group(exact_sets(bodies))
    classes, a, b = Classes(len(texts)), [], []

    def link(k: int, overlap: np.ndarray) -> np.ndarray:
        to = np.flatnonzero(g.linked(k, overlap))
        for t in classes.join(k, to[to != k]).tolist():
            a.append(int(texts[k]))
            b.append(int(texts[t]))
        return to

    if (role == 1).any():
        last = None
        for k in np.flatnonzero(role == 1).tolist():
            last = (k, g.overlaps(k, last))
            link(k, last[1])
        return a, b, []
    if not (role == 2).any():
        return a, b, []
    pivot = int(np.flatnonzero(role == 2)[0])
    last = first = (pivot, g.overlaps(pivot))
    away = np.ones(len(texts), bool)
    away[link(pivot, first[1])] = away[pivot] = False
    rest = np.flatnonzero(away)
    # the most similar first, so that each one's answers follow from the last one's
    for k in rest[np.argsort(-first[1][rest], kind="stable")].tolist():
        last = (k, g.overlaps(k, last))
        link(k, last[1])
    return a, b, texts[rest].tolist()


def _heavy(index: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The index without hot lists, and their (text, pivot); a hot list is never in one task.

    Only buckets beyond their share are looked into.  Hot lists are as many as the whole index has
    entries over HOT_LIST at most, which bounds what the driver sees.
    """
    spark = index.sparkSession
    size = F.sum(F.octet_length("data"))
    heavy = index.groupBy("bucket").agg(size.alias("bytes")).where(F.col("bytes") > max(4 * BUCKET_BYTES, HOT_LIST * ENTRY.itemsize)).select("bucket")
    heavy = [r.bucket for r in heavy.collect()]  # fewer than a fourth of the buckets
    if not heavy:
        return index, None
    own = index.where(F.col("bucket").isin(heavy))
    lists = own.select("data").mapInArrow(_partial, "key bigint, band bigint, pivot bigint, least bigint, n bigint")
    lists = lists.groupBy("key", "band").agg(F.min("pivot").alias("pivot"), F.min("least").alias("least"), F.sum("n").alias("n"))
    hot = lists.where(F.col("n") > HOT_LIST).drop("n").toArrow()
    if not len(hot):
        return index, None
    columns = [hot.column(c).to_numpy() for c in ("key", "band", "pivot", "least")]
    known = spark.sparkContext.broadcast((columns[0].view(np.uint64), *columns[1:]))
    rest = own.mapInArrow(_without(known), "bucket int, data binary")
    return index.where(~F.col("bucket").isin(heavy)).union(rest), own.select("data").mapInArrow(_hot_pairs(known), "text bigint, pivot bigint")


def name(text: Column) -> Column:
    return F.xxhash64(text)


def check(text: Column) -> Column:
    """Beside name(): two texts with both in common are one text."""
    return F.xxhash64(F.lit(0x51CED), F.length(text), text)


def names(rows: DataFrame) -> list[int]:
    """Names that several texts share, of rows with ``key`` and ``check``; by chance there are none
    or a few."""
    shared = rows.groupBy("key").agg(F.min("check").alias("a"), F.max("check").alias("b")).where("a <> b").select("key")
    shared = [r.key for r in shared.limit(10_001).collect()]
    if len(shared) > 10_000:
        raise ValueError("over 10,000 names are shared by several texts")
    return shared


def resolved(shared: list[int]) -> Column:
    return F.when(F.col("key").isin(shared), F.col("check")).otherwise(F.col("key")) if shared else F.col("key")


def links(docs: DataFrame, rows: DataFrame, *, text: str = "text", id: str = "doc_id", shared: list[int] = ()) -> DataFrame:
    """Links (a, b) between text keys that suffice for components; ``rows`` has id, key, n, bits, frequent."""
    spark = docs.sparkSession
    keyed = docs.select(name(F.col(text)).alias("key"), check(F.col(text)).alias("check"), F.col(id).alias("id"), F.col(text).alias("body"))
    keyed = keyed.select(resolved(shared).alias("key"), "id", "body")
    shingles = rows.agg(F.sum("n")).first()[0] or 0
    counts = rows.select(F.explode("frequent").alias("f")).groupBy("f.h").agg(F.sum("f.n").alias("n"))
    top = counts.orderBy(F.desc("n"), "h").limit(FREQUENT).toArrow()  # FREQUENT rows at most
    h, n = top.column("h").to_numpy().view(np.uint64), top.column("n").to_numpy()
    rank = np.empty(len(h), np.uint64)
    rank[np.lexsort((h, n))] = np.arange(len(h), dtype=np.uint64)
    order = np.argsort(h)
    frequent = spark.sparkContext.broadcast((h[order], rank[order]) if len(h) else ())

    buckets = max(16, -(-int(shingles * (DEN - NUM) / DEN * ENTRY.itemsize) // BUCKET_BYTES))
    index = keyed.select("key", "body").mapInArrow(_index(buckets, frequent), "bucket int, data binary")
    # a hot list is one of a frequent shingle; where there is none, the index goes to its buckets at once
    written = [settle(index, batch=BATCH)] if len(n) and n.max() > HOT_LIST else []
    cool, hot = _heavy(written[0]) if written else (index, None)
    found = cool.groupBy("bucket").applyInArrow(_lists, "text bigint, pivot bigint")
    pairs = settle((found.union(hot) if hot is not None else found).distinct(), batch=BATCH)
    forget(spark, *written)

    # groups that one task can hold lose what bitmaps keep apart; larger ones go on whole
    several = pairs.groupBy("pivot").agg(F.count("*").alias("members"))
    sized = pairs.join(several, "pivot")
    held = sized.where(F.col("members") <= GROUP).join(rows.dropDuplicates(["key"]).select(F.col("key").alias("text"), "n", "bits"), "text")
    tasks = max(4, pairs.count() // TASK_ROWS)
    held = held.withColumn("task", F.pmod(F.xxhash64("pivot"), F.lit(tasks)).cast("int"))
    near = held.groupBy("task").applyInArrow(_near, "text bigint, pivot bigint").distinct()
    pairs = settle(near.union(sized.where(F.col("members") > GROUP).select("text", "pivot")).distinct())

    # groups of any size: members are dealt to parts, and the pivot to all of them
    parts = pairs.groupBy("pivot").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts"))
    dealt = pairs.join(parts, "pivot").withColumn("pivotal", F.col("text") == F.col("pivot"))
    dealt = dealt.select("text", "pivot", "parts", F.explode(F.when(F.col("pivotal"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(F.pmod(F.xxhash64("text"), F.col("parts")).cast("int")))).alias("part"), F.when(F.col("pivotal"), 2).otherwise(0).alias("role"))
    one = rows.groupBy("key").agg(F.min("id").alias("one"))
    dealt = settle(dealt.join(one, dealt["text"] == one["key"]).drop("key"))

    def compared(who: DataFrame) -> DataFrame:
        n = who.count()
        small = F.broadcast(who) if n <= BROADCAST_ROWS else who
        there = keyed.join(small, (keyed["key"] == small["text"]) & keyed["id"].eqNullSafe(small["one"]))
        task = F.pmod(F.xxhash64("pivot", "part", "block"), F.lit(max(4, n // TASK_ROWS))).cast("int")
        there = there.select("pivot", "part", "block", "text", "role", "body", task.alias("task"))
        return there.groupBy("task").applyInArrow(_compare, "a bigint, b bigint, linked boolean")

    found = settle(compared(dealt.withColumn("block", F.lit(0))), batch=BATCH)
    edges = found.where("linked").select("a", "b")
    # a group in several parts: what isn't linked with the pivot meets the members of all parts
    many = dealt.where("parts > 1")
    rest = found.where("NOT linked").select(F.col("a").alias("pivot"), F.col("b").alias("text")).distinct()
    rest = rest.join(many.select("pivot", "parts").distinct(), "pivot")
    if not rest.isEmpty():
        one = rows.groupBy("key").agg(F.min("id").alias("one"))
        blocks = rest.groupBy("pivot").agg(F.ceil(F.count("*") / PART).cast("int").alias("blocks"))
        asks = rest.join(blocks, "pivot").withColumn("block", F.pmod(F.xxhash64(F.lit(1), "text"), F.col("blocks")).cast("int"))
        asks = asks.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).join(one, F.col("text") == F.col("key"))
        asked = many.where("role = 0").join(blocks, "pivot").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        columns = ["pivot", "part", "block", "text", "one"]
        both = settle(asks.select(*columns, F.lit(1).alias("role")).union(asked.select(*columns, F.lit(0).alias("role"))))
        edges = edges.union(settle(compared(both), batch=BATCH).select("a", "b"))
    return edges


def similar(docs: DataFrame, *, text: str = "text", id: str = "doc_id") -> DataFrame:
    """(id, n_shingles, component_id): the least id that links lead to, for each row of ``docs``."""
    sizes = F.arrow_udf(_profile, returnType=SHAPE, functionType=ArrowUDFType.SCALAR_ITER)
    rows = docs.select(F.col(id).alias("id"), name(F.col(text)).alias("key"), check(F.col(text)).alias("check"), sizes(F.col(text)).alias("p"))
    rows = settle(rows.select("id", "key", "check", "p.n", "p.bits", "p.frequent"), batch=2 * BATCH)
    shared = names(rows)
    rows = rows.withColumn("key", resolved(shared)).drop("check")
    least = components(links(docs, rows.where("n > 0 OR size(frequent) > 0"), text=text, id=id, shared=shared))
    named = lookup(rows.select("id", "key", "n"), "key", settle(least.withColumnRenamed("node", "key")))
    named = settle(named.withColumn("class", F.coalesce("least", "key")).drop("least"))
    first = settle(named.where("n > 0").groupBy("class").agg(F.min("id").alias("first")))
    out = lookup(named, "class", first)
    return out.select("id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("first")).otherwise(F.col("id")).alias("component_id"))


def keep_one(docs: DataFrame, *, text: str = "text", id: str = "doc_id") -> DataFrame:
    """One document of each component, the one with the least id, null ids last; of repeated rows one.

    Texts aren't shuffled unless more rows go than may be broadcast, or rows are repeated.
    """
    key = F.xxhash64(F.col(text))
    named = settle(similar(docs.select(F.struct(F.col(id).isNull().alias("none"), F.col(id).alias("id"), key.alias("key")).alias("__id"), F.col(text)), text=text, id="__id"))
    gone = settle(named.where("NOT (id <=> component_id)").select("id.id", "id.key").distinct())
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone
    rows = docs.withColumn("__key", key)
    kept = rows.join(gone, rows[id].eqNullSafe(gone["id"]) & (rows["__key"] == gone["key"]), "left_anti")
    if not named.where("n_shingles > 0").groupBy("id").count().where("count > 1").isEmpty():
        some, none = F.col("__n") > 0, F.col("__n") == 0
        sized = kept.withColumn("__n", F.length(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+", "")))
        kept = sized.where(some).dropDuplicates([id, "__key"]).unionByName(sized.where(none))
    return kept.select(*docs.columns)


def op3_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return similar(docs).select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


OP3_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), link AS (
  SELECT x, y FROM (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b USING (k) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2) JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y
  WHERE 100 * c >= 80 * (p.n + q.n - c)
), reach AS (
  SELECT x, y FROM link UNION SELECT r.x, l.y FROM reach r JOIN link l ON r.y = l.x
), least AS (
  SELECT x, min(y) AS y FROM reach GROUP BY x
)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(y, d.doc_id)) AS component_id FROM d LEFT JOIN n USING (doc_id) LEFT JOIN least ON x = d.doc_id
"""


def brute_force(docs: list[tuple]) -> list[tuple]:
    """The contract of op3 on plain Python values, for tests."""
    import re

    def shingles(s: str | None) -> frozenset:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s or ""))
        return frozenset(tuple(w[i : i + SHINGLE]) for i in range(max(1, len(w) - SHINGLE + 1))) if w else frozenset()

    sets = [shingles(s) for _, s in docs]
    root = list(range(len(docs)))

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and 5 * min(len(sets[i]), len(sets[j])) >= 4 * max(len(sets[i]), len(sets[j])):
                if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                    root[find(i)] = find(j)
    least: dict[int, int] = {}
    for i, (d, _) in enumerate(docs):
        least[find(i)] = min(least.get(find(i), d), d)
    return [(d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(docs)]
