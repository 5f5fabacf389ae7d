"""Removal of long repeated passages by merging shards' Burrows-Wheeler transforms.

A byte goes if it is covered by a string of ``size`` bytes that also starts anywhere else, in the
same text or another.  Every such string has one anchor: the leftmost least hash among its runs
of ``GRAM`` bytes.  Equal strings have equal anchors at equal offsets, so strings are compared only
within an anchor's contexts: the bytes that the strings around it cover, aligned at the anchor.
Anchors that stand once in the corpus can't repeat and are left out; that is all that their hashes
decide.

1. The contexts of a part of the corpus are a shard.  Its transform lists, for each column from the
   right to the left, the symbols of that column in the order of the suffixes that begin after it;
   a stable sort by the symbols gives the order for the column itself.  Left of the anchor a symbol
   is a byte, right of it, where no string begins, it has eight.  Equal contexts of a shard are
   neighbours in its last order; one of them goes on, marked.
2. Transforms are cut by anchor and merged.  Only the interleave is refined, from the shards' symbols
   alone: it says which shard's suffix comes next, each shard's symbols are read in turn, and a
   stable sort by symbol gives the interleave one column further left.  No text is read and no
   suffix is compared or sorted again.
3. Common prefixes of neighbours follow in the same step, as one symbol more than the least common
   prefix between their old places.  A string repeats if an interval of common prefixes of ``size``
   and more holds another context that has a string there.
4. What is decided for a context goes back to its shard, which keeps the places of all contexts.

An anchor in very many contexts is split: its strings are dealt by the 16 offsets they may begin
at and by the bytes that all strings of those offsets share, which are 185 of 200.

Defined results: a null text counts as empty; texts shorter than ``size`` keep everything; equal
rows are copies of one another, and copies are repeated from the first to the last byte if they are
long enough; ties don't arise, since a string that repeats goes wherever it stands; very long texts
are shards of their own in steps of memory; an empty table gives an empty result; columns named like
the result are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import ArrowUDFType

from . import textscan as ts
from .store import forget, settle

SIZE, GRAM = 200, 56
#: Columns of a context: the anchor begins at LEFT, words of eight bytes fill what is right of there.
LEFT, WIDTH = SIZE - GRAM, 2 * SIZE - GRAM
WORDS = (WIDTH - LEFT) // 8
#: Bytes that one task gets; contexts of a shard; contexts from which an anchor is split.
TASK_BYTES, SHARD, SPLIT = 8 << 20, 16_384, 50_000
#: Texts of an Arrow batch.
BATCH = 4000
#: Offsets of a split anchor's part.
PART = 16
#: Bytes of places or runs up to which they are broadcast; beyond, texts are shuffled to them.
BROADCAST_BYTES = 8 << 20

ENTRY = np.dtype([("anchor", "<u8"), ("row", "<i8"), ("lo", "<u4"), ("span", "<u2"), ("rel", "<u2")])
#: In ``rel``: the anchor stands several times in its batch.
MULTI = np.uint16(1 << 15)


def anchors(piece: ts.Piece, size: int = SIZE, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(document, first start, starts after it, anchor's distance from it, anchor) of each anchor."""
    n = len(piece.data)
    if n < size:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.uint64))
    h = ts.prefix_hash(piece.data.astype(np.uint64) + np.uint64(1), ts.BYTES)
    at = np.arange(n - gram + 1)
    grams = ts.mix(ts.run_hash(h, at, at + gram, ts.BYTES))
    window, width = size - gram + 1, 1
    value, where = grams, at

    def least(shift: int, length: int) -> tuple[np.ndarray, np.ndarray]:
        later = value[shift : shift + length] < value[:length]
        return np.where(later, value[shift : shift + length], value[:length]), np.where(later, where[shift : shift + length], where[:length])

    while 2 * width <= window:
        value, where = least(width, len(value) - width)
        width *= 2
    if width < window:
        value, where = least(window - width, n - size + 1)
    start = np.arange(n - size + 1)
    start = start[start + size <= np.repeat(piece.bounds[1:], np.diff(piece.bounds))[: n - size + 1]]
    if not len(start):
        return anchors(ts.Piece(0, piece.data[:0], piece.bounds[:1]))
    where = where[start]
    new = np.concatenate([[True], (where[1:] != where[:-1]) | (start[1:] != start[:-1] + 1)])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    lo, hi, a = start[first], start[last], where[first]
    doc = np.searchsorted(piece.bounds, lo, "right") - 1
    return doc, lo - piece.bounds[doc], hi - lo, a - lo, grams[a]


def _firsts(*columns: np.ndarray) -> np.ndarray:
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _lengths(first: np.ndarray, n: int) -> np.ndarray:
    return np.diff(np.append(first, n))


def _by_bucket(rows: np.ndarray, by: np.ndarray, buckets: int) -> tuple[np.ndarray, list[bytes]]:
    bucket = (ts.mix(by.copy()) % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    rows, bucket = rows[order], bucket[order]
    edge = _firsts(bucket)
    return bucket[edge], [rows[a:b].tobytes() for a, b in zip(edge.tolist(), [*edge[1:].tolist(), len(rows)])]


def _index(buckets: int):
    """Anchors in packed rows by bucket.  Of an anchor that a batch holds several times one entry
    goes to the bucket; that all of them repeat is known here (kind 1)."""

    @ts.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, parts = batch.column(0).to_numpy(zero_copy_only=False), [np.empty(0, ENTRY)]
            for p in ts.pieces(batch.column(1), 1 << 18):
                doc, lo, span, rel, anchor = anchors(p)
                e = np.empty(len(doc), ENTRY)
                e["anchor"], e["row"], e["lo"], e["span"], e["rel"] = anchor, names[p.first + doc], lo, span, rel
                parts.append(e)
            e = np.concatenate(parts)
            e = e[np.argsort(e["anchor"], kind="stable")]
            first = _firsts(e["anchor"])
            n = _lengths(first, len(e))
            many, e = e[np.repeat(n > 1, n)], e[first]
            e["rel"][n > 1] |= MULTI
            for kind, rows, by in ((0, e, e["anchor"]), (1, many, many["row"].view(np.uint64))):
                if len(rows):
                    bucket, data = _by_bucket(rows, by, buckets)
                    yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array([kind] * len(data), pa.int32()), pa.array(data, pa.binary())], names=["bucket", "kind", "data"])

    return run


RUNS = "row bigint, lo int, span int, rel int, anchor bigint, hot boolean"


def _repeated(split: int):
    @ts.lean
    def run(table: pa.Table) -> pa.Table:
        """Places of the anchors that stand several times, and the anchors to split, as rows of their own."""
        kinds, data = table.column("kind").to_numpy(), table.column("data").to_pylist()
        own = lambda kind: np.concatenate([np.empty(0, ENTRY), *[np.frombuffer(x, ENTRY) for x, k in zip(data, kinds.tolist()) if k == kind]])
        e = own(0)
        e = e[np.argsort(e["anchor"], kind="stable")]
        first = _firsts(e["anchor"])
        n = _lengths(first, len(e))
        hot = e[first[n > split]].copy()
        e = e[np.repeat(n > 1, n)]
        e = np.concatenate([own(1), e[e["rel"] < MULTI], hot])
        return pa.table({
            "row": e["row"], "lo": e["lo"].astype(np.int32), "span": e["span"].astype(np.int32), "rel": (e["rel"] & ~MULTI).astype(np.int32),
            "anchor": e["anchor"].view(np.int64), "hot": np.arange(len(e)) >= len(e) - len(hot),
        })

    return run


class Contexts:
    """Contexts by key: bytes of all columns, columns where strings may begin, and their places."""

    def __init__(self, key: np.ndarray, text: np.ndarray, first: np.ndarray, last: np.ndarray, row: np.ndarray, base: np.ndarray):
        self.key, self.text, self.first, self.last, self.row, self.base = key, text, first, last, row, base

    def __len__(self) -> int:
        return len(self.key)

    def take(self, at: np.ndarray) -> Contexts:
        return Contexts(self.key[at], self.text[at], self.first[at], self.last[at], self.row[at], self.base[at])

    @staticmethod
    def joined(parts: list[Contexts]) -> Contexts:
        return Contexts(*[np.concatenate([getattr(p, f) for p in parts]) for f in ("key", "text", "first", "last", "row", "base")])


def contexts(row: np.ndarray, bodies: pa.Array, owner: np.ndarray, lo: np.ndarray, span: np.ndarray, rel: np.ndarray, anchor: np.ndarray, hot: np.ndarray) -> Contexts:
    """The contexts of anchors; ``owner`` is each one's text, ``hot`` the sorted anchors to split."""
    piece = next(ts.pieces(bodies, 1 << 62))
    data = np.concatenate([np.zeros(LEFT, np.uint8), piece.data, np.zeros(WIDTH, np.uint8)])  # column 0 of position 0 is there
    first = LEFT - rel
    last = first + span
    base = lo - first  # where column 0 is in the text
    where = piece.bounds[owner] + lo + rel  # of column 0 in ``data``
    key = anchor.view(np.uint64).copy()
    if len(hot):
        is_hot = hot[np.minimum(np.searchsorted(hot, key), len(hot) - 1)] == key
        cool, parts = np.flatnonzero(~is_hot), []
        at = np.flatnonzero(is_hot)
        for j in range(0, LEFT + 1, PART):
            own = at[(first[at] < j + PART) & (last[at] >= j)]
            shared = ts.hash_runs(data, where[own] + j + PART - 1, where[own] + j + SIZE, 1)
            parts.append((own, ts.mix(key[own] + np.uint64(j)) ^ shared, np.maximum(first[own], j), np.minimum(last[own], j + PART - 1)))
        own = np.concatenate([cool, *[p[0] for p in parts]])
        key = np.concatenate([key[cool], *[p[1] for p in parts]])
        first, last = np.concatenate([first[cool], *[p[2] for p in parts]]), np.concatenate([last[cool], *[p[3] for p in parts]])
        owner, base, where = owner[own], base[own], where[own]
    text = np.lib.stride_tricks.sliding_window_view(data, WIDTH)[where]
    column = np.arange(WIDTH)
    text[(column < first[:, None]) | (column >= last[:, None] + SIZE)] = 0
    return Contexts(key, text, first.astype(np.uint16), last.astype(np.uint16), row[owner], base.astype(np.int32))


def _ranked(block: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """The stable order by block and symbol, given blocks in order; whole blocks in order stay."""
    out = np.arange(len(symbol))
    fall = np.flatnonzero((symbol[1:] < symbol[:-1]) & (block[1:] == block[:-1]))
    if not len(fall):
        return out
    unsorted = np.zeros(block[-1] + 1, bool)
    unsorted[block[fall]] = True
    own = np.flatnonzero(unsorted[block])
    if symbol.dtype == np.uint8:
        order = np.argsort(block[own] * 256 + symbol[own], kind="stable")
    else:
        order = np.lexsort((symbol[own], block[own]))
    out[own] = own[order]
    return out


def transform(block: np.ndarray, text: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Symbols of all columns from the right to the left, each in the order of the suffixes that
    begin after it, and these orders; the last order is that of whole contexts."""
    words = np.ascontiguousarray(np.ascontiguousarray(text[:, LEFT:]).view(">u8").T).astype(np.uint64)
    letters = np.ascontiguousarray(text[:, :LEFT].T)
    order, symbols, orders = np.arange(len(block), dtype=np.int32), [], []
    for column in (*words[::-1], *letters[::-1]):
        symbols.append(column[order])
        orders.append(order)
        order = order[_ranked(block, symbols[-1])]
    return symbols, [*orders, order]


#: A transform's part for one bucket, packed: a header, then arrays of its contexts.
HEAD = np.dtype([("shard", "<i8"), ("n", "<i8")])
CODEC = "zstd"


def _pack(shard: int, buckets: int, c: Contexts) -> tuple[list[int], list[bytes], bytes]:
    """(buckets, parts of the transform of distinct contexts, places of all) of a shard."""
    bucket = (ts.mix(c.key.copy()) % np.uint64(buckets)).astype(np.int64)
    by = np.lexsort((c.key, bucket))
    c, bucket = c.take(by), bucket[by]
    block = np.repeat(np.arange(len(f := _firsts(c.key))), _lengths(f, len(c)))
    symbols, orders = transform(block, c.text)
    last = orders[-1]
    a, b = last[1:], last[:-1]
    equal = np.zeros(len(c), bool)
    equal[1:] = (block[a] == block[b]) & (c.first[a] == c.first[b]) & (c.last[a] == c.last[b])
    near = np.flatnonzero(equal[1:])
    equal[1 + near] = (c.text[a[near]] == c.text[b[near]]).all(axis=1)
    heads = np.flatnonzero(~equal)
    kept = np.zeros(len(c), bool)
    kept[last[heads]] = True
    number = np.cumsum(kept) - 1  # of distinct contexts, in the first order
    named = np.empty(len(c), np.uint32)
    named[last] = np.repeat(number[last[heads]], _lengths(heads, len(c)))
    several = np.bincount(named, minlength=len(heads)) > 1

    columns = [s[kept[o]] for s, o in zip(symbols, orders)]
    key, first, final, bucket = c.key[kept], c.first[kept], c.last[kept], bucket[kept]
    edge = _firsts(bucket)
    parts, codec = [], pa.Codec(CODEC, compression_level=1)
    for x, y in zip(edge.tolist(), [*edge[1:].tolist(), len(key)]):
        head = np.array([(shard, y - x)], HEAD)
        raw = b"".join([key[x:y].tobytes(), np.arange(x, y, dtype=np.uint32).tobytes(), first[x:y].tobytes(), final[x:y].tobytes(), several[x:y].tobytes(), *[s[x:y].tobytes() for s in columns]])
        parts.append(head.tobytes() + codec.compress(raw, asbytes=True))
    places = np.empty(len(c), PLACE)
    places["context"], places["row"], places["base"] = named, c.row, c.base
    return bucket[edge].tolist(), parts, places.tobytes()


PLACE = np.dtype([("context", "<u4"), ("base", "<i4"), ("row", "<i8")])
ROW = 8 + 4 + 2 + 2 + 1 + WIDTH


def _unpack(data: bytes) -> tuple[int, tuple[np.ndarray, ...], list[np.ndarray]]:
    """(shard, (key, number, first, last, several), symbols of all columns) of a packed part."""
    head = np.frombuffer(data, HEAD, 1)[0]
    n, at = int(head["n"]), 0
    raw = pa.Codec(CODEC).decompress(data[HEAD.itemsize :], n * ROW, asbytes=True)
    out = []
    for kind in ("<u8", "<u4", "<u2", "<u2", "?", *["<u8"] * WORDS, *["u1"] * LEFT):
        out.append(np.frombuffer(raw, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return int(head["shard"]), tuple(out[:5]), out[5:]


def _least(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least of values[a..b], both included, by minima over runs of doubling length."""
    level = np.frexp(b - a + 1)[1] - 1
    out, run = np.empty(len(a), values.dtype), values
    for k in range(int(level.max(initial=-1)) + 1):
        if k:
            run = np.minimum(run[: -(1 << (k - 1))], run[1 << (k - 1) :])
        own = np.flatnonzero(level == k)
        out[own] = np.minimum(run[a[own]], run[b[own] - (1 << k) + 1])
    return out


def _equal_bytes(x: np.ndarray) -> np.ndarray:
    """How many leading bytes of big-endian words with this difference are equal."""
    return sum((x < np.uint64(1 << (8 * k))).astype(np.int16) for k in range(8))


def interleave(shard: np.ndarray, block: np.ndarray, symbols: Iterator[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(order, common prefixes with the one before) of all suffixes for one column after another.

    ``shard`` and ``block`` are given in the first order; ``symbols`` yields each column's symbols,
    shard after shard, each shard's in its own order.
    """
    shard = shard.astype(np.uint16 if shard.max(initial=0) < 1 << 16 else np.int64)
    order, common = np.arange(len(shard)), np.zeros(len(shard), np.int16)
    edge = np.zeros(len(shard), bool)
    edge[_firsts(block)] = True
    for column in symbols:
        symbol = np.empty(len(column), column.dtype)
        symbol[np.argsort(shard, kind="stable")] = column  # each shard's symbols in turn
        new = _ranked(block, symbol)
        symbol, a, b = symbol[new], new[:-1], new[1:]
        same = (symbol[1:] == symbol[:-1]) & ~edge[1:]
        after = np.zeros(len(shard), np.int16)
        step = np.where(same, common[b], 0)
        far = np.flatnonzero(same & (b != a + 1))
        step[far] = _least(common, a[far] + 1, b[far])
        if column.dtype == np.uint8:
            after[1:] = np.where(same, np.minimum(step, WIDTH) + 1, 0)
        else:
            after[1:] = np.where(same, step + 8, np.where(edge[1:], 0, _equal_bytes(symbol[1:] ^ symbol[:-1])))
        order, shard, common = order[new], shard[new], after
        yield order, common


DECIDED = np.dtype([("context", "<u4"), ("a", "<u2"), ("b", "<u2")])


@ts.lean
def _merge(table: pa.Table) -> pa.Table:
    """For each shard of a bucket, runs of columns where its contexts' strings repeat."""
    parts = [_unpack(x.as_py()) for x in table.column("data")]
    parts.sort(key=lambda p: p[0])
    names = np.array([p[0] for p in parts])
    shard = np.repeat(np.arange(len(parts)), [len(p[1][0]) for p in parts])
    key, number, first, last, several = (np.concatenate([p[1][k] for p in parts]) for k in range(5))
    begin = np.argsort(key, kind="stable")
    block = np.repeat(np.arange(len(f := _firsts(key[begin]))), _lengths(f, len(key)))
    column = np.arange(LEFT + 1)
    repeated = several[:, None] & (column >= first[:, None]) & (column <= last[:, None])
    steps = (np.concatenate([p[2][k] for p in parts]) for k in range(WORDS + LEFT))
    for k, (order, common) in enumerate(interleave(shard[begin], block, steps)):
        at = LEFT - (k - WORDS + 1)
        if at > LEFT:
            continue
        near = common >= SIZE
        own = np.flatnonzero(near | np.append(near[1:], False))
        if not len(own):
            continue
        who, start = begin[order[own]], np.flatnonzero(~near[own])
        active = (first[who] <= at) & (at <= last[who])
        several_there = np.repeat(np.add.reduceat(active.astype(np.int64), start) > 1, _lengths(start, len(own)))
        repeated[who[active & several_there], at] = True
    step = np.diff(np.pad(repeated.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    (i, a), (_, b) = np.nonzero(step == 1), np.nonzero(step == -1)
    out = np.empty(len(i), DECIDED)
    out["context"], out["a"], out["b"] = number[i], a, b - 1
    edge = _firsts(shard[i])  # contexts are in order of shards
    data = [out[x:y].tobytes() for x, y in zip(edge.tolist(), [*edge[1:].tolist(), len(out)])]
    return pa.table({"key": pa.array(names[shard[i][edge]], pa.int64()), "kind": pa.array([2] * len(edge), pa.int32()), "data": pa.array(data, pa.binary())})


PASSAGES = "row bigint, lo int, hi int"


@ts.lean
def _found(table: pa.Table) -> pa.Table:
    """Starts of repeated strings, as runs of a text, from a shard's places and what is decided."""
    kinds, data = table.column("kind").to_numpy().tolist(), table.column("data").to_pylist()
    places = np.concatenate([np.empty(0, PLACE), *[np.frombuffer(x, PLACE) for x, k in zip(data, kinds) if k == 1]])
    runs = np.concatenate([np.empty(0, DECIDED), *[np.frombuffer(x, DECIDED) for x, k in zip(data, kinds) if k == 2]])
    runs = runs[np.argsort(runs["context"], kind="stable")]
    lo, hi = np.searchsorted(runs["context"], places["context"], "left"), np.searchsorted(runs["context"], places["context"], "right")
    n = hi - lo
    place, run = np.repeat(places, n), runs[np.arange(n.sum()) + np.repeat(lo - np.cumsum(n) + n, n)]
    row, a, b = place["row"], place["base"].astype(np.int64) + run["a"], place["base"].astype(np.int64) + run["b"]
    order = np.lexsort((a, row))
    row, a, b = row[order], a[order], b[order]
    if len(row):  # strings that meet, as one run of starts
        new = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (a[1:] > b[:-1] + SIZE)]))
        row, a, b = row[new], a[new], np.maximum.reduceat(b, new)
    return pa.table({"row": row, "lo": a.astype(np.int32), "hi": b.astype(np.int32)})


def _transforms(buckets: int, shard: int, hot):
    """Packed parts of shards' transforms by bucket (kind 0), and shards' places (kind 1)."""

    @ts.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, held, number = hot.value, [], TaskContext.get().partitionId() << 24

        def flush() -> pa.RecordBatch:
            keys, parts, places = _pack(number, buckets, Contexts.joined(held))
            columns = [pa.array([*keys, number], pa.int64()), pa.array([0] * len(keys) + [1], pa.int32()), pa.array([*parts, places], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["key", "kind", "data"])

        for batch in batches:
            for a in range(0, len(batch), 256):
                rows = batch.slice(a, 256)
                each = rows.column(2).flatten()
                n = np.diff(rows.column(2).offsets.to_numpy())
                owner = np.repeat(np.arange(len(rows)), n)
                lo, span, rel, anchor = (each.field(f).to_numpy(zero_copy_only=False).astype(np.int64) for f in ("lo", "span", "rel", "anchor"))
                for x in range(0, len(owner), shard):  # a long text's contexts may be several shards
                    y = slice(x, x + shard)
                    held.append(contexts(rows.column(0).to_numpy(), rows.column(1), owner[y], lo[y], span[y], rel[y], anchor[y], split))
                    if sum(map(len, held)) >= shard:
                        yield flush()
                        held, number = [], number + 1
        if sum(map(len, held)):
            yield flush()

    return run


SHAPE = "struct<n_removed:bigint,n_spans:bigint,spans:array<struct<start:int,end:int>>,kept_sha256:string>"
ARROW = pa.struct([("n_removed", pa.int64()), ("n_spans", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), ("kept_sha256", pa.string())])


def _cover(starts: list[dict] | None) -> list[tuple[int, int]]:
    """Byte runs covered by strings that start in the given runs of starts."""
    out: list[list[int]] = []
    for a, b in sorted((s["lo"], s["hi"] + SIZE) for s in starts or ()):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _kept(body: bytes, runs: list[tuple[int, int]]) -> bytes:
    at, parts = 0, []
    for a, b in runs:
        parts.append(body[at:a])
        at = b
    return b"".join([*parts, body[at:]])


def _removal(texts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for bodies, starts in texts:
        rows = []
        for body, own in zip(bodies, starts):
            data, runs = (body.as_py() or "").encode(), _cover(own.as_py())
            rows.append({"n_removed": sum(b - a for a, b in runs), "n_spans": len(runs), "spans": [{"start": a, "end": b} for a, b in runs], "kept_sha256": hashlib.sha256(_kept(data, runs)).hexdigest()})
        yield pa.array(rows, ARROW)


def repeated_starts(rows: DataFrame, *, text: str = "text", split: int = SPLIT, shard: int = SHARD) -> DataFrame:
    """(row, starts): for rows with numbers ``__row``, runs (lo, hi) of starts of strings that also
    start elsewhere, with what lies between starts whose strings meet."""
    spark = rows.sparkSession
    keyed = rows.select(F.col("__row").alias("row"), F.col(text).alias("body")).where(F.octet_length("body") >= SIZE)
    total = keyed.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    buckets = max(16, -(-2 * total * ENTRY.itemsize // ((LEFT + 2) * TASK_BYTES)))
    index = keyed.mapInArrow(_index(buckets), "bucket int, kind int, data binary")
    runs = settle(index.groupBy("bucket").applyInArrow(_repeated(split), RUNS), batch=BATCH)

    # an anchor to split has over ``split`` entries, so they are few beside the corpus
    hot = np.sort(np.array([r.anchor for r in runs.where("hot").select("anchor").distinct().collect()], np.int64).view(np.uint64))
    left = runs.where("NOT hot").groupBy("row").agg(F.collect_list(F.struct("lo", "span", "rel", "anchor")).alias("runs"))
    n = runs.where("NOT hot").count()
    there = keyed.join(F.broadcast(left) if n * ENTRY.itemsize <= BROADCAST_BYTES else left.hint("merge"), "row")
    tasks = max(16, -(-n * WIDTH // TASK_BYTES))
    packed = settle(there.select("row", "body", "runs").mapInArrow(_transforms(int(tasks), shard, spark.sparkContext.broadcast(hot)), "key bigint, kind int, data binary"), batch=BATCH)
    forget(spark, runs)
    decided = packed.where("kind = 0").groupBy("key").applyInArrow(_merge, "key bigint, kind int, data binary")
    found = decided.union(packed.where("kind = 1")).groupBy("key").applyInArrow(_found, PASSAGES)
    united = F.arrow_udf(_united, returnType="array<struct<lo:int,hi:int>>", functionType=ArrowUDFType.SCALAR)
    starts = settle(found.groupBy("row").agg(F.collect_list(F.struct("lo", "hi")).alias("starts")).select("row", united("starts").alias("starts")))
    forget(spark, packed)
    return starts


def _united(rows: pa.Array) -> pa.Array:
    """Runs of starts whose strings meet, as one run: it covers the same bytes."""
    kind = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))
    return pa.array(([{"lo": a, "hi": b - SIZE} for a, b in _cover(r.as_py())] for r in rows), kind)


def find_repeats(docs: DataFrame, *, text: str = "text", result: str = "repeats", **options) -> DataFrame:
    """``docs`` with a struct column: removed bytes, their runs, and the hash of what is kept.

    The rows are written once with numbers, which stay what they are however often a row is read.
    """
    rows = settle(docs.withColumn("__row", F.monotonically_increasing_id()))
    starts = repeated_starts(rows, text=text, **options)
    n = starts.agg(F.coalesce(F.sum(F.size("starts") * 8 + 16), F.lit(0))).first()[0]
    starts = starts.select(F.col("row").alias("__row"), F.col("starts").alias("__starts"))
    both = rows.join(F.broadcast(starts) if n <= BROADCAST_BYTES else starts.hint("merge"), "__row", "left")
    udf = F.arrow_udf(_removal, returnType=SHAPE, functionType=ArrowUDFType.SCALAR_ITER)
    return both.withColumn(result, udf(F.col(text), F.col("__starts"))).drop("__row", "__starts")


def remove_repeats(docs: DataFrame, *, text: str = "text", **options) -> DataFrame:
    """``docs`` without the repeated bytes; what a cut leaves of a character goes too."""

    def cut(texts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for bodies, spans in texts:
            yield pa.array((None if b.as_py() is None else _kept(b.as_py().encode(), [(x["start"], x["end"]) for x in s.as_py()]).decode(errors="ignore") for b, s in zip(bodies, spans)), pa.string())

    found = find_repeats(docs, text=text, result="__repeats", **options)
    udf = F.arrow_udf(cut, returnType="string", functionType=ArrowUDFType.SCALAR_ITER)
    return found.withColumn(text, udf(F.col(text), F.col("__repeats.spans"))).select(*docs.columns)


def op2_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_repeats(docs)
    r = "repeats"
    return found.select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        F.col(f"{r}.n_removed").alias("n_removed"), F.col(f"{r}.n_spans").alias("n_spans"), F.col(f"{r}.kept_sha256").alias("kept_sha256"),
    )


OP2_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), s AS (
  SELECT r, i, md5(substr(h, 2 * i + 1, {2 * SIZE})) AS k FROM (SELECT r, h, unnest(range(0, length(h) // 2 - {SIZE} + 1)) AS i FROM d)
), twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY k) AS n FROM s) WHERE n > 1
), marked AS (
  SELECT r, i, CASE WHEN i > lag(i) OVER (PARTITION BY r ORDER BY i) + {SIZE} THEN 1 ELSE 0 END AS new FROM twice
), run AS (
  SELECT r, min(i) AS a, max(i) + {SIZE} AS b FROM (SELECT r, i, sum(new) OVER (PARTITION BY r ORDER BY i) AS run FROM marked) GROUP BY r, run
), gap AS (
  SELECT r, a, b, substr(h, 2 * coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) + 1, 2 * (a - coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0))) AS before FROM run JOIN d USING (r)
), kept AS (
  SELECT r, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans, string_agg(before, '' ORDER BY a) AS begin, max(b) AS last FROM gap GROUP BY r
)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(CASE WHEN last IS NULL THEN h ELSE begin || substr(h, 2 * last + 1) END)) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""


def brute_force(docs: list[tuple]) -> list[tuple]:
    """The contract of op2 on plain Python values, for tests."""
    from collections import Counter

    bodies = [(d, (s or "").encode()) for d, s in docs]
    seen = Counter(b[i : i + SIZE] for _, b in bodies for i in range(len(b) - SIZE + 1))
    out = []
    for d, b in bodies:
        runs = _cover([{"lo": i, "hi": i} for i in range(len(b) - SIZE + 1) if seen[b[i : i + SIZE]] > 1])
        out.append((d, len(b), sum(y - x for x, y in runs), len(runs), hashlib.sha256(_kept(b, runs)).hexdigest()))
    return out
