"""Language-model scores by subword lattice likelihood.

The pieces of an existing vocabulary make a lattice over every word; all segmentations count, by
forward recursion in log space, so a text's probability is the marginal one.  The vocabulary's own
scores start the piece probabilities (a merge vocabulary's ranks by Zipf's law), and one step of
expectation and maximisation over all training words refits them.  Pieces of single bytes make
every word spellable.  A text ends with an end mark.

A word's score depends on the word alone, so lattices run over the table of distinct words.  That
table grows with the corpus: its most frequent words, at most ``HEAD``, are broadcast for a second
scan of the texts, and occurrences of all others are joined.

Beside it stands the base model: add-one counts of training words and end marks.

Defined results: a null or empty text is its end mark; a null id trains; without training rows
counts are 0 and pieces keep their start; an empty table gives an empty result; very long words
run alone, in time and memory linear in their length; repeated rows and equal texts count and score
one by one.  The table of words is grouped by the words themselves, occurrences find their words in
it by two independent 64-bit hashes.  Columns named like the result are replaced.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import ArrowUDFType

from . import textscan as ts
from .store import forget, settle

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁".encode()
#: Words broadcast at most: 40 bytes each.
HEAD = 1 << 20
#: Words longer than this run alone.
LONG = 64
SMOOTH = 0.1
LN10 = math.log(10)


def read_vocabulary(path: str = VOCABULARY) -> tuple[list[bytes], np.ndarray]:
    """Pieces as bytes, and their log probabilities before any training.

    A unigram model's scores are such probabilities already; a merge model has ranks in their
    place, which stand for probabilities by Zipf's law.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, scores, seen = [], [], set()
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            continue
        piece = bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).encode()
        if piece not in seen:  # a one-byte character and its byte are one piece
            seen.add(piece)
            pieces.append(piece)
            scores.append(model.get_score(i))
    scores = np.array(scores)
    if scores.min() < -1000:  # ranks of merges rather than log probabilities
        scores = -np.log(np.argsort(np.argsort(-scores, kind="stable")) + 10.0)
    for b in range(256):
        if bytes([b]) not in seen:
            pieces.append(bytes([b]))
            scores = np.append(scores, scores.min())
    return pieces, scores - np.logaddexp.reduce(scores)


def _hash(words: list[bytes]) -> np.ndarray:
    data = np.frombuffer(b"".join(words), np.uint8)
    end = np.cumsum([len(w) for w in words])
    h = ts.prefix_hash(data.astype(np.uint64) + np.uint64(1), ts.BYTES)
    return ts.mix(ts.run_hash(h, np.concatenate([[0], end[:-1]]), end, ts.BYTES))


def _names(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each word, as those of the texts' words."""
    data, end = np.frombuffer(b"".join(words), np.uint8), np.cumsum([len(w) for w in words])
    return tuple(ts.hash_runs(data, np.concatenate([[0], end[:-1]]), end, seed) for seed in (0, 1))


class Lattice:
    """Log probabilities of words, and expected counts of pieces."""

    def __init__(self, pieces: list[bytes], logp: np.ndarray):
        h = _hash(pieces)
        self.order = np.argsort(h)
        self.h, self.logp = h[self.order], np.asarray(logp)[self.order]
        self.most = max(map(len, pieces))
        self.bits = np.zeros(1 << 20, bool)
        self.bits[(self.h >> np.uint64(44)).astype(np.int64)] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which hashes are pieces, and their places in the sorted table."""
        maybe = np.flatnonzero(self.bits[(h >> np.uint64(44)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.h, h[maybe]), len(self.h) - 1)
        real = self.h[at] == h[maybe]
        return maybe[real], at[real]

    def run(self, words: list[bytes], counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Natural log probabilities; with counts also the expected count of each piece in them."""
        out, expected = np.zeros(len(words)), np.zeros(len(self.h))
        lengths = np.array([len(w) for w in words])
        for n in np.unique(lengths):
            own = np.flatnonzero(lengths == n)
            if n > LONG:
                for k in own.tolist():
                    out[k] = self._one(words[k], None if counts is None else counts[k], expected)
                continue
            for part in np.array_split(own, -(-len(own) // 20_000)):
                text = np.frombuffer(b"".join([MARK + words[k] for k in part.tolist()]), np.uint8).reshape(len(part), -1)
                out[part] = self._same(text, None if counts is None else counts[part], expected)
        back = np.zeros(len(self.h))
        back[self.order] = expected
        return out, back

    def _same(self, text: np.ndarray, counts: np.ndarray | None, expected: np.ndarray) -> np.ndarray:
        """Words of one length together."""
        m, n = text.shape
        up, down = ts.BYTES.to(n + 1)
        h = np.zeros((m, n + 1), np.uint64)
        np.cumsum((text.astype(np.uint64) + np.uint64(1)) * up[:n], axis=1, out=h[:, 1:])
        forward = np.full((n + 1, m), -np.inf)
        forward[0] = 0
        edges = []
        for j in range(1, n + 1):
            for i in range(max(0, j - self.most), j):
                rows, at = self.find(ts.mix((h[:, j] - h[:, i]) * down[i]))
                if len(rows):
                    forward[j, rows] = np.logaddexp(forward[j, rows], forward[i, rows] + self.logp[at])
                    if counts is not None:
                        edges.append((i, j, rows, at))
        total = forward[n]
        if counts is not None:
            backward = np.full((n + 1, m), -np.inf)
            backward[n] = 0
            for i, j, rows, at in sorted(edges, key=lambda e: -e[0]):
                backward[i, rows] = np.logaddexp(backward[i, rows], backward[j, rows] + self.logp[at])
            for i, j, rows, at in edges:
                np.add.at(expected, at, counts[rows] * np.exp(forward[i, rows] + self.logp[at] + backward[j, rows] - total[rows]))
        return total

    def _one(self, word: bytes, count: float | None, expected: np.ndarray) -> float:
        """A long word alone: pieces are looked up for all starts at once."""
        text = np.frombuffer(MARK + word, np.uint8)
        n = len(text)
        h = ts.prefix_hash(text.astype(np.uint64) + np.uint64(1), ts.BYTES)
        ending: list[list[tuple[int, int]]] = [[] for _ in range(n + 1)]
        for size in range(1, min(self.most, n) + 1):
            start = np.arange(n - size + 1)
            found, at = self.find(ts.mix(ts.run_hash(h, start, start + size, ts.BYTES)))
            for i, k in zip(found.tolist(), at.tolist()):
                ending[i + size].append((i, k))
        forward = [0.0] * (n + 1)
        for j in range(1, n + 1):
            terms = [forward[i] + float(self.logp[k]) for i, k in ending[j]]
            top = max(terms)
            forward[j] = top + math.log(sum(math.exp(t - top) for t in terms))
        if count is not None:
            backward = [-math.inf] * n + [0.0]
            for j in range(n, 0, -1):
                for i, k in ending[j]:
                    backward[i] = float(np.logaddexp(backward[i], backward[j] + self.logp[k]))
            for j in range(1, n + 1):
                for i, k in ending[j]:
                    expected[k] += count * math.exp(forward[i] + self.logp[k] + backward[j] - forward[n])
        return forward[n]


@ts.lean
def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct words of a batch of texts, how often they stand in all and in training texts."""
    for batch in batches:
        train = np.asarray(batch.column(1).to_numpy(zero_copy_only=False), bool)
        words, trains = [], []
        for p in ts.pieces(batch.column(0)):
            t = ts.tokens(p, ts.SPACED)
            words.append(ts.gather(t.lower, t.start, t.end))
            trains.append(train[p.first : p.first + p.count][t.doc()])
        if not sum(map(len, words)):
            continue
        coded = pa.chunked_array(words).dictionary_encode().combine_chunks()
        coded = coded if isinstance(coded, pa.DictionaryArray) else coded.chunk(0)
        known, at = coded.dictionary.cast(pa.string()), coded.indices.to_numpy()
        n, c = np.bincount(at, minlength=len(known)), np.bincount(at[np.concatenate(trains)], minlength=len(known))
        for a in range(0, len(known), 100_000):
            yield pa.RecordBatch.from_arrays([known[a : a + 100_000], pa.array(n[a : a + 100_000]), pa.array(c[a : a + 100_000])], names=["word", "n", "c"])


SHAPE = "struct<words:bigint,known:bigint,base:double,score:double,rare:array<struct<h:bigint,g:bigint,n:int>>>"
ARROW = pa.struct([("words", pa.int64()), ("known", pa.int64()), ("base", pa.float64()), ("score", pa.float64()), ("rare", pa.list_(pa.struct([("h", pa.int64()), ("g", pa.int64()), ("n", pa.int32())])))])


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _score_documents(column: pa.Array, h: np.ndarray, g: np.ndarray, values: np.ndarray) -> pa.Array:
    """Sums over the words in the table; the others by document and both hashes."""
    parts = []
    for p in ts.pieces(column):
        t = ts.tokens(p, ts.SPACED)
        own, other, doc = t.hashes(), t.hashes(1), t.doc()
        hit, v = np.zeros(len(own), bool), np.zeros((3, len(own)))
        if len(h):
            at = np.minimum(np.searchsorted(h, own), len(h) - 1)
            hit = (h[at] == own) & (g[at] == other)
            v = np.where(hit, values[:, at], 0.0)
        rest = np.flatnonzero(~hit)
        order = rest[np.lexsort((other[rest], own[rest], doc[rest]))]
        new = np.ones(len(order), bool)
        new[1:] = (own[order][1:] != own[order][:-1]) | (other[order][1:] != other[order][:-1]) | (doc[order][1:] != doc[order][:-1])
        first = np.flatnonzero(new)
        n = np.diff(np.append(first, len(order))).astype(np.int32)
        offsets = np.searchsorted(doc[order[first]], np.arange(p.count + 1)).astype(np.int32)
        rare = pa.StructArray.from_arrays([pa.array(own[order[first]].view(np.int64)), pa.array(other[order[first]].view(np.int64)), pa.array(n)], names=["h", "g", "n"])
        columns = [np.diff(t.bounds), _sums(v[0], t.bounds).astype(np.int64), _sums(v[1], t.bounds), _sums(v[2], t.bounds)]
        parts.append(pa.StructArray.from_arrays([*map(pa.array, columns), pa.ListArray.from_arrays(pa.array(offsets), rare)], names=[f.name for f in ARROW]))
    return pa.concat_arrays(parts) if parts else pa.array([], ARROW)


def is_held_out(id: Column, folds: int = 7, fold: int = 2) -> Column:
    return F.pmod(F.crc32(F.coalesce(id.cast("string"), F.lit("")).cast("binary")), F.lit(folds)) == fold


def score(docs: DataFrame, *, held_out: Column, text: str = "text", result: str = "lm", vocabulary: str = VOCABULARY, head: int = HEAD, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all) with a struct: held_out, n_tokens, n_known,
    train_tokens, base_score and score, both as log10 of a probability."""
    spark = docs.sparkSession
    keep = [c for c in (keep or docs.columns) if c != result]
    counted = docs.select(F.col(text), (~held_out).alias("train")).mapInArrow(_count, "word string, n bigint, c bigint")
    table = settle(counted.groupBy("word").agg(F.sum("n").alias("n"), F.sum("c").alias("c")))
    ends = docs.where(~held_out).count()
    tokens, known = table.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0)).first()
    tokens, known = tokens + ends, known + bool(ends)
    floor = math.log10(tokens + known + 1)

    pieces, start = read_vocabulary(vocabulary)
    logp, end = start, math.log(0.5)
    if ends:
        begin = spark.sparkContext.broadcast((pieces, start))

        @ts.lean
        def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lattice, total = Lattice(*begin.value), 0.0
            for b in batches:
                total = total + lattice.run([w.encode() for w in b.column(0).to_pylist()], b.column(1).to_numpy().astype(float))[1]
            if isinstance(total, np.ndarray):
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["piece", "n"])

        # one row for each piece of the vocabulary, however large the corpus
        counts = dict(table.where("c > 0").select("word", "c").mapInArrow(expect, "piece bigint, n double").groupBy("piece").agg(F.sum("n")).collect())
        n = np.array([counts.get(i, 0.0) for i in range(len(pieces))]) + SMOOTH
        logp, end = np.log(n) - math.log(n.sum() + ends), math.log(ends) - math.log(n.sum() + ends)
    fitted = spark.sparkContext.broadcast((pieces, logp))

    @ts.lean
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(*fitted.value)
        for b in batches:
            words, c = [w.encode() for w in b.column(0).to_pylist()], b.column(2).to_numpy()
            columns = [*(x.view(np.int64) for x in _names(words)), (c > 0).astype(np.int32), np.log10(c + 1.0) - floor, lattice.run(words)[0] / LN10]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), b.column(1)], names=["h", "g", "known", "base", "score", "n"])

    scored = settle(table.mapInArrow(judge, "h bigint, g bigint, known int, base double, score double, n bigint"))
    forget(spark, table)
    # the least frequency from which words are few enough for the head
    level = F.floor(F.log2("n") * 4).cast("int")
    least, held = None, 0
    for row in scored.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect():
        held += row["count"]
        if held > head:
            break
        least = row["level"]
    top = scored.where(level >= least if least is not None else F.lit(False)).select("h", "g", "known", "base", "score").toArrow()
    h = top.column("h").to_numpy().view(np.uint64)
    order = np.argsort(h)
    common = spark.sparkContext.broadcast((h[order], top.column("g").to_numpy().view(np.uint64)[order], np.stack([top.column(c).to_numpy().astype(float)[order] for c in ("known", "base", "score")])))

    @ts.lean
    def scan(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            yield _score_documents(column, *common.value)

    udf = F.arrow_udf(scan, returnType=SHAPE, functionType=ArrowUDFType.SCALAR_ITER)
    rows = settle(docs.withColumns({"__held": held_out, "__row": F.monotonically_increasing_id(), "__s": udf(F.col(text))}).select(*keep, "__held", "__row", "__s"))
    rare = rows.select("__row", F.explode("__s.rare").alias("r")).select("__row", "r.h", "r.g", "r.n").join(scored.drop("n"), ["h", "g"])
    rare = rare.groupBy("__row").agg(*[F.sum(F.col(c) * rare["n"]).alias(f"__{c}") for c in ("known", "base", "score")])
    out = rows.join(rare, "__row", "left")
    whole = lambda c: F.col(f"__s.{c}") + F.coalesce(F.col(f"__{c}"), F.lit(0))
    lm = F.struct(
        F.col("__held").alias("held_out"), (F.col("__s.words") + 1).alias("n_tokens"), (whole("known") + int(ends > 0)).cast("long").alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"),
        (whole("base") + math.log10(ends + 1) - floor).alias("base_score"), (whole("score") + end / LN10).alias("score"),
    )
    return out.withColumn(result, lm).select(*keep, result)


def op8_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return score(docs, held_out=is_held_out(F.col("doc_id")), keep=["doc_id"]).select("doc_id", "lm.*")


def brute_force_base(docs: list[tuple]) -> list[tuple]:
    """held_out, n_tokens, n_known, train_tokens and base_score on plain Python values, for tests."""
    import re
    from collections import Counter

    split = lambda s: re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s or "")) + [None]
    held = [zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2 for d, _ in docs]
    c = Counter(w for (_, s), x in zip(docs, held) if not x for w in split(s))
    n, v = sum(c.values()), len(c)
    return [(d, x, len(split(s)), sum(c[w] > 0 for w in split(s)), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in split(s))) for (d, s), x in zip(docs, held)]
