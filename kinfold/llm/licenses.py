"""License scans by template markup.

A template is plain wording with two kinds of markup: ``{? ... ?}`` may be missing, and ``{* n *}``
stands for up to n words of any kind.  Templates are compiled into token automata; a text is
accepted where all mandatory wording stands exactly, word for word, with case, punctuation and
line breaks set aside.  Each automaton is started only where its first three words stand.  Markup
isn't nested; a gap before the first word takes no words, since a text may begin anywhere; a template
without mandatory wording is an error.

Phrases of the base are reported wherever their words stand consecutively.

Defined results: a null or empty text has no words, no labels and score 0; overlapping places all
count; a template that is accepted at several lengths takes the fewest words; equal labels are named
once; repeated rows get equal results; very long texts are scanned whole; an empty table gives an
empty result.  Other columns stay as they are, except that one named like the result is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import ArrowUDFType

from . import textscan as ts
from .license_texts import TEMPLATES

#: Phrase -> label of the base.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
MARK = re.compile(r"\{\?(.*?)\?\}|\{\*\s*(\d+)\s*\*\}", re.DOTALL)
ANCHOR = 3


def split(text: str) -> list[bytes]:
    return WORD.findall(text.encode().lower())


class Automaton:
    """States in a row: a word to read, a jump over an optional region, or a gap of any words."""

    def __init__(self, label: str, template: str):
        self.label, self.states = label, []  # (word, None), (None, state to jump to) or (None, -most)
        at = 0
        for m in MARK.finditer(template):
            self._read(template[at : m.start()])
            if m[2]:
                if any(w is not None for w, _ in self.states):
                    self.states.append((None, -int(m[2])))
            elif "{" in m[1]:
                raise ValueError(f"nested markup in a template of {label}")
            else:
                inner = split(m[1])
                self.states.append((None, len(self.states) + 1 + len(inner)))
                self.states += [(w, None) for w in inner]
            at = m.end()
        self._read(template[at:])
        optional = {k for i, (_, to) in enumerate(self.states) if to and to > 0 for k in range(i + 1, to)}
        self.mandatory = [w is not None and i not in optional for i, (w, _) in enumerate(self.states)]
        self.total = sum(self.mandatory)
        if not self.total:
            raise ValueError(f"no mandatory wording in a template of {label}")
        self.anchors = self._anchors()

    def _read(self, text: str) -> None:
        self.states += [(w, None) for w in split(text)]

    def _anchors(self) -> set[tuple[bytes, ...]]:
        """What the first words can be, as far as a gap among them; never nothing."""
        out, todo = set(), [(0, ())]
        while todo:
            i, seen = todo.pop()
            if len(seen) == ANCHOR or i == len(self.states):
                out.add(seen)
                continue
            word, to = self.states[i]
            if word is not None:
                todo.append((i + 1, (*seen, word)))
            elif to > 0:
                todo += [(i + 1, seen), (to, seen)]
            else:
                out.add(seen)
        return out

    def _reach(self, state: tuple[int, int, int], into: set) -> None:
        """state: where, words of the gap read so far, mandatory words read so far."""
        todo = [state]
        while todo:
            i, used, read = s = todo.pop()
            if s in into:
                continue
            into.add(s)
            if i < len(self.states) and self.states[i][0] is None:
                to = self.states[i][1]
                todo += [(i + 1, 0, read), (to, 0, read)] if to > 0 else [(i + 1, 0, read)]

    def run(self, words) -> tuple[int | None, float]:
        """How many words the shortest acceptance takes, and the best share of the wording read."""
        now: set = set()
        self._reach((0, 0, 0), now)
        best = 0
        for n, word in enumerate([*words, None]):
            best = max([best, *(s[2] for s in now)])
            if any(s[0] == len(self.states) for s in now):
                return n, 1.0
            after: set = set()
            for i, used, read in now:
                want, to = self.states[i]
                if word is None:
                    continue
                if want is not None:
                    if want == word:
                        self._reach((i + 1, 0, read + self.mandatory[i]), after)
                elif to < 0 and used < -to:
                    self._reach((i, used + 1, read), after)
            now = after
            if not now:
                break
        return None, best / self.total

    @property
    def longest(self) -> int:
        return sum(1 if w is not None else max(0, -to) for w, to in self.states)


class Scanner:
    """Hashes of all phrases and anchors by length, so that a piece of text is scanned as a whole."""

    def __init__(self, phrases: dict[str, str], templates: dict[str, list[str]]):
        self.automata = [Automaton(label, t) for label, ts_ in templates.items() for t in ts_]
        starts: dict[int, dict[tuple, list]] = {}
        for phrase, label in phrases.items():
            starts.setdefault(len(split(phrase)), {}).setdefault(tuple(split(phrase)), []).append(label)
        for a in self.automata:
            for words in a.anchors:
                starts.setdefault(len(words), {}).setdefault(words, []).append(a)
        self.starts, self.by_size = starts, {}
        for size, known in starts.items():
            column = pa.array([b" ".join(w).decode() for w in known])
            h = [ts.window_hashes(t, t.hashes(), size)[1] for t in [ts.tokens(p, ts.ALNUM) for p in ts.pieces(column, 1 << 30)]]
            self.by_size[size] = np.sort(np.concatenate(h))

    def scan(self, piece: ts.Piece) -> Iterator[dict]:
        t = ts.tokens(piece, ts.ALNUM)
        hashes = t.hashes()
        found = []
        for size, h in self.by_size.items():
            at, own = ts.window_hashes(t, hashes, size)
            found += [(w, size) for w in at[np.isin(own, h)].tolist()]
        out = [{"n_words": n, "places": [], "labels": [], "score": 0.0} for n in np.diff(t.bounds).tolist()]
        if not found:
            return out
        text = t.lower.tobytes()
        words = lambda a, b: [text[x:y] for x, y in zip(t.start[a:b].tolist(), t.end[a:b].tolist())]
        where = np.searchsorted(t.bounds, [w for w, _ in found], "right") - 1
        for d, (w, size) in sorted(zip(where.tolist(), found)):
            first, last, row = int(t.bounds[d]), int(t.bounds[d + 1]), out[d]
            for what in self.starts[size].get(tuple(words(w, w + size)), ()):
                if isinstance(what, str):
                    row["places"].append({"label": what, "word": w - first})
                    row["score"] = max(row["score"], 0.5)
                else:
                    read, share = what.run(words(w, min(last, w + what.longest + 1)))
                    row["score"] = max(row["score"], share)
                    if read is not None:
                        row["labels"].append({"label": what.label, "first": w - first, "last": w - first + read - 1})
        return out


SHAPE = "struct<n_words:bigint,places:array<struct<label:string,word:int>>,labels:array<struct<label:string,first:int,last:int>>,score:double>"
ARROW = pa.struct([
    ("n_words", pa.int64()), ("places", pa.list_(pa.struct([("label", pa.string()), ("word", pa.int32())]))),
    ("labels", pa.list_(pa.struct([("label", pa.string()), ("first", pa.int32()), ("last", pa.int32())]))), ("score", pa.float64()),
])


def find_licenses(docs: DataFrame, *, text: str = "text", result: str = "licenses", phrases: dict[str, str] = PHRASES, templates: dict[str, list[str]] = TEMPLATES) -> DataFrame:
    """``docs`` with a struct column: words, places of base phrases, accepted templates, score.

    The score is 1 where a template accepts, else the largest share of a template's mandatory words
    that was read before it failed, and at least 0.5 where a base phrase stands.
    """

    @ts.lean
    def scan(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scanner = Scanner(phrases, templates)
        for column in columns:
            yield pa.array([row for piece in ts.pieces(column) for row in scanner.scan(piece)], ARROW)

    return docs.withColumn(result, F.arrow_udf(scan, returnType=SHAPE, functionType=ArrowUDFType.SCALAR_ITER)(F.col(text)))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    places, labels = F.col("licenses.places"), F.col("licenses.labels")
    at = F.transform(places, lambda p: p["word"])
    names = lambda x: F.transform(x, lambda p: p["label"])
    text = lambda x: F.array_join(F.array_sort(F.array_distinct(x)), ",")
    return found.select(
        "doc_id", F.col("licenses.n_words").alias("n_words"), F.size(places).cast("long").alias("n_base"), F.array_min(at).cast("long").alias("first_word"),
        F.array_max(at).cast("long").alias("last_word"), text(names(places)).alias("base_labels"), text(F.concat(names(places), names(labels))).alias("labels"),
        F.col("licenses.score").alias("score"),
    )
