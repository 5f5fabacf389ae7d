import random
import re

import pytest

from kinfold.llm import licenses as l

from .cases import SCHEMA, documents


def plain(t):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    at = sorted((i, label) for p, label in l.PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split())
    return len(w), len(at), at[0][0] if at else None, at[-1][0] if at else None, sorted({x for _, x in at})


MIT = re.sub(r"\{\?.*?\?\}", "", l.TEMPLATES["mit-text"][0])
TEXTS = [
    "MIT License, mit-license! Apache (License) the General Public License 3", "mit lic ense", "Ämit license mitlicense", MIT, MIT.replace("(", " (including the next paragraph) (", 0).replace("permission notice", "permission notice (including the next paragraph)"),
    MIT.replace("publish,", ""), "Released under the MIT License.", "Licensed under CC BY-NC 4.0.", "This work is licensed under the GNU General Public License, version 3.", "x " * 999 + "apache license",
]


def test_base_and_templates(spark):
    texts = [t for _, t, *_ in documents()] + TEXTS
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("licenses", l.F.lit(1))
    got = {r.doc_id: r.licenses for r in l.find_licenses(docs).collect()}
    for i, t in enumerate(texts):
        at = [p.word for p in got[i].places]
        assert (got[i].n_words, len(at), min(at, default=None), max(at, default=None), sorted({p.label for p in got[i].places})) == plain(t), t
    labels = [{x.label for x in got[len(texts) - len(TEXTS) + i].labels} for i in range(len(TEXTS))]
    assert labels[3] == labels[4] == {"mit-text"} and labels[5] == set()
    assert labels[6] == {"mit-notice"} and labels[7] == {"cc-by-nc"} and labels[8] == {"gpl-notice"}
    assert 0.2 < got[len(texts) - len(TEXTS) + 5].score < 1


def test_markup():
    a = l.Automaton("x", "one {? two three ?} four {* 2 *} five six")
    run = lambda s: a.run(s.encode().split())
    assert run("one four five six")[1] == run("one two three four z z five six z")[1] == 1.0
    assert run("one two four five six")[1] < 1 and run("one four z z z five six")[1] < 1 and run("one four five")[0] is None


def test_query_and_empty(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in l.op10_licenses(spark, sf).collect():
        n, base, first, last, labels = plain(texts[r.doc_id])
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (n, base, first, last, ",".join(labels))
        assert set(labels) <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1
    assert l.find_licenses(spark.createDataFrame([], SCHEMA)).collect() == []


def pattern(template):
    """A template as a regular expression over words that each end in a blank."""
    out, at = "", 0
    plain = lambda x: "".join(w.decode() + " " for w in l.split(x))
    for m in l.MARK.finditer(template):
        out += plain(template[at : m.start()])
        out += rf"(?:\S+ ){{0,{m[2]}}}" if m[2] else f"(?:{plain(m[1])})?"
        at = m.end()
    return re.compile(r"(?:^|(?<= ))" + out + plain(template[at:]))


def filled(template, rng):
    """A text that the template accepts."""
    text = re.sub(r"\{\?(.*?)\?\}", lambda m: m[1] if rng.random() < 0.5 else "", template, flags=re.DOTALL)
    return re.sub(r"\{\*\s*(\d+)\s*\*\}", lambda m: " ".join(["Somebody"] * rng.randint(0, int(m[1]))), text)


def test_against_patterns(spark):
    """Every template, filled in and then changed by a word, against a plain expression for it."""
    rng = random.Random(4)
    texts = []
    for templates in l.TEMPLATES.values():
        for t in templates:
            whole = f"Copyright x\n{filled(t, rng)} and more words"
            words = whole.split()
            k, j = rng.randrange(2, len(words) - 3), rng.randrange(2, len(words) - 3)
            texts += [whole, whole.upper(), " ".join([*words[:k], "changed", *words[k + 1 :]]), " ".join([*words[:j], *words[j + 1 :]]), " ".join(words[: k + 1])]
    patterns = [(label, pattern(t)) for label, templates in l.TEMPLATES.items() for t in templates]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    n = 0
    for r in l.find_licenses(docs).collect():
        plain = "".join(w.decode() + " " for w in l.split(texts[r.doc_id]))
        want = {label for label, p in patterns if p.search(plain)}
        assert {x.label for x in r.licenses.labels} == want, texts[r.doc_id]
        assert (r.licenses.score == 1.0) == bool(want)
        n += not want
    assert n > 50


def test_a_changed_disclaimer_is_refused(spark):
    mit, bsd = filled(l.TEMPLATES["mit-text"][0], random.Random(1)), filled(l.TEMPLATES["bsd-3-text"][0], random.Random(1))
    texts = [mit, mit[: mit.index("THE SOFTWARE IS")], mit.replace("WITHOUT WARRANTY", "WITH WARRANTY"), bsd, bsd.replace("ARE DISCLAIMED", "ARE GRANTED"), bsd.replace("Neither the name", "The name")]
    got = l.find_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert [{x.label for x in r.licenses.labels} for r in sorted(got)] == [{"mit-text"}, set(), set(), {"bsd-3-text"}, set(), set()]


def test_odd_templates():
    leading = l.Automaton("x", "{* 3 *} one two three four")
    assert leading.anchors == {(b"one", b"two", b"three")} and leading.run([b"one", b"two", b"three", b"four"]) == (4, 1.0)
    for bad in ("{* 3 *}", "{? one ?}", "", "one {? two {* 2 *} ?}"):
        with pytest.raises(ValueError):
            l.Automaton("x", bad)
