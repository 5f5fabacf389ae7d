import hashlib
import re

import pytest

from kinfold.llm import pii as p

from .cases import SCHEMA, documents


def luhn(x):
    return sum((2 * int(c) - 9 if int(c) > 4 else 2 * int(c)) if i % 2 else int(c) for i, c in enumerate(reversed(x))) % 10 == 0


def plain(t):
    t, o = t or "", []
    o += [(m.start(), 0, "email", m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    o += [(m.start(), 1, "ip", m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        if 12 <= len(d) <= 19 and luhn(d):
            o.append((m.start(), 2, "card", m.end()))
    o += [(m.start(), 3, "phone", m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(o))


TEXTS = [
    "a@b.c_d@e.fg x@y, .a%b+c@d-e.f-g.h.", "😀 é x.y@z.com and +1 (415) 555-1234, +12 34 +5 67.89-10111213", "1.2.3.4 256.1.1.1 0255.001.1.1 1.2.3.4.5.6.7.8 99999999999999999999.1.1.1",
    "4111 1111 1111 1111 and 4111-1111-1111-1112, 4111111111111111 5", "12 34  4111 1111 1111 1111", "1" * 30, "5500005555555559-5500005555555559", "+1 2 +1 234 567 890", "@ + . 1.1", "a@b.c@d.e",
    "x@" * 300 + "y.z", "7" * 19 + " 4", "0000000000000000", "a@" + "b." * 20_000 + "c", "a" * 100_000 + "@" + "b" * 100_000 + ".c", " ".join(str(1000000 + i) for i in range(40_000)),
    " ".join(f"+1 555 0{i:06}, u{i}@x.yz 10.0.{i % 256}.7" for i in range(10_000)), "+" + "1" * 50_000, "1." * 30_000, "(+" * 20_000,
]


@pytest.fixture(scope="module")
def found(spark):
    texts = [t for _, t, *_ in documents()] + TEXTS
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("pii", p.F.lit(0)).withColumn("start", p.F.lit(0))
    return texts, {r.doc_id: r.pii for r in p.find_pii(docs).collect()}


def test_base_kinds(found):
    texts, got = found
    for i, t in enumerate(texts):
        mine = ",".join(f"{s.kind}:{s.start}:{s.end}" for s in got[i].spans if s.kind in p.KINDS)
        assert mine == plain(t), t
        assert (got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone) == tuple(mine.count(k) for k in p.KINDS)


def test_patterns_find_unseen_identifiers(spark):
    seeds = [(i, f"words {i} then write patient number: 4{i}0.1.2.{i} end") for i in range(10, 19)]
    seeds = [(i, t.replace(f"4{i}0.1.2.{i}", f"{i}.1.2.{i}0")) for i, t in seeds]
    docs = seeds + [(90, "é patient number: 77-1234567, thanks"), (91, "some other thing 1234567 here"), (92, None)]
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.pii.spans] for r in p.find_pii(spark.createDataFrame(docs, "doc_id long, text string"), seeds=5).collect()}
    assert got[90] == [("context", 18, 28)] and got[91] == [] and got[92] == []


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in p.op5_pii(spark, sf).collect():
        assert r.base_sha256 == hashlib.sha256(plain(texts[r.doc_id]).encode()).hexdigest()


def test_empty_table(spark):
    assert p.find_pii(spark.createDataFrame([], SCHEMA)).collect() == []
