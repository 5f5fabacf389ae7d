import pytest

from kinfold.llm import pii as p

SEEDS = {
    "phone": ("contact phone:", [f"+1 (555) 123-45{i}7" for i in range(6)]),
    "email": ("mailbox owner:", [f"user{'abcdef'[i]}@mail.example.org" for i in range(6)]),
    "card": ("paid with", ["4111 1111 1111 1111", "5500 0000 0000 0004", "3400 0000 0000 009", "3000 0000 0000 04", "6011 0000 0000 0004", "5105 1051 0510 5100"]),
}


@pytest.mark.parametrize("kind", sorted(SEEDS))
def test_spans_of_each_kind_seed(spark, kind):
    cue, values = SEEDS[kind]
    docs = [(i, f"some words, {cue} {v} and more") for i, v in enumerate(values)] + [(90, f"other words, {cue} 77-1234567, thanks")]
    got = {r.doc_id: r.pii for r in p.find_pii(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert sum(got[i][f"n_{kind}"] for i in range(len(values))) == len(values)
    begin = len(f"other words, {cue} ")
    assert [(s.kind, s.start, s.end) for s in got[90].spans] == [("context", begin, begin + 10)]
