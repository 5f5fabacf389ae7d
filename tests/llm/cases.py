"""Texts that every operator has to bear: nulls, empty and very long ones, ties and repeated rows."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))


def documents(seed: int = 5) -> list[tuple]:
    """Copies, near copies, a common passage, odd white space and letters, nulls in every column."""
    rng = random.Random(seed)
    passage = words(rng, 70)
    texts = [None, "", " \n\t ", "one", "one two  three", "One TWO three", "a b c d e", "ÄÖ ü ß 字 😀 " * 50, "x " * 700, "lorem\x0bipsum\x0c dolor\r\nsit  amet\n\nsit  amet\n"]
    base = [words(rng, rng.randint(30, 260)) for _ in range(14)]
    texts += base + [base[0], base[0], base[1].upper(), base[1]]
    for b in base[:6]:
        w = b.split()
        for k in range(5):
            v = list(w)
            for _ in range(1 + k):
                v[rng.randrange(len(v))] = "zz" + str(rng.randrange(9))
            texts.append(" ".join(v))
    for b in base[6:12]:
        texts.append(b[: len(b) // 2] + " " + passage + " " + b[len(b) // 2 :])
    texts.append(words(rng, 9000) + " " + base[2] + " " + words(rng, 3000))
    texts.append("y" * 5000)
    sources = ["src0", "src0", "src1", "src2", None, "b", "a"]
    rows = [(i, t, rng.choice(["en", None]), sources[i % len(sources)], None if t is None else len(t)) for i, t in enumerate(texts)]
    return rows + [rows[14], (None, base[3], "en", "src1", 3), (None, None, None, None, None)]


def with_ids(rows: list[tuple]) -> list[tuple]:
    """Without null or repeated ids, for references that name documents by them."""
    seen, out = set(), []
    for r in rows:
        if r[0] is not None and r[0] not in seen:
            seen.add(r[0])
            out.append(r)
    return out
