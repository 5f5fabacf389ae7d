import base64
import hashlib
import json
import re

from kinfold.llm import secrets as s

from .cases import SCHEMA, documents


def plain(text):
    text, out = text or "", []
    for m in re.finditer(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 12:
            out.append((m.start(), 0, "assign", m.end()))
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return [f"{k}:{a}:{b}" for a, _, k, b in sorted(out)]


def der(tag, body):
    n = len(body)
    head = bytes([n]) if n < 128 else bytes([0x82]) + n.to_bytes(2, "big")
    return bytes([tag]) + head + body


KEY = der(0x30, der(2, b"\0") + b"".join(der(2, bytes([5] * 40)) for _ in range(8)))
TEXTS = [
    "Password = 'abcdefghijkl' and TOKEN:short", "toKen: \"x=y.z/12345678\" AKIAABCDEFGHIJKLMN AKIASHORT ſecret=abcdefghijklmnop", "ä deadbeefdeadbeef DEADBEEFDEADBEEF 0123456789abcdef0",
    "password: token=abcdefghijklmn", "secret" * 9 + "=" * 3, "apikey=aaaaaaaaaaaa api_key : bbbbbbbbbbbbbb\n", "a" * 4000,
]


def spans(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("secrets", s.F.lit(1))
    return {r.doc_id: r.secrets for r in s.find_secrets(docs).collect()}


def test_base_kinds(spark):
    texts = [t for _, t, *_ in documents()] + TEXTS
    got = spans(spark, texts)
    for i, t in enumerate(texts):
        mine = [f"{x.kind}:{x.start}:{x.end}" for x in got[i].spans if x.kind in s.BASE]
        assert mine == plain(t), t
        assert got[i].n_hex == sum(x.startswith("hex") for x in mine)


def test_structure_is_confirmed(spark):
    encoded, token = base64.b64encode(KEY).decode(), ".".join(base64.urlsafe_b64encode(json.dumps(x).encode()).decode().rstrip("=") for x in ({"alg": "HS256"}, {"sub": 1})) + ".c2ln"
    openssh = base64.b64encode(b"openssh-key-v1\0" + b"".join(len(x).to_bytes(4, "big") + x for x in (b"none", b"none", b"")) + (1).to_bytes(4, "big") + b"k" * 30).decode()
    pem = f"-----BEGIN RSA PRIVATE KEY-----\n{encoded}\n-----END RSA PRIVATE KEY-----"
    broken = base64.b64encode(KEY[:-3]).decode()
    texts = [f"x {encoded} y", token, openssh, pem, KEY.hex().upper(), broken, encoded[1:], token.replace("eyJ", "eyK", 1), pem.replace(encoded, broken)]
    kinds = {i: {x.kind for x in v.spans} - set(s.BASE) for i, v in spans(spark, texts).items()}
    assert kinds[0] == {"key"} and kinds[1] == {"token"} and kinds[2] == {"openssh"} and "pem" in kinds[3] and kinds[4] == {"key"}
    assert not any(kinds[i] for i in range(5, 9))


def wrapped(encoded, width=64, line="\n"):
    return line.join(encoded[i : i + width] for i in range(0, len(encoded), width))


def test_keys_in_every_dress(spark):
    encoded = base64.b64encode(KEY).decode()
    lines = wrapped(encoded)
    pem = lambda body, label="RSA PRIVATE KEY": f"-----BEGIN {label}-----\n{body}\n-----END {label}-----"
    cipher = base64.b64encode(bytes(range(160))).decode()
    legacy = f"Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,00112233445566778899AABBCCDDEEFF\n\n{wrapped(cipher)}"
    pkcs8 = base64.b64encode(der(0x30, der(0x30, der(6, b"\x2a\x86\x48") + der(0x30, b"")) + der(4, bytes(range(64))))).decode()
    packet = bytes([0x95]) + (120).to_bytes(2, "big") + b"\x04" + bytes(range(119))
    pgp = f"Version: x\n\n{wrapped(base64.b64encode(packet).decode())}\n=AbCd"
    colons = ":".join(f"{b:02x}" for b in KEY)
    token = ".".join(base64.urlsafe_b64encode(x.encode()).decode().rstrip("=") for x in ('{ "alg": "HS256" }', '{"sub": 1}')) + ".c2ln"
    newline = ".".join(base64.urlsafe_b64encode(x.encode()).decode().rstrip("=") for x in ('{\n "alg": "HS256"}', '{"sub": 1}')) + ".c2ln"
    field = lambda x: len(x).to_bytes(4, "big") + x
    ssh = base64.b64encode(b"openssh-key-v1\0" + field(b"none") + field(b"none") + field(b"") + (1).to_bytes(4, "big") + field(b"p" * 51) + field(b"q" * 130)).decode()
    found = [
        ('{"key": "' + pem(lines).replace("\n", "\\n") + '"}', "pem"), (pem(legacy), "pem"), (pem(pkcs8, "ENCRYPTED PRIVATE KEY"), "pem"), (pem(pgp, "PGP PRIVATE KEY BLOCK"), "pem"),
        (f"the key\n{lines}\nends here", "key"), (f"https://h/{encoded} x", "key"), (wrapped(colons, 45), "key"), (lines.replace("\n", "\\n"), "key"),
        (token, "token"), (newline, "token"), (wrapped(ssh, 70) + "\nafterwards", "openssh"),
    ]
    clean = [
        pem(legacy.replace("DEK-Info", "Other")), pem(pgp.replace("\n\n", "\n\nAAAA"), "PGP PRIVATE KEY BLOCK"), pem(pkcs8), "MIIB" * 4000, "30:82:" * 3000, "M" + "A" * 9000, "-----BEGIN PRIVATE KEY-----" * 3000,
        token.replace(".", ":"),
    ]
    got = spans(spark, [t for t, _ in found] + clean)
    for i, (t, kind) in enumerate(found):
        own = [x for x in got[i].spans if x.kind not in s.BASE]
        assert [x.kind for x in own] == [kind], (t[:60], own)
    body = found[4][0]
    assert [body[x.start : x.end] for x in got[4].spans if x.kind == "key"] == [lines]
    assert [found[10][0][x.start : x.end] for x in got[10].spans if x.kind == "openssh"] == [wrapped(ssh, 70)]
    for i, t in enumerate(clean):
        assert not {x.kind for x in got[len(found) + i].spans} - set(s.BASE), t[:60]


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in s.op4_secrets(spark, sf).collect():
        assert r.base_sha256 == hashlib.sha256(",".join(plain(texts[r.doc_id])).encode()).hexdigest()


def test_empty_table(spark):
    assert s.find_secrets(spark.createDataFrame([], SCHEMA)).collect() == []
