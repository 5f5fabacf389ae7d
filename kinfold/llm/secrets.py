"""Secret scans with structural confirmation.

Three base kinds are reported as their patterns find them.  Beyond them, runs that look like
base64 or hex are decoded and reported only if the bytes parse as what a secret is made of: a
private key as nested tag-length-value fields whose lengths add up, an OpenSSH key as
length-prefixed fields, a PGP secret key as a packet, or a signed token whose header is JSON with an
algorithm.  A key may stand between armour lines, with headers, encrypted, with line ends written
as ``\\n``, or bare in one line or several, and in hex with colons or without: where a bare key ends
is told by the length that it declares.

Defined results: a null text counts as empty and has no spans; positions are code points, ends
exclusive; equal spans of one kind are reported once; spans that begin together stand in the order
of kinds; repeated rows and equal texts get equal spans; very long texts are read to their end, in
time linear in their length; an empty table gives an empty result.  Other columns stay as they are,
except that one named like the result is replaced.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import ArrowUDFType

#: Kinds in the order of reports: those of the base, then those that need confirmation.
BASE = ("assign", "access", "hex")
KINDS = (*BASE, "pem", "key", "openssh", "token")

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
# maximal runs: a run that is too short holds none that is long enough
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")

BEGIN = re.compile(r"-----BEGIN ((?:[A-Z0-9]+ )*PRIVATE KEY(?: BLOCK)?)-----")
HEADER = re.compile(r"^[A-Za-z][A-Za-z0-9-]*:.*$", re.MULTILINE)
CHECKSUM = re.compile(r"^=[A-Za-z0-9+/]{4}\s*$", re.MULTILINE)
# A key's first byte is 0x30 and its second a length, which is M and one of A to P in base64.
BARE = re.compile(r"(?=M[A-P][A-Za-z0-9+/_-]{14})")
BARE_HEX = re.compile(r"(?=30:?(?:81:?[0-9a-f]{2}:?|82:?[0-9a-f]{2}:?[0-9a-f]{2}:?|[1-7][0-9a-f]:?)02:?01:?0[01])", re.IGNORECASE)
OPENSSH = "b3BlbnNzaC1rZXktdjE"
# A header that begins with a brace and then a quote or white space.
SIGNED = re.compile(r"(?<![A-Za-z0-9_-])(e[wy][A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]*)")
RUN, HEX_RUN = re.compile(r"[A-Za-z0-9+/_-]+"), re.compile(r"[0-9A-Fa-f]+")
BREAK, HEX_BREAK = re.compile(r"(?:(?:\\r)?\\n|\r?\n[\x20\t]*)"), re.compile(r":?(?:\r?\n)?[\x20\t]*")
#: No private key is longer.
LONGEST = 1 << 16

SHAPE = f"struct<{','.join(f'n_{k}:bigint' for k in BASE)},spans:array<struct<kind:string,start:int,end:int>>>"
ARROW = pa.struct([*[(f"n_{k}", pa.int64()) for k in BASE], ("spans", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])))])


def decoded(text: str) -> bytes | None:
    """Base64 with either alphabet, with or without padding."""
    text = text.rstrip("=").replace("-", "+").replace("_", "/")
    if len(text) % 4 == 1:
        return None
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def fields(data: bytes) -> list[tuple[int, bytes]] | None:
    """The tag-length-value fields that fill ``data``, or None if lengths don't add up."""
    out, i = [], 0
    while i < len(data):
        if i + 2 > len(data):
            return None
        tag, n = data[i], data[i + 1]
        i += 2
        if n & 0x80:
            wide = n & 0x7F
            if not 1 <= wide <= 4 or i + wide > len(data) or data[i] == 0:
                return None
            n = int.from_bytes(data[i : i + wide], "big")
            i += wide
        if i + n > len(data):
            return None
        out.append((tag, data[i : i + n]))
        i += n
    return out


def is_private_key(data: bytes | None) -> bool:
    """A sequence of a small version and the numbers or the wrapped key of a private key."""
    outer = fields(data) if data and data[0] == 0x30 else None
    if not outer or len(outer) != 1:
        return False
    inner = fields(outer[0][1])
    if not inner or len(inner) < 2 or inner[0][0] != 0x02 or inner[0][1] not in (b"\x00", b"\x01"):
        return False
    tags = [t for t, _ in inner]
    rsa = len(tags) >= 9 and all(t == 0x02 for t in tags[:9])
    dsa = len(tags) == 6 and all(t == 0x02 for t in tags)
    elliptic = tags[1] == 0x04 and len(inner[1][1]) >= 16
    wrapped = len(tags) >= 3 and tags[1] == 0x30 and tags[2] == 0x04 and bool(fields(inner[1][1])) and fields(inner[1][1])[0][0] == 0x06
    return rsa or dsa or elliptic or wrapped


def is_wrapped_key(data: bytes | None) -> bool:
    """An encrypted key: the algorithm's sequence, and the bytes."""
    outer = fields(data) if data and data[0] == 0x30 else None
    inner = fields(outer[0][1]) if outer and len(outer) == 1 else None
    return bool(inner) and [t for t, _ in inner] == [0x30, 0x04] and bool(kind := fields(inner[0][1])) and kind[0][0] == 0x06


def is_pgp_secret(data: bytes | None) -> bool:
    """A packet of a secret key or subkey, whose declared length is there."""
    if not data or len(data) < 8 or not data[0] & 0x80:
        return False
    if data[0] & 0x40:
        tag, first = data[0] & 0x3F, data[1]
        n, at = (first, 2) if first < 192 else (((first - 192) << 8) + data[2] + 192, 3) if first < 224 else (int.from_bytes(data[2:6], "big"), 6)
    else:
        tag, wide = data[0] >> 2 & 0xF, data[0] & 3
        if wide == 3:
            return False
        n, at = int.from_bytes(data[1 : 1 + (1 << wide)], "big"), 1 + (1 << wide)
    return tag in (5, 7) and data[at] in (3, 4, 5, 6) and 8 <= n <= len(data) - at


def declared(data: bytes) -> int | None:
    """How long a key is that begins like this: outer length, then a version of 0 or 1."""
    if len(data) < 7 or data[0] != 0x30:
        return None
    wide = data[1] & 0x7F if data[1] & 0x80 else 0
    if wide > 2 or (data[1] & 0x80 and not wide):
        return None
    n = int.from_bytes(data[2 : 2 + wide], "big") if wide else data[1]
    version = data[2 + wide : 5 + wide]
    return 2 + wide + n if version in (b"\x02\x01\x00", b"\x02\x01\x01") and n < LONGEST else None


def is_openssh(data: bytes | None) -> bool:
    magic = b"openssh-key-v1\x00"
    if not data or not data.startswith(magic):
        return False
    i = len(magic)
    for _ in range(3):  # cipher, key derivation, its options
        n = int.from_bytes(data[i : i + 4], "big")
        if i + 4 + n > len(data):
            return False
        i += 4 + n
    return 1 <= int.from_bytes(data[i : i + 4], "big") <= 16


def openssh_length(data: bytes) -> int | None:
    """How many bytes the fields of such a key fill, if they are all there."""
    i = len(b"openssh-key-v1\x00")
    for part in range(4):
        if part == 3:  # public keys as many as said, and the private part
            keys, i = int.from_bytes(data[i : i + 4], "big"), i + 4
        for _ in range(keys + 1 if part == 3 else 1):
            i += 4 + int.from_bytes(data[i : i + 4], "big")
            if i > len(data):
                return None
    return i


def openssh_keys(text: str) -> list[tuple[int, int]]:
    """Bare keys over several lines as far as their fields reach, or else a line that begins as one."""
    out, at = [], text.find(OPENSSH)
    while at >= 0:
        body, _ = gathered(text, at, 4 * LONGEST // 3, RUN, BREAK)
        line = RUN.match(text, at)[0]
        data = decoded(body[: len(body) // 4 * 4])
        n = openssh_length(data) if is_openssh(data) else None
        end = at
        if n:
            end = gathered(text, at, -(-n * 4 // 3), RUN, BREAK)[1]
        elif is_openssh(decoded(line)):
            end = at + len(line)
        if end > at:
            end += len(re.match("={0,2}", text[end : end + 2])[0])
            out.append((at, end))
        at = text.find(OPENSSH, max(end, at + len(OPENSSH)))
    return out


def armoured(body: str, label: str) -> bool:
    """Whether what stands between armour lines is a key; headers and line ends are set aside."""
    plain = body.replace("\\r", "").replace("\\n", "\n")
    headers = HEADER.findall(plain)
    data = decoded(re.sub(r"\s+", "", CHECKSUM.sub("", HEADER.sub("", plain))))
    if not data:
        return False
    if label.endswith("BLOCK"):
        return is_pgp_secret(data)
    if any(h.startswith("Proc-Type:") and "ENCRYPTED" in h for h in headers):  # the bytes are a cipher's blocks
        return any(h.startswith("DEK-Info:") for h in headers) and len(data) >= 16 and len(data) % 8 == 0
    return is_private_key(data) or is_openssh(data) or ("ENCRYPTED" in label and is_wrapped_key(data))


def gathered(text: str, at: int, n: int, run: re.Pattern, gap: re.Pattern) -> tuple[str, int]:
    """Up to n characters of an alphabet from a place on, and where they end, over gaps of one kind."""
    parts, held = [], 0
    while held < n:
        m = run.match(text, at)
        if not m:
            break
        part = m[0][: n - held]
        parts.append(part)
        held, at = held + len(part), at + len(part)
        if held < n:
            g = gap.match(text, at)
            if not g or g.end() == at:
                break
            at = g.end()
    return "".join(parts), at


def bare_keys(text: str) -> list[tuple[int, int]]:
    """Keys without armour, in base64 or hex; each is as long as it declares to be."""
    out, done = [], 0
    for m in BARE.finditer(text):
        n = declared(decoded(text[m.start() : m.start() + 16]) or b"") if m.start() >= done else None
        if n:
            body, end = gathered(text, m.start(), -(-n * 4 // 3), RUN, BREAK)
            data = decoded(body)
            if data and is_private_key(data[:n]):
                done = end + len(re.match("={0,2}", text[end : end + 2])[0])
                out.append((m.start(), done))
    done = 0
    for m in BARE_HEX.finditer(text):
        head = bytes.fromhex(re.sub(":", "", text[m.start() : m.start() + 21])[:14]) if m.start() >= done else b""
        n = declared(head)
        if n:
            body, end = gathered(text, m.start(), 2 * n, HEX_RUN, HEX_BREAK)
            if len(body) == 2 * n and is_private_key(bytes.fromhex(body)):
                done = end
                out.append((m.start(), end))
    return out


def is_signed_token(head: str, body: str) -> bool:
    try:
        header = json.loads(decoded(head) or b"")
        return isinstance(header, dict) and isinstance(header.get("alg"), str) and isinstance(json.loads(decoded(body) or b""), dict)
    except (ValueError, UnicodeDecodeError, RecursionError):
        return False


def base_spans(text: str) -> list[tuple[int, str, int]]:
    out = []
    if "=" in text or ":" in text:
        out += [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        out += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text)]
    return out + [(m.start(), "hex", m.end()) for m in HEX.finditer(text)]


def confirmed_spans(text: str) -> list[tuple[int, str, int]]:
    out = []
    if "-----BEGIN" in text:
        begins = list(BEGIN.finditer(text))
        for m, limit in zip(begins, [*[b.start() for b in begins[1:]], len(text)]):
            last = f"-----END {m[1]}-----"
            end = text.find(last, m.end(), limit)
            if end >= 0 and armoured(text[m.end() : end], m[1]):
                out.append((m.start(), "pem", end + len(last)))
    starts, ends = [a for a, _, _ in out], [b for _, _, b in out]
    inside = lambda a: (k := bisect_right(starts, a)) > 0 and a < ends[k - 1]
    out += [(a, "key", b) for a, b in bare_keys(text) if not inside(a)]
    if OPENSSH in text:
        out += [(a, "openssh", b) for a, b in openssh_keys(text) if not inside(a)]
    if "ey" in text or "ew" in text:
        out += [(m.start(), "token", m.end()) for m in SIGNED.finditer(text) if is_signed_token(m[1], m[2])]
    return out


def scan_text(text: str) -> dict:
    base = base_spans(text)
    spans = sorted({*base, *confirmed_spans(text)}, key=lambda s: (s[0], KINDS.index(s[1]), s[2]))
    return {f"n_{k}": sum(s[1] == k for s in base) for k in BASE} | {"spans": [{"kind": k, "start": a, "end": b} for a, k, b in spans]}


def find_secrets(docs: DataFrame, *, text: str = "text", result: str = "secrets") -> DataFrame:
    """``docs`` with a struct column: counts of the base kinds, and all spans in order."""

    def scan(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            yield pa.array((scan_text(x.as_py() or "") for x in column), ARROW)

    return docs.withColumn(result, F.arrow_udf(scan, returnType=SHAPE, functionType=ArrowUDFType.SCALAR_ITER)(F.col(text)))


def joined(spans):
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    spans = F.col("secrets.spans")
    return found.select(
        "doc_id", *[F.col(f"secrets.n_{k}").alias(f"n_{k}") for k in BASE],
        F.sha2(joined(F.filter(spans, lambda s: s["kind"].isin(*BASE))), 256).alias("base_sha256"), joined(spans).alias("spans"),
    )
