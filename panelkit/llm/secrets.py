"""Secrets in texts, confirmed by their structure.

Patterns propose assignments, access ids and hex runs (always reported when
they pass their length check) and base64, hex and dotted candidates, which are
reported only when they decode to something with the inner structure of a key:

* ``der``: base64 or hex of a DER SEQUENCE whose nested lengths fit exactly and
  that starts like a private key (a version number and then key material);
  base64 may be wrapped, with line ends that may be written out (``\\n``);
* ``pem``: an armoured block whose body decodes to such a DER key or to an
  OpenSSH key container with consistent inner lengths;
* ``jwt``: three base64url segments with a JSON header that names an algorithm
  and a JSON object as payload; the header may be written with white space.

Scanning is per text and linear; documents need no shuffle. It runs as an Arrow
batch function, since decoding has no built-in equivalent.

Defined results: a null text counts as empty and has no spans; every row gives
one row, whatever its id; repeated rows repeat; further columns are ignored.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from panelkit.llm.common import small_batches

# Kinds in the order of ties, and the base patterns.
KINDS = ["assign", "access", "hex", "jwt", "pem", "der"]
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")

#: Candidates of the structural kinds.
#: A token's header is base64url of an opening brace and white space or a quote.
JWT = re.compile(r"(?<![A-Za-z0-9_-])(?=(e[wy][A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*))")
PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----((?:[A-Za-z0-9+/=\s]|\\+[rn])++)-----END \1-----")
BASE64_DER = re.compile(r"(?<![A-Za-z0-9+/])M[A-Za-z0-9+/]{39,}={0,2}")
HEX_DER = re.compile(r"(?<![0-9A-Fa-f])30[0-9A-Fa-f]{62,}")
#: A key wrapped into lines, whose ends may be written out as in JSON.
WRAPPED_DER = re.compile(r"(?:(?<![A-Za-z0-9+/])|(?<=\\n))M[A-Za-z0-9+/]{39}")
RUN = re.compile(r"[A-Za-z0-9+/]+")
LINE_END = re.compile(r"\r?\n[\x20\t]*|(?:\\+r)?\\+n")
MIN_CHARS = {"assign": 8, "access": 16, "hex": 32}
MAX_DEPTH = 16


def decode64(s: str, url: bool = False) -> bytes | None:
    try:
        raw = re.sub(r"\s|\\+[rn]", "", s).rstrip("=")
        raw += "=" * (-len(raw) % 4)
        return base64.urlsafe_b64decode(raw) if url else base64.b64decode(raw, validate=True)
    except (binascii.Error, ValueError):
        return None


def der_items(b: bytes, at: int, end: int, depth: int = 0) -> list[tuple[int, int, int]] | None:
    """(tag, start, end) of the items that fill b[at:end] exactly, with every
    constructed item filled exactly in turn; None when lengths don't fit."""
    out = []
    while at < end:
        if at + 2 > end or depth > MAX_DEPTH:
            return None
        tag, size, at = b[at], b[at + 1], at + 2
        if size >= 0x80:
            n = size & 0x7F
            if not 1 <= n <= 4 or at + n > end:
                return None
            size, at = int.from_bytes(b[at:at + n], "big"), at + n
        if at + size > end or (tag & 0x20 and der_items(b, at, at + size, depth + 1) is None):
            return None
        out.append((tag, at, at + size))
        at += size
    return out


def is_der_key(b: bytes | None) -> bool:
    """A DER SEQUENCE that holds a small version INTEGER and then key material:
    big integers (RSA, DSA), an octet string (EC) or an algorithm identifier
    with an octet string (PKCS 8); or an encrypted PKCS 8 pair."""
    if not b or b[0] != 0x30:
        return False
    top = der_items(b, 0, len(b))
    if not top or len(top) != 1:
        return False
    items = der_items(b, top[0][1], top[0][2]) or []
    tags, sizes = [t for t, _, _ in items], [e - s for _, s, e in items]
    if tags[:1] == [0x02] and sizes[0] == 1 and b[items[0][1]] <= 3:
        if len(tags) >= 5 and set(tags[1:]) <= {0x02, 0x30} and sizes[1] >= 16:
            return True
        if tags[1:2] == [0x04] and sizes[1] >= 16:
            return True
        return tags[1:3] == [0x30, 0x04] and _is_algorithm(b, items[1])
    return tags == [0x30, 0x04] and _is_algorithm(b, items[0]) and sizes[1] >= 32


def _is_algorithm(b: bytes, item: tuple[int, int, int]) -> bool:
    inner = der_items(b, item[1], item[2]) or []
    return bool(inner) and inner[0][0] == 0x06


def wrapped_end(text: str, at: int) -> int | None:
    """Where the base64 of the DER item at ``at`` ends by the item's own length
    (of at most two bytes), across line ends; None if other text comes first."""
    head = decode64(text[at:at + 8]) or b"\x00"
    if head[0] != 0x30 or 0x82 < head[1] or head[1] == 0x80:
        return None
    n = head[1] & 0x7F if head[1] > 0x80 else 0
    size = 2 + n + (int.from_bytes(head[2:2 + n], "big") if n else head[1])
    left = (8 * size + 5) // 6  # characters
    while left:
        run = RUN.match(text, at, at + left)
        if not run:
            return None
        left, at = left - len(run[0]), run.end()
        if left:
            end = LINE_END.match(text, at)
            if not end:
                return None
            at = end.end()
    while at < len(text) and text[at] == "=":
        at += 1
    return None if RUN.match(text, at) else at


def is_openssh_key(b: bytes | None) -> bool:
    """The OpenSSH container: magic, then cipher, kdf and options as counted
    strings, a key count and that many counted public keys."""
    magic = b"openssh-key-v1\x00"
    if not b or not b.startswith(magic):
        return False
    at = len(magic)
    for _ in range(3):
        size = int.from_bytes(b[at:at + 4], "big")
        at += 4 + size
        if at > len(b):
            return False
    keys, at = int.from_bytes(b[at:at + 4], "big"), at + 4
    if not keys:
        return False
    for _ in range(keys + 1):  # the public keys, then the private block; each takes four bytes at least
        at += 4 + int.from_bytes(b[at:at + 4], "big")
        if at > len(b):
            return False
    return True


def is_signed_token(s: str) -> bool:
    head, body, _ = s.split(".", 2)
    try:
        header = json.loads(decode64(head, url=True) or b"")
        return isinstance(header, dict) and isinstance(header.get("alg"), str) and isinstance(json.loads(decode64(body, url=True) or b""), dict)
    except (ValueError, RecursionError):
        return False


def tokens(text: str) -> list[tuple[int, int, int]]:
    """Signed tokens. Candidates may overlap: one that is not confirmed hides
    no later one, one that is takes its characters."""
    out, end = [], 0
    for m in JWT.finditer(text):
        if m.start() >= end and is_signed_token(m[1]):
            end = m.end(1)
            out.append((m.start(), 3, end))
    return out


def spans(text: str | None) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of every secret in a text, sorted."""
    if not text:
        return []
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_CHARS["assign"]]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_CHARS["access"]]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    out += tokens(text)
    if "PRIVATE KEY-----" in text:
        for m in PEM.finditer(text):
            if is_der_key(b := decode64(m[2])) or is_openssh_key(b):
                out.append((m.start(), 4, m.end()))
    armoured = [(s, e) for s, k, e in out if k == 4]
    der = {(m.start(), 5, m.end()) for m in BASE64_DER.finditer(text) if is_der_key(decode64(m[0]))}
    for m in WRAPPED_DER.finditer(text):
        end = wrapped_end(text, m.start())
        if end and not any(s < m.start() < e for s, e in armoured) and is_der_key(decode64(text[m.start():end])):
            der.add((m.start(), 5, end))
    out += der
    for m in HEX_DER.finditer(text):
        if (m.end() - m.start()) % 2 == 0 and is_der_key(bytes.fromhex(m[0])):
            out.append((m.start(), 5, m.end()))
    return sorted(out)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = [spans(x.as_py()) for x in b["text"]]
        yield pa.RecordBatch.from_arrays(
            [b["id"], pa.array([[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in f] for f in found],
                               pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))],
            names=["id", "spans"])


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, spans): one row per document, spans sorted by start, kind."""
    small_batches(docs.sparkSession)
    d = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return (d.mapInArrow(_scan, "id long, spans array<struct<kind string, start bigint, end bigint>>")
            .select(F.col("id").alias(id_col), "spans"))


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: counts of the base kinds, the digest of the base spans,
    all spans as text and the counts of the structural kinds."""
    f = find(docs, id_col, text_col)
    text = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")
    base = F.filter("spans", lambda s: s.kind.isin(*KINDS[:3]))
    count = lambda k: F.size(F.filter("spans", lambda s: s.kind == k)).cast("long").alias(f"n_{k}")
    return f.select(F.col(f"`{id_col}`").alias("doc_id"), *[count(k) for k in KINDS[:3]],
                    F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"),
                    *[count(k) for k in KINDS[3:]])
