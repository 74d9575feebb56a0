"""Secrets in texts: patterns, and encoded values confirmed by their structure.

A base64 or hex candidate is reported only if what it decodes to has the structure of a secret: the nested lengths of a
key encoding (ASN.1 private keys, the binary form of secure-shell keys), the headers of a signed token, or text that
holds a secret itself.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.tables import texts_of

# Kinds in the order in which spans that start together are listed. The first three are the base patterns.
KINDS = ("assign", "access", "hex", "token", "key", "encoded")
BASE = KINDS[:3]

_ASSIGN = re.compile(rb"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
# the same as runs of any length of which those under 24 are dropped: a run is always taken whole
_HEX = re.compile(rb"[0-9a-f]{24,}")
# the body may hold hyphens (headers of encrypted keys), but no other boundary
_BLOCK = re.compile(rb"-----BEGIN ([A-Z0-9 ]{0,40}PRIVATE KEY)-----([^-]+(?:-(?!----)[^-]*)*)-----END \1-----")
# the headers of an encrypted key, also where line breaks have become spaces
_LOCKED = re.compile(rb"Proc-Type:\s*4,\s*ENCRYPTED(?!\S)")
_HEADERS = re.compile(rb"Proc-Type:\s*4,\s*ENCRYPTED(?!\S)|DEK-Info:\s*[A-Za-z0-9-]+(?:,\s*[0-9A-Fa-f]+)?(?!\S)")
# base64 of an opening brace, then of a quote or white space
_SIGNED = re.compile(rb"(?<![A-Za-z0-9_-])(e[yw][A-Za-z0-9_-]{6,})\.([A-Za-z0-9_-]{2,})\.([A-Za-z0-9_-]*)")
_BASE64 = re.compile(rb"[A-Za-z0-9+/_-]{24,}={0,2}")
_HEXES = re.compile(rb"(?<![0-9A-Za-z])(?:[0-9a-fA-F]{2}){16,}(?![0-9A-Za-z])")

_SSH = b"openssh-key-v1\0"
# How often an encoding inside an encoding is opened.
DEPTH = 3


def from_base64(text: bytes) -> bytes | None:
    """Decoded standard or URL-safe base64, padded or not; None if it is neither."""
    text = text.rstrip(b"=").translate(bytes.maketrans(b"-_", b"+/"))
    if len(text) % 4 == 1:
        return None
    try:
        return base64.b64decode(text + b"=" * (-len(text) % 4), validate=True)
    except binascii.Error:
        return None


def elements(data: bytes) -> list[tuple[int, bytes]] | None:
    """(tag, content) of consecutive ASN.1 values whose lengths fill the data exactly; None if they don't."""
    out, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, length, at = data[at], data[at + 1], at + 2
        if length & 0x80:
            size = length & 0x7F
            if not 1 <= size <= 4 or at + size > len(data):
                return None
            length, at = int.from_bytes(data[at : at + size], "big"), at + size
        if at + length > len(data):
            return None
        out.append((tag, data[at : at + length]))
        at += length
    return out


_INTEGER, _OCTETS, _OBJECT, _SEQUENCE = 2, 4, 6, 0x30


def is_private_key(data: bytes) -> bool:
    """An ASN.1 private key: its own kind of integers, or an algorithm with the key as octets, plain or encrypted."""
    outer = elements(data)
    if not outer or len(outer) != 1 or outer[0][0] != _SEQUENCE:
        return False
    inner = elements(outer[0][1])
    if not inner:
        return False
    tags = [tag for tag, _ in inner]
    if tags[:2] == [_INTEGER, _INTEGER]:  # version, then the numbers of the key
        numbers = [x for tag, x in inner if tag == _INTEGER]
        return len(numbers) == len(inner) and len(numbers) in (6, 9) and inner[0][1] in (b"\0", b"\1")
    if tags[:2] == [_INTEGER, _OCTETS]:  # version 1, the secret number, optional curve and point
        return inner[0][1] == b"\1" and len(inner[1][1]) >= 16 and set(tags[2:]) <= {0xA0, 0xA1}
    if tags[:3] == [_INTEGER, _SEQUENCE, _OCTETS]:  # version, algorithm, key
        algorithm = elements(inner[1][1])
        return inner[0][1] in (b"\0", b"\1") and bool(algorithm) and algorithm[0][0] == _OBJECT and bool(elements(inner[2][1]))
    if tags == [_SEQUENCE, _OCTETS]:  # algorithm with its parameters, encrypted key
        algorithm = elements(inner[0][1])
        return bool(algorithm) and len(algorithm) == 2 and algorithm[0][0] == _OBJECT and algorithm[1][0] == _SEQUENCE and len(inner[1][1]) >= 16
    return False


def is_shell_key(data: bytes) -> bool:
    """The binary form of a secure-shell private key: magic, then length-prefixed fields that end with the data."""
    if not data.startswith(_SSH):
        return False
    at, fields = len(_SSH), 0
    while at < len(data):
        if fields == 3:  # the number of keys stands between the options and the public key
            if data[at : at + 4] != b"\0\0\0\1":
                return False
            at += 4
        if at + 4 > len(data):
            return False
        at += 4 + int.from_bytes(data[at : at + 4], "big")
        fields += 1
    return at == len(data) and fields == 5


def is_signed_token(header: bytes, body: bytes, signature: bytes) -> bool:
    """A header object that names its algorithm, an object or encrypted body, and a signature unless there is no algorithm."""
    parts = [from_base64(x) for x in (header, body, signature)]
    if any(x is None for x in parts):
        return False
    try:
        head = json.loads(parts[0])
        claims = json.loads(parts[1])
    except (ValueError, RecursionError):
        return False
    if not isinstance(head, dict) or not isinstance(head.get("alg"), str) or not isinstance(claims, dict):
        return False
    return len(parts[2]) >= 16 or (head["alg"].lower() == "none" and not signature)


def _block_key(body: bytes, name: bytes) -> bool:
    body = body.replace(b"\\n", b"\n").replace(b"\\r", b"")
    locked = _LOCKED.search(body) is not None
    lines = [x.strip() for x in _HEADERS.sub(b"", body).split(b"\n") if x.strip()]
    data = from_base64(b"".join(b"".join(x for x in lines if b":" not in x).split()))
    if not data:
        return False
    return is_private_key(data) or is_shell_key(data) or (locked and len(data) % 8 == 0 and len(data) >= 64)


def _hidden(data: bytes | None, depth: int) -> str | None:
    """What kind of secret decoded bytes hold, or None."""
    if not data or len(data) < 12:
        return None
    if (data[0] == _SEQUENCE and is_private_key(data)) or is_shell_key(data):
        return "key"
    # text, not noise: nearly no control bytes, and valid UTF-8
    if sum(b < 32 and b not in (9, 10, 13) for b in data[:256]):
        return None
    try:
        data.decode("utf-8")
    except UnicodeDecodeError:
        return None
    found = spans_of(data, depth - 1)
    return "encoded" if any(kind != "hex" for _, _, kind in found) else None


def base_spans(data: bytes) -> list[tuple[int, int, str]]:
    """Byte spans of the base patterns, leftmost and not overlapping within a kind."""
    out = [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(data) if m.end(2) - m.start(2) >= 6]
    out += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(data) if m.end() - m.start() >= 20]
    return out + [(m.start(), m.end(), "hex") for m in _HEX.finditer(data)]


def spans_of(data: bytes, depth: int = DEPTH) -> list[tuple[int, int, str]]:
    """Byte spans of all kinds, by start, then in the order of the kinds."""
    out = base_spans(data)
    if b"-----BEGIN" in data:
        out += [(m.start(), m.end(), "key") for m in _BLOCK.finditer(data) if _block_key(m[2], m[1])]
    blocks = [(a, b) for a, b, kind in out if kind == "key"]
    for m in _SIGNED.finditer(data):
        if is_signed_token(*m.groups()):
            out.append((m.start(), m.end(), "token"))
            blocks.append(m.span())
    if depth > 0:
        for pattern, decode in ((_BASE64, from_base64), (_HEXES, lambda x: binascii.unhexlify(x))):
            for m in pattern.finditer(data):
                if any(a <= m.start() and m.end() <= b for a, b in blocks):
                    continue
                kind = _hidden(decode(m[0]), depth)
                if kind:
                    out.append((m.start(), m.end(), kind))
    return sorted(set(out), key=lambda x: (x[0], KINDS.index(x[2]), x[1]))


def in_characters(text: str, data: bytes, spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Byte spans as spans of code points."""
    if len(text) == len(data) or not spans:
        return spans
    places, at, count = {}, 0, 0
    for place in sorted({x for span in spans for x in span[:2]}):
        count += len(data[at:place].decode("utf-8"))
        at, places[place] = place, count
    return [(places[a], places[b], kind) for a, b, kind in spans]


def secret_spans(texts: list[str]) -> Iterator[list[tuple[int, int, str]]]:
    """Spans of each text in code points, end exclusive."""
    for text in texts:
        data = text.encode("utf-8")
        yield in_characters(text, data, spans_of(data))


def redacted(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with every stretch of overlapping spans replaced by the kind of its first one, in brackets."""
    out, at, end = [], 0, -1
    for start, stop, kind in spans:
        if start >= end:
            out += [text[at:start], f"[{kind}]"]
            end = stop
        end = max(end, stop)
        at = end
    return "".join(out) + text[at:]


_SPANS = "spans array<struct<kind:string,start:long,end:long,value:string>>"


def find_secrets(documents: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, spans): for every document the secrets of its whole text with kind, start, end (code points) and value.

    Null and empty texts have none. Spans of different kinds may overlap. Repeated rows are read one by one; an empty table
    gives no rows. No shuffle.
    """
    rows = documents.select(documents[id].alias("id"), documents[text].cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        element = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())])
        for batch in batches:
            texts = texts_of(batch.column("text")).to_pylist()
            found = [
                [{"kind": k, "start": a, "end": b, "value": body[a:b]} for a, b, k in spans] for body, spans in zip(texts, secret_spans(texts))
            ]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, pa.list_(element))], ["id", "spans"])

    return rows.mapInArrow(run, f"id {kind}, {_SPANS}").withColumnRenamed("id", id)


def redact(documents: DataFrame, text: str = "text") -> DataFrame:
    """The documents with every secret in ``text`` replaced by its kind in brackets; null texts stay null."""

    @F.pandas_udf("string")
    def clean(bodies: pd.Series) -> pd.Series:
        values = [x if isinstance(x, str) else None for x in bodies]
        found = secret_spans([x or "" for x in values])
        return pd.Series([None if x is None else redacted(x, spans) for x, spans in zip(values, found)], dtype=object)

    return documents.withColumn(text, clean(text))
