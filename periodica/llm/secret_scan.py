"""Secret scan: pattern candidates, and encoded candidates confirmed by their inner structure.

Three plain kinds come from patterns alone (``assign``, ``access``, ``hex``). The method adds kinds
that are only reported when the decoded bytes hold together:

``der``   base64 or hex text that decodes to one DER SEQUENCE whose nested lengths add up exactly and
          which starts as a key does (a version or modulus INTEGER, or an algorithm identifier)
``ssh``   base64 text of length-prefixed fields, the first naming an SSH key type, or an OpenSSH
          private key container whose cipher, key derivation, public keys and private part fill it exactly
``pem``   a PEM block whose label names a key and whose body is one of the above
``token`` a signed token of three base64url parts whose header is a JSON object with ``alg``

Hex is decoded in either case. Decoded keys have at least ``MIN_BYTES`` bytes. Texts of any length are
scanned whole; of spans with equal starts the kind listed first comes first. Offsets count code points, ends are exclusive. NULL and empty texts have no spans. Rows are scanned
one by one, so repeated rows give repeated results; an empty table gives an empty one; other columns
are ignored.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodica.llm.common import slices

KINDS = ("assign", "access", "hex", "der", "ssh", "pem", "token")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ASSIGN_STEMS = ("passw", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
ANY_HEX = re.compile(r"[0-9A-Fa-f]{32,}")
ENCODED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{22,}={0,2}")
MIN_BYTES = 16
PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]*KEY)-----([A-Za-z0-9+/=\s]+)-----END \1-----")
TOKEN = re.compile(r"(?<![A-Za-z0-9_-])(ey[A-Za-z0-9_-]+)\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*")
SSH_TYPES = (b"ssh-", b"ecdsa-sha2-", b"sk-ssh-", b"sk-ecdsa-")
SSH_CONTAINER = b"openssh-key-v1\x00"


def decode_base64(text: str) -> bytes | None:
    plain = text.rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(plain + "=" * (-len(plain) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der_fields(data: bytes, start: int, stop: int) -> list[tuple[int, int, int]] | None:
    """(tag, start, stop) of the values between two offsets, or None unless their lengths add up."""
    fields = []
    while start < stop:
        if start + 2 > stop:
            return None
        tag, length, at = data[start], data[start + 1], start + 2
        if length >= 0x80:
            octets = length & 0x7F
            if not 1 <= octets <= 4 or at + octets > stop:
                return None
            length = int.from_bytes(data[at : at + octets], "big")
            at += octets
        if at + length > stop:
            return None
        fields.append((tag, at, at + length))
        start = at + length
    return fields


def is_der_key(data: bytes) -> bool:
    outer = der_fields(data, 0, len(data))
    if not outer or len(outer) != 1 or outer[0][0] != 0x30:
        return False
    inner = der_fields(data, outer[0][1], outer[0][2])
    if not inner or len(inner) < 2:
        return False
    tag, start, stop = inner[0]
    if tag == 0x02 and stop > start:  # a version or a modulus, followed by numbers, octets or an algorithm
        rest = {t for t, _, _ in inner[1:]}
        nested = all(der_fields(data, a, b) is not None for t, a, b in inner[1:] if t & 0x20)
        return nested and bool(rest & {0x02, 0x04, 0x30})
    if tag == 0x30:  # an algorithm identifier, followed by the key bits
        algorithm = der_fields(data, start, stop)
        return bool(algorithm) and algorithm[0][0] == 0x06 and inner[1][0] == 0x03
    return False


def ssh_fields(data: bytes, count: int | None = None) -> tuple[list[bytes], bytes] | None:
    """The first ``count`` length-prefixed fields (all without it) and what follows them; None if they are cut off."""
    at, fields = 0, []
    while len(fields) < count if count is not None else at < len(data):
        stop = at + 4 + int.from_bytes(data[at : at + 4], "big")
        if at + 4 > len(data) or stop > len(data):
            return None
        fields.append(data[at + 4 : stop])
        at = stop
    return fields, data[at:]


def is_public_key(data: bytes) -> bool:
    found = ssh_fields(data)
    return found is not None and len(found[0]) >= 2 and found[0][0].startswith(SSH_TYPES)


def is_ssh_key(data: bytes) -> bool:
    """A public key, or a container: cipher, key derivation and its options, then counted public keys and one private part."""
    if not data.startswith(SSH_CONTAINER):
        return is_public_key(data)
    head = ssh_fields(data[len(SSH_CONTAINER) :], 3)
    if head is None or not head[0][0] or not head[0][1] or len(head[1]) < 4:
        return False
    keys = int.from_bytes(head[1][:4], "big")
    rest = ssh_fields(head[1][4:])
    if rest is None or not keys or len(rest[0]) != keys + 1:
        return False
    return all(map(is_public_key, rest[0][:-1])) and bool(rest[0][-1])


def key_kind(data: bytes | None) -> str | None:
    if data is None or len(data) < MIN_BYTES:
        return None
    return "der" if is_der_key(data) else "ssh" if is_ssh_key(data) else None


def is_token_header(part: str) -> bool:
    data = decode_base64(part)
    try:
        header = json.loads(data) if data else None
    except (ValueError, RecursionError):
        return False
    return isinstance(header, dict) and isinstance(header.get("alg"), str)


def find_secrets(text: str) -> list[tuple[int, int, int]]:
    """(start, rank of the kind in KINDS, end) of all spans, sorted."""
    spans = []
    low = text.lower()
    if any(stem in low for stem in ASSIGN_STEMS):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 12]
    spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    for m in HEX.finditer(text):
        spans.append((m.start(), 2, m.end()))
        digits = m.group()
        if len(digits) % 2 == 0 and (kind := key_kind(bytes.fromhex(digits))):
            spans.append((m.start(), KINDS.index(kind), m.end()))
    for m in ANY_HEX.finditer(text):
        digits = m.group()
        if digits != digits.lower() and len(digits) % 2 == 0 and (kind := key_kind(bytes.fromhex(digits))):
            spans.append((m.start(), KINDS.index(kind), m.end()))
    for m in ENCODED.finditer(text):
        if kind := key_kind(decode_base64(m.group())):
            spans.append((m.start(), KINDS.index(kind), m.end()))
    if "-----BEGIN" in text:
        for m in PEM.finditer(text):
            if key_kind(decode_base64("".join(m.group(2).split()))):
                spans.append((m.start(), KINDS.index("pem"), m.end()))
    if "ey" in text:
        spans += [(m.start(), KINDS.index("token"), m.end()) for m in TOKEN.finditer(text) if is_token_header(m.group(1))]
    return sorted(spans)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text"):
            found = [find_secrets(t) if t else [] for t in batch.column("text").to_pylist()]
            counts = [pa.array([sum(s[1] == k for s in spans) for spans in found], pa.int64()) for k in range(3)]
            base = [hashlib.sha256(joined([s for s in spans if s[1] < 3]).encode()).hexdigest() for spans in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *counts, pa.array(base, pa.string()), pa.array(map(joined, found), pa.string())],
                names=["id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, counts of the plain kinds, the digest of their spans, and all spans."""
    kind = docs.schema[id_col].dataType.simpleString()
    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = f"id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return named.mapInArrow(_scan, schema).withColumnRenamed("id", id_col)
