"""Secrets in texts: patterns, and candidates that prove their structure.

Patterns give the kinds `assign`, `access` and `hex`. On top of them, base64 and
hex candidates are decoded and reported only if what they hold parses:

- `key`: a private key in DER, whose nested lengths fill the value exactly and
  whose algorithm is one of keys, or a PEM block or bare candidate that holds one;
- `ssh`: a private key file of the openssh-key-v1 format, length by length;
- `jwt`: a signed token whose header and claims are JSON objects and whose
  signature has the size of the algorithm that the header names; it is not checked.

A candidate that decodes to the text of a PEM block is parsed once more inside.

Spans are code points of the text, end exclusive, ordered by start and kind.
Spans of different kinds may overlap. Nulls and empty texts have none, equal
texts have equal spans, an empty table stays empty, other columns pass through.
"""

from __future__ import annotations

import base64
import binascii
import bisect
import itertools
import json
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame

from razonete.llm.common import add_columns

KINDS = ("assign", "access", "hex", "key", "ssh", "jwt")

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")

PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----((?:[^-]|-(?!----))+)-----END \1-----")
# "ey" begins the base64 of an opening brace and a quote or space, "ew" that of one and a line end or tab.
JWT = re.compile(r"(?<![A-Za-z0-9_-])(e[yw][A-Za-z0-9_-]+)\.(e[yw][A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)")
# Long enough for the smallest private keys, of 256-bit curves.
# Lines of a wrapped value are as long, its last one may be shorter.
BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])([A-Za-z0-9+/_-]{48,}={0,2}(?:\r?\n[A-Za-z0-9+/_-]{48,}={0,2})*)(\r?\n[A-Za-z0-9+/_-]+={0,2})?")
HEX_ANY = re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{72,}(?![0-9A-Fa-f])")
LINE = re.compile(r"[A-Za-z0-9+/_=-]+")
# Line ends written out, as in JSON strings.
ESCAPED = re.compile(r"\\+r(?:\\+n)?|\\+n")

SEQUENCE, INTEGER, BITS, OCTETS, OBJECT_ID = 0x30, 0x02, 0x03, 0x04, 0x06
# Tagged fields of elliptic keys, and of PKCS #8.
CURVE, POINT = 0xA0, 0xA1
ATTRIBUTES, PUBLIC = 0xA0, 0x81

# The base64 of a key begins so: the tag of a sequence and a length, or the name of the format.
BEGIN = re.compile(r"M[C-I]|b3BlbnNzaC1rZXktdjE")
BEGIN_HEX = re.compile(r"(?=30(?:[2-7][0-9A-Fa-f]|8[12]))")
PADDING = re.compile("={0,2}")
PIECE = re.compile(r"[A-Za-z0-9+/_-]+")
# What may stand within a value: line ends, written out too, with blanks or a mark of quotes and comments before the next
# line; the ends of two strings that are joined.
GAP = re.compile(r"""(?:\\+[rn])*(?:[ \t]*\r?\n[ \t]*(?:[#>*][ \t]+)?|["'][ \t]*[+,\\]?[ \t]*(?:\r?\n[ \t]*)*[+,]?[ \t]*["'])?""")
# No key of the known schemes has more bytes.
MOST_BYTES = 1 << 16

# Bytes of a token's signature by its algorithm; the least for those that depend on the key.
SIGNED = {"HS256": (32,), "HS384": (48,), "HS512": (64,), "ES256": (64,), "ES256K": (64,), "ES384": (96,), "ES512": (132,),
          "EdDSA": (64, 114), "Ed25519": (64,), "Ed448": (114,)}
SIGNED_BY_KEY = {"RS256": 128, "RS384": 128, "RS512": 128, "PS256": 128, "PS384": 128, "PS512": 128}


def der_items(data: bytes) -> list[tuple[int, bytes]] | None:
    """Tags and contents of the DER values that fill `data`, or None if they do not."""
    items, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size, at = data[at], data[at + 1], at + 2
        if size >= 0x80:
            width = size - 0x80
            if not 0 < width <= 4 or at + width > len(data):
                return None
            size, at = int.from_bytes(data[at:at + width], "big"), at + width
            if size < 0x80 or size >> 8 * (width - 1) == 0:
                return None
        if at + size > len(data):
            return None
        items.append((tag, data[at:at + size]))
        at += size
    return items


def names_of(prefix: str, *ends: str) -> set[bytes]:
    return {bytes.fromhex(prefix + end) for end in ends}


# Object identifiers in DER, by what the octets of a PKCS #8 key hold.
RSA_KEYS = names_of("2a864886f70d0101", "01", "07", "0a")  # encryption, OAEP, PSS
NUMBER_KEYS = names_of("", "2a8648ce380401", "2a864886f70d010301", "2a8648ce3e0201")  # DSA, Diffie-Hellman (PKCS #3, X9.42)
CURVE_KEYS = names_of("2a8648ce3d02", "01")
OCTET_KEYS = {b"\x2b\x65" + bytes([n]): size for n, size in ((110, 32), (111, 56), (112, 32), (113, 57))}  # X25519, X448, Ed25519, Ed448
# Schemes of encrypted keys: with a salt and a count (PKCS #5 version 1, PKCS #12), with named parts (version 2).
SALTED = names_of("2a864886f70d0105", "01", "03", "04", "06", "0a", "0b") | names_of("2a864886f70d010c01", "01", "02", "03", "04", "05", "06")
IN_PARTS = names_of("2a864886f70d0105", "0d")


def fields_of(tag: int, data: bytes) -> list[tuple[int, bytes]]:
    """The values within a sequence; none if it is no sequence or does not parse."""
    return (der_items(data) or []) if tag == SEQUENCE else []


def algorithm(tag: int, data: bytes) -> tuple[bytes, list[tuple[int, bytes]]]:
    """Name and parameters of an algorithm identifier; an empty name if it is none."""
    named = fields_of(tag, data)
    return (named[0][1], named[1:]) if named and named[0][0] == OBJECT_ID and len(named) <= 2 else (b"", [])


def is_curve_key(fields: list[tuple[int, bytes]], named: bool) -> bool:
    """SEC 1: version, number, then the curve and the public point, each optional; a curve `named` elsewhere may lack."""
    if [tag for tag, _ in fields[:2]] != [INTEGER, OCTETS] or fields[0][1] != b"\1" or len(fields[1][1]) < 16:
        return False
    rest = [tag for tag, _ in fields[2:]]
    if rest not in ([CURVE], [POINT], [CURVE, POINT]):
        return named and not rest
    inner = {tag: der_items(data) for tag, data in fields[2:]}
    curve, point = inner.get(CURVE, [(OBJECT_ID, b"-")]), inner.get(POINT, [(BITS, b"-")])
    return all(found and len(found) == 1 and found[0][0] in tags and found[0][1]
               for found, tags in ((curve, (OBJECT_ID, SEQUENCE)), (point, (BITS,))))


def is_plain_key(name: bytes, data: bytes) -> bool:
    """Whether the octets of a PKCS #8 key hold what its algorithm says."""
    inner = der_items(data)
    if not inner or len(inner) != 1:
        return False
    tag, content = inner[0]
    if name in RSA_KEYS:
        return is_numbers(fields_of(tag, content), 9)
    if name in CURVE_KEYS:
        return is_curve_key(fields_of(tag, content), named=True)
    return (name in NUMBER_KEYS and tag == INTEGER and len(content) >= 16) or (tag == OCTETS and OCTET_KEYS.get(name) == len(content))


def is_numbers(fields: list[tuple[int, bytes]], n: int) -> bool:
    """RSA (9) and DSA (6): version 0 and numbers."""
    return [tag for tag, _ in fields] == [INTEGER] * n and fields[0][1] == b"\0" and all(number for _, number in fields)


def is_encryption(name: bytes, parameters: list[tuple[int, bytes]]) -> bool:
    """Whether a known scheme stands there with its own parameters: salt and count, or derivation and cipher."""
    parts = fields_of(*parameters[0]) if parameters else []
    if name in SALTED:
        return [tag for tag, _ in parts] == [OCTETS, INTEGER]
    return name in IN_PARTS and len(parts) == 2 and all(algorithm(*part)[0] for part in parts)


def is_private_key(data: bytes) -> bool:
    """Whether `data` is one private key in DER: PKCS #1, PKCS #8 (plain or encrypted) or SEC 1, at every level.

    A digest or certificate has the same outer shape as some keys; its algorithm is none of keys.
    """
    outer = der_items(data)
    if not outer or len(outer) != 1:
        return False
    fields = fields_of(*outer[0])
    tags = [tag for tag, _ in fields]
    if is_numbers(fields, 9) or is_numbers(fields, 6) or is_curve_key(fields, named=False):
        return True
    if tags[:3] == [INTEGER, SEQUENCE, OCTETS] and tags[3:] in ([], [ATTRIBUTES], [PUBLIC], [ATTRIBUTES, PUBLIC], [POINT]):
        return fields[0][1] in (b"\0", b"\1") and is_plain_key(algorithm(*fields[1])[0], fields[2][1])
    return tags == [SEQUENCE, OCTETS] and is_encryption(*algorithm(*fields[0])) and len(fields[1][1]) >= 16


def is_ssh_key(data: bytes) -> bool:
    """Whether `data` is a key file of openssh-key-v1: strings of stated lengths, to the end."""
    magic = b"openssh-key-v1\0"
    if not data.startswith(magic):
        return False
    at, keys = len(magic), 1
    for field in range(4 + keys):  # cipher, derivation, its options, public key, private keys
        if field == 3:
            keys, at = int.from_bytes(data[at:at + 4], "big"), at + 4
            if keys != 1:
                return False
        if at + 4 > len(data):
            return False
        at += 4 + int.from_bytes(data[at:at + 4], "big")
    return at == len(data)


def from_base64(text: str) -> bytes | None:
    """The bytes of base64 in either alphabet, padded or not, line ends ignored."""
    text = "".join(text.split()).rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def key_kind(data: bytes | None, depth: int = 1) -> str | None:
    """What decoded bytes hold: `key`, `ssh` or nothing known."""
    if not data:
        return None
    if is_private_key(data):
        return "key"
    if is_ssh_key(data):
        return "ssh"
    if depth and b"-----BEGIN " in data and (block := PEM.search(data.decode("latin-1"))):
        return pem_kind(block[2], depth - 1)
    return None


def pem_kind(body: str, depth: int = 1) -> str | None:
    """What the body of a PEM block holds. Under an encryption header that is whole cipher blocks."""
    body = ESCAPED.sub("\n", body)
    data = from_base64("".join(line for line in body.splitlines() if ":" not in line))
    if "DEK-Info:" in body:
        return "key" if data and len(data) % 8 == 0 else None
    return key_kind(data, depth)


def json_object(part: str) -> dict | None:
    try:
        value = json.loads(from_base64(part) or b"")
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def is_signed_token(header: str, claims: str, signature: str) -> bool:
    """Whether header and claims are objects, and the signature has the size that the header's algorithm gives.

    Signatures of other algorithms than the registered ones may have any size; those of `none` are none.
    """
    head, signed = json_object(header), from_base64(signature)
    name = (head or {}).get("alg")
    if not isinstance(name, str) or name.lower() == "none" or not signed or json_object(claims) is None:
        return False
    return len(signed) in SIGNED.get(name, (len(signed),)) and len(signed) >= SIGNED_BY_KEY.get(name, 1)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Matches of the three patterns: leftmost first, without overlap within a kind."""
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return found


def key_size(head: bytes) -> int:
    """The number of bytes of the DER value that begins so, or 0 if none does that could be a key."""
    if len(head) < 2 or head[0] != SEQUENCE:
        return 0
    size, width = head[1], 0
    if size >= 0x80:
        width = size - 0x80
        if not 0 < width <= 4 or len(head) < 2 + width:
            return 0
        size = int.from_bytes(head[2:2 + width], "big")
    return 2 + width + size


def ssh_size(read: Callable[[int, int], bytes]) -> int:
    """The number of bytes of a key file, whose bytes `read` gives by place and number, or 0 if it is none."""
    magic = b"openssh-key-v1\0"
    if read(0, len(magic)) != magic:
        return 0
    at = len(magic)
    for field in range(5):
        at += 4 * (field == 3)
        if len(size := read(at, 4)) < 4:
            return 0
        at += 4 + int.from_bytes(size, "big")
    return at


def parts_of(text: str, start: int, end: int) -> list[tuple[int, int, str]]:
    """Values within joined lines: each begins with a line, and ends with the one where its stated length does.

    A line after the end of a value may begin the next one.
    """
    lines = [(m.start(), m.end()) for m in LINE.finditer(text, start, end)]
    joined = "".join(text[a:b] for a, b in lines)
    begins = [0, *itertools.accumulate(b - a for a, b in lines)]
    ends = {begins[i] + len(text[a:b].rstrip("=")): i for i, (a, b) in enumerate(lines)}
    pads, decoded = [*(m.start() for m in re.finditer("=+", joined)), len(joined)], {}
    found, i = [], 0
    while i < len(lines):
        at, last, kind = begins[i], i, key_kind(from_base64(text[slice(*lines[i])]))

        def read(place: int, size: int) -> bytes:
            data = from_base64(joined[at + place // 3 * 4:at + -(-(place + size) // 3) * 4].rstrip("=")) or b""
            return data[place % 3:place % 3 + size]

        if not kind:
            size = key_size(read(0, 6)) or ssh_size(read)
            if not size and read(0, 11) == b"-----BEGIN ":
                to = bisect.bisect_left(pads, at)
                region = (pads[to], at % 4)
                if region not in decoded:
                    decoded[region] = at, (from_base64(joined[at:pads[to]]) or b"").decode("latin-1")
                base, value = decoded[region]
                place = (at - base) // 4 * 3
                # A line end may follow within the value.
                if block := PEM.match(value, place):
                    size = next((n for n in range(block.end() - place, block.end() - place + 3) if at + -(-n * 4 // 3) in ends), 0)
            last = ends.get(at + -(-size * 4 // 3), -1) if size else -1
            kind = key_kind(from_base64(text[lines[i][0]:lines[last][1]])) if last > i else None
        if kind:
            found.append((lines[i][0], lines[last][1], kind))
        i = last + 1 if kind else i + 1
    return found


def hex_spans(run: str, start: int) -> list[tuple[int, int, str]]:
    """The value that a run of hex digits is, or is but for one digit at either end; else the keys that begin in it and reach to its end."""
    even = len(run) // 2 * 2
    for at in range(1 + len(run) % 2):
        if (kind := key_kind(bytes.fromhex(run[at:at + even]))):
            return [(start + at, start + at + even, kind)]
    found, row, at = [], [], 0
    while begin := BEGIN_HEX.search(run, at):
        place = begin.start()
        if row and place != at:
            row = []
        at = place + 1
        size = 2 * may_be_key(bytes.fromhex(run[place:place + 18])) if len(run) >= place + 18 else 0
        if 0 < size <= len(run) - place and is_private_key(bytes.fromhex(run[place:place + size])):
            at = place + size
            row.append((start + place, start + at, "key"))
            if at == len(run):
                found = row
    return found


def jwt_spans(text: str) -> list[tuple[int, int, str]]:
    return [(m.start(), m.end(), "jwt") for m in JWT.finditer(text) if is_signed_token(*m.groups())]


def collect(text: str, at: int, n: int) -> tuple[str, int]:
    """`n` base64 characters from a place on, gaps left out, and where they end; fewer where the value ends before."""
    parts, end = [], at
    while n and (piece := PIECE.match(text, at, at + n)):
        parts.append(piece[0])
        n, end = n - len(piece[0]), piece.end()
        at = GAP.match(text, end).end()
        if at == end:
            break
    return "".join(parts), end


def may_be_key(head: bytes) -> int:
    """The number of bytes of a key that begins so (9 bytes), or 0: a version or an algorithm comes first."""
    size = key_size(head)
    inner = head[2 + max(head[1] - 0x80, 0):] if size else b""
    return size if size <= MOST_BYTES and (inner[:2] == b"\2\1" or inner[:1] == b"\x30") else 0


def keys_anywhere(text: str) -> list[tuple[int, int, str]]:
    """Keys in base64 at every place where one can begin, by their stated lengths, whatever stands before and behind.

    They may be wrapped at any width, cut into strings that are joined, or follow each other without a mark. The last of
    such a row ends where the base64 does, else there is more in the value than keys.
    """
    found, row, at = [], [], 0
    while begin := BEGIN.search(text, at):
        start = begin.start()
        if row and start != at:
            row = []
        at = start + 1
        if text[start] == "M":
            size = may_be_key(from_base64(collect(text, start, 12)[0]) or b"")
        else:
            size = ssh_size(lambda place, n: (from_base64(collect(text, start, -(-(place + n) * 4 // 3))[0]) or b"")[place:place + n])
            size *= size <= MOST_BYTES
        n = -(-size * 4 // 3)
        value, end = collect(text, start, n) if size else ("", start)
        kind = key_kind(from_base64(value), 0) if size and len(value) == n else None
        if not kind:
            row = []
            continue
        at = PADDING.match(text, end).end()
        row.append((start, at, kind))
        if at > end or not PIECE.match(text, at, at + 1):
            found += row
            row = []
    return found


def confirmed_spans(text: str) -> list[tuple[int, int, str]]:
    """Candidates whose decoded content parses."""
    found = []
    if "-----BEGIN " in text:
        found += [(m.start(), m.end(), kind) for m in PEM.finditer(text) if (kind := pem_kind(m[2]))]
    if "ey" in text or "ew" in text:
        found += jwt_spans(text)
    bare = []
    for m in BASE64.finditer(text):
        whole = [(m.start(), end, kind) for end in sorted({m.end(1), m.end()}) if (kind := key_kind(from_base64(text[m.start():end])))]
        bare += whole or parts_of(text, m.start(), m.end())
    for m in HEX_ANY.finditer(text):
        bare += hex_spans(m[0], m.start())
    bare += outside(keys_anywhere(text), bare)
    return found + outside(bare, found)


def outside(spans: list[tuple[int, int, str]], others: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """The spans that lie in none of the others."""
    starts = sorted((start, end) for start, end, _ in others)
    reach = list(itertools.accumulate((end for _, end in starts), max))
    return [s for s in spans if not (i := bisect.bisect_right(starts, s[0], key=lambda o: o[0])) or reach[i - 1] < s[1]]


def spans_of(text: str | None) -> list[tuple[int, int, str]]:
    """All spans (start, end, kind) of a text, by start, kind and end, each once."""
    if not text:
        return []
    return sorted({*base_spans(text), *confirmed_spans(text)}, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def find(docs: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """Add the secrets of each text as an array of (kind, start, end)."""
    fields = f"`{spans}` array<struct<kind: string, start: bigint, end: bigint>>"
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(column: pa.Array) -> list[pa.Array]:
        found = [[{"kind": k, "start": a, "end": b} for a, b, k in spans_of(t)] for t in column.to_pylist()]
        return [pa.array(found, kind)]

    return add_columns(docs, text, fields, run)


def redact_text(text: str | None, mark: str) -> str | None:
    """The text with each secret, or run of overlapping secrets, replaced by `mark`."""
    if not text:
        return text
    pieces, at = [], 0
    for start, end, _ in spans_of(text):
        if start >= at:
            pieces += [text[at:start], mark]
        at = max(at, end)
    return "".join(pieces) + text[at:] if pieces else text


def redact(docs: DataFrame, text: str = "text", redacted: str = "redacted", mark: str = "[secret]") -> DataFrame:
    """Add each text without its secrets; null stays null."""
    return add_columns(docs, text, f"`{redacted}` string",
                       lambda column: [pa.array([redact_text(t, mark) for t in column.to_pylist()], pa.string())])
