"""Secret scan: patterns find candidates, their structure confirms them.

Three base kinds are reported by their pattern alone: ``assign``, ``access``,
``hex``. The other kinds are reported only after their content was decoded and
parsed to its end:

* ``pem``: armoured block whose base64 is a DER structure or an OpenSSH container; its line
  breaks may be escaped, and its lines quoted, joined by operators or marked as in a diff;
* ``jwt``: signed token whose header is a JSON object with a known ``alg``, whose
  payload is a JSON object and whose signature has the length that ``alg`` needs;
* ``der``: base64 of a DER SEQUENCE whose nested lengths add up to the end and
  which holds a key's numbers or object identifier;
* ``ssh``: base64 of an OpenSSH private container, or of a key blob whose length
  fields add up to the end;
* ``hexder``: the same DER check on hexadecimal digits of either case.

The last three may begin and end inside a longer run of their alphabet: such keys are cut out by
their own lengths. Base64 may go on over consecutive lines, broken in the ways named for ``pem``;
inside an armoured block that is reported, only single lines are looked at.

Spans are in code points, end exclusive. Defined cases: a null text is empty and
has no spans; repeated rows are scanned alike; an empty table gives an empty
result; columns other than id and text are ignored.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate, takewhile

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapstats.llm.common import gives_back, text_or_empty

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "pem", "jwt", "der", "ssh", "hexder")

# The base patterns.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile("AKIA[A-Z0-9]+")
_HEX = re.compile("[0-9a-f]{24,}")  # the run is taken whole, so shorter runs never hide part of a longer one

_WORDS = ("passw", "secret", "token", "api")
_PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]+)-----((?:(?!-----).)+)-?-----END \1-----", re.S)
_RUN = re.compile("[A-Za-z0-9_-]++")
_JWT = re.compile(r"eyJ[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++\.[A-Za-z0-9_-]*+")
_BASE64 = re.compile("[A-Za-z0-9+/_-]{40,}={0,2}")
_ANY_HEX = re.compile("[0-9A-Fa-f]{64,}")
_BREAK = r"(?:\\+[rn]|\r?\n|\r)"
#: Between two lines of base64: ends of lines, escaped or not, with quotes, operators and marks of comments or quoted mail.
_QUOTE = r"""["'`][ \t]*+[+.,;]?[ \t]*+\\?"""
_BETWEEN = re.compile(rf"""(?:{_BREAK}++(?:(?:{_QUOTE}|[ \t]*+\\){_BREAK}++)?|(?:{_QUOTE}|[ \t]*+\\?){_BREAK}++)"""
                      r"""[ \t]*+(?:[#>*|]++[ \t]*+|//[ \t]++)?(?:[+.][ \t]++)?["'`]?""")
_LINES = re.compile(rf"[A-Za-z0-9+/_-]{{40,}}(?:{_BETWEEN.pattern}[A-Za-z0-9+/_-]+)*")
#: How the base64 of a SEQUENCE, of an OpenSSH container and of a key blob begins.
_HEAD = re.compile("M[A-P]|b3BlbnNzaC1rZXktdjEA|AAAA[A-Z]")
#: Fields of a key blob by what its type begins with.
_FIELDS = {b"ssh-rsa": 3, b"ssh-dss": 5, b"ssh-ed": 2, b"ecdsa-sha2": 3}
#: Bytes of a signature by algorithm; RSA signatures have the length of the key.
_SIGNATURE = {"HS256": {32}, "HS384": {48}, "HS512": {64}, "ES256": {64}, "ES384": {96}, "ES512": {132}, "EdDSA": {64, 114},
              **{a + n: {128, 256, 384, 512, 1024} for a in ("RS", "PS") for n in ("256", "384", "512")}}
_INTEGER, _OCTETS, _OBJECT, _SEQUENCE = 2, 4, 6, 0x30


def decode_base64(text: str) -> bytes | None:
    """Bytes of base64 in either alphabet, with or without padding; None if it is neither."""
    body = "".join(text.split()).rstrip("=")
    if len(body) % 4 == 1 or (set("+/") & set(body) and set("-_") & set(body)):
        return None
    try:
        return base64.b64decode(body.translate(str.maketrans("-_", "+/")) + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der_tags(data: bytes, at: int = 0, end: int | None = None, depth: int = 0) -> list[int] | None:
    """Tags of all elements if nested lengths fill ``data`` exactly, else None."""
    end = len(data) if end is None else end
    tags: list[int] = []
    while at < end:
        if at + 2 > end or depth > 12:
            return None
        tag, size, at = data[at], data[at + 1], at + 2
        if size >= 0x80:
            n = size & 0x7F
            if not 1 <= n <= 4 or at + n > end:
                return None
            size, at = int.from_bytes(data[at:at + n], "big"), at + n
            if size < 0x80:
                return None  # not the shortest form
        if at + size > end:
            return None
        tags.append(tag)
        if tag & 0x20:
            inner = der_tags(data, at, at + size, depth + 1)
            if inner is None:
                return None
            tags += inner
        at += size
    return tags


def is_der_key(data: bytes) -> bool:
    """A SEQUENCE to the end with an object identifier, or with the integers of a key."""
    if len(data) < 30 or data[0] != _SEQUENCE:
        return False
    return _is_key_tags(der_tags(data))


def _is_key_tags(tags: list[int] | None) -> bool:
    return bool(tags) and tags.count(_SEQUENCE) >= 1 and (
        _OBJECT in tags and bool({_OCTETS, 3} & set(tags)) or tags.count(_INTEGER) >= 2)


def _der_end(data: bytes, at: int) -> int | None:
    """Where the key whose SEQUENCE begins at ``at`` ends, by its own length; None if there is no key."""
    if at + 2 > len(data) or data[at] != _SEQUENCE:
        return None
    size, body = data[at + 1], at + 2
    if size >= 0x80:
        body += size & 0x7F
        size = int.from_bytes(data[at + 2:body], "big")
    end = body + size
    return end if 30 <= end - at <= len(data) - at and _is_key_tags(der_tags(data, at, end)) else None


def _hex_keys(run: str) -> list[tuple[int, int]]:
    """Spans of DER keys in a run of hexadecimal digits: the whole run, or else keys that begin inside it."""
    if len(run) % 2 == 0 and is_der_key(bytes.fromhex(run)):
        return [(0, len(run))]
    out: list[tuple[int, int]] = []
    data = [bytes.fromhex(run[odd:len(run) - (len(run) - odd) % 2]) for odd in (0, 1)]
    at = run.find("30")
    while at >= 0:
        end = _der_end(data[at % 2], at // 2)
        if end is not None:
            out.append((at, 2 * end + at % 2))
        at = run.find("30", at + 1 if end is None else out[-1][1])
    return out


def _strings(data: bytes, at: int) -> list[bytes] | None:
    """Fields with a 32-bit length before them, up to the end of ``data``."""
    out = []
    while at < len(data):
        size = int.from_bytes(data[at:at + 4], "big")
        if at + 4 > len(data) or at + 4 + size > len(data):
            return None
        out.append(data[at + 4:at + 4 + size])
        at += 4 + size
    return out


def is_ssh_key(data: bytes) -> bool:
    magic = b"openssh-key-v1\0"
    if data.startswith(magic):
        at = len(magic)
        for _ in range(3):  # cipher, key derivation, its options
            size = int.from_bytes(data[at:at + 4], "big")
            at += 4 + size
            if at > len(data):
                return False
        keys = int.from_bytes(data[at:at + 4], "big")
        rest = _strings(data, at + 4)
        return rest is not None and 1 <= keys <= 16 and len(rest) == keys + 1
    fields = _strings(data, 0) if data[:2] == b"\0\0" else None
    return bool(fields) and len(fields) >= 2 and bool(re.fullmatch(rb"(ssh|ecdsa-sha2)-[a-z0-9-]+(@openssh\.com)?", fields[0]))


def _ssh_end(data: bytes, at: int) -> int | None:
    """Where the OpenSSH container or key blob that begins at ``at`` ends, by its own lengths; None if there is none."""
    magic = b"openssh-key-v1\0"
    start, left, kind = at, 0, b""
    if boxed := data.startswith(magic, at):
        at, left = at + len(magic), 3
    else:
        size = int.from_bytes(data[at:at + 4], "big")
        kind = data[at + 4:at + 4 + size] if 7 <= size <= 64 else b""
        left = next((n for k, n in _FIELDS.items() if kind.startswith(k)), 0)
    while left:
        if at + 4 > len(data):
            return None
        at += 4 + int.from_bytes(data[at:at + 4], "big")
        left -= 1
        if boxed and not left:  # after cipher, key derivation and its options: the public keys and the private part
            left, at, boxed = int.from_bytes(data[at:at + 4], "big") + 1, at + 4, False
    return at if start < at <= len(data) and is_ssh_key(data[start:at]) else None


def _inner_keys(run: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of keys that begin anywhere in a run of base64, cut out by their own lengths."""
    out: list[tuple[str, int, int]] = []
    decoded: dict[int, bytes] = {}
    found = _HEAD.search(run)
    while found:
        at = found.start()
        next_at = at + 1
        phase = at % 4
        if phase not in decoded:
            body = run[phase:].translate(str.maketrans("-_", "+/"))
            body = body[:len(body) - (len(body) % 4 == 1)]
            decoded[phase] = base64.b64decode(body + "=" * (-len(body) % 4))
        data, start = decoded[phase], (at - phase) // 4 * 3
        end = _der_end(data, start) if run[at] == "M" else _ssh_end(data, start)
        if end is not None:
            stop = at + -(-(end - start) * 4 // 3)
            if decode_base64(run[at:stop]) is not None:  # one alphabet
                out.append(("der" if run[at] == "M" else "ssh", at, stop))
                next_at = stop
        found = _HEAD.search(run, next_at)
    return out


def _wrapped_keys(text: str, start: int, end: int) -> list[tuple[str, int, int]]:
    """Keys in the lines of base64 at ``start`` to ``end``, read as one run; with and without the marks of a diff."""
    lines, at = [], start
    for gap in _BETWEEN.finditer(text, start, end):
        lines.append((at, gap.start()))
        at = gap.end()
    lines.append((at, end))
    ways = [lines]
    if len(lines) > 1 and text[lines[1][0]] in "+-":
        mark = text[lines[1][0]]
        added = list(takewhile(lambda x: text[x[0]] == mark, lines[1:]))
        first = lines[0][0] + (text[lines[0][0]] == mark)
        ways.append([(first, lines[0][1]), *((a + 1, b) for a, b in added)])
        if len(added) > 1 or first > lines[0][0]:
            ways.reverse()  # one line may begin with such a letter by chance
    out: list[tuple[str, int, int]] = []
    for way in ways:
        run = "".join(text[a:b] for a, b in way)
        if not _HEAD.search(run):
            continue
        firsts = list(accumulate((b - a for a, b in way), initial=0))[:-1]
        place = lambda k: way[i := bisect_right(firsts, k) - 1][0] + k - firsts[i]  # noqa: B023, E731
        spans = []
        for kind, s, e in _inner_keys(run):
            stop = place(e - 1) + 1
            spans.append((kind, place(s), stop + len(re.match("={0,2}", text[stop:stop + 2])[0])))
        before = sorted(out, key=lambda x: x[1])
        for found in spans:  # those of one way are disjoint
            at = bisect_right(before, found[2] - 1, key=lambda x: x[1])
            if not at or before[at - 1][2] <= found[1]:
                out.append(found)
    return out


_MARK = re.compile(r"""^\s*(?:[#>*|;+-]|//(?=\s))?\s*(?:[+.]\s+)?["'`]?""")
_TAIL = re.compile(r"""(?:["'`]\s*[+.,;)]*|\\)?\s*$""")


def is_pem_body(body: str) -> bool:
    """Whether the lines of an armoured block hold a key, as they are or without escapes, quotes and marks."""
    plain = re.sub(r"\\+(?:[rnt]|u000[aAdD])", "\n", body)
    for escape, letter in ((r"\\+/", "/"), (r"\\+u002[bB]", "+"), (r"\\+u002[fF]", "/"), (r"\\+u003[dD]", "=")):
        plain = re.sub(escape, letter, plain)
    bare = "".join(_MARK.sub("", _TAIL.sub("", line, count=1), count=1) for line in plain.splitlines())
    return any(data and (is_der_key(data) or is_ssh_key(data)) for data in (decode_base64(plain), decode_base64(bare)))


def is_signed_token(text: str) -> bool:
    head, payload, signature = text.split(".")
    parts = [decode_base64(x) for x in (head, payload)]
    if None in parts:
        return False
    try:
        header, claims = (json.loads(p) for p in parts)
    except (ValueError, RecursionError):
        return False
    sign = decode_base64(signature) if signature else b""
    return (isinstance(header, dict) and isinstance(claims, dict) and isinstance(header.get("alg"), str)
            and sign is not None and len(sign) in _SIGNATURE.get(header["alg"], set()))


def _tokens(text: str) -> Iterator[tuple[int, int]]:
    """Spans of what has the form of a signed token, leftmost and not overlapping; each run of letters is read once."""
    at = text.find("eyJ")
    while at >= 0:
        if m := _JWT.match(text, at):
            yield m.span()
        # No other place of this run can begin one: its end is not followed by a payload.
        at = text.find("eyJ", m.end() if m else _RUN.match(text, at).end())


def find(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all secrets of a text, by start and then kind as listed."""
    out: list[tuple[str, int, int]] = []
    low = text.lower()
    # Lower-casing can only add letters that count here, so texts without these words have no match.
    if any(w in low for w in _WORDS):
        out += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    out += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    if "-----BEGIN " in text:
        out += [("pem", m.start(), m.end()) for m in _PEM.finditer(text) if is_pem_body(m[2])]
    armoured = [(s, e) for k, s, e in out if k == "pem"]
    if "eyJ" in text:
        out += [("jwt", s, e) for s, e in _tokens(text) if is_signed_token(text[s:e])]
    whole = []
    for m in _BASE64.finditer(text):
        data = decode_base64(m[0])
        if data and (is_der_key(data) or is_ssh_key(data)):
            whole.append(("der" if data[0] == _SEQUENCE else "ssh", m.start(), m.end()))
    known = sorted([*armoured, *((s, e) for _, s, e in whole)])
    tops = list(accumulate((e for _, e in known), max))
    for m in _LINES.finditer(text):
        for found in _wrapped_keys(text, m.start(), m.end()):
            # Those that lie in a block or run already reported are the same key.
            at = bisect_right(known, (found[1], len(text)))
            if not at or tops[at - 1] <= found[1]:
                whole.append(found)
    out += whole
    for m in _ANY_HEX.finditer(text):
        out += [("hexder", m.start() + s, m.start() + e) for s, e in _hex_keys(m[0])]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and spans (array of kind, start, end) for every row."""
    kind = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                                     T.StructField("end", T.LongType())]))
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spans = [[{"kind": k, "start": s, "end": e} for k, s, e in find(t)] for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(spans, arrow)], names=["doc_id", "spans"])

    narrow = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(F.col(text_col)).alias("__text"))
    return narrow.mapInArrow(gives_back(scanned), T.StructType([T.StructField("doc_id", narrow.schema["doc_id"].dataType),
                                                    T.StructField("spans", kind)]))
