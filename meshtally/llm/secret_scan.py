"""Secret scans with structural confirmation.

Three plain patterns give the base spans. Beyond them, runs of base64 or hex and dotted
tokens are only candidates: a candidate is decoded and reported if its structure holds, be
it nested tag-length-value records of a private key, the length-prefixed fields of an SSH
key file, or a signed token's JSON header and claims.
"""

from __future__ import annotations

import base64
import bisect
import json
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meshtally.llm.common import slices

# The base patterns, with the least length of what they must find, in order of kind.
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
LEAST_ASSIGNED = 12
BASE = ("assign", "access", "hex")
CONFIRMED = ("private_key", "ssh_key", "signed_token")
KINDS = {k: i for i, k in enumerate(BASE + CONFIRMED)}
SPANS = "array<struct<kind:string,start:int,end:int>>"

# A key's outer record (tag 0x30 and a length) or an SSH key file's magic, as base64 and as hex begin.
BASE64_KEY = re.compile(r"(?<![A-Za-z0-9+/])(?:M[A-I]|b3BlbnNzaC1rZXktdjE)[A-Za-z0-9+/]{20,}")
BASE64_RUN = re.compile(r"[A-Za-z0-9+/]+(?:\r?\n[A-Za-z0-9+/]+)*={0,2}")
HEX_RUN = re.compile(r"[0-9A-Fa-f]+")
LINE_BREAK = re.compile(r"[\r\n]")
HEX_KEY = re.compile(r"(?<![0-9A-Fa-f])(?:30[0-8][0-9A-Fa-f]|6f70656e7373682d6b65792d7631)[0-9A-Fa-f]{28,}", re.IGNORECASE)
TOKEN = re.compile(r"(?<![A-Za-z0-9_.-])eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*")
SSH_MAGIC = b"openssh-key-v1\0"
INTEGER, OCTETS, OBJECT_ID, SEQUENCE = 0x02, 0x04, 0x06, 0x30
DEEPEST = 16


def record(data: bytes | Decoded, at: int) -> tuple[int, int, int] | None:
    """Tag, start and end of the content of the record at a place; None if its length is malformed."""
    if at + 2 > len(data):
        return None
    size, start = data[at + 1], at + 2
    if size >= 0x80:
        n = size & 0x7F
        if not 1 <= n <= 4 or start + n > len(data):
            return None
        size, start = int.from_bytes(data[start:start + n], "big"), start + n
    return data[at], start, start + size


def records(data: bytes | Decoded, start: int, end: int, depth: int = 0) -> list[tuple[int, int, int]] | None:
    """The records that fill a stretch exactly, all nested ones well formed too; else None."""
    out = []
    while start < end:
        one = record(data, start)
        if one is None or one[2] > end or depth > DEEPEST:
            return None
        if one[0] & 0x20 and records(data, one[1], one[2], depth + 1) is None:
            return None
        out.append(one)
        start = one[2]
    return out


def private_key_length(data: bytes | Decoded) -> int:
    """Bytes of the private key record that the data begin with; 0 if they don't."""
    outer = record(data, 0)
    if outer is None or outer[0] != SEQUENCE or outer[2] > len(data) or outer[2] < 24:
        return 0
    inner = record(data, outer[1])
    if inner is None or inner[1] >= inner[2] or inner[2] > outer[2] or (
            (inner[0], inner[2] - inner[1]) != (INTEGER, 1) if data[inner[1]] <= 3 else (inner[0], data[inner[1]]) != (SEQUENCE, OBJECT_ID)):
        return 0  # neither a version nor an algorithm comes first: most false starts end here
    parts = records(data, outer[1], outer[2])
    if not parts:
        return 0
    tags = [p[0] for p in parts]
    versioned = tags[0] == INTEGER and parts[0][2] - parts[0][1] == 1 and data[parts[0][1]] <= 3

    def names_algorithm(p: tuple[int, int, int]) -> bool:
        return p[0] == SEQUENCE and p[1] < p[2] and data[p[1]] == OBJECT_ID

    plain = versioned and len(tags) >= 6 and set(tags[:6]) == {INTEGER}  # the numbers of an RSA or DSA key
    curve = versioned and tags[1:2] == [OCTETS] and parts[1][2] - parts[1][1] >= 16
    wrapped = versioned and len(parts) >= 3 and names_algorithm(parts[1]) and tags[2] == OCTETS
    sealed = len(parts) == 2 and names_algorithm(parts[0]) and tags[1] == OCTETS  # encrypted
    return outer[2] if plain or curve or wrapped or sealed else 0


def ssh_key_length(data: bytes | Decoded) -> int:
    """Bytes of the SSH key file that the data begin with; 0 if its fields don't fit."""
    if data[:len(SSH_MAGIC)] != SSH_MAGIC:
        return 0
    at = len(SSH_MAGIC)
    for field in ("cipher", "kdf", "options", "count", "public", "private"):
        size = int.from_bytes(data[at:at + 4], "big")
        if at + 4 > len(data) or field == "count" and not 1 <= size <= 64:
            return 0
        at += 4 + (0 if field == "count" else size)
        if at > len(data):
            return 0
    return at


class Decoded:
    """The bytes that a run of digits stands for, decoded only where they are looked at."""

    WINDOW = 96  # bytes decoded at once; whole groups of digits in base64 and hex

    def __init__(self, digits: str, first: int, decode: Callable[[str], bytes], per: tuple[int, int]):
        self.digits, self.first, self.decode, self.per = digits, first, decode, per
        self.size = (len(digits) - first) * per[0] // per[1]
        self.at, self.window = -1, b""

    def __len__(self) -> int:
        return self.size

    def __getitem__(self, place: int | slice) -> int | bytes:
        if isinstance(place, slice):
            start, stop, _ = place.indices(self.size)
            if start < stop and start // self.WINDOW == (stop - 1) // self.WINDOW:
                self[start]  # its window
                return self.window[start % self.WINDOW:(stop - 1) % self.WINDOW + 1]
            return bytes(self[i] for i in range(start, stop))
        at = place // self.WINDOW
        if at != self.at:
            step = self.WINDOW * self.per[1] // self.per[0]
            begin = self.first + at * step
            self.at, self.window = at, self.decode(self.digits[begin:begin + step])
        return self.window[place - at * self.WINDOW]


def from_base64(digits: str) -> bytes:
    digits = digits[:len(digits) - (len(digits) % 4 == 1)]
    return base64.b64decode(digits + "=" * (-len(digits) % 4))


def from_hex(digits: str) -> bytes:
    return bytes.fromhex(digits[:len(digits) - len(digits) % 2])


class Run:
    """A run of digits, line breaks taken out: its digits, and where the breaks were."""

    def __init__(self, text: str, start: int, pattern: re.Pattern):
        m = pattern.match(text, start)
        self.start, self.end, self.padding = start, m.end(), m.group().count("=", -2)
        self.breaks = [i.start() for i in LINE_BREAK.finditer(text, start, self.end)]
        self.digits = text[start:self.end - self.padding].replace("\r", "").replace("\n", "")

    def digit(self, place: int) -> int:
        """Number of the digit at a place of the text."""
        return place - self.start - bisect.bisect_left(self.breaks, place)

    def place(self, digit: int) -> int:
        """Place in the text just behind a number of digits."""
        # Breaks before digit k have fewer than k digits before them.
        lost = bisect.bisect_left(range(len(self.breaks)), digit, key=lambda k: self.breaks[k] - self.start - k)
        return self.start + digit + lost


def key_spans(text: str) -> Iterator[tuple[str, int, int]]:
    """Keys in base64 (line breaks allowed) or hex, each only as far as its outer length goes.

    The search goes on from a key's end, or else from the position after the failed start.
    A run of lines is taken apart once, whatever the number of starts in it, and a start's
    structure is walked along its length fields: bytes between them are not decoded, and
    a start whose outer length is longer than what follows is given up at once.
    """
    for pattern, whole, per, decode in ((BASE64_KEY, BASE64_RUN, (3, 4), from_base64), (HEX_KEY, HEX_RUN, (1, 2), from_hex)):
        run = None
        m = pattern.search(text)
        while m:
            if run is None or m.start() >= run.end:
                run = Run(text, m.start(), whole)
            first = run.digit(m.start())
            data = Decoded(run.digits, first, decode, per)
            end = m.start()
            kind, length = ("private_key", private_key_length(data)) if data[0] == SEQUENCE else ("ssh_key", ssh_key_length(data))
            if length:
                end = run.place(first + -(-length * per[1] // per[0]))
                while end < run.end and text[end] == "=":
                    end += 1
                yield kind, m.start(), end
            m = pattern.search(text, max(end, m.start() + 1))


def part_of_token(part: str) -> object:
    try:
        return json.loads(base64.urlsafe_b64decode(part + "=" * (-len(part) % 4)))
    except (ValueError, RecursionError):
        return None


def token_spans(text: str) -> Iterator[tuple[str, int, int]]:
    for m in TOKEN.finditer(text):
        head, claims, _ = m.group().split(".")
        header = part_of_token(head)
        if isinstance(header, dict) and isinstance(header.get("alg"), str) and isinstance(part_of_token(claims), dict):
            yield "signed_token", m.start(), m.end()


def scan(text: str) -> list[tuple[str, int, int]]:
    """All spans (kind, start, end; code points, end exclusive) by start, then kind."""
    spans = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= LEAST_ASSIGNED]
    spans += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    spans += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    spans += key_spans(text)
    if "eyJ" in text:
        spans += token_spans(text)
    return sorted(set(spans), key=lambda s: (s[1], KINDS[s[0]], s[2]))


def spans(text: Column) -> Column:
    """Spans of secrets in a text column.

    Null and empty texts have none, and a text of any length is scanned whole. Each row is
    scanned by itself: repeated rows give the same spans, other columns change nothing.
    """
    @F.arrow_udf(SPANS)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            yield pa.array([[dict(zip(("kind", "start", "end"), s)) for s in scan(t)]
                            for part in slices(batch.to_pylist()) for t in part], kind)

    return run(text)


def redacted(text: Column, mark: str = "[SECRET]") -> Column:
    """The text with each stretch of overlapping spans replaced by a mark; null stays null."""
    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = []
            for t in batch.to_pylist():
                parts, at = [], 0
                for _, start, end in scan(t or ""):
                    if start >= at:
                        parts += [t[at:start], mark]
                    at = max(at, end)
                out.append(t if t is None or not parts else "".join([*parts, t[at:]]))
            yield pa.array(out, pa.string())

    return run(text)


def joined(spans_: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans_, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")


def report(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, the digest of the base spans and all spans of each row; see `spans`."""
    found = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), spans(F.col(f"`{text}`")).alias("_s"))

    def of(*kinds: str) -> Column:
        return F.filter("_s", lambda s: s.kind.isin(*kinds))

    return found.select("doc_id", *(F.size(of(k)).cast("bigint").alias(f"n_{k}") for k in BASE),
                        F.sha2(joined(of(*BASE)).cast("binary"), 256).alias("base_sha256"),
                        joined(F.col("_s")).alias("spans"))
