"""Secret scan: keyword prefilter, anchored patterns near hits, embedded checksums.

An Aho-Corasick automaton finds the keywords of all kinds in one pass over a text;
a kind's pattern is tried only where one of its keywords starts. Runs of hex digits have
no keyword: a few shifted ANDs over the text's bytes tell whether a long one exists.

Base kinds (`assign`, `access`, `hex`) follow fixed patterns. Beyond them the scan adds
tokens that carry their own checksum (`github`, `npm`: the last 6 characters are the
CRC-32 of the 30 before them in base 62) where that checksum holds.

Null texts count as empty. Repeated rows and ties in doc_id give one row each; columns
other than doc_id and text are ignored; an empty table gives an empty result. Spans are
in code points, end exclusive; overlapping spans of different kinds are all listed.
"""

import hashlib
import re
import zlib

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from crawlspark.llm.shared import arrow_rows, bound_batches

# The patterns of the base kinds and their least lengths.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LEAST, ACCESS_LEAST = 6, 20
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
CHECKED = {"github": re.compile(r"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])"),
           "npm": re.compile(r"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")}
CHECKED_WORDS = {"github": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), "npm": ("npm_",)}
KINDS = ("assign", "access", "hex", "github", "npm")
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

_ASCII_LOWER = {code: code + 32 for code in range(65, 91)}
_HEX_BYTE = np.zeros(256, bool)
_HEX_BYTE[list(b"0123456789abcdef")] = True


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for kind, words in (("assign", ASSIGN_WORDS), ("access", ("akia",)), *CHECKED_WORDS.items()):
        for word in words:
            found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


def lowered(text: str) -> str:
    """`text` in lower case with every character in its place."""
    low = text.lower()
    return low if len(low) == len(text) else text.translate(_ASCII_LOWER)


def has_long_hex(data: bytes) -> bool:
    run = _HEX_BYTE[np.frombuffer(data, np.uint8)]
    for step in (1, 2, 4, 8):
        if len(run) <= step:
            return False
        run = run[:-step] & run[step:]
    # `run` marks 16 in a row now; 24 are two such runs that start 8 apart.
    return bool((run[:-8] & run[8:]).any())


def checksum62(body: str) -> str:
    value, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, rest = divmod(value, 62)
        digits = BASE62[rest] + digits
    return digits


def scan(data: bytes, words: ahocorasick.Automaton) -> list[tuple[int, int, str]]:
    """(start, end, kind) of every finding, by start, then kind."""
    text = data.decode("utf-8", "replace")
    spans, ends = [], dict.fromkeys(KINDS, 0)
    for last, (kind, length) in words.iter(lowered(text)):
        start = last - length + 1
        if start < ends[kind]:
            continue
        if kind == "assign":
            match = ASSIGN.match(text, start)
            good = match and len(match[2]) >= ASSIGN_LEAST
        elif kind == "access":
            match = ACCESS.match(text, start)
            good = match and match.end() - start >= ACCESS_LEAST
        else:
            match = CHECKED[kind].match(text, start)
            good = match and checksum62(match[1]) == match[2]
        if match:
            ends[kind] = match.end()
        if good:
            spans.append((start, match.end(), kind))
    if has_long_hex(data):
        spans += [(match.start(), match.end(), "hex") for match in HEX.finditer(text)]
    return sorted(spans, key=lambda span: (span[0], KINDS.index(span[2])))


def joined(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def find_secrets(documents: DataFrame) -> DataFrame:
    """`doc_id`, counts and digest of the base spans, and all `spans` as text, per row."""
    bound_batches(documents.sparkSession)

    def work(rows):
        words = automaton()
        for doc_id, data in rows:
            spans = scan(data or b"", words)
            base = [span for span in spans if span[2] in KINDS[:3]]
            counts = [sum(span[2] == kind for span in base) for kind in KINDS[:3]]
            yield doc_id, *counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)

    schema = pa.schema([("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()),
                        ("n_hex", pa.int64()), ("base_sha256", pa.string()), ("spans", pa.string())])
    return documents.selectExpr("cast(doc_id as bigint) as doc_id", "text").mapInArrow(
        arrow_rows(work, schema), "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, "
                                  "base_sha256 string, spans string")
