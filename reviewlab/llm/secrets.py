"""Secret scan: known shapes, and strings a tokenizer cannot shorten.

Assignments, access keys and long hexadecimal runs are found by pattern. Beyond these, a run
of key characters is reported when the tokenizer needs nearly as many tokens as a random
string would: few characters per token. Digests (hexadecimal ones, and integrity strings such as
``sha512-...==``), unique identifiers and plain numbers are as random but no secrets, and are left
out; so is what a pattern has found already. A key may stand in a path: a run loses the words and
numbers, between ``/``, ``=`` and ``-``, at its ends. It is judged whole then, and if it is no
secret, piece by piece.

Edge cases: a null text counts as empty and has no spans; repeated rows are each scanned;
other columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import tiktoken
from pyspark.sql import DataFrame, types as T

from reviewlab.llm.common import fields, map_rows, short_batches

# The shapes, and the least length of what each must hold.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ASSIGNED_CHARS = 8
# A run that is too short cannot hold a long enough one, so the bounds may stand inside.
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "random")

#: Random key material of letters and digits stays below this many characters per token.
MAX_CHARS_PER_TOKEN = 1.9
RANDOM_CHARS = 20
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % RANDOM_CHARS)
DIGEST_CHARS = {32, 40, 48, 56, 64, 96, 128}
DIGEST = re.compile(r"[0-9a-f]+|[0-9A-F]+")
KNOWN = re.compile(
    r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}(?![0-9A-Fa-f])"
    r"|md5-[A-Za-z0-9+/]{22}==|sha1-[A-Za-z0-9+/]{27}=|sha256-[A-Za-z0-9+/]{43}="
    r"|sha384-[A-Za-z0-9+/]{64}|sha512-[A-Za-z0-9+/]{86}=="
)
PIECE = re.compile(r"[A-Za-z0-9+_]+")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
MIXED = re.compile(r"[0-9].*[A-Za-z]|[A-Za-z].*[0-9]|[a-z].*[A-Z].*[a-z].*[A-Z]")


@lru_cache(maxsize=2)
def tokenizer(path: str, pattern: str) -> tiktoken.Encoding:
    """The ranks in a file, once per process."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(t): int(n) for t, n in map(bytes.split, f)}
    return tiktoken.Encoding(
        "secrets", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
    )


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` of the known shapes."""
    spans = [
        (m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGNED_CHARS
    ]
    spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def _free_parts(text: str, found: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """The parts of key-like runs outside the spans in ``found`` and known values, in order."""
    taken = sorted([(a, b) for a, _, b in found] + [m.span() for m in KNOWN.finditer(text)])
    at, covered = 0, 0
    for m in CANDIDATE.finditer(text):
        begin, end = m.span()
        while at < len(taken) and taken[at][0] < end:
            start, stop = taken[at]
            at += 1
            if start > max(begin, covered):
                yield max(begin, covered), start
            covered = max(covered, stop)
        if end > max(begin, covered):
            yield max(begin, covered), end


def random_spans(
    text: str, found: list[tuple[int, int, int]], coder: tiktoken.Encoding, most: float
) -> list[tuple[int, int, int]]:
    """Parts of runs with at most ``most`` characters per token outside the spans in ``found``."""

    def is_random(part: str) -> bool:
        if len(part) < RANDOM_CHARS or not MIXED.search(part):
            return False
        if len(part) in DIGEST_CHARS and DIGEST.fullmatch(part):
            return False
        return len(part) <= most * len(coder.encode_ordinary(part))

    spans = []
    for begin, end in _free_parts(text, found):
        pieces = [m.span() for m in PIECE.finditer(text, begin, end) if not WORD.fullmatch(m[0])]
        if not pieces:
            continue
        stop = pieces[-1][1]
        while stop < end and text[stop] == "=":
            stop += 1
        if is_random(text[pieces[0][0] : stop]):
            spans.append((pieces[0][0], 3, stop))
        else:
            spans += [(a, 3, b) for a, b in pieces if is_random(text[a:b])]
    return spans


def scan(
    df: DataFrame,
    path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    most: float = MAX_CHARS_PER_TOKEN,
) -> DataFrame:
    """``(id, spans)``: spans ``(kind, begin, end)`` in code points, end exclusive, by begin,
    then in the order of ``KINDS``. ``path`` names a file of tokenizer ranks, ``pattern`` the
    expression that cuts text for it."""
    short_batches(df.sparkSession)
    span = T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("begin", T.IntegerType()),
            T.StructField("end", T.IntegerType()),
        ]
    )
    schema = T.StructType([*fields(df, id_col), T.StructField("spans", T.ArrayType(span))])

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        coder = tokenizer(path, pattern)
        for columns in batches:
            spans = []
            for text in columns[text_col].to_pylist():
                found = base_spans(text or "")
                found = sorted(found + random_spans(text or "", found, coder, most))
                spans.append([{"kind": KINDS[k], "begin": a, "end": b} for a, k, b in found])
            yield {id_col: columns[id_col], "spans": spans}

    return map_rows(df.select(id_col, text_col), work, schema)
