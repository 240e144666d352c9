"""Secret scan: three fixed patterns, and a guess-cost search over values that stand where a credential would.

Patterns (`assign`, `access`, `hex`) are matched leftmost and without overlap, then dropped if too short. On top,
the value behind a credential word and `:` or `=`, or behind `Bearer`, is cut into segments that are cheapest to guess: a frequent word
(by its rank in the vocabulary), a date or year, a repeated unit, a keyboard or alphabet walk, or single
characters by brute force. The cheapest cut is found by a dynamic program over the positions of the value; a value
that costs at least `MIN_LOG10_GUESSES` is a `guess` span. The vocabulary is the tokenizer's, read by path.

Spans count code points, end exclusive; an `assign` span is the whole match. Cases: a null text counts as
empty and gives no span; a value may be of any length, since each of its positions looks back a bounded way; a
span found by two kinds is listed for each; repeated rows give a row each; an empty table gives none.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import key_and_text, slices

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # the same as runs of any length, then those of 16 and more
KINDS = ("assign", "access", "hex", "guess")

#: A credential word, then : or =, then a value, with a scheme such as Bearer before it or not; or Bearer and a value.
#: Words that the assign pattern has and others.
CONTEXT = re.compile(
    r"""(?:(?:pass(?:word|wd|phrase|code)?|pwd|(?:secret|token|credentials?)(?:[_-]?(?:access[_-]?)?key(?:[_-]?base)?)?"""
    r"""|(?:api|access|private|auth|signing|encryption|master|session|shared|service|account|client|consumer|deploy|ssh|hmac|jwt"""
    r"""|webhook|storage|license)[_-]?key|bearer|auth(?:orization)?)"""
    r"""["']?[\x20\t]*(?::|=>?)[\x20\t]*["']?(?:(?:bearer|basic|token)[\x20\t]+)?"""
    r"""|\bbearer[\x20\t]+["']?(?!(?:token|secret|credentials?|password|key)["']?[\x20\t]*[:=]))"""
    r"""([^\s"'<>,;]+)""",
    re.IGNORECASE | re.ASCII,
)
MIN_LOG10_GUESSES = 11.0
LONGEST_WORD = 24
#: Adjacent keys and letters, as rows.
WALKS = ("qwertyuiop", "asdfghjkl", "zxcvbnm", "1234567890", "abcdefghijklmnopqrstuvwxyz", "1qaz", "2wsx", "3edc", "4rfv", "5tgb", "6yhn", "7ujm")
DATE = re.compile(
    r"(?:(?:19|20)\d\d[-/._]?(?:0?[1-9]|1[0-2])[-/._]?(?:0?[1-9]|[12]\d|3[01])"
    r"|(?:0?[1-9]|[12]\d|3[01])[-/._]?(?:0?[1-9]|1[0-2])[-/._]?(?:19|20)\d\d|(?:19|20)\d\d)"
)
PLAIN = str.maketrans("@4310$57", "aaeiosst")  # usual swaps of letters

LOG_BRUTE = 1.0  # a character of a value of one class, or a lone sign
#: Signs that join the words of a name or path; they make no class of their own.
JOINERS = frozenset("._-/:")
#: How many characters a class has: small letters, capitals, digits, anything else.
CLASSES = (26, 26, 10, 33)
LOG_DATE = math.log10(365 * 120)
LOG_SEGMENT = math.log10(2)  # any cut may be there or not


@lru_cache(maxsize=2)
def words_of(path: str) -> dict[str, float]:
    """log10 of the rank of each lower-case word of three letters or more in a vocabulary file."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    suffix = model["end_of_word_suffix"]
    words = (t.removesuffix(suffix) for t in sorted(model["vocab"], key=model["vocab"].get) if t.endswith(suffix))
    kept = [w for w in words if len(w) >= 3 and w.isascii() and w.isalpha()]
    return {w: math.log10(rank + 2) for rank, w in reversed(list(enumerate(kept)))}


def _walk_lengths(low: str) -> list[int]:
    """How far a walk on a row of keys, in either direction, reaches from each position."""
    steps = {row[i : i + 2] for line in WALKS for row in (line, line[::-1]) for i in range(len(line) - 1)}
    n = len(low)
    reach = [1] * n
    for i in range(n - 2, -1, -1):
        if low[i : i + 2] in steps:
            reach[i] = reach[i + 1] + 1
    return reach


def _log_brute(value: str) -> float:
    """What a character costs by brute force, by the classes the value mixes."""
    classes = {0 if "a" <= c <= "z" else 1 if "A" <= c <= "Z" else 2 if "0" <= c <= "9" else 3 for c in value if c not in JOINERS}
    return math.log10(sum(CLASSES[k] for k in classes)) if len(classes) > 1 else LOG_BRUTE


def log10_guesses(value: str, words: dict[str, float]) -> float:
    """The least cost of any segmentation, as log10 of guesses."""
    low, n = value.lower(), len(value)
    if len(low) != n:  # a letter whose small form has another length
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in value)
    plain = low.translate(PLAIN)
    reach = _walk_lengths(low)
    one = _log_brute(value)
    ends: list[list[tuple[int, float]]] = [[] for _ in range(n)]  # segments by start: (end, cost)
    for match in DATE.finditer(low):
        ends[match.start()].append((match.end(), LOG_DATE if match.end() - match.start() > 4 else 2.1))
    run = {unit: 0 for unit in (1, 2, 3, 4)}
    for i in range(n - 1, -1, -1):
        for unit in run:  # how long the text from i on repeats with this period
            run[unit] = run[unit] + 1 if i + unit < n and low[i] == low[i + unit] else 0
            if (length := run[unit] + unit) >= max(3, 2 * unit):
                ends[i].append((i + length, unit * one + math.log10(length / unit)))
        if reach[i] >= 3:
            ends[i].append((i + reach[i], 1.5 + math.log10(reach[i])))
    best = [0.0] + [math.inf] * n
    brute = [math.inf] * (n + 1)  # the cheapest way that ends in a brute-force span
    for i in range(n):
        start = min(best[i] + LOG_SEGMENT, brute[i]) + one
        brute[i + 1] = start
        best[i + 1] = min(best[i + 1], start)
        base = best[i] + LOG_SEGMENT
        if not low[i].isalnum():  # a sign between words costs the same in a value of any classes
            best[i + 1] = min(best[i + 1], base + LOG_BRUTE)
        for stop, cost in ends[i]:
            best[stop] = min(best[stop], base + cost)
        if low[i].isalpha() or plain[i].isalpha():
            for stop in range(i + 3, min(n, i + LONGEST_WORD) + 1):
                rank = words.get(low[i:stop])
                if rank is None and (rank := words.get(plain[i:stop])) is not None:
                    rank += 0.5
                if rank is not None:
                    capitals = sum(c.isupper() for c in value[i:stop])
                    best[stop] = min(best[stop], base + rank + (0.3 if capitals in (1, stop - i) else 0.1 * capitals))
    return best[n]


def spans_of(text: str, words: dict[str, float]) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of every span, by start and kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    if ":" in text or "=" in text or "bearer" in text.lower():
        found += [(m.start(1), 3, m.end(1)) for m in CONTEXT.finditer(text) if log10_guesses(m[1], words) >= MIN_LOG10_GUESSES]
    return sorted(found)


def scan(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and spans (an array of kind, start, end, by start, then kind) for every row."""

    kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = words_of(vocabulary)
        for batch in slices(batches):
            found = [
                [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans_of(t or "", words)]
                for t in batch["text"].to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(found, pa.list_(kind))], ["doc_id", "spans"])

    return key_and_text(docs, key, text).mapInArrow(work, "doc_id long, spans array<struct<kind: string, start: int, end: int>>")
