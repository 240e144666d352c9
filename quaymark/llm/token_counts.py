"""Token counts by byte-pair merging with a heap and a linked list; no token is named.

A word starts as its UTF-8 bytes, the last one marked as the word's end. The adjacent pair of lowest merge
rank (the leftmost of equals) is merged until no pair has a rank. The count is the symbols at the start less
the merges made. A special string of the file counts one. Equal words are merged once per worker.

Cases: a null or blank text has 0 tokens (and a null one 0 bytes); repeated rows each give a row; an empty
table gives none; a word of any length takes n log n steps.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import key_and_text, slices
from .word_bpe import WordFile


def _byte_letters() -> list[str]:
    """Byte-level vocabularies write printable bytes as themselves and the others as letters from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in shown}
    for b in range(256):
        letters.setdefault(b, chr(256 + len(letters) - len(shown)))
    return [letters[b] for b in range(256)]


LETTERS = _byte_letters()


def merged_length(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """How many symbols are left when the lowest-ranked adjacent pair is merged again and again."""
    n = len(symbols)
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))
    heap = [(r, i) for i in range(n - 1) if (r := ranks.get((symbols[i], symbols[i + 1]))) is not None]
    heapify(heap)
    merges = 0
    while heap:
        rank, i = heappop(heap)
        j = right[i]
        # an entry is stale once either symbol has changed
        if j >= n or symbols[i] is None or ranks.get((symbols[i], symbols[j])) != rank:
            continue
        symbols[i] += symbols[j]
        symbols[j] = None
        right[i] = after = right[j]
        merges += 1
        if after < n:
            left[after] = i
            if (r := ranks.get((symbols[i], symbols[after]))) is not None:
                heappush(heap, (r, i))
        if (before := left[i]) >= 0 and (r := ranks.get((symbols[before], symbols[i]))) is not None:
            heappush(heap, (r, before))
    return n - merges


def count_word(file: WordFile, word: str) -> int:
    if word in file.specials:
        return 1
    symbols = [LETTERS[b] for b in word.encode()]
    symbols[-1] += file.suffix
    return merged_length(symbols, file.ranks)


def count_text(file: WordFile, text: str) -> int:
    """Tokens of a whole text."""
    words, memo = file.words(text), file.counts
    for word in words:
        if word not in memo:
            memo[word] = count_word(file, word)
    return sum(map(memo.__getitem__, words))


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 2048, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row; `vocabulary` is a path the workers can read."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = WordFile(vocabulary)
        for batch in slices(batches):
            file.counts.trim()
            texts = [t or "" for t in batch["text"].to_pylist()]
            counts = [count_text(file, t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array([len(t.encode()) for t in texts], pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array([n > limit for n in counts], pa.bool_()),
                ],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return key_and_text(docs, key, text).mapInArrow(work, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
