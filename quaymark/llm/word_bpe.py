"""The word tokenizer's file: its words, its ids through the library, its merge ranks.

A text becomes the words of this tokenizer once, and each distinct word is handled once per worker and
memoised. The file is named by path and read by the workers.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import lru_cache
from itertools import chain

import numpy as np
import regex
from tokenizers import Tokenizer

from .common import Memo

#: Distinct words a worker remembers.
MEMO_ENTRIES = 400_000
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Texts of the Latin alphabets only need the plain engine, which is several times as fast.
LATIN_END = 0x250
_beyond_latin = re.compile(f"[^\x00-{chr(LATIN_END - 1)}]").search


def _latin(kind: str) -> str:
    """The Latin characters of a kind (letters, numbers), for use inside a character class."""
    return "".join(re.escape(c) for c in map(chr, range(LATIN_END)) if unicodedata.category(c).startswith(kind))


@lru_cache(maxsize=2)
class WordFile:
    """One vocabulary file in one worker."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split_specials = re.compile("(" + "|".join(map(re.escape, self.specials)) + ")").split
        # the same pattern with white space spelt out, because engines differ on control characters
        pattern = pattern.replace("[^\\s", f"[^{_SPACE}")
        self.find_words = regex.compile(pattern).findall
        self.find_ascii = re.compile(pattern.replace("\\p{L}", "a-z").replace("\\p{N}", "0-9")).findall
        self.find_latin = re.compile(pattern.replace("\\p{L}", _latin("L")).replace("\\p{N}", _latin("N"))).findall
        self.suffix = spec["model"]["end_of_word_suffix"]
        self.ranks = {tuple(m if isinstance(m, list) else m.split(" ")): i for i, m in enumerate(spec["model"]["merges"])}
        vocab = spec["model"]["vocab"]
        self.ends = np.zeros(1 + max([*vocab.values(), *self.specials.values()]), dtype=bool)
        for token, number in vocab.items():
            self.ends[number] = token.endswith(self.suffix)
        self.library = Tokenizer.from_file(path)
        self.ids: Memo = Memo(MEMO_ENTRIES)
        self.counts: Memo = Memo(MEMO_ENTRIES)

    def words(self, text: str) -> list[str]:
        """The normalised words of a whole text; a special string is a word of its own."""
        parts = self.split_specials(text) if "<|" in text else [text]
        words = self.find(self.normal(parts[0]))
        for special, part in zip(parts[1::2], parts[2::2]):
            words.append(special)
            words += self.find(self.normal(part))
        return words

    def find(self, text: str) -> list[str]:
        if text.isascii():
            return self.find_ascii(text)
        return self.find_words(text) if _beyond_latin(text) else self.find_latin(text)

    @staticmethod
    def normal(text: str) -> str:
        if text.isascii():
            return text.lower()
        text = unicodedata.normalize("NFC", text)
        # the library lowers letter by letter; only a sigma's small form depends on its place
        return "".join(c.lower() for c in text) if "Σ" in text else text.lower()

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, four little-endian bytes each."""
        self.ids.trim()
        found = [self.words(t) for t in texts]
        get = self.ids.__getitem__
        try:
            return [b"".join(map(get, words)) for words in found]
        except KeyError:  # seldom, once a worker knows the frequent words
            self._learn(list(set(chain.from_iterable(found)).difference(self.ids)))
        return [b"".join(map(get, words)) for words in found]

    def _learn(self, words: list[str]) -> None:
        """Give new words to the library, many in one call; a word's last token bears the end mark."""
        for word in words:
            if word in self.specials or not (word.isascii() or unicodedata.is_normalized("NFC", word)):
                self.ids[word] = self._pack([self.specials[word]] if word in self.specials else self._call([word])[0])
        new = [w for w in words if w not in self.ids]
        for at in range(0, len(new), 10_000):
            part = new[at : at + 10_000]
            raw = self._pack(self._call([" ".join(part)])[0])
            stops = (np.flatnonzero(self.ends[np.frombuffer(raw, "<u4")]) + 1).tolist()
            if len(stops) == len(part):
                for word, began, stop in zip(part, [0, *stops], stops):
                    self.ids[word] = raw[4 * began : 4 * stop]
            else:
                self.ids.update(zip(part, map(self._pack, self._call(part))))

    def _call(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    @staticmethod
    def _pack(ids: list[int]) -> bytes:
        return np.array(ids, dtype="<u4").tobytes()
