"""Byte-level BPE ids of texts with a public vocabulary file.

In this vocabulary's splitting rule a space before a printing character starts
a new piece whatever precedes it, so a text is cut at its spaces and every
distinct word is encoded once per worker, the new ones of a text together. The vocabulary file of `tokenizers` is read; words of ordinary
Latin characters are merged by `tiktoken` over the same ranks, which gives the same
ids several times faster, all others by `tokenizers` itself. Texts where a space
comes before white space are encoded whole by `tokenizers`.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from functools import cached_property

import numpy as np

#: Words kept by a Python worker; the store starts anew when it is full.
KEPT_WORDS = 200_000
#: Longer words (texts without spaces, among others) are encoded each time, so what is kept
#: is bounded in bytes too: some 45 MB of usual words, 250 MB if all were of 64 three-byte characters.
KEPT_CHARS = 64
#: Words of a long text that are looked up at once, and new words from which one call for all pays.
WORDS_AT_ONCE = 1 << 15
_SEVERAL = 8
_ORDINARY = re.compile(r"[\t\n\x20-\x7e¡-¬®-ſ]*").fullmatch
_encoders: dict[str, "Encoder"] = {}


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class _Words(dict):
    """Ids of words as bytes; None for a word that can't be encoded alone."""

    def __init__(self, encode) -> None:
        self.encode = encode

    def __missing__(self, word: str) -> bytes | None:
        alone = word[:1] != " " or (len(word) > 1 and not word[1].isspace())
        ids = array("i", self.encode(word)).tobytes() if alone else None
        if len(word) <= KEPT_CHARS:
            if len(self) >= KEPT_WORDS:
                self.clear()
            self[word] = ids
        return ids


class Encoder:
    def __init__(self, path: str) -> None:
        import tiktoken
        from public_tokenizers import PATTERN

        self.path = path
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        special = {t["content"] for t in spec["added_tokens"]}
        printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in printed]
        byte = {chr(b): b for b in printed} | {chr(256 + i): b for i, b in enumerate(others)}
        ranks = {bytes(map(byte.__getitem__, t)): i for t, i in spec["model"]["vocab"].items() if t not in special}
        self.fast = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.words = _Words(self._word)
        spelled = [b""] * (max(ranks.values()) + 2)
        for token, i in ranks.items():
            spelled[i] = token
        self.widths = np.array([len(s) for s in spelled])
        self.ends_line = np.array([s.endswith(b"\n") for s in spelled])
        self.ends_sentence = np.array([s.rstrip(b"\"')").endswith((b".", b"!", b"?")) for s in spelled])
        self.starts_space = np.array([s[:1].isspace() for s in spelled])

    @classmethod
    def cached(cls, path: str) -> "Encoder":
        """One per Python worker."""
        if path not in _encoders:
            _encoders[path] = cls(path)
        return _encoders[path]

    @cached_property
    def tokenizer(self):
        """Loaded when a text first needs it: it takes more memory than the rest."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        made = Tokenizer.from_file(self.path)
        made.encode_special_tokens = True
        return made

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.int32)

    def _word(self, word: str) -> list[int]:
        return self.fast.encode_ordinary(word) if _ORDINARY(word) else self.tokenizer.encode(word, add_special_tokens=False).ids

    def _learn(self, words: list[str]) -> None:
        """Store the usual ones of the new words. They are encoded as one text and told apart by the
        bytes of their tokens; what is left out here is encoded when it is looked up."""
        known = self.words
        new = [w for w in set(words) if w not in known and 1 < len(w) <= KEPT_CHARS and w[0] == " " and not w[1].isspace()]
        if len(new) < _SEVERAL:
            return
        joined = "".join(new)
        if not _ORDINARY(joined):
            new = list(filter(_ORDINARY, new))
            joined = "".join(new)
        if len(known) + len(new) > KEPT_WORDS:
            known.clear()
            if len(new) > KEPT_WORDS:
                return
        ids = np.array(self.fast.encode_ordinary(joined), np.int32)
        ends = np.cumsum([len(w) for w in (new if joined.isascii() else map(str.encode, new))])
        cuts = 4 * (np.searchsorted(np.cumsum(self.widths[ids]), ends) + 1)
        raw, first = ids.tobytes(), 0
        for word, last in zip(new, cuts.tolist()):
            known[word] = raw[first:last]
            first = last

    def _found(self, words: list[str]) -> bytes:
        self._learn(words)
        return b"".join(map(self.words.__getitem__, words))

    def encode(self, text: str) -> np.ndarray:
        if "\x00" not in text:
            words = text.replace(" ", "\x00 ").split("\x00")
            try:
                ids = b"".join([self._found(words[a : a + WORDS_AT_ONCE]) for a in range(0, len(words), WORDS_AT_ONCE)])
            except TypeError:  # a None among them
                return self.whole(text)
            return np.frombuffer(ids, np.int32)
        return self.whole(text)
