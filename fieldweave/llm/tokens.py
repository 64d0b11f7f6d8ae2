"""Token ids of whole texts by a public tokenizer, for code inside tasks."""

from __future__ import annotations

import json
import re
import unicodedata
from array import array

from tokenizers import Tokenizer

#: Words whose ids a worker keeps, and words of letters before marks; beyond that it starts afresh, with the words
#: of the last time at hand.
KEPT_WORDS, KEPT_STARTS = 300_000, 100_000
#: A word and the marks behind it; an apostrophe may open a word part of its own.
_ENDED = re.compile(rb"([a-z\x80-\xff]+)([!-&(-/:-@\[-`{-~]+)")


def _spelled() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(others)}


class Ids:
    """Ids of texts as bytes, each an array item of ``kind`` (little-endian machines).

    If the tokenizer drops blanks, lowers letters and has byte-level words with an end mark, words between blanks are
    tokenized once and kept: letters go straight to its model, other words through all of it. Other tokenizers get
    every text as a whole.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.kind = "H" if self.tokenizer.get_vocab_size() <= 65536 else "I"
        steps = [s["type"] for s in (spec["normalizer"] or {}).get("normalizers", [])]
        cuts = [s["type"] for s in (spec["pre_tokenizer"] or {}).get("pretokenizers", [])]
        self.by_word = (
            steps == ["NFC", "Replace", "Lowercase"] and cuts == ["Split", "ByteLevel"]
            and spec["pre_tokenizer"]["pretokenizers"][0]["behavior"] == "Removed"
            and not spec["pre_tokenizer"]["pretokenizers"][1]["add_prefix_space"] and spec["model"]["type"] == "BPE")
        self.letters = str.maketrans({chr(b): c for b, c in _spelled().items()})
        self.known: dict[bytes, bytes] = {}
        self.before: dict[bytes, bytes] = {}
        self.starts: dict[bytes, bytes | None] = {}

    def _whole(self, text: str) -> bytes:
        return array(self.kind, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _letters(self, word: bytes) -> bytes | None:
        """Ids of a word of Latin letters only, else ``None``."""
        if word.isalpha():  # ASCII
            spelled = word.decode().lower()
        else:
            spelled = word.decode("utf-8", "replace").lower()
            if not spelled.isalpha() or max(spelled) > "ɏ" or not unicodedata.is_normalized("NFC", spelled):
                return None
            spelled = spelled.encode().decode("latin-1").translate(self.letters)
        return array(self.kind, [t.id for t in self.tokenizer.model.tokenize(spelled)]).tobytes()

    def _start(self, word: bytes) -> bytes | None:
        """Ids of the letters before a mark; ``None`` where marks may belong to what is before them."""
        if word.isalpha():  # ASCII, and so ids as those of the word alone
            return self.of_word(word)
        if word not in self.starts:
            if len(self.starts) >= KEPT_STARTS:
                self.starts.clear()
            self.starts[word] = self._letters(word)
        return self.starts[word]

    def _word(self, word: bytes) -> bytes:
        found = self.before.get(word)
        if found is not None:
            return self._keep(word, found)
        found = self._letters(word)
        if found is None:
            ended = _ENDED.fullmatch(word)
            first = ended and self._start(ended[1])
            found = first + self.of_word(ended[2]) if first else self._whole(word.decode())
        return self._keep(word, found)

    def _keep(self, word: bytes, found: bytes) -> bytes:
        if len(self.known) >= KEPT_WORDS:
            self.before = dict(self.known)
            self.known.clear()
        self.known[word] = found
        return found

    def of_word(self, word: bytes) -> bytes:
        return self.known.get(word) or self._word(word)

    def of(self, text: str) -> bytes:
        if not self.by_word:
            return self._whole(text)
        raw = text.encode()
        words = (raw if b"<|" in raw else raw.lower()).split()
        try:
            return b"".join(map(self.known.__getitem__, words))
        except KeyError:
            return b"".join(map(self.of_word, words))


_loaded: dict[str, Ids] = {}


def ids_by(path: str) -> Ids:
    """The worker's ``Ids`` of the tokenizer at ``path``, which every executor has installed."""
    if path not in _loaded:
        _loaded[path] = Ids(path)
    return _loaded[path]
