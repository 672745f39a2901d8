"""Token ids of whole texts with a public tokenizer, inside tasks.

The ``tokenizers`` library spends most of its time on building an encoding per
string, so texts are cut into pieces that are encoded once and looked up
afterwards.  No token of the two vocabularies used here holds a white-space
character after another character, so a text can be cut before each run of
white space that follows a visible character.  Of a piece that is plain letters
and closing marks the tokenizer's own split is known, and its model is asked
directly.  ``tests/llm/test_tokens.py`` holds the joined pieces against the
library's ids of whole texts.
"""

from __future__ import annotations

import json
import re
from itertools import islice

SPACE = r" \t\n\r\x0b\x0c"
#: white space that is not ASCII's, or only for some libraries: texts are not cut after it
ODD = r"\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\ufeff"
PIECES = re.compile(f"[{SPACE}]*[^{SPACE}{ODD}]*(?:[{ODD}]+[{SPACE}]*[^{SPACE}{ODD}]*)*")
#: what stands between the single spaces of an even text
EVEN = re.compile(f"\\n?[^{SPACE}{ODD}]+")
#: letters of Latin-1 are letters in every Unicode version; ASCII marks after them (but for the
#: apostrophe of contractions) are a token run
PLAIN = re.compile(r"(\n?)([A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+)([!-&(-/:-@\[-`{-~]*)")
#: most pieces kept per table of a Python worker (400 bytes each), and the longest piece kept
KEPT_PIECES, KEPT_CHARS = 450_000, 64


def byte_letters() -> dict[int, int]:
    """Byte-level alphabet: visible bytes stand for themselves, the rest for 256, 257, ..."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return {b: 256 + i for i, b in enumerate(rest)}


BYTE_LETTERS = byte_letters()


class Table(dict):
    """Ids of pieces; what is missing is encoded and kept."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, piece: str) -> bytes:
        ids = self.encode(piece)
        if len(piece) <= KEPT_CHARS:
            if len(self) >= KEPT_PIECES:
                self.drop_newest()
            self[piece] = ids
        return ids

    def drop_newest(self) -> None:
        """Keep the older half: what comes often comes early."""
        for old in list(islice(self, len(self) // 2, None)):
            del self[old]


class Uneven(ValueError):
    """A text is not cut by single spaces and line feeds."""


class Encoder:
    """ids of texts as little-endian unsigned 32-bit bytes, with bounded piece tables."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings are ordinary text
        self.model = self.tokenizer.model
        with open(path, encoding="utf-8") as f:
            self.plain = _plain_split(json.load(f))
        self.pieces = Table(self._piece)
        # keys of this table follow a space that is not part of the key, unless a line feed leads
        self.spaced = Table(self._spaced)
        self.marks = Table(self._run)

    def _run(self, text: str) -> bytes:
        """Ids of one pre-token."""
        # letters of ASCII stand for themselves
        mapped = text if text.isascii() and text.isalpha() else (
            text.encode().decode("latin-1").translate(BYTE_LETTERS))
        return b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(mapped)])

    def _piece(self, piece: str) -> bytes:
        ids = self.tokenizer.encode(piece, add_special_tokens=False).ids
        return b"".join([i.to_bytes(4, "little") for i in ids])

    def _spaced(self, key: str) -> bytes:
        if key.isascii() and key.isalpha():
            return self._letters(key)
        m = PLAIN.fullmatch(key)
        if m is None:
            if not EVEN.fullmatch(key):
                raise Uneven
            return self._piece(key if key[0] == "\n" else " " + key)
        feed, letters, marks = m.groups()
        if self.plain == "lower":
            feed, letters = "", letters.lower()
        if marks:
            return self.spaced[feed + letters] + self.marks[marks]
        if feed:
            return self.marks["\n"] + self._run(letters)
        return self._letters(letters) if letters == key else self.spaced[letters]

    def _letters(self, letters: str) -> bytes:
        """Ids of plain letters after a space; of a word in several cases only one is worked out."""
        if self.plain != "lower":
            return self._run(" " + letters)
        lower = letters.lower()
        return self._run(lower) if lower == letters else self.spaced[lower]

    def encode(self, texts: list[str | None], end_id: int) -> list[bytes]:
        """Ids of each text followed by ``end_id``; null is an empty text."""
        end = int(end_id).to_bytes(4, "little")
        return [self._text(t) + end if t else end for t in texts]

    def _text(self, text: str) -> bytes:
        if self.plain:
            first, *rest = text.replace("\n", " \n").split(" ")
            try:
                if EVEN.fullmatch(first):
                    return self.pieces[first] + b"".join(map(self.spaced.__getitem__, rest))
            except Uneven:
                pass
        return b"".join(map(self.pieces.__getitem__, PIECES.findall(text)))


def _plain_split(config: dict) -> str | None:
    """How the tokenizer splits plain pieces: "space" (kept before a word), "lower" (white space
    dropped, lower case), or None where that is not known."""
    norm, pre = config.get("normalizer"), config.get("pre_tokenizer") or {}
    if norm is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) \
            and not pre.get("add_prefix_space"):
        return "space"
    if norm and [n["type"] for n in norm.get("normalizers", [])] == ["NFC", "Replace", "Lowercase"] \
            and [x["type"] for x in pre.get("pretokenizers", [])] == ["Split", "ByteLevel"]:
        return "lower"
    return None


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def forget() -> None:
    """Give back the memory of the worker's encoders: a worker outlives the stage that encodes."""
    import pyarrow as pa
    _ENCODERS.clear()
    pa.default_memory_pool().release_unused()


def text_batches(batches, max_bytes: int = 1_000_000, columns=("doc_id", "text")):
    """Lists of (id, text) from Arrow batches, of about ``max_bytes`` of text at most."""
    import numpy as np
    import pyarrow.compute as pc
    for batch in batches:
        ids, texts = (batch.column(c) for c in columns)
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        group = np.cumsum(sizes.astype(np.int64) + 1) // max_bytes
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(ids)]
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            if hi > lo:
                yield ids.slice(lo, hi - lo).to_pylist(), texts.slice(lo, hi - lo).to_pylist()
