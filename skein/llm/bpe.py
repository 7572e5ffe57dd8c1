"""Whole texts to token ids with the ``tokenizers`` library, which sees each new word once.

Neither vocabulary in use lets a token reach across a space that follows a non-space. So a text is
cut there and each piece not met before is encoded. A piece of Latin letters with punctuation after
them is two runs that both splitters keep apart, so its letters go straight to the library's merge
model, once for all punctuation (and, where the vocabulary lower-cases, all cases); all other pieces
take the library's full path. A text with a space after other white space, where the byte-level
splitter looks ahead, goes through the library whole. Both tables are bounded by a number of
entries of bounded length. The tests compare ids with those of whole-text calls.

The strings of special tokens in a text are ordinary text, as the tokenizer files' own README has it.
"""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache

import numpy as np

# Entries kept per worker in each table; longer pieces are not kept, so a table takes some 100 MB at
# most. A full table keeps what it has (frequent words come early) until it has missed as often as
# it has entries times STALE, and is then started anew.
PIECE_CACHE, CORE_CACHE, LONGEST, STALE = 500_000, 500_000, 64, 8
# Latin letters (all that are letters up to U+024F), then punctuation.
_WORD = re.compile("([A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([.,;:!?%&$#*|)]*)").fullmatch
_NOT_SPACE_FOR_ALL = "\x1c\x1d\x1e\x1f"  # white space to Python's split(), not to the library


def _byte_letters() -> dict[int, str]:
    """byte -> the letter that byte-level BPE writes for it: itself where it is printable Latin-1,
    else the next unused code point from 256 on."""
    shown = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(256 + k) for k, b in enumerate(hidden)}


_LETTERS = _byte_letters()


class Bounded(dict):
    """At most ``limit`` entries, found by ``find`` as keys turn up."""

    def __init__(self, limit: int, find):
        super().__init__()
        self.limit, self.find, self.missed = limit, find, 0

    def __missing__(self, key: str) -> bytes | None:
        value = self.find(key)
        if len(self) < self.limit:
            if len(key) <= LONGEST:
                self[key] = value
        else:
            self.missed += 1
            if self.missed > STALE * self.limit:
                self.clear()
                self.missed = 0
        return value


class IdEncoder:
    """``spaces_kept``: the vocabulary encodes the space before a word (byte-level BPE); else white
    space is dropped and words are normalised."""

    def __init__(self, path: str, spaces_kept: bool):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.tokenize, self.normalizer = self.tokenizer.model.tokenize, self.tokenizer.normalizer
        self.spaces_kept = spaces_kept
        # pieces that start a text, and others; None where the byte-level splitter would look ahead
        self.starts = Bounded(PIECE_CACHE // 4, lambda piece: self.ids_of(piece, ""))
        self.others = Bounded(PIECE_CACHE, lambda piece: self.ids_of(piece, " ")) if spaces_kept else self.starts
        if not spaces_kept:
            self.starts.limit = PIECE_CACHE
        self.cores = Bounded(CORE_CACHE, self._core)
        self.tails = Bounded(1000, self._whole)
        self.newline, self.space = self._whole("\n"), _LETTERS[ord(" ")]

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids).tobytes()

    def _core(self, core: str) -> bytes | None:
        """Ids of Latin letters, after the space before them if any; None for letters that
        normalising makes into something else."""
        if core.isascii():
            if core[0] == " ":
                core = self.space + core[1:]
        else:
            if self.normalizer is not None:
                core = self.normalizer.normalize_str(core)
                if not core.isalpha():
                    return None
            core = core.encode().decode("latin-1").translate(_LETTERS)
        return array("I", [t.id for t in self.tokenize(core)]).tobytes()

    def _word(self, piece: str, lead: str) -> bytes | None:
        """Ids of Latin letters and punctuation after them; None for any other piece."""
        found = _WORD(piece)
        if found is None:
            return None
        core, tail = found.groups()
        data = self.cores[lead + core if self.normalizer is None else core.lower() if core.isascii() else core]
        return data + self.tails[tail] if tail and data is not None else data

    def ids_of(self, piece: str, lead: str) -> bytes | None:
        """Ids of a piece; None for one after which the byte-level splitter would look ahead."""
        if self.spaces_kept and (not piece or piece[-1].isspace()):
            return None if piece or lead else b""
        data = self._word(piece, lead)
        if data is None and self.spaces_kept and "\n" in piece:
            # single line breaks between words are tokens of their own
            first, *rest = piece.split("\n")
            parts = [self._word(first, lead), *[self._word(p, "") for p in rest]]
            data = None if None in parts else self.newline.join(parts)
        return self._whole(lead + piece) if data is None else data

    def forget(self) -> None:
        """Empty the tables: a worker that goes on to other work need not hold them."""
        for table in (self.starts, self.others, self.cores, self.tails):
            table.clear()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids (little-endian unsigned 32-bit) of each text."""
        starts, others, out = self.starts, self.others, []
        for text in texts:
            if self.spaces_kept:
                pieces = text.split(" ")
                head = starts[pieces.pop(0)]
            else:
                pieces, head = text.split(" ") if any(c in text for c in _NOT_SPACE_FOR_ALL) else text.split(), b""
            try:
                data = head + b"".join(map(others.__getitem__, pieces))
            except TypeError:  # a None: white space before a space
                data = self._whole(text)
            out.append(np.frombuffer(data, dtype="<u4"))
        return out


@lru_cache(maxsize=4)
def encoder(path: str, spaces_kept: bool) -> IdEncoder:
    """One encoder per Python worker."""
    return IdEncoder(path, spaces_kept)


def by_chars(rows: list, text_of, limit: int = 1_000_000):
    """Slices of ``rows`` of about ``limit`` characters, so that a batch's ids stay small."""
    start = total = 0
    for i, row in enumerate(rows):
        total += len(text_of(row))
        if total >= limit:
            yield rows[start:i + 1]
            start, total = i + 1, 0
    if start < len(rows):
        yield rows[start:]
