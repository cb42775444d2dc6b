"""Encoding with a public tokenizer unit by unit, with the result of encoding each whole text.

A unit is a stretch of text whose tokens depend on nothing around it. Units repeat, so a worker keeps
those it has met, up to a bound, and asks the tokenizers library for the others in batches.
"""

from __future__ import annotations

import os
import re
import sys
from array import array

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

#: Units a worker remembers; at this many it forgets those of more than SHORT_UNIT characters.
REMEMBERED, SHORT_UNIT = 1_000_000, 9
#: Units longer than this are encoded and not remembered.
LONGEST_UNIT = 48


def load(vocabulary: str) -> Tokenizer:
    """The tokenizer of a vocabulary file (a name of `public_tokenizers`), without truncation, padding or own threads."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_file(public_tokenizers.path(vocabulary))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _byte_letters() -> str:
    """The letter that byte-level vocabularies write for each byte: printable ones stand for themselves, the others
    follow from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    return "".join(chr(b) if b in set(shown) else chr(256 + hidden.index(b)) for b in range(256))


_LETTERS = str.maketrans(dict(enumerate(_byte_letters())))


class UnitEncoder:
    """Encodes lists of units to little-endian ids of the width of `dtype`."""

    def __init__(self, vocabulary: str, dtype: str) -> None:
        self.tokenizer = load(vocabulary)
        self.model = self.tokenizer.model
        self.lower = self.tokenizer.normalizer is not None
        self.dtype = np.dtype(dtype)
        if self.tokenizer.get_vocab_size(with_added_tokens=True) > np.iinfo(self.dtype).max:
            raise ValueError(f"ids of {vocabulary} do not fit {dtype}")
        #: The array type of native ids of that width.
        self.code = {2: "H", 4: "I"}[self.dtype.itemsize]
        if array(self.code).itemsize != self.dtype.itemsize or sys.byteorder != "little":
            raise ValueError("ids are written as little-endian numbers")
        self.known: dict[str, bytes] = {}
        #: A special token: text is encoded separately on its two sides.
        self.fence = next(t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.special)
        self.fence_id = self.tokenizer.token_to_id(self.fence)
        self.marks = {c: self._whole([c])[c] for c in ",."}

    def _word(self, unit: str) -> bytes | None:
        """Ids of a unit of Latin letters, with the space before and one mark after it if it has them, which
        are pieces for certain and go to the model at once; None for any other unit."""
        tail = self.marks.get(unit[-1])
        core = unit if tail is None else unit[:-1]
        letters = core[1:] if core[:1] == " " else core
        if not letters.isalpha():
            return None
        if letters.isascii():
            name = letters.lower() if self.lower else "Ġ" + letters if core is not letters else letters
        # Latin letters compose and change case one by one, but for the dotted capital I
        elif max(letters) <= "\u024f" and "\u0130" not in letters:
            name = (letters.lower() if self.lower else core).encode().decode("latin-1").translate(_LETTERS)
        else:
            return None
        ids = self.known.get(core)
        if ids is None:
            ids = array(self.code, [t.id for t in self.model.tokenize(name)]).tobytes()
        return ids if tail is None else ids + tail

    def _whole(self, units: list[str]) -> dict[str, bytes]:
        """Ids of any units, asked for in one call: a call costs more than a unit."""
        fenced = [u for u in units if self.fence in u]
        plain = [u for u in units if self.fence not in u]
        made = {}
        for unit, code in zip(fenced, self.tokenizer.encode_batch_fast(fenced, add_special_tokens=False), strict=True):
            made[unit] = np.array(code.ids, self.dtype).tobytes()
        if plain:
            (code,) = self.tokenizer.encode_batch_fast([self.fence.join(plain)], add_special_tokens=False)
            ids = np.array(code.ids, self.dtype)
            ends = [*np.flatnonzero(ids == self.fence_id).tolist(), len(ids)]
            width, raw, at = self.dtype.itemsize, ids.tobytes(), 0
            for unit, end in zip(plain, ends, strict=True):
                made[unit] = raw[at * width : end * width]
                at = end + 1
        return made

    def learn(self, units: list[str]) -> dict[str, bytes]:
        made, others = {}, []
        for unit in units:
            ids = self._word(unit)
            if ids is None:
                others.append(unit)
            else:
                made[unit] = ids
        return made | self._whole(others)

    def encode(self, units: list[str]) -> bytes:
        known = self.known
        found = list(map(known.get, units))
        try:
            return b"".join(found)
        except TypeError:  # some are not known yet
            missing = list({u for u, x in zip(units, found, strict=True) if x is None})
        made = self.learn(missing)
        if len(known) + len(made) > REMEMBERED:
            # short units are met most often
            short = {u: x for u, x in known.items() if len(u) <= SHORT_UNIT}
            known.clear()
            known.update(short if len(short) < REMEMBERED // 2 else {})
        known.update((u, x) for u, x in made.items() if len(u) <= LONGEST_UNIT)
        return b"".join([made[u] if x is None else x for u, x in zip(units, found, strict=True)])


_TIED = re.compile(r"\s\s|\x00")
_SAFE = re.compile(r"(?<=\S)(?= \S)")


def byte_level_units(text: str) -> list[str]:
    """Units for a byte-level vocabulary, whose pieces take the single space before them.

    A cut before a single space that stands between other characters is a piece boundary, whatever
    else is around; a single line feed between them is a piece. A text that may hold a special token is one unit.
    """
    if not text:
        return []
    if "<|" in text:
        return [text]
    if _TIED.search(text) or text[0].isspace() or text[-1].isspace():
        return _SAFE.split(text)
    return text.replace(" ", "\x00 ").replace("\n", "\x00\n\x00").split("\x00")


def word_units(text: str) -> list[str]:
    """Units for a vocabulary of words, which drops white space and never looks across it."""
    return [u for u in text.replace("\n", " ").split(" ") if u]


_encoders: dict[tuple[str, str], UnitEncoder] = {}


def encoder(vocabulary: str, dtype: str) -> UnitEncoder:
    """The worker's encoder: made once a process."""
    key = (vocabulary, dtype)
    if key not in _encoders:
        _encoders[key] = UnitEncoder(*key)
    return _encoders[key]
