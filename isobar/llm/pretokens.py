"""Cutting texts into units that byte-pair tokenizers encode one by one.

Both tokenizers used here first split a text by a pattern of letter runs, digit runs,
runs of other characters, contractions and white space. Some places are always such a
split: between a letter and a digit, a letter and a sign, or in front of white space
behind a visible character. Cutting at these places only, and letting the library
encode each distinct unit, gives exactly the ids of the whole text.

A place counts only if the characters on both sides are known for certain: ASCII, and
letters of the Latin and Cyrillic blocks. Beside any other character nothing is cut.
"""

from __future__ import annotations

import json
import os
import re
import struct

import numpy as np
import pyarrow as pa

from isobar.llm.arrow import text_bytes

#: Every special token of the supported vocabularies starts with this.
SPECIAL = "<|"

_OTHER, _LETTER, _DIGIT, _SIGN, _QUOTE, _SPACE = range(6)


def _classes() -> np.ndarray:
    table = np.full(256, _OTHER, dtype=np.uint8)
    table[0x21:0x7F] = _SIGN
    table[0x30:0x3A] = _DIGIT
    table[0x41:0x5B] = table[0x61:0x7B] = _LETTER
    table[0x27] = _QUOTE  # may start a contraction with the letters behind it
    table[[0x09, 0x0A, 0x0D, 0x20]] = _SPACE
    # First bytes of U+00C0-U+027F and U+0400-U+047F, all letters but those below.
    table[0xC3:0xCA] = table[0xD0:0xD2] = _LETTER
    return table


_CLASS = _classes()
# The multiplication and division signs, and the dotted capital I, whose lower case is
# two characters.
_NOT_LETTERS = ((0xC3, 0x97), (0xC3, 0xB7), (0xC4, 0xB0))


def _cuts() -> np.ndarray:
    cut = np.zeros((6, 6), dtype=bool)
    for a, b in ((_LETTER, _DIGIT), (_LETTER, _SIGN), (_DIGIT, _SIGN)):
        cut[a, b] = cut[b, a] = True
    cut[_LETTER, _QUOTE] = cut[_DIGIT, _QUOTE] = True
    for kind in (_LETTER, _DIGIT, _SIGN, _QUOTE):
        cut[kind, _SPACE] = True
    return cut.ravel()


_CUT = _cuts()


def byte_classes(raw: np.ndarray) -> np.ndarray:
    classes = _CLASS[raw]
    following = (raw & 0xC0) == 0x80
    if following.any():
        places = np.flatnonzero(following)
        # All these letters have two bytes; a third byte follows no letter.
        classes[places] = classes[places - 1] * (raw[places - 1] >= 0xC0)
        for first, second in _NOT_LETTERS:
            odd = places[(raw[places] == second) & (raw[places - 1] == first)]
            classes[odd] = classes[odd - 1] = _OTHER
    return classes


def units(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The units of all texts in turn, dictionary-coded, and each text's first unit.

    The second array has one more element, the number of units.
    """
    raw, places = text_bytes(texts)
    if not len(raw):
        return pa.array([], pa.large_string()).dictionary_encode(), np.zeros(len(places), dtype=np.int64)
    classes = byte_classes(raw)
    starts = np.zeros(len(raw), dtype=bool)
    starts[1:] = _CUT[classes[:-1] * 6 + classes[1:]]
    starts[places[:-1][places[:-1] < len(raw)]] = True
    bounds = np.append(np.flatnonzero(starts), len(raw)).astype(np.int64)
    cut = pa.LargeStringArray.from_buffers(
        len(bounds) - 1, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(raw))
    )
    return cut.dictionary_encode(), np.searchsorted(bounds, places)


def _byte_letters() -> dict[int, str]:
    """The character that byte-level vocabularies write for each byte.

    Fixed values: visible bytes stand for themselves, the others for U+0100 and up in turn.
    """
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [byte for byte in range(256) if byte not in visible]
    return {byte: chr(byte) for byte in visible} | {byte: chr(256 + n) for n, byte in enumerate(hidden)}


_BYTE_LETTERS = _byte_letters()
_SPACE_LETTER = _BYTE_LETTERS[0x20]
_KNOWN_LETTERS = "A-Za-zÀ-ÖØ-öø-įı-ɿЀ-ѿ"
_WORD = re.compile(rf"([ \t\n\r]*)([{_KNOWN_LETTERS}]+|[!-&(-/:-@\[-`{{-~]+)")


class UnitEncoder:
    """Ids of units, remembered up to a number of units.

    A unit that is one pre-token goes straight to the tokenizer's merges; any other goes
    through the whole library. ``cased`` vocabularies keep letter case and the space in
    front of a word, the others drop both.
    """

    #: Longer units are encoded each time instead of being kept.
    LONGEST = 64

    def __init__(self, definition: str, remembered: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_str(definition)
        self._model = self._tokenizer.model
        self._cased = json.loads(definition)["normalizer"] is None
        self._remembered = remembered
        self._cache: dict[bytes, bytes] = {}

    def whole(self, text: str) -> bytes:
        """A text through the library, special tokens in it taken as such."""
        return self._packed(self._tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids)

    def units(self, values: list[bytes]) -> list[bytes]:
        found = [self._cache.get(value) for value in values]
        missing = [i for i, ids in enumerate(found) if ids is None]
        hard = []
        for i in missing:
            pretoken = self._pretoken(values[i])
            if pretoken is None:
                hard.append(i)
            else:
                found[i] = self._packed([token.id for token in self._model.tokenize(pretoken)])
        encoded = self._tokenizer.encode_batch_fast([values[i].decode() for i in hard], add_special_tokens=False)
        for i, encoding in zip(hard, encoded, strict=True):
            found[i] = self._packed(encoding.ids)
        if len(self._cache) + len(missing) > self._remembered:
            self._cache.clear()
        self._cache.update((values[i], found[i]) for i in missing if len(values[i]) <= self.LONGEST)
        return found

    def _pretoken(self, unit: bytes) -> str | None:
        """The unit as the merges take it, if it is one pre-token."""
        if self._cased:
            if unit.isalpha():  # ASCII letters only
                return unit.decode()
            if unit[:1] == b" " and unit[1:].isalpha():
                return _SPACE_LETTER + unit[1:].decode()
        elif (word := unit.strip(b" \t\n\r")).isalpha():
            return word.lower().decode()
        match = _WORD.fullmatch(unit.decode())
        if match is None or self._cased and match[1] not in ("", " "):
            return None
        if not self._cased:
            unit = match[2].lower().encode()
        return unit.decode("latin-1").translate(_BYTE_LETTERS)

    @staticmethod
    def _packed(ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)


def unit_bytes(dictionary: pa.LargeStringArray) -> list[bytes]:
    _, offsets, data = dictionary.buffers()
    if data is None:
        return [b""] * len(dictionary)
    places = np.frombuffer(offsets, dtype=np.int64)[dictionary.offset : dictionary.offset + len(dictionary) + 1]
    raw, ends = data.to_pybytes(), places.tolist()
    return [raw[a:b] for a, b in zip(ends, ends[1:], strict=False)]


_encoders: dict[tuple[int, int], UnitEncoder] = {}


def worker_encoder(definition: str, remembered: int) -> UnitEncoder:
    """The encoder of this Python worker, kept from task to task."""
    key = hash(definition), remembered
    if key not in _encoders:
        _encoders[key] = UnitEncoder(definition, remembered)
    return _encoders[key]
