"""Token ids by the tokenizers library, for many texts in one task."""

from __future__ import annotations

import re
import string
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words, and pieces of words, that a worker meets before it forgets those it did not meet again; some 300 bytes each.
REMEMBERED = 60_000
#: The same where a job does nothing else that needs memory.
REMEMBERED_ALONE = 300_000
#: Bytes of text that are encoded together.
CHUNK = 1 << 21
#: A space before anything that may be white space, and NUL: texts whose words do not simply begin at each space.
_UNUSUAL = r"\x00| [\x00-\x20\x7f-\x{a0}\x{1680}\x{180e}\x{2000}-\x{200f}\x{2028}-\x{202f}\x{205f}\x{3000}]"
#: Words of one run of letters and one of punctuation, which need no Unicode tables to be split.
_LETTERS = " ?[A-Za-zÀ-ÖØ-öø-ɏ]+"
_PUNCTUATION = string.punctuation
_PLAIN = re.compile(f"({_LETTERS})([{re.escape(_PUNCTUATION)}]*)")
_LOADED: dict[str, Encoder] = {}


def _byte_letters() -> dict[int, str]:
    """The letters that byte-level vocabularies write bytes as: printable ones stand for themselves, the others follow from 256."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return {b: chr(b if b in printable else next(others)) for b in range(0x100)}


class Encoder(dict):
    """Ids (uint16 bytes) of texts, as a byte-level tokenizer gives them.

    Its pieces never join across the place before a space that a non-space follows, so a text's ids are those of its words,
    each with its space. A word falls into pieces by the pattern of the vocabulary, and the library's model gives the ids of
    each distinct piece once. ``pattern``: the vocabulary's own pattern of pieces. ``encode`` and ``encode_columns`` read all
    text as ordinary text; ``tokenized`` finds the tokenizer's added tokens in it first, as the tokenizer does as loaded.
    """

    def __init__(self, path: str, pattern: str):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.pieces, self.ids = self.tokenizer.model, regex.compile(pattern).findall, {}
        self.earlier_words, self.earlier_ids, self.remembered = {}, {}, REMEMBERED
        self.letters = _byte_letters()
        added = self.tokenizer.get_added_tokens_decoder()
        self.added = {t.content: array("H", [i]).tobytes() for i, t in added.items()}
        self.plain_added = not any(t.lstrip or t.rstrip or t.single_word for t in added.values())
        names = sorted(self.added, key=len, reverse=True)
        self.split = re.compile("(" + "|".join(map(re.escape, names)) + ")").split
        self.unusual = "|".join([_UNUSUAL, *(r"\Q" + t + r"\E" for t in names)])

    def __missing__(self, word: str) -> bytes:
        value = self.earlier_words.get(word)
        if value is None:
            plain = _PLAIN.fullmatch(word)
            value = b"".join([self.ids.get(p) or self._piece(p) for p in (plain.groups() if plain else self.pieces(word)) if p])
        self[word] = value
        return value

    def _piece(self, piece: str) -> bytes:
        value = self.earlier_ids.get(piece)
        if value is None:
            letters = piece.encode("utf-8").decode("latin-1").translate(self.letters)
            value = array("H", [t.id for t in self.model.tokenize(letters)]).tobytes()
        self.ids[piece] = value
        return value

    def _forget(self) -> None:
        if len(self) > self.remembered:
            self.earlier_words = dict(self)
            self.clear()
        if len(self.ids) > self.remembered:
            self.ids, self.earlier_ids = {}, self.ids

    def encode(self, texts: list[str]) -> list[bytes]:
        out = []
        for text in texts:
            self._forget()
            out.append(b"".join(map(self.__getitem__, _words(text))))
        return out

    def encode_columns(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's begin.

        For texts without NUL and without white space after a space, whose words begin at each space. Arrow finds the
        distinct words, parts plain ones into letters and punctuation, and finds the distinct parts of these.
        """
        words = pc.split_pattern(pc.replace_substring(texts, " ", "\x00 "), "\x00")
        coded = pc.dictionary_encode(words.flatten())
        distinct = coded.dictionary
        letters = pc.utf8_rtrim(distinct, characters=_PUNCTUATION)
        plain = pc.match_substring_regex(letters, f"^{_LETTERS}$")
        tails = pc.replace_substring_regex(pc.if_else(plain, distinct, ""), f"^{_LETTERS}", "")
        self._forget()
        kept: list[bytes] = []
        parts = np.empty((len(distinct), 2), np.int64)
        for column, values in enumerate([letters, tails]):
            part = pc.dictionary_encode(pc.if_else(plain, values, ""))
            parts[:, column] = part.indices.to_numpy(zero_copy_only=False) + len(kept)
            kept += [self.ids.get(p) or (self._piece(p) if p else b"") for p in part.dictionary.to_pylist()]
        others = np.flatnonzero(~plain.to_numpy(zero_copy_only=False))
        parts[others, 0] = np.arange(len(others)) + len(kept)
        kept += map(self.__getitem__, distinct.take(pa.array(others)).to_pylist())

        lengths = np.fromiter(map(len, kept), np.int64, len(kept)) // 2
        ids, ends = _gathered(np.frombuffer(b"".join(kept), np.uint16), np.cumsum(lengths) - lengths, lengths, parts.ravel())
        ids, ends = _gathered(ids, ends[:-1:2], np.diff(ends[::2]), coded.indices.to_numpy(zero_copy_only=False))
        return ids, ends[words.offsets.to_numpy() - words.offsets[0].as_py()]

    def tokenized(self, texts: pa.Array | list[str]) -> list[bytes]:
        """Ids of whole texts, added tokens found as the tokenizer finds them."""
        texts = pa.array(texts, pa.string()) if isinstance(texts, list) else texts
        apart = pc.match_substring_regex(texts, self.unusual).to_numpy(zero_copy_only=False)
        out: list[bytes] = [b""] * len(texts)
        usual = np.flatnonzero(~apart)
        if len(usual):
            ids, ends = self.encode_columns(texts.take(pa.array(usual)))
            raw = memoryview(ids).cast("B")
            for i, a, b in zip(usual.tolist(), (ends[:-1] * 2).tolist(), (ends[1:] * 2).tolist(), strict=True):
                out[i] = bytes(raw[a:b])
        for i in np.flatnonzero(apart).tolist():
            out[i] = self._unusual(texts[i].as_py())
        return out

    def _unusual(self, text: str) -> bytes:
        """Added tokens that take in their surroundings are left to the library."""
        if not any(t in text for t in self.added):
            return self.encode([text])[0]
        if not self.plain_added:
            return array("H", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        parts = self.split(text)
        parts[::2] = self.encode(parts[::2])
        parts[1::2] = [self.added[t] for t in parts[1::2]]
        return b"".join(parts)


def _gathered(ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``ids`` that ``codes`` name, one after the other, and where each begins (and the last ends)."""
    counts = lengths[codes]
    ends = np.append(0, np.cumsum(counts))
    places = np.repeat((starts[codes] - ends[:-1]).astype(np.int32), counts)
    places += np.arange(len(places), dtype=np.int32)  # a text has fewer bytes, and so fewer ids, than 2^31
    return ids[places], ends


def _words(text: str) -> list[str]:
    if "\x00" in text or re.search(r" \s", text):
        return re.split(r"(?= \S)", text)
    return text.replace(" ", "\x00 ").split("\x00")


def encoder(path: str, remembered: int = REMEMBERED) -> Encoder:
    """One for each worker, kept between tasks. Vocabularies of up to 65,536 ids. More ``remembered`` words cost memory and
    save encoding rare ones again."""
    if path not in _LOADED:
        import public_tokenizers

        _LOADED[path] = Encoder(path, public_tokenizers.PATTERN)
    _LOADED[path].remembered = remembered
    return _LOADED[path]
