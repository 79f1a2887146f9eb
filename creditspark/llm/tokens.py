"""Whole texts to ids of the public word BPE, by way of their distinct words.

The vocabulary's pre-tokenizer drops white space and never joins across it, nor across the border
between a letter and a mark other than an apostrophe, so the ids of a text are the ids of such pieces
one after the other. Each worker keeps the ids of pieces it has met (a bounded memo) and asks the tokenizers
library only for new ones, many in one call: the ids of single-word pieces are told apart by the
vocabulary's word ends, those of other pieces by a special string between them. Texts that may hold the
tokenizer's special strings go to the library whole.
The ids equal ``Tokenizer.encode`` of the whole text in every case (tested).
"""

from __future__ import annotations

from array import array
from itertools import compress, repeat
from operator import is_

import numpy as np

from .text import Words

WORD_VOCABULARY = "word_bpe_49k.json"
#: Pieces in each of the memo's two generations.
MEMO_WORDS = 200_000
_PER_CALL = 2_000


_LETTER, _MARK = np.zeros(256, bool), np.zeros(256, bool)
_LETTER[97:123] = True
#: Second bytes of the letters U+00C0 to U+00FF, which all begin with 0xC3.
_AFTER_C3 = np.zeros(256, bool)
_AFTER_C3[128:192] = True
_AFTER_C3[[0x97, 0xB7]] = False
#: The bytes of characters below U+0100 that words of letters may hold.
_LATIN = bytes([*range(97, 123), 0xC2, 0xC3, *range(128, 192)])
#: The characters that stand for bytes in the vocabulary; the space stays, to part words.
_BYTE_CHARS = np.arange(256, dtype="<u2")
_BYTE_CHARS[[*range(127, 161), 173]] = np.arange(289, 324)
_MARK[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'"]] = True


def _pieces(texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """The pieces of all texts in turn, and how many each text has."""
    raw = np.frombuffer(b" ".join([*(t.lower() for t in texts), b""]), np.uint8)
    letter, mark = _LETTER[raw], _MARK[raw]
    lead = np.flatnonzero(raw[:-1] == 0xC3)
    lead = lead[_AFTER_C3[raw[lead + 1]]]
    letter[lead] = letter[lead + 1] = True
    border = np.flatnonzero(letter[:-1] & mark[1:] | mark[:-1] & letter[1:]) + 1
    end = np.cumsum([len(t) + 1 for t in texts])
    flat = np.insert(raw, border, 32).tobytes()
    cut = [0, *(end + np.searchsorted(border, end)).tolist()]
    return flat.split(), Words.counts(flat, cut)


class WordCoder:
    """``encode_all(texts)``: for each UTF-8 text its ids as little-endian uint32 bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # the same vocabulary for lower-case words of letters below U+0100, given as the characters of their bytes
        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        n = self.tokenizer.get_vocab_size()
        self.ends = np.array([(self.tokenizer.id_to_token(i) or "").endswith("</w>") for i in range(n)])
        added = self.tokenizer.get_added_tokens_decoder()
        self.between = next(((i, x.content) for i, x in added.items() if x.content.startswith("<|") and not x.normalized), None)
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _ask(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _learn(self, pieces: set[bytes]) -> None:
        new = pieces.difference(self.older)
        back = pieces.difference(new)
        self.known.update(zip(back, map(self.older.__getitem__, back), strict=True))
        plain, words, other = list(filter(bytes.isalpha, new)), [], []  # of bytes: a-z
        for w in new.difference(plain):
            if not w.decode().isalpha():
                other.append(w)
            elif w.translate(None, _LATIN):
                words.append(w)
            else:
                plain.append(w)
        self._learn_words(self.plain, plain)
        self._learn_words(self.tokenizer, words)
        self._learn_other(other)

    def _learn_words(self, tokenizer, words: list[bytes]) -> None:
        known = self.known
        for i in range(0, len(words), _PER_CALL):
            part = words[i : i + _PER_CALL]
            text = b" ".join(part).decode()
            if tokenizer is self.plain and not text.isascii():
                text = _BYTE_CHARS[np.frombuffer(text.lower().encode(), np.uint8)].tobytes().decode("utf-16-le")
            got = tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
            ids = np.array(got, "<u4")
            last = np.flatnonzero(self.ends[ids]) + 1
            if len(last) == len(part):  # so each is one word to the pre-tokenizer
                raw, ends = ids.tobytes(), (4 * last).tolist()
                known.update(zip(part, map(raw.__getitem__, map(slice, [0, *ends], ends)), strict=False))
            else:
                known.update((w, self._ask(w.decode())) for w in part)

    def _learn_other(self, pieces: list[bytes]) -> None:
        if self.between is None:
            self.known.update((w, self._ask(w.decode())) for w in pieces)
            return
        number, text = self.between
        for i in range(0, len(pieces), _PER_CALL):
            part = pieces[i : i + _PER_CALL]
            joined = text.join([w.decode() for w in part])
            got = self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids
            ids = np.array([*got, number], "<u4")
            ends = np.flatnonzero(ids == number)
            raw, starts = ids.tobytes(), 4 * np.append(0, ends[:-1] + 1)
            self.known.update(zip(part, map(raw.__getitem__, map(slice, starts.tolist(), (4 * ends).tolist())), strict=True))

    def encode_all(self, texts: list[bytes]) -> list[bytes]:
        special = [i for i, t in enumerate(texts) if b"<|" in t]
        if special:
            whole = {i: self._ask(texts[i].decode()) for i in special}
            rest = iter(self.encode_all([t for i, t in enumerate(texts) if i not in whole]))
            return [whole[i] if i in whole else next(rest) for i in range(len(texts))]
        if not texts:
            return []
        if len(self.known) > MEMO_WORDS:
            self.known, self.older = {}, self.known
        pieces, count = _pieces(texts)
        ids = list(map(self.known.get, pieces))
        if None in ids:
            new = list(compress(range(len(ids)), map(is_, ids, repeat(None))))
            asked = list(map(pieces.__getitem__, new))
            self._learn(set(asked))
            for i, x in zip(new, map(self.known.__getitem__, asked), strict=True):
                ids[i] = x
        end = np.cumsum(count).tolist()
        return [b"".join(ids[a:b]) for a, b in zip([0, *end], end)]


_CODERS: dict[str, WordCoder] = {}


def coder(path: str) -> WordCoder:
    """One coder for each worker process and vocabulary."""
    if path not in _CODERS:
        _CODERS[path] = WordCoder(path)
    return _CODERS[path]


def vocabulary_path(path: str | None) -> str:
    """The given path, or the public word vocabulary of the machine that asks."""
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path(WORD_VOCABULARY)
