"""Whole texts cut at single spaces for byte-level BPE, so that the ids of pieces can be kept.

The pre-tokenizer's pattern never matches across a non-space followed by white space, so a
text may be cut before a space or line feed without changing a match, unless that place lies
inside a run of white space that goes on behind it. Nor does a match go on from a letter to
punctuation, so pieces are cut there too and recur more often. Texts with such a run, texts with the
string of an added token (at which the library cuts first) and texts with the mark that is
used for cutting are encoded whole.

For the same reason pieces that have not been met are encoded many in one string: one that begins
with a space or line feed before a non-space may follow any that ends in a non-space. Tokens of a
byte-level vocabulary have a character a byte, so the lengths of tokens tell the pieces apart.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from logfreight.llm.texts import LETTER_END, PieceIds, flat

_RUN = re.compile(r"\s\s(?:\s|\Z)")
_CUT = "\0"
# What a piece begins with that may follow another one in a string.
_FOLLOWS = re.compile(r"[ \n]\S").match


class JoinedPieces:
    """Ids of pieces, one after the other, and how many each has, from strings of up to ``MANY`` pieces.

    ``vocabulary`` has the id of each token that is no added one. Where the tokens of a string do
    not end with its pieces, all pieces are encoded on their own.
    """

    MANY = 256

    def __init__(self, encode_many: Callable[[list[str]], list[list[int]]], vocabulary: dict[str, int], added: list[str]):
        self.encode_many, self.apart = encode_many, any(re.search(r"\s", token) for token in added)
        self.bytes_of = np.zeros(max([*vocabulary.values(), -1]) + 1, np.int64)
        self.bytes_of[list(vocabulary.values())] = [len(token) for token in vocabulary]

    def _strings(self, pieces: list[str]) -> list[str]:
        first = np.array([not _FOLLOWS(piece) for piece in pieces], dtype=bool)
        first[1:] |= np.array([piece[-1:].isspace() for piece in pieces[:-1]], dtype=bool)
        first[:: self.MANY] = True
        begins = np.flatnonzero(first).tolist()
        return ["".join(pieces[i:j]) for i, j in zip(begins, [*begins[1:], len(pieces)])]

    def __call__(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if not self.apart:
            ids, _ = flat(self.encode_many(self._strings(pieces)))
            if not len(ids) or ids.max() < len(self.bytes_of):
                ends = np.concatenate([[0], np.cumsum(self.bytes_of[ids])])
                borders = np.cumsum(np.fromiter(map(len, map(str.encode, pieces)), np.int64, len(pieces)))
                at = np.searchsorted(ends, borders, side="right") - 1
                if np.array_equal(ends[at], borders):
                    return ids, np.diff(at, prepend=0)
        return flat(self.encode_many(pieces))


class ByteLevelTexts:
    """Ids of whole texts from a function that gives the ids of many strings.

    With a ``vocabulary``, pieces are encoded many in one string.
    """

    def __init__(
        self,
        encode_many: Callable[[list[str]], list[list[int]]],
        added: list[str],
        limit: int = 96_000_000,
        vocabulary: dict[str, int] | None = None,
    ):
        self.encode_many, self.added = encode_many, [*added, _CUT]
        self.pieces = PieceIds(JoinedPieces(encode_many, vocabulary, added) if vocabulary else encode_many, limit)

    def ids(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and how many each has; null texts have none."""
        whole = {
            i: text
            for i, text in enumerate(texts.to_pylist())
            if text and (_RUN.search(text) or any(token in text for token in self.added))
        }
        texts = pc.fill_null(texts, "")
        if whole:
            aside = np.zeros(len(texts), dtype=bool)
            aside[list(whole)] = True
            texts = pc.if_else(pa.array(aside), "", texts)
        texts = pc.replace_substring_regex(texts, LETTER_END, rf"\1{_CUT}\2")
        cut = pc.replace_substring(pc.replace_substring(texts, " ", _CUT + " "), "\n", _CUT + "\n")
        known = dict(zip(whole, self.encode_many(list(whole.values()))))
        return self.pieces.of(pc.split_pattern(cut, _CUT), known)
