"""Lower-cased words of letters, their character n-grams, and scores per distinct word.

Character models that look at single words give a word the same score wherever it stands, so a
task scores each distinct word once and adds up over the texts.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np

from starling.llm.words import U64, hash_spans, mix

#: Marks before and behind a word; neither is a letter.
FRONT, BACK = 1, 2
#: Characters worked on at once.
PIECE_CHARS = 1 << 20
#: Distinct words whose scores a task remembers.
CACHE_WORDS = 400_000


@functools.cache
def letter_table() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def code_values(codes: np.ndarray) -> np.ndarray:
    return mix(codes.astype(U64) + U64(0x1234567))


class Words:
    """The words of some texts: spans in `codes`, hashes, and text i has words bounds[i]:bounds[i+1]."""

    def __init__(self, texts: list[str | None]):
        lowered = [(t or "").lower() for t in texts]
        self.codes = np.frombuffer("\n".join(lowered).encode("utf-32-le"), np.uint32)
        lengths = np.fromiter((len(t) + 1 for t in lowered), np.int64, len(lowered))
        inside = np.zeros(len(self.codes) + 2, np.int8)
        inside[1:-1] = letter_table()[self.codes]
        turns = np.diff(inside)
        self.starts, self.ends = np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)
        self.bounds = np.searchsorted(self.starts, np.concatenate([[0], np.cumsum(lengths)]))
        self.hashes = hash_spans(self.codes, self.starts, self.ends, code_values)

    def texts_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def text_pieces(texts: list[str | None]) -> Iterator[list[str | None]]:
    piece, size = [], 0
    for text in texts:
        piece.append(text)
        size += len(text or "")
        if size >= PIECE_CHARS:
            yield piece
            piece, size = [], 0
    if piece:
        yield piece


def padded(
    codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, front: int, back: int
) -> tuple[np.ndarray, np.ndarray]:
    """The words laid end to end with marks around each; (codes, bounds)."""
    lengths = ends - starts
    bounds = np.concatenate([[0], np.cumsum(lengths + front + back)])
    flat = np.full(bounds[-1], FRONT, np.uint32)
    shift = np.repeat(bounds[:-1] + front - starts, lengths)
    source = np.arange(lengths.sum()) + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    flat[source + shift] = codes[source]
    for k in range(1, back + 1):
        flat[bounds[1:] - k] = BACK
    return flat, bounds


def gram_ends(flat: np.ndarray, n: int) -> np.ndarray:
    """For each place the hash of the n codes that end there (the first n - 1 places are void)."""
    values = flat.astype(U64) + U64(7)
    total = np.full(len(flat), U64(n), U64)
    with np.errstate(over="ignore"):
        for k in range(n - 1, -1, -1):
            moved = values if k == 0 else np.concatenate([np.zeros(min(k, len(flat)), U64), values[:-k]])
            total = (total + moved) * U64(0x9E3779B97F4A7C15)
            total ^= total >> U64(29)
    return mix(total)


class Remembered:
    """Scores of words by hash: computed once per distinct word, forgotten when there are too many."""

    def __init__(self, score: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray], columns: int):
        self.score, self.columns = score, columns
        self.keys, self.values = np.zeros(0, U64), np.zeros((0, columns))

    def of(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(scores of the distinct words, place of each word's score)."""
        distinct, first, place = np.unique(words.hashes, return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.keys, distinct), max(len(self.keys) - 1, 0))
        known = self.keys[at] == distinct if len(self.keys) else np.zeros(len(distinct), bool)
        out = np.empty((len(distinct), self.columns))
        if len(self.keys):
            out[known] = self.values[at[known]]
        if not known.all():
            fresh = first[~known]
            out[~known] = self.score(words.codes, words.starts[fresh], words.ends[fresh])
            if len(self.keys) > CACHE_WORDS:
                self.keys, self.values = distinct, out
            else:
                keys = np.concatenate([self.keys, distinct[~known]])
                order = np.argsort(keys)
                self.keys = keys[order]
                self.values = np.concatenate([self.values, out[~known]])[order]
        return out, place


def sums(values: np.ndarray, groups: np.ndarray, n: int) -> np.ndarray:
    """Column sums by group."""
    return np.stack([np.bincount(groups, values[:, k], n) for k in range(values.shape[1])], axis=1)
