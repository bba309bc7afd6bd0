"""Words and hashes of whole Arrow batches with numpy: no Python loop over words.

Hashes are 64-bit and depend on the bytes alone, so every task and run agrees on them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
MASK = (1 << 64) - 1
#: UTF-8 bytes that are worked on at once; a longer text is one piece.
PIECE_BYTES = 4 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: equal inputs only give equal outputs."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


BYTE_VALUES = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
STEP, LENGTH = U64(0xD6E8FEB86659FD93), U64(0xC2B2AE3D27D4EB4F)
#: Places of words worked on at once.
SEGMENT = 1 << 18


def byte_table(members: bytes, inverse: bool = False) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(members)] = True
    return ~table if inverse else table


#: Bytes of words between white space.
NOT_SPACE = byte_table(b" \t\n\x0b\f\r", inverse=True)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class Piece:
    """Some texts of a batch as one byte array: `data`, and text i is data[offsets[i]:offsets[i+1]]."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, first: int):
        self.data, self.offsets, self.first = data, offsets, first

    def __len__(self) -> int:
        return len(self.offsets) - 1


def pieces(texts: pa.Array, size: int = PIECE_BYTES) -> Iterator[Piece]:
    """The texts in pieces of about `size` bytes; nulls are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if len(texts) == 0:
        return
    if texts.null_count:
        texts = texts.fill_null("")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(texts.buffers()[1], kind)[texts.offset : texts.offset + len(texts) + 1]
    offsets = offsets.astype(np.int64)
    body = texts.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        end = int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1
        end = min(max(end, at + 1), len(texts))
        yield Piece(data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at], at)
        at = end


def spans(piece: Piece, word_bytes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, bounds): the words' byte spans; text i has words bounds[i]:bounds[i+1]."""
    inside = np.empty(len(piece.data) + 1, bool)
    inside[:-1] = word_bytes[piece.data]
    inside[-1] = False
    before = np.empty(len(piece.data) + 1, bool)
    before[0] = False
    before[1:] = inside[:-1]
    cuts = piece.offsets[1:-1]
    cuts = cuts[cuts < len(piece.data)]
    before[cuts] = False  # a text starts anew
    starts = np.flatnonzero(inside & ~before)
    stops = ~inside & before
    # Words that end where their text ends, before another text.
    closing = np.unique(cuts[cuts > 0])
    closing = closing[inside[closing - 1]]
    ends = np.flatnonzero(stops)
    if len(closing):
        ends = np.sort(np.concatenate([ends, closing]))
    bounds = np.searchsorted(starts, piece.offsets)
    return starts, ends, bounds


def byte_values(data: np.ndarray) -> np.ndarray:
    return BYTE_VALUES[data]


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values_of=byte_values) -> np.ndarray:
    """A 64-bit hash of each span: the sum of one mixed number per (value, place in the span).

    The numbers are unrelated, so no two words are bound to collide, as they are in a polynomial
    modulo a power of two; a long span is summed in parts.
    """
    sizes = ends - starts
    edges = np.concatenate([[0], np.cumsum(sizes)])
    total = int(edges[-1])
    out = np.zeros(len(starts), U64)
    with np.errstate(over="ignore"):
        for begin in range(0, total, SEGMENT):
            end = min(begin + SEGMENT, total)
            first = int(np.searchsorted(edges, begin, side="right")) - 1
            last = int(np.searchsorted(edges, end, side="left"))
            a, b = np.maximum(edges[first:last], begin), np.minimum(edges[first + 1 : last + 1], end)
            laid = np.arange(begin, end)
            place = laid - np.repeat(edges[first:last], b - a)
            values = values_of(data[place + np.repeat(starts[first:last], b - a)])
            sums = np.zeros(end - begin + 1, U64)
            np.cumsum(mix(values + place.astype(U64) * STEP), out=sums[1:])
            out[first:last] += sums[b - begin] - sums[a - begin]
        return mix(out + sizes.astype(U64) * LENGTH)


def gram_hashes(words: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Hashes of all runs of n words, over text borders too; the caller masks those."""
    count = max(len(words) - n + 1, 0)
    with np.errstate(over="ignore"):
        total = np.full(count, U64((n * 0x9E3779B97F4A7C15 + seed * 0xC2B2AE3D27D4EB4F) & MASK), U64)
        for k in range(n):
            total = (total ^ words[k : k + count]) * U64(0xFF51AFD7ED558CCD)
            total ^= total >> U64(32)
    return mix(total)


def run_starts(bounds: np.ndarray, n: int) -> np.ndarray:
    """Which word positions start a run of n words inside one text (as a mask over words)."""
    total = int(bounds[-1])
    mask = np.ones(total, bool)
    for k in range(1, n):
        last = bounds[1:] - k
        mask[last[last >= bounds[:-1]]] = False
    return mask


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """An Arrow list column from flat values and row bounds."""
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values))
