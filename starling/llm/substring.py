"""Substring dedup: words inside a window that also starts in an earlier document are removed.

Pass one: every bundle of documents lays its distinct windows on a count-min sketch (ROWS rows whose
width follows the size of the input) and sends the cells it touches; the sketches are merged slice
by slice. A cell is known to hold a repeated window only if two bundles, or two documents of one
bundle, touched it, so the estimate is never too low. Pass two sends only windows all of whose
cells say "repeated", by a full hash and with nothing but whether the bundle's first holder is the
first of all; these are grouped exactly. Both passes use the same shuffle of the texts.

Defined results: a null or empty text has no words. Rows that share a doc_id count as one document, so
they don't remove each other's words. A row without doc_id keeps all its words and removes none.
Texts are read whole; a text longer than a bundle is a bundle of its own. Repeats inside one document
stay. Other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starling.llm.common import SPACES, names, tidy, tidy_pair
from starling.llm.exchange import (
    ASK,
    Layout,
    answer,
    ask_rows,
    ask_table,
    bundled,
    cut,
    ordered,
    replies_of,
    unpack,
)
from starling.llm.registry import query
from starling.llm.words import NOT_SPACE, U64, gram_hashes, hash_spans, mix, pieces, run_starts, spans

WINDOW = 13
#: Rows of the count-min sketch, and cells per word in each.
ROWS = 2
CELLS_PER_WORD = 4


class Windows:
    """The windows of a bundle: hash and document number of each, in order of place."""

    def __init__(self, table: pa.Table, window: int):
        self.parts = []  # (piece, starts, ends, bounds, window places, hashes)
        ids = table.column("doc_id").to_pylist()
        numbers, number = [], -1
        for k, x in enumerate(ids):
            if k == 0 or x != ids[k - 1]:
                number += 1
            numbers.append(-1 if x is None else number)
        self.numbers = np.array(numbers, np.int64)
        documents, hashes = [], []
        for piece in pieces(table.column("text")):
            starts, ends, bounds = spans(piece, NOT_SPACE)
            words = hash_spans(piece.data, starts, ends)
            place = np.flatnonzero(run_starts(bounds, window))
            text = np.repeat(np.arange(len(piece)), np.diff(bounds))[place] + piece.first
            place, text = place[self.numbers[text] >= 0], text[self.numbers[text] >= 0]
            found = gram_hashes(words, window)[place] if len(place) else np.zeros(0, U64)
            self.parts.append((piece, starts, ends, bounds, place, found))
            documents.append(self.numbers[text])
            hashes.append(found)
        self.documents = np.concatenate([*documents, np.zeros(0, np.int64)])
        self.hashes = np.concatenate([*hashes, np.zeros(0, U64)])

    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted distinct hashes, the first document of each, and whether a second one has it."""
        order = np.argsort(self.hashes)
        hashes, documents = self.hashes[order], self.documents[order]
        new = np.ones(len(hashes), bool)
        new[1:] = hashes[1:] != hashes[:-1]
        at = np.flatnonzero(new)
        if not len(at):
            return hashes, documents, new
        first, last = np.minimum.reduceat(documents, at), np.maximum.reduceat(documents, at)
        return hashes[at], first, first != last


def _cells(hashes: np.ndarray, row: int, bits: int) -> np.ndarray:
    return mix(hashes ^ U64(0x1357 + row)) >> U64(64 - bits)


def _merge_sketches(asked, counts):
    """Add up how many documents touched each cell (two at most tell); one bit per cell asked."""
    if not asked:
        return []
    low = min(int(k[0]) for k in asked)
    high = max(int(k[-1]) for k in asked)
    cells = np.zeros(high - low + 1, np.uint8)
    for keys, number in zip(asked, counts, strict=True):
        at = (keys - U64(low)).astype(np.int64)
        cells[at] = np.minimum(cells[at] + number.astype(np.uint8), 2)
    return [np.packbits(cells[(k - U64(low)).astype(np.int64)] > 1).tobytes() for k in asked]


def _first_holders(asked, firsts):
    """For each hash: does a bundle with a smaller document than this one's hold it?"""
    keys = np.concatenate(asked)
    ids = np.concatenate(firsts).view(np.int64)
    order = np.argsort(keys)
    keys, ids = keys[order], ids[order]
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    least = np.minimum.reduceat(ids, np.flatnonzero(new))[np.cumsum(new) - 1] if len(keys) else ids
    later = np.empty(len(keys), bool)
    later[order] = ids > least
    edges = np.concatenate([[0], np.cumsum([len(k) for k in asked])])
    return [np.packbits(later[a:b]).tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)]


def dedup_substrings(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of `docs` (doc_id, text and any others) with n_words and n_removed.

    `text` holds the kept words joined by one space where words were removed, and the input text
    elsewhere. Columns named n_words or n_removed are replaced.
    """
    layout = Layout.of(docs)
    bits = max(10, (CELLS_PER_WORD * layout.words // 2).bit_length())
    cell_slices = layout.slices(layout.words // 2)
    key_slices = layout.slices(layout.words // 8)
    others = [c for c in docs.columns if c not in ("doc_id", "text", "n_words", "n_removed")]
    # The other columns travel as one, so that no name can clash.
    rest = F.struct(*names(others)) if others else F.lit(None).cast("int")
    rows = bundled(docs.select("doc_id", "text", rest.alias("rest")), layout)
    kinds = {field.name: field.dataType for field in rows.schema}

    def sketch(table: pa.Table) -> pa.Table:
        bundle = table.column("bundle")[0].as_py()
        hashes, _, twice = Windows(ordered(table), window).distinct()
        out = ([], [], [], [])
        for row in range(ROWS):
            cells = _cells(hashes, row, bits)
            order = np.argsort(cells)
            cells, many = cells[order], 1 + twice[order].astype(np.int64)
            new = np.ones(len(cells), bool)
            new[1:] = cells[1:] != cells[:-1]
            at = np.flatnonzero(new)
            number = np.minimum(np.add.reduceat(many, at), 2) if len(at) else many
            for mine, more in zip(out, ask_rows(bundle, cells[at], number, cell_slices, bits, row * cell_slices), strict=True):
                mine.extend(more)
        return ask_table(out)

    def estimated(windows: Windows, answers: pa.Table):
        """The distinct windows of the bundle that all rows of the sketch call repeated."""
        hashes, first, twice = windows.distinct()
        maybe = np.ones(len(hashes), bool)
        replies = replies_of(answers)
        for row in range(ROWS):
            cells = np.unique(_cells(hashes, row, bits))
            bitmap = [
                np.unpackbits(np.frombuffer(reply, np.uint8))
                for number, _, reply in replies
                if number // cell_slices == row
            ]
            sizes = [
                b - a
                for a, b in _slices_used(cells, cell_slices, bits)
            ]
            told = np.concatenate([b[:n] for b, n in zip(bitmap, sizes, strict=True)]) if sizes else np.zeros(0, np.uint8)
            maybe &= told[np.searchsorted(cells, _cells(hashes, row, bits))].astype(bool) if len(cells) else maybe
        return hashes[maybe], first[maybe]

    def candidates(texts: pa.Table, answers: pa.Table) -> pa.Table:
        texts = ordered(texts)
        if not texts.num_rows or not answers.num_rows:
            return ask_table(([], [], [], []))
        windows = Windows(texts, window)
        hashes, first = estimated(windows, answers)
        ids = np.full(int(windows.numbers.max(initial=0)) + 1, 0, np.int64)
        own = windows.numbers >= 0
        ids[windows.numbers[own]] = np.array(texts.column("doc_id").to_pylist(), object)[own].astype(np.int64)
        return ask_table(
            ask_rows(texts.column("bundle")[0].as_py(), hashes, ids[first].view(U64), key_slices, 64)
        )

    def remove(texts: pa.Table, answers: pa.Table) -> pa.Table:
        texts = ordered(texts)
        windows = Windows(texts, window)
        known, later = [np.zeros(0, U64)], [np.zeros(0, bool)]
        for _, packed, reply in replies_of(answers):
            keys = unpack(packed)
            known.append(keys)
            later.append(np.unpackbits(np.frombuffer(reply, np.uint8))[: len(keys)].astype(bool))
        known, later = np.concatenate(known), np.concatenate(later)
        hashes, first, _ = windows.distinct()
        at = np.searchsorted(hashes, known)
        gone_all = np.zeros(len(hashes), bool)
        gone_rest = np.zeros(len(hashes), bool)
        gone_all[at[later]] = True
        gone_rest[at[~later]] = True
        place = np.searchsorted(hashes, windows.hashes)
        marked = gone_all[place] | (gone_rest[place] & (windows.documents != first[place])) if len(hashes) else np.zeros(0, bool)
        out_text, n_words, n_removed, begin = [], [], [], 0
        given = texts.column("text").to_pylist()
        for piece, starts, ends, bounds, places, _ in windows.parts:
            mine = places[marked[begin : begin + len(places)]]
            begin += len(places)
            change = np.bincount(mine, minlength=len(starts) + 1)
            change = change - np.bincount(mine + window, minlength=len(starts) + 1)
            covered = np.cumsum(change)[:-1] > 0
            body = piece.data.tobytes()
            for i in range(len(piece)):
                a, b = int(bounds[i]), int(bounds[i + 1])
                cut_words = int(covered[a:b].sum())
                n_words.append(b - a)
                n_removed.append(cut_words)
                if cut_words:
                    keep = np.flatnonzero(~covered[a:b]) + a
                    out_text.append(b" ".join(body[x:y] for x, y in zip(starts[keep], ends[keep], strict=True)).decode())
                else:
                    out_text.append(given[piece.first + i])
        return pa.table(
            {
                "doc_id": texts.column("doc_id"),
                "text": pa.array(out_text, pa.string()),
                "n_words": pa.array(n_words, pa.int64()),
                "n_removed": pa.array(n_removed, pa.int64()),
                "rest": texts.column("rest"),
            }
        )

    asked = rows.groupBy("bundle").applyInArrow(tidy(sketch), ASK)
    sketches = answer(asked, _merge_sketches)
    repeated = rows.groupBy("bundle").cogroup(sketches.groupBy("bundle")).applyInArrow(tidy_pair(candidates), ASK)
    exact = answer(repeated, _first_holders, with_keys=True)
    schema = T.StructType(
        [
            T.StructField("doc_id", kinds["doc_id"]),
            T.StructField("text", T.StringType()),
            T.StructField("n_words", T.LongType()),
            T.StructField("n_removed", T.LongType()),
            T.StructField("rest", kinds["rest"]),
        ]
    )
    done = rows.groupBy("bundle").cogroup(exact.groupBy("bundle")).applyInArrow(tidy_pair(remove), schema)
    given = [
        F.col(c) if c in ("doc_id", "text") else F.col(f"rest.`{c}`").alias(c)
        for c in docs.columns
        if c not in ("n_words", "n_removed")
    ]
    return done.select(*given, "n_words", "n_removed")


def _slices_used(keys: np.ndarray, slices: int, bits: int):
    edges = cut(keys, slices, bits)
    return [(a, b) for a, b in zip(edges[:-1], edges[1:], strict=True) if a < b]


def kept_hash(text: str) -> F.Column:
    """sha256 of the words of a text joined by one space."""
    words = F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")
    return F.sha2(F.array_join(words, " ").cast("binary"), 256)


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), g AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)
), f AS (
  SELECT doc_id, i, min(doc_id) OVER (PARTITION BY k) AS first FROM g
), c AS (
  SELECT doc_id, list(DISTINCT p) AS gone FROM (
    SELECT doc_id, unnest(range(i, i + 13)) AS p FROM f WHERE first < doc_id) GROUP BY doc_id
), word AS (
  SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d
), gone AS (SELECT doc_id, unnest(gone) AS p FROM c), kept AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


@query("op2_substring_dedup", OP2_SQL)
def op2_substring_dedup(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_substrings(docs).select("doc_id", "n_words", "n_removed", kept_hash("text").alias("kept_sha256"))
