"""Token files: ids of documents in ascending doc_id order, compressed by Re-Pair grammars.

The rows are range-partitioned by doc_id and encoded in order; every few million ids become a shard
with its own grammar. Pairs of neighbouring ids that occur often are replaced by a new symbol,
again and again, never across documents; the shard stores the rules, the length each symbol
expands to, and where every document begins, so one document is decoded without the rest. Shards
are rows of a Parquet table: a lost executor repeats its tasks, a committed file is whole.

Defined results: a null text is an empty one; every document ends in END. Rows that share a doc_id
stay rows, ordered by their text. A missing doc_id sorts first. Long texts are not cut: a
shard closes after the document that fills it.
"""

from __future__ import annotations

import functools
import gc
import math
import os
import re
import unicodedata
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starling.functions.ranking import running_total
from starling.llm.common import text_bytes
from starling.llm.registry import query

END = 0
#: Ids of a shard, UTF-8 bytes of a range partition.
SHARD_IDS = 2_000_000
PARTITION_BYTES = 24 << 20
#: Re-Pair: rounds, new symbols a round, and how often a pair must occur.
ROUNDS = 8
ROUND_RULES = 8192
MIN_PAIRS = 8
#: A round that replaces a smaller share of the places is the last.
GAIN = 0.02
#: Distinct chunks of text whose ids a task remembers.
CACHE_CHUNKS = 700_000
#: The characters that the tokenizer's pattern takes as white space.
WHITE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
#: White space and what follows it up to the next white space: no token crosses such a border.
CHUNK = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")


@functools.cache
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _class(kind: str) -> str:
    return re.escape("".join(chr(c) for c in range(0x250) if unicodedata.category(chr(c))[0] == kind))


#: Characters below U+0250 except unusual white space and what starts a special token: their classes
#: are the same in every Unicode version. Other chunks go to the library whole.
PLAIN = re.compile("[\t-\r -;=-~\xa1-\u024f]*")
#: The published pattern by which byte-level BPE cuts a text before its merges, for those characters.
PRETOKENS = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[{L}]+| ?[{N}]+| ?[^\s{L}{N}]+|\s+(?!\S)|\s+".format(L=_class("L"), N=_class("N"))
)


def byte_letters() -> dict[int, str]:
    """How byte-level BPE writes a byte: printable ones as themselves, the rest from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class Places(dict):
    """Chunk -> number; a chunk that is new gets the next number and waits to be encoded."""

    def __init__(self):
        super().__init__()
        self.waiting: list[str] = []

    def __missing__(self, chunk: str) -> int:
        self[chunk] = number = len(self)
        self.waiting.append(chunk)
        return number


class Encoder:
    """Ids of texts; what a text is cut into is encoded once and remembered.

    Plain texts are cut as the tokenizer cuts them, and the library's BPE model merges each part. Others
    are cut into chunks between white space; a part of a text is a chunk of one part.
    """

    def __init__(self, path: str):
        self.tokenizer = _tokenizer(path)
        self.merge = self.tokenizer.model.tokenize
        special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        # Chunks that could hold a special token are not plain.
        self.plain = PLAIN.fullmatch if all(t[0] == "<" for t in special) else (lambda chunk: None)
        self.letters = byte_letters()
        self.clear()

    def clear(self) -> None:
        self.places = Places()
        self.parts: dict[str, list[int]] = {}
        self.ids = np.zeros(1 << 16, np.uint32)
        self.edges = np.zeros(1, np.int64)

    def _chunk_ids(self, chunk: str) -> list[int]:
        if not self.plain(chunk):
            return self.tokenizer.encode(chunk, add_special_tokens=False).ids
        cut = PRETOKENS.findall(chunk)
        if len(cut) == 1:
            return self._part_ids(chunk)
        found: list[int] = []
        for part in cut:
            ids = self.parts.get(part)
            if ids is None:
                ids = self.parts[part] = self._part_ids(part)
            found += ids
        return found

    def _part_ids(self, part: str) -> list[int]:
        if part.isascii() and part.isprintable():
            written = part.replace(" ", self.letters[32])
        else:
            written = part.encode().decode("latin-1").translate(self.letters)
        return [token.id for token in self.merge(written)]

    def _learn(self) -> None:
        # A hundred thousand small lists live for a moment; none is part of a cycle.
        gc.disable()
        try:
            learned = [self._chunk_ids(chunk) for chunk in self.places.waiting]
        finally:
            gc.enable()
        self.places.waiting.clear()
        if len(self.parts) > CACHE_CHUNKS // 4:
            self.parts.clear()
        sizes = np.fromiter(map(len, learned), np.int64, len(learned))
        begin = int(self.edges[-1])
        end = begin + int(sizes.sum())
        if end > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(len(self.ids), end - len(self.ids)), np.uint32)])
        self.ids[begin:end] = np.fromiter(chain.from_iterable(learned), np.uint32, end - begin)
        self.edges = np.concatenate([self.edges, begin + np.cumsum(sizes)])

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        if len(self.places) > CACHE_CHUNKS:
            self.clear()
        split = [(PRETOKENS if self.plain(text) else CHUNK).findall(text) for text in (t or "" for t in texts)]
        counts = np.fromiter(map(len, split), np.int64, len(split))
        at = np.fromiter(map(self.places.__getitem__, chain.from_iterable(split)), np.int64, counts.sum())
        if self.places.waiting:
            self._learn()
        sizes = self.edges[at + 1] - self.edges[at]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        flat = self.ids[np.arange(total) + np.repeat(self.edges[at] - (ends - sizes), sizes)]
        borders = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        return [flat[a:b] for a, b in zip(borders[:-1], borders[1:], strict=True)]


@functools.cache
def _encoder(path: str) -> Encoder:
    """One per Python worker, so later tasks start with what earlier ones learned."""
    return Encoder(path)


def _free(places: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Of overlapping occurrences (neighbouring places) keep the better rank, then the first."""
    none, kept = np.iinfo(np.int64).max, []
    for _ in range(3):
        near = np.diff(places) == 1
        left, right = np.full(len(places), none), np.full(len(places), none)
        left[1:][near] = rank[:-1][near]
        right[:-1][near] = rank[1:][near]
        best = (rank < left) & (rank <= right)
        kept.append(places[best])
        gone = best.copy()
        gone[1:] |= best[:-1] & near
        gone[:-1] |= best[1:] & near
        places, rank = places[~gone], rank[~gone]
        if not len(places):
            break
    return np.sort(np.concatenate(kept))


def _bucket(pairs: np.ndarray) -> np.ndarray:
    return (pairs * 0x9E3779B1 ^ pairs >> 29) & ((1 << 18) - 1)


def _found(pairs: np.ndarray, inside: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the places `inside` whose pair is one of the sorted `kinds`, which one).

    A table of hashes names one kind a bucket; only pairs of buckets that hold several are searched.
    """
    home = _bucket(kinds)
    table = np.full(1 << 18, -1, np.int32)
    table[home] = np.arange(len(kinds), dtype=np.int32)
    shared = np.zeros(1 << 18, bool)
    shared[home[table[home] != np.arange(len(kinds))]] = True
    bucket = _bucket(pairs)
    at = table[bucket]
    maybe = np.flatnonzero((at >= 0) & inside)
    at, own = at[maybe], pairs[maybe]
    again = np.flatnonzero(shared[bucket[maybe]])
    at[again] = np.minimum(np.searchsorted(kinds, own[again]), len(kinds) - 1)
    real = kinds[at] == own
    return maybe[real], at[real]


def compress(ids: np.ndarray, starts: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Re-Pair: (symbols, rules, starts of the documents among the symbols).

    Rule k says what symbol base + k stands for. `starts` are the documents' first places.
    """
    symbols = ids.astype(np.int64)
    head = np.zeros(len(symbols) + 1, bool)
    head[starts[starts < len(symbols)]] = True
    rules: list[np.ndarray] = []
    count = 0
    for _ in range(ROUNDS):
        if len(symbols) < 2:
            break
        pairs = symbols[:-1] << 32 | symbols[1:]
        inside = ~head[1 : len(symbols)]
        kinds, times = np.unique(pairs[inside], return_counts=True)
        often = np.flatnonzero(times >= MIN_PAIRS)
        if not len(often):
            break
        best = often[np.lexsort((kinds[often], -times[often]))][:ROUND_RULES]
        order = np.argsort(kinds[best])
        sorted_kinds = kinds[best][order]
        places, at = _found(pairs, inside, sorted_kinds)
        chosen = _free(places, order[at])
        which = np.zeros(len(pairs), np.int32)
        which[places] = at
        own = which[chosen]
        seen = np.bincount(own, minlength=len(sorted_kinds)) > 0
        used = sorted_kinds[seen]
        rules.append(np.stack([used >> 32, used & 0xFFFFFFFF], axis=1))
        symbols[chosen] = base + count + (np.cumsum(seen) - 1)[own]
        count += len(used)
        keep = np.ones(len(symbols), bool)
        keep[chosen + 1] = False
        symbols, head = symbols[keep], np.append(head[:-1][keep], False)
        if len(chosen) < GAIN * len(keep):
            break
    grammar = np.concatenate(rules) if rules else np.zeros((0, 2), np.int64)
    return symbols, grammar, np.flatnonzero(head)


def expansion_lengths(rules: np.ndarray, base: int) -> np.ndarray:
    lengths: list[int] = []
    for a, b in rules.tolist():
        lengths.append((lengths[a - base] if a >= base else 1) + (lengths[b - base] if b >= base else 1))
    return np.array(lengths, np.int64)


def expand(symbols: np.ndarray, rules: np.ndarray, base: int) -> np.ndarray:
    """The ids that the symbols stand for; any stretch of symbols can be expanded alone.

    Each kind of symbol in it is expanded once; its places copy what it stands for.
    """
    symbols = symbols.astype(np.int64)
    asked = np.zeros(len(rules), bool)
    asked[symbols[symbols >= base] - base] = True
    kinds = np.flatnonzero(asked)
    owner, flat = np.arange(len(kinds)), kinds + base
    while (deep := flat >= base).any():
        sizes = 1 + deep
        begin = np.cumsum(sizes) - sizes
        out = np.repeat(flat, sizes)
        pair = rules[flat[deep] - base]
        out[begin[deep]], out[begin[deep] + 1] = pair[:, 0], pair[:, 1]
        owner, flat = np.repeat(owner, sizes), out
    lengths = np.ones(len(symbols), np.int64)
    home = np.zeros(len(symbols), np.int64)
    high = np.flatnonzero(symbols >= base)
    number = (np.cumsum(asked) - 1)[symbols[high] - base]
    own = np.bincount(owner, minlength=len(kinds))
    lengths[high], home[high] = own[number], (np.cumsum(own) - own)[number]
    ends = np.cumsum(lengths)
    out = np.repeat(symbols, lengths)
    places = np.flatnonzero(out >= base)
    out[places] = flat[(places + np.repeat(home - (ends - lengths), lengths)[places])]
    return out.astype(np.uint32)


SHARD = (
    "part int, shard int, base int, n_ids long, doc_ids array<{kind}>, doc_starts array<int>, "
    "doc_symbols array<int>, symbols binary, rules binary, lengths binary"
)


def write_token_files(docs: DataFrame, tokenizer: str, path: str, text: str = "text") -> None:
    """Write the ids of all rows as shard rows under `path`."""
    kind = dict(docs.dtypes)["doc_id"]
    parts = max(1, math.ceil(text_bytes(docs, text) / PARTITION_BYTES))
    rows = docs.select("doc_id", F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    rows = rows.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    arrow_kind = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]

    def shard_row(part: int, number: int, base: int, doc_ids: list, ids: list[np.ndarray]) -> pa.RecordBatch:
        flat = np.concatenate(ids)
        starts = np.concatenate([[0], np.cumsum([len(x) for x in ids])[:-1]])
        symbols, rules, first = compress(flat, starts, base)
        values = [
            [part], [number], [base], [len(flat)], [doc_ids], [starts.astype(np.int32)], [first.astype(np.int32)],
            [symbols.astype("<u4").tobytes()], [rules.astype("<u4").tobytes()],
            [expansion_lengths(rules, base).astype("<u4").tobytes()],
        ]
        types = [
            pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.list_(arrow_kind), pa.list_(pa.int32()),
            pa.list_(pa.int32()), pa.binary(), pa.binary(), pa.binary(),
        ]
        names = [field.split()[0] for field in SHARD.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        base = encoder.tokenizer.get_vocab_size(with_added_tokens=True)
        part, number, size = TaskContext.get().partitionId(), 0, 0
        doc_ids: list = []
        ids: list[np.ndarray] = []
        for batch in batches:
            names, texts = batch.column(0).to_pylist(), batch.column(1)
            for a in range(0, len(names), 500):
                found = encoder.encode(texts.slice(a, 500).to_pylist())
                for name, own in zip(names[a : a + 500], found, strict=True):
                    doc_ids.append(name)
                    ids.append(np.append(own, np.uint32(END)))
                    size += len(ids[-1])
                    if size >= SHARD_IDS:
                        yield shard_row(part, number, base, doc_ids, ids)
                        doc_ids, ids, size, number = [], [], 0, number + 1
        if ids:
            yield shard_row(part, number, base, doc_ids, ids)

    rows.mapInArrow(run, SHARD.format(kind=kind)).write.parquet(path)


def decode_document(row, k: int) -> np.ndarray:
    """The ids of the k-th document of a shard row, from its own symbols alone."""
    symbols = np.frombuffer(row["symbols"], "<u4")
    rules = np.frombuffer(row["rules"], "<u4").reshape(-1, 2).astype(np.int64)
    first = row["doc_symbols"]
    end = first[k + 1] if k + 1 < len(first) else len(symbols)
    return expand(symbols[first[k] : end], rules, row["base"])


def read_token_files(spark, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids) per document; start counts all ids before it."""
    files = spark.read.parquet(path)
    kind = dict(files.dtypes)["doc_ids"][len("array<") : -1]
    ends = running_total(files.select("part", "shard", "n_ids"), [], ["part", "shard"], F.col("n_ids"), "_end")
    based = files.join(
        ends.select("part", "shard", (F.col("_end") - F.col("n_ids")).alias("first_id")), ["part", "shard"]
    ).select("doc_ids", "doc_starts", "n_ids", "first_id", "base", "symbols", "rules")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                doc_ids = row.column(0).flatten()
                starts = row.column(1).flatten().to_numpy().astype(np.int64)
                rules = np.frombuffer(row.column(6)[0].as_buffer(), "<u4").reshape(-1, 2).astype(np.int64)
                symbols = np.frombuffer(row.column(5)[0].as_buffer(), "<u4")
                flat = np.ascontiguousarray(expand(symbols, rules, row.column(4)[0].as_py()), "<u4")
                edges = np.append(starts, row.column(2)[0].as_py())
                sums = [zlib.crc32(flat[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        doc_ids,
                        pa.array(starts + row.column(3)[0].as_py()),
                        pa.array(np.diff(edges)),
                        pa.array(sums, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(flat.astype(np.int32))),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32", "ids"],
                )

    return based.mapInArrow(run, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long, ids array<int>")


@query("op4_token_files")
def op4_token_files(spark, sf_dir):
    import uuid

    import public_tokenizers

    from starling.session import shared_dir

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    path = f"{shared_dir(spark).rstrip('/')}/starling-llm/tokens-{uuid.uuid4().hex}"
    write_token_files(docs, public_tokenizers.path("byte_bpe_50k.json"), path)
    return read_token_files(spark, path).drop("ids")
