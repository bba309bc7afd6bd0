"""Alignment of two tokenizers' tokens of the same text, composed from fragments of byte ranges.

Tokenizer A (byte-level BPE) reads a space and the text, tokenizer B (piece BPE) the text, before which
it puts that space itself. Byte offsets at which tokens of both end cut the tokens into groups;
tokens of both that overlap are linked. Between neighbouring ends of either tokenizer lies one link.

A text longer than `CHUNK_BYTES` is cut into byte ranges that different tasks encode. A range
begins, for each tokenizer, at the next place at which that tokenizer may be cut without changing
a token: for A between a character and the white space behind it or the punctuation after an
unaccented or CJK letter, for B between characters that stand side by side in no piece of its
vocabulary (merges only ever make pieces). The two places differ, so a range yields a fragment: the
tokens up to the first common end (open prefix), closed groups, and the tokens after the last
common end (open suffix). Joining two fragments closes what meets in the middle; this is associative,
so neighbours are joined in a tree, `FAN` at a time, until a document is one fragment. Text in
which no such place is found stays one range.

Counts of linked id pairs cover the whole corpus and are a Spark aggregate over per-document
counts, joined back to them; no task holds all pairs.

Defined results: a null or empty text, and one whose tokens do not spell it byte for byte (B writes
a space for U+2581), has no tokens: zeros and '' as digest. Rows that share a doc_id or a text stay
rows and count each. Other columns are not looked at. An empty table stays empty.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starling.llm.common import saved, with_broadcast
from starling.llm.registry import query
from starling.llm.token_files import Encoder, byte_letters

#: Bytes of a range, fragments joined at once, UTF-8 bytes a task encodes at once.
CHUNK_BYTES = 32 << 10
FAN = 8
BATCH_BYTES = 1 << 19
MARK = "\u2581"
#: What may count as white space, and letters and marks whose class no Unicode version changes.
WHITE = r"\x09-\x0D\x1C-\x20\x85\xA0\u1680\u180E\u2000-\u200F\u2028\u2029\u202F\u205F\u2060\u3000\uFEFF"
LETTER = r"A-Za-z\u3041-\u3096\u30A1-\u30FA\u4E00-\u9FA5\uAC00-\uD7A3"
MARKS = r",.;:!?()\uFF0C\u3002\u3001\uFF1B\uFF1A\uFF01\uFF1F\u300C\u300D"
A_CUT = re.compile(rf"(?<=[^{WHITE}])(?=[ \t\n\r])|(?<=[{LETTER}])(?=[{MARKS}])")
BYTE_PIECE = re.compile("<0x([0-9A-F]{2})>")


class Tokens:
    """Ids and end offsets of one tokenizer's tokens, in order."""

    def __init__(self, ids: np.ndarray, ends: np.ndarray):
        self.ids, self.ends = ids, ends

    def __len__(self) -> int:
        return len(self.ids)

    def __add__(self, other: Tokens) -> Tokens:
        return Tokens(np.concatenate([self.ids, other.ids]), np.concatenate([self.ends, other.ends]))

    def upto(self, end: int) -> tuple[Tokens, Tokens]:
        k = int(np.searchsorted(self.ends, end, side="right"))
        return Tokens(self.ids[:k], self.ends[:k]), Tokens(self.ids[k:], self.ends[k:])

    def packed(self) -> bytes:
        return np.concatenate([self.ids, self.ends]).astype("<i8").tobytes()

    @staticmethod
    def unpacked(data: bytes) -> Tokens:
        flat = np.frombuffer(data, "<i8")
        return Tokens(flat[: len(flat) // 2], flat[len(flat) // 2 :])

    @staticmethod
    def none() -> Tokens:
        return Tokens(np.zeros(0, np.int64), np.zeros(0, np.int64))


class PlainEncoder(Encoder):
    """Remembers the ids of chunks between white space; special tokens in a text are ordinary text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__(path)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True


class Pair:
    """Both tokenizers, the bytes of their tokens, and where their input may be cut."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece

        self.encoder = PlainEncoder(a_path)
        self.a = self.encoder.tokenizer
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        letters = {c: b for b, c in byte_letters().items()}
        size = self.a.get_vocab_size(with_added_tokens=True)
        names = [self.a.id_to_token(i) or "" for i in range(size)]
        self.a_bytes = [bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode() for t in names]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(m[1], 16)]) if (m := BYTE_PIECE.fullmatch(p)) else p.replace(MARK, " ").encode() for p in pieces
        ]
        #: Characters that stand side by side in some piece, with the mark as the space it is.
        self.joined = {p[i : i + 2] for p in (p.replace(MARK, " ") for p in pieces) for i in range(len(p) - 1)}
        self.a_sizes = np.array([len(t) for t in self.a_bytes], np.int64)
        self.b_sizes = np.array([len(t) for t in self.b_bytes], np.int64)

    def a_cut(self, text: str, start: int) -> int:
        found = A_CUT.search(text, start)
        return found.start() if found else len(text)

    def b_cut(self, text: str, start: int) -> int:
        for i in range(max(start, 1), len(text)):
            # B puts a space before its input: the cut is before a space, or the space stays apart.
            if text[i - 1 : i + 1] not in self.joined and (text[i] == " " or " " + text[i] not in self.joined):
                return i
        return len(text)

    def a_encode(self, texts: list[str]) -> list[list[int]]:
        return [ids.tolist() for ids in self.encoder.encode(texts)]

    def b_encode(self, texts: list[str]) -> list[list[int]]:
        """Tokens of texts that begin with a space, which B adds itself, or with a character that no
        piece has behind a space: then the token of the added space is taken off."""
        found = self.b.encode([t[1:] if t[:1] == " " else t for t in texts], num_threads=1)
        alone = [self.b.piece_to_id(MARK)]  # B adds nothing to nothing
        return [alone if t == " " else ids if t[:1] == " " else ids[1:] for t, ids in zip(texts, found, strict=True)]


@functools.cache
def pair(a_path: str, b_path: str) -> Pair:
    """One per Python worker."""
    return Pair(a_path, b_path)


def ranges(both: Pair, text: str, size: int) -> list[tuple[int, str, int, str]]:
    """(first byte of A, A's part, first byte of B, B's part) of each range of a text with its space."""
    if len(text) <= size:
        return [(0, text, 0, text)]
    nominal = range(size, len(text), size)
    a = sorted({0, len(text), *(both.a_cut(text, k) for k in nominal)})
    b = sorted({0, len(text), *(both.b_cut(text, k) for k in nominal)})
    count = max(len(a), len(b)) - 1
    a, b = [x + [len(text)] * (count + 1 - len(x)) for x in (a, b)]
    out, a_at, b_at = [], 0, 0
    for k in range(count):
        parts = text[a[k] : a[k + 1]], text[b[k] : b[k + 1]]
        out.append((a_at, parts[0], b_at, parts[1]))
        a_at += len(parts[0].encode())
        b_at += len(parts[1].encode())
    return out


# Groups, links and digests of many closed stretches at once.


@functools.cache
def _digits(size: int) -> tuple[np.ndarray, np.ndarray]:
    """(digits left-aligned in rows with a free place behind, number of digits) of 0 to size - 1."""
    lengths = np.array([len(str(i)) for i in range(size)], np.int64)
    rows = np.array([str(i) for i in range(size)], f"S{lengths[-1] + 1}")
    return rows.view(np.uint8).reshape(size, -1), lengths


def _decimals(ids: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, ends): every id in decimal, followed by its mark."""
    table, lengths = _digits(1 << int(ids.max()).bit_length())
    rows, sizes = table[ids], lengths[ids]
    rows[np.arange(len(ids)), sizes] = marks
    return rows[np.arange(rows.shape[1]) <= sizes[:, None]], np.cumsum(sizes + 1)


def closed(a: Tokens, b: Tokens) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """(groups as text, ends of the groups in it, their byte offsets, links as offset, A id, B id).

    The stretch begins at a common border and ends with a common end.
    """
    if not len(a):
        return b"", np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((3, 0), np.int64)
    # Both lists of ends merged; an end that both have stands there twice and is a border.
    ends = np.concatenate([a.ends, b.ends])
    order = np.argsort(ends, kind="stable")
    merged = ends[order]
    again = np.append(False, merged[1:] == merged[:-1])
    border = np.append(again[1:], False)
    group = np.empty(len(ends), np.int64)
    group[order] = np.cumsum(border) - (border | again)
    side = np.repeat([0, 1], [len(a), len(b)])
    last = np.zeros(len(ends), bool)
    last[order] = border | again
    marks = np.where(last, np.where(side == 0, ord("|"), ord(";")), ord(",")).astype(np.uint8)
    placed = np.argsort(group * 2 + side, kind="stable")
    text, text_ends = _decimals(np.concatenate([a.ids, b.ids])[placed], marks[placed])
    first = np.flatnonzero(~again)
    before = np.cumsum(side[order] == 0) - (side[order] == 0)
    links = np.stack([merged[first], a.ids[before[first]], b.ids[first - before[first]]])
    return text.tobytes(), text_ends[(last & (side == 1))[placed]], merged[border], links


def _in(x: np.ndarray, sorted_y: np.ndarray) -> np.ndarray:
    if not len(sorted_y):
        return np.zeros(len(x), bool)
    return sorted_y[np.minimum(np.searchsorted(sorted_y, x), len(sorted_y) - 1)] == x


def counted(codes: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    if times is None:
        return np.unique(codes, return_counts=True)
    kinds, place = np.unique(codes, return_inverse=True)
    return kinds, np.bincount(place, times, len(kinds)).astype(np.int64)


@dataclass
class Fragment:
    """What a byte range knows: open tokens on both sides, and the sums of what is closed between.

    Without a common end (`cut` false) all tokens are in `a_head` and `b_head`.
    """

    valid: bool
    cut: bool
    a_head: Tokens
    b_head: Tokens
    a_tail: Tokens
    b_tail: Tokens
    groups: bytes = b""
    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    codes: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    times: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    @staticmethod
    def of(a: Tokens, b: Tokens, at_border: bool, valid: bool = True) -> Fragment:
        """The fragment of tokens; `at_border` says that they begin at a common border."""
        common = a.ends[_in(a.ends, b.ends)]
        if not len(common) and not at_border:
            return Fragment(valid, False, a, b, Tokens.none(), Tokens.none())
        if not len(common):
            return Fragment(valid, True, Tokens.none(), Tokens.none(), a, b)
        first = 0 if at_border else int(common[0])
        (a_head, a_rest), (b_head, b_rest) = (t.upto(first) if not at_border else (Tokens.none(), t) for t in (a, b))
        (a_mid, a_tail), (b_mid, b_tail) = (t.upto(int(common[-1])) for t in (a_rest, b_rest))
        groups, _, borders, links = closed(a_mid, b_mid)
        return Fragment(
            valid, True, a_head, b_head, a_tail, b_tail, groups, len(a_mid), len(b_mid), len(borders),
            *counted(links[1] << 32 | links[2]),
        )

    def __mul__(self, right: Fragment) -> Fragment:
        """This fragment and the one behind it as one."""
        left_a, left_b = (self.a_tail, self.b_tail) if self.cut else (self.a_head, self.b_head)
        mid = Fragment.of(left_a + right.a_head, left_b + right.b_head, self.cut)
        a_tail, b_tail = (right.a_tail, right.b_tail) if right.cut else (mid.a_tail, mid.b_tail)
        parts = (self, mid, right)
        return Fragment(
            self.valid and right.valid,
            mid.cut,
            *((self.a_head, self.b_head) if self.cut else (mid.a_head, mid.b_head)),
            a_tail, b_tail,
            b"".join(p.groups for p in parts),
            *(sum(getattr(p, name) for p in parts) for name in ("n_a", "n_b", "n_groups")),
            *counted(np.concatenate([p.codes for p in parts]), np.concatenate([p.times for p in parts])),
        )


FRAGMENT = (
    "row long, chunk long, valid boolean, cut boolean, a_head binary, b_head binary, a_tail binary, b_tail binary, "
    "groups binary, n_a long, n_b long, n_groups long, codes array<long>, times array<long>"
)
ALIGNED = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, codes array<long>, times array<long>"


def _fragment_table(row: list, chunk: list, found: list[Fragment]) -> pa.Table:
    opens = ["a_head", "b_head", "a_tail", "b_tail"]
    columns: dict = {"row": pa.array(row, pa.int64()), "chunk": pa.array(chunk, pa.int64())}
    columns |= {name: pa.array([getattr(f, name) for f in found], pa.bool_()) for name in ("valid", "cut")}
    columns |= {name: pa.array([getattr(f, name).packed() for f in found], pa.binary()) for name in opens}
    columns["groups"] = pa.array([f.groups for f in found], pa.binary())
    columns |= {name: pa.array([getattr(f, name) for f in found], pa.int64()) for name in ("n_a", "n_b", "n_groups")}
    columns |= {name: pa.array([getattr(f, name) for f in found], pa.list_(pa.int64())) for name in ("codes", "times")}
    return pa.table(columns)


def _fragments(table: pa.Table) -> Iterator[tuple[int, int, Fragment]]:
    for r in table.to_pylist():
        heads = [Tokens.unpacked(r[name]) for name in ("a_head", "b_head", "a_tail", "b_tail")]
        codes, times = np.array(r["codes"], np.int64), np.array(r["times"], np.int64)
        yield r["row"], r["chunk"], Fragment(
            r["valid"], r["cut"], *heads, r["groups"], r["n_a"], r["n_b"], r["n_groups"], codes, times
        )


def _spelled(ids: list[int], names: list[bytes], text: str) -> bool:
    return b"".join([names[i] for i in ids]) == text.encode()


def _flat(ids: list[list[int]], sizes: np.ndarray) -> Tokens:
    flat = np.fromiter(chain.from_iterable(ids), np.int64, sum(map(len, ids)))
    return Tokens(flat, np.cumsum(sizes[flat]))


def align_texts(both: Pair, texts: list[str]) -> dict[str, pa.Array]:
    """The ALIGNED columns of whole texts, all at once; empty texts have no tokens."""
    spaced = [" " + t for t in texts]
    found = [both.a_encode(spaced), both.b_encode(spaced)]
    good = [
        bool(t) and _spelled(a, both.a_bytes, s) and _spelled(b, both.b_bytes, s)
        for t, s, a, b in zip(texts, spaced, *found, strict=True)
    ]
    ids = [[own if ok else [] for own, ok in zip(side, good, strict=True)] for side in found]
    a, b = _flat(ids[0], both.a_sizes), _flat(ids[1], both.b_sizes)
    groups, ends, borders, links = closed(a, b)
    sizes = np.array([len(s.encode()) if ok else 0 for s, ok in zip(spaced, good, strict=True)], np.int64)
    upto = np.concatenate([[0], np.cumsum(sizes)])
    group_at = np.searchsorted(borders, upto, side="right")
    text_at = np.concatenate([[0], ends])[group_at]
    document = np.searchsorted(upto[1:], links[0])
    # Ids fit 24 bits each; the document is put before them for one sort of the batch.
    kinds, times = counted(document << 48 | links[1] << 24 | links[2])
    bounds = np.searchsorted(kinds >> 48, np.arange(len(texts) + 1)).astype(np.int32)
    codes = (kinds >> 24 & 0xFFFFFF) << 32 | kinds & 0xFFFFFF
    sha = [hashlib.sha256(groups[x : y - 1]).hexdigest() if y > x else "" for x, y in zip(text_at[:-1], text_at[1:], strict=True)]
    return {
        "n_a": pa.array([len(x) for x in ids[0]], pa.int64()),
        "n_b": pa.array([len(x) for x in ids[1]], pa.int64()),
        "n_groups": pa.array(np.diff(group_at).astype(np.int64)),
        "n_links": pa.array(np.bincount(document, minlength=len(texts)).astype(np.int64)),
        "groups_sha256": pa.array(sha, pa.string()),
        "codes": pa.ListArray.from_arrays(pa.array(bounds), pa.array(codes)),
        "times": pa.ListArray.from_arrays(pa.array(bounds), pa.array(times)),
    }


def _short(docs: DataFrame, kind: str, a_path: str, b_path: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = pair(a_path, b_path)
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text").to_pylist()
            at = 0
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and size < BATCH_BYTES:
                    size += len(texts[end]) + 1
                    end += 1
                columns = {"doc_id": ids.slice(at, end - at)} | align_texts(both, texts[at:end])
                yield pa.RecordBatch.from_pydict(columns)
                at = end

    return docs.mapInArrow(run, f"doc_id {kind}, {ALIGNED}")


def _long(docs: DataFrame, kind: str, a_path: str, b_path: str, size: int) -> DataFrame:
    """Long texts: ranges, fragments, and their joins level by level."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = pair(a_path, b_path)
        for batch in batches:
            for row, text in zip(batch.column("row").to_pylist(), batch.column("text"), strict=True):
                parts = ranges(both, " " + text.as_py(), size)
                for k in range(0, len(parts), 64):
                    some = parts[k : k + 64]
                    columns = [[row] * len(some), list(range(k, k + len(some))), *map(list, zip(*some, strict=True))]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["row", "chunk", "a_at", "a", "b_at", "b"]
                    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = pair(a_path, b_path)
        for batch in batches:
            for at in range(0, batch.num_rows, 32):
                some = batch.slice(at, 32)
                row, chunk, a_at, a, b_at, b = (some.column(k).to_pylist() for k in range(6))
                found = []
                for k, (a_ids, b_ids) in enumerate(zip(both.a_encode(a), both.b_encode(b), strict=True)):
                    valid = _spelled(a_ids, both.a_bytes, a[k]) and _spelled(b_ids, both.b_bytes, b[k])
                    tokens = [_flat([x], s) for x, s in ((a_ids, both.a_sizes), (b_ids, both.b_sizes))]
                    for side, start in zip(tokens, (a_at[k], b_at[k]), strict=True):
                        side.ends = side.ends + start
                    none = Tokens.none()
                    found.append(
                        Fragment.of(*tokens, chunk[k] == 0) if valid else Fragment(False, False, none, none, none, none)
                    )
                yield from _fragment_table(row, chunk, found).to_batches()

    def join(table: pa.Table) -> pa.Table:
        parts = sorted(_fragments(table), key=lambda p: p[1])
        whole = functools.reduce(lambda x, y: x * y, (p[2] for p in parts))
        return _fragment_table([parts[0][0]], [parts[0][1] // FAN], [whole])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, _, f in _fragments(pa.Table.from_batches([batch])):
                ok = f.valid
                text = f.groups[:-1] if ok else b""
                values = [
                    row, f.n_a, f.n_b, f.n_groups, int(f.times.sum()),
                    hashlib.sha256(text).hexdigest() if ok else "", f.codes, f.times,
                ]
                empty = [row, 0, 0, 0, 0, "", f.codes[:0], f.times[:0]]
                names = ["row", *[c.split()[0] for c in ALIGNED.split(", ")]]
                yield pa.RecordBatch.from_pydict({n: pa.array([v]) for n, v in zip(names, values if ok else empty, strict=True)})

    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string()]
    numbered = saved(docs.withColumn("row", F.monotonically_increasing_id()), "align-long")
    pieces = numbered.select("row", "text").mapInArrow(cut, "row long, chunk long, a_at long, a string, b_at long, b string")
    spread = pieces.repartition(F.col("row"), F.col("chunk"))
    level = saved(spread.mapInArrow(encode, FRAGMENT), "align-fragments")
    last = level.agg(F.max("chunk")).first()[0] or 0
    while last:
        grouped = level.withColumn("_up", F.floor(F.col("chunk") / FAN)).groupBy("row", "_up")
        level = saved(grouped.applyInArrow(lambda t: join(t.drop_columns(["_up"])), FRAGMENT), "align-fragments")
        last //= FAN
    whole = level.mapInArrow(finish, f"row long, {ALIGNED}")
    return numbered.select("row", "doc_id").join(whole, "row").drop("row")


def aligned(docs: DataFrame, a_path: str, b_path: str, text: str = "text", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(doc_id, ALIGNED) of every row; `codes` holds linked id pairs (A id * 2^32 + B id), `times` how often."""
    rows = docs.select("doc_id", F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    kind = dict(docs.dtypes)["doc_id"]
    long_ = F.octet_length("text") > chunk_bytes
    short = _short(rows.filter(~long_), kind, a_path, b_path)
    if rows.filter(long_).limit(1).count() == 0:
        return short
    return short.unionByName(_long(rows.filter(long_), kind, a_path, b_path, chunk_bytes))


def align(docs: DataFrame, a_path: str, b_path: str, text: str = "text", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row."""
    numbered = aligned(docs, a_path, b_path, text, chunk_bytes).withColumn("row", F.monotonically_increasing_id())
    rows = saved(numbered, "aligned")
    pairs = F.arrays_zip(F.col("codes").alias("code"), F.col("times").alias("k"))
    counts = saved(rows.select(F.inline(pairs).alias("code", "k")).groupBy("code").agg(F.sum("k").alias("n")), "align-pairs")
    piece = F.col("code").bitwiseAND((1 << 32) - 1)
    best = counts.groupBy(piece.alias("b")).agg(F.max("n").alias("top"))
    ranked = counts.withColumn("b", piece).join(with_broadcast(best), "b")
    ranked = saved(ranked.select("code", "n", (F.col("n") == F.col("top")).alias("is_best")), "align-ranked")
    keys = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    links = rows.select("row", F.inline(pairs).alias("code", "k")).join(with_broadcast(ranked), "code")
    sums = links.groupBy("row").agg(
        F.sum(F.when(F.col("is_best"), F.col("k")).otherwise(0)).alias("n_best"),
        F.sum(F.col("k") * F.col("n")).alias("count_sum"),
    )
    out = rows.select(*keys).join(sums, "row", "left").fillna(0, ["n_best", "count_sum"])
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@query("op12_token_alignment")
def op12_token_alignment(spark, sf_dir):
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return align(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
