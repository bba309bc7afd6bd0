"""SentencePiece encoding and decoding on a relational lattice.

A text (with the leading space the model asks for) is cut into units before its runs of spaces and
between characters of different families; a family holds the characters that pieces of the table
chain together (letters, signs), and one that no piece joins to another stands alone (digits). Units
of over LONG characters are cut between all neighbours that stand together inside no piece. No piece
reaches over such cuts, so the best path of a text is the best paths of its units.
Distinct units are numbered, exploded into substrings no longer than the longest piece and
joined with the piece table; the edges of a unit are grouped by its number, sorted by their ends, and
a Viterbi fold keeps the best score and edge for every place. A character without a piece is spelled
in UTF-8 bytes. What is still longer than LONG (one letter or spaces over and over) is folded place by
place where its slice answers. The unit's ids then go back to the bundles of documents that asked.

Piece scores: the model file holds merge ranks; a piece of rank r gets -log(r + 1), so a path of few
frequent pieces wins. (The ranks themselves, summed, would prefer many short pieces.) Paths are the
best of this lattice, not the merges of the library; decoding gives the text back exactly.

Defined results: null and empty texts have no ids and decode to an empty text. Ties go to the longer
last piece. Rows that repeat are encoded row by row; rows of one doc_id, or of none, are dealt by
their text. A table with pieces that hold a space behind another character is an error. Ids that are no pieces decode to nothing.
"""

from __future__ import annotations

import math
import re
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starling.llm.common import text_bytes, tidy, tidy_pair
from starling.llm.exchange import pack_counts, packed, text_schema, unpack_counts, unpacked
from starling.llm.registry import query

#: Characters of a unit that the relational lattice takes; its rows carry their unit.
LONG = 1024
#: UTF-8 bytes of a bundle, compression of its texts, distinct units of a slice.
BUNDLE_BYTES = 6 << 20
TEXT_LEVEL = 3
SLICE_UNITS = 100_000
LATTICE_UNITS = 30_000
MARK = "▁"


class Layout:
    def __init__(self, docs: DataFrame):
        size = text_bytes(docs)
        self.bundles = max(1, math.ceil(size / BUNDLE_BYTES))
        units = size // 160  # a guess that only sizes partitions
        self.slices = max(1, math.ceil(units / SLICE_UNITS))
        self.parts = max(8, math.ceil(units / LATTICE_UNITS))


def piece_table(spark: SparkSession, model: str) -> tuple[DataFrame, list[bytes | int | None], int]:
    """(pieces as (piece, id, score), what each id stands for, the id of byte 0).

    The table is as large as the vocabulary file, whatever the input.
    """
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=model)
    rows, meaning, byte_zero = [], [], 0
    for i in range(processor.get_piece_size()):
        piece = processor.id_to_piece(i)
        if processor.is_byte(i):
            value = int(piece[3:5], 16)
            byte_zero = i - value
            meaning.append(bytes([value]))
        elif processor.is_control(i) or processor.is_unknown(i) or processor.is_unused(i):
            meaning.append(None)
        else:
            text = piece.replace(MARK, " ")
            rank = -processor.get_score(i)
            # Pieces that the file rules out of merging (a mark score) are ranked by their id.
            rows.append((text, i, -math.log(1.0 + (rank if 0 <= rank < 1e8 else i))))
            meaning.append(text.encode())
    return spark.createDataFrame(rows, "piece string, id int, score double"), meaning, byte_zero


def unit_pattern(pieces: Iterable[str]) -> re.Pattern:
    """Finds the units of a text; as long as the alphabet of the table."""
    family: dict[str, set[str]] = {}
    for piece in pieces:
        for left, right in zip(piece, piece[1:], strict=False):
            if right == " " and left != " ":
                raise ValueError(f"piece {piece!r} holds a space behind another character")
            if left == " ":
                continue
            one, other = family.setdefault(left, {left}), family.setdefault(right, {right})
            if one is not other:
                one |= other
                family.update(dict.fromkeys(other, one))
    found = sorted({id(f): f for f in family.values()}.values(), key=lambda f: (-len(f), min(f)))
    runs = [f" *[{''.join(map(re.escape, sorted(f)))}]+" for f in found]
    return re.compile("|".join([*runs, " *[^ ]", " +"]))


def best_paths(units: DataFrame, pieces: DataFrame, longest: int, byte_zero: int, worst: float) -> DataFrame:
    """(number, ids) of `units` (number, unit), numbers distinct; every step stays in the partition of the number."""
    size, start, end = F.char_length("unit"), F.col("start"), F.col("end")
    spans = (
        units.select("number", "unit", F.explode(F.sequence(F.lit(0), size - 1)).alias("start"))
        .select("number", "unit", "start", F.explode(F.sequence(start + 1, F.least(size, start + longest))).alias("end"))
        .select("number", "start", "end", F.substring(F.col("unit"), start + 1, end - start).alias("piece"))
    )
    edges = spans.join(F.broadcast(pieces), "piece", "left").filter(
        F.col("id").isNotNull() | (end == start + 1)
    )
    # A character without a piece costs more than any piece, byte by byte.
    cost = F.coalesce("score", F.octet_length("piece") * F.lit(worst - 10.0))
    spelled = F.when(F.col("id").isNull(), F.col("piece"))
    grouped = edges.groupBy("number").agg(
        F.sort_array(
            F.collect_list(F.struct("end", "start", cost.alias("score"), "id", spelled.alias("spelled")))
        ).alias("edges")
    )
    # The best way to every place: its score and its last edge, which a step only points at.
    kind = "struct<end:int,start:int,score:double,id:int,spelled:string>"
    origin = F.array(F.struct(F.lit(0.0).alias("score"), F.lit(None).cast(kind).alias("edge")))

    def step(best, edge):
        score = F.get(best, edge["start"])["score"] + edge["score"]
        way = F.array(F.struct(score.alias("score"), edge.alias("edge")))
        first = F.size(best) == edge["end"]
        better = score > F.element_at(best, -1)["score"]
        rest = F.slice(best, F.lit(1), F.size(best) - 1)
        return F.when(first, F.concat(best, way)).when(better, F.concat(rest, way)).otherwise(best)

    folded = grouped.select("number", F.aggregate("edges", origin, step).alias("back"))
    # Back from the end along the best edges.
    walk = F.aggregate(
        F.reverse(F.sequence(F.lit(1), F.size("back") - 1)),
        F.struct((F.size("back") - 1).alias("at"), F.array().cast(f"array<{kind}>").alias("path")),
        lambda acc, place: F.when(
            acc["at"] == place,
            F.struct(
                F.get("back", place)["edge"]["start"].alias("at"),
                F.concat(F.array(F.get("back", place)["edge"]), acc["path"]).alias("path"),
            ),
        ).otherwise(acc),
        lambda acc: acc["path"],
    )

    def ids(edge):
        code = F.hex(F.encode(edge["spelled"], "UTF-8"))
        as_bytes = F.transform(
            F.sequence(F.lit(1), F.length(code), F.lit(2)),
            lambda k: F.conv(F.substring(code, k, F.lit(2)), 16, 10).cast("int") + byte_zero,
        )
        return F.when(edge["id"].isNotNull(), F.array(edge["id"])).otherwise(as_bytes)

    return folded.select("number", walk.alias("path")).select("number", F.flatten(F.transform("path", ids)).alias("ids"))


def _pack_units(units: list[bytes]) -> bytes:
    sizes = np.array([len(u) for u in units], "<u4").tobytes()
    return zstandard.compress(len(units).to_bytes(4, "little") + sizes + b"".join(units), 3)


def _unpack_units(blob: bytes) -> list[bytes]:
    raw = zstandard.decompress(blob)
    n = int.from_bytes(raw[:4], "little")
    sizes = np.frombuffer(raw, "<u4", n, 4).astype(np.int64)
    edges = np.concatenate([[0], np.cumsum(sizes)]) + 4 + 4 * n
    return [raw[a:b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]


def _dealt(units: Iterable[str], slices: int) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(sorted units, their places by slice, where each slice begins there); both ends of the exchange deal alike."""
    names = sorted(units)
    parts = np.fromiter((zlib.crc32(name.encode()) % slices for name in names), np.int64, len(names))
    order = np.argsort(parts, kind="stable")
    return names, order, np.searchsorted(parts[order], np.arange(slices + 1))


def _apart(unit: str, joined: frozenset[str]) -> list[str]:
    """`unit` cut between neighbours that no piece holds side by side."""
    cuts = [i for i in range(1, len(unit)) if unit[i - 1 : i + 1] not in joined]
    return [unit[a:b] for a, b in zip([0, *cuts], [*cuts, len(unit)], strict=True)]


def _units(text: str | None, split, joined) -> list[str]:
    """`joined` is a broadcast of the neighbours inside pieces; read for long units only."""
    found = split(" " + text) if text else []
    if not text or len(text) < LONG or max(map(len, found)) <= LONG:
        return found
    return [part for unit in found for part in ([unit] if len(unit) <= LONG else _apart(unit, joined.value))]


def _fold(unit: str, table: dict[str, tuple[int, float]], longest: int, byte_zero: int, worst: float) -> list[int]:
    """Ids of the best path of one long unit, as `best_paths` finds them; linear in its length."""
    scores, starts, ids = array("d", [0.0]), array("q", [0]), array("q", [-1])
    for end in range(1, len(unit) + 1):
        top, begin, found = -math.inf, 0, -1
        for start in range(max(0, end - longest), end):
            known = table.get(unit[start:end])
            if known is None:
                if start < end - 1:
                    continue
                known = (-1, len(unit[start].encode()) * (worst - 10.0))
            score = scores[start] + known[1]
            if score > top:
                top, begin, found = score, start, known[0]
        scores.append(top)
        starts.append(begin)
        ids.append(found)
    out, at = [], len(unit)
    while at:
        out += [ids[at]] if ids[at] >= 0 else [byte_zero + b for b in reversed(unit[at - 1].encode())]
        at = starts[at]
    return out[::-1]


def _pack_ids(sizes: np.ndarray, ids: np.ndarray) -> bytes:
    head = pack_counts(sizes)
    return len(head).to_bytes(4, "little") + head + zstandard.compress(ids.tobytes(), 3)


def _unpack_ids(blob: bytes, kind: str) -> tuple[np.ndarray, np.ndarray]:
    end = 4 + int.from_bytes(blob[:4], "little")
    return unpack_counts(blob[4:end]).astype(np.int64), np.frombuffer(zstandard.decompress(blob[end:]), kind)


def _texts(ids: pa.ListArray, meaning: pa.Array) -> pa.Array:
    """The text of every list of ids; `meaning` ends with what other ids stand for."""
    last = len(meaning) - 1
    numbers = ids.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
    known = meaning.take(pa.array(np.where((numbers < 0) | (numbers > last), last, numbers)))
    edges = np.concatenate([[0], np.cumsum(ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
    spelled = pc.binary_join(pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), known), b"")
    return pa.array([raw.removeprefix(b" ").decode("utf-8", "replace") for raw in spelled.to_pylist()], pa.string())


def _meaning_array(meaning: list[bytes | None]) -> pa.Array:
    return pa.array([*[m or b"" for m in meaning], b""], pa.binary())


def encode(docs: DataFrame, model: str, decoded: str | None = None) -> DataFrame:
    """`doc_id, text` of every row with `ids` (array<int>).

    `decoded` names a column for the text that the ids stand for, found by the task that has them:
    a check of the round trip then needs neither a table in between nor a second Python worker.
    """
    spark = docs.sparkSession
    pieces, stands_for, byte_zero = piece_table(spark, model)
    # As large as the vocabulary file; for long units only.
    table = {r["piece"]: (r["id"], r["score"]) for r in pieces.collect()}
    longest, worst = max(map(len, table)), min(score for _, score in table.values())
    joined = spark.sparkContext.broadcast(frozenset(p[i : i + 2] for p in table for i in range(len(p) - 1)))
    scored = spark.sparkContext.broadcast(table)
    meaning = spark.sparkContext.broadcast(stands_for)
    layout = Layout(docs)
    rows = docs.select(
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(layout.bundles)).cast("int").alias("bundle"), "doc_id", "text"
    )
    split = unit_pattern(table).findall
    kind = dict(docs.dtypes)["doc_id"]
    schema_of_texts = text_schema(docs)
    slices = layout.slices
    number = "<u2" if len(stands_for) <= 1 << 16 else "<u4"

    def ordered(table: pa.Table) -> pa.Table:
        return table.sort_by([("doc_id", "ascending"), ("text", "ascending")])

    def ask(table: pa.Table) -> pa.Table:
        found: set[str] = set()
        for text in unpacked(table, schema_of_texts).column("text").to_pylist():
            found.update(_units(text, split, joined))
        names, order, begins = _dealt(found, slices)
        used = np.flatnonzero(np.diff(begins)).tolist()
        packed = [_pack_units([names[i].encode() for i in order[begins[k] : begins[k + 1]]]) for k in used]
        return pa.table(
            {
                "slice": pa.array(used, pa.int32()),
                "bundle": pa.array([table.column("bundle")[0].as_py()] * len(used), pa.int32()),
                "units": pa.array(packed, pa.binary()),
            }
        )

    def numbered(asked: pa.Table) -> list[bytes]:
        """The distinct units of a slice; a unit's number is its place here, after the slice."""
        found: set[bytes] = set()
        for blob in asked.column("units").to_pylist():
            found.update(_unpack_units(blob))
        return sorted(found)

    def distinct(asked: pa.Table) -> pa.Table:
        first = asked.column("slice")[0].as_py() << 32
        known = [(first + k, u) for k, u in enumerate(u.decode() for u in numbered(asked)) if len(u) <= LONG]
        return pa.table(
            {"number": pa.array([n for n, _ in known], pa.int64()), "unit": pa.array([u for _, u in known], pa.string())}
        )

    def reply(asked: pa.Table, known: pa.Table) -> pa.Table:
        units = numbered(asked)
        place = {unit: k for k, unit in enumerate(units)}
        at = known.column("number").to_numpy() & 0xFFFFFFFF
        column = pa.chunked_array(known.column("ids").chunks, pa.list_(pa.int32())).combine_chunks()
        column = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
        lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        sizes, begins = np.zeros(len(units), np.int64), np.zeros(len(units), np.int64)
        sizes[at], begins[at] = lengths, np.cumsum(lengths) - lengths
        flats = [column.flatten().to_numpy(zero_copy_only=False).astype(number)]
        end = len(flats[0])
        for k in np.flatnonzero(sizes == 0):  # longer than LONG
            own = np.array(_fold(units[k].decode(), scored.value, longest, byte_zero, worst), number)
            flats.append(own)
            sizes[k], begins[k] = len(own), end
            end += len(own)
        flat, blobs = np.concatenate(flats), []
        for blob in asked.column("units").to_pylist():
            at = np.fromiter(map(place.__getitem__, _unpack_units(blob)), np.int64)
            own = sizes[at]
            before = np.cumsum(own) - own
            ids = flat[np.arange(own.sum()) + np.repeat(begins[at] - before, own)]
            blobs.append(_pack_ids(own, ids))
        return pa.table(
            {"bundle": asked.column("bundle"), "slice": asked.column("slice"), "ids": pa.array(blobs, pa.binary())}
        )

    def apply(texts: pa.Table, answers: pa.Table) -> pa.Table:
        texts = ordered(unpacked(texts, schema_of_texts))
        place: dict[str, int] = defaultdict(count().__next__)  # by first sight
        find = place.__getitem__
        seen = []
        for text in texts.column("text").to_pylist():
            own = _units(text, split, joined)
            seen.append(np.fromiter(map(find, own), np.int32, len(own)))
        # The answers come by slice, in the order in which this bundle asked.
        names, order, _ = _dealt(place, slices)
        order = np.fromiter(map(find, names), np.int64, len(names))[order]
        blobs = answers.sort_by([("slice", "ascending")]).column("ids").to_pylist()
        parts = [_unpack_ids(blob, number) for blob in blobs]
        lengths = np.concatenate([np.zeros(0, np.int64), *[part[0] for part in parts]])
        flat = np.concatenate([np.zeros(0, np.int32), *[part[1].astype(np.int32) for part in parts]])
        sizes, begins = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
        sizes[order], begins[order] = lengths, np.cumsum(lengths) - lengths
        out, bounds = [], [0]
        for at in seen:
            own = sizes[at]
            before = np.cumsum(own) - own
            out.append(flat[np.arange(own.sum()) + np.repeat(begins[at] - before, own)])
            bounds.append(bounds[-1] + len(out[-1]))
        ids = pa.ListArray.from_arrays(
            pa.array(np.array(bounds, np.int32)), pa.array(np.concatenate([*out, np.zeros(0, np.int32)]))
        )
        columns = {"doc_id": texts.column("doc_id"), "text": texts.column("text"), "ids": ids}
        if decoded:
            columns[decoded] = _texts(ids, _meaning_array(meaning.value))
        return pa.table(columns)

    rows = packed(rows, TEXT_LEVEL)
    asked = rows.groupBy("bundle").applyInArrow(tidy(ask), "slice int, bundle int, units binary")
    units = asked.groupBy("slice").applyInArrow(tidy(distinct), "number long, unit string")
    paths = best_paths(units.repartition(layout.parts, "number"), pieces, longest, byte_zero, worst)
    known = paths.withColumn("slice", F.shiftright("number", 32).cast("int"))
    answers = (
        asked.groupBy("slice")
        .cogroup(known.groupBy("slice"))
        .applyInArrow(tidy_pair(reply), "bundle int, slice int, ids binary")
    )
    schema = f"doc_id {kind}, text string, ids array<int>" + (f", `{decoded}` string" if decoded else "")
    return rows.groupBy("bundle").cogroup(answers.groupBy("bundle")).applyInArrow(tidy_pair(apply), schema)


def decode(encoded: DataFrame, model: str, out: str = "decoded") -> DataFrame:
    """`encoded` with `out`: the text that `ids` stand for."""
    spark = encoded.sparkSession
    meaning = spark.sparkContext.broadcast(piece_table(spark, model)[1])
    columns = [c for c in encoded.columns if c != out]
    at = columns.index("ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _meaning_array(meaning.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, _texts(batch.column(at), table)], [*columns, out])

    schema = ", ".join(f"`{c}` {t}" for c, t in encoded.select(*columns).dtypes) + f", {out} string"
    return encoded.select(*columns).mapInArrow(run, schema)


@query("op3_sentencepiece")
def op3_sentencepiece(spark, sf_dir):
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return encode(docs, model, decoded="decoded").select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_ids"),
        "ids",
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )
