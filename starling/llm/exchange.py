"""Ask-and-answer between bundles of documents and hash slices of what they hold.

Documents fall into bundles of a few MB by the hash of their id. A bundle sends, to each slice of a
key space, its sorted distinct keys with one small number each, packed; what repeats inside a
bundle is sent once, so a frequent key costs one entry per bundle whatever share of the rows
holds it. A slice adds up what all bundles sent and answers each one, in the order asked. The
bundle meets the answers together with its texts, which come from the same shuffle as before.
No table of all keys goes to one place or to every executor.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from starling.llm.common import text_bytes, tidy
from starling.llm.words import U64

#: UTF-8 bytes of the texts of a bundle, and entries that a slice receives, on average.
BUNDLE_BYTES = 4 << 20
SLICE_ENTRIES = 3_000_000


@dataclass
class Layout:
    """Sizes that follow from the input."""

    bundles: int
    words: int  # an upper estimate

    @classmethod
    def of(cls, docs: DataFrame, times: float = 1) -> Layout:
        """Bundles of `times` BUNDLE_BYTES."""
        size = text_bytes(docs)
        return cls(max(1, math.ceil(size / (times * BUNDLE_BYTES))), max(1024, size // 4))

    def slices(self, entries: int) -> int:
        return max(1, math.ceil(entries / SLICE_ENTRIES))


def bundled(docs: DataFrame, layout: Layout) -> DataFrame:
    """`docs` (doc_id, text, ...) with its bundle; null ids share one."""
    return docs.select(F.pmod(F.xxhash64("doc_id"), F.lit(layout.bundles)).cast("int").alias("bundle"), "*")


def packed(rows: DataFrame, level: int) -> DataFrame:
    """(bundle, texts): the rows (bundle, doc_id, text) of a bundle in one batch, compressed.

    The shuffle then moves less than the texts; `unpacked` gives the rows back.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = batch.column(0).to_numpy()
            own = batch.select(["doc_id", "text"])
            order = np.argsort(numbers, kind="stable")
            cuts = np.flatnonzero(np.diff(numbers[order])) + 1
            parts = np.split(order, cuts) if len(order) else []
            blobs = [zstandard.compress(own.take(pa.array(part)).serialize(), level) for part in parts]
            found = [int(numbers[part[0]]) for part in parts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.int32()), pa.array(blobs, pa.binary())], ["bundle", "texts"]
            )

    return rows.mapInArrow(run, "bundle int, texts binary")


def unpacked(table: pa.Table, schema: pa.Schema) -> pa.Table:
    """(doc_id, text) of the rows behind `packed` rows, in one table."""
    blobs = map(zstandard.decompress, table.column("texts").to_pylist())
    return pa.Table.from_batches([pa.ipc.read_record_batch(pa.py_buffer(blob), schema) for blob in blobs], schema)


def text_schema(docs: DataFrame) -> pa.Schema:
    """The Arrow form of (doc_id, text), as Spark hands it to Python."""
    return to_arrow_schema(docs.select("doc_id", "text").schema)


def _planes(values: np.ndarray) -> bytes:
    """Byte planes from the lowest up; upper ones are mostly zero and vanish in compression."""
    planes = values.astype(U64).view(np.uint8).reshape(-1, 8).T
    used = max([k + 1 for k in range(8) if planes[k].any()], default=1)
    return zstandard.compress(bytes([used]) + planes[:used].tobytes(), 1)


def _from_planes(data: bytes) -> np.ndarray:
    raw = zstandard.decompress(data)
    planes = np.frombuffer(raw, np.uint8, offset=1).reshape(raw[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, : raw[0]] = planes.T
    return out.view(U64).ravel()


def pack(values: np.ndarray) -> bytes:
    """Sorted unsigned numbers as the differences between neighbours."""
    values = values.astype(U64)
    return _planes(np.concatenate([values[:1], np.diff(values)]))


def unpack(data: bytes) -> np.ndarray:
    return np.cumsum(_from_planes(data), dtype=U64)


def pack_counts(values: np.ndarray) -> bytes:
    return _planes(values)


def unpack_counts(data: bytes) -> np.ndarray:
    return _from_planes(data)


def cut(keys: np.ndarray, slices: int, bits: int) -> np.ndarray:
    """Where sorted keys of `bits` bits fall into equal slices of the key space."""
    width = -(-(1 << bits) // slices)
    borders = np.array([min(k * width, (1 << bits) - 1) for k in range(1, slices)], dtype=U64)
    return np.concatenate([[0], np.searchsorted(keys, borders), [len(keys)]])


ASK = "slice int, bundle int, keys binary, extra binary"
ANSWER = "bundle int, slice int, keys binary, reply binary"


def ask_rows(bundle: int, keys: np.ndarray, extra: np.ndarray | None, slices: int, bits: int, first: int = 0):
    """Rows of ASK for sorted keys; slices are numbered from `first`."""
    edges = cut(keys, slices, bits)
    rows = ([], [], [], [])
    for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        if a < b:
            rows[0].append(first + k)
            rows[1].append(bundle)
            rows[2].append(pack(keys[a:b]))
            rows[3].append(pack_counts(extra[a:b]) if extra is not None else b"")
    return rows


def ask_table(rows) -> pa.Table:
    types = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
    return pa.table({n: pa.array(v, t) for n, v, t in zip(("slice", "bundle", "keys", "extra"), rows, types, strict=True)})


def answer(
    asked: DataFrame, reply: Callable[[list[np.ndarray], list[np.ndarray]], list[bytes]], with_keys: bool = False
) -> DataFrame:
    """Rows of ANSWER: `reply` sees all key arrays of a slice (and their numbers) and answers each."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("bundle", "ascending")])
        packed = table.column("keys").to_pylist()
        extra = [unpack_counts(x) if x else None for x in table.column("extra").to_pylist()]
        replies = reply([unpack(x) for x in packed], extra)
        return pa.table(
            {
                "bundle": table.column("bundle"),
                "slice": table.column("slice"),
                "keys": pa.array(packed if with_keys else [b""] * len(packed), pa.binary()),
                "reply": pa.array(replies, pa.binary()),
            }
        )

    return asked.groupBy("slice").applyInArrow(tidy(run), ANSWER)


def replies_of(table: pa.Table) -> list[tuple[int, bytes, bytes]]:
    """(slice, keys, reply) of one bundle, by slice."""
    rows = zip(
        table.column("slice").to_pylist(),
        table.column("keys").to_pylist(),
        table.column("reply").to_pylist(),
        strict=True,
    )
    return sorted(rows, key=lambda row: row[0])


def ordered(table: pa.Table) -> pa.Table:
    """The documents of a bundle in one fixed order, whatever order the shuffle brought them in."""
    return table.sort_by([("doc_id", "ascending"), ("text", "ascending")])
