"""Bundles of texts: rows of some megabytes that stay together over the passes of a job.

What a pass learns about a key (a window, a context, a word) is sent once for each bundle that holds it, sorted and
packed, to the task that answers for the key's range; answers come back to the bundle. So a key that a third of all
documents share is one entry for each bundle, no table of keys is held whole anywhere, and documents are never
exchanged but as their bundle's compressed text.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from searchlift.llm.hashing import text_bytes
from searchlift.llm.tables import small_batches, stored

#: Rows of a bundle, at most; a text longer than its bytes is a bundle of its own.
BUNDLE_ROWS = 1 << 14
_GROUP_BYTES = 16 << 20
_LEVEL = 3
_SCHEMA = "bundle long, ids array<long>, flags array<boolean>, sizes array<long>, body binary, n_bytes long, n_flagged long"
#: What a pass over bundles reads.
COLUMNS = ("bundle", "ids", "flags", "sizes", "body")


def _bundler(most: int):
    def bundle_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32  # fixed once the bundles are written
        held, rows, size = [], 0, 0

        def bundle() -> pa.RecordBatch:
            ids, flags = (pa.concat_arrays([part[k] for part in held]) for k in (0, 1))
            ends = pa.array([0, len(ids)], pa.int32())
            sizes = np.concatenate([np.diff(at) for _, _, _, at in held])
            body = pa.Codec("zstd", compression_level=_LEVEL).compress(b"".join(data.tobytes() for _, _, data, _ in held), asbytes=True)
            flagged = int(np.sum(flags.to_numpy(zero_copy_only=False)))
            columns = [
                pa.array([number]), pa.ListArray.from_arrays(ends, ids), pa.ListArray.from_arrays(ends, flags), pa.array([sizes], pa.list_(pa.int64())),
                pa.array([body], pa.binary()), pa.array([size]), pa.array([flagged]),
            ]
            return pa.RecordBatch.from_arrays(columns, names=["bundle", "ids", "flags", "sizes", "body", "n_bytes", "n_flagged"])

        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            first = 0
            while first < batch.num_rows:
                room = np.searchsorted(offsets, offsets[first] + most - size, side="left")
                last = int(min(max(room, first + 1), first + BUNDLE_ROWS - rows, batch.num_rows))
                ids, flags = (batch.column(name).slice(first, last - first) for name in ("doc_id", "flag"))
                held.append((ids, flags, data[offsets[first] : offsets[last]], offsets[first : last + 1]))
                rows, size, first = rows + last - first, size + int(offsets[last] - offsets[first]), last
                if size >= most or rows >= BUNDLE_ROWS:
                    yield bundle()
                    number, held, rows, size = number + 1, [], 0, 0
        if held:
            yield bundle()

    return bundle_up


def packed_rows(df: DataFrame, label: str, by: tuple[str, ...] = ()) -> DataFrame:
    """A stored table of few large rows, in small row groups: a writer and a reader hold one whole."""
    return stored(df, label, by, {"parquet.block.size": str(_GROUP_BYTES), "compression": "zstd"})


def bundled(docs: DataFrame, size: int) -> DataFrame:
    """`docs(doc_id, text, flag)` as stored bundles of about so many bytes; a null text is an empty one."""
    rows = small_batches(docs.select("doc_id", "text", "flag")).mapInArrow(_bundler(size), _SCHEMA)
    return packed_rows(rows, "bundles")


class Bundle(NamedTuple):
    row: dict
    ids: np.ndarray
    known: np.ndarray  # whether a document has an id
    flags: np.ndarray
    data: np.ndarray
    offsets: np.ndarray


def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[Bundle]:
    """The bundles of a pass, one at a time; `row` holds the columns that were joined to them."""
    for batch in batches:
        for k in range(batch.num_rows):
            row = {name: batch.column(name)[k] for name in batch.schema.names}
            ids = row["ids"].values
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            offsets = np.r_[0, np.cumsum(row["sizes"].values.to_numpy())]
            body = pa.decompress(row["body"].as_buffer(), decompressed_size=int(offsets[-1]), codec="zstd", asbytes=True) if offsets[-1] else b""
            flags = row["flags"].values.to_numpy(zero_copy_only=False)
            yield Bundle(row, ids.fill_null(0).to_numpy().astype(np.int64), known, flags, np.frombuffer(body, np.uint8), offsets)


def planes(numbers: np.ndarray, kind: str) -> bytes:
    """Numbers as planes of their bytes, which shuffle files compress well where high bytes agree."""
    return numbers.astype(kind).view(np.uint8).reshape(len(numbers), -1).T.tobytes()


def from_planes(body: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(body, np.uint8).reshape(np.dtype(kind).itemsize, -1).T.copy().view(kind).ravel()


def steps(rising: np.ndarray, kind: str = "<u4") -> bytes:
    """Rising numbers by their differences."""
    return planes(np.diff(rising, prepend=np.uint64(0)), kind)


def from_steps(body: bytes, kind: str = "<u4") -> np.ndarray:
    return np.cumsum(from_planes(body, kind), dtype=np.uint64)


def slices(parts: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(part, first, end) of each run of a rising array of part numbers."""
    cuts = np.flatnonzero(np.r_[True, parts[1:] != parts[:-1]][: len(parts)])
    for first, end in zip(cuts, np.r_[cuts, len(parts)][1:], strict=True):
        yield int(parts[first]), int(first), int(end)


def columns_of(rows: list[tuple], kinds: dict[str, pa.DataType]) -> list[pa.Array]:
    """Rows as columns of these kinds, also without any row."""
    columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
    return [pa.array(list(c), kind) for c, kind in zip(columns, kinds.values(), strict=True)]


def table_of(rows: list[tuple], kinds: dict[str, pa.DataType]) -> pa.Table:
    return pa.Table.from_arrays(columns_of(rows, kinds), names=list(kinds))


def batch_of(rows: list[tuple], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(columns_of(rows, kinds), names=list(kinds))
