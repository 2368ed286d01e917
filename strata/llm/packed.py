"""Moving many 64-bit keys through one shuffle as packed arrays.

A task that holds millions of (key, owner) pairs sends one row for each buffer of them and part of
the key space, with the keys and owners as binary columns, instead of a row for each pair. Parts are
ranges of hashed keys, so they are even whatever the keys are, and their number follows the input.

A buffer is filled from many slices of input before it is cut (``buffered``), and is cut into COARSE
parts at most; beyond that ``spread`` sends it to coarse parts first and cuts those again. A row so
holds BUFFER_BYTES / COARSE on average at any size of the input, not less as parts become more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import stored_bytes
from strata.llm.tokens import mix

#: Stored bytes of text for each part; its keys and owners then fit in a task many times over.
PART_BYTES = 8 << 20
#: Bytes of arrays that a task gathers before it sends them; parts that one buffer is cut into at most.
BUFFER_BYTES, COARSE = 48 << 20, 1024
_AGAIN = np.uint64(0xD6E8FEB86659FD93)


def part_count(docs: DataFrame) -> int:
    """Parts for the keys of ``docs`` (text, ...), from the size of the files behind it.

    A frame that is not read from files has no such size; there the text's bytes are summed.
    """
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    size = stored_bytes(docs)
    if size >= 1 << 60:
        size = (docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // 2
    return max(min(least, 64), -(-size // PART_BYTES))


def parts_of(keys: np.ndarray, n: int) -> np.ndarray:
    """The part of each 64-bit key: the range, of n even ones, that its hash is in.

    Keys are hashed again: those that callers pick as least hashes are not spread evenly.
    """
    return ((mix(keys ^ _AGAIN) >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def packed(keys: np.ndarray, n: int, *columns: np.ndarray) -> Iterator[tuple[int, bytes, list[bytes]]]:
    """(part, keys, columns as bytes) of every part that has keys."""
    part = parts_of(keys, n)
    order = np.argsort(part.astype(np.uint16) if n < 1 << 16 else part, kind="stable")
    bounds = np.searchsorted(part[order], np.arange(n + 1))
    keys, columns = keys[order], [c[order] for c in columns]
    for p in np.flatnonzero(np.diff(bounds)):
        at = slice(bounds[p], bounds[p + 1])
        yield int(p), keys[at].tobytes(), [c[at].tobytes() for c in columns]


def joined(column: list[pa.Array], dtype) -> np.ndarray:
    """All values of binary columns, one after another."""
    cells = [c for a in column for c in a.to_pylist() if c]
    return np.frombuffer(b"".join(cells), dtype) if cells else np.zeros(0, dtype)


def buffered(arrays: Iterator[tuple[np.ndarray, ...]]) -> Iterator[tuple[np.ndarray, ...]]:
    """Consecutive tuples of parallel arrays joined until they hold about BUFFER_BYTES."""
    held: list[tuple[np.ndarray, ...]] = []
    size = 0
    for a in arrays:
        held.append(a)
        size += sum(x.nbytes for x in a)
        if size >= BUFFER_BYTES:
            yield tuple(map(np.concatenate, zip(*held, strict=True)))
            held, size = [], 0
    if size:
        yield tuple(map(np.concatenate, zip(*held, strict=True)))


def rows_of(keys: np.ndarray, n_parts: int, columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    """Rows (part, keys, columns...) of a buffer, one a coarse part."""
    rows = list(packed(keys, min(n_parts, COARSE), *columns.values()))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([r[0] for r in rows], pa.int32()),
            pa.array([r[1] for r in rows], pa.binary()),
            *(pa.array([r[2][i] for r in rows], pa.binary()) for i in range(len(columns))),
        ],
        ["part", "keys", *columns],
    )


def spread(rows: DataFrame, n_parts: int, kinds: dict[str, type]) -> DataFrame:
    """Rows of ``rows_of`` dealt so that a key's are in one of about ``n_parts`` tasks; kinds: dtypes of the columns.

    With more parts than COARSE, coarse parts are cut into theirs by a task each, and dealt again.
    """
    kinds = {"keys": np.uint64} | kinds
    dealt = rows.select("part", *kinds).repartition(min(n_parts, COARSE), "part")
    if n_parts <= COARSE:
        return dealt

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def arrays():
            for b in batches:
                for i in range(b.num_rows):
                    yield tuple(joined([b.column(c).slice(i, 1)], t) for c, t in kinds.items())

        for keys, *columns in buffered(arrays()):
            rows = list(packed(keys, n_parts, *columns))
            for at in range(0, len(rows), 4096):
                some = rows[at : at + 4096]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r[0] for r in some], pa.int32()),
                        pa.array([r[1] for r in some], pa.binary()),
                        *(pa.array([r[2][i] for r in some], pa.binary()) for i in range(len(columns))),
                    ],
                    ["part", *kinds],
                )

    schema = "part int, " + ", ".join(f"{c} binary" for c in kinds)
    return dealt.mapInArrow(cut, schema).repartition(n_parts, "part")


def gathered(batches: Iterator[pa.RecordBatch], kinds: dict[str, type]) -> list[np.ndarray]:
    """Each column's values over all rows of a task, in parallel arrays."""
    cells: dict[str, list] = {c: [] for c in kinds}
    for b in batches:
        for c in kinds:
            cells[c].append(b.column(c))
    return [joined(cells[c], t) for c, t in kinds.items()]
