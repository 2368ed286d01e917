"""SHA-256 of stored files of any size, in chunks, on executors.

A file is read through Spark's line reader with one separator byte, so whatever storage Spark
reaches is reached, and a task holds one chunk at a time: the bytes up to the next separator. A task
that gets a whole file hashes its chunks as they come, without a shuffle. Files are therefore read
with a relation that does not cut them; where the cluster's settings cut one all the same, its chunks
meet by file, sorted by their place, and are hashed as a stream as well.

A digest takes a file's bytes in order, yet not in one task: of a file larger than ``TASK_BYTES`` the
first task leaves the state of its hash (some hundred bytes) after a block of that size, the next goes on
from there, and so on, a block of every large file at a time. Each byte is read once and no task reads
more than a block. hashlib keeps its state to itself, so these files are hashed by calls to the library
below hashlib; where that cannot be called, they are read whole like the others.

The reader drops separators and a byte order mark at the start of a file. Separators stand between
two chunks, and after the last one if the file is a byte longer than that; the length comes from the
file's metadata. Files whose name ends in the suffix of a compression codec would be unpacked and are refused.
"""

from __future__ import annotations

import ctypes
import functools
import hashlib
import struct
import uuid
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark import RDD
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_path

#: The byte that chunks end at, and the bytes of text that are hashed at a time.
SEPARATOR, UPDATE_BYTES = "\n", 1 << 20
#: Bytes of a file that one task reads; larger files go from task to task.
TASK_BYTES = 256 << 20
#: More than any file: what a relation that keeps files whole is told a partition may hold.
_WHOLE = str(1 << 45)
_MARK = b"\xef\xbb\xbf"
_PACKED = (".gz", ".bz2", ".deflate", ".snappy", ".lz4", ".zst", ".zstd")
_SCHEMA = "path string, size long, block_start long, sha256 string"


@functools.cache
def _library() -> ctypes.CDLL | None:
    """The library that hashlib calls, or None where it does not have the functions below."""
    try:
        import _hashlib

        lib = ctypes.CDLL(_hashlib.__file__)
        lib.SHA256_Init.argtypes = [ctypes.c_void_p]
        lib.SHA256_Update.argtypes = [ctypes.c_void_p, ctypes.c_char_p, ctypes.c_size_t]
        lib.SHA256_Final.argtypes = [ctypes.c_void_p, ctypes.c_void_p]
    except (ImportError, AttributeError, OSError):
        return None
    return lib


class _Sha256:
    """Like hashlib.sha256, with a ``state`` that another process can go on from."""

    #: More than the 112 bytes that the library keeps.
    STATE_BYTES = 256

    def __init__(self, data: bytes = b"", state: bytes | None = None):
        self._at = ctypes.create_string_buffer(state or b"", self.STATE_BYTES)
        if state is None:
            _library().SHA256_Init(self._at)
        self.update(data)

    def update(self, data: bytes) -> None:
        _library().SHA256_Update(self._at, data, len(data))

    def hexdigest(self) -> str:
        out = ctypes.create_string_buffer(32)
        _library().SHA256_Final(out, self._at)
        return out.raw.hex()

    @property
    def state(self) -> bytes:
        return self._at.raw


@functools.cache
def _can_pass_on() -> bool:
    """Whether a hash that goes on from a state is right here."""
    if _library() is None:
        return False
    first, second = b"a" * 100, b"b" * 100
    again = _Sha256(state=_Sha256(first).state)
    again.update(second)
    return again.hexdigest() == hashlib.sha256(first + second).hexdigest()


class _File:
    """The running hash of one file's chunks."""

    def __init__(self, path: str, size: int, start: int, whole: bool, sha256=hashlib.sha256):
        self.path, self.size, self.start, self.whole = path, size, start, whole
        self.hash, self.seen, self.chunks, self.waiting, self.waits = sha256(), 0, 0, [], 0
        # A byte order mark is missed at the end only, so files that may have one are hashed with it too.
        self.marked = None if path.endswith(".parquet") else sha256(_MARK)

    @classmethod
    def resumed(cls, path: str, size: int, state: bytes | None) -> _File:
        """The file as ``state`` has it, None: at its beginning; ``start`` is that of its last block."""
        file, n = cls(path, size, -1, True, _Sha256), _Sha256.STATE_BYTES
        if state is not None:
            file.start, file.seen, file.chunks = struct.unpack("<3q", state[:24])
            file.hash = _Sha256(state=state[24 : 24 + n])
            if file.marked:
                file.marked = _Sha256(state=state[24 + n :])
        return file

    def state(self) -> bytes:
        self.flush()
        return struct.pack("<3q", self.start, self.seen, self.chunks) + self.hash.state + (self.marked.state if self.marked else b"")

    def add(self, chunk: bytes) -> None:
        if self.chunks:
            self.waiting.append(b"\n")
        self.waiting.append(chunk)
        self.seen += len(chunk) + (self.chunks > 0)
        self.waits += len(chunk) + 1
        self.chunks += 1
        if self.waits >= UPDATE_BYTES:
            self.flush()

    def flush(self) -> None:
        data = b"".join(self.waiting)
        self.hash.update(data)
        if self.marked:
            self.marked.update(data)
        self.waiting, self.waits = [], 0

    def done(self) -> tuple[str, int, int, str | None]:
        if not self.whole:
            return self.path, self.size, self.start, None
        rest = self.size - self.seen
        use = self.hash
        if rest >= len(_MARK) and self.marked:
            use, rest = self.marked, rest - len(_MARK)
        if rest == 1 and self.chunks:
            self.waiting.append(b"\n")
            rest = 0
        if rest:
            raise ValueError(f"{self.path}: {self.seen} of {self.size} bytes were read")
        self.flush()
        return self.path, self.size, self.start, use.hexdigest()


def _hashes(in_blocks: bool):
    """Digest of each run of chunks of one file; in_blocks: a file that is not whole here gets none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, out = None, []
        for b in batches:
            cols = [b.column(c).to_pylist() for c in ("path", "size", "block_start", "block_length")]
            for path, size, start, length, chunk in zip(*cols, b.column("chunk").to_pylist(), strict=True):
                at = start if in_blocks else 0
                if file is None or file.path != path or file.start != at:
                    if file:
                        out.append(file.done())
                    file = _File(path, size, at, not in_blocks or length == size)
                if file.whole:
                    file.add(chunk)
        if file:
            out.append(file.done())
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)],
                ["path", "size", "block_start", "sha256"],
            )

    return run


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of chunks as one chunk each."""
    for b in batches:
        if b.num_rows:
            chunk = pa.array([b"\n".join(b.column("chunk").to_pylist())], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("block_start").slice(0, 1).cast(pa.int64()), chunk], ["block_start", "chunk"])


def _gone_on(states: dict[int, tuple[str, int, bytes | None]]):
    """The state after a block; ``states``: by partition (path, size, state before it)."""

    def run(part: int, rows: Iterator[Row]) -> Iterator[tuple[str, bytes]]:
        if part not in states:
            return  # not its turn
        file = _File.resumed(*states[part])
        path, before = file.path, file.start
        for start, chunk in rows:
            if start <= before:
                raise ValueError(f"{path}: block {start} came after block {before}")
            file.start = start
            file.add(bytes(chunk))
        yield path, file.state()

    return run


def _chunks(spark: SparkSession, path: str, glob: str, block: str | None = None) -> DataFrame:
    """(path, size, block_start, block_length, chunk) of the files, in a session that keeps files whole
    or has one ``block`` of so many bytes in a partition."""
    whole = spark.newSession()
    for key in ("maxPartitionBytes", "openCostInBytes"):
        whole.conf.set(f"spark.sql.files.{key}", block or _WHOLE)
    if block:
        whole.conf.unset("spark.sql.files.maxPartitionNum")
    files = whole.read.option("lineSep", SEPARATOR).option("pathGlobFilter", glob).option("recursiveFileLookup", "true").text(path)
    at = F.col("_metadata")
    return files.select(
        at["file_path"].alias("path"), at["file_size"].alias("size"), at["file_block_start"].alias("block_start"),
        at["file_block_length"].alias("block_length"), F.col("value").cast("binary").alias("chunk"),
    )


def hash_files(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    """(path, byte_size, sha256) of the files under ``path`` (a folder, a file or a glob), stored.

    Names are as in ``_metadata.file_path``. Files without bytes, or of a byte order mark alone,
    have no row: Spark reads nothing from them.
    """
    if glob.endswith(_PACKED) or path.endswith(_PACKED):
        raise ValueError(f"{glob}: packed files would be unpacked before they are hashed")
    chunks, large = _chunks(spark, path, glob), []
    if _can_pass_on():
        large = _large_files(spark, path, glob)
        chunks = chunks.where(F.col("size") <= TASK_BYTES)
    first = _stored(spark, chunks.mapInArrow(_hashes(True), _SCHEMA), "file-hashes")
    cut = first.where("sha256 IS NULL").select("path").distinct()
    found = first.where("sha256 IS NOT NULL")
    if not cut.isEmpty():
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        order = ["path", "block_start", "at"]
        again = chunks.withColumn("at", F.monotonically_increasing_id()).join(cut, "path", "left_semi")
        again = again.repartition(parts, "path").sortWithinPartitions(*order).mapInArrow(_hashes(False), _SCHEMA)
        found = found.unionByName(_stored(spark, again, "file-hashes"))
    if large:
        digests = _pass_on(_chunks(spark, path, glob, str(TASK_BYTES)), large)
        found = found.unionByName(spark.createDataFrame(digests, _SCHEMA))
    return found.select("path", F.col("size").alias("byte_size"), "sha256")


def _large_files(spark: SparkSession, path: str, glob: str) -> list[Row]:
    """(path, size) of the files that one task does not read whole; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    files = files.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"))
    return files.where(F.col("size") > TASK_BYTES).collect()


def _pass_on(chunks: DataFrame, files: list[Row]) -> list[tuple[str, int, int, str]]:
    """Digests of ``files``: a block of each at a time, their states between. The driver holds a state a file."""
    sc = chunks.sparkSession.sparkContext
    # The blocks of one file are its partitions in their order, which the tasks check.
    blocks = [chunks.where(F.col("path") == f.path).mapInArrow(_joined, "block_start long, chunk binary").rdd for f in files]
    counts = [b.getNumPartitions() for b in blocks]
    starts = [0, *accumulate(counts)][:-1]
    union, states = sc.union(blocks), dict.fromkeys(f.path for f in files)
    for turn in range(max(counts)):
        parts = {at + turn: (f.path, f.size, states[f.path]) for f, at, n in zip(files, starts, counts, strict=True) if turn < n}
        states |= _after(union, parts)
    return [_File.resumed(f.path, f.size, states[f.path]).done() for f in files]


def _after(blocks: RDD, states: dict[int, tuple[str, int, bytes | None]]) -> dict[str, bytes]:
    """The states of files after one block each, by path; only these partitions are read."""
    return dict(blocks.context.runJob(blocks.mapPartitionsWithIndex(_gone_on(states)), list, [*states]))


def _stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df``, one row a file, written to the shared folder and read by ``spark``."""
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
