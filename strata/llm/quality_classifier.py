"""Compression classifier: two zstandard dictionaries, one of good and one of bad labelled text.

A text is cut into pieces of PIECE bytes and every piece is compressed with both dictionaries. The
normalised difference of the sums, (bad - good) / (bad + good), says which dictionary knows the text
better; a logistic curve fitted on labelled texts that the dictionaries have not seen turns it into
a score from 0 to 1.

Learning reads a bounded sample of labelled rows: at most SAMPLE_ROWS of each label, those with the
smallest hash of doc_id and text. Every second one is for the dictionaries: its whole text is cut into
pieces by the tasks, and the DICT_PIECES pieces with the smallest hash of row and place, from
anywhere in the texts, come to the driver. The others are for the curve: the tasks compress their whole
texts and only the differences come back. Scoring reads every byte of every text where it lies; there
is no shuffle, and the model (two dictionaries of DICT_BYTES and two numbers) goes to the tasks
with the function.

Defined results: null and empty texts get the curve's value at a difference of 0. Labels with null
doc_id or quality are not learnt from, nor are doc_ids that are labelled both ways. If a label has too few rows for a dictionary, the model knows
nothing and every score is the share of label 1 (0.5 without labels). Repeated rows get equal scores;
other columns pass through ``score_quality``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import slices, store, table
from strata.llm.tokens import mix, utf8

PIECE, LEVEL, DICT_BYTES = 1024, 3, 16 << 10
SAMPLE_ROWS, DICT_PIECES = 2000, 4000


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    slope: float
    offset: float


class Differ:
    """Compresses with both dictionaries; made once a task."""

    def __init__(self, good: bytes, bad: bytes):
        def made(data: bytes) -> zstandard.ZstdCompressor:
            d = zstandard.ZstdCompressionDict(data)
            d.precompute_compress(level=LEVEL)
            return zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_dict_id=False)

        self.good, self.bad = made(good), made(bad)

    def __call__(self, data: memoryview) -> float:
        good = bad = 0
        for at in range(0, len(data), PIECE):
            piece = data[at : at + PIECE]
            good += len(self.good.compress(piece))
            bad += len(self.bad.compress(piece))
        return (bad - good) / (bad + good) if good else 0.0


def _differences(differ, column: pa.Array) -> np.ndarray:
    """The difference of each whole text."""
    buf, off = utf8(column)
    view = memoryview(np.ascontiguousarray(buf))
    return np.array([differ(view[off[i] : off[i + 1]]) for i in range(len(off) - 1)])


def _pieces(rows: DataFrame) -> list[bytes]:
    """The DICT_PIECES pieces of whole texts (o, text) with the smallest hashes; o: a number of the row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            buf, off = utf8(b.column("text"))
            at = [(i, s) for i, (s, e) in enumerate(zip(off[:-1].tolist(), off[1:].tolist(), strict=True)) for s in range(s, e, PIECE)]
            row = np.array([i for i, _ in at], np.int64)
            start = np.array([s for _, s in at], np.int64)
            o = b.column("o").to_numpy()[row] if len(row) else row
            order = mix(o.view(np.uint64) + mix((start - off[row]).astype(np.uint64))).view(np.int64) if len(row) else row
            data = [buf[s : min(s + PIECE, off[i + 1])].tobytes() for i, s in at]
            yield pa.RecordBatch.from_arrays([pa.array(order), pa.array(data, pa.binary())], ["o", "data"])

    found = rows.select("o", "text").mapInArrow(run, "o long, data binary").orderBy("o", "data").limit(DICT_PIECES)
    return [bytes(r["data"]) for r in found.collect()]


def fit_curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve by Newton's method, with a little ridge on the slope."""
    scale = x.std() or 1.0
    a = np.column_stack([x / scale, np.ones_like(x)])
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        g = a.T @ (p - y) + [1e-3 * w[0], 0]
        h = (a * (p * (1 - p))[:, None]).T @ a + np.diag([1e-3, 1e-9])
        step = np.linalg.solve(h, g)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] / scale), float(w[1])


def _sample(docs: DataFrame, known: DataFrame) -> DataFrame:
    """(label, o, text, dictionary) of the sampled rows of both labels, equal rows once; stored.

    Rows are picked by hash, without their texts; then the bounded list of hashes fetches them.
    """
    rows = []
    for label in (0, 1):
        picked = known.where(F.col("quality") == label).select("o", "doc_id").distinct().orderBy("o", "doc_id").limit(SAMPLE_ROWS).collect()
        rows += [(label, r["o"], r["doc_id"], i % 2 == 0) for i, r in enumerate(picked)]
    wanted = docs.sparkSession.createDataFrame(rows, "label int, o long, doc_id long, dictionary boolean")
    found = docs.select("doc_id", "text", _order().alias("o")).join(F.broadcast(wanted), ["o", "doc_id"])
    return store(found.dropDuplicates(["o", "doc_id"]).select("label", "o", "text", "dictionary"), "labelled")


def _order() -> Column:
    return F.xxhash64(F.col("doc_id").cast("string"), "text")


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from ``docs`` (doc_id, text) and ``labels`` (doc_id, quality; a row a doc_id).

    Pieces and differences of the sample are all that comes to the driver.
    """
    # Hashes meet the labels, not texts.
    rows = docs.where(F.col("doc_id").isNotNull()).select("doc_id", _order().alias("o"))
    known = rows.join(labels.where(F.col("quality").isin(0, 1)), "doc_id")
    share = known.agg(F.coalesce(F.avg(F.col("quality").cast("double")), F.lit(0.5)).alias("share")).first()["share"]
    share = min(max(share, 0.01), 0.99)
    base = math.log(share / (1 - share))
    sample = _sample(docs, known)
    samples = [sample.where(F.col("label") == label) for label in (0, 1)]
    try:
        bad, good = (zstandard.train_dictionary(DICT_BYTES, _pieces(s.where("dictionary"))).as_bytes() for s in samples)
    except (zstandard.ZstdError, ValueError):
        return Model(b"", b"", 0.0, base)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        differ = Differ(good, bad)
        for b in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([b.column("o"), pa.array(_differences(differ, b.column("text")), pa.float64())], ["o", "x"])

    found = [s.where("NOT dictionary").select("o", "text").mapInArrow(run, "o long, x double").orderBy("o", "x").collect() for s in samples]
    x = np.array([r["x"] for rows in found for r in rows])
    y = np.concatenate([np.full(len(rows), k, float) for k, rows in enumerate(found)])
    if not len(x):
        return Model(good, bad, 0.0, base)
    slope, offset = fit_curve(x, y)
    # The sample has its own share of label 1; the curve is moved to the share of all labelled rows.
    own = min(max(y.mean(), 0.01), 0.99)
    return Model(good, bad, slope, offset + base - math.log(own / (1 - own)))


def score_quality(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """``docs`` with ``column``: the calibrated score of each whole text."""
    keep = [c for c in docs.columns if c != column]
    schema = docs.select(*keep).schema.add(column, "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        differ = Differ(model.good, model.bad) if model.good else lambda _: 0.0
        for b in slices(batches, "text"):
            x = _differences(differ, b.column("text"))
            s = 1 / (1 + np.exp(-np.clip(model.slope * x + model.offset, -30, 30)))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(s, pa.float64())], [*keep, column])

    return docs.mapInArrow(run, schema)


def fold(doc_id: str) -> Column:
    return F.crc32(F.col(doc_id).cast("string")) % 3


def model_for(spark: SparkSession, docs: DataFrame, sf_dir: str) -> Model:
    """Learnt from the labelled ``docs`` whose crc32(doc_id) mod 3 is not 1."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality").where(fold("doc_id") != 1)
    one = labels.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
    return learn(docs.select("doc_id", "text"), one.where("quality = other").drop("other"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_quality(docs, model_for(spark, docs, sf_dir))
    return scored.select(
        "doc_id",
        F.coalesce(fold("doc_id") == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
