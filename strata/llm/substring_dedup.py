"""Substring dedup by hashing lines (paragraphs) and their sentences.

A text is cut into units at two grains: its lines, and the sentences of each line (cut after runs
of . ! ?; of a passage pasted into the middle of a line only the pieces that these marks cut out are
found, not its glued ends, its short sentences or text without such marks). A unit of at least
``min_words`` words is normalised (A-Z lower-cased, runs of white space as one space) and hashed
(MD5). Digests are grouped over all documents; the occurrence with the smallest (doc_id, start)
stays and every other one goes. Removed spans are returned as [start, end) code point offsets into
the original text, merged where units touch or one lies in the other.

The shuffles carry (digest, doc_id, start, end). A digest's first occurrence is a combined minimum,
so a passage that a third of all documents hold meets as one row a task; the join back is between
stored tables, where AQE splits hot digests. Nothing is collected but the spans of one document.

Defined results: null text counts as empty and has no unit. Rows that repeat a doc_id with the same
text are the same occurrences and keep or lose the same units; a null doc_id ranks before all.
Empty tables give no row; other columns pass through ``remove_repeats``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import attach, slices, store, table

MIN_WORDS = 8
#: Pieces of a line: up to and with a run of . ! ? and the white space after it; they concatenate to the line.
SENTENCE = re.compile(r"[^.!?]*[.!?]+[\x20\x09-\x0D]*|[^.!?]+\Z")
_SPACE = re.compile(r"[\x20\x09-\x0D]+")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_SPAN = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))


def text_units(text: str, min_words: int) -> Iterator[tuple[int, int, bytes]]:
    """(start, stop, digest) of the units of a text that have at least ``min_words`` words."""
    at, shortest = 0, 2 * min_words - 1
    for line in text.split("\n"):
        if len(line) >= shortest:
            spans = [(0, len(line))]
            sentences = [m.span() for m in SENTENCE.finditer(line)]
            if len(sentences) > 1:
                spans += sentences
            for a, b in spans:
                if b - a >= shortest:
                    normal = _SPACE.sub(" ", line[a:b]).strip(" ").translate(_LOWER)
                    if normal.count(" ") >= min_words - 1:
                        yield at + a, at + b, hashlib.md5(normal.encode(), usedforsecurity=False).digest()
        at += len(line) + 1


def units(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, digest, start, stop) of every unit that is long enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            rows = [(i, *u) for i, t in enumerate(b.column("text").to_pylist()) if t for u in text_units(t, min_words)]
            at, start, stop, digest = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("doc_id").take(pa.array(at, pa.int64())),
                    pa.array(digest, pa.binary()),
                    pa.array(start, pa.int32()),
                    pa.array(stop, pa.int32()),
                ],
                ["doc_id", "digest", "start", "stop"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, digest binary, start int, stop int")


def lost_units(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """A stored row for each document that loses something: how many units, and their spans merged in order."""
    found = store(units(docs, min_words), "units")
    first = (
        found.groupBy("digest")
        .agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "start")).alias("first"))
        .where(F.col("n") > 1)
    )
    first = store(first.select("digest", "first"), "units-first")
    lost = (
        found.join(first, "digest")
        .where(~F.struct("doc_id", "start").eqNullSafe(F.col("first")))
        .groupBy("doc_id")
        .agg(F.sort_array(F.collect_set(F.struct("start", "stop"))).alias("_lost"))
    )


    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lost = b.column("_lost").to_pylist()
            spans = [[{"start": a, "stop": z} for a, z in merged(x)] for x in lost]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([len(x) for x in lost], pa.int64()), pa.array(spans, _SPAN)], ["doc_id", "_n", "_spans"]
            )

    return store(lost.mapInArrow(run, "doc_id long, _n long, _spans array<struct<start:int,stop:int>>"), "units-lost")


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    """Sorted spans with those that touch or overlap made one."""
    out: list[tuple[int, int]] = []
    for s in spans:
        if out and s["start"] <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], s["stop"])
        else:
            out.append((s["start"], s["stop"]))
    return out


def remove_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with ``text`` without its repeated units, n_units_removed and removed (original offsets)."""
    made = ("text", "n_units_removed", "removed")
    keep = [c for c in docs.columns if c not in made]
    body = attach(docs.select(*keep, "text"), lost_units(docs, min_words), "doc_id")
    schema = docs.select(*keep, "text").schema.add("n_units_removed", "long")
    schema = schema.add("removed", T.ArrayType(T.StructType().add("start", T.IntegerType()).add("stop", T.IntegerType())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            texts, removed = [], b.column("_spans").to_pylist()
            for text, spans in zip(b.column("text").to_pylist(), removed, strict=True):
                if spans:
                    ends = [0, *(s["stop"] for s in spans)]
                    text = "".join(text[a:z] for a, z in zip(ends, [*(s["start"] for s in spans), len(text)], strict=True))
                texts.append(text or "")
            counts = pc.fill_null(b.column("_n"), 0)
            removed = [s or [] for s in removed]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in keep), pa.array(texts, pa.string()), counts, pa.array(removed, _SPAN)],
                [*keep, *made],
            )

    return body.select(*keep, "text", "_n", "_spans").mapInArrow(run, schema)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs).select(
        "doc_id",
        "n_units_removed",
        F.aggregate("removed", F.lit(0), lambda a, s: a + s["stop"] - s["start"]).cast("long").alias("n_chars_removed"),
        F.array_join(F.transform("removed", lambda s: F.concat_ws("-", s["start"], s["stop"])), ",").alias("removed"),
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"),
    )


OP5_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), o AS (
  SELECT *, sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY pos) - length(line) - 1 AS off FROM l
), p AS (
  SELECT doc_id, off, pos, line, regexp_extract_all(line, '[^.!?]*[.!?]+[\x20\x09-\x0D]*|[^.!?]+$') AS s
  FROM o WHERE length(line) >= 15
), q AS (
  SELECT doc_id, off, pos, unnest(s) AS unit, generate_subscripts(s, 1) AS i FROM p WHERE len(s) > 1
), u AS (
  SELECT doc_id, off AS start, line AS unit FROM p
  UNION ALL
  SELECT doc_id, off + sum(length(unit)) OVER (PARTITION BY doc_id, pos ORDER BY i) - length(unit), unit FROM q
), n AS (
  SELECT doc_id, start, start + length(unit) AS stop,
         trim(regexp_replace(translate(unit, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                             '[\x20\x09-\x0D]+', ' ', 'g')) AS normal FROM u
), m AS (
  SELECT *, row_number() OVER (PARTITION BY normal ORDER BY doc_id, start) AS rank
  FROM n WHERE length(normal) - length(replace(normal, ' ', '')) >= 7
), g AS (
  SELECT DISTINCT doc_id, start, stop FROM m WHERE rank > 1
), e AS (
  SELECT *, max(stop) OVER (PARTITION BY doc_id ORDER BY start, stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM g
), b AS (
  SELECT *, sum(CASE WHEN start <= reach THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY start, stop) AS island FROM e
), s AS (
  SELECT doc_id, min(start) AS start, max(stop) AS stop, count(*) AS n FROM b GROUP BY doc_id, island
), t AS (
  SELECT doc_id, start, stop, n, lag(stop, 1, 0) OVER (PARTITION BY doc_id ORDER BY start) AS before,
         row_number() OVER (PARTITION BY doc_id ORDER BY start DESC) AS back FROM s
), k AS (
  SELECT t.doc_id, sum(n)::BIGINT AS n_units_removed, sum(stop - start)::BIGINT AS n_chars_removed,
         string_agg(start || '-' || stop, ',' ORDER BY start) AS removed,
         string_agg(substr(text, (before + 1)::BIGINT, (start - before)::BIGINT)
                    || CASE WHEN back = 1 THEN substr(text, (stop + 1)::BIGINT) ELSE '' END, '' ORDER BY start) AS kept
  FROM t JOIN documents d ON d.doc_id = t.doc_id GROUP BY t.doc_id
)
SELECT d.doc_id, coalesce(n_units_removed, 0) AS n_units_removed, coalesce(n_chars_removed, 0) AS n_chars_removed,
       coalesce(removed, '') AS removed,
       sha256(CASE WHEN k.doc_id IS NULL THEN coalesce(d.text, '') ELSE k.kept END) AS kept_sha256
FROM documents d LEFT JOIN k ON k.doc_id = d.doc_id
"""
