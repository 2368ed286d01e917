"""Line dedup: drop lines that occur in many documents, keep the rest in place.

Native DataFrame work. A line's key is the line with ASCII white space stripped at both ends and
A-Z lower-cased. Keys of at least ``min_chars`` code points are hashed (MD5, 128 bit) and counted
by distinct documents; a key found in at least ``min_docs`` documents loses all its lines except in
the largest doc_id that holds it. Each text is then reassembled from its remaining lines by position.

Shuffles carry (digest, doc_id) only. The count is two combined aggregations, by (digest, document)
and then by digest, so a line that a third of all documents hold is spread over all tasks and meets
again as one row a task; the join back is between stored tables, so AQE can split a hot digest.

Defined results: null text counts as empty, an empty text is one empty line, no text gives no row.
A null doc_id is a document like another, below every other. Rows that repeat a doc_id are one
document for the count, and each row is returned with its own text. Other columns pass through;
names starting with an underscore are used inside and may be used by the input as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import attach, lower_ascii, store, table

#: Code points of a key, and documents that hold it, from which its lines go.
MIN_CHARS, MIN_DOCS = 40, 5
_STRIPPED = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(_STRIPPED)))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _digest(line: Column) -> Column:
    return F.unhex(F.md5(line_key(line)))


def frequent_keys(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> tuple[DataFrame, DataFrame]:
    """(pairs of document and digest; digests of frequent keys with the document that keeps them)."""
    long = F.filter(_lines(F.col("text")), lambda x: F.char_length(line_key(x)) >= min_chars)
    pairs = store(
        docs.select("doc_id", F.explode(F.array_distinct(F.transform(long, _digest))).alias("digest")).distinct(),
        "line-pairs",
    )
    counts = pairs.groupBy("digest").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("keeper"))
    return pairs, store(counts.where(F.col("n_docs") >= min_docs), "line-frequent")


def drop_frequent_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` (doc_id, text, ...) with ``text`` reassembled, and n_lines, n_dropped."""
    pairs, frequent = frequent_keys(docs, min_chars, min_docs)
    lost = (
        pairs.join(frequent, "digest")
        .where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
        .groupBy("doc_id")
        .agg(F.collect_set("digest").alias("_lost"))
    )
    lost = store(lost, "line-lost")
    body = attach(docs.select("doc_id", F.struct(*docs.columns).alias("_row")), lost, "doc_id")
    lines = _lines(F.col("_row.text"))
    kept = F.when(F.col("_lost").isNull(), lines).otherwise(
        F.filter(
            lines,
            lambda x: ~((F.char_length(line_key(x)) >= min_chars) & F.array_contains(F.col("_lost"), _digest(x))),
        )
    )
    body = body.withColumn("_lines", lines).withColumn("_kept", kept)
    others = [F.col("_row").getField(c).alias(c) for c in docs.columns if c not in ("text", "n_lines", "n_dropped")]
    return body.select(
        *others,
        F.array_join("_kept", "\n").alias("text"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size("_kept")).cast("long").alias("n_dropped"),
    )


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_frequent_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    )


OP1_SQL = """
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), k AS (
  SELECT *, translate(trim(line, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line_key
  FROM l
), f AS (
  SELECT line_key, max(doc_id) AS keeper FROM k WHERE length(line_key) >= 40
  GROUP BY line_key HAVING count(DISTINCT doc_id) >= 5
), j AS (
  SELECT k.doc_id, k.pos, k.line, (f.line_key IS NOT NULL AND k.doc_id <> f.keeper) AS gone
  FROM k LEFT JOIN f ON k.line_key = f.line_key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""
