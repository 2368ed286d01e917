"""WARC fixity audit: Merkle trees over ordered records of replicas, descended only where they differ.

Pages become WARC/1.1 response records, laid out in files by ranges of page_id; a record's offset is
the sum of the lengths before it in its file. A leaf hashes page_id, length and the SHA-256 of the
record's bytes. Inner nodes hash the ordered hashes of the nodes below, each over a fixed range of
page_id (hence an ordered offset range): FANOUT leaves, FANOUT**2, and the file, whose hash is its
root. ``audit`` compares roots of two replicas and joins the next level only inside files and nodes
that differ, so a sound replica costs one comparison a file.

All work is native. The bytes are hashed where they are read; only (file, page_id, length, digest)
is shuffled. Files and nodes are bounded by id ranges, whatever the hosts or sizes of pages, and rows
that are byte for byte the same are combined first.

Defined results: null url or html count as empty. A null page_id gets a negative one from its
contents. Rows with one page_id and several contents are ordered by digest and all belong to the
leaf; equal rows count as copies and the record is written that often. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import store, table

FANOUT = 8
#: A WARC file holds the records of FANOUT ** LEVELS successive page ids.
LEVELS = 3


def record(page_id: Column, url: Column, html: Column) -> Column:
    """The WARC response record of a page, as text."""
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"),
        page_id.cast("string"),
        F.lit(">\r\nWARC-Target-URI: "),
        url,
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(html).cast("string"),
        F.lit("\r\n\r\n"),
        html,
        F.lit("\r\n\r\n"),
    )


def leaves(pages: DataFrame) -> DataFrame:
    """A stored row for each page id and file: place, length and hash of its record(s)."""
    url, html = F.coalesce("url", F.lit("")), F.coalesce("html", F.lit(""))
    page = F.coalesce(F.col("page_id"), -1 - F.pmod(F.xxhash64(url, html), F.lit(1 << 40)))
    rows = (
        pages.select(page.alias("page_id"), url.alias("url"), html.alias("html"))
        .select("page_id", record(F.col("page_id"), F.col("url"), F.col("html")).alias("record"))
        .select("page_id", F.octet_length("record").cast("long").alias("length"), F.sha2("record", 256).alias("digest"))
        .groupBy("page_id", "length", "digest")
        .agg(F.count("*").alias("copies"))
    )
    one = rows.groupBy("page_id").agg(
        F.sum(F.col("length") * F.col("copies")).alias("length"),
        F.sort_array(F.collect_list(F.struct("digest", "copies"))).alias("records"),
    )
    span = FANOUT**LEVELS
    one = one.select(
        F.floor(F.col("page_id") / span).cast("long").alias("file_id"),
        "page_id",
        "length",
        F.sha2(
            F.concat_ws(
                "|",
                F.col("page_id").cast("string"),
                F.col("length").cast("string"),
                F.array_join(F.transform("records", lambda r: F.concat_ws("*", r["digest"], r["copies"])), ","),
            ),
            256,
        ).alias("hash"),
    )
    before = Window.partitionBy("file_id").orderBy("page_id").rowsBetween(Window.unboundedPreceding, -1)
    return store(one.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long")), "warc-leaves")


def parents(nodes: DataFrame, level: int) -> DataFrame:
    """Nodes of ``level`` from those of the level below: ordered hashes hashed, offset ranges joined."""
    node = F.floor(F.col("page_id") / FANOUT**level).cast("long") if level == 1 else F.floor(F.col("node") / FANOUT).cast("long")
    order = "page_id" if level == 1 else "node"
    return (
        nodes.groupBy("file_id", node.alias("_up"))
        .agg(
            F.sha2(
                F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(order, "hash"))), lambda x: x["hash"]), ""), 256
            ).alias("hash"),
            F.min("offset").alias("offset"),
            F.sum("length").alias("length"),
        )
        .withColumnRenamed("_up", "node")
    )


def tree(leaf: DataFrame) -> list[DataFrame]:
    """[leaves, level 1, ..., roots]; every level is keyed by (file_id, node)."""
    levels = [leaf]
    for k in range(1, LEVELS + 1):
        levels.append(parents(levels[-1], k))
    return levels


def _differing(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    cols = ["file_id", key, "hash", "offset", "length"]
    return (
        a.select(*cols)
        .withColumnsRenamed({c: f"a_{c}" for c in cols[2:]})
        .join(b.select(*cols).withColumnsRenamed({c: f"b_{c}" for c in cols[2:]}), ["file_id", key], "full_outer")
        .where(~F.col("a_hash").eqNullSafe(F.col("b_hash")))
    )


def audit(left: DataFrame, right: DataFrame) -> DataFrame:
    """The records in which two replicas (pages) differ: where, how, and the nodes passed on the way down."""
    a, b = tree(leaves(left)), tree(leaves(right))
    bad = _differing(a[LEVELS], b[LEVELS], "node").select("file_id", "node")
    for k in range(LEVELS - 1, -1, -1):
        key = "page_id" if k == 0 else "node"
        inside = bad.withColumnRenamed("node", "_above")
        below = lambda t: t.withColumn("_above", F.floor(F.col(key) / FANOUT).cast("long")).join(
            inside, ["file_id", "_above"], "left_semi"
        )
        found = _differing(below(a[k]), below(b[k]), key)
        if k:
            bad = store(found.select("file_id", "node"), f"warc-level{k}")
    return found.select(
        "file_id",
        "page_id",
        F.when(F.col("b_hash").isNull(), "missing").when(F.col("a_hash").isNull(), "extra").otherwise("altered").alias("status"),
        F.col("a_offset").alias("offset"),
        F.col("a_length").alias("length"),
        F.col("b_offset").alias("replica_offset"),
        F.col("b_length").alias("replica_length"),
    )


def damaged(pages: DataFrame) -> DataFrame:
    """A second replica with known damage, made from ``pages`` by rule.

    By page_id modulo 211: 3 loses its last character, 50 has its first "<" turned into "(", 101 is
    missing, and 160 has a twin with page_id below zero.
    """
    kind = F.pmod(F.col("page_id"), F.lit(211))
    html = (
        F.when(kind == 3, F.expr("left(html, char_length(html) - 1)"))
        .when(kind == 50, F.regexp_replace("html", "^([^<]*)<", "$1("))
        .otherwise(F.col("html"))
    )
    kept = pages.where(~F.coalesce(kind == 101, F.lit(False))).select("page_id", "url", html.alias("html"))
    twin = pages.where(kind == 160).select((-1 - F.col("page_id")).alias("page_id"), "url", "html")
    return kept.unionByName(twin)


def op2_warc_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return audit(pages, damaged(pages))


OP2_SQL = r"""
WITH a AS (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html FROM pages),
b AS (
  SELECT page_id, url, CASE WHEN page_id % 211 = 3 THEN substr(html, 1, length(html) - 1)
      WHEN page_id % 211 = 50 AND strpos(html, '<') > 0
        THEN substr(html, 1, strpos(html, '<') - 1) || '(' || substr(html, strpos(html, '<') + 1)
      ELSE html END AS html
  FROM a WHERE page_id % 211 <> 101
  UNION ALL SELECT -1 - page_id, url, html FROM a WHERE page_id % 211 = 160
), r AS (
  SELECT 'a' AS replica, * FROM a UNION ALL SELECT 'b', * FROM b
), s AS (
  SELECT replica, floor(page_id / 512.0)::BIGINT AS file_id, page_id, sha256(url || chr(10) || html) AS digest,
    strlen('WARC/1.1..WARC-Type: response..WARC-Record-ID: <urn:page:' || page_id || '>..WARC-Target-URI: ' || url
      || '..Content-Type: text/html..Content-Length: ' || strlen(html) || '....' || html || '....') AS length
  FROM r
), o AS (
  SELECT *, sum(length) OVER (PARTITION BY replica, file_id ORDER BY page_id) - length AS "offset" FROM s
)
SELECT coalesce(x.file_id, y.file_id) AS file_id, coalesce(x.page_id, y.page_id) AS page_id,
  CASE WHEN y.digest IS NULL THEN 'missing' WHEN x.digest IS NULL THEN 'extra' ELSE 'altered' END AS status,
  x."offset"::BIGINT AS "offset", x.length::BIGINT AS length,
  y."offset"::BIGINT AS replica_offset, y.length::BIGINT AS replica_length
FROM (SELECT * FROM o WHERE replica = 'a') x FULL JOIN (SELECT * FROM o WHERE replica = 'b') y ON x.page_id = y.page_id
WHERE x.digest IS DISTINCT FROM y.digest
"""
