"""Filter interaction audit: what each filter removes, alone and in every order of the filters.

Each document becomes a mask with one bit for each filter it fails. Four filters look at one text;
the fifth, exact duplicates, is found with radix tries. Texts are range-partitioned by adaptive
prefixes: prefixes of LEVELS[0] code points are weighed over the whole table, those heavier than a
partition are cut at the next length, and so on, so that a header that many texts share does not
make one range. Each partition inserts its full texts into a compressed trie whose terminals hold
the least doc_id and the number of documents, and a traversal returns the texts found twice or more.
Equal texts of one batch go in as one, so copies of one text, however many, are one entry a batch.

Masks are reduced to at most 2**k counts a part before anything is combined. What a filter removes
depends only on the set of filters before it, so orders are read off the k * 2**(k-1) pairs of a
filter and a set; its Shapley value is the sum of its removals over all orders.

Defined results: null text is empty, null part the empty string, an empty table gives no row. A null
doc_id is neither smaller than another nor has one smaller, so it is no duplicate and makes none;
rows that repeat doc_id and text are not smaller either. A document is good (toxic) if any label row
of its doc_id says so. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import attach, slices, store, table
from strata.llm.tokens import Words, distinct

#: Filters in the order of their bits: few words, few distinct words, many capitals, symbols, copy.
FILTERS = "ABCDE"
MIN_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 200, 50, 2
#: Lengths in code points at which prefixes are weighed; text of one partition in bytes.
LEVELS = (8, 64, 512, 4096)
PART_BYTES = 32 << 20

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#$%&*|"]] = True
_CAPITAL = np.zeros(256, bool)
_CAPITAL[ord("A") : ord("Z") + 1] = True


# --- Filters of one text


def text_masks(column: pa.Array) -> np.ndarray:
    """The bits of the filters A to D for each text."""
    words = Words(column, lower=False)
    off, n = words.offsets, words.counts()

    def total(marks: np.ndarray) -> np.ndarray:
        t = np.concatenate(([0], np.cumsum(marks)))
        return t[off[1:]] - t[off[:-1]]

    few = n < MIN_WORDS
    same = 100 * np.diff(distinct(words.hashes, words.first)[1]) < DISTINCT_PERCENT * n
    loud = 100 * total(_CAPITAL[words.bytes]) > CAPITAL_PERCENT * total((words.bytes & 0xC0) != 0x80)
    return few + 2 * same + 4 * loud + 8 * (total(_SYMBOL[words.bytes]) > 0)


def _facts(docs: DataFrame) -> DataFrame:
    """(digest, doc_id, part, mask) of every document, without its text; filters A to D."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            mask = pa.array(text_masks(b.column("text")).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("digest", "doc_id", "part")), mask], ["digest", "doc_id", "part", "mask"])

    rows = docs.select(F.unhex(F.md5("text")).alias("digest"), "doc_id", "part", "text")
    return rows.mapInArrow(run, "digest binary, doc_id long, part string, mask int")


# --- Tries


class Trie:
    """A compressed radix trie of byte strings; a node is [label, children by first byte, least id, entries]."""

    def __init__(self):
        self.root = [b"", {}, None, 0]

    def insert(self, text: bytes, least: int | None, entries: int) -> None:
        node, at = self.root, 0
        while at < len(text):
            child = node[1].get(text[at])
            if child is None:
                child = node[1][text[at]] = [text[at:], {}, None, 0]
            elif not text.startswith(child[0], at):
                child = self._split(node, child, text, at)
            at += len(child[0])
            node = child
        if least is not None:
            node[2] = least if node[2] is None else min(node[2], least)
        node[3] += entries

    @staticmethod
    def _split(node: list, child: list, text: bytes, at: int) -> list:
        """Cut the edge to ``child`` where the text leaves it; the node made there."""
        label, low, high = child[0], 1, len(child[0])
        while low + 1 < high:  # the first ``low`` bytes agree, the first ``high`` do not
            middle = (low + high) // 2
            if text.startswith(label[low:middle], at + low):
                low = middle
            else:
                high = middle
        top = node[1][label[0]] = [label[:low], {label[low]: child}, None, 0]
        child[0] = label[low:]
        return top

    def repeated(self) -> Iterator[tuple[bytes, int]]:
        """(MD5 of a text, least id) of the terminals with two entries or more and an id."""
        stack = [(self.root, hashlib.md5())]
        while stack:
            node, digest = stack.pop()
            if node[0]:
                digest = digest.copy()
                digest.update(node[0])
            if node[3] > 1 and node[2] is not None:
                yield digest.digest(), node[2]
            stack.extend((c, digest) for c in node[1].values())


def _collapsed(docs: DataFrame) -> DataFrame:
    """(text, least, entries): the documents of an Arrow batch with one text are one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = pa.Table.from_batches([b]).group_by("text").aggregate([("doc_id", "min"), ([], "count_all")])
            yield from rows.select(["text", "doc_id_min", "count_all"]).rename_columns(["text", "least", "entries"]).combine_chunks().to_batches()

    return docs.select("doc_id", "text").mapInArrow(run, "text string, least long, entries long")


def adaptive_prefix(rows: DataFrame, most: int) -> tuple[Column, Column]:
    """Range keys of ``text``: its shortest prefix that weighs at most ``most`` bytes, and a tie-break.

    A round weighs the prefixes of one length, of texts with a heavy prefix of the length before. The
    heavy ones, at most total / most of them, come to the driver as digests. Where prefixes of the
    last length are still heavy, a hash of the whole text splits them.
    """
    heavy = []
    for length in LEVELS:
        of = rows
        for shorter, found in heavy:
            of = of.where(F.md5(F.substring("text", 1, shorter)).isin(found))
        prefix = F.md5(F.substring("text", 1, length))
        weighed = of.groupBy(prefix.alias("p")).agg(F.sum(F.octet_length("text")).alias("w"), F.max(F.char_length("text")).alias("n"))
        found = [r.p for r in weighed.where((F.col("w") > most) & (F.col("n") > length)).select("p").collect()]
        if not found:
            break
        heavy.append((length, found))
    lengths = [*LEVELS, LEVELS[-1]]
    key, tie = F.substring("text", 1, lengths[len(heavy)]), F.lit(0).cast("long")
    if len(heavy) == len(LEVELS):
        tie = F.xxhash64("text")
    for at in reversed(range(len(heavy))):
        length, found = heavy[at]
        in_heavy = F.md5(F.substring("text", 1, length)).isin(found)
        key = F.when(in_heavy, key).otherwise(F.substring("text", 1, length))
        tie = F.when(in_heavy, tie).otherwise(F.lit(0).cast("long"))
    return key, tie


def duplicate_texts(docs: DataFrame) -> DataFrame:
    """(digest, least) of each text that two or more rows of ``docs`` (doc_id, text) hold, by tries."""
    rows = store(_collapsed(docs), "trie-texts")
    spark = docs.sparkSession
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), -(-total // PART_BYTES))
    key, tie = adaptive_prefix(rows, max(total // parts, 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie()
        for b in batches:
            texts = b.column("text").cast(pa.binary())
            for text, least, entries in zip(texts, b.column("least").to_pylist(), b.column("entries").to_pylist(), strict=True):
                trie.insert(text.as_py(), least, entries)
        found = list(trie.repeated())
        if found:
            digests, least = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(least, pa.int64())], ["digest", "least"])

    spread = rows.repartitionByRange(parts, key, tie)
    return store(spread.mapInArrow(run, "digest binary, least long"), "trie-duplicates")


# --- Orders


def failure_masks(docs: DataFrame) -> DataFrame:
    """(doc_id, part, mask) of ``docs`` (doc_id, text, part); all five filters."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("part", F.lit("")).alias("part"))
    facts = store(_facts(docs), "filter-facts")
    copy = F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False))
    found = attach(facts, duplicate_texts(docs), "digest")
    return found.select("doc_id", "part", (F.col("mask") + F.when(copy, 16).otherwise(0)).alias("mask"))


def interactions(masks: DataFrame, labels: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row for each part, order of the ``filters`` and step, from (doc_id, part, mask) and labels."""
    spark, k = masks.sparkSession, len(filters)
    says = labels.groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    per = masks.groupBy("doc_id", "part", "mask").agg(F.count("*").alias("n")).join(says, "doc_id", "left")
    told = lambda c: F.sum(F.col("n") * F.coalesce(c, F.lit(0)))
    per = store(per.groupBy("part", "mask").agg(F.sum("n").alias("n"), told("good").alias("good"), told("toxic").alias("toxic")), "filter-masks")

    sets = F.explode(F.sequence(F.lit(0), F.lit((1 << k) - 1)))
    pairs = per.withColumn("before", sets).withColumn("own", F.explode(F.lit([1 << i for i in range(k)])))
    pairs = pairs.where(F.col("before").bitwiseAND(F.col("own")) == 0)
    fails, hit = F.col("mask").bitwiseAND(F.col("own")) != 0, F.col("mask").bitwiseAND(F.col("before")) != 0

    def of(when: Column, what: str = "n") -> Column:
        return F.sum(F.when(when, F.col(what)).otherwise(0)).cast("long")

    pairs = pairs.groupBy("part", "own", "before").agg(
        of(~fails & ~hit).alias("kept"), of(fails & ~hit).alias("removed"), of(fails & hit).alias("redundant"),
        of(F.col("mask") == F.col("own")).alias("unique_fails"), of(fails & ~hit, "good").alias("good_lost"), of(fails & ~hit, "toxic").alias("toxic_lost"),
    )
    pairs = store(pairs, "filter-pairs")

    orders = []
    for order in permutations(range(k)):
        name, before = "".join(filters[i] for i in order), 0
        for step, i in enumerate(order, 1):
            orders.append((1 << i, before, name, step))
            before |= 1 << i
    orders = F.broadcast(spark.createDataFrame(orders, "own int, before int, filter_order string, step int"))  # k * k! rows
    times = orders.groupBy("own", "before").agg(F.count("*").alias("times"))
    shapley = pairs.join(F.broadcast(times), ["own", "before"]).groupBy("part", "own").agg(F.sum(F.col("removed") * F.col("times")).alias("shapley"))
    rows = pairs.join(shapley, ["part", "own"]).join(orders, ["own", "before"])
    return rows.select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.col("source").alias("part"))
    return interactions(failure_masks(docs), table(spark, sf_dir, "labels"))


OP13_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS part,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
), f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, [
    CASE WHEN len(w) < 200 THEN 'A' END,
    CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' END,
    CASE WHEN 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 2 * length(text) THEN 'C' END,
    CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' END,
    CASE WHEN d.doc_id > min(d.doc_id) OVER (PARTITION BY text) THEN 'E' END] AS failed
  FROM d LEFT JOIN s ON s.doc_id = d.doc_id
), m AS (
  SELECT part, list_filter(failed, lambda x: x IS NOT NULL) AS failed,
         count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
  FROM f GROUP BY ALL
), l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (
  SELECT [a.x, b.x, c.x, e.x, g.x] AS p FROM l a, l b, l c, l e, l g
  WHERE len(list_distinct([a.x, b.x, c.x, e.x, g.x])) = 5
), t AS (
  SELECT array_to_string(p, '') AS filter_order, i AS step, p[i] AS own, p[:i - 1] AS before FROM o, range(1, 6) r(i)
), r AS (
  SELECT part, filter_order, step, own,
    sum(CASE WHEN NOT list_contains(failed, own) AND NOT list_has_any(failed, before) THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN list_contains(failed, own) AND NOT list_has_any(failed, before) THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN list_contains(failed, own) AND list_has_any(failed, before) THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN failed = [own] THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN list_contains(failed, own) AND NOT list_has_any(failed, before) THEN good ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN list_contains(failed, own) AND NOT list_has_any(failed, before) THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM m, t GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, step::INT AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM r
"""
