"""Benchmark decontamination: size-partitioned MinHash containment search, verified on whole sets.

Items are sets of 5-word shingles of letters and digits (A-Z lower-cased, everything else ASCII cuts
words). A document holds an item if at least PERCENT of the item's shingles are in the document,
wherever they stand in it.

Items are partitioned by the size of their sets, in powers of two. An item's MinHash sketch is its k
least shingle hashes; k is what an item of its size may lack, and EXTRA more. A document's sketch for a
partition is all of its hashes up to the partition's threshold, the greatest hash in a sketch there.
Sketches of one hash order stay comparable between a short item and a document of any length: what
an item has among its k least hashes and the document has at all is in the document's sketch. The
share of the sketch that is found estimates the containment, and a held item has at least k less
what it may lack of it, so a pair with fewer is no candidate and no item that is held is missed: the recall of
the search is 1 in every partition, scattered shingles and items of one shingle included. Partitions
of large items look at a fifth of a document's hashes; those of the smallest at nearly all.
Candidates are then counted on whole sets.

Every row of documents is searched, in one pass and without a shuffle. The items are the stated query
set: they go to the tasks in blocks of about ITEM_BYTES of text, one pass over the documents for each,
so what is sent is bounded whatever the size of the benchmark. With more than one block, a block's
results are stored before the next is collected, and the driver holds one at a time.

Defined results: null and empty documents and items hold nothing and are held by nothing. A text of
fewer than five words is one shingle, its whole sequence, and meets only a text of just these words.
Repeated rows of documents give repeated rows; items with one text are all reported. Empty tables
give no row; other columns pass through ``drop_leaks``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import slices, store, table
from strata.llm.tokens import NOT_ALNUM, Words, distinct, owners, shingles

WORDS, PERCENT = 5, 80
ITEM_BYTES = 8 << 20
#: Hashes of a sketch beyond what an item may lack; so many of them a held item shares at least.
EXTRA = 3
#: Entries of lists, or shingles of items, that are looked at together.
CHUNK = 1 << 20


def _runs(first: np.ndarray, many: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... (many[0] of them), then the same for the next."""
    return np.repeat(first - (np.cumsum(many) - many), many) + np.arange(many.sum())


def _chunks(many: np.ndarray) -> Iterator[slice]:
    """Slices of ``many`` that sum to about CHUNK (one element at least)."""
    total, at = np.cumsum(many), 0
    while at < len(many):
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + CHUNK, "right")))
        yield slice(at, to)
        at = to


@dataclass(frozen=True)
class Partition:
    """The sketches of the items of one size class, by hash."""

    #: The greatest hash of a sketch; a document's sketch has no greater one.
    threshold: np.uint64
    #: Ascending hashes; the items with hashes[v] in their sketch are lists[first[v] : first[v + 1]].
    hashes: np.ndarray
    first: np.ndarray
    lists: np.ndarray


@dataclass(frozen=True)
class Items:
    """A block of the benchmark: ids, distinct shingles with bounds, and partitions of sketches."""

    ids: list
    bounds: np.ndarray
    #: The shingles of all items in ascending order, and the place in it of each item's shingles.
    vocabulary: np.ndarray
    places: np.ndarray
    #: Hashes of its sketch that each item shares at least with a document that holds it.
    need: np.ndarray
    partitions: list[Partition]

    @staticmethod
    def of(ids: list, texts: list[str | None]) -> Items:
        values, bounds = distinct(*shingles(Words(pa.array(texts, pa.string()), breaks=NOT_ALNUM), WORDS))
        vocabulary, places = np.unique(values, return_inverse=True)
        n, own = np.diff(bounds), owners(bounds)
        lacks = n - -(-n * PERCENT // 100)
        k = np.minimum(n, lacks + EXTRA)
        order = np.lexsort((values, own))
        rank = np.arange(len(values)) - np.repeat(bounds[:-1], n)
        sketch = order[rank < np.repeat(k, n)]
        size_class = np.frexp(n)[1][own[sketch]]  # 1, 2-3, 4-7, 8-15, ...
        partitions = []
        for c in np.unique(size_class):
            part = sketch[size_class == c]
            part = part[np.argsort(values[part], kind="stable")]
            hashes, first = np.unique(values[part], return_index=True)
            partitions.append(Partition(hashes[-1], hashes, np.append(first, len(part)), own[part]))
        return Items(ids, bounds, vocabulary, places, k - lacks, partitions)

    def candidates(self, values: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(text, item) pairs whose sketches share what a held item shares at least; values: hashes of the texts own."""
        out = [np.zeros(0, np.int64)]
        for p in self.partitions:
            at = np.flatnonzero(values <= p.threshold)
            v = np.searchsorted(p.hashes, values[at])
            hit = p.hashes[v] == values[at]
            text, v = np.divmod(np.unique(own[at[hit]] * len(p.hashes) + v[hit]), len(p.hashes))
            many = p.first[v + 1] - p.first[v]
            pairs, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
            for c in _chunks(many):
                item = p.lists[_runs(p.first[v[c]], many[c])]
                new, n = np.unique(np.repeat(text[c], many[c]) * len(self.ids) + item, return_counts=True)
                # Texts come in order: all but the last text's pairs of a chunk are complete.
                pairs, at = np.unique(np.concatenate([pairs, new]), return_inverse=True)
                counts = np.bincount(at, np.concatenate([counts, n]), len(pairs)).astype(np.int64)
                whole = pairs < text[c][-1] * len(self.ids)
                enough = counts >= self.need[pairs % len(self.ids)]
                out.append(pairs[whole & enough])
                pairs, counts = pairs[~whole], counts[~whole]
            out.append(pairs[counts >= self.need[pairs % len(self.ids)]])
        return np.divmod(np.unique(np.concatenate(out)), max(1, len(self.ids)))

    def held(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, item, shared shingles) of every item held by a text, counted on whole sets."""
        values, bounds = shingles(Words(column, breaks=NOT_ALNUM), WORDS)
        size = len(self.vocabulary)
        if not len(values) or not size:
            return (np.zeros(0, np.int64),) * 3
        text, item = self.candidates(values, owners(bounds))
        if not len(text):
            return (np.zeros(0, np.int64),) * 3
        some = np.zeros(len(bounds), bool)  # whole sets of the texts that have a candidate
        some[text] = True
        mine = np.flatnonzero(np.repeat(some[:-1], np.diff(bounds)))
        at = np.minimum(np.searchsorted(self.vocabulary, values[mine]), size - 1)
        hit = self.vocabulary[at] == values[mine]
        have = np.unique((np.searchsorted(bounds, mine[hit], "right") - 1) * size + at[hit])
        n = np.diff(self.bounds)[item]
        shared = np.zeros(len(item), np.int64)
        for c in _chunks(n):
            probe = np.repeat(text[c], n[c]) * size + self.places[_runs(self.bounds[item[c]], n[c])]
            there = have[np.minimum(np.searchsorted(have, probe), len(have) - 1)] == probe
            shared[c] = np.add.reduceat(there, np.cumsum(n[c]) - n[c], dtype=np.int64)
        good = 100 * shared >= PERCENT * n
        return text[good], item[good], shared[good]


def item_blocks(items: DataFrame) -> tuple[int, Iterator[Items]]:
    """The query set (item_id, text) in blocks of about ITEM_BYTES of text: how many, and one after another."""
    items = items.select("item_id", "text")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // ITEM_BYTES)

    def blocks() -> Iterator[Items]:
        for i in range(n):
            rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i).collect()
            yield Items.of([r["item_id"] for r in rows], [r["text"] for r in rows])

    return n, blocks()


def find_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, item_shingles, shared) of every item that a document holds."""
    schema = "doc_id long, item_id long, item_shingles long, shared long"
    out = docs.sparkSession.createDataFrame([], schema)
    n, blocks = item_blocks(items)
    for block in blocks:

        def run(batches: Iterator[pa.RecordBatch], block: Items = block) -> Iterator[pa.RecordBatch]:
            sizes = np.diff(block.bounds)
            for b in slices(batches, "text"):
                text, item, shared = block.held(b.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column("doc_id").take(pa.array(text)),
                        pa.array([block.ids[i] for i in item], pa.int64()),
                        pa.array(sizes[item].astype(np.int64)),
                        pa.array(shared),
                    ],
                    ["doc_id", "item_id", "item_shingles", "shared"],
                )

        found = docs.select("doc_id", "text").mapInArrow(run, schema)
        out = out.unionByName(found if n == 1 else store(found, "leaks"))
    return out


def drop_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item."""
    n, blocks = item_blocks(items)
    for block in blocks:

        def run(batches: Iterator[pa.RecordBatch], block: Items = block) -> Iterator[pa.RecordBatch]:
            for b in slices(batches, "text"):
                clean = np.ones(b.num_rows, bool)
                clean[block.held(b.column("text"))[0]] = False
                yield b.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
        docs = docs if n == 1 else store(docs, "without-leaks")
    return docs


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP4_SQL = r"""
WITH t AS (
  SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark
), w AS (
  SELECT kind, id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM t
), s AS (
  SELECT DISTINCT kind, id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))
                                        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] END) AS shingle FROM w
), n AS (
  SELECT id, count(*) AS n FROM s WHERE kind = 'b' GROUP BY id
), h AS (
  SELECT d.id AS doc_id, b.id AS item_id, count(*) AS shared
  FROM s d JOIN s b ON d.shingle = b.shingle AND d.kind = 'd' AND b.kind = 'b' GROUP BY d.id, b.id
)
SELECT doc_id, item_id, n AS item_shingles, shared FROM h JOIN n ON n.id = h.item_id WHERE 100 * shared >= 80 * n
"""
