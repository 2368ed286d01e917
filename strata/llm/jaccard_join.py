"""N-gram Jaccard join: a prefix-tree join over globally ordered shingle sets, and its components.

Sets are the distinct k-word shingles of whole texts as 64-bit hashes; sets are ordered by hash, in
step 2 rarest first. Two sets are linked when intersection * 100 >= threshold * union. The steps:

1. One pass over the texts gives every row its set size and a 128-bit set identity, so equal sets
   are one class from here on, and sends an extended prefix of every set through a packed shuffle.
   There classes go by 64 bits of the identity; a loss would take two linked classes with equal bits.
   A class's counts from all parts are packed and summed; hot shingles are counted where they are.
   With sets in one order, two linked sets share their first k common shingles within prefixes of
   size - ceil(threshold * size) + k. Classes whose prefix does not hold that many shingles of other
   classes can have no link and leave; this is exact.
2. The classes that remain bring their whole sets and count each shingle among themselves. Every
   shingle of the plain prefix (k = 1, rarest first) names the smallest class that holds it in its
   prefix, its pivot; a class joins the groups of its pivots. Linked classes share a prefix shingle,
   so they share a group.
3. Each class is compared with its pivot. Linked ones are done with each other (the pivot connects
   them). By the triangle inequality of the Jaccard distance, a class further than twice the limit
   from the pivot cannot be linked with those, and needs comparison with the others only.
4. What is left of a group is joined by prefix trees, in blocks of bounded size: one side is stored
   in a trie of ordered sets, the other traverses it. Sets under a node share their partial overlap,
   and a subtree is left as soon as overlap plus remaining length cannot reach the limit.
5. Links are classes; connected components run over them, and every row gets its component.

For the components it is enough that a block connects what its links connect. ``jaccard_links`` and the
link counts need every link once: there zone 1 is joined with zones 1 and 2 as well, and a pair that
meets in several groups counts in that of its smallest common pivot, or in step 3 if one is the other's
pivot. Counts are summed in the blocks, so a dense group sends no row for each pair.

Groups are never collected: steps 2 and 3 are joins of stored tables that AQE splits, step 4 works
on blocks. No pairs of copies are made; no link between different texts is lost.

Defined results: null and empty texts have the empty set, linked with nothing. Rows that repeat a
doc_id are rows of their own. A null doc_id is linked with nothing: null component_id, no link counted.
Empty tables give no row; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import BROADCAST_BYTES, attach, slices, store, stored_bytes, table
from strata.llm.components import components
from strata.llm.packed import buffered, gathered, joined, part_count, rows_of, spread
from strata.llm.tokens import Words, distinct, mix, owners, shingles

WORDS, PERCENT = 4, 85
#: The extended prefix must share so many percent of a set (k in step 1). A cost choice only.
EXTRA = 20
#: Sets and shingles of a trie, and of the sets that traverse it, in one task of step 4 (about).
TRIE_SETS, TRIE_TOKENS = 1024, 1 << 21
#: Classes of one shingle in one task's buffer beyond which it counts as hot; heavy shingles at most.
HOT, HEAVY = 1024, 1 << 16


def _ceil(n, percent: int):
    return -(-n * percent // 100)


def ordered_sets(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct shingles in ascending order, and the bounds."""
    values, bounds = distinct(*shingles(Words(column), k))
    own = owners(bounds)
    order = np.argsort(values)
    own = own[order]
    by_text = np.argsort(own.astype(np.uint16) if len(bounds) < 1 << 16 else own, kind="stable")
    return values[order][by_text], bounds


def identities(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums of each set's mixed hashes and size: its identity."""
    n = np.diff(bounds)
    out = []
    for salt in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F):
        total = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(mix(values + np.uint64(salt)), out=total[1:])
        out.append(mix(total[bounds[1:]] - total[bounds[:-1]] + n.astype(np.uint64) * np.uint64(salt)).view(np.int64))
    return out[0], out[1]


def _ids(h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """64 bits of both halves of the identities, for step 1 alone."""
    return mix(h1.view(np.uint64) ^ mix(h2.view(np.uint64))).view(np.int64)


def _combined(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, ...]:
    """A buffer's pairs (key, class) once each, and what is known of its hot keys already.

    A key of more than HOT classes is shared: only its least and greatest class are sent on, the
    others count it here. Returns keys and ids to send, the classes that counted and their counts.
    """
    order = np.lexsort((ids, keys))
    keys, ids = keys[order], ids[order]
    once = np.ones(len(keys), bool)
    once[1:] = (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1])
    keys, ids = keys[once], ids[once]
    start = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    size = np.diff(np.append(start, len(keys)))
    hot = size > HOT
    inner = np.repeat(hot, size)
    inner[start[hot]] = inner[start[hot] + size[hot] - 1] = False
    found, count = np.unique(ids[inner], return_counts=True)
    return keys[~inner], ids[~inner], found, count.astype(np.int64)


_TEXTS = pa.schema([(c, pa.int64()) for c in ("id", "h1", "h2", "n", "doc_id")])
_CELLS = pa.schema([("kind", pa.int32()), ("part", pa.int32()), ("keys", pa.binary()), ("cells", pa.binary())])
_COUNTED = "id long, h1 long, h2 long, n long, doc_id long, kind int, part int, keys binary, cells binary"


def _joined_schema(b: pa.RecordBatch) -> pa.RecordBatch:
    """``b``, rows of texts or of cells, with null for the columns of the other kind."""
    both = pa.schema([*_TEXTS, *_CELLS])
    return pa.RecordBatch.from_arrays([b.column(f.name) if f.name in b.schema.names else pa.nulls(b.num_rows, f.type) for f in both], schema=both)


def _cells(kind: int, keys: np.ndarray, n_parts: int, cells: np.ndarray) -> pa.RecordBatch:
    rows = rows_of(keys, n_parts, {"cells": cells})
    return pa.RecordBatch.from_arrays([pa.array(np.full(rows.num_rows, kind, np.int32)), *rows.columns], schema=_CELLS)


def _prefixes(docs: DataFrame, k: int, percent: int, extra: int, n_parts: int) -> DataFrame:
    """A row for each text: id, identity, size, doc_id. Packed rows of prefixes (kind 0: shingle, class)
    and of counts of hot shingles (kind 1: class, count)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: list[pa.RecordBatch] = []

        def arrays():
            for b in slices(batches, "text"):
                values, bounds = ordered_sets(b.column("text"), k)
                h1, h2 = identities(values, bounds)
                n, ids = np.diff(bounds), _ids(h1, h2)
                cols = [pa.array(ids), pa.array(h1), pa.array(h2), pa.array(n.astype(np.int64)), b.column("doc_id")]
                texts.append(pa.RecordBatch.from_arrays(cols, schema=_TEXTS))
                length = np.where(n > 0, n - _ceil(n, percent) + _ceil(n, extra), 0)
                _, once = np.unique(np.column_stack([h1, h2]), axis=0, return_index=True)
                length[np.setdiff1d(np.arange(len(n)), once)] = 0  # copies inside the slice bring nothing new
                length = np.minimum(length, n)
                take = np.arange(len(values)) - np.repeat(bounds[:-1], n) < np.repeat(length, n)
                yield values[take], np.repeat(ids, length)

        for keys, ids in buffered(arrays()):
            yield from map(_joined_schema, texts)
            texts.clear()
            keys, ids, found, count = _combined(keys, ids)
            yield _joined_schema(_cells(0, keys, n_parts, ids))
            if len(found):
                yield _joined_schema(_cells(1, found.view(np.uint64), n_parts, count))
        yield from map(_joined_schema, texts)

    return docs.select("doc_id", "text").mapInArrow(run, _COUNTED)


def _count_shared(n_parts: int):
    """Packed rows (class, count): how many of its prefix shingles in this part other classes have too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, ids = gathered(batches, {"keys": np.uint64, "cells": np.int64})
        if not len(keys):
            return
        order = np.lexsort((ids, keys))
        keys, ids = keys[order], ids[order]
        start = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        size = np.diff(np.append(start, len(keys)))
        mixed = np.repeat(ids[start] != ids[start + size - 1], size)
        keys, ids = keys[mixed], ids[mixed]  # shingles of two classes or more
        once = np.ones(len(ids), bool)  # a class that came from several buffers counts once
        once[1:] = (ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1])
        found, count = np.unique(ids[once], return_counts=True)
        yield rows_of(found.view(np.uint64), n_parts, {"cells": count.astype(np.int64)})

    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, shared): a class's counts from all parts as one row."""
    ids, counts = gathered(batches, {"keys": np.int64, "cells": np.int64})
    found, at = np.unique(ids, return_inverse=True)
    total = np.zeros(len(found), np.int64)
    np.add.at(total, at, counts)
    yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total)], ["id", "shared"])


def _whole_sets(docs: DataFrame, k: int) -> DataFrame:
    """(cid, n, tokens, copies) of the candidate classes; docs has (text, h1, h2, cid, copies) of their smallest documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            values, bounds = ordered_sets(b.column("text"), k)
            h1, h2 = identities(values, bounds)
            same = (h1 == b.column("h1").to_numpy(zero_copy_only=False)) & (h2 == b.column("h2").to_numpy(zero_copy_only=False))
            at = np.flatnonzero(same)
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("cid").take(pa.array(at)),
                    pa.array(np.diff(bounds)[at].astype(np.int64)),
                    pa.array([values[bounds[i] : bounds[i + 1]].tobytes() for i in at], pa.binary()),
                    b.column("copies").take(pa.array(at)),
                ],
                ["cid", "n", "tokens", "copies"],
            )

    return docs.mapInArrow(run, "cid long, n long, tokens binary, copies long")


def _buffers(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(tokens, cid of each) of stored sets, by buffers."""

    def arrays():
        for b in slices(batches, "tokens"):
            yield joined([b.column("tokens")], np.uint64), np.repeat(b.column("cid").to_numpy(), b.column("n").to_numpy())

    return buffered(arrays())


def _heavy(sets: DataFrame) -> list[int]:
    """Shingles that at least 1 / HEAVY of all shingles of the sets are copies of, ascending: at most HEAVY.

    Counted where a buffer holds more than HOT of them, which is the rule, not an estimate of one:
    what matters is that all tasks mean the same shingles.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, _ in _buffers(batches):
            found, count = np.unique(keys, return_counts=True)
            many = count > HOT
            yield pa.RecordBatch.from_arrays([pa.array(found[many].view(np.int64)), pa.array(count[many].astype(np.int64))], ["token", "n"])

    total = sets.agg(F.sum("n")).first()[0] or 0
    counts = sets.select("cid", "n", "tokens").mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    return sorted(r.token % (1 << 64) for r in counts.where(F.col("n") * HEAVY >= total).select("token").collect())


_SHARED = {"keys": np.int64, "cells": np.uint64, "counts": np.int32}


def _shared_tokens(n_parts: int):
    """Packed rows by class: the shingles of a part that two sets or more have, and how many do."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, ids = gathered(batches, {"keys": np.uint64, "cells": np.int64})
        if not len(keys):
            return
        order = np.argsort(keys)
        keys, ids = keys[order], ids[order]
        start = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        size = np.diff(np.append(start, len(keys)))
        count = np.repeat(size, size)
        some = count > 1
        yield rows_of(ids[some].view(np.uint64), n_parts, {"cells": keys[some], "counts": count[some].astype(np.int32)})

    return run


def _prefix_rows(sets: DataFrame, percent: int, n_parts: int) -> DataFrame:
    """(token, cid) of each set's plain prefix, rarest shingles first.

    Shingles that no other candidate has come first of all: they fill the prefix but join nothing,
    and a set with too few others is no candidate any more. Heavy shingles come last, by hash, and are
    counted nowhere: a shingle that a third of all sets have is not sent to one part.
    """
    heavy = np.array(_heavy(sets), np.uint64)
    last = np.iinfo(np.int32).max

    def is_heavy(keys: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(heavy, keys), len(heavy) - 1)
        return heavy[at] == keys if len(heavy) else np.zeros(len(keys), bool)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, ids in _buffers(batches):
            yield rows_of(keys[~is_heavy(keys)], n_parts, {"cells": ids[~is_heavy(keys)]})

    def pack_heavy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, ids in _buffers(batches):
            of = is_heavy(keys)
            yield rows_of(ids[of].view(np.uint64), n_parts, {"cells": keys[of], "counts": np.full(of.sum(), last, np.int32)})

    def pack_sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:  # a class's size comes as a cell with count 0
            ids, n = b.column("cid").to_numpy(), b.column("n").to_numpy()
            yield rows_of(ids.view(np.uint64), n_parts, {"cells": n.view(np.uint64), "counts": np.zeros(len(ids), np.int32)})

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, keys, counts = gathered(batches, _SHARED)
        order = np.lexsort((keys, counts, ids))
        ids, keys, counts = ids[order], keys[order], counts[order]
        start = np.flatnonzero(counts == 0)  # each class's size, its first cell
        size = np.diff(np.append(start, len(ids))) - 1
        many = np.maximum(size - _ceil(keys[start].view(np.int64), percent) + 1, 0)
        at = np.arange(many.sum()) + np.repeat(start + 1 - np.cumsum(many) + many, many)
        yield pa.RecordBatch.from_arrays([pa.array(keys[at].view(np.int64)), pa.array(ids[at])], ["token", "cid"])

    cells, shared = "part int, keys binary, cells binary", "part int, keys binary, cells binary, counts binary"
    rows = sets.select("cid", "n", "tokens")
    parts = spread(rows.mapInArrow(pack, cells), n_parts, {"cells": np.int64}).mapInArrow(_shared_tokens(n_parts), shared)
    parts = parts.unionByName(sets.select("cid", "n").mapInArrow(pack_sizes, shared))
    if len(heavy):
        parts = parts.unionByName(rows.mapInArrow(pack_heavy, shared))
    return spread(parts, n_parts, {"cells": np.uint64, "counts": np.int32}).mapInArrow(rank, "token long, cid long")


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Common members of two ascending arrays of distinct values."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a))


def _against_pivots(pairs: DataFrame, percent: int) -> DataFrame:
    """zone of each (cid, pivot): 1 linked, 2 within twice the distance, 3 beyond."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            zone = []
            for x, y in zip(b.column("tokens").to_pylist(), b.column("pivot_tokens").to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = overlap(x, y)
                union = len(x) + len(y) - both
                zone.append(1 if 100 * both >= percent * union else 2 if 100 * both >= (2 * percent - 100) * union else 3)
            yield pa.RecordBatch.from_arrays([b.column("cid"), b.column("pivot"), b.column("n"), pa.array(zone, pa.int32())], ["cid", "pivot", "n", "zone"])

    return pairs.select("cid", "pivot", "n", "tokens", "pivot_tokens").mapInArrow(run, "cid long, pivot long, n long, zone int")


class Trie:
    """Ordered sets in a path-compressed prefix tree, its nodes in arrays, level by level.

    A node's edge is the run of tokens that the sets below it share from the depth of the node above.
    A probe walks down one level at a time: the children of a node start from the overlap that its
    path has, each edge is looked at once for all sets below it, and nodes from which the remaining
    lengths cannot reach the limit are left.
    """

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.percent = percent
        # Big-endian bytes compare as the token sequences do.
        order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u8").tobytes())
        ordered = [sets[i] for i in order]
        todo, edges, made = [(0, len(ordered), 0)], [], []
        for lo, hi, depth in todo:  # grows while it is walked
            first, last = ordered[lo], ordered[hi - 1]  # the first and the last share least
            n = min(len(first), len(last))
            differ = np.flatnonzero(first[depth:n] != last[depth:n])
            to = depth + int(differ[0]) if len(differ) else n
            sizes = [len(s) for s in ordered[lo:hi]]
            ends = len(first) == to  # distinct sets: at most the first ends here
            child = len(todo)
            begin = lo + ends
            while begin < hi:
                stop = begin + 1
                while stop < hi and ordered[stop][to] == ordered[begin][to]:
                    stop += 1
                todo.append((begin, stop, to))
                begin = stop
            edges.append(first[depth:to])
            made.append((to, min(sizes), max(sizes), order[lo] if ends else -1, child, len(todo) - child))
        self.depth, self.least, self.most, self.end, self.child, self.children = np.array(made, np.int64).T
        self.size = np.array([len(e) for e in edges], np.int64)
        self.last = np.array([e[-1] if len(e) else 0 for e in edges], np.uint64)
        self.start = np.cumsum(self.size) - self.size
        self.vocabulary, self.tokens = np.unique(np.concatenate(edges), return_inverse=True)
        self.mark = np.zeros(len(self.vocabulary) + 1, np.int64)

    def linked(self, probe: np.ndarray, skip: Callable[[int], bool] = lambda _: False) -> Iterator[tuple[int, int]]:
        """(position of a set given to the trie, overlap) of every set linked with ``probe``.

        Sets for which ``skip`` holds when their turn comes are left out.
        """
        for i, both in zip(*(x.tolist() for x in self.found(probe)), strict=True):
            if not skip(i):
                yield i, both

    def found(self, probe: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions and overlaps of all sets linked with ``probe``."""
        n, p = len(probe), self.percent
        out = [np.zeros((2, 0), np.int64)]
        if not len(self.vocabulary):
            return out[0][0], out[0][1]
        at = np.minimum(np.searchsorted(self.vocabulary, probe), len(self.vocabulary) - 1)
        at = at[self.vocabulary[at] == probe]
        known = self.vocabulary[at]  # the probe's tokens that any stored set has
        self.mark[at] = 1
        node, common = np.zeros(1, np.int64), np.zeros(1, np.int64)
        while len(node):
            # Before an edge is looked at: what its path has, and at most all that is left.
            left = np.minimum(len(known) - common, self.most[node])
            able = ((common + left) * (100 + p) >= p * (n + self.least[node])) & (100 * self.most[node] >= p * n) & (p * self.least[node] <= 100 * n)
            node, common = node[able], common[able]
            common = common + self._hits(node)
            rest = np.minimum(len(known) - np.searchsorted(known, self.last[node], "right"), self.most[node] - self.depth[node])
            reach = (common + rest) * (100 + p) >= p * (n + self.least[node])
            node, common = node[reach], common[reach]
            good = np.flatnonzero((self.end[node] >= 0) & (common * (100 + p) >= p * (n + self.depth[node])))
            out.append(np.stack([self.end[node[good]], common[good]]))
            many = self.children[node]
            node, common = np.repeat(self.child[node] - np.cumsum(many) + many, many) + np.arange(many.sum()), np.repeat(common, many)
        self.mark[at] = 0
        ends, shared = np.concatenate(out, axis=1)
        return ends, shared

    def _hits(self, node: np.ndarray) -> np.ndarray:
        """Marked tokens on the edges of the nodes, and on no others."""
        size = self.size[node]
        total = np.zeros(size.sum() + 1, np.int64)
        ends = np.cumsum(size)
        np.cumsum(self.mark[self.tokens[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.start[node] - ends + size, size)]], out=total[1:])
        return total[ends] - total[ends - size]


def _trie_links(percent: int):
    """Links of a block. zone 2 meets all stored sets, zone 3 those of zones 2 and 3.

    Sets that earlier links of the block connect already are passed over: what is returned connects
    the block as all its links would.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int]] = []
        above: dict[int, int] = {}

        def root(x: int) -> int:
            while (y := above.get(x, x)) != x:
                above[x] = above.get(y, y)
                x = above[x]
            return x

        pivot = int(rows["pivot"].iloc[0])
        above |= {int(c): pivot for c in rows.loc[rows["zone"] == 1, "cid"]}
        probes = rows[~rows["stored"]]
        for near in (True, False):
            stored = rows[rows["stored"] & ((rows["zone"] == 1) == near)]
            mine = probes[probes["zone"] == 2] if near else probes
            if not len(stored) or not len(mine):
                continue
            trie = Trie([np.frombuffer(t, np.uint64) for t in stored["tokens"]], percent)
            ids = stored["cid"].tolist()
            for cid, data in zip(mine["cid"].tolist(), mine["tokens"], strict=True):
                for i, _ in trie.linked(np.frombuffer(data, np.uint64), lambda i, cid=cid: root(ids[i]) == root(cid)):
                    out.append((ids[i], cid))
                    above[root(cid)] = root(ids[i])
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    return run


def _every_link(percent: int, pairs: bool):
    """All links of a block that count in this group, each once.

    pairs: rows (a, b); else rows (a, b) that connect what these links connect, and rows (a, a, n)
    with the copies of the classes linked with a.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, int]] = []
        above: dict[int, int] = {}

        def root(x: int) -> int:
            while (y := above.get(x, x)) != x:
                above[x] = above.get(y, y)
                x = above[x]
            return x

        pivot = int(rows["pivot"].iloc[0])
        above |= {int(c): pivot for c in rows.loc[rows["zone"] == 1, "cid"]}
        count: dict[int, int] = {}
        for near in (True, False):
            stored = rows[rows["stored"] & ((rows["zone"] == 1) == near)]
            probes = rows[~rows["stored"] & (rows["zone"] < 3 if near else rows["zone"] > 1)]
            if not len(stored) or not len(probes):
                continue
            trie = Trie([np.frombuffer(t, np.uint64) for t in stored["tokens"]], percent)
            ids, copies = stored["cid"].to_numpy(), stored["copies"].to_numpy()
            total = np.zeros(len(ids), np.int64)
            # Stored sets by pivot: pairs with a smaller common pivot count there, those of a pivot in step 3.
            by_pivot: dict[int, list[int]] = {}
            for i, own in enumerate(stored["pivots"]):
                for q in own.tolist():
                    by_pivot.setdefault(q, []).append(i)
            place = {q: np.array(i) for q, i in by_pivot.items()}
            at = {c: i for i, c in enumerate(ids.tolist())}
            for cid, zone, data, many, own in zip(*(probes[c] for c in ("cid", "zone", "tokens", "copies", "pivots")), strict=True):
                # Sets of like zones meet twice, as stored and as probe.
                here = np.ones(len(ids), bool) if near and zone == 2 else ids < cid
                for q in own.tolist():
                    if q < pivot and q in place:
                        here[place[q]] = False
                    elif q in at:
                        here[at[q]] = False
                if cid in place:
                    here[place[cid]] = False
                if not here.any():
                    continue
                found, _ = trie.found(np.frombuffer(data, np.uint64))
                found = found[here[found]]
                if not len(found):
                    continue
                if pairs:
                    out += [(int(c), int(cid), 0) for c in ids[found]]
                    continue
                total[found] += many
                count[cid] = count.get(cid, 0) + int(copies[found].sum())
                for c in ids[found].tolist():
                    if root(c) != root(cid):
                        out.append((c, int(cid), 0))
                        above[root(cid)] = root(c)
            for i in np.flatnonzero(total).tolist():
                count[int(ids[i])] = count.get(int(ids[i]), 0) + int(total[i])
        out += [(c, c, n) for c, n in count.items()]
        return pd.DataFrame(out, columns=["a", "b", "n"]).astype("int64")

    return run


def _zones(sets: DataFrame, percent: int, n_parts: int) -> tuple[DataFrame, DataFrame]:
    """Stored (cid, pivot) of the groups, and (cid, pivot, n, zone)."""
    rows = store(_prefix_rows(sets, percent, n_parts), "prefixes")
    pivots = rows.groupBy("token").agg(F.min("cid").alias("pivot"), F.max("cid").alias("_max")).where("pivot < _max")
    pivots = store(pivots.select("token", "pivot"), "pivots")
    groups = store(rows.join(pivots, "token").where("cid <> pivot").select("cid", "pivot").distinct(), "groups")
    other = sets.select(F.col("cid").alias("pivot"), F.col("tokens").alias("pivot_tokens"))
    members = groups.join(sets, "cid").join(other, "pivot")
    return groups, store(_against_pivots(members, percent), "zones")


def _block_rows(todo: DataFrame, probing: DataFrame) -> DataFrame:
    """(pivot, cid, zone, stored, i, j): ``todo`` as stored sets and ``probing`` as probes of the blocks (i, j)."""
    blocks = F.ceil(F.greatest(F.col("members") / TRIE_SETS, F.col("member_tokens") / TRIE_TOKENS)).cast("int")
    mine = F.pmod(F.xxhash64("cid"), blocks).cast("int")
    every = F.sequence(F.lit(0), blocks - 1)
    kept = todo.select("pivot", "cid", "zone", F.lit(True).alias("stored"), mine.alias("i"), F.explode(every).alias("j"))
    probe = probing.select("pivot", "cid", "zone", F.lit(False).alias("stored"), F.explode(every).alias("i"), mine.alias("j"))
    return kept.unionByName(probe)


def class_links(sets: DataFrame, percent: int, n_parts: int) -> DataFrame:
    """Stored links (a, b) between classes of ``sets`` (cid, n, tokens), enough for the components."""
    _, zones = _zones(sets, percent, n_parts)
    links = zones.where("zone = 1").select(F.col("pivot").alias("a"), F.col("cid").alias("b"))
    rest = zones.groupBy("pivot").agg(
        F.count_if(F.col("zone") == 2).alias("n2"), F.count_if(F.col("zone") == 3).alias("n3"),
        F.count("*").alias("members"), F.sum("n").alias("member_tokens"),
    )
    # Zone 2 meets everybody, zone 3 meets zones 2 and 3. Zone 1 is stored only where zone 2 has rows.
    rest = store(rest.where("(n2 > 0 OR n3 > 1) AND members > 1"), "group-rest")
    todo = zones.join(rest, "pivot").where("zone > 1 OR n2 > 0")
    work = _block_rows(todo, todo.where("zone > 1")).join(sets.select("cid", "tokens"), "cid")
    more = work.groupBy("pivot", "i", "j").applyInPandas(_trie_links(percent), "a long, b long")
    return store(links.unionByName(more), "links")


def every_link(sets: DataFrame, percent: int, n_parts: int, pairs: bool) -> DataFrame:
    """Stored (a, b, n) of ``sets`` (cid, n, tokens, copies), see ``_every_link``; pairs: every link once."""
    groups, zones = _zones(sets, percent, n_parts)
    near = zones.where("zone = 1").select(F.col("pivot").alias("a"), F.col("cid").alias("b"))
    links = near.withColumn("n", F.lit(0).cast("long"))
    if not pairs:
        both = near.unionByName(near.select(F.col("b").alias("a"), F.col("a").alias("b")))
        both = both.join(sets.select(F.col("cid").alias("b"), "copies"), "b").groupBy("a").agg(F.sum("copies").alias("n"))
        links = links.unionByName(both.select("a", F.col("a").alias("b"), "n"))
    rest = zones.groupBy("pivot").agg(F.count("*").alias("members"), F.sum("n").alias("member_tokens"))
    todo = zones.join(store(rest.where("members > 1"), "group-rest"), "pivot")
    own = groups.groupBy("cid").agg(F.collect_list("pivot").alias("pivots"))
    side = store(sets.select("cid", "tokens", "copies").join(own, "cid"), "group-sets")
    work = _block_rows(todo, todo).join(side, "cid")
    more = work.groupBy("pivot", "i", "j").applyInPandas(_every_link(percent, pairs), "a long, b long, n long")
    return store(links.unionByName(more), "links")


def _class_sets(docs: DataFrame, k: int, percent: int, n_parts: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows (h1, h2, n, doc_id), their classes, and the stored sets of the classes that can have a link.

    A class is known by both halves of its identity; those that can have a link get a number, cid.
    """
    found = store(_prefixes(docs, k, percent, EXTRA, n_parts), "jaccard-prefixes")
    texts = found.where("kind IS NULL").select("id", "h1", "h2", "n", "doc_id")
    cells = {"cells": np.int64}
    counts = spread(found.where("kind = 0"), n_parts, cells).mapInArrow(_count_shared(n_parts), "part int, keys binary, cells binary")
    counts = counts.unionByName(found.where("kind = 1").select("part", "keys", "cells"))
    shared = spread(counts, n_parts, cells).mapInArrow(_summed, "id long, shared long")
    classes = texts.where("n > 0").groupBy("h1", "h2").agg(
        F.min("doc_id").alias("least_doc"), F.first("n").alias("n"), F.first("id").alias("id"), F.count("doc_id").alias("copies")
    )
    # A partner has at least percent of the members, and its prefix shares as many as both allow.
    least = F.expr(f"ceil({EXTRA} * ceil({percent} * n / 100) / 100)")
    classes = classes.where("least_doc IS NOT NULL").join(shared, "id", "left").withColumn("able", F.coalesce(F.col("shared") >= least, F.lit(False)))
    classes = store(classes.withColumn("cid", F.monotonically_increasing_id()).drop("id", "shared"), "classes")
    able = classes.where("able").select("least_doc", "h1", "h2", "cid", "copies")
    # A doc_id with several texts may stand for several classes; the hashes tell which row is meant.
    picked = F.broadcast(able) if stored_bytes(classes) <= BROADCAST_BYTES else able
    fetched = docs.join(picked, F.col("doc_id") == F.col("least_doc")).select("text", "h1", "h2", "cid", "copies")
    return texts, classes, store(_whole_sets(fetched, k).dropDuplicates(["cid"]), "sets")


def jaccard_components(docs: DataFrame, k: int = WORDS, percent: int = PERCENT, count_links: bool = False) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs`` (doc_id, text).

    count_links: also n_links, the number of other rows (with a doc_id) that the row is linked with,
    copies included.
    """
    docs = docs.select("doc_id", "text")
    n_parts = part_count(docs)
    texts, classes, sets = _class_sets(docs, k, percent, n_parts)
    links = every_link(sets, percent, n_parts, pairs=False) if count_links else class_links(sets, percent, n_parts)
    found = store(components(links), "components")
    made = ["component_id"]
    named = classes.join(found, classes["cid"] == found["node"], "left").select(
        "h1", "h2", "cid", "least_doc", "copies", F.coalesce("component", "cid").alias("component")
    )
    named = store(named, "class-components")
    least_doc = named.groupBy("component").agg(F.min("least_doc").alias("component_id"))
    named = named.join(least_doc, "component")
    if count_links:
        linked = store(links.groupBy(F.col("a").alias("cid")).agg(F.sum("n").alias("_linked")), "link-counts")
        named = named.join(linked, "cid", "left").withColumn("n_links", F.col("copies") - 1 + F.coalesce("_linked", F.lit(0)))
        made.append("n_links")
    named = store(named.select("h1", "h2", *made), "class-names")
    out = texts.join(named, ["h1", "h2"], "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    many = [F.when(F.col("doc_id").isNotNull(), F.coalesce("n_links", F.lit(0))).otherwise(0).cast("long").alias("n_links")] if count_links else []
    return out.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"), *many)


def jaccard_links(docs: DataFrame, k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(a, b) of every link between different texts, a < b: the smallest doc_id of each text's copies."""
    docs = docs.select("doc_id", "text")
    n_parts = part_count(docs)
    _, classes, sets = _class_sets(docs, k, percent, n_parts)
    pairs = every_link(sets, percent, n_parts, pairs=True).select("a", "b")
    for c in ("a", "b"):
        name = classes.select(F.col("cid").alias(c), F.col("least_doc").alias(f"_{c}"))
        pairs = pairs.join(name, c).drop(c)
    return pairs.select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b"))


def keep_one(docs: DataFrame, k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` without those of every component's documents but the smallest doc_id."""
    lost = jaccard_components(docs, k, percent).where("doc_id <> component_id").select("doc_id").distinct()
    lost = store(lost.withColumn("_lost", F.lit(True)), "copies")
    return attach(docs, lost, "doc_id").where("_lost IS NULL").drop("_lost")


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), count_links=True)
