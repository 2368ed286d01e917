"""The Jaccard join where parts are many, shingles hot and identities collide."""

import numpy as np
import pytest

from strata.llm import jaccard_join, packed
from strata.llm.jaccard_join import Trie, identities, jaccard_components
from tests.llm.test_corpus_operators import brute_components, near_copies, text_of


def test_parts_and_hot_shingles(spark, monkeypatch):
    """Two shuffles of coarse and fine parts, tiny buffers, and shingles that most sets have."""
    monkeypatch.setattr(packed, "COARSE", 4)
    monkeypatch.setattr(packed, "BUFFER_BYTES", 1 << 12)
    monkeypatch.setattr(jaccard_join, "part_count", lambda docs: 13)
    monkeypatch.setattr(jaccard_join, "HOT", 3)
    monkeypatch.setattr(jaccard_join, "HEAVY", 50)
    rows = near_copies(5)
    common = text_of(30, "common")
    rows += [(2000 + i, common + " " + text_of(3 + i % 4, i % 9)) for i in range(25)]
    rows += [(3000 + i, common) for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(df).collect()}
    assert got == brute_components(rows, 4, 85)


def test_equal_first_halves_do_not_merge_classes(spark, monkeypatch):
    def half(values, bounds):
        h1, h2 = identities(values, bounds)
        return h1 & np.int64(1), h2

    monkeypatch.setattr(jaccard_join, "identities", half)
    rows = near_copies(6)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(df, count_links=True).collect()}
    assert got == brute_components(rows, 4, 85)


@pytest.mark.parametrize("stored", [64, 4096])
def test_a_probe_looks_at_edges_it_can_reach_only(stored):
    rng = np.random.default_rng(stored)
    sets = [np.unique(rng.integers(0, 1 << 63, 60, np.uint64)) for _ in range(stored)]
    trie = Trie(sets, 85)
    seen = []
    hits = trie._hits
    trie._hits = lambda node: seen.append(int(trie.size[node].sum())) or hits(node)
    assert len(trie.found(np.unique(rng.integers(0, 1 << 63, 60, np.uint64)))[0]) == 0 and sum(seen) == 0
    ends, shared = trie.found(sets[7])
    assert ends.tolist() == [7] and shared.tolist() == [len(sets[7])]
