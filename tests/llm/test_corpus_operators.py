"""Operators over whole tables: audit, chat format, mixing, Jaccard join, classifier, pipeline."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.llm import jaccard_join, quality_classifier
from strata.llm.chat_format import CHAT, Formatter, digests, format_conversations
from strata.llm.components import components
from strata.llm.common import store
from strata.llm.jaccard_join import Trie, jaccard_components, jaccard_links, keep_one
from strata.llm.mixing import fly, mix, targets
from strata.llm.quality_classifier import Model, learn, op10_quality_classifier, score_quality
from strata.llm.warc_audit import audit, damaged

SF = "/root/testdata/sf0.01"


def text_of(n, seed, vocabulary=4000):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


# --- WARC audit

PAGES = "page_id long, url string, html string"


def test_audit_of_equal_replicas_is_empty(spark):
    pages = spark.createDataFrame([(i, f"u{i}", "<p>" * i) for i in range(700)] + [(None, None, None), (3, "u", "again")], PAGES)
    assert audit(pages, pages.repartition(3)).count() == 0
    assert audit(pages.limit(0), pages.limit(0)).count() == 0


def test_audit_locates_each_damage(spark):
    pages = spark.createDataFrame([(i, f"u{i}", f"<p>{i}</p>") for i in range(900)], PAGES)
    got = {(r.page_id, r.status) for r in audit(pages, damaged(pages)).collect()}
    want = {(i, "altered") for i in range(900) if i % 211 in (3, 50)} | {(i, "missing") for i in range(900) if i % 211 == 101}
    want |= {(-1 - i, "extra") for i in range(900) if i % 211 == 160}
    assert got == want


def test_audit_sees_lost_copies(spark):
    rows = [(1, "u", "same"), (1, "u", "same"), (2, "v", "x")]
    left = spark.createDataFrame(rows, PAGES)
    assert [r.page_id for r in audit(left, spark.createDataFrame(rows[1:], PAGES)).collect()] == [1]


# --- Chat format

ROLES = st.sampled_from(["system", "user", "assistant", "tool", "", "<|text|>", "^a"])
PIECES = [*"ab^<>[]/|s \n", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<|end|>", "é", "^b"]
TEXTS = st.lists(st.sampled_from(PIECES), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(ROLES, TEXTS), max_size=6))
def test_chat_round_trip(turns):
    f = Formatter(CHAT)
    text, segments = f.write(turns)
    assert f.read_back(text) == turns
    assert "".join(text[a:b] for a, b, _, _ in segments) == text
    learnt = "".join(f.unescaped(text[a:b]) for a, b, _, loss in segments if loss)
    assert learnt == "".join(t for r, t in turns if r == "assistant")


def test_chat_machine():
    f = Formatter(CHAT)
    assert f.walk(["system", "user", "assistant"]) == -1 and f.walk(["user", "assistant", "user", "assistant"]) == -1
    assert f.walk([]) == 0 and f.walk(["user"]) == 1 and f.walk(["user", "user"]) == 1 and f.walk(["assistant"]) == 0


def test_chat_nulls_ties_and_empty(spark):
    schema = "conv_id long, turn long, role string, text string, segments string"
    rows = [(1, 1, "assistant", None, ""), (1, 0, "user", "hi", ""), (None, 0, None, "x", ""), (2, 0, "user", "b", ""), (2, 0, "user", "a", "")]
    got = {r.conv_id: r for r in digests(format_conversations(spark.createDataFrame(rows, schema))).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[1].is_valid and got[1].loss_chars == 0 and got[1].turns_sha256 == sha("user\nhi\nassistant\n\n")
    assert not got[None].is_valid and got[None].turns_sha256 == sha("\nx\n")
    assert got[2].turns_sha256 == sha("user\na\nuser\nb\n")
    assert format_conversations(spark.createDataFrame([], schema)).count() == 0


# --- Mixing


def brute_targets(sizes):
    total, live, out = sum(sizes.values()), dict(sizes), {}
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    left = total
    while True:
        w = sum(weight[s] for s in live)
        over = [s for s in live if left * weight[s] > 3 * live[s] * w]
        if not over:
            return out | {s: left * weight[s] / w for s in live}
        for s in over:
            out[s] = 3 * live.pop(s)
            left -= out[s]


@pytest.mark.parametrize("seed", range(4))
def test_targets_match_water_filling(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{i}": rng.choice([0, 1, 5, 50, 1000, rng.randrange(10**6)]) for i in range(12)} | {None: 7, "é": 3}
    df = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r.source: r.target for r in targets(df).collect()}
    want = brute_targets(sizes)
    assert got.keys() == want.keys()
    assert all(abs(got[s] - want[s]) <= 1e-9 * max(1, want[s]) for s in want)


def test_flight_keeps_totals():
    rng = np.random.default_rng(1)
    size = rng.integers(1, 5000, 3000).astype(float)
    p = np.full(3000, 0.37)
    x = np.column_stack([size, np.ones(3000)])
    q = fly(p, x, rng)
    assert ((q > 0) & (q < 1)).sum() <= 2
    assert abs(q @ size - p @ size) < 1e-4 * (p @ size) and abs(q.sum() - p.sum()) < 1e-6


def test_mix_meets_targets_and_repeats(spark):
    rows = [(i, text_of(1 + (i * 37) % 90, i), f"s{i % 5}" if i % 3 else "s0", "x") for i in range(4000)] + [(None, None, None, "x"), (7, "a b", "s1", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, row string")
    first, again = ({(r.doc_id, r.size, r.copies) for r in mix(d).collect()} for d in (df, df.repartition(7)))
    assert first == again and len(mix(df).collect()) == len(rows)
    taken, want = Counter(), {}
    for r in mix(df).collect():
        taken[r.source] += r.size * r.copies
        want[r.source] = r.target
        assert 0 <= r.copies <= 3
    assert all(abs(taken[s] - want[s]) <= 180 for s in want)
    assert mix(df.limit(0)).count() == 0


def test_mix_hands_columns_through(spark):
    rows = [(i % 7 if i % 5 else None, text_of(i % 30, i), f"s{i % 3}", i, f"k{i}") for i in range(300)] + [(1, None, None, -1, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, row int, kept string")
    got = mix(df, columns=("text", "row", "kept", "source"))
    assert sorted((r.row, r.text, r.kept, r.doc_id, r.source) for r in got.collect()) == sorted((r[3], r[1], r[4], r[0], r[2]) for r in rows)
    assert got.columns == ["doc_id", "source", "size", "source_size", "target", "copies", "text", "row", "kept"]


# --- Jaccard join


def brute_components(rows, k, percent):
    sets, lower = {}, {c: c + 32 for c in range(65, 91)}
    for d, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(lower))
        sets[d] = {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), root(d)) for d in ids}


def near_copies(seed):
    """Chains and stars of near copies around the limit, copies, short texts and texts without words."""
    rng = random.Random(seed)
    rows, n = [], 0
    for base in range(6):
        words = text_of(rng.choice([20, 60, 150]), (seed, base).__hash__()).split()
        for _ in range(rng.randint(1, 14)):
            w = list(words)
            for _ in range(rng.randint(0, 4)):
                w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
            rows.append((n, " ".join(w)))
            words = w if rng.random() < 0.4 else words
            n += 1
    return rows + [(n, None), (n + 1, ""), (n + 2, "a b"), (n + 3, "A B"), (n + 4, "a b c")]


@pytest.mark.parametrize("seed", range(3))
def test_components_match_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(jaccard_join, "TRIE_SETS", 3)  # many blocks
    rows = near_copies(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(df).collect()}
    assert got == brute_components(rows, 4, 85)


@pytest.mark.parametrize("seed, sets", [(0, 3), (1, 2), (2, 1024)])
def test_every_link_matches_brute_force(spark, seed, sets, monkeypatch):
    monkeypatch.setattr(jaccard_join, "TRIE_SETS", sets)
    rows = near_copies(seed)
    rows += [(1000 + i, t) for i, (_, t) in enumerate(rows[:9])] + [(2, rows[2][1]), (None, rows[2][1])]
    shingled = [{tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))} if (w := (t or "").lower().split()) else set() for _, t in rows]
    want, pairs = [], set()
    for (d, _), x in zip(rows, shingled, strict=True):
        near = [(e, y) for (e, _), y in zip(rows, shingled, strict=True) if e is not None and x and 100 * len(x & y) >= 85 * len(x | y)]
        want.append((d, len(near) - 1 if x and d is not None else 0))
        least = lambda z: min(e for (e, _), y in zip(rows, shingled, strict=True) if y == z and e is not None)
        pairs |= {(least(x), least(y)) for _, y in near if least(x) < least(y)}
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard_components(df, count_links=True).collect()
    assert Counter((r.doc_id, r.n_links) for r in got) == Counter(want)
    assert Counter((r.doc_id, r.component_id) for r in got) == Counter((r.doc_id, r.component_id) for r in jaccard_components(df).collect())
    links = [(r.a, r.b) for r in jaccard_links(df).collect()]
    assert len(links) == len(set(links)) and set(links) == pairs and len(pairs) > 5


def test_jaccard_null_and_repeated_ids_and_empty(spark):
    t = text_of(80, 1)
    df = spark.createDataFrame([(5, t, 1), (5, t, 1), (3, t, 1), (None, t, 1), (9, "", 1)], "doc_id long, text string, h1 long")
    got = Counter((r.doc_id, r.component_id) for r in jaccard_components(df).collect())
    assert got == Counter({(5, 3): 2, (3, 3): 1, (None, None): 1, (9, 9): 1})
    assert sorted((r.doc_id or -1) for r in keep_one(df).collect()) == [-1, 3, 9]
    assert jaccard_components(df.limit(0)).count() == 0


def test_trie_finds_every_linked_set():
    rng = np.random.default_rng(2)
    base = np.unique(rng.integers(0, 1 << 60, 60).astype(np.uint64))
    sets = [base]
    for _ in range(80):
        keep = base[rng.random(len(base)) < rng.uniform(0.8, 1.0)]
        sets.append(np.unique(np.append(keep, rng.integers(0, 1 << 60, rng.integers(0, 8)).astype(np.uint64))))
    trie = Trie(sets, 85)
    for probe in sets:
        want = {i for i, s in enumerate(sets) if 100 * len(np.intersect1d(s, probe)) >= 85 * len(np.union1d(s, probe))}
        assert {i for i, _ in trie.linked(probe)} == want


def test_connected_components(spark):
    edges = [(i, i + 1) for i in range(20)] + [(100, 30 + i) for i in range(10)] + [(7, 7)]
    got = {r.node: r.component for r in components(store(spark.createDataFrame(edges, "a long, b long"), "t")).collect()}
    assert got == {i: 0 for i in range(1, 21)} | {i: 30 for i in [*range(31, 40), 100]}


# --- Quality classifier


def test_held_out_accuracy(spark):
    got = op10_quality_classifier(spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = got.join(labels, "doc_id").where("held_out").select("predicted", "quality", "score").collect()
    assert all(0 <= r.score <= 1 for r in rows)
    right = sum(r.predicted == r.quality for r in rows) / len(rows)
    always = max(Counter(r.quality for r in rows).values()) / len(rows)
    assert right >= 0.93 and right > always
    folds = got.where("doc_id < 50").select("doc_id", "held_out").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in folds)


def test_classifier_without_labels_and_odd_texts(spark):
    df = spark.createDataFrame([(1, None, "c"), (2, "", "c"), (None, "x" * 5000, "c")], "doc_id long, text string, _score string")
    model = learn(df, df.select("doc_id", F.lit(None).cast("int").alias("quality")))
    got = score_quality(df, model)
    assert [round(r.score, 6) for r in got.collect()] == [0.5] * 3 and "_score" in got.columns
    assert score_quality(df.limit(0), Model(b"", b"", 0.0, 0.0)).count() == 0


def plain_difference(model, text):
    """Compressed sizes of the whole text's pieces, one plain call after another."""
    sizes = []
    for data in (model.good, model.bad):
        d = zstandard.ZstdCompressionDict(data)
        d.precompute_compress(level=quality_classifier.LEVEL)
        c = zstandard.ZstdCompressor(level=quality_classifier.LEVEL, dict_data=d, write_content_size=False, write_dict_id=False)
        b = (text or "").encode()
        sizes.append(sum(len(c.compress(b[i : i + 1024])) for i in range(0, len(b), 1024)))
    good, bad = sizes
    return (bad - good) / (bad + good) if good else 0.0


def test_scores_are_those_of_a_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    model = quality_classifier.model_for(spark, docs, SF)
    assert model == quality_classifier.model_for(spark, docs.repartition(5), SF)  # the sample does not hang on partitions
    some = docs.where("doc_id % 20 = 0")
    for r in score_quality(some, model).collect():
        want = 1 / (1 + math.exp(-max(-30, min(30, model.slope * plain_difference(model, r.text) + model.offset))))
        assert abs(r.score - want) < 1e-12


def test_texts_are_learnt_from_as_a_whole(spark):
    """Both labels begin alike for 20 KB; only what comes after tells them apart."""
    rows = []
    for i in range(240):
        good = i % 2
        head, tail = text_of(3000, ("head", i).__hash__(), 500), text_of(900, ("tail", i).__hash__(), 300).replace("w", "good" if good else "bad")
        rows.append((i, head + " " + tail, good))
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    scored = score_quality(df.where("doc_id >= 160"), learn(df.where("doc_id < 160"), df.select("doc_id", "quality"))).collect()
    assert sum((r.score >= 0.5) == bool(r.quality) for r in scored) >= 0.9 * len(scored)


def test_repeated_and_contradicting_labels(spark, tmp_path):
    docs = [(i % 40, text_of(300, i, 400) + (" fine" if i % 40 % 2 else " poor") * 60) for i in range(160)]
    labels = [(d, d % 2, 0) for d in range(40)] * 2 + [(3, 0, 0), (4, 1, 0), (None, 1, 1), (5, None, 0)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for seed in (1, 2):
        random.Random(seed).shuffle(labels)
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int").repartition(seed + 1).write.parquet(f"{tmp_path}/{seed}/labels.parquet")
    models = [quality_classifier.model_for(spark, df, f"{tmp_path}/{seed}") for seed in (1, 2)]
    assert models[0] == models[1] and models[0].good


# --- Pipeline


def test_pipeline_stages_take_effect(spark):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = {name: None for name, _ in P.STAGES}
    now = docs
    for name, stage in P.STAGES:
        out = store(stage(spark, now, SF), "test")
        if name != "mixing":
            assert out.columns == docs.columns
        seen[name] = (now, out)
        now = out
    scored = {r.doc_id: r.predicted for r in op10_quality_classifier(spark, SF).collect()}
    assert {r.doc_id for r in seen["quality_classifier"][1].collect()} == {d for d, p in scored.items() if p}
    before, after = seen["jaccard_join"]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    want = {d for d, (_, c) in brute_components(rows, P.NEAR_WORDS, P.NEAR_PERCENT).items() if d == c}
    assert {r.doc_id for r in after.collect()} == want
    assert seen["benchmark_decontamination"][0].count() > seen["benchmark_decontamination"][1].count()
    assert now.count() == seen["mixing"][0].count()
    assert {(r.doc_id, r.taken) for r in P.run(spark, SF).collect()} == {(r.doc_id, r.taken) for r in now.collect()}


def test_queries_read_whole_tables_and_sql_agrees(spark):
    import duckdb

    from strata.llm.queries import ORACLES, QUERIES

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    assert [n for n in range(1, 11) if not any(q.startswith(f"op{n}_") for q in QUERIES)] == []
    for name, sql in ORACLES.items():
        df = QUERIES[name](spark, sf)
        want = con.execute(sql)
        cols = [c[0] for c in want.description]
        assert sorted(cols) == sorted(df.columns), name
        assert Counter(map(tuple, df.select(*cols).collect())) == Counter(want.fetchall()), name
