"""Operators over single texts: words, line and substring dedup, rules, suffix windows, decontamination."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from strata.llm import decontamination
from strata.llm.decontamination import Items, drop_leaks, find_leaks
from strata.llm.line_dedup import drop_frequent_lines
from strata.llm.quality_rules import MADE, figures, judge
from strata.llm.substring_dedup import remove_repeats
from strata.llm.suffix_dedup import WINDOW, later_windows, remove_later
from strata.llm.tokens import NOT_ALNUM, Words, owners, shingles

DOCS = "doc_id long, text string, source string, _row string"


def words_of(n, seed=0, vocabulary=None):
    rng = random.Random(seed)
    return [rng.choice(vocabulary) if vocabulary else "".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n)]


def test_words_split_like_the_pattern():
    texts = ["A  b\tc", None, "", " x ", "é\x0bÉ z", "\n", "last"]
    w = Words(pa.array(texts))
    assert w.counts().tolist() == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]
    same = Words(pa.array(["Foo bar", "foo BAR", "foobar"]))
    assert same.hashes[0] == same.hashes[2] and same.hashes[1] == same.hashes[3]
    assert len(set(same.hashes.tolist())) == 3


def test_short_text_is_one_shingle():
    h, bounds = shingles(Words(pa.array(["a b", "a b c d", "", "a b c d e"])), 4)
    assert np.diff(bounds).tolist() == [1, 1, 0, 2]
    assert h[1] == h[2] and h[0] != h[1]


def brute_lines(rows):
    def key(line):
        return line.strip("\t\n\x0b\x0c\r ").translate({c: c + 32 for c in range(65, 91)})

    held = {}
    for d, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 40:
                held.setdefault(key(line), set()).add(d)
    out = {}
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(held.get(key(x), ())) < 5 or d == max(held[key(x)])]
        out[d] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def test_line_dedup_matches_brute_force(spark):
    common = "This Line Is Long Enough To Be Counted By Its Key"
    rows = [(i, f"own {i}\n {common.upper() if i % 2 else common}\t\nshort\n{common}") for i in range(6)]
    rows += [(6, None), (7, ""), (8, "x" * 40), (9, "\n\n")]
    df = spark.createDataFrame([(d, t, "s", "clash") for d, t in rows], DOCS)
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in drop_frequent_lines(df).collect()}
    assert got == brute_lines(rows)
    assert set(drop_frequent_lines(df).columns) >= {"source", "_row"}


def test_line_dedup_null_and_repeated_ids(spark):
    line = "y" * 45
    df = spark.createDataFrame([(None, line, "s", ""), (1, line, "s", ""), (1, line, "s", ""), (2, line, "s", ""), (3, line, "s", "")], DOCS)
    assert {r.n_dropped for r in drop_frequent_lines(df).collect()} == {0}  # four documents
    more = df.unionByName(spark.createDataFrame([(4, line, "s", "")], DOCS))
    got = [(r.doc_id, r.n_dropped) for r in drop_frequent_lines(more).collect()]
    assert sorted(got, key=str) == sorted([(None, 1), (1, 1), (1, 1), (2, 1), (3, 1), (4, 0)], key=str)


@pytest.mark.parametrize("operator", [drop_frequent_lines, remove_repeats, judge])
def test_empty_table_keeps_columns(spark, operator):
    out = operator(spark.createDataFrame([], DOCS))
    assert out.count() == 0 and {"doc_id", "source", "_row"} <= set(out.columns)


def test_substring_dedup_keeps_first_and_offsets(spark):
    passage = " ".join(words_of(60, 1)).capitalize() + "."
    rows = [
        (1, "Before it. " + passage + " After it."),
        (2, "x " + " ".join(words_of(12, 2)) + ". " + passage + "\nA clean line of its own words that nobody else has."),
        (3, None),
        (4, passage),
    ]
    df = spark.createDataFrame([(d, t, "s", "clash") for d, t in rows], DOCS)
    got = {r.doc_id: r for r in remove_repeats(df).collect()}
    assert got[1].text == rows[0][1] and got[3].text == "" and got[4].text == ""
    assert passage not in got[2].text and "A clean line" in got[2].text
    cut = got[2].removed[0]
    assert rows[1][1][cut.start : cut.stop].strip() == passage


def brute_rules(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)

    def cover(k):
        seen = {}
        for i in range(n - k + 1):
            seen.setdefault(tuple(w[i : i + k]), []).append(i)
        return len({j for v in seen.values() if len(v) > 1 for i in v for j in range(i, i + k)})

    longest = 0
    while any_repeat(w, longest + 1):
        longest += 1
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = n < 50 or 100 * cover(3) > 50 * n
    kept = not failed and 100 * cover(8) <= 20 * n and longest <= 100
    return (n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), cover(3), cover(8), longest, failed, kept)


def any_repeat(w, k):
    seen = set()
    for i in range(len(w) - k + 1):
        g = tuple(w[i : i + k])
        if g in seen:
            return True
        seen.add(g)
    return False


def test_quality_rules_match_brute_force():
    rng = random.Random(5)
    texts = [None, "", "\n\n", "one", "a a a a", " ".join(["to"] * 70), "é# |x\n\né# |x\n"]
    for i in range(60):
        w = words_of(rng.randint(1, 140), i, ["the", "of", "a", "b", "c"][: rng.randint(2, 5)])
        texts.append(" ".join(w) if i % 3 else "\n".join(" ".join(w[j : j + 5]) for j in range(0, len(w), 5)) + "\n" + " ".join(w[:20]))
    base = words_of(150, 9)
    texts += [" ".join(base + base), " ".join(base + words_of(200, 10))]
    got = list(zip(*(c.tolist() for c in figures(pa.array(texts, pa.string()))), strict=True))
    assert got == [brute_rules(t) for t in texts]
    assert len(MADE) == len(got[0])


def test_repeats_below_the_base_limit_are_refused():
    """Half of the words lie in two passages pasted twice: the base rules pass it, the covered share does not."""
    a, b = words_of(99, 21, [f"a{i}" for i in range(900)]), words_of(99, 22, [f"b{i}" for i in range(900)])
    text = " ".join(words_of(402, 23, [f"c{i}" for i in range(9000)]) + a + b + a + b)
    row = dict(zip(MADE, (c.tolist()[0] for c in figures(pa.array([text]))), strict=True))
    assert 390 < row["covered_words"] <= 0.5 * row["n_words"] and row["longest_repeat"] > 100
    assert not row["base_failed"] and not row["kept"]
    text = " ".join(words_of(402, 23, [f"c{i}" for i in range(9000)]) + a + b[:50] + a + b[50:])
    row = dict(zip(MADE, (c.tolist()[0] for c in figures(pa.array([text]))), strict=True))
    assert not row["base_failed"] and row["longest_repeat"] <= 100 and not row["kept"]


def brute_windows(rows):
    seen, out = set(), {}
    for d, t in sorted(rows, key=lambda r: r[0]):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - WINDOW + 1):
            if b[i : i + WINDOW] in seen:
                gone[i : i + WINDOW] = b"\x01" * WINDOW
            seen.add(b[i : i + WINDOW])
        out[d] = bytes(x for x, g in zip(b, gone, strict=True) if not g)
    return out


def test_suffix_dedup_matches_brute_force(spark):
    rng = random.Random(3)
    passage, long = " ".join(words_of(40, 4)), " ".join(words_of(400, 5))
    rows = [(i, f"{' '.join(words_of(rng.randint(0, 60), i))} {passage[rng.randint(0, 40):]} {' '.join(words_of(20, -i - 1))}") for i in range(30)]
    rows += [(50, long), (51, long[:900] + "X" + long[901:]), (52, "é" * 400), (53, "ab" * 300), (54, None), (55, "short"), (56, long)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (bytes(r.kept), r.n_bytes) for r in remove_later(df).collect()}
    want = brute_windows(rows)
    assert {d: k for d, (k, _) in got.items()} == want
    assert all(n == len((t or "").encode()) for (d, t), n in ((r, got[r[0]][1]) for r in rows))


def test_suffix_dedup_repeated_ids_null_ids_and_empty(spark):
    a, b = " ".join(words_of(40, 1)), " ".join(words_of(40, 2))
    df = spark.createDataFrame([(1, a), (1, a), (1, b), (None, b), (2, a)], "doc_id long, text string")
    got = sorted(((r.doc_id, len(r.kept)) for r in remove_later(df).collect()), key=str)
    assert got == sorted([(1, len(a)), (1, len(a)), (1, 0), (None, len(b)), (2, 0)], key=str)
    assert remove_later(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_column_wise_index_finds_equal_windows():
    rng = np.random.default_rng(0)
    strings = [rng.integers(97, 99, rng.integers(100, 140)).astype(np.uint8) for _ in range(20)]
    strings += [np.concatenate([s[:20], strings[0][20:]]) for s in strings[1:4] if len(strings[0]) >= 120]
    strings += [strings[5][1:] if len(strings[5]) > 100 else strings[5], np.full(130, 97, np.uint8)]
    sizes = np.array([len(s) for s in strings])
    n = np.arange(len(strings))
    got = set(zip(*(x.tolist() for x in later_windows(np.concatenate(strings), sizes, n, n * 0, n.astype(np.uint16))), strict=True))
    seen, want = set(), set()
    for i, s in enumerate(strings):
        for j in range(len(s) - WINDOW + 1):
            if s[j : j + WINDOW].tobytes() in seen:
                want.add((i, j))
            seen.add(s[j : j + WINDOW].tobytes())
    assert got == want and want


def test_decontamination_finds_passages_and_leaves_the_rest(spark):
    items = [(i, " ".join(words_of(20 + 3 * i, 100 + i)).capitalize() + ".") for i in range(12)]
    items += [(90, None), (91, ""), (92, "two words")]
    docs = []
    for i, text in items[:12]:
        around = words_of(3000 if i % 2 else 40, 200 + i)
        middle = len(around) // 2
        w = text.split()
        if i == 5:
            w[len(w) // 2] = "changed"  # one word of many: still most of its shingles
        docs.append((i, " ".join(around[:middle]) + "\n" + " ".join(w).upper() + "; " + " ".join(around[middle:])))
    docs += [(100, " ".join(words_of(500, 999))), (101, None), (102, ""), (103, "Two words"), (104, " ".join(items[0][1].split()[:10]))]
    df = spark.createDataFrame([(d, t, "s", "clash") for d, t in docs], DOCS)
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in find_leaks(df, bench).collect()}
    assert found == {(i, i) for i in range(12)} | {(103, 92)}
    clean = drop_leaks(df, bench)
    assert {r.doc_id for r in clean.collect()} == {100, 101, 102, 104} and clean.columns == df.columns
    none = spark.createDataFrame([], "item_id long, text string")
    assert find_leaks(df, none).count() == 0 and drop_leaks(df, none).count() == len(docs)


def test_decontamination_recall_against_brute_force():
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(3000)]
    items = [words_of(rng.randint(5, 120), i, vocabulary) for i in range(80)]
    docs = []
    for i in range(160):
        d = words_of(rng.randint(10, 2000), 1000 + i, vocabulary)
        at = rng.randint(0, len(d))
        piece = items[i % 80][: max(5, int(len(items[i % 80]) * rng.uniform(0.6, 1.0)))]
        docs.append(d[:at] + piece + d[at:])

    def grams(w):
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}

    sets = [grams(d) for d in docs]
    want = {(i, j) for i, s in enumerate(sets) for j, it in enumerate(items) if 100 * len(grams(it) & s) >= 80 * len(grams(it))}
    block = Items.of(list(range(80)), [" ".join(i) for i in items])
    text, item, _ = block.held(pa.array([" ".join(d) for d in docs]))
    got = set(zip(text.tolist(), item.tolist(), strict=True))
    assert got <= want and len(got) >= 0.99 * len(want) and len(want) > 60


def test_decontamination_finds_short_items_in_long_documents():
    items = [words_of(5 + i % 10, 5000 + i) for i in range(400)]  # 1 to 10 shingles
    docs = []
    for i, item in enumerate(items):
        d, at = words_of(400, 9000 + i), (0, 37, 200, 400)[i % 4]
        docs.append(d[:at] + item + d[at:])
    block = Items.of(list(range(400)), [" ".join(i) for i in items])
    text, item, shared = block.held(pa.array([" ".join(d) for d in docs]))
    assert list(zip(text.tolist(), item.tolist(), strict=True)) == [(i, i) for i in range(400)]
    assert shared.tolist() == [1 + i % 10 for i in range(400)]


def test_decontamination_finds_scattered_quotations():
    items = [words_of(59, 20000 + i) for i in range(200)]  # 55 shingles
    docs = []
    for i, item in enumerate(items):
        d = words_of(300, 30000 + i)
        for a in (0, 15, 30, 44):  # four passages of 11 shingles: 44 of 55
            d += item[a : a + 15] + words_of(300, 40000 + 100 * i + a)
        docs.append(" ".join(d))
    docs.append(docs[0].replace(" ".join(items[0][:15]), " ".join(items[0][:14])))  # 43 of 55
    block = Items.of(list(range(200)), [" ".join(i) for i in items])
    text, item, shared = block.held(pa.array(docs))
    assert list(zip(text.tolist(), item.tolist(), strict=True)) == [(i, i) for i in range(200)]
    assert set(shared.tolist()) == {44}


def test_digests_are_of_utf8():
    assert hashlib.sha256("é".encode()).hexdigest().startswith("4a99557e")


@pytest.mark.parametrize("size", [1, 2, 3, 5, 8, 13, 30, 70, 200])
def test_recall_of_the_sketches_in_each_size_partition(size):
    """Every item that a text holds is a candidate of its partition, at the limit too; few others are."""
    rng = random.Random(size)
    items = [words_of(size + 4, (size, i).__hash__()) for i in range(120)]
    docs = []
    for i, w in enumerate(items):
        shingled = [w[j : j + 5] for j in range(size)]
        keep = shingled if i % 3 else rng.sample(shingled, -(-size * 8 // 10))
        scattered = [x for s in keep for x in [*s, *words_of(2, rng.random())]]
        docs.append(words_of(300, -i) + (w if i % 2 else scattered) + words_of(300, -i - 1000))
    block = Items.of(list(range(len(items))), [" ".join(w) for w in items])
    assert len(block.partitions) == 1
    sets = [{tuple(w[j : j + 5]) for j in range(len(w) - 4)} for w in items]
    whole = [{tuple(d[j : j + 5]) for j in range(len(d) - 4)} for d in docs]
    want = {(d, i) for d in range(len(docs)) for i in range(len(items)) if 10 * len(sets[i] & whole[d]) >= 8 * len(sets[i])}
    column = pa.array([" ".join(d) for d in docs])
    values, bounds = shingles(Words(column, breaks=NOT_ALNUM), 5)
    candidates = set(zip(*(x.tolist() for x in block.candidates(values, owners(bounds))), strict=True))
    assert len(want) >= 120 and want <= candidates and len(candidates) <= len(want) + 5
    assert {(int(d), int(i)) for d, i in zip(*block.held(column)[:2], strict=True)} == want


def test_blocks_of_the_benchmark_give_what_one_gives(spark, monkeypatch):
    items = [(i, " ".join(words_of(3 + i, i))) for i in range(40)] + [(90, None), (91, ""), (3, "another of this id and more words")]
    docs = [(i, f"{' '.join(words_of(50, -i))} {items[i % 43][1] or ''}", "s", "en") for i in range(60)]
    df, bench = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string")
    one = sorted(map(tuple, find_leaks(df, bench).collect())), sorted(map(tuple, drop_leaks(df, bench).collect()))
    monkeypatch.setattr(decontamination, "ITEM_BYTES", 1500)
    monkeypatch.setattr(decontamination, "CHUNK", 7)
    assert (sorted(map(tuple, find_leaks(df, bench).collect())), sorted(map(tuple, drop_leaks(df, bench).collect()))) == one
    assert len(one[0]) >= 50 and len(one[1]) < 20
