"""Filter interactions against a brute-force walk through every order; the trie against a dictionary."""

import hashlib
import random
import re
from itertools import permutations

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import filter_audit as A

DOCS = "doc_id long, text string, part string"
LABELS = "doc_id long, quality int, toxic int"


def fails(text, duplicate):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    caps, odd = len(re.findall("[A-Z]", text)), re.search(r"[#$%&*|]", text)
    bad = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * caps > 2 * len(text), "D": bool(odd), "E": duplicate}
    return {f for f, b in bad.items() if b}


def brute(docs, labels):
    rows = []
    for d, t, p in docs:
        copy = any(d is not None and o is not None and o < d and (u or "") == (t or "") for o, u, _ in docs)
        says = [x for x in labels if d is not None and x[0] == d]
        rows.append((p or "", fails(t or "", copy), any(x[1] == 1 for x in says), any(x[2] == 1 for x in says)))
    out = {}
    for part in {r[0] for r in rows}:
        mine = [r[1:] for r in rows if r[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[0]]
                earlier = [r for r in mine if f in r[0] and r[0] & set(order[: step - 1])]
                left = [r for r in left if f not in r[0]]
                shapley[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), len(earlier), sum(r[0] == {f} for r in mine), sum(r[1] for r in gone), sum(r[2] for r in gone),
                ]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def result(docs, labels):
    rows = A.interactions(A.failure_masks(docs), labels).collect()
    got = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in rows}
    assert len(got) == len(rows)
    return got


def documents(seed, n=60):
    rng = random.Random(seed)
    texts = [None, "", " ", "Short text", "it costs 5 % more", "HEAD " * 3]
    for _ in range(12):
        words = [rng.choice(["w", "V", "é"]) + str(rng.randrange(rng.choice([60, 5000]))) for _ in range(rng.choice([150, 200, 260]))]
        texts.append("a common header of many texts " * 3 + " ".join(words) + rng.choice(["", "", " #"]))
    texts += [texts[-1] + "x", texts[-1][:-1], texts[-1][:40]]
    rows = [(rng.choice([rng.randrange(-20, 200), None]), rng.choice(texts), rng.choice(["a", "b", "", None])) for _ in range(n)]
    return rows + rows[:5]


@pytest.mark.parametrize("seed, levels, part", [(0, (8, 64, 512, 4096), 32 << 20), (1, (1, 2, 4), 64), (2, (4, 32, 100), 1)])
def test_matches_brute_force(spark, seed, levels, part, monkeypatch):
    monkeypatch.setattr(A, "LEVELS", levels)
    monkeypatch.setattr(A, "PART_BYTES", part)
    docs = documents(seed)
    labels = [(d, i % 3, i % 2) for i, (d, _, _) in enumerate(docs) if i % 4] + [(None, 1, 1), (9999, 1, 1), (5, None, None)]
    df = spark.createDataFrame([(*r, 7, "x") for r in docs], DOCS + ", mask int, digest string")
    assert result(df, spark.createDataFrame(labels, LABELS)) == brute(docs, labels)


def test_a_third_of_all_rows_is_one_text(spark):
    docs = [(i, "same words", "hot") for i in range(400)] + [(1000 + i, f"text {i}", "hot") for i in range(800)]
    got = result(spark.createDataFrame(docs, DOCS), spark.createDataFrame([], LABELS))
    assert got["hot", "EABCD", 1] == (801, 399, 0, 0, 0, 0, brute(docs, [])["hot", "EABCD", 1][-1])


def test_empty_tables_and_long_texts(spark):
    none = spark.createDataFrame([], LABELS)
    assert result(spark.createDataFrame([], DOCS), none) == {}
    docs = [(1, "z" * 3_000_000, "p"), (2, "z" * 3_000_000, "p"), (3, "z" * 2_999_999, "p")]
    assert result(spark.createDataFrame(docs, DOCS), none) == brute(docs, [])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from([b"a", b"b", b"ab", b"abab", b"\xc3\xa9"]), max_size=7).map(b"".join), st.one_of(st.none(), st.integers(0, 9))), max_size=20))
def test_trie_holds_what_a_dictionary_holds(rows):
    trie, held = A.Trie(), {}
    for text, least in rows:
        trie.insert(text, least, 1)
        held.setdefault(text, []).append(least)
    want = {hashlib.md5(t).digest(): min(x for x in ids if x is not None) for t, ids in held.items() if len(ids) > 1 and any(x is not None for x in ids)}
    assert dict(trie.repeated()) == want


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="aB c#\né", max_size=600), max_size=5))
def test_masks_of_one_text(texts):
    bits = {"A": 1, "B": 2, "C": 4, "D": 8}
    got = A.text_masks(pa.array(texts, pa.string())).tolist()
    assert got == [sum(bits[f] for f in fails(t, False)) for t in texts]
