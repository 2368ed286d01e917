"""The prefix trie of rebuilt conversations against a brute-force version."""

import hashlib
import random
import zlib

import pytest

from strata.llm import conversation_trie as T

SCHEMA = "conv_id long, turn long, role string, text string"
LAST = 1 << 70


def brute(rows):
    own = {}
    for c, turn, role, text in rows:
        own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(ts)] for c, ts in own.items()}
    nodes = {}
    for c, turns in own.items():
        if c is not None:
            h = zlib.crc32(str(c).encode()) % 6
            donor = c - (c % 100 if c >= 0 else -(-c % 100))  # the remainder has the sign of c
            turns = own.get(donor, [])[:h] + turns[h:]
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append((LAST if c is None else c, len(turns)))
    out = set()
    for path, members in nodes.items():
        below = [p for p in nodes if p[: len(path)] == path]
        leaves = [p for p in below if not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in below)]
        saved = sum((len(nodes[p]) - 1) * len(p[-1][1]) for p in below if p)
        ends = ",".join("" if c == LAST else str(c) for c, n in sorted(members) if n == len(path))
        least = lambda m: None if min(m)[0] == LAST else min(m)[0]
        out.add((
            least(members), len(path), least(nodes[path[:-1]]) if path else None, len(members),
            sum(len(p) == len(path) + 1 for p in below), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return out


def conversations(seed, ids, longest):
    """Conversations over few turn texts, so that many share prefixes; nulls and ties among them."""
    rng = random.Random(seed)
    rows = []
    for c in ids:
        for i in range(rng.randint(1, longest)):
            rows.append((c, rng.choice([i, i, i, None]), rng.choice(["user", "assistant", None]), rng.choice(["a", "bé", "", None, "𝄞c"])))
    return rows


def result(df):
    got = [tuple(r) for r in T.conversation_trie(df).drop("x1", "x2").collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.parametrize("seed, width, strip", [(0, 8, 1024), (1, 2, 2), (2, 1, 1), (3, 3, 2)])
def test_matches_brute_force(spark, seed, width, strip, monkeypatch):
    monkeypatch.setattr(T, "WIDTH", width)
    monkeypatch.setattr(T, "STRIP", strip)
    monkeypatch.setattr(T, "CHUNK_BYTES", 8)
    rows = conversations(seed, [0, 1, 2, 3, 7, 55, 99, 100, 101, 150, 203, -1, -5, -100, -120, None], 12)
    df = spark.createDataFrame(rows, SCHEMA)
    assert result(df) == brute(rows)


def test_hot_conversation_and_copies(spark, monkeypatch):
    monkeypatch.setattr(T, "WIDTH", 4)
    monkeypatch.setattr(T, "STRIP", 2)
    rows = [(5, i, "user", f"t{i % 3}") for i in range(60)]
    rows += [(c, i, "user", "same") for c in range(1000, 1100, 3) for i in range(8)]
    rows += [(None, None, None, None)] * 9  # rows that repeat are turns of their own
    assert result(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_empty_and_turnless(spark):
    assert T.conversation_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    lone = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 > 1)
    rows = [(lone, 0, "user", "x")]  # its turn falls away and there is no donor
    assert result(spark.createDataFrame(rows, SCHEMA)) == brute(rows) and len(brute(rows)) == 1


def test_columns_of_the_input_do_not_clash(spark):
    rows = conversations(9, [1, 2, 100, 101], 4)
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], SCHEMA + ", place int, _at int, block int")
    assert result(df) == brute(rows)


def test_a_long_text_counts_in_code_points(spark):
    text = "é" * 200_000
    rows = [(c, i, "user", text) for c in (0, 1) for i in range(6)]
    assert result(spark.createDataFrame(rows, SCHEMA)) == brute(rows)
