"""Fingerprints against a plain version of the same sketch, and against exact similarity."""

import base64
import hashlib
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from strata.llm import fingerprints as P

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def plain_shingles(text):
    w = WORDS.findall((text or "").translate(LOWER))
    return [w[i : i + 5] for i in range(max(1, len(w) - 4))] if w else []


def plain_fingerprint(text):
    bins = {}
    for s in plain_shingles(text):
        h = 42
        for w in s:
            h = xxhash.xxh64_intdigest(w.encode(), h)
        h = signed(h)
        b = (h >> 55) + 256
        bins[b] = min(bins.get(b, h), h)
    if not bins:
        return ""
    digits = []
    for i in range(512):
        b = i
        t = 0
        while b not in bins:
            b = (P._STEP[i] * t + P._START[i]) % 512
            t += 1
        h = xxhash.xxh64_intdigest((bins[b] % (1 << 64)).to_bytes(8, "little"), 42)
        digits.append(xxhash.xxh64_intdigest(i.to_bytes(4, "little"), h) & 15)
    return base64.b64encode(bytes(a << 4 | b for a, b in zip(digits[::2], digits[1::2], strict=True))).decode()


def plain_likeness(a, b):
    if a == b or not a or not b:
        return float(a == b)
    nibbles = lambda s: [x for c in base64.b64decode(s) for x in (c >> 4, c & 15)]
    same = sum(x == y for x, y in zip(nibbles(a), nibbles(b), strict=True))
    return max(0.0, (same / 512 - 1 / 16) / (1 - 1 / 16))


def jaccard(a, b):
    a, b = ({tuple(s) for s in plain_shingles(t)} for t in (a, b))
    return len(a & b) / len(a | b) if a | b else 1.0


def text_of(n, seed):
    rng = random.Random(seed)
    return " ".join(rng.choice("abcdefgh") * rng.randint(1, 3) + str(rng.randrange(500)) for _ in range(n))


TEXTS = [None, "", " \n\t", "one", "One", "one two", "a b c d e", "a b c d e f", "é " * 40, text_of(30, 1), text_of(300, 2), text_of(3000, 3), "x" * 50_000, text_of(60_000, 4)]


def test_fingerprint_matches_plain_version(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, text string").select("i", P.fingerprint(F.col("text")).alias("f"))
    got = {r.i: r.f for r in df.collect()}
    assert got == {i: plain_fingerprint(t) for i, t in enumerate(TEXTS)}
    assert got[3] == got[4] and len(got[9]) == 344 and got[0] == got[2] == ""


def test_likeness_matches_plain_version_and_similarity(spark):
    rows = []
    for seed in range(40):
        words = text_of(random.Random(seed).choice([20, 80, 300, 1500]), seed).split()
        other = [w if random.Random((seed, i).__hash__()).random() > seed / 400 else "new" for i, w in enumerate(words)]
        rows.append((" ".join(words), " ".join(other)))
    rows += [("", "a"), ("", ""), ("a", "b"), ("a", "a")]
    df = spark.createDataFrame(rows, "a string, b string").select("a", "b", P.fingerprint(F.col("a")).alias("x"), P.fingerprint(F.col("b")).alias("y"))
    got = df.withColumn("l", P.likeness(F.col("x"), F.col("y"))).collect()
    assert all(abs(r.l - plain_likeness(r.x, r.y)) < 1e-12 for r in got)
    off = [abs(r.l - jaccard(r.a, r.b)) for r in got]
    assert max(off) < 0.12 and sum(off) / len(off) < 0.03


def brute(rows):
    """(doc_id, n_chars, sha of edited, fingerprints, likenesses) of rows, equal ids ordered by digest."""
    key = lambda r: hashlib.md5(f"{'' if r[0] is None else r[0]}:{r[1] or ''}".encode()).digest()
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), key(r)))
    out = []
    for i, (d, t) in enumerate(order):
        t, after = t or "", order[(i + 1) % len(order)][1] or ""
        edited = t[: len(t) - len(t) // 3] + after[: len(t) // 3]
        a, b, c = map(plain_fingerprint, (t, edited, after))
        out.append((str(d), len(t), hashlib.sha256(edited.encode()).hexdigest(), a, b, round(plain_likeness(a, b), 9), round(plain_likeness(a, c), 9)))
    return sorted(out)


def result(df):
    cols = ("doc_id", "n_chars", F.sha2(F.col("edited_text").cast("binary"), 256), "fingerprint", "edited_fingerprint", "near_edited", "near_next")
    return sorted((str(r[0]), r[1], r[2], r[3], r[4], round(r[5], 9), round(r[6], 9)) for r in P.fingerprints(df).select(*cols).collect())


@pytest.mark.parametrize("block", [4096, 3, 1])
def test_edits_and_neighbours(spark, block, monkeypatch):
    monkeypatch.setattr(P, "BLOCK", block)
    rows = [(i * 7 % 60, text_of(random.Random(i).randint(0, 60), i % 25)) for i in range(40)]
    rows += [(None, "no id"), (None, None), (5, None), (5, "twice"), (5, "twice"), (5, "twice"), (-3, "ab"), (1 << 60, "é𝄞 é𝄞 é𝄞")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, digest int, mark string")
    assert result(df.repartition(5)) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(1, "lone text of some words here")], [(1, None)], [(3, "x y")] * 4, [(None, "a b c")] * 3])
def test_small_tables(spark, rows):
    assert result(spark.createDataFrame(rows, "doc_id long, text string")) == (brute(rows) if rows else [])


def test_main_path_is_native(spark):
    df = P.fingerprints(spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|MapPartitions", plan)
