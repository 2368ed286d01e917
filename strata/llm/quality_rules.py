"""Quality rules by suffix arrays: repeated substrings of a text, in words, next to simple base rules.

The words of a text are the symbols. A suffix array per text (built for many texts at once by prefix
doubling; only suffixes that still have a twin are sorted again) gives the longest common prefix of
neighbours. Every suffix's deepest LCP interval, the greater of its two neighbours' prefixes, is the
longest repeat that starts there. The spans of those of at least SPAN words are united, which gives the
union of all maximal repeats: one that can be extended to the left lies inside the longer one. A text fails if the
united spans cover more than MAX_COVERED percent of its words, or if one repeat is longer than
MAX_REPEAT words. The same array gives the words in repeated three-word windows of the base rules.

Each row is judged on its own, in slices of a few MB: no shuffle, no state, whatever the skew.

Defined results: null and empty texts have no words and fail the base rules (too few words). Rows
that repeat are judged alike; other columns pass through ``judge``. Words are compared by 64-bit
hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import slices, table
from strata.llm.tokens import SPACE, Words, _span_hashes, distinct, owners

MIN_WORDS, MAX_REPEAT_WORDS = 50, 50
#: Words of a repeat that counts, and the share of a text that such repeats may cover, in percent. Repeats of 8 words
#: lie inside those of three, so a share that the base rules would let pass has to be well below MAX_REPEAT_WORDS.
SPAN, MAX_COVERED, MAX_REPEAT = 8, 20, 100
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


def _dense(groups: np.ndarray) -> np.ndarray:
    """Positions of each element's group start, for sorted group marks (True where a new one begins)."""
    start = np.flatnonzero(groups)
    return np.repeat(start, np.diff(np.append(start, len(groups))))


def suffix_array(symbols: np.ndarray, own: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """The suffix array of every text in ``symbols``, and the ranks by the first h symbols, h = 1, 2, 4...

    own: the text of each symbol, ascending; left: symbols from here to the end of the text. Texts
    follow each other in the array; equal ranks mean equal first h symbols of one text.
    """
    n = len(symbols)
    order = np.argsort(symbols)
    by_text = order[np.argsort(own[order].astype(np.uint16), kind="stable")]
    s, o = symbols[by_text], own[by_text]
    new = np.ones(n, bool)
    new[1:] = (s[1:] != s[:-1]) | (o[1:] != o[:-1])
    sa = by_text
    rank = np.empty(n, np.int64)
    rank[sa] = _dense(new)
    levels, h = [(1, rank.copy())], 1
    # Slots of sa whose suffix shares its rank with another; the rest is final.
    twin = ~new | ~np.append(new[1:], True)
    slots = np.flatnonzero(twin)
    while len(slots):
        at = sa[slots]
        group = rank[at]
        ahead = np.minimum(at + h, n - 1)
        second = np.where(left[at] > h, rank[ahead] + 1, 0)
        key = np.lexsort((second, group)) if n >= 1 << 31 else np.argsort(group * (n + 1) + second)
        at, group, second = at[key], group[key], second[key]
        sa[slots] = at
        new = np.ones(len(at), bool)
        new[1:] = (group[1:] != group[:-1]) | (second[1:] != second[:-1])
        rank[at] = slots[_dense(new)]
        h *= 2
        levels.append((h, rank.copy()))
        slots = slots[~new | ~np.append(new[1:], True)]
    return sa, levels


def common_prefixes(sa: np.ndarray, levels: list[tuple[int, np.ndarray]], left: np.ndarray) -> np.ndarray:
    """LCP of each slot with the slot before (0 across texts), by descending powers of two."""
    n = len(sa)
    lcp = np.zeros(n + 1, np.int64)  # a last 0 closes the array
    if n < 2:
        return lcp
    # Neighbours with different first symbols need no further look.
    first = levels[0][1]
    slot = np.flatnonzero(first[sa[1:]] == first[sa[:-1]]) + 1
    a, b, got = sa[slot].copy(), sa[slot - 1].copy(), np.zeros(len(slot), np.int64)
    for h, rank in reversed(levels):
        room = (left[np.minimum(a, n - 1)] >= h) & (left[np.minimum(b, n - 1)] >= h) & (a < n) & (b < n)
        room &= (left[sa[slot]] > got) & (left[sa[slot - 1]] > got)
        same = np.flatnonzero(room)
        same = same[rank[a[same]] == rank[b[same]]]
        a[same] += h
        b[same] += h
        got[same] += h
    lcp[slot] = got
    return lcp


def longest_repeats(words: Words) -> np.ndarray:
    """For each word, the length of the longest word sequence from there that its text has elsewhere too."""
    n = len(words.hashes)
    own = owners(words.first)
    left = words.first[own + 1] - np.arange(n) if n else np.zeros(0, np.int64)
    if n == 0:
        return np.zeros(0, np.int64)
    sa, levels = suffix_array(words.hashes, own, left)
    lcp = common_prefixes(sa, levels, left)
    out = np.empty(n, np.int64)
    out[sa] = np.maximum(lcp[:-1], lcp[1:])
    return out


def covered(repeat: np.ndarray, least: int, bounds: np.ndarray) -> np.ndarray:
    """Words of each text inside the union of its repeats of at least ``least`` words."""
    edge = np.zeros(len(repeat) + 1, np.int64)
    at = np.flatnonzero(repeat >= least)
    edge[at] += 1
    np.subtract.at(edge, at + repeat[at], 1)
    inside = np.concatenate(([0], np.cumsum(np.cumsum(edge[:-1]) > 0)))
    return inside[bounds[1:]] - inside[bounds[:-1]]


def duplicate_lines(words: Words) -> np.ndarray:
    """Lines with a word that equal an earlier line of the text."""
    buf, off = words.bytes, words.offsets
    ends = np.union1d(np.flatnonzero(buf == 10), off[1:])
    starts = np.concatenate(([0], ends[:-1]))
    starts += (buf[np.minimum(starts, len(buf) - 1)] == 10) & (starts < ends) if len(buf) else 0
    has = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
    starts, ends = starts[has], ends[has]
    # The byte at a text's first position may be a line end of its own; that line has no word.
    hashes = _span_hashes(buf, starts, ends)
    bounds = np.searchsorted(starts, off)
    return np.diff(bounds) - np.diff(distinct(hashes, bounds)[1])


def _per_text(marks: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(marks)))
    return total[off[1:]] - total[off[:-1]]


MADE = {
    "n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long", "n_repeat_words": "long",
    "covered_words": "long", "longest_repeat": "long", "base_failed": "boolean", "kept": "boolean",
}


def figures(column: pa.Array) -> list[np.ndarray]:
    """The columns of MADE for a batch of texts."""
    words = Words(column, lower=False)
    off, n = words.offsets, words.counts()
    space = SPACE[words.bytes]
    chars = _per_text(((words.bytes & 0xC0) != 0x80) & ~space, off)
    repeat = longest_repeats(words)
    again = covered(repeat, 3, words.first)
    spans = covered(repeat, SPAN, words.first)
    longest = np.zeros(len(n), np.int64)
    some = n > 0
    if some.any():
        longest[some] = np.maximum.reduceat(repeat, words.first[:-1][some])
    failed = (n < MIN_WORDS) | (100 * again > MAX_REPEAT_WORDS * n)
    kept = ~failed & (100 * spans <= MAX_COVERED * n) & (longest <= MAX_REPEAT)
    return [n, chars, _per_text(_SYMBOL[words.bytes], off), duplicate_lines(words), again, spans, longest, failed, kept]


def judge(docs: DataFrame) -> DataFrame:
    """``docs`` with the columns of MADE."""
    keep = [c for c in docs.columns if c not in MADE]
    schema = docs.select(*keep).schema
    for name, kind in MADE.items():
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", 2 << 20):
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in keep), *map(pa.array, figures(b.column("text")))], [*keep, *MADE]
            )

    return docs.select(*keep).mapInArrow(run, schema)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", *(c for c in MADE if c != "longest_repeat"))


OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), p AS (
  SELECT doc_id, w, len(w) AS n, unnest(range(1, len(w) + 1)) AS i FROM d
), g AS (
  SELECT doc_id, i, 3 AS size, list_slice(w, i, i + 2) AS gram FROM p WHERE i + 2 <= n
  UNION ALL SELECT doc_id, i, 8, list_slice(w, i, i + 7) FROM p WHERE i + 7 <= n
  UNION ALL SELECT doc_id, i, 101, [md5(list_slice(w, i, i + 100)::VARCHAR)] FROM p WHERE i + 100 <= n
), r AS (
  SELECT doc_id, i, size FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, size, gram) > 1
), c AS (
  SELECT doc_id, size, count(DISTINCT j) AS words
  FROM (SELECT doc_id, size, unnest(range(i, i + least(size, 8))) AS j FROM r) GROUP BY doc_id, size
), l AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), f AS (
  SELECT d.doc_id, len(w) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup, 0) AS n_dup_lines,
    coalesce((SELECT words FROM c WHERE c.doc_id = d.doc_id AND size = 3), 0) AS n_repeat_words,
    coalesce((SELECT words FROM c WHERE c.doc_id = d.doc_id AND size = 8), 0) AS covered_words,
    EXISTS (SELECT 1 FROM c WHERE c.doc_id = d.doc_id AND size = 101) AS too_long
  FROM d LEFT JOIN l ON l.doc_id = d.doc_id
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, covered_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * covered_words <= 20 * n_words AND NOT too_long AS kept
FROM f
"""
