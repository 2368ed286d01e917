"""Document fingerprints: one-permutation MinHash, all in SQL expressions.

The five-word shingles of a text (words ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased; fewer than five words:
the whole sequence as one) are hashed once. The top 9 bits of a hash name one of 512 bins, and a bin
keeps its least hash: hashes are sorted together with one sentinel a bin, so the first element of each
bin is its minimum, or the sentinel if the bin is empty. An empty bin copies the bin that comes first
in its own fixed order of all bins and is not empty (optimal densification); the orders are affine,
so a few probes find it and, where nearly all bins are empty, its place is computed from the few that
are not. A bin's value is then hashed with the bin's number and its low 4 bits are stored: 256 bytes,
packed, as base64. Texts that share no shingle agree in a bin by chance 1/16, and ``likeness`` takes
that out: (agreeing / 512 - 1/16) / (1 - 1/16), at least 0. Its standard error is at most 0.024.

``fingerprints`` also edits each text: its last third is replaced by the beginning of the next document
in descending doc_id. The order comes from range partitions numbered over all, neighbours from a
window over blocks of places; texts are shuffled once, by a digest of the row, and only as much of a
text goes to its neighbour as it takes.

Defined results: a null text is empty; a text without words has the empty string as fingerprint, like
1 to another such and 0 to others. A null doc_id comes last; rows of one doc_id are ordered by digest
and each is a document. A lone document is its own next. An empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import lower_ascii, store, table
from strata.llm.numbering import numbered

#: Words of a shingle; bins; bits kept of each; probes before the place is computed.
SHINGLE, BINS, BITS, PROBES = 5, 512, 4, 32
#: Neighbouring places that one window partition covers.
BLOCK = 4096
_SHIFT = 64 - (BINS.bit_length() - 1)
_EMPTY = (1 << _SHIFT) - 1
_SPACE = "\t\n\x0b\x0c\r"
#: Orders of the bins: bin i probes (step[i] * t + start[i]) % BINS for t = 0, 1, ...; steps are odd.
_STEP = [(i * 2654435761 >> 7) % BINS | 1 for i in range(1, BINS + 1)]
_START = [(i * 40503 * 2246822519 >> 11) % BINS for i in range(1, BINS + 1)]


def _constant(values: list[int], kind: str = "int") -> Column:
    """An array of numbers that the optimizer folds into one constant."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def shingle_hashes(text: Column) -> Column:
    """64-bit hashes of a text's shingles, in order; null counts as empty."""
    spaced = F.translate(lower_ascii(F.coalesce(text, F.lit(""))), _SPACE, " " * len(_SPACE))

    def windows(words: Column) -> Column:
        starts = F.slice(words, F.lit(1), F.greatest(F.size(words) - (SHINGLE - 1), F.lit(1)))
        return F.transform(starts, lambda w, i: F.xxhash64(w, *(F.get(words, i + j) for j in range(1, SHINGLE))))

    return _let(F.array_remove(F.split(spaced, " "), ""), windows)


def _minima(hashes: Column) -> Column:
    """The least hash of each bin, in bin order, null where a bin is empty."""
    sentinels = _constant([(b << _SHIFT) | _EMPTY for b in range(-BINS // 2, BINS // 2)], "bigint")

    def first_of_bin(s: Column) -> Column:
        return F.filter(s, lambda x, i: (i == 0) | (F.shiftright(x, _SHIFT) != F.shiftright(F.get(s, i - 1), _SHIFT)))

    least = _let(F.sort_array(F.concat(hashes, sentinels)), first_of_bin)
    return F.transform(least, lambda x: F.when(x.bitwiseAND(F.lit(_EMPTY)) != _EMPTY, x))


def _densified(minima: Column) -> Column:
    """Each empty bin filled with the first bin of its own order that is not empty."""
    step, start = _constant(_STEP), _constant(_START)
    back = _constant([pow(s, -1, BINS) for s in _STEP])
    wrap = F.lit(BINS - 1)
    tries = [_constant([(a * t + b) % BINS for a, b in zip(_STEP, _START, strict=True)]) for t in range(PROBES)]

    def fill(e: Column, full: Column) -> Column:
        def earliest(i: Column) -> Column:
            """The bin that is not empty and comes first in the order of bin i."""
            t = F.array_min(F.transform(full, lambda j: ((j - F.get(start, i) + BINS) * F.get(back, i)).bitwiseAND(wrap)))
            return (F.get(step, i) * t + F.get(start, i)).bitwiseAND(wrap)

        return F.transform(e, lambda x, i: F.coalesce(x, *(F.get(e, F.get(t, i)) for t in tries), F.get(e, earliest(i))))

    def with_full(e: Column) -> Column:
        full = F.filter(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda j: F.get(e, j).isNotNull())
        return _let(full, lambda f: fill(e, f))

    return _let(minima, with_full)


def fingerprint(text: Column) -> Column:
    """The packed fingerprint of a text as base64; the empty string if it has no words."""
    return _as_text(_packed(text))


def _as_text(packed: Column) -> Column:
    return F.translate(F.base64(packed), "\r\n", "")


def _packed(text: Column) -> Column:
    """The fingerprint as bytes."""
    low = F.lit((1 << BITS) - 1).cast("long")

    def pack(hashes: Column) -> Column:
        bins = F.transform(_densified(_minima(hashes)), lambda x, i: F.hex(F.xxhash64(x, i).bitwiseAND(low)))
        return F.when(F.size(hashes) == 0, F.lit(b"")).otherwise(F.unhex(F.array_join(bins, "")))

    return _let(shingle_hashes(text), pack)


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of shingles that two texts have in common, 0 to 1, from their fingerprints."""
    return _likeness(F.unbase64(a), F.unbase64(b))


def _likeness(a: Column, b: Column) -> Column:
    per = 64 // BITS
    ones = F.lit(int("1" * per, 16))

    def differing(x: Column, y: Column) -> Column:
        """Bins that differ: each bin's bits are folded into its lowest."""

        def word(h: Column, i: Column) -> Column:
            return F.conv(F.substring(h, i * 16 + 1, F.lit(16)), 16, -10).cast("long")

        def folded(i: Column) -> Column:
            d = word(x, i).bitwiseXOR(word(y, i))
            return _let(d.bitwiseOR(F.shiftrightunsigned(d, 1)), lambda e: F.bit_count(e.bitwiseOR(F.shiftrightunsigned(e, 2)).bitwiseAND(ones)))

        return F.aggregate(F.transform(F.sequence(F.lit(0), F.lit(BINS // per - 1)), folded), F.lit(0), lambda s, c: s + c)

    chance = 1 / (1 << BITS)
    off = _let(F.hex(a), lambda x: _let(F.hex(b), lambda y: differing(x, y)))
    return (
        F.when(a == b, 1.0)
        .when((F.octet_length(a) == 0) | (F.octet_length(b) == 0), 0.0)
        .otherwise(F.greatest(F.lit(0.0), (1 - off / BINS - chance) / (1 - chance)))
    )


def _neighbours(rows: DataFrame) -> DataFrame:
    """``rows`` with ``next``, the (digest, mark) of the next document; the last one's is the first."""
    placed, total = numbered(rows, [F.desc_nulls_last("doc_id"), F.col("digest"), F.col("tie")], "place", "fingerprints")
    placed = placed.withColumn("block", F.expr(f"place div {BLOCK}")).withColumn("me", F.struct("digest", "mark"))
    lead = placed.withColumn("next", F.lead("me").over(Window.partitionBy("block").orderBy("place")))
    # The last row of a block meets the first of the block after: one row in BLOCK, joined by block.
    last = max(total - 1, 0) // BLOCK
    heads = placed.where(f"place % {BLOCK} = 0").select(
        F.when(F.col("block") == 0, last).otherwise(F.col("block") - 1).alias("block"), F.col("me").alias("head")
    )
    return lead.join(heads, "block", "left").withColumn("next", F.coalesce("next", "head")).drop("head", "me", "block", "place", "tie")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_text, both fingerprints and their likenesses of ``docs`` (doc_id, text)."""
    text = F.coalesce("text", F.lit(""))
    digest = F.unhex(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), text)))
    marks = docs.select(
        "doc_id",
        digest.alias("digest"),
        F.char_length(text).cast("long").alias("n_chars"),
        _packed(text).alias("mark"),
        F.monotonically_increasing_id().alias("tie"),
    )
    # Stored, because range partitioning reads its input twice: once to find the ranges.
    marks = store(marks, "fingerprint-marks")
    near = _likeness(F.col("mark"), F.col("next.mark")).alias("near_next")
    links = _neighbours(marks).select("doc_id", "digest", "n_chars", "mark", near, F.col("next.digest").alias("after"))
    links = store(links, "fingerprint-links")
    body = docs.select(digest.alias("digest"), text.alias("whole"))
    if not links.where("digest = after").isEmpty():
        body = body.dropDuplicates(["digest"])  # equal rows: one text serves all of their links
    third = F.expr("n_chars div 3").cast("int")
    lent = links.join(body.select(F.col("digest").alias("after"), F.col("whole").alias("lender")), "after")
    lent = lent.withColumn("lent", F.substring("lender", F.lit(1), third)).drop("after", "lender")
    edited = F.concat(F.substring("whole", F.lit(1), (F.col("n_chars") - third).cast("int")), "lent")
    out = lent.join(body, "digest").select("doc_id", "n_chars", "mark", "near_next", edited.alias("edited_text"))
    out = out.withColumn("edited_mark", _packed(F.col("edited_text")))
    return out.select(
        "doc_id", "n_chars", "edited_text", _as_text(F.col("mark")).alias("fingerprint"), _as_text(F.col("edited_mark")).alias("edited_fingerprint"),
        _likeness(F.col("mark"), F.col("edited_mark")).alias("near_edited"), "near_next",
    )


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_chars", F.sha2(F.col("edited_text").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint", "edited_fingerprint", "near_edited", "near_next",
    )
