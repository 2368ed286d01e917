"""Mixing sources to target weights with the cube method.

A source whose target is m times its size takes every document floor(m) times, and draws the rest
with the inclusion probability m - floor(m) by balanced sampling: the cube method moves the vector
of fractional probabilities through the null space of the balancing constraints (token total and
document total), which ends with probabilities of 0 and 1 but for at most as many as constraints.

Here the flight runs in blocks: documents of a source are dealt by a hash of doc_id and size into blocks of
about BLOCK rows, each flown on its own; the few rows a block leaves fractional are flown again
with those of MERGE other blocks, and so on until a source has one block. The small landing problem
that remains there (at most two rows) is flown with the token total alone, and a last row is drawn.
A hot source is only more blocks. Seeds come from source and block, so reruns agree.

Targets are water-filling over the pre-aggregated sources: target = min(weight * level, 3 * size),
where the level shares out exactly the sum of all sizes.

Defined results: null text has size 0, a null source is a source like another and last in order.
Rows that repeat a doc_id are rows of their own, ordered by size and dealt to blocks by it as well. Empty
tables give no row; other columns pass through ``mix`` if they are named and are none of its results.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import store, table

WEIGHTS = (1, 2, 3)
MOST = 3
BLOCK, MERGE = 4096, 512


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, n_docs, target) from (source, size); one row a source, stored.

    The windows run over sources, after the aggregation, not over documents.
    """
    # Code point order is the byte order of UTF-8; null comes last.
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    pick = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int"))
    w = per.withColumn("weight", pick.cast("long"))
    order = Window.orderBy((most * F.col("source_size") / F.col("weight")), F.col("source").asc_nulls_last())
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    everyone = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    w = (
        w.withColumn("_left", F.sum("source_size").over(everyone) - most * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
        .withColumn("_w", F.sum("weight").over(after))
        # From this source on nobody is above: the level that its remaining words and weights give.
        .withColumn("_free", most * F.col("source_size") * F.col("_w") > F.col("_left") * F.col("weight"))
    )
    level = F.first(F.when(F.col("_free"), F.struct("_left", "_w")), ignorenulls=True).over(everyone)
    w = w.withColumn("_level", level)
    free = F.col("weight") * F.col("_level._left") / F.col("_level._w")
    target = F.least(F.coalesce(free, F.lit(float("inf"))), (most * F.col("source_size")).cast("double"))
    return store(w.select("source", "source_size", "n_docs", target.alias("target")), "mix-targets")


def fly(p: np.ndarray, x: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """The flight phase: probabilities moved until at most as many are fractional as x has columns.

    Keeps k + 1 fractional rows at hand; a vector u with x.T @ u = 0 on them moves p up or down
    until one becomes 0 or 1, with chances that leave every expectation as it was.
    """
    p, k = p.copy(), x.shape[1]
    scale = np.abs(x).max(axis=0)
    x = x / np.where(scale > 0, scale, 1)
    hand, at, n = [], 0, len(p)
    draws = rng.random(2 * n + 8)
    used = 0
    while True:
        while len(hand) <= k and at < n:
            if 1e-12 < p[at] < 1 - 1e-12:
                hand.append(at)
            else:
                p[at] = round(p[at])
            at += 1
        if len(hand) <= k:
            return p
        u = _null(x[hand])
        q = p[hand]
        with np.errstate(divide="ignore", invalid="ignore"):
            up = np.where(u > 0, (1 - q) / u, np.where(u < 0, -q / u, np.inf)).min()
            down = np.where(u > 0, q / u, np.where(u < 0, (q - 1) / u, np.inf)).min()
        q = q + u * up if draws[used % len(draws)] * (up + down) < down else q - u * down
        used += 1
        q[q < 1e-9], q[q > 1 - 1e-9] = 0, 1
        p[hand] = q
        hand = [i for i, v in zip(hand, q, strict=True) if 0 < v < 1]


def _null(a: np.ndarray) -> np.ndarray:
    """A vector u of k + 1 entries with a.T @ u = 0, a being (k + 1, k)."""
    if a.shape == (3, 2):
        u = np.cross(a[:, 0], a[:, 1])
    else:
        u = np.array([a[1, 0], -a[0, 0]])
    if np.abs(u).max() > 1e-14:
        return u / np.abs(u).max()
    return np.linalg.svd(a.T)[2][-1]


def _flown(last: bool):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["size", "doc_id"], ascending=[False, True], kind="stable").reset_index(drop=True)
        source = rows["source"].iloc[0]
        word = f"{'' if source is None else 's' + source}/{rows['level'].iloc[0]}/{rows['block'].iloc[0]}"
        rng = np.random.default_rng(list(word.encode()))
        size, p = rows["size"].to_numpy(float), rows["p"].to_numpy(float)
        p = fly(p, np.column_stack([size, np.ones(len(p))]), rng)
        if last:  # landing: the document total is given up, then chance
            p = fly(p, size[:, None], rng)
            p = np.where((p > 0) & (p < 1), rng.random(len(p)) < p, p)
        return rows.assign(p=p)

    return run


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, columns: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies) of ``docs`` (doc_id, text, source), and ``columns`` of it.

    copies: how often the row is taken.
    """
    spark = docs.sparkSession
    words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    made = ("doc_id", "source", "size", "source_size", "target", "copies")
    columns = tuple(c for c in columns if c not in made)
    kept = [F.struct(*columns).alias("kept")] if columns else []
    rows = store(docs.select("doc_id", "source", words.alias("size"), F.monotonically_increasing_id().alias("row"), *kept), "mix-sizes")
    sizes = rows.select("doc_id", "source", "size", "row")
    per = targets(sizes.select("source", "size"), weights, most)
    # One row a source: small next to documents, and joined by the planner's own choice.
    key = per.withColumnRenamed("source", "_s").withColumn(
        "_m", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    )
    blocks = F.ceil(F.col("n_docs") / BLOCK)
    units = sizes.join(key, sizes["source"].eqNullSafe(key["_s"]), "inner").select(
        "doc_id", "row", "source", "size", "source_size", "target",
        F.floor("_m").cast("long").alias("base"), (F.col("_m") - F.floor("_m")).alias("p"),
        F.pmod(F.xxhash64("doc_id", "size"), blocks).alias("block"), blocks.cast("long").alias("blocks"),
    )
    schema = "doc_id long, row long, source string, size long, p double, block long, blocks long, level int"
    left = units.select("doc_id", "row", "source", "size", "p", "block", "blocks", F.lit(0).alias("level"))
    done = None
    most_blocks = per.agg(F.max(F.ceil(F.col("n_docs") / BLOCK))).first()[0] or 1
    level = 0
    while True:
        last = most_blocks <= 1
        if level:
            spread = F.floor(F.col("block") / MERGE).cast("long")
            left = left.withColumns({"block": spread, "blocks": F.ceil(F.col("blocks") / MERGE).cast("long"), "level": F.lit(level)})
        flown = store(left.groupBy("source", "block").applyInPandas(_flown(last), schema), f"mix-level{level}")
        whole = (F.col("p") == 0) | (F.col("p") == 1)
        settled = flown if last else flown.where(whole)
        done = settled if done is None else done.unionByName(settled)
        if last:
            break
        left = flown.where(~whole)
        most_blocks, level = -(-most_blocks // MERGE), level + 1
    drawn = done.select("row", F.col("p").cast("long").alias("_drawn"))
    out = units.join(drawn, "row").withColumn("copies", F.col("base") + F.col("_drawn"))
    if columns:  # texts and the like meet their row again only here
        out = out.join(rows.select("row", "kept"), "row")
    return out.select(*made, *(F.col("kept").getField(c).alias(c) for c in columns))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(docs).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken"), "copies", "source"
    )
