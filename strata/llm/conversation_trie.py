"""Conversation prefix trie: every prefix of every conversation, with figures of its subtree.

The turns of a conversation become positional turn-id columns t1 .. t8, and one ``GROUP BY ROLLUP``
over them, with ``grouping_id``, aggregates all prefixes of all conversations together: the group at
level d is the node of the first d turns. Longer conversations go on in further blocks of columns;
a block is keyed by the node where the block before it ended, so the same statement serves all
blocks in one job. A second ROLLUP over the nodes sums each node's own figures over its subtree.

A turn's id is the MD5 of role and text followed by the text's length. A node's id is its depth and
the XOR of 128 bits of hash for each (position, turn id) on its path; XOR is associative, so prefixes
are cut from block sums by a window in two levels and no task needs a whole conversation. Subtrees
that reach over several blocks are summed by pointer doubling over the blocks' keys: the number of
rounds is the logarithm of the greatest number of blocks, each one join of small rows.

Hot turns and copies of conversations collapse in the map side of the ROLLUP; a hot conversation is
spread by its blocks. The ids that end in a node are packed into chunks of CHUNK_BYTES before they
meet, and hashed as a stream, so a node with a third of all conversations is a few rows.

Before all that, ``rebuild`` puts the first h turns of a donor conversation before a conversation's
own turns after its first h; a conversation without turns is a member of the root alone.

Defined results: null role or text is empty; null turns come first. Ties in turn are ordered by role,
then by the first 64 code points of the text, then by turn id; repeated rows stay. Rows without
conv_id are one more conversation: it is not rebuilt, is last in order, counts as a member, and its
id is written as nothing; a node that only it reaches has a null conv_id. An empty table has no
nodes, not even a root. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import BROADCAST_BYTES, store, stored_bytes, table
from strata.llm.numbering import numbered

#: Turn-id columns of a block; blocks that are summed as one strip by the window over blocks.
WIDTH, STRIP = 8, 1024
#: Conversations that share a donor, and one more than the most turns that are borrowed.
HUNDRED, BORROW = 100, 6
#: Bytes of ids that travel as one row.
CHUNK_BYTES = 1 << 16
_ID = ["depth", "x1", "x2"]


def turn_id(role: Column, text: Column) -> Column:
    """16 bytes of MD5 over role and text, and 4 bytes: the code points of the text."""
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.concat(F.unhex(F.md5(whole)), F.unhex(F.lpad(F.hex(F.char_length(text)), 8, "0")))


def _hash(seed: int, position: Column, turn: Column) -> Column:
    return F.xxhash64(F.lit(seed), position.cast("long"), turn)


def placed(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn_id, place): turns in the order of conversations and turns, numbered over all."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.select(
        "conv_id", "turn", role.alias("role"), F.substring(text, 1, 64).alias("head"), turn_id(role, text).alias("turn_id")
    )
    order = [F.asc_nulls_last("conv_id"), F.asc_nulls_first("turn"), F.col("role"), F.col("head"), F.col("turn_id")]
    return numbered(rows, order, "place", "trie-turns")[0].select("conv_id", "turn_id", "place")


def rebuild(turns: DataFrame, hundred: int = HUNDRED, borrow: int = BORROW) -> tuple[DataFrame, DataFrame]:
    """(conv_id, pos, turn_id) of the rebuilt conversations from ``placed`` turns; (conv_id, length) of all."""
    per = turns.groupBy("conv_id").agg(F.min("place").alias("start"), F.count("*").alias("n"))
    per = store(
        per.withColumn("h", (F.crc32(F.coalesce(F.col("conv_id").cast("string"), F.lit("")).cast("binary")) % borrow).cast("int")),
        "trie-conversations",
    )
    gives = F.col("conv_id") % hundred == 0
    donors = (
        turns.where(gives)
        .join(per.where(gives), "conv_id")
        .where(F.col("place") - F.col("start") < borrow - 1)
        .groupBy(F.col("conv_id").alias("donor"))
        .agg(F.array_sort(F.collect_list(F.struct("place", "turn_id"))).alias("lent"))
    )
    lent = F.when(F.col("lent").isNotNull(), F.slice("lent", F.lit(1), F.col("h"))).otherwise(F.expr("slice(lent, 1, 0)"))
    convs = per.withColumn("donor", F.col("conv_id") - F.col("conv_id") % hundred).join(donors, "donor", "left")
    convs = convs.select("conv_id", "start", "n", "h", F.coalesce(lent.getField("turn_id"), F.array().cast("array<binary>")).alias("lent"))
    convs = store(
        convs.withColumn("m", F.size("lent")).withColumn("length", F.greatest(F.col("n") - F.col("h"), F.lit(0)) + F.col("m")),
        "trie-rebuilt",
    )
    key = convs.select(F.col("conv_id").alias("_key"), "start", "h", "m")
    own = turns.join(key, turns["conv_id"].eqNullSafe(key["_key"]))
    own = own.withColumn("at", F.col("place") - F.col("start")).where("at >= h")
    own = own.select("conv_id", (F.col("at") - F.col("h") + F.col("m") + 1).alias("pos"), "turn_id")
    first = convs.select("conv_id", F.posexplode("lent").alias("pos", "turn_id"))
    first = first.select("conv_id", (F.col("pos") + 1).cast("long").alias("pos"), "turn_id")
    return own.unionByName(first), convs.select("conv_id", "length")


def _columns() -> list[str]:
    return [f"t{i}" for i in range(1, WIDTH + 1)]


def blocks(rebuilt: DataFrame, lengths: DataFrame) -> DataFrame:
    """One row for each block of a conversation: block, key (k1, k2), t1 .. t8, end (e1, e2), length."""
    per = rebuilt.withColumn("block", F.expr(f"(pos - 1) div {WIDTH}")).groupBy("conv_id", "block").agg(
        F.array_sort(F.collect_list(F.struct("pos", "turn_id"))).getField("turn_id").alias("t"),
        F.bit_xor(_hash(1, F.col("pos"), F.col("turn_id"))).alias("b1"),
        F.bit_xor(_hash(2, F.col("pos"), F.col("turn_id"))).alias("b2"),
    )
    per = store(per.withColumn("strip", F.expr(f"block div {STRIP}")), "trie-blocks")
    before = Window.unboundedPreceding, -1

    def running(rows: DataFrame, keys: list[str], order: str, into: tuple[str, str]) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(order).rowsBetween(*before)
        return rows.select("*", *(F.coalesce(F.bit_xor(b).over(w), F.lit(0).cast("long")).alias(i) for b, i in zip(("b1", "b2"), into, strict=True)))

    # Strips first, then blocks within a strip: a conversation of any length is spread over tasks.
    strips = per.where("block > 0 OR size(t) = " + str(WIDTH)).groupBy("conv_id", "strip").agg(F.bit_xor("b1").alias("b1"), F.bit_xor("b2").alias("b2"))
    strips = running(strips, ["conv_id"], "strip", ("s1", "s2")).where("strip > 0").select(F.col("conv_id").alias("_c"), F.col("strip").alias("_s"), "s1", "s2")
    within = running(per, ["conv_id", "strip"], "block", ("w1", "w2"))
    within = within.join(strips, within["conv_id"].eqNullSafe(strips["_c"]) & (within["strip"] == strips["_s"]), "left")
    none = F.lit(0).cast("long")
    k1, k2 = (F.col(f"w{i}").bitwiseXOR(F.coalesce(F.col(f"s{i}"), none)) for i in (1, 2))
    cells = [F.get("t", F.lit(i)).alias(c) for i, c in enumerate(_columns())]
    rows = within.select("conv_id", "block", k1.alias("k1"), k2.alias("k2"), *cells, k1.bitwiseXOR(F.col("b1")).alias("e1"), k2.bitwiseXOR(F.col("b2")).alias("e2"))
    all_ = lengths.select(F.col("conv_id").alias("_c"), "length")
    rows = rows.join(all_, rows["conv_id"].eqNullSafe(all_["_c"])).drop("_c")
    null = F.lit(None).cast("binary")
    bare = lengths.where("length = 0").select(
        "conv_id", *(none.alias(c) for c in ("block", "k1", "k2")), *(null.alias(c) for c in _columns()), none.alias("e1"), none.alias("e2"), "length"
    )
    return store(rows.unionByName(bare), "trie-rows")


def _rolled(rows: DataFrame, sums: str) -> DataFrame:
    """``sums`` for each prefix: ROLLUP over the turn ids within a block's key, with depth and ids.

    A level whose last turn is null holds what ended before; level 0 of a later block is the node
    where the block before it ended. Neither is a node of its own.
    """
    ts = ", ".join(_columns())
    got = rows.sparkSession.sql(
        f"SELECT block, k1, k2, {ts}, {WIDTH} - bit_count(grouping_id()) AS d, {sums} "
        f"FROM {{rows}} GROUP BY block, k1, k2, ROLLUP({ts})",
        rows=rows,
    )
    last = F.get(F.array(*_columns()), F.col("d") - 1)
    got = got.withColumn("last", last).where("(d > 0 AND last IS NOT NULL) OR (d = 0 AND block = 0)")

    def path(seed: int, less: int) -> Column:
        x = F.col(f"k{seed}")
        for i, c in enumerate(_columns(), 1):
            step = F.when(F.col("d") - less >= i, _hash(seed, F.col("block") * WIDTH + i, F.col(c))).otherwise(F.lit(0).cast("long"))
            x = x.bitwiseXOR(step)
        return x

    return got.select(
        "*", (F.col("block") * WIDTH + F.col("d")).alias("depth"), path(1, 0).alias("x1"), path(2, 0).alias("x2"), path(1, 1).alias("p1"), path(2, 1).alias("p2")
    )


def _below(nodes: DataFrame) -> DataFrame | None:
    """Sums over everything from a later block's key down, at the nodes where such blocks begin.

    Pointer doubling over the tree of blocks: after round j a block has the sums of those less than
    2**j blocks below, and points to the one 2**j above.
    """
    deepest = nodes.agg(F.max("block")).first()[0] or 0
    if not deepest:
        return None
    own = nodes.groupBy("block", "k1", "k2").agg(F.sum("own").alias("own"), F.sum("leaf").alias("leaf"))
    ends = nodes.where(f"d = {WIDTH}")
    above = ends.select((F.col("block") + 1).alias("block"), F.col("x1").alias("k1"), F.col("x2").alias("k2"), F.struct("block", "k1", "k2").alias("jump"))
    tree = store(own.join(above, ["block", "k1", "k2"], "left").withColumn("me", F.struct("block", "k1", "k2")), "trie-tree")
    for _ in range(int(deepest).bit_length()):
        up = tree.where("jump IS NOT NULL").groupBy(F.col("jump").alias("me")).agg(F.sum("own").alias("_own"), F.sum("leaf").alias("_leaf"))
        far = tree.select(F.col("me").alias("jump"), F.col("jump").alias("_far"))
        tree = tree.join(up, "me", "left").join(far, "jump", "left").select(
            "me",
            *((F.col(c) + F.coalesce(F.col(f"_{c}"), F.lit(0))).cast("long").alias(c) for c in ("own", "leaf")),
            F.col("_far").alias("jump"),
        )
        tree = store(tree, "trie-tree")
    start = tree.where("me.block > 0").select(
        (F.col("me.block") * WIDTH).alias("depth"), F.col("me.k1").alias("x1"), F.col("me.k2").alias("x2"), F.col("own").alias("_own"), F.col("leaf").alias("_leaf")
    )
    return ends.join(start, _ID).select("block", "k1", "k2", *_columns(), F.col("_own").alias("own"), F.col("_leaf").alias("leaf"))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (node, conv_id) rows as (node, text): decimal ids of one node, joined, up to CHUNK_BYTES."""
    node, ids, size, out = None, [], 0, []
    schema = pa.schema([("depth", pa.int64()), ("x1", pa.int64()), ("x2", pa.int64()), ("ids", pa.string())])

    def rows():
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    for b in batches:
        for *at, c in zip(*(b.column(n).to_pylist() for n in (*_ID, "conv_id")), strict=True):
            if at != node or size >= CHUNK_BYTES:
                if ids:
                    out.append((*node, ",".join(ids)))
                node, ids, size = at, [], 0
            ids.append("" if c is None else str(c))
            size += len(ids[-1]) + 1
        if len(out) >= 1024:
            yield rows()
            out.clear()
    if ids:
        out.append((*node, ",".join(ids)))
    if out:
        yield rows()


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's chunks, which come sorted; one digest is open at a time."""
    schema = pa.schema([("depth", pa.int64()), ("x1", pa.int64()), ("x2", pa.int64()), ("ends_sha256", pa.string())])
    node, sha, out = None, None, []

    def rows():
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    for b in batches:
        for *at, text in zip(*(b.column(n).to_pylist() for n in (*_ID, "ids")), strict=True):
            if at != node:
                if sha:
                    out.append((*node, sha.hexdigest()))
                node, sha = at, hashlib.sha256(text.encode())
            else:
                sha.update(b"," + text.encode())
        if len(out) >= 1024:
            yield rows()
            out.clear()
    if sha:
        out.append((*node, sha.hexdigest()))
    if out:
        yield rows()


def ends(rows: DataFrame) -> DataFrame:
    """(node, ends_sha256) of the nodes where conversations end, from ``blocks``."""
    last = rows.where(f"block = CASE WHEN length = 0 THEN 0 ELSE (length - 1) div {WIDTH} END")
    last = last.select(F.col("length").alias("depth"), F.col("e1").alias("x1"), F.col("e2").alias("x2"), "conv_id")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    order = [*map(F.col, _ID), F.asc_nulls_last("conv_id")]
    packed = last.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    packed = packed.mapInArrow(_chunks, "depth long, x1 long, x2 long, ids string").withColumn("_at", F.monotonically_increasing_id())
    packed = store(packed, "trie-ends")
    return packed.repartition(parts, *_ID).sortWithinPartitions(*_ID, "_at").drop("_at").mapInArrow(_streamed, "depth long, x1 long, x2 long, ends_sha256 string")


def prefix_trie(rebuilt: DataFrame, lengths: DataFrame) -> DataFrame:
    """The nodes of the trie of (conv_id, pos, turn_id), one row each; ``lengths`` has every conversation."""
    rows = blocks(rebuilt, lengths)
    nodes = _rolled(rows, "count(*) AS n_convs, min(conv_id) AS conv_id, max(length) AS longest")
    chars = F.coalesce(F.conv(F.hex(F.substring("last", 17, 4)), 16, 10).cast("long"), F.lit(0))
    nodes = nodes.withColumn("own", (F.col("n_convs") - 1) * chars)
    nodes = store(nodes.withColumn("leaf", (F.col("longest") == F.col("depth")).cast("long")), "trie-nodes")
    cells = ["block", "k1", "k2", *_columns(), "own", "leaf"]
    below = _below(nodes)
    parts = nodes.select(*cells) if below is None else nodes.select(*cells).unionByName(below)
    sums = _rolled(parts, "sum(own) AS saved_tokens, sum(leaf) AS n_leaves")

    # A node's own row, its sums and its children meet by its id in one aggregation.
    zero, null = F.lit(0).cast("long"), F.lit(None).cast("long")
    mine = nodes.select(*_ID, "p1", "p2", "conv_id", "n_convs", zero.alias("n_children"), null.alias("n_leaves"), null.alias("saved_tokens"))
    child = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("x1"), F.col("p2").alias("x2")).agg(F.count("*").alias("n_children"))
    child = child.select(*_ID, *(null.alias(c) for c in ("p1", "p2", "conv_id", "n_convs")), "n_children", null.alias("n_leaves"), null.alias("saved_tokens"))
    total = sums.select(*_ID, *(null.alias(c) for c in ("p1", "p2", "conv_id", "n_convs")), zero.alias("n_children"), "n_leaves", "saved_tokens")
    met = mine.unionByName(child).unionByName(total).groupBy(*_ID).agg(
        *(F.max(c).alias(c) for c in ("p1", "p2", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"))
    )
    met = store(met.join(ends(rows), _ID, "left"), "trie-met")

    tops = met.where("n_children > 0").select((F.col("depth") + 1).alias("_d"), F.col("x1").alias("_1"), F.col("x2").alias("_2"), F.col("conv_id").alias("parent_conv_id"))
    # Parents are sent to the nodes if small; else AQE splits the parent with the most children.
    tops = F.broadcast(tops) if stored_bytes(met) <= BROADCAST_BYTES else tops
    joined = met.join(tops, (F.col("depth") == F.col("_d")) & (F.col("p1") == F.col("_1")) & (F.col("p2") == F.col("_2")), "left")
    empty = hashlib.sha256(b"").hexdigest()
    return joined.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"), "x1", "x2",
    )


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The prefix trie of the rebuilt ``conversations`` (conv_id, turn, role, text); x1, x2: node id."""
    return prefix_trie(*rebuild(placed(conversations)))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations")).drop("x1", "x2")


#: CRC-32 of the decimal id, byte by byte and bit by bit (reflected polynomial 0xEDB88320).
_CRC = """xor(4294967295, list_reduce(
    list_concat([4294967295], list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ''), ''), lambda s: coalesce(ascii(s), 0)::BIGINT)),
    lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)), lambda a, i: xor(a >> 1, 3988292384 * (a & 1)))))"""

OP11_SQL = f"""
WITH own AS (
  SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}}
           ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
  FROM conversations GROUP BY conv_id
), picked AS (
  SELECT conv_id, turns, CASE WHEN conv_id IS NULL THEN 0 ELSE {_CRC} % 6 END AS h FROM own
), rebuilt AS (
  SELECT p.conv_id, list_concat(coalesce(d.turns, [])[1:p.h], p.turns[p.h + 1:]) AS turns
  FROM picked p LEFT JOIN own d ON d.conv_id = p.conv_id - p.conv_id % 100
), member AS (
  SELECT conv_id, unnest(range(len(turns) + 1)) AS depth, turns FROM rebuilt
), node AS (
  SELECT depth, turns[1:depth] AS path, min(conv_id) AS conv_id, count(*) AS n_convs,
         string_agg(CASE WHEN len(turns) = depth THEN coalesce(CAST(conv_id AS VARCHAR), '') END, ',' ORDER BY conv_id NULLS LAST) AS ends
  FROM member GROUP BY ALL
), figured AS (
  SELECT n.*, CASE WHEN depth > 0 THEN (n_convs - 1) * length(path[depth].t) ELSE 0 END AS own,
         (SELECT count(*) FROM node c WHERE c.depth = n.depth + 1 AND c.path[1:n.depth] = n.path) AS n_children
  FROM node n
), up AS (
  SELECT unnest(range(depth + 1)) AS top, path, own, n_children FROM figured
), summed AS (
  SELECT top AS depth, path[1:top] AS path, sum(own) AS saved, count(*) FILTER (n_children = 0) AS leaves FROM up GROUP BY ALL
)
SELECT f.conv_id, f.depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, s.leaves AS n_leaves,
       CAST(s.saved AS BIGINT) AS saved_tokens, sha256(coalesce(f.ends, '')) AS ends_sha256
FROM figured f JOIN summed s ON s.depth = f.depth AND s.path = f.path
LEFT JOIN node p ON p.depth = f.depth - 1 AND p.path = f.path[1:f.depth - 1]
"""
