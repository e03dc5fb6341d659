"""Trie of conversation prefixes by ROLLUP over positional turn-id columns.

A turn has an id of 128 bits (two hashes of its role and text). A conversation is a row of ``WIDTH`` id columns, or several
of them if it is longer: blocks of ``WIDTH`` turns, each keyed by the node that the block before it ends in. One
``GROUP BY block, prior, ROLLUP(turn 0, turn 1, …)`` then aggregates the prefixes of all lengths at once, and ``grouping_id`` tells their depth.

* A node is known by the exclusive or of its turns' ids, each mixed with its position: the same whatever block it is reached in,
  and to be had by running combinations, so blocks need no rounds one after the other however long a conversation is.
* Every node belongs to its smallest member. The nodes of one owner are consecutive ones of its path, down to its end. So a
  subtree's sum is that of the owner's nodes from this one on, and all other members' whole sums; a second
  ROLLUP adds up the latter, and counts leaves by their owners.
* Ids of conversations that end in a node are written in sorted chunks first; one pass over the chunks of a node feeds its digest.
* Places, running combinations and sums go by pieces of bounded length, so a conversation with very many turns is spread over
  tasks. All else is partial aggregation, or joins whose skewed sides Spark splits.

Cases: null role or text is empty. Null turns come first; turns of the same number stand by role, then by the MD5 of
their texts; repeated rows are turns of their own. Rows with a null conversation id belong to no conversation. A conversation
without turns ends in the root. An empty table has no node. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from runatlas.llm.numbering import with_places
from runatlas.llm.scratch import Scratch, plain_columns

WIDTH = 8  # turn columns of a block
PIECE = 512  # blocks, and 8 times as many nodes, that one window takes in order
CHUNK = 4096  # ids of one written chunk
LISTED = 1_000_000  # longest list (by its count) that is broadcast: some 32 MB
WORD = r"[^\x20\x09-\x0D]+"


def _listed(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.limit(LISTED + 1).count() <= LISTED else df


def turn_ids(turns: DataFrame, scratch: Scratch, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``conv_id, pos, a, b, words``: turns of every conversation in order, with both halves of their ids."""
    rows = plain_columns(turns, conv_id=conv, turn=turn, role=role, text=text).filter("conv_id is not null")
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        role.alias("role"),
        F.md5(text).alias("digest"),
        F.xxhash64(F.lit(1), role, text).alias("a"),
        F.xxhash64(F.lit(2), role, text).alias("b"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    rows = scratch.save(rows, "turns")
    placed, table = with_places(rows, F.col("conv_id"), [F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")], scratch)
    placed = scratch.save(placed.select("conv_id", "pos", "a", "b", "words"), "placed")
    scratch.drop(rows, table)
    return placed


def grafted(placed: DataFrame, scratch: Scratch, family: int = 20, most: int = 3) -> tuple[DataFrame, DataFrame]:
    """Rebuilt turns, as from ``turn_ids``, and ``(conv_id, n)`` of every rebuilt conversation.

    Conversation ``c`` gets the first ``h`` turns of conversation ``c - c % family`` in place of its own first ``h``;
    ``h`` is the CRC-32 of ``c`` in decimal modulo ``most + 1``.
    """
    conv = F.col("conv_id")
    h = F.crc32(conv.cast("string")) % (most + 1)
    sizes = scratch.save(placed.groupBy("conv_id").agg(F.count("*").alias("n")), "sizes")
    first = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    kept = F.least(F.coalesce("n_base", F.lit(0)), h)
    convs = sizes.withColumn("base", conv - conv % family).join(first, "base", "left")
    convs = convs.select("conv_id", "base", "n", kept.alias("kept"), (F.greatest(F.col("n") - h, F.lit(0)) + kept).alias("rebuilt"))
    convs = scratch.save(convs, "conversations")
    opening = placed.filter(F.col("pos") < most).withColumnRenamed("conv_id", "base")
    heads = opening.join(convs.filter("kept > 0").select("base", "conv_id", "kept"), "base").filter("pos < kept")
    moved = convs.filter(F.col("kept") < h).select("conv_id", "kept")
    own = placed.filter(F.col("pos") >= h).join(_listed(moved), "conv_id", "left").withColumn("pos", F.col("pos") + F.coalesce(F.col("kept") - h, F.lit(0)))
    columns = ("conv_id", "pos", "a", "b", "words")
    rebuilt = scratch.save(own.select(*columns).union(heads.select(*columns)), "rebuilt")
    return rebuilt, convs.select("conv_id", F.col("rebuilt").alias("n"))


def _mixed(half: int, a: Column, b: Column, pos: Column) -> Column:
    """Half of the id of a turn at its position."""
    return F.xxhash64(F.lit(half), a, b, pos.cast("long"))


def running(df: DataFrame, key: str, place: str, piece: int, combine: dict[str, tuple[Callable, str]], downwards: bool = False) -> DataFrame:
    """``combine`` (new column: function and input) over the rows of ``key`` before each one, or from it on with ``downwards``.

    Places are cut into pieces of bounded length; what whole pieces give is combined first.
    """
    split = df.withColumn("piece", F.floor(F.col(place) / piece).cast("long"))
    order, last = (F.col("piece").desc(), F.col(place).desc()) if downwards else (F.col("piece"), F.col(place)), 0 if downwards else -1
    whole = split.groupBy(key, "piece").agg(*[f(column).alias(name) for name, (f, column) in combine.items()])
    earlier = Window.partitionBy(key).orderBy(order[0]).rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy(key, "piece").orderBy(order[1]).rowsBetween(Window.unboundedPreceding, last)
    whole = whole.select(key, "piece", *[f(name).over(earlier).alias(f"whole_{name}") for name, (f, _) in combine.items()])
    whole = whole.filter(F.coalesce(*[f"whole_{name}" for name in combine]).isNotNull())
    out = split.select("*", *[f(column).over(inside).alias(f"part_{name}") for name, (f, column) in combine.items()]).join(_listed(whole), [key, "piece"], "left")
    parts = {name: (F.coalesce(f"whole_{name}", F.lit(0)), F.coalesce(f"part_{name}", F.lit(0))) for name in combine}
    joined = {name: x.bitwiseXOR(y) if combine[name][0] is F.bit_xor else x + y for name, (x, y) in parts.items()}
    return out.select(*df.columns, *[column.alias(name) for name, column in joined.items()])


def blocks_of(rebuilt: DataFrame, convs: DataFrame, scratch: Scratch) -> DataFrame:
    """``conv_id, block, prior_a, prior_b, a0, b0, w0, a1, …``: ``WIDTH`` turns of a conversation; one without turns has an empty block."""
    turn = F.col("pos") % WIDTH
    cells = [F.max(F.when(turn == j, F.col(c))).alias(f"{name}{j}") for j in range(WIDTH) for name, c in (("a", "a"), ("b", "b"), ("w", "words"))]
    mixed = [F.bit_xor(_mixed(half, F.col("a"), F.col("b"), F.col("pos"))).alias(f"x{half}") for half in (1, 2)]
    blocks = rebuilt.groupBy("conv_id", F.floor(F.col("pos") / WIDTH).cast("long").alias("block")).agg(*cells, *mixed)
    blocks = scratch.save(blocks, "blocks")
    keyed = running(blocks, "conv_id", "block", PIECE, {"prior_a": (F.bit_xor, "x1"), "prior_b": (F.bit_xor, "x2")}).drop("x1", "x2")
    zero = F.lit(0).cast("long")
    empty = convs.filter("n = 0").select("conv_id", zero.alias("block"), zero.alias("prior_a"), zero.alias("prior_b"))
    return scratch.save(keyed.unionByName(empty, allowMissingColumns=True), "keyed")


def rolled_up(blocks: DataFrame, aggregates: dict[str, str]) -> DataFrame:
    """Every prefix: ``depth``, its id ``(key_a, key_b)``, that of its parent, ``words`` of its last turn, and ``aggregates`` over its members."""
    columns = ", ".join(f"(a{j}, b{j})" for j in range(WIDTH))
    cells = ", ".join(f"a{j}, b{j}, max(w{j}) AS w{j}" for j in range(WIDTH))
    wanted = ", ".join(f"{sql} AS {name}" for name, sql in aggregates.items())
    rows = blocks.sparkSession.sql(
        f"SELECT block, prior_a, prior_b, {cells}, {wanted}, {WIDTH} - bit_count(grouping_id()) DIV 2 AS upto "
        f"FROM {{blocks}} GROUP BY block, prior_a, prior_b, ROLLUP({columns})",
        blocks=blocks,
    )
    upto = F.col("upto").cast("int")
    last = [F.get(F.array(*[F.col(f"{name}{j}") for j in range(WIDTH)]), upto - 1) for name in ("a", "b", "w")]
    # A prefix that has ended earlier is no node of this depth; the empty one is the root, or the node of the block before.
    rows = rows.filter(F.when(upto > 0, last[0].isNotNull()).otherwise(F.col("block") == 0))
    keys, parents = [], []
    for half, name in ((1, "prior_a"), (2, "prior_b")):
        key = F.col(name)
        for j in range(WIDTH - 1):
            turn = _mixed(half, F.col(f"a{j}"), F.col(f"b{j}"), F.col("block") * WIDTH + j)
            key = key.bitwiseXOR(F.when(upto - 1 > j, turn).otherwise(F.lit(0).cast("long")))
        parents.append(key)
        own = _mixed(half, last[0], last[1], F.col("block") * WIDTH + upto - 1)
        keys.append(key.bitwiseXOR(F.when(upto > 0, own).otherwise(F.lit(0).cast("long"))))
    return rows.select(
        (F.col("block") * WIDTH + upto).cast("long").alias("depth"),
        keys[0].alias("key_a"),
        keys[1].alias("key_b"),
        parents[0].alias("parent_a"),
        parents[1].alias("parent_b"),
        F.coalesce(last[2], F.lit(0)).alias("words"),
        *aggregates,
    )


def _chunks(batches):
    """Rows sorted by node and id: the ids of a node, comma-joined, in pieces."""
    held, node = [], None

    def chunk():
        return pa.RecordBatch.from_pydict(
            {"key_a": pa.array([node[0]], pa.int64()), "key_b": pa.array([node[1]], pa.int64()), "first": pa.array([held[0]], pa.int64()), "ids": pa.array([",".join(map(str, held))], pa.string())}
        )

    for batch in batches:
        for a, b, conv in zip(*(batch.column(c).to_pylist() for c in ("key_a", "key_b", "conv_id")), strict=True):
            if held and ((a, b) != node or len(held) >= CHUNK):
                yield chunk()
                held = []
            node = (a, b)
            held.append(conv)
    if held:
        yield chunk()


def _digests(batches):
    """Chunks sorted by node and first id: one digest a node."""
    node, seen = None, None

    def row():
        return pa.RecordBatch.from_pydict({"key_a": pa.array([node[0]], pa.int64()), "key_b": pa.array([node[1]], pa.int64()), "ends_sha256": pa.array([seen.hexdigest()], pa.string())})

    for batch in batches:
        for a, b, ids in zip(*(batch.column(c).to_pylist() for c in ("key_a", "key_b", "ids")), strict=True):
            if (a, b) != node:
                if node:
                    yield row()
                node, seen = (a, b), hashlib.sha256()
            else:
                seen.update(b",")
            seen.update(ids.encode())
    if node:
        yield row()


def ends_of(rebuilt: DataFrame, convs: DataFrame, scratch: Scratch) -> DataFrame:
    """``key_a, key_b, ends_sha256``: digest of the ids of the conversations that end in a node, in ascending order."""
    mixed = [F.bit_xor(_mixed(half, F.col("a"), F.col("b"), F.col("pos"))).alias(name) for half, name in ((1, "key_a"), (2, "key_b"))]
    ends = rebuilt.groupBy("conv_id").agg(*mixed).select("key_a", "key_b", "conv_id")
    zero = F.lit(0).cast("long")
    ends = scratch.save(ends.union(convs.filter("n = 0").select(zero.alias("key_a"), zero.alias("key_b"), "conv_id")), "ends")
    order = ["key_a", "key_b", "conv_id"]
    chunks = ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_chunks, "key_a long, key_b long, first long, ids string")
    dealt = chunks.repartition("key_a", "key_b").sortWithinPartitions("key_a", "key_b", "first")
    return dealt.mapInArrow(_digests, "key_a long, key_b long, ends_sha256 string")


def trie(rebuilt: DataFrame, convs: DataFrame, scratch: Scratch) -> DataFrame:
    """One row for each distinct prefix of the conversations ``convs(conv_id, n)`` with turns ``rebuilt``.

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.
    """
    key = ["key_a", "key_b"]
    blocks = blocks_of(rebuilt, convs, scratch)
    nodes = scratch.save(rolled_up(blocks, {"conv_id": "min(conv_id)", "n_convs": "count(*)"}), "nodes")
    children = nodes.filter("depth > 0").groupBy(F.col("parent_a").alias("key_a"), F.col("parent_b").alias("key_b")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, key, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = scratch.save(nodes.withColumn("saved", (F.col("n_convs") - 1) * F.col("words")), "nodes")

    owners = nodes.groupBy("conv_id").agg(F.min("depth").alias("first"), F.sum("saved").alias("total"), F.max((F.col("n_children") == 0).cast("long")).alias("leaf"))
    owners = scratch.save(owners, "owners")
    weighed = blocks.join(owners.select("conv_id", "total", "leaf"), "conv_id")
    sums = rolled_up(weighed, {"members": "sum(total)", "n_leaves": "sum(leaf)"}).select(*key, "members", "n_leaves")

    # Below its owner's first node the parent has the same owner; of the first nodes it is looked up.
    borders = nodes.join(owners.select("conv_id", F.col("first").alias("depth")), ["conv_id", "depth"]).filter("depth > 0")
    parents = nodes.select(F.col("key_a").alias("parent_a"), F.col("key_b").alias("parent_b"), F.col("conv_id").alias("parent_conv_id"), F.col("depth").alias("over"))
    root = parents.filter("over = 0").select("parent_conv_id")
    looked_up = borders.filter("depth = 1").crossJoin(F.broadcast(root)).select(*key, "parent_conv_id")
    looked_up = looked_up.union(borders.filter("depth > 1").join(parents, ["parent_a", "parent_b"]).select(*key, "parent_conv_id"))
    looked_up = scratch.save(looked_up, "parents")

    below = running(nodes, "conv_id", "depth", PIECE * WIDTH, {"suffix": (F.sum, "saved")}, downwards=True)
    below = below.join(owners.select("conv_id", "total", "first"), "conv_id")
    below = scratch.save(below.drop("words", "saved", "parent_a", "parent_b"), "below")
    out = below.join(sums, key).join(looked_up, key, "left").join(ends_of(rebuilt, convs, scratch), key, "left")
    parent = F.when(F.col("depth") > F.col("first"), F.col("conv_id")).otherwise(F.col("parent_conv_id"))
    return out.select(
        "conv_id",
        "depth",
        parent.alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        (F.col("suffix") + F.col("members") - F.col("total")).cast("long").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def conversation_trie(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The trie of the conversations as they are."""
    scratch = Scratch(turns.sparkSession, "trie")
    placed = turn_ids(turns, scratch, conv, turn, role, text)
    return trie(placed, scratch.save(placed.groupBy("conv_id").agg(F.count("*").alias("n")), "convs"), scratch)


def grafted_trie(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The trie of the conversations rebuilt by ``grafted``."""
    scratch = Scratch(turns.sparkSession, "trie")
    return trie(*grafted(turn_ids(turns, scratch, conv, turn, role, text), scratch), scratch)
