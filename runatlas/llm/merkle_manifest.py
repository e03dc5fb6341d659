"""Merkle manifest of a dataset: checkpoint every few levels, recompute what lies between.

Every row is a leaf, the SHA-256 of its fields with their lengths. Within each group (a language) leaves stand in
the order of their ids; every ``FAN`` consecutive nodes become one, level by level, while more than one remains. The groups' roots, in
the order of the groups, become one root in the same way. All digests are lower-case hex text, and are hashed as such.

Going up, only every ``STEP``-th level is written: a task gets the ``FAN ** STEP`` stored nodes below one stored node,
makes the levels between them on the fly and keeps only the top. Proofs are taken going down: each aligned subtree is rebuilt
from its stored nodes, each of these gets its siblings of ``STEP`` levels, followed by those of the subtree's top, and
the rebuilt interior nodes are dropped again. A proof is a list with, for each level, the siblings before and after the node's place.

No group of rows is ever larger than ``FAN ** STEP`` nodes; the numbers of the leaves come from sorted ranges, so a
language that holds all rows is spread like any other. Nothing meets on the driver.

Cases: any field may be null (``-``; an empty text is ``0:``). Null ids come first, equal ids stand in the order of
their leaves; equal rows are leaves of their own. A language of its own holds the rows without one. A lone leaf is its group's root, and a
lone group's root the root. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runatlas.llm.numbering import with_places
from runatlas.llm.scratch import Scratch, plain_columns

FAN = 8
STEP = 3  # levels between stored ones: a subtree is rebuilt from 512 nodes
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
MANY_GROUPS = 100_000  # groups up to which their sizes are broadcast (a counted bound: a few MB)
HOP = "array<struct<before:string,after:string>>"


def leaf_digest(**fields: Column) -> Column:
    """Digest of the fields in the order given: ``-`` for null, else byte count, ``:`` and value."""
    parts = []
    for value in fields.values():
        written = value.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(written).cast("string"), F.lit(":"), written), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _nodes(level: int, size: Column) -> Column:
    """How many nodes a tree of ``size`` leaves has at a level."""
    return F.ceil(size / F.lit(float(FAN**level)))


def _over(level: int, size: Column, below: Column) -> Column:
    """The nodes one level over ``below`` (those of an aligned subtree, at ``level``); the top stays as it is."""
    run = F.sequence(F.lit(0), F.ceil(F.size(below) / F.lit(FAN)).cast("int") - 1)
    made = F.transform(run, lambda k: F.sha2(F.array_join(F.slice(below, k * FAN + 1, F.lit(FAN)), ""), 256))
    return F.when(_nodes(level, size) > 1, made).otherwise(below)


def _subtrees(stored: DataFrame, level: int) -> DataFrame:
    """``tree, size, subtree, n0, n1, …``: the stored nodes of each aligned subtree and the levels over them, rebuilt."""
    node = F.struct("pos", *[c for c in stored.columns if c not in ("tree", "size", "pos")])
    rows = stored.groupBy("tree", "size", F.floor(F.col("pos") / FAN**STEP).alias("subtree")).agg(F.sort_array(F.collect_list(node)).alias("nodes"))
    rows = rows.withColumn("n0", F.col("nodes.hash"))
    for k in range(STEP):
        rows = rows.withColumn(f"n{k + 1}", _over(level + k, F.col("size"), F.col(f"n{k}")))
    return rows


def build(leaves: DataFrame, scratch: Scratch, purpose: str) -> tuple[list[DataFrame], DataFrame]:
    """Stored levels 0, STEP, 2 STEP … over ``leaves(tree, size, pos, hash, …)``, and ``(tree, hash)`` of every root.

    ``size`` is the number of leaves of the tree. A tree is left out of levels at which it is complete.
    """
    levels, roots, level = [leaves], None, 0
    while True:
        tops = _subtrees(levels[-1].select("tree", "size", "pos", "hash"), level).select(
            "tree", "size", F.col("subtree").alias("pos"), F.element_at(f"n{STEP}", 1).alias("hash")
        )
        level += STEP
        tops = scratch.save(tops, f"{purpose}-level")
        complete = _nodes(level, F.col("size")) <= 1
        done = tops.filter(complete).select("tree", "hash")
        roots = done if roots is None else roots.union(done)
        open_ = tops.filter(~complete)
        if not open_.limit(1).count():
            return levels, roots
        levels.append(open_)


def proofs(levels: list[DataFrame], above: DataFrame, scratch: Scratch, purpose: str) -> DataFrame:
    """The leaves of ``build`` with ``proof``: siblings before and after, level by level, and then those of their root.

    ``above(tree, size, proof, …)`` has the proof of every tree's root; its further columns are handed down.
    """
    handed = [c for c in above.columns if c not in ("tree", "size", "proof")]
    lower = None
    for number in reversed(range(len(levels))):
        level = number * STEP
        complete = above.filter(_nodes(level + STEP, F.col("size")) <= 1)  # one subtree, whose top is the root
        tops = complete.select("tree", F.lit(0).cast("long").alias("subtree"), "proof", *handed)
        if lower is not None:
            tops = tops.unionByName(lower.select("tree", F.col("pos").alias("subtree"), "proof", *handed))
        one = _subtrees(levels[number], level).join(tops, ["tree", "subtree"]).select("*", F.posexplode("nodes").alias("at", "node"))
        hops, at = [], F.col("at")
        for k in range(STEP):
            first, place = (F.floor(at / FAN) * FAN).cast("int"), at % FAN
            run = F.slice(F.col(f"n{k}"), first + 1, F.lit(FAN))
            before, after = F.slice(run, F.lit(1), place), F.slice(run, place + 2, F.lit(FAN))
            hop = F.array(F.struct(F.array_join(before, "").alias("before"), F.array_join(after, "").alias("after")))
            hops.append(F.when(_nodes(level + k, F.col("size")) > 1, hop).otherwise(F.array().cast(HOP)))
            at = F.floor(at / FAN).cast("int")
        found = one.select("tree", "node.*", F.concat(*hops, "proof").alias("proof"), *handed)
        if number:
            lower = scratch.save(found, f"{purpose}-proofs")
    return found


def siblings_digest(proof: Column) -> Column:
    """Digest of all siblings of a proof, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda hop: F.concat(hop["before"], hop["after"])), ""), 256)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof give."""
    return F.aggregate(proof, leaf, lambda node, hop: F.sha2(F.concat(hop["before"], node, hop["after"]), 256))


def manifest(docs: DataFrame, altered: dict[str, Column] | None = None, id_column: str = "doc_id", group_column: str = "lang", fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """Per row: ``id_column``, ``leaf``, ``claim``, ``subroot`` of its group, ``root``, and ``proof``.

    ``claim`` is the leaf with the fields in ``altered`` put in place of the stored ones (the leaf itself if there are none): what a
    holder of another copy of the row would compute.
    """
    scratch = Scratch(docs.sparkSession, "merkle")
    stored = {name: docs[f"`{name}`"] for name in fields}
    leaf = leaf_digest(**stored)
    claim = leaf_digest(**stored | altered) if altered else leaf
    # A key that is never null and keeps the groups' order: "!" and the name, and a blank alone for the rows without one.
    group = F.coalesce(F.concat(F.lit("!"), docs[f"`{group_column}`"].cast("string")), F.lit(" "))
    rows = docs.select(group.alias("tree"), docs[f"`{id_column}`"].alias("id"), leaf.alias("leaf"), claim.alias("claim"))
    rows = scratch.save(rows, "rows")

    placed, table = with_places(rows, F.col("tree"), [F.col("id").asc_nulls_first(), F.col("leaf")], scratch)
    sizes = scratch.save(rows.groupBy("tree").agg(F.count("*").alias("size")), "sizes")
    few = sizes.limit(MANY_GROUPS + 1).count() <= MANY_GROUPS
    leaves = placed.withColumnRenamed("leaf", "hash").join(F.broadcast(sizes) if few else sizes, ["tree"])
    leaves = scratch.save(leaves, "leaves")
    scratch.drop(rows, table)
    levels, roots = build(leaves, scratch, "group")
    roots = scratch.save(roots.join(sizes, "tree").withColumnsRenamed({"tree": "group", "size": "rows"}), "subroots")

    heads, _ = with_places(roots, F.lit("all"), [F.col("group")], scratch)
    heads = heads.withColumn("tree", F.lit("all")).withColumn("size", F.lit(roots.count()).cast("long"))
    heads = scratch.save(heads, "heads")
    tops, root = build(heads, scratch, "root")
    size = heads.groupBy("tree", "size").count().select("tree", "size")
    root = scratch.save(root.join(size, "tree").select("tree", "size", F.array().cast(HOP).alias("proof"), F.col("hash").alias("root")), "root")
    climbs = proofs(tops, root, scratch, "root")
    above = climbs.select(F.col("group").alias("tree"), F.col("rows").alias("size"), "proof", F.col("hash").alias("subroot"), "root")
    found = proofs(levels, scratch.save(above, "above"), scratch, "group")
    return found.select(F.col("id").alias(id_column), F.col("hash").alias("leaf"), "claim", "subroot", "root", "proof")


def verify(docs: DataFrame, altered: dict[str, Column] | None = None, **columns: str) -> DataFrame:
    """Per row of ``docs``: id, leaf, subroot, root, ``proof_sha256``, the ``folded_root`` of its claim and whether it is the root."""
    rows = manifest(docs, altered, **columns)
    found = rows.withColumn("folded_root", folded(F.col("claim"), F.col("proof"))).withColumn("proof_sha256", siblings_digest(F.col("proof")))
    return found.select(rows.columns[0], "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
