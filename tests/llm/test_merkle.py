"""The Merkle manifest against a plain one, at sizes around full runs and stored levels."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from runatlas.llm import merkle_manifest, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, pos int, `a.b` map<string,int>"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(doc_id, source, lang, n_chars, text) -> str:
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def plain_tree(leaves: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """Root, and for each leaf the siblings before and after at each level."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([digest("".join(low[i : i + 8])) for i in range(0, len(low), 8)])
    proofs = []
    for i in range(len(leaves)):
        proof, at = [], i
        for low in levels[:-1]:
            first = at - at % 8
            proof.append(("".join(low[first:at]), "".join(low[at + 1 : first + 8])))
            at //= 8
        proofs.append(proof)
    return levels[-1][0], proofs


def expected(rows: list[tuple]) -> list[tuple]:
    groups = {}
    for doc_id, text, lang, source, n_chars, *_ in rows:
        leaf = plain_leaf(doc_id, source, lang, n_chars, text)
        claim = leaf
        if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0 and text is not None:
            lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
            claim = plain_leaf(doc_id, source, lang, n_chars, lowered)
        groups.setdefault(lang, []).append((doc_id, leaf, claim))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees[g] = plain_tree([r[1] for r in groups[g]])
    if not names:
        return []
    root, above = plain_tree([trees[g][0] for g in names])
    out = []
    for g, up in zip(names, above, strict=True):
        subroot, proofs = trees[g]
        for (doc_id, leaf, claim), proof in zip(groups[g], proofs, strict=True):
            fold = claim
            for before, after in proof + up:
                fold = digest(before + fold + after)
            seen = "".join(b + a for b, a in proof + up)
            out.append((doc_id, leaf, subroot, root, digest(seen), fold, fold == root))
    return out


def written(spark, tmp_path, rows):
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    out = queries.op12_merkle_manifest(spark, str(tmp_path))
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(map(tuple, out.collect()), key=str)


@pytest.mark.parametrize("sizes", [[], [1], [1, 1], [8], [9, 1, 2], [64, 65, 7, 8, 1, 1, 1, 1, 1, 1], [511, 513], [512, 4100]])
def test_manifest_equals_a_plain_one(spark, tmp_path, sizes):
    rng = random.Random(sum(sizes))
    rows, at = [], 0
    for g, n in enumerate(sizes):
        for _ in range(n):
            rows.append((at, rng.choice(["", "Text é", "low", f"X{at}"]), "zaßcdefghijk"[g], rng.choice(["web", ""]), at % 5, 1, {"k": 1}))
            at += 1
    assert written(spark, tmp_path, rows) == sorted(expected(rows), key=str)


def test_nulls_ties_and_repeated_rows(spark, tmp_path):
    rng = random.Random(4)
    pick = lambda *values: rng.choice([None, *values])
    rows = [(pick(*range(-4, 9), 10**12), pick("", "A", "b", "long " * 500), pick("", " ", "!", "é", "z"), pick("s", ""), pick(0, 7), None, None) for _ in range(400)]
    rows += rows[:40]
    found = written(spark, tmp_path, rows)
    assert found == sorted(expected(rows), key=str)
    assert any(r[-1] for r in found) and not all(r[-1] for r in found)


def test_a_change_of_any_field_is_seen_and_only_there(spark):
    rows = [(i, f"Text {i}", "en", None, 5, 0, None) for i in range(70)]
    docs = spark.createDataFrame(rows, SCHEMA)
    for field, value in (("text", F.lit("other")), ("source", F.lit("")), ("n_chars", F.lit(None).cast("long"))):
        changed = F.when(F.col("doc_id") == 33, value).otherwise(F.col(field))
        out = merkle_manifest.verify(docs, {field: changed}).filter("not verified").collect()
        assert [r.doc_id for r in out] == [33]


def test_interior_levels_are_not_written(spark, tmp_path):
    """Of the four levels over 600 leaves only those in steps of three are stored."""
    rows = [(i, "t", "en", None, 1, 0, None) for i in range(600)]
    leaves = spark.createDataFrame(rows, SCHEMA).select(
        F.lit("en").alias("tree"), F.lit(600).cast("long").alias("size"), F.col("doc_id").alias("pos"), F.sha2(F.col("doc_id").cast("string"), 256).alias("hash")
    )
    scratch = merkle_manifest.Scratch(spark, "test")
    levels, roots = merkle_manifest.build(leaves, scratch, "t")
    assert [d.count() for d in levels] == [600, 2]
    assert roots.first().hash == plain_tree([digest(str(i)) for i in range(600)])[0]
