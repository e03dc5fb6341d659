"""SimHash groups through pivot tables, against plain hashing and all pairs."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import types as T

from runatlas.llm import simhash_pivots as sp
from runatlas.llm.scratch import Scratch


def plain_fingerprint(text: str | None) -> int:
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(space, " ")
    words = [w for w in lowered.split(" ") if w]
    runs = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    values = [xxhash.xxh64(r.encode(), seed=42).intdigest() for r in runs]
    return sum(1 << k for k in range(64) if 2 * sum(v >> k & 1 for v in values) > len(values))


def plain_groups(ids: list, prints: list[int], bits: int = 3) -> list:
    group = list(range(len(prints)))

    def top(i: int) -> int:
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                group[top(i)] = top(j)
    least = {}
    for i, id_ in enumerate(ids):
        if id_ is not None:
            least[top(i)] = min(least.get(top(i), id_), id_)
    return [least.get(top(i)) for i in range(len(ids))]


@pytest.mark.parametrize(
    "text",
    ["", "  \n", "one", "One TWO", "a b c", "a b c a b c a b c", "ÀB c d É\x1ff g", "\x0bx\x0cy\rz w", "x" * 50 + " " + "tail " * 7],
)
def test_a_fingerprint_is_that_of_plain_hashing(text):
    assert sp.simhash(text.encode()) == plain_fingerprint(text)


@pytest.mark.parametrize("block", [1, 2, 7, 64])
def test_blocks_do_not_show(monkeypatch, block):
    rng = random.Random(3)
    monkeypatch.setattr(sp, "BLOCK_BYTES", block)
    for n in (0, 1, 2, 3, 4, 50):
        text = " ".join(rng.choice(["a", "bb", "ccc", "é"]) * rng.randint(1, 3) for _ in range(n)) + " " * rng.randint(0, 2)
        assert sp.simhash(text.encode()) == plain_fingerprint(text)


def test_groups_of_texts_equal_brute_force(spark):
    rng = random.Random(5)
    texts = []
    for _ in range(40):
        words = [f"w{rng.randint(0, 400)}" for _ in range(rng.choice([2, 30, 150, 400]))]
        texts.append(" ".join(words))
        for _ in range(rng.choice([0, 1, 3])):
            changed = list(words)
            changed[rng.randrange(len(changed))] = "other"
            texts.append(rng.choice([" ".join(words), " ".join(changed), " ".join(words).upper()]))
    texts += [None, "", " ", "x", "X", "x"]
    ids = [*range(100, 100 + len(texts) - 3), None, 7, 7]
    rows = [(i, t, "clash", 1.0) for i, t in zip(ids, texts, strict=True)]
    schema = T.StructType.fromDDL("doc_id long, text string, fp string, component_id double")
    out = sp.near_duplicate_groups(spark.createDataFrame(rows, schema)).collect()
    prints = [plain_fingerprint(t) for t in texts]
    expected = zip(ids, (f"{p:016x}" for p in prints), plain_groups(ids, prints), strict=True)
    assert sorted(map(tuple, out), key=str) == sorted(expected, key=str)


def clouds(seed: int, n: int) -> list[int]:
    """Random fingerprints; those around a few centres differ from them in up to six of some weak bits."""
    rng = random.Random(seed)
    out = {rng.getrandbits(64) for _ in range(n)}
    for _ in range(3):
        centre, weak = rng.getrandbits(64), rng.sample(range(64), 14)
        for _ in range(n):
            out.add(centre ^ sum(1 << k for k in rng.sample(weak, rng.randint(0, 6))))
    return sorted(out)


@pytest.mark.parametrize(("bits", "crowded"), [(3, 128), (3, 64), (1, 64), (5, 64)])
def test_links_connect_what_all_pairs_connect_in_crowded_cells(spark, monkeypatch, bits, crowded):
    monkeypatch.setattr(sp, "CROWDED", crowded)
    monkeypatch.setattr(sp, "COMPARED_ROWS", 300)
    prints = clouds(bits, 600)
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    frame = spark.createDataFrame([(s,) for s in signed], "fp long")
    scratch = Scratch(spark, "test")
    edges = [tuple(r) for r in sp.links(frame, scratch, bits).collect()]
    assert all(((a ^ b) & (2**64 - 1)).bit_count() >= 1 for a, b in edges)
    label = {s: s for s in signed}

    def top(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in edges:
        label[top(a)] = top(b)
    found = plain_groups(signed, prints, bits)
    by_top = {}
    for s in signed:
        by_top.setdefault(top(s), []).append(s)
    assert [min(by_top[top(s)]) for s in signed] == found


def test_no_pair_is_discarded_wrongly_and_most_of_the_others_are(spark):
    rng = np.random.default_rng(1)
    fp = rng.integers(0, 2**64, 400, dtype=np.uint64)
    fp[200:] = fp[:200] ^ np.uint64(0b1011)
    a, b = sp.linked_pairs(np.zeros(400, np.int64), fp, 3)
    pairs = {tuple(sorted(map(int, p))) for p in zip(a, b, strict=True)}
    assert pairs == {(i, j) for i in range(400) for j in range(i + 1, 400) if int(fp[i] ^ fp[j]).bit_count() <= 3}
    table = sp.distances(fp, 2**64 - 1).astype(int)
    kept = (np.abs(table[:, None] - table[None]) <= 3).all(axis=2).sum()
    assert kept < 3 * 400


def test_empty_table(spark):
    assert sp.near_duplicate_groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("n", [1, 10**6, 10**9, 10**12])
def test_bands_leave_small_cells(n):
    bands = sp.bands_for(n, 3)
    assert n / 2 ** (64 * (bands - 3) / bands) < 20
