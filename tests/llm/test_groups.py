"""Components, Jaccard groups and spot signatures against brute force."""

import hashlib
import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("runatlas.llm")

from runatlas.llm import jaccard_join, spot_signatures
from runatlas.llm.components import connected_components
from runatlas.llm.scratch import Scratch
from runatlas.llm.wordgrid import ALNUM, NOT_SPACE, find_words, hash_spans, shingle_hashes, text_slices

SCHEMA = "doc_id long, text string, token string, n string, component string"


def least_reachable(nodes, links):
    parent = {n: n for n in nodes}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def documents():
    """Families of near copies (one of more than 16), copies, short and empty texts, a repeated id."""
    draw = random.Random(5)
    vocabulary = ["".join(draw.choices("abcdefgh", k=6)) for _ in range(400)]
    rows, number = [], 0
    for size, words, edits in ((60, 80, 3), (5, 300, 8), (9, 40, 1), (4, 12, 1), (3, 5, 0)):
        base = draw.choices(vocabulary, k=words)
        for _ in range(size):
            text = list(base)
            for _ in range(draw.randint(0, edits)):
                text[draw.randrange(words)] = draw.choice(vocabulary)
            rows.append((number, " ".join(text)))
            number += 3
    rows += [(number + k, t) for k, t in enumerate([None, "", " \t\n", "One two", "one  TWO", "one", rows[0][1], rows[0][1]])]
    rows += [(7, "alone here " + " ".join(vocabulary[:9])), (7, rows[70][1]), (rows[3][0], rows[3][1])]
    return [(i, t, "x", "y", "z") for i, t in rows]


def test_components_are_those_of_union_find(spark):
    draw = random.Random(1)
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(draw.randrange(200, 300), draw.randrange(200, 300)) for _ in range(60)]
    frame = spark.createDataFrame([*edges, (5, None), (None, None), (900, 900)], "a long, b long")
    got = {r.node: r.component for r in connected_components(frame, Scratch(spark, "t")).collect()}
    nodes = {n for e in edges for n in e if e[0] != e[1]}
    assert got == least_reachable(nodes, edges)
    assert connected_components(frame.limit(0), Scratch(spark, "t")).count() == 0


def test_jaccard_groups_are_whole(spark):
    rows = documents()
    got = sorted(tuple(r) for r in jaccard_join.near_duplicate_groups(spark.createDataFrame(rows, SCHEMA)).collect())
    sets = [(r[0], shingles(r[1])) for r in rows]
    links = [
        (i, j)
        for k, (i, a) in enumerate(sets)
        for j, b in sets[:k]
        if a and 100 * len(a & b) >= 80 * len(a | b)
    ]
    least = least_reachable({i for i, _ in sets}, links)
    assert got == sorted((i, len(s), least[i]) for i, s in sets)


def test_jaccard_groups_of_null_ids_and_empty_table(spark):
    frame = spark.createDataFrame([(None, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f")], "doc_id long, text string")
    got = {tuple(r) for r in jaccard_join.near_duplicate_groups(frame).collect()}
    assert got == {(None, 2, None), (1, 2, 1), (2, 2, 1)}
    assert jaccard_join.near_duplicate_groups(frame.limit(0)).count() == 0


def test_hashes_follow_words_only():
    column = pa.array(["One two  three", None, "x" * 300_000 + " two", "", "two"])
    for limit in (8, 1 << 20):
        found = []
        for _, _, data, offsets in text_slices(column, limit):
            words = find_words(data, offsets, NOT_SPACE)
            hashes = words.hashes()
            found += [hashes[a:b].tolist() for a, b in zip(words.first, words.first[1:], strict=False)]
        assert [len(f) for f in found] == [3, 0, 2, 0, 1]
        assert found[0][1] == found[2][1] == found[4][0]
    long = np.frombuffer(b"ab" * 1_200_000 + b" cd", dtype=np.uint8)
    spans = hash_spans(long, np.array([0, 2_400_001]), np.array([2_400_000, 2_400_003]))
    assert spans[1] == hash_spans(np.frombuffer(b"cd", dtype=np.uint8), np.array([0]), np.array([2]))[0]


def test_short_sequences_differ_from_each_other():
    seen = set()
    for text in ("a", "a a", "a a a", "a a a a", "a a a a a", "b a", "a b"):
        data = np.frombuffer(text.encode(), dtype=np.uint8)
        words = find_words(data, np.array([0, len(data)]), NOT_SPACE)
        seen.add(int(shingle_hashes(words, words.hashes(), 5)[0][0]))
    assert len(seen) == 7


def test_fingerprints_follow_the_contract(spark):
    rows = [(r[0], r[1]) for r in documents()] + [(5000, "The cat sat on the mat. 😀 " * 4), (5001, "?!"), (None, "of the night")]
    got = spot_signatures.fingerprints(spark.createDataFrame(rows, "doc_id long, text string"), parts=5).collect()
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    sets = {t: s for t, (_, s) in zip([t for _, t in order], spot_signatures.spot_sets(pa.array([t for _, t in order])), strict=True)}
    want = []
    for (i, text), (_, following) in zip(order, [*order[1:], order[0]], strict=True):
        edited = spot_signatures.edited(text, following)
        other = next(spot_signatures.spot_sets(pa.array([edited])))[1]
        want.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), spot_signatures.fingerprint(sets[text]), round(spot_signatures.likeness(sets[text], other), 9), round(spot_signatures.likeness(sets[text], sets[following]), 9)))
    found = [(r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, round(r.near_edited, 9), round(r.near_next, 9)) for r in got]
    assert sorted(found, key=repr) == sorted(want, key=repr)


def test_fingerprints_of_one_and_of_no_document(spark):
    one = spark.createDataFrame([(1, "A house by the sea")], "doc_id long, text string")
    row = spot_signatures.fingerprints(one).first()
    assert row.near_next == 1.0 and row.n_chars == 18
    assert spot_signatures.fingerprints(one.limit(0)).count() == 0


def test_signatures_see_edits_at_any_place():
    words = [f"word{k}" if k % 3 else "the" for k in range(300)]
    changed = [*words[:250], *[f"other{k}" for k in range(50)]]
    a, b, c = (s for _, s in spot_signatures.spot_sets(pa.array([" ".join(words), " ".join(changed), "ñandú " * 30])))
    assert 0.5 < spot_signatures.likeness(a, b) < 1.0 and len(c)
    assert spot_signatures.likeness(a, a) == 1.0 and spot_signatures.likeness(a, a[:10], at_least=0.5) == 0.0


def plain_signatures(text):
    """(anchor, content word, content word) of a text, found word by word."""
    words = re.findall(r"[0-9A-Za-z\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    common = set(spot_signatures.COMMON.split())
    out = set()
    for i in range(-1, len(words)):
        anchor = words[i] if i >= 0 else ""
        if i >= 0 and anchor not in common:
            lonely = not any(w in common for w in words[max(0, i - spot_signatures.REACH) : i])
            data = np.frombuffer(anchor.encode(), dtype=np.uint8)
            if not lonely or int(find_words(data, np.array([0, len(data)]), ALNUM).hashes()[0]) % 8:
                continue
        content = [w for w in words[i + 1 :] if w not in common][:2]
        if content:
            out.add((anchor, *content))
    return out


def test_signatures_equal_plain_ones():
    draw = np.random.default_rng(3)
    rare = [f"word{k}" for k in range(80)] + ["Ñandú", "中文", "x1"]
    texts = ["", "the of", "a", "House"]
    for n in (3, 40, 120, 300):
        for share in (0.0, 0.02, 0.1, 0.5):
            texts.append(" ".join(draw.choice(["the", "und", "Es"]) if draw.random() < share else draw.choice(rare) for _ in range(n)))
    texts += [t + " tail of it" for t in texts]
    sets = [s for _, s in spot_signatures.spot_sets(pa.array(texts))]
    plain = [plain_signatures(t) for t in texts]
    assert [len(s) for s, p in zip(sets, plain, strict=True) if p] == [len(p) for p in plain if p]
    for i, j in itertools.combinations(range(len(texts)), 2):
        if plain[i] and plain[j]:
            want = len(plain[i] & plain[j]) / len(plain[i] | plain[j])
            assert spot_signatures.likeness(sets[i], sets[j]) == pytest.approx(want)


@pytest.mark.parametrize("n_common", range(0, 40))
def test_one_more_common_word_changes_signatures_near_it_only(n_common):
    words = [f"word{k}" for k in range(500)]
    for k in range(n_common):
        words[(k * 37 + 11) % 500] = "the"
    more = [*words[:250], "the", *words[250:]]
    a, b = (s for _, s in spot_signatures.spot_sets(pa.array([" ".join(words), " ".join(more)])))
    shared = len(np.intersect1d(a, b))
    # The new anchor, those that the signatures over its place had, and hashed anchors within its reach.
    assert len(a) + len(b) - 2 * shared <= 3 + spot_signatures.REACH
    assert spot_signatures.likeness(a, b) > 0.6


def test_similar_groups_of_spots(spark):
    rows = [(r[0], r[1]) for r in documents() if r[1] and r[1].strip()]
    rows = list({i: (i, t) for i, t in rows}.values())
    got = {r.node: r.component for r in spot_signatures.similar_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = [(rows[k][0], set(s.tolist())) for k, s in spot_signatures.spot_sets(pa.array([t for _, t in rows]))]
    links = [(i, j) for k, (i, a) in enumerate(sets) for j, b in sets[:k] if a and 100 * len(a & b) >= 80 * len(a | b)]
    least = least_reachable({i for i, _ in sets}, links)
    assert all(got.get(i, i) == c for i, c in least.items())
