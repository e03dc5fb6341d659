"""The conversation trie against one made of plain dictionaries."""

import hashlib
import random
import re
import zlib

import pytest

from runatlas.llm import prefix_trie, queries

SCHEMA = "conv_id long, turn long, role string, text string, depth int, `a.b` map<string,int>"


def plain_trie(paths: dict[int, tuple]) -> list[tuple]:
    members = {}
    for conv, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(conv)
    rows = []
    for node, convs in members.items():
        inside = [n for n in members if n[: len(node)] == node]
        saved = sum((len(members[n]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) for n in inside if n)
        parents = {n[:-1] for n in members if n}
        ends = ",".join(map(str, sorted(c for c in convs if len(paths[c]) == len(node))))
        rows.append(
            (
                min(convs),
                len(node),
                min(members[node[:-1]]) if node else None,
                len(convs),
                sum(n[:-1] == node for n in members if n),
                sum(n not in parents for n in inside),
                saved,
                hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(rows, key=str)


def ordered(rows: list[tuple]) -> dict[int, list[tuple]]:
    convs = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            convs.setdefault(conv, []).append((turn, role or "", text or ""))
    key = lambda t: (t[0] is not None, t[0] or 0, t[1], hashlib.md5(t[2].encode()).hexdigest())
    return {c: [t[1:] for t in sorted(turns, key=key)] for c, turns in convs.items()}


def rebuilt(convs: dict[int, list[tuple]]) -> dict[int, tuple]:
    out = {}
    for conv, turns in convs.items():
        h = zlib.crc32(str(conv).encode()) % 4
        base = conv - (conv % 20 if conv >= 0 else -(-conv % 20))
        out[conv] = tuple(convs.get(base, [])[:h] + turns[h:])
    return out


def random_rows(seed: int, convs: list[int], longest: int) -> list[tuple]:
    rng = random.Random(seed)
    rows = []
    for conv in convs:
        # Few different turns, so prefixes are shared at every depth.
        n = rng.choice([1, 2, 3, 5, 8, 9, 16, 17, longest])
        style = rng.randint(1, 2)
        rows += [(conv, t, rng.choice(["user", "user", None]), rng.choice(["", "a", "a b\tc", None][:style]), 1, None) for t in range(n)]
    return rows


def found(spark, tmp_path, rows):
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    out = queries.op13_prefix_trie(spark, str(tmp_path))
    assert out.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(map(tuple, out.collect()), key=str)


@pytest.mark.parametrize(("seed", "piece", "chunk"), [(1, 512, 4096), (2, 2, 3), (3, 1, 1)])
def test_trie_equals_a_plain_one(spark, tmp_path, monkeypatch, seed, piece, chunk):
    monkeypatch.setattr(prefix_trie, "PIECE", piece)
    monkeypatch.setattr(prefix_trie, "CHUNK", chunk)
    rows = random_rows(seed, [*range(45), *range(100, 130, 3), -7, -20, -23, 10**12], 50)
    assert found(spark, tmp_path, rows) == plain_trie(rebuilt(ordered(rows)))


def test_nulls_ties_and_repeated_rows(spark, tmp_path):
    rng = random.Random(8)
    pick = lambda *values: rng.choice([None, *values])
    rows = [(pick(0, 1, 2, 3, 20, 41), pick(0, 1, 2), pick("user", ""), pick("", "word " * 3, "\x1c é"), 1, None) for _ in range(300)]
    assert found(spark, tmp_path, rows + rows[:50]) == plain_trie(rebuilt(ordered(rows + rows[:50])))


def test_conversations_as_they_are_and_emptied_ones(spark, tmp_path):
    rows = [(c, t, "user", f"x{t}", 1, None) for c in range(60) for t in range(c % 3)] + [(19, 0, "user", "x", 1, None)]
    frame = spark.createDataFrame(rows, SCHEMA)
    out = sorted(map(tuple, prefix_trie.conversation_trie(frame).collect()), key=str)
    assert out == plain_trie({c: tuple(t) for c, t in ordered(rows).items()})
    # Without a base conversation, a short one loses all its turns and ends in the root.
    rows = [(c, 0, "user", "x", 1, None) for c in range(1, 15)]
    plain = rebuilt(ordered(rows))
    assert any(not path for path in plain.values())
    assert found(spark, tmp_path, rows) == plain_trie(plain)


def test_empty_table(spark, tmp_path):
    assert found(spark, tmp_path, []) == []
    assert prefix_trie.conversation_trie(spark.createDataFrame([(None, 0, "user", "x", 1, None)], SCHEMA)).count() == 0


def test_one_conversation_with_many_turns_is_spread(spark):
    """A conversation of 20,000 turns is one row a block, and its owner's sums come from several pieces."""
    frame = spark.range(20_000).selectExpr("1L as conv_id", "id as turn", "'user' as role", "concat('w ', id) as text")
    frame = frame.union(frame.filter("turn < 15000").selectExpr("2L", "turn", "role", "text"))
    out = prefix_trie.conversation_trie(frame)
    assert out.count() == 20_001
    rows = {r.depth: r for r in out.filter("depth in (0, 1, 14999, 15000, 15001, 20000)").collect()}
    assert rows[0].saved_tokens == 30_000 and rows[1].saved_tokens == 30_000 and rows[14999].saved_tokens == 4
    assert rows[15000].saved_tokens == 2 and rows[15001].saved_tokens == 0
    assert all(r.n_leaves == 1 and r.conv_id == 1 for r in rows.values())
    assert rows[15000].ends_sha256 == hashlib.sha256(b"2").hexdigest()
