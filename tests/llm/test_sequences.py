"""Language mixtures and transcripts."""

import itertools
import zlib

import numpy as np
import pytest

pytest.importorskip("runatlas.llm")

from runatlas.llm import chat_format, language_mix

SF = "/root/testdata/sf0.001"


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.collect()}
    more = spark.createDataFrame([(90_000, None, "en"), (90_001, "", "en"), (90_002, "123 ?!", "fr"), (None, "and the", None), (90_003, "ǅ", "x")], "doc_id long, text string, lang string")
    found = language_mix.predict_languages(docs.select("doc_id", "text", "lang").union(more)).collect()
    rows = {r.doc_id: r for r in found}
    assert len(found) == len(truth) + 5
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    unseen = [r for r in found if r.held_out and r.doc_id in truth]
    assert np.mean([truth[r.doc_id] == r.lang_pred for r in unseen]) > 0.97
    assert [(rows[i].lang_pred, rows[i].score) for i in (90_000, 90_001, 90_002)] == [("und", 0.0)] * 3
    assert all(0 <= r.score <= 1 for r in found) and rows[None].lang_pred != "und"


def test_nothing_learned_and_nothing_given(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [tuple(r)[2:4] for r in language_mix.predict_languages(docs).collect()] == [("und", 0.0)]
    assert language_mix.predict_languages(docs.limit(0)).count() == 0


def test_mixtures_are_found(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("text", "lang")
    model = language_mix.learn(docs)
    texts = {r.lang: r.text for r in docs.filter("length(text) > 1500").collect()}
    mixed = texts["en"][:1000] + "\n" + texts["de"][:1000]
    row = language_mix.predict(spark.createDataFrame([(1, mixed)], "doc_id long, text string"), model).first()
    assert set(row.proportions) == {"en", "de"} and 0.35 < row.score < 0.65
    beside = language_mix.predict_beside(spark.createDataFrame([("b", mixed, 7)], "lang_pred string, text string, x int"), model).first()
    assert (beside.x, beside.score) == (7, row.score)


def test_every_labelled_language_is_learned(spark):
    draw = np.random.default_rng(6)
    names = [f"l{k:02d}" for k in range(70)]
    rows = []
    for k, name in enumerate(names):
        words = ["".join(draw.choice(list("abcdefghijklmnopqrstuvwxyz"), 7)) for _ in range(12)]
        rows.append((k, " ".join(draw.choice(words, 400 - 5 * k)), name))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = language_mix.predict(docs, language_mix.learn(docs)).collect()
    assert {r.doc_id: r.lang_pred for r in found} == {k: name for k, _, name in rows}


def test_four_languages_of_one_text_are_all_kept(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("text", "lang")
    model = language_mix.learn(docs)
    texts = {r.lang: r.text for r in docs.filter("length(text) > 1500").collect()}
    mixed = "\n".join(texts[k][:1000] for k in ("fr", "en", "de", "es"))
    row = language_mix.predict(spark.createDataFrame([(1, mixed)], "doc_id long, text string"), model).first()
    assert set(row.proportions) == {"fr", "en", "de", "es"}
    assert all(0.15 < share < 0.35 for share in row.proportions.values())


def plain_mixture(likelihood, rounds=4000):
    """``likelihood``: words x languages."""
    p = np.full(likelihood.shape[1], 1 / likelihood.shape[1])
    for _ in range(rounds):
        w = likelihood * p
        p = (w / w.sum(axis=1, keepdims=True)).mean(axis=0)
    return p, np.log((likelihood * p).sum(axis=1)).sum()


def test_expectation_maximisation_by_hand():
    draw = np.random.default_rng(0)
    likelihood, bounds = draw.random((30, 3)) + 0.01, np.array([0, 10, 30])
    share, value, above = language_mix._mixture(likelihood.T.copy(), bounds)
    for d, (a, b) in enumerate([(0, 10), (10, 30)]):
        _, highest = plain_mixture(likelihood[a:b])
        found = np.log(likelihood[a:b] @ share[:, d]).sum()
        assert np.isclose(share[:, d].sum(), 1.0) and np.isclose(value[d], found)
        assert value[d] <= highest + 1e-9 and highest <= value[d] + above[d] + 1e-9
        assert above[d] <= language_mix.NEAR * language_mix.PENALTY * np.log(b - a + 1.0)


def test_the_set_with_the_highest_penalised_likelihood_is_chosen():
    draw = np.random.default_rng(4)
    sizes = set()
    for n_true in (1, 2, 3, 4, 5, 6) * 3:
        n_words = int(draw.integers(60, 600))
        logs = -draw.exponential(6.0, (6, n_words))
        logs[draw.integers(0, n_true, n_words), np.arange(n_words)] = 0.0
        logs -= logs.max(axis=0)
        penalty = language_mix.PENALTY * np.log(n_words + 1.0)
        got = language_mix._select(logs, np.array([0, n_words]), logs.sum(axis=1)[:, None])[:, 0]
        kept = np.flatnonzero(got)
        reached = plain_mixture(np.exp(logs[kept]).T)[1] - penalty * (len(kept) - 1)
        # The sets are those that follow the order of the proportions of all.
        order = np.argsort(-plain_mixture(np.exp(logs).T)[0], kind="stable")
        single = logs.sum(axis=1).max()
        best = max(single, *(plain_mixture(np.exp(logs[order[:k]]).T)[1] - penalty * (k - 1) for k in range(2, 7)))
        assert best - reached <= 2 * language_mix.NEAR * penalty
        sizes.add(len(kept))
    assert max(sizes) > 3


def some_model():
    draw = np.random.default_rng(1)
    size = len(chat_format.STATES)
    return chat_format.Model(draw.integers(1, 50, size), draw.integers(1, 50, (size, size)), [draw.integers(1, 50, (size, v)) for v in chat_format.FEATURES])


def test_viterbi_is_the_best_of_all_paths_and_of_any_cut():
    model = some_model()
    lines = ["User: hi?", "", "more words here.", "Assistant: yes", "a b c d e f", "[system] x", "?"]
    emissions = model.emissions(lines, None)

    def score(path):
        total = model.start[path[0]] + emissions[0, path[0]]
        for n in range(1, len(path)):
            total += model.move[path[n - 1], path[n]] + emissions[n, path[n]]
        return total

    best = model.decode(emissions, None, None)
    short = model.decode(emissions[:5], None, None)
    assert np.isclose(score(short), max(score(p) for p in itertools.product(range(6), repeat=5)))
    for cuts in ([2], [1, 2, 5], [3, 6]):
        edges = [0, *cuts, len(lines)]
        parts = [emissions[a:b] for a, b in itertools.pairwise(edges)]
        leave = chat_format.border_states([model.matrix(p, k == 0) for k, p in enumerate(parts)])
        entries = [None, *leave[:-1]]
        assert [s for p, e, x in zip(parts, entries, leave, strict=True) for s in model.decode(p, e, x)] == best


def test_roles_are_recovered(spark):
    conversations = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    truth = {}
    for r in sorted(conversations.collect(), key=lambda r: (r.conv_id, r.turn)):
        truth.setdefault(r.conv_id, []).append((r.role, chat_format.render(r.role, r.text.strip("\n"))))
    found = {}
    for r in sorted(chat_format.format_conversations(conversations).collect(), key=lambda r: (r.conv_id, r.segment, r.turn)):
        found.setdefault(r.conv_id, []).append((r.role, r.rendered))
    unseen = [k for k in truth if zlib.crc32(str(k).encode()) % 4 == 2]
    assert set(found) == set(truth) and np.mean([found[k] == truth[k] for k in unseen]) > 0.9


def test_segments_do_not_change_the_parse(spark, monkeypatch):
    turns = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    raw = chat_format.raw_transcripts(turns)
    model = chat_format.learn(raw.withColumn("conv", raw["conv_id"].cast("string")))

    def roles():
        out = {}
        for r in sorted(chat_format.parse_transcripts(raw, model).collect(), key=lambda r: (r.conv_id, r.segment, r.turn)):
            out.setdefault(r.conv_id, []).extend([] if r.continued else [r.role])
        return out

    whole = roles()
    monkeypatch.setattr(chat_format, "SEGMENT", 2)
    assert roles() == whole


def test_turns_over_borders_are_whole(spark, monkeypatch):
    turns = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    raw = chat_format.raw_transcripts(turns)
    model = chat_format.learn(raw.withColumn("conv", raw["conv_id"].cast("string")))
    lines = [(1, k, "Assistant: it begins" if k == 2 else "and goes on with more words") for k in range(9)]
    lines += [(None, None, f"User: is it {k}?") for k in range(20)] + [(2, k, "User: yes?" if k % 2 else "Assistant: no.") for k in range(9)]
    pieces = spark.createDataFrame(lines, "conv_id long, position long, text string")

    def rows():
        found = chat_format.parse_transcripts(pieces, model).collect()
        return sorted([(r.conv_id or 0, r.turn, r.role, r.continued, r.n_lines, r.rendered) for r in found])

    whole = rows()
    assert max(r[4] for r in whole) > 3
    monkeypatch.setattr(chat_format, "SEGMENT", 2)
    assert rows() == whole
    dealt, _ = chat_format._pieces(pieces.select(chat_format._key(pieces["conv_id"]).alias("conv"), "position", "text"), False, chat_format.Scratch(spark, "t"))
    assert max(r["count"] for r in dealt.groupBy("conv", "segment").count().collect()) == 2


def test_odd_transcripts(spark):
    rows = [(1, 0, "User: a"), (1, 0, "User: a"), (1, None, None), (None, 1, "hello"), (2, 5, "")]
    pieces = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, position long, text string, segment string")
    found = chat_format.parse_transcripts(pieces, some_model()).collect()
    assert {r.conv_id for r in found} == {1, 2, None}
    assert sum(r.n_lines for r in found if r.conv_id == 1) == 2
    assert chat_format.parse_transcripts(pieces.limit(0), some_model()).count() == 0
