"""The corpus pipeline on planted cases."""

import random

import pytest

pytest.importorskip("runatlas.llm")
corpus_pipeline = pytest.importorskip("corpus_pipeline")

from tokenizers import Tokenizer

from runatlas.llm.scratch import Scratch


@pytest.fixture(scope="module")
def planted(tmp_path_factory, spark):
    draw = random.Random(9)
    lists = {"en": "the and of with river stone window garden people".split(), "de": "der und mit Fluss Stein Fenster Garten Leute nicht".split()}
    rows = []

    def text(lang, n=120):
        return " ".join(draw.choice(lists[lang]) + draw.choice(["", "s", "er", "ing", "lich"]) for _ in range(n))

    for k in range(40):
        lang = "en" if k % 2 else "de"
        rows.append((k, text(lang), lang))
    rows += [(100, rows[3][1], "en"), (101, rows[3][1] + " end", "en"), (102, None, "en"), (103, "12 34", "en"), (104, "", None)]
    leak = text("en", 40)
    rows += [(105, text("en") + " " + leak + " " + text("en"), "en"), (106, text("de") + " password=b7db7aa4a5fcc78305 und", "de")]
    rows += [(None, text("de"), "de"), (5, rows[5][1], "en")]
    folder = tmp_path_factory.mktemp("sf")
    docs = spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, leak), (2, text("de", 30))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), rows


def test_every_stage_does_its_work(spark, planted):
    folder, rows = planted
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, scratch, kept = docs.columns, Scratch(spark, "t"), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = scratch.save(stage(spark, docs, folder), name)
        kept[name] = docs.collect()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    ids = {name: sorted((r.doc_id is None, r.doc_id) for r in found) for name, found in kept.items()}
    known = [(i is None, i) for i, t, _ in rows if t and any(c.isalpha() for c in t)]
    assert ids["language"] == sorted(known)
    assert ids["near_duplicates"] == sorted(x for x in set(known) if x[1] not in (100, 101))
    assert ids["decontamination"] == [x for x in ids["near_duplicates"] if x[1] != 105]
    assert ids["secrets"] == ids["encoding"] == ids["decontamination"]
    masked = next(r for r in kept["secrets"] if r.doc_id == 106)
    assert "b7db7aa4" not in masked.text and "<secret>" in masked.text and masked.n_chars == len(masked.text)
    before = {r.doc_id: r for r in kept["decontamination"]}
    assert all(r == before[r.doc_id] for r in kept["secrets"] if r.doc_id != 106)
    library = Tokenizer.from_file(__import__("public_tokenizers").path("word_bpe_49k.json"))
    texts = {r.doc_id: r.text for r in kept["secrets"]}
    assert all(r.ids == library.encode(texts[r.doc_id], add_special_tokens=False).ids for r in kept["encoding"])


def test_rows_are_judged_by_their_own_text(spark, tmp_path):
    draw = random.Random(4)
    words = ["".join(draw.choices("abcdefghijkl", k=6)) for _ in range(500)]
    texts = [" ".join(draw.choices(words, k=80)) for _ in range(6)]
    leak = " ".join(draw.choices(words, k=40))
    rows = [
        (1, texts[0], "a"), (1, texts[1], "b"), (1, texts[2] + " end", "c"), (0, texts[2], "d"),
        (None, texts[3], "e"), (None, texts[3] + " end", "f"), (None, texts[0] + " end", "g"),
        (None, leak, "h"), (2, texts[4], "i"), (2, texts[5] + " " + leak, "j"), (3, "", "k"), (3, "", "l"), (4, "", "m"), (None, "", "n"), (None, None, "o"),
        (5, texts[4], "p"), (5, texts[4], "p"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    assert "".join(sorted(r.source for r in kept.collect())) == "abdehijkmno"
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    clean = corpus_pipeline.drop_benchmark_leaks(spark, kept, str(tmp_path))
    assert clean.columns == docs.columns and "".join(sorted(r.source for r in clean.collect())) == "abdeikmno"


def test_run_gives_the_last_stage(spark, planted):
    folder, _ = planted
    found = corpus_pipeline.run(spark, folder)
    assert "ids_sha256" in found.columns and found.count() == 42


def test_queries_are_registered():
    import __spark_entry__

    names = [n for n in __spark_entry__.queries() if n.startswith("op")]
    assert {int(n[2:].split("_")[0]) for n in names} == set(range(1, 14)) and "pipeline" in __spark_entry__.queries()
