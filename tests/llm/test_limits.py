"""What the workers of the operators hold, and what they do more than once."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("runatlas.llm")
public_tokenizers = pytest.importorskip("public_tokenizers")

from runatlas.llm import decontaminate
from runatlas.llm.word_bpe import WordBpe
from runatlas.llm.wordgrid import text_slices


def test_block_maxima_are_summed_in_pieces():
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(2000)]
    index = decontaminate.build_index([(i, " ".join(rng.choice(words, 64))) for i in range(400)])
    text = pa.array([" ".join(rng.choice(words, 100_000))])
    _, _, data, offsets = next(text_slices(text))
    tracemalloc.start()
    try:
        decontaminate.passages(index, data, offsets, 0.6)
        assert tracemalloc.get_traced_memory()[1] < 50 << 20  # all maxima at once are 75 MB
    finally:
        tracemalloc.stop()


def test_slices_of_texts_hold_a_megabyte():
    slices = list(text_slices(pa.array(["x" * 300_000] * 12)))
    assert len(slices) == 4 and slices[-1][1] == 12

def test_a_word_in_several_parts_is_merged_once(monkeypatch):
    bpe = WordBpe(public_tokenizers.path("word_bpe_49k.json"))
    merged, merge = [], bpe.encode_word
    monkeypatch.setattr(bpe, "encode_word", lambda word: merged.append(word) or merge(word))
    text = "quixotry, (quixotry) quixotry. Quixotry"
    assert bpe.written(text) == " ".join(map(str, bpe.encode(text)))
    del merged[:]
    bpe.young.clear()
    bpe.written(text)
    assert merged.count("quixotry") == 1
