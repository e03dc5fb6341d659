"""Token counts, with huge documents encoded in overlapping chunks and spliced where both sides agree.

A document of more than ``chunk`` characters is cut into chunks that overlap by ``overlap``.
Chunks are spread over all tasks and encoded with offsets. The tokenizer's first step, the
split into words, is memoryless: what follows a word boundary does not depend on what comes
before it. So a boundary of the left chunk, at least ``MARGIN`` characters before its end
(longer than any look-ahead and any special string), is a boundary of the whole document,
if the left chunk's own start was. Where the right chunk has the same boundary, everything
from there on agrees with the whole document: a proven stable boundary. The count is

    sum over neighbours of (left tokens before p - right tokens before p) + tokens of the last chunk.

Neighbours without a common boundary send their document to another round with a
fourfold overlap and chunk, until it is one chunk at last.

Words are found with their offsets by the tokenizer's pattern. Their token counts come from the
library, which is asked once for each new word, and are kept in a bounded cache: merges never
cross words, so a text's count is the sum over its words.

Cases: null and empty text have no tokens and no bytes. Equal huge texts are encoded together
and joined back to each of their rows. Special strings in texts are tokens, as is the library's default.
"""

from __future__ import annotations

import json
import os
import re
from itertools import accumulate

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runatlas.llm.scratch import Scratch, plain_columns

CHUNK = 16_384
OVERLAP = 512
MARGIN = 16
LIMIT = 1024

CACHE_WORDS = 300_000  # per generation; an entry takes about 120 bytes

# Fixed value of the tokenizer's file format: the pattern of its words.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
ASCII_WORD = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\x09-\x0d\x20A-Za-z0-9]+|[\x09-\x0d\x20]+(?![^\x09-\x0d\x20])|[\x09-\x0d\x20]+"


class WordCounter:
    """Token counts of texts by the words of a byte-level BPE tokenizer of the library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task owns one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as file:
            special = sorted((t["content"] for t in json.load(file)["added_tokens"]), key=len, reverse=True)
        self.special = set(special)
        self.split_special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self.word, self.ascii_word = regex.compile(WORD), re.compile(ASCII_WORD)
        self.young: dict[str, int] = {}
        self.old: dict[str, int] = {}

    def words(self, text: str) -> list[str]:
        """The words and special strings, in order; together they are the text."""
        out: list[str] = []
        for segment in self.split_special.split(text) if self.split_special else [text]:
            if segment in self.special:
                out.append(segment)
            else:
                out += (self.ascii_word if segment.isascii() else self.word).findall(segment)
        return out

    def counts(self, words: list[str]) -> list[int]:
        """Tokens of each word."""
        if len(self.young) >= CACHE_WORDS:
            self.young, self.old = {}, self.young
        young, old = self.young, self.old
        new = {w for w in words if w not in young}
        ask = []
        for word in new:
            if (n := old.get(word)) is None:
                ask.append(word)
            else:
                young[word] = n
        if ask:
            for word, encoding in zip(ask, self.library.encode_batch_fast(ask, add_special_tokens=False), strict=True):
                young[word] = len(encoding.ids)
        out = [young[w] for w in words]
        for word in new:
            if len(word) > 64:
                del young[word]
        return out


class PieceCounter:
    """Token counts of whole texts by a sentencepiece model."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)

    def totals(self, texts: list[str]) -> list[int]:
        return [len(ids) for ids in self.library.encode(texts, num_threads=1)]


_LOADED: dict[str, WordCounter | PieceCounter] = {}


def counter(path: str):
    """One per worker process."""
    if path not in _LOADED:
        _LOADED[path] = PieceCounter(path) if path.endswith(".model") else WordCounter(path)
    return _LOADED[path]


def _count_whole(path: str):
    def run(batches):
        made = counter(path)
        for batch in batches:
            texts = pc.fill_null(batch.column("text"), "")
            if isinstance(made, PieceCounter):
                counts = made.totals(texts.to_pylist())
            else:
                counts = [sum(made.counts(made.words(t.as_py()))) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pc.binary_length(texts).cast(pa.int64()), pa.array(counts, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    return run


def _cut(chunk: int, overlap: int):
    def run(batches):
        for batch in batches:
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text"), strict=True):
                text = text.as_py()
                starts = range(0, max(1, len(text) - overlap), chunk - overlap)
                yield pa.RecordBatch.from_pydict(
                    {
                        "key": pa.array([key] * len(starts), pa.string()),
                        "part": pa.array(range(len(starts)), pa.int32()),
                        "start": pa.array(starts, pa.int64()),
                        "last": pa.array([k == len(starts) - 1 for k in range(len(starts))]),
                        "text": pa.array([text[s : s + chunk] for s in starts], pa.string()),
                    }
                )

    return run


def encoded_chunk(made: WordCounter, text: str) -> tuple[int, list[tuple[int, int]]]:
    """Number of tokens, and ``(offset, tokens before it)`` of every word's start."""
    words = made.words(text)
    counts = made.counts(words)
    offsets = accumulate(map(len, words), initial=0)
    before = accumulate(counts, initial=0)
    bounds = list(zip(offsets, before, strict=True))[: len(words)]
    return sum(counts), bounds


PAIRS = pa.map_(pa.int64(), pa.int64())


def _encode_chunks(path: str, overlap: int):
    def run(batches):
        made = counter(path)
        for batch in batches:
            total, left, right = [], [], []
            for text, start in zip(batch.column("text"), batch.column("start").to_pylist(), strict=True):
                text = text.as_py()
                tokens, bounds = encoded_chunk(made, text)
                total.append(tokens)
                left.append([(start + p, n) for p, n in bounds if p <= overlap])
                proven = len(text) - MARGIN
                right.append([(start + p, n) for p, n in bounds if len(text) - overlap <= p <= proven])
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("key", "part", "last")]
                + [pa.array(total, pa.int64()), pa.array(left, PAIRS), pa.array(right, PAIRS)],
                ["key", "part", "last", "total", "left", "right"],
            )

    return run


def _spliced(huge: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """Per key: ``n_tokens``, null where two neighbours have no proven common boundary."""
    cut = huge.mapInArrow(_cut(chunk, overlap), "key string, part int, start long, last boolean, text string")
    encoded = cut.repartition("key", "part").mapInArrow(
        _encode_chunks(path, overlap),
        "key string, part int, last boolean, total long, left map<long,long>, right map<long,long>",
    )
    # Rows of equal texts gave equal chunks.
    encoded = encoded.groupBy("key", "part").agg(*[F.first(c).alias(c) for c in ("last", "total", "left", "right")])
    following = F.lead("left").over(Window.partitionBy("key").orderBy("part"))
    joined = encoded.withColumn("following", following).withColumn(
        "p", F.array_min(F.array_intersect(F.map_keys("right"), F.map_keys("following")))
    )
    piece = F.when(F.col("last"), F.col("total")).otherwise(
        F.element_at("right", F.col("p")) - F.element_at("following", F.col("p"))
    )
    return joined.groupBy("key").agg(
        F.when(F.count("*") == F.count(piece), F.sum(piece)).alias("n_tokens")
    )


def count_tokens(
    docs: DataFrame,
    path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    limit: int = LIMIT,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """Per row: ``doc_id``, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit``."""
    scratch = Scratch(docs.sparkSession, "tokens")
    docs = plain_columns(docs, doc_id=id_column, text=text_column)
    kind = docs.schema["doc_id"].dataType.simpleString()
    if path.endswith(".model"):  # no words to splice at: such a vocabulary is applied to whole texts
        small, huge = docs, None
    else:
        small = docs.filter(F.coalesce(F.length("text"), F.lit(0)) <= chunk)
        huge = docs.filter(F.length("text") > chunk).withColumn("key", F.sha2("text", 256))
    counted = small.mapInArrow(_count_whole(path), f"doc_id {kind}, n_bytes long, n_tokens long")
    if huge is not None:
        done, open_keys = None, huge
        while True:
            found = scratch.save(_spliced(open_keys.select("key", "text"), path, chunk, overlap), f"overlap{overlap}")
            whole = found.filter("n_tokens is not null")
            done = whole if done is None else done.union(whole)
            failed = found.filter("n_tokens is null").select("key")
            if failed.isEmpty():
                break
            chunk, overlap = 4 * chunk, 4 * overlap
            open_keys = huge.join(failed, "key", "left_semi")
        rows = huge.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "key")
        counted = counted.union(rows.join(done, "key").select("doc_id", "n_bytes", "n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
