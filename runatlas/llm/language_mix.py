"""Language identification as mixture inference.

A document is a mixture of languages, and each of its words comes from one of them. A word's
likelihood in a language is that of its byte trigrams (with a blank at either end).
Expectation-maximisation estimates the proportions. The set of languages grows, by the
proportions of the mixture of all, from the single language with the highest likelihood on; of these sets the one with the highest
penalised log-likelihood wins. Only the penalty ends the growth: no size of set is out of reach, and a larger one is left untried
only where an upper bound of its likelihood shows that it cannot win.
The prediction is the language with the largest proportion, the score that proportion.

Trigram counts are taken from all labelled documents given for learning, in one pass with
partial sums in each task. The tables they make have a fixed size per language; every language is learned. They are
broadcast in shards of ``SHARD_LANGUAGES`` languages, and with more languages texts are taken in smaller slices.

Cases: ``und`` with score 0 for null text, text without a letter, and where nothing was learned. Rows
with a null label teach nothing. Repeated rows count as often as they stand. One row in, one row out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from runatlas.llm.scratch import Scratch, let_workers_import, plain_columns
from runatlas.llm.wordgrid import byte_table, find_words, text_slices

BUCKETS = 1 << 15  # hashed trigrams per language
SHARD_LANGUAGES = 64  # of one broadcast table: 8 MB
SMOOTHING = 0.5
PENALTY = 4.0  # nats per further language and unit of log(words)
NEAR = 0.05  # of a penalty: expectation-maximisation ends when its likelihood is that near to the highest one
NEAR_PER_WORD = 1e-4  # or that near for each word, whichever is more
LEAST_SHARE = 1e-12  # keeps a language in reach whose share had fallen before others did
SLICE_BYTES = 1 << 20
UNKNOWN = "und"

#: Letters of words: ASCII letters, and every byte of a longer UTF-8 character.
LETTERS = byte_table(bytes([*range(65, 91), *range(97, 123), *range(128, 256)]))


@dataclass
class Model:
    languages: list[str]
    tables: list[np.ndarray]  # each BUCKETS x the next SHARD_LANGUAGES languages

    def log_likelihood(self, language: int) -> np.ndarray:
        return self.tables[language // SHARD_LANGUAGES][:, language % SHARD_LANGUAGES]

    def slice_bytes(self) -> int:
        """Bytes of a slice of texts: its words x languages take the same room with any number of languages."""
        return SLICE_BYTES * SHARD_LANGUAGES // max(SHARD_LANGUAGES, len(self.languages))


def word_trigrams(data: np.ndarray, offsets: np.ndarray):
    """Hashed trigrams of all words: ``(bucket of each, first trigram of each word, first word of each text)``."""
    words = find_words(data, offsets, LETTERS)
    lengths = words.ends - words.starts
    # Every word with one blank on either side, laid end to end: a word of n bytes has n trigrams.
    total = int(lengths.sum()) + 2 * len(lengths)
    codes = np.zeros(total + 2, dtype=np.uint32)
    first = np.r_[0, np.cumsum(lengths)]
    letters = np.repeat(words.starts - first[:-1], lengths) + np.arange(first[-1])
    target = np.repeat(2 * np.arange(len(lengths)) + 1, lengths) + np.arange(first[-1])
    codes[target] = data[letters]
    mixed = (codes[:-2] * np.uint32(0x9E3779B1)) ^ (codes[1:-1] * np.uint32(0x85EBCA77)) ^ (codes[2:] * np.uint32(0xC2B2AE3D))
    mixed ^= mixed >> np.uint32(15)
    return (mixed[target - 1] * np.uint32(0x2C1B3C6D) >> np.uint32(17)).astype(np.int32), first, words.first


def _lowered(column: pa.Array) -> pa.Array:
    return pc.utf8_lower(pc.fill_null(column, ""))


def _count(batches):
    held: dict[str, np.ndarray] = {}
    for batch in batches:
        labels = batch.column("lang").to_pylist()
        for at, upto, data, offsets in text_slices(_lowered(batch.column("text")), SLICE_BYTES):
            grams, first, words = word_trigrams(data, offsets)
            ends = first[words]
            for d in range(upto - at):
                if ends[d + 1] > ends[d]:
                    table = held.setdefault(labels[at + d], np.zeros(BUCKETS, dtype=np.int64))
                    np.add.at(table, grams[ends[d] : ends[d + 1]], 1)
    for language, table in held.items():
        full = np.flatnonzero(table)
        yield pa.RecordBatch.from_pydict(
            {
                "lang": pa.array([language] * len(full), pa.string()),
                "bucket": pa.array(full, pa.int32()),
                "n": pa.array(table[full], pa.int64()),
            }
        )


def learn(labelled: DataFrame) -> Model:
    """Trigram likelihoods of each language of ``labelled(text, lang)``."""
    let_workers_import(labelled.sparkSession)
    counted = (
        labelled.filter("lang is not null and text is not null")
        .mapInArrow(_count, "lang string, bucket int, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
    )
    counted = Scratch(labelled.sparkSession, "languages").save(counted, "counted")
    languages = sorted(r["lang"] for r in counted.select("lang").distinct().collect())
    tables = []
    for at in range(0, len(languages), SHARD_LANGUAGES):
        part = languages[at : at + SHARD_LANGUAGES]
        table = counted.filter(F.col("lang").isin(part)).toArrow()
        number = {language: i for i, language in enumerate(part)}
        counts = np.full((BUCKETS, len(part)), SMOOTHING)
        which = np.array([number[x] for x in table.column("lang").to_pylist()], dtype=np.int64)
        counts[table.column("bucket").to_numpy(), which] += table.column("n").to_numpy()
        tables.append(np.asfortranarray(np.log(counts / counts.sum(axis=0)), dtype=np.float32))
    return Model(languages, tables)


def _mixture(likelihood: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Proportions of the languages in each text, the log-likelihood, and what the highest one exceeds it by at most.

    ``likelihood``: languages x words. The log-likelihood is concave in the proportions, so its slope bounds what is still
    to gain: words x (the largest mean of a language's share in the words, over its proportion, minus one). Texts go on until
    that is small.
    """
    n_words = np.diff(bounds)
    enough = np.maximum(NEAR * PENALTY * np.log(n_words + 1.0), NEAR_PER_WORD * n_words)
    share = np.full((len(likelihood), len(n_words)), 1.0 / len(likelihood))
    value, above = np.zeros(len(n_words)), np.zeros(len(n_words))
    open_texts, words = np.arange(len(n_words)), likelihood
    while len(open_texts):
        counts = n_words[open_texts]
        starts = np.cumsum(counts) - counts
        now = share[:, open_texts]
        total = np.maximum(np.einsum("lw,lw->w", np.repeat(now, counts, axis=1), words), 1e-300)
        slope = np.add.reduceat(words / total, starts, axis=1) / counts
        value[open_texts] = np.add.reduceat(np.log(total), starts)
        above[open_texts] = counts * np.maximum(slope.max(axis=0) - 1.0, 0.0)
        going = above[open_texts] > enough[open_texts]
        if not going.all():
            words = words[:, np.repeat(going, counts)]
            now, slope, open_texts = now[:, going], slope[:, going], open_texts[going]
        moved = np.maximum(now * slope, LEAST_SHARE)
        share[:, open_texts] = moved / moved.sum(axis=0)
    return share, value, above


def _select(logs: np.ndarray, bounds: np.ndarray, alone: np.ndarray) -> np.ndarray:
    """Proportions (languages x texts) of the best set of languages of each text.

    ``logs``: languages x words, the best of a word zero. ``alone``: log-likelihood of each single language. No set is
    likelier than the mixture of all can be, so a text's sets grow while that bound, less the penalty of their size, is
    above the best set so far.
    """
    n_words = np.diff(bounds)
    penalty = PENALTY * np.log(n_words + 1.0)
    share, value, above = _mixture(np.exp(logs), bounds)
    highest = np.minimum(value + above, 0.0)
    single = alone.argmax(axis=0)
    every = np.arange(len(n_words))
    best, best_value = np.zeros_like(share), alone[single, every]
    best[single, every] = 1.0
    order = np.argsort(-share, axis=0, kind="stable")
    for size in range(2, len(logs) + 1):
        growing = highest - penalty * (size - 1) > best_value
        texts = np.flatnonzero(growing)
        if not len(texts):
            break
        words = np.flatnonzero(np.repeat(growing, n_words))
        chosen = order[:size, texts]
        picked = np.exp(logs[np.repeat(chosen, n_words[texts], axis=1), words])
        found, value, _ = _mixture(picked, np.r_[0, np.cumsum(n_words[texts])])
        value = value - penalty[texts] * (size - 1)
        better = value > best_value[texts]
        kept = texts[better]
        placed = np.zeros((len(logs), len(kept)))
        np.put_along_axis(placed, chosen[:, better], found[:, better], axis=0)
        best[:, kept] = placed
        best_value[kept] = value[better]
    return best


def infer(model: Model, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions (texts x languages) and whether the text has words, for lower-case texts."""
    grams, first, words = word_trigrams(data, offsets)
    n, n_languages = len(offsets) - 1, len(model.languages)
    shares = np.zeros((n, n_languages))
    filled = np.flatnonzero(np.diff(words))
    has_words = np.zeros(n, dtype=bool)
    has_words[filled] = True
    if not len(filled):
        return shares, has_words
    logs = np.stack([np.add.reduceat(model.log_likelihood(k)[grams], first[:-1]) for k in range(n_languages)])
    # Only ratios count for the proportions; the best language of each word is set to zero.
    logs = np.maximum(logs - logs.max(axis=0), np.float32(-80.0))
    bounds = np.r_[words[filled], words[-1]]
    n_words = np.diff(bounds)
    alone = np.add.reduceat(logs, bounds[:-1], axis=1, dtype=np.float64)
    single = alone.argmax(axis=0)
    # No set's likelihood is above that of the best language of every word, which is zero: where one language
    # is nearer to it than the least penalty of a larger set, that language it is.
    settled = -alone[single, np.arange(len(filled))] <= PENALTY * np.log(n_words + 1.0)
    shares[filled[settled], single[settled]] = 1.0
    rest = np.flatnonzero(~settled)
    if len(rest):
        picked = np.flatnonzero(np.repeat(~settled, n_words))
        bounds = np.r_[0, np.cumsum(n_words[rest])]
        shares[filled[rest]] = _select(logs[:, picked].astype(np.float64), bounds, alone[:, rest]).T
    return shares, has_words


def _broadcast(spark, model: Model) -> tuple[list[str], list]:
    return model.languages, [spark.sparkContext.broadcast(table) for table in model.tables]


def _predict(shared, keep_mix: bool):
    def run(batches):
        model = Model(shared[0], [table.value for table in shared[1]])
        names = np.array([*model.languages, UNKNOWN], dtype=object)
        for batch in batches:
            text = batch.column("text")
            letters = pc.fill_null(pc.match_substring_regex(text, r"\p{L}"), False).to_numpy(zero_copy_only=False)
            choice = np.full(batch.num_rows, len(model.languages))
            score = np.zeros(batch.num_rows)
            mixes: list = [None] * batch.num_rows
            if model.languages:
                for at, upto, data, offsets in text_slices(_lowered(text), model.slice_bytes()):
                    shares, known = infer(model, data, offsets)
                    known &= letters[at:upto]
                    choice[at:upto] = np.where(known, shares.argmax(axis=1), len(model.languages))
                    score[at:upto] = np.where(known, np.clip(shares.max(axis=1), 0.0, 1.0), 0.0)
                    if keep_mix:
                        for d in np.flatnonzero(known):
                            some = np.flatnonzero(shares[d] > 0)
                            mixes[at + d] = [(model.languages[i], float(shares[d, i])) for i in some]
            out = [batch.column("doc_id"), pa.array(names[choice].tolist(), pa.string()), pa.array(score)]
            kept = ["doc_id", "lang_pred", "score"]
            if keep_mix:
                out.append(pa.array(mixes, pa.map_(pa.string(), pa.float64())))
                kept.append("proportions")
            yield pa.RecordBatch.from_arrays(out, kept)

    return run


def predict(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text", keep_mix: bool = True) -> DataFrame:
    """Per row: ``doc_id``, ``lang_pred``, ``score``; with ``keep_mix`` the ``proportions`` of its languages."""
    let_workers_import(docs.sparkSession)
    shared = _broadcast(docs.sparkSession, model)
    docs = plain_columns(docs, doc_id=id_column, text=text_column)
    kind = docs.schema["doc_id"].dataType.simpleString()
    more = ", proportions map<string,double>" if keep_mix else ""
    return docs.mapInArrow(_predict(shared, keep_mix), f"doc_id {kind}, lang_pred string, score double{more}")


def predict_beside(docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """All columns of ``docs`` with ``lang_pred`` and ``score`` beside them; columns of these names give way."""
    let_workers_import(docs.sparkSession)
    shared = _broadcast(docs.sparkSession, model)
    docs = docs.select(*[docs[f"`{c}`"] for c in docs.columns if c not in ("lang_pred", "score")])

    def run(batches):
        for batch in batches:
            text = batch.column(docs_text)
            named = pa.RecordBatch.from_arrays([pa.nulls(batch.num_rows), text], ["doc_id", "text"])
            for found in _predict(shared, False)([named]):
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, found.column("lang_pred"), found.column("score")],
                    [*batch.schema.names, "lang_pred", "score"],
                )

    docs_text = docs.columns.index(text_column)
    schema = StructType([*docs.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return docs.mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id"):
    """Documents that teach nothing: a quarter, by the checksum of the id's digits."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def predict_languages(docs: DataFrame) -> DataFrame:
    """Learn from all documents but the held-out ones, and predict all."""
    labelled = plain_columns(docs, doc_id="doc_id", text="text", lang="lang").filter(~held_out()).select("text", "lang")
    found = predict(docs, learn(labelled))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "proportions")
