"""Document fingerprints from spot signatures.

Common words are anchors. A signature is an anchor with the two content words that follow it
(common words between them are skipped). A document's fingerprint is the set of its
signatures, 32 bits of hash each, sorted, in base64: equal texts have equal fingerprints, and
likeness is the Jaccard similarity of the sets. Texts are partitioned by set length for the
search of similar documents: only neighbouring partitions can hold a pair, and pairs are pruned
by length and prefixes before their sets are compared.

So that every text has a fingerprint that follows all of it, the start of a text counts as an
anchor, and where the ``REACH`` words before a word hold no common word (a language without a list, say), the word itself is
an anchor if its hash is one of every eight. An added or lost common word thus changes signatures near its place only. Words are runs of ASCII letters, digits and non-ASCII characters.

Cases: null and empty text have the empty fingerprint; two of those have likeness 1, one of them
and another text 0. A text without content words has the hash of its bytes as only signature.
Repeated ids follow each other in the order of their text; a null id comes before all others.
The document after the last is the first, so a single document is followed by itself.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runatlas.llm import jaccard_join
from runatlas.llm.components import connected_components
from runatlas.llm.scratch import Scratch, plain_columns
from runatlas.llm.wordgrid import ALNUM, PLACES, find_words, hash_spans, lower_ascii, mix, sorted_unique, text_slices

# Common words of English, German, French and Spanish.
COMMON = (
    "a an and are as at be by for from has have he in is it its not of on or that the there this to was were "
    "which will with you "
    "als auch auf aus bei das dem den der des die ein eine einer es für im ist mit nicht sich sie und von zu "
    "au aux avec ce ces dans de du elle en est et il la le les mais ne par pas pour que qui sa se son sur un une "
    "al como con del el ella esta este ha las lo los más no para pero por se sin su sus una y"
)
REACH = 24  # words before a word among which a common word keeps it from being an anchor by hash
SLICE_BYTES = 2 << 20


def _hashes_of(words: str) -> np.ndarray:
    data = np.frombuffer(words.encode("utf-8"), dtype=np.uint8)
    found = find_words(data, np.array([0, len(data)]), ALNUM)
    return np.unique(hash_spans(data, found.starts, found.ends))


ANCHORS = _hashes_of(COMMON)


def spot_sets(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """``(row, sorted distinct 32-bit signatures)`` of every text of a batch."""
    for at, upto, data, offsets in text_slices(column):
        words = find_words(lower_ascii(data), offsets, ALNUM)
        hashes = words.hashes()
        n_words = np.diff(words.first)
        text_of = np.repeat(np.arange(upto - at), n_words)
        place = np.searchsorted(ANCHORS, hashes)
        place[place == len(ANCHORS)] = 0
        common = ANCHORS[place] == hashes
        places = np.arange(len(hashes))
        # The last common word before each word; one of an earlier text does not count.
        before = np.r_[-1, np.maximum.accumulate(np.where(common, places, -1))[:-1]] if len(hashes) else places
        lonely = before < np.maximum(words.first[:-1][text_of], places - REACH)
        content = np.flatnonzero(~common)
        content_end = np.searchsorted(content, words.first[1:])
        anchors = np.flatnonzero(common | (lonely & (hashes % np.uint64(8) == 0)))
        anchor_text = text_of[anchors]
        starts = np.flatnonzero(n_words)
        # The start of a text is an anchor before its first word.
        anchor_hash = np.r_[hashes[anchors], np.zeros(len(starts), np.uint64)]
        following = np.searchsorted(content, np.r_[anchors + 1, words.first[:-1][starts]])
        text = np.r_[anchor_text, starts]
        padded = np.r_[hashes[content], np.zeros(2, np.uint64)]
        has_one, has_two = following < content_end[text], following + 1 < content_end[text]
        first = np.where(has_one, padded[np.minimum(following, len(content))], 0)
        second = np.where(has_two, padded[np.minimum(following + 1, len(content))], 0)
        signature = mix(anchor_hash * PLACES[0] + first * PLACES[1] + second * PLACES[2])[has_one]
        text = text[has_one]
        order = np.argsort(text, kind="stable")
        signature, bounds = (signature[order] >> np.uint64(32)), np.searchsorted(text[order], np.arange(upto - at + 1))
        for d in range(upto - at):
            out = sorted_unique(signature[bounds[d] : bounds[d + 1]])
            if not len(out) and offsets[d + 1] > offsets[d]:
                digest = hashlib.sha256(data[offsets[d] : offsets[d + 1]].tobytes()).digest()
                out = np.frombuffer(digest[:4], dtype=">u4").astype(np.uint64)
            yield at + d, out


def fingerprint(signatures: np.ndarray) -> str:
    return base64.b64encode(signatures.astype(">u4").tobytes()).decode("ascii")


def likeness(a: np.ndarray, b: np.ndarray, at_least: float = 0.0) -> float:
    """Jaccard similarity; 0 without comparing where the lengths alone keep it under ``at_least``."""
    low, high = min(len(a), len(b)), max(len(a), len(b))
    if not high:
        return 1.0
    if low == 0 or low < at_least * high:
        return 0.0
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (len(a) + len(b) - shared)


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compare(batches):
    """Rows sorted by (k, ahead, doc_id): each with the next row's text. Rows that are only ahead give no output."""
    names = ("k", "ahead", "doc_id", "text")
    held: list[tuple] = []

    def emit(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        # The last row is there for its text only.
        texts = [r[3] for r in rows]
        changed = [edited(t, f) for t, f in zip(texts, texts[1:], strict=False)]
        own = [s for _, s in spot_sets(pa.array(texts, pa.large_string()))]
        other = [s for _, s in spot_sets(pa.array(changed, pa.large_string()))]
        kept = [i for i, r in enumerate(rows[:-1]) if not r[1] and r[0] == rows[i + 1][0]]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([rows[i][2] for i in kept], pa.int64()),
                pa.array([len(texts[i]) for i in kept], pa.int64()),
                pa.array([hashlib.sha256(changed[i].encode("utf-8")).hexdigest() for i in kept], pa.string()),
                pa.array([fingerprint(own[i]) for i in kept], pa.string()),
                pa.array([fingerprint(other[i]) for i in kept], pa.string()),
                pa.array([likeness(own[i], other[i]) for i in kept], pa.float64()),
                pa.array([likeness(own[i], own[i + 1]) for i in kept], pa.float64()),
            ],
            ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )

    size = 0
    for batch in batches:
        columns = [batch.column(c) for c in names]
        for i in range(batch.num_rows):
            row = tuple(c[i].as_py() for c in columns)
            held.append((row[0], row[1], row[2], row[3] or ""))
            size += len(held[-1][3])
            if size > SLICE_BYTES and len(held) > 1:
                yield from emit(held)
                held = held[-1:]
                size = len(held[0][3])
    if len(held) > 1:
        yield from emit(held)


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", parts: int | None = None) -> DataFrame:
    """Per row: fingerprint, that of the edited text, and likeness to the edited and to the next text.

    Ids are cut at quantiles into ranges, one task each. The first row of a range is also sent
    to the range before it, so each range knows the row that follows its last: texts move once.
    """
    spark = docs.sparkSession
    Scratch(spark, "spots")
    docs = plain_columns(docs, doc_id=id_column, text=text_column).withColumn("doc_id", F.col("doc_id").cast("long"))
    parts = min(parts or int(spark.conf.get("spark.sql.shuffle.partitions")), 4096)
    place = F.coalesce("doc_id", F.lit(-(2**63)))
    quantiles = F.percentile_approx(place, [i / parts for i in range(1, parts)] or [0.5], F.lit(20 * parts + 1000))
    low, cuts = docs.agg(F.min(place), quantiles).first()
    bounds = sorted({low, *((cuts or []) if parts > 1 else [])} - {None}) or [0]
    bound = F.array(*[F.lit(b).cast("long") for b in bounds])
    n = len(bounds)
    k = F.size(F.filter(bound, lambda b: b <= place)) - 1
    ranges = F.when(F.array_contains(bound, place), F.array(k, F.pmod(k - 1, F.lit(n)))).otherwise(F.array(k))
    dealt = docs.select("doc_id", "text", F.posexplode(ranges).alias("ahead", "k"))
    return (
        dealt.repartitionById(n, F.col("k"))
        .sortWithinPartitions("k", "ahead", F.col("doc_id").asc_nulls_first(), "text")
        .mapInArrow(
            _compare,
            "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
            "near_edited double, near_next double",
        )
    )


def similar_groups(docs: DataFrame, percent: int = 80, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(node, component)`` of documents that are linked by fingerprints at least ``percent`` like each other."""
    scratch = Scratch(docs.sparkSession, "spots")
    docs = plain_columns(docs, doc_id=id_column, text=text_column).filter("doc_id is not null and text <> ''")
    docs = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    links = jaccard_join.jaccard_links(docs, None, scratch, percent, sets_of=spot_sets, by_length=True)
    return connected_components(links, scratch)
