"""Benchmark decontamination: BM25 over test items with block-max WAND, then an overlap check.

Items are cut into units of at most ``UNIT`` words, the documents of the index. An impact is a term's
BM25 weight in a unit as a part of the unit's whole weight, so a passage's score for a unit, the sum over
its distinct terms, is the part of the unit that it covers. Every passage of every document (two
neighbouring cells of ``UNIT`` words, at each cell) is a query; all units with a score of at least
``THRESHOLD`` are retrieved.

Of each passage, the maxima of its terms in each block of units are summed first, for all passages of a
slice at once: only passages with a block that could reach the threshold are run through block-max
WAND, over posting lists with a pivot, block maxima and skips. Retrieved items are verified on the whole
text: of the item's runs of five words, the part found in the document must be at least ``OVERLAP`` both
for the question (runs that begin before the answer) and the answer (runs that reach into it: the last
sentence where that is at most half, but never less than a quarter of the item or ``RUN`` words, so that an edit
or a cut at the very end alone does not hide a copy).

The index is broadcast in shards of bounded size; a larger benchmark is looked up shard by shard. Document
frequencies, unit count and mean length are those of all items in every shard, so shards do not change
a score. Equal items are one entry of the index, with the number of their copies.

Cases: null or empty items match nothing, as do null or empty documents. An item of fewer than five words is
one run. Repeated documents and items give repeated rows. Words are runs of letters and digits, in lower case.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Mapping
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runatlas.llm.scratch import Scratch, let_workers_import, plain_columns
from runatlas.llm.wordgrid import ALNUM, find_words, hash_spans, lower_ascii, sorted_unique, text_slices

UNIT = 64
THRESHOLD = 0.6
OVERLAP = 0.5
RUN = 5
K1, B = 1.2, 0.75
BLOCK = 2  # units; wider blocks let most passages through
SHARD_BYTES = 1 << 20  # of item text in one broadcast index
SHARD_ITEMS = 2048
HINT_BITS = 18
GATHERED = 1 << 20  # block maxima (4 MB) that are summed at a time


def word_list(text: str) -> tuple[np.ndarray, list[bool]]:
    """Hashes of a text's words, and whether each ends a sentence."""
    data = lower_ascii(np.frombuffer(text.encode("utf-8"), dtype=np.uint8))
    words = find_words(data, np.array([0, len(data)]), ALNUM)
    gaps = [data[e:s].tobytes() for e, s in zip(words.ends, [*words.starts[1:], len(data)], strict=True)]
    return hash_spans(data, words.starts, words.ends), [any(c in gap for c in b".?!\n") for gap in gaps]


def answer_start(ends: list[bool]) -> int:
    """The word with which the last sentence begins, if it is at most half of the text; at least ``RUN`` words and a quarter."""
    n = len(ends)
    last = max((i + 1 for i in range(n - 1) if ends[i]), default=0)
    least = max(0, n - max(RUN, -(-n // 4)))
    return min(last, least) if n - last <= n / 2 else least


@dataclass
class Item:
    item_id: int
    words: list[int]
    answer: int
    copies: int = 1

    def runs(self) -> tuple[int, list[tuple[int, ...]], list[bool], list[bool]]:
        """Run length; the runs; which belong to the question; which to the answer."""
        n = len(self.words)
        width = min(RUN, n)
        runs = [tuple(self.words[i : i + width]) for i in range(n - width + 1)]
        question = [i < self.answer or n <= width for i in range(len(runs))]
        return width, runs, question, [i + width > self.answer for i in range(len(runs))]


@dataclass
class Index:
    items: list[Item]
    unit_item: list[int] = field(default_factory=list)
    terms: np.ndarray | None = None  # sorted hashes
    hint: np.ndarray | None = None  # whether any term has these low bits
    postings: list[tuple[list[int], list[float], float]] = field(default_factory=list)  # units, impacts, maximum
    block_max: np.ndarray | None = None  # terms x blocks


@dataclass
class Statistics:
    """Of the units of a whole benchmark; ``frequency`` may be that of some terms only."""

    units: int
    words: int
    frequency: Mapping[int, int]


def units_of(words: np.ndarray) -> list[Counter]:
    return [Counter(piece.tolist()) for piece in np.array_split(words, math.ceil(len(words) / UNIT))] if len(words) else []


def build_index(rows: list[tuple], statistics: Statistics | None = None) -> Index:
    """The index of ``(item_id, text)`` or ``(item_id, text, copies)``, by default with statistics of these items."""
    items, units, unit_item = [], [], []
    for item_id, text, *copies in rows:
        words, ends = word_list(text or "")
        if not len(words):
            continue
        items.append(Item(item_id, words.tolist(), answer_start(ends), *copies))
        for unit in units_of(words):
            units.append(unit)
            unit_item.append(len(items) - 1)
    index = Index(items, unit_item)
    if not units:
        return index
    if statistics is None:
        frequency: Counter = Counter()
        total = length = 0
        for unit, number in zip(units, unit_item, strict=True):
            copies = items[number].copies
            total, length = total + copies, length + copies * sum(unit.values())
            for t in unit:
                frequency[t] += copies
        statistics = Statistics(total, length, frequency)
    frequency, mean = statistics.frequency, statistics.words / statistics.units
    lists: dict[int, list[tuple[int, float]]] = {}
    for n, unit in enumerate(units):
        length = K1 * (1 - B + B * sum(unit.values()) / mean)
        weight = {
            t: math.log(1 + (statistics.units - frequency[t] + 0.5) / (frequency[t] + 0.5)) * tf * (K1 + 1) / (tf + length)
            for t, tf in unit.items()
        }
        whole = sum(weight.values())
        for t, w in weight.items():
            lists.setdefault(t, []).append((n, w / whole))
    index.terms = np.array(sorted(lists), dtype=np.uint64)
    index.hint = np.zeros(1 << HINT_BITS, dtype=bool)
    index.hint[(index.terms & np.uint64((1 << HINT_BITS) - 1)).astype(np.int64)] = True
    index.block_max = np.zeros((len(index.terms), math.ceil(len(units) / BLOCK)), dtype=np.float32)
    for k, t in enumerate(index.terms.tolist()):
        numbers, impacts = zip(*lists[t], strict=True)
        index.postings.append((list(numbers), list(impacts), max(impacts)))
        np.maximum.at(index.block_max[k], np.array(numbers) // BLOCK, np.array(impacts, dtype=np.float32))
    return index


def retrieve(index: Index, terms: list[int], threshold: float) -> list[tuple[int, float]]:
    """All ``(unit, score)`` with a score of at least ``threshold`` for distinct ``terms``: block-max WAND."""
    least = threshold - 1e-6
    cursors = [[index.postings[t][0], index.postings[t][1], index.postings[t][2], index.block_max[t], 0] for t in terms]
    out = []
    while True:
        cursors = [c for c in cursors if c[4] < len(c[0])]
        cursors.sort(key=lambda c: c[0][c[4]])
        total, pivot = 0.0, -1
        for i, c in enumerate(cursors):
            total += c[2]
            if total >= least:
                pivot = i
                break
        if pivot < 0:
            return out
        unit = cursors[pivot][0][cursors[pivot][4]]
        while pivot + 1 < len(cursors) and cursors[pivot + 1][0][cursors[pivot + 1][4]] == unit:
            pivot += 1
        block = unit // BLOCK
        if sum(float(c[3][block]) for c in cursors[: pivot + 1]) >= least:
            if cursors[0][0][cursors[0][4]] == unit:
                score = math.fsum(c[1][c[4]] for c in cursors[: pivot + 1])  # the same in any order
                if score >= least:
                    out.append((unit, score))
                target = unit + 1
            else:
                target = unit
        else:
            # No unit of this block can do with these terms; the next may where the block ends or a further term begins.
            target = (block + 1) * BLOCK
            if pivot + 1 < len(cursors):
                target = min(target, cursors[pivot + 1][0][cursors[pivot + 1][4]])
            target = max(target, unit + 1)
        for c in cursors[: pivot + 1]:
            numbers, at = c[0], c[4]
            while at < len(numbers) and numbers[at] < target:
                at += 1
            c[4] = at


def passages(index: Index, data: np.ndarray, offsets: np.ndarray, threshold: float):
    """``(text, distinct terms)`` of the passages of a slice with a block that may reach the threshold, and all words."""
    words = find_words(lower_ascii(data), offsets, ALNUM)
    hashes = words.hashes()
    found = np.flatnonzero(index.hint[(hashes & np.uint64((1 << HINT_BITS) - 1)).astype(np.int64)])
    term = np.searchsorted(index.terms, hashes[found])
    term[term == len(index.terms)] = 0
    same = index.terms[term] == hashes[found]
    found, term = found[same], term[same]
    counts = np.diff(words.first)
    cells = -(-counts // UNIT)
    first_cell = np.r_[0, np.cumsum(cells)]
    text_of = np.repeat(np.arange(len(counts)), counts)[found]
    cell = first_cell[text_of] + (found - words.first[text_of]) // UNIT
    keys = sorted_unique(cell * len(index.terms) + term)
    if not len(keys):
        return [], words, hashes
    cell, term = keys // len(index.terms), keys % len(index.terms)
    starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
    spans = np.r_[starts, len(cell)]
    blocks = index.block_max.shape[1]
    bound = np.zeros((first_cell[-1] + 1, blocks), dtype=np.float32)
    step = max(1, GATHERED // (UNIT * blocks))  # cells; each has at most UNIT terms
    for at in range(0, len(starts), step):
        upto = min(at + step, len(starts))
        maxima = index.block_max[term[spans[at] : spans[upto]]]
        bound[cell[starts[at:upto]]] = np.add.reduceat(maxima, starts[at:upto] - starts[at], axis=0)
    cell_text = np.repeat(np.arange(len(counts)), cells)
    paired = np.r_[cell_text[1:] == cell_text[:-1], False] if len(cell_text) else np.zeros(0, bool)
    np.add(bound[:-1], bound[1:], out=bound[:-1], where=paired[:, None])
    hopeful = np.flatnonzero(bound[:-1].max(axis=1) >= threshold - 1e-4)
    place = dict(zip(cell[starts].tolist(), range(len(starts)), strict=True))
    out = []
    for c in hopeful.tolist():
        pair = (c, c + 1) if paired[c] else (c,)
        picked = [term[spans[place[x]] : spans[place[x] + 1]] for x in pair if x in place]
        out.append((int(cell_text[c]), sorted_unique(np.concatenate(picked)).tolist()))
    return out, words, hashes


def overlap(item: Item, words: list[int]) -> tuple[float, float]:
    """Parts of the question's and the answer's runs that stand in a text."""
    width, runs, question, answer = item.runs()
    there = set(zip(*[words[k:] for k in range(width)], strict=False))
    hit = [r in there for r in runs]

    def part(of: list[bool]) -> float:
        return sum(h for h, o in zip(hit, of, strict=True) if o) / max(1, sum(of))

    return part(question), part(answer)


def _search(shared, threshold: float, least: float):
    def run(batches):
        index: Index = shared.value
        for batch in batches:
            rows = []
            for at, _, data, offsets in text_slices(batch.column("text")):
                hopeful, words, hashes = passages(index, data, offsets, threshold)
                scores: dict[tuple[int, int], float] = {}
                for d, terms in hopeful:
                    for unit, score in retrieve(index, terms, threshold):
                        key = (d, index.unit_item[unit])
                        scores[key] = max(score, scores.get(key, 0.0))
                listed: dict[int, list[int]] = {}
                for (d, number), score in sorted(scores.items()):
                    if d not in listed:
                        listed[d] = hashes[words.first[d] : words.first[d + 1]].tolist()
                    item = index.items[number]
                    question, answer = overlap(item, listed[d])
                    if question >= least and answer >= least:
                        rows.append((at + d, item.item_id, item.copies, min(score, 1.0), question, answer))
            if rows:
                row, *values = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(row)), *[pa.array(v, pa.int64()) for v in values[:2]]]
                    + [pa.array(v, pa.float64()) for v in values[2:]],
                    ["doc_id", "item_id", "copies", "score", "question_overlap", "answer_overlap"],
                )

    return run


def _term_counts(batches):
    """Units that hold each term, per shard; in the row without a term all units and words."""
    for batch in batches:
        units, words = Counter(), Counter()
        for shard, text, copies in zip(*[batch.column(c).to_pylist() for c in ("shard", "text", "copies")], strict=True):
            for unit in units_of(word_list(text)[0]):
                units[shard, None] += copies
                words[shard, None] += copies * sum(unit.values())
                for t in unit:
                    units[shard, t] += copies
        yield pa.RecordBatch.from_pydict(
            {
                "shard": pa.array([s for s, _ in units], pa.int64()),
                "term": pa.array([None if t is None else t - (t >> 63 << 64) for _, t in units], pa.int64()),
                "units": pa.array(units.values(), pa.int64()),
                "words": pa.array([words[k] for k in units], pa.int64()),
            }
        )


def _statistics(items: DataFrame, scratch: Scratch) -> tuple[int, int, DataFrame]:
    """Units and words of all items, and of each shard's terms ``(shard, term, units)`` the units of all items that hold it."""
    counted = items.mapInArrow(_term_counts, "shard long, term long, units long, words long")
    counted = counted.groupBy("shard", "term").agg(F.sum("units").alias("units"), F.sum("words").alias("words"))
    counted = scratch.save(counted, "counted")
    units, words = counted.filter("term is null").agg(F.sum("units"), F.sum("words")).first()
    of_all = counted.filter("term is not null").groupBy("term").agg(F.sum("units").alias("units"))
    return units or 0, words or 0, scratch.save(counted.select("shard", "term").join(of_all, "term"), "frequency")


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    threshold: float = THRESHOLD,
    least: float = OVERLAP,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """Per document and item found in it: ``doc_id``, ``item_id``, ``score``, ``question_overlap``, ``answer_overlap``."""
    spark = docs.sparkSession
    let_workers_import(spark)
    docs = plain_columns(docs, doc_id=id_column, text=text_column)
    items = plain_columns(benchmark, item_id=item_column, text=item_text_column).filter("text is not null and text <> ''")
    scratch = Scratch(spark, "decontaminate")
    items = items.groupBy(F.col("item_id").cast("long").alias("item_id"), "text").agg(F.count("*").alias("copies"))
    items = scratch.save(items, "items")
    n, size, most = items.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.max("copies")).first()
    shards = max(1, -(-n // SHARD_ITEMS), -(-size // SHARD_BYTES))
    items = items.withColumn("shard", F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)))
    units, words, frequency = _statistics(items, scratch) if shards > 1 else (0, 0, None)  # one shard counts its own
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, item_id long, copies long, score double, question_overlap double, answer_overlap double"
    out = None
    for shard in range(shards):
        held = items.filter(F.col("shard") == shard).orderBy("item_id", "text").select("item_id", "text", "copies").collect()
        statistics = None
        if shards > 1:
            terms = frequency.filter(F.col("shard") == shard).select("term", "units").collect()
            statistics = Statistics(units, words, {r["term"] % (1 << 64): r["units"] for r in terms})
        index = build_index([tuple(r) for r in held], statistics)
        if not index.items:
            continue
        found = docs.mapInArrow(_search(spark.sparkContext.broadcast(index), threshold, least), schema)
        out = found if out is None else out.union(found)
    if out is None:
        return spark.createDataFrame([], schema).drop("copies")
    if most > 1:
        out = out.withColumn("copies", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return out.drop("copies")
