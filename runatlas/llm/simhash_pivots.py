"""SimHash near-duplicates found through tables of distances to reference fingerprints.

A text's fingerprint has a bit set where over half of the XXH64 values of its 3-word shingles (repeats
included) have it. Two fingerprints are linked when at most ``BITS`` bits differ.

1. Equal fingerprints collapse to one class with its least id; only distinct ones are searched.
2. A fingerprint's row of the pivot table holds, for each band of bits and each of ``PIVOTS`` fixed reference
   fingerprints, the Hamming distance over that band; over all bands they add up to the whole distance. A pair at
   most ``BITS`` apart has, for any pivot, band differences that add up to ``BITS`` at most: of
   ``BITS + 2`` bands at least two have no difference for any pivot. So fingerprints meet in cells, one for
   each choice of two bands, that hold equal coordinates there.
3. In a cell, pairs whose largest coordinate difference (whole distances) is over ``BITS`` are discarded;
   the others are verified by counting differing bits. Links of a batch leave as a spanning forest.
4. A cell of more than ``CROWDED`` distinct fingerprints is not compared: its members are dealt to finer cells by a
   pivot table of the bits that its own coordinates leave free. Distinct members must differ in free bits, and each step fixes two
   bands of them, so this ends by itself (after six steps at most, with cells of 2**6) and no cell is ever large.
5. Components of the links give the groups.

Cases: null and empty texts, and texts without words, have the fingerprint zero and are linked like any other.
A row with a null id takes part with its text; its group's id is the least id that is not null (null if there is none). Repeated
rows get a row each. An empty table gives an empty result. Other columns are ignored. Texts of any length are hashed in blocks.
"""

from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runatlas.llm.components import connected_components
from runatlas.llm.scratch import Scratch, plain_columns
from runatlas.llm.wordgrid import mix

WIDTH = 3
SEED = 42
BITS = 3
PIVOTS = 16
CROWDED = 128  # distinct fingerprints of a cell from which it is dealt to finer cells; at least 64
BLOCK_BYTES = 1 << 20
COMPARED_ROWS = 20_000
LISTED = 1_000_000  # longest list (by its count) that is broadcast: 16 MB; a longer one is joined by shuffle

_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_random = np.random.default_rng(11)
REFERENCE = _random.integers(0, 2**64, PIVOTS, dtype=np.uint64)
_PLACES = _random.integers(0, 2**63, (16, PIVOTS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _counted(words: list[bytes], total: np.ndarray) -> int:
    """Add the bits of all shingles of ``words`` to ``total``; how many shingles there are."""
    hashed = xxhash.xxh64_intdigest
    runs = map(b" ".join, zip(*(words[k:] for k in range(WIDTH)), strict=False))
    values = np.fromiter((hashed(run, SEED) for run in runs), np.uint64)
    if len(values):
        total += np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return len(values)


def simhash(text: bytes) -> int:
    """Fingerprint of a text in UTF-8, as an unsigned number."""
    text = text.lower()  # of bytes: A-Z only
    total, n, at, held = np.zeros(64, dtype=np.int64), 0, 0, []
    while at < len(text):
        cut = _SPACE.search(text, min(at + BLOCK_BYTES, len(text)))
        upto = cut.start() if cut else len(text)
        words = held + text[at:upto].split()
        n += _counted(words, total)
        held = words[1 - WIDTH :]
        at = upto
    if not n and held:  # fewer words than a shingle has: all of them, as the first block kept them
        n, total = 1, np.unpackbits(np.array([xxhash.xxh64_intdigest(b" ".join(held), SEED)], np.uint64).view(np.uint8), bitorder="little")
    return int(np.packbits(2 * total > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(batches):
    for batch in batches:
        texts = batch.column("text").cast(pa.large_binary())
        values = np.fromiter((simhash(t.as_py() or b"") for t in texts), np.uint64, len(texts))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values.view(np.int64))], ["doc_id", "fp"])


def band_masks(free: int, bands: int) -> list[int]:
    """The set bits of ``free`` cut into ``bands`` runs of nearly equal size."""
    at = [k for k in range(64) if free >> k & 1]
    edges = [len(at) * b // bands for b in range(bands + 1)]
    return [sum(1 << k for k in at[a:b]) for a, b in zip(edges, edges[1:], strict=False)]


def distances(fp: np.ndarray, mask: int) -> np.ndarray:
    """The pivot table over the bits of ``mask``: a row for each fingerprint, a column for each pivot."""
    return np.bitwise_count((fp[:, None] ^ REFERENCE[None, :]) & np.uint64(mask))


def _dealt(bits: int, bands: int):
    """Every row ``(cell, free, fp)`` in each of its finer cells: one for each choice of ``bands - bits`` bands."""
    choices = list(combinations(range(bands), bands - bits))

    def run(batches):
        for batch in batches:
            cells, frees, fps = (batch.column(c).to_numpy(zero_copy_only=False).view(np.uint64) for c in ("cell", "free", "fp"))
            for free in np.unique(frees):
                rows = np.flatnonzero(frees == free)
                fp, cell = fps[rows], cells[rows]
                masks = band_masks(int(free), bands)
                # Coordinates of a band as one number: equal rows of the table give equal numbers.
                told = [mix((distances(fp, m).astype(np.uint64) * _PLACES[b]).sum(axis=1, dtype=np.uint64)) for b, m in enumerate(masks)]
                for k, chosen in enumerate(choices):
                    left = int(free) & ~sum(masks[b] for b in chosen)
                    with np.errstate(over="ignore"):
                        key = cell * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k + 1)
                        for b in chosen:
                            key = mix(key ^ told[b])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key.view(np.int64)), pa.array(np.full(len(fp), left, np.uint64).view(np.int64)), pa.array(fp.view(np.int64))],
                        ["cell", "free", "fp"],
                    )

    return run


def linked_pairs(cell: np.ndarray, fp: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs within a cell (rows are sorted by it) that differ in ``bits`` bits at most."""
    table = distances(fp, 2**64 - 1).astype(np.int8)
    out_a, out_b = [], []
    at, step = np.arange(len(fp)), 1
    while True:
        at = at[at + step < len(fp)]
        at = at[cell[at] == cell[at + step]]
        if not len(at):
            break
        a, b = at, at + step
        for pivot in range(PIVOTS):
            near = np.abs(table[a, pivot] - table[b, pivot]) <= bits
            a, b = a[near], b[near]
        same = np.bitwise_count(fp[a] ^ fp[b]) <= bits
        out_a.append(a[same])
        out_b.append(b[same])
        step += 1
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *out_a]), np.concatenate([none, *out_b])


def _compared(bits: int):
    """Rows sorted by cell, few of each: links as edges ``(a, b)`` to the least place of what hangs together in a batch."""

    def forest(cell: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        values, at = np.unique(fp, return_inverse=True)
        a, b = linked_pairs(cell, fp, bits)
        a, b, label = at[a], at[b], np.arange(len(values))
        while True:
            best = label.copy()
            np.minimum.at(best, a, label[b])
            np.minimum.at(best, b, label[a])
            best = best[best]
            if (best == label).all():
                break
            label = best
        moved = np.flatnonzero(label != np.arange(len(values)))
        return pa.RecordBatch.from_arrays([pa.array(values[label[moved]].view(np.int64)), pa.array(values[moved].view(np.int64))], ["a", "b"])

    def run(batches):
        cell, fp = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for batch in batches:
            cell = np.concatenate([cell, batch.column("cell").to_numpy(zero_copy_only=False)])
            fp = np.concatenate([fp, batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)])
            whole = int(np.searchsorted(cell, cell[-1])) if len(cell) else 0  # the last cell may go on
            if whole >= COMPARED_ROWS:
                yield forest(cell[:whole], fp[:whole])
                cell, fp = cell[whole:], fp[whole:]
        if len(cell):
            yield forest(cell, fp)

    return run


def bands_for(n: int, bits: int) -> int:
    """Bands for ``n`` distinct fingerprints: so many that cells stay small. Any number over ``bits`` gives the same links."""
    bands = bits + 2
    while n > 2 ** (64 * (bands - bits) // bands + 2) and bands < 2 * bits + 2:
        bands += 1
    return bands


def _listed(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.limit(LISTED + 1).count() <= LISTED else df


def links(distinct: DataFrame, scratch: Scratch, bits: int = BITS) -> DataFrame:
    """Edges ``(a, b)`` that connect all fingerprints ``fp`` of ``distinct`` with ``bits`` differing bits at most."""
    schema = "cell long, free long, fp long"
    level = distinct.select(F.lit(0).cast("long").alias("cell"), F.lit(-1).cast("long").alias("free"), "fp")
    bands, found = bands_for(distinct.count(), bits), None
    while True:
        cells = scratch.save(level.mapInArrow(_dealt(bits, bands), schema), "cells")
        sizes = cells.groupBy("cell").agg(F.count("*").alias("n")).filter("n > 1")
        sizes = scratch.save(sizes, "sizes")
        crowded = sizes.filter(F.col("n") > CROWDED).select("cell")
        several = cells.join(_listed(sizes.filter(F.col("n") <= CROWDED).select("cell")), "cell", "left_semi")
        met = several.repartition("cell").sortWithinPartitions("cell", "fp").mapInArrow(_compared(bits), "a long, b long")
        met = scratch.save(met, "links")
        found = met if found is None else found.union(met)
        if not crowded.limit(1).count():
            return found
        level = cells.join(_listed(crowded), "cell", "left_semi").select("cell", "free", "fp")
        bands = bits + 2


def near_duplicate_groups(docs: DataFrame, bits: int = BITS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``fingerprint`` (16 hex digits), ``component_id``: the least id reachable by links."""
    scratch = Scratch(docs.sparkSession, "simhash")
    docs = plain_columns(docs, doc_id=id_column, text=text_column).withColumn("doc_id", F.col("doc_id").cast("long"))
    rows = scratch.save(docs.mapInArrow(_fingerprints, "doc_id long, fp long"), "fingerprints")
    classes = scratch.save(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "classes")
    groups = scratch.save(connected_components(links(classes.select("fp"), scratch, bits), scratch), "groups")
    grouped = groups.withColumnRenamed("node", "fp").join(classes, "fp")
    least = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    linked = grouped.join(least, "component").select("fp", "component_id")
    alone = classes.filter("n > 1").join(groups.select(F.col("node").alias("fp")), "fp", "left_anti")
    labels = scratch.save(linked.union(alone.select("fp", F.col("least").alias("component_id"))), "labels")
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    joined = rows.join(_listed(labels).withColumn("known", F.lit(True)), "fp", "left")
    # An unknown fingerprint is alone with its row.
    return joined.select("doc_id", hexed, F.when(F.col("known"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
