"""Transcript parsing with a hidden Markov model, and canonical rendering of the recovered turns.

A transcript is a sequence of lines. Each line has a hidden state: the role that speaks and whether
the line begins a turn or goes on with it. Seen are the line's speaker marker and features (length,
ending, a blank line before, the transcript's first line), taken as independent given the state. Emission and
transition counts are learned from labelled transcripts, in tables of fixed size; Viterbi finds the best states.

A long transcript is cut into segments of ``SEGMENT`` pieces, counted in order: pieces are sorted by ranges over all
tasks, and a transcript that reaches over several ranges is numbered on by their offsets. Viterbi is a product of matrices in
(max, +), so every segment first gives its 6 x 6 matrix of best scores, the states at the segments' borders are
chosen from those alone, and each segment is then decoded between its borders, in a task of its own: the
result is that of one run over the whole transcript. A turn that goes on over borders is put together again.

Cases: pieces with null or empty text have one empty line. Pieces with a null position come first, ties go
by text; equal pieces at one position count once. A null conversation is one of its own. An empty table gives none.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runatlas.llm.scratch import Scratch, plain_columns

ROLES = ("system", "user", "assistant")
STATES = tuple((role, begins) for role in ROLES for begins in (True, False))
SEGMENT = 1024
SMOOTHING = 0.5

_NAMES = {
    "system": ("system", "sys", "context"),
    "user": ("user", "human", "question", "q", "customer", "instruction"),
    "assistant": ("assistant", "ai", "bot", "answer", "a", "model", "response"),
}
_ROLE_OF = {name: role for role, names in _NAMES.items() for name in names}
_ANY_NAME = "|".join(sorted(_ROLE_OF, key=len, reverse=True))
MARKER = re.compile(rf"\s*(?:\#+\s*({_ANY_NAME})\s*:?|\*\*({_ANY_NAME}):?\*\*:?|<\|({_ANY_NAME})\|>|\[({_ANY_NAME})\]:?|({_ANY_NAME})\s*:)\s*", re.I)
OTHER_NAME = re.compile(r"\s*[A-Z][\w.-]{0,20}:\s")

#: Number of values of each feature: marker, words, ending, blank line before, first line.
FEATURES = (5, 5, 4, 2, 2)


def marker_of(line: str) -> tuple[str | None, int]:
    """The role that a line's speaker marker names, and the marker's length."""
    found = MARKER.match(line)
    if not found:
        return None, 0
    return _ROLE_OF[next(g for g in found.groups() if g).lower()], found.end()


def features(line: str, before: str | None) -> tuple[int, ...]:
    role, _ = marker_of(line)
    marker = ROLES.index(role) + 1 if role else 4 if OTHER_NAME.match(line) else 0
    words = len(line.split())
    size = 0 if not words else 1 if words <= 3 else 2 if words <= 10 else 3 if words <= 30 else 4
    last = line.rstrip()[-1:]
    ending = 1 if last == "?" else 2 if last in (".", "!") and last else 3 if last else 0
    return marker, size, ending, int(before is not None and not before.strip()), int(before is None)


def lines_of(text: str | None) -> list[str]:
    return (text or "").replace("\r\n", "\n").split("\n")


class Model:
    """Logarithms of start, transition and emission probabilities."""

    def __init__(self, starts: np.ndarray, moves: np.ndarray, seen: list[np.ndarray]):
        def logs(counts: np.ndarray) -> np.ndarray:
            smooth = counts + SMOOTHING
            return np.log(smooth / smooth.sum(axis=-1, keepdims=True))

        begins = np.array([b for _, b in STATES])
        self.start = np.where(begins, logs(starts), -np.inf)
        self.move = logs(moves)
        # Only the same role can go on with a turn.
        for i, (before, _) in enumerate(STATES):
            for j, (role, b) in enumerate(STATES):
                if not b and role != before:
                    self.move[i, j] = -np.inf
        self.seen = [logs(s) for s in seen]  # per feature: states x values

    def emissions(self, lines: list[str], before: str | None) -> np.ndarray:
        out = np.zeros((len(lines), len(STATES)))
        for n, line in enumerate(lines):
            for table, value in zip(self.seen, features(line, before), strict=True):
                out[n] += table[:, value]
            before = line
        return out

    def matrix(self, emissions: np.ndarray, first: bool) -> np.ndarray:
        """Best score from each state before the segment to each state of its last line; for the first segment all rows are alike."""
        best = (np.tile(self.start, (len(STATES), 1)) if first else self.move) + emissions[0]
        for row in emissions[1:]:
            best = (best[:, :, None] + self.move[None]).max(axis=1) + row
        return best

    def decode(self, emissions: np.ndarray, entry: int | None, leave: int | None) -> list[int]:
        """The best states, after the state ``entry`` (or from the start) and ending in ``leave`` (or anywhere)."""
        best = (self.start if entry is None else self.move[entry]) + emissions[0]
        back = []
        for row in emissions[1:]:
            scores = best[:, None] + self.move
            back.append(scores.argmax(axis=0))
            best = scores.max(axis=0) + row
        states = [int(best.argmax()) if leave is None else leave]
        for pointer in reversed(back):
            states.append(int(pointer[states[-1]]))
        return states[::-1]


def border_states(matrices: list[np.ndarray]) -> list[int]:
    """The state of the last line of each segment, from the segments' matrices in order."""
    best = matrices[0][0]
    back = []
    for matrix in matrices[1:]:
        scores = best[:, None] + matrix
        back.append(scores.argmax(axis=0))
        best = scores.max(axis=0)
    states = [int(best.argmax())]
    for pointer in reversed(back):
        states.append(int(pointer[states[-1]]))
    return states[::-1]


def _groups(batches, names: list[str]) -> Iterator[list[tuple]]:
    """Runs of rows with equal first two columns, from sorted batches."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*[batch.column(n).to_pylist() for n in names], strict=True):
            if held and held[0][:2] != row[:2]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _count(batches):
    """Counts of starts, moves and feature values, as rows ``(kind, state, value, n)``."""
    starts = np.zeros(len(STATES), dtype=np.int64)
    moves = np.zeros((len(STATES), len(STATES)), dtype=np.int64)
    seen = [np.zeros((len(STATES), values), dtype=np.int64) for values in FEATURES]
    for rows in _groups(batches, ["conv", "segment", "text", "role"]):
        before_line, before_state = None, None
        for _, segment, text, role in rows:
            if role not in ROLES:
                before_line, before_state = "", None
                continue
            for n, line in enumerate(lines_of(text)):
                state = STATES.index((role, n == 0))
                if before_state is not None:
                    moves[before_state, state] += 1
                elif segment == 0 and before_line is None:
                    starts[state] += 1
                if before_line is not None or segment == 0:
                    for table, value in zip(seen, features(line, before_line), strict=True):
                        table[state, value] += 1
                before_line, before_state = line, state
    tables = [starts[:, None], moves, *seen]
    kind, state, value, n = zip(*[(k, *at, int(v)) for k, t in enumerate(tables) for at, v in np.ndenumerate(t)], strict=True)
    yield pa.RecordBatch.from_pydict({"kind": pa.array(kind, pa.int32()), "state": pa.array(state, pa.int32()), "value": pa.array(value, pa.int32()), "n": pa.array(n, pa.int64())})


_NO_CONV = "\u0000"


def _key(conv: Column) -> Column:
    """The conversation as a string that is never null."""
    return F.coalesce(conv.cast("string"), F.lit(_NO_CONV))


def _numbered(batches):
    """Rows of a sorted partition, with the partition and the number of the row among those of its conversation there."""
    part, conv, number = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        numbers = []
        for this in batch.column("conv").to_pylist():
            number = number + 1 if this == conv else 0
            conv = this
            numbers.append(number)
        more = [pa.array([part] * batch.num_rows, pa.int32()), pa.array(numbers, pa.int64())]
        yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, "part", "number"])


def _pieces(df: DataFrame, role: bool, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Pieces with their segment, and the table below them; equal pieces of a position count once."""
    columns = ["conv", "position", "text", *(["role"] if role else [])]
    once = df.select(*columns).distinct()
    order = ["conv", *[F.col(c).asc_nulls_first() for c in columns[1:]]]
    ranged = once.repartitionByRange(*order).sortWithinPartitions(*order)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in once.schema.fields)
    table = scratch.save(ranged.mapInArrow(_numbered, f"{fields}, part int, number long"), "numbered")
    # Only the first conversation of a part can have begun in an earlier one: at most one offset a part.
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = table.groupBy("part", "conv").agg(F.count("*").alias("n")).withColumn("offset", F.sum("n").over(before))
    offsets = F.broadcast(offsets.filter("offset > 0").select("part", "conv", "offset"))
    rank = F.col("number") + F.coalesce("offset", F.lit(0))
    numbered = table.join(offsets, ["part", "conv"], "left").select(*columns, F.floor(rank / SEGMENT).cast("long").alias("segment"))
    return numbered, table


def _sorted(pieces: DataFrame) -> DataFrame:
    order = ["conv", "segment", F.col("position").asc_nulls_first(), F.col("text").asc_nulls_first()]
    return pieces.repartition("conv", "segment").sortWithinPartitions(*order)


def learn(labelled: DataFrame) -> Model:
    """A model from ``labelled(conv, position, role, text)``; rows of other roles break the sequence."""
    scratch = Scratch(labelled.sparkSession, "chat")
    pieces, table = _pieces(labelled, True, scratch)
    counted = _sorted(pieces).mapInArrow(_count, "kind int, state int, value int, n long")
    tables = [np.zeros((len(STATES), 1)), np.zeros((len(STATES), len(STATES))), *[np.zeros((len(STATES), v)) for v in FEATURES]]
    for kind, state, value, n in counted.groupBy("kind", "state", "value").agg(F.sum("n")).collect():  # of fixed size
        tables[kind][state, value] = n
    scratch.drop(table)
    return Model(tables[0][:, 0], tables[1], tables[2:])


def _with_lines(rows: list[tuple]) -> list[str]:
    return [line for row in rows for line in lines_of(row[2])]


def _matrices(shared):
    def run(batches):
        for rows in _groups(batches, ["conv", "segment", "text", "last"]):
            model: Model = shared.value
            emissions = model.emissions(_with_lines(rows), rows[0][3])
            yield pa.RecordBatch.from_pydict(
                {
                    "conv": pa.array([rows[0][0]], pa.string()),
                    "segment": pa.array([rows[0][1]], pa.int64()),
                    "matrix": pa.array([model.matrix(emissions, rows[0][3] is None).ravel().tolist()], pa.list_(pa.float64())),
                }
            )

    return run


def _borders(batches):
    held: list[tuple] = []

    def chosen() -> pa.RecordBatch:
        size = len(STATES)
        leave = border_states([np.array(r[2]).reshape(size, size) for r in held])
        return pa.RecordBatch.from_pydict(
            {
                "conv": pa.array([r[0] for r in held], pa.string()),
                "segment": pa.array([r[1] for r in held], pa.int64()),
                "entry": pa.array([None, *leave[:-1]], pa.int32()),
                "leave": pa.array(leave, pa.int32()),
                "several": pa.array([len(held) > 1] * len(held), pa.bool_()),
            }
        )

    for batch in batches:
        for row in zip(*[batch.column(n).to_pylist() for n in ("conv", "segment", "matrix")], strict=True):
            if held and held[0][0] != row[0]:
                yield chosen()
                held = []
            held.append(row)
    if held:
        yield chosen()


def render(role: str, text: str) -> str:
    return f"<|{role}|>\n{text}\n<|end|>"


def _decode(shared):
    names = ["conv", "segment", "text", "last", "entry", "leave"]

    def run(batches):
        for rows in _groups(batches, names):
            conv, segment, _, last, entry, leave = rows[0]
            lines = _with_lines(rows)
            model: Model = shared.value
            states = model.decode(model.emissions(lines, last), entry, leave)
            turns: list[tuple[str, bool, list[str]]] = []
            for line, state in zip(lines, states, strict=True):
                role, begins = STATES[state]
                if begins or not turns:
                    turns.append((role, not begins, []))
                    named, length = marker_of(line)
                    if begins and named:
                        line = line[length:]
                        if not line:
                            continue
                turns[-1][2].append(line)
            yield pa.RecordBatch.from_pydict(
                {
                    "conv": pa.array([conv] * len(turns), pa.string()),
                    "segment": pa.array([segment] * len(turns), pa.int64()),
                    "turn": pa.array(range(len(turns)), pa.int64()),
                    "role": pa.array([t[0] for t in turns], pa.string()),
                    "continued": pa.array([t[1] for t in turns], pa.bool_()),
                    "n_lines": pa.array([len(t[2]) for t in turns], pa.int64()),
                    "text": pa.array(["\n".join(t[2]) for t in turns], pa.string()),
                }
            )

    return run


def parse_transcripts(pieces: DataFrame, model: Model, conv: str = "conv_id", position: str = "position", text: str = "text") -> DataFrame:
    """Recovered turns ``(conv_id, segment, turn, role, continued, n_lines, rendered)`` of raw transcripts.

    ``pieces`` are consecutive parts of transcripts, of whole lines each. Turns are numbered through the transcript;
    ``segment`` is that in which the turn begins. Turns are whole, so ``continued`` is false.
    """
    spark = pieces.sparkSession
    scratch = Scratch(spark, "chat")
    kind = pieces.schema[conv].dataType
    shared = spark.sparkContext.broadcast(model)
    raw = plain_columns(pieces, conv=conv, position=position, text=text).withColumn("conv", _key(F.col("conv")))
    # One table of segments for both passes: each with the line that stands before it.
    dealt, _ = _pieces(raw, False, scratch)
    ends = F.max_by("text", F.struct(F.col("position").isNotNull(), "position", F.col("text").isNotNull(), "text")).alias("end")
    tails = dealt.groupBy("conv", "segment").agg(ends)
    before = F.lag(F.element_at(F.split(F.regexp_replace(F.coalesce("end", F.lit("")), "\r\n", "\n"), "\n"), -1))
    tails = tails.select("conv", "segment", before.over(Window.partitionBy("conv").orderBy("segment")).alias("last"))
    tails = scratch.save(tails, "tails")

    def joined(table: DataFrame, *columns: str) -> DataFrame:
        return _sorted(dealt.join(table.select("conv", "segment", *columns), ["conv", "segment"]))

    matrices = joined(tails, "last").mapInArrow(_matrices(shared), "conv string, segment long, matrix array<double>")
    borders = (
        matrices.repartition("conv")
        .sortWithinPartitions("conv", "segment")
        .mapInArrow(_borders, "conv string, segment long, entry int, leave int, several boolean")
    )
    chosen = scratch.save(tails.join(borders, ["conv", "segment"]), "borders")
    schema = "conv string, segment long, turn long, role string, continued boolean, n_lines long, text string"

    def decoded(some: DataFrame) -> DataFrame:
        return joined(some, "last", "entry", "leave").mapInArrow(_decode(shared), schema)

    turns = decoded(chosen.filter("not several"))
    if not chosen.filter("several").isEmpty():
        turns = turns.unionByName(_whole_turns(scratch.save(decoded(chosen.filter("several")), "parts")))
    named = F.when(F.col("conv") != _NO_CONV, F.col("conv")).cast(kind)
    rendered = F.concat(F.lit("<|"), "role", F.lit("|>\n"), F.btrim("text", F.lit("\n")), F.lit("\n<|end|>"))  # as render()
    return turns.select(named.alias("conv_id"), *turns.columns[1:-1], rendered.alias("rendered"))


def _whole_turns(parts: DataFrame) -> DataFrame:
    """The turns of segments as turns of their transcripts: what goes on with a turn is joined to it."""
    begun = parts.groupBy("conv", "segment").agg(
        F.count_if(~F.col("continued")).alias("begun"), F.count_if("continued").alias("shift")
    )
    before = Window.partitionBy("conv").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    begun = begun.withColumn("offset", F.coalesce(F.sum("begun").over(before), F.lit(0)) - F.col("shift"))
    numbered = parts.join(begun.select("conv", "segment", "offset"), ["conv", "segment"])
    numbered = numbered.withColumn("turn", F.col("turn") + F.col("offset"))
    joined = numbered.groupBy("conv", "turn", "role").agg(
        F.min("segment").alias("segment"),
        F.sum("n_lines").alias("n_lines"),
        F.array_sort(F.collect_list(F.struct("segment", "text"))).alias("parts"),
    )
    text = F.array_join(F.transform("parts", lambda p: p["text"]), "\n")
    return joined.select("conv", "segment", "turn", "role", F.lit(False).alias("continued"), "n_lines", text.alias("text"))


def raw_transcripts(turns: DataFrame) -> DataFrame:
    """``conversations`` written as raw transcripts in one of six styles each; the last two leave markers out.

    ``position`` is the turn, ``text`` the lines that a parser sees, ``role`` the label.
    """
    style = F.pmod(F.xxhash64(F.lit("style"), "conv_id"), F.lit(6))
    dropped = F.crc32(F.concat_ws("/", F.col("conv_id").cast("string"), F.col("turn").cast("string")).cast("binary")) % 3 == 0

    def name(system: str, user: str, assistant: str) -> Column:
        role = F.col("role")
        return F.when(role == "system", system).when(role == "user", user).when(role == "assistant", assistant).otherwise("")

    marked = (
        F.when(style == 0, name("System: ", "User: ", "Assistant: "))
        .when(style == 1, name("### System:\n", "### Human:\n", "### Assistant:\n"))
        .when(style == 2, name("<|system|>\n", "<|user|>\n", "<|assistant|>\n"))
        .when(style == 3, name("[system] ", "Q: ", "A: "))
        .when((style == 4) & ~dropped, name("Context: ", "Question: ", "Answer: "))
        .otherwise("")
    )
    apart = F.when(style >= 4, "\n").otherwise("")
    text = F.concat(marked, F.coalesce("text", F.lit("")), apart)
    return turns.select("conv_id", F.col("turn").alias("position"), "role", text.alias("text"))


def held_out(conv: str = "conv_id") -> Column:
    return F.coalesce(F.crc32(F.col(conv).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def format_conversations(conversations: DataFrame) -> DataFrame:
    """Raw transcripts of all conversations, parsed by a model of those that are not held out."""
    turns = plain_columns(conversations, conv_id="conv_id", turn="turn", role="role", text="text")
    raw = raw_transcripts(turns)
    labelled = raw.filter(~held_out()).withColumn("conv", _key(F.col("conv_id")))
    Scratch(conversations.sparkSession, "chat")
    return parse_transcripts(raw, learn(labelled))
