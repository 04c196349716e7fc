"""Packing of documents into sequences of a fixed length by length patterns.

Only the histogram of piece lengths decides what goes together.  It has one
entry for each length, so the driver holds it whatever the corpus' size.

* Patterns of one, two or three lengths that fill a sequence exactly are
  enumerated.  Non-negative least squares finds repeat counts whose lengths come
  nearest to the histogram.  The counts are rounded, and cut where the pieces of a
  length run out.
* What is left is packed by best fit, longest first, all pieces of a length and
  all equal sequences in one step.

The plan names, for each length, which of its pieces (numbered within the length)
go to which sequences and places.  Pieces are numbered without gathering a
length anywhere: each task counts its own, and the counts of the tasks are added
up before them.  Then every piece finds its slot by itself.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evenground.llm.common import text_batches
from evenground.llm.tokenfile import encoded_chunks
from evenground.session import small_side, written


def patterns(size: int, lengths: np.ndarray, documents: int = 3) -> np.ndarray:
    """Rows of up to ``documents`` (3 at most) of the ``lengths`` that add up to
    ``size``, shortest first, zeros in front."""
    there = np.zeros(size + 1, bool)
    there[lengths] = True
    out = [np.array([[0, 0, size]])] if there[size] else []
    if documents >= 2:
        a = lengths[2 * lengths <= size]
        a = a[there[size - a]]
        out.append(np.stack((np.zeros_like(a), a, size - a), axis=1))
    if documents >= 3:
        for a in lengths[3 * lengths <= size].tolist():
            b = lengths[(lengths >= a) & (2 * lengths <= size - a)]
            b = b[there[size - a - b]]
            out.append(np.stack((np.full_like(b, a), b, size - a - b), axis=1))
    return np.concatenate(out) if out else np.zeros((0, 3), np.int64)


def nearest_counts(rows: np.ndarray, histogram: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Repeat counts x >= 0 of the patterns that bring the squares of ``histogram``
    minus the lengths they use near to their least.

    Block coordinate descent: each round takes the patterns of greatest gain that
    share no length, and moves each to its best count, not below zero; without
    a common length all of them are at their best together.  It ends when a round
    gains next to nothing, at the latest after ``rounds``; what a fit leaves is
    packed afterwards anyway.
    """
    size = len(histogram) - 1
    x = np.zeros(len(rows))
    rest = histogram.astype(np.float64)
    rest[0] = 0.0
    start = float(rest @ rest)
    # a length that a pattern holds twice counts four times
    real = rows > 0
    bend = real.sum(axis=1) + 2.0 * sum((rows[:, i] == rows[:, j]) & real[:, i] for i, j in ((0, 1), (0, 2), (1, 2)))
    for _ in range(rounds):
        slope = rest[rows].sum(axis=1)
        step = np.maximum(slope / bend, -x)
        gain = step * (slope - 0.5 * bend * step)
        best = np.argpartition(-gain, min(3 * size, len(gain) - 1))[: 3 * size]
        taken, chosen = bytearray(size + 1), []
        for p, (a, b, c) in zip(order := best[np.argsort(-gain[best])].tolist(), rows[order].tolist()):
            if not (taken[a] or taken[b] or taken[c]):
                taken[a] = taken[b] = taken[c] = 1
                taken[0] = 0
                chosen.append(p)
        gained = float(gain[chosen].sum())
        x[chosen] += step[chosen]
        rest -= np.bincount(rows[chosen].ravel(), np.repeat(step[chosen], 3), size + 1)
        rest[0] = 0.0
        if gained <= 1e-9 * start:
            break
    return x


@dataclass
class Group:
    """``repeat`` equal sequences: lengths with their copies in each, space left."""

    content: tuple[tuple[int, int], ...]
    repeat: int
    space: int


def fitted(histogram: np.ndarray, documents: int = 3) -> list[Group]:
    """Sequences from rounded pattern counts; takes their pieces out of
    ``histogram``."""
    size = len(histogram) - 1
    rows = patterns(size, np.flatnonzero(histogram), documents)
    if not len(rows):
        return []
    counts = np.rint(nearest_counts(rows, histogram)).astype(np.int64)
    out = []
    for p in np.argsort(-counts, kind="stable"):
        if counts[p] == 0:
            break
        lengths, copies = np.unique(rows[p][rows[p] > 0], return_counts=True)
        repeat = int(min(counts[p], (histogram[lengths] // copies).min()))
        if repeat:
            histogram[lengths] -= repeat * copies
            out.append(Group(tuple(zip(lengths.tolist(), copies.tolist())), repeat, 0))
    return out


def best_fit(histogram: np.ndarray) -> list[Group]:
    """Residual pieces, longest first, each into the sequence that it leaves the
    least space in.  Equal sequences are filled together, so the work follows
    the number of lengths and not the number of pieces."""
    size = len(histogram) - 1
    open_: list[Group] = []  # by space
    spaces: list[int] = []
    closed: list[Group] = []

    def put(group: Group) -> None:
        if group.space == 0:
            closed.append(group)
        else:
            at = bisect_left(spaces, group.space)
            spaces.insert(at, group.space)
            open_.insert(at, group)

    for length in range(size, 0, -1):
        left = int(histogram[length])
        while left:
            at = bisect_left(spaces, length)
            if at == len(spaces):
                group = Group((), left, size)
            else:
                spaces.pop(at)
                group = open_.pop(at)
            copies = min(group.space // length, left)
            full = min(group.repeat, left // copies)
            if full < group.repeat and group.content:
                put(Group(group.content, group.repeat - full, group.space))
            put(Group((*group.content, (length, copies)), full, group.space - copies * length))
            left -= full * copies
    return closed + open_


@dataclass
class Plan:
    """Slots by length, then first piece: the pieces ``first``, ``first + 1`` ...
    of a length fill ``copies`` places after ``offset`` in one sequence after the
    other, from ``sequence`` on."""

    length: np.ndarray
    first: np.ndarray
    sequence: np.ndarray
    copies: np.ndarray
    offset: np.ndarray
    sequences: int

    def places(self, lengths: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of pieces by length and number within the length."""
        slot = np.empty(len(lengths), np.int64)
        for n in np.unique(lengths):  # as many as there are lengths
            own = np.flatnonzero(lengths == n)
            a, b = np.searchsorted(self.length, (n, n + 1))
            slot[own] = a + np.searchsorted(self.first[a:b], numbers[own], side="right") - 1
        beyond = numbers - self.first[slot]
        return self.sequence[slot] + beyond // self.copies[slot], self.offset[slot] + beyond % self.copies[slot] * lengths


def plan_of(histogram: np.ndarray, documents: int = 3) -> Plan:
    """Slots for ``histogram[length]`` pieces of each length up to the last."""
    rest = histogram.astype(np.int64).copy()
    groups = fitted(rest, documents) + best_fit(rest)
    used = np.zeros(len(histogram), np.int64)
    slots, sequences = [], 0
    for group in groups:
        offset = 0
        for length, copies in group.content:
            slots.append((length, int(used[length]), sequences, copies, offset))
            used[length] += copies * group.repeat
            offset += copies * length
        sequences += group.repeat
    slots.sort()
    columns = np.array(slots, np.int64).reshape(-1, 5).T
    return Plan(*columns, sequences)


def pieces(docs: DataFrame, tokenizer: str, key: str, text: str, end: int | None, size: int, ids: bool) -> DataFrame:
    """Pieces of at most ``size`` ids of each document, the first one the
    shorter; ``part`` and ``in_part`` number those of one length in a task."""
    text_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), np.zeros(size + 1, np.int64)
        for keys, encoded in encoded_chunks(batches, tokenizer):
            values = [np.append(v, end).astype("<u4") if end is not None else v.astype("<u4") for v in encoded]
            total = np.array([len(v) for v in values], np.int64)
            many = np.maximum(-(-total // size), 1)
            owner = np.repeat(np.arange(len(values)), many)
            piece = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
            shorter = total - (many - 1) * size
            start = np.where(piece == 0, 0, shorter[owner] + (piece - 1) * size)
            length = np.where(piece == 0, shorter[owner], size)
            raw = [values[o][a : a + n].tobytes() for o, a, n in zip(owner.tolist(), start.tolist(), length.tolist())]
            order = np.argsort(length, kind="stable")
            ordered = length[order]
            firsts = np.searchsorted(ordered, ordered)
            number = np.empty(len(length), np.int64)
            number[order] = np.arange(len(length)) - firsts + seen[ordered]
            seen += np.bincount(length, minlength=size + 1)
            columns = [keys.take(pa.array(owner)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array([zlib.crc32(r) for r in raw], pa.int64()),
                       pa.array(np.full(len(owner), part), pa.int32()), pa.array(number)]
            names = ["key_", "piece", "start", "length", "ids_crc32", "part", "in_part"]
            if ids:
                columns.append(pa.array(raw, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = docs.select(F.col(key).alias("key_"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text_"))
    kind = docs.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"key_ {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, part int, in_part bigint" + ", ids binary" * ids)


def packed(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", end: int | None = None, size: int = 1024,
           documents: int = 3, ids: bool = True) -> DataFrame:
    """``key``, ``piece`` (from 0), ``start``, ``length``, ``ids_crc32``,
    ``sequence_id``, ``offset`` and, with ``ids``, ``ids`` (unsigned 32-bit,
    little-endian) of each piece of each row.

    A NULL text is empty: it has the end id only or, without one, a piece of
    length 0 without a sequence.  Repeated rows and keys and NULL keys have pieces
    of their own; an empty table gives no rows; other columns of ``docs`` are not
    read.  Sequences are numbered from 0 on without gaps; which of several pieces
    of one length stands in which sequence follows the order in the files.
    """
    if size < 2 or documents not in (1, 2, 3):
        raise ValueError("sequences hold two tokens at least, patterns one to three documents")
    table = written(pieces(docs, tokenizer, key, text, end, size, ids), "pieces")
    counts = written(table.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-counts")
    histogram = np.zeros(size + 1, np.int64)
    for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # one row for each length
        histogram[row["length"]] = row["n"]
    histogram[0] = 0
    plan = plan_of(histogram, documents)
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    numbered = table.join(small_side(before), ["part", "length"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, numbers = batch.column("length").to_numpy(), batch.column("in_part").to_numpy() + batch.column("before").to_numpy()
            real = np.flatnonzero(lengths > 0)
            there = np.ones(len(lengths), bool)
            there[real] = False
            sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
            sequence[real], offset[real] = plan.places(lengths[real], numbers[real])
            columns = {n: batch.column(n) for n in ("key_", "piece", "start", "length", "ids_crc32")}
            columns |= {"sequence_id": pa.array(sequence, mask=there), "offset": pa.array(offset, mask=there)}
            if ids:
                columns["ids"] = batch.column("ids")
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    kind = docs.schema[key].dataType.simpleString()
    out = numbered.select("key_", "piece", "start", "length", "ids_crc32", "in_part", "before", *["ids"] * ids).mapInArrow(
        run, f"key_ {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint" + ", ids binary" * ids)
    return out.withColumnRenamed("key_", key)


def sequences(pieces_: DataFrame) -> DataFrame:
    """``sequence_id``, ``n_tokens`` and ``ids`` (unsigned 32-bit, little-endian) of
    whole sequences from what ``packed`` gives with ``ids``; a group has as many
    pieces as a sequence has tokens at most."""
    each = pieces_.where(F.col("sequence_id").isNotNull()).groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"), F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("all_"))
    joined = F.aggregate("all_", F.lit(b"").cast("binary"), lambda s, p: F.concat(s, p["ids"]))
    return each.select("sequence_id", "n_tokens", joined.alias("ids"))
