"""Removal of long byte strings that stand elsewhere in the corpus.

Seeds come first: the least hash of the 64-byte strings in each window of
``size`` bytes.  Equal windows have equal seeds, so a window whose seed stands
once in the corpus is not repeated, and the windows of one seed can be judged
apart from all others.  Runs of windows with a common seed are cut out as
pieces; equal pieces are one piece with a count.

A task joins the pieces of whole seeds to shards and builds the suffix array
of each by induced sorting: suffixes are classified, leftmost smaller ones are
named and sorted by recursion, and the shard's array is induced from them in
two passes over the buckets, each handling whole stretches of a bucket at a
time.  Permuted common prefixes are compared at irreducible places only.  A
window is repeated where its prefix in common with a neighbour has ``size``
bytes or more.

A seed with very many different pieces (a passage in a third of the corpus)
would not fit into one shard.  Its windows are dealt out by their own 128-bit
hashes instead and counted, which comes to the same.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenground.llm.backoff import BACK, BASE, _SYMBOL, _powers
from evenground.llm.common import text_batches
from evenground.llm.pieces import mix
from evenground.session import written

GRAM = 64
SHARD_BYTES = 2_500_000
#: pieces of one seed that go to one shard; beyond, windows are dealt out
SEED_PIECES = 4_000
CUT = 0xFF  # no byte of UTF-8
NEVER = np.uint64(2**64 - 1)


# --- suffix arrays ---------------------------------------------------------

def smaller(t: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one."""
    ends = np.concatenate((np.flatnonzero(t[1:] != t[:-1]), [len(t) - 1]))
    value = np.append(t[ends[:-1]] < t[ends[:-1] + 1], True)
    return np.repeat(value, np.diff(np.concatenate(([-1], ends))))


def _refined(symbols: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Ranks of the strings ``starts .. stops`` (inclusive) of symbols of which
    none is a proper prefix of another: the number of smaller strings."""
    rank, active, k = np.zeros(len(starts), np.int64), np.arange(len(starts)), 0
    while len(active):
        sign = symbols[starts[active] + k]
        order = np.lexsort((sign, rank[active]))
        of, r, s = active[order], rank[active][order], sign[order]
        place = np.arange(len(of))
        new_group = np.concatenate(([True], r[1:] != r[:-1]))
        new_part = new_group | np.concatenate(([True], s[1:] != s[:-1]))
        at = np.maximum.accumulate(np.where(new_part, place, 0))
        rank[of] = r + at - np.maximum.accumulate(np.where(new_group, place, 0))
        alone = new_part & np.append(new_part[1:], True)
        active = of[~alone & (starts[of] + k < stops[of])]
        k += 1
    return rank


def _induced(t: np.ndarray, leftmost: np.ndarray, sigma: int) -> np.ndarray:
    """All suffixes in order, from the order of the leftmost smaller ones;
    ``t`` has symbols below ``sigma`` and ends with the only 0."""

    def deal(prev: np.ndarray, into: list[list[np.ndarray]]) -> None:
        if not len(prev):
            return
        sign = t[prev]
        order = np.argsort(sign, kind="stable")
        prev, sign = prev[order], sign[order]
        cuts = np.flatnonzero(sign[1:] != sign[:-1]) + 1
        for c, part in zip(sign[np.concatenate(([0], cuts))].tolist(), np.split(prev, cuts)):
            into[c].append(part)

    heads = np.searchsorted(t[leftmost], np.arange(sigma + 1))
    larger: list[list[np.ndarray]] = [[] for _ in range(sigma)]
    for c in range(sigma):
        done, q = [], np.concatenate(larger[c]) if larger[c] else np.zeros(0, np.int64)
        while len(q):
            done.append(q)
            prev = q[q > 0] - 1
            sign = t[prev]
            deal(prev[sign > c], larger)
            q = prev[sign == c]
        larger[c] = done
        seeds = leftmost[heads[c] : heads[c + 1]]
        deal(seeds[seeds > 0] - 1, larger)
    less: list[list[np.ndarray]] = [[] for _ in range(sigma)]
    out: list[np.ndarray] = []
    for c in range(sigma - 1, 0, -1):
        done, q = [], np.concatenate(less[c]) if less[c] else np.zeros(0, np.int64)
        while len(q):
            done.append(q)
            prev = q[q > 0] - 1
            sign = t[prev]
            deal(prev[sign < c], less)
            q = prev[sign == c]
        large = np.concatenate(larger[c]) if larger[c] else np.zeros(0, np.int64)
        back = large[::-1]
        prev = back[back > 0] - 1
        deal(prev[t[prev] < c], less)
        out.append(np.concatenate([large, *([np.concatenate(done)[::-1]] if done else [])]))
    return np.concatenate([np.array([len(t) - 1]), *out[::-1]])


def suffix_array(t: np.ndarray, sigma: int | None = None) -> np.ndarray:
    """Suffix array of numbers from 0 on of which the last is the only 0.

    With few symbols (``sigma``) the array is induced bucket by bucket; the
    strings of names of the recursion have many, and take their order from
    each suffix's stretch up to the next leftmost smaller one and that one's rank.
    """
    n = len(t)
    if n == 1:
        return np.zeros(1, np.int64)
    s = smaller(t)
    leftmost = np.flatnonzero(s[1:] & ~s[:-1]) + 1
    typed = t.astype(np.int64) * 2 + s
    stops = np.append(leftmost[1:], n - 1)
    if sigma is not None:
        by_sign = leftmost[np.argsort(t[leftmost], kind="stable")]
        is_left = np.zeros(n, bool)
        is_left[leftmost] = True
        rough = _induced(t, by_sign, sigma)
        rough = rough[is_left[rough]]
        stop_of = np.zeros(n, np.int64)
        stop_of[leftmost] = stops
        same = np.zeros(len(rough), bool)
        a, b, k = rough[:-1], rough[1:], 0
        active = np.flatnonzero(stop_of[a] - a == stop_of[b] - b)
        while len(active):
            active = active[typed[a[active] + k] == typed[b[active] + k]]
            ended = a[active] + k >= stop_of[a[active]]
            same[active[ended] + 1] = True
            active, k = active[~ended], k + 1
        name_at = np.zeros(n, np.int64)
        name_at[rough] = np.cumsum(~same) - 1
        names = name_at[leftmost]
    else:
        names = np.unique(_refined(typed, leftmost, stops), return_inverse=True)[1]
    if names.max(initial=-1) + 1 < len(names):
        order = suffix_array(names)
    else:
        order = np.argsort(names)
    if sigma is not None:
        return _induced(t, leftmost[order], sigma)
    rank = np.zeros(n, np.int64)
    rank[leftmost[order]] = np.arange(len(order))
    index = np.searchsorted(leftmost, np.arange(n), side="right")
    following = np.append(leftmost, n - 1)[index]
    tails = _refined(typed, np.arange(n), following)
    return np.lexsort((rank[following], tails))


def common_prefixes(raw: np.ndarray, array: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Permuted: for each place the length of the prefix in common with the
    suffix before it in ``array``, and that suffix (-1: none)."""
    n = len(raw)
    before = np.full(n, -1, np.int64)
    before[array[1:]] = array[:-1]
    place = np.arange(n)
    odd = (place == 0) | (before <= 0)
    rest = np.flatnonzero(~odd)
    odd[rest] = raw[rest - 1] != raw[before[rest] - 1]
    odd &= before >= 0
    padded = np.concatenate((raw, np.zeros(16, np.uint8)))
    words = np.ndarray((n + 8,), "<u8", padded.tobytes(), strides=(1,))
    a = np.flatnonzero(odd)
    b, have = before[a].copy(), np.zeros(len(a), np.int64)
    left = n - np.maximum(a, b)
    active, at = np.arange(len(a)), a.copy()
    while len(active):
        differ = words[at[active]] ^ words[b[active]]
        low = differ & (~differ + np.uint64(1))
        bits = np.where(differ == 0, 64, np.bitwise_count(low - np.uint64(1)))
        have[active] += bits >> 3
        more = (differ == 0) & (have[active] < left[active])
        active = active[more]
        at[active] += 8
        b[active] += 8
    reach = np.zeros(n, np.int64)
    reach[a] = np.minimum(have, left) + a
    return np.maximum(np.maximum.accumulate(reach) - place, 0), before


def repeated_starts(pieces: list[bytes], size: int) -> list[np.ndarray]:
    """Of each piece the places where a string of ``size`` bytes begins that
    begins elsewhere in the pieces, too."""
    raw = np.frombuffer(b"".join(p + bytes([CUT]) for p in pieces), np.uint8)
    used = np.unique(raw)
    code = np.zeros(256, np.uint16)
    code[used] = np.arange(1, len(used) + 1)
    array = suffix_array(np.append(code[raw], np.uint16(0)), len(used) + 1)[1:]
    prefix, before = common_prefixes(raw, array)
    far = np.flatnonzero(prefix >= size)
    mark = np.zeros(len(raw), bool)
    mark[far] = True
    mark[before[far]] = True
    out, at = [], 0
    for p in pieces:
        out.append(np.flatnonzero(mark[at : at + len(p) - size + 1]))
        at += len(p) + 1
    return out


# --- seeds and pieces ------------------------------------------------------

def _slid(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) of each ``width`` values in a row."""
    out, have = values, 1
    while 2 * have <= width:
        out, have = pick(out[:-have], out[have:]), 2 * have
    return pick(out[: len(values) - width + 1], out[width - have :][: len(values) - width + 1]) if have < width else out


def seed_runs(texts: list[bytes], size: int) -> tuple[np.ndarray, ...]:
    """(text, seed, first, last, twice) of each run of windows with one seed;
    ``twice``: the run may hold its seed more than once."""
    raw = np.frombuffer(b"".join(texts) + bytes(GRAM), np.uint8)
    n, width = len(raw) - GRAM, size - GRAM + 1
    lengths = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(lengths)
    if n < size:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_SYMBOL[raw] * _powers(BASE, len(raw)), dtype=np.uint64)))
    grams = np.minimum(mix((sums[GRAM : GRAM + n] - sums[:n]) * _powers(BACK, n)), NEVER - np.uint64(1))
    least = _slid(grams, width, np.minimum)  # of each window, by its first byte
    of_text = np.repeat(np.arange(len(texts)), lengths)
    first = (ends - lengths)[of_text]
    whole = (np.arange(n) + size <= ends[of_text])[: len(least)]
    starts = np.flatnonzero(whole)
    if not len(starts):
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    value = least[starts]
    new = np.concatenate(([True], (value[1:] != value[:-1]) | (starts[1:] != starts[:-1] + 1) | (of_text[starts[1:]] != of_text[starts[:-1]])))
    lo = starts[new]
    hi = starts[np.append(np.flatnonzero(new)[1:] - 1, len(starts) - 1)]
    shown = np.where(whole, least, np.uint64(0))
    padded = np.concatenate((np.zeros(width - 1, np.uint64), shown, np.zeros(n - len(shown), np.uint64)))
    anchors = np.flatnonzero(_slid(padded, width, np.maximum) == grams)
    again = np.concatenate(([0], np.cumsum(grams[anchors[1:]] == grams[anchors[:-1]]))) if len(anchors) else np.zeros(1, np.int64)
    a = np.searchsorted(anchors, lo)
    b = np.searchsorted(anchors, hi + width - 1, side="right") - 1
    twice = again[np.minimum(b, len(again) - 1)] > again[np.minimum(a, len(again) - 1)]
    return of_text[lo], value[new].view(np.int64), lo - first[lo], hi - first[lo], twice


def _runs(docs: DataFrame, size: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            text, seed, lo, hi, twice = seed_runs(batch.column(1).cast(pa.binary()).to_pylist(), size)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[text]), pa.array(seed), pa.array(lo), pa.array(hi), pa.array(twice.astype(bool))], names=["id_", "seed", "lo", "hi", "twice"])

    return docs.select("id_", "text_").mapInArrow(run, "id_ bigint, seed bigint, lo bigint, hi bigint, twice boolean")


def _pieces(listed: DataFrame, size: int) -> DataFrame:
    """Occurrences of pieces; the bytes come with the first one in a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            seen: set[bytes] = set()
            for id_, text, runs in zip(*(c.to_pylist() for c in batch.columns)):
                raw = text.encode()
                for r in runs:
                    piece = raw[r["lo"] : r["hi"] + size]
                    name = hashlib.md5(piece, usedforsecurity=False).digest()
                    rows.append((id_, r["seed"], r["lo"], r["hi"], name, None if name in seen else piece))
                    seen.add(name)
            columns = list(zip(*rows)) if rows else [[]] * 6
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["id_", "seed", "lo", "hi", "piece_id", "piece"])

    return listed.select("id_", "text_", "runs").mapInArrow(
        run, "id_ bigint, seed bigint, lo bigint, hi bigint, piece_id binary, piece binary")


def _ranges(starts: np.ndarray) -> list[dict]:
    """Runs of consecutive places."""
    cuts = np.flatnonzero(np.diff(starts) != 1)
    return [{"a": int(a), "b": int(b)} for a, b in zip(starts[np.concatenate(([0], cuts + 1))], starts[np.concatenate((cuts, [len(starts) - 1]))])]


RANGES = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))


def _sharded(pieces: DataFrame, size: int) -> DataFrame:
    """``piece_id`` and ``ranges`` of repeated places of the pieces that have any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: list[bytes] = []
        texts: list[bytes] = []
        total, last = 0, None

        def emit() -> pa.RecordBatch:
            found = [(n, _ranges(s)) for n, s in zip(names, repeated_starts(texts, size)) if len(s)]
            return pa.RecordBatch.from_arrays([pa.array([n for n, _ in found], pa.binary()), pa.array([r for _, r in found], RANGES)], names=["piece_id", "ranges"])

        for batch in batches:
            for seed, name, piece in zip(*(c.to_pylist() for c in batch.columns)):
                if seed != last and total >= SHARD_BYTES:
                    yield emit()
                    names, texts, total = [], [], 0
                if not names or names[-1] != name:
                    names.append(name)
                    texts.append(piece)
                    total += len(piece) + 1
                last = seed
        if texts:
            yield emit()

    dealt = pieces.select("seed", "piece_id", "piece").repartition("seed").sortWithinPartitions("seed", "piece_id")
    return dealt.mapInArrow(run, "piece_id binary, ranges array<struct<a:bigint,b:bigint>>")


def _dealt(pieces: DataFrame, size: int) -> DataFrame:
    """The same by counting windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, piece in zip(*(c.to_pylist() for c in batch.columns)):
                n = len(piece) - size + 1
                windows = [hashlib.md5(piece[k : k + size], usedforsecurity=False).digest() for k in range(n)]
                yield pa.RecordBatch.from_arrays([pa.array([name] * n, pa.binary()), pa.array(range(n), pa.int64()), pa.array(windows, pa.binary())], names=["piece_id", "at", "window"])

    windows = pieces.select("piece_id", "piece").mapInArrow(run, "piece_id binary, at bigint, window binary")
    windows = written(windows.dropDuplicates(["piece_id", "at"]), "windows")
    often = windows.groupBy("window").agg(F.count("*").alias("n")).where("n > 1").select("window")
    return windows.join(often, "window", "left_semi").groupBy("piece_id").agg(
        F.collect_list(F.struct(F.col("at").alias("a"), F.col("at").alias("b"))).alias("ranges"))


def remove_repeats(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text", size: int = 400, whole: bool = False) -> DataFrame:
    """``keep``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and,
    with ``whole``, ``spans`` (start, stop in bytes) and ``kept`` (bytes left).

    Every byte under a string of ``size`` bytes that also begins elsewhere, in
    the same or another text, is removed; NULL texts are empty; repeated rows
    repeat each other; an empty table gives no rows.
    """
    spark = docs.sparkSession
    text_batches(spark)
    names = [f"key{i}_" for i in range(len(keep))]
    marked = docs.select(*[F.col(k).alias(n) for k, n in zip(keep, names)], F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text_")).withColumn(
        "id_", F.monotonically_increasing_id())
    runs = written(_runs(marked, size), "runs")
    seeds = runs.groupBy("seed").agg(F.count("*").alias("n")).where("n > 1")
    chosen = runs.join(seeds, "seed", "left").where("n IS NOT NULL OR twice")
    listed = chosen.groupBy("id_").agg(F.collect_list(F.struct("seed", "lo", "hi")).alias("runs"))
    pieces = written(_pieces(marked.select("id_", "text_").join(listed, "id_"), size), "pieces")
    texts = pieces.where("piece IS NOT NULL")
    hot = written(texts.groupBy("seed").agg(F.count("*").alias("n")).where(F.col("n") > SEED_PIECES).select("seed"), "hot")
    found = _sharded(texts.join(hot, "seed", "left_anti"), size)
    if not hot.isEmpty():
        found = found.unionByName(_dealt(texts.join(hot, "seed", "left_semi"), size))
    found = written(found, "found")
    places = pieces.select("id_", "lo", "hi", "piece_id")
    copies = places.groupBy("piece_id").agg(F.count("*").alias("copies"))
    judged = copies.join(found, "piece_id", "left").where("copies > 1 OR ranges IS NOT NULL")
    every = F.array(F.struct(F.lit(0).cast("long").alias("a"), (F.col("hi") - F.col("lo")).alias("b")))
    gone = places.join(judged, "piece_id").select("id_", "lo", F.when(F.col("copies") > 1, every).otherwise(F.col("ranges")).alias("ranges"))
    gone = gone.select("id_", F.transform("ranges", lambda r: F.struct((r["a"] + F.col("lo")).alias("a"), (r["b"] + F.col("lo") + size).alias("b"))).alias("ranges"))
    gone = written(gone.groupBy("id_").agg(F.array_sort(F.flatten(F.collect_list("ranges"))).alias("ranges")), "gone")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_columns
            out = []
            for text, ranges in zip(batch.column(n - 2).to_pylist(), batch.column(n - 1).to_pylist()):
                raw, spans = text.encode(), []
                for r in ranges or ():
                    if spans and r["a"] <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], r["b"])
                    else:
                        spans.append([r["a"], r["b"]])
                edges = [0, *(x for s in spans for x in s), len(raw)]
                kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))
                out.append((len(raw), len(raw) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), [{"a": a, "b": b} for a, b in spans], kept))
            columns = list(zip(*out)) if out else [[]] * 6
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()] + [RANGES, pa.binary()] * whole
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(n - 2)), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                                             names=[*names, "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"][: n - 2 + len(kinds)])

    schema = ", ".join([*(f"{x} {docs.schema[k].dataType.simpleString()}" for k, x in zip(keep, names)), "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"])
    rows = marked.join(gone, "id_", "left").select(*names, "text_", "ranges")
    out = rows.mapInArrow(cut, schema + ", spans array<struct<a:bigint,b:bigint>>, kept binary" * whole)
    return out.withColumnsRenamed(dict(zip(names, keep)))
