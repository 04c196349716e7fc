"""Language-model scores by a weighted backoff automaton.

States are the empty context and every word of the training texts; a word's
state has an arc for each pair that starts with it, and one failure arc to the
empty context.  With ``prior`` pseudo-counts the arc of a pair weighs
``(c(h,w) + prior * p(w)) / (c(h) + prior)`` and the failure arc
``prior / (c(h) + prior)``; arcs of the empty context weigh
``p(w) = (c(w) + 1) / (N + V + 1)``.  The arcs of each state sum to one.  A text
is walked once from left to right: follow the word's arc, or fail and follow the
empty context's; either way the next state is the word's.

The automaton grows with the corpus, so nobody holds it whole.  Documents are
dealt into units of a few megabytes that list their distinct words and pairs as
sorted 64-bit hashes.  Slices of these lists, cut at the same hashes in every
unit, meet in buckets; a bucket adds up the counts of its slice of the
automaton and answers each unit with the counts it asked for.  A word or pair
is one entry for each unit, however common it is, and buckets are even because
hashes are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenground.llm.common import text_batches
from evenground.llm.pieces import mix
from evenground.session import fresh_path

UNIT_BYTES = 12_000_000
#: texts of a unit whose bytes are hashed at once
SLICE_BYTES = 1_000_000
BUCKET_TOKENS = 2_000_000
BASE = 0x9E3779B97F4A7C15
BACK = pow(BASE, -1, 1 << 64)
END = np.uint64(0x656E64)

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SYMBOL = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens of the texts, an end after each, and their numbers
    of tokens."""
    raw = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    space = _SPACE[raw]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).view(np.int8)))
    starts, stops = edge[::2], edge[1::2]
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_SYMBOL[_LOWER[raw]] * _powers(BASE, len(raw)), dtype=np.uint64)))
    words = mix((sums[stops] - sums[starts]) * _powers(BACK, len(raw) + 1)[starts] + (stops - starts).astype(np.uint64))
    ends = np.cumsum([len(t) + 1 for t in texts])
    upto = np.searchsorted(starts, ends)
    return np.insert(words, upto, END), np.diff(np.concatenate(([0], upto))) + 1


def sliced_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The same, some texts at a time: the arrays of eight bytes for each byte of
    text are then as long as a slice, not as a unit."""
    sizes = np.cumsum([len(t) + 1 for t in texts])
    cuts = [0, *(np.flatnonzero(np.diff(sizes // SLICE_BYTES)) + 1).tolist(), len(texts)]
    parts = [word_hashes(texts[a:b]) for a, b in zip(cuts[:-1], cuts[1:]) if b > a]
    return np.concatenate([w for w, _ in parts]), np.concatenate([n for _, n in parts])


def pair_hashes(tokens: np.ndarray) -> np.ndarray:
    """Hash of each token with the one before; the first of all follows an end."""
    before = np.concatenate((np.array([END]), tokens[:-1]))
    return mix(mix(before + np.uint64(BASE)) ^ tokens)


def _saved(df: DataFrame, name: str) -> DataFrame:
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def units(docs: DataFrame, key: str, text: str, held_out) -> DataFrame:
    """One row per unit: keys, flags and token numbers of its documents, its
    distinct words (sorted u64) and the word numbers of its tokens (u32)."""
    text_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        keys, held, texts, size = [], [], [], 0

        def emit() -> pa.RecordBatch:
            tokens, lengths = sliced_hashes(texts)
            words, place = np.unique(tokens, return_inverse=True)
            return pa.RecordBatch.from_arrays([
                pa.array([part << 32 | number], pa.int64()), pa.array([pa.concat_arrays(keys).to_pylist()], pa.list_(keys[0].type)),
                pa.array([held], pa.list_(pa.bool_())), pa.array([lengths], pa.list_(pa.int64())), pa.array([int(lengths.sum())], pa.int64()),
                pa.array([words.astype("<u8").tobytes()], pa.binary()), pa.array([place.astype("<u4").tobytes()], pa.binary())],
                names=["unit", "keys", "held", "lengths", "n_tokens", "words", "places"])

        for batch in batches:
            keys.append(batch.column(0))
            held += batch.column(1).to_pylist()
            new = batch.column(2).cast(pa.binary()).to_pylist()
            texts += new
            size += sum(map(len, new))
            if size >= UNIT_BYTES:
                yield emit()
                keys, held, texts, size, number = [], [], [], 0, number + 1
        if texts:
            yield emit()

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key_"), held_out.alias("held"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text_"))
    return _saved(rows.mapInArrow(
        run, f"unit bigint, keys array<{kind}>, held array<boolean>, lengths array<bigint>, n_tokens bigint, words binary, places binary"), "units")


def _asked(words: bytes, places: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """words, places, tokens, pairs and their places of a unit."""
    words, places = np.frombuffer(words, "<u8"), np.frombuffer(places, "<u4")
    pairs, at = np.unique(pair_hashes(words[places]), return_inverse=True)
    return words, places, pairs, at.astype(np.uint32)


def _cuts(hashes: np.ndarray, buckets: int) -> np.ndarray:
    limits = np.arange(1, buckets, dtype=np.uint64) * np.uint64(((1 << 64) - 1) // buckets)
    return np.concatenate(([0], np.searchsorted(hashes, limits), [len(hashes)]))


def requests(table: DataFrame, buckets: int) -> DataFrame:
    """A unit's hashes of one bucket and their counts in its training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for unit, held, lengths, w, p in zip(*(c.to_pylist() for c in batch.columns)):
                words, places, pairs, at = _asked(w, p)
                trained = np.repeat(~np.array(held, bool), lengths)
                for order, hashes, where in ((1, words, places), (2, pairs, at)):
                    counts = np.bincount(where[trained], minlength=len(hashes)).astype("<u4")
                    cuts = _cuts(hashes, buckets).tolist()
                    spans = [(b, x, y) for b, (x, y) in enumerate(zip(cuts[:-1], cuts[1:])) if y > x]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([order] * len(spans), pa.int32()), pa.array([b for b, _, _ in spans], pa.int32()), pa.array([unit] * len(spans), pa.int64()),
                        pa.array([hashes[x:y].astype("<u8").tobytes() for _, x, y in spans], pa.binary()),
                        pa.array([counts[x:y].tobytes() for _, x, y in spans], pa.binary())], names=["order", "bucket", "unit", "hashes", "counts"])

    return table.select("unit", "held", "lengths", "words", "places").mapInArrow(
        run, "order int, bucket int, unit bigint, hashes binary, counts binary")


def _merged(frame: pd.DataFrame) -> pd.DataFrame:
    """Counts over all units, for each unit in the order it asked; types and
    tokens of the bucket stand at its first row."""
    hashes = [np.frombuffer(h, "<u8") for h in frame["hashes"]]
    counts = np.concatenate([np.frombuffer(c, "<u4") for c in frame["counts"]])
    known, place = np.unique(np.concatenate(hashes), return_inverse=True)
    total = np.bincount(place, weights=counts, minlength=len(known)).astype("<u8")
    ends = np.cumsum([len(h) for h in hashes])
    first = np.zeros(len(frame), np.int64)
    first[0] = 1
    return pd.DataFrame({
        "order": frame["order"], "bucket": frame["bucket"], "unit": frame["unit"],
        "counts": [total[place[e - len(h) : e]].tobytes() for h, e in zip(hashes, ends)],
        "types": first * int((total > 0).sum()), "tokens": first * int(total.sum())})


def walk(c_word: np.ndarray, c_state: np.ndarray, c_pair: np.ndarray, tokens: int, types: int, prior: float) -> np.ndarray:
    """log10 weight of each step: the pair's arc, or failure and the word's."""
    root = (c_word + 1) / (tokens + types + 1)
    failure = np.where(c_state > 0, prior / (c_state + prior), 1.0)
    arc = (c_pair + prior * root) / (c_state + prior)
    return np.log10(np.where((c_state > 0) & (c_pair > 0), arc, failure * root))


def scored(table: DataFrame, answers: DataFrame, key: str, prior: float) -> DataFrame:
    sums = answers.where("order = 1").agg(F.sum("tokens"), F.sum("types")).first()
    n, v = int(sums[0] or 0), int(sums[1] or 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                keys, held, lengths = batch.column(0)[k].values, batch.column(1)[k].values, np.array(batch.column(2)[k].as_py())
                words, places, pairs, at = _asked(batch.column(3)[k].as_py(), batch.column(4)[k].as_py())
                found = sorted(batch.column(5)[k].as_py(), key=lambda x: (x["order"], x["bucket"]))
                counts = {o: np.frombuffer(b"".join(x["counts"] for x in found if x["order"] == o), "<u8").astype(np.float64) for o in (1, 2)}
                c_word = counts[1][places]
                c_state = np.concatenate((counts[1][np.searchsorted(words, [END])], c_word[:-1]))
                base = np.log10((c_word + 1) / (n + v + 1))
                score = walk(c_word, c_state, counts[2][at], n, v, prior)
                starts = np.cumsum(lengths) - lengths
                total = lambda x: np.add.reduceat(x, starts)
                yield pa.RecordBatch.from_arrays([
                    keys, held, pa.array(lengths), pa.array(total((c_word > 0).astype(np.int64))), pa.array(np.full(len(lengths), n, np.int64)),
                    pa.array(total(base)), pa.array(total(score))],
                    names=["key_", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    per_unit = answers.groupBy("unit").agg(F.collect_list(F.struct("order", "bucket", "counts")).alias("found"))
    rows = table.join(per_unit, "unit").select("keys", "held", "lengths", "words", "places", "found")
    text_batches(table.sparkSession, 1)
    kind = table.schema["keys"].dataType.elementType.simpleString()
    return rows.mapInArrow(
        run, f"key_ {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    ).withColumnRenamed("key_", key)


def score_texts(docs: DataFrame, key: str = "doc_id", text: str = "text", held_out=None, prior: float = 100.0) -> DataFrame:
    """``key``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` and ``score`` of each row.

    ``held_out`` is a column; the model learns from all other rows.  A NULL or
    empty text is one end token; repeated rows are trained on as often as they
    stand; a NULL key or flag counts as training; an empty table gives no rows.
    """
    spark: SparkSession = docs.sparkSession
    flag = F.coalesce(held_out if held_out is not None else F.lit(False), F.lit(False))
    table = units(docs, key, text, flag)
    tokens = table.agg(F.sum("n_tokens")).first()[0] or 0
    text_batches(spark, 1)
    asked = requests(table, max(1, -(-tokens // BUCKET_TOKENS)))
    answers = _saved(asked.groupBy("order", "bucket").applyInPandas(
        _merged, "order int, bucket int, unit bigint, counts binary, types bigint, tokens bigint"), "answers")
    return scored(table, answers, key, prior)
