"""Periodic runs of words by an online sparse diagonal pass.

A run is a stretch of consecutive words with smallest period q, at least
``max(least, times * q)`` words long, that no neighbouring word extends keeping
the period.  On the diagonal of lag q it is a stretch of words that equal the
word q places before.  The pass goes through a text once from left to right: the
earlier occurrences of the word at hand lengthen the matches of their lags, and
a lag that isn't lengthened has ended; if its match is long enough, its run is
emitted at once.

Which earlier occurrences count.  All of them would be a square of the number of
copies of a common word.  With ``times`` of 4, a run of period q holds a match of
3q words on its diagonal.  For the lags of one octave, 2^k <= q < 2^(k+1), each
word of the match therefore begins or lies in a stretch of ``3 * 2^k`` words that
stands q words earlier, too, and only the *nearest* earlier place of that stretch
can matter: if it stood at a smaller distance p, the stretch and the q words
before it would have periods p and q, and being at least p + q words long also
their greatest common divisor, so q would not be the run's smallest period.  For the
same reason a match that ends on a nearest lag is maximal and its lag is its
smallest period.  So a word has one occurrence per octave at most, and the
work for n words is in the order of n log n however often a word stands.

Names of stretches come from doubling: a stretch of 2^(j+1) words is a pair of
names of 2^j words, numbered anew without collisions.  Stretches that stand once
in a text are left out, after two or three rounds nearly all of prose.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenground.llm.common import text_batches

#: texts of about this many bytes are looked at together
CHUNK_BYTES = 2_000_000
RUN = "struct<start:bigint,length:bigint,period:bigint>"


def word_numbers(texts: list[list[bytes]]) -> np.ndarray:
    """A number for each word, the same for equal words of one text; texts
    share none, so that no stretch of words reaches over two of them."""
    numbers, first = [], 0
    for words in texts:
        known = dict(zip(dict.fromkeys(words), count(first)))
        numbers += map(known.__getitem__, words)
        first += len(known)
    return np.array(numbers, np.int64)


def _repeated(places: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The places whose code stands more than once, in ascending order, the
    numbers of these codes from 0 on, and how many there are."""
    order = np.argsort(codes, kind="stable")
    ordered = codes[order]
    new = np.concatenate((np.ones(min(len(codes), 1), bool), ordered[1:] != ordered[:-1]))
    group = np.cumsum(new) - 1
    often = np.bincount(group, minlength=1)[group] > 1 if len(codes) else np.zeros(0, bool)
    renamed = np.full(len(codes), -1, np.int64)
    renamed[order[often]] = (np.cumsum(new & often) - 1)[often]
    kept = renamed >= 0
    return places[kept], renamed[kept], int((new & often).sum())


def _pairs(places: np.ndarray, names: np.ndarray, full: np.ndarray, apart: int, n_names: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the stretches made of one at a place and one ``apart`` words
    later, where both stand more than once; ``full`` holds the second's names."""
    later = places + apart
    inside = later < len(full)
    places, names, second = places[inside], names[inside], full[later[inside]]
    both = second >= 0
    return places[both], names[both] * np.int64(n_names) + second[both]


def occurrences(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``place``, ``lag``, ``width``: stretches of ``width`` words that begin at a
    place and stand ``lag`` words earlier, too, the nearest of each octave of
    lags, by place."""
    found = []
    every = np.arange(len(numbers))
    places, names, n = _repeated(every, numbers)
    full = np.full(len(numbers), -1, np.int64)
    full[places] = names
    size = 1
    while len(places):
        two_places, codes = _pairs(places, names, full, size, max(n, 1))
        two_places, two_names, two = _repeated(two_places, codes)
        # the octave of lags size ... 2 * size - 1: stretches of 3 * size words
        at, codes = _pairs(two_places, two_names, full, 2 * size, max(n, 1))
        order = np.argsort(codes, kind="stable")
        ordered, starts = codes[order], at[order]
        lag = starts[1:] - starts[:-1]
        near = (ordered[1:] == ordered[:-1]) & (lag >= size) & (lag < 2 * size)
        found.append((starts[1:][near], lag[near], np.full(int(near.sum()), 3 * size)))
        full[places] = -1
        full[two_places] = two_names
        places, names, n, size = two_places, two_names, two, 2 * size
    if not found:
        return every, every, every
    place, lag, width = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((lag, place))
    return place[order], lag[order], width[order]


def diagonal_runs(place: np.ndarray, lag: np.ndarray, width: np.ndarray, least: int, times: int) -> list[tuple[int, int, int]]:
    """``start, length, period`` of the runs, in the order in which they end.

    ``active`` has the match length of each lag lengthened at the word before;
    the first stretch of a match counts whole, each further one adds a word.
    """
    out: list[tuple[int, int, int]] = []
    active: dict[int, int] = {}
    hit: dict[int, int] = {}
    at = -1

    def ended(lags, word: int) -> None:
        # the match of a lag ends with the stretch that began at the word before
        for q in lags:
            match = active[q]
            if match + q >= max(least, times * q):
                first = word - 1 + 3 * (1 << q.bit_length() - 1) - match
                out.append((first - q, match + q, q))

    for i, q, w in zip(place.tolist(), lag.tolist(), width.tolist()):
        if i != at:
            if at >= 0:
                ended(active.keys() - hit.keys(), at)
                active, hit = hit, {}
                if i != at + 1:
                    ended(active.keys(), at + 1)
                    active = {}
            at = i
        hit[q] = active[q] + 1 if q in active else w
    if at >= 0:
        ended(active.keys() - hit.keys(), at)
        active = hit
        ended(active.keys(), at + 1)
    return out


def runs_of(texts: list[list[bytes]], least: int = 6, times: int = 4) -> list[list[tuple[int, int, int]]]:
    """Runs of each text, by start, then period."""
    numbers = word_numbers(texts)
    bounds = np.cumsum([0, *map(len, texts)])
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    runs = sorted(diagonal_runs(*occurrences(numbers), least, times), key=lambda r: (r[0], r[2]))
    owners = np.searchsorted(bounds, [r[0] for r in runs], side="right") - 1
    for (start, length, period), k in zip(runs, owners.tolist()):
        out[k].append((start - int(bounds[k]), length, period))
    return out


def kept_words(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = 6, times: int = 4) -> DataFrame:
    """``key``, ``n_words``, ``runs`` (start, length, period; by start, then
    period) and ``collapsed`` (the words kept, joined by one space) of each row.

    Words are ``[^\\x20\\x09-\\x0D]+``.  A NULL or empty text has no words, no runs
    and an empty collapsed text; repeated rows and keys and NULL keys give one
    row each; an empty table gives no rows; other columns of ``docs`` are not
    read and may have any names.  ``times`` below 4 is refused: an octave's
    stretches would no longer be part of each run.
    """
    if times < 4 or least < 2:
        raise ValueError("runs need four periods and two words at least")
    text_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.cumsum([len(t) for t in batch.column(1).cast(pa.binary()).to_pylist()])
            cuts = [0, *(np.flatnonzero(np.diff(sizes // CHUNK_BYTES)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if b > a:
                    yield part(batch.slice(a, b - a))

    def part(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t.split() for t in batch.column(1).cast(pa.binary()).to_pylist()]
        runs = runs_of(texts, least, times)
        rows = [[{"start": s, "length": n, "period": q} for s, n, q in r] for r in runs]
        kept = pa.array([b" ".join(kept_words(w, r)) for w, r in zip(texts, runs)], pa.binary()).cast(pa.string())
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len(w) for w in texts], pa.int64()), pa.array(rows, kind), kept], names=["key_", "n_words", "runs", "collapsed"])

    rows = docs.select(F.col(key).alias("key_"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text_"))
    out = rows.mapInArrow(run, f"key_ {docs.schema[key].dataType.simpleString()}, n_words bigint, runs array<{RUN}>, collapsed string")
    return out.withColumnRenamed("key_", key)
