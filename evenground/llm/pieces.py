"""Sampled segmentation into the pieces of a SentencePiece model, and back.

The pieces of a text form a lattice.  Forward filtering sums the weights of
all paths to each place; backward sampling then draws the last piece, the one
before it, and so on, with the right probability of each whole path.  Draws
are numbers made from the row's key, the segment and the step, so the result
is the same in any partition and on any retry.

No piece reaches over the start of a run of spaces or a line feed, so the
lattice falls apart there.  Filtering is done once for each distinct segment
of a few megabytes of text, many segments at a time; sampling goes piece by
piece for all their occurrences at a time.  Characters without a piece, and the
piece sign for spaces itself, are written as byte pieces, so decoding gives
the text back in any case.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenground.llm.common import kept_in_worker, text_batches

SIGN = "▁"
FACTOR = np.uint64(0x9E3779B97F4A7C15)
CHUNK = 4_000_000
#: characters of different segments whose lattices are held together
LATTICE = 200_000


def mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64 of unsigned 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Lattice:
    """Pieces of a model with their weights, ready for look-up by hash.

    Scores of a BPE model are merge ranks; their weight is ``-theta * ln(1 +
    rank)``.  Scores of a unigram model are used as they are, times theta.
    """

    def __init__(self, model: str, theta: float) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        size = sp.vocab_size()
        plain = [i for i in range(size) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.is_byte(i))]
        self.text = {i: sp.id_to_piece(i).replace(SIGN, " ") for i in plain}
        self.bytes_of = [b""] * size
        for i, t in self.text.items():
            self.bytes_of[i] = t.encode()
        self.byte_ids = np.zeros(256, np.int32)
        for i in range(size):
            if sp.is_byte(i):
                value = int(sp.id_to_piece(i)[3:5], 16)
                self.byte_ids[value] = i
                self.bytes_of[i] = bytes([value])
        score = np.array([sp.get_score(i) for i in plain])
        ranked = score.min() < -1000
        weight = -theta * np.log1p(np.maximum(-score, 0)) if ranked else theta * score
        # one place beyond the pieces stands for a character in bytes, the last for no arc
        self.fallback, self.none = size, size + 1
        self.weight = np.full(size + 2, -np.inf)
        self.weight[plain] = weight
        self.weight[self.fallback] = 4 * weight.min()
        self.longest = max(map(len, self.text.values()))
        self.whole = any("\n" in t or " " in t.lstrip(" ") for t in self.text.values())
        self.tables = []
        for n in range(1, self.longest + 1):
            ids = np.array([i for i in plain if len(self.text[i]) == n], np.int32)
            if not len(ids):
                self.tables.append(None)
                continue
            points = np.frombuffer("".join(self.text[i] for i in ids).encode("utf-32-le"), np.uint32).reshape(-1, n)
            keys = np.zeros(len(ids), np.uint64)
            for k in range(n):
                keys = keys * FACTOR + mix(points[:, k].astype(np.uint64) + FACTOR)
            order = np.argsort(keys)
            self.tables.append((keys[order], ids[order]))

    def segments(self, text: str) -> list[str]:
        return [text] if self.whole else re.findall(r" *[^ \n]+| +|\n", text)

    def filtered(self, points: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Arcs by their last character and length, and the running shares of
        the arcs that end there, of segments one behind the other."""
        width, total = self.longest, len(points)
        ids = np.full((total, width), self.none, np.int32)
        ids[:, 0] = self.fallback
        left = np.repeat(starts + sizes, sizes) - np.arange(total)  # characters up to the end of the segment
        symbol, keys, at = mix(points.astype(np.uint64) + FACTOR), np.zeros(total, np.uint64), np.arange(total)
        for n in range(1, width + 1):
            if n > 1:
                keep = left[at] >= n
                at, keys = at[keep], keys[keep]
            if not len(at):
                break
            keys = keys * FACTOR + symbol[at + n - 1]
            if self.tables[n - 1] is not None:
                known, of = self.tables[n - 1]
                place = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                hit = known[place] == keys
                ids[at[hit] + n - 1, n - 1] = of[place[hit]]
        alpha, shares = np.zeros(total), np.ones((total, width), np.float32)
        order = np.argsort(-sizes, kind="stable")
        by_size = sizes[order]
        for t in range(1, int(by_size[0]) + 1 if total else 1):
            here = starts[order[: np.searchsorted(-by_size, -t, side="right")]] + t - 1
            n = min(t, width)
            arcs = self.weight[ids[here, :n]]
            for k in range(1, n + 1):
                if k < t:
                    arcs[:, k - 1] += alpha[here - k]
            top = arcs.max(axis=1, keepdims=True)
            np.exp(arcs - top, out=arcs)
            np.cumsum(arcs, axis=1, out=arcs)
            alpha[here] = np.log(arcs[:, -1]) + top[:, 0]
            shares[here, :n] = arcs / arcs[:, -1:]
        return ids, shares

    def sample(self, texts: list[str], seeds: np.ndarray) -> list[np.ndarray]:
        """Piece ids of each text, drawn with its seed."""
        number: dict[str, int] = {}
        counts, found = [], []
        for text in texts:
            parts = self.segments(" " + text) if text else []
            counts.append(len(parts))
            found += [number.setdefault(p, len(number)) for p in parts]
        if not found:
            return [np.zeros(0, np.int32) for _ in texts]
        sizes = np.fromiter(map(len, number), np.int64, len(number))
        points = np.frombuffer("".join(number).encode("utf-32-le"), np.uint32)
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        which, counts = np.array(found), np.array(counts)
        del found, number
        own = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
        key = mix(np.repeat(seeds, counts) + own.astype(np.uint64) * FACTOR)
        steps, drawn = np.zeros(len(which), np.int64), []
        # a lattice takes over a hundred bytes a character, so it is made for some
        # segments at a time, and all their occurrences are drawn from it
        part = starts // LATTICE
        order = np.argsort(part[which], kind="stable")
        for of in np.unique(part).tolist():
            first, beyond = np.searchsorted(part, (of, of + 1))
            begin, stop = starts[first], starts[beyond - 1] + sizes[beyond - 1]
            here = points[begin:stop]
            ids, shares = self.filtered(here, starts[first:beyond] - begin, sizes[first:beyond])
            a, b = np.searchsorted(part[which], (of, of + 1), sorter=order)
            self._draw(here, ids, shares, order[a:b], starts[which[order[a:b]]] - begin, sizes[which[order[a:b]]], key, steps, drawn)
            del ids, shares
        ends = np.cumsum(steps)
        out = np.empty(int(ends[-1]), np.int64)
        for rows, piece, k in drawn:
            out[ends[rows] - 1 - k] = piece
        edges = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(counts)))]
        return [self._bytes(out[a:b]) for a, b in zip(edges[:-1], edges[1:])]

    def _draw(self, points: np.ndarray, ids: np.ndarray, shares: np.ndarray, active: np.ndarray, starts: np.ndarray, left: np.ndarray,
              key: np.ndarray, steps: np.ndarray, drawn: list) -> None:
        """Pieces of occurrences ``active`` from their last to their first:
        rows, pieces and turn of each turn go to ``drawn``, and are counted in
        ``steps``."""
        at, turn = starts + left - 1, 0
        while len(active):
            u = (mix(key[active] + np.uint64((turn + 1) * int(FACTOR) % 2**64)) >> np.uint64(40)).astype(np.float32) / np.float32(1 << 24)
            size = (shares[at] <= u[:, None]).sum(axis=1) + 1
            size = np.minimum(size, left)
            piece = ids[at, size - 1]
            piece = np.where(piece == self.fallback, -1 - points[at].astype(np.int32), piece)
            drawn.append((active.astype(np.int32), piece, turn))
            steps[active] += 1
            left = left - size
            more = left > 0
            active, at, left = active[more], (at - size)[more], left[more]
            turn += 1

    def _bytes(self, tokens: np.ndarray) -> np.ndarray:
        """Characters without a piece become their bytes."""
        lost = np.flatnonzero(tokens < 0)
        if not len(lost):
            return tokens.astype(np.int32)
        raw = [chr(-1 - t).encode() for t in tokens[lost].tolist()]
        times = np.ones(len(tokens), np.int64)
        times[lost] = [len(r) for r in raw]
        out = np.repeat(tokens, times)
        out[out < 0] = self.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
        return out.astype(np.int32)

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist())).decode()[1:]


def sampled_pieces(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text", seed: int = 7,
                   theta: float = 1.0, ids: bool = True) -> DataFrame:
    """``key``, ``n_pieces``, ``ids_crc32`` (of the ids as little-endian
    unsigned 32-bit numbers), ``lossless`` (decoding gave the text) and, with
    ``ids``, ``pieces`` and ``decoded``, one row for each row.

    NULL and empty texts have no pieces and decode to an empty text.  Rows
    with equal keys and texts are segmented alike; NULL is a key like others.
    An empty table gives no rows.
    """
    text_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = kept_in_worker(f"lattice {model} {theta}", lambda: Lattice(model, theta))

        def emit(keys: list, names: list, texts: list[str]) -> pa.RecordBatch:
            seeds = np.array([xxhash.xxh64_intdigest("" if n is None else n, seed) for n in names], np.uint64)
            found = lattice.sample(texts, seeds)
            decoded = [lattice.decode(f) for f in found]
            columns = [
                pa.concat_arrays(keys), pa.array([len(f) for f in found], pa.int64()),
                pa.array([zlib.crc32(f.astype("<u4").tobytes()) for f in found], pa.int64()),
                pa.array([a == b for a, b in zip(decoded, texts)], pa.bool_()),
            ]
            if ids:
                columns += [pa.array(found, pa.list_(pa.int32())), pa.array(decoded, pa.string())]
            return pa.RecordBatch.from_arrays(columns, names=["key_", "n_pieces", "ids_crc32", "lossless", "pieces", "decoded"][: len(columns)])

        keys, names, texts, size = [], [], [], 0
        for batch in batches:
            keys.append(batch.column(0))
            names += batch.column(1).to_pylist()
            texts += batch.column(2).to_pylist()
            size += batch.column(2).nbytes
            if size >= CHUNK:
                yield emit(keys, names, texts)
                keys, names, texts, size = [], [], [], 0
        if texts:
            yield emit(keys, names, texts)

    kind = docs.schema[key].dataType.simpleString()
    schema = f"key_ {kind}, n_pieces bigint, ids_crc32 bigint, lossless boolean" + ", pieces array<int>, decoded string" * ids
    rows = docs.select(F.col(key).alias("key_"), F.col(key).cast("string").alias("name_"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text_"))
    return rows.mapInArrow(run, schema).withColumnRenamed("key_", key)
