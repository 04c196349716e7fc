"""Ranked lexical search, term at a time, with a limit on new accumulators.

Documents are read twice for a block of queries.  The first pass writes, for each
document, its length and the counts of the query terms in it, and adds up the
corpus statistics.  In the second pass each task takes slices of these rows.  In
a slice every query goes through its terms, rarest first: the postings of a term
create accumulators, or add to those that exist.  Once the greatest scores that
the remaining terms give in the slice add up to less than the k-th partial score,
a document without an accumulator can no longer be among the k best, so no more
are created; the survivors are updated to their exact scores.  The k best of
each slice meet per query, where Spark keeps k per task before it shuffles.

A partial score of a slice is never above that of all documents, so its limit
is safe; a limit equal to the k-th partial score goes on, for ties go to the
smaller key.  A term that a third of all documents hold is dealt out with the
documents, never gathered.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evenground.llm.common import text_batches
from evenground.session import written

#: bytes that stand between terms: U+0000-2F, 3A-40, 5B-60, 7B-7F
_BETWEEN = [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
_TABLE = bytes(0x20 if b in _BETWEEN else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
#: documents whose accumulators, and postings that a task holds at once
SLICE = 65_536
SLICE_POSTINGS = 2_000_000
#: (query, term) pairs that go to the tasks with a job
BLOCK_TERMS = 200_000


def terms_of(text: bytes) -> list[bytes]:
    """Maximal stretches of ASCII letters, digits and other characters above
    U+007F, only A-Z in lower case."""
    return text.translate(_TABLE).split()


def query_terms(queries: DataFrame, text: str) -> DataFrame:
    """``row_`` of a query and each of its terms once."""
    text_batches(queries.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [(r, t) for r, x in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()) for t in dict.fromkeys(terms_of(x))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r for r, _ in pairs], pa.int64()), pa.array([t for _, t in pairs], pa.binary())], names=["row_", "term"])

    rows = queries.select("row_", F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text_"))
    return rows.mapInArrow(run, "row_ bigint, term binary")


def postings(docs: DataFrame, key: str, text: str, terms: list[bytes]) -> DataFrame:
    """``key_``, ``n`` (terms with repeats), and the numbers of the ``terms`` in
    a document with their counts, both as unsigned 32-bit numbers."""
    numbers = {t: i for i, t in enumerate(terms)}
    text_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = numbers.keys()
        for batch in batches:
            lengths, which, counts = [], [], []
            for value in batch.column(1).cast(pa.binary()).to_pylist():
                found = terms_of(value)
                often = Counter(found)
                held = often.keys() & wanted
                lengths.append(len(found))
                which.append(np.array([numbers[t] for t in held], "<u4").tobytes())
                counts.append(np.array([often[t] for t in held], "<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lengths, pa.int64()), pa.array(which, pa.binary()), pa.array(counts, pa.binary())], names=["key_", "n", "terms", "counts"])

    rows = docs.select(F.col(key).alias("key_"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text_"))
    kind = docs.schema[key].dataType.simpleString()
    # documents without a term have no place in the statistics
    return written(rows.mapInArrow(run, f"key_ {kind}, n bigint, terms binary, counts binary").where("n > 0"), "postings")


def holders(table: DataFrame) -> DataFrame:
    """``term`` (number) and ``df`` of the terms that documents hold, added up in
    each task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            found = np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), "<u4"), minlength=len(total))
            found[: len(total)] += total
            total = found
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["term", "df"])

    return table.select("terms").mapInArrow(run, "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df"))


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Slice:
    """Postings of some documents by term, with the scores that they give."""

    def __init__(self, lengths: np.ndarray, terms: np.ndarray, docs: np.ndarray, counts: np.ndarray, weights: np.ndarray, n_docs: int, n_terms: int) -> None:
        self.n = len(lengths)
        # 100 - 50 + 50 * length / mean length, in whole numbers
        norm = 50 + (50 * lengths * n_docs) // max(n_terms, 1)
        order = np.argsort(terms, kind="stable")
        terms, self.docs, counts = terms[order], docs[order], counts[order].astype(np.int64)
        self.scores = weights[terms] * ((1_000_000_000 * counts) // (1000 * counts + 20 * norm[self.docs]))
        self.cuts = np.searchsorted(terms, np.arange(len(weights) + 1))

    def of(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.cuts[term], self.cuts[term + 1]
        return self.docs[a:b], self.scores[a:b]

    def best(self, terms: list[int], k: int, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of the k best above 0; ``terms`` rarest first,
        ``order`` the rank of the documents among ties."""
        lists = [self.of(t) for t in terms]
        bounds = [int(s.max()) if len(s) else 0 for _, s in lists]
        after = np.cumsum([0, *bounds[::-1]])[::-1].tolist()  # after[i]: of the terms from i on
        total = np.zeros(self.n, np.int64)
        has = np.zeros(self.n, bool)
        made, n_made, creating = [], 0, True
        for i, (docs, scores) in enumerate(lists):
            if creating and n_made >= k:
                partial = total[np.concatenate(made)]
                creating = after[i] >= np.partition(partial, n_made - k)[n_made - k]
            if creating:
                new = docs[~has[docs]]
                has[new] = True
                made.append(new)
                n_made += len(new)
                total[docs] += scores
            else:
                old = has[docs]
                total[docs[old]] += scores[old]
        found = np.concatenate(made) if made else np.zeros(0, np.int64)
        found = found[total[found] > 0]
        if len(found) > k:
            limit = np.partition(total[found], len(found) - k)[len(found) - k]
            found = found[total[found] >= limit]
        found = found[np.lexsort((order[found], -total[found]))][:k]
        return found, total[found]


def _key_order(keys: pa.Array) -> np.ndarray:
    """Rank of each key in ascending order, NULL last."""
    rank = np.empty(len(keys), np.int64)
    rank[pa.compute.sort_indices(keys, null_placement="at_end").to_numpy()] = np.arange(len(keys))
    return rank


def ranked_block(table: DataFrame, asked: list[tuple[int, list[int]]], df: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """``row_``, ``key_``, ``score`` of the k best documents of each slice."""
    weights = np.array([weight(n_docs, int(d)) for d in df], np.int64)
    # rarest first, and terms that no document holds not at all
    queries = [(row, sorted((t for t in terms if df[t]), key=lambda t: (df[t], t))) for row, terms in asked]
    kind = table.schema["key_"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, size = [], 0, 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            size += pa.compute.sum(pa.compute.binary_length(batch.column(2))).as_py() or 0
            if n >= SLICE or size >= 4 * SLICE_POSTINGS:
                yield answers(pa.Table.from_batches(held))
                held, n, size = [], 0, 0
        if held:
            yield answers(pa.Table.from_batches(held))

    def answers(rows: pa.Table) -> pa.RecordBatch:
        keys = rows.column(0).combine_chunks()
        which, counts = (rows.column(c).to_pylist() for c in (2, 3))
        docs = np.repeat(np.arange(len(which)), [len(w) // 4 for w in which])
        part = Slice(rows.column(1).to_numpy(), np.frombuffer(b"".join(which), "<u4").astype(np.int64), docs,
                     np.frombuffer(b"".join(counts), "<u4"), weights, n_docs, n_terms)
        order = _key_order(keys)
        found = [(row, *part.best(terms, k, order)) for row, terms in queries]
        at = np.concatenate([d for _, d, _ in found]) if found else np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.repeat([r for r, _, _ in found], [len(d) for _, d, _ in found]).astype(np.int64)), keys.take(pa.array(at.astype(np.int64))),
             pa.array(np.concatenate([s for _, _, s in found]) if found else [], pa.int64())], names=["row_", "key_", "score"])

    return table.mapInArrow(run, f"row_ bigint, key_ {kind.simpleString()}, score bigint")


def search(docs: DataFrame, queries: DataFrame, key: str = "doc_id", text: str = "text", query_text: str = "text", k: int = 50,
           block_terms: int = BLOCK_TERMS) -> DataFrame:
    """All columns of ``queries`` as struct ``query``, ``rank`` (from 1), ``key``
    and ``score`` of the k best documents with a score above 0 of each query row.

    Equal scores go by ascending key, NULL last, and rows with equal keys are
    documents of their own.  A NULL or empty text is a document without terms,
    which counts nowhere, or a query without answers; repeated queries have
    answers of their own; an empty table on either side gives no rows; further
    columns of ``docs`` are not read, those of ``queries`` may have any names.

    Queries are taken in blocks of about ``block_terms`` terms, by a hash of
    the query row; that bounds what a job carries to its tasks.  The corpus is
    read once for each block.
    """
    spark = docs.sparkSession
    numbered = written(queries.select(F.struct("*").alias("query")).withColumn("row_", F.monotonically_increasing_id()), "queries")
    asked = written(query_terms(numbered.select("row_", F.col("query")[query_text].alias("text_")), "text_"), "query-terms")
    blocks = max(1, -(-asked.count() // block_terms))
    kind = docs.schema[key].dataType.simpleString()
    out = spark.createDataFrame([], f"row_ bigint, key_ {kind}, score bigint")
    for block in range(blocks):
        # bounded by block_terms, and by the terms of one query
        pairs = asked.where(F.pmod(F.xxhash64("row_"), F.lit(blocks)) == block).toPandas()
        terms = sorted(set(map(bytes, pairs["term"])))
        if not terms:
            continue
        numbers = {t: i for i, t in enumerate(terms)}
        by_query: dict[int, list[int]] = {}
        for row, term in zip(pairs["row_"].tolist(), pairs["term"]):
            by_query.setdefault(row, []).append(numbers[bytes(term)])
        table = postings(docs, key, text, terms)
        n_docs, n_terms = table.agg(F.count("*"), F.sum("n")).first()
        held = holders(table).toPandas()  # bounded by the terms of the block
        df = np.zeros(len(terms), np.int64)
        df[held["term"].to_numpy(np.int64)] = held["df"].to_numpy(np.int64)
        out = out.unionByName(ranked_block(table, sorted(by_query.items()), df, n_docs, n_terms or 0, k))
    order = Window.partitionBy("row_").orderBy(F.desc("score"), F.col("key_").asc_nulls_last())
    best = out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.join(numbered, "row_").select("query", "rank", F.col("key_").alias(key), "score")
