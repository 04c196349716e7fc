"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items meet on the hashes of ``seed`` tokens in a row.
For a pair that shares a seed, the longest common runs of tokens are marked
again and again, longest first and never overlapping, until none of ``seed``
tokens is left.  The share of an item's tokens under tiles is its coverage;
the order of the tiles does not matter, so a passage with exchanged sentences
is still found.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenground.llm.common import bind, text_batches
from evenground.session import small_side, written

BASE = 1_000_003
FIELD = (1 << 61) - 1


def _runs(tokens: list[int], marked: bytearray, size: int) -> Iterator[tuple[int, int]]:
    """(start, Karp-Rabin hash) of all unmarked runs of ``size`` tokens."""
    top = pow(BASE, size - 1, FIELD)
    value = length = 0
    for i, x in enumerate(tokens):
        if marked[i]:
            value = length = 0
            continue
        if length == size:
            value = (value - tokens[i - size] * top) % FIELD
        else:
            length += 1
        value = (value * BASE + x) % FIELD
        if length == size:
            yield i - size + 1, value


def tiles(item: list[int], text: list[int], least: int) -> list[tuple[int, int, int]]:
    """(start in item, start in text, size) of greedy tiles of ``least`` tokens
    or more: always the longest run left, ties by the place in the item, then
    in the text."""
    done_item, done_text = bytearray(len(item)), bytearray(len(text))
    out: list[tuple[int, int, int]] = []
    while True:
        table = defaultdict(list)
        for at, value in _runs(item, done_item, least):
            table[value].append(at)
        found: list[tuple[int, int, int]] = []
        best = least
        for at, value in _runs(text, done_text, least):
            for start in table.get(value, ()):
                # only the left end of a run is followed to its right end
                if start and at and not done_item[start - 1] and not done_text[at - 1] and item[start - 1] == text[at - 1]:
                    continue
                size = 0
                while (start + size < len(item) and at + size < len(text) and item[start + size] == text[at + size]
                       and not done_item[start + size] and not done_text[at + size]):
                    size += 1
                if size >= best:
                    best = size
                    found.append((start, at, size))
        longest = sorted(f for f in found if f[2] == best)
        if not longest:
            return out
        for start, at, size in longest:
            if not any(done_item[start : start + size]) and not any(done_text[at : at + size]):
                done_item[start : start + size] = b"\1" * size
                done_text[at : at + size] = b"\1" * size
                out.append((start, at, size))


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.array_remove(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), "[^\\p{L}\\p{N}]+"), "")


def _seeds(words: Column, seed: int) -> Column:
    return F.when(F.size(words) < seed, F.expr("CAST(array() AS array<bigint>)")).otherwise(
        F.transform(F.sequence(F.lit(0), F.size(words) - seed), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(seed)])))


def contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_key: str = "item_id",
                  item_text: str = "text", seed: int = 5, coverage: float = 0.5) -> DataFrame:
    """Pairs ``(id_, item, covered, n_tokens, coverage)`` with a coverage of
    ``coverage`` or more; ``id_`` is a column of ``docs``.

    An item of fewer than ``seed`` tokens can't be tested and gives no pair.
    NULL texts are empty; repeated items and rows are pairs of their own.
    """
    spark = docs.sparkSession
    text_batches(spark, 64)
    items = benchmark.select(
        F.col(item_key).alias("item"), tokens(F.col(item_text)).alias("item_tokens")).withColumn(
        "item_row", F.xxhash64("item", "item_tokens")).where(F.size("item_tokens") >= seed)
    items = written(items.dropDuplicates(["item_row"]), "items")
    keys = written(items.select("item_row", F.explode(_seeds(F.col("item_tokens"), seed)).alias("seed")).distinct(), "seeds")
    words = docs.select("id_", bind(tokens(F.col(text)), lambda w: _seeds(w, seed)).alias("s"))
    shared = words.select("id_", F.explode("s").alias("seed")).join(small_side(keys.select("seed").distinct()), "seed", "left_semi")
    pairs = written(shared.join(small_side(keys), "seed").groupBy("id_", "item_row").agg(F.count("*").alias("seeds")), "pairs")
    touched = pairs.select("id_").distinct()
    texts = docs.select("id_", tokens(F.col(text)).alias("tokens")).join(small_side(touched), "id_", "left_semi")
    both = pairs.join(texts, "id_").join(items, "item_row").select("id_", "item", "item_tokens", "tokens")

    def tile(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for id_, wanted, have in zip(frame["id_"], frame["item_tokens"], frame["tokens"]):
                numbers: dict[str, int] = {}
                a = [numbers.setdefault(w, len(numbers) + 1) for w in wanted]
                # tokens that the item lacks can't be in a tile
                b = [numbers.get(w, 0) or -1 - i for i, w in enumerate(have)]
                rows.append(sum(size for _, _, size in tiles(a, b, seed)))
            yield pd.DataFrame({"id_": frame["id_"], "item": frame["item"], "covered": pd.Series(rows, dtype="int64"),
                                "n_tokens": frame["item_tokens"].map(len).astype("int64")})

    kind = benchmark.schema[item_key].dataType.simpleString()
    out = both.mapInPandas(tile, f"id_ bigint, item {kind}, covered bigint, n_tokens bigint")
    return out.withColumn("coverage", F.col("covered") / F.col("n_tokens")).where(F.col("coverage") >= coverage)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_key: str = "item_id",
                  item_text: str = "text", seed: int = 5, coverage: float = 0.5) -> DataFrame:
    """All columns of ``docs`` in a struct ``row_`` with ``n_items``,
    ``max_coverage`` and ``first_item`` (the smallest of the items covered
    best) of the contaminated documents; 0, 0.0 and NULL for the others."""
    marked = docs.select(F.struct("*").alias("row_"), F.col(text).alias("text_")).withColumn("id_", F.monotonically_increasing_id())
    pairs = contamination(marked.select("id_", "text_"), benchmark, "text_", item_key, item_text, seed, coverage)
    hits = written(pairs.groupBy("id_").agg(
        F.count("*").alias("n_items"), F.max("coverage").alias("max_coverage"),
        F.min(F.struct((-F.col("coverage")).alias("c"), F.col("item"))).alias("best")), "hits")
    return marked.join(small_side(hits), "id_", "left").select(
        "row_", F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"), F.coalesce("max_coverage", F.lit(0.0)).alias("max_coverage"),
        F.col("best.item").alias("first_item"))
