"""Deletion of later copies of repeated runs of lines.

Lines with words become numbers, the rank of a line being the first place
where it stands.  Prefix doubling then ranks the runs of 2, 4, 8 ... lines of
every suffix: two runs that share both halves share a rank, which again is
their first place, so the suffixes of one rank are one interval of the suffix
array with a common prefix of that many lines.  Intervals of one suffix are
left out at once, so each round has the repeated suffixes only.

A repeated run counts from ``least_words`` words on.  It is the union of its
shortest such windows that begin at one of its lines and its shortest ones
that end at one.  A window of n lines is named exactly by the two (overlapping)
runs of 2^k <= n lines at its ends, so one grouping finds the windows that
stand earlier somewhere, without comparing pairs.  A window has
``least_words`` lines at most, which bounds the rounds by its logarithm.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenground.llm.common import bind, words_of
from evenground.session import written

SPACE = " \t\r\x0b\x0c"


def _windows(frames: Iterator[pd.DataFrame], least: int) -> Iterator[pd.DataFrame]:
    """Shortest windows of ``least`` words from each line on and up to each
    line, within consecutive repeated lines of one document."""
    for frame in frames:
        out = []
        for id_, lines in zip(frame["id_"], frame["lines"]):
            at = np.array([x["i"] for x in lines], np.int64)
            words = np.array([x["words"] for x in lines], np.int64)
            pos = np.array([x["pos"] for x in lines], np.int64)
            cuts = np.flatnonzero(np.diff(at) != 1) + 1
            for part in np.split(np.arange(len(at)), cuts):
                sums = np.concatenate(([0], np.cumsum(words[part])))
                stop = np.searchsorted(sums, sums[:-1] + least)  # first sum that is large enough
                start = np.searchsorted(sums, sums[1:] - least, side="right") - 1  # last start that is
                pairs = {(s, e) for s, e in enumerate(stop.tolist()) if e < len(sums)}
                pairs |= {(s, e + 1) for e, s in enumerate(start.tolist()) if s >= 0}
                out += [(id_, at[part[s]], e - s, pos[part[s]]) for s, e in sorted(pairs)]
        yield pd.DataFrame(out, columns=["id_", "i", "n", "pos"]).astype("int64")


def repeated_lines(docs: DataFrame, text: str = "text", order: str = "doc_id", least_words: int = 50) -> DataFrame:
    """``(id_, o)``: the places (from 0, of lines split at line feeds) that
    later copies cover.  ``docs`` has a unique ``id_ BIGINT``."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    split = F.transform(F.split(body, "\n"), lambda x, o: F.struct(F.btrim(x, F.lit(SPACE)).alias("x"), o.alias("o")))
    lines = docs.select("id_", F.col(order).alias("order_"), F.posexplode(bind(split, lambda s: F.filter(s, lambda x: x["x"] != ""))).alias("i", "l"))
    lines = written(lines.select(
        "id_", "order_", "i", F.col("l.o").alias("o"), F.xxhash64("l.x").alias("h"), F.hash("l.x").alias("g"),
        F.size(words_of(F.col("l.x"))).alias("words")), "lines")
    twice = lines.groupBy("h", "g").agg(F.count("*").alias("times")).where("times > 1").select("h", "g")
    found = lines.join(twice, ["h", "g"], "left_semi").orderBy(F.col("order_").asc_nulls_last(), "id_", "i")
    found = written(found.withColumn("pos", F.monotonically_increasing_id()), "repeated")
    first = found.groupBy("h", "g").agg(F.min("pos").alias("name"))
    level = written(found.join(first, ["h", "g"]).select("id_", "i", "pos", "name"), "rank")
    levels, k = [level.withColumn("k", F.lit(0))], 0
    while 2 ** (k + 1) <= least_words:
        ahead = level.select("id_", (F.col("i") - 2**k).alias("i"), F.col("name").alias("then"))
        pairs = level.join(ahead, ["id_", "i"])
        both = pairs.groupBy("name", "then").agg(F.min("pos").alias("first"), F.count("*").alias("times")).where("times > 1")
        level = written(pairs.join(both, ["name", "then"]).select("id_", "i", "pos", F.col("first").alias("name")), "rank")
        k += 1
        if level.isEmpty():
            break
        levels.append(level.withColumn("k", F.lit(k)))
    ranks = levels[0]
    for other in levels[1:]:
        ranks = ranks.unionByName(other)
    ranks = ranks.select("k", "id_", "i", "name")
    per_document = found.groupBy("id_").agg(F.array_sort(F.collect_list(F.struct("i", "words", "pos"))).alias("lines"))
    windows = per_document.mapInPandas(lambda f: _windows(f, least_words), "id_ bigint, i bigint, n bigint, pos bigint")
    windows = windows.withColumn("k", F.floor(F.log2("n") + 1e-9).cast("int"))
    named = windows.join(ranks.withColumnRenamed("name", "head"), ["k", "id_", "i"]).withColumn(
        "j", (F.col("i") + F.col("n") - F.pow(F.lit(2.0), F.col("k")).cast("long")))
    named = written(named.join(ranks.select("k", "id_", F.col("i").alias("j"), F.col("name").alias("tail")), ["k", "id_", "j"]), "windows")
    earliest = named.groupBy("n", "head", "tail").agg(F.min("pos").alias("first"))
    later = named.join(earliest, ["n", "head", "tail"]).where("pos > first")
    gone = later.select("id_", F.explode(F.sequence("i", F.col("i") + F.col("n") - 1)).alias("i")).distinct()
    return gone.join(found.select("id_", F.col("i").cast("long").alias("i"), "o"), ["id_", "i"]).select("id_", "o")


def line_dedup(docs: DataFrame, text: str = "text", order: str = "doc_id", least_words: int = 50) -> DataFrame:
    """``row_`` (all columns of ``docs`` as a struct), ``n_lines``,
    ``n_removed`` and ``kept``, the text without the deleted lines.

    Lines are equal if they are so without white space at their ends; lines
    without words are no part of a run and stay.  The first place in the order
    of ``order`` (NULL last), then of the input, keeps its lines.  NULL texts
    have one empty line and stay NULL; repeated rows are copies like others.
    """
    marked = docs.select(F.struct("*").alias("row_"), F.col(text).alias("text_"), F.col(order).alias("order_")).withColumn(
        "id_", F.monotonically_increasing_id())
    gone = repeated_lines(marked, "text_", "order_", least_words)
    gone = written(gone.groupBy("id_").agg(F.collect_set("o").alias("gone")), "gone")
    split = F.split(F.coalesce(F.col("text_").cast("string"), F.lit("")), "\n")
    none = F.expr("CAST(array() AS array<int>)")

    def rebuild(s):
        left = F.array_except(F.sequence(F.lit(0), F.size(s) - 1), F.col("gone"))
        return F.array_join(F.transform(left, lambda o: F.get(s, o)), "\n")

    # the same join at every size, so that its cost is in proportion
    out = marked.join(gone.hint("merge"), "id_", "left")
    return out.select(
        "row_", F.size(split).cast("long").alias("n_lines"), F.size(F.coalesce("gone", none)).cast("long").alias("n_removed"),
        F.when(F.col("gone").isNull(), F.col("text_")).otherwise(bind(split, rebuild)).alias("kept"))
