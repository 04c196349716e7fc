"""Helpers shared by the operators: Arrow batches, row keys, components."""

from __future__ import annotations

import os
import sys
import types

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evenground.session import discard, written

#: rows of one Arrow batch that carry whole texts
TEXT_ROWS = 256
#: white space between words, U+0020 and U+0009 to U+000D
SPACE = " \t\n\x0b\x0c\r"


def text_batches(spark: SparkSession, rows: int = TEXT_ROWS) -> None:
    """Keep the Arrow batches of texts small; a batch of the default size may
    hold ten thousand very long texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def kept_in_worker(name: str, make):
    """What ``make`` returns, kept by a Python worker between its tasks.  The
    functions of this package travel by value, so their own globals are new in
    each task."""
    store = sys.modules.setdefault("evenground_kept", types.ModuleType("evenground_kept")).__dict__
    if name not in store:
        store[name] = make()
    return store[name]


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once for each row.

    A plain column used several times inside lambda functions may be put into
    them by the optimizer and then be evaluated for every element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; NULL has none."""
    trimmed = F.btrim(F.coalesce(text.cast("string"), F.lit("")), F.lit(SPACE))
    return F.when(trimmed == "", F.expr("CAST(array() AS array<string>)")).otherwise(F.split(trimmed, "[\\x20\\x09-\\x0D]+"))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected ``edges (a BIGINT, b BIGINT)``.

    Returns ``(node, root)``, the root being the smallest node of the
    component, for every node with an edge to another node.  Large-star and
    small-star steps alternate until the set of edges stays the same; each
    result is written to the shared folder, so that no lineage grows and
    a lost executor costs one step.  Every step is a pre-aggregated minimum and
    an equi-join, which adaptive execution splits where a node has many edges.
    """
    now = written(edges.where("a <> b").selectExpr("greatest(a, b) AS a", "least(a, b) AS b").distinct(), "edges")
    state = _state(now)
    while state[0]:
        both = now.unionByName(now.selectExpr("b AS a", "a AS b"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).selectExpr("a", "least(a, m) AS m")
        large = both.join(least, "a").where("b > a").selectExpr("b AS a", "m AS b").where("a <> b").distinct()
        large = written(large, "large")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").selectExpr("b AS a", "m AS b").where("a <> b")
        following = small.unionByName(low.selectExpr("a", "m AS b")).selectExpr("greatest(a, b) AS a", "least(a, b) AS b").distinct()
        following = written(following, "edges")
        after = _state(following)
        discard(now, large)
        now, before, state = following, state, after
        if after == before:
            break
    return now.selectExpr("a AS node", "b AS root").unionByName(now.selectExpr("b AS node", "b AS root").distinct())


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.countDistinct("a")).first()
    return tuple(row)


def tokenizer_file(name: str) -> str:
    """A vocabulary file of the public tokenizers; the folder is a setting."""
    return os.path.join(os.environ.get("PUBLIC_TOKENIZERS", "/opt/tokenizers"), name)
