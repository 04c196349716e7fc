"""Secret scan by corpus-wide ownership, in built-in functions only.

Base rules find assignments, access keys and hexadecimal keys.  Beyond these,
long mixed tokens are candidates.  The corpus decides about them: the hash of
each candidate is aggregated over the repositories and owners that hold it.
A value of one owner only looks live and is reported; a value that many owners
hold is a copied example and is not.  The same counts grade the base matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenground.llm.common import bind
from evenground.session import written

# kind, pattern of a match, least code points of the judged group; longer
# patterns stand for the rules wherever a shorter match can't hide another one
ASSIGN = "(?i:password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "owned")
CANDIDATE = "[A-Za-z0-9+/_=-]{20,}"


def _spans(text: Column, pattern: str, rank: int, value_group: int = 0, least: int = 0) -> Column:
    """Array of (start, rank, stop, value), in code points, of all matches of
    ``pattern`` whose value has ``least`` code points or more.

    The gaps between the matches are what a split leaves, so starts are
    running sums over gaps and matches.
    """

    def placed(gaps: Column, whole: Column, values: Column) -> Column:
        steps = F.transform(whole, lambda m, i: F.struct(
            F.length(F.get(gaps, i)).alias("gap"), F.length(m).alias("size"), F.get(values, i).alias("value")))
        empty = F.struct(F.lit(0).alias("at"), F.expr("CAST(array() AS array<struct<start:int,rank:int,stop:int,value:string>>)").alias("out"))
        return F.aggregate(steps, empty, lambda a, s: F.struct(
            (a["at"] + s["gap"] + s["size"]).alias("at"),
            F.concat(a["out"], F.array(F.struct(
                (a["at"] + s["gap"]).alias("start"), F.lit(rank).alias("rank"),
                (a["at"] + s["gap"] + s["size"]).alias("stop"), s["value"].alias("value")))).alias("out")), lambda a: a["out"])

    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group)) if value_group else whole
    found = bind(F.split(text, pattern, -1), lambda g: bind(whole, lambda w: bind(values, lambda v: placed(g, w, v))))
    none = F.expr("CAST(array() AS array<struct<start:int,rank:int,stop:int,value:string>>)")
    found = F.filter(found, lambda s: F.length(s["value"]) >= least) if least else found
    return F.when(text.rlike(pattern), found).otherwise(none)


def _mixed(value: Column) -> Column:
    """Looks generated: letters and digits in turn, not a path or a word."""
    turns = F.size(F.regexp_extract_all(value, F.lit("[A-Za-z][0-9]|[0-9][A-Za-z]"), F.lit(0)))
    return (turns >= 3) & (F.size(F.array_distinct(F.split(value, ""))) >= 10)


def secret_spans(docs: DataFrame, text: str = "text", owner: str = "source", repository: str = "doc_id",
                 keep: tuple[str, ...] = ("doc_id",), copied_owners: int = 2) -> DataFrame:
    """One row per row of ``docs``: ``keep`` and ``spans``, an array of
    (start, rank, stop, value, hash, repositories, owners, live) by start, then
    rank in ``KINDS``; start and stop in code points, stop exclusive.

    ``owned`` spans are candidates that no base match overlaps and that fewer
    than ``copied_owners`` owners hold.  ``live`` says the same of any span's
    value.  NULL texts have no spans.  NULL owners and repositories are one
    owner and one repository.  Repeated rows count as often as they stand;
    an empty table gives no rows.
    """
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    base = docs.select(
        F.struct(*[F.col(k) for k in keep]).alias("row_"), F.sha2(F.coalesce(F.col(owner).cast("string"), F.lit("")), 256).alias("owner_"),
        F.sha2(F.coalesce(F.col(repository).cast("string"), F.lit("")), 256).alias("repository_"),
        F.concat(_spans(t, ASSIGN, 0, 1, 6), _spans(t, ACCESS, 1), _spans(t, HEX, 2)).alias("base_"),
        F.filter(_spans(t, CANDIDATE, 3), lambda s: _mixed(s["value"])).alias("more_"))
    more = F.filter("more_", lambda m: ~F.exists("base_", lambda b: (b["start"] < m["stop"]) & (m["start"] < b["stop"])))
    base = base.select("row_", "owner_", "repository_", F.array_sort(F.concat("base_", more)).alias("spans_")).withColumn(
        "id_", F.monotonically_increasing_id())
    table = written(base, "secrets")
    each = table.select("id_", "owner_", "repository_", F.explode("spans_").alias("s")).select(
        "id_", "owner_", "repository_", "s", F.sha2(F.col("s.value"), 256).alias("hash"))
    held = each.select("hash", "owner_", "repository_").distinct()
    counts = held.groupBy("hash", "owner_").agg(F.count("*").alias("r")).groupBy("hash").agg(
        F.sum("r").alias("repositories"), F.count("*").alias("owners"))
    judged = each.join(counts, "hash").withColumn("live", F.col("owners") < copied_owners).where("s.rank < 3 OR live")
    spans = judged.groupBy("id_").agg(F.array_sort(F.collect_list(F.struct(
        "s.start", "s.rank", "s.stop", "s.value", "hash", "repositories", "owners", "live"))).alias("spans"))
    return table.join(spans, "id_", "left").select(*[F.col("row_")[k].alias(k) for k in keep], F.coalesce(
        "spans", F.expr("CAST(array() AS array<struct<start:int,rank:int,stop:int,value:string,hash:string,repositories:bigint,owners:bigint,live:boolean>>)")).alias("spans"))


def span_text(spans: Column, of: Column | None = None) -> Column:
    """``kind:start:end`` of spans, joined by commas."""
    name = lambda s: F.element_at(F.array(*[F.lit(k) for k in KINDS]), s["rank"] + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s), s["start"].cast("string"), s["stop"].cast("string"))), ",")
