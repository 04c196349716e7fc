"""Registered queries of the operators, and the SQL of those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from evenground.llm import tokenfile
from evenground.llm.backoff import score_texts
from evenground.llm.common import bind, tokenizer_file, words_of
from evenground.llm.html import extract
from evenground.llm.lines import line_dedup
from evenground.llm.oracles import QUALITY, SEARCH, SECRETS
from evenground.llm.packing import packed
from evenground.llm.pieces import sampled_pieces
from evenground.llm.quality import quality
from evenground.llm.ranked import search
from evenground.llm.runs import periodic_runs
from evenground.llm.secrets import secret_spans, span_text
from evenground.llm.simhash import near_duplicates
from evenground.llm.suffixes import remove_repeats
from evenground.llm.tiling import decontaminate

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {"op6_quality_rules": QUALITY, "op7_secret_scans": SECRETS, "op12_ranked_lexical_search": SEARCH}


if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL


def _query(f):
    QUERIES[f.__name__] = f
    return f


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows of the corpus pipeline."""
    return corpus_pipeline.run(spark, sf_dir)


@_query
def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return near_duplicates(_table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


@_query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document."""
    out = quality(_table(spark, sf_dir, "documents"))
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return out.select("doc_id", *[f"m.{c}" for c in base], *[F.round(f"m.{c}", 6).alias(c) for c in ("class_js", "word_js")])


@_query
def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of base matches, their digest and all spans of every document."""
    out = secret_spans(_table(spark, sf_dir, "documents"))
    number = lambda k: F.size(F.filter("spans", lambda s: s["rank"] == k)).cast("long")
    return out.select(
        "doc_id", number(0).alias("n_assign"), number(1).alias("n_access"), number(2).alias("n_hex"),
        F.sha2(span_text(F.filter("spans", lambda s: s["rank"] < 3)), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["live"])).cast("long").alias("n_live"))


@_query
def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that each document holds for the greater part."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = decontaminate(docs, _table(spark, sf_dir, "benchmark"))
    return out.select("row_.doc_id", (F.col("n_items") > 0).alias("contaminated"), "n_items",
                      F.round("max_coverage", 6).alias("max_coverage"), F.col("first_item").alias("item_id"))


@_query
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document, lines deleted, digest of what is left."""
    out = line_dedup(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("row_.doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"))


@_query
def op8_sentencepiece_encoding_and_decoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and checksum of the sampled pieces, and that they decode to the text."""
    return sampled_pieces(_table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"), ids=False)


@_query
def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract(_table(spark, sf_dir, "pages"))


@_query
def op5_token_id_binary_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and checksum of every document's ids, read back from the files."""
    path = tokenfile.new_folder(spark)
    tokenfile.write(_table(spark, sf_dir, "documents"), path, tokenizer_file("byte_bpe_50k.json"), end=2)
    return tokenfile.read(spark, path, ids=False).withColumnRenamed("key", "doc_id")


@_query
def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a model of those whose checksum is not 2 of 7."""
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7 == 2
    return score_texts(_table(spark, sf_dir, "documents"), held_out=held_out)


@_query
def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document under strings of 400 bytes that stand elsewhere."""
    return remove_repeats(_table(spark, sf_dir, "documents")).withColumn("has_repeat", F.col("n_removed") > 0)


def planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``; in the texts whose checksum ends in 0 the words
    from a place on repeat the first words after it."""
    mark = F.crc32(F.col("doc_id").cast("string"))
    steps = F.floor(mark / 10).cast("bigint")

    def repeated(words):
        n = F.size(words).cast("bigint")
        first = F.pmod(steps, n)
        period = 1 + F.floor((n - first) / (3 + F.pmod(steps, F.lit(8)))).cast("bigint")
        tail = F.transform(F.sequence(first, n - 1), lambda i: first + F.pmod(i - first, period))
        return F.concat(F.slice(words, F.lit(1), first.cast("int")), F.transform(tail, lambda i: F.get(words, i.cast("int"))))

    changed = bind(words_of(F.col("text")), lambda w: F.when(F.size(w) > 0, F.array_join(repeated(w), " ")).otherwise(F.lit("")))
    return docs.select("doc_id", F.when(mark % 10 == 0, changed).otherwise(F.col("text")).alias("text"))


@_query
def op11_periodic_run_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number, greatest and digest of the periodic runs of every document, and
    digest of its words without their repeats."""
    out = periodic_runs(planted_runs(_table(spark, sf_dir, "documents").select("doc_id", "text")))
    greatest = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r.start, r.length, r.period)), "")
    return out.withColumn("top", greatest).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), (-F.col("top.start")).alias("start"), F.col("top.length").alias("length"),
        (-F.col("top.period")).alias("period"), F.expr("1000 * top.length div -top.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words")


@_query
def op12_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    out = search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), k=50)
    return out.select("query.item_id", "rank", "doc_id", "score")


@_query
def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequence and place of every piece of every document."""
    return packed(_table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), end=2, size=1024, ids=False)
