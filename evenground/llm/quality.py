"""Quality rules by distribution divergence, in built-in functions only.

Each language of the corpus has a reference: the shares of seven classes of
characters and the shares of its most common words, both over all its
documents.  A document is compared with the reference of its language by
Jensen-Shannon distance (base 2, 0 to 1), one without a language with the
closest reference; languages are never mixed.  Short documents and small
references have noisy histograms, so each comparison has a least length, and
the allowances shrink with the square root of the size of both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenground.llm.common import bind, words_of
from evenground.session import written

# classes of characters; all others are the last class
CLASSES = {
    "small": "[a-z]",
    "capitals": "[A-Z]",
    "digits": "[0-9]",
    "space": "[\\x20\\x09-\\x0D]",
    "points": "[.,;:!?'\"()-]",
    "symbols": "[#*$%&|<>@/\\\\_=+~^{}`\\[\\]]",
}
COMMON_WORDS = 24
WINDOW = 5


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)


def _repeated_words(words: Column) -> Column:
    """Words in windows of five that the text has twice or more."""

    def detail(ordered: Column) -> Column:
        same = lambda a, b: F.coalesce(F.get(ordered, a)["x"] == F.get(ordered, b)["x"], F.lit(False))
        at = F.filter(F.sequence(F.lit(0), F.size(ordered) - 1), lambda k: same(k, k - 1) | same(k, k + 1))
        starts = F.array_sort(F.transform(at, lambda k: F.get(ordered, k)["i"]))
        return bind(starts, lambda p: _sum(F.transform(
            p, lambda x, k: F.coalesce(F.least(F.get(p, k + 1) - x, F.lit(WINDOW)), F.lit(WINDOW)).cast("long"))))

    def windows(w: Column, join) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW), lambda i: join(*[F.get(w, i + k) for k in range(WINDOW)]))

    def count(h: Column) -> Column:
        # equal windows have equal hashes; the windows themselves are only
        # compared where two hashes are equal
        texts = windows(words, lambda *w: F.concat_ws(" ", *w))
        pairs = F.array_sort(F.transform(texts, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(bind(pairs, detail))

    return F.when(F.size(words) < WINDOW, F.lit(0).cast("long")).otherwise(bind(windows(words, F.xxhash64), count))


def base_measures(text: Column) -> dict[str, Column]:
    """Measures of one text; NULL counts as empty."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    removed = lambda t, pattern: (F.length(t) - F.length(F.regexp_replace(t, f"{pattern}+", ""))).cast("long")
    first, *others = CLASSES.values()

    def rest_of(rest: Column) -> Column:
        small = (F.length(text) - F.length(rest)).cast("long")
        return F.struct(F.array(small, *[removed(rest, c) for c in others]).alias("classes"), removed(rest, "[#*$%&|<>]").alias("symbols"))

    return {
        "chars_": F.length(text).cast("long"),
        # all other classes are counted in what is left without the first
        "c_": bind(F.regexp_replace(text, f"{first}+", ""), rest_of),
        "n_dup_lines": bind(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")),
    }


def _histogram(chars: Column, classes: Column) -> Column:
    return F.concat(classes, F.array(chars - _sum(classes)))


def divergence(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance, base 2, of counts or shares of equal length."""
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    part = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)

    def over(s: Column) -> Column:
        terms = F.zip_with(F.transform(p, lambda x: x.cast("double") / s), q,
                           lambda x, y: (part(x, (x + y) / 2) + part(y, (x + y) / 2)) / 2)
        return F.sqrt(F.greatest(total(terms), F.lit(0.0)))

    return bind(total(F.transform(p, lambda x: x.cast("double"))), lambda s: F.when(s > 0, over(s)))


def word_references(docs: DataFrame, text: str = "text", lang: str = "lang", common: int = COMMON_WORDS) -> DataFrame:
    """``lang_`` and ``refs`` as of ``_candidates``: ``common_words`` (by count,
    then word), ``word_shares`` (last: all other words), ``lang``."""
    plain = docs.select(F.col(lang).cast("string").alias("lang_"), F.col(text).cast("string").alias("text_")).where("lang_ IS NOT NULL")
    words = plain.select("lang_", F.explode(words_of(F.col("text_"))).alias("word"))
    counts = written(words.groupBy("lang_", "word").agg(F.count("*").alias("n")), "words")
    totals = counts.groupBy("lang_").agg(F.sum("n").alias("size"))
    top = counts.withColumn("rank", F.row_number().over(Window.partitionBy("lang_").orderBy(F.desc("n"), "word"))).where(F.col("rank") <= common)
    top = top.groupBy("lang_").agg(F.array_sort(F.collect_list(F.struct("rank", "word", "n"))).alias("top"))
    common_n = F.aggregate(F.col("top"), F.lit(0).cast("long"), lambda a, x: a + x["n"])
    return _candidates(top.join(totals, "lang_").select(
        "lang_", F.transform("top", lambda x: x["word"]).alias("common_words"),
        F.concat(F.transform("top", lambda x: x["n"] / F.col("size")), F.array((F.col("size") - common_n) / F.col("size"))).alias("word_shares"),
        F.col("lang_").alias("lang")))


def class_references(measured: DataFrame) -> DataFrame:
    """``lang_`` and ``refs`` as of ``_candidates``: ``class_shares``, ``size``
    in characters, ``texts`` (the effective number of documents, by words) and
    ``lang``, over all measured documents of each language."""
    names = [f"c{i}" for i in range(len(CLASSES))]
    sums = measured.where("lang_ IS NOT NULL").groupBy("lang_").agg(
        F.sum("chars_").alias("size"), F.sum("n_words").cast("double").alias("w"), F.sum(F.col("n_words").cast("double") * F.col("n_words")).alias("w2"), *[F.sum(F.col("classes_")[i]).alias(n) for i, n in enumerate(names)]).where("size > 0")
    shares = F.transform(_histogram(F.col("size"), F.array(*[F.col(n) for n in names])), lambda x: x / F.col("size"))
    texts = F.when(F.col("w2") > 0, F.col("w") * F.col("w") / F.col("w2")).alias("texts")
    return _candidates(sums.select("lang_", shares.alias("class_shares"), "size", texts, F.col("lang_").alias("lang")))


def _candidates(refs: DataFrame) -> DataFrame:
    """``refs`` of each ``lang_``: an array of its own reference, and, where
    ``lang_`` is NULL, of the references of all languages."""
    refs = written(refs, "references")
    ref = F.struct(*[c for c in refs.columns if c != "lang_"])
    everyone = refs.agg(F.array_sort(F.collect_list(F.struct("lang_", ref.alias("ref")))).alias("all_")).select(
        F.lit(None).cast("string").alias("lang_"), F.transform("all_", lambda x: x["ref"]).alias("refs"))
    return written(refs.select("lang_", F.array(ref).alias("refs")).unionByName(everyone), "candidates")


def _with_references(rows: DataFrame, refs: DataFrame) -> DataFrame:
    """``refs`` of each row.  The table of references is small and written, so
    it is broadcast by its size."""
    refs = refs.withColumnRenamed("lang_", "of_")
    return rows.join(refs, F.col("lang_").eqNullSafe(F.col("of_")), "left").drop("of_")


def _closest(distance) -> Column:
    """``js`` and ``lang`` of the closest of the row's references."""
    return F.array_min(F.transform(F.col("refs"), lambda r: F.struct(distance(r).alias("js"), r["lang"].alias("lang"))))


def quality(docs: DataFrame, text: str = "text", lang: str = "lang", class_limit: float = 0.32, class_noise: float = 1.2,
            word_limit: float = 0.18, word_noise: float = 2.3, text_noise: float = 0.11, least_chars: int = 200, least_words: int = 50, all_columns: bool = False) -> DataFrame:
    """All columns of ``docs`` (or ``doc_id`` and ``lang`` only) and a struct
    ``m`` of the measures, ``class_js``, ``word_js``, ``base_failed``, ``kept``.

    Texts are read twice: for the common words, then for all measures, which
    are written; references of classes and verdicts come from the latter.

    A distance is NULL, and decides nothing, for a text under the least
    length.  A language has its own reference at every size; a NULL language
    has the closest one, by words and by classes, and no distance if no row
    has a language.  The limits grow with the sampling error of the reference; a
    text repeats its words, so that of words goes by the number of texts.
    NULL texts count as empty and fail the base rules; an empty table gives no
    rows; columns of ``docs`` may have any names.
    """
    mine = docs if all_columns else docs.select("doc_id", lang)
    columns = mine.columns
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row_"), F.col(lang).cast("string").alias("lang_"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text_"))
    rows = _with_references(rows, word_references(docs, text, lang))
    base = base_measures(F.col("text_"))

    def of_words(w: Column) -> Column:
        def distance(r: Column) -> Column:
            def words_js(found: Column) -> Column:
                # each word has two spaces of its own, so that removing one leaves the others
                joined = F.concat(F.lit(" "), F.array_join(found, "  "), F.lit(" "))

                def count(s: Column) -> Column:
                    # bytes are known, characters would have to be counted
                    number = lambda x: ((F.octet_length(s) - F.octet_length(F.replace(s, F.concat(F.lit(" "), x, F.lit(" ")), F.lit("")))) / (F.octet_length(x) + 2)).cast("long")
                    return F.concat(F.transform(r["common_words"], number), F.array((F.size(w) - F.size(found)).cast("long")))

                return divergence(bind(joined, count), r["word_shares"])

            longest = F.array_max(F.transform(r["common_words"], F.length))
            found = bind(longest, lambda n: F.filter(w, lambda x: (F.length(x) <= n) & F.array_contains(r["common_words"], x)))
            return bind(found, words_js)

        return F.struct(
            F.size(w).cast("long").alias("n_words"), _repeated_words(w).alias("n_repeat_words"),
            F.when(F.size(w) >= least_words, _closest(distance)).alias("by_words"))

    measured = rows.select("row_", "lang_", *[c.alias(n) for n, c in base.items()], bind(words_of(F.col("text_")), of_words).alias("w")).select(
        "row_", "lang_", "chars_", F.col("c_.classes").alias("classes_"), F.col("c_.symbols").alias("n_symbols"), "n_dup_lines", "w.*")
    measured = written(measured, "measures")
    judged = _with_references(measured, class_references(measured))
    by_classes = bind(_histogram(F.col("chars_"), F.col("classes_")), lambda h: _closest(lambda r: divergence(h, r["class_shares"])))
    judged = judged.withColumn("by_classes", F.when(F.col("chars_") >= least_chars, by_classes))
    rows = judged.select(
        "row_", "n_words", (F.col("chars_") - F.col("classes_")[list(CLASSES).index("space")]).alias("word_chars"),
        "n_symbols", "n_dup_lines", "n_repeat_words", F.col("by_classes.js").alias("class_js"), F.col("by_words.js").alias("word_js"),
        *[F.get(F.filter("refs", lambda r: r["lang"] == F.col(f"{by}.lang")), 0)[of].alias(n) for by, of, n in (
            ("by_classes", "size", "class_size_"), ("by_words", "texts", "word_texts_"))])
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    far = (F.col("class_js") > class_limit + class_noise / F.sqrt("class_size_")) | (
        F.col("word_js") > word_limit + word_noise * F.sqrt(1 / F.col("n_words") + text_noise / F.col("word_texts_")))
    kept = ~failed & ~F.coalesce(far, F.lit(False))
    rows = rows.withColumn("base_failed", failed).withColumn("kept", kept).drop("class_size_", "word_texts_")
    measures = [c for c in rows.columns if c != "row_"]
    return rows.select(*[F.col("row_")[c].alias(c) for c in columns], F.struct(*measures).alias("m"))
