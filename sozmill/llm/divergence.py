"""Quality rules by distribution divergence, in DataFrame functions only.

A document is compared with the reference of its language: two histograms, of
character classes and of the language's commonest words, each by Jensen-Shannon
distance. Short documents have noisy histograms, so each rule has a guard on
the length. References are sums over all documents.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import stored

# Fixed values of the contract.
SPACES = "[\\x20\\x09-\\x0D]+"
NOT_SYMBOLS = "[^#*$%&|<>]+"
MIN_WORDS, MAX_REPEATED_PERCENT, RUN = 10, 20, 5

#: Character classes; what is in none of them (other letters, marks) is the last bin.
CLASSES = {"upper": "\\p{Lu}", "digit": "\\p{Nd}", "point": "\\p{P}", "symbol": "\\p{S}"}
COMMON_WORDS = 16
#: So many references are broadcast, the largest first; documents of other languages are joined to theirs.
BROADCAST = 4096
#: A distance beyond ``limit + slack / sqrt(length)`` rejects, as histograms of short texts are noisy.
#: The guards are the lengths, in characters or words, from which a rule holds at all.
CLASS_LIMIT, CLASS_SLACK, GUARD_CHARS = 0.20, 1.2, 200
WORD_LIMIT, WORD_SLACK, GUARD_WORDS = 0.18, 1.0, 60
#: What a reference adds to a limit, over the square root of its words or characters: those of few are noisy, too.
WORD_REF_SLACK, CLASS_REF_SLACK = 3.0, 3.0
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def left_by(text: Column, removed: str) -> Column:
    """Characters that are left when a pattern is removed."""
    return F.length(F.regexp_replace(text, removed, "")).cast("long")


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)


def _with(value: Column, body) -> Column:
    """``body(value)`` with the value made once."""
    return F.get(F.transform(F.array(value), body), 0)


def _repeated(windows: Column) -> Column:
    """Words in windows that occur twice or more, from the hash of each window by its first word.

    Equal windows are neighbours once sorted; the places of those are put in
    order again, and each covers the words up to the next, its length at most.
    """
    pairs = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return _with(pairs, _covered)


def _covered(pairs: Column) -> Column:
    def same(pair, k):
        return F.coalesce(pair["h"] == F.get(pairs, k)["h"], F.lit(False))

    def until_next(places):
        return _sum(F.transform(places, lambda x, k: F.least(
            F.lit(RUN), F.coalesce(F.get(places, k + 1) - x, F.lit(RUN))).cast("long")))

    twice = F.filter(pairs, lambda p, k: same(p, k - 1) | same(p, k + 1))
    return _with(F.array_sort(F.transform(twice, lambda p: p["i"])), until_next)


def measure(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with the base counts, ``__classes`` and ``__hashes`` of its words."""
    content = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(content, "\n"), lambda x: F.length(F.regexp_replace(x, SPACES, "")) > 0)
    first = docs.withColumns({"__words": words_of(F.col(text)), "__lines": lines})
    hashed = first.withColumn("__hashes", F.transform("__words", lambda w: F.xxhash64(w)))
    hashes = F.col("__hashes")
    windows = F.transform(
        F.slice(hashes, 1, F.greatest(F.size(hashes) - RUN + 1, F.lit(0))),
        lambda h, i: F.xxhash64(h, *[F.get(hashes, i + k) for k in range(1, RUN)]))
    joined = F.array_join("__words", "")
    measured = hashed.withColumns({
        "__windows": windows,
        "n_words": F.size("__words").cast("long"),
        "word_chars": F.length(joined).cast("long"),
        "n_symbols": left_by(content, NOT_SYMBOLS),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "__classes": classes(content),
    })
    some = F.size(F.array_distinct("__windows")) < F.size("__windows")
    return measured.withColumn(
        "n_repeat_words", F.when(some, _repeated(F.col("__windows"))).otherwise(F.lit(0).cast("long"))
    ).drop("__words", "__lines", "__windows")


def classes(content: Column) -> Column:
    """Characters of each class, white space left out, then the rest."""
    inside = left_by(content, SPACES)
    counts = [left_by(content, f"[^{c}]+") for c in CLASSES.values()]
    return F.array(*counts, inside - reduce(lambda a, b: a + b, counts))


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two histograms of counts or shares, 0 to 1; null if one is empty."""
    total_p = F.aggregate(p, F.lit(0.0), lambda a, x: a + x)
    total_q = F.aggregate(q, F.lit(0.0), lambda a, x: a + x)

    def part(x, m):
        return F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)

    terms = F.zip_with(
        F.transform(p, lambda x: x / total_p), F.transform(q, lambda x: x / total_q),
        lambda x, y: (part(x, (x + y) / 2) + part(y, (x + y) / 2)) / 2)
    whole = F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)
    return F.when((total_p > 0) & (total_q > 0), F.sqrt(F.greatest(whole, F.lit(0.0))))


def references(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """One row a language: ``ref_lang, ref_classes, ref_words, ref_counts``.

    ``ref_words`` are hashes of the commonest words, ``ref_counts`` their counts
    and that of all other words. The row of a null language has the classes of all
    documents, and no words: those of several languages are no measure of any one.
    A stored table of small rows.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    bins = range(len(CLASSES) + 1)
    # A row for each language, read once from the texts.
    totals = stored(
        docs.select(F.col(lang).alias("lang"), classes(content).alias("c"), F.size(words_of(F.col(text))).alias("n"))
        .groupBy("lang")
        .agg(F.sum("n").alias("n"), *[F.sum(F.get("c", k)).cast("double").alias(f"c{k}") for k in bins])
    )
    of_all = totals.agg(*[F.sum(f"c{k}").alias(f"c{k}") for k in bins]).select(
        F.lit(None).cast("string").alias("ref_lang"), F.array(*[f"c{k}" for k in bins]).alias("ref_classes"),
        F.lit(None).cast("array<long>").alias("ref_words"), F.lit(None).cast("array<double>").alias("ref_counts"))
    words = docs.filter(F.col(lang).isNotNull()).select(
        F.col(lang).alias("lang"), F.explode(words_of(F.col(text))).alias("word"))
    counted = words.select("lang", F.xxhash64("word").alias("hash")).groupBy("lang", "hash").agg(
        F.count(F.lit(1)).alias("n"))
    by_rank = Window.partitionBy("lang").orderBy(F.desc("n"), "hash")
    top = counted.withColumn("rank", F.row_number().over(by_rank)).filter(F.col("rank") <= COMMON_WORDS)
    common = top.groupBy("lang").agg(
        F.sort_array(F.collect_list(F.struct("rank", "hash", F.col("n").cast("double").alias("n")))).alias("common"))
    counts = F.coalesce(F.col("common.n"), F.array().cast("array<double>"))
    rest = F.col("n") - F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
    own = totals.filter(F.col("lang").isNotNull()).join(common, "lang", "left").select(
        F.col("lang").alias("ref_lang"), F.array(*[f"c{k}" for k in bins]).alias("ref_classes"),
        F.coalesce(F.col("common.hash"), F.array().cast("array<long>")).alias("ref_words"),
        F.concat(counts, F.array(rest)).alias("ref_counts"))
    return stored(own.unionByName(of_all))


def _total(counts) -> Column:
    return F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)


def _held(docs: DataFrame, reference: DataFrame, lang: str) -> DataFrame:
    """``docs`` with the reference of their language, or null."""
    own = reference.filter(F.col("__ref_lang").isNotNull())
    same = F.col(lang) == F.col("__ref_lang")
    if own.count() <= BROADCAST:
        return docs.join(F.broadcast(own), same, "left")
    large = stored(own.orderBy(_total("__ref_counts").desc(), "__ref_lang").limit(BROADCAST))
    small = own.join(F.broadcast(large.select("__ref_lang")), "__ref_lang", "left_anti")
    first = docs.join(F.broadcast(large), same, "left")
    none = F.col("__ref_lang").isNull()
    # Each of these languages has less than 1 / BROADCAST of all words, so none is a hot key.
    others = first.filter(none & F.col(lang).isNotNull()).select(*docs.columns).join(small, same, "left")
    return first.filter(~none | F.col(lang).isNull()).unionByName(others)


def verdicts(docs: DataFrame, reference: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs`` with the base counts, ``class_distance, word_distance, base_failed, kept``.

    ``reference`` comes from ``references`` and is broadcast, so no text is
    shuffled, but for languages beyond the ``BROADCAST`` largest. Null is a text without
    words: it fails the base. A null language is held against the
    character classes of all documents; its words can't be judged. A distance
    is null where that is so or the document is under the guard, and the rule then
    passes; so it does if there is no reference. The fewer words a reference has, the more
    it lets pass. Repeated rows get equal verdicts; columns of these names are replaced.
    """
    added = (*BASE, "class_distance", "word_distance", "base_failed", "kept")
    docs = docs.drop(*added)
    # Apart from all names that documents may have.
    reference = reference.toDF(*[f"__{c}" for c in reference.columns])
    of_all = F.broadcast(reference.filter(F.col("__ref_lang").isNull()).select(
        F.lit(True).alias("__all"), F.col("__ref_classes").alias("__all_classes")))
    held = _held(docs, reference, lang).withColumn("__all", F.lit(True)).join(of_all, "__all", "left")
    held = held.withColumn("__ref_classes", F.coalesce("__ref_classes", "__all_classes")).drop(
        "__all", "__ref_lang", "__all_classes")
    measured = measure(held, text)
    counts = F.transform("__ref_words", lambda w: (
        F.size("__hashes") - F.size(F.array_remove("__hashes", w))).cast("double"))
    measured = measured.withColumn("__counts", F.when(F.col("n_words") >= GUARD_WORDS, counts))
    histogram = F.concat("__counts", F.array(F.col("n_words") - _total("__counts")))
    far = measured.withColumns({
        "class_distance": F.when(F.col("word_chars") >= GUARD_CHARS, distance(
            F.col("__classes").cast("array<double>"), F.col("__ref_classes"))),
        "word_distance": distance(histogram, F.col("__ref_counts")),
        "base_failed": (F.col("n_words") < MIN_WORDS) | (
            100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")),
    })

    def near(name, limit, slack, length, ref_slack, reference):
        size = F.greatest(_total(reference), F.lit(1.0))
        return F.coalesce(F.col(name) <= limit + slack / F.sqrt(length) + ref_slack / F.sqrt(size), F.lit(True))

    kept = (
        ~F.col("base_failed")
        & near("class_distance", CLASS_LIMIT, CLASS_SLACK, "word_chars", CLASS_REF_SLACK, "__ref_classes")
        & near("word_distance", WORD_LIMIT, WORD_SLACK, "n_words", WORD_REF_SLACK, "__ref_counts"))
    # From a generator: a filter on plain columns would be moved below the projections and
    # drag copies of all their expressions with it.
    found = F.struct(*added[:-1], kept.alias("kept"))
    return far.select(*docs.columns, F.inline(F.array(found)))


def passing(docs: DataFrame, reference: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """Rows of ``docs`` that ``verdicts`` keeps, with the columns of ``docs``."""
    return verdicts(docs, reference, text, lang).filter("kept").select(*docs.columns)
