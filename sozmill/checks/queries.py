"""One query for each operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions import domain as D, labels as L, text as X
from ..functions.rules import INTENDED, OBSERVED, RulePack
from ..operators import coverage as C, rows as R, similarity as S, subwords as B, tokens as K
from ..operators.normalize import clean_text
from ..operators.training import train_word2vec
from ..plans import evaluate as E, negation as G, tune as U
from ..plans.clean import clean_rows, row_counts
from ..plans.corpus import corpus_lines
from ..plans.report import neighbour_report
from ..sources.models import load_bucketed, save_bucketed
from ..sources.params import check_params
from ..sources.sinks import write_corpus, write_sources, write_two_column
from ..sources.tables import (
    SourceSpec, bad_records, materialize, read_cleaned, read_corpus, read_sources, require_rows, spread, work_folder,
)
from .snippets import SNIPPETS

TRI_LABELS = ("pos", "neu", "neg", "müsbət", "2", "junk")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def texts(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A table whose texts are worked on without a shuffle before."""
    return spread(table(spark, sf, name))


def pick(values, index: Column) -> Column:
    """The element of a literal list at ``index`` modulo its length."""
    literal = F.array(*[F.lit(v) for v in values])
    return F.element_at(literal, (index % len(values)).cast("int") + 1)


def with_snippet(text: Column, length: Column) -> Column:
    return F.concat(text, F.lit(" "), pick(SNIPPETS, length))


def docs(spark, sf) -> DataFrame:
    text = with_snippet(F.col("text"), F.col("n_chars"))
    return texts(spark, sf, "documents").select(
        "doc_id", "lang", "source", "n_chars", text.alias("text"))


def doc_rule(rule) -> Callable:
    """Query that applies one text rule to every document."""
    def query(spark, sf):
        return docs(spark, sf).select("doc_id", rule(F.col("text")).alias("t"))
    return query


def _rows(df, name, order, source_ord, text, has_label, value):
    return df.select(
        F.lit(name).alias("source"), F.lit(source_ord).alias("source_ord"),
        order.cast("long").alias("row_ord"), text.alias("text"), has_label.alias("has_label"),
        value.cast("double").alias("sentiment_value"),
    )


def rows_all(spark, sf, read=table) -> DataFrame:
    """Three labelled sources in canonical form."""
    documents = read(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    talk = read(spark, sf, "conversations")
    bench = table(spark, sf, "benchmark")
    text, quality = F.col("text"), F.col("quality")

    def tri(index):
        return L.sentiment_value(pick(TRI_LABELS, index), "tri", T.StringType())

    parts = [
        _rows(documents, "documents", F.col("doc_id"), 0, with_snippet(text, F.col("n_chars")),
              quality.isNotNull(), L.sentiment_value(quality, "binary", T.IntegerType())),
        _rows(talk, "conversations", F.col("conv_id") * 1000 + F.col("turn"), 1,
              with_snippet(text, F.length(text)), F.lit(True),
              tri(F.col("conv_id") + F.col("turn"))),
        _rows(bench, "benchmark", F.col("item_id"), 2, with_snippet(text, F.length(text)),
              F.lit(True), tri(F.col("item_id"))),
    ]
    return reduce(DataFrame.unionByName, parts)


def clean_docs(spark, sf, rules: RulePack = OBSERVED) -> DataFrame:
    tagged = docs(spark, sf).withColumn("domain", D.detect_domain(F.col("text")))
    return clean_text(tagged, rules=rules).select("doc_id", "lang", "source", "domain", "cleaned_text")


def lower_tokens(text: Column) -> Column:
    return X.extract_tokens(X.lower_az(text))


def count_tokens(tokens: DataFrame) -> DataFrame:
    return tokens.groupBy("token").agg(F.count(F.lit(1)).alias("cnt"))


# --- sources, filters, dedup, limits ---------------------------------------

def union_sources(spark, sf):
    return rows_all(spark, sf).groupBy("source", "source_ord").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("has_label").alias("labelled"),
        F.sum(F.length("text")).alias("chars"),
    )


def drop_blank(spark, sf):
    """All pages, and one blank and one null row for each."""
    pages = table(spark, sf, "pages").select("page_id", F.col("html").alias("text"))
    blank = pages.select("page_id", F.lit(chr(160) + "\t  ").alias("text"))
    none = pages.select("page_id", F.lit(None).cast("string").alias("text"))
    rows = pages.unionByName(blank).unionByName(none).na.drop(subset=["text"])
    return rows.filter(R.has_text(F.col("text"))).select(
        "page_id", F.length("text").cast("long").alias("chars"))


def dedup_first_wins(spark, sf):
    labelled = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    rows = labelled.select("source", F.col("doc_id").alias("row_ord"), "text", "lang",
                           F.coalesce("quality", F.lit(-1)).alias("label"))
    return R.first_rows(rows, ["text"], "row_ord", ["source"]).select(
        "source", "row_ord", "lang", "label")


def dedup_label_first(spark, sf):
    kept = R.drop_missing(rows_all(spark, sf)).filter(R.has_text(F.col("text")))
    return R.first_labelled(kept).select("source", "row_ord", "sentiment_value")


def dedup_large_order(spark, sf):
    """Orders near the ends of the 64-bit range, and negative ones."""
    order = F.when(F.col("doc_id") % 2 == 0, F.lit((1 << 62) + 5) + F.col("doc_id")).otherwise(
        F.lit(-(1 << 62)) - F.col("doc_id"))
    rows = R.drop_missing(rows_all(spark, sf).filter("source = 'documents'")).withColumnRenamed("row_ord", "doc_id")
    return R.first_labelled(rows.withColumn("row_ord", order)).select("source", "row_ord", "sentiment_value")


def source_specs(sf) -> list[SourceSpec]:
    """Four specifications: two tables, one path with nothing, one table without the column."""
    return [
        SourceSpec("talk", f"{sf}/conversations.parquet", "text", "role", "tri"),
        SourceSpec("nothing", f"{sf}/no-such-table.parquet"),
        SourceSpec("lacking", f"{sf}/benchmark.parquet", "text", "sentiment", "tri"),
        SourceSpec("labels", f"{sf}/labels.parquet", "toxic", "quality", "binary", order_col="doc_id"),
    ]


def read_sources_rows(spark, sf):
    rows, _ = read_sources(spark, source_specs(sf))
    return rows.select("source", "source_ord", "row_ord", "has_label", "sentiment_value",
                       F.length("text").cast("long").alias("chars"))


def read_sources_status(spark, sf):
    """What became of each specification, with the rows it gave."""
    rows, status = read_sources(spark, source_specs(sf))
    counts = rows.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    return status.join(counts, "source", "left").select(
        "source", "status", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def bad_row_files(spark, sf) -> list[SourceSpec]:
    """Labels as CSV and turns as JSON lines; every tenth label lacks fields or has too many, every seventh turn is cut."""
    folder, id = work_folder(spark), F.col("doc_id")
    fields = F.concat_ws(",", id, "quality", "toxic")
    line = F.when(id % 10 == 3, id.cast("string")).when(id % 10 == 7, F.concat(fields, F.lit(",more,fields"))).otherwise(fields)
    table(spark, sf, "labels").select(line.alias("value")).write.text(f"{folder}/labels")
    whole = F.to_json(F.struct("conv_id", "turn", "role", "text"))
    cut = F.when((F.col("conv_id") + F.col("turn")) % 7 == 0, F.substr(whole, F.lit(1), F.length(whole) - 3)).otherwise(whole)
    table(spark, sf, "conversations").select(cut.alias("value")).write.text(f"{folder}/turns")
    return [
        SourceSpec("labels", f"{folder}/labels", "toxic", "quality", "binary", "csv",
                   {"schema": "doc_id long, quality string, toxic string"}, order_col="doc_id"),
        SourceSpec("turns", f"{folder}/turns", "text", "role", "tri", "json",
                   {"schema": "conv_id long, turn long, role string, text string"}),
        SourceSpec("nothing", f"{folder}/nothing", fmt="csv"),
    ]


def read_sources_bad_rows(spark, sf):
    """Rows read and rows that can't be, by source."""
    rows, status = read_sources(spark, bad_row_files(spark, sf))
    counts = rows.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count_if("has_label").alias("labelled"))
    return status.join(counts, "source", "left").select(
        "source", "status", "bad_rows", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "labelled")])


def bad_records_kept(spark, sf):
    """The records that can't be read, whole."""
    return bad_records(spark, bad_row_files(spark, sf))


def junk_columns_dropped(spark, sf):
    """A table with columns that exports leave behind, read as a source."""
    path = f"{work_folder(spark)}/exported"
    table(spark, sf, "conversations").select(
        F.col("turn").alias("Unnamed: 0"), F.col("conv_id").alias("index"), "text", F.col("role").alias("label"),
        (F.col("conv_id") * 1000 + F.col("turn")).alias("place")).write.parquet(path)
    rows, _ = read_sources(spark, [SourceSpec("talk", path, "text", "label", "tri", order_col="place")])
    return rows.withColumn("columns", F.lit(",".join(rows.columns)))


# --- sinks -------------------------------------------------------------------

def plain_rows(spark, sf) -> DataFrame:
    """Labelled rows with their text as it is, for the sinks."""
    rows = R.drop_missing(rows_all(spark, sf)).filter("sentiment_value is not null")
    return rows.select("source", "source_ord", "row_ord", F.col("text").alias("cleaned_text"), "sentiment_value")


def sink_by_source(spark, sf):
    """All sources, then a run of two of them: one with other rows, one of which none is left; run twice."""
    path, rows = f"{work_folder(spark)}/clean", plain_rows(spark, sf)
    write_two_column(rows, path)
    again = rows.filter("source = 'conversations' and sentiment_value = 1.0")
    for _ in range(2):
        counts = write_sources(again, path, ["conversations", "benchmark"])
    said = spark.createDataFrame(list(counts.items()), "source string, written long")
    stored = read_cleaned(spark, path).groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("cleaned_text")).alias("chars"), F.sum("row_ord").alias("mark"))
    return stored.join(said, "source", "full").select(
        "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "chars", "mark")], "written")


def pruned_read(spark, sf):
    """The text column of a stored clean table, and where its rows come from; nothing else of it is read."""
    path = f"{work_folder(spark)}/clean"
    write_two_column(plain_rows(spark, sf), path)
    return read_cleaned(spark, path).groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("cleaned_text")).alias("chars"),
        F.max(F.length("cleaned_text")).alias("longest"))


def empty_guard(spark, sf):
    """Whether each source has a sentence to train on; of the last only blank ones are given."""
    rows, found = plain_rows(spark, sf), []
    for name in ("documents", "conversations", "benchmark", "nowhere"):
        sentences = rows.filter(F.col("source") == name)
        try:
            require_rows(sentences)
            found.append((name, True))
        except RuntimeError:
            found.append((name, False))
    return spark.createDataFrame(found, "source string, has_rows boolean")


def tuned_as_reported(spark, sf):
    """A trial of the sweep against the same fit and evaluation by hand, on the conversations."""
    talk = spread(table(spark, sf, "conversations"))
    cleaned = materialize(clean_text(talk.filter("text is not null")).select(
        F.col("role").alias("source"), F.lit(0).alias("source_ord"),
        (F.col("conv_id") * 1000 + F.col("turn")).alias("row_ord"), "cleaned_text"))
    top = K.vocabulary(K.token_counts(cleaned, ()), 3).orderBy(F.desc("cnt"), "word").limit(4).agg(
        F.sort_array(F.collect_list(F.struct(F.col("cnt") * -1, "word"))).alias("w"))
    pairs = top.select(F.explode(F.array(*[
        F.struct(F.lit(k).alias("kind"), F.get("w", i)["word"].alias("a"), F.get("w", i + 1)["word"].alias("b"))
        for k, i in (("syn", 0), ("ant", 2))])).alias("p")).select("p.*")
    params = {**TOY, "vector_size": 8, "min_count": 3}
    # Each fit is one task, so both run at once.
    with ThreadPoolExecutor(2) as both:
        sweep = both.submit(U.sweep, cleaned, pairs, [{"trial": 0, **params}], num_partitions=1)
        vectors = both.submit(train_word2vec, cleaned, params, num_partitions=1).result()
        tuned = sweep.result()
    reported = E.evaluate(vectors, K.token_counts(cleaned), pairs)
    same = [F.abs(F.col(f"t.{m}") - F.col(f"r.{m}")) < 1e-9 for m in ("syn_mean", "ant_mean", "separation", "coverage")]
    one = F.lit(1).alias("__one")
    return tuned.select("*", one).alias("t").join(reported.select("*", one).alias("r"), "__one").select(
        reduce(lambda a, b: a & b, same).alias("same"), F.round("r.coverage", 9).alias("coverage"))


def corpus_store(spark, sf):
    """The corpus written by domain, and of it the folder of one domain."""
    path = f"{work_folder(spark)}/corpus"
    lines = write_corpus(corpus_lines(rows_all(spark, sf, texts)), path, by_domain=True)
    return read_corpus(spark, path, "reviews").select("value", F.lit(lines).cast("long").alias("lines"))


def vector_store(spark, sf):
    """Vectors stored in buckets; pairs and coverage looked up in the stored table."""
    path = f"{work_folder(spark)}/model"
    save_bucketed(word_vectors(spark, sf), path, 8)
    vectors = load_bucketed(spark, path)
    counts = vectors.select(F.lit("all").alias("source"), F.concat("word", F.col("cnt")).alias("token"), F.col("cnt"))
    covered = C.macro_coverage(C.coverage(counts, vectors)).scalar()
    return S.pair_similarities(vectors, label_pairs(spark, sf)).select(
        "kind", "a", "b", F.round("cosine", 6).alias("cosine"), F.round(covered, 9).alias("coverage"))


def params_stored(spark, sf):
    """What is read of parameter files that lack keys, have others, or values of another type."""
    kind = F.col("label")
    body = F.concat(
        F.lit('{"vector_size": '), F.col("n"), F.lit(', "window": '), F.when(kind % 3 == 0, F.lit('"wide"')).otherwise((kind + 2).cast("string")),
        F.when(kind % 2 == 0, F.lit(', "min_count": null, "sample": 0.001')).otherwise(F.lit(', "sample": "much"')),
        F.when(kind % 4 == 1, F.lit(', "colour": [1, "red"]')).otherwise(F.lit("")), F.lit("}"))
    counts = table(spark, sf, "embeddings").groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    objects = counts.select("label", F.when(kind == 7, F.lit("no object")).otherwise(body).alias("value"))
    return check_params(objects)


def head_n_sentences(spark, sf):
    return R.head(rows_all(spark, sf), 700).select("source", "row_ord", "text")


# --- text rules --------------------------------------------------------------

def garbled(text: Column, times: int, page: str = "cp1252") -> Column:
    """The text's UTF-8 bytes read in a single-byte code page, so often."""
    for _ in range(times):
        latin = F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")
        text = F.translate(latin, "".join(map(chr, range(0x80, 0x100))), X.high_characters(page))
    return text


def encoding_round_trip(spark, sf):
    """Texts as they are, garbled once and twice, read back; every third of the garbled in the Turkish code page."""
    text, way = F.col("text"), F.col("doc_id") % 4
    bad = F.when(way == 1, garbled(text, 1)).when(way == 2, garbled(text, 2)).when(
        way == 3, garbled(text, 1, "cp1254")).otherwise(text)
    docs = texts(spark, sf, "documents").select("doc_id", "text", bad.alias("bad"))
    return docs.select("doc_id", (F.col("bad") != F.col("text")).alias("garbled"), X.read_back(F.col("bad")).alias("t"))


def sentence_marks(spark, sf):
    """Punctuation dropped but for sentence ends, squeezed, and the sentences that follow from it."""
    kept = X.squeeze_spaces(X.squeeze_punctuation(X.drop_punctuation(F.col("text"), keep_sentence_punct=True)))
    return docs(spark, sf).select("doc_id", kept.alias("t")).select(
        "doc_id", "t", F.size(X.split_sentences(F.col("t"))).cast("long").alias("sentences"))


def html_unescape(spark, sf):
    """Each page, which has markup, and on a line of its own a snippet, most of which have none."""
    html = F.concat_ws("\n", "html", pick(SNIPPETS, F.length("html")))
    return texts(spark, sf, "pages").select(
        "page_id", X.unescape_html(X.settle_entities(html)).alias("t"))


def html_url_email_tags(spark, sf):
    text = F.concat_ws(" ", "html", "url", pick(SNIPPETS, F.length("html")))
    tagged = X.tag_emails(X.tag_urls(X.strip_tags(text)))
    return texts(spark, sf, "pages").select("page_id", tagged.alias("t"))


def phone_number_tags(spark, sf):
    phones = docs(spark, sf).select("doc_id", X.tag_phones(F.col("text")).alias("phones"))
    return phones.withColumn("numbers", X.tag_numbers(F.col("phones")))


def squeeze_marks(spark, sf):
    text = F.col("text")
    return docs(spark, sf).select(
        "doc_id", X.squeeze_spaces(X.squeeze_punctuation(text)).alias("t"),
        X.drop_punctuation(text).alias("bare"))


def whitelist_tokens(spark, sf):
    return count_tokens(docs(spark, sf).select(F.explode(lower_tokens(F.col("text"))).alias("token")))


def repeat_collapse(spark, sf):
    token = F.explode(lower_tokens(F.col("text"))).alias("token")
    return count_tokens(
        docs(spark, sf).select(token).select(X.collapse_repeats(F.col("token")).alias("token")))


def deasciify_changes(spark, sf):
    tagged = docs(spark, sf).withColumn("domain", D.detect_domain(F.col("text")))
    return K.spelling_changes(tagged)


def negation_scope(spark, sf):
    words = X.join_tokens(lower_tokens(F.col("text")))
    return docs(spark, sf).select("doc_id", X.mark_negation(words).alias("t"))


def negation_toggle(spark, sf):
    # The words are a column of their own, so that they are taken once.
    words = docs(spark, sf).select(X.join_tokens(lower_tokens(F.col("text"))).alias("words"))
    both = words.select(F.explode(F.array(
        F.struct(F.lit(False).alias("on"), F.col("words").alias("t")),
        F.struct(F.lit(True).alias("on"), X.mark_negation(F.col("words")).alias("t")))).alias("b"))
    counts = K.token_counts(both.select("b.on", "b.t"), ("on",), "t")
    on = F.col("on")
    return counts.agg(
        F.count_if(~on).alias("words_off"), F.count_if(on).alias("words_on"),
        F.sum(F.when(on & F.col("token").endswith("_NEG"), F.col("cnt"))).alias("marked"))


def short_token_filter(spark, sf):
    kept = X.drop_short_tokens(lower_tokens(F.col("text")))
    return docs(spark, sf).select("doc_id", kept.alias("l")).select(
        "doc_id", X.join_tokens(F.col("l")).alias("t"), F.size("l").cast("long").alias("kept"))


def rating_tags(spark, sf):
    tagged = docs(spark, sf).withColumn("domain", D.detect_domain(F.col("text")))
    return tagged.select(
        "doc_id", "domain", D.domain_normalize(F.col("text"), F.col("domain")).alias("t"))


def domain_counts(spark, sf):
    tagged = docs(spark, sf).select("source", D.detect_domain(F.col("text")).alias("domain"))
    return tagged.groupBy("source", "domain").agg(F.count(F.lit(1)).alias("n"))


def sentence_split(spark, sf):
    protected = X.tag_emails(X.tag_urls(F.col("text")))
    sentence = docs(spark, sf).select("doc_id", F.explode(X.split_sentences(protected)).alias("s"))
    return sentence.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("sentences"), F.sum(F.length("s")).alias("chars"))


# --- labels ------------------------------------------------------------------

def label_binary(spark, sf):
    values = ["1", "0", "7", " 1 ", "1.0", "abc", "0_1", "+1", "-1", "_1"]
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return rows.select(
        "doc_id",
        L.sentiment_value(F.col("quality"), "binary", T.IntegerType()).alias("quality"),
        L.sentiment_value(pick(values, F.col("doc_id")), "binary", T.StringType()).alias("from_text"),
        L.sentiment_value(F.col("n_chars") / 1000, "binary", T.DoubleType()).alias("from_float"),
    )


def label_tri(spark, sf):
    names = ["Positive", "müsbət", "2", "neytral", "0", "bad", "1.0", "junk", " NEG ", "1"]
    return table(spark, sf, "documents").select(
        "doc_id",
        L.sentiment_value(pick(names, F.col("doc_id")), "tri", T.StringType()).alias("from_text"),
        L.sentiment_value(F.col("n_chars") % 4, "tri", T.LongType()).alias("from_int"),
        L.sentiment_value(F.col("n_chars") / 1, "tri", T.DoubleType()).alias("from_float"),
    )


# --- plans -------------------------------------------------------------------

def clean_two_column(spark, sf):
    return clean_rows(rows_all(spark, sf)).drop("source_ord")


def intended_clean(spark, sf):
    tagged = docs(spark, sf).withColumn("domain", D.detect_domain(F.col("text")))
    cleaned = clean_text(tagged, out="t", rules=INTENDED, domain="domain")
    return cleaned.select("doc_id", "domain", "t")


def rows_by_source(spark, sf):
    return row_counts(clean_rows(rows_all(spark, sf))).withColumnRenamed("rows", "n")


def corpus(spark, sf):
    return corpus_lines(rows_all(spark, sf, texts)).select("source", "row_ord", "domain", "value")


def corpus_domain_filter(spark, sf):
    return corpus_lines(rows_all(spark, sf, texts), domain="reviews").select("source", "row_ord", "value")


# --- tokens, vocabularies, coverage -------------------------------------------

def doc_counts(spark, sf, *by):
    """Token counts of the cleaned documents, stored: both the vocabulary and the groups are read from them."""
    return materialize(K.token_counts(clean_docs(spark, sf), by or ("source",)))


def vocab_min_count(spark, sf):
    return K.vocabulary(K.token_counts(clean_docs(spark, sf)), 3)


def coverage_by_source(spark, sf):
    counts = doc_counts(spark, sf)
    return C.coverage(counts, K.vocabulary(counts, 3))


def coverage_by_domain(spark, sf):
    counts = doc_counts(spark, sf, "source", "domain")
    return C.coverage(counts, K.vocabulary(counts, 3), ("source", "domain"))


def coverage_macro(spark, sf):
    covered = C.macro_coverage(coverage_by_source(spark, sf))
    return covered.select(F.round("coverage", 9).alias("coverage"))


def coverage_empty_source(spark, sf):
    """A source without tokens counts as 0 in the mean."""
    all_counts = doc_counts(spark, sf)
    counts = all_counts.filter("source <> 'src1'")
    groups = table(spark, sf, "documents").select("source").distinct()
    record = E.evaluate(word_vectors(spark, sf), counts, label_pairs(spark, sf), K.vocabulary(counts, 3), groups)
    return rounded(record, "syn_mean", "ant_mean", "separation", "coverage")


def stopword_candidates(spark, sf):
    return K.stopword_candidates(clean_docs(spark, sf)).select(
        "lang", "token", "docs", F.col("rank").cast("long").alias("rank"))


def stopword_comparison(spark, sf):
    compared = K.compare_stopwords(K.stopword_candidates(clean_docs(spark, sf)))
    return compared.withColumn("best_rank", F.col("best_rank").cast("long"))


def subsample_tokens(spark, sf):
    # Places are ints, whose product would overflow from the 20,506th word of a text on.
    draw = (F.col("doc_id") * 7919 + F.col("pos").cast("long") * 104729) % 1000003 / F.lit(1000003.0)
    cleaned = materialize(clean_docs(spark, sf).select("doc_id", "cleaned_text"))
    kept = K.subsample_tokens(cleaned, K.token_counts(cleaned, ()), 0.001, draw=draw)
    return kept.groupBy("token").agg(
        F.count(F.lit(1)).alias("kept"), F.sum(F.col("doc_id") * 31 + F.col("pos")).alias("mark"))


# --- vectors -----------------------------------------------------------------

def word_vectors(spark, sf):
    """The given embeddings as a word table."""
    return table(spark, sf, "embeddings").select(
        F.concat(F.lit("w"), F.col("vec_id")).alias("word"), F.col("embedding").alias("vector"),
        (1 + F.col("vec_id") % 7).alias("cnt"), "label", "vec_id")


def label_pairs(spark, sf):
    """Each vector with its successor; the same label makes a synonym."""
    here = table(spark, sf, "embeddings").select("vec_id", "label")
    after = here.select((F.col("vec_id") - 1).alias("vec_id"), F.col("label").alias("next"))
    same = F.coalesce(F.col("label") == F.col("next"), F.lit(True))
    return here.join(after, "vec_id", "left").select(
        F.when(same, "syn").otherwise("ant").alias("kind"),
        F.concat(F.lit("w"), F.col("vec_id")).alias("a"),
        F.concat(F.lit("w"), F.col("vec_id") + 1).alias("b"))


def pair_cosine(spark, sf):
    found = S.pair_similarities(word_vectors(spark, sf), label_pairs(spark, sf))
    return found.select("kind", "a", "b", F.round("cosine", 6).alias("cosine"))


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def separation_score(spark, sf):
    found = S.pair_similarities(word_vectors(spark, sf), label_pairs(spark, sf))
    return rounded(S.pair_means(found), "syn_mean", "ant_mean", "separation")


def knn_top5(spark, sf):
    """Seeds: the first vector of each label, and one word without a vector."""
    given = table(spark, sf, "embeddings")
    seeds = given.groupBy("label").agg(F.min("vec_id").alias("id")).select("id").union(
        given.agg(F.max("vec_id") + 1)).select(F.concat(F.lit("w"), F.col("id")).alias("word"))
    found = S.nearest_neighbours(word_vectors(spark, sf), seeds, 5)
    return seeds.select(F.col("word").alias("seed")).join(found, "seed", "left").select(
        "seed", F.coalesce(F.col("rank"), F.lit(0)).cast("long").alias("rank"),
        F.coalesce("word", F.lit("")).alias("word"), F.round("cosine", 6).alias("cosine"))


def model_neighbours(spark, sf):
    """Neighbours of the first vector of each label and of an unknown word, in both models."""
    given, vectors = table(spark, sf, "embeddings"), word_vectors(spark, sf)
    seeds = given.groupBy("label").agg(F.min("vec_id").alias("id")).select("id").union(
        given.agg(F.max("vec_id") + 1)).select(F.concat(F.lit("w"), F.col("id")).alias("word"))
    found = neighbour_report(vectors.select("word", "vector", "cnt"), vectors.select("word", "vector", "cnt"), seeds)
    return found.withColumn("neighbours", F.array_join("neighbours", " "))


def half_vectors(spark, sf) -> DataFrame:
    """The given vectors with the latter half of their components turned round, as another model."""
    half = F.transform("vector", lambda x, i: F.when(i < 32, x).otherwise(-x).cast("float"))
    shuffled = F.concat(F.slice(half, 33, 32), F.slice(half, 1, 16), F.array_repeat(F.lit(0.0).cast("float"), 16))
    return word_vectors(spark, sf).withColumn("vector", shuffled)


def negation_neighbours(spark, sf):
    """Neighbours of every tenth word in two models, and how many they share."""
    vectors = word_vectors(spark, sf)
    seeds = vectors.filter("vec_id % 10 = 0").select("word").union(
        table(spark, sf, "embeddings").select(F.concat(F.lit("w"), F.max("vec_id") + 1)))
    found = G.negation_overlap(vectors, half_vectors(spark, sf), seeds, 5)
    return found.select("seed", "shared", F.round("overlap", 9).alias("overlap"))


def neighbours_all(spark, sf):
    """The nearest other word of every word."""
    vectors = word_vectors(spark, sf)
    found = S.nearest_neighbours(vectors, vectors, 1)
    return found.select("seed", "word", F.round("cosine", 6).alias("cosine"))


def evaluate_subwords(spark, sf):
    """Pairs of known and unknown words; the latter's vectors come from hashed n-grams."""
    vectors = word_vectors(spark, sf)
    pairs = label_pairs(spark, sf).withColumn(
        "b", F.when(F.substr("b", F.length("b"), F.lit(1)) == "3", F.concat("b", F.lit("x"))).otherwise(F.col("b")))
    counts = vectors.select(F.col("label").cast("string").alias("source"), F.concat(
        "word", F.when(F.col("vec_id") % 5 == 0, "x").otherwise("")).alias("token"), F.col("cnt"))
    record = E.evaluate_subwords(vectors, counts, pairs, buckets=3000)
    return rounded(record, "syn_mean", "ant_mean", "separation", "coverage")


def subword_membership(spark, sf):
    """Which words are in the vocabulary, and which have a vector through hashed n-grams."""
    vectors = word_vectors(spark, sf)
    words = vectors.select("word").union(vectors.select(F.concat("word", F.lit("x")))).union(
        vectors.select(F.concat(F.lit("q"), F.repeat(F.lit("z"), F.col("cnt").cast("int")))))
    return B.membership(B.subword_vectors(vectors, words, 3, 6, 3000), words)


def bucket_table(spark, sf):
    return vector_sums(B.bucket_vectors(word_vectors(spark, sf), 3000))


def vector_sums(df: DataFrame) -> DataFrame:
    v = F.col("vector")
    total = F.aggregate(v, F.lit(0.0), lambda t, x: t + x)
    moment = F.aggregate(
        F.transform(v, lambda x, i: x * (i + 1)), F.lit(0.0), lambda t, x: t + x)
    length = F.sqrt(F.aggregate(v, F.lit(0.0), lambda t, x: t + x * x))
    return df.withColumns({
        "total": F.round(total, 6), "length": F.round(length, 6), "moment": F.round(moment, 5),
    }).drop("vector")


def ngram_table(spark, sf):
    return vector_sums(B.ngram_vectors(word_vectors(spark, sf)))


def subword_oov(spark, sf):
    vectors = word_vectors(spark, sf)
    doubled = vectors.select(F.concat("word", F.col("vec_id")).alias("word"))
    unknown = doubled.join(vectors.select("word"), "word", "left_anti")
    return vector_sums(B.word_vectors_from(B.ngram_vectors(vectors), unknown))


def evaluation_record(spark, sf):
    counts = doc_counts(spark, sf)
    record = E.evaluate(
        word_vectors(spark, sf), counts, label_pairs(spark, sf), K.vocabulary(counts, 3))
    return rounded(record, "syn_mean", "ant_mean", "separation", "coverage")


def best_trial(spark, sf):
    """Trials that keep a quarter, half, three quarters or all of each vector's components."""
    pairs = label_pairs(spark, sf)
    trial = F.explode(F.sequence(F.lit(0), F.lit(3))).alias("trial")
    size = F.ceil(F.size("vector") * (F.col("trial") + 1) / 4).cast("int").alias("vector_size")
    vectors = word_vectors(spark, sf)
    cut = vectors.select("word", "vector", trial).select("word", "vector", "trial", size)
    sizes = cut.select("trial", "vector_size").distinct()
    found = S.pair_similarities(
        cut.select(F.concat_ws("@", "word", "trial").alias("word"), "trial", "vector_size",
                   F.slice("vector", 1, F.col("vector_size")).alias("vector")),
        pairs.join(sizes).select("kind", "trial", "vector_size", F.concat_ws("@", "a", "trial").alias("a"),
                                 F.concat_ws("@", "b", "trial").alias("b")))
    means = S.pair_means(found, "trial", "vector_size")
    counts = pairs.select(F.lit("pairs").alias("source"), F.col("b").alias("token"),
                          F.lit(1).alias("cnt"))
    covered = C.macro_coverage(C.coverage(counts, vectors)).scalar()
    trials = means.withColumn("score", E.score(F.col("separation"), covered))
    return rounded(E.best_trial(trials, "vector_size"), "score")


def model_compare(spark, sf):
    """Given vectors against vectors composed from n-grams, same evaluation."""
    vectors, pairs = word_vectors(spark, sf), label_pairs(spark, sf)
    composed = B.word_vectors_from(B.ngram_vectors(vectors), vectors)
    successor = F.concat(F.lit("w"), F.col("vec_id") + 1)
    counts = vectors.select(
        F.col("label").cast("string").alias("source"), successor.alias("token"),
        F.lit(1).alias("cnt"))
    metrics = []
    for name, model in (("plain", vectors), ("subword", composed)):
        metrics.append(E.model_metrics(name, E.evaluate(model, counts, pairs, vectors)))
        metrics.append(E.source_metrics(name, counts, vectors))
    return rounded(E.compare_models(metrics, ["plain", "subword"]), "plain", "subword")


# --- training ------------------------------------------------------------------

TOY = dict(vector_size=32, window=3, min_count=5, epochs=1, seed=42, sample=None)


def word2vec_vectors(spark, sf):
    cleaned = materialize(clean_docs(spark, sf).select("cleaned_text"))
    vectors = train_word2vec(cleaned, TOY, num_partitions=8)
    return vectors.select("word", F.size("vector").alias("size"), "cnt")


def word2vec_thinned(spark, sf):
    """Frequent words thinned by built-in functions; the vocabulary is that of the whole texts."""
    cleaned = materialize(clean_docs(spark, sf).select("cleaned_text"))
    vectors = train_word2vec(cleaned, {**TOY, "vector_size": 8, "min_count": 20, "sample": 0.001}, num_partitions=8)
    return vectors.select("word", F.size("vector").alias("size"), "cnt")


def param_sweep(spark, sf):
    """Two trials over all documents, one of them thinned; pairs are the commonest words."""
    cleaned = materialize(clean_docs(spark, sf)).select(
        F.lit(0).alias("source_ord"), F.col("doc_id").alias("row_ord"), "source", "cleaned_text")
    counts = K.vocabulary(K.token_counts(cleaned, ()), 5)
    top = counts.orderBy(F.desc("cnt"), "word").limit(8).agg(
        F.sort_array(F.collect_list(F.struct(F.col("cnt") * -1, "word"))).alias("w"))
    pairs = top.select(F.explode(F.array(*[
        F.struct(F.lit("syn" if i % 2 == 0 else "ant").alias("kind"), F.get("w", 2 * i)["word"].alias("a"),
                 F.get("w", 2 * i + 1)["word"].alias("b")) for i in range(4)])).alias("p")).select("p.*")
    trials = [{"trial": i, **TOY, "window": 2 + 2 * i, "sample": (None, 0.001)[i]} for i in range(2)]
    return U.sweep(cleaned, pairs, trials, num_partitions=8).select(
        "trial", "window", "vector_size", F.round("coverage", 9).alias("coverage"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "union_sources": union_sources,
        "drop_blank": drop_blank,
        "dedup_first_wins": dedup_first_wins,
        "dedup_label_first": dedup_label_first,
        "dedup_large_order": dedup_large_order,
        "read_sources_rows": read_sources_rows,
        "read_sources_status": read_sources_status,
        "read_sources_bad_rows": read_sources_bad_rows,
        "bad_records": bad_records_kept,
        "junk_columns": junk_columns_dropped,
        "sink_by_source": sink_by_source,
        "pruned_read": pruned_read,
        "empty_guard": empty_guard,
        "tuned_as_reported": tuned_as_reported,
        "corpus_store": corpus_store,
        "vector_store": vector_store,
        "params_report": params_stored,
        "head_n_sentences": head_n_sentences,
        "encoding_round_trip": encoding_round_trip,
        "sentence_marks": sentence_marks,
        "emoji_tags": doc_rule(X.map_emoji),
        "mojibake_repair": doc_rule(X.repair_encoding),
        "html_unescape": html_unescape,
        "html_url_email_tags": html_url_email_tags,
        "phone_number_tags": phone_number_tags,
        "mention_tags": doc_rule(X.tag_mentions),
        "hashtag_split": doc_rule(X.split_hashtags),
        "lower_az": doc_rule(X.lower_az),
        "squeeze_marks": squeeze_marks,
        "whitelist_tokens": whitelist_tokens,
        "repeat_collapse": repeat_collapse,
        "deasciify_changes": deasciify_changes,
        "negation_scope": negation_scope,
        "negation_toggle": negation_toggle,
        "short_token_filter": short_token_filter,
        "rating_tags": rating_tags,
        "domain_counts": domain_counts,
        "sentence_split": sentence_split,
        "label_binary": label_binary,
        "label_tri": label_tri,
        "clean_two_column": clean_two_column,
        "intended_clean": intended_clean,
        "row_counts": rows_by_source,
        "corpus_lines": corpus,
        "corpus_domain_filter": corpus_domain_filter,
        "vocab_min_count": vocab_min_count,
        "coverage_by_source": coverage_by_source,
        "coverage_by_domain": coverage_by_domain,
        "coverage_macro": coverage_macro,
        "coverage_empty_source": coverage_empty_source,
        "stopword_candidates": stopword_candidates,
        "stopword_comparison": stopword_comparison,
        "model_neighbours": model_neighbours,
        "neighbours_all": neighbours_all,
        "negation_neighbours": negation_neighbours,
        "evaluate_subwords": evaluate_subwords,
        "subword_membership": subword_membership,
        "bucket_table": bucket_table,
        "subsample_tokens": subsample_tokens,
        "pair_cosine": pair_cosine,
        "separation_score": separation_score,
        "knn_top5": knn_top5,
        "ngram_table": ngram_table,
        "subword_oov": subword_oov,
        "evaluation_record": evaluation_record,
        "best_trial": best_trial,
        "model_compare": model_compare,
        "word2vec_vectors": word2vec_vectors,
        "word2vec_thinned": word2vec_thinned,
        "param_sweep": param_sweep,
    }
