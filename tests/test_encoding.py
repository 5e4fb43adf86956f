"""Misread UTF-8 read back, and nested character references, in time that grows with the text."""

import html
import time

import pytest
from pyspark.sql import functions as F

from sozmill.functions import encoding as E, text as X
from sozmill.operators.normalize import clean_text


def garble(text, page, times=1):
    high = E.high_characters(page)
    for _ in range(times):
        text = "".join(chr(b) if b < 128 else high[b - 128] for b in text.encode())
    return text


def read_back(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "n int, t string").repartition(4)
    rows = df.select("n", E.read_back(F.col("t")).alias("r")).collect()
    return [r.r for r in sorted(rows, key=lambda r: r.n)]


@pytest.mark.parametrize("page", E.CODE_PAGES)
@pytest.mark.parametrize("times", [1, 2])
def test_every_letter(spark, page, times):
    want = [f"x {chr(c)} y" for c in range(0xA0, 0x250)]
    assert read_back(spark, [garble(t, page, times) for t in want]) == want


def test_texts(spark):
    want = ["Привет, мир", "yaxşı gözəl əla ĞÜŞİÖÇ", "日本語 テキスト", "naïve café €5", "größer – “quoted”", "emoji 😊 ok",
            "one line\nzwei Wörter\n\nşəhər"]
    for page in E.CODE_PAGES:
        assert read_back(spark, [garble(t, page, n) for t in want for n in (1, 2, 3)]) == [
            t for t in want for _ in range(3)]


def test_only_misread_lines_change(spark):
    good = ["", "plain", "naïve café", "Ünlü Çağrı Şişli", "Année 2000 déjà vu", "price £5 ±3 ©2020", "Привет Рим",
            "ÁÉÍÓÚ Ñ ¿qué?", "le CAFÉ»", "un ÉTÉ® à", "fÊª",  "«Москва» №5", "İŞ °C", "ÀÉ®", "Ã", "Â£5 é"]
    assert read_back(spark, good) == good
    assert read_back(spark, ["café\n" + garble("şəhər", "cp1252"), None]) == ["café\nşəhər", None]


def test_chain_and_rule_agree(spark):
    texts = [garble("Müsəlman ağac çörək", "cp1254"), "gÃ¼n and şa " + garble("çə", "cp1252"), garble("ﬁlm ＡＢ", "cp1252")]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    rows = clean_text(df).select("cleaned_text", X.normalize(F.col("text")).alias("n")).collect()
    assert [r.cleaned_text for r in rows] == [r.n for r in rows] == ["müsəlman ağac çörək", "gün and şa çə", "film ab"]
    plan = clean_text(df)._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEval" not in plan and "MapIn" not in plan and "BatchEvalPython" not in plan


def test_one_long_line_takes_little_time(spark):
    """A hundred thousand misread letters on a line, and 200 kB of references."""
    text = "ş" * 100_000
    start = time.perf_counter()
    assert read_back(spark, [garble(text, "cp1252", 2)]) == [text]
    assert time.perf_counter() - start < 20

    def settled(value):
        df = spark.createDataFrame([(value,)], "t string").coalesce(1)
        begun = time.perf_counter()
        out = df.select(X.settle_entities(F.col("t")).alias("t")).first().t
        return out, time.perf_counter() - begun

    settled("warm &amp; up " * 500)
    for value in ("salt &amp; pepper " * 12_000, "&amp;" * 40_000, "&" * 200_000, "&" + "amp;" * 300 + "lt;"):
        out, seconds = settled(value)
        want = html.unescape(value)
        while want != html.unescape(want):
            want = html.unescape(want)
        assert out == want and seconds < 5


def test_references_in_references(spark):
    texts = ["&amp;amp;amp;lt;x", "&am&#112;; x", "a & b &copy;", "&#38;#38;lt;", "<b>&amp;amp;</b>", "&amp;lt;\n<i>&amp;lt;"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.t for r in df.select(X.settle_entities(F.col("t")).alias("t")).collect()]
    assert got == ["<x", "& x", "a & b ©", "<", "<b>&amp;amp;</b>", "<\n<i>&amp;lt;"]


def seconds(df):
    begun = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begun


def test_plain_letters_are_passed_over(spark):
    """The search for misread letters takes little more than one for a simple class; it took ten times as long."""
    text = F.repeat(F.lit("a long line of plain text with one şə of its own and no other " * 20), 400)
    df = spark.range(16).select(F.concat(text, F.col("id").cast("string")).alias("t")).repartition(4).cache()
    df.count()
    search, plain = df.select(E.may_be_misread(F.col("t"))), df.select(F.col("t").rlike(r"[^\x00-\x{FFFF}]"))
    for found in (search, plain):
        seconds(found)
    assert min(seconds(search) for _ in range(3)) < 5 * min(seconds(plain) for _ in range(3)) + 0.1


def test_repair_computes_its_chain_once(spark):
    df = spark.createDataFrame([("x",)], "t string").select(X.repair_encoding(F.col("t")).alias("t"))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("translate(") <= 1 + len(E.CODE_PAGES)


def test_what_stands_before_a_reference(spark):
    df = spark.createDataFrame([("amp;x &amp;amp;lt; y\nə &am&amp;p;",)], "t string")
    assert df.select(X.settle_entities(F.col("t")).alias("t")).first().t == "amp;x < y\nə &am&p;"
