"""One check for each text rule, and the fixture rows in both modes."""

import html
import random
import re
import unicodedata
from html.entities import html5

import pytest
from pyspark.sql import functions as F

from sozmill.functions import domain as D, text as X
from sozmill.functions.rules import INTENDED, OBSERVED, RulePack
from sozmill.operators.normalize import clean_sentences, clean_text

GOLDEN = [
    # input, domain, observed, intended
    ("Yaxsi idi amma qiymet cox baha idi :((", "general",
     "yaxşı idi amma qiymet çox baha idi", "yaxşı idi amma qiymet çox baha idi"),
    ("#QarabagIsBack", "social", "qarabag ıs back", "qarabag is back"),
    ("Bu məhsul çox yaxşı, 5 ulduz! 20 azn", "reviews",
     "bu məhsul <RATING_POS> <NUM> ulduz <NUM> azn",
     "bu məhsul <RATING_POS> <STARS_5> <PRICE>"),
    ("Bu yaxşı deyil o çox baha 3 dəfə", "general",
     "bu yaxşı deyil o_NEG çox_NEG baha_NEG <NUM> dəfə",
     "bu yaxşı deyil o_NEG çox_NEG baha_NEG <NUM> dəfə"),
    ("yox 5 a b c d", "general", "yox <NUM> a_NEG b_NEG c_NEG", "yox <NUM> a_NEG b_NEG c_NEG"),
    ("əla 😊", "general", "əla", "əla <EMO_POS>"),
    ("😊", "general", "", "<EMO_POS>"),
    ("mail me: a.b@x.az www.site.az +994 50 123 45 67 @ali IŞIQ", "social",
     "mail me emaıl url phone user ışıq", "mail me <EMAIL> <URL> <PHONE> <USER> ışıq"),
    ("COOOOL tmm!!! rt", "social", "cool tamam rt", "cool tamam rt"),
    ("Sabah apa bildirib ki #ok", "news", "sabah apa bildirib ki ok", "sabah apa bildirib ki ok"),
    ("heç heç bir iki üç dörd", "general",
     "heç heç bir_NEG iki_NEG üç_NEG dörd", "heç heç bir_NEG iki_NEG üç_NEG dörd"),
    ("#yaxşı gün", "social", "yax şı gün", "yaxşı gün"),
    ("1 2 3 4 ədəd", "general", "phone ədəd", "<PHONE> ədəd"),
    ("12345678", "general", "phone", "<PHONE>"),
    ("<b>Salam</b> &amp; sagol", "general", "salam sağol", "salam sağol"),
    ("Qiymət. Gəldi! Getdi?", "reviews", "qiymət gəldi getdi", "qiymət gəldi getdi"),
    ("a o e x", "general", "o e", "o e"),
]


def one(spark, value, rule):
    df = spark.createDataFrame([(value,)], "t string")
    return df.select(rule(F.col("t")).alias("r")).first().r


def many(spark, values, rule):
    df = spark.createDataFrame(list(enumerate(values)), "n int, t string")
    rows = df.select("n", rule(F.col("t")).alias("r")).collect()
    return [r.r for r in sorted(rows, key=lambda r: r.n)]


def test_golden_rows(spark):
    df = spark.createDataFrame([(i, g[0]) for i, g in enumerate(GOLDEN)], "n int, text string")
    df = df.withColumn("domain", D.detect_domain(F.col("text")))
    df = clean_text(df, domain="domain")
    df = clean_text(df, out="meant", rules=INTENDED, domain="domain")
    for row in df.collect():
        text, domain, observed, intended = GOLDEN[row.n]
        assert (row.domain, row.cleaned_text, row.meant) == (domain, observed, intended), text


def token_chain(text, rules=OBSERVED):
    """The observed chain from the public rules, on arrays of tokens."""
    text = X.repair_encoding(X.map_emoji(X.sweep_tag_chars(text), rules))
    text = X.strip_tags(X.unescape_html(text))
    text = X.tag_mentions(X.tag_phones(X.tag_emails(X.tag_urls(text))))
    text = X.lower_az(X.split_hashtags(text))
    text = X.squeeze_spaces(X.drop_punctuation(X.tag_numbers(X.squeeze_punctuation(text)), True))
    tokens = F.transform(
        X.extract_tokens(text), lambda t: X.fix_spelling(X.collapse_repeats(t), rules))
    marked = F.split(X.mark_negation(X.join_tokens(tokens), rules), " ")
    return X.join_tokens(X.drop_short_tokens(marked, rules))


PARTS = [
    "yox", "heç", "deyil", "yoxdur", "qətiyyən", "a", "o", "e", "x", "5", "12", "3-4-5-6-7-8",
    "tmm", "cox", "cox", "yaxsi", "sim", "Sagol", "IŞIQ", "İsti", "çox yaxşı", "çoooox", "aaab",
    "#BuGünGəl", "#aBcD_eF", "##x", "@ali", "@@", "a@b.c", "x.y-z@q.az.", ".@a.b", "é", "é",
    "ı", "ß", "ſ", "<b>", "</b>", "<", ">", "< 😊 x >", "😊", "😡", "👍", "&amp;", "&lt;b&gt;",
    "&#x301;", "&nbsp;", "&", "&copy", "&notit;", "&#304;", "www.a.b", "WwW.x", "https://a/b?c#D",
    "HTTP://Q", "http://", "+994 50 123 45 67", "(012) 345-67-89", "1 2 3 4", "\t", "\n\n", "  ",
    "_", "a_b", "'", "!!!", "...", ",", "snake_case", "١٢", "日本", "🙂", " ", " ",
]


def random_texts(count=1500, seed=5):
    rng = random.Random(seed)
    return [
        "".join(rng.choice(PARTS) + rng.choice([" ", " ", " ", ""])
                for _ in range(rng.randint(0, 14)))
        for _ in range(count)
    ]


def test_chain_three_ways(spark):
    texts = random_texts() + ["ÉÄ Åland É™", "x" + chr(0xE000) + "y" + chr(0xE010) + "z", "a\x07b"]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, text string")
    df = clean_text(df).withColumn("whole", X.normalize(F.col("text")))
    df = df.withColumn("tokens", token_chain(F.col("text")))
    for row in df.collect():
        assert row.cleaned_text == row.tokens, repr(texts[row.n])
        assert row.whole == row.tokens, repr(texts[row.n])


def test_chain_with_other_rules(spark):
    rules = RulePack(
        negators=("no", "never"), negation_scope=2, kept_short_tokens=("a",),
        spelling={"cox": "sim", "sim": "salam"},
    )
    texts = [t.replace("heç", "never").replace("yox", "no") for t in random_texts(400, 9)]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, text string")
    df = clean_text(df, rules=rules).withColumn("tokens", token_chain(F.col("text"), rules))
    for row in df.collect():
        assert row.cleaned_text == row.tokens, repr(texts[row.n])


def test_negation_and_number_toggles(spark):
    df = spark.createDataFrame([("yox 5 alma var",)], "text string")
    off = clean_text(df, rules=RulePack(negation=False)).first().cleaned_text
    assert off == "yox <NUM> alma var"
    bare = clean_text(df, rules=RulePack(numbers_to_token=False)).first().cleaned_text
    assert bare == "yox alma_NEG var_NEG"


def test_output_properties(spark):
    rows = clean_text(
        spark.createDataFrame([(t,) for t in random_texts(500, 11)], "text string")
    ).collect()
    token = re.compile("^(?:<NUM>|[a-zəğıöüçş]+(?:_NEG)?)$")
    for row in rows:
        run = 0
        for t in row.cleaned_text.split():
            assert token.match(t), t
            run = run + 1 if t.endswith("_NEG") else (run if t == "<NUM>" else 0)
            assert run <= 3
        assert row.cleaned_text == " ".join(row.cleaned_text.split())


def test_null_text_is_empty(spark):
    df = spark.createDataFrame([(None,)], "text string")
    assert clean_text(df).first().cleaned_text == ""
    assert df.select(D.detect_domain(F.col("text"))).first()[0] == "general"


def test_unescape_all_names(spark):
    names = ["&" + n for n in html5] + ["&" + n.rstrip(";") + "zq;" for n in html5]
    got = many(spark, names, X.unescape_html)
    assert [g for g, n in zip(got, names) if g != html.unescape(n)] == []


def test_unescape_numbers_and_oddities(spark):
    codes = [0, 1, 8, 9, 11, 13, 31, 32, 65, 127, 128, 129, 150, 159, 160, 304, 0xD800, 0xDFFF,
             0xFDD0, 0xFFFE, 0xFFFF, 0x1F600, 0x1FFFF, 0x10FFFD, 0x10FFFF, 0x110000, 10**12]
    texts = [f"a&#{c};b" for c in codes] + [f"a&#x{c:x}b g" for c in codes]
    texts += [f"&#0000{c};" for c in codes]
    texts += ["&", "&&", "&;", "& amp;", "&amp", "&ampx", "&AMP;lt;", "&#;", "&#x;", "&#xg", "",
              "&lt;&gt;", "x&notin;y", "&notinx", "&nosuchthing;", "&" + "a" * 40 + ";", "&#38;lt;"]
    got = many(spark, texts, X.unescape_html)
    for g, t in zip(got, texts):
        assert g == html.unescape(t), t


def test_nfc_is_canonical_composition(spark):
    rng = random.Random(3)
    marks = [chr(c) for c in range(0x300, 0x345)]
    texts = ["".join(rng.choice("aeIsgcou") + rng.choice(marks) * rng.randint(0, 2)
                     for _ in range(6)) for _ in range(300)]
    texts += ["Å", "각", "̈́", "q̣̇"]
    assert many(spark, texts, X.nfc) == [unicodedata.normalize("NFC", t) for t in texts]


def test_repair_encoding(spark):
    for letter in "ÜüÖöÇçĞğıİŞşƏə":
        wrong = "".join(
            bytes([b]).decode("cp1252", "ignore") or chr(b) for b in letter.encode("utf-8"))
        assert one(spark, f"a{wrong}b", X.repair_encoding) == f"a{letter}b"
    assert one(spark, "ｆｕｌｌ　ﬁn\x07e", X.repair_encoding) == "full fine"
    df = spark.createDataFrame([("yaxÅŸÄ± ﬁlm ＡＢ",)], "text string")
    assert clean_text(df).first().cleaned_text == "yaxşı film ab"


@pytest.mark.parametrize("rule, text, expected", [
    (X.map_emoji, "a😊b😡", "a <EMO_POS> b <EMO_NEG> "),
    (X.strip_tags, "a<br\n>b <> c", "a b <> c"),
    (X.tag_urls, "x HTTPS://A.b/c d www.e", "x  <URL>  d  <URL> "),
    (X.tag_emails, "to ab.c@d-e.az.", "to  <EMAIL> ."),
    (X.tag_phones, "12345 1234567 +99", " <PHONE>  +99"),
    (X.tag_mentions, "@əli x", " <USER>  x"),
    (X.split_hashtags, "#QarabagIsBack!", " Qarabag Is Back !"),
    (X.split_hashtags, "#Abş", " Ab ş"),
    (X.lower_az, "IİŞÇ İ", "ıişç i"),
    (X.squeeze_punctuation, "a!!! b.. ?!", "a! b. ?!"),
    (X.squeeze_spaces, " a \t  b\n", "a b"),
    (X.tag_numbers, "a12b", "a <NUM> b"),
    (X.drop_punctuation, "a,b.<c>'_é!", "a b <c>'_é "),
    (lambda c: X.drop_punctuation(c, True), "a,b.!?", "a b.!?"),
    (X.extract_tokens, "salam_x <NUM> 'é <FOO>", ["salam", "x", "<NUM>", "FOO"]),
    (X.collapse_repeats, "cooool aa 111", "cool aa 11"),
    (X.fix_spelling, "cox", "çox"),
    (X.fix_spelling, "alma", "alma"),
    (X.mark_negation, "a yox <NUM> b c d e yox", "a yox <NUM> b_NEG c_NEG d_NEG e yox"),
    (X.split_sentences, "bir. iki!? üç ", ["bir", "iki", "üç"]),
    (X.whitespace_tokens, "  a b c ", ["a", "b", "c"]),
    (lambda c: X.join_tokens(X.drop_short_tokens(F.split(c, " "))), "a bc o x e", "bc o e"),
    (lambda c: X.corpus_line(F.lit("news"), c), "Bu, <NUM> X_NEG", "domnews bu <num> x_neg"),
    (lambda c: X.corpus_line(F.lit("news"), c), " . ", None),
    (D.normalize_review, "çox yaxşı 5 ulduz 20 AZN çox pis çox yaxşı_NEG",
     "<RATING_POS> <STARS_5> <PRICE> <RATING_NEG> çox yaxşı_NEG"),
])
def test_single_rules(spark, rule, text, expected):
    assert one(spark, text, rule) == expected


def test_hashtags_intended(spark):
    def rule(c):
        return X.split_hashtags(c, INTENDED)
    assert one(spark, "#QarabagIsBack #YaxşıIşıq #Ib", rule).split() == [
        "Qarabag", "is", "Back", "Yaxşı", "Işıq", "ib"]


def test_domains(spark):
    cases = {
        "Reuters xəbəri": "news", "trend @x": "news", "trendy": "general", "RT bu": "social",
        "art": "general", "a#b": "social", "20 AZN": "reviews", "aldim": "reviews",
        "ALDIM": "reviews", "manatlıq": "general", "Çox Yaxşı": "reviews", "": "general",
        "reuter" + chr(0x17F): "news",
    }
    assert many(spark, list(cases), D.detect_domain) == list(cases.values())


def test_sentences(spark):
    df = spark.createDataFrame(
        [(1, "Bax www.a.az/x.y ! Saytı. a.b@c.az yaz! Yox. Gəl"), (2, "..."), (3, None)],
        "id int, text string")
    rows = clean_sentences(df, rules=INTENDED).orderBy("id", "sent_ord").collect()
    assert [r.sentence for r in rows] == ["bax <URL>", "saytı", "<EMAIL> yaz", "yox", "gəl"]
    rows = clean_sentences(df).collect()
    assert [(r.id, r.sent_ord) for r in rows] == [(1, 0)]
