"""DuckDB SQL for every query that SQL can express.

The SQL is written on its own terms: tokens are unnested and negation uses
windows, where the Spark side works on strings.
"""

from __future__ import annotations

from ..functions import rules as R
from .snippets import SNIPPETS

W, S, D = R.WORD, R.SPACE, R.DIGIT
LETTERS = R.TOKEN_LETTERS


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def array(items) -> str:
    return "[" + ", ".join(q(i) for i in items) + "]"


def sub(expr: str, pattern: str, to: str = " ") -> str:
    return f"regexp_replace({expr}, {q(pattern)}, {q(to)}, 'g')"


def replace_all(expr: str, pairs) -> str:
    for a, b in pairs:
        expr = f"replace({expr}, {q(a)}, {q(b)})"
    return expr


SNIPPET = f"({array(SNIPPETS)})"


def injected(length: str) -> str:
    return f"{SNIPPET}[CAST({length} % {len(SNIPPETS)} AS INTEGER) + 1]"


DOCS = (
    "docs AS (SELECT doc_id, lang, source, n_chars, text || ' ' || "
    + injected("n_chars") + " AS text FROM documents)"
)

# --- text rules ---------------------------------------------------------------

MOJIBAKE = [
    ("Ãœ", "Ü"), ("Ã¼", "ü"), ("Ã–", "Ö"), ("Ã¶", "ö"), ("Ã‡", "Ç"), ("Ã§", "ç"),
    ("Äž", "Ğ"), ("ÄŸ", "ğ"), ("Ä±", "ı"), ("Ä°", "İ"), ("Åž", "Ş"), ("ÅŸ", "ş"),
    ("Æ" + chr(0x8F), "Ə"), ("É™", "ə"),
]
LIGATURES = [("ﬀ", "ff"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬃ", "ffi"), ("ﬄ", "ffl"), ("ﬆ", "st")]
WIDE = "".join(chr(c) for c in range(0xFF01, 0xFF5F)) + chr(0x3000)
NARROW = "".join(chr(c) for c in range(0x21, 0x7F)) + " "


def emoji(expr: str) -> str:
    for tag, faces in (("<EMO_POS>", R.EMOJI_POSITIVE), ("<EMO_NEG>", R.EMOJI_NEGATIVE)):
        expr = replace_all(expr, [(face, f" {tag} ") for face in faces])
    return expr


def repaired(expr: str) -> str:
    expr = replace_all(expr, MOJIBAKE + LIGATURES)
    expr = f"translate({expr}, {q(WIDE)}, {q(NARROW)})"
    return f"nfc_normalize({sub(expr, '[' + chr(92) + 'x01-' + chr(92) + 'x08]', '')})"


ENTITIES = [
    ("amp", "&"), ("lt", "<"), ("gt", ">"), ("quot", '"'), ("copy", "©"),
    ("middot", "·"), ("nbsp", chr(0xA0)),
]


def unescaped(expr: str) -> str:
    named = " ".join(
        f"WHEN regexp_matches(p, '^{n};?') THEN {q(c)} || regexp_replace(p, '^{n};?', '')"
        for n, c in ENTITIES
    )
    piece = (
        "CASE WHEN regexp_matches(p, '^#[0-9]') THEN "
        "chr(CAST(regexp_extract(p, '^#([0-9]+)', 1) AS INTEGER)) "
        "|| regexp_replace(p, '^#[0-9]+;?', '') "
        "WHEN regexp_matches(p, '^#[xX][0-9a-fA-F]') THEN "
        "chr(CAST('0x' || regexp_extract(p, '^#[xX]([0-9a-fA-F]+)', 1) AS INTEGER)) "
        "|| regexp_replace(p, '^#[xX][0-9a-fA-F]+;?', '') "
        f"{named} ELSE '&' || p END"
    )
    parts = f"string_split({expr}, '&')"
    return (
        f"({parts}[1] || array_to_string(list_transform({parts}[2:], lambda p: {piece}), ''))"
    )


def settled(expr: str) -> str:
    """One reading of lines without markup; the snippets are nested four deep at most."""
    line = f"CASE WHEN contains(l, '<') OR NOT contains(l, '&') THEN l ELSE {unescaped('l')} END"
    return f"array_to_string(list_transform(string_split({expr}, chr(10)), lambda l: {line}), chr(10))"


def urls(expr: str, tag: str = " <URL> ") -> str:
    return sub(expr, rf"(?i)(https?://|www\.)[^{S}]+", tag)


def emails(expr: str, tag: str = " <EMAIL> ") -> str:
    return sub(expr, rf"[{W}][{W}.\-]*@[{W}.\-]+\.[{W}]+", tag)


def phones(expr: str, tag: str = " <PHONE> ") -> str:
    return sub(expr, rf"\+?[{D}{S}\-()]{{6,}}{D}", tag)


def mentions(expr: str, tag: str = " <USER> ") -> str:
    return sub(expr, rf"@[{W}]+", tag)


def hashtags(expr: str) -> str:
    parts = f"string_split({expr}, '#')"
    name = "regexp_extract(p, '^[A-Za-z0-9_]+')"
    camel = f"regexp_replace({name}, '([a-z])([A-Z])', '\\1 \\2', 'g')"
    piece = (
        f"CASE WHEN {name} <> '' THEN ' ' || {camel} || ' ' || substr(p, length({name}) + 1) "
        "ELSE '#' || p END"
    )
    return (
        f"({parts}[1] || array_to_string(list_transform({parts}[2:], lambda p: {piece}), ''))"
    )


def lowered(expr: str) -> str:
    return f"lower(translate(nfc_normalize({expr}), 'Iİ', 'ıi'))"


def collapsed(expr: str, letters: str = R.LOWER_LETTERS) -> str:
    for c in letters:
        expr = f"regexp_replace({expr}, '{c}{{3,}}', '{c}{c}', 'g')"
    return expr


def whole(words: str) -> str:
    return rf"(^|[^{W}])({words})($|[^{W}])"


LONG_S = chr(0x17F)
NEWS = whole(f"apa|trend|azertac|reuter[s{LONG_S}]|bloomberg|dha")
REVIEW = whole(f"azn|manat|q[iı]ymət|ald[ıi]m|ulduz|çox yaxşı|çox p[ıi][s{LONG_S}]")


def domain(expr: str) -> str:
    low = f"lower({expr})"
    return (
        f"CASE WHEN regexp_matches({low}, {q(NEWS)}) THEN 'news' "
        f"WHEN contains({expr}, '@') OR contains({expr}, '#') "
        f"OR regexp_matches({low}, {q(whole('rt'))}) THEN 'social' "
        f"WHEN regexp_matches({low}, {q(REVIEW)}) THEN 'reviews' ELSE 'general' END"
    )


def spelled(token: str) -> str:
    whens = " ".join(f"WHEN {q(a)} THEN {q(b)}" for a, b in R.SPELLING.items())
    return f"CASE {token} {whens} ELSE {token} END"


# Written out again, so that a slip in the rules does not pass both sides.
STOPWORDS = ("və", "amma", "lakin", "çünki", "belə", "hətta", "bütün", "əgər", "yenə", "sonra")
NEGATORS = "(" + ", ".join(q(n) for n in R.NEGATORS) + ")"


def negated(source: str, keys: str, prefix: str = "") -> str:
    """CTEs from ``source(keys, pos, token)`` to ``{prefix}marked`` with suffixes."""
    return f"""
    {prefix}scope AS (
      SELECT *, sum(CASE WHEN token IN {NEGATORS} THEN 1 ELSE 0 END)
               OVER (PARTITION BY {keys} ORDER BY pos) AS g,
             CASE WHEN token IN {NEGATORS} OR token LIKE '<%' THEN 0 ELSE 1 END AS word
      FROM {source}),
    {prefix}placed AS (
      SELECT *, sum(word) OVER (PARTITION BY {keys}, g ORDER BY pos) AS place
      FROM {prefix}scope),
    {prefix}marked AS (
      SELECT {keys}, pos, CASE WHEN g > 0 AND word = 1 AND place <= 3
                               THEN token || '_NEG' ELSE token END AS token
      FROM {prefix}placed)"""


def joined(source: str, keys: str, extra: str = "") -> str:
    return (
        f"SELECT {keys}, string_agg(token, ' ' ORDER BY pos) AS cleaned_text "
        f"FROM {source} WHERE length(token) > 1 OR token IN ('o', 'e') GROUP BY {keys}"
    )


def cleaned(source: str, keys: str, prefix: str = "", negation: bool = True) -> str:
    """CTEs from ``source(keys, text)`` to ``{prefix}base(keys, cleaned_text)``."""
    p = prefix
    marked = negated(f"{p}toks", keys, p) if negation else f"{p}marked AS (SELECT * FROM {p}toks)"
    return f"""
    {p}c1 AS MATERIALIZED (SELECT {keys}, {repaired(emoji('text'))} AS t FROM {source}),
    {p}u1 AS MATERIALIZED (SELECT {keys}, {settled('t')} AS t FROM {p}c1),
    {p}u2 AS MATERIALIZED (SELECT {keys}, {settled('t')} AS t FROM {p}u1),
    {p}u3 AS MATERIALIZED (SELECT {keys}, {settled('t')} AS t FROM {p}u2),
    {p}u4 AS MATERIALIZED (SELECT {keys}, {settled('t')} AS t FROM {p}u3),
    {p}c2 AS MATERIALIZED (SELECT {keys}, {unescaped('t')} AS t FROM {p}u4),
    {p}c3 AS MATERIALIZED (SELECT {keys}, {emails(urls(sub('t', '<[^>]+>')))} AS t FROM {p}c2),
    {p}c4 AS MATERIALIZED (SELECT {keys}, {mentions(phones('t'))} AS t FROM {p}c3),
    {p}c5 AS MATERIALIZED (SELECT {keys}, {lowered(hashtags('t'))} AS t FROM {p}c4),
    {p}c6 AS MATERIALIZED (
      SELECT {keys}, regexp_extract_all({sub('t', D + '+', ' <NUM> ')},
                                        '[{LETTERS}]+|<NUM>') AS l FROM {p}c5),
    {p}c7 AS (SELECT {keys}, unnest(l) AS token, generate_subscripts(l, 1) AS pos FROM {p}c6),
    {p}toks AS MATERIALIZED (
      SELECT {keys}, pos, {spelled('token')} AS token
      FROM (SELECT {keys}, pos, {collapsed('token')} AS token FROM {p}c7)),
    {marked},
    {p}base AS MATERIALIZED ({joined(p + 'marked', keys)})"""


def rated(expr: str) -> str:
    # A cleaned text has one space between tokens, so pad and match twice.
    padded = f"(' ' || replace({expr}, ' ', '  ') || ' ')"
    padded = replace_all(padded, [(" çox  yaxşı ", " <RATING_POS> "),
                                  (" çox  pis ", " <RATING_NEG> ")])
    return f"trim(regexp_replace({padded}, ' +', ' ', 'g'))"


def in_domain(expr: str, dom: str = "domain") -> str:
    return f"CASE WHEN {dom} = 'reviews' THEN {rated(expr)} ELSE {expr} END"


# --- shared row sets ------------------------------------------------------------

TRI_LABELS = ("pos", "neu", "neg", "müsbət", "2", "junk")


def tri(expr: str) -> str:
    def words(items):
        return ", ".join(q(i) for i in items)
    v = f"lower(trim({expr}))"
    return (
        f"CASE WHEN {v} IN ({words(R.POSITIVE_LABELS)}) THEN 1.0 "
        f"WHEN {v} IN ({words(R.NEUTRAL_LABELS)}) THEN 0.5 "
        f"WHEN {v} IN ({words(R.NEGATIVE_LABELS)}) THEN 0.0 END::DOUBLE"
    )


def tri_label(key: str) -> str:
    return f"({array(TRI_LABELS)})[CAST({key} % 6 AS INTEGER) + 1]"


ROWS = f"""
  rows_all AS (
    SELECT 'documents' AS source, 0 AS source_ord, d.doc_id AS row_ord,
           d.text || ' ' || {injected('n_chars')} AS text, l.quality IS NOT NULL AS has_label,
           CASE WHEN l.quality = 1 THEN 1.0 WHEN l.quality IS NOT NULL THEN 0.0 END::DOUBLE AS v
    FROM documents d LEFT JOIN labels l USING (doc_id)
    UNION ALL
    SELECT 'conversations', 1, conv_id * 1000 + turn, text || ' ' || {injected('length(text)')},
           true, {tri(tri_label('(conv_id + turn)'))} FROM conversations
    UNION ALL
    SELECT 'benchmark', 2, item_id, text || ' ' || {injected('length(text)')},
           true, {tri(tri_label('item_id'))} FROM benchmark)"""

FIRST = f"""{ROWS},
  first_rows AS (
    SELECT source, source_ord, row_ord, text, v FROM (
      SELECT *, row_number() OVER (PARTITION BY source, text ORDER BY row_ord) AS n
      FROM rows_all WHERE text IS NOT NULL AND has_label AND regexp_matches(text, '[^{S}]'))
    WHERE n = 1)"""

KEYS = "source, row_ord"

CLEAN = f"""{FIRST},
  tagged AS MATERIALIZED (
    SELECT source, source_ord, row_ord, text, v, {domain('text')} AS domain
    FROM first_rows WHERE v IS NOT NULL),
  {cleaned('tagged', KEYS)},
  clean_rows AS MATERIALIZED (
    SELECT source, row_ord, domain, {in_domain('cleaned_text')} AS cleaned_text,
           v AS sentiment_value
    FROM base JOIN tagged USING (source, row_ord))"""

CORPUS = f"""{ROWS},
  tagged AS MATERIALIZED (SELECT *, {domain('text')} AS domain FROM rows_all WHERE text IS NOT NULL),
  {cleaned('tagged', KEYS)},
  corpus AS (
    SELECT source, row_ord, domain, 'dom' || domain || ' ' || lower(cleaned_text) AS value
    FROM base JOIN tagged USING (source, row_ord) WHERE cleaned_text <> '')"""

DOC_TEXT = f"""{DOCS},
  tagged AS MATERIALIZED (SELECT *, {domain('text')} AS domain FROM docs),
  {cleaned('docs', 'doc_id')},
  clean_docs AS MATERIALIZED (
    SELECT doc_id, lang, source, domain, cleaned_text FROM base JOIN tagged USING (doc_id))"""

DOC_TOKENS = f"""{DOC_TEXT},
  tokens AS MATERIALIZED (
    SELECT doc_id, lang, source, domain, unnest(l) AS token, generate_subscripts(l, 1) - 1 AS pos
    FROM (SELECT *, string_split(cleaned_text, ' ') AS l FROM clean_docs)),
  vocab AS MATERIALIZED (
    SELECT token AS word, count(*) AS cnt FROM tokens GROUP BY 1 HAVING count(*) >= 3)"""


def covered(by: str) -> str:
    return f"""SELECT {by}, count(*) AS tokens, count(v.word) AS hits,
      count(v.word) / greatest(1, count(*))::DOUBLE AS coverage
      FROM tokens t LEFT JOIN vocab v ON t.token = v.word GROUP BY {by}"""


# --- the intended rules -----------------------------------------------------------

CHAR = {tag: chr(0xE000 + i) for i, tag in enumerate(R.TOKEN_TAGS + R.REVIEW_TAGS)}


def char(tag: str) -> str:
    return f" {CHAR[tag]} "


def hashtags_any(expr: str) -> str:
    parts = f"string_split({expr}, '#')"
    name = f"regexp_extract(p, '^[{W}]+')"
    camel = f"regexp_replace({name}, '(\\p{{Ll}})(\\p{{Lu}})', '\\1 \\2', 'g')"
    plain = f"regexp_matches({name}, '^[A-Za-z0-9_]+$')"
    piece = (
        f"CASE WHEN {name} = '' THEN '#' || p ELSE ' ' || "
        f"CASE WHEN {plain} THEN replace({camel}, 'I', 'i') ELSE {camel} END "
        f"|| ' ' || substr(p, length({name}) + 1) END"
    )
    return (
        f"({parts}[1] || array_to_string(list_transform({parts}[2:], lambda p: {piece}), ''))"
    )


def amounts(expr: str) -> str:
    # Neighbouring amounts share a boundary character, hence two passes each.
    for _ in range(2):
        expr = sub(expr, rf"(^|[^{W}]){D}+[{S}]*(azn|manat)($|[^{W}])",
                   rf"\1{char('<PRICE>')}\3")
    for n in "12345":
        for _ in range(2):
            expr = sub(expr, rf"(^|[^{W}]){n}[{S}]*ulduz($|[^{W}])",
                       rf"\1{char(f'<STARS_{n}>')}\2")
    return expr


def intended() -> str:
    faces = "t"
    for tag, group in (("<EMO_POS>", R.EMOJI_POSITIVE), ("<EMO_NEG>", R.EMOJI_NEGATIVE)):
        faces = replace_all(faces, [(face, char(tag)) for face in group])
    tags = " ".join(f"WHEN {q(c)} THEN {q(tag)}" for tag, c in CHAR.items())
    turkic = f"lower(translate(nfc_normalize({hashtags_any('t')}), 'Iİ', 'ıi'))"
    return f"""WITH {DOCS},
    tagged AS MATERIALIZED (SELECT doc_id, {domain('text')} AS domain FROM docs),
    z1 AS MATERIALIZED (SELECT doc_id, {settled('text')} AS t FROM docs),
    z2 AS MATERIALIZED (SELECT doc_id, {settled('t')} AS t FROM z1),
    z3 AS MATERIALIZED (SELECT doc_id, {settled('t')} AS t FROM z2),
    z4 AS MATERIALIZED (SELECT doc_id, {settled('t')} AS t FROM z3),
    i1 AS MATERIALIZED (SELECT doc_id, {unescaped('t')} AS t FROM z4),
    i2 AS MATERIALIZED (SELECT doc_id, {repaired(sub('t', '<[^>]+>'))} AS t FROM i1),
    i3 AS MATERIALIZED (
      SELECT doc_id, {emails(urls(faces, char('<URL>')), char('<EMAIL>'))} AS t FROM i2),
    i4 AS MATERIALIZED (
      SELECT doc_id, {mentions(phones('t', char('<PHONE>')), char('<USER>'))} AS t FROM i3),
    i5 AS MATERIALIZED (SELECT doc_id, {turkic} AS t FROM i4),
    i6 AS MATERIALIZED (
      SELECT doc_id, domain, CASE WHEN domain = 'reviews' THEN {amounts('t')} ELSE t END AS t
      FROM i5 JOIN tagged USING (doc_id)),
    i7 AS (
      SELECT doc_id, domain, regexp_extract_all({sub('t', D + '+', char('<NUM>'))},
        '[{LETTERS}]+|[{CHAR['<NUM>']}-{CHAR['<RATING_NEG>']}]') AS l FROM i6),
    i8 AS (SELECT doc_id, domain, unnest(l) AS token, generate_subscripts(l, 1) AS pos FROM i7),
    i9 AS (
      SELECT doc_id, domain, pos, CASE token {tags} ELSE {spelled('token')} END AS token
      FROM (SELECT doc_id, domain, pos, {collapsed('token')} AS token FROM i8)),
    near AS (
      SELECT *, lead(token) OVER w AS after, lag(token) OVER w AS before
      FROM i9 WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
    toks AS MATERIALIZED (
      SELECT doc_id, pos,
        CASE WHEN domain = 'reviews' AND token = 'çox' AND after = 'yaxşı' THEN '<RATING_POS>'
             WHEN domain = 'reviews' AND token = 'çox' AND after = 'pis' THEN '<RATING_NEG>'
             ELSE token END AS token
      FROM near
      WHERE NOT (domain = 'reviews' AND token IN ('yaxşı', 'pis') AND before IS NOT DISTINCT FROM 'çox')),
    {negated('toks', 'doc_id')},
    base AS ({joined('marked', 'doc_id')})
    SELECT doc_id, domain, coalesce(cleaned_text, '') AS t FROM tagged LEFT JOIN base USING (doc_id)"""


# --- vectors --------------------------------------------------------------------

VECTORS = """
  vectors AS MATERIALIZED (
    SELECT 'w' || vec_id AS word, vec_id, label, 1 + vec_id % 7 AS cnt,
           list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS vector FROM embeddings),
  pairs AS MATERIALIZED (
    SELECT CASE WHEN b.label = a.label OR b.label IS NULL THEN 'syn' ELSE 'ant' END AS kind,
           'w' || a.vec_id AS a, 'w' || (a.vec_id + 1) AS b
    FROM embeddings a LEFT JOIN embeddings b ON b.vec_id = a.vec_id + 1)"""


def cos(a: str, b: str) -> str:
    return (
        f"list_dot_product({a}, {b}) / sqrt(list_dot_product({a}, {a})) "
        f"/ sqrt(list_dot_product({b}, {b}))"
    )


def pair_cosines(vectors: str = "vectors") -> str:
    return (
        f"SELECT p.kind, p.a, p.b, {cos('x.vector', 'y.vector')} AS c FROM pairs p "
        f"JOIN {vectors} x ON x.word = p.a JOIN {vectors} y ON y.word = p.b"
    )


def means(source: str, by: str = "") -> str:
    select = f"{by}, " if by else ""
    group = f" GROUP BY {by}" if by else ""
    return (
        f"SELECT {select}avg(c) FILTER (WHERE kind = 'syn') AS syn, "
        f"avg(c) FILTER (WHERE kind = 'ant') AS ant FROM {source}{group}"
    )


def grams(source: str, columns: str, low: int = 3, high: int = 6) -> str:
    """Distinct n-grams of each framed word of ``source``."""
    framed = "('<' || word || '>')"
    lists = ", ".join(
        f"list_transform(range(1, length({framed}) - {n} + 2), "
        f"lambda i: substr({framed}, i, {n}))"
        for n in range(low, high + 1)
    )
    return f"SELECT {columns}, unnest(list_distinct(flatten([{lists}]))) AS ngram FROM {source}"


GRAMS = f"""{VECTORS},
  word_grams AS ({grams('vectors', 'word, cnt, vector')}),
  gram_dims AS MATERIALIZED (
    SELECT ngram, i, sum(cnt * vector[i]) / sum(cnt) AS x, count(*) AS words
    FROM (SELECT ngram, cnt, vector, unnest(range(1, 65)) AS i FROM word_grams)
    GROUP BY ngram, i),
  gram_vectors AS MATERIALIZED (
    SELECT ngram, any_value(words) AS words, list(x ORDER BY i) AS vector
    FROM gram_dims GROUP BY ngram),
  unknown AS (SELECT 'w' || vec_id || vec_id AS word FROM embeddings
              WHERE 'w' || vec_id || vec_id NOT IN (SELECT word FROM vectors)),
  unknown_vectors AS MATERIALIZED (
    SELECT word, any_value(ngrams) AS ngrams, list(x ORDER BY i) AS vector FROM (
      SELECT word, i, avg(vector[i]) AS x, count(*) AS ngrams FROM (
        SELECT g.word, v.vector, unnest(range(1, 65)) AS i
        FROM ({grams('unknown', 'word')}) g JOIN gram_vectors v USING (ngram))
      GROUP BY word, i)
    GROUP BY word)"""

def crc32(expr: str) -> str:
    """CRC-32 of an ASCII string, bit by bit."""
    codes = f"list_transform(string_split({expr}, ''), lambda c: ascii(c)::BIGINT)"
    byte = ("list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: "
            "xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))")
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, b: {byte}), 4294967295)"


def slots(source: str, columns: str, buckets: int = 3000) -> str:
    """The slot of each n-gram of each word."""
    return f"SELECT {columns}, {crc32('ngram')} % {buckets} AS bucket FROM ({grams(source, columns)})"


SLOTS = f"""{VECTORS},
  slot_dims AS MATERIALIZED (
    SELECT bucket, i, sum(cnt * vector[i]) / sum(cnt) AS x, count(*) AS words
    FROM (SELECT bucket, cnt, vector, unnest(range(1, 65)) AS i FROM ({slots('vectors', 'word, cnt, vector')}))
    GROUP BY bucket, i),
  slot_vectors AS MATERIALIZED (
    SELECT bucket, any_value(words) AS words, list(x ORDER BY i) AS vector FROM slot_dims GROUP BY bucket)"""

HALF = """
  half AS MATERIALIZED (SELECT word, list_concat(list_concat(
    list_transform(vector[33:64], lambda x: -x), vector[1:16]), list_transform(range(16), lambda x: 0.0)) AS vector
    FROM vectors)"""

VECTOR_SUMS = """round(list_sum(vector), 6) AS total,
  round(sqrt(list_dot_product(vector, vector)), 6) AS length,
  round(list_sum(list_transform(vector, lambda x, i: x * i)), 5) AS moment"""


def oracle_sql() -> dict[str, str]:
    docs = f"WITH {DOCS} SELECT doc_id, "
    sql: dict[str, str] = {}

    # Sources, filters, dedup, unions, limits.
    sql["union_sources"] = f"""WITH {ROWS}
      SELECT source, source_ord, count(*) AS n, count(*) FILTER (WHERE has_label) AS labelled,
             sum(length(text))::BIGINT AS chars FROM rows_all GROUP BY source, source_ord"""
    sql["drop_blank"] = f"""WITH r AS (
        SELECT page_id, html AS text FROM pages
        UNION ALL SELECT page_id, chr(160) || chr(9) || '  ' FROM pages
        UNION ALL SELECT page_id, NULL FROM pages)
      SELECT page_id, length(text) AS chars FROM r WHERE regexp_matches(text, '[^{S}]')"""
    sql["dedup_first_wins"] = """SELECT source, row_ord, lang, label FROM (
        SELECT d.source, d.doc_id AS row_ord, d.lang, coalesce(l.quality, -1) AS label,
          row_number() OVER (PARTITION BY d.source, d.text ORDER BY d.doc_id) AS n
        FROM documents d LEFT JOIN labels l USING (doc_id)) WHERE n = 1"""
    sql["dedup_label_first"] = f"""WITH {FIRST}
      SELECT source, row_ord, v AS sentiment_value FROM first_rows"""
    sql["dedup_large_order"] = f"""WITH {ROWS}, o AS (
        SELECT *, CASE WHEN row_ord % 2 = 0 THEN 4611686018427387909 + row_ord
          ELSE -4611686018427387904 - row_ord END AS big FROM rows_all
        WHERE source = 'documents' AND has_label AND text IS NOT NULL)
      SELECT source, big::BIGINT AS row_ord, v AS sentiment_value FROM (
        SELECT *, row_number() OVER (PARTITION BY source, text ORDER BY big) AS n FROM o) WHERE n = 1"""
    sql["read_sources_rows"] = f"""
      SELECT 'talk' AS source, 0 AS source_ord, row_number() OVER () - 1 AS row_ord, role IS NOT NULL AS has_label,
        {tri('role')}::DOUBLE AS sentiment_value, length(text) AS chars FROM conversations
      UNION ALL SELECT 'labels', 3, doc_id, quality IS NOT NULL,
        CASE WHEN quality = 1 THEN 1.0 WHEN quality IS NOT NULL THEN 0.0 END, length(toxic::VARCHAR) FROM labels"""
    sql["read_sources_status"] = """
      SELECT 'talk' AS source, 'read' AS status, (SELECT count(*) FROM conversations) AS n
      UNION ALL SELECT 'nothing', 'missing', 0 UNION ALL SELECT 'lacking', 'no columns', 0
      UNION ALL SELECT 'labels', 'read', (SELECT count(*) FROM labels)"""
    cut = "(conv_id + turn) % 7 = 0"
    sql["read_sources_bad_rows"] = f"""
      SELECT 'labels' AS source, 'read' AS status, count(*) FILTER (WHERE doc_id % 10 IN (3, 7)) AS bad_rows,
        count(*) FILTER (WHERE doc_id % 10 NOT IN (3, 7)) AS n,
        count(quality) FILTER (WHERE doc_id % 10 NOT IN (3, 7)) AS labelled FROM labels
      UNION ALL SELECT 'turns', 'read', count(*) FILTER (WHERE {cut}), count(*) FILTER (WHERE NOT {cut}),
        count(role) FILTER (WHERE NOT {cut}) FROM conversations
      UNION ALL SELECT 'nothing', 'missing', 0, 0, 0"""
    sql["bad_records"] = f"""
      SELECT 'labels' AS source, CASE WHEN doc_id % 10 = 3 THEN doc_id::VARCHAR
        ELSE concat_ws(',', doc_id, quality, toxic) || ',more,fields' END AS record
      FROM labels WHERE doc_id % 10 IN (3, 7)
      UNION ALL SELECT 'turns', left(j, length(j) - 3) FROM (SELECT to_json(
        {{'conv_id': conv_id, 'turn': turn, 'role': role, 'text': text}})::VARCHAR AS j FROM conversations WHERE {cut})"""
    sql["junk_columns"] = f"""SELECT 'talk' AS source, 0 AS source_ord, conv_id * 1000 + turn AS row_ord, text,
        role IS NOT NULL AS has_label, {tri('role')} AS sentiment_value,
        'source,source_ord,row_ord,text,has_label,sentiment_value' AS columns FROM conversations"""
    sql["sink_by_source"] = f"""WITH {ROWS}, r AS (SELECT * FROM rows_all
        WHERE text IS NOT NULL AND has_label AND v IS NOT NULL AND (source = 'documents'
          OR source = 'conversations' AND v = 1.0)),
      c AS (SELECT source, count(*) AS n, sum(length(text))::BIGINT AS chars, sum(row_ord)::BIGINT AS mark
            FROM r GROUP BY source)
      SELECT source, n, chars, mark, CASE WHEN source <> 'documents' THEN n END AS written FROM c
      UNION ALL SELECT 'benchmark', 0, 0, 0, 0"""
    sql["pruned_read"] = f"""WITH {ROWS}
      SELECT source, count(*) AS n, sum(length(text))::BIGINT AS chars, max(length(text))::INT AS longest FROM rows_all
      WHERE text IS NOT NULL AND has_label AND v IS NOT NULL GROUP BY source"""
    sql["empty_guard"] = f"""WITH {ROWS}, r AS (SELECT * FROM rows_all
        WHERE text IS NOT NULL AND has_label AND v IS NOT NULL)
      SELECT unnest(['documents', 'conversations', 'benchmark', 'nowhere']) AS source, unnest([
        (SELECT count(*) > 0 FROM r WHERE source = 'documents'), (SELECT count(*) > 0 FROM r WHERE source = 'conversations'),
        (SELECT count(*) > 0 FROM r WHERE source = 'benchmark'), false]) AS has_rows"""
    talk = "talk AS (SELECT conv_id * 1000 + turn AS row_ord, role AS source, text FROM conversations WHERE text IS NOT NULL)"
    sql["tuned_as_reported"] = f"""WITH {talk}, {cleaned('talk', 'source, row_ord')},
      tokens AS (SELECT source, unnest(string_split(cleaned_text, ' ')) AS token FROM base),
      three AS (SELECT token AS word FROM tokens GROUP BY token HAVING count(*) >= 3)
      SELECT true AS same, round(avg(c), 9) AS coverage FROM (SELECT source, count(word)::DOUBLE / count(*) AS c
        FROM tokens LEFT JOIN three ON word = token GROUP BY source)"""
    sql["corpus_store"] = f"""WITH {CORPUS}
      SELECT value, (SELECT count(*) FROM corpus) AS lines FROM corpus WHERE domain = 'reviews'"""
    sql["vector_store"] = f"""WITH {VECTORS}
      SELECT kind, a, b, round(c, 6) AS cosine, (SELECT round(sum(CASE WHEN v.word || v.cnt IN (SELECT word FROM vectors)
        THEN cnt ELSE 0 END) / sum(cnt)::DOUBLE, 9) FROM vectors v) AS coverage FROM ({pair_cosines()})"""
    given = {
        "vector_size": ("n::VARCHAR", "read"),
        "window": ("CASE WHEN label % 3 = 0 THEN 'wide' ELSE (label + 2)::VARCHAR END",
                   "CASE WHEN label % 3 = 0 THEN 'wrong type' ELSE 'read' END"),
        "sample": ("CASE WHEN label % 2 = 0 THEN '0.001' ELSE 'much' END",
                   "CASE WHEN label % 2 = 0 THEN 'read' ELSE 'wrong type' END"),
    }
    rows = []
    for key in "vector_size window min_count epochs sample seed min_n max_n sg negative".split():
        value, status = given.get(key, ("NULL", "missing"))
        status = status if status.startswith("CASE") else q(status)
        rows.append(f"SELECT label, {q(key)} AS key, {value} AS given, {status} AS status FROM l WHERE label <> 7")
    sql["params_report"] = "WITH l AS (SELECT label, count(*) AS n FROM embeddings GROUP BY label) " + " UNION ALL ".join(
        [*rows, """SELECT label, 'colour', '[1,"red"]', 'unknown' FROM l WHERE label % 4 = 1""",
         "SELECT label, NULL, NULL, 'no object' FROM l WHERE label = 7"])
    sql["head_n_sentences"] = f"""WITH {ROWS} SELECT source, row_ord, text FROM (
        SELECT *, source_ord AS so FROM rows_all ORDER BY source_ord, row_ord LIMIT 700)"""

    # Text rules one by one.
    sql["emoji_tags"] = docs + f"{emoji('text')} AS t FROM docs"
    sql["mojibake_repair"] = docs + f"{repaired('text')} AS t FROM docs"
    sql["html_unescape"] = f"""WITH
      u0 AS MATERIALIZED (SELECT page_id, html || chr(10) || {injected('length(html)')} AS t FROM pages),
      u1 AS MATERIALIZED (SELECT page_id, {settled('t')} AS t FROM u0),
      u2 AS MATERIALIZED (SELECT page_id, {settled('t')} AS t FROM u1),
      u3 AS MATERIALIZED (SELECT page_id, {settled('t')} AS t FROM u2),
      u4 AS MATERIALIZED (SELECT page_id, {settled('t')} AS t FROM u3)
      SELECT page_id, {unescaped('t')} AS t FROM u4"""
    sql["html_url_email_tags"] = f"""SELECT page_id, {emails(urls(sub(
        f"html || ' ' || url || ' ' || {injected('length(html)')}", '<[^>]+>')))} AS t FROM pages"""
    sql["encoding_round_trip"] = """SELECT doc_id, doc_id % 4 > 0 AND strlen(text) > length(text) AS garbled,
      text AS t FROM documents"""
    bare = sub("text", rf"[^{W}{S}<>.!?" + "']")
    for mark in "!?.,;:":
        bare = sub(bare, f"[{mark}]{{2,}}", mark)
    sql["sentence_marks"] = f"""WITH {DOCS}, b AS (SELECT doc_id, trim({sub(bare, f'[{S}]+')}) AS t FROM docs)
      SELECT doc_id, t, len(list_filter(regexp_split_to_array(t, '[.!?]+'),
        lambda x: regexp_matches(x, '[^{S}]')))::BIGINT AS sentences FROM b"""
    sql["phone_number_tags"] = docs + (
        f"{phones('text')} AS phones, {sub(phones('text'), D + '+', ' <NUM> ')} AS numbers FROM docs")
    sql["mention_tags"] = docs + f"{mentions('text')} AS t FROM docs"
    sql["hashtag_split"] = docs + f"{hashtags('text')} AS t FROM docs"
    sql["lower_az"] = docs + f"{lowered('text')} AS t FROM docs"
    squeezed = "text"
    for mark in "!?.,;:":
        squeezed = sub(squeezed, f"[{mark}]{{2,}}", mark)
    sql["squeeze_marks"] = docs + (
        f"trim({sub(squeezed, f'[{S}]+')}) AS t, "
        rf"{sub('text', rf'[^{W}{S}<>' + chr(39) + ']')} AS bare FROM docs")
    sql["whitelist_tokens"] = f"""WITH {DOCS} SELECT token, count(*) AS cnt FROM (
        SELECT unnest(regexp_extract_all({lowered('text')}, '[{LETTERS}]+')) AS token FROM docs)
      GROUP BY token"""
    sql["repeat_collapse"] = f"""WITH {DOCS} SELECT token, count(*) AS cnt FROM (
        SELECT {collapsed('t')} AS token FROM (
          SELECT unnest(regexp_extract_all({lowered('text')}, '[{LETTERS}]+')) AS t FROM docs))
      GROUP BY token"""
    sql["deasciify_changes"] = f"""WITH {DOCS},
        tagged AS (SELECT doc_id, source, {domain('text')} AS domain FROM docs),
        {cleaned('docs', 'doc_id')}
      SELECT source, domain, count(*) AS tokens,
        count(*) FILTER (WHERE {spelled('token')} <> token) AS changed
      FROM (SELECT doc_id, {collapsed('token')} AS token FROM c7) JOIN tagged USING (doc_id)
      GROUP BY source, domain"""
    words = f"""WITH {DOCS},
      l AS (SELECT doc_id, regexp_extract_all({lowered('text')}, '[{LETTERS}]+') AS l FROM docs),
      toks AS (SELECT doc_id, unnest(l) AS token, generate_subscripts(l, 1) AS pos FROM l)"""
    sql["negation_scope"] = words + f""",{negated('toks', 'doc_id')}
      SELECT doc_id, string_agg(token, ' ' ORDER BY pos) AS t FROM marked GROUP BY doc_id"""
    sql["negation_toggle"] = words + f""",{negated('toks', 'doc_id')}
      SELECT (SELECT count(DISTINCT token) FROM toks) AS words_off,
             (SELECT count(DISTINCT token) FROM marked) AS words_on,
             (SELECT count(*) FROM marked WHERE token LIKE '%#_NEG' ESCAPE '#') AS marked"""
    sql["short_token_filter"] = words + """
      SELECT doc_id, string_agg(token, ' ' ORDER BY pos) AS t, count(*) AS kept FROM toks
      WHERE length(token) > 1 OR token IN ('o', 'e') GROUP BY doc_id"""
    price = rf"(?i)(^|[^{W}]){D}+[{S}]*(azn|manat)($|[^{W}])"
    stars = rf"(?i)(^|[^{W}])([1-5])[{S}]*ulduz($|[^{W}])"
    review = sub(sub("text", price, r"\1 <PRICE> \3"), stars, r"\1 <STARS_\2> \3")
    for phrase, tag in ((R.POSITIVE_RATING, "<RATING_POS>"), (R.NEGATIVE_RATING, "<RATING_NEG>")):
        review = sub(review, whole(phrase), rf"\1 {tag} \3")
    sql["rating_tags"] = f"""WITH {DOCS}, tagged AS (SELECT *, {domain('text')} AS domain FROM docs)
      SELECT doc_id, domain, CASE WHEN domain = 'reviews'
        THEN trim({sub(review, f'[{S}]+')}) ELSE text END AS t FROM tagged"""
    sql["domain_counts"] = f"""WITH {DOCS} SELECT source, {domain('text')} AS domain, count(*) AS n
      FROM docs GROUP BY 1, 2"""

    # Labels.
    values = array(["1", "0", "7", " 1 ", "1.0", "abc", "0_1", "+1", "-1", "_1"])
    sql["label_binary"] = f"""SELECT d.doc_id,
        CASE WHEN l.quality = 1 THEN 1.0 WHEN l.quality IS NOT NULL THEN 0.0 END::DOUBLE AS quality,
        CASE WHEN regexp_matches(d.v, '^[{S}]*[+-]?[0-9]+(_[0-9]+)*[{S}]*$') THEN
          CASE WHEN TRY_CAST(replace(trim(d.v), '_', '') AS BIGINT) = 1 THEN 1.0 ELSE 0.0 END
        END::DOUBLE AS from_text,
        CASE WHEN n_chars >= 1000 AND n_chars < 2000 THEN 1.0 ELSE 0.0 END::DOUBLE AS from_float
      FROM (SELECT *, ({values})[CAST(doc_id % 10 AS INTEGER) + 1] AS v FROM documents) d
      LEFT JOIN labels l USING (doc_id)"""
    names = ["Positive", "müsbət", "2", "neytral", "0", "bad", "1.0", "junk", " NEG ", "1"]
    sql["label_tri"] = f"""SELECT doc_id,
        {tri(f"({array(names)})[CAST(doc_id % 10 AS INTEGER) + 1]")} AS from_text,
        CASE n_chars % 4 WHEN 1 THEN 1.0 WHEN 2 THEN 0.5 WHEN 0 THEN 0.0 END::DOUBLE AS from_int,
        CAST(NULL AS DOUBLE) AS from_float FROM documents"""

    # Plans.
    sql["clean_two_column"] = f"""WITH {CLEAN}
      SELECT source, row_ord, domain, cleaned_text, sentiment_value FROM clean_rows"""
    sql["intended_clean"] = intended()
    sql["row_counts"] = f"""WITH {CLEAN}
      SELECT source, count(*) AS n FROM clean_rows GROUP BY ROLLUP (source)"""
    sql["corpus_lines"] = f"WITH {CORPUS} SELECT source, row_ord, domain, value FROM corpus"
    sql["corpus_domain_filter"] = f"""WITH {CORPUS}
      SELECT source, row_ord, value FROM corpus WHERE value LIKE 'domreviews %'"""
    protected = emails(urls("text"))
    sql["sentence_split"] = f"""WITH {DOCS}, p AS (
        SELECT doc_id, unnest(regexp_split_to_array({protected}, '[.!?]+')) AS s FROM docs)
      SELECT doc_id, count(*) AS sentences, sum(length({sub('s', f'^[{S}]+|[{S}]+$', '')}))::BIGINT AS chars
      FROM p WHERE regexp_matches(s, '[^{S}]') GROUP BY doc_id"""

    # Tokens, vocabularies, coverage.
    sql["vocab_min_count"] = f"WITH {DOC_TOKENS} SELECT word, cnt FROM vocab"
    sql["coverage_by_source"] = f"WITH {DOC_TOKENS} {covered('source')}"
    sql["coverage_by_domain"] = f"WITH {DOC_TOKENS} {covered('source, domain')}"
    sql["coverage_macro"] = f"""WITH {DOC_TOKENS}
      SELECT round(coalesce(avg(coverage), 0.0), 9) AS coverage FROM ({covered('source')})"""
    sql["stopword_candidates"] = f"""WITH {DOC_TOKENS} SELECT lang, token, docs, rank FROM (
        SELECT *, row_number() OVER (PARTITION BY lang ORDER BY docs DESC, token) AS rank FROM (
          SELECT lang, token, count(DISTINCT doc_id) AS docs FROM tokens
          WHERE token NOT IN {NEGATORS} GROUP BY lang, token)) WHERE rank <= 10"""
    sql["stopword_comparison"] = f"""WITH c AS ({sql["stopword_candidates"]})
      SELECT token, string_agg(DISTINCT lang, ',' ORDER BY lang) AS langs, count(DISTINCT lang) AS n_langs,
        min(rank) AS best_rank, token IN ({", ".join(map(q, STOPWORDS))}) AS listed
      FROM c GROUP BY token"""
    sql["subsample_tokens"] = f"""WITH {DOC_TOKENS},
      f AS (SELECT token, count(*)::DOUBLE AS cnt, (SELECT count(*) FROM tokens)::DOUBLE AS total
            FROM tokens GROUP BY token),
      k AS (SELECT token, least(1.0, sqrt(0.001 * total / cnt) + 0.001 * total / cnt) AS keep FROM f)
      SELECT token, count(*) AS kept, sum(doc_id * 31 + pos)::BIGINT AS mark FROM tokens JOIN k USING (token)
      WHERE keep >= 1.0 OR ((doc_id * 7919 + pos * 104729) % 1000003) / 1000003.0 < keep
      GROUP BY token"""

    # Vectors.
    sql["pair_cosine"] = f"""WITH {VECTORS}
      SELECT kind, a, b, round(c, 6) AS cosine FROM ({pair_cosines()})"""
    sql["separation_score"] = f"""WITH {VECTORS}, m AS ({means('(' + pair_cosines() + ')')})
      SELECT round(syn, 6) AS syn_mean, round(ant, 6) AS ant_mean,
             round(coalesce(syn - ant, -1.0), 6) AS separation FROM m"""
    sql["knn_top5"] = f"""WITH {VECTORS},
      seeds AS (SELECT 'w' || min(vec_id) AS word FROM embeddings GROUP BY label
                UNION ALL SELECT 'w' || (max(vec_id) + 1) FROM embeddings),
      scored AS (
        SELECT s.word AS seed, v.word, {cos('v.vector', 'x.vector')} AS c
        FROM seeds s JOIN vectors x ON x.word = s.word JOIN vectors v ON v.word <> s.word),
      best AS (SELECT *, row_number() OVER (PARTITION BY seed ORDER BY c DESC, word) AS rank
               FROM scored)
      SELECT s.word AS seed, coalesce(b.rank, 0) AS rank, coalesce(b.word, '') AS word,
        round(b.c, 6) AS cosine
      FROM seeds s LEFT JOIN best b ON b.seed = s.word AND b.rank <= 5"""
    sql["model_neighbours"] = f"""WITH {GRAMS},
      seeds AS (SELECT 'w' || min(vec_id) AS word FROM embeddings GROUP BY label
                UNION ALL SELECT 'w' || (max(vec_id) + 1) FROM embeddings),
      composed AS (SELECT word, list(x ORDER BY i) AS vector FROM (
          SELECT word, i, avg(v[i]) AS x FROM (
            SELECT g.word, v.vector AS v, unnest(range(1, 65)) AS i
            FROM ({grams('seeds', 'word')}) g JOIN gram_vectors v USING (ngram)
            WHERE g.word NOT IN (SELECT word FROM vectors))
          GROUP BY word, i) GROUP BY word),
      asked AS (
        SELECT model, word AS seed, vector::DOUBLE[] AS vector FROM seeds JOIN vectors USING (word),
          (SELECT unnest(['plain', 'subword']) AS model)
        UNION ALL SELECT 'subword', word, vector FROM composed),
      scored AS (SELECT model, seed, v.word, {cos('v.vector::DOUBLE[]', 'a.vector')} AS c
                 FROM asked a JOIN vectors v ON v.word <> a.seed),
      best AS (SELECT *, row_number() OVER (PARTITION BY model, seed ORDER BY c DESC, word) AS rank FROM scored)
      SELECT m.model, s.word AS seed, coalesce(string_agg(b.word, ' ' ORDER BY b.rank), '') AS neighbours
      FROM seeds s CROSS JOIN (SELECT unnest(['plain', 'subword']) AS model) m
        LEFT JOIN best b ON b.model = m.model AND b.seed = s.word AND b.rank <= 5
      GROUP BY m.model, s.word"""
    sql["neighbours_all"] = f"""WITH {VECTORS}
      SELECT a.word AS seed, b.word, round({cos('a.vector', 'b.vector')}, 6) AS cosine
      FROM vectors a JOIN vectors b ON a.word <> b.word
      QUALIFY row_number() OVER (PARTITION BY a.word ORDER BY {cos('a.vector', 'b.vector')} DESC, b.word) = 1"""
    ranked = " UNION ALL ".join(f"""SELECT '{name}' AS model, x.word AS seed, y.word, row_number() OVER (
        PARTITION BY x.word ORDER BY {cos('x.vector', 'y.vector')} DESC, y.word) AS r
      FROM {name} x JOIN {name} y ON y.word <> x.word JOIN seeds s ON s.word = x.word""" for name in ("vectors", "half"))
    sql["negation_neighbours"] = f"""WITH {VECTORS}, {HALF.lstrip()},
      seeds AS (SELECT word FROM vectors WHERE vec_id % 10 = 0
                UNION ALL SELECT 'w' || (max(vec_id) + 1) FROM embeddings),
      best AS MATERIALIZED (SELECT * FROM ({ranked}) WHERE r <= 5),
      common AS (SELECT a.seed, greatest(a.r, b.r) AS depth FROM best a JOIN best b USING (seed, word)
                 WHERE a.model = 'vectors' AND b.model = 'half')
      SELECT s.word AS seed, count(depth) AS shared,
        round(coalesce(sum(list_sum(list_transform(range(depth, 6), lambda d: 1.0 / d))), 0.0) / 5, 9)::DOUBLE AS overlap
      FROM seeds s LEFT JOIN common c ON c.seed = s.word GROUP BY s.word"""
    probes = f"""{SLOTS}, probe AS MATERIALIZED (SELECT kind, a, CASE WHEN b LIKE '%3' THEN b || 'x' ELSE b END AS b
        FROM pairs),
      asked AS (SELECT a AS word FROM probe UNION SELECT b FROM probe),
      unknown AS (SELECT word FROM asked WHERE word NOT IN (SELECT word FROM vectors)),
      composed AS MATERIALIZED (
        SELECT word, vector FROM vectors
        UNION ALL SELECT word, list(x ORDER BY i) FROM (
          SELECT word, i, avg(v[i]) AS x FROM (
            SELECT g.word, v.vector AS v, unnest(range(1, 65)) AS i
            FROM ({slots('unknown', 'word')}) g JOIN slot_vectors v USING (bucket)) GROUP BY word, i) GROUP BY word)"""
    sql["evaluate_subwords"] = f"""WITH {probes},
      m AS ({means('(' + pair_cosines('composed').replace('FROM pairs p', 'FROM probe p') + ')')}),
      cov AS (SELECT label, sum(CASE WHEN vec_id % 5 <> 0 THEN cnt ELSE 0 END) / sum(cnt)::DOUBLE AS c
              FROM vectors GROUP BY label)
      SELECT round(syn, 6) AS syn_mean, round(ant, 6) AS ant_mean, round(syn - ant, 6) AS separation,
        (SELECT round(avg(c), 6) FROM cov) AS coverage FROM m"""
    sql["subword_membership"] = f"""WITH {SLOTS},
      words AS (SELECT word FROM vectors UNION SELECT word || 'x' FROM vectors
                UNION SELECT 'q' || repeat('z', cnt::INT) FROM vectors),
      filled AS (SELECT DISTINCT word FROM ({slots('words', 'word')}) JOIN slot_vectors USING (bucket))
      SELECT word, word IN (SELECT word FROM vectors) AS in_vocab,
        word IN (SELECT word FROM vectors) OR word IN (SELECT word FROM filled) AS has_vector FROM words"""
    sql["bucket_table"] = f"WITH {SLOTS} SELECT bucket::INT AS bucket, words, {VECTOR_SUMS} FROM slot_vectors"
    sql["ngram_table"] = f"WITH {GRAMS} SELECT ngram, words, {VECTOR_SUMS} FROM gram_vectors"
    sql["subword_oov"] = f"WITH {GRAMS} SELECT word, ngrams, {VECTOR_SUMS} FROM unknown_vectors"
    sql["evaluation_record"] = f"""WITH {DOC_TOKENS}, {VECTORS.lstrip()},
      m AS ({means('(' + pair_cosines() + ')')})
      SELECT round(syn, 6) AS syn_mean, round(ant, 6) AS ant_mean,
        round(coalesce(syn - ant, -1.0), 6) AS separation,
        (SELECT round(avg(coverage), 6) FROM ({covered('source')})) AS coverage FROM m"""
    sql["coverage_empty_source"] = f"""WITH {DOC_TOKENS}, {VECTORS.lstrip()},
      m AS ({means('(' + pair_cosines() + ')')}),
      left_in AS (SELECT * FROM tokens WHERE source <> 'src1'),
      known AS (SELECT token AS word FROM left_in GROUP BY token HAVING count(*) >= 3),
      cov AS (SELECT source, count(k.word)::DOUBLE / count(*) AS c
              FROM left_in s LEFT JOIN known k ON k.word = s.token GROUP BY source)
      SELECT round(syn, 6) AS syn_mean, round(ant, 6) AS ant_mean,
        round(coalesce(syn - ant, -1.0), 6) AS separation,
        (SELECT round(avg(coalesce(c, 0.0)), 6) FROM (SELECT DISTINCT source FROM clean_docs)
         LEFT JOIN cov USING (source)) AS coverage FROM m"""
    sql["best_trial"] = f"""WITH {VECTORS},
      sizes AS (SELECT DISTINCT trial, ceil(len(vector) * (trial + 1) / 4)::INT AS size
                FROM vectors, (SELECT unnest([0, 1, 2, 3]) AS trial)),
      cut AS (SELECT trial, size, kind, {cos('x.vector[1:size]', 'y.vector[1:size]')} AS c
              FROM pairs p JOIN vectors x ON x.word = p.a JOIN vectors y ON y.word = p.b, sizes),
      scored AS (
        SELECT trial, size AS vector_size, syn - ant + 0.2 * (SELECT count(x.word)::DOUBLE / count(*)
            FROM pairs LEFT JOIN vectors x ON x.word = pairs.b) AS score
        FROM (SELECT trial, size, avg(c) FILTER (WHERE kind = 'syn') AS syn,
                avg(c) FILTER (WHERE kind = 'ant') AS ant FROM cut GROUP BY trial, size))
      SELECT trial, vector_size, round(score, 6) AS score FROM scored
      ORDER BY scored.score DESC, trial LIMIT 1"""
    sql["model_compare"] = f"""WITH {GRAMS},
      composed AS MATERIALIZED (
        SELECT word, list(x ORDER BY i) AS vector FROM (
          SELECT word, i, avg(v[i]) AS x FROM (
            SELECT g.word, v.vector AS v, unnest(range(1, 65)) AS i
            FROM ({grams('vectors', 'word')}) g JOIN gram_vectors v USING (ngram))
          GROUP BY word, i) GROUP BY word),
      m AS ({means('(' + pair_cosines() + ')')}),
      n AS ({means('(' + pair_cosines('composed') + ')')}),
      cov AS (SELECT e.label::VARCHAR AS source, count(*)::DOUBLE AS n,
                count(x.word) / count(*)::DOUBLE AS c
              FROM embeddings e LEFT JOIN vectors x
                ON x.word = 'w' || (e.vec_id + 1) GROUP BY e.label)
      SELECT NULL::VARCHAR AS source, 'syn_mean' AS metric, round(m.syn, 6) AS plain,
             round(n.syn, 6) AS subword FROM m, n
      UNION ALL SELECT NULL, 'ant_mean', round(m.ant, 6), round(n.ant, 6) FROM m, n
      UNION ALL SELECT NULL, 'separation', round(m.syn - m.ant, 6), round(n.syn - n.ant, 6) FROM m, n
      UNION ALL SELECT NULL, 'coverage', (SELECT round(avg(c), 6) FROM cov),
                (SELECT round(avg(c), 6) FROM cov)
      UNION ALL SELECT source, 'coverage', round(c, 6), round(c, 6) FROM cov"""
    five = f"""{DOC_TOKENS}, five AS (
        SELECT token AS word, count(*) AS cnt FROM tokens GROUP BY token HAVING count(*) >= 5)"""
    sql["word2vec_vectors"] = f"WITH {five} SELECT word, 32 AS size, cnt FROM five"
    sql["word2vec_thinned"] = f"""WITH {DOC_TOKENS}
      SELECT token AS word, 8 AS size, count(*) AS cnt FROM tokens GROUP BY token HAVING count(*) >= 20"""
    sql["param_sweep"] = f"""WITH {five}, c AS (
        SELECT avg(cov) AS cov FROM (SELECT source, count(v.word)::DOUBLE / count(*) AS cov
          FROM tokens t LEFT JOIN five v ON v.word = t.token GROUP BY source))
      SELECT trial, 2 + 2 * trial AS "window", 32 AS vector_size, round(cov, 9) AS coverage
      FROM c, (SELECT unnest([0, 1]) AS trial)"""
    return sql
