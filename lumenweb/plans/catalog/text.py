"""Sentences, words and features of whole document texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumenweb.functions import language, text, tokenizers
from lumenweb.functions.fixed import LIMITS, OWN_TOKENIZERS, PUNCTUATION, SENTENCE_END, STANDARD_LANGUAGES, WORD_GAP
from lumenweb.operators import taxonomy
from lumenweb.operators.common import spread
from lumenweb.plans.catalog.base import query, table


def _q(x: str) -> str:
    return x.replace("'", "''")


SENT, GAP, MANY = _q(SENTENCE_END), _q(WORD_GAP), _q(SENTENCE_END[:-1] + "{2,}")
MARKS = "[" + ", ".join(f"'{_q(c)}'" for c in ["", *PUNCTUATION]) + "]"
SAYS = f"NOT list_contains({MARKS}, regexp_replace(x, '^\\s+|\\s+$', '', 'g'))"


def sql_tokens(x: str) -> str:
    """The oracle's token matrix."""
    first = f"list_filter(regexp_split_to_array({x}, '{SENT}'), lambda x: {SAYS})"
    cut = f"list_filter(flatten(list_transform({first}, lambda x: list_transform(range(0, length(x) // 100 + 1), lambda i: substr(x, i * 100 + 1, 100)))), lambda x: x <> '')"
    joined = f"list_filter(list_transform({cut}, lambda x: regexp_replace(x, '{MANY}', '.', 'g')), lambda x: {SAYS})"
    return f"list_transform({joined}, lambda s: list_transform(list_filter(regexp_split_to_array(s, '{GAP}'), lambda x: {SAYS}), lambda x: lower(x)))"


def docs(spark, d):
    return spread(table(spark, d, "documents").select("doc_id", "text", "lang"))


# Core and attribute words, roots and a vocabulary among the words that the documents have.
ROOTS = {"the": "the", "of": "of", "der": "the", "le": "the", "el": "the", "la": "the", "die": "the", "and": "and", "und": "and", "et": "and", "y": "and", "de": "of", "von": "of"}
TYPES = {"the": "core", "of": "attr", "and": "attr"}
WORDS = ["and", "of", "the", "in", "que"]


def known():
    return F.create_map(*[F.lit(x) for kv in ROOTS.items() for x in kv])


def type_map():
    return F.create_map(*[F.lit(x) for kv in TYPES.items() for x in kv])


SQL_ROOTS = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in ROOTS.items()) + "}"
TOKENS = f"t AS (SELECT doc_id, {sql_tokens('text')} AS tokens FROM documents)"
TRANSLATED = f"{TOKENS}, r AS (SELECT doc_id, list_transform(tokens, lambda s: list_transform(s, lambda w: coalesce({SQL_ROOTS}[w], w))) AS tokens FROM t)"


def tokens(spark, d):
    return docs(spark, d).select("doc_id", text.tokenize(F.col("text")).alias("tokens"))


def roots(spark, d):
    return tokens(spark, d).select("doc_id", text.translate_tokens(F.col("tokens"), known()).alias("tokens"))


@query("l03_l23_l42_sentences", f"SELECT doc_id, len(regexp_split_to_array(text, '{SENT}')) AS n, md5(array_to_string(regexp_split_to_array(text, '{SENT}'), '|')) AS digest FROM documents")
def sentences(spark, d):
    s = text.split_sentences(F.col("text"))
    return docs(spark, d).select("doc_id", F.size(s).cast("long").alias("n"), F.md5(F.array_join(s, "|")).alias("digest"))


@query("l04_words", f"SELECT doc_id, len(regexp_split_to_array(text, '{GAP}')) AS n, md5(array_to_string(regexp_split_to_array(text, '{GAP}'), '|')) AS digest FROM documents")
def words(spark, d):
    w = text.split_words(F.col("text"))
    return docs(spark, d).select("doc_id", F.size(w).cast("long").alias("n"), F.md5(F.array_join(w, "|")).alias("digest"))


@query("l05_tokenizer_table", "SELECT * FROM (VALUES " + ", ".join(f"('{g}', '{s}', '{w}')" for g, (s, w) in OWN_TOKENIZERS.items()) + ", " + ", ".join(f"('{g}', 'std', 'std')" for g in STANDARD_LANGUAGES) + ") t(lgg, sentence_tokenizer, word_tokenizer)")
def tokenizer_table(spark, d):
    return taxonomy.tokenizer_table(spark)


# Planted texts in languages with tokenizers of their own, and what becomes of them.
OWN = {"zh-cn": ("域名出售。请联系", "域|名|出|售;请|联|系"), "ja": ("カタカナと漢字", "カタカナ|と|漢字"), "th": ("ไทย", "ไ|ท|ย"), "hi": ("यह पेज। बंद है", "यह|पेज;बंद|है"), "ko": ("도메인 판매", "도메인|판매"), "vi": ("tên miền. bán", "tên|miền;bán"), "ar": ("نطاق للبيع", "نطاق|للبيع"), "en": ("For sale! Now, please", "for|sale;now|please")}
_LANGS = list(OWN)


@query("l05_l18_l30_l41_own_tokenizers", "SELECT doc_id, CASE doc_id % 8 " + " ".join(f"WHEN {i} THEN '{OWN[g][1]}'" for i, g in enumerate(_LANGS)) + " END AS tokens FROM documents")
def own_tokenizers(spark, d):
    planted = F.expr("CASE doc_id % 8 " + " ".join(f"WHEN {i} THEN '{OWN[g][0]}'" for i, g in enumerate(_LANGS)) + " END")
    lang = F.expr("CASE doc_id % 8 " + " ".join(f"WHEN {i} THEN '{g}'" for i, g in enumerate(_LANGS)) + " END")
    matrix = tokenizers.tokenize(planted, lang)
    return docs(spark, d).select("doc_id", F.array_join(F.transform(matrix, lambda s: F.array_join(s, "|")), ";").alias("tokens"))


@query("l19_tokens", f"WITH {TOKENS} SELECT doc_id, len(tokens) AS n_sentences, len(flatten(tokens)) AS n_words, md5(array_to_string(list_transform(tokens, lambda s: array_to_string(s, '|')), ';')) AS digest FROM t")
def tokenized(spark, d):
    t = tokens(spark, d)
    return t.select("doc_id", F.size("tokens").cast("long").alias("n_sentences"), text.n_words(F.col("tokens")).cast("long").alias("n_words"), F.md5(F.array_join(F.transform("tokens", lambda s: F.array_join(s, "|")), ";")).alias("digest"))


@query("l20_cut_sentences", "SELECT doc_id, len(list_filter(list_transform(range(0, length(text) // 100 + 1), lambda i: substr(text, i * 100 + 1, 100)), lambda x: x <> '')) AS n FROM documents")
def cut(spark, d):
    return docs(spark, d).select("doc_id", F.size(text.cut_long(F.array("text"))).cast("long").alias("n"))


@query("l21_url_token", "SELECT doc_id, concat('see x_url or x_url! not a', doc_id, 'xb.com') AS text FROM documents")
def url_token(spark, d):
    planted = F.expr("concat('see WWW.A', doc_id, '.b.com or a', doc_id, '.B.com! not a', doc_id, 'xb.com')")
    return docs(spark, d).select("doc_id", text.url_token(planted, F.expr("concat('a', doc_id, '.b.com')")).alias("text"))


@query("l22_pair_tokens", "SELECT doc_id, concat('index_of x hello_world lorem_ipsum; no_website indexes', doc_id) AS text FROM documents")
def pair_tokens(spark, d):
    planted = F.expr("concat('Index of x hello. World LOREM  ipsum; no website indexes', doc_id)")
    return docs(spark, d).select("doc_id", text.pair_tokens(planted).alias("text"))


@query("a03_a04_unique_words", f"WITH {TOKENS} SELECT doc_id, len(list_distinct(flatten(tokens))) AS n FROM t")
def unique(spark, d):
    return tokens(spark, d).select("doc_id", text.n_unique_words(F.col("tokens")).cast("long").alias("n"))


@query("j11_translate", f"WITH {TRANSLATED} SELECT doc_id, md5(array_to_string(flatten(tokens), ' ')) AS digest FROM r")
def translated(spark, d):
    return roots(spark, d).select("doc_id", F.md5(F.array_join(F.flatten("tokens"), " ")).alias("digest"))


@query("l24_relevant_words", f"WITH {TOKENS} SELECT doc_id, len(f) AS n, array_to_string(list_transform(f[1:5], lambda w: {SQL_ROOTS}[w]), ' ') AS head FROM (SELECT doc_id, list_filter(flatten(tokens), lambda w: {SQL_ROOTS}[w] IS NOT NULL) AS f FROM t)")
def relevant(spark, d):
    found = tokens(spark, d).select("doc_id", text.relevant_words(F.col("tokens"), known()).alias("f"))
    return found.select("doc_id", F.size("f").cast("long").alias("n"), F.array_join(F.slice("f", 1, 5), " ").alias("head"))


@query("l25_vocabulary_counts", f"WITH {TRANSLATED}, w AS (SELECT doc_id, regexp_extract_all(lower(array_to_string(flatten(tokens), ' ')), '[\\pL\\pN_\\pM]+') AS w FROM r) SELECT doc_id, " + ", ".join(f"len(list_filter(w, lambda x: x = '{v}')) AS n_{v}" for v in WORDS) + " FROM w")
def counts(spark, d):
    c = roots(spark, d).select("doc_id", text.vocabulary_counts(F.col("tokens"), WORDS).alias("c"))
    return c.select("doc_id", *[F.col("c")[i].cast("long").alias(f"n_{v}") for i, v in enumerate(WORDS)])


_PAIRS = f"""WITH {TRANSLATED}, s AS (SELECT doc_id, unnest(tokens) AS s, generate_subscripts(tokens, 1) AS pos FROM r),
k AS (SELECT doc_id, pos, len(s) AS n, list_contains(s, 'the') AS c, list_contains(s, 'of') OR list_contains(s, 'and') AS a FROM s),
l AS (SELECT *, coalesce(lag(c) OVER w, false) AS pc, coalesce(lag(a) OVER w, false) AS pa FROM k WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
m AS (SELECT doc_id, n, c AND a AS same, NOT (c AND a) AND (a AND pc OR pa AND c) AS next FROM l)
SELECT r.doc_id, coalesce(count(*) FILTER (same), 0) AS n_pair_same, coalesce(count(*) FILTER (next), 0) AS n_pair_successive, coalesce(min(n) FILTER (same), 1000) AS min_sent_size_same, coalesce(min(n) FILTER (next), 1000) AS min_sent_size_successive FROM r LEFT JOIN m ON r.doc_id = m.doc_id GROUP BY r.doc_id"""


@query("w01_pair_features", _PAIRS)
def pairs(spark, d):
    found = roots(spark, d).select("doc_id", text.pair_features(F.col("tokens"), type_map()).alias("p"))
    return found.select("doc_id", *[F.col(f"p.{k}").cast("long").alias(k) for k in ("n_pair_same", "n_pair_successive", "min_sent_size_same", "min_sent_size_successive")])


@query("l26_l27_l28_features")
def features(spark, d):
    rows = docs(spark, d).select("doc_id", "text", F.lit("").alias("url"))
    out = text.with_features(rows, "text", F.col("url"), WORDS, TYPES, known())
    return out.select("doc_id", F.array_join("text_feat", " ").alias("counts"), "n_sentences", "n_words", "n_unique_words", "n_pair_same", "n_pair_successive", "min_sent_size_same", "min_sent_size_successive")


@query("l29_plain_words", f"SELECT doc_id, len(list_filter(regexp_split_to_array(lower(text), '{GAP}'), lambda x: x <> '')) AS n FROM documents")
def plain_words(spark, d):
    return docs(spark, d).select("doc_id", F.size(F.array_remove(text.split_words(F.lower("text")), "")).cast("long").alias("n"))


@query("a05_class_counts", f"WITH {TRANSLATED}, w AS (SELECT doc_id, list_distinct(regexp_extract_all(lower(array_to_string(flatten(tokens), ' ')), '[\\pL\\pN_\\pM]+')) AS w FROM r) SELECT doc_id, CAST(list_contains(w, 'and') AS BIGINT) + CAST(list_contains(w, 'in') AS BIGINT) AS sale, CAST(list_contains(w, 'of') AS BIGINT) AS expired, CAST(0 AS BIGINT) AS blocked FROM w")
def classes(spark, d):
    c = roots(spark, d).select("doc_id", text.vocabulary_counts(F.col("tokens"), WORDS).alias("c"))
    found = text.class_counts(F.col("c"), WORDS, {"and": "sale", "in": "sale", "of": "expired"})
    return c.select("doc_id", *[found[k].cast("long").alias(k) for k in ("sale", "expired", "blocked")])


@query("l01_l02_language", "SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'en' WHEN 1 THEN 'de' WHEN 2 THEN 'ru' ELSE 'other' END AS language FROM documents")
def languages(spark, d):
    planted = F.expr("CASE doc_id % 4 WHEN 0 THEN 'This is the page of a company and it is for you. Welcome!' WHEN 1 THEN 'Das ist die Seite der Firma und sie ist nicht fertig.' WHEN 2 THEN 'Домен продается сегодня очень дешево.' ELSE 'abc' END")
    return docs(spark, d).select("doc_id", language.detect(planted).alias("language"))


@query("l01_language_of_all_documents")
def detected(spark, d):
    return docs(spark, d).select("doc_id", "lang", language.detect(F.col("text")).alias("detected"))


assert LIMITS["sentence"] == 100  # as the oracles have it
