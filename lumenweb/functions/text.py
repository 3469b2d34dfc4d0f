"""Sentences, words and features of page texts, as expressions on arrays.

A token matrix is an array of sentences, each an array of words. Everything stays in the JVM but for languages with a
tokenizer of their own, see ``tokenizers``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenweb.functions.fixed import LIMITS, PUNCTUATION, SENTENCE_END, TOKEN_PAIRS, WORD_CLASSES, WORD_GAP


def let(value: Column, body) -> Column:
    """body(value), with value computed once a row."""
    return F.transform(F.array(value), body)[0]


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+\z", "")


def split_sentences(text: Column) -> Column:
    return F.split(text, SENTENCE_END)


def split_words(sentence: Column) -> Column:
    return F.split(sentence, WORD_GAP)


#: Nothing, or one mark, between white space.
_NOTHING = r"(?U)\A\s*(?:[" + "".join("\\" + c if c.isascii() else c for c in PUNCTUATION) + r"]\s*)?\z"


def _says_something(text: Column) -> Column:
    """The first test is right for nearly every word, and is over at its first letter."""
    return text.rlike(r"[\p{L}\p{N}]") | ~text.rlike(_NOTHING)


def cut_long(sentences: Column, size: int = LIMITS["sentence"]) -> Column:
    """Sentences in pieces of at most size characters."""
    return F.flatten(F.transform(sentences, lambda s: F.regexp_extract_all(s, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))))


def url_token(text: Column, url: Column) -> Column:
    """The page's own name becomes x_url. The name is taken literally; an empty one changes nothing."""
    quoted = F.regexp_replace(url, r"([^\p{L}\p{N}_])", r"\\$1")
    pattern = F.concat(F.lit(r"(?iu)(www\.)?"), quoted)
    return F.when(F.coalesce(url, F.lit("")) == "", text).otherwise(F.regexp_replace(text, pattern, F.lit("x_url")))


def pair_tokens(text: Column) -> Column:
    """Two words that mean one thing become one token."""
    for pair in TOKEN_PAIRS:
        a, b = pair.split()
        text = F.regexp_replace(text, f"(?iu){a}[ .]+{b}", f"{a}_{b}")
    return text


def clean_sentences(sentences: Column) -> Column:
    """Sentences that say something, cut to size, with piled up separators made one."""
    kept = cut_long(F.filter(sentences, _says_something))
    return F.filter(F.transform(kept, lambda s: F.regexp_replace(s, SENTENCE_END[:-1] + "{2,}", ".")), _says_something)


def clean_words(words: Column) -> Column:
    return F.transform(F.filter(words, _says_something), F.lower)


def tokenize(text: Column) -> Column:
    """The standard token matrix; null for null."""
    return F.transform(clean_sentences(split_sentences(text)), lambda s: clean_words(split_words(s)))


def translate_tokens(tokens: Column, known: Column) -> Column:
    """Words that the map knows are replaced by their roots."""
    return F.transform(tokens, lambda s: F.transform(s, lambda w: F.coalesce(F.try_element_at(known, w), w)))


def n_words(tokens: Column) -> Column:
    return F.aggregate(tokens, F.lit(0), lambda n, s: n + F.size(s))


def n_unique_words(tokens: Column) -> Column:
    return F.size(F.array_distinct(F.flatten(tokens)))


def relevant_words(tokens: Column, known: Column) -> Column:
    """The roots of words that the map knows, in order."""
    return F.transform(F.filter(F.flatten(tokens), lambda w: F.map_contains_key(known, w)), lambda w: F.element_at(known, w))


def retokenize(tokens: Column) -> Column:
    """The words of two and more word characters in the joined tokens, as a count vectorizer sees them."""
    return F.regexp_extract_all(F.lower(F.array_join(F.flatten(tokens), " ")), F.lit(r"(?U)\b\w\w+\b"), F.lit(0))


def vocabulary_counts(tokens: Column, vocabulary: list[str]) -> Column:
    """How often each vocabulary word occurs, in the vocabulary's order; one pass over the words."""
    index = F.create_map(*[x for i, w in enumerate(vocabulary) for x in (F.lit(w), F.lit(i))])
    found = F.filter(F.transform(retokenize(tokens), lambda w: F.try_element_at(index, w)), lambda i: i.isNotNull())
    return let(found, lambda at: F.transform(F.sequence(F.lit(0), F.lit(len(vocabulary) - 1)), lambda i: F.size(F.filter(at, lambda x: x == i))))


def pair_features(tokens: Column, types: Column, known: Column | None = None) -> Column:
    """struct(n_pair_same, n_pair_successive, min_sent_size_same, min_sent_size_successive).

    types: word to core or attr. A sentence with a core and an attribute word is a pair of its own; one whose partner
    stands in the sentence before is a successive pair. known: only words that are keys of this map count.
    """

    def count(s: Column, kind: str) -> Column:
        right = lambda w: F.coalesce(F.try_element_at(types, w) == kind, F.lit(False)) & (F.lit(True) if known is None else F.map_contains_key(known, w))
        return F.exists(s, right)

    marked = F.transform(tokens, lambda s: F.struct(count(s, "core").alias("c"), count(s, "attr").alias("a"), F.size(s).alias("n")))
    none = F.lit(LIMITS["no_pair"])
    start = F.struct(F.lit(0).alias("same"), F.lit(0).alias("next"), none.alias("min_same"), none.alias("min_next"), F.lit(False).alias("c"), F.lit(False).alias("a"))

    def step(z: Column, s: Column) -> Column:
        same = s["c"] & s["a"]
        following = ~same & ((s["a"] & z["c"]) | (z["a"] & s["c"]))
        return F.struct(
            (z["same"] + same.cast("int")).alias("same"), (z["next"] + following.cast("int")).alias("next"),
            F.when(same, F.least(z["min_same"], s["n"])).otherwise(z["min_same"]).alias("min_same"),
            F.when(following, F.least(z["min_next"], s["n"])).otherwise(z["min_next"]).alias("min_next"), s["c"].alias("c"), s["a"].alias("a"),
        )

    done = lambda z: F.struct(z["same"].alias("n_pair_same"), z["next"].alias("n_pair_successive"), z["min_same"].alias("min_sent_size_same"), z["min_next"].alias("min_sent_size_successive"))
    return F.aggregate(marked, start, step, done)


def class_counts(counts: Column, vocabulary: list[str], classes: dict[str, str]) -> dict[str, Column]:
    """For each word class how many different vocabulary words of it are present."""
    out = {}
    for name in WORD_CLASSES:
        own = [i for i, w in enumerate(vocabulary) if classes.get(w) == name]
        out[name] = sum(((F.get(counts, F.lit(i)) > 0).cast("int") for i in own), F.lit(0)) if own else F.lit(0)
    return {k: F.coalesce(v, F.lit(0)) for k, v in out.items()}


def with_features(df: DataFrame, text: str, url_domain: Column, vocabulary: list[str], types: dict[str, str], known: Column) -> DataFrame:
    """df with tokens and every feature of a page's text: counts are zero for pages of three words and less."""
    type_map = F.create_map(*[F.lit(x) for kv in types.items() for x in kv])
    out = df.withColumn("tokens", translate_tokens(tokenize(pair_tokens(url_token(F.col(text), url_domain))), known))
    out = out.withColumns({"n_sentences": F.coalesce(F.size("tokens"), F.lit(0)), "n_words": F.coalesce(n_words(F.col("tokens")), F.lit(0)), "n_unique_words": F.coalesce(n_unique_words(F.col("tokens")), F.lit(0)), "_pairs": pair_features(F.col("tokens"), type_map, known)})
    counted = (F.col("n_sentences") > 0) & (F.col("n_words") > LIMITS["ml_words"])
    zero = F.array_repeat(F.lit(0), len(vocabulary))
    out = out.withColumn("text_feat", F.coalesce(F.when(counted, vocabulary_counts(F.col("tokens"), vocabulary)), zero))
    return out.select("*", "_pairs.*").drop("_pairs")


def detection_text(text: Column) -> Column:
    """What language detection looks at: without digits at the beginning, 3000 characters of sentences of over four."""
    head = F.substring(F.ltrim(text, F.lit("0123456789")), 1, 3000)
    kept = F.filter(F.regexp_extract_all(head, F.lit(r"([^?.!]*)([?.!]|\z)"), F.lit(0)), lambda s: F.length(F.regexp_replace(s, r"[?.!]\z", "")) > 4)
    return F.when(F.length(text) > 10, F.array_join(kept, ""))


def trim_stop_words(phrase: Column, stop_words: list[str]) -> Column:
    """Stop words at both ends cut, again and again."""
    words = "|".join(re.escape(w) for w in stop_words)
    if not words:
        return phrase
    return strip(F.regexp_replace(phrase, rf"(?iu)^\s*((?:{words})(?=\s|\z)\s*)+|(\s*(?<=\s|^)(?:{words}))+\s*\z", ""))
