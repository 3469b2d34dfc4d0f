"""Tokenizers by language, as plug-ins.

The standard tokenizer is expressions (see text). A language with one of its own goes through Python; what isn't
registered falls back: to one token a character for Chinese and Thai, to runs of one script for Japanese, to the danda
marks for sentences of Indic languages, and to the standard splits elsewhere. ``register`` puts any other in place.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from lumenweb.functions import text
from lumenweb.functions.fixed import OWN_TOKENIZERS, PUNCTUATION, SENTENCE_END, WORD_GAP, LIMITS

_SENTENCE, _WORD = re.compile(SENTENCE_END), re.compile(WORD_GAP)
_REPEATED = re.compile(SENTENCE_END[:-1] + "{2,}")
_MARKS = set(PUNCTUATION)


def standard_sentences(s: str) -> list[str]:
    return _SENTENCE.split(s)


def standard_words(s: str) -> list[str]:
    return _WORD.split(s)


def danda_sentences(s: str) -> list[str]:
    return re.split(r"[।॥?!.|\n]+", s)


def line_sentences(s: str) -> list[str]:
    """Thai has no marks at the end of sentences: lines and wide gaps."""
    return re.split(r"\n+| {2,}|" + SENTENCE_END, s)


def character_words(s: str) -> list[str]:
    """Letters of scripts without gaps one by one, others as words."""
    return re.findall(r"[㐀-鿿豈-﫿฀-๿]|[^\W㐀-鿿豈-﫿฀-๿]+", s)


def script_words(s: str) -> list[str]:
    """Runs of kanji, hiragana, katakana and other letters."""
    return re.findall(r"[㐀-鿿豈-﫿々]+|[぀-ゟ]+|[゠-ヿー]+|[^\W㐀-鿿豈-﫿々぀-ヿ]+", s)


def marked_words(s: str) -> list[str]:
    """Words with their vowel signs and joiners."""
    return re.findall(r"[\ẁ-֑ͯ-ׇؐ-ًؚ-ٰٟۖ-ۭऀ-෿‌‍'’-]+", s)


SENTENCES: dict[str, Callable[[str], list[str]]] = {"std": standard_sentences, "th": line_sentences, "vi": standard_sentences, "fa": standard_sentences} | dict.fromkeys(("bn", "hi", "mr", "te"), danda_sentences)
WORDS: dict[str, Callable[[str], list[str]]] = {"std": standard_words, "chn": character_words, "th": character_words, "ja": script_words, "ko": standard_words, "vi": standard_words} | dict.fromkeys(("ar", "bn", "fa", "gu", "he", "hi", "kn", "ml", "mr", "ne", "pa", "ta", "ur"), marked_words)


def register(kind: str, name: str, tokenizer: Callable[[str], list[str]]) -> None:
    """kind: sentences or words; name: an id of the dispatch table. The callable must be picklable."""
    {"sentences": SENTENCES, "words": WORDS}[kind][name] = tokenizer


def ids_of(language: str | None) -> tuple[str, str]:
    return OWN_TOKENIZERS.get(language or "", ("std", "std"))


def tokenize_text(s: str | None, language: str | None, sentences=None, words=None) -> list[list[str]] | None:
    """The token matrix of one text; a tokenizer that fails is replaced by the standard one."""
    if s is None:
        return None
    by_sentence, by_word = ids_of(language)

    def safe(tokenizer, standard, value):
        try:
            return tokenizer(value)
        except Exception:  # a plug-in's failure is not the page's
            return standard(value)

    told = lambda x: x.strip() and x.strip() not in _MARKS
    parts = [x for x in safe((sentences or SENTENCES)[by_sentence], standard_sentences, s) if told(x)]
    size = LIMITS["sentence"]
    parts = [_REPEATED.sub(".", x[i : i + size]) for x in parts for i in range(0, len(x), size)]
    return [[w.lower() for w in safe((words or WORDS)[by_word], standard_words, x) if told(w)] for x in parts if told(x)]


def tokenize(s: Column, language: Column) -> Column:
    """The token matrix by each row's language."""
    sentences, words = dict(SENTENCES), dict(WORDS)

    @F.pandas_udf("array<array<string>>")
    def own(texts: pd.Series, languages: pd.Series) -> pd.Series:
        return pd.Series([tokenize_text(t, g, sentences, words) for t, g in zip(texts, languages, strict=True)])

    special = language.isin(*OWN_TOKENIZERS)
    # Rows of other languages send no text to Python.
    return F.when(special, own(F.when(special, s), language)).otherwise(text.tokenize(s))
