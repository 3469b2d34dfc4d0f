"""Tokenizers of other packages, as optional plug-ins: ``install`` registers those whose package is there.

Each plug-in makes its tokenizer in the process that uses it, on the first text, and is a plain object until then, so that
it can be sent to executors. Where a package is missing the offline fallback of ``tokenizers`` stays in place, and a
package that fails on a text gives way to the standard tokenizer for that text.
"""

from __future__ import annotations

import importlib
import importlib.util
from collections.abc import Callable

from lumenweb.functions import tokenizers

_made: dict[tuple, Callable[[str], list[str]]] = {}


def _function(package: str, name: str, *_) -> Callable:
    return getattr(importlib.import_module(package), name)


def _method(package: str, cls: str, method: str, *args) -> Callable:
    return getattr(getattr(importlib.import_module(package), cls)(*args), method)


def _fields(package: str, name: str, place: int) -> Callable:
    """A function that yields tuples, of which one field is the word."""
    f = getattr(importlib.import_module(package), name)
    return lambda s: [x[place] for x in f(s)]


class Plugin:
    """make(package, *args) gives the tokenizer."""

    def __init__(self, make: Callable, package: str, *args):
        self.key = (make, package, *args)

    @property
    def package(self) -> str:
        return self.key[1].split(".")[0]

    def __call__(self, s: str) -> list[str]:
        if self.key not in _made:
            make, *args = self.key
            _made[self.key] = make(*args)
        return list(_made[self.key](s))


_INDIC = ("hi", "pa", "gu", "kn", "ml", "mr", "bn", "ta", "ur", "ne")
#: By kind and by id of the dispatch table.
KNOWN: dict[str, dict[str, Plugin]] = {
    "words": {
        "chn": Plugin(_fields, "jieba", "tokenize", 0),
        "ja": Plugin(_method, "tinysegmenter", "TinySegmenter", "tokenize"),
        "ko": Plugin(_method, "soynlp.tokenizer", "MaxScoreTokenizer", "tokenize"),
        "th": Plugin(_function, "pythainlp", "word_tokenize"),
        "vi": Plugin(_function, "underthesea", "word_tokenize"),
        "fa": Plugin(_function, "hazm", "word_tokenize"),
        "ar": Plugin(_method, "cltk.tokenize.word", "WordTokenizer", "tokenize", "arabic"),
        "he": Plugin(_fields, "hebrew_tokenizer", "tokenize", 1),
        **{k: Plugin(_method, "inltk.tokenizer", "IndicTokenizer", "tokenizer", k) for k in _INDIC},
    },
    "sentences": {
        "th": Plugin(_function, "pythainlp", "sent_tokenize"),
        "vi": Plugin(_function, "underthesea", "sent_tokenize"),
        "fa": Plugin(_function, "hazm", "sent_tokenize"),
        **{k: Plugin(_method, "cltk.tokenize.sentence", "TokenizeSentence", "tokenize", n) for k, n in (("bn", "bengali"), ("hi", "hindi"), ("te", "telugu"), ("mr", "marathi"))},
    },
}


def found(package: str) -> bool:
    return importlib.util.find_spec(package) is not None


def install(there: Callable[[str], bool] = found) -> list[tuple[str, str]]:
    """Registers what is there; returns (kind, id) of each one."""
    put = [(kind, name, p) for kind, all_ in KNOWN.items() for name, p in all_.items() if there(p.package)]
    for kind, name, p in put:
        tokenizers.register(kind, name, p)
    return [(kind, name) for kind, name, _ in put]
