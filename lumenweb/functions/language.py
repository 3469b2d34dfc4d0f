"""Language detection that always gives the same answer: shares of common words and of characters that are telling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lumenweb.functions.text import detection_text, let

#: Common words; a parameter of ``detect``.
COMMON = {
    "en": "the of and to in is that for it with as was on are by this be from at or an",
    "de": "der die und das ist nicht ein eine mit von zu den auf für im dem sich auch es als",
    "fr": "le la les des et est une dans pour que qui pas sur avec au par un du ce plus",
    "es": "el los las una por con para que es del se como más pero su al un lo no y",
    "it": "il che di per una sono con del non alla della gli nel dei anche come si è",
    "sv": "och att det som på är av för den med inte ett till har om vi kan",
    "da": "og det at er på af for den til med ikke som der har vi kan et",
    "et": "ja on et ei see mis oma kui ning või ka aga seda selle",
    "sk": "je na sa že to so ako pre ale aj alebo ktorý sú podľa",
}
#: Scripts of one language each.
SCRIPTS = {"zh-cn": r"[一-鿿]", "ja": r"[぀-ヿ]", "ko": r"[가-힣]", "ru": r"[Ѐ-ӿ]", "el": r"[Ͱ-Ͽ]", "ar": r"[؀-ۿ]", "he": r"[֐-׿]", "th": r"[฀-๿]", "hi": r"[ऀ-ॿ]"}


def detect(text: Column, common: dict[str, str] | None = None) -> Column:
    """A language code, or other: for short texts, and where nothing tells. Ties go to the first in the alphabet."""
    kinds = common or COMMON
    alphabet = sorted({*kinds, *SCRIPTS})
    score = lambda n, g: F.struct(n.alias("n"), F.lit(-alphabet.index(g)).alias("turn"), F.lit(g).alias("g"))
    telling = "[" + "".join(s[1:-1] for s in SCRIPTS.values()) + "]"

    def by_words(words: Column) -> list[Column]:
        return [score(F.size(F.filter(words, lambda w: w.isin(*c.split()))), g) for g, c in kinds.items()]

    def by_script(head: Column) -> Column:
        """None of the scripts is searched for in a text that has a letter of none."""
        found = [score((2 * F.length(F.regexp_replace(head, "[^" + s[1:], "")) / 3).cast("int"), g) for g, s in SCRIPTS.items()]
        return F.when(head.rlike(telling), F.array_max(F.array(*found))).otherwise(score(F.lit(0), alphabet[-1]))

    def best(head: Column) -> Column:
        words = F.array_remove(F.split(head, r"(?U)[^\p{L}]+"), "")
        return F.greatest(let(words, lambda w: F.array_max(F.array(*by_words(w)))), by_script(head))

    # The text that is looked at, its words and the best score are each made once a row, not once for each language.
    head = F.lower(F.coalesce(detection_text(text), F.lit("")))
    return let(let(head, best), lambda x: F.when(x["n"] > 0, x["g"]).otherwise("other"))
