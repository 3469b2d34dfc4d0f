"""The vocabulary of parking words: reading, building and cleaning its table; words to roots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenweb.functions.fixed import OWN_TOKENIZERS, SHORT_WORDS, STANDARD_LANGUAGES, UNIQUE_WORDS
from lumenweb.operators.common import small, true

SCHEMA = "form string, root string, to_derive string, to_translate string, word string, context string, lgg string, trs_direct string, word_type string, end_class string"


def translations(taxonomy: DataFrame) -> DataFrame:
    """(lgg, word, root): of each language, and of all together as ``other``. A word with several roots has the last in the alphabet."""
    rows = taxonomy.where("trs_direct is not null and root is not null").select("lgg", F.lower("trs_direct").alias("word"), F.lower("root").alias("root"))
    both = rows.union(rows.select(F.lit("other").alias("lgg"), "word", "root"))
    return both.groupBy("lgg", "word").agg(F.max("root").alias("root"))


def word_table(taxonomy: DataFrame) -> DataFrame:
    """(root, word_type, end_class): the roots, and the words of no language."""
    rows = taxonomy.where("root is not null").groupBy(F.lower("root").alias("root")).agg(F.max("word_type").alias("word_type"), F.max("end_class").alias("end_class"))
    unique = taxonomy.sparkSession.createDataFrame(UNIQUE_WORDS, "root string, word_type string, end_class string")
    return rows.join(unique.select("root"), "root", "left_anti").unionByName(unique)


def vocabulary(taxonomy: DataFrame) -> list[str]:
    """Sorted distinct roots, then the unique words. A vocabulary is some hundred words."""
    roots = [r["root"] for r in taxonomy.where("root is not null").select(F.lower("root").alias("root")).distinct().collect()]
    unique = [w for w, _, _ in UNIQUE_WORDS]
    return sorted(set(roots) - set(unique)) + unique


def language_map(taxonomy: DataFrame) -> DataFrame:
    """(lgg, known): a map of words to roots for each language, to be joined by broadcast."""
    return translations(taxonomy).groupBy("lgg").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("word", "root")))).alias("known"))


def with_language_map(df: DataFrame, taxonomy: DataFrame, language: str = "language") -> DataFrame:
    """df with the map of its language, or that of other languages."""
    maps = language_map(taxonomy)
    known = [r["lgg"] for r in maps.select("lgg").collect()]
    key = F.when(F.col(language).isin(*known), F.col(language)).otherwise("other")
    return df.withColumn("_lgg", key).join(small(maps.withColumnRenamed("lgg", "_lgg"), 1000), "_lgg", "left").drop("_lgg").withColumn("known", F.coalesce("known", F.create_map().cast("map<string,string>")))


def translate_words(words: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """words: (lgg, word). With root: the translation, or the word itself. Languages without translations use those of all."""
    known = translations(taxonomy)
    languages = known.select(F.col("lgg").alias("_l")).distinct()
    keyed = words.join(small(languages), F.col("lgg") == F.col("_l"), "left").withColumn("_l", F.coalesce("_l", F.lit("other")))
    joined = keyed.join(small(known.select(F.col("lgg").alias("_l"), "word", F.col("root").alias("_root"))), ["_l", "word"], "left")
    return joined.withColumn("root", F.coalesce("_root", "word")).select(*words.columns, "root")


def tokenizer_table(spark) -> DataFrame:
    """(lgg, sentence_tokenizer, word_tokenizer) of every known language."""
    rows = [(g, "std", "std") for g in STANDARD_LANGUAGES] + [(g, s, w) for g, (s, w) in OWN_TOKENIZERS.items()]
    return spark.createDataFrame(sorted(rows), "lgg string, sentence_tokenizer string, word_tokenizer string")


def melt(wide: DataFrame, keys: list[str]) -> DataFrame:
    """A column for each language to rows (keys, lgg, trs_direct), sorted."""
    return wide.unpivot(keys, [c for c in wide.columns if c not in keys], "lgg", "trs_direct").orderBy("lgg", *keys)


def merge_translations(direct: DataFrame, context: DataFrame, double: DataFrame) -> DataFrame:
    """Three results of translating, side by side by index."""
    return direct.join(context, "index", "full_outer").join(double, "index", "full_outer")


def add_word_features(first: DataFrame, second: DataFrame, roots: DataFrame) -> DataFrame:
    """Two taxonomies as one, with type and class of each root. A root without a type is an error."""
    both = first.unionByName(second, allowMissingColumns=True).drop("word_type", "end_class")
    out = both.join(small(roots.select("root", "word_type", "end_class")), "root", "left")
    return out.withColumn("word_type", F.coalesce("word_type", F.raise_error(F.concat(F.lit("no word type for root "), F.coalesce("root", F.lit("null")))).cast("string")))


def is_short(language: Column, word: Column) -> Column:
    """Translations too short to mean anything, by language."""
    limit = F.lit(None).cast("int")
    for n, languages in SHORT_WORDS.items():
        limit = F.coalesce(limit, F.when(language.isin(*languages), n))
    return F.coalesce(F.length(word) <= limit, F.lit(False))


def clear(taxonomy: DataFrame) -> DataFrame:
    return taxonomy.where(~is_short(F.col("lgg"), F.col("trs_direct")))


def derived(roots: DataFrame, forms: DataFrame) -> DataFrame:
    """(root, word): each root with its forms; one without has itself. forms: (root, word), from any word-form table."""
    return roots.select("root").distinct().join(small(forms), "root", "left").select("root", F.coalesce("word", "root").alias("word")).distinct()


def own(spark) -> DataFrame:
    """A small taxonomy of our own, in the same shape, for pages in six languages."""
    rows = []
    for line in OWN_WORDS.strip("\n").split("\n"):
        root, kind, end_class, *words = (x.strip() for x in line.split("|"))
        for language, word in (x.split(":") for x in words[0].split()):
            rows.append(("n", root, "no", "yes", root, "", language, word, kind, end_class))
    return spark.createDataFrame(rows, SCHEMA)


#: root | type | class | translations (language:word).
OWN_WORDS = """
domain | core | other | en:domain en:domains de:domain fr:domaine es:dominio it:dominio sv:domän
site | core | other | en:site en:website de:webseite fr:site es:sitio it:sito sv:webbplats
page | core | other | en:page de:seite fr:page es:página it:pagina sv:sida
hosting | core | other | en:hosting de:hosting fr:hébergement es:alojamiento it:hosting sv:webbhotell
sale | attr | sale | en:sale en:buy de:verkauf fr:vente es:venta it:vendita sv:salu
construction | attr | construction | en:construction de:aufbau fr:construction es:construcción it:costruzione sv:uppbyggnad
soon | attr | construction | en:soon de:bald fr:bientôt es:pronto it:presto sv:snart
expired | attr | expired | en:expired de:abgelaufen fr:expiré es:caducado it:scaduto sv:utgången
blocked | attr | blocked | en:blocked de:gesperrt fr:bloqué es:bloqueado it:bloccato sv:blockerad
reserved | attr | reserved | en:reserved de:reserviert fr:réservé es:reservado it:riservato sv:reserverad
parked | attr | other | en:parked de:geparkt fr:parking es:estacionado it:parcheggiato sv:parkerad
registered | attr | other | en:registered de:registriert fr:enregistré es:registrado it:registrato sv:registrerad
default | attr | starter | en:default de:standard fr:défaut es:defecto it:predefinita sv:standard
"""


def derive(words: DataFrame, forms: DataFrame) -> DataFrame:
    """words: (root, to_derive, to_translate); forms: (root, form, word), a table of word forms from wherever. Roots that are to be derived become their forms, others stay as they are; a root without forms is lost."""
    yes = F.col("to_derive") == "yes"
    derived = words.where(yes).join(forms.select("root", "form", "word").distinct(), "root")
    kept = words.where(~true(yes)).withColumns({"word": F.col("root"), "form": F.lit(None).cast("string")})
    return derived.unionByName(kept).select("root", "word", "form", "to_derive", "to_translate")


def translate_table(words: DataFrame, languages: list[str], found: DataFrame) -> DataFrame:
    """words with a row for each language, and its translation: found has (word, lgg, trs), from a translator that ran elsewhere. What it has no answer for is null; a word that is not to be translated is itself."""
    asked = words.withColumn("lgg", F.explode(F.array(*[F.lit(x) for x in languages])))
    got = asked.join(found.select("word", "lgg", "trs").dropDuplicates(["word", "lgg"]), ["word", "lgg"], "left")
    return got.withColumn("trs", F.when(F.col("to_translate") == "yes", F.col("trs")).otherwise(F.col("word")))
