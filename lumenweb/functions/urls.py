"""URL and link functions: Column to Column, each with one reference to its input, so that chains stay small."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from lumenweb.functions.fixed import ACCOUNT, NETWORKS

# What is cut from the beginning of a link, in this order, each once.
PREFIXES = ("https://www.", "http://www.", "https://", "http://", "//", "www.")
#: Public suffixes of two labels; a parameter of registered_name.
TWO_LABEL_SUFFIXES = ("ac.uk", "co.in", "co.jp", "co.kr", "co.nz", "co.uk", "co.za", "com.au", "com.br", "com.cn", "com.mx", "com.tr", "gov.uk", "ne.jp", "net.au", "or.jp", "org.au", "org.uk")


def strip_dot(url: Column) -> Column:
    """Without one dot at its end."""
    return F.regexp_replace(url.cast("string"), r"\.\z", "")


def has_domain(url: Column) -> Column:
    """True if a dot is in it; false for null."""
    return F.coalesce(F.contains(url, F.lit(".")), F.lit(False))


def clean_link(link: Column) -> Column:
    """Backslashes turned, scheme and www. cut, one slash at the end cut."""
    out = F.translate(link, "\\", "/")
    for p in PREFIXES:
        out = F.regexp_replace(out, r"^\Q" + p + r"\E", "")
    return F.regexp_replace(out, r"/\z", "")


def link_to_domain(link: Column) -> Column:
    return F.substring_index(F.substring_index(clean_link(link), "/", 1), "?", 1)


def tld(url: Column) -> Column:
    """What follows the last dot."""
    return F.substring_index(url, ".", -1)


def is_trivial_link(link: Column) -> Column:
    """Empty or null, within the page, a mail address, or to a page that says nothing."""
    return F.coalesce((link == "") | link.startswith("#") | link.startswith("mailto") | F.substring_index(link, "/", -1).rlike("blank|empty|notfound"), F.lit(True))


def absolute(link: Column, base: Column, keep_scheme: bool = False) -> Column:
    """A relative link joined to its base. keep_scheme: a base's own scheme stays behind the one that is put before it."""
    link = F.translate(link, "\\", "/")
    base = F.regexp_replace(base, r"/\z", "")
    if not keep_scheme:
        base = F.regexp_replace(base, r"(?i)^(https?:)?//", "")
    path = F.regexp_replace(F.regexp_replace(link, r"^\./", "/"), r"^(?!/)", "/")
    return F.when(link.rlike(r"(?i)^https?:") | link.startswith("//"), link).otherwise(F.concat(F.lit("http://"), base, path))


def remove_format_tags(html: Column) -> Column:
    return F.regexp_replace(html, r"</?(u|b|em|sub|sup|strong|br)>", "")


def file_name(url: Column) -> Column:
    return F.regexp_replace(url, r'[/\\:*?"<>|]', "_")


def document_name(csv_name: Column) -> Column:
    """The name of the documents' file that goes with a list's."""
    return F.concat(F.lit("obj_documents_"), F.substring(csv_name, F.lit(1), F.greatest(F.length(csv_name) - 4, F.lit(0))), F.lit(".json"))


def without_parameters(path: Column) -> Column:
    return F.lower(F.substring_index(F.substring_index(path, "?", 1), "&", 1))


def registered_name(url: Column, two_label_suffixes=TWO_LABEL_SUFFIXES) -> Column:
    """The label before the public suffix."""
    labels = F.split(F.regexp_replace(F.lower(link_to_domain(url)), r":\d+\z", ""), r"\.")
    at = F.when(F.array_join(F.slice(labels, -2, 2), ".").isin(*two_label_suffixes), 3).otherwise(2)
    return F.coalesce(F.try_element_at(labels, -F.least(at, F.size(labels))), F.lit(""))


def account_pattern(network: str) -> str:
    return "(?iu)" + NETWORKS[network] + ".com/" + ACCOUNT


def account_of(link: Column, network: str) -> Column:
    """The account that a link names; null if it is none of the network's."""
    p = account_pattern(network)
    return F.when(link.rlike(p), without_parameters(F.regexp_extract(link, p, 1)))


def account_name(name: Column, network: Column) -> Column:
    """Without outer slashes; of a path, the part behind company, in (lk) or r (rd)."""
    trimmed = F.regexp_replace(F.regexp_replace(F.translate(name, "\\", "/"), "^/", ""), r"/\z", "")
    first, second = F.substring_index(trimmed, "/", 1), F.coalesce(F.get(F.split(trimmed, "/"), 1), F.lit(""))
    generic = ((network == "lk") & first.isin("company", "in")) | ((network == "rd") & (first == "r"))
    return F.when(generic, second).otherwise(trimmed)


def distance_key(name: Column) -> Column:
    return F.translate(F.lower(name), "-_", "")


def name_distance(a: Column, b: Column) -> Column:
    """-1 if equal, 0 if one holds the other, else the edit distance."""
    return F.when(a == b, -1).when(F.contains(b, a) | F.contains(a, b), 0).otherwise(F.levenshtein(a, b))


def replace_known(value: Column, known: dict[str, str]) -> Column:
    table = F.create_map(*[F.lit(x) for kv in known.items() for x in kv])
    return F.coalesce(table[value], value)


def final_url(url: Column, target: Column, delimiter: str = ",") -> Column:
    """The target, or else the url, without line ends, tabs and the delimiter."""
    return F.regexp_replace(F.coalesce(target, url), "[\n\t" + re.escape(delimiter) + "]", "")


def _ascii_name(name: str) -> str:
    try:
        import idna

        return idna.encode(name).decode("ascii")
    except ImportError:
        return name.encode("idna").decode("ascii")


def to_idna(url: Column) -> Column:
    """IDNA form; a name that has none stays. Only names with other characters than ASCII go to Python."""

    @F.pandas_udf("string")
    def run(names: pd.Series) -> pd.Series:
        def one(name):
            if name is None or name.isascii():
                return name
            try:
                return _ascii_name(name)
            except (UnicodeError, ValueError):
                return name

        return names.map(one)

    foreign = url.rlike(r"[^\x00-\x7F]")
    return F.when(foreign, run(F.when(foreign, url))).otherwise(url)


def lower_keys(keys: Column) -> Column:
    """Distinct lower-cased strings of an array."""
    return F.array_distinct(F.transform(keys, lambda k: F.lower(k.cast("string"))))


def lower_map_keys(values: Column) -> Column:
    """A map with lower-cased keys; of keys that become equal the last stays."""
    pairs = F.transform(F.map_entries(values), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    return F.map_from_entries(F.filter(pairs, lambda e, i: ~F.exists(F.slice(pairs, i + 2, F.greatest(F.size(pairs), F.lit(1))), lambda o: o["key"] == e["key"])))
