"""The decision on one page: error, placeholder of a redirection, or what its text, links and scripts say."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenweb.functions.fixed import LIMITS
from lumenweb.functions.patterns import parking_pattern
from lumenweb.operators.common import true
from lumenweb.operators.redirect import needs_target_visit

#: Columns of a normal page's result.
RESULT = "url to_sample source original_url flag_iframe flag_js_found n_letter n_words is_redirected redirection_type target_url is_redirected_to_registrar is_redirected_different_domain park_service registrar_found document_write to_revisit_with_js is_full_js_parked is_non_text_park kw_parked kw_park_notice js_or_iframe_found pred_is_empty pred_ml_park pred_is_parked tag_quantity ssl_enabled history URL_history".split()
#: Columns that a result of each kind brings along; the others stay as they are when results are consolidated.
KEYS = {
    "error": "url source original_url to_sample is_redirected to_revisit_with_js pred_is_parked is_error comment".split(),
    "failed": "url source original_url to_sample is_redirected to_revisit_with_js pred_is_parked".split(),
    "redirect": "url source original_url to_sample to_revisit_with_js".split(),
}


def javascript_need(html: Column, no_script: Column, n_letters: Column) -> Column:
    """struct(document_write, to_revisit_with_js): a short page that writes itself, or that says it needs scripts."""
    short = n_letters < LIMITS["js_text"]
    writes = true(html.rlike(r"(?i)document\.writeln *\(|document\.write *\(") | html.rlike(r"\.createElement *\(|\.appendChild *\("))
    asks = true(no_script.rlike("(?i)enable|require") & no_script.rlike("(?i)javascript"))
    return F.struct(F.when(short, writes).alias("document_write"), (true(short) & (writes | asks)).alias("to_revisit_with_js"))


def is_non_text_park(non_text: Column) -> Column:
    return true(non_text.rlike("(?iu)[^a-z]park"))


def empty_page(df: DataFrame, data: str = "html_data") -> DataFrame:
    """Hardly any word, no script, no frame, no link."""
    d = F.col(data)
    active = true(d["flag_js_found"]) | true(d["flag_iframe"])
    return df.withColumns({"js_or_iframe_found": active, "pred_is_empty": true((F.col("n_unique_words") <= LIMITS["empty_words"]) & ~active & (F.size(d["all_links"]) == 0))})


def valid_registrar(found: Column, redirected: Column, ml: Column, n_words: Column, n_tags: Column) -> Column:
    """A registrar that was found stands if the page sends there or looks parked; not on a page with much of its own."""
    return true(found) & F.when(true(redirected) | true(ml), True).when(n_words > LIMITS["registrar_words"], False).when(n_tags > LIMITS["tags"], False).otherwise(True)


def validate_javascript(df: DataFrame, html: str = "raw_text", text: str = "clean_text", data: str = "html_data") -> DataFrame:
    """Whether a browser must look at the page: not where the case is clear, and surely where scripts are most of it."""
    n = F.coalesce(F.length(text), F.lit(0))
    short = n < LIMITS["js_text"]
    clue = is_non_text_park(F.col("non_text"))
    full = clue & short
    clear = F.col("registrar_found") | F.col("pred_ml_park") | full | F.col("pred_is_empty")
    mostly = true((F.col(data)["lg_inline_script"] / (F.length(html) + F.lit(1e-5)) > LIMITS["js_share"]) & short)
    return df.withColumns({"is_non_text_park": clue, "is_full_js_parked": full, "to_revisit_with_js": F.when(clear, False).when(mostly, True).otherwise(F.col("to_revisit_with_js"))})


def ml_gate(prediction: Column) -> Column:
    """A prediction counts on pages with a sentence and more than three words."""
    return true((F.col("n_sentences") > 0) & (F.col("n_words") > LIMITS["ml_words"]) & prediction)


def kind_of_page(fix_window_location: bool = False) -> Column:
    return F.when(true(F.col("is_error")), "error").when(needs_target_visit(fix_window_location), "redirect").when(F.col("html_data").isNull(), "failed").otherwise("normal")


def classify(df: DataFrame, fix_window_location: bool = False) -> DataFrame:
    """Results of pages that carry html_data, text features, redirection, registrar and prediction (column ml_prediction).

    page_kind tells which of RESULT a row brings along. Errors count as parked; a placeholder stands under its target's url.
    """
    d = F.col("html_data")
    need = javascript_need(F.col("raw_text"), d["no_script_text"], F.coalesce(F.length("clean_text"), F.lit(0)))
    # The pattern engine is Python: it sees only rows that it decides on.
    out = df.withColumn("page_kind", kind_of_page(fix_window_location)).withColumn("_need", need).select("*", "_need.*").drop("_need")
    out = empty_page(out).withColumn("pred_ml_park", ml_gate(F.col("ml_prediction")))
    normal = F.col("page_kind") == "normal"
    looked = lambda c: F.when(normal, F.col(c))
    out = out.withColumn("_pattern", parking_pattern(looked("raw_text"), looked("clean_text"), F.col("language"), F.col("url"), F.col("n_words")))
    out = out.withColumns({"kw_parked": F.col("_pattern.kw_parked"), "kw_park_notice": F.col("_pattern.kw_park_notice"), "missing_language": F.col("_pattern.missing_language"), "registrar_found": valid_registrar(F.col("registrar_found"), F.col("is_redirected_to_registrar"), F.col("pred_ml_park"), F.col("n_words"), d["tag_quantity"])})
    parked = F.col("registrar_found") | F.col("kw_parked") | F.col("pred_is_empty") | F.col("pred_ml_park")
    out = validate_javascript(out.withColumn("pred_is_parked", parked))
    out = out.withColumns({"flag_iframe": d["flag_iframe"], "flag_js_found": d["flag_js_found"], "tag_quantity": d["tag_quantity"], "n_letter": F.coalesce(F.length("clean_text"), F.lit(0)), "ssl_enabled": F.col("URL_history").startswith("https:")})
    return shape(out.drop("_pattern"))


def shape(df: DataFrame) -> DataFrame:
    """Columns that a row's kind doesn't bring along are null; the rest is set as the kind has it."""
    kind = F.col("page_kind")
    error, failed, redirect = (kind == k for k in ("error", "failed", "redirect"))
    keep = {c: F.when(kind == "normal", F.col(c)) for c in [*RESULT, *[c for c in df.columns if c.startswith("ml_feat_")]] if c in df.columns}
    from_target = F.col("source") == "target"
    keep |= {
        "url": F.when(redirect, F.col("target_url")).otherwise(F.col("url")), "original_url": F.when(redirect, F.col("url")).otherwise(F.col("original_url")), "source": F.when(redirect, "target").otherwise(F.col("source")),
        "to_sample": F.when(error, False).otherwise(F.col("to_sample")), "is_redirected": F.when(error | failed, False).otherwise(keep["is_redirected"]), "to_revisit_with_js": F.when(error | failed | redirect, False).otherwise(F.col("to_revisit_with_js")),
        "pred_is_parked": F.when(error | failed, True).otherwise(keep["pred_is_parked"]), "is_error": F.when(error & from_target, True), "comment": F.when(error & from_target, F.col("comment")),
        "history": F.when((kind == "normal") & F.col("to_revisit_with_js"), F.col("history")), "URL_history": F.when((kind == "normal") & F.col("to_revisit_with_js"), F.col("URL_history")),
    }
    return df.withColumns(keep)


def missing_languages(df: DataFrame) -> DataFrame:
    """Languages without patterns by how many pages had them."""
    return df.where("missing_language is not null and missing_language <> 'other'").groupBy("missing_language").count().orderBy(F.desc("count"), "missing_language")
