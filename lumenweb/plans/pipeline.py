"""From crawl rows to final categories.

Each page is parsed once, in one Python node, and the parsed pages are written once: social accounts, technologies,
registrars and the decision each read their own columns of that table. Originals, targets and browser pages are three
filters of the same classified rows, written once too, and two joins on the url put them together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenweb.functions import language, text, urls
from lumenweb.functions.html import parse_pages
from lumenweb.operators import consolidate, output, parking, redirect, registrars, social, taxonomy, technologies
from lumenweb.operators.common import add_missing, true
from lumenweb.operators.visits import without_long_pages
from lumenweb.plans.config import Config
from lumenweb.sources.scratch import written


def process_pages(crawl: DataFrame, config: Config = Config()) -> DataFrame:
    """crawl with html_data, clean_text, non_text and language. Errors keep what they have."""
    out = add_missing(without_long_pages(crawl), {"clean_text": F.lit(None).cast("string"), "non_text": F.lit(None).cast("string"), "language": F.lit(None).cast("string"), "source": F.lit("original"), "original_url": F.lit(None).cast("string"), "to_sample": F.lit(False), "history": F.lit(0), "URL_history": F.lit(None).cast("string")})
    out = parse_pages(out)
    if config.do_page_processing:
        out = out.withColumns({"clean_text": F.coalesce("html_data.clean_text", "clean_text"), "non_text": F.coalesce("html_data.non_text", "non_text")})
        out = out.withColumn("language", F.coalesce("language", language.detect(F.col("clean_text"))))
    return out


def with_text_features(pages: DataFrame, words: DataFrame) -> DataFrame:
    """Tokens, counts and word classes (ml_feat_*) of pages. words: a taxonomy."""
    vocabulary = taxonomy.vocabulary(words)
    rows = taxonomy.word_table(words).collect()  # the vocabulary: some hundred rows
    types, classes = {r["root"]: r["word_type"] for r in rows}, {r["root"]: r["end_class"] for r in rows}
    known = taxonomy.with_language_map(pages, words)
    out = text.with_features(known, "clean_text", urls.link_to_domain(F.col("url")), vocabulary, types, F.col("known")).drop("known")
    return out.withColumns({f"ml_feat_{k}": v for k, v in text.class_counts(F.col("text_feat"), vocabulary, classes).items()})


def classify(pages: DataFrame, words: DataFrame, known_registrars: DataFrame, predict=None, config: Config = Config()) -> DataFrame:
    """Results of processed pages. predict: DataFrame to DataFrame with ml_prediction; without one no page looks parked to it."""
    out = with_text_features(redirect.with_redirection(pages), words)
    out = out.withColumn("all_links", F.col("html_data.all_links"))
    out = registrars.detect(out, registrars.suffixes(known_registrars)).drop("all_links")
    out = predict(out) if predict else out.withColumn("ml_prediction", F.lit(False))
    return parking.classify(out, config.fix_window_location)


def parking_results(pages: DataFrame, words: DataFrame, known_registrars: DataFrame, predict=None, config: Config = Config()) -> DataFrame:
    """One row for each original: its own result, that of its redirection's target, or that of its rendered page."""
    kind = F.coalesce(F.col("visit_kind"), F.lit("original")) if "visit_kind" in pages.columns else F.lit("original")
    out = classify(pages.withColumn("visit_kind", kind), words, known_registrars, predict, config)
    columns = [c for c in [*parking.RESULT, "is_error", "comment", "page_kind", *[c for c in out.columns if c.startswith("ml_feat_")]] if c in out.columns]
    out = written(out.select("visit_kind", *columns), "results")
    parts = {k: out.where(F.col("visit_kind") == k).select(*columns) for k in ("original", "target", "browser")}
    # A placeholder stands under its target's url; the original's url is in original_url.
    first = parts["original"].withColumn("original_url", F.when(F.col("page_kind") == "redirect", F.col("original_url")))
    done = consolidate.with_targets(first, parts["target"])
    if config.do_js_interpretation:
        done = consolidate.with_browser(done, parts["browser"])
    done = done.withColumn("url", F.when(F.col("page_kind") == "redirect", F.coalesce("original_url", "url")).otherwise(F.col("url")))
    return redirect.settle_same_domain(done).drop("page_kind")


def run(domains: DataFrame, crawl: DataFrame, words: DataFrame, known_registrars: DataFrame, predict=None, config: Config = Config()) -> DataFrame:
    """The final table: a row for each domain of the list, with its categories."""
    pages = written(process_pages(crawl, config), "pages")
    originals = pages.where(F.coalesce(F.col("visit_kind"), F.lit("original")) == "original") if "visit_kind" in pages.columns else pages
    out = domains
    if config.do_classification:
        out = consolidate.stage(out, parking_results(pages, words, known_registrars, predict, config))
    if config.do_social_media:
        accounts = social.results(originals)
        if "visit_kind" in pages.columns:
            targets = pages.where("visit_kind = 'target'")
            accounts = social.with_targets(accounts, social.results(targets).join(targets.select("url", "original_url"), "url"))
        out = consolidate.stage(out, accounts)
    if config.do_mail_exchange and "mx_record" in crawl.columns:
        out = consolidate.stage(out, technologies.with_mail(originals).select("url", "has_mx_record", "MXRecord", "has_own_mx_record"))
    if config.do_hcj_extraction and "header_keys" in crawl.columns:
        flags = technologies.with_features(originals, libraries=technologies.library_names(F.col("html_data.libraries")), count_scripts=config.count_scripts)
        out = consolidate.stage(out, flags.select("url", *[c for c in flags.columns if c.startswith("fx_hcj__")]))
    told = [c for c in ("url", "is_error", "comment", "language", "status", "all_status_codes", "history", "URL_history") if c in originals.columns]
    out = consolidate.crawl_over(out, originals.select(*told))
    if config.do_sampling:
        out = out.withColumn("to_sample", output.sampled(F.col("url"), config.sampling_rate) & ~true(F.col("is_error")))
    out = output.fill_defaults(add_missing(out, {"target_url": F.lit(None).cast("string")}))
    need = {"is_error": F.lit(False), "comment": F.lit(None).cast("string"), "registrar_found": F.lit(False), "is_full_js_parked": F.lit(False), "pred_ml_park": F.lit(False), "pred_is_empty": F.lit(False), "flag_js_found": F.lit(False)} | {f"ml_feat_{k}": F.lit(0) for k in ("index_of", "construction", "sale", "starter", "expired", "blocked", "reserved")}
    out = add_missing(out, need)
    return output.final_format(out, config.csv_output_delimiter) if config.do_content_classification else output.order_columns(out)
