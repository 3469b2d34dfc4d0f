"""Schemas of the tables that go in and out, as DDL: nothing here needs a session."""

DOMAIN_LIST = "url string"
CRAWL = (
    "url string, original_url string, source string, visit_kind string, is_error boolean, comment string, to_revisit boolean, raw_text string, clean_text string, non_text string, language string, "
    "status int, history int, URL_history string, all_status_codes string, header_keys array<string>, cookie_keys array<string>, mx_record string, mail_comment string, to_sample boolean"
)
REGISTRARS = "hosting_name string, tld string"
SAMPLES = (
    "url string, html_text string, html_raw string, language string, tld string, ss_filename string, user_choices array<array<string>>, user_comments array<array<string>>, "
    "categorisation struct<category_lv4: string, pred_ml_park: string, comment: string>, target double"
)
PREDICTIONS = "id long, url string, actual int, pred double, language string, tld string"
