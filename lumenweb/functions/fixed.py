"""Values that results depend on: names, codes, clues, categories, limits. Tables are text, one entry a line."""

from __future__ import annotations


def _lines(text: str) -> list[str]:
    return [x for x in text.strip("\n").split("\n") if x.strip()]


def _pairs(text: str, sep: str = " ") -> dict[str, str]:
    return dict(x.strip().split(sep, 1) for x in _lines(text))


# HTTP status codes and their descriptions.
STATUS_TEXT = {
    int(k): v
    for k, v in _pairs("""
100 Continue
101 Switching Protocols
102 Processing
200 OK
201 Created
202 Accepted
203 Non-authoritative Information
204 No Content
205 Reset Content
206 Partial Content
207 Multi-Status
208 Already Reported
226 IM Used
300 Multiple Choices
301 Moved Permanently
302 Found
303 See Other
304 Not Modified
305 Use Proxy
306 Switch Proxy
307 Temporary Redirect
308 Permanent Redirect
400 Bad Request
401 Unauthorized
402 Payment Required
403 Forbidden
404 Not Found
405 Method Not Allowed
406 Not Acceptable
407 Proxy Authentication Required
408 Request Timeout
409 Conflict
410 Gone
411 Length Required
412 Precondition Failed
413 Payload Too Large
414 Request-URI Too Long
415 Unsupported Media Type
416 Requested Range Not Satisfiable
417 Expectation Failed
418 I'm a teapot
419 Authentication Timeout
421 Misdirected Request
422 Unprocessable Entity
423 Locked
424 Failed Dependency
426 Upgrade Required
428 Precondition Required
429 Too Many Requests
431 Request Header Fields Too Large
440 Login Timeout (Microsoft)
444 Connection Closed Without Response
449 Retry With (Microsoft)
450 Blocked by Windows Parental Controls (Microsoft)
451 Unavailable For Legal Reasons
494 Request Header Too Large (Nginx)
495 Cert Error (Nginx)
496 No Cert (Nginx)
497 HTTP to HTTPS (Nginx)
498 Token Expired/Invalid (Esri)
499 Client Closed Request
500 Internal Server Error
501 Not Implemented
502 Bad Gateway
503 Service Unavailable
504 Gateway Timeout
505 HTTP Version Not Supported
506 Variant Also Negotiates
507 Insufficient Storage
508 Loop Detected
509 Bandwidth Limit Exceeded (Apache)
510 Not Extended
511 Network Authentication Required
520 Unknown Error
526 Invalid SSL certificate
598 Network Read Timeout Error (Microsoft)
599 Network Connect Timeout Error
999 To ignore
""").items()
}

# The category tree, lowest level first: lv4 | lv1 | lv2 | lv3.
CATEGORIES = [
    tuple(x.split(" | "))
    for x in _lines("""
Other | Content | Low content | Other
Parked Notice Registrar | Content | Low content | Parked Notice Registrar
Blocked | Content | Low content | Blocked
Under construction | Content | Low content | Upcoming
Starter | Content | Low content | Upcoming
Expired | Content | Low content | Abandoned
Index of | Content | Low content | Not used
Blank Page | Content | Low content | Not used
For sale | Content | Low content | Parked Notice Individual Content
Reserved | Content | Low content | Parked Notice Individual Content
Parked Notice Individual Content | Content | Low content | Parked Notice Individual Content
No address found | No content | Errors | DNS Error
Refused Connection | No content | Errors | Connection Error
Timeout | No content | Errors | Connection Error
No Status Code | No content | Errors | Invalid Response
HTTP_401 | No content | Errors | HTTP Error
HTTP_403 | No content | Errors | HTTP Error
HTTP_404 | No content | Errors | HTTP Error
HTTP_408 | No content | Errors | HTTP Error
HTTP_500 | No content | Errors | HTTP Error
HTTP_502 | No content | Errors | HTTP Error
HTTP_504 | No content | Errors | HTTP Error
HTTP_other | No content | Errors | HTTP Error
High content | Content | High content | High content
""")
]

# Clues of page features: type name | cookies | headers | script libraries.
CLUES = [
    (a.split()[0], a.split()[1], b.split(), c.split(), d.split())
    for a, b, c, d in (
        x.split("|")
        for x in _lines("""
secu xss || xss x-xss-protection |
secu xsrf | xsrf-token _csrf csrf csrftoken ||
secu tls || strict-transport-security |
secu contentPolicy || x-frame-options content-security-policy x-permitted-cross-domain-policies access-control-allow-origin cross-origin-opener-policy cross-origin-resource-policy cross-origin-embedder-policy access-control-allow-methods content-security-policy-report-only |
secu captcha | captcha-tracker ||
opti cache | ssr-caching | cache-control cf-cache-status x-cache pragma x-proxy-cache x-cache-miss-from x-cacheable x-litespeed-cache x-cache-group server-cache x-cache-enabled x-cache-hit x-cacheproxy-retries x-cache-status x-proxy-cache-info x-sucuri-cache |
opti etag || etag |
opti parkingPage | parking_session ||
techno ASP | asp.net_sessionid | x-aspnet-version x-aspnetmvc-version |
techno PHP | phpsessid | x-php-version |
techno AWS | awsalb awsalbtg | x-amz-cf-id x-amz-cf-pop x-amz-request-id x-amz-id-2 x-amz-server-side-encryption |
techno Java | jsessionid ||
techno Jquery ||| jquery.js jquery-migrate.js slick.js jquery.blockui.js jquery-ui.js jquery.waypoints.js
techno React ||| react-dom.production.js react.production.js fusion-alert.js fusion-flexslider.js fusion-general-global.js fusion-lightbox.js fusion-video-general.js fusion-column.js fusion-container.js fusion-parallax.js
techno Angular ||| angular.js angular-translate.js angular-locale_en.js
service adblock || x-adblock-key |
service wix | wordpress_test_cookie | x-wix-request-id | wix-perf-measure.umd.js
service shopify | _shopify_s _shopify_y _shopify_m _shopify_tm _shopify_tw | x-shopify-stage |
service shop | shop_session_token | x-shopify-stage x-storefront-renderer-rendered x-shopid x-sorting-hat-shopid | woocommerce.js woocommerce-add-to-cart.js
service sucuri || x-sucuri-id x-sucuri-cache |
service googleAds ||| adsbygoogle.js
""")
    )
]

# Social networks by short name, and the characters that end an account's name.
NETWORKS = {"fb": "facebook", "tw": "twitter", "lk": "linkedin", "rd": "reddit", "ig": "instagram", "gh": "github"}
ACCOUNT = r"""([^';!,"?<>\n\t\r /\\^]*)"""

# Columns that default to a truth value where nothing is known.
BOOLEAN_DEFAULTS = {k: k == "ind_non_schema" for k in "to_sample pred_is_parked ind_non_schema is_error is_redirected is_redirected_different_domain registrar_found kw_parked pred_ml_park pred_is_empty is_full_js_parked flag_js_found has_facebook has_twitter has_linkedin has_reddit has_instagram has_github has_open_graph has_twitter_card has_schema_tag has_mx_record has_own_mx_record".split()}

# Column orders of the intermediate and the final table.
INTERMEDIATE_ORDER = "url ind_non_schema pred_is_parked is_error comment is_redirected redirection_type is_redirected_different_domain flag_park flag_iframe flag_js_found URL_history all_status_codes history registrar_found park_service kw_parked kw_park_notice flag_js pred_is_empty n_letter n_words ssl_enabled language cookies headers links has_facebook has_twitter has_linkedin has_reddit has_instagram has_github feat_fb_lks feat_tw_lks feat_lk_lks feat_rd_lks feat_ig_lks feat_gh_lks has_open_graph has_twitter_card has_schema_tag to_sample ss_filename raw_filename clean_filename json_filename".split()
FINAL_ORDER = "input_url final_url tld category_lv1 category_lv2 category_lv3 category_lv4 language source target_url url ind_non_schema is_error comment is_redirected is_redirected_different_domain redirection_type URL_history all_status_codes history registrar_found park_service kw_parked kw_park_notice pred_is_empty n_letter n_words flag_js_found document_write js_or_iframe_found is_js_rendered_results flag_iframe original_url has_facebook has_twitter has_linkedin has_reddit has_instagram has_github feat_fb_lks feat_tw_lks feat_lk_lks feat_rd_lks feat_ig_lks feat_gh_lks has_open_graph has_twitter_card has_schema_tag has_mx_record MXRecord has_own_mx_record to_sample ss_filename raw_filename clean_filename json_filename".split()
CLUE_COLUMNS = [f"fx_hcj__{kind}_{name}" for kind, name, *_ in CLUES]
#: Columns that the warehouse takes from the final table.
WAREHOUSE_COLUMNS = "input_url final_url tld category_lv1 category_lv2 category_lv3 category_lv4 has_facebook has_twitter has_linkedin has_reddit has_instagram has_github has_open_graph has_twitter_card has_schema_tag has_mx_record has_own_mx_record ssl_enabled is_redirected is_redirected_different_domain redirection_type all_status_codes comment language source to_sample ss_filename raw_filename clean_filename json_filename".split() + CLUE_COLUMNS

#: Warehouse schema by version: columns that each one adds.
WAREHOUSE_VERSIONS = [
    "date filename input_url final_url tld category subcategory language source pred_is_parked ind_non_schema is_error comment is_redirected is_redirected_different_domain redirection_type url_history all_status_codes history park_service kw_park_notice n_letter n_words flag_js_found flag_css document_write flag_iframe ssl_enabled".split(),
    "flag_park flag_js pred_has_ads has_ads_link ads_found flag_ads cookies headers links original_url is_redirected_to_registrar to_revisit_with_js pred_ml_park ml_feat_construction ml_feat_starter ml_feat_index ml_feat_provider tag_quantity category_lv1 category_lv2 category_lv3 category_lv4".split(),
    "has_schema_tag has_reddit has_facebook has_open_graph has_instagram has_linkedin has_twitter_card has_github has_twitter".split(),
    "has_mx_record has_own_mx_record".split(),
    "to_sample ss_filename raw_filename clean_filename json_filename".split(),
    CLUE_COLUMNS,
]

# Classes of vocabulary words, in the order in which the first one found names a parked page.
WORD_CLASSES = "sale blocked construction expired index_of other reserved starter".split()
CLASS_ORDER = {"index_of": "Index of", "construction": "Under construction", "sale": "For sale", "starter": "Starter", "expired": "Expired", "blocked": "Blocked", "reserved": "Reserved"}

# Vocabulary words of no language: word | type | class.
UNIQUE_WORDS = [
    tuple(x.split())
    for x in _lines("""
hello other other
world other other
hello_world other starter
x_url core other
wordpress other starter
wix other starter
microsoft other starter
lorem_ipsum other starter
index_of other index_of
index other other
no_website other other
""")
]
TOKEN_PAIRS = ["index of", "hello world", "lorem ipsum", "no website"]

# Labels: label | binary target | class target | word class.
LABELS = {
    x.split()[0]: (int(x.split()[1]), int(x.split()[2]), (x.split() + [""])[3])
    for x in _lines("""
high_content 0 0
parked_notice_registrar 1 1
parked_notice_individual_content 1 1 other
blocked 1 2 blocked
under_construction 1 3 construction
starter 1 3 starter
expired 1 4 expired
index_of 1 5 index_of
blank_page 1 5 other
for_sale 1 1 sale
reserved 1 1 reserved
""")
}

# Assumed shares and accuracies outside the classifier.
ERROR_ACCURACY, REGISTRAR_ACCURACY = 0.9902, 0.98
PREVALENCE = {"cctld": (0.29, 0.15), "gtld": (0.55, 0.14)}

# Language codes of a translator that differ from a detector's.
DETECTOR_CODES = {"en-gb": "en", "pt-br": "pt", "pt-pt": "pt", "zh": "zh-cn"} | {x: x for x in "af am ar bg bn ca chr cs cy da de el en es et eu fi fil fr gu hi hr hu id is it iw ja kn ko lt lv ml mr ms nl no pl ro ru sk sl sr sv sw ta te th tr uk ur vi zh-cn zh-tw".split()}

# Languages with a tokenizer of their own (language sentences words); the others use the standard one.
OWN_TOKENIZERS = {
    x.split()[0]: tuple(x.split()[1:])
    for x in _lines("""
ar std ar
bn bn bn
fa fa fa
gu std gu
he std he
hi hi hi
ja std ja
kn std kn
ko std ko
ml std ml
mr mr mr
ne std ne
pa std pa
ta std ta
te te std
th th th
ur std ur
vi vi vi
zh-cn std chn
zh-tw std chn
""")
}
STANDARD_LANGUAGES = "af bg ca cs cy da de el en es et fi fr hr hu id it lt lv mk nl no pl pt ro ru sk sl so sq sv sw tl tr uk".split()

# Tags.
FORMAT_TAGS = "u b em sub sup strong br".split()
TRIVIAL_TAGS = "td tr li ul b br em sub sup p u strong".split()
BASIC_PARENTS = "td tr p article footer li span noscript".split()

# Limits.
LIMITS = {"empty_words": 5, "html_lines": 150, "tags": 40, "pattern_words": 1000, "pattern_text": 5, "registrar_words": 50, "js_text": 500, "js_share": 0.5, "ml_words": 3, "too_long": 10_000_000, "non_text": 10_000, "sentence": 100, "no_pair": 1000, "chunk": 10_000, "chunk_ee": 50}

# Characters that end sentences, and those between words.
SENTENCE_END = "[.?:!;·˳̥۰ᴉ•․﮳。：；？！」』؟:।]+"
WORD_MARKS = "!\"#$%&'()*+,./:;<=>?@[]^`{|}~"
#: The backslash is not among them: it escapes the bracket after it.
WORD_GAP = "[" + "".join("\\" + c for c in WORD_MARKS) + "\\n\\t\\r ।]+"
PUNCTUATION = list("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~") + ["▁"]

# Languages whose translations of so few letters are dropped.
SHORT_WORDS = {2: "vi yo kk mn so ku my mi haw gd sm ht ro ha".split(), 1: "sd ig si".split()}
