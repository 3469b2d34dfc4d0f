"""non_text of every kind of planted page, and of real ones."""

from lumenweb.functions.html import extract
from lumenweb.plans.catalog import QUERIES
from lumenweb.plans.catalog.base import table
from tests.test_catalog import DATA, pytestmark  # noqa: F401


def test_every_page_has_its_non_text(spark):
    pages = {r.page_id: r for r in table(spark, str(DATA), "pages").collect()}
    planted = {r.page_id: r.non_text for r in QUERIES["h03_non_text_of_all_kinds"](spark, str(DATA)).collect()}
    assert planted.keys() == pages.keys() and {p % 8 for p, x in planted.items() if x} == set(range(8))
    real = {r.page_id: r.non_text for r in QUERIES["h04_text_of_all_pages"](spark, str(DATA)).collect()}
    assert real == {p: extract(r.html, r.url)["non_text"] for p, r in pages.items()}
    assert any(real.values())
