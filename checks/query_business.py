"""Registered queries: views and business questions."""

from __future__ import annotations

from shelftide.operators import views
from shelftide.plans import questions

from . import inputs


def _bind(plan, source):
    read = inputs.hb if source == "hb" else inputs.sales
    return lambda spark, sf_dir: plan(read(spark, sf_dir))


QUERIES = {
    "hourly_business": inputs.hb,
    "store_dashboard": _bind(views.store_dashboard, "hb"),
    "category_intelligence": _bind(views.category_intelligence, "hb"),
    "rhythm_patterns": _bind(views.rhythm_patterns, "hb"),
    "store_indicators": _bind(views.store_indicators, "hb"),
}
for _key, (_plan, _source) in questions.QUESTIONS.items():
    QUERIES[_key] = _bind(_plan, _source)

# The flag inferred from sales can never meet a sale, so the registered form
# of this question asks the shelf reading; the literal form is in the tests.
QUERIES["q25_promo_stockout"] = _bind(
    lambda hb: questions.promo_stockout(hb, "stock_status_flag"), "hb")
QUERIES["q12_stock_avg_status"] = _bind(lambda hb: questions.stock_avg(hb, "stock_status_flag"), "hb")
