"""Ordered text rules that map a raw traffic source to a channel. The first matching rule wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from .scalars import _col

# Fixed values: (prefix, channel) in rule order.
CHANNEL_PREFIXES = [
    ("facebook", "facebook_ads"), ("fb", "facebook_ads"), ("ig", "facebook_ads"),
    ("google", "google_ads"), ("youtube", "google_ads"), ("webflow", "webflow_ads"),
    ("bing", "bing"), ("customer.io", "customer.io"), ("taboola", "taboola"), ("chatgpt", "chatgpt"),
    ("menarini", "menarini"), ("edm", "edm"), ("klaviyo", "klaviyo"), ("perplexity", "perplexity"),
    ("pornhub", "pornhub"), ("msg", "msg"), ("hk01", "hk01"),
]

# Fixed values: (prefix, label) for the evaluation funnel.
FUNNEL_SOURCES = [
    ("facebook", "Facebook"), ("fb", "Facebook"), ("google", "Google"), ("webflow", "Webflow"),
    ("ig", "Instagram"), ("bing", "Bing"), ("customer.io", "customer.io"), ("taboola", "Taboola"),
    ("chatgpt", "ChatGPT"),
]

# Fixed values: (infix, label) for page visits.
PAGE_SOURCES = [
    ("google", "Google"), ("facebook", "Facebook"), ("webflow", "Webflow"), ("customer.io", "customer.io"),
    ("bing", "Bing"), ("taboola", "Taboola"), ("ig", "Instagram"),
]
PAGE_MEDIUMS = [("cpc", "CPC"), ("email", "Email"), ("native", "Native"), ("bio", "Bio")]


def map_channel(col: Column | str, rules: Sequence[tuple[str, str]], *, match: str = "prefix",
                ignore_case: bool = False) -> Column:
    """Label of the first rule whose text is a prefix (or infix) of the value; other values pass through."""
    raw = _col(col)
    text = F.lower(raw) if ignore_case else raw
    test = {"prefix": text.startswith, "contains": text.contains}[match]
    (needle, label), *rest = rules
    ladder = F.when(test(needle), F.lit(label))
    for needle, label in rest:
        ladder = ladder.when(test(needle), F.lit(label))
    return ladder.otherwise(raw)
