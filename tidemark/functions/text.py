"""Urls, identifiers, topics and fenced text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidemark.functions.dates import col

# Canonical topic -> spellings it is known by.
TOPIC_ALIASES = {
    "layoff": ["layoff", "layoffs"],
    "fed_policy": ["fed_policy", "fed", "fomc"],
    "cpi": ["cpi", "inflation"],
    "labor": ["labor", "employment", "jobs"],
    "markets": ["markets", "market"],
    "energy": ["energy", "oil", "gas"],
    "real_estate": ["real_estate", "housing"],
}

# News domains taken as trusted.
TRUSTED_DOMAINS = [
    "reuters.com", "wsj.com", "bloomberg.com", "ft.com", "apnews.com", "nytimes.com", "washingtonpost.com",
    "marketwatch.com", "cnbc.com", "federalreserve.gov", "stlouisfed.org", "bls.gov", "bea.gov", "treasury.gov",
    "eia.gov", "imf.org", "bis.org", "oecd.org", "conference-board.org", "visa.com", "spglobal.com", "sifma.org",
    "adp.com", "equifax.com",
]

URL_AUTHORITY = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"


def url_domain(url) -> Column:
    """Lower-cased network location of a url, port kept; empty when there is none."""
    return F.lower(F.regexp_extract(F.coalesce(col(url), F.lit("")), URL_AUTHORITY, 1))


def url_host_token(url) -> Column:
    """Text between the double slash and the next slash, as written; NULL without a scheme."""
    u = col(url)
    return F.when(F.instr(u, "://") > 0, F.get(F.split(u, "/"), F.lit(2)))


def article_id(url, title) -> Column:
    """Deterministic id: first 32 hex digits of SHA-256 over url, two pipes, title."""
    key = F.concat_ws("||", F.coalesce(col(url), F.lit("")), F.coalesce(col(title), F.lit("")))
    return F.substring(F.sha2(key, 256), 1, 32)


def topic_norm(c) -> Column:
    """Canonical topic; an unknown topic passes through lower-cased."""
    low = F.lower(col(c))
    out = F.when(F.lit(False), low)
    for topic, names in TOPIC_ALIASES.items():
        out = out.when(low.isin(names), F.lit(topic))
    return out.otherwise(low)


def strip_fence(c) -> Column:
    """Inner text of a block fenced by three back-ticks, language tag dropped."""
    text = F.trim(F.regexp_replace(col(c), r"^\s+|\s+$", ""))
    return F.regexp_replace(F.regexp_replace(text, r"^```[A-Za-z0-9_+-]*\s*", ""), r"\s*```$", "")


def text_len(c) -> Column:
    return F.length(F.coalesce(col(c), F.lit("")))
