"""Projections, filters, predicates, top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.dates import iso_year_week, month_start
from tidemark.functions.text import url_domain
from tidemark.operators.merge import incremental
from tidemark.operators.reshape import distinct_values, max_by_date, weekly_mean
from tidemark.operators.rolling import flag_spans, last_n, top_n, top_n_per_key
from tidemark.operators.select import (
    date_between, delete_where, drop_bad_dates, fill_features, label_periods, news_valid, select_as, trailing, trusted_only,
    valid_weeks, year_week_between,
)
from workload.frames import articles, cte, daily, dense, dense_staged, orders, r6, sql_week, table
from workload.register import query


@query("p01_select_as", "SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS date, o_totalprice AS close_price FROM orders")
def project(spark, sf):
    return select_as(table(spark, sf, "orders"), {"id": "o_orderkey", "date": ("o_orderdate", "date"), "close_price": "o_totalprice"})


@query(
    "p02_drop_bad_dates",
    "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date, o_orderpriority AS ticker FROM orders WHERE o_orderstatus = 'O'",
)
def bad_dates(spark, sf):
    # Orders in work carry their key or a broken text where the date should be.
    o = table(spark, sf, "orders")
    text = F.col("o_orderdate").cast("date").cast("string")
    broken = F.when(F.col("o_orderstatus") == "F", F.lower("o_orderpriority")).when(F.col("o_orderstatus") == "P", F.concat(F.lit("x"), text))
    return drop_bad_dates(
        o.select("o_orderkey", F.coalesce(broken, text).alias("date"), F.col("o_orderpriority").alias("ticker"))
    )


@query("p03_trailing", cte("ord") + "SELECT o_orderkey, date FROM ord WHERE date BETWEEN (SELECT MAX(date) FROM ord) - 30 AND (SELECT MAX(date) FROM ord)")
def trail(spark, sf):
    return trailing(orders(spark, sf), "date", 30, "day").select("o_orderkey", "date")


@query(
    "p03_trailing_years",
    cte("ord") + "SELECT o_orderkey, date FROM ord WHERE date BETWEEN (SELECT MAX(date) - INTERVAL 2 YEAR FROM ord) AND (SELECT MAX(date) FROM ord)",
)
def trail_years(spark, sf):
    return trailing(orders(spark, sf), "date", 2, "year").select("o_orderkey", "date")


@query("p04_iso_week", cte("ord") + "SELECT o_orderkey, CAST(isoyear(date) AS INTEGER) AS iso_year, CAST(week(date) AS INTEGER) AS iso_week FROM ord")
def iso_week(spark, sf):
    year, week = iso_year_week("date")
    return orders(spark, sf).select("o_orderkey", year.alias("iso_year"), week.alias("iso_week"))


_WEEKS = (
    cte("daily")
    + f", w AS (SELECT series, CAST(year(date) AS INTEGER) AS year, {sql_week('date')} AS week, ROUND(AVG(value), 6) AS value FROM daily GROUP BY 1, 2, 3) "
)


def _weeks(spark, sf):
    return r6(weekly_mean(daily(spark, sf), "date", "value", "series"), "value")


@query("p05_year_week_range", _WEEKS + "SELECT * FROM w WHERE year * 100 + week BETWEEN 199620 AND 199907")
def week_range(spark, sf):
    return year_week_between(_weeks(spark, sf), (1996, 20), (1999, 7))


@query("p06_date_between", cte("ord") + "SELECT o_orderkey, date FROM ord WHERE date BETWEEN DATE '1996-03-01' AND DATE '1997-02-28'")
def dates(spark, sf):
    return date_between(orders(spark, sf), "date", "1996-03-01", "1997-02-28").select("o_orderkey", "date")


_HELD = (
    cte("ord")
    + ", held AS (SELECT o_orderpriority AS series, date FROM ord WHERE o_orderstatus = 'P' AND date < DATE '2000-01-01' "
    "AND o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')), m AS (SELECT series, MAX(date) AS mark FROM held GROUP BY 1) "
    "SELECT o_orderkey, o_orderpriority AS series, date FROM ord LEFT JOIN m ON m.series = ord.o_orderpriority "
)


def _new_and_held(spark, sf):
    new = orders(spark, sf).select("o_orderkey", F.col("o_orderpriority").alias("series"), "date", "o_orderstatus")
    held = new.filter(
        (F.col("o_orderstatus") == "P") & (F.col("date") < "2000-01-01") & F.col("series").isin("1-URGENT", "2-HIGH", "3-MEDIUM")
    )
    return new.drop("o_orderstatus"), held


@query("p07_incremental", _HELD + "WHERE CASE WHEN mark IS NULL THEN date >= (SELECT MAX(date) FROM ord) - 30 ELSE date > mark END")
def increment(spark, sf):
    new, held = _new_and_held(spark, sf)
    return incremental(new, held, "series", default_days=30)


@query("p08_overlap", _HELD + "WHERE mark IS NULL OR date > mark")
def overlap(spark, sf):
    new, held = _new_and_held(spark, sf)
    return incremental(new, held, "series", overlap_days=7)


@query(
    "p09_delete_where",
    cte("articles") + "SELECT event_id, topic FROM articles WHERE NOT (COALESCE(ingest_date = DATE '2024-01-15' AND date_trunc('month', published_at) = DATE '2024-01-01', FALSE))",
)
def delete(spark, sf):
    today = F.lit("2024-01-15").cast("date")
    bad = (F.col("ingest_date") == today) & (month_start("published_at") == month_start(today))
    return delete_where(articles(spark, sf), bad).select("event_id", "topic")


@query("p10_valid_weeks", _WEEKS + "SELECT * FROM w WHERE week NOT IN (0, 53) AND year >= 1999")
def weeks(spark, sf):
    return valid_weeks(_weeks(spark, sf))


@query("p12_fill_features", cte("dense") + "SELECT series, date, COALESCE(value, 0.0) AS value FROM dense")
def fill_zero(spark, sf):
    return fill_features(dense(spark, sf), ["value"])


@query("p13_news_valid", cte("articles") + "SELECT event_id, title AS url FROM articles WHERE title IS NOT NULL AND title <> ''")
def valid_news(spark, sf):
    return news_valid(articles(spark, sf).select("event_id", F.col("title").alias("url")))


@query(
    "p14_label_periods",
    cte("daily")
    + """SELECT series, date, value, period FROM daily JOIN (VALUES ('boom', DATE '1996-01-01', DATE '1999-12-31'),
    ('late', DATE '1999-06-01', DATE '2001-01-31'), ('2001-2003', DATE '2001-03-01', DATE '2003-03-01')) p(period, a, b) ON date BETWEEN a AND b""",
)
def periods(spark, sf):
    spans = {"boom": ("1996-01-01", "1999-12-31"), "late": ("1999-06-01", "2001-01-31"), "2001-2003": ("2001-03-01", "2003-03-01")}
    return label_periods(daily(spark, sf), "date", spans)


_DOMAIN = "lower(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\\-]*:)?//([^/?#]*)', 1))"


@query(
    "p15_trusted_only",
    f"SELECT page_id, {_DOMAIN} AS source_domain FROM pages WHERE {_DOMAIN} IN ('example.com', 'example.org') OR {_DOMAIN} LIKE '%.example.com' OR {_DOMAIN} LIKE '%.example.org'",
)
def trusted(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", url_domain("url").alias("source_domain"))
    return trusted_only(pages, domains=["example.com", "example.org"])


_FLAG = cte("dense") + ", f AS (SELECT series, date, CASE WHEN value > 250000 THEN 1.0 ELSE 0.0 END AS flag FROM dense)"


def _flags(spark, sf):
    return dense_staged(spark, sf).select("series", "date", F.when(F.col("value") > 250000, 1.0).otherwise(0.0).alias("flag"))


@query("p17_flag_mask", _FLAG + " SELECT series, date FROM f WHERE flag > 0")
def flag_mask(spark, sf):
    return _flags(spark, sf).filter(F.col("flag") > 0).select("series", "date")


@query(
    "p17_flag_spans",
    _FLAG
    + """, g AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY series ORDER BY date) - ROW_NUMBER() OVER (PARTITION BY series, flag > 0 ORDER BY date) AS run FROM f)
    SELECT series, MIN(date) AS span_start, MAX(date) AS span_end FROM g WHERE flag > 0 GROUP BY series, run""",
)
def spans(spark, sf):
    return flag_spans(_flags(spark, sf), "date", "flag", "series")


@query("k01_total_sort", cte("daily") + "SELECT series, date, value FROM daily ORDER BY date, series")
def total_sort(spark, sf):
    return daily(spark, sf).orderBy("date", "series")


@query("k02_top_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def top(spark, sf):
    return top_n(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), F.asc("o_orderkey")], 25)


@query(
    "k04_top_n_per_key",
    "SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) <= 10",
)
def top_per_key(spark, sf):
    return top_n_per_key(table(spark, sf, "orders"), "o_custkey", [F.desc("o_orderdate"), F.asc("o_orderkey")], 10).select(
        "o_custkey", "o_orderkey", "o_totalprice"
    )


@query(
    "k05_head_of_list",
    "SELECT o_orderkey, o_orderdate FROM (SELECT * FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 200) ORDER BY o_orderdate DESC, o_orderkey LIMIT 50",
)
def head(spark, sf):
    order = [F.desc("o_orderdate"), F.asc("o_orderkey")]
    return top_n(top_n(table(spark, sf, "orders"), order, 200), order, 50).select("o_orderkey", "o_orderdate")


@query("w19_last_n", _WEEKS + "SELECT * FROM w QUALIFY ROW_NUMBER() OVER (PARTITION BY series ORDER BY year DESC, week DESC) <= 24")
def last_weeks(spark, sf):
    return last_n(_weeks(spark, sf), ["year", "week"], 24, "series")


@query("w19_last_n_table", "SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 24")
def last_rows(spark, sf):
    return last_n(table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"], 24)


@query("u05_distinct", cte("ord") + "SELECT DISTINCT date, o_totalprice AS value FROM ord")
def distinct(spark, sf):
    return distinct_values(orders(spark, sf), "date", "o_totalprice")


@query("a06_max_by_date", cte("ord") + "SELECT date, MAX(o_totalprice) AS value FROM ord GROUP BY 1")
def max_date(spark, sf):
    return max_by_date(orders(spark, sf), value="o_totalprice")
