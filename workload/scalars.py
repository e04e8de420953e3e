"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import dates as D, numbers as N, payload as J, text as T
from workload.frames import articles, cte, orders, runs, sql_week, table
from workload.register import query


@query(
    "f01_f02_date_parts",
    cte("ord") + f"SELECT o_orderkey, date AS d, CAST(year(date) AS INTEGER) AS year, {sql_week('date')} AS week FROM ord",
)
def date_parts(spark, sf):
    o = table(spark, sf, "orders")
    d = D.as_date("o_orderdate")
    return o.select("o_orderkey", d.alias("d"), F.year(d).alias("year"), D.week_u(d).alias("week"))


@query(
    "f03_f04_date_math",
    cte("ord")
    + """SELECT o_orderkey, CAST(date - DATE '1995-01-01' AS INTEGER) AS age, date - 7 AS week_ago,
    CAST(date - INTERVAL 1 MONTH AS DATE) AS month_ago, CAST(date_trunc('month', date) AS DATE) AS month FROM ord""",
)
def date_math(spark, sf):
    return orders(spark, sf).select(
        "o_orderkey",
        D.days_between("date", F.lit("1995-01-01").cast("date")).alias("age"),
        D.trailing_start(F.col("date"), 7, "day").alias("week_ago"),
        D.trailing_start(F.col("date"), 1, "month").alias("month_ago"),
        D.month_start("date").alias("month"),
    )


@query(
    "f05_f25_sequences",
    cte("ord")
    + """SELECT o_orderkey, CAST(UNNEST(generate_series(date_trunc('month', date) + INTERVAL 1 MONTH, date_trunc('month', date) + INTERVAL 6 MONTH, INTERVAL 1 MONTH)) AS DATE) AS month FROM ord""",
)
def sequences(spark, sf):
    return orders(spark, sf).select("o_orderkey", F.explode(D.month_range("date", 6)).alias("month"))




def _odd_numbers(spark, sf):
    kind = F.col("event_type")
    text = (
        F.when(kind == "click", F.concat(F.lit("x"), F.col("value"))).when(kind == "error", "NaN").when(kind == "signup", "-Infinity")
        .otherwise(F.col("value").cast("string"))
    )
    return table(spark, sf, "events").select("event_id", "value", "ts", text.alias("t"))


@query("f23_finite_or_null", "SELECT event_id, CASE WHEN event_type IN ('view', 'purchase') THEN value END AS x FROM events")
def finite(spark, sf):
    return _odd_numbers(spark, sf).select("event_id", N.finite_or_null("t").alias("x"))


@query("f06_safe_ts", "SELECT event_id, CASE WHEN event_type IN ('view', 'error') THEN TIMESTAMP '2020-01-01 00:00:00' ELSE ts END AS x FROM events")
def safe(spark, sf):
    e = table(spark, sf, "events")
    text = F.when(F.col("event_type").isin("view", "error"), "2020-01-01T00:00:00Z").when(F.col("event_type") == "click", "soon")
    read = e.select("event_id", text.alias("t"), F.col("ts").cast("timestamp").alias("ts"))
    return read.select("event_id", D.safe_ts("t", "ts").cast("timestamp_ntz").alias("x"))


@query("f07_safe_div", "SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice / NULLIF(l_discount, 0) AS x FROM lineitem")
def divide(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", N.safe_div("l_extendedprice", "l_discount").alias("x"))


_CENTS = "WITH c AS (SELECT l_orderkey, l_linenumber, l_partkey, CAST(round(l_extendedprice * 100) AS BIGINT) AS c FROM lineitem) SELECT l_orderkey, l_linenumber, l_partkey, "


@query("f08_round_half_up", _CENTS + "(c // 8 + CASE WHEN c % 8 >= 4 THEN 1 ELSE 0 END) / 100.0::DOUBLE AS x FROM c")
def half_up(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", N.round_half_up(F.col("l_extendedprice") / 8).alias("x"))


@query(
    "f09_round_half_even",
    _CENTS + "(c // 8 + CASE WHEN c % 8 > 4 THEN 1 WHEN c % 8 = 4 THEN (c // 8) % 2 ELSE 0 END) / 100.0::DOUBLE AS x FROM c",
)
def half_even(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", N.round_half_even(F.col("l_extendedprice") / 8).alias("x"))


@query(
    "f10_conditionals",
    "SELECT event_id, CASE WHEN event_type = 'view' THEN NULL ELSE greatest(value, 10.0) END AS x, COALESCE(CASE WHEN value > 5 THEN value END, 0.0) AS y FROM events",
)
def conditionals(spark, sf):
    e = table(spark, sf, "events").withColumn("v", F.when(F.col("event_type") != "view", F.col("value")))
    return e.select(
        "event_id", N.greatest_strict("v", F.lit(10.0)).alias("x"), F.coalesce(F.when(F.col("value") > 5, F.col("value")), F.lit(0.0)).alias("y")
    )


@query(
    "f11_null_safe_eq",
    cte("articles") + "SELECT event_id, title IS NOT DISTINCT FROM CASE WHEN score > 8 THEN title END AS same FROM articles",
)
def same(spark, sf):
    a = articles(spark, sf).withColumn("other", F.when(F.col("score") > 8, F.col("title")))
    return a.select("event_id", N.null_safe_eq("title", "other").alias("same"))


_TOPIC = "CASE lower(topic) WHEN 'fed' THEN 'fed_policy' WHEN 'layoffs' THEN 'layoff' WHEN 'inflation' THEN 'cpi' WHEN 'oil' THEN 'energy' ELSE lower(topic) END"


@query("f12_n04_topic_norm", cte("articles") + f"SELECT event_id, {_TOPIC} AS topic FROM articles")
def topic(spark, sf):
    return articles(spark, sf).select("event_id", T.topic_norm("topic").alias("topic"))


@query(
    "f13_url_domain",
    "SELECT page_id, lower(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\\-]*:)?//([^/?#]*)', 1)) AS domain, "
    "CASE WHEN url LIKE '%://%' THEN split_part(url, '/', 3) END AS host FROM pages",
)
def domain(spark, sf):
    return table(spark, sf, "pages").select("page_id", T.url_domain("url").alias("domain"), T.url_host_token("url").alias("host"))


@query("f14_f15_article_id", "SELECT page_id, substr(sha256(COALESCE(url, '') || '||' || COALESCE(html, '')), 1, 32) AS id FROM pages")
def identity(spark, sf):
    return table(spark, sf, "pages").select("page_id", T.article_id("url", "html").alias("id"))


_SECOND = "date_trunc('second', ts)"


@query(
    "f16_parse_any_ts",
    f"""SELECT event_id, CASE event_type WHEN 'view' THEN {_SECOND} WHEN 'click' THEN {_SECOND} WHEN 'error' THEN {_SECOND} - INTERVAL 330 MINUTE
    WHEN 'purchase' THEN {_SECOND} + INTERVAL 5 HOUR END AS x FROM events""",
)
def parse_ts(spark, sf):
    ts, kind = F.col("ts").cast("timestamp"), F.col("event_type")
    mail = F.date_format(ts, "EEE, dd MMM yyyy HH:mm:ss")
    text = (
        F.when(kind == "view", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(kind == "click", F.concat(mail, F.lit(" GMT")))
        .when(kind == "error", F.concat(mail, F.lit(" +0530")))
        .when(kind == "purchase", F.concat(mail, F.lit(" EST")))
        .otherwise(F.concat(F.lit("on "), F.date_format(ts, "yyyy")))
    )
    e = table(spark, sf, "events").select("event_id", text.alias("t"))
    return e.select("event_id", D.parse_any_ts("t").cast("timestamp_ntz").alias("x"))


@query(
    "f17_published_at",
    f"SELECT event_id, CASE WHEN event_type = 'signup' THEN NULL ELSE {_SECOND} END AS x FROM events",
)
def published(spark, sf):
    iso = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    kind = F.col("event_type")

    def item(text, *args):
        return F.format_string(text, *args)

    payload = (
        F.when(kind == "view", item('{"published_at": "%s", "date": "2001-01-01"}', iso))
        .when(kind == "click", item('{"published_at": "soon", "pubDate": "%s"}', iso))
        .when(kind == "error", item('{"title": "t", "meta": {"published": "%s"}}', iso))
        .when(kind == "purchase", item('{"date": "", "meta": {}, "metadata": {"date": "%s"}}', iso))
        .otherwise(F.lit('{"date": "later"}'))
    )
    e = table(spark, sf, "events").select("event_id", payload.alias("payload"))
    return e.select("event_id", J.published_at("payload").cast("timestamp_ntz").alias("x"))


@query("f18_json_number", "SELECT event_id, CAST(props->>'$.k' AS DOUBLE) AS k FROM events")
def number(spark, sf):
    return table(spark, sf, "events").select("event_id", J.json_number("props", "$.k").alias("k"))




@query(
    "f19_metric_columns",
    cte("runs") + "SELECT run_id, smape AS \"SMAPE\", mae AS \"MAE\", CAST(NULL AS DOUBLE) AS \"R2\" FROM runs",
)
def metric_cols(spark, sf):
    return J.metric_columns(runs(spark, sf), "metrics").select("run_id", "SMAPE", "MAE", "R2")


@query(
    "f20_metric_map",
    cte("runs")
    + "SELECT run_id, 'MAE' AS metric, mae AS x FROM runs UNION ALL SELECT run_id, 'SMAPE', smape FROM runs WHERE smape IS NOT NULL "
    "UNION ALL SELECT run_id, 'R2', 0.5 FROM runs",
)
def metric_maps(spark, sf):
    named = J.metric_map(runs(spark, sf).withColumns({"R2": F.lit(0.5), "MAE": F.lit(-1.0)}), "metrics")
    return named.select("run_id", F.explode("metrics_all").alias("metric", "x"))


@query("f21_algorithm", cte("runs") + "SELECT run_id, algorithm FROM runs")
def algorithm(spark, sf):
    return runs(spark, sf).select("run_id", J.algorithm("params").alias("algorithm"))


@query("f22_strip_fence", "SELECT event_id, props AS x FROM events")
def fence(spark, sf):
    e = table(spark, sf, "events")
    fenced = F.when(F.col("event_type") == "view", F.col("props")).otherwise(F.concat(F.lit(" ```json\n"), "props", F.lit("\n```\n")))
    return e.select("event_id", T.strip_fence(fenced).alias("x"))


@query(
    "f24_labels",
    cte("ord") + f"SELECT o_orderkey, strftime(date, '%Y-%m-%d %H:%M:%S') AS shown, CAST(year(date) AS VARCHAR) || '-W' || strftime(date, '%U') AS label FROM ord",
)
def labels(spark, sf):
    o = orders(spark, sf).withColumns({"year": F.year("date"), "week": D.week_u("date")})
    return o.select("o_orderkey", D.fmt_ts("date").alias("shown"), D.week_label("year", "week").alias("label"))


@query("f26_decade_month", cte("ord") + "SELECT o_orderkey, CAST(year(date) // 10 * 10 AS INTEGER) AS decade, CAST(month(date) AS INTEGER) AS month FROM ord")
def decade_month(spark, sf):
    return orders(spark, sf).select("o_orderkey", D.decade("date").alias("decade"), F.month("date").alias("month"))


@query("f27_json_key_count", "SELECT CAST(11 AS INTEGER) AS members, COUNT(*) AS n FROM lineitem")
def key_count(spark, sf):
    line = table(spark, sf, "lineitem").withColumn("l_shipdate", F.col("l_shipdate").cast("date"))
    return line.select(J.json_key_count(line).alias("members")).groupBy("members").agg(F.count(F.lit(1)).alias("n"))


@query("f28_text_len", "SELECT doc_id, CAST(length(COALESCE(text, '')) AS INTEGER) AS x FROM documents")
def text_length(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.text_len("text").alias("x"))
