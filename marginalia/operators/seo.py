"""Organic-search operators and the paid/organic overlap (K-18..K-20, V-05, V-06).

``perf`` is search-console performance: (query_date, site, query, page,
country, device, impressions, clicks, ctr, position).

Scale notes
* every operator first reduces the daily rows with a ``groupBy`` over its
  grain; the week-over-week ``lag`` then runs over at most a handful of weekly
  rows per (site, query, page), bounded by the look-back.
* the paid side of the overlap is pre-aggregated to one row per (date, term,
  campaign) before the full outer join, so the fan-out of an organic row is
  the number of campaigns that bought its query that day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marginalia.functions import monday_week, round_half_away, safe_div, sunday_week

# Fixed values that must equal the reference's for equal results:
#   opportunities: last 30 days, avg position 5..20, >= 100 impressions, score = round(impr / pos * 10, 2)
#   content gaps: last 30 days, >= 200 impressions, ctr < 0.05; actions: pos <= 5 & ctr < 0.05 optimize_title,
#                 pos 5..10 & ctr < 0.03 optimize_meta, pos > 10 & ctr < 0.02 review_content, else monitor
#   trends: last 28 days, Monday weeks, change <= -1 improving, >= 1 declining, else stable
#   overlap: position <= 3 strong_organic_and_paid, 4..10 weak_organic_and_paid, else organic_and_paid


def _since(perf: DataFrame, as_of: str, days: int) -> DataFrame:
    return perf.where(F.col("query_date") >= F.date_sub(F.lit(as_of).cast("date"), days))


def seo_opportunities(perf: DataFrame, as_of: str, *, days: int = 30, min_pos: float = 5, max_pos: float = 20,
                      min_impressions: int = 100) -> DataFrame:
    """K-18: striking-distance queries."""
    r = _since(perf, as_of, days).groupBy("site", "query", "page").agg(
        F.avg("position").alias("avg_position"), F.sum("impressions").alias("impressions_30d"),
        F.sum("clicks").alias("clicks_30d"), safe_div(F.sum("clicks"), F.sum("impressions")).alias("ctr"))
    r = r.where(F.col("avg_position").between(min_pos, max_pos) & (F.col("impressions_30d") >= min_impressions))
    return r.select("site", "query", "page", "avg_position", "impressions_30d", "clicks_30d", "ctr",
                    round_half_away(F.col("impressions_30d") * (1.0 / F.col("avg_position")) * 10, 2)
                    .alias("opportunity_score"))


def seo_content_gaps(perf: DataFrame, as_of: str, *, days: int = 30, min_impressions: int = 200,
                     max_ctr: float = 0.05) -> DataFrame:
    """K-19: pages with many impressions and a low click-through rate, with a suggested action."""
    p = _since(perf, as_of, days).groupBy("site", "page").agg(
        F.sum("impressions").alias("total_impressions"), F.sum("clicks").alias("total_clicks"),
        safe_div(F.sum("clicks"), F.sum("impressions")).alias("avg_ctr"), F.avg("position").alias("avg_position"))
    p = p.where((F.col("total_impressions") >= min_impressions) & (F.col("avg_ctr") < max_ctr))
    pos, ctr = F.col("avg_position"), F.col("avg_ctr")
    act = (F.when((pos <= 5) & (ctr < 0.05), "optimize_title")
           .when(pos.between(5, 10) & (ctr < 0.03), "optimize_meta")
           .when((pos > 10) & (ctr < 0.02), "review_content").otherwise("monitor"))
    return p.select("site", "page", "total_impressions", "total_clicks", "avg_ctr", "avg_position",
                    act.alias("suggested_action"))


def seo_trends(perf: DataFrame, as_of: str, *, days: int = 28) -> DataFrame:
    """K-20: week-over-week average position per (site, query, page)."""
    wk = _since(perf, as_of, days).groupBy("site", "query", "page", monday_week("query_date").alias("week_start")) \
        .agg(F.avg("position").alias("current_week_position"), F.sum("clicks").alias("current_week_clicks"),
             F.sum("impressions").alias("current_week_impressions"))
    w = Window.partitionBy("site", "query", "page").orderBy("week_start")
    wp = wk.withColumn("prior_week_position", F.lag("current_week_position").over(w)) \
        .where(F.col("prior_week_position").isNotNull())
    delta = F.col("current_week_position") - F.col("prior_week_position")
    trend = (F.when(F.col("prior_week_position").isNull(), "new").when(delta <= -1, "improving")
             .when(delta >= 1, "declining").otherwise("stable"))
    return wp.select("site", "query", "page", "week_start", "current_week_position", "prior_week_position",
                     round_half_away(delta, 2).alias("position_change"), "current_week_clicks",
                     "current_week_impressions", trend.alias("trend"))


def paid_vs_organic(perf: DataFrame, terms: DataFrame) -> DataFrame:
    """V-05: organic rows and paid search terms on the same query and day, with an overlap label.

    A full join as a left join and an anti join: adaptive execution can split a
    brand query's day in both, which it cannot in a full outer join.
    """
    o = perf.select("query_date", "site", "query", "page", "device", "country",
                    F.col("clicks").alias("organic_clicks"), F.col("impressions").alias("organic_impressions"),
                    F.col("ctr").alias("organic_ctr"), F.col("position").alias("organic_position"))
    p = terms.groupBy("date_start", "search_term", "campaign_id", "campaign_name").agg(
        F.sum("clicks").alias("paid_clicks"), F.sum("impressions").alias("paid_impressions"),
        F.sum("spend").alias("paid_spend"), F.sum("conversions").alias("paid_conversions"),
        F.sum("conversion_value").alias("paid_conversion_value"))
    seen = perf.select(F.col("query").alias("_query"), F.col("query_date").alias("_day")).distinct()
    only_paid = p.join(seen, (p["search_term"] == seen["_query"]) & (p["date_start"] == seen["_day"]), "left_anti")
    j = o.join(p, (o["query"] == p["search_term"]) & (o["query_date"] == p["date_start"]), "left")
    j = j.unionByName(only_paid, allowMissingColumns=True)
    both = F.col("query").isNotNull() & F.col("search_term").isNotNull()
    pos = F.col("organic_position")
    label = (F.when(both & (pos <= 3), "strong_organic_and_paid")
             .when(both & pos.between(4, 10), "weak_organic_and_paid")
             .when(both, "organic_and_paid")
             .when(F.col("query").isNotNull() & F.col("search_term").isNull(), "organic_only")
             .otherwise("paid_only"))
    return j.select(
        F.coalesce("query_date", "date_start").alias("report_date"),
        F.coalesce("query", "search_term").alias("query"), "site", "page", "device", "country",
        "organic_clicks", "organic_impressions", "organic_ctr", "organic_position", "campaign_id",
        "campaign_name", "paid_clicks", "paid_impressions", "paid_spend", "paid_conversions",
        "paid_conversion_value", label.alias("overlap_type"))


def trends_vs_spend(interest: DataFrame, search_daily: DataFrame) -> DataFrame:
    """V-06: weekly search interest against that (Sunday) week's total search spend."""
    t = interest.where(~F.col("is_partial")).select("week", "keyword", "interest_score")
    s = search_daily.groupBy(sunday_week("date_start").alias("week")).agg(
        F.sum("spend").alias("total_weekly_spend"), F.sum("impressions").alias("total_weekly_impressions"),
        F.sum("clicks").alias("total_weekly_clicks"), F.sum("conversions").alias("total_weekly_conversions"),
        F.sum("conversion_value").alias("total_weekly_conversion_value"))
    j = t.join(s, "week", "left")
    return j.select("week", "keyword", "interest_score", "total_weekly_spend", "total_weekly_impressions",
                    "total_weekly_clicks", "total_weekly_conversions", "total_weekly_conversion_value",
                    safe_div(F.col("interest_score"), F.col("total_weekly_spend")).alias("interest_per_spend_dollar"))
