"""Published views (V-01..V-04, V-07) and the alias views (V-08..V-30).

The alias views of the source project are ``select * from <model>``; here
``publish`` registers a DataFrame under each published name as a temporary
view, so SQL users can keep querying the old names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.functions import safe_div

# Fixed values that must equal the reference's for equal results:
#   account label of the email views: "store";  campaigns kept: status "Sent"
#   product health defaults: approval "unknown", reasons ""
ACCOUNT = "store"

# published alias name -> model it exposes unchanged (V-08..V-30)
ALIASES = {
    "google_ads_auction_insights": "auction_insights",
    "google_ads_shopping_performance": "shopping_performance",
    "search_console_performance": "search_performance",
    "vw_channel_summary": "channel_summary",
    "vw_component_scores": "component_scores",
    "vw_content_performance": "content_performance",
    "vw_creative_performance": "creative_performance",
    "vw_customer_ltv": "customer_ltv",
    "vw_daily_performance": "daily_performance",
    "vw_enhanced_roas": "enhanced_roas",
    "vw_ga4_attribution": "ga4_attribution",
    "vw_ga4_funnel": "ga4_funnel",
    "vw_ga4_product_insights": "ga4_product_insights",
    "vw_google_ads_copy_performance": "google_ads_copy_performance",
    "vw_google_ads_keywords": "google_ads_keywords",
    "vw_product_performance": "product_performance",
    "vw_product_profitability": "product_profitability",
    "vw_search_terms_waste": "search_terms_waste",
    "vw_seo_content_gaps": "seo_content_gaps",
    "vw_seo_opportunities": "seo_opportunities",
    "vw_seo_trends": "seo_trends",
    "vw_trends": "trends",
    "vw_true_roas": "true_roas",
}


def publish(models: dict[str, DataFrame]) -> list[str]:
    """V-08..V-30: register every available model under its published alias; returns the names."""
    done = []
    for alias, model in ALIASES.items():
        if model in models:
            models[model].createOrReplaceTempView(alias)
            done.append(alias)
    return done


def schedule_performance(schedule: DataFrame) -> DataFrame:
    """V-01: dayparting rows with return and cost per conversion (zero -> NULL)."""
    return schedule.select(
        F.col("date_start").alias("date"), "campaign_id", "campaign_name", "criterion_id", "day_of_week",
        "start_hour", "end_hour", "start_minute", "end_minute", "impressions", "clicks", "cost", "conversions",
        "conversions_value", safe_div(F.col("conversions_value"), F.col("cost")).alias("roas"),
        safe_div(F.col("cost"), F.col("conversions")).alias("cpa"), "ingested_at")


def email_campaign_summary(campaigns: DataFrame, metrics: DataFrame, *, account: str = ACCOUNT) -> DataFrame:
    """V-02: sent campaigns with delivery-based rates."""
    c = campaigns.where(F.col("status") == "Sent")
    j = c.join(metrics, "campaign_id", "left")
    d = F.col("delivered")
    return j.select(
        "campaign_id", "campaign_name", F.lit(account).alias("account"),
        F.col("send_time").cast("date").alias("send_date"), "recipients", "delivered", "opens",
        safe_div(F.col("opens"), d).alias("open_rate"), "clicks", safe_div(F.col("clicks"), d).alias("click_rate"),
        "unsubscribes", safe_div(F.col("unsubscribes"), d).alias("unsubscribe_rate"), "conversions", "revenue",
        safe_div(F.col("revenue"), d).alias("revenue_per_recipient"), "ingested_at")


def email_performance(timeline: DataFrame, *, account: str = ACCOUNT) -> DataFrame:
    """V-03: daily email metric timeline with the account label."""
    return timeline.select("date", F.lit(account).alias("account"), "metric_name", "value", "ingested_at")


def product_health(products: DataFrame, statuses: DataFrame) -> DataFrame:
    """V-04: feed products with their latest approval status.

    The latest status per product is a ``max(struct(ingested_at, ...))``
    aggregate (ties broken by the other fields), not a ranked window.
    """
    latest = statuses.groupBy("product_id").agg(
        F.max(F.struct("ingested_at", "approval_status", "disapproval_reasons")).alias("s")).select(
        "product_id", F.col("s.approval_status").alias("approval_status"),
        F.col("s.disapproval_reasons").alias("disapproval_reasons"))
    j = products.join(latest, "product_id", "left")
    return j.select("product_id", "title", "availability", F.col("price_value").alias("price"), "brand",
                    F.coalesce("approval_status", F.lit("unknown")).alias("approval_status"),
                    F.coalesce("disapproval_reasons", F.lit("")).alias("disapproval_reasons"), "ingested_at")


def interest_weekly(interest: DataFrame) -> DataFrame:
    """V-07: weekly interest series as published."""
    return interest.select("week", "keyword", "interest_score", "is_partial")


# T-06..T-16: marts that materialise an intermediate model unchanged
PASS_THROUGH_MARTS = {
    "fct_finance__affiliate_by_partner": "affiliate_by_partner",
    "fct_finance__expense_by_vendor": "expense_by_vendor",
    "fct_finance__expense_detail": "monthly_expenses",
    "fct_finance__expense_enriched": "expense_enriched",
    "fct_finance__monthly_pnl": "monthly_pnl",
    "fct_finance__monthly_revenue": "monthly_revenue",
    "fct_finance__subscription_analysis": "subscription_analysis",
    "fct_marketing__channel_summary": "channel_summary",
    "fct_marketing__enhanced_roas": "enhanced_roas",
    "fct_marketing__product_profitability": "product_profitability",
    "fct_marketing__trends": "trends",
}


def materialize(models: dict[str, DataFrame], root: str, *, names: list[str] | None = None) -> list[str]:
    """T-06..T-16: write each pass-through mart as a Parquet table under ``root`` (full refresh).

    Writing the mart once cuts the lineage: readers of the mart no longer
    recompute the whole ancestry of views, as the source warehouse's views do.
    """
    done = []
    for mart, model in PASS_THROUGH_MARTS.items():
        if model in models and (names is None or mart in names):
            models[model].write.mode("overwrite").parquet(f"{root.rstrip('/')}/{mart}")
            done.append(mart)
    return done
