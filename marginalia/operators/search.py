"""Paid-search operators: keyword tiers, wasted search terms, ad-copy roll-up and
search-term n-grams (K-10, K-11, K-12, T-05).

Scale notes
* n-grams are built inside each row with array functions (filter the
  normalised words, pair each kept word with the next kept word) and exploded
  once; no window over word positions.
* a term's n-grams take many times the term's bytes, so terms are dealt by
  week and campaign before the explode and their n-grams are summed where
  they arise, without a shuffle; only a week of a campaign that holds a large
  share of all rows is spread by term, and its n-grams are shuffled.
* the ad-copy join pushes the 30-day date predicate into the right side
  (it sits in the ON clause in the source model, so unmatched copy stays).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginalia.functions import monday_week, safe_div
from marginalia.functions.windows import spread

# Fixed values that must equal the reference's for equal results:
#   stop words removed from n-grams (32):
STOP_WORDS = (
    "a", "an", "the", "and", "or", "but",
    "in", "on", "at", "to", "for", "of", "with", "by", "from",
    "is", "are", "was", "were", "be", "been",
    "it", "its", "this", "that", "i", "my", "me",
    "we", "us", "you", "your",
)
#   term normaliser: characters outside [a-z0-9 ] become a space, applied
#   before lower-casing (so capitals become spaces, as in the source model)
NORMALISE_PATTERN = "[^a-z0-9 ]+"
#   n-gram signals: no conversions and spend >= 10 wasteful, >= 5 watch;
#   conversion rate >= 0.05 top_performer, >= 0.02 good; else neutral
#   kept n-grams: >= 2 distinct terms or spend >= 5;  look-back 8 weeks
#   wasted terms: spend > 0 rows, no conversions, spend >= 5
#   keyword tiers: roas >= 3 & conv >= 3 top_performer; roas >= 2 & conv >= 1 good;
#                  roas >= 1 marginal; spend > 10 & conv = 0 wasted_spend; else underperformer


def term_words(term: Column, lower_first: bool = False) -> Column:
    """Kept words of a search term, in order (blanks and stop words removed)."""
    if lower_first:
        norm = F.regexp_replace(F.lower(F.trim(term)), NORMALISE_PATTERN, " ")
    else:
        norm = F.lower(F.regexp_replace(F.trim(term), NORMALISE_PATTERN, " "))
    return F.filter(F.split(norm, " "), lambda w: ~w.isin("", *STOP_WORDS))


def gram_texts(words: Column) -> Column:
    """array<string>: every kept word, then every kept-word pair; words hold no space, so a text with one is a pair."""
    n = F.greatest(F.size(words) - 1, F.lit(0))
    pairs = F.zip_with(F.slice(words, F.lit(1), n), F.slice(words, F.lit(2), n), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.concat(words, pairs)


def gram_length(gram: Column) -> Column:
    return F.when(F.contains(gram, F.lit(" ")), 2).otherwise(1)


def term_ngrams(words: Column) -> Column:
    """array<struct<ngram, ngram_length>>: every kept word, then every kept-word pair."""
    return F.transform(gram_texts(words), lambda g: F.struct(g.alias("ngram"), gram_length(g).alias("ngram_length")))


#: A week of a campaign is large when it has more rows than this, and more than one in ``LARGE_SHARE`` of all.
LARGE_ROWS, LARGE_SHARE = 100_000, 32
#: Partitions for each week of a campaign, so that few of them meet in a task, and the most there are for that.
PER_GROUP, MOST_PARTS = 4, 2048


def _groups(recent: DataFrame) -> tuple[int, Column | None]:
    """The number of (week, campaign) groups, and whether a row is of a large one, None where there is none.

    Below ``LARGE_SHARE`` keys reach the driver."""
    sizes = recent.groupBy("week_start", "campaign_name").count()
    n, total, most = sizes.agg(F.count(F.lit(1)), F.sum("count"), F.max("count")).first()
    large = None
    least = max(LARGE_ROWS, (total or 0) // LARGE_SHARE)
    for k in sizes.where(F.col("count") > least).collect() if n and most > least else []:
        this = F.col("week_start").eqNullSafe(F.lit(k["week_start"])) & F.col("campaign_name").eqNullSafe(F.lit(k["campaign_name"]))
        large = this if large is None else large | this
    return n, large


def _gram_sums(recent: DataFrame, lower_first: bool) -> DataFrame:
    """Sums of each (week, n-gram, campaign), exchanged where the rows are not yet dealt by week and campaign."""
    weekly = recent.groupBy("week_start", "search_term", "campaign_name").agg(
        F.sum("impressions").alias("impressions"), F.sum("clicks").alias("clicks"),
        F.sum("spend").alias("spend"), F.sum("conversions").alias("conversions"))
    # words are projected once as a column: referencing the split expression
    # inside the pairing lambda would re-evaluate it for every element
    words = weekly.select(
        "week_start", "campaign_name", "impressions", "clicks", "spend", "conversions",
        term_words(F.col("search_term"), lower_first).alias("words"))
    # beside each n-gram stands the one before it, null for the first
    ordered = words.withColumn("grams", F.sort_array(gram_texts(F.col("words"))))
    grams = ordered.select(
        "week_start", "campaign_name", "impressions", "clicks", "spend", "conversions",
        F.explode(F.arrays_zip(F.col("grams").alias("g"), F.concat(F.array(F.lit(None)), F.col("grams")).alias("before")))
        .alias("z")).where("z.g is not null").select(
        "week_start", "campaign_name", "impressions", "clicks", "spend", "conversions", "z.g",
        (~F.col("z.g").eqNullSafe(F.col("z.before"))).cast("bigint").alias("first"))
    return grams.groupBy("week_start", F.col("g").alias("ngram"), "campaign_name").agg(
        F.sum("first").alias("unique_search_terms"),
        F.sum("impressions").alias("total_impressions"), F.sum("clicks").alias("total_clicks"),
        F.sum("spend").alias("total_spend"), F.sum("conversions").alias("total_conversions"))


def search_term_ngrams(terms: DataFrame, as_of: str, *, weeks: int = 8, lower_first: bool = False) -> DataFrame:
    """T-05: 1- and 2-word n-grams x campaign x Monday week with spend signals.

    A (week, term, campaign) is one row before its n-grams are exploded, so
    the terms that hold an n-gram are counted by a mark on its first place in
    the row's sorted n-grams.  Rows are dealt by week and campaign, so that
    both groupings need no other exchange; those of a large week of a campaign
    (rows are counted first) are dealt by term, their n-grams exchanged.
    """
    recent = terms.where((F.col("spend") > 0) &
                         (F.col("date_start") >= F.date_sub(F.lit(as_of).cast("date"), 7 * weeks)))
    recent = recent.select(monday_week("date_start").alias("week_start"), "search_term", "campaign_name",
                           "impressions", "clicks", "spend", "conversions")
    groups, large = _groups(recent)
    rest = recent if large is None else recent.where(~large)
    agg = _gram_sums(spread(rest, "week_start", "campaign_name", least=min(PER_GROUP * groups, MOST_PARTS)), lower_first)
    if large is not None:
        agg = agg.unionByName(_gram_sums(recent.where(large), lower_first))
    cvr = safe_div(F.col("total_conversions"), F.col("total_clicks"))
    sig = (F.when((F.col("total_conversions") == 0) & (F.col("total_spend") >= 10), "wasteful")
           .when((F.col("total_conversions") == 0) & (F.col("total_spend") >= 5), "watch")
           .when(cvr >= 0.05, "top_performer").when(cvr >= 0.02, "good").otherwise("neutral"))
    return (agg.where((F.col("unique_search_terms") >= 2) | (F.col("total_spend") >= 5))
            .select("week_start", "ngram", gram_length(F.col("ngram")).alias("ngram_length"), "campaign_name", "unique_search_terms",
                    "total_impressions", "total_clicks", "total_spend", "total_conversions",
                    safe_div(F.col("total_clicks"), F.col("total_impressions")).alias("avg_ctr"),
                    cvr.alias("avg_cvr"), sig.alias("signal")))


def search_terms_waste(terms: DataFrame, *, min_spend: float = 5.0) -> DataFrame:
    """K-12: search terms with spend and no conversions (negative keyword candidates)."""
    g = terms.where(F.col("spend") > 0).groupBy("search_term").agg(
        F.sum("impressions").alias("total_impressions"), F.sum("clicks").alias("total_clicks"),
        F.sum("spend").alias("total_spend"), F.sum("conversions").alias("total_conversions"),
        safe_div(F.sum("clicks"), F.sum("impressions")).alias("avg_ctr"),
        F.count_distinct("date_start").alias("days_seen"),
        F.array_sort(F.collect_set("campaign_name")).alias("campaigns"),
        F.array_sort(F.collect_set("keyword_text")).alias("matched_keywords"))
    return g.where((F.col("total_conversions") == 0) & (F.col("total_spend") >= min_spend))


def keyword_performance(terms: DataFrame, keywords: DataFrame) -> DataFrame:
    """K-11: search-term metrics per keyword x campaign x ad group, with quality and tier."""
    kp = terms.groupBy("keyword_text", "campaign_id", "campaign_name", "ad_group_id", "ad_group_name").agg(
        F.sum("impressions").alias("total_impressions"), F.sum("clicks").alias("total_clicks"),
        F.sum("spend").alias("total_spend"), F.sum("conversions").alias("total_conversions"),
        F.sum("conversion_value").alias("total_conversion_value"),
        safe_div(F.sum("clicks"), F.sum("impressions")).alias("avg_ctr"),
        safe_div(F.sum("spend"), F.sum("conversions")).alias("avg_cpa"),
        safe_div(F.sum("conversion_value"), F.sum("spend")).alias("roas"),
        F.count_distinct("date_start").alias("days_active"))
    k = keywords.select(F.col("keyword_text").alias("k_text"), F.col("ad_group_id").alias("k_group"),
                        "quality_score", "expected_ctr", "ad_relevance", "landing_page_experience")
    j = kp.join(k, (kp["keyword_text"] == k["k_text"]) & (kp["ad_group_id"] == k["k_group"]), "left")
    roas, conv, spend = F.col("roas"), F.col("total_conversions"), F.col("total_spend")
    tier = (F.when((roas >= 3.0) & (conv >= 3), "top_performer").when((roas >= 2.0) & (conv >= 1), "good")
            .when(roas >= 1.0, "marginal").when((spend > 10) & (conv == 0), "wasted_spend")
            .otherwise("underperformer"))
    return j.select("keyword_text", "campaign_id", "campaign_name", "ad_group_id", "ad_group_name",
                    "total_impressions", "total_clicks", "total_spend", "total_conversions",
                    "total_conversion_value", "avg_ctr", "avg_cpa", "roas", "days_active", "quality_score",
                    "expected_ctr", "ad_relevance", "landing_page_experience", tier.alias("performance_tier"))


AD_COPY_KEYS = ["ad_id", "campaign_id", "campaign_name", "ad_group_id", "ad_group_name", "ad_type",
                "asset_type", "asset_text", "performance_label"]


def ad_copy_performance(copy: DataFrame, search_daily: DataFrame, as_of: str, *, days: int = 30) -> DataFrame:
    """K-10: ad-group metrics of the last ``days`` days attached to each ad copy asset."""
    g = (search_daily.where(F.col("date_start") >= F.date_sub(F.lit(as_of).cast("date"), days))
         .groupBy(F.col("ad_group_id").alias("g_group")).agg(
             F.sum("spend").alias("spend"), F.sum("impressions").alias("impressions"),
             F.sum("clicks").alias("clicks"), F.sum("conversions").alias("conversions"),
             F.sum("conversion_value").alias("conversion_value")))
    # pre-aggregating the ad-group side first gives the same sums as the
    # row-level join when each copy row matches many daily rows
    c = copy.groupBy(*AD_COPY_KEYS).agg(F.count(F.lit(1)).alias("_copies"))
    j = c.join(g, c["ad_group_id"] == g["g_group"], "left")
    mult = F.col("_copies")
    return j.select(
        *AD_COPY_KEYS,
        (F.col("spend") * mult).alias("ad_group_spend"), (F.col("impressions") * mult).alias("ad_group_impressions"),
        (F.col("clicks") * mult).alias("ad_group_clicks"), (F.col("conversions") * mult).alias("ad_group_conversions"),
        (F.col("conversion_value") * mult).alias("ad_group_conversion_value"),
        safe_div(F.col("conversion_value"), F.col("spend")).alias("ad_group_roas"),
        safe_div(F.col("clicks"), F.col("impressions")).alias("ad_group_ctr"))
