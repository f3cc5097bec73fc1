import datetime as dt

from marginalia.operators import search as se

TERMS = ("date_start date, search_term string, campaign_name string, impressions long, clicks long, "
         "spend double, conversions double, keyword_text string")


def test_bigrams_bridge_stop_words_and_capitals(spark):
    df = spark.createDataFrame([("Red the shoes shoes",), ("Pickle Ball!",)], "t string")
    words = [r.w for r in df.select(se.term_words(df.t).alias("w")).collect()]
    assert words[0] == ["ed", "shoes", "shoes"]      # capital R becomes a space before lower-casing
    assert words[1] == ["ickle", "all"]
    grams = df.select(se.term_ngrams(se.term_words(df.t)).alias("g")).first().g
    assert [(g.ngram, g.ngram_length) for g in grams] == [
        ("ed", 1), ("shoes", 1), ("shoes", 1), ("ed shoes", 2), ("shoes shoes", 2)]


def test_ngram_aggregation(spark):
    d = dt.date(2024, 2, 5)
    df = spark.createDataFrame([
        (d, "red shoes", "c1", 10, 2, 3.0, 0.0, "k"), (d, "red boots", "c1", 10, 2, 3.0, 0.0, "k"),
        (d, "blue hat", "c1", 5, 1, 1.0, 1.0, "k"), (d, "zero", "c1", 5, 1, 0.0, 0.0, "k")], TERMS)
    out = {(r.ngram, r.ngram_length): r for r in se.search_term_ngrams(df, "2024-02-26").collect()}
    assert out[("red", 1)].unique_search_terms == 2 and out[("red", 1)].total_spend == 6.0
    assert out[("red", 1)].signal == "watch"
    assert ("blue", 1) not in out and ("zero", 1) not in out     # single term, spend < 5 / spend 0


def test_waste_arrays_and_having(spark):
    d = dt.date(2024, 2, 5)
    df = spark.createDataFrame([(d, "t", "c2", 1, 1, 3.0, 0.0, None), (d, "t", "c1", 1, 1, 3.0, 0.0, "k"),
                                (d, "u", "c1", 1, 1, 9.0, 1.0, "k")], TERMS)
    rows = se.search_terms_waste(df).collect()
    assert len(rows) == 1 and rows[0].campaigns == ["c1", "c2"] and rows[0].matched_keywords == ["k"]


def test_ngrams_count_a_term_once_however_often_it_holds_a_word(spark):
    """One term repeats a word, a second holds it once, in two rows of one week: two terms, every occurrence's spend."""
    rows = [(dt.date(2024, 2, 20), "red red shoe", "c", 10, 2, 4.0, 0.0), (dt.date(2024, 2, 21), "red hat", "c", 10, 2, 3.0, 0.0),
            (dt.date(2024, 2, 22), "red hat", "c", 10, 2, 3.0, 0.0), (dt.date(2024, 2, 20), "", "c", 1, 0, 9.0, 0.0)]
    df = spark.createDataFrame(rows, "date_start date, search_term string, campaign_name string, impressions long, clicks long, spend double, conversions double")
    got = {(r.ngram, r.ngram_length): (r.unique_search_terms, r.total_impressions, r.total_spend)
           for r in se.search_term_ngrams(df, "2024-02-26").collect()}
    assert got == {("red", 1): (2, 40, 14.0), ("hat", 1): (1, 20, 6.0), ("red hat", 2): (1, 20, 6.0)}
