"""Token counts by an exact length histogram.

Documents are encoded once and aggregated by encoded length.  Everything a
context limit can ask of the corpus (how many documents fit, the total, the
total after truncation, quantiles of the length) follows from suffix sums over
that histogram, so no later question reads the texts again.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marginalia.llm import tokens
from marginalia.llm.common import id_and_text, slices, write_shared


def token_lengths(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, n_tokens) of every document; a null or empty text has 0 tokens."""
    def encode(batches):
        for b in slices(batches):
            n = [len(tokens.encode(t, vocabulary)) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64())], names=["doc_id", "n_tokens"])

    return id_and_text(docs).mapInArrow(encode, "doc_id long, n_tokens long")


def length_histogram(lengths: DataFrame, block: int = 1024) -> DataFrame:
    """One row per distinct length, with exact suffix sums.

    ``n_docs`` documents have ``length`` tokens; ``docs_at_least`` and
    ``tokens_at_least`` count the documents of this length or more and their
    tokens; ``truncated_total`` is the corpus total if every document were cut
    at ``length``; ``total_tokens`` the uncut total; ``share_below`` the share
    of documents that are shorter.

    The documents are aggregated before the shuffle, so a length that a third
    of them share is one row a task.  Suffix sums take two levels: inside
    blocks of ``block`` lengths, and over the block totals; the second window
    sees (longest length / block) rows.  An empty table gives no rows.
    """
    hist = lengths.groupBy(F.col("n_tokens").alias("length")).agg(F.count(F.lit(1)).alias("n_docs"))
    hist = write_shared(hist.withColumn("_block", F.floor(F.col("length") / block)), "lengths")  # read twice, texts once
    here = Window.partitionBy("_block").orderBy(F.col("length").desc()).rowsBetween(Window.unboundedPreceding, 0)
    later = Window.orderBy(F.col("_block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    all_blocks = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = hist.groupBy("_block").agg(F.sum("n_docs").alias("_d"), F.sum(F.col("n_docs") * F.col("length")).alias("_t"))
    blocks = blocks.select("_block", F.coalesce(F.sum("_d").over(later), F.lit(0)).alias("_d_later"),
                           F.coalesce(F.sum("_t").over(later), F.lit(0)).alias("_t_later"),
                           F.sum("_d").over(all_blocks).alias("_docs"), F.sum("_t").over(all_blocks).alias("total_tokens"))
    out = hist.select("*", F.sum("n_docs").over(here).alias("_dh"),
                      F.sum(F.col("n_docs") * F.col("length")).over(here).alias("_th"))
    out = out.join(blocks, "_block").withColumns({"docs_at_least": F.col("_dh") + F.col("_d_later"),
                                                  "tokens_at_least": F.col("_th") + F.col("_t_later")})
    return out.select(
        "length", "n_docs", "docs_at_least", "tokens_at_least",
        (F.col("total_tokens") - F.col("tokens_at_least") + F.col("docs_at_least") * F.col("length")).alias("truncated_total"),
        "total_tokens", ((F.col("_docs") - F.col("docs_at_least")) / F.col("_docs")).alias("share_below"))


def for_limits(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """(context_limit, docs_over, truncated_total): the answers for given limits, from the histogram alone."""
    one = [F.struct(F.lit(int(k)).cast("long").alias("context_limit"),
                    F.sum(F.when(F.col("length") > k, F.col("n_docs")).otherwise(0)).alias("docs_over"),
                    F.sum(F.least(F.col("length"), F.lit(int(k))) * F.col("n_docs")).alias("truncated_total")).alias(f"_{i}")
           for i, k in enumerate(limits)]
    return histogram.agg(*one).select(F.inline(F.array(*[f"_{i}" for i in range(len(limits))])))


def quantiles(histogram: DataFrame, shares: list[float]) -> DataFrame:
    """(share, length): the smallest length that at least this share of the documents stay within."""
    total = histogram.agg(F.sum("n_docs").alias("_n"))
    up_to = histogram.join(F.broadcast(total)).select(  # one row
        "length", ((F.col("_n") - F.col("docs_at_least") + F.col("n_docs")) / F.col("_n")).alias("_share"))
    one = [F.struct(F.lit(float(q)).alias("share"), F.min(F.when(F.col("_share") >= q, F.col("length"))).alias("length")).alias(f"_{i}")
           for i, q in enumerate(shares)]
    return up_to.agg(*one).select(F.inline(F.array(*[f"_{i}" for i in range(len(shares))])))
