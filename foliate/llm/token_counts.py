"""Token counts: the exact histogram of encoded lengths, and what follows from it for any context limit.

Documents are counted by encoded length. With the histogram summed from its long end,
one row answers everything about a limit L: how many documents exceed it, how many
tokens there are in all, and how many remain when each text is cut at L tokens. The
answers are exact for every limit, not only for those that occur as lengths.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliate.llm.frames import id_and_text, map_texts
from foliate.session import materialize

#: Lengths are summed in blocks of this many, so that no single task sorts all distinct lengths.
BLOCK = 1024


def _counter(vocabulary: str) -> Callable[[], Callable[[list[str | None]], dict[str, Sequence]]]:
    def make() -> Callable[[list[str | None]], dict[str, Sequence]]:
        import base64

        import public_tokenizers
        import tiktoken

        with open(vocabulary, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
        encoding = tiktoken.Encoding("counted", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        return lambda texts: {"n_tokens": [len(encoding.encode_ordinary(t)) if t else 0 for t in texts]}

    return make


def encoded_lengths(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``n_tokens`` of every whole text; null and empty texts have none. ``vocabulary``: a file of ranks every executor can read."""
    return map_texts(id_and_text(docs, id_col, text_col), _counter(vocabulary), "n_tokens bigint")


def length_histogram(lengths: DataFrame) -> DataFrame:
    """``n_tokens`` and ``docs``, exact; the counts are added up before they are shuffled, so a common length is no hot key."""
    return lengths.groupBy("n_tokens").agg(F.count("*").alias("docs"))


def limit_table(histogram: DataFrame) -> DataFrame:
    """One row per length that occurs, read as a context limit:

    ``docs`` of that length, ``docs_over`` longer ones, ``tokens_over`` the tokens of those,
    ``tokens_total`` of all, ``tokens_truncated`` left after cutting every text at the limit,
    ``tokens_lost`` by that, ``share_at_most`` of the documents at that length or below
    (the quantile it is). An empty histogram gives no rows.
    """
    # Read twice below: written once, so that no text is encoded twice.
    histogram = materialize(histogram)
    tokens = F.col("docs") * F.col("n_tokens")
    block = F.floor(F.col("n_tokens") / BLOCK)
    blocks = histogram.groupBy(block.alias("block")).agg(F.sum("docs").alias("d"), F.sum(tokens).alias("t"))
    # One row per BLOCK lengths: the longest text's length over BLOCK at most.
    after = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    later = blocks.select(
        "block",
        F.coalesce(F.sum("d").over(after), F.lit(0)).alias("d_after"),
        F.coalesce(F.sum("t").over(after), F.lit(0)).alias("t_after"),
        F.sum("d").over(everything).alias("d_all"),
        F.sum("t").over(everything).alias("t_all"),
    )
    inside = Window.partitionBy("block").orderBy(F.col("n_tokens").desc()).rowsBetween(Window.unboundedPreceding, -1)
    summed = histogram.withColumn("block", block).select(
        "block",
        "n_tokens",
        "docs",
        F.coalesce(F.sum("docs").over(inside), F.lit(0)).alias("d_in"),
        F.coalesce(F.sum(tokens).over(inside), F.lit(0)).alias("t_in"),
    )
    over, tokens_over = F.col("d_in") + F.col("d_after"), F.col("t_in") + F.col("t_after")
    lost = F.col("tokens_over") - F.col("docs_over") * F.col("context_limit")
    return (
        summed.join(later, "block")
        .select(F.col("n_tokens").alias("context_limit"), "docs", over.alias("docs_over"), tokens_over.alias("tokens_over"), F.col("t_all").alias("tokens_total"), "d_all")
        .select(
            "context_limit",
            "docs",
            "docs_over",
            "tokens_over",
            "tokens_total",
            (F.col("tokens_total") - lost).alias("tokens_truncated"),
            lost.alias("tokens_lost"),
            ((F.col("d_all") - F.col("docs_over")) / F.col("d_all")).alias("share_at_most"),
        )
    )


def at_limits(histogram: DataFrame, limits: Sequence[int]) -> DataFrame:
    """The answers for given limits, whether or not they occur as lengths: one pass over the histogram."""

    def cut(limit: int) -> Column:
        return F.struct(
            F.lit(limit).cast("bigint").alias("context_limit"),
            F.sum(F.when(F.col("n_tokens") > limit, F.col("docs")).otherwise(0)).alias("docs_over"),
            F.sum(F.col("docs") * F.least("n_tokens", F.lit(limit))).alias("tokens_truncated"),
            F.sum(F.col("docs") * F.col("n_tokens")).alias("tokens_total"),
        )

    return histogram.agg(F.array(*(cut(x) for x in limits)).alias("rows")).select(F.inline("rows"))


def quantiles(histogram: DataFrame, shares: Sequence[float]) -> DataFrame:
    """``share`` and the smallest length that at least that share of the documents does not exceed."""
    table = limit_table(histogram)
    picked = [F.struct(F.lit(float(s)).alias("share"), F.min(F.when(F.col("share_at_most") >= s, F.col("context_limit"))).alias("n_tokens")) for s in shares]
    return table.agg(F.array(*picked).alias("rows")).select(F.inline("rows"))
