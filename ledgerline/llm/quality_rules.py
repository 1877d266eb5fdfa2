"""Quality rules with cross-document line frequency, in DataFrame functions only.

Base figures come from array functions within a row. The method normalises and hashes the lines of
every document, counts for each host how many different texts hold a line, takes away the lines
above the limits and rejects documents of which too little is left.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.workspace import keep

SPACE = r"[\x20\x09-\x0D]+"
WINDOW = 5


@dataclass(frozen=True)
class LineLimits:
    """A line of any length is above the limits if more than `min_texts` different texts of its host, and more
    than `min_share` of them, hold it. A text is depleted if fewer than `left_words` words are left without
    such lines, or less than `left_share` of its words."""

    min_texts: int = 20
    min_share: float = 0.05
    left_words: int = 5
    left_share: float = 0.1


def word_array(text: Column) -> Column:
    """Runs of characters other than ASCII white space; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def _window_hashes(words: Column) -> Column:
    """A 64-bit hash for each window of five words; none where there are fewer than two windows."""
    last = F.size(words) - WINDOW
    starts = F.sequence(F.lit(0), F.greatest(last, F.lit(0)))
    hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]))
    return F.when(last >= 1, hashes).otherwise(F.array().cast("array<bigint>"))


def _covered(placed: str) -> Column:
    """Words in windows found twice or more, from the column of (hash, start) in hash order: there a repeated window
    stands beside its equal, and in text order each covers the words up to the next one, five at most."""
    twice = F.filter(placed, lambda p, k: (F.get(placed, k - 1)["h"] == p["h"]) | (F.get(placed, k + 1)["h"] == p["h"]))
    starts = F.sort_array(F.transform(twice, lambda p: p["i"]))
    return F.aggregate(
        starts,
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("at")),
        lambda a, i: F.struct((a["n"] + F.least(F.lit(WINDOW), i - a["at"])).alias("n"), i.alias("at")),
        lambda a: a["n"],
    )


def with_base_figures(rows: DataFrame, text: str) -> DataFrame:
    """`rows` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long) and base_failed; null text: no words."""
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    frame = rows.select("*", word_array(F.col(text)).alias("_words"), lines.alias("_lines"))
    frame = frame.select("*", _window_hashes(F.col("_words")).alias("_windows"))
    # Only texts with a repeated window are sorted. A column of its own, so that the lambdas below read it ready made.
    sorted_ones = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    frame = frame.select("*", F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), sorted_ones).alias("_placed"))
    frame = frame.select(
        *rows.columns,
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        (F.length(whole) - F.length(F.regexp_replace(whole, r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(_covered("_placed"), F.lit(0).cast("long")).alias("n_repeat_words"),
    )
    return frame.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))


def _normalised_lines(text: Column) -> Column:
    """(hash, words) of each line with a word: lower case, white space as one blank, numbers as 0."""
    lines = F.split(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"\d+", "0"), "\n")
    lines = F.filter(F.transform(lines, lambda x: F.trim(F.regexp_replace(x, SPACE, " "))), lambda x: x != "")
    return F.transform(lines, lambda x: F.struct(F.xxhash64(x).alias("line"), F.size(F.split(x, " ")).alias("words")))


def depleted_texts(rows: DataFrame, limits: LineLimits) -> DataFrame:
    """Distinct (host_key, text_key) of depleted texts, from rows with host_key, text_key and text.

    Copies of one text count once for a line: which copy stays is for deduplication to decide. The
    counts cover all documents and are combined before they are shuffled, so neither a hot host nor
    a line of every document meets in one task; Spark splits the join with the frequent lines.
    """
    lines = rows.select("host_key", "text_key", F.explode(_normalised_lines(F.col("text"))).alias("l"))
    lines = keep(lines.select("host_key", "text_key", "l.line", "l.words").groupBy("host_key", "text_key", "line").agg(F.max("words").alias("words"), F.count("*").alias("times")))
    texts = lines.select("host_key", "text_key").distinct().groupBy("host_key").agg(F.count("*").alias("texts"))
    holders = lines.groupBy("host_key", "line").agg(F.count("*").alias("holders"))
    frequent = holders.where(F.col("holders") > limits.min_texts).join(texts, "host_key").where(F.col("holders") > limits.min_share * F.col("texts"))
    cut = F.when(F.col("cut"), F.lit(0)).otherwise(F.col("words")) * F.col("times")
    left = lines.join(frequent.select("host_key", "line", F.lit(True).alias("cut")), ["host_key", "line"], "left")
    left = left.groupBy("host_key", "text_key").agg(F.sum(F.col("words") * F.col("times")).alias("before"), F.sum(cut).alias("after"))
    few = (F.col("after") < limits.left_words) | (F.col("after") < limits.left_share * F.col("before"))
    return left.where((F.col("after") < F.col("before")) & few).select("host_key", "text_key")


def judged(documents: DataFrame, carried: Column, text: str = "text", host: str = "source", limits: LineLimits = LineLimits()) -> DataFrame:
    """One row per document: `row` (the carried struct), the base figures, base_failed and kept.

    kept is false for base failures and for depleted texts. A null text has no words and fails; a
    null host is a host of its own; repeated rows get one verdict; without rows there is no result.
    """
    rows = documents.select(
        carried.alias("row"),
        F.xxhash64(F.col(host).isNull(), F.col(host)).alias("host_key"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_key"),
        F.col(text).alias("text"),
    )
    # Texts that fail the base rules are judged already, but their lines count like all others.
    depleted = depleted_texts(rows, limits).withColumn("depleted", F.lit(True))
    # A column that depends on the partition holds back filters on the verdict, which would otherwise
    # be moved below the figures and repeat their expressions.
    figures = with_base_figures(rows, "text").drop("text").withColumn("at", F.monotonically_increasing_id())
    found = figures.join(depleted, ["host_key", "text_key"], "left")
    kept = ~F.col("base_failed") & F.col("depleted").isNull() & (F.col("at") >= 0)
    return found.withColumn("kept", kept).drop("host_key", "text_key", "depleted", "at")
