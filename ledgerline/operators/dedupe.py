"""Keep the first row of every key, and list the rows that were not kept.

Neither function ranks a whole key in one task. ``first_per_key`` is a minimum, which Spark
combines on the map side, so a hot key sends one row per map task. ``rows_after_first`` never
numbers the copies: equal rows cannot be told apart, so counting them says it all. It finds the repeated
keys from the key column, marks them in a Bloom filter of fixed size, and shuffles only rows that pass it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.bloom import bloom_words, may_be_among

# Copies written out per portion; longer runs are spread over the cluster.
COPIES_PER_TASK = 100_000


def _sort_key(columns: Sequence[str]) -> str:
    """Struct that orders like ``columns`` ascending with NULLS LAST."""
    fields = [f"{name} IS NULL AS no_{name}, {name}" for name in columns]
    return f"struct({', '.join(fields)})"


def first_per_key(df: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """First row of each key by ``order_by``; a NULL key counts as one key.

    Ties are broken by all other columns, so that reruns keep the same row. A reader that
    needs the key only gets a plain distinct: Spark drops the unused minimum.
    """
    rest = [c for c in df.columns if c != key and c not in order_by]
    kept = df.groupBy(key).agg(F.expr(f"min({_sort_key([*order_by, *rest])}) AS kept"))
    return kept.selectExpr(*[c if c == key else f"kept.{c} AS {c}" for c in df.columns])


def rows_of_repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """All rows of keys with several rows, and some others. The NULL key is a key.

    Reads the key column alone to find the repeated keys; ``df`` itself is not shuffled.
    """
    repeated = df.groupBy(key).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    return may_be_among(df, key, bloom_words(repeated, key))


def rows_after_first(df: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """All rows that ``first_per_key`` did not keep, every copy included.

    Only rows that pass the filter of repeated keys are shuffled. Those are spread by their whole content, so neither a
    hot key nor a pile of equal rows lands in one task. A row whose key comes once is kept, whether it passes or not.
    """
    columns = df.columns
    repeated = rows_of_repeated_keys(df, key)
    contents = repeated.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies"))
    # Choosing among the counted contents reads the same shuffle as counting them.
    kept = first_per_key(contents, key, order_by)
    kept = kept.select([F.col(c).alias(f"kept_{c}") for c in contents.columns])
    same = reduce(
        lambda a, b: a & b,
        [F.col(c).eqNullSafe(F.col(f"kept_{c}")) for c in contents.columns],
    )
    surplus = F.col("copies") - F.when(F.col("kept_copies").isNull(), 0).otherwise(1)
    left_over = (
        contents.join(kept, same, "left")
        .select(*columns, surplus.alias("surplus"))
        .where("surplus > 0")
    )
    return _repeat(left_over, "surplus").select(*columns)


def _repeat(df: DataFrame, times: str) -> DataFrame:
    """Every row ``times`` times; long runs are cut into portions and spread over tasks."""
    # A fixed number of partitions is not merged by adaptive execution, which sees small rows and
    # cannot know how long their runs are.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    end = F.col(times)
    portions = df.withColumn(
        "portion", F.explode(F.sequence(F.lit(0), end - 1, F.lit(COPIES_PER_TASK)))
    ).repartition(tasks, *df.columns, "portion")
    size = F.least(end - F.col("portion"), F.lit(COPIES_PER_TASK)).cast("int")
    return portions.withColumn("copy", F.explode(F.array_repeat(F.lit(True), size)))
