"""Joins that stay balanced when a few keys hold a large share of the rows.

The right side of these joins has one row per key. Small right sides need no
care: Spark broadcasts them. For the others the rows of hot keys, and rows
without a key, are dealt out over many tasks, and the right side's rows of
exactly those keys are copied to them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Counters of the heavy-hitter sketch. It bounds what reaches the driver.
SKETCH_SIZE = 10_000
LARGEST_SKETCH = 1_000_000
#: Share of the rows from which on a key counts as hot when none is given; with more
#: than its inverse of shuffle partitions, one partition's share.
HOT_SHARE = 0.001
#: Least number of tasks a hot key is dealt out to.
LEAST_WAYS = 64
#: Key types the sketch can count.
COUNTABLE = (
    T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType,
    T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType,
)
AUTO = "auto"


def find_hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE) -> list:
    """Keys that hold about ``share`` of the rows or more.

    One pass over the key column into a fixed-size sketch per task: no shuffle
    of the rows, and at most ``1 / share`` keys come back. The list only steers
    how rows are spread; a key that is missed or reported in error costs time,
    never rows.
    """
    return _hot(df, key, share)[0]


def _hot(df: DataFrame, key: str, share: float) -> tuple[list, float]:
    """Hot keys, and the share of rows without a key."""
    if not 2 / LARGEST_SKETCH < share <= 1:
        raise ValueError(f"share must lie in ({2 / LARGEST_SKETCH}, 1]")
    counters = max(SKETCH_SIZE, int(2 / share) + 1)
    top = F.call_function("approx_top_k", F.col(key), F.lit(int(1 / share) + 1), F.lit(counters))
    row = df.agg(
        top.alias("top"), F.count(F.col(key)).alias("keyed"), F.count("*").alias("n")
    ).first()
    hot = [i["item"] for i in row["top"] or () if i["item"] is not None and i["count"] >= share * row["n"]]
    return hot, 1 - row["keyed"] / row["n"] if row["n"] else 0.0


def keyed_join(
    main: DataFrame, key: str, found: DataFrame, found_key: str, how: str,
    hot_keys: list | str | None, spread_by: list[str] | None = None, may_broadcast: bool = True,
) -> DataFrame:
    """Join ``main`` with ``found``, which has at most one row per key.

    ``hot_keys`` is a list of keys to spread, ``None`` for a plain join, or
    ``"auto"``: ``main``'s key column is read once to find the hot keys. Nothing is
    spread when ``found`` fits a broadcast, unless ``may_broadcast`` says it shall
    not be. Rows of a hot key part by the columns ``spread_by``; without it, by the
    whole row. ``found_key`` is in the result of a left join; the caller drops it.
    """
    if hot_keys is not None and may_broadcast and fits_broadcast(found):
        hot_keys = None
    if hot_keys == AUTO:
        hot_keys = _choose(main, key)
    if hot_keys is None:
        return main.join(found if may_broadcast else found.hint("merge"), main[key] == found[found_key], how)
    tasks = int(main.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ways = max(LEAST_WAYS, tasks)
    salted = main.withColumn("__salt", _spread(main, key, hot_keys, ways, spread_by))
    copied = found.withColumn("__found_salt", F.explode(_copies(F.col(found_key), hot_keys, ways)))
    same = (salted[key] == copied[found_key]) & (salted["__salt"] == copied["__found_salt"])
    # Spark's estimate does not see the copies, so it must not choose a broadcast by it
    return salted.join(copied.hint("merge"), same, how).drop("__salt", "__found_salt")


def _choose(main: DataFrame, key: str) -> list | None:
    if main.isStreaming:
        return None
    if not isinstance(main.schema[key].dataType, COUNTABLE):
        return []
    share = hot_share(main.sparkSession)
    hot, missing = _hot(main, key, share)
    return hot if hot or missing >= share else None


def hot_share(spark: SparkSession) -> float:
    """Share of the rows that is too much for one task."""
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(min(HOT_SHARE, 1 / tasks), 4 / LARGEST_SKETCH)


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Spark's size estimate lets it broadcast ``df``."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    # an unknown size is given as a huge number, which may arrive as a negative one
    return 0 <= size <= limit


def _spread(df: DataFrame, key: str, hot_keys: list, ways: int, spread_by: list[str] | None) -> Column:
    """Salt of a row: hot keys and missing keys go ``ways`` ways, others one.

    It depends on the row's content only, so a retried task deals its rows out
    the same way and filters above it still move below it. Without ``spread_by`` it
    reads the whole row: no choice of columns is sure to differ within a key.
    """
    columns = spread_by or [f.name for f in df.schema if "map<" not in f.dataType.simpleString()]
    value = F.col(key)
    hot = value.isNull() if not hot_keys else value.isNull() | value.isin(*hot_keys)
    dealt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in columns or [key]]), F.lit(ways))
    return F.when(hot, dealt.cast("int")).otherwise(F.lit(0))


def _copies(key: Column, hot_keys: list, ways: int) -> Column:
    """Salts the other side of the join needs for ``key``, as an array."""
    one = F.array(F.lit(0))
    if not hot_keys:
        return one
    return F.when(key.isin(*hot_keys), F.sequence(F.lit(0), F.lit(ways - 1))).otherwise(one)

