"""What the operators of this package share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Java and Python regex class body of the white space that parts words.
SPACE = r"\x20\x09-\x0D"
#: Rows are taken for learning unless this remainder of crc32(id) mod FOLDS is met.
FOLDS, HELD_OUT = 5, 0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(id_col: str | Column) -> Column:
    """crc32 of the id as text, mod FOLDS; NULL for a NULL id."""
    column = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(column.cast("string")) % FOLDS


def is_held_out(id_col: str | Column) -> Column:
    """Whether the row is kept from learning. A NULL id is neither learned from nor held out."""
    return F.coalesce(fold(id_col) == HELD_OUT, F.lit(False))


def words(text: Column) -> Column:
    """Maximal runs of characters other than ASCII white space; none for NULL."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+"), "")
