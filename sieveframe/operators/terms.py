"""Document access by id, combined search fields and term counts."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .filters import filter_in

#: Runs of letters of any alphabet.
WORD = r"\p{L}+"


def get_by_ids(df: DataFrame, key: str, ids: Iterable | DataFrame) -> DataFrame:
    """Rows with the given keys. A short list is a scan predicate, a long one a
    semi join."""
    return filter_in(df, key, ids)


def copy_field(df: DataFrame, sources: Sequence[str], dest: str, separator: str = " ") -> DataFrame:
    """One field that holds the values of several; missing ones are skipped."""
    return df.withColumn(dest, F.concat_ws(separator, *[_text(df, s) for s in sources]))


def _text(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType.simpleString()
    return F.col(name).cast("array<string>" if kind.startswith("array") else "string")


def terms_doc_freq(
    df: DataFrame, key: str, column: str, token_pattern: str = WORD, unique_key: bool = False
) -> DataFrame:
    """``term, doc_freq``: distinct lower-case terms and how many documents hold
    them.

    Repeats inside a document go before anything is shuffled. When every key
    has one row (``unique_key=True``) a plain count with map-side combining
    follows, so a term found everywhere costs one row per task.
    """
    tokens = F.regexp_extract_all(F.lower(F.col(column)), F.lit(f"({token_pattern})"), F.lit(1))
    terms = df.select(F.col(key).alias("__key"), F.explode(F.array_distinct(tokens)).alias("term"))
    if not unique_key:
        # keyed by term and document, so a frequent term still spreads
        terms = terms.filter(F.col("__key").isNotNull()).dropDuplicates(["term", "__key"])
    return terms.groupBy("term").agg(F.count("*").alias("doc_freq"))
