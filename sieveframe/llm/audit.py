"""Source divergence audit by dominance skybands.

Terms are counted by language and source, and the terms in at least ``least_docs``
documents of a language are kept. A group (a source's part of a language, or a language)
gives each kept term a smoothed share in whole billionths.

Each source's ``ranks`` most overused terms are those whose share lies most above the
language's. A term that another one equals or beats in three ways, a higher count in the
group, a lower one in the language, an earlier place in UTF-8 order, never ranks before
it. So partitions retain the terms that fewer than ``ranks`` others dominate (whatever
the totals are, which need not be known), retained terms are merged and thinned once
more, and only what remains is ranked by exact values.

Distances between the sources of a language are sums over all kept terms. Terms are
taken in cells of about ``CELL_TERMS``, sources in parts of ``CELL_SOURCES``; a cell
gives one number for two sources. A term that both lack adds the same to every cell, so
it is reckoned without being looked at.

Texts are read once, in tasks that count words and pass the counts on whenever they hold
``HELD`` different ones. Nothing is collected or broadcast. All arithmetic is in whole
numbers, decimals where a product might pass 64 bits.

Rows: NULL text, language and source count as ''; every group that occurs is there, also
without terms; repeated rows count as often as they occur; other columns are not read; an
empty table gives no rows. Equal values are ranked by the item's bytes.
"""

from __future__ import annotations

import itertools
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import materialize

LEAST_DOCS = 30
RANKS = 50
UNIT = 1_000_000_000
PRIOR = 5
#: Different words whose counts a task holds before it passes them on.
HELD = 200_000
#: Terms and sources that are compared at once.
CELL_TERMS, CELL_SOURCES = 4096, 256
#: Buckets of a group in which skybands are merged.
MERGED = 16
#: Bytes of a text that are split at once.
BLOCK = 1 << 20

# Letters of ASCII, folded, and all bytes of other characters; the rest parts terms.
_FOLD = bytes(c if c >= 128 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def count_terms(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """lang, source, term, n occurrences, in ``docs`` documents; a NULL term for each group."""
    chosen = docs.select(
        *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) for c, name in ((lang_col, "lang"), (source_col, "source"))),
        F.col(text_col).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple, tuple[Counter, Counter]] = {}
        for batch in batches:
            for lang, source, text in zip(*(batch.column(i).to_pylist() for i in range(2)), batch.column(2), strict=True):
                occurring, within = counts.setdefault((lang, source), (Counter(), Counter()))
                own: set[bytes] = set()
                for found in _blocks(text.as_py()):
                    occurring.update(found)
                    own.update(found)
                within.update(own)
                if sum(len(held[0]) for held in counts.values()) > HELD:
                    yield from sent(counts)
                    counts = {}
        yield from sent(counts)

    def sent(counts: dict[tuple, tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
        for (lang, source), (occurring, within) in counts.items():
            terms = list(occurring)
            size = len(terms) + 1
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * size, pa.string()), pa.array([source] * size, pa.string()), pa.array([None, *terms], pa.binary()),
                pa.array([0, *occurring.values()], pa.int64()), pa.array([0, *map(within.__getitem__, terms)], pa.int64()),
            ], ["lang", "source", "term", "n", "docs"])

    partial = chosen.mapInArrow(run, "lang string, source string, term binary, n long, docs long")
    return partial.groupBy("lang", "source", F.col("term").cast("string").alias("term")).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _blocks(text: bytes | None) -> Iterator[list[bytes]]:
    spaced, at = (text or b"").translate(_FOLD), 0
    while at < len(spaced):
        end = spaced.find(b" ", at + BLOCK)
        end = len(spaced) if end < 0 else end
        yield spaced[at:end].split()
        at = end


def share(count: str | Column, total: str | Column, kept: str | Column) -> Column:
    """Smoothed share of a count, in whole billionths from 1 on."""
    count, total, kept = ((F.col(c) if isinstance(c, str) else c).cast("decimal(38,0)") for c in (count, total, kept))
    top, bottom = ((count + PRIOR) * UNIT).cast("decimal(38,0)"), (total + PRIOR * kept).cast("decimal(38,0)")
    # without terms there is nothing to share
    return F.coalesce(F.call_function("div", top, F.nullif(bottom, F.lit(0).cast("decimal(38,0)"))).cast("long"), F.lit(0)) + 1


def skyband(rows: DataFrame, ranks: int = RANKS) -> DataFrame:
    """Of each partition's rows (lang, source, term, n, total) those that fewer than
    ``ranks`` others of their partition and group dominate. No row changes partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, kept = None, None
        for batch in batches:
            frame = batch.to_pandas()
            changed = (frame["lang"] != frame["lang"].shift()) | (frame["source"] != frame["source"].shift())
            starts = [*np.flatnonzero(changed), len(frame)]
            keep = np.zeros(len(frame), bool)
            for a, b in itertools.pairwise(starts):
                name = (frame["lang"].iat[a], frame["source"].iat[a])
                if name != group:
                    group, kept = name, (np.zeros(0, np.int64), np.zeros(0, object))
                terms = frame["term"].iloc[a:b].map(str.encode).to_numpy(object)
                keep[a:b], kept = retained(frame["total"].to_numpy()[a:b], terms, *kept, ranks)
            yield batch.filter(pa.array(keep))

    ordered = rows.select("lang", "source", "term", "n", "total").sortWithinPartitions("lang", "source", F.desc("n"), "total", "term")
    return ordered.mapInArrow(run, ordered.schema)


def retained(totals: np.ndarray, terms: np.ndarray, seen_totals: np.ndarray, seen_terms: np.ndarray, ranks: int):
    """Which rows stay, given those seen that stay, and both together. Rows come by count
    (high first), total and term, so only earlier ones dominate. A dominator that went has
    ``ranks`` dominators that stay, so those that stay decide."""
    held = len(seen_totals)
    _, order = np.unique(np.concatenate([seen_terms, terms]), return_inverse=True)
    size = held + len(terms)
    place, total = np.empty(size, np.int64), np.empty(size, np.int64)
    place[:held], total[:held] = order[:held], seen_totals
    keep = np.zeros(len(terms), bool)
    for i, (own, at) in enumerate(zip(totals, order[held:], strict=True)):
        if held < ranks or np.count_nonzero((total[:held] <= own) & (place[:held] <= at)) < ranks:
            keep[i], place[held], total[held] = True, at, own
            held += 1
    return keep, (np.concatenate([seen_totals, totals[keep]]), np.concatenate([seen_terms, terms[keep]]))


def overused(counts: DataFrame, groups: DataFrame, ranks: int = RANKS) -> DataFrame:
    """lang, source, item, value, rank of each group's most overused terms."""
    local = skyband(counts, ranks)
    merged = skyband(local.repartition("lang", "source", F.pmod(F.xxhash64("term"), F.lit(MERGED))), ranks)
    valued = merged.join(groups, ["lang", "source"]).withColumn("value", share("n", "own", "kept") - share("total", "all", "kept"))
    return _ranked(valued.filter("value > 0").withColumnRenamed("term", "item")).filter(F.col("rank") <= ranks)


def distances(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item, value, rank for each two sources of a language."""
    zero = share(F.lit(0), "own", "kept").alias("zero")
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    parts = F.ceil(F.col("sources") / CELL_SOURCES).cast("int")
    groups = groups.join(groups.groupBy("lang").agg(F.count("*").alias("sources")), "lang").select(
        "lang", "source", "kept", zero, F.floor(place / CELL_SOURCES).cast("int").alias("part"), parts.alias("parts"),
        F.greatest(F.ceil(F.col("kept") / CELL_TERMS), F.lit(1)).cast("int").alias("cells"), "own")
    groups = materialize(groups)
    mine = F.col("part")
    squares = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda o: F.struct(F.least(o, mine).alias("one"), F.greatest(o, mine).alias("other"))).cast("array<struct<one:int,other:int>>")
    keyed = counts.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", share("n", "own", "kept").alias("p"), F.pmod(F.xxhash64("term"), F.col("cells")).cast("int").alias("cell"),
        F.explode(squares).alias("s")).select("lang", "cell", "s.one", "s.other", "source", "term", "p")
    present = groups.filter("kept > 0").select(
        "lang", "source", "zero", "part", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)).alias("cell"), F.explode(squares).alias("s"),
    ).select("lang", "cell", "s.one", "s.other", "source", "part", "zero")
    square = ["lang", "cell", "one", "other"]

    def compared(shares: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        known = known.sort_values("source", ignore_index=True)
        rows = pd.Index(known["source"]).get_indexer(shares["source"])
        columns, terms = pd.factorize(shares["term"])
        table = np.repeat(known["zero"].to_numpy()[:, None], len(terms), axis=1)
        table[rows, columns] = shares["p"].to_numpy()
        zero, part = known["zero"].to_numpy(), known["part"].to_numpy()
        one, other = (known["part"].to_numpy() == p for p in (part.min(), part.max()))
        out = []
        for i in np.flatnonzero(one):
            to = np.flatnonzero(other & ((np.arange(len(part)) > i) | (part != part[i])))
            # less what a term that both lack adds
            sums = np.abs(table[to] - table[i]).sum(1) - len(terms) * np.abs(zero[to] - zero[i])
            out.append(pd.DataFrame({"source": known["source"].iat[i], "item": known["source"].to_numpy()[to], "part_value": sums}))
        return pd.concat(out).assign(lang=known["lang"].iat[0])[["lang", "source", "item", "part_value"]]

    sums = keyed.groupBy(*square).cogroup(present.groupBy(*square)).applyInPandas(
        compared, "lang string, source string, item string, part_value long")
    sums = sums.groupBy("lang", "source", "item").agg(F.sum("part_value").alias("looked_at"))
    a, b = groups.select("lang", "source", "zero", "kept"), groups.select("lang", F.col("source").alias("item"), F.col("zero").alias("item_zero"))
    # the result has a row for each two sources, so this join makes no more than is asked
    pairs = a.join(b, "lang").filter("source < item").join(sums, ["lang", "source", "item"], "left")
    value = F.coalesce("looked_at", F.lit(0)) + F.col("kept") * F.abs(F.col("zero") - F.col("item_zero"))
    pairs = materialize(pairs.select("lang", "source", "item", value.alias("value")))
    return _ranked(pairs.union(pairs.select("lang", F.col("item"), F.col("source"), "value")))


def _ranked(valued: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return valued.select("lang", "source", "item", F.col("value").cast("long").alias("value"), F.row_number().over(order).alias("rank"))


def audit(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", *,
    least_docs: int = LEAST_DOCS, ranks: int = RANKS,
) -> DataFrame:
    """lang, source, part (``pair``: distance to another source; ``term``: an overused
    term), item, value and rank."""
    found = materialize(count_terms(docs, text_col, lang_col, source_col))
    kept = found.filter("term is not null").groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs"))
    kept = kept.filter(F.col("docs") >= least_docs).drop("docs")
    counts = materialize(found.select("lang", "source", "term", "n").join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "total"))
    own = counts.groupBy("lang", "source").agg(F.sum("n").alias("own"))
    language = counts.groupBy("lang", "term").agg(F.sum("n").alias("n")).groupBy("lang").agg(F.sum("n").alias("all"), F.count("*").alias("kept"))
    groups = found.filter("term is null").select("lang", "source").join(own, ["lang", "source"], "left").join(language, "lang", "left")
    groups = materialize(groups.na.fill(0, ["own", "all", "kept"]))
    pairs = distances(counts, groups).select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank")
    terms = overused(counts, groups, ranks).select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")
    return pairs.union(terms)


def oracle_sql(least_docs: int = LEAST_DOCS, ranks: int = RANKS) -> str:
    """The same in DuckDB SQL, by ranking every term."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return (
        "with d as (select row_number() over () as doc, coalesce(text, '') as text, coalesce(lang, '') as lang, coalesce(source, '') as source from documents),"
        f" w as (select doc, lang, source, unnest(regexp_extract_all(translate(text, '{upper}', '{lower}'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term from d),"
        " c as (select doc, lang, source, term, count(*) as n from w group by all),"
        f" k as (select lang, term, sum(n) as n from c group by all having count(*) >= {least_docs}),"
        " l as (select lang, sum(n) as total, count(*) as v from k group by lang),"
        " g as (select distinct lang, source from d),"
        " gc as (select c.lang, source, term, sum(c.n) as n from c join k using (lang, term) group by all),"
        " gt as (select lang, source, coalesce(sum(n), 0) as total from g left join gc using (lang, source) group by all),"
        " full_counts as (select g.lang, g.source, k.term, coalesce(gc.n, 0) as n from g join k using (lang) left join gc using (lang, source, term)),"
        f" p as (select f.lang, f.source, f.term, f.n, 1 + ((f.n + {PRIOR})::hugeint * {UNIT}) // (gt.total + {PRIOR} * l.v) as p"
        " from full_counts f join gt using (lang, source) join l on l.lang = f.lang),"
        f" q as (select k.lang, k.term, 1 + ((k.n + {PRIOR})::hugeint * {UNIT}) // (l.total + {PRIOR} * l.v) as q from k join l using (lang)),"
        " sums as (select x.lang, x.source, y.source as item, sum(abs(x.p - y.p)) as value from p x join p y on x.lang = y.lang and x.term = y.term and x.source <> y.source group by all),"
        " pairs as (select a.lang, a.source, 'pair' as part, b.source as item, coalesce(s.value, 0) as value from g a join g b on a.lang = b.lang and a.source <> b.source"
        " left join sums s on s.lang = a.lang and s.source = a.source and s.item = b.source),"
        " terms as (select lang, source, 'term' as part, term as item, p - q as value from p join q using (lang, term) where n > 0 and p > q),"
        " every as (select * from pairs union all select * from terms),"
        " r as (select *, row_number() over (partition by lang, source, part order by value desc, item) as rank from every)"
        f" select lang, source, part, item, cast(value as bigint) as value, cast(rank as int) as rank from r where part = 'pair' or rank <= {ranks}"
    )
