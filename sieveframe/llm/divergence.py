"""Quality rules by distribution divergence.

Two histograms describe a text: its characters by class, and its words by the
``COMMON`` most widespread words of its language, all other words in one bin. The
reference of a language is the mean of the distributions of its documents that
have at least ``LEAST_WORDS`` words; a word is the more widespread, the more
documents of the language have it (ties: the smaller word). A document is rejected
if the Jensen-Shannon distance (root of the divergence in bits, 0 to 1) of its
characters to the reference exceeds ``CHAR_LIMIT``, or that of its words exceeds
``WORD_LIMIT``. Short texts stray by chance: the characters count from
``LEAST_CHARS`` characters in words on, the words from ``LEAST_COMPARED`` words on.

Before that, a base rule rejects texts of fewer than ``LEAST_WORDS`` words and
texts with more than 30 % of their words in repeated windows of 8 words.

Everything is a DataFrame expression. Words are counted over all documents, with
sums before the shuffle; the references are a row for each language. A text is
read twice and never moved.

Rows: NULL text has no words and fails the base rule. Documents without a language
form a group with a reference of their own. Repeated rows get equal verdicts and
each count once. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import materialize
from .common import SPACE, words

LEAST_WORDS = 20
WINDOW = 8
REPEATED_PERCENT = 30
COMMON = 50
LEAST_CHARS = 200
LEAST_COMPARED = 60
CHAR_LIMIT = 0.25
WORD_LIMIT = 0.42
SYMBOLS = "#*$%&|<>"
#: A letter of one byte for each place among the common words.
LETTERS = [chr(ord("!") + place) for place in range(COMMON)]
#: Common words are looked up by their hash modulo this.
BUCKETS = 1024
#: Classes of characters; what is in none of them is the last class.
CLASSES = (r"\p{Ll}", r"\p{Lu}", r"\p{Nd}", rf"[{SPACE}]", r"[.,;:!?]", rf"[{SYMBOLS}]")


def _distinct(items: Column) -> Column:
    return F.size(F.array_distinct(items))


def with_repeated_words(df: DataFrame) -> DataFrame:
    """``df`` with ``n_repeat_words``: words within windows that occur twice or more.
    ``windows`` has a 64-bit hash of each window by its start.

    The steps are columns of their own, so that none is computed anew for each element.
    """
    pairs = F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    df = df.withColumn("marked", F.when(_distinct(F.col("windows")) < F.size("windows"), F.sort_array(pairs)))

    def same(k: Column, step: int) -> Column:
        return F.coalesce(F.get("marked", k)["h"] == F.get("marked", k + step)["h"], F.lit(False))  # NULL beyond either end

    at = F.sequence(F.lit(0), F.size("marked") - 1)
    df = df.withColumn("again", F.when(F.col("marked").isNotNull(), F.filter(at, lambda k: same(k, -1) | same(k, 1))))
    df = df.withColumn("starts", F.sort_array(F.transform("again", lambda k: F.get("marked", k)["i"])))
    after = F.slice("starts", 2, F.greatest(F.size("starts"), F.lit(1)))
    widths = F.zip_with("starts", after, lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW)))
    total = F.aggregate(widths, F.lit(0), lambda total, width: total + width)
    return df.withColumn("n_repeat_words", F.coalesce(total, F.lit(0)).cast("long")).drop("marked", "again", "starts")


def _removed(text: str, pattern: str) -> Column:
    return F.regexp_replace(F.col(text), f"{pattern}+", "")


def features(docs: DataFrame) -> DataFrame:
    """From ``text``, ``lang``, ``common`` and its ``buckets`` to the base measures and both histograms."""
    read = docs.withColumn("text", F.coalesce("text", F.lit(""))).withColumn("w", words(F.col("text")))
    n = F.size("w")
    # each class is taken out of what the classes before it left
    left, sizes = "text", []
    for i, pattern in enumerate(CLASSES):
        read = read.withColumn(f"left{i}", _removed(left, pattern))
        sizes.append(F.length(left) - F.length(f"left{i}"))
        left = f"left{i}"
    classes = F.array(*sizes, F.length(left))
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(f"[^{SPACE}]"))
    read = read.withColumn("classes", classes).withColumn("lines", lines)
    read = read.withColumn("h1", F.transform("w", lambda word: F.xxhash64(word)))
    for half in (1, 2, 4):
        doubled = F.zip_with(f"h{half}", F.slice(f"h{half}", half + 1, F.greatest(n, F.lit(1))), lambda a, b: F.xxhash64(a, b))
        read = read.withColumn(f"h{2 * half}", doubled)
    read = read.withColumn("windows", F.slice("h8", 1, F.greatest(n - WINDOW + 1, F.lit(0))))
    # a text's common words as letters, so that a count is what they lose with a letter; read twice,
    # or Spark would move their making into the lambda
    letter = F.array(*map(F.lit, LETTERS))
    found = F.transform("h1", lambda h: F.get("buckets", F.pmod(h, F.lit(BUCKETS)).cast("int")))
    read = with_repeated_words(read).withColumn("found", found)
    one = F.zip_with("w", "found", lambda word, places: F.get(letter, F.get(F.filter(places, lambda p: F.get("common", p) == word), F.lit(0))))
    read = read.withColumn("letters", F.array_join(one, ""))
    known = F.length("letters")
    own = F.transform(F.slice(letter, F.lit(1), F.size("common")), lambda one: known - F.length(F.replace(F.col("letters"), one, F.lit(""))))
    counts = F.concat(own, F.array(n - known))
    return read.select(
        "id", "lang", n.cast("long").alias("n_words"), (F.length("text") - F.col("classes")[3]).cast("long").alias("word_chars"),
        F.col("classes")[5].cast("long").alias("n_symbols"), (F.size("lines") - _distinct(F.col("lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        _shares(F.col("classes"), F.length("text")).alias("chars"),
        _shares(counts, n).alias("words"),
    )


def _shares(counts: Column, total: Column) -> Column:
    return F.transform(counts, lambda count: F.when(total > 0, count / total).otherwise(0.0))


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two distributions over the same bins."""
    def part(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(0.0)

    terms = F.zip_with(p, q, lambda a, b: part(a, b) + part(b, a))
    return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda total, term: total + term) / 2, F.lit(0.0)))


def common_words(docs: DataFrame, count: int = COMMON) -> DataFrame:
    """(ref_lang, common): the most widespread words of each language, in that order."""
    split = docs.select("lang", words(F.col("text")).alias("w"))
    each = split.select("lang", F.explode(F.when(F.size("w") >= LEAST_WORDS, F.array_distinct("w"))).alias("word"))
    spread = each.groupBy("lang", "word").agg(F.count("*").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    top = spread.withColumn("place", place).filter(F.col("place") <= count)
    listed = top.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("place", "word"))).alias("top"))
    return listed.select(F.col("lang").alias("ref_lang"), F.col("top.word").alias("common"))


def buckets(common: Column) -> Column:
    """Of each remainder of a word's hash, the places in ``common`` of the words that have it."""
    at = F.sequence(F.lit(0), F.size(common) - 1)
    return F.transform(F.sequence(F.lit(0), F.lit(BUCKETS - 1)), lambda b: F.filter(at, lambda p: F.pmod(F.xxhash64(F.get(common, p)), F.lit(BUCKETS)) == b))


def apply_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """id, measures, base_failed, both distances and kept of every document."""
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    # stored, so that Spark knows how small they are
    common = materialize(common_words(own).withColumn("buckets", buckets(F.col("common"))))
    listed = own.join(common, F.col("lang").eqNullSafe(F.col("ref_lang")), "left").drop("ref_lang")
    for column, kind in (("common", "string"), ("buckets", "array<int>")):
        listed = listed.withColumn(column, F.coalesce(column, F.array().cast(f"array<{kind}>")))
    measured = materialize(features(listed))
    judged = measured.filter(F.col("n_words") >= LEAST_WORDS)
    bins = [F.avg(F.get("chars", F.lit(i))).alias(f"c{i}") for i in range(len(CLASSES) + 1)]
    bins += [F.avg(F.get("words", F.lit(i))).alias(f"w{i}") for i in range(COMMON + 1)]
    means = judged.groupBy("lang").agg(*bins)
    references = materialize(means.select(
        F.col("lang").alias("ref_lang"), F.array(*(f"c{i}" for i in range(len(CLASSES) + 1))).alias("ref_chars"),
        F.array_compact(F.array(*(f"w{i}" for i in range(COMMON + 1)))).alias("ref_words"),
    ))
    both = measured.join(references, F.col("lang").eqNullSafe(F.col("ref_lang")), "left").drop("ref_lang")
    both = both.withColumn("char_distance", distance(F.col("chars"), F.col("ref_chars")))
    both = both.withColumn("word_distance", distance(F.col("words"), F.col("ref_words")))
    base_failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))
    strays = (F.col("word_chars") >= LEAST_CHARS) & (F.col("char_distance") > CHAR_LIMIT)
    strays |= (F.col("n_words") >= LEAST_COMPARED) & (F.col("word_distance") > WORD_LIMIT)
    return both.select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"), (~base_failed & ~F.coalesce(strays, F.lit(False))).alias("kept"),
        "char_distance", "word_distance",
    )


def oracle_sql(table: str = "documents") -> str:
    """The same rules in DuckDB's SQL."""
    nested = [f"regexp_replace(text, '{CLASSES[0]}+', '', 'g')"]
    for pattern in CLASSES[1:]:
        nested.append(f"regexp_replace(l{len(nested) - 1}, '{pattern}+', '', 'g')")
    lefts = "".join(f", {expression} AS l{i}" for i, expression in enumerate(nested))
    sizes = ["length(text) - length(l0)"] + [f"length(l{i - 1}) - length(l{i})" for i in range(1, len(CLASSES))]
    counts = ", ".join([*sizes, f"length(l{len(CLASSES) - 1})"])

    def jsd(p: str, q: str) -> str:
        def part(a: str, b: str) -> str:
            return f"CASE WHEN {a} > 0 THEN {a} * log2(2 * {a} / ({a} + {b})) ELSE 0 END"

        one, two = f"{p}[i]", f"{q}[i]"
        terms = f"list_transform(range(1, len({p}) + 1), lambda i: {part(one, two)} + {part(two, one)})"
        return f"sqrt(greatest(coalesce(list_sum({terms}), 0) / 2, 0))"

    def mean(column: str) -> str:
        return f"""(SELECT lang, list(m ORDER BY i) AS ref FROM (
            SELECT lang, i, avg(v) AS m FROM (SELECT lang, unnest({column}) AS v, unnest(range(1, len({column}) + 1)) AS i FROM g WHERE n >= {LEAST_WORDS})
            GROUP BY lang, i) GROUP BY lang)"""

    return f"""
WITH d AS (
    SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS text,
        list_filter(regexp_split_to_array(coalesce(text, ''), '[{SPACE}]+'), lambda x: x <> '') AS w
    FROM {table}
), common AS (
    SELECT lang, list(word ORDER BY place) AS common FROM (
        SELECT lang, word, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, word) AS place
        FROM (SELECT lang, unnest(list_distinct(w)) AS word FROM d WHERE len(w) >= {LEAST_WORDS}) GROUP BY lang, word
    ) WHERE place <= {COMMON} GROUP BY lang
), hits AS (
    SELECT rid, map(list(place), list(k)) AS m FROM (
        SELECT t.rid, place, count(*) AS k
        FROM (SELECT rid, lang, unnest(w) AS word FROM d) t
        JOIN (SELECT lang, unnest(common) AS word, unnest(range(1, len(common) + 1)) AS place FROM common) u
        ON t.lang IS NOT DISTINCT FROM u.lang AND t.word = u.word
        GROUP BY t.rid, place
    ) GROUP BY rid
), placed AS (
    SELECT rid, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d
), windows AS (
    SELECT rid, i, word AS w0, {", ".join(f"lead(word, {k}) OVER (PARTITION BY rid ORDER BY i) AS w{k}" for k in range(1, WINDOW))} FROM placed
), starts AS (
    SELECT rid, i FROM (
        SELECT rid, i, count(*) OVER (PARTITION BY rid, concat_ws(' ', {", ".join(f"w{k}" for k in range(WINDOW))})) AS c
        FROM windows WHERE w{WINDOW - 1} IS NOT NULL
    ) WHERE c > 1
), repeated AS (
    SELECT rid, sum(least({WINDOW}, coalesce(after - i, {WINDOW}))) AS n_repeat FROM (
        SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS after FROM starts
    ) GROUP BY rid
), c AS (
    SELECT *{lefts} FROM d
), f AS (
    SELECT c.rid, c.doc_id, c.lang, len(w) AS n, [{counts}] AS k, length(text) AS total,
        coalesce(n_repeat, 0) AS n_repeat,
        len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^{SPACE}]')))
        - len(list_distinct(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^{SPACE}]')))) AS dup,
        list_transform(range(1, len(coalesce(common, [])) + 1), lambda x: coalesce(m[x], 0)) AS own
    FROM c LEFT JOIN common ON c.lang IS NOT DISTINCT FROM common.lang LEFT JOIN repeated ON c.rid = repeated.rid
    LEFT JOIN hits ON c.rid = hits.rid
), g AS (
    SELECT *, list_transform(k, lambda x: CASE WHEN total > 0 THEN x / total ELSE 0 END) AS chars,
        list_transform(list_append(own, n - coalesce(list_sum(own), 0)), lambda x: CASE WHEN n > 0 THEN x / n ELSE 0 END) AS words
    FROM f
), j AS (
    SELECT g.*, {jsd("chars", "a.ref")} AS char_distance, {jsd("words", "b.ref")} AS word_distance
    FROM g LEFT JOIN {mean("chars")} a ON g.lang IS NOT DISTINCT FROM a.lang
    LEFT JOIN {mean("words")} b ON g.lang IS NOT DISTINCT FROM b.lang
), r AS (
    SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(total - k[4] AS BIGINT) AS word_chars, CAST(k[6] AS BIGINT) AS n_symbols,
        CAST(dup AS BIGINT) AS n_dup_lines, CAST(n_repeat AS BIGINT) AS n_repeat_words,
        n < {LEAST_WORDS} OR 100 * n_repeat > {REPEATED_PERCENT} * n AS base_failed,
        coalesce(total - k[4] >= {LEAST_CHARS} AND char_distance > {CHAR_LIMIT}, false)
        OR coalesce(n >= {LEAST_COMPARED} AND word_distance > {WORD_LIMIT}, false) AS strays
    FROM j
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT strays AS kept FROM r
"""
