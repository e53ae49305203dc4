"""Document quality by Bradley-Terry ranking.

Each text becomes a fixed list of measures (lengths, character shares,
repetition). Pairs of a preferred and a rejected document teach one weight per
measure: the logistic loss of the weighted difference of their measures. The
weighted sum is a document's strength. The cut lies at the quantile of the
strengths of all learning rows that the rejected ones make up, so as many rows
fall below it as were marked bad, and the score is the logistic function of the
distance from that cut, moved so that the cut has the score ``CUT_SCORE``.

The weights come from at most about ``FIT_ROWS`` rows of each label, chosen by a
hash of the id, every one paired with ``PARTNERS`` rows of the other label; their
measures (a few numbers a row) are fitted on the driver. The cut comes from all
learning rows: one pass gives their strengths, and counts in ever narrower ranges
find the exact quantile. Scoring is one more pass over the whole texts; neither
shuffles a text.

Rows: NULL and empty texts have the measures of a text without words and get a
score like any other; labels that are NULL or whose id is NULL teach nothing;
without both labels every strength is the same, and the score is 0.5. Repeated
rows get equal scores; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass, replace
from math import log, log1p
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import materialize
from .common import is_held_out

#: Learning rows of each label, about; the bound on what reaches the driver.
FIT_ROWS = 8_000
#: Partners of a learning row.
PARTNERS = 8
#: Weight of the squared weights in the loss.
RIDGE = 1e-3
#: Ranges that strengths are counted in at once, and strengths sorted on the driver.
RANGES = 4096
#: Score at the cut.
CUT_SCORE = 0.3

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGIT = bytes(range(48, 58))
_SPACE = b" \t\n\r\x0b\x0c"
_MARK = b"#*$%&|<>{}[]\\^~_=+@/"
_STOP = b".,;:!?"
_WIDE = bytes(range(128, 256))
MEASURES = (
    "log_words", "word_length", "long_words", "upper", "digits", "marks", "stops", "shouts", "spaces", "wide",
    "lines", "distinct_words", "top_word", "same_next", "repeated_lines", "packed", "upper_words", "mark_words",
    "short_text",
)


def measure(text: str | None) -> list[float]:
    """The measures of a text, in the order of ``MEASURES``."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    size, n = max(len(raw), 1), len(words)
    many = max(n, 1)

    def share(of: bytes) -> float:
        return (len(raw) - len(raw.translate(None, of))) / size

    lines = [line for line in raw.split(b"\n") if line.strip()]
    counts = Counter(words)
    return [
        log1p(n),
        min(sum(map(len, words)) / many, 40.0),
        sum(len(word) > 20 for word in words) / many,
        share(_UPPER),
        share(_DIGIT),
        share(_MARK),
        share(_STOP),
        raw.count(b"!") / size,
        share(_SPACE),
        share(_WIDE),
        len(lines) / many,
        len(counts) / many,
        max(counts.values(), default=0) / many,
        sum(map(eq, words, words[1:])) / many,
        1 - len(set(lines)) / max(len(lines), 1),
        min(len(zlib.compress(raw, 1)) / size, 2.0) if raw else 1.0,
        sum(map(bytes.isupper, words)) / many,
        sum(word[-1] in _MARK for word in words) / many,
        1.0 if n < 20 else 0.0,
    ]


@dataclass(frozen=True)
class Ranking:
    """A fitted ranking: plain arrays, so it goes to the tasks with the function."""

    center: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float

    def strengths(self, measures: np.ndarray) -> np.ndarray:
        return np.clip((measures - self.center) / self.scale, -8, 8) @ self.weights

    def scores(self, measures: np.ndarray) -> np.ndarray:
        moved = self.strengths(measures) - self.cut + (log(CUT_SCORE / (1 - CUT_SCORE)) if self.weights.any() else 0.0)
        return 1 / (1 + np.exp(-np.clip(moved, -500, 500)))


def fit_pairs(good: np.ndarray, bad: np.ndarray, seed: int = 0) -> Ranking:
    """Weights from all good rows against partners among the bad ones, and the
    other way round, by Newton steps on the ridged pairwise logistic loss."""
    width = len(MEASURES)
    if not len(good) or not len(bad):
        return Ranking(np.zeros(width), np.ones(width), np.zeros(width), 0.0)
    both = np.concatenate([good, bad])
    center, scale = both.mean(0), both.std(0) + 1e-9
    a, b = (np.clip((x - center) / scale, -8, 8) for x in (good, bad))
    pick = np.random.default_rng(seed)
    own = np.concatenate([np.repeat(np.arange(len(a)), PARTNERS), pick.integers(len(a), size=len(b) * PARTNERS)])
    other = np.concatenate([pick.integers(len(b), size=len(a) * PARTNERS), np.repeat(np.arange(len(b)), PARTNERS)])
    difference = a[own] - b[other]
    weights = np.zeros(width)

    def loss(w: np.ndarray) -> float:
        return np.logaddexp(0, -(difference @ w)).mean() + RIDGE * w @ w

    for _ in range(50):
        wrong = 1 / (1 + np.exp(np.clip(difference @ weights, -500, 500)))
        slope = 2 * RIDGE * weights - difference.T @ wrong / len(difference)
        bend = (difference.T * (wrong * (1 - wrong))) @ difference / len(difference) + 2 * RIDGE * np.eye(width)
        step, size = np.linalg.solve(bend, slope), 1.0
        while size > 1e-6 and loss(weights - size * step) > loss(weights):
            size /= 2
        weights = weights - size * step
        if np.abs(size * step).max() < 1e-7:
            break
    fitted = Ranking(center, scale, weights, 0.0)
    strengths = np.sort(fitted.strengths(both))
    return Ranking(center, scale, weights, float(strengths[len(bad) - 1:len(bad) + 1].mean()))


def fit(
    docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text",
    *, fit_rows: int = FIT_ROWS, seed: int = 0,
) -> Ranking:
    """Learn from the labelled documents that are not held out. Label 1 is preferred to label 0."""
    marked = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    marked = marked.filter(F.col("label").isin(0, 1) & F.col("id").isNotNull() & ~is_held_out("id"))
    held = marked.agg(*(F.count(F.when(F.col("label") == v, 1)).alias(f"n{v}") for v in (0, 1))).first()
    rank = F.pmod(F.xxhash64("id", F.lit(seed)), F.when(F.col("label") == 1, F.lit(max(held["n1"], 1))).otherwise(F.lit(max(held["n0"], 1))))
    # about fit_rows of each label, so small enough to broadcast
    chosen = F.broadcast(marked.filter(rank < fit_rows).select("id", "label").distinct())
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(chosen, "id")
    found = rows.select("id", "label", measures_udf()(F.col("text")).alias("measures")).toPandas()
    found = found.assign(order=[tuple(m) for m in found["measures"]]).sort_values(["label", "id", "order"])
    good, bad = (np.array(found.loc[found["label"] == v, "measures"].tolist(), float).reshape(-1, len(MEASURES)) for v in (1, 0))
    model = fit_pairs(good, bad, seed)
    if not model.weights.any():
        return model
    # the texts stay where they are: ids and strengths meet the labels
    strengths = docs.filter(~is_held_out(id_col)).select(F.col(id_col).alias("id"), strength(F.col(text_col), model).alias("value"))
    return replace(model, cut=cut(materialize(strengths.join(marked.distinct(), "id").select("label", "value"))))


def strength(text: Column, model: Ranking) -> Column:
    @F.pandas_udf("double")
    def strengths(texts: pd.Series) -> pd.Series:
        return pd.Series(model.strengths(np.array([measure(text) for text in texts]).reshape(-1, len(MEASURES))))

    return strengths(text)


def cut(learned: DataFrame) -> float:
    """Middle of the two strengths between which the share of rows with label 0 ends."""
    bad = learned.filter("label = 0").count()
    return (smallest(learned, bad) + smallest(learned, bad + 1)) / 2


def smallest(values: DataFrame, rank: int) -> float:
    """The ``rank``-th smallest ``value``, from 1."""
    least, most, n = values.agg(F.min("value"), F.max("value"), F.count("value")).first()
    while n > RANGES and least < most:
        place = F.least(F.floor((F.col("value") - least) / (most - least) * RANGES), F.lit(RANGES - 1))
        ranges = values.groupBy(place.alias("place")).agg(F.min("value"), F.max("value"), F.count("value"))
        for _, least, most, n in sorted(ranges.collect()):
            if rank <= n:
                break
            rank -= n
        values = values.filter(F.col("value").between(least, most))
    return least if least == most else sorted(row["value"] for row in values.select("value").collect())[rank - 1]


def measures_udf():
    @F.pandas_udf("array<double>")
    def measures(texts: pd.Series) -> pd.Series:
        return pd.Series([measure(text) for text in texts])

    return measures


def score(text: Column, model: Ranking) -> Column:
    """Score of a whole text, 0 to 1."""

    @F.pandas_udf("double")
    def scores(texts: pd.Series) -> pd.Series:
        measured = np.array([measure(text) for text in texts]).reshape(-1, len(MEASURES))
        return pd.Series(model.scores(measured))

    return scores(text)


def classify(docs: DataFrame, model: Ranking, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, held_out, score and predicted (1 from ``CUT_SCORE`` on) of every document."""
    scored = docs.select(
        F.col(id_col), is_held_out(id_col).alias("held_out"), score(F.col(text_col), model).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= CUT_SCORE).cast("int"))


def keep_good(docs: DataFrame, model: Ranking, text_col: str = "text") -> DataFrame:
    """The documents that reach the cut, all columns as they were."""
    return docs.filter(score(F.col(text_col), model) >= CUT_SCORE)
