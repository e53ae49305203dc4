"""Language of a text by cross-parsing.

For every language a suffix automaton holds a bounded sample of its labelled
text. A text is parsed against each: the longest prefix that occurs in the sample
is a phrase, and the next phrase starts behind it. The fewer phrases, the closer
the language; since a larger sample has longer matches, a phrase costs the
logarithm of the sample's length, and the cost is divided by the text's length.
The language with the lowest cost wins; ties go to the one with more labelled
rows, then to the smaller name.

Text is parsed as lower-case letters; what lies between letters is one mark. A
letter is one mark; if the samples have more than ``SINGLE`` different letters, it
is as many as its UTF-8 form has bytes, so that no letter shares its marks with
another. Letters that no sample has are a mark that no sample has. Text
is parsed in blocks of ``BLOCK`` marks so that many blocks step through the
automata together, one table lookup per mark and language; a block starts a new
phrase. Whole texts are read.

Learning takes windows of ``WINDOW`` characters from about ``FIT_ROWS`` rows of
each language, chosen by a hash of the id, up to ``FIT_MARKS`` marks of each
language and ``FIT_TOTAL`` in all. These samples make the model; its size is
bounded by them. Prediction is one pass without a shuffle.

Rows: NULL text, or text without a letter, is ``und`` with score 0, as is every
text when nothing could be learned. Rows whose id, text or language is NULL teach
nothing but are predicted. Repeated rows get equal answers; an empty table gives
no rows.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import materialize
from .common import is_held_out

UNKNOWN = "und"
FIT_ROWS = 96
WINDOW = 512
FIT_MARKS = 30_000
FIT_TOTAL = 1_200_000
BLOCK = 1024
#: Different letters up to which each is one mark.
SINGLE = 250
#: Mark of a letter that no sample has, where letters are their UTF-8 bytes.
OTHER = 1
#: Phrases a mark beyond which a text is in none of the learned languages. Text of a
#: learned language takes 0.15 to 0.35, also of a small sample; a letter that no sample
#: has is a phrase of its own. Texts of fewer than ``LEAST_MARKS`` marks tell too little.
MOST_PHRASES = 0.47
LEAST_MARKS = 16
#: Blocks parsed together.
TOGETHER = 2048


@dataclass(frozen=True)
class Model:
    """Languages, the letters seen, and the samples as marks (0: between letters)."""

    languages: tuple[str, ...]
    letters: str
    samples: tuple[bytes, ...]


def marks_of(text: str, classes: np.ndarray) -> np.ndarray:
    """The text as marks: letters by class, one 0 for each gap between letters."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    marks = classes[points]
    keep = marks > 0
    keep[1:] |= marks[:-1] > 0
    marks = marks[keep]
    if marks.dtype == np.uint8:
        return marks
    return np.frombuffer(marks.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass"), np.uint8)


def letter_classes(letters: str) -> np.ndarray:
    """Class of every code point: 0 no letter, then the letters, then one for all other
    letters. Beyond ``SINGLE`` letters, each is its code point, and all others ``OTHER``."""
    is_letter = np.fromiter((chr(i).isalpha() for i in range(sys.maxunicode + 1)), bool)
    if len(letters) > SINGLE:
        classes = is_letter.astype(np.uint32) * OTHER
        points = [ord(letter) for letter in letters]
        classes[points] = points
        return classes
    classes = is_letter.astype(np.uint8)
    classes[classes > 0] = len(letters) + 1
    classes[[ord(letter) for letter in letters]] = np.arange(1, len(letters) + 1)
    return classes


def suffix_automaton(sample: bytes, width: int) -> np.ndarray:
    """Transitions of the suffix automaton, [state, mark], -1 where there is none."""
    following: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for mark in sample:
        new = len(following)
        following.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and mark not in following[at]:
            following[at][mark] = new
            at = link[at]
        if at >= 0:
            onto = following[at][mark]
            if length[onto] == length[at] + 1:
                link[new] = onto
            else:
                copy = len(following)
                following.append(dict(following[onto]))
                length.append(length[at] + 1)
                link.append(link[onto])
                while at >= 0 and following[at].get(mark) == onto:
                    following[at][mark] = copy
                    at = link[at]
                link[onto] = link[new] = copy
        last = new
    table = np.full((len(following), width), -1, np.int32)
    for state, own in enumerate(following):
        table[state, list(own)] = list(own.values())
    return table


class CrossParser:
    """The automata of a model in one table, and parsing of many texts at once."""

    def __init__(self, model: Model):
        self.languages = model.languages
        self.classes = letter_classes(model.letters)
        width = len(model.letters) + 2 if len(model.letters) <= SINGLE else 256
        tables, self.roots, first = [], [], 0
        for sample in model.samples:
            table = suffix_automaton(sample, width)
            # A mark the sample lacks is a phrase of its own: a last state without a way on.
            table = np.concatenate([table, np.full((1, width), -1, np.int32)])
            table[0, table[0] < 0] = len(table) - 1
            # A state is its place in the flat table. Where no transition is, the
            # phrase ends: the entry is the complement of where the next one stands.
            start = table[0]
            flat = np.where(table >= 0, (table + first) * width, ~((start + first) * width))
            tables.append(flat.astype(np.int32))
            self.roots.append(first * width)
            first += len(table)
        self.table = np.concatenate(tables).ravel() if tables else np.zeros(0, np.int32)
        self.price = np.log2([max(len(sample), 2) for sample in model.samples])

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrases of each text against each language."""
        counts = np.zeros((len(texts), len(self.languages)), np.int64)
        blocks = [(text, at) for text, marks in enumerate(texts) for at in range(0, len(marks), BLOCK)]
        blocks.sort(key=lambda block: -min(BLOCK, len(texts[block[0]]) - block[1]))
        for at in range(0, len(blocks), TOGETHER):
            some = blocks[at:at + TOGETHER]
            parts = [texts[text][start:start + BLOCK] for text, start in some]
            np.add.at(counts, [text for text, _ in some], self._step(parts))
        return counts

    def _step(self, parts: list[np.ndarray]) -> np.ndarray:
        lengths = np.array([len(part) for part in parts])
        grid = np.zeros((len(parts), lengths[0]), np.int32)
        for row, part in zip(grid, parts, strict=True):
            row[:len(part)] = part
        grid = np.ascontiguousarray(grid.T)
        state = np.tile(np.array(self.roots, np.int32), (len(parts), 1))
        ends = np.zeros(state.shape, np.int32)
        active = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")  # blocks longer than the step
        for marks, n in zip(grid, active, strict=True):
            found = self.table.take(state[:n] + marks[:n, None])
            ended = found >> 31
            ends[:n] -= ended
            np.bitwise_xor(found, ended, out=state[:n])
        return ends + 1

    def predict(self, texts) -> tuple[list[str], list[float], list[float]]:
        """Language, score and phrases a mark of each text; 0 of short ones."""
        marks = [marks_of(text, self.classes) if isinstance(text, str) else np.zeros(0, np.uint8) for text in texts]
        sizes = np.array([len(m) for m in marks])
        lettered = [bool(m.any()) for m in marks]
        if not self.languages:
            return [UNKNOWN] * len(marks), [0.0] * len(marks), [0.0] * len(marks)
        phrases = self.phrases(marks) / np.maximum(sizes, 1)[:, None]
        cost = phrases * self.price
        best = cost.argmin(1)
        taken = np.where(sizes < LEAST_MARKS, 0.0, phrases[np.arange(len(marks)), best])
        ranked = np.sort(cost, 1)
        second = ranked[:, 1] if cost.shape[1] > 1 else np.full(len(marks), np.inf)
        with np.errstate(invalid="ignore"):
            score = np.where(np.isinf(second), 1.0, second / np.maximum(ranked[:, 0] + second, 1e-12))
        return (
            [self.languages[b] if ok else UNKNOWN for b, ok in zip(best, lettered, strict=True)],
            [float(s) if ok else 0.0 for s, ok in zip(score, lettered, strict=True)],
            [float(t) if ok else 0.0 for t, ok in zip(taken, lettered, strict=True)],
        )


def fit(
    docs: DataFrame, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text", *,
    fit_rows: int = FIT_ROWS, window: int = WINDOW, fit_marks: int = FIT_MARKS, fit_total: int = FIT_TOTAL,
) -> Model:
    """Samples of every language among the documents that are not held out."""
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")
    ).filter(F.col("id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~is_held_out("id"))
    # stored, so that Spark knows how small it is and leaves the texts where they are
    held = materialize(rows.groupBy("lang").agg(F.count("*").alias("n")))
    place = F.xxhash64("id")
    start = F.pmod(place, F.greatest(F.length("text") - window, F.lit(0)) + 1) + 1
    chosen = rows.join(held, "lang").filter(F.pmod(place, F.col("n")) < fit_rows)
    found = chosen.select("lang", "n", "id", F.substr("text", start.cast("int"), F.lit(window)).alias("part")).toPandas()
    found = found.sort_values(["n", "lang", "id", "part"], ascending=[False, True, True, True])
    letters = "".join(sorted({c for part in found["part"] for c in part.lower() if c.isalpha() and ord(c) < 0x110000}))
    classes = letter_classes(letters)
    parts = {
        lang: np.concatenate([marks_of(part, classes) for part in group["part"]]) for lang, group in found.groupby("lang", sort=False)
    }
    # a language without a single letter in its sample explains nothing
    kept = {lang: marks for lang, marks in parts.items() if marks.any()}
    most = min(fit_marks, fit_total // max(len(kept), 1))
    return Model(tuple(kept), letters, tuple(marks[:most].tobytes() for marks in kept.values()))


_parsers: dict[Model, CrossParser] = {}


def parser_of(model: Model) -> CrossParser:
    """The parser of a model, built once in a Python worker."""
    if model not in _parsers:
        _parsers.clear()
        _parsers[model] = CrossParser(model)
    return _parsers[model]


def predict(text: Column, model: Model) -> Column:
    """struct(lang_pred, score, phrases) of a whole text."""

    @F.pandas_udf("lang_pred string, score double, phrases double")
    def predicted(texts: pd.Series) -> pd.DataFrame:
        languages, scores, phrases = parser_of(model).predict(texts)
        return pd.DataFrame({"lang_pred": languages, "score": scores, "phrases": phrases})

    return predicted(text)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, held_out, lang_pred and score of every document."""
    found = docs.select(F.col(id_col), is_held_out(id_col).alias("held_out"), predict(F.col(text_col), model).alias("__found"))
    return found.select(id_col, "held_out", "__found.lang_pred", "__found.score")


def keep_identified(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The documents in a learned language, all columns as they were: text with a
    letter, which takes at most ``MOST_PHRASES`` phrases a mark, however long the samples
    are, if it has marks enough to tell."""
    found = docs.withColumn("__found", predict(F.col(text_col), model))
    return found.filter((F.col("__found.lang_pred") != UNKNOWN) & (F.col("__found.phrases") <= MOST_PHRASES)).drop("__found")
