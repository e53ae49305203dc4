"""Phrase collocations by multikey quicksort of suffix pointers.

Every word begins a suffix, which is followed for ``LONGEST`` words or to the end of
its piece. Suffixes are routed by their leading words, and each bucket sorts pointers
to its own: a partition is split in three around a word, the partition of equal words
is one phrase and its size the phrase's count, and only that one is sorted by the next
word. A partition with fewer than ``least`` suffixes holds no frequent phrase of any
length and is abandoned. Partitions of at most ``SMALL`` pointers are sorted outright.

Routing: a suffix goes by its words up to the first that is not hot, two at least. A
word is hot from a quarter of a bucket's share of all words on, so a bucket stays near
its size whatever words the corpus repeats. A phrase of hot words only may lie in
several buckets; its counts there are added, whatever their size. A suffix of
``LONGEST`` hot words is collapsed with its equals before it is moved.

A word that occurs fewer than ``least`` times ends a suffix, since no frequent phrase
holds it. Tasks know these words by a sieve of bounded size (``SIEVE_BITS``); what it
lets pass costs time, never counts. The ``COMMON`` most frequent words have numbers of
their own. They and the sieve are all that is broadcast.

What moves: a task numbers the words of about ``CHUNK`` positions and sends each bucket
one row of packed numbers, with the words that are not common. Memory is bounded by a
chunk, a bucket and the bytes of the longest text, which is read in blocks.

Then phrases meet their parts and the phrases around them by equality joins, in decimal
arithmetic wherever a product might pass 64 bits.

Rows: NULL text counts as empty, NULL language as ``und``; repeated rows count as often
as they occur; other columns, whatever their names, are not read; an empty table, and a
language without a candidate, give no rows. Ties are settled by the phrase's bytes.
"""

from __future__ import annotations

import itertools
import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import materialize

LEAST = 30
LONGEST = 4
SCALE = 2_000_000
#: A phrase is part of a longer one that has this many hundredths of its count.
PART_OF = 80
PER_LANG = 2000
UNKNOWN = "und"
#: Positions numbered together, and suffixes a bucket should hold.
CHUNK = 2_000_000
BUCKET = 1_000_000
#: Bits of the sieve of frequent words at most, as a power of 2.
SIEVE_BITS = 26
#: Pointers that are sorted outright.
SMALL = 1024
#: Bytes of a text that are split at once; each word takes two at least.
BLOCK = 100_000
#: Different words whose counts a task holds before it passes them on.
HELD_WORDS = 200_000
#: Bits of a word's number, and how many words have one in all chunks; 0 ends a suffix.
NUMBER_BITS = 20
COMMON = 1 << 18

_BREAK = b"."
_FOLD = bytearray(range(256))
_FOLD[65:91] = range(97, 123)
for _byte in b".,;:!?\n\v\f\r":
    _FOLD[_byte] = _BREAK[0]
_FOLD = bytes(_FOLD)
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def blocks(text: bytes | None, size: int = BLOCK) -> Iterator[tuple[list[bytes], bool]]:
    """Words of a text, some at a time, with ``.`` where a piece ends; and whether they
    are the last."""
    spaced = (text or b"").translate(_FOLD).replace(_BREAK, b" . ")
    at = 0
    while at < len(spaced):
        end = spaced.find(b" ", at + size)
        end = len(spaced) if end < 0 else end
        yield spaced[at:end].split(), end == len(spaced)
        at = end


def _texts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text_col).cast("binary").alias("text"))


def count_words(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang, phrase (one word) and n, its occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = held.setdefault(lang, Counter())
                for found, _ in blocks(text.as_py()):
                    own.update(found)
                if sum(map(len, held.values())) > HELD_WORDS:
                    yield from sent(held)
                    held = {}
        yield from sent(held)

    def sent(held: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        for lang, own in held.items():
            own.pop(_BREAK, None)
            if own:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(own), pa.string()), pa.array(list(own), pa.binary()), pa.array(list(own.values()), pa.int64())],
                    ["lang", "phrase", "n"])

    partial = _texts(docs, text_col, lang_col).mapInArrow(run, "lang string, phrase binary, n long")
    return partial.groupBy("lang", F.col("phrase").cast("string").alias("phrase")).agg(F.sum("n").alias("n"))


class Sieve:
    """Bits of the frequent words; it may pass other words too. Two a word, out of 16 or
    more up to ``SIEVE_BITS`` words, beyond which it passes more and more."""

    def __init__(self, words: DataFrame):
        some = words.select(F.xxhash64("phrase").alias("h"))
        size = 1 << min(max((16 * some.count()).bit_length(), 10), SIEVE_BITS)
        self.mask = size - 1
        at = some.select(F.explode(F.array(*(F.expr(f"shiftrightunsigned(h, {by}) & {self.mask}L") for by in (0, 32)))).alias("at"))
        bits = at.groupBy(F.shiftright("at", 6).alias("part")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits")).toPandas()
        table = np.zeros(size // 64, np.int64)
        table[bits["part"]] = bits["bits"]
        self.bits = table.tobytes()

    def __contains__(self, word: bytes) -> bool:
        h, bits, mask = xxhash.xxh64_intdigest(word, 42), self.bits, self.mask
        a, b = h & mask, h >> 32 & mask
        return bits[a >> 3] >> (a & 7) & 1 and bits[b >> 3] >> (b & 7) & 1


class Vocabulary:
    """Common words with their numbers, from 1 on, the most frequent first; which of
    them are hot in each language; and a sieve of the other frequent words."""

    def __init__(self, words: list[bytes], hot: dict[str, list[bytes]], sieve: Sieve):
        self.words, self.sieve = [_BREAK, *words], sieve
        self.numbers = {word: number for number, word in enumerate(self.words)}
        self.hot = {lang: np.array([self.numbers[word] for word in found], np.int32) for lang, found in hot.items()}
        self._hashes: np.ndarray | None = None

    def hashes(self) -> np.ndarray:
        if self._hashes is None:
            self._hashes = np.fromiter(map(xxhash.xxh64_intdigest, self.words), np.uint64, len(self.words))
        return self._hashes

    def is_hot(self, lang: str, size: int) -> np.ndarray:
        out = np.zeros(size, bool)
        out[self.hot.get(lang, np.zeros(0, np.int32))] = True
        return out


class _Numbers(dict):
    """Words to numbers: common ones, others in order of appearance, 0 for those sifted out."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__(vocabulary.numbers)
        self.first, self.others, self.sieve = len(vocabulary.words), [], vocabulary.sieve

    def __missing__(self, word: bytes) -> int:
        number = 0
        if word in self.sieve:
            number = self.first + len(self.others)
            self.others.append(word)
        self[word] = number
        return number


class Chunk:
    """Positions of a task, in texts of one language, whose words share one numbering."""

    def __init__(self, lang: str, buckets: int, vocabulary: Vocabulary):
        self.lang, self.buckets, self.vocabulary = lang, buckets, vocabulary
        self.clear()

    def clear(self) -> None:
        self.numbers = _Numbers(self.vocabulary)
        self.held: list[np.ndarray] = []
        self.positions = 0

    def fits(self, found: list[bytes]) -> bool:
        seen = len(self.numbers) - len(self.vocabulary.words)
        return seen < HELD_WORDS and self.numbers.first + len(self.numbers.others) + len(found) < 1 << NUMBER_BITS

    def add(self, found: list[bytes], last: bool) -> None:
        """Suffixes of a run of words; without ``last`` its closing words only end others."""
        numbers = np.zeros(len(found) + LONGEST - 1, np.int32)
        numbers[:len(found)] = np.fromiter(map(self.numbers.__getitem__, found), np.int32, len(found))
        starts = len(found) if last else max(len(found) - LONGEST + 1, 0)
        # a word alone is counted with the words
        goes_on = inside = (numbers[:starts] > 0) & (numbers[1:1 + starts] > 0)
        suffixes = np.empty((LONGEST, starts), np.int32)
        suffixes[:2] = numbers[:starts], numbers[1:1 + starts]
        for step in range(2, LONGEST):
            goes_on = goes_on & (numbers[step:step + starts] > 0)
            suffixes[step] = numbers[step:step + starts] * goes_on
        self.held.append(suffixes[:, inside])
        self.positions += len(found)

    def sent(self) -> Iterator[pa.RecordBatch]:
        """One row for each bucket; the chunk is empty afterwards."""
        suffixes = np.concatenate(self.held, axis=1) if self.held else np.zeros((LONGEST, 0), np.int32)
        if suffixes.shape[1]:
            others, first = self.numbers.others, self.numbers.first
            hashes = np.r_[self.vocabulary.hashes(), np.fromiter(map(xxhash.xxh64_intdigest, others), np.uint64, len(others))]
            is_hot = self.vocabulary.is_hot(self.lang, len(hashes))
            counts = np.ones(suffixes.shape[1], np.uint32)
            hot = is_hot[suffixes].all(0)
            if hot.any():
                alike, repeats = np.unique(suffixes[:, hot], axis=1, return_counts=True)
                suffixes = np.concatenate([suffixes[:, ~hot], alike], axis=1)
                counts = np.r_[counts[~hot], repeats.astype(np.uint32)]
            bucket = self.route(suffixes, hashes, is_hot)
            # in order of their first words, so that their bytes repeat
            order = np.argsort(suffixes[0].astype(np.int64) << NUMBER_BITS | suffixes[1])
            order = order[np.argsort(bucket[order], kind="stable")]
            suffixes, counts, bucket = suffixes[:, order], counts[order], bucket[order]
            edges = np.r_[0, np.flatnonzero(np.diff(bucket)) + 1, len(bucket)]
            rows = []
            for a, b in itertools.pairwise(edges):
                own = suffixes[:, a:b]
                used = np.unique(own[own >= first])
                # bytes of one weight together
                packed = np.ascontiguousarray(own).view(np.uint8).reshape(LONGEST, -1, 4).transpose(0, 2, 1)[:, :3]
                rows.append((self.lang, int(bucket[a]), used.astype(np.int32).tobytes(), b" ".join([others[i - first] for i in used]),
                             packed.tobytes(), counts[a:b].tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), PACKED.types, strict=True)], PACKED.names)
        self.clear()

    def route(self, suffixes: np.ndarray, hashes: np.ndarray, is_hot: np.ndarray) -> np.ndarray:
        """Bucket of each suffix: by its words up to the first that is not hot, two at least."""
        route = np.full(suffixes.shape[1], xxhash.xxh64_intdigest(self.lang), np.uint64)
        leads = np.ones(len(route), bool)
        all_hot = is_hot[suffixes[0]]
        for step, words in enumerate(suffixes):
            if step >= 2:
                all_hot = all_hot & is_hot[suffixes[step - 1]]
                leads = all_hot & (words > 0)
            route = np.where(leads, (route ^ hashes[words]) * _MIX[step % len(_MIX)], route)
            route ^= route >> np.uint64(31)
        bucket = route % np.uint64(self.buckets)
        return bucket.astype(np.uint16 if self.buckets <= 1 << 16 else np.int64)


PACKED = pa.schema([("lang", pa.string()), ("bucket", pa.int64()), ("used", pa.binary()), ("words", pa.binary()), ("suffixes", pa.binary()), ("counts", pa.binary())])


def unpacked(row: dict) -> np.ndarray:
    """Numbers of the suffixes in a row."""
    three = np.frombuffer(row["suffixes"], np.uint8).reshape(LONGEST, 3, -1)
    four = np.zeros((LONGEST, three.shape[2], 4), np.uint8)
    four[:, :, :3] = three.transpose(0, 2, 1)
    return four.view(np.int32)[:, :, 0]


def pack_suffixes(docs: DataFrame, buckets: int, shared: Broadcast[Vocabulary], text_col: str, lang_col: str) -> DataFrame:
    """Suffixes of all texts, packed by chunk, language and bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks: dict[str, Chunk] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if lang not in chunks:
                    chunks[lang] = Chunk(lang, buckets, shared.value)
                chunk, carried = chunks[lang], []
                for found, last in blocks(text.as_py()):
                    found = carried + found
                    if not chunk.fits(found):
                        yield from chunk.sent()
                    chunk.add(found, last)
                    carried = found[-(LONGEST - 1):]
                if sum(chunk.positions for chunk in chunks.values()) >= CHUNK:
                    for chunk in chunks.values():
                        yield from chunk.sent()
                    chunks = {}
        for chunk in chunks.values():
            yield from chunk.sent()

    return _texts(docs, text_col, lang_col).mapInArrow(
        run, "lang string, bucket long, used binary, words binary, suffixes binary, counts binary")


def sort_pointers(columns: np.ndarray, weights: np.ndarray, least: int, small: int = SMALL) -> Iterator[tuple[int, int, int]]:
    """(a pointer, words, count) of every phrase of two words or more that ``least``
    suffixes or more begin with. ``columns`` holds the words of the suffixes, 0 after
    their end; ``weights`` how often each occurs."""
    longest = len(columns)
    waiting = [(np.arange(columns.shape[1]), 0)]
    while waiting:
        at, depth = waiting.pop()
        if len(at) <= small:
            yield from _sorted_small(columns, weights, at, depth, least)
            continue
        keys = columns[depth][at]
        sample = np.sort(keys[::max(len(keys) // 9, 1)][:9])
        pivot = sample[len(sample) // 2]
        lower, higher = keys < pivot, keys > pivot
        for part in (at[lower], at[higher]):
            if len(part) and weights[part].sum() >= least:
                waiting.append((part, depth))
        if pivot:
            same = at[~(lower | higher)]
            count = int(weights[same].sum())
            if count >= least:
                if depth:
                    yield int(same[0]), depth + 1, count
                if depth + 1 < longest:
                    waiting.append((same, depth + 1))


def _sorted_small(columns: np.ndarray, weights: np.ndarray, at: np.ndarray, depth: int, least: int) -> Iterator[tuple[int, int, int]]:
    """The same for a partition whose first ``depth`` words are equal, by sorting it."""
    at = at[np.lexsort(columns[depth:, at][::-1])]
    total = np.r_[0, np.cumsum(weights[at])]
    changed = np.zeros(len(at), bool)
    changed[:1] = True
    for step in range(depth, len(columns)):
        keys = columns[step][at]
        changed[1:] |= keys[1:] != keys[:-1]
        if not step:
            continue
        starts = np.flatnonzero(changed)
        counts = total[np.r_[starts[1:], len(at)]] - total[starts]
        for i in np.flatnonzero((counts >= least) & (keys[starts] > 0)):
            yield int(at[starts[i]]), step + 1, int(counts[i])


def count_phrases(packed: DataFrame, shared: Broadcast[Vocabulary], least: int, partitions: int) -> DataFrame:
    """lang, phrase and n of every phrase of two words or more that occurs ``least`` times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = [], None
        for batch in batches:
            for row in batch.to_pylist():
                if (row["lang"], row["bucket"]) != at and held:
                    yield from counted(at[0], held)
                    held = []
                at = row["lang"], row["bucket"]
                held.append(row)
        if held:
            yield from counted(at[0], held)

    def counted(lang: str, rows: list[dict]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        others, columns = {}, []
        for row in rows:
            own = unpacked(row)
            if row["used"]:
                used = np.frombuffer(row["used"], np.int32)
                lookup = np.arange(used[-1] + 1, dtype=np.int32)
                lookup[used] = [others.setdefault(word, len(vocabulary.words) + len(others)) for word in row["words"].split(b" ")]
                own = lookup[own]
            columns.append(own)
        columns = np.concatenate(columns, axis=1)
        weights = np.concatenate([np.frombuffer(row["counts"], np.uint32) for row in rows]).astype(np.int64)
        rest = list(others)
        is_hot = vocabulary.is_hot(lang, len(vocabulary.words) + len(rest))
        found = [
            (pointer, words, count) for pointer, words, count in sort_pointers(columns, weights, least)
            if words == LONGEST or not is_hot[columns[:words, pointer]].all()
        ]
        found.extend(_hot_phrases(columns, weights, is_hot))
        for i in range(0, len(found), 50_000):
            some = found[i:i + 50_000]
            phrases = [
                b" ".join([vocabulary.words[n] if n < len(vocabulary.words) else rest[n - len(vocabulary.words)] for n in columns[:words, pointer].tolist()])
                for pointer, words, _ in some
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(some), pa.string()), pa.array(phrases, pa.binary()), pa.array([c for *_, c in some], pa.int64())],
                ["lang", "phrase", "n"])

    routed = packed.repartition(partitions, "bucket").sortWithinPartitions("bucket", "lang")
    counts = routed.mapInArrow(run, "lang string, phrase binary, n long")
    whole = counts.groupBy("lang", F.col("phrase").cast("string").alias("phrase")).agg(F.sum("n").alias("n"))
    return whole.filter(F.col("n") >= least)


def _hot_phrases(columns: np.ndarray, weights: np.ndarray, is_hot: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Counts in this bucket of phrases, shorter than the longest, of hot words only."""
    at, order = np.arange(columns.shape[1]), np.cumsum(is_hot) * is_hot
    key = np.zeros(len(at), np.int64)
    for step in range(LONGEST - 1):
        keep = is_hot[columns[step][at]] & (columns[step][at] > 0)
        at = at[keep]
        # hot words are common, so three of their numbers fit
        key = key[keep] << NUMBER_BITS | order[columns[step][at]]
        if step and len(at):
            _, first, inverse = np.unique(key, return_index=True, return_inverse=True)
            counts = np.bincount(inverse, weights[at]).astype(np.int64)
            yield from ((int(at[i]), step + 1, int(c)) for i, c in zip(first, counts, strict=True))


def vocabulary(words: DataFrame, least: int, hot: float, most: int = COMMON) -> Vocabulary:
    """At most ``most`` common words, and those above ``hot`` occurrences among them."""
    frequent = words.filter(F.col("n") >= least)
    # words by eighths of a power of two of their count: a few hundred classes at most
    size = F.floor(8 * F.log2("n")).cast("int")
    from_size, held = None, 0
    for row in sorted(frequent.groupBy(size.alias("size")).count().collect(), reverse=True):
        held += row["count"]
        if held > most:
            break
        from_size = row["size"]
    common = frequent.filter(size >= from_size if from_size is not None else F.lit(False)).select("lang", "phrase", "n").toPandas()
    common = common.sort_values(["n", "phrase"], ascending=[False, True])
    named = {lang: [word.encode() for word in own["phrase"]] for lang, own in common[common["n"] > hot].groupby("lang")}
    rest = frequent.filter(size < from_size) if from_size is not None else frequent
    return Vocabulary([word.encode() for word in dict.fromkeys(common["phrase"])], named, Sieve(rest))


def phrase_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", *, least: int = LEAST, bucket: int = BUCKET) -> tuple[DataFrame, DataFrame]:
    """Words, and phrases of ``least`` or more: lang, phrase, n each."""
    words = materialize(count_words(docs, text_col, lang_col))
    total = words.agg(F.sum("n")).first()[0] or 0
    buckets = max(1, math.ceil(total / bucket))
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary(words, least, max(total / (4 * buckets), total / COMMON)))
    packed = pack_suffixes(docs, buckets, shared, text_col, lang_col)
    phrases = count_phrases(packed, shared, least, max(1, math.ceil(buckets / 2)))
    return words, materialize(phrases)


def _exact(column: str | Column) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return column.cast("decimal(38,0)")


def score_phrases(words: DataFrame, phrases: DataFrame, *, least: int = LEAST, scale: int = SCALE, part_of: int = PART_OF) -> DataFrame:
    """lang, phrase, a, l, r and score of the phrases that no longer one stands for."""
    known = words.filter(F.col("n") >= least).union(phrases)
    split = F.split("phrase", " ")
    cut = phrases.select("lang", "phrase", F.col("n").alias("a"), split.alias("w"), F.posexplode(F.sequence(F.lit(1), F.size(split) - 1)).alias("i", "k"))
    cut = cut.select(
        "lang", "phrase", "a", "k", F.array_join(F.expr("slice(w, 1, k)"), " ").alias("first"),
        F.array_join(F.expr("slice(w, k + 1, size(w))"), " ").alias("rest"))
    left, right = (known.select(F.col("lang").alias(f"{s}_lang"), F.col("phrase").alias(f"{s}_phrase"), F.col("n").alias(s)) for s in "lr")
    cut = cut.join(left, (cut["lang"] == left["l_lang"]) & (cut["first"] == left["l_phrase"]))
    cut = cut.join(right, (cut["lang"] == right["r_lang"]) & (cut["rest"] == right["r_phrase"]))
    score = F.expr(f"cast((cast(a as decimal(38,0)) * {scale}) div (cast(l as decimal(38,0)) + cast(r as decimal(38,0))) as bigint)")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("low")
    scored = cut.groupBy("lang", "phrase").agg(F.first("a").alias("a"), lowest)

    inner = F.expr(
        "flatten(transform(sequence(2, size(w) - 1), n -> transform(sequence(1, size(w) - n + 1), i -> array_join(slice(w, i, n), ' '))))")
    longer = phrases.select("lang", "n", split.alias("w")).filter(F.size("w") > 2)
    around = longer.select("lang", "n", F.explode(inner).alias("phrase")).groupBy("lang", "phrase").agg(F.max("n").alias("around"))
    apart = scored.join(around, ["lang", "phrase"], "left")
    apart = apart.filter(F.col("around").isNull() | (100 * _exact("around") < part_of * _exact("a")))
    return apart.select("lang", "phrase", "a", "low.l", "low.r", "low.score")


def mine(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", *, least: int = LEAST, per_lang: int = PER_LANG, bucket: int = BUCKET,
) -> DataFrame:
    """The ``per_lang`` best phrases of each language: lang, rank, phrase, a (occurrences),
    l and r (those of its weakest cut's parts), n (words of the language), score."""
    words, phrases = phrase_counts(docs, text_col, lang_col, least=least, bucket=bucket)
    scored = score_phrases(words, phrases, least=least)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= per_lang)
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    columns = ["lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"]
    return best.join(totals, "lang").select(*columns)


def oracle_sql(least: int = LEAST, per_lang: int = PER_LANG) -> str:
    """The same in DuckDB SQL, by counting every phrase."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    grams = " union all ".join(
        f"select lang, concat_ws(' ', {', '.join(f'w{i}' for i in range(n))}) as phrase, {n} as words from runs where w{n - 1} is not null"
        for n in range(1, LONGEST + 1))
    runs = ", ".join(f"lead(word, {i}) over (partition by d, p order by i) as w{i}" for i in range(1, LONGEST))
    cuts = " union all ".join(
        f"select lang, phrase, words, a, {k} as k, array_to_string(string_split(phrase, ' ')[1:{k}], ' ') as p, array_to_string(string_split(phrase, ' ')[{k + 1}:], ' ') as q from c where words > {k}"
        for k in range(1, LONGEST))
    parts = " union all ".join(
        f"select lang, array_to_string(string_split(phrase, ' ')[{i}:{i + n - 1}], ' ') as phrase, a from c where words > {n} and words >= {i + n - 1}"
        for n in range(2, LONGEST) for i in range(1, LONGEST - n + 2))
    return (
        f"with t as (select row_number() over () as d, coalesce(lang, '{UNKNOWN}') as lang,"
        f" regexp_split_to_array(translate(coalesce(text, ''), '{upper}', '{lower}'), '[.,;:!?\\x0A-\\x0D]') as pieces from documents),"
        " pieces as (select d, lang, unnest(pieces) as piece, generate_subscripts(pieces, 1) as p from t),"
        " split as (select d, lang, p, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') as w from pieces),"
        " flat as (select d, lang, p, unnest(w) as word, generate_subscripts(w, 1) as i from split),"
        f" runs as (select lang, word as w0, {runs} from flat),"
        f" f as (select lang, phrase, words, count(*) as a from ({grams}) group by all),"
        f" c as (select * from f where words > 1 and a >= {least}),"
        f" cuts as ({cuts}),"
        f" known as materialized (select lang, phrase, a from f where a >= {least}),"
        " half as materialized (select x.*, l.a as l from cuts x join known l on l.lang = x.lang and l.phrase = x.p),"
        f" s as (select x.lang, x.phrase, x.a, k, l, r.a as r, cast((x.a::hugeint * {SCALE}) // (l + r.a) as bigint) as score"
        " from half x join known r on r.lang = x.lang and r.phrase = x.q),"
        " low as (select * from s qualify row_number() over (partition by lang, phrase order by score, k) = 1),"
        f" around as (select lang, phrase, max(a) as m from ({parts}) group by all),"
        f" apart as (select low.* from low left join around using (lang, phrase) where m is null or 100 * m < {PART_OF} * a),"
        " n as (select lang, cast(sum(a) as bigint) as n from f where words = 1 group by lang),"
        " ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from apart)"
        f" select lang, rank, phrase, a, l, r, n, score from ranked join n using (lang) where rank <= {per_lang}"
    )
