import random
import re
from collections import Counter

import duckdb
import numpy as np

from odd_rows import no_documents, odd_documents  # noqa: F401
from sieveframe.llm import collocations

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def by_hand(rows, least, per_lang):
    """Counting every phrase of every piece."""
    counts, totals = {}, Counter()
    for text, lang in rows:
        own = counts.setdefault(lang or "und", Counter())
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            totals[lang or "und"] += len(words)
            for n in range(1, 5):
                own.update(tuple(words[i:i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, f in counts.items():
        scored = []
        for phrase, a in f.items():
            if len(phrase) < 2 or a < least:
                continue
            longer = [f[p] for p in f if len(p) > len(phrase) and f[p] >= least and any(p[i:i + len(phrase)] == phrase for i in range(len(p)))]
            if any(100 * n >= 80 * a for n in longer):
                continue
            cuts = [(2_000_000 * a // (f[phrase[:k]] + f[phrase[k:]]), k) for k in range(1, len(phrase))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(phrase).encode(), f[phrase[:k]], f[phrase[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:per_lang], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def random_rows(seed, documents, words):
    rng = random.Random(seed)
    names = [f"W{i}é" if i % 5 == 0 else f"w{i}" for i in range(words)]
    weights = [1 / (i + 1) for i in range(words)]
    def text():
        picked = rng.choices(names, weights, k=rng.randrange(120))
        return "".join(word + rng.choice([" ", " ", " ", "\t ", ", ", ".", "\n", " ; ", "\x0b"]) for word in picked)
    return [(text(), rng.choice(["en", "en", "de", None])) for _ in range(documents)]


def test_against_counting(spark):
    rows = random_rows(1, 150, 40) + [("the same words again and the same words again", "en")] * 60 + [("ha " * 400, "de")]
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(5)
    for least, per_lang, bucket in ((30, 2000, 1_000_000), (5, 40, 200), (3, 2000, 50)):
        got = sorted(map(tuple, collocations.mine(docs, least=least, per_lang=per_lang, bucket=bucket).collect()))
        assert got == by_hand(rows, least, per_lang) and got


def test_sql_agrees(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    con = duckdb.connect()
    con.execute("create view documents as select * from '/root/testdata/sf0.001/documents.parquet'")
    got = collocations.mine(docs)
    want = con.sql(f"select {', '.join(got.columns)} from ({collocations.oracle_sql()})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want) and want


def test_odd_rows(spark, odd_documents, no_documents):
    rows = [tuple(r) for r in odd_documents.select("text", "lang").collect()]
    for bucket in (1_000_000, 3000):
        assert sorted(map(tuple, collocations.mine(odd_documents, bucket=bucket).collect())) == by_hand(rows, 30, 2000)
    assert collocations.mine(no_documents).count() == 0
    assert collocations.mine(odd_documents).columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_long_texts_in_blocks(spark):
    """Phrases across the blocks of a text, and more words than a chunk can number."""
    text = " ".join(f"x{i} y z" for i in range(90_000)) + " a b c d" * 40
    rows = [(text, "en"), ("a b c d " * 50, "en")]
    docs = spark.createDataFrame(rows, "text string, lang string")
    got = {r.phrase: r.a for r in collocations.mine(docs).collect()}
    words = [t.split() for t, _ in rows]
    assert got["y z"] == 90_000 and got["a b c d"] == sum(w[i:i + 4] == ["a", "b", "c", "d"] for w in words for i in range(len(w)))
    split = list(collocations.blocks(b"A b, c\td.", 3))
    assert sum((found for found, _ in split), []) == [b"a", b"b", b".", b"c", b"d", b"."]
    assert len(split) > 1 and [last for _, last in split] == [False] * (len(split) - 1) + [True]


def test_sieve_passes_all_frequent_words(spark):
    words = spark.range(5000).selectExpr("concat('wörd', id) AS phrase")
    sieve = collocations.Sieve(words)
    assert all(f"wörd{i}".encode() in sieve for i in range(5000))
    assert sum(f"other{i}".encode() in sieve for i in range(5000)) < 250


def test_words_beyond_the_common_ones(spark, monkeypatch):
    """Phrases are the same whether their words are numbered for all or sent along."""
    rows = random_rows(8, 200, 60)
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    want = by_hand(rows, 5, 2000)
    own = collocations.vocabulary
    for most in (0, 7):
        monkeypatch.setattr(collocations, "vocabulary", lambda words, least, hot: own(words, least, hot, most))
        assert sorted(map(tuple, collocations.mine(docs, least=5, bucket=300).collect())) == want


def test_quicksort_of_pointers():
    """Partitions against counting prefixes, with and without the outright sort."""
    rng = np.random.default_rng(3)
    for words, rows in ((2, 500), (7, 3000), (300, 4000), (1, 200)):
        columns = rng.integers(1, words + 1, (4, rows)).astype(np.int32)
        ends = rng.integers(1, 6, rows)
        for step in range(4):
            columns[step, ends <= step] = 0
        weights = rng.integers(1, 4, rows)
        want = Counter()
        for row, n in zip(columns.T, weights, strict=True):
            for size in range(2, 5):
                if row[size - 1]:
                    want[tuple(row[:size])] += int(n)
        for least in (1, 12):
            for small in (0, 16, 10_000):
                got = [(tuple(columns[:size, at]), n) for at, size, n in collocations.sort_pointers(columns, weights, least, small)]
                assert len(got) == len(set(got)) and dict(got) == {k: n for k, n in want.items() if n >= least}
