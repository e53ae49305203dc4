import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from odd_rows import no_documents, odd_documents  # noqa: F401
from sieveframe.llm import audit

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def by_hand(rows, least_docs=30, ranks=50):
    """Every term of every group, ranked in full. ``rows``: text, lang, source."""
    counts, spread = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        terms = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(LOWER))
        counts[lang or "", source or ""].update(terms)
        spread[lang or ""].update(set(terms))
    out = []
    for lang, docs in spread.items():
        kept = [t for t, n in docs.items() if n >= least_docs]
        groups = {s: c for (own, s), c in counts.items() if own == lang}
        groups = {s: {t: c[t] for t in kept} for s, c in groups.items()}
        whole = {t: sum(c[t] for c in groups.values()) for t in kept}

        def shares(c):
            total = sum(c.values()) + 5 * len(kept)
            return {t: 1 + 1_000_000_000 * (n + 5) // total for t, n in c.items()}

        p, q = {s: shares(c) for s, c in groups.items()}, shares(whole)
        for s, c in groups.items():
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in groups if o != s]
            terms = [(q[t] - p[s][t], t.encode(), t) for t in kept if c[t] > 0 and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:ranks])):
                out += [(lang, s, part, item, -value, rank) for rank, (value, _, item) in enumerate(found, 1)]
    return sorted(out)


def random_rows(seed, documents, words, sources):
    rng = random.Random(seed)
    names = [rng.choice(["Ü", "w", "q", "é", "𝄞", "Z"]) + chr(97 + i % 26) + chr(97 + i // 26 % 26) for i in range(words)]
    def text(source):
        weights = [1 / (1 + (i * (source + 3)) % words) for i in range(words)]
        return "".join(w + rng.choice([" ", "-", "1", "'", "\n", "\x7f", "_"]) for w in rng.choices(names, weights, k=rng.randrange(80)))
    picked = [(rng.randrange(sources), rng.choice(["en", "en", "de", None])) for _ in range(documents)]
    return [(text(s), lang, f"s{s}" if s else None) for s, lang in picked] + [(None, "en", "silent"), ("...", "xx", "only"), ("", "xx", "other")]


@pytest.mark.parametrize("parts", [1, 6])
def test_against_full_ranking(spark, parts, monkeypatch):
    rows = random_rows(2, 700, 400, 7)
    docs = spark.createDataFrame(rows, "text string, lang string, source string").repartition(parts)
    for least_docs, ranks in ((30, 50), (3, 5), (10_000, 50)):
        got = sorted(map(tuple, audit.audit(docs, least_docs=least_docs, ranks=ranks).collect()))
        assert got == by_hand(rows, least_docs, ranks)
    monkeypatch.setattr(audit, "CELL_SOURCES", 2)
    monkeypatch.setattr(audit, "CELL_TERMS", 50)
    monkeypatch.setattr(audit, "HELD", 40)
    assert sorted(map(tuple, audit.audit(docs, least_docs=5).collect())) == by_hand(rows, 5)


def test_sql_agrees(spark):
    rows = random_rows(4, 500, 150, 4)
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    got = audit.audit(docs)
    want = con.sql(f"select {', '.join(got.columns)} from ({audit.oracle_sql()})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want) == by_hand(rows)


def test_odd_rows(odd_documents, no_documents):
    rows = [tuple(r) for r in odd_documents.select("text", "lang", "source").collect()]
    for least_docs in (30, 1):
        assert sorted(map(tuple, audit.audit(odd_documents, least_docs=least_docs).collect())) == by_hand(rows, least_docs)
    found = audit.audit(no_documents)
    assert found.count() == 0 and found.columns == ["lang", "source", "part", "item", "value", "rank"]


def test_retained_rows_are_those_with_few_dominators():
    rng = np.random.default_rng(1)
    for size, high, ranks in ((300, 6, 4), (400, 1000, 10), (200, 1, 3)):
        rows = sorted((-int(rng.integers(high)), int(rng.integers(high)), bytes(rng.integers(97, 123, 2).tolist()) + bytes([i % 256, i // 256])) for i in range(size))
        totals, terms = np.array([t for _, t, _ in rows]), np.array([t for *_, t in rows], object)
        want = [sum(a[0] <= r[0] and a[1] <= r[1] and a[2] <= r[2] for a in rows) - 1 < ranks for r in rows]
        keep, kept = audit.retained(totals, terms, np.zeros(0, np.int64), np.zeros(0, object), ranks)
        assert keep.tolist() == want
        first, kept = audit.retained(totals[:90], terms[:90], np.zeros(0, np.int64), np.zeros(0, object), ranks)
        rest, _ = audit.retained(totals[90:], terms[90:], *kept, ranks)
        assert [*first, *rest] == want


def test_shares_are_exact(spark):
    big = 4 * 10**15
    row = spark.range(1).select(audit.share(audit.F.lit(big), audit.F.lit(3 * big + 1), audit.F.lit(7)).alias("p")).first()
    assert row.p == 1 + 10**9 * (big + 5) // (3 * big + 1 + 35)
