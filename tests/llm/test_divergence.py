import re
from collections import Counter

import duckdb

from odd_rows import no_documents, odd_documents  # noqa: F401
from sieveframe.llm import divergence


def by_hand(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    counts = Counter(windows)
    covered = {j for i, window in enumerate(windows) if counts[window] > 1 for j in range(i, i + 8)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed


def compared(docs):
    got = docs.select("doc_id", "text", "lang").toPandas()
    con = duckdb.connect()
    con.register("documents", got)
    judged = divergence.apply_rules(docs).drop("char_distance", "word_distance")
    rows = judged.collect()
    key = lambda r: tuple((x is None or x != x, 0 if x is None or x != x else x) for x in r)
    columns = ", ".join(judged.columns)
    want = con.sql(f"SELECT {columns} FROM ({divergence.oracle_sql()})").fetchall()
    assert sorted(map(tuple, rows), key=key) == sorted(want, key=key)
    return rows


def test_odd_rows(odd_documents, no_documents):
    rows = compared(odd_documents)
    texts = odd_documents.select("text").toPandas()["text"]
    assert sorted(tuple(r)[1:7] for r in rows) == sorted(map(by_hand, texts))
    assert all(not r.kept for r in rows if r.base_failed)
    assert divergence.apply_rules(no_documents).count() == 0


def test_strays_are_rejected(spark):
    plain = [" ".join(f"the of {chr(97 + (i + j) % 26)}word{'abcdefghij'[j % 10]}" for j in range(40)) for i in range(60)]
    odd = ["%%% ### ||| <<< >>> " * 3 + " ".join(f"#{i}$%&|<>{i * 7}*" for i in range(90)), " ".join(f"UNSEEN{i}!" for i in range(100))]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(plain + odd)], "doc_id long, text string, lang string")
    kept = {r.doc_id: r.kept for r in compared(docs)}
    assert all(kept[i] for i in range(60)) and not kept[60] and not kept[61]


def test_repeated_windows(spark):
    base = " ".join(f"w{i}" for i in range(30))
    texts = [base + " " + base, base + " x " + base[:40], " ".join("ab" for _ in range(50)), base, "a b c d e f g h a b c d e f g h"]
    docs = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    got = {r.doc_id: r.n_repeat_words for r in divergence.apply_rules(docs).collect()}
    assert got == {i: by_hand(t)[4] for i, t in enumerate(texts)}
