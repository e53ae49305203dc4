import numpy as np

from odd_rows import no_documents, odd_documents  # noqa: F401
from sieveframe.llm import language

VOICES = {"aa": "ba be bi bo bu da de di do du".split(), "bb": "ka ke ki ko ku ta te ti to tu".split()}


def phrases_by_hand(text, sample):
    """Greedy parse into the longest parts that occur in the sample."""
    at = count = 0
    while at < len(text):
        end = at + 1
        while end < len(text) and text[at:end + 1] in sample:
            end += 1
        count, at = count + 1, end
    return count


def text_in(lang, seed, n=60):
    pick = np.random.default_rng(seed)
    return " ".join("".join(pick.choice(VOICES[lang], 3)) for _ in range(n))


def test_phrases_equal_a_search_in_the_sample(monkeypatch):
    monkeypatch.setattr(language, "BLOCK", 50)
    monkeypatch.setattr(language, "TOGETHER", 7)
    letters = "abcdeikotu"
    classes = language.letter_classes(letters)
    samples = [language.marks_of(text_in(lang, 1), classes).tobytes() for lang in VOICES]
    parser = language.CrossParser(language.Model(tuple(VOICES), letters, tuple(samples)))
    texts = [language.marks_of(t, classes) for t in (text_in("aa", 5), text_in("bb", 6, 200), "zzz qqq", "b", "", "Ba! de?")]
    want = [[sum(phrases_by_hand(t.tobytes()[i:i + 50], s) for i in range(0, len(t), 50)) for s in samples] for t in texts]
    assert parser.phrases(texts).tolist() == want


def test_held_out_accuracy(spark):
    rows = [(i, text_in(("aa", "bb")[i % 2], i, 5 + i % 40), ("aa", "bb")[i % 2]) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language.identify(docs, language.fit(docs)).join(docs, "doc_id").toPandas()
    held = got[got["held_out"]]
    assert len(held) > 10 and (held["lang_pred"] == held["lang"]).all() and got["score"].between(0, 1).all()


def test_odd_rows(spark, odd_documents, no_documents):
    model = language.fit(odd_documents)
    got = language.identify(odd_documents, model).toPandas()
    texts = odd_documents.select("text").toPandas()["text"]
    assert (got["lang_pred"] == "und").sum() == sum(not any(c.isalpha() for c in t or "") for t in texts)
    assert (got[got["lang_pred"] == "und"]["score"] == 0).all()
    kept = language.keep_identified(odd_documents, model)
    assert kept.columns == odd_documents.columns and 0 < kept.count() < odd_documents.count()
    nothing = language.fit(no_documents)
    assert set(language.identify(odd_documents, nothing).toPandas()["lang_pred"]) == {"und"}
    assert language.identify(no_documents, model).count() == 0


def test_unknown_script_is_rejected(spark):
    docs = spark.createDataFrame([(i, text_in("aa", i), "aa") for i in range(50)], "doc_id long, text string, lang string")
    other = spark.createDataFrame([(1, "Это совсем другой язык"), (2, text_in("aa", 99))], "doc_id long, text string")
    assert [r.doc_id for r in language.keep_identified(other, language.fit(docs)).collect()] == [2]


def test_letters_of_large_alphabets_stay_apart(spark):
    def written(first, seed, n=60, many=400):
        pick = np.random.default_rng(seed)
        return "".join(chr(first + int(i)) for i in pick.zipf(1.3, n) % many)

    firsts = {"aa": 0x4E00, "bb": 0x6E00, "cc": 0xAC00, "dd": 0xB800}
    rows = [(i, written(first, 10 * i + j), lang) for i in range(80) for j, (lang, first) in enumerate(firsts.items())]
    docs = spark.createDataFrame([(k, text, lang) for k, (_, text, lang) in enumerate(rows)], "doc_id long, text string, lang string")
    model = language.fit(docs)
    assert len(model.letters) > 250
    got = language.identify(docs, model).join(docs, "doc_id").toPandas()
    held = got[got["held_out"]]
    assert len(held) > 10 and (held["lang_pred"] == held["lang"]).all()
    other = spark.createDataFrame([(1, written(0xA000, 7)), (2, written(0x8E00, 8)), (3, written(0xAC00, 9))], "doc_id long, text string")
    assert [r.doc_id for r in language.keep_identified(other, model).collect()] == [3]


def test_short_texts_are_kept_whatever_the_samples(spark):
    for rows in (10, 60):
        docs = spark.createDataFrame([(i, text_in("aa", i), "aa") for i in range(rows)], "doc_id long, text string, lang string")
        short = spark.createDataFrame([(1, "ok"), (2, "Ja"), (3, "?"), (4, None)], "doc_id long, text string")
        assert sorted(r.doc_id for r in language.keep_identified(short, language.fit(docs)).collect()) == [1, 2]
