import pytest

# Columns whose names the operators use inside, with values that would show if they were taken.
CLASHING = (
    "id fp rank chunk size target text_hash n w common score label measures shard slot p place sequence_id offset component_id held_out words "
    "chars own other vector bytes sha1 first_id found s copies taken whole"
).split()


@pytest.fixture(scope="session")
def odd_documents(spark):
    """NULLs in every column, empty, blank, long and repeated texts, and clashing extra columns."""
    long_text = " ".join(f"word{i % 977} and the of" for i in range(8000))
    rows = [
        (1, "The of and quick brown fox.", "en", "a"), (2, None, "en", "a"), (3, "", None, None), (4, " \n\t ", "en", "b"),
        (5, long_text, "en", "b"), (6, "12345 !!! 678", "de", None), (7, "The of and quick brown fox.", "de", "c"),
        (8, "The of and quick brown fox.", "en", "a"), (8, "The of and quick brown fox.", "en", "a"),
        (None, "no id here at all", None, "c"), (None, None, None, None), (9, "x", "fr", "é"), (10, "日本語 テキスト é́", "ja", "z"),
        (11, "a\x00b\x1fc d e", "en", "a"), (12, "line one\nline one\n\nline two", "en", "b"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return df.selectExpr("*", "length(text) AS n_chars", *(f"-777 AS {name}" for name in CLASHING)).repartition(3)


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.limit(0)
