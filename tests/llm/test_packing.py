import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from odd_rows import no_documents, odd_documents  # noqa: F401
from sieveframe.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def ids_of(text):
    tokenizer = Tokenizer.from_file(PATH)
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")


@pytest.mark.parametrize("capacity,window", [(2048, 4_000_000), (64, 64), (7, 100)])
def test_pieces_cover_documents_and_fill_sequences(spark, odd_documents, capacity, window):
    got = packing.pack(odd_documents, PATH, capacity=capacity, window_tokens=window).toPandas()
    docs = odd_documents.select("doc_id", "text").toPandas()
    want = sorted(len(ids_of(t)) for t in docs["text"])
    assert sorted(got[got["start"] == 0]["doc_tokens"]) == want
    assert got["length"].sum() == sum(want)
    by_id = {row.doc_id: ids_of(row.text) for row in docs.itertuples() if row.doc_id not in (8,) and row.doc_id == row.doc_id}
    for row in got[got["doc_id"].isin(list(by_id))].itertuples():
        assert row.ids_crc32 == zlib.crc32(by_id[row.doc_id][row.start:row.start + row.length].tobytes())
    for _, pieces in got.groupby("doc_id"):
        pieces = pieces.sort_values("start")
        if pieces["start"].eq(0).sum() == 1:
            assert (pieces["start"].values[1:] == pieces["length"].cumsum().values[:-1]).all()
    for _, pieces in got.groupby("sequence_id"):
        pieces = pieces.sort_values("offset")
        assert pieces["offset"].tolist() == [0, *pieces["length"].cumsum().tolist()[:-1]]
        total = int(pieces["length"].sum())
        assert total == pieces["sequence_tokens"].iloc[0]
        assert total == capacity or total & (total - 1) == 0


def test_costs_are_balanced():
    packer = packing.Packer(0, 100, 100, 1.0, 0.01)
    for i in range(400):
        packer.add(i, bytes(4 * (1 + i * 37 % 60)))
    packer.finish()
    cost = {}
    for _, _, length, _, _, sequence, _, tokens in packer.out:
        if tokens == 100:
            cost[sequence] = cost.get(sequence, 0) + length + 0.01 * length * length
    assert max(cost.values()) < 1.3 * min(cost.values())


def test_empty_table(no_documents):
    assert packing.pack(no_documents, PATH).count() == 0


def test_small_cache_gives_the_same_ids(monkeypatch):
    texts = ["Some words, and the same words again; İstanbul's 42nd çà.", "words! words? re-words 3.14", ""] * 3
    monkeypatch.setattr(packing, "CACHE_ENTRIES", 4)
    assert packing._WordEncoder(PATH, 1)(texts) == [ids_of(t).tobytes() for t in texts]


def test_ids_are_the_tokenizers(spark):
    """Names of the tokenizer's own tokens, alphabets, contractions and runs of punctuation."""
    texts = [
        "a <|endoftext|> b", "x<|startoftext|>y <|endoftext|>", "<|ENDOFTEXT|> <|End", "İstanbul ΣΑΣ ǅ straße ÉTÉ e\u0301t\u0301", "don't can't'll 'tis foo's. bar'.",
        "wait... what?! (yes) [no] {a} a--b 3.14, 1,000; x_y", "日本語テキスト、ひらがな。 한국어", "\u200bzero\u00a0width \u2003em", "ŉ ǰ ẞ ſ ﬁ", "aı iI \u0130i",
        "word," * 50 + " word. word; WORD! wörd?", "", " \t\n", "\x00 \x1f a\x07b",
    ]
    encode = packing.word_encoder(PATH, 1)
    for text, got in zip(texts, encode(texts), strict=True):
        assert got == ids_of(text).tobytes(), text
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    pieces = packing.pack(docs, PATH).toPandas()
    assert {r.doc_id: r.doc_tokens for r in pieces.itertuples()} == {i: len(ids_of(t)) for i, t in enumerate(texts)}
    assert 49407 in ids_of(texts[0]) and 49406 in ids_of(texts[1])


def test_small_caches_change_nothing(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_ENTRIES", 5)
    texts = ["one two, three four. five six seven", "two three eight nine ten, one"] * 3
    encode = packing._WordEncoder(PATH, 1)
    for at in range(0, 6, 2):
        assert encode(texts[at:at + 2]) == [ids_of(t).tobytes() for t in texts[at:at + 2]]
