"""Cost-balanced packing of token sequences.

Attention over a piece of n tokens costs ``linear * n + quadratic * n**2``.
Pieces are taken longest first, and each goes to the sequence with the lowest
cost so far that still has room for it. Documents longer than a sequence give
full sequences of their own; what remains of them is packed like any other piece.

The work is one pass over the partitions of the input, without a shuffle: a task
gathers pieces until they hold ``window_tokens`` tokens, packs as many full
sequences as these make, and carries the rest to the next window. A piece that
fits nowhere whole is cut at the end of the sequence it goes to, so sequences
are full. The tokens left when a partition ends make sequences whose lengths are
powers of two, which need no padding. Memory is bounded by a window and by the
longest text; a lost task is done again with the same result.

A text that holds the name of one of the tokenizer's own tokens is encoded whole, as the
tokenizer reads it; the ids of all others are put together from those of their words.

Rows: NULL text counts as empty and gives the end token only; rows with the same
id are packed as separate documents; an empty table gives no rows.
"""

from __future__ import annotations

import itertools
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

CAPACITY = 2048
END_ID = 1
WINDOW_TOKENS = 4_000_000
LINEAR, QUADRATIC = 1.0, 1.0 / CAPACITY
#: Texts turned into Python strings at a time.
SLICE = 256
#: Entries of the word cache of a Python worker, and their bytes; a full cache is emptied.
CACHE_ENTRIES = 250_000
CACHE_BYTES = 16_000_000

SCHEMA = (
    "{id} {type}, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, sequence_tokens long"
)


def pack(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", *,
    capacity: int = CAPACITY, end_id: int = END_ID, window_tokens: int = WINDOW_TOKENS,
    linear: float = LINEAR, quadratic: float = QUADRATIC,
) -> DataFrame:
    """One row per piece: document, start and length within it, checksum of its
    ids, tokens of the document, sequence, offset there, tokens of the sequence.

    ``tokenizer`` is the path of a ``tokenizers`` file every executor has.
    ``sequence_id`` is the partition's number in the upper bits and a running
    number in the lower 33; it holds for one layout of the input.
    """
    if capacity < 1 or window_tokens < capacity:
        raise ValueError("a window holds at least one sequence")
    kind = docs.schema[id_col].dataType.simpleString()
    chosen = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(TaskContext.get().partitionId(), capacity, window_tokens, linear, quadratic)
        encode = word_encoder(tokenizer, end_id)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                ids = part.column(0).to_pylist()
                for doc_id, tokens in zip(ids, encode(part.column(1).to_pylist()), strict=True):
                    packer.add(doc_id, tokens)
                if packer.waiting >= window_tokens:
                    packer.close_window()
                yield from packer.rows(id_type, 20_000)
        packer.finish()
        yield from packer.rows(id_type, 0)
        pa.default_memory_pool().release_unused()

    schema = SCHEMA.format(id="__id", type=kind)
    id_type = to_arrow_type(chosen.schema["id"].dataType)
    return chosen.mapInArrow(run, schema).withColumnRenamed("__id", id_col)


class Packer:
    """Pieces of one partition on their way into sequences."""

    def __init__(self, partition: int, capacity: int, window_tokens: int, linear: float, quadratic: float):
        self.capacity = capacity
        self.linear, self.quadratic = linear, quadratic
        self.next_id = partition << 33
        self.pieces: list[tuple] = []  # (id, tokens of the document, start, bytes of the ids)
        self.waiting = 0
        self.out: list[tuple] = []

    def add(self, doc_id, tokens: bytes) -> None:
        total, full = len(tokens) // 4, len(tokens) // 4 // self.capacity * self.capacity
        for start in range(0, full, self.capacity):
            self.place(doc_id, total, start, tokens[4 * start:4 * (start + self.capacity)], self.next_id, 0, self.capacity)
            self.next_id += 1
        if total > full:
            self.pieces.append((doc_id, total, full, tokens[4 * full:]))
            self.waiting += total - full

    def place(self, doc_id, total: int, start: int, ids: bytes, sequence: int, offset: int, tokens: int) -> None:
        self.out.append((doc_id, start, len(ids) // 4, zlib.crc32(ids), total, sequence, offset, tokens))

    def close_window(self) -> None:
        """Pack as many full sequences as the waiting pieces make."""
        if count := self.waiting // self.capacity:
            self.fill(np.full(count, self.capacity, np.int64))

    def finish(self) -> None:
        """Pack everything; the last tokens go into sequences of power-of-two lengths."""
        self.close_window()
        rest = self.waiting
        sizes = [1 << bit for bit in reversed(range(rest.bit_length())) if rest >> bit & 1]
        if sizes:
            self.fill(np.array(sizes, np.int64))

    def fill(self, sizes: np.ndarray) -> None:
        room, cost, used = sizes.copy(), np.zeros(len(sizes)), np.zeros(len(sizes), np.int64)
        first, left, open_tokens = self.next_id, [], int(sizes.sum())
        self.next_id += len(sizes)
        for doc_id, total, start, ids in sorted(self.pieces, key=lambda piece: -len(piece[3])):
            while ids and open_tokens:
                fits = room >= len(ids) // 4
                at = int(np.argmin(np.where(fits if fits.any() else room > 0, cost, np.inf)))
                part = ids[:4 * int(room[at])]
                n = len(part) // 4
                self.place(doc_id, total, start, part, first + at, int(used[at]), int(sizes[at]))
                room[at] -= n
                used[at] += n
                open_tokens -= n
                cost[at] += self.linear * n + self.quadratic * n * n
                start, ids = start + n, ids[4 * n:]
            if ids:
                left.append((doc_id, total, start, ids))
        self.pieces = left
        self.waiting = sum(len(piece[3]) // 4 for piece in left)

    def rows(self, id_type: pa.DataType, least: int) -> Iterator[pa.RecordBatch]:
        if len(self.out) <= least:
            return
        columns = list(zip(*self.out, strict=True))
        self.out = []
        names = ["__id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_tokens"]
        arrays = [pa.array(columns[0], id_type), *(pa.array(c, pa.int64()) for c in columns[1:])]
        yield pa.RecordBatch.from_arrays(arrays, names)


_encoders: dict[tuple[str, int], object] = {}
# Punctuation behind a letter or digit is a token of its own.
_PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())
# Bytes as the letters that byte-level tokenizers show them as: themselves where they can
# be seen, else the next letters from 256 on.
_SEEN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_SHOWN = {b: b for b in _SEEN} | {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _SEEN)}
_PLAIN_ENDS = frozenset(b"abcdefghijklmnopqrstuvwxyz0123456789")


def word_encoder(path: str, end_id: int):
    """A function from texts to the bytes of their ids (little-endian, 4 each),
    ``end_id`` last. One per Python worker, since it remembers words.

    It is for tokenizers that drop white space and fold case: there the ids of a
    text are those of its words, one after the other.
    """
    key = (path, end_id)
    if key not in _encoders:
        _encoders[key] = _WordEncoder(path, end_id)
    return _encoders[key]


class _WordEncoder:
    def __init__(self, path: str, end_id: int):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # a text that may hold the name of one of the tokenizer's own tokens is encoded whole
        self.own = [token.content.lower().encode() for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = self.tokenizer.model
        # a word of plain letters needs no normalizing and no cutting, if the tokenizer reads bytes
        self.direct = all(self.letters(word) == self.ids(word) for word in ("the", "étranger", "straße", "žluťoučký"))
        self.end = int(end_id).to_bytes(4, "little")
        self.words: dict[bytes, bytes] = {}
        self.held = 0

    def __call__(self, texts: list[str]) -> list[bytes]:
        lowered = [text.encode().lower() for text in texts]  # ASCII case only
        whole = [any(name in text for name in self.own) for text in lowered]
        split = [[] if apart else text.split() for text, apart in zip(lowered, whole, strict=True)]  # ASCII white space only
        new = set(itertools.chain.from_iterable(split)).difference(self.words)
        if len(self.words) + len(new) > CACHE_ENTRIES or self.held > CACHE_BYTES:
            self.words, self.held = {}, 0
            new = set(itertools.chain.from_iterable(split))
        self.learn(new)
        known = self.words.__getitem__
        return [
            (self.ids(text) if apart else b"".join(map(known, found))) + self.end
            for text, apart, found in zip(texts, whole, split, strict=True)
        ]

    def ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def letters(self, text: str) -> bytes:
        """Ids of lower-case Latin letters, from the merges alone."""
        return array("I", [token.id for token in self.model.tokenize(text.encode().decode("latin-1").translate(_SHOWN))]).tobytes()

    def learn(self, new: set[bytes]) -> None:
        """Ids of new words; a word and what punctuation follows it are learned apart."""
        parts, joined = set(), []
        for word in new:
            stem = word.rstrip(_PUNCTUATION)
            if stem and len(stem) < len(word) and stem[-1] in _PLAIN_ENDS:
                joined.append((word, stem, word[len(stem):]))
            else:
                parts.add(word)
        parts.update(itertools.chain.from_iterable(both for _, *both in joined))
        self.encode(sorted(parts.difference(self.words)))
        for word, stem, rest in joined:
            self.words[word] = self.words[stem] + self.words[rest]
        self.held += sum(len(word) + len(self.words[word]) for word in new)

    def encode(self, parts: list[bytes]) -> None:
        rest = []
        for part in parts:
            text = part.decode()
            if self.direct and text.isalpha() and (text.isascii() or max(text) < "\u0250" and text == text.lower()):
                self.words[part] = self.letters(text)
            else:
                rest.append((part, text))
        found = self.tokenizer.encode_batch_fast([text for _, text in rest], add_special_tokens=False)
        for (part, _), own in zip(rest, found, strict=True):
            self.words[part] = array("I", own.ids).tobytes()
