"""Cost-balanced packing of tokenised documents into training sequences.

Method. A piece of n tokens costs n * LINEAR + n * n * QUADRATIC, the two parts of a
transformer's work on it with attention inside the document. Documents are taken in descending
length; each goes to the sequence of the lowest cost so far that still has room for it. A document
that fits nowhere whole is cut: the emptiest sequence takes what fits, the rest waits its turn.
Documents over the sequence length first give full sequences of their own.

Packing is done per shard of about SHARD_SEQUENCES sequences, while a task streams over its
input, so text and tokens are never shuffled and memory is bounded by a shard and a document.
A shard's room is exactly its tokens: full sequences, and for the remainder one sequence for each
binary digit. Lengths that are a power of two need no padding, so nothing is padded.

`sequence_id` is the number of the input partition and a running number in it. A partition of
files is the same on every attempt, so a task that is run again gives the same pieces. Give it
files (or a written table), not the result of a shuffle.

Defined cases: a NULL or empty text is the end token alone. Every row is a document by itself,
whether or not its doc_id is NULL or repeats. Extra columns are ignored.
"""

from __future__ import annotations

import heapq
import os
import string
import unicodedata
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.functions import col

from tripspark.llm.common import rows, sliced

SEQUENCE = 4096
SHARD_SEQUENCES = 256
END = 2
LINEAR = 1.0
QUADRATIC = 1.0 / 2048
CACHED_WORDS = 600_000  # per worker; words beyond it are encoded whenever they come


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# Marks that a word may end in, all of ASCII but the apostrophe, which may begin a word of its own.
MARKS = "".join(sorted(set(string.punctuation) - {"'"}))


class Letters(dict):
    """What the tokenizer's normalizer and pre-tokenizer make of a letter, or None if that is not
    one piece."""

    def __init__(self, pieces: Callable[[str], list[str]]):
        super().__init__()
        self.pieces = pieces

    def __missing__(self, letter: str) -> str | None:
        found = self.pieces(letter)
        self[letter] = found[0] if len(found) == 1 else None
        return self[letter]


class Words(dict):
    """The ids of words as little-endian bytes, remembered up to CACHED_WORDS of them.

    Only for tokenizers that never join ids across blanks and line feeds, as those that split
    at white space and drop it. An unknown word goes through the tokenizer's own normalizer,
    pre-tokenizer and model one after the other, which spares the offsets a full encoding
    makes. For a tokenizer that is seen to take letters one by one and to part them from marks, a
    word of letters goes to the model directly and the marks after it are looked up apart.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__({"": b""})
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.letters = Letters(self._pieces)
        probe = string.ascii_letters + "éßñÜ"
        parts = [[probe[0], m] for m in (MARKS, *MARKS)]
        self.simple = self._pieces(probe) == [
            "".join(self.letters[c] or "" for c in probe)
        ] and parts == [self._pieces(probe[0] + m) for _, m in parts]

    def _pieces(self, text: str) -> list[str]:
        normal, split = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        text = normal.normalize_str(text) if normal else text
        return [p for p, _ in split.pre_tokenize_str(text)] if split else [text]

    def __missing__(self, word: str) -> bytes:
        ids = self._ids(word)
        if len(self) < CACHED_WORDS:
            self[word] = ids
        return ids

    def _ids(self, word: str) -> bytes:
        pieces = None
        if self.simple:
            if word.isalpha():
                if word.isascii() or unicodedata.is_normalized("NFC", word):
                    letters = list(map(self.letters.__getitem__, word))
                    pieces = None if None in letters else ["".join(letters)]
            elif (stem := word.rstrip(MARKS)) != word and stem.isalpha():
                if self.letters[stem[-1]]:  # else its last piece is not letters only
                    return (self.get(stem) or self._ids(stem)) + self[word[len(stem) :]]
        if pieces is None:
            if any(s in word for s in self.specials):
                found = self.tokenizer.encode(word, add_special_tokens=False).ids
                return array("I", found).tobytes()
            pieces = self._pieces(word)
        return array("I", [t.id for p in pieces for t in self.model.tokenize(p)]).tobytes()

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


_encoders: dict[str, Words] = {}


def encoder(path: str) -> Words:
    """One encoder per worker process and tokenizer."""
    if path not in _encoders:
        _encoders[path] = Words(path)
    return _encoders[path]


def capacities(tokens: int, sequence: int = SEQUENCE) -> list[int]:
    """Sequence lengths that hold exactly so many tokens without padding."""
    full, rest = divmod(tokens, sequence)
    return [sequence] * full + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]


def pack(lengths: list[int], sequence: int = SEQUENCE) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence number, offset) of documents of these lengths."""
    pieces, waiting, number = [], [], 0
    for doc, n in enumerate(lengths):
        for start in range(0, n - sequence + 1, sequence):
            pieces.append((doc, start, sequence, number, 0))
            number += 1
        if rest := n % sequence:
            waiting.append((-rest, doc, n - rest))
    size = capacities(-sum(w[0] for w in waiting), sequence)
    room = np.array(size, np.int64)
    cost = np.zeros(len(size))
    heapq.heapify(waiting)
    while waiting:
        length, doc, start = heapq.heappop(waiting)
        length = -length
        fits = np.flatnonzero(room >= length)
        if fits.size:
            to, taken = int(fits[np.argmin(cost[fits])]), length
        else:
            to = int(np.argmax(room))
            taken = int(room[to])
            heapq.heappush(waiting, (taken - length, doc, start + taken))
        pieces.append((doc, start, taken, number + to, size[to] - int(room[to])))
        room[to] -= taken
        cost[to] += LINEAR * taken + QUADRATIC * taken * taken
    return pieces


_PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
        ("ids", pa.binary()),
    ]
)
_DDL = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)


def packed(
    docs: DataFrame,
    tokenizer: str | None = None,
    sequence: int = SEQUENCE,
    shard_sequences: int = SHARD_SEQUENCES,
    end: int = END,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, start (the document's ids before it), length, ids_crc32 (of its
    little-endian 32-bit ids), doc_tokens, sequence_id, offset, and on request the ids."""
    path = tokenizer or default_tokenizer()
    schema = _PIECES if with_ids else pa.schema(list(_PIECES)[:-1])
    last = array("I", [end]).tobytes()

    def shard(docs: list[tuple[int | None, bytes]], first: int) -> tuple[pa.RecordBatch, int]:
        out, used = [], first
        for doc, start, n, number, offset in pack([len(d[1]) // 4 for d in docs], sequence):
            doc_id, data = docs[doc]
            ids = data[4 * start : 4 * (start + n)]
            crc = zlib.crc32(ids)
            out.append((doc_id, start, n, crc, len(data) // 4, first + number, offset, ids))
            used = max(used, first + number + 1)
        return rows(schema, list(zip(*out, strict=True))[: len(schema)]), used

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(path)
        number = TaskContext.get().partitionId() << 40
        waiting, size = [], 0
        for batch in sliced(batches, "text"):
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = words.encode(text or "")
                waiting.append((doc_id, ids + last))
                size += len(ids) // 4 + 1
                if size >= shard_sequences * sequence:
                    made, number = shard(waiting, number)
                    yield made
                    waiting, size = [], 0
        if waiting:
            yield shard(waiting, number)[0]

    slim = docs.select(col("doc_id").cast("long").alias("doc_id"), "text")
    return slim.mapInArrow(run, _DDL + (", ids binary" if with_ids else ""))
