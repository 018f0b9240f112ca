import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.data import docs, edge_rows, prose
from tripspark.llm import packing

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))

ODD = [
    "<|endoftext|> inside<|startoftext|>text",
    "it's THEY'RE é ä İstanbul ΟΔΟΣ. ΟΔΟΣ",
    "tab\tnew\r\nline\x0bvt\x1cfs nbsp ls　wide  double",
    "123 4,5.6 ... !!! #$% \U0001f600 漢字 ﬁ",
    "'s 't don 't ' s",
    "\x00 control \x7f",
    "one. two, three.; (four) five... SIX, Seven.",
]


def ids_of(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 2]


def check(df, rows, sequence=4096, shard=256):
    pieces = packing.packed(df, sequence=sequence, shard_sequences=shard).collect()
    wanted = defaultdict(list)
    for doc, text in rows:
        wanted[doc].append(ids_of(text))
    sequences = defaultdict(list)
    covered = defaultdict(int)
    for p in pieces:
        assert p["length"] > 0
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
        crcs = [
            zlib.crc32(np.array(ids[p["start"] : p["start"] + p["length"]], "<u4").tobytes())
            for ids in wanted[p["doc_id"]]
            if len(ids) == p["doc_tokens"]
        ]
        assert p["ids_crc32"] in crcs
        covered[p["doc_id"]] += p["length"]
    assert covered == {d: sum(map(len, ids)) for d, ids in wanted.items()}
    for spans in sequences.values():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at
            at += n
        assert at <= sequence and at & (at - 1) == 0  # exactly a power of two: no padding
    return pieces


def test_edges(spark):
    rows = edge_rows() + list(enumerate(ODD, 100))
    check(docs(spark, rows, extra=True), rows)


@pytest.mark.parametrize(("sequence", "shard"), [(64, 4), (128, 1), (4096, 2)])
def test_shards(spark, sequence, shard):
    rng = random.Random(1)
    rows = [(i, " ".join(prose(rng, rng.randrange(1, 120)))) for i in range(200)]
    check(docs(spark, rows).coalesce(2), rows, sequence, shard)


def test_words_equal_the_tokenizer(sf_dir, spark):
    texts = [r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()] + ODD
    words = packing.Words(packing.default_tokenizer())
    assert words.simple
    for _ in range(2):  # once learning, once from memory
        for text in texts:
            want = TOKENIZER.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(words.encode(text), "<u4").tolist() == want


def test_random_words_equal_the_tokenizer():
    rng = random.Random(3)
    alphabet = "aBzÉßüİΣσς.,'’-é́ 漢ﬁ1²½#_<|endoftxs>\u200d\x1f\x85\xa0\u3000\U0001f600"
    words = packing.Words(packing.default_tokenizer())
    for _ in range(20_000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 9)))
        want = TOKENIZER.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(words.encode(text), "<u4").tolist() == want, repr(text)


def test_full_memory_changes_nothing(monkeypatch):
    monkeypatch.setattr(packing, "CACHED_WORDS", 3)
    words = packing.Words(packing.default_tokenizer())
    for text in ODD:
        assert np.frombuffer(words.encode(text), "<u4").tolist() == ids_of(text)[:-1]
    assert len(words) <= 3


def test_costs_are_balanced():
    rng = random.Random(2)
    lengths = [rng.randrange(1, 300) for _ in range(400)]
    cost = defaultdict(float)
    size = defaultdict(int)
    for _, _, n, number, _ in packing.pack(lengths, 1024):
        cost[number] += packing.LINEAR * n + packing.QUADRATIC * n * n
        size[number] += n
    full = [cost[s] for s in size if size[s] == 1024]
    assert max(full) < 1.1 * min(full)


def test_descending_and_few_cuts():
    pieces = packing.pack([10, 4000, 5000, 86, 904], 4096)
    assert (2, 0, 4096, 0, 0) in pieces
    assert sum(1 for p in pieces if p[0] == 1) == 1  # the longest rest stays whole


def test_with_ids(spark):
    df = packing.packed(docs(spark, [(1, "some words here")]), with_ids=True)
    row = b"".join(bytes(r["ids"]) for r in sorted(df.collect(), key=lambda r: r["start"]))
    assert np.frombuffer(row, "<u4").tolist() == ids_of("some words here")


def test_empty(spark):
    assert packing.packed(docs(spark, [])).collect() == []
