import binascii
import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from daytally.llm import packing, queries

PATH = public_tokenizers.path("word_bpe_49k.json")
PIECES = [
    "a", "Words", "The", " ", "  ", "\n", "\t", "'s", "'", "<|endoftext|>", "0", "é", "é", "̈", "汉", "😀", "\x1c",
    "\x85", "\x00", "!!", "...", "İ", "Σ", "T\u0308", "W\u030a", "<|STARTOFTEXT|>", "Word,", "word***", "don't.", "x<|", "A.B", "ΑΣ", "\r\n", " ", "�",
]


def test_same_ids_as_the_library():
    library, ours = Tokenizer.from_file(PATH), packing.UnitTokenizer(PATH)
    pick = random.Random(3)
    texts = ["".join(pick.choice(PIECES) for _ in range(pick.randint(0, 30))) for _ in range(1500)]
    texts += ["".join(chr(pick.choice([pick.randint(0, 0x370), pick.randint(0x900, 0x2FFF)])) + pick.choice(["", " "]) for _ in range(9)) for _ in range(500)]
    texts += ["", "x" * 3000, "word " * 9000]
    for text, ids in zip(texts, ours.encode(texts), strict=True):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_words_of_letters_are_encoded_together():
    library, ours = Tokenizer.from_file(PATH), packing.UnitTokenizer(PATH)
    pick = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyzABCÉéñöÖßçèàªºµÿŒſ"
    words = ["".join(pick.choices(letters, k=pick.randint(1, 14))) + pick.choice(["", "", ".", ",***", "'s", "'", "<|"]) for _ in range(6000)]
    texts = [" ".join(pick.choices(words, k=40)) for _ in range(300)]
    for text, ids in zip(texts, ours.encode(texts), strict=True):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_rows_without_doc_id_are_spread(spark):
    docs = spark.range(3000).selectExpr("cast(null as long) as doc_id", "repeat(concat('same words ', id % 3, ' '), 1000) as text")
    packs = packing.tokenized(docs, PATH, 2).groupBy("pack").count().collect()
    assert len(packs) > 4 and max(row["count"] for row in packs) < 1500


def check(pieces, wanted):
    """Every id once, sequences gapless and within bounds; returns the share of padding."""
    documents, sequences = defaultdict(list), defaultdict(list)
    for row in pieces:
        documents[row["key"]].append((row["start"], row["length"], row["ids"]))
        sequences[row["sequence_id"]].append((row["offset"], row["length"]))
        assert row["length"] > 0 and row["doc_tokens"] == len(wanted[row["key"]])
    for key, ids in wanted.items():
        own = sorted(documents.pop(key))
        assert [s for s, _, _ in own] == np.cumsum([0] + [n for _, n, _ in own])[:-1].tolist()
        assert [i for _, _, part in own for i in part] == ids
    assert not documents
    used = padded = 0
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == np.cumsum([0] + [n for _, n in parts])[:-1].tolist()
        total = sum(n for _, n in parts)
        assert total <= packing.SEQUENCE
        used += total
        padded += 0 if total & (total - 1) == 0 else packing.SEQUENCE - total
    return padded / (used + padded)


@pytest.mark.parametrize("lengths", [[1], [4096], [4097], [9000, 1, 1], [3000] * 50, [1] * 500, [4095, 2, 4095, 2], list(range(1, 4000, 7))])
def test_layout(lengths):
    lengths = np.array(lengths)
    wanted = {i: list(range(n)) for i, n in enumerate(lengths)}
    pieces = [
        {"key": d, "start": s, "length": n, "ids": list(range(s, s + n)), "doc_tokens": int(lengths[d]), "sequence_id": q, "offset": o}
        for d, s, n, q, o in packing.lay_out(lengths)
    ]
    check(pieces, wanted)
    assert len({p["sequence_id"] for p in pieces}) == -(-int(lengths.sum()) // packing.SEQUENCE) or lengths.max() > packing.SEQUENCE


def test_costs_are_balanced():
    lengths = np.random.default_rng(1).integers(1, 1500, 2000)
    costs = defaultdict(float)
    for _, _, n, q, _ in packing.lay_out(lengths):
        costs[q] += packing.cost(n)
    assert max(costs.values()) < 1.1 * min(costs.values())


def test_query_packs_every_id_once(spark):
    folder = "/root/testdata/sf0.01"
    library = Tokenizer.from_file(PATH)
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    wanted = {r.doc_id: [*library.encode(r.text or "", add_special_tokens=False).ids, 2] for r in docs}
    rows = [r.asDict() for r in queries.op2_packing(spark, folder).collect()]
    for row in rows:
        part = wanted[row["doc_id"]][row["start"] : row["start"] + row["length"]]
        assert row["ids_crc32"] == binascii.crc32(np.array(part, "<u4").tobytes())
        row |= {"key": row["doc_id"], "ids": part}
    assert check(rows, wanted) < 0.01


def test_odd_rows(spark):
    big = (1 << 60) + 1
    rows = [(big, None, 1), (2, "", 2), (3, "word " * 20_000, 3), (3, "word " * 20_000, 3), (None, "x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, pack int")
    found = packing.packed(docs, PATH, 2).collect()
    total = sum(r.length for r in found)
    assert total == 1 + 1 + 2 * 20_001 + 2
    assert {r.doc_id for r in found} == {big, 2, 3, None}
    assert packing.packed(docs.limit(0), PATH, 2).count() == 0
