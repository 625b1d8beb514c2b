import random

import pytest
import public_tokenizers
from tokenizers import Tokenizer

from daytally.llm import queries, speculative_bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
PIECES = [
    "a", "aa", "the", " ", "  ", "\n", "\t", "'s", "<|endoftext|>", "0", "12", "é", "汉", "😀", "\x1c", "\x85", "\x00",
    "!!", "...", "_", "²", "\r\n", "zzzz", " <|endoftext|>", "<|endof",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def odd_texts():
    pick = random.Random(3)
    texts = ["".join(pick.choice(PIECES) for _ in range(pick.randint(0, 40))) for _ in range(800)]
    texts += ["".join(chr(pick.choice([pick.randint(0, 0x2FF), pick.randint(0xE000, 0x2FFFF)])) for _ in range(9)) for _ in range(400)]
    return [*texts, "", " ", "a" * 5000, "ab" * 3000, " " * 777, "word " * 20_000]


def test_same_ids_and_text_as_the_library(library):
    bpe = speculative_bpe.ByteBPE(PATH)
    for text in odd_texts():
        ids, counts = bpe.encode([text])
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
        assert bpe.decode(ids, counts) == [library.decode(ids.tolist(), skip_special_tokens=False)] == [text]


def test_forgetting_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(speculative_bpe, "CACHE_UNITS", 10)
    bpe = speculative_bpe.ByteBPE(PATH)
    for text in odd_texts()[:200]:
        assert bpe.encode([text, text])[0].tolist() == 2 * library.encode(text, add_special_tokens=False).ids


def test_long_words_are_merged_as_short_ones():
    bpe = speculative_bpe.ByteBPE(PATH)
    pick = random.Random(4)
    for _ in range(200):
        word = bytes(pick.choice(b"abet ") for _ in range(speculative_bpe.SHORT))
        short = bpe.merged(word)
        tokens = [bpe.ids[word[i : i + 1]] for i in range(len(word))]
        assert bpe.merged_short(tokens) == short
        joined = bpe.merged(word + word)
        assert b"".join(bpe.token_bytes[t] for t in joined) == word + word


def test_operators_keep_every_row(spark):
    rows = [(1, "hello world", "x"), (2, None, "y"), (2, None, "y"), (None, "", None), (3, "é" * 9000, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    back = speculative_bpe.decoded(speculative_bpe.encoded(docs, PATH), PATH).collect()
    assert sorted(((r.doc_id, r.decoded) for r in back), key=repr) == sorted(((d, t or "") for d, t, _ in rows), key=repr)
    assert speculative_bpe.encoded(docs.limit(0), PATH).count() == 0


def test_query_against_the_library(spark, library):
    import hashlib

    import numpy as np

    folder = "/root/testdata/sf0.001"
    got = {row.doc_id: row for row in queries.op10_byte_bpe(spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert len(got) == len(docs)
    for row in docs:
        ids = library.encode(row.text or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert got[row.doc_id].n_tokens == len(ids)
        assert got[row.doc_id].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[row.doc_id].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
