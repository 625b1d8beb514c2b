"""Cost-balanced packing of tokenised documents into sequences of a fixed length.

Training cost of a document of n tokens is estimated as LINEAR * n + QUADRATIC * n * n (its
attention stays inside it). Documents are dealt by a hash of doc_id and text into packs of about PACK_BYTES
of text. In a pack, whole blocks of a long document are sequences of their own; all other documents
go, in descending order of cost, to the sequence of lowest cost that has room for them. A pack opens
just as many sequences as its tokens need, so a document that fits nowhere whole is cut over the
cheapest sequences with room, and a pack is padded by less than one sequence.

Packs are independent: no task sees more than one pack at a time, whatever the number of documents.
Each id moves once, with its document, to the pack that lays it out.

Defined cases: a null text counts as empty and is its end token alone; repeated rows are packed
each; a document without doc_id goes to a pack by its row; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import functools
import os
import re
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daytally.llm.common import NO_ID, blocks, gather, ids_back, partitions_for, python_docs, text_bytes

#: Tokens of a sequence.
SEQUENCE = 4096
#: Text bytes of one pack: some hundred sequences, so that what is left of the last one is little.
PACK_BYTES = 6_000_000
#: Relative cost of a token itself and of a pair of tokens; attention weighs as much as the rest at 1/QUADRATIC tokens.
LINEAR, QUADRATIC = 1.0, 1.0 / 8192
#: Units that a worker remembers before it starts anew, and the longest one worth remembering.
CACHE_UNITS, LONGEST_KEPT = 700_000, 256
#: Words of letters that are given to the library together.
TOGETHER = 256
#: Marks that some lower-case but no upper-case ASCII letter composes with, and the start of a special token.
UPPER_MATTERS = re.compile("[\u0300-\u036f]|<\\|")
#: Punctuation that may be told from the word before it.
TRAILING = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: Sequence numbers of a pack start at the pack's number times this.
PACK_STRIDE = 1 << 32

PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, sequence_cost double"


def plain_letters(piece: str) -> bool:
    """Letters of Latin-1 alone: no mark, no composition, the same letters in every Unicode version."""
    return piece.isalpha() and (piece.isascii() or max(piece) <= "\xff")


class UnitTokenizer:
    """A library tokenizer that drops white space and case, applied once to each distinct piece.

    Its splits never reach over white space and its normaliser composes nothing with it, so the ids
    of a text are those of the pieces between spaces and line ends. Nor do they reach from letters
    into punctuation, so a word with punctuation after it is two pieces. Pieces of plain letters are
    given to the library many at a time; the last token of each is one that closes a word.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        vocabulary = self.library.get_vocab()
        suffix = getattr(self.library.model, "end_of_word_suffix", None)
        self.closing = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        if suffix:
            self.closing[[number for token, number in vocabulary.items() if token.endswith(suffix)]] = True
        self.forget()

    def forget(self) -> None:
        self.codes: dict[str, int] = {}
        self.parts: dict[str, int] = {}
        self.part_flat, self.part_starts, self.part_counts = np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64)
        self.flat = np.empty(0, np.uint32)
        self.starts = np.empty(0, np.int64)
        self.counts = np.empty(0, np.int64)

    def plain(self, text: str) -> str:
        """The text with spaces for line ends, and A-Z lowered unless that could change more than case."""
        if not (UPPER_MATTERS.search(text) if not text.isascii() else "<|" in text):
            text = text.encode().lower().decode()
        return text.replace("\n", " ")

    def ids_of(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces in order, and each piece's number of them."""
        batch = self.library.encode_batch_fast(pieces, add_special_tokens=False)
        counts = np.fromiter(map(len, batch), np.int64, len(pieces))
        return np.fromiter(chain.from_iterable(x.ids for x in batch), np.uint32, counts.sum()), counts

    def ids_of_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words of plain letters."""
        together = [" ".join(words[i : i + TOGETHER]) for i in range(0, len(words), TOGETHER)]
        ids, _ = self.ids_of(together)
        ends = np.flatnonzero(self.closing[ids]) + 1
        return (ids, np.diff(ends, prepend=0)) if len(ends) == len(words) else self.ids_of(words)

    def learn(self, new: list[str]) -> None:
        """Ids of new parts, in the order of their numbers."""
        lettered = np.fromiter(map(plain_letters, new), bool, len(new))
        words, others = [x for x, y in zip(new, lettered, strict=True) if y], [x for x, y in zip(new, lettered, strict=True) if not y]
        (ids, counts), (other_ids, other_counts) = self.ids_of_words(words), self.ids_of(others)
        all_counts = np.concatenate([counts, other_counts])
        first = len(self.part_flat)
        places = np.empty(len(new), np.int64)
        places[np.concatenate([np.flatnonzero(lettered), np.flatnonzero(~lettered)])] = np.arange(len(new))
        self.part_flat = np.concatenate([self.part_flat, ids, other_ids])
        self.part_starts = np.concatenate([self.part_starts, (first + np.cumsum(all_counts) - all_counts)[places]])
        self.part_counts = np.concatenate([self.part_counts, all_counts[places]])

    def remember(self, units: list[str]) -> None:
        known, owned, numbers = self.parts, [], []
        before = len(known)
        for unit in units:
            stem = unit.rstrip(TRAILING)
            if len(stem) == len(unit) or not plain_letters(stem):
                numbers.append(known.setdefault(unit, len(known)))
                owned.append(1)
            else:
                numbers.append(known.setdefault(stem, len(known)))
                tail = unit[len(stem) :]
                numbers.append(known.setdefault(tail, len(known)))
                owned.append(2)
        self.learn(list(islice(known, before, None)))
        parts, ends = np.array(numbers, np.int64), np.cumsum(owned)
        part_counts = self.part_counts[parts]
        counts = np.add.reduceat(part_counts, ends - owned)
        first = len(self.flat)
        self.flat = np.concatenate([self.flat, gather(self.part_flat, self.part_starts[parts], part_counts)])
        self.starts = np.concatenate([self.starts, first + np.cumsum(counts) - counts])
        self.counts = np.concatenate([self.counts, counts])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.codes) > CACHE_UNITS:
            self.forget()
        codes, new, rows = self.codes, [], []
        for text in texts:
            units = self.plain(text).split(" ")
            try:
                row = np.fromiter(map(codes.__getitem__, units), np.int64, len(units))
            except KeyError:
                for unit in units:
                    if unit not in codes:
                        codes[unit] = len(codes)
                        new.append(unit)
                row = np.fromiter(map(codes.__getitem__, units), np.int64, len(units))
            rows.append(row)
        if new:
            self.remember(new)
        every = np.concatenate(rows) if rows else np.empty(0, np.int64)
        counts = self.counts[every]
        ids = gather(self.flat, self.starts[every], counts)
        ends = np.concatenate([[0], np.cumsum(counts)])[np.cumsum([len(row) for row in rows])]
        found = np.split(ids, ends[:-1]) if rows else []
        if any(len(unit) > LONGEST_KEPT for unit in new):
            self.forget()
        return found


@functools.lru_cache(maxsize=2)
def unit_tokenizer(path: str) -> UnitTokenizer:
    """One per worker process and file."""
    return UnitTokenizer(path)


def tokenized(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """doc_id, pack, ids (little-endian unsigned 32-bit, with the end token) of every whole text."""
    docs = python_docs(docs)
    packs = text_bytes(docs) // PACK_BYTES + 1
    # Rows without doc_id, or that share one, go to packs by text, and equal texts without one by their row.
    missing = F.when(F.col("doc_id") == NO_ID, F.monotonically_increasing_id())
    dealt = docs.withColumn("pack", F.pmod(F.xxhash64("doc_id", "text", missing), F.lit(packs)))

    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer = unit_tokenizer(path)
        end = np.array([end_id], "<u4").tobytes()
        for frame in blocks(frames):
            ids = [x.astype("<u4", copy=False).tobytes() + end for x in tokenizer.encode(frame["text"].tolist())]
            yield pd.DataFrame({"doc_id": frame["doc_id"], "pack": frame["pack"], "ids": ids})

    spread = partitions_for(docs.sparkSession, min(packs, 100_000))
    return dealt.mapInPandas(encode, "doc_id long, pack long, ids binary").repartition(spread, "pack")


def cost(tokens: np.ndarray | int) -> np.ndarray | float:
    return LINEAR * tokens + QUADRATIC * tokens * tokens


def lay_out(lengths: np.ndarray, size: int = SEQUENCE) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of documents with these numbers of tokens."""
    whole = lengths // size
    pieces, sequence = [], 0
    for document in np.flatnonzero(whole).tolist():
        for block in range(int(whole[document])):
            pieces.append((document, block * size, size, sequence, 0))
            sequence += 1
    rest = lengths - whole * size
    opened = -(-int(rest.sum()) // size)
    costs, room = np.zeros(opened), np.full(opened, size, np.int64)
    order = np.argsort(-rest, kind="stable")
    for document in order[: np.count_nonzero(rest)].tolist():
        start, left = int(whole[document]) * size, int(rest[document])
        while left:
            fits = room >= left
            if not fits.any():
                fits = room > 0
            at = int(np.argmin(np.where(fits, costs, np.inf)))
            taken = min(left, int(room[at]))
            pieces.append((document, start, taken, sequence + at, size - int(room[at])))
            room[at] -= taken
            costs[at] += cost(taken)
            start, left = start + taken, left - taken
    return pieces


def pack_group(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values(["doc_id", "ids"], ignore_index=True)
    ids = [np.frombuffer(x, "<u4") for x in frame["ids"]]
    lengths = np.array([len(x) for x in ids], np.int64)
    pieces = lay_out(lengths)
    document, start, length, sequence, offset = (np.array(x, np.int64) for x in zip(*pieces, strict=True))
    total = np.bincount(sequence, cost(length))
    return pd.DataFrame(
        {
            "doc_id": frame["doc_id"].to_numpy()[document],
            "start": start,
            "length": length,
            "ids": [ids[d][s : s + n].tobytes() for d, s, n in zip(document, start, length, strict=True)],
            "doc_tokens": lengths[document],
            "sequence_id": int(frame["pack"].iloc[0]) * PACK_STRIDE + sequence,
            "offset": offset,
            "sequence_cost": total[sequence],
        }
    )


def packed(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """Every piece of every document with its ids and its place: columns of PIECES."""
    return ids_back(tokenized(docs, path, end_id).groupBy("pack").applyInPandas(pack_group, PIECES))
