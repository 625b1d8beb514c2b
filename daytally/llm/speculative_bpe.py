"""Byte-level BPE encoding by speculation, and decoding.

Words (the tokenizer's own pre-tokens) are encoded once per batch of new words: a greedy
longest match proposes tokens; one vectorised look-up tests every adjacent pair of all proposed
words for compatibility; only words with an incompatible pair are merged exactly. Two tokens are
compatible when merging their joined bytes gives just these two tokens back, and a sequence whose
tokens are sound and whose adjacent pairs are all compatible is the BPE encoding. Each pair is
merged once per worker and remembered.

Texts are split at single spaces into units, each a space with what follows it; pre-tokens never
reach over such a border, but for runs of white space, and texts with those take the pre-token
pattern as a whole. A document is a row of unit codes, and its ids are gathered with numpy. The
vocabulary file is read on each executor from the path given; memory is bounded by one block of
texts and by CACHE_UNITS remembered units.

Defined cases: null texts count as empty and have no ids; a special token's string in a text
becomes its id, as the tokenizer does; extra columns are dropped by the batch functions.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daytally.llm.common import NO_ID, blocks, gather, ids_back, python_docs

# The pre-token pattern of this tokenizer family, and the characters that stand for bytes.
PRETOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
SHOWN_BYTES = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]

#: A space inside a run of white space, where units would cut a pre-token.
RUN = re.compile(r"\s \s|\s \Z")
#: Units that a worker remembers before it starts anew, and the longest unit worth remembering.
CACHE_UNITS, LONGEST_KEPT = 400_000, 256
#: Up to so many bytes, the lowest pair is found by looking at all.
SHORT = 40
#: Pairs are looked up as first * PAIR_BASE + second.
PAIR_BASE = 1 << 20


def byte_letters() -> dict[str, int]:
    """The character that stands for each byte in the vocabulary file: shown ones for themselves, others from U+0100 on."""
    hidden = [b for b in range(256) if b not in set(SHOWN_BYTES)]
    return {chr(b): b for b in SHOWN_BYTES} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteBPE:
    """One vocabulary with what this worker has learnt about its tokens, pairs and words."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()
        as_bytes = lambda token: bytes(letters[c] for c in token)
        vocab = spec["model"]["vocab"]
        self.token_bytes: dict[int, bytes] = {i: as_bytes(t) for t, i in vocab.items()}
        self.ids = {b: i for i, b in self.token_bytes.items()}
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.merges = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(merges)}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.token_bytes |= {i: t.encode() for t, i in self.special.items()}
        self.special_pattern = regex.compile("|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True))) if self.special else None
        self.longest = max(map(len, self.ids))
        self.sound: dict[int, bool] = {}
        self.pairs: dict[int, bool] = {}
        self.known_pairs = np.empty(0, np.int64)
        self.good_pairs = np.empty(0, bool)
        size = max(self.token_bytes) + 1
        self.byte_counts = np.array([len(self.token_bytes.get(i, b"")) for i in range(size)], np.int64)
        self.byte_starts = np.cumsum(self.byte_counts) - self.byte_counts
        self.all_bytes = np.frombuffer(b"".join(self.token_bytes.get(i, b"") for i in range(size)), np.uint8)
        self.exact_merges = self.encoded_words = 0
        self.forget()

    def forget(self) -> None:
        self.codes: dict[str | int, int] = {}  # units after a space, without it; special tokens by id
        self.heads: dict[str, int] = {}  # what has no space before it
        self.word_ids: dict[str, list[int]] = {}
        self.flat = np.empty(0, np.uint32)
        self.starts = np.empty(0, np.int64)
        self.counts = np.empty(0, np.int64)

    def merged(self, word: bytes) -> list[int]:
        """Exact BPE: always the pair of lowest rank, the leftmost of equals; n log n in the word's length."""
        tokens: list[int] = [self.ids[word[i : i + 1]] for i in range(len(word))]
        if len(tokens) <= SHORT:
            return self.merged_short(tokens)
        after, before = list(range(1, len(tokens) + 1)), list(range(-1, len(tokens) - 1))
        queue = []
        for i in range(len(tokens) - 1):
            if found := self.merges.get((tokens[i], tokens[i + 1])):
                queue.append((found[0], i, tokens[i], tokens[i + 1]))
        heapq.heapify(queue)
        while queue:
            _, i, left, right = heapq.heappop(queue)
            j = after[i]
            if tokens[i] != left or j >= len(tokens) or tokens[j] != right:
                continue
            tokens[i], tokens[j] = self.merges[left, right][1], -1
            after[i] = after[j]
            if after[i] < len(tokens):
                before[after[i]] = i
                if found := self.merges.get((tokens[i], tokens[after[i]])):
                    heapq.heappush(queue, (found[0], i, tokens[i], tokens[after[i]]))
            if before[i] >= 0 and (found := self.merges.get((tokens[before[i]], tokens[i]))):
                heapq.heappush(queue, (found[0], before[i], tokens[before[i]], tokens[i]))
        return [t for t in tokens if t >= 0]

    def merged_short(self, tokens: list[int]) -> list[int]:
        get, none = self.merges.get, (PAIR_BASE, -1)
        found = [get(pair, none) for pair in zip(tokens[:-1], tokens[1:], strict=True)]
        while found:
            best = min(found)
            if best is none:
                break
            i = found.index(best)
            tokens[i : i + 2] = [best[1]]
            del found[i]
            if i < len(found):
                found[i] = get((tokens[i], tokens[i + 1]), none)
            if i:
                found[i - 1] = get((tokens[i - 1], tokens[i]), none)
        return tokens

    def is_sound(self, token: int) -> bool:
        """Whether merging the token's own bytes gives it back."""
        if token not in self.sound:
            self.sound[token] = self.merged(self.token_bytes[token]) == [token]
        return self.sound[token]

    def proposal(self, word: bytes) -> list[int]:
        """Greedy longest match over sound tokens."""
        ids, found, at, size = self.ids, [], 0, len(word)
        while at < size:
            for end in range(min(size, at + self.longest), at, -1):
                token = ids.get(word[at:end])
                if token is not None and (end == at + 1 or self.is_sound(token)):
                    break
            found.append(token)
            at = end
        return found

    def compatible(self, pairs: np.ndarray) -> np.ndarray:
        """For each pair code, whether the two tokens may stand side by side."""
        distinct, where = np.unique(pairs, return_inverse=True)
        unknown = distinct[~np.isin(distinct, self.known_pairs)]
        if len(unknown):
            good = []
            for pair in unknown.tolist():
                first, second = divmod(pair, PAIR_BASE)
                good.append(self.merged(self.token_bytes[first] + self.token_bytes[second]) == [first, second])
            known = np.concatenate([self.known_pairs, unknown])
            order = np.argsort(known)
            self.known_pairs, self.good_pairs = known[order], np.concatenate([self.good_pairs, np.array(good)])[order]
        return self.good_pairs[np.searchsorted(self.known_pairs, distinct)][where]

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        """Proposals for all words, one test over all adjacent pairs, exact merging for the words that fail."""
        found = [self.proposal(word) for word in words]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter((t for tokens in found for t in tokens), np.int64, counts.sum())
        owner = np.repeat(np.arange(len(found)), counts)
        inside = owner[1:] == owner[:-1]
        pairs = (flat[:-1] * PAIR_BASE + flat[1:])[inside]
        failed = np.unique(owner[1:][inside][~self.compatible(pairs)]) if len(pairs) else np.empty(0, np.int64)
        for i in failed.tolist():
            found[i] = self.merged(words[i])
        self.encoded_words += len(words)
        self.exact_merges += len(failed)
        return found

    def remember(self, units: list[str | int]) -> None:
        """Gives the units (or special ids) the next codes."""
        words = [[] if isinstance(unit, int) else PRETOKEN.findall(unit) for unit in units]
        new = list({word for found in words for word in found if word not in self.word_ids})
        self.word_ids.update(zip(new, self.encode_words([word.encode() for word in new]), strict=True))
        known = self.word_ids
        found = [[unit] if isinstance(unit, int) else [t for word in own for t in known[word]] for unit, own in zip(units, words, strict=True)]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        first = len(self.flat)
        self.flat = np.concatenate([self.flat, np.fromiter((t for x in found for t in x), np.uint32, counts.sum())])
        self.starts = np.concatenate([self.starts, first + np.cumsum(counts) - counts])
        self.counts = np.concatenate([self.counts, counts])

    def coded(self, text: str, new: list[str | int]) -> np.ndarray:
        """Codes of the text's units; those not seen before get one and are added to ``new``."""
        if not text:
            return np.empty(0, np.int64)
        if RUN.search(text):
            head, *rest = PRETOKEN.findall(text)
            parts, known = [head, *rest], self.heads
            for part in parts:
                if part not in known:
                    known[part] = len(self.codes) + len(self.heads)
                    new.append(part)
            return np.fromiter(map(known.__getitem__, parts), np.int64, len(parts))
        head, *rest = text.split(" ")
        codes = self.codes
        if head and head not in self.heads:
            self.heads[head] = len(codes) + len(self.heads)
            new.append(head)
        try:
            row = np.fromiter(map(codes.__getitem__, rest), np.int64, len(rest))
        except KeyError:
            for unit in rest:
                if unit not in codes:
                    codes[unit] = len(codes) + len(self.heads)
                    new.append(" " + unit)
            row = np.fromiter(map(codes.__getitem__, rest), np.int64, len(rest))
        return np.concatenate([[self.heads[head]], row]) if head else row

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after another, and how many each text has."""
        if len(self.codes) + len(self.heads) > CACHE_UNITS:
            self.forget()
        new: list[str | int] = []
        rows = []
        for text in texts:
            if not self.special_pattern or not self.special_pattern.search(text):
                rows.append(self.coded(text, new))
                continue
            parts, at = [], 0
            for match in self.special_pattern.finditer(text):
                token = self.special[match.group()]
                parts.append(self.coded(text[at : match.start()], new))
                if token not in self.codes:
                    self.codes[token] = len(self.codes) + len(self.heads)
                    new.append(token)
                parts.append([self.codes[token]])
                at = match.end()
            rows.append(np.concatenate([*parts, self.coded(text[at:], new)]).astype(np.int64))
        if new:
            self.remember(new)
        all_codes = np.concatenate(rows) if rows else np.empty(0, np.int64)
        counts = self.counts[all_codes]
        ids = gather(self.flat, self.starts[all_codes], counts)
        ends = np.concatenate([[0], np.cumsum(counts)])
        bounds = ends[np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)]
        if any(len(unit) > LONGEST_KEPT for unit in new if isinstance(unit, str)):
            self.forget()
        return ids, np.diff(bounds)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """The text of each row of ids; bytes that are no UTF-8 become replacement characters."""
        data = gather(self.all_bytes, self.byte_starts[ids], self.byte_counts[ids]).tobytes()
        ends = np.concatenate([[0], np.cumsum(self.byte_counts[ids])])[np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)].tolist()
        return [data[a:b].decode("utf-8", "replace") for a, b in zip(ends[:-1], ends[1:], strict=True)]


@functools.lru_cache(maxsize=2)
def tokenizer(path: str) -> ByteBPE:
    """One per worker process and file."""
    return ByteBPE(path)


def encode_batches(path: str):
    """Frames with doc_id and text -> frames with doc_id and ids (numpy uint32 rows)."""

    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = tokenizer(path)
        for frame in blocks(frames):
            ids, counts = bpe.encode(frame["text"].tolist())
            yield pd.DataFrame({"doc_id": frame["doc_id"], "ids": cut(ids, counts)})

    return encode


def decode_batches(path: str):
    """Frames with ids -> the same frames with a column ``decoded``."""

    def decode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = tokenizer(path)
        for frame in frames:
            rows = [np.asarray(row, np.int64) for row in frame["ids"]]
            flat = np.concatenate(rows) if rows else np.empty(0, np.int64)
            yield frame.assign(decoded=bpe.decode(flat, np.array([len(row) for row in rows], np.int64)))

    return decode


def cut(flat: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    return np.split(flat, np.cumsum(counts)[:-1]) if len(counts) else []


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids array<int> of every whole text."""
    return ids_back(python_docs(docs).mapInPandas(encode_batches(path), "doc_id long, ids array<int>"))


def decoded(ids: DataFrame, path: str) -> DataFrame:
    """doc_id, ids, decoded text."""
    ids = ids.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), "ids")
    return ids_back(ids.mapInPandas(decode_batches(path), "doc_id long, ids array<int>, decoded string"))
