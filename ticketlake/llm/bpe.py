"""Byte-level BPE, encoding and decoding, with a two-tier lookup of pre-tokens.

Tier one is a minimal perfect hash over the vocabulary: a pre-token that is a vocabulary entry takes
its id at once. Tier two merges the bytes of any other pre-token: a heap of ranked neighbour pairs
over a linked list, always the lowest rank, leftmost first. Each distinct stretch of text between
spaces is looked up once for a batch, and recent ones are remembered in bounded memory.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterable
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlake.llm import words as W

#: White space before a space: such a text is not cut at its spaces.
SPACE_BEFORE_SPACE = r"[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}] "

# Fixed value: the pattern that byte-level vocabularies commonly use.
COMMON_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

class PerfectHash:
    """Minimal perfect hash from byte strings to 0..n-1, by levels of collision-free slots.

    At each level, keys that share a slot with no other key are placed; the others go on to the next
    level. A key's number is the count of filled slots before its own. A key that is not in the set
    gets some number, so `find` compares the key that is stored there.
    """

    def __init__(self, keys: Iterable[bytes], spread: float = 1.6):
        rest = list(keys)
        self.keys: list[bytes] = []
        self.levels: list[list[int]] = []
        while rest:
            level = len(self.levels)
            size = max(2, int(len(rest) * spread)) | 1
            at = np.array([xxhash.xxh3_64_intdigest(k, level) % size for k in rest])
            used = np.bincount(at, minlength=size)
            number = np.where(used == 1, np.cumsum(used == 1) - 1 + len(self.keys), -1)
            alone = used[at] == 1
            placed = sorted((int(number[a]), k) for a, k, one in zip(at, rest, alone) if one)
            self.keys.extend(k for _, k in placed)
            self.levels.append(number.tolist())
            rest = [k for k, one in zip(rest, alone) if not one]

    def find(self, key: bytes) -> int:
        """The key's number, -1 for a key that is not in the set."""
        for level, numbers in enumerate(self.levels):
            number = numbers[xxhash.xxh3_64_intdigest(key, level) % len(numbers)]
            if number >= 0:
                return number if self.keys[number] == key else -1
        return -1


class Codec:
    """Encoder and decoder of one rank file, whose lines are base64 tokens and ids."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x.strip())}
        self.hash = PerfectHash(self.ranks)
        self.ids = [self.ranks[k] for k in self.hash.keys]
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.find_all = regex.compile(pattern).findall
        self.find_iter = regex.compile(pattern).finditer
        self.common = pattern == COMMON_PATTERN
        self.memo = W.IdLists(self.stretch)
        self.pieces = W.IdLists(lambda piece: self.pre_token(piece.encode()))

    def pre_token(self, piece: bytes) -> list[int]:
        number = self.hash.find(piece)
        return [self.ids[number]] if number >= 0 else self.merged(piece)

    def merged(self, piece: bytes) -> list[int]:
        """Ids after merging byte pairs, lowest rank first, the leftmost of equal ranks first."""
        n, rank_of = len(piece), self.ranks.get
        after, before, ends = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(rank, i, i + 2) for i in range(n - 1) if (rank := rank_of(piece[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, end = heapq.heappop(heap)
            j = after[i]
            if j >= n or ends[j] != end or ends[i] != j:
                continue  # one of the two has been merged meanwhile
            k = after[j]
            ends[i], ends[j], after[i] = end, -1, k
            if k < n:
                before[k] = i
                if (rank := rank_of(piece[i:ends[k]])) is not None:
                    heapq.heappush(heap, (rank, i, ends[k]))
            h = before[i]
            if h >= 0 and (rank := rank_of(piece[h:end])) is not None:
                heapq.heappush(heap, (rank, h, end))
        ranks = self.ranks
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i:ends[i]]])
            i = after[i]
        return out

    def stretch(self, text: str) -> list[int]:
        """Ids of a stretch of text, pre-token by pre-token."""
        ids: list[int] = []
        for piece in self.find_all(text):
            ids.extend(self.pre_token(piece.encode()))
        return ids

    def whole(self, text: str) -> np.ndarray:
        """Ids of a text that is not cut at its spaces."""
        parts = [np.zeros(0, np.uint32)]
        found = self.find_iter(text)
        while pieces := [m.group() for m in islice(found, 100_000)]:
            ids, starts, lengths = self.memo.find(pieces)
            parts.append(ids[W.take_lists(starts, lengths, np.arange(len(pieces)))])
        return np.concatenate(parts)

    def stretches(self, vocab: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct stretches, and where the ids of each start and how many they are."""
        plain = pc.and_(pc.match_substring_regex(vocab, W.PLAIN_WORD), self.common)
        found = W.letter_parts(vocab.filter(plain), single_digits=False)
        part_ids, part_at, part_n = self.pieces.find(found.vocab.to_pylist())
        rest_ids, rest_at, rest_n = self.memo.find(vocab.filter(pc.invert(plain)).to_pylist())
        ids = np.concatenate([part_ids[W.take_lists(part_at, part_n, found.codes)], rest_ids])
        sizes = W.per_text(part_n[found.codes], found.offsets)
        plain = plain.to_numpy(zero_copy_only=False)
        starts, lengths = np.zeros(len(vocab), np.int64), np.zeros(len(vocab), np.int64)
        starts[plain], lengths[plain] = np.cumsum(sizes) - sizes, sizes
        starts[~plain], lengths[~plain] = rest_at + sizes.sum(), rest_n
        return ids, starts, lengths

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and where each text's ids start (and the end).

        A pre-token holds a space only as its first character or within white space. So a text can be
        cut before each space that follows something else, and the distinct stretches are encoded once.
        """
        plain = pc.invert(pc.match_substring_regex(texts, SPACE_BEFORE_SPACE)).to_numpy(zero_copy_only=False)
        offsets, values = W.listed(pc.split_pattern(texts.filter(pa.array(plain)), " "))
        first = np.zeros(len(values), dtype=bool)
        first[offsets[:-1]] = True
        spaced = pc.if_else(pa.array(first), values, pc.binary_join_element_wise(
            pa.scalar(" ", values.type), values, pa.scalar("", values.type)))
        found = W.coded(offsets, spaced)
        ids, starts, lengths = self.stretches(found.vocab)
        ids = ids[W.take_lists(starts, lengths, found.codes)]
        sizes = np.zeros(len(texts), dtype=np.int64)
        sizes[plain] = W.per_text(lengths[found.codes], found.offsets)
        if plain.all():
            return ids, np.concatenate([[0], np.cumsum(sizes)])
        ends = np.concatenate([[0], np.cumsum(sizes)])
        rest = {i: self.whole(texts[i].as_py()) for i in np.flatnonzero(~plain).tolist()}
        parts = [rest[i] if i in rest else ids[ends[i]:ends[i + 1]] for i in range(len(texts))]
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(x) for x in parts])])

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """The codec of a rank file, built once in each Python worker."""
    return Codec(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", out: str = "ids") -> DataFrame:
    """`docs` with the array column `out`: the ids of each whole text, without special tokens.

    `path` names a rank file that every worker can open, `pattern` what splits text into pre-tokens.
    A null or empty text has no ids. Row-local; repeated rows stay, a column `out` is replaced.
    """
    @F.arrow_udf("array<int>")
    def ids_of(texts: pa.Array) -> pa.Array:
        parts = []
        for chunk in W.text_chunks(texts):
            ids, offsets = codec(path, pattern).encode(chunk)
            parts.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32())))
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))

    return docs.withColumn(out, ids_of(F.col(text)))


def decode(docs: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """`docs` with the binary column `out`: the bytes that the ids stand for; null ids give none.

    An id that the vocabulary lacks is an error.
    """
    @F.arrow_udf("binary")
    def bytes_of(lists: pa.Array) -> pa.Array:
        own = codec(path, pattern)
        offsets, values = W.listed(lists)
        flat = values.to_numpy(zero_copy_only=False)
        return pa.array([own.decode(flat[a:b].tolist()) for a, b in zip(offsets[:-1], offsets[1:])], pa.binary())

    return docs.withColumn(out, bytes_of(F.coalesce(F.col(ids), F.array().cast("array<int>"))))
