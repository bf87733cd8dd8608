"""Words of whole text batches as Arrow and numpy arrays: each distinct word is worked on once."""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Results that are remembered between chunks, about.
MEMO_ENTRIES = 200_000
#: Bytes of text that are taken apart at a time, at least one document; bounds a worker's memory.
CHUNK_BYTES = 4 << 20
#: The same where every distinct word is taken apart into its n-grams.
NGRAM_CHUNK_BYTES = 1 << 20


@dataclass
class Words:
    """Words of some texts: text i has `codes[offsets[i]:offsets[i + 1]]`, indexes into `vocab`."""

    offsets: np.ndarray
    codes: np.ndarray
    vocab: pa.Array

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)


def text_chunks(texts: pa.Array, size: int = CHUNK_BYTES) -> Iterator[pa.Array]:
    """Consecutive slices of a text column of about `size` bytes; null becomes the empty text."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(texts):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + size, side="right")))
        yield texts.slice(start, stop - start)
        pa.default_memory_pool().release_unused()  # what the last chunk needed
        start = stop


def listed(parts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Offsets and values of a list array, from its slice only."""
    offsets = parts.offsets.to_numpy().astype(np.int64)
    return offsets - offsets[0], parts.values.slice(offsets[0], offsets[-1] - offsets[0])


def coded(offsets: np.ndarray, values: pa.Array, keep: np.ndarray | None = None) -> Words:
    """Dictionary codes of list values, without those where `keep` is false."""
    if keep is not None and not keep.all():
        values = values.filter(pa.array(keep))
        offsets = np.concatenate([[0], np.cumsum(keep)])[offsets]
    found = values.dictionary_encode()
    return Words(offsets, found.indices.to_numpy(zero_copy_only=False), found.dictionary)


def split_words(texts: pa.Array) -> Words:
    """Words between the characters \\x20 and \\x09 to \\x0D."""
    offsets, values = listed(pc.ascii_split_whitespace(texts))
    return coded(offsets, values, pc.binary_length(values).to_numpy(zero_copy_only=False) > 0)


def per_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of the values of each text along axis 0; 0 for a text without values."""
    out = np.zeros((len(offsets) - 1, *values.shape[1:]), dtype=values.dtype)
    full = np.flatnonzero(np.diff(offsets))
    if len(full):
        out[full] = np.add.reduceat(values, offsets[full], axis=0)
    return out


def take_lists(starts: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Positions of the values of list `c` for every `c` in `codes`, one list after the other."""
    sizes = lengths[codes]
    shift = starts[codes] - (np.cumsum(sizes) - sizes)
    return np.repeat(shift, sizes) + np.arange(sizes.sum())


#: Words that `letter_parts` can cut, after a space or not: Latin-1 letters, digits, signs but `'` and `<`.
PLAIN_WORD = r"^ ?[!-&(-;=-~ß-öø-ÿÀ-ÖØ-Þ]+$"


def letter_parts(vocab: pa.Array, single_digits: bool) -> Words:
    """Stretches of letters, of digits and of signs of words that match `PLAIN_WORD`.

    A space in front belongs to what follows it. In such words every byte from 0x80 is of a letter.
    """
    lengths = pc.binary_length(vocab).to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    whole = joined(vocab)
    text = np.frombuffer(whole, dtype=np.uint8)
    digit = (text >= 48) & (text <= 57)
    kind = np.where(digit, 1, np.where(((text | 32) >= 97) & ((text | 32) <= 122) | (text >= 128), 2, 0))
    first = np.zeros(len(text), dtype=bool)
    first[starts[:-1]] = True
    space = np.flatnonzero(text == 32)
    kind[space] = kind[space + 1]
    cut = first | (kind != np.roll(kind, 1))
    if single_digits:
        cut |= digit
    at = np.flatnonzero(cut)
    parts = pa.LargeStringArray.from_buffers(
        len(at), pa.py_buffer(np.append(at, len(text)).astype(np.int64)), pa.py_buffer(whole))
    return coded(np.concatenate([[0], np.cumsum(cut)])[starts], parts)


class IdLists:
    """Lists of ids by text, computed once and remembered in flat arrays of bounded size."""

    def __init__(self, compute: Callable[[str], Sequence[int]]):
        self.compute = compute
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.ids, self.ends = array("I"), array("q", [0])

    def find(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All remembered ids, and where the list of each key starts and how long it is."""
        if len(self.index) > MEMO_ENTRIES:
            self.forget()
        index, compute, ids, ends = self.index, self.compute, self.ids, self.ends
        for key in keys:
            if key not in index:
                ids.extend(compute(key))
                index[key] = len(ends) - 1
                ends.append(len(ids))
        at = np.fromiter(map(index.__getitem__, keys), dtype=np.int64, count=len(keys))
        bounds = np.array(ends, dtype=np.int64)
        return np.array(ids, dtype=np.uint32), bounds[at], bounds[at + 1] - bounds[at]


def joined(vocab: pa.Array) -> bytes:
    """The bytes of all words one after the other."""
    vocab = pa.concat_arrays([vocab.cast(pa.large_string())])  # without offset
    offsets = np.frombuffer(vocab.buffers()[1], dtype=np.int64)[:len(vocab) + 1] if len(vocab) else [0, 0]
    return vocab.buffers()[2][offsets[0]:offsets[-1]].to_pybytes() if offsets[-1] > offsets[0] else b""


def code_points(vocab: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words one after the other, and where each word starts (and the end)."""
    lengths = pc.utf8_length(vocab).to_numpy(zero_copy_only=False)
    points = np.frombuffer(joined(vocab).decode().encode("utf-32-le"), dtype=np.uint32)
    return points, np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)


def mixed(h: np.ndarray) -> np.ndarray:
    """Bits of a uint64 array spread over the whole word."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def ngram_hashes(vocab: pa.Array, sizes: tuple[int, ...], whole_word: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the character n-grams of each word, set between `<` and `>`, and its own hash.

    Returns the hashes ordered by word and the offsets of each word's hashes.
    """
    edged = pc.binary_join_element_wise(
        *[pa.scalar(x, vocab.type) if isinstance(x, str) else x for x in ("<", vocab, ">")], pa.scalar("", vocab.type))
    points, starts = code_points(edged)
    lengths = np.diff(starts)
    word_of = np.repeat(np.arange(len(lengths)), lengths)
    left = starts[1:][word_of] - np.arange(len(points))  # characters up to the word's end
    base = points.astype(np.uint64) + np.uint64(1)
    hashes, owners = [], []
    rolling = np.zeros(len(points), dtype=np.uint64)
    for size in range(1, max(sizes, default=0) + 1):
        rolling[: len(points) - size + 1] = (
            rolling[: len(points) - size + 1] * np.uint64(0x100000001B3) + base[size - 1:])
        if size in sizes:
            fits = np.flatnonzero(left >= size)
            hashes.append(mixed(rolling[fits] + np.uint64(size << 40)))
            owners.append(word_of[fits])
    if whole_word and len(lengths):
        power = np.power(np.uint64(0x100000001B3), (np.arange(len(points)) - starts[:-1][word_of]).astype(np.uint64))
        hashes.append(mixed(np.add.reduceat(base * power, starts[:-1]) ^ np.uint64(0xABCDEF)))
        owners.append(np.arange(len(lengths)))
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(lengths) + 1, np.int64)
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(hashes)[order], np.concatenate(
        [[0], np.cumsum(np.bincount(owner, minlength=len(lengths)))]).astype(np.int64)
