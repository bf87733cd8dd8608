"""Best-fit packing of token pieces: minimum bin slack by bitset subset sums over piece lengths.

Which piece of a length goes where does not matter, so bins are filled from the counts of pieces by
length: at most `capacity` numbers, whatever the number of documents. Each fill is repeated while its
lengths last. Pieces then look up their place by their rank among the pieces of their length.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticketlake.llm import words as W
from ticketlake.llm.common import staged

#: Pieces that are ranked together, about; a frequent length is dealt to several such groups.
GROUP_ROWS = 20_000


def byte_letters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary.

    Printable Latin-1 characters stand for themselves, the other bytes for those from 256 on.
    """
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]



class Tokens:
    """Ids of one tokenizer file, word by word: its words never reach across white space."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.letters = byte_letters()
        self.parts, self.words = W.IdLists(self.part_ids), W.IdLists(self.word_ids)

    def part_ids(self, part: str) -> list[int]:
        """Ids of a lower-case stretch of letters, a digit or a stretch of other characters."""
        if not part.isascii():
            part = "".join([self.letters[b] for b in part.encode()])
        return [t.id for t in self.tokenizer.model.tokenize(part)]

    def word_ids(self, word: str) -> list[int]:
        """Ids of a word by all steps of the tokenizer."""
        return self.tokenizer.encode(word, add_special_tokens=False).ids

    def vocab_ids(self, vocab: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct words, and where each word's ids start and how many they are.

        The vocabulary's file splits words into stretches of letters, single digits and stretches of
        signs, but for endings after an apostrophe. Words of Latin-1 letters, digits and signs are
        cut here; those with an apostrophe or with `<` (of special tokens) and all others go through
        the tokenizer.
        """
        plain = pc.match_substring_regex(vocab, W.PLAIN_WORD)
        found = W.letter_parts(pc.utf8_lower(vocab.filter(plain)), single_digits=True)
        part_ids, part_at, part_n = self.parts.find(found.vocab.to_pylist())
        word_ids, word_at, word_n = self.words.find(vocab.filter(pc.invert(plain)).to_pylist())
        ids = np.concatenate([part_ids[W.take_lists(part_at, part_n, found.codes)], word_ids])
        sizes = W.per_text(part_n[found.codes], found.offsets)
        plain = plain.to_numpy(zero_copy_only=False)
        starts, lengths = np.zeros(len(vocab), np.int64), np.zeros(len(vocab), np.int64)
        starts[plain], lengths[plain] = np.cumsum(sizes) - sizes, sizes
        starts[~plain], lengths[~plain] = word_at + sizes.sum(), word_n
        return ids, starts, lengths

    def encode(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each followed by `end`, and where each text's ids start (and the end)."""
        found = W.split_words(texts)
        ids, starts, lengths = self.vocab_ids(found.vocab)
        ids = np.append(ids, np.uint32(end))
        starts, lengths = np.append(starts, len(ids) - 1), np.append(lengths, 1)
        codes = np.insert(found.codes, found.offsets[1:], len(starts) - 1)
        offsets = found.offsets + np.arange(len(found.offsets))
        return ids[W.take_lists(starts, lengths, codes)], np.concatenate(
            [[0], np.cumsum(W.per_text(lengths[codes], offsets))])


@lru_cache(maxsize=2)
def tokens(path: str) -> Tokens:
    """The tokenizer of a file, built once in each Python worker."""
    return Tokens(path)


def token_pieces(docs: DataFrame, path: str, capacity: int, end: int, text: str = "text") -> DataFrame:
    """One row for each piece of at most `capacity` tokens: `piece`, `start`, `length`, `ids`.

    `ids` are little-endian unsigned 32-bit numbers. A document is its tokens and the id `end`; only
    longer ones are cut. A null or empty text gives the piece of `end` alone. Row-local; the other
    columns of `docs` stay but for `text`, and those of the four names are replaced.
    """
    @F.arrow_udf("array<binary>")
    def pieces_of(texts: pa.Array) -> pa.Array:
        parts = []
        for chunk in W.text_chunks(texts):
            ids, offsets = tokens(path).encode(chunk, end)
            number = -(-np.diff(offsets) // capacity)
            owner = np.repeat(np.arange(len(number)), number)
            place = np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number)
            cuts = np.concatenate([offsets[owner] + place * capacity, offsets[-1:]]) * 4
            values = pa.Array.from_buffers(pa.binary(), len(owner), [
                None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(ids.astype("<u4"))])
            parts.append(pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(number)]), pa.int32()), values))
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.binary()))

    kept = [c for c in docs.columns if c not in (text, "piece", "start", "length", "ids")]
    # every document has a piece; without `outer`, a filter on the pieces would encode each text twice
    pieces = F.posexplode_outer("ids").alias("piece", "ids")
    return (
        docs.select(*kept, pieces_of(F.col(text)).alias("ids")).select(*kept, pieces)
        .withColumn("start", F.col("piece").cast("long") * capacity)
        .withColumn("length", (F.octet_length("ids") / 4).cast("long"))
        .select(*kept, "piece", "start", "length", "ids")
    )


def fullest(lengths: list[int], counts: dict[int, int], room: int) -> list[tuple[int, int]]:
    """The multiset of available lengths with the largest sum that is at most `room`.

    Bit s of a number says that sum s can be reached. Lengths are added from the longest down until
    `room` itself is reached, and the numbers before each addition give the way back.
    """
    reach, mask, trail = 1, (1 << (room + 1)) - 1, []
    for length in reversed(lengths[:bisect_right(lengths, room)]):
        left, copies = min(counts[length], room // length), 1
        while left > 0:
            copies = min(copies, left)
            more = reach | (reach << (copies * length)) & mask
            if more != reach:
                trail.append((length, copies, reach))
                reach = more
            left, copies = left - copies, copies * 2
        if reach >> room:
            break
    total, chosen = reach.bit_length() - 1, []
    for length, copies, before in reversed(trail):
        if not before >> total & 1:
            chosen.append((length, copies))
            total -= copies * length
    return chosen


def bin_plan(counts: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """Fills `(times, {length: copies})` that use up all counts, each with the least slack then possible.

    A bin starts with the longest length left. A fill is taken as often as its lengths last, after
    which one of them is scarcer than the fill needs: the number of fills is bounded by the lengths.
    """
    counts = {length: n for length, n in counts.items() if n > 0}
    lengths, plan = sorted(counts), []
    while lengths:
        longest = lengths[-1]
        counts[longest] -= 1
        fill = {longest: 1}
        for length, copies in fullest(lengths, counts, capacity - longest):
            fill[length] = fill.get(length, 0) + copies
        counts[longest] += 1
        times = min(counts[length] // copies for length, copies in fill.items())
        for length, copies in fill.items():
            counts[length] -= times * copies
            if not counts[length]:
                lengths.pop(bisect_left(lengths, length))
        plan.append((times, fill))
    return plan


def slots(plan: list[tuple[int, dict[int, int]]]) -> np.ndarray:
    """Rows `(length, first rank, copies, first sequence, first offset)`, by length and rank."""
    rows, used, sequence = [], {}, 0
    for times, fill in plan:
        offset = 0
        for length, copies in sorted(fill.items(), reverse=True):
            rank = used.get(length, 0)
            rows.append((length, rank, copies, sequence, offset))
            used[length] = rank + times * copies
            offset += length * copies
        sequence += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, capacity: int, length: str = "length") -> DataFrame:
    """`pieces` with `sequence_id` and `offset`: sequences of at most `capacity` without gaps.

    Every `length` must be 1 to `capacity`. Repeated rows are packed each for itself; an empty table
    gives an empty result; columns of the two names are replaced. Pieces are written once with a row
    number, so that all later passes see the same rows. Of the data, only counts by length reach the
    driver (at most `capacity` rows), and the fills go back with the lookup function. One shuffle, by
    length and a salt that splits frequent lengths.
    """
    kept = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    rows = staged(pieces.select(*kept).withColumn("_row", F.monotonically_increasing_id()), "pieces")
    counts = {r[0]: r[1] for r in rows.groupBy(length).agg(F.count("*").alias("n")).collect()}
    if any(not 1 <= (k or 0) <= capacity for k in counts):
        raise ValueError(f"lengths must be 1 to {capacity}")
    table = slots(bin_plan(counts, capacity))
    salts = max(1, -(-max(counts.values(), default=0) // GROUP_ROWS))
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("_row"), F.lit(salts)))
    groups = salted.groupBy(length, "_salt").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(length).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = groups.select(length, "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    own = Window.partitionBy(length, "_salt").orderBy("_row")
    ranked = salted.withColumn("_own", F.row_number().over(own) - 1).join(bases, [length, "_salt"]).withColumn(
        "_rank", (F.col("_own") + F.col("_base")).cast("long"))

    @F.arrow_udf("struct<sequence_id:long,offset:long>")
    def place(lengths: pa.Array, ranks: pa.Array) -> pa.Array:
        size, rank = lengths.to_numpy(zero_copy_only=False), ranks.to_numpy(zero_copy_only=False)
        first, last = np.searchsorted(table[:, 0], size), np.searchsorted(table[:, 0], size, side="right")
        key = table[:, 0] * (1 << 48) + table[:, 1]
        at = np.searchsorted(key, size * (1 << 48) + rank, side="right") - 1
        assert ((first <= at) & (at < last)).all()
        within = rank - table[at, 1]
        return pa.StructArray.from_arrays(
            [pa.array(table[at, 3] + within // table[at, 2]), pa.array(table[at, 4] + within % table[at, 2] * size)],
            ["sequence_id", "offset"])

    placed = ranked.select(*kept, place(F.col(length).cast("long"), F.col("_rank")).alias("_at"))
    return placed.select(*kept, "_at.sequence_id", "_at.offset")


def sequences(packed: DataFrame, ids: str = "ids") -> DataFrame:
    """The packed sequences themselves: `sequence_id`, `n_pieces` and `ids`, at most `capacity` tokens each."""
    parts = F.array_sort(F.collect_list(F.struct("offset", F.col(ids).alias("ids"))))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.size("parts").alias("n_pieces"),
        F.aggregate("parts", F.lit(b""), lambda whole, part: F.concat(whole, part["ids"])).alias("ids"))
