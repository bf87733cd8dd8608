"""Alignment of two tokenizers by the byte offsets where tokens of both end.

The shorter list of ends drives: each of its ends is looked up in the longer one by steps that double,
then by bisection. The common ends cut both token lists into groups, and the differences of their ranks
say which tokens overlap. Between single spaces both tokenizers always end a token, so each distinct
stretch of a batch is encoded and aligned once, and documents are put together from stretches.
"""

from __future__ import annotations

import hashlib
import json
from functools import lru_cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlake.llm import words as W
from ticketlake.llm.bpe import COMMON_PATTERN, SPACE_BEFORE_SPACE
from ticketlake.llm.common import staged
from ticketlake.llm.packing import byte_letters

SIGN = "▁"
#: A space beside white space or in front, or the sign of a space: such a text is one stretch.
ENDS_IN_SPACE = f"{SPACE_BEFORE_SPACE[:-1]}$"
UNEVEN = f"{SPACE_BEFORE_SPACE}|^{SPACE_BEFORE_SPACE[:-1]}|{SIGN}"
#: Pairs of tokens from which on a group's equal ids are put together before they are paired.
WIDE_GROUP = 4096
#: Bytes of text that are aligned at a time, at least one document.
CHUNK_BYTES = 1 << 20
#: Id pairs, those of most documents, whose counts are sent to all tasks.
FREQUENT_PAIRS = 1 << 18


class Side(NamedTuple):
    """Tokens of many stretches: stretch i has `ids[offsets[i]:offsets[i + 1]]`, ending at bytes `ends`."""

    ids: np.ndarray
    offsets: np.ndarray
    ends: np.ndarray


class Groups(NamedTuple):
    """Groups of all stretches in order: token ranges of both sides, and each stretch's groups."""

    a: np.ndarray  # where the tokens of each group start, and the end
    b: np.ndarray
    offsets: np.ndarray


def gallop(wanted: np.ndarray, start: np.ndarray, stop: np.ndarray, values: np.ndarray) -> np.ndarray:
    """For each wanted value the first place in `values[start:stop]`, ascending, that is not below it."""
    low, step = start.copy(), np.ones(len(start), dtype=np.int64)
    open_ = np.flatnonzero(low < stop)
    while len(open_):  # doubling steps, until the value stepped on is not below
        at = np.minimum(low[open_] + step[open_], stop[open_]) - 1
        below = values[at] < wanted[open_]
        low[open_[below]] = at[below] + 1
        open_ = open_[below & (at + 1 < stop[open_])]
        step[open_] *= 2
    high = np.minimum(low + step, stop)
    open_ = np.flatnonzero(low < high)
    while len(open_):  # bisection inside the last step
        middle = (low[open_] + high[open_]) // 2
        below = values[middle] < wanted[open_]
        low[open_[below]] = middle[below] + 1
        high[open_[~below]] = middle[~below]
        open_ = open_[low[open_] < high[open_]]
    return low


def only(side: Side, keep: np.ndarray) -> Side:
    """The same stretches, without tokens where `keep` is false."""
    sizes = np.diff(side.offsets)
    mask = np.repeat(keep, sizes)
    return Side(side.ids[mask], np.concatenate([[0], np.cumsum(np.where(keep, sizes, 0))]), side.ends[mask])


def groups_of(a: Side, b: Side) -> Groups:
    """Cuts both token lists of each stretch at the ends that they share."""
    shorter = np.diff(a.offsets) <= np.diff(b.offsets)
    cuts = []
    for own, other, mine in ((a, b, shorter), (b, a, ~shorter)):
        sizes = np.diff(own.offsets)
        drives = np.repeat(mine, sizes)
        stretch = np.repeat(np.arange(len(sizes)), sizes)[drives]
        wanted, rank = own.ends[drives], np.flatnonzero(drives)
        found = gallop(wanted, other.offsets[stretch], other.offsets[stretch + 1], other.ends)
        inside = found < other.offsets[stretch + 1]
        hit = inside & (other.ends[np.minimum(found, len(other.ends) - 1)] == wanted)
        cut = (stretch[hit], rank[hit] + 1, found[hit] + 1)
        cuts.append(cut if own is a else (cut[0], cut[2], cut[1]))
    stretch, a_end, b_end = (np.concatenate(x) for x in zip(*cuts))
    order = np.argsort(stretch, kind="stable")  # within a stretch, one side gave all cuts in order
    stretch, a_end, b_end = stretch[order], a_end[order], b_end[order]
    offsets = np.concatenate([[0], np.cumsum(np.bincount(stretch, minlength=len(shorter)))]).astype(np.int64)
    return Groups(np.concatenate([[0], a_end]), np.concatenate([[0], b_end]), offsets)


def linked_pairs(a: Side, b: Side, groups: Groups, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Id pairs `a * width + b` that share a group, how often, and where those of each stretch start.

    All occurrences of a small group are listed; of a wide one, each pair of distinct ids with its count.
    """
    a_n, b_n = np.diff(groups.a), np.diff(groups.b)
    wide = a_n * b_n > WIDE_GROUP
    small_n = np.where(wide, 0, b_n)
    group = np.repeat(np.arange(len(a_n)), a_n)
    codes = group[small_n[group] > 0]
    keys = [np.repeat(a.ids[small_n[group] > 0].astype(np.int64), small_n[codes]) * width
            + b.ids[W.take_lists(groups.b[:-1], small_n, codes)]]
    times, owners = [np.ones(len(keys[0]), dtype=np.int64)], [np.repeat(codes, small_n[codes])]
    for g in np.flatnonzero(wide).tolist():
        left, left_n = np.unique(a.ids[groups.a[g]:groups.a[g + 1]], return_counts=True)
        right, right_n = np.unique(b.ids[groups.b[g]:groups.b[g + 1]], return_counts=True)
        keys.append((left.astype(np.int64)[:, None] * width + right).ravel())
        times.append((left_n[:, None] * right_n).ravel())
        owners.append(np.full(len(keys[-1]), g))
    owner = np.concatenate(owners)
    stretch = np.searchsorted(groups.offsets, owner, side="right") - 1
    order = np.argsort(stretch, kind="stable")
    offsets = np.concatenate([[0], np.cumsum(np.bincount(stretch, minlength=len(groups.offsets) - 1))])
    return np.concatenate(keys)[order], np.concatenate(times)[order], offsets.astype(np.int64)


def group_texts(a: Side, b: Side, groups: Groups) -> list[bytes]:
    """Each stretch's groups as `a1,a2|b1;a3|b2,b3`."""
    a_n, b_n = np.diff(groups.a), np.diff(groups.b)
    a_group, b_group = np.repeat(np.arange(len(a_n)), a_n), np.repeat(np.arange(len(b_n)), b_n)
    total = len(a.ids) + len(b.ids)
    ids, kind = np.zeros(total, dtype=np.int64), np.zeros(total, dtype=np.int8)
    a_at = np.arange(len(a.ids)) + groups.b[a_group]  # after the other side's tokens of earlier groups
    b_at = np.arange(len(b.ids)) + groups.a[b_group + 1]
    ids[a_at], ids[b_at] = a.ids, b.ids
    last = groups.a[1:] - 1
    kind[a_at[last]] = 1
    kind[b_at[groups.b[1:] - 1]] = 2
    signs = pa.DictionaryArray.from_arrays(pa.array(kind), pa.array([",", "|", ";"], pa.large_string())).cast(pa.large_string())
    texts = pc.binary_join_element_wise(
        pa.array(ids).cast(pa.large_string()), signs, pa.scalar("", pa.large_string()))
    whole = W.joined(texts)
    ends = np.concatenate([[0], np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))])
    place = ends[groups.a[groups.offsets] + groups.b[groups.offsets]].tolist()
    return [whole[x:max(x, y - 1)] for x, y in zip(place, place[1:])]


class Aligner:
    """The two tokenizers: A of byte-level pieces, B of pieces with byte fallback.

    A's vocabulary file numbers its tokens in the order of its merges, so that merging by number gives its
    ids; the texts of many stretches are encoded by it at once. Special tokens are in neither vocabulary.
    """

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        import tiktoken

        with open(path_a, encoding="utf-8") as file:
            model = json.load(file)["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        numbers = [model["vocab"]["".join(m)] for m in merges]
        if numbers != sorted(numbers):
            raise ValueError("the ids of the first tokenizer are not in the order of its merges")
        byte_of = {letter: byte for byte, letter in enumerate(byte_letters())}
        learned = set(numbers)
        tokens = {i: bytes([byte_of[x] for x in entry]) for entry, i in model["vocab"].items() if len(entry) == 1 or i in learned}
        self.a = tiktoken.Encoding(
            "a", pat_str=COMMON_PATTERN, mergeable_ranks={x: i for i, x in tokens.items()}, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        a_bytes = [tokens.get(i, b"") for i in range(max(tokens) + 1)]
        b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace(SIGN, " ").encode())
        self.bytes = [self._table(x) for x in (a_bytes, b_bytes)]
        self.alone = self.b.piece_to_id(SIGN)

    @staticmethod
    def _table(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All tokens' bytes one after the other, where each one starts and how many they are."""
        sizes = np.array([len(x) for x in tokens], dtype=np.int64)
        return np.frombuffer(b"".join(tokens), dtype=np.uint8), np.cumsum(sizes) - sizes, sizes

    def ids_a(self, spaced: pa.Array, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A's ids of stretches after a space, and where those of each one start; `ends` are their bytes.

        Stretches that end in something else than white space are encoded as one text, because the next
        one's space then starts a token.
        """
        apart = pc.match_substring_regex(spaced, ENDS_IN_SPACE).to_numpy(zero_copy_only=False)
        together = np.flatnonzero(~apart)
        ids = self.a.encode_to_numpy(W.joined(spaced.take(pa.array(together))).decode(), disallowed_special=())
        token_ends = np.cumsum(self.bytes[0][2][ids])
        stops = np.searchsorted(token_ends, np.cumsum(np.diff(ends)[together])) + 1
        if not apart.any():
            return ids.astype(np.int64), np.concatenate([[0], stops])
        lists = [np.zeros(0, np.int64)] * len(spaced)
        for i, part in zip(together.tolist(), np.split(ids, stops[:-1])):
            lists[i] = part
        for i in np.flatnonzero(apart).tolist():
            lists[i] = self.a.encode_to_numpy(spaced[i].as_py(), disallowed_special=())
        return np.concatenate(lists).astype(np.int64), np.concatenate([[0], np.cumsum([len(x) for x in lists])])

    def ids_b(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """B's ids of stretches, which it puts a space before, and where those of each one start."""
        found = self.b.encode(stretches, num_threads=1) if stretches else []
        if "" in stretches:
            found[stretches.index("")] = [self.alone]
        offsets = np.concatenate([[0], np.cumsum(np.fromiter(map(len, found), dtype=np.int64, count=len(found)))])
        return np.fromiter(chain.from_iterable(found), dtype=np.int64, count=int(offsets[-1])), offsets

    def side(self, which: int, ids: np.ndarray, offsets: np.ndarray, want: np.ndarray, starts: np.ndarray):
        """Tokens of one side, and which stretches their bytes give back (`want`, starting at `starts`)."""
        flat, first, length = self.bytes[which]
        given = flat[W.take_lists(first, length, ids)]
        ends = np.cumsum(length[ids])
        before = np.concatenate([[0], ends])[offsets]
        same = np.diff(before) == np.diff(starts)
        if same.all():
            wrong = np.flatnonzero(given != want)
            same[np.searchsorted(starts, wrong, side="right") - 1] = False
        else:
            for i in np.flatnonzero(same).tolist():
                same[i] = np.array_equal(given[before[i]:before[i + 1]], want[starts[i]:starts[i + 1]])
        return Side(ids, offsets, ends - np.repeat(before[:-1], np.diff(offsets))), same

    def align(self, texts: pa.Array) -> dict[str, pa.Array | np.ndarray]:
        """Columns of the aligned texts; null is taken out before."""
        even = pc.invert(pc.match_substring_regex(texts, UNEVEN))
        cuts, values = W.listed(pc.split_pattern(texts.filter(even), " "))
        even = even.to_numpy(zero_copy_only=False)
        sizes = np.ones(len(texts), dtype=np.int64)
        sizes[even] = np.diff(cuts)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        order = np.argsort(np.repeat(~even, sizes), kind="stable")  # where the stretches of even texts stand
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        found = W.coded(offsets, pa.concat_arrays([values, texts.filter(pa.array(~even))]).take(pa.array(place)))
        spaced = pc.binary_join_element_wise(pa.scalar(" ", found.vocab.type), found.vocab, pa.scalar("", found.vocab.type))
        want = np.frombuffer(W.joined(spaced), dtype=np.uint8)
        starts = np.concatenate([[0], np.cumsum(pc.binary_length(spaced).to_numpy(zero_copy_only=False))]).astype(np.int64)
        encoded = self.ids_a(spaced, starts), self.ids_b(found.vocab.to_pylist())
        (a, a_same), (b, b_same) = (self.side(i, *encoded[i], want, starts) for i in (0, 1))
        same = a_same & b_same
        a, b = (x if same.all() else only(x, same) for x in (a, b))
        groups = groups_of(a, b)
        group_n = np.diff(groups.offsets)
        width = self.b.get_piece_size()
        keys, times, pair_offsets = linked_pairs(a, b, groups, width)
        sound = W.per_text((~same)[found.codes].astype(np.int64), found.offsets) == 0
        sound &= ~pc.equal(texts, "").to_numpy(zero_copy_only=False)
        links = W.per_text(np.diff(groups.a) * np.diff(groups.b), groups.offsets)
        out = {}
        for name, each in (("n_a", np.diff(a.offsets)), ("n_b", np.diff(b.offsets)), ("n_groups", group_n), ("n_links", links)):
            out[name] = pa.array(np.where(sound, W.per_text(each[found.codes], found.offsets), 0), pa.int64())
        written, codes, ends = group_texts(a, b, groups), found.codes.tolist(), found.offsets.tolist()
        out["groups_sha256"] = pa.array([
            hashlib.sha256(b";".join([written[c] for c in codes[x:y]])).hexdigest() if good else ""
            for x, y, good in zip(ends, ends[1:], sound.tolist())], pa.string())
        out["pairs"], out["times"] = self._of_documents(found, sound, keys, times, pair_offsets, width * len(self.bytes[0][2]))
        return out

    @staticmethod
    def _of_documents(found: W.Words, sound, keys, times, pair_offsets, most) -> tuple[pa.Array, pa.Array]:
        """Distinct id pairs of each document and how often they are linked in it."""
        owner = np.repeat(np.arange(len(sound)), np.diff(found.offsets))
        use = sound[owner]
        uses, often = np.unique(owner[use] * len(found.vocab) + found.codes[use], return_counts=True)
        owner, code = np.divmod(uses, len(found.vocab))
        sizes = np.diff(pair_offsets)
        at = W.take_lists(pair_offsets[:-1], sizes, code)
        key = np.repeat(owner, sizes[code]) * most + keys[at]
        each = np.repeat(often, sizes[code]) * times[at]
        order = np.argsort(key, kind="stable")
        key, each = key[order], each[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])[:len(key)])
        each = np.add.reduceat(each, first) if len(first) else each
        owner, pair = np.divmod(key[first], most)
        offsets = pa.array(np.searchsorted(owner, np.arange(len(sound) + 1)), pa.int32())
        return (pa.ListArray.from_arrays(offsets, pa.array(pair, pa.int64())),
                pa.ListArray.from_arrays(offsets, pa.array(each, pa.int64())))


@lru_cache(maxsize=1)
def aligner(path_a: str, path_b: str) -> Aligner:
    """The two tokenizers, loaded once in each Python worker."""
    return Aligner(path_a, path_b)


COLUMNS = {"n_a": "bigint", "n_b": "bigint", "n_groups": "bigint", "n_links": "bigint", "groups_sha256": "string",
           "pairs": "array<bigint>", "times": "array<bigint>"}


def align(docs: DataFrame, path_a: str, path_b: str, text: str = "text") -> DataFrame:
    """`docs` without their text, with `COLUMNS`: tokens, groups and links of each whole text.

    `pairs` are the distinct linked id pairs, `a * width + b` with the size of B's vocabulary as width,
    and `times` how often the text links them. Texts that are null, empty, or that the joined bytes of
    either side's tokens do not give back after a space have no tokens: zeros, no pairs, and ''.
    Row-local: repeated rows stay, an empty table gives an empty result, columns of these names are
    replaced. A document's distinct pairs are held together.
    """
    schema = ", ".join(f"{name}: {kind}" for name, kind in COLUMNS.items())

    @F.arrow_udf(f"struct<{schema}>")
    def aligned(texts: pa.Array) -> pa.Array:
        types = [pa.int64()] * 4 + [pa.string()] + [pa.list_(pa.int64())] * 2
        parts = []
        for chunk in W.text_chunks(texts, CHUNK_BYTES):
            found = aligner(path_a, path_b).align(chunk)
            parts.append(pa.StructArray.from_arrays([found[c].cast(t) for c, t in zip(COLUMNS, types)], list(COLUMNS)))
        return pa.concat_arrays(parts) if parts else pa.array([], pa.struct(list(zip(COLUMNS, types))))

    kept = [c for c in docs.columns if c not in COLUMNS and c != text]
    return docs.select(*kept, aligned(F.col(text)).alias("_aligned")).select(*kept, "_aligned.*")


def pair_counts(aligned: DataFrame, width: int) -> DataFrame:
    """`pair`, `n` (documents that hold it) and `best`: whether its A id has no pair in more documents.

    Each document lists a pair once, so counting it before and after the shuffle counts documents; a
    pair that all documents hold comes once from each task. An A id has at most `width` pairs.
    """
    counts = staged(aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")), "pairs")
    most = counts.groupBy(F.expr(f"pair div {width}").alias("_a")).agg(F.max("n").alias("_most"))
    own = counts.withColumn("_a", F.expr(f"pair div {width}")).join(most, "_a")
    return staged(own.select("pair", "n", (F.col("n") == F.col("_most")).alias("best")), "pairs")


def scored(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """`aligned` with `n_best`, the links whose count is their A id's highest, and `count_sum` over all links.

    The counts of the `FREQUENT_PAIRS` or fewer most frequent pairs go to all tasks, whatever the size of
    the data: pairs are counted by powers of two of their counts, and the powers from above that fit are
    taken. All other pairs are joined by pair, and each of them is in fewer documents than those.
    """
    kept = [c for c in aligned.columns if c not in ("pairs", "times", "n_best", "count_sum")]
    power = F.floor(F.log2("n")).cast("int")
    sizes = dict(counts.groupBy(power.alias("p")).count().collect())
    least, room = max(sizes, default=0) + 1, FREQUENT_PAIRS
    while sizes and least > min(sizes) and (room := room - sizes.get(least - 1, 0)) >= 0:
        least -= 1
    table = counts.filter(power >= least).toArrow().sort_by("pair").combine_chunks()
    pair, n, best = (table[c].to_numpy() for c in ("pair", "n", "best"))
    result = "struct<n_best: bigint, count_sum: bigint, pairs: array<bigint>, times: array<bigint>>"

    @F.arrow_udf(result)
    def sums(pairs: pa.Array, times: pa.Array) -> pa.Array:
        offsets, key = W.listed(pairs)
        key, often = key.to_numpy(zero_copy_only=False), W.listed(times)[1].to_numpy(zero_copy_only=False)
        at = np.minimum(np.searchsorted(pair, key), max(len(pair) - 1, 0))
        known = pair[at] == key if len(pair) else np.zeros(len(key), dtype=bool)
        own = [np.zeros(len(key), dtype=np.int64) for _ in range(2)]
        own[0][known], own[1][known] = often[known] * best[at[known]], often[known] * n[at[known]]
        left = pa.array(np.concatenate([[0], np.cumsum(~known)])[offsets], pa.int32())
        return pa.StructArray.from_arrays(
            [pa.array(W.per_text(x, offsets), pa.int64()) for x in own]
            + [pa.ListArray.from_arrays(left, pa.array(x[~known], pa.int64())) for x in (key, often)],
            ["n_best", "count_sum", "pairs", "times"])

    rows = staged(
        aligned.select(*kept, sums("pairs", "times").alias("_s")).withColumn("_row", F.monotonically_increasing_id()), "links")
    rare = rows.select("_row", F.inline(F.arrays_zip("_s.pairs", "_s.times")).alias("pair", "times"))
    joined = rare.join(counts.filter(power < least), "pair")
    more = joined.groupBy("_row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("_best"), F.sum(F.col("times") * F.col("n")).alias("_sum"))
    return rows.join(more, "_row", "left").select(
        *kept, (F.col("_s.n_best") + F.coalesce("_best", F.lit(0))).alias("n_best"),
        (F.col("_s.count_sum") + F.coalesce("_sum", F.lit(0))).alias("count_sum"))


def align_tokenizers(docs: DataFrame, path_a: str, path_b: str, text: str = "text") -> DataFrame:
    """`docs` without their text, aligned and scored; see `align` and `scored`. Texts are encoded once."""
    aligned = staged(align(docs, path_a, path_b, text), "aligned")
    return scored(aligned, pair_counts(aligned, width_of(path_b)))


def width_of(path_b: str) -> int:
    """Size of B's vocabulary."""
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
