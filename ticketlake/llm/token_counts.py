"""Token counts under a piece vocabulary: whole pieces are counted, only the rest is merged.

A text becomes the sign for a space (U+2581) and itself, with that sign for each space. Merging joins
two neighbours if they make a vocabulary string, the best score first. Two facts of the vocabulary are
proved before any text is read: which two characters stand side by side in some string of it, since no
merge reaches across any other two, so a text can be cut there; and which strings merge to themselves
alone, so that a stretch that is one of them counts one token without merging.
"""

from __future__ import annotations

import heapq
import re
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlake.llm import words as W

#: What a space becomes.
SIGN = "▁"
#: Characters of a stretch up to which many are merged together, one merge of each at a time.
SHORT_STRETCH = 64
#: Stretches of an uneven text that are looked at together.
STRETCHES = 100_000
#: A text with this is taken apart sign by sign instead of at its single spaces.
UNEVEN = f"^ |  |{SIGN}"


class Pieces:
    """Scores of a model file of pieces with byte fallback and without text normalisation."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        if not any(map(model.is_byte, ids)):
            raise ValueError("the model has no byte pieces")
        self.score = {
            model.id_to_piece(i): model.get_score(i) for i in ids
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))}
        beside = {(ord(a) << 21) | ord(b) for piece in self.score for a, b in zip(piece, piece[1:])}
        self.beside = np.array(sorted(beside), dtype=np.int64)
        if any(a != SIGN == b for piece in self.score for a, b in zip(piece, piece[1:])):
            raise ValueError("a piece of the model holds a space after another character")
        self._tabulate()
        #: Strings that merge to one token, by themselves.
        self.whole = {piece for piece in self.score if self.merged(piece) == 1}
        #: Those that a stretch after a space can be, without its sign.
        self.words = pa.array(sorted(p[1:] for p in self.whole if p[0] == SIGN), pa.large_string())

    def _tabulate(self) -> None:
        """Numbers of pieces, best score first, and the number that each pair of neighbours merges to."""
        ordered = sorted(self.score, key=self.score.get, reverse=True)
        number = {piece: i for i, piece in enumerate(ordered)}
        scores = [self.score[piece] for piece in ordered]
        self.ranks = np.cumsum([0, *(a != b for a, b in zip(scores, scores[1:]))])  # equal for equal scores
        self.unknown = len(ordered)
        self.of_point = np.full(0x110000, self.unknown, dtype=np.int64)
        pairs = {}
        for piece, own in number.items():
            if len(piece) == 1:
                self.of_point[ord(piece)] = own
            for i in range(1, len(piece)):
                left, right = number.get(piece[:i]), number.get(piece[i:])
                if left is not None and right is not None:
                    pairs[left * self.unknown + right] = own
        self.pairs = np.array(sorted(pairs), dtype=np.int64)
        self.merge_to = np.array([pairs[k] for k in self.pairs.tolist()], dtype=np.int64)

    def joins(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """What each pair of numbers merges to, -1 for none."""
        keys = left * self.unknown + right
        at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
        known = (self.pairs[at] == keys) & (left < self.unknown) & (right < self.unknown)
        return np.where(known, self.merge_to[at], -1)

    def merged_together(self, stretches: pa.Array) -> np.ndarray:
        """Tokens of each of many short stretches: in a round, each one makes its next merge."""
        points, starts = W.code_points(stretches)
        symbols = self.of_point[points]
        sizes = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
        counts = W.per_text(np.where(symbols == self.unknown, sizes - 1, 0), starts) + np.diff(starts)
        own = np.flatnonzero(np.diff(starts) > 1)  # the stretches that are still being merged
        keep = np.repeat(np.diff(starts) > 1, np.diff(starts))
        symbols, starts = symbols[keep], np.concatenate([[0], np.cumsum(np.diff(starts)[own])])
        none = np.int64(1) << 62
        to = np.append(self.joins(symbols[:-1], symbols[1:]), -1)
        to[starts[1:] - 1] = -1
        while len(own):
            order = np.where(to >= 0, (self.ranks[to] << 32) + np.arange(len(to)), none)
            best = np.minimum.reduceat(order, starts[:-1])
            alive = best < none
            if not alive.all():
                lengths = np.diff(starts)
                keep = np.repeat(alive, lengths)
                own, best = own[alive], best[alive]
                gone = (np.cumsum(~keep))[best & 0xFFFFFFFF]
                symbols, to, starts = symbols[keep], to[keep], np.concatenate([[0], np.cumsum(lengths[alive])])
                best = best - gone
            at = best & 0xFFFFFFFF
            counts[own] -= 1
            symbols[at] = to[at]
            keep = np.ones(len(symbols), dtype=bool)
            keep[at + 1] = False
            symbols, to = symbols[keep], to[keep]
            starts = starts - np.arange(len(starts))
            at = at - np.arange(len(at))
            last = at == starts[1:] - 1
            to[at] = np.where(last, -1, self.joins(symbols[at], symbols[np.minimum(at + 1, len(symbols) - 1)]))
            before = at[at > starts[:-1]] - 1
            to[before] = self.joins(symbols[before], symbols[before + 1])
        return counts

    def merged(self, stretch: str) -> int:
        """Tokens after merging: the best score first, the leftmost of equal ones; bytes of unknown characters."""
        score, n = self.score.get, len(stretch)
        after, before, ends = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(-s, i, i + 2) for i in range(n - 1) if (s := score(stretch[i:i + 2])) is not None]
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
                if (s := score(stretch[i:ends[k]])) is not None:
                    heapq.heappush(heap, (-s, i, ends[k]))
            h = before[i]
            if h >= 0 and (s := score(stretch[h:end])) is not None:
                heapq.heappush(heap, (-s, h, end))
        count, i = 0, 0
        while i < n:
            known = ends[i] > i + 1 or stretch[i] in self.score
            count += 1 if known else len(stretch[i].encode())
            i = after[i]
        return count

    def cut(self, stretch: str) -> list[str]:
        """Parts of a stretch between characters that no vocabulary string holds side by side."""
        points = np.frombuffer(stretch.encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        pairs = (points[:-1] << 21) | points[1:]
        at = np.searchsorted(self.beside, pairs)
        joined = self.beside[np.minimum(at, len(self.beside) - 1)] == pairs
        places = [0, *(np.flatnonzero(~joined) + 1).tolist(), len(stretch)]
        return [stretch[a:b] for a, b in zip(places, places[1:])]

    def tokens(self, stretches: pa.Array) -> np.ndarray:
        """Tokens of distinct stretches without their sign: one if proved whole, the others by merging."""
        counts = np.ones(len(stretches), dtype=np.int64)
        whole = pc.is_in(stretches, self.words).to_numpy(zero_copy_only=False)
        short = pc.less_equal(pc.utf8_length(stretches), SHORT_STRETCH).to_numpy(zero_copy_only=False)
        rest = stretches.filter(pa.array(short & ~whole))
        counts[short & ~whole] = self.merged_together(pc.binary_join_element_wise(
            pa.scalar(SIGN, rest.type), rest, pa.scalar("", rest.type)))
        counts[~short & ~whole] = [self.long(SIGN + s) for s in stretches.filter(pa.array(~short & ~whole)).to_pylist()]
        return counts

    def long(self, stretch: str) -> int:
        """Tokens of a long stretch, cut wherever that is proved to change nothing."""
        parts = self.cut(stretch)
        short = pa.array([p for p in parts if len(p) <= SHORT_STRETCH], pa.large_string())
        return int(self.merged_together(short).sum()) + sum(self.merged(p) for p in parts if len(p) > SHORT_STRETCH)

    def uneven(self, text: str) -> int:
        """Tokens of a text with several spaces in a row, in front, or with signs of its own."""
        signed, total = SIGN + text.replace(" ", SIGN), 0
        found = re.finditer(f"{SIGN}+[^{SIGN}]*", signed)
        while part := [m.group()[1:] for m in islice(found, STRETCHES)]:
            some = W.coded(np.array([0, len(part)]), pa.array(part, pa.large_string()))
            total += int(self.tokens(some.vocab)[some.codes].sum())
        return total

    def count(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text. Between single spaces each distinct stretch is counted once."""
        even = pc.invert(pc.match_substring_regex(texts, UNEVEN))
        offsets, values = W.listed(pc.split_pattern(texts.filter(even), " "))
        found = W.coded(offsets, values)
        even = even.to_numpy(zero_copy_only=False)
        out = np.zeros(len(texts), dtype=np.int64)
        out[even] = W.per_text(self.tokens(found.vocab)[found.codes], found.offsets)
        out[~even] = [self.uneven(texts[i].as_py()) for i in np.flatnonzero(~even).tolist()]
        return np.where(pc.equal(texts, "").to_numpy(zero_copy_only=False), 0, out)


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    """The vocabulary of a file, proved once in each Python worker."""
    return Pieces(path)


def count_tokens(docs: DataFrame, path: str, limit: int, text: str = "text") -> DataFrame:
    """`docs` with `n_bytes`, `n_tokens` and `over_limit` (more than `limit` tokens) of each whole text.

    Null counts as the empty text, which has no token. Row-local: repeated rows stay, an empty table
    gives an empty result; columns of the three names are replaced. Begin, end and other special tokens
    are not added, and their strings in a text are plain text. A text is worked on in stretches; one
    without any proved cut needs memory in proportion to its length.
    """
    @F.arrow_udf("long")
    def tokens_of(texts: pa.Array) -> pa.Array:
        parts = [pa.array(pieces(path).count(chunk), pa.int64()) for chunk in W.text_chunks(texts)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.int64())

    kept = [c for c in docs.columns if c not in ("n_bytes", "n_tokens", "over_limit")]
    counted = docs.select(
        *kept, F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
        tokens_of(F.col(text)).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
