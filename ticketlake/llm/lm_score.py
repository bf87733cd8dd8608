"""Language-model scores with stupid backoff, computed relationally over n-grams of words.

A word after others scores c(context word) / c(context) for its `order` - 1 words of context if the corpus
holds the n-gram, else ALPHA times what it scores with one word less; a word without context scores
c(word) / N. Every n-gram of every document counts, by a 64-bit hash of its words.

A document that is itself of the corpus never backs off: its own n-grams are all held. Its score is then
the sum over its distinct n-grams of weight * log c, where the weight is how often the n-gram is scored
less how often it is the context. So one exchange by n-gram gives both the counts and the scores. Other
documents are joined with the table of counts, one row for each length that a word may back off to.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticketlake.llm import words as W

ALPHA, ORDER = 0.4, 2
#: Frequent n-grams, at most, from about so many texts. They are counted beforehand and never become rows
#: that are shuffled, so that no key that is left is hot; the choice changes no score.
FREQUENT, SAMPLE_TEXTS = 131_072, 2_000
#: Bytes of text whose n-grams are made together, at least one document.
CHUNK_BYTES = 2 << 20
STEP = np.uint64(0x100000001B3)


class Grams:
    """N-grams of some texts, by length from 1: where they start, their numbers here, and each number's key."""

    def __init__(self, texts: pa.Array, order: int):
        found = W.split_words(texts)
        hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in found.vocab.to_pylist()], dtype=np.uint64)
        codes, size = found.codes.astype(np.int64), np.int64(max(1, len(hashes)))
        self.counts = found.counts
        self.owner = np.repeat(np.arange(len(texts)), found.counts)
        self.first = found.offsets[:-1][self.owner]
        self.left = found.offsets[1:][self.owner] - np.arange(len(codes))  # words up to the text's end
        at, numbers, keys = np.arange(len(codes)), codes, W.mixed(hashes)
        self.lengths = [(at, numbers, keys)]
        for length in range(2, order + 1):
            fits = self.left[at] >= length
            at = at[fits]
            distinct, numbers = np.unique(numbers[fits] * size + codes[at + length - 1], return_inverse=True)
            keys = W.mixed(keys[distinct // size] * STEP + hashes[distinct % size])
            self.lengths.append((at, numbers, keys))

    def of_texts(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For each length: owners, numbers, times and weights of each text's distinct n-grams, and keys."""
        order = len(self.lengths)
        for length, (at, numbers, keys) in enumerate(self.lengths, 1):
            size = np.int64(max(1, len(keys)))
            distinct, inverse, times = np.unique(
                self.owner[at] * size + numbers, return_inverse=True, return_counts=True)
            weight = times
            if length < order:
                first = at == self.first[at]
                context = (self.left[at] > length) & (first | (length == order - 1))
                weight = np.bincount(inverse, first.astype(float) - context, len(distinct)).astype(np.int64)
            yield distinct // size, distinct % size, times, weight, keys


def places(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Where each key stands in the sorted ones, -1 if it doesn't."""
    at = np.minimum(np.searchsorted(sorted_keys, keys), max(0, len(sorted_keys) - 1))
    return np.where(sorted_keys[at] == keys, at, -1) if len(sorted_keys) else np.full(len(keys), -1)


def by_chunk(order: int, make: Callable[[Grams, pa.RecordBatch], pa.RecordBatch]):
    """A function for `mapInArrow` over rows whose last column is the text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for chunk in W.text_chunks(batch.column(batch.num_columns - 1), CHUNK_BYTES):
                yield make(Grams(chunk, order), batch.slice(at, len(chunk)))
                at += len(chunk)

    return run


def gram_counts(docs: DataFrame, text: str = "text", order: int = ORDER) -> DataFrame:
    """`(key, length, n)`: how often each n-gram of up to `order` words occurs, counted before the shuffle."""
    def count(grams: Grams, _: pa.RecordBatch) -> pa.RecordBatch:
        parts = [(keys, np.full(len(keys), i), np.bincount(numbers, minlength=len(keys)))
                 for i, (_, numbers, keys) in enumerate(grams.lengths, 1)]
        key, length, n = (np.concatenate(x) for x in zip(*parts))
        return pa.RecordBatch.from_arrays(
            [pa.array(key.view(np.int64)), pa.array(length, pa.int32()), pa.array(n, pa.int64())], ["key", "length", "n"])

    rows = docs.select(text).mapInArrow(by_chunk(order, count), "key long, length int, n long")
    return rows.groupBy("key", "length").agg(F.sum("n").alias("n"))


def frequent_grams(docs: DataFrame, text: str, order: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Sorted keys of the most frequent n-grams of a bounded sample, their counts in all texts, and all tokens."""
    sample = docs.sample(min(1.0, SAMPLE_TEXTS / max(1, docs.count())), seed=5)
    top = gram_counts(sample, text, order).filter("n > 1").orderBy(F.col("n").desc(), "key").limit(FREQUENT)
    frequent = np.sort(top.select("key").toArrow()["key"].to_numpy().view(np.uint64))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(frequent) + 1, dtype=np.int64)  # the last one: tokens
        for batch in batches:
            for chunk in W.text_chunks(batch.column(0), CHUNK_BYTES):
                grams = Grams(chunk, order)
                n[-1] += grams.counts.sum()
                for _, numbers, keys in grams.lengths:
                    place = places(frequent, keys)
                    n[place[place >= 0]] += np.bincount(numbers, minlength=len(keys))[place >= 0]
        full = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(n[full])], ["place", "n"])

    counted = docs.select(text).mapInArrow(count, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    n = np.zeros(len(frequent) + 1, dtype=np.int64)
    n[counted["place"].to_numpy()] = counted["n"].to_numpy()
    return frequent, n[:-1], int(n[-1])


def totals(scored: DataFrame) -> DataFrame:
    """The result columns from parts `(row, doc_id, n, score)` of each row's score."""
    sums = scored.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.sum("n").alias("n"), F.sum("score").alias("score"))
    return sums.select(
        "doc_id", F.col("n").alias("n_tokens"), F.round("score", 6).alias("log_score"),
        F.round(F.when(F.col("n") > 0, F.col("score") / F.col("n")), 9).alias("mean_log_score"))


def numbered(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    return docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))


def score_documents(docs: DataFrame, id_col: str = "doc_id", text: str = "text", order: int = ORDER) -> DataFrame:
    """`(doc_id, n_tokens, log_score, mean_log_score)`, one row for each row of `docs`, by counts over all of them.

    A null or empty text has 0 tokens, score 0 and a null mean. Null ids and repeated rows are kept, each
    row counts; an empty table gives an empty result; other columns are left out. Long texts are worked on
    whole. At most FREQUENT counts come to the driver.
    """
    frequent, n, total = frequent_grams(docs, text, order)
    logs, whole = np.log(np.maximum(n, 1)), np.log(max(1, total))

    def explode(grams: Grams, rows: pa.RecordBatch) -> pa.RecordBatch:
        size, number = len(grams.counts), rows.column(0).to_numpy()
        own = -whole * (grams.counts if order == 1 else grams.counts > 0)
        parts = []
        for owner, at, times, weight, keys in grams.of_texts():
            place = places(frequent, keys)[at]
            hot = place >= 0
            own = own + np.bincount(owner[hot], weight[hot] * logs[place[hot]], size)
            parts.append((keys[at[~hot]], number[owner[~hot]], times[~hot], weight[~hot]))
        key, row, times, weight = (np.concatenate(x) for x in zip(*parts))
        # a document's own row has its id, its tokens and what frequent n-grams score
        none, zeros = pa.nulls(len(key), pa.int64()), np.zeros(len(key), dtype=np.int64)
        heads = W.mixed(number.astype(np.uint64))
        return pa.RecordBatch.from_arrays([
            pa.array(np.concatenate([heads, key]).view(np.int64)), pa.array(np.concatenate([number, row])),
            pa.array(np.concatenate([np.zeros(size, np.int64), times]), pa.int64()),
            pa.array(np.concatenate([np.zeros(size, np.int64), weight]), pa.int64()),
            pa.concat_arrays([rows.column(1).cast(pa.int64()), none]),
            pa.array(np.concatenate([grams.counts, zeros]), pa.int64()),
            pa.array(np.concatenate([own, zeros.astype(float)])),
        ], ["key", "row", "times", "weight", "doc_id", "n", "score"])

    rows = numbered(docs, id_col, text).mapInArrow(
        by_chunk(order, explode), "key long, row long, times long, weight long, doc_id long, n long, score double")
    count = F.greatest(F.sum("times").over(Window.partitionBy("key")), F.lit(1))
    return totals(rows.select("row", "doc_id", "n", (F.col("score") + F.col("weight") * F.log(count)).alias("score")))


def score_against(
    docs: DataFrame, corpus: DataFrame, id_col: str = "doc_id", text: str = "text", order: int = ORDER,
) -> DataFrame:
    """The columns of `score_documents`, by the counts of another table, with backoff.

    A word that the corpus doesn't hold counts as one that it holds once, and so does an empty corpus's
    length. Nulls, empty and repeated rows as in `score_documents`. The rows are a document's distinct
    n-grams times the lengths they may back off to; the side of the counts has one row for each n-gram,
    so Spark can split a hot n-gram's rows.
    """
    counts = gram_counts(corpus, text, order).select("key", F.col("n").alias("c"), "length")
    total = counts.filter("length = 1").agg(F.sum("c")).first()[0] or 1

    def explode(grams: Grams, rows: pa.RecordBatch) -> pa.RecordBatch:
        number = rows.column(0).to_numpy()
        key_at = []
        for at, numbers, keys in grams.lengths:
            spread = np.zeros(len(grams.owner), dtype=np.uint64)
            spread[at] = keys[numbers]
            key_at.append(spread)
        heads = W.mixed(number.astype(np.uint64))  # a document's own row has its id and its tokens
        none = np.zeros(len(number), dtype=np.int64)
        parts = [(number, heads, none, none, none, heads, heads)]
        for length, (at, numbers, keys) in enumerate(grams.lengths, 1):
            scored = np.ones(len(at), dtype=bool) if length == order else at == grams.first[at]
            size = np.int64(max(1, len(keys)))
            _, one, times = np.unique(
                grams.owner[at[scored]] * size + numbers[scored], return_index=True, return_counts=True)
            start = at[scored][one]
            for left in range(1, length + 1):
                key = key_at[left - 1][start + length - left]
                context = key_at[left - 2][start + length - left] if left > 1 else key
                parts.append((number[grams.owner[start]], key_at[length - 1][start], times, np.full(len(key), length),
                              np.full(len(key), left), key, context))
        row, gram, times, whole, left, key, context = (np.concatenate(x) for x in zip(*parts))
        rest = len(row) - len(number)
        return pa.RecordBatch.from_arrays([
            pa.array(row), pa.array(gram.view(np.int64)), pa.array(times, pa.int64()), pa.array(whole, pa.int32()),
            pa.array(left, pa.int32()), pa.array(key.view(np.int64)), pa.array(context.view(np.int64)),
            pa.concat_arrays([rows.column(1).cast(pa.int64()), pa.nulls(rest, pa.int64())]),
            pa.array(np.concatenate([grams.counts, np.zeros(rest, np.int64)]), pa.int64()),
        ], ["row", "gram", "times", "whole", "left", "key", "context", "doc_id", "n"])

    chains = numbered(docs, id_col, text).mapInArrow(
        by_chunk(order, explode),
        "row long, gram long, times long, whole int, left int, key long, context long, doc_id long, n long")
    contexts = counts.select(F.col("key").alias("context"), F.col("c").alias("of"))
    joined = chains.join(counts.select("key", "c"), "key", "left").join(contexts, "context", "left")
    # what is held of a gram is also held of its context; of all lengths held, the longest scores
    log = F.log(F.coalesce("c", F.lit(1))) - F.log(F.when(F.col("left") > 1, F.col("of")).otherwise(total))
    best = joined.filter(F.col("c").isNotNull() | (F.col("left") < 2)).groupBy("row", "gram").agg(
        F.max_by(log, "left").alias("log"), F.max("left").alias("left"), F.max("whole").alias("whole"),
        *[F.max(c).alias(c) for c in ("times", "doc_id", "n")])
    score = F.col("times") * (F.col("log") + (F.col("whole") - F.col("left")) * float(np.log(ALPHA)))
    return totals(best.select("row", "doc_id", "n", score.alias("score")))
