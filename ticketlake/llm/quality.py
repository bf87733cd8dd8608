"""Quality classifier: learned vectors of hashed word and character n-grams, averaged per document.

The average goes through a softmax over the labels. It is trained by stochastic gradient descent in
numpy on a bounded sample of labelled documents, which tasks take apart: the driver gets counts of
buckets and no text. Scoring covers whole texts of all documents, row by row, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlake.llm import words as W
from ticketlake.llm.common import hashed_fraction

BUCKETS = 1 << 16
NGRAMS = (3, 4)
#: Features without weight that every average holds, so that a few words decide little.
PRIOR_FEATURES = 20
#: Steps of descent that even a small sample gets, about.
LEAST_STEPS = 800
#: Labelled documents of each label that training uses, about.
SAMPLE_PER_LABEL = 1500
#: Distinct buckets of a text as unsigned 16-bit numbers, and how often each occurs, as 32-bit ones.
BAG = "struct<bucket:binary,times:binary>"


@dataclass
class Model:
    """`feature` is each bucket's share of the margin of label 1 over label 0, `bias` the rest."""

    feature: np.ndarray
    bias: float


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, W.Words]:
    """Buckets of each distinct word and its character n-grams, their offsets, and the words."""
    found = W.split_words(texts)
    hashes, offsets = W.ngram_hashes(found.vocab, NGRAMS, whole_word=True)
    return (hashes % np.uint64(BUCKETS)).astype(np.int64), offsets, found


def word_pairs(found: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the adjacent word pairs of each text and their offsets.

    All pairs of a word with itself share a bucket, so that repetition of unknown words counts.
    """
    if not len(found.codes):
        return np.zeros(0, np.int64), np.zeros_like(found.offsets)
    own, _ = W.ngram_hashes(found.vocab, (), whole_word=True)
    inside = np.ones(len(found.codes), dtype=bool)
    inside[found.offsets[1:][found.counts > 0] - 1] = False  # the last word of a text starts no pair
    left = np.flatnonzero(inside)
    a, b = found.codes[left], found.codes[left + 1]
    pair = W.mixed(own[a] * np.uint64(3) + own[b]) % np.uint64(BUCKETS - 1)
    return np.where(a == b, BUCKETS - 1, pair.astype(np.int64)), np.concatenate([[0], np.cumsum(inside)])[found.offsets]


def bags(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct buckets of each text and how often each occurs."""
    for chunk in W.text_chunks(texts, W.NGRAM_CHUNK_BYTES):
        bucket, starts, found = features(chunk)
        lengths = np.diff(starts)
        pairs, pair_at = word_pairs(found)
        for i, (a, b) in enumerate(zip(found.offsets[:-1], found.offsets[1:])):
            grams = bucket[W.take_lists(starts[:-1], lengths, found.codes[a:b])]
            mine, times = np.unique(np.concatenate([grams, pairs[pair_at[i]:pair_at[i + 1]]]), return_counts=True)
            yield mine.astype(np.uint16), times.astype(np.uint32)


def bag_column(text: Column) -> Column:
    """The bag of a text column."""
    @F.arrow_udf(BAG)
    def of(texts: pa.Array) -> pa.Array:
        found = [(bucket.tobytes(), times.tobytes()) for bucket, times in bags(texts)]
        return pa.StructArray.from_arrays(
            [pa.array([x[i] for x in found], pa.binary()) for i in (0, 1)], ["bucket", "times"])

    return of(text)


def training_rows(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE_PER_LABEL) -> DataFrame:
    """About `per_label` rows `(text, quality)` of each label 0 and 1, chosen by a hash of the id.

    Rows with a null id, text or label take no part.
    """
    known = labels.filter(F.col("quality").isin(0, 1)).select("doc_id", "quality").dropna().distinct()
    n = {r["quality"]: r["n"] for r in known.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    share = F.when(F.col("quality") == 1, per_label / max(1, n.get(1, 0))).otherwise(per_label / max(1, n.get(0, 0)))
    chosen = known.filter(hashed_fraction(F.col("doc_id"), share))
    # at most about 2 * per_label rows of two numbers
    return (
        docs.select("doc_id", "text").dropna().join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "quality"))


def train(rows: list[tuple[str, int]], **options) -> Model:
    """A model from texts and their labels; see `descend`."""
    return descend(
        list(bags(pa.array([t for t, _ in rows], pa.string()))), np.array([q for _, q in rows], dtype=np.int64), **options)


def descend(
    found: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, dim: int = 8, epochs: int = 6, rate: float = 0.5,
    batch: int = 32, seed: int = 7,
) -> Model:
    """Word and n-gram vectors and softmax weights by stochastic gradient descent over bags of texts.

    The labels weigh the same, so the score of a document says nothing about how rare its label is.
    Without rows of both labels every score is that of the label there is, or 0.5.
    """
    if len(set(target.tolist())) < 2:
        return Model(np.zeros(BUCKETS), 3.0 * (2 * int(target[0]) - 1) if len(target) else 0.0)
    rng = np.random.default_rng(seed)
    weight = np.where(target == 1, 0.5 / np.mean(target == 1), 0.5 / np.mean(target == 0))
    vectors = rng.uniform(-1 / dim, 1 / dim, (BUCKETS, dim))
    out, bias = np.zeros((dim, 2)), np.zeros(2)
    epochs = max(epochs, LEAST_STEPS // -(-len(found) // batch))
    steps = epochs * -(-len(found) // batch)
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(found))
        for at in range(0, len(found), batch):
            now = rate * (1 - step / steps)
            step += 1
            docs = order[at:at + batch]
            sizes = np.array([len(found[d][0]) for d in docs])
            feature = np.concatenate([found[d][0] for d in docs])
            share = np.concatenate([found[d][1] / (found[d][1].sum(dtype=np.int64) + PRIOR_FEATURES) for d in docs])
            owner = np.repeat(np.arange(len(docs)), sizes)
            mean = np.zeros((len(docs), dim))
            for k in range(dim):
                mean[:, k] = np.bincount(owner, share * vectors[feature, k], len(docs))
            logits = mean @ out + bias
            chance = np.exp(logits - logits.max(axis=1, keepdims=True))
            chance /= chance.sum(axis=1, keepdims=True)
            chance[np.arange(len(docs)), target[docs]] -= 1
            error = chance * weight[docs, None] / len(docs)
            back = error @ out.T
            out -= now * batch * (mean.T @ error) / 4
            bias -= now * error.sum(axis=0)
            distinct, place = np.unique(feature, return_inverse=True)
            for k in range(dim):
                vectors[distinct, k] -= now * batch * np.bincount(place, share * back[owner, k], len(distinct))
    return Model(vectors @ (out[:, 1] - out[:, 0]), float(bias[1] - bias[0]))


def fit(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE_PER_LABEL) -> Model:
    """A model from labelled documents; about `2 * per_label` bags come to the driver, in Arrow batches."""
    rows = training_rows(docs, labels, per_label).orderBy("doc_id", "text").select(
        bag_column(F.col("text")).alias("bag"), "quality").select("bag.*", "quality").toArrow()
    found = [
        (np.frombuffer(bucket.as_py(), np.uint16), np.frombuffer(times.as_py(), np.uint32))
        for bucket, times in zip(rows["bucket"], rows["times"])]
    return descend(found, rows["quality"].to_numpy().astype(np.int64))


def scores(texts: pa.Array, model: Model) -> np.ndarray:
    """Probability of label 1 of each text; null counts as empty, empty texts have the bias alone."""
    out = []
    for chunk in W.text_chunks(texts, W.NGRAM_CHUNK_BYTES):
        bucket, starts, found = features(chunk)
        pairs, pair_at = word_pairs(found)
        words = W.per_text(W.per_text(model.feature[bucket], starts)[found.codes], found.offsets)
        n = W.per_text(np.diff(starts)[found.codes], found.offsets) + np.diff(pair_at)
        margin = (words + W.per_text(model.feature[pairs], pair_at)) / (n + PRIOR_FEATURES)
        out.append(1 / (1 + np.exp(-np.clip(margin + model.bias, -50, 50))))
    return np.round(np.concatenate(out), 9) if out else np.zeros(0)


def score_column(model: Model, text: Column) -> Column:
    """The score of a text column, 0 to 1."""
    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(scores(texts, model))

    return score(text)


def classify(docs: DataFrame, model: Model, text: str = "text", score: str = "score") -> DataFrame:
    """`docs` with the column `score`; a column of that name is replaced, repeated rows stay."""
    return docs.withColumn(score, score_column(model, F.col(text)))
