"""Language of text: scripts narrow the candidates, Viterbi over per-word scores labels spans.

Each word scores every language by the log probabilities of its character n-grams. A language
competes for a word only if it uses the word's script. The best path through the words pays a
penalty for each switch of language, so that stretches of one language come out as spans.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlake.llm import words as W
from ticketlake.llm.common import hashed_fraction

BUCKETS = 1 << 15
NGRAMS = (1, 2, 3)
#: Distinct training texts of each language, about.
SAMPLE_PER_LANG = 2000
#: What a switch of language costs, in nats, and what a word costs in a script its language lacks.
SWITCH, WRONG_SCRIPT = 12.0, 20.0
#: Share of a language's letters from which on it uses a script.
SCRIPT_SHARE = 0.01
#: Words whose best paths are found together, about.
PATH_WORDS = 1 << 19
UNDETERMINED = "und"
RESULT = ("struct<lang:string,score:double,spans:array<struct<first_word:int,last_word:int,lang:string,letters:int>>>")

# First and last code points of scripts.
SCRIPTS = [
    ("latin", 0x41, 0x24F), ("latin", 0x1E00, 0x1EFF), ("greek", 0x370, 0x3FF), ("cyrillic", 0x400, 0x52F),
    ("armenian", 0x530, 0x58F), ("hebrew", 0x590, 0x5FF), ("arabic", 0x600, 0x6FF), ("devanagari", 0x900, 0x97F),
    ("bengali", 0x980, 0x9FF), ("tamil", 0xB80, 0xBFF), ("thai", 0xE00, 0xE7F), ("georgian", 0x10A0, 0x10FF),
    ("hangul", 0x1100, 0x11FF), ("hangul", 0xAC00, 0xD7AF), ("kana", 0x3040, 0x30FF), ("han", 0x3400, 0x9FFF),
]
SCRIPT_NAMES = ["other", *dict.fromkeys(name for name, _, _ in SCRIPTS)]


@lru_cache(maxsize=1)
def letter_scripts() -> np.ndarray:
    """For every code point: -1 if it is no letter, else the place of its script in SCRIPT_NAMES."""
    out = np.array([0 if chr(c).isalpha() else -1 for c in range(0x110000)], dtype=np.int8)
    for name, first, last in SCRIPTS:
        part = out[first:last + 1]
        part[part == 0] = SCRIPT_NAMES.index(name)
    return out


@dataclass
class Model:
    """Log probabilities by language and bucket, and which scripts each language uses."""

    langs: list[str]
    logs: np.ndarray
    uses: np.ndarray


def word_letters(vocab: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Number of letters of each word, and counts of its letters by script."""
    points, starts = W.code_points(vocab)
    script = letter_scripts()[points]
    owner = np.repeat(np.arange(len(vocab)), np.diff(starts))
    letter = script >= 0
    n = len(SCRIPT_NAMES)
    by_script = np.bincount(owner[letter] * n + script[letter], minlength=len(vocab) * n).reshape(-1, n)
    return by_script.sum(axis=1), by_script


def lettered(texts: pa.Array) -> tuple[W.Words, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words, lower-cased, with n-gram buckets and letters of each distinct one.

    A word without a letter has no n-grams: it fits every language alike.
    """
    found = W.split_words(texts)
    vocab = pc.utf8_lower(found.vocab)
    letters, by_script = word_letters(vocab)
    hashes, offsets = W.ngram_hashes(vocab, NGRAMS, whole_word=False)
    keep = np.repeat(letters > 0, np.diff(offsets))
    kept = np.concatenate([[0], np.cumsum(keep)])[offsets]
    return found, (hashes[keep] % np.uint64(BUCKETS)).astype(np.int64), kept, letters, by_script


def fit(docs: DataFrame, per_lang: int = SAMPLE_PER_LANG, text: str = "text", lang: str = "lang") -> Model:
    """A model from about `per_lang` whole texts of each language, chosen by a hash of the text.

    Equal texts of a language count once, in its size and in the sample. If the hash takes none of a
    language's texts, that of the least hash stands for it. Rows with a null text or language take no part. Tasks count n-grams; what comes to the driver is
    one count for each language and bucket. An empty table gives a model without languages.
    """
    known = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).dropna()
    texts = known.select("lang", F.xxhash64("text").alias("hash")).distinct()
    found = texts.groupBy("lang").agg(F.count("*").alias("n"), F.min("hash").alias("least")).collect()
    sizes, least = ({r["lang"]: r[name] for r in found} for name in ("n", "least"))
    langs = sorted(sizes)
    if not langs:
        return Model([], np.zeros((0, BUCKETS)), np.zeros((0, len(SCRIPT_NAMES)), bool))
    shares = F.create_map(*[F.lit(x) for k in langs for x in (k, per_lang / sizes[k])])
    leasts = F.create_map(*[F.lit(x) for k in langs for x in (k, least[k])])
    taken = hashed_fraction(F.col("text"), shares[F.col("lang")]) | (F.xxhash64("text") == leasts[F.col("lang")])
    sample = known.filter(taken).distinct()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = np.array(batch.column("lang").to_pylist(), dtype=object)
            for name in sorted(set(of.tolist())):
                total = np.zeros(BUCKETS + len(SCRIPT_NAMES), dtype=np.int64)
                for chunk in W.text_chunks(batch.column("text").filter(pa.array(of == name)), W.NGRAM_CHUNK_BYTES):
                    found, bucket, offsets, _, by_script = lettered(chunk)
                    times = np.bincount(found.codes, minlength=len(found.vocab))
                    total[:BUCKETS] += np.bincount(
                        bucket, np.repeat(times, np.diff(offsets)), BUCKETS).astype(np.int64)
                    total[BUCKETS:] += times @ by_script
                at = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(at), pa.string()), pa.array(at), pa.array(total[at])], ["lang", "bucket", "n"])

    counts = np.zeros((len(langs), BUCKETS + len(SCRIPT_NAMES)))
    rows = sample.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    counts[pc.index_in(rows["lang"], pa.array(langs, pa.string())).to_numpy(), rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    grams, scripts = counts[:, :BUCKETS] + 0.5, counts[:, BUCKETS:]
    uses = scripts >= SCRIPT_SHARE * np.maximum(1, scripts.sum(axis=1, keepdims=True))
    return Model(langs, np.log(grams / grams.sum(axis=1, keepdims=True)), uses)


def steady(scores: np.ndarray, offsets: np.ndarray, best: np.ndarray) -> np.ndarray:
    """Texts whose best path surely stays in `best`, their language with the largest total.

    If no run of words gains more than half a switch by any other language, no path with switches
    wins: one with m runs in other languages saves at most m halves and pays at least m - 1 >= m / 2
    switches, or is one language throughout, which the largest total beats.
    """
    n, k = len(offsets) - 1, scores.shape[1]
    sizes = np.diff(offsets)
    owner = np.repeat(np.arange(n), sizes)
    gain = scores - scores[np.arange(len(owner)), best[owner]][:, None]
    at = np.arange(len(owner)) + owner + 1  # a zero stands before each text
    path = np.zeros((len(owner) + n, k))
    path[at] = gain
    path = np.cumsum(path, axis=0)
    first = offsets[:-1] + np.arange(n)
    whole = np.repeat(np.arange(n), sizes + 1)
    path -= path[first][whole]
    drop = (2 * np.abs(path).max(initial=0) + 1) * whole[:, None]
    low = np.minimum.accumulate(path - drop, axis=0) + drop
    most = np.maximum.reduceat((path - low).max(axis=1), first) if n else np.zeros(0)
    return most <= SWITCH / 2


def viterbi(scores: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Languages of the words of texts along their best paths; ties stay, then take the first.

    All texts take a step at a time: the longer ones go on when the shorter ones have ended.
    """
    order = np.argsort(-np.diff(offsets), kind="stable")
    first, sizes = offsets[:-1][order], np.diff(offsets)[order]
    steps = int(sizes.max(initial=0))
    going = np.searchsorted(-sizes, -np.arange(steps), side="left")  # texts with a word t
    own = np.arange(scores.shape[1], dtype=np.int16)
    back = np.zeros(scores.shape, dtype=np.int16)
    total = scores[first]
    for t in range(1, steps):
        now = total[:going[t]]
        top = now.argmax(axis=1)
        moved = np.take_along_axis(now, top[:, None], axis=1) - SWITCH
        better = moved > now
        at = first[:going[t]] + t
        back[at] = np.where(better, top[:, None].astype(np.int16), own)
        total[:going[t]] = np.where(better, moved, now) + scores[at]
    path, state = np.zeros(len(scores), dtype=np.int64), total.argmax(axis=1)
    for t in range(steps - 1, -1, -1):
        at = first[:going[t]] + t
        path[at] = state[:going[t]]
        state[:going[t]] = back[at, path[at]] if t else state[:going[t]]
    return path


def path_spans(model: Model, scores: list, counted: list, every: list) -> list[dict]:
    """Results of texts whose best path may switch."""
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in counted])]).astype(np.int64)
    path, out = viterbi(np.concatenate(scores), offsets), []
    for a, b, letters, n in zip(offsets[:-1], offsets[1:], counted, every):
        own = path[a:b]
        cuts = np.flatnonzero(np.diff(own)) + 1
        firsts, lasts = np.concatenate([[0], cuts]), np.concatenate([cuts - 1, [b - a - 1]])
        runs = np.add.reduceat(letters, firsts)
        share = np.bincount(own[firsts], runs, len(model.langs))
        out.append({"lang": model.langs[int(share.argmax())], "score": round(float(share.max() / n), 9), "spans": [
            {"first_word": int(f), "last_word": int(z), "lang": model.langs[own[f]], "letters": int(x)}
            for f, z, x in zip(firsts, lasts, runs)]})
    return out


def word_scores(texts: pa.Array, model: Model) -> tuple[W.Words, np.ndarray, np.ndarray, np.ndarray]:
    """Words of the texts, and for each distinct word its scores, its letters, and whether it counts.

    A script that a language doesn't use counts against it; a script that none uses counts for nothing.
    """
    found, bucket, starts, letters, by_script = lettered(texts)
    scores = np.stack([W.per_text(logs[bucket], starts) for logs in model.logs], axis=1)
    alien = by_script @ (~model.uses).T
    readable = alien.min(axis=1) == 0
    scores = np.where(readable[:, None], scores - WRONG_SCRIPT * (alien > 0), 0.0)
    return found, scores, letters, readable & (letters > 0)


def nearest_languages(texts: pa.Array, model: Model) -> list[str]:
    """Languages with the largest total score, whatever scripts they use; ties take the first."""
    found, bucket, starts, *_ = lettered(texts)
    scores = np.stack([W.per_text(logs[bucket], starts) for logs in model.logs], axis=1)
    return [model.langs[k] for k in W.per_text(scores[found.codes], found.offsets).argmax(axis=1)]


def identify_texts(texts: pa.Array, model: Model) -> list[dict]:
    """Language, score and spans of each text; see `identify`."""
    nothing = {"lang": UNDETERMINED, "score": 0.0, "spans": []}
    out: list[dict] = [nothing] * len(texts)
    pending: list[tuple] = []
    waiting, base = 0, 0

    def settle() -> None:
        for (i, *_), result in zip(pending, path_spans(model, *[[p[j] for p in pending] for j in (1, 2, 3)])):
            out[i] = result
        pending.clear()

    for chunk in W.text_chunks(texts, W.NGRAM_CHUNK_BYTES) if model.langs else []:
        found, of_word, letters, readable = word_scores(chunk, model)
        scores, weight = of_word[found.codes], letters[found.codes]
        counted = np.where(readable[found.codes], weight, 0)
        every, known = W.per_text(weight, found.offsets), W.per_text(counted, found.offsets)
        best = W.per_text(scores, found.offsets).argmax(axis=1)
        calm = steady(scores, found.offsets, best)
        alien = np.flatnonzero((every > 0) & (known == 0))
        for i, name in zip(alien, nearest_languages(chunk.take(pa.array(alien)), model) if len(alien) else []):
            out[base + i] = {"lang": name, "score": 0.0, "spans": [
                {"first_word": 0, "last_word": int(found.counts[i] - 1), "lang": name, "letters": 0}]}
        for i in np.flatnonzero(known):
            a, b = found.offsets[i], found.offsets[i + 1]
            if calm[i]:
                name = model.langs[best[i]]
                out[base + i] = {"lang": name, "score": round(float(known[i] / every[i]), 9), "spans": [
                    {"first_word": 0, "last_word": int(b - a - 1), "lang": name, "letters": int(known[i])}]}
            else:
                pending.append((base + i, scores[a:b].copy(), counted[a:b], every[i]))
                waiting += b - a
        if waiting > PATH_WORDS:
            settle()
            waiting = 0
        base += len(chunk)
    if pending:
        settle()
    return out


def identify(docs: DataFrame, model: Model, text: str = "text", out: str = "language") -> DataFrame:
    """`docs` with the struct column `out`: language, score and spans of each whole text.

    The language is the one with most letters along the best path, the score its share of all
    letters. A text in scripts that no language uses has the nearest language, score 0 and one span
    without letters. A null text, one without letters, or any text where the model holds no language
    is `und` with score 0 and no spans. Spans count words from 0. Row-local; a column `out` is replaced.
    """
    @F.arrow_udf(RESULT)
    def label(texts: pa.Array) -> pa.Array:
        return pa.array(identify_texts(texts, model), LABEL_TYPE)

    return docs.withColumn(out, label(F.col(text)))


LABEL_TYPE = pa.struct([
    ("lang", pa.string()), ("score", pa.float64()),
    ("spans", pa.list_(pa.struct([
        ("first_word", pa.int32()), ("last_word", pa.int32()), ("lang", pa.string()), ("letters", pa.int32())]))),
])
