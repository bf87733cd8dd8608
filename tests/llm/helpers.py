"""Small tables with nulls, repeated rows, ties and clashing columns, and plain Python versions."""

import random
import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 97}x{i % 13}" for i in range(30_000))


def odd_texts():
    return [None, "", " \n\t ", "a", "One. two, THREE!", "it's 12,5 % off — naïve Σίσυφος 東京\u00a0x  y \n\n z",
            "<|endoftext|> a<b 'tis don't", "\u3000tab\tend ", "x" * 5000, LONG, "7" * 3000, "é" * 400]


def odd_docs(spark, extra=""):
    rows = [(i, t, None if i % 3 else "en", "src", None) for i, t in enumerate(odd_texts())]
    rows += [rows[4], rows[4], (None, "no id here", None, None, None), (None, None, None, None, None)]
    schema = DOCS + extra
    return spark.createDataFrame([r + ("z",) * (extra.count(",")) for r in rows], schema)


def random_docs(n, seed=1, vocabulary=300, length=60):
    """Texts with exact copies, near copies and chains of ever more distant ones."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)]
    texts = []
    while len(texts) < n:
        kind = rng.random()
        if texts and kind < 0.15:
            texts.append(rng.choice(texts))
        elif texts and kind < 0.55:
            copy = rng.choice(texts[-12:]).split()
            for _ in range(rng.randint(1, 4)):
                if copy:
                    copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy))
        else:
            texts.append(" ".join(rng.choice(words) for _ in range(rng.randint(0, 2 * length))))
    return texts


def shingles(text, size):
    words = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)}


def components(ids_texts, size, percent):
    """Smallest id that links reach, by comparing all pairs."""
    sets = {i: shingles(t, size) for i, t in ids_texts}
    top = {i: i for i in sets}

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    order = sorted(sets)
    for k, a in enumerate(order):
        for b in order[:k]:
            same = len(sets[a] & sets[b])
            if same and 100 * same >= percent * (len(sets[a]) + len(sets[b]) - same):
                x, y = sorted((root(a), root(b)))
                top[y] = x
    return {i: root(i) for i in sets}
