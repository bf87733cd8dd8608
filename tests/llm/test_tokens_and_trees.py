"""Merkle manifest, tokenizer alignment and token counts against plain Python and the libraries."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from compare import compare, connect
from conftest import rows
from llm.helpers import DOCS, odd_docs, odd_texts
from ticketlake.llm import alignment, merkle, token_counts
from ticketlake.llm.common import on_workers
from ticketlake.llm.packing import byte_letters
from ticketlake.llm.queries import ORACLE, QUERIES

public_tokenizers = pytest.importorskip("public_tokenizers")
A, B = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
SMALL = "/root/testdata/sf0.001"


def as_table(folder, name, df):
    df.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def random_texts(n, seed, longest=40):
    rng = random.Random(seed)
    letters = ["a", "e", "▁", " ", " ", "  ", "\n", "é", "東", "京", "x", "7", ".", "<s>", "<|endoftext|>", "\x00", "🙂", "the",
               " the", "'s", "\t", "ا", "क", "ि", " ", "　", "ing", "<0x0A>"]
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, longest))) for _ in range(n)]


# --- Merkle manifest ---------------------------------------------------------------------------------
def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row, change=lambda t: t):
    parts = [row["doc_id"], row["source"], row["lang"], row["n_chars"], row["text"] and change(row["text"])]
    return sha("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in parts))


def plain_tree(leaves):
    """Levels of a tree, the last one its root alone."""
    made = [leaves]
    while len(made[-1]) > 1:
        made.append([sha("".join(made[-1][i:i + 16])) for i in range(0, len(made[-1]), 16)])
    return made


def plain_path(made, at):
    """(digests before, digests after) of the siblings at each level."""
    out = []
    for level in made[:-1]:
        run = level[at // 16 * 16:at // 16 * 16 + 16]
        out.append((run[:at % 16], run[at % 16 + 1:]))
        at //= 16
    return out


def plain_merkle(docs):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    groups = collections.defaultdict(list)
    for row in docs:
        groups[row["source"]].append((row["doc_id"] is not None, row["doc_id"], plain_leaf(row), row))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for name in names:
        groups[name].sort(key=lambda x: (x[0], x[1] or 0, x[2]))
        trees.append(plain_tree([x[2] for x in groups[name]]))
    top = plain_tree([t[-1][0] for t in trees])
    for s, name in enumerate(names):
        for i, (_, doc_id, leaf, row) in enumerate(groups[name]):
            path = plain_path(trees[s], i) + plain_path(top, s)
            proof = sha("".join("".join(x + y) for x, y in path))
            changed = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0
            node = plain_leaf(row, lambda t: t.translate(lower)) if changed else leaf
            for before, after in path:
                node = sha("".join(before + [node] + after))
            yield doc_id, leaf, trees[s][-1][0], top[-1][0], proof, node, node == top[-1][0]


def merkle_tables(spark):
    many = [(i, f"Text {i}", "en" if i % 2 else None, f"s{i % 40}" if i % 3 else "hot", i) for i in range(700)]
    return {
        "groups of all sizes": spark.createDataFrame(many + [(9000, "alone", None, None, None)], DOCS),
        "odd": odd_docs(spark), "one group": spark.createDataFrame([(i, "A", "en", "s", 1) for i in range(257)], DOCS),
        "one leaf": spark.createDataFrame([(5, "A b", None, "s", 1)], DOCS), "empty": odd_docs(spark).limit(0),
    }


@pytest.mark.parametrize("name", ["groups of all sizes", "odd", "one group", "one leaf", "empty"])
def test_merkle_equals_plain_trees(spark, tmp_path, name):
    docs = merkle_tables(spark)[name]
    found = QUERIES["op11_merkle"](spark, as_table(tmp_path, "documents", docs))
    want = sorted(plain_merkle([r.asDict() for r in docs.collect()]), key=str)
    assert sorted((tuple(r) for r in found.collect()), key=str) == want


def test_merkle_equals_sql(spark):
    assert compare(spark, connect(SMALL), QUERIES["op11_merkle"], ORACLE["op11_merkle"], SMALL) is None


def test_merkle_intervals_nest(spark):
    leaves = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 50)).alias("group"),
        F.col("id").alias("order"), F.sha2(F.col("id").cast("string"), 256).alias("digest"), F.struct("id").alias("row"))
    trees = merkle.manifest(leaves)
    assert len(trees.groups) == 3 and len(trees.top) == 2
    for i, level in enumerate(trees.groups):
        found = level.collect()
        for r in found:
            assert [c.lo for c in r.children] == list(range(r.lo, r.hi + 1, 16 ** i))
            assert r.lo % 16 ** (i + 1) == 0 and r.hi == min(r.lo + 16 ** (i + 1), r["size"]) - 1
    proved = merkle.proofs(trees)
    assert proved.filter("folded_root = root").count() == 5000
    assert merkle.proofs(trees, F.lit("0" * 64)).filter("folded_root = root").count() == 0


# --- token counts ------------------------------------------------------------------------------------
def test_token_counts_equal_the_library(spark, tmp_path):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=B)
    texts = odd_texts() + random_texts(3000, 5) + ["東京" * 4000, "x" * 7000 + " y", " ".join("ab" * i for i in range(300))]
    docs = spark.createDataFrame([(i, t, None, None, None, "kept", 1) for i, t in enumerate(texts)],
                                 DOCS + ", over_limit string, n_tokens int")
    found = {r.doc_id: r for r in QUERIES["op13_token_counts"](spark, as_table(tmp_path, "documents", docs)).collect()}
    for i, text in enumerate(texts):
        n = len(library.encode(text or ""))
        assert (found[i].n_bytes, found[i].n_tokens, found[i].over_limit) == (len((text or "").encode()), n, n > 4096), text[:50]


def test_merging_together_equals_merging_alone():
    pieces = token_counts.pieces(B)
    words = sorted({w for t in random_texts(400, 6) for w in t.replace(" ", "▁").split("\n") if w})
    together = pieces.merged_together(pa.array(words, pa.large_string()))
    assert together.tolist() == [pieces.merged(w) for w in words]
    assert all(sum(map(pieces.merged, pieces.cut(w))) == pieces.merged(w) for w in words)


def test_whole_tokens_are_proved():
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=B)
    words = token_counts.pieces(B).words.to_pylist()
    assert len(words) > 15_000
    assert all(len(library.encode(w.replace("▁", " "))) == 1 for w in words if w)


# --- alignment ---------------------------------------------------------------------------------------
def plain_alignment(texts):
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    byte_of = {letter: i for i, letter in enumerate(byte_letters())}
    out, holds, most = {}, collections.Counter(), collections.Counter()
    for i, text in texts.items():
        a_ids = a.encode(" " + text, add_special_tokens=False).ids if text else []
        b_ids = b.encode(text) if text else []
        a_bytes = [bytes(byte_of[x] for x in a.id_to_token(t)) for t in a_ids]
        b_bytes = [bytes([int(b.id_to_piece(t)[3:5], 16)]) if b.is_byte(t) else b.id_to_piece(t).replace("▁", " ").encode()
                   for t in b_ids]
        if not text or not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
            out[i] = None
            continue
        ends = [np.cumsum([len(x) for x in each]).tolist() for each in (a_bytes, b_bytes)]
        places = [{end: i + 1 for i, end in enumerate(each)} for each in ends]
        common = sorted(places[0].keys() & places[1].keys())
        groups, at, links = [], [0, 0], collections.Counter()
        for end in common:
            until = [place[end] for place in places]
            groups.append((a_ids[at[0]:until[0]], b_ids[at[1]:until[1]]))
            at = until
            links.update((x, y) for x in groups[-1][0] for y in groups[-1][1])
        holds.update(links.keys())
        out[i] = (a_ids, b_ids, groups, links)
    for (x, _), n in holds.items():
        most[x] = max(most[x], n)
    rows_ = {}
    for i, found in out.items():
        if found is None:
            rows_[i] = (0, 0, 0, 0, 0, 0, "")
            continue
        a_ids, b_ids, groups, links = found
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        rows_[i] = (len(a_ids), len(b_ids), len(groups), sum(links.values()),
                    sum(n for pair, n in links.items() if holds[pair] == most[pair[0]]),
                    sum(n * holds[pair] for pair, n in links.items()), sha(text))
    return rows_


@pytest.mark.parametrize("frequent", [alignment.FREQUENT_PAIRS, 40, 0])
def test_alignment_equals_all_pairs(spark, tmp_path, monkeypatch, frequent):
    monkeypatch.setattr(alignment, "FREQUENT_PAIRS", frequent)
    monkeypatch.setattr(alignment, "WIDE_GROUP", 6)
    given = [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("text").limit(40).collect()]
    texts = dict(enumerate(odd_texts() + random_texts(300, 7) + given + given[:9] + ["▁", "a▁b", " ", "  "]))
    docs = spark.createDataFrame([(i, t, None, None, None, 3) for i, t in texts.items()], DOCS + ", pairs int")
    found = QUERIES["op12_alignment"](spark, as_table(tmp_path, "documents", docs)).collect()
    want = plain_alignment(texts)
    assert {r.doc_id: tuple(r)[1:] for r in found} == want


def test_alignment_of_repeated_rows_and_of_an_empty_table(spark):
    on_workers(spark)
    docs = odd_docs(spark, ", n_a string")
    found = alignment.align_tokenizers(docs, A, B)
    assert found.count() == docs.count() and found.columns.count("n_a") == 1
    assert found.filter("doc_id IS NULL").count() == 2
    assert alignment.align_tokenizers(docs.limit(0), A, B).collect() == []
    assert token_counts.count_tokens(docs.limit(0), B, 5).collect() == []


def test_gallop_equals_bisection():
    rng = np.random.default_rng(1)
    values = np.concatenate([np.cumsum(rng.integers(1, 5, n)) for n in (1, 7, 300, 0, 40)])
    offsets = np.cumsum([0, 1, 7, 300, 0, 40])
    which = rng.integers(0, 5, 2000)
    wanted = rng.integers(0, 900, 2000)
    got = alignment.gallop(wanted, offsets[which], offsets[which + 1], values)
    want = [offsets[w] + np.searchsorted(values[offsets[w]:offsets[w + 1]], x) for w, x in zip(which, wanted)]
    assert got.tolist() == want
