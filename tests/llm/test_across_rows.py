"""Operators that compare rows, against comparing all pairs."""

import collections
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from compare import compare, connect
from llm.helpers import components, odd_docs, odd_texts, random_docs, shingles
from ticketlake.llm import ann, knn_join, lm_score, near_dup
from ticketlake.llm.common import staged
from ticketlake.llm.components import components as linked
from ticketlake.llm.components import large_star, small_star
from ticketlake.llm.queries import QUERIES
from ticketlake.session import settings


@pytest.mark.parametrize("size,percent", [(4, 80), (2, 60)])
def test_near_duplicates_equal_all_pairs(spark, size, percent):
    texts = random_docs(260, seed=size)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    rows = near_dup.near_duplicates(docs, size=size, percent=percent).collect()
    expected = components(list(enumerate(texts)), size, percent)
    assert len(rows) == len(texts) and len(set(expected.values())) < len(texts) - 40
    for r in rows:
        assert (r.component_id, r.n_shingles, r.kept) == (
            expected[r.doc_id], len(shingles(texts[r.doc_id], size)), expected[r.doc_id] == r.doc_id)


def test_near_duplicates_large_buckets(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK", (4, 16))
    base = [f"b{i}" for i in range(40)]
    texts = [" ".join(base[:i % 37] + [f"n{i}"] + base[i % 37 + 1:]) for i in range(120)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = near_dup.near_duplicates(docs, size=3, percent=80).collect()
    expected = components(list(enumerate(texts)), 3, 80)
    assert {r.doc_id: r.component_id for r in rows} == expected


def test_near_duplicates_broadcast_no_table_that_grows(spark, monkeypatch):
    """Bucket keys come from an explode, so Spark takes them for a table of a few KB."""
    plans = []

    def planned(df, purpose):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return staged(df, purpose)

    monkeypatch.setattr(near_dup, "staged", planned)
    texts = random_docs(400, seed=3)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "64k"}):
        left = near_dup.deduplicated(docs, size=4)
        plans.append(left._jdf.queryExecution().executedPlan().toString())
        kept = {r.doc_id for r in left.collect()}
    assert len(plans) == 8 and [i for i, plan in enumerate(plans) if "Broadcast" in plan] == []
    assert kept == set(components(list(enumerate(texts)), 4, 80).values())


def test_near_duplicates_odd_rows(spark):
    docs = odd_docs(spark, ", digest string")
    rows = near_dup.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by_id[0].component_id == 0 and by_id[0].n_shingles == 0 and by_id[2].kept and by_id[4].kept
    assert sum(r.doc_id is None and r.kept and r.component_id is None for r in rows) == 2
    left = near_dup.deduplicated(docs)
    assert left.columns == docs.columns and left.filter("doc_id = 4").count() == 1 and left.count() == len(odd_texts()) + 2
    assert near_dup.near_duplicates(docs.limit(0)).count() == 0


def near_copies():
    """Three texts of which each pair is alike, and a chain whose ends are not."""
    words = [f"w{i}" for i in range(100)]
    alike = [" ".join(words[:i] + ["x"] + words[i + 1:]) for i in (0, 50, 99)]
    chain = [" ".join(words), " ".join(words[12:]), " ".join(words[24:])]
    return alike, chain


def test_rows_without_an_id_link_others(spark):
    alike, chain = near_copies()
    docs = spark.createDataFrame([(None, alike[0]), (None, alike[1]), (5, alike[2])], "doc_id long, text string")
    assert {r.component_id for r in near_dup.near_duplicates(docs).collect()} == {5}
    assert [tuple(r) for r in near_dup.deduplicated(docs).collect()] == [(5, alike[2])]
    assert len(set(components(list(enumerate(chain)), 5, 80).values())) == 1
    assert len(set(components([(0, chain[0]), (1, chain[2])], 5, 80).values())) == 2
    bridge = spark.createDataFrame([(1, chain[0]), (None, chain[1]), (3, chain[2])], "doc_id long, text string")
    assert {r.component_id for r in near_dup.near_duplicates(bridge).collect()} == {1}


def test_each_text_of_an_id_links(spark):
    alike, _ = near_copies()
    docs = spark.createDataFrame([(1, "quite another text of six words"), (1, alike[0]), (2, alike[1])], "doc_id long, text string")
    assert [r.component_id for r in near_dup.near_duplicates(docs).collect()] == [1, 1, 1]
    assert {tuple(r) for r in near_dup.deduplicated(docs).collect()} == {(1, "quite another text of six words"), (1, alike[0])}


def test_one_row_is_kept_by_a_stated_rule(spark):
    alike, _ = near_copies()
    rows = [(None, alike[0], "b", {"k": 1}), (None, alike[0], "a", {"k": 2}), (None, alike[1], "a", {"k": 3}),
            (7, "", "z", None), (7, "", "y", None), (7, None, "x", None), (8, "one two", None, None), (8, "one two", "q", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string, row map<string,int>").repartition(4)
    left = [(r.doc_id, r.text, r.key) for r in near_dup.deduplicated(docs).collect()]
    group = [x for x in left if x[0] is None]
    assert len(group) == 1 and group[0] in {(None, alike[0], "a"), (None, alike[1], "a")}
    assert {x for x in left if x[0]} == {(7, "", "y"), (7, None, "x"), (8, "one two", None)} and len(left) == 4
    again = [(r.doc_id, r.text, r.key) for r in near_dup.deduplicated(docs.repartition(3)).collect()]
    assert sorted(map(str, again)) == sorted(map(str, left))


def test_sketch_estimate_is_near_the_similarity():
    rng = np.random.default_rng(1)
    for share in (0.5, 0.8, 0.95):
        pool = rng.integers(0, 1 << 63, 2000, dtype=np.uint64)
        cut = int(2000 * (1 - share) / 2)
        a, b = near_dup.registers(pool[cut:]), near_dup.registers(pool[:2000 - cut])
        sizes = np.array([2000 - cut])
        assert abs(near_dup.estimate(sizes, sizes, a[None], b[None])[0] - share) < 0.12
        merged = np.maximum(a, b)
        assert (merged == near_dup.registers(pool)).all()


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (None, 3)]
    found = {r.node: r.component for r in linked(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}}
    assert linked(spark.createDataFrame([], "a long, b long")).count() == 0


def test_knn_join_equals_its_sql(spark, sf):
    assert compare(spark, connect(sf), entry.queries()["op4_knn_join"], entry.oracle_sql()["op4_knn_join"], sf) is None


def odd_vectors(spark, kind):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 6)]) for i in range(300)]
    rows += [(i, rows[5][1]) for i in range(300, 420)] + [(420, None), (421, []), (422, [None] * 6), (423, [1.0] * 4), (None, [1.0] * 6)]
    rows += [rows[7], (424, [0.0] * 6)]
    if kind == "double":
        rows += [(425, [float("nan")] * 6), (426, [float("inf")] * 6)]
    return spark.createDataFrame(rows, "vec_id long, v array<double>").withColumn("v", F.col("v").cast(f"array<{kind}>")), rows


def brute_top(rows, queries, k):
    usable = [(i, v) for i, v in rows if i is not None and v and len(v) == 6 and None not in v and all(map(math.isfinite, v))]
    out = []
    for q, qv in usable:
        if queries(q):
            ranked = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, v in usable if i != q)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(ranked)]
    return sorted(out)


def test_knn_join_ties_copies_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(knn_join.V, "BLOCK_ROWS", 50)
    monkeypatch.setattr(knn_join.V, "BLOCK_QUERIES", 7)
    data, rows = odd_vectors(spark, "long")
    found = knn_join.top_products(data, data.filter("vec_id % 11 = 0"), 9, vector="v").collect()
    assert sorted(tuple(r) for r in found) == brute_top(rows, lambda i: i % 11 == 0, 9)
    assert knn_join.top_products(data.limit(0), data, 9, vector="v").count() == 0
    few = data.filter("vec_id < 3")
    assert knn_join.top_products(few, few, 9, vector="v").count() == 6


def test_ann_ties_copies_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(ann.V, "BLOCK_ROWS", 100)
    data, rows = odd_vectors(spark, "double")
    rows = [(i, v) for i, v in rows if i != 424]
    found = ann.nearest(data, data.filter("vec_id % 11 = 0"), 9, vector="v").collect()
    expected = brute_top(rows, lambda i: i % 11 == 0, 9)
    assert len(found) == len(expected)
    scores = {(q, n): s for q, n, _, s in expected}
    assert np.mean([abs(scores[r.query_id, r.rank] - r.score) < 1e-9 for r in found]) > 0.8
    assert ann.nearest(data.limit(0), data, 9, vector="v").count() == 0
    few = data.filter("vec_id < 3")
    assert ann.nearest(few, few, 9, vector="v").count() == 6


def test_ann_recall(spark):
    sf = "/root/testdata/sf0.1"
    table = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    ids, x = table["vec_id"].to_numpy(), np.stack(table["embedding"]).astype(float)
    found = collections.defaultdict(set)
    for r in QUERIES["op8_ann"](spark, sf).collect():
        found[r.query_id].add(r.vec_id)
    hits = 0
    for query, mine in found.items():
        at = int(np.flatnonzero(ids == query)[0])
        scores = x @ x[at]
        scores[at] = -np.inf
        hits += len(mine & set(ids[np.argsort(-scores)[:20]]))
    assert hits / (20 * len(found)) >= 0.9


def test_index_finds_every_code_within_the_radius():
    codes = np.random.default_rng(3).integers(0, 1 << 16, (3000, 4)).astype(np.uint16)
    codes[:500, 0] &= 3
    index = ann.Index(codes)
    for i in (0, 7, 2000):
        for radius in (0, 3, 4, 11, 20, 30, 45, 64):
            assert index.within(codes[i], radius).tolist() == np.flatnonzero(ann.hamming(codes, codes[i]) <= radius).tolist()


def test_index_probes_spare_rows_where_the_radius_is_small():
    codes = np.random.default_rng(3).integers(0, 1 << 16, (3000, 4)).astype(np.uint16)
    assert ann.Index(codes).candidates(codes[0], 7).sum() < 60
    for radius in range(64):  # no row that the rule leaves out is within the radius
        probed = ann.Index(codes).candidates(codes[1], radius)
        assert (ann.hamming(codes[~probed], codes[1]) > radius).all()


def plain_scores(corpus, texts, order):
    """Stupid backoff by counting; a word that the corpus lacks counts once."""
    split = [(t or "").encode().split() for t in corpus]
    counts = collections.Counter(
        tuple(w[i:i + k]) for w in split for k in range(1, order + 1) for i in range(len(w) - k + 1))
    total = sum(map(len, split)) or 1

    def word(gram):
        if len(gram) == 1:
            return math.log(max(1, counts[gram]) / total)
        if counts[gram]:
            return math.log(counts[gram] / counts[gram[:-1]])
        return math.log(lm_score.ALPHA) + word(gram[1:])

    found = []
    for w in [(t or "").encode().split() for t in texts]:
        found.append((len(w), sum(word(tuple(w[max(0, i - order + 1):i + 1])) for i in range(len(w)))))
    return found


def same_scores(found, ids, expected):
    rows = sorted((str(r.doc_id), r.n_tokens, r.log_score, r.mean_log_score) for r in found.collect())
    expected = sorted((str(i), n, round(s, 6), round(s / n, 9) if n else None) for i, (n, s) in zip(ids, expected))
    assert [x[:2] for x in rows] == [x[:2] for x in expected]
    for a, b in zip(rows, expected):
        assert a[2] == pytest.approx(b[2], rel=1e-8, abs=2e-6)
        assert a[3] == pytest.approx(b[3], abs=1e-8) if b[3] is not None else a[3] is None


@pytest.mark.parametrize("order, frequent", [(1, 8), (2, 131_072), (2, 8), (3, 0), (3, 50)])
def test_lm_scores_equal_plain_counting(spark, monkeypatch, order, frequent):
    monkeypatch.setattr(lm_score, "FREQUENT", frequent)
    monkeypatch.setattr(lm_score, "CHUNK_BYTES", 20_000)
    texts = random_docs(150, seed=9) + odd_texts() + ["again and again"] * 3 + [None]
    ids = [*range(150), *range(200, 200 + len(odd_texts())), 500, 500, None, None]
    docs = spark.createDataFrame([(i, t, "z") for i, t in zip(ids, texts)], "doc_id long, text string, score string").repartition(3)
    expected = plain_scores(texts, texts, order)
    same_scores(lm_score.score_documents(docs, order=order), ids, expected)
    if frequent == 50:
        same_scores(lm_score.score_against(docs, docs, order=order), ids, expected)
    assert lm_score.score_documents(docs.limit(0), order=order).count() == 0


@pytest.mark.parametrize("order", [1, 2, 3])
def test_lm_scores_back_off_in_other_documents(spark, order):
    corpus = [t for t in random_docs(80, seed=4, vocabulary=60)]
    texts = random_docs(40, seed=5, vocabulary=80) + odd_texts()
    ids = list(range(len(texts)))
    docs = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    known = spark.createDataFrame(list(enumerate(corpus)), "doc_id long, text string")
    same_scores(lm_score.score_against(docs, known, order=order), ids, plain_scores(corpus, texts, order))
    same_scores(lm_score.score_against(docs, known.limit(0), order=order), ids, plain_scores([], texts, order))


def test_lm_scores_equal_their_sql(spark, sf):
    assert compare(spark, connect(sf), entry.queries()["op9_lm_score"], entry.oracle_sql()["op9_lm_score"], sf) is None


def test_lm_scores_fold_no_word_of_a_long_corpus(spark):
    texts = ["w " * 2_200_000, "once", "twice seen w", "w twice seen", "w other"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    n, w = 2_200_009, 2_200_003
    first, after = math.log(w / n), math.log(1 / w)
    expected = [
        first + 2_199_999 * math.log(2_199_999 / w), math.log(1 / n), math.log(2 / n) + math.log(2 / 2) + math.log(1 / 2),
        first + after + math.log(2 / 2), first + after]
    found = [r.log_score for r in lm_score.score_documents(docs).orderBy("doc_id").collect()]
    assert found == pytest.approx(expected, abs=2e-3)


def test_stars_leave_no_broadcast_in_the_driver(spark):
    edges = spark.range(5).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    stars = small_star(large_star(edges))
    assert "Broadcast" not in stars._jdf.queryExecution().executedPlan().toString()
    assert {(r.node, r.component) for r in linked(edges).collect()} == {(n, 0) for n in range(6)}
