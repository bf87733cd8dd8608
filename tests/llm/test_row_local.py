"""Operators that work row by row, against plain versions and over odd rows."""

import base64
import hashlib
import re
import time
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from compare import compare, connect
from llm.helpers import DOCS, LONG, odd_docs, odd_texts
from ticketlake.llm import bpe, language_id, packing, pii, quality, url_filter
from ticketlake.llm.queries import QUERIES


def test_url_filter_equals_its_sql(spark, sf):
    assert compare(spark, connect(sf), entry.queries()["op1_url_filter"], entry.oracle_sql()["op1_url_filter"], sf) is None


def test_url_filter_odd_rows(spark):
    urls = [None, "", "nourl", "http://", "https://COM", "https://a.Com/x?y", "http://xcom/", "ftp://www.example.com/en/a#b",
            "http://example.com/en/", "http://example.com?/en/", "http://a..net/es/" + "p" * 9000, "x://net/es/://com/"]
    pages = spark.createDataFrame([(i, u, "old") for i, u in enumerate(urls)] + [(None, urls[5], "old")] * 2,
                                  "page_id long, url string, verdict string")
    rules = spark.createDataFrame(
        [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/es/"), (None, "net", "/"), ("block", None, "/")],
        "action string, host string, path string")
    got = {(r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_filter.filter_urls(pages, rules).collect()}
    assert url_filter.filter_urls(pages, rules).count() == 14
    assert (4, "com", "", None, "allow") in got and (5, "a.com", "/x", "com/", "allow") in got
    assert (6, "xcom", "/", None, "allow") in got and (7, "www.example.com", "/en/a", "www.example.com/en/", "allow") in got
    assert (8, "example.com", "/en/", "example.com/en/", "block") in got and (9, "example.com", "", None, "allow") in got
    assert (10, "a..net", "/es/" + "p" * 9000, "net/es/", "block") in got
    assert (11, "net", "/es/://com/", "net/es/", "block") in got and (None, "a.com", "/x", "com/", "allow") in got
    assert {r[1:] for r in got if r[0] in (0, 1, 2, 3)} == {("", "", None, "allow")}
    assert {r.verdict for r in url_filter.filter_urls(pages, rules.limit(0), default="block").collect()} == {"block"}
    assert url_filter.filter_urls(pages.limit(0), rules).count() == 0


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def plain_spans(text):
    def valid(kind, match):
        digits = re.sub("[^0-9]", "", match)
        return {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in match.split(".")),
                "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]

    found = [(m.start(), i, kind, m.end()) for i, kind in enumerate(BASE)
             for m in re.finditer(BASE[kind], text or "", re.ASCII) if valid(kind, m.group())]
    return ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in sorted(found))


PII_TEXTS = [
    "a@b.com_x@c.org, a@b..c @x.y é😀 z@q.de-", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.255 1.2.3", "x.a.b@c.d@e.f",
    "4111 1111 1111 1111 and 4111-1111-1111-1112, 4111  1111", "+1 (017) 555-7713. +12 +1 2345678(9 +1 23456789",
    "9" * 4000 + "." + "9" * 4000, "a" * 4000 + "@", "a@" + "b." * 4000 + "c", "+1" + " " * 4000 + "2",
    "card 4111111111111111 8.8.8.8 +49 30 1234567",
]


def test_pii_equals_plain_python(spark):
    texts = odd_texts() + PII_TEXTS
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    base = [k.name for k in pii.KINDS]
    found = pii.find_pii(docs).select("doc_id", pii.spans_text(F.filter("pii", lambda s: s["kind"].isin(base))).alias("s"))
    for row in found.collect():
        assert row.s == plain_spans(texts[row.doc_id]), texts[row.doc_id]


def test_pii_added_kind_scores_and_masks(spark):
    text = "bank GB82 WEST 1234 5698 7654 32 or GB82 WEST 1234 5698 7654 33, mail a@b.de\nxé1.2.3.4"
    docs = spark.createDataFrame([(1, text, 5), (1, text, 5), (2, None, 5)], "doc_id long, text string, pii int")
    rows = pii.find_pii(docs).select("doc_id", "pii", pii.masked(F.col("text"), F.col("pii")).alias("m")).collect()
    assert len(rows) == 3 and rows[0] == rows[1] and not rows[2].pii and rows[2].m is None
    spans = {s.kind: s for s in rows[0].pii}
    assert spans["iban"].value == "GB82 WEST 1234 5698 7654 32" and spans["iban"].score == 1.0
    assert spans["email"].score == 0.95 and spans["ip"].score == 0.4
    assert rows[0].m == "bank [IBAN] or GB82 WEST 1234 5698 7654 33, mail [EMAIL]\nxé[IP]"


def plain_mask(text, spans):
    out, at = [], 0
    for s in spans:
        if s.start >= at:
            out += [text[at:s.start], f"[{s.kind.upper()}]"]
        at = max(at, s.end)
    return "".join(out) + text[at:]


def test_pii_positions_in_blocks_and_pieces(spark, monkeypatch):
    """Context, positions and masks are the same whatever the sizes of blocks and pieces."""
    texts = PII_TEXTS + ["mail é😀a@b.de " * 9 + "x" * 90 + " 4111 1111 1111 1111, +49 4111 1111 1111 1111 " * 5, "naïve 😀" * 40, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = []
    for block, piece in ((256, 256), (2, 7), (3, 64)):
        monkeypatch.setattr(pii, "SCAN_BLOCK", block)
        monkeypatch.setattr(pii, "PIECE_CHARS", piece)
        rows = pii.find_pii(docs).select("*", pii.masked(F.col("text"), F.col("pii")).alias("m")).orderBy("doc_id").collect()
        assert [r.m for r in rows] == [plain_mask(r.text, r.pii) for r in rows]
        assert all(r.text[s.start:s.end] == s.value for r in rows for s in r.pii)
        found.append(rows)
    assert found[0] == found[1] == found[2] and sum(len(r.pii) for r in found[0]) > 20


def test_pii_of_a_very_long_text(spark):
    text = " ".join(f"mail user{i}@host{i % 7}.org 10.0.{i % 300}.7" for i in range(60_000))
    assert len(text) > 2_000_000
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    pii.find_pii(docs.limit(0)).count()
    start = time.time()
    row = pii.find_pii(docs).select("pii", pii.masked(F.col("text"), F.col("pii")).alias("m")).first()
    assert time.time() - start < 30
    assert len(row.pii) == 60_000 + sum(i % 300 < 256 for i in range(60_000)) and row.m == plain_mask(text, row.pii)


def test_bpe_equals_the_library_and_round_trips(spark):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs = odd_docs(spark).withColumn("decoded", F.lit(1))
    encoded = bpe.encode(docs, path, public_tokenizers.PATTERN)
    rows = bpe.decode(encoded, path, public_tokenizers.PATTERN).collect()
    assert len(rows) == docs.count()
    for row in rows:
        assert row.ids == plain.encode_ordinary(row.text or "")
        assert bytes(row.decoded) == (row.text or "").encode()
    assert bpe.encode(docs.limit(0), path, public_tokenizers.PATTERN).count() == 0


def test_perfect_hash_is_minimal_and_knows_its_keys():
    keys = [str(i).encode() for i in range(5000)]
    found = bpe.PerfectHash(keys)
    assert sorted(found.find(k) for k in keys) == list(range(5000))
    assert all(found.find(f"x{i}".encode()) == -1 for i in range(1000))


def test_packing_cuts_fills_and_loses_nothing(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    docs = odd_docs(spark, ", sequence_id string")
    pieces = packing.token_pieces(docs, path, 512, 1)
    rows = packing.pack(pieces, 512).collect()
    by_seq, by_doc = {}, {}
    for r in rows:
        by_seq.setdefault(r.sequence_id, []).append(r)
        by_doc.setdefault(r.doc_id, []).append(r)
    for members in by_seq.values():
        at = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 512
    for i, text in enumerate(odd_texts()):
        ids = plain.encode(text or "", add_special_tokens=False).ids + [1]
        parts = sorted(by_doc[i], key=lambda r: (r.piece, r.sequence_id, r.offset))
        copies = 3 if i == 4 else 1
        assert len(parts) == copies * -(-len(ids) // 512)
        for r in parts:
            assert bytes(r.ids) == np.array(ids[r.start:r.start + 512], dtype="<u4").tobytes() and r.start == 512 * r.piece
    assert len(by_seq) == -(-sum(r.length for r in rows) // 512)
    whole = {r.sequence_id: r for r in packing.sequences(packing.pack(pieces, 512)).collect()}
    assert sum(len(r.ids) for r in whole.values()) == 4 * sum(r.length for r in rows)
    assert packing.pack(pieces.limit(0), 512).count() == 0


def test_packing_encodes_each_text_once(spark):
    pieces = packing.token_pieces(odd_docs(spark), public_tokenizers.path("word_bpe_49k.json"), 4096, 1)
    digests = pieces.select("doc_id", "piece", "length", F.crc32("ids"))
    assert digests._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def test_packing_query_equals_plain_python(spark, sf):
    """The registered columns: ids of the library, cut, and gapless places in few sequences."""
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = set()
    for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        ids = plain.encode(r.text or "", add_special_tokens=False).ids + [1]
        for i in range(0, len(ids), 4096):
            part = ids[i:i + 4096]
            expected.add((r.doc_id, i // 4096, i, len(part), zlib.crc32(np.array(part, dtype="<u4").tobytes())))
    rows = QUERIES["op2_packing"](spark, sf).collect()
    assert len(rows) == len(expected)
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows} == expected
    at = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at.get(r.sequence_id, 0)
        at[r.sequence_id] = r.offset + r.length
    assert max(at.values()) <= 4096 and len(at) <= 1.02 * -(-sum(at.values()) // 4096) + 1


@pytest.mark.parametrize("seed", range(4))
def test_bin_plan_uses_all_pieces_near_the_bound(seed):
    rng = np.random.default_rng(seed)
    lengths = np.minimum(200, rng.geometric(0.02, 3000))
    counts = {int(k): int(n) for k, n in zip(*np.unique(lengths, return_counts=True))}
    used, bins = {}, 0
    for times, fill in packing.bin_plan(counts, 200):
        assert sum(k * n for k, n in fill.items()) <= 200
        bins += times
        for k, n in fill.items():
            used[k] = used.get(k, 0) + n * times
    assert used == counts and bins <= 1.01 * lengths.sum() / 200 + 1
    assert sum(k * n for k, n in packing.fullest([3, 5, 7], {3: 2, 5: 1, 7: 1}, 11)) == 11


def test_language_viterbi_equals_the_slow_path():
    rng = np.random.default_rng(5)
    sizes = [0, 1, 40, 7, 120]
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    scores = rng.normal(0, 6, (offsets[-1], 3))
    full = np.array([i for i, n in enumerate(sizes) if n])
    ends = np.concatenate([offsets[full], offsets[-1:]])
    path = language_id.viterbi(scores, ends)
    for a, b in zip(ends[:-1], ends[1:]):
        best = scores[a].copy()
        for t in range(a + 1, b):
            best = np.maximum(best, best.max() - language_id.SWITCH) + scores[t]
        own = path[a:b]
        value = scores[np.arange(a, b), own].sum() - language_id.SWITCH * (own[1:] != own[:-1]).sum()
        assert abs(value - best.max()) < 1e-9
        totals = scores[a:b].sum(axis=0)
        calm = language_id.steady(scores[a:b], np.array([0, b - a]), np.array([totals.argmax()]))
        assert not calm[0] or (own == totals.argmax()).all()


def test_language_held_out_accuracy_and_odd_rows(spark):
    sf = "/root/testdata/sf0.01"
    held = QUERIES["op3_language_id"](spark, sf).filter("held_out").join(
        spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    right, n = held.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 250 and right > 0.97
    docs = odd_docs(spark).withColumn("language", F.lit(3))
    model = language_id.fit(docs)
    rows = {r.doc_id: r.language for r in language_id.identify(docs, model).collect() if r.doc_id is not None}
    assert rows[0].lang == rows[1].lang == rows[10].lang == "und" and rows[4].lang == "en" and 0 <= rows[5].score <= 1
    empty = language_id.fit(docs.limit(0))
    assert {r.language.lang for r in language_id.identify(docs, empty).collect()} == {"und"}
    assert language_id.identify(docs.limit(0), model).count() == 0


def test_mixed_language_spans():
    langs = ["de", "en"]
    logs = np.zeros((2, language_id.BUCKETS))
    model = language_id.Model(langs, logs, np.ones((2, len(language_id.SCRIPT_NAMES)), dtype=bool))
    text = " ".join(["eins"] * 12 + ["seven"] * 9 + ["eins"] * 12)
    _, bucket, starts, *_ = language_id.lettered(pa.array([text], pa.large_string()))
    logs[0, bucket[starts[0]:starts[1]]] += 2
    logs[1, bucket[starts[1]:starts[2]]] += 2
    only = language_id.identify_texts(pa.array([text]), model)[0]
    assert [(s["first_word"], s["last_word"], s["lang"]) for s in only["spans"]] == [(0, 11, "de"), (12, 20, "en"), (21, 32, "de")]
    assert only["lang"] == "de" and abs(only["score"] - 96 / 141) < 1e-6


def test_quality_held_out_and_odd_rows(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = QUERIES["op10_quality"](spark, sf).filter("held_out").join(labels, "doc_id").collect()
    good, bad = [r.predicted for r in rows if r.quality], [r.predicted for r in rows if not r.quality]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.3
    docs = odd_docs(spark).withColumn("score", F.lit("x"))
    for model in (quality.fit(docs, labels.limit(0)), quality.train([("good text", 1), ("%% &&", 0), ("fine words", 1)])):
        scored = quality.classify(docs, model).collect()
        assert len(scored) == docs.count() and all(0 <= r.score <= 1 for r in scored)
    assert quality.classify(docs.limit(0), model).count() == 0


def test_quality_training_takes_no_text_apart_in_the_driver(spark, monkeypatch):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet") for n in ("documents", "labels"))
    rows = quality.training_rows(docs, labels).orderBy("doc_id", "text").collect()
    expected = quality.train([(r["text"], r["quality"]) for r in rows])
    monkeypatch.setattr(quality, "features", None)  # here, not in the workers
    model = quality.fit(docs, labels)
    assert model.bias == expected.bias and np.array_equal(model.feature, expected.feature)


def test_long_text_counts_whole():
    model = quality.Model(np.zeros(quality.BUCKETS), 0.0)
    assert quality.scores(pa.array([LONG, None, ""]), model).tolist() == [0.5, 0.5, 0.5]
    assert zlib.crc32(hashlib.sha256(LONG.encode()).digest())


def test_letters_of_unlearned_scripts_get_a_learned_language(spark):
    rows = [(i, t, lang, None, None) for i, (t, lang) in enumerate(
        [("the cat sat", "en"), ("le chat dort", "fr"), ("Μῆνιν ἄειδε θεά", None), ("слово", None), ("12 34", None)])]
    docs = spark.createDataFrame(rows, DOCS)
    found = [r.language for r in language_id.identify(docs, language_id.fit(docs)).orderBy("doc_id").collect()]
    assert all(x.lang in ("en", "fr") and x.score == 0 and len(x.spans) == 1 for x in found[2:4])
    assert found[2].spans[0].last_word == 2 and found[4].lang == "und"
    kept = corpus_pipeline.known_language(spark, docs, "")
    assert {r.doc_id for r in kept.collect()} == {0, 1, 2, 3}
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert corpus_pipeline.known_language(spark, unlabelled, "").count() == 5


def test_pii_iban_ends_where_its_country_says(spark):
    ibans = ["ES91 2100 0418 4502 0005 1332", "AT61 1904 3002 3457 3201", "BE68539007547034", "DE89 3704 0044 0532 0130 00"]
    texts = [f"pay {a}{after}" for a in ibans for after in (" BIC CAIXESBB", " THANKS", " 2024", " A", ", ok")]
    texts.append(f"{ibans[2]} {ibans[0]} {ibans[1]}")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = [[s.value for s in r.pii if s.kind == "iban"] for r in pii.find_pii(docs).orderBy("doc_id").collect()]
    assert found == [[a] for a in ibans for _ in range(5)] + [[ibans[2], ibans[0], ibans[1]]]


def test_language_sample_counts_equal_texts_once(spark):
    texts = [(f"the cat number{i} sat", "en") for i in range(200)] + [(f"le chat numero{i} dort", "fr") for i in range(200)]
    once = spark.createDataFrame(texts, "text string, lang string")
    often = spark.createDataFrame(texts + [texts[0]] * 300 + [("ein Hund", "de")] * 400, "text string, lang string")
    model = language_id.fit(often, per_lang=20)
    plain = language_id.fit(once, per_lang=20)
    assert model.langs == ["de", "en", "fr"] and model.uses[0].any()
    assert np.array_equal(model.logs[1:], plain.logs)
    assert language_id.fit(often.filter("lang = 'de'").limit(400), per_lang=1).uses.any()
    few = spark.createDataFrame([(f"Hund{i}", "de") for i in range(3)] * 50, "text string, lang string")
    for size in (0.001, 1):
        assert language_id.fit(few, per_lang=size).uses.any()
