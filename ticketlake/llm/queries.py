"""One query for each operator over its whole table, next to its SQL where SQL can express it."""

from __future__ import annotations

import string
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketlake.llm import (
    alignment, ann, bpe, knn_join, language_id, lm_score, merkle, near_dup, packing, pii, quality, token_counts,
    url_filter, vectors)
from ticketlake.llm.common import id_fold, on_workers, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            on_workers(spark)
            return function(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return function

    return register


URL_RULES = [
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"), ("block", "net", "/fr/"),
]


@query("op1_url_filter", """
    WITH rules(action, host, path) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
        ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
    p AS (SELECT page_id,
        coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
        coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path FROM pages),
    best AS (SELECT p.host, p.path, max_by(r.host || r.path, length(r.host || r.path)) AS rule,
            max_by(r.action, length(r.host || r.path)) AS action
        FROM (SELECT DISTINCT host, path FROM p) p JOIN rules r
          ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path) GROUP BY ALL)
    SELECT page_id, p.host, p.path, rule, coalesce(action, 'allow') AS verdict
    FROM p LEFT JOIN best USING (host, path)""")
def op1_url_filter(spark, sf):
    values = ", ".join(f"('{action}', '{host}', '{path}')" for action, host, path in URL_RULES)
    rules = spark.sql(f"SELECT * FROM VALUES {values} AS rules(action, host, path)")
    found = url_filter.filter_urls(table(spark, sf, "pages"), rules)
    return found.select("page_id", "host", "path", "rule", "verdict")


SEQUENCE_TOKENS, END_ID = 4096, 1


@query("op2_packing")
def op2_packing(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    pieces = packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"), SEQUENCE_TOKENS, END_ID)
    digests = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(digests, SEQUENCE_TOKENS)


@query("op3_language_id")
def op3_language_id(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    fold = id_fold(F.col("doc_id"), 3)
    model = language_id.fit(docs.filter(fold != 1))
    return language_id.identify(docs, model).select(
        "doc_id", F.coalesce(fold == 1, F.lit(False)).alias("held_out"), F.col("language.lang").alias("lang_pred"),
        "language.score", F.size("language.spans").alias("n_spans"))


@query("op5_pii")
def op5_pii(spark, sf):
    base = [kind.name for kind in pii.KINDS]
    found = pii.find_pii(table(spark, sf, "documents").select("doc_id", "text"))
    kinds = F.transform("pii", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in base]
    return found.select(
        "doc_id", *counts,
        F.sha2(pii.spans_text(F.filter("pii", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        pii.spans_text(F.col("pii")).alias("spans"),
    )


@query("op6_bpe")
def op6_bpe(spark, sf):
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = bpe.encode(table(spark, sf, "documents").select("doc_id", "text"), *vocabulary).drop("text")
    decoded = bpe.decode(encoded, *vocabulary)
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


#: Score from which on a document counts as good.
GOOD = 0.3


@query("op10_quality")
def op10_quality(spark, sf):
    docs, labels = table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "labels")
    model = quality.fit(docs, labels.filter(id_fold(F.col("doc_id"), 5) != 0))
    held_out = F.coalesce(id_fold(F.col("doc_id"), 5) == 0, F.lit(False))
    scored = quality.classify(docs.withColumn("held_out", held_out), model)
    return scored.select("doc_id", "held_out", "score", F.when(F.col("score") >= GOOD, 1).otherwise(0).alias("predicted"))


@query("op7_near_dup", r"""
    WITH RECURSIVE w AS (SELECT doc_id, [x for x in string_split_regex(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') if x <> ''] AS words
        FROM documents),
    s AS (SELECT DISTINCT doc_id, unnest(CASE
            WHEN len(words) >= 4 THEN [array_to_string(words[i:i + 3], ' ') for i in range(1, len(words) - 2)]
            WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS shingle FROM w),
    n AS (SELECT doc_id, count(*) AS size FROM s GROUP BY doc_id),
    c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
        GROUP BY 1, 2),
    l AS (SELECT a, b FROM c JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * shared >= 80 * (x.size + y.size - shared)),
    e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
    r(doc_id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.other = e.a),
    m AS (SELECT doc_id, min(other) AS component_id FROM r GROUP BY doc_id)
    SELECT doc_id, coalesce(size, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
    FROM documents LEFT JOIN n USING (doc_id) JOIN m USING (doc_id)""")
def op7_near_dup(spark, sf):
    return near_dup.near_duplicates(table(spark, sf, "documents"), size=4, percent=80)


TOP, QUERY_STEP = 20, 20


@query("op4_knn_join", """
    WITH v AS (SELECT vec_id, [floor(64 * x::DOUBLE) for x in embedding]::DOUBLE[] AS v FROM embeddings
        WHERE embedding IS NOT NULL AND len([1 for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
    s AS (SELECT q.vec_id AS query_id, d.vec_id, list_inner_product(q.v, d.v)::BIGINT AS score
        FROM v q JOIN v d ON q.vec_id <> d.vec_id WHERE q.vec_id % 20 = 0)
    SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
    WHERE rank <= 20""")
def op4_knn_join(spark, sf):
    rows = table(spark, sf, "embeddings").filter(vectors.usable(F.col("embedding"))).select(
        "vec_id", F.transform("embedding", lambda x: F.floor(x.cast("double") * 64)).alias("vector"))
    return knn_join.top_products(rows, rows.filter(F.col("vec_id") % QUERY_STEP == 0), TOP)


@query("op8_ann")
def op8_ann(spark, sf):
    rows = table(spark, sf, "embeddings").select("vec_id", "embedding")
    return ann.nearest(rows, rows.filter(F.col("vec_id") % QUERY_STEP == 0), TOP)


@query("op9_lm_score", r"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id,
            [x for x in string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') if x <> ''] AS words FROM documents),
    u AS (SELECT r, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM d),
    p AS (SELECT *, lag(w) OVER (PARTITION BY r ORDER BY i) AS v FROM u),
    ones AS (SELECT w, count(*) AS n FROM u GROUP BY w),
    twos AS (SELECT v, w, count(*) AS n FROM p WHERE i > 1 GROUP BY v, w),
    s AS (SELECT r, ln(n) - ln((SELECT count(*) FROM u)) AS score FROM u JOIN ones USING (w) WHERE i = 1
        UNION ALL SELECT r, ln(twos.n) - ln(ones.n) FROM p JOIN twos USING (v, w) JOIN ones ON ones.w = p.v),
    t AS (SELECT r, sum(score) AS score FROM s GROUP BY r)
    SELECT doc_id, len(words)::BIGINT AS n_tokens, round(coalesce(score, 0), 6) AS log_score,
        round(score / len(words), 9) AS mean_log_score FROM d LEFT JOIN t USING (r)""")
def op9_lm_score(spark, sf):
    return lm_score.score_documents(table(spark, sf, "documents"))


def _merkle_sql(depth: int = 7) -> str:
    """Trees of up to 16 to the power of `depth` leaves: levels up, then siblings and folds from the leaf."""
    def field(column: str) -> str:
        return f"CASE WHEN {column} IS NULL THEN '-' ELSE strlen({column}::VARCHAR)::VARCHAR || ':' || {column}::VARCHAR END"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(map(field, ["doc_id", "source", "lang", "n_chars", text])) + ")"

    def tree(name: str, key: str, leaves: str) -> str:
        """Levels `{name}0` to `{name}{depth}` over leaves, and `{name}root`."""
        parts = [f"{name}0 AS ({leaves})"]
        for i in range(1, depth + 1):
            parts.append(f"""{name}{i} AS (SELECT {key}, CASE WHEN n > 1 THEN r // 16 ELSE r END AS r,
                CASE WHEN n > 1 THEN sha256(string_agg(h, '' ORDER BY r)) ELSE any_value(h) END AS h, (n + 15) // 16 AS n
                FROM {name}{i - 1} GROUP BY {key}, CASE WHEN n > 1 THEN r // 16 ELSE r END, n)""")
        return ", ".join(parts)

    def climb(name: str, key: str, tree: str, start: str) -> str:
        """Siblings and folds of every row of `start`, whose rank is r, level by level."""
        parts = [f"{name}0 AS ({start})"]
        for i in range(1, depth + 1):
            same = f"{tree}{i - 1} t WHERE t.{key} = u.{key} AND t.r // 16 = u.r // 16 AND t.n > 1"
            parts.append(f"""{name}{i} AS (SELECT * EXCLUDE (r, proof, folded), r // 16 AS r, proof || coalesce(
                (SELECT string_agg(t.h, '' ORDER BY t.r) FROM {same} AND t.r <> u.r), '') AS proof, coalesce(
                (SELECT sha256(string_agg(CASE WHEN t.r = u.r THEN u.folded ELSE t.h END, '' ORDER BY t.r)) FROM {same}),
                folded) AS folded FROM {name}{i - 1} u)""")
        return ", ".join(parts)

    crc = ("xor(list_reduce([ord(x) FOR x IN string_split(doc_id::VARCHAR, '')], lambda c, b: list_reduce(range(8),"
           " lambda d, k: xor(d >> 1, 3988292384 * (d & 1)), xor(c, b::BIGINT)), 4294967295::BIGINT), 4294967295)")
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
        WITH d AS (SELECT doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS s, {leaf('text')} AS leaf,
            CASE WHEN {crc} % 5 = 0 THEN {leaf(lowered)} END AS tampered FROM documents),
        l AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r,
            count(*) OVER (PARTITION BY s) AS n FROM d),
        {tree('a', 's', 'SELECT s, r, leaf AS h, n FROM l')},
        {tree('b', 'g', f'SELECT 0 AS g, s AS r, h, count(*) OVER () AS n FROM a{depth}')},
        {climb('u', 's', 'a', "SELECT doc_id, s, leaf, r, '' AS proof, coalesce(tampered, leaf) AS folded FROM l")},
        {climb('v', 'g', 'b', f'SELECT doc_id, 0 AS g, s, leaf, s AS r, proof, folded FROM u{depth}')}
        SELECT doc_id, leaf, a{depth}.h AS subroot, b{depth}.h AS root, sha256(proof) AS proof_sha256,
               folded AS folded_root, folded = b{depth}.h AS verified
        FROM v{depth} v JOIN a{depth} ON v.s = a{depth}.s, b{depth}"""


@query("op11_merkle", _merkle_sql())
def op11_merkle(spark, sf):
    docs = table(spark, sf, "documents")
    parts = ["doc_id", "source", "lang", "n_chars"]
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    leaves = docs.select(
        F.col("source").alias("group"), F.col("doc_id").alias("order"), merkle.digest(*map(F.col, parts), F.col("text")).alias("digest"),
        F.struct("doc_id", F.when(chosen, merkle.digest(*map(F.col, parts), lowered)).alias("tampered")).alias("row"))
    proved = merkle.proofs(merkle.manifest(leaves), F.col("row.tampered"))
    return proved.select(
        "row.doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


@query("op12_alignment")
def op12_alignment(spark, sf):
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    aligned = alignment.align_tokenizers(table(spark, sf, "documents").select("doc_id", "text"), *paths)
    return aligned.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@query("op13_token_counts")
def op13_token_counts(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model"), SEQUENCE_TOKENS)
