"""Registered queries of the text operators, and their SQL where DuckDB can
state them. Each query applies its operator with production parameters to
the whole table and derives the stated columns from the operator's result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corate.llm import exact_dedup, jaccard, language, lexical, licenses, negatives, packing, pieces, quality, secrets, suffixes, toxicity, urls
from corate.llm.common import crc_fold, read_table


def tokenizer_path(name: str) -> str:
    """Where the named public tokenizer file is."""
    import public_tokenizers

    return public_tokenizers.path(name)


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents", "doc_id", "text", *columns)


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return secrets.secret_digest(secrets.find_secrets(docs, secrets.fit_markov(docs)))


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_components(documents(spark, sf_dir), words=4, percent=85).drop("set_id")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality.quality_rules(docs, quality.fit_quality(docs, read_table(spark, sf_dir, "labels", "doc_id", "quality")))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf_dir))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), read_table(spark, sf_dir, "labels", "doc_id", "toxic")
    model = toxicity.fit_toxicity(docs.where(crc_fold("doc_id", 5) != 0), labels.where(crc_fold("doc_id", 5) != 0))
    return toxicity.score_documents(docs, model).select(
        "doc_id", F.coalesce(crc_fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s.start.cast("string"), s.end.cast("string"))), ",").alias("toxic_spans"),
    )


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.piece_digest(documents(spark, sf_dir), tokenizer_path("piece_bpe_32k.model"))


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages", "page_id", "url")
    decided = urls.with_rules(pages).where("rule is not null").withColumn("label", (F.col("rule_verdict") == "block").cast("int"))
    return urls.filter_urls(pages, urls.fit_urls(decided.select("url", "host", "path", "label")))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "lang")
    model = language.fit_languages(docs.where(crc_fold("doc_id", 4) != 2))
    return language.identify(docs, model).select(
        "doc_id", F.coalesce(crc_fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(documents(spark, sf_dir))


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeat_digest(suffixes.remove_repeats(documents(spark, sf_dir), length=100, digest=True))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings", "vec_id", "label", "embedding")
    label = F.col("label").cast("long")
    moved = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))
    return negatives.mine(moved, F.col("vec_id") % 100 == 0, "embedding", positives=5, negatives=5, low=80, high=100)


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark", "item_id", "text"), k=20)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_secret_scan, op2_ngram_jaccard, op3_quality_rules, op4_exact_dedup, op5_toxicity,
        op6_best_fit_packing, op7_sentencepiece, op8_url_filters, op9_language_id, op10_license_scan,
        op11_suffix_dedup, op12_hard_negatives, op13_ranked_search,
    )
}

ORACLES = {
    "op2_ngram_jaccard": """
        WITH RECURSIVE worded AS (
          SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        shingled AS (
          SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                 ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i : i + 3], ' ')) END) AS g FROM worded),
        token AS (SELECT doc_id, len(g) AS n, unnest(g) AS t FROM shingled),
        link AS (
          SELECT a.doc_id AS a, b.doc_id AS b FROM token a JOIN token b ON a.t = b.t AND a.doc_id <> b.doc_id
          GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
        reach AS (
          SELECT doc_id AS node, doc_id AS root FROM documents
          UNION SELECT l.b, r.root FROM reach r JOIN link l ON l.a = r.node WHERE r.root < l.b)
        SELECT doc_id, CAST(len(g) AS BIGINT) AS n_shingles, min(root) AS component_id
        FROM shingled JOIN reach ON node = doc_id GROUP BY doc_id, len(g)
    """,
    "op4_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, text_sha256
        FROM (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
              FROM documents)
        WINDOW w AS (PARTITION BY text_sha256)
    """,
    "op11_suffix_dedup": """
        WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
        starting AS (
          SELECT doc_id, s, md5_number(substr(h, 2 * s + 1, 200)) AS string
          FROM (SELECT doc_id, h, unnest(range(0, n - 99)) AS s FROM d WHERE n >= 100)),
        again AS (
          SELECT doc_id, s, s + 100 AS e FROM starting
          QUALIFY row_number() OVER (PARTITION BY string ORDER BY doc_id, s) > 1),
        reach AS (SELECT *, max(e) OVER (PARTITION BY doc_id ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r FROM again),
        run AS (SELECT *, sum(CASE WHEN r >= s THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY s) AS k FROM reach),
        span AS (SELECT doc_id, k, min(s) AS s, max(e) AS e FROM run GROUP BY doc_id, k),
        gap AS (SELECT doc_id, s, e, lag(e, 1, 0) OVER (PARTITION BY doc_id ORDER BY s) AS since FROM span),
        part AS (
          SELECT doc_id, sum(e - s) AS n_removed, count(*) AS n_spans, max(e) AS last,
                 string_agg(substr(h, 2 * since + 1, 2 * (s - since)), '' ORDER BY s) AS before
          FROM gap JOIN d USING (doc_id) GROUP BY doc_id)
        SELECT doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
               sha256(unhex(coalesce(before, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
        FROM d LEFT JOIN part USING (doc_id)
    """,
    "op12_hard_negatives": """
        WITH v AS (
          SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
                 list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
          FROM embeddings
          WHERE label IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
          SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
          FROM v a JOIN v b ON a.vec_id % 100 = 0 AND (a.label <> b.label OR a.vec_id <> b.vec_id)),
        positive AS (
          SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
          QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
        ranked AS (
          SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
                 CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
          FROM positive p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
           AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score)
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 5
    """,
    "op13_ranked_search": """
        WITH term AS (
          SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS t FROM documents),
        held AS (SELECT doc_id, t, count(*) AS tf FROM term GROUP BY ALL),
        length AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM held GROUP BY doc_id),
        whole AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS total FROM length),
        norm AS (SELECT doc_id, 100 - 25 + (25 * n * n_docs) // total AS m FROM length, whole),
        weight AS (SELECT t, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM held, whole GROUP BY t, n_docs),
        wanted AS (
          SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                 '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS t FROM benchmark),
        scored AS (
          SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
          FROM wanted JOIN held USING (t) JOIN norm USING (doc_id) JOIN weight USING (t) GROUP BY item_id, doc_id),
        ranked AS (
          SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
          FROM scored WHERE score > 0)
        SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
    """,
}
