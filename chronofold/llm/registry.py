"""The operators' queries and the corpus pipeline, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronofold.llm import bpe, decontamination, divergence, fim, jaccard, langid, pii, quality, substrings, topk, toxicity, warc, whitening
from chronofold.llm.labelled import crc_mod
from chronofold.llm.session import shared_dir

#: Where the public vocabularies lie; a parameter of the operator.
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), VOCABULARY, with_ids=False)


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    model = langid.train(docs.where(crc_mod("doc_id", 4) != 2))
    return langid.predict(docs, model).select("doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels")
    model = quality.train(docs, labels.where(crc_mod("doc_id", 3) != 1))
    held_out, predicted = (crc_mod("doc_id", 3) == 1).alias("held_out"), (F.col("score") >= 0.5).cast("int").alias("predicted")
    return quality.score(docs, model).select("doc_id", held_out, "score", predicted)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "warc")
    warc.write(_read(spark, sf_dir, "pages"), path)
    return warc.read(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: Session setting of the key of the pseudonyms. A job sets its own secret there (and keeps plans and event logs, which hold
#: it, as safe); the key that is taken without one is public and hides nothing from who reads this.
PII_SETTING, PUBLIC_KEY = "spark.chronofold.pii.key", "public test key"


def pii_key(spark: SparkSession) -> str:
    return spark.conf.get(PII_SETTING, PUBLIC_KEY)


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, pii_key(spark))


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.deduplicate(_read(spark, sf_dir, "documents"), with_text=False)


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.where(crc_mod("doc_id", 4) != 2))
    held_out, predicted = (crc_mod("doc_id", 4) == 2).alias("held_out"), (F.col("score") >= 0.3).cast("int").alias("predicted")
    return toxicity.score(docs, model).select("doc_id", held_out, "score", predicted)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.report(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.group(_read(spark, sf_dir, "documents"))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.judge(_read(spark, sf_dir, "documents")).drop("class_distance", "word_distance")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_read(spark, sf_dir, "embeddings"))


def op13_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(_read(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_bpe, op2_langid, op3_quality, op4_warc, op5_pii, op6_substrings, op7_topk, op8_toxicity, op9_decontamination, op10_jaccard, op11_divergence, op12_whitening, op13_fim, pipeline)}


#: DuckDB twins of the queries that SQL can express.
ORACLES = {
    "op7_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 20 = 0
        ), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
    """,
    "op11_divergence": r"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(lang, '') AS lang, coalesce(text, '') AS t FROM documents),
        w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d),
        b AS (SELECT *, len(w) AS n, length(list_aggregate(w, 'string_agg', '')) AS joined FROM w),
        c AS (
            SELECT *, coalesce(joined, 0) AS word_chars, length(regexp_replace(t, '[a-z\x20\x09-\x0D]+', '', 'g')) AS rare, length(t) AS chars,
                [length(t) - length(regexp_replace(t, '[A-Z]+', '', 'g')), length(t) - length(regexp_replace(t, '[0-9]+', '', 'g')),
                 length(t) - length(regexp_replace(t, '[.,;:!?''"()-]+', '', 'g')), length(t) - length(regexp_replace(t, '[#$%&*+/<=>@\[\\\]^_`{|}~]+', '', 'g')),
                 length(t) - length(regexp_replace(t, '[^\x00-\x7F]+', '', 'g')), length(t) - coalesce(joined, 0)] AS found,
                length(t) - length(regexp_replace(t, '[#*$%&|<>]+', '', 'g')) AS n_symbols,
                list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM b
        ),
        k AS (SELECT *, list_append(found, chars - list_sum(found)) AS classes, len(lines) - len(list_distinct(lines)) AS n_dup_lines FROM c),
        win AS (SELECT r, i, [w[i], w[i + 1], w[i + 2], w[i + 3], w[i + 4]] AS g FROM (SELECT r, w, unnest(range(1, n - 3)) AS i FROM k WHERE n >= 5)),
        twice AS (SELECT r, i FROM win SEMI JOIN (SELECT r, g FROM win GROUP BY ALL HAVING count(*) > 1) USING (r, g)),
        rep AS (SELECT r, count(DISTINCT i + j) AS n_repeat_words FROM twice, range(5) t(j) GROUP BY r),
        big AS (SELECT *, 100000000 // n AS weight FROM k WHERE n >= 50),
        lang AS (
            SELECT lang, CAST(sum(n * weight) AS BIGINT) AS total, [CAST(sum(100000000 * classes[1] // chars) AS BIGINT), CAST(sum(100000000 * classes[2] // chars) AS BIGINT), CAST(sum(100000000 * classes[3] // chars) AS BIGINT),
                CAST(sum(100000000 * classes[4] // chars) AS BIGINT), CAST(sum(100000000 * classes[5] // chars) AS BIGINT), CAST(sum(100000000 * classes[6] // chars) AS BIGINT), CAST(sum(100000000 * classes[7] // chars) AS BIGINT)] AS cs
            FROM big GROUP BY lang HAVING count(*) >= 10
        ),
        word AS (SELECT lang, lower(x) AS x, CAST(sum(weight) AS BIGINT) AS s FROM (SELECT lang, weight, unnest(w) AS x FROM big) GROUP BY ALL),
        top AS (
            SELECT lang, x, s / total AS q FROM word JOIN lang USING (lang) WHERE s >= 0.001 * total AND regexp_matches(x, '\p{L}')
            QUALIFY row_number() OVER (PARTITION BY lang ORDER BY s DESC, x) <= 32
        ),
        own AS (SELECT r, lang, lower(x) AS x, count(*) AS m FROM (SELECT r, lang, unnest(w) AS x FROM big) GROUP BY ALL),
        bins AS (
            SELECT r, q, coalesce(m, 0) / n AS p FROM big JOIN top USING (lang) LEFT JOIN own USING (r, lang, x)
        ),
        hist AS (SELECT * FROM bins UNION ALL SELECT b.r, greatest(0, 1 - coalesce(sum(q), 0)), greatest(0, 1 - coalesce(sum(p), 0)) FROM big b LEFT JOIN bins USING (r) GROUP BY b.r
        ),
        cbins AS (SELECT r, cs[i] / list_sum(cs) AS q, classes[i] / chars AS p FROM big JOIN lang USING (lang), range(1, 8) t(i)),
        dist AS (
            SELECT r, sqrt(greatest(sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2, 0)) AS v FROM hist GROUP BY r
        ),
        cdist AS (
            SELECT r, sqrt(greatest(sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2, 0)) AS v FROM cbins GROUP BY r
        ),
        f AS (
            SELECT k.*, coalesce(n_repeat_words, 0) AS n_repeat_words, n < 10 OR 100 * coalesce(n_repeat_words, 0) > 20 * n AS base_failed,
                coalesce(dist.v > 0.22 + 1.4 / sqrt(n) OR cdist.v > 0.15 + 0.8 / sqrt(n), false) AND lang IN (SELECT lang FROM lang) AS far
            FROM k LEFT JOIN rep USING (r) LEFT JOIN dist USING (r) LEFT JOIN cdist USING (r)
        )
        SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
            CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed, NOT base_failed AND NOT far AS kept FROM f
    """,
    "op13_fim": r"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS s FROM documents),
        h AS (
            SELECT *, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u, CAST('0x' || s[1:8] AS BIGINT) AS h1, CAST('0x' || s[9:16] AS BIGINT) AS h2,
                CAST('0x' || s[17:24] AS BIGINT) AS h3, CAST('0x' || s[25:32] AS BIGINT) AS h4 FROM d
        ),
        c AS (SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b FROM h),
        p AS (
            SELECT *, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form,
                array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:n], '') AS suffix FROM c
        )
        SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
            sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
            sha256(t) AS restored_sha256 FROM p
    """,
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
