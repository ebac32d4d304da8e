"""Registered queries of the corpus operators, each over its whole table, and their DuckDB SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm import (
    decontamination, exact_dedup, hard_negatives, html_extraction, jaccard_join, language_id, mixing, phrases, sharding, token_ids, token_ledger,
    toxicity, warc)
from rivulet.llm.common import null_as_empty, shared_path, table

TOKENIZERS = ("byte_bpe_50k", "byte_bpe_multi_50k")


def remainder(modulus: int) -> Column:
    """crc32 of doc_id's text modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % modulus


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"), k=4, percent=85)


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), 16)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, index = warc.write_archives(table(spark, sf_dir, "pages"))
    return warc.read_records(index, root, payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_extraction.extract(pages, html_extraction.train(pages)).drop("html")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"), max_epochs=mixing.MAX_EPOCHS)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", remainder(4) == 2)
    labels = table(spark, sf_dir, "labels").where(remainder(4) != 2).select("doc_id", "toxic")
    model = toxicity.train(docs.where(~F.col("held_out")), labels)
    return toxicity.score(docs.select("doc_id", "held_out", "text"), model).drop("text")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", remainder(5) == 0)
    model = language_id.train(docs.where(~F.col("held_out")).select("doc_id", "lang", "text"))
    return language_id.identify(docs.select("doc_id", "held_out", "text"), model).drop("text")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of the whole table under both tokenizers, after batches that each alter them.

    Batch 0 (delivered twice, the second has no effect) inserts every document, an eighth of them as a draft of
    other text, source and lang, and for another eighth a stray copy under an id of its own. Batch 1 revises the
    drafts to what the table says, batch 2 deletes the stray copies.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    ledger = token_ledger.TokenLedger(spark, shared_path(spark, "ledger"),
                                      {t: f"{token_ledger.TOKENIZER_DIR}/{t}.tiktoken" for t in TOKENIZERS})
    draft, strayed = remainder(8) == 1, remainder(8) == 2
    first = docs.withColumns({"source": F.when(draft, "draft").otherwise(F.col("source")), "lang": F.when(~draft, F.col("lang")),
                              "text": F.when(draft, F.concat(F.lit("draft "), null_as_empty(F.col("text")))).otherwise(F.col("text"))})
    stray = docs.where(strayed & F.col("doc_id").isNotNull()).withColumn("doc_id", -1 - F.col("doc_id"))
    stray = stray.join(docs.where("doc_id < 0").select("doc_id"), "doc_id", "left_anti")  # ids of the table stay the table's
    inserts = first.unionByName(stray).withColumn("op", F.lit("insert"))
    ledger.apply(0, inserts)
    ledger.apply(0, inserts)
    ledger.apply(1, docs.where(draft).withColumn("op", F.lit("revise")))
    ledger.apply(2, stray.withColumn("op", F.lit("delete")))
    return ledger.totals()


def op11_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, index = token_ids.write_ids(table(spark, sf_dir, "documents"))
    return token_ids.read_ids(token_ids.starts(index), root)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(hard_negatives.shifted_labels(table(spark, sf_dir, "embeddings")))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_jaccard_join": op1_jaccard_join,
    "op2_sharding": op2_sharding,
    "op3_warc": op3_warc,
    "op4_decontamination": op4_decontamination,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_html_extraction": op6_html_extraction,
    "op7_mixing": op7_mixing,
    "op8_toxicity": op8_toxicity,
    "op9_language_id": op9_language_id,
    "op10_token_counts": op10_token_counts,
    "op11_token_ids": op11_token_ids,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_phrases": op13_phrases,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL: dict[str, str] = {
    "op1_jaccard_join": f"""
        WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        u AS (SELECT doc_id, len(w) AS n, unnest(w) AS x, unnest(range(len(w))) AS i FROM w),
        v AS (SELECT doc_id, n, i, concat_ws(' ', x, lead(x) OVER p, lead(x, 2) OVER p, lead(x, 3) OVER p) AS t
              FROM u WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
        e AS (SELECT DISTINCT doc_id, t FROM v WHERE i = 0 OR i <= n - 4),
        s AS (SELECT doc_id, count(t) AS k FROM documents LEFT JOIN e USING (doc_id) GROUP BY doc_id),
        f AS (SELECT * FROM e QUALIFY count(*) OVER (PARTITION BY t) > 1),
        p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM f a JOIN f b ON a.t = b.t AND a.doc_id <> b.doc_id GROUP BY ALL),
        l AS (SELECT x, y FROM p JOIN s a ON a.doc_id = x JOIN s b ON b.doc_id = y WHERE 100 * c >= 85 * (a.k + b.k - c)),
        r AS (SELECT doc_id, doc_id AS other FROM s UNION SELECT r.doc_id, l.y FROM r JOIN l ON l.x = r.other)
        SELECT doc_id, CAST(any_value(k) AS BIGINT) AS n_shingles, min(other) AS component_id
        FROM r JOIN s USING (doc_id) GROUP BY doc_id""",
    "op3_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
        k AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest,
                     min(page_id) OVER (PARTITION BY html) AS first_id FROM p)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
        FROM k""",
    "op5_exact_dedup": f"""
        WITH k AS (SELECT doc_id, {_LOWER} AS t FROM documents)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
        FROM k""",
    "op12_hard_negatives": """
        WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                          list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x
                   FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
                     AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, CAST(list_dot_product(a.x, b.x) AS BIGINT) AS score
              FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
        p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
              QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
        SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, other AS negative_id, positive_score, score AS negative_score
        FROM p JOIN s USING (anchor_id)
        WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
        WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) QUALIFY row_number() OVER w <= 5""",
    "op13_phrases": f"""
        WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, 'und') AS lang, {_LOWER} AS t FROM documents),
        p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM d),
        w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM p),
        n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
        g AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, range(1, 6) r(k) WHERE len(w) >= k),
        f AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 100),
        c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
        i AS (SELECT lang, array_to_string(w[b:e], ' ') AS phrase, max(a) AS b
              FROM (SELECT *, unnest([1, 2]) AS b, unnest([k - 1, k]) AS e FROM c WHERE k > 2) GROUP BY ALL),
        z AS (SELECT c.*, unnest(range(1, k)) AS cut FROM c LEFT JOIN i USING (lang, phrase) WHERE i.b IS NULL OR i.b < a),
        x AS (SELECT z.lang, z.phrase, a, l.f AS l, r.f AS r, n, cut,
                     CAST((CAST(1000 AS HUGEINT) * a * n) // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
              FROM z JOIN n USING (lang) JOIN f l ON l.lang = z.lang AND l.phrase = array_to_string(z.w[1:cut], ' ')
              JOIN f r ON r.lang = z.lang AND r.phrase = array_to_string(z.w[cut + 1:z.k], ' ')),
        m AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1)
        SELECT lang, row_number() OVER o AS rank, phrase, a, l, r, n, score FROM m
        WINDOW o AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) QUALIFY row_number() OVER o <= 2000""",
}
