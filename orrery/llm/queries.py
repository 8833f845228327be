"""The queries of this subpackage: thin calls of its operators, with the columns that their contracts name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.llm import crosstoken, decontam, htmltext, jaccard, kneser, lattice, licenses, linededup, matroska, negatives, packing, toxicity, warc
from orrery.llm.common import table


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_hilbert_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op2_matroska(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matroska.features(matroska.stored(matroska.to_matroska(table(spark, sf_dir, "documents"), "doc_id", "text")), "doc_id")


def op3_html_text_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(table(spark, sf_dir, "pages"))


def op4_license_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op5_lattice_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.score(table(spark, sf_dir, "documents"), lattice.pieces(vocabulary("byte_bpe_50k.tiktoken")))


def op6_warc_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


def op7_toxicity_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_jaccard_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link_components(table(spark, sf_dir, "documents"), percent=90, width=3)


def op9_kneser_ney_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_edit_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def relabelled(embeddings: DataFrame) -> DataFrame:
    """Every seventh row under a wrong label, which a mined negative then may hold."""
    return embeddings.withColumn("label", F.expr("if(vec_id % 7 = 0, (cast(label as bigint) + 1) % 10, label)"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.hard_negatives(negatives.quantized(relabelled(table(spark, sf_dir, "embeddings"))))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crosstoken.alignments(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = linededup.dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_hilbert_packing, op2_matroska, op3_html_text_density, op4_license_minhash, op5_lattice_likelihood, op6_warc_dictionary, op7_toxicity_neighbours, op8_jaccard_components, op9_kneser_ney_quality, op10_edit_decontamination, op11_hard_negatives, op12_token_alignment, op13_line_dedup)}

#: DuckDB's form of those queries that SQL expresses; tests hold the others against brute force.
ORACLES: dict[str, str] = {
    "op6_warc_dictionary": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
        d AS (SELECT page_id, html, sha1(html) AS h, min(page_id) OVER (PARTITION BY sha1(html)) AS first FROM p),
        bits AS (SELECT *, array_to_string(list_transform(range(1, 41), lambda i: substr('0000000100100011010001010110011110001001101010111100110111101111', 4 * instr('0123456789abcdef', substr(h, CAST(i AS BIGINT), 1)) - 3, 4)), '') AS b FROM d)
        SELECT page_id, strlen(html) AS payload_bytes,
               array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   1 + list_sum(list_transform(range(1, 6), lambda j: CAST(substr(b, CAST(5 * k + j AS BIGINT), 1) AS BIGINT) * CAST(2 ** (5 - j) AS BIGINT)))::BIGINT, 1)), '') AS payload_digest,
               CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first THEN first END AS refers_to, TRUE AS intact
        FROM bits""",
    "op11_hard_negatives": """
        WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score FROM v a, v b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
        p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
        FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
        WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 5""",
    "op13_line_dedup": """
        WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
        l AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS place FROM d),
        k AS (SELECT *, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))) AS key FROM l),
        shared AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE doc_id < last) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE last IS NULL OR doc_id >= last), '')) AS kept_sha256
        FROM k LEFT JOIN shared USING (key) GROUP BY doc_id""",
}
