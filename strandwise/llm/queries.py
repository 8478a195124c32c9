"""The queries opN_<name> and pipeline: each applies an operator, with production parameters, to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from strandwise.llm import alignment, exact_dups, fingerprints, html_text, mixing, near_dups, packing, parity_join, prefix_trie, private_data, quality, toxicity, urls


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(_table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op2_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = private_data.find_private(docs, private_data.fit_on_sample(docs))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit_on_labels(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score_severity(docs, model).select("doc_id", "toxic_chance", "severity", "toxic")


def op5_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(_table(spark, sf_dir, "pages").select("page_id", "url"), urls.RULES).select("page_id", "host", "path", "rule", "verdict")


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicate_groups(_table(spark, sf_dir, "documents").select("doc_id", "text"), k=4, percent=80)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score_quality(docs, quality.fit_on_labels(docs, _table(spark, sf_dir, "labels")))
    return scored.select("doc_id", quality.held_out(scored["doc_id"]).alias("held_out"), "score", "predicted")


def op10_exact_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dups.exact_groups(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(_table(spark, sf_dir, "conversations"))


def op12_parity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity_join.similar_groups(_table(spark, sf_dir, "documents").select("doc_id", "text"), width=4, percent=85)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_tokenizers(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = [op1_html_text, op2_private_data, op3_mixing, op4_toxicity, op5_urls, op6_fingerprints, op7_near_dups, op8_packing, op9_quality, op10_exact_dups]
    own += [op11_prefix_trie, op12_parity_join, op13_alignment]
    return {f.__name__: f for f in own} | {"pipeline": corpus_pipeline.run}


def similar_sql(width: int, percent: int) -> str:
    """Groups of documents whose shingle sets reach a similarity, by comparing all that share a shingle."""
    return f"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents WHERE text IS NOT NULL),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= {width} THEN list_transform(range(1, len(w) - {width} + 2), lambda i: array_to_string(w[i : i + {width - 1}], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * k >= {percent} * (p.n + q.n - k)),
reached AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other),
least AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY 1)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM documents JOIN least USING (doc_id) LEFT JOIN n USING (doc_id)"""


def oracle_sql() -> dict[str, str]:
    near = f"SELECT *, doc_id = component_id AS kept FROM ({similar_sql(4, 80)})"
    similar = {"op7_near_dups": near, "op12_parity_join": similar_sql(4, 85)}
    return similar | {"op5_urls": urls.URLS_SQL, "op10_exact_dups": exact_dups.EXACT_SQL, "op11_prefix_trie": prefix_trie.TRIE_SQL}
