"""The registered queries of the operators, on whole tables, and their SQL counterparts."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.llm.fit_packing import fit_documents
from ledgermill.llm.lexical_search import ranked_documents
from ledgermill.llm.near_dedup import near_duplicates
from ledgermill.llm.packing import pack_documents
from ledgermill.llm.periodic_runs import periodic_runs, run_digests, with_planted_periods
from ledgermill.llm.pii import personal_data_report
from ledgermill.llm.repetition_rules import quality_rules
from ledgermill.llm.source_mixing import mix_report
from ledgermill.llm.substring_dedup import remove_repeats
from ledgermill.llm.texts import documents
from ledgermill.llm.token_counts import token_counts
from ledgermill.llm.token_output import read_token_ids, with_checksums, write_token_ids
from ledgermill.llm.top_k_search import top_k
from ledgermill.llm.toxicity import toxicity
from ledgermill.session import scratch_path

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), shingle_words=3, radius=2)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op3_repetition_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(documents(spark, sf_dir), weights=(5, 2, 1), share=1.5, most=2.0)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_repeats(documents(spark, sf_dir), window=13)
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0, k=5, scale=256)


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data_report(documents(spark, sf_dir))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir), BYTE_BPE)


def op9_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    out_dir = scratch_path(spark, "token-ids")
    write_token_ids(documents(spark, sf_dir), WORD_BPE, out_dir, end_id=2)
    return with_checksums(read_token_ids(spark, out_dir))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), WORD_BPE, capacity=2048, end_id=1).drop("padded_to")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(periodic_runs(with_planted_periods(documents(spark, sf_dir)), least=12))


def op12_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fit_documents(documents(spark, sf_dir), WORD_BPE, capacity=4096, end_id=1)


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), k=50)


LLM_QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_toxicity": op2_toxicity,
    "op3_repetition_rules": op3_repetition_rules,
    "op4_mixing": op4_mixing,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_top_k": op6_top_k,
    "op7_pii": op7_pii,
    "op8_token_counts": op8_token_counts,
    "op9_token_output": op9_token_output,
    "op10_packing": op10_packing,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_fit_packing": op12_fit_packing,
    "op13_lexical_search": op13_lexical_search,
}
# The targets are found in one pass: sources fill up in order of size over weight, and the level that the
# others share is that of the first one that does not.
_OP4 = r"""
WITH sized AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
    FROM documents
), weighed AS (
    SELECT source, sum(size)::BIGINT AS source_size, 2.0::DOUBLE * sum(size)::DOUBLE AS cap,
        CASE (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
    FROM sized GROUP BY source
), filling AS (
    SELECT *, coalesce(sum(cap) OVER before, 0) AS held, sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS open_weight,
        1.5::DOUBLE * sum(source_size) OVER () AS total
    FROM weighed
    WINDOW before AS (ORDER BY cap / weight, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), levels AS (
    SELECT (total - held) / open_weight AS level FROM filling
    WHERE cap > weight * ((total - held) / open_weight)
    ORDER BY cap / weight, encode(source) NULLS LAST LIMIT 1
), targets AS (
    SELECT source, source_size, CASE WHEN cap <= weight * coalesce(level, 0) THEN cap ELSE weight * coalesce(level, 0) END AS target,
        CAST('0x' || substr(md5(concat_ws(':', CASE WHEN source IS NULL THEN '1' ELSE '0' END, coalesce(source, ''))), 1, 8) AS BIGINT)
            / 4294967296.0::DOUBLE AS shift
    FROM weighed LEFT JOIN levels ON true
), ranked AS (
    SELECT doc_id, source, size, row_number() OVER (
        PARTITION BY source
        ORDER BY length(bin(size)), substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 3), size, doc_id) - 1 AS rank
    FROM sized
)
SELECT doc_id, size, source_size, target,
    CAST(floor((rank + 1)::DOUBLE * rate + shift) - floor(rank::DOUBLE * rate + shift) AS BIGINT) * size AS taken
FROM (
    SELECT r.*, source_size, target, shift, CASE WHEN source_size > 0 THEN target / source_size::DOUBLE ELSE 0 END AS rate
    FROM ranked r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source
)
"""

_OP5 = r"""
WITH split AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), positions AS (
    SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS p FROM split
), windows AS (
    SELECT doc_id, p, array_to_string(words[p : p + 12], ' ') AS sequence FROM positions WHERE p + 12 <= len(words)
), repeated AS (
    SELECT doc_id, p FROM windows
    JOIN (SELECT sequence, min(doc_id) AS first FROM windows GROUP BY sequence HAVING min(doc_id) < max(doc_id)) USING (sequence)
    WHERE first < doc_id
), covered AS (
    SELECT DISTINCT doc_id, p + k AS p FROM repeated, (SELECT unnest(range(0, 13)) AS k)
), stays AS (
    SELECT doc_id, string_agg(words[p], ' ' ORDER BY p) AS kept, count(*) AS n_kept
    FROM positions ANTI JOIN covered USING (doc_id, p) GROUP BY doc_id
)
SELECT s.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n_kept, 0) AS BIGINT) AS n_removed,
    sha256(coalesce(kept, '')) AS kept_sha256
FROM split s LEFT JOIN stays t ON s.doc_id = t.doc_id
"""

_OP6 = """
WITH vectors AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND NOT list_contains(list_transform(embedding, lambda x: coalesce(isfinite(x), false)), false)
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
    FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

_OP13 = r"""
WITH split AS (
    SELECT doc_id, row_number() OVER () AS place, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
), totals AS (
    SELECT count(*)::BIGINT AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM split WHERE len(terms) > 0
), counted AS (
    SELECT place, doc_id, len(terms)::BIGINT AS n, unnest(terms) AS term FROM split
), cells AS (
    SELECT place, doc_id, n, term, count(*)::BIGINT AS tf FROM counted GROUP BY ALL
), weights AS (
    SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
    FROM cells, totals GROUP BY term
), asked AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
), scored AS (
    SELECT item_id, place, doc_id,
        sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // n_terms))))::BIGINT AS score
    FROM asked JOIN cells USING (term) JOIN weights USING (term), totals GROUP BY ALL
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
    FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""

LLM_COUNTERPARTS: dict[str, str] = {
    "op4_mixing": _OP4, "op5_substring_dedup": _OP5, "op6_top_k": _OP6, "op13_lexical_search": _OP13,
}
