"""One query per operator, each over its whole table with the operator's production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelgap.llm.ctw import score_texts
from labelgap.llm.decontaminate import contaminated
from labelgap.llm.filter_audit import audit
from labelgap.llm.html_text import extract
from labelgap.llm.license_scan import scan
from labelgap.llm.minhash import near_duplicates
from labelgap.llm.prefix_bpe import encoding_digests
from labelgap.llm.registry import query
from labelgap.llm.source_mix import mix, taken_words
from labelgap.llm.stages import stage_path
from labelgap.llm.token_counts import encoded_lengths, length_histogram
from labelgap.llm.token_file import read_token_digests, write_token_file
from labelgap.llm.toxicity import score, train
from labelgap.llm.vector_groups import vector_groups
from labelgap.llm.whitening import whiten

MULTI_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: In the order of the chain: a text of low quality first, so that its probability helps to tell a toxic one.
CATEGORIES = ("low_quality", "toxic")
#: Probability from which a document counts as toxic.
TOXIC_FROM = 0.4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_license_diagonals")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))[1]


@query("op2_context_trees")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7
    return score_texts(table(spark, sf_dir, "documents"), fold != 2)


@query("op3_prefix_bpe")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding_digests(table(spark, sf_dir, "documents"), MULTI_RANKS, public_tokenizers.PATTERN)


_NEAR_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), runs AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s FROM words
), sizes AS (SELECT doc_id, len(s) AS n_shingles FROM runs),
single AS (SELECT doc_id, unnest(s) AS g FROM runs),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM single a JOIN single b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY 1, 2 HAVING 100 * count(*) >= 75 * (
    (SELECT n_shingles FROM sizes s WHERE s.doc_id = a.doc_id) + (SELECT n_shingles FROM sizes s WHERE s.doc_id = b.doc_id) - count(*))
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM sizes UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY 1)
SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept FROM sizes JOIN least USING (doc_id)
"""


@query("op7_minhash_groups", _NEAR_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query("op4_contaminated")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def quality_and_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labels as categories that are 1 for what is unwanted."""
    return table(spark, sf_dir, "labels").select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")


@query("op5_path_ratios")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


@query("op6_classifier_chain")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    chain = train(docs, quality_and_toxicity(spark, sf_dir), CATEGORIES)
    return score(docs, chain).withColumn("is_toxic", F.col("p_toxic") >= TOXIC_FROM)


@query("op8_length_histogram")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = encoded_lengths(table(spark, sf_dir, "documents"), BYTE_RANKS, public_tokenizers.PATTERN)
    return length_histogram(lengths)


@query("op9_token_file")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = stage_path(spark, "tokens")
    write_token_file(table(spark, sf_dir, "documents"), out, BYTE_TOKENIZER, public_tokenizers.PATTERN)
    return read_token_digests(spark, out)


_VECTORS_SQL = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
), usable AS (
  SELECT vec_id, v, sqrt(list_dot_product(v, v)) AS size FROM vectors
  WHERE len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_dot_product(v, v) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_dot_product(a.v, b.v) / (a.size * b.size) >= 0.9
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM vectors UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), least AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY 1),
counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY 1)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM vectors JOIN least USING (vec_id) LEFT JOIN counts USING (vec_id)
"""


@query("op10_collision_counts", _VECTORS_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_groups(table(spark, sf_dir, "embeddings"))


@query("op11_spectrum_slices")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


_AUDIT_SQL = """
WITH docs AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), least AS (SELECT text, min(doc_id) AS first_id FROM docs GROUP BY text),
marked AS (
  SELECT doc_id, part, (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
    + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text))::INT
    + 8 * regexp_matches(text, '[#$%&*|]')::INT + 16 * coalesce(doc_id > first_id, false)::INT AS failed
  FROM docs JOIN least USING (text)
), known AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
cells AS (
  SELECT part, failed, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM marked LEFT JOIN known USING (doc_id) GROUP BY part, failed
), filters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS bit),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM filters a, filters b, filters c, filters d, filters e WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31
), steps AS (
  SELECT filter_order, s AS step, bits[s] AS own, coalesce(list_sum(bits[1:s - 1]), 0)::INT AS before
  FROM orders, (SELECT unnest(range(1, 6))::INT AS s)
), counted AS (
  SELECT part, filter_order, step, substring(filter_order, step, 1) AS filter,
    sum(CASE WHEN failed & (before | own) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN failed & before = 0 AND failed & own <> 0 THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN failed & before <> 0 AND failed & own <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN failed = own THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN failed & before = 0 AND failed & own <> 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN failed & before = 0 AND failed & own <> 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM cells, steps GROUP BY part, filter_order, step
)
SELECT *, (sum(removed) OVER (PARTITION BY part, filter))::BIGINT AS shapley FROM counted
"""


@query("op12_filter_shapley", _AUDIT_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


_MIX_SQL = """
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM docs GROUP BY source
), ratios AS (
  SELECT *, 3 * source_size AS most, (3 * source_size)::DOUBLE / weight AS ratio, (sum(source_size) OVER ())::BIGINT AS words,
    (sum(weight) OVER ())::BIGINT AS weights FROM sources
), levels AS (
  SELECT *, ratio <= (words - (sum(most) OVER (ORDER BY ratio) - sum(most) OVER (PARTITION BY ratio)))::DOUBLE
    / (weights - (sum(weight) OVER (ORDER BY ratio) - sum(weight) OVER (PARTITION BY ratio)))::DOUBLE AS stopped FROM ratios
), shared AS (
  SELECT (max(words) - coalesce(sum(most) FILTER (WHERE stopped), 0))::DOUBLE / nullif(max(weights) - coalesce(sum(weight) FILTER (WHERE stopped), 0), 0)::DOUBLE AS level
  FROM levels
), targets AS (
  SELECT source, source_size, CASE WHEN stopped THEN most::DOUBLE ELSE level * weight END AS target FROM levels, shared
), copies AS (SELECT *, row_number() OVER (PARTITION BY source, doc_id, size) - 1 AS copy FROM docs),
placed AS (
  SELECT doc_id, source, size, (sum(size) OVER (PARTITION BY source ORDER BY
    md5(concat_ws('|', coalesce(doc_id::VARCHAR, 'null'), size, copy // 1000, 13)), doc_id, copy ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS start FROM copies
), whole AS (SELECT *, floor(target + 0.5)::BIGINT AS wanted FROM targets)
SELECT doc_id, size, source_size, target,
  CASE WHEN size = 0 THEN 0 ELSE wanted // source_size * size + greatest(0, least(start + size, wanted % source_size) - start) END::BIGINT AS taken
FROM placed JOIN whole ON placed.source IS NOT DISTINCT FROM whole.source
"""


@query("op13_source_schedule", _MIX_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken_words(mix(table(spark, sf_dir, "documents")))
