"""The operators as queries over one folder of tables, and DuckDB SQL where it can express them."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm import bpe, fingerprint, jaccard, langid, oracle, packing, quality, repair, rules, sharding, spelling, suffixes, tokenfile, wrapper
from postlens.llm.common import held_out, table
from postlens.session import fresh_path

QUERIES = {}
ORACLE = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    classifier = quality.fit_classifier(docs, table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", quality.quality_score(classifier).alias("score"))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query
def op2_jaccard_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


@query
def op2_jaccard_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_links(table(spark, sf_dir, "documents"))


@query
def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fingerprint.fingerprint_documents(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
    )


@query
def op4_wrapper_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = wrapper.extract_text(table(spark, sf_dir, "pages"))
    return texts.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


@query
def op5_subword_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    named = docs.select("doc_id", langid.language(langid.fit_model(docs)).alias("named"))
    return named.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "named.lang_pred", "named.score", "named.rejected")


@query
def op6_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_documents(table(spark, sf_dir, "documents")).select(
        "doc_id",
        F.expr("octet_length(ids) div 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op7_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "arc"
    )


@query
def op8_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rules.host_rules(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "token-files")
    tokenfile.write_tokens(table(spark, sf_dir, "documents"), path)
    return tokenfile.token_digests(spark, path)


@query
def op10_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(table(spark, sf_dir, "documents"))


@query
def op11_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = suffixes.without_repeats(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op12_repaired_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repaired_after_damage(table(spark, sf_dir, "conversations"))


@query
def op13_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(table(spark, sf_dir, "documents"))


ORACLE["op12_repaired_conversations"] = oracle.OP12
ORACLE["op13_spelling_groups"] = oracle.OP13

# Documents linked at 100 * intersection >= 75 * union of their five-word shingles, and the least doc_id of each component.
ORACLE["op2_jaccard_components"] = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
s AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3),
    lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS g
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other)
SELECT d.doc_id, coalesce(max(n.n), 0) AS n_shingles, min(r.other) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN reach r ON r.doc_id = d.doc_id GROUP BY d.doc_id
"""

# The same with the number of documents that each is linked with.
JOINED = """SELECT d.doc_id, coalesce(max(n.n), 0) AS n_shingles, min(r.other) AS component_id"""
COUNTED = """SELECT d.doc_id, coalesce(max(n.n), 0) AS n_shingles,
  (SELECT count(*) FROM links l WHERE l.a = d.doc_id) AS n_links, min(r.other) AS component_id"""
ORACLE["op2_jaccard_links"] = ORACLE["op2_jaccard_components"].replace(JOINED, COUNTED)

ORACLE["op8_host_rules"] = """
WITH w AS (
  SELECT doc_id, lower(coalesce(source, '')) AS source, coalesce(text, '') AS text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l
  FROM documents),
g AS (
  SELECT doc_id, unnest(range(1, len(w) - 3)) AS i, unnest(list_transform(range(1, len(w) - 3),
    lambda i: array_to_string(w[i:i + 4], ' '))) AS g FROM w WHERE len(w) >= 5),
again AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g) WHERE c > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM again, range(5) t(k) GROUP BY doc_id),
c AS (
  SELECT w.doc_id, source, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(l) AS n_lines,
    len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words
  FROM w LEFT JOIN covered USING (doc_id)),
r AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
    100 * n_symbols > 20 * word_chars AS symbols_failed, 100 * n_dup_lines > 30 * n_lines AS lines_failed FROM c),
h AS (
  SELECT source, count(*) AS n, unnest([{'rule': 'base', 'f': count(*) FILTER (base_failed)},
    {'rule': 'symbols', 'f': count(*) FILTER (symbols_failed)}, {'rule': 'lines', 'f': count(*) FILTER (lines_failed)}]) AS k
  FROM r GROUP BY source),
q AS (
  SELECT k.rule AS rule, count(*) AS hosts, sum(n) AS docs, sum(n::DOUBLE * n) AS nn, sum(k.f) AS f, sum(k.f::DOUBLE * k.f / n) AS ff
  FROM h GROUP BY k.rule),
b AS (
  SELECT rule, (docs - nn / docs) / (hosts - 1) AS size, (ff - f::DOUBLE * f / docs) / (hosts - 1) AS b, (f - ff) / (docs - hosts) AS w
  FROM q WHERE hosts > 1 AND docs > hosts),
a AS (SELECT q.rule, CASE WHEN b > w THEN (b - w) / (b + (size - 1) * w) ELSE 0 END AS a FROM q LEFT JOIN b ON b.rule = q.rule),
p AS (
  SELECT a.rule, any_value(a) AS a, sum(k.f / (1 + a * (n - 1))) / sum(n / (1 + a * (n - 1))) AS m
  FROM h JOIN a ON a.rule = h.k.rule GROUP BY a.rule),
v AS (
  SELECT h.source, max((a * k.f + (1 - a) * m) / (a * n + 1 - a)) > 0.5 AS bad FROM h JOIN p ON p.rule = h.k.rule GROUP BY h.source)
SELECT doc_id, n_words, word_chars::BIGINT AS word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT bad AS kept
FROM r JOIN v USING (source)
"""
