"""Registered queries of the training-data operators and the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from soldscope.llm import (
    bpe, exact_dedup, fim, jaccard_join, lattice_lm, packing, quality, resample, secrets, suffix_dedup, toxicity, vector_topk, warc,
)
from soldscope.llm.common import id_remainder, table

LEAST_QUALITY = 0.3
LEAST_TOXIC = 0.7


def quality_model(spark: SparkSession, sf_dir: str) -> quality.QualityModel:
    labels = table(spark, sf_dir, "labels").where(id_remainder("doc_id", 5) != 0)
    return quality.fit(quality.quality_sample(table(spark, sf_dir, "documents"), labels))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = quality.quality_scores(table(spark, sf_dir, "documents"), quality_model(spark, sf_dir))
    return scores.select(
        "doc_id",
        (id_remainder("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= LEAST_QUALITY).cast("int").alias("predicted"),
        "difference",
    )


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.secret_spans(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        F.sha2(secrets.joined_spans("base"), 256).alias("base_sha256"),
        secrets.joined_spans("spans").alias("spans"),
    )


def _sql_spans(kind: str, rank: int, pattern: str, group: int, least: int) -> str:
    """DuckDB: list of (start, rank, kind, end) of a pattern without flags."""
    quoted = pattern.replace("'", "''")
    return f"""list_filter(list_transform(range(1, len(regexp_extract_all(t, '{quoted}')) + 1), lambda i: {{
        's': (list_sum(list_transform(regexp_split_to_array(t, '{quoted}')[:i], lambda p: length(p)))
              + coalesce(list_sum(list_transform(regexp_extract_all(t, '{quoted}')[:i - 1], lambda p: length(p))), 0))::BIGINT,
        'r': {rank}, 'k': '{kind}',
        'e': (list_sum(list_transform(regexp_split_to_array(t, '{quoted}')[:i], lambda p: length(p)))
              + list_sum(list_transform(regexp_extract_all(t, '{quoted}')[:i], lambda p: length(p))))::BIGINT,
        'n': length(regexp_extract_all(t, '{quoted}', {group})[i])}}), lambda x: x.n >= {least})"""


# the assign pattern with both cases written out: no engine's case folding takes part
_ASSIGN = (
    "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    "|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
OP2_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
s AS (SELECT doc_id,
  {_sql_spans('assign', 0, _ASSIGN, 2, 6)} AS a,
  {_sql_spans('access', 1, 'AKIA[A-Z0-9]+', 0, 20)} AS b,
  {_sql_spans('hex', 2, '[0-9a-f]{24,}', 0, 24)} AS c,
  {_sql_spans('pem', 3, '-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----', 0, 0)} AS e,
  {_sql_spans('github', 4, 'gh[pousr]_[A-Za-z0-9]{36,}', 0, 0)} AS f,
  {_sql_spans('slack', 5, 'xox[abprs]-[A-Za-z0-9-]{10,}', 0, 0)} AS g
  FROM d)
SELECT doc_id, len(a) AS n_assign, len(b) AS n_access, len(c) AS n_hex,
  sha256(array_to_string(list_transform(list_sort(a || b || c), lambda x: x.k || ':' || x.s || ':' || x.e), ',')) AS base_sha256,
  array_to_string(list_transform(list_sort(a || b || c || e || f || g), lambda x: x.k || ':' || x.s || ':' || x.e), ',') AS spans
FROM s"""


def op3_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    train = id_remainder("doc_id", 5) != 1
    scores = lattice_lm.document_scores(table(spark, sf_dir, "documents"), train, path, public_tokenizers.PATTERN)
    return scores.select(
        "doc_id",
        (id_remainder("doc_id", 5) == 1).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.digests(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(id_remainder("doc_id", 3) != 1)
    model, counted = toxicity.fit(docs, labels)
    scores = toxicity.counted_scores(counted, model) if counted is not None else toxicity.toxicity_scores(docs, model)
    return scores.select(
        "doc_id",
        (id_remainder("doc_id", 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= LEAST_TOXIC).cast("int").alias("predicted"),
        "examples",
        "similarities",
    )


def packed(docs: DataFrame) -> DataFrame:
    ranks, tokenizer = map(public_tokenizers.path, ("byte_bpe_50k.tiktoken", "byte_bpe_50k.json"))
    return packing.pack(docs, ranks, tokenizer, public_tokenizers.PATTERN)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def op7_vector_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = vector_topk.whole_numbers(F.transform("embedding", lambda x: x.cast("double") * 256))
    vectors = table(spark, sf_dir, "embeddings").where(vector_topk.usable("embedding")).select("vec_id", cells.alias("cells"))
    return vector_topk.exact_topk(vectors.where("vec_id % 50 = 0"), vectors, k=5)


OP7_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)::BIGINT) AS c
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT q.vec_id AS query_id, v.vec_id,
         list_sum(list_transform(list_zip(q.c, v.c), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v q JOIN v ON v.vec_id <> q.vec_id AND len(v.c) = len(q.c)
  WHERE q.vec_id % 50 = 0),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.jaccard_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.col("group_id").alias("class_id"), "n_links", "text_class", "class_texts")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


OP9_SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))"""

def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")




def op11_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


# CRC-32 of a word: the 256 remainders of single bytes, then one step a byte
OP11_SQL = """
WITH bytes AS (
  SELECT list_transform(range(256), lambda b: list_reduce([b] || range(8),
         lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS r),
small AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
aim AS (SELECT translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM benchmark),
d AS (SELECT doc_id, row_number() OVER () AS i, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM small),
sw AS (SELECT i, unnest(w) AS w FROM d),
tw AS (SELECT unnest(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM aim),
v AS (SELECT DISTINCT w FROM (SELECT w FROM sw UNION ALL SELECT w FROM tw)),
h AS (SELECT w, hex(encode(w)) AS x, (SELECT r FROM bytes) AS r FROM v),
b AS (SELECT w, xor(list_reduce([4294967295] || list_transform(range(len(x) // 2), lambda i: ('0x' || x[2 * i + 1:2 * i + 2])::BIGINT),
         lambda c, y: xor(c >> 8, r[(xor(c, y) & 255) + 1])), 4294967295) % 10000 AS b FROM h),
s AS (SELECT b, count(*) AS s FROM sw JOIN b USING (w) GROUP BY b),
t AS (SELECT b, count(*) AS t FROM tw JOIN b USING (w) GROUP BY b),
n AS (SELECT (SELECT count(*) FROM sw) AS sn, (SELECT count(*) FROM tw) AS tn),
g AS (SELECT s.b, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (sn + 10000) / ((s + 1)::DOUBLE * (tn + 10000))))::BIGINT AS g
      FROM s LEFT JOIN t ON s.b = t.b CROSS JOIN n),
f AS (SELECT i, count(*) AS n, sum(g)::BIGINT AS g FROM sw JOIN b USING (w) JOIN g USING (b) GROUP BY i),
w AS (SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(floor(g::DOUBLE / n), 0)::BIGINT AS weight,
             ('0x' || sha256('2024:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT AS h
      FROM d LEFT JOIN f USING (i)),
z AS (SELECT doc_id, n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM w),
r AS (SELECT *, CASE WHEN n_features >= 20 THEN row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) END AS r,
             (SELECT count(*) FROM z WHERE n_features >= 20) * 10 // 100 AS k FROM z)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= k THEN r END AS rank FROM r"""


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write_archive(table(spark, sf_dir, "pages"))
    found = warc.read_archive(index, with_payload=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


# base32: five hexadecimal digits are four letters
OP12_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
g AS (SELECT page_id, h, min(page_id) OVER (PARTITION BY h) AS first, sha1(h) AS x FROM p)
SELECT page_id, strlen(h) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i:
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[((('0x' || x[5 * (i // 4) + 1:5 * (i // 4) + 5])::BIGINT >> (15 - 5 * (i % 4))) & 31) + 1]), '') AS payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM g"""


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.fill_in_middle(table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fim.restored("output", "form"), 256).alias("restored_sha256"),
    )


OP13_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
u AS (SELECT doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS w, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
             ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM d),
c AS (SELECT *, len(w) AS n, least(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS a, greatest(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS b,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                  WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, array_to_string(w[:a], '') AS p, array_to_string(w[a + 1:b], '') AS m, array_to_string(w[b + 1:], '') AS s FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p"""


QUERIES = {
    "op1_quality": op1_quality,
    "op2_secrets": op2_secrets,
    "op3_lattice_lm": op3_lattice_lm,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_toxicity": op5_toxicity,
    "op6_packing": op6_packing,
    "op7_vector_topk": op7_vector_topk,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_resample": op11_resample,
    "op12_warc": op12_warc,
    "op13_fill_in_middle": op13_fill_in_middle,
}
ORACLES = {
    "op2_secrets": OP2_SQL,
    "op7_vector_topk": OP7_SQL,
    "op9_exact_dedup": OP9_SQL,
    "op11_resample": OP11_SQL,
    "op12_warc": OP12_SQL,
    "op13_fill_in_middle": OP13_SQL,
}
