"""The operators over their whole tables, with the settings for production, and SQL where it can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threatframe.llm import bpe, brown_lm, embedding, exact_dedup, html_render, merkle, ngram_jaccard, packing, piece_bpe, prefix_trie, quality, secrets, url_filter
from threatframe.llm.common import id_and_text, lower_ascii, remainder, table
from threatframe.session import Scratch

URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge(table(spark, sf_dir, "pages"), rules)


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    # two batches, so that the second meets an index that holds the digests of the first
    found = exact_dedup.dedup(table(spark, sf_dir, "documents"), exact_dedup.DigestIndex(spark), batches=2)
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.tokenize(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    light = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(light)


def op4_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown_lm.score(table(spark, sf_dir, "documents"), remainder(F.col("doc_id"), 7) == 2)


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard.link(table(spark, sf_dir, "documents"))


def op6_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = remainder(F.col("doc_id"), 5) == 0
    model = quality.fit(id_and_text(docs.where(~held_out)), labels.where(~held_out))
    scores = quality.score(docs, model)
    return scores.select("doc_id", held_out.alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


def op7_html_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_render.extract(table(spark, sf_dir, "pages"))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    plain = bpe.decode(coded, ranks, public_tokenizers.PATTERN)
    return plain.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, name = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False)
    count = [secrets.count_of(F.col(name), i).alias(f"n_{k}") for i, k in enumerate(secrets.KINDS[:3])]
    return found.select("doc_id", *count, F.sha2(secrets.listing(F.col(name), 2), 256).alias("base_sha256"), secrets.listing(F.col(name)).alias("spans"))


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    plain = piece_bpe.decode(piece_bpe.encode(table(spark, sf_dir, "documents"), model), model)
    listed = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return plain.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = Scratch(spark)
    turns = prefix_trie.numbered_turns(table(spark, sf_dir, "conversations"), tables)
    # the first h turns come from the first conversation of the hundred
    convs = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n"))
    convs = convs.withColumns({"base": F.col("conv") - F.col("conv") % 100, "h": remainder(F.col("conv"), 6)})
    convs = tables.write("convs", convs)
    there = convs.where("conv = base").select("base", F.col("n").alias("n_base"))
    convs = tables.write("grafts", convs.join(there, "base", "left").withColumn("taken", F.least("h", F.coalesce("n_base", F.lit(0)))))
    heads = turns.where("pos < 5 and conv % 100 = 0").withColumnRenamed("conv", "base")
    first = convs.where("taken > 0").select("conv", "base", "taken").join(heads, "base").where("pos < taken")
    shorter = convs.where("taken < h").select("conv", (F.col("h") - F.col("taken")).alias("fewer"))
    rest = turns.where(F.col("pos") >= remainder(F.col("conv"), 6)).join(shorter, "conv", "left").withColumn("pos", F.col("pos") - F.coalesce("fewer", F.lit(0)))
    columns = ["conv", "pos", "digest", "size"]
    return prefix_trie.trie(first.select(*columns).unionByName(rest.select(*columns)), convs, tables)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    docs = table(spark, sf_dir, "documents")
    tampered = merkle.leaf_of([lower_ascii(F.col(c)) if c == "text" else F.col(c) for c in columns])
    seen = F.when(F.col("doc_id").isNotNull() & (remainder(F.col("doc_id"), 5) == 0), tampered)
    rows = merkle.manifest(docs, columns, seen)
    folded = rows.withColumn("folded_root", merkle.fold(F.coalesce("changed", "leaf"), F.col("path")))
    proof = merkle.proof_digest(F.col("path")).alias("proof_sha256")
    return folded.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", proof, "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def crc32_sql(value: str) -> str:
    """crc32 of the decimal text of ``value`` in DuckDB."""
    step = "list_reduce(list_prepend(xor(crc, byte), range(8)), lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)"
    digits = f"list_transform(string_split(({value})::VARCHAR, ''), lambda x: ascii(x)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {digits}), lambda crc, byte: {step}), 4294967295)"


QUERIES = {f.__name__: f for f in (op1_url_filter, op2_exact_dedup, op3_best_fit_packing, op4_brown_lm, op5_ngram_jaccard, op6_quality_cnn,
                                   op7_html_layout, op8_embedding_dedup, op9_byte_bpe, op10_secret_scan, op11_sentencepiece, op12_conversation_trie, op13_merkle_manifest)}

ORACLES = {
    "op1_url_filter": r"""
WITH p AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
  FROM pages),
r(h, p, verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
f AS (
  SELECT x.host, x.path, min_by(r.h || r.p, (-length(r.h || r.p), r.h || r.p)) AS rule, min_by(r.verdict, (-length(r.h || r.p), r.h || r.p)) AS verdict
  FROM (SELECT DISTINCT host, path FROM p) x JOIN r ON (x.host = r.h OR x.host LIKE '%.' || r.h) AND starts_with(x.path, r.p)
  GROUP BY 1, 2)
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict FROM p LEFT JOIN f ON p.host = f.host AND p.path = f.path""",
    "op2_exact_dedup": r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, d.text_sha256 FROM d JOIN g USING (text_sha256)""",
    "op12_conversation_trie": rf"""
WITH o AS (
  SELECT conv_id, r, t, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, x) - 1 AS p, x
  FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t, left(sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 32) AS x
        FROM conversations WHERE conv_id IS NOT NULL)),
c AS (SELECT conv_id, conv_id - conv_id % 100 AS base, {crc32_sql("conv_id")} % 6 AS h FROM (SELECT DISTINCT conv_id FROM o)),
mixed AS (
  SELECT c.conv_id, 0 AS own, o.p, o.x, o.t FROM c JOIN o ON o.conv_id = c.base AND o.p < c.h
  UNION ALL SELECT c.conv_id, 1, o.p, o.x, o.t FROM c JOIN o ON o.conv_id = c.conv_id AND o.p >= c.h),
turns AS (SELECT conv_id, row_number() OVER w AS d, length(t) AS size, string_agg(x, '') OVER w AS key FROM mixed WINDOW w AS (PARTITION BY conv_id ORDER BY own, p)),
m AS MATERIALIZED (SELECT conv_id, d, size, sha256(key) AS key FROM turns UNION ALL SELECT conv_id, 0, 0, '' FROM c),
lengths AS (SELECT conv_id, max(d) AS last FROM m GROUP BY 1),
v AS MATERIALIZED (SELECT d, key, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size FROM m GROUP BY 1, 2),
up AS MATERIALIZED (SELECT v.d, v.key, v.n_convs, v.size, m.d AS at, m.key AS above FROM v JOIN m ON m.conv_id = v.conv_id AND m.d <= v.d),
parents AS (SELECT up.d, up.key, up.above, v.conv_id AS parent FROM up JOIN v ON v.d = up.at AND v.key = up.above WHERE up.at = up.d - 1),
kids AS (SELECT d - 1 AS d, above AS key, count(*) AS n FROM parents GROUP BY 1, 2),
sums AS (SELECT up.at AS d, up.above AS key, sum((up.n_convs - 1) * up.size) AS saved, count(*) FILTER (WHERE kids.n IS NULL) AS leaves
         FROM up LEFT JOIN kids ON kids.d = up.d AND kids.key = up.key GROUP BY 1, 2),
ends AS (SELECT m.d, m.key, string_agg(m.conv_id::VARCHAR, ',' ORDER BY m.conv_id) AS ids FROM m JOIN lengths l ON l.conv_id = m.conv_id AND l.last = m.d GROUP BY 1, 2)
SELECT v.conv_id, v.d AS depth, parents.parent AS parent_conv_id, v.n_convs, coalesce(kids.n, 0) AS n_children, sums.leaves AS n_leaves, sums.saved::BIGINT AS saved_tokens,
       sha256(coalesce(ends.ids, '')) AS ends_sha256
FROM v JOIN sums USING (d, key) LEFT JOIN parents USING (d, key) LEFT JOIN kids USING (d, key) LEFT JOIN ends USING (d, key)""",
    "op13_merkle_manifest": rf"""
WITH RECURSIVE cells AS (
  SELECT doc_id, source, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
         || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head, text FROM documents),
leaves AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY source) AS n
  FROM (SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
               CASE WHEN doc_id IS NOT NULL AND {crc32_sql("coalesce(doc_id, 0)")} % 5 = 0
                    THEN sha256(head || coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) END AS tampered FROM cells)),
inner_nodes(l, source, n, i, h) AS (
  SELECT 0, source, n, i, leaf FROM leaves
  UNION ALL SELECT l + 1, source, (n + 15) // 16, i // 16, sha256(string_agg(h, '' ORDER BY i)) FROM inner_nodes WHERE n > 1 GROUP BY l, source, n, i // 16),
subroots AS MATERIALIZED (SELECT source, l AS height, h, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM inner_nodes WHERE n = 1),
outer_nodes(l, n, i, h) AS (
  SELECT 0, n, i, h FROM subroots UNION ALL SELECT l + 1, (n + 15) // 16, i // 16, sha256(string_agg(h, '' ORDER BY i)) FROM outer_nodes WHERE n > 1 GROUP BY l, n, i // 16),
runs AS (
  SELECT l, source, i // 16 AS run, list(h ORDER BY i) AS hs FROM inner_nodes WHERE n > 1 GROUP BY 1, 2, 3
  UNION ALL SELECT s.height + o.l, s.source, o.run, o.hs FROM subroots s JOIN (SELECT l, i // 16 AS run, list(h ORDER BY i) AS hs FROM outer_nodes WHERE n > 1 GROUP BY 1, 2) o ON s.i // (16 ** o.l)::BIGINT // 16 = o.run),
fold(doc_id, source, leaf, row, l, i, h, proof) AS (
  SELECT doc_id, source, leaf, i, 0, i, coalesce(tampered, leaf), '' FROM leaves
  UNION ALL
  SELECT f.doc_id, f.source, f.leaf, f.row, f.l + 1, CASE WHEN f.l + 1 = s.height THEN s.i ELSE j // 16 END,
         sha256(array_to_string(r.hs[:j % 16], '') || f.h || array_to_string(r.hs[j % 16 + 2:], '')), f.proof || array_to_string(r.hs[:j % 16], '') || array_to_string(r.hs[j % 16 + 2:], '')
  FROM (SELECT f.*, CASE WHEN f.l = 0 AND x.height = 0 THEN x.i ELSE f.i END AS j FROM fold f JOIN subroots x ON x.source IS NOT DISTINCT FROM f.source) f
  JOIN subroots s ON s.source IS NOT DISTINCT FROM f.source JOIN runs r ON r.l = f.l AND r.source IS NOT DISTINCT FROM f.source AND r.run = j // 16),
done AS (SELECT doc_id, source, leaf, row, arg_max(h, l) AS folded_root, sha256(arg_max(proof, l)) AS proof_sha256 FROM fold GROUP BY 1, 2, 3, 4)
SELECT d.doc_id, d.leaf, s.h AS subroot, root.h AS root, d.proof_sha256, d.folded_root, d.folded_root = root.h AS verified
FROM done d JOIN subroots s ON s.source IS NOT DISTINCT FROM d.source, (SELECT arg_max(h, l) AS h FROM outer_nodes) root""",
}
