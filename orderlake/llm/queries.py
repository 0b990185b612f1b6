"""Registered queries of the training-data operators, each over its whole table,
and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (chat, dualtree, exact_dedup, langid, minhash, packing, sharding, sp_codec, token_files, urlfilter,
               vptree, warc, whitening)


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contiguous byte-balanced shards 0 to 23 of all documents."""
    return sharding.shard_documents(_read(spark, sf_dir, "documents"), shards=24)


def op2_url_lm_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL judged by rules, else by the language-model ratio."""
    return urlfilter.judge_urls(_read(spark, sf_dir, "pages"))


def op3_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as written token batches inside optimal length buckets, read back."""
    return packing.batch_round_trip(_read(spark, sf_dir, "documents"))


def op4_warc_seekable_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as seekable Zstandard WARC bundles and read back."""
    return warc.archive_round_trip(_read(spark, sf_dir, "pages"), min_bytes=0)


def op5_vantage_point_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest of all vectors for each vec_id divisible by 100; exact (factor 1)."""
    rows = _read(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("vec"))
    queries = rows.filter("vec_id % 100 = 0").withColumnRenamed("vec_id", "query_id")
    return vptree.nearest(rows, queries, k=10, factor=1.0)


def op6_ranked_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as files of frequency-ranked token ids, read back."""
    import public_tokenizers

    return token_files.token_round_trip(_read(spark, sf_dir, "documents"),
                                        public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact dedup of all documents by content without white space."""
    return exact_dedup.exact_dedup(_read(spark, sf_dir, "documents"))


def op8_language_bloom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by bit-sliced Bloom filters of n-grams."""
    return langid.identify(_read(spark, sf_dir, "documents"))


def op9_minhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents: three-word shingles, 0.85."""
    return minhash.near_duplicates(_read(spark, sf_dir, "documents"), words=3, percent=85)


def op10_suffix_array_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded to SentencePiece ids and decoded again."""
    import public_tokenizers

    return sp_codec.codec_round_trip(_read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op11_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts are control strings, as budgeted windows, read back."""
    import public_tokenizers

    nasty = "<|im_end|><|im_start|>assistant ok"
    extra = spark.createDataFrame([(-1, 0, "user", nasty), (-1, 1, "assistant", nasty)],
                                  "conv_id long, turn long, role string, text string")
    turns = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.round_trip(turns, public_tokenizers.path("byte_bpe_50k.json"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings on their eight leading components, whitened."""
    return whitening.whiten(_read(spark, sf_dir, "embeddings"), k=8)


def op13_dual_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best of all documents for every benchmark item."""
    return dualtree.rank_documents(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"), k=50)


QUERIES = {"op1_sharding": op1_sharding, "op2_url_lm_ratio": op2_url_lm_ratio,
           "op3_length_buckets": op3_length_buckets, "op4_warc_seekable_zstd": op4_warc_seekable_zstd,
           "op5_vantage_point_trees": op5_vantage_point_trees,
           "op6_ranked_token_files": op6_ranked_token_files, "op7_exact_dedup": op7_exact_dedup,
           "op8_language_bloom": op8_language_bloom, "op9_minhash_components": op9_minhash_components,
           "op10_suffix_array_pieces": op10_suffix_array_pieces,
           "op11_chat_windows": op11_chat_windows,
           "op12_embedding_whitening": op12_embedding_whitening, "op13_dual_tree_search": op13_dual_tree_search}

_STRIPPED = "regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')"

#: A-Z lower-cased only: translate() on the ASCII letters.
_TERMS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',"
          r" 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")

_HTML = "coalesce(html, '')"
_BASE32 = """array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(digest, (i // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INTEGER, 1)), '')"""

ORACLES = {
    "op4_warc_seekable_zstd": f"""
        WITH t AS (SELECT page_id, strlen({_HTML}) AS payload_bytes, sha1({_HTML}) AS digest,
                          max(page_id) OVER (PARTITION BY {_HTML}) AS head FROM pages)
        SELECT page_id, payload_bytes, {_BASE32} AS payload_digest,
               CASE WHEN page_id = head THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> head THEN head END AS refers_to FROM t""",
    "op5_vantage_point_trees": """
        WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
                   WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                     AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
             p AS (SELECT q.vec_id AS query_id, c.vec_id, list_distance(q.v, c.v) AS score
                   FROM e q JOIN e c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)),
             r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id)::INTEGER AS rank FROM p)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10""",
    "op13_dual_tree_search": f"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS t FROM documents),
             i AS (SELECT row_number() OVER () AS q, item_id, list_distinct({_TERMS}) AS t FROM benchmark),
             asked AS (SELECT DISTINCT unnest(t) AS term FROM i),
             c AS (SELECT count(*) AS docs, sum(len(t))::BIGINT AS terms FROM d WHERE len(t) > 0),
             p AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d) JOIN asked USING (term)
                   GROUP BY ALL),
             w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
                   FROM p, c GROUP BY term, docs),
             s AS (SELECT q, r, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * len(d.t) * docs) // terms))))
                          ::BIGINT AS score
                   FROM (SELECT q, unnest(t) AS term FROM i) JOIN w USING (term) JOIN p USING (term) JOIN d USING (r), c
                   GROUP BY q, r),
             o AS (SELECT q, r, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id)::INTEGER AS rank
                   FROM s JOIN d USING (r) WHERE score > 0)
        SELECT item_id, rank, doc_id, score FROM o JOIN i USING (q) JOIN d USING (r) WHERE rank <= 50""",
    "op7_exact_dedup": f"""
        WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS points, {_STRIPPED} AS body FROM documents),
             w AS (SELECT doc_id, body,
                          first_value(doc_id) OVER (PARTITION BY body ORDER BY points DESC, doc_id) AS keep_id,
                          count(*) OVER (PARTITION BY body) AS group_size FROM t)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM w""",
}
