"""The queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirflow.llm import bpe, copies, html, lm, packing, quality, ranked, recompress, repair, sharding, simhash, suffixes, topk
from weirflow.llm.common import id_and_text
from weirflow.session import configure

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name, with SQL for the same rows if there is any."""

    def add(f: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(configure(spark), sf_dir)

        QUERIES[f.__name__] = run
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query()
def op1_sharding(spark, sf):
    docs = _table(spark, sf, "documents")
    # Whole documents are scattered and shuffled; the digests are of what comes out.
    sharded = sharding.shard_rows(docs.withColumn("bytes", sharding.row_bytes(docs)), 40, "bytes")
    text = F.coalesce(F.col("text"), F.lit(""))
    return sharded.select(
        "doc_id", F.col("bytes").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _rule_sql(r: quality.Rule) -> str:
    scale = f"{r.bottom}::DOUBLE" if r.bottom else "1::DOUBLE"
    bounds = [f"{r.top} {sign} {limit}::DOUBLE * {scale}" for sign, limit in (("<", r.low), (">", r.high)) if limit is not None]
    return f"(n_words >= {r.min_words} AND ({' OR '.join(bounds)}))"


_STOPS = ", ".join(f"'{w}'" for w in quality.STOP_WORDS)
_BASE = " OR ".join(map(_rule_sql, quality.BASE_RULES))
_BROKEN = " OR ".join(map(_rule_sql, quality.RULES))


@query(
    f"""WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
    w AS (SELECT r, doc_id, text, list_filter(regexp_split_to_array(text, '[ \\t-\\r]+'), lambda x: x <> '') AS words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ \\t-\\r]')) AS lines FROM t),
    places AS (SELECT r, words, unnest(generate_series(1, len(words) - 4)) AS i FROM w),
    windows AS (SELECT r, i, count(*) OVER (PARTITION BY r, words[i:i+4]) AS n FROM places),
    again AS (SELECT r, count(DISTINCT j)::BIGINT AS n_repeat_words
        FROM (SELECT r, unnest(generate_series(i, i + 4)) AS j FROM windows WHERE n > 1) GROUP BY r),
    m AS (SELECT doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
        len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(regexp_extract_all(text, '!'))::BIGINT AS n_exclaims,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines)::BIGINT AS n_lines,
        len(list_filter(words, lambda x: x IN ({_STOPS})))::BIGINT AS n_stop_words, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
        FROM w LEFT JOIN again USING (r))
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, {_BASE} AS base_failed,
        NOT ({_BASE} OR {_BROKEN}) AS kept FROM m"""
)
def op10_quality(spark, sf):
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    return quality.quality_rules(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query()
def op2_html(spark, sf):
    return html.extract_text(_table(spark, sf, "pages"))


@query()
def op5_packing(spark, sf):
    return packing.pack_sequences(_table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query()
def op7_bpe(spark, sf):
    return bpe.bpe_round_trip(_table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query(
    """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS w FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
    SELECT query_id, rank, vec_id, score FROM (
        SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.w, c.w)::BIGINT AS score,
            row_number() OVER (PARTITION BY q.vec_id ORDER BY list_inner_product(q.w, c.w) DESC, c.vec_id)::INTEGER AS rank
        FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.w) = len(c.w) WHERE q.vec_id % 20 = 0) WHERE rank <= 20"""
)
def op8_top_k(spark, sf):
    return topk.top_k(_table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0, 20)


@query()
def op9_simhash(spark, sf):
    return simhash.near_duplicates(_table(spark, sf, "documents"), words_per_shingle=3, bits=3)


@query()
def op6_lm(spark, sf):
    return lm.score_texts(_table(spark, sf, "documents"))


@query()
def op4_recompression(spark, sf):
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    cut = recompress.dedup_passages(docs, window=20)
    words = F.filter(F.split(F.coalesce("text", F.lit("")), "[ \t-\r]+"), lambda w: w != "")
    kept = F.sha2(F.array_join(words, " ").cast("binary"), 256)
    return cut.select("doc_id", "n_words", "n_removed", kept.alias("kept_sha256"))


@query()
def op3_suffixes(spark, sf):
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    return suffixes.dedup_bytes(docs, size=50).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query()
def op11_repair(spark, sf):
    return repair.repair_conversations(repair.damage(_table(spark, sf, "conversations"))).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
    )


@query(
    """SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(coalesce(text, '')) AS text_sha256
       FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))"""
)
def op12_copies(spark, sf):
    return copies.exact_copies(_table(spark, sf, "documents"))


def _terms_sql(table: str, id_col: str) -> str:
    return f"""SELECT {id_col}, term, count(*) AS tf FROM (
        SELECT row_number() OVER () AS r, {id_col}, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM {table}
    ) GROUP BY r, {id_col}, term"""


@query(
    f"""WITH d AS ({_terms_sql("documents", "doc_id")}), i AS ({_terms_sql("benchmark", "item_id")}),
    lengths AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM d GROUP BY doc_id),
    t AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM lengths),
    w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM d, t GROUP BY term, docs),
    s AS (
        SELECT item_id, doc_id, sum(i.tf * w * ((1000000000 * d.tf) // (1000 * d.tf + 8 * (25 + (75 * n * docs) // terms))))::BIGINT AS score
        FROM i JOIN d USING (term) JOIN w USING (term) JOIN lengths USING (doc_id), t GROUP BY item_id, doc_id
    )
    SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INT AS rank, doc_id, score
    FROM s WHERE score > 0 QUALIFY rank <= 10"""
)
def op13_ranked(spark, sf):
    return ranked.search(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"), 10)
