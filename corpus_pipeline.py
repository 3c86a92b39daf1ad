"""From raw documents to packed training sequences, in four stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and read again as the next one's documents. All but the last return the columns of
documents; the last returns the packed pieces.

Defined results: null texts count as empty and fail the first stage, as texts without words do;
rows without an id are kept by the second, which keeps one of equal rows and the least id of a
group of near copies, and different texts that share an id; texts that are cut have their
``n_chars`` counted anew. Texts of any length are read whole. All columns of the input go along,
also such as have the name of a figure that a stage works out; an empty table gives no rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirflow.llm import packing, quality, recompress, simhash
from weirflow.llm.common import stored
from weirflow.operators.once import fence
from weirflow.session import configure


def _plain(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The documents with other names for all columns but id and text, so that none clashes with a figure."""
    names = {c: c if c in ("doc_id", "text") else f"c{i}" for i, c in enumerate(docs.columns)}
    return docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]), names


def _named(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(n).alias(c) for c, n in names.items()])


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break no quality rule."""
    plain, names = _plain(docs)
    judged = fence(quality.quality_rules(plain).select(*plain.columns, F.col("kept").alias("_kept")), ["_kept"])
    return _named(judged.where("_kept"), names)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words, a similarity of 0.8 or more."""
    plain, names = _plain(docs)
    return _named(simhash.near_copies(plain, words_per_shingle=5, similarity=0.8), names)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of 20 words or more that an earlier document has."""
    plain, names = _plain(docs)
    cut = recompress.dedup_passages(plain, window=20)
    if "n_chars" in names:
        size = names["n_chars"]
        counted = F.when(F.col("n_removed") > 0, F.char_length("text")).otherwise(F.col(size))
        cut = cut.withColumn(size, counted.cast(plain.schema[size].dataType))
    return _named(cut, names)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, with their sequence and place there."""
    # Workers live on and serve the other stages as well, so they remember fewer words.
    return packing.pack_sequences(docs, public_tokenizers.path("word_bpe_49k.json"), remembered=1 << 19)


STAGES = [
    ("quality rules", keep_good),
    ("near duplicates", drop_near_copies),
    ("substring dedup", cut_repeats),
    ("packing", pack),
]

#: Near duplicates, substring hashing and packing cannot be said in SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents."""
    docs = configure(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, name.replace(" ", "-"))
    return docs


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
