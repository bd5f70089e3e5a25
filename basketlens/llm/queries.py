"""Named queries of the corpus operators, with the parameters of production, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.llm import curve_packing, decontaminate, exact_dedup, html_text, language_id, near_dedup, packing, prefix_trie, repair, sharding, suffix_dedup, toxicity, warc
from basketlens.llm.columns import shared_folder


def _read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _remainder(key: str, parts: int):
    """crc32 of the key as text, modulo parts."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % parts


def op1_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(_read(spark, folder, "documents"))


def op2_warc(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_folder(spark, "warc")
    warc.write_archives(_read(spark, folder, "pages"), path)
    return warc.read_archives(spark, path)


def op3_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_by_bytes(_read(spark, folder, "documents"), 8)


def op4_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_read(spark, folder, "documents")).drop("kept")


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _read(spark, folder, "documents")
    held_out = F.coalesce(_remainder("doc_id", 5) == 0, F.lit(False))
    model = toxicity.learn(docs.where(~held_out), _read(spark, folder, "labels"))
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op6_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(_read(spark, folder, "pages"))


def op7_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contamination(_read(spark, folder, "documents"), _read(spark, folder, "benchmark"))


def pack_documents(docs: DataFrame) -> DataFrame:
    special = packing.added_tokens(public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, special=special)


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(_read(spark, folder, "documents"))


def op9_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_read(spark, folder, "documents"))


def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = _read(spark, folder, "documents")
    held_out = F.coalesce(_remainder("doc_id", 4) == 2, F.lit(False))
    model = language_id.learn(docs.where(~held_out))
    found = language_id.identify(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    turns, members = prefix_trie.with_shared_starts(prefix_trie.marked_turns(_read(spark, folder, "conversations")))
    return prefix_trie.trie(turns, members)


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return repair.repair(repair.damaged(_read(spark, folder, "conversations")))


def op13_curve_packing(spark: SparkSession, folder: str) -> DataFrame:
    special = packing.added_tokens(public_tokenizers.path("byte_bpe_50k.json"))
    docs = _read(spark, folder, "documents")
    return curve_packing.pack_along_curve(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, special=special)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in [
        op1_minhash_near_dedup,
        op2_warc,
        op3_sharding,
        op4_suffix_dedup,
        op5_toxicity,
        op6_html_text,
        op7_decontaminate,
        op8_packing,
        op9_exact_dedup,
        op10_language_id,
        op11_prefix_trie,
        op12_conversation_repair,
        op13_curve_packing,
    ]
}

SQL: dict[str, str] = {
    "op2_warc": warc.SQL,
    "op7_decontaminate": decontaminate.SQL,
    "op9_exact_dedup": exact_dedup.SQL,
    "op11_prefix_trie": prefix_trie.SQL,
}
