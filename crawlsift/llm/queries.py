"""Registered queries of the training-data operators: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlsift.llm import (
    alignment,
    arc,
    bpe,
    decontaminate,
    exact_dedup,
    importance,
    line_windows,
    mixing,
    packing,
    rank_order,
    simhash,
    toxicity,
    trie,
)
from crawlsift.llm.common import table


#: Rank file of the tokenizer that the packing query and the pipeline use.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Vocabularies of the encoding and alignment queries.
BYTE_LEVEL = "/opt/tokenizers/byte_bpe_50k.json"
PIECES = "/opt/tokenizers/piece_bpe_32k.model"


def op1_token_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as packed rows of token ids, written as matrices and read back."""
    tokenizer = packing.Tokenizer.load(TOKENIZER)
    return packing.packed(table(spark, sf_dir, "documents"), tokenizer)


def op2_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that the chain flags as toxic, with the probability of each category.

    ``labels`` knows one category of toxicity; low quality comes before it in the chain.
    """
    labels = table(spark, sf_dir, "labels").withColumn("low_quality", 1 - F.col("quality"))
    docs = table(spark, sf_dir, "documents")
    chain = toxicity.learn(docs, labels, ["low_quality", "toxic"])
    return toxicity.flag_toxic(toxicity.score_toxicity(docs, chain))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op4_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents drawn by importance, with log weight and Gumbel key."""
    drawn = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return drawn.select("doc_id", "log_weight", "sample_key")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    rest = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3))
    profiles = rank_order.learn(docs.where(rest != 1), "text", "lang", F.col("doc_id"))
    found = rank_order.predict_languages(docs, profiles)
    return found.select("doc_id", F.coalesce(rest == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op6_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the later occurrences of repeated three-line windows."""
    cleaned = line_windows.remove_repeated_lines(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_removed", "text")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item, one row per document and item."""
    return decontaminate.contaminations(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact-duplicate group of every document."""
    found = exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"), digest_all=True)
    return found.withColumnRenamed("digest", "text_sha256")


#: Target mixture: weights by domain, language and source.
MIX = mixing.Mixture(
    domains={"web": 3, "reference": 2, "dialogue": 1},
    languages={"en": 4, "de": 2, "fr": 2, "es": 1},
    share=0.8,
    max_epochs=2,
    seed=17,
)


def mix_columns() -> dict[str, Column]:
    """Tree columns of ``documents``; a source's number says which domain it belongs to."""
    number = F.try_to_number(F.regexp_extract("source", "^src([0-9]{1,9})$", 1), F.lit("999999999"))
    return {
        "domain": F.when(number < 8, "web").when(number < 14, "reference").otherwise("dialogue"),
        "lang": F.col("lang"),
        "source": F.col("source"),
        "doc_id": F.col("doc_id"),
        "text": F.col("text"),
    }


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often the mixture takes each document; those it never takes are left out."""
    columns = mix_columns()
    mixed = mixing.mix_epochs(table(spark, sf_dir, "documents"), MIX, **columns)
    return mixed.where("epochs > 0").select(
        "doc_id",
        columns["domain"].alias("domain"),
        "lang",
        "source",
        mixing.count_tokens(F.col("text")).alias("tokens"),
        "epochs",
    )


def op10_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record after conversion from ARC to WARC and reading back."""
    return arc.archived_pages(table(spark, sf_dir, "pages"))


def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How two tokenizers' ids line up in every document, with corpus counts of linked ids."""
    tokenizers = alignment.Tokenizers(BYTE_LEVEL, PIECES)
    found = alignment.align(table(spark, sf_dir, "documents"), tokenizers)
    shown = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    return found.withColumn("groups_sha256", shown).drop("groups")


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations, with its subtree's totals."""
    return trie.prefix_trie(trie.rebuild(table(spark, sf_dir, "conversations")))


def op13_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded by byte-level BPE and decoded again."""
    return bpe.digests(table(spark, sf_dir, "documents"), bpe.Vocabulary(BYTE_LEVEL))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_token_packing": op1_token_packing,
        "op2_toxicity_chain": op2_toxicity_chain,
        "op3_simhash_near_dedup": op3_simhash_near_dedup,
        "op4_importance_resampling": op4_importance_resampling,
        "op5_language_id": op5_language_id,
        "op6_line_windows": op6_line_windows,
        "op7_decontamination": op7_decontamination,
        "op8_exact_dedup": op8_exact_dedup,
        "op9_mixing": op9_mixing,
        "op10_arc_to_warc": op10_arc_to_warc,
        "op11_cross_tokenizer_alignment": op11_cross_tokenizer_alignment,
        "op12_conversation_trie": op12_conversation_trie,
        "op13_bpe_round_trip": op13_bpe_round_trip,
    }
