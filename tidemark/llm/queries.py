"""The registered training-data queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.audits import repair_conversations
from tidemark.llm.bpe import bpe_round_trip
from tidemark.llm.exact_dedup import exact_duplicates
from tidemark.llm.jaccard_join import jaccard_components
from tidemark.llm.notices import license_scan
from tidemark.llm.packing import pack_powers
from tidemark.llm.quality import judged
from tidemark.llm.resharding import reshard
from tidemark.llm.spellings import spelling_variants
from tidemark.llm.surrogates import with_surrogates
from tidemark.llm.templates import main_text
from tidemark.llm.toxicity import toxicity, train_on
from tidemark.llm.twins import CONVERSATIONS, JACCARD, QUALITY, SPELLINGS
from tidemark.llm.warc import read_warc, write_warc
from tidemark.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_exact_dedup", """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
""")
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the copy that stays; of equal texts the largest doc_id."""
    return exact_duplicates(table(spark, sf_dir, "documents"), keep="largest").select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def tokenizer_path(name: str) -> str:
    """Where the tokenizer package keeps a vocabulary; the same place on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op2_bpe_round_trip")
def op2_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded with the word-end vocabulary, as digests."""
    coded = bpe_round_trip(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query("op3_power_packing")
def op3_power_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens, each a power of two long."""
    pieces = pack_powers(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset", "bucket")


@query("op10_quality_rules", QUALITY)
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document under the base rules and the cutoffs proven on the labelled ones."""
    return judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "failed_rule")


@query("op5_warc_round_trip", """
SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN best END AS refers_to
FROM (SELECT *, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS best,
             octet_length(encode(coalesce(html, ''))) >= 1000
             AND page_id < max(page_id) OVER (PARTITION BY coalesce(html, '')) AS again FROM pages)
""")
def op5_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC archives and read back."""
    path = write_warc(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    return read_warc(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op7_flow_resharding")
def op7_flow_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents moved from six shards by source, uneven by nature, to eight of equal bytes."""
    old = F.pmod(F.xxhash64(F.coalesce("source", F.lit(""))), F.lit(6))
    placed = reshard(table(spark, sf_dir, "documents"), old, [1.0] * 8, scratch_path(spark, "shards"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "old_shard")


@query("op9_jaccard_join", JACCARD)
def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its class under links of 3-word shingles at a similarity of 0.9."""
    found = jaccard_components(table(spark, sf_dir, "documents"), width=3, num=90, den=100)
    return found.select("doc_id", "n_shingles", "component_id")


@query("op4_toxicity_chain")
def op4_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document under a chain: abuse in English, abuse in another language, abuse at all."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    languages = docs.groupBy("doc_id").agg(F.min("lang").alias("lang"))
    toxic, english = F.col("toxic") > 0, F.coalesce(F.col("lang"), F.lit("")) == "en"
    marked = labels.join(languages, "doc_id").select(
        "doc_id", (toxic & english).cast("int").alias("toxic_english"),
        (toxic & ~english).cast("int").alias("toxic_foreign"), toxic.cast("int").alias("toxic"))
    chain = train_on(docs, marked, ["toxic_english", "toxic_foreign", "toxic"])
    return toxicity(docs, chain).drop("uid")


SURROGATE_KEY = "a key that a real run takes from its secret store"


@query("op8_pii_surrogates")
def op8_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced by surrogates."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = with_surrogates(docs, SURROGATE_KEY, spans="spans")
    return found.select("doc_id", "text", F.size("spans").cast("long").alias("n_entities"),
                        F.array_sort(F.array_distinct(F.col("spans.kind"))).alias("kinds"))


@query("op6_template_text")
def op6_template_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    found = main_text(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query("op11_license_notices")
def op11_license_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its license phrases, and the notices found with bounded errors."""
    return license_scan(table(spark, sf_dir, "documents"))


def damaged(rows: DataFrame) -> DataFrame:
    """Messages with faults planted by a checksum of their place; a dropped row stays, marked ``gone``."""
    blank = F.lit(" ")
    place = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")])
    fault = F.crc32(place.cast("binary")) % 20
    text, role = F.coalesce("text", blank), F.coalesce("role", blank)
    return rows.select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(role).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (fault == 0).alias("gone"), F.explode(F.array_repeat(F.lit(0), F.when(fault == 3, 2).otherwise(1))).alias("copy"))


@query("op13_audited_conversations", CONVERSATIONS)
def op13_audited_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged and repaired by its cheapest edits."""
    return repair_conversations(damaged(table(spark, sf_dir, "conversations")), gone=F.col("gone")).drop("messages")


@query("op12_spelling_variants", SPELLINGS)
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents with the spelling that it is a variant of."""
    return spelling_variants(table(spark, sf_dir, "documents"))
