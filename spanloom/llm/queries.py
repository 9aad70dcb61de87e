"""The operators' queries over the given tables, and their SQL where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, divergence, gif, html, langid, lines, mixing, oracles, pii, repeats, sharding, toxicity, turns
from .minhash import near_duplicates
from .storage import materialize


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; fitted on the labelled rows that aren't held out."""
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit(docs.where(~toxicity.held_out(F.col("doc_id"))), _table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "n_passages",
    )


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-word shingles at similarity 0.8 over all documents."""
    return near_duplicates(_table(spark, sf_dir, "documents"), k=2, percent=80)


def op3_prefix_free_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document left when repeated strings of 400 bytes are removed."""
    return repeats.repeated_spans(_table(spark, sf_dir, "documents")).drop("spans")


def op4_extendible_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard of every document, at most 16 MiB of text each."""
    docs = _table(spark, sf_dir, "documents")
    sized = docs.withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    return sharding.assign_shards(sized).select("doc_id", "n_bytes", "shard_depth", "shard_prefix", "shard_id")


def op5_gif_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document stored as an animated GIF, read back, with digests and colour histogram."""
    return gif.digests(gif.text_media(_table(spark, sf_dir, "documents")))


def op6_host_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page, by the container path that its host's pages agree on."""
    return html.extract_pages(_table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars", "container")


def op7_subword_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; fitted on the rows that aren't held out."""
    docs = _table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(~langid.held_out(F.col("doc_id"))))
    return langid.predict(docs, model).select(
        "doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "accepted"
    )


def op8_chain_field_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: the patterns' spans and those that the field adds."""
    return pii.span_digests(pii.find_personal_data(_table(spark, sf_dir, "documents")))


def op9_pivotal_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    docs = _table(spark, sf_dir, "documents")
    sizes = materialize(docs.select("doc_id", "source", mixing.n_words(F.col("text")).alias("n_words")), "sizes")
    return mixing.mix(sizes, size="n_words").select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op10_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark items that every document leaks."""
    found = decontam.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", (F.size("items") > 0).alias("leaked"), F.size("items").cast("long").alias("n_items"), F.array_join(F.transform("items", lambda i: i.cast("string")), ",").alias("items"), "best"
    )


def op11_twice_seen_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document that stay when lines of many documents are kept in one of them."""
    out = lines.drop_repeated_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How every source's words differ from those of its language and of the other sources there."""
    return divergence.divergence(_table(spark, sf_dir, "documents"))


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cheapest repair of every damaged conversation."""
    return turns.repair(turns.damage(_table(spark, sf_dir, "conversations")))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_minhash_near_dedup": op2_minhash_near_dedup,
    "op3_prefix_free_parsing": op3_prefix_free_parsing,
    "op4_extendible_sharding": op4_extendible_sharding,
    "op5_gif_media": op5_gif_media,
    "op6_host_consensus": op6_host_consensus,
    "op7_subword_langid": op7_subword_langid,
    "op8_chain_field_pii": op8_chain_field_pii,
    "op9_pivotal_mixing": op9_pivotal_mixing,
    "op10_spaced_seeds": op10_spaced_seeds,
    "op11_twice_seen_lines": op11_twice_seen_lines,
    "op12_source_divergence": op12_source_divergence,
    "op13_turn_repair": op13_turn_repair,
}
ORACLES: dict[str, str] = {
    "op2_minhash_near_dedup": oracles.NEAR_DUPLICATES,
    "op3_prefix_free_parsing": oracles.REPEATS,
    "op4_extendible_sharding": sharding.shard_sizes_sql(),
    "op10_spaced_seeds": oracles.LEAKS,
    "op11_twice_seen_lines": oracles.LINES,
    "op12_source_divergence": oracles.DIVERGENCE,
    "op13_turn_repair": oracles.TURNS,
}
