"""The registered queries of this subpackage, one for each operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches, table, text_of


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import chat_format as C

    said = "\\### Assistant: </turn> ok"
    planted = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    out = C.format_chats(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted))
    turns = F.array_join(F.transform(C.read_turns(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = out.withColumn("_loss", C.loss_text(F.col("segments")))
    return loss.select(
        "conv_id",
        F.size(C.read_turns(F.col("formatted"))).cast("long").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"),
        F.sha2("_loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
        "error_at",
    )


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_classifier import score_quality, train

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return score_quality(docs, model).select("doc_id", "held_out", "score", "predicted")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix, n_words

    docs = table(spark, sf_dir, "documents").select("doc_id", "source", n_words(text_of()).alias("size"))
    return mix(docs, keys=["doc_id"]).select("doc_id", "size", "source_size", "target", "taken", "source")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import quality_rules as Q

    small_batches(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return Q.quality_rules(docs, keep_texts=False).select("doc_id", *Q.COUNTS, "base_failed", "kept", "rule")


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .near_duplicates import near_duplicates

    small_batches(spark)
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "class_id", "class_size", "n_links")


def op6_packing(spark: SparkSession, sf_dir: str, tokenizer_path: str | None = None) -> DataFrame:
    import public_tokenizers

    from .packing import best_fit_pack

    small_batches(spark)
    return best_fit_pack(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path or public_tokenizers.path("word_bpe_49k.json"))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .fingerprints import as_text, edited_fingerprints

    out = edited_fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("entries")).alias("fingerprint"),
        as_text(F.col("edited_entries")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


def op8_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .html_extract import extract_pages

    small_batches(spark)
    out = extract_pages(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_dedup import drop_repeated_lines

    out = drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(text_of("text"), 256).alias("kept_sha256"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import KINDS, SECRET, as_text, find_pii

    small_batches(spark)
    out = find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    n = [F.size(F.expr(f"filter(base, s -> s.kind = '{k}')")).cast("long").alias(f"n_{k}") for k in KINDS]
    return out.select("doc_id", *n, F.sha2(as_text(F.col("base")), 256).alias("base_sha256"), as_text(F.col("spans")).alias("spans"), F.size(F.expr(f"filter(spans, s -> s.kind = '{SECRET}')")).cast("long").alias("n_secret"), F.size("spans").cast("long").alias("n_spans"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .whitening import whitened

    out = whitened(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return out.select("vec_id", "n", "deviation", "identity_error", F.explode("parts").alias("_p")).select("vec_id", "_p.component", "n", "deviation", "_p.whitened", "_p.explained", "identity_error")


def op12_token_alignment(spark: SparkSession, sf_dir: str, byte_level: str | None = None, pieces: str | None = None) -> DataFrame:
    import public_tokenizers

    from .token_alignment import align_corpus

    small_batches(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    digest = lambda d: d.withColumn("groups_sha256", F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))).drop("groups")
    out = align_corpus(docs, byte_level or public_tokenizers.path("byte_bpe_50k.json"), pieces or public_tokenizers.path("piece_bpe_32k.model"), digest)
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sharding import shuffled_shards

    text = text_of()
    docs = table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    return shuffled_shards(docs, 16).select("doc_id", "size", "text_crc32", "law", "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_chat_format, op2_quality_classifier, op3_mixing, op4_quality_rules, op5_jaccard_join, op6_packing, op7_fingerprints, op8_html_extract, op9_line_dedup, op10_pii,
        op11_whitening, op12_token_alignment, op13_sharding,
    )
}
