"""The thin queries: each applies its operator to the whole given table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, embedding_dedup, filter_audit, knn_join, langid, line_dedup, line_rules, minhash, mixing, quality,
               suffix_dedup, turn_repair, warc)
from ._common import shared_folder, table, word_count


def op2_warc_revisit(spark: SparkSession, sf: str) -> DataFrame:
    """Archive every page, rewrite the archives with each payload once, and
    report what the rewritten archives hold. A page without an id is left
    out (no record id could name it)."""
    raw, clean = shared_folder(spark, "warc-in"), shared_folder(spark, "warc-out")
    pages = table(spark, sf, "pages").filter("page_id is not null")
    warc.write_archives(warc.page_records(pages), raw)
    warc.deduplicate_archives(spark, raw, clean, warc.page_id_of(F.col("record_id")))
    back = warc.read_archives(spark, clean, payloads=False)
    return back.select(
        warc.page_id_of(F.col("record_id")).alias("page_id"),
        F.col("declared_bytes").alias("payload_bytes"), "payload_digest", "record_type",
        warc.page_id_of(F.col("refers_to_id")).alias("refers_to"))


def op8_mixing(spark: SparkSession, sf: str) -> DataFrame:
    """Mix all documents to the weights 3, 1, 2 by source."""
    docs = table(spark, sf, "documents").select(
        "doc_id", "source", word_count(F.col("text")).alias("size"))
    return mixing.taken(docs)


def op6_bpe_roundtrip(spark: SparkSession, sf: str, vocabulary: str | None = None) -> DataFrame:
    """Encode every text, decode the ids, and digest both. ``vocabulary`` is
    the path of a byte-level vocabulary file; unset, the installed public one."""
    if vocabulary is None:
        import public_tokenizers
        vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    docs = table(spark, sf, "documents").select("doc_id", "text")
    done = bpe.decode(bpe.encode(docs, vocabulary).select("doc_id", "ids"), vocabulary)
    return done.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


def op7_language_id(spark: SparkSession, sf: str) -> DataFrame:
    """Predict the language of every document; learn from two thirds of them.
    A document without an id is not learnt from and not held out."""
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs.filter(~held_out))
    found = langid.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"),
                        "lang_pred", "score", "rejected")


def op4_quality(spark: SparkSession, sf: str) -> DataFrame:
    """The quality of every document: source as host, language as path."""
    docs = table(spark, sf, "documents").select("doc_id", "text", "source", "lang")
    judged = quality.judge(docs, table(spark, sf, "labels"))
    return judged.select("doc_id", "p_doc", "host_rate", "path_rate", "p_quality", "kept")


def op1_minhash(spark: SparkSession, sf: str) -> DataFrame:
    """Near-duplicate documents at a Jaccard similarity of 0.85."""
    return minhash.near_duplicates(table(spark, sf, "documents"))


def op9_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Remove every byte covered by 100 bytes that also start earlier."""
    found = suffix_dedup.remove_repeats(table(spark, sf, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans",
                        F.sha2("kept", 256).alias("kept_sha256"))


def op10_knn_join(spark: SparkSession, sf: str) -> DataFrame:
    """The five best of all vectors for each whose id is divisible by 50."""
    vectors = knn_join.quantised(table(spark, sf, "embeddings"), "vec_id", "embedding")
    return knn_join.top_k(vectors.filter("id % 50 = 0"), vectors, 5)


def op5_embedding_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Near-duplicate embeddings of a label at a cosine of 0.93."""
    return embedding_dedup.near_duplicates(table(spark, sf, "embeddings"))


def op3_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Every line of every document, its group, and whether it stays."""
    return line_dedup.judged_lines(table(spark, sf, "documents"))


def op11_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's base counts, and whether line-first cleaning keeps it."""
    found = line_rules.judged(table(spark, sf, "documents").select("doc_id", "text"))
    return found.select("doc_id", *line_rules.RESULT)


def op13_filter_audit(spark: SparkSession, sf: str) -> DataFrame:
    """What five filters remove from each source, in all orders of them."""
    docs = table(spark, sf, "documents").select("doc_id", "text", "source")
    return filter_audit.audit(filter_audit.patterns(docs, table(spark, sf, "labels")))


def op12_turn_repair(spark: SparkSession, sf: str) -> DataFrame:
    """Damage every conversation, and find the cheapest repair of each."""
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    return turn_repair.report(turns, turn_repair.damaged(turns))
