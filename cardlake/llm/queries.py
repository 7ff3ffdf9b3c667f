"""One query per operator, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardlake.llm import (
    chat,
    decontamination,
    fingerprints,
    packing,
    quality,
    repeats,
    resampling,
    rules,
    secrets,
    similar,
    urlrules,
    warc,
    whitening,
)
from cardlake.llm.shared import shared_path, stored

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = packing.pieces(_read(spark, sf_dir, "documents"), TOKENIZER)
    found = found.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.packed(found)


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlrules.filtered_urls(_read(spark, sf_dir, "pages").select("page_id", "url")).select(
        "page_id", "host", "path", "rule", "verdict", "confidence"
    )


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    spans = secrets.judged_spans(docs, repository=["source", "lang"], owner="source")
    rows = secrets.with_spans(docs.select("doc_id", "text"), spans)
    found = F.col("secret_spans")
    base = F.filter(found, lambda s: s["kind_no"] < len(secrets.BASE))

    def count(kind):
        return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(some):
        return F.array_join(
            F.transform(some, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
        )

    return rows.select(
        "doc_id",
        *[count(kind) for kind, *_ in secrets.BASE],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(found).alias("spans"),
        F.size(F.filter(found, lambda s: s["live"])).cast("long").alias("n_live"),
    )


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_path(spark, "warc")
    archives = warc.write_archives(_read(spark, sf_dir, "pages"), folder)
    return warc.read_archives(archives, folder, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    buckets = 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = fingerprints.in_order(docs, buckets)
    chars = F.length("text")
    half = F.floor(chars / 2).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), chars - half), F.substring("next_text", F.lit(1), half)
    )
    rows = rows.select(
        "bucket", "place", "guest", F.col("id").alias("doc_id"), "text",
        chars.cast("long").alias("n_chars"), edited.alias("edited"),
        F.sha2(edited, 256).alias("edited_sha256"), fingerprints.text_key(F.col("text")).alias("text_key"),
    )
    own = F.struct(F.lit(False).alias("edit"), F.col("text").alias("body"))
    other = F.struct(F.lit(True).alias("edit"), F.col("edited").alias("body"))
    carried = ["guest", "doc_id", "n_chars", "edited_sha256", "text_key"]
    both = rows.select(
        "bucket", "place", *carried,
        F.explode(F.when(F.col("guest"), F.array(own)).otherwise(F.array(own, other))).alias("x"),
    ).select("bucket", "place", *carried, "x.*")
    marked = fingerprints.fingerprinted(both, "body", ["bucket", "place", "edit"], carried)
    found = stored(
        marked.groupBy("bucket", "place", *carried).agg(
            F.max(F.when(~F.col("edit"), F.col("fingerprint"))).alias("fingerprint"),
            F.max(F.when(F.col("edit"), F.col("fingerprint"))).alias("edited_fingerprint"),
        ),
        "fingerprints",
    )
    order = Window.partitionBy("bucket").orderBy("place")
    found = found.withColumn("next", F.lead("fingerprint").over(order)).where(~F.col("guest"))
    asked = found.where(F.col("doc_id") % 50 == 0)
    near = (
        fingerprints.within_radius(asked, found)
        .groupBy(F.col("fingerprint").alias("__f"))
        .agg(F.sum("n").alias("__n"))
    )
    alike = fingerprints.alike_counts(docs.where(F.col("doc_id") % 50 == 0), docs)
    result = found.select(
        "text_key",
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        fingerprints.likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        fingerprints.likeness(F.col("fingerprint"), F.col("next")).alias("near_next"),
    )
    is_query = F.col("doc_id") % 50 == 0
    result = result.join(
        stored(near, "near"), is_query & (F.col("fingerprint") == F.col("__f")), "left"
    ).join(
        stored(alike.withColumnRenamed("key", "__key"), "alike"),
        is_query & (F.col("text_key") == F.col("__key")),
        "left",
    )
    return result.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        "near_edited", "near_next",
        F.when(is_query, F.col("__n") - 1).alias("n_near"),
        F.when(is_query, F.col("n_alike") - 1).alias("n_alike"),
    )


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar.linked_documents(_read(spark, sf_dir, "documents"))


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chat.rotated(_read(spark, sf_dir, "conversations"))
    spans = F.array_join(
        F.transform("mask", lambda s: F.concat_ws("-", s["start"], s["end"])), ","
    )
    return rows.select(
        "conv_id", "speaker", "part", "n_turns", "rendered", spans.alias("mask")
    )


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    voters = quality.trained(docs, _read(spark, sf_dir, "labels"))
    return quality.scored(docs, voters).select(
        "doc_id", quality.is_held_out(F.col("doc_id")).alias("held_out"), "score", "predicted"
    )


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.without_repeats(_read(spark, sf_dir, "documents"))
    removed = F.aggregate(
        "spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]
    )
    return found.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.decontaminated(
        _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark")
    )
    names = F.array_join(F.array_sort(F.col("items").cast("array<string>")), ",")
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(names, 256).alias("items_sha256"),
        "contaminated",
    )


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _read(spark, sf_dir, "embeddings")
    model = whitening.fitted(vectors, "embedding")
    found = whitening.whitened(vectors.select("vec_id", "embedding"), model, "embedding")
    explained = F.lit([float(e / model.trace) for e in model.eigenvalues]).cast("array<double>")
    return found.select(
        "vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened")
    ).select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("place")).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judged(_read(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    found = resampling.weighed(docs, _read(spark, sf_dir, "benchmark")).drop("text")
    return resampling.drawn(found).select("doc_id", "n_features", "weight", "score", "rank")


QUERIES = {
    "op1_packing": op1_packing,
    "op2_url_filters": op2_url_filters,
    "op3_secret_scans": op3_secret_scans,
    "op4_warc": op4_warc,
    "op5_fingerprints": op5_fingerprints,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_chat": op7_chat,
    "op8_quality": op8_quality,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_decontamination": op10_decontamination,
    "op11_whitening": op11_whitening,
    "op12_quality_rules": op12_quality_rules,
    "op13_resampling": op13_resampling,
}
