"""Registered queries of this subpackage and their SQL, where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import (
    classifier, embedding_dedup, line_dedup, minhash, mixing, pii, quality_rules, sentencepiece, sharding, url_filter,
    vector_codes, warc, whitening)
from tallyloom.llm.common import joined, table
from tallyloom.session import scratch_path

# Read on the driver only; its tables go to the tasks.
TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"
SHARD_BYTES = 8 << 20

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run
    return register


@query("op4_quality_rules")
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"), ["doc_id"])
    shown = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judged.select("doc_id", *[quality_rules.count(c).alias(c) for c in shown],
                         F.round(quality_rules.count("p_good"), 6).alias("p_good"))


@query("op6_minhash")
def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.group(table(spark, sf_dir, "documents"), words=2)


@query("op7_pii")
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.counts_of(pii.find(table(spark, sf_dir, "documents"), ["doc_id"]), ["doc_id"])


@query("op10_mixing", mixing.oracle())
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang"))
    own = {c: F.col(mixing.OWN + c) for c in ("source", "lang", "topic", "tokens", "prob", "sampled")}
    own["prob"] = F.round(own["prob"], 6)
    return mixed.select("doc_id", *[c.alias(name) for name, c in own.items()])


@query("op1_sentencepiece")
def op1_sentencepiece(spark: SparkSession, sf_dir: str, model: str = TOKENIZER) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    coded = sentencepiece.encode(docs, sentencepiece.Model.read(model), ["doc_id"])
    return coded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_ids"), "round_trip")


@query("op2_sharding", sharding.oracle(SHARD_BYTES))
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shards are written and read back; sizes are those of the texts as read."""
    docs = table(spark, sf_dir, "documents")
    path = scratch_path(spark, "shards")
    sharding.write(sharding.assign(docs, "doc_id", F.octet_length("text"), SHARD_BYTES), path)
    back = sharding.read(spark, path, docs.schema)
    shard = F.col(sharding.OWN + "id")
    return back.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
                       shard.alias("shard"), F.length(shard).cast("long").alias("depth"),
                       F.col(sharding.OWN + "total").alias("shard_bytes"))


@query("op8_warc", warc.oracle())
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    return warc.read(warc.archives(index)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op9_quality_classifier")
def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    scored = classifier.score(docs, labels.select("doc_id", F.col("quality").alias("label")).where(~held_out))
    return scored.select("doc_id", held_out.alias("held_out"), "score",
                         F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))


@query("op3_embedding_dedup")
def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.link(table(spark, sf_dir, "embeddings"))


URL_RULES = [url_filter.Fixed("block", "net", "/"), url_filter.Fixed("allow", "example.net", "/en/"),
             url_filter.Fixed("block", "example.com", "/de/"), url_filter.Fixed("allow", "org", "/fr/")]


@query("op5_url_filter")
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page is labelled by the document whose number ends its path: bad if poor or toxic."""
    pages, labels = table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")
    number = F.regexp_extract(url_filter.path_of(F.col("url")), r"/([0-9]{1,18})(?:\.[a-z]+|/)?$", 1)
    numbered = pages.select("url", F.when(number != "", number).cast("long").alias("doc_id"))
    bad = labels.groupBy("doc_id").agg(F.max((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    labelled = joined(numbered, bad, ["doc_id"]).select("url", "bad")
    return url_filter.judge(pages, labelled, URL_RULES).drop("url")


@query("op11_whitening")
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query("op12_vector_codes")
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings")).select(
        "vec_id", "code", "error", "label_error", "codebooks_sha256")


@query("op13_line_dedup", line_dedup.oracle())
def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.drop_common_lines(table(spark, sf_dir, "documents"))
    own = {c: F.col(line_dedup.OWN + c) for c in ("n_lines", "n_dropped", "kept")}
    return done.select("doc_id", own["n_lines"].alias("n_lines"), own["n_dropped"].alias("n_dropped"),
                       F.sha2(F.coalesce(own["kept"], F.lit("")), 256).alias("kept_sha256"))
