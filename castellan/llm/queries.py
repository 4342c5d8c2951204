"""The queries of the corpus operators over the driver's tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from castellan.llm.chat import format_windows, read_back
from castellan.llm.imatch import imatch_with_edits
from castellan.llm.licenses import scan_licenses
from castellan.llm.mixing import mix_sources
from castellan.llm.oracles import ORACLES as ORACLES
from castellan.llm.packing import pack
from castellan.llm.personal import BASE as PERSONAL
from castellan.llm.personal import scan_personal
from castellan.llm.quality import quality_verdicts
from castellan.llm.repair import damage, repair_conversations
from castellan.llm.secrets import BASE, scan_secrets
from castellan.llm.sharding import ShardedTable
from castellan.llm.simhash import simhash_components
from castellan.llm.templates import line_report
from castellan.llm.trie import numbered_turns, prefix_trie, rebuilt
from castellan.workspace import keep, new_path


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    table = ShardedTable(spark, new_path(spark, "shards"), docs.schema)
    for k in range(4):  # four arrivals, which together are all rows; what each leaves is compacted before the next
        table.append(docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(4)) == k))
        table.compact(target_bytes=64 << 20)
        table.vacuum()
    rows = table.read()
    shard = [F.col(f"_shard.{a}").alias(b) for a, b in (("name", "shard"), ("rows", "shard_rows"), ("bytes", "shard_bytes"), ("level", "level"), ("version", "version"))]
    return rows.select("doc_id", F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32"), "lang", "source", "n_chars", *shard)


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = scan_licenses(documents(spark, sf_dir))
    one = F.transform("notices", lambda x: F.concat_ws(":", x["license"], x["start"].cast("string"), x["end"].cast("string"), (x["missing"] + x["extra"]).cast("string")))
    return s.select(F.col("id").alias("doc_id"), "n_blocks", F.size("notices").cast("long").alias("n_notices"), F.array_join(one, ",").alias("notices"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = quality_verdicts(documents(spark, sf_dir))
    return v.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("distance", 6).alias("distance"))


def op4_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = imatch_with_edits(documents(spark, sf_dir))
    return m.select(F.col("id").alias("doc_id"), "n_chars", "edited_sha256", F.array_join("fp", "").alias("fingerprint"), F.array_join("edited_fp", "").alias("edited_fingerprint"), "near_edited", "near_next")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = mix_sources(documents(spark, sf_dir)).rows
    return m.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "copies", F.array_join(F.col("shards").cast("array<string>"), ",").alias("shards"))


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = "</s>[INST] ok [/INST]"
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    more = spark.range(1).select(F.explode(F.expr(f"array(named_struct('conv_id', -1L, 'turn', 0L, 'role', 'user', 'text', '{probe}'), named_struct('conv_id', -1L, 'turn', 1L, 'role', 'assistant', 'text', '{probe}'))")).alias("r")).select("r.*")
    b = read_back(format_windows(turns.unionByName(more)))
    return b.select(F.col("conv").alias("conv_id"), "n_turns", F.sha2("turns", 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars", "n_windows")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = pack(documents(spark, sf_dir), tokenizer_path=public_tokenizers.path("word_bpe_49k.json"))
    return p.select(F.col("id").alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = line_report(documents(spark, sf_dir))
    return r.select(F.col("id").alias("doc_id"), "n_lines", "n_dropped", "dropped", F.length("clean").cast("long").alias("clean_chars"), F.sha2("clean", 256).alias("clean_sha256"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(documents(spark, sf_dir))

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    counts = [F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in BASE]
    return found.select(F.col("id").alias("doc_id"), *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = simhash_components(documents(spark, sf_dir))
    return c.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    r = repair_conversations(damage(turns))
    every = turns.select("conv_id").distinct().join(r, F.col("conv_id").eqNullSafe(F.col("conv")), "left")
    counts = [F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = keep(numbered_turns(spark.read.parquet(f"{sf_dir}/conversations.parquet")), "numbered-turns")
    t = prefix_trie(keep(rebuilt(turns), "rebuilt"))
    return t.select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"))


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_personal(documents(spark, sf_dir))

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = F.filter("spans", lambda s: s["kind"].isin(*PERSONAL))
    counts = [F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in PERSONAL]
    return found.select(F.col("id").alias("doc_id"), *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1_sharding,
    "op2_licenses": op2_licenses,
    "op3_quality": op3_quality,
    "op4_imatch": op4_imatch,
    "op5_mixing": op5_mixing,
    "op6_chat": op6_chat,
    "op7_packing": op7_packing,
    "op8_line_dedup": op8_line_dedup,
    "op9_secrets": op9_secrets,
    "op10_simhash": op10_simhash,
    "op11_repair": op11_repair,
    "op12_trie": op12_trie,
    "op13_pii": op13_pii,
}
