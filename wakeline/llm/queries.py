"""Registered queries of the operators, with production parameters over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.llm import (
    ann,
    chat,
    langid,
    merkle,
    neardup,
    packing,
    quality,
    runs,
    secrets_scan,
    spencode,
    suffixtree,
    tokencount,
    tokenfile,
)
from wakeline.llm.oracle import ORACLE  # noqa: F401
from wakeline.llm.tokenizers_io import public_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packs the documents' bytes into bins of 8192; copies and documents of one source never share a bin."""
    docs = _table(spark, sf_dir, "documents")
    return packing.packed(docs, F.octet_length("text"), packing.text_cluster(), capacity=8192)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit_open(docs)
    rows = langid.identified(docs.select("doc_id", "text"), model)
    return rows.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the documents' ids as token files and reads them back."""
    folder = tokenfile.new_folder(spark)
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    tokenfile.write_tokens(docs, folder, public_path("byte_bpe_50k.json"), end_id=0)
    return tokenfile.read_tokens(spark, folder)


def op4_nearest_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.neighbours(vectors, vectors.filter("vec_id % 100 = 0"), k=10)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokencount.token_counts(docs, public_path("piece_bpe_32k.model"), limit=4096)


# Schema of the tool that conversation_calls derives: (name, param, type, required).
REPLY_SCHEMA = [("reply", "turn", "integer", True), ("reply", "n_chars", "integer", True), ("reply", "after", "object", False)]


def conversation_calls(conversations: DataFrame) -> DataFrame:
    """Messages with tool calls, derived from the conversations: each assistant turn becomes a call of the tool
    ``reply`` (identified by conversation and turn, needing the reply two turns before it) and a tool result with the turn's
    text. So a conversation is one chain of calls. A reply whose length is divisible by 7 has a text for a number, one divisible
    by 10 gets no result, one divisible by 11 has arguments that are no JSON. Other turns stay as they are."""
    name = lambda turn: F.format_string("c%d-%d", F.col("conv_id"), turn)
    t, n = F.col("turn"), F.char_length("text")
    before = F.when(t >= 3, F.struct(name(t - 2).alias("$ref"))).alias("after")
    good = F.to_json(F.struct(t.alias("turn"), n.alias("n_chars"), before))
    typed = F.to_json(F.struct(t.alias("turn"), n.cast("string").alias("n_chars"), before))
    text = F.when(n % 11 == 0, F.rtrim(good, F.lit("}"))).when(n % 7 == 0, typed).otherwise(good)
    call = F.struct(name(t).alias("id"), F.lit("reply").alias("name"), text.alias("arguments"))
    replies = conversations.filter("role = 'assistant'")
    calls = replies.select("conv_id", "turn", "role", F.to_json(F.struct(F.array(call).alias("tool_calls"))).alias("text"))
    results = replies.filter(F.coalesce(n % 10 != 0, F.lit(True))).select("conv_id", "turn", F.lit("tool").alias("role"), F.to_json(F.struct(
        name(t).alias("tool_call_id"), F.col("text").alias("content"))).alias("text"))
    others = conversations.filter("role is null or role != 'assistant'").select("conv_id", "turn", "role", "text")
    return others.unionByName(calls).unionByName(results)


def op6_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, orders, validates and serialises the calls of all conversations."""
    schemas = spark.createDataFrame(REPLY_SCHEMA, "name string, param string, type string, required boolean")
    return chat.formatted(conversation_calls(_table(spark, sf_dir, "conversations")), schemas)


def op7_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return spencode.encoded(docs, public_path("piece_bpe_32k.model"), with_ids=False, with_text=False).drop("text")


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    rows = quality.judged(docs)
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       "base_failed", "kept")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets_scan.scanned(docs).drop("text")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A proof of every document against the root of all; claims of folded texts fail."""
    docs = _table(spark, sf_dir, "documents")
    manifest = merkle.build(merkle.document_rows(docs))
    top = merkle.root(spark, manifest).first()
    found = merkle.proofs(spark, manifest)
    root = F.lit(top[0] if top else None).cast("string")
    return found.select(F.col("__order").cast("long").alias("doc_id"), "leaf", "subroot", root.alias("root"),
                        "proof_sha256", "folded_root", (F.col("folded_root") == root).alias("verified"))


def op12_suffix_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores all texts with a tree learnt from those not held out."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = suffixtree.fit(docs.filter(~suffixtree.held_out()))
    rows = suffixtree.scored(docs, model)
    return rows.select("doc_id", suffixtree.held_out().alias("held_out"), "n_tokens", "n_known",
                       F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every text, with periods planted into every tenth document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return runs.periodic_runs(docs, plant=True).drop("text")


QUERIES = {f.__name__: f for f in (
    op1_best_fit_packing, op2_language_id, op3_token_files, op4_nearest_codes, op5_token_counts, op6_tool_calls,
    op7_piece_encoding, op8_near_duplicates, op9_quality_rules, op10_secret_scan,
    op11_merkle_manifest, op12_suffix_tree_scores, op13_periodic_runs)}
