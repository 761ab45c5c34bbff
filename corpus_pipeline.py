"""The corpus pipeline: quality rules, language identification, near duplicates, secrets, packing.

Each stage takes (spark, docs, sf_dir) and works on everything its predecessor kept. All but the last return
the columns of ``documents``. Between stages the rows are written as Parquet in the folder that
``spark.checkpoint.dir`` names and read again, so a lost executor never sets back more than one stage.

Columns whose names clash with a stage's own outputs pass through untouched, as the outputs carry a prefix.
Empty tables pass through all stages.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wakeline.llm import langid, neardup, packing, quality, secrets_scan
from wakeline.session import checkpoint_dir, materialize

OWN = "__stage_"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that pass the base rule and their group's adaptive fences; null texts go."""
    return quality.judged(docs, prefix=OWN).filter(F.col(OWN + "kept")).select(*docs.columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose language can be told and knows their words; letterless and null texts go."""
    model = langid.fit_fences(langid.fit_open(docs))
    rows = langid.identified(docs, model, prefix=OWN)
    sure = langid.confident(*(F.col(OWN + c) for c in ("score", "lang_pred", "explained")))
    return rows.filter(sure).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate component: its smallest doc_id, one row of it.

    Rows with a null doc_id are linked with nothing and stay.
    """
    found = neardup.near_duplicates(docs)
    # Written once: both branches below read them, and the driver need not plan the components with each.
    ids = materialize(found.filter("kept and doc_id is not null").groupBy("doc_id").agg(F.count("*").alias(OWN + "n"))
                      .withColumnRenamed("doc_id", OWN + "id"))
    match = docs["doc_id"].cast("long") == F.col(OWN + "id")
    rows = docs.join(ids, match)
    single = rows.filter(F.col(OWN + "n") == 1).select(*docs.columns)
    # Only ids that come several times need to be told apart.
    first = Window.partitionBy(OWN + "id").orderBy(F.xxhash64("text"))
    repeated = (rows.filter(F.col(OWN + "n") > 1).withColumn(OWN + "r", F.row_number().over(first))
                .filter(F.col(OWN + "r") == 1).select(*docs.columns))
    return single.unionByName(repeated).unionByName(docs.filter("doc_id is null"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret found in a text; n_chars follows the changed text."""
    clean = OWN + "text"
    rows = secrets_scan.scanned(docs, redact_to=clean, prefix=OWN)
    changed = {"text": F.col(clean)}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col(clean) != F.col("text"), F.char_length(clean)).otherwise(
            F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return rows.select(*[changed[c].alias(c) if c in changed else F.col(c) for c in docs.columns])


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents' bytes into bins of 8192."""
    return packing.packed(docs, F.octet_length("text"), packing.text_cluster(), capacity=8192)


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secret_scan),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result of the last one."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        out = f"{folder}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs


# Sketches, learned models, signatures and best-fit search have no counterpart in SQL.
ORACLE_SQL = None
