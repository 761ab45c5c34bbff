"""Merkle manifest of a dataset as a postorder append log.

Every row is a leaf; the leaves of a tree, in order, are grouped by eight into nodes, level by level. Aligned builders
take blocks of ``8 ** block_levels`` consecutive nodes, each block in a task of its own, and write its nodes in
completion order. Where a node stands in the log of its tree follows from subtree sizes alone (``position``), so a
builder needs nothing from any other, and a proof reads its siblings from computed places. Higher levels are built the
same way over the roots of the blocks, so a tree of n leaves takes ``log(n) / log(8 ** block_levels)`` rounds.
The roots of the trees, ordered by name, are the leaves of one further tree.

Digests are lowercase hex sha256, and a node hashes the hex text of its children.

Nulls are leaves like any other (``-``), a null tree name comes first, an empty table gives an empty manifest, equal rows
are equal leaves, and rows of one order key are ordered by their digest. Other columns, whatever their names, are no
part of a leaf.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wakeline.session import checkpoint_dir, ship_package

FAN_BITS = 3
FAN = 1 << FAN_BITS
BLOCK_LEVELS = 4
TOP = "top"

LOG_SCHEMA = "t string, n long, pos long, level int, idx long, digest string"
STEP_SCHEMA = "t string, block long, step int, slot int, own int, tree string, pos long"
PROOF_SCHEMA = "__order string, leaf string, t string, subroot string, proof_sha256 string, folded_root string"


@dataclass(frozen=True)
class Manifest:
    """Folders of the leaves in order, of the log of the trees and of the log of the tree over their roots."""

    leaves: str
    log: str
    top_leaves: str
    top_log: str
    block_levels: int


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def counts(n: int) -> list[int]:
    """Number of nodes on each level of a tree of n leaves, from the leaves up to the one root."""
    out = [n]
    while out[-1] > 1:
        out.append(-(-out[-1] // FAN))
    return out


def position(level: int, idx, n: int):
    """Place in the postorder log of node ``idx`` of ``level``: the number of nodes completed before it.

    When it completes, all nodes below it and to their left are written, as are those above that end left of it.
    """
    done = 0
    for j, have in enumerate(counts(n)):
        if j <= level:
            done = done + np.minimum((idx + 1) << FAN_BITS * (level - j), have)
        else:
            done = done + (idx >> FAN_BITS * (j - level))
    return done - 1


def leaf_digest(columns: list[str], values: dict[str, Column] | None = None) -> Column:
    """Digest of a row: of each column ``-`` if null, else its length in bytes, a colon and its text."""
    values = values or {}
    parts = []
    for c in columns:
        text = values.get(c, F.col(c)).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def ordered(rows: DataFrame, folder: str) -> DataFrame:
    """Rows (t, __order.., leaf, ..) numbered within their tree in the order of (__order, leaf); written to the folder.

    They are range-partitioned by tree and order together, so one large tree spreads over all tasks; the numbers of
    the partitions are added up, never the rows.
    """
    spark = rows.sparkSession
    keys = [F.col("t"), F.col("__order").asc_nulls_first(), F.col("leaf"), F.col("__row")]
    (rows.withColumn("__row", F.monotonically_increasing_id())
     .repartitionByRange(*keys).sortWithinPartitions(*keys)
     .select("*", F.spark_partition_id().alias("__part"), F.monotonically_increasing_id().alias("__at"))
     .drop("__row").write.parquet(folder))
    stored = spark.read.parquet(folder)
    parts = stored.groupBy("t", "__part").agg(F.count("*").alias("__n"), F.min("__at").alias("__first"))
    before = Window.partitionBy("t").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("t", "__part", "__first", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"),
                         F.sum("__n").over(Window.partitionBy("t")).alias("n"))
    rank = F.col("__at") - F.col("__first") + F.col("__before")
    return stored.join(parts, ["t", "__part"]).withColumn("rank", rank).drop("__part", "__at", "__first", "__before")


def _build_block(base: int, block_levels: int):
    """The nodes above one block of consecutive nodes of level ``base``, in completion order."""

    def build(table: pa.Table) -> pa.Table:
        at = table.column("idx").to_numpy()
        order = np.argsort(at)
        t, n = table.column("t")[0].as_py(), table.column("n")[0].as_py()
        sizes = counts(n)
        start = int(at[order[0]])
        leaves = table.column("digest").take(pa.array(order)).to_pylist()
        levels = [(base, start, leaves)] if base == 0 else []
        row, height = leaves, min(base + block_levels, len(sizes) - 1)
        for level in range(base + 1, height + 1):
            row = [digest("".join(row[k:k + FAN])) for k in range(0, len(row), FAN)]
            levels.append((level, start >> FAN_BITS * (level - base), row))
        if not levels:
            return pa.table([[]] * 6, schema=_LOG_ARROW)
        pos = np.concatenate([position(lv, np.arange(i, i + len(r)), n) for lv, i, r in levels])
        write = np.argsort(pos)
        lv = np.concatenate([np.full(len(r), lv) for lv, _, r in levels]).astype(np.int32)
        idx = np.concatenate([np.arange(i, i + len(r)) for _, i, r in levels])
        digests = pa.array([d for _, _, r in levels for d in r], pa.string())
        m = len(write)
        return pa.table([pa.array([t] * m, pa.string()), pa.array(np.full(m, n)), pa.array(pos[write]),
                         pa.array(lv[write]), pa.array(idx[write]), digests.take(pa.array(write))], schema=_LOG_ARROW)

    return build


_LOG_ARROW = pa.schema([("t", pa.string()), ("n", pa.int64()), ("pos", pa.int64()), ("level", pa.int32()),
                        ("idx", pa.int64()), ("digest", pa.string())])


def write_log(ranked: DataFrame, folder: str, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """Builds all trees over the ranked leaves, a round for each block_levels levels, and returns the log."""
    spark = ranked.sparkSession
    most = ranked.agg(F.max("n")).first()[0] or 0
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in _ddl(LOG_SCHEMA)]
    spark.range(0).select(*empty).write.parquet(f"{folder}/round=0")
    nodes, base = ranked.select("t", "n", F.col("rank").alias("idx"), F.col("leaf").alias("digest")), 0
    while most > 1 or (base == 0 and most > 0):
        out = f"{folder}/round={base + block_levels}"
        (nodes.groupBy("t", F.floor(F.col("idx") / FAN ** block_levels).alias("block"))
         .applyInArrow(_build_block(base, block_levels), LOG_SCHEMA).write.parquet(out))
        base += block_levels
        most = -(-most // FAN ** block_levels)
        nodes = spark.read.schema(LOG_SCHEMA).parquet(out).filter(F.col("level") == base).select(
            "t", "n", "idx", "digest")
    return read_log(spark, folder)


def read_log(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA + ", round int").parquet(folder).drop("round")


def roots(log: DataFrame) -> DataFrame:
    """The root of each tree: the last node of its log."""
    last = log.groupBy("t").agg(F.max_by("digest", "pos").alias("subroot"))
    return last


def tree_key(name: Column) -> Column:
    """Text that keeps the names' bytewise order, nulls first, and is never null."""
    return F.coalesce(F.concat(F.lit("v"), name.cast("string")), F.lit("n"))


def build(rows: DataFrame, folder: str | None = None, block_levels: int = BLOCK_LEVELS) -> Manifest:
    """Writes the manifest of the rows: ``t`` (tree_key), ``__order`` (order in the tree), ``leaf`` and any others."""
    spark = rows.sparkSession
    ship_package(spark)
    folder = folder or f"{checkpoint_dir(spark).rstrip('/')}/manifest-{uuid.uuid4().hex}"
    out = Manifest(*[f"{folder}/{name}" for name in ("leaves", "log", "top_leaves", "top_log")], block_levels)
    rows.write.parquet(f"{folder}/rows")
    ranked = ordered(spark.read.parquet(f"{folder}/rows"), f"{folder}/sorted")
    ranked.write.parquet(out.leaves)
    log = write_log(spark.read.parquet(out.leaves), out.log, block_levels)
    tops = roots(log).select(F.lit(TOP).alias("t"), F.col("t").alias("__order"), F.col("subroot").alias("leaf"))
    ordered(tops, f"{folder}/top_sorted").write.parquet(out.top_leaves)
    write_log(spark.read.parquet(out.top_leaves), out.top_log, block_levels)
    return out


def _steps(first: int, top: bool):
    """Where the siblings of a node stand on its way to the root: one row for each member of each run on the way.

    Input rows (t, block, idx, n): a node ``idx`` of level ``first`` in a tree of n leaves. ``own`` marks the run's
    member that is on the way.
    """

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for row in batch.to_pylist():
                sizes = counts(row["n"])
                idx = row["idx"]
                for level in range(first, len(sizes) - 1):
                    run = idx >> FAN_BITS << FAN_BITS
                    for member in range(run, min(run + FAN, sizes[level])):
                        place = int(position(level, member, row["n"]))
                        for col, v in zip(out, (row["t"], row["block"], level + (64 if top else 0), member - run,
                                                int(member == idx), TOP if top else row["t"], place)):
                            col.append(v)
                    idx >>= FAN_BITS
            yield pa.record_batch([pa.array(c, ty) for c, ty in zip(out, _STEP_TYPES)],
                                  names=["t", "block", "step", "slot", "own", "tree", "pos"])

    return steps


_STEP_TYPES = [pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.int64()]


def _ways(steps: DataFrame, log: DataFrame) -> DataFrame:
    """(t, block, way): the runs on the way to the root as pairs of the digests left and right of the node on it."""
    there = log.select(F.col("t").alias("tree"), "pos", "digest")
    runs = steps.join(there, ["tree", "pos"]).groupBy("t", "block", "step").agg(
        F.array_sort(F.collect_list(F.struct("slot", "own", "digest"))).alias("run"))
    own = F.expr("array_max(transform(run, x -> if(x.own = 1, x.slot, -1)))")
    side = lambda test: F.array_join(F.transform(
        F.filter("run", lambda x: test(x["slot"], own)), lambda x: x["digest"]), "")
    return runs.select("t", "block", F.struct("step", side(lambda s, o: s < o).alias("left"),
                                              side(lambda s, o: s > o).alias("right")).alias("run")).groupBy(
        "t", "block").agg(F.array_sort(F.collect_list("run")).alias("way"))


def _extract(block_levels: int):
    """Proofs of one block's leaves: siblings inside the block from their places in its part of the log, those above
    from the block's way. The root is computed anew from the claimed leaf."""

    def extract(left: pa.Table, right: pa.Table) -> pa.Table:
        m = left.num_rows
        if m == 0:
            return pa.table([[]] * 6, schema=_PROOF_ARROW)
        way, subroot, places, digests = [], None, [], []
        for pos, d, w, s in zip(*(right.column(c).to_pylist() for c in ("pos", "digest", "way", "subroot"))):
            if d is None:
                way, subroot = w or [], s
            else:
                places.append(pos)
                digests.append(d)
        log = dict(zip(places, digests))
        n = left.column("n")[0].as_py()
        sizes = counts(n)
        ranks = left.column("rank").to_numpy()
        start = int(ranks.min()) // FAN ** block_levels * FAN ** block_levels
        stop = min(start + FAN ** block_levels, n)
        sides = []
        for level in range(min(block_levels, len(sizes) - 1)):
            a, b = start >> FAN_BITS * level, -(-stop // FAN ** level)
            row = [log[int(p)] for p in position(level, np.arange(a, b), n)]
            sides.append((a, [("".join(row[k // FAN * FAN:k]), "".join(row[k + 1:k // FAN * FAN + FAN]))
                              for k in range(len(row))]))
        above = [(w["left"], w["right"]) for w in way]
        above_text = "".join(a + b for a, b in above)
        proofs, folded = [], []
        for r, claim in zip(ranks.tolist(), left.column("claim").to_pylist()):
            text, cur = [], claim
            for level, (a, pairs) in enumerate(sides):
                before, after = pairs[(r >> FAN_BITS * level) - a]
                text.append(before + after)
                cur = digest(before + cur + after)
            for before, after in above:
                cur = digest(before + cur + after)
            proofs.append(digest("".join(text) + above_text))
            folded.append(cur)
        return pa.table([left.column("__order").cast(pa.string()), left.column("leaf"), left.column("t"),
                         pa.array([subroot] * m, pa.string()), pa.array(proofs, pa.string()),
                         pa.array(folded, pa.string())], schema=_PROOF_ARROW)

    return extract


_PROOF_ARROW = pa.schema([("__order", pa.string()), ("leaf", pa.string()), ("t", pa.string()), ("subroot", pa.string()),
                          ("proof_sha256", pa.string()), ("folded_root", pa.string())])


def ways(spark: SparkSession, manifest: Manifest) -> DataFrame:
    """(t, block, subroot, way): what the leaves of a block have in common above it, up to the root of roots."""
    leaves = spark.read.parquet(manifest.leaves)
    log, top = read_log(spark, manifest.log), read_log(spark, manifest.top_log)
    blocks = leaves.groupBy("t", "n", F.floor(F.col("rank") / FAN ** manifest.block_levels).alias("block")).agg(F.count("*").alias("__n"))
    start = "t string, block long, idx long, n long"
    inside = _ways(blocks.select("t", "block", F.col("block").alias("idx"), "n").to(_ddl(start)).mapInArrow(
        _steps(manifest.block_levels, False), STEP_SCHEMA), log)
    tops = spark.read.parquet(manifest.top_leaves).select(
        F.col("__order").alias("t"), F.lit(0).cast("long").alias("block"), F.col("rank").alias("idx"), "n")
    outside = _ways(tops.to(_ddl(start)).mapInArrow(_steps(0, True), STEP_SCHEMA), top).select(
        "t", F.col("way").alias("outer"))
    none = F.array().cast("array<struct<step:int,left:string,right:string>>")
    return (blocks.select("t", "block").join(inside, ["t", "block"], "left").join(outside, "t", "left")
            .join(roots(log), "t")
            .select("t", "block", "subroot", F.concat(F.coalesce("way", none), F.coalesce("outer", none)).alias("way")))


def _ddl(text: str):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(text)


def proofs(spark: SparkSession, manifest: Manifest) -> DataFrame:
    """A proof for every leaf: its tree ``t``, order key (as text), digest, the tree's root, the digest of its siblings
    on the way to the root of roots, and the root that its ``claim`` gives with those siblings."""
    ship_package(spark)
    block = F.floor(F.col("rank") / FAN ** manifest.block_levels).alias("block")
    leaves = spark.read.parquet(manifest.leaves).select("t", block, "rank", "n", "leaf", "claim", F.col("__order").cast(
        "string").alias("__order"))
    below = read_log(spark, manifest.log).filter(F.col("level") < manifest.block_levels)
    block = F.floor(F.col("idx") / F.pow(F.lit(FAN), manifest.block_levels - F.col("level")))
    way = ways(spark, manifest)
    log = below.select("t", block.alias("block"), "pos", "digest", F.lit(None).cast("string").alias("subroot"),
                       F.lit(None).cast(way.schema["way"].dataType).alias("way")).unionByName(
        way.select("t", "block", F.lit(-1).cast("long").alias("pos"), F.lit(None).cast("string").alias("digest"),
                   "subroot", "way"))
    return leaves.groupBy("t", "block").cogroup(log.groupBy("t", "block")).applyInArrow(
        _extract(manifest.block_levels), PROOF_SCHEMA)


def root(spark: SparkSession, manifest: Manifest) -> DataFrame:
    """The root of roots, as one row (none for an empty manifest)."""
    return roots(read_log(spark, manifest.top_log)).select(F.col("subroot").alias("root"))


# Fixed values of the documents' manifest.
DOCUMENT_COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def document_rows(docs: DataFrame) -> DataFrame:
    """Leaves of ``documents`` by language; the claim of every third doc_id (by its crc32) has its text folded."""
    folded = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    leaf = leaf_digest(DOCUMENT_COLUMNS)
    changed = leaf_digest(DOCUMENT_COLUMNS, {"text": F.translate("text", UPPER, UPPER.lower())})
    return docs.select(tree_key(F.col("lang")).alias("t"), F.col("doc_id").alias("__order"), leaf.alias("leaf"),
                       F.when(folded, changed).otherwise(leaf).alias("claim"))
