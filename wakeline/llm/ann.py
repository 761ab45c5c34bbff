"""Approximate nearest neighbours with randomly rotated one-bit codes.

Vectors are assigned to the nearest of K coarse centres. A vector's residual from its centre is rotated by one
fixed random rotation and stored as its sign bits (one bit a dimension), its length, and the inner product of
the unit residual with its own code. A query estimates inner products from the bits, corrected by that
scalar, and knows how far the estimate can be off: about ``EPSILON`` standard errors of a random rotation.
From these follow lower and upper bounds of every distance; only vectors whose lower bound does not
exceed the k-th smallest upper bound are reranked on the original vectors, in double precision.

The centres, and the number of cells to visit for the wanted recall, come from a bounded sample; every
vector is coded and indexed. Cells are cut into blocks of bounded rows, and the queries of a cell into
blocks too, so a hot cell or a vector repeated a million times is many small tasks. Equal vectors are one entry: a neighbour list of k+1 can name at most the k+1 smallest ids of each.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wakeline.session import materialize, ship_package

SAMPLE = 16_384
MAX_CELLS = 2_048
PROBE_RECALL = 0.98
CALIBRATION_QUERIES = 256
MIN_PROBES = 4
BLOCK_VECTORS = 8_192
BLOCK_QUERIES = 1_024
EPSILON = 3.0


def rotation(dim: int, seed: int = 20240517) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.Generator(np.random.PCG64(seed)).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def centres_of(sample: np.ndarray, cells: int, rounds: int = 8) -> np.ndarray:
    """Coarse centres by Lloyd's rounds over the sample; a cell that loses its vectors keeps its centre."""
    rng = np.random.Generator(np.random.PCG64(7))
    centres = sample[rng.permutation(len(sample))[:cells]].copy()
    for _ in range(rounds):
        near = nearest(sample, centres, 1)[:, 0]
        sums = np.zeros_like(centres)
        np.add.at(sums, near, sample)
        n = np.bincount(near, minlength=len(centres))
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def nearest(x: np.ndarray, centres: np.ndarray, k: int) -> np.ndarray:
    """The k nearest centres of each vector, nearest first."""
    d = (centres ** 2).sum(axis=1)[None, :] - 2.0 * (x @ centres.T)
    return np.argsort(d, axis=1, kind="stable")[:, :k]


def probes_needed(sample: np.ndarray, centres: np.ndarray, k: int, recall: float) -> int:
    """Cells to visit so that the share ``recall`` of the sample's own k nearest neighbours lie in them.

    Neighbours in a sample are farther away than in the whole table, so this errs on the safe side. Data with
    clusters need few cells; data without structure need most of them.
    """
    asked = sample[np.random.Generator(np.random.PCG64(11)).permutation(len(sample))[:CALIBRATION_QUERIES]]
    square = (sample ** 2).sum(axis=1)
    cell = nearest(sample, centres, 1)[:, 0]
    ranks = []
    for q, order in zip(asked, nearest(asked, centres, len(centres))):
        near = np.argsort(square - 2.0 * (sample @ q), kind="stable")[1:k + 1]
        place = np.empty(len(centres), dtype=np.int64)
        place[order] = np.arange(len(centres))
        ranks.append(place[cell[near]])
    ranks = np.sort(np.concatenate(ranks))
    return int(ranks[min(len(ranks) - 1, int(recall * len(ranks)))]) + 1 if len(ranks) else 1


def codes(x: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign bits, residual lengths, and inner product of each unit residual with its code."""
    residual = x - centre
    length = np.sqrt((residual ** 2).sum(axis=1))
    unit = (residual / np.where(length > 0, length, 1.0)[:, None]) @ turn
    inner = np.abs(unit).sum(axis=1) / math.sqrt(x.shape[1])
    return np.packbits(unit > 0, axis=1), length, inner


def bounds(packed: np.ndarray, length: np.ndarray, inner: np.ndarray, query: np.ndarray, centre: np.ndarray,
           turn: np.ndarray, epsilon: float) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the squared distances (vectors x queries), from the codes alone."""
    dim = query.shape[1]
    signs = np.unpackbits(packed, axis=1, count=dim).astype(np.float32) * 2.0 - 1.0
    residual = query - centre
    q_length = np.sqrt((residual ** 2).sum(axis=1))
    unit = ((residual / np.where(q_length > 0, q_length, 1.0)[:, None]) @ turn).astype(np.float32)
    safe = np.maximum(inner, 1e-6)
    found = (signs @ unit.T) / math.sqrt(dim) / safe[:, None]
    error = epsilon * np.sqrt(np.maximum(1.0 - safe ** 2, 0.0) / safe ** 2) / math.sqrt(max(dim - 1, 1)) + 1e-5
    square = length[:, None] ** 2 + q_length[None, :] ** 2
    scale = 2.0 * length[:, None] * q_length[None, :]
    return (square - scale * np.minimum(found + error[:, None], 1.0),
            square - scale * np.maximum(found - error[:, None], -1.0))


def _valid(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, v): vectors that take part, of the commonest dimension, each (vec_id, vector) once."""
    v = F.col("v")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = (vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
            .filter(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0))
            .filter(~bad).filter(F.exists(v, lambda x: x != 0)))
    common = rows.groupBy(F.size(v).alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    return rows.filter(F.size(v) == (common["dim"] if common else 0)).dropDuplicates(["vec_id", "v"])


def _matrix(column) -> np.ndarray:
    dim = len(column[0])
    flat = column.flatten() if isinstance(column, pa.ListArray) else np.concatenate(column)
    return np.asarray(flat, dtype=np.float64).reshape(-1, dim)


def neighbours(vectors: DataFrame, queries: DataFrame, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding",
               recall: float = PROBE_RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query among all other vectors.

    ``score`` is the Euclidean distance in double precision; ties go to the smaller vec_id.

    * null, zero and non-finite vectors, null ids, and vectors of another dimension than the commonest take no part;
    * a (vec_id, vector) repeated counts once; a query never meets rows of its own vec_id;
    * fewer than k candidates: all of them; an empty table gives an empty result. Other columns are not read.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    result = "query_id long, rank int, vec_id long, score double"
    every = materialize(_valid(vectors, vec_id, vector))
    own = _valid(queries, vec_id, vector) if queries is not vectors else every
    w = Window.partitionBy("v").orderBy("vec_id")
    copies = (every.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= k + 1)
              .withColumn("rep", F.first("vec_id").over(w)))
    copies = materialize(copies.select("rep", "vec_id", "v"))
    entries = copies.filter("rep = vec_id").select("rep", "v")
    n = entries.count()
    if not n:
        return spark.createDataFrame([], result)
    sample = _matrix([r["v"] for r in entries.orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE).select("v").collect()])
    cells = max(1, min(MAX_CELLS, round(math.sqrt(n)), len(sample) // 8))
    dim = sample.shape[1]
    index = spark.sparkContext.broadcast((centres_of(sample, cells), rotation(dim)))

    def assign(batches):
        centres, turn = index.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1))
            cell = nearest(x, centres, 1)[:, 0]
            bits, length, inner = codes(x, centres[cell], turn)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cell, pa.int32()), batch.column(1), pa.array([b.tobytes() for b in bits], pa.binary()),
                 pa.array(length), pa.array(inner)], ["rep", "cell", "v", "bits", "length", "inner"])

    coded = materialize(entries.mapInArrow(
        assign, "rep long, cell int, v array<double>, bits binary, length double, inner double"))
    # At most MAX_CELLS counts.
    size = {r["cell"]: r["n"] for r in coded.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    probes = max(MIN_PROBES, probes_needed(sample, index.value[0], k, recall))

    def probe(batches):
        centres, _ = index.value
        held = np.array([size.get(c, 0) for c in range(len(centres))])
        for batch in batches:
            if not batch.num_rows:
                continue
            order = nearest(_matrix(batch.column(1)), centres, len(centres))
            ids, cell, rows = [], [], []
            for i, o in enumerate(order):
                # Enough cells, and more of them while they hold too few vectors.
                enough = int(np.searchsorted(np.cumsum(held[o]), 4 * (k + 1))) + 1
                take = [int(c) for c in o[:max(probes, enough)] if held[c]]
                ids += [batch.column(0)[i].as_py()] * len(take)
                cell += take
                rows += [i] * len(take)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(cell, pa.int32()),
                                              batch.column(1).take(pa.array(rows, pa.int64()))], ["q", "cell", "v"])

    asked = own.groupBy("v").agg(F.min("vec_id").alias("q")).select("q", "v")
    probed = materialize(asked.mapInArrow(probe, "q long, cell int, v array<double>"))
    wanted = {r["cell"]: r["n"] for r in probed.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    shape = spark.createDataFrame(
        [(c, -(-size[c] // BLOCK_VECTORS), -(-wanted[c] // BLOCK_QUERIES)) for c in wanted], "cell int, nv int, nq int")
    deal = lambda df, key, mine, other: (
        df.join(F.broadcast(shape), "cell").withColumn("_mine", F.pmod(F.xxhash64(key), F.col(mine)).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col(other) - 1))))
    left = deal(coded, "rep", "nv", "nq").select("cell", F.col("_mine").alias("bv"), F.col("_other").alias("bq"),
                                                 "rep", "v", "bits", "length", "inner")
    right = deal(probed, "q", "nq", "nv").select("cell", F.col("_other").alias("bv"), F.col("_mine").alias("bq"), "q", "v")

    def search(lv: pd.DataFrame, rq: pd.DataFrame) -> pd.DataFrame:
        if not len(lv) or not len(rq):
            return pd.DataFrame({"q": np.empty(0, np.int64), "rep": np.empty(0, np.int64), "score": np.empty(0)})
        centres, turn = index.value
        lv = lv.sort_values("rep", ignore_index=True)
        centre = centres[int(lv["cell"].iat[0])]
        x, q = np.stack(lv["v"].to_list()), np.stack(rq["v"].to_list())
        packed = np.frombuffer(b"".join(lv["bits"]), np.uint8).reshape(len(lv), -1)
        low, high = bounds(packed, lv["length"].to_numpy(), lv["inner"].to_numpy(), q, centre, turn, EPSILON)
        keep = min(k + 1, len(lv))
        edge = np.partition(high, keep - 1, axis=0)[keep - 1]
        reps, names, got, scores = lv["rep"].to_numpy(), [], [], []
        for j, name in enumerate(rq["q"].to_numpy()):
            at = np.flatnonzero(low[:, j] <= edge[j])
            score = np.sqrt(((x[at] - q[j]) ** 2).sum(axis=1))
            best = np.lexsort((reps[at], score))[:k + 1]
            names.append(np.full(len(best), name))
            got.append(reps[at][best])
            scores.append(score[best])
        return pd.DataFrame({"q": np.concatenate(names), "rep": np.concatenate(got), "score": np.concatenate(scores)})

    block = ["cell", "bv", "bq"]
    found = left.groupBy(*block).cogroup(right.groupBy(*block)).applyInPandas(search, "q long, rep long, score double")
    by_rep = Window.partitionBy("q").orderBy("score", "rep")
    near = found.withColumn("_r", F.row_number().over(by_rep)).filter(F.col("_r") <= k + 1).drop("_r")
    by_id = Window.partitionBy("q").orderBy("score", "vec_id")
    named = (near.join(copies.select("rep", "vec_id"), "rep").withColumn("_r", F.row_number().over(by_id))
             .filter(F.col("_r") <= k + 1).select("q", "vec_id", "score"))
    ids = own.select(F.col("vec_id").alias("query_id"), "v").join(asked, "v").select("query_id", "q")
    final = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (ids.join(named, "q").filter("vec_id != query_id").withColumn("rank", F.row_number().over(final).cast("int"))
            .filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))
