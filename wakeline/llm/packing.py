"""Conflict-constrained best-fit packing of documents into fixed-size bins.

A document longer than a bin is cut into full pieces, each a bin of its own, and a tail; tails and shorter
documents are packed. Two documents conflict if they have the same source or the same duplicate cluster: a bin
carries a bitmap of each. Items are taken longest first. The bins are ordered by residual space; the search starts
at the smallest residual that holds the item and goes on to its successors until it finds a bin
without a conflict, so the tightest compatible bin is taken, else a new one is opened.

The table is dealt into blocks of bounded size that are packed independently, so no task holds more than
about ``block_rows`` small rows whatever the keys are. Bitmaps number the sources and clusters of a block. A residual
whose bins all hold a source is remembered in a bit vector per source, so that bins of a hot source
are passed over at once instead of one by one.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.session import ship_package

BLOCK_ROWS = 20_000


class Bins:
    """Open bins in residual order, with successor search."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.n = 0
        self.at: list[dict[int, None]] = [{} for _ in range(capacity + 1)]  # bins by residual, oldest first
        self.used = 0  # bit r: some bin has residual r
        self.sources: list[int] = []
        self.clusters: list[int] = []
        self.full: dict[int, int] = {}  # source -> bit r: every bin of residual r holds the source

    def _put(self, b: int, residual: int) -> None:
        self.at[residual][b] = None
        bit = 1 << residual
        self.used |= bit
        for s, mask in self.full.items():
            if mask & bit and not self.sources[b] >> s & 1:
                self.full[s] = mask & ~bit

    def _take(self, b: int, residual: int) -> None:
        bins = self.at[residual]
        del bins[b]
        if not bins:
            self.used &= ~(1 << residual)

    def best(self, length: int, source: int, cluster: int) -> tuple[int, int] | None:
        """(bin, residual) of the tightest compatible bin; -1 stands for no source or no cluster."""
        open_ = self.used >> length
        if source >= 0:
            open_ &= ~(self.full.get(source, 0) >> length)
        while open_:
            low = open_ & -open_
            residual = length + low.bit_length() - 1
            blocked = True
            for b in self.at[residual]:
                if source >= 0 and self.sources[b] >> source & 1:
                    continue
                blocked = False
                if cluster < 0 or not self.clusters[b] >> cluster & 1:
                    return b, residual
            if blocked:
                self.full[source] = self.full.get(source, 0) | 1 << residual
            open_ ^= low
        return None

    def add(self, length: int, source: int, cluster: int) -> tuple[int, int]:
        """Place an item; returns its bin and its offset in the bin."""
        found = self.best(length, source, cluster)
        if found is None:
            b, residual = self.n, self.capacity
            self.n += 1
            self.sources.append(0)
            self.clusters.append(0)
        else:
            b, residual = found
            self._take(b, residual)
        if source >= 0:
            self.sources[b] |= 1 << source
        if cluster >= 0:
            self.clusters[b] |= 1 << cluster
        if residual - length:
            self._put(b, residual - length)
        return b, self.capacity - residual


def pack_block(rows, lengths, sources, clusters, capacity: int):
    """Pack one block; yields (row, piece, start, length, bin, offset), bins numbered from 0.

    Items go longest first, ties by row. Sources and clusters are any values; None never conflicts. Empty
    documents (length 0) take an empty piece of bin 0's kind: they get a null bin.
    """
    out = []
    single = {c for c, n in pd.Series(list(clusters), dtype=object).dropna().value_counts().items() if n > 1}
    source_no: dict = {}
    cluster_no: dict = {}
    bins = Bins(capacity)
    tails = []
    whole = []
    for row, length, source, cluster in zip(rows, lengths, sources, clusters):
        full, tail = divmod(length, capacity)
        for p in range(full):
            whole.append((row, p, p * capacity, capacity))
        if tail or not length:
            s = -1 if source is None else source_no.setdefault(source, len(source_no))
            c = cluster_no.setdefault(cluster, len(cluster_no)) if cluster in single else -1
            tails.append((-tail, row, full, full * capacity, s, c))
    tails.sort()
    for negative, row, piece, start, s, c in tails:
        if negative:
            b, offset = bins.add(-negative, s, c)
            out.append((row, piece, start, -negative, b, offset))
        else:
            out.append((row, piece, start, 0, None, 0))
    out += [(row, p, start, n, bins.n + i, 0) for i, (row, p, start, n) in enumerate(whole)]
    return out


def packed(docs: DataFrame, length: Column, cluster: Column, source: str = "source", capacity: int = 8192,
           block_rows: int = BLOCK_ROWS, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per piece: the ``keep`` columns, piece, start, length, bin_id (unique over the table), block, offset.

    * ``length``: size of a document in the unit of ``capacity``; null counts as 0. A document of
      length 0 gets one row of length 0 with a null bin_id.
    * null source or cluster: conflicts with nothing. Repeated rows are documents of their own (and share a
      cluster, so they go to different bins). An empty table gives an empty result.
    * ``keep`` columns may have any names; other columns are not read.
    """
    spark = docs.sparkSession
    ship_package(spark)
    n_blocks = max(1, -(-docs.count() // block_rows))
    # Dealt by row number of the scan, so equal rows and hot keys spread like any others.
    rows = docs.select(F.struct(*[F.col(c) for c in keep]).alias("_keep"), length.cast("long").alias("_length"),
                       F.col(source).cast("string").alias("_source"), cluster.cast("string").alias("_cluster"),
                       F.monotonically_increasing_id().alias("_row"))
    rows = rows.withColumn("_block", F.pmod(F.xxhash64("_row"), F.lit(n_blocks)).cast("long"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        order = np.argsort(pdf["_row"].to_numpy())
        pdf = pdf.iloc[order].reset_index(drop=True)
        texts = [[None if v is None or v != v else v for v in pdf[c]] for c in ("_source", "_cluster")]
        lengths = [0 if v != v else int(v) for v in pdf["_length"]]
        got = pack_block(range(len(pdf)), lengths, texts[0], texts[1], capacity)
        i = np.array([g[0] for g in got], dtype=np.int64)
        return pd.DataFrame({
            "_row": pdf["_row"].to_numpy()[i], "piece": [g[1] for g in got], "start": [g[2] for g in got],
            "length": [g[3] for g in got], "bin": pd.array([g[4] for g in got], dtype="Int64"),
            "offset": [g[5] for g in got], "block": pdf["_block"].to_numpy()[i],
            "_keep": [pdf["_keep"].iat[k] for k in i]})

    keep_type = rows.schema["_keep"].dataType.simpleString()
    schema = f"_row long, piece int, start long, length long, bin long, offset long, block long, _keep {keep_type}"
    out = rows.repartition(n_blocks, "_block").groupBy("_block").applyInPandas(run, schema)
    return out.select("_keep.*", "piece", "start", "length", "offset", "block",
                      F.when(F.col("bin").isNotNull(), (F.col("block") * F.lit(1 << 40) + F.col("bin"))).alias("bin_id"))


def text_cluster(text: str = "text") -> Column:
    """A duplicate cluster key for tables without one: hash of the case-folded text with blanks squeezed."""
    return F.xxhash64(F.regexp_replace(F.trim(F.lower(F.col(text))), r"\s+", " "))
