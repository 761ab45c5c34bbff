"""Near-duplicate documents by HyperMinHash registers, banding and verification on full shingle sets.

* A document's set holds its distinct case-folded five-word shingles, as 64-bit hashes.
* HyperMinHash: the top bits of a hash choose one of ``REGISTERS`` buckets; a register keeps the smallest
  remaining hash of its bucket as 6 bits of leading zeros and 10 mantissa bits. Empty buckets borrow from
  another one along a fixed random order, so short texts have full signatures too.
* ``BANDS`` keys of ``BAND_ROWS`` registers each put documents in buckets. A pair of similarity 0.75 shares at
  least one key with a chance of about 0.99999; sets of up to ``PREFIX_SET`` shingles, whose registers say
  less, also get exact prefix keys, which no linked pair of such sets can miss.
* Candidate pairs are dropped if the collision-corrected estimate lies 4.5 standard errors below the
  threshold; the rest is verified on the full sets.

Groups of copies never become all pairs. Equal sets are one node. In each bucket every node is first paired
with two centres only, the smallest id and the node that shares the most buckets with others; nodes that turn out linked through a common node need no pair of their own.
Only pairs from different groups of a bucket are then paired up, if their sizes, and the number of
shingles that either shares with any node in question, allow a link at all; with a common centre, the shingles that both
share with it are counted exactly, from bits. Components
come from alternating large-star and small-star rounds over the verified links; nothing but
convergence counts reaches the driver, and lineage is cut in the checkpoint folder: by Parquet files of the
call (``Scratch``), dropped at its end, and by a checkpoint for what the result reads.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.llm.textkernel import mix, shingle_set
from wakeline.session import Scratch, materialize, ship_package

REGISTERS = 256
BUCKET_BITS = 8
MANTISSA_BITS = 10
BANDS, BAND_ROWS = 64, 6
PREFIX_SET = 48
PERCENT = 75
FILTER_BITS = 1 << 26

_rng = np.random.Generator(np.random.PCG64(8_128_256))
_BORROW = np.argsort(_rng.random((REGISTERS, REGISTERS)), axis=1).astype(np.int16)
_BAND = np.stack([_rng.permutation(REGISTERS)[:BAND_ROWS] for _ in range(BANDS)])
_BAND_MULT = _rng.integers(1, 2**62, (BANDS, BAND_ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BAND_ADD = _rng.integers(1, 2**62, BANDS, dtype=np.uint64)
_PREFIX_ADD = np.uint64(0x51ED270B35AE1D49)
# Chance that two different minima share a register, from the HyperMinHash collision analysis.
COLLISION = 0.169919 * 2.0**-MANTISSA_BITS


def registers(hashes: np.ndarray) -> np.ndarray:
    """The registers of a sorted non-empty set of 64-bit hashes, as unsigned 16-bit integers."""
    buckets = (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    first = np.flatnonzero(np.diff(buckets, prepend=-1))
    width = 64 - BUCKET_BITS
    rest = (hashes[first] & np.uint64((1 << width) - 1)) | np.uint64(1)
    # Length of each remainder in bits, exact for integers split in two halves.
    high = (rest >> np.uint64(32)).astype(np.float64)
    low = (rest & np.uint64(0xFFFFFFFF)).astype(np.float64)
    length = np.where(high > 0, np.frexp(high)[1] + 32, np.frexp(low)[1]).astype(np.int64)
    shift = length - 1 - MANTISSA_BITS
    ones = np.uint64((1 << MANTISSA_BITS) - 1)
    mantissa = np.where(shift >= 0, rest >> np.maximum(shift, 0).astype(np.uint64),
                        rest << np.maximum(-shift, 0).astype(np.uint64)) & ones
    out = np.zeros(REGISTERS, dtype=np.uint16)
    full = np.zeros(REGISTERS, dtype=bool)
    out[buckets[first]] = ((width - length) << MANTISSA_BITS).astype(np.uint16) | mantissa.astype(np.uint16)
    full[buckets[first]] = True
    if not full.all():
        empty = np.flatnonzero(~full)
        order = _BORROW[empty]
        out[empty] = out[order[np.arange(len(empty)), np.argmax(full[order], axis=1)]]
    return out


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Jaccard estimates of rows of registers, corrected for accidental equality."""
    same = (a == b).mean(axis=-1)
    return np.maximum(0.0, (same - COLLISION) / (1.0 - COLLISION))


def band_keys(regs: np.ndarray, prefix: np.ndarray) -> np.ndarray:
    """64-bit bucket keys: one per band, and one per prefix shingle of a small set."""
    bands = mix((regs.astype(np.uint64)[_BAND] * _BAND_MULT).sum(axis=1, dtype=np.uint64) + _BAND_ADD)
    return np.concatenate([bands, mix(prefix + _PREFIX_ADD)]) if len(prefix) else bands


def prefix_shingles(hashes: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The smallest hashes of a small set, enough that two linked sets share one of them."""
    n = len(hashes)
    return hashes[:n - -(-percent * n // 100) + 1] if n <= PREFIX_SET else hashes[:0]


def places(hub: np.ndarray, other: np.ndarray) -> np.ndarray:
    """For each member of a sorted set, whether the other sorted set has it."""
    if not len(other):
        return np.zeros(len(hub), dtype=bool)
    return other[np.minimum(np.searchsorted(other, hub), len(other) - 1)] == hub


def bit_words(flags: np.ndarray) -> np.ndarray:
    """Flags as 64-bit words."""
    packed = np.packbits(flags, bitorder="little")
    return np.pad(packed, (0, -len(packed) % 8)).view(np.int64)


def _signed(a: np.ndarray) -> pa.Array:
    return pa.array(a.view(np.int64), pa.int64())


def signatures(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, n_shingles, d1, d2, sig, small): set size, 128-bit digest of the set, registers, and the prefix
    shingles of small sets."""

    def run(batches):
        for batch in batches:
            ids, n, d1, d2, sig, small = batch.column(0), [], [], [], [], []
            for x in batch.column(1):
                hashes = shingle_set((x.as_py() or "").encode())
                n.append(len(hashes))
                d1.append(int(mix(hashes).sum(dtype=np.uint64)) if len(hashes) else 0)
                d2.append(int(np.bitwise_xor.reduce(hashes)) ^ len(hashes) if len(hashes) else 0)
                sig.append(registers(hashes).tobytes() if len(hashes) else None)
                small.append(prefix_shingles(hashes).tobytes())
            yield pa.RecordBatch.from_arrays(
                [ids.cast(pa.int64()), pa.array(n, pa.int64()), _signed(np.array(d1, dtype=np.uint64)),
                 _signed(np.array(d2, dtype=np.uint64)), pa.array(sig, pa.binary()), pa.array(small, pa.binary())],
                ["doc_id", "n_shingles", "d1", "d2", "sig", "small"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, "doc_id long, n_shingles long, d1 long, d2 long, sig binary, small binary")


def _buckets(nodes: DataFrame) -> DataFrame:
    """(key, rep, n) rows of every node."""

    def run(batches):
        for batch in batches:
            for s in range(0, batch.num_rows, 1024):
                part = batch.slice(s, 1024)
                keys, times = [], []
                for sig, small in zip(part.column(2), part.column(3)):
                    k = band_keys(np.frombuffer(sig.as_buffer(), np.uint16), np.frombuffer(small.as_buffer(), np.uint64))
                    keys.append(k)
                    times.append(len(k))
                rep = np.repeat(part.column(0).to_numpy(), times)
                n = np.repeat(part.column(1).to_numpy(), times)
                yield pa.RecordBatch.from_arrays([_signed(np.concatenate(keys)), pa.array(rep), pa.array(n)],
                                                 ["key", "rep", "n"])

    return nodes.select("rep", "n", "sig", "small").mapInArrow(run, "key long, rep long, n long")


def _likely(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sizes and estimated similarity allow a link."""
    limit = percent / 100.0

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(-1, REGISTERS) for i in (2, 3))
            n = np.maximum(batch.column(4).to_numpy(), 1)
            # A set smaller than the registers fills them unevenly, which adds to the error.
            error = np.sqrt(limit * (1 - limit) * (1.0 / REGISTERS + 0.75 / n))
            keep = estimate(a, b) >= limit - 4.5 * error
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep))

    side = nodes.select("rep", "n", "sig")
    joined = (pairs.join(side.toDF("a", "na", "sa"), "a").join(side.toDF("b", "nb", "sb"), "b")
              .filter(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)
              .select("a", "b", "sa", "sb", F.greatest("na", "nb").alias("n")))
    return joined.mapInArrow(run, "a long, b long")


def _in_question(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose ``rep`` is in ``ids``, and a few others, without moving the texts.

    The ids set bits of a bitmap of ``FILTER_BITS`` bits by their hash, in rows of 4 KB. The bitmap has 8 MB at most,
    so it can be sent to every task. More ids than bits only let more rows through.
    """
    place = F.pmod(F.xxhash64("rep"), F.lit(FILTER_BITS))
    bitmap = ids.select(place.alias("_p")).groupBy(F.bitmap_bucket_number("_p").alias("_b")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_p")).alias("_bits"))
    rows = docs.withColumn("_p", place).withColumn("_b", F.bitmap_bucket_number("_p"))
    bit = F.bitmap_bit_position("_p")
    byte = F.conv(F.hex(F.substring("_bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return (rows.join(F.broadcast(bitmap), "_b").filter(F.pmod(F.floor(byte / F.pow(F.lit(2), bit % 8)), F.lit(2)) == 1)
            .drop("_p", "_b", "_bits"))


def _verified(pairs: DataFrame, docs: DataFrame, doc_id: str, text: str, percent: int) -> DataFrame:
    """(a, b, both, linked, a_in_b, b_in_a) of the pairs: size of the intersection of the full sets, whether it reaches
    the threshold, and which places of b's sorted set a has, as bits (and the other way round). Sets are made again
    from the texts of the documents in question only, so they need not be kept for all."""

    def sets(batches):
        for batch in batches:
            out = [shingle_set((x.as_py() or "").encode()).tobytes() for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["rep", "set"])

    def run(batches):
        for batch in batches:
            sizes, linked, a_in_b, b_in_a = [], [], [], []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                in_x, in_y = places(x, y), places(y, x)
                both = int(in_x.sum())
                sizes.append(both)
                linked.append(bool(len(x)) and 100 * both >= percent * (len(x) + len(y) - both))
                a_in_b.append(bit_words(in_y))
                b_in_a.append(bit_words(in_x))
            words = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(linked, pa.bool_()),
                 pa.array(a_in_b, words), pa.array(b_in_a, words)], ["a", "b", "both", "linked", "a_in_b", "b_in_a"])

    wanted = pairs.select(F.explode(F.array("a", "b")).alias("rep"))
    texts = _in_question(docs.select(F.col(doc_id).cast("long").alias("rep"), F.col(text).alias("text")), wanted)
    made = texts.select("rep", "text").mapInArrow(sets, "rep long, set binary")
    joined = (pairs.join(made.toDF("a", "x"), "a").join(made.toDF("b", "y"), "b").select("a", "b", "x", "y"))
    return joined.mapInArrow(run, "a long, b long, both long, linked boolean, a_in_b array<long>, b_in_a array<long>"
                             ).distinct()


def _alone(ids: DataFrame, docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(rep, alone): shingles of each node that no other node in question has, so that no pair of them shares."""

    def shingles(batches):
        for batch in batches:
            for rep, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                hashes = shingle_set((body.as_py() or "").encode())
                yield pa.RecordBatch.from_arrays([_signed(hashes), pa.array(np.full(len(hashes), rep, dtype=np.int64))],
                                                 ["shingle", "rep"])

    texts = _in_question(docs.select(F.col(doc_id).cast("long").alias("rep"), F.col(text).alias("text")), ids)
    rows = texts.filter("rep is not null").select("rep", "text").mapInArrow(shingles, "shingle long, rep long")
    once = rows.groupBy("shingle").agg(F.count("*").alias("_n"), F.min("rep").alias("rep")).filter("_n = 1")
    return once.groupBy("rep").agg(F.count("*").alias("alone"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b): root is the smallest node it reaches.

    Alternating large-star and small-star rounds; a node's neighbours are only ever aggregated or joined,
    never collected, and the number of rounds grows with the logarithm of the size.
    """
    scratch = Scratch(edges.sparkSession, "stars")
    now = scratch.keep(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct())
    seen = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
        now = scratch.keep(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        state = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == seen:
            break
        seen = state
    now = materialize(now)
    scratch.drop()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()


def links(nodes: DataFrame, docs: DataFrame, doc_id: str, text: str, keep, percent: int = PERCENT) -> DataFrame:
    """Verified links (a, b) that connect all linked nodes (rep, n, sig, small); ``keep`` cuts lineage."""
    rows = _buckets(nodes)
    shared = rows.groupBy("key").agg(F.min("rep").alias("_low"), F.max("rep").alias("_high"), F.count("*").alias("held"))
    members = keep(rows.join(shared.filter("_low != _high").select("key", "held", F.col("_low").alias("c")), "key"))
    # The text that a group was copied from shares buckets with more of the group than any copy does.
    weight = members.groupBy("rep").agg((F.sum("held") * 1024 + F.pmod(F.xxhash64("rep"), F.lit(1024))).alias("_w"))
    middle = (members.select("key", "rep").join(weight, "rep").groupBy("key").agg(F.max_by("rep", "_w").alias("m")))
    star = (members.join(middle, "key").select("rep", F.explode(F.array("c", "m")).alias("c")).filter("rep != c")
            .select(F.least("rep", "c").alias("a"), F.greatest("rep", "c").alias("b")).distinct())
    measured = keep(_verified(keep(_likely(star, nodes, percent)), docs, doc_id, text, percent))
    first = measured.filter("linked").select("a", "b").distinct()
    # A doc_id whose rows hold several texts has several sets, for which no bound on one of them holds.
    several = keep(nodes.groupBy("rep").count().filter("count > 1").select("rep"))
    measured = (measured.join(several.toDF("a"), "a", "left_anti").join(several.toDF("b"), "b", "left_anti"))
    # Every node's hub: of the nodes it was measured against, the one that shares the most buckets.
    sides = F.array(F.struct(F.col("a").alias("rep"), F.col("b").alias("hub")), F.struct(F.col("b").alias("rep"), F.col("a").alias("hub")))
    against = measured.select(F.explode(sides).alias("s"), "both").select("s.rep", "s.hub", "both")
    heavy = against.join(weight.toDF("hub", "_w"), "hub")
    hubs = heavy.groupBy("rep").agg(F.max_by("hub", "_w").alias("hub"), F.max_by("both", "_w").alias("in_hub"))
    # The places of the hub's set that a node has.
    bits = measured.select(F.explode(F.array(
        F.struct(F.col("a").alias("rep"), F.col("b").alias("hub"), F.col("a_in_b").alias("has")),
        F.struct(F.col("b").alias("rep"), F.col("a").alias("hub"), F.col("b_in_a").alias("has")))).alias("s")).select("s.*")

    # Nodes with the same label are connected already: the smallest linked node, followed once more.
    near = (first.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e"))
            .groupBy(F.col("e.a").alias("rep")).agg(F.min("e.b").alias("_m"))
            .select("rep", F.least("rep", "_m").alias("label")))
    label = (near.join(near.toDF("label", "next"), "label", "left")
             .select("rep", F.coalesce("next", "label").alias("label")))
    marked = (members.select("key", "rep", "n").join(label, "rep", "left")
              .select("key", "rep", "n", F.coalesce("label", "rep").alias("label")))
    mixed = marked.groupBy("key").agg(F.min("label").alias("_low"), F.max("label").alias("_high")).filter("_low != _high")
    open_rows = keep(marked.join(mixed.select("key"), "key"))
    in_question = open_rows.select("rep").distinct()
    hubs = keep(hubs.join(in_question, "rep", "left_semi").join(bits, ["rep", "hub"], "left"))
    alone = (_alone(in_question.unionByName(hubs.select(F.col("hub").alias("rep"))), docs, doc_id, text)
             .join(several, "rep", "left_anti"))
    shared_with = F.col("n") - F.coalesce("alone", F.lit(0))
    outside = F.greatest(shared_with - F.col("in_hub"), F.lit(0))
    sized = open_rows.join(alone, "rep", "left").join(hubs, "rep", "left").select(
        "key", "rep", "n", "label", shared_with.alias("c"), "hub", "in_hub", outside.alias("out"), "has")
    # A node whose shared shingles cannot reach the share with a set of its own size links with nothing here.
    sized = keep(sized.filter(F.col("c") * 100 >= F.col("n") * percent))
    left = sized.toDF("key", "a", "na", "la", "ca", "ha", "ia", "oa", "sa")
    right = sized.toDF("key", "b", "nb", "lb", "cb", "hb", "ib", "ob", "sb")
    # The intersection is at most the smaller count of shingles that are not a node's own alone; with a common hub,
    # at most the smaller part inside the hub plus the smaller such part outside.
    most = F.when(F.col("ha") == F.col("hb"), F.least("ia", "ib") + F.least("oa", "ob")).otherwise(F.least("ca", "cb"))
    # Where that still allows a link, the shingles that both have inside the common hub are counted.
    inside = F.aggregate(F.zip_with("sa", "sb", lambda x, y: F.bit_count(x.bitwiseAND(y))), F.lit(0), lambda x, y: x + y)
    exact = inside + F.least("oa", "ob")
    crossing = (left.join(right, "key").filter("a < b and la != lb")
                .filter(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)
                .filter(most * (100 + percent) >= (F.col("na") + F.col("nb")) * percent)
                .filter((F.col("ha") != F.col("hb")) | F.col("ha").isNull() | F.col("hb").isNull()
                        | (exact * (100 + percent) >= (F.col("na") + F.col("nb")) * percent))
                .select("a", "b").distinct().join(star, ["a", "b"], "left_anti"))
    second = keep(_verified(keep(_likely(crossing, nodes, percent)), docs, doc_id, text, percent))
    return first.unionByName(second.filter("linked").select("a", "b"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Documents are linked if ``100 * intersection >= percent * union`` of their sets; component_id is the
    smallest doc_id reachable over links.

    * null text, or text without words: empty set, linked with nothing, its own component;
    * null doc_id: linked with nothing, component_id null, kept;
    * rows that share a doc_id are one document (linked through its id); repeated rows all come back, with
      the same component; an empty table gives an empty result; other columns of ``docs`` are not read.
    """
    ship_package(docs.sparkSession)
    signed = materialize(signatures(docs, doc_id, text))
    full = signed.filter("n_shingles > 0 and doc_id is not null")
    classes = full.groupBy("d1", "d2", "n_shingles").agg(F.min("doc_id").alias("rep"))
    scratch = Scratch(docs.sparkSession, "links")
    nodes = scratch.keep(
        full.join(classes, ["d1", "d2", "n_shingles"]).filter("doc_id = rep")
        .select("rep", F.col("n_shingles").alias("n"), "sig", "small", "d1", "d2")
        .dropDuplicates(["d1", "d2", "n"]).drop("d1", "d2"))
    found = links(nodes, docs, doc_id, text, scratch.keep, percent)
    # Rows that share a doc_id are one document, so their classes are linked through it.
    ids = full.join(classes, ["d1", "d2", "n_shingles"]).filter("doc_id != rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    shared = ids.join(classes.select(F.col("rep").alias("a")).distinct(), "a", "left_semi").distinct()
    roots = components(found.unionByName(shared))
    scratch.drop()
    label = (classes.join(roots, classes["rep"] == roots["node"], "left")
             .select("d1", "d2", "n_shingles", F.coalesce("root", "rep").alias("_root")))
    out = signed.select("doc_id", "n_shingles", "d1", "d2").join(label, ["d1", "d2", "n_shingles"], "left")
    own = F.when(F.col("n_shingles") > 0, F.col("_root")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce(own, F.col("doc_id")))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
