"""Language-model scores from a probabilistic suffix tree over words.

A text is its words with A-Z folded, then an end symbol; before its first word stands a begin symbol, which only serves as
a context. A node of the tree is a context of one or two preceding symbols.

* Counting: the following symbols of every context are counted over all training texts; a task adds up its own texts first,
  so a frequent context costs one row a task and symbol. Contexts of two symbols are counted where they can be nodes, that is
  if they occur ``min_count`` times.
* Divergence test: with n occurrences of a context, of which n_w are followed by w, and P the parent's distribution, the
  context is kept if ``sum n_w ln(n_w / (n P(w)))``, over the symbols that follow at least ``min_next`` times and the rest as
  one symbol, reaches ``min_gain``. A kept context keeps its parent.
* Smoothing: these symbols get ``(n_w - discount) / n``, and all others share the rest in proportion to the parent's
  distribution. The root adds one half to each count, unseen words included. So every distribution sums to one.
* Scoring: a symbol's probability is that of the longest kept context before it. Written as a sum along the tree's
  path, a text's score is a sum of terms, each belonging to a word, a pair or a triple of neighbours
  (``model``), so texts are scored by looking terms up. The most frequent ``cached`` terms are sent to the tasks, and a filter of
  fixed size tells most pairs and triples without a term; what is left meets the terms in
  parts of the keys, which send back a sum per text. Both only save work: no result depends
  on them. Keys, terms and sums travel as arrays packed in bytes, a row per part and some hundred thousand keys, as
  the counts do: rows of a key each fill an executor's heap with buffers and sorts.

Nodes and terms grow with the corpus; what is sent to all tasks is bounded by parameters. Symbols and contexts are
known by 64-bit hashes.

Null and empty texts are an end symbol. A null id is never held out. Repeated rows count, and are scored, once each.
Without training texts every symbol is unknown.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.llm.batchwords import BatchWords, pieces
from wakeline.llm.textkernel import mix
from wakeline.session import checkpoint_dir, ship_package, small_batches

# Symbols that are no words.
BEGIN = np.uint64(0xB0A7D5E1C3F29688)
END = np.uint64(0x5E4D3C2B1A09F8E7)

_LEFT, _RIGHT, _TURN = np.uint64(0x9DDFEA08EB382D69), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)

# Memory of a counting task: symbols gathered before they are added up, and text per bucket of contexts.
GATHER = 400_000
COUNTED_BYTES = 1 << 20
BUCKET_BYTES = 4 << 20
FILTER_BITS = 27
FILTER_SLICES = 64
PROBES = 3
PROBED = 1 << 17
# Text scored at once: each word stands for three terms.
SCORED_BYTES = 1 << 19
# Keys looked up in one task, and texts whose sums are put together in one.
ASKED = 1 << 19
SUMMED = 1 << 14


@dataclass(frozen=True)
class TreeLimits:
    min_count: int = 50
    min_next: int = 5
    min_gain: float = 10.0
    discount: float = 0.75
    cached: int = 1 << 20
    hot_sample: int = 4000


@dataclass(frozen=True)
class Model:
    """Terms in a folder: key, known (1 for a word), base and score in log10, weight (occurrences)."""

    terms: str
    default: float
    tokens: int


def pair_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Key of two neighbours, of which the first may be a key itself."""
    return mix(a * _LEFT + (b ^ _TURN) * _RIGHT)


def symbols(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all texts, each with begin and end; their texts; number of words of each text."""
    words = BatchWords(texts, fold_case=True)
    docs = len(texts)
    out = np.empty(len(words.hashes) + 2 * docs, dtype=np.uint64)
    owner = np.repeat(np.arange(docs), words.counts + 2)
    ends = words.first[1:] + 2 * np.arange(1, docs + 1) - 1
    out[ends], out[ends - words.counts - 1] = END, BEGIN
    out[np.arange(len(words.hashes)) + 2 * np.repeat(np.arange(docs), words.counts) + 1] = words.hashes
    return out, owner, words.counts


def _probes(keys: np.ndarray) -> Iterator[np.ndarray]:
    """Bit numbers of keys in the filter; a key's bits lie in the slice that its highest bits name."""
    inner = FILTER_BITS - int(math.log2(FILTER_SLICES))
    base = (keys >> np.uint64(64 - int(math.log2(FILTER_SLICES)))) << np.uint64(inner)
    h = mix(keys ^ _TURN)
    for k in range(PROBES):
        yield base | ((h >> np.uint64(20 * k)) & np.uint64((1 << 20) - 1)) << np.uint64(inner - 20) | (
            (keys >> np.uint64(7 * k)) & np.uint64((1 << inner - 20) - 1))


def build_filter(keys: DataFrame) -> bytes:
    """Filter of FILTER_BITS bits over column ``key``: tasks build its slices, which are put together here."""
    inner = FILTER_BITS - int(math.log2(FILTER_SLICES))
    size = 1 << inner - 3

    def bits(table: pa.Table) -> pa.Table:
        found = table.column("key").to_numpy().view(np.uint64)
        out = np.zeros(1 << inner, dtype=bool)
        for at in _probes(found):
            out[(at & np.uint64((1 << inner) - 1)).astype(np.int64)] = True
        return pa.table({"slice": [table.column("slice")[0].as_py()], "bits": [np.packbits(out, bitorder="little").tobytes()]})

    def merge(table: pa.Table) -> pa.Table:
        every = np.bitwise_or.reduce([np.frombuffer(b.as_py(), dtype=np.uint8) for b in table.column("bits")])
        return pa.table({"slice": [table.column("slice")[0].as_py()], "bits": [every.tobytes()]})

    part = F.shiftrightunsigned("key", 64 - int(math.log2(FILTER_SLICES)))
    spread = F.pmod(F.col("key"), F.lit(8))
    slices = keys.select("key", part.alias("slice"), spread.alias("spread")).groupBy("slice", "spread").applyInArrow(
        bits, "slice long, bits binary").groupBy("slice").applyInArrow(merge, "slice long, bits binary")
    out = bytearray(size * FILTER_SLICES)
    for row in slices.collect():
        out[row.slice * size:(row.slice + 1) * size] = row.bits
    return bytes(out)


class Filter:
    def __init__(self, data: bytes):
        self.bits = np.frombuffer(data, dtype=np.uint8)

    def has(self, keys: np.ndarray) -> np.ndarray:
        some = [self._has(keys[a:a + PROBED]) for a in range(0, len(keys), PROBED)]
        return np.concatenate(some) if some else np.zeros(0, dtype=bool)

    def _has(self, keys: np.ndarray) -> np.ndarray:
        live = np.ones(len(keys), dtype=bool)
        for k, at in enumerate(_probes(keys)):
            if k == 0:
                live = self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1 == 1
            else:
                sel = np.flatnonzero(live)
                bit = at[sel]
                live[sel] = self.bits[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8) & 1 == 1
        return live


_KEPT: dict = {}


def _held(broadcast, make):
    """An object made from a broadcast once per task; the task's end clears it."""
    key = broadcast.value[0]
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make(broadcast.value)
    return _KEPT[key]


# ---- counting


def _hot_words(texts: DataFrame, rows: int, buckets: int, limits: TreeLimits) -> np.ndarray:
    """Words frequent enough, in a sample, to be spread over all buckets; only the work's layout depends on them."""
    share = min(1.0, limits.hot_sample / max(rows, 1))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text", COUNTED_BYTES):
                seen, _, _ = symbols(piece.column("text"))
                values, n = np.unique(seen, return_counts=True)
                hot = n * 8 * buckets >= len(seen)
                yield pa.record_batch([pa.array(values[hot].view(np.int64)), pa.array(n[hot]),
                                       pa.array(np.full(int(hot.sum()), len(seen)))], names=["w", "n", "m"])

    found = texts.sample(share, seed=7).mapInArrow(count, "w long, n long, m long")
    found = found.groupBy("w").agg(F.sum(F.col("n") / F.col("m")).alias("f"), F.max(F.col("n") / F.col("m")).alias("g"))
    rows = found.filter(F.col("g") * 4 * buckets >= 1).orderBy(F.desc("f")).limit(8 * buckets).collect()
    return np.sort(np.array([r.w for r in rows], dtype=np.int64).view(np.uint64))


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _is_in(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Whether each value is in a sorted array."""
    if not len(among):
        return np.zeros(len(values), dtype=bool)
    at = np.searchsorted(among, values)
    return among[np.minimum(at, len(among) - 1)] == values


def _added(context: np.ndarray, after: np.ndarray, n: np.ndarray | None):
    """Equal (context, symbol) pairs as one, with their number or the sum of ``n``, sorted by context."""
    key = pair_key(context, after)
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, dtype=np.int64)
    del key
    if n is None:
        n = np.diff(np.append(first, len(order)))
    elif len(first):
        n = np.add.reduceat(n[order], first)
    some = order[first]
    del order, first
    context = context[some]
    by = np.argsort(context)
    return context[by], after[some[by]], n[by]


def _following(texts: DataFrame, buckets: int, hot: np.ndarray, pairs) -> DataFrame:
    """Counts of (context, following symbol): one row a context's bucket and task, arrays packed as bytes.

    ``pairs`` turns the symbols and owners of a piece into contexts and following symbols. Contexts in ``hot`` are
    spread over all buckets by their following symbol.
    """

    def flush(parts: list) -> pa.RecordBatch:
        context, after = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
        parts.clear()
        context, after, n = _added(context, after, None)
        bucket = _bucket(context, buckets)
        wide = _is_in(context, hot)
        bucket[wide] = _bucket(mix(context[wide] ^ after[wide] * _LEFT), buckets)
        order = np.argsort(bucket, kind="stable")
        context, after, n, bucket = context[order], after[order], n[order].astype(np.uint32), bucket[order]
        edges = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket))
        rows = [[], [], [], []]
        for a, b in zip(edges[:-1], edges[1:]):
            for col, v in zip(rows, (int(bucket[a]), context[a:b].tobytes(), after[a:b].tobytes(), n[a:b].tobytes())):
                col.append(v)
        return pa.record_batch([pa.array(rows[0], pa.int64())] + [pa.array(r, pa.binary()) for r in rows[1:]],
                               names=["bucket", "contexts", "after", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            for piece in pieces(batch, "text", COUNTED_BYTES):
                seen, owner, _ = symbols(piece.column("text"))
                parts.append(pairs(seen, owner))
                size += len(parts[-1][0])
                if size >= GATHER:
                    yield flush(parts)
                    size = 0
        if size:
            yield flush(parts)
        _KEPT.clear()

    return texts.select("text").mapInArrow(count, "bucket long, contexts binary, after binary, n binary")


def _totals(packed: DataFrame, min_next: int) -> DataFrame:
    """Per bucket: rows (context, null, total) of every context, and (context, symbol, their key, count) of those counts
    that reach min_next."""

    def add(table: pa.Table) -> pa.Table:
        join = lambda c, t: np.concatenate([np.frombuffer(b.as_py(), dtype=t) for b in table.column(c)])
        context, after, n = _added(join("contexts", np.uint64), join("after", np.uint64),
                                   join("n", np.uint32).astype(np.int64))
        first = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]]))
        often = n >= min_next
        key = pair_key(context[often], after[often])
        long = lambda *parts: pa.array(np.concatenate(parts).view(np.int64))
        none = pa.nulls(len(first), pa.int64())
        return pa.table({"context": long(context[first], context[often]),
                         "symbol": pa.concat_arrays([none, long(after[often])]),
                         "key": pa.concat_arrays([none, long(key)]),
                         "n": long(np.add.reduceat(n, first), n[often])})

    return packed.groupBy("bucket").applyInArrow(add, "context long, symbol long, key long, n long")


def _signed(x: np.uint64) -> int:
    return int(np.array(x, dtype=np.uint64).view(np.int64))


def fit(training: DataFrame, limits: TreeLimits = TreeLimits(), folder: str | None = None) -> Model:
    """Learns the tree from column ``text``; its terms are written to the folder."""
    spark = training.sparkSession
    ship_package(spark)
    small_batches(spark)
    folder = folder or f"{checkpoint_dir(spark).rstrip('/')}/tree-{uuid.uuid4().hex}"
    training = training.select("text")
    rows, size = training.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    buckets = max(8, -(-(size or 0) // BUCKET_BYTES))

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    def neighbours(seen, owner):
        ok = np.flatnonzero(owner[1:] == owner[:-1])
        return seen[ok], seen[ok + 1]

    hot = _hot_words(training, rows, buckets, limits)
    one = kept(_totals(_following(training, buckets, hot, neighbours), limits.min_next), "one")
    # A spread context has a total in each bucket.
    whole = one.filter("symbol is null").groupBy("context").agg(F.sum("n").alias("total"))
    contexts = kept(whole, "contexts")
    words = contexts.filter(F.col("context") != _signed(BEGIN)).select(F.col("context").alias("symbol"), F.col("total").alias("c"))
    words = words.unionByName(spark.range(1 if rows else 0).select(F.lit(_signed(END)).alias("symbol"),
                                                                   F.lit(rows).cast("long").alias("c")))
    tokens, kinds = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    size = tokens + 0.5 * (kinds + 1)

    often = contexts.filter(F.col("total") >= limits.min_count)
    after = one.filter("symbol is not null").join(often, "context")
    after = after.join(words, "symbol").withColumn("parent", (F.col("c") + 0.5) / size)
    first = kept(after.select("context", "symbol", "key", "n", "total", "parent",
                              ((F.col("n") - limits.discount) / F.col("total")).alias("p")), "first")
    tests = _tested(first)

    # Contexts of two symbols: pairs that occur often enough, by their key.
    pairs = first.filter(F.col("n") >= limits.min_count).select(
        F.col("key").alias("context"), F.col("symbol").alias("last"), F.col("n").alias("total"))
    pairs = kept(pairs, "pairs")
    bits = spark.sparkContext.broadcast((uuid.uuid4().hex, build_filter(pairs.select(F.col("context").alias("key")))))

    def triples(seen, owner):
        ok = np.flatnonzero(owner[2:] == owner[:-2])
        context = pair_key(seen[ok], seen[ok + 1])
        maybe = _held(bits, lambda v: Filter(v[1])).has(context)
        return context[maybe], seen[ok[maybe] + 2]

    hot = pairs.filter(F.col("total") * (4 * buckets) >= tokens).select("context").collect()
    hot = np.sort(np.array([r.context for r in hot], dtype=np.int64).view(np.uint64))
    two = kept(_totals(_following(training, buckets, hot, triples), limits.min_next).filter("symbol is not null"), "two")
    above = first.select(F.col("context").alias("last"), "symbol", F.col("p").alias("parent"))
    second = kept(two.join(pairs, "context").join(above, ["last", "symbol"]).select(
        "context", "last", "symbol", "key", "n", "total", "parent",
        ((F.col("n") - limits.discount) / F.col("total")).alias("p")), "second")
    bits.unpersist()

    # Both tests' results, and the contexts that stay: those that pass, and the parents of these.
    deep = kept(_tested(second, "last").filter(F.col("gain") >= limits.min_gain), "deep")
    parents = deep.select(F.col("last").alias("context")).distinct().withColumn("needed", F.lit(True))
    shallow = kept(tests.join(parents, "context", "left").filter(
        (F.col("gain") >= limits.min_gain) | F.col("needed")).select("context", "rest"), "shallow")

    def log(x):
        return F.log10(x)

    base = log((F.col("c") + 0.5) / 0.5)
    # Terms of words (also as contexts), of pairs (as followers and as contexts) and of triples.
    begin = spark.range(1).select(F.lit(_signed(BEGIN)).alias("symbol"), F.lit(None).cast("long").alias("c"))
    single = words.unionByName(begin).join(shallow.withColumnRenamed("context", "symbol"), "symbol", "left").select(
        F.col("symbol").alias("key"), F.col("c").isNotNull().cast("int").alias("known"),
        F.coalesce(base, F.lit(0.0)).alias("base"),
        (F.coalesce(base, F.lit(0.0)) + F.coalesce(log("rest"), F.lit(0.0))).alias("score"),
        F.coalesce("c", F.lit(rows)).cast("long").alias("weight"))
    double = first.join(shallow, "context", "left").join(
        deep.select(F.col("context").alias("key"), F.col("rest").alias("deeper")), "key", "left").select(
        "key", F.lit(0).alias("known"), F.lit(0.0).alias("base"),
        (F.when(F.col("rest").isNotNull(), log("p") - log("rest") - log("parent")).otherwise(0.0)
         + F.coalesce(log("deeper"), F.lit(0.0))).alias("score"), F.col("n").alias("weight"))
    triple = second.join(deep.select("context", "rest"), "context").select(
        "key", F.lit(0).alias("known"), F.lit(0.0).alias("base"),
        (log("p") - log("rest") - log("parent")).alias("score"), F.col("n").alias("weight"))
    terms = single.unionByName(double.filter("score != 0")).unionByName(triple)
    terms.write.parquet(f"{folder}/terms")
    return Model(f"{folder}/terms", math.log10(0.5 / size), int(tokens))


def _tested(rows: DataFrame, *keys: str) -> DataFrame:
    """Per context: its gain over the parent, and the factor that all other symbols' parent probabilities get."""
    n, total, parent = F.col("n"), F.col("total"), F.col("parent")
    sums = rows.groupBy("context", "total", *keys).agg(
        F.sum(n * F.log(n / total / parent)).alias("gain"), F.sum("n").alias("n"), F.sum("p").alias("p"),
        F.sum("parent").alias("parent"))
    other, left = total - n, 1.0 - parent
    gain = F.col("gain") + F.when(other > 0, other * F.log(other / total / left)).otherwise(0.0)
    return sums.select("context", *keys, gain.alias("gain"), ((1.0 - F.col("p")) / left).alias("rest"))


# ---- scoring


class Cache:
    """The most frequent terms and the filter over all terms, in a task."""

    def __init__(self, value):
        _, self.keys, self.known, self.base, self.score, bits = value
        self.filter = Filter(bits)

    def sums(self, keys: np.ndarray, owner: np.ndarray, docs: int):
        """Sums per text of the terms in the cache, and keys, with their texts, that may have a term elsewhere."""
        may = self.filter.has(keys)
        keys, owner = keys[may], owner[may]
        order = np.argsort(keys)
        keys, owner = keys[order], owner[order]
        at = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        hit = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), dtype=bool)
        of, at = owner[hit], at[hit]
        sums = [np.bincount(of, weights=v[at], minlength=docs) for v in (self.known, self.base, self.score)]
        return sums, keys[~hit], owner[~hit]


def _cached_terms(spark: SparkSession, model: Model, most: int):
    """The terms of the highest weights, at most ``most`` of them, as arrays sorted by key."""
    terms = spark.read.parquet(model.terms)
    level = F.floor(F.log2("weight") * 8).cast("int")
    heights = terms.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect()
    low, have = None, 0
    for row in heights:
        if have + row["count"] > most:
            break
        low, have = row["level"], have + row["count"]
    inside = level >= low if low is not None else F.lit(False)
    table = terms.filter(inside).select("key", "known", "base", "score").toArrow()
    keys = table.column("key").to_numpy().view(np.uint64)
    order = np.argsort(keys)
    cols = [table.column(c).to_numpy()[order] for c in ("known", "base", "score")]
    return (keys[order], cols[0].astype(np.int8), *cols[1:]), terms.filter(~inside)


def scored(docs: DataFrame, model: Model, limits: TreeLimits = TreeLimits(), folder: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score) of every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    ship_package(spark)
    small_batches(spark)
    folder = folder or f"{checkpoint_dir(spark).rstrip('/')}/scores-{uuid.uuid4().hex}"
    cache, others = _cached_terms(spark, model, limits.cached)
    bits = build_filter(spark.read.parquet(model.terms).select("key"))
    sent = spark.sparkContext.broadcast((uuid.uuid4().hex, *cache, bits))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = _held(sent, Cache)
        for batch in batches:
            for piece in pieces(batch, "text", SCORED_BYTES):
                yield _measured(piece, terms)
        _KEPT.clear()

    out = "doc_id long, n_tokens long, n_known long, base double, score double, open array<long>"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(measure, out)
    rows.withColumn("row", F.monotonically_increasing_id()).write.parquet(folder)
    sent.unpersist()
    rows = spark.read.parquet(folder)
    texts, asked = rows.agg(F.count("*"), F.coalesce(F.sum(F.size("open")), F.lit(0))).first()
    parts, groups = max(8, -(-max(asked, others.count()) // ASKED)), max(8, -(-texts // SUMMED))
    wanted = rows.select("row", "open").mapInArrow(_asking(parts), "part long, keys binary, rows binary")
    given = others.select("key", "known", "base", "score").mapInArrow(
        _giving(parts), "part long, keys binary, known binary, base binary, score binary")
    more = wanted.groupBy("part").cogroup(given.groupBy("part")).applyInArrow(
        _looked_up(groups), "part long, rows binary, known binary, base binary, score binary")
    more = more.groupBy("part").applyInArrow(_summed, "row long, known2 long, base2 double, score2 double")
    value = lambda c, d: F.col(c) + F.coalesce(F.col(d), F.lit(0))
    return rows.drop("open").join(more, "row", "left").select(
        "doc_id", "n_tokens", value("n_known", "known2").alias("n_known"),
        (F.col("n_tokens") * model.default + value("base", "base2")).alias("base_score"),
        (F.col("n_tokens") * model.default + value("score", "score2")).alias("score"))


def _steps(values: np.ndarray) -> bytes:
    """64-bit numbers as the bytes of their differences, all first bytes before all second ones: sorted ones compress well."""
    steps = np.diff(values.view(np.uint64), prepend=np.uint64(0))
    return steps.view(np.uint8).reshape(-1, 8).T.tobytes()


def _from_steps(data: bytes) -> np.ndarray:
    steps = np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(8, -1).T).view(np.uint64).ravel()
    return np.cumsum(steps, dtype=np.uint64)


def _parted(part: np.ndarray, names: list[str], columns: list[tuple]) -> pa.RecordBatch:
    """A row per part, in which each column, given with its packing, is the bytes of the part's values in their order."""
    order = np.argsort(part, kind="stable")
    part = part[order]
    edges = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(part))
    out = [pa.array(part[edges[:-1]], pa.int64())]
    for values, pack in columns:
        values = values[order]
        out.append(pa.array([pack(values[a:b]) for a, b in zip(edges[:-1], edges[1:])], pa.binary()))
    return pa.record_batch(out, names=["part", *names])


def _joined(table: pa.Table, column: str, unpack) -> np.ndarray:
    some = [unpack(v.as_py()) for v in table.column(column)]
    return np.concatenate(some) if some else unpack(b"")


def _of(dtype):
    return lambda data: np.frombuffer(data, dtype=dtype)


def _key_part(keys: np.ndarray, parts: int) -> np.ndarray:
    return _bucket(mix(keys ^ _TURN), parts)


def _gathered(batches: Iterator[pa.RecordBatch], size, flush) -> Iterator[pa.RecordBatch]:
    """``flush`` of the batches, taken together until they hold GATHER keys."""
    held, have = [], 0
    for batch in batches:
        held.append(batch)
        have += size(batch)
        if have >= GATHER:
            yield flush(pa.Table.from_batches(held).combine_chunks())
            held, have = [], 0
    if have:
        yield flush(pa.Table.from_batches(held).combine_chunks())


def _asking(parts: int):
    """Packs the keys of (row, open) by their part, with the rows they are for."""

    def flush(table: pa.Table) -> pa.RecordBatch:
        lists = table.column("open").combine_chunks()
        keys = lists.flatten().to_numpy().view(np.uint64)
        rows = np.repeat(table.column("row").to_numpy(), lists.value_lengths().to_numpy())
        return _parted(_key_part(keys, parts), ["keys", "rows"], [(keys, np.ndarray.tobytes), (rows, _steps)])

    return lambda batches: _gathered(batches, lambda b: len(b.column("open").flatten()), flush)


def _giving(parts: int):
    """Packs terms by the part of their keys."""

    def flush(table: pa.Table) -> pa.RecordBatch:
        keys = table.column("key").to_numpy().view(np.uint64)
        order = np.argsort(keys)
        keys = keys[order]
        known, base, score = (table.column(c).to_numpy()[order] for c in ("known", "base", "score"))
        return _parted(_key_part(keys, parts), ["keys", "known", "base", "score"], [
            (keys, _steps), *[(v, np.ndarray.tobytes) for v in (known.astype(np.int8), base, score)]])

    return lambda batches: _gathered(batches, lambda b: b.num_rows, flush)


def _looked_up(groups: int):
    """Sums, per row of the scores, of the terms of one part of the keys, packed by groups of rows."""

    def look(asked: pa.Table, terms: pa.Table) -> pa.Table:
        keys = _joined(terms, "keys", _from_steps)
        order = np.argsort(keys)
        keys = keys[order]
        wanted, rows = _joined(asked, "keys", _of(np.uint64)), _joined(asked, "rows", _from_steps)
        hit = np.flatnonzero(_is_in(wanted, keys))
        at = order[np.searchsorted(keys, wanted[hit])]
        row, of = np.unique(rows[hit], return_inverse=True)
        known, base, score = (np.bincount(of, weights=_joined(terms, c, _of(t))[at], minlength=len(row))
                              for c, t in (("known", np.int8), ("base", np.float64), ("score", np.float64)))
        return pa.Table.from_batches([_parted(_bucket(mix(row), groups), ["rows", "known", "base", "score"], [
            (row, _steps), *[(v, np.ndarray.tobytes) for v in (known.astype(np.int64), base, score)]])])

    return look


def _summed(table: pa.Table) -> pa.Table:
    """Sums of a group of rows over all parts of the keys."""
    row, of = np.unique(_joined(table, "rows", _from_steps), return_inverse=True)
    sums = [np.bincount(of, weights=_joined(table, c, _of(t)), minlength=len(row))
            for c, t in (("known", np.int64), ("base", np.float64), ("score", np.float64))]
    return pa.table({"row": pa.array(row.view(np.int64)), "known2": pa.array(sums[0].astype(np.int64)),
                     "base2": pa.array(sums[1].astype(np.float64)), "score2": pa.array(sums[2].astype(np.float64))})


def _measured(piece: pa.RecordBatch, terms: Cache) -> pa.RecordBatch:
    docs = piece.num_rows
    seen, owner, words = symbols(piece.column("text"))
    two = np.flatnonzero(owner[1:] == owner[:-1])
    three = np.flatnonzero(owner[2:] == owner[:-2])
    pairs = pair_key(seen[:-1], seen[1:])
    keys = np.concatenate([seen, pairs[two], pair_key(pairs[three], seen[three + 2])])
    of = np.concatenate([owner, owner[two], owner[three]])
    (known, base, score), keys, of = terms.sums(keys, of, docs)
    order = np.argsort(of, kind="stable")
    ends = np.cumsum(np.bincount(of, minlength=docs))
    lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(keys[order].view(np.int64)))
    return pa.record_batch([piece.column("doc_id"), pa.array(words + 1), pa.array(known.astype(np.int64)),
                            pa.array(base.astype(np.float64)), pa.array(score.astype(np.float64)), lists],
                           names=["doc_id", "n_tokens", "n_known", "base", "score", "open"])


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is kept from training, by its id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 1, F.lit(False))
