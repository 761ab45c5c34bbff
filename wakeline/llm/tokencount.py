"""Token counts of whole texts, with overlap resynchronisation for huge ones.

A text of up to ``chunk_chars`` characters is encoded whole. A longer one is cut into chunks that
overlap by ``overlap_chars``; chunks are rows of their own, dealt over all tasks, and each is encoded
with offsets. Offsets are in bytes of the text with every U+2581 as a blank, which the encoder takes for one. Neighbouring chunks are spliced at a *stable* boundary inside their overlap: a byte
offset where both encodings end a token and both have the same token before it. There the pair of
tokens at the splice stands side by side in one of the two encodings, so it is a pair that merging
leaves alone, and a sequence in which that holds for every adjacent pair is the encoding of the whole text.
Where an overlap has no such boundary, the text is cut again with chunks and overlaps ``widen`` times as
long, until it is spliced or is one chunk.

Only a chunk's two edge zones (token ids and offsets inside the overlap) and its token count leave the
encoding task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.llm.columns import cleared, extended
from wakeline.llm.tokenizers_io import broadcast_file, piece_model
from wakeline.session import materialize, ship_package

CHUNK_CHARS = 32_768
OVERLAP_CHARS = 256
WIDEN = 4
ENCODE_CHARS = 1 << 20

# Zones are packed arrays of these entries: boundary offset, token before it, tokens up to it.
ZONE = np.dtype([("at", "<i8"), ("before", "<i4"), ("index", "<i4")])


def n_offset(text: str) -> int:
    """Bytes of the text; a U+2581 counts as the blank that its piece stands for."""
    return len(text.replace("▁", " ").encode())


def cut(text: str, chunk_chars: int, overlap_chars: int):
    """Yield (number, chunk, offset, offset of the next chunk or -1) covering ``text``."""
    step = chunk_chars - overlap_chars
    starts = range(0, max(len(text) - overlap_chars, 1), step)
    at = 0
    for k, s in enumerate(starts):
        last = k == len(starts) - 1
        chunk = text[s:] if last else text[s:s + chunk_chars]
        after = -1 if last else at + n_offset(text[s:s + step])
        yield k, chunk, at, after
        at = after


def byte_lengths(sp) -> np.ndarray:
    """Bytes of text that each id stands for; a blank counts as one."""
    return np.array([1 if sp.is_byte(i) else len(sp.id_to_piece(i).replace("▁", " ").encode())
                     for i in range(sp.vocab_size())], dtype=np.int64)


def zones(ids: list[int], lengths: np.ndarray, at: int, after: int, overlap_bytes_end: int) -> tuple[bytes, bytes]:
    """Boundaries in the overlap with the chunk before and with the chunk after, packed."""
    tokens = np.asarray(ids, dtype=np.int64)
    # The encoder puts one blank before the chunk, which is not part of the text.
    ends = at - 1 + np.cumsum(lengths[tokens])
    every = np.empty(len(tokens), dtype=ZONE)
    every["at"], every["before"], every["index"] = ends, tokens, np.arange(1, len(tokens) + 1)
    head = every[ends < overlap_bytes_end] if at else every[:0]
    tail = every[ends > after] if after >= 0 else every[:0]
    return head.tobytes(), tail.tobytes()


def splice(tail: bytes, head: bytes) -> tuple[int, int] | None:
    """Tokens of the left chunk to keep and of the right chunk to drop, at a stable boundary."""
    left, right = np.frombuffer(tail, dtype=ZONE), np.frombuffer(head, dtype=ZONE)
    _, i, j = np.intersect1d(left["at"], right["at"], assume_unique=True, return_indices=True)
    stable = left["before"][i] == right["before"][j]
    if not stable.any():
        return None
    first = int(np.flatnonzero(stable)[0])
    return int(left["index"][i[first]]), int(right["index"][j[first]])


def _encoded_chunks(texts: DataFrame, model, chunk_chars: int, overlap_chars: int) -> DataFrame:
    """Rows (key, k, n, head, tail) of every chunk of the texts in columns ``_key`` and ``_text``."""

    def chunks(batches):
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for k, chunk, at, after in cut(text, chunk_chars, overlap_chars):
                    # The previous chunk's overlap ends at this offset of the text.
                    end = at + n_offset(chunk[:overlap_chars])
                    yield pa.RecordBatch.from_pylist(
                        [{"_key": key, "k": k, "chunk": chunk, "at": at, "after": after, "edge": end}], schema=arrow)

    def encode(batches):
        sp = piece_model(model.value)
        lengths = byte_lengths(sp)
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                ids = sp.encode(r["chunk"])
                head, tail = zones(ids, lengths, r["at"], r["after"], r["edge"])
                rows.append({"_key": r["_key"], "k": r["k"], "n": len(ids), "head": head, "tail": tail,
                             "last": r["after"] < 0})
            yield pa.RecordBatch.from_pylist(rows, schema=result)

    arrow = pa.schema([("_key", pa.string()), ("k", pa.int32()), ("chunk", pa.string()), ("at", pa.int64()),
                       ("after", pa.int64()), ("edge", pa.int64())])
    result = pa.schema([("_key", pa.string()), ("k", pa.int32()), ("n", pa.int64()), ("head", pa.binary()),
                        ("tail", pa.binary()), ("last", pa.bool_())])
    rows = texts.select("_key", "_text").mapInArrow(
        chunks, "_key string, k int, chunk string, at long, after long, edge long")
    # Chunks of one text, and chunks of equal texts, are spread by their number and a salt.
    rows = rows.withColumn("_salt", F.spark_partition_id()).repartition("_key", "k", "_salt").drop("_salt")
    encoded = rows.mapInArrow(encode, "_key string, k int, n long, head binary, tail binary, last boolean")
    return encoded.dropDuplicates(["_key", "k"])


def _spliced(chunks: DataFrame) -> DataFrame:
    """(key, n_tokens, failed): tokens of each text, and how many of its overlaps have no splice."""

    def run(batches):
        for batch in batches:
            out = []
            for key, n, tail, head in zip(*[batch.column(i).to_pylist() for i in range(4)]):
                found = splice(tail, head)
                keep, drop = found or (0, 0)
                out.append({"_key": key, "n": -(n - keep) - drop, "failed": int(found is None)})
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    arrow = pa.schema([("_key", pa.string()), ("n", pa.int64()), ("failed", pa.int64())])
    left = chunks.filter("not last").select("_key", (F.col("k") + 1).alias("k"), "n", "tail")
    pairs = left.join(chunks.select("_key", "k", "head"), ["_key", "k"]).select("_key", "n", "tail", "head")
    less = pairs.mapInArrow(run, "_key string, n long, failed long")
    return (chunks.select("_key", "n", F.lit(0).cast("long").alias("failed")).unionByName(less)
            .groupBy("_key").agg(F.sum("n").alias("n_tokens"), F.sum("failed").alias("failed")))


def huge_counts(texts: DataFrame, model, chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS) -> DataFrame:
    """(key, n_tokens) for texts in columns ``_key`` (of the content) and ``_text``; see the module's text.

    Each round writes the counts of its texts once; only the number of texts still to do comes back to
    the driver. The chunks grow ``WIDEN`` times a round, so the rounds end.
    """
    done, todo = None, texts
    while True:
        # Counts and both edges are read from the chunks, so they are written once.
        chunks = materialize(_encoded_chunks(todo, model, chunk_chars, overlap_chars))
        counts = materialize(_spliced(chunks))
        good = counts.filter("failed = 0").select("_key", "n_tokens")
        done = good if done is None else done.unionByName(good)
        failed = counts.filter("failed > 0").select("_key")
        if failed.isEmpty():
            return done
        todo = texts.join(failed, "_key", "left_semi")
        chunk_chars, overlap_chars = chunk_chars * WIDEN, overlap_chars * WIDEN


def token_counts(docs: DataFrame, model_path: str, text: str = "text", limit: int = 4096, prefix: str = "",
                 chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS) -> DataFrame:
    """``docs`` without the text column, plus n_bytes, n_tokens and over_limit (each with ``prefix``).

    Null and empty texts have 0 bytes and 0 tokens. Rows are counted each on its own; equal huge texts
    share one count. Other columns pass through; one with the name of an output is replaced
    by it (``prefix`` keeps it).
    """
    spark = docs.sparkSession
    ship_package(spark)
    model = broadcast_file(spark, model_path)
    names = [prefix + "n_bytes", prefix + "n_tokens"]
    docs = cleared(docs, [*names, prefix + "over_limit", "_key"])
    keep = [c for c in docs.columns if c != text]
    schema = extended(docs.select(*keep), [(n, "long") for n in names])

    def run(batches):
        sp = piece_model(model.value)
        for batch in batches:
            at = batch.schema.get_field_index(text)
            texts = [x or "" for x in batch.column(at).to_pylist()]
            counts, group, chars = [], [], 0
            for i, t in enumerate(texts):
                group.append(t)
                chars += len(t)
                if chars >= ENCODE_CHARS or i == len(texts) - 1:
                    counts += map(len, sp.encode(group, num_threads=1))
                    group, chars = [], 0
            cols = [batch.column(c) for c in keep] + [pa.array([len(t.encode()) for t in texts], pa.int64()),
                                                      pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, keep + names)

    size = F.coalesce(F.char_length(text), F.lit(0))
    small = docs.filter(size <= chunk_chars).mapInArrow(run, schema)
    huge = docs.filter(size > chunk_chars)
    key = F.concat_ws("-", F.sha1(text), F.char_length(text))
    counts = huge_counts(huge.select(key.alias("_key"), F.col(text).alias("_text")), model, chunk_chars, overlap_chars)
    large = (huge.select(*keep, key.alias("_key"), F.octet_length(text).cast("long").alias(names[0]))
             .join(counts.withColumnRenamed("n_tokens", names[1]), "_key").select(*keep, *names))
    return small.unionByName(large).withColumn(prefix + "over_limit", F.col(names[1]) > limit)
