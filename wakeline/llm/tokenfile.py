"""Token-id output as binary files with Elias-Fano document boundaries.

Documents are encoded, dealt to shards by ranges of doc_id and written in ascending doc_id order, one file
per shard. A file is the concatenated ids (2 or 4 bytes each, by vocabulary size), the documents' end
offsets and doc_ids as two Elias-Fano sequences, and a footer. An Elias-Fano sequence
of n values below u keeps the low ``log2(u / n)`` bits of each value packed, and the high parts as
a bit vector with n ones, about ``2 + log2(u / n)`` bits per value; sampled positions of
the ones let ``select`` find any value without a table of 64-bit offsets.

Files are written under a temporary name and then moved, so a retried or duplicated task leaves
one whole file. They lie in the shared folder that ``spark.checkpoint.dir`` names.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.llm.batchwords import pieces
from wakeline.llm.tokenizers_io import broadcast_file, json_tokenizer
from wakeline.operators.prefix import scan_before
from wakeline.session import checkpoint_dir, ship_package, small_batches

MAGIC = b"WKTOK001"
SAMPLE = 256
SHARD_DOCS = 16_384
# Units that a task remembers, with their ids; longer ones are asked for anew in each batch of texts.
CACHED_UNITS = 500_000
CACHED_IDS = 1 << 23
CACHED_CHARS = 64
# Text encoded at once, and units that the tokenizer is given at once.
ENCODED_BYTES = 2 << 20
ASKED = 4096
FOOTER = struct.Struct("<QQQQBQQ8s")
EF_HEAD = struct.Struct("<QQBQQ")


class EliasFano:
    """A non-decreasing sequence of unsigned integers with random access."""

    def __init__(self, n: int, universe: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.universe, self.low_bits, self.low, self.high, self.samples = n, universe, low_bits, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, dtype=np.uint64)
        n = len(values)
        universe = int(values[-1]) + 1 if n else 1
        low_bits = max(0, (universe // max(n, 1)).bit_length() - 1)
        if low_bits:
            shifts = np.arange(low_bits, dtype=np.uint64)
            low = np.packbits(((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
        else:
            low = np.empty(0, dtype=np.uint8)
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(ones[-1]) + 1 if n else 0, dtype=np.uint8)
        bits[ones] = 1
        return cls(n, universe, low_bits, low, np.packbits(bits, bitorder="little"), ones[::SAMPLE].astype("<u4"))

    def to_bytes(self) -> bytes:
        return (EF_HEAD.pack(self.n, self.universe - 1, self.low_bits, len(self.low), len(self.high))
                + self.low.tobytes() + self.high.tobytes() + self.samples.tobytes())

    @classmethod
    def from_bytes(cls, data: memoryview) -> EliasFano:
        n, top, low_bits, n_low, n_high = EF_HEAD.unpack_from(data)
        at = EF_HEAD.size
        low = np.frombuffer(data, np.uint8, n_low, at)
        high = np.frombuffer(data, np.uint8, n_high, at + n_low)
        samples = np.frombuffer(data, "<u4", -(-n // SAMPLE), at + n_low + n_high)
        return cls(n, top + 1, low_bits, low, high, samples)

    def select(self, i: int) -> int:
        """Value number ``i``: its high part from the i-th one of the bit vector, its low bits directly."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at = int(self.samples[i // SAMPLE])
        left = i % SAMPLE
        byte = at >> 3
        word = int(self.high[byte]) >> (at & 7) << (at & 7)
        while (ones := word.bit_count()) <= left:
            left -= ones
            byte += 1
            word = int(self.high[byte])
        for _ in range(left):
            word &= word - 1
        one = (byte << 3) + (word & -word).bit_length() - 1
        value = one - i
        if self.low_bits:
            bit = i * self.low_bits
            last = bit + self.low_bits
            chunk = int.from_bytes(self.low[bit >> 3:(last + 7) >> 3].tobytes(), "little")
            value = value << self.low_bits | chunk >> (bit & 7) & ((1 << self.low_bits) - 1)
        return value

    def values(self) -> np.ndarray:
        """All values at once."""
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))
        out = (ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)
        if self.low_bits:
            bits = np.unpackbits(self.low, count=self.n * self.low_bits, bitorder="little")
            weights = np.uint64(1) << np.arange(self.low_bits, dtype=np.uint64)
            out |= (bits.reshape(self.n, self.low_bits).astype(np.uint64) * weights).sum(axis=1, dtype=np.uint64)
        return out


class TokenFile:
    """One shard, read back: ``ids(i)`` finds document ``i`` through the boundary sequence alone."""

    def __init__(self, data: bytes):
        self.data = memoryview(data)
        self.shard, self.n_docs, self.n_null, n_ids, self.width, ends_at, docs_at, magic = FOOTER.unpack(
            self.data[-FOOTER.size:])
        if magic != MAGIC or bytes(self.data[:8]) != MAGIC:
            raise ValueError("not a token file")
        self.ids_all = np.frombuffer(self.data, f"<u{self.width}", n_ids, 8)
        self.ends = EliasFano.from_bytes(self.data[ends_at:docs_at])
        base = struct.unpack_from("<q", self.data, docs_at)[0]
        self.base, self.docs = base, EliasFano.from_bytes(self.data[docs_at + 8:-FOOTER.size])

    def bounds(self, i: int) -> tuple[int, int]:
        return (self.ends.select(i - 1) if i else 0), self.ends.select(i)

    def ids(self, i: int) -> np.ndarray:
        start, end = self.bounds(i)
        return self.ids_all[start:end].astype("<u4")

    def doc_id(self, i: int) -> int | None:
        return None if i < self.n_null else self.docs.select(i - self.n_null) + self.base


class ShardWriter:
    """Writes one file; ids are streamed, only the documents' lengths and ids are held."""

    def __init__(self, fs, folder: str, shard: int, width: int):
        self.fs, self.shard, self.width = fs, shard, width
        self.path = f"{folder}/shard-{shard:08d}.wktok"
        self.part = f"{folder}/.part-{uuid.uuid4().hex}"
        self.out = fs.open_output_stream(self.part)
        self.out.write(MAGIC)
        self.lengths: list[int] = []
        self.doc_ids: list[int] = []
        self.n_null = 0

    def add(self, doc_id: int | None, ids: pa.Buffer) -> None:
        self.out.write(ids)
        self.lengths.append(ids.size // self.width)
        if doc_id is None:
            self.n_null += 1
        else:
            self.doc_ids.append(doc_id)

    def close(self) -> tuple[int, int, int]:
        ends = np.cumsum(np.array(self.lengths, dtype=np.int64))
        n_ids = int(ends[-1]) if len(ends) else 0
        base = self.doc_ids[0] if self.doc_ids else 0
        docs = np.array([d - base for d in self.doc_ids], dtype=np.uint64)
        ends_at = 8 + n_ids * self.width
        packed = EliasFano.of(ends).to_bytes()
        self.out.write(packed)
        self.out.write(struct.pack("<q", base) + EliasFano.of(docs).to_bytes())
        self.out.write(FOOTER.pack(self.shard, len(self.lengths), self.n_null, n_ids, self.width,
                                   ends_at, ends_at + len(packed), MAGIC))
        self.out.close()
        self.fs.move(self.part, self.path)
        return self.shard, len(self.lengths), n_ids


class WordEncoder:
    """Ids of whole texts from the tokenizer, asked once for each distinct unit.

    The byte-level pre-tokenizer never joins a visible character to a blank or line feed after it, so a text
    may be cut there and its units encoded apart. Texts are cut, and their units told apart and put together again, by
    array operations over many texts; only the distinct units of these are looked up one by one. Units are remembered,
    in bounded memory.
    """

    UNIT = re.compile(r"\s*\S+(?:[^\S \n]\s*\S*)*|\s+")
    # Letters and marks of plain words; no apostrophe, which may open an ending of its own.
    LETTERS, MARKS = r"[A-Za-zÀ-ÖØ-öø-ſ]", r"[!-&(-/:-@\[-`{-~]"
    PLAIN = re.compile(f"([ \n]?)({LETTERS}+)({MARKS}*)")
    # Two neighbours that both are blanks to Python's regular expressions, as Arrow's have fewer of them.
    DOUBLE = "[{0}][{0}]".format(r"\s\v\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}")

    def __init__(self, tokenizer, width: int):
        self.tokenizer, self.width = tokenizer, width
        self.plain = self.PLAIN.fullmatch if self._cuts_plain_words() else lambda unit: None
        single = (chr(c) for c in range(0x180) if re.fullmatch(f"[ \n]|{self.LETTERS}|{self.MARKS}", chr(c)))
        cut = tokenizer.pre_tokenizer.pre_tokenize_str if tokenizer.pre_tokenizer else lambda c: [(c, None)]
        self.spelt = str.maketrans({c: "".join(x for x, _ in cut(c)) for c in single})
        self._forget()

    def _cuts_plain_words(self) -> bool:
        """Whether a unit of ``PLAIN`` always goes to the tokenizer's model in these pieces: a line feed, the word with
        a blank before it, the marks after it, each spelt byte by byte."""
        spec = json.loads(self.tokenizer.to_str())
        cut = spec["pre_tokenizer"] or {}
        return (spec["normalizer"] is None and cut.get("type") == "ByteLevel" and cut["use_regex"] and not cut["add_prefix_space"]
                and not any(re.fullmatch(r"\s*[^\W\d_]*[^\w\s]*\s*", t["content"]) for t in spec["added_tokens"]))

    def _forget(self) -> None:
        """Starts with no units: their numbers, and by number where a unit's ids start in ``ids`` and how many they are."""
        self.known: dict[str, int] = {}
        self.ids = np.empty(0, dtype=f"<u{self.width}")
        self.starts, self.lengths = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)

    def encode(self, texts: pa.Array, end: bytes = b"") -> pa.Array:
        """Each text's ids and ``end`` as bytes; a null text is empty."""
        texts = pc.fill_null(texts, "")
        double = pc.match_substring_regex(texts, self.DOUBLE).to_numpy(zero_copy_only=False)
        # Where each blank and line feed stands alone, it opens the unit after it.
        lines, of_text = self._split(pc.if_else(pa.array(double), "", texts), "\n")
        later = np.ones(len(lines), dtype=bool)
        later[np.cumsum(of_text) - of_text] = False
        parts, of_line = self._split(lines, " ")
        firsts = np.cumsum(of_line) - of_line
        sizes = np.add.reduceat(of_line, np.cumsum(of_text) - of_text) if len(texts) else of_text
        rest, head = parts.dictionary_encode(), parts.take(pa.array(firsts))
        head = pc.binary_join_element_wise(pc.if_else(pa.array(later), "\n", ""), head, "").dictionary_encode()
        texts_of = lambda a: a.dictionary.to_numpy(zero_copy_only=False).tolist()
        units = [" " + u for u in texts_of(rest)]
        plain = rest.indices.to_numpy().copy()
        plain[firsts] = head.indices.to_numpy() + len(units)
        units += texts_of(head)
        plain = plain[np.repeat(~double, sizes)]
        place: dict[str, int] = {}
        others = {}
        for d in np.flatnonzero(double):
            found = self.UNIT.findall(texts[int(d)].as_py())
            others[d] = np.array([place.setdefault(u, len(units) + len(place)) for u in found], dtype=np.int32)
            sizes[d] = len(found)
        units += place

        # All texts' units in their order, an end after each text.
        stops = np.cumsum(sizes + 1)
        codes = np.full(int(stops[-1]) if len(stops) else 0, len(units), dtype=np.int32)
        free = np.ones(len(codes), dtype=bool)
        free[stops - 1] = False
        for d, found in others.items():
            at = slice(stops[d] - 1 - len(found), stops[d] - 1)
            codes[at], free[at] = found, False
        codes[free] = plain
        numbers = self._numbers(units)
        numbers = np.append(numbers, np.int32(len(self.starts)))[codes]
        ids = np.concatenate([self.ids, np.frombuffer(end, dtype=self.ids.dtype)])
        starts, lengths = np.append(self.starts, len(self.ids)), np.append(self.lengths, len(ids) - len(self.ids))
        n = lengths[numbers]
        ends = np.cumsum(n)
        out = ids[np.repeat(starts[numbers] - ends + n, n) + np.arange(int(ends[-1]) if len(ends) else 0)]
        offsets = np.append(0, ends[stops - 1] * self.width).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(offsets), pa.py_buffer(out)])

    @staticmethod
    def _split(texts: pa.Array, at: str) -> tuple[pa.Array, np.ndarray]:
        """All texts' parts, and how many each text has."""
        cut = pc.split_pattern(texts, at)
        return pc.list_flatten(cut), pc.list_value_length(cut).to_numpy().astype(np.int64)

    def _numbers(self, units: list[str]) -> np.ndarray:
        """Numbers of distinct units; those not known yet are given to the tokenizer."""
        if len(self.known) >= CACHED_UNITS or len(self.ids) >= CACHED_IDS:
            self._forget()
        known = self.known
        found = list(map(known.get, units))
        missing = [u for u, n in zip(units, found) if n is None]
        ids, lengths, first = [self.ids], [self.lengths], len(self.starts)
        for s in range(0, len(missing), ASKED):
            got = self._asked(missing[s:s + ASKED])
            lengths.append(np.fromiter(map(len, got), dtype=np.int64, count=len(got)))
            ids.append(np.fromiter(chain.from_iterable(got), dtype=self.ids.dtype, count=int(lengths[-1].sum())))
        self.ids, self.lengths = np.concatenate(ids), np.concatenate(lengths)
        self.starts = np.cumsum(self.lengths) - self.lengths
        known.update((u, n) for n, u in enumerate(missing, first) if len(u) <= CACHED_CHARS)
        new = iter(range(first, first + len(missing)))
        return np.array([next(new) if n is None else n for n in found], dtype=np.int32)

    def _asked(self, units: list[str]) -> list[list[int]]:
        """The tokenizer's ids of units; plain words go to its model without being cut first."""
        out: list = [None] * len(units)
        model, short = self.tokenizer.model, {"": []}
        for i, found in enumerate(map(self.plain, units)):
            if found:
                before, word, after = found.groups()
                if before == " ":
                    before, word = "", " " + word
                for piece in (before, after):
                    if piece not in short:
                        short[piece] = [t.id for t in model.tokenize(piece.translate(self.spelt))]
                out[i] = short[before] + [t.id for t in model.tokenize(word.translate(self.spelt))] + short[after]
        left = [i for i, ids in enumerate(out) if ids is None]
        for i, e in zip(left, self.tokenizer.encode_batch_fast([units[i] for i in left], add_special_tokens=False)):
            out[i] = e.ids
        return out


_ENCODERS: dict[tuple[int, int], WordEncoder] = {}


def _encoder(data: bytes, width: int) -> WordEncoder:
    key = (hash(data), width)
    if key not in _ENCODERS:
        _ENCODERS[key] = WordEncoder(json_tokenizer(data), width)
    return _ENCODERS[key]


def write_tokens(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 0, doc_id: str = "doc_id",
                 text: str = "text", shard_docs: int = SHARD_DOCS) -> None:
    """Encode ``docs`` and write shard files and a manifest (shard, n_docs, n_ids) under ``folder``.

    Shards are ranges of doc_id taken from approximate quantiles; a doc_id that fills several ranges
    (repeated or null) is dealt over all of them. Null doc_ids come first; rows with the same
    doc_id follow each other in the order of their ids. A null text is encoded as empty, so each
    document has at least its end id. An empty table gives an empty manifest.
    """
    spark = docs.sparkSession
    ship_package(spark)
    small_batches(spark)
    data = broadcast_file(spark, tokenizer_path)
    width = 2 if json_tokenizer(data.value).get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
    low = -(1 << 63)
    slim = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(low)).alias("_key"), F.col(text).alias("_text"))
    n = slim.count()
    n_shards = max(1, -(-n // shard_docs))
    at = [i / n_shards for i in range(1, n_shards)]
    edges = []
    if at:
        edges = slim.agg(F.percentile_approx("_key", at, max(10_000, 20 * n_shards))).first()[0]
    edges = spark.sparkContext.broadcast(np.array(edges, dtype=np.int64))
    end = int(end_id).to_bytes(width, "little")

    def encode(batches):
        encoder = _encoder(data.value, width)
        for batch in batches:
            at = 0
            for piece in pieces(batch, "_text", ENCODED_BYTES):
                keys = piece.column(0).to_numpy()
                ids = encoder.encode(piece.column(1), end)
                shard = np.searchsorted(edges.value, keys, "left")
                last = np.searchsorted(edges.value, keys, "right")
                # A key that equals several edges may go to any shard between them.
                for i in np.flatnonzero(last > shard):
                    shard[i] += (zlib.crc32(ids[i].as_buffer()) + at + i) % (last[i] - shard[i] + 1)
                at += len(keys)
                yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int64()), pa.array(keys, pa.int64()), ids],
                                                 ["shard", "_key", "ids"])

    def write(batches):
        from pyarrow import fs as pafs

        # The encoding is over; workers may be used again, and need not hold its units while files are written and read.
        _ENCODERS.clear()
        fs, path = pafs.FileSystem.from_uri(uri)
        fs.create_dir(path, recursive=True)
        writer, rows = None, []
        for batch in batches:
            for shard, key, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if writer is None or writer.shard != shard:
                    if writer:
                        rows.append(writer.close())
                    writer = ShardWriter(fs, path, shard, width)
                writer.add(None if key == low else key, ids.as_buffer())
        if writer:
            rows.append(writer.close())
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(3)],
                                         ["shard", "n_docs", "n_ids"])

    uri = (folder if "://" in folder or folder.startswith("file:") else "file://" + folder) + "/shards"
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    encoded = slim.mapInArrow(encode, "shard long, _key long, ids binary")
    dealt = encoded.repartition(n_shards, "shard").sortWithinPartitions("shard", "_key", "ids")
    dealt.mapInArrow(write, "shard long, n_docs long, n_ids long").write.parquet(folder + "/manifest")


def read_tokens(spark, folder: str, with_ids: bool = False) -> DataFrame:
    """Rows of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, shard,
    and with ``with_ids`` the ids. Each file is one row of bytes, read by Spark."""
    ship_package(spark)
    manifest = spark.read.schema("shard long, n_docs long, n_ids long").parquet(folder + "/manifest")
    base = scan_before(manifest.select("shard", "n_ids"), "n_ids", "shard", "before", "sum")
    base = base.select("shard", F.coalesce("before", F.lit(0)).cast("long").alias("before"))
    fields = [("shard", pa.int64()), ("doc_id", pa.int64()), ("local", pa.int64()), ("n_tokens", pa.int64()),
              ("ids_crc32", pa.int64())] + ([("ids", pa.list_(pa.int64()))] if with_ids else [])

    def run(batches):
        for batch in batches:
            for data in batch.column(0):
                f = TokenFile(data.as_buffer())
                ends = f.ends.values().astype(np.int64)
                starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                docs = [None] * f.n_null + [int(d) + f.base for d in f.docs.values()]
                ids = f.ids_all.astype("<u4")
                crc = [zlib.crc32(ids[s:e]) for s, e in zip(starts, ends)]
                cols = [np.full(len(ends), f.shard), docs, starts, ends - starts, crc]
                if with_ids:
                    cols.append([ids[s:e].tolist() for s, e in zip(starts, ends)])
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, fields)],
                                                 [x for x, _ in fields])

    if manifest.isEmpty():
        rows = spark.createDataFrame([], "shard long, doc_id long, local long, n_tokens long, ids_crc32 long"
                                     + (", ids array<long>" if with_ids else ""))
    else:
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.wktok").load(folder + "/shards")
        rows = files.select("content").mapInArrow(
            run, "shard long, doc_id long, local long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else ""))
    out = rows.join(base, "shard").withColumn("start", F.col("before") + F.col("local"))
    return out.select("doc_id", "start", "n_tokens", "ids_crc32", "shard", *(["ids"] if with_ids else []))


def new_folder(spark) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
