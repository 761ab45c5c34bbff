"""Language identification: known words first, backing off to shorter and shorter character n-grams.

Fitting counts words and character n-grams per language with Spark aggregations over every distinct text
of the labelled rows, and keeps the most frequent of each, so a language's part of the model is bounded by
``words_per_lang`` and ``grams_per_lang``. The model is sparse: each entry lists the languages that know it, so it
grows with its entries, not with entries times languages, and it can be sent to every task. A known word scores its log
frequency in each language. An unseen word is covered from left to right: at each position the longest
known n-gram scores, and the next one starts where it ends. A text scores the sum over all its words; its confidence
is the winner's share of the likelihood. Only the text is read for a prediction.

The likelihood is summed over all words, so it nearly always names a clear winner, for random letters too. Whether
the winner explains the text is told by ``known``, the share of its words that the winner knows as its own words, against a
fence learnt per language from all labelled texts (``fit_fences``).
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline.llm.columns import appended, cleared, extended
from wakeline.session import checkpoint_dir, drop_folder, materialize, ship_package, small_batches

WORD = re.compile(r"[^\W\d_]+")
UNDETERMINED = "und"
MAX_GRAM = 5
MAX_WORD_CHARS = 64
# Entries that a task holds: rows of unseen words, and counts of words and n-grams not yet handed on.
REMEMBERED = 100_000
COUNTED = 300_000
GRAMS_HELD = 500_000
# Words cut into n-grams at once.
WORDS_CUT = 10_000
# A row a language: up to so many are sent to every task, more are joined by a shuffle.
BROADCAST_LANGS = 65_536
# Places that hashes of texts fall in; the places of repeated texts are sent to every task.
HASH_PLACES = 1 << 20
# A text is explained by its language if the share of its words that the language knows reaches FENCE_PART of the
# share that all but FENCE_QUANTILE of the language's texts reach.
FENCE_QUANTILE, FENCE_PART = 0.01, 0.75
# A language knows a word as its own if the word is at most so many times as frequent in any other one, so that a few
# texts with a wrong label do not make two languages share their words.
OWN_FACTOR = 10.0


@dataclass(frozen=True)
class FitLimits:
    """Entries kept a language. All distinct texts teach, unless a caller asks for about ``docs_per_lang`` a language."""

    docs_per_lang: int | None = None
    words_per_lang: int = 50_000
    grams_per_lang: int = 30_000


def words_of(text: str) -> list[str]:
    """Lower-cased runs of letters; runs are cut every ``MAX_WORD_CHARS`` characters."""
    found = WORD.findall(text.lower())
    if len(text) <= MAX_WORD_CHARS or max(map(len, found), default=0) <= MAX_WORD_CHARS:
        return found
    return [w[i:i + MAX_WORD_CHARS] for w in found for i in range(0, len(w), MAX_WORD_CHARS)]


def sample_rows(docs: DataFrame, text: str, lang: str, limits: FitLimits) -> DataFrame:
    """(lang, text) of about ``docs_per_lang`` distinct texts a language, chosen by a hash of the text.

    Each chosen text comes once a language: the copies of a chosen text are chosen with it, and they may be
    a large part of all rows. So the share is of a language's distinct texts, counted by a sketch."""
    texts = F.least(F.count("*"), F.greatest(F.lit(1), F.approx_count_distinct(F.xxhash64(text))))
    taught = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    share = materialize(taught.groupBy(F.col(lang).alias("_lang")).agg(texts.alias("_n")).select(
        "_lang", F.least(F.lit(1.0), F.lit(float(limits.docs_per_lang)) / F.col("_n")).alias("_share")))
    part = F.pmod(F.xxhash64(text), F.lit(1 << 30)) / float(1 << 30)
    few = share.count() <= BROADCAST_LANGS
    return (taught.select(F.col(lang).alias("lang"), F.col(text).alias("text"), part.alias("_part"))
            .join(F.broadcast(share) if few else share, F.col("lang") == F.col("_lang"))
            .filter(F.col("_part") < F.col("_share")).select("lang", "text").distinct())


def taught_rows(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, text) of every labelled text, once a language: many copies of one text teach no more than the text.

    Only texts whose hash falls where a repeated one does are brought together; all others stay where they are. There are
    at most ``HASH_PLACES`` such places, however many texts come several times."""
    taught = _labelled(docs, text, lang).withColumn("_hash", F.xxhash64("text"))
    taught = taught.withColumn("_place", F.pmod("_hash", F.lit(HASH_PLACES)).cast("int"))
    places = materialize(taught.groupBy("lang", "_hash", "_place").count().filter("count > 1").select("_place").distinct())
    alone = taught.join(F.broadcast(places), "_place", "left_anti").select("lang", "text")
    others = taught.join(F.broadcast(places), "_place", "left_semi")
    return alone.unionByName(others.groupBy("lang", "_hash").agg(F.first("text").alias("text")).select("lang", "text"))


def _labelled(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"))


def _words_counted(taught: DataFrame) -> DataFrame:
    """(lang, item, n) of the words of all texts; a task adds them up as far as its memory is to go, then Spark does."""
    names = ["lang", "item", "n"]

    def run(batches):
        held: dict[str, Counter] = {}

        def flush():
            for label, counts in held.items():
                yield pa.RecordBatch.from_arrays([pa.array([label] * len(counts), pa.string()), pa.array(list(counts), pa.string()),
                                                  pa.array(list(counts.values()), pa.int64())], names)
            held.clear()

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                for label, body in zip(some.column(0).to_pylist(), some.column(1).to_pylist()):
                    held.setdefault(label, Counter()).update(words_of(body))
                if sum(map(len, held.values())) >= COUNTED:
                    yield from flush()
        yield from flush()

    return taught.mapInArrow(run, "lang string, item string, n long").groupBy("lang", "item").agg(F.sum("n").alias("n"))


def _grams_counted(words: DataFrame) -> DataFrame:
    """(lang, kind, item, n) of the n-grams of all words, each as often as its word comes; kind is the n-gram's length."""

    def grams(batch):
        lang, word, n = batch.columns
        marked = pc.binary_join_element_wise("<", word, ">", "")
        table = pa.table([lang, marked, n, pc.utf8_length(marked)], ["lang", "word", "n", "length"])
        out, start = [], 0
        while table.num_rows:
            for order in range(1, MAX_GRAM + 1):
                some = table.filter(pc.greater_equal(table["length"], start + order))
                out.append(pa.table([some["lang"], pc.utf8_slice_codeunits(some["word"], start, start + order), some["n"]],
                                    ["lang", "item", "n"]))
            start += 1
            table = table.filter(pc.greater(table["length"], start))
        return added(out)

    def added(tables):
        return pa.concat_tables(tables).group_by(["lang", "item"]).aggregate([("n", "sum")]).rename_columns(["lang", "item", "n"])

    def run(batches):
        held = []
        for batch in batches:
            for at in range(0, batch.num_rows, WORDS_CUT):
                held.append(grams(batch.slice(at, WORDS_CUT)))
                if sum(t.num_rows for t in held) >= GRAMS_HELD:
                    yield from added(held).to_batches()
                    held = []
        if held:
            yield from added(held).to_batches()

    found = words.select("lang", "item", "n").mapInArrow(run, "lang string, item string, n long")
    return found.groupBy("lang", F.char_length("item").alias("kind"), "item").agg(F.sum("n").alias("n"))


def _most_frequent(counts: DataFrame, limits: FitLimits) -> DataFrame:
    """The most frequent entries a language and kind, ties by their text.

    How often an entry must come is read off the numbers of entries by frequency, so only the entries kept, and those as
    frequent as the last of them, are put in order."""
    top = F.when(F.col("kind") == 0, limits.words_per_lang).otherwise(limits.grams_per_lang)
    counts = counts.filter("n > 1 or kind > 0")
    w = Window.partitionBy("lang", "kind").orderBy(F.desc("n"))
    sizes = counts.groupBy("lang", "kind", "n").agg(F.count("*").alias("_size"))
    above = F.sum("_size").over(w.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_size")
    least = materialize(sizes.withColumn("_above", above).filter(F.col("_above") < top)
                        .groupBy("lang", "kind").agg(F.min("n").alias("_least")))
    few = least.count() <= BROADCAST_LANGS
    rank = F.row_number().over(Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "item"))
    return (counts.join(F.broadcast(least) if few else least, ["lang", "kind"]).filter(F.col("n") >= F.col("_least"))
            .withColumn("_rank", rank).filter(F.col("_rank") <= top).select("lang", "kind", "item", "n"))


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", limits: FitLimits = FitLimits()) -> Model:
    """Fit on the labelled rows of ``docs`` (rows with a null lang or text teach nothing)."""
    spark = docs.sparkSession
    ship_package(spark)
    small_batches(spark)
    folder = f"{checkpoint_dir(spark).rstrip('/')}/langid-{uuid.uuid4().hex}"

    def kept_as(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    if limits.docs_per_lang is None:
        taught, rows = taught_rows(docs, text, lang), _labelled(docs, text, lang)
    else:
        taught = rows = materialize(sample_rows(docs, text, lang, limits))
    words = kept_as(_words_counted(taught), "words")
    grams = kept_as(_grams_counted(words), "grams")
    counts = words.select("lang", F.lit(0).alias("kind"), "item", "n").unionByName(grams)
    totals = counts.groupBy("lang", "kind").agg(F.sum("n").alias("total")).collect()
    langs = sorted({r["lang"] for r in totals})
    place = spark.createDataFrame(list(enumerate(langs)), "at int, lang string")
    kept = _most_frequent(counts, limits)
    # What a language adds to the score of an entry it knows, above that of a language that does not.
    gain = F.log((F.col("n") + 0.5) / 0.5).cast("float")
    entries = (kept.join(place, "lang").groupBy("kind", "item")
               .agg(F.array_sort(F.collect_list(F.struct("at", gain.alias("gain")))).alias("known"))
               .select("kind", "item", F.col("known.at").alias("at"), F.col("known.gain").alias("gain")))
    model = Model.of(entries.toArrow(), langs, {(r["lang"], r["kind"]): r["total"] for r in totals})
    model.taught = rows
    drop_folder(spark, folder)
    return model


class Model:
    """Log frequencies of words (kind 0) and n-grams (kind = order), as sparse rows.

    Entry i has kind ``kind[i]`` and is known to the languages ``at[first[i]:first[i + 1]]``, each of which adds its
    ``gain``; ``base[kind]`` holds every language's score of an entry that it does not know. ``fences`` holds a
    language's least share of known words, or nothing."""

    taught = None

    def __init__(self, langs: list[str], items: pa.Array, kind: np.ndarray, first: np.ndarray, at: np.ndarray,
                 gain: np.ndarray, base: np.ndarray, fences: dict[str, float] | None = None):
        self.langs, self.items, self.kind, self.first = langs, items, kind, first
        self.at, self.gain, self.base, self.fences = at, gain, base, fences or {}
        self.words = None
        if len(items):
            sizes = np.diff(first)
            rate = gain + base[np.repeat(kind, sizes), at]
            self.own = rate >= np.repeat(np.maximum.reduceat(rate, first[:-1]), sizes) - np.log(OWN_FACTOR)

    def __getstate__(self):
        return self.langs, self.items, self.kind, self.first, self.at, self.gain, self.base, self.fences

    def __setstate__(self, state):
        self.__init__(*state)

    def _start(self) -> None:
        """Look-ups of an entry by its text; made where texts are scored, not on the driver."""
        items, words = self.items.to_pylist(), int((self.kind == 0).sum())
        self.words = {w: i for i, w in enumerate(items[:words])}
        self.grams = {g: i for i, g in enumerate(items[words:], words)}
        self.unseen: dict[str, tuple[int, ...]] = {}

    @classmethod
    def of(cls, entries: pa.Table, langs: list[str], totals: dict[tuple[str, int], int]) -> Model:
        entries = entries.sort_by([("kind", "ascending"), ("item", "ascending")]).combine_chunks()
        kind = entries["kind"].to_numpy().astype(np.int8)
        sizes = pc.list_value_length(entries["at"]).to_numpy().astype(np.int64)
        first = np.concatenate([[0], np.cumsum(sizes)])
        at = pc.list_flatten(entries["at"]).to_numpy().astype(np.int32)
        gain = pc.list_flatten(entries["gain"]).to_numpy().astype(np.float32)
        distinct = np.bincount(kind, minlength=MAX_GRAM + 1)
        total = np.array([[totals.get((lang, k), 0) for lang in langs] for k in range(MAX_GRAM + 1)], dtype=float)
        base = np.log(0.5) - np.log(total.reshape(MAX_GRAM + 1, len(langs)) + 0.5 * (distinct[:, None] + 1))
        items = entries["item"].combine_chunks()
        return cls(langs, items.combine_chunks() if isinstance(items, pa.ChunkedArray) else items, kind, first, at, gain, base)

    def backoff(self, word: str) -> tuple[int, ...]:
        """Rows of an unseen word: the longest known n-gram from its start, then from where that ends,
        and so on; a character that no n-gram knows says nothing."""
        marked = f"<{word}>"
        known, out, i, end = self.grams, [], 0, len(marked)
        while i < end:
            for n in range(min(MAX_GRAM, end - i), 0, -1):
                row = known.get(marked[i:i + n])
                if row is not None:
                    out.append(row)
                    i += n
                    break
            else:
                i += 1
        return tuple(out)

    def score(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Per language: log likelihood of the words, and how many of them it knows as its own."""
        if self.words is None:
            self._start()
        rows, unseen, ids = self.words, self.unseen, []
        for w in words:
            found = rows.get(w)
            if found is not None:
                ids.append(found)
                continue
            parts = unseen.get(w)
            if parts is None:
                if len(unseen) >= REMEMBERED:
                    unseen.clear()
                parts = unseen[w] = self.backoff(w)
            ids += parts
        n = len(self.langs)
        if not ids:
            return np.zeros(n), np.zeros(n, dtype=np.int64)
        ids = np.array(ids, dtype=np.int64)
        kinds, sizes = self.kind[ids], self.first[ids + 1] - self.first[ids]
        ends = np.cumsum(sizes)
        spot = np.arange(ends[-1]) + np.repeat(self.first[ids] - ends + sizes, sizes)
        at = self.at[spot]
        likelihood = np.bincount(kinds, minlength=MAX_GRAM + 1) @ self.base
        likelihood += np.bincount(at, weights=self.gain[spot], minlength=n)
        return likelihood, np.bincount(at[np.repeat(kinds == 0, sizes) & self.own[spot]], minlength=n)

    def judge(self, text: str | None) -> tuple[str, float, float]:
        """Language, confidence, and the share of the words that the language knows as words; ties go to the first
        language by name. No letters: ``und``, 0, 0."""
        # Numbers that are no decimal digits are word characters too, but no letters.
        words = words_of(text) if text and any(map(str.isalpha, text)) else []
        if not words or not self.langs:
            return UNDETERMINED, 0.0, 0.0
        s, known = self.score(words)
        best = int(np.argmax(s))
        return self.langs[best], 1.0 / float(np.exp(np.maximum(s - s[best], -700.0)).sum()), int(known[best]) / len(words)

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and confidence, as ``judge`` gives them."""
        return self.judge(text)[:2]


def fit_fences(model: Model) -> Model:
    """The model with a fence per language: ``FENCE_PART`` of the share of known words that all but ``FENCE_QUANTILE``
    of the language's distinct texts reach, measured on every text that the model was fitted on. A language whose texts hold
    few repeated words, as in scripts without blanks, gets a low fence. A language without a text of its own prediction has
    none."""
    if model.taught is None:
        return model
    rows = identified(model.taught, model, prefix="_").filter(F.col("_lang_pred") == F.col("lang"))
    # Copies of a text have its share; the shares are brought together, not the texts.
    rows = rows.groupBy("lang", F.xxhash64("text")).agg(F.first("_known").alias("_known"))
    low = rows.groupBy("lang").agg(F.percentile_approx("_known", FENCE_QUANTILE, 10_000).alias("low")).collect()
    model.fences = {r["lang"]: FENCE_PART * r["low"] for r in low}
    return model


def identified(docs: DataFrame, model: Model, text: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` plus lang_pred, score, known (share of the words that the language knows) and explained (whether that
    reaches the language's fence; true where none was learnt), each with ``prefix``.

    Null, empty and letterless texts are ``und`` with score 0, known 0, not explained, and so is everything if
    nothing was learned. Other columns pass through; one with the name of an output is replaced by it
    (``prefix`` keeps it).
    """
    spark = docs.sparkSession
    ship_package(spark)
    small_batches(spark)
    # Bounded by the fit's limits a language, not by the data.
    shared = spark.sparkContext.broadcast(model)
    fields = [(prefix + "lang_pred", "string"), (prefix + "score", "double"), (prefix + "known", "double"),
              (prefix + "explained", "boolean")]
    names = [n for n, _ in fields]
    docs = cleared(docs, names)

    def run(batches):
        m = shared.value
        for batch in batches:
            got = [m.judge(x.as_py()) for x in batch.column(batch.schema.get_field_index(text))]
            explained = [g[0] != UNDETERMINED and g[2] >= m.fences.get(g[0], 0.0) for g in got]
            yield appended(batch, names, [pa.array([g[0] for g in got], pa.string()),
                                          *(pa.array([g[i] for g in got], pa.float64()) for i in (1, 2)),
                                          pa.array(explained, pa.bool_())])

    return docs.mapInArrow(run, extended(docs, fields))


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows kept from learning: crc32 of the id's text leaves 2 modulo 4. A null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def fit_open(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """Fit on the rows that are not held out (and have an id)."""
    rows = docs.filter(~held_out(doc_id) & F.col(doc_id).isNotNull()).select(text, lang)
    return fit(rows, text, lang)


def confident(score: Column, pred: Column, explained: Column, least: float = 0.5) -> Column:
    """The filter rule: a determined language that has most of the likelihood and explains the text's words."""
    return (pred != UNDETERMINED) & (score >= least) & explained
