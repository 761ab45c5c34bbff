"""Quality rules with adaptive thresholds.

Every text is measured once. The measures feed KLL quantile sketches, one set per (lang, source); the
sketches are mergeable, so they are built map-side, merged per language and over everything, and a hot
source costs no more than any other. A group's fences come from its own quantiles: a document is
an outlier if a measure lies beyond ``quartile + reach * max(spread, least)`` of its group. Groups
with fewer than ``min_docs`` documents use their language's merged sketch, and languages below that
the sketch of the whole table. The fences are joined back to the documents, which are then filtered.

The fences are written once (checkpoint), so every task, retried or not, sees the same ones.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.llm.columns import appended, cleared, extended
from wakeline.llm.textkernel import repeated_words, word_bounds
from wakeline.session import materialize, ship_package

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")

# Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

# Fences are sent to every task up to this size; a larger table of them is joined by a shuffle.
BROADCAST_BYTES = 8 << 20
FENCE_ROW_BYTES = 256


@dataclass(frozen=True)
class Fence:
    """One adaptive rule: reject a document whose ``value`` lies ``reach`` spreads beyond its group.

    ``least`` is the smallest spread used, so that a group without variation does not reject every
    document that differs a little.
    """

    name: str
    value: str
    reach: float
    least: float
    low: bool = False


# Long documents only weigh in where their measure means something: ratios are per word or per line.
FENCES = (
    Fence("symbols", "n_symbols / n_words", 3.0, 0.05),
    Fence("dup_lines", "n_dup_lines / n_lines", 3.0, 0.10),
    Fence("long_words", "word_chars / n_words", 6.0, 0.75),
    Fence("short_words", "word_chars / n_words", 6.0, 0.50, low=True),
)


def measure_text(text: str | None) -> tuple[int, int, int, int, int, int]:
    """The measures of one text, in the order of ``MEASURES``; all zero for null."""
    if not text:
        return 0, 0, 0, 0, 0, 0
    data = text.encode()
    starts, ends = word_bounds(data)
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return (len(starts), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(data, starts, ends), len(lines))


def measured(docs: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` plus the measures as long columns named ``prefix + measure``."""
    ship_package(docs.sparkSession)
    names = [prefix + m for m in MEASURES]
    docs = cleared(docs, names)
    schema = extended(docs, [(n, "long") for n in names])

    def run(batches):
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text))
            rows = [measure_text(x.as_py()) for x in texts]
            extra = [pa.array([r[k] for r in rows], pa.int64()) for k in range(len(names))]
            yield appended(batch, names, extra)

    return docs.mapInArrow(run, schema)


def base_failed(prefix: str = ""):
    """The fixed base rule: too few words, or too many of them in repeated windows."""
    words, repeats = F.col(prefix + "n_words"), F.col(prefix + "n_repeat_words")
    return (words < MIN_WORDS) | (repeats * 100 > words * MAX_REPEAT_PERCENT)


def _value(fence: Fence, prefix: str):
    above, below = (F.col(prefix + x.strip()) for x in fence.value.split("/"))
    return F.try_divide(above, below)


def thresholds(measures: DataFrame, keys: tuple[str, str], prefix: str = "", min_docs: int = 200,
               k: int = 800) -> DataFrame:
    """One row per (lang, source) found, with a ``fence_<name>`` column for each rule.

    Documents that fail the base rule do not shape the fences. ``k`` sets the sketches' accuracy
    (normalised rank error about 0.3 % at 800). Null languages and sources form groups of their own.
    """
    lang, source = keys
    values = {f.value: f"_s{i}" for i, f in enumerate(FENCES)}
    rows = measures.select(lang, source, F.when(~base_failed(prefix), 1).alias("_ok"),
                           *[F.when(~base_failed(prefix), _value(f, prefix)).alias(values[f.value])
                             for f in {f.value: f for f in FENCES}.values()])
    cols = sorted(set(values.values()))
    group = rows.groupBy(lang, source).agg(
        F.count("_ok").alias("_n"), *[F.kll_sketch_agg_double(c, F.lit(k)).alias(c) for c in cols])
    group = materialize(group)
    by_lang = group.groupBy(F.col(lang).alias("_lang")).agg(
        F.sum("_n").alias("_n_lang"), *[F.kll_merge_agg_double(c, F.lit(k)).alias(c + "_lang") for c in cols])
    overall = group.agg(F.sum("_n").alias("_n_all"),
                        *[F.kll_merge_agg_double(c, F.lit(k)).alias(c + "_all") for c in cols])
    # overall is a single row, so this join adds columns, not pairs.
    joined = group.join(by_lang, F.col(lang).eqNullSafe(F.col("_lang"))).crossJoin(F.broadcast(overall))
    out = [F.col(lang), F.col(source)]
    for f in FENCES:
        c = values[f.value]
        sketch = (F.when(F.col("_n") >= min_docs, F.col(c))
                  .when(F.col("_n_lang") >= min_docs, F.col(c + "_lang")).otherwise(F.col(c + "_all")))
        size = F.kll_sketch_get_n_double(sketch)
        q = [F.when(size > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(p))) for p in (0.25, 0.5, 0.75)]
        spread = F.greatest((q[1] - q[0]) if f.low else (q[2] - q[1]), F.lit(f.least))
        fence = q[0] - f.reach * spread if f.low else q[2] + f.reach * spread
        out.append(fence.alias("fence_" + f.name))
    return materialize(joined.select(*out))


def judged(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
           prefix: str = "", min_docs: int = 200) -> DataFrame:
    """``docs`` plus the measures, ``base_failed`` and ``kept`` (each with ``prefix``).

    * null or empty text: all measures 0, ``base_failed`` (fewer than ten words), not kept;
    * null lang or source: a group of its own; repeated rows are judged alike, each on its own;
    * an empty table gives an empty result; other columns pass through. An input column with the
      name of an output is replaced by it; give a ``prefix`` to keep it.
    """
    docs = cleared(docs, [prefix + n for n in (*MEASURES, "base_failed", "kept")])
    slim = measured(docs.select(*dict.fromkeys([text, lang, source])), text, prefix).drop(*{text} - {lang, source})
    fences = thresholds(slim, (lang, source), prefix, min_docs)
    fences = fences.withColumnsRenamed({lang: "_fence_lang", source: "_fence_source"})
    # One row per group. Unless the groups are very many, the documents need not move to meet their fences.
    keys = F.sum(sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0))
                      for c in ("_fence_lang", "_fence_source")), F.lit(FENCE_ROW_BYTES)).cast("long"))
    if (fences.agg(keys).first()[0] or 0) <= BROADCAST_BYTES:
        fences = F.broadcast(fences)
    rows = measured(docs, text, prefix).join(
        fences, F.col(lang).eqNullSafe(F.col("_fence_lang")) & F.col(source).eqNullSafe(F.col("_fence_source")), "left")
    outlier = F.lit(False)
    for f in FENCES:
        v, edge = _value(f, prefix), F.col("fence_" + f.name)
        outlier = outlier | F.coalesce(v < edge if f.low else v > edge, F.lit(False))
    failed = base_failed(prefix)
    return (rows.withColumn(prefix + "base_failed", failed)
            .withColumn(prefix + "kept", ~failed & ~outlier)
            .drop("_fence_lang", "_fence_source", *["fence_" + f.name for f in FENCES]))
