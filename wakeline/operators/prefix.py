"""Parallel prefix scans over an arrival order.

A running aggregate over a global order (``... OVER (ORDER BY seq)``) has no
partition key, so Spark would move every row into one task. Instead the order
is cut into fixed-size buckets of ``seq``: each bucket is scanned in its own
task, a tiny per-bucket summary table is scanned in order, and its carry is
joined back on the bucket key. Rows per task stay bounded by the bucket size,
the only single-task step works on ``rows / bucket_rows`` summary rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BUCKET_ROWS = 100_000

_UNB = Window.unboundedPreceding


DEFAULT_LEVELS = 2


MAX_CUTS = 1024


@dataclass(frozen=True)
class Buckets:
    """Buckets for arrival numbers that are spread thin or unevenly (clock readings, packed offsets).

    ``cuts`` are quantiles of the numbers, at most ``MAX_CUTS`` however large the input. Between two cuts lie about as many rows
    as between any others, and that stretch is cut again into buckets of equal width: ``first`` holds each stretch's first bucket,
    ``width`` the width of its buckets. There are about ``rows / bucket_rows + len(cuts)`` buckets, whatever the numbers are.
    """

    cuts: tuple[int, ...]
    first: tuple[int, ...]
    width: tuple[int, ...]
    bucket_rows: int

    def of(self, seq: str):
        """Bucket of a number: a binary search among the cuts, then a division."""
        longs = lambda xs: F.expr(f"array({','.join(f'{x}L' for x in xs)})")
        number, at = F.col(seq), F.lit(0)
        if len(self.cuts) > 1:
            steps = [1 << k for k in range((len(self.cuts) - 1).bit_length())][::-1]
            # The highest cut that is not above the number; numbers below all cuts count to the first stretch.
            reached = lambda i: F.try_element_at(longs(self.cuts), i + 1) <= number
            at = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda lo, step: F.when(
                (lo + step < len(self.cuts)) & reached(lo + step), lo + step).otherwise(lo))

        def within(i):
            # Decimals, as two longs may lie further apart than a long reaches.
            far = F.floor((number.cast("decimal(20,0)") - longs(self.cuts)[i]) / longs(self.width)[i]).cast("long")
            return longs(self.first)[i] + F.greatest(F.lit(0), F.least(far, longs(self.last())[i]))

        return F.when(number.isNotNull(), F.transform(F.array(at), within)[0])

    def last(self) -> tuple[int, ...]:
        """Number of the last bucket within each stretch."""
        ends = (*self.first[1:], self.first[-1] + 1)
        return tuple(e - f - 1 for f, e in zip(self.first, ends))


def measured_buckets(df: DataFrame, seq: str, bucket_rows: int = DEFAULT_BUCKET_ROWS, cuts: int = MAX_CUTS) -> Buckets:
    """Buckets fitted to the numbers in ``df``: one pass for their count and quantiles (a mergeable sketch, one row back)."""
    share = [i / cuts for i in range(cuts + 1)]
    n, found = df.agg(F.count(seq), F.percentile_approx(seq, share, 20 * cuts)).first()
    found = sorted(set(found or [0]))
    # Equal quantiles are one cut; the last one closes the last stretch.
    cut = found[:-1] or found
    ends = found[1:] or [found[0] + 1]
    each = max(1, -(-n // (len(cut) * int(bucket_rows))))
    widths = [max(1, -(-(e - c) // each)) for c, e in zip(cut, ends)]
    counts = [min(each, -(-(e - c) // w)) for c, e, w in zip(cut, ends, widths)]
    first = [0]
    for c in counts[:-1]:
        first.append(first[-1] + c)
    return Buckets(tuple(cut), tuple(first), tuple(widths), int(bucket_rows))


def _bucket(seq: str, bucket_rows: int | Buckets):
    if isinstance(bucket_rows, Buckets):
        return bucket_rows.of(seq)
    return F.expr(f"`{seq}` div {int(bucket_rows)}")


def _combine(how: str, a, b):
    if how == "max":
        return F.greatest(a, b)
    return F.when(a.isNull() & b.isNull(), F.lit(None)).otherwise(F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)))


def scan_before(df: DataFrame, value: str, seq: str, out: str, how: str = "max",
                keys: Sequence[str] = (), bucket_rows: int | Buckets = DEFAULT_BUCKET_ROWS,
                levels: int = DEFAULT_LEVELS) -> DataFrame:
    """Add ``out`` = ``how`` (max or sum) of ``value`` over rows with a smaller ``seq`` (per ``keys``).

    NULL values never contribute; a row with nothing before it gets NULL.
    Each level cuts the order into buckets of ``bucket_rows``: rows are
    scanned within their bucket (one exchange), the bucket totals are
    scanned by the next level the same way, and the carry is joined back on
    the bucket key. Only the last level is a plain window, over
    ``rows / bucket_rows ** (levels - 1)`` summary rows. Numbers that are not dense need ``measured_buckets`` as
    ``bucket_rows``; a bucket of plain width would hold few of them, and the summary as many rows as the input.
    """
    keys = list(keys)
    agg = F.max if how == "max" else F.sum
    if levels <= 1:
        w = Window.partitionBy(*keys).orderBy(seq).rowsBetween(_UNB, -1)
        return df.withColumn(out, agg(value).over(w))
    b = f"_bkt{levels}"
    wr = Window.partitionBy(*keys, b).orderBy(seq).rowsBetween(_UNB, -1)
    inner = df.withColumn(b, _bucket(seq, bucket_rows)).withColumn(f"_in{levels}", agg(value).over(wr))
    # Totals per bucket are taken after the same exchange, so the input is shuffled once.
    summary = inner.groupBy(*keys, b).agg(agg(value).alias(f"_tot{levels}"))
    # Bucket numbers are dense, so the next levels are cut by value.
    rows = bucket_rows.bucket_rows if isinstance(bucket_rows, Buckets) else bucket_rows
    carry = scan_before(summary, f"_tot{levels}", b, f"_carry{levels}", how, keys, rows, levels - 1)
    return (inner.join(carry.drop(f"_tot{levels}"), [*keys, b], "left")
            .withColumn(out, _combine(how, F.col(f"_carry{levels}"), F.col(f"_in{levels}")))
            .drop(b, f"_carry{levels}", f"_in{levels}"))


def running_max_before(df: DataFrame, value: str, seq: str, out: str,
                       keys: Sequence[str] = (), bucket_rows: int | Buckets = DEFAULT_BUCKET_ROWS,
                       levels: int = DEFAULT_LEVELS) -> DataFrame:
    """Add ``out`` = max(``value``) over all rows with a smaller ``seq`` (per ``keys``)."""
    return scan_before(df, value, seq, out, "max", keys, bucket_rows, levels)


def global_row_number(df: DataFrame, seq: str, out: str = "rn",
                      keys: Sequence[str] = (), bucket_rows: int | Buckets = DEFAULT_BUCKET_ROWS,
                      levels: int = DEFAULT_LEVELS) -> DataFrame:
    """Add ``out`` = 1-based position of the row in ``seq`` order (per ``keys``).

    Equal to ``row_number() OVER (PARTITION BY keys ORDER BY seq)`` for unique
    ``seq``, without a single-partition exchange over the rows.
    """
    d = df.withColumn("_one", F.lit(1).cast("long"))
    d = scan_before(d, "_one", seq, "_before", "sum", keys, bucket_rows, levels)
    return d.withColumn(out, (F.coalesce(F.col("_before"), F.lit(0)) + 1).cast("long")).drop("_one", "_before")
