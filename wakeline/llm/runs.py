"""Periodic runs in sequences of words, by longest common extensions over a difference cover.

The texts of a record batch form one sequence of symbols, each text followed by a symbol found nowhere else, so no
run and no common extension leaves its text.

* Harmonic grid: a run of period p and at least two periods holds two neighbouring multiples of p whose symbols are
  equal. For every p the grid's equal neighbours are found by one comparison of two strided views, n log n comparisons
  in all.
* A pair is extended forwards and, on the reversed sequence, backwards. Its symbols are compared one by one until both
  ends stand on sampled positions at once, which a difference cover of ``COVER_MODULUS`` promises within as many steps.
  Pairs still equal there are answered from the sampled suffixes: these alone are sorted (by names of blocks of
  ``COVER_MODULUS`` symbols, doubled), and a sparse table over their common prefixes gives the number of equal blocks.
* A stretch found for several periods belongs to the smallest.

Names of blocks are checked symbol by symbol; words are told apart by 64-bit hashes.

A text is held whole by its task, with its neighbours of the same slice (about 6 MB of text), as its runs may span all
of it. Null and empty texts have no words and no runs; repeated rows give repeated results; the columns of the input
that clash with an output are replaced by it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from wakeline.llm.batchwords import BatchWords, pieces
from wakeline.llm.columns import appended, cleared, extended
from wakeline.session import ship_package

# Fixed values of the rule: shortest run, and least number of periods.
MIN_LENGTH = 12
MIN_PERIODS = 2

# A perfect difference set: every residue is the difference of two of its members.
COVER_MODULUS = 31
COVER = np.array([1, 5, 11, 24, 25, 27])

FIELDS = [("n_runs", "long"), ("start", "long"), ("length", "long"), ("period", "long"), ("exponent_milli", "long"),
          ("runs_sha256", "string"), ("collapsed_sha256", "string")]


def _shifts() -> np.ndarray:
    """For a residue of a pair's first position and of its distance: steps, one at least, until both stand on sampled
    positions."""
    v = COVER_MODULUS
    out = np.empty((v, v), dtype=np.int64)
    for distance in range(v):
        both = COVER[np.isin((COVER + distance) % v, COVER)]
        for at in range(v):
            out[at, distance] = ((both - at - 1) % v).min() + 1
    return out


_SHIFT = _shifts()
_SAMPLED = np.isin(np.arange(COVER_MODULUS), COVER)


class Extensions:
    """Longest common extensions of pairs of positions of one sequence.

    Every text of the sequence must end in a symbol of its own; ``owner`` gives each position's text.
    """

    def __init__(self, symbols: np.ndarray, owner: np.ndarray):
        v = COVER_MODULUS
        end = np.uint64(0xF000000000000000) + np.arange(2 * v, dtype=np.uint64)
        self.symbols = np.concatenate([symbols, end])
        self.owner = owner

    def _compare(self, i: np.ndarray, j: np.ndarray, most) -> np.ndarray:
        """Equal symbols from i and j on, up to ``most`` of each pair."""
        out = np.zeros(len(i), dtype=np.int64)
        live = np.arange(len(i))
        t = 0
        while len(live):
            live = live[most[live] > t]
            same = self.symbols[i[live] + t] == self.symbols[j[live] + t]
            live = live[same]
            t += 1
            out[live] = t
        return out

    def near(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Equal symbols before the first sampled positions, and whether the pair is equal up to there."""
        v = COVER_MODULUS
        shift = _SHIFT[i % v, (j - i) % v]
        found = self._compare(i, j, shift)
        return found, found == shift

    def far(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """The whole common extension of pairs whose both positions are sampled."""
        blocks = self._samples(np.unique(self.owner[i]))(i, j)
        i, j = i + blocks * COVER_MODULUS, j + blocks * COVER_MODULUS
        return blocks * COVER_MODULUS + self._compare(i, j, np.full(len(i), COVER_MODULUS))

    def _samples(self, owners: np.ndarray):
        """Sorts the sampled suffixes of these texts; returns a function from pairs to their number of equal blocks."""
        v = COVER_MODULUS
        wanted = np.zeros(int(self.owner.max()) + 1, dtype=bool)
        wanted[owners] = True
        at = np.flatnonzero(_SAMPLED[np.arange(len(self.owner)) % v] & wanted[self.owner])
        m = len(at)
        index = np.full(len(self.owner) + v, m, dtype=np.int64)
        index[at] = np.arange(m)
        ranks = [self._names(at)]
        following = index[at + v]
        jump = np.append(following, m)
        while True:
            rank = np.append(ranks[-1] + 1, 0)
            pair = rank[:m] * np.int64(m + 2) + rank[jump[:m]]
            values, new = np.unique(pair, return_inverse=True)
            if len(values) == m:
                break
            ranks.append(new)
            jump = jump[jump]
        order = np.argsort(new)
        place = np.empty(m, dtype=np.int64)
        place[order] = np.arange(m)
        common = self._adjacent(order, ranks, following, m)
        table = [common]
        while 2 << len(table) - 1 <= len(common):
            half = 1 << len(table) - 1
            table.append(np.minimum(table[-1][:-half], table[-1][half:]))

        def blocks(i: np.ndarray, j: np.ndarray) -> np.ndarray:
            a, b = place[index[i]], place[index[j]]
            low, high = np.minimum(a, b), np.maximum(a, b)
            level = (np.frexp((high - low).astype(np.float64))[1] - 1).astype(np.int64)
            out = np.empty(len(i), dtype=np.int64)
            for k in np.unique(level):
                sel = level == k
                out[sel] = np.minimum(table[k][low[sel]], table[k][high[sel] - (1 << int(k))])
            return out

        return blocks

    def _names(self, at: np.ndarray) -> np.ndarray:
        """Numbers for the blocks of symbols at sampled positions: equal exactly where the blocks are."""
        v = COVER_MODULUS
        for salt in range(1, 100):
            mult = np.uint64(0x9E3779B97F4A7C15 + 2 * salt)
            key = np.zeros(len(at), dtype=np.uint64)
            for t in range(v):
                key = (key ^ self.symbols[at + t]) * mult
                key ^= key >> np.uint64(29)
            values, first, name = np.unique(key, return_index=True, return_inverse=True)
            like = at[first[name]]
            if all((self.symbols[at + t] == self.symbols[like + t]).all() for t in range(v)):
                return name
        raise RuntimeError("block names collide")

    @staticmethod
    def _adjacent(order: np.ndarray, ranks: list[np.ndarray], following: np.ndarray, m: int) -> np.ndarray:
        """Equal blocks of neighbours in suffix order, from the doubling's ranks, longest steps first."""
        a, b = order[:-1].copy(), order[1:].copy()
        out = np.zeros(max(m - 1, 0), dtype=np.int64)
        jumps = [np.append(following, m)]
        for _ in ranks[1:]:
            jumps.append(jumps[-1][jumps[-1]])
        for k in range(len(ranks) - 1, -1, -1):
            rank = np.append(ranks[k], -1)
            same = (a < m) & (b < m) & (rank[a] == rank[b])
            out[same] += 1 << k
            a[same], b[same] = jumps[k][a[same]], jumps[k][b[same]]
        return out


def find_runs(symbols: np.ndarray, owner: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and smallest period of every run, by start and period.

    ``symbols`` holds texts of up to ``longest`` symbols, each followed by a symbol of its own (its owner the text's).
    """
    n = len(symbols)
    at, period = [], []
    for p in range(1, longest // MIN_PERIODS + 1):
        found = np.flatnonzero(symbols[0:n - p:p] == symbols[p:n:p])
        if len(found):
            at.append(found * p)
            period.append(np.full(len(found), p))
    none = np.empty(0, dtype=np.int64)
    if not at:
        return none, none, none
    i, p = np.concatenate(at), np.concatenate(period)
    inside = owner[i] == owner[i + p]
    i, p = i[inside], p[inside]
    # Equal neighbours at distance p: that many symbols of a run equal the one a period later.
    need = np.maximum(p * (MIN_PERIODS - 1), MIN_LENGTH - p)
    # Reversed, a text ends in the symbol before it, and the first one in a new symbol.
    turned = np.append(symbols[-2::-1], np.uint64(0xF800000000000000))
    forward, backward = Extensions(symbols, owner), Extensions(turned, owner[::-1])
    ahead, open_ahead = forward.near(i, i + p)
    back, open_back = backward.near(n - 1 - i - p, n - 1 - i)
    live = ((ahead + back >= need) | open_ahead | open_back) & ((back < p) | open_back)
    i, p, need, ahead, back = i[live], p[live], need[live], ahead[live], back[live]
    open_ahead, open_back = open_ahead[live], open_back[live]
    sel = np.flatnonzero(open_back)
    if len(sel):
        back[sel] += backward.far(n - 1 - i[sel] - p[sel] + back[sel], n - 1 - i[sel] + back[sel])
    # The first grid point inside a run is less than a period from its start; later ones find it again.
    live = (back < p) & ((ahead + back >= need) | open_ahead)
    i, p, need, ahead, back, open_ahead = i[live], p[live], need[live], ahead[live], back[live], open_ahead[live]
    sel = np.flatnonzero(open_ahead)
    if len(sel):
        ahead[sel] += forward.far(i[sel] + ahead[sel], i[sel] + p[sel] + ahead[sel])
    live = ahead + back >= need
    start, end, p = (i - back)[live], (i + p + ahead)[live], p[live]
    order = np.lexsort((p, end, start))
    start, end, p = start[order], end[order], p[order]
    first = np.ones(len(start), dtype=bool)
    first[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, p = start[first], end[first], p[first]
    order = np.lexsort((p, start))
    return start[order], end[order], p[order]


def planted(doc_id, n: int) -> np.ndarray | None:
    """Which original word stands at each place where the document's number asks for a planted period; else None."""
    if doc_id is None or n == 0:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % p
    return at


def _results(batch: pa.RecordBatch, plant: bool) -> list[pa.Array]:
    words = BatchWords(batch.column("text"), fold_case=False)
    docs = batch.num_rows
    ids = batch.column("doc_id").to_pylist() if plant else [None] * docs
    source = np.arange(len(words.hashes))
    moved = set()
    for d in range(docs):
        first = words.first[d]
        to = planted(ids[d], int(words.counts[d]))
        if to is not None:
            moved.add(d)
            source[first:first + len(to)] = first + to
    owner_of_word = np.repeat(np.arange(docs), words.counts)
    place = np.arange(len(source)) + owner_of_word
    n = len(source) + docs
    symbols = np.empty(n, dtype=np.uint64)
    # Each text's own end symbol; a word's hash is one of these with a chance of about 2**-64.
    stops = words.first[1:] + np.arange(docs)
    symbols[stops] = np.uint64(0xE000000000000000) + np.arange(docs, dtype=np.uint64)
    symbols[place] = words.hashes[source]
    owner = np.repeat(np.arange(docs), words.counts + 1)
    start, end, period = find_runs(symbols, owner, int(words.counts.max()) if docs else 0)

    change = np.zeros(n + 1, dtype=np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, end, -1)
    dropped = np.cumsum(change[:-1]) > 0
    of = owner[start]
    base = words.first[:-1] + np.arange(docs)
    bounds = np.searchsorted(of, np.arange(docs + 1))
    out: list[list] = [[] for _ in FIELDS]
    for d in range(docs):
        a, b = bounds[d], bounds[d + 1]
        kept = words.text(d).split()
        if d in moved or b > a:
            left = np.flatnonzero(~dropped[base[d]:base[d] + words.counts[d]]) + words.first[d]
            kept = [kept[k] for k in (source[left] - words.first[d]).tolist()]
        runs = list(zip((start[a:b] - base[d]).tolist(), (end[a:b] - start[a:b]).tolist(), period[a:b].tolist()))
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
        text = "".join("%d,%d,%d\n" % r for r in runs)
        values = (len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha256(text.encode()).hexdigest(),
                  sha256(b" ".join(kept)).hexdigest())
        for column, value in zip(out, values):
            column.append(value)
    return [pa.array(c, pa.string() if t == "string" else pa.int64()) for c, (_, t) in zip(out, FIELDS)]


def periodic_runs(docs: DataFrame, plant: bool = False) -> DataFrame:
    """The rows with their texts' runs: number, the longest one (ties: first start, then period), a digest of all and one
    of the text without the repetitions. ``plant`` first writes periods into every tenth document, by its doc_id."""
    docs = cleared(docs, [name for name, _ in FIELDS])
    ship_package(docs.sparkSession)
    names = [name for name, _ in FIELDS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                yield appended(piece, names, _results(piece, plant))

    return docs.mapInArrow(run, extended(docs, FIELDS))
