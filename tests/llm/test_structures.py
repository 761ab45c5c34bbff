"""Merkle manifest, suffix tree scores and periodic runs against brute force, with their edge cases."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from wakeline.llm import merkle, runs, suffixtree

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_runs string, leaf string, score string"
LONG = "of the ing tion. " * 6000
TEXTS = [None, "", " ", "one", "x " * 40, "Word word WORD wörd 日本\n\n x", LONG, "tabs\tand\x0bfeeds  double   blanks ",
         "the same words again " * 30, "the same words again " * 30]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, [None, "en", "ü", "z"][i % 4], "s" if i % 3 else None, len(t or ""), "a", "b", "c")
            for i, t in enumerate(TEXTS)]
    rows += [(None, "a text without an id", None, None, None, None, None, None), rows[5], rows[5]]
    return spark.createDataFrame(rows, SCHEMA)


def _words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


# ---- Merkle manifest


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _levels(row):
    out = [row]
    while len(out[-1]) > 1:
        out.append([_h(*out[-1][k:k + 8]) for k in range(0, len(out[-1]), 8)])
    return out


def _leaf(r, text):
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return _h(*map(field, (r.doc_id, r.source, r.lang, r.n_chars, text)))


def _brute_manifest(rows):
    trees = collections.defaultdict(list)
    for r in rows:
        low = r.text and re.sub("[A-Z]", lambda m: m[0].lower(), r.text)
        fold = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 0
        trees[(r.lang is not None, (r.lang or "").encode())].append(
            (r.doc_id is not None, r.doc_id or 0, _leaf(r, r.text), _leaf(r, low if fold else r.text), r.doc_id))
    names = sorted(trees)
    built = {t: _levels([x[2] for x in sorted(trees[t])]) for t in names}
    top = _levels([built[t][-1][0] for t in names])
    out = []
    for k, t in enumerate(names):
        for i, (_, _, leaf, cur, doc_id) in enumerate(sorted(trees[t])):
            text = ""
            for levels, at in ((built[t], i), (top, k)):
                for row in levels[:-1]:
                    run = at // 8 * 8
                    left, right = row[run:at], row[at + 1:run + 8]
                    text += "".join(left + right)
                    cur = _h(*left, cur, *right)
                    at //= 8
            out.append((doc_id, leaf, built[t][-1][0], _h(text), cur, top[-1][0]))
    return out


@pytest.mark.parametrize("n", [1, 2, 8, 9, 63, 64, 65, 100, 513])
def test_positions_are_postorder(n):
    sizes, log = merkle.counts(n), []

    def visit(level, idx):
        if level:
            for child in range(idx * 8, min(idx * 8 + 8, sizes[level - 1])):
                visit(level - 1, child)
        log.append((level, idx))

    visit(len(sizes) - 1, 0)
    assert [merkle.position(lv, i, n) for lv, i in log] == list(range(len(log)))


def _manifest(spark, docs, **kw):
    m = merkle.build(merkle.document_rows(docs), **kw)
    top = merkle.root(spark, m).first()
    got = [(None if r["__order"] is None else int(r["__order"]), r.leaf, r.subroot, r.proof_sha256, r.folded_root,
            top[0] if top else None) for r in merkle.proofs(spark, m).collect()]
    return m, got


def test_manifest_matches_brute_force(spark, docs):
    _, got = _manifest(spark, docs)
    key = lambda x: tuple((v is not None, v) for v in x)
    assert sorted(got, key=key) == sorted(_brute_manifest(docs.collect()), key=key)


def test_manifest_of_several_blocks_and_many_trees(spark):
    rows = spark.range(700).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("Text "), F.col("id").cast("string")).alias("text"),
        F.when(F.col("id") % 3 > 0, F.lit("en")).otherwise((F.col("id") % 60).cast("string")).alias("lang"),
        F.lit("s").alias("source"), F.lit(5).cast("long").alias("n_chars"))
    m, got = _manifest(spark, rows, block_levels=1)
    assert sorted(got) == sorted(_brute_manifest(rows.collect()))
    log = merkle.read_log(spark, m.log)
    spans = log.groupBy("t").agg(F.count("*").alias("c"), F.min("pos").alias("a"), F.max("pos").alias("b"),
                                 F.countDistinct("pos").alias("d")).collect()
    assert all(s.a == 0 and s.b == s.c - 1 and s.c == s.d for s in spans)


def test_manifest_of_nothing(spark, docs):
    assert _manifest(spark, docs.limit(0))[1] == []


# ---- periodic runs


def _brute_runs(w):
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            a = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i - a + q >= max(12, 2 * q):
                found.setdefault((a, i - a + q), q)
            i += 1
    return sorted((a, m, q) for (a, m), q in found.items())


def _brute_row(doc_id, text, plant):
    w = _words(text)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if plant and h % 10 == 0 and w:
        g = h // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
    found = _brute_runs(w)
    gone = {i for a, m, q in found for i in range(a + q, a + m)}
    best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=(None,) * 3)
    return (len(found), *best, 1000 * best[1] // best[2] if found else None,
            hashlib.sha256("".join("%d,%d,%d\n" % r for r in found).encode()).hexdigest(),
            hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest())


def test_cover_has_every_difference():
    v = runs.COVER_MODULUS
    assert {(a - b) % v for a in runs.COVER for b in runs.COVER} == set(range(v))


def test_runs_match_brute_force_on_random_sequences():
    rnd = random.Random(5)
    for _ in range(150):
        docs = []
        for _ in range(rnd.randint(1, 6)):
            k = rnd.choice([1, 2, 3, 50])
            base = [rnd.randrange(k) for _ in range(rnd.randint(0, 80))]
            if rnd.random() < 0.5 and base:
                unit = [rnd.randrange(k) for _ in range(rnd.randint(1, 90))]
                base += unit * rnd.randint(1, 5) + base[:rnd.randint(0, 10)]
                if rnd.random() < 0.3:
                    base *= 3
            docs.append(base)
        symbols, owner = [], []
        for d, b in enumerate(docs):
            symbols += [x + 7 for x in b] + [0xE000000000000000 + d]
            owner += [d] * (len(b) + 1)
        start, end, period = runs.find_runs(np.array(symbols, dtype=np.uint64), np.array(owner), max(map(len, docs)))
        first = np.cumsum([0] + [len(b) + 1 for b in docs])
        got = collections.defaultdict(list)
        for a, b, q in zip(start.tolist(), end.tolist(), period.tolist()):
            got[owner[a]].append((a - first[owner[a]], b - a, q))
        for d, b in enumerate(docs):
            assert got[d] == _brute_runs(b)


def test_runs_of_documents(spark, docs):
    names = [n for n, _ in runs.FIELDS]
    rows = runs.periodic_runs(docs, plant=True).collect()
    assert len(rows) == docs.count()
    for r in rows:
        if r.text != LONG:
            assert tuple(r[n] for n in names) == _brute_row(r.doc_id, r.text, True)
        else:
            assert (r.n_runs, r.start, r.length) == (1, 0, 24000) or runs.planted(r.doc_id, 24000) is not None
    assert runs.periodic_runs(docs.limit(0)).collect() == []


def test_planted_runs(spark):
    rnd = random.Random(1)
    rows = [(i, " ".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(1, 120)))) for i in range(80)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for r in runs.periodic_runs(frame, plant=True).collect():
        assert tuple(r[n] for n, _ in runs.FIELDS) == _brute_row(r.doc_id, r.text, True)


# ---- suffix tree scores


def _tokens(t):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in _words(t)]


def _brute_scores(texts, train, lim):
    count, after = collections.Counter(), collections.defaultdict(collections.Counter)
    for t in train:
        s = ["<B>", *_tokens(t), "<E>"]
        for i in range(1, len(s)):
            count[s[i]] += 1
            after[(s[i - 1],)][s[i]] += 1
            if i > 1:
                after[(s[i - 2], s[i - 1])][s[i]] += 1
    size = sum(count.values()) + 0.5 * (len(count) + 1)
    root = lambda w: (count[w] + 0.5) / size

    def node(c, parent):
        total = sum(after[c].values())
        often = {w: n for w, n in after[c].items() if n >= lim.min_next}
        if total < lim.min_count or not often:
            return None
        above, other = sum(parent(w) for w in often), total - sum(often.values())
        gain = sum(n * math.log(n / total / parent(w)) for w, n in often.items())
        gain += other * math.log(other / total / (1 - above)) if other else 0
        own = {w: (n - lim.discount) / total for w, n in often.items()}
        return gain, own, (1 - sum(own.values())) / (1 - above)

    one = {c: x for c in list(after) if len(c) == 1 for x in [node(c, root)] if x}

    def shallow(v):
        x = one.get((v,))
        return lambda w: (x[1].get(w) or x[2] * root(w)) if x else root(w)

    two = {c: x for c in list(after) if len(c) == 2 and c[:1] in one and after[c[:1]][c[1]] >= lim.min_next
           for x in [node(c, shallow(c[1]))] if x and x[0] >= lim.min_gain}
    kept = {c: x for c, x in one.items() if x[0] >= lim.min_gain or any(d[1:] == c for d in two)}
    for c, x in kept.items():
        every = sum(x[1].get(w) or x[2] * root(w) for w in count) + x[2] * 0.5 / size
        assert abs(every - 1) < 1e-9
    out = []
    for t in texts:
        s = ["<B>", *_tokens(t), "<E>"]
        base = score = 0.0
        for i in range(1, len(s)):
            p = root(s[i])
            base += math.log10(p)
            for x in (kept.get((s[i - 1],)), two.get((s[i - 2], s[i - 1])) if i > 1 else None):
                if x:
                    p = x[1].get(s[i]) or x[2] * p
            score += math.log10(p)
        out.append((len(s) - 1, sum(count[w] > 0 for w in s[1:]), base, score))
    return out, len(kept), len(two)


@pytest.mark.parametrize("cached", [0, 60, 1 << 20])
def test_scores_match_brute_force(spark, cached):
    rnd = random.Random(8)
    vocabulary = [f"W{i}" for i in range(12)]
    texts = [None, "", "Unseen words ONLY"]
    for _ in range(400):
        w = [rnd.choice(vocabulary)]
        for _ in range(rnd.randint(0, 60)):
            w.append(rnd.choice(vocabulary) if rnd.random() < 0.5 else vocabulary[
                (7 * int(w[-1][1:]) + (int(w[-2][1:]) if len(w) > 1 else 0) + 1) % 12])
        texts.append(" ".join(w))
    texts += texts[5:8]
    lim = suffixtree.TreeLimits(min_count=10, min_next=2, min_gain=4.0, cached=cached)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    ids = [i for i in range(len(texts)) if zlib.crc32(str(i).encode()) % 5 != 1]
    want, shallow, deep = _brute_scores(texts, [texts[i] for i in ids], lim)
    assert shallow > 10 and deep > 10
    model = suffixtree.fit(frame.filter(~suffixtree.held_out()), lim)
    got = suffixtree.scored(frame, model, lim).orderBy("doc_id").collect()
    assert len(got) == len(texts)
    for g, w in zip(got, want):
        assert (g.n_tokens, g.n_known) == w[:2]
        assert g.base_score == pytest.approx(w[2]) and g.score == pytest.approx(w[3])
    held = [g for g in got if g.doc_id not in ids]
    assert sum(g.score for g in held) > 1.1 * sum(g.base_score for g in held)


def test_scores_edges(spark, docs):
    model = suffixtree.fit(docs.limit(0))
    rows = suffixtree.scored(docs, model).collect()
    assert len(rows) == docs.count() and all(r.n_known == 0 and r.score == r.base_score for r in rows)
    model = suffixtree.fit(docs)
    rows = suffixtree.scored(docs, model).collect()
    assert sorted(r.n_tokens for r in rows) == sorted(len(_words(r.text)) + 1 for r in docs.collect())
    assert all(r.n_known == r.n_tokens and math.isfinite(r.score) for r in rows)
    assert suffixtree.scored(docs.limit(0), model).collect() == []


def test_lookups_travel_packed_and_in_parts(spark, docs, monkeypatch):
    """Terms that are not cached are met without a row per key, however many parts the keys have."""
    lim = suffixtree.TreeLimits(min_count=5, min_next=2, min_gain=1.0, cached=0)
    rows = docs.select("doc_id", "text")
    model = suffixtree.fit(rows, lim)
    want = suffixtree.scored(rows, model, suffixtree.TreeLimits(cached=1 << 20)).collect()
    monkeypatch.setattr(suffixtree, "ASKED", 2)
    monkeypatch.setattr(suffixtree, "SUMMED", 1, raising=False)
    found = suffixtree.scored(rows, model, lim)
    assert "Generate" not in found._jdf.queryExecution().executedPlan().toString()
    order = lambda r: (r.doc_id is not None, r.doc_id, r.n_tokens)
    got = sorted(found.collect(), key=order)
    assert len(got) == len(want) and any(r.n_known for r in got)
    for g, w in zip(got, sorted(want, key=order)):
        assert g[:3] == w[:3] and g[3:] == pytest.approx(w[3:])


def test_lookup_packs_a_row_per_part():
    import pyarrow as pa

    rnd = np.random.default_rng(3)
    lists = [rnd.integers(-2**63, 2**63, n) for n in (0, 1, 5000, 0, 300_000, 300_000)]
    batches = [pa.record_batch([pa.array([7 + (k << 33), 8 + (k << 33)]), pa.array(lists[2 * k:2 * k + 2], pa.list_(pa.int64()))],
                               names=["row", "open"]) for k in range(3)]
    packed = pa.Table.from_batches(suffixtree._asking(5)(iter(batches)))
    assert packed.num_rows == 5 and packed.column("part").to_pylist() == [0, 1, 2, 3, 4]
    keys = suffixtree._joined(packed, "keys", suffixtree._of(np.int64))
    rows = suffixtree._joined(packed, "rows", suffixtree._from_steps)
    ids = [int(r) for b in batches for r in b.column("row").to_numpy()]
    want = sorted((i, int(k)) for i, some in zip(ids, lists) for k in some)
    assert sorted(zip(rows.tolist(), keys.tolist())) == want
    for p in packed.to_pylist():
        own = suffixtree._key_part(np.frombuffer(p["keys"], dtype=np.uint64), 5)
        assert set(own.tolist()) == {p["part"]}


def test_tree_tasks_get_texts_in_small_batches(spark, docs):
    from wakeline.session import BATCH_BYTES

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    try:
        spark.conf.unset(key)
        model = suffixtree.fit(docs)
        assert spark.conf.get(key) == str(BATCH_BYTES)
        spark.conf.unset(key)
        suffixtree.scored(docs, model)
        assert spark.conf.get(key) == str(BATCH_BYTES)
        spark.conf.set(key, "123456")
        suffixtree.scored(docs, model)
        assert spark.conf.get(key) == "123456"
    finally:
        spark.conf.unset(key)
