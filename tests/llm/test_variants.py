"""Near duplicates where many variants of one text are linked with it or with each other or with nothing."""

import random

from wakeline.llm import neardup
from wakeline.llm.textkernel import shingle_set


def _brute(rows):
    sets = [(i, set(shingle_set(t.encode()).tolist())) for i, t in rows]
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for k, (a, x) in enumerate(sets):
        for b, y in sets[:k]:
            if x and 100 * len(x & y) >= 75 * len(x | y):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {i: find(i) for i, _ in rows}


def _variant(rng, words, times):
    out = list(words)
    for _ in range(times):
        out[rng.randrange(len(out))] = rng.choice(("and", "of", "the", "in", f"w{rng.randrange(10**6)}"))
    return " ".join(out)


def test_unlinked_variants_of_one_text(spark):
    rng = random.Random(5)
    base = [f"b{i}" for i in range(150)]
    rows = [(i, _variant(rng, base, rng.choice((9, 10, 11, 12)))) for i in range(500)]
    # Variants of variants are linked with each other only.
    rows += [(500 + i, _variant(rng, rows[i][1].split(" "), 2)) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(docs).collect()}
    want = _brute(rows)
    assert len(set(want.values())) > 100 and got == want


def test_ids_with_several_texts_among_variants(spark):
    rng = random.Random(6)
    base = [f"b{i}" for i in range(150)]
    rows = [(i, _variant(rng, base, 11)) for i in range(60)]
    rows += [(i, _variant(rng, [f"z{k}" for k in range(120)], 9)) for i in range(60, 80)]
    rows += [(i, _variant(rng, base, 11)) for i in range(60, 80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(docs).collect()}
    want = _brute(rows)
    assert got == want


def test_places_as_bits():
    rng = random.Random(7)
    import numpy as np
    for n in (0, 1, 63, 64, 65, 400):
        x = np.unique(np.array([rng.randrange(500) for _ in range(n)], dtype=np.uint64))
        y = np.unique(np.array([rng.randrange(500) for _ in range(n // 2)], dtype=np.uint64))
        flags = neardup.places(x, y)
        assert flags.sum() == len(set(x.tolist()) & set(y.tolist()))
        words = neardup.bit_words(flags)
        assert sum(bin(int(w) & (2**64 - 1)).count("1") for w in words) == flags.sum() and len(words) == -(-len(x) // 64)


def test_small_tables_between_star_rounds_take_few_tasks(spark, monkeypatch):
    from wakeline.session import path_exists

    made, real = [], neardup.Scratch
    monkeypatch.setattr(neardup, "Scratch", lambda *a: made.append(real(*a)) or made[-1])
    held = {"spark.sql.shuffle.partitions": "48", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        spark.sparkContext.setJobGroup("stars", "")
        got = {(r.node, r.root) for r in neardup.components(edges).collect()}
        found = spark.sparkContext.statusTracker()
        stages = {s for j in found.getJobIdsForGroup("stars") for s in found.getJobInfo(j).stageIds}
        tasks = [found.getStageInfo(s).numCompletedTasks for s in stages if found.getStageInfo(s)]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {(i, 0) for i in range(41)} | {(100, 100), (101, 100)}
    # Small files are read several to a task; with a task for each partition that wrote them it took 4,043.
    assert sum(tasks) < 3000
    assert len(made) == 1 and not path_exists(spark, made[0].folder)
