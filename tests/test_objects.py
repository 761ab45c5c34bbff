"""Archive objects, their commit and their reader."""

import json
import os
import re

import pytest
from pyspark.sql import functions as F

from wakeline.sources.objects import read_objects, write_objects
from wakeline.streaming import pipeline as P

NAME = re.compile(r"^\d{8}_\d{6}_\d{6}\.json$")


def _files(root):
    found = {}
    for folder, _, names in os.walk(root):
        for n in names:
            if not n.startswith("."):
                with open(os.path.join(folder, n)) as f:
                    found[os.path.relpath(os.path.join(folder, n), root)] = f.read()
    return found


def _raw(spark, a, b):
    return spark.createDataFrame([(s, '{"id": 1, "x": 1.0, "y": 2.0, "timestamp": %d.0}' % s) for s in range(a, b)],
                                 "seq long, value string")


def test_archive_objects_and_replay(spark, scratch):
    out = os.path.join(scratch, "store")
    writer = P.ArchiveWriter(os.path.join(scratch, "state"), n=4, objects=out, clock=lambda b: 1_700_000_000.0)
    writer(_raw(spark, 0, 10), 0)
    first = _files(out)
    assert len(first) == 2 and all(n.startswith("raw_data/") and NAME.match(n.split("/")[1]) for n in first)
    assert [[int(e["timestamp"]) for e in json.loads(first[n])] for n in sorted(first)] == [[0, 1, 2, 3], [4, 5, 6, 7]]
    writer.clock = lambda b: 1_800_000_000.0
    writer(_raw(spark, 0, 10), 0)  # replayed later
    assert _files(out) == first
    writer.flush(spark)
    tail = read_objects(spark, out + P.TAIL)
    assert sorted(int(r.timestamp) for r in tail.collect()) == [8, 9]
    writer.clock = lambda b: 1_600_000_000.0  # the clock went back: names still ascend
    writer(_raw(spark, 10, 15), 1)
    assert not os.path.exists(out + P.TAIL)
    back = read_objects(spark, out).orderBy("object", "pos").collect()
    assert [int(r.timestamp) for r in back] == list(range(12))
    assert len({r.object for r in back}) == 3 and [r.pos for r in back] == [0, 1, 2, 3] * 3


def test_failed_job_publishes_nothing(spark, scratch):
    out = os.path.join(scratch, "store")
    bad = spark.range(0, 8, 1, 4).select(
        F.concat(F.lit("raw_data/"), F.col("id").cast("string"), F.lit(".json")).alias("name"),
        F.when(F.col("id") == 7, F.raise_error(F.lit("no"))).otherwise(F.lit("[]")).alias("value"))
    with pytest.raises(Exception, match="no"):
        write_objects(bad, out)
    # A task still running at the abort may leave staged files, which no reader sees.
    assert [n for n in _files(out) if not n.startswith("_staging-")] == []
    assert not os.path.exists(out) or read_objects(spark, out).count() == 0


def test_foreign_objects(spark, scratch):
    os.makedirs(os.path.join(scratch, "raw_data"))
    event = {"id": 3, "x": 1.5, "y": 2.5, "timestamp": 7.0}
    for name, text in (("a.json", json.dumps([event, json.dumps(event)])), ("b.json", "[]"), ("c.json", "{broken"), ("d.txt", "[1]")):
        with open(os.path.join(scratch, "raw_data", name), "w") as f:
            f.write(text)
    rows = read_objects(spark, scratch).orderBy("object", "pos").collect()
    assert [(r.object, r.pos, r.id, r.timestamp) for r in rows] == [
        ("a.json", 0, 3, 7.0), ("a.json", 1, 3, 7.0), ("b.json", None, None, None), ("c.json", None, None, None)]
