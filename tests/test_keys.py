"""Several unique keys: against inserting row after row, and how often rows are moved for it."""

import random

from pyspark.sql import functions as F

from millrace.operators import merge


def inserted(rows):
    taken, out = set(), []
    for i, *keys in rows:
        held = [(k, v) for k, v in enumerate(keys) if v is not None]
        if not any(h in taken for h in held):
            taken.update(held)
            out.append(i)
    return out


def test_three_keys_are_looked_up_at_once(spark, monkeypatch):
    draw = random.Random(4)
    rows = [(i, *(draw.choice([None, draw.randrange(60)]) for _ in range(3))) for i in range(200)]
    df = spark.createDataFrame(rows, "i long, a long, b long, c long").repartition(3)
    asked = []
    plain = merge.left_lookup
    monkeypatch.setattr(merge, "left_lookup", lambda facts, lookup, on, *a, **k: asked.append(list(on)) or plain(facts, lookup, on, *a, **k))
    got = merge.insert_ignoring(df, None, [["a"], ["b"], ["c"]], [F.col("i")])
    assert sorted(r.i for r in got.collect()) == inserted(rows)
    assert [on for on in asked if not on[0].startswith("_lead")] == [["_held"]]
