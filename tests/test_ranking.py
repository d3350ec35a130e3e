"""Exact in-group positions with a hot group holding a third of the rows."""

import datetime as dt

from pyspark.sql import functions as F

from attrition.operators import activity
from attrition.operators.ranking import ordered_position


def test_positions_with_hot_group(spark):
    rows = [("hot", i % 50, i) for i in range(3000)] + [(f"c{i % 300}", i % 7, i) for i in range(6000)]
    df = spark.createDataFrame(rows, "g string, m long, id long").repartition(6)
    out = ordered_position(df, ["m", F.col("id").desc()], group=["g"], name="pos", group_size="n").collect()
    by_group = {}
    for r in out:
        by_group.setdefault(r.g, []).append(r)
    for g, rs in by_group.items():
        want = sorted(rs, key=lambda r: (r.m, -r.id))
        assert [r.pos for r in want] == list(range(len(rs))), g
        assert {r.n for r in rs} == {len(rs)}


def test_reverse_rank_hot_client(spark):
    start, ref = dt.date(2024, 1, 1), dt.date(2024, 12, 31)
    rows = [(i, "hot", dt.date(2024, 1 + i % 12, 1), i) for i in range(2400)]
    rows += [(10000 + i, f"c{i % 40}", dt.date(2024, 1 + i % 12, 1), i) for i in range(4800)]
    usage = spark.createDataFrame(rows, "usage_id long, client_id string, mois date, nb_connexions int")
    got = activity.reverse_rank(usage, start, ref).filter("client_id = 'hot'").collect()
    assert len(got) == 2400
    order = sorted(got, key=lambda r: (r.mois, r.usage_id))
    assert [r.rn for r in order] == list(range(2400))
    assert all(r.rn_max == 2399 and r.reverse_rn == 2399 - r.rn for r in got)
