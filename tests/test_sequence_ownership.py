from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions.sequence import sequence_within
from tidemark.operators import ownership


def test_sequence_within_matches_row_number_with_a_hot_key(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else f"k{rnd.randint(0, 40)}"  # one key holds a third of the rows
        rows.append((key, rnd.randint(0, 30), i, float(i)))
    df = spark.createDataFrame(rows, "k string, day int, o int, v double")
    got = sequence_within(df, ["k"], "day", ["o"], next_of="v").select("k", "o", "seq", "next_v")
    w = Window.partitionBy("k").orderBy("day", "o")
    want = df.select("k", "o", F.row_number().over(w).alias("seq"), F.lead("v").over(w).alias("next_v"))
    assert sorted(got.collect()) == sorted(want.collect())


def test_deletions_and_reappearances(spark):
    t = lambda d: dt.datetime(2024, 1, d)
    scd2 = spark.createDataFrame(
        [
            ("a", 1, "T", t(1), t(2), "s1"),  # changed on day 2 (no gap)
            ("a", 1, "T", t(2), t(3), "s2"),  # deleted on day 3
            ("a", 1, "T", t(5), None, "s3"),  # back on day 5
            ("a", 2, "T", t(1), t(4), "s4"),  # deleted for good
        ],
        "account string, entity_id int, type_key string, valid_from timestamp_ntz, valid_to timestamp_ntz, scd_id string",
    )
    dels = sorted((r.entity_id, r.deleted_ts) for r in ownership.deletions(scd2).collect())
    assert dels == [(1, t(3)), (2, t(4))]
    back = [(r.entity_id, r.absent_from, r.event_ts) for r in ownership.reappearances(scd2).collect()]
    assert back == [(1, t(3), t(5))]
    fs = spark.createDataFrame([("a", "T", t(1))], "account string, type_key string, first_seen_ts timestamp_ntz")
    as_of = spark.createDataFrame([(t(11),)], "as_of_ts timestamp_ntz")
    (f,) = ownership.first_seen_features(fs, scd2, as_of).collect()
    assert (f.days_since_first_seen, f.days_to_first_delete, f.delete_count) == (10, 2, 2)
    (b,) = ownership.collection_breadth(fs).collect()
    assert (b.new_types, b.breadth) == (1, 1)


def test_register_views(spark):
    from tidemark.plans.catalog import silver

    s = silver(spark, "/root/testdata/sf0.001")
    names = s.register_views(prefix="t_")
    assert "t_gold" in names
    assert spark.sql("SELECT COUNT(*) AS n FROM t_quarantine").first().n > 0
