"""Property tests (hypothesis) and brute-force checks on small fixtures."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shopsignal.operators.features import most_frequent
from shopsignal.plans.ranking import with_group_position

ROWS = st.lists(st.tuples(st.integers(0, 3), st.integers(0, 50)), min_size=1, max_size=60)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=ROWS, parts=st.integers(1, 6))
def test_group_position_is_sorted_enumeration(spark, rows, parts):
    # group 0 gets a third of the rows on top (hot key); values may repeat
    rows = rows + [(0, v) for _, v in rows[: len(rows) // 2]]
    df = spark.createDataFrame([(i, g, v) for i, (g, v) in enumerate(rows)], "id long, g int, v int")
    got = with_group_position(df.repartition(parts), ["g"], [F.col("v"), F.col("id")], "p").collect()
    want = {}
    for g in {g for g, _ in rows}:
        members = sorted((v, i) for i, (gg, v) in enumerate(rows) if gg == g)
        for pos, (_, i) in enumerate(members, 1):
            want[i] = pos
    assert {r["id"]: r["p"] for r in got} == want


def test_most_frequent_brute_force_with_hot_user(spark):
    # user 1 holds a third of the events; ties broken by first occurrence in (ts, event_id)
    events = []
    for i in range(90):
        user = 1 if i % 3 == 0 else 2 + i % 7
        events.append((i, (i * 37) % 11, user, ["a", "b", "c", "d"][(i * 7) % 4]))
    df = spark.createDataFrame(events, "event_id long, ts long, user_id long, kind string")
    got = {r["user_id"]: r for r in most_frequent(df, "user_id", "kind", ["ts", "event_id"]).collect()}
    for u in {e[2] for e in events}:
        seq = [k for _, _, uu, k in sorted(events, key=lambda e: (e[1], e[0])) if uu == u]
        c = Counter(seq)
        best = sorted(c, key=lambda k: (-c[k], seq.index(k)))[0]
        assert got[u]["kind_most_1"] == best and got[u]["kind_most_cnt_1"] == c[best]
        assert got[u]["kind_nunique"] == len(c) and got[u]["n_events"] == len(seq)
