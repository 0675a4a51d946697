"""Behaviour statistics over a user's time-ordered history (A14-A21, PF8).

The reference folds each user's log into space-joined path strings and runs
a Python callback per row and statistic. Here every statistic is an
aggregate over the log itself, and callers name the groups they need:

* ``base``: event count, time max/min/std and action counts are one plain
  aggregate per user -- no sort, no generator;
* ``nunique``: the token columns, the time stamp and the (seller, item)
  favourite key are stacked into ``(user, column, token)`` rows and counted in
  two levels, so neither a hot user nor a hot token lands whole in one task;
* ``most``: the same two levels for the n-th most frequent token. Only this
  group needs event order: the log is range-sorted once and each event gets a
  long id monotone in event order (first occurrence = ``min(id)``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopsignal.sources.fixtures import ADD_CART, ADD_FAV, BUY, CLICK, EVENT_ORDER, TOKEN_COLUMNS

MISSING = -1  # value of every statistic for a user without history (N2)
#: Events of a task when whole histories are dealt to tasks; a log with a longer history is range-sorted.
TASK_EVENTS = 250_000


def user_base_stats(log: DataFrame, user: str = "user_id", ts: str = "time_stamp",
                    action: str = "action_type", compat: bool = False) -> DataFrame:
    """Count, max/min/population-std of time, action counts in one aggregate.

    Times may be fractional; the std merges central moments, so large stamps
    lose no digits. ``compat=True`` reproduces the reference's conditional
    count, which returns the history length whatever the action (defect D1).
    """
    n = F.count(F.lit(1))
    x = F.col(ts).cast("double")

    def action_count(code: str) -> Column:
        return n if compat else F.count_if(F.col(action) == code)

    return log.groupBy(user).agg(
        n.alias("user_cnt"),
        F.max(x).alias("time_stamp_max"), F.min(x).alias("time_stamp_min"),
        F.stddev_pop(x).alias("time_stamp_std"),
        action_count(CLICK).alias("user_cnt_0"),
        action_count(ADD_CART).alias("cart_cnt"),
        action_count(BUY).alias("buy_cnt"),
        F.count_if(F.col(action) == ADD_FAV).alias("_fav_events"),
    )


def task_count(log: DataFrame, user: str = "user_id") -> int | None:
    """Tasks for ``log`` by whole histories, ``TASK_EVENTS`` events each; None if one history alone has more."""
    r = log.groupBy(user).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("longest"), F.sum("n").alias("n")).first()
    return None if (r["longest"] or 0) > TASK_EVENTS else max(1, -(-(r["n"] or 0) // TASK_EVENTS))


def with_event_ids(log: DataFrame, user: str = "user_id", tasks: int | None = None) -> DataFrame:
    """Stamp each event with a long that increases in (user, event order).

    With ``tasks`` whole histories are dealt to that many tasks, so all that is then grouped by the
    user stays where it is: the log moves once. Without it:

    A range-partitioned sort spreads even a user holding a third of the log
    over many tasks; ``monotonically_increasing_id`` after the sort is then
    monotone in event order within every user. The first occurrence of a
    token becomes ``min(_eid)``: a fixed-width value, so both aggregation
    levels stay hash aggregates (a struct minimum would force a sort-based
    aggregate over the exploded rows).
    """
    order = [F.col(user)] + [F.col(c) for c in EVENT_ORDER if c in log.columns]
    if tasks:
        return log.repartition(tasks, user).sortWithinPartitions(*order).withColumn("_eid", F.monotonically_increasing_id())
    return log.orderBy(*order).withColumn("_eid", F.monotonically_increasing_id())


def _long_tokens(log: DataFrame, user: str, tokens: dict[str, Column], ordered: bool, tasks: int | None = None) -> DataFrame:
    """Stack token columns into (user, col, token[, _eid]) rows, nulls skipped."""
    items = [F.struct(F.lit(name).alias("col"), c.cast("string").alias("token")) for name, c in tokens.items()]
    eid = ["_eid"] if ordered else []
    src = with_event_ids(log, user, tasks) if ordered else log
    return (src.select(F.col(user), *eid, F.explode(F.array(*items)).alias("t"))
            .select(user, F.col("t.col").alias("col"), F.col("t.token").alias("token"), *eid)
            .where(F.col("token").isNotNull()))


def token_counts(log: DataFrame, user: str, tokens: dict[str, Column], ordered: bool = True, tasks: int | None = None) -> DataFrame:
    """Level 1: (user, col, token) -> cnt and, if ``ordered``, first occurrence (min event id)."""
    first = [F.min("_eid").alias("first")] if ordered else []
    return (_long_tokens(log, user, tokens, ordered, tasks).groupBy(user, "col", "token")
            .agg(F.count(F.lit(1)).alias("cnt"), *first))


def _favourite() -> Column:
    """The (seller, item) key of a favourite event, else null."""
    return F.when(F.col("action_type") == ADD_FAV,
                  F.concat_ws("_", F.col("seller_id").cast("string"), F.col("item_id").cast("string")))


def token_stats(log: DataFrame, user: str = "user_id", n: int = 1, token_cols: dict[str, str] | None = None,
                nunique: bool = True, most: bool = True, tasks: int | None = None) -> DataFrame:
    """A15, A18, A19, A21 per user from one pass over the log.

    ``<name>_nunique`` of every token column, of ``time_stamp`` and of the
    favourite (seller, item) keys; ``<name>_most_<n>`` (string token) and
    ``<name>_most_cnt_<n>``. Ties go to the token seen first in event order (N5).
    """
    token_cols = TOKEN_COLUMNS if token_cols is None else token_cols
    tokens = {name: F.col(c) for name, c in token_cols.items()}
    if nunique:
        tokens |= {"time_stamp": F.col("time_stamp"), "fav_seller_item": _favourite()}
    lvl1 = token_counts(log, user, tokens, ordered=most, tasks=tasks)
    col, tok, cnt = F.col("col"), F.col("token"), F.col("cnt")
    if not most:
        return lvl1.groupBy(user).agg(*[F.count_if(col == name).alias(f"{name}_nunique") for name in tokens])
    aggs = [F.count_if(col == name).alias(f"{name}_nunique") for name in tokens] if nunique else []
    if n == 1:
        # the best token is a min_by aggregate: higher count first, then earlier first occurrence
        pref = F.struct((-cnt).alias("negcnt"), F.col("first").alias("first"))
        for name in token_cols:
            sel = col == name
            aggs.append(F.min_by(F.when(sel, tok), F.when(sel, pref)).alias(f"{name}_most_1"))
            aggs.append(F.min_by(F.when(sel, cnt), F.when(sel, pref)).alias(f"{name}_most_cnt_1"))
        return lvl1.groupBy(user).agg(*aggs)
    # Spark keeps at most n rows per (user, column) on both sides of the shuffle (window group limit)
    w = Window.partitionBy(user, "col").orderBy(cnt.desc(), F.col("first").asc())
    nth = (lvl1.where(col.isin(list(token_cols))).withColumn("rn", F.row_number().over(w)).where(F.col("rn") == n)
           .groupBy(user).agg(*[F.max(F.when(col == name, F.col(c))).alias(f"{name}_{lab}_{n}")
                                for name in token_cols for c, lab in (("token", "most"), ("cnt", "most_cnt"))]))
    return lvl1.groupBy(user).agg(*aggs).join(nth, user, "left") if nunique else nth


def with_missing_defaults(df: DataFrame, n: int = 1, token_cols=None) -> DataFrame:
    """-1 for every statistic of a user without history; range after defaults."""
    token_cols = TOKEN_COLUMNS if token_cols is None else token_cols
    repl = {}
    for c in df.columns:
        if c.endswith("_nunique") or c.endswith(f"_most_cnt_{n}") or c in (
                "user_cnt", "user_cnt_0", "cart_cnt", "buy_cnt"):
            repl[c] = F.coalesce(F.col(c).cast("long"), F.lit(MISSING).cast("long"))
        elif c in ("time_stamp_std", "time_stamp_max", "time_stamp_min"):
            repl[c] = F.coalesce(F.col(c), F.lit(float(MISSING)))
        elif c.endswith(f"_most_{n}") and c[: -len(f"_most_{n}")] in token_cols:
            repl[c] = F.coalesce(F.col(c), F.lit(str(MISSING)))
    out = df.withColumns(repl)
    if "time_stamp_max" in out.columns and "time_stamp_min" in out.columns:
        out = out.withColumn("time_stamp_range", F.col("time_stamp_max") - F.col("time_stamp_min"))
    return out


GROUPS = ("base", "nunique", "most")


def user_stats(log: DataFrame, n: int = 1, compat: bool = False, groups=GROUPS, tasks: int | None = None) -> DataFrame:
    """Per-user statistics, one row per user with history; only the named ``groups`` are computed.

    ``tasks`` (see ``task_count``): deal whole histories to so many tasks.
    """
    parts = []
    if "base" in groups or compat:
        parts.append(user_base_stats(log, compat=compat))
    if "nunique" in groups or "most" in groups:
        parts.append(token_stats(log, n=n, nunique="nunique" in groups, most="most" in groups, tasks=tasks))
    out = parts[0]
    for p in parts[1:]:
        # a user whose tokens are all null has base statistics only
        out = out.join(p, "user_id", "left")
        out = out.fillna(0, subset=[c for c in p.columns if c.endswith("_nunique")])
    if compat and "nunique" in groups:
        # The reference also counts the empty key once when some event is not a favourite
        out = out.withColumn("fav_seller_item_nunique", F.col("fav_seller_item_nunique")
                             + F.when(F.col("user_cnt") > F.col("_fav_events"), 1).otherwise(0))
    return out.drop("_fav_events")


def user_features(pairs: DataFrame, info: DataFrame, log: DataFrame, n: int = 1,
                  compat: bool = False, tasks: int | None = None) -> DataFrame:
    """Feature table: pairs + profile (J1) + user statistics (N11: joined on user only)."""
    stats = user_stats(log, n=n, compat=compat, tasks=tasks)
    out = pairs.join(info, "user_id", "left").join(stats, "user_id", "left")
    return with_missing_defaults(out, n=n)


def most_frequent(log: DataFrame, user: str, col: str, order: list[str], n: int = 1) -> DataFrame:
    """A15/A18/A19 for any log: per user the n-th most frequent value of ``col``, its count,
    the distinct count and the event count; ties go to the value seen first in ``order``."""
    ordered = log.orderBy(F.col(user), *[F.col(c) for c in order]).withColumn("_eid", F.monotonically_increasing_id())
    lvl1 = (ordered.where(F.col(col).isNotNull())
            .groupBy(user, F.col(col).cast("string").alias("token"))
            .agg(F.count(F.lit(1)).alias("cnt"), F.min("_eid").alias("first")))
    base = lvl1.groupBy(user).agg(F.count(F.lit(1)).alias(f"{col}_nunique"),
                                  F.sum("cnt").cast("long").alias("n_events"))
    if n == 1:
        pref = F.struct((-F.col("cnt")).alias("negcnt"), F.col("first"))
        top = lvl1.groupBy(user).agg(F.min_by("token", pref).alias(f"{col}_most_1"),
                                     F.min_by("cnt", pref).alias(f"{col}_most_cnt_1"))
    else:
        w = Window.partitionBy(user).orderBy(F.col("cnt").desc(), F.col("first").asc())
        top = (lvl1.withColumn("rn", F.row_number().over(w)).where(F.col("rn") == n)
               .select(user, F.col("token").alias(f"{col}_most_{n}"), F.col("cnt").alias(f"{col}_most_cnt_{n}")))
    return base.join(top, user, "left")


def distinct_sketches(log: DataFrame, columns: dict[str, str], user: str = "user_id", day: str = "time_stamp",
                      lg_k: int = 12) -> DataFrame:
    """A15, mergeable: one HyperLogLog sketch per (user, day, column), to be written once.

    Sketches are at most 2 ** lg_k bytes and a few bytes per value where there are few; null ids are
    not counted. The relative standard error is about 1.04 / sqrt(2 ** lg_k) (1.6 % by default), and
    small counts are exact.
    """
    tokens = F.explode(F.array(*[F.struct(F.lit(n).alias("column"), F.col(c).cast("string").alias("token")) for n, c in columns.items()]))
    long = log.select(user, day, tokens.alias("t")).select(user, day, "t.*").where("token is not null")
    return long.groupBy(user, day, "column").agg(F.hll_sketch_agg("token", lg_k).alias("sketch"))


def distinct_in_window(sketches: DataFrame, first: int, last: int, user: str = "user_id", day: str = "time_stamp") -> DataFrame:
    """(user, column, nunique) over the days ``first`` to ``last``, from the days' sketches alone."""
    part = sketches.where(F.col(day).between(first, last))
    return part.groupBy(user, "column").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("nunique"))
