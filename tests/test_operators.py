import random
import re
from collections import Counter
from datetime import date, datetime
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from hireflow.operators import profile, quality as q
from hireflow.operators.history import StoredHistory, scd2
from hireflow.operators.impacted import distinct_keys, history_of, orphans
from hireflow.operators.keyed_table import KeyedTable
from hireflow.operators.latest import newest_snapshot
from hireflow.operators.skew import hot_keys, number_across_ranges, number_rows
from hireflow.session import folder_names, scratch_path
from tests.conftest import rows

T0, T1 = datetime(2024, 1, 1), datetime(2024, 1, 2)


def test_newest_snapshot_breaks_ties_by_hash(spark):
    data = [("a", T0, "z", 1), ("a", T1, "h1", 2), ("a", T1, "h2", 3), (None, T0, "n", 4),
            (None, T1, "n", 5)]
    schema = "k string, _ingestion_ts timestamp_ntz, _record_hash string, v int"
    for order in (data, data[::-1]):
        got = newest_snapshot(spark.createDataFrame(order, schema), "k")
        assert rows(got.select("k", "v")) == [("a", 3), (None, 5)]


def test_newest_snapshot_keeps_one_row_per_task_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 k", "timestamp_ntz'2024-01-01' _ingestion_ts",
                                     "cast(id as string) _record_hash")
    plan = newest_snapshot(df, "k")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def numbered(df, hot):
    order = [F.col("t").asc_nulls_last(), F.col("i").asc()]
    return rows(number_rows(df, "k", order, "n", hot).select("k", "t", "i", "n"))


def test_hot_keys_are_numbered_like_others(spark):
    df = spark.range(2000).selectExpr(
        "case when id % 3 = 0 then 'hot' when id % 7 = 0 then null else cast(id % 50 as string) "
        "end k", "case when id % 11 != 0 then cast(pmod(hash(id), 5) as int) end t", "id i",
    )
    assert hot_keys(df, "k", 10_000) is None
    hot = hot_keys(df, "k", 100)
    assert rows(hot.frame) == [("hot",), (None,)] and hot.count == 2
    assert numbered(df, hot) == numbered(df, None)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 3) | st.none()),
                min_size=1, max_size=40))
def test_numbering_across_ranges_equals_brute_force(spark, pairs):
    data = [(k, t, i) for i, (k, t) in enumerate(pairs)]
    df = spark.createDataFrame(data, "k string, t int, i int")
    order = [F.col("t").asc_nulls_last(), F.col("i").asc()]
    got = {r["i"]: r["n"] for r in number_across_ranges(df, "k", order, "n").collect()}
    for k, t, i in data:
        ahead = [x for x in data if x[0] == k and
                 (x[1] is None, x[1] or 0, x[2]) <= (t is None, t or 0, i)]
        assert got[i] == len(ahead)


def test_key_operators(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",)], "k string")
    b = spark.createDataFrame([("y",), ("z",)], "k string")
    assert rows(distinct_keys("k", a, b)) == [("x",), ("y",), ("z",)]
    doubled = spark.createDataFrame([("x",), ("x",)], "k string")
    assert rows(history_of(a, doubled, "k")) == [("x",), ("x",)]
    child = spark.createDataFrame([("x", 1), (None, 2), ("q", 3)], "f string, i int")
    assert rows(orphans(child, "f", a, "k")) == [("q", 3)]


def test_history_of_hot_keys(spark):
    df = spark.range(300).selectExpr("case when id % 3 = 0 then 'hot' else cast(id as string) end k",
                                     "id")
    hot = hot_keys(df, "k", 50)
    for wanted in (["hot", "1", "hot"], ["1", "2"], ["none"]):
        keys = spark.createDataFrame([(k,) for k in wanted], "k string")
        assert rows(history_of(df, keys, "k", hot)) == rows(history_of(df, keys, "k"))


# -- keyed tables --------------------------------------------------------------------------------


def frame(spark, data):
    return spark.createDataFrame(sorted(data.items()), "k int, v string")


def table(spark, buckets=3):
    return KeyedTable(spark, scratch_path(spark, "t"), ["k"], buckets=buckets)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.dictionaries(st.integers(0, 12), st.text("ab", max_size=2), max_size=8),
                min_size=1, max_size=4), st.booleans())
def test_upserts_equal_a_dictionary(spark, batches, compact):
    t, expected = table(spark), {}
    for number, batch in enumerate(batches):
        t.upsert(frame(spark, batch))
        expected.update(batch)
        if compact and number == 1:
            t.compact()
    assert dict(rows(t.read())) == expected
    fresh = KeyedTable(spark, t.path, ["k"], buckets=3)
    assert dict(rows(fresh.read())) == expected


def test_new_keys_rewrite_nothing(spark):
    t = table(spark, buckets=1)
    t.upsert(frame(spark, {1: "a"}))
    t.upsert(frame(spark, {2: "b"}))
    assert [f.version for f in t._state().live] == [1, 2]
    t.upsert(frame(spark, {1: "c"}))
    # the folder of key 1 has no other row, so nothing of it is kept; that of key 2 stays
    assert sorted((f.version, f.part) for f in t._state().live) == [(2, "new"), (3, "new")]
    assert dict(rows(t.read())) == {1: "c", 2: "b"}


def test_upsert_leaves_only_folders_that_a_version_lists(spark):
    """Folders of the batch whose rows were written again go when the version counts."""
    t = KeyedTable(spark, scratch_path(spark, "t"), ["k"], buckets=1)
    t.upsert(spark.range(10).selectExpr("id k", "0 v"))
    t.upsert(spark.range(5, 15).selectExpr("id k", "if(id < 8, 1, 0) v"))
    listed = {f.path for v in (1, 2) for f in t._listed(v).live + t._listed(v).after + t._listed(v).before}
    stored = {str(p.parent.relative_to(t.path)) for p in Path(t.path).glob("data/**/_bucket=*/*.parquet")}
    assert stored == listed
    assert sorted(map(tuple, t.read().collect())) == [(k, int(5 <= k < 8)) for k in range(15)]
    assert t.changes(1).count() == 11 and t.changes(0) is None


def test_clear_deletes_what_the_newest_two_versions_do_not_read(spark):
    t, seen = KeyedTable(spark, scratch_path(spark, "t"), ["k"], buckets=2), []

    for n in range(4):
        t.upsert(spark.range(10 + n).selectExpr("id k", f"if(id < 9, {n}, 0) v"))
        seen.append(t.read())
        t.clear(1 if n == 2 else None)
        if n == 2:
            assert t.changes(1).count() == 4 * 9 + 2  # two versions, of which the first's stayed as well
    three, four = t._listed(3), t._listed(4)
    stored = {str(p.parent.relative_to(t.path)) for p in Path(t.path).glob("data/**/*.parquet")}
    assert stored == {f.path for f in three.live + four.live + four.after + four.before}
    for df, n in ((seen[2], 2), (seen[3], 3), (KeyedTable(spark, t.path, ["k"], buckets=2).read(), 3)):
        assert sorted(map(tuple, df.collect())) == [(k, n if k < 9 else 0) for k in range(10 + n)]
    assert t.changes(3).count() == 2 * 9 + 1 and t.changes(2) is None and t.changes(1) is None
    assert t.counts(1) == {"rows_total": 13, "rows_arrived": 36, "rows_written": 30, "rows_replaced": 27}


def test_rows_that_stay_the_same_rewrite_nothing(spark):
    t = KeyedTable(spark, scratch_path(spark, "t"), ["k"], buckets=1)

    def stamped(data, at):
        return frame(spark, data).withColumn("at", F.lit(at))

    t.upsert(stamped({1: "a", 2: None}, 1), ("at",))
    t.upsert(stamped({1: "a", 2: None, 3: "c"}, 2), ("at",))
    assert rows(t.read()) == [(1, "a", 1), (2, None, 1), (3, "c", 2)]
    assert [f.version for f in t._state().live] == [1, 2]
    t.upsert(stamped({2: "b", 3: "c"}, 3), ("at",))
    assert sorted((f.version, f.part) for f in t._state().live) == [(2, "new"), (3, "kept"), (3, "new")]
    assert rows(t.read()) == [(1, "a", 1), (2, "b", 3), (3, "c", 2)]
    t.upsert(stamped({3: "c"}, 4))
    assert rows(t.read()) == [(1, "a", 1), (2, "b", 3), (3, "c", 4)]


def test_untouched_buckets_stay(spark):
    t = table(spark, buckets=8)
    t.overwrite(frame(spark, {i: "a" for i in range(40)}))
    before = t._state().live
    t.upsert(frame(spark, {5: "b"}))
    assert len(set(before) - set(t._state().live)) == 1
    assert t.read().count() == 40


def test_changes_are_the_difference_of_versions(spark):
    t, states = table(spark, buckets=2), [{}]
    for batch in ({1: "a", 2: "b"}, {2: "b", 3: "c"}, {1: "z", 4: None}, {4: None, 1: "y"}, {1: "y"}):
        t.upsert(frame(spark, batch))
        states.append(states[-1] | batch)
    assert t.changes(0) is None  # the first write replaced everything
    for since in range(1, 6):
        sums = Counter()
        for key, value, sign in rows(t.changes(since)):
            sums[key, value] += sign
        was, now = set(states[since].items()), set(states[-1].items())
        assert {k: n for k, n in sums.items() if n} == {
            **{k: 1 for k in now - was}, **{k: -1 for k in was - now}}
    t.compact()
    assert rows(t.changes(5)) == []
    t.overwrite(frame(spark, {9: "x"}))
    assert t.changes(5) is None and rows(t.changes(t.version())) == []


def opened(df):
    """Folders (below the table) and columns that the scans of a frame read."""
    files = {f.split("data/")[1].rsplit("/", 1)[0] for f in df.inputFiles()}
    columns = re.findall(r"ReadSchema: struct<([^>]*)>", df._jdf.queryExecution().toString())
    return files, columns


def test_rows_of_keys_open_only_folders_that_hold_them(spark):
    t = KeyedTable(spark, scratch_path(spark, "t"), ["k"], buckets=1)
    for start in (0, 100, 200):
        t.upsert(frame(spark, {start + i: "a" for i in range(50)}))
    keys = spark.createDataFrame([(120,), (None,), (777,)], "k int")
    found = t.rows_of(keys, "k")
    assert {f for f, in rows(found.select("k"))} == set(range(100, 150))
    assert opened(found)[0] == {"_v=2/_step=new/_part=new/_bucket=0"}
    assert t.rows_of(keys.filter("k = 777"), "k").count() == 0
    with pytest.raises(ValueError, match="not bucketed by v"):
        t.rows_of(keys, "v")


def test_an_upsert_reads_whole_rows_only_of_folders_with_its_keys(spark, monkeypatch):
    """The others are not opened at all when their ranges are apart, else only their keys are read."""
    t, scans = KeyedTable(spark, scratch_path(spark, "t"), ["k"], buckets=1), []
    whole = KeyedTable._read_folders

    def seen(self, folders, schema):
        scans.append({f.path.split("/", 1)[1] for f in folders})
        return whole(self, folders, schema)

    t.upsert(frame(spark, {i: "a" for i in range(100, 150)}))
    t.upsert(frame(spark, {i: "a" for i in range(150, 200)}))
    t.upsert(frame(spark, {i: "a" for i in (110, 190, 500)}).filter("k = 500"))
    monkeypatch.setattr(KeyedTable, "_read_folders", seen)
    t.upsert(frame(spark, {120: "b", 130: "a"}))
    opened_before = [s for s in scans if not any(p.startswith("_v=4") for p in s)]
    assert opened_before and all(s == {"_v=1/_step=new/_part=new/_bucket=0"} for s in opened_before)
    assert t.read().count() == 101 and rows(t.read().filter("k = 120")) == [(120, "b")]


def test_rows_are_not_shuffled_only_to_lie_by_bucket(spark):
    """Each task writes to the few buckets there are; ``compact`` joins the files."""
    t = KeyedTable(spark, scratch_path(spark, "t"), ["k"], buckets=2)
    batch = spark.range(0, 300, 1, 3).selectExpr("cast(id as int) k", "'a' v")
    t.overwrite(batch)
    assert len(t.read().inputFiles()) == 6
    t.upsert(batch.selectExpr("k + 1000 k", "v"))
    assert len(t.read().inputFiles()) == 12 and t.compact() == 2
    assert len(t.read().inputFiles()) == 2 and t.read().distinct().count() == 600
    many = KeyedTable(spark, scratch_path(spark, "t"), ["k"], buckets=16)
    many.overwrite(batch)
    assert len(many.read().inputFiles()) == 16


def test_an_upsert_writes_its_rows_once(spark):
    """New and changed rows as they come, and without a shuffle of stored rows for a few changes."""
    t = KeyedTable(spark, scratch_path(spark, "t"), ["k"], buckets=1)
    t.upsert(frame(spark, {i: "a" for i in range(50)}))
    t.upsert(frame(spark, {i: "b" for i in range(40, 90)}))
    written = spark.read.parquet(f"{t.path}/data/_v=2/_step=new").count()
    stored = spark.read.parquet(f"{t.path}/data/_v=2/_step=kept").groupBy("_part").count()
    assert written == 50 and sorted(map(tuple, stored.collect())) == [("kept", 40), ("was", 10)]
    steps = [f for f in folder_names(spark, f"{t.path}/data/_v=2", "") if f.startswith("_step")]
    assert steps == ["_step=kept", "_step=matched", "_step=new"]
    assert dict(rows(t.read())) == {i: "a" if i < 40 else "b" for i in range(90)}


def test_older_and_equal_rows_of_a_batch_stay_out(spark):
    t = KeyedTable(spark, scratch_path(spark, "t"), ["k"], buckets=2)
    first = [(1, "a", 5), (2, "a", 5), (3, "a", 5), (None, "n", 5)]
    t.upsert(spark.createDataFrame(first, "k int, v string, at int"), newer_by="at")
    second = [(1, "a", 5), (2, "old", 4), (3, "new", 6), (4, "new", 6), (None, "m", 5)]
    t.upsert(spark.createDataFrame(second, "k int, v string, at int"), newer_by="at")
    assert rows(t.read()) == [(1, "a", 5), (2, "a", 5), (3, "new", 6), (4, "new", 6),
                              (None, "m", 5), (None, "n", 5)]
    assert rows(t.changes(1)) == [(3, "a", 5, -1), (3, "new", 6, 1), (4, "new", 6, 1), (None, "m", 5, 1)]


def test_lists_that_differ_in_nulls_differ(spark):
    t = table(spark, buckets=1)
    lists = [None, [], [None], ["a", None], [None, "a"], ["a"], ["a", "b"], ["ab"], [""]]
    for value in lists:
        t.upsert(spark.createDataFrame([(1, value)], "k int, v array<string>"))
        assert rows(t.read()) == [(1, value)]
    assert t.version() == len(lists)


def test_a_write_that_dies_is_not_seen(spark):
    t = table(spark)
    t.upsert(frame(spark, {1: "a", 2: "a"}))

    class Dies(KeyedTable):
        def _commit(self, state):
            raise RuntimeError("lost")

    broken = Dies(spark, t.path, ["k"], buckets=3)
    try:
        broken.upsert(frame(spark, {1: "x", 3: "x"}))
    except RuntimeError:
        pass
    t.refresh()
    assert dict(rows(t.read())) == {1: "a", 2: "a"}
    t.upsert(frame(spark, {3: "b"}))
    assert dict(rows(t.read())) == {1: "a", 2: "a", 3: "b"}


def test_a_table_can_be_rebuilt_from_itself(spark):
    t = table(spark)
    t.overwrite(frame(spark, {1: "a", 2: "b"}))
    t.overwrite(t.read().withColumn("v", F.upper("v")))
    assert dict(rows(t.read())) == {1: "A", 2: "B"}


def test_empty_tables(spark):
    t = table(spark)
    t.overwrite(frame(spark, {1: "a"}).filter("false"))
    assert t.exists() and t.read().columns == ["k", "v"] and t.read().count() == 0
    t.upsert(frame(spark, {1: "a"}))
    t.upsert(frame(spark, {1: "a"}).filter("false"))
    assert dict(rows(t.read())) == {1: "a"}


# -- quality -------------------------------------------------------------------------------------


def test_checks_ignore_null_where_undecided(spark):
    df = spark.createDataFrame([(None, None), (None, None), ("a", "x@y"), ("a", "x@y.z")],
                               "k string, email string")
    assert rows(q.unique(df, "k")) == [("a", 2)]
    assert q.not_null(df, "k").count() == 2
    assert rows(q.accepted_values(df, "k", ["b"])) == [("a", 2)]
    assert rows(q.email_format(df)) == [("a", "x@y")]


def test_row_count_bounds_are_inclusive(spark):
    df = spark.range(5)
    assert q.row_count_between(df, 5, 9).isEmpty() and q.row_count_between(df, 1, 5).isEmpty()
    assert rows(q.row_count_between(df, 6, 9)) == [(5,)]
    assert rows(q.row_count_between(df, 1, 4)) == [(5,)]


def test_freshness(spark):
    df = spark.createDataFrame([(T0,)], "_ingestion_ts timestamp_ntz")
    states = [q.source_freshness(df, "s", datetime(2024, 1, d)).first()["status"]
              for d in (2, 3, 4, 8, 9)]
    assert states == ["pass", "pass", "warn", "warn", "error"]
    assert q.source_freshness(df.filter("false"), "s", T1).first()["status"] == "error"


# -- profiles ------------------------------------------------------------------------------------


def test_profiles_count_null_as_a_value(spark):
    long = "x" * 200
    df = spark.createDataFrame([("a", 1, ["p"]), (None, 1, None), (None, 2, ["p"]),
                                (long, 2, []), (long + "y", 2, [])],
                               "s string, n int, l array<string>")
    exact = rows(profile.column_profile(df, "f"))
    assert exact == [("f", "l", "array<string>", 1, 3), ("f", "n", "int", 0, 2),
                     ("f", "s", "string", 2, 4)]
    assert rows(profile.column_profile_approx(df, "f")) == exact


def test_full_duplicates_are_null_safe(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("a", "b")], "x string, y string")
    assert rows(profile.full_duplicate_rows(df, "f")) == [("f", 1)]


def test_whole_rows_are_compared_by_a_short_digest(spark):
    data = [("a|b", None, 1), ("a", "b", 1), ("a|b", None, 1), (None, "a|b", 1), ("-", None, 1)]
    found = profile.full_duplicate_rows(spark.createDataFrame(data, "x string, y string, z int"), "f")
    assert rows(found) == [("f", 1)]
    assert re.search(r"hashpartitioning\(row#\d+, \d+\)", found._jdf.queryExecution().toString())


def test_list_profile(spark):
    df = spark.createDataFrame([(["a", "b"],), (None,), (["a"],)], "l array<string>")
    assert rows(profile.list_stats(df, "l")) == [(0, 2, 1.0)]
    assert rows(profile.top_elements(df, "l", 1)) == [("a", 2)]


def test_anomaly_probe_reads_mixed_dates(spark):
    events = spark.createDataFrame(
        [("1", "Offer", "Hired", "2025-11-08T00:00:00"), ("2", "Offer", "Hired", "2025-11-20"),
         ("1", "Offer", "HIRED", "2025-11-01"), ("9", None, "Hired", "2025-11-01")],
        "application_id string, old_status string, new_status string, event_timestamp string")
    applied = spark.createDataFrame([("1", "13-Nov-2025"), ("2", "November 13, 2025")],
                                    "application_id string, apply_date string")
    assert rows(profile.anomaly_probe(events, applied)) == [
        ("1", "Offer", "Hired", "2025-11-08T00:00:00", "13-Nov-2025")]


# -- history -------------------------------------------------------------------------------------


def test_history_drops_repeats_and_keeps_returns(spark):
    def at(hour):
        return datetime(2024, 1, 1, hour)

    data = [("a", "h1", at(1)), ("a", "h1", at(2)), ("a", "h2", at(3)), ("a", "h1", at(4)),
            ("b", "h1", at(1)), ("b", "h1", at(9))]
    df = spark.createDataFrame(data, "k string, _record_hash string, _ingestion_ts timestamp_ntz")
    expected = [("a", "h1", at(1), at(3), False), ("a", "h1", at(4), None, True),
                ("a", "h2", at(3), at(4), False), ("b", "h1", at(1), None, True)]
    columns = ["k", "_record_hash", "valid_from", "valid_to", "is_current"]
    assert rows(scd2(df, "k").select(columns)) == sorted(expected, key=repr)
    spread = scd2(df, "k", hot_keys(df, "k", 3))
    assert rows(spread.select(columns)) == sorted(expected, key=repr)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_merged_history_equals_the_full_build(spark, seed):
    pick = random.Random(seed)
    data = {(pick.choice("ab"), pick.randrange(12)): pick.choice("xy") for _ in range(16)}
    found = [(k, f"h{v}", datetime(2024, 1, 1, hour), v) for (k, hour), v in data.items()]
    schema = "k string, _record_hash string, _ingestion_ts timestamp_ntz, v string"
    everything = spark.createDataFrame(found, schema)
    history = StoredHistory(spark, scratch_path(spark, "history"), "k", buckets=2)
    pick.shuffle(found)
    for part in (found[:3], found[3:7], found[7:], found[:2]):
        history.merge(spark.createDataFrame([*part, (None, "h", datetime(2024, 1, 1), "n")], schema))
    columns = ["k", "_record_hash", "v", "_ingestion_ts", "valid_from", "valid_to", "is_current"]
    assert rows(history.read().select(columns)) == rows(scd2(everything, "k").select(columns))


def test_merged_sketches(spark):
    sketches = profile.ColumnSketches(spark, scratch_path(spark, "sketches"))
    schema = "n int, s string, l array<string>"
    whole = [(i, f"s{i % 7}", ["a"]) for i in range(100)] + [(None, None, None)]
    sketches.add(spark.createDataFrame(whole[:50], schema), "1")
    sketches.add(spark.createDataFrame(whole[:10], schema), "2")
    sketches.add(spark.createDataFrame(whole[50:], schema), "2")
    got = {r.column: r for r in sketches.profile("f").collect()}
    exact = {r.column: r for r in profile.column_profile(spark.createDataFrame(whole, schema), "f").collect()}
    for name, r in got.items():
        assert (r.rows, r.null_count, r.distinct_count) == (101, 1, exact[name].distinct_count)
    assert abs(got["n"].median - 50) <= 2 and got["s"].median is None
    assert {r.rows for r in sketches.profile("f", ["1"]).collect()} == {50}
    sketches.add(spark.createDataFrame([], schema), "3")
    assert {r.rows for r in sketches.profile("f", ["3"]).collect()} == {0}


def test_upsert_shuffles_keys_but_no_whole_rows(spark, tmp_path, monkeypatch):
    """Also beyond the number of keys that may be broadcast."""
    t = KeyedTable(spark, f"{tmp_path}/t", ["id"], buckets=4)
    rows = spark.range(450_000).select(
        F.col("id").cast("string").alias("id"), (F.col("id") % 2).alias("v"), F.lit("wide").alias("pad")
    )
    t.upsert(rows)
    plans = {}
    write = KeyedTable._write

    def watched(self, df, version, step, spread=None):
        plans[step] = df._jdf.queryExecution().executedPlan().toString()
        return write(self, df, version, step, spread)

    monkeypatch.setattr(KeyedTable, "_write", watched)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables too big for it
    try:
        t.upsert(rows.withColumn("v", F.when(F.col("v") == 0, F.col("v")).otherwise(99)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    for step in ("changed", "kept"):
        assert not [line for line in plans[step].splitlines() if "Exchange" in line and "id#" in line]
        assert "SortMergeJoin" not in plans[step]
    assert t.read().filter("v = 99").count() == 225_000
    assert t.read().select("id").distinct().count() == t.read().count() == 450_000


@pytest.mark.parametrize("few", [0, 8_192])
def test_marked_rows_are_exact_across_files_and_words(spark, tmp_path, monkeypatch, few):
    """Every third row changes; NULL keys match nothing; files hold more rows than one bitmap."""
    from hireflow.operators import keyed_table

    monkeypatch.setattr(keyed_table, "FEW_BITMAPS", few)
    t = KeyedTable(spark, f"{tmp_path}/t", ["id"], buckets=2)
    ids = F.when(F.col("id") != 5, F.col("id"))
    first = spark.range(100_000).coalesce(1).select(ids.alias("id"), F.lit(1).alias("v"))
    second = spark.range(50_000, 150_000).select(
        "id", F.when(F.col("id") % 3 == 0, 2).otherwise(1).alias("v")
    )
    t.upsert(first)
    t.upsert(second)
    want = spark.range(150_000).select(
        ids.alias("id"), F.when((F.col("id") >= 50_000) & (F.col("id") % 3 == 0), 2).otherwise(1).alias("v")
    )
    assert t.read().exceptAll(want).count() == want.exceptAll(t.read()).count() == 0
    moved = {(r["_change"], r["v"]): r["count"] for r in t.changes(1).groupBy("_change", "v").count().collect()}
    replaced = len([i for i in range(50_000, 100_000) if i % 3 == 0])
    added = len([i for i in range(100_000, 150_000) if i % 3 == 0])
    assert moved == {(-1, 1): replaced, (1, 2): replaced + added, (1, 1): 50_000 - added}


def test_hot_keys_are_counted_one_by_one_only_in_full_counters(spark, monkeypatch):
    from hireflow.operators import skew

    rows = spark.range(1_000).select(
        F.when(F.col("id") < 300, "big").when(F.col("id") < 450, F.lit(None)).otherwise(
            F.col("id").cast("string")).alias("k")
    )
    for counters, listed in ((1 << 14, 1000), (4, 1000), (4, 1)):
        monkeypatch.setattr(skew, "COUNTERS", counters)
        monkeypatch.setattr(skew, "FEW_COUNTERS", listed)
        found = skew.hot_keys(rows, "k", 100)
        assert {r["_hot"] for r in found.frame.collect()} == {"big", None} and found.count == 2
        assert skew.hot_keys(rows, "k", 400) is None
    monkeypatch.setattr(skew, "ensure_checkpoint_dir", None)  # nothing is kept where no counter is full
    monkeypatch.setattr(skew, "COUNTERS", 1 << 14)
    assert skew._full_counters(rows, "k", 400) == [] and skew.hot_keys(rows, "k", 400) is None
