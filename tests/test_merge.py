import threading
from datetime import datetime

from pyspark.sql import functions as F

from tenorline.operators.merge import (
    insert_ignore, key_violations, patch, split_by_id, upsert,
)
from tenorline.schema import with_natural_id
from tenorline.session import scratch_dir
from tenorline.sinks import parquet_tables
from tenorline.sinks.parquet_tables import append_new, committing, patch_rows, upsert_rows, write_table
from tenorline.sources.tables import read_table

SCHEMA = "id long, dt timestamp, ticker string, close double, iv double"
KEY = ("dt", "ticker")


def day(n):
    return datetime(2022, 1, n, 21)


def rows(spark, *items):
    return spark.createDataFrame(list(items), SCHEMA)


def content(df):
    return sorted((r["id"], r["dt"].day, r["ticker"], r["close"], r["iv"]) for r in
                  df.select("id", "dt", "ticker", "close", "iv").collect())


def batch(spark):
    return spark.createDataFrame(
        [(2, day(4), "B", 9.0, 1), (3, day(5), "C", 3.0, 1), (3, day(5), "C", 3.5, 2)],
        "id long, dt timestamp, ticker string, close double, seq int")


def target(spark):
    return rows(spark, (1, day(3), "A", 1.0, 0.1), (2, day(4), "B", 2.0, 0.2))


def test_insert_ignore_keeps_stored_and_first(spark):
    once = insert_ignore(target(spark), batch(spark), KEY, ("seq",))
    assert content(once) == [(1, 3, "A", 1.0, 0.1), (2, 4, "B", 2.0, 0.2), (3, 5, "C", 3.0, None)]
    assert content(insert_ignore(once, batch(spark), KEY, ("seq",))) == content(once)


def test_upsert_replaces_whole_rows_with_the_latest(spark):
    once = upsert(target(spark), batch(spark), ("id",), ("seq",))
    assert content(once) == [(1, 3, "A", 1.0, 0.1), (2, 4, "B", 9.0, None), (3, 5, "C", 3.5, None)]
    assert content(upsert(once, batch(spark), ("id",), ("seq",))) == content(once)


def test_override_applies_to_replaced_rows_only(spark):
    out = upsert(target(spark), batch(spark), ("id",), ("seq",), {"iv": F.lit(0.7)})
    assert content(out) == [(1, 3, "A", 1.0, 0.1), (2, 4, "B", 9.0, 0.7), (3, 5, "C", 3.5, None)]


def test_stored_table_round_trip(spark):
    path = scratch_dir(spark, "merge-test")
    write_table(target(spark), path)
    for _ in range(2):
        append_new(spark, path, batch(spark), KEY, ("seq",))
        assert content(read_table(spark, path)) == [
            (1, 3, "A", 1.0, 0.1), (2, 4, "B", 2.0, 0.2), (3, 5, "C", 3.0, None)]
    for _ in range(2):
        upsert_rows(spark, path, batch(spark), KEY, ("seq",))
        assert content(read_table(spark, path)) == [
            (1, 3, "A", 1.0, 0.1), (2, 4, "B", 9.0, None), (3, 5, "C", 3.5, None)]


def test_append_creates_the_table(spark):
    path = scratch_dir(spark, "merge-new")
    append_new(spark, path, batch(spark), KEY, ("seq",))
    stored = read_table(spark, path)
    assert sorted((r["ticker"], r["close"]) for r in stored.collect()) == [("B", 9.0), ("C", 3.0)]


def test_split_and_violations(spark):
    mixed = rows(spark, (None, day(3), "A", 1.0, 0.1), (2, day(4), "B", 2.0, 0.2))
    new, known = split_by_id(mixed)
    assert "id" not in new.columns and new.count() == 1 and known.first()["id"] == 2
    assert key_violations(target(spark), KEY).isEmpty()
    twice = target(spark).unionByName(target(spark).filter("id = 1"))
    assert [r["n"] for r in key_violations(twice, KEY).collect()] == [2]


def test_natural_id_is_stable(spark):
    a, b = (with_natural_id(target(spark)).orderBy("ticker").collect() for _ in range(2))
    assert [r["id"] for r in a] == [r["id"] for r in b] and a[0]["id"] != a[1]["id"]


def test_day_conditions_prune_partitions(spark):
    from datetime import date

    from tenorline.operators.filters import between_days

    path = scratch_dir(spark, "pruned")
    write_table(target(spark), path)
    one = between_days(read_table(spark, path), date(2022, 1, 4), date(2022, 1, 4))
    assert content(one) == [(2, 4, "B", 2.0, 0.2)]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(d" in plan


def test_merges_read_only_the_touched_days(spark):
    from tenorline.sinks.parquet_tables import _touched
    from tenorline.sources.tables import with_day

    path = scratch_dir(spark, "touched")
    write_table(target(spark), path)
    touched = _touched(read_table(spark, path), with_day(batch(spark)))
    assert [r["id"] for r in touched.collect()] == [2]
    plan = touched._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [d" in plan or "PartitionFilters: [isnotnull(d" in plan


def patches(spark):
    return spark.createDataFrame(
        [(2, day(4), "B", None, 0.7, 1), (2, day(4), "B", 9.0, None, 2), (2, day(4), "B", None, None, 3),
         (3, day(5), "C", 3.0, None, 1)], "id long, dt timestamp, ticker string, close double, iv double, seq int")


def test_patch_keeps_what_the_source_does_not_give(spark):
    once = patch(target(spark), patches(spark), KEY, ("seq",))
    assert content(once) == [(1, 3, "A", 1.0, 0.1), (2, 4, "B", 9.0, 0.7), (3, 5, "C", 3.0, None)]
    assert content(patch(once, patches(spark), KEY, ("seq",))) == content(once)
    without = patches(spark).drop("iv")
    assert content(patch(target(spark), without, KEY, ("seq",)))[1] == (2, 4, "B", 9.0, 0.2)
    assert content(patch(target(spark), patches(spark).limit(0), KEY, ("seq",))) == content(target(spark))


def test_patched_table_rewrites_touched_days(spark):
    path = scratch_dir(spark, "patch-test")
    patch_rows(spark, path, target(spark), KEY, ("id",))
    for _ in range(2):
        patch_rows(spark, path, patches(spark), KEY, ("seq",))
        assert content(read_table(spark, path)) == [(1, 3, "A", 1.0, 0.1), (2, 4, "B", 9.0, 0.7), (3, 5, "C", 3.0, None)]


def test_a_key_that_two_writers_bring_is_stored_once(spark, monkeypatch):
    """The second writer appends the same key after the first has staged its rows and before it commits."""
    path = scratch_dir(spark, "two-writers")
    staged, came = parquet_tables.staged, []

    def interleaved(session, incoming, beside):
        if not came:
            came.append(True)
            append_new(spark, path, rows(spark, (2, day(3), "A", 5.0, None), (2, day(3), "B", 5.0, None)), KEY, ("id",))
        return staged(session, incoming, beside)

    for start in ("absent", "present"):
        monkeypatch.setattr(parquet_tables, "staged", staged)
        if start == "present":
            came.clear()
        monkeypatch.setattr(parquet_tables, "staged", interleaved)
        append_new(spark, path, rows(spark, (1, day(3), "A", 1.0, None), (1, day(3), "C", 1.0, None)), KEY, ("id",))
        assert key_violations(read_table(spark, path), KEY).isEmpty()
        assert content(read_table(spark, path)) == [
            (1, 3, "C", 1.0, None), (2, 3, "A", 5.0, None), (2, 3, "B", 5.0, None)]


def test_writers_at_the_same_time(spark):
    path = scratch_dir(spark, "many-writers")
    work = [threading.Thread(target=append_new, args=(
        spark, path, rows(spark, *[(n, day(3 + k % 3), f"T{k}", float(n), None) for k in range(n, n + 6)]), KEY, ("id",)))
        for n in range(1, 5)]
    for w in work:
        w.start()
    for w in work:
        w.join()
    table = read_table(spark, path)
    assert key_violations(table, KEY).isEmpty()
    assert sorted(r["ticker"] for r in table.collect()) == sorted(f"T{k}" for k in range(1, 10))


def test_versions_are_exclusive_and_given_up_after_the_lease(spark):
    path = scratch_dir(spark, "versions")
    order = []

    def second():
        with committing(spark, path) as version:
            order.append(version)

    with committing(spark, path) as version:
        other = threading.Thread(target=second)
        other.start()
        other.join(1.5)
        assert other.is_alive()
        order.append(version)
    other.join(20)
    assert order == [1, 2]
    try:
        with committing(spark, path):
            raise ValueError("a failed merge")
    except ValueError:
        pass
    with committing(spark, path) as version:
        assert version == 4
        with committing(spark, path, lease=0.0) as overtaking:  # as if the holder had died
            assert overtaking == 5
