"""Histories, tables of versions and the types of unions, on hand-made rows beside brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelens.operators import checks, reshape
from hirelens.operators.types import superset
from hirelens.plans import history
from hirelens.session import scratch_path
from hirelens.sources import table_log

DAY = dt.date(2024, 1, 1)
FIELDS = "id int, name string, level int"


def day(k):
    return DAY + dt.timedelta(days=k)


def brute_history(deliveries):
    """{key: [(values, from, to)]} of deliveries {day: {key: values}}."""
    out = []
    days = sorted(deliveries)
    for key in {k for rows in deliveries.values() for k in rows}:
        state, since = None, None
        for k in [*days, None]:
            now = deliveries[k].get(key) if k is not None else None
            if k is None:
                if state is not None:
                    out.append((key, state, day(since), None))
            elif now != state:
                if state is not None:
                    out.append((key, state, day(since), day(k)))
                state, since = now, k
    return sorted(out, key=repr)


def as_rows(frame):
    return sorted([((r.id, r.name), (r.level,), r.valid_from, r.valid_to) for r in frame.collect()], key=repr)


def made(seed, days):
    rng = random.Random(seed)
    keys = [(1, "a"), (1, None), (None, "a"), (2, "b"), (3, "c")]
    return {k: {key: (rng.choice([None, 1, 2]),) for key in keys if rng.random() < 0.7} for k in range(days)}


def frame_of(spark, rows):
    return spark.createDataFrame([(*key, *values) for key, values in rows.items()], FIELDS)


@pytest.mark.parametrize("seed,order", [(1, [0, 1, 2, 3]), (2, [3, 1, 2, 0]), (3, [2, 3, 0, 1, 1, 3])])
def test_deliveries_in_any_order_give_one_history(spark, seed, order):
    deliveries = made(seed, 4)
    want = brute_history(deliveries)
    every = [frame_of(spark, rows).withColumn("delivered_at", F.lit(day(k))) for k, rows in deliveries.items()]
    built = history.build(every[3].unionAll(every[1]).unionAll(every[0]).unionAll(every[2]), ["id", "name"])
    assert as_rows(built) == want
    place, told = scratch_path(spark, "history"), []
    for k in order:
        told.append(history.deliver(spark, place, frame_of(spark, deliveries[k]), ["id", "name"], day(k)))
    assert told == [k not in order[:n] for n, k in enumerate(order)]
    assert as_rows(history.stored(spark, place)) == want
    assert as_rows(history.stored(spark, place, open_only=True)) == [r for r in want if r[3] is None]


def test_a_delivery_that_is_merged_again_changes_nothing(spark):
    """As where the log entry was lost: the same delivery meets versions of its own time."""
    deliveries = made(5, 3)
    rows = None
    for k in (0, 1, 2, 2):
        sent = frame_of(spark, deliveries[k])
        first = sent.withColumns({"valid_from": F.lit(day(k)), "valid_to": F.lit(None).cast("date")})
        rows = first if rows is None else history.merge(rows, sent, ["id", "name"], F.lit(day(k)))
    assert as_rows(rows) == brute_history(deliveries)


def test_odd_deliveries(spark):
    place = scratch_path(spark, "history")
    twice = spark.createDataFrame([(1, "a", 2), (1, "a", 1), (1, "a", None), (None, None, 5), (None, None, 5)], FIELDS)
    none = twice.where("false")
    history.deliver(spark, place, none, ["id", "name"], day(0))
    assert as_rows(history.stored(spark, place)) == []
    history.deliver(spark, place, twice, ["id", "name"], day(1))
    history.deliver(spark, place, none, ["id", "name"], day(2))
    got = as_rows(history.stored(spark, place))
    assert got == sorted([((1, "a"), (None,), day(1), day(2)), ((None, None), (5,), day(1), day(2))], key=repr)
    assert history.stored(spark, place, open_only=True).count() == 0
    keys_only = spark.createDataFrame([(1,), (1,), (2,)], "id int").withColumn("delivered_at", F.lit(day(0)))
    assert history.build(keys_only, ["id"]).count() == 2


def test_an_on_time_delivery_leaves_closed_rows_unread(spark):
    place = scratch_path(spark, "history")
    for k, rows in made(7, 4).items():
        history.deliver(spark, place, frame_of(spark, rows), ["id", "name"], day(k))
    numbers = table_log.versions(spark, f"{place}/history")
    before, last = (table_log.entry(spark, f"{place}/history", n)["parts"] for n in numbers[-2:])
    closed = [p["folder"] for p in before if p["tag"] == "closed"]
    assert closed and set(closed) <= {p["folder"] for p in last}


def _exchanges(frame):
    return frame._jdf.queryExecution().executedPlan().toString().split("Exchange ")[1:]


@pytest.mark.parametrize("order", [[0, 1, 2, 3], [1, 3, 2, 0], [0, 2, 3, 1]])
def test_a_delivery_moves_only_its_own_rows(spark, monkeypatch, order):
    """Stored versions lie in buckets by key: one shuffle, with the delivered rows, even if the delivery is late."""
    plans, rebuild, place = [], table_log.rebuild, scratch_path(spark, "history")
    monkeypatch.setattr(table_log, "rebuild", lambda df, *a, **k: (plans.append(_exchanges(df)), rebuild(df, *a, **k))[1])
    deliveries = made(11, 4)
    for k in order:
        history.deliver(spark, place, frame_of(spark, deliveries[k]), ["id", "name"], day(k))
    assert [len(p) for p in plans] == [1] * 4
    assert as_rows(history.stored(spark, place)) == brute_history(deliveries)


def test_all_deliveries_at_once_are_shuffled_by_key_once(spark):
    rows = [frame_of(spark, rows).withColumn("delivered_at", F.lit(day(k))) for k, rows in made(12, 2).items()]
    plan = history.build(rows[0].unionAll(rows[1]), ["id", "name"])
    assert len([e for e in _exchanges(plan) if e.startswith("hashpartitioning") and "id#" in e.split("\n")[0]]) == 1


def test_buckets_of_odd_names_and_no_rows(spark):
    place = scratch_path(spark, "odd names")
    rows = spark.createDataFrame([(1, "a", (2, "x")), (None, "it's", None)], "`an id` int, `b``c` string, s struct<`d e`: int, f: string>")
    table_log.rebuild(rows.repartition(3, "`an id`"), place, buckets=(3, ["an id"]))
    table_log.append(rows.where("false"), place)
    assert sorted(table_log.read(spark, place).collect(), key=repr) == sorted(rows.collect(), key=repr)
    assert table_log.buckets_of(spark, place) is None
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("hirelens_")]


# --- tables of versions -----------------------------------------------------------------------


def test_a_failed_rebuild_leaves_the_old_rows(spark):
    place = scratch_path(spark, "versions")
    with pytest.raises(ValueError, match="no version"):
        table_log.read(spark, place)
    assert table_log.rebuild(spark.range(3), place) == 1
    with pytest.raises(Exception, match="stopped"):
        table_log.rebuild(spark.range(9).select(F.raise_error(F.lit("stopped")).cast("long").alias("id")), place)
    assert table_log.read(spark, place).count() == 3 and table_log.versions(spark, place) == [1]
    table_log.rebuild(table_log.read(spark, place).where("id > 0"), place)
    assert [table_log.read(spark, place, n).count() for n in (1, 2)] == [3, 2]
    with pytest.raises(table_log.VersionTaken):
        table_log._commit(spark, place, 2, {"parts": []})
    assert table_log.read(spark, place).count() == 2


def test_the_schema_comes_from_the_log(spark):
    place = scratch_path(spark, "schemas")
    table_log.append(spark.createDataFrame([(1, "a")], "id int, name string"), place)
    table_log.append(spark.createDataFrame([], "id int, name string"), place)
    table_log.append(spark.createDataFrame([("x", 2.5, (1, None))], "id string, size double, place struct<a: int, b: string>"), place)
    table_log.append(spark.createDataFrame([((2**40,),)], "place struct<A: long>"), place)
    rows = {(r.id, r.name, r.size, r.place) for r in table_log.read(spark, place).collect()}
    assert rows == {("1", "a", None, None), ("x", None, 2.5, (1, None)), (None, None, None, (2**40, None))}
    assert [n for n, _ in table_log.schema_log(spark, place)] == [1, 3, 4]


# --- types ------------------------------------------------------------------------------------


@pytest.mark.parametrize("kinds,wanted", [
    ("tinyint, int", "int"), ("int, bigint, smallint", "bigint"), ("int, decimal(10, 2)", "decimal(12, 2)"), ("bigint, decimal(4, 4)", "decimal(24, 4)"),
    ("decimal(38, 0), decimal(38, 18)", "string"), ("float, smallint", "float"), ("float, int", "double"), ("decimal(38, 0), decimal(38, 18), double", "double"),
    ("date, timestamp_ntz", "timestamp_ntz"), ("date, timestamp, timestamp_ntz", "timestamp"), ("date, int", "string"), ("boolean, int", "string"),
    ("void, int", "int"), ("void", "void"), ("string, boolean, double", "string"), ("array<int>, array<bigint>", "array<bigint>"),
    ("map<int, int>, map<bigint, string>", "map<bigint, string>"), ("binary", "binary"),
    ("struct<a: int, b: date>, struct<B: timestamp, c: array<int>>", "struct<a: int, b: timestamp, c: array<int>>"),
])
def test_superset_of_types_does_not_depend_on_order(spark, kinds, wanted):
    types = [f.dataType for f in T.StructType.fromDDL("".join(f"c{k} {t}, " for k, t in enumerate(_split(kinds)))[:-2])]
    want = T.StructType.fromDDL(f"c {wanted}")[0].dataType
    assert superset(types).simpleString() == want.simpleString()
    if not isinstance(want, T.StructType):
        assert superset(types[::-1]).simpleString() == want.simpleString()


def _split(kinds):
    out, depth = [""], 0
    for c in kinds:
        depth += (c in "(<") - (c in ")>")
        if c == "," and not depth:
            out.append("")
        else:
            out[-1] += c
    return [k.strip() for k in out]


@pytest.mark.parametrize("kinds", ["binary, string", "array<int>, int", "struct<a: int>, map<string, int>"])
def test_types_without_a_common_one_are_refused(spark, kinds):
    types = [f.dataType for f in T.StructType.fromDDL("".join(f"c{k} {t}, " for k, t in enumerate(_split(kinds)))[:-2])]
    for order in (types, types[::-1]):
        with pytest.raises(ValueError, match="no common type"):
            superset(order)


def test_unions_keep_every_value(spark):
    one = spark.createDataFrame([(1, [1, None], {"k": 1}, (1, [(2,)]), None)], "id int, l array<int>, m map<string, int>, s struct<x: int, y: array<struct<p: int>>>, v void")
    two = spark.createDataFrame([("t", [2**40], {"q": 2.5}, ([(2**40, "e")], "z"), 3), (None, None, None, None, None)],
                                "ID string, l array<bigint>, M map<string, double>, s struct<y: array<struct<p: bigint, q: string>>, w: string>, v int")
    for tables in ({"a": one, "b": two}, {"b": two, "a": one}):
        rows = [r.asDict(recursive=True) for r in reshape.union_relations(tables, source_column=None).collect()]
        rows = {(r.get("id") or r.get("ID")): {k.lower(): v for k, v in r.items()} for r in rows}
        assert rows["1"]["l"] == [1, None] and rows["1"]["m"] == {"k": 1.0}
        assert rows["1"]["s"] == {"x": 1, "y": [{"p": 2, "q": None}], "w": None} and rows["1"]["v"] is None
        assert rows["t"]["s"] == {"x": None, "y": [{"p": 2**40, "q": "e"}], "w": "z"} and rows["t"]["v"] == 3
        assert rows[None]["s"] is None and rows[None]["l"] is None


# --- columns of tables ------------------------------------------------------------------------


def test_pivot_finds_all_values(spark):
    rows = [(g, v, n) for g in "xy" for v in ("A b", "c-d", "9") for n in (1, 1, 2)] + [("x", "only", 5)]
    frame = spark.createDataFrame(rows, "g string, v string, n int")
    got = reshape.pivot(frame, ["g"], "v", agg="count", then_value="n", else_value=None, prefix="of ", slug_names=True, distinct=True)
    assert sorted(got.columns) == ["g", "of_9", "of_a_b", "of_c_d", "of_only"]
    assert {(r.g, r.of_a_b, r.of_only) for r in got.collect()} == {("x", 2, 1), ("y", 2, 0)}


def test_columns_of_two_tables_are_compared_as_rows(spark):
    one = spark.createDataFrame([(1, None, "x"), (2, None, None)], "ID int, a string, `odd name` string")
    two = spark.createDataFrame([(1, "v")], "id int, B string")
    got = {tuple(r) for r in checks.columns_match(one, two).collect()}
    assert got == {("a", None, 0), ("odd name", None, 1), (None, "b", 1)}
    assert {tuple(r) for r in checks.columns_match_set(one, ["Id", "A", "c", "C"]).collect()} == {("odd name", None), (None, "c")}
    assert checks.columns_match(one.where("false"), two.where("false")).count() == 3
    assert checks.columns_match_set(one, []).count() == 3
