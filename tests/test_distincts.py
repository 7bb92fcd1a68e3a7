"""Distinct counts over loads against ``countDistinct`` over all rows."""

import glob
import shutil

import pytest
from pyspark.sql import functions as F

from wardflow.sources.distincts import DistinctStore

SCHEMA = "city string, name string, code int"
LOADS = [
    [("a", "x", 1), ("a", "x", 2), (None, "y", 2), ("b", None, None)],
    [("a", "z", 1), ("c", "x", 7), (None, "y", 9), ("a", "", 1)],
    [],
    [("b", "w", None)] * 5 + [("a", "x", 1)],
]


def _frames(spark):
    return [spark.createDataFrame(rows, SCHEMA) for rows in LOADS]


def _expected(frames, by):
    rows = frames[0]
    for other in frames[1:]:
        rows = rows.union(other)
    found = rows.groupBy(*by).agg(
        F.count("*").alias("rows"), F.countDistinct("name").alias("name"),
        F.countDistinct("code").alias("code"))
    return sorted(map(str, found.collect()))


def _found(store, by):
    return sorted(map(str, store.counts(by).collect()))


def test_counts_follow_the_loads(spark, tmp_path):
    frames = _frames(spark)
    store = DistinctStore(spark, str(tmp_path), ["name", "code"], frames[0].select("city"), parts=3)
    assert _found(store, []) == ["Row(rows=0, name=0, code=0)"]
    assert _found(store, ["city"]) == []
    for n, rows in enumerate(frames, 1):
        assert store.add_load(f"load {n}", rows)
        for by in ([], ["city"]):
            assert _found(store, by) == _expected(frames[:n], by)


def test_a_repeated_load_and_a_dead_one_do_not_count(spark, tmp_path, monkeypatch):
    frames = _frames(spark)
    store = DistinctStore(spark, str(tmp_path), ["name", "code"], frames[0].select("city"))
    store.add_load("one", frames[0])
    assert not store.add_load("one", frames[1])

    def dies(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(DistinctStore, "_commit", dies)
    with pytest.raises(RuntimeError, match="lost"):
        store.add_load("two", frames[1])
    monkeypatch.undo()
    assert _found(store, ["city"]) == _expected(frames[:1], ["city"])
    store.add_load("two", frames[1])
    assert _found(store, ["city"]) == _expected(frames[:2], ["city"])


def test_old_rows_and_merged_loads_are_not_read(spark, tmp_path):
    frames = _frames(spark)
    store = DistinctStore(spark, f"{tmp_path}/store", ["name", "code"], frames[0].select("city"))
    for n, rows in enumerate(frames):
        rows.write.parquet(f"{tmp_path}/rows-{n}")
        store.add_load(str(n), spark.read.parquet(f"{tmp_path}/rows-{n}"))
        shutil.rmtree(f"{tmp_path}/rows-{n}")
    before = store.places()
    store.merge_loads()
    store.merge_loads()
    assert len(before) == len(LOADS) and len(store.places()) == 1
    for place in before:
        shutil.rmtree(place)
    assert _found(store, ["city"]) == _expected(frames, ["city"])
    # Values that came before keep their numbers, a new one gets a number of its own.
    assert not store.add_load("0", frames[0]) and store.add_load("5", frames[1])
    again = [*frames, frames[1]]
    assert _found(store, ["city"]) == _expected(again, ["city"])
    assert not glob.glob(f"{tmp_path}/rows-*")


def test_many_values_over_several_bitmaps(spark, tmp_path):
    store = DistinctStore(spark, str(tmp_path), ["id"], parts=2)
    for n, (first, last) in enumerate(((0, 90_000), (50_000, 200_000), (0, 10))):
        store.add_load(str(n), spark.range(first, last))
    assert [tuple(r) for r in store.counts().collect()] == [(240_010, 200_000)]
    numbers = store._read("values", "name string, value string, part int, number long", store.places())
    assert numbers.groupBy("part", "number").count().where("count > 1").isEmpty()
    widest = numbers.groupBy("part").agg((F.max("number") - F.count("*")).alias("gap"))
    assert {r["gap"] for r in widest.collect()} == {0}
