import threading
import time

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from shiftlode.sinks import versions as K


def values(df):
    return sorted(row[0] for row in df.collect())


def numbers(spark, *found):
    return spark.createDataFrame([(n,) for n in found], "a long")


def test_all_tables_change_together(spark, tmp_path):
    """While the second table is being written, readers see both old tables; then both new ones."""
    base = str(tmp_path)
    K.refresh_together(spark, base, {"mines": numbers(spark, 1), "logs": numbers(spark, 1)})

    @F.udf("long")
    def slow(value):
        time.sleep(1.5)
        return value

    seen, done = [], threading.Event()

    def read():
        while not done.is_set():
            tables = K.read_version(spark, base)
            seen.append((values(tables["mines"]), values(tables["logs"])))

    reader = threading.Thread(target=read)
    reader.start()
    K.refresh_together(spark, base, {"mines": numbers(spark, 2), "logs": numbers(spark, 2).select(slow("a").alias("a"))})
    done.set()
    reader.join()
    seen.append(tuple(values(K.read_version(spark, base)[name]) for name in ("mines", "logs")))
    assert seen[0] == ([1], [1]) and seen[-1] == ([2], [2])
    assert {str(pair) for pair in seen} == {"([1], [1])", "([2], [2])"}


def test_two_writers_lose_nothing(spark, tmp_path):
    """Both read version 1; the one that comes second starts again from what the first left."""
    base = str(tmp_path)
    K.refresh_together(spark, base, {"t": numbers(spark, 0), "other": numbers(spark, 9)})
    meet, calls = threading.Barrier(2), []

    def writer(number):
        def add(tables):
            calls.append(number)
            if calls.count(number) == 1:
                meet.wait()
            return {"t": tables["t"].union(numbers(spark, number))}

        K.refresh_together(spark, base, add)

    threads = [threading.Thread(target=writer, args=(n,)) for n in (1, 2)]
    [thread.start() for thread in threads]
    [thread.join() for thread in threads]
    tables = K.read_version(spark, base)
    assert values(tables["t"]) == [0, 1, 2] and values(tables["other"]) == [9]
    assert len(calls) == 3 and K.current_version(spark, base)[0] == 3


def test_given_tables_are_published_over_a_faster_writer(spark, tmp_path, monkeypatch):
    base, take, lost = str(tmp_path), K._take, []

    def faster(spark, path, number, tables):
        if not lost:
            lost.append(number)
            assert take(spark, path, number, {"x": K._stored(numbers(spark, 5), path, "x", ())})
        return take(spark, path, number, tables)

    monkeypatch.setattr(K, "_take", faster)
    tables = K.refresh_together(spark, base, {"y": numbers(spark, 6)})
    assert values(tables["x"]) == [5] and values(tables["y"]) == [6]
    monkeypatch.setattr(K, "_take", lambda *_: False)
    with pytest.raises(K.VersionConflict):
        K.refresh_together(spark, base, {"y": numbers(spark, 7)}, attempts=2)


def test_a_failure_keeps_every_table(spark, tmp_path):
    base = str(tmp_path)
    assert K.current_version(spark, base) == (0, {}) and K.read_version(spark, base) == {}
    K.refresh_together(spark, base, {"a": numbers(spark, 1), "b": numbers(spark, 1)})
    broken = numbers(spark, 2).select(F.raise_error(F.lit("broken")).cast("long").alias("a"))
    with pytest.raises(PySparkException):
        K.refresh_together(spark, base, {"a": numbers(spark, 2), "b": broken})
    tables = K.read_version(spark, base)
    assert values(tables["a"]) == values(tables["b"]) == [1]


def test_earlier_versions_partitions_and_removal(spark, tmp_path):
    base = str(tmp_path)
    days = spark.range(20).select((F.col("id") % 4).alias("day"), "id")
    for _ in range(3):
        K.refresh_together(spark, base, {"t": days, "empty": days.limit(0)}, {"t": ["day"]})
    K.refresh_together(spark, base, {"t": numbers(spark, 1)})
    assert K.read_version(spark, base, 3)["t"].columns == ["day", "id"]
    assert K.read_version(spark, base)["empty"].count() == 0
    assert K.remove_versions(spark, base, keep=2) == 4
    assert K.read_version(spark, base, 3)["t"].count() == 20 and values(K.read_version(spark, base)["t"]) == [1]
    with pytest.raises(ValueError):
        K.read_version(spark, base, 9)


def test_a_rename_does_not_replace(spark, tmp_path):
    """The way for file systems without hard links."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    for name in ("one", "two"):
        (tmp_path / name).write_text(name)
    target = path(f"file:{tmp_path}/target")
    assert K._renamed(spark, path(f"file:{tmp_path}/one"), target)
    assert not K._renamed(spark, path(f"file:{tmp_path}/two"), target)
    assert (tmp_path / "target").read_text() == "one"
