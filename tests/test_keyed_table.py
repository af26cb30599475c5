"""The keyed table against the plain merge, and what its changes write and leave behind."""

import json
import os
import random

import pytest

from paddock.sources import keyed_table as K
from paddock.sources import sinks
from paddock.streaming import live

SCHEMA = "k string, part int, value int, at int"


def rows(spark, some):
    return spark.createDataFrame(some, SCHEMA)


def size(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


def content(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_changes_give_what_the_plain_merge_gives(spark, tmp_path):
    rng = random.Random(2)
    table = K.KeyedTable(spark, str(tmp_path / "t"), ["k", "part"], "at", ["value"], buckets=5)
    want = rows(spark, [])
    for step in range(6):
        some = [(rng.choice([None, *"abcdefgh"]), rng.randrange(3), rng.randrange(100), rng.randrange(6)) for _ in range(rng.randrange(1, 30))]
        want = sinks.upsert(want, rows(spark, some), ["k", "part"], "at", ["value"])
        table.apply(rows(spark, some), f"batch {step}")
        table.apply(rows(spark, [("a", 0, -1, 99)]), f"batch {step}")  # a repeated batch is left out
        if step in (2, 4):
            assert table.compact(most=3) is not None
            table.vacuum()
        assert content(table.read()) == content(want)
    while table.compact(most=2):
        assert content(table.read()) == content(want)
    assert all(len(x) == 1 for x in table.manifest()["layers"].values())
    asked = rows(spark, [("a", 0, 0, 0), ("zz", 9, 0, 0)])
    assert content(table.lookup(asked)) == content(want.join(asked.select("k", "part"), ["k", "part"], "left_semi").select("k", "part", "value", "at"))


def test_a_small_batch_writes_few_bytes(spark, tmp_path):
    path = str(tmp_path / "t")
    table = K.KeyedTable(spark, path, ["k"], "at", buckets=16)
    table.apply(spark.range(200_000).selectExpr("cast(id as string) as k", "1 as part", "cast(id * 7919 % 1000003 as int) as value", "0 as at"))
    whole = size(path)
    table.apply(rows(spark, [("17", 1, 5, 1)]))
    assert size(path) - whole < 4_000 < whole / 100
    assert table.lookup(rows(spark, [("17", 0, 0, 0)])).first()["value"] == 5 and table.read().count() == 200_000
    plan = table.read()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Union") == 1  # 15 buckets come as they are, one is merged


def test_a_killed_batch_leaves_the_table_as_it_was(spark, tmp_path, monkeypatch):
    table = K.KeyedTable(spark, str(tmp_path / "t"), ["k"], "at", buckets=4)
    table.apply(rows(spark, [("a", 1, 1, 1)]))
    with monkeypatch.context() as m:
        m.setattr(K.KeyedTable, "_commit", lambda *a, **b: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            table.apply(rows(spark, [("a", 1, 2, 2)]))
    assert content(K.KeyedTable(spark, str(tmp_path / "t")).read()) == [("a", 1, 1, 1)]
    assert [n for n in table.vacuum() if n.startswith("layer-")] and content(table.read()) == [("a", 1, 1, 1)]
    table.apply(rows(spark, [("a", 1, 2, 2)]))
    assert content(table.read()) == [("a", 1, 2, 2)]


def test_old_files_go_and_two_writers_do_not_mix(spark, tmp_path):
    table = K.KeyedTable(spark, str(tmp_path / "t"), ["k"], "at", buckets=1)
    for i in range(5):
        table.apply(rows(spark, [("a", 1, i, i)]))
    before = table.manifest()
    table.compact()
    table.vacuum(keep=1)
    assert len([n for n in os.listdir(tmp_path / "t") if n.startswith(("layer", "manifest"))]) == 2
    with pytest.raises(FileExistsError):
        table._commit(before, layers={})
    assert content(table.read()) == [("a", 1, 4, 4)]
    with pytest.raises(ValueError, match="has keys"):
        K.KeyedTable(spark, str(tmp_path / "t"), ["part"], "at")
    with pytest.raises(FileNotFoundError):
        K.KeyedTable(spark, str(tmp_path / "none"))


def test_streamed_batches_are_layers_until_they_are_folded(spark, tmp_path):
    for i in range(4):
        rows(spark, [("a", 1, i, i), (f"k{i}", 1, i, i)]).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = live.stream_files(spark, str(tmp_path / "in"), SCHEMA, files_per_trigger=1)
    live.live_upsert(stream, str(tmp_path / "t"), str(tmp_path / "check"), ["k"], "at", compact_after=4).awaitTermination()
    got = {r["k"]: r["value"] for r in live.latest_version(spark, str(tmp_path / "t")).collect()}
    assert got == {"a": 3, "k0": 0, "k1": 1, "k2": 2, "k3": 3}
    newest = max(n for n in os.listdir(tmp_path / "t") if n.startswith("manifest"))
    manifest = json.loads((tmp_path / "t" / newest).read_text())
    assert len(manifest["tokens"]) == 4 and max(len(x) for x in manifest["layers"].values()) == 1
