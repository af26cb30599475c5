"""Entries and results as streams against the same tables joined as a batch."""

import datetime
import random

from paddock.streaming import live
from paddock.streaming import results as R

ENTRY, RESULT = "race_id long, horse_id long, off_at timestamp", "race_id long, horse_id long, position int, received_at timestamp"
START = datetime.datetime(2024, 5, 1, 12)


def day(x):
    return START + datetime.timedelta(days=x)


def write(spark, path, batches, schema):
    for some in batches:
        spark.createDataFrame(some, schema).coalesce(1).write.mode("append").parquet(path)


def stream(spark, tmp_path, name):
    entries = live.stream_files(spark, str(tmp_path / "entries"), ENTRY, files_per_trigger=1)
    results = live.stream_files(spark, str(tmp_path / "results"), RESULT, files_per_trigger=1)
    out = R.with_late_results(entries, results, ["race_id", "horse_id"], "off_at", "received_at")
    query = out.writeStream.format("parquet").option("path", str(tmp_path / name)).option("checkpointLocation", str(tmp_path / f"{name}-check")).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def test_streams_give_what_the_batch_gives(spark, tmp_path):
    rng = random.Random(8)
    entries, results = [], []
    for d in range(30):
        entries.append([(d * 10 + r, h, day(d)) for r in range(2) for h in range(3)])
        # some results come the same day, some days later, some too late, some never
        results.append([(x * 10 + r, h, rng.randrange(1, 9), day(d) + datetime.timedelta(hours=1)) for x in range(max(0, d - 9), d + 1) for r in range(2) for h in range(3) if (x * 7 + r * 3 + h * 5) % 11 == d - x])
    write(spark, str(tmp_path / "entries"), entries, ENTRY)
    write(spark, str(tmp_path / "results"), [x for x in results if x], RESULT)
    query = stream(spark, tmp_path, "out")
    read = lambda name: spark.read.parquet(str(tmp_path / name))
    got = sorted(map(tuple, read("out").collect()), key=str)
    batch = R.settled_results(read("entries"), read("results"), ["race_id", "horse_id"], "off_at", "received_at")
    assert got == sorted(map(tuple, batch.select(*read("out").columns).collect()), key=str)
    without = [r for r in got if r[3] is None]
    assert without and len(got) - len(without) > 50 and max(r[2] for r in without) < day(30 - 7)
    assert R.rows_left_out(query) == 0
    assert R.rows_in_state(query) < 6 * 2 * 11  # the last days only


def test_rows_behind_the_watermark_are_counted(spark, tmp_path):
    write(spark, str(tmp_path / "entries"), [[(1, 1, day(0))], [(2, 1, day(40))], [(3, 1, day(41))], [(4, 1, day(1))]], ENTRY)
    write(spark, str(tmp_path / "results"), [[(1, 1, 1, day(0.1))], [(2, 1, 2, day(40.1))], [(3, 1, 3, day(41.1))], [(9, 9, 9, day(2))]], RESULT)
    query = stream(spark, tmp_path, "out")
    got = sorted((r["race_id"], r["position"]) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [(1, 1), (2, 2), (3, 3)] and R.rows_left_out(query) == 2
