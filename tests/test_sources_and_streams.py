import json

from pyspark.sql import functions as F

from paddock.plans.views import Views
from paddock.sources import documents, sinks
from paddock.streaming import live

CARD = {"race_id": "r1", "course_id": "c1", "course": "Ascot", "region": "GB", "race_name": "Cup", "date": "2024-05-01", "type": "Flat", "surface": "Turf", "going": "Good", "race_class": "Class 3", "distance": "2m4f", "distance_f": "20", "prize": "£4,187",
        "runners": [{"horse_id": "h1", "horse": "A (IRE)", "jockey_id": "", "trainer_id": "t1", "lbs": "126", "ofr": "–", "age": "4"}, {"horse_id": "", "horse": "nobody"}]}
RESULT = {"race_id": "r1", "course": "Ascot", "date": "2024-05-01", "class": "Class 3", "dist": "2m4f", "dist_m": "4000",
          "runners": [{"horse_id": "h1", "position": "1", "btn": "0", "sp": "13/8F", "sp_dec": "2.63", "time": "4:20.5", "or": "66", "weight_lbs": "126"}, {"horse_id": "h2", "position": "PU", "sp": ""}]}


def write(path, rows):
    path.write_text("".join(json.dumps(r) + "\n" for r in rows) + "not json\n")
    return str(path)


def test_documents_become_tables(spark, tmp_path):
    cards = documents.read_documents(spark, write(tmp_path / "cards.json", [CARD, {"race_id": ""}]), documents.CARD_SCHEMA)
    race = documents.card_races(cards).collect()
    assert len(race) == 1 and (race[0].race_class, race[0].distance_m, race[0].prize, race[0].field_size, race[0].has_result) == (3, 4022, 4187.0, 2, False)
    runner = documents.card_runners(cards).collect()
    assert len(runner) == 1 and (runner[0].jockey_id, runner[0].weight_lbs, runner[0].ofr, runner[0].is_scratched) == (None, 126, None, False)
    results = documents.read_documents(spark, write(tmp_path / "results.json", [RESULT]), documents.RESULT_SCHEMA)
    assert documents.result_races(results).first().winning_time == "4:20.5"
    rows = {r.horse_id: r for r in documents.result_runners(results, "2024-05-01 18:00:00").collect()}
    assert (rows["h1"].position, rows["h1"].distance_beaten, rows["h1"].time_seconds, rows["h1"].ofr) == (1, "0", 260.5, 66)
    assert rows["h2"].position is None and rows["h2"].did_not_finish and rows["h2"].result_updated_at is None and rows["h1"].result_updated_at is not None


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, p string")
    sinks.append(df, str(tmp_path / "t"))
    sinks.append(df, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 4
    sinks.replace_partitions(df, str(tmp_path / "p"), ["p"])
    sinks.replace_partitions(spark.createDataFrame([(9, "a")], "k int, p string"), str(tmp_path / "p"), ["p"])
    assert {(r.k, r.p) for r in spark.read.parquet(str(tmp_path / "p")).collect()} == {(9, "a"), (2, "b")}
    sinks.log_run(spark, str(tmp_path / "log"), "races", "insert", 3)
    assert spark.read.parquet(str(tmp_path / "log")).first().records_processed == 3
    sinks.write_json(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 2


def test_live_upsert_takes_the_latest(spark, tmp_path):
    source = tmp_path / "in"
    rows = [("r", "h", None, 1), ("r", "g", None, 1)], [("r", "h", 2, 3)], [("r", "h", 5, 2)]
    for i, some in enumerate(rows):
        spark.createDataFrame(some, "race_id string, horse_id string, position int, at int").coalesce(1).write.mode("append").parquet(str(source))
        stream = live.stream_files(spark, str(source), "race_id string, horse_id string, position int, at int")
        live.live_upsert(stream, str(tmp_path / "out"), str(tmp_path / "check"), ["race_id", "horse_id"], "at").awaitTermination()
    got = {r.horse_id: r.position for r in live.latest_version(spark, str(tmp_path / "out")).collect()}
    assert got == {"h": 2, "g": None}


def test_streamed_windows_equal_the_batch(spark, tmp_path):
    runs = Views(spark, "/root/testdata/sf0.001").runs.select("jockey_id", "position", F.col("race_date").cast("timestamp").alias("at")).where("jockey_id < 3")
    runs.coalesce(1).write.parquet(str(tmp_path / "runs"))
    stream = live.rolling_form(live.stream_files(spark, str(tmp_path / "runs"), runs.schema), "jockey_id", "at", late="10000 days", slide="10 days")
    stream.writeStream.format("memory").queryName("form").outputMode("complete").trigger(availableNow=True).start().awaitTermination()
    batch = live.rolling_form(spark.read.parquet(str(tmp_path / "runs")), "jockey_id", "at", slide="10 days")
    assert sorted(map(tuple, spark.table("form").collect())) == sorted(map(tuple, batch.collect()))


def test_new_entities_come_once(spark, tmp_path):
    spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "id string, n int").withColumn("at", F.timestamp_seconds("n")).coalesce(1).write.parquet(str(tmp_path / "e"))
    stream = live.new_entities(live.stream_files(spark, str(tmp_path / "e"), "id string, n int, at timestamp"), "id", "at")
    stream.writeStream.format("memory").queryName("fresh").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    assert sorted(r.id for r in spark.table("fresh").collect()) == ["a", "b"]


def test_live_upsert_goes_on_with_a_new_checkpoint(spark, tmp_path):
    schema = "id string, value int, at int"
    for i, some in enumerate(([("a", 1, 1), ("b", 1, 1)], [("a", 2, 2)], [("c", 3, 1), ("a", 0, 0)])):
        spark.createDataFrame(some, schema).coalesce(1).write.parquet(str(tmp_path / f"in{i}"))
        stream = live.stream_files(spark, str(tmp_path / f"in{i}"), schema)
        live.live_upsert(stream, str(tmp_path / "out"), str(tmp_path / f"check{i}"), ["id"], "at").awaitTermination()
    assert sorted(map(tuple, live.latest_version(spark, str(tmp_path / "out")).collect())) == [("a", 2, 2), ("b", 1, 1), ("c", 3, 1)]


def test_only_ids_that_are_not_known_are_added(spark, tmp_path):
    known, source = str(tmp_path / "known"), str(tmp_path / "source")
    spark.createDataFrame([("a", 1)], "id string, n int").write.parquet(known)
    for some in ([("a", 5), ("b", 2), ("b", 2)], [("b", 7), ("c", 3)]):
        spark.createDataFrame(some, "id string, n int").coalesce(1).write.mode("append").parquet(source)
        live.enrich_new(live.stream_files(spark, source, "id string, n int"), known, str(tmp_path / "check"), "id").awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(known).collect())) == [("a", 1), ("b", 2), ("c", 3)]


def test_the_last_week_is_read_again(spark):
    import datetime

    day = datetime.date(2024, 5, 20)
    old = spark.createDataFrame([(1, day, "x"), (2, day - datetime.timedelta(30), "x")], "id int, day date, v string")
    again = spark.createDataFrame([(1, day, "y"), (2, day - datetime.timedelta(30), "y"), (3, day, "y")], "id int, day date, v string")
    assert sorted((r.id, r.v) for r in sinks.reconcile_recent(old, again, ["id"], "day", day).collect()) == [(1, "y"), (2, "x"), (3, "y")]


def test_course_documents_get_coordinates(spark, tmp_path):
    (tmp_path / "c.json").write_text('{"id": "c1", "course": "Dundalk-AW", "region_code": "ire", "region": "Eire"}\n{"id": " ", "course": "x"}\n{"id": "c2", "course": "Nowhere", "region": "Eire"}\n{"id"')
    file = spark.createDataFrame([("Dundalk", "EIRE", 54.0, -6.4)], "name string, region string, latitude double, longitude double")
    got = documents.course_rows(documents.read_documents(spark, str(tmp_path), documents.COURSE_SCHEMA), file).collect()
    assert sorted((r.id, r.name, r.latitude) for r in got) == [("c1", "Dundalk-AW", 54.0), ("c2", "Nowhere", None)]


def test_columns_are_filled_alone_or_together(spark):
    rows = spark.createDataFrame([(1, None, "", "x"), (2, "a", None, "y"), (3, "", None, "z")], "k int, a string, b string, other string")
    other = spark.createDataFrame([(i, "A", "B") for i in (1, 2, 3)], "k int, a string, b string")
    get = lambda **x: sorted(map(tuple, sinks.fill_missing(rows, other, "k", ["a", "b"], **x).collect()))
    assert get() == [(1, "A", "", "x"), (2, "a", "B", "y"), (3, "", "B", "z")]
    assert get(blank=True) == [(1, "A", "B", "x"), (2, "a", "B", "y"), (3, "A", "B", "z")]
    assert get(blank=True, together=True) == [(1, "A", "B", "x"), (2, "A", "B", "y"), (3, "A", "B", "z")]
    some = other.where("k < 3").withColumn("b", F.lit(None).cast("string"))
    got = sinks.fill_missing(rows, some, "k", ["a", "b"], together=True).collect()
    assert sorted(map(tuple, got)) == [(1, "A", None, "x"), (2, "A", None, "y"), (3, "", None, "z")]
