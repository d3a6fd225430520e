"""Streams run to the end over landed files, and agree with batch."""

import datetime
import json
import uuid

from pyspark.sql import functions as F

from echotide.operators.select import dedup_keep_first
from echotide.plans.catalog import QUERIES
from echotide.schemas import LANDED_REVIEW
from echotide.streaming import reviews as st

DAILY = "day date, platform string, n_negative long, n_reviews long"
T0 = datetime.datetime(2025, 12, 1)


def land(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(
        "\n".join(
            json.dumps({"review_id": i, "platform": p, "ts": (T0 + datetime.timedelta(hours=h))
                        .isoformat() + "Z", "text": "x", "sentiment": s})
            for i, p, h, s in rows
        )
    )


def test_runs_go_on_and_drop_what_was_seen(spark, tmp_path):
    name, out = uuid.uuid4().hex, str(tmp_path / "out")

    def run():
        stream = st.stream_floor(st.stream_reviews(spark, str(tmp_path / "in")), "ts", "2025-12-01")
        st.append_once(st.stream_dedup(stream, delay="2 days"), name, out).awaitTermination()
        return {(r["platform"], r["review_id"]): r["ts"] for r in spark.read.parquet(out).collect()}

    land(tmp_path / "in", "1.json", [("a", "P", 1, "Negative"), ("b", "P", 2, "Positive"),
                                     ("old", "P", -1, "Positive")])
    assert set(run()) == {("P", "a"), ("P", "b")}
    land(tmp_path / "in", "2.json", [("a", "P", 3, "Negative"), ("a", "Q", 3, "Negative"),
                                     ("c", "P", 200, "Negative")])
    got = run()
    assert set(got) == {("P", "a"), ("P", "b"), ("Q", "a"), ("P", "c")}
    assert got["P", "a"] == T0 + datetime.timedelta(hours=1)
    # Far behind the watermark now: late rows are left out.
    land(tmp_path / "in", "3.json", [("late", "P", 5, "Negative"), ("d", "P", 201, "Positive")])
    assert set(run()) == {("P", "a"), ("P", "b"), ("Q", "a"), ("P", "c"), ("P", "d")}
    assert set(run()) == set(got) | {("P", "d")}  # nothing new landed


def test_daily_counts_grow_over_runs_and_match_batch(spark, tmp_path):
    name, out = uuid.uuid4().hex, str(tmp_path / "out")

    def run():
        stream = st.stream_reviews(spark, str(tmp_path / "in"), files_per_trigger=1)
        daily = st.stream_daily_negativity(stream.withWatermark("ts", "30 days"), by=["platform"])
        st.upsert_once(daily, name, out, ["day", "platform"]).awaitTermination()
        return st.written(spark, out, DAILY)

    def batch():
        landed = spark.read.schema(LANDED_REVIEW).json(str(tmp_path / "in"))
        return st.stream_daily_negativity(landed, by=["platform"])

    for i in range(4):
        rows = [(str(j), "PQ"[j % 2], 7 * j + i, ["Negative", "positive", None][(i + j) % 3])
                for j in range(12)]
        land(tmp_path / "in", f"{i}.json", rows)
        if i % 2:
            got, want = run(), batch()
            assert got.exceptAll(want.select(*got.columns)).count() == 0
            assert got.count() == want.count()
    months = st.months_of_days(batch()).collect()
    assert [(r["month"], r["n_reviews"]) for r in months] == [(datetime.date(2025, 12, 1), 48)]


def test_counts_have_one_version_per_day(spark, tmp_path):
    """However many runs there are, days bound the folders."""
    landed, out = tmp_path / "landed", tmp_path / "out"
    for turn in range(4):
        spark.sql(
            f"""select id, 'p' platform, timestamp '2026-01-01 05:00:00' + make_interval(0, 0, 0,
                cast(id % 3 as int)) ts, 'x' text, 'Negative' sentiment from range({10 + turn})"""
        ).withColumnRenamed("id", "review_id").withColumn(
            "review_id", F.col("review_id").cast("string")
        ).write.mode("append").json(str(landed))
        stream = st.stream_reviews(spark, str(landed))
        counts = st.stream_daily_negativity(stream.withWatermark("ts", "7 days"))
        name = f"days-{tmp_path.name}"
        st.upsert_once(counts, name, str(out)).awaitTermination()
    folders = [x.name for x in out.iterdir() if x.is_dir() and not x.name.startswith("_")]
    assert len(folders) == 3
    assert sum(r["n_reviews"] for r in st.written(spark, str(out), DAILY).collect()) == 46


def test_batch_twin_of_dedup(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    stream = st.stream_reviews(
        spark, sf, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string",
        format="parquet", pathGlobFilter="events.parquet",
    )
    out = spark.conf.get("spark.checkpoint.dir") + "/" + uuid.uuid4().hex
    kept = st.stream_dedup(stream, ["event_type"], delay="60 days").select("event_type")
    st.append_once(kept, uuid.uuid4().hex, out).awaitTermination()
    want = dedup_keep_first(events, ["event_type"], ["ts"]).select("event_type")
    got = spark.read.parquet(out)
    assert sorted(r[0] for r in got.collect()) == sorted(r[0] for r in want.collect())


def test_tables_of_either_layout(spark, sf, tmp_path):
    """A table is a file or a folder of files; the queries read all of both."""
    events = spark.read.parquet(f"{sf}/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    for name in ("stream_daily", "stream_dedup"):
        one, many = (QUERIES[name](spark, str(d)) for d in (sf, tmp_path))
        assert one.count() == many.count() > 0
        assert one.exceptAll(many).isEmpty() and many.exceptAll(one).isEmpty()


def test_no_input_gives_no_rows(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet")
    events.limit(0).write.parquet(str(tmp_path / "events.parquet"))
    for name in ("stream_daily", "stream_dedup"):
        assert QUERIES[name](spark, str(tmp_path)).collect() == []
    stream = st.stream_reviews(spark, str(tmp_path / "events.parquet"), format="parquet")
    out = str(tmp_path / "out")
    st.append_once(stream, uuid.uuid4().hex, out).awaitTermination()
    assert st.written(spark, out, stream.schema).collect() == []
    assert st.written(spark, str(tmp_path / "never"), stream.schema).collect() == []


def test_budget_lasts_over_triggers(spark, tmp_path):
    """A hot group, one not named, ties in time and a budget that is used up early."""
    landed, out, name = tmp_path / "landed", str(tmp_path / "out"), uuid.uuid4().hex
    rows = []
    for turn in range(3):
        batch = [("hot", turn * 10 + i // 100, turn * 1000 + i) for i in range(1000)]
        batch += [("rare", turn, 9000 + turn), ("other", turn, 9100 + turn), (None, turn, 9200 + turn)]
        rows += batch
        df = spark.createDataFrame(batch, "app string, at long, id long")
        df.repartition(7).write.mode("append").parquet(str(landed))
        stream = st.stream_reviews(
            spark, str(landed), "app string, at long, id long", format="parquet"
        )
        kept = st.stream_budget(stream, ["app"], ["at", "id"], {"hot": 1500, "rare": 2})
        st.append_once(kept, name, out).awaitTermination()
    got = sorted(map(tuple, st.written(spark, out, kept.schema).collect()))
    hot = sorted(r for r in rows if r[0] == "hot")[:1500]
    assert got == sorted(hot + [("rare", 0, 9000), ("rare", 1, 9001)])


def test_budget_without_keys_and_with_null_groups(spark, tmp_path):
    landed = tmp_path / "landed"
    far = 2**60  # beyond what a double holds
    rows = [(None if i % 3 else "a", i % 5, far + i) for i in range(50)]
    schema = "app string, at long, id long"
    late = spark.createDataFrame([("b", 9, None)], schema)
    spark.createDataFrame(rows, schema).union(late).repartition(3).write.parquet(str(landed))

    def run(keys, n):
        stream = st.stream_reviews(spark, str(landed), schema, format="parquet")
        kept = st.stream_budget(stream, keys, ["at", "id"], n)
        out = str(tmp_path / uuid.uuid4().hex)
        st.append_once(kept, uuid.uuid4().hex, out).awaitTermination()
        return {r["id"] for r in st.written(spark, out, kept.schema).collect()}

    ranked = sorted(rows, key=lambda r: r[1:])
    assert run([], 7) == {r[2] for r in ranked[:7]}
    assert run(["app"], 4) == {None} | {
        r[2] for app in ("a", None) for r in [x for x in ranked if x[0] == app][:4]
    }
