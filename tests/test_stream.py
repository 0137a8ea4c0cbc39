"""The live feed: restarts, order inside a micro-batch, agreement with the batch operator."""

import json
import random

import pytest

from core_helpers import rows
from roadlens.operators import dedup
from roadlens.sinks import batches
from roadlens.sources import feed
from roadlens.streaming import changes


def alert(kind, millis, lat=-33.5, subtype=None, street="S"):
    return {"type": kind, "subtype": subtype, "street": street, "city": "C",
            "pubMillis": millis, "location": {"x": -70.5, "y": lat}}


class Feed:
    def __init__(self, spark, root):
        self.spark, self.root, self.polls = spark, root, 0
        (root / "landing").mkdir()

    def land(self, *alerts, poll=True):
        half = len(alerts) // 2
        payload = {"alerts": alerts[:half], "traffic": alerts[half:]}
        if poll:
            payload["poll"] = self.polls
        (self.root / "landing" / f"{self.polls:05d}.json").write_text(json.dumps(payload))
        self.polls += 1

    def run(self, **options):
        changes.start_ingest(self.spark, f"{self.root}/landing", f"{self.root}/store",
                             f"{self.root}/checkpoint", available_now=True,
                             **options).awaitTermination()
        return self.spark.read.schema(changes.EVENTS).parquet(f"{self.root}/store")


@pytest.fixture
def live(spark, tmp_path):
    return Feed(spark, tmp_path)


def test_restart_keeps_the_last_seen_stamps(live):
    live.land(alert("JAM", 1000), alert("P", 1000))
    assert live.run().count() == 2
    live.land(alert("JAM", 1000), alert("P", 2000))
    got = live.run()
    assert got.count() == 3
    assert got.filter("tipo = 'P'").count() == 2
    live.land(alert("P", 1000))
    assert live.run().count() == 4


def test_a_b_a_emits_three_in_one_micro_batch(live):
    for millis in (1000, 2000, 2000, 1000):
        live.land(alert("JAM", millis))
    assert [h for h in sorted(r.hora for r in live.run().collect())] == [
        "1970-01-01T00:00:01", "1970-01-01T00:00:01", "1970-01-01T00:00:02"]


def test_repeats_inside_one_poll(live):
    live.land(*[alert("JAM", m) for m in (1000, 1000, 2000, 1000)])
    live.land(*[alert("JAM", m) for m in (1000, 1000)])
    assert live.run().count() == 3


def test_payload_without_poll_number(live):
    live.land(alert("JAM", 1000), poll=False)
    live.land(alert("JAM", 1000), alert("P", None), poll=False)
    assert live.run().count() == 2


def test_plain_ingest_keeps_everything(live):
    live.land(alert("JAM", 1000), alert("JAM", 1000))
    live.land(alert("JAM", 1000))
    assert live.run(changes_only=False).count() == 3


@pytest.mark.parametrize("arrow_rows", [10_000, 3])
def test_stream_equals_batch_with_a_hot_key(spark, live, arrow_rows):
    """One key holds a third of the rows; small Arrow batches split the polls."""
    draw = random.Random(11)
    for _ in range(12):
        live.land(*[alert("HOT" if i % 3 == 0 else draw.choice(["A", "B", None]),
                          draw.choice([1000, 2000, 2500]), subtype=draw.choice(["s", None]),
                          street=str(draw.random()))
                    for i in range(30)])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", arrow_rows)
    try:
        streamed = live.run()
        got = rows(streamed)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    arrived = feed.flatten_in_order(feed.read_feed(spark, f"{live.root}/landing"))
    numbered = arrived.withColumn("seq", arrived.poll * 1000 + arrived.pos)
    batch = dedup.change_only(numbered, ["clave"], "seq", chunk_rows=2000)
    assert got == rows(batch.select(streamed.columns))


def test_stream_in_several_micro_batches(live):
    for millis in (1000, 1000, 2000, 2000, 1000):
        live.land(alert("JAM", millis))
        live.run(max_files=1)
    assert live.run(max_files=1).count() == 3


def test_state_function_compares_columns():
    import inspect

    source = inspect.getsource(changes)
    assert "json.loads" not in source and "iterrows" not in source and "itertuples" not in source


def test_a_time_to_live_needs_a_running_stream(live):
    with pytest.raises(ValueError, match="running"):
        live.run(ttl_seconds=60)


def test_a_timed_out_key_is_removed():
    class State:
        hasTimedOut, removed = True, False

        def remove(self):
            self.removed = True

    state = State()
    assert list(changes._emitter(1000)(("k", ""), iter(()), state)) == [] and state.removed


def test_a_poll_delivered_again_leaves_no_second_copy(live):
    """Another file name, in the same micro-batch, in a later one, and after a restart; another poll of equal content stays."""
    live.land(alert("JAM", 1000), alert("P", 1000))
    again = (live.root / "landing" / "00000.json").read_text()
    (live.root / "landing" / "copy.json").write_text(again)
    assert live.run(changes_only=False).count() == 2
    (live.root / "landing" / "later.json").write_text(again)
    live.land(alert("JAM", 1000), alert("P", 1000))
    assert live.run(changes_only=False).count() == 4
    (live.root / "landing" / "last.json").write_text(again)
    live.land(alert("Q", 1))
    assert live.run(changes_only=False, max_files=1).count() == 5


def test_a_replayed_poll_does_not_bring_back_an_old_stamp(live):
    live.land(alert("JAM", 1000))
    live.land(alert("JAM", 2000))
    assert live.run().count() == 2
    (live.root / "landing" / "copy.json").write_text((live.root / "landing" / "00000.json").read_text())
    assert live.run().count() == 2


@pytest.mark.parametrize("broken", ["store", "seen", "polls"])
def test_a_crash_anywhere_inside_a_batch_adds_nothing_twice(live, monkeypatch, broken):
    """The batch runs again after its store, the last stamps or the poll digests were written, but not committed."""
    live.land(alert("JAM", 1000), alert("P", 1000))
    live.run()
    live.land(alert("JAM", 2000), alert("P", 1000), alert("Q", 5))
    live.land(alert("JAM", 3000))
    with monkeypatch.context() as m:
        append, put = changes.append_batch, changes.LastValues.put

        def failing_append(*args):
            append(*args)
            raise RuntimeError("crash")

        def failing_put(self, *args):
            put(self, *args)
            if self.key == {"seen": "clave", "polls": "digest"}[broken]:
                raise RuntimeError("crash")

        if broken == "store":
            m.setattr(changes, "append_batch", failing_append)
        else:
            m.setattr(changes.LastValues, "put", failing_put)
        with pytest.raises(Exception, match="crash"):
            live.run()
    got = live.run()
    assert sorted(r.hora for r in got.filter("tipo = 'JAM'").collect()) == [f"1970-01-01T00:00:0{i}" for i in (1, 2, 3)]
    assert got.count() == 5
    assert live.run().count() == 5


def test_files_half_moved_are_moved_on(spark, tmp_path):
    """A crash while a whole batch is being moved into the store."""
    store = str(tmp_path / "store")
    df = spark.range(100).repartition(4)
    batches.append_batch(df, store, "w", 0)
    df.selectExpr("id + 100 AS id").write.parquet(f"{store}/_w-1")
    first = next(p for p in (tmp_path / "store" / "_w-1").iterdir() if p.name.startswith("part-"))
    first.rename(tmp_path / "store" / first.name)
    batches.append_batch(spark.range(7), store, "w", 1)  # not computed again: the batch was whole
    assert sorted(r.id for r in spark.read.parquet(store).collect()) == list(range(200))
    batches.append_batch(spark.range(200, 201), store, "w", 2)
    assert spark.read.parquet(store).count() == 201


def test_last_values_are_those_of_the_batches_before(spark, tmp_path):
    """Against a dictionary, over put-together tables, a repeated batch and a least stamp."""
    table = batches.LastValues(str(tmp_path / "t"), "k", "v string", buckets=3, compact_after=3)
    draw, held, history = random.Random(2), {}, []
    for n in range(11):
        history.append(dict(held))
        new = {draw.choice("abcdefgh"): (f"v{n}", n) for _ in range(3)}
        held.update(new)
        df = spark.createDataFrame([(k, v, s) for k, (v, s) in new.items()], "k string, v string, stamp bigint")
        for _ in range(2 if n in (3, 6, 7) else 1):
            got = {r.k: (r.v, r.stamp) for r in table.before(spark, n).collect()}
            assert got == history[n]
            table.put(df, n)
    assert {r.k: (r.v, r.stamp) for r in table.before(spark, 11).collect()} == held
    assert {r.k for r in table.before(spark, 11, 8).collect()} == {k for k, (_, s) in held.items() if s >= 8}
    assert len(list((tmp_path / "t" / "kind=delta").iterdir())) <= 8


def test_old_keys_are_forgotten_by_the_newest_file(spark, live):
    """The time-to-live counts from the newest file of a micro-batch."""
    ingest = changes.Ingest(f"{live.root}/store", f"{live.root}/checkpoint", ttl_seconds=60)
    ingest._writer = "w"

    def batch(number, millis, landed):
        payload = [([alert("JAM", millis)], None, number, landed, f"f{number}", True)]
        schema = changes.FEED + ", landed bigint, file string, numbered boolean"
        ingest(spark.createDataFrame(payload, schema), number)
        return spark.read.schema(changes.EVENTS).parquet(f"{live.root}/store").count()

    assert [batch(0, 1000, 0), batch(1, 1000, 50_000), batch(2, 1000, 100_000), batch(3, 1000, 200_000)] == [1, 1, 1, 2]


def test_ingest_runs_without_python_on_the_executors(spark, live):
    ingest = changes.Ingest(f"{live.root}/store", f"{live.root}/checkpoint")
    live.land(alert("JAM", 1000))
    rows_ = feed.flatten_in_order(feed.read_feed(spark, f"{live.root}/landing"))
    rows_ = rows_.withColumn("seq", changes.arrival(rows_.poll, rows_.pos))
    text = ingest._changed(rows_, 10, 0, None)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Pandas" not in text and "Arrow" not in text
