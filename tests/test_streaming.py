import json
import time

import pytest
from pyspark.sql import functions as F

from stopwise.operators import constraints
from stopwise.sources import envelopes
from stopwise.streaming import events, jobs, progress, sinks
from tests.events import envelope, event

JOBS = {"vehicle": ("vehicle-state", 1), "trip": ("trip-update", 2), "alert": ("service-alert", 2)}


def drop(spark, folder, name, items, offset=0):
    """Place one file of envelope rows into a stream folder."""
    rows = envelope(spark, items).withColumn("offset", F.col("offset") + offset)
    folder.mkdir(exist_ok=True)
    lines = [json.dumps(row.asDict(), default=str) for row in rows.collect()]
    (folder / f"{name}.json").write_text("\n".join(lines))


def run(spark, job, base):
    raw = envelopes.read_envelope_stream(spark, str(base / "in"))
    query = jobs.start(
        raw,
        job,
        target=str(base / "out"),
        checkpoint=str(base / "checkpoint"),
        trigger={"availableNow": True},
    )
    query.awaitTermination()
    return query


@pytest.mark.parametrize("kind", sorted(JOBS))
def test_duplicates_and_restarts_store_each_event_once(spark, tmp_path, kind):
    name, rows = JOBS[kind]
    job = jobs.JOBS[name]
    first = event(kind)
    drop(spark, tmp_path / "in", "1", [first, first, event(kind, event_id=" ")])
    query = run(spark, job, tmp_path)
    assert sinks.read_keyed(spark, str(tmp_path / "out")).count() == rows
    # The same event again, after a restart, in another batch.
    drop(spark, tmp_path / "in", "2", [first], offset=10)
    again = run(spark, job, tmp_path)
    assert again.id == query.id
    assert sinks.read_keyed(spark, str(tmp_path / "out")).count() == rows
    drop(spark, tmp_path / "in", "3", [event(kind, event_id="new")], offset=20)
    run(spark, job, tmp_path)
    table = sinks.read_keyed(spark, str(tmp_path / "out"))
    assert table.count() == 2 * rows
    assert sorted(table.columns) == sorted(constraints_columns(spark, job))


def constraints_columns(spark, job):
    return jobs.table_rows(envelope(spark, []), job).columns


def test_a_batch_written_twice_replaces_itself(spark, tmp_path):
    job = jobs.JOBS["trip-update"]
    target = str(tmp_path / "t")
    key = constraints.KEYS[job.table]

    def append(items, batch_id, run="r"):
        rows = jobs.table_rows(envelope(spark, items), job)
        sinks.append_keyed(rows, batch_id, target=target, run=run, keys=key, table=job.table)
        return sinks.read_keyed(spark, target).count()

    assert append([event("trip")], 0) == 2
    assert append([event("trip")], 0) == 2
    assert append([event("trip"), event("trip", event_id="n")], 1) == 4
    # Replay after a crash that followed the write, with an overlap.
    assert append([event("trip"), event("trip", event_id="n")], 1) == 4
    # Another query, as after a lost checkpoint.
    assert append([event("trip", event_id="n"), event("trip", event_id="m")], 0, "s") == 6
    assert append([], 2) == 6


def test_a_key_is_stored_once_whatever_its_time(spark, tmp_path):
    job = jobs.JOBS["vehicle-state"]
    target, key = str(tmp_path / "t"), constraints.KEYS[job.table]
    later = event("vehicle", "source_timestamp", "2026-03-09T08:00:00+00:00")
    other = event("vehicle", event_id="no-epoch")
    moved = event("vehicle", "source_timestamp", "2026-03-10T08:00:00+00:00", event_id="no-epoch")
    for batch_id, items in enumerate([[event("vehicle"), other], [later, moved]]):
        rows = jobs.table_rows(envelope(spark, items), job)
        sinks.append_keyed(rows, batch_id, target=target, run="r", keys=key, table=job.table)
    table = sinks.read_keyed(spark, target, with_day=True)
    assert table.count() == 2 and sinks.DAY in table.columns


def test_a_batch_opens_only_its_own_slots(spark, tmp_path):
    job = jobs.JOBS["vehicle-state"]
    target, key = str(tmp_path / "t"), constraints.KEYS[job.table]
    for day in range(4):
        items = [event("vehicle", event_id=f"v:{1772000000 + 86400 * day}")]
        rows = jobs.table_rows(envelope(spark, items), job)
        sinks.append_keyed(rows, day, target=target, run="r", keys=key, table=job.table)
    slots = sorted(p.name for p in (tmp_path / "t").iterdir() if p.name.startswith("slot="))
    assert len(slots) == 4
    found = sinks.stored_rows(spark, target, "event_id string", [int(slots[0].removeprefix("slot="))])
    assert len(found.inputFiles()) == 1 and found.count() == 1
    assert sinks.stored_rows(spark, target, "event_id string", [63, 62]) is None


def _append(spark, target, batch_id, items, run="r"):
    job = jobs.JOBS["vehicle-state"]
    rows = jobs.table_rows(envelope(spark, items), job)
    sinks.append_keyed(rows, batch_id, target=target, run=run, keys=constraints.KEYS[job.table], table=job.table)


def test_a_batch_writes_a_file_per_slot_at_most(spark, tmp_path):
    """Ids without a time over thirty days, and ids with one over a year."""
    target = str(tmp_path / "t")
    days = [f"2026-03-{1 + k % 30:02d}T08:00:00+00:00" for k in range(300)]
    items = [event("vehicle", "source_timestamp", day, event_id=f"id-{k}") for k, day in enumerate(days)]
    items += [event("vehicle", event_id=f"v:{1772000000 + 86400 * k}") for k in range(365)]
    _append(spark, target, 0, items)
    assert 0 < len(list((tmp_path / "t").rglob("*.parquet"))) <= sinks.SLOTS
    _append(spark, target, 1, items)
    assert sinks.read_keyed(spark, target).count() == 665


def test_folders_of_a_slot_are_merged(spark, tmp_path):
    target = str(tmp_path / "t")
    for batch_id in range(sinks.FOLDERS + 2):
        _append(spark, target, batch_id, [event("vehicle", event_id=f"v{batch_id}:1772884800")])
    (slot,) = [p for p in (tmp_path / "t").iterdir() if p.name.startswith("slot=")]
    folders = sorted(f"{p.parent.name}/{p.name}" for p in slot.glob("run=*/batch_id=*"))
    assert folders == ["run=merged/batch_id=0", f"run=r/batch_id={sinks.FOLDERS + 1}"]
    # A replay of a merged batch and of the last one add nothing.
    for batch_id in (3, sinks.FOLDERS + 1):
        _append(spark, target, batch_id, [event("vehicle", event_id=f"v{batch_id}:1772884800")])
    assert sinks.read_keyed(spark, target).count() == sinks.FOLDERS + 2


def test_a_merge_that_was_cut_off_is_finished(spark, tmp_path):
    target = str(tmp_path / "t")
    _append(spark, target, 0, [event("vehicle")])
    (slot,) = [p for p in (tmp_path / "t").iterdir() if p.name.startswith("slot=")]
    number = slot.name.removeprefix("slot=")
    staged = tmp_path / "t" / "_merge" / number / "run=merged" / "batch_id=0"
    spark.read.parquet(str(slot / "run=r" / "batch_id=0")).write.parquet(str(staged))
    (tmp_path / "t" / "_old").mkdir()
    slot.rename(tmp_path / "t" / "_old" / number)
    _append(spark, target, 1, [event("vehicle"), event("vehicle", event_id="v9:1772884800")])
    assert sinks.read_keyed(spark, target).count() == 2
    assert not list((tmp_path / "t" / "_old").iterdir())


def test_a_broken_row_stores_nothing_of_its_batch(spark, tmp_path):
    job = jobs.JOBS["trip-update"]
    target, key = str(tmp_path / "t"), constraints.KEYS[job.table]
    bad = event("trip", "start_time", "5:10", event_id="bad")
    rows = jobs.table_rows(envelope(spark, [event("trip"), bad]), job)
    with pytest.raises(Exception, match="start time is a clock time"):
        sinks.append_keyed(rows, 0, target=target, run="r", keys=key, table=job.table)
    assert not (tmp_path / "t").exists()
    fixed = jobs.table_rows(envelope(spark, [event("trip")]), job)
    sinks.append_keyed(fixed, 0, target=target, run="r", keys=key, table=job.table)
    assert sinks.read_keyed(spark, target).count() == 2


def test_duplicates_across_batches_and_late_rows(spark, tmp_path):
    job = jobs.JOBS["vehicle-state"]
    (tmp_path / "in").mkdir()
    raw = envelopes.read_envelope_stream(spark, str(tmp_path / "in"))
    valid, _ = jobs.checked_events(raw, job)
    rows = job.flatten(events.deduplicated(events.with_event_time(valid)))
    drop(spark, tmp_path / "in", "1", [event("vehicle")])
    query = sinks.start_memory_sink(rows, "two_batches", str(tmp_path / "c"))
    try:
        query.processAllAvailable()
        later = event("vehicle", "source_timestamp", "2026-08-14T13:00:00Z", event_id="later")
        drop(spark, tmp_path / "in", "2", [event("vehicle"), later], offset=10)
        query.processAllAvailable()
        assert spark.table("two_batches").count() == 2
        late = event("vehicle", event_id="late")
        drop(spark, tmp_path / "in", "3", [late], offset=20)
        query.processAllAvailable()
        assert spark.table("two_batches").count() == 2
        reports = [json.loads(p.json) for p in query.recentProgress]
        dropped = sum(s["numRowsDroppedByWatermark"] for r in reports for s in r["stateOperators"])
        assert dropped >= 1
        provider = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
        assert provider.endswith("RocksDBStateStoreProvider")
    finally:
        query.stop()


def test_console_sink_and_progress_log(spark, tmp_path):
    folder = str(tmp_path / "log")
    log = progress.ProgressLog(spark, "printer", folder)
    drop(spark, tmp_path / "in", "1", [event("vehicle")])
    raw = envelopes.read_envelope_stream(spark, str(tmp_path / "in"))
    spark.streams.addListener(log)
    try:
        query = sinks.start_console_sink(
            events.envelope_columns(raw), str(tmp_path / "c"), "printer", "1 second"
        )
        query.processAllAvailable()
        query.stop()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        for _ in range(50):
            status = progress.application_status(progress.read_log(spark, folder)).collect()
            if status and status[0].status == "terminated":
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(log)
    assert status[0].status == "terminated"
    assert status[0].last_batch_id is not None
    rows = progress.progress_rows(progress.read_log(spark, folder))
    assert rows.agg(F.sum("num_input_rows")).first()[0] == 1
    # The offsets of a file source name no topic.
    assert progress.offsets(progress.with_source_offsets(rows)).count() == 0


def test_kafka_options():
    assert envelopes.kafka_options("b:9092", "t") == {
        "kafka.bootstrap.servers": "b:9092",
        "subscribe": "t",
        "startingOffsets": "latest",
    }
    assert envelopes.kafka_options("b", "t", "earliest", 5)["maxOffsetsPerTrigger"] == "5"


def test_times_without_zone_are_accepted_as_event_time(spark):
    rows = spark.readStream.format("rate").load()
    plain = rows.withColumn("source_timestamp", F.col("timestamp").cast("timestamp_ntz"))
    assert dict(events.with_event_time(plain).dtypes)["source_timestamp"] == "timestamp"
