"""Batches by size, by silence, and over a restart."""

import json
import time

import pytest

from milldam.streaming import flush


@pytest.fixture
def store(spark):
    for k, v in flush.STATE_STORE.items():
        spark.conf.set(k, v)
    yield
    for k in flush.STATE_STORE:
        spark.conf.unset(k)


def test_batches_by_size_and_silence(spark, store, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()

    def put(name, ids):
        (tmp_path / name).write_text("\n".join(json.dumps({"message_id": f"m{i}", "payload": "x"}) for i in ids))
        (tmp_path / name).rename(folder / name)

    def start(silence_ms):
        rows = spark.readStream.schema("message_id string, payload string").json(str(folder))
        out = flush.batched(rows, most=3, silence_ms=silence_ms, buffers=1)
        return out.writeStream.format("json").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state").trigger(processingTime="300 milliseconds").start()

    def found(n, seconds=60):
        end = time.time() + seconds
        while time.time() < end:
            rows = spark.read.schema("message_id string, flush long, flushed string").json(f"{tmp_path}/out").collect() if (tmp_path / "out").exists() else []
            if len(rows) >= n:
                return rows
            time.sleep(0.5)
        raise AssertionError(f"{len(rows)} of {n} rows")

    put("a.json", range(7))
    run = start(3_600_000)  # no silence is that long: one row waits
    try:
        rows = found(6)
    finally:
        run.stop()
    assert sorted((r.flush, r.flushed) for r in rows) == [(1, "size")] * 3 + [(2, "size")] * 3
    put("b.json", [7])
    run = start(500)  # the row that waited is there again, with one more
    try:
        rows = found(8)
    finally:
        run.stop()
    assert sorted(r.message_id for r in rows) == sorted(f"m{i}" for i in range(8)) and [r.flushed for r in rows if r.flush == 3] == ["silence"] * 2
