"""Interval tables of wave files and the batch runner."""

import io
import wave

import numpy as np
import pytest

from linecurate.operators import intervals, signal
from linecurate.sources import sinks
from linecurate.streaming import runner


def wav(samples, rate=8000, width=2, channels=1):
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(channels), w.setsampwidth(width), w.setframerate(rate)
        whole = np.repeat((np.asarray(samples) * (2 ** (8 * width - 1) - 1)).astype("<i4") + (128 if width == 1 else 0), channels)
        w.writeframes(whole.astype("<i4").view(np.uint8).reshape(-1, 4)[:, :width].tobytes())
    return out.getvalue()


def shaped(*parts):
    """Silence and tone of these ms in turn."""
    return np.concatenate([np.zeros(8 * ms) if i % 2 == 0 else 0.5 * np.sign(np.sin(np.arange(8 * ms) + 0.5)) for i, ms in enumerate(parts)])


@pytest.mark.parametrize("width", [1, 2, 3, 4])
@pytest.mark.parametrize("channels", [1, 2])
def test_tables_of_intervals(spark, width, channels):
    x = shaped(200, 300, 120, 300, 60, 200, 200)
    files = spark.createDataFrame([("a", bytearray(wav(x, width=width, channels=channels))), ("b", bytearray(b"no")), ("c", None), ("d", bytearray(wav(np.zeros(8000), width=width)))], "path string, content binary")
    got = lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
    assert [r[:3] for r in got(intervals.pauses(files)) if r[3] is None] == [("a", 500.0, 120.0), ("a", 920.0, 60.0)]
    assert {r[0] for r in got(intervals.pauses(files)) if r[3]} == {"b", "c"}
    assert [r[0] for r in got(intervals.voice_edges(files)) if r[3] is None] == ["a"]
    quiet = intervals.quiet_intervals(files)
    assert [r[:4] for r in got(quiet) if r[4] is None] == [("a", 4000, 4960, 8000)]
    longer = {r["path"]: r for r in intervals.with_silence(files, quiet, 50.0).collect()}
    samples, rate = signal.read_wav(longer["a"]["content"])
    assert len(samples) == len(x) + 400 and rate == 8000 and wave.open(io.BytesIO(longer["a"]["content"])).getparams()[:3] == (channels, width, 8000)
    assert signal.pauses(samples, rate)[0] == (500.0, 170.0)
    assert bytes(longer["b"]["content"]) == b"no" and longer["c"]["content"] is None  # they have no interval
    measured = {r["path"]: r for r in intervals.rates(files).collect()}
    assert measured["a"]["mean_pause_ms"] == pytest.approx(90) and measured["a"]["voice_s"] == pytest.approx(0.8) and measured["b"]["voice_s"] is None
    with pytest.raises(signal.SignalError):
        intervals.with_silence(files, quiet, 0)


def test_files_of_rows(spark, tmp_path):
    df = spark.range(20).selectExpr("concat('f', id, '.bin') as name", "cast(repeat('x', id) as binary) as content").repartition(4)
    assert sinks.write_files(df, f"file:{tmp_path}/out", "name", "content") == 20
    assert {p.name: len(p.read_bytes()) for p in (tmp_path / "out").iterdir()} == {f"f{i}.bin": i for i in range(20)}


class Stopped(Exception):
    pass


@pytest.fixture
def work(spark, tmp_path):
    handled = []

    def make(fails=lambda key, alone: False, stop_at=None, before_log=False):
        def handle(batch):
            keys = [r["k"] for r in batch.collect()]
            if stop_at is not None and len(handled) == stop_at and not before_log:
                raise Stopped
            handled.append(keys)
            for k in keys:
                if not fails(k, len(keys) == 1):
                    (tmp_path / f"{k}.done").write_text("x")
            if stop_at is not None and len(handled) == stop_at + 1 and before_log:
                raise Stopped

        def check(batch):
            done = [(int(p.stem), True) for p in tmp_path.glob("*.done")]
            return batch.join(spark.createDataFrame(done, "k long, ok boolean"), "k").select("k", "ok")

        return handle, check

    return handled, make, str(tmp_path / "log")


@pytest.mark.parametrize("before_log", [False, True])
def test_stopped_between_batches(spark, work, before_log):
    handled, make, log = work
    items = spark.range(23).withColumnRenamed("id", "k")
    with pytest.raises(Stopped):
        runner.run(items, "k", *make(stop_at=2, before_log=before_log), log, 5)
    states = runner.run(items, "k", *make(), log, 5)
    assert sorted(k for keys in handled for k in keys) == list(range(23))
    assert handled[0] == [0] and all(len(keys) <= 5 for keys in handled)
    assert {(r["k"], r["state"]) for r in states.collect()} == {(i, "valido") for i in range(23)}
    runner.run(items, "k", *make(), log, 5)
    assert sum(map(len, handled)) == 23


def test_failed_items_go_alone(spark, work):
    handled, make, log = work
    items = spark.range(9).withColumnRenamed("id", "k")
    states = runner.run(items, "k", *make(fails=lambda k, alone: k == 4 or k == 6 and not alone), log, 4)
    assert {r["k"]: (r["state"], r["attempts"]) for r in states.collect()} == {i: ("invalido" if i == 4 else "valido", 2 if i in (4, 6) else 1) for i in range(9)}
    assert [sorted(x) for x in handled] == [[0], [1, 2, 3, 4], [5, 6, 7, 8], [4], [6]] or [sorted(x) for x in handled] == [[0], [1, 2, 3, 4], [5, 6, 7, 8], [6], [4]]


def test_preflight(spark, work):
    handled, make, log = work
    with pytest.raises(runner.PreflightError):
        runner.run(spark.range(9).withColumnRenamed("id", "k"), "k", *make(fails=lambda k, alone: True), log, 4)
    assert handled == [[0]]
    assert runner.run(spark.range(0).withColumnRenamed("id", "k"), "k", *make(), log + "2", 4).count() == 0
