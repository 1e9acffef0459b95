"""Intervals of wave files as tables: pauses, voice edges, quiet places, and silence put into them.

files are rows of a key and a file's bytes, as the binaryFile source gives them. A file that can't
be read is one row with an error. Work is a file at a time, in Arrow batches.
"""

from __future__ import annotations

import io
import wave
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import signal
from .signal import SignalError

_TYPES = {"double": pa.float64(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}


def _table(files: DataFrame, key: str, content: str, columns: str, find: Callable[[np.ndarray, int], list[tuple]]) -> DataFrame:
    """A row for each tuple that find gives for a file's samples and rate; one with an error where the file can't be read."""
    fields = [c.split() for c in columns.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, rows = [], []
            for i, raw in enumerate(batch.column(1)):
                try:
                    found = [(*row, None) for row in find(*signal.read_wav(raw.as_py() or b""))]
                except SignalError as e:
                    found = [(*(None for _ in fields), str(e))]
                places += [i] * len(found)
                rows += found
            keys = batch.column(0).take(pa.array(places, pa.int64()))
            values = [pa.array([r[j] for r in rows], _TYPES[kind]) for j, (_, kind) in enumerate([*fields, ("error", "string")])]
            yield pa.RecordBatch.from_arrays([keys, *values], [key, *[n for n, _ in fields], "error"])

    return files.select(key, content).mapInArrow(run, f"{key} {files.schema[key].dataType.simpleString()}, {columns}, error string")


def pauses(files: DataFrame, key: str = "path", content: str = "content", frame_ms: float = 10.0, least_ms: float = 35.0) -> DataFrame:
    """(key, start_ms, length_ms, error): the pauses inside of speech; none for a file without."""
    return _table(files, key, content, "start_ms double, length_ms double", lambda x, rate: signal.pauses(x, rate, frame_ms, least_ms))


def voice_edges(files: DataFrame, key: str = "path", content: str = "content", frame_ms: float = 20.0, level_db: float = -45.0, padding_ms: float = 80.0) -> DataFrame:
    """(key, start_s, end_s, error): where the padded voice begins and ends; no row for silence."""
    return _table(files, key, content, "start_s double, end_s double", lambda x, rate: [e for e in [signal.voice_edges(x, rate, frame_ms, level_db, padding_ms)] if e])


def quiet_intervals(files: DataFrame, key: str = "path", content: str = "content", level_db: float = -35.0, least_ms: float = 100.0, edge_ms: float = 150.0) -> DataFrame:
    """(key, start, end, rate, error): quiet places in samples, off the edges."""
    return _table(files, key, content, "start long, end long, rate long", lambda x, rate: [(a, b, rate) for a, b in signal.quiet_intervals(x, rate, level_db, least_ms, edge_ms)])


def rates(files: DataFrame, key: str = "path", content: str = "content") -> DataFrame:
    """measure_files with what follows from it: voice_s without pauses, its share of the trimmed time, pauses a second, and the mean pause."""
    measured = signal.measure_files(files, key, content)
    voice = F.greatest(F.lit(0.0), F.col("trimmed_s") - F.col("pause_ms") / 1000)
    many = F.col("micro_pauses") + F.col("long_pauses")
    over = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    derived = {"voice_s": voice, "voice_share": over(voice, F.col("trimmed_s")), "pauses_per_s": over(many, F.col("trimmed_s")), "mean_pause_ms": over(F.col("pause_ms"), many)}
    return measured.withColumns({n: F.when(F.col("error").isNull(), c) for n, c in derived.items()})


def lengthened(raw: bytes, places: list[int], extra_ms: float) -> bytes:
    """A wave file with so much silence put in before each of these samples; width, rate and channels stay."""
    try:
        with wave.open(io.BytesIO(raw)) as w:
            params, payload = w.getparams(), w.readframes(w.getnframes())
    except (EOFError, wave.Error) as e:
        raise SignalError(str(e) or "cut off") from e
    size = params.nchannels * params.sampwidth
    silence = (b"\x80" if params.sampwidth == 1 else b"\x00" * params.sampwidth) * params.nchannels * round(params.framerate * extra_ms / 1000)
    cuts = [0, *sorted(min(p * size, len(payload)) for p in places), len(payload)]
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setparams(params._replace(nframes=0))
        w.writeframes(silence.join(payload[a:b] for a, b in zip(cuts, cuts[1:])))
    return out.getvalue()


def with_silence(files: DataFrame, places: DataFrame, extra_ms: float, key: str = "path", content: str = "content") -> DataFrame:
    """(key, content, error) of all files, with extra_ms of silence in the middle of each of their intervals (key, start, end).

    Files without an interval stay as they are; one that can't be read has an error and no content.
    A file's intervals are put together in its row, so their number is bounded by its length.
    """
    if extra_ms <= 0:
        raise SignalError("extra_ms must be positive")
    middles = places.where("start is not null").groupBy(key).agg(F.sort_array(F.collect_list(F.floor((F.col("start") + F.col("end")) / 2))).alias("__middles"))
    rows = files.select(key, content).join(middles, key, "left").select(key, content, "__middles")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made, errors = [], []
            for raw, middles in zip(batch.column(1), batch.column(2)):
                try:
                    made.append(lengthened(raw.as_py() or b"", middles.as_py(), extra_ms) if middles.is_valid else raw.as_py())
                    errors.append(None)
                except SignalError as e:
                    made.append(None)
                    errors.append(str(e))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary()), pa.array(errors, pa.string())], [key, content, "error"])

    return rows.mapInArrow(run, f"{key} {files.schema[key].dataType.simpleString()}, {content} binary, error string")
