"""Measures of PCM signals, in numpy inside Arrow batches."""

from __future__ import annotations

import io
import wave
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame


class SignalError(ValueError):
    pass


def decode_pcm(payload: bytes, width: int) -> np.ndarray:
    """float32 in -1..1 of little-endian PCM of 1 (unsigned), 2, 3 or 4 bytes a sample."""
    if width == 1:
        return (np.frombuffer(payload, np.uint8).astype(np.float32) - 128) / 128
    if width in (2, 4):
        return np.frombuffer(payload, f"<i{width}").astype(np.float32) / np.float32(2 ** (8 * width - 1))
    if width == 3:
        raw = np.frombuffer(payload, np.uint8).reshape(-1, 3)
        wide = np.zeros((len(raw), 4), np.uint8)
        wide[:, 1:] = raw
        return (wide.view("<i4").ravel() >> 8).astype(np.float32) / np.float32(2**23)
    raise SignalError(f"sample width {width}")


def read_wav(content: bytes) -> tuple[np.ndarray, int]:
    """(mono samples, rate) of a WAV file's bytes."""
    try:
        with wave.open(io.BytesIO(content)) as w:
            channels, rate, width, packing = w.getnchannels(), w.getframerate(), w.getsampwidth(), w.getcomptype()
            payload = w.readframes(w.getnframes())
    except (EOFError, wave.Error) as e:
        raise SignalError(str(e) or "cut off") from e
    if packing != "NONE" or channels < 1 or rate < 8000 or not payload:
        raise SignalError("not a PCM file")
    samples = decode_pcm(payload, width)
    if len(samples) % channels:
        raise SignalError("incomplete samples")
    return np.nan_to_num(samples.reshape(-1, channels).mean(axis=1, dtype=np.float32)), rate


def true_runs(mask: np.ndarray) -> np.ndarray:
    """(start, end) rows of the stretches in which mask holds."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
    return edge.reshape(-1, 2)


def frame_levels(samples: np.ndarray, size: int) -> np.ndarray:
    """dB of the root mean square of each frame, the last filled up with zeros."""
    padded = np.zeros(-(-len(samples) // size) * size)
    padded[: len(samples)] = samples
    return 20 * np.log10(np.maximum(np.sqrt((padded.reshape(-1, size) ** 2).mean(axis=1)), 1e-12))


def speech_mask(samples: np.ndarray, rate: int, frame_ms: float = 10.0, bridge: int = 2) -> np.ndarray:
    """Frames above an adaptive level; inner silences of up to `bridge` frames count as speech."""
    level = frame_levels(samples, max(1, round(rate * frame_ms / 1000)))
    active = level > min(-36.0, max(-50.0, float(np.percentile(level, 90)) - 32.0))
    for a, b in true_runs(~active):
        if 0 < a and b < len(active) and b - a <= bridge:
            active[a:b] = True
    return active


def measure(samples: np.ndarray, rate: int, frame_ms: float = 10.0) -> dict[str, float]:
    """Edges, pauses, blips, tail island, clipping and jumps of one line; raises on silence."""
    active = speech_mask(samples, rate, frame_ms)
    speech = true_runs(active)
    if not len(speech):
        raise SignalError("silent")
    first, last = int(speech[0, 0]), int(speech[-1, 1])
    length = len(samples) / rate
    start, end = first * frame_ms / 1000, min(length, last * frame_ms / 1000)
    gaps = (speech[1:, 0] - speech[:-1, 1]) * frame_ms
    pauses = gaps[gaps >= 35]
    lasting = (speech[:, 1] - speech[:, 0]) * frame_ms
    blip = (lasting[1:-1] <= 90) & (gaps[:-1] >= 35) & (gaps[1:] >= 35)
    tail = len(speech) > 1 and lasting[-1] <= 220 and gaps[-1] >= 40 and (speech[-1, 0] - first) / max(1, last - first) >= 0.60
    size, step = np.abs(samples), np.abs(np.diff(samples))
    rms = float(np.sqrt((samples.astype(np.float64) ** 2).mean()))
    return {
        "duration_s": length, "trim_start_s": start, "trim_end_s": end, "trimmed_s": max(0.0, end - start), "peak": float(size.max()), "rms": rms,
        "micro_pauses": int((pauses <= 180).sum()), "long_pauses": int((pauses > 180).sum()), "pause_ms": float(pauses.sum()),
        "blips": int(blip.sum()), "tail_island_ms": float(lasting[-1]) if tail else 0.0, "tail_gap_ms": float(gaps[-1]) if tail else 0.0,
        "tail_margin_ms": max(0.0, (length - end) * 1000), "active_s": float(active.sum() * frame_ms / 1000),
        "clipping": float((size >= 0.999).mean()), "max_step": (float(step.max()) if len(step) else 0.0) / max(rms, 1e-8),
    }


def pauses(samples: np.ndarray, rate: int, frame_ms: float = 10.0, least_ms: float = 35.0) -> list[tuple[float, float]]:
    """(start, duration) in ms of the inner pauses."""
    speech = true_runs(speech_mask(samples, rate, frame_ms))
    return [(float(a) * frame_ms, float(b - a) * frame_ms) for a, b in zip(speech[:-1, 1], speech[1:, 0]) if (b - a) * frame_ms >= least_ms]


def voice_edges(samples: np.ndarray, rate: int, frame_ms: float = 20.0, level_db: float = -45.0, padding_ms: float = 80.0) -> tuple[float, float] | None:
    """(start, end) in seconds of the padded voice: from the first to the last place where two of
    three frames are loud. None in silence."""
    size = max(1, round(rate * frame_ms / 1000))
    cells = [samples[i : i + size] for i in range(0, len(samples), size)]
    loud = np.array([20 * np.log10(max(1e-12, float(np.sqrt((c.astype(np.float64) ** 2).mean())))) >= level_db for c in cells], int)
    ahead = loud + np.append(loud[1:], 0) + np.append(loud[2:], [0, 0])[: len(loud)]
    behind = loud + np.append(0, loud[:-1]) + np.append([0, 0], loud[:-2])[: len(loud)]
    if not (ahead >= 2).any():
        return None
    a, b = int(np.argmax(ahead >= 2)), len(loud) - 1 - int(np.argmax(behind[::-1] >= 2))
    return max(0.0, a * size / rate - padding_ms / 1000), min(len(samples) / rate, (b + 1) * size / rate + padding_ms / 1000)


def quiet_intervals(samples: np.ndarray, rate: int, level_db: float = -35.0, least_ms: float = 100.0, edge_ms: float = 150.0) -> list[tuple[int, int]]:
    """(start, end) samples of silences relative to the loudest frame (20 ms each 10 ms), off the edges."""
    size, hop = max(1, round(rate * 0.020)), max(1, round(rate * 0.010))
    if len(samples) < size:
        return []
    many = 1 + -(-(len(samples) - size) // hop)
    padded = np.zeros((many - 1) * hop + size)
    padded[: len(samples)] = samples
    rms = np.sqrt((np.lib.stride_tricks.sliding_window_view(padded, size)[::hop] ** 2).mean(axis=1))
    if rms.max() < 1e-9:
        return []
    quiet = 20 * np.log10(np.maximum(rms, 1e-12) / rms.max()) <= level_db
    spans = [(int(a) * hop, min(len(samples), (int(b) - 1) * hop + size)) for a, b in true_runs(quiet)]
    edge = round(rate * edge_ms / 1000)
    return [(a, b) for a, b in spans if a >= edge and b <= len(samples) - edge and b - a >= round(rate * least_ms / 1000)]


def insert_silence(samples: np.ndarray, intervals: list[tuple[int, int]], extra: int) -> np.ndarray:
    """extra zeros in the middle of each interval."""
    if extra <= 0:
        raise SignalError("extra must be positive")
    return np.insert(samples, np.repeat([(a + b) // 2 for a, b in intervals], extra), 0) if intervals else samples.copy()


MEASURES = (
    "duration_s double, trim_start_s double, trim_end_s double, trimmed_s double, peak double, rms double, micro_pauses long, long_pauses long, pause_ms double, blips long, "
    "tail_island_ms double, tail_gap_ms double, tail_margin_ms double, active_s double, clipping double, max_step double, error string"
)


def _frame(rows: list[dict], key: str) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=[key, *(c.split()[0] for c in MEASURES.split(", "))])
    out["error"] = pd.Series([r.get("error") for r in rows], dtype=object)
    floats = {c: "float64" for c in out.columns if c not in (key, "error")}
    return out.astype(floats | {n: "Int64" for n in ("micro_pauses", "long_pauses", "blips")})


def measure_files(files: DataFrame, key: str = "path", content: str = "content") -> DataFrame:
    """One row a WAV file of (key, content): its measures, or an error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for k, raw in zip(batch[key], batch[content]):
                try:
                    rows.append({key: k, **measure(*read_wav(raw))})
                except SignalError as e:
                    rows.append({key: k, "error": str(e)})
            yield _frame(rows, key)

    return files.select(key, content).mapInPandas(run, f"{key} {files.schema[key].dataType.simpleString()}, {MEASURES}")


def measure_arrays(df: DataFrame, key: str, samples: str, rate: int = 8000) -> DataFrame:
    """measure() of signals that are arrays of numbers; an error for silent or empty ones."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for k, x in zip(batch[key], batch[samples]):
                try:
                    if x is None or not len(x):
                        raise SignalError("empty")
                    rows.append({key: k, **measure(np.asarray(x, np.float32), rate)})
                except SignalError as e:
                    rows.append({key: k, "error": str(e)})
            yield _frame(rows, key)

    return df.select(key, samples).mapInPandas(run, f"{key} {df.schema[key].dataType.simpleString()}, {MEASURES}")
