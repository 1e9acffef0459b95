"""Synthetic signals and archives."""

import io
import struct
import wave

import numpy as np
import pytest
from pyspark.sql import functions as F

from linecurate.operators import signal
from linecurate.sources import archive, archive_source


def tone(rate, *parts):
    """Alternating silence and 220 Hz tone of these seconds, silence first."""
    out = [np.zeros(round(s * rate)) if i % 2 == 0 else 0.3 * np.sin(2 * np.pi * 220 * np.arange(round(s * rate)) / rate) for i, s in enumerate(parts)]
    return np.concatenate(out).astype(np.float32)


def wav(samples, rate):
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1), w.setsampwidth(2), w.setframerate(rate)
        w.writeframes((samples * 32767).astype("<i2").tobytes())
    return out.getvalue()


def test_clustered_pauses():
    m = signal.measure(tone(16000, 0.20, *([0.18, 0.08] * 5), 0.18, 0.10), 16000)
    assert m["micro_pauses"] >= 4


def test_tail_island():
    m = signal.measure(tone(16000, 0.10, 0.80, 0.10, 0.08, 0.10), 16000)
    assert 0 < m["tail_island_ms"] <= 100


def test_one_pause():
    got = signal.pauses(tone(48000, 0.05, 0.20, 0.10, 0.20, 0.05), 48000)
    assert len(got) == 1 and abs(got[0][1] - 100) <= 20


def test_voice_edges():
    start, end = signal.voice_edges(tone(24000, 0.30, 1.0, 0.70), 24000)
    assert 0.18 <= start <= 0.24 and 1.36 <= end <= 1.42
    assert signal.voice_edges(np.zeros(1000), 8000) is None


def test_insert_silence():
    audio = np.concatenate((np.full(300, 0.5), np.zeros(150), np.full(300, 0.5)))
    found = signal.quiet_intervals(audio, 1000)
    assert len(found) == 1 and len(signal.insert_silence(audio, found, 180)) == len(audio) + 180


@pytest.mark.parametrize("width", [1, 2, 3, 4])
def test_decode_pcm(width):
    value = {1: bytes([192]), 2: struct.pack("<h", 2**14), 3: (2**22).to_bytes(3, "little"), 4: struct.pack("<i", 2**30)}[width]
    assert signal.decode_pcm(value, width)[0] == pytest.approx(0.5)


def test_measure_files(spark, tmp_path):
    (tmp_path / "a.wav").write_bytes(wav(tone(16000, 0.1, 0.5, 0.1), 16000))
    (tmp_path / "b.wav").write_bytes(b"nothing")
    files = spark.read.format("binaryFile").load(str(tmp_path))
    out = {r["path"][-5:]: r for r in signal.measure_files(files).collect()}
    assert out["a.wav"]["error"] is None and out["a.wav"]["duration_s"] == pytest.approx(0.7) and out["b.wav"]["error"]


def media(data=120, tag=0x3041):
    fmt = struct.pack("<HHIIHH", tag, 1, 48000, 12000, 1, 16) + bytes(20)
    body = b"WAVE" + b"fmt " + struct.pack("<I", 36) + fmt + b"data" + struct.pack("<I", data) + bytes(data)
    return b"RIFF" + struct.pack("<I", len(body)) + body


def test_media_header():
    m = archive.parse_media(media())
    assert m.duration == pytest.approx(0.01) and m.family == "wem-opus"
    with pytest.raises(archive.FormatError):
        archive.parse_media(media()[:-1])


@pytest.mark.parametrize("n", [0, 1, 63, 64, 127, 128, 8191, 8192, 10**6, 2**31])
def test_counts(n):
    raw = archive.encode_count(n)
    assert archive.decode_count(raw) == (n, len(raw))


@pytest.mark.parametrize("slice_bytes", [1 << 30, 200])
def test_archive_table(spark, tmp_path, slice_bytes):
    """Whole files and slices give the same rows."""
    items = [(7, 0, media(), 5, b""), (8, 1, media(240), 5, b"side")]
    (tmp_path / "one.w3").write_bytes(archive.build(items))
    (tmp_path / "two.w3").write_bytes(archive.build([(7, 0, media(), 5, b""), (8, 1, media(360), 5, b"side")]))
    (tmp_path / "bad.w3").write_bytes(b"CPSW")
    read = lambda glob="*": archive_source.read_archives(spark, str(tmp_path), glob=glob, slice_bytes=slice_bytes)
    assert read("one.w3").rdd.getNumPartitions() == (1 if slice_bytes > 1000 else 4)
    rows = read().collect()
    one = [r for r in rows if r["path"].endswith("one.w3")]
    assert sorted((r["ident"], r["codec"], r["error"]) for r in one) == [(7, "wem-opus", None), (8, "wem-opus", None)]
    assert [r["error"] for r in rows if r["path"].endswith("bad.w3")] == ["no archive"]
    old, new = read("one.w3"), read("two.w3")
    assert [(r["ident"], r["change"]) for r in archive.changed_payloads(old, new).collect()] == [(8, "payload")]
    placed = archive.layout(old, "ident").orderBy("entry_index").collect()
    entries = archive.parse_entries((tmp_path / "one.w3").read_bytes())
    assert [(r["wave_offset"], r["companion_offset"]) for r in placed] == [(e[3], e[5]) for e in entries]
    assert {r["archive_bytes"] for r in placed} == {len((tmp_path / "one.w3").read_bytes())}


def test_damaged_entries_are_counted(spark, tmp_path):
    items = [(i, 0, media(100 + i), 5, b"c" * (i % 2)) for i in range(6)] + [(0, 0, media(), 5, b"")]
    raw = bytearray(archive.build(items))
    entry = lambda i, field: 11 + 40 * i + 4 * field
    struct.pack_into("<I", raw, entry(1, 2), 10**9)  # media out of bounds
    struct.pack_into("<I", raw, entry(2, 3), 1)  # reserved
    struct.pack_into("<I", raw, entry(3, 6), 0)  # companion out of bounds
    raw[struct.unpack_from("<I", raw, entry(4, 2))[0]] ^= 1
    (tmp_path / "a.w3").write_bytes(raw)
    got = archive_source.read_archives(spark, str(tmp_path), slice_bytes=150)
    assert {r["error"]: r["n"] for r in archive_source.skipped(got).collect()} == {"entry out of bounds": 1, "reserved field set": 1, "companion out of bounds": 1, "block size differs": 1, "repeated id": 1}
    assert sorted(r["ident"] for r in got.where("error is null").collect()) == [0, 5]


def test_wanted_ids_reach_the_reader(spark, tmp_path):
    (tmp_path / "a.w3").write_bytes(archive.build([(i, 0, media(), 5, b"") for i in range(20)]))
    assert sorted(r["ident"] for r in archive_source.read_archives(spark, str(tmp_path), wanted={3, 5, 99}).collect()) == [3, 5]
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        got = archive_source.read_archives(spark, str(tmp_path), slice_bytes=500).where("ident in (4, 6) and channels = 1")
        assert sorted(r["ident"] for r in got.collect()) == [4, 6]
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")
    reader = archive_source.PushedArchiveReader({"path": str(tmp_path)})
    other = archive_source.EqualTo(("rate",), 1)
    assert list(reader.pushFilters([archive_source.In(("ident",), (1, 2)), other, archive_source.EqualTo(("ident",), 2)])) == [other] and reader.wanted == {2}


def test_written_archive(spark, tmp_path):
    rows = [(i, i % 3, bytearray(media(50 + i)), bytearray(b"side" * (i % 2)), (50 + i) / 12000, 4, -i) for i in range(100)]
    items = spark.createDataFrame(rows, "ident long, ident_high long, media binary, companion binary, duration double, trailer_kind long, o int").repartition(5)
    path = str(tmp_path / "new" / "all.w3")
    archive_source.write_archive(items, path, "o")
    raw = (tmp_path / "new" / "all.w3").read_bytes()
    assert raw == archive.build([(r[0], r[1], bytes(r[2]), r[5], bytes(r[3])) for r in reversed(rows)])
    with pytest.raises(Exception, match="FileExistsError"):
        archive_source.write_archive(items, path, "o")
    archive_source.write_archive(items.limit(0), path, "o", force=True)
    assert (tmp_path / "new" / "all.w3").read_bytes() == archive.build([])
    with pytest.raises(ValueError, match="repeated"):
        archive_source.write_archive(items.unionAll(items.where("ident = 3")), path, "o", force=True)
    with pytest.raises(RuntimeError, match="1 entries differ"):
        archive_source.write_archive(items.withColumn("media", F.when(F.col("ident") == 3, F.lit(b"RIFX")).otherwise(F.col("media"))), path, "o", force=True)
    assert not (tmp_path / "new" / "all.w3").exists()


@pytest.mark.parametrize("options", [{}, {"payload": "true"}, {"idents": "5,77,300"}, {"index": "true"}])
def test_slices_read_each_byte_about_once(tmp_path, monkeypatch, options):
    """However many slices a file has, all of them together read little more than the file."""
    (tmp_path / "a.w3").write_bytes(archive.build([(i, 0, media(10 + i % 7), 5, b"side" * (i % 2)) for i in range(1000)]))
    length, read = (tmp_path / "a.w3").stat().st_size, []
    real = archive_source.file_system

    class Counting:
        def __init__(self, file):
            self.file = file

        def read_at(self, n, at):
            got = self.file.read_at(n, at)
            read.append(len(got))
            return got

        def __enter__(self):
            self.file.__enter__()
            return self

        def __exit__(self, *error):
            self.file.__exit__(*error)

    class System:
        def __init__(self, system):
            self.system = system

        def open_input_file(self, path):
            return Counting(self.system.open_input_file(path))

        def __getattr__(self, name):
            return getattr(self.system, name)

    monkeypatch.setattr(archive_source, "file_system", lambda path: (System(real(path)[0]), real(path)[1]))
    reader = archive_source.ArchiveReader({"path": str(tmp_path), "slice_bytes": "1024", **options})
    parts = reader.partitions()
    idents = [x for p in parts for batch in reader.read(p) for x in batch.column("ident").to_pylist()]
    assert len(parts) > 100 and sorted(idents) == ([5, 77, 300] if "idents" in options else list(range(1000)))
    assert sum(read) < 2.5 * length


@pytest.mark.parametrize("small", [100_000, 1])
def test_repeated_ids_in_other_slices(spark, tmp_path, monkeypatch, small):
    """All but the first of an id are errors, also where the first is damaged; a reserved field comes first, and another archive's ids count for themselves."""
    items = [(i % 30, i % 2, media(100 + i), 5, b"") for i in range(90)]
    raw = bytearray(archive.build(items))
    struct.pack_into("<I", raw, 11 + 1 + 40 * 3 + 12, 1)  # reserved: the first of id 3
    struct.pack_into("<I", raw, 11 + 1 + 40 * 34 + 12, 1)  # and the second of id 4
    (tmp_path / "a.w3").write_bytes(raw)
    (tmp_path / "b.w3").write_bytes(archive.build(items[:30]))
    monkeypatch.setattr(archive_source, "SMALL", small)
    for payload in (False, True):
        for wanted in (None, {3, 4, 8}):
            got = archive_source.read_archives(spark, str(tmp_path), wanted=wanted, slice_bytes=500, payload=payload)
            rows = {(r["path"][-4:], r["entry_index"]): r for r in got.collect()}
            expected = [(f, i) for f, n in (("a.w3", 90), ("b.w3", 30)) for i in range(n) if wanted is None or i % 30 in wanted]
            assert sorted(rows) == expected
            for (file, i), r in rows.items():
                error = "reserved field set" if file == "a.w3" and i in (3, 34) else "repeated id" if i >= 30 else None
                assert (r["error"], r["ident"], r["media_bytes"]) == (error, i % 30, None if error else len(media(100 + i)))
                assert not payload or r["media"] == (None if error else media(100 + i))
