"""Voice archives and RIFF media as tables.

An archive is CPSW, u32 version, u16 key, a count, count entries of ten u32 (id, id_high, wave
offset, 0, wave size, 0, companion offset, 0, companion size, 0), u16 key. A media block is u32
size, the media, f32 duration, u32 kind.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.scan import placed_in_order

MAGIC, VERSION = b"CPSW", 163
ENTRY_BYTES, BLOCK_EXTRA = 40, 12
PIECE = 1 << 20  # bytes of a payload that are held at once
INDEX_BLOCK = 4096  # index records that are read at once


#: gives a file's bytes from an offset on, so many
Fetch = Callable[[int, int], bytes]


class FormatError(ValueError):
    pass


def decode_count(raw: bytes, at: int = 0) -> tuple[int, int]:
    """(value, next place) of a count: 6 bits in the first byte, whose bit 6 says more follow, then
    7 bits a byte while bit 7 is set; a single 0x80 is 0."""
    if at >= len(raw):
        raise FormatError("count cut off")
    head = raw[at]
    at += 1
    if head == 0x80:
        return 0, at
    if head > 0x80:
        value, shift, more = head & 0x7F, 7, True
    else:
        value, shift, more = head & 0x3F, 6, bool(head & 0x40)
    for _ in range(19):
        if not more:
            return value, at
        if at >= len(raw):
            raise FormatError("count cut off")
        value |= (raw[at] & 0x7F) << shift
        more, shift, at = raw[at] > 0x7F, shift + 7, at + 1
    raise FormatError("count too long")


def encode_count(value: int) -> bytes:
    if value < 0:
        raise FormatError("negative count")
    if not value:
        return b"\x80"
    rest = value >> 6
    out = [value & 0x3F | (0x40 if rest else 0)]
    while rest:
        out.append(rest & 0x7F | (0x80 if rest > 0x7F else 0))
        rest >>= 7
    return bytes(out)


@dataclass(frozen=True)
class Media:
    size: int
    tag: int
    format_size: int
    channels: int
    rate: int
    bytes_per_second: int
    data_size: int
    duration: float
    has_seek: bool

    @property
    def family(self) -> str:
        known = {(0x3041, 36): "wem-opus", (0xFFFF, 66): "wem-vorbis"}
        return known.get((self.tag, self.format_size)) or ("pcm" if self.tag == 0xFFFE else f"0x{self.tag:04x}")


def media_header(fetch: Fetch, start: int, length: int) -> Media:
    """Header of a RIFF/WAVE block of this length; chunks are padded to even sizes, fmt and data must be there. Only the chunks' heads are fetched."""
    head = fetch(start, min(length, 20))
    if head[:4] != b"RIFF" or head[8:12] != b"WAVE" or len(head) < 20:
        raise FormatError("no RIFF/WAVE")
    if struct.unpack_from("<I", head, 4)[0] + 8 != length:
        raise FormatError("declared size differs")
    at, sizes, fmt = 12, {}, None
    while at + 8 <= length:
        name, size = struct.unpack("<4sI", fetch(start + at, 8))
        if at + 8 + size > length:
            raise FormatError("chunk too long")
        sizes[name] = size
        if name == b"fmt ":
            if size < 16:
                raise FormatError("fmt too short")
            fmt = struct.unpack("<HHIIHH", fetch(start + at + 8, 16))
        at += 8 + size + size % 2
    if fmt is None or b"data" not in sizes or fmt[3] <= 0:
        raise FormatError("fmt or data missing")
    return Media(length, fmt[0], sizes[b"fmt "], fmt[1], fmt[2], fmt[3], sizes[b"data"], sizes[b"data"] / fmt[3], b"seek" in sizes)


def parse_media(raw: bytes) -> Media:
    return media_header(lambda at, n: raw[at : at + n], 0, len(raw))


def index_place(fetch: Fetch, length: int) -> tuple[int, int]:
    """(number of entries, place of the first) of an archive of this length; only its first bytes and the key behind the index are fetched."""
    head = fetch(0, min(length, 64))
    many, at = decode_count(head, 10) if len(head) > 10 else (0, 10)
    if head[:4] != MAGIC or len(head) < 11:
        raise FormatError("no archive")
    version, key = struct.unpack_from("<IH", head, 4)
    end = at + many * ENTRY_BYTES
    if version != VERSION or end + 2 > length or key or struct.unpack("<H", fetch(end, 2))[0]:
        raise FormatError("unexpected version, key or length")
    return many, at


def _entries(raw: bytes, first: int = 0) -> Iterator[tuple[int, int, int, int, int, int, int, bool]]:
    return ((i, e[0], e[1], e[2], e[4], e[6], e[8], bool(e[3] or e[5] or e[7] or e[9])) for i, e in enumerate(struct.iter_unpack("<10I", raw), first))


def parse_entries(raw: bytes) -> list[tuple[int, int, int, int, int, int, int, bool]]:
    """(index, id, id_high, wave offset, wave size, companion offset, companion size, reserved field set) of all entries."""
    many, at = index_place(lambda at, n: raw[at : at + n], len(raw))
    return list(_entries(raw[at : at + many * ENTRY_BYTES]))


def index_blocks(fetch: Fetch, many: int, at: int, part: int, parts: int) -> Iterator[tuple[int, bytes]]:
    """(first entry's number, index records) of this part of the index. Records are dealt out to the parts in blocks,
    so that each part is read once in all and a run of long entries is shared."""
    size = max(1, min(INDEX_BLOCK, many // (8 * parts)))
    for first in range(part * size, many, parts * size):
        yield first, fetch(at + first * ENTRY_BYTES, min(size, many - first) * ENTRY_BYTES)


def part_entries(fetch: Fetch, many: int, at: int, part: int, parts: int) -> Iterator[tuple[int, int, int, int, int, int, int, bool]]:
    """Entries as parse_entries gives them, of one part of the index."""
    for first, raw in index_blocks(fetch, many, at, part, parts):
        yield from _entries(raw, first)


def _sha256(fetch: Fetch, start: int, length: int) -> str:
    out = hashlib.sha256()
    for at in range(start, start + length, PIECE):
        out.update(fetch(at, min(PIECE, start + length - at)))
    return out.hexdigest()


def occurrence(fetch: Fetch, length: int, offset: int, size: int, companion_offset: int, companion_size: int, header: int) -> dict:
    """Media, trailer and hashes of one entry; raises where it leaves the file or overlaps. fetch(offset, size) gives the file's bytes, a piece at a time."""
    if size < BLOCK_EXTRA or offset < header or offset + size > length:
        raise FormatError("entry out of bounds")
    if companion_size and not offset + size <= companion_offset <= length - companion_size:
        raise FormatError("companion out of bounds")
    if struct.unpack("<I", fetch(offset, 4))[0] != size - BLOCK_EXTRA:
        raise FormatError("block size differs")
    media = media_header(fetch, offset + 4, size - BLOCK_EXTRA)
    seconds, kind = struct.unpack("<fI", fetch(offset + size - 8, 8))
    if abs(seconds - media.duration) > 0.02:
        raise FormatError("trailer duration differs")
    return {
        "codec": media.family, "channels": media.channels, "rate": media.rate, "duration": media.duration, "has_seek": media.has_seek, "trailer_kind": kind,
        "media_bytes": media.size, "media_sha256": _sha256(fetch, offset + 4, media.size), "companion_bytes": companion_size, "companion_sha256": _sha256(fetch, companion_offset, companion_size),
    }


def layout(selection: DataFrame, order: str) -> DataFrame:
    """Adds entry_index, wave_offset and companion_offset that a compact archive of these rows gets, in order, and its number of entries and bytes.

    selection has media_bytes and companion_bytes. Offsets are prefix sums by pieces; `fits` is
    false from the first row that ends beyond 4 GiB.
    """
    block = F.col("media_bytes") + BLOCK_EXTRA
    placed = selection.drop("entry_index").withColumn("__bytes", (block + F.col("companion_bytes")).cast("long"))
    placed = placed_in_order(placed, "__bytes", order, total_into="wave_offset", place_into="entry_index")
    whole = placed.agg(F.count("*").alias("entries"), F.coalesce(F.sum("__bytes"), F.lit(0)).alias("__payload"))
    many = F.col("entries")
    # the count takes 6 bits in its first byte and 7 in each further one
    header = 10 + F.when(many < 64, 1).otherwise(1 + F.ceil((F.floor(F.log2(many)) - 5) / 7)) + ENTRY_BYTES * many + 2
    out = placed.crossJoin(F.broadcast(whole.withColumn("__header", header.cast("long"))))  # one row
    out = out.withColumn("wave_offset", F.col("__header") + F.col("wave_offset")).withColumn("archive_bytes", F.col("__header") + F.col("__payload"))
    out = out.withColumn("companion_offset", F.when(F.col("companion_bytes") > 0, F.col("wave_offset") + block).otherwise(0))
    return out.withColumn("fits", F.col("wave_offset") + F.col("__bytes") <= 0xFFFFFFFF).drop("__bytes", "__header", "__payload")


def build(items: list[tuple[int, int, bytes, int, bytes]]) -> bytes:
    """Archive of (id, id_high, media, kind, companion) items."""
    at = 10 + len(encode_count(len(items))) + ENTRY_BYTES * len(items) + 2
    index, body = [], []
    for ident, high, media, kind, companion in items:
        size = len(media) + BLOCK_EXTRA
        index.append(struct.pack("<10I", ident, high, at, 0, size, 0, at + size if companion else 0, 0, len(companion), 0))
        body += [struct.pack("<I", len(media)), media, struct.pack("<fI", parse_media(media).duration, kind), companion]
        at += size + len(companion)
    return b"".join([MAGIC, struct.pack("<IH", VERSION, 0), encode_count(len(items)), *index, struct.pack("<H", 0), *body])


def changed_payloads(old: DataFrame, new: DataFrame) -> DataFrame:
    """(ident, ident_high, change) between two archives' rows: payload, companion, metadata, added, removed, moved."""
    cols = ("entry_index", "media_sha256", "companion_sha256", "trailer_kind", "codec", "channels", "rate")
    key = ["ident", "ident_high"]
    a = old.select(*key, *[F.col(c).alias(f"a_{c}") for c in cols])
    b = new.select(*key, *[F.col(c).alias(f"b_{c}") for c in cols])
    same = lambda c: F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}"))
    change = (
        F.when(F.col("a_entry_index").isNull(), "added").when(F.col("b_entry_index").isNull(), "removed").when(~same("companion_sha256"), "companion")
        .when(~(same("trailer_kind") & same("codec") & same("channels") & same("rate")), "metadata").when(~same("media_sha256"), "payload").when(~same("entry_index"), "moved")
    )
    return a.join(b, key, "full_outer").select(*key, change.alias("change")).where("change is not null")
