"""Media columns: Matroska files in a binary column, written and parsed into packet tables.

`packets` reads any Matroska bytes: EBML elements of variable length (ids of 1-4 bytes, sizes of 1-8 bytes,
unknown sizes of segments and clusters), SimpleBlocks and BlockGroups with no, Xiph, fixed-size or EBML lacing,
and Cues. `to_matroska` stores a binary payload losslessly as 8-bit PCM. Both are maps over rows: nothing is
shuffled, memory is bounded by the largest file, and a lost task is simply run again.

Null or empty media give no packets; damaged files give the packets before the damage and `error` true.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import sha256
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame

from orrery.llm.common import arrow_rows, scratch, slices

# Fixed values of the Matroska specification (RFC 9559): element ids.
EBML, SEGMENT, INFO, TRACKS, CLUSTER, CUES = 0x1A45DFA3, 0x18538067, 0x1549A966, 0x1654AE6B, 0x1F43B675, 0x1C53BB6B
TIMESTAMP_SCALE, TRACK_ENTRY, TRACK_NUMBER, TRACK_UID, TRACK_TYPE, CODEC_ID = 0x2AD7B1, 0xAE, 0xD7, 0x73C5, 0x83, 0x86
AUDIO, SAMPLING, CHANNELS, BIT_DEPTH = 0xE1, 0xB5, 0x9F, 0x6264
TIMESTAMP, SIMPLE_BLOCK, BLOCK_GROUP, BLOCK, BLOCK_DURATION = 0xE7, 0xA3, 0xA0, 0xA1, 0x9B
CUE_POINT, CUE_TIME, CUE_POSITIONS, CUE_TRACK, CUE_CLUSTER = 0xBB, 0xB3, 0xB7, 0xF7, 0xF1
VERSION, READ_VERSION, MAX_ID, MAX_SIZE, DOC_TYPE, DOC_VERSION, DOC_READ = 0x4286, 0x42F7, 0x42F2, 0x42F3, 0x4282, 0x4287, 0x4285
MUXER, WRITER = 0x4D80, 0x5741
#: Elements that end a cluster or segment of unknown size.
TOP = {CLUSTER, CUES, INFO, TRACKS, 0x114D9B74, 0x1941A469, 0x1043A770, 0x1254C367}

UNKNOWN = -1
LACINGS = ("none", "xiph", "fixed", "ebml")


def vint(data: bytes, at: int, end: int, marker: bool = False) -> tuple[int, int]:
    """(value, next position) of a variable-length integer; `marker` keeps its length bit, as ids do."""
    if at >= end or not data[at]:
        raise ValueError("no variable-length integer")
    width = 9 - data[at].bit_length()
    if at + width > end:
        raise ValueError("cut off")
    value = int.from_bytes(data[at : at + width], "big")
    if marker:
        return value, at + width
    value &= (1 << 7 * width) - 1
    return (UNKNOWN if value == (1 << 7 * width) - 1 else value), at + width


def put_vint(value: int, width: int = 0) -> bytes:
    """`value` as a size, in the fewest bytes or in `width` of them."""
    width = width or next(w for w in range(1, 9) if value < (1 << 7 * w) - 1)
    return (value | 1 << 7 * width).to_bytes(width, "big")


def element(kind: int, body: bytes) -> bytes:
    return kind.to_bytes((kind.bit_length() + 7) // 8, "big") + put_vint(len(body)) + body


def uint(kind: int, value: int) -> bytes:
    return element(kind, value.to_bytes(max(1, (value.bit_length() + 7) // 8), "big"))


@dataclass
class Packet:
    track: int
    timestamp: int
    cluster: int
    block: int
    frame: int
    lacing: str
    keyframe: bool
    start: int
    size: int


@dataclass
class Media:
    scale: int = 1_000_000
    tracks: list[tuple[int, int, str]] = field(default_factory=list)
    packets: list[Packet] = field(default_factory=list)
    cues: list[tuple[int, int, int]] = field(default_factory=list)
    clusters: list[int] = field(default_factory=list)
    blocks: int = 0
    error: bool = False


def parse(data: bytes) -> Media:
    """Tracks, packets, cues and cluster positions of a Matroska file."""
    media = Media()
    try:
        _segment(data, media)
    except (ValueError, IndexError, struct.error):
        media.error = True
    return media


def _children(data: bytes, at: int, end: int, until: set[int] | frozenset = frozenset()) -> Iterator[tuple[int, int, int, int]]:
    """(id, element's start, body's start, body's end). A body of unknown size ends before the next id in TOP."""
    while at < end:
        start = at
        kind, at = vint(data, at, end, True)
        if kind in until:
            return
        size, at = vint(data, at, end)
        if size == UNKNOWN:
            if kind not in (SEGMENT, CLUSTER):
                raise ValueError("unknown size")
            stop = end if kind == SEGMENT else _cluster_end(data, at, end)
        else:
            stop = at + size
        if stop > end:
            yield kind, start, at, end
            raise ValueError("cut off")
        yield kind, start, at, stop
        at = stop


def _cluster_end(data: bytes, at: int, end: int) -> int:
    while at < end:
        kind, body = vint(data, at, end, True)
        if kind in TOP:
            return at
        size, body = vint(data, body, end)
        at = body + size
    return end


def _number(data: bytes, at: int, end: int) -> int:
    return int.from_bytes(data[at:end], "big")


def _segment(data: bytes, media: Media) -> None:
    for kind, _, body, stop in _children(data, 0, len(data)):
        if kind != SEGMENT:
            continue
        for kind, start, at, end in _children(data, body, stop):
            if kind == CLUSTER:
                media.clusters.append(start - body)
                _cluster(data, at, end, media)
            elif kind == INFO:
                for k, _, a, e in _children(data, at, end):
                    if k == TIMESTAMP_SCALE:
                        media.scale = _number(data, a, e)
            elif kind == TRACKS:
                for k, _, a, e in _children(data, at, end):
                    if k == TRACK_ENTRY:
                        got = {k2: (a2, e2) for k2, _, a2, e2 in _children(data, a, e)}
                        media.tracks.append((_number(data, *got.get(TRACK_NUMBER, (0, 0))), _number(data, *got.get(TRACK_TYPE, (0, 0))), data[slice(*got.get(CODEC_ID, (0, 0)))].decode("ascii", "replace")))
            elif kind == CUES:
                for k, _, a, e in _children(data, at, end):
                    if k == CUE_POINT:
                        _cue(data, a, e, media)


def _cue(data: bytes, at: int, end: int, media: Media) -> None:
    time, places = 0, []
    for kind, _, a, e in _children(data, at, end):
        if kind == CUE_TIME:
            time = _number(data, a, e)
        elif kind == CUE_POSITIONS:
            got = {k: _number(data, a2, e2) for k, _, a2, e2 in _children(data, a, e)}
            places.append((got.get(CUE_TRACK, 0), got.get(CUE_CLUSTER, 0)))
    media.cues += [(time, *p) for p in places]


def _cluster(data: bytes, at: int, end: int, media: Media) -> None:
    base, number = 0, len(media.clusters) - 1
    for kind, _, a, e in _children(data, at, end):
        if kind == TIMESTAMP:
            base = _number(data, a, e)
        elif kind == SIMPLE_BLOCK:
            _block(data, a, e, base, number, None, media)
        elif kind == BLOCK_GROUP:
            inner = list(_children(data, a, e))
            referenced = any(k == 0xFB for k, *_ in inner)
            for k, _, a2, e2 in inner:
                if k == BLOCK:
                    _block(data, a2, e2, base, number, not referenced, media)


def _block(data: bytes, at: int, end: int, base: int, cluster: int, key: bool | None, media: Media) -> None:
    track, at = vint(data, at, end)
    relative, flags = struct.unpack_from(">hB", data, at)
    at += 3
    lacing = (flags >> 1) & 3
    sizes: list[int] = []
    if lacing:
        count = data[at] + 1
        at += 1
        if lacing == 2:
            if (end - at) % count:
                raise ValueError("unequal fixed lacing")
            sizes = [(end - at) // count] * (count - 1)
        elif lacing == 1:
            for _ in range(count - 1):
                size = 0
                while True:
                    size += data[at]
                    at += 1
                    if data[at - 1] < 255:
                        break
                sizes.append(size)
        elif count > 1:
            size, at = vint(data, at, end)
            sizes.append(size)
            for _ in range(count - 2):
                before = at
                size, at = vint(data, at, end)
                width = at - before
                full = (1 << 7 * width) - 1
                sizes.append(sizes[-1] + (full if size == UNKNOWN else size) - (full >> 1))
    sizes.append(end - at - sum(sizes))
    if min(sizes) < 0:
        raise ValueError("lace beyond its block")
    keyframe = bool(flags & 0x80) if key is None else key
    for frame, size in enumerate(sizes):
        media.packets.append(Packet(track, (base + relative) * media.scale, cluster, media.blocks, frame, LACINGS[lacing], keyframe, at, size))
        at += size
    media.blocks += 1


_HEADER = element(EBML, uint(VERSION, 1) + uint(READ_VERSION, 1) + uint(MAX_ID, 4) + uint(MAX_SIZE, 8) + element(DOC_TYPE, b"matroska") + uint(DOC_VERSION, 4) + uint(DOC_READ, 2))


def mux(payload: bytes, rate: int = 8000, frame: int = 512, laced: int = 8, blocks: int = 8) -> bytes:
    """`payload` as 8-bit PCM samples: frames of `frame` bytes, `laced` of them a block, `blocks` blocks a cluster.

    Equal frames are laced with a fixed size, others by Xiph's or EBML's rule in turn.
    """
    head = element(INFO, uint(TIMESTAMP_SCALE, 1_000_000) + element(MUXER, b"orrery") + element(WRITER, b"orrery"))
    audio = element(SAMPLING, struct.pack(">d", float(rate))) + uint(CHANNELS, 1) + uint(BIT_DEPTH, 8)
    head += element(TRACKS, element(TRACK_ENTRY, uint(TRACK_NUMBER, 1) + uint(TRACK_UID, 1) + uint(TRACK_TYPE, 2) + element(CODEC_ID, b"A_PCM/INT/LIT") + element(AUDIO, audio)))
    out, cues, step, at = [head], [], frame * laced, len(head)
    for start in range(0, len(payload), step * blocks):
        time = start * 1000 // rate
        body = [uint(TIMESTAMP, time)]
        for k, b in enumerate(range(start, min(len(payload), start + step * blocks), step)):
            part = payload[b : min(len(payload), b + step)]
            sizes = [min(frame, len(part) - i) for i in range(0, len(part), frame)]
            kind = 0 if len(sizes) == 1 else 2 if sizes[-1] == sizes[0] else 1 + 2 * (k & 1)
            lace = b"" if not kind else bytes([len(sizes) - 1])
            if kind == 1:
                lace += b"".join(b"\xff" * (s // 255) + bytes([s % 255]) for s in sizes[:-1])
            elif kind == 3:
                lace += put_vint(sizes[0]) + b"".join(put_vint(s - r + 63, 1) for r, s in zip(sizes, sizes[1:-1]))
            body.append(element(SIMPLE_BLOCK, b"\x81" + struct.pack(">hB", b * 1000 // rate - time, 0x80 | kind << 1) + lace + part))
        cues.append(element(CUE_POINT, uint(CUE_TIME, time) + element(CUE_POSITIONS, uint(CUE_TRACK, 1) + uint(CUE_CLUSTER, at))))
        out.append(element(CLUSTER, b"".join(body)))
        at += len(out[-1])
    out.append(element(CUES, b"".join(cues)))
    body = b"".join(out)
    return _HEADER + SEGMENT.to_bytes(4, "big") + put_vint(len(body), 8) + body


def padded(text: bytes, unit: int = 64) -> bytes:
    """`text` with bytes 0 up to a positive multiple of `unit`."""
    return text + b"\0" * (unit - len(text) if not text else -len(text) % unit)


def to_matroska(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, n_bytes, media): every whole text as UTF-8, padded and muxed. A null text counts as empty.

    Rows that repeat and rows without a key are muxed each; other columns are not read, whatever their names; a text of
    any length is one file, by itself in its slice if it is long. An empty table gives an empty result.
    """
    schema = pa.schema([(key, pa.int64()), ("n_bytes", pa.int64()), ("media", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, 1000):
                raw = [x or b"" for x in part.column(1).cast(pa.binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(map(len, raw), pa.int64()), pa.array((mux(padded(x)) for x in raw), pa.binary())], schema=schema)

    return df.select(df[key].cast("long").alias(key), df[text].cast("string")).mapInArrow(run, f"`{key}` long, n_bytes long, media binary")


def stored(media: DataFrame) -> DataFrame:
    """The media as a compressed table in the shared folder, read from there."""
    path = scratch(media.sparkSession, "media")
    media.write.option("compression", "zstd").parquet(path)
    return media.sparkSession.read.schema(media.schema).parquet(path)


def packets(df: DataFrame, key: str, media: str = "media") -> DataFrame:
    """The packet table: one row per frame with track, codec, timestamp in ns, cluster, block, lacing and byte range."""
    out = f"`{key}` long, track long, codec string, timestamp_ns long, cluster long, block long, frame long, lacing string, keyframe boolean, byte_start long, byte_size long, cued boolean, error boolean"
    kinds = [pa.int64(), pa.int64(), pa.string(), *[pa.int64()] * 4, pa.string(), pa.bool_(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_()]
    schema = pa.schema([(c.split()[0].strip("`"), t) for c, t in zip(out.split(", "), kinds)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for k, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                    m = parse(raw.as_py() or b"")
                    codec, cued = {n: c for n, _, c in m.tracks}, {c for _, _, c in m.cues}
                    for p in m.packets:
                        yield k, p.track, codec.get(p.track), p.timestamp, p.cluster, p.block, p.frame, p.lacing, p.keyframe, p.start, p.size, m.clusters[p.cluster] in cued, m.error

        yield from arrow_rows(rows(), schema)

    return df.select(df[key].cast("long").alias(key), df[media]).mapInArrow(run, out)


def features(df: DataFrame, key: str, media: str = "media") -> DataFrame:
    """Digests and a feature string from the stored bytes: what the packets hold, joined in order of the file."""
    out = f"`{key}` long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    kinds = [pa.int64()] * 3 + [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    schema = pa.schema([(c.split()[0].strip("`"), t) for c, t in zip(out.split(", "), kinds)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for k, n, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                    raw = raw.as_py() or b""
                    m = parse(raw)
                    payload = b"".join([raw[p.start : p.start + p.size] for p in m.packets])
                    laced = "".join(f"{x[0]}{sum(p.lacing == x for p in m.packets)}" for x in LACINGS)
                    last = m.packets[-1].timestamp // 1_000_000 if m.packets else -1
                    feature = f"tracks={len(m.tracks)} packets={len(m.packets)} blocks={m.blocks} clusters={len(m.clusters)} cues={len(m.cues)} lacing={laced} last_ms={last} symbols={len(set(payload))} peak={max(payload, default=0)} error={int(m.error)}"
                    yield k, n, len(payload), sha256(payload).hexdigest(), crc32(payload[-64:]), len(raw), sha256(raw).hexdigest(), feature

        yield from arrow_rows(rows(), schema)

    return df.select(df[key].cast("long").alias(key), df["n_bytes"], df[media]).mapInArrow(run, out)
