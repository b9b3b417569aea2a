"""Ogg media columns: texts stored losslessly as 8-bit samples in a multiplexed Ogg file, and read back.

Writing: the samples form one logical stream (uncompressed PCM, 8 bits, 8 kHz), cues with each packet's
checksum form another; their pages are interleaved. Reading verifies every page's checksum, puts packets
together from lacing values, also over page borders, takes the logical streams apart by serial number,
and derives times from granule positions.

Defined results: a null text is stored like an empty one, as blanks; a null or damaged file is not `ok`, has an
`error` and null payload; equal bytes give equal results, repeated rows each their own; whole texts are stored,
whatever their length; an empty table gives an empty table; extra columns pass through, columns with the
names of results are replaced.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, schema_with, slices, table, with_columns

RATE = 8000
#: Samples in a packet, segments in a page at most, and what the payload's length is a multiple of.
PACKET, SEGMENTS, FRAME = 3840, 128, 192
SOUND, CUES = 1, 2
CONTINUED, FIRST, LAST = 1, 2, 4
_HEAD = struct.Struct("<4sBBqIIIB")
_MIRROR = bytes(int(f"{b:08b}"[::-1], 2) for b in range(256))


def checksum(page: bytes) -> int:
    """Ogg's CRC-32: polynomial 04c11db7, most significant bit first, from 0. zlib's is the same over mirrored bits."""
    return int(f"{zlib.crc32(page.translate(_MIRROR), 0xFFFFFFFF) ^ 0xFFFFFFFF:032b}"[::-1], 2)


def pages(packets: list[tuple[bytes, int]], serial: int) -> list[tuple[int, bytes]]:
    """Pages of one logical stream with their granule position, from its packets and the position at each one's end."""
    segments: list[tuple[int, bytes, int]] = []
    for data, position in packets:
        whole, rest = divmod(len(data), 255)
        for i in range(whole):
            segments.append((255, data[255 * i : 255 * i + 255], -1))
        segments.append((rest, data[255 * whole :], position))
    first = sum(1 for _ in packets[:1] for _ in range(len(packets[0][0]) // 255 + 1))
    groups = [segments[:first]] + [segments[i : i + SEGMENTS] for i in range(first, len(segments), SEGMENTS)]
    out, open_packet = [], False
    for number, group in enumerate(groups):
        position = max([p for _, _, p in group])
        kind = CONTINUED * open_packet | FIRST * (number == 0) | LAST * (number == len(groups) - 1)
        open_packet = group[-1][2] < 0
        body = bytes(n for n, _, _ in group) + b"".join([x for _, x, _ in group])
        page = _HEAD.pack(b"OggS", 0, kind, position, serial, number, 0, len(group)) + body
        out.append((position, page[:22] + struct.pack("<I", checksum(page)) + page[26:]))
    return out


def write(payload: bytes) -> bytes:
    head = struct.pack("<8sHHIIBBHI", b"PCM     ", 0, 0, 1, RATE, 8, 1, PACKET, 0)
    sound, cues = [(head, 0)], [(b"cues\0\0\0\0" + struct.pack("<I", RATE), 0)]
    for i in range(0, len(payload), PACKET):
        part = payload[i : i + PACKET]
        sound.append((part, i + len(part)))
        cues.append((struct.pack("<III", i, len(part), zlib.crc32(part)), i + len(part)))
    a, b = pages(sound, SOUND), pages(cues, CUES)
    rest = sorted([(p, 0, i, x) for i, (p, x) in enumerate(a[1:])] + [(p, 1, i, x) for i, (p, x) in enumerate(b[1:])])
    return a[0][1] + b[0][1] + b"".join(x for *_, x in rest)


def streams(media: bytes) -> dict[int, list[tuple[bytes, int]]]:
    """The packets of each logical stream, with the granule position known at each one's end (-1: none)."""
    out: dict[int, list[tuple[bytes, int]]] = {}
    parts: dict[int, list[bytes]] = {}
    numbers: dict[int, int] = {}
    ended, at = set(), 0
    while at < len(media):
        if len(media) < at + 27:
            raise ValueError("cut page header")
        capture, version, kind, position, serial, number, said, count = _HEAD.unpack_from(media, at)
        if capture != b"OggS" or version:
            raise ValueError("no page where one should begin")
        lacing = media[at + 27 : at + 27 + count]
        end = at + 27 + count + sum(lacing)
        if len(lacing) < count or len(media) < end:
            raise ValueError("cut page")
        page = media[at:end]
        if checksum(page[:22] + bytes(4) + page[26:]) != said:
            raise ValueError("wrong page checksum")
        if number != numbers.get(serial, -1) + 1 or (kind & FIRST > 0) != (number == 0) or serial in ended:
            raise ValueError("page out of order")
        if (kind & CONTINUED > 0) != bool(parts.get(serial)):
            raise ValueError("broken packet")
        numbers[serial] = number
        packets, open_parts = out.setdefault(serial, []), parts.setdefault(serial, [])
        begin = before = at + 27 + count
        done = len(packets)
        for n in lacing:
            before += n
            if n < 255:
                packets.append((b"".join([*open_parts, media[begin:before]]), -1))
                open_parts.clear()
                begin = before
        if begin < before or (count and lacing[-1] == 255):
            open_parts.append(media[begin:before])
        if len(packets) > done:
            packets[-1] = packets[-1][0], position
        if kind & LAST:
            ended.add(serial)
        at = end
    if set(out) - ended or any(parts.values()):
        raise ValueError("a stream does not end")
    return out


def timed(packets: list[tuple[bytes, int]]) -> list[tuple[int, int]]:
    """First sample of each packet and the one behind its last, from granule positions: a page's position is where the last
    packet that ends on it ends; those before it end where the next one begins. A gap or an overlap is an error."""
    out, then = [], None
    for data, position in reversed(packets):
        end = position if position >= 0 else then
        if end is None or end < len(data) or then not in (None, end):
            raise ValueError("granule position off")
        then = end - len(data)
        out.append((then, end))
    if then:
        raise ValueError("granule position off")
    return out[::-1]


def read(media: bytes) -> dict:
    """Payload, counts, times and features of a file as write() makes it; raises ValueError when damaged."""
    found = streams(media)
    if SOUND not in found or CUES not in found or found[SOUND][0][0][:8] != b"PCM     ":
        raise ValueError("not the streams that are expected")
    rate = struct.unpack_from("<I", found[SOUND][0][0], 16)[0]
    sound, cues = found[SOUND][1:], found[CUES][1:]
    spans = timed(sound)
    cue = [struct.unpack("<III", x) for x, _ in cues]
    if len(cue) != len(sound) or any(c[1:] != (len(x), zlib.crc32(x)) for c, (x, _) in zip(cue, sound, strict=True)):
        raise ValueError("cues and packets differ")
    payload = b"".join([x for x, _ in sound])
    samples = np.frombuffer(payload, np.uint8)
    centred = samples.astype(np.int64) - 128
    crossed = int(np.count_nonzero((centred[1:] < 0) != (centred[:-1] < 0)))
    last = spans[-1][1] if spans else 0
    return {
        "payload": payload,
        "n_streams": len(found),
        "n_packets": len(sound),
        "starts_s": [begin / rate for begin, _ in spans],
        "duration_s": last / rate,
        "feature": f"s={len(samples)};ms={1000 * last // rate};mean={int(centred.sum())};energy={int((centred * centred).sum())};cross={crossed};lo={int(samples.min())};hi={int(samples.max())}",
    }


RESULT = T.StructType(
    [
        T.StructField("ok", T.BooleanType()),
        T.StructField("error", T.StringType()),
        T.StructField("payload", T.BinaryType()),
        T.StructField("n_streams", T.IntegerType()),
        T.StructField("n_packets", T.IntegerType()),
        T.StructField("starts_s", T.ArrayType(T.DoubleType())),
        T.StructField("duration_s", T.DoubleType()),
        T.StructField("feature", T.StringType()),
    ]
)


def padded(text: bytes) -> bytes:
    """Blanks are appended up to a positive multiple of FRAME bytes."""
    return text + b" " * (-len(text) % FRAME if text else FRAME)


def store(df: DataFrame, text: str = "text", media: str = "media") -> DataFrame:
    """Adds the Ogg file that holds the text's bytes, padded with blanks, as samples."""
    bounded_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, text):
                texts = batch.column(text).cast(pa.binary()).to_pylist()
                yield with_columns(batch, **{media: pa.array([write(padded(x or b"")) for x in texts], pa.binary())})

    return df.mapInArrow(run, schema_with(df, **{media: T.BinaryType()}))


def probe(df: DataFrame, media: str = "media", result: str = "probe") -> DataFrame:
    """Adds what reading the file gives."""
    bounded_batches(df.sparkSession)
    kind = pa.struct([("ok", pa.bool_()), ("error", pa.string()), ("payload", pa.binary()), ("n_streams", pa.int32()), ("n_packets", pa.int32()), ("starts_s", pa.list_(pa.float64())), ("duration_s", pa.float64()), ("feature", pa.string())])

    def one(data: bytes | None) -> dict:
        try:
            return {"ok": True} | read(data) if data is not None else {"ok": False, "error": "null"}
        except (ValueError, struct.error) as e:
            return {"ok": False, "error": str(e)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, media):
                yield with_columns(batch, **{result: pa.array([one(x) for x in batch.column(media).to_pylist()], kind)})

    return df.mapInArrow(run, schema_with(df, **{result: RESULT}))


def op5_ogg_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    slim = store(docs).select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "media")
    return probe(slim).select(
        "doc_id",
        "n_bytes",
        F.octet_length("probe.payload").cast("long").alias("payload_bytes"),
        F.sha2("probe.payload", 256).alias("payload_sha256"),
        F.crc32(F.substring("probe.payload", -16, 16)).alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        F.col("probe.feature").alias("feature"),
        F.col("probe.duration_s").alias("duration_s"),
        F.element_at("probe.starts_s", -1).alias("last_start_s"),
    )
