"""Matroska media columns: a writer of 8-bit PCM files and a parser to packet tables.

The parser reads EBML elements with variable-length ids and sizes (unknown sizes included), tracks,
clusters, simple blocks and block groups with no, Xiph, fixed-size or EBML lacing, and cues. Each
packet has its track, timestamp in ticks, and byte range in the file.
"""

from __future__ import annotations

import struct
from typing import NamedTuple

# Element ids of the Matroska specification.
EBML, SEGMENT, INFO, TRACKS, TRACK, CLUSTER, CUES = 0x1A45DFA3, 0x18538067, 0x1549A966, 0x1654AE6B, 0xAE, 0x1F43B675, 0x1C53BB6B
TICK, NUMBER, UID, KIND, CODEC, AUDIO, RATE, CHANNELS, DEPTH = 0x2AD7B1, 0xD7, 0x73C5, 0x83, 0x86, 0xE1, 0xB5, 0x9F, 0x6264
TIME, SIMPLE, GROUP, BLOCK, POINT, CUE_TIME, CUE_AT, CUE_TRACK, CUE_CLUSTER = 0xE7, 0xA3, 0xA0, 0xA1, 0xBB, 0xB3, 0xB7, 0xF7, 0xF1
DOC_TYPE, DOC_VERSION, DOC_READ, DEFAULT = 0x4282, 0x4287, 0x4285, 0x23E383
NESTED = {EBML, SEGMENT, INFO, TRACKS, TRACK, AUDIO, CLUSTER, GROUP, CUES, POINT, CUE_AT}
TOP = {INFO, TRACKS, CLUSTER, CUES}

#: The written form: 8000 one-byte samples a second, a tick a sample, frames of 64, eight to a block, 32 blocks to a cluster.
SAMPLES_A_SECOND, FRAME, LACED, BLOCKS = 8000, 64, 8, 32
TICK_NS = 1_000_000_000 // SAMPLES_A_SECOND


class Packet(NamedTuple):
    track: int
    timestamp: int
    start: int
    end: int
    keyframe: bool


class Media(NamedTuple):
    """Codec and audio form of each track, packets in file order, and cues as (timestamp, track, byte of the cluster)."""

    tick_ns: int
    tracks: dict[int, tuple[str, float, int, int]]
    packets: list[Packet]
    cues: list[tuple[int, int, int]]


def size_bytes(n: int, length: int = 0) -> bytes:
    """A variable-length size: its length is told by the leading bit; all ones is kept for unknown."""
    length = length or next(k for k in range(1, 9) if n < (1 << 7 * k) - 1)
    return (n | 1 << 7 * length).to_bytes(length, "big")


def element(kind: int, body: bytes) -> bytes:
    return kind.to_bytes((kind.bit_length() + 7) // 8, "big") + size_bytes(len(body)) + body


def number(kind: int, n: int) -> bytes:
    return element(kind, n.to_bytes(max(1, (n.bit_length() + 7) // 8), "big"))


def read_size(data: bytes, at: int) -> tuple[int, int]:
    """A size and the place after it; -1 for unknown."""
    if at >= len(data) or not data[at]:
        raise ValueError(f"no size at byte {at}")
    length = 9 - data[at].bit_length()
    if at + length > len(data):
        raise ValueError(f"a size is cut off at byte {at}")
    n = int.from_bytes(data[at : at + length], "big") & (1 << 7 * length) - 1
    return (-1 if n == (1 << 7 * length) - 1 else n), at + length


def read_head(data: bytes, at: int, end: int) -> tuple[int, int, int]:
    """An element's id, and begin and end of its body."""
    if not data[at]:
        raise ValueError(f"no element id at byte {at}")
    length = 9 - data[at].bit_length()
    kind = int.from_bytes(data[at : at + length], "big")
    size, body = read_size(data, at + length)
    stop = end if size < 0 else body + size
    if stop > end:
        raise ValueError(f"the element at byte {at} goes past its parent")
    return kind, body, stop


def elements(data: bytes, at: int, end: int, parent: int = 0):  # noqa: ANN201
    """(id, begin, end) of a body's elements; one of unknown size ends where a top-level element of the segment follows."""
    while at < end:
        kind, body, stop = read_head(data, at, end)
        if kind == CLUSTER and read_size(data, at + 4)[0] < 0:
            stop = body
            while stop < end:
                inner, _, after = read_head(data, stop, end)
                if inner in TOP:
                    break
                stop = after
        yield kind, body, stop
        at = stop


def written(payload: bytes) -> bytes:
    """A file of one PCM track that holds the payload, a multiple of 64 bytes."""
    audio = element(RATE, struct.pack(">d", SAMPLES_A_SECOND)) + number(CHANNELS, 1) + number(DEPTH, 8)
    track = number(NUMBER, 1) + number(UID, 1) + number(KIND, 2) + element(CODEC, b"A_PCM/INT/LIT") + element(AUDIO, audio)
    body = element(INFO, number(TICK, TICK_NS)) + element(TRACKS, element(TRACK, track))
    parts, at, points, step = [body], len(body), [], FRAME * LACED
    for begin in range(0, len(payload), step * BLOCKS):
        cluster = [number(TIME, begin)]
        for b in range(begin, min(len(payload), begin + step * BLOCKS), step):
            frames = payload[b : b + step]
            n = len(frames) // FRAME
            head = b"\x81" + struct.pack(">hB", b - begin, 0x84 if n > 1 else 0x80)  # a key frame; fixed-size lacing for several
            cluster.append(element(SIMPLE, head + (bytes([n - 1]) if n > 1 else b"") + frames))
        points.append(element(POINT, number(CUE_TIME, begin) + element(CUE_AT, number(CUE_TRACK, 1) + number(CUE_CLUSTER, at))))
        parts.append(element(CLUSTER, b"".join(cluster)))
        at += len(parts[-1])
    parts.append(element(CUES, b"".join(points)))
    head = element(EBML, element(DOC_TYPE, b"matroska") + number(DOC_VERSION, 4) + number(DOC_READ, 2))
    return head + element(SEGMENT, b"".join(parts))


def frame_ranges(data: bytes, at: int, end: int, lacing: int) -> list[tuple[int, int]]:
    """Byte ranges of a block's frames. Lacing: 0 none, 1 Xiph, 2 fixed size, 3 EBML."""
    if not lacing:
        return [(at, end)]
    n, at = data[at] + 1, at + 1
    if lacing == 2:
        if (end - at) % n:
            raise ValueError("fixed-size lacing doesn't divide its block")
        sizes = [(end - at) // n] * (n - 1)
    elif lacing == 1:
        sizes = []
        while len(sizes) < n - 1:
            size = 0
            while data[at] == 255:
                size, at = size + 255, at + 1
            sizes.append(size + data[at])
            at += 1
    else:
        sizes = []
        for i in range(n - 1):
            begin = at
            value, at = read_size(data, at)
            # after the first, differences: a signed number of as many bits
            sizes.append(value if not i else sizes[-1] + value - ((1 << 7 * (at - begin) - 1) - 1))
    out = []
    for size in sizes:
        out.append((at, at + size))
        at += size
    if at > end or any(b < a for a, b in out):
        raise ValueError("lacing goes past its block")
    return [*out, (at, end)]


def parsed(data: bytes) -> Media:
    """The file's tables; ValueError where it isn't well-formed, cut off or lacks what a packet needs."""
    try:
        return _parsed(data)
    except (struct.error, IndexError, KeyError, StopIteration, UnicodeDecodeError, OverflowError) as e:
        raise ValueError(f"not well-formed: {type(e).__name__}: {e}") from e


def _parsed(data: bytes) -> Media:
    tick, tracks, packets, cues, segment = 1_000_000, {}, [], [], None

    def unsigned(a: int, b: int) -> int:
        return int.from_bytes(data[a:b], "big")

    def block(a: int, b: int, time: int, simple: bool) -> None:
        track, a = read_size(data, a)
        if a + 3 > b:
            raise ValueError(f"the block at byte {a} is shorter than its header")
        shift, flags = struct.unpack_from(">hB", data, a)
        frames = frame_ranges(data, a + 3, b, flags >> 1 & 3)
        each = durations.get(track, 0)
        for i, (x, y) in enumerate(frames):
            length = each // tick if each else y - x if tracks.get(track, ("",))[0].startswith("A_PCM") and tick == TICK_NS else 0
            packets.append(Packet(track, time + shift + i * length, x, y, bool(flags & 0x80) or not simple))

    durations: dict[int, int] = {}
    for kind, body, stop in elements(data, 0, len(data)):
        if kind == EBML:
            names = [data[a:b] for k, a, b in elements(data, body, stop) if k == DOC_TYPE]
            if names and names[0].rstrip(b"\0") not in (b"matroska", b"webm"):
                raise ValueError("another kind of EBML file")
        if kind != SEGMENT:
            continue
        segment = body
        for top, a, b in elements(data, body, stop):
            if top == INFO:
                tick = next((unsigned(x, y) for k, x, y in elements(data, a, b) if k == TICK), tick)
            elif top == TRACKS:
                for k, x, y in elements(data, a, b):
                    if k == TRACK:
                        of = {j: (p, q) for j, p, q in elements(data, x, y)}
                        sound = {j: (p, q) for j, p, q in elements(data, *of[AUDIO])} if AUDIO in of else {}
                        rate = data[slice(*sound[RATE])] if RATE in sound else b""
                        rate = struct.unpack({4: ">f", 8: ">d"}[len(rate)], rate)[0] if rate else 8000.0
                        n = unsigned(*of[NUMBER])
                        tracks[n] = (data[slice(*of[CODEC])].decode(), rate, unsigned(*sound[CHANNELS]) if CHANNELS in sound else 1, unsigned(*sound[DEPTH]) if DEPTH in sound else 0)
                        if DEFAULT in of:
                            durations[n] = unsigned(*of[DEFAULT])
            elif top == CLUSTER:
                time = 0
                for k, x, y in elements(data, a, b):
                    if k == TIME:
                        time = unsigned(x, y)
                    elif k == SIMPLE:
                        block(x, y, time, True)
                    elif k == GROUP:
                        for j, p, q in elements(data, x, y):
                            if j == BLOCK:
                                block(p, q, time, False)
            elif top == CUES:
                for k, x, y in elements(data, a, b):
                    if k == POINT:
                        inner = list(elements(data, x, y))
                        time = next(unsigned(p, q) for j, p, q in inner if j == CUE_TIME)
                        for j, p, q in inner:
                            if j == CUE_AT:
                                at = {i: unsigned(r, s) for i, r, s in elements(data, p, q)}
                                cues.append((time, at[CUE_TRACK], segment + at[CUE_CLUSTER]))
    if segment is None:
        raise ValueError("no segment")
    return Media(tick, tracks, packets, cues)


def samples(data: bytes, media: Media, track: int = 1) -> bytes:
    """A track's packets, joined in file order."""
    return b"".join([data[p.start : p.end] for p in media.packets if p.track == track])
