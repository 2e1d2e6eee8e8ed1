"""Baseline JPEG: a writer for byte payloads and a reader of any baseline file.

The reader parses markers, decodes Huffman scans and keeps the DC coefficients of
the first (luminance) component: one sample for each 8 x 8 block, which is the
image at an eighth of its size. Segments between restart markers are independent,
so all segments of all images of a batch are decoded side by side in numpy, a
symbol at a time.

The writer stores one payload byte in each block's DC coefficient with a
quantiser of 8, so that the thumbnail is the payload, bit for bit. It is a plain
grey-scale baseline file that any decoder opens.
"""

from __future__ import annotations

import struct
from functools import lru_cache
from typing import NamedTuple

import numpy as np

ZIGZAG_DC_ONLY = bytes([8] + [1] * 63)
#: Payload bytes in a row of blocks, which is also the restart interval.
ROW = 192
#: Rows of blocks that the format's 16-bit height holds; longer payloads take more images.
MOST_ROWS = 65535 // 8
_DC_CODES = ((2, 0), (3, 2), (3, 3), (3, 4), (3, 5), (3, 6), (4, 14), (5, 30), (6, 62))
_DC_COUNTS = bytes([0, 1, 5, 1, 1, 1] + [0] * 10)
_DC_VALUES = bytes(range(9))
_AC_COUNTS = bytes([1] + [0] * 15)
_AC_VALUES = bytes([0])


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


@lru_cache(4096)
def _head(rows: int) -> bytes:
    return b"".join((
        b"\xff\xd8",
        _segment(0xDB, b"\x00" + ZIGZAG_DC_ONLY),
        _segment(0xC0, struct.pack(">BHHBBBB", 8, rows * 8, ROW * 8, 1, 1, 0x11, 0)),
        _segment(0xC4, b"\x00" + _DC_COUNTS + _DC_VALUES),
        _segment(0xC4, b"\x10" + _AC_COUNTS + _AC_VALUES),
        _segment(0xDD, struct.pack(">H", ROW)),
        _segment(0xDA, struct.pack(">BBBBBB", 1, 1, 0x00, 0, 63, 0)),
    ))


@lru_cache(1)
def _codes() -> tuple[np.ndarray, np.ndarray]:
    """For each difference from -255 to 255: its bits (code, value, end of block) and their number."""
    bits, sizes = np.zeros(511, np.uint32), np.zeros(511, np.int64)
    for d in range(-255, 256):
        size = abs(d).bit_length()
        length, code = _DC_CODES[size]
        extra = d if d >= 0 else d + (1 << size) - 1
        bits[d + 255], sizes[d + 255] = ((code << size) | extra) << 1, length + size + 1
    return bits, sizes


def write(payloads: list[bytes]) -> list[bytes]:
    """A JPEG stream for each payload, whose length is a positive multiple of
    ``ROW``: one image, or several in a row if it is longer than an image holds."""
    parts, owner = [], []
    for i, p in enumerate(payloads):
        if not p or len(p) % ROW:
            raise ValueError(f"a payload's length must be a positive multiple of {ROW}")
        for a in range(0, len(p), ROW * MOST_ROWS):
            parts.append(p[a : a + ROW * MOST_ROWS])
            owner.append(i)
    rows = np.frombuffer(b"".join(parts), np.uint8).reshape(-1, ROW).astype(np.int16) - 128
    diff = np.diff(rows, axis=1, prepend=np.int16(0))
    table, lengths = _codes()
    code, size = table[diff + 255], lengths[diff + 255]
    ends = size.cumsum(1)
    width = (ends[:, -1] + 7) // 8
    # the bits of a row's blocks go to at most four bytes each; ones fill the last byte
    base = np.concatenate([[0], np.cumsum(width)])
    start = (base[:-1, None] * 8 + ends - size).ravel()
    shifted = code.ravel().astype(np.uint64) << (np.uint64(32) - size.ravel().astype(np.uint64) - (start & 7).astype(np.uint64))
    first = start >> 3
    out = np.zeros(int(base[-1]) + 4, np.int64)
    for k in range(4):
        out += np.bincount(first + k, ((shifted >> np.uint64(24 - 8 * k)) & np.uint64(255)).astype(np.float64), minlength=len(out)).astype(np.int64)
    spare = width * 8 - ends[:, -1]
    out[base[1:] - 1] += (1 << spare) - 1
    data = out[: base[-1]].astype(np.uint8).tobytes()
    streams: list[list[bytes]] = [[] for _ in payloads]
    row = 0
    for p, i in zip(parts, owner):
        n = len(p) // ROW
        scan = []
        for k in range(n):
            scan.append(data[base[row + k] : base[row + k + 1]].replace(b"\xff", b"\xff\x00"))
            scan.append(b"\xff" + bytes([0xD0 + (k & 7)]))
        scan.pop()
        streams[i] += [_head(n), *scan, b"\xff\xd9"]
        row += n
    return [b"".join(s) for s in streams]


class Scan(NamedTuple):
    """What the markers of one image say, and its entropy-coded segments."""

    width: int
    height: int
    sampling: tuple[tuple[int, int], ...]
    dc: tuple[bytes, ...]
    ac: tuple[bytes, ...]
    quantiser: int
    interval: int
    segments: tuple[bytes, ...]


def parse(data: bytes) -> list[Scan]:
    """The baseline images that stand one after another in ``data``."""
    images, at = [], 0
    quant: dict[int, int] = {}
    huff: dict[int, bytes] = {}
    frame, interval = None, 0
    while at + 4 <= len(data) or data[at : at + 2] in (b"\xff\xd8", b"\xff\xd9"):
        if data[at] != 0xFF:
            raise ValueError(f"no marker at byte {at}")
        marker = data[at + 1]
        if marker == 0xFF:
            at += 1
            continue
        at += 2
        if marker in (0xD8, 0xD9):
            if marker == 0xD8:
                quant, huff, frame, interval = {}, {}, None, 0
            continue
        (n,) = struct.unpack_from(">H", data, at)
        body = data[at + 2 : at + n]
        at += n
        if marker == 0xDB:
            while body:
                wide = body[0] >> 4
                quant[body[0] & 15] = struct.unpack_from(">H", body, 1)[0] if wide else body[1]
                body = body[1 + 64 * (1 + bool(wide)) :]
        elif marker == 0xC4:
            while body:
                total = sum(body[1:17])
                huff[body[0]], body = body[1 : 17 + total], body[17 + total :]
        elif marker == 0xDD:
            (interval,) = struct.unpack(">H", body)
        elif marker in (0xC0, 0xC1):
            _, height, width, count = struct.unpack_from(">BHHB", body)
            frame = (width, height, {body[6 + 3 * i]: (body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(count)})
        elif 0xC2 <= marker <= 0xCF:
            raise ValueError("not a baseline JPEG")
        elif marker == 0xDA:
            if frame is None:
                raise ValueError("a scan without a frame")
            parts = [(body[1 + 2 * i], body[2 + 2 * i]) for i in range(body[0])]
            segments, start = [], at
            while True:
                at = data.find(b"\xff", at)
                if at < 0 or at + 1 >= len(data):
                    raise ValueError("the scan has no end")
                if data[at + 1] == 0:
                    at += 2
                elif 0xD0 <= data[at + 1] <= 0xD7:
                    segments.append(data[start:at])
                    at = start = at + 2
                else:
                    segments.append(data[start:at])
                    break
            specs = [frame[2][c] for c, _ in parts]
            if parts[0][0] == next(iter(frame[2])):
                sampling = tuple((h, v) for h, v, _ in specs) if len(parts) > 1 else ((1, 1),)
                images.append(Scan(frame[0], frame[1], sampling, tuple(huff[t >> 4] for _, t in parts), tuple(huff[16 | (t & 15)] for _, t in parts), quant[specs[0][2]], interval, tuple(s.replace(b"\xff\x00", b"\xff") for s in segments)))
    return images


@lru_cache(64)
def _lookup(table: bytes) -> np.ndarray:
    """For each 16 bits that may come: symbol * 32 + length of the code (0: none)."""
    out, code, at = np.zeros(1 << 16, np.int32), 0, 16
    for length in range(1, 17):
        for _ in range(table[length - 1]):
            lo = code << (16 - length)
            out[lo : lo + (1 << (16 - length))] = table[at] * 32 + length
            at, code = at + 1, code + 1
        code <<= 1
    return out


def thumbnails(scans: list[Scan]) -> list[np.ndarray]:
    """The DC-only luminance image of each scan, 8-bit samples."""
    out: list[np.ndarray | None] = [None] * len(scans)
    alike: dict[tuple, list[int]] = {}
    for i, s in enumerate(scans):
        alike.setdefault((s.sampling, s.dc, s.ac), []).append(i)
    for (sampling, dc, ac), which in alike.items():
        blocks = [(c, k) for c, (h, v) in enumerate(sampling) for k in range(h * v)]
        # MCUs in each segment
        segments, need, owner = [], [], []
        for i in which:
            s = scans[i]
            hm, vm = max(h for h, _ in sampling), max(v for _, v in sampling)
            total = -(-s.width // (8 * hm)) * -(-s.height // (8 * vm))
            step = s.interval or total
            for k, seg in enumerate(s.segments):
                segments.append(seg)
                need.append(max(0, min(step, total - k * step)))
                owner.append(i)
        levels = _decode(segments, np.array(need, np.int64), blocks, [_lookup(t) for t in dc], [_lookup(t) for t in ac])
        luma, at = sampling[0][0] * sampling[0][1], 0
        need = np.array(need)
        for i in which:
            s = scans[i]
            n = int(need[at : at + len(s.segments)].sum()) * luma
            start = int(need[:at].sum()) * luma if at == 0 else end
            end = start + n
            at += len(s.segments)
            h, v = sampling[0]
            hm, vm = max(a for a, _ in sampling), max(b for _, b in sampling)
            across, down = -(-s.width // (8 * hm)), -(-s.height // (8 * vm))
            grid = np.zeros(across * down * luma, np.int64)
            grid[:n] = levels[start:end]
            grid = grid.reshape(down, across, v, h).transpose(0, 2, 1, 3).reshape(down * v, across * h)
            grid = grid[: -(-s.height * v // (8 * vm)), : -(-s.width * h // (8 * hm))]
            out[i] = np.clip(np.rint(grid * s.quantiser / 8) + 128, 0, 255).astype(np.uint8)
    return out


def _decode(segments: list[bytes], need: np.ndarray, blocks: list, dc: list, ac: list) -> np.ndarray:
    """DC levels of the first component's blocks, segment after segment."""
    pad = b"\0" * 8
    data = np.frombuffer(pad.join(segments) + pad, np.uint8)
    sizes = np.array([len(s) for s in segments], np.int64)
    position = (np.cumsum(sizes + 8) - sizes - 8) * 8
    wide = (data[:-2].astype(np.uint32) << 16) | (data[1:-1].astype(np.uint32) << 8) | data[2:]

    def peek(at: np.ndarray) -> np.ndarray:
        return (wide[at >> 3] >> (8 - (at & 7)).astype(np.uint32)) & np.uint32(0xFFFF)

    # long segments first, so that those still busy are a prefix
    order = np.argsort(-need, kind="stable")
    position, left = position[order], need[order]
    luma = sum(c == 0 for c, _ in blocks)
    starts = np.concatenate([[0], np.cumsum(need * luma)])[:-1][order]
    out = np.zeros(int((need * luma).sum()), np.int64)
    last = np.zeros((len(dc), len(segments)), np.int64)
    for mcu in range(int(left.max(initial=0))):
        busy = int(np.searchsorted(-left, -mcu, side="left"))
        at = position[:busy]
        for nth, (c, _) in enumerate(blocks):
            found = dc[c][peek(at)]
            size = found >> 5
            at = at + (found & 31)
            if size.any():
                value = (peek(at) >> (16 - size).astype(np.uint32)).astype(np.int64)
                value = np.where((size > 0) & (value < (1 << np.maximum(size - 1, 0))), value - (1 << size) + 1, value)
                at = at + size
                last[c, :busy] += value
            if c == 0:
                out[starts[:busy] + mcu * luma + nth] = last[0, :busy]
            # AC coefficients are only walked over
            coefficient, going = np.ones(busy, np.int64), None
            while True:
                here = at if going is None else at[going]
                found = ac[c][peek(here)]
                symbol = found >> 5
                here = here + (found & 31) + (symbol & 15)
                if going is None:
                    at = here
                else:
                    at[going] = here
                mine = coefficient if going is None else coefficient[going]
                mine = np.where((symbol == 0) | (found == 0), 64, mine + (symbol >> 4) + 1)
                if going is None:
                    coefficient = mine
                else:
                    coefficient[going] = mine
                going = np.flatnonzero(coefficient < 64)
                if not len(going):
                    break
        position[:busy] = at
    return out


def read(data: bytes) -> bytes:
    """The payload that ``write`` stored."""
    return b"".join(t.tobytes() for t in thumbnails(parse(data)))
