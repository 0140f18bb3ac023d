"""The pixel layout of TIFF files: where strips and tiles lie, their decoding into arrays, and the encoding of tiled files."""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np

from geoloom.sources.files import TAGS, directory, placed

#: Fixed values of the format: sample bits, compression, strip offsets, rows a strip, strip sizes, planar layout, predictor, tile width, tile height, tile offsets, tile sizes, sample format.
LAYOUT_TAGS = (258, 259, 273, 278, 279, 284, 317, 322, 323, 324, 325, 339)
PLAIN, LZW, DEFLATE, OLD_DEFLATE, PACKED = 1, 5, 8, 32946, 32773
KINDS = {1: "u", 2: "i", 3: "f"}


@dataclass
class Layout:
    """How one file keeps its pixels. Chunks are its strips or tiles, row by row; planes of separate bands follow each other."""

    header: tuple
    kind: str
    compression: int
    predictor: int
    planar: int
    width: int
    height: int
    bands: int
    chunk_width: int
    chunk_height: int
    tiled: bool
    offsets: tuple[int, ...]
    sizes: tuple[int, ...]

    @property
    def across(self) -> int:
        return -(-self.width // self.chunk_width)

    @property
    def down(self) -> int:
        return -(-self.height // self.chunk_height)

    def planes(self, chunk: int) -> list[tuple[int, int]]:
        """Offset and size of a chunk's bytes, one pair for each separate band."""
        n = self.across * self.down
        return [(self.offsets[i], self.sizes[i]) for i in range(chunk, n * (self.bands if self.planar == 2 else 1), n)]


def layout(f) -> Layout:
    """The layout of an open file."""
    got = directory(f, TAGS + LAYOUT_TAGS)
    head = placed(got)
    width, height, bands = head[:3]
    one = lambda tag, default: got.get(tag, (default,))[0]
    bits = set(got.get(258, (1,)))
    if len(bits) > 1 or not bits <= {8, 16, 32, 64} or one(339, 1) not in KINDS:
        raise ValueError(f"samples of {sorted(bits)} bits are not read")
    tiled = 322 in got
    size = (one(322, width), one(323, height)) if tiled else (width, min(height, one(278, height)))
    kind = got[0].decode() + KINDS[one(339, 1)] + str(bits.pop() // 8)
    return Layout(head, kind, one(259, 1), one(317, 1), one(284, 1), width, height, bands, *size, tiled, got[324 if tiled else 273], got[325 if tiled else 279])


def unpacked(raw: bytes) -> bytes:
    """PackBits: runs and literals."""
    out, at = bytearray(), 0
    while at < len(raw):
        n = raw[at]
        if n < 128:
            out += raw[at + 1 : at + n + 2]
            at += n + 2
        elif n > 128:
            out += raw[at + 1 : at + 2] * (257 - n)
            at += 2
        else:
            at += 1
    return bytes(out)


def unlzw(raw: bytes) -> bytes:
    """LZW with codes of 9 to 12 bits, most significant bit first, which grow one code early."""
    clear, end = 256, 257
    first = [bytes([i]) for i in range(256)] + [b"", b""]
    table, out, bits, held, have, last = list(first), [], 9, 0, 0, b""
    for byte in raw:
        held, have = (held << 8) | byte, have + 8
        if have < bits:
            continue
        have -= bits
        code, held = held >> have, held & ((1 << have) - 1)
        if code == end:
            break
        if code == clear:
            table, bits, last = list(first), 9, b""
            continue
        if code > len(table) or not last and code >= clear:
            raise ValueError("damaged LZW data")
        word = table[code] if code < len(table) else last + last[:1]
        out.append(word)
        if last:
            table.append(last + word[:1])
        last = word
        bits = min(12, max(9, (len(table) + 1).bit_length()))
    return b"".join(out)


def decompressed(raw: bytes, compression: int) -> bytes:
    if compression == PLAIN:
        return raw
    if compression in (DEFLATE, OLD_DEFLATE):
        return zlib.decompress(raw)
    if compression == LZW:
        return unlzw(raw)
    if compression == PACKED:
        return unpacked(raw)
    raise ValueError(f"compression {compression} is not read")


def decoded(raw: bytes, kind: str, compression: int, predictor: int, rows: int, cols: int, samples: int) -> np.ndarray:
    """One chunk's samples as (rows, cols, samples)."""
    dtype, data = np.dtype(kind), decompressed(raw, compression)
    data = data[: rows * cols * samples * dtype.itemsize]
    if predictor == 3:  # bytes of a row stand by significance, each the difference to the one a pixel before
        planes = np.frombuffer(data, np.uint8).reshape(rows, cols * dtype.itemsize, samples)
        planes = np.cumsum(planes, axis=1, dtype=np.uint8).reshape(rows, dtype.itemsize, cols * samples)
        return np.ascontiguousarray(planes.transpose(0, 2, 1)).view(">f" + str(dtype.itemsize)).reshape(rows, cols, samples).astype(dtype.newbyteorder("="))
    x = np.frombuffer(data, dtype).reshape(rows, cols, samples)
    if predictor == 2:
        plain = x.view(f"{dtype.byteorder}u{dtype.itemsize}").astype(f"=u{dtype.itemsize}")
        return np.cumsum(plain, axis=1, dtype=plain.dtype).view(dtype.newbyteorder("=").str)
    return x.astype(dtype.newbyteorder("="))


def encoded(x: np.ndarray) -> bytes:
    """(rows, cols, samples) deflated, with the predictor that predictor_of() names; little-endian."""
    rows, cols, samples = x.shape
    size = x.dtype.itemsize
    if x.dtype.kind == "f":
        planes = np.ascontiguousarray(x.astype(f">f{size}").reshape(rows, cols * samples)).view(np.uint8).reshape(rows, cols * samples, size).transpose(0, 2, 1).reshape(rows, cols * size, samples)
        return zlib.compress(np.diff(planes, axis=1, prepend=np.zeros((rows, 1, samples), np.uint8)).astype(np.uint8).tobytes())
    plain = np.ascontiguousarray(x).view(f"=u{size}")
    return zlib.compress(np.diff(plain, axis=1, prepend=np.zeros((rows, 1, samples), plain.dtype)).astype(f"<u{size}").tobytes())


def predictor_of(kind: str) -> int:
    return 3 if np.dtype(kind).kind == "f" else 2


def file_head(width: int, height: int, bands: int, kind: str, tile: int, sizes: list[int], affine: tuple[float, ...], epsg: int | None, nodata: float | None) -> bytes:
    """All that stands before the tiles of a little-endian tiled file: tiles follow at once in the order of sizes (0: a tile without pixels). 64-bit offsets where the file needs them."""
    dtype = np.dtype(kind)
    big = sum(sizes) > 2**32 - 2**24 - 64 * len(sizes)
    place, count, room = ("Q", "Q", 8) if big else ("I", "H", 4)
    a, b, c, d, e, f = affine
    listed = [1, 1, 0, 3, 1024, 0, 1, 2 if epsg and 4000 <= epsg < 5000 else 1, 1025, 0, 1, 1, 2048 if epsg and 4000 <= epsg < 5000 else 3072, 0, 1, epsg or 0]
    values: list[tuple[int, int, int, bytes]] = [
        (256, 4, 1, struct.pack("<I", width)), (257, 4, 1, struct.pack("<I", height)), (258, 3, bands, struct.pack(f"<{bands}H", *[dtype.itemsize * 8] * bands)), (259, 3, 1, struct.pack("<H", DEFLATE)),
        (262, 3, 1, struct.pack("<H", 2 if bands >= 3 else 1)), (277, 3, 1, struct.pack("<H", bands)), (284, 3, 1, struct.pack("<H", 1)), (317, 3, 1, struct.pack("<H", predictor_of(kind))),
        (322, 4, 1, struct.pack("<I", tile)), (323, 4, 1, struct.pack("<I", tile)), (324, 16 if big else 4, len(sizes), b"\0" * room * len(sizes)), (325, 16 if big else 4, len(sizes), struct.pack(f"<{len(sizes)}{place}", *sizes)),
        (339, 3, bands, struct.pack(f"<{bands}H", *[{"u": 1, "i": 2, "f": 3}[dtype.kind]] * bands)),
    ]
    extra = bands - 3 if bands > 3 else bands - 1 if bands == 2 else 0
    if extra:
        values.append((338, 3, extra, struct.pack(f"<{extra}H", *[0] * extra)))
    if b == 0 and d == 0 and e < 0 < a:
        values += [(33550, 12, 3, struct.pack("<3d", a, -e, 0)), (33922, 12, 6, struct.pack("<6d", 0, 0, 0, c, f, 0))]
    else:
        values.append((34264, 12, 16, struct.pack("<16d", a, b, 0, c, d, e, 0, f, 0, 0, 0, 0, 0, 0, 0, 1)))
    if epsg:
        values.append((34735, 3, len(listed), struct.pack(f"<{len(listed)}H", *listed)))
    if nodata is not None:
        text = f"{nodata:.17g}".encode() + b"\0"
        values.append((42113, 2, len(text), text))
    values.sort()
    start = 16 if big else 8
    behind_at = start + struct.calcsize("<" + count) + len(values) * (4 + 2 * room) + room
    long = [len(raw) > room for _, _, _, raw in values]
    at = behind_at + sum(len(raw) + len(raw) % 2 for (_, _, _, raw), behind in zip(values, long, strict=True) if behind)
    offsets = []
    for n in sizes:
        offsets.append(at if n else 0)
        at += n
    values = [(tag, kind_, n, struct.pack(f"<{n}{place}", *offsets) if tag == 324 else raw) for tag, kind_, n, raw in values]
    entries, behind = b"", b""
    for (tag, kind_, n, raw), is_long in zip(values, long, strict=True):
        own = struct.pack("<" + place, behind_at + len(behind)) if is_long else raw.ljust(room, b"\0")
        behind += raw + b"\0" * (len(raw) % 2) if is_long else b""
        entries += struct.pack(f"<HH{place}", tag, kind_, n) + own
    top = b"II" + (struct.pack("<HHHQ", 43, 8, 0, start) if big else struct.pack("<HI", 42, start))
    return top + struct.pack("<" + count, len(values)) + entries + b"\0" * room + behind
