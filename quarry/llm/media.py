"""Media columns: baseline JPEG, written and read in numpy.

Reading parses the markers, Huffman-decodes the scan and reconstructs a luminance thumbnail from the DC coefficients
alone, one pixel a block. All restart intervals of a batch of pictures are decoded side by side, a symbol of each at a
time, so the work is array operations, not a Python loop over symbols. Grey and colour pictures with any sampling
factors are read; progressive, arithmetic-coded and 12-bit ones are refused with ValueError.

Writing stores bytes losslessly in the format's own unit, the quantised coefficient: 64 bytes are the 64 coefficients
of one 8 x 8 block, each value plus one, under a quantisation table of ones, one block a restart interval. A comment
marker holds the payload's length; blocks past it fill the last row of blocks.

Cases: a null text counts as empty and is stored as 64 zero bytes; equal texts have equal files and features; an empty
table gives no rows; one very long text is one picture of its own, up to about 4 GB.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import documents, flat, passes

BLOCK = 64
ROW_BLOCKS = 64
MOST_BLOCKS = 8191  # of one side: the format's 65,535 pixels
#: Code lengths 1 to 16 and symbols: a DC or AC symbol's low four bits are the number of value bits.
DC_TABLE = (bytes([1, 1, 1, 0, 0, 6, 1, 0, 0, 0, 0, 0, 0, 0, 0, 0]), bytes([7, 6, 8, 5, 1, 4, 2, 3, 0, 9]))
AC_TABLE = (bytes([1, 1, 1, 0, 0, 7, 1, 0, 0, 0, 0, 0, 0, 0, 0, 0]), bytes([0x07, 0x06, 0x08, 0x05, 0x01, 0x04, 0x02, 0x03, 0x00, 0x09, 0xF0]))


def _codes(table: tuple[bytes, bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Canonical code and its length by symbol (length 0: none)."""
    code, length = np.zeros(256, np.int64), np.zeros(256, np.int64)
    at = value = 0
    for n, count in enumerate(table[0], 1):
        for s in table[1][at : at + count]:
            code[s], length[s] = value, n
            value += 1
        at += count
        value <<= 1
    return code, length


def _lookup(table: tuple[bytes, bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Symbol and code length by the next 16 bits (length 0: no such code)."""
    code, length = _codes(table)
    symbol, size = np.zeros(1 << 16, np.int16), np.zeros(1 << 16, np.int8)
    for s in table[1]:
        a = int(code[s]) << (16 - int(length[s]))
        b = a + (1 << (16 - int(length[s])))
        symbol[a:b], size[a:b] = s, length[s]
    return symbol, size


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">HH", 0xFF00 | marker, len(body) + 2) + body


def shape(blocks: int) -> tuple[int, int]:
    """Blocks in a row, and rows, for a payload of so many blocks."""
    wide = min(blocks, max(ROW_BLOCKS, -(-blocks // MOST_BLOCKS)))
    high = -(-blocks // wide)
    if high > MOST_BLOCKS or wide > MOST_BLOCKS:
        raise ValueError("payload too long for one picture")
    return wide, high


def write_jpegs(payloads: list[bytes]) -> list[bytes]:
    """One baseline JPEG per payload, whose coefficients are the payload; lengths are positive multiples of 64."""
    if not payloads:
        return []
    counts = np.array([len(p) // BLOCK for p in payloads])
    shapes = [shape(n) for n in counts.tolist()]
    full = np.array([w * h for w, h in shapes])
    ends = np.cumsum(full)
    dc, ac = _codes(DC_TABLE), _codes(AC_TABLE)
    joined = np.frombuffer(b"".join(p + bytes(BLOCK * int(f - n)) for p, f, n in zip(payloads, full, counts)), np.uint8).reshape(-1, BLOCK)
    kept = np.arange(len(joined)) - np.repeat(ends - full, full) < np.repeat(counts, full)
    streams: list[np.ndarray] = []
    sizes: list[np.ndarray] = []
    size_of = np.array([0, *(int(x).bit_length() for x in range(1, 257))])
    values = np.arange(257)
    dc_bits, dc_len = (dc[0][size_of] << size_of) | values, dc[1][size_of] + size_of
    ac_bits, ac_len = (ac[0][size_of] << size_of) | values, ac[1][size_of] + size_of
    end_bits, end_len, zero_bits, zero_len = int(ac[0][0]), int(ac[1][0]), int(dc[0][0]), int(dc[1][0])
    for a in range(0, len(joined), 1 << 14):
        v = joined[a : a + (1 << 14)].astype(np.int64) + 1
        keep = kept[a : a + (1 << 14)]
        bits = np.zeros((len(v), BLOCK + 1), np.uint16)
        length = np.zeros((len(v), BLOCK + 1), np.uint8)
        bits[:, 0], length[:, 0] = dc_bits[v[:, 0]], dc_len[v[:, 0]]
        bits[:, 1:BLOCK], length[:, 1:BLOCK] = ac_bits[v[:, 1:]], ac_len[v[:, 1:]]
        if not keep.all():  # a block of zeros: DC difference 0, end of block
            bits[~keep], length[~keep] = 0, 0
            bits[~keep, 0], length[~keep, 0] = zero_bits, zero_len
            bits[~keep, 1], length[~keep, 1] = end_bits, end_len
        pad = (-length.sum(axis=1, dtype=np.int64)) % 8
        bits[:, BLOCK], length[:, BLOCK] = (1 << pad) - 1, pad
        place = np.arange(15, -1, -1, dtype=np.uint16)
        each = ((bits[:, :, None] >> place) & 1).astype(np.uint8)
        streams.append(np.packbits(each[place < length[:, :, None]]))
        sizes.append(length.sum(axis=1, dtype=np.int64) // 8)
    stream, size = np.concatenate(streams), np.concatenate(sizes)
    # a byte 255 gets a zero after it, and each block a restart marker after it (the last of a picture is cut off)
    block = np.repeat(np.arange(len(size)), size)
    ff = stream == 255
    at = np.arange(len(stream)) + np.cumsum(ff) - ff + 2 * block
    out = np.zeros(len(stream) + int(ff.sum()) + 2 * len(size), np.uint8)
    out[at] = stream
    last = np.cumsum(size) - 1
    mark = at[last] + 1 + ff[last]
    out[mark] = 255
    out[mark + 1] = 0xD0 + (np.arange(len(size)) - np.repeat(ends - full, full)) % 8
    cuts = mark[ends - 1]
    begins = np.concatenate([[0], cuts[:-1] + 2])
    tables = _segment(0xDB, b"\0" + b"\1" * 64) + _segment(0xC4, b"\0" + DC_TABLE[0] + DC_TABLE[1]) + _segment(0xC4, b"\x10" + AC_TABLE[0] + AC_TABLE[1]) + _segment(0xDD, struct.pack(">H", 1))
    scan = _segment(0xDA, b"\1\1\0\0\x3f\0")
    return [b"\xff\xd8" + _segment(0xFE, struct.pack(">Q", len(p))) + tables + _segment(0xC0, struct.pack(">BHHB", 8, 8 * h, 8 * w, 1) + b"\1\x11\0") + scan + out[a:b].tobytes() + b"\xff\xd9" for p, (w, h), a, b in zip(payloads, shapes, begins.tolist(), cuts.tolist())]


@dataclass
class Picture:
    """What the markers say, and then the coefficients in scan order (block, 64)."""

    width: int = 0
    height: int = 0
    parts: list[tuple[int, int, int, int]] = field(default_factory=list)  # id, horizontal and vertical sampling, quantisation table
    tables: dict[int, tuple[bytes, bytes]] = field(default_factory=dict)  # Huffman tables: 0-3 DC, 16-19 AC
    quant: dict[int, np.ndarray] = field(default_factory=dict)
    use: dict[int, tuple[int, int]] = field(default_factory=dict)  # part id: DC and AC table
    restart: int = 0
    comment: bytes = b""
    scan: tuple[int, int] = (0, 0)
    coefficients: np.ndarray | None = None

    def schedule(self) -> list[int]:
        """The part of each block of one MCU."""
        return [0] if len(self.parts) == 1 else [i for i, (_, h, v, _) in enumerate(self.parts) for _ in range(h * v)]

    def units(self) -> tuple[int, int]:
        """MCUs in a row, and rows of them."""
        h, v = (1, 1) if len(self.parts) == 1 else (max(p[1] for p in self.parts), max(p[2] for p in self.parts))
        return -(-self.width // (8 * h)), -(-self.height // (8 * v))


def parse(b: bytes) -> Picture:
    """The markers up to the scan's data."""
    if b[:2] != b"\xff\xd8":
        raise ValueError("not a JPEG")
    p, at = Picture(), 2
    while at + 4 <= len(b):
        if b[at] != 0xFF:
            raise ValueError("marker expected")
        kind = b[at + 1]
        if kind == 0xFF:
            at += 1
            continue
        (n,) = struct.unpack_from(">H", b, at + 2)
        body = b[at + 4 : at + 2 + n]
        at += 2 + n
        if kind == 0xDB:
            while body:
                wide = body[0] >> 4
                p.quant[body[0] & 15] = np.frombuffer(body[1 : 1 + 64 * (1 + wide)], ">u2" if wide else "u1").astype(np.int64)
                body = body[1 + 64 * (1 + wide) :]
        elif kind == 0xC4:
            while body:
                count = sum(body[1:17])
                p.tables[body[0]] = (body[1:17], body[17 : 17 + count])
                body = body[17 + count :]
        elif kind == 0xC0 or kind == 0xC1:
            bits, p.height, p.width, count = struct.unpack_from(">BHHB", body)
            if bits != 8 or not p.height or not p.width:
                raise ValueError("8-bit pictures of known size only")
            p.parts = [(body[6 + 3 * i], body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(count)]
        elif kind in (0xC2, 0xC3, *range(0xC5, 0xC8), *range(0xC9, 0xD0)):
            raise ValueError("not a baseline picture")
        elif kind == 0xDD:
            (p.restart,) = struct.unpack(">H", body)
        elif kind == 0xFE:
            p.comment = body
        elif kind == 0xDA:
            if body[0] != len(p.parts):
                raise ValueError("one interleaved scan expected")
            p.use = {body[1 + 2 * i]: (body[2 + 2 * i] >> 4, 16 + (body[2 + 2 * i] & 15)) for i in range(body[0])}
            end = b.rfind(b"\xff\xd9")
            p.scan = (at, end if end >= at else len(b))
            return p
    raise ValueError("no scan")


_lookups: dict[tuple[bytes, bytes], tuple[np.ndarray, np.ndarray]] = {}


def _decode(pictures: list[tuple[Picture, bytes]]) -> None:
    """Huffman-decode the scans of pictures that have the same tables, parts and restart interval."""
    first = pictures[0][0]
    schedule = first.schedule()
    look = []
    for part in first.parts:
        for which in first.use[part[0]]:
            if which not in first.tables:
                raise ValueError("missing Huffman table")
            t = first.tables[which]
            _lookups.setdefault(t, _lookup(t))
        look.append([_lookups[first.tables[k]] for k in first.use[part[0]]])
    raw = np.frombuffer(b"".join(b[p.scan[0] : p.scan[1]] for p, b in pictures) + bytes(8), np.uint8)
    ends = np.cumsum([p.scan[1] - p.scan[0] for p, _ in pictures])
    nxt = np.concatenate([raw[1:], [0]])
    mark = (raw == 255) & (nxt >= 0xD0) & (nxt <= 0xD7)
    drop = np.zeros(len(raw), bool)
    drop[1:] = (raw[:-1] == 255) & (raw[1:] == 0)
    drop |= mark
    drop[1:] |= mark[:-1]
    where = np.concatenate([[0], np.cumsum(~drop)])  # place of a raw byte in the unstuffed data
    data = np.concatenate([raw[~drop], np.zeros(8, np.uint8)]).astype(np.uint32)
    starts = np.sort(np.concatenate([[0], ends[:-1], np.flatnonzero(mark) + 2]))
    # intervals: how many blocks each holds
    blocks, owner = [], []
    for i, (p, _) in enumerate(pictures):
        wide, high = p.units()
        total = wide * high
        step = p.restart or total
        n = np.full(-(-total // step), step)
        n[-1] = total - step * (len(n) - 1)
        blocks.append(n * len(schedule))
        owner.append(len(n))
    todo = np.concatenate(blocks)
    if len(starts) != len(todo):
        raise ValueError("restart markers do not match the size")
    base = np.concatenate([[0], np.cumsum(todo)])
    coef = np.zeros((int(base[-1]), 64), np.int16)
    bit = where[starts].astype(np.int64) * 8
    limit = np.concatenate([where[starts[1:]], [where[ends[-1]]]]).astype(np.int64) * 8
    predicted = np.zeros((len(todo), len(first.parts)), np.int64)

    def peek(at: np.ndarray) -> np.ndarray:
        i = at >> 3
        return ((data[i] << 16 | data[i + 1] << 8 | data[i + 2]) >> (8 - (at & 7)).astype(np.uint32)) & 0xFFFF

    def value(at: np.ndarray, size: np.ndarray) -> np.ndarray:
        v = (peek(at) >> (16 - size).astype(np.uint32)).astype(np.int64)
        return np.where((size > 0) & (v < (1 << np.maximum(size - 1, 0))), v - (1 << size) + 1, v)

    for number in range(int(todo.max())):
        part = schedule[number % len(schedule)]
        (dc_symbol, dc_size), (ac_symbol, ac_size) = look[part]
        lane = np.flatnonzero(todo > number)
        at = bit[lane]
        w = peek(at)
        if not dc_size[w].all():
            raise ValueError("bad code")
        size = dc_symbol[w].astype(np.int64)
        at = at + dc_size[w]
        predicted[lane, part] += value(at, size)
        at = at + size
        row = base[lane] + number
        coef[row, 0] = predicted[lane, part]
        k = np.ones(len(lane), np.int64)
        live = np.arange(len(lane))
        while len(live):
            a = at[live]
            w = peek(a)
            n = ac_size[w]
            if not n.all():
                raise ValueError("bad code")
            s = ac_symbol[w].astype(np.int64)
            a = a + n
            run, size = s >> 4, s & 15
            kk = k[live] + run
            has = size > 0
            if (kk[has] > 63).any():
                raise ValueError("too many coefficients")
            v = value(a, size)
            coef[row[live[has]], kk[has]] = v[has]
            a = a + size
            at[live] = a
            kk = np.where(has | (run == 15), kk + 1, 64)
            k[live] = kk
            live = live[(kk < 64) & (a <= limit[lane[live]])]
        bit[lane] = at
    if (bit > limit).any():
        raise ValueError("scan ends early")
    a = 0
    for (p, _), n in zip(pictures, blocks):
        p.coefficients = coef[a : a + int(n.sum())]
        a += int(n.sum())


def read_jpegs(files: list[bytes]) -> list[Picture]:
    """All pictures with their coefficients; those of one kind are decoded together."""
    out = [parse(b) for b in files]
    kinds: dict[tuple, list[tuple[Picture, bytes]]] = {}
    for p, b in zip(out, files):
        kinds.setdefault((tuple(sorted(p.tables.items())), tuple(p.parts), tuple(sorted(p.use.items())), p.restart), []).append((p, b))
    for group in kinds.values():
        _decode(group)
    return out


def thumbnail(p: Picture) -> np.ndarray:
    """Luminance, one pixel a block: a block's mean is its DC coefficient over 8, plus 128."""
    wide, high = p.units()
    h, v = (1, 1) if len(p.parts) == 1 else p.parts[0][1:3]
    dc = p.coefficients[:, 0].reshape(high, wide, -1)[:, :, : h * v].astype(np.int64) * int(p.quant[p.parts[0][3]][0])
    grid = dc.reshape(high, wide, v, h).transpose(0, 2, 1, 3).reshape(high * v, wide * h)
    most = (1, 1) if len(p.parts) == 1 else (max(x[1] for x in p.parts), max(x[2] for x in p.parts))
    grid = grid[: -(-p.height * v // (8 * most[1])), : -(-p.width * h // (8 * most[0]))]
    return np.clip((grid + 4 >> 3) + 128, 0, 255).astype(np.uint8)


def average_hash(pixels: np.ndarray, n: int = 8) -> int:
    """n x n bits: whether the mean of that part of the thumbnail reaches the mean of all parts."""
    def cells(size: int) -> tuple[np.ndarray, np.ndarray]:
        a = np.arange(n) * size // n
        return a, np.maximum((np.arange(n) + 1) * size // n, a + 1)

    total = np.zeros((pixels.shape[0] + 1, pixels.shape[1] + 1), np.int64)
    total[1:, 1:] = pixels.astype(np.int64).cumsum(0).cumsum(1)
    (top, bottom), (left, right) = cells(pixels.shape[0]), cells(pixels.shape[1])
    sums = total[bottom][:, right] - total[top][:, right] - total[bottom][:, left] + total[top][:, left]
    mean = sums / np.outer(bottom - top, right - left)
    return int("".join("01"[int(x)] for x in (mean >= mean.mean()).ravel()), 2)


def feature(p: Picture) -> str:
    """Width x height, average hash and checksum of the thumbnail."""
    t = thumbnail(p)
    return f"{p.width}x{p.height}:{average_hash(t):016x}:{zlib.crc32(t.tobytes()):08x}"


def payload(p: Picture) -> bytes:
    """What write_jpegs stored."""
    (n,) = struct.unpack(">Q", p.comment)
    return (p.coefficients[: n // BLOCK] - 1).astype(np.uint8).tobytes()


RESULT = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def media_columns(df: DataFrame, key: str = "doc_id", text: str = "text", keep_media: bool = False) -> DataFrame:
    """Store each text as a picture, read it back, and return digests and features (with keep_media, the file too)."""
    schema = RESULT + ", media binary" * keep_media

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in passes(batches, text, 1 << 20):
            data, at = flat(b.column(text))
            raw = [data[x:y].tobytes() for x, y in zip(at[:-1].tolist(), at[1:].tolist())]
            files = write_jpegs([r + bytes(-len(r) % BLOCK or (0 if r else BLOCK)) for r in raw])
            pictures = read_jpegs(files)
            back = [payload(p) for p in pictures]
            columns = [
                b.column(key).cast(pa.int64()),
                pa.array([len(r) for r in raw], pa.int64()),
                pa.array([len(x) for x in back], pa.int64()),
                pa.array([hashlib.sha256(x).hexdigest() for x in back], pa.string()),
                pa.array([zlib.crc32(x[-BLOCK:]) for x in back], pa.int64()),
                pa.array([len(f) for f in files], pa.int64()),
                pa.array([hashlib.sha256(f).hexdigest() for f in files], pa.string()),
                pa.array([feature(p) for p in pictures], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(files, pa.binary())] if keep_media else columns, [x.split()[0] for x in schema.split(", ")])

    return df.select(key, text).mapInArrow(run, schema)


def read_media(df: DataFrame, key: str, content: str) -> DataFrame:
    """Dimensions and thumbnail hash of JPEG files in a binary column; what can't be read has nulls and the reason."""
    schema = f"`{key}` {df.schema[key].dataType.simpleString()}, width int, height int, feature string, error string"

    def one(b: bytes | None) -> tuple:
        try:
            p = read_jpegs([b or b""])[0]
            return p.width, p.height, feature(p), None
        except (ValueError, IndexError, KeyError, struct.error) as e:
            return None, None, None, str(e) or type(e).__name__

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            w, h, f, e = zip(*map(one, b.column(1).to_pylist())) if b.num_rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(w, pa.int32()), pa.array(h, pa.int32()), pa.array(f, pa.string()), pa.array(e, pa.string())], [key, "width", "height", "feature", "error"])

    return df.select(key, content).mapInArrow(run, schema)


def op4_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_columns(documents(spark, sf_dir))
