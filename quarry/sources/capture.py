"""Capture times: camera metadata, then file names, then modification times. Times are microseconds since 1970 in UTC."""

from __future__ import annotations

import struct

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Tag numbers of the metadata standard.
ORIENTATION, MODIFIED, SUB_FOLDER = 274, 306, 34665
ORIGINAL, DIGITIZED, ORIGINAL_FRACTION, DIGITIZED_FRACTION = 36867, 36868, 37521, 37522

#: The file name formats that are times, each a pattern of its own.
#: YYYYMMDD, one character that is no digit or none, HHMMSS, then 3 to 6 digits of a fraction.
WITH_FRACTION = r"(?<!\d)(\d{4})(\d{2})(\d{2})[^\d]?(\d{2})(\d{2})(\d{2})(\d{3,6})(?!\d)"
#: YYYYMMDD, one character that is no digit or none, HHMMSS.
COMPACT = r"(?<!\d)(\d{4})(\d{2})(\d{2})[^\d]?(\d{2})(\d{2})(\d{2})(?!\d)"
#: YYYY-MM-DD, a gap, HH-MM-SS, with dashes, underscores, points, or colons in the time.
SEPARATED = r"(?<!\d)(\d{4})[-_.](\d{2})[-_.](\d{2})[ T_-]+(\d{2})[-_.:](\d{2})[-_.:](\d{2})(?!\d)"
#: Fixed value: YYYY:MM:DD HH:MM:SS of the metadata standard, with an offset or none.
STAMP = r"^(\d{4}):(\d{1,2}):(\d{1,2})\s+(\d{1,2}):(\d{1,2}):(\d{1,2})(Z|[+-]\d{2}:?\d{2})?$"


def _folder(data: bytes, base: int, at: int, order: str) -> dict[int, object]:
    """Short numbers, long numbers and texts of one folder of tags."""
    out: dict[int, object] = {}
    (count,) = struct.unpack_from(order + "H", data, base + at)
    for i in range(count):
        tag, kind, n, value = struct.unpack_from(order + "HHI4s", data, base + at + 2 + 12 * i)
        if kind == 3:
            out[tag] = struct.unpack(order + "H", value[:2])[0]
        elif kind == 4:
            out[tag] = struct.unpack(order + "I", value)[0]
        elif kind == 2:
            start = base + struct.unpack(order + "I", value)[0]
            raw = value[:n] if n <= 4 else data[start : start + n]
            out[tag] = raw.split(b"\0")[0].decode("latin-1")
    return out


def _block(data: bytes) -> int | None:
    """Where the metadata's own header starts: in a JPEG's segment, in a PNG's chunk, or at a TIFF's front."""
    if data[:4] in (b"II*\0", b"MM\0*"):
        return 0
    if data[:2] == b"\xff\xd8":
        at = 2
        while at + 4 <= len(data) and data[at] == 0xFF and data[at + 1] != 0xDA:
            if data[at + 1] == 0xE1 and data[at + 4 : at + 10] == b"Exif\0\0":
                return at + 10
            at += 2 + struct.unpack_from(">H", data, at + 2)[0]
    if data[:8] == b"\x89PNG\r\n\x1a\n":
        at = 8
        while at + 8 <= len(data):
            size, kind = struct.unpack_from(">I4s", data, at)
            if kind == b"eXIf":
                return at + 8
            at += 12 + size
    return None


def metadata(data: bytes) -> dict[int, object]:
    """Tags of both folders, the first one's first; nothing where the block is absent or broken."""
    try:
        base = _block(data)
        if base is None:
            return {}
        order = "<" if data[base : base + 2] == b"II" else ">"
        first = _folder(data, base, struct.unpack_from(order + "I", data, base + 4)[0], order)
        try:
            second = _folder(data, base, int(first[SUB_FOLDER]), order) if SUB_FOLDER in first else {}
        except struct.error:
            second = {}
        return second | first
    except struct.error:
        return {}


def _made(text: Column, pattern: str) -> Column:
    """Microseconds of the first match's six groups; null without a match or for an impossible date."""
    part = [F.regexp_extract(text, pattern, i).try_cast("int") for i in range(1, 7)]
    stamp = F.try_make_timestamp(*part[:5], part[5].cast("decimal(8,6)"), F.lit("UTC"))
    return F.when((part[0] >= 1) & (part[5] < 60), F.unix_micros(stamp))


def _micros(digits: Column) -> Column:
    return F.rpad(F.substring(digits, 1, 6), 6, "0").try_cast("long")


def stamp_time(value: Column, fraction: Column | None = None) -> Column:
    """A metadata time `Y:m:d H:M:S`, dashes allowed in the date, with or without an offset; UTC by default."""
    text = F.trim(value)
    text = F.regexp_replace(text, r"^([^-]*)-([^-]*)-", "$1:$2:")
    text = F.regexp_replace(text, r"^([^-]*)-([^-]*)$", "$1:$2")
    zone = F.regexp_extract(text, STAMP, 7)
    span = F.substring(zone, 2, 2).try_cast("long") * 3600 + F.substring(F.replace(zone, F.lit(":"), F.lit("")), 4, 2).try_cast("long") * 60
    shift = F.when(zone.isin("", "Z"), F.lit(0)).otherwise(F.when(zone.startswith("-"), -span).otherwise(span))
    time = _made(text, STAMP) - shift * 1_000_000
    if fraction is None:
        return time
    return time + F.coalesce(_micros(F.nullif(F.regexp_replace(fraction, r"\D", ""), F.lit(""))), F.lit(0))


def file_stem(path: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(path, "([^/]*)$", 1), r"(?<=.)\.[^.]*$", "")


def name_time(stem: Column) -> Column:
    """The first pattern whose first match is a possible date."""
    fraction = _micros(F.regexp_extract(stem, WITH_FRACTION, 7))
    return F.coalesce(_made(stem, WITH_FRACTION) + fraction, _made(stem, COMPACT), _made(stem, SEPARATED))


def capture_time(tags: Column, stem: Column, modified: Column, use_exif: bool = True, use_filename: bool = True, use_mtime: bool = False) -> Column:
    """struct(capture_us, capture_source); null and '' where no source gives a time. tags: original, original_fraction, digitized, digitized_fraction, modified."""
    chain = []
    if use_exif:
        # one expression over the three stamps: written out three times, its generated code would be too long to compile
        pairs = [(tags["original"], tags["original_fraction"]), (tags["digitized"], tags["digitized_fraction"]), (tags["modified"], F.lit(None).cast("string"))]
        stamps = F.transform(F.array(*[F.struct(v.alias("value"), f.alias("fraction")) for v, f in pairs]), lambda x: stamp_time(x["value"], x["fraction"]))
        chain.append((F.get(F.filter(stamps, lambda t: t.isNotNull()), 0), "exif"))
    if use_filename:
        chain.append((name_time(stem), "filename"))
    if use_mtime:
        chain.append((F.unix_micros(modified), "mtime"))
    none = F.struct(F.lit(None).cast("long").alias("capture_us"), F.lit("").alias("capture_source"))
    found = [F.when(t.isNotNull(), F.struct(t.alias("capture_us"), F.lit(s).alias("capture_source"))) for t, s in chain]
    return F.coalesce(*found, none)
