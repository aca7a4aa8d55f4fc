"""GRIB2 messages as rows: a Spark data source over files of regular latitude-longitude fields.

``spark.dataSource.register(Grib2Source)`` and ``spark.read.format("grib2").load(path)``. Each file is a partition; a
message is a row with its field and grid; missing points are null. Data templates 5.0 (simple), 5.2 and 5.3 (complex,
with spatial differences), 5.41 (PNG) and 5.42 (adaptive entropy coding) are read; other ones and other grids are refused by name.
"""

from __future__ import annotations

import glob
import os
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from . import aec, png

SCHEMA = (
    "file string, ordinal int, discipline int, ref_time timestamp_ntz, pdtn int, category int, number int, surface_type int, surface_value double, "
    "ni int, nj int, la1 double, lo1 double, di double, dj double, scan int, template int, values array<float>"
)


def _signed(raw: int, bits: int) -> int:
    """Sign and magnitude, as the format stores negative numbers."""
    top = 1 << (bits - 1)
    return -(raw - top) if raw & top else raw


def _int(b: bytes, at: int, size: int, signed: bool = False) -> int:
    raw = int.from_bytes(b[at : at + size], "big")
    return _signed(raw, 8 * size) if signed else raw


def bit_groups(data: bytes, widths: np.ndarray, start: int = 0) -> np.ndarray:
    """Unsigned numbers of the given widths, packed one after another from bit ``start``."""
    ends = start + np.cumsum(widths)
    if len(ends) and ends[-1] > 8 * len(data):
        raise ValueError("the packed data are cut")
    out = np.zeros(len(widths), np.int64)
    bits = np.unpackbits(np.frombuffer(data, np.uint8)).astype(np.int64)
    begins = ends - widths
    for k in range(int(widths.max()) if len(widths) else 0):
        live = widths > k
        out[live] = (out[live] << 1) | bits[begins[live] + k]
    return out


@dataclass
class Message:
    head: dict
    sections: dict[int, bytes]

    def scaled(self, packed: np.ndarray) -> np.ndarray:
        s = self.sections[5]
        r = struct.unpack(">f", s[11:15])[0]
        return (r + packed * 2.0 ** _int(s, 15, 2, True)) / 10.0 ** _int(s, 17, 2, True)

    def values(self) -> np.ndarray:
        """Every point of the grid in scanning order; NaN where the bitmap or a missing code says so."""
        s, data = self.sections[5], self.sections[7][5:]
        n, template = _int(s, 5, 4), _int(s, 9, 2)
        if template == 0:
            width = s[19]
            packed = bit_groups(data, np.full(n, width)) if width else np.zeros(n, np.int64)
            found = self.scaled(packed)
        elif template in (2, 3):
            found = self._complex(s, data, n, template)
        elif template == 41:
            v, _ = png.samples(data) if s[19] else (np.zeros(n, np.int64), {})
            found = self.scaled(v.reshape(-1)[:n] if v.ndim == 1 or v.shape[2] == 1 else v.reshape(n, -1) @ (256 ** np.arange(v.shape[2])[::-1]))
        elif template == 42:
            packed = aec.decode(data, n, s[19], s[22], _int(s, 23, 2), s[21]) if s[19] else np.zeros(n, np.int64)
            found = self.scaled(packed)
        else:
            raise ValueError(f"data template 5.{template} isn't read")
        bitmap = self.sections.get(6, b"\x00" * 5 + b"\xff")
        points = self.head["ni"] * self.head["nj"]
        if bitmap[5] == 255:
            if len(found) != points:
                raise ValueError("a message has fewer values than its grid has points")
            return found
        if bitmap[5] != 0:
            raise ValueError("predefined bitmaps aren't read")
        there = np.unpackbits(np.frombuffer(bitmap[6:], np.uint8))[:points].astype(bool)
        if there.sum() != len(found):
            raise ValueError("the bitmap has another number of points than there are values")
        out = np.full(points, np.nan)
        out[there] = found
        return out

    def _complex(self, s: bytes, data: bytes, n: int, template: int) -> np.ndarray:
        bits, missing = s[19], s[22]
        groups = _int(s, 31, 4)
        width_ref, width_bits = s[35], s[36]
        length_ref, length_step, last, length_bits = _int(s, 37, 4), s[41], _int(s, 42, 4), s[46]
        order, extra = (s[47], s[48]) if template == 3 else (0, 0)
        at = 0
        first, least = [], 0
        if order:
            first = [_int(data, k * extra, extra, True) for k in range(order)]
            least = _int(data, order * extra, extra, True)
            at = (order + 1) * extra

        def block(count: int, width: int) -> np.ndarray:
            nonlocal at
            if not width:
                return np.zeros(count, np.int64)
            got = bit_groups(data[at:], np.full(count, width))
            at += -(-count * width // 8)
            return got

        refs = block(groups, bits)
        widths = width_ref + block(groups, width_bits)
        lengths = length_ref + block(groups, length_bits) * length_step
        lengths[-1] = last
        if lengths.sum() != n:
            raise ValueError("the groups don't add up to the number of values")
        each = np.repeat(widths, lengths)
        packed = bit_groups(data[at:], each)
        gone = np.zeros(n, bool)
        if missing:
            top = np.where(each > 0, (1 << each) - 1, -1)
            gone = packed == top
            ref_gone = np.repeat(refs == (1 << bits) - 1, lengths) & (each == 0)
            if missing == 2:
                gone |= (packed == top - 1) & (each > 0)
                ref_gone |= np.repeat(refs == (1 << bits) - 2, lengths) & (each == 0)
            gone = (gone & (each > 0)) | ref_gone
        total = packed + np.repeat(refs, lengths)
        there = total[~gone]
        if order:
            there = there + least
            there[:order] = first
            # Undoing one difference is a running sum; of second order it is one of running sums.
            if order == 1:
                there = np.cumsum(there)
            elif order == 2:
                there[1] = first[1] - first[0]
                there = first[0] + np.concatenate([[0], np.cumsum(np.cumsum(there[1:]))])
            else:
                raise ValueError(f"spatial differences of order {order} aren't read")
        out = np.full(n, np.nan)
        out[~gone] = self.scaled(there)
        return out


def messages(data: bytes) -> Iterator[Message]:
    """The messages of a file; sections 4 to 7 may repeat within one. A wrong length or trailer fails."""
    at = 0
    while at < len(data):
        if data[at : at + 4] != b"GRIB" or data[at + 7] != 2:
            raise ValueError("not a GRIB2 message")
        size = _int(data, at + 8, 8)
        if at + size > len(data) or data[at + size - 4 : at + size] != b"7777":
            raise ValueError("a GRIB2 message is cut")
        head: dict = {"discipline": data[at + 6]}
        sections: dict[int, bytes] = {}
        k = at + 16
        while k < at + size - 4:
            length, number = _int(data, k, 4), data[k + 4]
            if length < 5:
                raise ValueError("a GRIB2 section has no length")
            body = data[k : k + length]
            sections[number] = body
            if number == 1:
                y, mo, d, h, mi, sec = struct.unpack(">HBBBBB", body[12:19])
                head["ref_time"] = (y, mo, d, h, mi, sec)
            elif number == 3:
                if _int(body, 12, 2) != 0:
                    raise ValueError(f"grid template 3.{_int(body, 12, 2)} isn't read")
                unit = 1e-6
                head |= {"ni": _int(body, 30, 4), "nj": _int(body, 34, 4), "la1": _int(body, 46, 4, True) * unit, "lo1": _int(body, 50, 4, True) * unit}
                head |= {"di": _int(body, 63, 4) * unit, "dj": _int(body, 67, 4) * unit, "scan": body[71]}
            elif number == 4:
                scale, value = _int(body, 23, 1, True), _int(body, 24, 4, True)
                head |= {"pdtn": _int(body, 7, 2), "category": body[9], "number": body[10], "surface_type": body[22], "surface_value": value / 10.0**scale}
            elif number == 7:
                yield Message(dict(head), dict(sections))
            k += length
        at += size


def row(file: str, ordinal: int, m: Message) -> tuple:
    import datetime

    h = m.head
    values = [None if np.isnan(v) else float(v) for v in m.values()]
    return (file, ordinal, h["discipline"], datetime.datetime(*h["ref_time"]), h["pdtn"], h["category"], h["number"], h["surface_type"], h["surface_value"],
            h["ni"], h["nj"], h["la1"], h["lo1"], h["di"], h["dj"], h["scan"], _int(m.sections[5], 9, 2), values)


class Grib2Source(DataSource):
    """Files under a path that all workers see; for other stores read ``binaryFile`` and use :func:`fields`."""

    @classmethod
    def name(cls) -> str:
        return "grib2"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return Grib2Reader(self.options["path"])


class Grib2Reader(DataSourceReader):
    def __init__(self, path: str) -> None:
        self.path = path

    def partitions(self) -> list[InputPartition]:
        files = sorted(glob.glob(os.path.join(self.path, "*"))) if os.path.isdir(self.path) else sorted(glob.glob(self.path))
        return [InputPartition(f) for f in files]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        with open(partition.value, "rb") as f:
            data = f.read()
        for k, m in enumerate(messages(data)):
            yield row(partition.value, k, m)


def fields(files):  # noqa: ANN001, ANN201
    """Rows of SCHEMA from a DataFrame of ``binaryFile`` (path, content), for any store that Spark reads."""
    import pyarrow as pa

    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = [row(path, k, m) for k, m in enumerate(messages(content))]
                if rows:
                    kinds = {"values": pa.list_(pa.float32()), "ref_time": pa.timestamp("us"), "file": pa.string()}
                    doubles = {"surface_value", "la1", "lo1", "di", "dj"}
                    columns = [pa.array([r[k] for r in rows], kinds.get(n, pa.float64() if n in doubles else pa.int32())) for k, n in enumerate(names)]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    return files.select("path", "content").mapInArrow(run, SCHEMA)


def encode(values: np.ndarray, *, template: int = 0, bits: int = 12, decimal: int = 1, category: int = 2, number: int = 2, level: float = 25000.0, order: int = 2, group: int = 8) -> bytes:
    """One message of a field (rows, columns) for tests and fixtures: template 0, 2, 3, 41 or 42; NaN goes to a bitmap."""
    flat = values.reshape(-1).astype(float)
    there = ~np.isnan(flat)
    integer = np.round(flat[there] * 10.0**decimal).astype(np.int64)
    least = int(integer.min()) if len(integer) else 0
    packed = integer - least

    def section(number: int, body: bytes) -> bytes:
        return struct.pack(">IB", len(body) + 5, number) + body

    def put(numbers: np.ndarray, widths: np.ndarray) -> bytes:
        stream = np.concatenate([[(int(v) >> (w - 1 - k)) & 1 for k in range(int(w))] for v, w in zip(numbers, widths, strict=True)] or [[]]).astype(np.uint8)
        return np.packbits(stream).tobytes()

    def sm(v: int, size: int) -> bytes:
        return (abs(v) | (1 << (8 * size - 1)) if v < 0 else v).to_bytes(size, "big")

    tail = b""
    reference = least
    if template == 0:
        data = put(packed, np.full(len(packed), bits))
    elif template == 41:
        data = png.encode_grey(packed.reshape(-1, values.shape[1]) if there.all() else packed.reshape(1, -1), 16, 1)
        bits = 16
    elif template == 42:
        data = aec.encode(packed, bits, 16, 8, aec.DIFFERENCES)
        tail = struct.pack(">BBBH", 0, aec.DIFFERENCES, 16, 8)
    else:
        numbers, reference = packed, least
        lead = b""
        if template == 3:
            # Differences are taken of the numbers themselves, the first ones are stored apart.
            numbers, reference = integer, 0
            diff = np.diff(numbers, n=order)
            low = int(diff.min())
            lead = b"".join(sm(int(x), 4) for x in numbers[:order]) + sm(low, 4)
            numbers = np.concatenate([np.zeros(order, np.int64), diff - low])
        parts = [numbers[k : k + group] for k in range(0, len(numbers), group)]
        refs = np.array([p.min() for p in parts])
        widths = np.array([int(p.max() - p.min()).bit_length() for p in parts])
        bits = max(1, int(refs.max()).bit_length())
        data = lead + put(refs, np.full(len(refs), bits)) + put(widths, np.full(len(parts), 6)) + put(np.zeros(len(parts), np.int64), np.full(len(parts), 1))
        data += put(np.concatenate([p - r for p, r in zip(parts, refs, strict=True)]), np.repeat(widths, [len(p) for p in parts]))
        tail = struct.pack(">BBffIBBIBIB", 1, 0, 0.0, 0.0, len(parts), 0, 6, group, 1, len(parts[-1]), 1) + (struct.pack(">BB", order, 4) if template == 3 else b"")
    nj, ni = values.shape
    s1 = section(1, struct.pack(">HHBBBHBBBBBBB", 7, 0, 2, 1, 1, 2026, 1, 2, 3, 0, 0, 0, 1))
    s3 = section(3, struct.pack(">BIBBH", 0, ni * nj, 0, 0, 0) + b"\x06" + b"\x00" * 15 + struct.pack(">IIII", ni, nj, 0, 0xFFFFFFFF) + sm(25_000_000, 4) + sm(-80_000_000, 4) + b"\x30" + sm(30_000_000, 4) + sm(-70_000_000, 4) + struct.pack(">IIB", 500_000, 500_000, 64))
    s4 = section(4, struct.pack(">HHBBBBBHBBI", 0, 0, category, number, 2, 0, 96, 0, 0, 1, 0) + b"\x64" + b"\x00" + sm(int(level), 4) + b"\xff" * 6)
    s5 = section(5, struct.pack(">IHf", int(there.sum()), template, float(reference)) + sm(0, 2) + sm(decimal, 2) + bytes([bits]) + (tail if template == 42 else b"\x00" + tail))
    s6 = section(6, b"\xff") if there.all() else section(6, b"\x00" + np.packbits(there).tobytes())
    body = s1 + s3 + s4 + s5 + s6 + section(7, data) + b"7777"
    return b"GRIB" + b"\x00\x00\x00\x02" + struct.pack(">Q", len(body) + 16) + body
