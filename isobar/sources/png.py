"""PNG images as arrays of samples, by zlib and NumPy: non-interlaced, 1 to 16 bits, colour types 0, 2, 3, 4 and 6."""

from __future__ import annotations

import struct
import zlib

import numpy as np

SIGNATURE = b"\x89PNG\r\n\x1a\n"
_CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}


def chunks(data: bytes) -> list[tuple[bytes, bytes]]:
    """(type, body) in order; a wrong checksum or a cut file fails."""
    if data[:8] != SIGNATURE:
        raise ValueError("not a PNG file")
    at, out = 8, []
    while at < len(data):
        if at + 12 > len(data):
            raise ValueError("the PNG file is cut")
        size, kind = struct.unpack(">I4s", data[at : at + 8])
        body = data[at + 8 : at + 8 + size]
        crc = data[at + 8 + size : at + 12 + size]
        if len(crc) < 4 or zlib.crc32(kind + body) != struct.unpack(">I", crc)[0]:
            raise ValueError(f"PNG chunk {kind!r} is damaged")
        out.append((kind, body))
        at += 12 + size
        if kind == b"IEND":
            break
    return out


def unfiltered(raw: bytes, rows: int, row_bytes: int, pixel_bytes: int) -> np.ndarray:
    """Rows of bytes after undoing each row's filter. Left-dependent filters run along the row, one pixel column at a time."""
    if len(raw) != rows * (row_bytes + 1):
        raise ValueError("the PNG data have another length than the header says")
    lines = np.frombuffer(raw, np.uint8).reshape(rows, row_bytes + 1)
    out = np.zeros((rows, row_bytes), np.uint8)
    above = np.zeros(row_bytes, np.uint8)
    for j in range(rows):
        kind, line = int(lines[j, 0]), lines[j, 1:]
        if kind == 0:
            row = line.copy()
        elif kind == 1:
            padded = np.zeros(-(-row_bytes // pixel_bytes) * pixel_bytes, np.uint8)
            padded[:row_bytes] = line
            row = np.cumsum(padded.reshape(-1, pixel_bytes), 0, dtype=np.uint8).reshape(-1)[:row_bytes]
        elif kind == 2:
            row = line + above
        elif kind in (3, 4):
            row = np.zeros(row_bytes, np.uint8)
            left, corner = [0] * pixel_bytes, [0] * pixel_bytes
            source, up = line.tolist(), above.tolist()
            for i in range(row_bytes):
                k = i % pixel_bytes
                if kind == 3:
                    guess = (left[k] + up[i]) // 2
                else:
                    p = left[k] + up[i] - corner[k]
                    da, db, dc = abs(p - left[k]), abs(p - up[i]), abs(p - corner[k])
                    guess = left[k] if da <= db and da <= dc else up[i] if db <= dc else corner[k]
                corner[k] = up[i]
                left[k] = (source[i] + guess) & 255
                row[i] = left[k]
        else:
            raise ValueError(f"PNG filter {kind} doesn't exist")
        out[j] = above = row
    return out


def samples(data: bytes) -> tuple[np.ndarray, dict]:
    """(rows, columns, channels) of integer samples, and the header with palette and transparency."""
    parts = chunks(data)
    if not parts or parts[0][0] != b"IHDR":
        raise ValueError("the PNG file has no header")
    width, height, depth, colour, _, _, interlace = struct.unpack(">IIBBBBB", parts[0][1])
    if interlace or colour not in _CHANNELS:
        raise ValueError("interlaced PNG files and unknown colour types aren't read")
    channels = _CHANNELS[colour]
    row_bytes = -(-width * channels * depth // 8)
    raw = zlib.decompress(b"".join(b for k, b in parts if k == b"IDAT"))
    rows = unfiltered(raw, height, row_bytes, max(1, channels * depth // 8))
    if depth == 16:
        values = rows.reshape(height, -1).view(">u2").astype(np.int64)
    elif depth == 8:
        values = rows.astype(np.int64)
    else:
        bits = np.unpackbits(rows, axis=1)[:, : width * channels * depth].reshape(height, width * channels, depth)
        values = bits @ (1 << np.arange(depth)[::-1]).astype(np.int64)
    header = {"width": width, "height": height, "depth": depth, "colour": colour}
    header["palette"] = next((np.frombuffer(b, np.uint8).reshape(-1, 3) for k, b in parts if k == b"PLTE"), None)
    header["transparency"] = next((b for k, b in parts if k == b"tRNS"), None)
    return values.reshape(height, width, channels), header


def rgba(data: bytes) -> np.ndarray:
    """(rows, columns, 4) of bytes, whatever the colour type."""
    v, h = samples(data)
    top = (1 << h["depth"]) - 1
    out = np.full((*v.shape[:2], 4), 255, np.int64)
    see = h["transparency"]
    if h["colour"] == 3:
        if h["palette"] is None:
            raise ValueError("the PNG file has no palette")
        out[..., :3] = h["palette"][v[..., 0]]
        if see:
            alpha = np.full(256, 255, np.int64)
            alpha[: len(see)] = np.frombuffer(see, np.uint8)
            out[..., 3] = alpha[v[..., 0]]
        return out.astype(np.uint8)
    scaled = v * 255 // top
    colours = 1 if h["colour"] in (0, 4) else 3
    out[..., :3] = scaled[..., :1] if colours == 1 else scaled[..., :3]
    if h["colour"] in (4, 6):
        out[..., 3] = scaled[..., -1]
    elif see:
        out[..., 3] = np.where((v == np.frombuffer(see, ">u2")[:colours]).all(-1), 0, 255)
    return out.astype(np.uint8)


def encode_grey(values: np.ndarray, depth: int = 8, kind: int = 0) -> bytes:
    """A grey PNG file of 8 or 16 bits with one filter (0 none, 1 left, 2 above) in every row, for tests and fixtures."""
    rows = values.astype(">u2" if depth == 16 else np.uint8).view(np.uint8).reshape(values.shape[0], -1)
    step = depth // 8
    moved = np.zeros_like(rows)
    if kind == 1:
        moved[:, step:] = rows[:, :-step]
    elif kind == 2:
        moved[1:] = rows[:-1]
    lines = np.concatenate([np.full((len(rows), 1), kind, np.uint8), rows - moved], 1)
    part = lambda k, b: struct.pack(">I", len(b)) + k + b + struct.pack(">I", zlib.crc32(k + b))
    head = struct.pack(">IIBBBBB", values.shape[1], values.shape[0], depth, 0, 0, 0, 0)
    return SIGNATURE + part(b"IHDR", head) + part(b"IDAT", zlib.compress(lines.tobytes())) + part(b"IEND", b"")
