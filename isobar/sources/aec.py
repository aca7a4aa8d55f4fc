"""Adaptive entropy coding of the CCSDS 121.0 standard, as GRIB2 packs fields with it.

Samples come in blocks; each block names its code: unary parts with k plain low bits, pairs of small numbers as one unary
code, runs of blocks of zeros, or plain numbers. With a predictor, samples are differences to the one before, folded to
unsigned numbers, and each interval of blocks begins with a sample in full.
"""

from __future__ import annotations

import numpy as np

#: Flags of the format: samples are signed, differences are coded, few option codes, intervals end at a byte.
SIGNED, DIFFERENCES, RESTRICTED, PADDED = 1, 8, 16, 32
#: Blocks of zeros end at such a number of blocks at the latest.
SEGMENT = 64


def id_bits(bits: int, flags: int) -> int:
    if flags & RESTRICTED and bits <= 4:
        return 1 if bits <= 2 else 2
    return 3 if bits <= 8 else 4 if bits <= 16 else 5


class _Bits:
    def __init__(self, data: bytes) -> None:
        self.bits = np.unpackbits(np.frombuffer(data, np.uint8))
        self.ones = np.flatnonzero(self.bits)
        self.at = 0

    def plain(self, count: int, width: int) -> np.ndarray:
        end = self.at + count * width
        if end > len(self.bits):
            raise ValueError("the entropy-coded data are cut")
        got = self.bits[self.at : end].reshape(count, width).astype(np.int64) @ (1 << np.arange(width, dtype=np.int64)[::-1]) if width else np.zeros(count, np.int64)
        self.at = end
        return got

    def unary(self, count: int) -> np.ndarray:
        """Numbers of zeros before each of the next ones."""
        k = int(np.searchsorted(self.ones, self.at))
        ends = self.ones[k : k + count]
        if len(ends) < count:
            raise ValueError("the entropy-coded data are cut")
        got = np.diff(np.concatenate([[self.at - 1], ends])) - 1
        if count:
            self.at = int(ends[-1]) + 1
        return got


def decode(data: bytes, count: int, bits: int, block: int, interval: int, flags: int) -> np.ndarray:
    """``count`` samples; the data must hold them all and nothing more than the last byte's rest."""
    source, width = _Bits(data), id_bits(bits, flags)
    coded = bool(flags & DIFFERENCES)
    out = []
    made = 0
    while made < count:
        parts: list[np.ndarray] = []
        first = None
        k = 0
        while k < interval and made + k * block < count:
            lead = int(coded and k == 0)
            option = int(source.plain(1, width)[0])
            if lead:
                # The sample in full stands between the option and the block's other samples.
                extended = int(source.plain(1, 1)[0]) if option == 0 else 0
                first = int(source.plain(1, bits)[0])
            elif option == 0:
                extended = int(source.plain(1, 1)[0])
            size = block - lead
            if option == (1 << width) - 1:
                parts.append(source.plain(size, bits))
            elif option:
                high = source.unary(size)
                parts.append((high << (option - 1)) + source.plain(size, option - 1))
            elif extended:
                m = source.unary(block // 2)
                total = ((np.sqrt(8 * m + 1) - 1) / 2).astype(np.int64)
                second = m - total * (total + 1) // 2
                parts.append(np.stack([total - second, second], 1).reshape(-1)[lead:])
            else:
                run = int(source.unary(1)[0]) + 1
                if run == 5:
                    run = min(SEGMENT - k % SEGMENT, interval - k)
                elif run > 5:
                    run -= 1
                parts.append(np.zeros(run * block - lead, np.int64))
                k += run - 1
            k += 1
        values = np.concatenate(parts)
        if coded:
            values = _summed(first, values, bits, flags)
        elif flags & SIGNED:
            values = np.where(values >= 1 << (bits - 1), values - (1 << bits), values)
        out.append(values[: count - made])
        made += len(out[-1])
        if flags & PADDED:
            source.at = -(-source.at // 8) * 8
    if len(data) * 8 - source.at >= 8:
        raise ValueError("entropy-coded data are left over")
    return np.concatenate(out)


def _summed(first: int, folded: np.ndarray, bits: int, flags: int) -> np.ndarray:
    low, high = (-(1 << (bits - 1)), (1 << (bits - 1)) - 1) if flags & SIGNED else (0, (1 << bits) - 1)
    if flags & SIGNED and first > high:
        first -= 1 << bits
    out, x = [first], first
    for d in folded.tolist():
        room = min(x - low, high - x)
        if d <= 2 * room:
            x += -(d + 1) // 2 if d & 1 else d // 2
        elif room == x - low:
            x += d - room
        else:
            x -= d - room
        out.append(x)
    return np.array(out, np.int64)


def encode(values: np.ndarray, bits: int, block: int, interval: int, flags: int) -> bytes:
    """The shortest code for each block, for tests and fixtures; runs of zeros are not joined over blocks."""
    width, coded = id_bits(bits, flags), bool(flags & DIFFERENCES)
    v = np.concatenate([values, np.full(-len(values) % block, values[-1])]).astype(np.int64)
    low, high = (-(1 << (bits - 1)), (1 << (bits - 1)) - 1) if flags & SIGNED else (0, (1 << bits) - 1)
    out: list[str] = []
    plain = lambda x, n: format(int(x) & ((1 << n) - 1), f"0{n}b") if n else ""
    for start in range(0, len(v), block * interval):
        part = v[start : start + block * interval]
        numbers = part & ((1 << bits) - 1)
        if coded:
            folded = [0]
            for a, b in zip(part[:-1].tolist(), part[1:].tolist(), strict=True):
                room, d = min(a - low, high - a), b - a
                folded.append(2 * d if 0 <= d <= room else -2 * d - 1 if -room <= d < 0 else room + abs(d))
            numbers = np.array(folded)
        for k in range(0, len(part), block):
            lead = int(coded and k == 0)
            own = numbers[k + lead : k + block].tolist()
            full = plain(part[k], bits) if lead else ""
            choices = [plain((1 << width) - 1, width) + full + "".join(plain(x, bits) for x in own)]
            for low_bits in range(min((1 << width) - 2, bits)):
                choices.append(plain(low_bits + 1, width) + full + "".join("0" * (x >> low_bits) + "1" for x in own) + "".join(plain(x, low_bits) for x in own))
            pairs = ([0] * lead + own)
            m = [(a + b) * (a + b + 1) // 2 + b for a, b in zip(pairs[::2], pairs[1::2], strict=True)]
            if max(m) < 200:
                choices.append(plain(0, width) + "1" + full + "".join("0" * x + "1" for x in m))
            if not any(own):
                choices.append(plain(0, width) + "0" + full + "1")
            out.append(min(choices, key=len))
        if flags & PADDED:
            out.append("0" * (-sum(map(len, out)) % 8))
    text = "".join(out)
    text += "0" * (-len(text) % 8)
    return int(text, 2).to_bytes(len(text) // 8, "big")
