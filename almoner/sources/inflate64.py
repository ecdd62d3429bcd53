"""Deflate64 (ZIP method 9): Deflate with a window of 64 KB, two more distance codes, and matches of up to 64 KB."""

from __future__ import annotations


def _steps(first: int, free: int, each: int, n: int) -> list[tuple[int, int]]:
    """(least value, extra bits) of n codes: `free` of them without extra bits, then `each` codes for every number of bits."""
    out, at = [], first
    for k in range(n):
        bits = 0 if k < free else (k - free) // each + 1
        out.append((at, bits))
        at += 1 << bits
    return out


#: Lengths of the codes 257 to 284 (285 is 3 with 16 bits), distances of the codes 0 to 31.
LENGTHS = [*_steps(3, 8, 4, 28), (3, 16)]
DISTANCES = _steps(1, 4, 2, 32)
#: In which order the lengths of the code lengths' codes are given; the code lengths of fixed blocks.
ORDER = (16, 17, 18, 0, 8, 7, 9, 6, 10, 5, 11, 4, 12, 3, 13, 2, 14, 1, 15)
FIXED = [8] * 144 + [9] * 112 + [7] * 24 + [8] * 8, [5] * 32


class _Bits:
    """Bits from the lowest of each byte on."""

    def __init__(self, data: bytes):
        self.data, self.at, self.hold, self.n = data, 0, 0, 0

    def need(self, n: int) -> None:
        while self.n < n:
            # beyond the end come a few zeros: a code may be looked up by more bits than it has
            if self.at > len(self.data) + 8:
                raise ValueError("the Deflate64 stream ends early")
            self.hold |= int.from_bytes(self.data[self.at : self.at + 8], "little") << self.n
            self.at += 8
            self.n += 64

    def take(self, n: int) -> int:
        self.need(n)
        out = self.hold & ((1 << n) - 1)
        self.hold >>= n
        self.n -= n
        return out

    def symbol(self, table: tuple[int, list]) -> int:
        bits, entries = table
        self.need(bits)
        entry = entries[self.hold & ((1 << bits) - 1)]
        if entry is None:
            raise ValueError("a code that the Deflate64 stream doesn't define")
        size, value = entry
        self.hold >>= size
        self.n -= size
        return value


def _table(lengths: list[int]) -> tuple[int, list]:
    """Canonical codes of these lengths, looked up by the next bits (a code's first bit is the lowest)."""
    most = max(lengths, default=0) or 1
    entries: list = [None] * (1 << most)
    code = 0
    for size in range(1, most + 1):
        for value, n in enumerate(lengths):
            if n == size:
                low = int(format(code, f"0{size}b")[::-1], 2)
                for k in range(low, 1 << most, 1 << size):
                    entries[k] = size, value
                code += 1
        code <<= 1
    return most, entries


def _dynamic(bits: _Bits) -> tuple[tuple, tuple]:
    n_literals, n_distances, n_lengths = bits.take(5) + 257, bits.take(5) + 1, bits.take(4) + 4
    own = [0] * 19
    for k in range(n_lengths):
        own[ORDER[k]] = bits.take(3)
    table, lengths = _table(own), []
    while len(lengths) < n_literals + n_distances:
        value = bits.symbol(table)
        if value < 16:
            lengths.append(value)
        elif value == 16:
            if not lengths:
                raise ValueError("nothing to repeat in the Deflate64 stream")
            lengths += [lengths[-1]] * (bits.take(2) + 3)
        else:
            lengths += [0] * (bits.take(3) + 3 if value == 17 else bits.take(7) + 11)
    return _table(lengths[:n_literals]), _table(lengths[n_literals : n_literals + n_distances])


def inflate64(data: bytes, most: int) -> bytes:
    """The stream's content; ValueError where it is broken or holds more than `most` bytes."""
    bits, out, last = _Bits(data), bytearray(), False
    while not last:
        last, kind = bool(bits.take(1)), bits.take(2)
        if kind == 0:
            bits.take(bits.n % 8)
            size, check = bits.take(16), bits.take(16)
            if size ^ check != 0xFFFF:
                raise ValueError("a stored block's size is wrong")
            out += bytes(bits.take(8) for _ in range(size))
            continue
        if kind == 3:
            raise ValueError("a block of an unknown kind")
        literals, distances = _dynamic(bits) if kind == 2 else map(_table, FIXED)
        while (value := bits.symbol(literals)) != 256:
            if value < 256:
                out.append(value)
            else:
                if value > 285:
                    raise ValueError("a length that Deflate64 doesn't have")
                base, extra = LENGTHS[value - 257]
                size = base + bits.take(extra)
                base, extra = DISTANCES[bits.symbol(distances)]
                back = base + bits.take(extra)
                if back > len(out):
                    raise ValueError("a match from before the beginning")
                piece = out[-back:]
                out += (piece * (size // back + 1))[:size] if back < size else piece[:size]
            if len(out) > most:
                raise ValueError("more content than stated")
    if 8 * bits.at - bits.n > 8 * len(data):
        raise ValueError("the Deflate64 stream ends early")
    return bytes(out)
