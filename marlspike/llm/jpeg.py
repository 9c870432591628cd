"""Luminance of JPEG frames of the sequential DCT process, as motion JPEG holds them (operator 10).

A frame is read in one walk over its Huffman codes, which are looked up 16 bits at a time; the
coefficients of all blocks are then transformed together.  Only the first component is kept:
shots are detected on it.

Cases: frames without tables of their own use the standard's, as motion JPEG allows; restart
intervals, any sampling factors and one or several scans are read; progressive, arithmetic and
12-bit frames, and frames that break off, raise ``ValueError``.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

# The order of coefficients and the typical Huffman tables that the JPEG standard states (counts of codes by length, then symbols).
ZIGZAG = (
    0, 1, 8, 16, 9, 2, 3, 10, 17, 24, 32, 25, 18, 11, 4, 5, 12, 19, 26, 33, 40, 48, 41, 34, 27, 20, 13, 6, 7, 14, 21, 28,
    35, 42, 49, 56, 57, 50, 43, 36, 29, 22, 15, 23, 30, 37, 44, 51, 58, 59, 52, 45, 38, 31, 39, 46, 53, 60, 61, 54, 47, 55, 62, 63,
)
STANDARD = {
    (0, 0): ("00010501010101010100000000000000", "000102030405060708090a0b"),
    (0, 1): ("00030101010101010101010000000000", "000102030405060708090a0b"),
    (1, 0): (
        "0002010303020403050504040000017d",
        "01020300041105122131410613516107227114328191a1082342b1c11552d1f02433627282090a161718191a25262728292a3435363738393a434445464748494a"
        "535455565758595a636465666768696a737475767778797a838485868788898a92939495969798999aa2a3a4a5a6a7a8a9aab2b3b4b5b6b7b8b9bac2c3c4c5c6c7"
        "c8c9cad2d3d4d5d6d7d8d9dae1e2e3e4e5e6e7e8e9eaf1f2f3f4f5f6f7f8f9fa",
    ),
    (1, 1): (
        "00020102040403040705040400010277",
        "000102031104052131061241510761711322328108144291a1b1c109233352f0156272d10a162434e125f11718191a262728292a35363738393a43444546474849"
        "4a535455565758595a636465666768696a737475767778797a82838485868788898a92939495969798999aa2a3a4a5a6a7a8a9aab2b3b4b5b6b7b8b9bac2c3c4c5"
        "c6c7c8c9cad2d3d4d5d6d7d8d9dae2e3e4e5e6e7e8e9eaf2f3f4f5f6f7f8f9fa",
    ),
}
_NATURAL = np.array(ZIGZAG)
_x = np.arange(8)
_COSINES = np.cos((2 * _x[:, None] + 1) * _x[None, :] * np.pi / 16) * np.where(_x == 0, np.sqrt(1 / 8), 0.5)


@lru_cache(maxsize=64)
def _lookup(counts: bytes, symbols: bytes) -> tuple[list[int], list[int]]:
    """Code length (0: no code) and symbol for each 16 bits that may come next."""
    lengths, values = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
    code, k = 0, 0
    for n in range(1, 17):
        for _ in range(counts[n - 1]):
            if k >= len(symbols) or code >> n:
                raise ValueError("a Huffman table that is none")
            lengths[code << (16 - n) : (code + 1) << (16 - n)] = n
            values[code << (16 - n) : (code + 1) << (16 - n)] = symbols[k]
            code, k = code + 1, k + 1
        code <<= 1
    return lengths.tolist(), values.tolist()


def _standard() -> dict[tuple[int, int], tuple[list[int], list[int]]]:
    return {key: _lookup(bytes.fromhex(c), bytes.fromhex(v)) for key, (c, v) in STANDARD.items()}


class _Bits:
    """The bits of one restart interval, without stuffing; beyond its end there are ones, and no more than a block of them may be read."""

    def __init__(self, data: bytes) -> None:
        self.data, self.at, self.held, self.n = data + b"\xff" * 16, 0, 0, 0

    def _fill(self) -> None:
        part = self.data[self.at : self.at + 6]
        if len(part) < 2:
            raise ValueError("a scan that breaks off")
        self.held = (self.held & ((1 << self.n) - 1)) << (8 * len(part)) | int.from_bytes(part, "big")
        self.n += 8 * len(part)
        self.at += len(part)

    def block(self, out: np.ndarray, row: int, dc: tuple[list[int], list[int]], ac: tuple[list[int], list[int]], before: int) -> int:
        """Reads the coefficients of a block into ``out[row]`` (in the order of the scan); returns its DC value."""
        k, table = 0, dc
        value = before
        while k < 64:
            if self.n < 32:
                self._fill()
            ahead = (self.held >> (self.n - 16)) & 0xFFFF
            used, symbol = table[0][ahead], table[1][ahead]
            if not used:
                raise ValueError("a code that the Huffman table lacks")
            size = symbol & 15
            if k:
                run = symbol >> 4
                if size == 0:
                    self.n -= used
                    if run < 15:
                        break
                    k += 16
                    continue
                k += run
                if k > 63:
                    raise ValueError("more coefficients than a block has")
            extra = (self.held >> (self.n - used - size)) & ((1 << size) - 1)
            self.n -= used + size
            if size and extra < 1 << (size - 1):
                extra -= (1 << size) - 1
            if k:
                out[row, k] = extra
            else:
                value = before + extra
                out[row, 0] = value
                table = ac
            k += 1
        return value


def _tables(body: bytes, quants: dict[int, np.ndarray]) -> None:
    at = 0
    while at < len(body):
        wide, name = body[at] >> 4, body[at] & 15
        n = 128 if wide else 64
        quants[name] = np.frombuffer(body, ">u2" if wide else np.uint8, 64, at + 1).astype(np.float64)
        at += 1 + n


def _codes(body: bytes, codes: dict[tuple[int, int], tuple[list[int], list[int]]]) -> None:
    at = 0
    while at < len(body):
        counts = body[at + 1 : at + 17]
        n = sum(counts)
        codes[body[at] >> 4, body[at] & 15] = _lookup(counts, body[at + 17 : at + 17 + n])
        at += 17 + n


def _intervals(frame: bytes, at: int) -> list[bytes]:
    """The scan from ``at`` on, cut at its restart markers, without stuffed zeros."""
    out, start = [], at
    while True:
        at = frame.find(b"\xff", at)
        if at < 0 or at + 1 >= len(frame):
            raise ValueError("a scan that breaks off")
        mark = frame[at + 1]
        if mark == 0:
            at += 2
        elif mark == 0xFF:
            at += 1
        else:
            out.append(frame[start:at].rstrip(b"\xff").replace(b"\xff\x00", b"\xff"))
            if not 0xD0 <= mark <= 0xD7:
                return out
            start = at = at + 2


def luminance(frame: bytes) -> np.ndarray:
    """Samples (height x width) of a frame's first component."""
    quants: dict[int, np.ndarray] = {}
    codes = _standard()
    parts, restart, at = None, 0, 2
    while at + 4 <= len(frame):
        if frame[at] != 0xFF:
            raise ValueError("not a JPEG frame")
        mark = frame[at + 1]
        if mark == 0xFF:
            at += 1
            continue
        n = int.from_bytes(frame[at + 2 : at + 4], "big")
        body = frame[at + 4 : at + 2 + n]
        if len(body) != n - 2:
            break
        if mark == 0xDB:
            _tables(body, quants)
        elif mark == 0xC4:
            _codes(body, codes)
        elif mark == 0xDD:
            restart = int.from_bytes(body[:2], "big")
        elif mark in (0xC0, 0xC1):
            if body[0] != 8:
                raise ValueError("only 8-bit samples are decoded")
            height, width = int.from_bytes(body[1:3], "big"), int.from_bytes(body[3:5], "big")
            parts = [(body[6 + 3 * k], body[7 + 3 * k] >> 4, body[7 + 3 * k] & 15, body[8 + 3 * k]) for k in range(body[5])]
            if not parts or not height or not width or min(min(p[1:3]) for p in parts) == 0:
                raise ValueError("a frame without samples")
        elif 0xC2 <= mark <= 0xCF and mark != 0xC8 and mark != 0xCC:
            raise ValueError("only the sequential DCT process is decoded")
        elif mark == 0xDA:
            if parts is None:
                raise ValueError("a scan before its frame")
            scan = [(body[1 + 2 * k], body[2 + 2 * k] >> 4, body[2 + 2 * k] & 15) for k in range(body[0])]
            if any(name == parts[0][0] for name, _, _ in scan):
                return _first_component(frame, at + 2 + n, parts, scan, (height, width), restart, quants, codes)
        at += 2 + n
    raise ValueError("a JPEG frame that breaks off")


def _first_component(frame: bytes, at: int, parts: list, scan: list, size: tuple[int, int], restart: int, quants: dict, codes: dict) -> np.ndarray:
    height, width = size
    by_name = {p[0]: p for p in parts}
    most_h, most_v = max(p[1] for p in parts), max(p[2] for p in parts)
    first = parts[0]
    wide, high = -(-width * first[1] // most_h), -(-height * first[2] // most_v)  # samples of the first component
    alone = len(scan) == 1  # then its blocks follow each other, whatever the sampling
    across, down = (-(-wide // 8), -(-high // 8)) if alone else (-(-width // (8 * most_h)), -(-height // (8 * most_v)))
    ch, cv = (1, 1) if alone else first[1:3]
    if across * ch * down * cv > 4 * len(frame):  # a block takes two bits at least
        raise ValueError("a frame with fewer bits than blocks")
    coefs = np.zeros((across * ch * down * cv, 64))
    spare = np.zeros((1, 64))
    plan = []
    for name, dc, ac in scan:
        if name not in by_name or (0, dc) not in codes or (1, ac) not in codes:
            raise ValueError("a scan of unknown parts")
        _, h, v, _ = by_name[name]
        blocks = [(y, x) for y in range(1 if alone else v) for x in range(1 if alone else h)]
        plan.append((name == first[0], blocks, codes[0, dc], codes[1, ac]))
    units, done = across * down, 0
    for data in _intervals(frame, at):
        bits, last = _Bits(data), [0] * len(plan)
        for unit in range(done, min(units, done + (restart or units))):
            row, column = divmod(unit, across)
            for k, (own, blocks, dc, ac) in enumerate(plan):
                for y, x in blocks:
                    if own:
                        last[k] = bits.block(coefs, (row * cv + y) * across * ch + column * ch + x, dc, ac, last[k])
                    else:
                        last[k] = bits.block(spare, 0, dc, ac, last[k])
            done = unit + 1
        if bits.at - bits.n // 8 > len(data) + 1:
            raise ValueError("a scan that breaks off")
    if done < units:
        raise ValueError("a scan that breaks off")
    if first[3] not in quants:
        raise ValueError("a frame without its quantisation table")
    square = np.zeros_like(coefs)
    square[:, _NATURAL] = coefs * quants[first[3]]
    square = _COSINES @ square.reshape(-1, 8, 8) @ _COSINES.T
    image = square.reshape(down * cv, across * ch, 8, 8).transpose(0, 2, 1, 3).reshape(down * cv * 8, across * ch * 8)
    return np.clip(np.rint(image + 128), 0, 255).astype(np.uint8)[:high, :wide]
