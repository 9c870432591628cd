"""Motion-JPEG clips in AVI containers (operator 10).

An AVI file is a RIFF tree: ``hdrl`` describes the streams, ``movi`` holds one chunk a frame, and
an index says where each frame lies: ``idx1`` (counted from the file's begin or from ``movi``), or the
``indx`` and ``ix`` chunks of files with several RIFF segments.  Where there is none, or it does not
lead to frames, ``movi`` is walked.  The film is the first video stream; others are passed over.

Frames that are stored here are grey intra frames of the lossless JPEG process (SOF3, 8-bit
samples, left-neighbour prediction), so samples read back are the samples stored.  Decoding walks
all frames of a block in step: one vector operation handles the same sample of every frame.
Frames of the sequential DCT process (SOF0, SOF1), which other files hold, are decoded to their
luminance one by one (:mod:`marlspike.llm.jpeg`).

Shots are found by adaptive histogram differences: a cut lies where the difference between
neighbouring frames exceeds the mean of the preceding differences of the shot by a multiple
of their deviation (and a floor).

Cases: null and empty texts become 64 zero bytes; very long texts become many frames; equal
texts give equal files and features; an empty table gives an empty result; other columns are
not read.  A file that cannot be read (null, no AVI, another codec, a broken frame) has its reason in
``error`` and null features, and stops no other.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlspike.llm import jpeg
from marlspike.llm.common import chunked, utf8_buffer

WIDTH, HEIGHT, FPS = 32, 32, 25
FRAME = WIDTH * HEIGHT
BINS = 16
#: Frames that are encoded or decoded in step.
STEP = 1024
CUT_FLOOR, CUT_SPREAD, CUT_MEMORY = 0.35, 3.0, 8

#: Huffman code lengths of the difference categories 0 to 8; no code is all ones.
_LENGTHS = (3, 4, 4, 4, 3, 3, 3, 3, 3)


def _canonical(lengths: tuple[int, ...]) -> tuple[list[int], list[int]]:
    """Symbols by code length, and their canonical codes."""
    symbols = sorted(range(len(lengths)), key=lambda s: (lengths[s], s))
    codes, code, last = {}, 0, lengths[symbols[0]]
    for s in symbols:
        code <<= lengths[s] - last
        last = lengths[s]
        codes[s] = code
        code += 1
    return symbols, [codes[s] for s in range(len(lengths))]


_SYMBOLS, _CODES = _canonical(_LENGTHS)
_DIFF = np.arange(-255, 256)
_CAT = np.array([int(abs(d)).bit_length() for d in _DIFF])
_EXTRA = np.where(_DIFF < 0, _DIFF + (1 << _CAT) - 1, _DIFF)
#: For each difference + 255: the bits to write and how many.
_BITS = (np.array(_CODES)[_CAT] << _CAT | _EXTRA).astype(np.uint32)
_NBITS = (np.array(_LENGTHS)[_CAT] + _CAT).astype(np.int64)


def _jpeg_header() -> bytes:
    counts = bytes(sum(1 for x in _LENGTHS if x == n) for n in range(1, 17))
    dht = b"\x00" + counts + bytes(_SYMBOLS)
    sof = struct.pack(">BHHB", 8, HEIGHT, WIDTH, 1) + b"\x01\x11\x00"
    sos = b"\x01\x01\x00" + b"\x01\x00\x00"  # predictor 1: the left neighbour
    part = lambda mark, body: b"\xff" + mark + struct.pack(">H", len(body) + 2) + body
    return b"\xff\xd8" + part(b"\xc3", sof) + part(b"\xc4", dht) + part(b"\xda", sos)


JPEG_HEADER = _jpeg_header()


def encode_frames(samples: np.ndarray) -> list[bytes]:
    """JPEG files of frames given as rows of ``FRAME`` samples."""
    return [f for a in range(0, len(samples), STEP) for f in _encode_block(samples[a : a + STEP])]


def _encode_block(samples: np.ndarray) -> list[bytes]:
    n = len(samples)
    image = samples.reshape(n, HEIGHT, WIDTH).astype(np.int16)
    pred = np.empty_like(image)
    pred[:, :, 1:] = image[:, :, :-1]
    pred[:, 1:, 0] = image[:, :-1, 0]
    pred[:, 0, 0] = 128
    diff = (image - pred).reshape(n, FRAME) + 255
    size = _NBITS[diff]
    ends = np.cumsum(size, axis=1)
    nbytes = (ends[:, -1] + 7) // 8
    base = np.zeros(n + 1, np.int64)
    np.cumsum(nbytes, out=base[1:])
    at = (ends - size + base[:-1, None] * 8).ravel()
    size = size.ravel()
    word = _BITS[diff.ravel()].astype(np.int64) << (24 - size - (at & 7))
    total = int(base[-1])
    out = np.zeros(total + 2, np.float64)
    for k, shift in enumerate((16, 8, 0)):
        out += np.bincount((at >> 3) + k, weights=(word >> shift) & 255, minlength=total + 2)[: total + 2]
    scan = out[:total].astype(np.uint8)
    spare = (nbytes * 8 - ends[:, -1]).astype(np.int64)
    scan[base[1:] - 1] |= ((1 << spare) - 1).astype(np.uint8)  # padding bits are ones
    marks = np.flatnonzero(scan == 255)
    stuffed = np.insert(scan, marks + 1, 0).tobytes()
    cut = base + np.searchsorted(marks, base, "left")
    return [JPEG_HEADER + stuffed[a:b] + b"\xff\xd9" for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]


def _chunk(name: bytes, body: bytes) -> bytes:
    return name + struct.pack("<I", len(body)) + body + b"\0" * (len(body) & 1)


def build_avi(frames: list[bytes], length: int) -> bytes:
    """An AVI file of JPEG frames; ``length`` (samples that are payload) goes to the stream's ``strd`` chunk."""
    most = max(map(len, frames))
    avih = struct.pack("<14I", 1_000_000 // FPS, most * FPS, 0, 0x10, len(frames), 0, 1, most, WIDTH, HEIGHT, 0, 0, 0, 0)
    strh = b"vidsMJPG" + struct.pack("<IHHIIIIIIII4H", 0, 0, 0, 0, 1, FPS, 0, len(frames), most, 0xFFFFFFFF, 0, 0, 0, WIDTH, HEIGHT)
    strf = struct.pack("<IiiHH4sIiiII", 40, WIDTH, HEIGHT, 1, 8, b"MJPG", FRAME, 0, 0, 0, 0)
    strl = _chunk(b"LIST", b"strl" + _chunk(b"strh", strh) + _chunk(b"strf", strf) + _chunk(b"strd", struct.pack("<Q", length)))
    hdrl = _chunk(b"LIST", b"hdrl" + _chunk(b"avih", avih) + strl)
    parts, index, at = [b"movi"], [], 4
    for f in frames:
        c = _chunk(b"00dc", f)
        index.append(b"00dc" + struct.pack("<III", 0x10, at, len(f)))
        parts.append(c)
        at += len(c)
    body = b"AVI " + hdrl + _chunk(b"LIST", b"".join(parts)) + _chunk(b"idx1", b"".join(index))
    return _chunk(b"RIFF", body)


def riff(data: bytes, start: int, end: int) -> Iterator[tuple[bytes, int, int]]:
    """Chunks of a RIFF level: name (of a list its type), first and last byte of the content."""
    while start + 8 <= end:
        name, n = data[start : start + 4], struct.unpack_from("<I", data, start + 4)[0]
        if start + 8 + n > end:
            raise ValueError("a RIFF chunk runs past its parent")
        if name in (b"LIST", b"RIFF"):
            yield data[start + 8 : start + 12], start + 12, start + 8 + n
        else:
            yield name, start + 8, start + 8 + n
        start += 8 + n + (n & 1)


def _movi_frames(data: bytes, start: int, end: int, names: tuple[bytes, ...]) -> Iterator[tuple[int, int]]:
    for name, a, b in riff(data, start, end):
        if name == b"rec ":
            yield from _movi_frames(data, a, b, names)
        elif name in names:
            yield a, b - a


def _old_index(data: bytes, at: tuple[int, int], movi: int, names: tuple[bytes, ...]) -> list[tuple[int, int]]:
    """Frames that ``idx1`` lists, from the origin at which its entries find their chunks; none if neither does."""
    a, b = at
    index = np.frombuffer(data, np.dtype([("id", "S4"), ("flags", "<u4"), ("at", "<u4"), ("size", "<u4")]), (b - a) // 16, a)
    index = index[np.isin(index["id"], names)]
    heads = [i + struct.pack("<I", n) for i, n in zip(index["id"].tolist(), index["size"].tolist())]
    for origin in (movi - 4, 0):
        places = (origin + index["at"].astype(np.int64)).tolist()
        if all(data[p : p + 8] == head for p, head in zip(places, heads)):
            return [(p + 8, n) for p, n in zip(places, index["size"].tolist())]
    return []


def _new_index(data: bytes, at: tuple[int, int]) -> list[tuple[int, int]]:
    """Frames that the chunks of an ``indx`` super index list."""
    out = []
    for k in range(struct.unpack_from("<I", data, at[0] + 4)[0]):
        place, _, _ = struct.unpack_from("<QII", data, at[0] + 24 + 16 * k)
        width, _, kind, count, _, base = struct.unpack_from("<HBBI4sQ", data, place + 8)
        if width != 2 or kind != 1:
            raise ValueError("an index of an unknown kind")
        entries = np.frombuffer(data, "<u4", 2 * count, place + 32).reshape(-1, 2).astype(np.int64)
        out += list(zip((base + entries[:, 0]).tolist(), (entries[:, 1] & 0x7FFFFFFF).tolist()))
    return out


def parse_avi(data: bytes) -> dict:
    """Frame rate, payload length and each frame's place of the first video stream; anything else raises ``ValueError``."""
    segments = list(riff(data, 0, len(data)))
    if not segments or segments[0][0] != b"AVI " or data[:4] != b"RIFF":
        raise ValueError("not an AVI file")
    level = {name: (a, b) for name, a, b in reversed(list(riff(data, *segments[0][1:])))}
    if not {b"hdrl", b"movi"} <= level.keys():
        raise ValueError("an AVI file without header or frames")
    streams = [{n: (x, y) for n, x, y in riff(data, a, b)} for name, a, b in riff(data, *level[b"hdrl"]) if name == b"strl"]
    number = next((k for k, x in enumerate(streams) if b"strh" in x and data[x[b"strh"][0] : x[b"strh"][0] + 4] == b"vids"), None)
    if number is None:
        raise ValueError("an AVI file without a video stream")
    stream = streams[number]
    a, b = stream[b"strh"]
    scale, rate = struct.unpack_from("<II", data, a + 20) if b - a >= 28 else (0, 0)
    coded = data[stream[b"strf"][0] + 16 : stream[b"strf"][0] + 20] if b"strf" in stream else b"MJPG"
    if not scale or not rate or coded.upper() not in (b"MJPG", b"JPEG"):
        raise ValueError("no motion JPEG")
    names = (b"%02ddc" % number, b"%02ddb" % number)
    frames: list[tuple[int, int]] = []
    try:
        if b"indx" in stream:
            frames = _new_index(data, stream[b"indx"])
        elif b"idx1" in level:
            frames = _old_index(data, level[b"idx1"], level[b"movi"][0], names)
    except (ValueError, struct.error):
        frames = []
    if not frames or any(p + n > len(data) or (n and data[p : p + 2] != b"\xff\xd8") for p, n in frames):
        movis = [(x, y) for kind, c, d in segments if kind in (b"AVI ", b"AVIX") for name, x, y in riff(data, c, d) if name == b"movi"]
        frames = [f for x, y in movis for f in _movi_frames(data, x, y, names)]
    # An empty chunk repeats the frame before it.
    shown: list[tuple[int, int]] = []
    for f in frames:
        if f[1] or shown:
            shown.append(f if f[1] else shown[-1])
    if not shown:
        raise ValueError("an AVI file without frames")
    length = struct.unpack_from("<Q", data, stream[b"strd"][0])[0] if b"strd" in stream and stream[b"strd"][1] - stream[b"strd"][0] == 8 else None
    return {"fps": rate / scale, "length": length, "frames": shown}


def _scan_of(frame: memoryview) -> tuple[int, tuple[int, int], bytes, bytes] | None:
    """Where the scan starts, height and width, and the Huffman table of a lossless grey JPEG; None for one of a DCT process."""
    if bytes(frame[:2]) != b"\xff\xd8":
        raise ValueError("not a JPEG frame")
    at, shape, table = 2, None, None
    while at + 4 <= len(frame):
        mark, n = frame[at + 1], int.from_bytes(frame[at + 2 : at + 4], "big")
        body = frame[at + 4 : at + 2 + n]
        if frame[at] != 0xFF or len(body) != n - 2:
            break
        if mark in (0xC3, 0xDA) and len(body) < 6:
            break
        if mark == 0xC3:
            if body[0] != 8 or body[5] != 1:
                raise ValueError("lossless frames other than grey ones of 8-bit samples are not decoded")
            shape = (int.from_bytes(body[1:3], "big"), int.from_bytes(body[3:5], "big"))
        elif mark == 0xC4:
            table = bytes(body)
        elif mark == 0xDA:
            if shape is None or table is None or body[3] != 1:
                raise ValueError("lossless frames with another predictor than the left neighbour are not decoded")
            counts, symbols = table[1:17], table[17:]
            codes = sum(c << (16 - k) for k, c in enumerate(counts, 1))  # of 16 bits, how many have a code
            if not symbols or sum(counts) != len(symbols) or codes > 1 << 16 or max(symbols) > 16:
                raise ValueError("a Huffman table that is none")
            if not 0 < shape[0] * shape[1] <= 8 * len(frame):  # a sample takes a bit at least
                raise ValueError("a frame with fewer bits than samples")
            return at + 2 + n, shape, counts, symbols
        elif mark in (0xC0, 0xC1):
            return None
        elif 0xC0 <= mark <= 0xCF and mark != 0xC8:
            raise ValueError("frames of progressive or arithmetic processes are not decoded")
        at += 2 + n
    raise ValueError("a JPEG frame that breaks off")


def decode_frames(frames: list[memoryview], found: tuple, starts_at: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Samples of lossless frames of one shape and table, a row a frame, all decoded in step, and which of them hold a whole scan."""
    bodies = [j[a:-2] for j, a in zip(frames, starts_at)]
    (height, width), counts, symbols = found
    deep = max(n for n in range(1, 17) if counts[n - 1])
    look = np.full((1 << deep, 2), -1, np.int64)
    code, k = 0, 0
    for n in range(1, deep + 1):
        for _ in range(counts[n - 1]):
            look[code << (deep - n) : (code + 1) << (deep - n)] = symbols[k], n
            code, k = code + 1, k + 1
        code <<= 1
    sizes = np.array([len(b) for b in bodies], np.int64)
    raw = np.frombuffer(b"".join(bodies), np.uint8)
    edge = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=edge[1:])
    stuffing = np.flatnonzero(raw[:-1] == 255) + 1
    keep = np.ones(len(raw), bool)
    keep[stuffing] = False
    places = edge - np.searchsorted(stuffing, edge, "left")
    d = np.concatenate([raw[keep], np.zeros(4, np.uint8)]).astype(np.uint32)
    window = (d[:-3] << 24 | d[1:-2] << 16 | d[2:-1] << 8 | d[3:]).astype(np.int64)
    at, end = places[:-1] * 8, places[1:] * 8
    n = len(at)
    out = np.empty((height * width, n), np.uint8)
    whole = np.ones(n, bool)
    cats, lens = look[:, 0].copy(), look[:, 1].copy()
    whole_table = bool((cats >= 0).all())
    left, above = np.full(n, 128, np.int64), None
    for i in range(height * width):
        if i % width == 0 and i:
            left = above
        w = (window[np.minimum(at >> 3, len(window) - 1)] << (at & 7)) & 0xFFFFFFFF
        top = w >> (32 - deep)
        cat, used = cats[top], lens[top]
        if not whole_table:
            whole &= cat >= 0
            cat, used = np.maximum(cat, 0), np.maximum(used, 1)
        extra = ((w << used) & 0xFFFFFFFF) >> (32 - cat)
        diff = np.where(extra < (1 << cat) >> 1, extra - (1 << cat) + 1, extra)
        left = (left + diff) & 255
        out[i] = left
        if i % width == 0:
            above = left
        at += used + cat
    return np.ascontiguousarray(out.T), whole & (at <= end)


def histograms(frames: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Share of each frame's payload samples in each of ``BINS`` grey levels."""
    n = len(frames)
    inside = np.arange(frames.shape[1])[None, :] < lengths[:, None]
    cell = (np.arange(n)[:, None] * BINS + (frames >> 4))[inside]
    h = np.bincount(cell, minlength=n * BINS).reshape(n, BINS)
    return h / np.maximum(lengths, 1)[:, None]


def cuts(diffs: np.ndarray) -> list[int]:
    """Frames that begin a shot, from the histogram difference of each frame to the one before."""
    starts, run = [0], []
    for i, d in enumerate(diffs.tolist(), 1):
        recent = run[-CUT_MEMORY:]
        mean = sum(recent) / len(recent) if recent else 0.0
        spread = (sum((x - mean) ** 2 for x in recent) / len(recent)) ** 0.5 if recent else 0.0
        if d > max(CUT_FLOOR, mean + CUT_SPREAD * spread):
            starts.append(i)
            run = []
        else:
            run.append(d)
    return starts


def clip_spans(hist: np.ndarray, fps: float) -> list[tuple[float, float, int]]:
    """Timed clips of a film: start and end in seconds, and frames."""
    starts = cuts(np.abs(np.diff(hist, axis=0)).sum(axis=1))
    ends = [*starts[1:], len(hist)]
    return [(a / fps, b / fps, b - a) for a, b in zip(starts, ends)]


def pad(n: int) -> int:
    """Payload length of ``n`` bytes: the next positive multiple of 64."""
    return max(64, -(-n // 64) * 64)


def store_texts(data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """One AVI file for each text of a UTF-8 buffer; the last frame is filled up with zero samples."""
    sizes = np.diff(offsets)
    padded = np.maximum(64, -(-sizes // 64) * 64)
    count = -(-padded // FRAME)
    first = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(count, out=first[1:])
    block = np.zeros(int(first[-1]) * FRAME, np.uint8)
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        s = int(first[i]) * FRAME
        block[s : s + b - a] = data[a:b]
    frames = encode_frames(block.reshape(-1, FRAME))
    f = first.tolist()
    return [build_avi(frames[f[i] : f[i + 1]], int(padded[i])) for i in range(len(sizes))]


def _film(x: dict, parts: list[np.ndarray]) -> dict:
    """Payload, clips and mean histogram of a film from its frames in order."""
    total = x["length"] if x["length"] is not None else sum(map(len, parts))
    payload, hists, at = [], [], 0
    for a in range(0, len(parts), STEP):
        block = np.stack(parts[a : a + STEP])
        inside = np.clip(total - at - np.arange(len(block)) * block.shape[1], 0, block.shape[1])
        hists.append(histograms(block, inside))
        payload.append(block.tobytes()[: max(total - at, 0)])
        at += block.size
    hist = np.concatenate(hists)
    return {"error": None, "payload": b"".join(payload), "clips": clip_spans(hist, x["fps"]), "hist": hist.mean(axis=0)}


def read_films(files: list[bytes | None]) -> list[dict]:
    """Payload and clips of each AVI file, or its ``error``; lossless frames of one shape and table are decoded together, others one by one."""
    infos: list[dict | str] = []
    alike: dict[tuple, list[tuple[int, int, memoryview, int]]] = {}
    frames: list[list[np.ndarray | None]] = []
    for i, f in enumerate(files):
        frames.append([])
        try:
            info = parse_avi(f or b"")
            view, mine, head = memoryview(f), [], {}
            for k, (a, n) in enumerate(info["frames"]):
                j = view[a : a + n]
                key = bytes(j[: len(JPEG_HEADER)])
                if key not in head:
                    head[key] = _scan_of(j)
                frames[i].append(None)
                if head[key] is None:
                    frames[i][k] = jpeg.luminance(bytes(j)).ravel()
                else:
                    mine.append((head[key][1:], (i, k, j, head[key][0])))
            infos.append(info)
            for kind, frame in mine:
                alike.setdefault(kind, []).append(frame)
        except (ValueError, struct.error, IndexError) as wrong:
            infos.append(str(wrong) or "a broken file")
    for kind, rows in alike.items():
        for a in range(0, len(rows), STEP):
            part = rows[a : a + STEP]
            samples, whole = decode_frames([r[2] for r in part], kind, [r[3] for r in part])
            for (i, k, _, _), row, ok in zip(part, samples, whole.tolist()):
                frames[i][k] = row
                if not ok:
                    infos[i] = "a frame whose scan breaks off"
    out = []
    for x, parts in zip(infos, frames):
        if isinstance(x, dict) and len({len(p) for p in parts}) > 1:
            x = "frames of differing size"
        out.append({"error": x, "payload": None, "clips": None, "hist": None} if isinstance(x, str) else _film(x, parts))
    return out


def _films(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in chunked(whole, "_text"):
            data, offsets = utf8_buffer(batch.column("_text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(np.diff(offsets)), pa.array(store_texts(data, offsets), pa.binary())],
                ["_id", "n_bytes", "media"],
            )


def to_films(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's text as an AVI file: ``id_col``, ``n_bytes`` (unpadded) and ``media`` (the file)."""
    kind = df.schema[id_col].dataType.simpleString()
    src = df.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    return src.mapInArrow(_films, f"_id {kind}, n_bytes long, media binary").withColumnRenamed("_id", id_col)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in chunked(whole, "_media", 2 << 20):
            files = batch.column("_media").to_pylist()
            films = read_films(files)
            each = lambda f: [None if x["error"] else f(x) for x in films]
            rows = {
                "error": [x["error"] for x in films],
                "payload_bytes": each(lambda x: len(x["payload"])),
                "payload_sha256": each(lambda x: hashlib.sha256(x["payload"]).hexdigest()),
                "tail_crc32": each(lambda x: zlib.crc32(x["payload"][-64:])),
                "media_bytes": [None if f is None else len(f) for f in files],
                "media_sha256": [None if f is None else hashlib.sha256(f).hexdigest() for f in files],
                "clips": each(lambda x: [{"start_s": a, "end_s": b, "frames": n} for a, b, n in x["clips"]]),
                "histogram": each(lambda x: x["hist"].tolist()),
            }
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), *(pa.array(rows[k], t) for k, t in _FEATURE_TYPES)], ["_id", *(k for k, _ in _FEATURE_TYPES)]
            )


_CLIPS = pa.list_(pa.struct([("start_s", pa.float64()), ("end_s", pa.float64()), ("frames", pa.int64())]))
_FEATURE_TYPES = [
    ("error", pa.string()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()),
    ("media_sha256", pa.string()), ("clips", _CLIPS), ("histogram", pa.list_(pa.float64())),
]


def film_features(df: DataFrame, id_col: str = "doc_id", media_col: str = "media") -> DataFrame:
    """Digests, clips and mean histogram of each AVI file; ``error`` says why a file has none."""
    kind = df.schema[id_col].dataType.simpleString()
    schema = (
        f"_id {kind}, error string, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, "
        "clips array<struct<start_s:double,end_s:double,frames:bigint>>, histogram array<double>"
    )
    src = df.select(F.col(id_col).alias("_id"), F.col(media_col).alias("_media"))
    return src.mapInArrow(_features, schema).withColumnRenamed("_id", id_col)


def clip_rows(features: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row a clip: ``id_col``, ``clip`` (from 0), ``start_s``, ``end_s``, ``frames``."""
    return features.select(id_col, F.posexplode("clips").alias("clip", "c")).select(id_col, "clip", "c.*")


def media_columns(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stores every text as a film, reads it back and describes it; the file travels between the two in one stage."""
    films = to_films(df, id_col, text_col)
    kind = df.schema[id_col].dataType.simpleString()
    keyed = films.select(F.struct(F.col(id_col), "n_bytes").alias("_row"), "media")
    out = film_features(keyed, "_row")
    feature = F.concat_ws(
        ";", F.transform("clips", lambda c: F.concat(F.format_number(c["start_s"], 2), F.lit("-"), F.format_number(c["end_s"], 2)))
    )
    levels = F.concat_ws(",", F.transform("histogram", lambda x: F.round(x * 1000).cast("int").cast("string")))
    return out.select(
        F.col(f"_row.{id_col}").cast(kind).alias(id_col), "_row.n_bytes", "payload_bytes", "payload_sha256", "tail_crc32",
        "media_bytes", "media_sha256", F.concat(F.lit("clips="), feature, F.lit(" levels="), levels).alias("feature"),
    )
