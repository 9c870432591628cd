"""Frames and containers of other writers: DCT frames made by the JVM's own encoder, sound before video, several RIFF segments, broken files."""

import random
import struct

import numpy as np
import pytest

from marlspike.llm import jpeg, media


def _scene(rng, height, width, shift=0):
    y, x = np.mgrid[0:height, 0:width]
    base = 128 + 60 * np.sin((x + shift) / 7.0) + 50 * np.cos(y / 5.0)
    return np.clip(base + rng.normal(0, 4, (height, width)), 0, 255).astype(np.uint8)


def _java_jpeg(spark, image, colour):
    """A JPEG by the JVM's image writer, and the luminance its reader gives."""
    jvm, gate = spark._jvm, spark.sparkContext._gateway
    height, width = image.shape
    kind = jvm.java.awt.image.BufferedImage.TYPE_INT_RGB if colour else jvm.java.awt.image.BufferedImage.TYPE_BYTE_GRAY
    picture = jvm.java.awt.image.BufferedImage(width, height, kind)
    flat = gate.new_array(jvm.int, height * width * (3 if colour else 1))
    values = np.stack([image, 255 - image, image // 2], -1) if colour else image
    for i, v in enumerate(values.ravel().tolist()):
        flat[i] = v
    picture.getRaster().setPixels(0, 0, width, height, flat)
    out = jvm.java.io.ByteArrayOutputStream()
    assert jvm.javax.imageio.ImageIO.write(picture, "jpg", out)
    data = bytes(out.toByteArray())
    reader = jvm.javax.imageio.ImageIO.getImageReadersByFormatName("jpeg").next()
    reader.setInput(jvm.javax.imageio.ImageIO.createImageInputStream(jvm.java.io.ByteArrayInputStream(data)))
    raster = reader.readRaster(0, None)
    return data, np.array([raster.getSample(x, y, 0) for y in range(height) for x in range(width)]).reshape(height, width)


@pytest.mark.parametrize("height,width,colour", [(16, 16, False), (19, 37, False), (16, 32, True), (21, 35, True)])
def test_dct_frames_equal_another_decoder(spark, height, width, colour):
    image = _scene(np.random.default_rng(height), height, width)
    data, want = _java_jpeg(spark, image, colour)
    got = jpeg.luminance(data)
    assert got.shape == want.shape and np.abs(got.astype(int) - want).max() <= 2  # rounding of the inverse transform
    for cut in (20, len(data) // 2, len(data) - 8):
        with pytest.raises(ValueError):
            jpeg.luminance(data[:cut])


def _encode(image, restart=0):
    """A small encoder of grey frames without tables of Huffman codes: motion JPEG's usual form."""
    codes = {}
    for key in ((0, 0), (1, 0)):
        counts, symbols = (bytes.fromhex(x) for x in jpeg.STANDARD[key])
        code, k = 0, 0
        for n in range(1, 17):
            for _ in range(counts[n - 1]):
                codes[key[0], symbols[k]] = format(code, f"0{n}b")
                code, k = code + 1, k + 1
            code <<= 1
    height, width = image.shape
    quant = np.full(64, 4)

    def value(v):
        n = int(abs(v)).bit_length()
        return n, format(v if v >= 0 else v + (1 << n) - 1, f"0{n}b") if n else ""

    def packed(bits):
        bits += "1" * (-len(bits) % 8)
        return bytes(int(bits[i : i + 8], 2) for i in range(0, len(bits), 8)).replace(b"\xff", b"\xff\x00")

    scan, bits, before, count = [], "", 0, 0
    for y in range(0, height, 8):
        for x in range(0, width, 8):
            if restart and count and count % restart == 0:
                scan.append(packed(bits) + bytes([0xFF, 0xD0 + (count // restart - 1) % 8]))
                bits, before = "", 0
            block = jpeg._COSINES.T @ (image[y : y + 8, x : x + 8].astype(float) - 128) @ jpeg._COSINES
            line = np.rint(block.ravel()[list(jpeg.ZIGZAG)] / quant).astype(int).tolist()
            n, extra = value(line[0] - before)
            bits, before, run = bits + codes[0, n] + extra, line[0], 0
            for v in line[1:]:
                if v == 0:
                    run += 1
                    continue
                while run > 15:
                    bits, run = bits + codes[1, 0xF0], run - 16
                n, extra = value(v)
                bits, run = bits + codes[1, run << 4 | n] + extra, 0
            bits += codes[1, 0] if run else ""
            count += 1
    scan.append(packed(bits))
    part = lambda mark, body: b"\xff" + bytes([mark]) + struct.pack(">H", len(body) + 2) + body
    head = b"\xff\xd8" + part(0xDB, b"\0" + bytes(quant.tolist())) + part(0xC0, struct.pack(">BHHB", 8, height, width, 1) + b"\x01\x11\x00")
    head += part(0xDD, struct.pack(">H", restart)) if restart else b""
    return head + part(0xDA, b"\x01\x01\x00\x00\x3f\x00") + b"".join(scan) + b"\xff\xd9"


def test_frames_without_tables_and_with_restarts():
    image = _scene(np.random.default_rng(1), 24, 40)
    for restart in (0, 1, 4):
        assert np.abs(jpeg.luminance(_encode(image, restart)).astype(int) - image).max() <= 12
    assert np.array_equal(jpeg.luminance(_encode(image)), jpeg.luminance(_encode(image, 2)))
    for mark in (b"\xff\xc2", b"\xff\xc9"):
        with pytest.raises(ValueError):
            jpeg.luminance(_encode(image).replace(b"\xff\xc0", mark))


def _list(name, *parts):
    return media._chunk(b"LIST", name + b"".join(parts))


def _avi(frames, layout, width=40, height=24):
    """A film as the second of two streams, sound first, laid out in one of several ways."""
    strh = lambda kind, codec, scale, rate: media._chunk(b"strh", kind + codec + struct.pack("<IHHIIIIIIII4H", 0, 0, 0, 0, scale, rate, 0, len(frames), 0, 0, 0, 0, 0, width, height))
    strf = media._chunk(b"strf", struct.pack("<IiiHH4sIiiII", 40, width, height, 1, 24, b"mjpg", 0, 0, 0, 0, 0))
    sound = _list(b"strl", strh(b"auds", b"\0\0\0\0", 1, 8000), media._chunk(b"strf", b"\1\0\1\0" + struct.pack("<II", 8000, 8000) + b"\1\0\x08\0"))
    name = b"01db" if layout == "db" else b"01dc"
    chunks = [media._chunk(b"01wb"[:0] + b"00wb", b"noise!") + media._chunk(name, f) for f in frames]
    half = len(chunks) // 2
    index_size = 16 + 8 + 24 + 16
    indx = lambda places: media._chunk(b"indx", struct.pack("<HBBI4s12x", 4, 0, 0, len(places), name) + b"".join(struct.pack("<QII", p, n, 0) for p, n in places))
    video = lambda extra=b"": _list(b"strl", strh(b"vids", b"MJPG", 1, 10), strf, extra)
    hdrl = lambda extra=b"": _list(b"hdrl", media._chunk(b"avih", bytes(56)), sound, video(extra))
    if layout == "rec":
        return media._chunk(b"RIFF", b"AVI " + hdrl() + _list(b"movi", *(_list(b"rec ", c) for c in chunks)))
    if layout in ("movi", "file", "wrong", "db"):
        start = 12 + len(hdrl()) + 8 if layout == "file" else 0
        at, entries = start + 4, []
        for c, f in zip(chunks, frames):
            skip = 8 + 6
            entries += [b"00wb" + struct.pack("<III", 0, at, 6), name + struct.pack("<III", 16, at + skip + (3 if layout == "wrong" else 0), len(f))]
            at += len(c)
        return media._chunk(b"RIFF", b"AVI " + hdrl() + _list(b"movi", *chunks) + media._chunk(b"idx1", b"".join(entries)))
    groups = [chunks[:half], chunks[half:]] if layout in ("segments", "opendml") else [chunks]
    if layout == "segments":
        return media._chunk(b"RIFF", b"AVI " + hdrl() + _list(b"movi", *groups[0])) + media._chunk(b"RIFF", b"AVIX" + _list(b"movi", *groups[1]))
    assert layout == "opendml" and index_size
    plain = media._chunk(b"RIFF", b"AVI " + hdrl(indx([(0, 0), (0, 0)])) + _list(b"movi", *groups[0]))
    parts, places, at = [], [], 0
    for k, group in enumerate(groups):
        base = (len(plain) - sum(map(len, group)) if k == 0 else len(parts[0]) + 12 + 12)
        entries, at = [], base
        for c, f in zip(group, frames[:half] if k == 0 else frames[half:]):
            entries.append(struct.pack("<II", at - base + 8 + 6 + 8, len(f)))
            at += len(c)
        ix = media._chunk(b"ix01", struct.pack("<HBBI4sQI", 2, 0, 1, len(group), name, base, 0) + b"".join(entries))
        places.append((at, len(ix)))
        parts.append(None if k == 0 else media._chunk(b"RIFF", b"AVIX" + _list(b"movi", *group, ix)))
        if k == 0:
            parts[0] = media._chunk(b"RIFF", b"AVI " + hdrl(indx([(0, 0), (0, 0)])) + _list(b"movi", *group, ix))
    parts[0] = parts[0].replace(indx([(0, 0), (0, 0)]), indx(places))
    return b"".join(parts)


@pytest.fixture(scope="module")
def film():
    rng = np.random.default_rng(7)
    dark = lambda s: (_scene(rng, 24, 40, s) // 4).astype(np.uint8)
    frames = [_encode(_scene(rng, 24, 40, k)) for k in range(6)] + [_encode(dark(k)) for k in range(5)] + [_encode(_scene(rng, 24, 40, 9))] * 3
    return frames


@pytest.mark.parametrize("layout", ["movi", "file", "wrong", "db", "rec", "segments", "opendml"])
def test_films_of_any_layout(film, layout):
    """Shots of ten frames a second begin where the scene turns dark and where it turns light again."""
    info = media.parse_avi(_avi(film, layout))
    assert info["fps"] == 10 and len(info["frames"]) == len(film)
    (out,) = media.read_films([_avi(film, layout)])
    assert out["error"] is None and out["clips"] == [(0.0, 0.6, 6), (0.6, 1.1, 5), (1.1, 1.4, 3)]
    assert out["payload"] == b"".join(jpeg.luminance(f).tobytes() for f in film)


def test_broken_files_stop_no_other(spark, film):
    good = media.build_avi(media.encode_frames(np.arange(2048, dtype=np.uint8).reshape(2, 1024)), 1500)
    rng = random.Random(4)
    files = [(1, good), (2, None), (3, b""), (4, b"RIFF"), (5, good[: len(good) // 2]), (6, good.replace(b"MJPG", b"H264")), (7, _avi(film, "movi")), (8, good.replace(b"vids", b"txts"))]
    at = good.index(media.JPEG_HEADER) + len(media.JPEG_HEADER)
    files += [(9, good[:at] + b"\xff\xd9" * 30 + good[at + 60 :])]
    files += [(100 + i, bytes(b if rng.random() > 0.01 else rng.randrange(256) for b in f)) for i, f in enumerate([good] * 20 + [_avi(film, "opendml")] * 20)]
    got = {r["doc_id"]: r for r in media.film_features(spark.createDataFrame([(i, bytearray(f) if f is not None else None) for i, f in files], "doc_id long, media binary")).collect()}
    assert set(got) == {i for i, _ in files}
    assert got[1]["error"] is None and got[1]["payload_bytes"] == 1500 and got[7]["error"] is None and len(got[7]["clips"]) == 3
    for i in (2, 3, 4, 5, 6, 8):
        assert got[i]["error"] and got[i]["payload_bytes"] is None and got[i]["clips"] is None
    clips = media.clip_rows(media.film_features(spark.createDataFrame([(7, bytearray(_avi(film, "rec"))), (8, None)], "doc_id long, media binary"))).collect()
    assert [(r["clip"], r["frames"]) for r in sorted(clips, key=lambda r: r["clip"])] == [(0, 6), (1, 5), (2, 3)]
    empty = spark.createDataFrame([], "doc_id long, media binary")
    assert media.film_features(empty).count() == 0


def test_long_films_are_coded_in_blocks(monkeypatch):
    data = np.random.default_rng(2).integers(0, 256, 50_000).astype(np.uint8)
    whole = media.store_texts(data, np.array([0, 50_000]))
    monkeypatch.setattr(media, "STEP", 7)
    assert media.store_texts(data, np.array([0, 50_000])) == whole
    (out,) = media.read_films(whole)
    assert out["payload"][:50_000] == data.tobytes() and len(out["payload"]) == media.pad(50_000)
