"""Images against plain definitions; URL rules against a loop over them."""

import hashlib
import io
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldtally.llm import media
from fieldtally.llm import queries as q
from fieldtally.llm.url_filter import INLINE_RULES, Rule, host_of, path_of, rarest_tokens, url_filter


def test_netpbm_kinds():
    assert media.decode_netpbm(b"P1\n# c\n3 2\n1 0 1\n0 1 0\n").tolist() == [[0, 1, 0], [1, 0, 1]]
    assert media.decode_netpbm(b"P2 2 1 255 7 9").tolist() == [[7, 9]]
    assert media.decode_netpbm(b"P3 1 1 255 1 2 3").tolist() == [[[1, 2, 3]]]
    assert media.decode_netpbm(b"P4 9 1\n" + bytes([0b10000000, 0b10000000])).tolist() == [[0, 1, 1, 1, 1, 1, 1, 1, 0]]
    assert media.decode_netpbm(b"P5 2 1 255\n" + bytes([1, 2])).tolist() == [[1, 2]]
    assert media.decode_netpbm(b"P5 1 1 65535\n" + bytes([1, 2])).tolist() == [[258]]
    assert media.decode_netpbm(b"P6 1 1 255\n" + bytes([1, 2, 3])).tolist() == [[[1, 2, 3]]]
    giant = b"9" * 25
    out_of_range = [b"P2 1 1 255 300", b"P2 1 1 255 -5", b"P2 1 1 255 " + giant, b"P2 1 1 255 x", b"P5 1 1 100\n\xff", b"P1 1 1 2", b"P5 %s 1 255\n\1" % giant, b"P5 0 %s 255\n" % giant, b"P4 %s 1\n\1" % giant]
    for bad in (*out_of_range, b"P7 1 1 255\n", b"P5 2 2 255\n\1", b"P5 2", b"P5 1 1 70000\n\1\1", b""):
        with pytest.raises(ValueError):
            media.decode_netpbm(bad)


def bmp(bits, rows, palette=b"", height=1, packed=0):
    first = 54 + len(palette)
    return b"BM" + struct.pack("<IHHI", 0, 0, 0, first) + struct.pack("<IiiHHIIiiII", 40, 2, height, 1, bits, packed, 0, 0, 0, len(palette) // 4, 0) + palette + rows


def test_bmp_kinds():
    assert media.decode(bmp(24, bytes([3, 2, 1, 6, 5, 4, 0, 0]))).tolist() == [[[1, 2, 3], [4, 5, 6]]]
    assert media.decode(bmp(32, bytes([3, 2, 1, 0, 6, 5, 4, 0]))).tolist() == [[[1, 2, 3], [4, 5, 6]]]
    masks = struct.pack("<III", 0xFF, 0xFF00, 0x3FF00000)  # red first, blue of 10 bits
    assert media.decode(bmp(32, struct.pack("<II", 1 | 2 << 8 | 1023 << 20, 7), masks, packed=3)).tolist() == [[[1, 2, 255], [7, 0, 0]]]
    for bad in (bmp(32, bytes(8), struct.pack("<III", 0, 1, 2), packed=3), bmp(24, bytes(8), packed=3), bmp(8, b""), b"BM"):
        with pytest.raises((ValueError, struct.error)):
            media.decode(bad)
    two = bytes([0, 0, 0, 0, 9, 8, 7, 0])
    assert media.decode(bmp(8, bytes([1, 0, 0, 0]), two)).tolist() == [[[7, 8, 9], [0, 0, 0]]]
    assert media.decode(bmp(1, bytes([0b01000000, 0, 0, 0]), two)).tolist() == [[[0, 0, 0], [7, 8, 9]]]
    rows = bytes([1, 1, 1, 1, 1, 1, 0, 0]) + bytes([2, 2, 2, 2, 2, 2, 0, 0])
    assert media.decode(bmp(24, rows, height=2))[0, 0].tolist() == [2, 2, 2] and media.decode(bmp(24, rows, height=-2))[0, 0].tolist() == [1, 1, 1]


@pytest.mark.parametrize("shape", [(8, 9), (16, 18), (5, 7), (1, 64), (100, 3)])
def test_resize_is_the_mean_of_areas(shape):
    image = np.random.default_rng(1).integers(0, 256, shape).astype(np.uint8)
    fine = np.kron(image.astype(float), np.ones((8, 9)))
    plain = fine.reshape(8, shape[0], 9, shape[1]).mean((1, 3))
    assert np.allclose(media.area_resize(image, 8, 9), plain)
    assert np.allclose(media.area_resize(image, 8, 9, rows=3), plain)
    tiles = media.to_tiles(image, 4)
    assert (media.from_tiles(tiles) == image).all() and np.load(io.BytesIO(tiles[0])).shape[0] <= 4


def test_media_rows_with_errors(spark):
    pgm = media.encode_pgm(np.arange(128, dtype=np.uint8).reshape(2, 64))
    df = spark.createDataFrame([(1, pgm, "x"), (2, None, "x"), (3, b"nothing", "x"), (None, pgm, "x"), (1, pgm, "x"), (4, b"P2 1 1 255 99999999999999999999", "x"), (5, b"P5 99999999999999999999 1 255\n\1", "x")], "k long, media binary, dhash string")
    rows = media.media_tiles(df, "k", "media").collect()
    assert len(rows) == 7 and sum(r.error is None for r in rows) == 3
    assert media.media_tiles(df.limit(0), "k", "media").count() == 0


def test_texts_come_back(spark):
    texts = {1: "", 2: None, 3: "é" * 32, 4: "x" * 300_000, 5: "same", 6: "same", 7: "a" * 64, 8: "a" * 65}
    df = spark.createDataFrame([(k, t, "?") for k, t in texts.items()], "doc_id long, text string, feature string")
    rows = {r.doc_id: r for r in media.text_media(df).collect()}
    for k, t in texts.items():
        raw = (t or "").encode()
        payload = raw + bytes(-len(raw) % 64 if raw else 64)
        r = rows[k]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        image = np.frombuffer(payload, np.uint8).reshape(-1, 64)
        tiles = []
        for i in range(0, len(image), 4096):
            np.save(f := io.BytesIO(), image[i : i + 4096])
            tiles.append(f.getvalue())
        fine = np.kron(image, np.ones((8, 9))).reshape(8, len(image), 9, 64).mean((1, 3)) if len(image) < 200 else None
        assert (r.media_bytes, r.media_sha256) == (sum(map(len, tiles)), hashlib.sha256(b"".join(tiles)).hexdigest())
        assert r.feature.endswith(f":64x{len(image)}")
        if fine is not None and np.abs(np.diff(fine, axis=1)).min() > 1e-9:
            assert r.feature.split(":")[0] == np.packbits(fine[:, :-1] > fine[:, 1:]).tobytes().hex()
    assert rows[5][1:] == rows[6][1:] and rows[4].media_bytes > 300_000
    assert media.text_media(df.limit(0)).count() == 0


URLS = [None, "", "no scheme", "http://Example.COM/en/7", "https://a.example.com/en/77/x?y", "http://example.com/en/8", "http://badexample.com/en/7", "http://x.net/de/8", "http://www.example.net/de/8#x", "http://example.net/de/7", "http://org/es/", "http://a.org/ES/", "http://com", "x://y.com/en/?q=http://z.org/es/", "http://ÉX.com/en/", "http://example.com:80/en/7", "http://a.com/en/\nb", "http://.com/en/"]


def plainly(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
        path = rest[end:]
        path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = min(fits, key=lambda r: (-len(r.name), r.name), default=None)
    return host, path, best and best.name, best.verdict if best else "allow"


@pytest.mark.parametrize("many", [False, True])
def test_rules(spark, many):
    rules = list(q.RULES)
    if many:
        rules += [Rule(f"h{i}.com", f"/p{i % 7}/", "block") for i in range(INLINE_RULES)]
    urls = [*URLS, *(f"http://h{i}.com/p{i % 7}/x" for i in range(5)), URLS[3]]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)] + [(None, URLS[3], "x")], "page_id long, url string, rule string")
    rows = url_filter(pages, rules).collect()
    assert len(rows) == len(urls) + 1
    for r in rows:
        assert (r.host, r.path, r.rule, r.verdict) == plainly(urls[r.page_id] if r.page_id is not None else URLS[3], rules)
    assert url_filter(pages.limit(0), rules).count() == 0


def test_a_rule_is_found_by_its_rarest_whole_token(spark):
    pages = spark.createDataFrame([(1, "http://a.com/en/7"), (2, "http://b.com/en/8")], "page_id long, url string")
    rule = Rule("com", "/en/7", "block")
    assert rule.tokens == ["com", "en"]
    assert rarest_tokens(pages, [rule, Rule("a.com", "/x", "block")])[Rule("a.com", "/x", "block")] == "a"
    wild = Rule("com", "/e*/7", "block")
    assert wild.tokens == ["com"] and url_filter(pages, [wild]).where("rule is not null").count() == 1
    assert url_filter(pages, []).where("verdict = 'allow'").count() == 2
    assert [tuple(r) for r in pages.select(host_of(F.col("url")), path_of(F.col("url"))).collect()][0] == ("a.com", "/en/7")
