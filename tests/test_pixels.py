import struct
import zlib

import numpy as np
import pytest

from sievewright.operators import jpeg, pixels
from sievewright.schema import Thresholds


def png(x: np.ndarray) -> bytes:
    """A PNG of (h, w) grey, (h, w, 3) or (h, w, 4) bytes."""
    h, w = x.shape[:2]
    kind = {2: 0, 3: 2 if x.shape[-1] == 3 else 6}[x.ndim]
    raw = b"".join(b"\0" + row.tobytes() for row in x.astype(np.uint8))
    chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, kind, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw, 1)) + chunk(b"IEND", b"")


def noise(seed=0, h=400, w=600):
    return np.random.default_rng(seed).integers(0, 255, (h // 20, w // 20, 3)).repeat(20, 0).repeat(20, 1)


def distance(a, b):
    return (int(a, 16) ^ int(b, 16)).bit_count()


def test_phash_properties():
    x = noise()
    a = pixels.phash(pixels.thumbnail(x))
    assert len(a) == 16 and a == pixels.phash(pixels.thumbnail(x))
    assert distance(a, pixels.phash(pixels.thumbnail(pixels.resize(x, 300, 450)))) <= 5
    assert distance(a, pixels.phash(pixels.thumbnail(np.clip(x + np.random.default_rng(1).normal(0, 6, x.shape), 0, 255)))) <= 8
    assert distance(a, pixels.phash(pixels.thumbnail(noise(9)))) > 15


def test_dct_is_the_sum_of_cosines():
    d, x = pixels.cosines(8), np.random.default_rng(0).random((8, 8))
    k, m = 3, 5
    want = sum(x[i, j] * np.cos(np.pi * (2 * i + 1) * k / 16) * np.cos(np.pi * (2 * j + 1) * m / 16) for i in range(8) for j in range(8))
    assert np.isclose((d @ x @ d.T)[k, m], want)


def test_resize_keeps_constants_and_weights_sum_to_one():
    assert np.allclose(pixels.lanczos_weights(100, 7).sum(axis=1), 1) and np.allclose(pixels.lanczos_weights(5, 20).sum(axis=1), 1)
    assert (pixels.resize(np.full((50, 70, 3), 123), 9, 11) == 123).all()
    assert pixels.thumbnail(np.zeros((1000, 500, 3))).shape == (256, 128, 3) and pixels.thumbnail(np.zeros((10, 20, 3))).shape == (10, 20, 3)


def test_sharpness():
    x = noise()
    blurred = pixels.resize(pixels.resize(x, 20, 30), 400, 600)
    assert pixels.laplacian_variance(pixels.thumbnail(x)) > 5 * pixels.laplacian_variance(pixels.thumbnail(blurred))
    assert pixels.laplacian_variance(np.zeros((2, 2, 3))) == 0.0


def test_border_counts_corners_twice():
    x = np.zeros((20, 20, 3))
    x[:2, :2] = 100
    m = pixels.statistics(x)
    assert np.isclose(m["border_mean"], 100 * 8 / (4 * 2 * 20)) and m["dark_frac"] == 0.99 and m["saturation"] == 0


def test_measure_a_folder(spark, tmp_path):
    field, back = np.clip(noise(3, 1500 // 5, 2000 // 5) // 2 + 70, 0, 255), np.full((300, 400, 3), 5)
    back[100:200, 150:250] = noise(4, 100, 100)
    (tmp_path / "field.png").write_bytes(png(field))
    (tmp_path / "dark.png").write_bytes(png(back))
    (tmp_path / "grey.png").write_bytes(png(field[:, :, 0]))
    (tmp_path / "alpha.png").write_bytes(png(np.dstack([field, np.full(field.shape[:2], 255)])))
    (tmp_path / "bad.jpg").write_bytes(b"this is no image")
    got = {r.name: r for r in pixels.measure(spark, str(tmp_path)).collect()}
    assert {k: (r.width, r.height, r.mode) for k, r in got.items() if k != "bad.jpg"} == {"field.png": (400, 300, "RGB"), "dark.png": (400, 300, "RGB"), "grey.png": (400, 300, "L"), "alpha.png": (400, 300, "RGBA")}
    assert got["bad.jpg"].error.startswith("ValueError") and got["bad.jpg"].bytes == 16
    assert np.isclose(got["field.png"].saturation, pixels.statistics(pixels.thumbnail(field))["saturation"])
    t = Thresholds()
    studio = lambda m: (m.border_std < t.border_std and (m.border_mean < t.border_dark or m.border_mean > t.border_light)) or m.dark_frac > t.dark_frac or m.light_frac > t.light_frac
    assert studio(got["dark.png"]) and not studio(got["field.png"])


def pictures():
    rng, (y, x) = np.random.default_rng(2), np.mgrid[:301, :417]
    return {
        "smooth": np.stack([x * 255 // 417, y * 255 // 301, (x + y) * 255 // 718], axis=2),
        "noise": rng.integers(0, 256, (64, 72, 3)),
        "stripes": np.stack([np.tile(np.arange(40) % 2 * 255, (30, 1)), np.full((30, 40), 90), np.tile(np.arange(40) % 2 * 60, (30, 1))], axis=2),
        "odd": rng.integers(100, 140, (13, 7, 3)),
        "one": np.array([[[255, 0, 10]]]),
        "flat": np.full((40, 40, 3), 77),
        "sparse": (rng.random((96, 96, 3)) > 0.999) * 255,
    }


def test_jpeg_is_read_back_by_the_decoder(spark, tmp_path):
    made = pictures()
    for k, v in made.items():
        (tmp_path / f"{k}.jpg").write_bytes(jpeg.encode(v.astype(np.uint8)))
    got = {r.name[:-4]: pixels.to_rgb(r.data, r.height, r.width, r.nChannels).astype(float) for r in pixels.decoded(spark, str(tmp_path)).collect()}
    assert {k: v.shape for k, v in got.items()} == {k: v.shape for k, v in made.items()}
    error = {k: float(((v - made[k]) ** 2).mean()) for k, v in got.items()}
    assert error["flat"] <= 1 and error["smooth"] < 1 and error["one"] < 2
    assert max(error.values()) < 25  # 34 dB on noise; halved chroma would cost the stripes thousands


def test_jpeg_does_not_depend_on_strips(monkeypatch):
    made = {k: jpeg.encode(v.astype(np.uint8)) for k, v in pictures().items()}
    monkeypatch.setattr(jpeg, "STRIP", 1)
    assert made == {k: jpeg.encode(v.astype(np.uint8)) for k, v in pictures().items()}
    assert all(len(jpeg.encode(v.astype(np.uint8), 50)) <= len(made[k]) for k, v in pictures().items())
    for shape in ((0, 5, 3), (5, 5), (5, 5, 4), (1, 65_536, 3)):
        with pytest.raises(ValueError):
            jpeg.encode(np.zeros(shape, dtype=np.uint8))


def test_code_lengths_are_those_of_a_prefix_code():
    for seed, n in ((0, 1), (1, 2), (2, 17), (3, 200), (4, 256)):
        rng = np.random.default_rng(seed)
        counts = np.zeros(256, dtype=np.int64)
        counts[rng.permutation(256)[:n]] = np.floor(2.0 ** rng.uniform(0, 40, n)).astype(np.int64)  # as uneven as a code of 16 bits is hard on
        got = jpeg.code_lengths(counts)
        assert sorted(got) == np.flatnonzero(counts).tolist() and max(got.values()) <= 16
        assert sum(2.0 ** -k for k in got.values()) < 1  # room for the code of ones
    fib = np.zeros(256, dtype=np.int64)
    fib[:6] = [1, 1, 2, 4, 8, 16]
    assert [jpeg.code_lengths(fib)[k] for k in range(6)] == [6, 5, 4, 3, 2, 1]
