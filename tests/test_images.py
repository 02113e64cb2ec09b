"""Pixel kernels against plain loops, metadata and names, configuration, and a whole run over a folder of made images."""

import copy
import csv
import json
import math
import os
import struct
import zlib
from datetime import datetime, timezone

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry import config
from quarry.__main__ import main
from quarry.functions import kernels as K
from quarry.operators import inference
from quarry.operators.bursts import assign_bursts, burst_names
from quarry.operators.pairs import cosine_pairs, near_chosen, nearest
from quarry.operators.selection import WEIGHTS, select_greedy
from quarry.sources import capture, images, outputs, vocabulary

CONFIG = {
    "dataset": {"train": 3, "validate": 2},
    "runtime": {"device": "auto", "batch_size": 4, "workers": 1, "output_mode": "copy"},
    "models": {"embedding": "none", "tagger": {"repo": "none", "revision": "none", "selected_tags_sha256": ""}},
    "audit": {"min_side": 64, "max_aspect": 3.0, "brisque": {"enabled": True, "weight": 0.15}, "focus": {"fail_risk": 0.99, "soft_risk_start": 0.52, "semantic_hard": 0.9, "semantic_corroborated": 0.8, "semantic_corroboration_risk": 0.9}},
    "dedup": {"phash_distance": 8, "pixel_difference": 0.08, "dino_similarity": 0.985, "dino_phash_distance": 16},
    "burst": {"enabled": True, "gap_seconds": 5.0, "max_span_seconds": 20.0, "use_exif": True, "use_filename": True, "use_mtime": False, "repeat_penalty": 0.08},
    "semantic": {
        "evidence_floor": 0.2, "availability_capture": 0.75, "presence_threshold": 0.3,
        "categories": [{"name": "seated", "group": "pose", "weight": 0.7, "target_fraction": 0.5, "tags": ["Sitting Down"]}, {"name": "held", "weight": 0.9, "prefixes": ["holding"], "exclude_tags": ["holding pen"]}],
        "penalties": [{"name": "semantic_blur", "weight": 0.0, "tags": ["blurry"]}, {"name": "censoring", "weight": 0.3, "hard_threshold": 0.65, "tags": ["censored"]}],
    },
    "selection": {"quality_weight": 0.3, "coverage_weight": 0.5, "novelty_weight": 0.2, "coverage_top_groups": 3, "novelty_similarity_start": 0.94, "redundancy_similarity_start": 0.965, "redundancy_penalty": 0.12, "soft_focus_penalty": 0.12, "semantic_penalty_cap": 0.3},
    "validation": {"near_duplicate_similarity": 0.98, "near_duplicate_phash_distance": 24, "same_burst_similarity": 0.95},
}
TAGS = ["sitting down", "holding cup", "holding pen", "blurry", "censored"]


def reflect(i, n):
    while not 0 <= i < n:
        i = -i - 1 if i < 0 else 2 * n - 1 - i
    return i


def test_filters_are_plain_sums():
    a = np.random.default_rng(1).random((17, 19))

    def at(y, x):
        return a[reflect(y, 17), reflect(x, 19)]

    lap = [[at(y - 1, x) + at(y + 1, x) + at(y, x - 1) + at(y, x + 1) - 4 * at(y, x) for x in range(19)] for y in range(17)]
    assert np.allclose(K.laplace(a), lap)
    s = [[sum(k * (at(y + d, x + 1) - at(y + d, x - 1)) for d, k in ((-1, 1), (0, 2), (1, 1))) for x in range(19)] for y in range(17)]
    assert np.allclose(K.sobel(a, 1), s)
    for size in (7, 11):
        assert np.allclose(K.box(a, size, 0), [[np.mean([at(y + d, x) for d in range(-(size // 2), size // 2 + 1)]) for x in range(19)] for y in range(17)])


def test_resize_is_a_windowed_sinc():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 256, (9, 40), dtype=np.uint8)
    got = K.resize(a, 9, 16)
    scale = 40 / 16
    for y, v in ((0, 0), (4, 7), (8, 15)):
        c, total, norm = (v + 0.5) * scale, 0.0, 0.0
        for x in range(max(0, int(c - 3 * scale + 0.5)), min(40, int(c + 3 * scale + 0.5))):
            t = (x + 0.5 - c) / scale
            w = np.sinc(t) * np.sinc(t / 3) if abs(t) < 3 else 0.0
            total, norm = total + w * a[y, x], norm + w
        assert got[y, v] == min(255, max(0, math.floor(total / norm + 0.5)))
    assert (K.resize(np.full((50, 70, 3), 93, np.uint8), 32, 32) == 93).all()
    assert K.shrink(np.zeros((1000, 500), np.uint8), 384).shape == (384, 192) and K.shrink(np.zeros((1000, 10), np.uint8), 384).shape == (384, 32)


def test_hash_is_that_of_the_cosine_transform():
    view = np.random.default_rng(3).integers(0, 256, (32, 32), dtype=np.uint8)
    y = np.arange(32)
    low = [float((view * np.cos(np.pi * (2 * y[:, None] + 1) * u / 64) * np.cos(np.pi * (2 * y[None, :] + 1) * v / 64)).sum() * (0.5**0.5 if not u else 1) * (0.5**0.5 if not v else 1)) for u in range(8) for v in range(8)]
    median = sorted(low[1:])[31]
    assert f"{K.perceptual_hash(view):064b}" == "0" + "".join(str(int(c > median)) for c in low[1:])


def test_signals():
    rng = np.random.default_rng(4)
    sharp = rng.integers(0, 256, (200, 300, 3), dtype=np.uint8)
    flat = np.full((200, 300, 3), 128, np.uint8)
    assert K.simple_signals(flat) == (0.0, 0.75) and K.blur_signals(flat) == (1.0, 1.0, 1.0)
    assert K.simple_signals(sharp)[0] > 1000 and max(K.blur_signals(sharp)) < 0.6
    soft = K.resize(K.resize(sharp, 25, 38), 200, 300)
    assert all(a < b for a, b in zip(K.blur_signals(sharp), K.blur_signals(soft)))
    assert math.isnan(K.reblur(np.zeros((15, 40)), 7))
    assert K.simple_signals(np.zeros((64, 64, 3), np.uint8))[1] == 0.0


def test_colours_turns_and_squares():
    bgra = np.array([[[1, 2, 3, 255], [0, 0, 0, 0]]], np.uint8)
    assert K.to_rgb(bgra.tobytes(), 1, 2, 4).tolist() == [[[3, 2, 1], [255, 255, 255]]]
    assert K.to_rgb(b"\x07", 1, 1, 1).tolist() == [[[7, 7, 7]]]
    a = np.array([[1, 2], [3, 4], [5, 6]])
    want = {1: a, 2: [[2, 1], [4, 3], [6, 5]], 3: [[6, 5], [4, 3], [2, 1]], 4: [[5, 6], [3, 4], [1, 2]], 5: a.T, 6: [[5, 3, 1], [6, 4, 2]], 7: [[6, 4, 2], [5, 3, 1]], 8: [[2, 4, 6], [1, 3, 5]], None: a, 9: a}
    for turn, rows in want.items():
        assert K.orient(a, turn).tolist() == np.asarray(rows).tolist(), turn
    for turn in range(1, 9):  # a box of the upright image shows the same pixels in the stored one
        stored = np.arange(35).reshape(5, 7)
        up = K.orient(stored, turn)
        assert (K.crop(stored, (1, 2, 4, 5), turn) == up[2:5, 1:4]).all() and K.crop(stored, (1, 2, 4, 5), turn).shape == (3, 3)
    s = K.square(np.full((2, 6, 3), 9, np.uint8), True)
    assert s.shape == (6, 6, 3) and (s == 9).all()
    assert K.square(np.full((2, 6, 3), 9, np.uint8), False)[0, 0].tolist() == [255, 255, 255]
    assert K.pixel_difference(bytes([0, 255]), bytes([255, 255])) == 0.5


def exif(order: str, first: dict, second: dict) -> bytes:
    """A JPEG head with a metadata block of texts and short numbers."""

    def folder(tags: dict, at: int) -> bytes:
        fixed, loose = struct.pack(order + "H", len(tags)), b""
        end = at + 2 + 12 * len(tags) + 4
        for tag, v in sorted(tags.items()):
            if isinstance(v, str):
                raw = v.encode() + b"\0"
                value = raw.ljust(4, b"\0") if len(raw) <= 4 else struct.pack(order + "I", end + len(loose))
                loose += raw if len(raw) > 4 else b""
                fixed += struct.pack(order + "HHI", tag, 2, len(raw)) + value
            elif tag == capture.SUB_FOLDER:
                fixed += struct.pack(order + "HHII", tag, 4, 1, v)
            else:
                fixed += struct.pack(order + "HHIHH", tag, 3, 1, v, 0)
        return fixed + b"\0" * 4 + loose

    if second:
        first = first | {capture.SUB_FOLDER: 0}
        first[capture.SUB_FOLDER] = 8 + len(folder(first, 8))
    body = folder(first, 8)
    block = (b"II*\0" if order == "<" else b"MM\0*") + struct.pack(order + "I", 8) + body + (folder(second, 8 + len(body)) if second else b"")
    segment = b"Exif\0\0" + block
    return b"\xff\xd8\xff\xe0\x00\x04ab\xff\xe1" + struct.pack(">H", len(segment) + 2) + segment + b"\xff\xda"


@pytest.mark.parametrize("order", ["<", ">"])
def test_metadata(order):
    data = exif(order, {capture.ORIENTATION: 6, capture.MODIFIED: "2020:01:02 03:04:05"}, {capture.ORIGINAL: "2019:01:02 03:04:05", capture.ORIGINAL_FRACTION: "25"})
    got = capture.metadata(data)
    assert got[capture.ORIENTATION] == 6 and got[capture.ORIGINAL] == "2019:01:02 03:04:05" and got[capture.ORIGINAL_FRACTION] == "25"
    for broken in (b"", b"\xff\xd8", data[:40], b"II*\0\xff\xff\xff\xff", b"\x89PNG\r\n\x1a\n\0\0"):
        assert isinstance(capture.metadata(broken), dict)


def test_metadata_behind_the_pixels(spark, tmp_path):
    pad = 1 << 18
    tiff = b"II*\0" + struct.pack("<I", 8 + pad) + b"\7" * pad + struct.pack("<HHHIHHI", 1, capture.ORIENTATION, 3, 1, 6, 0, 0)
    block = b"II*\0" + struct.pack("<I", 8) + struct.pack("<HHHIHHI", 1, capture.ORIENTATION, 3, 1, 8, 0, 0)
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + b"\0" * 4
    (tmp_path / "late.tif").write_bytes(tiff)
    (tmp_path / "late.png").write_bytes(b"\x89PNG\r\n\x1a\n" + chunk(b"IDAT", bytes(pad)) + chunk(b"eXIf", block))
    got = {r["path"][-8:]: r["orientation"] for r in images.headers(images.image_files(spark, str(tmp_path))).collect()}
    assert got == {"late.tif": 6, "late.png": 8}


def us(*parts, micro=0):
    return int(datetime(*parts, tzinfo=timezone.utc).timestamp()) * 10**6 + micro


def test_capture_chain(spark):
    rows = [
        ("2019:01:02 03:04:05", "25", None, "IMG_20200102_030405", us(2019, 1, 2, 3, 4, 5, micro=250000), "exif"),
        ("2019-01-02 03:04:05+02:00", None, None, "x", us(2019, 1, 2, 1, 4, 5), "exif"),
        ("2019:13:02 03:04:05", None, "2018:01:01 00:00:00", "x", us(2018, 1, 1), "exif"),
        (None, None, None, "IMG_20200102_030405", us(2020, 1, 2, 3, 4, 5), "filename"),
        (None, None, None, "20200102-030405123", us(2020, 1, 2, 3, 4, 5, micro=123000), "filename"),
        (None, None, None, "a 2020-01-02 03.04.05 b", us(2020, 1, 2, 3, 4, 5), "filename"),
        (None, None, None, "20201302_030405", None, ""),
        (None, None, None, "920200102_0304051", None, ""),
        ("rubbish", "", None, "", None, ""),
    ]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, original string, original_fraction string, modified string, stem string, t long, s string")
    df = df.withColumns({"digitized": F.lit(None).cast("string"), "digitized_fraction": F.lit(None).cast("string")})
    tags = F.struct("original", "original_fraction", "digitized", "digitized_fraction", "modified")
    got = df.select("i", capture.capture_time(tags, F.col("stem"), F.lit(None).cast("timestamp"), use_mtime=True).alias("c")).orderBy("i").collect()
    assert [(r["c"]["capture_us"], r["c"]["capture_source"]) for r in got] == [r[4:] for r in rows]
    stems = spark.createDataFrame([("file:/a/b.c.jpg",), ("x",), ("/d/.hidden",)], "p string").select(capture.file_stem(F.col("p")).alias("s")).collect()
    assert [r["s"] for r in stems] == ["b.c", "x", ".hidden"]


def changed(path: str, value) -> dict:
    cfg = copy.deepcopy(CONFIG)
    at = cfg
    *front, last = path.split(".")
    for p in front:
        at = at[int(p)] if isinstance(at, list) else at[p]
    if value is ...:
        del at[last]
    else:
        at[last] = value
    return cfg


@pytest.mark.parametrize(
    "path,value",
    [
        ("extra", 1), ("dataset.train", 0), ("dataset.train", ...), ("dataset", []), ("runtime.device", "tpu"), ("runtime.output_mode", "move"), ("audit.focus.soft_risk_start", 0.995), ("dedup.phash_distance", 65),
        ("burst.max_span_seconds", 1.0), ("burst.enabled", "yes"), ("semantic.evidence_floor", 0.3), ("selection.quality_weight", 0.4), ("selection.coverage_top_groups", 0), ("semantic.categories.0.name", "held"), ("semantic.categories.0.tags", []),
        ("semantic.categories.0.weight", -1), ("semantic.categories.0.max_target_fraction", 0.1), ("semantic.categories.0.odd", 1), ("semantic.penalties.0.name", "other"), ("virtual", {"face_crop": {"enabled": True}}), ("virtual", {"x": 1}),
    ],
)
def test_config_refuses(path, value):
    with pytest.raises(config.ConfigError):
        config.checked(changed(path, value))


def test_config_accepts():
    rows = config.spec_rows(config.checked(CONFIG))
    assert [r[:4] for r in rows] == [("seated", "category", 0, "pose"), ("held", "category", 1, "coverage"), ("semantic_blur", "penalty", 0, "penalty"), ("censoring", "penalty", 1, "penalty")]
    face = {"enabled": True, "model_path": "m.bin", "min_size": 1, "min_face_size": 1, "context_scale": 1.5, "confidence": 0.5, "detection_max_side": 9}
    assert config.checked(CONFIG | {"virtual": {"face_crop": face}}, "/a")["virtual"]["face_crop"]["model_path"] == "/a/m.bin"


def words(spark):
    return spark.createDataFrame([(i, t.replace(" ", "_"), 0) for i, t in enumerate(TAGS)] + [(9, "holding_x", 4)], "tag_idx int, name string, category int")


def test_vocabulary(spark, tmp_path):
    specs = config.specs(spark, config.checked(CONFIG))
    got = vocabulary.resolved(specs, words(spark)).collect()
    assert {tuple(r) for r in got} == {("seated", 0), ("held", 1), ("semantic_blur", 3), ("censoring", 4)}
    with pytest.raises(vocabulary.VocabularyError, match="seated.tags:nothing"):
        vocabulary.resolved(config.specs(spark, changed("semantic.categories.0.tags", ["nothing"])), words(spark))
    (tmp_path / "v.csv").write_text("name,category\nSitting Down,0\nx,4\n")
    assert [tuple(r) for r in vocabulary.read(spark, f"file://{tmp_path}/v.csv").orderBy("tag_idx").collect()] == [(0, "sitting_down", 0), (1, "x", 4)]
    with pytest.raises(vocabulary.VocabularyError):
        vocabulary.read(spark, f"file://{tmp_path}/v.csv", "00")


def test_vector_joins_are_exact(spark):
    rng = np.random.default_rng(6)
    v = rng.normal(size=(60, 8))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    v[7] = v[3]
    df = spark.createDataFrame([(f"k{i:02d}", x.tolist()) for i, x in enumerate(v)], "k string, v array<double>")
    s = v @ v.T
    got = {(r["a"], r["b"]) for r in cosine_pairs(df, "k", "v", 0.5, pivots=5, block_rows=7).collect()}
    assert got == {(r["a"], r["b"]) for r in cosine_pairs(df, "k", "v", 0.5).collect()}
    assert got == {(f"k{i:02d}", f"k{j:02d}") for i in range(60) for j in range(i + 1, 60) if s[i, j] >= 0.5}
    chosen = df.where("k < 'k10'")
    found = {r["k"]: r["nearest"] for r in nearest(df, chosen, "k", "v").collect()}
    np.fill_diagonal(s, -np.inf)
    assert found == {f"k{i:02d}": f"k{int(s[i, :10].argmax()):02d}" for i in range(60)}
    near = {(r["k"], r["chosen"]) for r in near_chosen(df, chosen, "k", "v", 0.4).collect()}
    assert near == {(f"k{i:02d}", f"k{j:02d}") for i in range(60) for j in range(10) if s[i, j] >= 0.4}


def sequential(rows, group_of, weight, target, n):
    """Picks by the plain rule, a pick at a time over all rows."""
    p, chosen, covered, used, similar = WEIGHTS, [], np.zeros(len(target)), {}, {r[0]: -1.0 for r in rows}
    while len(chosen) < min(n, len(rows)):
        scored = []
        for i, q, blame, burst, focus, v, e in rows:
            if i in chosen:
                continue
            gains = {}
            for g, w, t, c, x in zip(group_of, weight, target, covered, e):
                gains[g] = max(gains.get(g, 0.0), x * (max(t - c, 0) / t if t > 1e-6 else 0.0) * w / max(1.0, *weight))
            best = [x for x in sorted(gains.values(), reverse=True)[: p["top_groups"]] if x > 1e-6]
            s = similar[i]
            clip = lambda x: min(1.0, max(0.0, x))
            score = p["quality"] * (q or 0) + p["coverage"] * (sum(best) / max(1, len(best))) + p["novelty"] * (clip((1 - s) / (1 - p["novelty_start"])) if chosen else 0.5)
            score -= (blame or 0) + p["redundancy"] * clip((s - p["redundancy_start"]) / (1 - p["redundancy_start"])) ** 2
            score -= p["soft_focus"] * clip(((focus or 0) - p["soft_start"]) / (p["fail_risk"] - p["soft_start"])) + (p["repeat"] * min(3, used.get(burst, 0)) if burst else 0)
            scored.append((score, q or 0, i, burst, v, e))
        top = max(x[0] for x in scored)
        _, _, i, burst, v, e = min((x for x in scored if x[0] >= top - 1e-8), key=lambda x: (-x[1], x[2]))
        chosen.append(i)
        covered = covered + np.array(e)
        used[burst] = used.get(burst, 0) + 1
        similar = {r[0]: max(similar[r[0]], float(np.dot(r[5], v))) for r in rows}
    return chosen


def test_selection_is_sequential(spark):
    rng = np.random.default_rng(7)
    v = rng.normal(size=(30, 4))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    rows = [(f"r{i:02d}", float(rng.random()), float(rng.random() * 0.1), ["", "b1", "b2"][i % 3], float(rng.random()), v[i].tolist(), rng.random(3).tolist()) for i in range(30)]
    rows += [("r30", *rows[4][1:]), ("r31", None, None, None, None, *rows[4][5:])]
    pool = spark.createDataFrame(rows, "record_id string, quality double, penalty double, burst string, focus_risk double, vector array<double>, evidence array<double>")
    args = (["a", "a", "b"], [1.0, 1.2, 0.5], [4.0, 2.0, 0.0], 12)
    want = sequential(rows, *args)
    assert len(want) == 12
    for candidates in (1024, 6, 1):
        assert [r["record_id"] for r in select_greedy(pool, *args, candidates=candidates).orderBy("pick").collect()] == want
    assert select_greedy(pool.limit(0), *args).count() == 0


def test_burst_numbers(spark):
    rows = [("b", "exif", 0, "1"), ("b", "exif", 2, "2"), ("b", "exif", 4, "3"), ("b", "exif", 6, "4"), ("a", "exif", 0, "5"), ("a", "exif", 1, "6"), ("a", "exif", 50, "7"), ("a", "mtime", 51, "8"), ("a", "exif", None, "9")]
    df = spark.createDataFrame(rows, "dir string, src string, t long, id string")
    got = burst_names(assign_bursts(df, ["dir", "src"], "t", "id", 2, 4), ["dir", "src"]).collect()
    assert {r["id"]: r["burst_id"] for r in got} == {"5": "B00001", "6": "B00001", "1": "B00002", "2": "B00002", "3": "B00002"}


def picture(seed: int, h: int = 96, w: int = 128) -> np.ndarray:
    rng = np.random.default_rng(seed)
    return np.clip(K.resize(rng.integers(0, 256, (12, 16, 3), dtype=np.uint8), h, w) + rng.integers(-20, 20, (h, w, 3)), 0, 255).astype(np.uint8)


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    top = tmp_path_factory.mktemp("run") / "in"
    (top / "sub").mkdir(parents=True)
    for i in range(9):
        place = top / ("sub" if i % 2 else "") / f"IMG_20200102_0304{i:02d}.png"
        place.write_bytes(outputs.png(picture(i)))
    (top / "copy.PNG").write_bytes(outputs.png(picture(0)))
    (top / "small.png").write_bytes(outputs.png(picture(20, 40, 90)))
    (top / "long.png").write_bytes(outputs.png(picture(21, 64, 320)))
    (top / "broken.jpg").write_bytes(b"no image")
    (top / "notes.txt").write_text("x")
    return top


def test_scan_and_audit(spark, folder):
    cfg = config.checked(CONFIG)
    rows = {os.path.basename(r["path"]): r for r in images.records(spark, str(folder), str(folder / "sub"), cfg).collect()}
    assert "IMG_20200102_030401.png" not in rows and "notes.txt" not in rows and len(rows) == 9
    assert {n: r["reject_reason"] for n, r in rows.items() if r["reject_reason"]} == {"small.png": "small", "long.png": "aspect", "broken.jpg": "decode:Unreadable"}
    r = rows["IMG_20200102_030400.png"]
    rgb = picture(0)
    assert (r["width"], r["height"], r["capture_us"], r["capture_source"]) == (128, 96, us(2020, 1, 2, 3, 4, 0), "filename")
    assert r["phash"] == K.perceptual_hash(K.hash_view(K.grey(rgb))) == rows["copy.PNG"]["phash"]
    assert (r["laplacian"], r["exposure"]) == K.simple_signals(rgb) and bytes(r["thumb"]) == K.thumb(rgb).tobytes()


def stored(up: np.ndarray, turn: int) -> np.ndarray:
    """The image that `turn` makes upright."""
    a = up[::-1] if turn in (3, 4, 7, 8) else up
    a = a[:, ::-1] if turn in (2, 3, 6, 7) else a
    return a.swapaxes(0, 1) if turn in (5, 6, 7, 8) else a


def test_all_orientations_of_parents_and_crops(spark, tmp_path):
    up = picture(7, 96, 128)
    for turn in range(1, 9):
        block = b"MM\0*" + struct.pack(">IHHHIHHI", 8, 1, capture.ORIENTATION, 3, 1, turn, 0, 0)
        data = outputs.png(np.ascontiguousarray(stored(up, turn)))
        chunk = struct.pack(">I", len(block)) + b"eXIf" + block + struct.pack(">I", zlib.crc32(b"eXIf" + block))
        (tmp_path / f"{turn}.png").write_bytes(data[:33] + chunk + data[33:])
    cfg = config.checked(CONFIG)
    rows = images.records(spark, str(tmp_path), None, cfg)
    by = {int(os.path.basename(r["path"])[0]): r for r in rows.collect()}
    box = (20, 8, 100, 72)
    wanted = rows.select("path", F.lit("face_crop").alias("kind"), F.lit(0).alias("view_index"), F.struct(*[F.lit(v).alias(n) for n, v in zip(("x1", "y1", "x2", "y2"), box)]).alias("crop_box"), F.lit(0.9).alias("confidence"), F.lit(40.0).alias("w"), F.lit(40.0).alias("h"))
    crops = {int(os.path.basename(r["path"])[0]): r for r in images.crop_records(spark, str(tmp_path), rows, wanted, cfg).collect()}
    part = up[8:72, 20:100]
    for turn in range(1, 9):
        r, c = by[turn], crops[turn]
        assert (r["orientation"], r["width"], r["height"]) == (turn, 128, 96) and K.pixel_difference(bytes(r["thumb"]), K.thumb(up).tobytes()) < 0.004
        assert r["laplacian"] == pytest.approx(K.simple_signals(up)[0], rel=1e-9) and r["blur_global"] == pytest.approx(K.blur_signals(up)[0], abs=1e-3)
        assert (c["orientation"], c["width"], c["height"], c["phash"]) == (turn, 80, 64, K.perceptual_hash(K.hash_view(K.grey(part))))
        assert bytes(c["thumb"]) == K.thumb(part).tobytes() and c["laplacian"] == K.simple_signals(part)[0]
    chosen = spark.createDataFrame([(crops[t]["path"], str(t), t, f"{t}.png", box, t) for t in crops], "path string, record_id string, pick int, file string, crop_box struct<x1:int,y1:int,x2:int,y2:int>, orientation int")
    outputs.materialise(spark, str(tmp_path), outputs.manifest(chosen), str(tmp_path / "out"), "copy")
    assert {(tmp_path / "out" / f"{t}.png").read_bytes() for t in range(1, 9)} == {outputs.png(part)}


def test_other_formats_go_to_the_decoder(spark, tmp_path):
    rgb = np.arange(60, dtype=np.uint8).reshape(4, 5, 3)
    (tmp_path / "a.webp").write_bytes(rgb.tobytes())
    (tmp_path / "b.avif").write_bytes(b"broken")
    decoder = lambda: lambda b: np.frombuffer(b, np.uint8).reshape(4, 5, 3)
    got = {os.path.basename(r["path"]): r for r in images.pixels(spark, str(tmp_path), decoder=decoder).collect()}
    assert got["b.avif"]["height"] == -1 and (K.to_rgb(got["a.webp"]["data"], 4, 5, 3) == rgb).all()
    assert {r["height"] for r in images.pixels(spark, str(tmp_path), decoder=lambda: None).collect()} == {-1}


def test_inference_hooks(spark, folder):
    rows = images.pixels(spark, str(folder)).withColumnRenamed("path", "record_id")
    inputs = inference.model_inputs(rows, 8, True)
    assert inputs.count() == 12

    def make():
        return lambda x: x.mean(axis=(1, 2)).astype(np.float32)

    v = inference.embeddings(inputs, make, 8, 4).collect()
    assert all(abs(sum(x * x for x in r["vector"]) - 1) < 1e-9 for r in v)
    assert inference.tag_probabilities(inputs, make, 8, 4, 3).count() == 36
    with pytest.raises(Exception, match="output width 3"):
        inference.tag_probabilities(inputs, make, 8, 4, 5).collect()


def test_device():
    assert [inference.device("auto", {"mps"}.__contains__), inference.device("auto", lambda d: True), inference.device("auto", lambda d: False), inference.device("cuda", lambda d: False)] == ["mps", "cuda", "cpu", "cuda"]
    assert inference.device("auto") in ("cuda", "mps", "cpu")


def test_whole_run(spark, folder, tmp_path):
    face = {"enabled": True, "model_path": "m", "min_size": 64, "min_face_size": 20, "context_scale": 1.5, "confidence": 0.5, "detection_max_side": 640}
    (tmp_path / "c.json").write_text(json.dumps(CONFIG | {"virtual": {"face_crop": face}}))
    (tmp_path / "v.csv").write_text("name,category\n" + "".join(f"{t},0\n" for t in TAGS))
    names = [f"file:{folder}/{'sub/' if i % 2 else ''}IMG_20200102_0304{i:02d}.png" for i in range(9)] + [f"file:{folder}/copy.PNG"]
    crop = f"{names[2]}::face_crop:0:"
    cfg = config.checked(CONFIG)
    box = spark.createDataFrame([(names[2], 0, 40.0, 20.0, 40.0, 40.0, 0.9), (names[2], 1, 0.0, 0.0, 10.0, 10.0, 0.99), (names[3], 0, 0.0, 0.0, 9.0, 9.0, 0.9)], "path string, det_idx int, x double, y double, w double, h double, confidence double")
    box.write.parquet(str(tmp_path / "det"))
    crop += "28,14,92,78"
    rng = np.random.default_rng(8)
    ids = [*names, crop]
    v = rng.normal(size=(len(ids), 16))
    v[4] = v[5]
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    spark.createDataFrame([(n, x.tolist()) for n, x in zip(ids, v)], "record_id string, vector array<double>").write.parquet(str(tmp_path / "vec"))
    probs = [(n, t, 0.95 if (n == names[6] and t == 4) else float(rng.random() * 0.5)) for n in ids for t in range(5)]
    spark.createDataFrame(probs, "record_id string, tag_idx int, prob double").write.parquet(str(tmp_path / "prob"))
    out = tmp_path / "out"
    code = main([str(folder), str(out), "--config", str(tmp_path / "c.json"), "--vectors", str(tmp_path / "vec"), "--probabilities", str(tmp_path / "prob"), "--vocabulary", f"file://{tmp_path}/v.csv", "--detections", str(tmp_path / "det")])
    assert code == 0
    rows = [r for p in sorted((out / "debug.csv").glob("part-*.csv")) for r in csv.DictReader(p.open())]
    by = {r["record_id"]: r for r in rows}
    assert len(rows) == 14 and by[crop]["crop_box"] == "28,14,92,78" and by[crop]["kind"] == "face_crop"
    assert sorted(r["reject_reason"] for r in rows if r["reject_reason"] in ("small", "aspect", "decode:Unreadable", "phash_duplicate")) == ["aspect", "decode:Unreadable", "phash_duplicate", "small"]
    assert by[names[6]]["reject_reason"] in ("semantic_hard", "focus") and by[names[0]]["burst_id"].startswith("B0000")
    status = [r["status"] for r in rows]
    assert status.count("train") == 3 and status.count("validate") <= 2
    assert len(list((out / "train").iterdir())) == 3 and len(list((out / "validate").iterdir())) == status.count("validate")
    sources = {s: {r["source_id"] for r in rows if r["status"] == s} for s in ("train", "validate")}
    assert not sources["train"] & sources["validate"]
    assert "cat:seated" in rows[0] and "pen:censoring" in rows[0] and by[crop]["detected_width"] == "40"
    assert cfg["dataset"]["train"] == 3


def test_too_few_images_end_the_run(spark, folder, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"x": 1}))
    assert main([str(folder), str(tmp_path / "o"), "--config", str(tmp_path / "c.json"), "--vectors", "v", "--probabilities", "p", "--vocabulary", "w"]) == 2


def test_crops_and_equal_names(spark, folder, tmp_path):
    box = (10, 20, 74, 84)
    path = f"file:{folder}/IMG_20200102_030402.png"
    rows = [(path, "a", 1, "x.png", None), (path, "b", 2, "X.png", None), (path, "c", 3, "x__face0.png", box)]
    df = outputs.manifest(spark.createDataFrame(rows, "path string, record_id string, pick int, file string, crop_box struct<x1:int,y1:int,x2:int,y2:int>"))
    for mode in ("copy", "hardlink", "symlink"):
        out = tmp_path / mode
        assert outputs.materialise(spark, str(folder), df, str(out), mode) == 3
        assert sorted(p.name for p in out.iterdir()) == ["X__e9d71f5e.png", "x.png", "x__face0.png"]
    assert (tmp_path / "copy/x.png").read_bytes() == outputs.png(picture(2)) and (tmp_path / "symlink/x.png").is_symlink()
    seen = images.pixels(spark, str(tmp_path / "copy")).where("path like '%face0%'").first()
    assert (K.to_rgb(seen["data"], seen["height"], seen["width"], seen["channels"]) == picture(2)[20:84, 10:74]).all()
