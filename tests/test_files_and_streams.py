"""Folders of images, written manifests, and streams across restarts."""

import hashlib
import shutil
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from boxloom import vocabulary as V
from boxloom.functions import pixels
from boxloom.operators import scoring
from boxloom.sources import images as I
from boxloom.sources import sinks
from boxloom.streaming import ingest


def png(rgb):
    h, w, _ = rgb.shape

    def chunk(kind, data):
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    raw = b"".join(b"\0" + row.tobytes() for row in rgb.astype("uint8"))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("pictures")
    rng = np.random.default_rng(1)
    noisy = rng.integers(0, 256, (60, 80, 3))
    for name, data in {
        "bed/a one.PNG": png(noisy), "bed/copy.png": png(noisy), "bed/white.png": png(np.full((40, 40, 3), 250)),
        "sofa/dark.png": png(np.zeros((40, 64, 3))), "sofa/broken.jpg": b"not a picture", "sofa/notes.txt": b"x",
        "sofa/deep/x.png": png(np.full((8, 8, 3), 100)), "other/z.webp": b"RIFF",
    }.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data)
    return str(root)


def test_class_folder_scan(spark, folder):
    got = sorted((r.label, r.path) for r in I.class_folder_images(spark, folder, ["bed", "sofa"]).collect())
    assert got == [("bed", "bed/a one.PNG"), ("bed", "bed/copy.png"), ("bed", "bed/white.png"), ("sofa", "sofa/broken.jpg"), ("sofa", "sofa/dark.png")]
    plan = I.list_images(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1]


def test_split_tree(spark, tmp_path):
    for p in ("train/main_door/1.png", "val/room_door/2.jpg", "extra/room_door/3.jpg", "train/bed/4.jpg"):
        (tmp_path / p).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / p).write_bytes(b"x")
    got = sorted((r.split, r.label, r.class_index) for r in I.split_tree_samples(spark, str(tmp_path), "door").collect())
    assert got == [("train", "main_door", 0), ("val", "room_door", 1)]


def test_decode_and_quarantine(spark, folder):
    table = I.decoded(spark, folder).cache()
    good, skipped = I.quarantine(table)
    rows = {r.path: r for r in good.collect()}
    assert set(rows) == {"bed/a one.PNG", "bed/copy.png", "bed/white.png", "sofa/dark.png", "sofa/deep/x.png"}
    assert {r.path for r in skipped.collect()} == {"sofa/broken.jpg", "other/z.webp"}
    a, b = rows["bed/a one.PNG"], rows["bed/copy.png"]
    assert (a.width, a.height) == (80, 60) and a.signature == b.signature and a.sha1 == hashlib.sha1(open(folder + "/bed/copy.png", "rb").read()).hexdigest()
    assert rows["bed/white.png"].white == 1.0 and rows["sofa/dark.png"].dark == 1.0 and len(a.ahash) == 16
    assert abs(np.linalg.norm(a.vector) - 1) < 1e-5 and len(a.vector) == 3072
    verdicts = {r.path: r.v for r in good.select("path", pixels.verdict(min_bytes=10, short_side=20).alias("v")).collect()}
    assert verdicts == {"bed/a one.PNG": "ok", "bed/copy.png": "ok", "bed/white.png": "white", "sofa/dark.png": "dark", "sofa/deep/x.png": "small_side"}
    table.unpersist()


def test_red_channel_and_means():
    bgr = np.zeros((64, 64, 3), dtype="uint8")
    bgr[:, 32:, 2] = 200  # red in the right half
    white, dark, red, ahash, _ = pixels.describe(bgr.tobytes(), 64, 64, 3)
    assert white == 0 and dark == 0.5 and abs(red - np.std([0, 200] * 512, ddof=1)) < 1e-9
    assert ahash == "0f" * 8
    assert pixels.describe(b"", 0, 0, 3) is None
    assert np.allclose(pixels.shrink(np.arange(12).reshape(3, 4, 1), 2).mean(), 5.5)


def test_scorer_loads_once_per_task_and_batches(spark):
    df = spark.range(50).select(F.col("id").alias("image_id"), F.lit(10).alias("width"), F.lit(10).alias("height"), F.lit("p").alias("prompt"))

    def load():
        import pandas as pd

        def score(part):
            assert len(part) <= 3
            n = len(part)
            return pd.DataFrame({"image_id": part["image_id"], "pos": 0, "raw_label": "bed", "score": 0.5,
                                 "x1": [0.0] * n, "y1": [0.0] * n, "x2": [1.0] * n, "y2": [1.0] * n})
        return score

    assert scoring.score_images(df, load, max_images=3, max_pixels=10_000).count() == 50


def test_sinks_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("b.jpg", "train", "bed", "x"), ("a.jpg", "val", "bed", "y")], "path string, split string, label string, label_text string")
    sinks.write_manifest(df.select("label", "label_text", "path", "split"), str(tmp_path / "m"), ["path"])
    assert [r.path for r in sinks.read_manifest(spark, str(tmp_path / "m"), "label string, label_text string, path string, split string").orderBy("path").collect()] == ["a.jpg", "b.jpg"]
    out = str(tmp_path / "export")
    sinks.export_split(df, out)
    assert sorted(r.path for r in spark.read.parquet(out).collect()) == ["a.jpg", "b.jpg"]
    again = df.unionByName(df.limit(1).withColumn("path", F.lit("c.jpg")))
    sinks.export_split(again, out)
    assert sorted(r.path for r in spark.read.parquet(out).collect()) == ["a.jpg", "b.jpg", "c.jpg"]
    more = again.unionByName(df.limit(1).withColumn("path", F.lit("d.jpg")))
    for _ in range(2):  # a retry under the same name adds nothing twice
        assert [r.path for r in sinks.export_split(more, out, "third").collect()] == ["d.jpg"]
    assert sorted(r.path for r in spark.read.parquet(out).collect()) == ["a.jpg", "b.jpg", "c.jpg", "d.jpg"]
    tidy = spark.createDataFrame([("split", "train", 3), ("split", "val", 1)], "section string, key string, value long")
    sinks.write_summary(tidy, str(tmp_path / "s"))
    assert spark.read.text(str(tmp_path / "s")).collect()[0][0] == '{"section":"split","counts":{"train":3,"val":1}}'
    sinks.write_list(df, "path", str(tmp_path / "l"), ["path"])
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "l")).collect()) == ["a.jpg", "b.jpg"]
    bom = tmp_path / "bom.csv"
    bom.write_bytes("\ufeffpath,n\nx,1\n".encode("utf-8"))
    assert sinks.read_manifest(spark, str(bom), "path string, n int").collect()[0].path == "x"


def land(spark, rows, path):
    spark.createDataFrame(rows, "arrival_id long, ts timestamp_ntz, label string, content_key string").coalesce(1).write.mode("append").parquet(path)


def test_quota_stream_over_restarts(spark, tmp_path):
    from datetime import datetime, timedelta

    t0 = datetime(2024, 1, 1)
    source, table, check = (str(tmp_path / n) for n in ("in", "accepted", "state"))

    def arrivals(lo, hi, label, keys):
        return [(k, t0 + timedelta(seconds=k), label, f"{label}{k % keys}") for k in range(lo, hi)]

    def run():
        stream = ingest.landed(spark, source, "arrival_id long, ts timestamp_ntz, label string, content_key string")
        ingest.collect_until_full(stream, table, check, target=5).awaitTermination()
        return spark.read.schema(f"{ingest.ACCEPTED}, {ingest.FILED}").parquet(table)

    land(spark, arrivals(0, 10, "bed", 3) + arrivals(0, 4, "sofa", 10), source)
    assert sorted(r.content_key for r in run().collect()) == ["bed0", "bed1", "bed2", "sofa0", "sofa1", "sofa2", "sofa3"]
    land(spark, arrivals(10, 30, "bed", 20) + arrivals(0, 9, "sofa", 10), source)
    accepted = run()
    keys = [r.content_key for r in accepted.collect()]
    assert len(keys) == len(set(keys)) == 10 and "sofa4" in keys and "sofa5" not in keys
    rows = {r.label: (r["count"], r.gained, r.completed) for r in ingest.progress(accepted, V.classes(spark, ["bed", "sofa", "desk"]), 5).collect()}
    assert rows == {"bed": (5, 2, True), "sofa": (5, 1, True), "desk": (0, 0, False)}
    # a repeated batch replaces its own rows
    before = sorted(keys)
    last = spark.read.schema("arrival_id long, ts timestamp_ntz, label string, content_key string").parquet(source).where("arrival_id >= 10 or label = 'sofa'")
    run_name, batch = accepted.agg(F.max(F.struct("run", "batch")).alias("n")).first()["n"]
    ingest.accept(last, batch, table, 5, run_name)
    assert len(spark.read.parquet(table).collect()) == len(before)
    # a lost checkpoint replays everything: nothing twice, nothing beyond the target
    shutil.rmtree(check)
    assert sorted(r.content_key for r in run().collect()) == before
    land(spark, arrivals(40, 45, "desk", 50), source)
    accepted = run()
    assert sorted(r.content_key for r in accepted.where("label <> 'desk'").collect()) == before
    assert accepted.count() == 15 and accepted.select("content_key").distinct().count() == 15


def test_seen_once_over_restarts(spark, tmp_path):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "state"))

    def run():
        stream = spark.readStream.schema("content_key string, n int").parquet(source)
        q = ingest.seen_once(stream).writeStream.format("parquet").option("path", out).option("checkpointLocation", check).trigger(availableNow=True).start()
        q.awaitTermination()
        return sorted(r.content_key for r in spark.read.schema("content_key string").parquet(out).collect())

    spark.createDataFrame([("a", k) for k in range(500)] + [("b", 1)], "content_key string, n int").write.parquet(source)
    assert run() == ["a", "b"]
    spark.createDataFrame([("a", 7), ("c", 1)], "content_key string, n int").write.mode("append").parquet(source)
    assert run() == ["a", "b", "c"]


def test_only_new_images_are_scored(spark, tmp_path):
    source, cache, boxes, check = (str(tmp_path / n) for n in ("in", "cache", "boxes", "state"))
    schema = "export_stem string, sha1 string, source_class string"
    full = f"image_id long, {schema}"

    def run(rows):
        spark.createDataFrame(rows, full).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(full).parquet(source)
        ingest.detect_new(stream, cache, boxes, check, lambda p: p.select("image_id", F.lit("bed").alias("label")), schema).awaitTermination()
        return sorted(r.image_id for r in spark.read.parquet(boxes).collect())

    assert run([(1, "a", "s1", "bed"), (2, "b", "s2", "bed")]) == [1, 2]
    assert run([(3, "a", "s1", "bed"), (4, "a", "s9", "bed"), (5, "c", "s1", "bed")]) == [1, 2, 4, 5]
    shutil.rmtree(check)  # a lost checkpoint replays everything; the cache still knows it
    assert run([(6, "a", "s1", "bed"), (7, "d", "s7", "bed")]) == [1, 2, 4, 5, 7]
    assert len(spark.read.parquet(cache).collect()) == 5


def test_quota_state_does_not_grow_with_the_stream(spark, tmp_path):
    """Many batches, each reads the one state before it; old states go."""
    from datetime import datetime

    source, table, check = (str(tmp_path / n) for n in ("in", "accepted", "state"))
    sizes = []
    for k in range(6):
        land(spark, [(100 * k + j, datetime(2024, 1, 1), "bed", f"{k}-{j}") for j in range(10)], source)
        stream = ingest.landed(spark, source, "arrival_id long, ts timestamp_ntz, label string, content_key string")
        ingest.collect_until_full(stream, table, check, target=15).awaitTermination()
        filed = ingest._filed(spark, ingest.state_of(table))
        assert len(filed) <= 2
        sizes.append(spark.read.parquet(ingest._folder(ingest.state_of(table), filed[-1])).count())
    assert sizes == [10, 15, 15, 15, 15, 15]
    rows = [tuple(r) for r in ingest.progress_by_batch(spark, table, V.classes(spark, ["bed", "sofa"]), 15).orderBy("step", "label").collect()]
    assert rows[:4] == [(1, 0, "bed", 10, 10, False), (1, 1, "sofa", 0, 0, False), (2, 0, "bed", 15, 5, True), (2, 1, "sofa", 0, 0, False)]
    assert len(rows) == 12 and rows[-2:] == [(6, 0, "bed", 15, 0, True), (6, 1, "sofa", 0, 0, False)]


def dying(monkeypatch, table):
    """The next write to ``table`` fails."""
    real = ingest.write_batch

    def write(df, to, run, batch):
        if to == table:
            monkeypatch.setattr(ingest, "write_batch", real)
            raise RuntimeError("lost between the two writes")
        real(df, to, run, batch)

    monkeypatch.setattr(ingest, "write_batch", write)


@pytest.mark.parametrize("lost", [True, False])
def test_quota_batch_that_died_between_its_writes(spark, tmp_path, monkeypatch, lost):
    from datetime import datetime

    source, table, check = (str(tmp_path / n) for n in ("in", "accepted", "state"))

    def run():
        stream = ingest.landed(spark, source, "arrival_id long, ts timestamp_ntz, label string, content_key string")
        ingest.collect_until_full(stream, table, check, target=5).awaitTermination()

    land(spark, [(k, datetime(2024, 1, 1), "bed", f"k{k}") for k in range(3)], source)
    run()
    land(spark, [(k, datetime(2024, 1, 1), "bed", f"k{k}") for k in range(3, 9)], source)
    dying(monkeypatch, ingest.state_of(table))
    with pytest.raises(Exception):
        run()
    assert spark.read.parquet(table).count() == 5  # the rows stand there, uncommitted
    if lost:
        shutil.rmtree(check)
    run()
    rows = [r.content_key for r in spark.read.parquet(table).collect()]
    assert sorted(rows) == ["k0", "k1", "k2", "k3", "k4"]


@pytest.mark.parametrize("lost", [True, False])
def test_boxes_of_a_batch_that_died_before_its_cache_entry(spark, tmp_path, monkeypatch, lost):
    source, cache, boxes, check = (str(tmp_path / n) for n in ("in", "cache", "boxes", "state"))
    schema = "export_stem string, sha1 string, source_class string"
    full = f"image_id long, {schema}"

    def run(rows):
        if rows:
            spark.createDataFrame(rows, full).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(full).parquet(source)
        ingest.detect_new(stream, cache, boxes, check, lambda p: p.select("image_id", F.lit("bed").alias("label")), schema).awaitTermination()

    run([(1, "a", "s1", "bed")])
    dying(monkeypatch, cache)
    with pytest.raises(Exception):
        run([(2, "b", "s2", "bed"), (3, "a", "s1", "bed")])
    assert spark.read.parquet(boxes).count() == 2
    if lost:
        shutil.rmtree(check)
    run([])
    assert sorted(r.image_id for r in spark.read.parquet(boxes).collect()) == [1, 2]
    assert spark.read.parquet(cache).count() == 2


def exif(value, order="<"):
    mark = b"II" if order == "<" else b"MM"
    return mark + struct.pack(order + "HIHHHIHH", 42, 8, 1, 0x0112, 3, 1, value, 0) + b"\0" * 4


def jpeg(spark, rgb, orientation=None, order="<"):
    """A JPEG as the JVM writes it, with an orientation tag put in front."""
    jvm = spark._jvm
    h, w, _ = rgb.shape
    image = jvm.java.awt.image.BufferedImage(w, h, 1)
    for y in range(h):
        for x in range(w):
            r, g, b = (int(c) for c in rgb[y, x])
            image.setRGB(x, y, r << 16 | g << 8 | b)
    out = jvm.java.io.ByteArrayOutputStream()
    assert jvm.javax.imageio.ImageIO.write(image, "jpg", out)
    data = bytes(out.toByteArray())
    if orientation is None:
        return data
    body = b"Exif\0\0" + exif(orientation, order)
    return data[:2] + b"\xff\xe1" + struct.pack(">H", len(body) + 2) + body + data[2:]


def webp(kind, w, h, more=b""):
    body = {
        b"VP8X": b"\0" * 4 + (w - 1).to_bytes(3, "little") + (h - 1).to_bytes(3, "little"),
        b"VP8L": b"\x2f" + ((w - 1) | (h - 1) << 14).to_bytes(4, "little") + b"\0",
        b"VP8 ": b"\0\0\0\x9d\x01\x2a" + struct.pack("<HH", w, h),
    }[kind]
    chunks = kind + struct.pack("<I", len(body)) + body + more
    return b"RIFF" + struct.pack("<I", len(chunks) + 4) + b"WEBP" + chunks


def test_headers():
    from boxloom.functions.headers import header

    assert header(png(np.zeros((4, 7, 3)))) == (7, 4, 1)
    for kind in (b"VP8X", b"VP8L", b"VP8 "):
        assert header(webp(kind, 320, 200)) == (320, 200, 1)
    tag = exif(6)
    assert header(webp(b"VP8X", 32, 20, b"EXIF" + struct.pack("<I", len(tag)) + tag)) == (32, 20, 6)
    avif = b"\0\0\0\x1cftypavif" + b"\0" * 30 + b"\0\0\0\x14ispe\0\0\0\0" + struct.pack(">II", 64, 48) + b"\0\0\0\x09irot\x01"
    assert header(avif) == (64, 48, 8)
    assert header(b"GIF89a" + struct.pack("<HH", 5, 6)) == (5, 6, 1) and header(b"BM" + b"\0" * 16 + struct.pack("<ii", 3, -4)) == (3, 4, 1)
    for bad in (None, b"", b"RIFF", b"RIFF1234WEBP", b"\xff\xd8\xff\xe1", b"\xff\xd8\xff\xda\0\0", b"not a picture", b"\0\0\0\x1cftypavif"):
        assert header(bad) is None


def test_upright_pictures(spark, tmp_path):
    """All eight orientations have size, hash and thumbnail of the picture as it is meant; webp stays with size and hash."""
    rng = np.random.default_rng(3)
    meant = np.kron(rng.integers(0, 256, (4, 8, 1)).repeat(3, axis=2), np.ones((16, 16, 1))).astype("uint8")
    back = {1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 8, 7: 7, 8: 6}
    for k in range(1, 9):
        stored = pixels.upright(meant, back[k])
        (tmp_path / f"{k}.jpg").write_bytes(jpeg(spark, stored, k, "<>"[k % 2]))
    (tmp_path / "plain.jpg").write_bytes(jpeg(spark, meant))
    (tmp_path / "w.webp").write_bytes(webp(b"VP8L", 30, 20))
    good, skipped = I.quarantine(I.decoded(spark, str(tmp_path)))
    rows = {r.path: r for r in good.collect()}
    assert skipped.count() == 0 and len(rows) == 10
    plain = rows["plain.jpg"]
    for k in range(1, 9):
        r = rows[f"{k}.jpg"]
        assert (r.width, r.height, r.orientation) == (128, 64, k) and r.ahash == plain.ahash
        assert np.abs(np.array(r.vector) - np.array(plain.vector)).max() < 0.01
    w = rows["w.webp"]
    assert (w.width, w.height, w.white) == (30, 20, None) and w.sha1 == hashlib.sha1((tmp_path / "w.webp").read_bytes()).hexdigest()


def test_pixels_of_a_byte_column(spark, folder, tmp_path):
    """A table of bytes gives the same pixel facts as the folder; every row filter of PNG; what cannot be read is null."""
    from boxloom.functions import bitmaps

    rng = np.random.default_rng(4)
    rgb = rng.integers(0, 256, (9, 13, 3)).astype("uint8")
    assert bitmaps.decode(png(rgb)) == (9, 13, 3, rgb[:, :, ::-1].tobytes())
    line = b"".join(bytes([0]) + r.tobytes() for r in rgb)
    assert bitmaps.decode(png(rgb)[:-30]) is None and bitmaps.decode(b"BM") is None and bitmaps.decode(None) is None and len(line) == 9 * 40
    for filtered in range(5):  # written with one filter, by the rules of the format
        rows, above = b"", np.zeros(39, int)
        for r in rgb.reshape(9, 39).astype(int):
            left, corner = np.r_[0, 0, 0, r[:-3]], np.r_[0, 0, 0, above[:-3]]
            near = left + above - corner
            a, b, c = abs(near - left), abs(near - above), abs(near - corner)
            guess = [0 * r, left, above, (left + above) // 2, np.where((a <= b) & (a <= c), left, np.where(b <= c, above, corner))][filtered]
            rows, above = rows + bytes([filtered]) + ((r - guess) % 256).astype("uint8").tobytes(), r
        head = png(rgb)[:33]
        body = zlib.compress(rows)
        data = head + struct.pack(">I", len(body)) + b"IDAT" + body + b"\0" * 4 + b"\0\0\0\0IEND\0\0\0\0"
        assert bitmaps.decode(data) == (9, 13, 3, rgb[:, :, ::-1].tobytes())
    wide = np.zeros((9, 40), "uint8")
    wide[:, :39] = rgb[::-1, :, ::-1].reshape(9, 39)
    bmp = b"BM" + struct.pack("<IHHI", 0, 0, 0, 54) + struct.pack("<IiiHHIIiiII", 40, 13, 9, 1, 24, 0, 0, 0, 0, 0, 0) + wide.tobytes()
    assert bitmaps.decode(bmp) == bitmaps.decode(png(rgb))

    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.{png,PNG,jpg}").load(folder)
    seen = raw.select(F.element_at(F.split("path", "/"), -1).alias("name"), bitmaps.image("content").alias("image"))
    got = {r.name: r for r in seen.select("name", pixels.signature(F.col("image")).alias("signature"), pixels.features(F.col("image")).alias("f")).collect()}
    for r in I.decoded(spark, folder).where("width > 0").collect():
        one = got[r.path.split("/")[-1].replace(" ", "%20")] if r.path.split("/")[-1].replace(" ", "%20") in got else got[r.path.split("/")[-1]]
        assert (one.signature, one.f.ahash, one.f.white, one.f.red_std) == (r.signature, r.ahash, r.white, r.red_std)
    assert got["broken.jpg"].signature is None and got["broken.jpg"].f.ahash is None


def test_detection_cache_grows_and_is_read_back(spark, tmp_path):
    """Entries written in two goes; only images whose stem, SHA-1 and class all agree count as done."""
    from boxloom.operators import manifests

    path, schema = str(tmp_path / "cache"), "export_stem string, sha1 string, source_class string, flags string"
    sinks.write_cache(spark.createDataFrame([("a", "1", "bed", "")], schema), path)
    sinks.write_cache(spark.createDataFrame([("b", "2", "bed", "dark"), ("a", "1", "bed", "")], schema), path)
    cache = spark.read.schema(schema).parquet(path)
    images = spark.createDataFrame([(1, "a", "1", "bed"), (2, "b", "2", "sofa"), (3, "b", "9", "bed"), (4, "b", "2", "bed")],
                                   "image_id int, export_stem string, sha1 string, source_class string")
    cached, pending = manifests.split_cache(images, cache)
    assert sorted(r.image_id for r in cached.collect()) == [1, 4] and sorted(r.image_id for r in pending.collect()) == [2, 3]
