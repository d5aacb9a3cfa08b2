import os

import numpy as np
import pytest
from conftest import write_png
from pyspark.sql import functions as F

from featureflow.operators import images as I
from featureflow.operators import inference


def test_crop_kernels():
    a = np.arange(8 * 10 * 3, dtype=np.uint8).reshape(8, 10, 3)
    assert I.crop_xyxy(a, (2, 1, 5, 4)).shape == (3, 3, 3)
    assert np.array_equal(I.crop_xyxy(a, (-3, -1, 100, 3)), a[0:3, 0:10])
    with pytest.raises(I.StageError):
        I.crop_xyxy(a, (5, 1, 5, 4))
    c = I.crop_xywh(a, (-1, -2, 4, 5))
    assert c.shape == (5, 4, 3)
    assert (c[:2] == 0).all() and (c[:, 0] == 0).all()
    assert np.array_equal(c[2:, 1:], a[0:3, 0:3])


def test_resize_kernels():
    a = np.arange(16, dtype=np.float32).reshape(4, 4, 1)
    n = I.resize_nearest(a, (2, 2))
    assert n[:, :, 0].tolist() == [[5.0, 7.0], [13.0, 15.0]]
    up = I.resize_nearest(a, (8, 8))
    assert np.array_equal(up[::2, ::2], a)
    b = I.resize_bilinear(a, (2, 2))
    assert np.allclose(b[:, :, 0], [[2.5, 4.5], [10.5, 12.5]])
    u8 = I.resize_bilinear(np.array([[[0], [255]]], dtype=np.uint8), (1, 4))
    assert u8.dtype == np.uint8 and u8[0, :, 0].tolist() == [0, 64, 191, 255]


def resampled_by_hand(a, size, method):
    """Pixel by pixel: exact fractions would round alike, as no product is a tie."""
    def kernel(x):
        x = abs(x)
        if method == "triangle":
            return max(1 - x, 0.0)
        if x < 1:
            return 1.5 * x ** 3 - 2.5 * x ** 2 + 1
        return -0.5 * x ** 3 + 2.5 * x ** 2 - 4 * x + 2 if x < 2 else 0.0

    reach = {"triangle": 1, "bicubic": 2}[method]

    def one_axis(line, n):
        wide, out = max(len(line) / n, 1), []
        for i in range(n):
            mid = (i + 0.5) * len(line) / n
            lo, hi = max(int(mid - reach * wide + 0.5), 0), min(int(mid + reach * wide + 0.5), len(line))
            w = [kernel((p + 0.5 - mid) / wide) for p in range(lo, hi)]
            v = sum(x * y for x, y in zip(w, line[lo:hi])) / sum(w)
            out.append(min(max(int(np.floor(v + 0.5)), 0), 255))
        return out

    rows = [one_axis(r, size[1]) for r in a.tolist()]
    return np.array([one_axis(c, size[0]) for c in zip(*rows)]).T


@pytest.mark.parametrize("method", ["triangle", "bicubic"])
def test_resample_kernels(method):
    rng = np.random.default_rng(3)
    for shape, size in [((8, 8), (3, 12)), ((31, 17), (7, 5)), ((5, 40), (11, 9)), ((1, 6), (4, 1)), ((3, 3), (3, 3))]:
        a = rng.integers(0, 256, shape).astype(np.uint8)
        got = I.resample(a[..., None], size, method)
        assert got.dtype == np.uint8 and got.shape == (*size, 1)
        off = got[..., 0].astype(int) - resampled_by_hand(a, size, method)
        assert np.abs(off).max() <= 1 and (off != 0).mean() < 0.02  # whole-number weights
        f = I.resample(a.astype(np.float32)[..., None], size, method)
        assert f.dtype == np.float32 and np.allclose(I.resample(np.full((*shape, 3), 7, np.float32), size, method), 7)
    flat = np.full((9, 30, 3), 200, np.uint8)
    assert (I.resample(flat, (4, 50), method) == 200).all()


def test_gray_and_blocks():
    bgr = np.zeros((2, 2, 3), dtype=np.uint8)
    bgr[..., 2] = 200  # red
    g = I.gray(bgr, 3)
    assert g.shape == (2, 2, 3) and int(g[0, 0, 0]) == int(np.floor(0.299 * 200 + 0.5))
    m = I.block_means(np.arange(16, dtype=np.float32).reshape(4, 4, 1), 2)
    assert m.tolist() == [2.5, 4.5, 10.5, 12.5]


@pytest.fixture()
def picture_dir(tmp):
    rng = np.random.default_rng(1)
    root = os.path.join(tmp, "images")
    write_png(os.path.join(root, "Ann_Example", "12.png"), rng.integers(0, 255, (20, 30, 3)))
    write_png(os.path.join(root, "Ann_Example", "13.png"), rng.integers(0, 255, (16, 16)))
    write_png(os.path.join(root, "Bob", "7.png"), rng.integers(0, 255, (10, 12, 3)))
    os.makedirs(os.path.join(root, "Empty"), exist_ok=True)
    with open(os.path.join(root, "Bob", "8.png"), "wb") as f:
        f.write(b"not a picture")
    write_png(os.path.join(root, "Bob", ".hidden.png"), rng.integers(0, 255, (4, 4, 3)))
    return root


def test_read_and_transform_pictures(spark, picture_dir):
    from featureflow.sources.images import list_images, read_images

    listing = list_images(spark, picture_dir)
    assert sorted((r.person, r.image_id) for r in listing.collect()) == [
        ("Ann_Example", 12), ("Ann_Example", 13), ("Bob", 7), ("Bob", 8)]
    pics = read_images(spark, picture_dir)
    st = {(r.person, r.image_id): r.status for r in pics.collect()}
    assert st[("Bob", 8)] == "undecodable" and st[("Bob", 7)] == "ok"
    boxed = pics.withColumn("bbox_coords", F.array(F.lit(1), F.lit(1), F.lit(9), F.lit(8)))
    out = I.resize(I.crop(boxed, "bbox_coords", "xyxy"), 4, "bilinear")
    rows = {(r.person, r.image_id): r for r in out.collect()}
    assert rows[("Ann_Example", 12)].image.height == 4 and rows[("Ann_Example", 12)].image.nChannels == 3
    assert rows[("Bob", 8)].image is None and rows[("Bob", 8)].status == "undecodable"
    grey = I.to_gray(out, 3)
    px = I.to_pixels(grey).collect()
    assert all(r.pixels is None or len(r.pixels) == 4 * 4 * 3 for r in px)


def test_crop_resize_fused_equals_chain(spark, picture_dir):
    from featureflow.sources.images import read_images

    pics = read_images(spark, picture_dir)
    box = F.when(F.col("image_id") == 13, F.lit(None).cast("array<int>")).otherwise(
        F.array(F.lit(1), F.lit(2), F.lit(9), F.lit(7)))
    boxed = pics.withColumn("bbox_coords", box)
    for gray_channels in (None, 3):
        chain = I.resize(I.crop(boxed, "bbox_coords", "xyxy"), (5, 3), "bilinear")
        if gray_channels:
            chain = I.to_gray(chain, gray_channels)
        fused = I.crop_resize(boxed, "bbox_coords", "xyxy", (5, 3), "bilinear", gray_channels)
        a = {(r.person, r.image_id): (r.status, r.image) for r in chain.collect()}
        b = {(r.person, r.image_id): (r.status, r.image) for r in fused.collect()}
        assert a == b
        assert b[("Ann_Example", 13)][0] == "bad_bbox" and b[("Bob", 8)][0] == "undecodable"
    plan = I.crop_resize(boxed)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInPandas") == 1


def test_crop_matches_numpy_on_decoded_png(spark, picture_dir):
    from featureflow.sources.images import read_images

    pics = read_images(spark, picture_dir).filter("person = 'Bob' AND image_id = 7")
    raw = I.to_pixels(pics).first()
    arr = np.asarray(raw.pixels, dtype=np.float32).reshape(10, 12, 3)
    boxed = pics.withColumn("bbox_coords", F.array(F.lit(-2), F.lit(3), F.lit(5), F.lit(4)))
    got = I.to_pixels(I.crop(boxed, "bbox_coords", "xywh")).first()
    assert np.array_equal(np.asarray(got.pixels).reshape(4, 5, 3), I.crop_xywh(arr, (-2, 3, 5, 4)))


def test_features_and_labeller(spark, picture_dir):
    from featureflow.sources.images import read_images

    pics = read_images(spark, picture_dir).withColumn("bbox_coords", F.array(*[F.lit(v) for v in (0, 0, 8, 8)]))
    feats = inference.image_features(pics, size=8, method="nearest").collect()
    ok = [r for r in feats if r.status == "ok"]
    assert len(ok) == 3 and all(len(r.features) == 4 * 4 * r_c + 16 for r, r_c in
                                ((r, 3 if r.person == "Bob" or r.image_id == 12 else 1) for r in ok))

    def make_labeller():
        def label(arrays):
            if any(a.shape[2] == 1 for a in arrays):
                raise RuntimeError("grey picture")
            return ["happy" if a.mean() > 120 else "sad" for a in arrays]
        return label

    lab = {(r.person, r.image_id): (r.emotion, r.error) for r in inference.label_images(pics, make_labeller).collect()}
    assert lab[("Ann_Example", 13)][0] is None and "grey" in lab[("Ann_Example", 13)][1]
    assert lab[("Bob", 7)][0] in {"happy", "sad"} and lab[("Bob", 7)][1] is None
    assert lab[("Bob", 8)] == (None, "undecodable")


def test_predict_batch_extractor(spark):
    emb = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    out = inference.extract_features(emb, inference.block_mean_predict_fn(2), "embedding", (8, 8, 1), batch_size=50)
    row = out.orderBy("vec_id").first()
    a = np.asarray(row.embedding, np.float64).reshape(8, 8, 1)
    assert np.allclose(row.features, I.block_means(a, 2), atol=1e-6)


def test_binary_rows_and_vectors_to_images(spark):
    from featureflow.operators.arrow import binary_rows

    valid = np.array([True, False, True])
    rows = np.array([[1, 2], [3, 4]], dtype="<f4")
    out = binary_rows(valid, rows)
    assert out.to_pylist() == [rows[0].tobytes(), None, rows[1].tobytes()]
    df = spark.createDataFrame([(1, [float(i) for i in range(6)]), (2, None), (3, [1.0, 2.0])],
                               "id int, v array<float>")
    imgs = {r.id: r.image for r in I.vectors_to_images(df, "v", 2, 3).collect()}
    assert np.frombuffer(imgs[1].data, dtype="<f4").tolist() == [0.0, 1.0, 2.0, 3.0, 4.0, 5.0]
    assert imgs[2].data is None and imgs[3].data is None


def _pictures(spark, n, parts):
    df = spark.range(n, numPartitions=parts).select(
        F.col("id"), F.transform(F.sequence(F.lit(0), F.lit(15)), lambda i: ((F.col("id") + i) % 7).cast("float")).alias("v"))
    return I.vectors_to_images(df, "v", 4, 4).select("id", "image")


def _count_builds(folder, fn):
    """A model factory that leaves a file for each time it is called."""
    def make():
        import os
        import uuid

        open(os.path.join(folder, f"{os.getpid()}-{uuid.uuid4().hex}"), "w").close()
        return fn
    return make


def test_batch_model_is_built_once_a_worker(spark, tmp):
    import os

    pics = _pictures(spark, 320, 16)
    make = _count_builds(tmp, lambda batch: batch.reshape(len(batch), -1)[:, :2])
    feats = inference.image_features(pics, None, size=4, method="nearest", make_predict_fn=make, batch_size=7)
    for _ in range(2):
        assert sorted((r.id, r.status, r.features) for r in feats.collect())[3] == (3, "ok", [3.0, 4.0])
    builds = os.listdir(tmp)
    assert len(builds) == len({b.split("-")[0] for b in builds})


def test_batch_model_failures_stay_with_their_pictures(spark):
    def make():
        def model(batch):
            if (batch[:, 0, 0, 0] == 5).any():
                raise ValueError("a five: " + "x" * 600)
            return batch.reshape(len(batch), -1)[:, :1]
        return model

    rows = inference.image_features(_pictures(spark, 70, 3), None, size=4, method="nearest", make_predict_fn=make).collect()
    assert all((r.features is None) == (r.id % 7 == 5) for r in rows)
    assert {r.status for r in rows if r.id % 7 == 5} == {"error: ValueError: a five: " + "x" * 600}


def test_labeller_once_a_worker_and_whole_outcomes(spark, tmp):
    import os

    def label(arrays):
        got = ["happy" if a.ravel()[0] < 3 else None for a in arrays]
        return got[:-1] if len(got) > 4 else got  # too few for a batch
    out = inference.label_images(_pictures(spark, 200, 16), _count_builds(tmp, label))
    for _ in range(2):
        rows = out.collect()
        assert len(rows) == 200 and all((r.emotion is None) != (r.error is None) for r in rows)
        assert all((r.emotion == "happy") == (r.id % 7 < 3) for r in rows)
    builds = os.listdir(tmp)
    assert len(builds) == len({b.split("-")[0] for b in builds})
