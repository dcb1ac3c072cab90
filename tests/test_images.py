import numpy as np
import pandas as pd
import pytest

from invoicelake.operators import images
from invoicelake.plans.flow import Lake
from invoicelake.sources import files
from invoicelake.streaming.ingest import ingest_available
from tests.pictures import png


def text_page(angle=0.0, size=400):
    """Dark lines on paper, turned by ``angle`` degrees."""
    y, x = np.mgrid[0:size, 0:size].astype(float) - size / 2
    a = np.deg2rad(angle)
    row = -x * np.sin(a) + y * np.cos(a)
    column = x * np.cos(a) + y * np.sin(a)
    ink = (np.mod(row, 24) < 8) & (np.abs(row) < 150) & (np.abs(column) < 150)
    return np.where(ink, 20, 235).astype(np.uint8)


def test_gray_and_stretch():
    bgr = np.array([[[10, 20, 30], [255, 255, 255]]], dtype=np.uint8)
    assert images.gray(bgr).tolist() == [[22, 255]]          # 1.14 + 11.74 + 8.97 = 21.85
    assert images.stretch(np.array([[50, 100, 150]], dtype=np.uint8)).tolist() == [[0, 128, 255]]
    assert images.stretch(np.full((2, 2), 9, dtype=np.uint8)).tolist() == [[0, 0], [0, 0]]


def test_blur_score_by_hand():
    image = np.zeros((3, 3), dtype=np.uint8)
    image[1, 1] = 10
    # mirrored borders: edge middles see the centre twice
    want = np.array([[0, 20, 0], [20, -40, 20], [0, 20, 0]], dtype=float)
    assert images.blur_score(image) == pytest.approx(want.var())
    assert images.blur_score(np.full((5, 5), 7, dtype=np.uint8)) == 0


def test_otsu_splits_two_levels():
    image = np.array([[10] * 6 + [200] * 4], dtype=np.uint8)
    assert 10 <= images.otsu(image) < 200


@pytest.mark.parametrize("angle", [-7.0, -2.5, 0.0, 3.5, 8.0])
def test_skew_of_planted_angle(angle):
    found = images.skew_angle(text_page(angle))
    assert abs(found - angle) <= 0.5 or abs(found + angle) <= 0.5
    if angle:
        assert images.skew_angle(text_page(-angle)) * found < 0


def test_box_and_features():
    page = np.full((300, 200), 255, dtype=np.uint8)
    page[100:120, 90:110] = 0
    assert images.content_box(page) == (50, 60, 149, 159)
    assert images.content_box(np.full((10, 20), 255, dtype=np.uint8)) == (0, 0, 20, 10)
    assert images.pooled(np.zeros((64, 64), dtype=np.uint8)).tolist() == [1.0] * 1024
    half = np.zeros((256, 256), dtype=np.uint8)
    half[:, 128:] = 255
    assert images.pooled(half).reshape(32, 32)[:, :16].min() == 1.0 and images.pooled(half).reshape(32, 32)[:, 16:].max() == 0.0
    odd = images.shrink(np.arange(15, dtype=np.uint8).reshape(3, 5), 2, 2)
    assert odd.mean() == pytest.approx(7.0)                  # resizing by area keeps the mean


def test_job_on_files(spark, tmp_path):
    (tmp_path / "g.png").write_bytes(png(text_page(3.0)))
    colour = np.stack([text_page()] * 3, axis=2)
    (tmp_path / "c.png").write_bytes(png(colour))
    (tmp_path / "bad.png").write_bytes(b"no picture")
    rows = files.read_images(spark, str(tmp_path))
    rows = rows.withColumn("doc_id", files.file_name_of("path"))
    assert {r.doc_id: r.channels for r in rows.collect()} == {"g.png": 1, "c.png": 3, "bad.png": None}
    registry = spark.createDataFrame([("g.png", "INGESTED"), ("c.png", "INGESTED"), ("bad.png", "INGESTED"), ("x", "INGESTED")],
                                     "doc_id string, status string")
    done = spark.createDataFrame([("c.png",)], "doc_id string")
    good, failed = images.quality_job(registry, rows, done)
    assert [r.doc_id for r in failed.collect()] == ["bad.png"]
    r = good.collect()
    assert [x.doc_id for x in r] == ["g.png"]
    assert r[0].blur_score == pytest.approx(images.blur_score(text_page(3.0)))
    assert abs(abs(r[0].skew_angle) - 3.0) <= 0.5
    features = images.measure(rows.filter("doc_id = 'c.png'")).first().features
    assert np.allclose(features, images.pooled(text_page()))


def test_stream_registers_new_files_only(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "a.png").write_bytes(b"1")
    (raw / "b.png").write_bytes(b"1")
    lake = Lake(spark, str(tmp_path / "lake"))
    ingest_available(lake, str(raw)).awaitTermination(60)
    (raw / "c.png").write_bytes(b"2")
    ingest_available(lake, str(raw)).awaitTermination(60)
    got = {r.file_name: r.status for r in lake.table("bronze/documents").read().collect()}
    assert got == {"a.png": "INGESTED", "b.png": "DUPLICATE_EXACT", "c.png": "INGESTED"}
    assert sorted(bytes(r.content) for r in spark.read.parquet(f"{lake.root}/landing").collect()) == [b"1", b"2"]


def test_results_are_held_for_few_pictures_at_once():
    frames = [pd.DataFrame({"n": range(k)}) for k in (0, 3, images.AT_ONCE, 2 * images.AT_ONCE + 1)]
    slices = list(images._slices(iter(frames)))
    assert max(map(len, slices)) == images.AT_ONCE
    assert [n for s in slices for n in s["n"]] == [n for f in frames for n in f["n"]]
