import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from lumagrid.functions.gray import srgb_of_linear
from lumagrid.operators import tamper
from lumagrid.plans import jobs
from lumagrid.sources import files, table
from lumagrid.streaming.ingest import ingest_stream


def png(array: np.ndarray) -> bytes:
    """A one- or three-channel 8-bit PNG, written with the standard library."""
    h, w = array.shape[:2]
    colour = 2 if array.ndim == 3 else 0

    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    lines = b"".join(b"\0" + array[y].astype(np.uint8).tobytes() for y in range(h))
    head = struct.pack(">IIBBBBB", w, h, 8, colour, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b"")


RAMP = np.arange(256).reshape(16, 16)


def luma(v):
    return (0.299 * v + 0.587 * v + 0.114 * v).astype(int)


@pytest.fixture()
def folder(tmp_path):
    (tmp_path / "gray.png").write_bytes(png(RAMP))
    (tmp_path / "rgb.png").write_bytes(png(np.dstack([RAMP] * 3)))
    (tmp_path / "UP.PNG").write_bytes(png(RAMP))
    (tmp_path / "bad.jpg").write_bytes(b"not an image")
    (tmp_path / "note.txt").write_text("text")
    (tmp_path / "deeper").mkdir()
    (tmp_path / "deeper" / "inner.png").write_bytes(png(RAMP))
    return str(tmp_path)


def grays(df):
    return {r.image_id: np.frombuffer(bytes(r.gray), np.uint8).astype(int) for r in df.collect()}


def test_scan_takes_one_level_and_any_case(spark, folder):
    scanned = files.scan_images(spark, folder)
    names = {r.image_id: (r.width, r.height) for r in scanned.collect()}
    assert names == {"gray.png": (16, 16), "rgb.png": (16, 16), "UP.PNG": (16, 16), "bad.jpg": (-1, -1)}
    assert rows_of(files.rejects(scanned)) == [("bad.jpg",)]


def test_missing_folder_is_empty(spark, tmp_path):
    assert files.scan_images(spark, str(tmp_path / "none")).count() == 0


def test_gray_values(spark, folder):
    shown = grays(files.gray_images(files.scan_images(spark, folder)))
    assert set(shown) == {"gray.png", "rgb.png", "UP.PNG"}
    assert (shown["rgb.png"] == luma(RAMP.ravel())).all()
    assert (shown["gray.png"] == luma(srgb_of_linear())).all()
    raw = grays(files.gray_images(files.scan_images(spark, folder), "raw"))
    assert (raw["UP.PNG"] == RAMP.ravel()).all() and (raw["rgb.png"] == luma(RAMP.ravel())).all()
    with pytest.raises(ValueError):
        files.gray_images(files.scan_images(spark, folder), "other")


def test_bitmaps_written_by_spark_are_read_back(spark, tmp_path, rng):
    values = {i: rng.integers(0, 256, 15).tolist() for i in range(5)}
    df = spark.createDataFrame(list(values.items()), "id bigint, v array<int>")
    out = str(tmp_path / "bitmaps")
    name = F.concat(F.col("id").cast("string"), F.lit(".bmp"))
    files.write_files(df.select(name.alias("name"), files.bitmap(5, 3, F.col("v")).alias("content")), out)
    got = grays(files.gray_images(files.scan_images(spark, out)))
    assert {k: v.tolist() for k, v in got.items()} == {
        f"{i}.bmp": luma(np.array(v)).tolist() for i, v in values.items()
    }


def test_packed_files_and_histogram_text(spark, pack, tmp_path, rng):
    images = pack({i: rng.integers(0, 256, (3, 4)) for i in range(20)})
    files.write_packed(images, str(tmp_path / "packed"), 2)
    back = files.read_packed(spark, str(tmp_path / "packed"))
    assert rows_of(back.select("image_id", F.hex("gray"))) == rows_of(images.select("image_id", F.hex("gray")))
    library = jobs.generate_histograms(images)
    files.write_hist_text(library, str(tmp_path / "text"))
    text = files.read_hist_text(spark, str(tmp_path / "text"))
    assert rows_of(text.select(F.col("name").cast("bigint"), F.to_json("hist"))) == rows_of(
        library.select("image_id", F.to_json("hist"))
    )


def test_sequence_files(spark, tmp_path):
    pairs = spark.sparkContext.parallelize([("a.jpg", bytearray(b"\x01\x02")), ("b.jpg", bytearray(b""))])
    pairs.saveAsSequenceFile(str(tmp_path / "seq"))
    got = files.read_sequence_files(spark, str(tmp_path / "seq"))
    assert sorted((r.name, bytes(r.content)) for r in got.collect()) == [("a.jpg", b"\x01\x02"), ("b.jpg", b"")]


def test_arriving_files_reach_the_table(spark, folder, tmp_path_factory):
    where, progress = (str(tmp_path_factory.mktemp(n)) + "/x" for n in ("table", "progress"))

    def run():
        images = files.gray_images(files.stream_images(spark, folder))
        ingest_stream(images, where, progress, 2).awaitTermination()
        return rows_of(table.scan(spark, where).select("image_id", "width"))

    names = ["UP.PNG", "gray.png", "rgb.png"]
    assert run() == [(n, 16) for n in names]
    with open(f"{folder}/new.png", "wb") as sink:
        sink.write(png(RAMP[:, :4]))
    assert run() == [("UP.PNG", 16), ("gray.png", 16), ("new.png", 4), ("rgb.png", 16)]
    got = table.get(spark, where, "rgb.png").first()
    assert (np.frombuffer(bytes(got.gray), np.uint8) == luma(RAMP.ravel())).all()
    assert got.hist == np.bincount(luma(RAMP.ravel()), minlength=256).tolist()


def test_export(spark, pack, tmp_path):
    verdicts = tamper.detect(pack({1: np.zeros((16, 16))}), pack({2: np.full((16, 16), 99)}, "suspect_id"))
    files.export_results(verdicts, str(tmp_path / "json"))
    back = spark.read.schema(verdicts.schema).json(str(tmp_path / "json"))
    assert back.collect() == verdicts.collect()
    files.export_results(tamper.ranking(verdicts), str(tmp_path / "csv"), "csv")
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 1
    files.write_results_text(verdicts.select("image_id", "matching_pixels"), str(tmp_path / "tsv"))
    assert spark.read.text(str(tmp_path / "tsv")).first()[0] == "1\t0"
    with pytest.raises(ValueError):
        files.export_results(verdicts, str(tmp_path / "x"), "xml")
