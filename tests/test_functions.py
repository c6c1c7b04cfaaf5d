import numpy as np
import pytest
from pyspark.sql import functions as F

from lumagrid import checks
from lumagrid.functions import gray as G
from lumagrid.functions import histograms as H
from lumagrid.functions import text as X


def test_luma_truncates_in_doubles(spark):
    v = spark.range(256).select(F.col("id").cast("int").alias("v"))
    got = {r.v: r.g for r in v.select("v", G.luma(F.col("v"), F.col("v"), F.col("v")).alias("g")).collect()}
    want = {k: int(0.299 * k + 0.587 * k + 0.114 * k) for k in range(256)}
    assert got == want
    assert sum(got[k] != k for k in got) == 65


def test_unpack_rgb(spark):
    r, g, b = G.unpack_rgb(F.col("c"))
    row = spark.createDataFrame([(0x0A0BFF,)], "c int").select(r.alias("r"), g.alias("g"), b.alias("b")).first()
    assert tuple(row) == (10, 11, 255)


def test_one_channel_samples_go_through_srgb():
    table = G.srgb_of_linear()
    assert [int(table[v]) for v in (0, 1, 50, 128, 200, 255)] == [0, 13, 122, 188, 229, 255]


def test_one_channel_modes(spark):
    df = spark.createDataFrame([(50,)], "v int")
    shown = int(0.299 * 122 + 0.587 * 122 + 0.114 * 122)
    assert df.select(G.one_channel_gray(F.col("v"))).first()[0] == shown
    assert df.select(G.one_channel_gray(F.col("v"), "raw")).first()[0] == 50
    with pytest.raises(ValueError):
        G.one_channel_gray(F.col("v"), "other")


@pytest.mark.parametrize(
    "csv, trim, want",
    [
        (",".join(map(str, range(256))), True, list(range(256))),
        ("1,2,3", True, [1, 2, 3] + [0] * 253),
        (",".join(["7"] * 300), True, [7] * 256),
        (" 1 , 2", True, [1, 2] + [0] * 254),
        (" 1 , 2", False, None),
        ("1,x,3", True, None),
        ("1,,3", True, None),
        ("1,2,,", True, [1, 2] + [0] * 254),
        (",,", True, [0] * 256),
        ("", True, None),
        (None, True, None),
        ("+5,-3", True, [5, -3] + [0] * 254),
        ("99999999999", True, None),
        ("1.5", True, None),
        (",".join(["7"] * 256 + ["bad"]), True, [7] * 256),
    ],
)
def test_csv_to_histogram(spark, csv, trim, want):
    df = spark.createDataFrame([(csv,)], "csv string")
    assert df.select(H.from_csv(F.col("csv"), trim)).first()[0] == want


def test_similarity_of_histograms(spark):
    z = [0] * 256
    a, b = z.copy(), z.copy()
    a[3], b[3], b[9] = 4, 2, 6
    rows = [(a, a), (a, b), (a, z), (z, z), (b, a)]
    df = spark.createDataFrame(rows, "a array<bigint>, b array<bigint>")
    got = [r[0] for r in df.select(H.similarity(F.col("a"), F.col("b"))).collect()]
    assert got == [1.0, 2 / 10, 0.0, 0.0, 2 / 10]


def test_texts(spark):
    df = spark.createDataFrame([("a" * 100,), ("b" * 101,)], "t string")
    short, long = [r[0] for r in df.select(X.preview(F.col("t"))).collect()]
    assert short == "a" * 100 and long == "b" * 100 + "..."
    one = spark.range(1)
    name = F.lit("p.png")
    keys = one.select(X.search_key(name), X.local_key(name, F.lit(0.95)), X.tamper_key(name, F.lit(20)))
    assert tuple(keys.first()) == ("SEARCH_p.png", "LOCAL_p.png_0.95", "TAMPER_p.png_20")
    assert one.select(X.percent(F.lit(0.98765))).first()[0] == "98.77%"
    assert one.select(X.file_name(F.lit("file:/a/b/c.png"))).first()[0] == "c.png"


def test_detail_text(spark):
    df = spark.createDataFrame([("n", 2, 1, [1, 1] + [0] * 254)], "n string, w int, h int, hist array<int>")
    detail = df.select(H.detail_text(F.col("n"), F.col("w"), F.col("h"), F.col("hist"))).first()[0]
    assert detail.split("\n")[:2] == ["Filename:n", "Size:2x1"]
    assert detail.split("\n")[2].startswith("Histogram:1,1,0,")


def test_argument_checks(spark):
    for bad in (-0.1, 1.1):
        with pytest.raises(ValueError):
            checks.share(bad)
    for bad in (-1, 256):
        with pytest.raises(ValueError):
            checks.gray_step(bad)
    with pytest.raises(ValueError):
        checks.count_of(0)
    with pytest.raises(ValueError):
        checks.not_empty(spark.createDataFrame([], "image_id bigint"))
    assert np.isclose(checks.share(0.95), 0.95)
