"""SAS transport files: numbers, layout, ranges, cut files, and the data source."""

import math
import os
import random
import struct

import numpy as np
import pandas as pd
import pytest
from cohortlab.sources import xport
from cohortlab.sources.tables import load_module
from pyspark.errors import PySparkException
from pyspark.sql import functions as F


def exact(raw: bytes) -> float:
    """A base-16 number by its definition, in whole numbers."""
    bits = int.from_bytes(raw.ljust(8, b"\0"), "big")
    value = (bits & (1 << 56) - 1) * 16.0 ** ((bits >> 56 & 127) - 64 - 14)
    return -value if bits >> 63 else value


def test_numbers_come_back_equal():
    rng = random.Random(1)
    values = [0.0, 1.0, -1.0, 0.1, -118.625, 15.999999999999998, 16.0, 1 / 3, 2.0 ** 53, 16.0 ** 62, 16.0 ** -64, 5e-78]
    values += [rng.uniform(-1, 1) * 10.0 ** rng.randrange(-70, 70) for _ in range(3000)]
    x = np.array(values)
    raw = xport.encode_numbers(x, np.zeros(len(x), bool))
    assert [exact(r.tobytes()) for r in raw[:400]] == values[:400]
    back, missing = xport.decode_numbers(raw)
    assert (back == x).all() and not missing.any()
    assert raw[1].tobytes() == b"\x41\x10\0\0\0\0\0\0" and raw[4].tobytes() == b"\xc2\x76\xa0\0\0\0\0\0"  # 1, -118.625


def test_numbers_beyond_the_range():
    none = np.zeros(1, bool)
    for bad in (16.0 ** 63, -1e300, math.inf):
        with pytest.raises(ValueError, match="large|infinite"):
            xport.encode_numbers(np.array([bad]), none)
    for tiny in (1e-80, -3e-85, 5e-324):  # digits are lost, never the size
        back, _ = xport.decode_numbers(xport.encode_numbers(np.array([tiny]), none))
        assert abs(back[0] - tiny) <= 16.0 ** -78


def test_missing_codes_and_short_numbers():
    codes = [bytes([c]).ljust(8, b"\0") for c in b"._AZMB"]
    _, missing = xport.decode_numbers(np.frombuffer(b"".join(codes), np.uint8).reshape(-1, 8))
    assert missing.all()
    values, missing = xport.decode_numbers(np.frombuffer(b"\x41\x18\x42\x64\x00\x00", np.uint8).reshape(-1, 2))
    assert values.tolist() == [1.5, 100.0, 0.0] and missing.tolist() == [False, False, False]
    # 'A' with digits behind it is a number (the byte is an exponent like any other)
    values, missing = xport.decode_numbers(np.frombuffer(b"A\x10\0", np.uint8).reshape(1, 3))
    assert values[0] == 1.0 and not missing[0]


COLUMNS = [xport.Variable("ID", True, 8, 0), xport.Variable("TXT", False, 5, 8), xport.Variable("VAL", True, 8, 13)]


def hand_file(path, rows, columns=COLUMNS, fill=True):
    """A file put together by hand: numbers by ``struct``-free arithmetic, text padded."""
    def number(v):
        if v is None:
            return b".".ljust(8, b"\0")
        if v == 0:
            return bytes(8)
        sign, v, e = (128, -v, 64) if v < 0 else (0, v, 64)
        while v >= 1:
            v, e = v / 16, e + 1
        while v < 1 / 16:
            v, e = v * 16, e - 1
        return bytes([sign + e]) + struct.pack(">Q", int(v * 2 ** 56))[1:]

    body = b"".join(b"".join(number(x) if c.numeric else (x or "").encode().ljust(c.width)
                             for c, x in zip(columns, r, strict=True)) for r in rows)
    data = xport.write_layout(columns, "HAND") + body
    path.write_bytes(data + b" " * (-len(data) % 80 if fill else 0))
    return str(path)


ROWS = [(float(i), None if i % 7 == 0 else f"t{i % 100}", None if i % 5 == 0 else i / -7) for i in range(1000)]


def near(a, b):
    return a == b or (a is not None and b is not None and math.isclose(a, b, rel_tol=1e-15))


def test_reads_by_ranges_that_rows_straddle(spark, tmp_path):
    path = hand_file(tmp_path / "hand.xpt", ROWS)
    xport.register(spark)
    for size in (1 << 20, 777, 80, 23):
        df = spark.read.format("xport").option("rangeBytes", size).load(path)
        got = sorted(map(tuple, df.collect()))
        assert df.schema.simpleString() == "struct<ID:double,TXT:string,VAL:double>"
        assert len(got) == len(ROWS) and all(a[:2] == b[:2] and near(a[2], b[2]) for a, b in zip(got, ROWS, strict=True))
    assert spark.read.format("xport").schema("VAL double, ID double").load(path).columns == ["VAL", "ID"]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5, 40])
def test_blanks_of_the_last_card_are_no_rows(spark, tmp_path, n):
    """Rows of four blanks' width: up to 19 of them would fit in the fill."""
    columns = [xport.Variable("T", False, 4, 0)]
    path = hand_file(tmp_path / "short.xpt", [("a",)] * n, columns)
    xport.register(spark)
    assert spark.read.format("xport").load(path).count() == n


def test_pandas_reads_what_is_written(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, rng.choice((None, "x", "twelve chars", "é ü")), rng.choice((None, float("nan"), rng.gauss(0, 1e6))), i % 2 == 0)
            for i in range(500)]
    df = spark.createDataFrame(rows, "SEQN long, NAME string, V double, FLAG boolean").repartition(3)
    xport.register(spark)
    out = str(tmp_path / "out")
    df.write.format("xport").mode("append").option("textWidth", 80).save(out)  # pandas miscounts rows below 80 bytes
    files = [p for p in os.listdir(out) if p.endswith(".xpt")]
    assert len(files) == 3 and not any(p.startswith("_") for p in os.listdir(out))
    theirs = pd.concat([pd.read_sas(f"{out}/{p}", format="xport", encoding="utf-8") for p in files])
    theirs = sorted((r.SEQN, r.NAME.strip() or None, None if math.isnan(r.V) else r.V, r.FLAG) for r in theirs.itertuples())
    ours = sorted(map(tuple, load_module(spark, out, "xport").collect()))
    want = sorted((float(i), n, None if v is None or math.isnan(v) else v, float(f)) for i, n, v, f in rows)
    assert ours == want
    assert len(theirs) == len(want)  # pandas reads zero as 16**-65
    assert all(a[1] == b[1] and all(x == y or (y == 0 and abs(x) < 1e-78) for x, y in zip(a[::2] + a[3:], b[::2] + b[3:], strict=True))
               for a, b in zip(theirs, want, strict=True))
    df.limit(5).write.format("xport").mode("overwrite").option("textWidth", 20).save(out)
    assert load_module(spark, out, "xport").count() == 5
    df.limit(3).write.format("xport").mode("append").option("textWidth", 20).save(out)
    assert load_module(spark, out, "xport").count() == 8


def test_absent_and_cut_files_are_absent_modules(spark, tmp_path):
    assert load_module(spark, str(tmp_path / "none.xpt"), "xport") is None
    (tmp_path / "empty").mkdir()
    assert load_module(spark, str(tmp_path / "empty"), "xport") is None
    whole = open(hand_file(tmp_path / "whole.xpt", ROWS), "rb").read()
    for k, cut in enumerate((0, 100, 700, 1000, len(whole) - 40, len(whole) - 80)):
        (tmp_path / f"cut{k}.xpt").write_bytes(whole[:cut])
        assert load_module(spark, str(tmp_path / f"cut{k}.xpt"), "xport") is None, cut
    (tmp_path / "other.xpt").write_bytes(b"x" * 2000)
    assert load_module(spark, str(tmp_path / "other.xpt"), "xport") is None
    assert load_module(spark, str(tmp_path / "whole.xpt"), "xport").count() == len(ROWS)


def test_a_second_member_is_an_error(spark, tmp_path):
    one = open(hand_file(tmp_path / "a.xpt", ROWS[:8]), "rb").read()
    (tmp_path / "two.xpt").write_bytes(one + one[240:])  # 21-byte rows: the second header ends on a row by its fill
    df = load_module(spark, str(tmp_path / "two.xpt"), "xport")
    if df is not None:
        with pytest.raises(PySparkException, match="more than one member"):
            df.collect()


def test_what_cannot_be_written_is_refused(spark, tmp_path):
    xport.register(spark)
    one = spark.range(1)
    for df, message in ((one.select(F.lit("x" * 30).alias("T")), "longer"), (one.select(F.lit(1).alias("MUCHTOOLONG")), "names"),
                        (one.select(F.array(F.lit(1)).alias("A")), "numbers and text"), (one.select(F.lit(1e300).alias("V")), "large")):
        with pytest.raises(Exception, match=message):
            df.write.format("xport").mode("append").option("textWidth", 20).save(str(tmp_path / "bad"))
    assert load_module(spark, str(tmp_path / "bad"), "xport") is None
