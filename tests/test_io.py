import os
import tempfile

import pytest
from pyspark.sql import functions as F

from statlake.sources import files, synthetic
from tests.fixtures_solar import SOLAR_START, SOLAR_VALUES


def test_series_csv_roundtrip(spark):
    d = tempfile.mkdtemp(prefix="statlake-io-")
    path = os.path.join(d, "solar.csv")
    with open(path, "w") as fh:
        fh.write("date~value\n")
        y, m = map(int, SOLAR_START.split("-")[:2])
        for i, v in enumerate(SOLAR_VALUES):
            yy, mm = y + (m - 1 + i) // 12, (m - 1 + i) % 12 + 1
            fh.write(f"{yy:04d}-{mm:02d}-01~{v}\n")
    s = files.read_series(spark, path)
    rows = s.collect()
    assert len(rows) == 99 and rows[0]["value"] == SOLAR_VALUES[0]
    assert str(rows[-1]["date"]) == "2030-03-01"
    out = os.path.join(d, "kv")
    files.write_table(files.to_kv(s.agg(F.count("*").alias("n"), F.max("value").alias("max"))), out)
    back = spark.read.option("sep", "~").option("header", True).csv(out).collect()
    assert {r["metric"]: r["value"] for r in back}["n"] == "99"


def test_required_columns(spark):
    d = tempfile.mkdtemp(prefix="statlake-io-")
    path = os.path.join(d, "bad.csv")
    with open(path, "w") as fh:
        fh.write("when~amount\n2020-01-01~1\n")
    with pytest.raises(ValueError):
        files.read_series(spark, path)


def test_generators_noise_free(spark):
    s = synthetic.series(spark, 24, trend=1.0, season=0.0, noise=0.0, level=10.0).orderBy("t").toPandas()
    assert s["value"].tolist() == [10.0 + i for i in range(24)]
    st = synthetic.station(spark, 72, noise=0.0).toPandas()
    assert len(st) == 72 and (abs(st["revenue"] - st["costs"] - st["net_cashflow"]) < 1e-9).all()
    pv = synthetic.pv_rows(spark, 200, seed=3).toPandas()
    assert (pv["P"] >= 0).all()
