import gzip
import json

import pytest

from panelspark.sinks import raw as SR
from panelspark.sources import raw as RAW


def test_raw_text_whole_file_keeps_bytes_of_invalid_utf8(spark, tmp_path):
    d = tmp_path / "raw" / "asset.txt"
    d.mkdir(parents=True)
    (d / "good.txt").write_bytes("héllo\nwörld\n".encode("utf-8"))
    (d / "bad.txt").write_bytes(b"caf\xe9\n")
    rows = {r.path.rsplit("/", 1)[-1]: r for r in RAW.scan_raw_text(spark, str(tmp_path), "asset", whole=True).collect()}
    assert rows["good.txt"].text == "héllo\nwörld\n" and rows["good.txt"].valid_utf8
    assert rows["bad.txt"].text is None and not rows["bad.txt"].valid_utf8
    assert bytes(rows["bad.txt"].bytes) == b"caf\xe9\n"
    with pytest.raises(FileNotFoundError):
        RAW.scan_raw_text(spark, str(tmp_path), "absent")


def test_raw_json_prefers_plain_then_gzip(spark, tmp_path):
    d = tmp_path / "raw" / "a.json.gz"
    d.mkdir(parents=True)
    with gzip.open(d / "part-0.json.gz", "wt") as f:
        f.write(json.dumps({"k": 1}) + "\n")
    assert [r.k for r in RAW.scan_raw_json(spark, str(tmp_path), "a").collect()] == [1]
    SR.save_raw_json(spark.createDataFrame([(2,)], "k long"), str(tmp_path), "a")
    assert [r.k for r in RAW.scan_raw_json(spark, str(tmp_path), "a").collect()] == [2]


def test_raw_parquet_metadata_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "x")], "id long, v string")
    SR.save_raw_parquet(df, str(tmp_path), "p", metadata={"source": "unit"})
    back = RAW.scan_raw_parquet(spark, str(tmp_path), "p")
    assert RAW.asset_metadata(back) == {"source": "unit"} and back.count() == 1


def test_raw_csv_text_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 'line one\nline "two", ok')], "id long, text string")
    path = SR.save_raw_text(df, str(tmp_path), "docs", ext="csv")
    back = (spark.read.option("header", "true").option("escape", '"').option("multiLine", "true")
            .schema("id long, text string").csv(path))
    assert back.collect()[0].text == 'line one\nline "two", ok'
