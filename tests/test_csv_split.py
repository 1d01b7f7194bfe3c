"""Splittable reads of CSV files with quoted line breaks equal Spark's multi-line read."""

import random

import pytest

from panelspark.sources.wide_csv import read_wide_csv, split_records

HEAD = "RegionID,SizeRank,RegionName,StateName,2024-01-31,2024-02-29"


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000b")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def text(rng, n, end="\n", long=0):
    names = ['plain', '"quoted, comma"', '"two\nlines"', '"say ""hi""\n\n  there"', '""', '"a\n\n\nb"', '"x ""\n"" y"', '""""']
    out = []
    for i in range(n):
        name = rng.choice(names)
        if long and i % 50 == 7:
            name = '"' + "long,\nname " * long + '"'  # longer than several splits
        out.append(f"{i},{i},{name.replace(chr(10), end)},CA,{rng.random():.6f},{rng.choice(['', '5', '-1.5'])}")
        if rng.random() < 0.05:
            out.append("")
    return HEAD + end + end.join(out) + (end if rng.random() < 0.5 else "")


def same(spark, path):
    whole = read_wide_csv(spark, path, source_col="src", splittable=False)
    cut = read_wide_csv(spark, path, source_col="src", splittable=True)
    assert cut.columns == whole.columns
    key = lambda r: tuple((x is None, x) for x in r)
    a, b = sorted(whole.collect(), key=key), sorted(cut.collect(), key=key)
    assert a == b
    return len(b), cut


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_equals_the_multi_line_read(spark, tmp_path, small_splits, seed, end):
    rng = random.Random(seed)
    (tmp_path / "d").mkdir()
    for k, long in enumerate((0, 600, 0)):
        (tmp_path / "d" / f"{k}.csv").write_bytes((["", "\ufeff"][k % 2] + text(rng, 400, end, long)).encode())
    n, cut = same(spark, str(tmp_path / "d"))
    assert n == 1200


def test_one_file_is_read_by_several_tasks(spark, tmp_path, small_splits):
    p = tmp_path / "one.csv"
    p.write_text(text(random.Random(9), 1000, long=300))
    n, cut = same(spark, str(p))
    assert n == 1000 and split_records(spark, [str(p)]).rdd.getNumPartitions() > 8
    assert read_wide_csv(spark, str(p), splittable=False).rdd.getNumPartitions() == 1
    assert read_wide_csv(spark, str(p)).rdd.getNumPartitions() > 8  # by its size
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "value" not in "".join(line for line in plan.splitlines() if "Exchange" in line)  # lines are not shuffled


def test_open_quote_and_surplus_fields_raise(spark, tmp_path, small_splits):
    p = tmp_path / "open.csv"
    p.write_text(f'{HEAD}\n1,1,"open,CA,1,2\n' + "2,2,x,CA,1,2\n" * 500)
    with pytest.raises(ValueError, match="within quotes"):
        read_wide_csv(spark, str(p), splittable=True)
    p.write_text(f'{HEAD}\n' + '2,2,"x\ny",CA,1,2\n' * 300 + "3,3,x,CA,1,2,9\n")
    with pytest.raises(Exception, match="malformed record"):
        read_wide_csv(spark, str(p), splittable=True).collect()


def test_short_records_empty_and_packed_files(spark, tmp_path, small_splits):
    p = tmp_path / "short.csv"
    p.write_text(f"{HEAD}\n\n1,1,A,CA,5\n   \n2,2,B,CA,6,7\n")
    same(spark, str(p))
    p.write_text(f"{HEAD}\n\n")
    assert read_wide_csv(spark, str(p), splittable=True) is None
    import gzip
    z = tmp_path / "z.csv.gz"
    z.write_bytes(gzip.compress(text(random.Random(1), 300).encode()))
    assert same(spark, str(z))[0] == 300
