"""The CSV reader against Python's csv module, and dense row numbers."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from tallyforge.plans.pipeline import run_pipeline
from tallyforge.plans.schema import AUTO_INDEX
from tallyforge.sources import csvfile, tables


@pytest.fixture
def small_ranges(spark):
    """Ranges of about ``n`` bytes; a task for each."""

    def use(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        spark.conf.set("spark.sql.files.minPartitionNum", "1")

    yield use
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")
    spark.conf.unset("spark.sql.files.minPartitionNum")


def _plain(texts, width, blank=lambda r: r == [] or (len(r) == 1 and not r[0].strip(" \t"))):
    """Rows by Python's reader: short ones padded, long and blank ones skipped."""
    out = []
    for text in texts:
        rows = [r for r in csv.reader(io.StringIO(text, newline="")) if not blank(r)]
        out += [tuple(x or None for x in r + [""] * (width - len(r))) for r in rows[1:] if len(r) <= width]
    return out


def _got(df):
    return [tuple(x or None for x in tuple(r)[:-1]) for r in df.orderBy("_row_id").collect()]


def test_folder_of_small_files(spark, tmp_path):
    texts = [f"id,name,note\n{i},n{i},x{i}\n" for i in range(24)]
    for i, t in enumerate(texts):
        (tmp_path / f"part-{i:02d}.csv").write_text(t)
    df = tables.read_csv(spark, str(tmp_path))
    assert df.count() == 24 and _got(df) == _plain(texts, 3)
    assert [r["_row_id"] for r in df.orderBy("_row_id").collect()] == list(range(24))


def _messy(seed, rows, stray=True):
    """Quoted commas, line breaks and quotes, blank and short and long rows, quotes within unquoted fields."""
    r = random.Random(seed)
    pieces = ["a", "bb", ",", "\n", '""', " ", "é", "日", "x\n\ny", "1,2", "\n,\n"]
    out = ["id,name,note"]
    for i in range(rows):
        fields = [str(i)]
        for _ in range(r.choice([2, 2, 2, 2, 1, 3])):
            k = r.random()
            if k < 0.4:
                fields.append('"' + "".join(r.choice(pieces) for _ in range(r.randint(0, 12))) + '"')
            elif stray and k < 0.5:
                fields.append('5" pipe' if r.random() < 0.5 else 'it is "so"')
            else:
                fields.append(r.choice(["plain", "", "x y"]))
        out.append(",".join(fields))
        if r.random() < 0.1:
            out.append(r.choice(["", "  "]))
    return "\n".join(out) + "\n"


@pytest.mark.parametrize("seed", range(3))
def test_quoted_breaks_across_ranges(spark, tmp_path, small_ranges, seed):
    texts = [_messy(seed * 10 + k, n) for k, n in enumerate((400, 3, 90))]
    for k, t in enumerate(texts):
        (tmp_path / f"{k}.csv").write_bytes(t.encode())
    small_ranges(700)
    found = csvfile.read(spark, str(tmp_path))
    want = _plain(texts, 3)
    assert found.ranges >= 8 and found.df.rdd.getNumPartitions() >= 4
    assert _got(found.df) == want and found.rows == len(want) and found.skipped > 0
    ids = sorted(r["_row_id"] for r in found.df.select("_row_id").collect())
    assert ids == list(range(len(want)))
    small_ranges(10_000_000)
    assert _got(tables.read_csv(spark, str(tmp_path))) == want, "the same rows and numbers from one range a file"


def test_one_record_over_many_ranges(spark, tmp_path, small_ranges):
    text = 'id,note\n1,"' + "line, of a long note\n" * 300 + '"\n2,short\n3,"' + "y\n" * 500 + '",too long\n4,end'
    (tmp_path / "a.csv").write_text(text)
    small_ranges(512)
    found = csvfile.read(spark, str(tmp_path / "a.csv"))
    assert _got(found.df) == _plain([text], 2) and (found.rows, found.skipped) == (3, 1)
    with pytest.raises(ValueError, match="malformed"):
        csvfile.read(spark, str(tmp_path / "a.csv"), strict=True)


def test_line_ends_headers_and_empty_files(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("﻿id,id,\r\n1,2,\"x\r\ny\"\r\n\r\n3\r\n".encode())
    df = tables.read_csv(spark, str(tmp_path / "a.csv"))
    assert df.columns == ["id0", "id1", "_c2", "_row_id"] and [tuple(r) for r in df.orderBy("_row_id").collect()] == [("1", "2", "x\r\ny", 0), ("3", None, None, 1)]
    (tmp_path / "b.csv").write_text("id,name\n")
    assert tables.read_csv(spark, str(tmp_path / "b.csv")).count() == 0
    other = tmp_path / "two"
    other.mkdir()
    (other / "a.csv").write_text("id,name\n1,x\n")
    (other / "b.csv").write_text('"id",name\n2,y\n')
    assert tables.read_csv(spark, str(other)).count() == 2
    (other / "c.csv").write_text("name,id\nx,1\n")
    with pytest.raises(Exception, match="another header"):
        tables.read_csv(spark, str(other)).collect()


def test_scan():
    assert csvfile.scan('a,"b,c",d', False) == (2, False)
    assert csvfile.scan('a,"b', False) == (1, True) and csvfile.scan('b",c', True) == (1, False)
    assert csvfile.scan('""",""', True) == (1, False) and csvfile.scan('5" pipe,"x""', False) == (1, True) and csvfile.scan("no end, here", True) == (0, True)


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_dense_numbers(spark, tmp_path, small_ranges, parts):
    """ROW_%06d has no gaps, and doesn't depend on how many tasks read the rows."""
    text = "date,amount,thing\n" + "".join(f"2026-01-{i % 28 + 1:02d},{i}.5,t{i % 3}\n" for i in range(600))
    (tmp_path / "a.csv").write_text(text)
    small_ranges(len(text) // parts + 1)
    raw = tables.read_csv(spark, str(tmp_path / "a.csv"))
    assert raw.rdd.getNumPartitions() == parts
    out = run_pipeline(spark, raw, "s", [], overrides={"entity_id": AUTO_INDEX})
    from tallyforge.functions.parsing import pseudonym

    want = {r[0] for r in spark.range(600).select(pseudonym(F.format_string("ROW_%06d", "id"))).collect()}
    assert {r["entity_id"] for r in out.clean_df.collect()} == want and out.clean_df.count() == 600


def test_numbers_of_other_relations(spark, tmp_path, small_ranges):
    spark.range(1000).repartition(3).write.parquet(str(tmp_path / "p"))
    small_ranges(1 << 20)
    one = {(r["id"], r["_row_id"]) for r in tables.numbered(spark.read.parquet(str(tmp_path / "p"))).collect()}
    small_ranges(1 << 10)
    assert one == {(r["id"], r["_row_id"]) for r in tables.numbered(spark.read.parquet(str(tmp_path / "p"))).collect()}
    assert sorted(n for _, n in one) == list(range(1000))
    made = tables.numbered(spark.read.parquet(str(tmp_path / "p")).filter("id % 3 = 0"))
    assert sorted(r["_row_id"] for r in made.collect()) == list(range(334))
    assert sorted(r["_row_id"] for r in tables.numbered(spark.range(50).repartition(4)).collect()) == list(range(50))
    assert tables.numbered(spark.range(0)).count() == 0
