"""CSV files read in pieces, against Spark's reader of whole files."""

import random

import pytest
from pyspark.sql import functions as F

from riskloom.sources import quoted
from riskloom.sources.tables import read_csv, read_csv_inferred, read_text_fields, write_csv

from helpers import final_plan, rows

DDL = "n INT, text STRING, more STRING"


@pytest.fixture
def pieces(spark):
    """A session that reads files in splits of a few records."""
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", "300")
    session.conf.set("spark.sql.files.openCostInBytes", "1")
    session.conf.set("spark.sql.session.timeZone", "UTC")
    return session


def written(path, records, end="\n", header="n,text,more"):
    path.write_bytes(end.join([header, *records, ""]).encode())
    return str(path)


def made(seed, count, breaks=("\n",)):
    rng = random.Random(seed)
    field = lambda: "".join(rng.choice(['a', 'é', ',', '""', ' ', "'", *breaks, "bcd"]) for _ in range(rng.randint(1, 30)))
    return [f'{k},"{field()}","{field()}"' if rng.random() < 0.7 else f"{k},plain {k},{rng.choice(['', 'x'])}" for k in range(count)]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_one_file_in_many_splits(pieces, tmp_path, end):
    path = written(tmp_path / "a.csv", made(len(end), 400, breaks=(end, end + end)), end)
    assert pieces.read.text(path).rdd.getNumPartitions() > 20
    found = read_csv(pieces, path, DDL)
    # Spark's own reader takes line breaks in a quoted text for plain ones.
    plain = found.withColumns({c: F.replace(c, F.lit("\r\n"), F.lit("\n")) for c in ("text", "more")})
    assert rows(plain) == rows(read_csv(pieces, path, DDL, whole_files=True))
    assert found.count() == 400
    assert any(end in (r.text or "") for r in found.collect())


def test_a_record_longer_than_several_splits(pieces, tmp_path):
    long = "line of text\n" * 400
    records = made(5, 30) + [f'900,"{long}","say ""so"""'] + made(6, 30)
    path = written(tmp_path / "long.csv", records)
    found = read_csv(pieces, path, DDL)
    assert rows(found) == rows(read_csv(pieces, path, DDL, whole_files=True))
    (row,) = found.where("n = 900").collect()
    assert (row.text, row.more) == (long, 'say "so"')


def test_several_files_with_blank_lines_marks_and_one_line_headers(pieces, tmp_path):
    for k in range(3):
        mark = "﻿" if k else ""
        records = made(20 + k, 50) + ["", '77,"",'] + made(30 + k, 3)
        written(tmp_path / f"{k}.csv", records, header=f"{mark}n,text,more")
    path = str(tmp_path)
    assert rows(read_csv(pieces, path, DDL)) == rows(read_csv(pieces, path, DDL, whole_files=True))
    assert read_csv(pieces, path, DDL).count() == 3 * 54


def test_a_header_with_a_line_break(pieces, tmp_path):
    path = written(tmp_path / "h.csv", made(3, 40), header='n,"the\ntext",more')
    found = read_text_fields(pieces, path)
    assert found.columns == ["n", "the\ntext", "more"]
    assert rows(found) == rows(read_text_fields(pieces, path, whole_files=True))


@pytest.mark.parametrize("header", ["n,other,more", "n,text", "n,text,more,again"])
def test_another_header_is_an_error(pieces, tmp_path, header):
    written(tmp_path / "0.csv", made(1, 5))
    written(tmp_path / "1.csv", made(2, 5), header=header)
    with pytest.raises(Exception, match="another header"):
        read_csv(pieces, str(tmp_path), DDL).collect()


def test_types_are_inferred_over_all_splits(pieces, tmp_path):
    records = [f'{k},{k / 4},"a\nb{k}",2024-01-0{1 + k % 9} 10:00:00,true,{k if k < 90 else "x"}' for k in range(100)]
    path = written(tmp_path / "t.csv", records, header="whole,real,text,time,flag,late")
    found = read_csv_inferred(pieces, path)
    plain = read_csv_inferred(pieces, path, whole_files=True)
    assert found.dtypes == plain.dtypes and dict(found.dtypes)["late"] == "string"
    assert rows(found) == rows(plain)


def test_short_and_unreadable_fields(pieces, tmp_path):
    path = written(tmp_path / "s.csv", ["1,a", "x,b,c", "3,d,e,extra", '4,"open'])
    found = sorted(tuple(r) for r in read_csv(pieces, path, "n INT, text STRING, more STRING").fillna({"n": -1, "more": "-"}).collect())
    assert [r[:2] for r in found][:3] == [(-1, "b"), (1, "a"), (3, "d")]
    assert found[3][0] == 4 and found[3][1].startswith("open")


def test_no_rows(pieces, tmp_path):
    write_csv(pieces.createDataFrame([], DDL), str(tmp_path / "none"))
    assert read_csv(pieces, str(tmp_path / "none"), DDL).collect() == []
    path = written(tmp_path / "one.csv", [])
    assert read_csv(pieces, path, DDL).collect() == []


def test_no_task_reads_a_whole_file(pieces, tmp_path):
    path = written(tmp_path / "b.csv", made(9, 300))
    lines = quoted._lines(pieces, path).groupBy("block").count().collect()
    assert len(lines) > 20 and max(r["count"] for r in lines) < 40


def test_records_within_a_split_are_not_shuffled(pieces, tmp_path):
    path = written(tmp_path / "w.csv", made(12, 300))
    plan = final_plan(quoted.quoted_records(pieces, path))
    scan = plan.split("MapInArrow", 1)[1].split("BroadcastExchange", 1)[0]
    assert "Scan text" in scan and "Exchange" not in scan and "Sort" not in scan


def test_tasks_that_scan_many_splits(pieces, tmp_path):
    path = written(tmp_path / "m.csv", made(13, 3000))
    splits = pieces.read.text(path).rdd.getNumPartitions()
    assert quoted._lines(pieces, path).rdd.getNumPartitions() < splits / 2
    assert rows(read_csv(pieces, path, DDL)) == rows(read_csv(pieces, path, DDL, whole_files=True))
    assert rows(read_csv(pieces, path, DDL).select("n")) == [(k,) for k in sorted(range(3000), key=lambda k: repr((k,)))]
