"""Records of CSV files cut into blocks of any size, against pandas, and folders of many files."""

import csv
import io
import os
import random

import pandas as pd
import pytest

import __spark_entry__ as E
from oracle_check import check
from textlens.sources import csv_files, csv_scan

SF = "/root/testdata/sf0.001"


def write(folder, name, data: bytes):
    with open(os.path.join(folder, name), "wb") as f:
        f.write(data)


def by_signs(line, state, sep):
    """The states of a field, sign by sign."""
    at = "quoted" if state else "start"
    for c in line:
        if at in ("start", "plain") and c in sep + "\r":
            at = "start"
        elif at in ("quoted", "closing"):
            at = ("closing" if at == "quoted" else "quoted") if c == '"' else "quoted" if at == "quoted" else "start" if c in sep + "\r" else "plain"
        else:
            at = "quoted" if at == "start" and c == '"' else "plain"
    return int(at == "quoted")


def test_state_after_a_line():
    rnd = random.Random(1)
    for sep in (",", "\t"):
        q = csv_scan.Quotes(sep.encode())
        for _ in range(20_000):
            line = "".join(rnd.choice('aé",\r\t ') for _ in range(rnd.randrange(12)))
            for state in (0, 1):
                assert q.after(line.encode(), state) == by_signs(line, state, sep), (line, state)


def random_file(rnd, sep, end, rows, accents):
    signs = ["a", "b ", " x", '"', sep, "\n", "\r\n", "", ".", "'", 'q"q', "NA "] + (["é", "ÿß"] if accents else [])
    out = io.StringIO(newline="")
    w = csv.writer(out, delimiter=sep, lineterminator=end)
    w.writerow(["Text", "label", "n"])
    for i in range(rows):
        w.writerow(["".join(rnd.choice(signs) for _ in range(rnd.randrange(9))), rnd.choice(["0", "1", "Positive", "NA", ""]), i])
        if rnd.random() < 0.1:
            out.write(end)                                      # a blank line
        if rnd.random() < 0.1:
            out.write(f'5" wide{sep}1{sep}7{end}')              # a quote inside a plain field
    return out.getvalue()


def with_blocks(spark, size):
    class Set:
        def __enter__(self):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1")

        def __exit__(self, *_):
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
    return Set()


@pytest.mark.parametrize("size,sep,end,encoding", [(47, ",", "\n", "utf-8"), (300, "\t", "\r\n", "latin-1"), (90, ",", "\r\n", "utf-8-sig")])
def test_blocks_of_any_size_give_the_rows_of_pandas(spark, tmp_folder, sep, end, encoding, size):
    rnd = random.Random(size)
    data = random_file(rnd, sep, end, 4 + size // 3, encoding != "utf-8").encode(encoding)
    write(tmp_folder, "f f+1%.csv", data)
    path = f"file://{tmp_folder}/f f+1%.csv"
    with with_blocks(spark, size):
        assert spark.read.text(path).rdd.getNumPartitions() > len(data) / size / 2 > 3
        d = csv_files.sniff(spark, path)
        assert (d.sep, d.encoding, d.multiline) == (sep, "ISO-8859-1" if encoding == "latin-1" else "UTF-8", True)
        got = csv_files.read_csv(spark, path).orderBy("_row").collect()
    want = pd.read_csv(io.BytesIO(data), sep=sep, encoding=encoding.removesuffix("-sig"), dtype=str)
    assert [(r.text, r.label, r.n) for r in got] == [tuple(None if pd.isna(x) else x for x in row) for row in want.itertuples(index=False)]
    assert len({r._row for r in got}) == len(got)


def test_carriage_returns_end_records_too(spark, tmp_folder):
    write(tmp_folder, "m.csv", b'text,label\ra b,0\r"c\rd",1\re f,2')
    got = csv_files.read_csv(spark, f"file://{tmp_folder}/m.csv").orderBy("_row").collect()
    assert [(r.text, r.label) for r in got][-3:] == [("a b", "0"), ("c\rd", "1"), ("e f", "2")]


def test_a_folder_of_many_files_takes_as_many_jobs_as_one_of_few(spark, tmp_folder):
    few, many = os.path.join(tmp_folder, "few"), os.path.join(tmp_folder, "many")
    for folder, n in ((few, 3), (many, 60)):
        os.mkdir(folder)
        for i in range(n):
            sep = ",\t"[i % 2]
            write(folder, f"{i:03}.csv", f'Tweet{sep}label\n"a b {i}\nc d"{sep}{i % 3}\nx{sep}\n'.encode())
        write(folder, "zz.csv", b"id,other\n1,2\n")

    def jobs(folder):
        spark.sparkContext.setJobGroup(folder, folder)
        curated, report = csv_files.load_dataset(spark, f"file://{folder}")
        rows = curated.collect()
        spark.sparkContext.setJobGroup("", "")
        return rows, report, len(spark.sparkContext.statusTracker().getJobIdsForGroup(folder))
    rows, report, n_few = jobs(few)
    assert len(rows) == 3 and report.usable == {f"{i:03}.csv": 1 for i in range(3)}
    rows, report, n_many = jobs(many)
    assert len(rows) == 60 and report.skipped == {"zz.csv": "no text or label column"}
    assert n_many <= n_few + 2, (n_few, n_many)


def test_columns_and_odd_files(spark, tmp_folder):
    write(tmp_folder, "a.csv", b'\n \n"tweet\nx", Content ,CLASS,label\nq,"t ""u"" v",1,2\n,NA,0,1\nshort\nq,w,1,2,3,4\n')
    rows, report = csv_files.load_labelled(spark, f"file://{tmp_folder}")
    assert [(r.text, r.label_raw, r.origin) for r in rows.orderBy("row_id").collect()] == [
        ('t "u" v', "1", "a.csv"), (None, "0", "a.csv"), (None, None, "a.csv"), ("w", "1", "a.csv")]
    write(tmp_folder, "b.csv", b"")
    with pytest.raises(ValueError, match="b.csv: the file is empty"):
        csv_files.load_labelled(spark, f"file://{tmp_folder}")
    write(tmp_folder, "b.csv", b'text,label\n"never closed,0\na,1\n')
    with pytest.raises(ValueError, match="b.csv: .*never closed"):
        csv_files.load_labelled(spark, f"file://{tmp_folder}")


def test_files_of_a_folder_are_matched_by_name_of_column(spark, tmp_folder):
    write(tmp_folder, "1.csv", b"text,conf\na,1\nb,2\n")
    write(tmp_folder, "2.csv", b"conf\ttext\textra\n3\tc\tz\n")
    got = csv_files.read_csv(spark, f"file://{tmp_folder}").orderBy("_row").collect()
    assert [(r.text, r.conf) for r in got] == [("a", "1"), ("b", "2"), ("c", "3")]


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
@pytest.mark.parametrize("name", ["csv_dialects", "csv_folder_report", "csv_curate_corpus"])
def test_oracles(spark, name):
    res = check(spark, SF, [name])[name]
    assert res["cols_ok"] and res["hash_ok"] and res["rows"], res
