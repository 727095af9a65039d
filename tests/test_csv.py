"""separator/encoding resolution, column resolution, skip rules."""

import os

import pytest

from textlens.sources.csv_files import load_dataset, read_csv, sniff


def write(folder, name, data: bytes):
    with open(os.path.join(folder, name), "wb") as f:
        f.write(data)


def test_sniff_and_load(spark, tmp_folder):
    write(tmp_folder, "a.csv", "Tweet,Sentiment\n\"café au lait x y\",0\nn/a,1\nw x y z,2\n".encode())
    write(tmp_folder, "b.csv", "text\tlabel\tsource_file\ncafé noir a b\t0\tsentimen_twitter_labeled_4.csv\n"
                               .encode("latin-1"))
    write(tmp_folder, "c.csv", b"id,other\n1,2\n")
    assert sniff(spark, f"file://{tmp_folder}/a.csv").sep == ","
    d = sniff(spark, f"file://{tmp_folder}/b.csv")
    assert (d.sep, d.encoding) == ("\t", "ISO-8859-1")
    curated, report = load_dataset(spark, f"file://{tmp_folder}")
    got = sorted((r.text, r.sentiment) for r in curated.collect())
    assert got == [("café au lait x y", "Positive"), ("café noir a b", "Neutral"), ("w x y z", "Negative")]
    assert report.skipped == {"c.csv": "no text or label column"}
    assert report.usable == {"a.csv": 2, "b.csv": 1}


def test_unreadable_file_raises(spark, tmp_folder):
    write(tmp_folder, "x.csv", b"onlyonecolumn\n1\n")
    with pytest.raises(ValueError):
        sniff(spark, f"file://{tmp_folder}/x.csv")


def test_only_files_with_broken_lines_are_read_whole(spark, tmp_folder):
    write(tmp_folder, "plain.csv", 'text,label\n"a, ""b"" c d",0\ne f g h,1\n'.encode())
    write(tmp_folder, "broken.csv", 'text,label\n"a b\nc d",0\ne f g h,1\n'.encode())
    write(tmp_folder, "latin.csv", 'text,label\n"caf\xe9",0\n"a\xe9\nb",1\n'.encode("latin-1"))
    got = {n: sniff(spark, f"file://{tmp_folder}/{n}.csv") for n in ("plain", "broken", "latin")}
    assert [got[n].multiline for n in ("plain", "broken", "latin")] == [False, True, True]
    assert [r.text for r in read_csv(spark, f"file://{tmp_folder}/plain.csv").orderBy("_row").collect()] == ['a, "b" c d', "e f g h"]
    assert [r.text for r in read_csv(spark, f"file://{tmp_folder}/latin.csv").orderBy("_row").collect()] == ["caf\xe9", "a\xe9\nb"]
