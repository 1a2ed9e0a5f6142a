"""CSV by blocks against Python's own reader and Spark's reader of whole files."""

import csv
import io
import random

import pytest

from tests.conftest import rows
from tests.test_plans import settings
from trialcohort.sources import readers
from trialcohort.sources.csv_records import numbered_lines

BLOCKS = {"spark__sql__files__maxPartitionBytes": "700", "spark__sql__files__openCostInBytes": "0"}


def table(seed, n, ending="\r\n"):
    rng = random.Random(seed)
    cells = ["", "plain", "a,b", 'say "hi"', "one;\n two", "\n", '"\n"', "é\n\n日本,", "x" * 300, "line\r\nline\n" * 8, '""', " blank "]
    data = [[str(i), *(rng.choice(cells) for _ in range(3))] for i in range(n)]
    text = io.StringIO(newline="")
    out = csv.writer(text, lineterminator=ending)
    out.writerows([["id", "first", "second name", "third"], *data])
    return text.getvalue(), [tuple(x or None for x in row) for row in data]


def written(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(text.encode())


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_blocks_give_the_rows_of_whole_files(spark, tmp_path, ending):
    folder, expected = tmp_path / "in.csv", []
    for k, n in enumerate((120, 1, 0, 60)):
        text, data = table(k, n, ending)
        written(folder, f"{k}.csv", text if k else text.rstrip(ending))
        expected += data
    with settings(spark, **BLOCKS):
        found = readers.raw_csv(spark, str(folder))
        assert found.columns == ["id", "first", "second name", "third"]
        assert rows(found) == sorted(expected, key=repr)
        lines = numbered_lines(spark, str(folder))
        assert lines.select("path", "start").distinct().count() > 20
    if ending == "\n":  # Spark's reader turns \r\n within cells into \n where lines end so
        whole = spark.read.csv(str(folder), header=True, multiLine=True, quote='"', escape='"')
        assert rows(whole) == sorted(expected, key=repr)


def test_a_cell_over_many_blocks_and_blank_lines(spark, tmp_path):
    long = "\n".join(f"line {i}" for i in range(2_000))
    written(tmp_path / "in.csv", "a.csv", f'\ufeffid,text\n\n1,"{long}"\n\n2,"x\n\ny"\n3,\n\n')
    with settings(spark, **BLOCKS):
        found = readers.raw_csv(spark, str(tmp_path / "in.csv"))
        assert found.columns == ["id", "text"]
        assert rows(found) == [("1", long), ("2", "x\n\ny"), ("3", None)]


def test_short_and_long_rows(spark, tmp_path):
    written(tmp_path / "in.csv", "a.csv", 'id;a;b\n1;"p\nq"\n2;x;y;z\n')
    assert rows(readers.raw_csv(spark, str(tmp_path / "in.csv"), ";")) == [("1", "p\nq", None), ("2", "x", "y")]


def test_quotes_that_do_not_pair_up_end_the_job(spark, tmp_path):
    written(tmp_path / "in.csv", "a.csv", 'id,text\n1,a "quote\n2,b\n')
    with pytest.raises(Exception, match="pair up"):
        readers.raw_csv(spark, str(tmp_path / "in.csv")).collect()


def test_each_block_has_its_task(spark, tmp_path):
    text, _ = table(5, 400)
    written(tmp_path / "in.csv", "a.csv", text)
    with settings(spark, spark__sql__files__maxPartitionBytes="4096", spark__sql__files__openCostInBytes="0", spark__sql__files__minPartitionNum="1"):
        scan = spark.read.option("lineSep", "\n").text(str(tmp_path / "in.csv"))
        assert scan.rdd.getNumPartitions() == -(-len(text.encode()) // 4096)
