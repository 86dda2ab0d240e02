"""Quoted CSV read in splits: the same rows as a reader that takes the file whole."""

import random

import numpy as np
import pytest
from conftest import plan
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from ordermill.sources import quoted
from ordermill.sources import tables as io

SCHEMA = StructType([StructField("id", IntegerType()), StructField("title", StringType()), StructField("note", StringType()), StructField("score", IntegerType())])
HEADER = "id,title,note,score\n"


def whole_file(spark, path, keep_corrupt=True):
    """The reader that cannot split a file."""
    schema = StructType(list(SCHEMA.fields)).add(io.CORRUPT, StringType()) if keep_corrupt else SCHEMA
    reader = spark.read.option("header", True).option("enforceSchema", False).option("mode", "PERMISSIVE").option("multiLine", True)
    reader = reader.option("quote", '"').option("escape", '"').option("columnNameOfCorruptRecord", io.CORRUPT)
    return reader.schema(schema).csv(path)


def same_rows(spark, path):
    def plain(df):
        # The raw text of a bad record may keep its line end in the other reader.
        return sorted((tuple(r)[:4] + ((r[io.CORRUPT] or "").strip("\r\n"),) for r in df.collect()), key=repr)

    ours = io.read_csv_permissive(spark, path, SCHEMA, multi_line=True, keep_corrupt=True)
    assert plain(ours) == plain(whole_file(spark, path))
    return ours


def written(rng, n, end="\n"):
    """Records with line breaks, commas and doubled quotes in quotes, stray quotes, bad numbers, short and long records."""
    cells = ["plain", "", '""', '"a, b"', '"two\nlines"', '"x ""y"" z"', '"\n\n"', '"""\n"""', 'five" pipe', '"shut"open', '"," ', "é日本", '"crlf\r\nin"', " pad "]
    out = []
    for i in range(n):
        cell = [str(i), rng.choice(cells), rng.choice(cells), rng.choice(["1", "9", "n/a", "", '"7"'])]
        cell = cell[: rng.choice([4, 4, 4, 4, 4, 3, 2])] + ["extra"] * rng.choice([0] * 9 + [1])
        out.append(",".join(cell))
        if rng.random() < 0.05:
            out.append("")
    return end.join(out)


@pytest.fixture
def tiny_splits(spark):
    """Splits of a few bytes, packed in few tasks as real ones are."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def cut(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")

    yield cut
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("size", [37, 300, 4096])
def test_rows_equal_the_whole_file_reader(spark, tmp_path, tiny_splits, size):
    tiny_splits(size)
    rng = random.Random(size)
    (tmp_path / "a").mkdir()
    for i in range(3):
        (tmp_path / "a" / f"{i}.csv").write_text(HEADER + written(rng, min(400, 6 * size)) + "\n" * (i % 2), newline="")
    ours = same_rows(spark, str(tmp_path / "a"))
    if size < 4096:
        assert quoted.lines_of(spark, str(tmp_path / "a")).rdd.getNumPartitions() > 3


def test_a_record_may_span_many_splits(spark, tmp_path, tiny_splits):
    tiny_splits(50)
    long = "\n".join(f'line {i}, "" of the text' for i in range(200))
    (tmp_path / "a.csv").write_text(HEADER + f'1,a,"{long}",2\n2,b,c,3\n3,"{long}","{long}",4\n4,"never closed\nto the end,5\n6,7')
    ours = same_rows(spark, str(tmp_path / "a.csv")).filter("id < 4").orderBy("id").collect()
    assert [r["note"] for r in ours] == [long.replace('""', '"'), "c", long.replace('""', '"')]


@pytest.mark.parametrize("text", ["", HEADER, HEADER.strip(), HEADER + "\n\n", HEADER.replace("\n", "\r\n") + "1,a,c,2\r\n"])
def test_empty_files_and_other_line_ends(spark, tmp_path, text):
    (tmp_path / "a.csv").write_text(text, newline="")
    assert same_rows(spark, str(tmp_path / "a.csv")).count() == (1 if "1," in text else 0)


def test_line_breaks_in_quotes_stay_as_they_are(spark, tmp_path):
    """The other reader turns them to line feeds where the file's records end with a carriage return, too."""
    (tmp_path / "a.csv").write_text(HEADER.replace("\n", "\r\n") + '1,"a\r\nb","c\n",2\r\n', newline="")
    row = io.read_csv_permissive(spark, str(tmp_path / "a.csv"), SCHEMA, multi_line=True).first()
    assert tuple(row) == (1, "a\r\nb", "c\n", 2)


def test_each_file_has_its_header_checked(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEADER + "1,a,b,2\n")
    (tmp_path / "b.csv").write_text("id,note,title,score\n1,a,b,2\n")
    with pytest.raises(Exception, match="header"):
        io.read_csv_permissive(spark, str(tmp_path), SCHEMA, multi_line=True).select("id").collect()


def test_states_compose():
    rng = np.random.default_rng(5)
    for _ in range(200):
        out, ins = rng.integers(0, 2, (2, int(rng.integers(1, 12)))).astype(bool)
        for start in (False, True):
            state, want = start, []
            for o, i in zip(out, ins, strict=True):
                state = bool(i if state else o)
                want.append(state)
            assert quoted.states_after(out, ins, start).tolist() == want


def test_whole_records_are_not_shuffled(spark, tmp_path):
    """Only the parts of records that cross splits pass an exchange; the lines are joined with the splits by broadcast."""
    (tmp_path / "a.csv").write_text(HEADER + "1,a,b,2\n")
    text = plan(quoted.quoted_records(spark, str(tmp_path)))
    whole, parts = text.split("ObjectHashAggregate")[0], text
    assert "SortMergeJoin" not in parts and "BroadcastHashJoin" in whole
    assert "CartesianProduct" not in parts and "BroadcastNestedLoopJoin" not in parts
