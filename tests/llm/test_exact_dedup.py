"""Exact deduplication against a plain grouping."""

import hashlib
import re
from collections import defaultdict

import pytest
from compare import connect, differences
from llm.conftest import EDGES

from ordermill.llm import exact_dedup, queries


def plain(rows):
    """doc_id, keep_id, group_size, kept, text_sha256 of every row, sorted."""
    sha = [hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", t or "").encode()).hexdigest() for _, t in rows]
    groups = defaultdict(list)
    for (i, _), h in zip(rows, sha, strict=True):
        groups[h].append(i)
    out = []
    for (i, _), h in zip(rows, sha, strict=True):
        least = min((x for x in groups[h] if x is not None), default=None)
        out.append((i, least, len(groups[h]), i == least, h))
    return sorted(out, key=repr)


COPIES = [(100 + i, "many  copies\nof one text") for i in range(90)] + [(None, "many copies of one text"), (3, "many copies of one text ")]


@pytest.mark.parametrize("rows", [EDGES, COPIES, EDGES + COPIES, [(None, "x"), (None, "x")], [(1, None), (0, ""), (None, None)], []])
@pytest.mark.parametrize("blocks", [exact_dedup.BLOCKS, 0])
def test_groups_equal_a_plain_grouping(table, rows, blocks, monkeypatch):
    """Also with a filter of a single block, in which many rows meet by chance."""
    monkeypatch.setattr(exact_dedup, "BLOCKS", max(1, blocks))
    monkeypatch.setattr(exact_dedup, "BLOCK", exact_dedup.BLOCK if blocks else 8)
    found, copies = exact_dedup.exact_duplicates(table(rows))
    got = found.select("doc_id", f"{copies}.*").collect()
    assert sorted(map(tuple, got), key=repr) == plain(rows)


def test_any_column_name_may_be_taken(spark):
    names = ["doc_id", "TEXT", "copies", "suspect", "block", "bitmap", "text_sha256", "group_sha256", "group_id", "group_rows", "a.b"]
    docs = spark.createDataFrame([(1, "x", *range(9)), (2, "x", *range(9)), (3, "y", *range(9))], names)
    found, copies = exact_dedup.exact_duplicates(docs)
    assert found.columns == [*names, "copies_"] and copies == "copies_"
    assert sorted(r.doc_id for r in found.filter("copies_.kept").collect()) == [1, 3]


def test_only_possibly_repeated_rows_are_shuffled(spark, small):
    """A text with two clear slots is in no exchange of the rows: its branch holds broadcasts only."""
    docs = spark.range(2000).selectExpr("id AS doc_id", "concat('text number ', id) AS text")
    found, copies = exact_dedup.exact_duplicates(docs)
    assert found.count() == 2000
    bits = exact_dedup.repeated_slots(docs.withColumn("sha", exact_dedup.normalised("text")), "sha", 8)
    assert bits.selectExpr("sum(bitmap_count(bitmap)) AS n").first()["n"] < 200


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_the_query_equals_its_sql(spark, sf):
    sf_dir = f"/root/testdata/{sf}"
    assert differences(queries.op12_exact_dedup(spark, sf_dir), connect(sf_dir), queries.EXACT_DUPLICATES) == []
