"""Exact deduplication in two passes around a blocked Bloom filter.

Pass one reads all texts and keeps two slots of each text's hash.  Slots that are
hit more than once make up the filter: a bitmap of bounded size, built and tested
with SQL functions.  Pass two reads the texts again.  A row with an unset slot
has no equal anywhere and passes straight through; only rows with both slots set,
which are repeated or share their slots by chance, are grouped by their digest.

All of it is DataFrame functions.  Counts and groups combine in each task before
they are shuffled, and rows of frequent groups meet their group's verdict through
a broadcast list of bounded length, so no group of copies meets a task whole.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm.quality_rules import fresh_name
from ordermill.llm.storage import stored

#: Bits of a block of the filter, as ``bitmap_construct_agg`` has it.
BLOCK = 1 << 15

#: Slots for each row, and blocks at most (32 MB): beyond that more rows count as possibly repeated, and results stay the same.
SLOTS, BLOCKS = 32, 1 << 13

#: Groups larger than this, and than their share of all rows, are told by broadcast: ``LISTED`` groups at most.
FREQUENT, LISTED = 64, 1 << 16


def normalised(text: str) -> Column:
    """``text`` with each run of white space as one space; a null is an empty text."""
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def is_set(bitmap: str, position: Column) -> Column:
    """Whether a bit of a block is set; false where there is no block."""
    byte = F.conv(F.hex(F.substr(F.col(bitmap), (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, (position % 8).cast("int")) == 1, F.lit(False))


def slots(digest: str, blocks: int) -> tuple[Column, Column, Column]:
    """The block of a digest, and its two positions in it."""
    place = F.xxhash64(F.lit(1), F.col(digest))
    first, second = place.bitwiseAND(F.lit(BLOCK - 1)), F.shiftrightunsigned(place, 15).bitwiseAND(F.lit(BLOCK - 1))
    return F.pmod(F.xxhash64(digest), F.lit(blocks)), first, second


def repeated_slots(digests: DataFrame, digest: str, blocks: int) -> DataFrame:
    """``block, bitmap`` of all slots that more than one row hits."""
    block, first, second = slots(digest, blocks)
    hit = digests.select(F.explode(F.array(block * BLOCK + first, block * BLOCK + second)).alias("slot"))
    twice = hit.groupBy("slot").agg(F.count("*").alias("n")).filter("n > 1")
    bits = F.bitmap_construct_agg(F.col("slot") % BLOCK).alias("bitmap")
    return twice.groupBy(F.floor(F.col("slot") / BLOCK).alias("block")).agg(bits)


def exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, str]:
    """All rows and columns of ``docs`` with a struct of ``keep_id, group_size, kept, text_sha256``; and that struct's name.

    Texts are equal when they are identical after each run of white space became
    one space; a null text counts as empty.  Of equal texts the row with the
    smallest id stays.  A null id comes after all others, so such a row stays
    only where no row of its group has an id.  Rows equal in text and id are one
    document and get one verdict; each counts for ``group_size``.  Other columns
    may have any name; an empty table gives no rows.
    """
    sha, suspect, at, bits, key, least, n, group = (
        fresh_name(docs, c) for c in ("text_sha256", "suspect", "block", "bitmap", "group_sha256", "group_id", "group_rows", "copies")
    )
    given = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.count()
    blocks = min(BLOCKS, max(1, 2 ** math.ceil(math.log2(max(1, SLOTS * rows / BLOCK)))))
    keyed = docs.withColumn(sha, F.sha2(normalised(text).cast("binary"), 256))
    block, first, second = slots(sha, blocks)
    repeated = F.broadcast(repeated_slots(keyed.select(sha), sha, blocks).toDF(at, bits))
    found = keyed.join(repeated, block == F.col(at), "left").withColumn(suspect, is_set(bits, first) & is_set(bits, second))
    found = found.select(*given, sha, suspect)
    groups = found.filter(F.col(suspect)).groupBy(F.col(sha).alias(key)).agg(F.min(doc_id).alias(least), F.count("*").alias(n))
    # Two joins read the groups; written once, they take one pass over the texts instead of two.
    groups = stored(groups, "copies")
    frequent = F.col(n) > max(FREQUENT, rows / LISTED)
    told = found.join(F.broadcast(groups.filter(frequent)), F.col(sha) == F.col(key), "left")
    through = told.filter(~F.col(suspect) | F.col(key).isNotNull())
    rest = told.filter(F.col(suspect) & F.col(key).isNull()).select(*given, sha)
    dealt = rest.join(groups.filter(~frequent), F.col(sha) == F.col(key))
    single = F.col(n).isNull()
    verdict = F.struct(
        F.when(single, F.col(doc_id)).otherwise(F.col(least)).alias("keep_id"),
        F.coalesce(n, F.lit(1)).alias("group_size"),
        (single | F.col(doc_id).eqNullSafe(F.col(least))).alias("kept"),
        F.col(sha).alias("text_sha256"),
    ).alias(group)
    return through.select(*given, verdict).unionByName(dealt.select(*given, verdict)), group
