"""Hashed character n-grams of whole texts, and bounded samples of labelled rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm import buffers

#: Bytes as the n-grams see them: A-Z lower-cased, letters and all bytes above ASCII kept, the rest a space.
SEEN = np.full(256, 32, dtype=np.uint8)
SEEN[97:123] = np.arange(97, 123)
SEEN[65:91] = np.arange(97, 123)
SEEN[128:] = np.arange(128, 256)


def spaced(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The letters of all texts, a space before each word and two after each text; where each text begins."""
    data, offsets = buffers.layout(texts)
    data = SEEN[data]
    solid = data != 32
    head = solid.copy()
    head[1:] &= ~solid[:-1]
    begin = offsets[:-1][np.diff(offsets) > 0]
    head[begin] = solid[begin]
    # Each letter moves right by the words begun up to it and by two for each text before.
    shift = np.cumsum(head)
    n = len(offsets) - 1
    before = np.concatenate(([0], np.cumsum(solid)))[offsets] + np.concatenate(([0], shift))[offsets] + 2 * np.arange(n + 1)
    out = np.full(int(before[-1]), 32, dtype=np.uint8)
    letters = np.flatnonzero(solid)
    owner = np.repeat(np.arange(n), np.diff(offsets))[letters]
    out[np.arange(len(letters)) + shift[letters] + 2 * owner] = data[letters]
    return out, before


def grams(texts: pa.Array, sizes: tuple[int, ...], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Every n-gram of at most one word and its borders: the text it is in, and its hash of ``bits`` bits."""
    data, begin = spaced(texts)
    gap = np.concatenate(([0], np.cumsum(data == 32, dtype=np.int64)))
    owner = np.repeat(np.arange(len(begin) - 1, dtype=np.int64), np.diff(begin))
    keys, texts_of, hashes = np.zeros(len(data), dtype=np.uint64), [], []
    for n in range(1, max(sizes) + 1):
        count = max(0, len(data) - n + 1)
        keys = keys[:count] << np.uint64(8) | data[n - 1 : n - 1 + count]
        if n not in sizes:
            continue
        # No space inside, and a letter somewhere: spaces may stand at either end only.
        inner = gap[n - 1 : n - 1 + count] - gap[1 : 1 + count] if n > 2 else np.zeros(count, dtype=np.int64)
        spaces = gap[n : n + count] - gap[:count]
        at = np.flatnonzero((inner == 0) & (spaces < n))
        hashes.append((buffers.mixed(keys[at] + np.uint64(n << 56)) >> np.uint64(64 - bits)).astype(np.int64))
        texts_of.append(owner[at])
    return np.concatenate(texts_of), np.concatenate(hashes)


def trained_on(doc_id: str, modulus: int = 3, held_out: int = 1) -> Column:
    """Whether the CRC of the id as text leaves another remainder than ``held_out``; a null id is never trained on."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus != held_out, F.lit(False))


def labelled_sample(labelled: DataFrame, label: str, key: str, per_label: int) -> DataFrame:
    """At most ``per_label`` rows of each label: those with the smallest hash of the key.

    Hashes lie evenly, so about four times the wanted rows of a label have one
    below a bound that follows from its count.  Only these are shuffled and
    sorted: a frequent label meets no task whole, at any size.
    """
    # One row for each label, as the models have; the classes are what bounds it.
    counts = F.broadcast(labelled.groupBy(label).agg(F.count("*").alias("_rows")))
    place = F.xxhash64(key).cast("double") / 2.0**64 + 0.5
    low = labelled.join(counts, label).filter(place * F.col("_rows") <= 4 * per_label).drop("_rows")
    spread = Window.partitionBy(label).orderBy(F.xxhash64(key), key)
    return low.withColumn("_nth", F.row_number().over(spread)).filter(F.col("_nth") <= per_label).drop("_nth")


def one_text(rows: DataFrame, *keys: str) -> DataFrame:
    """One row for each of ``keys``: of its texts the one with the smallest hash, and of these the smallest.

    Tasks settle this for their own rows first, so a key with many rows meets no task whole.
    """
    least = F.min(F.struct(F.xxhash64("text").alias("hash"), F.col("text").alias("text")))
    return rows.groupBy(*keys).agg(least.alias("_least")).select(*keys, F.col("_least.text").alias("text"))
