"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Each text is the set of its hashed n-grams of a word and its borders.  Every
n-gram has the log ratio of its share among toxic and among other training
texts; the classifier is a linear separator over these ratios.  N-grams are
ranked by how far their counts are from independence of the label.  The
strongest have a coefficient each, and all others share one for their ratios,
so every n-gram of the training texts has a weight.

Ratios are counted on all training texts; only the separator is fitted on a
sample.  A text's own n-grams make its ratios look clearer than those of a new
text, so the shared coefficient is fitted on ratios from the other half.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType, StringType

from ordermill.llm import buffers
from ordermill.llm.exact_dedup import BLOCK, BLOCKS, is_set
from ordermill.llm.grams import grams, labelled_sample, one_text
from ordermill.llm.storage import stored

SIZES, BITS, BLOCKS = (3, 4, 5, 6), 20, 32

#: Log odds for a margin of one.
STEEP = 3.0

#: Bits of the labelled ids' bitmaps for each of them, while ``BLOCKS`` allows.
SPARSE = 16


class Model(NamedTuple):
    """The weight (ratio times coefficient) of every n-gram hash, zero if it was not seen, and the intercept."""

    weight: np.ndarray
    intercept: float


def text_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (text, n-gram hash) of all texts, in order of the texts.

    Each text writes its n-grams' places into a table of all hashes; the last of
    equal ones finds its own there.
    """
    owner, code = grams(texts, SIZES, BITS)
    edges = [0, *(np.flatnonzero(owner[1:] < owner[:-1]) + 1).tolist(), len(owner)]
    parts = [np.searchsorted(owner[a:b], np.arange(len(texts) + 1)) + a for a, b in zip(edges[:-1], edges[1:], strict=True)]
    last, found = np.zeros(1 << BITS, dtype=np.int32), []
    for i in range(len(texts)):
        own = np.concatenate([code[bounds[i] : bounds[i + 1]] for bounds in parts])
        place = np.arange(len(own), dtype=np.int32)
        last[own] = place
        found.append(own[last[own] == place])
    count = [len(x) for x in found]
    return np.repeat(np.arange(len(texts)), count), np.concatenate(found) if found else np.zeros(0, np.int64)


def half(text: str = "text") -> Column:
    """0 or 1 by the hash of the text."""
    return F.pmod(F.coalesce(F.xxhash64(text), F.lit(0)), F.lit(2)).cast("int")


def gram_counts(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """In how many texts of each label and half each n-gram hash is, and the texts of each; ``rows`` has text, label.

    Tasks add up their texts in one array of a fixed size and shuffle it in blocks.
    """
    width = (1 << BITS) // BLOCKS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # One more block counts the texts.
        totals = np.zeros((4, width * (BLOCKS + 1)), dtype=np.int32)
        for batch in buffers.slices(batches, limit=buffers.CHUNK // 2):
            owner, code = text_sets(batch.column("text"))
            kind = 2 * batch.column("label").to_numpy() + batch.column("half").to_numpy()
            for k in range(4):
                totals[k, : 1 << BITS] += np.bincount(code[kind[owner] == k], minlength=1 << BITS).astype(np.int32)
                totals[k, 1 << BITS] += np.count_nonzero(kind == k)
        if totals.any():
            parts = [pa.compress(totals[:, b * width : (b + 1) * width].tobytes(), codec="zstd", asbytes=True) for b in range(BLOCKS + 1)]
            yield pa.RecordBatch.from_arrays([pa.array(range(BLOCKS + 1), pa.int32()), pa.array(parts, pa.binary())], names=["block", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, packed in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                found = np.frombuffer(pa.decompress(packed, decompressed_size=16 * width, codec="zstd", asbytes=True), np.int32)
                totals[block] = totals.get(block, 0) + found.reshape(4, width).astype(np.int64)
        for block, sums in totals.items():
            packed = pa.compress(sums.tobytes(), codec="zstd", asbytes=True)
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([packed], pa.binary())], names=["block", "counts"])

    partial = rows.select("text", F.col("label").cast("int"), half().alias("half")).mapInArrow(count, "block int, counts binary")
    out = np.zeros((4, width * (BLOCKS + 1)), dtype=np.int64)
    for r in partial.repartition(BLOCKS, "block").mapInArrow(add, "block int, counts binary").collect():
        sums = np.frombuffer(pa.decompress(r["counts"], decompressed_size=32 * width, codec="zstd", asbytes=True), np.int64)
        out[:, r["block"] * width : (r["block"] + 1) * width] = sums.reshape(4, width)
    return out[:, : 1 << BITS].reshape(2, 2, 1 << BITS), out[:, 1 << BITS].reshape(2, 2)


def even_ratios(toxic: np.ndarray, other: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """Log ratios smoothed by the labels' shares, so an n-gram that was not seen says nothing."""
    if not n1 or not n0:
        return np.zeros(len(toxic))
    return np.where(toxic + other > 0, np.log((toxic + n1 / (n1 + n0)) / n1) - np.log((other + n0 / (n1 + n0)) / n0), 0.0)


def train(rows: DataFrame, sample: DataFrame, keep: int) -> Model:
    """Count ratios on ``rows`` and fit on ``sample`` (both text, label 0 or 1); ``sample`` must be bounded.

    ``keep`` n-grams get a coefficient of their own.
    """
    counts, sizes = gram_counts(rows)
    (other, toxic), (n0, n1) = counts.sum(axis=1), sizes.sum(axis=1)
    if not n1 or not n0:
        return Model(np.zeros(1 << BITS), 6.0 if n1 else -6.0)
    ratio = np.log((toxic + 1) / (n1 + 2)) - np.log((other + 1) / (n0 + 2))
    surprise = np.abs(ratio) * np.abs(toxic / n1 - other / n0)
    seen = np.flatnonzero(toxic + other)
    feature = np.sort(seen[np.argsort(-surprise[seen], kind="stable")[:keep]])
    weight = even_ratios(toxic, other, n1, n0)
    halves = np.stack([even_ratios(counts[1, h], counts[0, h], sizes[1, h], sizes[0, h]) for h in (1, 0)])
    halves[:, feature] = 0.0
    held = sample.sparkSession.sparkContext.broadcast((feature, halves))

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        feature, halves = held.value
        for batch in buffers.slices(batches, limit=buffers.CHUNK // 2):
            owner, code = text_sets(batch.column("text"))
            rest = np.bincount(owner, weights=halves[batch.column("half").to_numpy()[owner], code], minlength=batch.num_rows)
            place = np.full(1 << BITS, -1, dtype=np.int32)
            place[feature] = np.arange(len(feature))
            chosen = place[code] >= 0
            places = place[code[chosen]].astype("<u2").view(np.uint8)
            bounds = np.searchsorted(owner[chosen], np.arange(batch.num_rows + 1))
            yield pa.RecordBatch.from_arrays([batch.column("label"), buffers.binaries(places, 2 * bounds).cast(pa.binary()), pa.array(rest)], names=["label", "places", "rest"])

    found = sample.select(F.col("label").cast("int"), "text", half().alias("half")).mapInArrow(select, "label int, places binary, rest double").collect()
    found.sort(key=lambda r: (r["label"], r["places"], r["rest"]))
    places = [np.frombuffer(r["places"], "<u2").astype(np.int64) for r in found]
    row = np.repeat(np.arange(len(found)), [len(x) for x in places])
    column = np.concatenate(places) if places else np.zeros(0, np.int64)
    rest = np.array([r["rest"] for r in found])
    unit = rest.std() if len(rest) and rest.std() > 0 else 1.0
    coefficient, shared, intercept = separate(row, column, ratio[feature], rest / unit, np.array([r["label"] for r in found], dtype=np.float64))
    weight *= STEEP * shared / unit
    weight[feature] = STEEP * coefficient * ratio[feature]
    return Model(weight, STEEP * intercept)


def separate(row: np.ndarray, column: np.ndarray, scale: np.ndarray, rest: np.ndarray, label: np.ndarray, cost: float = 0.1, rounds: int = 30) -> tuple[np.ndarray, float, float]:
    """Coefficients, that of ``rest``, and intercept of a linear separator with squared hinge loss, by dual coordinate descent.

    Feature ``column`` of ``row`` has the value ``scale[column]``, and one more
    feature is ``rest``; both labels weigh the same.
    """
    bounds = np.searchsorted(row, np.arange(len(label) + 1))
    sign, draw = np.where(label > 0, 1.0, -1.0), np.random.default_rng(0)
    soft = 0.5 / cost * np.where(label > 0, 2 * label.mean(), 2 * (1 - label.mean()))
    places = [column[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    values = [scale[p] for p in places]
    square = np.array([v @ v + 1 for v in values]) + rest * rest + soft
    alpha, weight, shared, bias = np.zeros(len(label)), np.zeros(len(scale)), 0.0, 0.0
    for _ in range(rounds):
        for i in draw.permutation(len(label)):
            gradient = sign[i] * (weight[places[i]] @ values[i] + shared * rest[i] + bias) - 1 + soft[i] * alpha[i]
            new = max(alpha[i] - gradient / square[i], 0.0)
            if new != alpha[i]:
                change = (new - alpha[i]) * sign[i]
                weight[places[i]] += change * values[i]
                shared += change * rest[i]
                bias += change
                alpha[i] = new
    return weight, float(shared), float(bias)


def score(docs: DataFrame, model: Model, text: str = "text", into: str = "score") -> DataFrame:
    """All rows and columns of ``docs``, and the probability ``into`` that the text is toxic.

    A null or empty text has no n-gram and gets what the intercept says; equal
    texts get equal scores.  ``into`` must not be a column of ``docs`` already.
    """
    names = docs.columns
    held = docs.sparkSession.sparkContext.broadcast(model)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, intercept = held.value
        for batch in buffers.slices(batches, text, buffers.CHUNK // 2):
            owner, code = text_sets(batch.column(text))
            margin = np.bincount(owner, weights=weight[code], minlength=batch.num_rows) + intercept
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(1 / (1 + np.exp(-np.clip(margin, -30, 30))))], names=[*names, into])

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields]
    return docs.mapInArrow(apply, ", ".join([*kinds, f"`{into}` double"]))


def perhaps_labelled(texts: DataFrame, known: DataFrame) -> DataFrame:
    """``texts`` (``doc_id, text``) without most rows whose id ``known`` has not; every row whose id it has stays.

    Bitmaps of the known ids, bounded in size, are broadcast however many ids
    there are, so a text without a label mostly ends in the task that reads it.
    Ids that may be equal without the same bytes all stay.
    """
    kinds = {rows.schema["doc_id"].dataType for rows in (texts, known)}
    if len(kinds) > 1 or not kinds <= {ByteType(), ShortType(), IntegerType(), LongType(), StringType()}:
        return texts
    blocks = min(BLOCKS, max(1, -(-SPARSE * known.count() // BLOCK)))
    block, place = F.pmod(F.xxhash64("doc_id"), F.lit(blocks)), F.xxhash64(F.lit(1), "doc_id").bitwiseAND(F.lit(BLOCK - 1))
    bitmaps = known.groupBy(block.alias("_block")).agg(F.bitmap_construct_agg(place).alias("_bits"))
    return texts.join(F.broadcast(bitmaps), block == F.col("_block")).filter(is_set("_bits", place)).select("doc_id", "text")


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, per_label: int = 8192, keep: int = 2048, doc_id: str = "doc_id", text: str = "text", label: str = "toxic"
) -> Model:
    """Train on the texts of labelled documents.

    ``labels`` has ``doc_id`` and ``label`` (0 or 1; rows with other values, a
    null id or no document are left out).  Ratios are counted on all of them,
    each document once however many rows it has; the separator is fitted on at
    most ``per_label`` documents of each label, whose ids are few enough to be
    broadcast.  With no row of one label the model says the other.
    """
    known = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("label")).filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
    known = known.distinct()
    chosen = labelled_sample(known, "label", "doc_id", per_label)
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = one_text(perhaps_labelled(texts, known), "doc_id").join(known, "doc_id").select("text", "label")
    sample = one_text(texts.join(F.broadcast(chosen), "doc_id"), "doc_id", "label").select("text", "label")
    return train(rows, stored(sample, "toxic-sample"), keep)
