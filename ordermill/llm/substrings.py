"""Substring deduplication: repeated windows of words, counted in super-k-mer buckets.

A window belongs to the bucket of its minimiser, the smallest hash of a few
consecutive words in it.  Neighbouring windows mostly share their minimiser, so
they travel together as one packed string of words.  In its bucket every window
meets all windows with the same words, and sorting finds the first of them.

Each task first does the same over its own texts: a window that starts earlier
in them is settled there, and only the first travels.  Buckets are folded piece
by piece, keeping one place of each window, so a passage that a third of all
documents share costs a bucket no more than a rare one.

Different windows around one frequent minimiser do not fold.  The bytes of all
buckets are measured first, and the windows of a bucket with too many are dealt
by a hash of the whole window, which still brings equal ones together.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm import buffers
from ordermill.llm.quality_rules import fresh_name

#: Words in a minimiser; packed bytes of a bucket, and of what is folded at once.
MINIMISER, BUCKET, FOLD = 3, 6 << 20, 8 << 20

#: Unpacked bytes of different windows from which a bucket is dealt by whole windows.
HEAVY = 16 << 20

#: The order key of a null id: before all others.
NULL_ID = -(1 << 63)


class Runs(NamedTuple):
    """Stretches of words: the document (id, variant), the first word's place in it, and the words."""

    doc: np.ndarray
    variant: np.ndarray
    place: np.ndarray
    words: buffers.Words


def first_places(runs: Runs, size: int) -> tuple[Runs, np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Find windows that start earlier in ``runs``.

    Returns the runs in order of place, the start of every window (as a word
    number), which of these are first, the words' codes and the distinct words.
    """
    order = np.lexsort((runs.place, runs.variant, runs.doc))
    w = runs.words
    count = np.diff(w.first)[order]
    index = buffers.ragged(w.first[:-1][order], count)
    words = buffers.Words(w.data, w.start[index], w.end[index], np.concatenate(([0], np.cumsum(count))))
    runs = Runs(runs.doc[order], runs.variant[order], runs.place[order], words)
    code, distinct = buffers.numbered(buffers.word_array(words))
    starts = buffers.inside(words.first, size)
    owner = np.searchsorted(words.first, starts, side="right") - 1
    by, fresh = buffers.equal_windows(code, starts, size)
    # The same place of the same document can be there twice; neither is earlier.
    document = np.cumsum(np.concatenate(([0], (runs.doc[1:] != runs.doc[:-1]) | (runs.variant[1:] != runs.variant[:-1])))) if len(order) else order
    at = runs.place[owner] + starts - words.first[owner]
    head = by[np.maximum.accumulate(np.where(fresh, np.arange(len(by)), 0))] if len(by) else by
    first = np.ones(len(starts), dtype=bool)
    first[by] = (document[owner[by]] == document[owner[head]]) & (at[by] == at[head])
    return runs, starts, first, code, distinct


def stretches(starts: np.ndarray, owner: np.ndarray, chosen: np.ndarray, group: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Runs of chosen consecutive windows of one owner (and one group): places in ``starts``, and lengths."""
    at = np.flatnonzero(chosen)
    if not len(at):
        return at, at
    cut = (starts[at[1:]] != starts[at[:-1]] + 1) | (owner[at[1:]] != owner[at[:-1]])
    if group is not None:
        cut |= group[at[1:]] != group[at[:-1]]
    begin = np.flatnonzero(np.concatenate(([True], cut)))
    return at[begin], np.diff(np.append(begin, len(at)))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` consecutive values."""
    span, out = 1, values
    while 2 * span <= width:
        out = np.minimum(out[: len(out) - span], out[span:])
        span *= 2
    rest = width - span
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def packed(runs: Runs, first_word: np.ndarray, n_words: np.ndarray, owner: np.ndarray, text: np.ndarray, bounds: np.ndarray, rows: slice) -> bytes:
    """Some stretches as one compressed string: how many, their places and sizes, and their words with a space after each."""
    a, n, d = first_word[rows], n_words[rows], owner[rows]
    body = text[buffers.ragged(bounds[a], bounds[a + n] - bounds[a])]
    place = runs.place[d] + a - runs.words.first[d]
    parts = (np.array([len(a)]), runs.doc[d], runs.variant[d], place, n)
    return pa.compress(b"".join(p.astype(np.int64).tobytes() for p in parts) + body.tobytes(), codec="zstd", asbytes=True)


def unpacked(blobs: list[tuple[bytes, int]]) -> Runs:
    """The stretches of some packed strings (each with its size unpacked)."""
    columns: list[list[np.ndarray]] = [[], [], [], []]
    bodies = []
    for blob, size in blobs:
        raw = pa.decompress(blob, decompressed_size=size, codec="zstd", asbytes=True)
        n = int(np.frombuffer(raw, np.int64, 1)[0])
        for i, column in enumerate(columns):
            column.append(np.frombuffer(raw, np.int64, n, 8 + 8 * n * i))
        bodies.append(np.frombuffer(raw, np.uint8, offset=8 + 32 * n))
    doc, variant, place, n_words = (np.concatenate(c) for c in columns)
    data = np.concatenate(bodies)
    gap = np.flatnonzero(data == 32)
    start = np.concatenate(([0], gap[:-1] + 1)) if len(gap) else gap
    return Runs(doc, variant, place, buffers.Words(data, start, gap, np.concatenate(([0], np.cumsum(n_words)))))


def spaced_words(words: buffers.Words) -> tuple[np.ndarray, np.ndarray]:
    """All words with a space after each, and where each begins."""
    length = words.end - words.start
    bounds = np.concatenate(([0], np.cumsum(length + 1)))
    text = np.full(int(bounds[-1]), 32, dtype=np.uint8)
    text[buffers.ragged(bounds[:-1], length)] = words.data[buffers.ragged(words.start, length)]
    return text, bounds


def spans(runs: Runs, starts: np.ndarray, first: np.ndarray, size: int) -> list[np.ndarray]:
    """Documents and word ranges that windows starting earlier elsewhere cover."""
    owner = np.searchsorted(runs.words.first, starts, side="right") - 1
    at, n = stretches(starts, owner, ~first)
    low = runs.place[owner[at]] + starts[at] - runs.words.first[owner[at]]
    return [runs.doc[owner[at]], runs.variant[owner[at]], low, low + n - 1 + size]


def row_batch(bucket, blob, size, found: list[np.ndarray] | None) -> pa.RecordBatch:
    n = len(bucket)
    empty = pa.nulls(n, pa.int64())
    found = [empty] * 4 if found is None else [pa.array(x, pa.int64()) for x in found]
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket, pa.int32()), pa.nulls(n, pa.binary()) if blob is None else pa.array(blob, pa.binary()), empty if size is None else pa.array(size, pa.int64()), *found],
        names=["bucket", "blob", "size", "doc", "variant", "low", "high"],
    )


_ROW = "bucket int, blob binary, size long, doc long, variant long, low long, high long"


def least_keys(hashes: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """The minimiser of each window that begins at ``starts``; ``hashes`` are those of the words."""
    return sliding_min(buffers.window_keys(hashes, MINIMISER), size - MINIMISER + 1)[starts]


def heavy_buckets(docs: DataFrame, size: int, buckets: int, total: int, chunk: int = buffers.CHUNK) -> tuple[np.ndarray, int]:
    """Buckets with more than ``HEAVY`` bytes, and the bytes of their windows when each is packed alone.

    Windows that a chunk of text repeats count once, as only one travels.  A
    chunk is silent on buckets with less than its share of a quarter of
    ``HEAVY``, so what is silent adds up to a quarter at most and the rest is
    compared with three quarters.  ``total`` is the bytes of all texts.
    """

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in buffers.slices(batches, limit=chunk):
            w = buffers.words(batch.column("text"))
            starts = buffers.inside(w.first, size)
            if not len(starts):
                continue
            silent = HEAVY / 4 * pa.compute.sum(pa.compute.binary_length(batch.column("text"))).as_py() / max(total, 1)
            hashes = buffers.span_hashes(w.data, w.start, w.end)
            bucket = (buffers.mixed(least_keys(hashes, starts, size)) % np.uint64(buckets)).astype(np.int64)
            owner = np.searchsorted(w.first, starts, side="right") - 1
            bounds = np.concatenate(([0], np.cumsum(w.end - w.start + 1)))

            def sizes(chosen: np.ndarray) -> np.ndarray:
                at, n = stretches(starts, owner, chosen, bucket)
                return np.bincount(bucket[at], weights=32 + bounds[starts[at] + n + size - 1] - bounds[starts[at]], minlength=buckets)

            loud = sizes(np.ones(len(starts), dtype=bool)) > silent
            maybe = np.flatnonzero(loud[bucket])
            if not len(maybe):
                continue
            _, once = np.unique(buffers.window_keys(hashes, size)[starts[maybe]], return_index=True)
            chosen = np.zeros(len(starts), dtype=bool)
            chosen[maybe[once]] = True
            packed_size = sizes(chosen)
            alone = np.bincount(bucket[chosen], weights=32 + bounds[starts[chosen] + size] - bounds[starts[chosen]], minlength=buckets)
            told = np.flatnonzero(packed_size > silent)
            yield pa.RecordBatch.from_arrays([pa.array(told, pa.int32()), pa.array(packed_size[told].astype(np.int64)), pa.array(alone[told].astype(np.int64))], names=["bucket", "size", "alone"])

    sums = docs.select("text").mapInArrow(measure, "bucket int, size long, alone long").groupBy("bucket").agg(F.sum("size").alias("size"), F.sum("alone").alias("alone"))
    found = sums.filter(F.col("size") > HEAVY * 3 // 4).collect()
    return np.array(sorted(r["bucket"] for r in found), dtype=np.int64), sum(r["alone"] for r in found)


def super_k_mers(docs: DataFrame, size: int, buckets: int, heavy: np.ndarray, extra: int, chunk: int = buffers.CHUNK) -> DataFrame:
    """Packed strings by bucket, and the spans that a task finds by itself; ``docs`` has doc, variant, text.

    Windows of the buckets in ``heavy`` go to one of ``extra`` more buckets, by all their words.
    """

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in buffers.slices(batches, limit=chunk):
            runs = Runs(batch.column("doc").to_numpy(), batch.column("variant").to_numpy(), np.zeros(batch.num_rows, np.int64), buffers.words(batch.column("text")))
            runs, starts, first, code, distinct = first_places(runs, size)
            if not len(starts):
                continue
            found = spans(runs, starts, first, size)
            yield row_batch(((found[0] ^ found[2]) % buckets).astype(np.int32), None, None, found)
            ends = np.frombuffer(distinct.buffers()[1], np.int64)[distinct.offset : distinct.offset + len(distinct) + 1]
            data = np.frombuffer(distinct.buffers()[2], np.uint8)
            hashes = buffers.span_hashes(data, ends[:-1], ends[1:])[code]
            bucket = (buffers.mixed(least_keys(hashes, starts, size)) % np.uint64(buckets)).astype(np.int64)
            if len(heavy):
                split_up = np.flatnonzero(np.isin(bucket, heavy))
                whole = buffers.window_keys(hashes, size)[starts[split_up]]
                bucket[split_up] = buckets + (buffers.mixed(whole) % np.uint64(extra)).astype(np.int64)
            del hashes, code, distinct, data
            owner = np.searchsorted(runs.words.first, starts, side="right") - 1
            at, n = stretches(starts, owner, first, bucket)
            bucket = bucket[at]
            by = np.argsort(bucket, kind="stable")
            at, n, bucket = at[by], n[by] + size - 1, bucket[by]
            text, bounds = spaced_words(runs.words)
            cuts = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket))
            blobs, sizes = [], []
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                blobs.append(packed(runs, starts[at], n, owner[at], text, bounds, slice(a, b)))
                sizes.append(int(8 + 32 * (b - a) + (bounds[starts[at[a:b]] + n[a:b]] - bounds[starts[at[a:b]]]).sum()))
            yield row_batch(bucket[cuts[:-1]].astype(np.int32), blobs, sizes, None)

    return docs.mapInArrow(split, _ROW)


def later_spans(rows: DataFrame, size: int, piece: int) -> DataFrame:
    """``doc, variant, low, high`` of all windows that start earlier elsewhere; a partition has its buckets in order.

    ``piece`` is the packed bytes that are folded at once.
    """

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, waiting, held = None, [], 0

        def settle(keep: bool) -> list[pa.RecordBatch]:
            nonlocal waiting, held
            runs, starts, first, _, _ = first_places(unpacked(waiting), size)
            waiting, held = [], 0
            if keep and len(starts):
                owner = np.searchsorted(runs.words.first, starts, side="right") - 1
                at, n = stretches(starts, owner, first)
                text, bounds = spaced_words(runs.words)
                blob = packed(runs, starts[at], n + size - 1, owner[at], text, bounds, slice(None))
                held = int(8 + 32 * len(at) + (bounds[starts[at] + n + size - 1] - bounds[starts[at]]).sum())
                waiting = [(blob, held)]
            found = spans(runs, starts, first, size)
            return [pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], names=["doc", "variant", "low", "high"])]

        kept = 0
        for batch in batches:
            own = batch.column("blob").is_null()
            yield batch.filter(own).select(["doc", "variant", "low", "high"])
            rest = batch.filter(pa.compute.invert(own))
            for b, blob, n in zip(*(rest.column(c).to_pylist() for c in ("bucket", "blob", "size")), strict=True):
                if b != bucket and waiting:
                    yield from settle(False)
                if b != bucket:
                    bucket, kept = b, 0
                waiting.append((blob, n))
                held += n
                # What stays is read again, so the next fold waits for as much anew.
                if held > piece + 2 * kept:
                    yield from settle(True)
                    kept = held
        if waiting:
            yield from settle(False)

    return rows.mapInArrow(fold, "doc long, variant long, low long, high long")


def remove_repeats(
    docs: DataFrame, size: int = 20, doc_id: str = "doc_id", text: str = "text", into: str = "_", fold: int | None = None, chunk: int = buffers.CHUNK
) -> DataFrame:
    """All rows and columns of ``docs``, with ``_n_words``, ``_n_removed`` and ``_kept`` (kept words, one space between).

    ``into`` is what the three new names begin with; a name that ``docs`` has
    already raises, and its other columns may have any name.  ``fold`` is the
    bytes of windows folded at once (``FOLD``), ``chunk`` the bytes of text cut at
    once: fewer take less memory and more time, and with smaller chunks more travels.

    A window is ``size`` consecutive words of one document.  Words covered by a
    window whose words also start earlier (smaller id, or same document and
    earlier) are removed; windows are judged on the input.  A null id is before
    all others.  Rows that share an id are ordered by a hash of their texts; rows
    equal in both are one document and get equal results.  A null text has no
    words.  Texts shorter than a window and empty tables pass unchanged.
    """
    results = [f"{into}{c}" for c in ("n_words", "n_removed", "kept")]
    if any(fresh_name(docs, c) != c for c in results):
        raise ValueError(f"columns named {results} are there already; choose another beginning")
    spark = docs.sparkSession
    key = F.coalesce(F.col(doc_id).cast("long"), F.lit(NULL_ID))
    per_id = docs.groupBy(key.alias("key")).agg(F.count("*").alias("n"), F.sum(F.octet_length(text)).alias("size"))
    most, total = per_id.agg(F.max("n"), F.coalesce(F.sum("size"), F.lit(0))).first()
    variant = F.coalesce(F.xxhash64(text), F.lit(0)) if (most or 0) > 1 else F.lit(0).cast("long")
    expected = 3 * int(total)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-expected // (64 << 20)))
    buckets = max(8 * parts, -(-expected // BUCKET))
    sources = docs.select(key.alias("doc"), variant.alias("variant"), F.col(text).alias("text"))
    heavy, alone = heavy_buckets(sources, size, buckets, int(total), chunk)
    extra = max(1, -(-4 * alone // (3 * BUCKET)))
    parts += -(-alone // (64 << 20))
    rows = super_k_mers(sources, size, buckets, heavy, extra, chunk).repartition(parts, "bucket").sortWithinPartitions("bucket")
    found = later_spans(rows, size, FOLD if fold is None else fold).groupBy("doc", "variant").agg(F.collect_list(F.struct("low", "high")).alias("spans"))
    names = docs.columns
    doc, version, spans, at, which = (fresh_name(docs, c) for c in ("doc", "variant", "spans", "found_doc", "found_variant"))
    keyed = docs.withColumns({doc: key, version: variant})
    joined = keyed.join(found.toDF(at, which, spans), (F.col(doc) == F.col(at)) & (F.col(version) == F.col(which)), "left")
    joined = joined.select(*[F.col(f"`{c}`") for c in names], spans)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in buffers.slices(batches, text, chunk):
            w = buffers.words(batch.column(text))
            column = batch.column(spans)
            flat, owner = column.flatten(), np.repeat(np.arange(batch.num_rows), pa.compute.fill_null(pa.compute.list_value_length(column), 0).to_numpy(zero_copy_only=False))
            edge = np.zeros(len(w.start) + 1, dtype=np.int64)
            for field, step in (("low", 1), ("high", -1)):
                np.add.at(edge, w.first[owner] + flat.field(field).to_numpy(zero_copy_only=False).astype(np.int64), step)
            stays = np.cumsum(edge[:-1]) == 0
            total = np.diff(w.first)
            count = buffers.per_text(stays, w.first)
            kept = buffers.Words(w.data, w.start[stays], w.end[stays], np.concatenate(([0], np.cumsum(count))))
            text_bytes, bounds = spaced_words(kept)
            begin, end = bounds[kept.first[:-1]], bounds[kept.first[1:]]
            length = end - begin - (count > 0)
            body = text_bytes[buffers.ragged(begin, length)]
            kept_text = buffers.binaries(body, np.concatenate(([0], np.cumsum(length)))).cast(pa.large_string()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*batch.select(names).columns, pa.array(total), pa.array(total - count), kept_text], names=[*names, *results])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return joined.mapInArrow(cut, f"{kinds}, `{results[0]}` long, `{results[1]}` long, `{results[2]}` string")
