"""Best-two-fit packing of documents into sequences of a fixed number of tokens.

Only lengths matter for packing, and there are at most ``capacity`` of them.  So
the plan is made from the histogram of piece lengths: which lengths share a
sequence, and how often that pattern repeats.  The histogram and the plan have
a bounded size whatever the corpus.  Every piece then finds its place from its
rank among the pieces of its length, which tasks number on their own and one
running sum over tasks makes global.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm import buffers
from ordermill.llm.encoders import byte_units, load
from ordermill.llm.storage import stored


class Pattern(NamedTuple):
    """``times`` sequences that each hold ``lengths``, in that order."""

    lengths: tuple[int, ...]
    times: int


def plan_sequences(histogram: dict[int, int], capacity: int) -> list[Pattern]:
    """Best-two-fit over a histogram of lengths, filling equal sequences together.

    A sequence takes the longest piece that fits until none does.  Then its
    shortest piece gives way to the two unpacked pieces that together fill the
    widened gap best, if they fill more than it did.  A sequence repeats as often
    as the pieces left allow the very same choices.
    """
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in histogram.items():
        left[length] = n
    out = []
    while (longest := int(left.nonzero()[0][-1]) if left.any() else 0):
        greedy: Counter[int] = Counter()
        free = left.copy()
        gap, length = capacity, longest
        while length:
            take = min(int(free[length]), gap // length)
            greedy[length] += take
            free[length] -= take
            gap -= take * length
            fitting = free[: gap + 1].nonzero()[0]
            length = int(fitting[-1]) if len(fitting) else 0
        filled, needed = Counter(greedy), Counter(greedy)
        if gap and sum(greedy.values()) > 1:
            shortest = min(greedy)
            pair = best_pair(free, shortest, gap + shortest)
            if pair:
                filled[shortest] -= 1
                filled.update(pair)
                needed.update(pair)
        filled = +filled
        times = min((int(left[x]) - needed[x]) // filled[x] + 1 for x in filled)
        for x, n in filled.items():
            left[x] -= times * n
        out.append(Pattern(tuple(sorted(filled.elements(), reverse=True)), times))
    return out


def best_pair(free: np.ndarray, more_than: int, room: int) -> tuple[int, int] | None:
    """The two lengths of ``free`` with the largest sum in ``more_than + 1 .. room``; ties to the longest first."""
    long = free[: room + 1].nonzero()[0]
    if not len(long):
        return None
    # For each length, the longest one that fits beside it and is no longer than it.
    below = np.maximum.accumulate(np.where(free[: room + 1] > 0, np.arange(room + 1), 0))
    limit = np.minimum(room - long, np.where(free[long] > 1, long, long - 1))
    second = np.where(limit > 0, below[np.maximum(limit, 0)], 0)
    total = np.where(second > 0, long + second, 0)
    best = int(total.max())
    if best <= more_than:
        return None
    i = int(np.flatnonzero(total == best)[-1])
    return int(long[i]), int(second[i])


def cut_documents(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Token ids of all documents in pieces of at most ``capacity``, stored.

    Returns ``doc_id, piece, start, length, ids`` (unsigned 32-bit little-endian
    numbers) with ``task, rank``: the piece's number among those of its length
    in the task that cut it.  A document is its ids and ``end_id``.  Of a longer
    one the first piece takes what is over, all others are full.  A null text is
    an empty one, which has the end only; repeated rows are cut each.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        encoder, ranks = load(tokenizer), np.zeros(capacity + 1, dtype=np.int64)
        cache: dict = buffers.worker_state().setdefault(("ids", tokenizer), {})
        for batch in buffers.slices(batches, limit=buffers.CHUNK // 2):
            ids, ends = encoded(batch.column("text"), encoder, cache, end_id)
            size = np.diff(ends)
            n = -(-size // capacity)
            doc = np.repeat(np.arange(len(n)), n)
            piece = buffers.ragged(np.zeros(len(n), dtype=np.int64), n)
            over = size - (n - 1) * capacity
            start = np.where(piece == 0, 0, over[doc] + (piece - 1) * capacity)
            length = np.where(piece == 0, over[doc], capacity)
            order = np.argsort(length, kind="stable")
            by = length[order]
            within = np.arange(len(by)) - np.searchsorted(by, by)
            rank = np.empty(len(by), dtype=np.int64)
            rank[order] = ranks[by] + within
            ranks += np.bincount(length, minlength=capacity + 1)
            cuts = np.concatenate((ends[:-1][doc] + start, ends[-1:])) * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), buffers.binaries(ids.view(np.uint8), cuts).cast(pa.binary()), pa.array(np.full(len(doc), task), pa.int32()), pa.array(rank)],
                names=["doc_id", "piece", "start", "length", "ids", "task", "rank"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return stored(docs.mapInArrow(cut, f"doc_id {kind}, piece int, start long, length long, ids binary, task int, rank long"), "pieces")


def encoded(texts: pa.Array, encoder, cache: dict, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts, each closed by ``end_id``, and where each text's begin."""
    data, start, first = byte_units(texts)
    code, size, pool = through_table(cache, buffers.binaries(data, np.concatenate((start, [len(data)]))), encoder.byte_ids)
    at = np.cumsum(size) - size
    sums = np.concatenate(([0], np.cumsum(size[code])))
    n = sums[first[1:]] - sums[first[:-1]]
    body = pool[buffers.ragged(at[code], size[code])]
    whole = {int(d): np.array(encoder.ids(texts[int(d)].as_py()), dtype=np.uint32) for d in encoder.whole(texts)}
    if whole:
        parts = np.split(body, np.cumsum(n)[:-1])
        for d, ids in whole.items():
            parts[d], n[d] = ids, len(ids)
        body = np.concatenate(parts)
    return np.insert(body, np.cumsum(n), np.uint32(end_id)), np.concatenate(([0], np.cumsum(n + 1)))


def through_table(
    cache: dict, units: pa.Array, encode: Callable, most: int = 350_000, size: int = 32 << 20
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The number of each unit, how many ids the unit of each number has, and the ids of all numbers in turn.

    ``encode`` is asked for units that ``cache`` lacks, each once.  The cache is a
    table of arrays: its units are numbered first, then the new ones, in a single
    pass.  Beyond ``most`` units or ``size`` bytes, units and ids, it keeps half
    of that: the units met in the most calls, of equals the newest, and none of more
    than a hundredth of ``size``.  Nothing but time depends on what it holds.
    """
    held = cache.get("units", pa.array([], pa.large_binary()))
    code, known = buffers.numbered(pa.concat_arrays([held, units]))
    code = code[len(held) :]
    ids, n = encode(known.slice(len(held)))
    if len(held):
        ids, n = np.concatenate((cache["ids"], ids)), np.concatenate((cache["n"], n))
    met = np.zeros(len(known), dtype=np.int64)
    met[code] = 1
    met[: len(held)] += cache.get("met", 0)
    cache.update(units=known, ids=ids, n=n, met=met)
    weight = pc.binary_length(known).to_numpy() + ids.itemsize * n
    if len(known) > most or weight.sum() > size:
        order = np.lexsort((-np.arange(len(known)), -met))
        order = order[weight[order] <= size // 100][: most // 2]
        keep = np.sort(order[np.cumsum(weight[order]) <= size // 2])
        at = np.cumsum(n) - n
        cache.update(units=known.take(pa.array(keep)), ids=ids[buffers.ragged(at[keep], n[keep])], n=n[keep], met=met[keep] // 2)
    return code, n, ids


def place(pieces: DataFrame, capacity: int) -> DataFrame:
    """Add ``sequence_id, offset`` to rows with ``task, length, rank``, which it drops."""
    counts = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    counts = stored(counts, "piece-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"))
    ranked = pieces.join(base, ["length", "task"]).withColumn("rank", F.col("rank") + F.col("_base")).drop("_base", "task")
    slots = slot_table(plan_sequences(histogram, capacity), capacity)
    names = [c for c in ranked.columns if c != "rank"]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin, rows, order = slots
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            key = length.astype(np.uint64) << np.uint64(48) | rank.astype(np.uint64)
            segment = np.searchsorted(begin, key, side="right") - 1
            into = (key - begin[segment]).astype(np.int64)
            sequence, per, slot = rows[segment].T
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(sequence + into // per), pa.array(order[slot + into % per])],
                names=[*names, "sequence_id", "offset"],
            )

    kinds = ", ".join(f"`{c}` {ranked.schema[c].dataType.simpleString()}" for c in names)
    return ranked.select(*names, "rank").mapInArrow(assign, f"{kinds}, sequence_id long, offset long")


def slot_table(plan: list[Pattern], capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For runs of ranks of a length: key of the first, (first sequence, pieces in each, place in ``order``); offsets."""
    used, begin, rows, order, sequence = np.zeros(capacity + 1, dtype=np.int64), [], [], [], 0
    for lengths, times in plan:
        offsets: dict[int, list[int]] = {}
        at = 0
        for x in lengths:
            offsets.setdefault(x, []).append(at)
            at += x
        for x, places in offsets.items():
            begin.append((x << 48) + int(used[x]))
            rows.append((sequence, len(places), len(order)))
            order += places
            used[x] += times * len(places)
        sequence += times
    by = np.argsort(np.array(begin, dtype=np.uint64))
    return np.array(begin, dtype=np.uint64)[by], np.array(rows, dtype=np.int64).reshape(-1, 3)[by], np.array(order, dtype=np.int64)


def sequences(placed: DataFrame) -> DataFrame:
    """The packed sequences: ``sequence_id, ids``, the ids of placed pieces in order of offset."""
    parts = placed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.aggregate("parts", F.lit(b""), lambda all_ids, part: F.concat(all_ids, part["ids"])).alias("ids"))
