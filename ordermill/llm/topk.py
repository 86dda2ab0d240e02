"""Exact top-k search by columnar branch and bound.

Candidates stand in blocks, one row per dimension.  A block adds up inner
products for a few dimensions at a time, the heaviest first.  What the
dimensions left can still add is at most the product of the norms that remain
(Cauchy-Schwarz), so a query keeps only the candidates that may yet reach its
k-th best, and goes on with those alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Candidates and (on average) queries of a block, and dimensions added at a time.
CANDIDATES, QUERIES, STEP = 4096, 512, 8

#: Candidates (on average) that a task compares with a group of queries.
PART = 1 << 16


def vertical_blocks(vectors: DataFrame) -> DataFrame:
    """``dim, ids, width, rows``: blocks of vectors of one length, stored dimension by dimension in ``width`` bytes a number."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list, list]] = {}

        def block(dim: int) -> pa.RecordBatch:
            ids, rows = held.pop(dim)
            matrix = np.stack(rows, axis=1)
            low, high = matrix.min(initial=0), matrix.max(initial=0)
            width = next(w for w in (2, 4, 8) if -(1 << 8 * w - 1) <= low and high < 1 << 8 * w - 1)
            packed = matrix.astype(f"<i{width}").tobytes()
            return pa.RecordBatch.from_arrays(
                [pa.array([dim], pa.int32()), pa.array([np.array(ids, dtype=np.int64).tobytes()], pa.binary()), pa.array([width], pa.int32()), pa.array([packed], pa.binary())],
                names=["dim", "ids", "width", "rows"],
            )

        for batch in batches:
            column = batch.column("vector")
            bounds, flat = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
            for i, a, b in zip(batch.column("id").to_pylist(), bounds[:-1], bounds[1:], strict=True):
                ids, rows = held.setdefault(int(b - a), ([], []))
                ids.append(i)
                rows.append(flat[a:b])
                if len(ids) == CANDIDATES:
                    yield block(int(b - a))
        for dim in list(held):
            yield block(dim)

    return vectors.mapInArrow(pack, "dim int, ids binary, width int, rows binary")


def search_block(queries: np.ndarray, own: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query: its number, and the places in the block and the scores of its k best (all, if fewer)."""
    dim, n = rows.shape
    # Sums below 2 ** 53 are exact as doubles; beyond that, whole numbers take over.
    exact = float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * dim < 2.0**53
    heavy = np.argsort(-(rows.astype(np.float64) ** 2).sum(axis=1), kind="stable")
    kind = np.float64 if exact else np.int64
    c, q = rows[heavy].astype(kind), queries[:, heavy].astype(kind)
    c_left = np.sqrt(np.cumsum((c.astype(np.float64) ** 2)[::-1], axis=0)[::-1])
    q_left = np.sqrt(np.cumsum((q.astype(np.float64) ** 2)[:, ::-1], axis=1)[:, ::-1])
    first = q[:, :STEP] @ c[:STEP]
    for i in range(len(q)):
        alive = np.flatnonzero(ids != own[i])
        part = first[i, alive]
        if len(alive) > k and dim > STEP:
            # A bound that holds: the k-th best of the most promising so far, in full.
            seed = np.argpartition(part, len(part) - k)[-k:]
            floor = (part[seed] + q[i, STEP:] @ c[STEP:, alive[seed]]).min()
            for at in range(STEP, dim, STEP):
                may = part + q_left[i, at] * c_left[at, alive] * (1 + 1e-9) + 1e-6 >= floor
                alive, part = alive[may], part[may]
                part = part + q[i, at : at + STEP] @ c[at : at + STEP, alive]
        elif dim > STEP:
            part = part + q[i, STEP:] @ c[STEP:, alive]
        best = np.lexsort((ids[alive], -part))[:k]
        yield i, alive[best], part[best]


def exact_top_k(queries: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` candidates of each query with the largest inner product.

    Both tables have ``id`` (long) and ``vector`` (array of long).  Rows with a
    null id, a null vector or a null in it take no part, and vectors meet those
    of their own length only.  A candidate with the query's id is never an
    answer.  Equal scores go to the smaller id; repeated candidate rows are
    candidates each; of repeated query ids the smallest vector asks.  Scores must
    fit a long.  Either table may be empty.
    """
    whole = F.col("id").isNotNull() & F.col("vector").isNotNull() & ~F.exists("vector", lambda x: x.isNull())
    queries, candidates = (t.select("id", "vector").filter(whole) for t in (queries, candidates))
    asked = queries.groupBy("id").agg(F.min("vector").alias("vector")).withColumn("dim", F.size("vector"))
    schema = "query_id long, vec_id long, score long"
    # Queries and candidates are cut into shares and parts; each pair of the two is one piece of work of a bounded size.
    shares = {r["dim"]: -(-r["n"] // QUERIES) for r in asked.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    if not shares:
        return queries.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    sizes = candidates.groupBy(F.size("vector").alias("dim")).agg(F.count("*").alias("n")).filter(F.col("dim").isin(list(shares)))
    parts = dict.fromkeys(shares, 1) | {r["dim"]: -(-r["n"] // PART) for r in sizes.collect()}
    n_shares, n_parts = (F.create_map(*[F.lit(x) for pair in n.items() for x in pair])[F.col("dim")].cast("long") for n in (shares, parts))
    groups = asked.withColumn("share", F.pmod(F.xxhash64("id"), n_shares))
    groups = groups.groupBy("dim", "share").agg(F.collect_list(F.struct("id", "vector")).alias("queries"))
    groups = groups.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), n_parts - 1)))
    blocks = vertical_blocks(candidates).filter(F.col("dim").isin(list(shares))).withColumn("part", F.pmod(F.xxhash64("ids"), n_parts))
    blocks = blocks.withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), n_shares - 1)))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                dim = batch.column("dim")[at].as_py()
                asking = batch.column("queries")[at].as_py()
                own = np.array([x["id"] for x in asking], dtype=np.int64)
                vectors = np.array([x["vector"] for x in asking], dtype=np.int64).reshape(len(own), dim)
                ids = np.frombuffer(batch.column("ids")[at].as_py(), np.int64)
                rows = np.frombuffer(batch.column("rows")[at].as_py(), f"<i{batch.column('width')[at].as_py()}").astype(np.int64).reshape(dim, len(ids))
                found = list(search_block(vectors, own, rows, ids, k))
                asker = np.concatenate([np.full(len(places), own[i]) for i, places, _ in found])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(asker, pa.int64()), pa.array(np.concatenate([ids[p] for _, p, _ in found])), pa.array(np.concatenate([s for _, _, s in found]).astype(np.int64))],
                    names=["query_id", "vec_id", "score"],
                )

    pairs = blocks.join(groups, ["dim", "share", "part"]).select("dim", "ids", "width", "rows", "queries")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = pairs.mapInArrow(search, schema).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
