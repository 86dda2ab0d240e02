"""The trie of conversation prefixes, summed up in flat arrays under a minimal perfect hash.

A prefix is known by its depth and a 128-bit digest, a polynomial over the hashes
of its turns, so the digests of all prefixes are running sums.  Turns are sorted
over all tasks, each task sums its own stretch, and the few conversations that
cross a border get what went before: no conversation meets a task whole.

Distinct digests are the nodes.  Nodes with one member need no sums over their
subtree.  The shared ones are dealt to shards of whole subtrees: those with so
many members that at most ``LISTED`` exist form the top, and each of their other
children begins a subtree with few members.  In a shard every node gets a slot by
a minimal perfect hash, verified against its digest; counts are scattered into
arrays by slot and added to the parents' slots, deepest first.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm import buffers
from ordermill.llm.storage import stored

#: Each conversation takes up to ``HEAD`` turns from the first of its ``FAMILY``.
FAMILY, HEAD = 5, 9

#: Turns of one conversation that meet its description in one task.
STRETCH = 1 << 20

#: Nodes of the top at most (besides the root), nodes from which a shard is full, ids in a piece of a member list.
LISTED, SHARD, PIECE = 1 << 16, 1 << 17, 4096

#: The bases of the two halves of a digest, odd so that they have an inverse modulo 2**64.
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


def raised(base: int, exponent: np.ndarray) -> np.ndarray:
    """``base ** exponent`` modulo 2**64; exponents may be negative."""
    size, out = np.abs(exponent).astype(np.uint64), np.ones(len(exponent), dtype=np.uint64)
    up, down = np.uint64(base), np.uint64(pow(base, -1, 1 << 64))
    power = np.where(exponent < 0, down, up)
    while size.any():
        out = np.where(size & np.uint64(1), out * power, out)
        power = power * power
        size = size >> np.uint64(1)
    return out


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def unsigned(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(c).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) for c in names]


def turn_rows(conversations: DataFrame) -> DataFrame:
    """``conv, turn, t1, t2, t3, bytes``: turns as parts of the SHA-256 of role and text, and the text's bytes; rows without an id are none."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    sha = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)

    def part(i: int):
        # Fifteen digits fit a signed number.
        return F.conv(F.substring(sha, 15 * i + 1, 15), 16, 10).cast("long").alias(f"t{i + 1}")

    given = conversations.filter(F.col("conv_id").isNotNull())
    return given.select(F.col("conv_id").cast("long").alias("conv"), "turn", part(0), part(1), part(2), F.octet_length(text).cast("long").alias("bytes"))


def numbered_turns(turns: DataFrame) -> DataFrame:
    """``conv, pos, t1, t2, t3, bytes, h1, h2, before1, before2``: places from 1, and the digests with and without each turn.

    Turns are in the order of ``turn`` (null first) and then of their hashes.
    """

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, conv, pos, sums = TaskContext.get().partitionId(), None, 0, [np.uint64(0), np.uint64(0)]
        for batch in batches:
            if not batch.num_rows:
                continue
            conversation = batch.column("conv").to_numpy()
            fresh = np.concatenate(([conversation[0] != conv], conversation[1:] != conversation[:-1]))
            run = np.cumsum(fresh)
            begin = np.concatenate(([0], np.flatnonzero(fresh)))[run] if not fresh[0] else np.flatnonzero(fresh)[run - 1]
            own = run == 0
            place = np.arange(batch.num_rows) - begin + 1 + np.where(own, pos, 0)
            out = []
            for i, base in enumerate(BASES):
                term = buffers.mixed(unsigned(batch, f"t{i + 1}")[0]) * raised(base, place)
                total = np.cumsum(term)
                earlier = np.where(own, np.uint64(0) - sums[i], np.concatenate((np.zeros(1, np.uint64), total))[begin])
                out.append(total - earlier)
            conv, pos, sums = conversation[-1], int(place[-1]), [x[-1] for x in out]
            columns = [batch.column(c) for c in ("conv", "t1", "t2", "t3", "bytes")]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(batch.num_rows, part), pa.int32()), *columns, pa.array(place), *map(signed, out)], names=["part", "conv", "t1", "t2", "t3", "bytes", "pos", "h1", "h2"])

    dealt = turns.repartitionByRange("conv", "turn", "t1", "t2", "t3").sortWithinPartitions("conv", "turn", "t1", "t2", "t3")
    rows = stored(dealt.mapInArrow(local, "part int, conv long, t1 long, t2 long, t3 long, bytes long, pos long, h1 long, h2 long"), "trie-turns")
    carried = carries(rows)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, conv, pos = (batch.column(c).to_numpy() for c in ("part", "conv", "pos"))
            count, sums = np.zeros(len(pos), dtype=np.int64), np.zeros((2, len(pos)), dtype=np.uint64)
            for p in np.unique(part):
                if p in carried:
                    at = (part == p) & (conv == carried[p][0])
                    count[at] = carried[p][1]
                    sums[:, at] = np.array(carried[p][2:], dtype=np.uint64)[:, None]
            out = []
            for i, base in enumerate(BASES):
                shift = raised(base, count)
                digest = unsigned(batch, f"h{i + 1}")[0] * shift + sums[i]
                term = buffers.mixed(unsigned(batch, f"t{i + 1}")[0]) * raised(base, pos) * shift
                out.append((signed(digest), signed(digest - term)))
            columns = [batch.column(c) for c in ("t1", "t2", "t3", "bytes")]
            yield pa.RecordBatch.from_arrays([batch.column("conv"), pa.array(pos + count), *columns, out[0][0], out[1][0], out[0][1], out[1][1]], names=["conv", "pos", "t1", "t2", "t3", "bytes", "h1", "h2", "before1", "before2"])

    return rows.mapInArrow(whole, "conv long, pos long, t1 long, t2 long, t3 long, bytes long, h1 long, h2 long, before1 long, before2 long")


def carries(rows: DataFrame) -> dict[int, tuple[int, int, int, int]]:
    """By part: the conversation it goes on with, its turns in earlier parts, and the sums over them.

    A part goes on with one conversation at most, so what reaches the driver is a few numbers for each part.
    """
    ends = rows.groupBy("part").agg(F.min("conv").alias("low"), F.max("conv").alias("high")).orderBy("part").collect()
    crossing = [b["low"] for a, b in itertools.pairwise(ends) if a["high"] == b["low"]]
    if not crossing:
        return {}
    last = F.max_by(F.struct("pos", "h1", "h2"), "pos").alias("last")
    known = rows.sparkSession.createDataFrame([(c,) for c in set(crossing)], "conv long")
    found = rows.join(F.broadcast(known), "conv", "left_semi").groupBy("part", "conv").agg(last).orderBy("conv", "part").collect()
    out, conv, count, sums = {}, None, 0, [0, 0]
    for r in found:
        if r["conv"] != conv:
            conv, count, sums = r["conv"], 0, [0, 0]
        if count:
            out[r["part"]] = (conv, count, *sums)
        sums = [(s + r["last"][f"h{i + 1}"] * pow(BASES[i], count, 1 << 64)) % (1 << 64) for i, s in enumerate(sums)]
        count += r["last"]["pos"]
    return out


def rebuilt(turns: DataFrame) -> DataFrame:
    """``conv, d, k1, k2, p1, p2, t1, t3, bytes, last``: each prefix of every rebuilt conversation, the empty one included.

    ``k`` is the prefix's digest and ``p`` its parent's.  A conversation begins
    with up to h turns of the first of its family and goes on with its own after h.
    """
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % HEAD).alias("h")
    own = [F.max(F.when(F.col("pos") == F.col("h"), F.col(f"h{i}"))).alias(f"own{i}") for i in (1, 2)]
    of = turns.withColumn("h", h).groupBy("conv", "h").agg(F.max("pos").alias("n"), *own)
    first = turns.filter((F.col("pos") < HEAD) & (F.col("conv") % FAMILY == 0))
    heads = first.groupBy(F.col("conv").alias("source")).agg(F.array_sort(F.collect_list(F.struct("pos", "h1", "h2"))).alias("head"))
    made = of.withColumn("source", F.col("conv") - F.col("conv") % FAMILY).join(heads, "source", "left")
    made = made.withColumn("m", F.least("h", F.coalesce(F.size("head"), F.lit(0))))
    made = made.withColumn("top", F.when(F.col("m") > 0, F.get("head", F.col("m").cast("int") - 1)))
    made = made.select("conv", "source", "h", "n", "m", "own1", "own2", F.col("top.h1").alias("top1"), F.col("top.h2").alias("top2"), (F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"))
    made = stored(made, "trie-conversations")
    stretch = F.floor(F.col("pos") / STRETCH)
    several = made.withColumn("stretch", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("n") / STRETCH))))
    tails = turns.withColumn("stretch", stretch).join(several.filter("n > h"), ["conv", "stretch"]).filter("pos > h")
    shift = F.col("m") - F.col("h")
    tails = tails.select("conv", (F.col("pos") + shift).alias("d"), "h1", "h2", "before1", "before2", "t1", "t3", "bytes", "top1", "top2", "own1", "own2", shift.alias("shift"), "length")
    none = F.lit(0).cast("long")
    taken = first.withColumnRenamed("conv", "source").join(made.filter("m > 0"), "source").filter("pos <= m")
    taken = taken.select("conv", F.col("pos").alias("d"), "h1", "h2", "before1", "before2", "t1", "t3", "bytes", *[none.alias(c) for c in ("top1", "top2", "own1", "own2", "shift")], "length")

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shift = batch.column("shift").to_numpy()
            keys = []
            for name in ("h", "before"):
                for i, base in enumerate(BASES, 1):
                    at, top, own = unsigned(batch, f"{name}{i}", f"top{i}", f"own{i}")
                    keys.append(signed(top + raised(base, shift) * (at - own)))
            last = np.equal(batch.column("d").to_numpy(), batch.column("length").to_numpy())
            yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("d"), *keys, *[batch.column(c) for c in ("t1", "t3", "bytes")], pa.array(last)], names=["conv", "d", "k1", "k2", "p1", "p2", "t1", "t3", "bytes", "last"])

    prefixes = tails.unionByName(taken).mapInArrow(digests, "conv long, d long, k1 long, k2 long, p1 long, p2 long, t1 long, t3 long, bytes long, last boolean")
    roots = made.select("conv", *[none.alias(c) for c in ("d", "k1", "k2", "p1", "p2", "t1", "t3", "bytes")], (F.col("length") == 0).alias("last"))
    return prefixes.unionByName(roots)


class PerfectHash:
    """Slots 0 to n - 1 for n different keys: a key takes its place on the first level where no other wants it."""

    def __init__(self, keys: np.ndarray, levels: int = 64):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        at = 0
        while len(keys):
            if len(self.levels) == levels:
                raise ValueError("keys are not distinct")
            place = self.place(keys, len(self.levels), 2 * len(keys))
            alone = np.bincount(place, minlength=2 * len(keys)) == 1
            rank = at + np.cumsum(alone) - 1
            self.levels.append((alone, rank))
            at += int(alone.sum())
            keys = keys[~alone[place]]

    @staticmethod
    def place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (buffers.mixed(keys + np.uint64((level + 1) * BASES[0] % (1 << 64))) % np.uint64(size)).astype(np.int64)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; of a key that is not there, any slot or -1."""
        out, left = np.full(len(keys), -1, dtype=np.int64), np.arange(len(keys))
        for level, (alone, rank) in enumerate(self.levels):
            place = self.place(keys[left], level, len(alone))
            hit = alone[place]
            out[left[hit]] = rank[place[hit]]
            left = left[~hit]
        return out


def summed(table: pa.Table) -> pa.Table:
    """The nodes of one shard with the sums over their subtrees, and whether each has its parent elsewhere."""
    depth, k1, k2, p1, p2 = (table.column(c).to_numpy().astype(np.int64) for c in ("d", "k1", "k2", "p1", "p2"))

    def key(d: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return buffers.mixed(a.view(np.uint64) + buffers.mixed(b.view(np.uint64) + d.astype(np.uint64)))

    index = PerfectHash(key(depth, k1, k2))
    slot = index.slots(key(depth, k1, k2))
    at_slot = np.empty(len(depth), dtype=np.int64)
    at_slot[slot] = np.arange(len(depth))
    up = index.slots(key(depth - 1, p1, p2))
    holder = at_slot[np.maximum(up, 0)]
    verified = (up >= 0) & (depth > 0) & (depth[holder] == depth - 1) & (k1[holder] == p1) & (k2[holder] == p2)
    up = np.where(verified, up, -1)
    sums = {}
    for name in ("members", "leaves", "saved"):
        sums[name] = np.zeros(len(depth), dtype=np.int64)
        sums[name][slot] = table.column(name).to_numpy()
    order = np.argsort(-depth, kind="stable")
    for level in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1):
        level = level[up[level] >= 0]
        for values in sums.values():
            np.add.at(values, up[level], values[slot[level]])
    out = {c: table.column(c) for c in ("d", "k1", "k2", "p1", "p2", "n")} | {name: pa.array(values[slot]) for name, values in sums.items()}
    return pa.table(out | {"begins": pa.array(up < 0)})


_NODE = "d long, k1 long, k2 long, p1 long, p2 long, n long, members long, leaves long, saved long"


def shard_sums(nodes: DataFrame, *subtree: str) -> DataFrame:
    """``summed`` over shards of whole subtrees; the rows of a subtree stand together in a partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, last = [], 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = list(zip(*(batch.column(c).to_pylist() for c in subtree), strict=True)) if subtree else [()] * batch.num_rows
            cut = 0
            for i, one in enumerate(ids):
                if one != last and rows + i - cut >= SHARD:
                    held.append(batch.slice(cut, i - cut))
                    yield from summed(pa.Table.from_batches(held)).to_batches()
                    held, rows, cut = [], 0, i
                last = one
            held.append(batch.slice(cut))
            rows += batch.num_rows - cut
        if rows:
            yield from summed(pa.Table.from_batches(held)).to_batches()

    return nodes.mapInArrow(run, f"{_NODE}, begins boolean")


def member_hashes(rows: DataFrame) -> DataFrame:
    """``d, k1, k2, ends_sha256``: the hash over the ids of the conversations that end at a node.

    Sorted ids are joined to pieces wherever they lie; a node's pieces then stream through one hash.
    """
    key = ["d", "k1", "k2"]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in key]
            ids = batch.column("conv").to_pylist()
            fresh = np.zeros(batch.num_rows, dtype=bool)
            fresh[::PIECE] = True
            for c in columns:
                fresh[1:] |= c[1:] != c[:-1]
            at = np.append(np.flatnonzero(fresh), batch.num_rows)
            text = [",".join(map(str, ids[a:b])) for a, b in itertools.pairwise(at)]
            yield pa.RecordBatch.from_arrays([*[pa.array(c[at[:-1]]) for c in columns], pa.array([ids[a] for a in at[:-1]], pa.int64()), pa.array(text, pa.string())], names=[*key, "first", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, running = None, hashlib.sha256()
        done: list[tuple] = []
        for batch in itertools.chain(batches, [None]):
            for *node, ids in zip(*(batch.column(c).to_pylist() for c in (*key, "ids")), strict=True) if batch is not None else ():
                if node != last:
                    if last is not None:
                        done.append((*last, running.hexdigest()))
                    last, running = node, hashlib.sha256(ids.encode())
                else:
                    running.update(b"," + ids.encode())
            if batch is None and last is not None:
                done.append((*last, running.hexdigest()))
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names=[*key, "ends_sha256"])
                done = []

    ends = rows.filter("last").select(*key, "conv")
    pieces = ends.repartitionByRange(*key, "conv").sortWithinPartitions(*key, "conv").mapInArrow(join, "d long, k1 long, k2 long, first long, ids string")
    return pieces.repartition(*key).sortWithinPartitions(*key, "first").mapInArrow(digest, "d long, k1 long, k2 long, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row for each distinct prefix of the rebuilt conversations (``conv_id, turn, role, text``).

    ``conv_id`` is its smallest member, with ``depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256``.  Turns go in the order of
    ``turn``, null first; turns with an equal number in the order of the first 45
    hexadecimal digits of the SHA-256 over the role's length in bytes, a colon,
    role and text.  Null roles and texts are empty; repeated rows are turns of
    their own; rows without an id belong to no conversation; other columns are
    ignored.  A table without conversations gives no rows, not even a root.
    """
    key, up = ["d", "k1", "k2"], [(F.col("d") - 1).alias("d"), F.col("p1").alias("k1"), F.col("p2").alias("k2")]
    rows = stored(rebuilt(numbered_turns(turn_rows(conversations))), "trie-prefixes")
    same = [F.min(c).alias(c) for c in ("p1", "p2", "t1", "t3")] + [F.max(c).alias(f"{c}_") for c in ("p1", "p2", "t1", "t3")]
    found = rows.groupBy(*key).agg(F.count("*").alias("n"), F.min("conv").alias("conv"), F.max("bytes").alias("bytes"), F.count_if("last").alias("ends"), *same)
    nodes = stored(found, "trie-digests")
    if nodes.filter("p1 <> p1_ OR p2 <> p2_ OR t1 <> t1_ OR t3 <> t3_").limit(1).count():
        raise RuntimeError("two prefixes have one digest")
    total = rows.count()
    kids = nodes.filter("d > 0").select(*up, "n").groupBy(*key).agg(F.count("*").alias("n_children"), F.count_if(F.col("n") == 1).alias("single"))
    nodes = nodes.drop("p1_", "p2_", "t1", "t1_", "t3", "t3_").join(kids, key, "left").na.fill(0, ["n_children", "single"])
    nodes = stored(nodes, "trie-nodes")
    # What a shared node has by itself and through children with one member.
    leaves = F.col("single") + (F.col("n_children") == 0).cast("long")
    own = nodes.filter("n > 1 OR d = 0").select(*key, "p1", "p2", "n", (F.col("ends") + F.col("single")).alias("members"), leaves.alias("leaves"), ((F.col("n") - 1) * F.col("bytes")).alias("saved"), "conv")
    top = (F.col("n") > total / LISTED) | (F.col("d") == 0)
    listed = F.broadcast(nodes.filter(top).select(*key))
    begin = rows.join(listed, key, "left_anti").groupBy("conv").agg(F.min(F.struct(*key)).alias("begin"))
    low = own.filter(~top).join(begin, "conv").select(*[F.col(c.split()[0]) for c in _NODE.split(", ")], *[F.col(f"begin.{c}").alias(f"s{c}") for c in key])
    low = low.repartition("sd", "sk1", "sk2").sortWithinPartitions("sd", "sk1", "sk2")
    low = stored(shard_sums(low, "sd", "sk1", "sk2"), "trie-sums")
    parts = ("members", "leaves", "saved")
    through = low.filter("begins").select(*up, *parts).groupBy(*key).agg(*[F.sum(c).alias(f"{c}_") for c in parts])
    high = own.filter(top).join(through, key, "left").select(*key, "p1", "p2", "n", *[(F.col(c) + F.coalesce(f"{c}_", F.lit(0))).alias(c) for c in parts])
    sums = stored(shard_sums(high.repartition(1)).unionByName(low), "trie-sums")
    if sums.filter("members <> n").limit(1).count():
        raise RuntimeError("the members of a subtree do not add up")
    sums = sums.select(*key, "leaves", "saved")
    above = nodes.select(*[F.col(c).alias(f"u{c}") for c in key], F.col("conv").alias("parent"), "n", "d")
    here = (F.col("d") - 1 == F.col("ud")) & (F.col("p1") == F.col("uk1")) & (F.col("p2") == F.col("uk2"))
    seen = nodes.join(F.broadcast(above.filter(top).drop("n", "d")), here, "left").drop("ud", "uk1", "uk2")
    near = seen.filter("d = 0 OR parent IS NOT NULL")
    rest = seen.filter("d > 0 AND parent IS NULL").drop("parent").join(above.filter(~top).drop("n", "d"), here).drop("ud", "uk1", "uk2")
    out = near.unionByName(rest).join(sums, key, "left").join(member_hashes(rows), key, "left")
    return out.select(
        F.col("conv").alias("conv_id"),
        F.col("d").alias("depth"),
        F.col("parent").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        "n_children",
        F.coalesce("leaves", F.lit(1)).alias("n_leaves"),
        F.coalesce("saved", F.lit(0)).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )
