"""MinHash near-duplicates, with odd sketches to verify banded candidates.

Texts with the same words are one class and go on as its smallest id.  MinHash
bands put classes into buckets.  In a bucket, odd sketches (parity bitmaps of
the MinHash samples) are compared: the population count of their XOR estimates
the similarity, far more precisely than shared bands.  Classes that may be
similar form small clusters, and in these every pair that is not yet connected
is confirmed on the full shingle sets.

Neither buckets nor clusters are joined pair by pair.  Large ones are cut into
blocks, tasks compare two blocks with array operations, and what comes out is at
most one link for each row of a block, enough to connect what is similar.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm import buffers
from ordermill.llm.graph import components
from ordermill.llm.storage import stored

#: Bands, rows of a band, bits of a sketch, rows of a block of a bucket and of a cluster.
BANDS, ROWS, BITS, SKETCHES, SETS = 32, 5, 256, 16384, 512

#: Large keys up to which their list is broadcast; more are joined by a shuffle.
LISTED = 100_000

#: How far an estimated similarity may be below the threshold.  Of 3 million simulated pairs at 0.80 this loses 2 (0.18 loses 248).
MARGIN = 0.26

_ODD = (np.random.default_rng(20240229).integers(0, 1 << 31, BANDS * ROWS, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)


def shingles(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each lower-cased text as 64-bit hashes: where each text's begin, and the sorted hashes.

    A text with fewer words than ``size`` has its whole sequence as one shingle;
    one without words has none.
    """
    w = buffers.words(texts, lower=True)
    hashes = buffers.span_hashes(w.data, w.start, w.end)
    starts = buffers.inside(w.first, size)
    keys = buffers.window_keys(hashes, size)[starts] if len(starts) else np.zeros(0, np.uint64)
    owner = np.searchsorted(w.first, starts, side="right") - 1
    count = np.diff(w.first)
    for n in range(1, size):
        short = np.flatnonzero(count == n)
        if len(short):
            keys = np.append(keys, buffers.window_keys(hashes, n)[w.first[short]] + np.uint64(n))
            owner = np.append(owner, short)
    order = np.argsort(keys, kind="stable")
    order = order[np.argsort(owner[order], kind="stable")]
    keys, owner = keys[order], owner[order]
    fresh = np.ones(len(keys), dtype=bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
    return np.searchsorted(owner[fresh], np.arange(len(texts) + 1)), keys[fresh]


def signatures(bounds: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Band hashes (one row per text) and odd sketches (bytes) of sets that are not empty."""
    n = len(bounds) - 1
    base = (keys >> np.uint64(32)).astype(np.uint32)
    samples = np.empty((BANDS * ROWS, n), dtype=np.uint32)
    for j, odd in enumerate(_ODD):
        h = base * odd
        h ^= h >> np.uint32(15)
        samples[j] = np.minimum.reduceat(h, bounds[:-1])
    bands = np.zeros((n, BANDS), dtype=np.uint64)
    for band in range(BANDS):
        key = np.full(n, band + 1, dtype=np.uint64)
        for j in range(band * ROWS, band * ROWS + ROWS):
            key = buffers.mixed(key ^ samples[j])
        bands[:, band] = key
    numbers = np.arange(BANDS * ROWS, dtype=np.uint64)[:, None] << np.uint64(32)
    bit = (buffers.mixed(samples + numbers) % np.uint64(BITS)).astype(np.int64)
    counts = np.bincount((bit + BITS * np.arange(n)).ravel(), minlength=n * BITS)
    return bands.view(np.int64), np.packbits((counts & 1).astype(np.uint8).reshape(n, BITS), axis=1)


def digests(texts: pa.Array) -> pa.Array:
    """A 128-bit digest of the lower-cased words of each text."""
    w = buffers.words(texts, lower=True)
    length = w.end - w.start + 1
    joined = np.full(int(length.sum()), 32, dtype=np.uint8)
    places = np.cumsum(length) - length
    joined[buffers.ragged(places, length - 1)] = w.data[buffers.ragged(w.start, length - 1)]
    edges, view = np.append(places, len(joined))[w.first], memoryview(joined)
    return pa.array([hashlib.md5(view[a:b]).digest() for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)], pa.binary())


def described(docs: DataFrame, size: int) -> DataFrame:
    """``doc_id, n_shingles, digest`` (of the words), ``bands, sketch`` of rows with ``doc_id, text``."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in buffers.slices(batches, limit=buffers.CHUNK // 2):
            texts = batch.column("text")
            bounds, keys = shingles(texts, size)
            n = np.diff(bounds)
            full = np.flatnonzero(n)
            bands, sketch = np.zeros((0, BANDS), np.int64), np.zeros((0, BITS // 8), np.uint8)
            if len(full):
                bands, sketch = signatures(np.append(bounds[:-1][full], bounds[-1]), keys)
            at = np.full(len(n), -1)
            at[full] = np.arange(len(full))
            pick = pa.array(at, mask=at < 0)
            banded = pa.ListArray.from_arrays(pa.array(np.arange(len(full) + 1, dtype=np.int32) * BANDS), pa.array(bands.ravel()))
            sketched = buffers.binaries(sketch.ravel(), np.arange(len(full) + 1) * (BITS // 8)).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), digests(texts), banded.take(pick), sketched.take(pick)], names=["doc_id", "n_shingles", "digest", "bands", "sketch"])

    return docs.mapInArrow(describe, "doc_id long, n_shingles long, digest binary, bands array<long>, sketch binary")


def blocked(rows: DataFrame, key: str, id_: str, most: int) -> DataFrame:
    """Deal the rows of each ``key`` into blocks of about ``most``, and copy them to every pair of blocks of it.

    Adds ``left, right`` (block numbers of the pair) and ``block`` (the row's
    own).  Keys with up to ``most`` rows, nearly all, have one pair and one copy.
    """
    large = rows.groupBy(key).agg(F.count("*").alias("_n")).filter(F.col("_n") > most)
    large = stored(large.select(key, F.ceil(F.col("_n") / most).cast("int").alias("_blocks")), "large-keys")
    n = large.count()
    if not n:
        return rows.withColumns({c: F.lit(0) for c in ("left", "right", "block")})
    dealt = rows.join(F.broadcast(large) if n <= LISTED else large, key, "left").withColumn("_blocks", F.coalesce("_blocks", F.lit(1)))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64(id_), F.col("_blocks")).cast("int"))
    pairs = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    return pairs.withColumns({"left": F.least("block", "_other"), "right": F.greatest("block", "_other")}).drop("_other", "_blocks")


def repeated(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """The batches without rows whose key neither neighbour has; rows at the ends of a batch stay."""
    for batch in batches:
        values = batch.column(key).to_numpy()
        like = np.concatenate(([True], values[1:] == values[:-1], [True]))
        yield batch.filter(pa.array(like[1:] | like[:-1]))


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The consecutive rows with equal keys, each group as one table."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        cut = np.zeros(batch.num_rows, dtype=bool)
        for c in columns:
            cut[1:] |= c[1:] != c[:-1]
        edges = [0, *np.flatnonzero(cut).tolist(), batch.num_rows]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if a == b:
                continue
            own = tuple(c[a] for c in columns)
            if held and own != last:
                yield pa.Table.from_batches(held)
                held = []
            last = own
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def unlike_bits(threshold: float) -> float:
    """The most bits in which sketches of sets with this similarity are expected to differ."""
    return BITS / 2 * (1 - np.exp(-4 * BANDS * ROWS * (1 - threshold) / BITS))


def candidate_clusters(classes: DataFrame, threshold: float) -> DataFrame:
    """``node, component``: clusters of classes that share buckets and have sketches alike."""
    lower = threshold - MARGIN
    banded = classes.select(F.explode("bands").alias("key"), "doc_id", "sketch", "n_shingles")
    dealt = blocked(banded, "key", "doc_id", SKETCHES)
    parts = dealt.repartition("key", "left", "right").sortWithinPartitions("key", "left", "right", "doc_id")

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[np.ndarray, np.ndarray]] = []
        for table in groups(repeated(batches, "key"), ["key", "left", "right"]):
            if table.num_rows < 2:
                continue
            doc, n, block = (table[c].to_numpy() for c in ("doc_id", "n_shingles", "block"))
            sketch = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint64).reshape(len(doc), BITS // 64)
            out += spanning_links(doc, n, sketch, block if block.min() != block.max() else None, lower, threshold)
            if len(out) >= 1000:
                yield edge_batch(out)
                out = []
        if out:
            yield edge_batch(out)

    edges = parts.select("key", "left", "right", "doc_id", "sketch", "n_shingles", "block").mapInArrow(link, "a long, b long")
    return components(edges)


def edge_batch(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate([p[i] for p in parts]), pa.int64()) for i in (0, 1)], names=["a", "b"])


def spanning_links(doc: np.ndarray, n: np.ndarray, sketch: np.ndarray, block: np.ndarray | None, lower: float, threshold: float) -> list:
    """Links that connect all rows whose sketches and sizes allow the threshold, one per row at most.

    Searches breadth first: a row is compared with the rows not reached yet.
    With ``block``, rows of one block need not be compared (another task does).
    """
    open_, out = np.arange(len(doc)), []
    limit = unlike_bits(lower)
    while len(open_) > 1:
        queue, open_ = [open_[0]], open_[1:]
        while queue and len(open_):
            x = queue.pop()
            unlike = np.bitwise_count(sketch[open_] ^ sketch[x]).sum(axis=1, dtype=np.int64)
            sizes = n[open_]
            near = (unlike <= limit) & (np.minimum(sizes, n[x]) >= threshold * np.maximum(sizes, n[x]) - 1e-9)
            if block is not None:
                near &= block[open_] != block[x]
            found = open_[near]
            if len(found):
                out.append((np.full(len(found), doc[x]), doc[found]))
                queue += found.tolist()
                open_ = open_[~near]
    return out


def confirmed_links(members: DataFrame, percent: int) -> DataFrame:
    """``a, b``: links that connect what the full sets of each cluster connect; ``members`` has cluster, doc_id, keys, sketch."""
    dealt = blocked(members, "cluster", "doc_id", SETS)
    parts = dealt.repartition("cluster", "left", "right").sortWithinPartitions("cluster", "left", "right", "doc_id")
    lower = percent / 100 - MARGIN

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[np.ndarray, np.ndarray]] = []
        for table in groups(batches, ["cluster", "left", "right"]):
            if table.num_rows > 1:
                out += similar_links(table, lower, percent)
            if len(out) >= 1000:
                yield edge_batch(out)
                out = []
        if out:
            yield edge_batch(out)

    return parts.select("cluster", "left", "right", "doc_id", "block", "sketch", "keys").mapInArrow(confirm, "a long, b long")


def similar_links(table: pa.Table, lower: float, percent: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links between rows with enough shared shingles, enough to connect all that are similar."""
    doc, block = (table[c].to_numpy() for c in ("doc_id", "block"))
    two = block.min() != block.max()
    sets = [np.frombuffer(k, np.uint64) for k in table["keys"].to_pylist()]
    sketch = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint64).reshape(len(doc), BITS // 64)
    n = np.array([len(s) for s in sets], dtype=np.int64)
    limit = unlike_bits(lower)
    # Shingles as numbers of this table, and for each the rows that have it.
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), n)
    by = np.argsort(flat, kind="stable")
    fresh = np.concatenate(([True], flat[by[1:]] != flat[by[:-1]]))
    code = np.empty(len(flat), dtype=np.int64)
    code[by] = np.cumsum(fresh) - 1
    first = np.append(np.flatnonzero(fresh), len(flat))
    rows, ends = owner[by], np.concatenate(([0], np.cumsum(n)))
    open_, out = np.arange(len(doc)), []
    while len(open_) > 1:
        queue, open_ = [open_[0]], open_[1:]
        while queue and len(open_):
            x = queue.pop()
            maybe = np.bitwise_count(sketch[open_] ^ sketch[x]).sum(axis=1, dtype=np.int64) <= limit
            if two:
                maybe &= block[open_] != block[x]
            if not maybe.any():
                continue
            own = code[ends[x] : ends[x + 1]]
            met = rows[buffers.ragged(first[own], first[own + 1] - first[own])]
            shared = np.bincount(met, minlength=len(doc))[open_]
            near = maybe & (100 * shared >= percent * (n[open_] + n[x] - shared))
            found = open_[near]
            if len(found):
                out.append((np.full(len(found), doc[x]), doc[found]))
                queue += found.tolist()
                open_ = open_[~near]
    return out


def with_digest(docs: DataFrame, into: str, text: str = "text") -> DataFrame:
    """All rows and columns of ``docs``, and the digest of the words of the text."""
    names = docs.columns

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in buffers.slices(batches, text):
            yield pa.RecordBatch.from_arrays([*batch.columns, digests(batch.column(text))], names=[*names, into])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(apply, f"{kinds}, `{into}` binary")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row.

    Rows are linked if their sets of lower-cased ``size``-word shingles share at
    least ``percent`` hundredths of their union; a component is what links
    connect, named by its smallest id, and that row is kept.  Texts without words
    (or null) have an empty set and are linked with nothing.  A row with a null
    id is linked with nothing, has no component and is kept.  Equal rows get
    equal results.  Rows that share an id but not the text are linked by their
    texts, and all of them are kept if the id is that of their component;
    ``judged`` tells them apart.  Extra columns are ignored; an empty table gives
    no rows.

    Shingles stand as 64-bit hashes.  A pair at the threshold is missed with a
    chance of about 4e-6: 3e-6 that it shares no band, 7e-7 that its sketches lie
    too far apart.  More similar pairs are missed with less.
    """
    return judged(docs, size, percent, doc_id, text).select("doc_id", "n_shingles", "component_id", "kept")


def judged(docs: DataFrame, size: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """What ``near_duplicates`` says, the ``digest`` of the words each row was judged by, and whether the row ``stays``.

    A class of equal words goes through the search under a 64-bit hash of its
    digest, as an id may have several texts.  Of texts that share the smallest
    id of a component, the one with the smallest digest stays.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    table = stored(described(rows, size), "signatures")
    linkable = table.filter(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    first = linkable.groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    classes = linkable.join(first, ["digest", "doc_id"], "left_semi")
    number = F.xxhash64("digest")
    nodes = classes.select(number.alias("doc_id"), "n_shingles", "bands", "sketch")
    clusters = stored(candidate_clusters(nodes, percent / 100), "clusters").withColumnRenamed("component", "cluster")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in buffers.slices(batches):
            batch = batch.filter(pa.compute.equal(batch.column("digest"), digests(batch.column("text"))))
            bounds, keys = shingles(batch.column("text"), size)
            packed = buffers.binaries(keys.view(np.uint8), bounds * 8).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("cluster"), batch.column("sketch"), packed], names=["doc_id", "cluster", "sketch", "keys"])

    wanted = classes.select("doc_id", "sketch", "digest", number.alias("node")).join(clusters, "node")
    members = rows.join(wanted, "doc_id")
    members = members.mapInArrow(sets, "doc_id long, cluster long, sketch binary, keys binary")
    found = components(confirmed_links(stored(members, "shingle-sets"), percent))
    named = first.withColumn("node", number).join(found, "node", "left").withColumn("group", F.coalesce("component", "node"))
    named = named.select("digest", "group", F.struct("doc_id", "digest").alias("own"))
    least = named.groupBy("group").agg(F.min("own").alias("least"))
    named = named.join(least, "group").select("digest", F.col("least.doc_id").alias("component"), F.col("least.digest").alias("chosen"))
    out = table.select("doc_id", "n_shingles", "digest").join(named, "digest", "left")
    lone = (F.col("n_shingles") == 0) | F.col("doc_id").isNull()
    component = F.when(lone, F.col("doc_id")).otherwise(F.col("component"))
    kept = lone | (F.col("doc_id") == F.col("component"))
    stays = lone | (kept & (F.col("digest") == F.col("chosen")))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), kept.alias("kept"), stays.alias("stays"), "digest")
