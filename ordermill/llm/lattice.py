"""Language-model scores by subword lattice likelihood.

A text's probability is the sum over all ways to cut it into pieces of a given
vocabulary, each piece drawn independently, closed by an end.  No piece holds a
space inside, so the forward recursion starts anew at each word with the same
values: a word's marginal is computed once, over all texts, and a text's log
probability is the sum over its words.  The vocabulary and its order come with
a tokenizer file; the probabilities start from that order and are fitted by
expectation maximisation over the word counts of the training texts.

Words and their counts stay distributed.  Words that make up more than one in
32,768 of all (so there are no more than that) are broadcast; the others meet
their values by a join, one row for each chunk of texts that has them.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm import buffers
from ordermill.llm.storage import stored

#: One over the share of a word that is broadcast; words worked on at once.
FREQUENT, WORDS = 1 << 15, 100_000

#: Added to the expected count of each piece.
SMOOTH = 0.01

_R = np.uint64(0x9E3779B97F4A7C15)


class Lattice(NamedTuple):
    """Natural-log probabilities of pieces, and two hash tables from piece to number."""

    log: np.ndarray
    lengths: tuple[int, ...]
    keys: np.ndarray
    tables: np.ndarray
    log_end: float


def vocabulary(model_file: str) -> tuple[list[bytes], np.ndarray]:
    """The byte strings of a sentencepiece file's pieces (a word's mark is a space), and weights by their order."""
    import sentencepiece

    held = sentencepiece.SentencePieceProcessor(model_file=model_file)
    weight: dict[bytes, float] = {bytes([b]): 1 / held.get_piece_size() for b in range(256)}
    for i in range(held.get_piece_size()):
        if held.is_control(i) or held.is_unknown(i) or held.is_byte(i) or held.is_unused(i):
            continue
        piece = held.id_to_piece(i).replace("▁", " ").encode()
        if piece and b" " not in piece[1:]:
            weight[piece] = weight.get(piece, 0.0) + 1 / (2 - held.get_score(i))
    return list(weight), np.array(list(weight.values()))


def hashed(rows: np.ndarray) -> np.ndarray:
    """A polynomial hash of every row's prefixes: one column more than ``rows`` has."""
    out = np.zeros((rows.shape[0], rows.shape[1] + 1), dtype=np.uint64)
    for i in range(rows.shape[1]):
        out[:, i + 1] = out[:, i] * _R + rows[:, i] + np.uint64(1)
    return out


def lattice(pieces: list[bytes], weight: np.ndarray, end: float) -> Lattice:
    """A lattice with these weights, normalised together with the weight of the end."""
    total = weight.sum() + end
    keys = np.array([hashed(np.frombuffer(p, np.uint8)[None])[0, -1] for p in pieces], dtype=np.uint64)
    tables = np.full((2, 1 << 20), -1, dtype=np.int32)
    spread = buffers.mixed(keys)
    for t, slot in enumerate((spread >> np.uint64(44), spread & np.uint64((1 << 20) - 1))):
        missing = np.flatnonzero((tables[0][spread >> np.uint64(44)] != np.arange(len(keys))) if t else np.ones(len(keys), bool))
        tables[t][slot[missing]] = missing
    found = np.where(keys[tables[0][spread >> np.uint64(44)]] == keys, tables[0][spread >> np.uint64(44)], tables[1][spread & np.uint64((1 << 20) - 1)])
    if not np.array_equal(found, np.arange(len(keys))):
        raise ValueError("two pieces share a slot of both tables")
    return Lattice(np.log(weight / total), tuple(sorted({len(p) for p in pieces})), keys, tables, float(np.log(end / total)))


def numbers(model: Lattice, key: np.ndarray) -> np.ndarray:
    """The piece with each key, or -1."""
    spread = buffers.mixed(key)
    out = model.tables[0][spread >> np.uint64(44)]
    miss = np.flatnonzero((out < 0) | (model.keys[out] != key))
    second = model.tables[1][spread[miss] & np.uint64((1 << 20) - 1)]
    out[miss] = np.where((second >= 0) & (model.keys[second] == key[miss]), second, -1)
    return out


def log_sum(parts: list[np.ndarray]) -> np.ndarray:
    """The logarithm of the sum of exponentials, column by column."""
    rows = np.stack(parts)
    top = rows.max(axis=0)
    return top + np.log(np.exp(rows - np.where(np.isfinite(top), top, 0)).sum(axis=0))


def forward(model: Lattice, rows: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray | None]:
    """Log marginals of words of one length (a row each, a space in front).

    With ``counts``, also the expected number of times each piece is used.
    """
    n, size = rows.shape
    prefix, power = hashed(rows), buffers.powers(int(_R), size + 1)
    logs = np.append(model.log, -np.inf)
    piece: dict[tuple[int, int], np.ndarray] = {}
    alpha = [np.zeros(n)]
    for j in range(1, size + 1):
        parts = []
        for length in model.lengths:
            if length > j:
                break
            found = numbers(model, prefix[:, j] - prefix[:, j - length] * power[length])
            if counts is not None:
                piece[j, length] = found
            parts.append(alpha[j - length] + logs[found])
        alpha.append(log_sum(parts))
    if counts is None:
        return alpha[size], None
    used = np.zeros(len(model.log))
    beta = [np.zeros(n)] * (size + 1)
    for i in range(size - 1, -1, -1):
        parts = []
        for length in model.lengths:
            if i + length > size:
                break
            found = piece[i + length, length]
            part = beta[i + length] + logs[found]
            parts.append(part)
            at = np.flatnonzero(found >= 0)
            used += np.bincount(found[at], weights=np.exp(alpha[i][at] + part[at] - alpha[size][at]) * counts[at], minlength=len(used))
        beta[i] = log_sum(parts)
    return alpha[size], used


def by_length(words: pa.Array, piece: int = 1 << 22) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Words of equal length: their places and their bytes after a space; few at once where they are long."""
    words = words.cast(pa.large_binary())
    ends = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2], np.uint8)
    size = np.diff(ends)
    order = np.argsort(size, kind="stable")
    for group in np.split(order, np.flatnonzero(np.diff(size[order])) + 1):
        if not len(group):
            continue
        length = int(size[group[0]])
        step = max(1, piece // ((length + 1) * 16))
        for at in range(0, len(group), step):
            some = group[at : at + step]
            rows = np.full((len(some), length + 1), 32, dtype=np.uint8)
            rows[:, 1:] = data[ends[some][:, None] + np.arange(length)]
            yield some, rows


def gathered(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """The rows again, in batches of ``most`` or somewhat more."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= most:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held = []
    if held and (rest := pa.Table.from_batches(held).combine_chunks().to_batches()):
        yield rest[0]


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, n_train, n_all`` of the lower-cased words of rows with ``text, train``, stored."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in buffers.slices(batches):
            w = buffers.words(batch.column("text"), lower=True)
            code, distinct = buffers.numbered(buffers.word_array(w))
            train = batch.column("train").to_numpy(zero_copy_only=False)[w.owner()]
            yield pa.RecordBatch.from_arrays([distinct.cast(pa.binary()), pa.array(np.bincount(code[train], minlength=len(distinct))), pa.array(np.bincount(code, minlength=len(distinct)))], names=["word", "n_train", "n_all"])

    parts = docs.select("text", "train").mapInArrow(count, "word binary, n_train long, n_all long")
    return stored(parts.groupBy("word").agg(F.sum("n_train").alias("n_train"), F.sum("n_all").alias("n_all")), "word-counts")


def fit(words: DataFrame, pieces: list[bytes], weight: np.ndarray, ends: int, rounds: int) -> Lattice:
    """Expectation maximisation over all distinct training words; each round gathers one number for each piece."""
    spark = words.sparkSession
    train = words.filter("n_train > 0").select("word", "n_train")
    model = lattice(pieces, weight, float(weight.sum()) / 100)
    for _ in range(rounds):
        held = spark.sparkContext.broadcast(model)

        def expect(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            used = np.zeros(len(held.value.log))
            for batch in gathered(batches, WORDS):
                n = batch.column("n_train").to_numpy().astype(np.float64)
                for at, rows in by_length(batch.column("word")):
                    used += forward(held.value, rows, n[at])[1]
            at = np.flatnonzero(used)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(used[at])], names=["piece", "used"])

        total = np.full(len(pieces), SMOOTH)
        for r in train.mapInArrow(expect, "piece int, used double").groupBy("piece").agg(F.sum("used").alias("used")).collect():
            total[r["piece"]] += r["used"]
        model = lattice(pieces, total, ends + 1.0)
    return model


def lattice_scores(
    docs: DataFrame, model_file: str, held_out: Column, doc_id: str = "doc_id", text: str = "text", rounds: int = 3
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    Learns from rows whose ``held_out`` (over ``doc_id``) is false; a null there
    is neither learned from nor held out.  Tokens are lower-cased (A-Z) words and
    one end.  ``base_score`` adds one to each count; ``score`` is the lattice's
    log10 probability of the words.  A null or empty text has the end only;
    repeated rows count and are scored each; an empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = rows.withColumn("train", F.coalesce(~held_out, F.lit(False)))
    words = word_counts(rows)
    ends = rows.filter("train").count()
    n_words, n_kinds, n_all = words.agg(F.sum("n_train"), F.count(F.when(F.col("n_train") > 0, 1)), F.sum("n_all")).first()
    train_tokens, kinds = (n_words or 0) + ends, n_kinds + (ends > 0)
    model = spark.sparkContext.broadcast(fit(words, *vocabulary(model_file), ends, rounds))

    def marginals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, WORDS):
            logs = np.zeros(batch.num_rows)
            for at, bytes_ in by_length(batch.column("word")):
                logs[at] = forward(model.value, bytes_)[0]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(logs / np.log(10))], names=["word", "n_train", "n_all", "log"])

    valued = stored(words.mapInArrow(marginals, "word binary, n_train long, n_all long, log double"), "word-marginals")
    frequent = valued.filter(F.col("n_all") * FREQUENT > (n_all or 0)).collect()  # fewer than FREQUENT rows
    tier = spark.sparkContext.broadcast(([bytes(r["word"]) for r in frequent], np.array([r["n_train"] for r in frequent], dtype=np.int64), np.array([r["log"] for r in frequent], dtype=np.float64)))
    log_end = model.value.log_end / np.log(10)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known_words, n_train, log = tier.value
        value_set, chunk = pa.array(known_words, pa.large_binary()), TaskContext.get().partitionId() << 32
        for batch in buffers.slices(batches):
            w = buffers.words(batch.column("text"), lower=True)
            code, distinct = buffers.numbered(buffers.word_array(w))
            at = pc.fill_null(pc.index_in(distinct, value_set=value_set), -1).to_numpy(zero_copy_only=False).astype(np.int64)
            of_word, n, owner = at[code], batch.num_rows, w.owner()
            here = of_word >= 0
            base = np.append(np.log10(n_train + 1), 0.0)[of_word]
            part = [np.bincount(owner[here], weights=x[here], minlength=n) for x in (np.append(n_train > 0, False)[of_word], base, np.append(log, 0.0)[of_word])]
            tokens = np.diff(w.first) + 1
            none = pa.nulls(n, pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, chunk)), pa.array(np.arange(n), pa.int32()), batch.column("doc_id"), batch.column("held_out"), pa.array(tokens), pa.array(part[0].astype(np.int64) + (ends > 0)), pa.array(part[1] + np.log10(ends + 1)), pa.array(part[2] + log_end), none, none], names=_NAMES
            )
            rare = np.flatnonzero(~here)
            rare = rare[np.argsort(code[rare], kind="stable")]
            cut = np.concatenate(([0], np.flatnonzero(np.diff(code[rare])) + 1, [len(rare)])) if len(rare) else np.zeros(1, np.int64)
            m = len(cut) - 1
            places = buffers.binaries(owner[rare].astype("<u4").view(np.uint8), cut * 4).cast(pa.binary())
            word = distinct.take(pa.array(code[rare[cut[:-1]]])).cast(pa.binary())
            empty = [pa.nulls(m, t) for t in (pa.int32(), batch.schema.field("doc_id").type, pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64())]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(m, chunk)), *empty, word, places], names=_NAMES)
            chunk += 1

    kind = rows.schema["doc_id"].dataType.simpleString()
    marked = rows.select("doc_id", "text", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    parts = stored(marked.mapInArrow(split, f"chunk long, at int, doc_id {kind}, held_out boolean, n_tokens long, n_known long, base double, score double, word binary, places binary"), "word-places")
    met = parts.filter("word is not null").select("chunk", "word", "places").join(valued.select("word", "n_train", "log"), "word").select("chunk", "places", "n_train", "log")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            flat, bounds = buffers.layout_bytes(batch.column("places").cast(pa.large_binary()))
            count, at = np.diff(bounds) // 4, flat.view("<u4").astype(np.int64)
            chunk, n_train, log = (np.repeat(batch.column(c).to_numpy(), count) for c in ("chunk", "n_train", "log"))
            for c in np.unique(chunk):
                own = chunk == c
                size = max(int(at[own].max()) + 1, held[c].shape[1] if c in held else 0)
                sums = np.stack([np.bincount(at[own], weights=x[own], minlength=size) for x in (n_train > 0, np.log10(n_train + 1), log)])
                if c in held:
                    sums[:, : held[c].shape[1]] += held[c]
                held[c] = sums
        for c, (known, base, log) in held.items():
            n = len(known)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, c)), pa.array(np.arange(n), pa.int32()), pa.array(known.astype(np.int64)), pa.array(base), pa.array(log)], names=["chunk", "at", "more_known", "more_base", "more_score"])

    # A chunk's rows meet in one task, which holds three numbers for each of its texts.
    sums = met.repartition("chunk").mapInArrow(add, "chunk long, at int, more_known long, more_base double, more_score double")
    whole = parts.filter("at is not null").drop("word", "places").join(sums, ["chunk", "at"], "left")
    more = {c: F.coalesce(f"more_{c}", F.lit(0)) for c in ("known", "base", "score")}
    smoothed = float(np.log10(train_tokens + kinds + 1))
    return whole.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + more["known"]).alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + more["base"] - F.col("n_tokens") * smoothed).alias("base_score"),
        (F.col("score") + more["score"]).alias("score"),
    )


_NAMES = ["chunk", "at", "doc_id", "held_out", "n_tokens", "n_known", "base", "score", "word", "places"]
