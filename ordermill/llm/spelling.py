"""Spelling variants: words one edit apart, found with blocked Gram matrices of letter counts.

Two words that differ by one inserted, deleted or replaced letter have letter
counts at a squared distance of at most two.  Words are dealt to blocks, and for
two blocks one product of their count matrices gives all squared distances; the
few pairs at most two apart are then compared letter by letter.

A block holds words of one length with the same numbers of letters in each of
five classes, so a word has near ones in its own block and in the few blocks
whose numbers differ by one or two steps.  Each word stands in its own block and
visits half of those, hence every two adjacent blocks meet once.  A large block is
cut into parts, and visitors stream past a part: a task holds one part at a time.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm import buffers
from ordermill.llm.storage import stored

#: Words in a part of a block, and visitors compared with it at once.
PART, VISITORS = 2048, 4096

#: Letters are dealt to classes by their code; a block's number has so many bits for the letters of each.
CLASSES, DIGITS = 5, 12

#: Runs with more bytes get their check sum one by one.
LONG = 64

#: The number of each letter of a word, a-z and then U+00C0 to U+00FF.
LETTER = np.zeros(256, dtype=np.int64)
LETTER[97:123] = np.arange(26)
LETTER[192:256] = 26 + np.arange(64)
LETTERS = 90


def letter_runs(texts: pa.Array) -> buffers.Words:
    """The longest runs of A-Z, a-z and U+00C0 to U+00FF in all texts, A-Z lower-cased.

    In UTF-8 the letters beyond ASCII are the byte C3 and any byte after it.
    """
    data, offsets = buffers.layout(texts)
    data = buffers.LOWER[data]
    solid = ((data >= 97) & (data <= 122)) | (data == 0xC3)
    solid[1:] |= data[:-1] == 0xC3
    start, end = solid.copy(), solid.copy()
    start[1:] &= ~solid[:-1]
    end[:-1] &= ~solid[1:]
    filled = np.flatnonzero(np.diff(offsets))
    start[offsets[filled]] = solid[offsets[filled]]
    end[offsets[filled + 1] - 1] = solid[offsets[filled + 1] - 1]
    start = np.flatnonzero(start)
    return buffers.Words(data, start, np.flatnonzero(end) + 1, np.searchsorted(start, offsets))


def crc_table() -> np.ndarray:
    """The check sum's change by each byte, from its polynomial (bits reversed)."""
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = np.where(out & 1, (out >> np.uint32(1)) ^ np.uint32(0xEDB88320), out >> np.uint32(1))
    return out


def check_sums(prefix: np.ndarray, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The CRC-32 of texts that continue ``prefix`` (check sums so far) by ``data[start:start + length]``."""
    table, out = crc_table(), prefix.astype(np.uint32)
    long = np.flatnonzero(length > LONG)
    for i in long:
        out[i] = zlib.crc32(data[start[i] : start[i] + length[i]].tobytes(), int(prefix[i]))
    at = np.flatnonzero(length <= LONG)
    at = at[np.argsort(-length[at], kind="stable")]
    state, left = ~out[at], length[at]
    for k in range(int(left[0]) if len(left) else 0):
        n = int(np.searchsorted(-left, -k, side="left"))
        state[:n] = table[(state[:n] ^ data[start[at[:n]] + k]) & 255] ^ (state[:n] >> np.uint32(8))
    out[at] = ~state
    return out


def latin(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words in UTF-8 as one byte for each letter: the bytes, and where each word begins."""
    after = np.zeros(len(data), dtype=bool)
    after[1:] = data[:-1] == 0xC3
    keep = data != 0xC3
    out = np.where(after, data + np.uint8(64), data)[keep]
    return out, np.concatenate(([0], np.cumsum(keep)))[offsets]


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", every: int | None = 97, least: int = 5) -> DataFrame:
    """``word`` (binary, one byte a letter) and ``n`` of all words of ``least`` letters or more.

    Where ``every`` divides the CRC-32 h of ``<doc_id>:<run>``, the run loses its
    letter h modulo its length.  A null id is written as nothing.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in buffers.slices(batches):
            w = letter_runs(batch.column("text"))
            if not len(w.start):
                continue
            code, distinct = buffers.numbered(buffers.word_array(w))
            data, offsets = buffers.layout_bytes(distinct)
            letters, bounds = latin(data, offsets)
            size = np.diff(bounds)
            n = np.bincount(code, minlength=len(distinct))
            fresh: dict[bytes, int] = {}
            if every is not None:
                pair, times = np.unique(w.owner() * len(distinct) + code, return_counts=True)
                owner, code = pair // len(distinct), pair % len(distinct)
                begun = np.array([zlib.crc32(b"%s:" % str(i).encode()) for i in batch.column("id").fill_null("").to_pylist()], dtype=np.uint32)
                h = check_sums(begun[owner], data, offsets[code], np.diff(offsets)[code])
                hit = np.flatnonzero(h % np.uint32(every) == 0)
                np.subtract.at(n, code[hit], times[hit])
                for i in hit[size[code[hit]] > least]:
                    word = letters[bounds[code[i]] : bounds[code[i] + 1]].tobytes()
                    cut = int(h[i]) % len(word)
                    word = word[:cut] + word[cut + 1 :]
                    fresh[word] = fresh.get(word, 0) + int(times[i])
            some = np.flatnonzero((size >= least) & (n > 0))
            body = letters[buffers.ragged(bounds[some], size[some])]
            plain = buffers.binaries(body, np.concatenate(([0], np.cumsum(size[some])))).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([plain, pa.array(n[some])], names=["word", "n"])
            if fresh:
                yield pa.RecordBatch.from_arrays([pa.array(list(fresh), pa.binary()), pa.array(list(fresh.values()), pa.int64())], names=["word", "n"])

    rows = docs.select(F.col(doc_id).cast("string").alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def block_numbers(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The block of each word: its letters of each class, ``DIGITS`` bits each.

    Counts wrap around, so words of very different lengths can share a block;
    adjacent ones still differ by one step, and pairs are verified anyway.
    """
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    per_class = np.bincount(owner * CLASSES + data % CLASSES, minlength=CLASSES * (len(offsets) - 1)).reshape(-1, CLASSES)
    return (per_class % (1 << DIGITS)) @ (1 << (DIGITS * np.arange(CLASSES)))


def visited(blocks: np.ndarray) -> np.ndarray:
    """The blocks that the words of ``blocks`` visit, a row each: one letter less, or one moved from a class to a later one."""
    digits = blocks[:, None] >> (DIGITS * np.arange(CLASSES)) & ((1 << DIGITS) - 1)
    steps = [-np.eye(CLASSES, dtype=np.int64)[i] for i in range(CLASSES)]
    steps += [np.eye(CLASSES, dtype=np.int64)[j] - np.eye(CLASSES, dtype=np.int64)[i] for j in range(CLASSES) for i in range(j)]
    to = (digits[:, None, :] + np.array(steps)[None]) % (1 << DIGITS)
    return to @ (1 << (DIGITS * np.arange(CLASSES)))


def with_blocks(words: DataFrame) -> DataFrame:
    """``word, n, block, visits`` (an array) of each word."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in buffers.slices(batches, "word"):
            block = block_numbers(*buffers.layout_bytes(batch.column("word").cast(pa.large_binary())))
            to = visited(block)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, to.size + 1, to.shape[1]), pa.int32()), pa.array(to.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(block), lists], names=["word", "n", "block", "visits"])

    return words.mapInArrow(number, "word binary, n long, block long, visits array<long>")


class Part:
    """Some words with their letter counts."""

    def __init__(self, words: pa.Array):
        self.words = words
        self.data, self.offsets = buffers.layout_bytes(words.cast(pa.large_binary()))
        self.size = np.diff(self.offsets)
        owner = np.repeat(np.arange(len(words)), self.size)
        counts = np.bincount(owner * LETTERS + LETTER[self.data], minlength=LETTERS * len(words))
        self.counts = counts.reshape(-1, LETTERS).astype(np.float32)
        self.norm = (self.counts**2).sum(axis=1)


def one_edit(a: Part, i: np.ndarray, b: Part, j: np.ndarray) -> np.ndarray:
    """Whether word ``i[k]`` of ``a`` and word ``j[k]`` of ``b`` are one inserted, deleted or replaced letter apart."""
    out = np.zeros(len(i), dtype=bool)

    def differ(x: Part, at: np.ndarray, y: Part, to: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where letters differ, and where each pair's letters begin."""
        unlike = x.data[buffers.ragged(at, length)] != y.data[buffers.ragged(to, length)]
        return unlike, np.concatenate(([0], np.cumsum(length)[:-1]))

    same = np.flatnonzero(a.size[i] == b.size[j])
    if len(same):
        unlike, begin = differ(a, a.offsets[i[same]], b, b.offsets[j[same]], a.size[i[same]])
        out[same] = np.add.reduceat(unlike, begin, dtype=np.int64) == 1
    for x, u, y, v in ((a, i, b, j), (b, j, a, i)):
        more = np.flatnonzero(x.size[u] == y.size[v] + 1)
        if not len(more):
            continue
        at, to, length = x.offsets[u[more]], y.offsets[v[more]], y.size[v[more]]
        place = buffers.ragged(np.zeros(len(more), np.int64), length)
        unlike, begin = differ(x, at, y, to, length)
        prefix = np.minimum.reduceat(np.where(unlike, place, np.repeat(length, length)), begin)
        unlike, begin = differ(x, at + 1, y, to, length)
        last = np.maximum.reduceat(np.where(unlike, place, -1), begin)
        out[more] = prefix > last
    return out


def near(a: Part, b: Part, within: bool) -> tuple[np.ndarray, np.ndarray]:
    """The pairs one edit apart of two parts; of one part, each pair once, if ``within``."""
    apart = a.norm[:, None] + b.norm[None, :] - 2 * (a.counts @ b.counts.T)
    close = apart <= 2
    i, j = np.nonzero(np.triu(close, 1) if within else close)
    found = np.zeros(len(i), dtype=bool)
    # Chunks by letters, as a word can be very long.
    ends = np.cumsum(a.size[i])
    at = 0
    while at < len(i):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + buffers.CHUNK, side="right")))
        found[at:to] = one_edit(a, i[at:to], b, j[at:to])
        at = to
    return i[found], j[found]


def near_words(words: DataFrame) -> DataFrame:
    """``word, other, other_n`` of every two words that are one edit apart, in both directions."""
    placed = stored(with_blocks(words), "spelling-blocks")
    parts = placed.groupBy("block").agg(F.ceil(F.count("*") / PART).alias("parts"))
    own = placed.join(parts, "block").withColumn("part", F.pmod(F.xxhash64("word"), "parts"))
    home = own.select("block", "part", F.lit(False).alias("visits"), "word", "n")
    # Parts of one block meet as well: a word visits the parts before its own.
    before = own.filter("part > 0").select("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("part") - 1)).alias("part"), F.lit(True).alias("visits"), "word", "n")
    to = placed.select("word", "n", F.explode("visits").alias("block")).join(parts, "block")
    guests = to.select("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), F.lit(True).alias("visits"), "word", "n")
    dealt = home.unionByName(before).unionByName(guests).repartition("block", "part").sortWithinPartitions("block", "part", "visits")

    def rows(a: Part, an: np.ndarray, b: Part, bn: np.ndarray, within: bool) -> list[pa.RecordBatch]:
        i, j = near(a, b, within)
        one, two = a.words.take(pa.array(i)), b.words.take(pa.array(j))
        out = [(one, two, bn[j]), (two, one, an[i])]
        return [pa.RecordBatch.from_arrays([u, v, pa.array(n)], names=["word", "other", "other_n"]) for u, v, n in out if len(n)]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, home = None, [], None
        for batch in batches:
            block, part, visits = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("block", "part", "visits"))
            cuts = np.flatnonzero((block[1:] != block[:-1]) | (part[1:] != part[:-1]) | (visits[1:] != visits[:-1])) + 1
            edges = np.concatenate(([0], cuts, [batch.num_rows]))
            for x, y in zip(edges[:-1], edges[1:], strict=True):
                if x == y:
                    continue
                if (block[x], part[x]) != key:
                    if held:
                        home = Part(pa.concat_arrays([h.column("word") for h in held])), np.concatenate([h.column("n").to_numpy() for h in held])
                        yield from rows(*home, *home, True)
                    key, held, home = (block[x], part[x]), [], None
                if not visits[x]:
                    held.append(batch.slice(x, y - x))
                    continue
                if held:
                    home = Part(pa.concat_arrays([h.column("word") for h in held])), np.concatenate([h.column("n").to_numpy() for h in held])
                    held = []
                    yield from rows(*home, *home, True)
                for z in range(x, y, VISITORS) if home else ():
                    some = batch.slice(z, min(VISITORS, y - z))
                    yield from rows(*home, Part(some.column("word")), some.column("n").to_numpy(), False)
        if held:
            home = Part(pa.concat_arrays([h.column("word") for h in held])), np.concatenate([h.column("n").to_numpy() for h in held])
            yield from rows(*home, *home, True)

    return dealt.mapInArrow(compare, "word binary, other binary, other_n long")


def last_forms(forms: DataFrame) -> DataFrame:
    """``word, root``: where following ``forms`` (``word, form``) ends; each round doubles the steps.

    A form is at least twice as frequent as its word, so a chain has at most 62 steps and six rounds end it.
    """
    now = stored(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "spelling-roots")
    while now.filter("moved").limit(1).count():
        further = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = now.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        now = stored(step, "spelling-roots")
    return now.select("word", "root")


def spelling_variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", every: int | None = 97, least: int = 5, often: int = 3) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of each distinct word of ``least`` letters that occurs ``often`` times.

    Words are the runs of letters (A-Z and U+00C0 to U+00FF) that ``word_counts``
    gives, A-Z lower-cased.  Two words are near if one letter is inserted, deleted
    or replaced; a word's form is its near word with the largest ``n`` (of equal
    ones the first in code-point order), if that is twice the word's own or more.
    ``root`` follows forms to the last.  A null text has no words, a null id is
    written as nothing, repeated rows count each, and other columns are ignored.
    An empty table gives no rows.
    """
    words = stored(word_counts(docs, doc_id, text, every, least).filter(F.col("n") >= often), "spelling-words")
    best = F.min(F.struct((-F.col("other_n")).alias("minus_n"), F.col("other").alias("other"))).alias("best")
    links = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), best)
    taken = F.when(-F.col("best.minus_n") >= 2 * F.col("n"), F.col("best"))
    found = words.join(links, "word", "left").withColumn("taken", taken)
    found = found.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.col("taken.other").alias("form"), (-F.col("taken.minus_n")).alias("form_n"))
    found = stored(found, "spelling-forms")
    roots = last_forms(found.filter("form IS NOT NULL"))

    def written(c: str) -> Column:
        return F.decode(c, "ISO-8859-1").alias(c)

    out = found.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
    return out.select(written("word"), written("form"), written("root"), "n", "n_near", "form_n")
