"""Token counts by a map-side two-tier lookup.

Words between white space are tokenised apart from each other by the tokenizers
served here, so a text's count is the sum over its words.  Tier one is a
compact table, word to token count, of the words that are frequent over all
documents; it has a fixed number of entries and is broadcast.  Tier two is a
cache that each Python worker fills by encoding what it meets beside that.  No
word occurrence is shuffled: only each task's bounded list of its most frequent
words is, to make the table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm import buffers
from ordermill.llm.encoders import load, unit_counts


def frequent_words(docs: DataFrame, text: str, entries: int) -> list[bytes]:
    """About the ``entries`` most frequent words of all texts.

    Each task counts all its words, forgetting its rarest whenever the list
    outgrows four times ``entries``; the lists are then summed by word.  What is
    forgotten costs time later and changes no count.
    """

    def tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pa.table({"word": pa.array([], pa.large_binary()), "n": pa.array([], pa.int64())})
        for batch in buffers.slices(batches, text):
            found = pc.value_counts(buffers.word_array(buffers.words(batch.column(text))))
            fresh = pa.table({"word": found.field("values"), "n": found.field("counts")})
            held = pa.concat_tables([held, fresh]).group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])
            if held.num_rows > 4 * entries:
                held = held.take(pc.select_k_unstable(held, k=2 * entries, sort_keys=[("n", "descending")]))
        if held.num_rows > entries:
            held = held.take(pc.select_k_unstable(held, k=entries, sort_keys=[("n", "descending")]))
        yield from pa.table({"word": held["word"].cast(pa.binary()), "n": held["n"]}).to_batches()

    counted = docs.select(text).mapInArrow(tops, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return [bytes(r.word) for r in counted.orderBy(F.desc("n"), "word").select("word").limit(entries).collect()]


def token_counts(
    docs: DataFrame, tokenizer: str, limit: int, doc_id: str = "doc_id", text: str = "text", entries: int = 1 << 15
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` (more than ``limit`` tokens) of every row.

    ``tokenizer`` is the file of a tokenizer that drops white space between
    words.  Texts with other Unicode white space or special strings are encoded
    whole, as the library would.  A null text is an empty one: 0 bytes, 0
    tokens.  A null id stays null; repeated rows are each counted; any other
    columns are ignored.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    table = frequent_words(docs, "text", entries)
    lengths = unit_counts(load(tokenizer), table)
    tier = spark.sparkContext.broadcast((b"".join(table), np.cumsum([0, *map(len, table)]), lengths))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data, ends, known = tier.value
        frequent, encoder = buffers.binaries(np.frombuffer(data, np.uint8), ends), load(tokenizer)
        cache: dict = buffers.worker_state().setdefault(("counts", tokenizer), {})
        for batch in buffers.slices(batches):
            texts = batch.column("text")
            w = buffers.words(texts)
            code, distinct = buffers.numbered(buffers.word_array(w))
            at = pc.index_in(distinct, value_set=frequent)
            n = np.zeros(len(distinct), dtype=np.int64)
            hit = at.is_valid().to_numpy(zero_copy_only=False)
            n[hit] = known[at.drop_null().to_numpy()]
            n[~hit] = through_cache(cache, distinct.filter(pa.array(~hit)).to_pylist(), lambda some: unit_counts(encoder, some).tolist())
            sums = np.concatenate(([0], np.cumsum(n[code])))
            tokens = sums[w.first[1:]] - sums[w.first[:-1]]
            for d in encoder.whole(texts):
                tokens[d] = len(encoder.ids(texts[d].as_py()))
            size = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), size, pa.array(tokens), pa.array(tokens > limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")


def through_cache(cache: dict, units: list, encode: Callable, most: int = 250_000, size: int = 32 << 20) -> list:
    """What ``encode`` gives for each unit, asking it for units that the cache lacks.

    The cache has two generations; when the young one has ``most`` units or their
    bytes reach ``size``, it becomes the old one.  A unit of more than a
    hundredth of ``size`` is not cached.  Nothing but time depends on what it holds.
    """
    young, old = cache.setdefault("young", {}), cache.get("old", {})
    out = [old.get(u) if (x := young.get(u)) is None else x for u in units]
    missing = [i for i, x in enumerate(out) if x is None]
    for i, x in zip(missing, encode([units[i] for i in missing]), strict=True):
        out[i] = x
    kept = cache.get("bytes", 0)
    for u, x in zip(units, out, strict=True):
        if len(u) <= size // 100 and u not in young:
            young[u] = x
            kept += len(u)
    cache["bytes"] = kept
    if len(young) > most or kept > size:
        cache["old"], cache["young"], cache["bytes"] = young, {}, 0
    return out
