"""Weak supervision: quality rules vote or abstain, and a label model weighs them.

Each rule says bad, good or nothing about a document.  How often a good and how
often a bad document gets each vote is estimated without labels by expectation
maximisation over the counts of vote patterns, which are bounded by three to the
number of rules.  A document is kept if its posterior probability to be good is
at least one half.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm import buffers

BAD, NONE, GOOD = 0, 1, 2

#: Words in a window for repetition inside a text.
REPEAT = 5

STATISTICS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_lines",
    "n_dup_lines",
    "n_repeat_words",
    "n_distinct",
    "n_letters",
    "n_capitals",
    "n_marked",
    "n_loose",
)


class Rule(NamedTuple):
    """Votes bad where ``bad`` holds, else good where ``good`` holds, else abstains (SQL over the statistics)."""

    name: str
    bad: str
    good: str


RULES = (
    Rule("length", "n_words < 10", "n_words >= 50"),
    Rule("symbols", "10 * n_symbols > n_words", "100 * n_symbols <= n_words"),
    Rule("repeats", "10 * n_repeat_words > 2 * n_words", "50 * n_repeat_words <= n_words"),
    Rule("lines", "n_dup_lines >= 3 and 10 * n_dup_lines > 3 * n_lines", "n_dup_lines = 0"),
    Rule("capitals", "2 * n_capitals > n_letters", "5 * n_capitals <= n_letters"),
    Rule("word_length", "word_chars < 2 * n_words or word_chars > 15 * n_words", "word_chars between 3 * n_words and 10 * n_words"),
    Rule("vocabulary", "n_words >= 20 and 10 * n_distinct < 2 * n_words", "10 * n_distinct >= 3 * n_words"),
    Rule("marks", "10 * n_marked > 3 * n_words", "20 * n_marked <= n_words"),
    Rule("loose", "10 * n_loose > 2 * n_words", "50 * n_loose <= n_words"),
)


def _table(characters: str) -> np.ndarray:
    return np.isin(np.arange(256), list(characters.encode()))


_SYMBOL = _table("#*$%&|<>")
_CAPITAL = _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LETTER = _CAPITAL | _table("abcdefghijklmnopqrstuvwxyz")
_PLAIN = _LETTER | (np.arange(256) >= 128) | _table("0123456789")


def statistics(texts: pa.Array) -> dict[str, np.ndarray]:
    """The numbers the rules look at, for each text; a null text has no word.

    A marked word ends in two characters that are neither letters nor digits; a
    loose one has no letter or digit at all.
    """
    w = buffers.words(texts)
    _, offsets = buffers.layout(texts)
    code, distinct = buffers.numbered(buffers.word_array(w))
    owner = w.owner()
    starts = buffers.inside(w.first, REPEAT)
    order, fresh = buffers.equal_windows(code, starts, REPEAT, owner[starts])
    many = ~(fresh & np.append(fresh[1:], True)) if len(fresh) else fresh
    repeated = buffers.covered(starts[order[many]], REPEAT, len(code))
    # Distinct words of a text: the first of each (text, word).
    seen = np.sort(owner * max(len(distinct), 1) + code)
    firsts = seen[np.concatenate(([True], seen[1:] != seen[:-1]))] // max(len(distinct), 1) if len(seen) else seen
    n = len(texts)
    marked = (w.end - w.start >= 2) & ~_PLAIN[w.data[w.end - 1]] & ~_PLAIN[w.data[np.maximum(w.end - 2, 0)]]
    plain = np.concatenate(([0], np.cumsum(_PLAIN[w.data])))
    loose = plain[w.end] == plain[w.start]
    lines, line_owner = spoken_lines(w, offsets)
    line_code, kinds = buffers.numbered(lines)
    pairs = np.unique(line_owner * max(len(kinds), 1) + line_code) // max(len(kinds), 1)
    n_lines = np.bincount(line_owner, minlength=n)
    solid = ~buffers.SEPARATOR[w.data]
    return {
        "n_words": np.diff(w.first),
        "word_chars": buffers.per_text(solid & (w.data & 0xC0 != 0x80), offsets),
        "n_symbols": buffers.per_text(_SYMBOL[w.data], offsets),
        "n_lines": n_lines,
        "n_dup_lines": n_lines - np.bincount(pairs, minlength=n),
        "n_repeat_words": buffers.per_text(repeated, w.first),
        "n_distinct": np.bincount(firsts, minlength=n),
        "n_letters": buffers.per_text(_LETTER[w.data], offsets),
        "n_capitals": buffers.per_text(_CAPITAL[w.data], offsets),
        "n_marked": buffers.per_text(marked, w.first),
        "n_loose": buffers.per_text(loose, w.first),
    }


def spoken_lines(w: buffers.Words, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The lines that hold a word, without their line feeds, and the text of each."""
    feed = np.flatnonzero(w.data == 10)
    filled = offsets[:-1][np.diff(offsets) > 0]
    start = np.union1d(filled, feed + 1)
    start = start[start < len(w.data)]
    if not len(start):
        return pa.array([], pa.large_binary()), start
    end = np.append(start[1:], len(w.data))
    end -= (w.data[end - 1] == 10) & (end > start)
    spoken = np.searchsorted(w.start, end) > np.searchsorted(w.start, start)
    start, length = start[spoken], (end - start)[spoken]
    lines = buffers.binaries(w.data[buffers.ragged(start, length)], np.concatenate(([0], np.cumsum(length))))
    return lines, np.searchsorted(offsets, start, side="right") - 1


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores if a column of ``df`` has it already (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_statistics(docs: DataFrame, text: str, into: str) -> DataFrame:
    """All columns of ``docs``, and a struct ``into`` with the statistics of ``text``."""
    names = docs.columns

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in buffers.slices(batches, text, buffers.CHUNK // 2):
            found = statistics(batch.column(text))
            made = pa.StructArray.from_arrays([pa.array(found[k], pa.int64()) for k in STATISTICS], names=list(STATISTICS))
            yield pa.RecordBatch.from_arrays([*batch.columns, made], names=[*names, into])

    fields = ", ".join(f"{k}: bigint" for k in STATISTICS)
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields]
    return docs.mapInArrow(measure, ", ".join([*kinds, f"`{into}` struct<{fields}>"]))


def vote(rule: Rule, struct: str) -> Column:
    """The vote of a rule over the statistics in ``struct``."""
    held = F.col(struct)
    bad, good = (F.expr(_qualified(x, struct)) for x in (rule.bad, rule.good))
    return F.when(held.isNull(), NONE).when(bad, BAD).when(good, GOOD).otherwise(NONE)


def _qualified(condition: str, struct: str) -> str:
    return " ".join(f"`{struct}`.{w}" if w in STATISTICS else w for w in condition.split())


class LabelModel(NamedTuple):
    """Share of good documents; probability of each vote of each rule, for bad and for good documents."""

    good: float
    votes: np.ndarray

    def posterior(self, pattern: np.ndarray) -> np.ndarray:
        """Probability that documents with these votes (one row each) are good."""
        rules = np.arange(pattern.shape[1])
        logs = np.log(self.votes)[:, rules, pattern].sum(axis=2)
        logs += np.log([1 - self.good, self.good])[:, None]
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def fit_label_model(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> LabelModel:
    """Expectation maximisation over vote patterns and how many documents show each.

    Begins with the view that a bad vote makes a document bad; one vote of each
    kind is added for each rule and class.  Without documents it keeps all.
    """
    q = np.where((patterns == BAD).any(axis=1), 0.1, 0.95)
    for _ in range(rounds):
        weight = np.stack([(1 - q) * counts, q * counts])
        good = (weight[1].sum() + 1) / (counts.sum() + 2)
        votes = np.stack([(weight[:, :, None] * (patterns == v)).sum(axis=1) + 1 for v in (BAD, NONE, GOOD)], axis=2)
        model = LabelModel(float(good), votes / votes.sum(axis=2, keepdims=True))
        q = model.posterior(patterns)
    return model


def judged(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, str, str]:
    """All rows and columns of ``docs`` with their statistics and the posterior probability to be good.

    Returns the table and the names of the two new columns (a struct, a double),
    which avoid names that ``docs`` has.  A null or empty text has no words and
    is judged as such; repeated rows get equal results; an empty table gives an
    empty one.
    """
    into = fresh_name(docs, "statistics")
    measured = with_statistics(docs, text, into)
    pattern = F.concat(*[vote(r, into).cast("string") for r in rules])
    only = with_statistics(docs.select(text), text, into)
    histogram = only.groupBy(pattern.alias("pattern")).agg(F.count("*").alias("n")).collect()  # 3 ** rules at most
    patterns = np.array([[int(v) for v in r["pattern"]] for r in histogram], dtype=np.int64).reshape(-1, len(rules))
    counts = np.array([r["n"] for r in histogram], dtype=np.float64)
    model = fit_label_model(patterns, counts)
    good = model.posterior(patterns)
    found = F.create_map(*[F.lit(x) for r, p in zip(histogram, good, strict=True) for x in (r["pattern"], float(p))])
    out = fresh_name(measured, "posterior")
    verdict = found[pattern] if histogram else F.lit(1.0)
    return measured.withColumn(out, verdict), into, out
