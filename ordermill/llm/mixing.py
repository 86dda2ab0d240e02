"""Mixing documents to target domain weights by soft membership.

A classifier trained on a labelled table gives every document a probability for
each domain.  Rates per document (how often to use it) are fitted so that the
expected tokens of each domain match its target: least squares, by projected gradient descent with momentum from a rate of one, and
after each step rates below zero become zero.  The gradient of a document needs
its probabilities and one number per domain, so a step is one pass over a narrow
table, and rates follow from the steps so far, whatever the number of domains.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm import buffers
from ordermill.llm.grams import labelled_sample, one_text
from ordermill.llm.language import BITS, vectors
from ordermill.llm.quality_rules import fresh_name
from ordermill.llm.storage import stored

#: Bytes of text that are classified at once: their n-grams take some 130 times as much.
PIECE = buffers.CHUNK // 16

#: Rows of a matrix product.  Products of other sizes add up in another order, so all have this one.
ROWS = 128


class Classifier(NamedTuple):
    """Softmax regression over hashed character n-grams."""

    domains: list[str]
    weight: np.ndarray
    bias: np.ndarray


def embedded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``domain`` and the packed vector of each ``text``."""
    for batch in buffers.slices(batches, limit=PIECE):
        packed = [pa.compress(v.astype("<f2").tobytes(), codec="zstd", asbytes=True) for v in vectors(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([batch.column("domain"), pa.array(packed, pa.binary())], names=["domain", "vector"])


def fit_domains(docs: DataFrame, labelled: DataFrame, per_domain: int = 300, doc_id: str = "doc_id", text: str = "text") -> Classifier:
    """Train on the texts of ``labelled`` (``doc_id, domain``), at most ``per_domain`` of each domain.

    Rows with a null id or domain, and ids without a text, are left out, and rows
    that share id and domain give one text.  The
    chosen ids are few enough to be broadcast, and their vectors to be collected.
    """
    known = labelled.filter(F.col("doc_id").isNotNull() & F.col("domain").isNotNull()).distinct()
    chosen = labelled_sample(known, "domain", "doc_id", per_domain)
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).filter("text is not null")
    sample = one_text(texts.join(F.broadcast(chosen), "doc_id"), "doc_id", "domain").select("domain", "text")
    found = sample.mapInArrow(embedded, "domain string, vector binary").collect()
    found.sort(key=lambda r: (r["domain"], r["vector"]))
    domains = sorted({r["domain"] for r in found})
    if not found:
        return Classifier([], np.zeros((1 << BITS, 0), np.float32), np.zeros(0, np.float32))
    x = np.stack([np.frombuffer(pa.decompress(r["vector"], decompressed_size=2 << BITS, codec="zstd", asbytes=True), "<f2").astype(np.float32) for r in found])
    y = np.array([[r["domain"] == d for d in domains] for r in found], dtype=np.float32)
    # Domains weigh the same, however many rows each has.
    share = (y / y.sum(axis=0)).sum(axis=1, keepdims=True) / len(domains)
    weight, bias = np.zeros((1 << BITS, len(domains)), np.float32), np.zeros(len(domains), np.float32)
    for _ in range(200):
        logits = x @ weight + bias
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        error = share * (p / p.sum(axis=1, keepdims=True) - y)
        weight -= 20 * (x.T @ error + 1e-5 * weight)
        bias -= 2 * error.sum(axis=0)
    return Classifier(domains, weight, bias)


def probabilities(texts: pa.Array, model: Classifier) -> np.ndarray:
    """The probability of each domain, a row for each text; equal texts get equal rows, whatever texts are beside them."""
    parts = [np.zeros((0, len(model.domains)))]
    for at in range(0, len(texts), ROWS):
        x = vectors(texts.slice(at, ROWS))
        filled = np.concatenate((x, np.zeros((ROWS - len(x), x.shape[1]), np.float32)))
        logits = ((filled @ model.weight)[: len(x)] + model.bias).astype(np.float64)
        p = np.exp(logits - logits.max(axis=1, keepdims=True, initial=0))
        parts.append(p / np.maximum(p.sum(axis=1, keepdims=True), 1e-300))
    return np.concatenate(parts)


def schema_of(docs: DataFrame, *more: str) -> str:
    return ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields), *more])


def with_membership(docs: DataFrame, model: Classifier, text: str, tokens: str, membership: str) -> DataFrame:
    """All columns of ``docs``, its number of words, and its probability for each domain (an array)."""
    names = docs.columns
    held = docs.sparkSession.sparkContext.broadcast(model)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for batch in buffers.slices(batches, text, PIECE):
            column = batch.column(text)
            flat = probabilities(column, model).ravel()
            lists = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * len(model.domains)), pa.array(flat))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.diff(buffers.words(column).first)), lists], names=[*names, tokens, membership])

    return docs.mapInArrow(apply, schema_of(docs, f"`{tokens}` long", f"`{membership}` array<double>"))


class Step(NamedTuple):
    """A step against the gradient: a number for each domain, and the share of the last move that goes on."""

    move: np.ndarray
    momentum: float


def rates_after(steps: list[Step], p: np.ndarray) -> np.ndarray:
    """Rates of documents with these probabilities: from one, and never below zero after a step."""
    before = now = np.ones(len(p))
    for move, momentum in steps:
        before, now = now, np.maximum(0.0, now + momentum * (now - before) - p @ move)
    return now


def with_rate(table: DataFrame, steps: list[Step], domains: int, membership: str, into: str) -> DataFrame:
    """All rows and columns, and the rate of each row after ``steps``."""
    names = table.columns

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = batch.column(membership).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, domains)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rates_after(steps, p))], names=[*names, into])

    return table.mapInArrow(apply, schema_of(table, f"`{into}` double"))


def summed(table: DataFrame, domains: int, steps: list[Step] | None) -> np.ndarray:
    """Expected tokens of each domain at the rates after ``steps``; without steps, of each two domains together."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(domains if steps is not None else domains * domains)
        for batch in batches:
            p = batch.column("membership").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, domains)
            tokens = batch.column("n_tokens").to_numpy().astype(np.float64)
            total += (p.T * tokens @ p).ravel() if steps is None else (tokens * rates_after(steps, p)) @ p
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["place", "total"])

    rows = table.select("n_tokens", "membership").mapInArrow(add, "place long, total double")
    found = {r["place"]: r["total"] for r in rows.groupBy("place").agg(F.sum("total").alias("total")).collect()}
    return np.array([found.get(i, 0.0) for i in range(domains if steps is not None else domains * domains)])


def fit_steps(table: DataFrame, targets: np.ndarray, tolerance: float = 1e-4, rounds: int = 200) -> tuple[list[Step], float]:
    """Projected gradient steps that bring the domain totals of ``table`` (``n_tokens, membership``) to ``targets``.

    Minimises the squares of ``total - target``, each over the domain's overlap
    with itself (which makes domains of all sizes move alike), over rates of at
    least zero.  Ends when no total is further off than ``tolerance`` of all
    targets, when the objective has stopped to fall, or after ``rounds``.
    Returns the steps and the largest distance left, as a share of all targets.
    """
    n, budget = len(targets), float(targets.sum())
    if not n or budget <= 0:
        return [], 0.0
    overlap = summed(table, n, None).reshape(n, n)
    size = np.diag(overlap)
    weight = np.divide(1.0, size, out=np.zeros(n), where=size > 0)
    # The largest step that cannot overshoot.
    scale = max(np.linalg.eigvalsh(np.sqrt(weight)[:, None] * overlap * np.sqrt(weight)).max(), 1e-300)
    steps: list[Step] = []
    before = now = summed(table, n, steps)
    best, theta, stalled = np.inf, 1.0, 0
    for _ in range(rounds):
        off = now - targets
        value = float((weight * off**2).sum())
        if np.abs(off).max() <= tolerance * budget:
            break
        stalled = stalled + 1 if value > best * (1 - 1e-6) else 0
        if stalled >= 12:
            break
        # Where the objective rose, momentum starts anew.
        theta, momentum = (1.0, 0.0) if value > best else ((1 + np.sqrt(1 + 4 * theta * theta)) / 2, (theta - 1) / ((1 + np.sqrt(1 + 4 * theta * theta)) / 2))
        best = min(best, value)
        ahead = now + momentum * (now - before)
        steps.append(Step(weight * (ahead - targets) / scale, momentum))
        before, now = now, summed(table, n, steps)
    return steps, float(np.abs(now - targets).max() / budget)


def flattened(totals: np.ndarray, power: float) -> np.ndarray:
    """The shares of these totals to this power, adding up to one."""
    shares = np.where(totals > 0, (totals / max(totals.sum(), 1.0)) ** power, 0.0)
    return shares / max(shares.sum(), 1e-300)


class Mixture(NamedTuple):
    """The classifier, the steps of the rates, documents with ``n_tokens, membership`` (stored), and how far the targets are missed at most."""

    model: Classifier
    steps: list[Step]
    table: DataFrame
    off: float


def fit_mixture(
    docs: DataFrame,
    labelled: DataFrame,
    weights: dict[str, float] | None = None,
    power: float = 0.7,
    tokens: float | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
) -> Mixture:
    """Fit rates of all documents so that each domain has its share of ``tokens`` expected words.

    ``weights`` are the shares wanted (a domain without one is to vanish); without
    them they are the domains' own shares to ``power``, so that frequent domains
    shrink and rare ones grow.  ``tokens`` is as many words as there are.
    Targets that no rates of at least zero reach are met as closely as can be;
    ``off`` says how far the worst total stays from its target, as a share of
    all tokens.  A null or empty text has no tokens and any rate; equal texts get
    equal rates.  Without labelled rows there is no domain, and all rates are one.
    """
    model = fit_domains(docs, labelled, doc_id=doc_id, text=text)
    unknown = set(weights or {}) - set(model.domains)
    if unknown and model.domains:
        raise ValueError(f"no labelled text of the domains {sorted(unknown)}")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    table = stored(with_membership(rows, model, "text", "n_tokens", "membership").drop("text"), "membership")
    totals = summed(table, len(model.domains), [])
    shares = flattened(totals, power) if weights is None else np.array([weights.get(d, 0.0) for d in model.domains])
    shares = shares / max(shares.sum(), 1e-300)
    steps, off = fit_steps(table, shares * (totals.sum() if tokens is None else tokens))
    return Mixture(model, steps, table, off)


def copies(weight: Column, key: Column) -> Column:
    """A whole number of uses whose mean over keys is the rate: the whole part, and one more by the key's hash."""
    chance = F.pmod(F.xxhash64(key, F.lit("copies")), F.lit(1 << 40)) / float(1 << 40)
    return (F.floor(weight) + (chance < weight - F.floor(weight)).cast("long")).cast("int")


def mixed_documents(docs: DataFrame, mixture: Mixture, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, each as often as its rate says (perhaps not at all), with the same columns."""
    rate, uses = fresh_name(docs, "rate"), fresh_name(docs, "uses")
    model, steps, names = docs.sparkSession.sparkContext.broadcast(mixture.model), mixture.steps, docs.columns

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in buffers.slices(batches, text, PIECE):
            rates = rates_after(steps, probabilities(batch.column(text), model.value))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rates)], names=[*names, rate])

    rated = docs.mapInArrow(apply, schema_of(docs, f"`{rate}` double"))
    used = rated.withColumn(uses, copies(F.col(rate), F.col(doc_id))).filter(F.col(uses) > 0)
    given = [F.col(f"`{c}`") for c in docs.columns]
    return used.select(*given, F.explode(F.sequence(F.lit(1), F.col(uses)))).select(*given)
