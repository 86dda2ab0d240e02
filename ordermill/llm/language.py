"""Language identification in two levels.

First the language family is predicted, then one-versus-one linear support
vector machines separate the languages of that family.  Texts are the square
roots of the shares of their hashed character n-grams, which have length one.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm import buffers
from ordermill.llm.grams import grams, labelled_sample, one_text

SIZES, BITS = (1, 2, 3), 12

#: Families of common languages; a language that is not listed is a family of its own.
FAMILIES = {
    "germanic": "af da de en is nb nl nn no sv",
    "romance": "ca es fr gl it oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "semitic": "ar he mt",
    "turkic": "az kk ky tr tt uz",
    "uralic": "et fi hu",
    "indic": "bn gu hi mr ne pa ur",
}
FAMILY = {language: family for family, members in FAMILIES.items() for language in members.split()}

UNKNOWN = "und"


class Machine(NamedTuple):
    """A linear separator: positive margins for ``first``, negative for ``second``."""

    first: str
    second: str
    weight: np.ndarray
    bias: float


class Model(NamedTuple):
    """Machines for pairs of families, and for pairs of languages in each family."""

    families: dict[str, list[str]]
    between: list[Machine]
    within: dict[str, list[Machine]]


def vectors(texts: pa.Array) -> np.ndarray:
    """One row per text, of length one (or zero, for a text without letters)."""
    owner, code = grams(texts, SIZES, BITS)
    counts = np.bincount(owner << BITS | code, minlength=len(texts) << BITS).reshape(len(texts), 1 << BITS)
    rows = np.sqrt(counts, dtype=np.float32)
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)


def separate(x: np.ndarray, y: np.ndarray, cost: float = 10.0, rounds: int = 20) -> tuple[np.ndarray, float]:
    """A linear support vector machine by dual coordinate descent; ``y`` is 1 or -1, classes weigh the same."""
    x = np.hstack([x, np.ones((len(x), 1), dtype=np.float32)]).astype(np.float64)
    share = np.where(y > 0, (y > 0).mean(), (y < 0).mean())
    upper, square = cost * 0.5 / share, (x * x).sum(axis=1)
    alpha, weight, draw = np.zeros(len(x)), np.zeros(x.shape[1]), np.random.default_rng(0)
    for _ in range(rounds):
        for i in draw.permutation(len(x)):
            new = min(max(alpha[i] - (y[i] * (weight @ x[i]) - 1) / square[i], 0.0), upper[i])
            if new != alpha[i]:
                weight += (new - alpha[i]) * y[i] * x[i]
                alpha[i] = new
    return weight[:-1].astype(np.float32), float(weight[-1])


def pairwise(x: np.ndarray, names: np.ndarray) -> list[Machine]:
    """A machine for each pair of names."""
    out = []
    for first, second in combinations(sorted(set(names.tolist())), 2):
        chosen = (names == first) | (names == second)
        out.append(Machine(first, second, *separate(x[chosen], np.where(names[chosen] == first, 1.0, -1.0))))
    return out


def fit_languages(docs: DataFrame, per_language: int = 300, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """Train on at most ``per_language`` texts of each language that rows of ``docs`` name.

    Rows with a null language, id or text are left out, and rows that share
    language and id give one text.  The chosen ids are few
    enough to be broadcast, and the chosen texts' vectors to be fitted on the
    driver: 16 kB each, read in compressed batches.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    usable = rows.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    chosen = labelled_sample(usable.select("doc_id", "lang").distinct(), "lang", "doc_id", per_language)

    def embed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in buffers.slices(batches):
            packed = [pa.compress(v.astype("<f2").tobytes(), codec="zstd", asbytes=True) for v in vectors(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("lang"), pa.array(packed, pa.binary())], names=["doc_id", "lang", "vector"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    texts = one_text(usable.join(F.broadcast(chosen), ["doc_id", "lang"]), "doc_id", "lang")
    found = texts.mapInArrow(embed, f"doc_id {kind}, lang string, vector binary").collect()
    found.sort(key=lambda r: (r["lang"], r["doc_id"], r["vector"]))
    if not found:
        return Model({}, [], {})
    x = np.stack([np.frombuffer(pa.decompress(r["vector"], decompressed_size=2 << BITS, codec="zstd", asbytes=True), "<f2").astype(np.float32) for r in found])
    names = np.array([r["lang"] for r in found], dtype=object)
    family = np.array([FAMILY.get(n, n) for n in names], dtype=object)
    families = {f: sorted(set(names[family == f].tolist())) for f in sorted(set(family.tolist()))}
    return Model(families, pairwise(x, family), {f: pairwise(x[family == f], names[family == f]) for f in families})


def decide(x: np.ndarray, names: list[str], machines: list[Machine]) -> tuple[np.ndarray, np.ndarray]:
    """The name with most pairwise wins (ties: larger sum of margins, then order), and how sure that is (0 to 1)."""
    wins, sums = np.zeros((len(x), len(names))), np.zeros((len(x), len(names)))
    at = {n: i for i, n in enumerate(names)}
    sure = np.ones((len(x), len(names)))
    for m in machines:
        margin = x @ m.weight + m.bias
        chance = 1 / (1 + np.exp(-2 * np.clip(margin, -15, 15)))
        for name, sign, p in ((m.first, 1, chance), (m.second, -1, 1 - chance)):
            wins[:, at[name]] += sign * margin > 0
            sums[:, at[name]] += sign * margin
            sure[:, at[name]] = np.minimum(sure[:, at[name]], p)
    best = np.argmax(wins + 0.5 * sums / (1 + np.abs(sums).max(axis=1, keepdims=True)), axis=1)
    return best, sure[np.arange(len(x)), best]


def identify(docs: DataFrame, model: Model, text: str = "text", into: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """All rows and columns of ``docs``, and the predicted language and its score (0 to 1).

    A text that is null or has no letter is ``und`` with score 0, and so is any
    if nothing was learned.  Equal texts get equal results.  The names in
    ``into`` must not be columns of ``docs`` already.
    """
    names = docs.columns
    held = docs.sparkSession.sparkContext.broadcast(model)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        families, between, within = held.value
        order = list(families)
        for batch in buffers.slices(batches, text, buffers.CHUNK // 4):
            said, sure = np.full(batch.num_rows, UNKNOWN, dtype=object), np.zeros(batch.num_rows)
            for at in range(0, batch.num_rows if order else 0, 1024):
                x = vectors(batch.column(text).slice(at, 1024))
                family, p = decide(x, order, between)
                for i, name in enumerate(order):
                    rows = np.flatnonzero(family == i)
                    best, q = decide(x[rows], families[name], within[name])
                    said[at + rows] = np.array(families[name], dtype=object)[best]
                    sure[at + rows] = p[rows] * q
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(said.tolist(), pa.string()), pa.array(sure)], names=[*names, *into])

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields]
    found = docs.mapInArrow(apply, ", ".join([*kinds, f"`{into[0]}` string, `{into[1]}` double"]))
    letters = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    return found.withColumns({into[0]: F.when(letters, F.col(into[0])).otherwise(UNKNOWN), into[1]: F.when(letters, F.col(into[1])).otherwise(0.0)})
