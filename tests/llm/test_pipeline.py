"""The pipeline stage by stage against plain versions, through ``run`` itself."""

import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from ordermill.llm import mixing, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
PIECES = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def table():
    """Clean texts, exact and near copies, one shared passage, junk, nulls and ids with two texts."""
    rng = np.random.default_rng(11)

    def prose(n, lang):
        ends = {"en": ("ing", "the", "ed"), "de": ("ung", "der", "ich")}[lang]
        return " ".join("".join(rng.choice(list("abcdefghijklm"), rng.integers(2, 6))) + str(rng.choice(ends)) for _ in range(n))

    passage = prose(60, "en")
    texts = [(i, prose(int(rng.integers(40, 120)), "en"), "en") for i in range(30)]
    texts += [(30 + i, prose(int(rng.integers(40, 120)), "de"), "de") for i in range(10)]
    texts += [(50 + i, texts[i][1], "en") for i in range(3)]  # exact copies
    texts += [(60 + i, texts[5 + i][1] + " one more", "en") for i in range(3)]  # near copies
    texts += [(70 + i, f"{prose(50, 'en')} {passage} {prose(50, 'en')}", "en") for i in range(4)]  # a shared passage
    texts += [(80, "# $ % & | < > " * 20, "en"), (81, "too short", "en"), (82, None, "en"), (83, "", "de"), (84, "same words here again ok " * 30, "en")]
    texts += [(7, prose(70, "en"), "en"), (None, prose(70, "en"), "en")]
    return [(i, t, lang, "web", len(t or "")) for i, t, lang in texts]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The input, the stored result of each stage of one run, and the folder of the tables."""
    root = tmp_path_factory.mktemp("corpus")
    rows = table()
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(root / "documents.parquet"))
    labels = [(i, 1, 0) for i in range(0, 45, 2)] + [(80, 0, 0), (81, 0, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(root / "labels.parquet"))
    results, keep = {}, corpus_pipeline.stored

    def noted(df, name):
        results[name] = keep(df, name)
        return results[name]

    corpus_pipeline.stored = noted
    try:
        corpus_pipeline.run(spark, str(root))
    finally:
        corpus_pipeline.stored = keep
    return {"input": rows} | {k: [tuple(r) for r in v.select(*(PIECES if k == "packing" else COLUMNS)).collect()] for k, v in results.items()} | {"root": str(root)}


def test_quality_keeps_what_the_base_rule_and_the_labels_model_allow(spark, stages):
    docs = spark.read.parquet(f"{stages['root']}/documents.parquet")
    found, numbers, posterior = quality_rules.judged(docs)
    verdict = {(r.doc_id, r.text): r[posterior] >= 0.5 for r in found.collect()}
    want = []
    for row in stages["input"]:
        words = WORD.findall(row[1] or "")
        windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
        covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
        if len(words) >= 10 and 100 * len(covered) <= 20 * len(words) and verdict[row[0], row[1]]:
            want.append(row)
    assert sorted(stages["quality_rules"], key=repr) == sorted(want, key=repr)
    kept = {r[0] for r in want}
    assert kept.isdisjoint({80, 81, 82, 83, 84}) and len(kept & set(range(40))) >= 38


def test_near_copies_leave_one_row(stages):
    rows = stages["quality_rules"]

    def shingles(text):
        words = WORD.findall(lowered(text))
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or {tuple(words)}

    sets, up = [shingles(r[1]) for r in rows], list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in combinations([i for i, r in enumerate(rows) if r[0] is not None], 2):
        if len(sets[a] & sets[b]) * 100 >= 80 * len(sets[a] | sets[b]):
            up[root(a)] = root(b)
    groups = defaultdict(list)
    for i, r in enumerate(rows):
        groups[root(i) if r[0] is not None else ("alone", i)].append(r)
    kept = Counter(stages["near_dedup"])
    assert kept.total() == len(groups)
    for members in groups.values():
        stay = [r for r in members if kept[r]]
        assert len(stay) == 1 and (stay[0][0] is None or stay[0][0] == min(r[0] for r in members))
    assert {50, 51, 52, 60, 61, 62}.isdisjoint({r[0] for r in stages["near_dedup"]})


def test_repeated_passages_go(stages):
    rows = sorted(stages["near_dedup"], key=lambda r: (r[0] is not None, r[0] or 0))
    first, want = {}, []
    words = [WORD.findall(r[1]) for r in rows]
    for d, w in enumerate(words):
        for i in range(len(w) - 19):
            first.setdefault(tuple(w[i : i + 20]), (d, i))
    for d, (row, w) in enumerate(zip(rows, words, strict=True)):
        gone = {i + k for i in range(len(w) - 19) if first[tuple(w[i : i + 20])] != (d, i) for k in range(20)}
        left = " ".join(x for i, x in enumerate(w) if i not in gone)
        if not gone or left:
            text = left if gone else row[1]
            want.append((row[0], text, row[2], row[3], len(text)))
    assert sorted(stages["substring_dedup"], key=repr) == sorted(want, key=repr)
    assert any(len(a[1]) < len(b[1]) for a, b in zip(sorted(stages["substring_dedup"], key=repr), sorted(stages["near_dedup"], key=repr), strict=True))


def test_mixing_uses_each_row_as_its_rate_says(spark, stages):
    rows = stages["substring_dedup"]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    wanted = {r for r in range(0, 45, 2)} | {80, 81}
    labelled = docs.selectExpr("doc_id", "lang AS domain").filter(docs.doc_id.isin(sorted(wanted)))
    mixture = mixing.fit_mixture(docs, labelled)
    rated = mixing.with_rate(mixture.table, mixture.steps, len(mixture.model.domains), "membership", "rate").collect()
    uses, got = {r.doc_id: r.rate for r in rated}, Counter(stages["mixing"])
    assert set(got) <= set(rows)
    for row in rows:
        assert int(uses[row[0]]) <= got[row] <= int(uses[row[0]]) + 1 or row[0] == 7
    tokens = {lang: sum(n * len(WORD.findall(r[1])) for r, n in got.items() if r[2] == lang) for lang in ("en", "de")}
    before = {lang: sum(len(WORD.findall(r[1])) for r in rows if r[2] == lang) for lang in ("en", "de")}
    assert tokens["de"] / before["de"] > tokens["en"] / before["en"]


def test_packing_holds_every_token_of_every_use(stages):
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    plain.encode_special_tokens = True
    want = Counter()
    for row in stages["mixing"]:
        ids = plain.encode(row[1] or "", add_special_tokens=False).ids + [2]
        cut = len(ids) % 1024 or 1024
        start, piece = 0, 0
        while start < len(ids):
            part = ids[start : start + (cut if piece == 0 else 1024)]
            want[row[0], piece, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
            start, piece = start + len(part), piece + 1
    places = defaultdict(list)
    got = Counter()
    for r in stages["packing"]:
        got[r[:5]] += 1
        places[r[5]].append((r[6], r[3]))
    assert got == want
    for held in places.values():
        held.sort()
        assert [o for o, _ in held] == [0, *np.cumsum([n for _, n in held]).tolist()[:-1]] and sum(n for _, n in held) <= 1024


def test_no_documents_no_sequences(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
