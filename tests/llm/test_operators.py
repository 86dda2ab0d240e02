"""Each operator against a plain version, on edge rows and on a small table."""

import hashlib
import re
import tracemalloc
from collections import Counter, defaultdict
from itertools import combinations
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from llm.conftest import EDGES
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ordermill.llm import buffers, encoders, grams, language, lattice, mixing, near_dedup, packing, quality_rules, queries, substrings, token_counts, topk, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.fixture(scope="module")
def docs(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")


@pytest.mark.parametrize("rows", [EDGES, []])
def test_token_counts_equal_the_tokenizer(table, rows):
    path = public_tokenizers.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    got = token_counts.token_counts(table(rows), path, 100, entries=3).collect()
    want = Counter((i, len((t or "").encode()), len(plain.encode(t or "", add_special_tokens=False).ids)) for i, t in rows)
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 100) for r in got)


@pytest.mark.parametrize("rows", [EDGES, []])
def test_packing_keeps_every_token_and_leaves_no_gap(table, rows):
    path = public_tokenizers.path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    pieces = packing.cut_documents(table(rows), path, 2, 64)
    placed = packing.place(pieces, 64).collect()
    want = Counter((i, tuple(plain.encode(t or "", add_special_tokens=False).ids) + (2,)) for i, t in rows)
    whole, places = defaultdict(list), defaultdict(list)
    for r in sorted(placed, key=lambda r: r.piece):
        assert 0 < r.length == len(r.ids) // 4 <= 64 and (r.piece == 0 or r.length == 64)
        places[r.sequence_id].append((r.offset, r.length))
        if r.doc_id != 6:
            whole[r.doc_id] += np.frombuffer(r.ids, "<u4").tolist()
    assert {(i, tuple(x)) for i, x in whole.items()} == {k for k in want if k[0] != 6}
    for held in places.values():
        held.sort()
        assert [o for o, _ in held] == np.cumsum([0, *[n for _, n in held]])[:-1].tolist()
        assert sum(n for _, n in held) <= 64


def test_a_pair_replaces_the_shortest_piece():
    # 7 takes 2, the gap is 1; 2 gives way to 1 and 2, which fill it.
    assert packing.plan_sequences({7: 1, 2: 2, 1: 1}, 10)[0].lengths == (7, 2, 1)
    plan = packing.plan_sequences({6: 1, 3: 1, 2: 2}, 10)
    assert plan[0].lengths == (6, 2, 2)
    assert sum(p.times * len(p.lengths) for p in plan) == 4


def test_plans_use_each_length_as_often_as_it_occurs():
    rng = np.random.default_rng(1)
    for _ in range(20):
        histogram = {int(x): int(n) for x, n in zip(rng.integers(1, 101, 30), rng.integers(1, 50, 30), strict=True)}
        used = Counter()
        for p in packing.plan_sequences(histogram, 100):
            assert sum(p.lengths) <= 100
            used.update({x: p.times * n for x, n in Counter(p.lengths).items()})
        assert used == histogram


@pytest.mark.parametrize("fold", [substrings.FOLD, 500])
def test_removed_words_equal_a_plain_search(spark, docs, table, fold, monkeypatch):
    monkeypatch.setattr(substrings, "FOLD", fold)
    rows = docs.unionByName(table(EDGES + [(9, "b " * 60), (10, " ".join(f"y{i % 30}" for i in range(90)))]).select("doc_id", "text"))
    seen, first, want = sorted({(r.doc_id, r.text) for r in rows.collect()}, key=lambda x: (x[0] is not None, x[0] or 0)), {}, {}
    words = {k: WORD.findall(k[1] or "") for k in seen}
    for n, k in enumerate(seen):
        for i in range(len(words[k]) - 19):
            first.setdefault(tuple(words[k][i : i + 20]), (n, i))
    for n, k in enumerate(seen):
        gone = {j for i in range(len(words[k]) - 19) if first[tuple(words[k][i : i + 20])] != (n, i) for j in range(i, i + 20)}
        want[k] = (len(words[k]), len(gone), " ".join(w for j, w in enumerate(words[k]) if j not in gone))
    for r in substrings.remove_repeats(rows).collect():
        assert (r._n_words, r._n_removed, r._kept) == want[r.doc_id, r.text]
    assert substrings.remove_repeats(table([])).count() == 0


def test_different_windows_around_one_minimiser_spread_over_buckets(spark, monkeypatch):
    monkeypatch.setattr(substrings, "BUCKET", 20_000)
    monkeypatch.setattr(substrings, "HEAVY", 20_000)
    # Of 200 trigrams the one with the least hash, between words that no other row has.
    word = [f"k{i}" for i in range(600)]
    packed_words = buffers.words(pa.array([" ".join(word)]))
    keys = buffers.window_keys(buffers.span_hashes(packed_words.data, packed_words.start, packed_words.end), 3)
    low = int(np.argmin(keys))
    texts = [" ".join([*(f"a{i}x{j}" for j in range(9)), *word[low : low + 3], *(f"b{i}x{j}" for j in range(9))]) for i in range(2000)]
    texts += texts[:5] + [" ".join(f"c{i}x{j}" for j in range(21)) for i in range(2000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    sent = []

    def spy(rows, *args, f=substrings.later_spans):
        sent.extend(rows.filter("blob is not null").groupBy("bucket").agg(F.sum("size").alias("size")).collect())
        return f(rows, *args)

    monkeypatch.setattr(substrings, "later_spans", spy)
    got = {r.doc_id: (r._n_removed, r._n_words) for r in substrings.remove_repeats(docs).collect()}
    assert all(n == (words if 2000 <= i < 2005 else 0) for i, (n, words) in got.items()) and len(got) == len(texts)
    assert max(r["size"] for r in sent) < 3 * 20_000 < sum(r["size"] for r in sent) / 4


@pytest.mark.parametrize("sizes", [(topk.CANDIDATES, topk.QUERIES, topk.PART), (16, 7, 40)])
def test_top_k_equals_a_full_comparison(spark, sizes, monkeypatch):
    for name, size in zip(("CANDIDATES", "QUERIES", "PART"), sizes, strict=True):
        monkeypatch.setattr(topk, name, size)
    rng = np.random.default_rng(2)
    rows = [(i, rng.integers(-9, 9, 20).tolist()) for i in range(300)] + [(7, [1] * 20), (None, [1] * 20), (900, None), (901, [1, None]), (902, [3]), (910, []), (911, []), (920, [1 << 40]), (921, [-(1 << 20)])]
    table = spark.createDataFrame(rows, "id long, vector array<long>")
    got = {(r.query_id, r["rank"], r.vec_id, r.score) for r in topk.exact_top_k(table.filter("id % 10 = 0"), table, 5).collect()}
    want, usable = set(), [(i, np.array(v)) for i, v in rows if i is not None and v is not None and None not in v]
    for q, x in usable:
        if q % 10 == 0:
            found = sorted((-int(x @ y), i) for i, y in usable if i != q and len(x) == len(y))[:5]
            want |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(found)}
    assert got == want
    assert topk.exact_top_k(table.limit(0), table, 5).count() == 0


@pytest.mark.parametrize("blocks", [(near_dedup.SKETCHES, near_dedup.SETS), (4, 3)])
def test_components_equal_a_plain_search(docs, table, blocks, monkeypatch):
    monkeypatch.setattr(near_dedup, "SKETCHES", blocks[0])
    monkeypatch.setattr(near_dedup, "SETS", blocks[1])
    edges = [(i and i + 100_000, t) for i, t in EDGES]
    rows = docs.unionByName(table(edges).select("doc_id", "text"))

    def shingles(text):
        w = WORD.findall(lowered(text))
        return {tuple(w[i : i + 4]) for i in range(len(w) - 3)} or ({tuple(w)} if w else set())

    sets = {r.doc_id: shingles(r.text) for r in rows.collect() if r.doc_id is not None}
    root = {i: i for i in sets}

    def find(x):
        return x if root[x] == x else find(root[x])

    for a, b in combinations(sorted(sets), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) and find(a) != find(b):
            root[max(find(a), find(b))] = min(find(a), find(b))
    for r in near_dedup.near_duplicates(rows, size=4).collect():
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), find(r.doc_id), find(r.doc_id) == r.doc_id)
    assert near_dedup.near_duplicates(table([])).count() == 0


def test_quality_statistics_and_verdicts(spark, small, docs, table):
    found, numbers, posterior = quality_rules.judged(docs)
    rows = found.collect()
    for r in rows:
        text, s = r.text or "", r[numbers]
        w = WORD.findall(text)
        windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        covered = {j for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        assert (s.n_words, s.word_chars, s.n_dup_lines, s.n_repeat_words) == (len(w), sum(map(len, w)), len(lines) - len(set(lines)), len(covered))
        assert s.n_symbols == len(re.findall(r"[#*$%&|<>]", text))
    good = {r.doc_id: r.quality for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    kept = [r[posterior] >= 0.5 for r in rows if good.get(r.doc_id) == 1 and r[numbers].n_words >= 10]
    assert np.mean(kept) > 0.95
    edge, numbers, posterior = quality_rules.judged(table(EDGES))
    assert edge.count() == len(EDGES) and (numbers, posterior) == ("statistics_", "posterior")
    assert quality_rules.judged(table([]))[0].count() == 0


def test_statistics_take_little_memory():
    """Six megabytes of texts in one batch."""
    texts = [" ".join(f"word{(i * k) % 977}" for k in range(400)) for i in range(2000)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    rows = SimpleNamespace(columns=["text"], schema=SimpleNamespace(fields=[]), mapInArrow=lambda task, kinds: task)
    task = quality_rules.with_statistics(rows, "text", "numbers")
    tracemalloc.start()
    made = sum(b.num_rows for b in task(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert made == len(texts) and peak < 140 << 20


def test_samples_are_the_smallest_hashes_of_each_label(spark):
    rows = spark.range(20_000).select("id", F.when(F.col("id") % 100 == 0, "rare").otherwise("common").alias("label"))
    kept = sorted(r.id for r in grams.labelled_sample(rows, "label", "id", 300).collect())
    held = rows.withColumn("hash", F.xxhash64("id")).orderBy("hash").collect()
    by_label = {x: [r.id for r in held if r.label == x][:300] for x in ("rare", "common")}
    assert kept == sorted(by_label["rare"] + by_label["common"])


def test_held_out_languages_and_toxicity(spark):
    sf = "/root/testdata/sf0.01"
    said = queries.op8_language_id(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in said]) > 0.97
    scored = queries.op5_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out").collect()
    assert np.mean([r.predicted for r in scored if r.toxic == 0]) < 0.02
    assert np.mean([r.predicted for r in scored if r.toxic == 1]) > 0.4


def test_weak_grams_count_and_ratios_come_from_all_rows(spark):
    # Toxic texts draw on many words; the one strongest gram alone cannot tell them, nor can the sample's ratios.
    rng = np.random.default_rng(3)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    word = ["".join(rng.choice(letters, 7)) for _ in range(400)]
    rows = [(i, " ".join(rng.choice(word[:200] if i % 2 else word[200:], 12))) for i in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit_toxicity(docs, docs.selectExpr("doc_id", "cast(doc_id % 2 as int) as toxic").filter("doc_id < 600"), per_label=100, keep=1)
    counted = np.unique(toxicity.text_sets(pa.array([t for i, t in rows if i < 600]))[1])
    assert (model.weight[counted] != 0).mean() > 0.95
    scored = toxicity.score(docs.filter("doc_id >= 600"), model).collect()
    assert np.mean([(r.score >= 0.5) == (r.doc_id % 2 == 1) for r in scored]) > 0.95


def test_a_repeated_row_teaches_toxicity_once(spark):
    rows = [(1, "bad words here")] * 50 + [(2, "other bad things"), (3, "nice day today"), (4, "good day all")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "cast(doc_id < 3 as int) as toxic")
    once, repeated = (toxicity.fit_toxicity(x, labels) for x in (docs.distinct(), docs))
    assert np.array_equal(once.weight, repeated.weight) and once.intercept == repeated.intercept


@pytest.mark.parametrize("kind", ["long", "string"])
def test_texts_without_a_label_are_left_out_before_a_shuffle(spark, kind):
    rows = spark.range(20000).selectExpr(f"cast(id as {kind}) as doc_id", "concat('text ', id) as text").unionByName(spark.createDataFrame([(None, "x")], f"doc_id {kind}, text string"))
    known = rows.filter("doc_id % 8 = 0").selectExpr("doc_id", "1 as label")
    found = toxicity.perhaps_labelled(rows, known)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    assert found.join(known, "doc_id").count() == 2500 and found.distinct().count() == found.count() < 5000
    assert toxicity.perhaps_labelled(rows, known.limit(0)).count() == 0


def test_toxicity_learns_by_ids_of_other_types(spark):
    docs = spark.createDataFrame([(1, "bad words here"), (2, "other bad things"), (3, "nice day today"), (4, "good day all"), (5, "bad"), (None, "bad")], "doc_id long, text string")
    labels = docs.filter("doc_id < 5").selectExpr("doc_id", "cast(doc_id < 3 as int) as toxic")
    models = [toxicity.fit_toxicity(docs, labels.withColumn("doc_id", F.col("doc_id").cast(kind))) for kind in ("long", "int", "decimal(20, 0)")]
    assert models[0].weight.any()
    assert all(np.array_equal(m.weight, models[0].weight) and m.intercept == models[0].intercept for m in models)


def test_a_repeated_row_teaches_languages_and_domains_once(spark, docs):
    rows = docs.filter("text is not null").orderBy("doc_id").limit(12).selectExpr("doc_id", "text", "if(doc_id % 2 = 0, 'en', 'de') as lang").localCheckpoint()
    first = rows.agg(F.min("doc_id")).first()[0]
    more = rows.unionByName(rows.filter(F.col("doc_id") == first).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(40)))).drop("n"))
    domains = rows.selectExpr("doc_id", "lang as domain")
    a, b = (mixing.fit_domains(x, domains) for x in (rows, more))
    assert np.array_equal(a.weight, b.weight) and np.array_equal(a.bias, b.bias)
    x, y = (language.fit_languages(x) for x in (rows, more))
    for m, n in zip([*x.between, *x.within["germanic"]], [*y.between, *y.within["germanic"]], strict=True):
        assert np.array_equal(m.weight, n.weight) and m.bias == n.bias


def test_lattice_sums_all_segmentations():
    pieces = [b" ", b" a", b"a", b"b", b"ab", b"ba"]
    weight = np.array([1.0, 2, 3, 4, 5, 6])
    model = lattice.lattice(pieces, weight, 1.0)
    p = dict(zip(pieces, weight / 22, strict=True))

    def total(word):
        return sum(p[x] * total(word[len(x) :]) for x in pieces if word.startswith(x)) if word else 1.0

    rows = np.array([list(b" abab"), list(b" baab")], dtype=np.uint8)
    logs, used = lattice.forward(model, rows, np.ones(2))
    assert np.allclose(np.exp(logs), [total(b" abab"), total(b" baab")])
    assert np.isclose((used * [len(x) for x in pieces]).sum(), 10)


def test_base_scores_equal_their_formula(spark, table):
    held = F.col("doc_id") % 3 == 0
    edges = [(i, t and t[:2000]) for i, t in EDGES]
    got = lattice.lattice_scores(table(edges), public_tokenizers.path("piece_bpe_32k.model"), held, rounds=1).collect()
    tokens = [(i, [*WORD.findall(lowered(t)), None]) for i, t in edges]
    c = Counter(w for i, ws in tokens if i is not None and i % 3 for w in ws)
    n = sum(c.values())
    want = sorted((i or 0, len(ws), sum(c[w] > 0 for w in ws), n, round(sum(np.log10((c[w] + 1) / (n + len(c) + 1)) for w in ws), 6)) for i, ws in tokens)
    assert sorted((r.doc_id or 0, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 for r in got)


def plain_least_squares(a, t, w, rounds=40_000):
    """The least weighted squares of ``a.T @ rates - t`` over nonnegative rates, by cyclic coordinate descent."""
    a = a[a.sum(axis=1) > 0]
    rate, off = np.ones(len(a)), a.sum(axis=0) - t
    for i in range(rounds):
        k = i % len(a)
        new = max(0.0, rate[k] - (w * off) @ a[k] / ((w * a[k]) @ a[k]))
        off += (new - rate[k]) * a[k]
        rate[k] = new
    return float((w * off**2).sum())


@pytest.mark.parametrize(
    "asked",
    [{"en": 0.4, "de": 0.3, "fr": 0.2, "es": 0.1}, {"de": 0.97, "en": 0.01, "fr": 0.01, "es": 0.01}, {"fr": 1.0}, None],
    ids=["spread", "one large", "others vanish", "flattened"],
)
def test_mixture_meets_its_targets(spark, docs, asked):
    """Domains shrink and grow within the corpus's own tokens; the result is as good as a plain nonnegative solver's."""
    labelled = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").selectExpr("doc_id", "lang as domain")
    mixture = mixing.fit_mixture(docs, labelled, weights=asked)
    rows = mixing.with_rate(mixture.table, mixture.steps, len(mixture.model.domains), "membership", "rate").collect()
    tokens = np.array([r.n_tokens for r in rows], dtype=float)
    a = tokens[:, None] * np.array([r.membership for r in rows])
    rate = np.array([r.rate for r in rows])
    shares = np.array([asked.get(d, 0.0) for d in mixture.model.domains]) if asked else mixing.flattened(a.sum(axis=0), 0.7)
    targets, totals = shares * tokens.sum(), rate @ a
    assert (rate >= 0).all() and mixture.steps
    assert mixture.off == pytest.approx(np.abs(totals - targets).max() / tokens.sum(), abs=1e-9)
    weight = 1 / (a * np.array([r.membership for r in rows])).sum(axis=0)
    least = plain_least_squares(a, targets, weight)
    at_first = (weight * (a.sum(axis=0) - targets) ** 2).sum()
    assert (weight * (totals - targets) ** 2).sum() - least <= 1e-4 * at_first
    shrunk = targets < a.sum(axis=0) * 0.9
    assert shrunk.any() and rate.min() < 0.9
    if asked and len(asked) == 1:
        assert (rate == 0).any() and mixture.off < 0.05
    else:
        assert mixture.off <= 1e-4


def test_mixtures_of_nothing_and_of_unknown_domains(spark, docs, table):
    labelled = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").selectExpr("doc_id", "lang as domain")
    empty = mixing.fit_mixture(table(EDGES), labelled.limit(0))
    assert mixing.mixed_documents(table(EDGES), empty).count() == len(EDGES)
    none = mixing.fit_mixture(docs.limit(0), labelled)
    assert none.steps == [] and none.off == 0 and mixing.mixed_documents(docs.limit(0), none).count() == 0
    with pytest.raises(ValueError, match="klingon"):
        mixing.fit_mixture(docs, labelled, weights={"klingon": 1.0})


def test_equal_texts_get_equal_rates(spark, docs):
    labelled = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").selectExpr("doc_id", "lang as domain")
    twice = docs.unionByName(docs.selectExpr("doc_id + 100000 AS doc_id", "text"))
    mixture = mixing.fit_mixture(twice, labelled)
    rates = {r.doc_id: r.rate for r in mixing.with_rate(mixture.table, mixture.steps, len(mixture.model.domains), "membership", "rate").collect()}
    assert all(rates[i] == rates[i + 100000] for i in rates if i < 100000)


def test_texts_are_classified_alike_beside_any_others():
    texts = pa.array(["a short one", "the same words again and again " * 40, "", "wörter über größe", *(f"text {i} of many words" for i in range(300))])
    draw = np.random.default_rng(1)
    model = mixing.Classifier(list("abcde"), draw.normal(size=(1 << mixing.BITS, 5)).astype(np.float32), np.zeros(5, np.float32))
    alone = np.concatenate([mixing.probabilities(texts.slice(i, 1), model) for i in range(len(texts))])
    assert np.array_equal(mixing.probabilities(texts, model), alone)


def test_training_texts_of_mixing_take_little_memory():
    """Six megabytes of texts in one batch, as a task of the sample can have them."""
    texts = [" ".join(f"word{(i * k) % 977}" for k in range(400)) for i in range(2000)]
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * len(texts)), pa.array(texts)], names=["domain", "text"])
    tracemalloc.start()
    made = sum(b.num_rows for b in mixing.embedded(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert made == len(texts) and peak < 100 << 20


def test_chunks_of_texts_change_no_removed_word(docs):
    whole, cut = (sorted(map(tuple, substrings.remove_repeats(docs, chunk=n).collect()), key=str) for n in (buffers.CHUNK, 3000))
    assert whole == cut and any(r[-2] for r in whole)


def test_the_cache_is_bounded_in_units_and_bytes():
    cache, calls = {}, []

    def encode(units):
        calls.extend(units)
        return [len(u) for u in units]

    for i in range(50):
        units = [b"%d-%d" % (i, k) for k in range(20)] + [b"x" * 2000]
        assert token_counts.through_cache(cache, units, encode, most=100, size=1500) == [len(u) for u in units]
        assert len(cache["young"]) <= 121 and cache["bytes"] <= 1500 and b"x" * 2000 not in cache["young"]
    assert len(calls) >= 50 * 21


def test_a_word_is_encoded_once_whatever_follows_it():
    encoder = encoders.load(public_tokenizers.path("byte_bpe_50k.json"))
    ends = ["", ".", ",", "'s", "!?", ")", "-x", ".'s", ".5"]
    odd = ["x it's it’s", "a<|endoftext|>. b", "3.5% a.b-c", "é, ü.", "end\u00a0. of", "a \n. \tb,\r\n 'll'LL", "", None, "a"]
    texts, asked, cache = odd + [f"The word{e} of 12{e}" for e in ends], [], {}

    def encode(units):
        asked.extend(units.to_pylist())
        return encoder.byte_ids(units)

    for _ in range(2):
        data, start, _ = encoders.byte_units(pa.array(texts))
        packing.through_table(cache, buffers.binaries(data, np.append(start, len(data))), encode)
    assert len(asked) == len(set(asked)) and [u for u in asked if b"word" in u] == [b" word"]
    ids, at = packing.encoded(pa.array(texts), encoder, cache, 2)
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [[*encoder.ids(t or ""), 2] for t in texts]


def test_the_table_of_units_is_bounded_and_changes_no_ids():
    cache, asked = {}, []

    def encode(units):
        asked.append(len(units))
        n = np.array([len(u) for u in units.to_pylist()], dtype=np.int64)
        return np.repeat(n, n).astype(np.uint32), n

    for i in range(50):
        units = [b"often", *(b"%d-%d" % (i, k) for k in range(20)), b"x" * 2000, b"often"]
        code, n, ids = packing.through_table(cache, pa.array(units, pa.large_binary()), encode, most=100, size=30_000)
        assert n[code].tolist() == [len(u) for u in units]
        ends = np.cumsum(n)
        assert all((ids[ends[c] - n[c] : ends[c]] == len(u)).all() for c, u in zip(code, units))
        weight = sum(map(len, cache["units"].to_pylist())) + 4 * len(cache["ids"])
        assert len(cache["units"]) <= 100 and weight <= 30_000 and cache["n"].sum() == len(cache["ids"])
    assert b"often" in cache["units"].to_pylist() and asked[1] == 20


def test_ids_that_do_not_stand_for_bytes_are_refused():
    encoder = encoders.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    with pytest.raises(ValueError, match="do not stand for the bytes"):
        encoder.byte_ids(pa.array([b" a", b" b"], pa.large_binary()))


def test_pipeline_stages_return_documents(spark, small):
    import corpus_pipeline

    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, small)
        assert docs.columns == columns, name
        if name != "mixing":
            assert docs.count() <= n
            n = docs.count()


def test_near_copies_are_dropped_by_their_text(spark, small):
    import corpus_pipeline

    x, y, z = (" ".join(f"{k}{i}" for i in range(40)) for k in "xyz")
    rows = [(1, x), (5, f"{x} more"), (5, y), (6, y), (5, y), (7, z), (7, f"{z} more"), (8, None), (8, None), (None, z)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = Counter((r.doc_id, r.text) for r in corpus_pipeline.drop_near_copies(spark, docs, small).collect())
    seven = [k for k in got if k[0] == 7]
    assert len(seven) == 1 and got.pop(seven[0]) == 1
    assert got == Counter([(1, x), (5, y), (8, None), (None, z)])


def test_kept_digest(spark, small):
    row = queries.op1_substring_dedup(spark, small).filter("n_removed = 0 and n_words > 0").orderBy("doc_id").first()
    text = spark.read.parquet(f"{small}/documents.parquet").filter(F.col("doc_id") == row.doc_id).first().text
    assert row.kept_sha256 == hashlib.sha256(" ".join(WORD.findall(text)).encode()).hexdigest()
