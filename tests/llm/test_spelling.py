"""Spelling variants against a plain comparison of all words."""

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from compare import connect, differences
from llm.conftest import EDGES

from ordermill.llm import queries, spelling


def near(a, b):
    """One inserted, deleted or replaced letter apart, by trying each."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(rows, every=97):
    n = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}
    links = {w: [o for o in n if near(w, o)] for w in n}
    forms = {}
    for w in n:
        best = min(links[w], key=lambda o: (-n[o], o), default=None)
        forms[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = set()
    for w in n:
        root = w
        while forms[root] is not None:
            root = forms[root]
        out.add((w, forms[w], root, n[w], len(links[w]), n.get(forms[w])))
    return out


CHAIN = [(i, "tallest " * 40 + "tallést " * 20 + "ctallést " * 10 + "ctallésx " * 5 + "ÉCLAIR éclair Éclair eclair " * 3) for i in range(3)]
MANY = [(7, " ".join(f"base{a}{b}word" for a in "abcdefghij" for b in "klmnopqrst") + " ") for _ in range(3)]
LONG = [(1, ("x" * 5000 + " ") * 3 + ("x" * 5001 + " ") * 7), (2, ("x" * 9096 + " ") * 3), (3, ("longrun" * 20 + " ") * 4)]
CODES = [(i, "lettersé word thing") for i in range(600)] + [(None, "lettersé")] * 3


@pytest.mark.parametrize(
    "rows, part",
    [(EDGES, spelling.PART), ([], spelling.PART), (CHAIN + CODES, spelling.PART), (CHAIN + MANY + LONG + CODES, 3)],
    ids=["edges", "none", "chain", "all in small parts"],
)
def test_variants_equal_a_plain_comparison(table, rows, part, monkeypatch):
    monkeypatch.setattr(spelling, "PART", part)
    monkeypatch.setattr(spelling, "VISITORS", max(2, part))
    got = spelling.spelling_variants(table(rows)).collect()
    assert len(got) == len(set(map(tuple, got)))
    assert set(map(tuple, got)) == plain(rows)


def test_the_chain_is_followed_and_the_deletion_happens(table):
    found = {r.word: r for r in spelling.spelling_variants(table(CHAIN), every=None).collect()}
    assert found["ctallésx"].form == "ctallést" and found["ctallésx"].root == "tallest"
    assert found["Éclair".replace("É", "é")].n == 9 and "Éclair" in found
    assert all(r[3] < 600 for r in plain(CODES))  # some documents delete a letter


def test_check_sums_equal_the_library():
    rng = np.random.default_rng(3)
    texts = [bytes(rng.integers(0, 256, n, dtype=np.uint8)) for n in [0, 1, 5, 63, 64, 65, 500, 0, 9]]
    data = np.frombuffer(b"".join(texts), np.uint8)
    length = np.array(list(map(len, texts)))
    prefix = np.array([zlib.crc32(b"%d:" % i) for i in range(len(texts))], dtype=np.uint32)
    got = spelling.check_sums(prefix, data, np.cumsum(length) - length, length)
    assert got.tolist() == [zlib.crc32(t, zlib.crc32(b"%d:" % i)) for i, t in enumerate(texts)]


def test_near_words_lie_in_blocks_that_meet():
    rng = np.random.default_rng(4)
    letters = [chr(c) for c in (*range(97, 123), *range(192, 256))]
    for _ in range(500):
        a = "".join(rng.choice(letters, rng.integers(5, 12)))
        at, x = int(rng.integers(len(a))), str(rng.choice(letters))
        b = [a[:at] + x + a[at:], a[:at] + x + a[at + 1 :], a[:at] + a[at + 1 :]][rng.integers(3)]
        words = pa.array([a.encode("latin-1"), b.encode("latin-1")], pa.large_binary())
        blocks = spelling.block_numbers(*spelling.buffers.layout_bytes(words))
        to = spelling.visited(blocks)
        assert blocks[0] == blocks[1] or blocks[1] in to[0] or blocks[0] in to[1]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_the_query_equals_its_sql(spark, sf):
    sf_dir = f"/root/testdata/{sf}"
    assert differences(queries.op11_spelling_variants(spark, sf_dir), connect(sf_dir), queries.sql.SPELLING_VARIANTS) == []
