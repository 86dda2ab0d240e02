"""The prefix trie against a plain one of dictionaries."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from compare import connect, differences

from ordermill.llm import prefix_trie, queries


def turn_key(t):
    turn, role, text = t
    content = f"{len(role.encode())}:{role}{text}".encode()
    return (turn is not None, turn or 0, hashlib.sha256(content).hexdigest()[:45])


def plain(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn, role or "", text or ""))
    own = {c: [t[1:] for t in sorted(ts, key=turn_key)] for c, ts in own.items()}
    built = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(own.get(c - c % 5, [])[:h] + ts[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c, ts in built.items():
        ends[ts].append(c)
        for d in range(len(ts) + 1):
            members[ts[:d]].append(c)
    kids = defaultdict(int)
    leaves, saved = defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    for p in members:
        for d in range(len(p) + 1):
            leaves[p[:d]] += kids[p] == 0
            saved[p[:d]] += (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
    return sorted(
        (
            (min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), kids[p], leaves[p], saved[p])
            + (hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest(),)
            for p in members
        ),
        key=repr,
    )


def made(n, seed, convs=40):
    rng = np.random.default_rng(seed)
    return [(int(rng.integers(convs)), int(rng.integers(6)), "ua"[rng.integers(2)], "xyé"[rng.integers(3)] * int(rng.integers(3))) for _ in range(n)]


EDGES = [
    (0, None, None, None),
    (0, 1, "user", ""),
    (0, 1, "user", "same turn"),
    (0, 1, "user", "same turn"),
    (1, 0, "user", "x"),
    (4, 2, "a", "b" * 50_000),
    (9, 0, "user", "no source"),
    (None, 0, "user", "no id"),
    (None, 1, None, None),
    (12, 0, "u", "y"),
    (10, 0, "u", "y"),
]
SAME = [(c, t, "user", f"turn {t}") for c in range(60) for t in range(12)]
LONG = [(5, t, "u", str(t)) for t in range(150)] + [(c, t, "u", str(t)) for c in (6, 7) for t in range(120)]


@pytest.mark.parametrize(
    "rows, small",
    [(EDGES, False), ([], False), (EDGES + SAME + LONG, True), (made(2000, 2), True), (made(900, 3, 300), False)],
    ids=["edges", "none", "copies and long ones", "dense", "wide"],
)
def test_nodes_equal_a_plain_trie(spark, rows, small, monkeypatch):
    """Also with a tiny top, tiny shards and pieces, and long conversations cut into stretches."""
    if small:
        for name, value in (("LISTED", 20), ("SHARD", 5), ("PIECE", 2), ("STRETCH", 7)):
            monkeypatch.setattr(prefix_trie, name, value)
    table = spark.createDataFrame([(*r, 1, "z") for r in rows], "conv_id long, turn long, role string, text string, d int, bytes string")
    got = prefix_trie.prefix_trie(table)
    assert sorted(map(tuple, got.collect()), key=repr) == plain(rows)


def test_a_perfect_hash_gives_each_key_its_own_slot():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 1000):
        keys = np.unique(rng.integers(0, 1 << 63, n, dtype=np.int64)).view(np.uint64)
        index = prefix_trie.PerfectHash(keys)
        assert sorted(index.slots(keys).tolist()) == list(range(len(keys)))
    with pytest.raises(ValueError):
        prefix_trie.PerfectHash(np.array([3, 3], dtype=np.uint64))


def test_powers_may_be_negative():
    base = prefix_trie.BASES[0]
    got = prefix_trie.raised(base, np.array([0, 1, 5, -3]))
    assert got.tolist() == [pow(base, int(e), 1 << 64) for e in (0, 1, 5, -3)]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_the_query_equals_its_sql(spark, sf):
    sf_dir = f"/root/testdata/{sf}"
    assert differences(queries.op13_prefix_trie(spark, sf_dir), connect(sf_dir), queries.sql.PREFIX_TRIE) == []
