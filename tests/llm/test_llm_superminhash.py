import random

import numpy as np
import pytest

from tidemark.llm import superminhash


def shingles(text, width):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def brute_force(rows, width, percent):
    """(smallest id reachable) of each id, over all pairs."""
    sets = [(i, shingles(t, width)) for i, t, *_ in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (a, x) in enumerate(sets):
        for b, y in sets[:k]:
            common = len(x & y)
            if common and 100 * common >= percent * (len(x) + len(y) - common):
                ra, rb = root(a), root(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {i: root(i) for i, _ in sets}


def check(df, rows, width, percent):
    want = brute_force(rows, width, percent)
    got = [r for r in superminhash.near_duplicates(df, width=width, percent=percent).collect()]
    named = {r.doc_id: r for r in got if r.doc_id is not None}
    assert {i: r.component_id for i, r in named.items()} == want
    assert all(r.kept == (i == want[i]) for i, r in named.items())
    for i, r in named.items():
        assert r.n_shingles == max(len(shingles(t, width)) for j, t, *_ in rows if j == i)
    nameless = [r for r in got if r.doc_id is None]
    assert len(nameless) == sum(1 for i, *_ in rows if i is None) and all(r.kept for r in nameless)


def test_signature_by_element():
    """The rounds give what the definition gives element by element."""
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 2**63, n).astype(np.uint64)) for n in (1, 2, 5, 40, 400)]
    together = superminhash.signatures(sets, 60)
    for s, row in zip(sets, together, strict=True):
        alone = np.min([superminhash.signatures([s[k:k + 1]], 60)[0] for k in range(len(s))], axis=0)
        assert np.array_equal(row, alone)
        # the ranks of one element are a permutation: one value in each unit interval
        one = superminhash.signatures([s[:1]], 60)[0]
        assert sorted(np.floor(one)) == list(range(60))


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(2)
    errors = []
    for _ in range(60):
        both = rng.integers(0, 2**63, 300).astype(np.uint64)
        a, b = np.unique(both[:240]), np.unique(both[60:])
        x, y = superminhash.signatures([a, b], 120)
        errors.append((x == y).mean() - 0.6)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < (0.6 * 0.4 / 120) ** 0.5 * 1.25


def test_edges(docs_of, edge_rows):
    rows = edge_rows + [(50, "ONE", "en", "s"), (51, "two  WORDS", "en", "s")]
    check(docs_of(rows), rows, 3, 85)


def test_empty_table(docs_of):
    assert superminhash.near_duplicates(docs_of([])).count() == 0


def test_texts_that_share_an_id(docs_of):
    rng = random.Random(4)
    x, y = (" ".join(rng.choice("abcdefghij") + str(rng.randint(0, 99)) for _ in range(60)) for _ in range(2))
    rows = [(5, x, "en", "s"), (5, y, "en", "s"), (6, x + " tail", "en", "s"), (4, y + " tail", "en", "s")]
    check(docs_of(rows), rows, 3, 85)


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
def test_chains_and_crowds_equal_brute_force(docs_of, width, percent):
    """Near copies of one text with many different rates of change, and chains of changes."""
    rng = random.Random(width)
    vocabulary = [f"v{i}" for i in range(300)]
    base = [rng.choice(vocabulary) for _ in range(150)]
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(rng.randint(0, 14)):
            words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
        rows.append((i, " ".join(words), "en", "s"))
    words = [rng.choice(vocabulary) for _ in range(120)]
    for i in range(60):
        words[(i * 2) % 120] = f"step{i}"
        rows.append((1000 - i, " ".join(words), "en", "s"))
    check(docs_of(rows), rows, width, percent)


def test_query(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = brute_force(rows, 3, 85)
    got = {r.doc_id: r.component_id for r in superminhash.op8_superminhash(spark, sf).collect()}
    assert got == want
