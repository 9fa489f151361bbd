"""SimHash by anchor covering against all pairs."""

import random

import numpy as np
import pytest
import xxhash

from tidemark.llm import simhash_anchors as s


def fingerprint(text, width=3):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(x, 42) for x in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def classes(prints, threshold=2):
    """Smallest id reachable, over all pairs; rows of one id are one document."""
    parent = {d: d for d, _ in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, f) in enumerate(prints):
        for b, g in prints[:i]:
            if (f ^ g).bit_count() <= threshold:
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    return {d: find(d) for d in parent}


def expected(rows):
    prints = [(d, fingerprint(t)) for d, t in rows if d is not None]
    of = classes(prints)
    return sorted((d, f"{fingerprint(t):016x}", of.get(d)) for d, t in rows if d is not None)


def found(df):
    return sorted((r.doc_id, f"{r.fingerprint & 2**64 - 1:016x}", r.component_id) for r in df.collect())


@pytest.mark.parametrize("code", [s.GOLAY, s.HAMMING, (7, 1, 0xB)])
def test_blocks_are_perfect_codes(code):
    """Every word has exactly one codeword within the radius, and the listed ones are all in reach."""
    block = s.Block(code, 2)
    length, radius, _ = code
    words = np.arange(1 << length) if length < 16 else np.random.default_rng(1).integers(0, 1 << length, 3000)
    syndrome = block.syndrome(words)
    assert (block.end[syndrome, 0] - block.start[syndrome] == 1).all()
    codewords = [w for w in range(1 << min(length, 15)) if not block.syndrome(np.array([w]))[0]]
    for w in words[:40].tolist():
        rows, anchors = s.anchors_of(np.array([w], np.uint64), [block], 2)
        assert not block.syndrome(anchors).any()
        assert ((anchors ^ w) < 1 << length).all()
        if length < 16:
            assert sorted(anchors.tolist()) == [c for c in codewords if (c ^ w).bit_count() <= radius + 2]


@pytest.mark.parametrize("codes", [(s.GOLAY, s.GOLAY), (s.GOLAY, s.GOLAY, s.HAMMING), (s.HAMMING,)])
def test_every_pair_in_reach_meets_at_both_homes(codes):
    rng = np.random.default_rng(2)
    one = rng.integers(0, 2**64, 3000, dtype=np.uint64)
    flips = (np.uint64(1) << rng.integers(0, 64, (2, 3000), dtype=np.uint64))
    other = one ^ flips[0] ^ flips[1]
    blocks = s.covering(codes, 2)
    rows, home = s.anchors_of(one, blocks, 0)
    assert rows.tolist() == list(range(3000))
    rows, anchors = s.anchors_of(other, blocks, 2)
    assert set(zip(range(3000), home.tolist(), strict=True)) <= set(zip(rows.tolist(), anchors.tolist(), strict=True))


def test_links_equal_all_pairs(spark):
    """Dense groups: words within a few bits of a few centres, and far ones."""
    rng = random.Random(3)
    words = {0, 2**64 - 1, 1, 3, 7}
    for _ in range(4):
        centre = rng.getrandbits(64)
        for _ in range(60):
            near = centre
            for _ in range(rng.randint(0, 4)):
                near ^= 1 << rng.randrange(64)
            words.add(near)
    words |= {rng.getrandbits(64) for _ in range(100)}
    signed = sorted(w - 2**64 if w >> 63 else w for w in words)
    want = [(a, b) for i, a in enumerate(signed) for b in signed[i + 1:] if ((a ^ b) & 2**64 - 1).bit_count() <= 2]
    df = spark.createDataFrame([(w,) for w in signed], "fingerprint long").repartition(3)
    for codes in ((s.GOLAY, s.GOLAY), (s.GOLAY, s.GOLAY, s.HAMMING)):
        assert sorted(map(tuple, s.links(df, codes, 2).collect())) == want


def test_edges_equal_brute_force(spark, docs_of, edge_rows):
    rows = [(r[0], r[1]) for r in edge_rows]
    near = " ".join(f"word{i}" for i in range(3000))
    rows += [(200 + i, near.replace(f" word{100 * i} ", f" other{i} ")) for i in range(12)]
    rows += [(300, "a b c"), (301, "A\tB\nC"), (302, "a b"), (303, "Ä b"), (304, "ä b")]
    rows += [(8, "another text under a used id, met by nothing else"), (8, near)]
    df = docs_of([(*r, "en", "s") for r in rows])
    assert found(s.near_duplicates(df).where("doc_id IS NOT NULL")) == expected(rows)
    more = s.near_duplicates(df, many=0)  # with the third code
    assert found(more.where("doc_id IS NOT NULL")) == expected(rows)
    lost = more.where("doc_id IS NULL").collect()
    assert len(lost) == 2 and all(r.component_id is None for r in lost)
    assert sorted(r.fingerprint & 2**64 - 1 for r in lost) == sorted(
        fingerprint(t) for d, t in rows if d is None)
    assert s.near_duplicates(df.limit(0)).count() == 0


def test_large_group_of_copies(spark):
    """A third of the rows hold one text, a third near copies of another."""
    base = [f"w{i}" for i in range(400)]
    rows = [(i, "the very same text again") for i in range(100)]
    rows += [(100 + i, " ".join(base[:i] + [f"x{i}"] + base[i + 1:])) for i in range(100)]
    rows += [(200 + i, f"text {i} of its own with number {i * i}") for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found(s.near_duplicates(df)) == expected(rows)


def test_query_equals_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = s.op13_simhash_anchors(spark, sf)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(tuple, got.collect())) == expected(rows)


def test_anchors_are_not_broadcast(spark, docs_of, edge_rows, monkeypatch):
    """Spark takes the anchors of a fingerprint, some thousand bytes, for one row: it would send all of them to the driver."""
    plans, kept = {}, s.saved

    def saved(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return kept(df, name)

    monkeypatch.setattr(s, "saved", saved)
    assert s.near_duplicates(docs_of(edge_rows)).count() == len(edge_rows)
    assert "SortMergeJoin" in plans["links"] and "Broadcast" not in plans["links"]
