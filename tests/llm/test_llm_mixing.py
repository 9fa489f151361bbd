import heapq
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def highest_quotients(weights, caps, seats):
    """Seats one by one, ties to the earlier claimant."""
    got = [0] * len(weights)
    heap = [(-w, i) for i, w in enumerate(weights) if caps[i] > 0]
    heapq.heapify(heap)
    for _ in range(min(seats, sum(caps))):
        _, i = heapq.heappop(heap)
        got[i] += 1
        if got[i] < caps[i]:
            heapq.heappush(heap, (-weights[i] / (2 * got[i] + 1), i))
    return got


@pytest.mark.parametrize("seed", range(6))
def test_apportion_equals_highest_quotients(spark, seed):
    rng = random.Random(seed)
    rows, want = [], {}
    for group in range(4):
        n = rng.choice([1, 2, 7, 30])
        weights = [float(rng.choice([1, 2, 3, rng.randint(1, 50)])) for _ in range(n)]
        caps = [rng.choice([1, 5, 1000]) for _ in range(n)]
        seats = rng.choice([0, 1, n, 10 * n, sum(caps), sum(caps) + 5])
        for key, quota in enumerate(highest_quotients(weights, caps, seats)):
            want[group, key] = quota
        rows += [(group, key, weights[key], caps[key], seats) for key in range(n)]
    df = spark.createDataFrame(rows, "g long, k long, w double, cap long, seats long")
    got = {(r.g, r.k): r.quota for r in mixing.apportion(df, ["g"], ["k"], "w", "cap", "seats").collect()}
    assert got == want


def targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, rest, out = share * sum(sizes.values()), set(names), {}
    while rest:
        total = sum(weight[s] for s in rest)
        over = [s for s in rest if left * weight[s] / total > most * sizes[s]]
        if not over:
            return out | {s: left * weight[s] / total for s in rest}
        for s in over:
            out[s] = float(most * sizes[s])
            rest.remove(s)
            left -= out[s]
    return out


def check(rows, source_sizes, block):
    taken, seen = Counter(), {}
    for r in rows:
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
        seen[r["source"]] = (r["source_size"], r["target"])
    want = targets(source_sizes)
    for s, (size, target) in seen.items():
        assert size == source_sizes[s] and target == pytest.approx(want[s])
        assert abs(taken[s] - target) <= 1.5 * block + 1


def test_edges(docs_of, edge_rows):
    df = docs_of(edge_rows)
    sizes = defaultdict(int)
    for _, text, _, source in edge_rows:
        sizes[source] += len(WORD.findall(text or ""))
    plan = mixing.mix(mixing.sizes_of(df, "doc_id", "text", "source"), block_words=8)
    rows = [r.asDict() for r in plan.collect()]
    assert len(rows) == len(edge_rows)
    check(rows, sizes, 8)
    again = mixing.mix(mixing.sizes_of(df, "doc_id", "text", "source"), block_words=8)
    key = ["doc_id", "row", "taken"]
    assert sorted(map(str, again.select(*key).collect())) == sorted(map(str, plan.select(*key).collect()))


def test_documents_of_the_mix_hold_the_words_taken(docs_of, edge_rows):
    df = docs_of(edge_rows)
    plan = mixing.mix(mixing.sizes_of(df, "doc_id", "text", "source"), block_words=8)
    want = Counter()
    for r in plan.collect():
        want[r["doc_id"], r["source"]] += r["taken"]
    mixed = mixing.mixed_documents(df, block_words=8)
    assert mixed.columns == df.columns
    got = Counter()
    own = defaultdict(Counter)
    for i, text, *_ in edge_rows:
        own[i].update(WORD.findall(text or ""))
    for r in mixed.collect():
        words = WORD.findall(r["text"])
        assert words and not Counter(words) - own[r["doc_id"]]
        got[r["doc_id"], r["source"]] += len(words)
    assert got == +want


def test_nothing_to_mix(docs_of):
    for rows in ([], [(1, None, "en", "s"), (2, "  ", "en", None)]):
        plan = mixing.mix(mixing.sizes_of(docs_of(rows), "doc_id", "text", "source")).collect()
        assert len(plan) == len(rows) and all(r["taken"] == 0 and r["target"] == 0 for r in plan)


def test_query(spark, sf):
    rows = [r.asDict() for r in mixing.op1_mixing(spark, sf).collect()]
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("source", F.col("text")).collect()
    sizes = Counter()
    for r in docs:
        sizes[r["source"]] += len(WORD.findall(r["text"] or ""))
    check(rows, sizes, mixing.BLOCK_WORDS)


def test_equal_rows_are_dealt_to_all_shards(docs_of, monkeypatch):
    """A third of the rows is one row again and again: no shard gets them all, and the result is that of single rows."""
    monkeypatch.setattr(mixing, "SHARD_WORDS", 500)
    rows = [(None, "equal words here again", "en", "hot")] * 400
    rows += [(i, f"words of document {i} " * (i % 5), "en", "hot" if i % 2 else "s") for i in range(800)]
    df = docs_of(rows)
    sizes = Counter()
    for _, text, _, source in rows:
        sizes[source] += len(WORD.findall(text))
    plan = mixing.mix(mixing.sizes_of(df, "doc_id", "text", "source"), block_words=8)
    got = [r.asDict() for r in plan.collect()]
    assert len(got) == len(rows)
    check(got, sizes, 8)
    hot = sorted(r["taken"] for r in got if r["doc_id"] is None)
    assert len(hot) == 400 and hot[0] < hot[-1]  # blocks are chosen inside the run of copies
    mixed = Counter(r["source"] for r in mixing.mixed_documents(df, block_words=8).collect() for _ in WORD.findall(r["text"]))
    assert mixed == Counter({source: sum(r["taken"] for r in got if r["source"] == source) for source in sizes})
    # the copies lie in as many shards as the source has
    seen = []
    saved = mixing.saved
    monkeypatch.setattr(mixing, "saved", lambda t, name: seen.append((name, saved(t, name))) or seen[-1][1])
    mixing.mix(mixing.sizes_of(df, "doc_id", "text", "source"), block_words=8)
    dealt = dict(seen)["dealt"].where("doc_id IS NULL").select("shard", "copies", "shards").collect()
    assert len(dealt) == dealt[0].shards > 3 and max(r.copies for r in dealt) <= 400 // len(dealt) + 1
