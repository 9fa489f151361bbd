"""MinHash near-dedup with SuperMinHash signatures.

Every element of a set draws its ranks without replacement: in round ``j`` it puts ``j + u`` into
a slot that it has not met before, so that the slots of one element are a random permutation and
its ranks are correlated. A slot keeps the least value. Rounds are taken for all elements of many
documents together; a document stops as soon as all its slots are below ``j``, which is after one
or two rounds for all but short texts.

Signatures are cut into bands. Documents with equal sets are one class. Classes that share a band
are candidates. First every class is held against the smallest class of each band bucket, on full
sets, then against other leaders where a bucket still holds several components;
union-find (large and small stars) joins what is linked. Then the classes of all buckets that
still hold several components are met across components, by the rarest shingles of their sets
(:func:`prefix_pairs`, which misses no link). Pairs inside a component need no look, so a bucket of
thousands of copies costs one comparison each, and no link between components is lost.
Before the sets of the first comparisons are met, a pair is put aside if set sizes rule the link out, or
if the signatures agree in far fewer slots than the threshold (``ESTIMATE_SIGMAS`` standard deviations).

The bands are chosen so that a pair at the threshold misses all of them with a probability of at
most ``MISS``.

Defined results: null or wordless texts have no shingles, link with nothing and stay; a text of
fewer words than a shingle is one shingle; rows that share a doc_id are one document, with the
links of any of its texts and the size of its largest set; rows with a null doc_id link with
nothing, have no component and stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import dropped, read_table, saved, small_batches
from tidemark.llm.shingles import mix, shingle_sets

MISS = 1e-6
MOST_SLOTS = 128
ESTIMATE_SIGMAS = 7
LEADER_ROUNDS = 2
SEED = 0x5EED


def banding(similarity: float) -> tuple[int, int]:
    """(bands, rows): the longest bands that miss a pair at the threshold rarely enough."""
    for rows in range(12, 0, -1):
        bands = MOST_SLOTS // rows
        if (1 - similarity**rows) ** bands <= MISS:
            least = int(np.ceil(np.log(MISS) / np.log1p(-(similarity**rows))))
            return least, rows
    raise ValueError("similarity is too low for banding")


def signatures(sets: list[np.ndarray], slots: int) -> np.ndarray:
    """SuperMinHash signatures (documents x slots) of non-empty sets of 64-bit hashes."""
    out = np.full((len(sets), slots), np.inf)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    element = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    order = None  # the permutation of each element still at work
    for j in range(slots):
        with np.errstate(over="ignore"):
            drawn = mix(element + np.uint64((SEED + j + 1) * 0x9E3779B97F4A7C15 % 2**64))
        value = j + (drawn >> np.uint64(32)).astype(np.float64) / 2**32
        at = j + ((drawn & np.uint64(0xFFFFFFFF)) * np.uint64(slots - j) >> np.uint64(32)).astype(np.int64)
        if order is None:
            slot = at
        else:
            rows = np.arange(len(element))
            slot = order[rows, at].astype(np.int64)
            order[rows, at] = order[:, j]
            order[:, j] = slot
        np.minimum.at(out.reshape(-1), owner * slots + slot, value)
        open_ = out.max(axis=1) >= j + 1  # values of the next round are at least j + 1
        stay = open_[owner]
        if not stay.any():
            break
        if order is None:
            order = np.tile(np.arange(slots, dtype=np.uint8 if slots <= 256 else np.int32),
                            (int(stay.sum()), 1))
            rows = np.arange(len(order))
            order[rows, slot[stay]] = 0
            order[:, 0] = slot[stay]
        else:
            order = order[stay]
        owner, element = owner[stay], element[stay]
    return out


def sketches(df: DataFrame, width: int, similarity: float) -> DataFrame:
    """(doc_id, n, set_hash, bands, signature) of (doc_id, text)."""
    bands, per = banding(similarity)
    slots = bands * per
    schema = "doc_id long, n long, set_a long, set_b long, bands array<long>, signature binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[bytes, int] = {}
        salt = np.uint64(0xD6E8FEB86659FD93)
        for batch in small_batches(batches, 2 << 20):
            sets = shingle_sets(batch.column(1).to_pylist(), width, kept)
            full = [i for i, s in enumerate(sets) if len(s)]
            values = signatures([sets[i] for i in full], slots)
            with np.errstate(over="ignore"):
                key = mix(values.view(np.uint64) + salt)
                keys = np.zeros((len(full), bands), np.uint64)
                for k in range(per):
                    keys = mix(keys * salt + key[:, k::per][:, :bands])
                small = (key & np.uint64(0xFFFF)).astype(np.uint16)
                set_a = [int(s.sum()) for s in sets]
                set_b = [int(mix(s + salt).sum()) for s in sets]
            by_row: list = [None] * len(sets)
            sig: list = [None] * len(sets)
            for i, k, v in zip(full, keys.view(np.int64), small, strict=True):
                by_row[i], sig[i] = k, v.tobytes()
            yield pa.RecordBatch.from_arrays([
                batch.column(0),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array(np.array(set_a, np.uint64).view(np.int64)),
                pa.array(np.array(set_b, np.uint64).view(np.int64)),
                pa.array(by_row, pa.list_(pa.int64())),
                pa.array(sig, pa.binary()),
            ], ["doc_id", "n", "set_a", "set_b", "bands", "signature"])

    return df.select("doc_id", F.col("text").cast("binary")).mapInArrow(run, schema)


def set_table(df: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(id, hashes) of the documents in ``wanted`` (ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[bytes, int] = {}
        for batch in small_batches(batches, 2 << 20):
            sets = shingle_sets(batch.column(1).to_pylist(), width, kept)
            hashes = pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), hashes], ["id", "hashes"])

    texts = df.join(wanted, df["doc_id"] == wanted["id"], "left_semi")
    return texts.select("doc_id", F.col("text").cast("binary")).mapInArrow(
        run, "id long, hashes array<long>")


def likely(similarity: float, slots: int) -> Column:
    """Whether sizes allow the link and signatures do not speak clearly against it."""
    least = similarity - ESTIMATE_SIGMAS * (similarity * (1 - similarity) / slots) ** 0.5
    small, large = F.least("na", "nb"), F.greatest("na", "nb")
    agree = F.aggregate(
        F.sequence(F.lit(0), F.lit(slots - 1)), F.lit(0),
        lambda total, i: total + (F.substring("sa", 2 * i + 1, 2)
                                  == F.substring("sb", 2 * i + 1, 2)).cast("int"))
    return (small >= F.floor(large * similarity)) & (agree >= int(slots * least))


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets meet ``100 * intersection >= percent * union``.

    The set of ``b`` is attached first, so the set of a much-used ``a`` travels once.
    """
    right = pairs.join(sets.select(F.col("id").alias("b"), F.col("hashes").alias("hb")), "b")
    both = right.join(sets.select(F.col("id").alias("a"), F.col("hashes").alias("ha")), "a")
    common = F.size(F.array_intersect("ha", "hb"))
    union = F.size("ha") + F.size("hb") - common
    return saved(both.where(100 * common >= percent * union).select("a", "b").distinct(), "links")


def prefix_pairs(docs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """All pairs (a, b) of (id, component) that may be linked, with different components.

    Shingles are put in one order, rare ones first. Two linked sets share one among the first few of
    both: where the first shared one stands at places i and j, at most ``1 + min(na - i, nb - j)`` are shared.
    How many first ones are enough depends on both sizes, so entries are kept apart by the size
    class of the smaller set. Under each shingle, entries of the largest component are only
    met with those of others, never with each other.
    """

    def overlap(x: Column, y: Column) -> Column:
        """Least number of shared shingles of linked sets of these sizes."""
        return F.ceil(percent * (x + y) / (100 + percent))

    step = 1.05
    sizes = docs.groupBy("component").agg(F.count(F.lit(1)).alias("held"))
    # texts that share an id are kept apart by ``part``
    rows = docs.join(sizes, "component").join(sets, "id").withColumn("part", F.xxhash64("hashes"))
    single = rows.select("id", "part", F.explode("hashes").alias("h"))
    rare = single.groupBy("h").agg(F.count(F.lit(1)).alias("f"))
    ordered = single.join(rare, "h").groupBy("id", "part").agg(
        F.sort_array(F.collect_list(F.struct("f", "h"))).alias("ordered"))
    rows = saved(
        rows.select("id", "part", "component", "held", F.size("hashes").alias("n"))
        .join(ordered, ["id", "part"]), "ordered")
    n = F.col("n")

    def entries(first: Column, size_class: Column) -> DataFrame:
        return (
            rows.withColumn("c", size_class).withColumn("first", first)
            .select("id", "component", "held", "n", "c",
                    F.posexplode(F.slice("ordered", 1, F.col("first").cast("int"))).alias("i", "e"))
            .where("e.f > 1")
            .select("id", "component", "held", "n", "c", F.col("e.h").alias("h"), (F.col("i") + 1).alias("i"))
        )

    def class_of(size: Column) -> Column:
        return F.floor(F.log(size.cast("double")) / float(np.log(step)) + 1e-9)

    small = saved(entries(n - overlap(n, n) + 1, class_of(n)), "entries")
    least = F.ceil(n * percent / 100)
    lowest = F.greatest(least, F.floor(F.pow(F.lit(step), F.col("c")) - 1e-6))
    large = saved(
        entries(n - overlap(lowest, n) + 1,
                F.explode(F.sequence(class_of(least) - 1, class_of(n) + 1))), "entries")
    dropped(rows)
    major = saved(
        small.groupBy("h", "c").agg(F.max(F.struct("held", "component")).alias("m"))
        .select("h", "c", F.col("m.component").alias("major")), "major")

    def named(df: DataFrame, end: str, of_major: bool | None) -> DataFrame:
        df = df.join(major, ["h", "c"])
        if of_major is not None:
            df = df.where((F.col("component") == F.col("major")) == of_major)
        return df.select("h", "c", *(F.col(k).alias(f"{k}_{end}") for k in ("id", "component", "n", "i")))

    possible = (
        (F.col("component_x") != F.col("component_y")) & (F.col("n_x") <= F.col("n_y"))
        & (1 + F.least(F.col("n_x") - F.col("i_x"), F.col("n_y") - F.col("i_y"))
           >= overlap(F.col("n_x"), F.col("n_y")))
    )
    met = [
        named(small, "x", mine).join(named(large, "y", theirs), ["h", "c"]).where(possible)
        .select(F.least("id_x", "id_y").alias("a"), F.greatest("id_x", "id_y").alias("b"))
        for mine, theirs in ((False, None), (True, False))
    ]
    return met[0].union(met[1]).distinct()


def components(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable, by alternating large and small stars."""
    edges = saved(links.select("a", "b").where("a <> b").distinct(), "edges")
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        # large star: every larger neighbour moves to the least of the neighbourhood
        large = (
            both.where("b > a").join(least, "a")
            .select(F.least("a", "m").alias("a"), "b").distinct()
        )
        # small star: every smaller neighbour and the node itself move to the least
        low = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
        least = low.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            low.join(least, "a").select(F.col("m").alias("a"), "b").where("a <> b")
            .union(least.select(F.col("m").alias("a"), F.col("a").alias("b")))
            .distinct()
        )
        moved = saved(small, "edges")
        # done when the edges are stars of roots: no node is both parent and child
        same = (moved.count() == edges.count()
                and moved.join(edges, ["a", "b"], "left_anti").isEmpty())
        dropped(edges)
        edges = moved
        if same:
            return edges.select(F.col("b").alias("id"), F.col("a").alias("component"))


def near_duplicates(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    width: int = 5,
    percent: int = 80,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document.

    Documents are linked from ``percent`` / 100 Jaccard similarity of their shingle sets on.
    """
    similarity = percent / 100
    bands, per = banding(similarity)
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sketch = saved(sketches(docs, width, similarity), "sketches")
    named = sketch.where(F.col("doc_id").isNotNull())
    classes = (
        named.where("n > 0").groupBy("set_a", "set_b", "n").agg(F.min("doc_id").alias("id"))
    )
    member = saved(
        named.select("doc_id", "n", "set_a", "set_b").join(
            classes, ["set_a", "set_b", "n"], "left").select("doc_id", "n", "id"),
        "members")
    # one row for each class
    ones = named.join(
        classes.withColumnRenamed("id", "doc_id"), ["doc_id", "set_a", "set_b", "n"], "left_semi"
    ).dropDuplicates(["doc_id", "set_a", "set_b", "n"])
    ones = saved(ones.select(F.col("doc_id").alias("id"), F.col("n").alias("size"), "bands",
                             "signature"), "classes")
    dropped(sketch)
    buckets = saved(
        ones.select("id", "size", F.posexplode("bands").alias("band", "key")), "buckets")
    shared = buckets.groupBy("band", "key").agg(
        F.min("id").alias("leader"), F.count(F.lit(1)).alias("held")).where("held > 1").drop("held")
    crowded = saved(buckets.join(shared, ["band", "key"]), "crowded")
    dropped(buckets)
    sets = saved(set_table(docs, crowded.select("id").distinct(), width), "sets")

    def promising(pairs: DataFrame) -> DataFrame:
        for end in "ab":
            pairs = pairs.join(
                ones.select(F.col("id").alias(end), F.col("size").alias(f"n{end}"),
                           F.col("signature").alias(f"s{end}")), end)
        return saved(pairs.where(likely(similarity, bands * per)).select("a", "b"), "pairs")

    stars = promising(
        crowded.where("id <> leader").select(F.col("leader").alias("a"), F.col("id").alias("b"))
        .distinct())
    # texts that share a doc_id hold their classes together
    several = member.groupBy("doc_id").agg(
        F.min("id").alias("a"), F.max("id").alias("hi")).where("a < hi").drop("hi")
    bound = member.join(several, "doc_id").select("a", F.col("id").alias("b")).where("a <> b")
    links = saved(verified(stars, sets, percent).union(bound), "links")
    found = components(links)

    def torn_buckets() -> DataFrame:
        """(band, key, id, component) of the buckets that still hold several components."""
        rows = crowded.join(found, "id", "left").withColumn(
            "component", F.coalesce("component", "id"))
        several = rows.groupBy("band", "key").agg(
            F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
        return saved(rows.join(several.select("band", "key"), ["band", "key"]), "torn")

    for number in range(LEADER_ROUNDS):  # against another leader of each bucket
        torn = torn_buckets()
        leaders = torn.groupBy("band", "key").agg(
            F.min(F.struct(F.xxhash64(F.lit(number), "id"), "id", "component")).alias("l"))
        pairs = torn.join(leaders, ["band", "key"]).where(F.col("component") != F.col("l.component"))
        pairs = pairs.select(F.least("id", "l.id").alias("a"), F.greatest("id", "l.id").alias("b"))
        more = verified(promising(pairs.distinct()), sets, percent)
        dropped(torn)
        if more.isEmpty():
            break
        links = saved(links.union(more), "links")
        found = components(links)

    torn = torn_buckets()
    dropped(crowded)
    cross = prefix_pairs(torn.select("id", "component").distinct(), sets, percent)
    more = verified(saved(cross, "pairs"), sets, percent)
    for table in (torn, sets, ones):
        dropped(table)
    if not more.isEmpty():
        found = components(links.union(more))
    own = F.coalesce("component", "id", "doc_id")
    result = (
        member.join(found, "id", "left").groupBy("doc_id")
        .agg(F.max("n").alias("n_shingles"), F.min(own).alias("component_id"))
        .withColumn("kept", F.col("doc_id") == F.col("component_id"))
    )
    nameless = F.lit(None).cast("long")
    lost = df.where(F.col(id_col).isNull()).select(
        nameless.alias("doc_id"), nameless.alias("n_shingles"), nameless.alias("component_id"),
        F.lit(True).alias("kept"))
    return result.unionByName(lost)


def op8_superminhash(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return near_duplicates(docs, width=3, percent=85)
