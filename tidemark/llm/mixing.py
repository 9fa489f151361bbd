"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

Sizes are words. A source's documents are dealt by a seeded hash into shards of about
``SHARD_WORDS`` words; inside a shard they stand in seeded order and are cut into blocks of equal
size (about ``block_words``; a block may begin and end inside a document). Targets are the sources'
weighted shares of the wanted total; no target passes ``most_repeats`` times its source, and what
is left over is shared again by weight until none does. Blocks are then allotted to sources by highest
quotients ``weight / (2 k + 1)``, and each source's blocks to its shards in the same way, with
shards weighing what they hold. A shard that gets ``q`` of its ``n`` blocks takes ``q // n`` whole passes
and ``q % n`` further blocks, those with the smallest seeded hashes.

Quotients are not allotted one by one. Water-filling gives a level at which all seats but about
one for each claimant are already fixed; only the quotients around that level are ranked. One source
may hold any share of the rows: no step after the sizes sees a source as one group of documents;
what is grouped by source is one row for each shard. Equal rows are one row with a count, whose copies are
dealt evenly to the shards and cut into blocks by arithmetic, so copies of one text do not meet in a shard.

Defined results: null and empty texts have size 0 and are never taken; a null source is a source
of its own, last in order; rows with a null doc_id, and repeated rows, take part like any others (equal
rows stand next to each other; in :func:`mixed_documents` rows of one id, text and source have the other
columns of one of them); a total of 0 gives targets of 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, WORD, read_table, saved

SHARD_WORDS = 1_000_000
BLOCK_WORDS = 64
SEED = 1


def water_level(df: DataFrame, group: list[str], weight: str, cap: str, total: str) -> DataFrame:
    """Adds ``level``: the least value at which ``sum(min(cap, weight * level)) = total`` by group.

    With less to share out than the caps hold; else the level at which the last cap is met.
    """
    turn = F.col(cap) / F.col(weight)
    by = Window.partitionBy(*group).orderBy("__turn")
    below = by.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(*group)
    capped = F.coalesce(F.sum(cap).over(below), F.lit(0.0))
    weights = F.sum(weight).over(every) - F.coalesce(F.sum(weight).over(below), F.lit(0.0))
    level = (F.col(total) - F.col("__capped")) / F.col("__weights")
    return (
        df.withColumn("__turn", turn)
        .withColumn("__capped", capped).withColumn("__weights", weights)
        .withColumn("__level", level)
        # that of the first claimant, by turn, whose cap lies above it; later ones are lower
        .withColumn("level", F.coalesce(
            F.max(F.when(F.col("__turn") >= F.col("__level"), F.col("__level"))).over(every),
            F.max("__turn").over(every)))
        .drop("__turn", "__capped", "__weights", "__level")
    )


def apportion(
    df: DataFrame, group: list[str], key: list[str], weight: str, cap: str, seats: str
) -> DataFrame:
    """Adds ``quota``: ``seats`` of the group by Sainte-Laguë, none above ``cap`` (whole numbers).

    Equal quotients go in the order of ``key``. Weights are positive; ``seats`` is the same in
    all rows of a group. If the caps hold fewer seats, all caps are filled.
    """
    n = F.count(F.lit(1)).over(Window.partitionBy(*group))

    def seats_at(level: Column) -> Column:
        """Seats whose quotients are at least 1 / (2 level)."""
        return F.least(F.col("__cap"), F.greatest(F.lit(0.0), F.floor(F.col(weight) * level + 0.5)))

    low = (
        df.withColumn("__cap", F.col(cap).cast("double"))
        .withColumn("__total", F.col(seats).cast("double")).withColumn("__n", n)
        .withColumn("__less", F.greatest(F.lit(0.0), F.col("__total") - F.col("__n") / 2 - 1))
        .withColumn("__more", F.col("__total") + F.col("__n") / 2 + 1)
    )
    # rounding moves each claimant by half a seat at most, so these levels lie on either side
    low = water_level(low, group, weight, "__cap", "__less").withColumnRenamed("level", "__low")
    low = water_level(low, group, weight, "__cap", "__more").withColumnRenamed("level", "__high")
    low = (
        low.withColumn("__sure", seats_at(F.col("__low") * (1 - 1e-12)))
        .withColumn("__may", F.greatest("__sure", seats_at(F.col("__high") * (1 + 1e-12) + 1e-12)))
        .withColumn("__open", F.col("__total") - F.sum("__sure").over(Window.partitionBy(*group)))
    )
    seat = F.explode(F.sequence(F.lit(1), (F.col("__may") - F.col("__sure")).cast("long")))
    claims = low.where("__may > __sure").select(*group, *key, "__open", "__sure", weight,
                                               seat.alias("__k"))
    quotient = F.col(weight) / (2 * (F.col("__sure") + F.col("__k")) - 1)
    rank = Window.partitionBy(*group).orderBy(F.desc("__quotient"), *key)
    won = (
        claims.withColumn("__quotient", quotient)
        .withColumn("__rank", F.row_number().over(rank)).where("__rank <= __open")
        .groupBy(*(F.col(c).alias(f"__w_{c}") for c in [*group, *key]))
        .agg(F.count(F.lit(1)).alias("__won"))
    )
    same = [F.col(c).eqNullSafe(F.col(f"__w_{c}")) for c in [*group, *key]]
    return low.join(won, same, "left").select(
        *df.columns,
        (F.col("__sure") + F.coalesce("__won", F.lit(0))).cast("long").alias("quota"))


def cyclic_weights(sources: DataFrame, weights: tuple[float, ...]) -> DataFrame:
    """Weights by place in code point order, null last, starting anew when they run out.

    One row for each source stands in the window.
    """
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.asc_nulls_last("source"))) - 1
    values = F.array(*(F.lit(float(w)) for w in weights))
    return sources.withColumn("weight", F.get(values, place % len(weights)))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mix(
    sizes: DataFrame,
    *,
    weights: tuple[float, ...] = (3.0, 1.0, 2.0),
    share: float = 1.5,
    most_repeats: int = 2,
    block_words: int = BLOCK_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """What the mix takes of each row of (doc_id, source, row, row2, size): adds ``source_size``,
    ``target``, ``taken``, ``passes`` (whole copies) and ``spans`` (word ranges taken once more).

    ``row`` and ``row2`` tell rows apart that differ.
    """
    order = F.xxhash64(F.lit(seed), "row", "row2")
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    totals = cyclic_weights(totals, weights)
    every = Window.partitionBy("__all")
    totals = (
        totals.withColumn("__all", F.lit(0))
        .withColumn("total", share * F.sum("source_size").over(every))
        .withColumn("most", (F.col("source_size") * most_repeats).cast("double"))
    )
    totals = water_level(totals, ["__all"], "weight", "most", "total")
    totals = (
        totals.withColumn("target", F.least("most", F.col("weight") * F.col("level")))
        .withColumn("shards", F.greatest(F.lit(1), F.round(F.col("source_size") / SHARD_WORDS)).cast("long"))
        .drop("level")
    )
    totals = saved(totals, "sources")
    small = totals.select(F.col("source").alias("__source"), "shards", "source_size", "target")

    # one row for each source; sources that hold many rows are joined by AQE's skew handling
    grouped = sizes.groupBy("doc_id", "source", "row", "row2", "size").agg(F.count(F.lit(1)).alias("equal"))
    dealt = grouped.join(small, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    # copies of a row go to as many shards as there are; a row of size 0 has nothing to be cut
    runs = F.when(F.col("size") > 0, F.least("equal", "shards")).otherwise(F.lit(1)).cast("long")
    dealt = saved(
        dealt.withColumn("order", order)
        .withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), runs - 1)))
        .withColumn("copies", F.floor(F.col("equal") / runs) + (F.col("run") < F.col("equal") % runs).cast("long"))
        .withColumn("shard", F.pmod(
            F.pmod(F.xxhash64(F.lit(seed + 1), "row", "row2"), "shards") + F.col("run"), F.col("shards"))),
        "dealt")
    shards = dealt.groupBy("source", "shard").agg(F.sum(F.col("size") * F.col("copies")).alias("held")).where("held > 0")
    shards = saved(
        shards.withColumn("blocks", F.greatest(F.lit(1), F.round(F.col("held") / block_words)).cast("long")),
        "shards")

    blocks = shards.groupBy(F.col("source").alias("__source")).agg(F.sum("blocks").alias("blocks"))
    claims = totals.join(blocks, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    # a source's weight in words becomes a weight in its blocks, which differ a little in size
    claims = (
        claims.withColumn("wanted", F.col("target") * F.col("blocks") / F.col("source_size"))
        .withColumn("seats", F.round(F.sum("wanted").over(every)))
        .withColumn("cap", F.col("blocks") * most_repeats)
        .withColumn("claim", F.when(F.col("target") < F.col("most"), F.col("wanted"))
                    .otherwise(F.col("cap").cast("double")))
    )
    seated = apportion(claims, ["__all"], ["source"], "claim", "cap", "seats").select(
        F.col("source").alias("__source"), F.col("quota").alias("seats"))
    parts = shards.join(seated, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    parts = (
        parts.withColumn("claim", F.col("blocks").cast("double"))
        .withColumn("cap", F.col("blocks") * most_repeats)
    )
    parts = apportion(parts, ["source"], ["shard"], "claim", "cap", "seats")
    block_hash = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1),
        lambda b: F.struct(F.xxhash64(F.lit(seed), "source", "shard", b).alias("h"), b.alias("b")))
    more = F.col("quota") % F.col("blocks")
    parts = saved(
        parts.select(
            F.col("source").alias("__source"), F.col("shard").alias("__shard"), "held", "blocks",
            F.floor(F.col("quota") / F.col("blocks")).alias("passes"),
            # the last of the shard's further blocks, by hash; null: none
            F.when(more > 0, F.get(F.array_sort(block_hash), (more - 1).cast("int"))).alias("last")),
        "quotas")

    at = Window.partitionBy("source", "shard").orderBy("order", "row", "row2")
    words = F.col("size") * F.col("copies")
    copy = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))
    full = (
        dealt.where("size > 0")
        .withColumn("start", F.sum(words).over(at.rowsBetween(Window.unboundedPreceding, 0)) - words)
        .join(parts, F.col("source").eqNullSafe(F.col("__source")) & (F.col("shard") == F.col("__shard")), "left")
        .withColumn("copy", copy)
        .withColumn("start", F.col("start") + F.col("copy") * F.col("size"))
    )
    empty = dealt.where("size = 0").withColumn("copy", copy)
    placed = full.unionByName(empty, allowMissingColumns=True).withColumn("end", F.col("start") + F.col("size"))

    def cut(b: Column) -> Column:
        """Where block ``b`` begins: blocks of a shard differ by one word at most."""
        return F.floor(b.cast("decimal(20)") * F.col("held") / F.col("blocks")).cast("long")

    # blocks that may overlap the document; the rounding of the division is made good by the bounds
    first = F.greatest(F.lit(0), F.floor(F.col("start") / F.col("held") * F.col("blocks")).cast("long") - 1)
    last = F.least(F.col("blocks") - 1, F.ceil(F.col("end") / F.col("held") * F.col("blocks")).cast("long") + 1)
    chosen = F.filter(
        F.sequence(first, last),
        lambda b: (F.struct(F.xxhash64(F.lit(seed), "source", "shard", b).alias("h"), b.alias("b"))
                   <= F.col("last")) & (cut(b) < F.col("end")) & (cut(b + 1) > F.col("start")))
    spans = F.when(
        (F.col("size") > 0) & F.col("last").isNotNull(),
        F.transform(chosen, lambda b: F.struct(
            (F.greatest(cut(b), "start") - F.col("start")).alias("from"),
            (F.least(cut(b + 1), "end") - F.col("start")).alias("to"))),
    )
    once = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["to"] - s["from"])
    passes = F.when(F.col("size") > 0, F.coalesce("passes", F.lit(0))).otherwise(F.lit(0))
    return (
        placed.withColumn("spans", spans).withColumn("passes", passes.cast("long"))
        .withColumn("taken", F.col("passes") * F.col("size") + F.coalesce(once, F.lit(0).cast("long")))
        .select("doc_id", "source", "row", "row2", "size", "source_size", "target", "taken", "passes", "spans")
    )


def row_keys(id_col: str, text_col: str, source_col: str) -> tuple[Column, Column]:
    """128 bits of a row's id, text and source."""
    parts = [F.col(f"`{c}`") for c in (id_col, text_col, source_col)]
    return F.xxhash64(*parts), F.xxhash64(F.lit(1), *parts)


def sizes_of(df: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(doc_id, source, row, row2, size), written once."""
    row, row2 = row_keys(id_col, text_col, source_col)
    return saved(
        df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").alias("source"),
                  row.alias("row"), row2.alias("row2"),
                  word_count(F.col(f"`{text_col}`")).alias("size")),
        "sizes")


def mixed_documents(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options
) -> DataFrame:
    """The mix itself: whole copies, and one row with the words taken once more, joined by the
    white space that stood before each, stretch by stretch. All columns pass through."""
    plan = mix(sizes_of(df, id_col, text_col, source_col), **options)
    plan = plan.where("taken > 0").select(
        F.col("row").alias("__row"), F.col("row2").alias("__row2"), F.col("passes").alias("__passes"),
        F.col("spans").alias("__spans"))
    row, row2 = row_keys(id_col, text_col, source_col)
    text = F.col(f"`{text_col}`")
    # one of equal rows, cut to one before the shuffle: it stands for all of them, whatever is taken of each
    others = [F.col(f"`{c}`") for c in df.columns if c not in (id_col, text_col, source_col)]
    first = Window.partitionBy("__row", "__row2").orderBy(F.xxhash64(F.lit(0), *others))
    rows = df.withColumns({"__row": row, "__row2": row2}).withColumn("__nth", F.row_number().over(first))
    met = rows.where(F.col("__nth") == 1).join(plan, ["__row", "__row2"])
    tokens = F.regexp_extract_all(text, F.lit(f"{SPACE}*{WORD}"), F.lit(0))
    pieces = F.flatten(F.transform("__spans", lambda s: F.slice(
        tokens, (s["from"] + 1).cast("int"), (s["to"] - s["from"]).cast("int"))))
    part = F.when(F.size("__spans") > 0, F.array(F.ltrim(F.array_join(pieces, ""))))
    copies = F.concat(F.array_repeat(text, F.col("__passes").cast("int")),
                      F.coalesce(part, F.array().cast("array<string>")))
    others = [F.col(f"`{c}`") for c in df.columns if c != text_col]
    out = met.select(*others, F.explode(copies).alias(text_col))
    return out.select(*(F.col(f"`{c}`") for c in df.columns))


def op1_mixing(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return mix(sizes_of(docs, "doc_id", "text", "source")).select(
        "doc_id", "size", "source_size", "target", "taken", "source")
