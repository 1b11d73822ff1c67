"""Mixing sources to target weights, with DataFrame functions only.

Documents are permuted within their source by a hash of their id and cut into blocks. A source's quota is how many
block draws its target takes: its blocks in permuted order, again from the first when all are through. A splitting
tree deals these quotas over the output shards: at each node half of its draws go left, how many of each source by a
multivariate-hypergeometric draw, so every shard has its exact quota of every source and the same number of draws.
A shard then draws disjoint runs of each source's permuted blocks, as long as its quotas, which says how often and
where a document is taken; rows are shuffled by hash within a shard. Shards and blocks grow in number with the words.

Null and empty texts have size 0; null sources form one source, last in order; null and shared ids are rows like
others; places that tie go by id and size; repeated rows count as often as they occur; very long texts are counted
whole; an empty table gives an empty result; columns with clashing names are kept apart from working ones.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lahar.llm.common import WORD, cut, drop, recorded

SEED = "mix-1"
#: Words of an output shard and of a permuted block, about; a source has at least 2 ** BLOCK_BITS blocks.
SHARD_WORDS, BLOCK_WORDS, BLOCK_BITS = 1 << 22, 1 << 16, 12


def hash32(*parts: Column) -> Column:
    """The first 32 bits of an MD5, as a long: the same in any SQL engine."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts).cast("binary")), 1, 8), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...], share: float, cap: float) -> DataFrame:
    """(source, source_size) with target: share of all sizes by weight, at most cap times the size, excess reshared.

    Sorted by cap over weight, the capped sources come first, so one pass finds the level of the others. The windows
    hold one row for each source, which is what one task can order.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    table = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sizes.withColumn("rank", F.row_number().over(order)).withColumn("weight", F.element_at(table, ((F.col("rank") - 1) % len(weights) + 1).cast("int")))
    ranked = ranked.withColumn("most", F.col("source_size") * F.lit(float(cap))).withColumn("full_at", F.col("most") / F.col("weight"))
    line = Window.orderBy("full_at", "rank")
    whole = Window.partitionBy()
    before, rest = line.rowsBetween(Window.unboundedPreceding, -1), line.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.sum("source_size").over(whole) * F.lit(float(share)) - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    ranked = ranked.withColumn("level", level)
    found = ranked.withColumn("level", F.min(F.when(F.col("full_at") >= F.col("level"), F.struct("full_at", "rank", "level"))).over(whole)["level"])
    return found.select("source", "source_size", "rank", F.least("most", F.coalesce(F.col("level") * F.col("weight"), F.col("most"))).alias("target"))


def _let(value: Column, then) -> Column:
    """then(value), with value computed once, so that expressions stay small."""
    return F.element_at(F.transform(F.array(value), then), 1)


def hypergeometric(own: Column, total: Column, need: Column, u: Column) -> Column:
    """How many of need draws without replacement from total are among own of them: the quantile of u in [0, 1).

    The distribution is summed from ten standard deviations under its mean to ten above, within its bounds, where its
    smallest and largest terms differ by less than a double holds: once for the whole, once up to the quantile.
    """
    n, k, m = own.cast("double"), need.cast("double"), F.greatest(total, F.lit(1)).cast("double")
    mean = n * k / m
    wide = 10 * F.sqrt(mean * (1 - n / m) * (m - k) / F.greatest(m - 1, F.lit(1.0))) + 10
    low = F.greatest(F.lit(0.0), k - (m - n), F.floor(mean - wide).cast("double"))
    high = F.least(n, k, F.ceil(mean + wide).cast("double"))
    given = F.struct(n.alias("n"), k.alias("k"), (m - n - k).alias("rest"), low.alias("low"), F.sequence(low.cast("long"), F.greatest(low, high).cast("long")).alias("inside"), u.alias("u"))

    def walk(g: Column, until: Column | None) -> Column:
        """(next term, its place, sum so far) of the terms from low on, the first as one; it stays where until is passed."""
        start = F.struct(F.lit(1.0).alias("p"), g["low"].alias("at"), F.lit(0.0).alias("sum"))

        def step(s: Column, _: Column) -> Column:
            more = s["p"] * (g["n"] - s["at"]) * (g["k"] - s["at"]) / ((s["at"] + 1) * (g["rest"] + s["at"] + 1))
            on = F.struct(more.alias("p"), (s["at"] + 1).alias("at"), (s["sum"] + s["p"]).alias("sum"))
            return on if until is None else F.when(s["sum"] + s["p"] > until, s).otherwise(on)

        return F.aggregate(g["inside"], start, step)

    def quantile(g: Column) -> Column:
        return _let(walk(g, None)["sum"] * g["u"], lambda until: F.least(walk(g, until)["at"], g["low"] + F.size(g["inside"]) - 1))

    return _let(given, quantile).cast("long")


def _source_left(seed: str):
    """Step over one source of a node: how many of its draws go left, given how many the node still needs."""

    def step(state: Column, item: Column) -> Column:
        u = hash32(F.lit(seed), F.col("shard").cast("string"), item["rank"].cast("string")) / F.lit(float(2**32))
        left = hypergeometric(item["draws"], state["all"], state["need"], u)
        return F.struct((state["need"] - left).alias("need"), (state["all"] - item["draws"]).alias("all"), F.concat(state["lefts"], F.array(left)).alias("lefts"))

    return step


def split_quotas(quotas: DataFrame, levels: int, seed: str = SEED) -> DataFrame:
    """(rank, draws) of each source -> (shard, rank, quota): a binary tree of levels, each node halved exactly.

    A node is a row that holds a number for each source; below the first levels nodes are dealt to
    tasks. Left and right always sum to their node, and shards differ by one draw at most.
    """
    tree = quotas.agg(F.array_sort(F.collect_list(F.struct("rank", "draws"))).alias("own")).select(F.lit(0).cast("long").alias("shard"), "own")
    for level in range(levels):
        total = F.aggregate("own", F.lit(0).cast("long"), lambda a, x: a + x["draws"])
        start = F.struct(F.floor(total / 2).cast("long").alias("need"), total.alias("all"), F.array().cast("array<bigint>").alias("lefts"))
        tree = tree.select("shard", "own", F.aggregate("own", start, _source_left(f"{seed}|{level}"), lambda s: s["lefts"]).alias("lefts"))
        left = F.zip_with("own", "lefts", lambda o, n: F.struct(o["rank"].alias("rank"), n.alias("draws")))
        right = F.zip_with("own", "lefts", lambda o, n: F.struct(o["rank"].alias("rank"), (o["draws"] - n).alias("draws")))
        both = F.array(F.struct((F.col("shard") * 2).alias("shard"), left.alias("own")), F.struct((F.col("shard") * 2 + 1).alias("shard"), right.alias("own")))
        tree = tree.select(F.explode(both).alias("x")).select("x.shard", "x.own")
        if level % 4 == 3:
            tree = cut(tree.repartition("shard"), "mix-tree")
    return tree.select("shard", F.explode("own").alias("x")).select("shard", "x.rank", F.col("x.draws").alias("quota"))


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = (5, 2, 1),
    share: float = 1.5,
    cap: float = 2.0,
    levels: int | None = None,
    seed: str = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    row_col: str | None = None,
) -> DataFrame:
    """One row per document: size, its source's size and target, the words taken, and the shard of each time it is taken.

    row_col is a key of each row's own, which is passed on. levels is the depth of the tree, by SHARD_WORDS if None.

    A source takes its documents whole as often as its target allows, then a run of permuted blocks up to the
    rest; in the block where the rest ends, documents go in permuted order while their middle is inside it.
    """
    with recorded() as made:
        out = cut(_taken(docs, weights, share, cap, levels, seed, id_col, text_col, source_col, row_col), "mix-taken")
    drop(docs.sparkSession, made[:-1])
    return out


def _taken(docs: DataFrame, weights: tuple[float, ...], share: float, cap: float, levels: int | None, seed: str, id_col: str, text_col: str, source_col: str, row_col: str | None) -> DataFrame:
    """What mix() gives, as a plan over tables that it writes on the way."""
    text = F.col(text_col).cast("string")
    size = F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
    place = hash32(F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.lit(seed))
    own = [F.col(row_col).alias("row")] if row_col else []
    sized = docs.select(*own, F.col(id_col).cast("long").alias("id"), F.col(source_col).cast("string").alias("source"), size.alias("size"), place.alias("place"))
    sized = cut(sized, "mix-sizes")
    words = sized.agg(F.sum("size")).head()[0] or 0
    bits = min(30, max(BLOCK_BITS, ceil(log2(words / BLOCK_WORDS + 1))))
    depth = max(1, ceil(log2(words * share / SHARD_WORDS + 1))) if levels is None else levels
    sized = sized.withColumn("block", F.shiftright("place", 32 - bits))
    blocks = cut(sized.groupBy("source", "block").agg(F.sum("size").alias("words")), "mix-blocks")
    plan = targets(blocks.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, cap)
    plan = plan.withColumn("passes", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.greatest("source_size", F.lit(1)))).otherwise(0).cast("long"))
    plan = plan.withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size"))
    line = Window.partitionBy("rank").orderBy("block")
    joined = blocks.alias("b").join(plan.alias("p"), F.col("b.source").eqNullSafe(F.col("p.source"))).select("p.*", "block", "words")
    joined = joined.withColumn("left", F.col("rest") - F.sum("words").over(line) + F.col("words")).withColumn("turn", F.row_number().over(line) - 1)
    joined = cut(joined, "mix-turns")
    # a source's quota: all its blocks in each pass, then those that the rest reaches
    quotas = joined.groupBy("rank").agg(F.count("*").alias("blocks"), F.sum(F.col("passes") + (F.col("left") > 0).cast("long")).alias("draws"))
    shares = cut(split_quotas(quotas, depth, seed), "mix-shares")
    runs = shares.where("quota > 0").withColumn("start", F.sum("quota").over(Window.partitionBy("rank").orderBy("shard")) - F.col("quota")).join(quotas.select("rank", "blocks"), "rank")
    draw = F.explode(F.sequence("start", F.col("start") + F.col("quota") - 1)).alias("draw")
    drawn = runs.select("rank", "blocks", "shard", draw).groupBy("rank", (F.col("draw") % F.col("blocks")).cast("int").alias("turn"))
    drawn = drawn.agg(F.array_sort(F.collect_list(F.struct("draw", "shard"))).alias("draws")).select("rank", "turn", F.transform("draws", lambda d: d["shard"].cast("int")).alias("shards"))
    joined = joined.join(drawn, ["rank", "turn"], "left").withColumn("shards", F.coalesce("shards", F.array().cast("array<int>")))
    rows = sized.alias("d").join(joined.alias("j"), F.col("d.source").eqNullSafe(F.col("j.source")) & (F.col("d.block") == F.col("j.block")))
    rows = rows.select(*["d.row"][: len(own)], "d.id", "d.size", "d.place", "j.*")
    within = Window.partitionBy("rank", "block").orderBy("place", "id", "size", *["row"][: len(own)]).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("middle", F.sum("size").over(within) - F.col("size") / 2)
    # as often as shards draw its block; in the block where the rest ends, the last draw takes only what is inside
    ends = (F.col("left") > 0) & (F.col("left") < F.col("words"))
    times = F.size("shards") - (ends & (F.col("middle") > F.col("left"))).cast("int")
    return rows.select(
        *[F.col("row").alias(row_col) for _ in own],
        F.col("id").alias(id_col),
        "size",
        "source_size",
        "target",
        (times * F.col("size")).alias("taken"),
        F.slice("shards", F.lit(1), times).alias("shards"),
    )


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", seed: str = SEED, shard_col: str | None = "shard", **options) -> DataFrame:
    """The mixture itself: docs' rows once for each time they are taken, with shard, shuffled by hash within a shard.

    A shard is written in slices of its hash order, each sorted, so that no task holds a whole shard.
    Rows are written once with a key of their own and joined by it, so null and shared ids are drawn as mix() says.
    With shard_col None the rows are the documents' alone.
    """
    if shard_col in docs.columns:
        raise ValueError(f"the documents have a column {shard_col} already")
    columns = [id_col, options.get("text_col", "text"), options.get("source_col", "source")]
    keyed = cut(docs.select(F.monotonically_increasing_id().alias("_mix_row"), F.struct(*docs.columns).alias("_row")), "mix-keyed")
    plain = keyed.select("_mix_row", *[F.col(f"_row.`{c}`").alias(c) for c in columns])
    taken = mix(plain, id_col=id_col, seed=seed, row_col="_mix_row", **options).select(F.col("_mix_row").alias("_taken_row"), F.posexplode("shards").alias("_time", "_shard"))
    out = keyed.join(taken, F.col("_mix_row") == F.col("_taken_row"))
    name = F.coalesce(F.col(f"_row.`{id_col}`").cast("string"), F.concat(F.lit("row "), F.col("_mix_row").cast("string")))
    order = hash32(name, F.col("_time").cast("string"), F.lit(seed))
    out = out.withColumn("_order", order).repartition("_shard", F.shiftright("_order", 32 - BLOCK_BITS)).sortWithinPartitions("_shard", "_order")
    return out.select("_row.*", *([F.col("_shard").alias(shard_col)] if shard_col else []))
