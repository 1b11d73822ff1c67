"""Near-duplicate documents by bottom-k sketches, confirmed on full shingle sets.

One hash function over word shingles; the K smallest values of a document are its sketch. Documents with the same
set are one node. Two sets alike enough share at least `least_shared` of their sketches (chance of less under 1e-9,
whatever their sizes), so with values ordered rarest first they meet in the inverted list of a value among the
first K - least + 1 of each: only those are listed. Every node of a list is paired with the list's leader; the pair
goes on if the bottom-K of the union, of which the sketches tell how much both hold, makes the similarity possible.
Sets that fit in a sketch are decided there, the others by their full sets. Links join nodes into components.

A list that still holds several components is open. Its nodes are listed anew, by their full sets: a pair of given
sizes needs so large an overlap that it shares one of the few rarest values of each (under a tenth of a set for
sets of one size), rarest among the open nodes. Documents that share a passage but have own text, and copies of
copies with edits of their own, then meet in no list, so no group is compared all against all. Nodes of one such
list make a pair only if the parities of their sets allow a link: a bit that differs is a value that one of them
lacks, and sets that link lack few. Pairs of different components go through the sketches and the full sets like the
others. No list is capped, and what is known to be connected is not compared again.

Texts without words have no shingles and link with nothing; with fewer words than a shingle, all words are one.
Null ids link with nothing and have a null component. Repeated rows share their component. An empty table gives an
empty result. Very long texts are hashed in slices. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from math import ceil, comb, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lahar.llm.common import arrow_schema, chunks_of, cut, docs_in, drop, recorded, small_batches
from lahar.llm.substrings import mixed, window_hashes, word_hashes, word_spans

K = 48
CHUNK = 1 << 20
MISSED = 1e-9
#: Partners of one node are dealt in groups of about so many, each with the node's text or label.
FANOUT = 64
#: Rows of one set are dealt in so many parts where they meet their component.
SALTS = 256
#: Sizes that differ by less than this ratio are of one class.
CLASS = 1.02
#: Words of 64 bits in which a set's values are counted by parity.
WORDS = 16


def least_shared(percent: int, k: int) -> int:
    """So many of k union values are in both sets but for a chance of MISSED, at a similarity of percent."""
    p, below, r = percent / 100, 0.0, 0
    while (below := below + comb(k, r) * p**r * (1 - p) ** (k - r)) < MISSED:
        r += 1
    return r


def shingle_sets(texts: list[bytes | None], width: int) -> list[np.ndarray]:
    """The sorted distinct 64-bit hashes of each text's shingles, ASCII letters in lower case."""
    data = np.frombuffer(b" ".join((t or b"").lower() for t in texts), np.uint8)
    start, end = word_spans(data)
    ends = np.cumsum([len(t or b"") + 1 for t in texts])
    counts = np.bincount(np.searchsorted(ends, start, "right"), minlength=len(texts))
    words = word_hashes(data, start, end, 0)
    wide = window_hashes(words, width, 0)
    out, at = [], 0
    for c in counts.tolist():
        if c >= width:
            out.append(np.unique(wide[at : at + c - width + 1]))
        elif c:
            out.append(mixed(window_hashes(words[at : at + c], c, 0) + np.uint64(c)))
        else:
            out.append(np.empty(0, np.uint64))
        at += c
    return out


def _digest(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def sketches(source: DataFrame, width: int) -> DataFrame:
    """(id, n, node, sketch) of each row of (id, text): set size, a 128-bit name of the set, its K smallest values."""
    small_batches(source.sparkSession)
    kind = source.schema["id"].dataType.simpleString()
    own = arrow_schema(f"id {kind}").field(0).type

    def run(batches):
        for ids, texts in chunks_of(batches, CHUNK):
            sets = shingle_sets(texts, width)
            rows = [(len(s), _digest(s), s[:K].view(np.int64).tolist()) for s in sets]
            n, node, sketch = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(ids, own), pa.array(n, pa.int64()), pa.array(node, pa.binary()), pa.array(sketch, pa.list_(pa.int64()))], ["id", "n", "node", "sketch"])

    return source.mapInArrow(run, f"id {kind}, n long, node binary, sketch array<long>")


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    """One row of unsigned values for each list, filled up with the largest value."""
    size = np.diff(lists.offsets.to_numpy())
    out = np.full((len(size), width), np.iinfo(np.uint64).max, np.uint64)
    out[np.arange(width) < size[:, None]] = lists.flatten().to_numpy().view(np.uint64)
    return out


def estimated(a: pa.Array, b: pa.Array, na: np.ndarray, nb: np.ndarray, percent: int, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(possible, certain) of each pair of k-value sketches and set sizes: certain where both sets are whole in them."""
    values = np.sort(np.concatenate([_matrix(a, k), _matrix(b, k)], 1), 1)
    real = values != np.iinfo(np.uint64).max
    twice = np.concatenate([np.zeros((len(values), 1), bool), (values[:, 1:] == values[:, :-1]) & real[:, 1:]], 1)
    place = np.cumsum(~twice & real, 1)
    shared = (twice & (place <= k)).sum(1)
    both = twice.sum(1)
    whole = (na <= k) & (nb <= k)
    alike = 100 * both >= percent * (na + nb - both)
    return np.where(whole, alike, shared >= least), whole


def _possible(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (x, y, group, groups) whose sketches allow a link, with certain: whether they prove it."""
    a = nodes.select(F.col("node").alias("x"), F.col("sketch").alias("sx"), F.col("n").alias("nx"))
    b = _bases(pairs).join(nodes.select(F.col("node").alias("y"), F.col("sketch").alias("sy"), F.col("n").alias("ny")), "y").select("y", _every_group(), "sy", "ny")
    sized = (F.col("nx") * 100 >= F.col("ny") * percent) & (F.col("ny") * 100 >= F.col("nx") * percent)
    both = pairs.join(a, "x").join(b, ["y", "group"]).where(sized).select("x", "y", "group", "groups", "sx", "sy", "nx", "ny")

    k, least = K, least_shared(percent, K)

    def run(batches):
        for batch in batches:
            fine, certain = estimated(batch.column(4), batch.column(5), batch.column(6).to_numpy(), batch.column(7).to_numpy(), percent, k, least)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(certain)], ["x", "y", "group", "groups", "certain"]).filter(pa.array(fine))

    return both.mapInArrow(run, "x binary, y binary, group int, groups int, certain boolean")


def _bases(pairs: DataFrame) -> DataFrame:
    return pairs.select("y", "groups").distinct()


def _every_group() -> Column:
    return F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("group")


def _grouped(pairs: DataFrame) -> DataFrame:
    """Pairs (x, y) with the partners of each y dealt in groups."""
    partners = pairs.groupBy("y").agg(F.ceil(F.count("*") / FANOUT).cast("int").alias("groups"))
    return pairs.join(partners, "y").select("x", "y", F.pmod(F.xxhash64("x"), F.col("groups")).cast("int").alias("group"), "groups")


def _texts(wanted: DataFrame, nodes: DataFrame, source: DataFrame) -> DataFrame:
    """(node, text) of the row of smallest id of each wanted node."""
    first = nodes.join(wanted, "node").select("node", F.col("id").alias("first_id"))
    return cut(source.join(first, F.col("id") == F.col("first_id")).select("node", "text"), "neardup-texts")


def _confirmed(pairs: DataFrame, nodes: DataFrame, source: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs whose full sets are alike enough, as (x, y, group, groups)."""
    sure, open_pairs = pairs.where("certain").drop("certain"), pairs.where("NOT certain")
    texts = _texts(open_pairs.select(F.col("x").alias("node")).union(open_pairs.select(F.col("y").alias("node"))).distinct(), nodes, source)
    left = open_pairs.join(texts, open_pairs["x"] == texts["node"]).select("y", "group", "groups", "x", "text")
    bases = _bases(open_pairs)
    right = bases.join(texts, bases["y"] == texts["node"]).select(F.col("y").alias("base_node"), F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("base_group"), F.col("text").alias("base_text"))

    def compare(few: pa.Table, one: pa.Table) -> pa.Table:
        out: list[int] = []
        if few.num_rows and one.num_rows:
            name = one.column("base_node")[0].as_py()
            base = next((s for s in shingle_sets(one.column("base_text").cast(pa.binary()).to_pylist(), width) if _digest(s) == name), None)
            names = few.column("x").to_pylist()
            for k, t in enumerate(few.column("text").cast(pa.binary()).to_pylist()):
                s = shingle_sets([t], width)[0]
                if base is not None and _digest(s) == names[k]:  # rows that share an id but not the text are told apart here
                    both = len(np.intersect1d(s, base, assume_unique=True))
                    if 100 * both >= percent * (len(s) + len(base) - both):
                        out.append(k)
        return few.select(["x", "y", "group", "groups"]).take(pa.array(out, pa.int64()))

    schema = "x binary, y binary, group int, groups int"
    found = left.groupBy("y", "group").cogroup(right.groupBy("base_node", "base_group")).applyInArrow(compare, schema)
    return sure.union(found)


def components(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, label): for each node with an edge, the smallest (id, node) connected with it.

    Smallest labels spread over edges and along labels, so rounds grow with the logarithm of the longest path. The
    label of a node with many partners goes to each group of them, so no key holds more than a group.

    Each round drops the labels before it, and with them the tables that its joins broadcast: Spark keeps these on
    every executor, a memory page each however few their rows, until the driver has collected its garbage.
    """
    bases = cut(_bases(edges), "neardup-bases")
    ends = edges.select(F.col("x").alias("node")).union(edges.select(F.col("y").alias("node"))).distinct()
    with recorded() as before:
        labels = cut(ends.join(nodes.select("node", "id"), "node").select("node", F.struct("id", "node").alias("label")), "neardup-labels")
    while True:
        told = bases.join(labels, bases["y"] == labels["node"]).select("y", _every_group(), "label")
        down = edges.join(told, ["y", "group"]).select(F.col("x").alias("to"), "label")
        up = edges.join(labels, edges["x"] == labels["node"]).select(F.col("y").alias("to"), "label")
        near = down.union(up).groupBy("to").agg(F.min("label").alias("near"))
        step = labels.join(near, labels["node"] == near["to"]).select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        # only labels of nodes that have another label themselves lead further: roots, where most labels point, do not
        jump = labels.where(F.col("label.node") != F.col("node")).select(F.col("node").alias("at"), F.col("label").alias("beyond"))
        step = step.join(jump, F.col("label.node") == F.col("at"), "left").select("node", "old", F.least("label", F.coalesce("beyond", "label")).alias("label"))
        with recorded() as made:
            step = cut(step, "neardup-labels")
        labels = step.select("node", "label")
        drop(nodes.sparkSession, before)
        before = made
        if step.where(F.col("old") != F.col("label")).isEmpty():
            return labels


def _linked(pairs: DataFrame, nodes: DataFrame, source: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs whose sketches and full sets are alike enough, written; nothing else stays that was needed for them."""
    with recorded() as made:
        links = cut(_confirmed(cut(_possible(pairs, nodes, percent), "neardup-pairs"), nodes, source, width, percent), "neardup-links")
    drop(nodes.sparkSession, made[:-1])
    return links


def _joined(labels: DataFrame, links: DataFrame, nodes: DataFrame) -> DataFrame:
    """Labels after more links: these join components, so the graph to walk has a node for each component."""
    part = lambda c: labels.select(F.col("node").alias(c), F.col("label.node").alias(f"of_{c}"))
    between = links.join(part("x"), "x", "left").join(part("y"), "y", "left")
    between = _grouped(between.select(F.coalesce("of_x", "x").alias("x"), F.coalesce("of_y", "y").alias("y")).where("x != y").distinct())
    wider = components(cut(between, "neardup-between"), nodes).select(F.col("node").alias("root"), F.col("label").alias("wider"))
    alone = links.select(F.col("x").alias("node")).union(links.select(F.col("y").alias("node"))).distinct().join(labels, "node", "left_anti")
    every = labels.union(alone.join(nodes.select("node", "id"), "node").select("node", F.struct("id", "node").alias("label")))
    return cut(every.join(wider, F.col("label.node") == F.col("root"), "left").select("node", F.coalesce("wider", "label").alias("label")), "neardup-labels")


def _rarest(values: DataFrame, docs: DataFrame, keep: list[str]) -> DataFrame:
    """Of (node, *keep, value): each node's values that others hold too, as rare, from (docs, value) pairs in order."""
    held = values.join(docs, "value").groupBy("node", *keep)
    return held.agg(F.array_sort(F.collect_list(F.struct("docs", "value"))).alias("rare"), F.sum("docs").alias("score"))


def _shared(values: DataFrame) -> DataFrame:
    """(value, docs) of the values that several nodes hold."""
    return values.groupBy("value").agg(F.count("*").alias("docs")).where("docs > 1")


def _lists(nodes: DataFrame, percent: int) -> DataFrame:
    """(node, score, value): the sketch values by which a node can be found, rarest first, as many as a link needs.

    A set that is whole in its sketch shares 2 - 1 / similarity of it with the sketch of any set it links with.
    """
    values = nodes.select("node", "n", F.explode("sketch").alias("value"))
    size = F.least("n", F.lit(K))
    need = F.when(F.col("n") <= K, F.ceil(F.col("n") * (2 - 100 / percent) - 1e-9)).otherwise(F.lit(least_shared(percent, K)))
    alone = size - F.size("rare")
    listed = _rarest(values, _shared(values), ["n"]).withColumn("room", (size - need + 1 - alone).cast("int")).where("room > 0")
    return cut(listed.select("node", "score", F.explode(F.slice("rare", F.lit(1), F.col("room"))).alias("x")).select("node", "score", "x.value"), "neardup-lists")


def _stars(lists: DataFrame) -> DataFrame:
    """(x, y, group, groups): every node of a list with the list's leader.

    The node whose values are shared most leads: of a group of edited copies, what they were edited from.
    """
    leaders = lists.groupBy("value").agg(F.max_by("node", F.struct("score", "node")).alias("y"), F.count("*").alias("members")).where("members > 1")
    groups = leaders.groupBy("y").agg(F.ceil(F.sum("members") / FANOUT).cast("int").alias("groups"))
    led = lists.join(leaders.join(groups, "y"), "value").where(F.col("node") != F.col("y"))
    return led.select(F.col("node").alias("x"), "y", F.pmod(F.xxhash64("node"), F.col("groups")).cast("int").alias("group"), "groups").distinct()


def _open_nodes(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """(node, part, odd) of the nodes of lists with several components; odd: outside the largest of some list."""
    part = labels.select(F.col("node").alias("of"), F.col("label.node").alias("part"))
    named = cut(lists.join(part, F.col("node") == F.col("of"), "left").select("value", "node", F.coalesce("part", "node").alias("part")), "neardup-named")
    parts = named.groupBy("value", "part").agg(F.count("*").alias("size"))
    several = parts.groupBy("value").agg(F.count("*").alias("parts"), F.max_by("part", F.struct("size", "part")).alias("largest")).where("parts > 1")
    odd = (F.col("part") != F.col("largest")).alias("odd")
    return cut(named.join(several, "value").select("node", "part", odd).groupBy("node", "part").agg(F.max("odd").alias("odd")), "neardup-open")


def parities(s: np.ndarray) -> np.ndarray:
    """64 * WORDS bits, each the parity of how many values of the set fall on it."""
    odd = np.bincount((s % np.uint64(64 * WORDS)).astype(np.int64), minlength=64 * WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _apart(n: Column, m: Column, percent: int) -> Column:
    """The most values that only one of two sets of n and m values has, if they link."""
    return n + m - 2 * F.ceil((n + m) * percent / (100 + percent) - 1e-9)


def _full_sets(texts: DataFrame, width: int) -> DataFrame:
    """(node, n, all, bits) of (node, text): the whole set and its parities, from the text that gives it."""
    small_batches(texts.sparkSession)

    def run(batches):
        for names, some in chunks_of(batches, CHUNK):
            rows = [(x, len(s), s.view(np.int64), parities(s)) for x, s in zip(names, shingle_sets(some, width), strict=True) if _digest(s) == x]
            if rows:
                node, n, values, bits = zip(*rows, strict=True)
                longs = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(node, pa.binary()), pa.array(n, pa.int64()), pa.array(values, longs), pa.array(bits, longs)], ["node", "n", "all", "bits"])

    return texts.mapInArrow(run, "node binary, n long, all array<long>, bits array<long>")


def _open_pairs(lists: DataFrame, labels: DataFrame, nodes: DataFrame, source: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs (x, y) of different components that share a list and one of the rarest values of their full sets.

    The parities of their sets must differ in no more bits than sets that link can differ in values. Sets of a and b values that link share at least percent * (a + b) / (100 + percent) of them. A node is listed,
    for each class of partner sizes, under as many of its rarest values as the smallest such overlap demands.
    """
    found = _open_nodes(lists, labels)
    sets = cut(_full_sets(_texts(found.select("node"), nodes, source), width), "neardup-sets")
    values = sets.select("node", "n", F.explode("all").alias("value"))
    n, step = F.col("n"), log(CLASS)
    rare = _rarest(values, _shared(values), ["n"]).withColumn("alone", n - F.size("rare"))
    rare = rare.where(F.col("alone") <= n - F.ceil(n * percent / 100 - 1e-9))
    own = F.floor(F.log(n) / step).cast("int")
    reach = ceil(log(100 / percent) / step) + 1
    sized = rare.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.col("own") - reach, F.col("own") + reach)))
    least = F.greatest(F.ceil(F.pow(F.lit(CLASS), F.col("other")) - 1e-6), F.ceil(n * percent / 100 - 1e-9), F.lit(1))
    room = n - F.ceil((n + least) * percent / (100 + percent) - 1e-9) + 1 - F.col("alone")
    sized = sized.withColumn("room", room.cast("int")).where("room > 0")
    entries = sized.select("node", "own", "other", F.explode(F.slice("rare", F.lit(1), F.col("room"))).alias("x")).select("node", "own", "other", "x.value")
    entries = cut(entries.join(found, "node"), "neardup-entries")
    bits = [f"b{k}" for k in range(WORDS)]
    known = sets.select("node", "n", *[F.col("bits")[k].alias(c) for k, c in enumerate(bits)])
    several = entries.groupBy("value").agg(F.min("part").alias("one"), F.max("part").alias("another"), F.max("odd").alias("odds")).where("odds AND one != another")
    entries = entries.join(several.select("value"), "value").join(known, "node")
    side = lambda c, own, other: [F.col("node").alias(c), "value", F.col(own).alias("own"), F.col(other).alias("other"), *[F.col(k).alias(f"{c}{k}") for k in ("part", "odd", "n", *bits)]]
    a, b = entries.where("odd").select(side("x", "own", "other")), entries.select(side("y", "other", "own"))
    differ = sum((F.bit_count(F.col(f"x{k}").bitwiseXOR(F.col(f"y{k}"))) for k in bits), F.lit(0))
    alike = (F.col("xpart") != F.col("ypart")) & ((F.col("x") > F.col("y")) | ~F.col("yodd")) & (differ <= _apart(F.col("xn"), F.col("yn"), percent))
    met = a.join(b, ["value", "own", "other"]).where(alike)
    return met.select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).distinct()


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 85, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): every row, with the smallest id that links lead to.

    With row_col, a key of each row's own, also that key and component, which tells components of one id apart.
    """
    if percent < 85:
        raise ValueError("the sketch bounds hold for similarities of 85 percent and more")
    with recorded() as made:
        out = cut(_classes(docs, width, percent, id_col, text_col, row_col), "neardup-classes")
    drop(docs.sparkSession, made[:-1])
    return out


def _classes(docs: DataFrame, width: int, percent: int, id_col: str, text_col: str, row_col: str | None) -> DataFrame:
    """What near_duplicates() gives, as a plan over tables that it writes on the way."""
    source = docs_in(docs, id_col, text_col)
    if row_col:
        source = docs.select(F.struct(F.col(id_col).cast("long").alias("id"), F.col(row_col).alias("row")).alias("id"), F.col(text_col).cast("string").alias("text"))
        rows = cut(sketches(source, width).select("id.id", "id.row", "n", "node", "sketch"), "neardup-rows")
        source = source.select("id.id", "text")
    else:
        rows = cut(sketches(source, width), "neardup-rows")
    real = (F.col("n") > 0) & F.col("id").isNotNull()
    salt = F.pmod(F.xxhash64("id", *["row"][: bool(row_col)]), F.lit(SALTS)).cast("int")
    nodes = rows.where(real).groupBy("node").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.collect_set(salt).alias("salts"))
    nodes = cut(nodes, "neardup-nodes")
    lists = _lists(nodes, percent)
    links = _linked(_stars(lists), nodes, source, width, percent)
    labels = components(links, nodes)
    with recorded() as made:
        more = cut(_open_pairs(lists, labels, nodes, source, width, percent), "neardup-met")
    drop(docs.sparkSession, made[:-1])
    if not more.isEmpty():
        more = _linked(_grouped(more), nodes, source, width, percent)
        if not more.isEmpty():
            labels = _joined(labels, more, nodes)
    named = labels.select(F.col("node").alias("of"), "label")
    found = nodes.join(named, F.col("node") == F.col("of"), "left").select(F.col("node").alias("key"), F.explode("salts").alias("salt"), F.coalesce("label", F.struct("id", "node")).alias("label"))
    joined = rows.withColumn("key", F.when(real, F.col("node"))).withColumn("salt", salt).join(found, ["key", "salt"], "left")
    component = F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("label.id"))
    own = [F.col("row").alias(row_col), F.col("label.node").alias("component")] if row_col else []
    out = joined.select(*own, F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True)))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of each component, of smallest id and then text, and every row that has no component.

    Rows are written once with a key of their own, by which they stay or go, whatever rows share their id.
    """
    keyed = cut(docs.select(F.monotonically_increasing_id().alias("_near_row"), F.struct(*docs.columns).alias("_row")), "neardup-keyed")
    plain = keyed.select("_near_row", *[F.col(f"_row.`{c}`").alias(c) for c in (id_col, text_col)])
    found = near_duplicates(plain, id_col=id_col, text_col=text_col, row_col="_near_row", **options).select("_near_row", "component", "kept")
    gone = found.where(~F.col("kept")).select("_near_row")
    first = found.where(F.col("kept") & F.col("component").isNotNull())
    twice = first.join(first.groupBy("component").count().where("count > 1").select("component"), "component").select("component", "_near_row")
    texts = twice.join(plain.select("_near_row", F.col(text_col).alias("_text")), "_near_row")
    stays = texts.groupBy("component").agg(F.min(F.struct("_text", "_near_row")).alias("_least")).select("_least._near_row")
    gone = gone.union(twice.select("_near_row").join(stays, "_near_row", "left_anti"))
    return keyed.join(gone, "_near_row", "left_anti").select("_row.*")
