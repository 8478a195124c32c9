"""Trie of conversation prefixes, with subtree totals by parallel tree contraction.

1. Turns are numbered and hashed along each conversation by scans over ranges, so a conversation of any length is no single
   task's work. A prefix is known by its depth and the exclusive or of the 128-bit hashes of (place, role, text) up to it.
2. Equal prefixes are one node, named by its smallest member; a node's parent is the prefix without the last turn.
3. Contraction, in rounds of joins on node keys: rake takes off all leaves, whose totals are complete, and adds them to their
   parents; compress takes nodes with one child out of chains, by coins: a node leaves if its coin shows heads and its child
   is no leaf and stays. Its child goes on under its parent, with what the chain's nodes have gathered. A round takes off all
   leaves and about a quarter of the chains' nodes, so rounds grow with the logarithm of the nodes, also for one long chain.
4. Expansion: the total of a node taken out of a chain is what it had gathered and its child's total. The links from such
   nodes to their children are followed by doubling, to nodes whose totals are complete.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandwise.operators.scan import dealt, running
from strandwise.storage import discard, stored

#: Most rounds of a contraction (72 for a chain of a billion nodes, by the coins' mean); bytes of a piece of a list of ids.
ROUNDS, PIECE = 200, 1 << 16


def rebuilt_turns(conversations: DataFrame, span: int = 100, heads: int = 6) -> tuple[DataFrame, DataFrame]:
    """((conv_id, place, h1, h2, chars) of each turn of each rebuilt conversation, places from 1; (conv_id) of all of them).

    Rebuilt: the first h turns of the conversation of id c - c % span, then c's own after its first h; h is the checksum of
    the decimal id modulo heads. c % span has the sign of c. Turns that tie are ordered by role and text."""
    cut = conversations.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")])
    order = ["turn", "role", "text"]
    ranges = dealt(cut, ["conv_id"], order)
    numbered = running(ranges, ["conv_id"], order, {"n": ("sum", F.lit(1).cast("long"))}).drop("_range", "turn")
    numbered = stored(numbered.withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads))
    discard(ranges)
    convs = stored(numbered.groupBy("conv_id", "h").agg(F.max("n").alias("n_own")).withColumn("base", F.col("conv_id") - F.col("conv_id") % span))
    sizes = convs.select(F.col("conv_id").alias("base"), F.col("n_own").alias("n_base"))
    taken = stored(convs.join(sizes, "base", "left").withColumn("taken", F.least("h", F.coalesce("n_base", F.lit(0)))).select("conv_id", "base", "h", "taken"))
    shared = numbered.filter(F.col("n") < heads).select(F.col("conv_id").alias("base"), "n", "role", "text")
    lent = taken.filter("taken > 0").join(shared, "base").filter("n <= taken").select("conv_id", F.col("n").alias("place"), "role", "text")
    shift = taken.select(F.col("conv_id").alias("own"), (F.col("taken") - F.col("h")).alias("shift"))
    own = numbered.filter("n > h").join(shift, F.col("conv_id") == F.col("own")).select("conv_id", (F.col("n") + F.col("shift")).alias("place"), "role", "text")
    hashed = lambda seed: F.xxhash64(F.lit(seed), "place", F.octet_length("role"), "role", "text")
    turns = lent.unionAll(own).select("conv_id", "place", hashed("one").alias("h1"), hashed("two").alias("h2"), F.char_length("text").cast("long").alias("chars"))
    return turns, convs.select("conv_id")


def prefix_nodes(turns: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(stored nodes (id, conv_id, depth, n_convs, chars, parent, parent_conv_id), stored ends (id, conv_id): where each
    conversation ends). The root is the node of depth 0."""
    ranges = dealt(turns, ["conv_id"], ["place"])
    keyed = running(ranges, ["conv_id"], ["place"], {"k1": ("xor", F.col("h1")), "k2": ("xor", F.col("h2"))}).drop("_range")
    empty = convs.select("conv_id", F.lit(0).cast("long").alias("place"), *[F.lit(0).cast("long").alias(c) for c in ("h1", "h2", "chars", "k1", "k2")])
    keyed = stored(keyed.select(*empty.columns).unionAll(empty))
    discard(ranges)
    grouped = keyed.groupBy(F.col("place").alias("depth"), "k1", "k2").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("chars").alias("chars"), F.max("h1").alias("h1"), F.max("h2").alias("h2"))
    named = stored(grouped.withColumn("id", F.monotonically_increasing_id()))
    above = named.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    below = named.withColumn("p1", F.col("k1").bitwiseXOR(F.col("h1"))).withColumn("p2", F.col("k2").bitwiseXOR(F.col("h2")))
    nodes = stored(below.join(above, ["depth", "p1", "p2"], "left").select("id", "conv_id", "depth", "n_convs", "chars", "parent", "parent_conv_id"))
    last = stored(keyed.groupBy("conv_id").agg(F.max(F.struct("place", "k1", "k2")).alias("e")).select("conv_id", F.col("e.place").alias("depth"), "e.k1", "e.k2"))
    ends = stored(last.join(named.select("id", "depth", "k1", "k2"), ["depth", "k1", "k2"]).select("id", "conv_id"))
    discard(keyed, named, last)
    return nodes, ends


def subtree_totals(nodes: DataFrame, values: list[str], rounds: int = ROUNDS) -> DataFrame:
    """(id, one column a value): sums over each node's subtree, its own included. nodes: (id, parent or null, values), one tree.

    gathered is what a node has of its subtree so far, passed what goes to its parent besides its own total: the sums of the
    chain nodes taken out between the two.
    """
    own, extra = [f"_own_{v}" for v in values], [f"_up_{v}" for v in values]
    zero = F.lit(0).cast("long")
    live = stored(nodes.select("id", "parent", *[F.col(v).cast("long").alias(o) for v, o in zip(values, own, strict=True)], *[zero.alias(e) for e in extra]))
    complete: list[DataFrame] = []
    skipped: list[DataFrame] = []
    for n in range(rounds):
        coin = lambda c: F.pmod(F.xxhash64(F.lit(n), c), F.lit(2)) == 0  # noqa: B023, E731
        # one shuffle tells each node its number of children and, if that is one, the child
        kids = live.filter("parent is not null").select(F.col("parent").alias("id"), F.col("id").alias("child"))
        both = live.withColumn("child", F.lit(None).cast("long")).withColumn("here", F.lit(True)).unionByName(kids.withColumn("here", F.lit(None).cast("boolean")), allowMissingColumns=True)
        state = both.groupBy("id").agg(F.max("parent").alias("parent"), F.count("child").alias("n"), F.max("child").alias("child"), *[F.max(c).alias(c) for c in own + extra])
        state = stored(state)
        complete.append(state.filter("n = 0").select("id", *own))
        inner = state.filter("n > 0")
        if inner.isEmpty():
            break
        chains = inner.filter((F.col("n") == 1) & F.col("parent").isNotNull() & coin("id"))
        stays = inner.filter((F.col("n") > 1) | ~coin("id")).select(F.col("id").alias("child"), *[F.col(e).alias(f"_child{e}") for e in extra])
        # what a node taken out has beside its child's total: its own, and what was taken out between the two before
        links_own = [(F.col(o) + F.col(f"_child{e}")).alias(f"_link{o}") for o, e in zip(own, extra, strict=True)]
        out = stored(chains.join(stays, "child").select("id", "child", "parent", *own, *extra, *links_own))
        # one more brings each node what its leaves had, and the child of a node taken out its new parent
        rows = inner.select("id", "parent", *own, *extra)
        rows = rows.withColumns({"new": F.lit(None).cast("long"), "gone": F.lit(False)})
        raked = state.filter("n = 0 and parent is not null").groupBy(F.col("parent").alias("id")).agg(*[F.sum(F.col(o) + F.col(e)).alias(o) for o, e in zip(own, extra, strict=True)])
        moved = out.select(F.col("child").alias("id"), F.col("parent").alias("new"), *[(F.col(o) + F.col(e)).alias(e) for o, e in zip(own, extra, strict=True)])
        left = out.select("id", F.lit(True).alias("gone"))
        news = rows.unionByName(raked, allowMissingColumns=True).unionByName(moved, allowMissingColumns=True).unionByName(left, allowMissingColumns=True)
        merged = news.groupBy("id").agg(F.coalesce(F.max("new"), F.max("parent")).alias("parent"), F.max("gone").alias("gone"), *[F.coalesce(F.sum(c), zero).alias(c) for c in own + extra])
        before, live = live, stored(merged.filter("not gone").drop("gone"))
        discard(before)
        skipped.append(out)
    else:
        raise RuntimeError(f"not contracted in {rounds} rounds: the parents hold a cycle, or there is more than one root")
    known = complete[0]
    for part in complete[1:]:
        known = known.unionAll(part)
    if not skipped:
        return known.select("id", *[F.col(o).alias(v) for v, o in zip(values, own, strict=True)])
    parts = [part.select("id", "child", *[F.col(f"_link{o}").alias(o) for o in own]) for part in skipped]
    links = parts[0]
    for part in parts[1:]:
        links = links.unionAll(part)
    links, open_links = stored(links), None
    while True:  # each step doubles how far down a link reaches
        further = links.select(F.col("id").alias("child"), F.col("child").alias("_next"), *[F.col(o).alias(f"_more{o}") for o in own])
        open_links = links.join(further, "child", "left")
        if open_links.filter("_next is not null").isEmpty():
            break
        before, links = links, stored(open_links.select("id", F.coalesce("_next", "child").alias("child"), *[(F.col(o) + F.coalesce(f"_more{o}", zero)).alias(o) for o in own]))
        discard(before)
    below = known.select(F.col("id").alias("child"), *[F.col(o).alias(f"_more{o}") for o in own])
    expanded = links.join(below, "child").select("id", *[(F.col(o) + F.col(f"_more{o}")).alias(o) for o in own])
    return known.unionAll(expanded).select("id", *[F.col(o).alias(v) for v, o in zip(values, own, strict=True)])


def list_digests(ends: DataFrame) -> DataFrame:
    """(id, ends_sha256): the SHA-256 of the decimal conv_ids of each id, ascending, comma-joined. Ranges of (id, conv_id) make
    pieces of the lists; a task reads the pieces of a list in order and holds one at a time, so ids may be of any number."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, key, first = [], 0, None, 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([key]), pa.array([first]), pa.array([",".join(held)])], ["id", "first", "ids"])

        for batch in batches:
            for node, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if held and (node != key or size > PIECE):
                    yield out()
                    held, size = [], 0
                if not held:
                    key, first = node, conv
                held.append(str(conv))
                size += len(held[-1]) + 1
        if held:
            yield out()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([key]), pa.array([state.hexdigest()])], ["id", "ends_sha256"])

        for batch in batches:
            for node, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if state is not None and node == key:
                    state.update(b",")
                else:
                    if state is not None:
                        yield out()
                    key, state = node, hashlib.sha256()
                state.update(ids.encode())
        if state is not None:
            yield out()

    cut = ends.repartitionByRange("id", "conv_id").sortWithinPartitions("id", "conv_id").select("id", "conv_id").mapInArrow(pieces, "id long, first long, ids string")
    return cut.repartition("id").sortWithinPartitions("id", "first").mapInArrow(digests, "id long, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) for every node of the trie of
    rebuilt conversations. conversations: (conv_id, turn, role, text, any others).

    A null turn comes first, a null role or text is empty, rows without a conv_id belong to no conversation and are left out.
    Repeated rows are turns of their own; turns that tie are ordered by role and text, so their order never depends on the
    input's. A conversation without turns of its own exists only through its rows, so an empty table has no root and no rows.
    Texts of any length are read whole, once.
    """
    turns, convs = rebuilt_turns(conversations)
    nodes, ends = prefix_nodes(turns, convs)
    children = nodes.filter("parent is not null").groupBy(F.col("parent").alias("id")).agg(F.count("*").alias("n_children"))
    counted = stored(nodes.join(children, "id", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))))
    own = counted.select("id", "parent", F.when(F.col("n_children") == 0, 1).otherwise(0).alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"))
    out = counted.join(subtree_totals(own, ["n_leaves", "saved_tokens"]), "id").join(list_digests(ends), "id", "left")
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", none).alias("ends_sha256"))


#: The same rows by prefix strings, and totals by each node's smallest member.
TRIE_SQL = """WITH raw AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
t AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n FROM raw),
steps AS (SELECT conv_id, list_reduce(list_prepend(4294967295::bigint, list_transform(range(0, 8 * length(conv_id::varchar)), lambda i: CASE WHEN i % 8 = 0 THEN ascii(substr(conv_id::varchar, (i // 8 + 1)::int, 1))::bigint ELSE 0::bigint END)), lambda a, e: xor(xor(a, e) >> 1, 3988292384::bigint * (xor(a, e) & 1))) AS c, count(*) AS n_own FROM t GROUP BY conv_id),
c AS (SELECT s.conv_id, s.conv_id - s.conv_id % 100 AS base, xor(s.c, 4294967295::bigint) % 6 AS h FROM steps s),
k AS (SELECT c.*, least(h, coalesce(n_own, 0)) AS taken FROM c LEFT JOIN steps b ON b.conv_id = c.base),
r AS (SELECT k.conv_id, t.n AS place, t.role, t.text FROM k JOIN t ON t.conv_id = k.base AND t.n <= k.taken
 UNION ALL SELECT k.conv_id, t.n - h + taken, t.role, t.text FROM k JOIN t ON t.conv_id = k.conv_id AND t.n > h),
p AS (SELECT conv_id, place, length(text) AS chars, md5(string_agg(length(role) || ':' || role || length(text) || ':' || text, '' ) OVER (PARTITION BY conv_id ORDER BY place)) AS pre FROM r
 UNION ALL SELECT conv_id, 0, 0, '' FROM k),
m AS (SELECT *, place = max(place) OVER (PARTITION BY conv_id) AS last FROM p),
n AS (SELECT place AS depth, pre, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars, sha256(coalesce(string_agg(conv_id::varchar, ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256 FROM m GROUP BY 1, 2),
up AS (SELECT n.*, q.conv_id AS parent_conv_id FROM n LEFT JOIN p ON p.conv_id = n.conv_id AND p.place = n.depth - 1 LEFT JOIN n q ON q.depth = p.place AND q.pre = p.pre),
kids AS (SELECT parent_conv_id, depth - 1 AS depth, count(*) AS n_children FROM up WHERE depth > 0 GROUP BY ALL),
f AS (SELECT up.*, coalesce(n_children, 0) AS n_children FROM up LEFT JOIN kids ON kids.parent_conv_id = up.conv_id AND kids.depth = up.depth),
totals AS (SELECT p.place AS depth, p.pre, sum(CASE WHEN f.n_children = 0 THEN 1 ELSE 0 END)::bigint AS n_leaves, sum((f.n_convs - 1) * f.chars)::bigint AS saved_tokens FROM f JOIN p ON p.conv_id = f.conv_id AND p.place <= f.depth GROUP BY 1, 2)
SELECT f.conv_id, f.depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 FROM f JOIN totals USING (depth, pre)"""
