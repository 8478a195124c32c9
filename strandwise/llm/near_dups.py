"""Near-duplicate texts by SetSketch registers: banded candidates, joint likelihood, exact verification.

1. One pass over the texts makes, for each document, its number of distinct word shingles, a 128-bit identity of the
   set, and REGISTERS SetSketch registers: exponentially spaced, truncated minima, mergeable by maximum.
2. Documents with one and the same set form a class; its smallest doc_id stands for it from here on.
3. BANDS bands of ROWS register values each give candidate buckets. Two sets with a similarity of 0.8 share none of them
   with a chance of (1 - 0.8**4)**32 = 5e-8.
4. Hub round: each class is compared with the hub of each of its buckets by the joint likelihood of both sketches; its
   likeliest partner is verified on the full sets, and verified links form components. A bucket's hub is the member whose
   buckets are the largest: of copies with edits of their own, the text that they were made from.
5. Rest round: in buckets that still hold several components, all members in different components are compared by their
   sketches, in blocks of bounded size; every pair that may reach the threshold is verified on the full sets: pairs of
   small buckets by joins, pairs of large ones where they are found, to which their members bring their sets.

No pair in one component is compared again, so groups of thousands of copies cost about one comparison a member.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandwise.llm.bloom import bits_for, hit_bits, may_hold
from strandwise.llm.common import mix, pieces, shingle_set, text_buffers
from strandwise.operators.graph import component_labels
from strandwise.storage import stored

#: SetSketch parameters: registers, base and rate, largest register value; bands of register values.
REGISTERS, SPACING, RATE, TOP, ROWS = 128, 1.001, 20.0, 65535, 4
BANDS = REGISTERS // ROWS
#: Pairs whose likeliest similarity is this far under the threshold aren't verified: 5 standard deviations at 0.8.
MARGIN = 0.18
#: Rows of an Arrow batch with texts or sets.
TEXT_ROWS = 1000
#: Shingles of a block, and members from which a bucket counts as large.
BLOCK, LARGE = 600_000, 48
_MULTIPLIERS = (mix(np.arange(1, REGISTERS + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def registers(hashes: np.ndarray) -> np.ndarray:
    """SetSketch registers of a set of 64-bit hashes; the maximum of two sketches is the sketch of the union."""
    x, least = (hashes >> np.uint64(32)).astype(np.uint32), np.full(REGISTERS, np.uint32(0xFFFFFFFF))
    for at in range(0, len(x), 1024):
        least = np.minimum(least, (_MULTIPLIERS[:, None] * x[None, at : at + 1024]).min(axis=1))
    rate = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**32) / RATE
    return np.clip(np.floor(1 - np.log(rate) / np.log(SPACING)), 0, TOP).astype(np.uint16)


def likeliest_similarity(above: np.ndarray, below: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity from the registers above and below in a, and the sizes of both sets."""
    u, v = size_a / (size_a + size_b), size_b / (size_a + size_b)
    top, equal = np.minimum(u / v, v / u), REGISTERS - above - below
    step = lambda x: -np.log1p(-np.clip(x, 1e-12, 1) * (SPACING - 1) / SPACING) / np.log(SPACING)

    def value(j):
        p, q = step(u - v * j), step(v - u * j)
        return above * np.log(np.maximum(p, 1e-12)) + below * np.log(np.maximum(q, 1e-12)) + equal * np.log(np.maximum(1 - p - q, 1e-12))

    lo, hi = np.zeros(len(top)), top.copy()
    for _ in range(40):  # the likelihood has one maximum
        a, b = lo + (hi - lo) / 3, hi - (hi - lo) / 3
        right = value(a) < value(b)
        lo, hi = np.where(right, a, lo), np.where(right, hi, b)
    return (lo + hi) / 2


def sketches(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, n_shingles, set_id binary, registers binary) of every row of docs (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            sizes, ids, regs = [], [], []
            for _, s, e in pieces(offsets):
                found = shingle_set(data[s:e], k)
                sizes.append(len(found))
                ids.append(np.array([found.sum(dtype=np.uint64), np.bitwise_xor.reduce(mix(found + np.uint64(7)))]).tobytes() if len(found) else None)
                regs.append(registers(found).tobytes() if len(found) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()), pa.array(regs, pa.binary())], ["doc_id", "n_shingles", "set_id", "registers"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_shingles long, set_id binary, registers binary")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def bands(classes: DataFrame) -> DataFrame:
    """(band, j, rep, n_shingles): a row for each band of each sketch; band is a hash of j and the band's values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            regs = _matrix(batch.column(1)).astype(np.uint64).reshape(-1, BANDS, ROWS)
            key = np.arange(1, BANDS + 1, dtype=np.uint64)[None, :].repeat(len(regs), 0)
            for j in range(ROWS):
                key = mix(key * np.uint64(0x9E3779B97F4A7C15) + regs[:, :, j])
            reps = np.repeat(batch.column(0).to_numpy(), BANDS)
            j = np.tile(np.arange(BANDS, dtype=np.int32), len(regs))
            sizes = np.repeat(batch.column(2).to_numpy(), BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(key.ravel().view(np.int64)), pa.array(j), pa.array(reps), pa.array(sizes)], ["band", "j", "rep", "n_shingles"])

    return classes.select("rep", "registers", "n_shingles").mapInArrow(run, "band long, j int, rep long, n_shingles long")


def _likely(pairs: DataFrame, sketched: DataFrame, threshold: float) -> DataFrame:
    """Pairs (x, y) whose joint likelihood allows the threshold, with the likeliest similarity as likeness."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y, nx, ny = (batch.column(i).to_numpy() for i in range(4))
            a, b = _matrix(batch.column(4)), _matrix(batch.column(5))
            likeness = likeliest_similarity((a > b).sum(1), (a < b).sum(1), nx.astype(float), ny.astype(float))
            keep = (likeness >= threshold - MARGIN) & (np.minimum(nx, ny) >= threshold * np.maximum(nx, ny) - 1e-9)
            yield pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in (x, y, likeness)], ["x", "y", "likeness"])

    side = lambda key, n: sketched.select(F.col("rep").alias(key), F.col("n_shingles").alias(f"n{n}"), F.col("registers").alias(f"r{n}"))
    joined = pairs.join(side("x", "x"), "x").join(side("y", "y"), "y").select("x", "y", "nx", "ny", "rx", "ry")
    return joined.mapInArrow(run, "x long, y long, likeness double")


def _rest(members: DataFrame, percent: int, full: bool) -> DataFrame:
    """Pairs between components of a bucket. members: (band, blocks, j, rep, component, n_shingles, registers, members or null).

    Buckets are dealt by a hash into blocks, of BLOCK shingles on average; a row goes once to each pair of blocks that its
    own is part of, and a task compares two blocks at a time, as matrices. A pair comes from the first bucket that it
    shares, so it comes once.
    full: the rows carry their full sets, and verified links come out, without those inside what they link; else likely
    pairs to verify.
    """
    threshold = percent / 100
    cut = members.withColumn("own", F.pmod(F.xxhash64("rep", F.lit(3)), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cut = cut.select("band", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "j", "rep", "component", "n_shingles", "registers", "members")

    def candidates(lo, hi, own, j_of, comp, size, regs) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        a, b = np.flatnonzero(own == lo[0]), np.flatnonzero(own == hi[0])
        for at in range(0, len(a), 64):
            part = a[at : at + 64]
            fits = comp[part][:, None] != comp[b][None, :]
            if lo[0] == hi[0]:
                fits &= part[:, None] < b[None, :]
            s, t = size[part][:, None], size[b][None, :]
            i, j = np.nonzero(fits & (np.minimum(s, t) >= threshold * np.maximum(s, t) - 1e-9))
            for cut_at in range(0, len(i), 20_000):
                p, q = part[i[cut_at : cut_at + 20_000]], b[j[cut_at : cut_at + 20_000]]
                near = (regs[p] == regs[q]).sum(1) >= REGISTERS * (threshold - MARGIN - 0.1)
                p, q = p[near], q[near]
                first = (regs[p] == regs[q]).reshape(-1, BANDS, ROWS).all(2).argmax(1) == j_of[0]
                p, q = p[first], q[first]
                if len(p):
                    likeness = likeliest_similarity((regs[p] > regs[q]).sum(1), (regs[p] < regs[q]).sum(1), size[p].astype(float), size[q].astype(float))
                    ok = likeness >= threshold - MARGIN
                    yield p[ok], q[ok]

    def links(rows: list) -> tuple[np.ndarray, np.ndarray]:
        lo, hi, own, j_of, rep, comp, size, sets, regs = (np.concatenate([r[i] for r in rows]) for i in range(9))
        found = list(candidates(lo, hi, own, j_of, comp, size, regs))
        p, q = (np.concatenate([f[i] for f in found]) if found else np.zeros(0, int) for i in range(2))
        if full and len(p):
            both = common(sets, p, q)
            ok = 100 * both >= percent * (size[p] + size[q] - both)
            p, q = spanning(comp, p[ok], q[ok])
        return np.minimum(rep[p], rep[q]), np.maximum(rep[p], rep[q])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None

        def out(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in links(rows)], ["x", "y"])

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(9)] + [_matrix(batch.column(9))]
            change = np.flatnonzero((np.diff(columns[0]) != 0) | (np.diff(columns[1]) != 0) | (np.diff(columns[2]) != 0)) + 1
            for s, e in zip([0, *change], [*change, batch.num_rows], strict=True):
                now = tuple(columns[i][s] for i in range(3))
                if held and now != key:
                    yield out(held)
                    held = []
                key = now
                held.append([c[s:e] for c in columns[1:]])
        if held:
            yield out(held)

    keys = ["band", "lo", "hi"]
    dealt = cut.repartition(*keys).sortWithinPartitions(*keys, "own")
    return dealt.select("band", "lo", "hi", "own", "j", "rep", "component", "n_shingles", "members", "registers").mapInArrow(run, "x long, y long")


def common(sets: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets (bytes of sorted 64-bit hashes) at p and q: by bitmaps over the hashes that
    two or more of the sets hold, some thousand at a time."""
    rows = np.unique(np.concatenate([p, q]))
    place = np.zeros(len(sets), int)
    place[rows] = np.arange(len(rows))
    values = [np.frombuffer(sets[r], np.uint64) for r in rows]
    owner = np.repeat(np.arange(len(rows)), [len(v) for v in values])
    _, word, count = np.unique(np.concatenate(values), return_inverse=True, return_counts=True)
    shared = count > 1
    number = np.cumsum(shared) - 1
    keep = shared[word]
    word, owner = number[word[keep]], owner[keep]
    order = np.argsort(word, kind="stable")
    word, owner, p, q = word[order], owner[order], place[p], place[q]
    out, width = np.zeros(len(p), np.int64), 8192
    for at in range(0, int(shared.sum()), width):
        s, e = np.searchsorted(word, [at, at + width])
        bits = np.zeros((len(rows), width), bool)
        bits[owner[s:e], word[s:e] - at] = True
        packed = np.packbits(bits, axis=1).view(np.uint64)
        for k in range(0, len(p), 8192):
            out[k : k + 8192] += np.bitwise_count(packed[p[k : k + 8192]] & packed[q[k : k + 8192]]).sum(1, dtype=np.int64)
    return out


def spanning(comp: np.ndarray, p: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the links between p and q, those that join what earlier ones didn't yet join, counted by component."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (y := root.get(x, x)) != x:
            root[x] = root.get(y, y)
            x = y
        return x

    kept = []
    for n, (x, y) in enumerate(zip(comp[p].tolist(), comp[q].tolist(), strict=True)):
        x, y = find(x), find(y)
        if x != y:
            root[max(x, y)] = min(x, y)
            kept.append(n)
    return p[kept], q[kept]


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (x, y) with 100 * intersection >= percent * union on the full sets, as edges (src, dst)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column(2), batch.column(3), strict=True):
                p, q = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(100 * both >= percent * (len(p) + len(q) - both))
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(keep, pa.bool_())) for i in range(2)], ["src", "dst"])

    side = lambda key: sets.select(F.col("rep").alias(key), F.col("members").alias(f"of_{key}"))
    joined = pairs.select("x", "y").join(side("x"), "x").join(side("y"), "y").select("x", "y", "of_x", "of_y")
    return joined.mapInArrow(run, "src long, dst long")


def _sets(docs: DataFrame, reps: DataFrame, k: int) -> DataFrame:
    """(rep, members binary): the sorted shingle hashes of the documents in reps (rep). A Bloom filter holds back the other texts."""
    bitmap = hit_bits(reps.select(F.xxhash64("rep").alias("h")), "h", bits_for(reps.count()))
    id_of = F.col("doc_id").cast("long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([shingle_set(data[s:e], k).tobytes() for _, s, e in pieces(offsets)], pa.binary())], ["rep", "members"])

    near = docs.select(id_of.alias("rep"), "text").filter(may_hold(docs, bitmap, F.xxhash64(id_of)))
    return near.join(reps.select("rep"), "rep", "left_semi").mapInArrow(run, "rep long, members binary").dropDuplicates(["rep"])


def verified_links(pairs: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Edges (src, dst) of the pairs (x, y) of doc_ids whose full sets of k-word shingles reach the percentage; only the texts
    in pairs are read again."""
    pairs = stored(pairs)
    ids = stored(pairs.select(F.explode(F.array("x", "y")).alias("rep")).distinct())
    return _verified(pairs, stored(_sets(docs, ids, k), TEXT_ROWS), percent)


def near_duplicate_groups(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of docs (doc_id, text, any other columns).

    Documents are linked when 100 * |A & B| >= percent * |A | B| on their sets of k-word shingles; component_id is the
    smallest doc_id reachable over links. Null, empty and blank texts have no shingles and stand alone. Rows that repeat
    a doc_id and text get one and the same result each; a null doc_id stands alone with a null component_id, kept. Rows
    that share a doc_id but not the text count as linked by their id. No table, however small, is special.
    """
    threshold = percent / 100
    sketched = stored(sketches(docs, k), TEXT_ROWS)
    classes = sketched.filter("set_id is not null and doc_id is not null").groupBy("set_id", "n_shingles").agg(F.min("doc_id").alias("rep"))
    classes = stored(classes)
    reps = sketched.join(classes.withColumnRenamed("rep", "doc_id"), ["doc_id", "set_id", "n_shingles"], "left_semi").select(F.col("doc_id").alias("rep"), "n_shingles", "registers").dropDuplicates(["rep"])
    # what is counted by band is stored before it is joined by band: no window holds a bucket, and a join of plain shuffles
    # can be split where a bucket is hot
    every = stored(bands(reps))
    counts = stored(every.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1"))
    buckets = stored(every.join(counts, "band"))
    involved = stored(buckets.groupBy("rep").agg(F.sum("n").alias("weight")))
    few = stored(reps.join(involved, "rep", "left_semi"))
    sets = stored(_sets(docs, involved, k), TEXT_ROWS)

    hubs = stored(buckets.join(involved, "rep").groupBy("band").agg(F.max(F.struct("weight", F.xxhash64("rep").alias("h"), "rep"))["rep"].alias("hub")))
    stars = buckets.join(hubs, "band").filter("rep <> hub").select(F.col("rep").alias("x"), F.col("hub").alias("y")).distinct()
    best = _likely(stars, few, threshold).groupBy("x").agg(F.max(F.struct("likeness", "y")).alias("best")).select("x", F.col("best.y").alias("y"))
    links = stored(_verified(best, sets, percent), TEXT_ROWS)
    labels = stored(component_labels(links))

    own = lambda df: df.join(labels.withColumnRenamed("id", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    labelled = own(buckets.select("band", "j", "rep", "n_shingles"))
    blocks = (F.floor(F.sum(F.col("n_shingles") + 200) / BLOCK) + 1).cast("int")
    mixed = labelled.groupBy("band").agg(F.min("component").alias("a"), F.max("component").alias("b"), F.count("*").alias("n"), blocks.alias("blocks"))
    mixed = stored(mixed.filter("a <> b").select("band", "n", "blocks"))
    members = stored(labelled.join(mixed, "band"))
    sketch_of = few.select("rep", "registers")
    small = members.filter(F.col("n") < LARGE).drop("n").join(sketch_of, "rep").withColumn("members", F.lit(None).cast("binary"))
    large = members.filter(F.col("n") >= LARGE).drop("n").join(sketch_of, "rep").join(sets, "rep")
    columns = ["band", "blocks", "j", "rep", "component", "n_shingles", "registers", "members"]
    more = _verified(_rest(small.select(*columns), percent, False), sets, percent)
    more = stored(more.unionAll(_rest(large.select(*columns), percent, True)), TEXT_ROWS)

    same_id = sketched.filter("set_id is not null and doc_id is not null").select("doc_id", "set_id", "n_shingles").distinct()
    to_class = same_id.join(classes, ["set_id", "n_shingles"]).filter("doc_id <> rep").select(F.col("doc_id").alias("src"), F.col("rep").alias("dst"))
    labels = stored(component_labels(links.unionAll(more)))
    # a class takes the component of its representative; only ids that stand for several texts need the classes as edges
    clash = same_id.groupBy("doc_id").count().filter("count > 1").select(F.col("doc_id").alias("src"))
    if not clash.isEmpty():
        labels = stored(component_labels(links.unionAll(more).unionAll(to_class)))
    classed = classes.join(labels.withColumnRenamed("id", "rep"), "rep", "left").select("set_id", "n_shingles", F.coalesce("component", "rep").alias("component"))
    out = sketched.drop("registers").join(classed, ["set_id", "n_shingles"], "left").withColumn("component_id", F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def without_near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs whose document stands for its group; columns as given. Rows that repeat a doc_id stay
    or go together: exact deduplication, which comes first in the pipeline, is what removes repeated rows."""
    groups = near_duplicate_groups(docs, k, percent).filter("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(groups, docs["doc_id"].cast("long") == groups["_gone"], "left_anti")
