"""Jaccard join of word shingle sets by parity sketches.

1. One pass over the texts makes each document's shingle set and its parity sketches. A layout deals the shingles by a hash
   into parts; a part's value is the exclusive or of its shingles' hashes (32 bits), and its word has the parity of how often
   each of 8 places was hit. Sketches of two sets differ where the sets' symmetric difference is odd, so both the parts that
   differ and the Hamming distance of the words are at most the symmetric difference.
2. Size bands: a layout serves the pairs whose smaller set lies in its band. Sets at a similarity of t differ in at most
   (1 - t) / (1 + t) of the sum of their sizes; k is the most that any such pair of the band differs in. A document has the
   layout of its own band and, if smaller partners lie in the band below, that one.
3. Pigeonhole join: of a layout's parts at least all but k agree, so if every document posts its k + 1 fullest parts (in an
   order that depends on a part's value alone), each pair that links shares a posting. Nothing is left to chance but
   collisions of 32-bit values, which only add candidates.
4. Documents of one and the same set are a class; its smallest doc_id stands for it.
5. Hub round: the parts of a layout in CHUNKS runs make a few keys a document, by which close copies meet. All members of
   such a bucket are compared with its hub, the member that shares the most: sketches within the bound go on to the full
   sets, and links found there make components.
6. Exact round: the pigeonhole join, over the buckets that hold several components only. Their members of different
   components are compared by their sketches, in blocks of bounded size, and likely pairs by their full sets. So a group of
   thousands of copies costs a comparison a member, and no link is left out.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandwise.llm.bloom import bits_for, held, hit_bits
from strandwise.llm.common import mix, pieces, shingle_set, text_buffers
from strandwise.llm.near_dups import verified_links
from strandwise.operators.graph import component_labels
from strandwise.storage import discard, stored

#: Ratio of a band's ends, and parts for each part that is posted.
BAND, SPARE = 1.6, 1.25
#: Rows of an Arrow batch with texts or sets, and bucket members that make a block on average.
TEXT_ROWS, BLOCK = 1000, 1024
#: Runs of parts that make the keys of the hub round.
CHUNKS = 16


@functools.lru_cache(maxsize=4)
def layouts(percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first size, k, parts) of each band, up to sets of 2**40. k bounds the symmetric difference of a pair of the band."""
    out, first = [], 1
    while first < 1 << 40:
        end = max(first + 1, int(first * BAND))
        k = (100 - percent) * (end - 1 + (end - 1) * 100 // percent) // (100 + percent)
        out.append((first, k, max(k + 1, int(np.ceil((k + 1) * SPARE)))))
        first = end
    return tuple(np.array(x) for x in zip(*out, strict=True))


def bands_of(size: int, percent: int) -> range:
    """The bands whose layouts a set of that size has: its own, and those below that hold sizes it may link with."""
    firsts = layouts(percent)[0]
    least = -(-size * percent // 100)
    return range(int(np.searchsorted(firsts, least, "right")) - 1, int(np.searchsorted(firsts, size, "right")))


def parity(hashes: np.ndarray, band: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, words) of the parts of a set of 64-bit hashes in a band's layout."""
    own = mix(hashes ^ np.uint64((band + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
    part = ((own >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    part, own = part[order], own[order]
    at = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else np.zeros(0, np.int64)
    values, words = np.zeros(parts, np.uint32), np.zeros(parts, np.uint8)
    if len(at):
        low = own & np.uint64(0xFFFFFFFF)
        values[part[at]] = np.bitwise_xor.reduceat(mix(low + np.uint64(11)).astype(np.uint32), at)
        words[part[at]] = np.bitwise_xor.reduceat(np.uint8(1) << (low & np.uint64(7)).astype(np.uint8), at)
    return values, words


def posted(values: np.ndarray, words: np.ndarray, k: int) -> np.ndarray:
    """The parts that a document posts: k + 1, those of most set places first; the order depends on a part and its value alone."""
    if len(values) <= k + 1:
        return np.arange(len(values))
    own = mix((values.astype(np.uint64) << np.uint64(32)) | np.arange(len(values), dtype=np.uint64))
    rank = (np.bitwise_count(words).astype(np.uint64) << np.uint64(60)) | (own >> np.uint64(4))
    return np.sort(np.argpartition(rank, len(rank) - k - 1)[len(rank) - k - 1 :])


def chunk_keys(values: np.ndarray, words: np.ndarray, band: int) -> np.ndarray:
    """A key for each of CHUNKS runs of parts, of all their values; runs without a set place have none."""
    own = mix((values.astype(np.uint64) << np.uint64(32)) | np.arange(len(values), dtype=np.uint64))
    at = np.unique(np.arange(CHUNKS) * len(values) // CHUNKS)
    used = np.bitwise_or.reduceat(words, at) > 0
    return mix(np.bitwise_xor.reduceat(own, at) + mix(np.uint64(band + 1) * np.uint64(1 << 32) + at.astype(np.uint64)))[used]


_SKETCHED = "doc_id long, n_shingles long, set_id binary, bands array<int>, words array<binary>, chunks array<binary>, keys array<binary>"


def sketches(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(doc_id, n_shingles, set_id, bands, words, chunks, keys) of every row of docs (doc_id, text): by layout, the words of all
    parts, the keys of the hub round, and the keys (64 bits of band, part and value) of the parts posted. A set that no other
    set can link with has no layouts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            rows: list[list] = [[] for _ in range(6)]
            for _, s, e in pieces(offsets):
                found = shingle_set(data[s:e], width)
                own: list[list] = [[], [], [], []]
                for band in bands_of(len(found), percent) if len(found) else []:
                    k, parts = (int(x[band]) for x in layouts(percent)[1:])
                    if not k:
                        continue  # only equal sets link, and they are one class
                    values, words = parity(found, band, parts)
                    use = posted(values, words, k)
                    key = mix((values[use].astype(np.uint64) << np.uint64(32)) ^ mix(np.uint64(band) * np.uint64(1 << 32) + use.astype(np.uint64)))
                    for column, value in zip(own, (band, words.tobytes(), chunk_keys(values, words, band).tobytes(), key.tobytes()), strict=True):
                        column.append(value)
                sums = (found.sum(dtype=np.uint64), np.bitwise_xor.reduce(mix(found + np.uint64(7)))) if len(found) else None
                for column, value in zip(rows, (len(found), np.array(sums).tobytes() if sums else None, *own), strict=True):
                    column.append(value)
            kinds = (pa.int64(), pa.binary(), pa.list_(pa.int32()), *[pa.list_(pa.binary())] * 3)
            arrays = [pa.array(c, kind) for c, kind in zip(rows, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], [c.split()[0] for c in _SKETCHED.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, _SKETCHED)


def postings(reps: DataFrame, keys: str, kept: np.ndarray | None = None) -> DataFrame:
    """(bucket, rep, band, component) for each of the keys of (rep, component, bands, keys). kept: a Bloom bitmap of the buckets
    to keep (with false hits); it is broadcast, and of bounded size."""
    shared = reps.sparkSession.sparkContext.broadcast(kept) if kept is not None else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                own, of, layout, comp = [], [], [], []
                for rep, component, bands, lists in zip(*(part.column(i).to_pylist() for i in range(4)), strict=True):
                    for band, key in zip(bands, lists, strict=True):
                        own.append(np.frombuffer(key, np.int64))
                        of.append(rep)
                        layout.append(band)
                        comp.append(component)
                if not own:
                    continue
                sizes, bucket = [len(x) for x in own], np.concatenate(own)
                columns = [bucket, *(np.repeat(np.array(x, kind), sizes) for x, kind in ((of, np.int64), (layout, np.int32), (comp, np.int64)))]
                if shared is not None:
                    keep = held(shared.value, bucket.view(np.uint64))
                    columns = [x[keep] for x in columns]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["bucket", "rep", "band", "component"])

    return reps.select("rep", "component", "bands", keys).mapInArrow(run, "bucket long, rep long, band int, component long")


def allowed(size_a: np.ndarray, size_b: np.ndarray, percent: int) -> np.ndarray:
    """The most by which sets of those sizes may differ to be linked; -1 where the sizes forbid it."""
    fits = 100 * np.minimum(size_a, size_b) >= percent * np.maximum(size_a, size_b)
    return np.where(fits, (100 - percent) * (size_a + size_b) // (100 + percent), -1)


def likely(pairs: DataFrame, sketched: DataFrame, percent: int) -> DataFrame:
    """Pairs (x, y) of pairs (x, y, band) whose words in the band's layout differ in no more places than linked sets can."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            most = allowed(batch.column(2).to_numpy(zero_copy_only=False), batch.column(3).to_numpy(zero_copy_only=False), percent)
            apart = [int(np.bitwise_count(np.frombuffer(a.as_buffer(), np.uint8) ^ np.frombuffer(b.as_buffer(), np.uint8)).sum()) for a, b in zip(batch.column(4), batch.column(5), strict=True)]
            keep = pa.array(np.array(apart, np.int64) <= most)
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(keep) for i in range(2)], ["x", "y"])

    side = lambda key: sketched.select(F.col("rep").alias(key), "band", F.col("n_shingles").alias(f"n{key}"), F.col("word").alias(f"w{key}"))
    joined = pairs.join(side("x"), ["x", "band"]).join(side("y"), ["y", "band"]).select("x", "y", "nx", "ny", "wx", "wy")
    return joined.mapInArrow(run, "x long, y long")


def between(members: DataFrame, percent: int) -> DataFrame:
    """Likely pairs (x, y) of different components of a bucket. members: (bucket, blocks, rep, component, n_shingles, word).

    Members are dealt by a hash into blocks; a row goes once to each pair of blocks that its own is part of, so a task
    compares two blocks at a time, as matrices of words."""
    own = F.pmod(F.xxhash64("rep", F.lit(3)), F.col("blocks")).cast("int")
    cut = members.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cut = cut.select("bucket", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "rep", "component", "n_shingles", "word")

    def pairs(own: np.ndarray, lo: int, hi: int, rep: np.ndarray, comp: np.ndarray, size: np.ndarray, words: np.ndarray) -> Iterator[pa.RecordBatch]:
        a, b = np.flatnonzero(own == lo), np.flatnonzero(own == hi)
        for at in range(0, len(a), 64):
            part = a[at : at + 64]
            fits = (comp[part][:, None] != comp[b][None, :]) & (allowed(size[part][:, None], size[b][None, :], percent) >= 0)
            if lo == hi:
                fits &= part[:, None] < b[None, :]
            i, j = np.nonzero(fits)
            step = max(1, (1 << 22) // max(1, words.shape[1]))
            for s in range(0, len(i), step):
                p, q = part[i[s : s + step]], b[j[s : s + step]]
                near = np.bitwise_count(words[p] ^ words[q]).sum(1, dtype=np.int64) <= allowed(size[p], size[q], percent)
                p, q = rep[p[near]], rep[q[near]]
                if len(p):
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(p, q)), pa.array(np.maximum(p, q))], ["x", "y"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None

        def out() -> Iterator[pa.RecordBatch]:
            own, rep, comp, size = (np.concatenate([h[i] for h in held]) for i in range(4))
            words = np.concatenate([h[4] for h in held])
            yield from pairs(own, key[1], key[2], rep, comp, size, words)

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(7)]
            change = np.flatnonzero(np.any([np.diff(c) != 0 for c in columns[:3]], axis=0)) + 1
            for s, e in zip([0, *change], [*change, batch.num_rows], strict=True):
                now = tuple(int(c[s]) for c in columns[:3])
                if held and now != key:
                    yield from out()
                    held = []
                key = now
                raw = batch.column(7).slice(s, e - s).to_pylist()
                held.append([c[s:e] for c in columns[3:7]] + [np.frombuffer(b"".join(raw), np.uint8).reshape(len(raw), -1)])
        if held:
            yield from out()

    keys = ["bucket", "lo", "hi"]
    dealt = cut.repartition(*keys).sortWithinPartitions(*keys, "own")
    return dealt.select("bucket", "lo", "hi", "own", "rep", "component", "n_shingles", "word").mapInArrow(run, "x long, y long")


def similar_groups(docs: DataFrame, width: int = 4, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of docs (doc_id, text, any others).

    Documents link when 100 * |A & B| >= percent * |A | B| on their sets of shingles of width words; component_id is the
    smallest doc_id reachable over links. Null, empty and blank texts have no shingles and stand alone. Rows that repeat a
    doc_id and text get one and the same result each; rows that share a doc_id but not the text count as linked by their id;
    a null doc_id stands alone with a null component_id. An empty table gives no rows.
    """
    sketched = stored(sketches(docs, width, percent).withColumn("row", F.monotonically_increasing_id()), TEXT_ROWS)
    sized = sketched.filter("set_id is not null and doc_id is not null")
    classes = stored(sized.groupBy("set_id", "n_shingles").agg(F.min(F.struct("doc_id", "row")).alias("r")).select("set_id", "n_shingles", F.col("r.doc_id").alias("rep"), "r.row"))
    chosen = classes.select("row", "rep")
    # the same join at every size: sketches are dealt by their row once for each use, whatever Spark would broadcast
    of_rep = lambda *columns, by=chosen: sketched.filter("size(bands) > 0").select("row", *columns).join(by.hint("merge"), "row").drop("row")
    layered = of_rep("n_shingles", "bands", "words").select("rep", "n_shingles", F.explode(F.arrays_zip("bands", "words")).alias("l"))
    layered = stored(layered.select("rep", "n_shingles", F.col("l.bands").alias("band"), F.col("l.words").alias("word")), TEXT_ROWS)

    every = stored(postings(of_rep("bands", "chunks").withColumn("component", F.col("rep")), "chunks").drop("component"))
    shared = stored(every.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1"))
    buckets = stored(every.join(shared, "bucket"))
    weight = buckets.groupBy("rep").agg(F.sum("n").alias("weight"))
    hubs = stored(buckets.join(weight, "rep").groupBy("bucket").agg(F.max(F.struct("weight", F.xxhash64("rep").alias("h"), "rep"))["rep"].alias("hub")))
    stars = buckets.join(hubs, "bucket").filter("rep <> hub").select(F.least("rep", "hub").alias("x"), F.greatest("rep", "hub").alias("y"), "band").dropDuplicates(["x", "y"])
    links = stored(verified_links(likely(stars, layered, percent), docs, width, percent), TEXT_ROWS)
    labels = stored(component_labels(links))
    discard(every, shared, buckets, hubs)

    labelled = chosen.join(labels.withColumnRenamed("id", "rep"), "rep", "left").select("row", "rep", F.coalesce("component", "rep").alias("component"))
    placed = stored(of_rep("bands", "keys", by=labelled), TEXT_ROWS)
    least, most = F.min("component").alias("a"), F.max("component").alias("b")
    blocks = (F.floor(F.count("*") / BLOCK) + 1).cast("int").alias("blocks")
    mixed = stored(postings(placed, "keys").groupBy("bucket").agg(least, most, blocks).filter("a <> b").select("bucket", "blocks"))
    # postings of buckets with one component end here, but for false hits of the bitmap, which the join ends
    bitmap = hit_bits(mixed, "bucket", bits_for(mixed.count()))
    members = postings(placed, "keys", bitmap).join(mixed, "bucket").join(layered.hint("merge"), ["rep", "band"])
    rest = stored(between(members.select("bucket", "blocks", "rep", "component", "n_shingles", "word"), percent).dropDuplicates(["x", "y"]))
    more = stored(verified_links(rest, docs, width, percent), TEXT_ROWS)
    discard(placed, mixed)

    same_id = sized.select("doc_id", "set_id", "n_shingles").distinct()
    clash = same_id.groupBy("doc_id").count().filter("count > 1").select("doc_id")
    # only ids that stand for several texts need their classes as edges; all others take their class's component
    to_class = same_id.join(clash, "doc_id", "left_semi").join(classes, ["set_id", "n_shingles"]).filter("doc_id <> rep").select(F.col("doc_id").alias("src"), F.col("rep").alias("dst"))
    labels = stored(component_labels(links.unionAll(more).unionAll(to_class)))
    classed = classes.join(labels.withColumnRenamed("id", "rep"), "rep", "left").select("set_id", "n_shingles", F.coalesce("component", "rep").alias("component"))
    return sketched.select("doc_id", "n_shingles", "set_id").join(classed, ["set_id", "n_shingles"], "left").select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
