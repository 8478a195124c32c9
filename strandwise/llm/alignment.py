"""Alignment of two tokenizers over a corpus by inverted bitmaps of id pairs.

1. One pass encodes each text twice, checks that the joined token bytes of both sides are a space and the text, and cuts
   the bytes where tokens of either side end. Each such cell is one link: the pair of tokens that cover it. Cells at whose
   end both sides end close a group.
2. The pass numbers documents within chunks of CHUNK_DOCS at most, and inverts its links: for each id pair a compressed
   bitmap of the chunk's documents that hold it, and one bitmap for each binary digit of how often they hold it beyond
   once (multiplicity planes). A container of up to 511 documents is a sorted list of 16-bit numbers, any other a bitmap.
3. The documents of a pair are the popcounts of its bitmaps, chunk by chunk: chunks share no document, so their union is
   the sum. An A id's best count is a maximum over its pairs.
4. Counts go back over the postings: each bitmap, with its pair's count and its plane's weight, is sent to its chunk and
   added up for the documents in it.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandwise.storage import stored

#: Documents of a chunk, links from which a chunk is closed, bytes of a container that is a bitmap.
CHUNK_DOCS, CHUNK_LINKS, DENSE = 1 << 13, 6_000_000, (1 << 13) // 8
#: Bytes of text that are cut at once, chunks whose sums a task holds, rows of an Arrow batch with texts or containers.
TEXT_BYTES, HELD_CHUNKS, TEXT_ROWS = 1 << 20, 64, 1000


def default_vocabularies() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("piece_bpe_32k.model")


@functools.lru_cache(maxsize=2)
def tokenizers(path_a: str, path_b: str):
    """(encode A, encode B, token bytes of A, token bytes of B). A takes the space and the text, B the text. A's ids are those
    that the tokenizers library gives for the same vocabulary, special tokens' strings as plain text."""
    import public_tokenizers
    import sentencepiece
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in Path(path_a).read_bytes().splitlines() if line)}
    encoder = tiktoken.Encoding("aligned", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    pieces = sentencepiece.SentencePieceProcessor(model_file=path_b)
    bytes_a = [b""] * (max(ranks.values()) + 1)
    for token, number in ranks.items():
        bytes_a[number] = token
    names = [pieces.id_to_piece(i) for i in range(pieces.get_piece_size())]
    bytes_b = [bytes([int(name[3:5], 16)]) if pieces.is_byte(i) else name.replace("▁", " ").encode() for i, name in enumerate(names)]
    return encoder.encode_ordinary, lambda text: pieces.encode(text, num_threads=1), bytes_a, bytes_b


@functools.lru_cache(maxsize=2)
def _digits(size: int) -> np.ndarray:
    """The decimal digits of each number under size, right-aligned in a row with a free last place; 0 where there is none."""
    width = len(str(size - 1))
    number, out = np.arange(size), np.zeros((size, width + 1), np.uint8)
    for place in range(width):
        rest = number // 10**place
        out[:, width - 1 - place] = np.where((rest > 0) | (place == 0), 48 + rest % 10, 0)
    return out


def cells(sizes: list[np.ndarray], totals: np.ndarray) -> tuple[np.ndarray, ...]:
    """Cells of texts put one after the other. sizes: the bytes of each token of A, of B, all texts; totals: the texts' bytes.
    (kind: 1 where A ends, 2 where B ends, 3 where both; place of the covering token in A, in B; text)."""
    marks = np.zeros(int(totals.sum()) + 1, np.uint8)
    for side, size in zip((1, 2), sizes, strict=True):
        marks[np.cumsum(size)] |= side  # a token without bytes ends where the one before it did
    marks[0] = 0
    ends = np.flatnonzero(marks)
    kind = marks[ends]
    text = np.searchsorted(np.cumsum(totals), ends)
    place = []
    for side, size in zip((1, 2), sizes, strict=True):
        ended = (kind & side) > 0
        full = np.flatnonzero(size)
        place.append(full[np.cumsum(ended) - ended] if len(full) < len(size) else np.cumsum(ended) - ended)
    return kind, place[0], place[1], text


def _group_texts(ids: list[np.ndarray], groups: list[np.ndarray], texts: np.ndarray, n_groups: int) -> list[str]:
    """The digest of each text's groups: its A ids, a bar, its B ids, a semicolon between groups. groups: the group of each
    token; texts: how many groups each text has."""
    count = [np.bincount(g, minlength=n_groups) for g in groups]
    upto = [np.concatenate([[0], np.cumsum(c)]) for c in count]
    size = len(ids[0]) + len(ids[1])
    out, mark = np.zeros(size, np.int64), np.full(size, 44, np.uint8)
    out[np.arange(len(ids[0])) + upto[1][groups[0]]] = ids[0]
    out[np.arange(len(ids[1])) + upto[0][groups[1] + 1]] = ids[1]
    mark[upto[0][1:] + upto[1][:-1] - 1] = 124
    mark[upto[0][1:] + upto[1][1:] - 1] = 59
    table = _digits(1 << 17)
    rows = table[out]
    rows[:, -1] = mark
    lengths = np.concatenate([[0], np.cumsum((rows != 0).sum(1))])
    flat = rows.ravel()
    flat = flat[flat != 0].tobytes()
    at, hashes = np.concatenate([[0], np.cumsum(texts)]), []
    tokens_upto = upto[0] + upto[1]
    for s, e in zip(lengths[tokens_upto[at[:-1]]].tolist(), lengths[tokens_upto[at[1:]]].tolist(), strict=True):
        hashes.append(hashlib.sha256(flat[s : e - 1]).hexdigest())
    return hashes


def container(lows: np.ndarray) -> bytes:
    """A set of document numbers of a chunk as a sorted list, or as a bitmap if that is no longer."""
    if 2 * len(lows) < DENSE:
        return lows.astype("<u2").tobytes()
    bits = np.zeros(CHUNK_DOCS, bool)
    bits[lows] = True
    return np.packbits(bits, bitorder="little").tobytes()


def _containers(keys: np.ndarray, lows: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """The distinct keys (ascending in keys) and the container of each one's lows."""
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    count = np.diff(np.append(at, len(keys)))
    dense = 2 * count >= DENSE
    sizes = np.where(dense, DENSE, 2 * count)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    data = np.zeros(int(offsets[-1]) // 2, "<u2")
    sparse = np.repeat(~dense, count)
    start = np.repeat(offsets[:-1] // 2 - at, count)
    data[(np.arange(len(keys)) + start)[sparse]] = lows[sparse]
    for k in np.flatnonzero(dense).tolist():
        data[offsets[k] // 2 : offsets[k + 1] // 2] = np.frombuffer(container(lows[at[k] : at[k] + count[k]]), "<u2")
    return keys[at], pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())])


def unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, document number) of every member of a column of containers."""
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    sizes = np.diff(offsets)
    dense = sizes == DENSE
    mask = np.repeat(~dense, sizes)
    rows, lows = [np.repeat(np.arange(len(sizes)), np.where(dense, 0, sizes // 2))], [data[mask].view("<u2").astype(np.int64)]
    where = np.flatnonzero(dense)
    for at in range(0, len(where), 1024):
        part = data[offsets[where[at : at + 1024], None] - offsets[0] + np.arange(DENSE)]
        row, low = np.nonzero(np.unpackbits(part, axis=1, bitorder="little"))
        rows.append(where[at + row])
        lows.append(low)
    return np.concatenate(rows), np.concatenate(lows)


_SCHEMA = "chunk long, low int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pair long, plane int, docs binary"


def postings(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Rows of two kinds, one pass over docs (doc_id, text): a row for each document (chunk, low, doc_id, n_a, n_b, n_groups,
    n_links, groups_sha256), and, where pair isn't null, a container (chunk, pair, plane, docs): plane 0 has the documents
    that hold the pair, plane p from 1 those whose number of links of it, less one, has the binary digit p - 1."""
    names = [c.split()[0] for c in _SCHEMA.split(", ")]
    kinds = dict(zip(names, (pa.int64(), pa.int32(), pa.int64(), *[pa.int64()] * 4, pa.string(), pa.int64(), pa.int32(), pa.binary()), strict=True))

    def made(n: int, **columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([columns[c] if isinstance(columns.get(c), pa.Array) else pa.array(columns[c], kinds[c]) if c in columns else pa.nulls(n, kinds[c]) for c in names], names)

    def inverted(chunk: int, held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        keys = np.concatenate(held)
        held.clear()
        keys.sort()
        at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        more, keys = np.diff(np.append(at, len(keys))) - 1, keys[at]
        for plane in range(int(more.max()).bit_length() + 1):
            now = keys[(more >> (plane - 1)) & 1 > 0] if plane else keys
            pair, members = _containers(now >> np.uint64(13), (now & np.uint64(CHUNK_DOCS - 1)).astype(np.uint16))
            for s in range(0, len(pair), 50_000):
                part = pair[s : s + 50_000].astype(np.int64)
                yield made(len(part), chunk=np.full(len(part), chunk), pair=part, plane=np.full(len(part), plane, np.int32), docs=members.slice(s, len(part)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, low, held, links = TaskContext.get().partitionId() << 24, 0, [], 0
        for batch in batches:
            texts = batch.column(1).to_pylist()
            ends = np.cumsum([len(t) for t in texts])
            at = 0
            while at < batch.num_rows:
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + TEXT_BYTES)))
                to = min(to, at + CHUNK_DOCS - low)
                digest, keys = _cut(texts[at:to], low, path_a, path_b)
                n = to - at
                yield made(n, chunk=np.full(n, chunk), low=np.arange(low, low + n, dtype=np.int32), doc_id=batch.column(0).slice(at, n), **digest)
                held, links, low, at = [*held, keys], links + len(keys), low + n, to
                if low == CHUNK_DOCS or links >= CHUNK_LINKS:
                    if links:
                        yield from inverted(chunk, held)
                    chunk, low, held, links = chunk + 1, 0, [], 0
        if links:
            yield from inverted(chunk, held)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).mapInArrow(run, _SCHEMA)


def _cut(texts: list[str], low: int, path_a: str, path_b: str) -> tuple[dict, np.ndarray]:
    """The digest columns of some texts, and a key (pair, document number) for each of their links. The texts' documents are
    numbered from low."""
    encode_a, encode_b, bytes_a, bytes_b = tokenizers(path_a, path_b)
    columns = {c: np.zeros(len(texts), np.int64) for c in ("n_a", "n_b", "n_groups", "n_links")}
    hashes, good, ids_a, ids_b, totals = [""] * len(texts), [], [], [], []
    for i, text in enumerate(texts):
        if not text:
            continue
        whole, a, b = b" " + text.encode(), encode_a(" " + text), encode_b(text)
        if b"".join(map(bytes_a.__getitem__, a)) == whole and b"".join(map(bytes_b.__getitem__, b)) == whole:
            good.append(i)
            ids_a.append(np.array(a, np.int64))
            ids_b.append(np.array(b, np.int64))
            totals.append(len(whole))
    if not good:
        return columns | {"groups_sha256": hashes}, np.zeros(0, np.uint64)
    ids = [np.concatenate(side) for side in (ids_a, ids_b)]
    sizes = [of[x] for of, x in zip(_all_sizes(path_a, path_b), ids, strict=True)]
    kind, at_a, at_b, text = cells(sizes, np.array(totals))
    # a group ends where both sides end; tokens without bytes belong to the group of the token before them
    both = kind == 3
    group = np.cumsum(both) - both
    groups = []
    for side, place, x in ((1, at_a, ids[0]), (2, at_b, ids[1])):
        ended = (kind & side) > 0
        of = np.full(len(x), -1, np.int64)
        of[place[ended]] = group[ended]
        groups.append(np.maximum.accumulate(of) if (of < 0).any() else of)
    n_groups = np.bincount(text, weights=both, minlength=len(good)).astype(np.int64)
    columns["n_a"][good], columns["n_b"][good] = [len(x) for x in ids_a], [len(x) for x in ids_b]
    columns["n_groups"][good], columns["n_links"][good] = n_groups, np.bincount(text, minlength=len(good))
    for i, digest in zip(good, _group_texts(ids, groups, n_groups, int(n_groups.sum())), strict=True):
        hashes[i] = digest
    numbers = np.array(good, np.uint64) + np.uint64(low)
    pair = (ids[0][at_a].astype(np.uint64) << np.uint64(25)) | ids[1][at_b].astype(np.uint64)
    return columns | {"groups_sha256": hashes}, (pair << np.uint64(13)) | numbers[text]


@functools.lru_cache(maxsize=2)
def _all_sizes(path_a: str, path_b: str) -> tuple[np.ndarray, np.ndarray]:
    _, _, bytes_a, bytes_b = tokenizers(path_a, path_b)
    return tuple(np.array([len(x) for x in side]) for side in (bytes_a, bytes_b))


def pair_counts(found: DataFrame) -> DataFrame:
    """(pair, n, best): documents that hold each pair, by popcounts of its bitmaps; best: no pair of its A id is in more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, _ = unpacked(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.bincount(row, minlength=batch.num_rows))], ["pair", "n"])

    sizes = found.filter("plane = 0").select("pair", "docs").mapInArrow(run, "pair long, n long")
    counts = stored(sizes.groupBy("pair").agg(F.sum("n").alias("n")).withColumn("a", F.shiftright("pair", 25)))
    # a row an id of A's vocabulary, so its size is bounded by that
    most = F.broadcast(counts.groupBy("a").agg(F.max("n").alias("most")))
    return counts.join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).cast("int").alias("best"))


def scores(found: DataFrame, counts: DataFrame) -> DataFrame:
    """(chunk, low, n_best, count_sum) of the documents that hold pairs: their containers, each with its pair's count, go to
    the tasks of their chunks, which add up all of a chunk in two arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for chunk, sums in held.items():
                low = np.flatnonzero(sums[1])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(low), chunk)), pa.array(low.astype(np.int32)), pa.array(sums[0][low]), pa.array(sums[1][low])], ["chunk", "low", "n_best", "count_sum"])
            held.clear()

        for batch in batches:
            if not batch.num_rows:
                continue
            chunk, plane, n, best = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            row, low = unpacked(batch.column(4))
            weight = 1 << np.maximum(plane.astype(np.int64) - 1, 0)
            names, number = np.unique(chunk, return_inverse=True)
            place, of = number[row] * CHUNK_DOCS + low, weight[row]
            total = np.zeros((2, len(names) * CHUNK_DOCS), np.int64)
            for k, value in enumerate((best.astype(np.int64), n)):
                np.add.at(total[k], place, of * value[row])
            for i, name in enumerate(names.tolist()):
                part = total[:, i * CHUNK_DOCS : (i + 1) * CHUNK_DOCS]
                held[name] = held[name] + part if name in held else part.copy()
            if len(held) > HELD_CHUNKS:
                yield from out()
        yield from out()

    # the pairs of a vocabulary aren't few enough to broadcast, so the same join at every size
    joined = found.select("pair", "chunk", "plane", "docs").join(counts.hint("merge"), "pair").select("chunk", "plane", "n", "best", "docs")
    added = joined.repartition("chunk").mapInArrow(run, "chunk long, low int, n_best long, count_sum long")
    return added.groupBy("chunk", "low").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def align_tokenizers(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for every row of docs (doc_id, text, any others).

    A reads a space and the text, B the text (to which it adds the space itself). Texts that are null or empty, or that either
    side's tokens don't give back byte by byte, have no tokens: zeros and an empty digest. Each row is a document of its own,
    also where ids repeat or are null; equal texts count once a row. An empty table gives no rows. A text of any length is
    read whole, in one task.
    """
    default_a, default_b = default_vocabularies()
    made = stored(postings(docs, path_a or default_a, path_b or default_b), TEXT_ROWS)
    found = made.filter("pair is not null")
    counts = stored(pair_counts(found))
    out = made.filter("pair is null").join(scores(found, counts), ["chunk", "low"], "left")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")
