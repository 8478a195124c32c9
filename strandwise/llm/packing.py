"""Packing documents into fixed windows of tokens by lexical retrieval from a sharded BM25 index."""

from __future__ import annotations

import base64
import functools
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandwise.llm.common import mix
from strandwise.storage import stored

#: Window length; the id after each document; the vocabulary's special token and its id.
WINDOW, END, SPECIAL, SPECIAL_ID = 2048, 1, "<|endoftext|>", 50_256
#: Tokens of an index shard (held in one task's memory).
INDEX_TOKENS = 1 << 22
#: BM25 parameters, the seed's terms of most weight that make up the query, and neighbours that a search sorts at first.
K1, B, QUERY_TERMS, NEAREST = 1.2, 0.75, 24, 64
#: How strongly the draw of a document's content key leans to terms of high weight. Most Spark partitions of the dealing.
LEAN, MOST_PARTS = 3, 50_000


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@functools.lru_cache(maxsize=2)
def _encoder(path: str):
    """The tokenizer of a ranks file. The same ids as the tokenizers library gives for the same vocabulary, at four times the speed."""
    import public_tokenizers
    import tiktoken

    lines = (line.split() for line in Path(path).read_bytes().splitlines() if line)
    return tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in lines}, special_tokens={SPECIAL: SPECIAL_ID})


def encoded(encoder, text: str) -> np.ndarray:
    """Ids of a text as unsigned 16-bit numbers, END after them; a special token's string is that token, as the tokenizers library has it."""
    found = encoder.encode_to_numpy(text, allowed_special="all") if SPECIAL in text else encoder.encode_to_numpy(text, disallowed_special=())
    return np.append(found, END).astype("<u2")


def tokenized(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids, terms, counts) for every row: ids with END after the text's own, and its distinct ids with
    their numbers, all as little-endian unsigned 16-bit numbers (a number over 65535 counts as that)."""
    path = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                ids = [encoded(encoder, text.as_py()) for text in part.column(1)]
                term, tf, sizes = distinct(ids)
                ends = np.cumsum(sizes)
                binary = lambda arrays: pa.array([x.tobytes() for x in arrays], pa.binary())
                cut = lambda x: np.split(np.minimum(x, 65535).astype("<u2"), ends[:-1])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(map(len, ids), pa.int64()), binary(ids), binary(cut(term)), binary(cut(tf))], ["doc_id", "n_tokens", "ids", "terms", "counts"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).mapInArrow(run, "doc_id long, n_tokens long, ids binary, terms binary, counts binary")


def distinct(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct ids of one document after the other, ascending in each, how often each stands there, and how many each has."""
    lengths = np.array([len(d) for d in docs])
    kind = np.uint32 if len(docs) <= 1 << 16 else np.uint64
    both = np.sort(np.repeat(np.arange(len(docs), dtype=kind) << kind(16), lengths) | np.concatenate(docs))
    at = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]]))
    first = both[at].astype(np.int64)
    return first & 0xFFFF, np.diff(np.append(at, len(both))), np.bincount(first >> 16, minlength=len(docs))


def document_frequencies(tokens: DataFrame) -> tuple[np.ndarray, int, int]:
    """Documents that hold each term, documents, tokens: over the whole corpus, a number for each id of the vocabulary at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, docs, total = np.zeros(1 << 16, np.int64), 0, 0
        for batch in batches:
            seen += np.bincount(_joined(batch.column(0))[0], minlength=1 << 16)
            docs, total = docs + batch.num_rows, total + int(batch.column(1).to_numpy(zero_copy_only=False).sum())
        used = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([used, [-1, -2]])), pa.array(np.concatenate([seen[used], [docs, total]]))], ["term", "n"])

    counts = tokens.select("terms", "n_tokens").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    out, docs, total = np.zeros(1 << 16, np.int64), 0, 0
    for row in counts.collect():  # a row a term of the vocabulary
        if row.term >= 0:
            out[row.term] = row.n
        elif row.term == -1:
            docs = row.n
        else:
            total = row.n
    return out, docs, total


def _joined(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The 16-bit numbers of a binary column one after the other, and how many each row has."""
    raw = column.to_pylist()
    return np.frombuffer(b"".join(raw), "<u2"), np.array([len(x) // 2 for x in raw], np.int64)


def _weights(term: np.ndarray, tf: np.ndarray, length: np.ndarray, idf: np.ndarray, mean: float) -> np.ndarray:
    """BM25 weights of terms in documents."""
    return (idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean))).astype(np.float32)


def content_keys(term: np.ndarray, weight: np.ndarray, sizes: np.ndarray, salt: int) -> np.ndarray:
    """A term of each document (sizes of them, one or more terms each), drawn in proportion to weight ** LEAN by hashes of the terms:
    two documents draw the same one with the chance of their weighted overlap, copies always."""
    chance = ((mix(term.astype(np.uint64) + np.uint64((salt + 1) << 20)) >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    time = -np.log(chance) / np.maximum(weight.astype(np.float64) ** LEAN, 1e-12)
    least = np.repeat(np.minimum.reduceat(time, starts), sizes)
    at = np.flatnonzero(time == least)
    _, first = np.unique(np.repeat(np.arange(len(sizes)), sizes)[at], return_index=True)
    return term[at[first]].astype(np.int64)


class Bm25:
    """Inverted index of one shard: term frequencies by term, with the whole corpus' idf and mean length."""

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, mean: float):
        self.n = len(docs)
        term, tf, sizes = distinct(docs)
        lengths, doc = np.array([len(d) for d in docs]), np.repeat(np.arange(self.n), sizes)
        weight = _weights(term, tf, lengths[doc], idf, mean)
        best = np.argsort(doc - weight / (weight.max() + 1.0), kind="stable")  # by document, falling weight, term
        first = np.concatenate([[0], np.cumsum(sizes)])
        self.queries = [term[best[a : min(b, a + QUERY_TERMS)]] for a, b in zip(first[:-1], first[1:], strict=True)]
        by_term = np.argsort(term, kind="stable")
        self.doc, self.weight = doc[by_term], weight[by_term]
        self.starts = np.searchsorted(term[by_term], np.arange((1 << 16) + 1))

    def scores(self, seed: int) -> np.ndarray:
        spans = [slice(self.starts[t], self.starts[t + 1]) for t in self.queries[seed]]
        return np.bincount(np.concatenate([self.doc[s] for s in spans]), np.concatenate([self.weight[s] for s in spans]), self.n) if spans else np.zeros(self.n)

    def neighbours(self, seed: int, used: np.ndarray) -> np.ndarray:
        """Unused documents by falling score, ties by place; those that share no query term are not among them."""
        return np.fromiter(self.each_neighbour(seed, used), np.int64)

    def each_neighbour(self, seed: int, used: np.ndarray) -> Iterator[int]:
        """neighbours() one by one: the first NEAREST are sorted at once, the others only if they are asked for."""
        score = self.scores(seed)
        score[used] = 0
        found = np.flatnonzero(score)
        if len(found) > NEAREST:
            edge = np.partition(score[found], len(found) - NEAREST)[len(found) - NEAREST]
            near = found[score[found] > edge]
            yield from near[np.argsort(-score[near], kind="stable")]
            found = found[score[found] <= edge]
        yield from found[np.argsort(-score[found], kind="stable")]


def chain(index: Bm25, lengths: np.ndarray, window: int = WINDOW, begun: int = 0) -> list[int]:
    """The order in which a shard's documents fill windows: a seed, then its best unused neighbours while the window that
    the seed ends in has room; the one that overruns it is the next seed. Without neighbours the next unused one in order is
    taken. begun: how far the first window is filled already."""
    used, out, fill, at, seed = np.zeros(len(lengths), bool), [], begun % window, 0, None
    while True:
        if seed is None:
            while at < len(lengths) and used[at]:
                at += 1
            if at == len(lengths):
                return out
            seed, used[at] = at, True
            out.append(seed)
            fill = (fill + lengths[seed]) % window
        nxt = None
        for d in index.each_neighbour(seed, used):
            used[d] = True
            out.append(int(d))
            over = fill + lengths[d] >= window
            fill = (fill + lengths[d]) % window
            if over:
                nxt = int(d)
                break
        seed = nxt


def dealt_by_content(tokens: DataFrame, shared, parts: int) -> DataFrame:
    """tokens (doc_id, row, ids) sorted by content, in parts ranges of about equal numbers of rows.

    The content key is two terms that each document draws (content_keys); documents of the same key, and keys of the same
    first term, stand together. The row breaks ties, so that a range border may divide a key however many documents have it.
    """

    @F.arrow_udf("long")
    def key(terms: pa.Array, counts: pa.Array, n_tokens: pa.Array) -> pa.Array:
        idf, mean = shared.value
        (term, sizes), (tf, _) = _joined(terms), _joined(counts)
        if not len(sizes):
            return pa.array([], pa.int64())
        length = np.repeat(n_tokens.to_numpy(zero_copy_only=False), sizes)
        weight = _weights(term.astype(np.int64), tf.astype(np.int64), length, idf, mean)
        first, second = (content_keys(term, weight, sizes, salt) for salt in (0, 1))
        return pa.array(first * (1 << 16) + second)

    keyed = tokens.select("doc_id", "row", "ids", key("terms", "counts", "n_tokens").alias("content"))
    return keyed.repartitionByRange(parts, "content", "row").sortWithinPartitions("content", "row").select("doc_id", "ids")


def pack(docs: DataFrame, vocabulary: str | None = None, window: int = WINDOW, index_tokens: int = INDEX_TOKENS) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset): the pieces of every row of docs (doc_id, text).

    Each text's ids with END after them lie in pieces without gap or overlap; a sequence is filled from 0 up to window, only
    the last of a Spark partition is shorter. Documents are dealt by content (dealt_by_content), so that likely neighbours
    meet in one index shard of index_tokens tokens; there each seed's best unused neighbours fill its window (chain). A corpus
    of any size is dealt in the same way. Term statistics are the whole corpus'. Null and empty texts are the
    single id END; rows that repeat a doc_id are packed each for itself, a null doc_id stays null; equal scores are taken in
    the shard's order. An empty table gives no pieces. A long text is cut into as many sequences as it needs.
    """
    tokens = stored(tokenized(docs, vocabulary).withColumn("row", F.monotonically_increasing_id()))
    seen, n_docs, total = document_frequencies(tokens)
    idf = np.log1p((n_docs - seen + 0.5) / (seen + 0.5)).astype(np.float32)
    shared = docs.sparkSession.sparkContext.broadcast((idf, total / max(1, n_docs)))  # 256 KB
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc_ids, ids, size, at = [], [], 0, 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal at
            lengths, rows, base = np.array([len(x) for x in ids]), [], TaskContext.get().partitionId() << 40
            for d in chain(Bm25(ids, *shared.value), lengths, window, at):
                start = 0
                while start < lengths[d]:
                    take = min(int(lengths[d]) - start, window - at % window)
                    piece = ids[d][start : start + take].astype("<u4").tobytes()
                    rows.append((doc_ids[d], start, take, zlib.crc32(piece), int(lengths[d]), base + at // window, at % window))
                    start, at = start + take, at + take
            for i in range(0, len(rows), 10_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows[i : i + 10_000], strict=True)], names)

        for batch in batches:
            for doc_id, raw in zip(*(batch.column(i).to_pylist() for i in range(2)), strict=True):
                doc_ids.append(doc_id)
                ids.append(np.frombuffer(raw, "<u2"))
                size += len(ids[-1])
                if size >= index_tokens:
                    yield from flush()
                    doc_ids, ids, size = [], [], 0
        if ids:
            yield from flush()

    return dealt_by_content(tokens, shared, min(MOST_PARTS, -(-total // index_tokens) + 1)).mapInArrow(run, schema)
