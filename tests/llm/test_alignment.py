"""Tokenizer alignment against a token-by-token version, and odd tables."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strandwise.llm import alignment

SCHEMA = "doc_id long, text string, chunk string, pair string"


def brute(texts: list[str | None]) -> list[tuple]:
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of each text, by comparing byte ranges."""
    encode_a, encode_b, bytes_a, bytes_b = alignment.tokenizers(*alignment.default_vocabularies())
    out, linked = [], []
    for text in texts:
        text = text or ""
        a, b, whole = encode_a(" " + text), encode_b(text), (" " + text).encode()
        if not text or b"".join(bytes_a[i] for i in a) != whole or b"".join(bytes_b[i] for i in b) != whole:
            out.append((0, 0, 0, 0, ""))
            linked.append(Counter())
            continue
        spans = []
        for ids, table in ((a, bytes_a), (b, bytes_b)):
            ends = np.cumsum([len(table[i]) for i in ids]).tolist()
            spans.append(list(zip([0, *ends[:-1]], ends, ids, strict=True)))
        shared = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups, since = [], 0
        for end in shared:
            groups.append("|".join(",".join(str(i) for s, e, i in side if since < e <= end) for side in spans))
            since = end
        pairs = Counter((i, j) for s, e, i in spans[0] for t, f, j in spans[1] if s < f and t < e)
        out.append((len(a), len(b), len(groups), sum(pairs.values()), hashlib.sha256(";".join(groups).encode()).hexdigest()))
        linked.append(pairs)
    count = Counter(pair for pairs in linked for pair in pairs)
    most: Counter = Counter()
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    best = [sum(n for p, n in pairs.items() if count[p] == most[p[0]]) for pairs in linked]
    total = [sum(n * count[p] for p, n in pairs.items()) for pairs in linked]
    return [(*row[:4], best[i], total[i], row[4]) for i, row in enumerate(out)]


def result(df) -> list[tuple]:
    columns = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted(((r.doc_id, *(r[c] for c in columns)) for r in df.collect()), key=repr)


ODD = ["", None, " ", "x", "word word word word word", "a<unk>b <s> </s>", "<|endoftext|> plain", "▁ x", "tab\tand\nline", "é 漢字 🙂 mixed", "  two  spaces ", "the " * 700, "nul\x00byte"]


def test_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", F.substring("text", 1, 1500).alias("text"))
    texts = [(r.doc_id, r.text, "c", "p") for r in docs.limit(60).collect()] + [(10_000 + i, t, None, "p") for i, t in enumerate(ODD)]
    want = sorted(((d, *row) for (d, *_), row in zip(texts, brute([t[1] for t in texts]), strict=True)), key=repr)
    table = spark.createDataFrame(texts, SCHEMA).repartition(3)
    assert result(alignment.align_tokenizers(table)) == want


def test_chunks_and_bitmaps_do_not_change_the_result(spark, monkeypatch):
    texts = [(i % 40, f"word{i % 3} common the the the text", "", "") for i in range(700)]
    want = sorted(((d, *row) for (d, *_), row in zip(texts, brute([t[1] for t in texts]), strict=True)), key=repr)
    table = spark.createDataFrame(texts, SCHEMA).coalesce(1)  # one chunk: pairs in 512 documents and more are bitmaps
    assert result(alignment.align_tokenizers(table)) == want
    monkeypatch.setattr(alignment, "CHUNK_LINKS", 50)
    monkeypatch.setattr(alignment, "HELD_CHUNKS", 2)
    assert result(alignment.align_tokenizers(table)) == want


def test_repeated_and_null_ids_and_empty_tables(spark):
    table = spark.createDataFrame([(1, "same text", "", ""), (1, "same text", "", ""), (None, "same text", "", ""), (None, None, "", "")], SCHEMA)
    ids, texts = [1, 1, None, None], ["same text", "same text", "same text", None]
    want = sorted(((d, *row) for d, row in zip(ids, brute(texts), strict=True)), key=repr)
    assert result(alignment.align_tokenizers(table)) == want and want[0][6] == 3 * want[0][4]
    assert alignment.align_tokenizers(table.limit(0)).count() == 0


@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 8192])
def test_containers(n):
    lows = np.sort(np.random.default_rng(n).permutation(alignment.CHUNK_DOCS)[:n]).astype(np.uint16)
    packed = alignment.container(lows)
    assert len(packed) <= alignment.DENSE
    row, low = alignment.unpacked(pa.array([b"", packed, alignment.container(lows[:1])], pa.binary()))
    assert np.sort(low[row == 1]).tolist() == lows.tolist() and not (row == 0).any()
