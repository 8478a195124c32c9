"""Alleles of reads, calls with indels, and consensus with inserted bases, against a walk over each read."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest

from strandwise.operators import alignments, variants

SCHEMA = "ref string, pos long, flag int, cigar string, seq string, qual string, note string"


def made(seed: int, n: int = 120) -> list[tuple]:
    rng, out = random.Random(seed), []
    for _ in range(n):
        parts = []
        for op in rng.choice(["M", "M", "MIM", "MDM", "SMS", "MIMDM", "HMH", "MNM", "=X=", "MPM", "IM", "MI"]):
            parts.append((rng.randrange(1, 4) if op in "ID" else rng.randrange(1, 9), op))
        size = sum(k for k, op in parts if op in "MIS=X")
        seq = "".join(rng.choice("ACGTacgtN") for _ in range(size))
        qual = rng.choice(["*", None]) if rng.random() < 0.1 else "".join(chr(33 + rng.randrange(10, 40)) for _ in range(size))
        out.append((rng.choice(["one", "two"]), rng.randrange(1, 6), rng.choice([0, 16, 4]), "".join(f"{k}{op}" for k, op in parts), seq, qual, "x"))
    return out + [("one", 3, 0, None, "ACGT", None, "x"), ("one", 3, 0, "*", None, "*", None), ("one", 3, 0, "4M", None, "IIII", "x")]


def walked(reads: list[tuple]) -> list[tuple]:
    out = []
    for ref, pos, flag, cigar, seq, qual, _ in reads:
        if flag & 4 or not cigar or not seq:
            continue
        at, i, seq = pos, 0, seq.upper()
        score = (lambda k: ord(qual[k]) - 33 if 0 <= k < len(qual) else None) if qual and len(qual) == len(seq) else lambda k: None
        for size, op in re.findall(r"(\d+)([MIDNSHP=X])", cigar):
            size = int(size)
            if op in "M=X":
                out += [(ref, at + k, seq[i + k], None, score(i + k), flag & 16 > 0) for k in range(size)]
            elif op == "I":
                marks = [score(i + k) for k in range(size)]
                out.append((ref, at - 1, "+" + seq[i : i + size], None, None if None in marks else sum(marks) // size, flag & 16 > 0))
            elif op == "D":
                out.append((ref, at - 1, "-", size, score(i - 1), flag & 16 > 0))
                out += [(ref, at + k, "*", None, score(i - 1), flag & 16 > 0) for k in range(size)]
            at += size if op in "M=XDN" else 0
            i += size if op in "M=XIS" else 0
    return out


def rows(df, *columns) -> list[tuple]:
    return sorted((tuple(r[c] for c in columns or df.columns) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def reads():
    return made(4)


def test_alleles(spark, reads):
    found = alignments.alleles(spark.createDataFrame(reads, SCHEMA).repartition(3))
    assert rows(found, "ref", "pos", "allele", "deleted", "quality", "reverse") == sorted(walked(reads), key=repr)
    assert alignments.alleles(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize(("min_depth", "min_freq"), [(1, 0.0), (5, 0.1), (10, 0.3)])
def test_calls(spark, reads, min_depth, min_freq):
    references = {"one": "ACGTacgtACGTACGTACGTAC", "two": "TTTTTTTTTT"}
    counted = alignments.count_alleles(alignments.alleles(spark.createDataFrame(reads, SCHEMA)))
    calls = variants.call_alleles(counted, spark.createDataFrame(list(references.items()), "ref string, seq string"), min_depth=min_depth, min_freq=min_freq)
    good = [r for r in walked(reads) if r[4] is None or r[4] >= 20]
    want, n, rv, quality = [], Counter(), Counter(), defaultdict(list)
    for ref, pos, allele, deleted, q, reverse in good:
        key = (ref, pos, allele, deleted)
        n[key] += 1
        rv[key] += reverse
        quality[key] += [q] if q is not None else []
    mean = lambda key: sum(quality[key]) / n[key] if quality[key] else None
    for key, depth in n.items():
        ref, pos, allele, deleted = key
        if not 1 <= pos <= len(references[ref]):
            continue
        base = references[ref][pos - 1].upper()
        total = sum(k for (r, p, a, _), k in n.items() if (r, p) == (ref, pos) and a in "ACGT*")
        if allele == base or allele in ("*", "N") or total < min_depth or not total or depth / total < min_freq:
            continue
        alt = "-" + references[ref][pos : pos + deleted].upper() if deleted else allele
        own = (ref, pos, base, None)
        want.append((ref, pos, base, alt, n[own], rv[own], mean(own) if n[own] else None, depth, rv[key], mean(key), depth / total, total))
    assert rows(calls) == sorted(want, key=repr)
    assert min_freq or {r[3][0] for r in want} >= set("ACGT+-")


@pytest.mark.parametrize("insertion", [0.0, 0.1, 0.5])
def test_consensus_with_insertions(spark, reads, insertion):
    counted = alignments.count_alleles(alignments.alleles(spark.createDataFrame(reads, SCHEMA)))
    got = {r.ref: r.seq for r in alignments.inserted_consensus(counted, min_depth=2, insertion=insertion).collect()}
    at = defaultdict(Counter)
    for ref, pos, allele, deleted, q, _ in walked(reads):
        if q is None or q >= 20:
            at[ref, pos][allele if not deleted else f"-{deleted}"] += 1
    for ref in ("one", "two"):
        seq = ""
        for pos in sorted(p for r, p in at if r == ref):
            alleles = at[ref, pos]
            depth = sum(alleles[b] for b in "ACGT")
            top = max(alleles[b] for b in "ACGT")
            seq += alignments.IUPAC[sum(1 << i for i, b in enumerate("ACGT") if alleles[b] == top)] if depth >= 2 else "N"
            plus = sorted((-k, a) for a, k in alleles.items() if a[0] == "+")
            if plus and depth + alleles["*"] and -plus[0][0] / (depth + alleles["*"]) >= insertion:
                seq += plus[0][1][1:]
        assert got[ref] == seq


def test_calls_go_on_to_types_and_strands(spark):
    reads = [("r", 1, 16 * (i % 2), "3M2I3M2D2M", "ACGTTACGAC", "IIIIIIIIII", "") for i in range(12)]
    counted = alignments.count_alleles(alignments.alleles(spark.createDataFrame(reads, SCHEMA)))
    calls = variants.call_alleles(counted, spark.createDataFrame([("r", "ACGACGGGAC")], "ref string, seq string"))
    typed = variants.strand_depths(variants.typed(calls))
    assert rows(typed, "pos", "type", "ref", "alt", "alt_fw", "alt_rv") == [(3, "INS", "G", "GTT", 6, 6), (6, "DEL", "GGG", "G", 6, 6)]
