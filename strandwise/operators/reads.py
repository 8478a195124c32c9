"""Reads: trimming, quality reports, gates, low complexity and unique molecular identifiers."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandwise.operators.graph import component_labels
from strandwise.storage import discard, stored


def _window_cut(window: int, mean: float, low: int):
    """UDF: (start, length, low) of a quality string: both ends cut up to the first window of that mean, and how many bases
    of the rest are below low. Running sums, one pass a read."""

    @F.pandas_udf("start int, length int, low int")
    def run(qual: pd.Series) -> pd.DataFrame:
        def one(text: str) -> tuple[int, int, int]:
            q = np.frombuffer(text.encode("latin-1", "replace"), np.uint8).astype(np.int64) - 33
            k = min(window, len(q))
            total = np.concatenate([[0], np.cumsum(q)])
            good = np.flatnonzero(total[k:] - total[: len(total) - k] >= mean * k) if k else []
            if not len(good):
                return 0, 0, 0
            start, end = int(good[0]), int(good[-1]) + k
            return start, end - start, int((q[start:end] < low).sum())

        return pd.DataFrame([one(x or "") for x in qual], columns=["start", "length", "low"])

    return run


def trim_reads(reads: DataFrame, window: int = 4, mean: float = 30, adapters: list[str] = (), poly: int = 10, low: int = 30, max_low: float = 0.10, min_length: int = 50) -> DataFrame:
    """reads (seq, qual) after clipping adapters and a tail of poly or more equal bases, cutting both ends up to the first
    window of the mean quality, and dropping reads that are short or have too many bases below low."""
    cut = lambda df, n: df.withColumn("_n", n).withColumns({c: F.expr(f"substring({c}, 1, _n)") for c in ("seq", "qual")}).drop("_n")
    out = reads
    if adapters:
        at = [F.when(F.instr("seq", a) > 0, F.instr("seq", a) - 1) for a in adapters]
        out = cut(out, F.coalesce(F.least(*at) if len(at) > 1 else at[0], F.length("seq")))
    out = cut(out, F.length(F.regexp_replace("seq", f"([ACGT])\\1{{{poly - 1},}}$", "")))
    out = out.withColumn("_cut", _window_cut(window, mean, low)("qual")).select("*", F.col("_cut.start").alias("_start"), F.col("_cut.length").alias("_length"), F.col("_cut.low").alias("_low"))
    kept = out.filter((F.col("_length") >= min_length) & (F.col("_low") <= max_low * F.col("_length")))
    return kept.withColumns({c: F.expr(f"substring({c}, _start + 1, _length)") for c in ("seq", "qual")}).drop("_cut", "_start", "_length", "_low")


def read_qc(reads: DataFrame, key: str) -> DataFrame:
    """(key, reads, mean_length, gc, n_share) of reads (seq)."""
    n = lambda pattern: F.sum(F.regexp_count("seq", F.lit(pattern)))
    total = F.sum(F.length("seq"))
    return reads.groupBy(key).agg(F.count("*").alias("reads"), F.avg(F.length("seq")).alias("mean_length"), (100 * n("[GCgc]") / total).alias("gc"), (100 * n("[Nn]") / total).alias("n_share"))


def quality_by_cycle(reads: DataFrame, keys: list[str] = ()) -> DataFrame:
    """(keys, cycle, n, mean, p10, q1, median, q3, p90) of reads (qual): qualities by place, from 0. A place's qualities are
    counted before the shuffle, so a histogram of some forty values a place is all that meets; quantiles are read off its
    running sums, as the least quality that at least that share of the reads doesn't exceed. Null and empty strings count for nothing."""
    marks = reads.select(*keys, F.posexplode(F.split("qual", "")).alias("cycle", "_q")).filter("_q <> ''")
    counted = marks.groupBy(*keys, "cycle", (F.ascii("_q") - 33).alias("quality")).agg(F.count("*").alias("k"))
    w = Window.partitionBy(*keys, "cycle")
    ranked = counted.withColumn("_up", F.sum("k").over(w.orderBy("quality"))).withColumn("_n", F.sum("k").over(w))
    at = lambda percent, name: F.min(F.when(100 * F.col("_up") >= percent * F.col("_n"), F.col("quality"))).alias(name)
    quantiles = [at(p, name) for p, name in ((10, "p10"), (25, "q1"), (50, "median"), (75, "q3"), (90, "p90"))]
    return ranked.groupBy(*keys, "cycle").agg(F.max("_n").alias("n"), (F.sum(F.col("quality") * F.col("k")) / F.max("_n")).alias("mean"), *quantiles)


def length_histogram(reads: DataFrame, keys: list[str] = ()) -> DataFrame:
    """(keys, length, reads): how many reads have each length; a null read has none and isn't counted."""
    return reads.filter("seq is not null").groupBy(*keys, F.length("seq").alias("length")).agg(F.count("*").alias("reads"))


def duplication(reads: DataFrame, key: str) -> DataFrame:
    """(key, copies, sequences): how many distinct sequences come how often."""
    return reads.groupBy(key, "seq").agg(F.count("*").alias("copies")).groupBy(key, "copies").agg(F.count("*").alias("sequences"))


def gate(df: DataFrame, count: str, least: int, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(pass, fail) by a count: at least, or strictly more than, least; a null count fails."""
    ok = F.coalesce(F.col(count) > least if strict else F.col(count) >= least, F.lit(False))
    return df.filter(ok), df.filter(~ok)


def kmers(seq: Column, k: int) -> Column:
    """All k-mers in order."""
    return F.transform(F.when(F.length(seq) >= k, F.sequence(F.lit(1), F.length(seq) - k + 1)).otherwise(F.array().cast("array<int>")), lambda i: F.substring(seq, i, F.lit(k)))


def complexity(seq: Column, k: int = 3) -> Column:
    """Entropy of the k-mers of a sequence, 0 to 1 of the most that so many can have; short ones: 0."""

    @F.pandas_udf("double")
    def run(seq: pd.Series) -> pd.Series:
        def one(text: str) -> float:
            n = len(text) - k + 1
            if n < 2:
                return 0.0
            share = np.array(list(Counter(text[i : i + k] for i in range(n)).values())) / n
            return float(-(share * np.log2(share)).sum() / np.log2(min(n, 4**k)))

        return pd.Series([one(x or "") for x in seq], dtype=float)

    return run(seq)


def dust(seq: Column) -> Column:
    """Triplet score: sum of c * (c - 1) / 2 over triplets, over the number of triplets less 1."""

    @F.pandas_udf("double")
    def run(seq: pd.Series) -> pd.Series:
        def one(text: str) -> float:
            counts = Counter(text[i : i + 3] for i in range(len(text) - 2))
            return sum(c * (c - 1) / 2 for c in counts.values()) / max(len(text) - 3, 1)

        return pd.Series([one(x or "") for x in seq], dtype=float)

    return run(seq)


def low_complexity(seq: Column, window: int = 50, least: float = 0.3, most: float = 0.20, k: int = 3) -> Column:
    """Struct (entropy, dust, low): the least entropy of the k-mers of any window, 0 to 1 of the most that so many can have;
    the largest triplet score of any window, 0 to 1 of that of one repeated triplet; and whether one passes its threshold.
    A short sequence is one window; one of less than two k-mers has entropy and score 0. A few array passes for each place of a
    window, so the time is linear in the length."""

    def extremes(codes: np.ndarray, n: int, g: np.ndarray) -> np.ndarray:
        """Sums of g(count) over the words of each window of n: a word that enters or leaves changes one term."""
        back, ahead = np.zeros(len(codes), np.int16), np.zeros(len(codes), np.int16)
        for lag in range(1, min(n, len(codes))):
            same = codes[lag:] == codes[:-lag]
            back[lag:] += same
            ahead[:-lag] += same
        step = np.diff(g)
        first = g[np.unique(codes[:n], return_counts=True)[1]].sum()
        return first + np.concatenate([[0], np.cumsum(step[back[n:]] - step[ahead[: len(codes) - n]])])

    def one(text: str) -> tuple[float, float, bool]:
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        out = []
        for size in (k, 3):
            number = len(points) - size + 1
            if number < 2:
                out.append(0.0)
                continue
            letters = np.unique(points, return_inverse=True)[1].astype(np.int64)
            codes = letters[:number]
            for i in range(1, size):  # renumbered after each letter, so that no code overflows
                codes = np.unique(codes * (letters.max() + 1) + letters[i : number + i], return_inverse=True)[1].astype(np.int64)
            n, count = min(number, window - size + 1), np.arange(window + 1)
            if len(out) == 0:
                sums = extremes(codes, n, np.where(count > 0, count * np.log2(np.maximum(count, 1)), 0.0))
                out.append(float(max(0.0, (np.log2(n) - sums.max() / n) / np.log2(min(n, 4**k)))))
            else:
                out.append(float(extremes(codes, n, count * (count - 1) / 2).max() / (n * (n - 1) / 2)))
        return out[0], out[1], bool(out[0] < least or out[1] > most)

    @F.pandas_udf("entropy double, dust double, low boolean")
    def run(seq: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([one(x or "") for x in seq], columns=["entropy", "dust", "low"])

    return run(seq)


def filter_complexity(reads: DataFrame, **options) -> DataFrame:
    """reads (seq) without those that have a window of low complexity."""
    return reads.withColumn("_c", low_complexity(F.col("seq"), **options)).filter("not _c.low").drop("_c")


def extract_umi(reads: DataFrame, length: int) -> DataFrame:
    """The first length bases go to the read's name."""
    return reads.withColumns({"umi": F.expr(f"substring(seq, 1, {length})"), "read_id": F.concat("read_id", F.lit("_"), F.expr(f"substring(seq, 1, {length})")), "seq": F.expr(f"substring(seq, {length + 1})"), "qual": F.expr(f"substring(qual, {length + 1})")})


def _pieces(pattern: str) -> list[tuple[str, int]]:
    """Runs of equal letters of a pattern of N, C and X: (letter, length)."""
    if not re.fullmatch("[NCX]+", pattern):
        raise ValueError(f"a pattern holds N, C and X only: {pattern!r}")
    return [(m[0][0], len(m[0])) for m in re.finditer(r"N+|C+|X+", pattern)]


def _groups(pattern: str) -> tuple[str, list[tuple[str, int]]]:
    """A pattern of named groups as a Java pattern whose parts are all groups, and (kind, number) of each part: umi, cell,
    discard, or keep for what stands between them. Named groups stand side by side, not within other groups."""
    re.compile(pattern)
    parts, at, depth, began, inside = [], 0, 0, 0, False
    while at < len(pattern):
        c = pattern[at]
        if c == "\\":
            at += 2
            continue
        if inside:
            inside = c != "]"
        elif c == "[":
            inside = True
            at += 1 + (pattern[at + 1 : at + 2] == "^")  # a bracket right after is a letter
        elif c == "|" and not depth:
            raise ValueError("alternatives belong into a group")
        elif c == "(":
            named = re.match(r"\(\?P<(umi|cell|discard)_?\w*>", pattern[at:])
            if named and depth:
                raise ValueError("named groups can't be within others")
            if named:
                parts.append(("keep", pattern[began:at]))
                parts.append((named[1], None))
                began, at = at + len(named[0]), at + len(named[0]) - 1
            depth += 1
        elif c == ")":
            depth -= 1
            if not depth and parts and parts[-1][1] is None:
                parts[-1] = (parts[-1][0], pattern[began:at])
                began = at + 1
        at += 1
    parts.append(("keep", pattern[began:].removesuffix("$")))
    out, number, found = "", 1, []
    for kind, text in parts:
        out += f"({text})"
        found.append((kind, number))
        number += 1 + re.compile(text).groups
    return f"(?s)^{out}{'$' if pattern.endswith('$') else '(.*)$'}", found + ([] if pattern.endswith("$") else [("keep", number)])


def cut_pattern(seq: Column, qual: Column, pattern: str) -> Column:
    """Struct (umi, cell, seq, qual) of a read by a pattern: a word of N (molecular word), C (cell word) and X (stays in the
    read), or a regular expression with groups named umi_*, cell_* and discard_*, which are cut out of the read. Null where
    the read is shorter than the word or the expression doesn't match from the start; qualities are cut as the read is."""
    pick = lambda kinds, parts: F.concat(*[p for kind, p in parts if kind in kinds], F.lit(""))
    if re.fullmatch("[NCX]+", pattern):
        at, own, marks = 1, [], []
        for letter, n in _pieces(pattern):
            own.append((letter, F.substring(seq, at, n)))
            marks.append((letter, F.substring(qual, at, n)))
            at += n
        ok, rest = F.length(seq) >= len(pattern), 1 << 30
        own.append(("X", F.substring(seq, at, rest)))
        marks.append(("X", F.substring(qual, at, rest)))
        names = ("N", "C", "X")
    else:
        expression, found = _groups(pattern)
        ok, names = seq.rlike(expression), ("umi", "cell", "keep")
        own = [(kind, F.regexp_extract(seq, expression, number)) for kind, number in found]
        marks, at = [], F.lit(1)
        for kind, part in own:
            marks.append((kind, F.substring(qual, at, F.length(part))))
            at = at + F.length(part)
    return F.when(ok, F.struct(pick(names[0], own).alias("umi"), pick(names[1], own).alias("cell"), pick(names[2], own).alias("seq"), pick(names[2], marks).alias("qual")))


def extract_pattern(reads: DataFrame, pattern: str, mate_pattern: str | None = None, discard: int | None = None, keys: list[str] = ("read_id",)) -> DataFrame:
    """reads (keys, read_id, mate, seq, qual, ...) with umi and cell added, cut out of the reads, and put at the end of the
    read's name (cell before umi), alike for both mates. pattern is for mate 1, mate_pattern for mate 2 (cut_pattern); a read
    whose mate doesn't match goes with it. discard: the mate to drop when the words have been taken, so that the other goes on
    as a single read with mate 1. Rows of the same keys are mates of each other."""
    cut = F.when(F.col("mate") == 1, cut_pattern(F.col("seq"), F.col("qual"), pattern))
    cut = F.when(F.col("mate") == 2, cut_pattern(F.col("seq"), F.col("qual"), mate_pattern)).otherwise(cut) if mate_pattern else cut
    marked = reads.withColumn("_cut", cut).withColumn("_fails", F.col("_cut").isNull() & ((F.col("mate") == 1) | F.lit(bool(mate_pattern))))
    words = lambda c: F.concat_ws("", *[F.max(F.when(F.col("mate") == m, F.col(f"_cut.{c}"))) for m in (1, 2)]).alias(c)
    both = marked.groupBy(*keys).agg(words("umi"), words("cell"), F.max("_fails").alias("_fails"), F.max(F.col("mate") == 1).alias("_first")).filter("not _fails and _first")
    named = marked.drop("umi", "cell", "_fails").join(both.drop("_fails", "_first"), list(keys))
    suffix = F.concat(F.when(F.col("cell") != "", F.concat(F.lit("_"), "cell")).otherwise(""), F.lit("_"), F.col("umi"))
    out = named.withColumns({"read_id": F.concat("read_id", suffix), "seq": F.coalesce("_cut.seq", "seq"), "qual": F.coalesce("_cut.qual", "qual")}).drop("_cut")
    return out.filter(F.col("mate") != discard).withColumn("mate", F.lit(1)) if discard else out


def dedup_umi(reads: DataFrame, keys: list[str] = (), method: str = "directional") -> DataFrame:
    """(keys, umi, n, group): words within one mismatch of each other, as groups. cluster links all neighbours; directional
    links a to b only if n(a) >= 2 n(b) - 1, and a group is what its commonest word reaches along such links, so that two
    common words that share a rare neighbour stay apart. Neighbours share a word with one place cut out, so they meet in an
    equi join."""
    counted = reads.groupBy(*keys, "umi").agg(F.count("*").alias("n")).withColumn("id", F.xxhash64(*keys, "umi"))
    holes = F.transform(F.sequence(F.lit(1), F.length("umi")), lambda i: F.concat(i.cast("string"), F.lit(":"), F.substring("umi", F.lit(1), i - 1), F.lit("_"), F.substring("umi", i + 1, F.length("umi"))))
    cut = counted.filter("length(umi) > 0").select(*keys, "id", "n", F.explode(holes).alias("hole"))
    other = cut.select(*keys, F.col("id").alias("id_b"), F.col("n").alias("n_b"), "hole")
    near = cut.join(other, [*keys, "hole"]).filter("id <> id_b and n >= n_b")
    if method == "directional":
        return _directed_groups(counted, near.filter("n >= 2 * n_b - 1").select("id", "n", "id_b", "n_b").distinct()).select(*keys, "umi", "n", "group")
    if method != "cluster":
        raise ValueError(f"unknown method {method}")
    labels = component_labels(near.select(F.col("id").alias("src"), F.col("id_b").alias("dst")))
    return counted.join(labels, "id", "left").select(*keys, "umi", "n", F.coalesce("component", "id").alias("group"))


def _directed_groups(counted: DataFrame, links: DataFrame, rounds: int = 64) -> DataFrame:
    """counted (umi, n, id) with group: the id of the commonest word (ties by word) from which links (id, n, id_b, n_b) lead to it.

    Counts at least halve, nearly, along a link, but for words seen once, which reach each other both ways: those are
    contracted first, so the rounds that hand the best word on along links are as many as a count has bits.
    """
    once = component_labels(links.filter("n = 1 and n_b = 1").select(F.col("id").alias("src"), F.col("id_b").alias("dst")))
    words = stored(counted.join(once, "id", "left").withColumn("node", F.coalesce("component", "id")).drop("component"))
    node = words.select("id", "node")
    edges = links.filter("n > 1").join(node, "id").join(node.select(F.col("id").alias("id_b"), F.col("node").alias("to")), "id_b")
    edges = stored(edges.select("node", "to").filter("node <> to").distinct())
    best = stored(words.groupBy("node").agg(F.min(F.struct((-F.col("n")).alias("n"), "umi", "id")).alias("best")))
    for _ in range(rounds):
        handed = edges.join(best, "node").groupBy(F.col("to").alias("node")).agg(F.min("best").alias("handed"))
        joined = best.join(handed, "node", "left")
        after = stored(joined.select("node", F.least("best", "handed").alias("best"), (F.col("handed") < F.col("best")).alias("moved")))
        settled = after.filter("moved").isEmpty()
        discard(best)
        best = after.drop("moved")
        if settled:
            return words.join(best, "node").withColumn("group", F.col("best.id"))
    raise RuntimeError("groups did not settle")


def umi_representatives(groups: DataFrame, keys: list[str] = ()) -> DataFrame:
    """The commonest word of each group (ties by word), with the group's reads."""
    w = Window.partitionBy(*keys, "group")
    return groups.withColumn("reads", F.sum("n").over(w)).withColumn("_p", F.row_number().over(w.orderBy(F.desc("n"), "umi"))).filter("_p = 1").drop("_p", "n")
