"""Toxicity as graded severity: cumulative-link ordinal regression on sparse text features."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandwise.llm.common import LOWER, pieces, shingle_set, slice_hashes, text_buffers
from strandwise.storage import stored

#: Hashed features; labelled rows of each class that the model is fitted on, about; grades above 0.
FEATURES, ROWS_A_CLASS, GRADES = 1 << 18, 6000, 3
#: Documents that a feature has to be in before it can be chosen.
LEAST_DOCS = 4
#: Weight of all toxic texts in the fit, of 1.
LEAN = 0.6
PREFIXES = (4, 5, 6)
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


def features(data: np.ndarray) -> np.ndarray:
    """Hashed features of one text, one a word and one a prefix of PREFIXES bytes of longer words; words are runs of letters."""
    if not len(data):
        return np.zeros(0, np.int64)
    edge = np.diff(np.concatenate(([False], _LETTER[data], [False])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    low = LOWER[data]
    accented = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
    low[accented] += 32  # capital letters of Latin-1 in UTF-8
    s, e = [starts], [ends]
    for k in PREFIXES:
        longer = ends - starts > k
        s.append(starts[longer])
        e.append(starts[longer] + k)
    if not len(starts):
        return np.zeros(0, np.int64)
    return (slice_hashes(low, np.concatenate(s), np.concatenate(e)) % np.uint64(FEATURES)).astype(np.int64)


@dataclass
class SeverityModel:
    """P(grade > k) = 1 / (1 + exp(cuts[k] - weights . x)), with one weight a feature for all cuts; x: log(1 + count).

    The fit weighs toxic texts LEAN of 1, however rare they are, so these chances lean to toxic, which is what the decision
    at 0.5 wants. shift is the log-odds between that weight and the labelled share of toxic texts: with it they are chances
    at that share, so that a text without any telling feature has about the chance that the labels have, not more."""

    weights: np.ndarray
    cuts: np.ndarray
    shift: float = 0.0

    def likely(self, leaning: np.ndarray) -> np.ndarray:
        """Chances at the labelled share from chances() of the leaning fit."""
        return leaning / (leaning + (1 - leaning) * np.exp(self.shift))

    def chances(self, found: np.ndarray) -> np.ndarray:
        hit = found[self.weights[found] != 0]
        value = 0.0
        if len(hit):
            which, count = np.unique(hit, return_counts=True)
            value = float((self.weights[which] * np.log1p(count)).sum())
        return 1 / (1 + np.exp(np.clip(self.cuts - value, -50, 50)))


def _distinct(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of one text and their counts."""
    found = features(data)
    which, count = np.unique(found, return_counts=True)
    return which.astype("<u4"), np.minimum(count, 65535).astype("<u2")


def _near_key(label: int, data: np.ndarray) -> bytes:
    """Copies and near copies have the same label and the same three least shingles; they count once, else their other words would tell."""
    return bytes([label]) + shingle_set(data, 3)[:3].tobytes()


def _chosen(seen: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features that are commoner among toxic texts by so large a log-likelihood ratio that about one of all candidates would
    be so by chance, and the logarithms of their ratios of shares. seen: (2, features) texts with each feature; n: texts, by class."""
    if not n.all():
        return np.zeros(0, np.int64), np.zeros(0)
    total = seen.sum(0)
    candidates = np.flatnonzero(total >= LEAST_DOCS)
    part = seen[:, candidates]
    expected = total[candidates][None, :] * (n / n.sum())[:, None]
    evidence = 2 * (part * np.log(np.maximum(part, 1) / np.maximum(expected, 1e-9))).sum(0)
    share = (part + 0.5) / (n + 1)[:, None]
    own = (share[1] > 4 * share[0]) & (evidence >= 2 * np.log(max(2, len(candidates))))
    return candidates[own], np.log(share[1] / share[0])[own]


def _graded(fold: np.ndarray, toxic: np.ndarray, row: np.ndarray, feature: np.ndarray, count: np.ndarray, lists: list) -> np.ndarray:
    """Grades: 0 for texts that aren't toxic, 1 to GRADES for toxic ones by thirds of their fold, in order of the evidence
    of the tell-tale features that were chosen on the other fold, so that no text's grade comes from features that it chose."""
    out = np.zeros(len(toxic), int)
    for own in (0, 1):
        which, weight = lists[1 - own]
        value = np.zeros(FEATURES)
        value[which] = weight
        evidence = np.bincount(row, value[feature] * np.log1p(count), len(toxic))
        mine = np.flatnonzero((fold == own) & (toxic == 1))
        order = mine[np.argsort(evidence[mine], kind="stable")]
        out[order] = 1 + np.arange(len(order)) * GRADES // max(1, len(order))
    return out


def _trained(grade: np.ndarray, row: np.ndarray, column: np.ndarray, value: np.ndarray, prior: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and cuts by gradient steps on the cumulative-link loss; the texts' features are (row, column, value)."""
    n, w, cuts = len(grade), 0.5 * prior, np.arange(1.0, GRADES + 1.0)
    target = (grade[:, None] > np.arange(GRADES)[None, :]).astype(float)
    positive = grade > 0
    weight = np.where(positive, LEAN / max(1, positive.sum()), (1 - LEAN) / max(1, (~positive).sum()))[:, None] / GRADES
    gw, gc = np.zeros_like(w), np.zeros_like(cuts)
    for _ in range(rounds):
        score = np.bincount(row, value * w[column], n)
        p = 1 / (1 + np.exp(np.clip(cuts[None, :] - score[:, None], -50, 50)))
        slope = (p - target) * weight
        dw, dc = np.bincount(column, value * slope.sum(1)[row], len(w)) + 1e-5 * (w - prior), -slope.sum(0)
        gw, gc = gw + dw**2, gc + dc**2
        w, cuts = w - 0.3 * dw / (np.sqrt(gw) + 1e-8), np.sort(cuts - 0.3 * dc / (np.sqrt(gc) + 1e-8))
    return w, cuts


def _model(seen: np.ndarray, fold: np.ndarray, toxic: np.ndarray, hits, rounds: int, share: float) -> SeverityModel:
    """seen: (2 folds, 2 classes, FEATURES) texts with each feature. hits: from chosen features to (row, feature, count) of all
    texts. share: of all labelled texts, those that are toxic. Without a toxic or without another text the model calls nothing toxic."""
    n = np.array([[((fold == f) & (toxic == c)).sum() for c in (0, 1)] for f in (0, 1)], float)
    chosen, prior = _chosen(seen.sum(0), n.sum(0))
    if not len(chosen):
        return SeverityModel(np.zeros(FEATURES, np.float32), np.full(GRADES, 50.0))
    lists = [_chosen(seen[f], n[f]) for f in (0, 1)]
    row, feature, count = hits(np.unique(np.concatenate([chosen, lists[0][0], lists[1][0]])))
    grade = _graded(fold, toxic, row, feature, count, lists)
    place = np.full(FEATURES, -1)
    place[chosen] = np.arange(len(chosen))
    own = place[feature] >= 0
    w, cuts = _trained(grade, row[own], place[feature[own]], np.log1p(count[own]), prior, rounds)
    weights = np.zeros(FEATURES, np.float32)
    weights[chosen] = w
    share = min(max(share, 1e-6), 1 - 1e-6)
    return SeverityModel(weights, cuts, float(np.log(LEAN / (1 - LEAN)) - np.log(share / (1 - share))))


def fit(texts: list[str], toxic: list[int], rounds: int = 150) -> SeverityModel:
    """Fits the model on labelled texts in memory, as fit_on_labels() does on tables; folds by turns."""
    alike: dict[bytes, np.ndarray] = {}
    for text, label in zip(texts, toxic, strict=True):
        data = np.frombuffer((text or "").encode(), np.uint8)
        alike.setdefault(_near_key(label, data), data)
    parts = [_distinct(x) for x in alike.values()]
    label = np.array([k[0] for k in alike], int)
    fold = np.arange(len(parts)) % 2
    seen = np.zeros((2, 2, FEATURES))
    for f, c, (which, _) in zip(fold, label, parts, strict=True):
        seen[f, c, which] += 1

    def hits(wanted: np.ndarray):
        row = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
        feature, count = (np.concatenate([p[i] for p in parts]).astype(np.int64) for i in (0, 1))
        keep = np.isin(feature, wanted)
        return row[keep], feature[keep], count[keep]

    return _model(seen, fold, label, hits, rounds, float(np.mean(toxic)) if len(toxic) else 0.0)


def sample_of_labels(labels: DataFrame, column: str, rows_a_class: int) -> DataFrame:
    """(_id, column): about rows_a_class labels of each class (0, 1), all if there aren't more: those whose hashed id lies in
    the share of the hash space that should hold as many. Ids with several labels count with the greatest; nulls are left out."""
    known = labels.filter(F.col(column).isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.max(F.col(column).cast("int")).alias(column))
    known = known.filter(F.col(column).isin(0, 1))
    size = {r[column]: r["count"] for r in known.groupBy(column).count().collect()}
    share = lambda c: F.lit(min(1.0, rows_a_class / max(1, size.get(c, 0))))
    place = (F.shiftrightunsigned(F.xxhash64("_id", F.lit(29)), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    return known.filter(place <= F.when(F.col(column) == 1, share(1)).otherwise(share(0)))


def fit_on_labels(docs: DataFrame, labels: DataFrame, rows_a_class: int = ROWS_A_CLASS, rounds: int = 150) -> SeverityModel:
    """Fits the model on about rows_a_class labelled documents of each class (sample_of_labels).

    Labels are 0 or 1; grade 0 is label 0. Toxic documents are graded 1 to GRADES by thirds, in order of the evidence of
    tell-tale features chosen on the other half of the sample: the cuts above the first carry that order, not a label.
    Texts become features in the tasks; the driver gets counts by feature, at most FEATURES, and the few
    features of each text that were chosen. Near copies count once, and of rows that repeat an id the least text. Empty and null
    texts have no features. Without labelled documents of both classes the model calls nothing toxic.
    """
    spark = docs.sparkSession
    chosen = sample_of_labels(labels, "toxic", rows_a_class)
    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(F.broadcast(chosen), "_id")
    rows = rows.groupBy("_id", "toxic").agg(F.min("text").alias("text"))  # an id's rows are reduced where they lie, however many

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            texts = [data[s:e] for _, s, e in pieces(offsets)]
            parts = [_distinct(x) for x in texts]
            binary = lambda found: pa.array(found, pa.binary())
            keys = binary([_near_key(c, x) for c, x in zip(batch.column(2).to_pylist(), texts, strict=True)])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), keys, *[binary([p[i].tobytes() for p in parts]) for i in (0, 1)]], ["_id", "toxic", "key", "features", "counts"])

    found = stored(rows.select("_id", "text", "toxic").mapInArrow(extract, "_id long, toxic int, key binary, features binary, counts binary"))
    first = found.groupBy("key").agg(F.min("_id").alias("_id"))
    found = stored(found.join(F.broadcast(first), ["key", "_id"]).dropDuplicates(["key"]).withColumn("fold", F.pmod(F.xxhash64("_id", F.lit(31)), F.lit(2)).cast("int")))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((4, FEATURES), np.int32)
        for batch in batches:
            for kind, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen[kind, np.frombuffer(raw, "<u4")] += 1
        kind, feature = np.nonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(feature), pa.array(seen[kind, feature].astype(np.int64))], ["kind", "feature", "n"])

    counts = found.select((2 * F.col("fold") + F.col("toxic")).alias("kind"), "features").mapInArrow(counted, "kind long, feature long, n long")
    by = counts.groupBy("feature").agg(*[F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(0)).alias(f"n{k}") for k in range(4)])
    by = by.filter((F.col("n1") + F.col("n3") > 1) & (F.col("n0") + F.col("n1") + F.col("n2") + F.col("n3") >= LEAST_DOCS)).toPandas()
    seen = np.zeros((4, FEATURES))
    seen[:, by["feature"].to_numpy()] = by[[f"n{k}" for k in range(4)]].to_numpy().T

    texts = found.select("_id", "fold", "toxic").orderBy("_id", "toxic").toPandas()

    def hits(wanted: np.ndarray):
        shared = spark.sparkContext.broadcast(wanted)

        def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i, label, which, count in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                    which, count = np.frombuffer(which, "<u4"), np.frombuffer(count, "<u2")
                    keep = np.isin(which, shared.value)
                    n = int(keep.sum())
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(n, i)), pa.array(np.full(n, label)), pa.array(which[keep].astype(np.int64)), pa.array(count[keep].astype(np.int64))], ["_id", "toxic", "feature", "n"])

        got = found.select("_id", "toxic", "features", "counts").mapInArrow(pick, "_id long, toxic long, feature long, n long").orderBy("_id", "toxic", "feature").toPandas()
        shared.destroy()
        place = {k: n for n, k in enumerate(zip(texts["_id"], texts["toxic"], strict=True))}
        row = np.array([place[k] for k in zip(got["_id"], got["toxic"], strict=True)], np.int64)
        return row, got["feature"].to_numpy(np.int64), got["n"].to_numpy(np.int64)

    share = labels.filter(F.col("toxic").isin(0, 1)).agg(F.avg("toxic")).first()[0] or 0.0
    return _model(seen.reshape(2, 2, FEATURES), *(texts[c].to_numpy(np.int64) for c in ("fold", "toxic")), hits, rounds, share)


def score_severity(docs: DataFrame, model: SeverityModel) -> DataFrame:
    """docs with toxic_chance, severity (expected grade, 0 to GRADES) and toxic added; columns of these names are replaced.

    Chance and severity are those at the labelled share of toxic texts (SeverityModel); toxic is decided on the leaning chance,
    where just 0.5 is toxic, so that a text may be called toxic at a chance below one half. Null and empty texts have no
    features and are not toxic; rows that repeat a text get
    one and the same score. Texts are read whole, each alone. The model (1 MB) is broadcast; nothing is shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("chance double, severity double, toxic boolean")
    def run(text: pa.Array) -> pa.Array:
        data, offsets = text_buffers(text)
        rows = [shared.value.chances(features(data[s:e])) for _, s, e in pieces(offsets)]
        table = np.array(rows).reshape(len(rows), GRADES)
        likely = shared.value.likely(table)
        return pa.StructArray.from_arrays([pa.array(likely[:, 0]), pa.array(likely.sum(1)), pa.array(table[:, 0] >= 0.5)], ["chance", "severity", "toxic"])

    names = [c for c in docs.columns if c not in ("toxic_chance", "severity", "toxic")]
    scored = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), run(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("_scored"))
    return scored.select("_row.*", F.col("_scored.chance").alias("toxic_chance"), F.col("_scored.severity").alias("severity"), F.col("_scored.toxic").alias("toxic"))


def without_toxic(docs: DataFrame, model: SeverityModel) -> DataFrame:
    """The rows of docs that aren't toxic, columns as given."""
    names = docs.columns
    tagged = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), "text")
    return score_severity(tagged, model).filter("not toxic").select("_row.*")
