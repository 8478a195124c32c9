"""Lempel-Ziv phrase fingerprints: the set of dictionary phrases of a text, as minimum-hash signatures."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandwise.llm.common import slice_hashes

#: Minima in a signature, each the least hash of its share of the phrase hashes; 16 bits of each are kept.
MINIMA = 128
#: Rows of a range of ids, about, where there are more of them than shuffle partitions times this.
ROWS_A_PART = 20_000
_EMPTY = 0xFFFF


def phrases(text: str, known: dict[str, None] | None = None, begun: str = "") -> tuple[dict[str, None], str]:
    """Parses text into dictionary phrases: each is the shortest run that isn't yet a phrase. Returns the phrases in order
    and the unfinished rest. known and begun carry a parse on."""
    found, now = {} if known is None else known, begun
    for c in text:
        now += c
        if now not in found:
            found[now] = None
            now = ""
    return found, now


def phrase_hashes(found: dict[str, None], rest: str = "") -> np.ndarray:
    """64-bit hashes of phrases; the unfinished rest, itself a phrase met before, adds nothing unless it is all there is."""
    parts = list(found) or ([rest] if rest else [])
    if not parts:
        return np.zeros(0, np.uint64)
    codes = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))
    return slice_hashes(codes, ends - np.fromiter(map(len, parts), np.int64, len(parts)), ends)


def signature(hashes: np.ndarray) -> np.ndarray:
    """MINIMA values of 16 bits: in each share of the hash space the least hash; 65535 where the share is empty."""
    out = np.full(MINIMA, 1 << 32, np.int64)
    np.minimum.at(out, (hashes % np.uint64(MINIMA)).astype(np.int64), (hashes >> np.uint64(32)).astype(np.int64))
    low = out * 0x9E3779B1 >> 7 & 0xFFFF  # 16 mixed bits of the minimum
    return np.where(out == 1 << 32, _EMPTY, np.minimum(low, _EMPTY - 1)).astype(np.uint16)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated Jaccard similarity of two phrase sets, 0 to 1; two empty texts are alike, an empty and another one not."""
    used = (a != _EMPTY) | (b != _EMPTY)
    return float(((a == b) & used).sum() / used.sum()) if used.any() else 1.0


def _hex(x: np.ndarray) -> str:
    return x.astype(">u2").tobytes().hex()


def fingerprint(text: str | None) -> str:
    """Hexadecimal signature of one text; null: empty."""
    return _hex(signature(phrase_hashes(*phrases(text or ""))))


def fingerprints(docs: DataFrame) -> DataFrame:
    """docs with fingerprint added (a column of that name is replaced). Equal texts have equal fingerprints, the empty and
    the null text too. Nothing is shuffled."""
    out = docs.drop("fingerprint")

    @F.pandas_udf("string")
    def run(text):
        return text.map(fingerprint)

    return out.withColumn("fingerprint", run(F.coalesce(F.col("text").cast("string"), F.lit(""))))


def with_next(docs: DataFrame, parts: int) -> DataFrame:
    """docs (doc_id, text) dealt into ranges of doc_id, with the first row of the following range (of the first, after the
    last) in each range too: columns part, tail, doc_id, text, sorted within Spark's partitions.

    Range borders are ids of the table, from a quantile sketch; the texts are shuffled once, a range to a Spark partition.
    Null ids come before all others.
    """
    place = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    found = docs.select(place.alias("k")).agg(F.percentile_approx("k", [i / parts for i in range(parts)], 10_000).alias("q"), F.min("k").alias("least")).first()
    borders = sorted({found.least, *(found.q or [])} - {None}) or [0]
    border = F.array(*[F.lit(b).cast("long") for b in borders])
    own = F.greatest(F.lit(0), F.aggregate(border, F.lit(-1), lambda n, b: n + (place >= b).cast("int")))
    at = F.array_position(border, place).cast("int")  # 1-based; 0: not a border
    before = F.when(at == 1, F.lit(len(borders) - 1)).when(at > 1, at - 2)
    places = F.when(at > 0, F.array(F.struct(own.alias("part"), F.lit(0).alias("tail")), F.struct(before.alias("part"), F.lit(1).alias("tail")))).otherwise(F.array(F.struct(own.alias("part"), F.lit(0).alias("tail"))))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    dealt = rows.select(F.explode(places).alias("p"), "doc_id", "text").select("p.part", "p.tail", "doc_id", "text")
    return dealt.repartitionById(len(borders), "part").sortWithinPartitions("part", "tail", "doc_id", "text")


def edited_fingerprints(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) for every row of docs.

    The edited text has its last floor(n_chars / 4) code points replaced by the first as many (or all) of the next
    document in ascending doc_id; after the last comes the first, so a single document follows itself. Rows that share a
    doc_id follow each other by text. A null doc_id sorts before all others. Null texts are empty. The parse of the text
    is carried on from the cut for both versions, so the edited one costs a quarter more; a very long text is parsed whole,
    its phrases in one task's memory. Other columns, whatever their names, play no part.
    """
    import hashlib

    spark = docs.sparkSession
    parts = parts or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-docs.select("doc_id").count() // ROWS_A_PART), 1)
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

    def parsed(text: str):
        cut = len(text) - len(text) // 4
        found, rest = phrases(text[:cut])
        return cut, found, len(found), rest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key, rows = None, None, []

        def pair(a, b_text, b_sign):
            doc_id, text, cut, found, n, rest, sign = a
            fill = b_text[: len(text) - cut]
            found, last = phrases(fill, found, rest)
            edited = signature(phrase_hashes(found, last))
            whole = text[:cut] + fill
            rows.append((doc_id, len(text), hashlib.sha256(whole.encode("utf-8", "surrogatepass")).hexdigest(), _hex(sign), _hex(edited), likeness(sign, edited), likeness(sign, b_sign)))

        for batch in batches:
            for part, tail, doc_id, text in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if held is not None and key != part:
                    held = None
                cut, found, n, rest = parsed(text)
                found, last = phrases(text[cut:], found, rest)
                sign = signature(phrase_hashes(found, last))
                while len(found) > n:
                    found.popitem()
                if held is not None:
                    pair(held, text, sign)
                    held = None
                key = part
                if not tail:
                    held = (doc_id, text, cut, found, n, rest, sign)
                if len(rows) >= 2000:
                    yield _batch(rows)
                    rows.clear()
        yield _batch(rows)

    def _batch(rows):
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        names = [x.split()[0] for x in schema.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

    return with_next(docs, parts).mapInArrow(run, schema)
