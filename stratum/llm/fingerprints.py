"""Document fingerprints by content-defined chunking (operator 1).

A gear hash rolls over the UTF-8 bytes; a chunk ends where its top bits are zero.
Chunking is normalised: more zero bits are asked for before the normal size and
fewer after it, which narrows the spread of chunk sizes. Boundaries follow content,
so text that is moved keeps its chunks. The fingerprint is the set of distinct chunk
digests, each with its length; the likeness of A to B is the share of A's chunk
bytes whose chunks B has too (weighted containment).

Defined cases: a null text is an empty one, with an empty fingerprint; an empty
fingerprint is fully contained in an empty one and not in any other. Texts are
processed whole whatever their length. Rows repeated under one id have a result each; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.common import partitions, slices, table, text_or_empty

MIN_CHUNK, NORMAL_CHUNK, MAX_CHUNK = 8, 32, 128
BITS_BEFORE, BITS_AFTER = 6, 4


def _gear_table(seed: int = 0x5EED) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 32, 256, dtype=np.uint32)


GEAR = _gear_table()


def gear_hash(data: np.ndarray) -> np.ndarray:
    """Gear hash at each byte over the 32 bytes up to it: sum of GEAR[byte at distance j] << j."""
    h = GEAR[data]
    for s in (1, 2, 4, 8, 16):  # windows of 2, 4, ... 32 by doubling
        if len(h) <= s:
            break
        wider = h.copy()
        wider[s:] += h[:-s] << np.uint32(s)
        h = wider
    return h


def chunk_ends(data: bytes) -> list[int]:
    """End offsets of the chunks of ``data``, in order; empty for no bytes."""
    n = len(data)
    if not n:
        return []
    top = gear_hash(np.frombuffer(data, np.uint8))
    loose = np.flatnonzero(top < np.uint32(1 << (32 - BITS_AFTER)))
    strict = (loose[top[loose] < np.uint32(1 << (32 - BITS_BEFORE))] + 1).tolist()
    loose = (loose + 1).tolist()
    strict.append(n + MAX_CHUNK)
    loose.append(n + MAX_CHUNK)
    ends, start = [], 0
    while n - start > MIN_CHUNK:
        normal, last = start + NORMAL_CHUNK, start + MAX_CHUNK
        end = strict[bisect_left(strict, start + MIN_CHUNK)]
        if end >= normal:
            end = min(loose[bisect_left(loose, normal)], last)
        if end >= n:
            break
        ends.append(end)
        start = end
    ends.append(n)
    return ends


def chunk_set(data: bytes) -> np.ndarray:
    """Sorted distinct chunks of ``data``: 48 bits of digest, then 8 bits of length."""
    ends = chunk_ends(data)
    keys, start, digest = [], 0, xxhash.xxh3_64_intdigest
    for end in ends:
        keys.append((digest(data[start:end]) >> 16 << 8) | (end - start))
        start = end
    return np.unique(np.array(keys, dtype=np.uint64))


def encode_set(chunks: np.ndarray) -> str:
    """The set as text: 7 bytes a chunk, in base64."""
    raw = chunks.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 1:].tobytes()
    return base64.b64encode(raw).decode()


def decode_set(fingerprint: str) -> np.ndarray:
    raw = np.frombuffer(base64.b64decode(fingerprint), np.uint8).reshape(-1, 7)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, 1:] = raw
    return out.view(">u8").reshape(-1).astype(np.uint64)


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Share of A's distinct chunk bytes whose chunks are in B; for an empty A: 1 if B is empty, else 0."""
    if not len(a):
        return 1.0 if not len(b) else 0.0
    weight = (a & np.uint64(255)).astype(np.float64)
    return float(weight[np.isin(a, b, assume_unique=True)].sum() / weight.sum())


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col``, n_chars, fingerprint. Other columns are not read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = batch.column("text").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array([encode_set(chunk_set(t.encode())) for t in texts], pa.string())],
                names=["id", "n_chars", "fingerprint"])

    src = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    return src.mapInArrow(run, "id long, n_chars long, fingerprint string").withColumnRenamed("id", id_col)


def _range_of(bounds: list[int], lo: int, hi: int) -> str:
    """SQL for the number of bounds at or above ``k``, as a balanced tree of comparisons."""
    if lo == hi:
        return str(lo)
    mid = (lo + hi) // 2  # bounds fall: bounds[mid] >= k means at least mid + 1 of them
    return f"IF(k <= {bounds[mid]}, {_range_of(bounds, mid + 1, hi)}, {_range_of(bounds, lo, mid)})"


def pair_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (part, guard, k, text) so that a task that reads a ``part`` in order sees each document
    right before the next one in descending id order (after the last: the first).

    The ids are cut into ranges at approximate quantiles; each range's first
    document also goes, as a guard, behind the range before it. So texts move once,
    and no task has more than its ranges. Null ids come last; equal ids are
    ordered by a hash of their text.
    """
    spark = docs.sparkSession
    lowest = -(1 << 63)
    base = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(lowest)).alias("k"),
                       text_or_empty(text_col).alias("text"))
    n = 4 * partitions(spark)
    row = base.select("k").agg(F.percentile_approx("k", [i / n for i in range(1, n)], 20 * n).alias("q")).first()
    bounds = sorted(set(row.q or []), reverse=True)
    part = F.expr(_range_of(bounds, 0, len(bounds)))
    # one row per range: as many as four times the shuffle partitions
    heads = {r.part: r.k for r in base.select("k", part.alias("part")).groupBy("part").agg(F.max("k").alias("k")).collect()}
    order = sorted(heads)
    before = {p: order[i - 1] for i, p in enumerate(order)}
    rows = base.select(part.alias("part"), F.lit(0).alias("guard"), "k", "text")
    if order:
        to = {heads[p]: before[p] for p in order}
        guards = base.where(F.col("k").isin(list(to)))
        lookup = F.create_map(*[F.lit(x) for kv in to.items() for x in kv])
        rows = rows.unionByName(guards.select(lookup[F.col("k")].cast("int").alias("part"), F.lit(1).alias("guard"), "k", "text"))
    return (rows.repartition(partitions(spark), "part")
            .sortWithinPartitions("part", "guard", F.desc("k"), F.xxhash64("text")))


def _compare_with_edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["k", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    held = None  # the last document: part, k, text, chunks
    for batch in slices(batches, "text"):
        out = []
        for part, guard, k, text in zip(*(batch.column(c).to_pylist() for c in ("part", "guard", "k", "text")), strict=True):
            chunks = chunk_set(text.encode())
            if held and held[0] == part:
                _, own_k, own, own_set = held
                cut = len(own) // 3
                edited = (own[:len(own) - cut] + text[:cut]).encode()
                edited_set = chunk_set(edited)
                out.append((own_k, len(own), hashlib.sha256(edited).hexdigest(), encode_set(own_set),
                            encode_set(edited_set), containment(own_set, edited_set), containment(own_set, chunks)))
            held = None if guard else (part, k, text, chunks)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 7, types)], names=names)


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited form, whose last third is replaced by the next
    document's start, with the likeness to the edited text and to the next document."""
    out = pair_with_next(docs, id_col, text_col).mapInArrow(
        _compare_with_edits, "k long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double")
    return out.withColumn("k", F.when(F.col("k") != F.lit(-(1 << 63)), F.col("k"))).withColumnRenamed("k", id_col)


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(table(spark, sf_dir, "documents"))
