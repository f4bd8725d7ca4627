"""Hard negatives by exact integer scores from a residue-number-system product (operator 13).

Vectors are made integers by floor(scale * x). Score matrices are not multiplied in
wide integers: for each of several small primes the balanced residues of both sides are
multiplied in float32 by BLAS, exactly, as a stretch of K_STEP products stays below
2**24; the residues of a score are put together by Chinese remaindering in balanced
mixed radix, which gives the signed score itself. The number of primes follows from the
measured largest component and length, so that their product exceeds every score's range.

Work is a grid of anchor blocks and row groups (the anchors are a stated query set):
every row goes once to each anchor block, and a task that holds one block streams the
group's rows in order of their ids and keeps only running best lists. The first pass
gives each anchor's positives, the second, with the score windows that these open, the
negatives; both end in a ranking of a few entries per anchor and row group.

Defined cases: rows with a null id, label or vector, or a null or non-finite component
take no part; neither do rows with a component so large that a score could leave 62 bits
(1.0e6 / sqrt(length / 64) for a scale of 256), as no long can hold what they mean. Rows
of different lengths are not compared; empty vectors score 0 with each other. Of rows
repeated under one id the one of smallest label, then length, then integers as bytes, counts. Ties go to the
smaller id. An empty table, or one without anchors, gives an empty result; other columns
are not read. Only the window of a positive with a score of 0 or more can hold negatives.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratum.llm.common import Scratch, partitions, table

#: The largest primes below 256. Two residues multiply to 125 * 125 at most.
PRIMES = (251, 241, 239, 233, 229, 227, 223, 211, 199, 197, 193, 191)
K_STEP = 256  # products added in float32 before they are reduced: 256 * 125 * 125 < 2**22
SCALE, POSITIVES, NEGATIVES, LOW, HIGH = 256, 5, 10, 30, 90
ANCHOR_BLOCK, ROW_GROUP, LEAST_GROUP, STEP = 4096, 1 << 16, 1024, 512
SCORE_BITS = 62


def primes_for(bound: int) -> tuple[int, ...]:
    """As many primes as make every integer of magnitude up to ``bound`` distinct."""
    product = 1
    for k, p in enumerate(PRIMES, 1):
        product *= p
        if product > 2 * bound:
            return PRIMES[:k]
    raise ValueError(f"scores up to {bound} need more primes")


def _balanced(x: np.ndarray, p: int) -> np.ndarray:
    """Residues of float32 integers below 2**22 in -(p - 1) / 2 .. (p - 1) / 2: the second step mends a quotient rounded wrongly at a half."""
    scale = np.float32(1 / p)
    for _ in range(2):
        x = x - np.float32(p) * np.rint(x * scale)
    return x


def residues(values: np.ndarray, primes: tuple[int, ...]) -> list[np.ndarray]:
    """Balanced residues of an integer matrix, as float32."""
    out = []
    for p in primes:
        r = np.mod(values, p)
        out.append(np.where(r > p // 2, r - p, r).astype(np.float32))
    return out


def exact_scores(a: list[np.ndarray], b: list[np.ndarray], primes: tuple[int, ...]) -> np.ndarray:
    """Inner products (rows of ``a`` with rows of ``b``) as int64, from the residues of both."""
    digits: list[np.ndarray] = []
    score = np.zeros((len(a[0]), len(b[0])), np.int64)
    weight = 1
    for k, p in enumerate(primes):
        r = np.zeros(score.shape, np.float32)
        for at in range(0, a[k].shape[1], K_STEP):
            r = _balanced(r + _balanced(a[k][:, at:at + K_STEP] @ b[k][:, at:at + K_STEP].T, p), p)
        for q, digit in zip(primes, digits):  # mixed radix: what the digits before leave, divided by their primes
            r = _balanced((r - digit) * np.float32(pow(q, -1, p)), p)
        digits.append(r)
        # weights wrap around at 64 bits, and so does the sum, whose value fits
        score += r.astype(np.int64) * np.array(weight % (1 << 64), np.uint64).astype(np.int64)
        weight *= p
    return score


class Best:
    """The first ``k`` entries of each slot, by score from high to low, then id; ids come in ascending order."""

    def __init__(self, slots: int, k: int):
        self.k = k
        self.cut = np.full(slots, np.iinfo(np.int64).min)  # an entry must exceed it once a slot is full
        self.slot, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))

    def offer(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(slot):
            return
        touched = np.zeros(len(self.cut), bool)
        touched[slot] = True
        old = touched[self.slot]
        s, v, i = (np.concatenate([x[old], y]) for x, y in ((self.slot, slot), (self.score, score), (self.id, ids)))
        order = np.lexsort((i, -v, s))
        s, v, i = s[order], v[order], i[order]
        first = np.flatnonzero(np.r_[True, s[1:] != s[:-1]])
        rank = np.arange(len(s)) - np.repeat(first, np.diff(np.r_[first, len(s)]))
        keep = rank < self.k
        last = rank == self.k - 1
        self.cut[s[last]] = v[last]
        self.slot, self.score, self.id = (np.concatenate([x[~old], y[keep]]) for x, y in ((self.slot, s), (self.score, v), (self.id, i)))


def _integers(limit: int, scale: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, tops, values = [], [], []
            for v in batch.column("v"):
                x = None
                if v.is_valid and not v.values.null_count:
                    x = np.floor(scale * v.values.to_numpy(zero_copy_only=False).astype(np.float64))
                    top = np.abs(x).max(initial=0)
                    if not (np.isfinite(top) and top <= min((1 << 31) - 1, math.isqrt((1 << limit) // max(1, len(x))))):
                        x = None
                dims.append(-1 if x is None else len(x))
                tops.append(0 if x is None else int(top))
                values.append(None if x is None else x.astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), batch.column("anchor"), pa.array(dims, pa.int32()),
                                              pa.array(tops, pa.int64()), pa.array(values, pa.binary())], names=["id", "label", "anchor", "dim", "top", "v"])
    return make


def _matrix(column, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int32).reshape(len(column), dim)


def _cells(batches: Iterator[pa.RecordBatch], scan) -> Iterator[pa.RecordBatch]:
    """Run ``scan(dim, anchors)`` over every cell: first its anchors, as one table, then ``send`` pieces of its rows.

    Rows come ordered by cell, then anchors before others, then id."""
    cell, anchors, active = None, [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = list(zip(*(batch.column(c).to_pylist() for c in ("dim", "block", "part", "role")), strict=True))
        cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
        for lo, hi in zip(cuts, cuts[1:]):
            piece, (*place, role) = batch.slice(lo, hi - lo), keys[lo]
            if place != cell:
                if active:
                    yield from active.result()
                cell, anchors, active = place, [], None
            if role == 0:
                anchors.append(piece)
                continue
            if active is None and anchors:
                active = scan(place[0], pa.Table.from_batches(anchors))
            for at in range(0, piece.num_rows, STEP):
                if active:
                    active.rows(piece.slice(at, STEP))
    if active:
        yield from active.result()


class _Scan:
    """Scores of one anchor block against streamed rows."""

    def __init__(self, primes: tuple[int, ...], dim: int, anchors: pa.Table):
        self.primes, self.dim = primes, dim
        self.ids, self.labels = (np.asarray(anchors.column(c)) for c in ("id", "label"))
        self.residues = residues(_matrix(anchors.column("v"), dim), primes)

    def scores(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids, labels = np.asarray(batch.column("id")), np.asarray(batch.column("label"))
        return ids, self.labels[:, None] == labels[None, :], exact_scores(self.residues, residues(_matrix(batch.column("v"), self.dim), self.primes), self.primes)


class _Positives(_Scan):
    def __init__(self, primes, k, dim, anchors):
        super().__init__(primes, dim, anchors)
        self.best = Best(len(self.ids), k)

    def rows(self, batch: pa.RecordBatch) -> None:
        ids, same, score = self.scores(batch)
        slot, col = np.nonzero(same & (self.ids[:, None] != ids[None, :]) & (score > self.best.cut[:, None]))
        self.best.offer(slot, score[slot, col], ids[col])

    def result(self) -> Iterator[pa.RecordBatch]:
        b = self.best
        yield pa.RecordBatch.from_arrays([pa.array(self.ids[b.slot]), pa.array(b.id), pa.array(b.score)], names=["anchor_id", "positive_id", "positive_score"])


class _Negatives(_Scan):
    def __init__(self, primes, k, low, high, dim, anchors):
        super().__init__(primes, dim, anchors)
        lists = anchors.column("positives").to_pylist()
        self.count = max(len(x) for x in lists)
        shape = (len(lists), self.count)
        self.positive, self.score = np.zeros(shape, np.int64), np.zeros(shape, np.int64)
        self.low, self.high = np.ones(shape, np.int64), np.zeros(shape, np.int64)  # no window
        for i, row in enumerate(lists):
            for j, p in enumerate(row):
                score = p["positive_score"]
                self.positive[i, j], self.score[i, j] = p["positive_id"], score
                self.low[i, j], self.high[i, j] = -(-low * score // 100), high * score // 100
        self.best = Best(shape[0] * shape[1], k)

    def rows(self, batch: pa.RecordBatch) -> None:
        ids, same, score = self.scores(batch)
        other = ~same
        cut = self.best.cut.reshape(-1, self.count)
        found = []
        for j in range(self.count):
            slot, col = np.nonzero(other & (score >= self.low[:, j, None]) & (score <= self.high[:, j, None]) & (score > cut[:, j, None]))
            found.append((slot * self.count + j, score[slot, col], ids[col]))
        self.best.offer(*(np.concatenate(x) for x in zip(*found)))

    def result(self) -> Iterator[pa.RecordBatch]:
        b = self.best
        i, j = b.slot // self.count, b.slot % self.count
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (self.ids[i], self.positive[i, j], b.id, self.score[i, j], b.score)],
                                         names=["anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"])


def hard_negatives(rows: DataFrame, anchor: Column, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding",
                   scale: int = SCALE, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for every anchor (a condition on
    ``rows``) its first ``positives`` other rows of the same label, and for each of these the first ``negatives`` rows
    of another label whose score lies within ``low`` and ``high`` hundredths of the positive's."""
    spark = rows.sparkSession
    scratch = Scratch(spark, "negatives")
    taken = rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                        F.coalesce(anchor, F.lit(False)).alias("anchor"), F.col(vector_col).cast("array<double>").alias("v"))
    made = (taken.where("id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")
            .mapInArrow(_integers(SCORE_BITS, scale), "id long, label long, anchor boolean, dim int, top long, v binary").where("dim >= 0"))
    made = scratch.write(made.groupBy("id").agg(F.min(F.struct("label", "dim", "v", "anchor", "top")).alias("r")).select("id", "r.*"), "integers")
    seen = made.agg(F.count(F.lit(1)).alias("n"), F.count_if("anchor").alias("anchors"), F.max("top").alias("top"), F.max("dim").alias("dim")).first()
    primes = primes_for(max(1, (seen.top or 0) ** 2 * (seen.dim or 0)))
    group = max(LEAST_GROUP, min(ROW_GROUP, -(-seen.n // partitions(spark))))
    parts, blocks = max(1, -(-seen.n // group)), max(1, -(-seen.anchors // ANCHOR_BLOCK))

    def grid(anchors: DataFrame) -> DataFrame:
        """Rows and anchors of each cell, in order; ``anchors`` may carry positives."""
        extra = [F.lit(None).cast(t).alias(c) for c, t in anchors.dtypes if c == "positives"]
        cells = anchors.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")).withColumn("role", F.lit(0))
        cells = cells.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        others = (made.select("id", "label", "dim", "v", *extra).withColumn("part", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(parts)).cast("int"))
                  .withColumn("role", F.lit(1)).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))
        key = ["dim", "block", "part"]
        return cells.unionByName(others).repartition(max(partitions(spark), parts * blocks), *key).sortWithinPartitions(*key, "role", "id")

    anchors = made.where("anchor").select("id", "label", "dim", "v")
    found = scratch.write(grid(anchors).mapInArrow(
        lambda b: _cells(b, lambda dim, t: _Positives(primes, positives, dim, t)), "anchor_id long, positive_id long, positive_score long"), "positives")
    place = F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id"))
    best = found.withColumn("place", place).where(F.col("place") <= positives)
    lists = best.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("place", "positive_id", "positive_score"))).alias("positives"))
    asking = scratch.write(anchors.join(lists.withColumnRenamed("anchor_id", "id"), "id"), "asking")
    found = scratch.write(grid(asking).mapInArrow(
        lambda b: _cells(b, lambda dim, t: _Negatives(primes, negatives, low, high, dim, t)),
        "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long"), "negatives")
    rank = F.row_number().over(Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id"))
    return (found.withColumn("rank", rank).where(F.col("rank") <= negatives)
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", F.expr(
        "IF(vec_id % 7 = 0, (CAST(label AS BIGINT) + 1) % 10, CAST(label AS BIGINT))").alias("label"))
    return hard_negatives(rows, F.col("vec_id") % 100 == 0)


def oracle_sql() -> str:
    """The same in DuckDB SQL: all scores of the anchors by integer products."""
    return f"""
    WITH v AS MATERIALIZED (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label,
               list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS e
        FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    score AS MATERIALIZED (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
               coalesce(list_sum(list_transform(range(1, len(a.e) + 1), lambda i: a.e[i] * b.e[i])), 0)::BIGINT AS s
        FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)),
    pos AS (SELECT anchor_id, other AS positive_id, s AS positive_score FROM score WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY s DESC, other) <= {POSITIVES}),
    neg AS (SELECT pos.*, other AS negative_id, s AS negative_score, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s DESC, other) AS rank
            FROM pos JOIN score USING (anchor_id) WHERE NOT same AND {LOW} * positive_score <= 100 * s AND 100 * s <= {HIGH} * positive_score)
    SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM neg WHERE rank <= {NEGATIVES}
    """
