"""Embedding near-dedup by NN-descent (operator 2).

Equal vectors are one class, represented by its smallest id, so copies cost a count.
On the classes a neighbour graph is grown: first lists come from random-hyperplane
leaves, then each round joins, around every vector, its neighbours and the vectors
that have it as neighbour, compares pairs of which one is new, and keeps every
vector's best K (neighbours of neighbours become neighbours). Rounds end when few
lists change, apart from those full of near entries, which are compared whole in any case. A list whose last entry is still similar enough is saturated: it is
enlarged and refined again; components that hold lists saturated at any time are then
compared whole, in pairs of blocks, of which only counts leave the tasks.
The tables of leaves grow with the number of hyperplanes, so that a pair at the threshold
meets in one with the same chance at any size. Two samples of rows, of all vectors and of
those with links, are compared with all rows (audit); while the recall of links, averaged
per vector, is below the goal in one of them, leaves with new hyperplanes are added and
the descent goes on, and in the end the operator fails rather than return less.

What a leaf or a join sees near the threshold also goes, apart from the capped lists, into
a table of bridges: per group, the sets of members that hang together. Components are
taken over links and bridges, so a list that is full of its own group hides no way to another.

Lists are refined on half-precision copies; every link that is kept has been computed
in double precision, or is a bridge above the threshold by more than the margin. Leaves and
hubs over the limit are compared in pairs of blocks.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components have no links; vectors of different lengths are never linked; a null id is
left out; of rows repeated under one id the one with the smallest digest counts; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratum.llm.common import Scratch, components, groups, partitions, table

THRESHOLD = 0.95
MARGIN = 0.004  # of half-precision cosines
NEIGHBOURS, ENLARGED = 10, 30
LEAF, LEAF_TABLES = 64, 8  # tables at least
CONTACT = 0.995  # chance that a pair at the threshold shares a leaf
HUB = 96  # members of one block
SETTLED = 0.02  # changed entries per vector at which a descent ends
ROUNDS = 8  # of one descent
BLOCK = 256
AUDIT_ROWS, AUDIT_GOAL, AUDITS = 1024, 0.995, 3


def _prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        digests, dims, units = [], [], []
        for v in batch.column("v"):
            x = None
            if v.is_valid and len(v.values):
                x = v.values.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0
                top = np.abs(x).max()
                x = x if np.isfinite(top) and top > 0 else None
            if x is None:
                digests.append(""), dims.append(0), units.append(None)
                continue
            digests.append(xxhash.xxh3_128_hexdigest(x.tobytes()))
            dims.append(len(x))
            x = x / top
            units.append((x / np.linalg.norm(x)).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(digests, pa.string()), pa.array(dims, pa.int32()),
                                          pa.array(units, pa.binary())], names=["id", "digest", "dim", "u"])


def _matrix(column, dtype) -> np.ndarray:
    """Equal-length binary values as a matrix."""
    return np.stack([np.frombuffer(x, dtype) for x in column.to_pylist()])


def _half(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        q = [np.frombuffer(u, np.float64).astype(np.float16).tobytes() for u in b.column("u").to_pylist()]
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(q, pa.binary())], names=[*b.schema.names, "q"])


def _emit(rows: list[tuple[np.ndarray, np.ndarray, np.ndarray, bool]]) -> pa.RecordBatch:
    a, b, s = (np.concatenate(x) for x in zip(*[r[:3] for r in rows]))
    bridge = np.repeat([r[3] for r in rows], [len(r[0]) for r in rows])
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(s.astype(np.float32)), pa.array(bridge)], names=["src", "dst", "sim", "bridge"])


def _batched(chunks: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    rows, n = [], 0
    for chunk in chunks:
        rows.append(chunk)
        n += len(chunk[0])
        if n >= 50_000:
            yield _emit(rows)
            rows, n = [], 0
    if rows:
        yield _emit(rows)


def _to_compare(g: pa.Table) -> np.ndarray:
    """Which pairs of a group are compared: all pairs of one block, or those between two blocks."""
    if g.column("cross")[0].as_py():
        side = g.column("side").to_numpy()
        return side[:, None] != side[None, :]
    return ~np.eye(g.num_rows, dtype=bool)


SURE = 2.0  # sim of a bridge that needs no check


def _bridges(ids: np.ndarray, sims: np.ndarray, may: np.ndarray) -> Iterator[tuple]:
    """What a group tells about components, apart from the capped lists: its members that hang together by
    pairs above the margin, each with the first of them, and the pairs inside the margin between such sets."""
    near = may & (sims >= THRESHOLD - MARGIN)
    if not near.any():
        return
    sure = near & (sims >= THRESHOLD + MARGIN)
    first = np.arange(len(ids))
    for i in np.flatnonzero(sure.any(axis=1)).tolist():
        if first[i] != i:
            continue
        reached, size = sure[i].copy(), 0
        reached[i] = True
        while reached.sum() > size:
            size = reached.sum()
            reached |= sure[reached].any(axis=0)
        first[reached] = i
    tied = np.flatnonzero(first != np.arange(len(ids)))
    if len(tied):
        yield ids[first[tied]], ids[tied], np.full(len(tied), SURE), True
    a, b = np.nonzero(np.triu(near & (first[:, None] != first[None, :]), 1))
    if len(a):
        yield ids[a], ids[b], sims[a, b], True


def _leaf_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each member's best neighbours inside its leaf, and the leaf's bridges; of two blocks, and in
    the tables over the first LEAF_TABLES, only near neighbours."""
    def chunks():
        for g in groups(batches, "grp"):
            n = g.num_rows
            if n < 2:
                continue
            ids = g.column("id").to_numpy()
            q = _matrix(g.column("q"), np.float16).astype(np.float32)
            may = _to_compare(g)
            sims = np.where(may, q @ q.T, np.float32(-2))
            k = min(NEIGHBOURS, n - 1)
            best = np.argpartition(-sims, k - 1, axis=1)[:, :k]
            s = np.take_along_axis(sims, best, 1).ravel()
            keep = s >= (THRESHOLD - MARGIN if g.column("cross")[0].as_py() or g.column("later")[0].as_py() else -1.5)
            yield np.repeat(ids, k)[keep], ids[best].ravel()[keep], s[keep], False
            yield from _bridges(ids, sims, may)

    yield from _batched(chunks())


def _local_join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs around one vector of which one member is new: what a list gains by them, and bridges."""
    def chunks():
        for g in groups(batches, "grp"):
            fresh = g.column("fresh").to_numpy(zero_copy_only=False).astype(bool)
            if g.num_rows < 2 or not fresh.any():
                continue
            ids, low = g.column("id").to_numpy(), g.column("low").to_numpy()
            q = _matrix(g.column("q"), np.float16).astype(np.float32)
            may = _to_compare(g) & (fresh[:, None] | fresh[None, :])
            sims = np.where(may, q @ q.T, np.float32(-3))
            gain = sims > np.maximum(low, np.float32(-2.5))[:, None]
            if gain.sum(axis=1).max() > ENLARGED:  # no list holds more
                best = np.argpartition(-sims, ENLARGED - 1, axis=1)[:, :ENLARGED]
                top = np.zeros_like(gain)
                np.put_along_axis(top, best, True, axis=1)
                gain &= top
            a, b = np.nonzero(gain)
            if len(a):
                yield ids[a], ids[b], sims[a, b], False
            yield from _bridges(ids, sims, may)

    yield from _batched(chunks())


def _grouped(df: DataFrame, fn, schema: str, *key: str) -> DataFrame:
    keyed = df.withColumn("grp", F.xxhash64(*key)).drop(*[k for k in key if k != "id"])
    return keyed.repartition(partitions(df.sparkSession), "grp").sortWithinPartitions("grp").mapInArrow(fn, schema)


def _blocks(df: DataFrame, key: str, limit: int) -> DataFrame:
    """Groups of ``key`` over ``limit`` rows fall into blocks by a hash of the id, and every pair of blocks
    (``lo``, ``hi``) becomes a group, so that all pairs of the whole group are compared."""
    large = df.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / limit).alias("_blocks")).where("_blocks > 1")
    sided = (df.join(large, key, "left").withColumn("_blocks", F.coalesce("_blocks", F.lit(1)).cast("long"))
             .withColumn("side", F.pmod(F.xxhash64("id"), F.col("_blocks")))
             .withColumn("_other", F.explode(F.expr("sequence(CAST(0 AS BIGINT), _blocks - 1)"))))
    return (sided.withColumn("lo", F.least("side", "_other")).withColumn("hi", F.greatest("side", "_other"))
            .withColumn("cross", F.col("lo") != F.col("hi")).drop("_blocks", "_other"))


LISTS = "src long, dst long, sim float, bridge boolean"


def _tables(bits: int) -> int:
    """Tables of ``bits`` hyperplanes in which a pair at the threshold shares a leaf with chance CONTACT."""
    met = (1 - math.acos(THRESHOLD) / math.pi) ** bits
    return LEAF_TABLES if met == 1 else max(LEAF_TABLES, math.ceil(math.log(1 - CONTACT) / math.log(1 - met)))


def _leaves(scratch: Scratch, vectors: DataFrame, n: int, seed: int) -> DataFrame:
    """First lists and bridges from leaves of random hyperplanes."""
    bits = max(0, math.ceil(math.log2(max(1, n) / LEAF)))
    tables = _tables(bits)

    def codes(batches):
        planes: dict[int, np.ndarray] = {}
        for b in batches:
            ids, leaves, later = [], [], []
            for i, u in zip(b.column("id").to_pylist(), b.column("u").to_pylist(), strict=True):
                x = np.frombuffer(u, np.float64)
                d = len(x)
                if d not in planes:
                    planes[d] = np.random.default_rng((seed, d)).standard_normal((tables * bits, d))
                signs = np.packbits((planes[d] @ x > 0).reshape(tables, bits), axis=1)
                ids += [i] * tables
                leaves += [xxhash.xxh3_64_intdigest(f"{seed}:{d}:{t}:".encode() + signs[t].tobytes()) - (1 << 63) for t in range(tables)]
                later += [t >= LEAF_TABLES for t in range(tables)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(leaves, pa.int64()), pa.array(later, pa.bool_())], names=["id", "leaf", "later"])

    coded = scratch.write(vectors.select("id", "u").mapInArrow(codes, "id long, leaf long, later boolean"), "codes")
    placed = _blocks(coded, "leaf", 4 * LEAF).join(vectors.select("id", "q"), "id")
    return _grouped(placed, _leaf_lists, LISTS, "leaf", "lo", "hi")


def _apart(scratch: Scratch, found: DataFrame, bridges: list[DataFrame]) -> DataFrame:
    """List entries of what a join found; its bridges are added to ``bridges``."""
    found = scratch.write(found, "found")
    bridges.append(found.where("bridge").select("src", "dst", "sim"))
    return found.where("NOT bridge").drop("bridge")


def _best(lists: DataFrame, wide: DataFrame | None) -> DataFrame:
    """Keep each vector's best entries; ``wide`` has the ids whose lists are enlarged."""
    once = lists.groupBy("src", "dst").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"))
    ranked = once.withColumn("_rank", F.row_number().over(Window.partitionBy("src").orderBy(F.desc("sim"), "dst")))
    if wide is None:
        return ranked.where(F.col("_rank") <= NEIGHBOURS).drop("_rank")
    return (ranked.where(F.col("_rank") <= ENLARGED).join(wide.select(F.col("id").alias("src"), F.lit(True).alias("_wide")), "src", "left")
            .where((F.col("_rank") <= NEIGHBOURS) | F.col("_wide")).drop("_rank", "_wide"))


def _descend(scratch: Scratch, lists: DataFrame, vectors: DataFrame, n: int, wide: DataFrame | None, bridges: list[DataFrame]) -> DataFrame:
    """Rounds of neighbours-of-neighbours joins until few lists change."""
    for round_ in range(ROUNDS):
        held = lists.groupBy("src").agg(F.count(F.lit(1)).alias("_c"), F.min("sim").alias("_low"))
        room = F.lit(NEIGHBOURS)
        if wide is not None:
            held = held.join(wide.select(F.col("id").alias("src"), F.lit(True).alias("_wide")), "src", "left")
            room = F.when(F.col("_wide"), ENLARGED).otherwise(NEIGHBOURS)
        low = held.select(F.col("src").alias("id"), F.when(F.col("_c") >= room, F.col("_low")).otherwise(F.lit(-2.0)).cast("float").alias("low"))
        nodes = vectors.select("id", "q").join(low, "id")
        around = (lists.select(F.col("src").alias("center"), F.col("dst").alias("id"), "fresh")
                  .unionByName(lists.select(F.col("dst").alias("center"), F.col("src").alias("id"), "fresh"))
                  .groupBy("center", "id").agg(F.max("fresh").alias("fresh")))
        live = around.where("fresh").select("center").distinct()
        members = _blocks(around.join(live, "center", "left_semi"), "center", HUB)
        found = _apart(scratch, _grouped(members.join(nodes, "id"), _local_join, LISTS, "center", "lo", "hi"), bridges)
        merged = lists.withColumn("fresh", F.lit(False)).unionByName(found.withColumn("fresh", F.lit(True)))
        after = scratch.write(_best(merged, wide), f"lists-{round_}")
        scratch.drop(lists)
        lists = after
        changed = lists.where("fresh").join(_full(lists).withColumnRenamed("id", "src"), "src", "left_anti").count()
        if changed <= SETTLED * n:
            break
    return lists


def _full(lists: DataFrame) -> DataFrame:
    """Ids of the lists that hold NEIGHBOURS near entries or more."""
    return (lists.where(F.col("sim") >= THRESHOLD - MARGIN).groupBy("src").agg(F.count(F.lit(1)).alias("c"))
            .where(F.col("c") >= NEIGHBOURS).select(F.col("src").alias("id")))


def _dots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        dots = [float(np.frombuffer(x, np.float64) @ np.frombuffer(y, np.float64))
                for x, y in zip(b.column("ua").to_pylist(), b.column("ub").to_pylist(), strict=True)]
        keep = np.array(dots) >= THRESHOLD
        yield pa.RecordBatch.from_arrays([b.column(c).filter(pa.array(keep)) for c in ("a", "b")], names=["a", "b"])


def _links(scratch: Scratch, lists: DataFrame, vectors: DataFrame) -> DataFrame:
    """Entries that are links in double precision: (a < b) once each."""
    near = (lists.where(F.col("sim") >= THRESHOLD - MARGIN)
            .select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).distinct())
    full = (near.join(vectors.select(F.col("id").alias("a"), F.col("u").alias("ua")), "a")
            .join(vectors.select(F.col("id").alias("b"), F.col("u").alias("ub")), "b"))
    return scratch.write(full.select("a", "b", "ua", "ub").mapInArrow(_dots, "a long, b long"), "links")


def _block_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per member of a pair of blocks: the vectors of the other block it links with."""
    for g in groups(batches, "grp"):
        ids, side = g.column("id").to_numpy(), g.column("side").to_numpy()
        size = g.column("size").to_numpy().astype(np.float64)
        u = _matrix(g.column("u"), np.float64)
        linked = u @ u.T >= THRESHOLD
        np.fill_diagonal(linked, False)
        if g.column("hi")[0].as_py() != g.column("lo")[0].as_py():
            linked &= side[:, None] != side[None, :]
        n = linked @ size
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n.astype(np.int64))], names=["id", "n"])


def _whole_components(scratch: Scratch, placed: DataFrame, vectors: DataFrame, saturated: DataFrame) -> DataFrame:
    """Link counts (id, n) of all members of the components that hold saturated lists, by pairs of blocks."""
    wanted = placed.join(saturated, "id", "left_semi").select("component").distinct()
    members = placed.join(wanted, "component", "left_semi")
    sizes = members.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    rows = (members.join(sizes, "component").withColumn("side", F.pmod(F.xxhash64("id"), F.col("blocks")))
            .join(vectors.select("id", "u", "size"), "id")
            .withColumn("other", F.explode(F.expr("sequence(CAST(0 AS BIGINT), blocks - 1)")))
            .withColumn("lo", F.least("side", "other")).withColumn("hi", F.greatest("side", "other")))
    keyed = rows.select("id", "size", "u", "side", "lo", "hi", F.xxhash64("component", "lo", "hi").alias("grp"))
    counts = (keyed.repartition(partitions(rows.sparkSession), "grp").sortWithinPartitions("grp")
              .mapInArrow(_block_counts, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")))
    return scratch.write(counts, "block-counts")


def _audit(vectors: DataFrame, counts: DataFrame, n: int) -> float:
    """Share of a vector's links, found by comparing it with all rows, that ``counts`` has: the mean over the vectors
    with links in a bounded sample of all, or in one of the vectors known to have links if that is less."""
    linked = counts.where("n > 0").select("id")
    rows, samples = [], []
    for of, m in ((vectors, n), (vectors.join(linked, "id", "left_semi"), linked.count())):
        step = max(1, m // AUDIT_ROWS)
        part = of.where(F.pmod(F.xxhash64("id", F.lit(7)), F.lit(step)) == 0).select("id", "dim", "u").orderBy("id").limit(2 * AUDIT_ROWS).collect()
        known = {i for s in samples for i in s}
        rows += [r for r in part if r.id not in known]
        samples.append({r.id for r in part})
    by_dim: dict[int, tuple[list[int], np.ndarray]] = {}
    for dim in {r.dim for r in rows}:
        own = [r for r in rows if r.dim == dim]
        by_dim[dim] = ([r.id for r in own], np.stack([np.frombuffer(r.u, np.float64) for r in own]))

    def compare(batches):
        total: dict[int, int] = {}
        for b in batches:
            dims, ids = np.asarray(b.column("dim")), np.asarray(b.column("id"))
            size, us = np.asarray(b.column("size")), b.column("u")
            for dim, (queries, q) in by_dim.items():
                at = np.flatnonzero(dims == dim)
                for i in range(0, len(at), 2048):
                    part = at[i:i + 2048]
                    linked = q @ _matrix(us.take(pa.array(part)), np.float64).T >= THRESHOLD
                    linked &= np.array(queries)[:, None] != ids[part][None, :]
                    for j, c in zip(queries, (linked @ size[part]).tolist(), strict=True):
                        total[j] = total.get(j, 0) + int(c)
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], names=["id", "n"])

    true = vectors.select("id", "dim", "size", "u").mapInArrow(compare, "id long, n long").groupBy("id").agg(F.sum("n").alias("t"))
    held = true.where("t > 0").join(counts, "id", "left").select("id", (F.least("t", F.coalesce("n", F.lit(0))) / F.col("t")).alias("share")).collect()
    shares = [[r.share for r in held if r.id in s] for s in samples]
    return min((sum(s) / len(s) for s in shares if s), default=1.0)


def near_vectors(table_: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per id: n_links, component_id, audit_recall (mean share of a sampled vector's links that were found)."""
    spark = table_.sparkSession
    scratch = Scratch(spark, "nn-descent")
    raw = table_.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where("id IS NOT NULL")
    rows = scratch.write(raw.mapInArrow(_prepare, "id long, digest string, dim int, u binary")
                         .groupBy("id").agg(F.min(F.struct("digest", "dim", "u")).alias("r")).select("id", "r.*"), "rows")
    classes = rows.where("dim > 0").groupBy("digest").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("size"),
                                                         F.first("dim").alias("dim"), F.first("u").alias("u"))
    vectors = scratch.write(classes.select("id", "size", "dim", "digest", "u")
                            .mapInArrow(_half, "id long, size long, dim int, digest string, u binary, q binary"), "vectors")
    n = vectors.count()

    lists = None
    bridges: list[DataFrame] = []
    recall = 1.0
    for attempt in range(AUDITS):
        first = _apart(scratch, _leaves(scratch, vectors, n, 101 + attempt), bridges).withColumn("fresh", F.lit(True))
        if lists is not None:
            first = first.unionByName(lists.withColumn("fresh", F.lit(False)))
        lists = scratch.write(_best(first, None), "lists")
        lists = _descend(scratch, lists, vectors, n, None, bridges)
        wide = scratch.write(_full(lists), "saturated")
        if not wide.isEmpty():
            again = lists.join(wide.select(F.col("id").alias("src"), F.lit(True).alias("_wide")), "src", "left")
            lists = scratch.write(again.withColumn("fresh", F.coalesce("_wide", F.lit(False))).drop("_wide"), "lists")
            lists = _descend(scratch, lists, vectors, n, wide, bridges)
        links = _links(scratch, lists, vectors)
        spans = scratch.write(reduce(DataFrame.unionByName, bridges).distinct(), "bridges")
        bridges = [spans]
        checked = _links(scratch, spans.where(F.col("sim") < SURE), vectors)
        tied = spans.where(F.col("sim") == SURE).select(F.col("src").alias("a"), F.col("dst").alias("b"))
        placed = scratch.write(components(scratch, links.unionByName(checked).unionByName(tied)), "components")
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        listed = both.join(vectors.select(F.col("id").alias("b"), "size"), "b").groupBy(F.col("a").alias("id")).agg(F.sum("size").alias("n"))
        # a list that was full once has lost entries, and others may have filled up since
        whole = _whole_components(scratch, placed, vectors, wide.unionByName(_full(lists)))
        counts = scratch.write(listed.join(whole, "id", "left_anti").unionByName(whole.select("id", "n")), "counts")
        recall = _audit(vectors, counts, n)
        if recall >= AUDIT_GOAL:
            break
    else:
        raise RuntimeError(f"near_vectors: recall of links {recall:.4f} is below {AUDIT_GOAL} after {AUDITS} descents")
    of_class = (vectors.select("id", "digest", "size").join(placed, "id", "left").join(counts, "id", "left")
                .select("digest", (F.col("size") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("component", "id").alias("component")))
    return (rows.select("id", "digest").join(of_class, "digest", "left")
            .select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component", "id").alias("component_id"), F.lit(float(recall)).alias("audit_recall")))


def op2_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return out.select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))


def oracle_sql() -> str:
    """The same result in DuckDB SQL, from the cosines of all pairs."""
    return f"""
    WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
    u AS (SELECT vec_id, e, sqrt(list_inner_product(e, e)) AS norm FROM v
          WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
              WHERE a.norm > 0 AND b.norm > 0 AND list_inner_product(a.e, b.e) / (a.norm * b.norm) >= {THRESHOLD}),
    reach(id, root) AS (SELECT vec_id, vec_id FROM v UNION SELECT links.b, reach.root FROM reach JOIN links ON links.a = reach.id),
    n AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
    SELECT v.vec_id, coalesce(any_value(n.n), 0) AS n_links, min(root) AS component_id, v.vec_id = min(root) AS kept
    FROM v JOIN reach ON reach.id = v.vec_id LEFT JOIN n ON n.vec_id = v.vec_id GROUP BY v.vec_id
    """
