"""MinHash near-dedup with tensored banding (operator 9).

A document's set holds its distinct 5-word shingles. Instead of hashing T bands of k
rows each, two small collections of T' half bands (k/2 rows) are computed and every
table key is a pair of half bands, one from each collection: 2 T' half bands give
T' * T' tables, so the minhash work falls to about a square root.

1. One pass over the texts gives set size, a 128-bit hash of the set and the minhash
   values; equal sets become one representative each, by a partial aggregate.
2. Tables: representatives meet in buckets of equal keys; buckets of one are dropped.
   Round one pairs every member with the bucket's smallest id only, so a bucket of m
   gives m - 1 pairs, and confirms the pairs on the full sets.
3. Round two looks at the buckets that still hold several components. Their members'
   full sets meet in blocks (groups of one half band, cut to BLOCK members and compared
   pair of blocks by pair of blocks); pairs of different components that share a table
   are compared there and only links leave the task. So nothing that the tables bring
   together stays unlooked at, connected members are not paired again, and no pair
   that is no link is written or shuffled. Work in one bucket grows with the square of
   its unconnected members, in tasks of bounded size.

Chance of a miss: two sets of similarity s meet with probability
(1 - (1 - s^2)^8)^2, 0.997 at s = 0.75 and 0.99995 at 0.85, before paths over others.

Defined cases: null or wordless texts are empty sets, linked with nothing; fewer words
than five are one shingle; a null id is not a document and is left out; of rows
repeated under one id the one with the smallest text hash stands for the id; an empty
table gives an empty result. Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.common import Scratch, components, groups, partitions, released, slices, table, text_or_empty

SHINGLE = 5
SIMILAR_NUM, SIMILAR_DEN = 75, 100
HALF_ROWS = 2  # minhashes of a half band
HALF_BANDS = 8  # half bands of each collection
MINHASHES = 2 * HALF_BANDS * HALF_ROWS
BLOCK = 1024  # members of a bucket that are compared at once
BLOCK_SHINGLES = 1 << 21  # and the shingles of their sets, about: 16 MB
SIEVE = 14  # of 32 packed 4-bit minhashes; 24.5 are expected to agree at similarity 0.75

_rng = np.random.default_rng(20240917)
_WORD_MIX = _rng.integers(1, 1 << 63, SHINGLE, dtype=np.uint64) | np.uint64(1)
_MULTIPLY = _rng.integers(1, 1 << 63, MINHASHES, dtype=np.uint64) | np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, MINHASHES, dtype=np.uint64)


def words_of(text: str) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased (bytes methods are ASCII only)."""
    return text.encode().lower().split()


def shingle_set(text: str) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of a whole text."""
    words = words_of(text)
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < SHINGLE:
        return np.array([xxhash.xxh3_64_intdigest(b"\x00" + b" ".join(words))], np.uint64)
    digest = xxhash.xxh3_64_intdigest
    hashes = np.array([digest(w) for w in words], np.uint64)
    n = len(hashes) - SHINGLE + 1
    mixed = np.zeros(n, np.uint64)
    for j in range(SHINGLE):
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + hashes[j:j + n] * _WORD_MIX[j]
    mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def minhashes(shingles: np.ndarray) -> np.ndarray:
    """Minhash values (32 bits each) of a non-empty set."""
    low = None
    for at in range(0, len(shingles), 4096):
        block = (shingles[None, at:at + 4096] * _MULTIPLY[:, None] + _ADD[:, None]).min(axis=1)
        low = block if low is None else np.minimum(low, block)
    return low >> np.uint64(32)


def _half_bands(values: np.ndarray) -> np.ndarray:
    """2 * HALF_BANDS half-band values: pairs of minhashes, as signed 64-bit integers."""
    return (values[0::2] << np.uint64(32) | values[1::2]).view(np.int64)


def _packed(values: np.ndarray) -> tuple[int, int]:
    """The 32 minhashes at 4 bits each, in two signed 64-bit integers."""
    nibbles = (values * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(60)).reshape(2, 16)
    return tuple(int(x) for x in (nibbles << np.arange(0, 64, 4, dtype=np.uint64)).sum(axis=1, dtype=np.uint64).view(np.int64))


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["id", "tid", "n", "set_hash", "bands", "p0", "p1"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.int64(), pa.int64()]
    for batch in slices(batches, "text"):
        out = []
        for key, tid, text in zip(*(batch.column(c).to_pylist() for c in ("id", "tid", "text")), strict=True):
            s = shingle_set(text)
            if not len(s):
                out.append((key, tid, 0, None, None, None, None))
                continue
            values = minhashes(s)
            out.append((key, tid, len(s), xxhash.xxh3_128_hexdigest(s.tobytes()), _half_bands(values).tolist(), *_packed(values)))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)


def _read_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        sets = [shingle_set(t).tobytes() for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sets, pa.binary())], names=["id", "s"])


def similar(x: int, y: int, both: int) -> bool:
    return SIMILAR_DEN * both >= SIMILAR_NUM * (x + y - both)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs with both full sets: those with 100 * intersection >= 75 * union."""
    for batch in batches:
        keep = []
        for sa, sb in zip(batch.column("sa"), batch.column("sb")):
            x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (sa, sb))
            keep.append(similar(len(x), len(y), len(np.intersect1d(x, y, assume_unique=True))))
        yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(keep, pa.bool_())) for c in ("a", "b")], names=["a", "b"])


def _compare_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Similar pairs of different components in one bucket, or between two blocks of it.

    A pair is looked at only in the bucket of the first half band that it shares, and
    only if it also shares one of the other collection: exactly the tables' candidates.
    """
    for g in groups(batches, "grp"):
        n, m = np.asarray(g.column("n")), g.num_rows
        ids, component, side = (np.asarray(g.column(c)) for c in ("id", "component", "side"))
        bands = np.array(g.column("bands").to_pylist(), np.int64)
        index = g.column("i")[0].as_py()
        wanted = component[:, None] != component[None, :]
        if g.column("lo")[0].as_py() != g.column("hi")[0].as_py():
            wanted &= side[:, None] != side[None, :]
        wanted &= SIMILAR_DEN * np.minimum(n[:, None], n[None, :]) >= SIMILAR_NUM * np.maximum(n[:, None], n[None, :])
        for j in range(index):
            wanted &= bands[:, None, j] != bands[None, :, j]
        shared = np.zeros((m, m), bool)
        for j in range(HALF_BANDS, 2 * HALF_BANDS):
            shared |= bands[:, None, j] == bands[None, :, j]
        wanted = np.triu(wanted & shared, 1)
        if not wanted.any():
            continue
        sets = [np.frombuffer(x, np.uint64) for x in g.column("s").to_pylist()]
        starts = np.cumsum([0, *map(len, sets)])
        codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
        mark = np.zeros(codes.max() + 1, np.int32)
        a_out, b_out = [], []
        for x in np.flatnonzero(wanted.any(axis=1)).tolist():
            others = np.flatnonzero(wanted[x])
            own = codes[starts[x]:starts[x + 1]]
            mark[own] = 1
            for y in others.tolist():
                if similar(n[x], n[y], int(mark[codes[starts[y]:starts[y + 1]]].sum())):
                    a_out.append(min(ids[x], ids[y]))
                    b_out.append(max(ids[x], ids[y]))
            mark[own] = 0
        yield pa.RecordBatch.from_arrays([pa.array(a_out, pa.int64()), pa.array(b_out, pa.int64())], names=["a", "b"])


def sieve(x: str, y: str) -> str:
    """SQL condition: set sizes allow the similarity, and enough packed minhashes agree."""
    agree = []
    for p in ("p0", "p1"):
        d = f"({x}.{p} ^ {y}.{p})"
        folded = f"({d} | shiftrightunsigned({d}, 2))"
        agree.append(f"bit_count(({folded} | shiftrightunsigned({folded}, 1)) & 1229782938247303441L)")  # 0x1111...
    return (f"{SIMILAR_DEN} * least({x}.n, {y}.n) >= {SIMILAR_NUM} * greatest({x}.n, {y}.n) "
            f"AND {MINHASHES} - {agree[0]} - {agree[1]} >= {SIEVE}")


def _across(scratch: Scratch, open_rows: DataFrame, reps: DataFrame, found: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) between components that still share buckets; ``open_rows`` (id, i) names the half
    bands to look at. Buckets are cut into blocks and compared block by block, so that hot ones spread over tasks."""
    rows = (open_rows.join(reps.select("id", "n", "bands"), "id").join(found, "id", "left")
            .withColumn("component", F.coalesce("component", "id")).withColumn("band", F.expr("get(bands, i)")))
    rows = scratch.write(rows, "open")
    blocks = rows.groupBy("i", "band").agg(F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("n") / BLOCK_SHINGLES)).alias("blocks"))
    placed = (rows.join(blocks, ["i", "band"]).join(sets, "id").withColumn("side", F.pmod(F.xxhash64("id"), F.col("blocks")))
              .withColumn("other", F.explode(F.expr("sequence(CAST(0 AS BIGINT), blocks - 1)")))
              .withColumn("lo", F.least("side", "other")).withColumn("hi", F.greatest("side", "other"))
              .withColumn("grp", F.xxhash64("i", "band", "lo", "hi")).select("grp", "i", "lo", "hi", "side", "id", "n", "component", "bands", "s"))
    grouped = placed.repartition(partitions(rows.sparkSession), "grp").sortWithinPartitions("grp")
    links = scratch.write(grouped.mapInArrow(released(_compare_blocks), "a long, b long"), "across")
    scratch.drop(rows)
    return links


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document id: id, n_shingles, component (smallest id reachable by links)."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "neardup")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text")).where("id IS NOT NULL")
    texts = texts.select("id", F.xxhash64("text").alias("tid"), "text")
    sketched = scratch.write(texts.mapInArrow(released(_sketch), "id long, tid long, n long, set_hash string, bands array<long>, p0 long, p1 long"), "sketch")
    rest = ["n", "set_hash", "bands", "p0", "p1"]
    single = sketched.groupBy("id").agg(F.min(F.struct("tid", *rest)).alias("r")).select("id", "r.*")
    single = scratch.write(single, "documents")
    scratch.drop(sketched)
    members = single.where("n > 0")
    # one representative per set: the smallest id; a hot set shrinks in the partial aggregate
    reps = scratch.write(members.groupBy("set_hash").agg(F.min(F.struct("id", "tid", "n", "bands", "p0", "p1")).alias("r"))
                         .select("set_hash", "r.*"), "representatives")
    half = HALF_BANDS
    keys = f"transform(sequence(0, {half * half - 1}), i -> xxhash64(i, get(bands, i div {half}), get(bands, {half} + i % {half})))"
    keyed = reps.select("id", F.posexplode(F.expr(keys)).alias("t", "key"))
    shared = keyed.groupBy("key").agg(F.min("id").alias("leader"), F.max("id").alias("top")).where("leader < top").select("key", "leader")
    tables = scratch.write(keyed.join(shared, "key"), "tables")
    wanted = tables.select("id").distinct().join(reps.select("id", "tid"), "id")
    sets = scratch.write(texts.join(wanted, ["id", "tid"], "left_semi").dropDuplicates(["id"]).select("id", "text")
                         .mapInArrow(released(_read_sets), "id long, s binary"), "sets")

    small = reps.select("id", "n", "p0", "p1")
    stars = (tables.where("id <> leader").select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct().alias("c")
             .join(small.alias("y"), F.expr("c.b = y.id")).join(small.alias("x"), F.expr("c.a = x.id AND " + sieve("x", "y"))).select("c.a", "c.b"))
    with_sets = (stars.join(sets.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b")
                 .join(sets.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a"))
    links = scratch.write(with_sets.select("a", "b", "sa", "sb").mapInArrow(released(_verify), "a long, b long"), "links")
    found = scratch.write(components(scratch, links), "first-components")

    placed = tables.select("id", "t", "key").join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    placed = scratch.write(placed, "placed")
    open_keys = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("key")
    open_rows = placed.join(open_keys, "key").select("id", F.expr(f"CAST(t div {half} AS INT)").alias("i")).distinct()
    more = _across(scratch, open_rows, reps, found, sets)
    # equal sets are links too
    copies = (members.select("id", "set_hash").join(reps.select("set_hash", F.col("id").alias("b")), "set_hash")
              .select(F.col("id").alias("a"), "b").where("a <> b"))
    joined = components(scratch, links.unionByName(more).unionByName(copies))
    scratch.drop(tables, placed, sets)
    return (single.select("id", "n").join(joined, "id", "left")
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id")))


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.withColumn("kept", F.col("doc_id") == F.col("component_id"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group. Of rows repeated under one id the one that was compared
    stays (smallest text hash; of equal texts the row that sorts first by a hash of all its columns and then
    by what it holds as JSON), if the id is kept; rows with a null id stay as they are. Columns pass through in a struct, under any names."""
    kept = near_duplicates(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "id", "text").where("id = component_id").select("id")
    own = F.col(id_col).cast("long")
    rows = docs.where(own.isNotNull()).select(own.alias("id"), F.xxhash64(text_or_empty(text_col)).alias("tid"), F.struct(*docs.columns).alias("row"))
    repeated = rows.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.min("tid").alias("tid"))  # ids and hashes only
    kept = kept.join(repeated, "id")
    single = rows.join(kept.where("n = 1").select("id"), "id", "left_semi").select("row.*")
    several = rows.join(kept.where("n > 1").select("id", "tid"), ["id", "tid"], "left_semi")
    first = several.groupBy("id").agg(F.min_by("row", F.struct(F.xxhash64("row"), F.to_json("row"))).alias("row")).select("row.*")
    return single.unionByName(first).unionByName(docs.where(own.isNull()))


def oracle_sql() -> str:
    """The same result in DuckDB SQL: exact set overlaps of all pairs that share a shingle."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
    WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
    sh AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + {SHINGLE - 1}], ' ') AS s
           FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - {SHINGLE - 1}, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
    n AS (SELECT w.doc_id, count(sh.s) AS n FROM w LEFT JOIN sh USING (doc_id) GROUP BY w.doc_id),
    pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
    links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE {SIMILAR_DEN} * shared >= {SIMILAR_NUM} * (x.n + y.n - shared)),
    steps AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reach(id, root) AS (SELECT doc_id, doc_id FROM n UNION SELECT steps.b, reach.root FROM reach JOIN steps ON steps.a = reach.id)
    SELECT n.doc_id, n.n AS n_shingles, min(root) AS component_id, n.doc_id = min(root) AS kept
    FROM n JOIN reach ON reach.id = n.doc_id GROUP BY n.doc_id, n.n
    """
