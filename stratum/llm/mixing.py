"""Mixing sources to target weights by Sainte-Laguë apportionment (operator 3).

Every source's share of the mix is paid out in blocks of equal token counts. The
blocks go to the sources by highest quotients target / (2k - 1), then each source's
blocks go to its shards in the same way, which gives every shard an integer quota.
Inside a shard the documents lie in a seeded order on one token line, cut into
blocks; a quota of q for n blocks takes every block q div n times and q mod n of
them once more, at a seeded offset and evenly spaced. All of it is DataFrame work.

``mix`` takes whole documents. A document's taken words make a fractional number of
copies; along the shard, from the longest document to the shortest, the running sum of
these is rounded, so that what one document gets too much the next ones get less. Of
STARTS places to begin rounding the one is used whose words come nearest to the quota.

Defined cases: a null text has no words; a null source is a source of its own, last
in order; a row with a null id is ordered by its text; repeated rows are rows of their
own; a source without words has target 0; an empty table gives an empty mix.
Columns beyond the three named ones are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratum.llm.common import Scratch, table, text_or_empty

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2
BLOCK = 64  # tokens of a block
SHARD_TOKENS = 1 << 18
STARTS = 32
SEED = "mix-1"


def word_count(text):
    """Words of ``text``: maximal runs without ASCII white space."""
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def apportion(parties: DataFrame, group: list[str], key: str, votes: str, seats: str) -> DataFrame:
    """Sainte-Laguë: add ``won``, the seats of each party among its group's ``seats``.

    With m parties, divisors for seats + m and seats - m seats bound the result from
    above and below, and the two bounds are at most 3 m seats apart in all; only the
    quotients between them are listed and ranked, ties by ``key``.
    """
    every = Window.partitionBy(*group) if group else Window.partitionBy()
    bounded = (parties
               .withColumn("_v", F.sum(votes).over(every)).withColumn("_m", F.count(F.lit(1)).over(every))
               .withColumn("_hi", F.when(F.col("_v") > 0, F.floor(F.col(votes) / (F.col("_v") / (F.col(seats) + F.col("_m"))) + 0.5)).otherwise(0).cast("long"))
               .withColumn("_lo", F.when((F.col("_v") > 0) & (F.col(seats) > F.col("_m")), F.floor(F.col(votes) / (F.col("_v") / (F.col(seats) - F.col("_m"))) + 0.5)).otherwise(0).cast("long"))
               .withColumn("_left", F.col(seats) - F.sum("_lo").over(every)))
    ranked = Window.partitionBy(*group).orderBy(F.desc("_quotient"), key)
    extra = (bounded.where("_hi > _lo").select(*group, key, "_left", F.col(votes).alias("_votes"), F.explode(F.sequence(F.col("_lo") + 1, F.col("_hi"))).alias("_k"))
             .withColumn("_quotient", F.col("_votes") / (2 * F.col("_k") - 1))
             .withColumn("_rank", F.row_number().over(ranked)).where("_rank <= _left")
             .groupBy(*group, key).agg(F.count(F.lit(1)).alias("_extra")))
    return (bounded.join(extra, [*group, key], "left")
            .withColumn("won", F.col("_lo") + F.coalesce("_extra", F.lit(0)))
            .drop("_v", "_m", "_hi", "_lo", "_left", "_extra"))


def targets(sizes: DataFrame) -> DataFrame:
    """Per source (source, source_size): its order ``no``, weight and target. The share is dealt by
    weight; a target stops at CAP times the size and the excess is dealt again by weight."""
    order = Window.orderBy(F.asc_nulls_last("source"))
    filled = Window.orderBy("_full", "no")
    every = Window.partitionBy()
    weights = F.array(*[F.lit(w) for w in WEIGHTS])
    return (sizes
            .withColumn("no", F.row_number().over(order).cast("long"))
            .withColumn("weight", F.element_at(weights, ((F.col("no") - 1) % len(WEIGHTS) + 1).cast("int")))
            .withColumn("_cap", (CAP * F.col("source_size")).cast("double"))
            .withColumn("_full", F.col("_cap") / F.col("weight"))
            .withColumn("_share", SHARE * F.sum("source_size").over(every))
            # the level at which water would stand if all sources that fill up earlier were full
            .withColumn("_rest", F.col("_share") - F.coalesce(F.sum("_cap").over(filled.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
            .withColumn("_dry", F.sum("weight").over(filled.rowsBetween(0, Window.unboundedFollowing)))
            .withColumn("_is_full", F.col("_rest") / F.col("_dry") > F.col("_full"))
            .withColumn("_level", (F.col("_share") - F.sum(F.when(F.col("_is_full"), F.col("_cap")).otherwise(0.0)).over(every))
                        / F.sum(F.when(F.col("_is_full"), 0).otherwise(F.col("weight"))).over(every))
            .withColumn("target", F.when(F.col("_is_full"), F.col("_cap")).otherwise(F.col("_level") * F.col("weight")))
            .select("source", "no", "source_size", "weight", "target", F.floor(F.col("_share") / BLOCK + 0.5).alias("seats")))


def _hash(*parts) -> F.Column:
    return F.md5(F.concat_ws(":", F.lit(SEED), *parts))


def _number(md5) -> F.Column:
    return F.conv(F.substring(md5, 1, 8), 16, 10).cast("long")


def _taken_before(x) -> F.Column:
    """Tokens before position ``x`` of the shard's line that lie in blocks taken once more."""
    block = F.expr(f"{x} div {BLOCK}")
    before = F.floor((block * F.col("_more") + F.col("_offset")) / F.col("_blocks"))
    after = F.floor(((block + 1) * F.col("_more") + F.col("_offset")) / F.col("_blocks"))
    return before * BLOCK + (after - before) * (F.col(x) - block * BLOCK)


def plan_mix(docs: DataFrame, scratch: Scratch, keep: list[str], source_col: str = "source", text_col: str = "text",
             id_col: str = "doc_id") -> DataFrame:
    """Per row: the ``keep`` columns (renamed ``k0``, ``k1``, ...), size, source_size, target, taken and
    ``copies``, the times that a mix of whole documents takes the row (0 without words).

    Targets and quotas are made from a written table of sizes. If the texts are kept, they are read
    again for the result and moved once, to their shard's line, but never written to scratch.
    """
    kept = [f"k{i}" for i in range(len(keep))]
    own = [F.col(c).alias(k) for c, k in zip(keep, kept, strict=True)]
    basic = [F.col(source_col).alias("source"), F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("~"), F.md5(F.encode(text_or_empty(text_col), "UTF-8")))).alias("id"),
             word_count(text_or_empty(text_col)).alias("size"), F.xxhash64(text_or_empty(text_col)).alias("tid")]
    slim = text_col not in keep
    sized = scratch.write(docs.select(*(own if slim else []), *basic), "sizes")
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    # a row per source; as a small written table it is broadcast only if its bytes are below Spark's threshold
    sources = apportion(targets(sizes), [], "no", "target", "seats").withColumn(
        "shards", F.greatest(F.lit(1), F.ceil(F.col("source_size") / SHARD_TOKENS)).cast("long"))
    sources = scratch.write(sources, "sources")

    def deal(rows: DataFrame, columns: list[str]) -> DataFrame:
        return (rows.withColumnRenamed("source", "_source").join(sources, F.col("_source").eqNullSafe(F.col("source")))
                .withColumn("_order", _hash("id")).withColumn("shard", _number(F.col("_order")) % F.col("shards"))
                .select(*columns, "size", "tid", "source_size", "target", "no", "shard", "_order", "won"))

    shards = (deal(sized, []).groupBy("no", "shard").agg(F.sum("size").alias("tokens"), F.first("won").alias("won"))
              .withColumn("_blocks", F.ceil(F.col("tokens") / BLOCK)))
    shards = shards.withColumn("quota", F.least("won", CAP * F.sum("_blocks").over(Window.partitionBy("no")))).drop("won")
    quotas = (apportion(shards, ["no"], "shard", "tokens", "quota")
              .withColumn("_quota", F.least("won", CAP * F.col("_blocks")))
              .withColumn("_blocks", F.greatest("_blocks", F.lit(1)))
              .withColumn("_times", F.expr("_quota div _blocks")).withColumn("_more", F.expr("_quota % _blocks"))
              .withColumn("_offset", _number(_hash("no", "shard")) % F.col("_blocks"))
              .select("no", "shard", "_blocks", "_times", "_more", "_offset"))
    quotas = scratch.write(quotas, "quotas")
    shard = Window.partitionBy("no", "shard")
    line = shard.orderBy("_order", "size", "tid").rowsBetween(Window.unboundedPreceding, 0)
    falling = shard.orderBy(F.desc("size"), "_order", "tid")
    before = F.coalesce(F.sum("_part").over(falling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    dealt = deal(sized if slim else docs.select(*own, *basic), kept)
    placed = (dealt.drop("won").withColumn("_end", F.sum("size").over(line)).withColumn("_start", F.col("_end") - F.col("size"))
              .join(quotas, ["no", "shard"])
              .withColumn("taken", (F.col("_times") * F.col("size") + _taken_before("_end") - _taken_before("_start")).cast("long"))
              .withColumn("_part", F.when(F.col("size") > 0, F.col("taken") / F.col("size")).otherwise(0.0))
              .withColumn("_before", before).withColumn("_after", F.sum("_part").over(falling.rowsBetween(Window.unboundedPreceding, 0))))
    rounded = [F.floor(F.col("_after") + k / STARTS) - F.floor(F.col("_before") + k / STARTS) for k in range(STARTS)]
    missed = F.array(*[F.abs(F.sum(F.col("size") * c).over(shard) - F.sum("taken").over(shard)) for c in rounded])
    return (placed.withColumn("_missed", missed).withColumn("_rounded", F.array(*rounded))
            .withColumn("copies", F.expr("_rounded[array_position(_missed, array_min(_missed)) - 1]").cast("int"))
            .select(*kept, "size", "source_size", "target", "taken", "copies"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = plan_mix(table(spark, sf_dir, "documents"), Scratch(spark, "op3"), ["doc_id"])
    return planned.select(F.col("k0").alias("doc_id"), "size", "source_size", "target", "taken")


def mix(docs: DataFrame) -> DataFrame:
    """The mix as rows of ``docs``, whole documents: each as often as its ``copies`` say."""
    columns = docs.columns
    planned = plan_mix(docs, Scratch(docs.sparkSession, "mix"), columns)
    times = planned.where("copies > 0").withColumn("_n", F.explode(F.array_repeat(F.lit(0), F.col("copies"))))
    return times.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(columns)])


def _apportion_sql(parties: str, group: str, key: str, votes: str, seats: str, tag: str) -> str:
    """CTEs ``won_<tag>``: the rows of ``parties`` with ``won``."""
    over = f"(PARTITION BY {group})" if group else "()"
    g = f"{group}, " if group else ""
    return f"""
    v_{tag} AS (SELECT *, sum({votes}) OVER {over} AS v_, count(*) OVER {over} AS m_ FROM {parties}),
    b_{tag} AS (SELECT *,
        CASE WHEN v_ > 0 THEN floor({votes} / (v_ / ({seats} + m_)::DOUBLE) + 0.5) ELSE 0 END::BIGINT AS hi_,
        CASE WHEN v_ > 0 AND {seats} > m_ THEN floor({votes} / (v_ / ({seats} - m_)::DOUBLE) + 0.5) ELSE 0 END::BIGINT AS lo_
        FROM v_{tag}),
    l_{tag} AS (SELECT *, {seats} - sum(lo_) OVER {over} AS left_ FROM b_{tag}),
    k_{tag} AS (SELECT {g}{key}, left_, {votes} AS votes_, unnest(range(lo_ + 1, hi_ + 1)) AS k_ FROM l_{tag}),
    r_{tag} AS (SELECT *, row_number() OVER (PARTITION BY {group or '1'} ORDER BY votes_ / (2 * k_ - 1)::DOUBLE DESC, {key}) AS rank_ FROM k_{tag}),
    e_{tag} AS (SELECT {g}{key}, count(*) AS extra_ FROM r_{tag} WHERE rank_ <= left_ GROUP BY {g}{key}),
    won_{tag} AS (SELECT l.* EXCLUDE (v_, m_, hi_, lo_, left_), lo_ + coalesce(extra_, 0) AS won
        FROM l_{tag} l LEFT JOIN e_{tag} USING ({g}{key}))"""


def oracle_sql() -> str:
    """The same mix in DuckDB SQL."""
    number = "CAST('0x' || substr({}, 1, 8) AS BIGINT)"
    before = "(floor(((({x} // {b}) * more_ + offset_) / blocks_::DOUBLE))::BIGINT)"
    after = "(floor((((({x} // {b}) + 1) * more_ + offset_) / blocks_::DOUBLE))::BIGINT)"
    taken = lambda x: (f"({before} * {BLOCK} + ({after} - {before}) * ({x} - ({x} // {BLOCK}) * {BLOCK}))").format(x=x, b=BLOCK)
    weights = f"[{', '.join(map(str, WEIGHTS))}]"
    return f"""
    WITH rows_ AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
                          md5('{SEED}:' || coalesce(doc_id::VARCHAR, '~' || md5(coalesce(text, '')))) AS ord FROM documents),
    sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM rows_ GROUP BY source),
    n AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS no FROM sizes),
    w AS (SELECT *, {weights}[((no - 1) % {len(WEIGHTS)} + 1)::INT] AS weight, ({CAP} * source_size)::DOUBLE AS cap_,
                 {SHARE}::DOUBLE * (sum(source_size) OVER ())::DOUBLE AS share_ FROM n),
    f AS (SELECT *, cap_ / weight::DOUBLE AS full_ FROM w),
    d AS (SELECT *, share_ - coalesce(sum(cap_) OVER (ORDER BY full_, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest_,
                 sum(weight) OVER (ORDER BY full_, no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS dry_ FROM f),
    i AS (SELECT *, rest_ / dry_::DOUBLE > full_ AS is_full FROM d),
    lv AS (SELECT *, (share_ - sum(CASE WHEN is_full THEN cap_ ELSE 0 END) OVER ()) / (sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER ())::DOUBLE AS level_ FROM i),
    t AS (SELECT source, no, source_size, CASE WHEN is_full THEN cap_ ELSE level_ * weight END AS target,
                 floor(share_ / {BLOCK} + 0.5)::BIGINT AS seats FROM lv),
    {_apportion_sql("t", "", "no", "target", "seats", "s")},
    src AS (SELECT *, greatest(1, ceil(source_size / {SHARD_TOKENS}::DOUBLE))::BIGINT AS shards FROM won_s),
    dealt AS (SELECT r.doc_id, r.size, r.ord, s.source_size, s.target, s.no, s.won, {number.format("r.ord")} % s.shards AS shard
              FROM rows_ r JOIN src s ON r.source IS NOT DISTINCT FROM s.source),
    sh AS (SELECT no, shard, sum(size)::BIGINT AS tokens, first(won) AS won, ceil(sum(size) / {BLOCK}::DOUBLE)::BIGINT AS blocks0 FROM dealt GROUP BY no, shard),
    q AS (SELECT no, shard, tokens, blocks0, least(won, {CAP} * sum(blocks0) OVER (PARTITION BY no))::BIGINT AS quota FROM sh),
    {_apportion_sql("q", "no", "shard", "tokens", "quota", "q")},
    b AS (SELECT no, shard, greatest(blocks0, 1) AS blocks_, least(won, {CAP} * blocks0)::BIGINT AS quota_,
                 {number.format(f"md5('{SEED}:' || no || ':' || shard)")} AS hash_ FROM won_q),
    z AS (SELECT no, shard, blocks_, quota_ // blocks_ AS times_, quota_ % blocks_ AS more_, hash_ % blocks_ AS offset_ FROM b),
    p AS (SELECT *, sum(size) OVER (PARTITION BY no, shard ORDER BY ord, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS end_ FROM dealt)
    SELECT doc_id, size, source_size, target, (times_ * size + {taken("end_")} - {taken("(end_ - size)")})::BIGINT AS taken
    FROM p JOIN z USING (no, shard)
    """
