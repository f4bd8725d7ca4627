"""Benchmark decontamination by a prefix-filtered set join (operator 12), in DataFrame functions only.

An item is cut into windows of ``window`` consecutive words (a shorter item is one
window); a window is the set of its shingles of up to ``SHINGLE`` words. A document
holds a window only if it holds all its shingles, so the prefix that a join needs is the
window's first shingle in the order of rarity over all documents.

1. One pass over the documents writes where they hold shingles of items (hash and
   position, no words). Their counts are the order of rarity.
2. Each distinct window gets its rarest shingle; the written places are joined with these
   prefixes. The place of the shingle in the window fixes where the window would start;
   starts before the document are dropped.
3. A second pass meets each document with its candidates: the end bound is applied, and
   the words at each place are compared with the window's. The occurrences are intervals
   of words, folded in order of their start to count every word hit once.
4. Windows found become items by a join on the window.

What is broadcast (the items' shingles and prefixes) is measured first and lies below
BROADCAST_BYTES; beyond that the same joins are shuffles of hashes and positions. Texts are
moved once, to their candidates. Hashes only propose; what counts is the comparison of words.

Defined cases: null and empty texts have no words and are never hit; an item without
words has no window; an item with a null id marks words but is not listed or counted;
rows repeated under one id or without one are told apart by their texts, and equal rows
have equal results; other columns are not read, and ``keep`` may name any; without items
every document is clean; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.common import Scratch, table, text_or_empty

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Letters beside A-Z that lower-casing may change, or that are too new to tell.
OTHER_CAPITALS = r"[[\p{javaUpperCase}\p{javaTitleCase}\p{Cn}]&&[^\x00-\x7F]]"
WINDOW, SHINGLE = 10, 3
BROADCAST_BYTES = 16 << 20


def words_of(text_col: str = "text") -> Column:
    """The words of a text, lower-cased (A-Z), as an array. ``lower`` is many times faster than ``translate``
    and serves all texts in which it can change nothing else."""
    text = text_or_empty(text_col)
    plain = (F.length(text) == F.octet_length(text)) | ~text.rlike(OTHER_CAPITALS)
    lowered = F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(lowered, SEPARATORS), "")


def _bound(body: str) -> str:
    """SQL: ``body``, in which ``w`` is the value of ``words``. As a lambda's variable it is computed once a row, while
    the optimizer may write out a column's whole expression at each place of use, also inside lambdas."""
    return f"element_at(transform(array(words), w -> {body}), 1)"


def _shingles(width: int) -> str:
    """SQL: hashes of the shingles of ``words`` of one width, by position; empty if there are fewer words."""
    parts = ", ".join(f"get(w, i + {j})" for j in range(width))
    return _bound(f"IF(size(w) < {width}, CAST(array() AS ARRAY<BIGINT>), transform(sequence(0, size(w) - {width}), i -> xxhash64({width}, {parts})))")


def item_windows(items: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(item, win, m, width, shingles): the distinct windows of each item, as text, their words and shingle hashes."""
    words = items.select(F.col(id_col).cast("string").alias("item"), words_of(text_col).alias("words")).where("size(words) > 0")
    sized = words.withColumn("m", F.least(F.size("words"), F.lit(window))).withColumn("width", F.least(F.lit(SHINGLE), "m"))
    cases = "CASE width " + " ".join(f"WHEN {w} THEN {_shingles(w)}" for w in range(1, SHINGLE + 1)) + " END"
    placed = sized.withColumn("hashes", F.expr(cases)).withColumn("first", F.explode(F.expr("sequence(0, size(words) - m)")))
    return placed.select("item", F.expr("concat_ws(' ', slice(words, first + 1, m))").alias("win"), "m", "width",
                         F.expr("slice(hashes, first + 1, m - width + 1)").alias("shingles")).distinct()


def prefixes_of(windows: DataFrame, rarity: DataFrame) -> DataFrame:
    """(hash, shift, m, win): for each distinct window its rarest shingle (ties: smallest hash, first place) and its place in it."""
    tokens = windows.select("win", "m", F.posexplode("shingles").alias("shift", "hash"))
    first = tokens.join(rarity, "hash", "left").groupBy("win", "m").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "hash", "shift")).alias("r"))
    return first.select("r.hash", "r.shift", "m", "win")


def candidates(scratch: Scratch, docs: DataFrame, windows: DataFrame, limit: int) -> DataFrame:
    """(key, found): for each key of ``docs`` (key, words) the windows whose prefixes it holds, with their starts."""
    widths = sorted(r.width for r in windows.select("width").distinct().collect())  # SHINGLE values at most
    near = lambda df, size: F.broadcast(df) if size <= limit else df
    wanted = scratch.write(windows.select(F.explode("shingles").alias("hash")).distinct(), "shingles")
    small = near(wanted, 8 * wanted.count())
    seen = docs.sparkSession.createDataFrame([], "key long, pos int, hash long")
    for width in widths:
        placed = docs.select("key", F.expr(_shingles(width)).alias("hashes")).select("key", F.posexplode("hashes").alias("pos", "hash"))
        seen = seen.unionByName(placed.join(small, "hash", "left_semi"))
    seen = scratch.write(seen, "seen")
    rarity = seen.groupBy("hash").agg(F.count(F.lit(1)).alias("n"))
    prefixes = scratch.write(prefixes_of(windows.select("win", "m", "shingles").distinct(), rarity), "prefixes")
    size = prefixes.agg(F.sum(F.octet_length("win") + 32)).first()[0] or 0
    met = seen.join(near(prefixes, size), "hash").where("pos >= shift").select("key", (F.col("pos") - F.col("shift")).alias("at"), "m", "win").distinct()
    return scratch.write(met.groupBy("key").agg(F.collect_list(F.struct("at", "m", "win")).alias("found")), "candidates")


def decontaminate(docs: DataFrame, items: DataFrame, keep: list[str], id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The ``keep`` columns of every row of ``docs``, then n_words, n_hit and items (sorted array of item ids as strings)."""
    scratch = Scratch(docs.sparkSession, "decontaminate")
    own = [F.col(c).alias(f"k{i}") for i, c in enumerate(keep)]
    text = text_or_empty(text_col)
    key = F.xxhash64(F.col(id_col).cast("string"), text)
    windows = scratch.write(item_windows(items, item_id, item_text, window), "windows")
    proposed = candidates(scratch, docs.select(key.alias("key"), words_of(text_col).alias("words")), windows, broadcast_bytes)
    rows = docs.select(*own, F.col(id_col).cast("string").alias("id"), key.alias("key"), text.alias("text"))
    met = rows.join(proposed.hint("merge"), "key", "left")  # grows with the documents, so it is never broadcast
    read = met.select(*[f"k{i}" for i in range(len(keep))], "id", "text", "found", words_of("text").alias("words"))
    held = _bound("named_struct('n', size(w), 'hits', filter(found, f -> f.at + f.m <= size(w) AND concat_ws(' ', slice(w, f.at + 1, f.m)) = f.win))")
    covered = ("aggregate(array_sort(coalesce(h.hits, array())), named_struct('n', 0L, 'reach', 0), (a, x) -> named_struct("
               "'n', a.n + greatest(0, x.at + x.m - greatest(x.at, a.reach)), 'reach', greatest(a.reach, x.at + x.m)), a -> a.n)")
    judge = (f"element_at(transform(array({held}), h -> named_struct('n_words', CAST(h.n AS BIGINT), 'n_hit', {covered}, "
             "'wins', array_distinct(transform(coalesce(h.hits, array()), x -> x.win)))), 1)")
    hit_key = F.concat(F.coalesce("id", F.lit("-")), F.lit(":"), F.md5(F.encode("text", "UTF-8"))).alias("hit_key")
    judged = scratch.write(read.select(*[f"k{i}" for i in range(len(keep))], hit_key, F.expr(judge).alias("r")), "judged")
    judged = judged.select(*[f"k{i}" for i in range(len(keep))], F.expr("IF(r.n_hit > 0, hit_key, NULL)").alias("hit_key"), "r.*")
    named = (judged.where("hit_key IS NOT NULL").select("hit_key", F.explode("wins").alias("win")).distinct()
             .join(windows.select("win", "item").distinct(), "win").groupBy("hit_key").agg(F.sort_array(F.collect_set("item")).alias("items")))
    named = scratch.write(named, "items")
    return judged.join(named, "hit_key", "left").select(
        *[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "n_words", "n_hit", F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("item_id", "text")
    return decontaminate(docs, items, ["doc_id"]).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def oracle_sql() -> str:
    """The same in DuckDB SQL: every window of every document compared with the items' windows as text."""
    words = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""
    WITH d AS MATERIALIZED (SELECT doc_id, {words} AS ws FROM documents),
    items AS (SELECT item_id, {words} AS ws FROM benchmark),
    sized AS (SELECT item_id, ws, least(len(ws), {WINDOW}) AS m FROM items WHERE len(ws) > 0),
    win AS MATERIALIZED (SELECT DISTINCT item_id, m, array_to_string(ws[i:i + m - 1], ' ') AS w
            FROM (SELECT item_id, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM sized)),
    sizes AS (SELECT DISTINCT m FROM win),
    places AS (SELECT doc_id, m, i, array_to_string(ws[i:i + m - 1], ' ') AS w
            FROM (SELECT doc_id, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM d, sizes WHERE len(ws) >= m)),
    hit AS MATERIALIZED (SELECT doc_id, item_id, i, m FROM places JOIN win USING (m, w)),
    n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM (SELECT DISTINCT doc_id, i, m FROM hit)) GROUP BY doc_id),
    ids AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, array_to_string(list_sort(list(DISTINCT item_id::VARCHAR)), ',') AS listed FROM hit GROUP BY doc_id)
    SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
           sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN n USING (doc_id) LEFT JOIN ids USING (doc_id)
    """
