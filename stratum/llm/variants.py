"""Spelling variants by a bit-sliced position index (operator 11).

The vocabulary counts the maximal letter runs of all texts. Two words are near if one
inserted, deleted or replaced code point makes one the other. Near words are found in
blocks of the vocabulary: for each position and letter a bitset says which words of the
block have that letter there. A query word walks over its letters once and carries
three bitsets over the block, all words at a time, 64 to a machine word:

    same  words that agree so far                      same' = same & at[p, q]
    sub   ... with one letter replaced                 sub'  = sub & at[p, q] | same & ~at[p, q]
    gap   ... that hold one letter more (shifted by 1) gap'  = gap & at[p + 1, q] | same'

All queries of a block walk together, so only the slices of two positions exist at once.

Blocks: with an edit in one half of the shorter word the other half stays as it is, so
near words share the length s of the shorter one and either its first s div 2 or its
last s - s div 2 letters. Every word goes to these groups (four rows: as the shorter and
as the longer word). Small groups fill a block together; a group above the block's size
is cut into parts that are compared in pairs of parts, so a hot prefix spreads over
tasks. Only near pairs leave a task.

A form is followed to its root by pointer doubling: counts grow by ``ratio`` with each
step, so log2 of the longest possible chain bounds the joins.

Defined cases: null and empty texts have no words; a null id is written as the empty
string in the deletion rule; repeated rows count as often as they stand; other columns
are not read; an empty table gives an empty result. Runs of any length are whole words
(blocks shrink as words get longer).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.common import Scratch, partitions, released, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LETTERS = "[A-Za-z\\x{C0}-\\x{FF}]"
MIN_LENGTH, MIN_COUNT, RATIO = 6, 5, 5
DELETE_EVERY = 199
BLOCK, BLOCK_LETTERS = 4096, 1 << 22  # words of a block, and their code points, at most


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
               min_count: int = MIN_COUNT, delete_every: int | None = DELETE_EVERY) -> DataFrame:
    """(word, n) of the texts' runs; with ``delete_every`` one code point is deleted where the run's checksum says so.
    Shorter runs cannot become words, so the pattern passes them over."""
    run = F.translate("run", UPPER, LOWER)
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all(F.col(text_col).cast("string"), F.lit(LETTERS + f"{{{min_length},}}"), F.lit(0))).alias("run"))
    words = runs.select("id", run.alias("word"))
    if delete_every:
        h = F.crc32(F.encode(F.concat("id", F.lit(":"), "word"), "UTF-8"))
        words = (words.withColumn("h", h).withColumn("at", (F.col("h") % F.length("word")).cast("int"))
                 .select(F.when(F.col("h") % delete_every == 0,
                                F.expr("concat(substring(word, 1, at), substring(word, at + 2))")).otherwise(F.col("word")).alias("word")))
    return (words.where(F.length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= min_count))


def _slices(codes: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Letters of one position, and the bitset of words for each (a last one, without words, for other letters)."""
    letters, which = np.unique(codes, return_inverse=True)
    bits = np.zeros((len(letters) + 1, words * 8), np.uint8)
    packed = np.packbits(which[None, :] == np.arange(len(letters))[:, None], axis=1, bitorder="little")
    bits[:-1, :packed.shape[1]] = packed
    return letters, bits.view(np.uint64)


def _at(slices: tuple[np.ndarray, np.ndarray], wanted: np.ndarray) -> np.ndarray:
    letters, bits = slices
    row = np.minimum(np.searchsorted(letters, wanted), len(letters) - 1)
    return bits[np.where(letters[row] == wanted, row, len(letters))]


def _members(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, bit number) of all set bits."""
    row, word = np.nonzero(bits)
    if not len(row):
        return row, word
    flags = np.unpackbits(bits[row, word].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    hit, bit = np.nonzero(flags)
    return row[hit], word[hit] * 64 + bit


def one_error(words: list[str], s: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For words of ``s`` and ``s + 1`` code points: (query, word, longer) of all pairs of a word of ``s`` code
    points and a word that one replaced or (longer) one more code point makes of it."""
    codes = np.array(words, dtype=f"U{s + 1}").view(np.uint32).reshape(len(words), s + 1)
    long = codes[:, s] != 0
    ask = np.flatnonzero(~long)
    queries, width = codes[ask], -(-len(words) // 64)
    same = np.zeros((len(ask), width * 8), np.uint8)
    same[:, :] = np.packbits(np.arange(width * 64) < len(words), bitorder="little")
    same = same.view(np.uint64)
    sub, gap = np.zeros_like(same), same.copy()
    here = _slices(codes[:, 0], width)
    for p in range(s):
        ahead = _slices(codes[:, p + 1], width)
        match = _at(here, queries[:, p])
        sub = (sub & match) | (same & ~match)
        same &= match
        gap = (gap & _at(ahead, queries[:, p])) | same
        here = ahead
    sized = np.zeros(width * 64, bool)
    sized[:len(words)] = long
    mask = np.packbits(sized, bitorder="little").view(np.uint64)
    a, b = _members(sub & ~mask)
    c, d = _members(gap & mask)
    return ask[np.concatenate([a, c])], np.concatenate([b, d]), np.concatenate([np.zeros(len(a), bool), np.ones(len(c), bool)])


_NEAR = pa.schema([("word", pa.string()), ("near", pa.string()), ("near_n", pa.int64())])


def _compare(units: np.ndarray, words: list[str], counts: list[int], parts: np.ndarray, across: np.ndarray, tail: bool, s: int) -> pa.RecordBatch:
    a, b, longer = one_error(words, s)
    keep = (units[a] == units[b]) & ~(across[a] & (parts[a] == parts[b]))
    half = s // 2
    out: tuple[list, list, list] = ([], [], [])
    for x, y, more in zip(a[keep].tolist(), b[keep].tolist(), longer[keep].tolist(), strict=True):
        if tail and words[x][:half] == words[y][:half]:
            continue  # seen where the first halves agree
        for u, v in ((x, y), (y, x)) if more else ((x, y),):
            out[0].append(words[u]), out[1].append(words[v]), out[2].append(counts[v])
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, _NEAR)], schema=_NEAR)


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs of rows ordered by side, s, affix, lo, hi: whole groups fill a block until it is large enough."""
    held: list[tuple] = []
    unit, n_units, shape, key = None, 0, None, None

    def flush() -> Iterator[pa.RecordBatch]:
        if len(held) > 1:
            units, words, counts, parts, across = zip(*held)
            yield _compare(np.array(units), list(words), list(counts), np.array(parts), np.array(across), shape[0], shape[1])
        held.clear()

    for batch in batches:
        for side, s, affix, lo, hi, part, word, n in zip(*(batch.column(c).to_pylist() for c in ("side", "s", "affix", "lo", "hi", "part", "word", "n")), strict=True):
            key = (side, s, affix, lo, hi)
            if key != unit:
                full = held and (shape != (side, s) or len(held) >= min(BLOCK, BLOCK_LETTERS // (s + 1)))
                if full:
                    yield from flush()
                unit, n_units, shape = key, n_units + 1, (side, s)
            held.append((n_units, word, n, part, lo != hi))
    yield from flush()


def near_words(scratch: Scratch, words: DataFrame) -> DataFrame:
    """(word, near, near_n) of all near pairs, in both directions."""
    size = f"greatest(2, least({BLOCK}, {BLOCK_LETTERS} div (s + 1)))"
    keyed = (words.withColumn("s", F.explode(F.expr("array(length(word), length(word) - 1)"))).where(F.col("s") > 0)
             .withColumn("side", F.explode(F.expr("array(false, true)")))
             .withColumn("affix", F.expr("IF(side, right(word, s - s div 2), left(word, s div 2))")))
    keyed = scratch.write(keyed, "keyed")
    # a group without a shorter word has no query
    sizes = keyed.groupBy("side", "s", "affix").agg(F.count(F.lit(1)).alias("members"), F.bool_or(F.length("word") == F.col("s")).alias("asks"))
    sizes = scratch.write(sizes.where("members > 1 AND asks").select("side", "s", "affix", F.expr(f"CAST(ceil(members / {size}) AS INT)").alias("cut")), "groups")
    placed = (keyed.join(sizes, ["side", "s", "affix"])
              .withColumn("part", F.expr("CAST(pmod(xxhash64(word), cut) AS INT)"))
              .withColumn("other", F.explode(F.expr("sequence(0, cut - 1)")))
              .withColumn("lo", F.least("part", "other")).withColumn("hi", F.greatest("part", "other")).drop("other", "cut"))
    order = ["side", "s", "affix", "lo", "hi"]
    near = (placed.repartition(partitions(words.sparkSession), *order).sortWithinPartitions(*order)
            .mapInArrow(released(_near), "word string, near string, near_n long"))
    return scratch.write(near, "near")


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n of a vocabulary (word, n): the form is the near word of largest n
    (ties: smallest in code-point order) if that is ``ratio`` times the word's own; roots end the chains of forms."""
    spark = words.sparkSession
    scratch = Scratch(spark, "variants")
    words = scratch.write(words.select("word", "n"), "vocabulary")
    near = near_words(scratch, words)
    best = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("best"))
    enough = F.expr(f"-best.m >= {ratio} * n")
    table_ = scratch.write(words.join(best, "word", "left").select(
        "word", F.when(enough, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, -F.col("best.m")).alias("form_n")), "forms")
    top = table_.agg(F.max("n")).first()[0] or 1
    steps = math.ceil(math.log2(max(2, 1 + math.log(top, ratio))))
    roots = table_.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(steps):
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = scratch.write(roots.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")
    return (table_.join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def op11_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(vocabulary(table(spark, sf_dir, "documents").select("doc_id", "text")))


def oracle_sql() -> str:
    """The same in DuckDB SQL: a table-driven CRC-32, and near words that agree after one deletion."""
    letters = "[A-Za-z" + chr(0xC0) + "-" + chr(0xFF) + "]+"
    return f"""
    WITH RECURSIVE runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '{letters}')), '{UPPER}', '{LOWER}') AS run FROM documents),
    told AS (SELECT doc_id, run, count(*) AS k FROM runs WHERE len(run) >= {MIN_LENGTH} GROUP BY 1, 2),
    step(i, c, k) AS (SELECT range, range::BIGINT, 0 FROM range(256)
        UNION ALL SELECT i, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k + 1 FROM step WHERE k < 8),
    crc AS MATERIALIZED (SELECT list(c ORDER BY i) AS t FROM step WHERE k = 8),
    hashed AS (SELECT run, k, xor(4294967295, list_reduce(list_concat([4294967295::BIGINT],
            list_transform(regexp_extract_all(hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)), '..'), lambda x: ('0x' || x)::BIGINT)),
            lambda c, b: xor(t[(xor(c, b) & 255) + 1], c // 256))) AS h FROM told, crc),
    words AS (SELECT CASE WHEN h % {DELETE_EVERY} = 0 THEN substring(run, 1, (h % len(run))::INT) || substring(run, (h % len(run))::INT + 2) ELSE run END AS word, k FROM hashed),
    v AS MATERIALIZED (SELECT word, sum(k)::BIGINT AS n FROM words WHERE len(word) >= {MIN_LENGTH} GROUP BY word HAVING sum(k) >= {MIN_COUNT}),
    cut AS MATERIALIZED (SELECT word, n, i, substring(word, 1, i - 1) || substring(word, i + 1) AS rest
        FROM (SELECT word, n, unnest(range(1, len(word) + 1)) AS i FROM v)),
    near AS (SELECT a.word, b.word AS near, b.n AS m FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
        UNION SELECT cut.word, v.word, v.n FROM cut JOIN v ON cut.rest = v.word
        UNION SELECT v.word, cut.word, cut.n FROM cut JOIN v ON cut.rest = v.word),
    best AS (SELECT word, count(*) AS n_near, arg_min(near, (-m, encode(near))) AS near, max(m) AS m FROM near GROUP BY word),
    forms AS MATERIALIZED (SELECT v.word, v.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN m >= {RATIO} * v.n THEN near END AS form, CASE WHEN m >= {RATIO} * v.n THEN m END AS form_n
        FROM v LEFT JOIN best USING (word)),
    chain(word, place) AS (SELECT word, word FROM forms UNION ALL SELECT chain.word, forms.form FROM chain JOIN forms ON forms.word = chain.place WHERE forms.form IS NOT NULL),
    root AS (SELECT chain.word, chain.place AS root FROM chain JOIN forms ON forms.word = chain.place WHERE forms.form IS NULL)
    SELECT word, form, root, n, n_near, form_n::BIGINT AS form_n FROM forms JOIN root USING (word)
    """
