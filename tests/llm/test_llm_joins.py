"""Spelling variants, decontamination and hard negatives against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratum.llm import decontaminate, negatives, variants
from stratum.llm.common import Scratch

# ------------------------------------------------------------ spelling variants


def plain_vocabulary(rows):
    count = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= 6 and n >= 5}


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_variants(count, ratio=5):
    near = {w: [v for v in count if one_apart(w, v)] for w in count}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-count[v], v), default=None)
        form[w] = best if best is not None and count[best] >= ratio * count[w] else None
    out = set()
    for w in count:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, count[w], len(near[w]), count[form[w]] if form[w] else None))
    return out


def as_set(df):
    return set(map(tuple, df.collect()))


def words_corpus():
    rng = random.Random(11)
    base = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(6, 9))) for _ in range(60)]
    rows = []
    for key in range(300):
        text = []
        for _ in range(60):
            w = list(base[min(int(rng.paretovariate(0.8)) - 1, 59)])
            if rng.random() < 0.25:
                at, what = rng.randrange(len(w)), rng.randrange(3)
                w[at:at + (what != 0)] = [] if what == 1 else [rng.choice("abcde")]
            text.append("".join(w).upper() if rng.random() < 0.1 else "".join(w))
        rows.append((key, " ".join(text)))
    rows += [(500 + i, "chainroot " * 20 + "Chainroots " * (3 if i < 10 else 0) + "chainrootsy " * (i < 6)) for i in range(20)]
    rows += [(None, rows[0][1]), (1, rows[1][1]), (1, rows[1][1]), (400, None), (401, ""), (402, "1234 -- ×÷ 中文 \U0001f600"),
             (403, "longest" * 30_000), (404, ("longest" * 30_000 + " ") * 6), (405, ("longest" * 30_000 + "x ") * 7)]
    return rows


def test_variants_against_brute_force(spark):
    rows = words_corpus()
    docs = spark.createDataFrame([(*r, "word", 7, "s") for r in rows], "doc_id long, text string, word string, n int, side string")
    count = plain_vocabulary(rows)
    words = variants.vocabulary(docs)
    assert dict(as_set(words)) == count
    got = variants.variants(words)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert as_set(got) == plain_variants(count)
    assert sum(r[1] is not None for r in as_set(got)) > 50 and any(r[1] != r[2] for r in as_set(got) if r[1])


def test_variants_hot_groups_ties_and_empty(spark, monkeypatch):
    monkeypatch.setattr(variants, "BLOCK", 8)  # groups are cut into parts of about eight words
    rng = random.Random(5)
    words = {"prefix" + "".join(rng.choice("abc") for _ in range(rng.randint(1, 4))) for _ in range(400)} | {"ab", "abc", "a", "prefix"}
    count = {w: rng.choice((5, 5, 25, 26, 700)) for w in words}
    df = spark.createDataFrame(list(count.items()), "word string, n long")
    near = variants.near_words(Scratch(spark, "t"), df)
    want = {(a, b, count[b]) for a in words for b in words if one_apart(a, b) and min(len(a), len(b)) > 0}
    rows = near.collect()
    assert {tuple(r) for r in rows} == want and len(rows) == len(want)  # each pair once per direction
    assert as_set(variants.variants(df)) == plain_variants(count)
    assert variants.variants(df.limit(0)).count() == 0
    assert variants.variants(variants.vocabulary(spark.createDataFrame([], "doc_id long, text string"))).count() == 0


@pytest.mark.parametrize("s", [1, 3, 6, 20])
def test_one_error_sets(s):
    rng = random.Random(s)
    words = list({"".join(rng.choice("abé" if s > 3 else "abcdefgh") for _ in range(rng.choice((s, s + 1)))) for _ in range(300)})
    if s > 6:  # long random words are hardly ever near: edit some
        words += [w[:4] + "z" + w[5:] for w in words[:50]] + [w[:2] + w[3:] for w in words[:50] if len(w) == s + 1]
        words = list(set(words))
    a, b, longer = variants.one_error(words, s)
    got = [(words[x], words[y]) for x, y in zip(a, b)]
    want = {(x, y) for x in words for y in words if len(x) == s and one_apart(x, y)}
    assert set(got) == want and len(got) == len(want)
    assert all((len(y) > len(x)) == m for (x, y), m in zip(got, longer))


# ------------------------------------------------------------- decontamination


def plain_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)


def plain_hits(docs, items, window=10):
    out = Counter()
    wins = []
    for item, text in items:
        w = plain_words(text)
        m = min(window, len(w))
        wins += [(item, w[i:i + m]) for i in range(len(w) - m + 1)] if w else []
    for key, text in docs:
        w = plain_words(text)
        hit, ids = set(), set()
        for item, win in wins:
            for i in range(len(w) - len(win) + 1):
                if w[i:i + len(win)] == win:
                    hit.update(range(i, i + len(win)))
                    ids |= {str(item)} if item is not None else set()
        listed = ",".join(sorted(ids))
        out[key, len(w), len(hit), len(ids), hashlib.sha256(listed.encode()).hexdigest(), bool(hit)] += 1
    return out


def contaminated_corpus():
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.choice((1, 2, 4))))
    text = lambda n: " ".join(word() for _ in range(n))
    items = [(i, text(rng.randint(10, 60))) for i in range(30)]
    items += [(50, "Two words"), (51, "single"), (52, "three little words"), (53, None), (54, ""), (55, "..."), (None, "nobody owns this"),
              (56, items[0][1]), (0, items[1][1]), (2, items[2][1]), (2, items[2][1]), (10, "a a a a a a a a a a a a a"), (9, "the hot passage " * 6)]
    docs = []
    for i in range(150):
        parts = [text(rng.randint(0, 80))]
        for _ in range(rng.randint(0, 2)):
            w = plain_words(rng.choice(items)[1])
            a = rng.randint(0, max(0, len(w) - 5))
            parts += [", ".join(w[a:a + rng.randint(5, 40)]).upper(), text(rng.randint(0, 30))]
        docs.append((i, " ".join(parts)))
    docs += [(200, None), (201, ""), (202, "!!"), (203, "it is single"), (204, "TWO, words... three little words"), (205, "nobody owns this two wordss"),
             (None, "single"), (None, "single"), (None, "none"), (206, "a " * 30), (207, "the hot passage " * 3000), (208, "Étude 中文 single"),
             (3, "single again"), (3, "nothing"), (3, "single again")]
    return docs, items


@pytest.mark.parametrize("limit", [1 << 20, -1])
def test_decontamination_against_brute_force(spark, limit):
    docs, items = contaminated_corpus()
    df = spark.createDataFrame([(*r, "k", 1, "h") for r in docs], "doc_id long, text string, key string, n_hit int, hash string").repartition(5)
    bench = spark.createDataFrame([(*r, "w") for r in items], "item_id long, text string, words string")
    got = decontaminate.decontaminate(df, bench, ["doc_id", "key", "n_hit"] if limit < 0 else ["doc_id", "key"], broadcast_bytes=limit)
    rows = [(r[0], r["n_words"], r[-2], len(r[-1]), hashlib.sha256(",".join(r[-1]).encode()).hexdigest(), r[-2] > 0) for r in got.collect()]
    assert Counter(rows) == plain_hits(docs, items)
    assert all(r["key"] == "k" for r in got.collect())


def test_decontamination_empty_tables(spark):
    docs, items = contaminated_corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    clean = decontaminate.decontaminate(df, bench.limit(0), ["doc_id"]).collect()
    assert len(clean) == len(docs) and not any(r.n_hit or r["items"] for r in clean)
    assert decontaminate.decontaminate(df.limit(0), bench, ["doc_id"]).count() == 0


def test_decontamination_is_native(spark):
    plan = decontaminate.op12_decontaminate(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# --------------------------------------------------------------- hard negatives


def plain_negatives(rows, is_anchor):
    kept = {}
    for key, label, v in rows:
        if key is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        w = [math.floor(256 * x) for x in v]
        if any(abs(x) > math.isqrt((1 << 62) // max(1, len(w))) or abs(x) > 2**31 - 1 for x in w):
            continue
        kept[key] = min(kept.get(key, (label, w)), (label, w), key=lambda r: (r[0], len(r[1]), np.array(r[1], np.int32).tobytes()))
    out = set()
    for a, (la, va) in kept.items():
        if not is_anchor(a):
            continue
        score = {k: sum(x * y for x, y in zip(va, v)) for k, (_, v) in kept.items() if k != a and len(v) == len(va)}
        order = sorted(score, key=lambda k: (-score[k], k))
        for p in [k for k in order if kept[k][0] == la][:5]:
            fit = [k for k in order if kept[k][0] != la and 30 * score[p] <= 100 * score[k] <= 90 * score[p]][:10]
            out |= {(a, p, i, k, score[p], score[k]) for i, k in enumerate(fit, 1)}
    return out


@pytest.mark.parametrize("scale,block", [(1.0, 4096), (900_000.0, 3)])
def test_negatives_against_brute_force(spark, monkeypatch, scale, block):
    monkeypatch.setattr(negatives, "ANCHOR_BLOCK", block)
    monkeypatch.setattr(negatives, "LEAST_GROUP", 50)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(4, 24)) / 5
    rows = []
    for i in range(400):
        c = rng.integers(4)
        v = centres[c] + rng.normal(size=24) * 0.1
        rows.append((i, int(c if rng.random() < 0.8 else rng.integers(4)), (v * scale).tolist()))
    rows += [(1000 + i, i % 4, rows[7][2]) for i in range(60)]  # ties
    rows += [(None, 1, rows[0][2]), (2000, None, rows[0][2]), (2001, 1, None), (2002, 1, [float("nan")] * 24), (2003, 1, [float("inf")] * 24),
             (2004, 1, [None] + rows[0][2][1:]), (2005, 1, [1e30] * 24), (2010, 0, [0.5] * 8), (2020, 0, [0.6] * 8), (2021, 1, [0.4] * 8),
             (2030, 2, []), (2040, 2, []), (2041, 3, []), (10, 3, rows[11][2]), (10, 3, rows[11][2]), (2050, 0, [0.0] * 24)]
    df = spark.createDataFrame([(*r, 1, "b") for r in rows], "vec_id long, label int, embedding array<double>, id int, block string")
    got = negatives.hard_negatives(df, F.col("vec_id") % 10 == 0)
    want = plain_negatives(rows, lambda k: k % 10 == 0)
    assert as_set(got) == want and got.count() == len(want) > 500
    assert negatives.hard_negatives(df.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert negatives.hard_negatives(df, F.col("vec_id") < 0).count() == 0


def test_exact_scores_at_the_limits():
    rng = np.random.default_rng(3)
    for d, m in ((64, 150), (64, 1 << 27), (1000, 1 << 20), (1, 2**31 - 1), (0, 5), (4096, 300), (64, math.isqrt(2**62 // 64))):
        a, b = (rng.integers(-m, m + 1, (k, d)).astype(np.int32) for k in (7, 9))
        if d:
            a[0], b[0], b[1] = m, m, -m
        primes = negatives.primes_for(max(1, m * m * d))
        got = negatives.exact_scores(negatives.residues(a, primes), negatives.residues(b, primes), primes)
        assert (got == (a.astype(object) @ b.astype(object).T if d else np.zeros((7, 9)))).all()
