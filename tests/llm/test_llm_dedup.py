"""Near-dedup of texts and embeddings against brute force."""

import math
import random

import numpy as np
import pytest

from stratum.llm import embeddings, neardup
from stratum.llm.common import Scratch, components


def roots(ids, links):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_components_against_union_find(spark):
    rng = random.Random(1)
    links = [(rng.randint(0, 80), rng.randint(0, 80)) for _ in range(50)] + [(i, i + 1) for i in range(200, 230)] + [(300, i) for i in range(301, 340)] + [(7, 7)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.id: r.component for r in components(Scratch(spark, "t"), df).collect()}
    expect = roots({x for l in links for x in l}, links)
    assert all(expect[i] == c for i, c in got.items())
    assert {i for i in expect if i not in got} <= {i for i in expect if all(a == b for a, b in links if i in (a, b))}
    assert components(Scratch(spark, "t"), df.limit(0)).count() == 0


def plain_set(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def corpus():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    rows, key = [], 0
    for _ in range(25):
        base = [word() for _ in range(rng.randint(30, 160))]
        for edits in (0, 0, 1, 2, 6, 12):
            text = list(base)
            for _ in range(edits):
                text[rng.randrange(len(text))] = word()
            rows.append((key, " ".join(text)))
            key += 1
    passage = " ".join(word() for _ in range(60))
    rows += [(key + i, passage + " " + " ".join(word() for _ in range(50))) for i in range(30)]
    hot = " ".join(word() for _ in range(80))
    rows += [(1000 + i, hot.upper() if i % 2 else hot + "\n") for i in range(120)]
    rows += [(2000, None), (2001, ""), (2002, " \t\n"), (2003, "two words"), (2004, "Two  Words"), (2005, "two words more"), (2006, "w " * 20_000), (3, rows[3][1])]
    return rows


@pytest.fixture(scope="module")
def found(spark):
    rows = [(i, t, "x", 1) for i, t in corpus()]
    df = spark.createDataFrame(rows, "doc_id long, text string, id string, component int").repartition(4)
    return {r.doc_id: r for r in neardup.near_duplicates(df).collect()}


def test_near_duplicates_against_brute_force(found):
    sets = {i: plain_set(t) for i, t in corpus()}
    ids = sorted(sets)
    links = [(a, b) for n, a in enumerate(ids) for b in ids[n + 1:] if sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    expect = roots(ids, links)
    assert {i: len(s) for i, s in sets.items()} == {i: r.n_shingles for i, r in found.items()}
    assert expect == {i: r.component_id for i, r in found.items()}


def test_hash_shingles_agree_with_plain_sets():
    a, b = corpus()[2][1], corpus()[3][1]
    x, y = neardup.shingle_set(a), neardup.shingle_set(b)
    p, q = plain_set(a), plain_set(b)
    assert (len(x), len(y), len(np.intersect1d(x, y))) == (len(p), len(q), len(p & q))


def test_tensored_tables_meet_as_often_as_they_should():
    rng = np.random.default_rng(5)
    met, n = 0, 300
    for _ in range(n):
        pool = rng.integers(0, 1 << 63, 220, dtype=np.uint64)
        a, b = np.unique(pool[:200]), np.unique(pool[20:])  # similarity 180 / 220 = 0.82
        x, y = (neardup._half_bands(neardup.minhashes(s)) for s in (a, b))
        same = x == y
        met += same[:neardup.HALF_BANDS].any() and same[neardup.HALF_BANDS:].any()
    s = 180 / 220
    assert met / n > (1 - (1 - s ** neardup.HALF_ROWS) ** neardup.HALF_BANDS) ** 2 - 0.02


def test_deduplicate_keeps_one_of_each_group(spark):
    rows = [(1, "a b c d e f", "s"), (2, "A b c d e f", "s"), (3, None, None), (4, "", "s"), (None, "a b c d e f", "s"), (5, "other words here", None), (5, "other words here", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = neardup.deduplicate(df)
    assert out.columns == df.columns
    assert sorted(str(r.doc_id) for r in out.collect()) == ["1", "3", "4", "5", "None"]
    assert neardup.deduplicate(df.limit(0)).count() == 0
    assert neardup.near_duplicates(df.limit(0)).count() == 0


def vectors():
    rng = np.random.default_rng(3)
    rows = []
    for _ in range(150):
        rows.append(rng.standard_normal(16))
    for size in (2, 3, 8, 60):  # tight groups; the last saturates every list
        center = rng.standard_normal(16)
        rows += [center + 0.05 * rng.standard_normal(16) for _ in range(size)]
    data = [(i, [float(x) for x in v]) for i, v in enumerate(rows)]
    data += [(500 + i, data[0][1]) for i in range(200)]  # a hot vector
    data += [(800, [2 * x for x in data[1][1]]), (801, None), (802, []), (803, [0.0] * 16), (804, [math.nan] + [1.0] * 15), (805, [math.inf] + [1.0] * 15),
             (806, [None] + [1.0] * 15), (807, data[2][1][:8]), (808, [1e300 * x for x in data[3][1]]), (4, data[4][1])]
    return data


def test_near_vectors_against_brute_force(spark):
    rows = [(i, v, "x", 1) for i, v in vectors()]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, id string, u int").repartition(3)
    got = {r.vec_id: r for r in embeddings.near_vectors(df).collect()}
    unit = {}
    for i, v, *_ in rows:
        x = np.array([math.nan if c is None else c for c in v or []], float)
        if len(x) and np.isfinite(x).all() and x.any():
            x = x / np.abs(x).max()
            unit[i] = x / np.linalg.norm(x)
    ids = sorted(unit)
    links = [(a, b) for n, a in enumerate(ids) for b in ids[n + 1:] if len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.95]
    degree = {i: sum(i in l for l in links) for i in got}
    assert degree == {i: r.n_links for i, r in got.items()}
    assert roots(got, links) == {i: r.component_id for i, r in got.items()}
    assert embeddings.near_vectors(df.limit(0)).count() == 0


def two_crowds():
    """Two tight crowds, each larger than any list; only a few pairs between them are links."""
    rng = np.random.default_rng(8)
    axis = np.eye(16)
    far = math.acos(0.955)
    crowds = [axis[0], math.cos(far) * axis[0] + math.sin(far) * axis[1]]
    return [(i, [float(x) for x in crowds[i % 2] + 0.01 * rng.standard_normal(16)]) for i in range(700)]


def brute(rows):
    u = np.array([v for _, v in rows])
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    linked = u @ u.T >= 0.95
    np.fill_diagonal(linked, False)
    return linked


def test_links_between_crowds_are_kept(spark):
    rows = two_crowds()
    linked = brute(rows)
    assert linked[0::2, 1::2].any() and linked[0::2, 0::2].sum(axis=1).min() > embeddings.ENLARGED
    got = {r.vec_id: r for r in embeddings.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert {i: int(linked[i].sum()) for i, _ in rows} == {i: r.n_links for i, r in got.items()}
    assert {r.component_id for r in got.values()} == {0}


def test_hubs_are_joined_whole(spark):
    """Every pair around a hub is compared, whichever blocks its members fall into."""
    rng = np.random.default_rng(2)
    n = 3 * embeddings.HUB
    u = rng.standard_normal((n, 4))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    rows = [(0, i, True, -2.0, bytearray(u[i].astype(np.float16).tobytes())) for i in range(n)]
    df = embeddings._blocks(spark.createDataFrame(rows, "center long, id long, fresh boolean, low float, q binary"), "center", embeddings.HUB)
    found = embeddings._grouped(df, embeddings._local_join, embeddings.LISTS, "center", "lo", "hi").where("NOT bridge").collect()
    best: dict[int, set] = {}
    for r in sorted(found, key=lambda r: -r.sim):
        own = best.setdefault(r.src, set())
        if len(own) < embeddings.NEIGHBOURS:
            own.add(r.dst)
    half = u.astype(np.float16).astype(np.float32)
    sims = half @ half.T
    np.fill_diagonal(sims, -2)
    tenth = np.sort(sims, axis=1)[:, -embeddings.NEIGHBOURS]
    assert all(len(best[i]) == embeddings.NEIGHBOURS and sims[i, list(best[i])].min() >= tenth[i] - 1e-5 for i in range(n))


def test_lists_full_at_their_own_limit_are_sent_on(spark):
    near = embeddings.THRESHOLD + 0.01
    rows = [(1, i, near) for i in range(10, 10 + embeddings.NEIGHBOURS)] + [(2, i, near) for i in range(30, 35)] + [(2, i, 0.5) for i in range(35, 40)]
    assert [r.id for r in embeddings._full(spark.createDataFrame(rows, "src long, dst long, sim float")).collect()] == [1]


@pytest.mark.parametrize("n", [1_000_000, 100_000_000])
def test_first_contact_does_not_fall_with_size(n):
    bits = math.ceil(math.log2(n / embeddings.LEAF))
    met = (1 - math.acos(embeddings.THRESHOLD) / math.pi) ** bits
    assert 1 - (1 - met) ** embeddings._tables(bits) >= embeddings.AUDIT_GOAL


def test_audit_is_not_hidden_by_a_hot_group(spark, monkeypatch):
    """A lost pair beside a crowd whose links are all there; the operator fails rather than return it."""
    rows = [r for r in two_crowds() if r[0] % 2 == 0] + [(i, list(np.eye(16)[2 + (i - 1000) // 2])) for i in range(1000, 1020)]
    rows = [(i, [x + 0.001 * i * (j == 15) / 1000 for j, x in enumerate(v)]) for i, v in rows]
    linked = brute(rows)
    data = [(i, 1, 16, bytearray((np.array(v) / np.linalg.norm(v)).tobytes())) for i, v in rows]
    vectors = spark.createDataFrame(data, "id long, size long, dim int, u binary")
    whole = spark.createDataFrame([(r[0], int(l.sum())) for r, l in zip(rows, linked)], "id long, n long")
    assert embeddings._audit(vectors, whole, len(rows)) == 1.0
    assert embeddings._audit(vectors, whole.where("id < 1000"), len(rows)) < embeddings.AUDIT_GOAL
    monkeypatch.setattr(embeddings, "_audit", lambda *_: 0.9)
    monkeypatch.setattr(embeddings, "AUDITS", 1)
    with pytest.raises(RuntimeError, match="below"):
        embeddings.near_vectors(spark.createDataFrame(rows[:5], "vec_id long, embedding array<double>"))
