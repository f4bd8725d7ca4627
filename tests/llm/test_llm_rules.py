"""Mixing, licenses, personal data, language: against brute force and planted cases."""

import hashlib
import random
import re

import duckdb
import numpy as np
import pytest

from stratum.llm import language, licenses, mixing, pii
from stratum.llm.common import Scratch

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()


def mix_rows():
    rng = random.Random(6)
    rows = []
    for i in range(300):
        source = "hot" if i % 3 else rng.choice(["a", "b", None, "é", "z"])
        rows.append((i, " ".join(rng.choice(WORDS) for _ in range(rng.randint(0, 90))), source))
    return rows + [(400, None, "a"), (401, "", "empty"), (402, " ", None), (7, rows[7][1], rows[7][2]), (None, "some words", "a"), (403, "w " * 20_000, "long")]


@pytest.fixture(scope="module")
def mix_docs(spark):
    return spark.createDataFrame([(*r, 1, "x") for r in mix_rows()], "doc_id long, text string, source string, no int, shard string").repartition(3)


def water_fill(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    share, full = 1.5 * sum(sizes.values()), set()
    while True:
        left = share - sum(2 * sizes[s] for s in full)
        free = sum(weight[s] for s in order if s not in full)
        target = {s: 2 * sizes[s] if s in full else left * weight[s] / free for s in order}
        over = {s for s in order if s not in full and target[s] > 2 * sizes[s]}
        if not over:
            return target
        full |= over


def test_mix_reaches_its_targets(spark, mix_docs):
    out = mixing.plan_mix(mix_docs, Scratch(spark, "t"), ["doc_id", "source"]).collect()
    sizes, taken = {}, {}
    for r in out:
        sizes[r.k1] = sizes.get(r.k1, 0) + r.size
        taken[r.k1] = taken.get(r.k1, 0) + r.taken
        assert 0 <= r.taken <= 2 * r.size
    target = water_fill(sizes)
    assert len(out) == len(mix_rows())
    for r in out:
        assert r.source_size == sizes[r.k1] and r.target == pytest.approx(target[r.k1])
    for s, t in target.items():
        assert abs(taken[s] - t) <= 2 * mixing.BLOCK
    again = mixing.plan_mix(mix_docs.repartition(5), Scratch(spark, "t"), ["doc_id", "source"]).collect()
    assert sorted(map(str, again)) == sorted(map(str, out))


def test_mix_equals_its_sql(spark, mix_docs):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", mix_rows())
    expect = sorted(map(str, con.sql(mixing.oracle_sql()).fetchall()))
    got = mixing.plan_mix(mix_docs, Scratch(spark, "t"), ["doc_id"]).select("k0", "size", "source_size", "target", "taken").collect()
    assert sorted(str(tuple(r)) for r in got) == expect


def test_apportion_is_by_highest_quotients(spark):
    rng = random.Random(8)
    rows = [(g, k, float(rng.randint(0, 500)), 37) for g in range(4) for k in range(9)]
    got = {(r.g, r.k): r.won for r in mixing.apportion(spark.createDataFrame(rows, "g int, k int, v double, s long"), ["g"], "k", "v", "s").collect()}
    for g in range(4):
        own = [(k, v) for gg, k, v, _ in rows if gg == g]
        quotients = sorted(((-v / (2 * i + 1), k) for k, v in own for i in range(37)))[:37]
        assert {k: sum(q[1] == k for q in quotients) for k, _ in own} == {k: got[(g, k)] for k, _ in own}


def test_mix_rows_and_empty(mix_docs):
    out = mixing.mix(mix_docs)
    assert out.columns == mix_docs.columns and 0 < out.count() <= 2 * mix_docs.count()
    planned = mixing.plan_mix(mix_docs, Scratch(mix_docs.sparkSession, "t"), ["source", "text"]).collect()
    for s in {r.k0 for r in planned}:  # whole documents keep to their source's words
        own = [r for r in planned if r.k0 == s]
        assert all(0 <= r.copies <= 2 for r in own)
        typical = sorted(r.size for r in own)[len(own) // 2]
        assert abs(sum(r.copies * r.size for r in own) - sum(r.taken for r in own)) <= max(typical, mixing.BLOCK) or len(own) == 1
    assert mixing.mix(mix_docs.limit(0)).count() == 0


LICENSED = [
    "Released under the MIT License. More words", "licensed under the Apache License, Version 2.0.", "x CC-BY-NC y cc by nc", "SPDX-License-Identifier: GPL-3.0",
    "This work is licensed under the GNU General Public License, version 3.", "not licensed under the MIT license", "Licensed under CC BY-NC 4.0.", "mit license", "UNDER THE MIT LICENSE under the mit license",
    "é under\tthe-MIT…license", "All rights reserved.", "nothing here", "License", "under the mit licenses", "xunder the mit license", "", None, "cc " * 3000 + "under the mit license", "under the mit license " * 500]


def words_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def test_license_base_against_brute_force(spark):
    df = spark.createDataFrame([(i, t, "q", 1) for i, t in enumerate(LICENSED)] + [(0, LICENSED[0], "q", 1)], "doc_id long, text string, detections string, score int")
    got = licenses.scan(df, ["doc_id"]).collect()
    assert len(got) == len(LICENSED) + 1
    for r in got:
        w = words_of(LICENSED[r.doc_id])
        places = [(i, label) for phrase, label in (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))
                  for i in range(len(w)) if w[i:i + len(phrase.split())] == phrase.split()]
        base = [d for d in r.detections if d.base]
        assert r.n_words == len(w)
        assert sorted((d.s, d.label) for d in base) == sorted(places)
        assert {p[1] for p in places} <= set(r.labels) and 0 <= r.score <= 1
    assert licenses.scan(df.limit(0), ["doc_id"]).count() == 0


def test_license_labels_and_suppression(spark):
    texts = ["SPDX-License-Identifier: GPL-3.0", "This work is licensed under the GNU General Public License, version 3.", "not licensed under the ISC license", "All rights reserved",
             "licensed under CC BY-NC-SA 4.0", "unrelated words", "the Mozilla Public License version 2.0", "GNU Affero General Public License v3"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: sorted(r.labels) for r in licenses.scan(df, ["doc_id"]).collect()}
    assert got[0] == ["gpl-3"] and got[1] == ["gpl-3"] and got[2] == [] and got[3] == ["proprietary"] and got[5] == []
    assert "cc-by-nc-sa" in got[4] and got[6] == ["mpl-2"] and got[7] == ["agpl-3"]
    assert sum(len(r) for r in licenses.RULES.values()) > 200


def test_license_rules_need_no_python(spark):
    df = licenses.scan(spark.createDataFrame([(1, "a")], "doc_id long, text string"), ["doc_id"])
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


def plain_spans(text):
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[ -]", "", m[0])
        if 16 <= len(digits) <= 19 and pii.luhn(digits):
            out.append(("card", m.start(), m.end()))
    out += [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


def test_base_spans_against_plain_patterns():
    rng = random.Random(3)
    atoms = ["a", "@", "b.c", ".", "1", "22", "255", "256", "0001", " ", "-", "+", "(", ")", "@x.y", "a@b.cc@d.e", "4111111111111111", "4111 1111-1111 1111", "+1 (688) 555-0922", "10.0.0.1", "é", "%", "_"]
    for _ in range(20_000):
        t = "".join(rng.choice(atoms) for _ in range(rng.randint(0, 9)))
        assert [(pii.KINDS[k], a, b) for k, a, b in pii.base_spans(t)] == plain_spans(t), t


@pytest.fixture(scope="module")
def private(spark):
    rng = random.Random(11)
    rows = []
    for i in range(400):
        words = [rng.choice(WORDS) for _ in range(30)]
        n = i % 8
        if n < 5:
            secret = "".join(rng.choice("0123456789abcdef") for _ in range(40))
            words[10] = [f"{rng.choice(WORDS)}.{i}@mail{i % 9}.example.com", f"{rng.randint(1, 99)}.{rng.randint(1, 255)}.3.{i % 256}", "4111111111111111", f"+1 (688) 555-{i:04d}", f'token = "{secret}"'][n]
        elif n == 5:
            words[10] = f"page {i} of 4.0"
        rows.append((i, " ".join(words), "s", 30))
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long").repartition(3)


@pytest.fixture(scope="module")
def model(private):
    return pii.fit(private)


def test_field_keeps_base_and_finds_secrets(private, model):
    texts = {r.doc_id: r.text for r in private.collect()}
    for r in pii.find_spans(private, model).collect():
        base = plain_spans(texts[r.doc_id])
        spans = [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in r.spans.split(",") if s)]
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
        assert set(base) <= set(spans)
        added = [s for s in spans if s not in base]
        if r.doc_id % 8 == 4:
            a = texts[r.doc_id].index('"') + 1
            assert added == [("secret", a, a + 40)]
        else:
            assert added == []


def test_skip_edges_carry_labels_to_repeats(model):
    text = "call +1 (688) 555-0922 alpha beta gamma delta epsilon zeta eta theta 16885550922 iota kappa"
    (base, spans), = pii.detect_texts([text], model)
    nodes = pii.Nodes()
    nodes.add(0, "write to kim.lee@x.org now alpha beta gamma delta epsilon zeta eta kim.lee said", [(0, 9, 22)])
    assert len(nodes.skip) == 1  # the mention of the local part far away
    features, labels, _, chain, skip = nodes.arrays()
    linked, alone = (pii.marginals(model, features, labels, chain, e)[skip[0, 1], 1] for e in (skip, skip[:0]))
    assert linked > alone
    assert set(base) <= set(spans)


def test_messages_are_exact_on_a_tree(model):
    import itertools

    import numpy as np

    unary, a, s = model
    features = np.array([[0, 1 + i, 10, 20, 28, 30, 32, 34, 36, 38, 64 + i, 192, 256, 320, 384] for i in range(3)])
    chain, skip, base = np.array([[0, 1]]), np.array([[1, 2]]), np.zeros(3, int)
    u = unary[features].sum(axis=1)
    total = np.zeros((3, pii.LABELS))
    for y in itertools.product(range(pii.LABELS), repeat=3):
        w = np.exp(sum(u[i, y[i]] for i in range(3)) + a[y[0], y[1]] + s[y[1], y[2]])
        for i in range(3):
            total[i, y[i]] += w
    assert pii.marginals(model, features, base, chain, skip) == pytest.approx(total / total.sum(axis=1, keepdims=True), abs=2e-2)


def test_redact_and_odd_rows(spark, model):
    rows = [(1, "mail a.b@c.de or 4111111111111111.", "s", 34), (2, None, None, None), (3, "", "s", 0), (4, "clean text 12", "s", 13), (1, "mail a.b@c.de or 4111111111111111.", "s", 34)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    out = sorted((r.doc_id, r.text, r.n_chars) for r in pii.redact(df, model, length_col="n_chars").collect() if r.text is not None)
    assert out[0] == (1, "mail <EMAIL> or <CARD>.", 23) and out[2:] == [(3, "", 0), (4, "clean text 12", 13)]
    assert pii.redact(df, None).count() == 5
    assert pii.find_spans(df.limit(0), model).count() == 0
    assert pii.fit(df.limit(0)) is None


def test_language_evidence(spark):
    rng = random.Random(1)
    vocabulary = {"en": "the of and thing with that from heart", "de": "der die und nicht schön über straße keit", "fr": "les la des être où ça était pour une", "es": "los la que niño año está para una señor"}
    text = lambda l, n: " ".join(rng.choice(vocabulary[l].split()) for _ in range(n))
    rows = [(i, text(l, 30), l, f"h{l}.example.{l}") for i, l in enumerate(list(vocabulary) * 40)]
    labelled = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    model = language.fit(labelled, "doc_id", "text", "lang")
    odd = [(900, None, "en", None), (901, "12 34 !", "en", "x"), (902, "", None, "x"), (903, "漢字仮名交じり文の例です" * 5, "en", "x"), (904, text("fr", 25), "en", "x"), (905, "la", None, "hes.example.es"), (906, text("de", 4000), "de", None)]
    df = labelled.unionByName(spark.createDataFrame(odd, labelled.schema))
    F = language.F
    got = {r._row.doc_id: r for r in language.identify(df, model, "text", F.col("lang"), F.lit(None).cast("string"), F.col("source")).collect()}
    assert sum(got[i].lang == l for i, _, l, _ in rows) >= 0.99 * len(rows)
    assert not any(got[i].kept for i in (900, 901, 902, 903))
    assert got[904].lang == "fr" and got[905].lang == "es" and got[906].lang == "de"  # text beats a wrong label; host decides for a short text
    kept = language.keep_identified(df)
    assert kept.columns == df.columns and kept.count() == len(rows) + 3
    assert language.keep_identified(df.limit(0)).count() == 0


def test_page_text():
    page = '<html lang="fr"><head><script>var t="</p>";</script><style>p{}</style></head><body><!-- <b> --><p>l&eacute;a &amp; co</p></body></html>'
    assert language.html_text(page).split() == ["léa", "&", "co"]


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    model = language.fit(docs.where("doc_id % 2 = 0"), "doc_id", "text", "lang")
    rest = docs.where("doc_id % 2 = 1").collect()
    hits = 0
    for r in rest:
        scores = model[language.trigrams(r.text)].mean(axis=0)[:-1]
        hits += language.LANGUAGES[scores.argmax()] == r.lang
    assert hits >= 0.99 * len(rest)


FAR = " alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu "


@pytest.mark.parametrize(("text", "kind", "repeat"), [
    ("paid by 4111 1111 1111 1111 today," + FAR + "card 4111.1111.1111.1111 again" + FAR, "card", "4111.1111.1111.1111"),
    ("call +1 (688) 555-0922 now," + FAR + "or 16885550922 then" + FAR, "phone", "16885550922"),
    ("call +1 (688) 555-0922 now," + FAR + "or 688 555 0922 then" + FAR, "phone", "688 555 0922"),
    ('password = "hunter2x!z"' + FAR + "they typed hunter2x!z there" + FAR, "secret", "hunter2x!z"),
    ("password = blue-Horse-staple" + FAR + "they typed blue-Horse-staple there" + FAR, "secret", "blue-Horse-staple"),
])
def test_far_repeats_in_another_form_become_spans(spark, model, text, kind, repeat):
    at = text.rindex(repeat)
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    spans = pii.find_spans(df, model).first().spans.split(",")
    assert f"{kind}:{at}:{at + len(repeat)}" in spans


def test_evidence_reaches_every_mention(model):
    text = "write to kim.lee@x.org now" + 30 * (FAR + "kim.lee said")
    nodes = pii.Nodes()
    nodes.add(0, text, pii.base_spans(text))
    features, labels, _, chain, skip = nodes.arrays()
    ties = np.array(nodes.tie, np.int64).reshape(-1, 2)
    p = pii.marginals(model, features, labels, chain, skip, ties)
    alone = pii.marginals(model, features, labels, chain, skip[:0])
    mentions = [j for j, (_, a, b) in enumerate(nodes.spans) if text[a:b] == "kim.lee"]
    gain = (np.log(p) - np.log(alone))[mentions, 1]
    assert len(mentions) == 30 and gain.min() > 1 and np.ptp(gain) < 0.5
    phones = "call +1 (688) 555-0922 now" + 30 * (FAR + "or 16885550922 then")
    (base, spans), = pii.detect_texts([phones], model)
    assert len(base) == 1 and sum(k == 3 for k, _, _ in spans) == 31


def test_license_contexts_hold_every_rule_at_its_longest(spark):
    """A text per family and template, with the rule's longest match between other words, is found whole."""
    import re

    rules = [r for rs in licenses.RULES.values() for r in rs]
    rows, want = [], {}
    for i, r in enumerate(rules):
        text = licenses.longest(r.regex)
        assert re.fullmatch(r.regex, text) and text.count("@") == 1
        rows.append((i, "lorem ipsum dolor " + text.replace("@", "") + " sit amet"))
        want[i] = (3, 2 + len(text.split()), r)
    found = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id"]).collect()}
    for i, (start, end, r) in want.items():
        spans = {(d.s, -d.ne, d.c) for d in found[i].detections}
        assert (start, end, r.confidence) in spans, rows[i]
    sayings = ["released under the terms and conditions of the creative commons attribution share alike 4 0 international license",
               "in accordance with the terms of the creative commons attribution non commercial 4 0 international license"]
    scores = [r.score for r in licenses.scan(spark.createDataFrame(list(enumerate(sayings)), "doc_id long, text string"), ["doc_id"]).orderBy("doc_id").collect()]
    assert scores == [0.9, 0.85]


def test_planted_personal_data_is_found_and_clean_texts_are_left_alone(spark):
    """Recall of the method's spans over planted data, in the base forms and repeated far away in other forms."""
    rng = random.Random(12)
    word = lambda: rng.choice(WORDS)
    prose = lambda n: " ".join(word() for _ in range(n))

    def card():
        digits = [4] + [rng.randint(0, 9) for _ in range(14)]
        total = sum(d if i % 2 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(digits))
        return "".join(map(str, [*digits, -total % 10]))

    rows, planted = [], {}
    for i in range(240):
        number, text, spans = card(), prose(30), []

        def put(value):
            nonlocal text
            spans.append((len(text) + 1, len(text) + 1 + len(value)))
            text += " " + value + " " + prose(rng.randint(20, 60))

        kind = i % 5
        if kind == 0:
            user = f"{word()}.{word()}{rng.randint(1, 99)}"
            put(f"{user}@example.org"), put(f"{user}@mail.example.com")
        elif kind == 1:
            put(number), put(" ".join(number[j:j + 4] for j in range(0, 16, 4)))
        elif kind == 2:
            put(f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}")
        elif kind == 3:
            put(".".join(str(rng.randint(1, 254)) for _ in range(4)))
        else:
            secret = "".join(rng.choice("0123456789abcdef") for _ in range(24))
            text += f" password={secret} {prose(50)}"
            spans.append((text.index(secret), text.index(secret) + 24))
        rows.append((i, text))
        planted[i] = spans
    clean = [(1000 + i, prose(120)) for i in range(100)]
    df = spark.createDataFrame(rows + clean + [(2000, None), (2001, "")], "doc_id long, text string")
    found = {r.doc_id: [tuple(map(int, x.split(":")[1:])) for x in r.spans.split(",") if x] for r in pii.find_spans(df, pii.fit(df)).collect()}
    hit = [any(a < end and b > start for a, b in found[i]) for i, spans in planted.items() for start, end in spans]
    assert sum(hit) >= 0.98 * len(hit), sum(hit) / len(hit)
    assert not any(found[i] for i, _ in clean) and not found[2000] and not found[2001]


def test_number_dense_texts_stay_small(spark):
    import resource

    model = pii.fit(spark.createDataFrame([(i, f"mail a{i}@b.org call +1 (202) 555-{1000 + i} or 4111 1111 1111 1111") for i in range(40)], "doc_id long, text string"))
    text = " ".join(str(10_000 + i * 7919 % 900_000) for i in range(60_000))
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    pii.detect_texts([text], model)
    assert (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024 < 700
