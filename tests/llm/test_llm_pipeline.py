"""The corpus pipeline: stage by stage on the smallest tables, and the registered queries."""

import pytest

import corpus_pipeline
from stratum.llm import catalog
from stratum.llm.common import Scratch, table

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    scratch = Scratch(spark, "t")
    docs = table(spark, SF, "documents")
    seen = [docs.count()]
    columns = docs.columns
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = scratch.write(stage(spark, docs, SF), name)
        if i < 4:
            assert docs.columns == columns
        seen.append(docs.count())
    assert seen[1] == seen[0]  # all have a language
    assert seen[2] < seen[1] and seen[3] == seen[2] and seen[4] == seen[5] > 0
    assert "ids_sha256" in docs.columns


def test_stages_take_an_empty_table(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = Scratch(spark, "t").write(stage(spark, docs, SF), "stage")
    assert docs.count() == 0


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_registered_query_returns_rows_for_its_whole_table(spark, name):
    if name == "pipeline":
        return
    out = catalog.QUERIES[name](spark, SF)
    source = "embeddings" if name.startswith("op2_") else "pages" if name.startswith("op7_") else "documents"
    assert out.count() == table(spark, SF, source).count()


# ------------------------------------------------------------- brute force
def plain_copies(rows):
    """Copies of each (doc_id, text, source) by highest quotients over blocks, one shard a source."""
    import hashlib
    import math
    import re

    from stratum.llm import mixing
    from test_llm_rules import water_fill

    words = {i: len(re.findall(mixing.WORD, t or "")) for i, t, _ in rows}
    sizes = {}
    for i, _, s in rows:
        sizes[s] = sizes.get(s, 0) + words[i]
    target = water_fill(sizes)
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    no = {s: n + 1 for n, s in enumerate(order)}
    seats = math.floor(1.5 * sum(sizes.values()) / mixing.BLOCK + 0.5)
    quotients = sorted(((-target[s] / (2 * k + 1), no[s]) for s in order for k in range(seats)))[:seats]
    md5 = lambda *p: hashlib.md5(":".join((mixing.SEED, *map(str, p))).encode()).hexdigest()
    out = {}
    for s in order:
        assert sizes[s] <= mixing.SHARD_TOKENS
        blocks = max(1, math.ceil(sizes[s] / mixing.BLOCK))
        quota = min(sum(q[1] == no[s] for q in quotients), 2 * math.ceil(sizes[s] / mixing.BLOCK))
        times, more = divmod(quota, blocks)
        offset = int(md5(no[s], 0)[:8], 16) % blocks
        at, part = 0, {}
        for _, i in sorted((md5(i), i) for i, _, src in rows if src == s):
            twice = [((b + 1) * more + offset) // blocks - (b * more + offset) // blocks for b in range(at // mixing.BLOCK, (at + words[i]) // mixing.BLOCK + 1)]
            edges = [at, *range((at // mixing.BLOCK + 1) * mixing.BLOCK, at + words[i], mixing.BLOCK), at + words[i]]
            part[i] = times * words[i] + sum(t * (y - x) for t, x, y in zip(twice, edges, edges[1:]))
            at += words[i]
        falling = sorted(part, key=lambda i: (-words[i], md5(i)))
        best = None
        for k in range(mixing.STARTS):
            run, copies = 0.0, {}
            for i in falling:
                old = run
                run += part[i] / words[i] if words[i] else 0.0
                copies[i] = math.floor(run + k / mixing.STARTS) - math.floor(old + k / mixing.STARTS)
            miss = abs(sum(words[i] * copies[i] for i in copies) - sum(part.values()))
            if best is None or miss < best[0]:
                best = miss, copies
        out |= best[1]
    return out


def test_pipeline_against_brute_force(spark):
    import hashlib
    import re
    from collections import Counter

    import public_tokenizers as P
    import sentencepiece
    from test_llm_dedup import plain_set, roots
    from test_llm_rules import plain_spans

    rows = [(r.doc_id, r.text, r.source) for r in table(spark, SF, "documents").collect()]
    sets = {i: plain_set(t) for i, t, _ in rows}
    ids = sorted(sets)
    links = [(a, b) for n, a in enumerate(ids) for b in ids[n + 1:] if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    kept = {i for i, root in roots(ids, links).items() if i == root}

    def redacted(text):
        spans = [(a, b, k) for k, a, b in plain_spans(text)]
        spans += [(*m.span(1), "secret") for m in re.finditer(r'(?:password=|token = ")([0-9a-f]{12,})', text)]
        out, done = [], 0
        for a, b, k in sorted(spans):
            if a >= done:
                out += [text[done:a], f"<{k.upper()}>"]
            done = max(done, b)
        return "".join(out) + text[done:]

    left = [(i, redacted(t), s) for i, t, s in rows if i in kept]
    copies = plain_copies(left)
    library = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    expect = Counter()
    for i, text, _ in left:
        tokens = library.encode(text)
        expect[(i, len(tokens), sha(",".join(map(str, tokens))), sha(library.decode(tokens)))] += copies[i]
    got = Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, SF).collect())
    assert got == +expect


# -------------------------------------------------------- names and long texts
def test_stages_keep_columns_whatever_their_names(spark):
    """Extra columns named like a stage's own ones pass through unchanged, and repeated and NULL ids do no harm."""
    from pyspark.sql import functions as F

    from stratum.llm import language, mixing, neardup, pii
    from stratum.llm.common import importable

    importable(spark)
    names = ["_kept", "_lang", "_confidence", "_text_lang", "_row", "id", "tid", "row", "n", "component_id", "copies", "taken", "size", "k0", "shard", "_n", "hit_key", "kept"]
    docs = table(spark, SF, "documents").limit(120)
    again = docs.limit(5).withColumn("text", F.concat("text", F.lit(" more")))
    docs = docs.unionByName(again).unionByName(docs.limit(2).withColumn("doc_id", F.lit(None).cast("long")))
    docs = docs.select("*", *[F.concat(F.lit(f"{c}-"), F.coalesce(F.col("doc_id").cast("string"), F.lit("x"))).alias(c) for c in names])
    unchanged = lambda df: all(r[c] == f"{c}-{'x' if r.doc_id is None else r.doc_id}" for r in df.collect() for c in names)
    for stage in (language.keep_identified, neardup.deduplicate, lambda d: pii.redact(d, pii.fit(d), length_col="n_chars"), mixing.mix):
        out = stage(docs)
        assert out.columns == docs.columns and out.count() > 20 and unchanged(out)
    kept = [r.doc_id for r in neardup.deduplicate(docs).where("doc_id IS NOT NULL").collect()]
    assert len(kept) == len(set(kept))
    assert sorted(map(str, neardup.deduplicate(docs.repartition(7)).collect())) == sorted(map(str, neardup.deduplicate(docs).collect()))


def test_long_pages_take_time_in_proportion():
    import time

    from stratum.llm.language import html_text

    assert html_text("a<script>x<b></script >b<!-- c -->d<style>e") == "a b d e"
    assert html_text("<noscript>q</noscript>A &amp; B <i") == " A & B <i"
    assert html_text("1<!-- 2 <script> 3 --> 4 </script> 5 <STYLE a=b>6</style> <scripty>7") == "1  4   5    7"
    for unit in ("<!-- x ", "<script> y ", "< z ", "<style><!--"):
        began = time.process_time()
        html_text(unit * 200_000)
        assert time.process_time() - began < 5


def test_fused_posterior_against_plain(spark):
    """The whole fusion of operator 7 recomputed in plain Python from the same trigram model."""
    import math
    import random

    import numpy as np
    from pyspark.sql import functions as F

    from stratum.llm import language as L
    from stratum.llm.common import importable

    importable(spark)
    labelled = table(spark, SF, "documents")
    model = L.fit(labelled, "doc_id", "text", "lang")
    rng = random.Random(9)
    rows = []
    for r in labelled.select("doc_id", "text", "lang").limit(80).collect():
        text = " ".join((r.text or "").split()[:rng.choice((2, 5, 60))])
        rows.append((r.doc_id, rng.choice([text, text, text, "", None, "1234"]), rng.choice([r.lang, "xx", None, "de"]), rng.choice([None, "fr"]),
                     rng.choice([None, "a.one.com", "b.one.com", "c.two.org", "x"])))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, sfx string, host string").repartition(3)
    got = {r._row.doc_id: r for r in L.identify(df, model, "text", F.col("lang"), F.col("sfx"), F.col("host")).collect()}
    n, soft = len(L.LANGUAGES), lambda v: np.exp(v - v.max()) / np.exp(v - v.max()).sum()
    known = lambda x: None if not x else x if x in L.LANGUAGES else "other"
    ll, spoken = {}, {}
    for i, text, *_ in rows:
        b = L.trigrams(text or "")
        mean = model[b].mean(axis=0) if len(b) else np.zeros(n + 1)
        ll[i], spoken[i] = mean[:-1] * min(len(b), L.EFFECTIVE), bool(len(b)) and mean[-1] >= L.KNOWN_SHARE
    post = {i: soft(v) for i, v in ll.items()}
    voters = [r for r in rows if spoken[r[0]]]

    def logs(column):
        values = {}
        for r in voters:
            if known(r[column]):
                values[known(r[column])] = values.get(known(r[column]), 0) + post[r[0]]
        total = sum(values.values()) if values else np.zeros(n)
        return {v: np.log((s + 1) / (total + n + 1)) for v, s in values.items()}

    declared, suffix = logs(2), logs(3)
    corpus = (sum(post[r[0]] for r in voters) + 1) / (len(voters) + n)
    of = lambda rows_: (len(rows_), sum((post[r[0]] for r in rows_), np.zeros(n)))
    domain = lambda h: ".".join(h.split(".")[-2:])
    for i, _, lang, sfx, host in rows:
        prior = np.log(corpus)
        if host and any(r[4] == host for r in voters):
            (hn, hs), (dn, ds) = of([r for r in voters if r[4] == host]), of([r for r in voters if r[4] and domain(r[4]) == domain(host)])
            d = (ds + L.DOMAIN_STRENGTH * corpus) / (dn + L.DOMAIN_STRENGTH)
            own = post[i] if spoken[i] else 0
            prior = np.log((np.maximum(hs - own, 0) + L.HOST_STRENGTH * d) / (hn - spoken[i] + L.HOST_STRENGTH))
        p = soft(ll[i] + declared.get(known(lang), np.zeros(n)) + suffix.get(known(sfx), np.zeros(n)) + prior)
        assert got[i].confidence == (0 if not spoken[i] else pytest.approx(p.max(), rel=1e-6))
        assert got[i].lang == (L.LANGUAGES[int(p.argmax())] if spoken[i] else None)
        assert got[i].kept == (got[i].confidence >= L.CONFIDENT)
    assert sum(spoken.values()) > 20 and not math.isnan(sum(r.confidence for r in got.values()))
