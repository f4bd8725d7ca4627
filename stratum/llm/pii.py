"""Personal data by base patterns and a skip-chain conditional random field (operator 10).

Base patterns (e-mail, IP, card, phone) find their spans first. In texts with a digit, an
at-sign or a credential cue, the tokens around such marks are the nodes of a conditional
random field: neighbouring tokens share chain potentials, and similar tokens anywhere in
the document (the same digits, a mention of an address's local part) share skip
potentials. Mentions of one datum are tied: a base card or phone and the same digits in
another form, of a phone also without country code; and in texts with a span or an
assignment, repeated tokens of six characters or more that are unlike words. Values of
assignments that are unlike words count as evidence. Loopy sum-product message passing then carries what is known at
one place, the base spans above all, to the others, so that labels agree across
the document. Tokens outside the base spans whose marginal for a kind reaches 0.9 become
added spans; credentials (kind ``secret``) only arise this way.

The weights are trained by pseudo-likelihood on a bounded sample of documents (at most
about TRAIN_DOCS with marks, chosen by a hash of the id), labelled by the base patterns
and by assignments such as ``password=...``; everything else looks at all rows.

Skip edges and ties join each occurrence to one hub, the first that a base span labels or
else the first, so a token repeated m times has m - 1 of them and none is more than two
edges from another. Messages go on until they rest. Texts are processed whole and one by one; nothing is shuffled.

Defined cases: a null text is an empty one and has no spans; repeated rows give repeated
rows; a table without marks gives a model without weights, which adds nothing; other
columns are passed through (``redact``) or not read.
"""

from __future__ import annotations

import bisect
import hashlib
import pickle
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.common import released, slices, table, text_or_empty

KINDS = ("email", "ip", "card", "phone", "secret")
BASE_KINDS = KINDS[:4]
LABELS = len(KINDS) + 1  # 0: none
TRAIN_DOCS = 600
CERTAIN = 0.9
BASE_WEIGHT = 8.0  # log-odds that a base span lends its tokens
DAMPING = 0.5
SETTLED = 1e-3  # log-odds: messages that would change by less rest
ROUNDS = 1000  # a guard; from a tenth on, steps get shorter, which ends oscillations
EDGES = 1 << 14  # whose messages are computed at once

_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SECRET = re.compile(r"(?i)(?:password|passwd|pwd|token|secret|api[_-]?key)[\"']?\s{0,3}[=:]\s{0,3}[\"']?([^\s\"']{6,})")
_TOKEN = re.compile(r"[^\s=\"'<>|,;()\[\]{}]+")
_MARK = re.compile(r"[0-9@]")
_CUES = ("passw", "pwd", "token", "secret", "key")  # one is in every match of _SECRET, in lower case
MARKED = "[0-9@]|(?i:password|passwd|pwd|token|secret|api[_-]?key)[\"']?\\s{0,3}[=:]"  # texts that can hold spans
_NUMBER = re.compile(r"[0-9+./-]+")
_JOINT = re.compile(r"[\s()./-]{1,3}")
_UNLIKE_WORDS = re.compile(r"[^A-Za-z]|[a-z][A-Z]")
TIE, OBSERVED = 100.0, 200.0  # log-odds: two mentions of one datum have one label; a mention that a pattern or an assignment labels


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the e-mail pattern, found from their at-signs: the part before must reach up to the sign."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", done)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base patterns, by kind, then start; leftmost, not overlapping within a kind."""
    out = [(0, a, b) for a, b in _emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(int(p[-4:]) <= 255 and len(p.lstrip("0")) <= 3 for p in m[0].split(".")):
            out.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((3, m.start(), m.end()))
    return out


FEATURES = 512


def _bucket(kind: str, value: str, base: int, size: int) -> int:
    return base + zlib.crc32(f"{kind}{value}".encode()) % size


def _shape(core: str) -> str:
    out = []
    for c in core[:40]:
        s = "9" if c in "0123456789" else "a" if c.isalpha() else c
        if not out or out[-1] != s:
            out.append(s)
    return "".join(out)


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def _assignments(text: str) -> list[tuple[int, int, int]]:
    """(start, end, label) of the values of credential assignments."""
    low = text.lower()
    return [(m.start(1), m.end(1), 5) for m in _SECRET.finditer(text)] if any(c in low for c in _CUES) else []


def _mentions(text: str, tokens: list[tuple[int, int]], known: list[tuple[int, int, int]], assigned: list, names: set[str]) -> dict[int, str]:
    """Tokens that belong to a mention of one datum, with the datum: all tokens of a base card or phone; runs of
    tokens whose joined digits are such a number, of a phone also without its country code or behind zeros; and,
    where the text holds a span or an assignment, tokens unlike words that are repeated
    (``names``, the local parts of addresses, may mean someone else and are left to the skip potentials)."""
    out: dict[int, str] = {}
    forms: dict[str, str] = {}
    spans = []
    for k, a, b in known:
        if k in (2, 3):
            digits = _digits(text[a:b])
            spans.append((a, b, forms.setdefault(digits, f"d{digits}")))
            for cut in (1, 2, 3) if k == 3 else ():
                if len(digits) - cut >= 7:
                    forms.setdefault(digits[cut:], f"d{digits}")
    starts = [a for a, _ in tokens]
    for a, b, datum in spans:
        for i in range(max(0, bisect.bisect_right(starts, a) - 1), bisect.bisect_left(starts, b)):
            if tokens[i][1] > a:
                out[i] = datum
    if forms:
        longest = max(map(len, forms)) + 3
        i = 0
        while i < len(tokens):
            joined, j, found = "", i, None
            while j < len(tokens) and j not in out and _NUMBER.fullmatch(text, *tokens[j]) and len(joined) <= longest \
                    and (j == i or _JOINT.fullmatch(text, tokens[j - 1][1], tokens[j][0])):
                joined += _digits(text[slice(*tokens[j])])
                datum = forms.get(joined) or forms.get(joined.lstrip("0"))
                if datum:
                    found = j, datum
                j += 1
            if found:
                out.update((t, found[1]) for t in range(i, found[0] + 1))
                i = found[0]
            i += 1
    if known or assigned:
        times = Counter(c for a, b in tokens if b - a >= 6 and _UNLIKE_WORDS.search(c := text[a:b]))
        for i, (a, b) in enumerate(tokens):
            if i not in out and times.get(text[a:b], 0) > 1 and "@" not in text[a:b] and text[a:b].lower() not in names:
                out[i] = f"t{text[a:b]}"
    return out


class Nodes:
    """The field's nodes of one or more documents: spans, feature indices, edges, known labels."""

    def __init__(self):
        self.spans: list[tuple[int, int, int]] = []  # document, start, end
        self.features: list[list[int]] = []
        self.base: list[int] = []
        self.taught: list[int] = []
        self.assigned: list[int] = []
        self.chain: list[tuple[int, int]] = []
        self.skip: list[tuple[int, int]] = []
        self.tie: list[tuple[int, int]] = []

    def add(self, doc: int, text: str, known: list[tuple[int, int, int]], teach: bool = False) -> None:
        tokens = []
        for m in _TOKEN.finditer(text):
            a, b = m.span()
            while b > a and text[b - 1] in ".:!?-":
                b -= 1
            if b > a:
                tokens.append((a, b))
        marked = [i for i, (a, b) in enumerate(tokens) if _MARK.search(text, a, b)]
        assigned = _assignments(text)
        names = {text[s:text.index("@", s)].lower() for k, s, _ in known if k == 0}
        mentions = _mentions(text, tokens, known, assigned, names)
        marked += mentions
        for a, b, _ in assigned:
            marked += [i for i in range(max(0, bisect.bisect_right(tokens, (a, len(text))) - 1), bisect.bisect_left(tokens, (b, 0))) if tokens[i][1] > a]
        wanted = {j for i in marked for j in range(max(0, i - 2), min(len(tokens), i + 3))}
        if names:
            wanted.update(i for i, (a, b) in enumerate(tokens) if text[a:b].lower() in names)
        cover = sorted((s, e, k + 1) for k, s, e in known)
        lessons = assigned
        at = lesson_at = 0
        seen: dict[str, list[int]] = {}
        tied: dict[str, list[int]] = {}
        previous = -2
        for i in sorted(wanted):
            a, b = tokens[i]
            node = len(self.spans)
            core = text[a:b]
            while at < len(cover) and cover[at][1] <= a:
                at += 1
            label = cover[at][2] if at < len(cover) and cover[at][0] < b else 0
            while lesson_at < len(lessons) and lessons[lesson_at][1] <= a:
                lesson_at += 1
            value = lessons[lesson_at][2] if lesson_at < len(lessons) and lessons[lesson_at][0] < b else 0
            taught = label or (value if teach else 0)
            gap = text[tokens[i - 1][1]:a] if i else ""
            before = text[tokens[i - 1][0]:tokens[i - 1][1]] if i else ""
            after = text[tokens[i + 1][0]:tokens[i + 1][1]] if i + 1 < len(tokens) else ""
            digits = sum(c in "0123456789" for c in core)
            ratio, n = digits / len(core), len(core)
            self.features.append([
                0, 1 + min(7, n // 3), 10 + int(ratio * 5.999), 20 + min(5, core.count(".")), 28 + ("@" in core), 30 + ("+" in core),
                32 + (n >= 12 and not core.strip("0123456789abcdefABCDEF")), 34 + ("=" in gap or ":" in gap), 36 + ('"' in gap or "'" in gap),
                38 + (ratio > 0), _bucket("s", _shape(core), 64, 128), _bucket("p", _shape(before), 192, 64), _bucket("n", _shape(after), 256, 64),
                _bucket("c", before.lower() if "=" in gap else "", 320, 64), 384 + min(31, digits)])
            self.spans.append((doc, a, b))
            self.base.append(label)
            self.taught.append(taught)
            self.assigned.append(0 if label or not _UNLIKE_WORDS.search(core) else value)
            if i == previous + 1:
                self.chain.append((node - 1, node))
            previous = i
            if i in mentions:
                tied.setdefault(mentions[i], []).append(node)
                continue
            key = core.partition("@")[0].lower() if "@" in core or core.lower() in names else \
                _digits(core) if digits >= 5 else None
            if key:
                seen.setdefault(key, []).append(node)
        for same, edges in ((seen, self.skip), (tied, self.tie)):
            for nodes in same.values():
                hub = next((j for j in nodes if self.base[j]), nodes[0])
                edges += [(hub, j) for j in nodes if j != hub]

    def arrays(self):
        edges = lambda e: np.array(e, np.int64).reshape(-1, 2)
        return np.array(self.features, np.int64).reshape(-1, 15), np.array(self.base, np.int64), np.array(self.taught, np.int64), edges(self.chain), edges(self.skip)


def _spread(index: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of rows of ``values`` by ``index``."""
    return np.stack([np.bincount(index, values[:, k], n) for k in range(values.shape[1])], axis=1) if len(index) else np.zeros((n, LABELS))


def train(parts: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Weights (unary, chain, skip) by pseudo-likelihood: each node given its neighbours' labels."""
    if not parts:
        return None
    at = np.cumsum([0, *(len(p[0]) for p in parts)])
    x = np.concatenate([p[0] for p in parts])
    y = np.concatenate([p[2] for p in parts])
    chain = np.concatenate([p[3] + o for p, o in zip(parts, at)])
    skip = np.concatenate([p[4] + o for p, o in zip(parts, at)])
    n = len(y)
    hot = np.eye(LABELS)[y]
    left, right = _spread(chain[:, 1], hot[chain[:, 0]], n), _spread(chain[:, 0], hot[chain[:, 1]], n)
    similar = _spread(skip[:, 1], hot[skip[:, 0]], n) + _spread(skip[:, 0], hot[skip[:, 1]], n)
    prior = 2.0 * np.eye(LABELS)
    params = [np.zeros((FEATURES, LABELS)), np.zeros((LABELS, LABELS)), prior.copy()]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    flat = x.ravel()
    for step in range(1, 121):
        u, a, s = params
        z = u[x].sum(axis=1) + left @ a + right @ a.T + similar @ s
        z -= z.max(axis=1, keepdims=True)
        p = np.exp(z)
        p /= p.sum(axis=1, keepdims=True)
        d = (p - hot) / n
        repeated = np.repeat(d, x.shape[1], axis=0)
        gu = np.stack([np.bincount(flat, repeated[:, k], FEATURES) for k in range(LABELS)], axis=1) + 1e-5 * u
        gs = similar.T @ d
        grads = [gu, left.T @ d + d.T @ right + 1e-4 * a, (gs + gs.T) / 2 + 1e-3 * (s - prior)]
        for i, g in enumerate(grads):  # Adam
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.99 * second[i] + 0.01 * g * g
            params[i] = params[i] - 0.15 * (first[i] / (1 - 0.9 ** step)) / (np.sqrt(second[i] / (1 - 0.99 ** step)) + 1e-8)
    return tuple(params)


def marginals(model, features, base, chain, skip, tie=np.zeros((0, 2), np.int64)) -> np.ndarray:
    """Node marginals by loopy sum-product message passing over chain, skip and tie edges."""
    unary, a, s = model
    n = len(features)
    u = unary[features].sum(axis=1)
    u[np.arange(n), base] += np.where(base > 0, BASE_WEIGHT, 0.0)
    seen = np.unique(np.concatenate([skip, tie]))  # a hub's label is known, however many others it has
    seen = seen[base[seen] > 0]
    u[seen, base[seen]] += OBSERVED
    u -= u.max(axis=1, keepdims=True)
    own = len(skip)
    skip = np.concatenate([skip, tie])
    m1, m2 = len(chain), len(skip)
    src = np.concatenate([chain[:, 0], chain[:, 1], skip[:, 0], skip[:, 1]])
    dst = np.concatenate([chain[:, 1], chain[:, 0], skip[:, 1], skip[:, 0]])
    back = np.concatenate([np.arange(m1) + m1, np.arange(m1), 2 * m1 + m2 + np.arange(m2), 2 * m1 + np.arange(m2)])
    potentials = np.stack([a, a.T, s, TIE * np.eye(LABELS)])
    kind = np.repeat([0, 1, 2, 3, 2, 3], [m1, m1, own, m2 - own, own, m2 - own])  # of each directed edge
    messages = np.zeros((len(src), LABELS))
    live = np.arange(len(src))
    for round_ in range(ROUNDS):
        if not len(live):
            break
        belief = u + _spread(dst, messages, n)
        new = np.empty((len(live), LABELS))
        for at in range(0, len(live), EDGES):
            some = live[at:at + EDGES]
            into = (belief[src[some]] - messages[back[some]])[:, :, None] + potentials[kind[some]]
            top = into.max(axis=1, keepdims=True)
            new[at:at + EDGES] = np.log(np.exp(into - top).sum(axis=1)) + top[:, 0]
        new -= new.max(axis=1, keepdims=True)
        change = new - messages[live]
        messages[live] += (1 - DAMPING) * min(1.0, 0.1 * ROUNDS / (round_ + 1)) * change
        moving = live[np.abs(change).max(axis=1) >= SETTLED]
        stirred, again = np.zeros(n, bool), np.zeros(len(src), bool)
        stirred[dst[moving]] = again[moving] = True
        live = np.flatnonzero(again | stirred[src])
    belief = u + _spread(dst, messages, n)
    belief -= belief.max(axis=1, keepdims=True)
    p = np.exp(belief)
    return p / p.sum(axis=1, keepdims=True)


def detect_texts(texts: list[str], model) -> list[tuple[list, list]]:
    """(base spans, all spans) of each text, as (kind, start, end) by kind, then start."""
    base = [base_spans(t) for t in texts]
    if model is None:
        return [(b, b) for b in base]
    nodes = Nodes()
    for i, (t, b) in enumerate(zip(texts, base, strict=True)):
        nodes.add(i, t, b)
    added: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if nodes.spans:
        features, labels, _, chain, skip = nodes.arrays()
        evidence = np.where(labels > 0, labels, np.array(nodes.assigned, np.int64))
        p = marginals(model, features, evidence, chain, skip, np.array(nodes.tie, np.int64).reshape(-1, 2))
        best = p.argmax(axis=1)
        new = np.flatnonzero((best > 0) & (p.max(axis=1) >= CERTAIN) & (labels == 0))
        before = -2
        for j in new.tolist():
            doc, a, b = nodes.spans[j]
            kind, own = int(best[j]) - 1, added[doc]
            if own and before == j - 1 and own[-1][0] == kind and 0 <= a - own[-1][2] <= 2 and not texts[doc][own[-1][2]:a].strip(" ()-."):
                own[-1] = (kind, own[-1][1], b)  # one datum in several tokens
            else:
                own.append((kind, a, b))
            before = j
    return [(b, sorted(b + a)) for b, a in zip(base, added, strict=True)]


def with_marks(texts: pa.Array) -> np.ndarray:
    """Indices of the texts that hold a digit, an at-sign or a credential cue: no span can be in another."""
    return np.flatnonzero(pc.match_substring_regex(texts, MARKED).to_numpy(zero_copy_only=False))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"):
    """Train on a bounded sample: documents with marks, kept by a hash of their id."""
    marked = docs.select(F.col(id_col).cast("string").alias("id"), text_or_empty(text_col).alias("text"))
    cued = reduce(Column.__or__, [F.lower("text").contains(c) for c in _CUES])  # spares most texts the slower pattern
    marked = marked.where(F.col("text").rlike(_MARK.pattern) | (cued & F.col("text").rlike(MARKED)))
    step = max(1, marked.count() // TRAIN_DOCS)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                nodes = Nodes()
                nodes.add(0, text, base_spans(text), teach=True)
                out.append(pickle.dumps(nodes.arrays()))
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(out, pa.binary())], names=["key", "nodes"])

    key = F.xxhash64(F.coalesce("id", F.lit("")), F.lit("pii"))
    chosen = marked.where(F.pmod(key, F.lit(step)) == 0).select(F.xxhash64("text").alias("key"), "text")
    # the hash keeps about TRAIN_DOCS rows; ids that repeat without end must not enlarge the sample
    rows = chosen.mapInArrow(released(learn), "key long, nodes binary").orderBy("key").limit(2 * TRAIN_DOCS).collect()
    return train([pickle.loads(r.nodes) for r in rows])


def _per_text(batch: pa.RecordBatch, model) -> Iterator[tuple[int, str, list, list]]:
    """(row, text, base spans, all spans) of the rows whose texts have marks."""
    at = with_marks(batch.column("text"))
    texts = batch.column("text").take(pa.array(at)).to_pylist()
    for i, t, (b, s) in zip(at.tolist(), texts, detect_texts(texts, model), strict=True):
        yield i, t, b, s


def spans_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def find_spans(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, base and spans (text ``kind:start:end`` by kind, then start; code points, end
    exclusive) and the counts n_<kind> of the base spans."""
    empty = hashlib.sha256(b"").hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            n = batch.num_rows
            counts = np.zeros((len(BASE_KINDS), n), np.int64)
            base, shas, spans = [""] * n, [empty] * n, [""] * n
            for i, _, b, s in _per_text(batch, model):
                for k, _, _ in b:
                    counts[k, i] += 1
                base[i], spans[i] = spans_text(b), spans_text(s)
                shas[i] = hashlib.sha256(base[i].encode()).hexdigest()
            yield pa.RecordBatch.from_arrays([batch.column("id"), *[pa.array(c) for c in counts], pa.array(base), pa.array(shas), pa.array(spans)],
                                             names=["id", *[f"n_{k}" for k in BASE_KINDS], "base", "base_sha256", "spans"])

    src = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    schema = f"id long, {', '.join(f'n_{k} long' for k in BASE_KINDS)}, base string, base_sha256 string, spans string"
    return src.mapInArrow(released(run), schema).withColumnRenamed("id", id_col)


def redact(docs: DataFrame, model, text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """``docs`` with every span of its text replaced by ``<KIND>``; overlapping spans are replaced as
    one, by the kind of the first. ``length_col``, if there, takes the new length of changed texts. All
    other columns stay; texts without spans (null ones too) stay as they are."""
    schema = docs.schema
    place = docs.columns.index(text_col)
    length_place = docs.columns.index(length_col) if length_col else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            column = batch.column(place)
            texts, changed = column.to_pylist(), set()
            plain = pa.RecordBatch.from_arrays([pc.fill_null(column, "")], names=["text"])
            for i, text, _, spans in _per_text(plain, model):
                if not spans:
                    continue
                out, done = [], 0
                for a, b, k in sorted((a, b, k) for k, a, b in spans):
                    if a >= done:
                        out += [text[done:a], f"<{KINDS[k].upper()}>"]
                    done = max(done, b)
                texts[i] = "".join(out) + text[done:]
                changed.add(i)
            columns = list(batch.columns)
            columns[place] = pa.array(texts, column.type)
            if length_place is not None:
                old = columns[length_place]
                columns[length_place] = pa.array([len(texts[i]) if i in changed else n for i, n in enumerate(old.to_pylist())], old.type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(released(run), schema)


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return find_spans(docs, fit(docs)).select("doc_id", *[f"n_{k}" for k in BASE_KINDS], "base_sha256", "spans")
