"""License scan by ordered signature rules (operator 5), in SQL functions only.

A text is lower-cased (A-Z) and read as words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``. Texts
without any anchor word (license, spdx, cc, ...) are done after one regex search. In
the others each anchor word opens a context of words around it, in which ``@`` marks
the anchor; a rule is a regex over that context. Rules of a license family run only
where the family's key occurs. The detections of a text, each an interval of words,
are folded in order of their start: one that lies inside an interval of the same or a
higher priority is dropped, unless it is a base phrase.

Nothing is shuffled and no rows are multiplied, so hot lines or long texts only cost
their own length. Defined cases: null and empty texts have no words, no labels and
score 0; repeated rows give repeated rows; other columns are not read; an empty table
gives an empty result. Contexts are as wide as the longest rule, so none is cut short.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.common import table, text_or_empty

#: Words and separators of the raw text, before lower-casing.
RAW_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ANCHORS = ("license", "licence", "licenses", "licensed", "licenced", "unlicense", "unlicensed", "spdx", "cc", "cc0", "gpl", "lgpl", "agpl",
           "gplv2", "gplv3", "wtfpl", "mpl", "epl", "eupl", "cddl", "permission", "redistribution", "domain", "reserved")

#: Base phrases (fixed values): phrase with its anchor marked, label.
BASE = (("under the mit @license", "mit"), ("apache @license version 2", "apache-2"), ("@cc by nc", "cc-by-nc"))

V = "(?:(?:version|v|ver) ?)?"
L = "{m}licen[sc]e"
#: Family: label, key that its contexts hold, regex of its full name ({m} stands before the anchor), short name.
FAMILIES = (
    ("mit", "mit", f"mit(?: x11)? {L}", "mit"),
    ("mit", "expat", f"expat(?: mit)? {L}", "expat"),
    ("mit-0", "mit", f"mit (?:0|no attribution) {L}", "mit 0"),
    ("apache-1.1", "apache", f"apache(?: software)? {L} {V}1 1", "apache 1 1"),
    ("apache-2", "apache", f"apache(?: software)? {L} {V}2(?: 0)?", "apache ?2(?: 0)?"),
    ("bsd-2-clause", "bsd", f"(?:simplified bsd|freebsd|bsd 2 clause|2 clause bsd|two clause bsd) {L}", "bsd 2 clause"),
    ("bsd-3-clause", "bsd", f"(?:new bsd|revised bsd|modified bsd|bsd 3 clause|3 clause bsd|three clause bsd) {L}", "bsd 3 clause"),
    ("bsd-4-clause", "bsd", f"(?:original bsd|bsd 4 clause|4 clause bsd) {L}", "bsd 4 clause"),
    ("isc", "isc", f"isc {L}", "isc"),
    ("zlib", "zlib", f"zlib(?: libpng)? {L}", "zlib"),
    ("gpl-2", "g", f"(?:gnu )?(?:general public|gpl) {L} {V}2(?: 0)?", "gpl ?v?2(?: 0)?"),
    ("gpl-3", "g", f"(?:gnu )?(?:general public|gpl) {L} {V}3(?: 0)?", "gpl ?v?3(?: 0)?"),
    ("lgpl-2.1", "g", f"(?:gnu )?(?:lesser|library) general public {L} {V}2(?: 1| 0)?", "lgpl ?v?2(?: 1| 0)?"),
    ("lgpl-3", "g", f"(?:gnu )?lesser general public {L} {V}3(?: 0)?", "lgpl ?v?3(?: 0)?"),
    ("agpl-3", "g", f"(?:gnu )?affero general public {L}(?: {V}3(?: 0)?)?", "agpl ?v?3(?: 0)?"),
    ("gfdl", "g", f"(?:gnu )?free documentation {L}", "gfdl(?: 1 [0-9])?"),
    ("mpl-1.1", "m", f"mozilla public {L} {V}1 1", "mpl 1 1"),
    ("mpl-2", "m", f"mozilla public {L} {V}2(?: 0)?", "mpl 2(?: 0)?"),
    ("epl-1", "e", f"eclipse public {L} {V}1(?: 0)?", "epl 1(?: 0)?"),
    ("epl-2", "e", f"eclipse public {L} {V}2(?: 0)?", "epl 2(?: 0)?"),
    ("eupl", "eu", f"(?:european union public|eupl) {L}(?: {V}1 [0-9])?", "eupl(?: 1 [0-9])?"),
    ("cddl", "c", f"common development and distribution {L}(?: {V}1 [01])?", "cddl(?: 1 [01])?"),
    ("cc0", "cc", "{m}cc0(?: 1 0)?(?: universal)?", "cc0(?: 1 0)?"),
    ("cc-by", "cc", "{m}cc by [1-4] [05]", "cc by [1-4] [05]"),
    ("cc-by-sa", "cc", "{m}cc by sa(?: [1-4] [05])?", "cc by sa(?: [1-4] [05])?"),
    ("cc-by-nd", "cc", "{m}cc by nd(?: [1-4] [05])?", "cc by nd(?: [1-4] [05])?"),
    ("cc-by-nc", "cc", "{m}cc by nc(?: [1-4] [05])?", "cc by nc(?: [1-4] [05])?"),
    ("cc-by-nc-sa", "cc", "{m}cc by nc sa(?: [1-4] [05])?", "cc by nc sa(?: [1-4] [05])?"),
    ("cc-by-nc-nd", "cc", "{m}cc by nc nd(?: [1-4] [05])?", "cc by nc nd(?: [1-4] [05])?"),
    ("cc-by", "creative", f"creative commons attribution(?: [1-4] [05])?(?: international| unported)? {L}", "creative commons attribution"),
    ("cc-by-sa", "creative", f"creative commons attribution share ?alike(?: [1-4] [05])?(?: international| unported)? {L}", "creative commons attribution share ?alike"),
    ("cc-by-nc", "creative", f"creative commons attribution non ?commercial(?: [1-4] [05])?(?: international| unported)? {L}", "creative commons attribution non ?commercial"),
    ("unlicense", "unlicense", "{m}unlicense", "unlicense"),
    ("wtfpl", "wtfpl", "{m}wtfpl(?: 2)?", "wtfpl"),
    ("artistic-2", "artistic", f"artistic {L} {V}2(?: 0)?", "artistic 2(?: 0)?"),
    ("bsl-1", "b", f"boost software {L}(?: {V}1(?: 0)?)?", "bsl 1(?: 0)?"),
    ("ofl-1.1", "o", f"(?:sil )?open font {L}(?: {V}1 1)?", "ofl(?: 1 1)?"),
    ("odbl", "o", f"open (?:data commons open )?database {L}(?: {V}1 0)?", "odbl(?: 1 0)?"),
    ("ms-pl", "m", f"microsoft public {L}", "ms pl"),
    ("psf-2", "p", f"(?:psf|python software foundation) {L}(?: {V}2)?", "psf(?: 2)?"),
    ("postgresql", "postgresql", f"postgresql {L}", "postgresql"),
    ("ncsa", "ncsa", f"(?:university of illinois )?ncsa(?: open source)? {L}", "ncsa"),
)

OF = "(?:(?:the )?terms (?:and conditions )?of )?(?:the )?"
#: Template: name, priority, confidence, regex over {name} (anchor marked), {plain} (anchor elsewhere), {short}.
TEMPLATES = (
    ("not", 5, 0.0, f"not @licen[sc]ed under {OF}" "{plain}"),
    ("spdx", 4, 1.0, "@spdx licen[sc]e identifier {short}"),
    ("licensed", 3, 0.95, f"(?:(?:is|are|be|dual|work|code) ){{0,4}}@licen[sc]ed (?:to you )?under {OF}" "(?:{plain}|{short})"),
    ("released", 3, 0.9, f"(?:released|distributed|available|published|provided|covered|redistributed) under {OF}" "{name}"),
    ("terms", 3, 0.85, "(?:subject to|governed by|in accordance with|in compliance with) (?:the )?(?:terms of )?(?:the )?{name}"),
    ("field", 2, 0.8, "@licen[sc]e(?: is)? {short}"),
    ("copy", 2, 0.7, "(?:copy of|see|read) the {name}"),
    ("or later", 2, 0.75, "{name} or (?:\\(at your option\\) )?(?:any )?later"),
    ("name", 1, 0.6, "{name}"),
)


@dataclass(frozen=True)
class Rule:
    family: str
    template: str
    priority: int
    label: str | None
    confidence: float
    regex: str


def _rules() -> dict[str, list[Rule]]:
    """The rules by key: every family under every template, and a few grants without a family name."""
    out: dict[str, list[Rule]] = {}
    for label, key, name, short in FAMILIES:
        for template, priority, confidence, regex in TEMPLATES:
            text = (regex.replace("{name}", name.replace("{m}", "@")).replace("{plain}", name.replace("{m}", "")).replace("{short}", short))
            text = text.replace("\\(at your option\\) ", "at your option ")
            out.setdefault(key, []).append(Rule(label, template, priority, None if template == "not" else label, confidence, text))
    grants = (
        ("mit", "permission", 0.9, "@permission is hereby granted free of charge to any person obtaining a copy"),
        ("isc", "permission", 0.9, "@permission to use copy modify and or distribute this software"),
        ("bsd", "redistribution", 0.8, "@redistribution and use in source and binary forms"),
        ("public-domain", "domain", 0.7, "(?:(?:in|into|to) the )?public @domain"),
        ("proprietary", "reserved", 0.4, "all rights @reserved"),
        ("proprietary", "unlicensed", 0.0, "@unlicensed"),
    )
    for label, key, confidence, regex in grants:
        out.setdefault(key, []).append(Rule(label, "grant", 2, label, confidence, regex))
    return out


RULES = _rules()
LEVELS = 1 + max(t[1] for t in TEMPLATES)


def longest(regex: str) -> str:
    """A text of the most words that a rule's regex matches: every option taken, every repeat as often as allowed."""
    def choice(at: int) -> tuple[str, int]:
        best, own = "", ""
        while at < len(regex) and regex[at] != ")":
            if regex[at] == "|":
                best, own, at = max(best, own, key=lambda x: (x.count(" "), len(x))), "", at + 1
                continue
            if regex[at] == "(":
                unit, at = choice(at + 3)  # groups are all (?: )
                at += 1
            elif regex[at] == "[":
                unit, at = regex[at + 1], regex.index("]", at) + 1
            else:
                unit, at = regex[at], at + 1
            times = 1
            if regex[at:at + 1] == "?":
                at += 1
            elif regex[at:at + 1] == "{":
                end = regex.index("}", at)
                times, at = int(regex[at + 1:end].split(",")[1]), end + 1
            own += unit * times
        return max(best, own, key=lambda x: (x.count(" "), len(x))), at

    return choice(0)[0]


def _reach() -> tuple[int, int]:
    """Words before and after an anchor that a rule can take in at most."""
    texts = [longest(r) for r in [*(b for b, _ in BASE), *(r.regex for rules in RULES.values() for r in rules)]]
    return tuple(max(t.split("@")[i].count(" ") for t in texts) for i in (0, 1))


LEFT, RIGHT = _reach()  # words of context around an anchor: no rule needs more


def _hit(regex: str, priority: int, confidence: float, label: str | None, base: bool) -> str:
    quoted = f"'{label}'" if label else "CAST(NULL AS STRING)"
    return (f"named_struct('m', regexp_extract(x.ctx, '(?:^| )({regex})(?= |$)', 1), 'p', {priority}, "
            f"'c', CAST({confidence} AS DOUBLE), 'label', {quoted}, 'base', {str(base).lower()})")


def _contexts() -> str:
    """SQL: (pos, ctx) of each anchor word of ``_text``; the words are bound once as ``w``."""
    anchors = ", ".join(f"'{a}'" for a in ANCHORS)
    words = f"split(trim(regexp_replace(translate(_text, '{UPPER}', '{LOWER}'), r'{SEPARATORS}', ' ')), ' ')"
    return (f"element_at(transform(array({words}), w -> transform(filter(sequence(0, size(w) - 1), i -> get(w, i) IN ({anchors})), "
            f"i -> named_struct('pos', i, 'ctx', concat_ws(' ', slice(w, greatest(i - {LEFT}, 0) + 1, least(i, {LEFT})), "
            f"concat('@', get(w, i)), slice(w, i + 2, {RIGHT}))))), 1)")


def _detections() -> str:
    """SQL: sorted detections (start, -end, -priority, label, confidence, base) of the contexts ``_contexts``."""
    base = [_hit(regex, LEVELS, 1.0, label, True) for regex, label in BASE]
    groups = [f"array({', '.join(base)})"]
    for key, rules in RULES.items():
        hits = ", ".join(_hit(r.regex, r.priority, r.confidence, r.label, False) for r in rules)
        groups.append(f"IF(contains(x.ctx, '{key}'), array({hits}), array())")
    spaces = lambda s: f"(length({s}) - length(replace({s}, ' ', '')))"
    found = (f"transform(filter(flatten(array({', '.join(groups)})), d -> d.m <> ''), d -> named_struct("
             f"'s', x.pos - {spaces("substring_index(d.m, '@', 1)")}, "
             f"'ne', -(x.pos + {spaces("substring_index(d.m, '@', -1)")}), 'np', -d.p, 'label', d.label, 'c', d.c, 'base', d.base))")
    return f"array_sort(flatten(transform(_contexts, x -> {found})))"


def _kept() -> str:
    """SQL: fold of the detections to (ends by priority, labels, score), dropping contained ones."""
    ends = ", ".join(f"'e{p}', -1" for p in range(LEVELS + 1))
    reach = "CASE -d.np " + " ".join(f"WHEN {p} THEN a.e{p}" for p in range(LEVELS + 1)) + " END"
    moved = ", ".join(f"'e{p}', IF(-d.np >= {p}, greatest(a.e{p}, -d.ne), a.e{p})" for p in range(LEVELS + 1))
    same = ", ".join(f"'e{p}', a.e{p}" for p in range(LEVELS + 1))
    return (f"aggregate(_detections, named_struct({ends}, 'labels', CAST(array() AS ARRAY<STRING>), 'score', CAST(0 AS DOUBLE)), "
            f"(a, d) -> IF(NOT d.base AND {reach} >= -d.ne, named_struct({same}, 'labels', a.labels, 'score', a.score), "
            f"named_struct({moved}, 'labels', IF(d.label IS NULL, a.labels, array_union(a.labels, array(d.label))), "
            f"'score', greatest(a.score, d.c))))")


def gate() -> str:
    inside = RAW_WORD.removesuffix("+")
    return f"(?i)(?<!{inside})(?:{'|'.join(ANCHORS)})(?!{inside})"


def scan(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """The ``keep`` columns, then n_words, detections (array of s, ne, np, label, c, base: first word,
    minus last word, minus priority, ...), labels (array, after suppression) and score."""
    text: Column = text_or_empty(text_col)
    gated = docs.select(*keep, text.alias("_text")).select(
        *keep, F.regexp_count("_text", F.lit(RAW_WORD)).cast("long").alias("n_words"),
        F.expr(f"IF(_text RLIKE r'{gate()}', {_contexts()}, array())").alias("_contexts"))
    found = gated.select(*keep, "n_words", F.expr(_detections()).alias("_detections"))
    return found.select(*keep, "n_words", F.col("_detections").alias("detections"), F.expr(_kept()).alias("_kept")).select(
        *keep, "n_words", "detections", F.col("_kept.labels").alias("labels"), F.col("_kept.score").alias("score"))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    base = "filter(detections, d -> d.base)"
    return scan(docs, ["doc_id"]).select(
        "doc_id", "n_words", F.expr(f"CAST(size({base}) AS BIGINT)").alias("n_base"),
        F.expr(f"CAST(array_min(transform({base}, d -> d.s)) AS BIGINT)").alias("first_word"),
        F.expr(f"CAST(array_max(transform({base}, d -> d.s)) AS BIGINT)").alias("last_word"),
        F.expr(f"concat_ws(',', sort_array(array_distinct(transform({base}, d -> d.label))))").alias("base_labels"),
        F.expr("concat_ws(',', sort_array(labels))").alias("labels"), "score")


def oracle_sql() -> str:
    """The same scan in DuckDB SQL, from the same rules: detections as rows, suppression by a join."""
    rows = [(regex, LEVELS, 1.0, label, True, "") for regex, label in BASE]
    rows += [(r.regex, r.priority, r.confidence, r.label, False, key) for key, rules in RULES.items() for r in rules]
    values = ", ".join(f"('{x}', {p}, {c}::DOUBLE, {f"'{label}'" if label else 'NULL'}, {base}, '{key}')" for x, p, c, label, base, key in rows)
    anchors = ", ".join(f"'{a}'" for a in ANCHORS)
    spaces = lambda s: f"(length({s}) - length(replace({s}, ' ', '')))"
    return f"""
    WITH rules(regex, p, c, label, base, key) AS (VALUES {values}),
    w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
    anchored AS (SELECT doc_id, ws, unnest(list_filter(range(1, len(ws) + 1), lambda i: ws[i] IN ({anchors}))) AS i FROM w),
    ctx AS (SELECT doc_id, i - 1 AS pos, array_to_string(list_concat(ws[greatest(i - {LEFT}, 1):i - 1], ['@' || ws[i]], ws[i + 1:i + {RIGHT}]), ' ') AS ctx FROM anchored),
    hit AS (SELECT doc_id, pos, p, c, label, base, regexp_extract(ctx, '(?:^| )(' || regex || ')(?: |$)', 1) AS m FROM ctx JOIN rules ON contains(ctx, key)),
    det AS (SELECT doc_id, p, c, label, base, pos - {spaces("split_part(m, '@', 1)")} AS s, pos + {spaces("split_part(m, '@', 2)")} AS e FROM hit WHERE m <> ''),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY s, e DESC, p DESC, label NULLS FIRST, c, base) AS rn FROM det),
    kept AS (SELECT * FROM ranked d WHERE base OR NOT EXISTS (SELECT 1 FROM ranked o WHERE o.doc_id = d.doc_id AND o.rn < d.rn AND o.p >= d.p AND o.e >= d.e)),
    sums AS (SELECT doc_id, count(*) FILTER (WHERE base) AS n_base, min(s) FILTER (WHERE base) AS first_word, max(s) FILTER (WHERE base) AS last_word,
                    array_to_string(list_sort(list(DISTINCT label) FILTER (WHERE base)), ',') AS base_labels,
                    array_to_string(list_sort(list(DISTINCT label) FILTER (WHERE label IS NOT NULL)), ',') AS labels, max(c) AS score FROM kept GROUP BY doc_id)
    SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
           coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score
    FROM w LEFT JOIN sums USING (doc_id)
    """
