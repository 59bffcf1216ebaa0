"""Secret scans through a trigram inverted index, in DataFrame functions only.

From each rule's regular expression a Boolean query over three-letter sequences is derived
that every match fulfils. An index lists, for each such sequence, the documents that hold it
(letters lower-cased); the lists are intersected and united as the queries say, and a rule's
expression runs on its candidates only. Rules without a mandatory sequence run on every text.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from itertools import product
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.llm.common import staged


@dataclass(frozen=True)
class Rule:
    """``kind`` names the spans. A match counts if ``group`` of it has ``least`` characters;
    a shorter one still takes its text."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0


def any_case(word: str) -> str:
    """The word with its letters in either case, spelled out: folding differs by engine."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(any_case(word) for word in ("password", "passwd", "secret", "token"))
_API = any_case("api") + "_?" + any_case("key")

BASE = (
    Rule(
        "assign",
        rf"""({_NAMES}|{_API})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        least=8,
        group=2,
    ),
    Rule("access", "AKIA[A-Z0-9]+", least=16),
    # A run is taken whole, so asking for 32 at once finds the runs of 32 or more.
    Rule("hex", "[0-9a-f]{32,}", least=32),
)

# What follows a private key's first line: all up to its last line, or, if that is missing,
# header lines and the lines of base64. The body holds single hyphens only, a few of them, so
# no search goes on past the next header. Bounded repeats: no engine runs out of stack.
_BODY = r"[A-Za-z0-9+/=\x09-\x0D\x20:,\\\"']"
_TO_END = rf"{_BODY}*(?:-{_BODY}+){{0,12}}-----END[A-Z\x20]*-{{0,5}}"
_LINES = (
    r"(?:[\x0A\x0D]+[A-Za-z-]+:\x20[^\x0A\x0D]*){0,5}[\x09-\x0D\x20\\\"']*[A-Za-z0-9+/=]{16}[A-Za-z0-9+/=\x0A\x0D\\]*"
    r"(?:[\x09\x20\"',+]+[A-Za-z0-9+/=]{16}[A-Za-z0-9+/=\x0A\x0D\\]*){0,60}"
)

# Fixed forms of public services' credentials.
MORE = (
    Rule("private_key", rf"-----BEGIN[A-Z\x20]*PRIVATE\x20KEY-----(?:{_TO_END}|{_LINES})?"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", least=30),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", least=40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", least=15),
    Rule("google", r"AIza[A-Za-z0-9_-]+", least=39),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]+", least=24),
)

RULES = BASE + MORE

# --- Boolean trigram queries -------------------------------------------------------------

# A query is a list of clauses, all of which hold; a clause is a set of alternatives, one of
# which holds; an alternative is a set of trigrams, all of which occur. No clause: any text.
Query = list[frozenset[frozenset[str]]]
MOST_STRINGS = 64


def trigram_query(pattern: str) -> Query:
    return _sequence(parser.parse(pattern))


def _sequence(items: object) -> Query:
    clauses: Query = []
    run = {""}
    for item in items:
        exact = _strings(item)
        if exact is not None and len(run) * len(exact) <= MOST_STRINGS:
            run = {a + b for a in run for b in exact}
            continue
        clauses += _clause(run) + (_inside(item) if exact is None else _clause(exact))
        run = {""}
    return clauses + _clause(run)


def _clause(strings: set[str]) -> Query:
    """What texts with one of these strings must hold; nothing if one is too short."""
    if any(len(string) < 3 for string in strings):
        return []
    every = {frozenset(string[i : i + 3] for i in range(len(string) - 2)) for string in strings}
    return [frozenset(one for one in every if not any(other < one for other in every))]


def _strings(item: tuple) -> set[str] | None:
    """All strings, lower-cased, that this part of an expression matches, if they are few."""
    kind, value = str(item[0]), item[1]
    if kind == "LITERAL":
        return {chr(value).lower()}
    if kind == "IN":
        if all(str(what) == "LITERAL" for what, _ in value):
            found = {chr(code).lower() for _, code in value}
            return found if len(found) <= 4 else None
        return None
    if kind == "SUBPATTERN":
        return _joined([_strings(part) for part in value[-1]])
    if kind == "BRANCH":
        parts = [_joined([_strings(part) for part in branch]) for branch in value[1]]
        return None if any(part is None for part in parts) else set().union(*parts)
    if kind == "MAX_REPEAT":
        low, high, inner = value
        once = _joined([_strings(part) for part in inner])
        if once is None or int(high) > 4:
            return None
        return set().union(*(_joined([once] * n) or set() for n in range(low, int(high) + 1)))
    return None


def _joined(parts: list[set[str] | None]) -> set[str] | None:
    found = {""}
    for part in parts:
        if part is None or len(found) * len(part) > MOST_STRINGS:
            return None
        found = {a + b for a, b in product(found, part)}
    return found


def _inside(item: tuple) -> Query:
    kind, value = str(item[0]), item[1]
    if kind == "SUBPATTERN":
        return _sequence(value[-1])
    if kind == "MAX_REPEAT" and value[0] >= 1:
        return _sequence(value[2])
    if kind == "BRANCH":
        each = [_sequence(branch) for branch in value[1]]
        return [frozenset().union(*(query[0] for query in each))] if all(each) else []
    return []


def trigrams_of(rules: tuple[Rule, ...]) -> list[str]:
    return sorted({t for r in rules for clause in trigram_query(r.pattern) for one in clause for t in one})


# --- the index ---------------------------------------------------------------------------


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """The inverted index (trigram, doc_id), as a written table sorted by trigram within each
    file. Texts are read whole; null texts hold nothing."""
    low = docs.select("doc_id", F.lower("text").alias("low"))
    held = F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams])
    listed = low.select("doc_id", F.explode(F.array_compact(held)).alias("trigram"))
    return staged(listed.select("trigram", "doc_id").sortWithinPartitions("trigram"), "trigrams")


def candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(doc_id, kinds): the rules with a trigram query that a document's postings fulfil. A
    document's lists meet in a partial aggregation: one small row leaves each task."""
    queries = {rule.kind: trigram_query(rule.pattern) for rule in rules}
    held = index.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.collect_set("trigram").alias("held"))
    kinds = [F.when(_holds(query), F.lit(kind)) for kind, query in queries.items() if query]
    if not kinds:
        return held.select("doc_id", F.array().cast("array<string>").alias("kinds")).limit(0)
    return held.select("doc_id", F.array_compact(F.array(*kinds)).alias("kinds")).filter(F.size("kinds") > 0)


def _holds(query: Query) -> Column:
    whole = F.lit(True)
    for clause in query:
        some = F.lit(False)
        for alternative in sorted(map(sorted, clause)):
            every = F.lit(True)
            for trigram in alternative:
                every = every & F.array_contains("held", trigram)
            some = some | every
        whole = whole & some
    return whole


# --- verification ------------------------------------------------------------------------

SPAN = "struct<start:int,rank:int,end:int,kind:string>"


def _given(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once: inside functions of functions a column
    would be computed at every step."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running(values: Column, merge: Callable[[Column, Column], Column]) -> Column:
    """For each of some whole numbers, what merging all before it gives, from 0 on.

    An array that grows by one is copied whole, so the numbers are merged in parts of the
    square root of their count: first each part, then the parts, then within each again.
    """
    zero = F.lit(0)
    grown = lambda part, start: F.aggregate(
        part, F.array(start), lambda all_, x: F.concat(all_, F.array(merge(F.element_at(all_, -1), x)))
    )

    def whole(every: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(every))).cast("int")
        cut = F.transform(F.sequence(zero, F.floor((F.size(every) - 1) / width).cast("int")), lambda c: F.slice(every, c * width + 1, width))
        return _given(cut, lambda parts: F.flatten(F.zip_with(
            parts,
            F.slice(grown(F.transform(parts, lambda part: F.aggregate(part, zero, merge)), zero), 1, F.size(parts)),
            lambda part, start: F.slice(grown(part, start), 1, F.size(part)),
        )))

    return _given(values, lambda every: F.when(F.size(every) > 0, whole(every)).otherwise(every))


def _spans(text: Column, rule: Rule, rank: int, unit: Callable[[Column], Column]) -> Column:
    """The counting matches of a rule in a text. The pieces between the matches give the
    positions."""
    pattern = F.lit(rule.pattern)
    found = F.struct(
        F.transform(F.split(text, rule.pattern, -1), unit).alias("gaps"),
        F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), unit).alias("sizes"),
        F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.length).alias("counted"),
    )

    def placed(all_: Column) -> Column:
        gaps = F.slice(all_["gaps"], 1, F.size(all_["sizes"]))
        before = _running(F.zip_with(gaps, all_["sizes"], lambda gap, size: gap + size), lambda a, b: a + b)
        starts = F.zip_with(before, gaps, lambda at, gap: at + gap)
        spans = F.zip_with(starts, F.arrays_zip(all_["sizes"].alias("size"), all_["counted"].alias("counted")), lambda start, m: F.struct(
            start.alias("start"), F.lit(rank).alias("rank"), (start + m["size"]).alias("end"), F.lit(rule.kind).alias("kind"),
            m["counted"].alias("counted"),
        ))
        kept = F.filter(spans, lambda s: s["counted"] >= rule.least)
        return F.transform(kept, lambda s: F.struct(*[s[name].alias(name) for name in ("start", "rank", "end", "kind")]))

    return _given(found, placed)


def find_secrets(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, into: str = "spans", unit: Callable[[Column], Column] = F.length
) -> DataFrame:
    """The rows of ``docs`` (doc_id, text and any other columns) with a column ``into``, an
    array of (start, rank, end, kind) by start and then rule; empty for null and clean texts.
    A column of ``docs`` with that name is replaced. Positions are in code points, or, with
    ``unit`` octet_length, in bytes.

    Repeated rows stay repeated. Rows without doc_id are not in the index and are scanned
    by every rule.
    """
    index = postings(docs, trigrams_of(rules))
    found = staged(candidates(index, rules), "secret-candidates")
    # A written table has a known size: Spark sends it to the tasks only if it is small.
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    rows = rows.join(found, rows["row.doc_id"] == found["doc_id"], "left").select("row", "kinds")
    text, kinds = F.col("row.text"), F.col("kinds")
    none = F.array().cast(f"array<{SPAN}>")
    spans = []
    for rank, rule in enumerate(rules):
        here = F.regexp_like(text, F.lit(rule.pattern))
        if trigram_query(rule.pattern):
            asked = F.col("row.doc_id").isNull() | F.coalesce(F.array_contains(kinds, rule.kind), F.lit(False))
            here = asked & here
        spans.append(F.when(here, _spans(text, rule, rank, unit)).otherwise(none))
    kept = [F.col("row")[c].alias(c) for c in docs.columns if c != into]
    return rows.select(*kept, F.array_sort(F.concat(*spans)).alias(into))


def listed(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every run of overlapping spans, in bytes and by start, replaced by a
    mark. Bytes are cut where they lie; characters would be counted from the front each time."""

    def cut(all_: Column) -> Column:
        spans_, whole = all_["spans"], all_["bytes"]
        reached = _running(F.transform(spans_, lambda s: s["end"]), lambda a, b: F.greatest(a, b))
        runs = F.filter(
            F.zip_with(spans_, reached, lambda s, at: F.struct(s["start"].alias("start"), at.alias("at"))),
            lambda r: r["start"] >= r["at"],
        )
        gaps = F.transform(runs, lambda r: F.substring(whole, r["at"] + 1, r["start"] - r["at"]).cast("string"))
        last = F.array_max(F.transform(spans_, lambda s: s["end"]))
        rest = F.substring(whole, last + 1, F.length(whole)).cast("string")
        return F.concat(F.array_join(gaps, mark), F.lit(mark), rest)

    both = F.struct(text.cast("binary").alias("bytes"), spans.alias("spans"))
    return F.when(F.size(spans) > 0, _given(both, cut)).otherwise(text)


def redact_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with every secret replaced in ``text`` and ``n_chars`` counted anew for the
    texts that changed. No row goes."""
    spans = "secret spans"
    found = find_secrets(docs, rules, spans, F.octet_length)
    clean = redacted(F.col("text"), F.col(spans))
    columns = [
        clean.alias("text") if c == "text"
        else F.when(F.size(spans) > 0, F.length(clean)).otherwise(F.col(c)).cast(docs.schema[c].dataType).alias(c)
        if c == "n_chars"
        else F.col(c)
        for c in docs.columns
    ]
    return found.select(*columns)


def oracle(rules: tuple[Rule, ...] = RULES, base: int = len(BASE)) -> str:
    """DuckDB SQL for the digest query, with every rule run on every text."""
    matches, parts = [], []
    for rank, rule in enumerate(rules):
        pattern = "'" + rule.pattern.replace("'", "''") + "'"
        sizes = "list_transform({0}, lambda x: length(x))"
        matches.append(
            f"""{sizes.format(f"string_split_regex(t, {pattern})")} AS gaps{rank},
            {sizes.format(f"regexp_extract_all(t, {pattern})")} AS sizes{rank},
            {sizes.format(f"regexp_extract_all(t, {pattern}, {rule.group})")} AS counted{rank}"""
        )
        parts.append(
            f"""list_filter(list_transform(range(1, len(sizes{rank}) + 1), lambda i: {{
            'start': list_sum(gaps{rank}[1:i]) + coalesce(list_sum(sizes{rank}[1:i-1]), 0),
            'rank': {rank}, 'size': sizes{rank}[i], 'kind': '{rule.kind}',
            'counted': counted{rank}[i]}}), lambda s: s.counted >= {rule.least})"""
        )
    show = "list_transform({0}, lambda s: s.kind || ':' || s.start::bigint || ':' || (s.start + s.size)::bigint)"
    counts = ", ".join(f"len(list_filter(every, lambda x: x.kind = '{r.kind}'))::bigint AS n_{r.kind}" for r in rules[:base])
    return f"""
    WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    cut AS (SELECT doc_id, {", ".join(matches)} FROM texts),
    found AS (SELECT doc_id, list_sort(flatten([{", ".join(parts)}])) AS every FROM cut)
    SELECT doc_id, {counts},
        sha256(array_to_string({show.format(f"list_filter(every, lambda x: x.rank < {base})")}, ',')) AS base_sha256,
        array_to_string({show.format("every")}, ',') AS spans
    FROM found"""
