"""Secret scans with a trigram inverted index, in DataFrame functions only.

Each rule's regular expression is turned into a Boolean query over trigrams. Postings of the trigrams
that the queries use are intersected per document, the documents that satisfy a rule's query are
verified with the rule itself, and rules without mandatory trigrams scan every text.

Spans come from ``split``: the pieces between leftmost non-overlapping matches give the places.

Defined results: a null text counts as empty and has no spans; null and repeated ids are scanned like
any other (postings of rows that share an id are united, verification decides per row); overlapping
spans of different kinds are all reported, and masked as one; an empty table gives an empty result;
further columns are ignored by ``secret_spans`` and kept by ``mask_secrets``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import product
from re import _constants as sre
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD_BITS = 60  # trigrams in one long of a document's index word
_MOST_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    """``pattern`` in the syntax that Java and Python share; a match counts if ``group`` is long enough."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    base: bool = False

    @property
    def fast(self) -> str:
        return self.pattern


BASE_RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2, True),
    # runs are taken whole, so a least length in the pattern drops the same matches
    Rule("access", r"AKIA[A-Z0-9]{16,}", base=True),
    Rule("hex", r"[0-9a-f]{24,}", base=True),
)
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
)
RULES = BASE_RULES + MORE_RULES


def _exact(item) -> set[str] | None:
    """All strings an item can match, if they are few."""
    op, arg = item
    if op is sre.LITERAL:
        return {chr(arg)}
    if op is sre.IN:
        chars: set[str] = set()
        for kind, value in arg:
            if kind is sre.LITERAL:
                chars.add(chr(value))
            elif kind is sre.RANGE and value[1] - value[0] < 8:
                chars |= {chr(c) for c in range(value[0], value[1] + 1)}
            else:
                return None
        return chars if len(chars) <= 8 else None
    if op is sre.SUBPATTERN:
        return _strings(arg[-1])
    if op is sre.BRANCH:
        parts = [_strings(p) for p in arg[1]]
        return None if any(p is None for p in parts) else set().union(*parts)
    if op is sre.MAX_REPEAT and arg[1] <= 4:
        one = _strings(arg[2])
        if one is None:
            return None
        out = {"".join(x) for n in range(arg[0], arg[1] + 1) for x in product(one, repeat=n)}
        return out if len(out) <= _MOST_STRINGS else None
    return None


def _strings(sequence) -> set[str] | None:
    out = {""}
    for item in sequence:
        one = _exact(item)
        if one is None or len(out) * len(one) > _MOST_STRINGS:
            return None
        out = {a + b for a in out for b in one}
    return out


def _smallest(options: set[frozenset[str]]) -> set[frozenset[str]]:
    return {o for o in options if not any(p < o for p in options)}


def _query(sequence) -> set[frozenset[str]]:
    """Options of which one must hold; an option is the trigrams that must all occur."""
    query, held = {frozenset()}, {""}

    def both(a, b):
        return _smallest({x | y for x in a for y in b})

    def flush():
        return {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in held}

    for item in sequence:
        one = _exact(item)
        if one is not None and len(held) * len(one) <= _MOST_STRINGS:
            held = {a + b for a in held for b in one}
            continue
        query, held = both(query, flush()), {""}
        op, arg = item
        if one is not None:
            held = one
        elif op is sre.SUBPATTERN:
            query = both(query, _query(arg[-1]))
        elif op is sre.BRANCH:
            query = both(query, _smallest(set().union(*[_query(p) for p in arg[1]])))
        elif op is sre.MAX_REPEAT and arg[0] >= 1:
            query = both(query, _query(arg[2]))
    return both(query, flush())


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Boolean query of a pattern over lower-case trigrams, as alternatives; empty: none is mandatory."""
    lowered = {frozenset(t.lower() for t in option) for option in _query(parser.parse(pattern))}
    return [] if frozenset() in lowered else sorted(_smallest(lowered), key=sorted)


def candidates(texts: DataFrame, rules: tuple[Rule, ...]) -> DataFrame | None:
    """doc_id and the kinds whose trigram query its postings satisfy; None if no rule has a query."""
    queries = {r.kind: q for r in rules if (q := trigram_query(r.pattern))}
    grams = sorted({g for q in queries.values() for option in q for g in option})
    if not grams:
        return None
    place = {g: divmod(i, WORD_BITS) for i, g in enumerate(grams)}
    low = F.lower("text")
    met = F.array(*[F.when(low.contains(g), F.lit(i)) for i, g in enumerate(grams)])
    postings = texts.select("doc_id", F.explode(F.array_compact(met)).alias("gram"))
    words = range(-(-len(grams) // WORD_BITS))
    bit = "shiftleft(1L, gram % {0})".format(WORD_BITS)
    lists = postings.groupBy("doc_id").agg(
        *[F.bit_or(F.expr(f"if(gram div {WORD_BITS} = {w}, {bit}, 0L)")).alias(f"w{w}") for w in words]
    )

    def holds(option: frozenset[str]) -> Column:
        masks = [sum(1 << place[g][1] for g in option if place[g][0] == w) for w in words]
        return reduce(Column.__and__, [F.col(f"w{w}").bitwiseAND(F.lit(m)) == m for w, m in enumerate(masks) if m])

    kinds = [F.when(reduce(Column.__or__, map(holds, q)), F.lit(k)) for k, q in queries.items()]
    return lists.select("doc_id", F.array_compact(F.array(*kinds)).alias("kinds")).where("size(kinds) > 0")


def _spans(rule: Rule, rank: int) -> Column:
    """(start, rank, kind, end) of the rule's matches, in code points, end exclusive."""
    text, pattern = F.col("text"), F.lit(rule.pattern)
    long = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length)
    counts = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.length) if rule.least else long
    # one entry per match: what lies before it, its length, and the length that counts
    gaps = F.slice(F.transform(F.split(text, rule.pattern, -1), F.length), F.lit(1), F.size(long))
    entry = F.arrays_zip(gaps.alias("gap"), long.alias("long"), counts.alias("counts"))
    start_kind = f"array<struct<start:int,rank:int,kind:string,end:int,counts:int>>"
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(start_kind).alias("spans"))

    def add(state: Column, one: Column) -> Column:
        start = (state["at"] + one["gap"]).cast("int")
        end = (start + one["long"]).cast("int")
        span = F.struct(
            start.alias("start"), F.lit(rank).alias("rank"), F.lit(rule.kind).alias("kind"), end.alias("end"),
            one["counts"].cast("int").alias("counts"),
        )
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(span)).cast(start_kind).alias("spans"))

    found = F.aggregate(entry, zero, add, lambda s: s["spans"])
    return F.filter(found, lambda s: s["counts"] >= rule.least)


def _scanned(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``docs`` (with doc_id and text among its columns) and one column of spans a rule."""
    found = candidates(docs.select("doc_id", "text"), rules)
    if found is None:
        joined = docs.withColumn("kinds", F.array().cast("array<string>"))
    else:
        found = found.withColumnRenamed("doc_id", "found_id")
        joined = docs.join(found, docs["doc_id"].eqNullSafe(found["found_id"]), "left").drop("found_id")
    none = F.array().cast("array<struct<start:int,rank:int,kind:string,end:int,counts:int>>")
    for i, rule in enumerate(rules):
        open_ = F.array_contains("kinds", rule.kind) if trigram_query(rule.pattern) else F.col("text").rlike(rule.pattern)
        joined = joined.withColumn(f"spans{i}", F.when(open_, _spans(rule, i)).otherwise(none))
    return joined.drop("kinds")


def _all(rules: tuple[Rule, ...], base_only: bool = False) -> Column:
    parts = [F.col(f"spans{i}") for i, r in enumerate(rules) if r.base or not base_only]
    return F.array_sort(F.concat(*parts))


def secret_spans(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, one count column ``n_<kind>`` a rule, and the arrays ``base`` and ``spans``."""
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return _scanned(texts, rules).select(
        "doc_id",
        *[F.size(f"spans{i}").cast("long").alias(f"n_{r.kind}") for i, r in enumerate(rules)],
        _all(rules, True).alias("base"),
        _all(rules).alias("spans"),
    )


def joined_spans(spans: str) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    one = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(one, ",")


def mask_secrets(
    docs: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    mask: str = "[secret]",
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with each secret (overlapping spans as one) replaced; rows without secrets as they came."""
    names = docs.columns
    held = docs.select(
        F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)]).alias("row"),
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    scanned = _scanned(held, rules).withColumn("spans", _all(rules))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def add(state: Column, span: Column) -> Column:
        gap = F.substring(F.col("text"), state["at"] + 1, span["start"] - state["at"])
        parts = F.when(span["start"] >= state["at"], F.concat(state["parts"], F.array(F.concat(gap, F.lit(mask)))))
        first = F.size(state["parts"]) == 0
        joined = F.when(first, F.array(F.concat(gap, F.lit(mask)))).otherwise(F.coalesce(parts, state["parts"]))
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"), joined.alias("parts"))

    def close(state: Column) -> Column:
        return F.concat(F.array_join(state["parts"], ""), F.substring(F.col("text"), state["at"] + 1, F.length("text")))

    place = names.index(text_col)
    masked = F.when(F.size("spans") > 0, F.aggregate("spans", zero, add, close)).otherwise(F.col(f"row.c{place}"))
    return scanned.select(*[masked.alias(c) if i == place else F.col(f"row.c{i}").alias(c) for i, c in enumerate(names)])
