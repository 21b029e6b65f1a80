"""Text expressions: cleaning, list literals, accent folding, phrase removal."""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable, Iterable, Mapping
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\s\x1c-\x1f]"
# every character that counts as a blank at either end of a text
BLANKS = "".join(chr(c) for c in range(0x10000) if chr(c).isspace())
CJK = r"[一-鿿]"


def col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times inside one expression."""
    return F.get(F.transform(F.array(value), use), 0)


def filled(text: Column) -> Column:
    """Text, NULL when empty; ``nullif`` would write a long expression twice."""
    return let(text, lambda t: F.when(t != "", t))


def first(items: Column) -> Column:
    """First element, NULL when there is none."""
    return F.get(items, 0)


def strip(text: Column | str) -> Column:
    """Cut blanks of any kind at both ends; plain ``trim`` knows only one of them."""
    return F.btrim(col(text), F.lit(BLANKS))


def clean(text: Column | str) -> Column:
    """Stripped text, NULL when nothing is left."""
    return filled(strip(text))


def squeeze(text: Column | str) -> Column:
    return strip(F.regexp_replace(col(text), rf"(?U){SPACE}+", " "))


def tokens(text: Column | str) -> Column:
    """Words between blanks; no word gives an empty array."""
    return F.filter(F.split(col(text), rf"(?U){SPACE}+"), lambda t: t != "")


def parts(text: Column | str, separator: str = "/") -> Column:
    """Stripped, non-empty pieces of a separated list; NULL text gives an empty array."""
    pieces = F.transform(F.split(F.coalesce(col(text), F.lit("")), separator), strip)
    return F.filter(pieces, lambda p: p != "")


def is_list(text: Column) -> Column:
    return text.startswith("[") & text.endswith("]")


def list_items(text: Column) -> Column:
    """Items of a list literal such as ``['Hermes']``; NULL when the text is none."""
    json = F.regexp_replace(text, r",\s*\]$", "]")
    options = {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true"}
    items = F.from_json(F.when(is_list(text), json), "array<string>", options)
    return F.filter(F.transform(items, strip), lambda i: i != "")


def first_item(text: Column | str) -> Column:
    """First item of a list literal; any other text, or a broken literal, stays as it is."""

    def pick(t: Column) -> Column:
        return let(list_items(t), lambda items: F.when(items.isNotNull(), first(items)).otherwise(t))

    return let(clean(text), pick)


def constant(rows: object, kind: str) -> Column:
    """Constant array written as one JSON text, which the optimizer folds to one literal."""
    return F.from_json(F.lit(json.dumps(rows, ensure_ascii=False)), kind)


def lookup(table: Mapping[str, object], key: Column) -> Column:
    """Value of a small constant table, NULL for an unknown key."""
    kind = "int" if all(isinstance(v, int) for v in table.values()) else "string"
    values = constant(list(table.values()), f"array<{kind}>")
    return F.map_from_arrays(constant_array(table), values)[key]


def constant_array(values: Iterable[str]) -> Column:
    return constant(list(values), "array<string>")


def _base(ch: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c))


@lru_cache(maxsize=1)
def _fold_table() -> tuple[str, str, tuple[tuple[str, str], ...], tuple[tuple[str, str], ...]]:
    """Characters that change under compatibility decomposition without marks, and what they become.

    Single replacements come as two strings, marks last: they have no counterpart and are deleted.
    Those that become several characters are pairs, the usual ones (Latin ligatures, fractions, signs)
    apart from the rest, which is looked at only in texts that hold one. Hangul is left alone.
    """
    codes = (c for c in range(0x80, 0x110000) if not 0xAC00 <= c <= 0xDFFF)
    changed = {ch: base for ch in map(chr, codes) if (base := _base(ch)) != ch}
    single = {ch: base for ch, base in changed.items() if len(base) == 1}
    marks = [ch for ch, base in changed.items() if base == ""]
    latin = lambda c: c < 0x250 or 0x2000 <= c < 0x2190 or 0xFB00 <= c < 0xFB07
    several = [(ch, base) for ch, base in changed.items() if len(base) > 1]
    usual = tuple(p for p in several if latin(ord(p[0])))
    rare = tuple(p for p in several if not latin(ord(p[0])))
    return "".join([*single, *marks]), "".join(single.values()), usual, rare


LIGATURES = (("œ", "oe"), ("Œ", "OE"), ("æ", "ae"), ("Æ", "AE"))
BEYOND_ASCII = r"[^\x00-\x7f]"


def _expanded(text: Column, pairs: tuple[tuple[str, str], ...]) -> Column:
    """Each character of the text that a pair names, in the other's form, in one pass over its characters."""
    table = constant([{"key": a, "value": b} for a, b in pairs], "array<struct<key:string,value:string>>")
    known = F.map_from_entries(table)
    return F.array_join(F.transform(F.split(text, ""), lambda c: F.coalesce(known[c], c)), "")


def _fold(text: Column, extra: tuple[tuple[str, str], ...]) -> Column:
    """Plain ASCII passes after one scan; pairs are looked up only in texts that hold one of them."""
    source, target, usual, rare = _fold_table()
    holds = lambda t, pairs: t.rlike(f"[^\\x00-\\x7f&&[{''.join(a for a, _ in pairs)}]]")
    usual = usual + extra
    table = [{"a": a, "b": b} for a, b in usual]

    def replaced(t: Column) -> Column:
        pairs = constant(table, "array<struct<a:string,b:string>>")
        return F.aggregate(pairs, t, lambda acc, p: F.replace(acc, p["a"], p["b"]))

    def folded(t: Column) -> Column:
        # a few ranges rule most texts out before the long class is tried
        unusual = t.rlike(r"[^\x00-\u024f\u2000-\u218f\ufb00-\ufb06]")
        wide = let(F.when(unusual & holds(t, rare), _expanded(t, rare)).otherwise(t), lambda w: F.when(holds(w, usual), replaced(w)).otherwise(w))
        return F.when(t.rlike(BEYOND_ASCII), F.translate(wide, source, target)).otherwise(t)

    return let(text, folded)


def fold_marks(text: Column | str) -> Column:
    """Decompose letters and drop their marks."""
    return _fold(col(text), ())


def fold_accents(text: Column | str) -> Column:
    """``fold_marks`` plus the two Latin ligatures that do not decompose."""
    return _fold(col(text), LIGATURES)


def english_lower(text: Column | str) -> Column:
    """Folded lower-case text; text with Chinese characters stays as it is."""
    return let(clean(text), lambda t: F.when(t.rlike(CJK), t).otherwise(F.lower(fold_accents(t))))


def token_key(text: Column) -> Column:
    return F.lower(fold_accents(text))


def quoted(literal: str) -> str:
    """Regular expression of a fixed phrase; a blank matches any run of blanks."""
    return r"\s+".join(re.sub(r"([^\w])", r"\\\1", w) for w in literal.split())


def quoted_column(text: Column) -> Column:
    safe = F.regexp_replace(text, r"(?U)([^\w\s])", r"\\$1")
    return F.regexp_replace(safe, " ", r"\\s+")


PHRASES = "array<struct<name:string,probe:string,body:string>>"


def phrase_table(phrases: Iterable[str]) -> Column:
    """Constant array of phrases with the word that must occur before the pattern is tried."""
    rows = [{"name": p, "probe": p.split()[0].lower(), "body": quoted(p)} for p in phrases]
    return constant(rows, PHRASES)


def word(body: Column) -> Column:
    return F.concat(F.lit(r"(?iU)\b"), body, F.lit(r"\b"))


def held(text: Column, phrases: Column) -> Column:
    """Phrases whose first word occurs in the text; removing others cannot make one of them appear."""
    return let(F.lower(text), lambda low: F.filter(phrases, lambda p: F.contains(low, p["probe"])))


def longest_first(phrases: Iterable[str]) -> list[str]:
    return sorted(phrases, key=len, reverse=True)


def strip_anywhere(text: Column, phrases: Iterable[str]) -> Column:
    """Remove whole-word phrases one after the other, wherever they stand."""
    table = phrase_table(phrases)
    cut = lambda acc, p: F.regexp_replace(acc, word(p["body"]), F.lit(" "))
    return squeeze(let(text, lambda t: F.aggregate(held(t, table), t, cut)))


def _cut_between_blanks(text: Column, body: Column) -> Column:
    flag = F.lit("(?iU)")
    inner = F.regexp_replace(text, F.concat(flag, F.lit(r"\s+"), body, F.lit(r"\s+")), F.lit(" "))
    tail = F.regexp_replace(inner, F.concat(flag, F.lit(r"\s+"), body, F.lit("$")), F.lit(""))
    return F.regexp_replace(tail, F.concat(flag, F.lit("^"), body, F.lit(r"\s+")), F.lit(""))


def strip_between_blanks(text: Column, phrases: Iterable[str]) -> Column:
    """Remove phrases that stand between blanks; a text that is nothing but the phrase stays."""
    table = phrase_table(longest_first(phrases))
    cut = lambda acc, p: _cut_between_blanks(acc, p["body"])
    return squeeze(let(text, lambda t: F.aggregate(held(t, table), t, cut)))


def strip_value_between_blanks(text: Column, value: Column) -> Column:
    return F.when(value.isNull() | (value == ""), text).otherwise(_cut_between_blanks(text, quoted_column(value)))


def map_distinct(df: DataFrame, column: str, out: str, expression: Callable[[Column], Column]) -> DataFrame:
    """Work out ``expression`` once per distinct value of ``column`` and join the results back.

    For expressions that cost more than a join. The join side is as large as the number of
    distinct values, so adaptive execution decides whether it is broadcast.
    """
    key, value = f"_{out}_key", f"_{out}_value"
    table = df.select(F.col(column).alias(key)).where(F.col(key).isNotNull()).distinct()
    table = table.withColumn(value, expression(F.col(key)))
    joined = df.join(table, F.col(column) == F.col(key), "left")
    return joined.withColumn(out, F.col(value)).drop(key, value)
