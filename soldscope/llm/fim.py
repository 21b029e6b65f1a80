"""Fill-in-middle transformation: a text is cut into prefix, middle and suffix by one counted pattern.

``regexp_count`` gives the number of units; two cuts follow from a digest of the id. A pattern made
for the row then takes ``unit{a}`` and ``unit{b-a}`` possessively and the rest, and its replacement is
the finished output, so a text is matched once. Possessive counts run as loops in the engine: texts of
any length need no stack, and no unit is tried twice.

Only column functions, no shuffle. Defined results: a null text counts as empty; the empty text, a text
that contains a sentinel and the stated share of others stay plain, with null lengths; a null id counts
as the empty text in the digest; equal rows give equal rows; an empty table gives an empty result; further
columns are ignored. ``regexp_count`` holds one text's units at a time, about 20 bytes a byte of text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from soldscope.llm.common import rows_of

UNIT = "[A-Za-z]+|[^A-Za-z]"
# the same units without a way back into a run of letters
_LOOP = "(?:[A-Za-z]++|[^A-Za-z])"


@dataclass(frozen=True)
class Marks:
    """Sentinels before prefix, suffix and middle; none may contain another or a ``$`` or backslash."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    @property
    def all(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


def digest_number(column: Column, group: int) -> Column:
    """The ``group``-th 8-digit group (from 1) of a hexadecimal text as an unsigned integer."""
    return F.conv(F.substring(column, 8 * group - 7, 8), 16, 10).cast("long")


def _order(form: Column, marks: Marks, psm: str, spm: str) -> Column:
    p, s, m = marks.all
    parts = {"P": p, "S": s, "M": m}
    return F.when(form == "psm", psm.format(**parts)).otherwise(spm.format(**parts))


def fill_in_middle(
    docs: DataFrame,
    seed: str = "1",
    plain_percent: int = 10,
    spm_percent: int = 20,
    marks: Marks = Marks(),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, text, n units, form (plain, psm, spm), prefix_chars, middle_chars and output."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    counted = rows_of(docs, id_col, text_col).select(
        "doc_id", "text", F.regexp_count("text", F.lit(UNIT)).cast("long").alias("n"), digest.alias("h")
    )
    cut = lambda group: digest_number(F.col("h"), group) % (F.col("n") + 1)
    marked = F.contains("text", F.lit(marks.prefix))
    for mark in marks.all[1:]:
        marked = marked | F.contains("text", F.lit(mark))
    plain = (F.col("n") == 0) | marked | (digest_number(F.col("h"), 3) % 100 >= 100 - plain_percent)
    formed = counted.select(
        "doc_id",
        "text",
        "n",
        F.least(cut(1), cut(2)).alias("a"),
        F.greatest(cut(1), cut(2)).alias("b"),
        F.when(plain, "plain").when(digest_number(F.col("h"), 4) % 100 < spm_percent, "spm").otherwise("psm").alias("form"),
    )
    text, form = F.col("text"), F.col("form")
    loop = F.lit(rf"\A({_LOOP}{{")
    pattern = F.concat(
        loop, F.col("a").cast("string"), F.lit(f"}}+)({_LOOP}{{"), (F.col("b") - F.col("a")).cast("string"), F.lit(r"}+)((?s:.*))\z")
    )
    made = F.regexp_replace(text, pattern, _order(form, marks, "{P}$1{S}$3{M}$2", "{S}$3{P}$1{M}$2"))
    done = formed.select("doc_id", "text", "n", "form", F.when(form == "plain", text).otherwise(made).alias("output"))

    # sentinels stand in the output once each, so their places give the lengths
    place = lambda mark: F.instr("output", mark).cast("long")
    p, s, m = marks.all
    prefix = F.when(form == "psm", place(s)).otherwise(place(m)) - place(p) - len(p)
    middle = F.length("output") - place(m) - (len(m) - 1)
    shaped = lambda value: F.when(form != "plain", value).cast("long")
    return done.select(
        "doc_id", "text", "n", "form", shaped(prefix).alias("prefix_chars"), shaped(middle).alias("middle_chars"), "output"
    )


def restored(output: str, form: str, marks: Marks = Marks()) -> Column:
    """The text that an output of a given form was made from."""
    p, s, m = (rf"\Q{x}\E" for x in marks.all)
    psm = F.regexp_replace(output, rf"(?s)\A{p}(.*?){s}(.*?){m}(.*)\z", "$1$3$2")
    spm = F.regexp_replace(output, rf"(?s)\A{s}(.*?){p}(.*?){m}(.*)\z", "$2$3$1")
    return F.when(F.col(form) == "psm", psm).when(F.col(form) == "spm", spm).otherwise(F.col(output))
