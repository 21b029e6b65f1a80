"""Exact duplicates: combined locally, then by salted digest groups, then over the salts.

Every stage groups by the digest *and* the whole text, so equal digests alone never merge two texts.

Defined results: a null text counts as empty, so null and empty texts are one class; ids that are
null are smaller than any id; of rows repeated with the same id and text exactly one stays; an empty
table gives an empty result; further columns are ignored by ``exact_dedup`` and kept by
``exact_dedup_rows``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from soldscope.llm.common import rows_of, saved

SALTS = 16


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _salt(salts: int) -> Column:
    return F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int")


def _classes(rows: DataFrame) -> DataFrame:
    """One row per text. The partial aggregates combine within a task before anything moves."""
    merged = rows.groupBy("digest", "salt", "text").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n")
    )
    return merged.groupBy("digest", "text").agg(
        F.max("keep_id").alias("keep_id"),
        F.sum("n").alias("group_size"),
        F.bit_or(F.expr("shiftleft(1L, salt)")).alias("salts_met"),
    )


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    salts: int = SALTS,
    digest=sha256,
) -> DataFrame:
    """Each row's class: doc_id, digest, keep_id, group_size, kept.

    A row meets its class on (digest, salt), so a text that a third of all rows share is spread over
    ``salts`` (at most 63) groups. Where one digest stands for several texts, the text decides.
    """
    rows = (
        rows_of(docs, id_col, text_col)
        .withColumn("digest", digest(F.col("text")))
        .withColumn("salt", _salt(salts))
    )
    classes = _classes(rows)
    per_digest = saved(
        classes.groupBy("digest").agg(
            F.count(F.lit(1)).alias("texts"),
            F.max("keep_id").alias("keep_id"),
            F.max("group_size").alias("group_size"),
            F.bit_or("salts_met").alias("salts_met"),
        ),
        "exact-dedup",
    )
    places = (
        per_digest.where("texts = 1")
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        .where("(shiftright(salts_met, salt) & 1) = 1")
        .select("digest", "salt", "keep_id", "group_size")
    )
    found = rows.select("doc_id", "digest", "salt").join(places, ["digest", "salt"])
    same = ["digest", "salt", "doc_id"]
    result = _first_kept(found, same)
    shared = per_digest.where("texts > 1").select("digest")
    if not shared.isEmpty():
        unsure = rows.join(shared, "digest", "left_semi")
        decided = unsure.join(_classes(unsure).drop("salts_met"), ["digest", "text"])
        result = result.unionByName(_first_kept(decided, [*same, "text"]))
    return result


def _first_kept(found: DataFrame, same: list[str]) -> DataFrame:
    turn = F.row_number().over(Window.partitionBy(*same).orderBy("doc_id"))
    return found.withColumn("turn", turn).select(
        "doc_id",
        "digest",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("turn") == 1)).alias("kept"),
    )


def exact_dedup_rows(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS
) -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they came.

    The other columns of the greatest id travel with the text through the same three stages, so no
    text is moved a third time.
    """
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns) if c != text_col]).alias("rest"),
        F.col(text_col).isNull().alias("no_text"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        F.col(id_col).alias("doc_id"),
    ).withColumn("digest", sha256(F.col("text"))).withColumn("salt", _salt(salts))
    for keys in (["digest", "salt", "text"], ["digest", "text"]):
        keyed = keyed.groupBy(*keys).agg(
            F.max_by(F.struct("rest", "no_text", "doc_id"), F.struct("doc_id")).alias("top")
        ).select(*keys, "top.*")
    text = F.when(~F.col("no_text"), F.col("text"))
    return keyed.select(
        *[text.alias(c) if c == text_col else F.col(f"rest.c{i}").alias(c) for i, c in enumerate(docs.columns)]
    )
