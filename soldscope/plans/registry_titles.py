"""Title queries and their SQL: whole parses, and one query a stage over titles made from the part table.

Each stage query writes titles whose answer follows from how they are put together, a different pattern
by part number, so the SQL states the answer case by case.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from soldscope.operators import titles, updates
from soldscope.plans.reformat import format_rows
from soldscope.plans.registry import register
from soldscope.plans.registry_fields import GRADE_SQL
from soldscope.plans.testtables import SOLD_SQL, sold, table

PART_SQL = """p AS (SELECT *, upper(split_part(p_name, ' ', 2)[1]) || split_part(p_name, ' ', 2)[2:] AS noun,
  CAST(p_size AS VARCHAR) AS size FROM part)"""


def _words() -> tuple[Column, Column]:
    """The word of the part's name that is no color, with a capital letter, and its size."""
    return F.initcap(F.split("p_name", " ")[1]), F.col("p_size").cast("string")


def _by_part(*cases: Column) -> Column:
    """The case that the part number picks."""
    out = F
    for i, case in enumerate(cases[:-1]):
        out = out.when(F.col("p_partkey") % len(cases) == i, case)
    return out.otherwise(cases[-1])


def _case_sql(*cases: str) -> str:
    whens = " ".join(f"WHEN {i} THEN {case}" for i, case in enumerate(cases))
    return f"CASE p_partkey % {len(cases)} {whens} END"


def _text(*pieces: Column | str) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p for p in pieces))


# ---------------------------------------------------------------- whole titles

SIZED_SQL = SOLD_SQL.replace("p_brand AS brand,", "p_brand AS brand, CAST(p_size AS VARCHAR) AS size,")
MODEL_SQL = """split_part(model, ' ', 2) || CASE WHEN shop <> 'V' AND material <> color THEN ' ' || material ELSE '' END
  || ' ' || size"""


@register(
    "title_parse",
    f"""WITH {SIZED_SQL} SELECT shop, lower(brand) AS new_brand, {MODEL_SQL} AS new_model, {GRADE_SQL} AS new_condition, color AS new_color,
      material AS new_material, CAST(NULL AS VARCHAR) AS new_other, count(*) AS row_count
    FROM sold GROUP BY ALL""",
)
def _(spark, sf_dir):
    """Formatted rows of all shops, counted per result; titles have size, color and material words."""
    rows = sold(spark, sf_dir, "shop", "brand", "title", "condition", "color", "material")
    rows = rows.withColumnRenamed("title", "model").withColumns(
        {"other": F.lit(None).cast("string"), "old_data": F.lit(None).cast("string")}
    )
    done = format_rows(rows)
    keys = [f"new_{c}" for c in ("brand", "model", "condition", "color", "material", "other")]
    return done.groupBy("shop", *keys).agg(F.count("*").alias("row_count"))


@register(
    "format_from_old_data",
    f"""WITH {SOLD_SQL} SELECT shop,
      'brand|model|' || CASE WHEN condition IS NULL THEN '' ELSE 'condition' END || CASE WHEN shop = 'V' THEN '' ELSE '|material' END AS changed,
      split_part(model, ' ', 2) AS new_model, count(*) AS row_count
    FROM sold GROUP BY ALL""",
)
def _(spark, sf_dir):
    """The reformat job's inputs from the raw JSON of each row, with changed rows counted per field."""
    rows = sold(spark, sf_dir, "shop", "brand", "condition", "color", "material", "old_data")
    rows = rows.withColumns({c: F.lit(None).cast("string") for c in ("model", "year", "other")})
    done = format_rows(rows)
    pairs = {c: (F.col(c), F.col(f"new_{c}")) for c in ("brand", "model", "condition", "color", "material")}
    marked = done.select("shop", F.array_join(updates.changed_fields(pairs), "|").alias("changed"), "new_model")
    return marked.groupBy("shop", "changed", "new_model").agg(F.count("*").alias("row_count"))


# ---------------------------------------------------------------- single stages


@register(
    "title_brand_strip",
    f"""WITH {PART_SQL} SELECT p_partkey, {_case_sql(
        "noun || ' ' || size",
        "noun || ' ' || size",
        "noun",
        "'Louis Vuitton ' || noun",
        "noun || ' Chanel'",
        "p_brand || ' ' || noun",
        "'Chanelle ' || noun",
    )} AS text FROM p""",
)
def _(spark, sf_dir):
    """Own brand and usual makers off the front, each once and in a fixed order."""
    noun, size = _words()
    raw = _by_part(
        _text(noun, " ", size),
        _text(F.upper("p_brand"), "  ", noun, " ", size),
        _text("HERMÈS ", noun),
        _text("Hermes Louis Vuitton ", noun),
        _text("Louis  Vuitton hermes ", noun, " Chanel"),
        _text(F.col("p_brand"), " ", F.col("p_brand"), " ", noun),
        _text("Chanelle ", noun),
    )
    part = table(spark, sf_dir, "part")
    return part.select("p_partkey", titles.strip_leading_brand(raw, F.lower("p_brand")).alias("text"))


@register(
    "title_condition",
    f"""WITH {PART_SQL} SELECT p_partkey, {_case_sql(
        "noun",
        "noun || ' ' || size",
        "noun || ' ' || size",
        "noun",
        "'Unworn ' || noun",
        "noun || ' in ' || noun",
    )} AS text, CAST(NULL AS VARCHAR) AS found FROM p""",
)
def _(spark, sf_dir):
    noun, size = _words()
    raw = _by_part(
        _text("Excellent ", noun),
        _text(noun, " Very  Good condition ", size),
        _text(noun, " never worn, with tag ", size),
        _text("in ", noun, " Shows Wear with"),
        _text("Unworn ", noun),
        _text("and ", noun, " fair in ", noun, " good condition"),
    )
    bare = table(spark, sf_dir, "part").select("p_partkey", titles.strip_condition(raw).alias("s"))
    return bare.select("p_partkey", "s.text", "s.found")


@register(
    "title_color",
    f"""WITH {PART_SQL} SELECT p_partkey, {_case_sql(
        "noun || ' ' || size",
        "noun",
        "noun || ' ' || size",
        "noun",
        "noun",
        "noun || ' 24/24'",
        "noun || ' MM'",
        "noun || ' ' || size",
    )} AS text, {_case_sql("'noir'", "'black'", "'rose gold'", "'black'", "'mother of pearl'", "'rouge h'", "'black/vert fonce'", "''")} AS colors
    FROM p""",
)
def _(spark, sf_dir):
    """Own color, color phrases (longest first), last words like the own color, and linking words left over."""
    noun, size = _words()
    raw = _by_part(
        _text(noun, " NOIR ", size),
        _text("Black ", noun),
        _text("Rose  Gold ", noun, " ", size),
        _text(noun, " Blak"),
        _text(noun, " in Mother of Pearl"),
        _text(noun, " 24/24 and Rouge H"),
        _text("Vert Fonce ", noun, " black MM"),
        _text(noun, " ", size),
    )
    part = table(spark, sf_dir, "part").select("p_partkey", raw.alias("raw"), F.lit("black").alias("own"))
    bare = titles.strip_attributes(part, "raw", "text", color="own")
    return bare.select("p_partkey", "text", F.array_join("text_colors", "/").alias("colors"))


@register(
    "title_material",
    f"""WITH {PART_SQL} SELECT p_partkey, {_case_sql("'Monogram Canvas'", "'Togo'", "'GG Coated Canvas and Leather'", "NULL", "'Leather'", "'Epi'", "'Box Calf'")} AS name,
      {_case_sql("noun || ' ' || size", "noun || ' ' || size", "noun", "noun || ' ' || size", "'Togo ' || noun", "noun", "noun || ' box'")} AS rest FROM p""",
)
def _(spark, sf_dir):
    """Material at the front, else the longest one inside."""
    noun, size = _words()
    raw = _by_part(
        _text("Monogram  canvas ", noun, " ", size),
        _text(noun, " Togo ", size),
        _text("GG Coated Canvas and Leather ", noun),
        _text(noun, " ", size),
        _text("Leather Togo ", noun),
        _text(noun, " EPI"),
        _text(noun, " Box Calf box"),
    )
    found = table(spark, sf_dir, "part").select("p_partkey", titles.extract_material(raw).alias("m"))
    return found.select("p_partkey", "m.name", "m.rest")


@register(
    "title_model",
    f"""WITH {PART_SQL} SELECT p_partkey, {_case_sql(
        "noun || ' MM'",
        "noun || ' 28'",
        "noun || ' ' || size",
        "noun || ' Mini ' || size",
        "noun || ' Large'",
        "noun || ' and ' || noun || ' ' || size",
        "'Bag'",
    )} AS model FROM p""",
)
def _(spark, sf_dir):
    """Bag types, hardware, own material and colors out; series and size words stay, glued sizes are split."""
    noun, size = _words()
    raw = _by_part(
        _text(noun, " Shoulder Bag MM"),
        _text(noun, "28"),
        _text(noun, " with Gold Hardware Shearling ", size),
        _text(noun, " Bag Black Mini ", size),
        _text("Vintage ", noun, " noir Large"),
        _text(noun, " and ", noun, " Suede ", size),
        F.lit("Bag"),
    )
    part = table(spark, sf_dir, "part").select("p_partkey", raw.alias("raw"), F.lit("Shearling").alias("material"), F.lit("black").alias("own"))
    return titles.refine_models(part, "raw", "model", material="material", color="own").select("p_partkey", "model")


@register(
    "title_variant",
    f"""WITH {PART_SQL} SELECT p_partkey, {_case_sql(
        "'kelly ' || size",
        "lower(noun) || ' sellier'",
        "lower(noun) || ' ' || size",
        "'picotin ' || size",
        "'roulis ' || lower(noun) || ' barenia'",
        "'gg marmont ' || size",
        "'birkin ' || size",
        "'speedy bandouliere'",
    )} AS model, {_case_sql("'sellier'", "NULL", "'so black'", "'cargo'", "'faubourg'", "NULL", "'touch'", "NULL")} AS other FROM p""",
)
def _(spark, sf_dir):
    """Craft words leave the model beside their lines only; words split off by mistake go back."""
    noun, size = _words()
    raw = _by_part(
        _text("Kelly Sellier ", size),
        _text(noun, " Sellier"),
        _text("So Black ", noun, " ", size),
        _text("Cargo Picotin ", size),
        _text("Roulis ", noun, " Barenia Faubourg"),
        _text("Marmont ", size),
        _text("Touch Birkin ", size),
        F.lit("Speedy"),
    )
    stored = F.when(F.col("p_partkey") % 8 == 5, "gg").when(F.col("p_partkey") % 8 == 7, "Bandoulière / zip")
    found = table(spark, sf_dir, "part").select("p_partkey", titles.model_and_other(raw, stored, raw).alias("m"))
    return found.select("p_partkey", "m.model", "m.other")
