"""Scalar vectors as one DataFrame per function."""

import pytest
from pyspark.sql import functions as F

from soldscope.functions import color, condition, money, names, similarity, text, urls, year


def values(spark, fn, inputs):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, v string")
    return [r.out for r in df.select("i", fn(F.col("v")).alias("out")).orderBy("i").collect()]


CASES = {
    "clean": (text.clean, [("  trimmed  ", "trimmed"), ("　\tx ", "x"), ("", None), (None, None)]),
    "first_item": (
        text.first_item,
        [("['Hermes']", "Hermes"), ("[]", None), ("[broken", "[broken"), ("[bro ken]", "[bro ken]"), ("x", "x")],
    ),
    "english_lower": (text.english_lower, [("框R/2014", "框R/2014"), ("Cœur É", "coeur e"), ("ﬁn", "fin"), ("ß", "ß")]),
    "condition": (
        condition.normalize_condition,
        [("New", "New"), ("['Excellent']", "['Excellent']"), ("", None), ("  trimmed  ", "trimmed")],
    ),
    "color": (
        color.normalize_color,
        [
            ("black", "black"), ("['Black']", "black"), ("['Browns']", "brown"),
            ("['Browns', 'Multicolor']", "brown/multicolor"), ("Multicolour", "multicolor"),
            ("Grey", "gray"), ("[]", None), ("color", None), ("Black/Multicolor", "black/multicolor"),
            ("", None), (None, None), ("noir", "black"), ("Rouge", "red"), ("doré", "gold"),
            ("Gris/Noir", "black/gray"), ("BLACK", "black"), ("Pivoine/Pink", "pink/pivoine"), ("Écru", "ecru"),
        ],
    ),
    "brand": (
        names.normalize_brand,
        [
            ("Hermès", "hermes"), ("Chloé", "chloe"), ("Alaïa", "alaia"), ("Céline", "celine"),
            ("Non Signé / Unsigned", "non signed / unsigned"), ("See by Chloé", "see by chloe"),
            ("Louis Vuitton", "louis vuitton"), ("['Louis Vuitton']", "louis vuitton"),
            ("['Hermes']", "hermes"), ("", None), (None, None),
        ],
    ),
    "name": (
        names.product_name,
        [
            ("Noé", "noe"), ("NéoNoé BB", "neonoe bb"), ("Speedy Bandoulière", "speedy bandouliere"),
            ("Le 5 à 7", "le 5 a 7"), ("Multi Pochette Accessoires", "multi pochette accessories"),
            ("Bum Bag Sac Ceinture", "bum bag belt bag"), ("Félicie", "felicie"), ("Sac 16", "sac 16"),
            ("CITY", "city"), ("框R/2014", "框R/2014"), (None, None), ("SAC À MAIN  noir", "handbag noir"),
        ],
    ),
    "material": (
        names.material,
        [
            ("cuir", "leather"), ("Toile et cuir", "canvas and leather"), ("vegan cuir", "vegan leather"),
            ("peau de veau", "calfskin"), ("Pony-style calfskin", "pony-style calfskin"), ("Leather", "leather"),
        ],
    ),
    "grade": (
        condition.exact_grade,
        [
            ("Excellent", "99新/Excellent"), ("Shows Wear", "90新/Shows Wear"), ("Giftable", "全新/Giftable"),
            ("bc-filter-Great", "98新/Great"), ("['Excellent']", "99新/Excellent"),
            ("99新/Excellent", "99新/Excellent"), ("Very good condition", "97新/Very good condition"),
            ("Excelent", None), (None, None),
        ],
    ),
    "year": (
        year.extract_year,
        [
            ("框Q", "框Q"), ("框R/2014", "框R/2014"), ("T/2015", "T/2015"), ("Z/2021", "Z/2021"),
            ("Acetate Square Sunglasses 6059", None), ("Horsebit 1955 Top Handle Flap Bag", None),
            ("Birkin 35", None), (None, None),
        ],
    ),
    "cny": (money.is_cny, [("CNY", True), ("cny", True), ("RMB", True), ("人民币", True), ("USD", False), (None, False), ("", False)]),
    "urls": (
        urls.extract_urls,
        [
            ("https://a.com/1.jpg, https://b.com/2.png;https://c.com/x", ["https://a.com/1.jpg", "https://b.com/2.png", "https://c.com/x"]),
            ("https://a.com/1.jpg https://a.com/1.jpg", ["https://a.com/1.jpg"]),
            ("/local/path.jpg", []),
            ("see (http://a.com/x).", ["http://a.com/x"]),
        ],
    ),
    "login": (urls.needs_login, [("https://x.feishu.cn/a", True), ("https://a.com", False), ("not a url", False)]),
    "extension": (urls.image_extension, [("https://a.com/1.JPEG", ".jpg"), ("https://a.com/1.png?x=1", ".png"), ("https://a.com/x", ".jpg"), ("https://a.com/x.exe", ".jpg")]),
}


@pytest.mark.parametrize("name", CASES)
def test_vectors(spark, name):
    fn, cases = CASES[name]
    assert values(spark, fn, [c[0] for c in cases]) == [c[1] for c in cases]


def test_display_color(spark):
    df = spark.createDataFrame(
        [
            (1, "F", "['Browns']"), (2, "F", "['A', 'B']"), (3, "F", "[]"), (4, "R", "greys"), (5, "V", "color"),
            (6, "V", "dark-blue/ecru x"), (7, "V", None),
        ],
        "i int, shop string, color string",
    )
    out = [r.c for r in df.select("i", color.display_color("color").alias("c")).orderBy("i").collect()]
    assert out == ["Brown", "['A', 'B']", None, "Gray", None, "Dark-Blue/Ecru X", None]


def test_fuzzy_grade_joins_back(spark):
    df = spark.createDataFrame(
        [(1, "Excelent"), (2, "Excellent"), (3, "odd thing"), (4, None), (5, "['Odd']"), (6, "")], "i int, condition string"
    )
    out = [r.condition for r in condition.with_grade(df).orderBy("i").collect()]
    assert out == ["99新/Excellent", "99新/Excellent", "odd thing", None, "Odd", None]


def test_ratio(spark):
    df = spark.createDataFrame([("Blak", "Black")], "a string, b string")
    assert df.select(similarity.ratio(F.col("a"), F.col("b")).alias("r")).first().r >= 0.86


def test_fx(spark):
    df = spark.createDataFrame(
        [(1, "USD", "100", "90", "10"), (2, "RMB", "100", None, None), (3, "EUR", "100", None, None)],
        "i int, currency string, price string, seller_price string, buyer_fee string",
    )
    for c in money.PRICE_COLUMNS:
        df = df.withColumn(c, F.col(c).cast("decimal(18,2)"))
    rows = money.prices_in_cny(df, "6.5").orderBy("i").collect()
    assert [(r.currency, str(r.price)) for r in rows] == [("CNY", "650.00"), ("CNY", "100.00"), ("EUR", "100.00")]
    assert (str(rows[0].seller_price), str(rows[0].buyer_fee)) == ("585.00", "65.00")


def test_merges(spark):
    df = spark.createDataFrame([("brown/pink", "Pivoine", "leather", "Epi/cuir", "Sellier / gg", "SELLIER")], "a string,b string,c string,d string,e string,f string")
    r = df.select(
        color.merge_colors(F.col("a"), F.col("b")).alias("color"),
        names.merge_materials(F.col("c"), F.col("d")).alias("material"),
        names.merge_other(F.col("e"), F.col("f")).alias("other"),
    ).first()
    assert (r.color, r.material, r.other) == ("brown/pink/pivoine", "leather/epi", "sellier/gg")
