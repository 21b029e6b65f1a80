"""Split CSV reading against the standard library's one-pass reader."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from soldscope.sources import landing
from soldscope.sources.csv_records import cells


def _field(rng):
    plain = "".join(rng.choices("ab é𝐀;'", k=rng.randint(0, 6)))
    kind = rng.random()
    if kind < 0.5:
        return plain, plain
    inner = "".join(rng.choices('ab,"\né ', k=rng.randint(1, 12)))
    return inner, '"' + inner.replace('"', '""') + '"'


def _file(rng, rows, end="\n"):
    out = []
    for i in range(rows):
        fields = [_field(rng)[1] for _ in range(rng.randint(1, 5))]
        out.append(",".join([f"r{i}", *fields]))
    return end.join(out) + end


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "90", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _read(spark, root):
    rows = landing.read_csv(spark, str(root)).collect()
    return sorted((r.file_name, [c or "" for c in r.cells]) for r in rows)


def test_many_ranges_give_what_one_reader_gives(spark, small_splits, tmp_path):
    rng = random.Random(11)
    (tmp_path / "F").mkdir()
    want = []
    for i in range(6):
        text = _file(rng, rng.randint(1, 60), "\r\n" if i == 3 else "\n")
        if i == 4:
            text = "\ufeff" + text
        if i == 5:
            text += 'last,"' + "long cell\n" * 60 + '"\n\n  \n'
        (tmp_path / "F" / f"{i}.csv").write_bytes(text.encode())
        rows = csv.reader(io.StringIO(text.removeprefix("\ufeff"), newline=""))
        want += [(f"{i}.csv", row) for row in rows if "".join(row).strip() or len(row) > 1]
    lines = spark.read.text(str(tmp_path / "F")).select(F.spark_partition_id().alias("p")).distinct().count()
    assert lines > 20
    assert _read(spark, tmp_path) == sorted(want)


def test_a_quote_that_is_never_closed_opens_nothing(spark, small_splits, tmp_path):
    (tmp_path / "R").mkdir()
    text = 'a,"x\ny"\nb,"broken\n' + "".join(f"c{i},1\n" for i in range(40))
    (tmp_path / "R" / "x.csv").write_text(text)
    got = [row for _, row in _read(spark, tmp_path)]
    assert ["a", "x\ny"] in got and ["c7", "1"] in got and len(got) == 42


def test_cells(spark):
    records = ["", "a", ",", 'a,"b,""c""",d', '"x\ny",', '"q"x,1', 'a"b,c', '""', "x" * 100_000 + ',"' + 'y,' * 50_000 + '"']
    got = [r.c for r in spark.createDataFrame([(i, r) for i, r in enumerate(records)], "i int, r string").orderBy("i").select(cells("r").alias("c")).collect()]
    assert got[:8] == [[None], ["a"], [None, None], ["a", 'b,"c"', "d"], ["x\ny", None], ['"q"x', "1"], ['a"b', "c"], [""]]
    assert [len(c) for c in got[8]] == [100_000, 100_000]


def test_one_odd_row_widens_nothing(spark, tmp_path):
    (tmp_path / "F").mkdir()
    text = "id,品牌,颜色\n1,Dior,red\n2,Dior,id" + "," * 3_000 + "\n"
    (tmp_path / "F" / "2026年05月01日-f.csv").write_text(text, encoding="utf-8")
    rows = landing.records(landing.read_cells(spark, str(tmp_path))).orderBy("item_id").collect()
    assert [(r.item_id, r.color) for r in rows] == [("1", "red"), ("2", "id")]
    assert landing.read_cells(spark, str(tmp_path)).where(F.size("pairs") > 3).count() == 0


def test_no_files_of_an_empty_folder(spark, tmp_path):
    (tmp_path / "F").mkdir()
    (tmp_path / "F" / "x.csv").write_text("")
    assert landing.read_cells(spark, str(tmp_path)).count() == 0
