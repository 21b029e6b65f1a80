"""Landing files, selection, store, keyed updates, reformat and the stream, on small fixtures."""

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from soldscope.operators import updates
from soldscope.plans import reformat as R
from soldscope.schema import SOLD, align
from soldscope.sources import landing, selection
from soldscope.sources.store import SnapshotStore
from soldscope.streaming.incremental import load_once, run_daily, run_incremental

FR_HEAD = "ID,品牌,型号,成色,价格(汇率7.1),颜色,图片路径\n"


@pytest.fixture()
def land(tmp_path):
    root = tmp_path / "landing"
    for s in "FRV":
        (root / s).mkdir(parents=True)

    def put(shop, name, text):
        (root / shop / name).write_text(text, encoding="utf-8")

    put("F", "2026年05月01日14：26-f.csv", FR_HEAD + "1,['Louis Vuitton'],Epi Alma BB Black,Excelent,\"1,000\",['Black'],https://a.com/1.jpg\n,,,,,,\n2,Hermès,Kelly Sellier 28 Togo,bc-filter-Great,2000.50,,\n")
    put("F", "2026年05月01日20：00-f.CSV", FR_HEAD + "9,Gucci,Other,Good,5,red,\n")
    put("R", "inventory.csv", "品牌,id,型号,Condition,价格\n['Gucci'],7,GG Canvas Ophidia Tote,Great,bad\n")
    put("V", "sold_items_20260502_export.csv", "id,品牌,商品名称,材质,颜色,价格,货币,卖家价格,点赞数,售出时间,成色,链接\n5,Chanel,2.55 crossbody bag,Cotton,Noir,100,USD,90,3.0,2026-04-30T10:00:00Z,Never worn,https://x\n")
    return root, put


def test_snapshot_date(spark):
    names = ["2025年3月1日-f.xlsx", "sold_items_20250301_export.xlsx", "inventory.xlsx", "2025年13月1日.csv"]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, n string")
    out = [r.d for r in df.select("i", landing.snapshot_date("n").alias("d")).orderBy("i").collect()]
    assert out == [date(2025, 3, 1), date(2025, 3, 1), None, None]


def test_listing_and_selection(spark, land):
    files = landing.list_files(spark, str(land[0]))
    assert files.count() == 4
    none = spark.createDataFrame([], "shop string, snapshot_date date")
    first = selection.select_files(files, none).where("shop = 'F'").collect()
    assert [r.file_name for r in first] == ["2026年05月01日14：26-f.csv"]
    held = spark.createDataFrame([("F", date(2026, 5, 1)), ("R", None)], "shop string, snapshot_date date")
    assert [r.shop for r in selection.select_files(files, held).collect()] == ["V"]
    assert selection.select_files(files, held, skip_existing=False).count() == 3
    missing = spark.createDataFrame([("V", date(2026, 5, 2)), ("R", None)], "shop string, snapshot_date date")
    assert [r.shop for r in selection.files_to_backfill(files, missing).collect()] == ["V"]
    assert selection.files_to_backfill(files, missing, date(2026, 5, 3)).count() == 0


def test_records(spark, land):
    rows = {r.item_id: r for r in landing.records(landing.read_cells(spark, str(land[0]))).collect()}
    assert set(rows) == {"1", "2", "9", "7", "5"}
    assert (str(rows["1"].price), str(rows["2"].price), rows["7"].price) == ("1000.00", "2000.50", None)
    assert json.loads(rows["1"].old_data) == {
        "item_id": "1", "brand": "['Louis Vuitton']", "model": "Epi Alma BB Black", "condition": "Excelent",
        "color": "['Black']", "price": "1000",
    }
    v = rows["5"]
    assert (str(v.price), str(v.seller_price), v.likes, v.currency) == ("100.00", "90.00", 3, "USD")
    assert json.loads(v.old_data)["product_name"] == "2.55 crossbody bag"
    assert json.loads(v.old_data)["sold_at"] == "2026-04-30T10:00:00"


def test_json_landing(spark, tmp_path):
    (tmp_path / "F").mkdir()
    (tmp_path / "F" / "a_20260501_b.jsonl").write_text('{"id": 3, "品牌": "Dior", "型号": "Saddle", "价格": "10", "品相": "Good"}\n', encoding="utf-8")
    r = landing.records(landing.read_cells(spark, str(tmp_path), "json")).first()
    assert (r.item_id, r.brand, r.model, str(r.price), r.condition, r.snapshot_date) == ("3", "Dior", "Saddle", "10.00", "Good", date(2026, 5, 1))


def test_prepare(spark, land):
    raw = landing.records(landing.read_cells(spark, str(land[0])))
    rows = {r.item_id: r for r in landing.prepare(raw, usd_cny="6.5", keep_images=False).collect()}
    one, v = rows["1"], rows["5"]
    assert (one.brand, one.condition, one.color, one.model, one.material) == ("louis vuitton", "99新/Excellent", "black", None, None)
    assert (v.material, v.model, v.currency, str(v.price), str(v.seller_price)) == ("Cotton", None, "CNY", "650.00", "585.00")
    assert json.loads(v.old_data)["price"] == "100"
    assert one.image_path is None


def test_stream_daily(spark, land, tmp_path):
    root, put = land
    store = SnapshotStore(spark, str(tmp_path / "store"))
    ckpt = str(tmp_path / "ckpt")
    run_incremental(spark, str(root), store, usd_cny="6.5", checkpoint=ckpt)
    rows = {r.item_id: r for r in store.read().collect()}
    assert set(rows) == {"1", "2", "7", "5"}
    assert (rows["1"].model, rows["1"].material, rows["1"].color) == ("alma bb", "epi", "black")
    assert (rows["2"].model, rows["2"].material, rows["2"].other) == ("kelly 28", "togo", "sellier")
    assert (rows["7"].model, rows["7"].material, rows["7"].snapshot_date) == ("ophidia", "gg canvas", None)
    assert (rows["5"].model, rows["5"].condition, rows["5"].material) == ("2.55", "全新/Never worn", "cotton")
    # a second run takes the new date only; a late file for a stored date is skipped
    put("F", "2026年05月03日-f.csv", FR_HEAD + "11,Dior,Saddle Bag,Good,5,red,\n")
    put("F", "2026年05月01日23：00-f.csv", FR_HEAD + "12,Dior,Late,Good,5,red,\n")
    counts = run_daily(spark, str(root), store, checkpoint=ckpt)
    assert {r.item_id for r in store.read().collect()} == {"1", "2", "7", "5", "11"}
    assert sum(r.changed for r in counts.collect()) == 0
    # reload on request replaces exactly the chosen dates
    load_once(spark, str(root), store, skip_existing=False)
    assert store.read().count() == 5
    again = R.reformat(store)
    assert sum(r.changed for r in again.collect()) == 5
    assert sum(r.changed for r in R.reformat(store, dates=[date(2026, 5, 1), None], dry_run=True).collect()) == 0
    store.reset()
    assert store.read().count() == 0


def sold(spark, rows):
    names = list(rows[0])
    kinds = {f.name: f.dataType.simpleString() for f in SOLD.fields}
    df = spark.createDataFrame([tuple(str(r[n]) if r[n] is not None else None for n in names) for r in rows], ", ".join(f"{n} string" for n in names))
    return align(df.select(*[F.col(n).cast(kinds[n]).alias(n) for n in names]))


BASE = [
    dict(shop="F", id=1, item_id="a", snapshot_date="2026-05-01", brand="['Hermes']", model="m", condition=None, color="['Browns', 'Multicolor']", image_path=" "),
    dict(shop="F", id=2, item_id="b", snapshot_date=None, brand="x", model="m", condition="Good", color="red", image_path="p"),
    dict(shop="V", id=3, item_id="a", snapshot_date="2026-05-01", brand="x", model="m", condition=None, color="red", image_path=None),
]


def test_keyed_updates(spark):
    target = sold(spark, BASE)
    source = sold(spark, [
        dict(shop="F", id=0, item_id="a", snapshot_date="2026-05-01", condition="Great", image_path="https://a.com/1.jpg", brand="B", model="M", color="C"),
        dict(shop="F", id=0, item_id="a", snapshot_date="2026-05-01", condition="Good", image_path="https://a.com/1.jpg", brand="B", model="M", color="C"),
        dict(shop="F", id=0, item_id="b", snapshot_date=None, condition="Fair", image_path="no url", brand="B", model="M", color="C"),
    ])
    by = lambda df: {r.id: r for r in df.collect()}
    out = by(updates.backfill_condition(target, source))
    assert [(out[i].condition, out[i]._changed) for i in (1, 2, 3)] == [("Great", True), ("Good", False), (None, False)]
    assert by(updates.backfill_condition(target, source, only_blank=False))[2].condition == "Fair"
    assert len(out) == 3
    images = by(updates.backfill_images(target, source))
    assert [images[i].image_path for i in (1, 2)] == ["https://a.com/1.jpg", "p"]
    raw = by(updates.restore_raw_fields(target, source))
    assert (raw[1].brand, raw[1].model, raw[1].material, raw[3]._changed) == ("B", "M", None, False)
    old = by(updates.backfill_old_data(target, source.withColumn("old_data", F.lit('{"model": "Z"}'))))
    assert (old[1].old_data, old[3].old_data) == ('{"model": "Z"}', None)
    moved = updates.rows_to_rewrite(updates.backfill_condition(target, source))
    assert [r.id for r in moved.collect()] == [1]


def test_repair_and_reconcile(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "s"))
    store.overwrite_dates(sold(spark, BASE))
    assert [(r.scanned, r.changed) for r in R.repair_colors(store).collect()] == [(2, 1)]
    assert {r.id: r.color for r in store.read().collect()} == {1: "brown/multicolor", 2: "red", 3: "red"}
    R.reconcile_brands(store)
    assert {r.id: r.brand for r in store.read().collect()} == {1: "hermes", 2: "x", 3: "x"}


def test_chains(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "s"))
    store.overwrite_dates(sold(spark, BASE))
    source = sold(spark, [dict(shop="F", id=0, item_id="a", snapshot_date="2026-05-01", brand="Louis Vuitton", model="Epi Alma BB Black", condition="Excellent", color="Black", old_data='{"model": "Monogram Speedy 25", "brand": "Louis Vuitton"}')])
    counts = {r.shop: r for r in R.restore_and_refill(store, source, str(tmp_path / "out")).collect()}
    assert (counts["F"].scanned, counts["F"].skipped) == (2, 0)
    row = {r.id: r for r in store.read().collect()}[1]
    assert (row.brand, row.model, row.material, row.color, row.condition) == ("louis vuitton", "alma bb", "epi", "black", "99新/Excellent")
    entries = R.read_preview(spark, str(tmp_path / "out")).where("id = 1").first()
    assert entries.changed and "material" in entries.changed_fields and entries.before["model"] == "Epi Alma BB Black"
    R.backfill_then_reformat(store, source)
    row = {r.id: r for r in store.read().collect()}[1]
    assert (row.model, row.material) == ("speedy 25", "monogram")


def test_currency_job(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "s"))
    rows = [
        dict(shop="V", id=1, item_id="a", snapshot_date="2026-05-01", price="100", seller_price="90", buyer_fee=None, currency="usd"),
        dict(shop="V", id=2, item_id="b", snapshot_date="2026-05-01", price="100", seller_price=None, buyer_fee=None, currency="cny"),
        dict(shop="V", id=3, item_id="c", snapshot_date="2026-05-02", price="100", seller_price=None, buyer_fee=None, currency="EUR"),
    ]
    store.overwrite_dates(sold(spark, rows))
    assert R.normalize_currency(store, "7", dry_run=True).first().changed == 2
    assert R.normalize_currency(store, "7").first().changed == 2
    out = {r.id: (str(r.price), r.currency) for r in store.read().collect()}
    assert out == {1: ("700.00", "CNY"), 2: ("100.00", "CNY"), 3: ("100.00", "EUR")}
    assert R.normalize_currency(store, "7").first().changed == 0


def test_wide_and_multi_line_csv(spark, tmp_path):
    folder = tmp_path / "F"
    folder.mkdir()
    names = ["id", *(f"x{i}" for i in range(67)), "价格", "颜色"]
    first = ["a1", *("v" for _ in range(67)), "120", '"deep\nsea, ""blue"""']
    second = ["a2", *("v" for _ in range(67)), "130", "red"]
    text = "\n".join(",".join(line) for line in (names, first, second)) + "\n"
    (folder / "2026年05月01日-f.csv").write_text(text, encoding="utf-8")
    (folder / "2026年05月02日-f.csv").write_text("1,2,3\n4,5,6\n", encoding="utf-8")
    rows = {r.item_id: r for r in landing.records(landing.read_cells(spark, str(tmp_path))).collect()}
    assert set(rows) == {"a1", "a2"}
    assert rows["a1"].price == 120 and rows["a1"].color == 'deep\nsea, "blue"'
    assert rows["a2"].price == 130 and rows["a2"].color == "red"
    lost = landing.files_without_header(spark, str(tmp_path)).collect()
    assert [(r.file_name, r.rows) for r in lost] == [("2026年05月02日-f.csv", 2)]


def test_line_break_in_a_header_cell(spark, tmp_path):
    folder = tmp_path / "F"
    folder.mkdir()
    text = 'ID,品牌,"备注\n(内部)",卖出价格,颜色\na1,Acme,x,120,red\na2,Acme,"y\nz",130,blue\n'
    (folder / "2026年05月01日-f.csv").write_text(text, encoding="utf-8")
    rows = {r.item_id: r for r in landing.records(landing.read_cells(spark, str(tmp_path))).collect()}
    assert {k: (r.price, r.color) for k, r in rows.items()} == {"a1": (120, "red"), "a2": (130, "blue")}
    assert landing.files_without_header(spark, str(tmp_path)).count() == 0


def test_only_touched_partitions_are_written(spark, tmp_path):
    from datetime import date

    from soldscope.plans.reformat import repair_colors
    from soldscope.schema import SOLD

    path = tmp_path / "sold"
    store = SnapshotStore(spark, str(path))
    days = [date(2026, 5, d) for d in (1, 2, 3)]
    rows = [{"shop": "F", "snapshot_date": d, "item_id": "x", "color": "['Black']" if d == days[1] else "Red"} for d in days]
    rows.append({"shop": "F", "snapshot_date": None, "item_id": "x", "color": "Red"})
    kept = [tuple(r.get(f.name) for f in SOLD.fields) for r in rows]
    store.overwrite_dates(spark.createDataFrame(kept, SOLD))
    assert {(r.shop, r.snapshot_date) for r in store.stored_dates().collect()} == {("F", d) for d in [*days, None]}
    files = lambda: {str(p): p.stat().st_mtime_ns for p in path.rglob("*.parquet")}
    before = files()
    counts = repair_colors(store).first()
    assert (counts.scanned, counts.changed) == (4, 1)
    after = files()
    gone = [p for p in before if p not in after]
    assert len(gone) == 1 and "snapshot_date=2026-05-02" in gone[0]
    assert all(after[p] == t for p, t in before.items() if p in after)
    assert store.read().count() == 4


def test_python_functions_reach_workers_elsewhere(tmp_path):
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parent.parent
    (tmp_path / "F").mkdir()
    (tmp_path / "F" / "x.csv").write_text('id,品牌,颜色\n1,Dior,"deep\nred"\n', encoding="utf-8")
    code = f"""
import sys; sys.path.insert(0, {str(root)!r})
from soldscope.session import local_session
from soldscope.sources import landing
spark = local_session(2)
print([r.color for r in landing.records(landing.read_cells(spark, "F")).collect()])
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=240)
    assert "['deep\\nred']" in done.stdout, done.stderr[-2000:]
