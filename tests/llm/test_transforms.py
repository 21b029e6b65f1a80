"""Importance resampling, WARC bundles and fill-in-middle against brute force and round trips."""

import base64
import hashlib
import io
import math
import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from soldscope.llm import fim, resample, warc
from tests.llm.helpers import key

# ---- fill-in-middle


def _brute_fim(doc_id, text, marks=("<P>", "<S>", "<M>"), plain=10, spm=20, seed="1"):
    text = text or ""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in marks) or h3 % 100 >= 100 - plain:
        return doc_id, n, "plain", None, None, text
    x, y, z = ("".join(part) for part in (units[:a], units[a:b], units[b:]))
    p, s, m = marks
    if h4 % 100 < spm:
        return doc_id, n, "spm", len(x), len(y), s + z + p + x + m + y
    return doc_id, n, "psm", len(x), len(y), p + x + s + z + m + y


def _fim_texts(spark, odd):
    rng = random.Random(5)
    letters = "abz AZ09\n\t\r<>$\\é𝐀ﷺ _"
    rows = [(i, "".join(rng.choices(letters, k=rng.randrange(0, 60)))) for i in range(100, 400)]
    rows += [(1000 + i, f"has {m} inside") for i, m in enumerate(("<P>", "<S>", "<M>"))]
    rows += [(2000 + i, "x" * 300_000 + " y " * 100_000) for i in range(4)]  # one unit of many letters, then many units
    return odd.select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id long, text string"))


def test_fill_in_middle_equals_brute_force_and_restores(spark, odd):
    docs = _fim_texts(spark, odd)
    made = fim.fill_in_middle(docs).withColumn("again", fim.restored("output", "form"))
    rows = made.collect()
    want = [_brute_fim(r.doc_id, r.text) for r in docs.collect()]
    got = [(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in rows]
    assert sorted(got, key=key) == sorted(want, key=key)
    assert {r.form for r in rows} == {"plain", "psm", "spm"}
    assert all(r.again == r.text for r in rows)


def test_fill_in_middle_with_other_marks_and_shares(spark, odd):
    marks = fim.Marks("[pre]", "[suf]", "[mid]")
    docs = _fim_texts(spark, odd).where("doc_id < 1500 or doc_id is null")
    made = fim.fill_in_middle(docs, seed="x", plain_percent=0, spm_percent=50, marks=marks)
    want = [_brute_fim(r.doc_id, r.text, marks.all, 0, 50, "x") for r in docs.collect()]
    got = [(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in made.collect()]
    assert sorted(got, key=key) == sorted(want, key=key)
    assert made.where(fim.restored("output", "form", marks) != F.col("text")).count() == 0


def test_fill_in_middle_needs_no_shuffle_and_no_python(odd, nothing):
    plan = fim.fill_in_middle(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Arrow" not in plan and "EvalPython" not in plan
    assert fim.fill_in_middle(nothing).count() == 0


# ---- importance resampling


def _words(text):
    small = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", small)


def _features(text, longest, buckets):
    w = _words(text)
    runs = [" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]
    return [zlib.crc32(r.encode()) % buckets for r in runs]


@pytest.mark.parametrize("longest, block", [(1, 1 << 20), (3, 1 << 20), (4, 7), (2, 40)])
def test_run_crcs_follow_from_running_ones(monkeypatch, longest, block):
    monkeypatch.setattr(resample, "BLOCK", block)
    rng = random.Random(longest)
    texts = ["", None, "one", "A-b c", " .. ", "é𝐀 ﷺx\x00y Z9", "same same same same"]
    texts += ["".join(rng.choices("ab C1é .,\n", k=rng.randrange(0, 300))) for _ in range(40)]
    texts.append("long " * 5_000)
    got = Counter()
    for row, bucket, n in resample.features([None if t is None else t.encode() for t in texts], longest, 10_000):
        got.update(zip(row.tolist(), bucket.tolist()))
    want = Counter((i, b) for i, t in enumerate(texts) for b in _features(t, longest, 10_000))
    assert got == want


def test_crc_shift_over_many_lengths():
    import numpy as np

    rng = random.Random(1)
    a, b = rng.randbytes(70_000), rng.randbytes(70_000)
    lengths = [0, 1, 2, 3, 255, 256, 65_535, 65_536, 70_000]
    before = np.array([zlib.crc32(a)] * len(lengths), np.uint32)
    through = np.array([zlib.crc32(a + b[:n]) for n in lengths], np.uint32)
    assert resample.part_crc(before, through, np.array(lengths)).tolist() == [zlib.crc32(b[:n]) for n in lengths]


def _brute_resample(docs, target, longest, buckets, least, percent):
    s = Counter(b for _, t in docs for b in _features(t, longest, buckets))
    t = Counter(b for x in target for b in _features(x, longest, buckets))
    S, T = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets))))
    rows = []
    for doc_id, text in docs:
        f = _features(text, longest, buckets)
        weight = sum(map(gain, f)) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((doc_id, len(_words(text)), len(f), weight, score))
    enough = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is not None, r[0]))
    return rows, enough[: len(enough) * percent // 100]


@pytest.mark.parametrize("longest, least, percent", [(1, 20, 10), (2, 2, 50), (1, 0, 100), (3, 0, 0)])
def test_resample_equals_brute_force(spark, odd, longest, least, percent):
    rng = random.Random(percent)
    more = [(i, " ".join(rng.choices(["Alpha", "beta", "g7", "δ"], k=rng.randrange(0, 40)))) for i in range(50, 250)]
    more += [(None, "beta beta Alpha " * 9)] * 120  # a third of all rows: one text, no id
    docs = odd.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    target = spark.createDataFrame([("alpha BETA g7",), (None,), ("δ",), ("",)], "text string")
    got = resample.resample(docs, target, longest, 100, least, percent).collect()
    rows, drawn = _brute_resample(
        [(r.doc_id, r.text) for r in docs.collect()], [r.text for r in target.collect()], longest, 100, least, percent
    )
    assert sorted(((r.doc_id, r.n_words, r.n_features, r.weight, r.score) for r in got), key=key) == sorted(rows, key=key)
    ranked = sorted((r for r in got if r.rank is not None), key=lambda r: r.rank)
    assert [r.rank for r in ranked] == list(range(1, len(drawn) + 1))
    assert [(r.doc_id, r.score) for r in ranked] == [(r[0], r[4]) for r in drawn]


def test_resample_of_empty_tables(spark, odd, nothing):
    assert resample.resample(nothing, odd).count() == 0
    assert resample.resample(odd, nothing, least_words=0, percent=100).where("rank is null").count() == 0


# ---- WARC


def _pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, frame int, key string, size string")


def _odd_pages(spark):
    big = "<p>" + "text " * 400_000
    rows = [
        (1, "http://a/", "<p>one</p>"),
        (2, None, "<p>one</p>"),
        (3, "http://a/b c\r\nX: y", None),
        (4, "http://é/𝐀", ""),
        (5, "http://a/5", big),
        (6, "http://a/6", big),
        (None, "http://a/n", "<p>one</p>"),
        (None, None, None),
        (None, "http://only", "without any id"),
        (7, "http://a/7", "WARC/1.1\r\n\r\n\r\n"),
        (7, "http://a/7", "WARC/1.1\r\n\r\n\r\n"),
        (7, "http://a/7", "other page of the id"),
        (0, "http://a/0", "é𝐀ﷺ\x00"),
    ]
    return _pages(spark, [(*r, 1, "k", "s") for r in rows])


def _brute_pages(rows, least):
    first = {}
    for r in rows:
        if r.page_id is not None:
            first[r.html or ""] = min(first.get(r.html or "", r.page_id), r.page_id)
    out = []
    for r in rows:
        data = (r.html or "").encode()
        head = first.get(r.html or "") if len(data) >= least else r.page_id
        same = r.page_id == head
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((r.page_id, len(data), digest, "response" if same else "revisit", None if same else head))
    return out


@pytest.mark.parametrize("least, sizes", [(0, {}), (5, {"frame_bytes": 300, "bundle_bytes": 1}), (10**9, {"frame_bytes": 1})])
def test_archive_round_trip(spark, least, sizes):
    pages = _odd_pages(spark)
    index = warc.write_archive(pages, least=least, **sizes)
    found = warc.read_archive(index).collect()
    rows = pages.collect()
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found]
    assert sorted(got, key=key) == sorted(_brute_pages(rows, least), key=key)
    texts = Counter((r.page_id, bytes(r.payload).decode()) for r in found if r.record_type == "response")
    assert texts.keys() <= {(r.page_id, r.html or "") for r in rows}
    assert all(r.payload is None for r in found if r.record_type == "revisit")
    # every record alone by its identifier, through the frame that holds it
    ids = index.select("record_id").distinct()
    again = warc.fetch(index, ids).collect()
    assert sorted((tuple(r) for r in again), key=key) == sorted((tuple(r) for r in found), key=key)
    one = warc.fetch(index, ids.where(F.col("record_id").startswith("urn:x-page:5:"))).collect()
    assert [r.page_id for r in one] == [5] and bytes(one[0].payload).startswith(b"<p>text")


def test_bundles_are_plain_zstandard_to_others(spark):
    index = warc.write_archive(_odd_pages(spark), frame_bytes=400)
    for (path,) in index.select("bundle").distinct().collect():
        data = open(path.removeprefix("file:"), "rb").read()
        with zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True) as stream:
            whole = stream.read()
        reader = warc.BundleReader(pa.BufferReader(data))
        assert whole == b"".join(reader.frame(i) for i in range(len(reader.sizes)))
        assert whole.startswith(b"WARC/1.1\r\n")


def test_damage_is_seen():
    made = warc.record("response", 1, "http://a", "1970-01-01T00:00:00Z", 3, warc.base32_sha1(b"abc"), None, b"abd")
    fields, block, _ = warc.parsed(made)
    with pytest.raises(ValueError):
        warc.page_row(fields, block, True)
    with pytest.raises(ValueError):
        warc.parsed(made[:-1])


def test_a_hot_payload_meets_in_no_single_task(spark):
    rows = [(i, f"http://a/{i}", "hot" if i % 3 == 0 else f"page {i // 2}", 1, "k", "s") for i in range(3_000)]
    pages = _pages(spark, rows).repartition(8)
    decided = warc.with_decisions(pages)
    got = decided.collect()
    want = {r[0]: r for r in _brute_pages(pages.collect(), 0)}
    assert all((r.kind, r.first) == want[r.page_id][3:] for r in got) and len(got) == 3_000
    assert max(decided.groupBy(F.spark_partition_id()).count().toPandas()["count"]) < 2_000


def test_archive_of_an_empty_table(spark):
    index = warc.write_archive(_pages(spark, []))
    assert index.count() == 0 and warc.read_archive(index).count() == 0 and warc.fetch(index, index).count() == 0
