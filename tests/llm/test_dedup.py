"""Exact dedup, Jaccard join and suffix dedup against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from soldscope.llm import exact_dedup, jaccard_join, suffix_dedup
from soldscope.llm.common import table
from tests.llm.helpers import key


def _classes(rows):
    by_text = defaultdict(list)
    for r in rows:
        by_text[r.text or ""].append(r.doc_id)
    return by_text


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda t: F.unhex(F.substring(F.sha2(t, 256), 1, 2))])
def test_exact_dedup_compares_texts_where_digests_collide(spark, odd, digest):
    docs = odd.unionByName(odd.where("doc_id = 4").withColumn("text", F.lit("SHORT text")))
    rows = docs.collect()
    by_text = _classes(rows)
    got = exact_dedup.exact_dedup(docs, salts=3, digest=digest).collect()
    want = []
    for r in rows:
        ids = by_text[r.text or ""]
        want.append((r.doc_id, max((i for i in ids if i is not None), default=None), len(ids)))
    assert sorted(((g.doc_id, g.keep_id, g.group_size) for g in got), key=key) == sorted(want, key=key)
    assert sum(g.kept for g in got) == len(by_text)  # one row of each text, repeated rows included


def test_exact_dedup_rows_keep_all_columns(odd):
    kept = exact_dedup.exact_dedup_rows(odd)
    assert kept.columns == odd.columns
    rows = kept.collect()
    assert Counter(r.text or "" for r in rows) == Counter(_classes(odd.collect()).keys())
    ids = {r.text: r.doc_id for r in rows}
    assert ids["short text"] == 4 and ids["same row"] == 7 and ids[max((t for t in ids if t), key=len)] == 6


def test_dedup_of_empty_tables(nothing):
    assert exact_dedup.exact_dedup(nothing).count() == 0
    assert exact_dedup.exact_dedup_rows(nothing).count() == 0
    assert jaccard_join.jaccard_groups(nothing).count() == 0
    assert jaccard_join.keep_one(nothing).count() == 0
    assert suffix_dedup.remove_repeats(nothing).count() == 0


def _brute_links(rows, threshold=0.8):
    """(id, links, smallest id of the group) of every row, by comparing shingle sets."""
    sets = []
    for _, text in rows:
        w = (text or "").lower().split()
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    near = [[j for j in range(len(rows)) if j != i and _similar(s, sets[j], threshold)] for i, s in enumerate(sets)]
    out, seen = [], set()
    for i in range(len(rows)):
        if i in seen:
            continue
        group, open_ = {i}, [i]
        while open_:
            for j in near[open_.pop()]:
                if j not in group:
                    group.add(j)
                    open_.append(j)
        seen |= group
        first = min((rows[j][0] for j in group if rows[j][0] is not None), default=None)
        out += [(rows[j][0], len(near[j]), first) for j in group]
    return sorted(out, key=key)


def _similar(a, b, threshold=0.8):
    if not a and not b:
        return True
    shared = len(a & b)
    return bool(shared) and shared >= threshold * (len(a) + len(b) - shared) - 1e-9


def _near_copies(n=60, most=3):
    rng = random.Random(5)
    base = [[f"w{rng.randint(0, 500)}" for _ in range(rng.randint(40, 160))] for _ in range(6)]
    rows = []
    for i in range(n):
        words = list(rng.choice(base))
        for _ in range(rng.randint(0, most)):
            words[rng.randrange(len(words))] = f"new{rng.randint(0, 9)}"
        rows.append((i, " ".join(words)))
    return rows


@pytest.mark.parametrize("tile", [1024, 7])
def test_jaccard_groups_equal_brute_force(spark, tile):
    rows = _near_copies()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_links, r.group_id) for r in jaccard_join.jaccard_groups(docs, tile=tile).collect()), key=key)
    assert got == _brute_links(rows)


@pytest.mark.parametrize("threshold, most", [(0.5, 12), (0.6, 9), (0.7, 7), (0.9, 2), (1.0, 1)])
def test_jaccard_groups_at_other_thresholds(spark, threshold, most):
    rows = _near_copies(90, most)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard_join.jaccard_groups(docs, threshold).collect()
    assert sorted(((r.doc_id, r.n_links, r.group_id) for r in got), key=key) == _brute_links(rows, threshold)
    kept = sorted(r.doc_id for r in jaccard_join.keep_one(docs, threshold).collect())
    assert kept == sorted({r.group_id for r in got})


def test_screen_follows_the_threshold():
    for threshold in (0.4, 0.5, 0.6, 0.7, 0.8, 0.9):
        bands, rows = jaccard_join.Screen(threshold).shape
        assert (1 - threshold**rows) ** bands <= jaccard_join.MISS and bands * rows <= jaccard_join.VALUES
    assert jaccard_join.Screen().shape == (30, 5)
    with pytest.raises(ValueError):
        jaccard_join.Screen(0.01).shape


def test_jaccard_odd_rows(odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = sorted(((r.doc_id, r.n_links, r.group_id) for r in jaccard_join.jaccard_groups(odd).collect()), key=key)
    assert got == _brute_links(rows)
    kept = jaccard_join.keep_one(odd)
    assert kept.columns == odd.columns
    # one of each group; the row repeated with id and text stays twice
    assert kept.count() == len({g for *_, g in got}) + 1 + 1  # id 7 names two groups


def test_pruning_keeps_pairs_at_the_threshold():
    rng = np.random.default_rng(2)
    pairs = 300
    sets = []
    for _ in range(pairs):
        shared = rng.integers(0, 2**63, 160).astype(np.uint64)
        for _ in range(2):
            sets.append(np.unique(np.concatenate([shared, rng.integers(0, 2**63, 20).astype(np.uint64)])))
    screen = jaccard_join.Screen()
    signed = jaccard_join.signatures(sets, screen.values)
    x, y = np.arange(0, 2 * pairs, 2), np.arange(1, 2 * pairs, 2)
    assert len(jaccard_join.pruned(signed, x, y, screen.steps)[0]) == pairs
    far = jaccard_join.pruned(signed, x[:-1], y[1:], screen.steps)[0]
    assert len(far) == 0
    keys = jaccard_join.band_keys(signed, screen.shape[0])
    assert (keys[x] == keys[y]).any(axis=1).all()


def _brute_repeats(rows, length):
    counts = Counter()
    for _, text in rows:
        raw = (text or "").encode()
        counts.update(raw[i : i + length] for i in range(len(raw) - length + 1))
    out = []
    for doc_id, text in rows:
        raw = (text or "").encode()
        cover = np.zeros(len(raw) + 1, int)
        for i in range(len(raw) - length + 1):
            if counts[raw[i : i + length]] > 1:
                cover[i] += 1
                cover[i + length] -= 1
        on = (np.cumsum(cover)[:-1] > 0).astype(int)
        kept = bytes(b for b, gone in zip(raw, on) if not gone)
        spans = int((np.diff(np.concatenate([[0], on])) == 1).sum())
        out.append((doc_id, len(raw), int(on.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=key)


def _passages():
    rng = random.Random(3)
    base = ["".join(rng.choice("abcde ") for _ in range(rng.randint(1, 300))) for _ in range(30)]
    rows = []
    for i in range(120):
        text = "".join(rng.choice(base)[rng.randint(0, 20) : rng.randint(20, 300)] + rng.choice("xyzé") for _ in range(rng.randint(0, 6)))
        if i % 11 == 0:
            text = "a" * rng.randint(0, 400)
        if i % 13 == 0:
            text = "ab" * rng.randint(0, 200)
        rows.append((i if i % 19 else None, None if i % 17 == 0 else text))
    return rows


@pytest.mark.parametrize("group_bytes", [1_000_000, 150])
def test_suffix_dedup_equals_brute_force(spark, group_bytes):
    rows = _passages()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = suffix_dedup.remove_repeats(docs, 50, gram=10, group_bytes=group_bytes).collect()
    assert sorted((tuple(r)[:5] for r in got), key=key) == _brute_repeats(rows, 50)


def test_suffix_dedup_on_test_table(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    got = suffix_dedup.remove_repeats(docs, with_bytes=True).collect()
    assert sorted((tuple(r)[:5] for r in got), key=key) == _brute_repeats([(r.doc_id, r.text) for r in docs.collect()], 200)
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got)


def test_suffix_dedup_tells_rows_apart_whatever_their_ids(spark, monkeypatch):
    rng = random.Random(8)
    word = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage = word(220)
    # a third of all rows: no id and one text; others share an id or have none
    rows = [(None, word(300) + passage), (1, passage + word(100)), (None, word(900)), (1, word(900))] * 1
    rows += [(None, "x" + passage[:180])] * 40 + [(None, word(500)) for _ in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    # hashes of whole texts that always meet must change nothing
    monkeypatch.setattr(F, "hash", lambda *c: F.lit(1))
    monkeypatch.setattr(F, "xxhash64", lambda *c: F.lit(1).cast("long"))
    got = suffix_dedup.remove_repeats(docs).collect()
    assert sorted((tuple(r)[:5] for r in got), key=key) == _brute_repeats(rows, 200)
    assert sum(r.n_removed > 0 for r in got) == 2


def test_suffix_dedup_odd_rows(odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = suffix_dedup.remove_repeats(odd).collect()
    assert sorted((tuple(r)[:5] for r in got), key=key) == _brute_repeats(rows, 200)


def test_run_index_matches_all_suffixes():
    text = np.concatenate([np.frombuffer(b"abracadabra abracadabra cad", np.uint8).astype(np.int32), [300]])
    index = suffix_dedup.RunIndex(text)
    assert index.lengths.sum() == len(text)
    order = suffix_dedup.suffix_order(text)
    assert [tuple(text[i:]) for i in order] == sorted(tuple(text[i:]) for i in range(len(text)))
