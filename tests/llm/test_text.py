"""Tokens, packing, secrets, classifiers, language model and vectors against brute force."""

import base64
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from soldscope.llm import bpe, lattice_lm, packing, quality, secrets, toxicity, vector_topk
from soldscope.llm.common import crc_remainder, id_remainder, table
from soldscope.llm.queries import ORACLES, QUERIES, packed
from tests.llm.helpers import key

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_their_sql(spark, name):
    import oracle

    assert oracle.compare(QUERIES[name](spark, SMALL), oracle.connect(SMALL), ORACLES[name]) is None


# ---- byte-level BPE


def _tiktoken():
    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_and_bytes_of_every_text(spark, odd):
    coder = _tiktoken()
    docs = odd.select("doc_id", "text").unionByName(table(spark, SMALL, "documents").select("doc_id", "text"))
    docs = docs.unionByName(spark.createDataFrame([(-1, "<|endoftext|> a  b\u0085c 𝐀👩‍👩‍👧 ١٢٣ don't 's " + "x" * 500 + " " * 90)], docs.schema))
    want = []
    for r in docs.collect():
        ids = coder.encode_ordinary(r.text or "")
        raw = np.array(ids, "<u4").tobytes()
        want.append((r.doc_id, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()))
    got = bpe.digests(docs, RANKS, PATTERN).collect()
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_offsets_and_split_characters(spark):
    text = "naïve 𝐀𝐁 ﷺ end"
    docs = spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")
    coded = bpe.encoded(docs, RANKS, PATTERN, with_offsets=True)
    rows = {r.doc_id: r for r in coded.collect()}
    pieces = [bpe.byte_table(RANKS)[i] for i in rows[1].ids]
    at = 0
    for piece, start, end in zip(pieces, rows[1].start, rows[1].end):
        assert text[start:end].encode().find(piece) >= 0
        at += len(piece)
    assert at == len(text.encode()) and rows[1].end[-1] == len(text)
    assert any(a < b for a, b in zip(rows[1].start[1:], rows[1].end))  # a character in two tokens
    back = {r.doc_id: bytes(r.bytes) for r in bpe.decoded(coded, RANKS).collect()}
    assert back == {1: text.encode(), 2: b""}
    part = spark.createDataFrame([(1, rows[1].ids[:4]), (2, None)], "doc_id long, ids array<int>")
    assert {r.doc_id: bytes(r.bytes) for r in bpe.decoded(part, RANKS).collect()}[1] == b"".join(pieces[:4])


# ---- packing


def _check_packing(rows, docs, capacity=2048):
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for doc_id, text in docs:
        ids = whole.encode(text or "", add_special_tokens=False).ids + [0]
        first = len(ids) % capacity or min(len(ids), capacity)
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want.append((doc_id, i, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=key) == sorted(want, key=key)
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held), -(-sum(r.length for r in rows) // capacity)


def test_packing_is_gapless_and_tight(spark, odd):
    docs = table(spark, MIDDLE, "documents")
    used, least = _check_packing(packed(docs).collect(), [(r.doc_id, r.text) for r in docs.collect()])
    assert used <= least * 1.02 + 1
    odd = odd.unionByName(odd.where("doc_id = 4").withColumn("text", F.lit("a<|endoftext|>b")))
    _check_packing(packed(odd).collect(), [(r.doc_id, r.text) for r in odd.collect()])


def test_plan_places_every_length():
    rng = np.random.default_rng(1)
    for _ in range(150):
        cap = int(rng.integers(4, 60))
        counts = {int(s): int(rng.integers(1, 40)) for s in rng.integers(1, cap + 1, rng.integers(1, 12))}
        plan = packing.plan(dict(counts), cap, int(rng.integers(1, 8)))
        met = Counter()
        for pattern, n in plan:
            assert n > 0 and sum(s * k for s, k in pattern) <= cap
            for s, k in pattern:
                met[s] += k * n
        assert met == counts
    assert packing.plan({}) == []


def test_configurations_beat_single_lengths():
    found = packing.configurations([60, 40], [10, 10], 100)
    assert sum(level for _, level in found) == pytest.approx(10)  # 60 with 40, ten times


# ---- secrets


def test_trigram_queries():
    q = secrets.trigram_query
    assert q(secrets.RULES[2].pattern) == []
    assert set(map(frozenset, q("abcd|xyz"))) == {frozenset({"abc", "bcd"}), frozenset({"xyz"})}
    assert q("AKIA[A-Z0-9]{16,}") == [frozenset({"aki", "kia"})]
    assign = q(secrets.RULES[0].pattern)
    assert {"api", "i_k"} <= set().union(*assign) and frozenset({"tok", "oke", "ken"}) in assign
    assert q("(abc)+x*(de)?fgh") and q("a.c") == []


def _brute_spans(text):
    """The base spans, found with Python's own matcher."""
    out = []
    assign = r"""(?ia)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    assign = re.sub(r"\(\?ia\)", "", assign)
    for rank, (kind, pattern, group, least, flags) in enumerate(
        [("assign", assign, 2, 6, re.I | re.A), ("access", "AKIA[A-Z0-9]+", 0, 20, 0), ("hex", "[0-9a-f]+", 0, 24, 0)]
    ):
        out += [(m.start(), rank, kind, m.end()) for m in re.finditer(pattern, text, flags) if len(m[group]) >= least]
    return sorted(out)


SECRETS = [
    "password: hunter22 and TOKEN = 'abc' secret:token: abcdef",
    "AKIA" + "B" * 16 + " AKIAAKIA" + "C" * 12 + " AKIA1234",
    "é𝐀 api_key=\"q9+/_.=-zz\" " + "deadbeef" * 3 + "g" + "0" * 23,
    "token=AKIA" + "D" * 20 + " password = " + "ab12" * 8,
    "passwd:" * 3 + "secret",
    "-----BEGIN RSA PRIVATE KEY-----", "ghp_" + "a" * 36, "", None,
]


def test_spans_and_masks(spark):
    docs = spark.createDataFrame([(i % 4 or None, t, "x", 1) for i, t in enumerate(SECRETS)], "doc_id long, text string, spans string, base int")
    found = secrets.secret_spans(docs).withColumn("b", secrets.joined_spans("base")).collect()
    want = sorted((i % 4 or None, ",".join(f"{k}:{s}:{e}" for s, _, k, e in _brute_spans(t or ""))) for i, t in [(i, t) for i, t in enumerate(SECRETS)] if i % 4)
    assert sorted((r.doc_id, r.b) for r in found if r.doc_id) == want
    assert sum(r.n_pem + r.n_github for r in found) == 2
    masked = secrets.mask_secrets(docs, mask="#")
    assert masked.columns == docs.columns
    texts = {r.text for r in masked.collect()}
    assert "é𝐀 #\" #g" + "0" * 23 in texts and "#" in texts and None in texts and "" in texts
    assert "# and TOKEN = 'abc' secret:token: abcdef" in texts  # too short a value, and it uses up what follows
    assert "passwd:" * 3 + "secret" not in texts


def test_secrets_of_odd_rows(odd, nothing):
    assert secrets.secret_spans(nothing).count() == 0 and secrets.mask_secrets(nothing).count() == 0
    got = {(r.doc_id, r.n_assign) for r in secrets.secret_spans(odd).collect()}
    assert (8, 1) in got and len(got) == 9
    assert secrets.mask_secrets(odd).where("doc_id = 8").first().text == "é𝐀ﷺ [secret]"
    only = secrets.secret_spans(odd, (secrets.RULES[2],)).count()
    assert only == odd.count()


# ---- classifiers


def _auc(score, y):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    n1 = y.sum()
    return (rank[y == 1].sum() - n1 * (n1 + 1) / 2) / n1 / (len(y) - n1)


@pytest.mark.parametrize(("name", "label", "least"), [("op1_quality", "quality", 0.9), ("op5_toxicity", "toxic", 0.8)])
def test_held_out_accuracy(spark, name, label, least):
    got = QUERIES[name](spark, MIDDLE).toPandas()
    assert len(got) == 1000 and got.score.between(0, 1).all()
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet").toPandas()
    held = got.merge(labels, on="doc_id")
    held = held[held.held_out]
    assert _auc(held.score.to_numpy(), held[label].to_numpy()) >= least


def test_classifiers_of_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(4, 1, 0), (5, 0, 1), (8, 1, 1), (7, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for table_ in (odd, nothing):
        for marks in (labels, labels.where("quality = 1 and toxic = 1"), labels.limit(0)):
            model = quality.fit(quality.quality_sample(table_, marks))
            scores = quality.quality_scores(table_, model).collect()
            assert len(scores) == table_.count() and all(0 <= r.score <= 1 for r in scores)
            assert quality.keep_good(table_, model, 0.0).count() == table_.count()
            model, _ = toxicity.fit(table_, marks)
            scores = toxicity.toxicity_scores(table_, model).collect()
            assert len(scores) == table_.count() and all(0 <= r.score <= 1 for r in scores)


def test_neighbours_are_exact():
    rng = np.random.default_rng(4)
    weights = rng.random((30, 500)) * (rng.random((30, 500)) < 0.2)
    weights /= np.maximum(np.linalg.norm(weights, axis=0), 1e-12)
    index = toxicity.BlockIndex({str(i): i for i in range(30)}, np.ones(30), rng.permutation(500), np.zeros(500), weights)
    for _ in range(20):
        rows = np.sort(rng.choice(30, 5, replace=False))
        w = rng.random(5)
        places, similarity = index.nearest(rows, w, 7)
        whole = w @ index.weights[rows]
        best = np.lexsort((np.arange(500), -whole))[:7]
        best = best[whole[best] > 0]
        assert places.tolist() == best.tolist() and np.allclose(similarity, whole[best])


def test_rare_terms_bring_neighbours(spark):
    """A term of two examples counts as any other; similarities are those of dense TF-IDF over all terms."""
    common = [f"{'abcde'[i % 5]}{'fghij'[i // 5 % 5]}{'klmno'[i // 25 % 5]}" for i in range(125)]
    texts = [" ".join(common[(7 * i + 3 * j) % 125] for j in range(9)) + (" vilest" if i < 200 else " kindest") for i in range(400)]
    texts[3] += " qzxw qzxw"
    texts[150] += " qzxw"
    rows = [(i, t) for i, t in enumerate(texts)] + [(1000, "qzxw"), (1001, "nothing of these")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 200)) for i in range(400)], "doc_id long, toxic int")
    model, counted = toxicity.fit(docs, labels)
    got = {r.doc_id: r for r in toxicity.toxicity_scores(docs, model).collect()}
    # the same from the counted terms
    assert sorted(map(str, toxicity.counted_scores(counted, model).collect())) == sorted(map(str, got.values()))
    assert sorted(got[1000].examples) == [3, 150] and got[1000].vote == 1
    assert got[1001].examples == [] and got[1001].vote == 0

    # the same by hand, every term kept
    def counted(text):
        return Counter(t for word in text.split() for t in [word, *(word[:n] + "*" for n in (4, 5, 6) if len(word) > n)])

    known = {t for text in texts for t in counted(text)}
    df = Counter(t for _, text in rows for t in counted(text))

    def vector(text):
        w = {t: (1 + math.log(n)) * math.log((len(rows) + 1) / (df[t] + 1)) for t, n in counted(text).items() if t in known}
        norm = math.sqrt(sum(x * x for x in w.values()))
        return {t: x / norm for t, x in w.items()}

    held = [vector(t) for t in set(texts)]  # equal texts are one example
    for asked in (0, 77, 250, 1000):
        w = vector(dict(rows)[asked])
        want = sorted((sum(x * v.get(t, 0) for t, x in w.items()) for v in held), reverse=True)
        near = got[asked].similarities
        assert np.allclose(near, [x for x in want[:3] if x > 0])


# ---- language model


def test_lattice_sums_all_segmentations():
    pieces = [b" ", b" a", b" ab", b"a", b"b", b"ab", b"ba", b"bab"]
    share = np.log10(np.array([0.1, 0.2, 0.05, 0.1, 0.2, 0.1, 0.15, 0.1]))
    known = dict(zip(pieces, 10**share))

    def brute(raw):
        return 1.0 if not raw else sum(known[raw[:i]] * brute(raw[i:]) for i in range(1, len(raw) + 1) if raw[:i] in known)

    lattice = lattice_lm.Lattice(pieces, share)
    words = [b"a", b"ab", b"abab", b"bbabab", b"ab" * 40]
    want = [math.log10(brute(b" " + w)) for w in words[:4]]
    assert np.allclose(lattice.words(words)[:4], want) and lattice.one(words[3]) == pytest.approx(want[3])
    assert lattice.words(words)[4] == pytest.approx(lattice.one(words[4]))


def test_lattice_takes_long_pieces():
    lattice = lattice_lm.Lattice([b" ", b"-", b"-" * 32, b" " + b"=" * 64], np.log10([0.1, 0.2, 0.3, 0.4]))
    both, dashes, equals = b"-" * 32, b"-" * 70, b"=" * 64
    want = [math.log10(0.1 * (0.3 + 0.2**32)), math.log10(0.1 * (0.2**70 + 39 * 0.3 * 0.2**38 + 28 * 0.3**2 * 0.2**6)), math.log10(0.4)]
    assert np.allclose(lattice.words([both, dashes, equals]), want)


@pytest.mark.parametrize("shared_words", [5, 100_000])
def test_language_model_counts(spark, odd, nothing, shared_words):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = odd.select("doc_id", "text").unionByName(table(spark, SMALL, "documents").select("doc_id", "text").where("doc_id >= 20"))
    rows = docs.collect()
    words = lambda t: (t or "").encode().lower().split() + [b" end"]
    counts = Counter(w for r in rows if crc_remainder(r.doc_id, 5) != 1 for w in words(r.text))
    total, distinct = sum(counts.values()), len(counts)
    want = [
        (r.doc_id, len(words(r.text)), sum(counts[w] > 0 for w in words(r.text)), total,
         round(sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in words(r.text)), 4))
        for r in rows
    ]
    train = id_remainder("doc_id", 5) != 1
    got = lattice_lm.document_scores(docs, train, path, PATTERN, shared_words).collect()
    assert sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got), key=key) == sorted(want, key=key)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert lattice_lm.document_scores(nothing, train, path, PATTERN).count() == 0


# ---- vectors


def test_topk_of_odd_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(0, 0.1, 8).round(2)]) for i in range(400)]
    rows += [(400 + i, rows[i][1]) for i in range(60)]  # ties
    rows += [(900, None), (950, [None] * 8), (1000, [math.nan] * 8), (None, [0.1] * 8), (1050, [0.1] * 3), (1051, [math.inf] * 8)]
    table_ = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    cells = vector_topk.whole_numbers(F.transform("embedding", lambda x: x * 256))
    vectors = table_.where(vector_topk.usable("embedding")).select("vec_id", cells.alias("cells"), F.lit(1).alias("score"))
    got = vector_topk.exact_topk(vectors.where("vec_id % 50 = 0"), vectors, 5, query_block=4, vector_block=64).collect()
    ints = {i: np.floor(np.array(v) * 256).astype(int) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    want = []
    for q in (i for i in ints if i % 50 == 0):
        found = sorted((-int(ints[q] @ x), i) for i, x in ints.items() if i != q and len(x) == len(ints[q]))[:5]
        want += [(q, n, i, -s) for n, (s, i) in enumerate(found, 1)]
    assert sorted(map(tuple, got)) == sorted(want)
    assert vector_topk.exact_topk(vectors.limit(0), vectors, 5).count() == 0
    assert vector_topk.exact_topk(vectors.where("vec_id = 0"), vectors.where("vec_id < 3"), 5).count() == 2


def _brute_topk(rows, k):
    want = []
    for q, x in sorted(rows):
        found = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in rows if i != q and len(x) == len(y))[:k]
        want += [(q, n, i, -s) for n, (s, i) in enumerate(found, 1)]
    return sorted(want)


@pytest.mark.parametrize("size", [10, 2**28, 2**29 - 1, 2**30])
def test_topk_is_exact_at_any_size(spark, size):
    rng = np.random.default_rng(size)
    rows = [(i, [int(v) for v in rng.integers(-size, size, 6, endpoint=True)]) for i in range(150)]
    rows += [(i, [size] * 6) for i in range(150, 260)]  # copies without number: ties go to the smaller ids
    vectors = spark.createDataFrame(rows, "vec_id long, cells array<long>")
    got = vector_topk.exact_topk(vectors, vectors, 3, query_block=50, vector_block=70)
    assert sorted(map(tuple, got.collect())) == _brute_topk(rows, 3)


def test_topk_never_wraps(spark):
    rows = [(0, [10**18, -(10**18)]), (1, [10**18, 10**18]), (2, [3, 4]), (3, [10**18, 10**18])]
    vectors = spark.createDataFrame(rows, "vec_id long, cells array<long>")
    asked = vectors.where("vec_id = 2")
    assert sorted(map(tuple, vector_topk.exact_topk(asked, vectors, 3).collect())) == [(2, 1, 1, 7 * 10**18), (2, 2, 3, 7 * 10**18), (2, 3, 0, -(10**18))]
    with pytest.raises(Exception, match="leaves 64 bits"):
        vector_topk.exact_topk(vectors, vectors, 2).collect()
    huge = spark.createDataFrame([(0, [1e17 * 256])], "vec_id long, x array<double>")
    with pytest.raises(Exception, match="beyond 64 bits"):
        huge.select(vector_topk.whole_numbers(F.col("x"))).collect()
    assert huge.select(vector_topk.whole_numbers(F.transform("x", lambda v: v / 256))).first()[0] == [10**17]
