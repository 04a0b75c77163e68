"""Quality, periodic runs and hard negatives against brute force, held-out rows and awkward rows."""

import hashlib
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as E
from pricelens.llm import negatives, quality, queries, runs, sql
from pricelens.llm.text import Words, chunks

from .conftest import DIR, ODD

SEEN = [(i, t or "") for i, t, *_ in ODD if i is not None]


def sha(x):
    return hashlib.sha256(x).hexdigest()


# ---- quality -----------------------------------------------------------------------

def auc(score, label):
    rank = np.argsort(np.argsort(score)) + 1
    good = label == 1
    return (rank[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())


def test_quality_held_out(spark):
    """At sf0.01: 0.1 of the rows can't tell good from bad, so AUC and both recalls are held."""
    where = DIR.replace("sf0.001", "sf0.01")
    label = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{where}/labels.parquet' WHERE quality IS NOT NULL").fetchall())
    got = {r["doc_id"]: r for r in queries.op11_quality(spark, where).collect()}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got.values())
    held = [i for i in label if i in got and got[i]["held_out"]]
    y = np.array([label[i] for i in held])
    p = np.array([got[i]["predicted"] for i in held])
    assert auc(np.array([got[i]["score"] for i in held]), y) > 0.97
    assert p[y == 1].mean() > 0.95 and p[y == 0].mean() < 0.2


def test_quality_attention_finds_the_passage():
    """Only one passage of a long text is bad; labels are those of whole texts."""
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(200)]
    texts = []
    for k in range(240):
        text = list(rng.choice(words, 48 * 12))
        if k % 2:
            at = 48 * int(rng.integers(0, 12))
            text[at:at + 48] = ["$$$ ###"[:3]] * 48
        texts.append(" ".join(text))
    bags = []
    for c in chunks(pa.array(texts, pa.large_string())):
        count, blocks = quality.passages(c)
        x = np.concatenate(list(blocks))
        bags += np.split(x, np.cumsum(count)[:-1])
    y = np.array([1 - k % 2 for k in range(240)])
    model = quality.fit(bags[:180], y[:180], epochs=20)
    assert auc(model.scores(pa.array(texts[180:], pa.large_string())), y[180:]) > 0.95
    h, e = model.encode(bags[181])
    a = quality.weighted(h, e, np.array([0]))[1]
    assert len(a) == 12 and abs(a.sum() - 1) < 1e-5


def test_quality_gradients():
    rng = np.random.default_rng(3)
    size = np.array([3, 1, 4])
    x = rng.normal(size=(8, quality.SLOTS + quality.SHARES))
    h, g = quality.HIDDEN, quality.GATES
    p = {"w": rng.normal(0, .05, (x.shape[1], h)), "b": rng.normal(size=h), "v": rng.normal(0, .3, (h, g)), "u": rng.normal(0, .3, (h, g)),
         "attend": rng.normal(size=g), "c": rng.normal(0, .3, h), "bias": np.array([0.1])}
    y, weight, first = np.array([1., 0, 1]), np.array([1., 2, .5]), np.cumsum(size) - size

    def loss(p):
        hid = np.tanh(x @ p["w"] + p["b"])
        e = (np.tanh(hid @ p["v"]) * quality.sigmoid(hid @ p["u"])) @ p["attend"]
        o = quality.weighted(hid, e, first)[0] @ p["c"] + p["bias"][0]
        return (weight * (np.log1p(np.exp(o)) - y * o)).sum()

    d = quality.gradients(p, x, first, y, weight)
    for name in p:
        at = tuple(int(rng.integers(0, s)) for s in p[name].shape)
        up, down = (p | {name: p[name].copy()} for _ in range(2))
        up[name][at] += 1e-5
        down[name][at] -= 1e-5
        assert abs((loss(up) - loss(down)) / 2e-5 - d[name][at]) < 1e-5


def test_quality_passages_cover_whole_texts(monkeypatch):
    """Passages of long texts, encoded in blocks, equal those of one block."""
    rng = np.random.default_rng(6)
    texts = [" ".join(rng.choice(["aa", "b", "ccc", "dé"], n)) for n in (0, 1, 47, 48, 49, 5000)]
    whole = [np.concatenate(list(quality.passages(c)[1])) for c in chunks(pa.array(texts, pa.large_string()))]
    monkeypatch.setattr(quality, "BLOCK", 7)
    parts = [np.concatenate(list(quality.passages(c)[1])) for c in chunks(pa.array(texts, pa.large_string()))]
    assert all(np.allclose(a, b, atol=1e-6) for a, b in zip(whole, parts)) and len(whole[0]) == 1 + 1 + 1 + 1 + 2 + 105
    assert len(quality.pooled(whole[0])) == 64 and np.isfinite(whole[0]).all()


def test_quality_odd(spark, odd, empty):
    labels = spark.createDataFrame([(1, 0), (5, 1), (2, None), (None, 1), (7, 0), (7, 0), (8, 1)], "doc_id long, quality int")
    model = quality.train(odd, labels)
    got = quality.score(odd, model, 0.3, ("lang",)).collect()
    assert len(got) == len(SEEN) and all(0 <= r["score"] <= 1 for r in got)
    by = {r["doc_id"]: r["score"] for r in got}
    assert by[2] == by[3] and abs(by[10] - by[11]) < 1e-9
    one = quality.train(odd, labels.filter("quality = 0"))
    assert max(r["score"] for r in quality.score(odd, one).collect()) < 0.01
    none = quality.train(odd, labels.limit(0))
    assert max(r["score"] for r in quality.score(odd, none).collect()) < 0.01
    assert quality.score(empty, model).count() == 0
    again = {r["doc_id"]: r["score"] for r in quality.score(odd, quality.train(odd, labels)).collect()}
    assert again == by


# ---- runs --------------------------------------------------------------------------

def all_runs(w, least=12):
    """Every run, by trying every period at every place."""
    out = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                out.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted(((i, n, q) for (i, n), q in out.items()), key=lambda r: (r[0], r[2]))


def collapsed(w, found):
    gone = set()
    for i, n, q in found:
        gone.update(range(i + q, i + n))
    return b" ".join(x for k, x in enumerate(w) if k not in gone)


def test_runs_against_brute_force(spark):
    text = dict(duckdb.sql(f"SELECT doc_id, text FROM '{DIR}/documents.parquet'").fetchall())
    got = {r["doc_id"]: r for r in queries.op12_runs(spark, DIR).collect()}
    assert set(got) == set(text)
    some = 0
    for i, t in text.items():
        w = (t or "").encode().split()
        h = zlib.crc32(str(i).encode())
        if h % 10 == 0 and w:
            g = h // 10
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(len(w))]
        if len(w) > 1500:       # brute force is quadratic; long ones in the next test
            continue
        found = all_runs(w)
        some += bool(found)
        r = got[i]
        best = min(found, key=lambda x: (-x[1], x[0], x[2]), default=(None,) * 3)
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(found), *best)
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if found else None)
        assert r["runs_sha256"] == sha("".join(f"{a},{b},{c}\n" for a, b, c in found).encode())
        assert r["collapsed_sha256"] == sha(collapsed(w, found))
    assert some > 10


def test_runs_of_made_texts():
    """Fibonacci words, few letters, planted periods and shared texts, many documents a chunk."""
    rng = np.random.default_rng(1)
    fib = ["a", "a b"]
    while len(fib) < 13:
        fib.append(f"{fib[-1]} {fib[-2]}")
    texts = ["", " \n", "a " * 50, "a b " * 40, fib[-1], " ".join("ab" * 10 + "ba" * 10), " ".join("aab" * 7 + "aba" * 9 + "c")]
    for t in range(200):
        n = int(rng.integers(1, 150))
        w = [str(x) for x in rng.integers(0, int(rng.integers(1, 4)) + 1, n)]
        if t % 3 == 0:
            a, p = int(rng.integers(0, n)), 1 + int(rng.integers(0, max(1, n // 3)))
            w = w[:a] + (w[a:a + p] * n)[:n - a]
        texts.append(" \n".join(w + w[:n // 2] + w if t % 5 == 0 else w))
    for size in (1 << 19, 300):
        for c in chunks(pa.array(texts, pa.large_string()), size=size):
            words = Words(c)
            start, length, period = runs.chunk_runs(c, words)
            kept = runs.kept_texts(c, words, runs.repeated(len(words.start), start + period, start + length)).to_pylist()
            for i in range(len(c)):
                own = words.doc[start] == i
                w = c.raw(i).split()
                want = all_runs(w)
                assert list(zip((start[own] - words.first[i]).tolist(), length[own].tolist(), period[own].tolist())) == want
                assert kept[i].encode() == collapsed(w, want)


def test_wavelet_matrix():
    rng = np.random.default_rng(2)
    v = rng.permutation(500)
    tree = runs.WaveletMatrix(v)
    for _ in range(200):
        lo, hi = np.sort(rng.integers(0, 501, 2))
        x = int(rng.integers(0, 600))
        assert tree.less(np.array([lo]), np.array([hi]), np.array([x]))[0] == (v[lo:hi] < x).sum()
        if hi > lo:
            k = int(rng.integers(0, hi - lo))
            assert tree.pick(np.array([lo]), np.array([hi]), np.array([k]))[0] == np.sort(v[lo:hi])[k]


def test_runs_odd(spark, odd, empty):
    got = {r["doc_id"]: r for r in runs.find_runs(odd).collect()}
    for i, t in SEEN:
        w = t.encode().split()
        found = all_runs(w) if len(w) < 2000 else [(0, len(w), 1)]
        assert list(got[i]["runs"]) == [x for r in found for x in r] and got[i]["n_words"] == len(w)
        assert got[i]["text"].encode() == collapsed(w, found)
    assert None not in got and runs.find_runs(odd).count() == len(SEEN)
    assert runs.find_runs(empty).count() == 0
    with pytest.raises(ValueError):
        runs.chunk_runs(None, None, 4)


def test_runs_of_a_text_larger_than_a_chunk(spark):
    rng = np.random.default_rng(8)
    unit = " ".join(str(x) for x in rng.integers(0, 10 ** 9, 30_000))
    head = " ".join(str(x) for x in rng.integers(0, 10 ** 9, 1_001))
    got = runs.find_runs(spark.createDataFrame([(1, f"{head}\n{unit} {unit} {unit} x")], "doc_id long, text string")).first()
    assert list(got["runs"]) == [1_001, 90_000, 30_000] and got["text"] == f"{head} {unit} x"


# ---- hard negatives ----------------------------------------------------------------

def mined(rows, positives=5, negatives_=3):
    """By scoring every pair with Python's whole numbers."""
    out = []
    for a, label, c in rows:
        if a % 50:
            continue
        scored = sorted(((sum(x * y for x, y in zip(c, d)), i, other) for i, other, d in rows if i != a and len(c) == len(d)),
                        key=lambda r: (-r[0], r[1]))
        for s, p, _ in [r for r in scored if r[2] == label][:positives]:
            fit = [r for r in scored if r[2] != label and 50 * s <= 100 * r[0] <= 95 * s][:negatives_]
            out += [(a, p, k + 1, n, s, t) for k, (t, n, _) in enumerate(fit)]
    return sorted(out)


def test_negatives_agree_with_sql(spark):
    con = duckdb.connect()
    where = DIR.replace("sf0.001", "sf0.01")
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{where}/embeddings.parquet'")
    got = E.queries()["op13_negatives"](spark, where)
    cols = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({sql.SQL['op13_negatives']})").fetchall()
    assert want and Counter(tuple(r[c] for c in cols) for r in got.collect()) == Counter(want)


@pytest.mark.parametrize("block", [4, 1000])
def test_negatives_against_all_pairs(spark, monkeypatch, block):
    """Ties, equal vectors, very large and negative components, two lengths; several blocks and small tiles."""
    monkeypatch.setattr(negatives, "ROWS", 16)
    rng = np.random.default_rng(block)
    rows = []
    for i in range(0, 1000, 10):
        e = (rng.integers(-3, 9, 4) / 4).tolist()
        if i % 30 == 0:
            e = [1.0, 0.5, 0.25, 2.0]
        if i % 70 == 0:
            e = [x * 2.0 ** 20 for x in e]
        rows.append((i, i // 10 % 3, e if i % 110 else e[:3]))
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    got = negatives.hard_negatives(negatives.whole_vectors(df), "vec_id % 50 = 0", block=block)
    want = mined([(i, k, [int(np.floor(256 * float(np.float32(x)))) for x in e]) for i, k, e in rows])
    assert want and sorted(tuple(r) for r in got.collect()) == want


def test_negatives_odd(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, i % 2, [1.0 + i / 100, 0.5]) for i in range(0, 120, 5)]
    bad = [(150, None, [1.0, 1.0]), (200, 1, None), (250, 1, []), (300, 1, [1.0, None]), (350, 0, [nan, 1.0]), (400, 0, [1.0, -inf]),
           (None, 1, [1.0, 1.0]), (450, 1, [1e30, 1.0]), (500, 0, [1.0, 1.0, 1.0])]
    schema = "vec_id long, label int, embedding array<double>, c string, score int, rank string"
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in good + bad + good[:3]], schema)
    got = negatives.hard_negatives(negatives.whole_vectors(df), "vec_id % 50 = 0")
    want = mined([(i, k, [int(np.floor(256 * x)) for x in e]) for i, k, e in good])
    assert want and sorted(tuple(r) for r in got.collect()) == want
    assert negatives.hard_negatives(negatives.whole_vectors(df.limit(0)), "vec_id % 50 = 0").count() == 0
    assert negatives.hard_negatives(negatives.whole_vectors(df.filter("label is null")), "true").count() == 0
    top = spark.createDataFrame([(50, 2147483647, [1.0])], "vec_id long, label int, embedding array<float>")
    assert negatives.whole_vectors(top, "if(true, (label + 1L) % 10, label)").first()["label"] == 8


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(4)
    x = rng.integers(-200, 200, (60, 8))
    x[30:] = x[:30] + rng.integers(-3, 4, (30, 8))
    tree = negatives.Tree(np.arange(60), np.zeros(60, np.int64), x)
    some = negatives.Rows(np.arange(500), np.zeros(500, np.int64), rng.integers(-200, 200, (500, 8)))
    exact = tree.x @ some.x.T
    seen = []

    def wanted(at, low, high):
        assert (low <= exact[at]).all() and (exact[at] <= high).all()
        need = high >= 60_000
        seen.append(need)
        return need

    for i, j, s in negatives.rescored(tree, some, wanted):
        assert (exact[i, j] == s).all()
    assert 0 < np.concatenate(seen).mean() < 0.5        # many pairs are never scored
    total = sum(tree.far)
    assert total < np.sqrt(((tree.x[1:] - tree.x[:-1]).astype(float) ** 2).sum(1)).sum()
