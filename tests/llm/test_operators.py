"""Each operator against a brute-force version on whole small tables, and on awkward rows."""

import hashlib
import itertools
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from pricelens.llm import (fingerprints, jaccard, langid, lattice, linededup, mixing, packing, queries, sql, substrings,
                           suffixes, toxicity)
from pricelens.llm.text import Words, chunks, pack, unpacked

from .conftest import DIR, ODD

SEEN = [(i, t or "") for i, t, *_ in ODD if i is not None]


def rows_of(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def shingles(text):
    w = text.encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def test_words_are_ascii_white_space_runs():
    texts = [t for _, t in SEEN] + ["a\x85b c　d", "end. ", "\x1cx"]
    for c in chunks(pa.array(texts, pa.large_string()), size=100):
        w = Words(c)
        for i in range(len(c)):
            got = [c.data[w.start[k]:w.end[k]].tobytes() for k in range(w.first[i], w.first[i + 1])]
            assert got == c.raw(i).split()


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n in sql.SQL])
def test_sql_agrees(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    got = E.queries()[name](spark, DIR)
    cols = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({sql.SQL[name]})").fetchall()
    assert Counter(tuple(r[c] for c in cols) for r in got.collect()) == Counter(want)


def test_fingerprints(spark, documents):
    got = rows_of(queries.op1_fingerprints(spark, DIR))
    down = documents[::-1]
    errors = []
    for k, (i, t) in enumerate(down):
        after = down[(k + 1) % len(down)][1]
        m = len(t) // 3
        edited = t[:len(t) - m] + after[:m]
        assert got[i]["edited_sha256"] == sha(edited) and got[i]["n_chars"] == len(t)
        a, b = shingles(t), shingles(edited)
        errors.append(got[i]["near_edited"] - (len(a & b) / len(a | b) if a | b else 1))
    assert np.abs(errors).max() < 0.2 and np.sqrt(np.mean(np.square(errors))) < 0.05


def test_sketches_merge():
    a, b = (fingerprints.sketches(pa.array([" ".join(map(str, r))]))[0] for r in (range(3000), range(1500, 4500)))
    both = fingerprints.sketches(pa.array([" ".join(map(str, range(4500)))]))[0]
    assert abs(fingerprints.resemblance(a, b) - 1 / 3) < 0.15
    assert fingerprints.containment(a, both) > 0.8 and abs(fingerprints.containment(both, a) - 2 / 3) < 0.2
    assert fingerprints.resemblance(fingerprints.merge(a, b), both) > 0.9
    assert abs(fingerprints.distinct_shingles(both) / 4496 - 1) < 0.3
    assert (fingerprints.from_text(fingerprints.to_text(a)) == a).all()


def test_lattice_decoder_is_nearest():
    x = np.random.default_rng(1).normal(size=(200, 8))
    near = lattice.decode_e8(x) / 2
    for r in lattice.roots() / 2:
        assert (((x - near) ** 2).sum(1) <= ((x - near - r) ** 2).sum(1) + 1e-9).all()


def test_lattice_against_all_pairs(spark):
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{DIR}/embeddings.parquet' ORDER BY 1").fetchall()
    x = np.array([r[1] for r in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.95
    label = np.arange(len(x))
    for _ in range(len(x)):
        label = np.where(near, label[None, :], len(x)).min(1)
    got = rows_of(queries.op2_lattice(spark, DIR), "vec_id")
    assert [got[r[0]]["n_links"] for r in rows] == (near.sum(1) - 1).tolist()
    assert [got[r[0]]["component_id"] for r in rows] == [rows[k][0] for k in label]


def test_lattice_recall_at_the_bound():
    rng = np.random.default_rng(5)
    a = rng.normal(size=(2000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    z = rng.normal(size=a.shape)
    z -= (z * a).sum(1, keepdims=True) * a
    b = 0.9501 * a + (1 - 0.9501 ** 2) ** 0.5 * z / np.linalg.norm(z, axis=1, keepdims=True)
    ka, kb = lattice.keys(a), lattice.keys(b)
    found = (ka[:, :, :1] == kb).any((1, 2)) | (kb[:, :, :1] == ka).any((1, 2))
    assert found.mean() >= 0.99


def test_lattice_tiles_and_odd_vectors(spark):
    rows = [(i, [1.0, i * 1e-4]) for i in range(60)] + [(100, None), (101, [0.0, 0.0]), (102, [float("nan"), 1.0]),
            (103, [1.0, None]), (104, [1.0, 0.0, 0.0]), (105, []), (None, [1.0, 0.0]), (5, [1.0, 5e-4])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = rows_of(lattice.near_duplicates(df, tile=8), "vec_id")
    assert all(got[i]["n_links"] == 59 and got[i]["component_id"] == 0 for i in range(60))
    assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i in range(100, 106))
    assert lattice.near_duplicates(df.limit(0)).count() == 0


def test_mixing_targets(spark, odd, empty):
    got = mixing.mix_sources(odd).collect()
    assert len(got) == len(SEEN)
    for r in got:
        assert r["taken"] <= 2 * r["size"] and r["target"] <= 2 * r["source_size"]
    by = {r["source"]: r for r in got}
    assert abs(sum(r["target"] for r in by.values()) - 1.5 * sum(r["source_size"] for r in by.values())) < 1e-6
    assert mixing.mix_sources(empty).count() == 0
    taken = Counter(r["doc_id"] for r in mixing.mixed(odd, ("lang",)).collect())
    assert sum(taken[r["doc_id"]] * r["size"] for r in got if r["doc_id"] != 9) == sum(r["taken"] for r in got if r["doc_id"] != 9)


def test_langid_held_out(spark, documents):
    lang = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{DIR}/documents.parquet'").fetchall())
    got = rows_of(queries.op4_langid(spark, DIR))
    held = [r for r in got.values() if r["held_out"]]
    assert {i for i in got if got[i]["held_out"]} == {i for i in lang if zlib.crc32(str(i).encode()) % 4 == 2}
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_langid_odd(spark, odd, empty):
    model = langid.train(odd)
    got = rows_of(langid.identify(odd, model))
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (2, 3, 4, 8))
    assert langid.train(empty) is None
    assert {r["lang_pred"] for r in langid.identify(odd, None).collect()} == {"und"}
    assert langid.identify(empty, model).count() == 0
    assert langid.group_families(np.array([[1, 0, 0], [.9, .1, 0], [0, 0, 1], [0, .1, .9]])) == [[0, 1], [2, 3]]


def drawn_labels(module, monkeypatch):
    """The labels of the rows that each fit gets."""
    got, fit = [], module.fit
    monkeypatch.setattr(module, "fit", lambda x, labels, *more: got.append(list(labels)) or fit(x, labels, *more))
    return got


def test_langid_draws_every_language_and_copies_once(spark, monkeypatch):
    rare = spark.range(6).selectExpr("id + 9000 doc_id", "concat('zzyzx qoph ', id) text", "'zz' lang")
    common = spark.range(4000).selectExpr("id doc_id", "concat('text number ', id * 7919) text", "if(id % 2 = 0, 'en', 'fr') lang")
    # the text whose hash is drawn first, in a third of all rows
    copy = spark.range(500).selectExpr("concat('copy ', id) text").orderBy(F.pmod(F.xxhash64("text"), F.lit(1 << 40))).first()[0]
    copies = spark.range(2000).select((F.col("id") + 10_000).alias("doc_id"), F.lit(copy).alias("text"), F.lit("en").alias("lang"))
    repeated = spark.range(100).selectExpr("cast(null as long) doc_id", "'no id, one row' text", "'xx' lang")
    got = drawn_labels(langid, monkeypatch)
    model = langid.train(rare.union(common).union(copies).union(repeated), 100, 5)
    n = Counter(got[0])
    assert model.langs == ["en", "fr", "xx", "zz"] and n["zz"] == 6 and n["xx"] == 1
    assert 20 <= n["en"] <= 80 and 20 <= n["fr"] <= 80
    pred = langid.identify(rare, model).collect()
    assert all(r["lang_pred"] == "zz" for r in pred)
    assert langid.rows_each([6, 1, 2000, 2000], 100, 5) == 46 and langid.rows_each([3, 4], 100, 5) == 5
    assert langid.rows_each([9] * 50, 100, 5) == 5 and langid.rows_each([], 100, 5) == 5


def pieces_hold(pieces, ids):
    """Pieces tile their documents and their sequences; returns the padding."""
    docs, seqs = defaultdict(list), defaultdict(list)
    for p in pieces:
        docs[p["doc_id"]].append(p)
        seqs[p["sequence_id"]].append(p)
    for i, parts in docs.items():
        parts.sort(key=lambda p: p["start"])
        raw = b"".join(bytes(p["ids"]) for p in parts)
        assert np.frombuffer(raw, "<u4").tolist() == ids[i] and parts[0]["doc_tokens"] == len(ids[i])
        assert [p["start"] for p in parts] == [0, *itertools.accumulate(p["length"] for p in parts[:-1])]
    padding = 0
    for parts in seqs.values():
        parts.sort(key=lambda p: p["offset"])
        assert [p["offset"] for p in parts] == [0, *itertools.accumulate(p["length"] for p in parts[:-1])]
        n = sum(p["length"] for p in parts)
        assert n <= 4096
        padding += 0 if n & (n - 1) == 0 else 4096 - n
    assert set(docs) == set(ids)
    return padding / sum(map(len, ids.values()))


def test_packing_round_trip(spark, documents, odd, empty):
    tok = packing.word_table(packing.TOKENIZER).tok
    encode = lambda t: tok.encode(t, add_special_tokens=False).ids + [2]
    got = packing.pack_documents(spark.read.parquet(f"{DIR}/documents.parquet")).collect()
    assert pieces_hold(got, {i: encode(t) for i, t in documents}) < 0.01
    got = packing.pack_documents(odd.filter("doc_id is null or doc_id != 9")).collect()
    pieces_hold(got, {i: encode(t) for i, t in SEEN if i != 9})
    assert packing.pack_documents(empty).count() == 0


def test_packing_cuts_are_least():
    rng = np.random.default_rng(2)
    for _ in range(50):
        at = np.cumsum(rng.integers(1, 5, 12))
        price = rng.integers(0, 4, 12)
        cuts = packing.best_cuts(at, price, 6)
        cost = lambda c: sum(6 - (b - a) for a, b in zip(c, c[1:])) + sum(int(price[at.tolist().index(x)]) for x in c[1:])
        best = min(cost((0, *c, at[-1])) for n in range(12) for c in itertools.combinations(at[:-1].tolist(), n)
                   if all(b - a <= 6 for a, b in zip((0, *c), (*c, at[-1]))))
        assert cost(cuts) == best


def test_line_dedup_odd(spark, empty):
    line = "A line that is longer than forty code points, shared by many."
    rows = [(i, f"{i}\n {line.upper() if i % 2 else line}\t\nrest\n{line}", "x") for i in range(9)] + [(20, None, "x"), (21, "", "x"),
            (22, "é" * 39 + "\n" + "é" * 40, "x"), (None, line, "x")]
    rows += [(30 + i, "é" * 40 + "\nunder forty é", "x") for i in range(4)]
    got = rows_of(linededup.drop_shared_lines(spark.createDataFrame(rows, "doc_id long, text string, dropped string")))
    assert all(got[i]["n_dropped"] == 2 and got[i]["text"] == f"{i}\nrest" for i in range(8))
    assert got[8]["n_dropped"] == 0 and got[8]["text"] == rows[8][1]
    assert got[20]["text"] == "" and got[20]["n_lines"] == 1 and got[21]["n_lines"] == 1
    assert got[22]["n_dropped"] == 1 and got[33]["n_dropped"] == 0 and got[30]["text"] == "under forty é"
    assert None not in got and linededup.drop_shared_lines(empty).count() == 0


def test_line_index_holds_all_lines_and_splits_hot_shards(spark, monkeypatch):
    monkeypatch.setattr(linededup, "SHARD_KEYS", 50)
    monkeypatch.setattr(linededup, "SHARD_PROBES", 100)
    hot, warm = "a hot line that one thousand documents hold, each once", "a line that exactly four documents hold, one too few"
    rows = [(i, f"line of document {i} alone, long enough to count\n{hot}" + (f"\n{warm}" if i < 4 else "")) for i in range(1000)]
    rows.append((7, rows[7][1]))        # a repeated row is no further document
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    keys = linededup.line_hashes(docs, linededup.MIN_CHARS)
    index, shards = linededup.build_index(keys)
    got = index.collect()
    counts = np.concatenate([np.frombuffer(r["counts"], np.int64) for r in got])
    assert shards == 21 and sorted(counts.tolist()) == [1] * 1000 + [4, 1000]
    assert sorted(r["replicas"] for r in got)[-1] >= 10 and sorted(r["replicas"] for r in got)[0] == 1
    for least, lost in ((5, {hot}), (4, {hot, warm})):
        out = linededup.drop_shared_lines(docs, min_docs=least).collect()
        assert len(out) == 1001
        keeper = {hot: 999, warm: 3}
        for r in out:
            want = [x for x in rows[r["doc_id"]][1].split("\n") if x not in lost or keeper[x] == r["doc_id"]]
            assert r["text"].split("\n") == want


def test_minimal_perfect_hash():
    keys = np.random.default_rng(4).integers(0, 1 << 63, 20_000).astype(np.uint64)
    keys = np.unique(keys)
    levels = linededup.perfect_hash(keys)
    assert sorted(linededup.locate(keys, levels).tolist()) == list(range(len(keys)))
    other = linededup.locate(keys + np.uint64(1), levels)
    assert other.max() < len(keys) and other.min() >= -1
    assert (linededup.locate(keys[:5], linededup.perfect_hash(keys[:0])) == -1).all()


def test_toxicity_held_out(spark):
    where = "/root/testdata/sf0.01"
    toxic = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{where}/labels.parquet' WHERE toxic IS NOT NULL").fetchall())
    got = rows_of(queries.op7_toxicity(spark, where))
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.values())
    held = [i for i in toxic if i in got and got[i]["held_out"]]
    yes, no = ([got[i]["score"] for i in held if toxic[i] == k] for k in (1, 0))
    area = np.mean([(a > b) + (a == b) / 2 for a in yes for b in no])
    caught, wrong = sum(x >= 0.5 for x in yes), sum(x >= 0.5 for x in no)
    # predicting 0 for every text would catch none, chance has an area of 0.5
    assert area > 0.85 and caught >= 0.5 * len(yes) and caught >= 0.9 * (caught + wrong)


def test_toxicity_features_are_characters():
    texts = ["Straße żółć", "日本語のテキスト", "", "ab", "STRASSE straSSE", "é" * 9, None, "😀😀é"]
    chunk, = chunks(pa.array(texts))
    chars, offsets = toxicity.characters(chunk)
    lower = ["".join(c.lower() if c.isascii() else c for c in t or "") for t in texts]
    assert np.diff(offsets).tolist() == [len(t) for t in lower]
    assert [int(x) for x in chars] == [int.from_bytes(c.encode(), "big") for t in lower for c in t]
    got = toxicity.features(chunk)
    grams = [{t[i:i + n] for n in toxicity.LENGTHS for i in range(len(t) - n + 1)} for t in lower]
    assert [len(f) for f in got] == [len(g) for g in grams]
    for f, t in zip(got, lower):        # a gram has one slot, wherever it stands
        alone, = toxicity.features(next(chunks(pa.array([t]))))
        assert f.tolist() == alone.tolist()
    bad = pa.array([b"ab\x80\x81", b"\xbf\xff\xfe abc"], pa.binary())
    assert all(len(toxicity.features(c)) == 2 for c in chunks(bad))


def test_toxicity_draws_each_label(spark, monkeypatch):
    docs = spark.range(6000).selectExpr("id doc_id", "concat('text number ', id, if(id % 300 = 0, ' vile', '')) text")
    labels = spark.range(6000).selectExpr("id doc_id", "cast(id % 300 = 0 as int) toxic")
    got = drawn_labels(toxicity, monkeypatch)
    model = toxicity.train(docs, labels, 100)
    n = Counter(got[0])
    assert n[1] == 20 and 50 <= n[0] <= 120
    # the drawn rows stand for all: rare labels stay rare
    assert np.mean([r["score"] for r in toxicity.score(docs, model).collect()]) < 0.05


def test_toxicity_learns_from_all_rows(spark, monkeypatch):
    """More rows than the driver fits: every one counts, as on the driver, however they are dealt."""
    monkeypatch.setattr(toxicity, "STEPS", 6)
    texts = spark.range(5000).selectExpr("id doc_id", "if(id = 7, null, concat('text number ', id * id, if(id % 20 = 0, ' vile', ' kind'))) text")
    docs = texts.unionByName(texts.filter("doc_id in (20, 31)")).unionByName(texts.limit(1).selectExpr("null doc_id", "'no id' text"))
    labels = spark.range(5000).selectExpr("id doc_id", "if(id = 9, null, cast(id % 20 = 0 as int)) toxic")
    model = toxicity.train(docs, labels)
    rows = [(r["text"], r["doc_id"] % 20 == 0) for r in docs.filter("doc_id is not null and doc_id != 9").collect()]
    want = toxicity.fit([f for c in chunks(pa.array([t for t, _ in rows], pa.string())) for f in toxicity.features(c)],
                        np.array([y for _, y in rows], float))
    assert np.abs(model.weights - want.weights).max() < 1e-6 and abs(model.bias - want.bias) < 1e-6
    again = toxicity.train(docs.repartition(7), labels)
    assert (again.weights == model.weights).all() and again.bias == model.bias
    without = toxicity.train(docs, labels.filter("doc_id != 4999"))       # one row less is another model
    assert (without.weights != model.weights).any()
    one = toxicity.train(docs, labels.filter("toxic = 0"))
    assert max(r["score"] for r in toxicity.score(docs, one).collect()) < 0.01


def test_toxicity_moves_texts_once_and_steps_by_cores(spark, monkeypatch):
    """Texts go through one shuffle, packed; the passes read written tables, a step's with no more tasks than cores."""
    monkeypatch.setattr(toxicity, "STEPS", 2)
    plans = []
    def seen(of, at):
        def call(df, *more):
            plans.append((at, df._jdf.queryExecution().optimizedPlan().toString(), df.rdd.getNumPartitions()))
            return of(df, *more)
        return call
    monkeypatch.setattr(toxicity, "written", seen(toxicity.written, "written"))
    monkeypatch.setattr(toxicity, "total", seen(toxicity.total, "total"))
    docs = spark.range(6000, numPartitions=40).selectExpr("id doc_id", "concat('text number ', id * id, if(id % 20 = 0, ' vile', ' kind')) text")
    toxicity.train(docs, spark.range(6000).selectExpr("id doc_id", "cast(id % 20 = 0 as int) toxic"))
    joins = [plan for at, plan, _ in plans if "Join" in plan]
    assert len(joins) == 1 and "z#" in joins[0].split("Join")[0] and "text#" not in joins[0].split("Join")[0]
    assert not any("Join" in plan for at, plan, _ in plans if at == "total")
    steps = [n for at, _, n in plans if at == "total"][1:]
    assert len(steps) == 10 and max(steps) <= spark.sparkContext.defaultParallelism


def test_unpacked_are_the_texts():
    texts = ["", "one", "Ä" * 40, "x" * 100, ""]
    got = list(unpacked(pa.array([pack(t.encode()) for t in texts]), 50))
    assert [(c.lo, c.hi) for c in got] == [(0, 3), (3, 4), (4, 5)]
    assert [c.raw(i).decode() for c in got for i in range(len(c))] == texts and not list(unpacked(pa.array([], pa.binary())))


def test_toxicity_odd(spark, odd, empty):
    labels = spark.createDataFrame([(1, 0), (5, 1), (2, None), (None, 1), (7, 0), (7, 0)], "doc_id long, toxic int")
    got = toxicity.score(odd, toxicity.train(odd, labels)).collect()
    assert len(got) == len(SEEN) and all(0 <= r["score"] <= 1 for r in got)
    one = toxicity.train(odd, labels.filter("toxic = 0"))
    assert max(r["score"] for r in toxicity.score(odd, one).collect()) < 0.01
    assert toxicity.score(empty, one).count() == 0


def linked(docs):
    """component_id by comparing all pairs."""
    sets = {i: shingles(t) for i, t in docs}
    label = {i: i for i in sets}
    pairs = [(a, b) for a, b in itertools.combinations(sorted(sets), 2) if sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    change = True
    while change:
        change = False
        for a, b in pairs:
            low = min(label[a], label[b])
            change |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return sets, label


def test_jaccard_against_all_pairs(spark, documents, odd, empty):
    for df, docs in ((spark.read.parquet(f"{DIR}/documents.parquet"), documents), (odd, SEEN)):
        sets, label = linked(docs)
        got = rows_of(jaccard.link_documents(df))
        assert {i: got[i]["component_id"] for i in got} == label
        assert {i: got[i]["n_shingles"] for i in got} == {i: len(s) for i, s in sets.items()}
    assert jaccard.link_documents(empty).count() == 0


def test_jaccard_small_sets_and_chains(spark, monkeypatch):
    """Small sets need one-deletion and single signatures; chains link through others; groups are tiled."""
    monkeypatch.setattr(jaccard, "TILE", 4)
    rng = np.random.default_rng(7)
    base = [str(x) for x in rng.integers(0, 10 ** 6, 60)]
    docs = []
    for i in range(90):
        n = int(rng.integers(5, 40))
        words = list(base[:n])
        if i % 3:
            words[-1] = f"w{i % 7}"
        if i % 5 == 0:
            words = words[1:]
        docs.append((i, " ".join(words)))
    docs += [(100 + i, " ".join(base[i:i + 40])) for i in range(20)]
    _, label = linked(docs)
    got = rows_of(jaccard.link_documents(spark.createDataFrame(docs, "doc_id long, text string")))
    assert {i: got[i]["component_id"] for i in got} == label


def test_signatures_never_miss(monkeypatch):
    """Any two sets at the similarity share a signature."""
    rng = np.random.default_rng(9)
    for _ in range(300):
        n = int(rng.integers(4, 120))
        a = rng.integers(0, 1 << 63, n).astype(np.uint64)
        drop = int(rng.integers(0, n // 5 + 1))
        more = rng.integers(0, 1 << 63, int(rng.integers(0, n // 4 + 1))).astype(np.uint64)
        b = np.concatenate([a[drop:], more])
        both = len(a) - drop
        if 100 * both < 80 * (len(a) + len(b) - both) or (drop == 0 and not len(more)):
            continue
        doc = np.repeat([0, 1], [len(a), len(b)])
        h = np.concatenate([np.sort(a), np.sort(b)])
        order = [rng.permutation(m) for m in jaccard.segments_of_bands()[:int(rng.integers(0, 10))]]
        d, sig = jaccard.sign(doc, h, np.array([len(a), len(b)]), 80, order)
        assert set(sig[d == 0].tolist()) & set(sig[d == 1].tolist())


def passages(docs, width=50):
    first, out = {}, {}
    for i, t in sorted(docs):
        w = t.encode().split()
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            if first.setdefault(tuple(w[k:k + width]), i) < i:
                gone[k:k + width] = [True] * width
        out[i] = (len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode())
    return out


def test_substrings_against_all_windows(spark, documents, odd, empty):
    for df, docs in ((spark.read.parquet(f"{DIR}/documents.parquet"), documents), (odd, SEEN)):
        got = rows_of(substrings.remove_passages(df))
        assert {i: (r["n_words"], r["n_removed"], r["text"]) for i, r in got.items()} == passages(docs)
    assert substrings.remove_passages(empty).count() == 0


def test_cover_is_a_difference_cover():
    shifts = {(a - b) % substrings.PERIOD for a in substrings.COVER for b in substrings.COVER}
    assert shifts == set(range(substrings.PERIOD))


def repeats(docs, width=100):
    seen, out = set(), {}
    for i, t in sorted(docs):
        b = t.encode()
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - width + 1):
            if b[k:k + width] in seen:
                gone[k:k + width] = True
            seen.add(b[k:k + width])
        spans = np.flatnonzero(np.diff(np.concatenate([[0], gone, [0]]).astype(int))).tolist()
        out[i] = (len(b), spans, np.frombuffer(b, np.uint8)[~gone].tobytes())
    return out


def test_suffixes_against_all_windows(spark, documents, odd, empty):
    for df, docs in ((spark.read.parquet(f"{DIR}/documents.parquet"), documents), (odd, dict(SEEN).items())):
        got = rows_of(suffixes.remove_repeats(df))
        assert {i: (r["n_bytes"], list(r["spans"]), bytes(r["kept"])) for i, r in got.items()} == repeats(docs)
    assert suffixes.remove_repeats(empty).count() == 0


def test_suffixes_anchors_in_stretches(monkeypatch):
    """Texts longer than a stretch of places have the anchors that they have as one stretch."""
    rng = np.random.default_rng(8)
    texts = ["ab" * 300, "".join(rng.choice(list("abc "), 2000)), "x" * 900, "".join(rng.choice(list("ab"), 99)), ""] * 2
    (c,) = chunks(pa.array(texts, pa.large_string()))
    whole = suffixes.runs(c)
    for bits in (7, 8, 11):
        monkeypatch.setattr(suffixes, "PLACE_BITS", bits)
        assert all((a == b).all() for a, b in zip(whole, suffixes.runs(c)))


def test_suffixes_periodic_texts(spark):
    rng = np.random.default_rng(3)
    docs = []
    for i in range(40):
        unit = "".join(rng.choice(list("ab"), int(rng.integers(1, 5))))
        docs.append((i, "".join(rng.choice(list("abc"), 60)) + unit * int(rng.integers(10, 120)) + docs[i // 2][1][:150] if i else unit * 200))
    got = rows_of(suffixes.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string")))
    assert {i: (r["n_bytes"], list(r["spans"]), bytes(r["kept"])) for i, r in got.items()} == repeats(docs)


# ---- words that regular hashes take for each other ------------------------------

def thue_morse(bits):
    """A word over two letters and its complement: polynomials modulo 2**64 can't tell them apart."""
    w = "a"
    for _ in range(bits):
        w += w.translate(str.maketrans("ab", "ba"))
    return w, w.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("bits", [8, 9, 11, 13])
def test_words_that_polynomials_confuse(spark, bits):
    one, other = thue_morse(bits)
    fill = [f"word{k}" for k in range(49)]
    texts = [one, other, " ".join([one, *fill]), " ".join([other, *fill]), f"{one} b c d e", f"{other} b c d e",
             f"x {one} y", f"x {other} y"]
    docs = list(enumerate(texts))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for seed in range(8):
        for c in chunks(pa.array(texts, pa.large_string())):
            h = Words(c).hashes(c.data, seed)
            assert len(set(h.tolist())) == len({w for t in texts for w in t.split()})
    prints = rows_of(fingerprints.with_neighbours(df))
    assert len({r["fingerprint"] for r in prints.values()}) == len(texts) and prints[1]["near_next"] == 0
    tok = packing.word_table(packing.TOKENIZER).tok
    pieces_hold(packing.pack_documents(df).collect(), {i: tok.encode(t, add_special_tokens=False).ids + [2] for i, t in docs})
    _, label = linked(docs)
    got = rows_of(jaccard.link_documents(df))
    assert {i: got[i]["component_id"] for i in got} == label and label[1] == 1 and label[5] == 5
    got = rows_of(substrings.remove_passages(df))
    assert {i: (r["n_words"], r["n_removed"], r["text"]) for i, r in got.items()} == passages(docs)
    got = rows_of(suffixes.remove_repeats(df))
    assert {i: (r["n_bytes"], list(r["spans"]), bytes(r["kept"])) for i, r in got.items()} == repeats(docs)


def test_jaccard_allocation_counts_all_documents(spark):
    """The two documents among 21,000 that share a passage are last by hash; its segments sign last."""
    last = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)).desc()
    two = [r["doc_id"] for r in spark.range(21_000).toDF("doc_id").orderBy(last).limit(2).collect()]
    passage = " ".join(f"w{k}" for k in range(12))
    docs = spark.range(21_000).toDF("doc_id").withColumn("text", F.when(
        F.col("doc_id").isin(two), F.concat_ws(" ", F.lit(passage), F.concat(F.lit("a"), "doc_id"), F.lit("c d e f g")))
        .otherwise(F.expr("concat_ws(' ', transform(sequence(1, 18), k -> concat('x', hash(doc_id, k))))")))
    reps = docs.select("doc_id")
    order = jaccard.allocation(docs, reps)
    few = jaccard.allocation(docs.filter(F.col("doc_id").isin(two)), reps.filter(F.col("doc_id").isin(two)))
    assert any((r != np.arange(len(r))).any() for r in few)
    assert [r.tolist() for r in order] == [r.tolist() for r in few]


def test_jaccard_allocation_by_cost(spark, empty, monkeypatch):
    """Segments where many share a subset sign last; the result does not depend on the sample."""
    assert [r.tolist() for r in jaccard.cost_order([(0, 1, 5), (0, 3, 2)])[:1]] == [[0, 4, 1, 3, 2]]
    rng = np.random.default_rng(5)
    passage = [str(x) for x in rng.integers(0, 10 ** 6, 60)]
    docs = [(i, " ".join(passage + [str(x) for x in rng.integers(0, 10 ** 6, 60)])) for i in range(300)]
    docs += [(1000 + i, " ".join([*t.split()[:-3], "a", "b", "c"])) for i, t in docs[:40]]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    first = spark.createDataFrame([(i,) for i, _ in docs], "doc_id long")
    order = jaccard.allocation(df, first)

    def candidates(order):
        return jaccard.shared(jaccard.signatures(df, 80, order)).select("hub", "doc_id").distinct().count()
    assert candidates(order) <= candidates(())
    assert any((r != np.arange(len(r))).any() for r in order)
    assert all((r == np.arange(len(r))).all() for r in jaccard.allocation(empty, first.limit(0)))
    _, label = linked(docs)
    monkeypatch.setattr(jaccard, "SAMPLE", 50)      # the whole sample is for the other tests
    got = rows_of(jaccard.link_documents(df))
    assert {i: got[i]["component_id"] for i in got} == label


def test_jaccard_verifies_words_not_hashes(spark, monkeypatch):
    """With hashes of a few bits nearly all texts look alike; the words still decide."""
    rng = np.random.default_rng(1)
    texts = [" ".join(str(x) for x in rng.integers(0, 10 ** 6, 30)).encode() for _ in range(6)] + [b"one two", b"ONE two", b"one two three"]
    monkeypatch.setattr(jaccard, "shingle_places", lambda *a: (lambda d, h, at: (d, np.arange(len(h), dtype=np.uint64) - np.searchsorted(d, d).astype(np.uint64), at))(
        *fingerprints_places(*a)))
    sets = jaccard.Sets(texts)
    assert sets.common(0, 1)[0] == 0 and sets.common(6, 7) == (1, 1) and sets.common(6, 8)[0] == 0 and sets.common(2, 2) == (26, 26)


def fingerprints_places(*a):
    from pricelens.llm.text import shingle_places
    return shingle_places(*a)


def test_packing_forgets_words_met_once(monkeypatch):
    """A small table of known words gives the ids of a large one."""
    rng = np.random.default_rng(3)
    words = [f"w{x}é7" if x % 7 == 0 else f"word{x}," if x % 3 else f"x{x}-y" for x in range(400)]
    texts = [" ".join(rng.choice(words, 60)) for _ in range(60)] + ["", "7 7 7", "a7b 7", "\u0085 \xa0x", "Iİ 7́"]
    monkeypatch.setattr(packing, "KNOWN_WORDS", 150)
    table = packing.WordTable(packing.TOKENIZER)
    for c in chunks(pa.array(texts, pa.large_string()), 2000):
        for i, ids in enumerate(table.encode(c)):
            assert ids.tolist() == table.tok.encode(texts[c.lo + i], add_special_tokens=False).ids + [2]
    assert len(table.index) < 400 and table.at.tolist() == (np.cumsum(table.size) - table.size).tolist()
