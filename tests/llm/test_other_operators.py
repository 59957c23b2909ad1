"""Packing, models, search, sharding and tokenizing."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from qtrbars.llm import langid, packing, pieces, quality, sharding, topk
from qtrbars.llm.queries import model_path

SF = "/root/testdata/sf0.01"


def test_packing(spark):
    r = random.Random(1)
    texts = [" ".join("w" * r.randint(1, 300)) for _ in range(300)] + ["", None, " ", "w " * 1000]
    rows = [(i if i % 50 else None, t, "clash", 1) for i, t in enumerate(texts)] + [(1, texts[1], "again", 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, bin string, n_tokens int")
    found = packing.pack_documents(df, lengths=(64, 128, 400), group_pieces=100).toPandas()
    tokens = found.groupby("doc_id")["piece_tokens"].sum()
    for i, t in enumerate(texts):
        if i % 50 and i != 1:
            assert tokens[i] == len((t or "").split())
    full = found[found["piece_tokens"] > 0]
    assert found[found["piece_tokens"] == 0]["bin"].isna().all() and (found["piece_tokens"] == 0).sum() == 3
    costs = packing.default_costs((64, 128, 400))
    for _, b in full.groupby(["group_id", "bin"]):
        load = b["piece_tokens"].sum()
        assert (b["bin_tokens"] == load).all() and (b["capacity"] == packing.downsized(load, costs)).all()
        spans = sorted(zip(b["bin_offset"], b["piece_tokens"]))
        assert [s for s, _ in spans] == list(np.cumsum([0] + [n for _, n in spans])[:-1])
    assert full["piece_tokens"].max() == 400
    assert packing.pack_documents(df.where("false")).count() == 0


def test_best_fit_by_hand():
    costs = {10: 11.0, 20: 15.0}
    bins, caps = packing.best_fit([12, 9, 8, 7, 3], costs)
    assert bins == [0, 1, 0, 1, 1] and caps == [20, 20]
    bins, caps = packing.best_fit([12, 5], {10: 10.0, 20: 20.0, 12: 12.0})
    assert caps == [20]  # opening 20 for both costs less than 12 and 10
    bins, caps = packing.best_fit([12, 5], {10: 10.0, 20: 23.0, 12: 12.0})
    assert sorted(caps) == [10, 12]  # downsizing
    assert packing.best_fit([], costs) == ([], [])


def least_cost(sizes, costs):
    """The least cost over all ways to put sizes into bins."""
    best = {(): 0.0}

    def solve(rest):
        if rest not in best:
            first, others = rest[0], rest[1:]
            found = []
            for mask in range(1 << len(others)):
                load = first + sum(x for k, x in enumerate(others) if mask >> k & 1)
                if load <= max(costs):
                    found.append(costs[packing.downsized(load, costs)]
                                 + solve(tuple(x for k, x in enumerate(others) if not mask >> k & 1)))
            best[rest] = min(found)
        return best[rest]
    return solve(tuple(sizes))


def test_best_fit_against_all_packings():
    r = random.Random(11)
    ratios, chosen = [], set()
    for _ in range(150):
        lengths = sorted(r.sample(range(5, 60), 3))
        costs = {n: n + n * n / r.choice((20, 80, 1000)) + r.choice((0, 5, 20)) for n in lengths}
        sizes = sorted((r.randint(1, lengths[-1]) for _ in range(r.randint(1, 8))), reverse=True)
        bins, caps = packing.best_fit(sizes, costs)
        loads = [sum(s for s, b in zip(sizes, bins) if b == k) for k in range(len(caps))]
        assert all(0 < x <= c for x, c in zip(loads, caps)) and sum(loads) == sum(sizes)
        cost = sum(costs[c] for c in caps)
        every = [p[2] for p in packing.plans(sizes, costs)]
        assert cost == min(every)
        chosen.add(every.index(cost))
        ratios.append(cost / least_cost(sizes, costs))
    assert min(ratios) >= 1 - 1e-9 and sum(ratios) / len(ratios) < 1.05 and max(ratios) < 1.6
    assert len(chosen) > 2  # no one plan is always best


def test_lengths_compete(spark):
    """On real lengths several plans are compared, and the one taken costs least."""
    sizes = packing.count_words(spark.read.parquet("/root/testdata/sf0.1/documents.parquet")).toPandas()["n_tokens"]
    pieces = sorted((min(int(x), 8192) for x in sizes if x > 0), reverse=True)[::2]
    costs = packing.default_costs(packing.LENGTHS)
    every = [p[2] for p in packing.plans(pieces, costs)]
    _, caps = packing.best_fit(pieces, costs)
    one_length = packing._pack(pieces, {8192: costs[8192]}, None)[2]
    assert len(every) == 6 and len(set(every)) > 3
    assert sum(costs[c] for c in caps) == min(every) < 0.9 * one_length and len(set(caps)) > 2


def test_frequent_ids_are_spread(spark):
    rows = [(None, "w " * 50)] * 400 + [(1, "w " * 50)] * 400
    found = packing.pack_documents(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3), group_pieces=100)
    assert found.groupBy("group_id").count().agg(F.max("count")).first()[0] < 300
    assert found.count() == 800


def test_language_id(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(9001, None, "en"), (9002, "12 !!", None), (None, "The thing", "en"), (9003, "", "de")],
                                  "doc_id bigint, text string, lang string")
    df = docs.unionByName(extra, allowMissingColumns=True).withColumn("score", F.lit("clash"))
    found = langid.identify(df, sample_docs=600).select("row.*", F.col("lang_pred").alias("p"),
                                                        langid.held_out("row.doc_id").alias("h")).toPandas()
    assert len(found) == docs.count() + 4
    held = found[found["h"] & found["lang"].notna() & (found["p"] != "und")]
    assert (held["p"] == held["lang"]).mean() > 0.97
    assert set(found[found["doc_id"].isin([9001, 9002, 9003])]["p"]) == {"und"}
    sure = found[found["doc_id"].notna()]
    assert all(h == (zlib.crc32(str(int(i)).encode()) % 5 == 0) for i, h in zip(sure["doc_id"], sure["h"]))
    nothing = langid.identify(df.withColumn("lang", F.lit(None).cast("string")))
    assert nothing.where("lang_pred <> 'und' or score <> 0").count() == 0
    assert langid.identify(df.where("false")).count() == 0


def test_network_against_plain_loops():
    """Filters, pooling and softmax written out, on a network learned from a few windows."""
    r = random.Random(2)
    texts = [(r.choice(["the and of ", "der und die ", "ABC äß "]) * 30)[:r.randint(3, 200)].encode() for _ in range(40)]
    labels = ["en" if t[:1] in b"t" else "de" for t in texts]
    net = langid.train(texts, labels, epochs=2)
    windows = np.zeros((12, langid.WINDOW), np.uint8)
    for row, t in enumerate(texts[:12]):
        windows[row, :len(t[:langid.WINDOW])] = list(t[:langid.WINDOW])
    count = langid.FILTERS * len(langid.WIDTHS)
    got = langid.forward(net, windows)
    for row in range(12):
        top = []
        for f in range(count):
            width = langid.WIDTHS[f // langid.FILTERS]
            best = -1e9
            for place in range(langid.WINDOW - max(langid.WIDTHS) + 1):
                answer = 0.0
                for k in range(width):
                    weights = net.filters[k]
                    answer += float(weights[windows[row, place + k], f - (count - weights.shape[1])])
                best = max(best, answer)
            top.append(max(best + float(net.bias[f]), 0.0))
        raw = [sum(t * float(net.out[f, c]) for f, t in enumerate(top)) + float(net.out_bias[c]) for c in range(len(net.langs))]
        e = np.exp(np.array(raw) - max(raw))
        assert np.allclose(got[row], e / e.sum(), atol=1e-4)


def test_risk_is_minimised_and_not_negative():
    """The non-negative unbiased risk, written out, falls; its negative part ends above -beta's reach."""
    rng = np.random.default_rng(5)
    prior = 0.4
    positive = rng.normal(1.2, 1, (900, 6)).astype(np.float32)
    mixed = np.where(rng.random((1500, 1)) < prior, rng.normal(1.2, 1, (1500, 6)), rng.normal(-1.2, 1, (1500, 6))).astype(np.float32)

    def loss(score, label):  # logistic, from the probability
        return -np.log(np.clip(score if label else 1 - score, 1e-12, 1))

    def risk(model):
        p, u = model.score(positive), model.score(mixed)
        for_positives = sum(loss(x, True) for x in p) / len(p)
        negative = sum(loss(x, False) for x in u) / len(u) - prior * sum(loss(x, False) for x in p) / len(p)
        return prior * for_positives + max(0.0, negative), negative

    untrained = quality.train(positive, mixed, prior, epochs=0)
    trained = quality.train(positive, mixed, prior, epochs=10)
    assert risk(trained)[0] < 0.35 * risk(untrained)[0] and risk(trained)[1] > -0.05
    truth_p, truth_n = rng.normal(1.2, 1, (500, 6)), rng.normal(-1.2, 1, (500, 6))
    assert (trained.score(truth_p.astype(np.float32)) > 0.5).mean() > 0.95
    assert (trained.score(truth_n.astype(np.float32)) < 0.5).mean() > 0.95


def test_quality(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    extra = spark.createDataFrame([(9001, None), (9002, ""), (None, "text")], "doc_id bigint, text string")
    df = docs.unionByName(extra, allowMissingColumns=True).withColumn("score", F.lit("clash"))
    found = quality.classify(df, labels.union(labels.limit(3))).select(
        F.col("row.doc_id").alias("doc_id"), "score", "predicted").toPandas()
    assert len(found) == docs.count() + 3 and found["score"].between(0, 1).all()
    both = found.merge(labels.toPandas().dropna(), on="doc_id")
    held = both[[zlib.crc32(str(int(i)).encode()) % 5 == 0 for i in both["doc_id"]]]
    good, bad = held[held["quality"] == 1]["score"], held[held["quality"] == 0]["score"]
    assert np.mean([[g > b for b in bad] for g in good]) > 0.9
    prior = quality.classify(df, labels.where("false"))
    assert prior.select("score").distinct().count() == 1
    assert quality.classify(df.where("false"), labels).count() == 0


def test_top_k(spark):
    r = np.random.default_rng(4)
    vecs = [list(map(float, v)) for v in r.normal(size=(220, 12)).astype(np.float32)]
    rows = [(i, v) for i, v in enumerate(vecs)] + [(300 + i, vecs[0]) for i in range(9)]
    rows += [(400, None), (450, [float("nan")] * 12), (500, [None] * 12), (550, [1.0, 2.0]), (600, []), (None, vecs[1])]
    df = spark.createDataFrame([(i, v, 1, "c") for i, v in rows], "vec_id bigint, embedding array<float>, score int, rank string")
    found = {(x[0], x[1]): (x[2], x[3]) for x in topk.top_k(df, F.col("vec_id") % 50 == 0, 5, query_block=3, row_block=40).collect()}
    fit = {i: np.pad(np.floor(256 * np.array(v, np.float64)).astype(int), (0, 12 - len(v))) for i, v in rows
           if i is not None and v is not None and None not in v and np.isfinite(v).all()}
    want = {}
    for q in (i for i in fit if i % 50 == 0):
        best = sorted((-int(fit[q] @ fit[x]), x) for x in fit if x != q)[:5]
        want |= {(q, k): (x, -s) for k, (s, x) in enumerate(best, 1)}
    assert found == want
    assert topk.top_k(df.where("vec_id < 3"), F.col("vec_id") == 0).count() == 2
    assert topk.top_k(df.where("false"), F.lit(True)).count() == 0


def test_blocks_out_of_reach_are_skipped(spark):
    """Vectors in clusters: most pairs of blocks aren't made, and the result is exact."""
    r = np.random.default_rng(8)
    centres = r.normal(size=(12, 16)) * 4
    vecs = np.round(centres[r.integers(0, 12, 1200)] + r.normal(size=(1200, 16)) * 0.1, 3)
    df = spark.createDataFrame([(i, list(map(float, v))) for i, v in enumerate(vecs)], "vec_id bigint, embedding array<double>")
    vectors = df.select(F.col("vec_id").alias("id"), topk.quantize(F.col("embedding")).alias("v"), (F.col("vec_id") % 20 == 0).alias("q"))
    rows, queries = topk.in_blocks(vectors, topk.plan_blocks(vectors, 1200, 16, 4, 40), 16)
    sizes = rows.groupBy("block").count().toPandas()["count"]
    assert sizes.sum() == 1200 and len(sizes) >= 30 and sizes.max() < 120
    of_rows, of_queries = topk.envelopes(rows, 16), topk.envelopes(queries, 16)
    every = topk.reaching(of_queries, of_rows, of_queries.select(F.col("block").alias("qb"), F.lit(None).cast("double").alias("floor")))
    assert every.count() == of_rows.count() * of_queries.count()
    fit = np.floor(256 * vecs).astype(np.int64)
    products = fit @ fit.T
    np.fill_diagonal(products, -2 ** 62)
    kth = {q: int(np.sort(products[q])[-3]) for q in range(0, 1200, 20)}
    floors = queries.join(spark.createDataFrame(list(kth.items()), "id bigint, kth bigint"), "id").groupBy("block").agg(
        F.min("kth").cast("double").alias("floor")).withColumnRenamed("block", "qb")
    assert topk.reaching(of_queries, of_rows, floors).count() < 0.3 * every.count()
    found = topk.top_k(df, F.col("vec_id") % 20 == 0, 3, query_block=4, row_block=40).collect()
    want = {(q, k): (int(x), int(products[q, x])) for q in kth for k, x in enumerate(sorted(range(1200), key=lambda x: (-products[q, x], x))[:3], 1)}
    assert {(x[0], x[1]): (x[2], x[3]) for x in found} == want


def test_repeated_query_ids(spark):
    """A query id with several vectors asks with the smallest, in whatever order the rows come."""
    rows = [(0, [3.0, 1.0]), (0, [1.0, 9.0]), (1, [0.0, 2.0]), (2, [5.0, 0.0]), (3, [1.0, 1.0])]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "vec_id bigint, embedding array<double>").coalesce(1)
        found = topk.top_k(df, F.col("vec_id") == 0, 2).collect()
        assert [(x[1], x[2], x[3]) for x in sorted(found)] == [(1, 1, 9 * 2 * 65536), (2, 3, 10 * 65536)]


def test_top_k_matches_sql(spark):
    import duckdb
    from qtrbars.llm.queries import ORACLES, QUERIES
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF}/embeddings.parquet')")
    want = con.execute(ORACLES["op7_exact_topk"]).fetchall()
    got = QUERIES["op7_exact_topk"](spark, SF).select("query_id", "rank", "vec_id", "score").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_segment_bound():
    r = np.random.default_rng(0)
    a, b = r.normal(size=(30, 16)), r.normal(size=(40, 16))
    for s in (1, 2, 4, 8, 16):
        assert (topk.segment_statistics(a, s) @ topk.segment_statistics(b, s).T >= a @ b.T - 1e-9).all()


def test_sharding(spark):
    shards = [f"s{i}" for i in range(7)]
    table = sharding.lookup_table(shards, 997)
    counts = np.bincount(table)
    assert counts.min() >= 997 // 7 and counts.max() <= 997 // 7 + 1
    fewer = sharding.lookup_table(shards[:-1], 997)
    stay = table != 6
    assert (table[stay] == fewer[stay]).mean() > 0.75  # few move beside the lost shard's
    heavy = np.bincount(sharding.lookup_table(shards, 997, [2.0] + [1.0] * 6))
    assert heavy[0] > 1.8 * heavy[1]
    df = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z"), (None, "n")], "doc_id bigint, shard string")
    found = sharding.assign_shards(df, "doc_id", shards, 997).collect()
    assert len(found) == 4 and len({r["shard"] for r in found if r["doc_id"] == 1}) == 1
    assert all(shards[table[r["slot"]]] == r["shard"] for r in found)
    with pytest.raises(ValueError):
        sharding.lookup_table(shards, 1000)


@pytest.mark.parametrize("size, n", [(7, 3), (13, 13), (101, 7), (65537, 64)])
def test_lookup_table_against_permutations(size, n):
    """Every shard's whole permutation written out, claimed in turns."""
    from hashlib import md5
    shards = [f"node {n - k}" for k in range(n)]

    def number(text):
        return int(md5(text.encode()).hexdigest()[:16], 16)
    preference = {}
    for s in shards:
        offset, step = number(f"offset {s}") % size, number(f"step {s}") % (size - 1) + 1
        preference[s] = iter([(offset + j * step) % size for j in range(size)])
    owner = {}
    while len(owner) < size:
        for s in sorted(shards):
            if len(owner) < size:
                owner[next(p for p in preference[s] if p not in owner)] = s
    table = sharding.lookup_table(shards, size)
    assert [shards[i] for i in table] == [owner[k] for k in range(size)]


def test_shards_of_odd_rows(spark):
    df = spark.createDataFrame([(None, 1, "x"), (5, 2, "y"), (5, 3, "z")], "doc_id bigint, slot int, shard string")
    found = sharding.assign_shards(df, "doc_id", ["a", "b", "c"], 101).collect()
    assert len(found) == 3 and len({r["slot"] for r in found if r["doc_id"] == 5}) == 1
    assert sharding.assign_shards(df.where("false"), "doc_id", ["a"], 11).count() == 0


def test_pieces(spark):
    model = pieces.load(open(model_path(), "rb").read())
    r = random.Random(1)
    letters = "ab \n\t▁é\x00😀  the(){}\r,.;0123 　"
    texts = ["".join(r.choice(letters) for _ in range(r.randint(0, 80))) for _ in range(3000)]
    texts += ["", " ", "a" * 5000, " " * 100, "<s></s><unk>", "the " * 3000]
    for t in texts:
        ids = model.library.encode(t)
        assert model.encode(t) == ids and model.decode(ids) == model.library.decode(ids)
    rows = [(i, t, "c") for i, t in enumerate(texts[:300])] + [(0, texts[0], "c"), (None, None, "c")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens string")
    found = pieces.encode_digests(df, model_path(), verify=1).collect()
    assert len(found) == 302 and all(r["n_tokens"] == len(model.library.encode(texts[r["doc_id"]])) for r in found
                                     if r["doc_id"] is not None)
    encoded = pieces.encode(df, model_path())
    back = {r[0]: r[1] for r in pieces.decode(encoded, model_path()).collect()}
    assert all(back[i] == model.library.decode(model.library.encode(texts[i])) for i in range(300))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert pieces.encode_digests(docs, model_path(), verify=1).where("n_tokens is null").count() == 0
    assert pieces.encode_digests(df.where("false"), model_path()).count() == 0


def test_pipeline(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    columns = docs.columns
    extra = spark.createDataFrame([(9001, None), (9002, "")], "doc_id bigint, text string")
    docs = docs.unionByName(extra, allowMissingColumns=True)
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "quality_classifier", "ngram_jaccard", "substring_dedup", "best_fit_packing"]
    now = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, "/root/testdata/sf0.001")
        assert now.columns == columns
    assert now.where("doc_id > 9000").count() == 0 and now.count() > 100
    packed = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert packed.select("doc_id").distinct().count() == now.count()
