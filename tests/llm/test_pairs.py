"""Near duplicates, nearest neighbours and the pipeline."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clinrisk.llm import op5_ann_adaptive as ann
from clinrisk.llm import op8_ngram_jaccard as jaccard

SMALL = "/root/testdata/sf0.001"


def shingles(text):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 4]) for i in range(len(w) - 3)) if len(w) >= 4 else frozenset([tuple(w)])


def brute_components(rows):
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def top(a):
        while parent[a] != a:
            a = parent[a]
        return a
    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                parent[max(top(i), top(j))] = min(top(i), top(j))
    return sorted(((i, len(shingles(t)), top(i) if i is not None else None) for i, t in rows), key=str)


def found(df):
    return sorted(((r.id, r.n_shingles, r.component_id) for r in jaccard.near_duplicates(df).collect()), key=str)


def mutated(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"m{rng.randrange(10**6)}"
    return " ".join(words)


def test_components_of_a_large_group_and_chains(docs, monkeypatch):
    monkeypatch.setattr(jaccard, "SHORT_LIST", 3)
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    rng = random.Random(1)
    base = [f"b{i}" for i in range(120)]
    texts = [mutated(rng, base, rng.randrange(6)) for _ in range(60)]
    step = [f"c{i}" for i in range(100)]
    for k in range(8):          # a chain: neighbours link, ends do not
        texts.append(" ".join(step))
        step = step[3:] + [f"d{k}{j}" for j in range(3)]
    texts += [" ".join(f"u{i}{j}" for j in range(50)) for i in range(20)]
    texts += ["a b c d e", "a b c d e", "A  B c\nd e", "a b", "a b", "b a", "", None, " ", "x"]
    rng.shuffle(texts)
    df = docs(*texts)
    assert found(df) == brute_components([(r.doc_id, r.text) for r in df.collect()])


@pytest.mark.parametrize("block, fragment", [(1024, 4096), (8, 64)])
def test_every_link_is_listed_and_counted(docs, monkeypatch, block, fragment):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "FRAGMENT", fragment)
    rng = random.Random(2)
    base = [f"b{i}" for i in range(120)]
    texts = [mutated(rng, base, rng.randrange(5)) for _ in range(40)]
    texts += [texts[3], texts[3].upper(), "a b c d e", "a  b c d e", "a", "", None]
    df = docs(*texts)
    sets = {r.doc_id: shingles(r.text) for r in df.collect()}
    near = {(i, j): (len(sets[i] & sets[j]), len(sets[i] | sets[j])) for i in sets for j in sets
            if i != j and sets[i] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])}
    rows, links = jaccard.similarity_join(df)
    rep = {r.id: r.rep for r in rows.collect()}
    want = sorted((i, j, *n) for (i, j), n in near.items() if i < j and rep[i] == i and rep[j] == j)
    assert sorted(map(tuple, links.collect())) == want and len(want) > 40
    assert {r.id: r.n_links for r in jaccard.link_counts(df).collect()} == {i: sum(x == i for x, _ in near) for i in sets}


def test_small_fragments_and_chunks_change_nothing(documents, monkeypatch):
    want = brute_components([(r.doc_id, r.text) for r in documents.collect()])
    assert found(documents) == want
    monkeypatch.setattr(jaccard, "candidate_classes", lambda docs, n, *a, f=jaccard.candidate_classes: f(docs, 600 * jaccard.FRAGMENT_GRAMS, *a))
    assert found(documents.repartition(5)) == want


def test_packed_steps_round_trip():
    v = np.sort(np.random.default_rng(0).integers(0, 2**32, 1000).astype(np.uint32))
    assert (jaccard._unplaned(jaccard._planes(v)) == v).all()


def test_near_duplicates_on_edge_rows(edge, empty):
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    assert found(edge) == brute_components(rows)
    assert jaccard.near_duplicates(empty).count() == 0
    kept = jaccard.one_of_each(edge)
    assert kept.columns == edge.columns
    # 4 stands twice and 5 is the same set: one row stays; rows without words or id stay.
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1, 2, 3, 4, 6, 7, None, 8, 9], key=str)


@pytest.mark.parametrize("extra", [[], [(9, "w1 w2 w3 w4 w5")] * 2])
def test_rows_that_stay_do_not_depend_on_other_rows(docs, extra):
    rows = [(5, "\n\t"), (5, "\n\t"), (6, None), (6, None), (None, "a b c d e"), (None, "a b c d e"), (7, "a b c d e"), (7, "a b c d e"), (8, "A b c d e"), *extra]
    kept = jaccard.one_of_each(docs(*[t for _, t in rows], ids=[i for i, _ in rows])).collect()
    assert sorted((r.doc_id or 0 for r in kept if r.doc_id != 9)) == [0, 0, 5, 5, 6, 6, 7]
    assert sum(r.doc_id == 9 for r in kept) == bool(extra)


def test_header_rows_are_dealt_over_many_groups():
    routes = {next(jaccard._pack(p << 24, [np.arange(3, dtype=np.uint64)], [(1, 2)], 3))[0] for p in range(500)}
    assert len(routes) == 500 and max(routes) < 0


# --- Nearest neighbours -----------------------------------------------------------------

def brute_nearest(ids, x, i, k=5):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = u @ u[i]
    order = [j for j in np.lexsort((ids, -s)) if ids[j] != ids[i]]
    return [int(ids[j]) for j in order[:k]]


def test_recall_and_scores(spark):
    sf = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    got = {}
    for r in ann.op5_ann_adaptive(spark, sf).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hit = 0
    for q, held in got.items():
        held.sort()
        assert [h[0] for h in held] == [1, 2, 3, 4, 5]
        assert [h[1] for h in held] == [h[1] for h in sorted(held, key=lambda h: (-h[2], h[1]))]
        i = int(np.searchsorted(ids, q))
        for _, v, s in held:
            j = int(np.searchsorted(ids, v))
            assert s == pytest.approx(x[i] @ x[j] / np.linalg.norm(x[i]) / np.linalg.norm(x[j]), abs=1e-12)
        hit += len({h[1] for h in held} & set(brute_nearest(ids, x, i)))
    assert len(got) == sum(ids % 50 == 0) and hit >= 0.9 * 5 * len(got)


def test_tests_abandon_most_candidates_but_not_the_nearest():
    rng = np.random.default_rng(1)
    x = ann.unit(rng.normal(size=(4000, 64)))
    q = ann.unit(rng.normal(size=(1, 64)) * 0.3 + x[3999:])[0]
    found_rows, dist = ann.adaptive_scan(q, [x[:, a:a + 16] for a in range(0, 64, 16)], 5)
    exact = ((x - q) ** 2).sum(axis=1)
    assert set(np.argsort(exact)[:3]) <= set(found_rows) and len(found_rows) < 400
    assert dist == pytest.approx(exact[found_rows])


def test_vectors_that_take_no_part_ties_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 16)
    monkeypatch.setattr(ann, "QUERIES", 2)
    same = [1.0, 2.0, 3.0]
    rows = [(i, same) for i in range(1, 101)] + [(100, same), (200, None), (201, [0.0, 0.0, 0.0]), (202, [1.0, None, 2.0]),
                                                 (203, [float("nan"), 1.0, 1.0]), (204, [float("inf"), 1.0, 1.0]), (205, [1.0]), (None, same)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("list", F.lit(1))
    got = {}
    for r in ann.nearest(df, F.col("id") % 50 == 0).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = r.vec_id
    assert got == {50: dict(zip(range(1, 6), range(1, 6))), 100: dict(zip(range(1, 6), range(1, 6)))}
    assert ann.nearest(df.where("false"), F.col("id") % 50 == 0).count() == 0
    few = ann.nearest(df.where("vec_id IN (50, 51, 201)"), F.col("id") % 50 == 0).collect()
    assert [(r.query_id, r.vec_id) for r in few] == [(50, 51)]


def test_huge_and_tiny_components(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(60, 8))
    rows = [(i, (v * 10.0 ** (200 * (i % 3 - 1))).tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = ann.nearest(df, F.col("id") % 20 == 0).collect()
    for i in (0, 20, 40):
        mine = sorted((r for r in got if r.query_id == i), key=lambda r: r.rank)
        assert [r.vec_id for r in mine] == brute_nearest(np.arange(60), x, i) and all(-1 <= r.score <= 1 for r in mine)


@pytest.mark.parametrize("times", [2, 6])
def test_repeated_rows_take_no_places(spark, times):
    rng = np.random.default_rng(4)
    rows = [(i, [float(v) for v in rng.normal(size=8)]) for i in range(60)]
    asked = F.col("id") % 10 == 0
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows])

    def neighbours(rows):
        got = {}
        for r in ann.nearest(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), asked, k=20).collect():
            got.setdefault(r.query_id, {})[r["rank"]] = r.vec_id
        return {q: [held[i] for i in sorted(held)] for q, held in got.items()}
    got = neighbours(rows * times)
    assert got == neighbours(rows)
    # Ids with several vectors, nearly but not quite equal, take one place too.
    near = neighbours([(i, [c + 1e-7 * j for c in v]) for j in range(times) for i, v in rows])
    for held in (got, near):
        assert all(len(set(h)) == len(h) == 20 for h in held.values())
        assert sum(len(set(held[q]) & set(brute_nearest(ids, x, q, 20))) for q in held) >= 0.9 * 20 * 6


# --- Pipeline -------------------------------------------------------------------------------

def test_stages_follow_each_other(spark):
    import corpus_pipeline
    from clinrisk.llm import op4_quality_cnn as cnn
    from clinrisk.llm.common import stored, table
    docs = table(spark, SMALL, "documents")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stored(stage(spark, docs, SMALL), f"test-{name}")
        seen[name] = (before, docs)
        if name != "packing":
            assert docs.columns == columns
    before, after = seen["quality"]
    score = {r.id: r.score for r in cnn.score(before, cnn.train(before, table(spark, SMALL, "labels"))).collect()}
    assert {r.doc_id for r in after.collect()} == {i for i, s in score.items() if s >= 0.3}
    before, after = seen["line_dedup"]
    assert before.count() == after.count()
    before, after = seen["near_duplicates"]
    want = {c for _, _, c in brute_components([(r.doc_id, r.text) for r in before.collect()])}
    assert sorted(r.doc_id for r in after.collect()) == sorted(want)
    before, after = seen["mixing"]
    rows = after.collect()
    assert {r.text for r in rows} <= {r.text for r in before.collect()}         # whole texts only
    words = lambda rows: sum(len(r.text.encode().split()) for r in rows)
    assert words(rows) == pytest.approx(words(before.collect()), rel=0.1)
    before, after = seen["packing"]
    assert after.select("doc_id").distinct().count() == before.select("doc_id").distinct().count()


def test_stages_take_edge_rows_and_empty_tables(spark, edge, empty):
    import corpus_pipeline
    from clinrisk.llm.common import stored
    for start in (edge, empty):
        docs = start
        for name, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, SMALL), f"edge-{name}")
            if name != "packing":
                assert docs.columns == start.columns
