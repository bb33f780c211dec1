"""Lattice scoring, quality rules, the byte networks and packing."""

import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pytest

from clinrisk.llm import bytechunks, bytewords
from clinrisk.llm import op2_subword_lattice as lattice
from clinrisk.llm import op3_quality_rules as rules
from clinrisk.llm import op4_quality_cnn as cnn
from clinrisk.llm import op6_packing as packing
from clinrisk.llm import op10_language_gru as gru


# --- Words and windows -----------------------------------------------------------

@pytest.mark.parametrize("most", [1 << 20, 64, 7])
def test_word_hashes_do_not_depend_on_the_blocks(monkeypatch, most):
    texts = [b"", b"one Two  three", b" \n", b"a" * 100 + b" b", b"one two\tthree\x0bfour five six seven", b"TWO"]
    monkeypatch.setattr(bytewords.segments, "__defaults__", (most,))
    counts, hashes = [], []
    for _, c, h in bytewords.word_hashes(texts, fold_case=True):
        counts += c.tolist()
        hashes += h.tolist()
    words = [w for t in texts for w in t.lower().split()]
    assert counts == [len(t.split()) for t in texts]
    table = dict(zip(words, hashes))
    assert len(set(table.values())) == len(table) and [table[w] for w in words] == hashes


# --- Lattice -------------------------------------------------------------------------

def all_segmentations(word, names, log_p):
    index = {}
    for i, n in enumerate(names):
        index.setdefault(n, []).append(i)
    total = []
    for cuts in itertools.product([0, 1], repeat=len(word) - 1):
        edges = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(word)]
        parts = [word[a:b] for a, b in zip(edges, edges[1:])]
        if all(p in index for p in parts):
            total += [sum(c) for c in itertools.product(*[[log_p[i] for i in index[p]] for p in parts])]
    return np.logaddexp.reduce(total)


def test_forward_sums_all_segmentations():
    names, first = lattice.pieces()
    log_p = np.log(first)
    run = lattice.Lattice(log_p)
    for w in (b"the", b"a", b"nation", "é".encode(), b"zq7x"):
        want = all_segmentations(b" " + w, names, log_p)
        assert run.words([w])[0] == pytest.approx(want)
        assert run.alone(b" " + w) == pytest.approx(want)


def test_expected_counts_agree_between_both_walks_and_cover_the_word():
    names, first = lattice.pieces()
    run = lattice.Lattice(np.log(first))
    for w in (b"nation", b"internationally", "straße".encode()):
        a, b = np.zeros(len(first)), np.zeros(len(first))
        run.words([w], np.ones(1), a)
        run.alone(b" " + w, 1.0, b)
        assert a == pytest.approx(b)
        assert sum(n * len(names[i]) for i, n in enumerate(a[:-1])) == pytest.approx(len(w) + 1)


def test_lattice_scores_against_plain_counts(spark, documents):
    got = {r.id: r for r in lattice.lattice_scores(documents).collect()}
    rows = [(r.doc_id, r.text.encode().lower().split()) for r in documents.collect()]
    c = Counter()
    for i, w in rows:
        if zlib.crc32(str(i).encode()) % 7 != 2:
            c.update([*w, None])
    n, v = sum(c.values()), len(c)
    for i, w in rows:
        w = [*w, None]
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(c[x] > 0 for x in w), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w))
        assert r.score < 0


def test_lattice_training_helps_on_held_out_text(documents, monkeypatch):
    trained = {r.id: r.score for r in lattice.lattice_scores(documents).collect() if r.held_out}
    monkeypatch.setattr(lattice.fit, "__defaults__", (0, lattice.VOCABULARY))
    raw = {r.id: r.score for r in lattice.lattice_scores(documents).collect() if r.held_out}
    assert sum(trained.values()) > 0.8 * sum(raw.values())


def test_hot_words_change_nothing(documents, monkeypatch):
    a = {r.id: r.score for r in lattice.lattice_scores(documents).collect()}
    monkeypatch.setattr(lattice, "HOT_WORDS", 3)
    b = {r.id: r.score for r in lattice.lattice_scores(documents).collect()}
    assert a == pytest.approx(b)


def test_lattice_on_edge_rows(edge, empty):
    got = lattice.lattice_scores(edge).collect()
    assert len(got) == edge.count() and all(math.isfinite(r.score) for r in got)
    assert {r.n_tokens for r in got if r.id in (1, 2, 3)} == {1}
    assert lattice.lattice_scores(empty).count() == 0


# --- Quality rules -----------------------------------------------------------------------

def test_repeated_windows_by_brute_force():
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(list("abc"), n)) for n in (0, 3, 8, 9, 40, 400)] + ["a b c d e f g h " * 3]
    want = []
    for t in texts:
        w = t.split()
        grams = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
        c = Counter(grams)
        want.append(len({i + j for i, g in enumerate(grams) if c[g] > 1 for j in range(8)}))
    got = [x for _, c, h in bytewords.word_hashes(t.encode() for t in texts) for x in rules.repeated_words(c, h)]
    assert got == want


def name(i, j):
    return "".join(chr(97 + x) for x in (i // 26, i % 26, j // 26, j % 26))


def test_boilerplate_is_removed_and_depleted_documents_go(docs):
    own = [" ".join(name(i, j) for j in range(40)) for i in range(40)]
    line = " ".join(name(99, j) for j in range(40))
    clean, stuffed = own[:30], [f"{line}\n{line.upper()}  \n{line}\ntail {x.split()[0]}" for x in own[30:]]
    df = docs(*clean, *[f"{line}\n{x}" for x in own[30:]], *stuffed)
    out = {r.id: r for r in rules.judge(df).collect()}
    assert all(out[i].kept for i in range(40))              # own words are left
    assert not any(out[i].kept for i in range(40, 50))
    assert out[30].n_removed == 40


def test_copies_of_a_clean_text_are_no_boilerplate(docs):
    df = docs(*[" ".join(f"w{j}" for j in range(50))] * 60)
    assert all(r.kept for r in rules.judge(df).collect())


@pytest.mark.parametrize("size", [100, 500])
def test_the_limit_does_not_rise_with_the_host(docs, size):
    line = " ".join(name(20, j) for j in range(40))
    df = docs(*[f"{line}\ntail w{i}" for i in range(11)], *[" ".join(name(i, j) for j in range(25)) for i in range(100, 100 + size)])
    out = {r.id: r for r in rules.judge(df).collect()}
    assert [out[i].n_removed for i in range(11)] == [40] * 11 and not any(out[i].kept for i in range(11))
    assert all(out[i].kept for i in range(11, 11 + size))


def test_frequent_lines_are_cut_from_the_texts(docs, edge, empty):
    line = " ".join(name(20, j) for j in range(10))
    own = [" ".join(name(i, j) for j in range(25)) for i in range(100, 112)]
    df = docs(*[f"{line.upper()} \n{x}\n\n{line}" for x in own], f"{line}\nend", own[0], None)
    df = df.union(df.where("doc_id IN (0, 13)"))
    cut = rules.drop_frequent_lines(df)
    assert cut.columns == df.columns
    rows = cut.collect()
    assert sorted(r.doc_id for r in rows) == sorted([*range(15), 0, 13])
    want = {**{i: x + "\n" for i, x in enumerate(own)}, 12: "end", 13: own[0], 14: None}
    assert all(r.text == want[r.doc_id] and r.n_chars == (None if r.text is None else len(r.text)) for r in rows)
    judged = {r.id: r for r in rules.judge(df).collect()}
    assert [judged[i].n_removed for i in (0, 12, 13, 14)] == [20, 10, 0, 0]
    kept = rules.clean(df).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == sorted((r.doc_id, r.text) for r in rows if judged[r.doc_id].kept)
    assert sorted(map(str, rules.drop_frequent_lines(edge).collect())) == sorted(map(str, edge.collect()))
    assert rules.drop_frequent_lines(empty).count() == 0


def test_rules_on_edge_rows(edge, empty):
    got = rules.judge(edge).collect()
    assert len(got) == edge.count()
    assert {(r.n_words, r.word_chars) for r in got if r.id == 6} == {(30_000, 120_000)}
    assert all(r.base_failed for r in got if r.id in (1, 2, 3, 4))
    assert rules.judge(empty).count() == 0


# --- Byte networks ---------------------------------------------------------------------------

def test_chunks_cover_every_byte():
    for n in (0, 1, 100, 515, 516, 970, 971, 5000):
        data = bytes(i % 251 + 1 for i in range(n))
        view = bytechunks.chunk_view(data, cnn.LENGTH, cnn.STRIDE)
        seen = np.zeros(max(n, 1) + cnn.LENGTH + cnn.STRIDE, bool)
        for i in range(len(view)):
            seen[i * cnn.STRIDE:i * cnn.STRIDE + cnn.LENGTH] = True
        assert seen[:n].all() and len(view) == 1 + max(0, -(-(n - cnn.LENGTH) // cnn.STRIDE))


def numeric(f, array, at, eps=1e-2):
    old = array[at]
    array[at] = old + eps
    up = f()
    array[at] = old - eps
    down = f()
    array[at] = old
    return (up - down) / (2 * eps)


def test_back_propagation_through_time_matches_finite_differences():
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in gru.initial(3).items()}
    x, y = rng.integers(1, 20, (4, 7)).astype(np.uint8), np.array([0, 1, 2, 1])
    grads, _ = gru.gradients(p, x, y)
    for name, at in (("rec_f", (1, 3)), ("rec_b", (0, 20)), ("in_f", (int(x[0, 0]), 2)), ("in_b", (int(x[1, 3]), 17)), ("out_b", (2, 1)), ("shift", (0,))):
        assert grads[name][at] == pytest.approx(numeric(lambda: gru.gradients(p, x, y)[1], p[name], at), rel=0.05, abs=2e-4)


def naive_logit(p, data):
    """The convolution window by window, pooled chunk by chunk."""
    logits, at = [], 0
    while True:
        chunk = data[at:at + cnn.LENGTH].ljust(cnn.LENGTH, b"\0")
        best = np.full(cnn.FILTERS, -np.inf)
        for i in range(cnn.LENGTH - cnn.WIDTH + 1):
            window = np.concatenate([p["embed"][c] for c in chunk[i:i + cnn.WIDTH]])
            best = np.maximum(best, window @ p["filters"])
        logits.append(float((np.maximum(best + p["bias"], 0) @ p["out"] + p["shift"])[0]))
        if at + cnn.LENGTH >= len(data):
            return np.mean(logits)
        at += cnn.STRIDE


def test_convolution_and_pooling_against_a_naive_version(docs):
    rng = np.random.default_rng(4)
    p = {"embed": rng.normal(0, 0.5, (256, cnn.EMBED)), "filters": rng.normal(0, 0.3, (cnn.WIDTH * cnn.EMBED, cnn.FILTERS)),
         "bias": rng.normal(0, 0.1, cnn.FILTERS), "out": rng.normal(0, 0.3, (cnn.FILTERS, 1)), "shift": rng.normal(0, 1, 1)}
    p = {k: v.astype(np.float32) for k, v in p.items()}
    texts = ["", "a short text", "".join(map(chr, rng.integers(32, 127, 515))), "".join(map(chr, rng.integers(32, 127, 1700)))]
    got = {r.id: r.score for r in cnn.score(docs(*texts), p).collect()}
    for i, t in enumerate(texts):
        assert got[i] == pytest.approx(1 / (1 + np.exp(-naive_logit(p, t.encode()))), rel=1e-4)


def test_convolution_gradients_match_finite_differences():
    rng = np.random.default_rng(5)
    x = rng.integers(32, 60, (6, 40)).astype(np.uint8)
    y, w = np.array([0, 1, 1, 0, 1, 0]), rng.uniform(0.5, 2, 6)
    p = {"embed": rng.normal(0, 0.5, (256, cnn.EMBED)), "filters": rng.normal(0, 0.3, (cnn.WIDTH * cnn.EMBED, cnn.FILTERS)),
         "bias": np.zeros(cnn.FILTERS), "out": rng.normal(0, 0.3, (cnn.FILTERS, 1)), "shift": np.zeros(1)}

    def loss(p):
        z = cnn.chunk_logits(p, x)[:, 0]
        return float((w * (np.logaddexp(0, z) - y * z)).sum() / len(y))
    grads = cnn._gradients(p, x, y, w)
    for k, at in (("filters", (3, 2)), ("filters", (11, 7)), ("bias", (4,)), ("out", (5, 0)), ("shift", (0,)), ("embed", (40, 1))):
        moved = {n: v.copy() for n, v in p.items()}
        moved[k][at] += 1e-5
        up = loss(moved)
        moved[k][at] -= 2e-5
        assert float(grads[k][at]) == pytest.approx((up - loss(moved)) / 2e-5, rel=2e-2, abs=2e-5)


def naive_probs(p, data):
    """Both recurrent units byte by byte over every chunk; the mean over all positions."""
    h = gru.HIDDEN
    sig = lambda v: 1 / (1 + np.exp(-v))

    def walk(side, codes):
        state, out = np.zeros(h), []
        for c in codes:
            x, r = p[f"in_{side}"][c].astype(float), state @ p[f"rec_{side}"].astype(float)
            z, g = sig(x[:h] + r[:h]), sig(x[h:2 * h] + r[h:2 * h])
            state = (1 - z) * np.tanh(x[2 * h:] + g * r[2 * h:]) + z * state
            out.append(state)
        return out
    total, n, at = 0.0, 0, 0
    while True:
        chunk = data[at:at + gru.LENGTH].ljust(gru.LENGTH, b"\0")
        for c, f, b in zip(chunk, walk("f", chunk), reversed(walk("b", chunk[::-1]))):
            if c:
                v = np.exp(f @ p["out_f"] + b @ p["out_b"] + p["shift"])
                total, n = total + v / v.sum(), n + 1
        if at + gru.LENGTH >= len(data):
            return total / n
        at += gru.STRIDE


def test_recurrent_pass_against_a_naive_version(docs):
    p = gru.initial(3)
    texts = ["ab", "some words of a text", "ünïcode " * 40, "x" * 128, "y z " * 100]
    got = {r.id: (r.lang_pred, r.score) for r in gru.identify(docs(*texts), p, ["aa", "bb", "cc"]).collect()}
    for i, t in enumerate(texts):
        want = naive_probs(p, t.encode())
        assert got[i][0] == ["aa", "bb", "cc"][int(want.argmax())] and got[i][1] == pytest.approx(float(want.max()), rel=1e-4)


def test_rows_sharing_an_id_do_not_crowd_out_a_language(docs):
    df = docs(*["the same words again and again"] * 3000, ids=[7] * 3000, lang="en").union(
        docs(*[f"der die das {i}" for i in range(60)], ids=range(100, 160), lang="de"))
    model, langs = gru.train(df, per_lang=10)
    assert langs == ["de", "en"]
    chosen = df.sparkSession.createDataFrame([(7, "en")], "id bigint, y string")
    assert len(bytechunks.training_chunks(df, chosen, "y", 48, 3, 1)[1]) == 1


def test_networks_on_held_out_rows(spark):
    from pyspark.sql import functions as F
    sf = "/root/testdata/sf0.01"
    held = F.col("held_out")
    q = cnn.op4_quality_cnn(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where(held).collect()
    assert np.mean([r.predicted == r.quality for r in q]) > 0.9 and np.mean([r.predicted for r in q if r.quality]) > 0.95
    lang = gru.op10_language_gru(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    rows = lang.where(held).collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.97


def test_networks_on_edge_rows(spark, edge, empty):
    labels = spark.createDataFrame([(4, 1, 0), (6, 0, 0), (7, None, None), (99, 1, 1), (None, 0, 0)], "doc_id bigint, quality int, toxic int")
    none = labels.where("false")
    for rows, marks in ((edge, labels), (edge, none), (empty, labels), (empty, none)):
        model = cnn.train(rows, marks)
        got = cnn.score(rows, model).collect()
        assert len(got) == rows.count() and all(0 <= r.score <= 1 for r in got)
        assert cnn.keep_good(rows, marks).columns == rows.columns
    got = {r.id: r for r in gru.identify(edge, *gru.train(edge)).collect()}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (1, 2, 3))
    assert got[4].lang_pred != "und" and 0 <= got[4].score <= 1
    assert gru.identify(empty, *gru.train(empty)).count() == 0
    assert {r.lang_pred for r in gru.identify(edge, *gru.train(empty)).collect()} == {"und"}


# --- Packing --------------------------------------------------------------------------------------

def test_pieces_are_a_partition_of_the_documents_ids(documents):
    from tokenizers import Tokenizer
    import public_tokenizers
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = packing.pack(documents).collect()
    for d in documents.collect():
        ids = np.array([*t.encode(d.text, add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for r in sorted((r for r in rows if r.doc_id == d.doc_id), key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    padding = 0
    for held in sequences.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= 1024
        padding += 0 if end & (end - 1) == 0 else 1024 - end
    assert padding < 0.01 * sum(r.length for r in rows)


def test_long_runs_of_blanks_are_packed(docs):
    texts = [" " * 2_000_000, "\n" * 1_500_000, " \n\t" * 500_000 + "x", "x " * 5 + " " * 1_000_001 + "y"]
    rows = packing.pack(docs(*texts)).collect()
    assert {r.doc_id for r in rows} == {0, 1, 2, 3}
    assert all(sum(r.length for r in rows if r.doc_id == i) == next(r.doc_tokens for r in rows if r.doc_id == i) for i in range(4))


def test_cuts_fill_their_classes():
    for n in range(1, 3000):
        pieces = packing.cut(n)
        assert sum(pieces) == n and max(pieces) <= 1024
        assert all(p < packing.SMALL or (1024 // p) * p >= packing.MIN_FILL * 1024 - 1024 // p for p in pieces)


def test_packing_on_edge_rows(edge, empty):
    rows = packing.pack(edge).collect()
    assert sum(r.length for r in rows if r.doc_id == 1) == 1
    assert sum(r.length for r in rows if r.doc_id == 4) == 2 * next(r.doc_tokens for r in rows if r.doc_id == 4)
    assert packing.pack(empty).count() == 0
