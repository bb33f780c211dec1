"""Line dedup, mixing and license scans: brute force, plans, and edge rows."""

import hashlib
import re
from collections import defaultdict

import duckdb
import pytest

from clinrisk.llm import op1_line_dedup as line_dedup
from clinrisk.llm import op7_mixing as mixing
from clinrisk.llm import op9_license_scan as licenses
from clinrisk.llm import registry
from clinrisk.llm.common import stored

SMALL = "/root/testdata/sf0.001"
WS = " \t\n\x0b\x0c\r"


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    fix = lambda v: float(f"{v:.9g}") if isinstance(v, float) else v
    return sorted((tuple(fix(r[i]) for i in order) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_sql_parity(spark, name):
    df = registry.QUERIES[name](spark, SMALL)
    con = duckdb.connect()
    for t in ("documents", "labels", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    cur = con.execute(registry.ORACLE[name])
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(df.columns)
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon(columns, cur.fetchall())


@pytest.mark.parametrize("name", ["op1_line_dedup", "op7_mixing", "op9_license_scan"])
def test_native_plans_hold_no_python(spark, name):
    plan = registry.QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|MapInArrow|CartesianProduct|NestedLoop", plan)


# --- Line dedup -----------------------------------------------------------------

def cut_lines(rows, min_chars=40, min_docs=5):
    low = lambda s: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)
    holders = defaultdict(set)
    lines = [(i, (t or "").split("\n")) for i, t in rows]
    for i, held in lines:
        for x in held:
            holders[low(x.strip(WS))].add(i)
    out = []
    for i, held in lines:
        def gone(x, i=i):
            k = low(x.strip(WS))
            return len(k) >= min_chars and len(holders[k]) >= min_docs and i != max(j for j in holders[k] if j is not None)
        kept = [x for x in held if not gone(x)]
        out.append((i, len(held), len(held) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def run_cut(docs):
    from pyspark.sql import functions as F
    out = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs))
    return sorted((tuple(r) for r in out.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256)).collect()), key=str)


def test_repeated_lines_stay_in_the_largest_id(docs):
    common = "This line is found in many documents, every time."
    texts = [f"{common}\nown {i}\n  {common.upper()} \n" for i in range(7)] + [common, "short\nshort", "é" * 39, "é" * 40, None]
    texts += ["\n".join([common] * 200 + ["tail"])]
    df = docs(*texts)
    assert run_cut(df) == cut_lines([(r.doc_id, r.text) for r in df.collect()])


def test_four_documents_are_too_few_and_one_document_counts_once(docs):
    line = "y" * 40
    df = docs(*[f"{line}\n{line}" for _ in range(4)])
    assert all(r[2] == 0 for r in run_cut(df))
    repeated = docs(*[line] * 5, ids=[1, 1, 2, 3, 4])
    assert all(r[2] == 0 for r in run_cut(repeated))


def test_line_dedup_on_edge_rows(edge, empty):
    assert run_cut(edge) == cut_lines([(r.doc_id, r.text) for r in edge.collect()])
    assert run_cut(empty) == []
    assert line_dedup.drop_repeated_lines(edge).columns == edge.columns
    assert line_dedup.drop_repeated_lines(edge).count() == edge.count()


def test_bitmaps_hold_only_words_with_a_dropped_line(docs):
    line = "z" * 50
    far = "\n".join([f"own {i}" for i in range(1000)] + [line])
    df = docs(*[far] * 6)
    rows = line_dedup.keep_bitmaps(df).collect()
    assert len(rows) == 5 and all(len(r.keep) == 1 and r.keep[0].word == 1000 // 64 for r in rows)


# --- Mixing -----------------------------------------------------------------------

def fill(sizes, weights, epochs=3):
    target, open_, rest = {}, dict(weights), sum(sizes.values())
    while open_:
        total = sum(open_.values())
        over = [s for s in open_ if epochs * sizes[s] < rest * open_[s] / total]
        if not over:
            return target | {s: rest * w / total for s, w in open_.items()}
        for s in over:
            target[s] = epochs * sizes[s]
            rest -= epochs * sizes[s]
            del open_[s]
    return target


def test_water_filling_matches_rounds_by_hand(spark):
    sizes = {f"s{i:02}": 10 ** (i % 5) * (i + 1) for i in range(30)}
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(sizes))}
    rows = spark.createDataFrame([(s, n, weights[s]) for s, n in sizes.items()], "source string, source_size bigint, weight bigint")
    got = {r.source: r.target for r in mixing.water_fill(rows).collect()}
    assert got == pytest.approx(fill(sizes, weights))
    assert sum(got.values()) == pytest.approx(sum(sizes.values()))


def test_taken_words_meet_the_targets(spark, documents):
    rows, cut, n = mixing.allotment(documents)
    out = mixing.with_taken(rows, cut, n).collect()
    assert len(out) == documents.count() and all(0 <= r.taken <= 3 * r.size for r in out)
    by = defaultdict(list)
    for r in out:
        by[r.source].append(r)
    for held in by.values():
        # Documents are taken whole, so the end is off by at most half of the largest.
        assert sum(r.taken for r in held) == pytest.approx(held[0].target, abs=max(r.size for r in held) / 2 + 1)
        assert all(r.taken % r.size == 0 for r in held if r.size)


def test_an_id_that_many_rows_share_is_no_hot_spot(spark, docs):
    df = docs(*[f"w{i} " * (1 + i % 7) for i in range(400)], ids=[None] * 400, source="a").union(
        docs(*["x " * 50 for _ in range(40)], ids=[5] * 40, source="b"))
    rows, cut, n = mixing.allotment(df)
    out = mixing.with_taken(rows, cut, n).collect()
    a = [r for r in out if r.source == "a"]
    assert sum(r.taken for r in a) == pytest.approx(a[0].target, abs=4)
    assert all(r.taken % r.size == 0 for r in out)
    assert cut.where("upto IS NOT NULL").count() <= 2 and mixing.mix(df).where("source = 'a'").count() == sum(r.taken // r.size for r in a)


def test_mixing_is_repeatable_and_renders_whole_copies(documents):
    a = sorted(tuple(r) for r in mixing.mix(documents).collect())
    assert a == sorted(tuple(r) for r in mixing.mix(documents.repartition(7)).collect())
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    rows, cut, n = mixing.allotment(documents)
    assert sum(words(r[1]) for r in a) == sum(r.taken for r in mixing.with_taken(rows, cut, n).collect())
    assert {r[1] for r in a} <= {r.text for r in documents.collect()}


def test_mixing_on_edge_rows(edge, empty):
    rows, cut, n = mixing.allotment(edge)
    out = mixing.with_taken(rows, cut, n).collect()
    assert len(out) == edge.count() and all(r.taken <= 3 * r.size for r in out)
    assert mixing.mix(edge).columns == edge.columns
    rows, cut, n = mixing.allotment(empty)
    assert mixing.with_taken(rows, cut, n).count() == 0 and mixing.mix(empty).count() == 0


# --- License scans ------------------------------------------------------------------

def test_base_places_and_method_labels(docs):
    df = docs("under the MIT license under the mit-license", "Apache License, Version 2.0", "cc by nc cc by nc", None, "",
              "This work is licensed under a GNU general public license, version 3", "no license here",
              "Redistribution and use in source and binary forms, with or without modification, are permitted",
              "under the mit", "x under the mit license" * 2)
    got = {r.id: r for r in licenses.scan_licenses(df).collect()}
    assert (got[0].n_base, got[0].first_word, got[0].last_word, got[0].base_labels) == (2, 0, 4, "mit")
    assert (got[1].n_base, got[1].base_labels) == (1, "apache-2")
    assert (got[2].n_base, got[2].first_word, got[2].last_word) == (2, 0, 3)
    assert (got[3].n_words, got[3].n_base, got[3].labels, got[3].score) == (0, 0, "", 0.0)
    assert got[5].labels == "gpl-3" and 0.6 <= got[5].score < 1 and got[5].n_base == 0
    assert got[6].labels == "" and got[7].labels == "bsd" and got[8].labels == ""
    assert got[9].n_base == 1       # "licensex" is another word


def test_templates_of_any_length(docs):
    words = " ".join(f"t{i}" for i in range(300))
    half = " ".join(f"t{i}" for i in range(150))
    gnu = "This is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the FSF"
    df = docs(f"x {words} y", half, " ".join(f"t{i}" for i in range(100, 290)), gnu, "nothing of the kind here", gnu.replace("General", "Lesser General"),
              "licensed under a Creative Commons Attribution-ShareAlike 4.0", licenses._MIT, licenses._BSD_WARRANTY)
    got = {r.id: (r.labels, r.score) for r in licenses.scan_licenses(df, templates={**licenses.NOTICES, words: "long"}).collect()}
    assert got[0] == ("long", 1.0) and got[1] == ("", 0.0) and got[2] == ("long", 188 / 298)
    assert [got[i][0] for i in range(3, 9)] == ["gpl", "", "lgpl", "cc-by-sa", "mit", "bsd"]


def test_any_number_of_templates(docs, monkeypatch):
    words = " ".join(f"t{i}" for i in range(300))
    df = docs(f"x {words} y", "under the MIT license", "word " * 50, None)
    small = licenses.scan_licenses(df, templates={words: "long"}).collect()
    monkeypatch.setattr(licenses, "MAX_BROADCAST_GRAMS", 10)
    assert sorted(map(str, licenses.scan_licenses(df, templates={words: "long"}).collect())) == sorted(map(str, small))


def test_license_scan_on_edge_rows(edge, empty):
    got = licenses.scan_licenses(edge).collect()
    assert len(got) == edge.count()
    assert {r.n_words for r in got if r.id == 6} == {30_000}
    assert [(r.n_base, r.base_labels) for r in got if r.id == 9] == [(2, "mit")]
    assert licenses.scan_licenses(empty).count() == 0


def test_stored_tables_lie_in_the_shared_folder(spark, documents):
    path = stored(documents.select("doc_id"), "probe").inputFiles()[0]
    assert spark.conf.get("spark.checkpoint.dir") in path


def test_a_hot_line_is_scanned_in_slices(spark, docs, monkeypatch):
    """The sorted scan decides the keeper, across the slices of one line."""
    line = "x" * 50
    df = docs(*[f"{line}\n{line}\nown {i}" for i in range(600)], ids=[(7 * i) % 600 for i in range(600)])
    seen = []
    monkeypatch.setattr(line_dedup, "stored", lambda f, name: seen.append((name, stored(f, name))) or seen[-1][1])
    got = {r.id: r.n_dropped for r in line_dedup.keep_bitmaps(df).collect()}
    assert got == {i: 2 for i in range(599)}
    runs = dict(seen)["line-runs"]
    assert {r.id for r in runs.where("keeper").collect()} == {599} and runs.where("first").count() == 600
