"""Spelling variants, conversation repair and token files, against brute force."""

import hashlib
import heapq
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from clinrisk.llm import bpe, common
from clinrisk.llm import op6_packing as packing
from clinrisk.llm import op11_spelling_variants as spelling
from clinrisk.llm import op12_conversation_repair as repair
from clinrisk.llm import op13_token_output as output
from clinrisk.llm.common import stored
from clinrisk.llm.elias_fano import EliasFano
from clinrisk.session import scratch_path

SMALL = "/root/testdata/sf0.001"
WS = " \t\n\x0b\x0c\r"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- Spelling variants ----------------------------------------------------------------

def brute_variants(rows, damage=199, min_chars=6, min_count=5, ratio=5):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if damage and h % damage == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += len(run) >= min_chars
    known = {w: n for w, n in counts.items() if n >= min_count}
    near, slots = defaultdict(set), defaultdict(set)
    for w in known:
        for i in range(len(w)):
            slots[w[:i], w[i + 1:]].add(w)
            if (d := w[:i] + w[i + 1:]) in known:
                near[w].add(d)
                near[d].add(w)
    for held in slots.values():
        for w in held:
            near[w] |= held - {w}
    form = {}
    for w, n in known.items():
        best = min(near[w], key=lambda x: (-known[x], x), default=None)
        if best and known[best] >= ratio * n:
            form[w] = best
    out = []
    for w, n in known.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), known.get(form.get(w))))
    return sorted(out, key=str)


def variants(df, **params):
    return sorted((tuple(r) for r in spelling.group_variants(spelling.damaged(spelling.runs(df)), **params).collect()), key=str)


def made_up(seed, n):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(6, 9))) for _ in range(12)]
    def word():
        w = rng.choice(base[:1 + rng.randrange(12)])
        if rng.random() < 0.4:
            i = rng.randrange(len(w))
            w = rng.choice([w[:i] + w[i + 1:], w[:i] + rng.choice("abcdeéÿÀ") + w[i:], w[:i] + rng.choice("abcdé") + w[i + 1:], w.upper()])
        return w
    return [" ".join(word() + rng.choice(["", ".", ", 9", "'s", "\n"]) for _ in range(60)) for _ in range(n)]


def test_variants_of_the_smallest_table(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = sorted((tuple(r) for r in spelling.op11_spelling_variants(spark, SMALL).collect()), key=str)
    assert got == brute_variants(rows) and any(r[1] for r in got)


@pytest.mark.parametrize("filter_bytes", [1 << 20, 64])
def test_variants_of_dense_neighbourhoods_and_many_rounds(docs, monkeypatch, filter_bytes):
    monkeypatch.setattr(spelling, "PIECE", 100)
    monkeypatch.setattr(spelling, "TILE", 7)
    texts = [*made_up(1, 60), None, "", "aaaaaaa aaaaaa " * 20, "x" * 5000]
    df = docs(*texts)
    assert variants(df, filter_bytes=filter_bytes) == brute_variants(list(enumerate(texts)))
    assert len(spelling.rounds({6: 100, 7: 40}, 64)) > 2


def test_edits_are_those_of_the_words():
    words = ["aabbaa", "abcdef", "éèéèéè"]
    alphabet = np.frombuffer("abcé".encode("latin-1"), np.uint8)
    of = {int(h): w for w in {v for w in words for v in brute_edits(w, "abcé")} for h in hashes_of(w)}
    for n, rows, codes in spelling.by_length(words):
        seen = Counter()
        for length, place, code, some, h in spelling.edits(codes, alphabet):
            for k, x in zip(rows[some].tolist(), h.tolist()):
                w = words[k]
                spelled = w[:place] + (chr(code) if code >= 0 else "") + w[place + 1:]
                assert of[x] == spelled and len(spelled) == length
                seen[w, spelled] += 1
        assert set(seen.values()) == {1}


def brute_edits(w, alphabet):
    return {w[:i] + w[i + 1:] for i in range(len(w))} | {w[:i] + c + w[i + 1:] for i in range(len(w)) for c in alphabet if c > w[i]}


def hashes_of(w):
    return spelling.hashes(np.frombuffer(w.encode("latin-1"), np.uint8).reshape(1, -1)).tolist()


def test_variants_on_edge_rows(edge, empty):
    assert variants(edge, min_count=2) == brute_variants([(r.doc_id, r.text) for r in edge.collect()], min_count=2)
    assert variants(empty) == []


# --- Conversation repair --------------------------------------------------------------

def brute_repair(rows):
    """Uniform-cost search in the order of (cost, audit)."""
    seen, faults = set(), []
    for role, text in rows:
        end = text.rstrip(WS)
        faults.append("b" if not end else "d" if (role, text) in seen else "t" if end[-1] not in ".!?" else "")
        seen.add((role, text))
    heap, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, i, after, out = heapq.heappop(heap)
        if i == len(rows) and after in ("", "a"):
            break
        if (i, after) in done:
            continue
        done.add((i, after))
        turn = "a" if after == "u" else "u"
        role = {"u": "user", "a": "assistant"}[turn]
        heapq.heappush(heap, (cost + 2, audit + "I", i, turn, (*out, (role, ""))))
        if i < len(rows):
            own, text = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, after, out))
            if faults[i] in ("", "t"):
                more = cost + (faults[i] == "t")
                initial = (own or " ")[0]
                if initial == turn or (initial == "s" and not after):
                    heapq.heappush(heap, (more, audit + "K", i + 1, initial, (*out, (own, text))))
                heapq.heappush(heap, (more + 2, audit + "R", i + 1, turn, (*out, (role, text))))
    initials = [(r or " ")[0] for r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    return faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, digest


def brute_report(rows, damage=True):
    held = defaultdict(list)
    for conv, turn, role, text in rows:
        held[conv] += []
        role, text = " " if role is None else role, " " if text is None else text
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damage else 9
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        held[conv] += [(turn, "user" if h == 4 else role, text)] * (0 if h == 0 else 2 if h == 3 else 1)
    out = []
    for conv, v in held.items():
        v.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        turns = [r[0] for r in v if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out.append((conv, gaps, *brute_repair([r[1:] for r in v])))
    return sorted(out, key=str)


TURNS = "conv_id bigint, turn bigint, role string, text string"


def conversations(seed, n=50):
    rng, rows = random.Random(seed), []
    for conv in [*range(n), None]:
        for i in range(rng.choice([1, 1, 2, 3, 5, 9, 14])):
            turn = None if i == 3 else i + rng.randrange(2) * (i > 3) * 20
            rows.append((conv, turn, rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None]),
                         rng.choice([f"a{i}.", f"b{i}!", "same.", "no end", "", " \t", None, f"q{i}?\n"])))
    return list({(r[0], r[1]): r for r in rows}.values())


def report(df, rows, *cuts):
    return sorted((tuple(r) for r in repair.repair_report(df, rows, *cuts).collect()), key=str)


def test_repairs_of_the_smallest_table(spark):
    df = spark.read.parquet(f"{SMALL}/conversations.parquet")
    got = sorted((tuple(r) for r in repair.op12_conversation_repair(spark, SMALL).collect()), key=str)
    assert got == brute_report([tuple(r) for r in df.collect()])


@pytest.mark.parametrize("cuts", [(128, 64), (1, 2), (3, 2)])
def test_repairs_do_not_depend_on_the_stretches(spark, cuts):
    rows = conversations(3)
    df = spark.createDataFrame(rows, TURNS).selectExpr("*", "1 AS at", "2 AS cid", "'x' AS fault")
    assert report(df, repair.damaged(df), *cuts) == brute_report(rows)
    if cuts[0] < 128:
        assert report(df, repair.plain(df), *cuts) == brute_report(rows, damage=False)


def test_a_conversation_of_many_rows_is_cut_up(spark):
    rng = random.Random(5)
    rows = [(7, i, rng.choice(["user", "assistant", "system"]), rng.choice([f"t{i}.", "dup.", "", f"x{i}"])) for i in range(1500)]
    df = spark.createDataFrame(rows, TURNS)
    found = repair.segments(stored(repair.numbered(repair.marked(repair.plain(df))), "t"))
    assert found.count() == 12 and found.selectExpr("max(length(initials))").first()[0] == 128
    assert report(df, repair.plain(df), 128, 4) == brute_report(rows, damage=False)


def test_repaired_rows_are_sound(spark):
    rows = conversations(4)
    df = spark.createDataFrame(rows, TURNS)
    marked = repair.marked(repair.damaged(df))
    numbered = stored(repair.numbered(marked), "t")
    turns = repair.repaired_turns(marked, numbered, stored(repair.repairs(numbered), "r")).collect()
    held = defaultdict(str)
    for r in sorted(turns, key=lambda r: (r.cid, r.at, r.k)):
        held[r.cid] += r.role[0]
    assert held and all(re.fullmatch("s?(ua)+", v) for v in held.values())


def test_repair_of_nothing(spark):
    df = spark.createDataFrame([], TURNS)
    assert repair.repair_report(df, repair.damaged(df)).collect() == []
    gone = [(c, 0, "user", "x.") for c in range(200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    df = spark.createDataFrame(gone, TURNS)
    assert report(df, repair.damaged(df)) == sorted(((c, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c, *_ in gone), key=str)


# --- Token files --------------------------------------------------------------------------

@pytest.mark.parametrize("values", [[], [0], [5], [0, 0, 0], [3, 3, 900, 901, 5_000_000], list(range(0, 3000, 7)), [-(1 << 63), -5, 0, 1 << 62],
                                    sorted(random.Random(1).randrange(1 << 40) for _ in range(2000))])
def test_elias_fano_round_trip_and_select(values):
    a = np.array(values, np.int64)
    data = b"abc" + EliasFano.of(a).to_bytes() + b"rest"
    s, stop = EliasFano.from_bytes(data, 3)
    assert data[stop:] == b"rest" and s.all().tolist() == values
    assert [s[i] for i in range(0, len(values), max(1, len(values) // 300))] == values[::max(1, len(values) // 300)]
    for v in {*values[:20], *values[-3:]}:
        assert s.first_at_least(v) == int(np.searchsorted(a, v)) and s.first_at_least(v + 1) == int(np.searchsorted(a, v, side="right"))


def test_boundaries_take_little_space():
    ends = np.cumsum(np.random.default_rng(2).integers(1, 2000, 100_000))
    bits = 8 * len(EliasFano.of(ends).to_bytes()) / len(ends)
    assert bits < 2 + np.log2(ends[-1] / len(ends)) + 1


def test_encoder_gives_the_librarys_ids(monkeypatch):
    slow = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(6)
    marks = [chr(c) for c in (9, 10, 13, 0x85, 0xA0, 0x1680, 0x2003, 0x2028, 0x3000, 0x200B, 0xFEFF, 0x1C, 0x1F, 0)] + [" "] * 6
    letters = [*marks, *"aZ9'.,é漢²½ßsl", "<|endoftext|>", "'s", " 're", "word", "’s"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(30))) for _ in range(3000)]
    texts += ["".join(chr(rng.randrange(32, 0x250)) for _ in range(60)) for _ in range(500)]
    want = [slow.encode(t, add_special_tokens=False).ids for t in texts]
    for window, cached in ((1 << 18, 400_000), (4, 50)):
        monkeypatch.setattr(bpe, "WINDOW", window)
        monkeypatch.setattr(bpe, "CACHED", cached)
        made = bpe.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
        assert [np.frombuffer(b, "<u2").tolist() for b in made.encode(texts)] == want


def expected(rows):
    slow = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out, at = [], 0
    for i, text in rows:
        ids = [*slow.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_token_rows_of_the_smallest_table(spark, documents):
    got = sorted((tuple(r) for r in output.op13_token_output(spark, SMALL).collect()), key=lambda r: r[1])
    assert got == expected(sorted((r.doc_id, r.text) for r in documents.collect()))


def test_single_documents_are_read_by_select(spark, documents):
    path = scratch_path(spark, "tokens")
    output.write_tokens(documents, path, segment=3000, partition_bytes=50_000)
    listed = stored(output.manifest(output.token_rows(spark, path)), "manifest")
    assert listed.count() > 20 and listed.selectExpr("count(DISTINCT path)").first()[0] > 4
    slow = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r.doc_id: r.text for r in documents.collect()}
    got = {r.doc_id: r.ids for r in output.read_documents(spark, listed, [0, 17, 180, 10**9]).collect()}
    assert got == {i: [*slow.encode(texts[i], add_special_tokens=False).ids, 0] for i in (0, 17, 180)}


def test_an_id_of_most_rows_is_dealt_over_partitions(spark, docs):
    df = docs(*[f"word {i}" for i in range(900)], ids=[*range(300), *[300] * 600])
    path = scratch_path(spark, "tokens")
    output.write_tokens(df, path, partition_bytes=500)
    rows = output.token_rows(spark, path)
    assert rows.where("doc_id = 300").selectExpr("count(DISTINCT part)").first()[0] > 3
    got = sorted(output.documents(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted(r.doc_id for r in got) and len(got) == 900
    assert all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:]))


def test_damaged_files_are_noticed():
    data = bytearray(output.pack_segment(0, 0, 2, [1, 2], [b"\1\0\0\0", b"\2\0"]))
    assert [s.span(1) for s in output.Segment.all(bytes(data) + output._TAIL.encode())] == [(2, 3)]
    data[-1] ^= 1
    with pytest.raises(ValueError):
        list(output.Segment.all(bytes(data) + output._TAIL.encode()))


def test_token_output_on_edge_rows(spark, edge, empty):
    path = scratch_path(spark, "tokens")
    output.write_tokens(edge, path, segment=100, partition_bytes=10_000)
    got = sorted((tuple(r) for r in output.documents(spark, path).collect()), key=lambda r: r[1])
    assert got == expected(sorted(((r.doc_id, r.text) for r in edge.collect()), key=lambda r: (r[0] is not None, r[0] or 0)))
    path = scratch_path(spark, "tokens")
    output.write_tokens(empty, path)
    assert output.documents(spark, path).collect() == []


def test_half_a_million_words_are_encoded_once():
    words = [" " + "".join(chr(97 + i // 26 ** k % 26) for k in range(5)) for i in range(500_000)]
    e, learned = bpe.Encoder(public_tokenizers.path("byte_bpe_50k.json")), []
    plain = e._learn
    e._learn = lambda new: learned.append(len(new)) or plain(new)
    first = list(e.encode("".join(words[i:i + 10_000]) for i in range(0, len(words), 10_000)))
    assert sum(learned) == len(words)
    learned.clear()
    assert list(e.encode("".join(words[i:i + 10_000]) for i in range(0, len(words), 10_000))) == first and not learned


def test_an_encoder_goes_when_another_operator_begins(spark):
    """Workers are used again: packing's next tasks find the encoder, tasks of other operators none beside them."""
    rows = spark.range(0, 160, 1, 16)

    def found(keep, make):
        def run(batches):
            n = len(common._KEPT)
            if make:
                bpe.encoder("byte_bpe_50k", make)
            yield from (pa.RecordBatch.from_arrays([pa.array([n] * b.num_rows)], names=["n"]) for b in batches)
        return {r.n for r in common.map_arrow(rows, run, "n bigint", keep=keep).collect()}
    assert 1 in found(True, 100)
    assert found(True, 200) <= {0, 1}           # the last one only
    assert found(False, None) == {0}


def test_packing_does_not_depend_on_the_runs_remembered(docs):
    df = docs(*[f"some words {i} and {i * 7} more of them" for i in range(300)]).coalesce(1)
    assert sorted(packing.pack(df, cached=20).collect()) == sorted(packing.pack(df).collect())


def test_an_encoder_remembers_no_more_than_asked():
    few = bpe.Encoder(public_tokenizers.path("byte_bpe_50k.json"), 1000)
    for k in range(20):
        list(few.encode(f"word{i} " for i in range(k * 500, k * 500 + 500)))
    assert 1000 <= len(few.known) < 2000
