"""N-gram Jaccard self-join by vertical partitioning: all links, and their components.

Two documents link when their sets of word 4-grams have a Jaccard similarity of
at least ``PERCENT`` per cent.  The global order of n-grams (rare first) is cut
into fragments; what two sets share is counted fragment by fragment and the
partial counts are summed per pair.

1. ``shingle_sets``: size and 128-bit signature of every set.  Equal sets are one class;
   its smallest id represents it.
2. ``candidate_classes``: n-gram hashes go to fragments of the hash range, in packed
   blocks of (hash, set) per task chunk; an n-gram that a chunk has twice is sent once.
   Each fragment marks the n-grams that several classes hold.  A class needs
   85 % of its n-grams marked to have any link: the partial counts of all
   fragments are summed per class, and most documents end here.
3. Exact document frequencies of what is left give the global order.  Two linked sets
   share an n-gram among the rarest ``n - ceil(0.85 n) + 1`` of each, so lists of
   classes by prefix n-gram hold every linked pair.
4. Groups that hold every link are found first, and need no full pairing: every class is
   first paired with the list's most central class (mean log frequency of its n-grams), the
   pairs are verified by fragment (``verified``), and components are formed.
5. Every list that still spans several components is then searched for
   links between them, all pairs, minus those that bounds exclude: sizes,
   shared n-grams, and the sum over fragments of the smaller partial count.
   Long lists are searched in blocks of ``BLOCK`` x ``BLOCK`` classes in numpy.  Pairs that pass are verified too.
   No link leaves the groups of classes that are connected now.
6. ``all_links``: within a group all pairs are joined, in blocks that hold each class's n-grams once:
   partial overlaps of a block pair by fragments of ``FRAGMENT`` shared n-grams, summed per pair.  Every linked
   pair of classes is listed with its counts.  The groups are the components of the links.

``similarity_join`` returns the links and which row is of which class;
``link_counts`` the number of every row's links, summed in the block pairs without listing them.  Nothing but a few counts reaches the driver.

Defined cases: documents without words (null, empty) have the empty set, 0
shingles, and are their own component; with fewer than four words the whole
sequence is the one shingle; a null ``doc_id`` takes no part (null component);
repeated rows each get their class's result; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clinrisk.llm.bytewords import mix, windows, word_hashes
from clinrisk.llm.common import WORD_RE, bit, map_arrow, ship, stored, table

SIZE = 4                        # words of a shingle, a power of two
PERCENT = 85
CHUNK_GRAMS = 1 << 20           # n-grams of one packed chunk
FRAGMENT_GRAMS = 1 << 21        # n-grams that one fragment's task holds
MARK_BITS = 24                  # log2 of the bits of the map of class ids
VERIFY_FRAGMENTS = 8
PROFILE = 16                    # fragments of the bound in step 5
SHORT_LIST, BLOCK = 32, 1024
BLOCK_GRAMS = 1 << 22           # n-grams of a block in step 6
FRAGMENT = 4096                 # n-grams of a fragment in step 6

_U = np.uint64
_SEVERAL = 0xFFFF               # set number of an n-gram that a chunk holds in several sets


# --- Sets -------------------------------------------------------------------

def _sets(texts: list[bytes]) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for _, counts, hashes in word_hashes(texts, fold_case=True):
        grams = windows(hashes, SIZE)
        at = 0
        for n in counts.tolist():
            if n >= SIZE:
                yield np.unique(grams[at:at + n - SIZE + 1])
            elif n:
                h = np.full(1, n, _U)
                for i in range(n):
                    h = mix(h * _U(0xA24BAED4963EE407) + hashes[at + i])
                yield h
            else:
                yield np.zeros(0, _U)
            at += n


def _signature(grams: np.ndarray) -> tuple[int, int]:
    d = np.frombuffer(xxhash.xxh3_128_digest(grams.tobytes()), np.int64)
    return int(d[0]), int(d[1])


def _texts(column: pa.Array) -> list[bytes]:
    return [(t.as_py() or "").encode() for t in column]


def shingle_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, th, n, s1, s2) of every row; the signature of an empty set is null."""
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
    schema = f"id {rows.schema['id'].dataType.simpleString()}, th bigint, n bigint, s1 bigint, s2 bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [(len(g), *(_signature(g) if len(g) else (None, None))) for g in _sets(_texts(batch.column(2)))]
            n, s1, s2 = zip(*sets) if sets else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, pa.int64()) for c in (n, s1, s2))],
                                             names=["id", "th", "n", "s1", "s2"])
    return map_arrow(rows, run, schema)


# --- Classes that can have a link -------------------------------------------

def _planes(values: np.ndarray) -> bytes:
    """Sorted 32-bit values as byte planes of their steps, which compress well."""
    steps = np.diff(values, prepend=values.dtype.type(0))
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 4).T).tobytes()


def _unplaned(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint32).ravel(), dtype=np.uint32)


_PACKED = "route bigint, chunk bigint, a binary, b binary, c binary"


def _pack(chunk: int, sets: list[np.ndarray], sigs: list[tuple[int, int]], bits: int) -> Iterator[tuple]:
    """One header row of a chunk, and one row for each fragment: the chunk's
    distinct n-grams, the set that holds each, and those sets' signatures."""
    grams = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets), dtype=np.uint16), [len(s) for s in sets])
    order = np.argsort(grams, kind="stable")
    grams, owner = grams[order], owner[order]
    new = np.ones(len(grams), bool)
    new[1:] = grams[1:] != grams[:-1]
    starts = np.flatnonzero(new)
    many = np.diff(starts, append=len(grams)) > 1
    own = np.bincount(owner[np.repeat(many, np.diff(starts, append=len(grams)))], minlength=len(sets))
    grams, owner = grams[starts], np.where(many, np.uint16(_SEVERAL), owner[starts])
    sig = np.array(sigs, np.int64)
    sizes = np.array([len(s) for s in sets], np.int64)
    yield (-1 - (chunk * 0x9E3779B97F4A7C15 >> 20) % (1 << 40), chunk, sig.tobytes(), sizes.tobytes(), own.astype(np.int64).tobytes())
    fragment = (grams >> _U(64 - bits)).astype(np.int64)
    low = ((grams >> _U(32 - bits)) & _U(0xFFFFFFFF)).astype(np.uint32)
    edges = np.flatnonzero(np.diff(fragment, prepend=-1)).tolist() + [len(grams)]
    for a, b in zip(edges, edges[1:]):
        held, who = np.unique(owner[a:b], return_inverse=True)
        marks = np.where(held == _SEVERAL, 0, sig[np.minimum(held, len(sig) - 1), 0])
        yield (int(fragment[a]), chunk, _planes(low[a:b]), who.astype(np.uint16).tobytes(),
               held.astype(np.uint16).tobytes() + marks.tobytes())


def _packed_chunks(docs: DataFrame, bits: int, id_col: str, text_col: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 24
        held: dict[tuple[int, int], np.ndarray] = {}
        size = 0

        def emit() -> pa.RecordBatch:
            rows = list(_pack(chunk, list(held.values()), list(held), bits))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), *[pa.binary()] * 3))],
                                              names=["route", "chunk", "a", "b", "c"])
        for batch in batches:
            for grams in _sets(_texts(batch.column(0))):
                if not len(grams) or (key := _signature(grams)) in held:
                    continue
                held[key] = grams
                size += len(grams)
                if size >= CHUNK_GRAMS or len(held) >= _SEVERAL - 1:
                    yield emit()
                    chunk, held, size = chunk + 1, {}, 0
        if held:
            yield emit()
    return map_arrow(docs.where(F.col(id_col).isNotNull()).select(text_col), run, _PACKED)


def _count_fragment(group: pa.Table) -> pa.Table:
    """A fragment's partial counts: for every chunk, how many of each set's
    n-grams other sets hold too.  Header rows pass."""
    if group.column("route")[0].as_py() < 0:
        return group.select(["chunk", "a", "b", "c"])
    blocks = []
    for a, b, c in zip(*(group.column(k).to_pylist() for k in "abc")):
        n = len(c) // 10
        blocks.append((_unplaned(a), np.frombuffer(b, np.uint16), np.frombuffer(c, np.uint16, n), np.frombuffer(c, np.int64, n, 2 * n)
                       if (2 * n) % 8 == 0 else np.frombuffer(c[2 * n:], np.int64)))
    grams = np.concatenate([x[0] for x in blocks])
    marks = np.concatenate([x[3][x[1]] for x in blocks])
    alone = np.concatenate([(x[2] != _SEVERAL)[x[1]] for x in blocks])
    order = np.argsort(grams, kind="stable")
    ranked, signs = grams[order], marks[order]
    starts = np.flatnonzero(np.concatenate([np.ones(1, bool), ranked[1:] != ranked[:-1]]))
    shared = np.minimum.reduceat(signs, starts) != np.maximum.reduceat(signs, starts)
    shared |= ~np.logical_and.reduceat(alone[order], starts)
    flag = np.empty(len(grams), bool)
    flag[order] = np.repeat(shared, np.diff(starts, append=len(grams)))
    out, at = [], 0
    for (_, who, held, _), chunk in zip(blocks, group.column("chunk").to_pylist()):
        counts = np.bincount(who[flag[at:at + len(who)]], minlength=len(held))
        at += len(who)
        real = held != _SEVERAL
        out.append((chunk, held[real].tobytes(), counts[real].astype(np.uint32).tobytes(), None))
    return pa.table([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), *[pa.binary()] * 3))], names=["chunk", "a", "b", "c"])


def _sum_chunk(group: pa.Table) -> pa.Table:
    """A chunk's sets whose shared n-grams suffice for a link: (s1, s2)."""
    rows = list(zip(*(group.column(k).to_pylist() for k in "abc")))
    header = next(r for r in rows if r[2] is not None)
    sig, sizes = np.frombuffer(header[0], np.int64).reshape(-1, 2), np.frombuffer(header[1], np.int64)
    total = np.frombuffer(header[2], np.int64).copy()
    for a, b, c in rows:
        if c is None:
            total[np.frombuffer(a, np.uint16)] += np.frombuffer(b, np.uint32)
    found = sig[100 * total >= PERCENT * sizes]
    return pa.table([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["s1", "s2"])


def candidate_classes(docs: DataFrame, total_grams: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(s1, s2) of every set that can have a link (a superset; each once)."""
    ship(docs.sparkSession)
    bits = max(3, (max(1, total_grams) // FRAGMENT_GRAMS).bit_length())
    counts = (_packed_chunks(docs, bits, id_col, text_col).groupBy("route")
              .applyInArrow(_count_fragment, "chunk bigint, a binary, b binary, c binary"))
    return counts.groupBy("chunk").applyInArrow(_sum_chunk, "s1 bigint, s2 bigint").distinct()


def _marks(alive: DataFrame) -> tuple[np.ndarray, int]:
    """A bit map of the classes' ids by hash, and its length: 16 bits an id, at
    most MARK_BITS (2 MB) for any number of ids."""
    bits = 1 << min(MARK_BITS, max(13, (16 * alive.count()).bit_length()))
    spot = F.pmod(F.xxhash64("rep"), F.lit(bits))
    words = alive.select(spot.alias("spot")).groupBy(F.floor(F.col("spot") / 64).alias("word")).agg(F.bit_or(bit(F.col("spot") % 64)).alias("set"))
    found = words.toArrow()
    marks = np.zeros(bits // 64, np.int64)
    marks[found.column("word").to_numpy()] = found.column("set").to_numpy()
    return marks.view(_U), bits


def class_grams(docs: DataFrame, alive: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(rep, n, grams) of the classes in ``alive`` (rep, s1, s2), from the
    texts.  A bit map of bounded size drops most other documents in the scan;
    the join on the id and the signature decides.  Texts are never shuffled."""
    marks, bits = _marks(alive)
    held = docs.sparkSession.sparkContext.broadcast(marks)
    spot = F.pmod(F.xxhash64(F.col(id_col).cast("bigint")), F.lit(bits))
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("rep"), spot.alias("spot"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = held.value
        for batch in batches:
            spots = batch.column(1).to_numpy()
            some = np.flatnonzero((marks[spots >> 6] >> (spots & 63).astype(_U)) & _U(1))
            part = batch.take(pa.array(some))
            sets = [(i, g) for i, g in enumerate(_sets(_texts(part.column(2)))) if len(g)]
            grams = [g.view(np.int64) for _, g in sets]
            ends = np.cumsum([0, *(len(g) for g in grams)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*grams, np.zeros(0, np.int64)])))
            sigs = np.array([_signature(g) for _, g in sets], np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array([i for i, _ in sets], pa.int64())), pa.array(sigs[:, 0]), pa.array(sigs[:, 1]),
                                              pa.array([len(g) for g in grams], pa.int64()), lists], names=["rep", "s1", "s2", "n", "grams"])
    made = map_arrow(rows, run, "rep bigint, s1 bigint, s2 bigint, n bigint, grams array<bigint>")
    return made.join(alive, ["rep", "s1", "s2"], "left_semi").select("rep", "n", "grams")


# --- Links --------------------------------------------------------------------

def _least_shared(n: str | Column) -> Column:
    """ceil(PERCENT % of n)."""
    n = F.col(n) if isinstance(n, str) else n
    return F.floor((n * PERCENT + 99) / 100).cast("bigint")


def _may_link(n: Column, shared: Column, m: Column, shared_m: Column) -> Column:
    return (100 + PERCENT) * F.least(shared, shared_m) >= PERCENT * (n + m)


def ranked_grams(classes: DataFrame) -> DataFrame:
    """(rep, n, grams in the global order without those of one class only, shared = their number, central)."""
    each = classes.select("rep", "n", F.explode("grams").alias("gram"))
    df = stored(each.groupBy("gram").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "gram-df")
    ranked = (each.join(df, "gram").groupBy("rep", "n")
              .agg(F.sort_array(F.collect_list(F.struct("df", "gram"))).alias("order"), (F.sum(F.log("df"))).alias("weight")))
    ranked = ranked.select("rep", "n", F.col("order.gram").alias("grams"), F.size("order").cast("bigint").alias("shared"),
                           F.round(F.col("weight") / F.col("n"), 6).alias("central"))
    return ranked.where(F.col("shared") >= _least_shared("n"))


def verified(pairs: DataFrame, ranked: DataFrame) -> DataFrame:
    """The pairs (a, b) that link: partial overlaps by fragment, summed per pair."""
    def fragment(f: int) -> Column:
        return F.filter("grams", lambda g: F.pmod(g, F.lit(VERIFY_FRAGMENTS)) == f)
    cut = F.array(*[fragment(f) for f in range(VERIFY_FRAGMENTS)])
    parts = ranked.select("rep", "n", F.posexplode(cut).alias("fragment", "grams"))
    left = parts.select(F.col("rep").alias("a"), F.col("n").alias("na"), "fragment", F.col("grams").alias("ga"))
    right = parts.select(F.col("rep").alias("b"), F.col("n").alias("nb"), "fragment", F.col("grams").alias("gb"))
    both = pairs.join(left, "a").join(right, ["b", "fragment"])
    partial = both.select("a", "b", "na", "nb", F.size(F.array_intersect("ga", "gb")).alias("part"))
    total = partial.groupBy("a", "b", "na", "nb").agg(F.sum("part").alias("both"))
    return total.where((100 + PERCENT) * F.col("both") >= PERCENT * (F.col("na") + F.col("nb"))).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest id reachable, by minimum labels and pointer jumping."""
    edges = stored(links.union(links.select("b", "a")), "edges")
    label = stored(edges.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("label")), "labels")
    while True:
        near = edges.join(label.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        lower = label.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("mid"))
        jump = lower.join(label.select(F.col("node").alias("mid"), "label"), "mid", "left")
        new = stored(jump.select("node", "old", F.least("mid", "label").alias("label")), "labels")
        label = new.select("node", "label")
        if new.where("old <> label").isEmpty():
            return label


def _search_block(group: pa.Table) -> pa.Table:
    """Pairs of one block pair of a list that the bounds don't exclude."""
    c = {k: group.column(k).to_numpy() for k in ("rep", "n", "shared", "label", "salt", "i", "j")}
    profile = np.frombuffer(b"".join(group.column("profile").to_pylist()), np.uint32).reshape(-1, PROFILE).astype(np.int64)
    first = np.flatnonzero(c["salt"] == c["i"][0])
    second = np.flatnonzero(c["salt"] == c["j"][0])
    a_out, b_out = [], []
    for x in first.tolist():
        n = c["n"][second] + c["n"][x]
        ok = (c["label"][second] != c["label"][x]) & ((100 + PERCENT) * np.minimum(c["shared"][second], c["shared"][x]) >= PERCENT * n)
        if c["i"][0] == c["j"][0]:
            ok &= c["rep"][second] > c["rep"][x]
        some = second[ok]
        bound = np.minimum(profile[some], profile[x]).sum(axis=1)
        some = some[(100 + PERCENT) * bound >= PERCENT * n[ok]]
        a_out.append(np.minimum(c["rep"][some], c["rep"][x]))
        b_out.append(np.maximum(c["rep"][some], c["rep"][x]))
    return pa.table([pa.array(np.concatenate([*v, np.zeros(0, np.int64)]).astype(np.int64)) for v in (a_out, b_out)], names=["a", "b"])


def _profiles(ranked: DataFrame) -> DataFrame:
    """(rep, profile): the number of n-grams in each of PROFILE fragments."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [np.bincount(np.array(g, np.int64) % PROFILE, minlength=PROFILE).astype(np.uint32).tobytes()
                    for g in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], names=["rep", "profile"])
    return map_arrow(ranked.select("rep", "grams"), run, "rep bigint, profile binary")


def _between_components(prefix: DataFrame, ranked: DataFrame, label: DataFrame, done: DataFrame) -> DataFrame:
    """Pairs of a list whose classes are in different components, not yet verified."""
    held = prefix.join(label.withColumnRenamed("node", "rep"), "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    held = stored(held.select("gram", "rep", "n", "shared", "label"), "lists")
    mixed = held.groupBy("gram").agg(F.count(F.lit(1)).alias("length"), F.min("label").alias("lo"), F.max("label").alias("hi"))
    mixed = stored(mixed.where("lo <> hi").select("gram", "length"), "mixed-lists")
    one = held.join(mixed.where(F.col("length") <= SHORT_LIST).select("gram"), "gram")
    two = one.select("gram", *[F.col(c).alias(f"{c}2") for c in ("rep", "n", "shared", "label")])
    short = one.join(two, "gram").where((F.col("rep") < F.col("rep2")) & (F.col("label") != F.col("label2"))
                                        & _may_link(F.col("n"), F.col("shared"), F.col("n2"), F.col("shared2")))
    short = short.select(F.col("rep").alias("a"), F.col("rep2").alias("b"))
    long = held.join(mixed.where(F.col("length") > SHORT_LIST), "gram").join(_profiles(ranked), "rep")
    salts = F.ceil(F.col("length") / BLOCK)
    long = long.withColumn("salt", F.pmod(F.xxhash64("rep"), salts)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), salts - 1)))
    long = long.withColumn("i", F.least("salt", "other")).withColumn("j", F.greatest("salt", "other"))
    long = long.select("gram", "i", "j", "salt", "rep", "n", "shared", "label", "profile")
    found = long.groupBy("gram", "i", "j").applyInArrow(_search_block, "a bigint, b bigint")
    return short.union(found).distinct().join(done, ["a", "b"], "left_anti")


def link_groups(ranked: DataFrame) -> DataFrame:
    """(node, label) of every class that has a link; no link is between two labels."""
    held = ranked.select("rep", "n", "shared", "central", F.explode(
        F.slice("grams", F.lit(1), (F.col("shared") - _least_shared("n") + 1).cast("int"))).alias("gram"))
    prefix = stored(held, "prefix")
    best = F.max(F.struct("central", (-F.col("rep")).alias("order"), F.col("rep").alias("rep"), "n", "shared"))
    centre = prefix.groupBy("gram").agg(best.alias("c"), F.count(F.lit(1)).alias("length")).where("length > 1")
    centre = stored(centre.select("gram", F.col("c.rep").alias("crep"), F.col("c.n").alias("cn"), F.col("c.shared").alias("cshared")), "centres")
    star = prefix.join(centre, "gram").where((F.col("rep") != F.col("crep"))
                                             & _may_link(F.col("n"), F.col("shared"), F.col("cn"), F.col("cshared")))
    star = stored(star.select(F.least("rep", "crep").alias("a"), F.greatest("rep", "crep").alias("b")).distinct(), "star-pairs")
    links = stored(verified(star, ranked), "star-links")
    label = components(links)
    rest = stored(_between_components(prefix, ranked, label, star), "cross-pairs")
    more = stored(verified(rest, ranked), "cross-links")
    return label if more.isEmpty() else components(links.union(more))


def _overlaps(group: pa.Table) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of one block pair of a group: its columns, the places of both sides, the overlaps (by fragment, summed), the
    sums of both sizes, and which pairs link (each pair of classes once)."""
    c = {k: group.column(k).to_numpy() for k in ("rep", "n", "salt", "i", "j")}
    first = np.flatnonzero(c["salt"] == c["i"][0])
    second = np.flatnonzero(c["salt"] == c["j"][0])
    lists = group.column("grams").combine_chunks()
    sizes, grams = lists.value_lengths().to_numpy(), lists.flatten().to_numpy()
    owner = np.repeat(np.arange(len(sizes)), sizes)
    order = np.argsort(grams, kind="stable")
    grams, owner = grams[order], owner[order]
    runs = np.flatnonzero(np.diff(grams, prepend=~grams[:1]))
    lengths = np.diff(runs, append=len(grams))
    several = lengths > 1                       # an n-gram of one class is in no overlap
    owner, word = owner[np.repeat(several, lengths)], np.repeat(np.arange(several.sum()), lengths[several])
    both = np.zeros((len(first), len(second)), np.int64)
    for at in range(0, int(several.sum()), FRAGMENT):
        lo, hi = np.searchsorted(word, (at, at + FRAGMENT))
        held, who = np.unique(owner[lo:hi], return_inverse=True)
        part = np.zeros((len(held), FRAGMENT), np.float32)       # counts under 2**24 are exact
        part[who, word[lo:hi] - at] = 1
        a, b = np.isin(first, held), np.isin(second, held)
        left, right = part[np.searchsorted(held, first[a])], part[np.searchsorted(held, second[b])]
        both[np.ix_(a, b)] += (left @ right.T).astype(np.int64)
    total = c["n"][first][:, None] + c["n"][second][None, :]
    linked = (100 + PERCENT) * both >= PERCENT * total
    if c["i"][0] == c["j"][0]:
        linked &= c["rep"][first][:, None] < c["rep"][second][None, :]
    return c, first, second, both, total, linked


def _link_block(group: pa.Table) -> pa.Table:
    """All linked pairs of one block pair."""
    c, first, second, both, total, linked = _overlaps(group)
    x, y = np.nonzero(linked)
    a, b = c["rep"][first[x]], c["rep"][second[y]]
    return pa.table([pa.array(v.astype(np.int64)) for v in (np.minimum(a, b), np.maximum(a, b), both[x, y], total[x, y] - both[x, y])],
                    names=["a", "b", "shared", "total"])


def _count_block(group: pa.Table) -> pa.Table:
    """Per class of one block pair with a link there: the ids of the classes that it links to."""
    c, first, second, _, _, linked = _overlaps(group)
    ids = group.column("ids").to_numpy()
    rep = np.concatenate([c["rep"][first], c["rep"][second]])
    n = np.concatenate([linked @ ids[second], ids[first] @ linked]).astype(np.int64)
    return pa.table([pa.array(rep[n > 0]), pa.array(n[n > 0])], names=["rep", "linked"])


def _block_pairs(ranked: DataFrame, groups: DataFrame, *columns: str):
    """The groups' classes in pairs of blocks, for ``applyInArrow``."""
    held = ranked.select("rep", "n", "grams", *columns).join(groups.withColumnRenamed("node", "rep"), "rep")
    held = stored(held, "groups")
    parts = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum(F.size("grams")) / BLOCK_GRAMS)).alias("parts")
    held = held.join(stored(held.groupBy("label").agg(parts), "group-parts"), "label")
    held = (held.withColumn("salt", F.pmod(F.xxhash64("rep"), F.col("parts")))
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1))))
    held = held.select("label", F.least("salt", "other").alias("i"), F.greatest("salt", "other").alias("j"), "salt", "rep", "n", "grams", *columns)
    return held.groupBy("label", "i", "j")


def all_links(ranked: DataFrame, groups: DataFrame) -> DataFrame:
    """(a, b, shared, total): every linked pair of classes, with the n-grams of both and of either."""
    return _block_pairs(ranked, groups).applyInArrow(_link_block, "a bigint, b bigint, shared bigint, total bigint")


def linked_ids(ranked: DataFrame, groups: DataFrame, sizes: DataFrame) -> DataFrame:
    """(rep, linked): per class, the ids (``sizes``: rep, ids) of all classes that it links to.  Every pair is
    compared as in ``all_links``; what leaves a block pair is a number a class, not a row a link."""
    counts = _block_pairs(ranked.join(sizes, "rep"), groups, "ids").applyInArrow(_count_block, "rep bigint, linked bigint")
    return counts.groupBy("rep").agg(F.sum("linked").alias("linked"))


def _grouped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Every row's class and component, (id, th, n_shingles, rep, component_id);
    the classes that can have a link, as ``ranked_grams``; their groups."""
    sets = stored(shingle_sets(docs, id_col, text_col), "sets")
    total = sets.agg(F.sum("n")).first()[0] or 0
    classes = (sets.where("s1 IS NOT NULL AND id IS NOT NULL").groupBy("s1", "s2")
               .agg(F.min("id").cast("bigint").alias("rep")))
    classes = stored(classes, "classes")
    alive = stored(classes.join(candidate_classes(docs, total, id_col, text_col), ["s1", "s2"]), "alive")
    grams = stored(class_grams(docs, alive, id_col, text_col).dropDuplicates(["rep"]), "class-grams")
    ranked = stored(ranked_grams(grams), "ranked")
    groups = link_groups(ranked)
    member = classes.join(groups.withColumnRenamed("node", "rep"), "rep", "left")
    member = stored(member.select(F.col("s1").alias("m1"), F.col("s2").alias("m2"), "rep", F.coalesce("label", "rep").alias("component")), "members")
    out = sets.join(member, (F.col("s1") == F.col("m1")) & (F.col("s2") == F.col("m2")), "left")
    mine = [F.when(F.col("id").isNotNull(), F.coalesce(c, "id")).alias(name) for c, name in (("rep", "rep"), ("component", "component_id"))]
    return out.select("id", "th", F.col("n").alias("n_shingles"), *mine), ranked, groups


def similarity_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Every row's class and component, (id, th, n_shingles, rep, component_id),
    and all links between classes, (a, b, shared, total) with a < b.  Rows of
    one class have equal sets."""
    rows, ranked, groups = _grouped(docs, id_col, text_col)
    return rows, stored(all_links(ranked, groups), "links")


def link_counts(docs: DataFrame, **columns) -> DataFrame:
    """(id, th, n_shingles, component_id, n_links) of every row: the other ids it links to."""
    rows, ranked, groups = _grouped(docs, **columns)
    rows = stored(rows, "class-rows")
    sizes = rows.where("rep IS NOT NULL AND n_shingles > 0").groupBy("rep").agg(F.countDistinct("id").alias("ids"))
    sizes = stored(sizes, "class-sizes")
    other = linked_ids(ranked, groups, sizes)
    counts = sizes.join(other, "rep", "left").select(F.col("rep").alias("r"), (F.col("ids") - 1 + F.coalesce("linked", F.lit(0))).alias("n"))
    out = rows.join(counts, (F.col("rep") == F.col("r")) & (F.col("n_shingles") > 0), "left")
    return out.select("id", "th", "n_shingles", "component_id", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_links"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, th, n_shingles, component_id) of every row; the links are not listed."""
    return _grouped(docs, id_col, text_col)[0].drop("rep")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents without near duplicates: of each component one row stays, of its
    smallest id and (where texts share that id) the smallest text hash.  Rows without words or without an id all stay."""
    found = stored(near_duplicates(docs), "near-duplicates")
    best = found.where("n_shingles > 0 AND id = component_id").groupBy("id", "th").agg(F.count(F.lit(1)).alias("copies"))
    best = best.groupBy("id").agg(F.min(F.struct("th", "copies")).alias("kept")).select("id", F.col("kept.th").alias("th"), F.col("kept.copies").alias("copies"))
    best = stored(best, "kept-rows")
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("th"))
    once = rows.join(best.where("copies = 1"), ["id", "th"], "left_semi").select("row")
    # Only texts that stand more than once are dealt by their row key, to leave one of them.
    again = rows.join(best.where("copies > 1"), ["id", "th"], "left_semi").dropDuplicates(["id", "th"]).select("row")
    no_words = F.col("text").isNull() | ~F.col("text").rlike(WORD_RE)
    free = docs.where(F.col("doc_id").isNull() | no_words).select(F.struct("*").alias("row"))
    return once.union(again).union(free).select(*[F.col("row")[c].alias(c) for c in docs.columns])


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_counts(table(spark, sf_dir, "documents")).select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "n_links")


ORACLE = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(ws) >= {SIZE} THEN [array_to_string(ws[i:i + {SIZE - 1}], ' ') FOR i IN range(1, len(ws) - {SIZE - 2})]
                                        WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS grams FROM d),
g AS (SELECT doc_id, len(grams) AS n, unnest(grams) AS gram FROM s),
links AS (SELECT x.doc_id AS a, y.doc_id AS b FROM g x JOIN g y ON x.gram = y.gram AND x.doc_id <> y.doc_id
          GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= {PERCENT} * (x.n + y.n - count(*))),
reach AS (SELECT doc_id AS a, doc_id AS b FROM s UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT doc_id, len(grams)::BIGINT AS n_shingles, (SELECT min(b) FROM reach WHERE a = doc_id) AS component_id,
       (SELECT count(*) FROM links WHERE a = doc_id) AS n_links FROM s
"""
