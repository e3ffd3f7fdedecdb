"""Similarity join on word shingles (Jaccard) by chosen paths.

In every run, a document's shingle set chooses tokens: those whose hash for the run lies below ``1 / (similarity * size)``,
about 1.25 tokens. Documents that chose the same token of the same run meet in a bucket. Similar sets choose the same
tokens; a passage that many documents share is chosen by few of them, as its tokens are few among theirs. Runs are repeated
until a pair at the threshold is missed with a probability below ``1 - recall``. Small buckets are compared pair by pair;
pairs that meet too seldom over all runs to be similar are left out before their sets are looked at. Large buckets are split
by further tokens chosen along the path, again and again while that parts their members; of large buckets that hold about the
same members, as copies that differ little make one for each token, one is tried first. Leaves that hold about the same
members become one, and what is left is compared in blocks inside tasks, which add up links and return one row per member, not pairs. Blocks are bounded by members and by the
bytes of their sets. Every pair's similarity is computed on the whole sets.

Documents with equal sets are one representative throughout, however many copies there are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import of_worker, stored

SHINGLE, SIMILARITY, RECALL = 5, 0.8, 0.9999
#: Members of a bucket that is compared pair by pair (a set is sent once a pair there, but some times a member in larger
#: ones); meetings a similar pair has at least.
SMALL, MEETINGS = 8, 6
#: Members, and bytes of their sets, of a block in larger ones; a comparison holds two blocks.
BLOCK, BLOCK_BYTES = 768, 4_000_000
#: Tokens chosen a step, for one at the first two, where buckets above a block are split on; steps at most; the share of a
#: bucket's pairs that a step must leave behind.
MORE, STEPS, GAIN = 3, 6, 0.5
#: Representatives that are sent to every task to fetch their sets (8 bytes each); with more, a join fetches them.
SENT = 500_000
CHUNK = 4_000_000

_POWERS = np.cumprod(np.full(64, 0x9E3779B97F4A7C15, np.uint64))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingles(texts: list[str | None], size: int = SHINGLE) -> list[np.ndarray]:
    """Each text's sorted distinct 64-bit hashes of runs of ``size`` words (A-Z in lower case, split at ASCII white space).

    A text with fewer words is one shingle; one without words, or null, has none.
    """
    hashes = of_worker("shingles", "hashes", _Hashes)
    if len(hashes) > 200_000:
        hashes.clear()
    words = [(t or "").encode("utf-8", "replace").lower().split() for t in texts]
    out = []
    for own in words:
        codes = np.fromiter(map(hashes.__getitem__, own), np.uint64, len(own))
        if len(codes) >= size:
            n = len(codes) - size + 1
            total = np.zeros(n, np.uint64)
            for k in range(size):
                total += codes[k:k + n] * _POWERS[k]
            out.append(np.unique(_mix(total)))
        elif len(codes):
            out.append(_mix(np.array([(codes * _POWERS[:len(codes)]).sum() + np.uint64(len(codes))], np.uint64)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def runs_for(similarity: float, recall: float) -> int:
    """Runs after which a pair at the threshold has met with probability ``recall``, also when its bucket is split once more."""
    once = 1 - math.exp(-1)  # at least one of the chosen tokens is shared: one is expected at the threshold
    twice = 1 - math.exp(-once)
    return math.ceil(math.log(1 - recall) / math.log(1 - twice)) + MEETINGS


def _limit(n: int, similarity: float) -> np.uint64:
    return np.uint64(min((1 << 64) - 1, int((1 << 64) / (similarity * n))))


def _table(docs: DataFrame, text: str, doc_id: str, size: int, similarity: float, runs: int) -> DataFrame:
    """Per document: place, doc_id, row_key, rep (hash of the set), n, keys (chosen tokens), set (sorted 32-bit hashes)."""
    seeds = _mix(np.arange(1, 3 * runs + 1, dtype=np.uint64))
    factors, shifts, marks = seeds[:runs] | np.uint64(1), seeds[runs:2 * runs], seeds[2 * runs:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, at = batch.column("text"), 0
            while at < len(texts):
                some, bytes_ = [], 0
                while at + len(some) < len(texts) and bytes_ < CHUNK:
                    some.append(texts[at + len(some)].as_py())
                    bytes_ += len(some[-1] or "")
                reps, counts, keys, sets = [], [], [], []
                for h in shingles(some, size):
                    short = np.unique((h >> np.uint64(32)).astype("<u4"))
                    if len(h):
                        chosen = (h * factors[:, None] + shifts[:, None]) <= _limit(len(short), similarity)
                        turn, place = chosen.nonzero()
                        keys.append(_mix(h[place] ^ marks[turn]).view(np.int64))
                    else:
                        keys.append(np.empty(0, np.int64))
                    reps.append(xxhash.xxh3_64_intdigest(h.tobytes()) - (1 << 63))
                    counts.append(len(short))
                    sets.append(short.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c).slice(at, len(some)) for c in ("place", "doc_id", "row_key")], pa.array(reps, pa.int64()),
                     pa.array(counts, pa.int64()), pa.array(keys, pa.list_(pa.int64())), pa.array(sets, pa.binary())],
                    ["place", "doc_id", "row_key", "rep", "n", "keys", "set"])
                at += len(some)

    rows = docs.select(F.monotonically_increasing_id().alias("place"), F.col(doc_id).cast("long").alias("doc_id"),
                       row_key(F.col(doc_id), F.col(text)).alias("row_key"), F.col(text).alias("text"))
    return stored(rows.mapInArrow(run, "place long, doc_id long, row_key long, rep long, n long, keys array<long>, set binary"),
                  "shingles")


def row_key(doc_id, text):
    """What rows with the same identifier and text share."""
    return F.xxhash64(doc_id, F.coalesce(text, F.lit("")))


def _compare(similarity: float):
    """Links inside one block pair of a large bucket: per member the copies it is linked to, and a component's first member."""
    def run(group: pa.Table) -> pa.Table:
        rows = group.sort_by("rep").to_pydict()
        n, copies = np.array(rows["n"]), np.array(rows["copies"], float)
        # |a and b| >= s * |a or b|, in integers as far as possible
        counted = _common([np.frombuffer(s, "<u4") for s in rows.pop("set")]) * (1 + similarity) >= (
            similarity * (n[:, None] + n[None, :]) - 1e-6)
        np.fill_diagonal(counted, False)
        side = np.array(rows["side"])
        if rows["i"][0] != rows["j"][0]:
            counted &= side[:, None] != side[None, :]
        # a pair counts where it is the first of the buckets that both are in, unless the small buckets have counted it
        counted &= _common([np.array(x, np.int64) for x in rows.pop("small")]) < MEETINGS
        here = rows["key"][0]
        counted &= _common([(x := np.array(y, np.int64))[x < here] for y in rows.pop("leaves")]) == 0
        root = np.arange(len(n), dtype=np.int32)
        while True:
            near = np.where(counted, root[None, :], np.int32(len(n))).min(1)
            new = np.minimum(root, near)
            new = new[new]
            if (new == root).all():
                break
            root = new
        one, other = np.nonzero(counted)  # every link counts in one place, which also joins its ends
        links = np.bincount(one, copies[other], len(n)).round().astype(np.int64)
        some, reps = np.unique(one), np.array(rows["rep"], np.int64)
        return pa.table({"rep": reps[some], "links": links[some], "root": reps[root[some]]})
    return run


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """How many elements each two sets share, by products of incidence matrices; elements of one set only are left out."""
    n = len(sets)
    out = np.zeros((n, n), np.float32)
    lengths = [len(s) for s in sets]
    if not sum(lengths):
        return out
    values, place = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(n), lengths)
    often = np.bincount(place, minlength=len(values)) > 1
    column = np.cumsum(often) - 1
    use = often[place]
    place, owner = column[place[use]], owner[use]
    order = np.argsort(place, kind="stable")
    place, owner = place[order], owner[order]
    width = 2048
    for start in range(0, int(often.sum()), width):
        lo, hi = np.searchsorted(place, [start, start + width])
        part = np.zeros((n, width), np.float32)
        part[owner[lo:hi], place[lo:hi] - start] = 1
        out += part @ part.T
    return out


def _pair_links(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
                x, y = np.frombuffer(a.as_buffer(), "<u4"), np.frombuffer(b.as_buffer(), "<u4")
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both * (1 + similarity) >= similarity * (len(x) + len(y)) - 1e-6)
            yield batch.select(["a", "b", "copies_a", "copies_b"]).filter(pa.array(keep, pa.bool_()))
    return run


def _next_paths(similarity: float):
    """Next tokens along the paths of members of large buckets: rows (rep, key, parent)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            reps, keys, parents = [], [], []
            for rep, data, paths in zip(batch.column("rep").to_pylist(), batch.column("set"), batch.column("large"), strict=True):
                tokens = np.frombuffer(data.as_buffer(), "<u4").astype(np.uint64)
                path = paths.values.to_numpy(zero_copy_only=False).view(np.uint64)
                for some in np.array_split(path, -(-len(path) * len(tokens) // CHUNK) or 1):
                    chosen = _mix(tokens ^ _mix(some)[:, None]) <= _limit(len(tokens), similarity)
                    at, place = chosen.nonzero()
                    keys.append(_mix(_mix(some[at] + np.uint64(1)) ^ tokens[place]).view(np.int64))
                    parents.append(some[at].view(np.int64))
                    reps.append(np.full(len(at), rep))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.empty(0, np.int64), *x])) for x in (reps, keys, parents)],
                                             ["rep", "key", "parent"])
    return run


def _split(found: DataFrame, similarity: float) -> DataFrame:
    return stored(found.select("rep", "large", "set").mapInArrow(_next_paths(similarity), "rep long, key long, parent long"), "paths")


def _with_sets(members: DataFrame, paths: DataFrame) -> DataFrame:
    return _only(members.select("rep", "set"), paths).join(paths.groupBy("rep").agg(F.collect_list("key").alias("large")), "rep")


def _gains(before: DataFrame, paths: DataFrame) -> DataFrame:
    """The keys (of) among ``before`` (rep, key, in_leaf) whose ``paths`` leave behind ``GAIN`` of their pairs."""
    before = before.select(F.col("key").alias("of"), "in_leaf").distinct()
    after = (paths.groupBy("parent", "key").agg(F.count(F.lit(1)).cast("double").alias("n"))
             .groupBy("parent").agg(F.sum(F.col("n") * F.col("n")).alias("pairs")))
    return stored(before.join(after, F.col("of") == F.col("parent"))
                  .where(F.col("pairs") <= (1 - GAIN) * F.col("in_leaf").cast("double") * F.col("in_leaf")).select("of"), "gains")


def _whole(sets: DataFrame, large: DataFrame, similarity: float) -> DataFrame | None:
    """Those of the large buckets (rep, key, in_leaf) above a block that are not split, if there are any.

    Copies that differ little are a bucket for each token that they chose, some 25 in all runs. Of buckets with the same
    smallest member that would make fewer comparisons as one, the one with the smallest key is split on trial. If that does
    not part its members, all stay whole: then nobody is parted, and a member is sent once and not once a bucket and token.
    """
    above = large.where(F.col("in_leaf") > BLOCK)
    if above.isEmpty():
        return None
    low = above.groupBy(F.col("key").alias("at")).agg(F.min("rep").alias("low"))
    named = stored(above.join(low, F.col("key") == F.col("at")).drop("at"), "named-buckets")
    squares = named.groupBy("low").agg(F.sum(F.col("in_leaf").cast("double")).alias("squares"), F.min("key").alias("one"),
                                       F.max("key").alias("other"), F.countDistinct("rep").cast("double").alias("in_all"))
    alike = squares.where((F.col("one") != F.col("other")) & (F.col("in_all") * F.col("in_all") <= F.col("squares")))
    alike = stored(named.join(alike.select("low", "one"), "low").drop("low"), "alike")
    tried = alike.where("key = one")
    if tried.isEmpty():
        return None
    gains = _gains(tried, _split(_with_sets(sets, tried), similarity / MORE))
    return stored(alike.join(gains, F.col("one") == F.col("of"), "left_anti").drop("one"), "whole")


def _leaves(members: DataFrame, similarity: float) -> DataFrame:
    """The buckets in which members of large buckets are compared: rows (rep, key, in_leaf).

    Large buckets are split by a second token. What is still larger than a block is split on, with ``MORE`` tokens chosen at
    a time, so that hardly any similar pair is parted, for as long as that leaves behind ``GAIN`` of a bucket's pairs. Copies
    that differ little share their tokens and stay together; they are compared in blocks.
    """
    def sizes(paths: DataFrame) -> DataFrame:
        return paths.groupBy(F.col("key").alias("at")).agg(F.count(F.lit(1)).alias("in_leaf"))

    paths = _split(members, similarity)
    leaves = paths.join(sizes(paths).where("in_leaf > 1"), F.col("key") == F.col("at")).select("rep", "key", "in_leaf")
    leaves = stored(leaves, "leaves")
    done, open_ = leaves.where(F.col("in_leaf") <= BLOCK), leaves.where(F.col("in_leaf") > BLOCK)
    for _ in range(2, STEPS):
        if open_.isEmpty():
            break
        paths = _split(_with_sets(members, open_), similarity / MORE)
        gains = _gains(open_, paths)
        whole = open_.join(gains, F.col("key") == F.col("of"), "left_anti")
        parted = paths.join(gains, F.col("parent") == F.col("of"), "left_semi")
        split_on = parted.join(sizes(parted).where("in_leaf > 1"), F.col("key") == F.col("at")).select("rep", "key", "in_leaf")
        split_on = stored(split_on, "children")
        done = done.unionByName(whole).unionByName(split_on.where(F.col("in_leaf") <= BLOCK))
        open_ = split_on.where(F.col("in_leaf") > BLOCK)
    return stored(done.unionByName(open_), "leaves")


def _only(members: DataFrame, some: DataFrame) -> DataFrame:
    """``members`` without those that ``some`` does not name, before their sets are sent, where names fit ``SENT``; else all."""
    names = some.select(F.col("rep").alias("of")).distinct()
    if names.limit(SENT + 1).count() > SENT:
        return members
    return members.join(F.broadcast(names), F.col("rep") == F.col("of"), "left_semi")


def _united(leaves: DataFrame) -> DataFrame:
    """``leaves`` (rep, key, in_leaf) with those that hold about the same members made one.

    Near copies share most tokens, so that one group of them is a leaf for each token. Leaves with the same smallest member
    become one leaf of all their members where that takes no more comparisons than theirs together (squares of members);
    then it sends no more sets either. Whoever shared a leaf shares one afterwards. It is done by two orders of the members.
    """
    for turn, order in enumerate((F.col("rep"), F.xxhash64("rep"))):
        low = leaves.groupBy(F.col("key").alias("at")).agg(F.min(order).alias("low"))
        named = stored(leaves.join(low, F.col("key") == F.col("at")).select("rep", "key", "in_leaf", "low"), "named-leaves")
        squares = named.groupBy("low").agg(F.sum(F.col("in_leaf").cast("double")).alias("squares"),
                                           F.min("key").alias("one"), F.max("key").alias("other"))
        together = named.groupBy("low", "rep").agg(F.lit(1).alias("here"))
        gains = (together.groupBy("low").agg(F.count(F.lit(1)).alias("in_all")).join(squares, "low")
                 .where((F.col("one") != F.col("other")) & (F.col("in_all").cast("double") * F.col("in_all") <= F.col("squares")))
                 .select(F.col("low").alias("of"), "in_all"))
        gains = stored(gains, "gains")
        united = together.join(gains, F.col("low") == F.col("of")).select(
            "rep", F.xxhash64(F.lit(turn), "low").alias("key"), F.col("in_all").alias("in_leaf"))
        apart = named.join(gains, F.col("low") == F.col("of"), "left_anti").select("rep", "key", "in_leaf")
        leaves = stored(united.unionByName(apart), "leaves")
    return leaves


def components(edges: DataFrame) -> DataFrame:
    """(rep, root) of all ends of ``edges`` (a, b), by alternating large-star and small-star rounds kept in the shared folder."""
    def star(pairs: DataFrame, large: bool) -> DataFrame:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        if not large:
            both = both.where("b < a")
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low")).withColumnRenamed("a", "at")
        joined = both.join(low, F.col("a") == F.col("at"))
        if large:
            found = joined.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        else:
            found = joined.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(
                low.select(F.col("at").alias("a"), F.col("low").alias("b")))
        return found.where("a <> b").distinct()

    def state(pairs: DataFrame):
        return pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    edges = stored(edges.where("a <> b").distinct(), "links")
    before = state(edges)
    while True:
        edges = stored(star(star(edges, True), False), "links")
        after = state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("a").alias("rep"), F.col("b").alias("root"))
    return roots.unionByName(edges.select(F.col("b").alias("rep"), F.col("b").alias("root")).distinct())


def near_classes(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", size: int = SHINGLE,
                 similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """One row per document: doc_id, row_key, class_id, n_links, first.

    Two documents are linked if their shingle sets have a Jaccard similarity of ``similarity`` or more. ``class_id`` is the
    smallest identifier among those reachable by links, ``n_links`` the number of other documents linked to this one (copies
    counted each), ``first`` true for one row of each class: the one with the smallest identifier (null last). Documents
    without words, null texts among them, have equal (empty) sets and are copies of each other. Rows may repeat: each is a
    document. Sets are compared by 32 bits of their shingles' hashes. An empty table gives an empty result.
    """
    rows = _table(docs, text, doc_id, size, similarity, runs_for(similarity, recall))
    reps = stored(rows.groupBy("rep").agg(F.first("n").alias("n"), F.first("keys").alias("keys"),
                                          F.min("place").alias("carrier"), F.count(F.lit(1)).alias("copies")), "representatives")
    chosen = reps.select("rep", "n", F.explode("keys").alias("key"))
    met = chosen.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    buckets = stored(chosen.join(met, "key"), "buckets")

    small = (buckets.where(F.col("members") <= SMALL).groupBy("key")
             .agg(F.array_sort(F.collect_list(F.struct("rep", "n"))).alias("m")))
    pair = F.explode(F.flatten(F.transform("m", lambda x, i: F.transform(
        F.filter(F.slice("m", i + 2, F.size("m")), lambda y: F.least(x["n"], y["n"]) >= similarity * F.greatest(x["n"], y["n"])),
        lambda y: F.struct(x["rep"].alias("a"), y["rep"].alias("b"))))))
    hits = (small.select(pair.alias("p")).groupBy("p.a", "p.b").agg(F.count(F.lit(1)).alias("hits"))
            .where(F.col("hits") >= MEETINGS).select("a", "b"))
    hits = stored(hits, "pairs")
    is_small = F.col("members") <= SMALL
    crowded = stored(buckets.groupBy("rep").agg(F.collect_list(F.when(is_small, F.col("key"))).alias("small"),
                                                F.collect_list(F.when(~is_small, F.col("key"))).alias("large"))
                     .where(F.size("large") > 0), "crowded")

    wanted = (hits.select(F.col("a").alias("rep"), F.lit(1).alias("paired")).union(hits.select("b", F.lit(1)))
              .union(crowded.select("rep", F.lit(0))).groupBy("rep").agg(F.max("paired").alias("paired"))
              .join(reps.select("rep", "carrier", "copies"), "rep"))
    wanted = stored(wanted.select(F.col("rep").alias("of"), "carrier", "copies", "paired"), "wanted")
    few = wanted.count() <= SENT
    sets = stored(rows.select("place", "rep", "n", "set").join(F.broadcast(wanted) if few else wanted,
                                                              F.col("place") == F.col("carrier"))
                  .select("rep", "n", "set", "copies", "paired"), "sets")

    def side(name: str) -> DataFrame:
        return sets.where("paired = 1").select(F.col("rep").alias(name), F.col("set").alias(f"set_{name}"), F.col("copies").alias(f"copies_{name}"))

    linked = stored(hits.join(side("a"), "a").join(side("b"), "b").select("a", "b", "copies_a", "copies_b", "set_a", "set_b")
                    .mapInArrow(_pair_links(similarity), "a long, b long, copies_a long, copies_b long"), "similar")

    large = buckets.where(~is_small).select("rep", "key", F.col("members").alias("in_leaf"))
    kept = _whole(sets, large, similarity)
    if kept is not None:
        split_on = (large.join(kept.select(F.col("key").alias("of")).distinct(), F.col("key") == F.col("of"), "left_anti")
                    .groupBy("rep").agg(F.collect_list("key").alias("large")))
        crowded = crowded.drop("large").join(split_on, "rep", "left").withColumn(
            "large", F.coalesce("large", F.array().cast("array<long>")))
    members = stored(crowded.join(sets.drop("paired"), "rep"), "members")
    leaves = _leaves(members, similarity)
    leaves = _united(leaves if kept is None else leaves.unionByName(kept))
    whole = _only(members, leaves).join(leaves.groupBy("rep").agg(F.collect_list("key").alias("leaves")), "rep").select(
        F.col("rep").alias("of"), "n", "set", "copies", "small", "leaves")
    about = (leaves.join(members.select(F.col("rep").alias("of"), F.octet_length("set").alias("bytes")), F.col("rep") == F.col("of"))
             .groupBy(F.col("key").alias("at")).agg(F.sum("bytes").alias("bytes")))
    blocks = F.ceil(F.greatest(F.col("in_leaf") / BLOCK, F.col("bytes") / BLOCK_BYTES))
    spread = (leaves.join(about, F.col("key") == F.col("at")).withColumn("blocks", blocks).drop("at", "bytes", "in_leaf")
              .withColumn("side", F.pmod(F.xxhash64("rep"), F.col("blocks")))
              .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
              .withColumn("i", F.least("side", "other")).withColumn("j", F.greatest("side", "other")).drop("other", "blocks"))
    spread = spread.join(whole, F.col("rep") == F.col("of")).drop("of")
    inside = stored(spread.groupBy("key", "i", "j").applyInArrow(_compare(similarity), "rep long, links long, root long"), "inside")

    links = (linked.select(F.col("a").alias("rep"), F.col("copies_b").alias("links"))
             .unionByName(linked.select(F.col("b").alias("rep"), F.col("copies_a").alias("links")))
             .unionByName(inside.select("rep", "links")).groupBy("rep").agg(F.sum("links").alias("links")))
    roots = components(linked.select("a", "b").unionByName(inside.select(F.col("rep").alias("a"), F.col("root").alias("b"))))
    about = (reps.select("rep", "copies").join(links, "rep", "left").join(roots, "rep", "left")
             .select(F.col("rep").alias("of"), F.coalesce("root", "rep").alias("root"),
                     (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    placed = stored(rows.select("place", "doc_id", "row_key", "rep").join(about, F.col("rep") == F.col("of"))
                    .select("place", "doc_id", "row_key", "root", "n_links"), "placed")
    top = placed.groupBy(F.col("root").alias("class")).agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "place")).alias("least"))
    return placed.join(top, F.col("root") == F.col("class")).select(
        "doc_id", "row_key", F.col("least.doc_id").alias("class_id"), F.col("n_links").cast("long").alias("n_links"),
        (F.col("place") == F.col("least.place")).alias("first"))


def one_per_class(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """``docs`` with all columns; of each class, one row stays: one with the smallest identifier (null last)."""
    first = (near_classes(docs, text=text, doc_id=doc_id, **options).where("first").select(F.col("row_key").alias("key"))
             .distinct())
    rows = docs.select(F.struct("*").alias("row"), row_key(F.col(doc_id), F.col(text)).alias("row_key"))
    turn = F.row_number().over(Window.partitionBy("row_key").orderBy(F.lit(1)))  # identical rows
    return rows.join(first, F.col("row_key") == F.col("key")).withColumn("turn", turn).where("turn = 1").select("row.*")
