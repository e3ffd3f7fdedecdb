"""Packing token sequences by a grouping genetic algorithm on islands.

Documents become pieces of at most ``capacity`` tokens. Full pieces fill a sequence alone; the others are dealt to regions
of a bounded number of pieces, and each region is packed by several islands. An individual is a set of bins. Crossover
takes whole well-filled bins from one parent into the other, removes the bins that held the same pieces, and puts the
displaced pieces back where they fit best. After each epoch, every island sends its elite to the next one of its region;
the best individual of all islands is the region's packing.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import parts_for, stored
from .token_ids import text_encoder

CAPACITY, REGION = 1024, 2000
ISLANDS, EPOCHS, POPULATION, GENERATIONS = 2, 2, 4, 4


def piece_lengths(n: int, capacity: int) -> list[int]:
    """Only what is longer than ``capacity`` is cut; the first piece takes the remainder."""
    if n <= capacity:
        return [n]
    first = n % capacity
    return ([first] if first else []) + [capacity] * (n // capacity)


def token_pieces(docs: DataFrame, tokenizer: str, *, text: str = "text", doc_id: str = "doc_id", end_id: int = 2,
                 capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32. A null text is empty and gives one piece: its end id."""
    end = end_id.to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = text_encoder(tokenizer)
        for batch in batches:
            out: list[tuple] = []
            for d, t in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids, start = memoryview(encode(t.as_py()) + end), 0
                for k, n in enumerate(piece_lengths(len(ids) // 4, capacity)):
                    out.append((d, k, start, n, zlib.crc32(ids[4 * start:4 * (start + n)])))
                    start += n
            if out:
                types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)],
                                                 ["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


class Packer:
    """The bins of one region's pieces: an individual is the bin number of each piece."""

    def __init__(self, sizes: np.ndarray, capacity: int, seed: int):
        self.sizes, self.capacity, self.random = sizes.astype(np.int64), capacity, np.random.default_rng(seed)

    def best_fit(self, bins: np.ndarray, order: np.ndarray) -> np.ndarray:
        """Puts the pieces of ``order`` each into the fullest bin with room for it, or a new one; -1 is no bin yet."""
        placed = bins >= 0
        fills = np.bincount(bins[placed], self.sizes[placed], int(bins.max(initial=-1)) + 1).astype(np.int64)
        fresh = len(fills)
        open_bins = sorted((self.capacity - f, b) for b, f in enumerate(fills.tolist()) if 0 < f < self.capacity)
        for piece, size in zip(order.tolist(), self.sizes[order].tolist(), strict=True):
            at = bisect_left(open_bins, (size, -1))
            if at < len(open_bins):
                room, b = open_bins.pop(at)
            else:
                room, b = self.capacity, fresh
                fresh += 1
            bins[piece] = b
            if room > size:
                insort(open_bins, (room - size, b))
        return bins

    def fresh(self, noise: float) -> np.ndarray:
        order = np.argsort(-(self.sizes + self.random.normal(0, 1, len(self.sizes)) * noise), kind="stable")
        return self.best_fit(np.full(len(self.sizes), -1, np.int64), order)

    def cost(self, bins: np.ndarray) -> tuple[int, float]:
        """Fewer bins first, then fuller bins (the mean of squared fills)."""
        fills = np.bincount(bins, self.sizes)
        fills = fills[fills > 0] / self.capacity
        return len(fills), -float((fills ** 2).sum())

    def cross(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        fills = np.bincount(two, self.sizes)
        full = np.argsort(-fills + self.random.random(len(fills)) * self.capacity / 64)
        taken = full[:max(1, int(len(full) * self.random.uniform(0.1, 0.5)))]
        chosen = np.zeros(len(fills), bool)
        chosen[taken[fills[taken] > 0]] = True
        injected = chosen[two]
        hit = np.zeros(int(one.max()) + 1, bool)
        hit[one[injected]] = True
        # the least filled bins go too, so that their pieces can be placed better
        rest = np.bincount(one, self.sizes)
        weak = np.flatnonzero((rest > 0) & (rest < np.quantile(rest[rest > 0], 0.05)))
        hit[weak] = True
        child = np.where(injected, two + len(hit), one)
        displaced = np.flatnonzero(~injected & hit[one])
        child[displaced] = -1
        child[child >= 0] = np.unique(child[child >= 0], return_inverse=True)[1]
        return self.best_fit(child, displaced[np.argsort(-self.sizes[displaced], kind="stable")])

    def evolve(self, population: list[np.ndarray], size: int, generations: int) -> list[np.ndarray]:
        """The population after some generations, best first; with nothing to gain (all bins needed) it ends at once."""
        least = -(-int(self.sizes.sum()) // self.capacity)
        while len(population) < size:
            population.append(self.fresh(0 if not population else self.capacity / 64))
        population.sort(key=self.cost)
        for _ in range(generations):
            if self.cost(population[0])[0] <= least:
                break
            one, two = self.random.choice(len(population), 2, replace=False)
            children = [self.cross(population[one], population[two]), self.cross(population[two], population[one])]
            population = sorted([*population, *children], key=self.cost)[:size]
        return population


def pack_pieces(pieces: DataFrame, *, capacity: int = CAPACITY, region: int = REGION, islands: int = ISLANDS,
                epochs: int = EPOCHS, population: int = POPULATION, generations: int = GENERATIONS) -> DataFrame:
    """``pieces`` (with a ``length`` of 1 to ``capacity``) with sequence_id and offset, gapless from 0 in each sequence.

    Rows may repeat in any column: each is a piece of its own. Pieces are dealt to regions at random, ``region`` to each on
    average, so no task holds more however many pieces there are. Other columns are carried along; an empty table gives
    an empty result.
    """
    columns = pieces.columns
    rows = stored(pieces.select(F.struct("*").alias("row"), F.col("length").cast("int").alias("size"),
                                F.monotonically_increasing_id().alias("place")), "pieces")
    full = rows.where(F.col("size") == capacity).select(
        "row", (-1 - F.col("place")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    part = rows.where(F.col("size") < capacity)
    n_regions = parts_for(part.count(), region)
    part = part.withColumn("region", F.pmod(F.xxhash64("place"), F.lit(n_regions)))

    state_type = "region long, island int, places array<long>, sizes array<int>, bins array<array<int>>"

    def evolve(epoch: int):
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                out = []
                for r in frame.itertuples():
                    packer = Packer(np.asarray(r.sizes), capacity, (r.region * 1009 + r.island * 31 + epoch) & 0x7FFFFFFF)
                    known = [np.asarray(b, np.int64) for b in (*r.bins, *r.guests)]
                    best = packer.evolve(known, population, generations)
                    out.append((r.region, r.island, r.places, r.sizes, [b.astype(np.int32) for b in best[:population]]))
                yield pd.DataFrame(out, columns=["region", "island", "places", "sizes", "bins"])
        return run

    none = F.array().cast("array<array<int>>")
    state = (part.groupBy("region").agg(F.array_sort(F.collect_list(F.struct("place", "size"))).alias("all"))
             .select("region", F.col("all.place").alias("places"), F.col("all.size").alias("sizes"),
                     F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"))
             .withColumn("bins", none).withColumn("guests", none).repartition("region", "island"))
    state = stored(state.mapInPandas(evolve(0), state_type), "islands-0")
    for epoch in range(1, epochs):
        elite = state.select("region", F.pmod(F.col("island") + 1, F.lit(islands)).alias("island"),
                             F.slice("bins", 1, 1).alias("guests"))
        state = state.join(elite, ["region", "island"]).repartition("region", "island")
        state = stored(state.mapInPandas(evolve(epoch), state_type), f"islands-{epoch}")

    def finish(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for r in frame.itertuples():
                packer = Packer(np.asarray(r.sizes), capacity, 0)
                bins = min((np.asarray(x[0], np.int64) for x in r.found), key=packer.cost)
                order = np.argsort(bins, kind="stable")
                ends = np.cumsum(packer.sizes[order])
                before = ends - packer.sizes[order]
                first = np.r_[True, np.diff(bins[order]) != 0]
                offset = before - np.maximum.accumulate(np.where(first, before, 0))
                yield pd.DataFrame({"place": np.asarray(r.places)[order], "sequence_id": r.region * (1 << 20) + bins[order],
                                    "offset": offset})

    best = state.groupBy("region").agg(F.first("places").alias("places"), F.first("sizes").alias("sizes"),
                                       F.collect_list(F.slice("bins", 1, 1)).alias("found"))
    placed = best.mapInPandas(finish, "place long, sequence_id long, offset long")
    packed = part.join(placed, "place").select("row", "sequence_id", "offset")
    return full.unionByName(packed).select(*[F.col("row")[c].alias(c) for c in columns], "sequence_id", "offset")


def pack_documents(docs: DataFrame, tokenizer: str, *, text: str = "text", doc_id: str = "doc_id", end_id: int = 2,
                   capacity: int = CAPACITY, **options) -> DataFrame:
    pieces = token_pieces(docs, tokenizer, text=text, doc_id=doc_id, end_id=end_id, capacity=capacity)
    return pack_pieces(pieces, capacity=capacity, **options)
