"""Packing documents into as few sequences of a fixed length as possible, by a grouping genetic algorithm.

An individual is a whole packing: which bin each piece is in.  A child takes whole well-filled bins of one parent; bins of the other
parent that hold one of the same pieces are dropped, and what else they held goes by best fit, longest first,
into the room that is left.  Documents are dealt by a hash into shards of bounded size.  Each shard lives on several
islands, tasks with a population of their own; after an epoch every island's elite, its best packing, migrates to the next island.
A shard's best packing is kept.  Full bins of it are final, but for a share drawn by a hash; all other bins are dissolved,
and their pieces are dealt anew into fewer shards, until they fit into one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfleet.llm.common import bounded_batches, hash_share, settle
from wayfleet.llm.tokens import encoder_of, read_vocabulary

CAPACITY = 1_024
END_ID = 2
SHARD_PIECES = 16_384
ISLANDS, EPOCHS = 3, 2
POPULATION, CHILDREN, GENERATIONS = 4, 4, 4
ROUNDS = 5
# Share of full bins that are dissolved too, so that later rounds have short pieces to fill with.
DISSOLVED = 0.15

Rng = np.random.Generator


def best_fit(order: list[int], lengths: list[int], bins: list[int], room: list[int], capacity: int) -> None:
    """Put each piece of ``order`` into the bin with the least room that takes it, or a new one; changes ``bins`` and ``room``."""
    held: list[list[int]] = [[] for _ in range(capacity + 1)]
    sizes = 0
    for b, r in enumerate(room):
        if r:
            held[r].append(b)
            sizes |= 1 << r
    for i in order:
        n = lengths[i]
        fitting = sizes >> n
        if fitting:
            # The lowest bit that is set says the least room of n and more.
            r = n + (fitting & -fitting).bit_length() - 1
            b = held[r].pop()
            if not held[r]:
                sizes ^= 1 << r
            r -= n
        else:
            b, r = len(room), capacity - n
            room.append(0)
        room[b], bins[i] = r, b
        if r:
            held[r].append(b)
            sizes |= 1 << r


def _refit(bins: np.ndarray, out: np.ndarray, lengths: np.ndarray, capacity: int, noise: np.ndarray | None = None) -> np.ndarray:
    """A packing with the pieces marked in ``out`` taken away and put back by best fit, longest first (``noise`` blurs the order)."""
    kept = np.flatnonzero(~out)
    _, names = np.unique(bins[kept], return_inverse=True)
    result = np.full(len(bins), -1, np.int64)
    result[kept] = names
    room = (capacity - np.bincount(names, weights=lengths[kept])).astype(np.int64).tolist() if len(kept) else []
    loose = np.flatnonzero(out)
    order = np.argsort(-(lengths[loose] if noise is None else lengths[loose] * noise[loose]), kind="stable")
    listed = result.tolist()
    best_fit(loose[order].tolist(), lengths.tolist(), listed, room, capacity)
    return np.array(listed, np.int64)


def crossed(one: np.ndarray, other: np.ndarray, lengths: np.ndarray, capacity: int, rng: Rng, share: float = 0.7) -> np.ndarray:
    """A child of two packings: a share of the well-filled bins of ``other`` whole, then those of ``one`` that hold none of their pieces."""
    fill = np.bincount(other, weights=lengths)
    well = fill >= max(np.quantile(fill, 0.5), fill.mean())
    given = (well & (rng.random(len(fill)) < share))[other]
    touched = np.zeros(one.max() + 1, bool)
    touched[one[given]] = True
    displaced = touched[one] & ~given
    return _refit(np.where(given, other, one + len(fill)), displaced, lengths, capacity)


def mutated(one: np.ndarray, lengths: np.ndarray, capacity: int, rng: Rng, share: float = 0.1) -> np.ndarray:
    """Some bins dissolved, half of those not full among them, and their pieces put back in a blurred order."""
    fill = np.bincount(one, weights=lengths)
    chosen = rng.random(len(fill)) < np.where(fill < capacity, 0.5, share)
    return _refit(one, chosen[one], lengths, capacity, 1 + 0.3 * rng.random(len(one)))


def fitness(bins: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[int, float]:
    """Less is better: the number of bins, then how little their fill is squared and averaged."""
    fill = np.bincount(bins, weights=lengths) / capacity
    return len(fill), -float(np.mean(fill**2))


def evolve(lengths: np.ndarray, capacity: int, rng: Rng, guests: list[np.ndarray], population: int, children: int, generations: int):
    """The elite of one island after some generations; ``guests`` are packings that begin in it."""
    packings = list(guests)
    for i in range(population - len(guests)):
        noise = 1 + 0.15 * (i + len(guests)) * rng.random(len(lengths))
        packings.append(_refit(np.zeros(len(lengths), np.int64), np.ones(len(lengths), bool), lengths, capacity, noise))
    ranked = sorted(((fitness(p, lengths, capacity), n, p) for n, p in enumerate(packings)), key=lambda x: x[:2])
    born = len(ranked)
    for _ in range(generations):
        for _ in range(children):
            if rng.random() < 0.7 and len(ranked) > 1:
                a, b = rng.choice(len(ranked), 2, replace=False)
                child = crossed(ranked[a][2], ranked[b][2], lengths, capacity, rng)
            else:
                child = mutated(ranked[0][2], lengths, capacity, rng)
            ranked.append((fitness(child, lengths, capacity), born, child))
            born += 1
        ranked = sorted(ranked, key=lambda x: x[:2])[:population]
        if ranked[0][0][0] * capacity - lengths.sum() < capacity:
            break  # no packing has fewer bins
    return ranked[0][2], ranked[0][0]


_ISLAND = "shard long, island int, lengths array<int>, bins array<int>, n_bins long, evenness double"


def _island(batches: Iterator[pa.RecordBatch], capacity: int, seed: int, sizes: tuple[int, int, int]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(len(batch)):
            of = {n: batch.column(n)[row] for n in batch.schema.names}
            lengths = np.asarray(of["lengths"].values, dtype=np.int64)
            guests = [np.asarray(of[n].values, dtype=np.int64) for n in ("bins", "guest") if n in of and of[n].is_valid]
            shard, island = of["shard"].as_py(), of["island"].as_py()
            rng = np.random.default_rng([seed, shard, island])
            elite, (n_bins, evenness) = evolve(lengths, capacity, rng, guests, *sizes)
            values = [[shard], [island], [lengths], [elite], [n_bins], [evenness]]
            kinds = [pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int64(), pa.float64()]
            yield pa.record_batch([pa.array(v, t) for v, t in zip(values, kinds)], ["shard", "island", "lengths", "bins", "n_bins", "evenness"])


def best_packing(
    shards: DataFrame, capacity: int = CAPACITY, seed: int = 0, islands: int = ISLANDS, epochs: int = EPOCHS, population: int = POPULATION,
    children: int = CHILDREN, generations: int = GENERATIONS,
) -> DataFrame:
    """(shard, bins) of ``shards`` (shard, lengths): the best packing found on the islands of each shard."""
    sizes = (population, children, generations)
    alone = shards.select("shard", "lengths", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island")).repartition("shard", "island")
    elites = settle(alone.mapInArrow(lambda it: _island(it, capacity, seed, sizes), _ISLAND), "elites")
    for epoch in range(1, epochs):
        # In a ring: each island is visited by the elite of the one before it.
        guests = elites.select("shard", F.pmod(F.col("island") + 1, F.lit(islands)).alias("island"), F.col("bins").alias("guest"))
        met = elites.select("shard", "island", "lengths", "bins").join(guests, ["shard", "island"])
        elites = settle(met.mapInArrow(lambda it, s=seed + 7919 * epoch: _island(it, capacity, s, sizes), _ISLAND), "elites")
    return elites.groupBy("shard").agg(F.min_by("bins", F.struct("n_bins", "evenness", "island")).alias("bins"))


def pack_lengths(
    pieces: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES, rounds: int = ROUNDS, dissolved: float = DISSOLVED, **search,
) -> DataFrame:
    """(no, sequence_id, offset) of pieces (no, length) that are not longer than ``capacity``; ``no`` differs from piece to piece.

    Pieces of full length are sequences of their own and take no part in the search.  Sequences number from 0 in each shard of each
    round; ids of full pieces are negative.  Equal input in equal order of ``no`` gives equal output.  No pieces give no rows.
    """
    whole = pieces.where(F.col("length") >= capacity).select("no", (-1 - F.col("no")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    left = pieces.where(F.col("length") < capacity).select("no", F.col("length").cast("int").alias("length"))
    done, rest = [whole], left.count()
    for number in range(rounds):
        if not rest:
            break
        shards = -(-rest // shard_pieces)
        last = shards == 1 or number == rounds - 1
        dealt = left.withColumn("shard", F.pmod(F.xxhash64("no", F.lit(number)), F.lit(shards)))
        # About shard_pieces rows a shard: the hash of a key that no two rows share.
        held = settle(dealt.groupBy("shard").agg(F.array_sort(F.collect_list(F.struct("length", "no"))).alias("rows")).select(
            "shard", F.transform("rows", lambda r: r["length"]).alias("lengths"), F.transform("rows", lambda r: r["no"]).alias("nos")), "shards")
        best = best_packing(held.select("shard", "lengths"), capacity, number, **search)
        listed = held.join(best, "shard").select("shard", F.explode(F.arrays_zip("nos", "lengths", "bins")).alias("p"))
        # Rounds, shards and bins share one number: 8, 32 and 23 bits.
        sequence = (F.lit(number << 55) + F.shiftleft("shard", 23) + F.col("p.bins")).alias("sequence_id")
        rows = listed.select(F.col("p.nos").alias("no"), F.col("p.lengths").alias("length"), sequence)
        upto = Window.partitionBy("sequence_id").orderBy(F.col("length").desc(), "no").rowsBetween(Window.unboundedPreceding, -1)
        every = Window.partitionBy("sequence_id")
        rows = rows.select("no", "length", "sequence_id", F.coalesce(F.sum("length").over(upto), F.lit(0)).cast("long").alias("offset"), F.sum("length").over(every).alias("fill"))
        final = F.lit(True) if last else (F.col("fill") == capacity) & (hash_share(F.col("sequence_id")) >= dissolved)
        rows = settle(rows.withColumn("final", final), "packed")
        done.append(rows.where("final").select("no", "sequence_id", "offset"))
        left = rows.where("not final").select("no", "length")
        rest = 0 if last else left.count()
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def _piece_batches(batches: Iterator[pa.RecordBatch], vocabulary, capacity: int, end_id: int) -> Iterator[pa.RecordBatch]:
    encode = encoder_of(vocabulary.value).ids
    rest = None
    for batch in batches:
        rest = [n for n in batch.schema.names if n != "text"]
        owners, numbers, starts, lengths, ids = [], [], [], [], []
        for row, text in enumerate(batch.column("text")):
            found = np.append(encode(text.as_py()), np.uint32(end_id)).astype("<u4")
            # All pieces but the first are of full length.
            first = (len(found) - 1) % capacity + 1
            for number, to in enumerate(range(first, len(found) + 1, capacity)):
                at = max(0, to - capacity) if number else 0
                owners.append(row)
                numbers.append(number)
                starts.append(at)
                lengths.append(to - at)
                ids.append(found[at:to].tobytes())
        of = pa.array(owners, pa.int64())
        yield pa.record_batch(
            [*[batch.column(n).take(of) for n in rest], pa.array(numbers, pa.int32()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(ids, pa.binary())],
            [*rest, "piece", "start", "length", "ids"])


def pieces(documents: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, row, piece, start, length, ids): every text's token ids and ``end_id``, cut only if they are more than ``capacity``.

    ``ids`` are little-endian unsigned 32-bit numbers.  The first piece of a cut document takes what is over, so all
    others are of full length.  Null and empty texts are the end id alone.  ``row`` numbers the rows of the input.
    """
    spark = documents.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(read_vocabulary(vocabulary))
    keyed = documents.select("doc_id", F.monotonically_increasing_id().alias("row"), "text")
    layout = f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, row long, piece int, start long, length long, ids binary"
    return keyed.mapInArrow(lambda it: _piece_batches(it, shared, capacity, end_id), layout)


def pack(
    documents: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
    content: Callable[[Column], Column] | None = None, **options,
) -> DataFrame:
    """(doc_id, piece, start, length, ids, sequence_id, offset) of every piece of every document.

    ``content`` replaces the ids by something worked out from them, a digest say, before anything is shuffled.  Null
    and empty texts are one piece of one id; equal rows and equal ids are packed each on its own; null ids stay null.  A text of any length
    is cut into pieces; one task holds it and its ids whole.  An empty table gives an empty result.  Other columns are ignored.
    """
    found = pieces(documents, vocabulary, capacity, end_id)
    if content is not None:
        found = found.withColumn("ids", content(F.col("ids")))
    # Only a document's first piece can be shorter than a sequence, so its row names it.
    found = settle(found.withColumn("open", F.col("length") < capacity), "pieces", "zstd")
    placed = pack_lengths(found.where("open").select(F.col("row").alias("no"), "length"), capacity, **options)
    shared = found.where("open").join(placed.withColumnRenamed("no", "row"), "row")
    # A full piece is a sequence of its own; its id is below zero.
    single = found.where("not open").withColumn("offset", F.lit(0).cast("long")).withColumn("sequence_id", -1 - F.monotonically_increasing_id())
    columns = ["doc_id", "piece", "start", "length", "ids", "sequence_id", "offset"]
    return shared.select(*columns).unionByName(single.select(*columns))


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids) of ``pack``'s rows: the token ids of each sequence, its pieces in their places."""
    held = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("of"), F.sum("length").alias("length"))
    return held.select("sequence_id", "length", F.aggregate("of", F.lit(b""), lambda all_, p: F.concat(all_, p["ids"])).alias("ids"))
