"""SimHash near-duplicates: a Gray-ordered hierarchical index over distributed fingerprints.

Fingerprints that differ in few bits must agree on some choice of blocks of bits.  For each
such choice (a mask) the fingerprints with the same masked pattern form an upper node of the index; one row per
fingerprint and mask is range-sorted by (mask, pattern, Gray rank).  Within a node, neighbours in Gray order share most
bits: runs of 16 are factored into a node that keeps the bits all of them have, runs of
these into further nodes.  A search goes down pairs of nodes and drops a pair as soon as the fixed bits in which the two differ
exceed the radius, so whole groups are pruned.

A node that is long, or that the range sort cuts, is dealt out in chunks; pairs of chunks that survive the same
pruning are compared as rows of their own.  No node is ever held whole by a task, and every node
is searched in full.  From each piece only a spanning forest is passed on, not all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfleet.llm.common import bounded_batches, flat, mixed, row_digest, settle, steps
from wayfleet.llm.components import connected
from wayfleet.llm.words import LOWER, WHITE, find_words, hash_grams, hash_words, whole_grams

SHINGLE = 4
RADIUS = 4
SEED = 42
# Six blocks, four differences: two blocks at least agree.  For billions of fingerprints more blocks (8, of which 4 agree) keep nodes small.
BLOCKS = 6
FAN_OUT = 16
CHUNK = 2048
SMALL = 32


def _shingle_hashes(text: bytes, begins: list[int], ends: list[int], shingle: int) -> list[int]:
    h = xxhash.xxh64_intdigest
    n = len(begins)
    if n == 0:
        return []
    if n < shingle:
        return [h(text[begins[0] : ends[-1]], SEED)]
    return [h(text[b:e], SEED) for b, e in zip(begins, ends[shingle - 1 :])]


def _majorities(hashes: np.ndarray, first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each row, the bits set in over half of its hashes; 0 for a row without any."""
    out = np.zeros(len(counts), np.uint64)
    some = np.flatnonzero(counts)
    if len(some):
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        sums = np.add.reduceat(bits, first[some], axis=0, dtype=np.int32)
        major = (2 * sums > counts[some, None]).astype(np.uint8)
        out[some] = np.packbits(major, axis=1, bitorder="little").view("<u8").ravel()
    return out


def _fingerprints(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = flat(batch.column("text"))
        out = []
        for a, b in steps(offsets, 1 << 18):
            part, at = LOWER[data[offsets[a] : offsets[b]]], offsets[a : b + 1] - offsets[a]
            starts, ends, rows = find_words(part, at, WHITE)
            counts = np.bincount(rows, minlength=b - a)
            # The words with one blank after each: what shingles are slices of.
            lengths = ends - starts
            to = np.cumsum(lengths + 1)
            begins, stops = to - lengths - 1, to - 1
            joined = np.full(int(to[-1]) if len(to) else 0, 32, np.uint8)
            inside = np.ones(len(joined), bool)
            inside[stops] = False
            joined[inside] = part[WHITE[part]]
            text, begins, stops = joined.tobytes(), begins.tolist(), stops.tolist()
            at, hashes, sizes = 0, [], []
            for n in counts.tolist():
                found = _shingle_hashes(text, begins[at : at + n], stops[at : at + n], shingle)
                hashes += found
                sizes.append(len(found))
                at += n
            sizes = np.array(sizes)
            out.append(_majorities(np.array(hashes, np.uint64), np.cumsum(sizes) - sizes, sizes))
        prints = np.concatenate(out) if out else np.zeros(0, np.uint64)
        rest = [batch.column(i) for i in range(batch.num_columns) if batch.schema.field(i).name != "text"]
        yield pa.record_batch([*rest, pa.array(prints.view(np.int64))], [*[n for n in batch.schema.names if n != "text"], "print"])


def fingerprints(documents: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, row_key, print) of every document, ``print`` as a signed 64-bit number; 0 for a text without words."""
    bounded_batches(documents.sparkSession)
    keyed = documents.select("doc_id", row_digest(F.col("doc_id"), F.col("text")).alias("row_key"), "text")
    id_type = documents.schema["doc_id"].dataType.simpleString()
    return keyed.mapInArrow(lambda it: _fingerprints(it, shingle), f"doc_id {id_type}, row_key string, print long")


def masks(radius: int = RADIUS, blocks: int = BLOCKS) -> list[int]:
    """Masks such that any two fingerprints within ``radius`` agree under one of them: all choices of ``blocks - radius`` blocks of bits."""
    if not 0 <= radius < blocks <= 64:
        raise ValueError("there must be more blocks than differing bits, and 64 at most")
    cuts = [round(i * 64 / blocks) for i in range(blocks + 1)]
    part = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]
    return [sum(part[i] for i in chosen) for chosen in combinations(range(blocks), blocks - radius)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def gray_rank(fingerprint: Column) -> Column:
    """Place of a code in the Gray sequence, as a signed number of the same order."""
    rank = fingerprint
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, shift))
    return rank.bitwiseXOR(F.lit(-(1 << 63)))


def from_rank(rank: Column) -> Column:
    """The code at a place in the Gray sequence."""
    plain = rank.bitwiseXOR(F.lit(-(1 << 63)))
    return plain.bitwiseXOR(F.shiftrightunsigned(plain, 1))


def _levels(prints: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Bits that all, and that any, of a node's fingerprints have; first the fingerprints, last a few top nodes."""
    levels = [(prints, prints)]
    while len(levels[-1][0]) > FAN_OUT:
        every, some = levels[-1]
        at = np.arange(0, len(every), FAN_OUT)
        levels.append((np.bitwise_and.reduceat(every, at), np.bitwise_or.reduceat(some, at)))
    return levels


def _search(a: np.ndarray, b: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of fingerprints of ``a`` and ``b`` within ``radius``; without ``b``, of pairs i < j inside ``a``."""
    up = _levels(a)
    over = up if b is None else _levels(b)
    while len(over) < len(up):
        over.append(over[-1] if len(over[-1][0]) == 1 else _levels_top(over[-1]))
    while len(up) < len(over):
        up.append(up[-1] if len(up[-1][0]) == 1 else _levels_top(up[-1]))
    n, m = len(up[-1][0]), len(over[-1][0])
    i, j = np.divmod(np.arange(n * m), m)
    for level in range(len(up) - 1, -1, -1):
        if level < len(up) - 1:
            wide_i = (i[:, None, None] * FAN_OUT + np.arange(FAN_OUT)[None, :, None])
            wide_j = (j[:, None, None] * FAN_OUT + np.arange(FAN_OUT)[None, None, :])
            i, j = (x.ravel() for x in np.broadcast_arrays(wide_i, wide_j))
            there = (i < len(up[level][0])) & (j < len(over[level][0]))
            i, j = i[there], j[there]
        if b is None:
            ordered = i < j if level == 0 else i <= j
            i, j = i[ordered], j[ordered]
        (every_a, some_a), (every_b, some_b) = up[level], over[level]
        apart = (every_a[i] & ~some_b[j]) | (every_b[j] & ~some_a[i])
        near = np.bitwise_count(apart) <= radius
        i, j = i[near], j[near]
    return i, j


def _levels_top(level: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    every, some = level
    at = np.arange(0, len(every), FAN_OUT)
    return np.bitwise_and.reduceat(every, at), np.bitwise_or.reduceat(some, at)


def _forest(ids: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (member, root) that connect what the pairs connect: one for each place that is no root.

    The root is the least id, so that index nodes which share members tend to give the same edges.
    """
    order = np.argsort(ids, kind="stable")
    place = np.empty(len(ids), np.int64)
    place[order] = np.arange(len(ids))
    label = place.copy()
    while len(i):
        before = label.copy()
        np.minimum.at(label, i, label[j])
        np.minimum.at(label, j, label[i])
        label = label[order[label]]
        if np.array_equal(label, before):
            break
    members = np.flatnonzero(label != place)
    return ids[members], ids[order[label[members]]]


_OUT = pa.schema([
    ("a", pa.int64()), ("b", pa.int64()), ("mask", pa.int32()), ("pattern", pa.int64()), ("every", pa.int64()), ("some", pa.int64()),
    ("least", pa.int64()), ("first", pa.int64()), ("rows", pa.binary())])
_OUT_DDL = "a long, b long, mask int, pattern long, every long, some long, least long, first long, rows binary"


@dataclass(frozen=True)
class Tables:
    """How nodes with one or several fingerprints each are linked.

    ``count``: fingerprints per node to search by.  A pair must be within ``radius`` in one of them; the first ``alone`` of them suffice
    by themselves.  Pairs found by the others need ``total`` differing bits or fewer in the ``proofs`` further numbers of each node.
    After the fingerprints come ``bands`` numbers of which one must be equal; pairs found by them need the proofs too."""

    count: int = 1
    alone: int = 1
    radius: int = RADIUS
    proofs: int = 0
    total: int = 0
    blocks: int = BLOCKS
    bands: int = 0

    @property
    def masks(self) -> list[int]:
        return masks(self.radius, self.blocks)

    @property
    def bits(self) -> np.ndarray:
        """The bits of a number by which it is put into an index node, for each mask of each table; all bits of a band."""
        return np.array([*self.masks * self.count, *[(1 << 64) - 1] * self.bands], np.uint64)

    def confirmed(self, table: int, a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``a`` and ``b``: rows of proofs."""
        if table < self.alone or len(i) == 0:
            return i, j
        apart = np.zeros(len(i), np.uint16)
        for k in range(self.proofs):
            apart += np.bitwise_count(a[i, k] ^ b[j, k])
            near = apart <= self.total
            if not near.all():
                i, j, apart = i[near], j[near], apart[near]
        return i, j

    def pairs(self, table: int, a: np.ndarray, b: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """``a`` and ``b``: rows of the fingerprint searched by, then the proofs."""
        i, j = _search(np.ascontiguousarray(a[:, 0]), None if b is None else np.ascontiguousarray(b[:, 0]), self.radius)
        return self.confirmed(table, a[:, 1:], (a if b is None else b)[:, 1:], i, j)


def _edges_out(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    none = [pa.nulls(len(a), f.type) for f in list(_OUT)[2:]]
    return pa.record_batch([pa.array(a), pa.array(b), *none], schema=_OUT)


def _chunk_out(mask: int, pattern: np.uint64, ids: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
    mine = rows[:, 0]
    numbers = (pattern, np.bitwise_and.reduce(mine), np.bitwise_or.reduce(mine), mine[0])
    whole = np.column_stack([ids.view(np.uint64), rows])
    values = [None, None, int(mask), *(_signed(int(x)) for x in numbers), int(ids[0]), whole.tobytes()]
    return pa.record_batch([pa.array([v], f.type) for v, f in zip(values, _OUT)], schema=_OUT)


def _link_runs(batches: Iterator[pa.RecordBatch], tables: Tables, most: int) -> Iterator[pa.RecordBatch]:
    """Rows (mask, id, fingerprint, proofs) in the order of the index.  Gives edges, and chunks of the index nodes that this task may not hold whole."""
    bits, per_table = tables.bits, len(tables.masks)
    mask_of, ids, rows = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, 1 + tables.proofs), np.uint64)
    opened = True  # the first index node of a task may have begun in another one

    def closed(mask_of: np.ndarray, ids: np.ndarray, rows: np.ndarray, runs: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Index nodes that lie whole in this task; ``runs``: where each begins."""
        sizes = np.diff(np.append(runs, len(ids)))
        several = sizes > 1
        small = several & (sizes <= SMALL)
        if small.any():
            keep = np.repeat(small, sizes)
            some, run, table = rows[keep], np.repeat(np.arange(len(sizes)), sizes)[keep], mask_of[keep] // per_table
            pairs_i, pairs_j = [], []
            for d in range(1, int(sizes[small].max())):
                i = np.flatnonzero(run[:-d] == run[d:])
                i = i[np.bitwise_count(some[i, 0] ^ some[i + d, 0]) <= tables.radius]
                alone = table[i] < tables.alone
                x, y = tables.confirmed(tables.alone, some[:, 1:], some[:, 1:], i[~alone], i[~alone] + d)
                pairs_i += [i[alone], x]
                pairs_j += [i[alone] + d, y]
            yield _edges_out(*_forest(ids[keep], np.concatenate(pairs_i), np.concatenate(pairs_j)))
        for k in np.flatnonzero(several & ~small):
            part = slice(runs[k], runs[k] + sizes[k])
            if sizes[k] <= most:
                yield _edges_out(*_forest(ids[part], *tables.pairs(int(mask_of[runs[k]]) // per_table, rows[part], None)))
            else:
                yield from chunked(int(mask_of[runs[k]]), ids[part], rows[part])

    def chunked(mask: int, ids: np.ndarray, rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(ids), most):
            piece, named = rows[at : at + most], ids[at : at + most]
            yield _edges_out(*_forest(named, *tables.pairs(mask // per_table, piece, None)))
            yield _chunk_out(mask, piece[0, 0] & bits[mask], named, piece)

    for batch in batches:
        mask_of = np.concatenate([mask_of, batch.column(0).to_numpy().astype(np.int64)])
        ids = np.concatenate([ids, batch.column(1).to_numpy()])
        rows = np.concatenate([rows, np.column_stack([batch.column(i).to_numpy().view(np.uint64) for i in range(2, 3 + tables.proofs)])])
        if len(ids) == 0:
            continue
        pattern = rows[:, 0] & bits[mask_of]
        runs = np.concatenate([[0], np.flatnonzero((np.diff(mask_of) != 0) | (pattern[1:] != pattern[:-1])) + 1])
        last = int(runs[-1])
        if len(runs) > 1:
            if opened:
                yield from chunked(int(mask_of[0]), ids[: runs[1]], rows[: runs[1]])
                opened = False
                runs = runs[1:]
            begin = int(runs[0])
            if last > begin:
                yield from closed(mask_of[begin:last], ids[begin:last], rows[begin:last], runs[:-1] - begin)
        mask_of, ids, rows = mask_of[last:], ids[last:], rows[last:]
        whole = len(ids) // most * most
        if whole > 8 * most:  # a long index node: pass on what is there, and treat the rest as one that began elsewhere
            yield from chunked(int(mask_of[0]), ids[:whole], rows[:whole])
            mask_of, ids, rows, opened = mask_of[whole:], ids[whole:], rows[whole:], True
    if len(ids):
        yield from chunked(int(mask_of[0]), ids, rows)


def _link_chunks(batches: Iterator[pa.RecordBatch], tables: Tables) -> Iterator[pa.RecordBatch]:
    n_masks = len(tables.masks)
    for batch in batches:
        for mask, *both in zip(*(batch.column(i).to_pylist() for i in range(3))):
            a, b = (np.frombuffer(x, np.uint64).reshape(-1, 2 + tables.proofs) for x in both)
            i, j = tables.pairs(mask // n_masks, a[:, 1:], b[:, 1:])
            x, y = _forest(np.concatenate([a[:, 0], b[:, 0]]).view(np.int64), i, j + len(a))
            yield pa.record_batch([pa.array(x), pa.array(y)], ["a", "b"])


def links(nodes: DataFrame, tables: Tables = Tables(), chunk: int = CHUNK) -> DataFrame:
    """Edges (a, b) between nodes (id, prints, proofs) that connect exactly those that chains of linked pairs connect.

    Ids are distinct 64-bit numbers; ``prints`` and ``proofs`` are arrays of as many numbers as ``tables`` says, the latter absent if there are none.
    """
    bounded_batches(nodes.sparkSession)
    per_table = len(tables.masks)
    proofs = [F.col("proofs")[i].alias(f"proof{i}") for i in range(tables.proofs)]
    names = [f"proof{i}" for i in range(tables.proofs)]
    # One row per table, then one per mask: the rank is worked out once, and the plan stays small however many masks there are.
    listed = nodes.select("id", *proofs, F.posexplode("prints").alias("table", "print")).withColumn("rank", gray_rank(F.col("print")))
    whole = F.col("table") >= tables.count
    bits = F.when(whole, F.array(F.lit(-1).cast("long"))).otherwise(F.array(*[F.lit(_signed(m)).cast("long") for m in tables.masks]))
    masked = listed.select("id", *names, "table", "print", "rank", F.posexplode(bits).alias("n", "bits"))
    number = F.when(whole, F.col("table") + tables.count * (per_table - 1)).otherwise(F.col("table") * per_table + F.col("n"))
    order = ["mask", "pattern", "rank", "id"]
    ranked = masked.select(
        number.alias("mask"), F.col("print").bitwiseAND(F.col("bits")).alias("pattern"), "rank", "id", *names,
    ).repartitionByRange(*order).sortWithinPartitions(*order)
    found = settle(ranked.select("mask", "id", from_rank(F.col("rank")).alias("print"), *names).mapInArrow(lambda it: _link_runs(it, tables, chunk), _OUT_DDL), "gray-index")
    inside = found.where("a is not null").select("a", "b")
    chunks = found.where("rows is not null").drop("a", "b")
    other = chunks.select(*[F.col(c).alias(f"_{c}") for c in chunks.columns])
    apart = F.expr("bit_count((every & ~_some) | (_every & ~some))")
    ordered = F.struct("least", "first") < F.struct("_least", "_first")
    pairs = chunks.join(other, (F.col("mask") == F.col("_mask")) & (F.col("pattern") == F.col("_pattern")) & ordered & (apart <= tables.radius))
    across = pairs.select("mask", "rows", "_rows").mapInArrow(lambda it: _link_chunks(it, tables), "a long, b long")
    return inside.unionByName(across).distinct()


def near_duplicates(documents: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """(doc_id, row_key, print, root, component_id) for every document.

    ``root`` is a fingerprint that names the group.  Equal fingerprints are one node, however many documents have them.  ``component_id`` is the smallest doc_id
    among the documents that chains of links reach; null if none of them has an id.  Texts without words have
    fingerprint 0 and link like any other.  Fewer words than a shingle are hashed as one.  Texts of any length are hashed whole, by one
    task.  Repeated rows repeat their result; an empty table gives an empty one; other columns are ignored.
    """
    printed = settle(fingerprints(documents, shingle), "prints")
    distinct = settle(printed.groupBy("print").agg(F.min("doc_id").alias("least")), "distinct-prints")
    nodes = distinct.select(F.col("print").alias("id"), F.array("print").alias("prints"))
    roots = connected(links(nodes, Tables(radius=radius, blocks=blocks)))
    rooted = distinct.join(roots, distinct["print"] == roots["node"], "left").select("print", "least", F.coalesce("root", "print").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    known = rooted.join(least, "root").select("print", "root", "component_id")
    return printed.join(known, "print").select("doc_id", "row_key", "print", "root", "component_id")


# For near copies: the least hashes of a text's five-word shingles under 512 orders.  Two texts of Jaccard similarity s have the same least hash
# with probability s each, whatever kind of edit lies between them.  The first 64 are taken by fours as bands to search by: one of 16 is equal
# with probability 1 - (1 - s^4)^16, which is 0.9998 at 0.8.  One bit of each of the 512 is the proof: two texts differ in 256 (1 - s) of them
# on average, 51 at 0.8, 64 at 0.75 and 77 at 0.7, with a deviation of 7 to 8.
BANDS, BAND, PROOFS = 16, 4, 8
SIMILAR_SHINGLE = 5
SIMILAR = Tables(count=1, alone=1, proofs=PROOFS, total=64, bands=BANDS)
_ORDERS = mixed(np.arange(1, 64 * PROOFS + 1, dtype=np.uint64)) | np.uint64(1)


def _least_hashes(hashed: np.ndarray, rows: np.ndarray, n_rows: int) -> np.ndarray:
    """For each row, its least hash under each order; all ones for a row without any."""
    order = np.argsort(rows, kind="stable")
    hashed, rows = hashed[order], rows[order]
    out = np.full((n_rows, len(_ORDERS)), np.uint64((1 << 64) - 1))
    if len(rows):
        first = np.flatnonzero(np.diff(rows, prepend=-1))
        for k, multiplier in enumerate(_ORDERS):
            out[rows[first], k] = np.minimum.reduceat(hashed * multiplier, first)
    return out


def _bands_and_proofs(least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    bands = hash_bands(least[:, : BANDS * BAND].reshape(len(least), BANDS, BAND))
    proofs = np.packbits((mixed(least) & np.uint64(1)).astype(np.uint8), axis=1, bitorder="little").view("<u8")
    return bands, proofs.astype(np.uint64)


def hash_bands(values: np.ndarray) -> np.ndarray:
    """One number for each run of values along the last axis."""
    out = np.zeros(values.shape[:-1], np.uint64)
    for k in range(values.shape[-1]):
        out = mixed(out ^ values[..., k]) + np.uint64(k + 1)
    return out


def _similar_fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The fingerprint of shingles that a batch has already, then the bands of each text; and the proofs."""
    for batch in batches:
        data, offsets = flat(batch.column("text"))
        bands, proofs = [np.zeros((0, BANDS), np.uint64)], [np.zeros((0, PROOFS), np.uint64)]
        for a, b in steps(offsets, 1 << 18):
            part, at = LOWER[data[offsets[a] : offsets[b]]], offsets[a : b + 1] - offsets[a]
            starts, ends, rows = find_words(part, at, WHITE)
            hashed = hash_words(part, starts, ends)
            whole = np.flatnonzero(whole_grams(rows, SIMILAR_SHINGLE))
            grams, of = hash_grams(hashed, SIMILAR_SHINGLE)[whole], rows[whole]
            # A text of fewer words is one shingle.
            short = np.flatnonzero(np.bincount(of, minlength=b - a) == 0)
            short = short[np.isin(short, rows)]
            sums = np.bincount(rows, minlength=b - a).cumsum()
            ones = np.array([int(np.bitwise_xor.reduce(mixed(hashed[sums[r - 1] if r else 0 : sums[r]] + np.arange(sums[r] - (sums[r - 1] if r else 0)).astype(np.uint64)))) for r in short], np.uint64)
            for numbers, out in zip(_bands_and_proofs(_least_hashes(np.concatenate([grams, ones]), np.concatenate([of, short]), b - a)), (bands, proofs)):
                out.append(numbers)
        whole = np.column_stack([batch.column("print").to_numpy().view(np.uint64), np.concatenate(bands)])

        def listed(numbers: np.ndarray) -> pa.Array:
            return pa.FixedSizeListArray.from_arrays(pa.array(np.ascontiguousarray(numbers).ravel().view(np.int64)), numbers.shape[1]).cast(pa.list_(pa.int64()))

        yield pa.record_batch([batch.column("doc_id"), batch.column("row_key"), listed(whole), listed(np.concatenate(proofs))], ["doc_id", "row_key", "prints", "proofs"])


def similar_groups(documents: DataFrame, tables: Tables = SIMILAR) -> DataFrame:
    """(doc_id, row_key, root): groups of near-duplicates by the linked fingerprint, and by similarity of five-word shingles.

    Beside the links of ``near_duplicates``, two texts are linked if one of 16 bands of their five-word shingles is equal and
    512 bits over these shingles differ in 64 places or fewer, which estimates a Jaccard similarity of 0.75 with a
    deviation of 0.03, so that 0.97 of the pairs at 0.8 are linked.  Texts with equal fingerprints are one node.
    """
    bounded_batches(documents.sparkSession)
    keyed = documents.select("doc_id", row_digest(F.col("doc_id"), F.col("text")).alias("row_key"), "text")
    id_type = documents.schema["doc_id"].dataType.simpleString()

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for printed in _fingerprints(iter([batch]), SHINGLE):
                yield from _similar_fingerprints(iter([pa.record_batch([*printed.columns, batch.column("text")], [*printed.schema.names, "text"])]))

    printed = keyed.mapInArrow(both, f"doc_id {id_type}, row_key string, prints array<long>, proofs array<long>")
    printed = settle(printed.withColumn("id", F.xxhash64("prints", "proofs")), "prints")
    nodes = printed.groupBy("id").agg(F.first("prints").alias("prints"), F.first("proofs").alias("proofs"))
    roots = connected(links(nodes, tables)).withColumnRenamed("node", "id")
    return printed.join(roots, "id", "left").select("doc_id", "row_key", F.coalesce("root", "id").alias("root"))


def one_of_each(documents: DataFrame) -> DataFrame:
    """One document of every group of ``similar_groups``, as it was: that with the smallest id (ids before nulls), of equal rows one."""
    first = similar_groups(documents).groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")).alias("first"))
    keys = first.select(F.col("first.row_key").alias("__key"))
    keyed = documents.withColumn("__wayfleet_row", row_digest(F.col("doc_id"), F.col("text")))
    return keyed.join(keys, keyed["__wayfleet_row"] == keys["__key"], "left_semi").dropDuplicates(["__wayfleet_row"]).drop("__wayfleet_row")


def hexed(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))
