"""Near duplicates by bottom-k sketches.

A document is the set of its distinct 5-word shingles, each hashed once; its sketch is the k smallest
hashes. Texts with equal sets form a class, and one document stands for it.

Inverted lists. Two sets with a Jaccard similarity of 0.75 or more agree in most of the smallest hashes of
their union. List keys are pairs of neighbouring values among the first `listed` values of a sketch, with a
class of set size in which similar sets must meet. Two sets that never have two common values in a row
among the first 32 of their union share no list; at similarity 0.75 that has probability 0.5757**32 = 2e-8,
and it cannot happen to sets of up to 32 shingles. Keys of two values keep a passage that many documents
share from linking all of them to a list, as only neighbours count.

Groups. Each list names its smallest class as its hub, and classes that share a list meet in the hub's group, where
each occurs once. Up to `BLOCK_DOCS` classes are one unit of work: the sketches of a union are estimated for all pairs at
once by a matrix product, classes without any pair that may reach the threshold go, and those left are compared in
the same way on their full sets, exactly. Only a spanning forest of the links is written.

Large groups. Their hub is their most central class: the one whose own lists hold most members, as those of the
original of many altered copies do. Large groups with one hub become one. Every member is compared with the hub
alone, in slices of bounded size, so a group costs a row a member. Members that link with the hub are one
component and need no pair among themselves. By the triangle inequality of the Jaccard distance, a member at a
distance above 0.5 from the hub links with none of them, and one at a distance between 0.25 and 0.5 (the ring) only
with those at most 0.25 nearer than itself. What is left are the pairs of the members that do not link with the hub,
among themselves and with those that the ring needs. Where these members fill more than a block, they are
told apart by what they do not share.

Differences. The centre of such members is the set of the shingles that most of them have, and a member's difference is
what it has beyond the centre and lacks of it. Two sets x, y are similar if |x - y| + |y - x| is at most a share of
|x| + |y| (1/7 at 0.75); their differences d are as far from each other as they are. So with the excess
e = |d| - share * |set|, two members with e1 + e2 <= 0 are similar by the triangle inequality, and others must have
(e1 + e2) / 2 elements of their differences in common. Members that the one of the least excess reaches in the first way
(the core) are one component. For the rest, as no pair needs more of its elements than that bound leaves out, two similar
members share one of the first elements of both differences, in any order; they are taken from the rarest of the group
on. A member looks for partners of less excess than its own, so a list needs one that looks and one of less excess.
All of this is exact and costs a row a shingle. An altered copy of a text has only its own alterations in its first
elements, and a passage that dissimilar documents share is the centre or comes last. These lists are compared as all
others are. One over 512 members, which have a rare shingle and little else in common, is still cut into pairs of blocks.

The estimate must stay 0.25 below the threshold to be discarded: over 6 standard deviations at k = 128.

Hot lists, hubs, shingles and star nodes: joins on them come from exchanges of their own, so adaptive execution parts them.

Defined results: NULL and empty texts have no set, are linked with nothing and stay. A text of fewer than
five words is one shingle of all its words. doc_id names a document: where it has several texts, each row has its
own set size, and all of them are linked. Rows that repeat doc_id and text share one class. A row with a NULL
doc_id is linked with nothing, has a NULL component_id, and stays. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadpulse.llm import folders
from threadpulse.llm import words as W
from threadpulse.llm.components import components
from threadpulse.operators.skew import lookup_join

SHINGLE = 5
PERCENT = 75
K, LISTED = 128, 32
MARGIN = 25
#: Classes in a block, and shingles of all of them together.
BLOCK_DOCS, BLOCK_SHINGLES = 512, 1 << 18
#: Ids (8 bytes each) that may be broadcast to choose sketches or texts before the shuffle.
BROADCAST_IDS = 1 << 20
#: Percent of similarity from which a member of a large group may still matter to those that link with its hub.
RING = 50
_COLUMNS = 4096  # of a matrix of shingles at a time
_TEXT_BYTES = 3 << 18  # of texts hashed at a time


def shingle_sets(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct shingle hashes of all texts laid end to end, and where each text's begin."""
    n = batch.num_rows
    texts = W.Texts.of(batch.column("text")).lowered()
    found = W.split(texts, W.WHITE)
    values = W.hashes(texts, found)
    counts = found.per_text(n)
    parts, owners = [], []
    for width in (SHINGLE, *range(1, SHINGLE)):
        hashed = W.windows(values, width)
        ok = W.same_text(found, width)
        text = found.text[: len(ok)]
        if width < SHINGLE:
            ok = ok & (counts[text] == width)
            hashed = W.mix(hashed + np.uint64(width))
        parts.append(hashed[ok])
        owners.append(text[ok])
    hashed, owner = np.concatenate(parts), np.concatenate(owners)
    order = np.lexsort((hashed, owner))
    hashed, owner = hashed[order], owner[order]
    new = np.ones(len(hashed), bool)
    new[1:] = (hashed[1:] != hashed[:-1]) | (owner[1:] != owner[:-1])
    hashed, owner = hashed[new], owner[new]
    return hashed, np.searchsorted(owner, np.arange(n + 1))


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in W.slices(batches, "text", _TEXT_BYTES):
        hashed, bounds = shingle_sets(batch)
        sizes = np.diff(bounds)
        one = np.concatenate([np.zeros(1, np.uint64), np.cumsum(W.mix(hashed), dtype=np.uint64)])
        two = np.concatenate([np.zeros(1, np.uint64), np.cumsum(W.mix(hashed + np.uint64(7)), dtype=np.uint64)])
        low = np.minimum(sizes, K)
        within = np.arange(len(hashed)) - np.repeat(bounds[:-1], sizes)
        sketch = hashed[within < K]
        offsets = np.concatenate([[0], np.cumsum(low)]).astype(np.int32) * 8
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(sizes, pa.int64()),
                W.signed(one[bounds[1:]] - one[bounds[:-1]]),
                W.signed(two[bounds[1:]] - two[bounds[:-1]]),
                pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(offsets), pa.py_buffer(sketch)]),
            ],
            ["doc_id", "n", "set1", "set2", "sketch"],
        )


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, n (size of the set), set1 and set2 (hash of the set) and sketch (u64, ascending) of each row."""
    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return wanted.mapInArrow(_signatures, "doc_id long, n long, set1 long, set2 long, sketch binary")


def size_class(n: int, percent: int = PERCENT) -> int:
    """Sets whose smaller size is at least percent of the larger are in the same class or in adjacent ones."""
    return math.floor(math.log(n) / -math.log(percent / 100) + 1e-9)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sketches = [np.frombuffer(s, np.uint64)[:LISTED] for s in batch.column("sketch").to_pylist()]
        keys, counts = [], []
        for values, n in zip(sketches, batch.column("n").to_pylist(), strict=True):
            pairs = W.mix(values[:-1] * np.uint64(3) + W.mix(values[1:])) if len(values) > 1 else values
            low = np.uint64(size_class(n))
            keys += [pairs + W.mix(np.full(len(pairs), low)), pairs + W.mix(np.full(len(pairs), low + np.uint64(1)))]
            counts.append(2 * len(pairs))
        members = np.repeat(batch.column("class").to_numpy(zero_copy_only=False), counts)
        flat = np.concatenate(keys) if keys else np.empty(0, np.uint64)
        yield pa.RecordBatch.from_arrays([W.signed(flat), pa.array(members, pa.int64())], ["key", "class"])


def lists(classes: DataFrame) -> DataFrame:
    """key, class: the inverted lists of neighbouring values among the first of each sketch."""
    return classes.select("class", "n", "sketch").mapInArrow(_keys, "key long, class long")


def grouped(entries: DataFrame) -> DataFrame:
    """hub, class, score: the classes that share a list with the smallest one of it, and how long these lists are."""
    found = entries.groupBy("key").agg(
        F.min("class").alias("hub"), F.max("class").alias("last"), F.count(F.lit(1)).alias("size")
    )
    hubs = found.where("hub < last").select(F.col("key").alias("hub_key"), "hub", "size")
    return lookup_join(entries, hubs, "key", "hub_key").groupBy("hub", "class").agg(F.sum("size").alias("score"))


def central(members: DataFrame, scores: DataFrame) -> DataFrame:
    """hub, class: the groups with their central class as the hub, and those that have the same as one.

    scores has the length of all lists of each class (of_class, total).
    """
    known = members.select("hub", "class").join(scores, F.col("class") == F.col("of_class"))
    best = known.groupBy("hub").agg(F.max(F.struct("total", (-F.col("class")).alias("class"))).alias("best"))
    best = best.select(F.col("hub").alias("of_hub"), (-F.col("best.class")).alias("centre"))
    return lookup_join(members, best, "hub", "of_hub").select(F.col("centre").alias("hub"), "class").distinct()


def _room(docs: str, largest: str) -> F.Column:
    """How many blocks a group takes."""
    room = F.greatest(F.lit(8), F.least(F.lit(BLOCK_DOCS), F.floor(F.lit(BLOCK_SHINGLES) / F.col(largest))))
    return F.ceil(F.col(docs) / room).cast("int")


def blocks(members: DataFrame, largest: str) -> DataFrame:
    """hub, i, j, side and class: each class in every pair of blocks of its group.

    A block holds at most BLOCK_DOCS classes and about BLOCK_SHINGLES shingles.
    """
    sizes = members.groupBy("hub").agg(F.count(F.lit(1)).alias("docs"), F.max(largest).alias("largest"))
    sizes = sizes.where("docs > 1").select(F.col("hub").alias("of_hub"), _room("docs", "largest").alias("parts"))
    cut = lookup_join(members, sizes, "hub", "of_hub")
    cut = cut.withColumn("own", F.pmod(F.xxhash64("class"), F.col("parts")).cast("int"))
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda o: F.struct(F.least(F.col("own"), o).alias("i"), F.greatest(F.col("own"), o).alias("j"), (F.col("own") > o).alias("side")),
    )
    return cut.withColumn("pair", F.explode(pairs)).select("hub", "pair.i", "pair.j", "pair.side", "class")


def slices(members: DataFrame, largest: str) -> DataFrame:
    """hub, i, j, side and class: each member of a group in one slice, with the hub on the other side of each."""
    sizes = members.groupBy("hub").agg(F.count(F.lit(1)).alias("docs"), F.max(largest).alias("largest"))
    sizes = sizes.select(F.col("hub").alias("of_hub"), _room("docs", "largest").alias("parts"))
    others = lookup_join(members.where("class <> hub"), sizes, "hub", "of_hub")
    others = others.withColumn("i", F.pmod(F.xxhash64("class"), F.col("parts")).cast("int"))
    hubs = sizes.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    hubs = hubs.select(F.col("of_hub").alias("hub"), "i", F.lit(True).alias("side"), F.col("of_hub").alias("class"))
    both = others.select("hub", "i", F.lit(False).alias("side"), "class").unionByName(hubs)
    return both.select("hub", "i", (F.col("i") + 1).alias("j"), "side", "class")


def _common(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets numbered left with those numbered right."""
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, column, count = np.unique(flat, return_inverse=True, return_counts=True)
    shared = count[column] > 1
    column, owner = column[shared], owner[shared]
    _, column = np.unique(column, return_inverse=True)
    out = np.zeros((len(left), len(right)), np.float32)
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, _COLUMNS):
        a, b = np.searchsorted(column, (first, first + _COLUMNS))
        dense = np.zeros((len(sets), _COLUMNS), np.float32)
        dense[owner[a:b], column[a:b] - first] = 1
        out += dense[left] @ dense[right].T
    return out.astype(np.int64)


def _pairs_of(side: np.ndarray, i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the documents on either side; within one block, both are all of it."""
    every = np.arange(len(side))
    return (every, every) if i == j else (np.flatnonzero(~side), np.flatnonzero(side))


def _estimated(
    sketches: list[np.ndarray], sizes: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int
) -> np.ndarray:
    """Whether a pair's similarity, estimated on the sketch of its union, is above percent less margin.

    Below the smaller of two sketch ends both sketches are complete; a set of up to K values has no end.
    """
    ends = np.array([s[-1] if n > K else 2**64 - 1 for s, n in zip(sketches, sizes, strict=True)], np.uint64)
    common = _common(sketches, left, right)
    below_left = np.stack([np.searchsorted(sketches[a], ends[right], "right") for a in left])
    below_right = np.stack([np.searchsorted(sketches[b], ends[left], "right") for b in right], axis=1)
    union = below_left + below_right - common
    a, b = sizes[left][:, None], sizes[right][None, :]
    similar = 100 * np.minimum(a, b) >= percent * np.maximum(a, b)
    return similar & (100 * common >= (percent - MARGIN) * union) & (common > 0)


def _by_group(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """Rows with equal keys that follow each other, across batches."""
    held: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        n = batch.num_rows
        if not n:
            continue
        change = np.zeros(n, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), n]
        for a, b in zip(cuts, cuts[1:], strict=False):
            key = tuple(c[a].item() for c in columns)
            if key != current and held:
                yield current, pa.Table.from_batches(held)
                held = []
            current = key
            held.append(batch.slice(a, b - a))
    if held:
        yield current, pa.Table.from_batches(held)


def _survivors(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for (hub, i, j), rows in _by_group(batches, _UNIT):
        member = rows.column("class").to_numpy()
        sketches = [np.frombuffer(s, np.uint64) for s in rows.column("sketch").to_pylist()]
        left, right = _pairs_of(rows.column("side").to_numpy(), i, j)
        if not len(left) or not len(right):
            continue
        good = _estimated(sketches, rows.column("n").to_numpy(), left, right, percent)
        good &= member[left][:, None] != member[right][None, :]
        keep = np.unique(np.concatenate([left[good.any(axis=1)], right[good.any(axis=0)]]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(keep), hub), pa.int64()), pa.array(member[keep])], ["hub", "class"]
        )


def _measured(rows: pa.Table, i: int, j: int) -> tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
    """A unit's rows whose text has the set of the class, their two sides, and the sizes of all pairs' intersections
    and unions."""
    sets, own = [], []
    for batch in W.slices(iter(rows.to_batches()), "text", _TEXT_BYTES):
        hashed, bounds = shingle_sets(batch)
        one = np.concatenate([np.zeros(1, np.uint64), np.cumsum(W.mix(hashed), dtype=np.uint64)])
        own.append((one[bounds[1:]] - one[bounds[:-1]]).view(np.int64) == batch.column("set1").to_numpy())
        sets += [hashed[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]
    # A doc_id may have other texts, and several with the set of the class.
    same = np.flatnonzero(np.concatenate(own))
    member = 2 * rows.column("class").to_numpy()[same] + rows.column("side").to_numpy()[same]
    use = same[np.sort(np.unique(member, return_index=True)[1])]
    rows, sets = rows.take(pa.array(use)), [sets[k] for k in use]
    left, right = _pairs_of(rows.column("side").to_numpy(), i, j)
    if not len(left) or not len(right):
        return None
    sizes = np.array([len(s) for s in sets])
    common = _common(sets, left, right)
    return rows, left, right, common, sizes[left][:, None] + sizes[right][None, :] - common


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A spanning forest of the exact links of each pair of blocks."""
    for (_, i, j), rows in _by_group(batches, _UNIT):
        found = _measured(rows, i, j)
        if found is None:
            continue
        rows, left, right, common, union = found
        doc = rows.column("doc_id").to_numpy()
        a, b = _forest(left, right, 100 * common >= PERCENT * union, len(doc))
        yield pa.RecordBatch.from_arrays([pa.array(doc[a]), pa.array(doc[b])], ["a", "b"])


def _to_hub(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """hub, class, both documents, similarity and whether it is a link, of members at most as far as the ring."""
    for (hub, i, j), rows in _by_group(batches, _UNIT):
        found = _measured(rows, i, j)
        if found is None:
            continue
        rows, left, right, common, union = found
        common, union = common[:, 0], union[:, 0]
        near = 100 * common >= RING * union
        doc = rows.column("doc_id").to_numpy()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(int(near.sum()), hub), pa.int64()),
                pa.array(rows.column("class").to_numpy()[left[near]]),
                pa.array(np.full(int(near.sum()), doc[right[0]]), pa.int64()),
                pa.array(doc[left[near]]),
                pa.array(common[near] / union[near]),
                pa.array((100 * common >= PERCENT * union)[near]),
            ],
            ["hub", "class", "hub_doc", "doc_id", "similar", "linked"],
        )


def _own_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """class and shingles (its whole set) from the texts that have the set of the class."""
    for batch in W.slices(batches, "text", _TEXT_BYTES):
        hashed, bounds = shingle_sets(batch)
        sizes = np.diff(bounds)
        one = np.concatenate([np.zeros(1, np.uint64), np.cumsum(W.mix(hashed), dtype=np.uint64)])
        own = (one[bounds[1:]] - one[bounds[:-1]]).view(np.int64) == batch.column("set1").to_numpy()
        offsets = np.concatenate([[0], np.cumsum(sizes[own])]).astype(np.int32)
        sets = pa.ListArray.from_arrays(pa.array(offsets), W.signed(hashed[np.repeat(own, sizes)]))
        yield pa.RecordBatch.from_arrays([batch.column("class").filter(pa.array(own)), sets], ["class", "shingles"])


def _differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """hub, class, doc_id, excess (in parts of 100 + PERCENT) and size of each member's difference from the centre, how
    many of its elements no other member has, and the others, rarest first; what is lacking is inverted."""
    for batch in batches:
        found, centre = batch.column("found"), batch.column("centre")
        ends, centre_ends = found.offsets.to_numpy(), centre.offsets.to_numpy()
        held, key = (found.values.field(c).to_numpy() for c in ("held", "key"))
        centre_held, centre_key = (centre.values.field(c).to_numpy() for c in ("held", "key"))
        docs, n = batch.column("docs").to_numpy(), batch.column("n").to_numpy()
        elements = []
        for k in range(batch.num_rows):
            own, usual = slice(ends[k], ends[k + 1]), slice(centre_ends[k], centre_ends[k + 1])
            beyond = 2 * held[own] <= docs[k]
            lacking = ~np.isin(centre_key[usual], key[own])
            rarity = np.concatenate([held[own][beyond], docs[k] - centre_held[usual][lacking]])
            names = np.concatenate([key[own][beyond], ~centre_key[usual][lacking]])
            elements.append(names[np.lexsort((names, rarity))])
        singles = n - np.diff(ends)
        counts = np.array([len(e) for e in elements], np.int64)
        rare = pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(np.concatenate([np.empty(0, np.int64), *elements]))
        )
        size = singles + counts
        excess = (100 + PERCENT) * size - (100 - PERCENT) * n
        columns = [*(batch.column(c) for c in ("hub", "class", "doc_id")), pa.array(excess), pa.array(size), pa.array(singles), rare]
        yield pa.RecordBatch.from_arrays(columns, ["hub", "class", "doc_id", "excess", "size", "singles", "rare"])


def _forest(left: np.ndarray, right: np.ndarray, linked: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the same nodes as all links do, each node beyond the first of its tree by one."""
    at = {int(x): k for k, x in enumerate(left)}, {int(x): k for k, x in enumerate(right)}
    seen = np.zeros(n, bool)
    a, b = [], []
    for root in range(n):
        if seen[root]:
            continue
        seen[root] = True
        waiting = [root]
        while waiting:
            node = waiting.pop()
            near = [right[linked[at[0][node]]]] if node in at[0] else []
            near += [left[linked[:, at[1][node]]]] if node in at[1] else []
            new = np.unique(np.concatenate(near))
            new = new[~seen[new]]
            seen[new] = True
            a += [node] * len(new)
            b += new.tolist()
            waiting += new.tolist()
    return np.array(a, np.int64), np.array(b, np.int64)


_UNIT = ["hub", "i", "j"]
_HUB_DDL = "hub long, class long, hub_doc long, doc_id long, similar double, linked boolean"
_DIFFERENCE_DDL = "hub long, class long, doc_id long, excess long, size long, singles long, rare array<long>"


class _Compared:
    """Comparison of classes in units, first by sketches, then those left by texts."""

    def __init__(self, classes: DataFrame, docs: DataFrame, parts: int) -> None:
        self.classes, self.docs, self.parts = classes, docs, parts

    @staticmethod
    def _chosen(rows: DataFrame, ids: DataFrame) -> DataFrame:
        """The rows whose id is among ids (one column of the same name)."""
        wanted = folders.written(ids.distinct(), "chosen")
        wanted = F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted
        return rows.join(wanted, ids.columns, "left_semi")

    def _dealt(self, units: DataFrame, what: DataFrame) -> DataFrame:
        joined = units.join(what, "class")
        return joined.repartition(self.parts, *_UNIT).sortWithinPartitions(*_UNIT)

    def _texts(self, alive: DataFrame) -> DataFrame:
        """class, doc_id, set1 and the texts that the doc_id of each class has, equal ones once."""
        named = self._chosen(self.classes.select("class", "doc_id", "set1"), alive.select("class"))
        texts = self._chosen(self.docs, named.select("doc_id")).select("doc_id", "text").distinct()
        return named.join(texts, "doc_id")

    def _alive(self, units: DataFrame, percent: int) -> DataFrame:
        sketches = self._chosen(self.classes.select("class", "n", "sketch"), units.select("class"))
        sketched = self._dealt(units, sketches)
        left = sketched.mapInArrow(lambda b: _survivors(b, percent), "hub long, class long").distinct()
        return folders.written(left, "similar").join(self.classes.select("class", "n"), "class")

    def sized(self, members: DataFrame) -> DataFrame:
        """With room, what a class takes in a block of sketches."""
        return members.join(self.classes.select("class", F.greatest("n", F.lit(K)).alias("room")), "class")

    def all_pairs(self, members: DataFrame) -> DataFrame:
        """a, b: links that connect all that are similar in each group (hub, class, room)."""
        alive = self._alive(blocks(members, "room"), PERCENT)
        return self._dealt(blocks(alive, "n"), self._texts(alive)).mapInArrow(_links, "a long, b long")

    def with_hub(self, members: DataFrame) -> DataFrame:
        """hub, class, hub_doc, doc_id, similar, linked of the members of each group near its hub."""
        alive = self._alive(slices(self.sized(members), "room"), RING)
        return self._dealt(slices(alive, "n"), self._texts(alive)).mapInArrow(_to_hub, _HUB_DDL)

    def differences(self, members: DataFrame) -> DataFrame:
        """hub, class, doc_id, excess, size, singles, rare of the members (hub, class) of groups; those without a common
        shingle are left out."""
        texts = self._texts(members)
        sets = texts.mapInArrow(_own_sets, "class long, shingles array<long>").dropDuplicates(["class"])
        sets = folders.written(sets, "member-sets")
        each = members.join(sets, "class").select("hub", "class", F.explode("shingles").alias("shingle"))
        each = each.select("hub", "class", F.xxhash64("hub", "shingle").alias("key"))
        sizes = members.groupBy(F.col("hub").alias("of_hub")).agg(F.count(F.lit(1)).alias("docs"))
        shared = each.groupBy("hub", "key").agg(F.count(F.lit(1)).alias("held")).where("held > 1")
        shared = folders.written(lookup_join(shared, sizes, "hub", "of_hub").drop("of_hub"), "shared-shingles")
        usual = F.when(2 * F.col("held") > F.col("docs"), F.struct("held", "key"))
        centres = shared.groupBy(F.col("hub").alias("of_hub")).agg(F.max("docs").alias("docs"), F.collect_list(usual).alias("centre"))
        known = lookup_join(each, shared.select(F.col("key").alias("of_key"), "held"), "key", "of_key")
        known = known.groupBy("hub", "class").agg(F.collect_list(F.struct("held", "key")).alias("found"))
        known = lookup_join(known.join(self.classes.select("class", "doc_id", "n"), "class"), centres, "hub", "of_hub")
        return folders.written(known.mapInArrow(_differences, _DIFFERENCE_DDL), "differences")

    def told_apart(self, members: DataFrame) -> tuple[DataFrame, DataFrame]:
        """a, b: links that connect the core of each group (hub, class); and hub, class: smaller groups in which its
        other similar members meet. These have hubs below 0."""
        apart = self.differences(members)
        least = apart.groupBy(F.col("hub").alias("of_hub")).agg(F.min(F.struct("excess", "class", "doc_id")).alias("least"))
        apart = lookup_join(apart, least, "hub", "of_hub").drop("of_hub")
        apart = apart.withColumn("core", F.col("excess") + F.col("least.excess") <= 0)
        linked = apart.where("core AND class <> least.class").select(F.col("least.doc_id").alias("a"), F.col("doc_id").alias("b"))
        # of a pair, the one of more excess probes, and is not of the core
        beyond = apart.where("NOT core").groupBy(F.col("hub").alias("of_hub")).agg(F.min("excess").alias("next"))
        apart = lookup_join(apart, beyond, "hub", "of_hub")

        def first(other: F.Column) -> F.Column:
            """How many of rare are among the first elements, where a partner has this excess or more."""
            common = F.greatest(F.lit(1), F.ceil((F.col("excess") + other) / F.lit(2 * (100 + PERCENT))))
            return F.greatest(F.lit(0), F.col("size") - common + 1 - F.col("singles")).cast("int")

        apart = apart.withColumn("indexed", first(F.greatest("excess", "next")))
        apart = apart.withColumn("probing", F.when(F.col("core"), 0).otherwise(first(F.col("least.excess"))))
        most = F.slice("rare", F.lit(1), F.greatest("indexed", "probing"))
        entries = apart.select("class", "indexed", "probing", F.posexplode(most).alias("at", "key"))
        entries = entries.select("key", "class", (F.col("at") < F.col("indexed")).alias("indexed"), (F.col("at") < F.col("probing")).alias("probing"))
        entries = folders.written(entries, "rare-elements")
        live = entries.groupBy(F.col("key").alias("live_key")).agg(F.bool_or("indexed").alias("any"), F.bool_or("probing").alias("asked"))
        live = live.where("any AND asked").select("live_key")
        smaller = grouped(lookup_join(entries.select("key", "class"), live, "key", "live_key").select("key", "class"))
        return linked, smaller.select(F.bitwise_not("hub").alias("hub"), "class")


def _rest(members: DataFrame, near: DataFrame) -> DataFrame:
    """hub, class, free: what is to be compared after all members were compared with their hub."""
    told = members.where("class <> hub").join(near.select("hub", "class", "similar", "linked"), ["hub", "class"], "left")
    told = told.withColumn("free", ~F.coalesce("linked", F.lit(False)))
    ring = told.where("free").groupBy("hub").agg(F.max("similar").alias("ring")).withColumnRenamed("hub", "of_hub")
    told = lookup_join(told, ring, "hub", "of_hub")  # groups without a free member are done
    needed = F.col("similar") <= F.col("ring") + (1 - PERCENT / 100) + 1e-9
    return told.where(F.col("free") | needed).select("hub", "class", "free")


def links(classes: DataFrame, docs: DataFrame, parts: int) -> DataFrame:
    """a, b: links between the documents of classes (class, doc_id, set1, n, sketch) that connect all that are similar."""
    compared = _Compared(classes, docs, parts)
    members = folders.written(compared.sized(grouped(lists(classes))), "groups")
    sizes = members.groupBy("hub").agg(F.count(F.lit(1)).alias("docs"), F.max("room").alias("largest"))
    large = folders.written(sizes.where(_room("docs", "largest") > 1).select(F.col("hub").alias("large_hub")), "large-groups")
    small = members.join(large, F.col("hub") == F.col("large_hub"), "left_anti")
    found = [folders.written(compared.all_pairs(small), "near-links")]
    if not large.isEmpty():
        scores = members.groupBy(F.col("class").alias("of_class")).agg(F.sum("score").alias("total"))
        hot = folders.written(central(lookup_join(members, large, "hub", "large_hub"), scores), "large-members")
        near = folders.written(compared.with_hub(hot), "near-hubs")
        found.append(near.where("linked").select(F.col("hub_doc").alias("a"), F.col("doc_id").alias("b")))
        rest = folders.written(compared.sized(_rest(hot, near)), "left-over")
        sizes = rest.groupBy(F.col("hub").alias("of_hub")).agg(F.count(F.lit(1)).alias("docs"), F.max("room").alias("largest"))
        sizes = sizes.select("of_hub", (_room("docs", "largest") > 1).alias("wide"))
        told = lookup_join(rest, sizes, "hub", "of_hub").select("hub", "class", "room", "wide")
        core, smaller = compared.told_apart(told.where("wide").select("hub", "class"))
        found.append(folders.written(core, "near-cores"))
        smaller = folders.written(compared.sized(smaller).select("hub", "class", "room"), "smaller-groups")
        narrow = told.where("NOT wide").select("hub", "class", "room")
        found.append(folders.written(compared.all_pairs(narrow.unionByName(smaller)), "near-links"))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _several_texts(named: DataFrame, same: DataFrame) -> DataFrame:
    """a, b: the documents that stand for the sets of one doc_id."""
    set_columns = ["set1", "set2", "n"]
    spread = named.groupBy("doc_id").agg(*(f(c).alias(f"{k}_{c}") for c in set_columns for k, f in (("low", F.min), ("high", F.max))))
    several = spread.where(" OR ".join(f"low_{c} < high_{c}" for c in set_columns)).select("doc_id")
    rows = named.select("doc_id", *set_columns).join(several, "doc_id").distinct().join(same, set_columns)
    return rows.select(F.col("doc_id").alias("a"), F.col("lead").alias("b")).distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable over links) and kept, for every row."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = folders.written(signatures(wanted), "signatures")
    named = signed.where("doc_id IS NOT NULL AND n > 0")
    same = named.groupBy("set1", "set2", "n").agg(F.min("doc_id").alias("lead"))
    # every class once, by its smallest document
    key = ["set1", "set2", "n", "doc_id"]
    leads = same.select("set1", "set2", "n", F.col("lead").alias("doc_id"))
    classes = named.select(*key, "sketch").join(leads, key).dropDuplicates(key)
    classes = classes.select(F.monotonically_increasing_id().alias("class"), "doc_id", "set1", "n", "sketch")
    classes = folders.written(classes, "classes")  # numbered for good
    near = links(classes, wanted.where("doc_id IS NOT NULL"), parts)
    linked = components(near.unionByName(_several_texts(named, same)))
    member = signed.select("doc_id", "n", "set1", "set2").join(same, ["set1", "set2", "n"], "left")
    component = F.when(F.col("n") > 0, F.coalesce("component", "lead", "doc_id")).otherwise(F.col("doc_id"))
    return member.join(linked, F.col("lead") == F.col("node"), "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), component).alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )
