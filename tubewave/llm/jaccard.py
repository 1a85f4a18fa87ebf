"""Documents linked by the Jaccard similarity of their word shingles, with a prefix-tree join."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import begin, keeps, slices, texts_of
from .components import components, union_find

#: Sets that one prefix tree holds.
TREE_SETS = 500
#: Words whose digests a worker remembers.
REMEMBERED = 300_000
#: Bits of a shingle's digest that are counted, and shingles of a task that are sorted and cut into slices at a time.
COUNTED_BITS, BLOCK = 40, 500_000
#: Instead of a slice's number: the sets of a base. Bytes of repeated shingles that a task holds before it sends them.
TOLD, SENT_BYTES = -1, 16 << 20
#: A size class reaches so many times as far as sizes of similar sets can differ.
CLASS_STEPS = 3

_LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))
_ODD = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB]


class _Digests(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = digest = xxhash.xxh3_64_intdigest(word)
        return digest


_digests = _Digests()
keeps("jaccard", _digests.clear)


def shingles(text: bytes, size: int) -> tuple[int, np.ndarray]:
    """Digest of the word sequence (signed) and the sorted digests of its distinct shingles; a shorter text is one shingle."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0, np.zeros(0, np.uint64)
    own = np.fromiter(map(_digests.__getitem__, words), np.uint64, len(words))
    n = min(size, len(words))
    mixed = np.full(len(words) - n + 1, n, np.uint64)
    for k in range(n):
        mixed += own[k : len(own) - n + 1 + k] * np.uint64(_ODD[k % 8]) ^ np.uint64(k // 8)
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(_ODD[1])
    mixed ^= mixed >> np.uint64(29)
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(own.tobytes())).astype(np.int64))), np.unique(mixed)


def least_overlap(a: int, b: int, share: tuple[int, int]) -> int:
    """Smallest intersection with which sets of sizes a and b reach ``share[0] / share[1]`` of their union."""
    return -(-share[0] * (a + b) // (share[0] + share[1]))


def size_class(n: int, share: tuple[int, int]) -> tuple[int, int]:
    """Number and largest size of the class of ``n``; a set of one class can only reach the share with one of the next."""
    number, last = 0, 0
    while True:
        first = last + 1
        last = first
        for _ in range(CLASS_STEPS):
            last = last * share[1] // share[0]
        if n <= last:
            return number, last
        number += 1


def class_parts(last: int, share: tuple[int, int]) -> tuple[int, int]:
    """Parts into which sets of a class are cut, and how many of a set's parts may be empty without further ado.

    Sets that reach the share differ in ``2 last (1 - t) / (1 + t)`` elements at most, so all parts but that many are equal.
    """
    most = 2 * last * (share[1] - share[0]) // (share[1] + share[0])
    spare = most // 8
    return most + 1 + spare, spare


def classes_of(n: int, share: tuple[int, int]) -> list[int]:
    """Size classes in which a set of size ``n`` meets similar ones: its own and, where a similar set can be in it, the next."""
    number, last = size_class(n, share)
    return [number, number + 1] if n * share[1] // share[0] > last else [number]


def signatures(own: np.ndarray, share: tuple[int, int]) -> np.ndarray:
    """Digests of the parts of a sorted set, for its size class and, where a similar set can be in it, the next one.

    A search by parts needs no counts; ``similar_documents`` counts shingles instead, because parts that lie in a common passage
    join what is not similar.

    Two sets that reach the share have a digest in common: of their equal parts at least one is not empty, unless both have
    more empty parts than are spared, and then their empty parts have digests, too.
    """
    out = []
    number, last = size_class(len(own), share)
    schemes = [(number, last)]
    if len(own) * share[1] // share[0] > last:
        schemes.append(size_class(last + 1, share))
    for scheme, reach in schemes:
        parts, spare = class_parts(reach, share)
        at = ((own >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
        starts = np.concatenate(([0], np.flatnonzero(at[1:] != at[:-1]) + 1))
        sums = np.add.reduceat((own ^ (own >> np.uint64(29))) * np.uint64(_ODD[2]), starts)
        named = at[starts]
        if parts - len(named) > spare:
            empty = np.setdiff1d(np.arange(parts), named)
            named, sums = np.concatenate([named, empty]), np.concatenate([sums, np.zeros(len(empty), np.uint64)])
        mixed = sums + named.astype(np.uint64) * np.uint64(_ODD[3]) + np.uint64((scheme + 1) * _ODD[5] % (1 << 64))
        mixed ^= mixed >> np.uint64(32)
        out.append(mixed * np.uint64(_ODD[1]))
    return np.concatenate(out)


def packed(*columns: tuple[np.ndarray, int]) -> bytes:
    """Numbers of so many bytes each as planes of bytes, so that leading zeros cost nothing once they are compressed."""
    return np.concatenate([np.ascontiguousarray(c, "<u8").view(np.uint8).reshape(-1, 8)[:, :width].T for c, width in columns]).tobytes()


def unpacked(blob: bytes, *widths: int) -> list[np.ndarray]:
    planes = np.frombuffer(blob, np.uint8).reshape(sum(widths), -1)
    out, at = [], 0
    for width in widths:
        wide = np.zeros((planes.shape[1], 8), np.uint8)
        wide[:, :width] = planes[at : at + width].T
        out.append(wide.view("<u8").ravel())
        at += width
    return out


def counted_blobs(numbers: np.ndarray, sets: list[np.ndarray], slice_bits: int) -> Iterator[tuple[int, bytes]]:
    """Leading bits of all elements, in order, by slice (their first ``slice_bits``): number of the slice and its elements.

    An element is the distance to the one before it (five bytes) and the number of its set (four bytes).
    """
    values = np.concatenate(sets) >> np.uint64(64 - COUNTED_BITS)
    of = np.repeat(numbers.astype("<u4"), [len(s) for s in sets])
    order = np.argsort(values, kind="stable")
    values, of = values[order], of[order]
    at = values >> np.uint64(COUNTED_BITS - slice_bits)
    edges = np.concatenate(([0], np.flatnonzero(at[1:] != at[:-1]) + 1, [len(at)])).tolist()
    for start, stop in zip(edges[:-1], edges[1:], strict=True):
        yield int(at[start]), packed((np.diff(values[start:stop], prepend=np.uint64(0)), 5), (of[start:stop], 4))


def read_blob(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Elements and the numbers of their sets."""
    steps, of = unpacked(blob, 5, 4)
    return np.cumsum(steps), of


def repeated_blobs(bases: np.ndarray, elements: np.ndarray, numbers: np.ndarray) -> list[tuple[int, bytes]]:
    """Of a slice, the elements that are met more than once, for each base: in order, with the number of their set and how
    often they are met."""
    order = np.argsort(elements, kind="stable")
    starts = np.concatenate(([0], np.flatnonzero(np.diff(elements[order])) + 1, [len(elements)]))
    times = np.repeat(np.diff(starts), np.diff(starts))
    often = order[times > 1]
    times = times[times > 1]
    by_base = np.argsort(bases[often], kind="stable")
    often, times = often[by_base], times[by_base]
    edges = np.concatenate(([0], np.flatnonzero(np.diff(bases[often])) + 1, [len(often)])).tolist() if len(often) else [0]
    out = []
    for start, stop in pairwise(edges):
        own = often[start:stop]
        out.append((int(bases[own[0]]), packed((np.diff(elements[own], prepend=np.uint64(0)), 5), (numbers[own], 4), (times[start:stop], 4))))
    return out


def head_elements(sizes: np.ndarray, blobs: list[bytes], share: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of sets and the repeated elements of their heads, from all of ``repeated_blobs`` of a base.

    The order is by the times an element is met; elements met once come first and are no links, so that what a head has beyond
    them is left.
    """
    told = [unpacked(blob, 5, 4, 4) for blob in blobs]
    elements = np.concatenate([np.cumsum(steps) for steps, _, _ in told])
    of, times = (np.concatenate([one[k] for one in told]).astype(np.int64) for k in (1, 2))
    order = np.lexsort((elements, times, of))
    of, elements = of[order], elements[order]
    often = np.bincount(of, minlength=len(sizes))
    heads = often + 1 + -share[0] * sizes // share[1]
    kept = np.arange(len(of)) - (np.cumsum(often) - often)[of] < heads[of]
    return of[kept], elements[kept].astype(np.int64)


class PrefixTree:
    """Sets in a common order (elements of many sets first) as a tree whose edges hold runs of elements."""

    def __init__(self, sets: list[np.ndarray]):
        sizes = np.array([len(s) for s in sets])
        values, codes, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        rank = np.empty(len(values), np.int64)
        rank[np.lexsort((values, -times))] = np.arange(len(values))
        edges = np.concatenate(([0], np.cumsum(sizes)))
        self.width = len(values)
        self.sets = [np.sort(rank[codes[a:b]]) for a, b in zip(edges[:-1], edges[1:], strict=True)]
        order = sorted(range(len(sets)), key=lambda i: self.sets[i].astype(">u4").tobytes())
        # node: depth from, depth to, the set that spells the path, children, sets that end here, smallest and largest size below
        self.nodes: list[list] = [[0, 0, order[0], [], [], 0, 0]]
        path = [0]
        for at, i in enumerate(order):
            own = self.sets[i]
            shared = 0
            if at:
                before = self.sets[order[at - 1]]
                n = min(len(own), len(before))
                differ = np.flatnonzero(own[:n] != before[:n])
                shared = int(differ[0]) if len(differ) else n
            while len(path) > 1 and self.nodes[path[-1]][0] >= shared:
                path.pop()
            top = self.nodes[path[-1]]
            if top[1] > shared:  # split the edge
                below = [shared, top[1], top[2], top[3], top[4], 0, 0]
                top[1], top[3], top[4] = shared, [len(self.nodes)], []
                self.nodes.append(below)
            if shared < len(own):
                top[3].append(len(self.nodes))
                path.append(len(self.nodes))
                self.nodes.append([shared, len(own), i, [], [i], 0, 0])
            else:
                top[4].append(i)
        self.below = self._order()
        for k in reversed(self.below):
            own = self.nodes[k]
            reach = [len(self.sets[i]) for i in own[4]] + [self.nodes[c][j] for c in own[3] for j in (5, 6)]
            own[5], own[6] = min(reach), max(reach)

    def _order(self) -> list[int]:
        out = [0]
        for k in out:
            out.extend(self.nodes[k][3])
        return out

    def links(self, share: tuple[int, int], groups: list[int]) -> list[tuple[int, int]]:
        """Pairs (of positions) that reach the share and join two groups which no earlier pair has joined.

        ``groups`` are numbers of sets that are known to be joined. A probe goes down the tree, carries the overlap with the
        path, and leaves a branch where even the best rest cannot reach the share, or where all sets are in its own group.
        """
        find, unite = union_find(len(self.sets))
        first: dict[int, int] = {}
        for i, group in enumerate(groups):
            unite(i, first.setdefault(group, i))
        nodes, found = self.nodes, []
        one_group = self._one_group(find)
        for i in sorted(range(len(self.sets)), key=lambda i: len(self.sets[i])):
            own = self.sets[i]
            has = np.zeros(self.width, bool)
            has[own] = True
            changed = False
            stack = [(0, 0)]
            while stack:
                k, overlap = stack.pop()
                start, stop, spelled, children, ends, least, most = nodes[k]
                if one_group[k] >= 0 and find(one_group[k]) == find(i):
                    continue
                if stop > start:
                    run = self.sets[spelled][start:stop]
                    overlap += int(np.count_nonzero(has[run]))
                    rest = len(own) - int(np.searchsorted(own, run[-1], "right"))
                    size = min(max(stop + rest, least), most)
                    if overlap + min(size - stop, rest) < least_overlap(size, len(own), share):
                        continue
                for j in ends:
                    if find(j) != find(i) and overlap >= least_overlap(len(self.sets[j]), len(own), share):
                        unite(i, j)
                        found.append((i, j))
                        changed = True
                stack.extend((c, overlap) for c in children)
            if changed:
                one_group = self._one_group(find)
        return found

    def _one_group(self, find: Callable[[int], int]) -> list[int]:
        """For each node a set below it if all of those are in one group, else -1."""
        out = [-1] * len(self.nodes)
        for k in reversed(self.below):
            own = self.nodes[k]
            members = own[4] + [out[c] for c in own[3]]
            if -1 not in members and len({find(m) for m in members}) == 1:
                out[k] = members[0]
        return out


def similar_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 3, share: tuple[int, int] = (90, 100)) -> DataFrame:
    """``key, n_shingles, component_id`` for every row of ``docs``.

    Words are split at ASCII white space after A-Z became a-z; a set holds the distinct shingles of ``size`` words, or the
    whole sequence if there are fewer. Sets are linked if their intersection is ``share`` of their union or more.
    ``component_id`` is the smallest key reachable by links. NULL and empty texts have no shingles and link with nothing, so
    their component is their own key. NULL keys count as keys larger than all; repeated rows and copies link like any other.

    1. Rows with the same word sequence are one set (64-bit digest).
    2. Shingles are ordered by the number of sets that have them. Of two similar sets, the heads in this order (a set's rarest
       shingles, as many as it may miss and one more) have a shingle in common, and one that only one set has is no link. So shingles
       are counted first, as slices of sorted digests, and only those met more than once come back to their sets, packed for about
       ``BLOCK`` shingles of sets that were read one after the other. Each shingle of heads links its sets of a size class to the smallest of them, which is linear; the components of these links are
       clusters outside of which no set can have a partner.
    3. A cluster is dealt to trees of at most ``TREE_SETS`` sets, the smallest set being in each. Where a cluster has several
       trees and is not in one piece yet, the sets outside its largest piece meet every tree, again in groups of that size.
    """
    lead = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.xxhash64(text).alias("row"))
    kind = lead.schema["key"].dataType.simpleString()

    slice_bits = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 4 - 1, 255).bit_length()
    names = ["key", "row", "uid", "n", "slice", "base", "blob"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("jaccard")
        base = TaskContext.get().partitionId() << 32
        held: list[tuple[int, np.ndarray]] = []  # sets whose shingles wait to be sorted; they share a base and are numbered from 0

        def blobs(schema: pa.Schema) -> pa.RecordBatch:
            sets = [own for _, own in held]
            told = packed((np.array([uid for uid, _ in held], np.int64), 8), (np.array([len(own) for own in sets]), 8))
            found = [(TOLD, told), *counted_blobs(np.arange(len(held)), sets, slice_bits)]
            own = [pa.nulls(len(found), schema.field(c).type) for c in names[:4]]
            columns = [pa.array([k for k, _ in found], pa.int32()), pa.array([base] * len(found), pa.int64()), pa.array([b for _, b in found], pa.binary())]
            return pa.RecordBatch.from_arrays([*own, *columns], schema=schema)

        for batch in slices(batches, "text"):
            seen: set[int] = set()
            uids, sizes = [], []
            for body in texts_of(batch, "text"):
                uid, own = shingles(body, size)
                uids.append(uid if len(own) else None)
                sizes.append(len(own))
                if len(own) and uid not in seen:
                    held.append((uid, own))
                seen.add(uid)
            columns = [batch.column("key"), batch.column("row"), pa.array(uids, pa.int64()), pa.array(sizes, pa.int64())]
            rows = pa.RecordBatch.from_arrays([*columns, *(pa.nulls(batch.num_rows, kind) for kind in (pa.int32(), pa.int64(), pa.binary()))], names)
            yield rows
            if sum(len(own) for _, own in held) >= BLOCK:
                yield blobs(rows.schema)
                base, held = base + 1, []
        if held:
            yield blobs(rows.schema)

    def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What slices have more than once, by base; a task's slices are told together."""
        begin("jaccard")
        at, held, out = None, [], []

        def sent() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.int64()), pa.array([b for _, b in out], pa.binary())], ["base", "blob"])

        def found() -> list[tuple[int, bytes]]:
            told = [read_blob(blob) for _, blob in held]
            bases = np.repeat(np.array([base for base, _ in held], np.int64), [len(e) for e, _ in told])
            return repeated_blobs(bases, *(np.concatenate(side) for side in zip(*told, strict=True)))

        for batch in batches:
            for own, base, blob in zip(*(batch.column(c) for c in ("slice", "base", "blob")), strict=True):
                if own.as_py() != at and held:
                    out += found()
                    held = []
                    if sum(len(b) for _, b in out) >= SENT_BYTES:
                        yield sent()
                        out = []
                held.append((base.as_py(), blob.as_py()))
                at = own.as_py()
        if held:
            out += found()
        if out:
            yield sent()

    def head_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("jaccard")
        at, uids, sizes, held = None, np.zeros(0, np.int64), np.zeros(0, np.int64), []

        def found() -> pa.RecordBatch:
            of, tokens = head_elements(sizes, held, share)
            classes = {int(n): classes_of(int(n), share) for n in np.unique(sizes[of])}
            first, last = (np.array([classes[n][k] for n in sizes[of].tolist()], np.int32) for k in (0, -1))
            more = last != first
            columns = [(uids[of], uids[of[more]]), (first, last[more]), (tokens, tokens[more])]
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in columns], ["uid", "class", "token"])

        for batch in batches:
            for own, base, blob in zip(*(batch.column(c) for c in ("slice", "base", "blob")), strict=True):
                if base.as_py() != at:
                    if held:
                        yield found()
                    at, held = base.as_py(), []
                if own.as_py() == TOLD:  # the first row of a base
                    uids, sizes = (c.astype(np.int64) for c in unpacked(blob.as_py(), 8, 8))
                else:
                    held.append(blob.as_py())
        if held:
            yield found()

    written = cut_lineage(lead.mapInArrow(read, f"key {kind}, row long, uid long, n long, slice int, base long, blob binary"), "shingles")
    rows = written.where("slice IS NULL").select("key", "row", "uid", "n")
    told = written.where("slice IS NOT NULL").select("slice", "base", "blob")
    sliced = told.where(f"slice <> {TOLD}").repartition("slice").sortWithinPartitions("slice")
    often = sliced.mapInArrow(repeated, "base long, blob binary").select(F.lit(TOLD + 1).alias("slice"), "base", "blob")
    gathered = told.where(f"slice = {TOLD}").unionByName(often).repartition("base").sortWithinPartitions("base", "slice")
    parts = cut_lineage(gathered.mapInArrow(head_rows, "uid long, class int, token long"), "heads")
    smallest = parts.groupBy("token", "class").agg(F.min("uid").alias("low"), F.max("uid").alias("high")).where("low < high").select("token", "class", "low")
    stars = parts.join(smallest, ["token", "class"]).where("uid <> low").select(F.col("low").alias("a"), F.col("uid").alias("b")).distinct()
    clusters = components(stars).withColumnRenamed("node", "uid").withColumnRenamed("component", "cluster")

    counts = clusters.groupBy("cluster").agg(F.count("*").alias("members"))
    dealt = clusters.join(counts, "cluster").withColumn("trees", F.ceil(F.col("members") / TREE_SETS).cast("int"))
    dealt = dealt.withColumn("tree", F.pmod(F.xxhash64("uid"), F.col("trees")).cast("int"))
    # one row stands for all rows of its word sequence
    chosen = rows.where("uid IS NOT NULL").groupBy("uid").agg(F.min(F.struct("row", "key")).alias("one")).select("uid", "one.row", F.col("one.key").alias("key"))
    chosen = cut_lineage(chosen.join(dealt, "uid"), "members")

    # texts of members travel once, by shuffle whatever the size: members have no bound, so they are never broadcast
    holders = chosen.select("uid", F.col("row").alias("of"), F.col("key").alias("holder")).hint("merge")
    bodies = lead.join(holders, (F.col("row") == F.col("of")) & F.col("key").eqNullSafe(F.col("holder"))).select("uid", "text")
    bodies = cut_lineage(bodies, "member-texts")

    # the cluster's smallest set goes to all of its trees
    places = chosen.select("uid", "cluster", F.expr("explode(if(uid = cluster, sequence(0, trees - 1), array(tree)))").alias("tree"))
    links = cut_lineage(_tree_links(bodies, places.withColumn("part", F.lit(0)).withColumn("joined", F.col("uid")), size, share), "tree-links")

    several = chosen.where("trees > 1").select("uid", "cluster", "tree", "trees")
    if not several.isEmpty():
        joined = components(links).withColumnRenamed("node", "uid")
        state = cut_lineage(several.join(joined, "uid", "left").withColumn("joined", F.coalesce("component", "uid")).drop("component"), "pieces")
        pieces = state.groupBy("cluster", "joined").agg(F.count("*").alias("n"))
        largest = pieces.groupBy("cluster").agg(F.max(F.struct("n", F.col("joined"))).alias("top"), F.count("*").alias("pieces")).where("pieces > 1").select("cluster", F.col("top.joined").alias("top"))
        state = state.join(largest, "cluster")
        outside = state.where("joined <> top").groupBy("cluster").agg(F.count("*").alias("outside"))
        state = state.join(outside, "cluster").withColumn("parts", F.ceil(F.col("outside") / TREE_SETS).cast("int"))
        home = state.select("uid", "cluster", "tree", F.expr("explode(sequence(0, parts - 1))").alias("part"), "joined")
        foreign = state.where("joined <> top").select("uid", "cluster", F.expr("explode(sequence(0, trees - 1))").alias("tree"), F.pmod(F.xxhash64("uid", F.lit(7)), F.col("parts")).cast("int").alias("part"), "joined")
        links = links.union(_tree_links(bodies, home.union(foreign), size, share))

    joined = components(links).withColumnRenamed("node", "uid")
    named = rows.join(joined, "uid", "left").withColumn("class", F.coalesce("component", "uid"))
    named = cut_lineage(named.select("key", "n", "class"), "classes")
    low = named.where("class IS NOT NULL").groupBy("class").agg(F.min("key").alias("low"))
    return named.join(low, "class", "left").select(F.col("key").alias(key), F.col("n").alias("n_shingles"), F.coalesce("low", "key").alias("component_id"))


def _tree_links(bodies: DataFrame, places: DataFrame, size: int, share: tuple[int, int]) -> DataFrame:
    """Links ``a, b`` found by trees, one for each ``cluster, tree, part`` of ``places``, of the sets of ``bodies`` (``uid, text``).

    The text travels, because it is smaller than its digests; the tree's task makes the set.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("jaccard")
        group: tuple | None = None
        held: dict[int, tuple[np.ndarray, int]] = {}

        def links() -> list[tuple[int, int]]:
            uids = list(held)
            if len(uids) < 2:
                return []
            tree = PrefixTree([held[u][0] for u in uids])
            return [(uids[i], uids[j]) for i, j in tree.links(share, [held[u][1] for u in uids])]

        def out(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], ["a", "b"])

        for batch in slices(batches, "text"):
            found: list[tuple[int, int]] = []
            columns = [batch.column(c).to_pylist() for c in ("cluster", "tree", "part", "uid", "joined")]
            for cluster, tree, part, uid, joined, body in zip(*columns, texts_of(batch, "text"), strict=True):
                if (cluster, tree, part) != group:
                    found += links()
                    group, held = (cluster, tree, part), {}
                if uid not in held:
                    held[uid] = (shingles(body, size)[1], joined)
            if found:
                yield out(found)
        if found := links():
            yield out(found)

    dealt = bodies.join(places, "uid").select("cluster", "tree", "part", "uid", "text", "joined").repartition("cluster", "tree", "part").sortWithinPartitions("cluster", "tree", "part")
    return dealt.mapInArrow(run, "a long, b long").distinct()
