"""Exact Jaccard join of documents as sets of word n-grams, by pivots in the metric space of Jaccard distance.

Documents of equal sets are one point.  First come cells: the points that have the same smallest n-gram, under each of a
few random orders, make a cell with one of them as pivot, as near points mostly have it in common; each point is compared
with its pivots alone.  So a large group of near copies is mostly one component before any two others are compared, and
from then on only points of different components are.

Two points within the threshold share some of their rarest n-grams, so the n-grams cut the space into regions to look
at.  A region whose points are one component already is left out where it is found.  A small region is compared whole.  A larger one gets a pivot: every
point's exact distance to it is computed, points within the threshold are linked to it, and by the triangle inequality
two points can only be linked if their distances to the pivot differ by no more than the threshold.  So the region
falls into rings around the pivot, each overlapping the next by one threshold; rings whose points are all linked
already are done, and the others are regions again, with pivots of their own, until nothing is left or rings no longer
part their points; what is left then is compared in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinledger.llm.common import cut, join_heavy, partitions, slices
from twinledger.llm.graphs import components
from twinledger.llm.substring_dedup import _planes, _whole, rolling, words_hashed

SLICE = 300_000
CELLS = 1 << 20
CHUNK = 1 << 12
SMALL = 48  # points of a region of rare shingles that are compared one by one
WHOLE = 256  # points of a ring
BLOCK = 512  # points of a ring that meet as many others in one task
ORDERS = np.array([0, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)  # each of the random orders of n-grams, by xor


def shingles(words: list[bytes], word_hash, n: int) -> np.ndarray:
    """Hashes of the distinct n-word shingles, ascending; fewer words are one shingle."""
    if not words:
        return np.empty(0, np.uint64)
    values = np.fromiter(map(word_hash, words), np.uint64, len(words))
    return np.unique(rolling(values, min(n, len(values))))


def point(found: np.ndarray) -> int:
    """One number for a set: a 64-bit hash, as a signed integer."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(found.tobytes())).astype(np.int64))


def least_overlap(n, percent: int):
    """An overlap that a set of n shares at least with any set it is linked to."""
    return -(-n * percent // 100)


def lead(n, percent: int):
    """How many of the rarest shingles two linked sets have in common at least, among their `prefix` rarest ones."""
    return 1 + n // 20 if percent < 100 else n * 0 + 1


def prefix(n, percent: int):
    return np.minimum(n, n - least_overlap(n, percent) + lead(n, percent))


def most_partner(n, place, percent: int):
    """The largest size of a set linked to one of n whose first shared shingle, rarest first, has this place (from 0).

    They share n - place shingles at most, and percent / (100 + percent) of both sizes at least.
    """
    return (100 + percent) * (n - place) // percent - n


def read_sets(docs: DataFrame, n: int) -> DataFrame:
    """For each document: doc_id, row, point, size, firsts (its smallest shingle in each of ORDERS); and counts of shingles by
    hash cell, in rows of CHUNK cells.

    docs: key (struct of id and row), text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word_hash = words_hashed.__getitem__
        cells = np.zeros(CELLS, np.uint32)
        names = ["doc_id", "row", "point", "size", "firsts", "chunk", "counts"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.binary()]
        for held in slices(batches, "key", "text", SLICE, bytes.lower):
            rows = []
            for key, words in held:
                found = shingles(words, word_hash, n)
                np.add.at(cells, (found & np.uint64(CELLS - 1)).astype(np.int64), 1)
                firsts = [int((found ^ x).min().astype(np.int64)) for x in ORDERS] if len(found) else None
                rows.append((key["id"], key["row"], point(found) if len(found) else None, len(found), firsts, None, None))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)
        full = [(None, None, None, None, None, i, _packed(part)) for i, part in enumerate(cells.reshape(-1, CHUNK)) if part.any()]
        if full:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*full), kinds)], names=names)

    return docs.mapInArrow(run, "doc_id long, row long, point long, size long, firsts array<long>, chunk int, counts binary")


def _packed(a: np.ndarray) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(_planes(a))


def _unpacked(data: bytes, kind) -> np.ndarray:
    import zstandard

    return _whole(zstandard.ZstdDecompressor().decompress(data), kind)


def cell_counts(parts: DataFrame) -> np.ndarray:
    """Shingles in each cell over all documents.  The table has CELLS entries whatever the input."""

    def add(table: pa.Table) -> pa.Table:
        total = sum(_unpacked(x, np.uint32).astype(np.uint64) for x in table["counts"].to_pylist())
        total = np.minimum(total, np.iinfo(np.uint32).max).astype(np.uint32)
        return pa.table({"chunk": table["chunk"][:1], "counts": pa.array([_packed(total)], pa.binary())})

    out = np.zeros((CELLS // CHUNK, CHUNK), np.uint32)
    for row in parts.groupBy("chunk").applyInArrow(add, "chunk int, counts binary").toLocalIterator():
        out[row.chunk] = _unpacked(bytes(row.counts), np.uint32)
    return out.ravel()


PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("shared", pa.int64()), ("hits", pa.int64()), ("least", pa.int64()), ("region", pa.int64())])
PAIR_DDL = "a long, b long, shared long, hits long, least long, region long"
#: A point in a region: its size, above that the shingle's place, above that whether all of its prefix is in small regions.
PLACE, RARE = 40, 62
TRIED = 1024  # pairs that are looked at for each point of a large region, by sizes and labels alone


def partners(p: np.ndarray, size: np.ndarray, most: np.ndarray, label: np.ndarray, percent: int, allowed: int) -> tuple[np.ndarray | None, np.ndarray]:
    """Pairs (i, k) of one region's points, ascending by size, that can be linked by this shingle as the first they
    share, and the points that have some; no pairs (None) if they are more than `allowed` for each point.

    Only points of other labels than the most frequent one look for partners, each among the sizes it can be linked to,
    so a large group that is one component costs nothing.
    """
    names, n = np.unique(label, return_counts=True)
    main = label == names[np.argmax(n)]
    z = np.flatnonzero(~main)
    low = np.searchsorted(size, least_overlap(size[z], percent))
    wide = np.maximum(np.searchsorted(size, np.minimum(most[z], size[z] * 100 // percent), "right") - low, 0)
    ends = np.cumsum(wide)
    if len(z) and ends[-1] > TRIED * len(p):
        return None, np.arange(len(p))
    out, count, start = [np.empty((2, 0), np.int64)], 0, 0
    own = np.zeros(len(p), bool)
    while start < len(z):
        end = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + (1 << 20), "right")))
        w = wide[start:end]
        i = np.repeat(z[start:end], w)
        k = np.arange(len(i)) - np.repeat(np.cumsum(w) - w, w) + np.repeat(low[start:end], w)
        good = (label[i] != label[k]) & (most[k] >= size[i]) & (main[k] | (i < k))
        i, k = i[good], k[good]
        own[i], own[k] = True, True
        count += len(i)
        if count <= allowed * len(p):
            out.append(np.stack([i, k]))
        start = end
    return (np.concatenate(out, axis=1) if count <= allowed * len(p) else None), np.flatnonzero(own)


def first_regions(docs: DataFrame, counts: np.ndarray, n: int, percent: int) -> DataFrame:
    """Pairs to look at (a < b, region null), with how many rare shingles they share in small regions, how many of these
    can be the first they share, and how many they have to share; and the members a of large regions, of size `least`
    (region not null).

    Two linked sets have a first shared shingle, rarest first.  What stands before it in each bounds their overlap, and
    with it the size of the other.  In a small region all pairs are made, and counted; in a large one only those that
    can be linked by its shingle as their first.  Points that share much beyond their rarest shingles, but not enough to
    be linked, so meet nowhere.  Only regions with very many such pairs are left as members.

    docs: key (struct of id, row and label), text.  Points of one label are linked already: they make no pair, and a
    large region of one label is left out.
    """
    spark = docs.sparkSession
    order = spark.sparkContext.broadcast(counts)
    buckets = 2 * partitions(spark)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word_hash = words_hashed.__getitem__
        for held in slices(batches, "key", "text", SLICE, bytes.lower):
            points, lists, sizes = [], [], []
            seen: set[int] = set()
            for key, words in held:
                found = shingles(words, word_hash, n)
                p = point(found)
                if not len(found) or p in seen:
                    continue
                seen.add(p)
                label = p if key["label"] is None else key["label"]
                often = order.value[(found & np.uint64(CELLS - 1)).astype(np.int64)]
                m = len(found)
                rare = np.lexsort((found, often))[: prefix(m, percent)]
                # a shingle of a cell of SMALL documents at most lies in a small region
                sizes.append(m | np.minimum(np.arange(len(rare)), (1 << RARE - PLACE) - 1) << PLACE | int(often[rare[-1]] <= SMALL) << RARE)
                points.append((p, label))
                lists.append(found[rare])
            if not lists:
                continue
            h = np.concatenate(lists)
            doc = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
            bucket = (h >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
            by = np.lexsort((doc, bucket))
            h, bucket = h[by], bucket[by]
            p, label = (np.array(points, np.int64)[doc[by]]).T
            size = np.concatenate(sizes)[by]
            cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))
            rows = [(int(bucket[a]), h[a:b].tobytes(), p[a:b].tobytes(), _packed(size[a:b]), _packed(label[a:b] ^ p[a:b])) for a, b in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), *[pa.binary()] * 4))], names=["bucket", "h", "p", "size", "label"])

    def meet(table: pa.Table) -> pa.Table:
        h = np.concatenate([np.frombuffer(x, np.uint64) for x in table["h"].to_pylist()])
        by = np.argsort(h)
        same = h[by][1:] == h[by][:-1]
        pick = by[np.concatenate([[False], same]) | np.concatenate([same, [False]])]
        p = np.concatenate([np.frombuffer(x, np.int64) for x in table["p"].to_pylist()])[pick]
        size = np.concatenate([_unpacked(x, np.int64) for x in table["size"].to_pylist()])[pick]
        label = np.concatenate([_unpacked(x, np.int64) for x in table["label"].to_pylist()])[pick] ^ p
        h = h[pick]
        by = np.lexsort((p, size & (1 << PLACE) - 1, h))
        h, p, size, label = h[by], p[by], size[by], label[by]
        own = np.concatenate([[True], (h[1:] != h[:-1]) | (p[1:] != p[:-1])]) if len(h) else np.empty(0, bool)
        h, p, size, label = h[own], p[own], size[own], label[own]
        cuts = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1], [True]])) if len(h) else np.zeros(1, int)
        if len(h):  # regions of one label are done
            apart = np.minimum.reduceat(label, cuts[:-1]) != np.maximum.reduceat(label, cuts[:-1])
            left = np.repeat(apart, np.diff(cuts))
            h, p, size, label = h[left], p[left], size[left], label[left]
            cuts = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1], [True]])) if len(h) else np.zeros(1, int)
        rare, place, size = size >> RARE, size >> PLACE & (1 << RARE - PLACE) - 1, size & (1 << PLACE) - 1
        most = most_partner(size, place, percent)
        width = np.diff(cuts)
        end = np.repeat(cuts[1:], width)
        small = np.repeat(width, width) <= SMALL
        pairs, members = [np.empty((5, 0), np.int64)], []
        for step in range(1, SMALL):
            i = np.flatnonzero(small & (np.arange(len(h)) + step < end))
            if not len(i):
                break
            i = i[(size[i] >= least_overlap(size[i + step], percent)) & (label[i] != label[i + step])]
            k = i + step
            pairs.append(np.stack([p[i], p[k], (most[i] >= size[k]) & (most[k] >= size[i]), np.where(rare[i] | rare[k], lead(size[i], percent), 1), np.ones(len(i), np.int64)]))
        for x, y in zip(cuts[:-1][width > SMALL], cuts[1:][width > SMALL]):
            found, own = partners(p[x:y], size[x:y], most[x:y], label[x:y], percent, SMALL)
            if found is None:
                members.append(x + own)
            else:
                pairs.append(np.concatenate([p[x:y][found], np.ones((3, found.shape[1]), np.int64)]))
        first, second, hit, least, one = np.concatenate(pairs, axis=1)
        a, b = np.minimum(first, second), np.maximum(first, second)
        by = np.lexsort((b, a))
        a, b, hit, least, one = a[by], b[by], hit[by], least[by], one[by]
        start = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])) if len(a) else np.empty(0, int)
        if len(a):
            hit, least, one = np.add.reduceat(hit, start), np.maximum.reduceat(least, start), np.add.reduceat(one, start)
        out = [pa.Table.from_arrays([pa.array(c, pa.int64()) for c in (a[start], b[start], one, hit, least)] + [pa.nulls(len(start), pa.int64())], schema=PAIR)]
        if members:
            big = np.concatenate(members)
            none = pa.nulls(len(big), pa.int64())
            out.append(pa.Table.from_arrays([pa.array(p[big]), none, none, none, pa.array(size[big]), pa.array(h[big].astype(np.int64))], schema=PAIR))
        return pa.concat_tables(out)

    sent = docs.mapInArrow(send, "bucket int, h binary, p binary, size binary, label binary")
    return sent.groupBy("bucket").applyInArrow(meet, PAIR_DDL)


def overlaps(pairs: DataFrame, texts: DataFrame, n: int, percent: int, rows: int = 1500) -> DataFrame:
    """a, b, inter, na, nb for each pair (a, b, must).

    Pairs that need not be answered are left out where the others link their points already.  texts: point, text.
    A pair goes to the part of the smaller of its points' smallest partners, a part of many pairs is dealt out by the
    pair's other point, and each part gets the texts of its points once.
    """
    ends = pairs.select(F.col("a").alias("x"), F.col("b").alias("y")).unionByName(pairs.select(F.col("b").alias("x"), F.col("a").alias("y")))
    hub = ends.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("hub"))
    led = pairs.join(hub.select(F.col("x").alias("a"), F.col("hub").alias("ha")), "a").join(hub.select(F.col("x").alias("b"), F.col("hub").alias("hb")), "b")
    led = led.select("a", "b", "must", F.least("ha", "hb").alias("hub"))
    many = led.groupBy("hub").agg(F.count("*").alias("n"))
    led = cut(led.join(many, "hub").select(
        "a", "b", "must", F.xxhash64("hub", F.when(F.col("n") > rows, F.pmod(F.xxhash64(F.when(F.col("hub") == F.col("a"), F.col("b")).otherwise(F.col("a"))), F.ceil(F.col("n") / rows))).otherwise(0)).alias("part")))
    parts = max(1, led.count() // rows)
    led = led.withColumn("part", F.pmod("part", F.lit(parts)))
    needs = led.select(F.col("part").alias("at"), F.explode(F.array("a", "b")).alias("point")).distinct()
    held = texts.join(needs, "point").select("at", "point", "text")

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        word_hash = words_hashed.__getitem__
        sets = {p: shingles(t.lower().split(), word_hash, n) for p, t in zip(left["point"].to_pylist(), left["text"].cast(pa.large_binary()).to_pylist())}
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while (y := root.get(x, x)) != x:
                root[x] = root.get(y, y)
                x = y
            return x

        out = []
        right = right.sort_by([("must", "descending"), ("a", "ascending"), ("b", "ascending")])
        for a, b, must in zip(right["a"].to_pylist(), right["b"].to_pylist(), right["must"].to_pylist()):
            if not must and find(a) == find(b):
                continue
            x, y = sets[a], sets[b]
            if len(x) > len(y):
                x, y = y, x
            inter = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
            if 100 * inter >= percent * (len(x) + len(y) - inter):
                root[find(a)] = find(b)
            out.append((a, b, inter, len(sets[a]), len(sets[b])))
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out) if out else [()] * 5)], names=["a", "b", "inter", "na", "nb"])

    return held.groupBy("at").cogroup(led.groupBy("part")).applyInArrow(run, "a long, b long, inter long, na long, nb long")


def linked(percent: int):
    return F.col("inter") * 100 >= percent * (F.col("na") + F.col("nb") - F.col("inter"))


def links(docs: DataFrame, n: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text", rounds: int = 4) -> tuple[DataFrame, DataFrame]:
    """(points, labels).  points: doc_id, point, size for each row; labels: node, label for each point that has a link,
    the label being the smallest point that links reach."""
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # an id may be null or stand for several texts, so texts are found again by a hash of both
    slim = slim.select(F.struct("id", F.xxhash64("id", "text").alias("row")).alias("key"), "text")
    both = cut(read_sets(slim, n))
    rows = both.where("chunk is null").select("doc_id", "row", "point", "size")
    points = rows.drop("row")
    counts = cell_counts(both.where("chunk is not null").select("chunk", "counts"))

    def texts_of(wanted: DataFrame) -> DataFrame:
        """One text for each point wanted; only these travel."""
        chosen = rows.join(wanted, "point").groupBy("point").agg(F.min("row").alias("row"))
        return cut(slim.select(F.col("key.row").alias("row"), "text").join(chosen, "row").dropDuplicates(["point"]).select("point", "text"))

    ends = lambda pairs: pairs.select(F.explode(F.array("a", "b")).alias("point"))
    stars = cut(cell_pairs(both.where("point is not null").select("point", "firsts")))
    first_wanted = cut(ends(stars).distinct())
    texts = texts_of(first_wanted)
    known = cut(overlaps(stars, texts, n, percent))
    labels = components(known.where(linked(percent)))

    of_row = rows.join(labels, rows.point == labels.node).select("row", "label").dropDuplicates(["row"])
    named = slim.select("key.id", "key.row", "text").join(of_row, "row", "left").select(F.struct("id", "row", "label").alias("key"), "text")
    met = cut(first_regions(named, counts, n, percent))
    near = met.where("region is null").groupBy("a", "b").agg(F.sum("shared").alias("shared"), F.sum("hits").alias("hits"), F.max("least").alias("least")).where("shared >= least and hits > 0").select("a", "b", F.lit(False).alias("must"))
    members = with_pivots(met.where("region is not null").select("region", F.col("a").alias("p"), F.col("least").alias("size")))
    pivots = members.where("p <> pivot").select(F.least("p", "pivot").alias("a"), F.greatest("p", "pivot").alias("b"), F.lit(True).alias("must"))
    pairs = near.unionByName(pivots).groupBy("a", "b").agg(F.max("must").alias("must"))
    pairs = cut(pairs.join(known.select("a", "b"), ["a", "b"], "left_anti"))
    wanted = ends(pairs).unionByName(members.select(F.col("p").alias("point"))).distinct().join(first_wanted, "point", "left_anti")
    texts = texts.unionByName(texts_of(wanted))

    def joined_up(found: DataFrame) -> DataFrame:
        return components(labels.select(F.col("node").alias("a"), F.col("label").alias("b")).unionByName(found))

    new = cut(overlaps(pairs, texts, n, percent))
    labels, known = joined_up(new.where(linked(percent)).select("a", "b")), known.unionByName(new)
    regions, before = members, members.count()
    used = members.select(F.col("pivot").alias("p")).distinct()
    while before:
        rounds -= 1
        regions = cut(rings(regions, known, labels, percent, used))
        # rings that do not part the points of their regions are compared in blocks, as are small ones
        before, last = (m := regions.count()), rounds == 0 or m >= before
        if not m:
            break
        found = cut(block_links(regions if last else regions.where("not large"), texts, n, percent))
        if last:
            labels = joined_up(found)
            break
        used = used.unionByName(regions.select(F.col("pivot").alias("p"))).distinct()
        star = regions.where("large and p <> pivot").select(F.least("p", "pivot").alias("a"), F.greatest("p", "pivot").alias("b"), F.lit(True).alias("must")).distinct()
        pairs = cut(star.join(known, ["a", "b"], "left_anti"))
        # a round without new pairs is not the last: large regions still fall into the rings of their next pivot
        if not pairs.isEmpty():
            new = cut(overlaps(pairs, texts, n, percent))
            found, known = found.unionByName(new.where(linked(percent)).select("a", "b")), known.unionByName(new)
        labels = joined_up(found)
        regions = regions.where("large")
    return points, labels


def cell_pairs(points: DataFrame) -> DataFrame:
    """a, b, must: each point and the pivot of each of its cells, the smallest point of the same smallest shingle."""
    firsts = points.dropDuplicates(["point"]).select("point", F.posexplode("firsts").alias("k", "h"))
    cells = firsts.groupBy("k", "h").agg(F.min("point").alias("pivot"), F.count("*").alias("n")).where("n > 1")
    pairs = firsts.join(cells, ["k", "h"]).where("point <> pivot")
    return pairs.select(F.least("point", "pivot").alias("a"), F.greatest("point", "pivot").alias("b"), F.lit(False).alias("must")).distinct()


def with_pivots(members: DataFrame) -> DataFrame:
    """Members with the pivot of their region: the member that lies in most regions, the centre of a group of copies."""
    often = members.groupBy("p").agg(F.count("*").alias("often"))
    pivots = members.join(often, "p").groupBy("region").agg(F.max_by("p", F.struct("often", "p")).alias("pivot"))
    return cut(members.join(pivots, "region"))


def rings(regions: DataFrame, known: DataFrame, labels: DataFrame, percent: int, used: DataFrame) -> DataFrame:
    """The parts of regions that still hold points of more than one component: region, p, size, label, pivot, large.

    used: p, the pivots of all rounds so far.

    A point's ring is its distance to the pivot in units of the threshold; it belongs to that ring and the next.
    """
    far = known.select("a", "b", (1 - F.col("inter") / (F.col("na") + F.col("nb") - F.col("inter"))).alias("d"))
    # regions whose points are one component by now go before anything is made of them
    at = regions.select("region", "p", "pivot", "size").join(labels, F.col("p") == F.col("node"), "left").withColumn("label", F.coalesce("label", "p")).drop("node")
    apart = at.groupBy("region").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("region")
    at = cut(at.join(apart, "region", "left_semi").withColumns({"a": F.least("p", "pivot"), "b": F.greatest("p", "pivot")}))
    at = at.join(far, ["a", "b"], "left").withColumn("d", F.coalesce("d", F.lit(0.0)))
    # a little wider than the threshold, for rounding
    ring = F.floor(F.col("d") / (1.0 - percent / 100.0 + 1e-9))
    at = at.withColumn("ring", F.explode(F.array(ring, ring + 1))).select(F.xxhash64("region", "ring", "pivot").alias("region"), "p", "size", "label")
    # a point that was a pivot comes last, so a ring gets another one each round
    often = at.groupBy("p").agg(F.count("*").alias("often")).join(used.withColumn("used", F.lit(1)), "p", "left").select("p", F.struct(F.col("used").isNull().alias("fresh"), "often", "p").alias("often"))
    found = at.join(often, "p").groupBy("region").agg(F.count("*").alias("n"), F.min("label").alias("lo"), F.max("label").alias("hi"), F.max_by("p", "often").alias("pivot")).where("lo <> hi")
    return at.join(found.select("region", "n", "pivot"), "region").withColumn("large", F.col("n") > WHOLE)


def block_links(regions: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """a, b: links that join up all linked points of different labels inside each region (region, p, label, n).

    A region of n points falls into blocks of about BLOCK, and each two blocks meet in one group with their texts: some
    n * n / BLOCK rows, 2 * BLOCK texts in a task at a time, and a link for each point at most.
    """
    k = F.ceil(F.col("n") / BLOCK)
    dealt = regions.select("region", "p", "label", k.alias("k"), F.pmod(F.xxhash64("p", "region"), k).alias("block"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    dealt = dealt.select(F.xxhash64("region", F.least("block", "other"), F.greatest("block", "other")).alias("at"), (F.col("block") == F.col("other")).alias("alone"),
                         (F.col("block") > F.col("other")).alias("second"), F.col("p").alias("point"), "label")

    def run(table: pa.Table) -> pa.Table:
        word_hash = words_hashed.__getitem__
        table = table.sort_by("point")
        sets = [shingles(t.lower().split(), word_hash, n) for t in table["text"].cast(pa.large_binary()).to_pylist()]
        point, label = table["point"].to_pylist(), table["label"].to_pylist()
        side = table["second"].to_numpy()
        inside = table["alone"][0].as_py()
        sizes = np.array([len(x) for x in sets], np.int64)
        h, d = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
        by = np.argsort(h, kind="stable")
        h, d = h[by], d[by]
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while (y := root.get(x, x)) != x:
                root[x] = root.get(y, y)
                x = y
            return x

        out = []
        for y, own in enumerate(sets):
            low = np.searchsorted(h, own)
            wide = np.searchsorted(h, own, "right") - low
            inter = np.bincount(d[np.arange(wide.sum()) + np.repeat(low - np.cumsum(wide) + wide, wide)], minlength=len(sets))
            good = 100 * inter >= percent * (sizes + sizes[y] - inter)
            good[y:] = False
            if not inside:
                good &= side != side[y]
            for x in np.flatnonzero(good):
                a, b = find(label[x]), find(label[y])
                if a != b:
                    root[a] = b
                    out.append((point[x], point[y]))
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out) if out else [()] * 2)], names=["a", "b"])

    return texts.join(dealt, "point").groupBy("at").applyInArrow(run, "a long, b long")


def jaccard_components(docs: DataFrame, n: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_shingles, component_id.

    Joins on a region, a hub or a label leave hot keys to the session's skew join (on by default); copies of one text,
    which may be a third of all rows, are joined by broadcast of their heaviest points.

    Words are cut at ASCII white space after lower-casing A-Z; the set of a document holds its distinct n-word
    shingles, or its whole word sequence if that is shorter.  Two documents are linked when 100 * intersection >=
    percent * union.  component_id is the smallest id that links reach.  A null text or one without words has no
    shingles, no link and itself as component.  A null id never names a component unless all its rows have one;
    repeated rows are linked like any equal texts, and so are different texts of one id.  Shingles, sets and rows are told
    apart by 64-bit hashes.
    """
    points, labels = links(docs, n, percent, id_col, text_col)
    firsts = points.where("point is not null").groupBy("point").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
    named = cut(firsts.join(labels, firsts.point == labels.node, "left").select("point", "first", "n", F.coalesce("label", "point").alias("label")))
    lowest = named.groupBy("label").agg(F.min("first").alias("component_id"))
    named = named.join(lowest, "label").select("point", "component_id", "n")
    full = points.where("point is not null")
    out = join_heavy(full, named, ["point"], "n", full.count()).select("doc_id", "size", "component_id")
    alone = points.where("point is null").select("doc_id", "size", F.col("doc_id").alias("component_id"))
    return out.unionByName(alone).select(F.col("doc_id").alias(id_col), F.col("size").alias("n_shingles"), "component_id")
