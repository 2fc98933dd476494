"""Near-duplicates: fast similarity sketches, banding, and exact verification on full sets."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from evstream.llm.common import components, grows, query, saved, table

WIDTH, PERCENT = 5, 75
COORDINATES, ROWS = 128, 4  # 32 bands of 4: a pair at 0.75 is missed by all with odds of 5e-6
# A pair at 0.75 agrees in fewer than LINK of 128 coordinates with odds of 7e-6: pairs that agree in LINK
# are candidates, which are then verified on full sets.
LINK = 74
# Rows that agree in ALIKE coordinates with a leader follow it and need not lead themselves.
ALIKE = 64
BUCKET = 20_000  # documents of one bucket that a task compares with leaders
BLOCK_DOCS, BLOCK_SHINGLES = 192, 1_500_000  # what one side of an exact comparison holds


def shingle_hashes(text: str | None) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles: five words, or all of fewer."""
    from xxhash import xxh3_64_intdigest

    if not text:
        return np.zeros(0, np.uint64)
    words = text.encode().lower().split()  # bytes: only A-Z are lowered, only ASCII blanks part
    h = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    n = max(1, len(h) - WIDTH + 1) if len(h) else 0
    z = np.full(n, min(len(h), WIDTH), np.uint64)
    for j in range(min(len(h), WIDTH)):
        z = mixed(z * np.uint64(0x9E3779B97F4A7C15) + h[j:j + n])
    return np.unique(z)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def sketches(sets: list[np.ndarray], t: int = COORDINATES) -> np.ndarray:
    """A fast similarity sketch of every set, a row each; empty sets give zeros.

    Round i throws every element into a hashed bin at height i plus a hashed fraction, and bins
    keep their lowest element. Rounds t and later throw all elements into bin i - t, so every bin
    is filled after 2t rounds. A set stops once its bins are full: later rounds are higher.
    """
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    low = np.full((len(sets), t), full)
    doc = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    x = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    for i in range(2 * t):
        if not len(x):
            break
        y = mixed(x + np.uint64((i + 1) * 0xD1B54A32D192ED03 & 0xFFFFFFFFFFFFFFFF))
        bins = (y >> np.uint64(32)) % np.uint64(t) if i < t else np.full(len(y), i - t, np.uint64)
        height = np.uint64(i << 32) | (y & np.uint64(0xFFFFFFFF))
        np.minimum.at(low.ravel(), doc * t + bins.astype(np.int64), height)
        open_ = (low == full).any(axis=1)
        stay = open_[doc]
        x, doc = x[stay], doc[stay]
    out = (mixed(low) >> np.uint64(48)).astype("<u2")
    out[[len(s) == 0 for s in sets]] = 0
    return out


SKETCH = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text_hash", T.LongType()),
    T.StructField("n_shingles", T.LongType()),
    T.StructField("set_id", T.BinaryType()), T.StructField("bands", T.BinaryType()),
    T.StructField("coarse", T.BinaryType())])


def sketched(docs: DataFrame) -> DataFrame:
    """``doc_id``, size, 128-bit digest and sketch of every document's set, in one pass."""

    def run(batches):
        from xxhash import xxh3_128_digest

        for b in batches:
            sets = [shingle_hashes(t) for t in b.column("text").to_pylist()]
            fine = sketches(sets)
            coarse = (fine & 0xFF).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id").cast(pa.int64()), b.column("text_hash"), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                pa.array([r.tobytes() for r in fine], pa.binary()),
                pa.array([r.tobytes() for r in coarse], pa.binary())], names=SKETCH.names)

    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(run, SKETCH)


def _rows(batches) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*[c.to_pylist() for c in b.columns], strict=True)


def _edges(found: Iterator[tuple], names=("a", "b"), size: int = 20_000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for x in found:
        held.append(x)
        if len(held) >= size:
            yield _batch(held, names)
            held = []
    yield _batch(held, names)


def _batch(rows, names):
    columns = zip(*rows, strict=True) if rows else ((),) * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=list(names))


class _Classes:
    """Union-find over the leaders a task holds."""

    def __init__(self):
        self.root: list[int] = []

    def add(self) -> None:
        self.root.append(len(self.root))

    def top(self, k: int) -> int:
        while self.root[k] != k:
            self.root[k] = self.root[self.root[k]]
            k = self.root[k]
        return k

    def merge(self, hits: list[int]) -> list[int]:
        """The first hit, and another of each class that was not yet joined with it."""
        out = hits[:1]
        first = self.top(hits[0])
        for k in hits[1:]:
            other = self.top(k)
            if other != first:
                out.append(k)
                self.root[max(first, other)] = first = min(first, other)
        return out


# Differing coordinates obey the triangle inequality: if a row agrees with a leader in ``a``
# coordinates, whatever agrees with that row in LINK agrees with the leader in a + LINK - 128. So a
# leader is in reach of all that can be linked with it or with a follower, whose least agreement it
# bears; a leader without loose followers is in reach of nothing but what is like itself.
def _reach(least):
    return np.minimum(LINK, least + LINK - COORDINATES)


TIES = ("a", "b", "least", "at")


def _leaders(batches):
    """Rows (key, rep, coarse sketch), sorted by key: ties (row, leader), and a row (leader, leader,
    least agreement of its followers, key) for each leader.

    Each row is tied to the first leader of its bucket in reach, and leaders to each other where a
    row is in reach of several that are not joined yet: as many ties as rows and leaders. A row
    like no leader leads itself, which is a tie of its own. Holds the leaders alone."""

    def found():
        for key, rows in groupby(_rows(batches), key=lambda r: r[0]):
            ids, lead, least = np.zeros(8, np.int64), np.zeros((8, COORDINATES), np.uint8), np.zeros(8, np.int64)
            n, classes = 0, _Classes()
            for _, rep, coarse in rows:
                v = np.frombuffer(coarse, np.uint8)
                same = (lead[:n] == v).sum(axis=1)
                hits = np.flatnonzero(same >= _reach(least[:n])).tolist()
                follows = n and int(same.argmax())
                if n and same[follows] >= ALIKE:
                    least[follows] = min(least[follows], same[follows])
                    if follows not in hits:
                        hits.append(follows)
                else:
                    if n == len(ids):
                        ids, lead, least = (np.concatenate([x, x]) for x in (ids, lead, least))
                    ids[n], lead[n], least[n] = rep, v, COORDINATES
                    classes.add()
                    hits.insert(0, n)
                    n += 1
                for k in classes.merge(hits):
                    if ids[k] != rep:
                        yield rep, int(ids[k]), -1, 0
            yield from ((int(ids[k]), int(ids[k]), int(least[k]), key) for k in range(n))

    return _edges(found(), TIES)


def _led(batches):
    """Rows (group, side, rep, coarse sketch, least), sorted by group and side: rows of side 1 are
    tied to the leaders, of side 0, in reach, as above."""

    def found():
        for _, rows in groupby(_rows(batches), key=lambda r: r[0]):
            ids, lead, reach, classes = [], [], [], _Classes()
            for _, side, rep, coarse, least in rows:
                v = np.frombuffer(coarse, np.uint8)
                if side == 0:
                    ids.append(rep)
                    lead.append(v)
                    reach.append(_reach(least))
                    classes.add()
                elif ids:
                    if not isinstance(lead, np.ndarray):
                        lead, reach = np.array(lead), np.array(reach)
                    hits = np.flatnonzero((lead == v).sum(axis=1) >= reach).tolist()
                    yield from ((rep, ids[k], -1, 0) for k in (classes.merge(hits) if hits else ()))

    return _edges(found(), TIES)


def _families(reps: DataFrame) -> DataFrame:
    """``node, component``: documents that banding and sketches bring together."""
    pieces = F.array(*[F.xxhash64(F.lit(k), F.substring("bands", 1 + 2 * ROWS * k, 2 * ROWS))
                       for k in range(COORDINATES // ROWS)])
    rows = reps.select("rep", F.explode(pieces).alias("key"))
    shared = rows.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    rows = rows.join(grows(shared), "key").join(grows(reps.select("rep", "coarse")), "rep")
    # A large bucket is compared in parts, and then each part with bounded groups of all leaders.
    parts = F.ceil(F.col("_n") / F.lit(BUCKET))
    rows = rows.withColumn("_part", F.pmod(F.xxhash64("rep", F.lit(3)), parts))
    rows = saved(rows.select("key", "rep", "coarse", "_part", parts.alias("_parts")), "buckets")
    by = ["key", "_part"]
    made = (rows.repartition(*by).sortWithinPartitions(*by, "rep").select(F.xxhash64(*by), "rep", "coarse")
            .mapInArrow(_leaders, "a long, b long, least long, at long"))
    edges = saved(made, "ties")
    cut, zero = rows.where("_parts > 1"), F.lit(0).cast("long")
    if cut.head(1):
        tops = edges.where("a = b").select(F.col("a").alias("rep"), "at", "least")
        tops = saved(cut.withColumn("at", F.xxhash64(*by)).join(grows(tops), ["rep", "at"]), "leaders")
        groups = tops.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / F.lit(BUCKET)).alias("_groups"))
        group, by = F.pmod(F.xxhash64("rep", F.lit(7)), F.col("_groups")), ["key", "_part", "_group"]
        ours = tops.join(groups, "key").withColumn("_part", F.explode(F.sequence(zero, F.col("_parts") - 1)))
        theirs = cut.join(groups, "key").withColumn("_group", F.explode(F.sequence(zero, F.col("_groups") - 1)))
        both = (ours.select("key", "_part", group.alias("_group"), zero.alias("_side"), "rep", "coarse", "least")
                .union(theirs.select(*by, F.lit(1).cast("long"), "rep", "coarse", zero)))
        edges = edges.union(both.repartition(*by).sortWithinPartitions(*by, "_side")
                            .select(F.xxhash64(*by), "_side", "rep", "coarse", "least").mapInArrow(_led, "a long, b long, least long, at long"))
    return components(edges.where("a <> b"))


def _common(sets: list[np.ndarray], split: int | None = None) -> np.ndarray:
    """Sizes of the intersections of all pairs, or of those before and from ``split``."""
    sizes = [len(s) for s in sets]
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.ones(len(flat), bool)
    new[1:] = flat[1:] != flat[:-1]
    column = np.cumsum(new) - 1
    often = np.bincount(column)[column] > 1
    column, owner = column[often], owner[often]
    column = np.cumsum(np.r_[False, column[1:] != column[:-1]]) if len(column) else column
    at = len(sets) if split is None else split
    total = np.zeros((at, len(sets) if split is None else len(sets) - at), np.float64)
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
        lo, hi = np.searchsorted(column, (first, first + 4096))
        m = np.zeros((len(sets), 4096), np.float32)
        m[owner[lo:hi], column[lo:hi] - first] = 1
        total += m @ m.T if split is None else m[:at] @ m[at:].T
    return total


def _verified(batches, crossed: bool):
    """Rows (group, side, rep, set), sorted by group: links of each group, thinned to a forest."""

    def found():
        for _, rows in groupby(_rows(batches), key=lambda r: r[0]):
            rows = sorted({(side, rep): s for _, side, rep, s in rows}.items())
            reps = [rep for (_, rep), _ in rows]
            sets = [np.frombuffer(s, "<u8") for _, s in rows]
            n = np.array([len(s) for s in sets], np.float64)
            at = sum(side == 0 for (side, _), _ in rows) if crossed else None
            if at == 0 or at == len(rows) or len(rows) < 2:
                continue
            both = _common(sets, at)
            a, b = (n[:at, None], n[None, at:]) if crossed else (n[:, None], n[None, :])
            i, j = np.nonzero(100 * both >= PERCENT * (a + b - both))
            if crossed:
                j = j + at
            root = {r: r for r in reps}

            def top(x):
                while root[x] != x:
                    root[x] = root[root[x]]
                    x = root[x]
                return x

            for p, q in zip(i.tolist(), j.tolist(), strict=True):
                x, y = top(reps[p]), top(reps[q])
                if x != y:
                    root[max(x, y)] = min(x, y)
                    yield x, y

    return _edges(found())


def _linked(docs: DataFrame, reps: DataFrame) -> DataFrame:
    """``node, component`` by verified links. Everything within a family is compared exactly."""
    family = _families(reps).select(F.col("node").alias("rep"), F.col("component").alias("family"))
    family = saved(family.join(reps.select("rep", "holder", "n_shingles", "set_id"), "rep"), "families")
    blocks = F.ceil(F.greatest(F.col("_docs") / BLOCK_DOCS, F.col("_size") / BLOCK_SHINGLES))
    size = family.groupBy("family").agg(F.count(F.lit(1)).alias("_docs"), F.sum("n_shingles").alias("_size"))
    size = size.select("family", blocks.cast("int").alias("blocks"))
    placed = family.join(size, "family").select(
        "holder", "rep", "family", "blocks", F.pmod(F.xxhash64("rep", F.lit(5)), "blocks").cast("int").alias("block"), "set_id")

    def full_sets(batches):
        from xxhash import xxh3_128_digest

        for b in batches:
            sets = [shingle_hashes(t).tobytes() for t in b.column("text").to_pylist()]
            # Other texts may bear the holder's id.
            own = pa.array([xxh3_128_digest(s) == d for s, d in zip(sets, b.column("set_id").to_pylist(), strict=True)])
            columns = [*b.columns[1:5], pa.array(sets, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["rep", "family", "blocks", "block", "set"]).filter(own)

    texts = docs.select(F.col("doc_id").cast("long").alias("holder"), "text")
    sets = saved(texts.join(grows(placed), "holder").select("text", "rep", "family", "blocks", "block", "set_id").mapInArrow(
        full_sets, "rep long, family long, blocks int, block int, set binary").dropDuplicates(["rep"]), "sets")

    def compare(rows, crossed):
        keys = ["family", "ub", "block"]
        return (rows.repartition(*keys).sortWithinPartitions(*keys)
                .select(F.xxhash64(*keys), "side", "rep", "set")
                .mapInArrow(lambda b: _verified(b, crossed), "a long, b long"))

    zero = F.lit(0)
    inner = sets.withColumn("ub", zero).withColumn("side", zero)
    # In families of several blocks, the first document meets every block.
    first = sets.where("blocks > 1 and rep = family").withColumn("block", F.explode(F.sequence(zero, F.col("blocks") - 1)))
    edges = saved(compare(inner.union(first.select(sets.columns).withColumn("ub", zero).withColumn("side", zero)), False), "links")
    if not sets.where("blocks > 1").head(1):
        return components(edges)
    # What is not in a family's largest class so far meets every block of the family.
    joint = components(edges)
    large = sets.where("blocks > 1").select("rep", "family").distinct().join(
        joint.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    largest = (large.groupBy("family", "component").agg(F.count(F.lit(1)).alias("n"))
               .groupBy("family").agg(F.max_by("component", F.struct("n", -F.col("component"))).alias("main")))
    rest = saved(large.join(largest, "family").where("component <> main").select("rep", "family"), "rest")
    count = rest.join(family.select("rep", "n_shingles"), "rep").groupBy("family").agg(
        F.count(F.lit(1)).alias("_docs"), F.sum("n_shingles").alias("_size"))
    count = count.select("family", blocks.cast("int").alias("ubs"))
    sets = sets.where("blocks > 1").join(count, "family")
    ours = (sets.join(rest.select("rep"), "rep", "left_semi")
            .withColumn("ub", F.pmod(F.xxhash64("rep", F.lit(9)), "ubs").cast("int"))
            .withColumn("block", F.explode(F.sequence(zero, F.col("blocks") - 1))).withColumn("side", zero))
    theirs = sets.withColumn("ub", F.explode(F.sequence(zero, F.col("ubs") - 1))).withColumn("side", F.lit(1))
    columns = ["family", "ub", "block", "side", "rep", "set"]
    return components(edges.union(compare(ours.select(columns).union(theirs.select(columns)), True)))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row.

    Documents are linked if their shingle sets (five words, A-Z lowered) share at least 75 per
    cent of their union; classes follow links, and the smallest id of a class is kept. NULL and
    empty texts have no shingles and stand alone, as do rows without an id (``component_id``
    NULL, kept). Rows of one id and one text stay or go together, those of one id and different
    texts go by their texts. Equal sets are compared once;
    a bucket, a family or a set of copies of any size is cut into bounded parts.
    """
    return _classed(docs).drop("text_hash")


def _classed(docs: DataFrame) -> DataFrame:
    """As :func:`near_duplicates`, with the hash of the text."""
    sk = saved(sketched(docs), "sketches")
    some = sk.where("n_shingles > 0 and doc_id is not null")
    reps = some.groupBy("set_id").agg(
        F.min("doc_id").alias("holder"), F.first("n_shingles").alias("n_shingles"),
        F.first("bands").alias("bands"), F.first("coarse").alias("coarse"))
    # Sets bear numbers of their own, fixed by writing them: several may have the same holder.
    reps = saved(reps.withColumn("rep", F.monotonically_increasing_id()), "reps")
    linked = _linked(docs, reps).withColumnRenamed("node", "rep")
    classed = reps.select("set_id", "rep", "holder").join(linked, "rep", "left").select(
        "set_id", "holder", F.coalesce("component", "rep").alias("_class"))
    lowest = classed.groupBy("_class").agg(F.min("holder").alias("_component"))
    of_set = classed.join(grows(lowest), "_class").select("set_id", "_component")
    out = sk.select("doc_id", "text_hash", "n_shingles", "set_id").join(of_set, "set_id", "left")
    alone = (F.col("n_shingles") == 0) | F.col("doc_id").isNull()
    out = out.select("doc_id", "text_hash", "n_shingles", F.when(alone, F.col("doc_id")).otherwise(F.col("_component")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose document is the first of its class, unchanged."""
    gone = _classed(docs).where(~F.col("kept")).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    same = (docs["doc_id"] == F.col("_id")) & (F.xxhash64(docs["text"]) == F.col("_hash"))
    return docs.join(grows(gone.distinct()), same, "left_anti").select(docs.columns)


@query("op10_minhash")
def op10_minhash(spark, folder):
    return near_duplicates(table(spark, folder, "documents"))
