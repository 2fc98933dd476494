"""Repeated passages by suffix sorting: Lyndon-prefix groups, processed in descending order.

Texts cannot all stand in one suffix array. Every window of 400 bytes is filed under an anchor it
holds, chosen by its content alone; windows that are equal share their anchor's place and the
bytes after it. So the stretches around equal anchors meet in one task, which sorts their
suffixes and compares neighbours.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from evstream.llm.common import grows, query, saved, table, without
from evstream.llm.minhash import mixed

LENGTH = 400  # bytes of a passage
SPAN = 288  # window starts among which an anchor is chosen; LENGTH - SPAN bytes after it are shared
SPAN_BYTES = 16  # bytes an anchor is chosen by
SHARED = LENGTH - SPAN
SYMBOL = 40  # bytes of a symbol of the sorted strings
CHUNK = 20_000  # stretches sorted together; more than that around one anchor are cut by their bytes
PART = 1 << 22  # window starts handled at once, so that texts of any length fit


def suffix_array(s: list[int]) -> list[int]:
    """Suffix array by linear grouping.

    ``s`` ends in its only smallest symbol. Suffixes are kept in groups of equal Lyndon prefix,
    ascending. Groups are taken from the highest down: each member's pointer to the nearest
    earlier suffix of a lower group is found along the pointers of the members passed, and that
    suffix, whose prefix now goes on with the group's, moves up within its group, those followed
    by more members further. Then every suffix, in final order, puts the one before it, and what
    that points to in turn, at the front of their groups.
    """
    n = len(s)
    sa = sorted(range(n), key=s.__getitem__)
    at, start, size = [0] * n, [0] * n, [0] * n
    g = 0
    for k, i in enumerate(sa):
        if s[i] != s[sa[g]]:
            g = k
        at[i], start[i] = k, g
        size[g] += 1
    prev = [-1] * n
    end = n - 1
    while end >= 0:
        g = start[sa[end]]
        members = sa[g:end + 1]
        depth: dict[int, int] = {}
        for i in members:
            p = i - 1
            while p >= 0 and start[p] > g:
                p = prev[p]
            prev[i] = p
        for i in members:  # members that follow one another share the suffix before the first
            run = []
            while i not in depth:
                run.append(i)
                p = prev[i]
                if p < 0 or start[p] < g:
                    break
                i = p
            for i in reversed(run):
                p = prev[i]
                if p >= 0 and start[p] == g:
                    depth[i], prev[i] = depth[p] + 1, prev[p]
                else:
                    depth[i] = 1
        most: dict[int, int] = {}
        for i in members:
            p = prev[i]
            if p >= 0 and most.get(p, 0) < depth[i]:
                most[p] = depth[i]
        by_count: dict[int, list[int]] = {}
        for p, c in most.items():
            by_count.setdefault(c, []).append(p)
        for c in sorted(by_count, reverse=True):
            moved = by_count[c]
            for p in moved:
                old = start[p]
                size[old] -= 1
                to, q = old + size[old], at[p]
                other = sa[to]
                sa[q], sa[to], at[other], at[p] = other, p, q, to
            olds = [start[p] for p in moved]
            new = {old: old + size[old] for old in olds}
            for old, to in new.items():
                if to != old:
                    size[to] = 0
            for p, old in zip(moved, olds, strict=True):
                to = new[old]
                start[p] = to
                size[to] += 1
        end = g - 1
    out, free, placed = [0] * n, list(range(n)), [False] * n
    out[0], placed[n - 1] = n - 1, True
    free[start[n - 1]] += 1
    for k in range(n):
        j = out[k] - 1
        while j >= 0 and not placed[j]:
            g = start[j]
            out[free[g]] = j
            free[g] += 1
            placed[j] = True
            j = prev[j]
    return out


def anchors(text: bytes) -> list[tuple[int, int, int]]:
    """``(anchor, least, most)``: where windows start before their anchor, ascending and without
    gaps. The anchor of a window is the least hash, the first of equals, of :data:`SPAN_BYTES`
    bytes among its first :data:`SPAN` places."""
    out, windows = [], len(text) - LENGTH + 1
    for first in range(0, max(0, windows), PART):
        count = min(PART, windows - first)
        m = count + SPAN - 1
        low = np.ndarray(m, "<u8", text, first, (1,))
        high = np.ndarray(m, "<u8", text, first + 8, (1,))
        place = np.arange(m, dtype=np.uint64)
        h = mixed(low * np.uint64(0x9E3779B97F4A7C15) + high) & np.uint64(0xFFFFFFFFFF000000) | place
        rows = -(-m // SPAN)
        wide = np.full(rows * SPAN, np.uint64(0xFFFFFFFFFFFFFFFF))
        wide[:m] = h
        wide = wide.reshape(rows, SPAN)
        on = np.minimum.accumulate(wide, axis=1).ravel()
        back = np.minimum.accumulate(wide[:, ::-1], axis=1)[:, ::-1].ravel()
        a = (np.minimum(back[:count], on[SPAN - 1:SPAN - 1 + count]) & np.uint64(0xFFFFFF)).astype(np.int64)
        edge = np.r_[0, np.flatnonzero(a[1:] != a[:-1]) + 1, count]
        for lo, hi in zip(edge[:-1].tolist(), (edge[1:] - 1).tolist(), strict=True):
            p = int(a[lo])
            out.append((p + first, p - hi, p - lo))
    return out


PLACES = "doc_id long, text_hash long, anchor long, least int, most int, key long, stretch long"
RUNS = "key long, stretch long, low int, high int"


def _places(docs: DataFrame) -> DataFrame:
    """Anchors of all texts: hash of the bytes all its windows share, and of all their bytes."""

    def run(batches):
        from xxhash import xxh3_64_intdigest as digest

        signed = lambda x: x - (1 << 64) if x >> 63 else x
        for b in batches:
            out = []
            for doc, name, text in zip(*[b.column(c).to_pylist() for c in ("doc_id", "text_hash", "text")], strict=True):
                t = (text or "").encode()
                for a, lo, hi in anchors(t):
                    out.append((doc, name, a, lo, hi, signed(digest(t[a:a + SHARED])),
                                signed(digest(t[a - hi:a + LENGTH - lo], lo * SPAN + hi))))
                if len(out) >= 50_000:
                    yield _table(out, arrow)
                    out = []
            yield _table(out, arrow)

    arrow = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("anchor", pa.int64()), ("least", pa.int32()), ("most", pa.int32()),
                       ("key", pa.int64()), ("stretch", pa.int64())])
    return docs.mapInArrow(run, PLACES)


def _table(rows, schema):
    columns = zip(*rows, strict=True) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _shared(rows: np.ndarray) -> np.ndarray:
    """How many first bytes each row shares with the next."""
    differ = rows[1:] != rows[:-1]
    return np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])


def _matches(rows: list[tuple]) -> list[tuple[int, int, int, int]]:
    """``(key, stretch, low, high)``: runs of places before the anchor from which a window of the
    stretch equals one of another. Rows are (key, stretch, least, most, bytes)."""
    n = len(rows)
    least, most = (np.array([r[k] for r in rows]) for k in (2, 3))
    right, left = np.zeros((n, LENGTH), np.uint8), np.zeros((n, SPAN), np.uint8)
    for k, (_, _, lo, hi, text) in enumerate(rows):
        x = np.frombuffer(text, np.uint8)
        right[k, :LENGTH - lo] = x[hi:] + 1  # UTF-8 has no byte 255, and 0 stands for the end
        left[k, :hi] = x[:hi][::-1] + 1
    names = np.unique(right.reshape(-1, SYMBOL).view(f"S{SYMBOL}").ravel(), return_inverse=True)[1]
    per = LENGTH // SYMBOL
    s = np.ones((n, per + 1), np.int64)
    s[:, :per] = names.reshape(n, per) + 2
    order = np.array(suffix_array([*s.ravel().tolist(), 0]))
    order = order[order % (per + 1) == 0]
    order = order[order < n * (per + 1)] // (per + 1)
    right, left, least, most = right[order], left[order], least[order], most[order]
    # Bytes that neighbours share after the anchor, and, in the order of those before it, before it.
    same = _shared(right)
    same = np.minimum(same, np.minimum((LENGTH - least)[1:], (LENGTH - least)[:-1]))
    reach = np.maximum(np.r_[0, same], np.r_[same, 0])
    before = np.argsort(left.view(f"S{SPAN}").ravel(), kind="stable")
    shared = _shared(left[before])
    hit, alike = np.zeros((n, SPAN), bool), np.zeros(n, np.int64)
    for x in range(SPAN):
        i = np.flatnonzero((least <= x) & (x <= most) & (reach >= LENGTH - x))
        if len(i) < 2:
            continue
        alike[before] = np.cumsum(np.r_[0, shared < x])
        band = np.cumsum(np.r_[0, same < LENGTH - x])
        _, back, count = np.unique(band[i] * n + alike[i], return_inverse=True, return_counts=True)
        hit[i[count[back] > 1], x] = True
    out = []
    step = np.diff(np.pad(hit, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    for (i, lo), (_, hi) in zip(np.argwhere(step == 1).tolist(), np.argwhere(step == -1).tolist(), strict=True):
        key, stretch = rows[order[i]][:2]
        out.append((key, stretch, lo, hi - 1))
    return out


def _sorted(batches):
    """Rows sorted by group: whole groups are gathered into chunks, which are sorted and compared."""
    schema = pa.schema([("key", pa.int64()), ("stretch", pa.int64()), ("low", pa.int32()), ("high", pa.int32())])
    held, same, group = [], [], None
    for b in batches:
        for g, *r in zip(*[c.to_pylist() for c in b.columns], strict=True):
            if g != group:
                held, same, group = held + same, [], g
                if len(held) >= CHUNK:
                    yield _table(_matches(held), schema)
                    held = []
            same.append(tuple(r))
    if held or same:
        yield _table(_matches(held + same), schema)


STRETCHES = "group long, key long, stretch long, least int, most int, text binary"


def _halved(crowded: DataFrame) -> DataFrame:
    """Stretches of crowded groups, each cut to the lower and the upper half of the window places of
    its group (``lo`` to ``hi`` before the anchor). Windows of a half share more bytes than those of
    the whole, on both sides of the anchor: a half is filed under these. ``part`` names the bytes left."""

    def run(batches):
        from xxhash import xxh3_64_intdigest as digest

        signed = lambda x: x - (1 << 64) if x >> 63 else x
        schema = pa.schema([("group", pa.int64()), ("key", pa.int64()), ("stretch", pa.int64()), ("least", pa.int32()), ("most", pa.int32()),
                            ("text", pa.binary()), ("lo", pa.int32()), ("hi", pa.int32()), ("part", pa.int64())])
        for b in batches:
            out = []
            for group, key, stretch, least, most, text, lo, hi in zip(*[c.to_pylist() for c in b.columns], strict=True):
                mid = (lo + hi + 1) // 2
                for first, last in ((lo, mid - 1), (mid, hi)):
                    low, high = max(least, first), min(most, last)
                    if low <= high:
                        # The anchor is at ``most`` in the text.
                        shared = text[most - first:most + LENGTH - last]
                        rest = text[most - high:most + LENGTH - low]
                        out.append((signed(digest(shared, (group + first) % (1 << 64))), key, stretch, low, high, rest,
                                    first, last, signed(digest(rest, low * SPAN + high))))
                if len(out) >= 5_000:
                    yield _table(out, schema)
                    out = []
            yield _table(out, schema)

    return crowded.select("group", "key", "stretch", "least", "most", "text", "lo", "hi").mapInArrow(
        run, f"{STRETCHES}, lo int, hi int, part long")


def _cut(stretches: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Groups of at most :data:`CHUNK` stretches that hold all equal windows, and runs found on the way.

    A group with more is halved until none is left; a group of one window place holds one string,
    so that is at most nine times. Stretches that are alike once cut are repeats of one another over
    all places left to them: they are told at once, and one of them stays for the others.
    """
    todo = stretches.withColumns({"lo": F.lit(0), "hi": F.lit(SPAN - 1)})
    few, runs = [], []
    while True:
        few.append(todo.where(F.col("crowd") <= CHUNK).drop("crowd", "lo", "hi"))
        crowded = todo.where(F.col("crowd") > CHUNK)
        if not crowded.head(1):
            break
        halves = saved(_halved(crowded), "halves")
        alike = halves.groupBy("group", "part").agg(
            F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "stretch")).alias("one"))
        crowd = alike.groupBy("group").agg(F.count(F.lit(1)).alias("crowd"))
        halves = saved(halves.join(grows(alike), ["group", "part"]).join(grows(crowd), "group"), "halves")
        runs.append(halves.where("n > 1").select("key", "stretch", F.col("least").alias("low"), F.col("most").alias("high")))
        todo = halves.where(F.struct("key", "stretch") == F.col("one")).drop("n", "one", "part")
    return reduce(DataFrame.unionByName, few), reduce(DataFrame.union, runs) if runs else None


def repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, start, end``: byte ranges whose windows of 400 bytes start elsewhere too.
    A text is named by its id and its 64-bit hash, as rows of one id may differ."""
    docs = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    places = saved(_places(docs), "places")
    classes = places.groupBy("key", "stretch").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "text_hash", "anchor", "least", "most")).alias("at"))
    # A key needs a second place; only where its stretches differ are their bytes looked at.
    keys = places.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("stretch").alias("lo"),
                                     F.max("stretch").alias("hi")).where("n > 1")
    mixed_keys = keys.where("lo <> hi").select("key")
    whole = classes.where("n > 1").select(
        "key", "stretch", F.col("at.least").alias("low"), F.col("at.most").alias("high"))
    looked = saved(classes.join(grows(mixed_keys), "key").select("key", "stretch", "n", "at.*"), "looked")
    crowd = looked.groupBy("key").agg(F.count(F.lit(1)).alias("crowd"))
    wanted = looked.join(crowd, "key").groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).agg(
        F.collect_list(F.struct("key", "stretch", "anchor", "least", "most", "crowd")).alias("at"))

    def cut(batches):
        schema = pa.schema([("key", pa.int64()), ("stretch", pa.int64()), ("least", pa.int32()), ("most", pa.int32()),
                            ("text", pa.binary()), ("crowd", pa.int64())])
        for b in batches:
            out = []
            for text, at in zip(*[c.to_pylist() for c in b.columns], strict=True):
                t = text.encode()
                out += [(r["key"], r["stretch"], r["least"], r["most"],
                         t[r["anchor"] - r["most"]:r["anchor"] + LENGTH - r["least"]], r["crowd"]) for r in at]
                if len(out) >= 5_000:
                    yield _table(out, schema)
                    out = []
            yield _table(out, schema)

    named = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    stretches = saved(docs.join(grows(wanted), named).select("text", "at").mapInArrow(
        cut, "key long, stretch long, least int, most int, text binary, crowd long"), "stretches")
    few, alike = _cut(stretches.withColumn("group", F.col("key")))
    few = few.select("group", "key", "stretch", "least", "most", "text").repartition("group").sortWithinPartitions("group")
    runs = whole.union(few.mapInArrow(_sorted, RUNS))
    runs = runs if alike is None else runs.union(alike)
    runs = saved(runs.distinct(), "runs")
    return places.join(grows(runs), ["key", "stretch"]).select(
        "doc_id", "text_hash", (F.col("anchor") - F.col("high")).alias("start"), (F.col("anchor") - F.col("low") + LENGTH).alias("end"))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with ``removed``, the byte ranges taken out (maximal, ascending), and ``kept``, the
    bytes that remain of the UTF-8 text.

    A byte goes if a string of 400 bytes over it also starts anywhere else, in the same text or
    another, as the texts were given; matches may overlap, but never cross texts. All copies lose
    it. NULL and short texts lose nothing. Repeated rows are copies of each other; rows of one id
    with different texts are judged each by its own. Other columns are carried, clashing ones
    replaced.
    """
    docs = without(docs, "removed", "kept", "_id", "_hash", "_ranges")
    found = repeats(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    found = found.groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).agg(
        F.collect_list(F.struct("start", "end")).alias("_ranges"))
    named = F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_hash"))
    joined = docs.join(grows(found), named, "left").drop("_id", "_hash")
    spans = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    schema = T.StructType([*docs.schema.fields, T.StructField("removed", spans), T.StructField("kept", T.BinaryType())])

    def run(batches):
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for b in batches:
            columns = dict(zip(b.schema.names, b.columns, strict=True))
            removed, kept = [], []
            for text, ranges in zip(columns["text"].to_pylist(), columns.pop("_ranges").to_pylist(), strict=True):
                t, out, at, parts = (text or "").encode(), [], 0, []
                for r in sorted(ranges or [], key=lambda r: r["start"]):
                    if out and r["start"] <= out[-1]["end"]:
                        out[-1]["end"] = max(out[-1]["end"], r["end"])
                    else:
                        out.append(dict(r))
                for r in out:
                    parts.append(t[at:r["start"]])
                    at = r["end"]
                removed.append(out)
                kept.append(b"".join([*parts, t[at:]]))
            columns |= {"removed": pa.array(removed, kind), "kept": pa.array(kept, pa.binary())}
            yield pa.RecordBatch.from_arrays([columns[f.name] for f in schema], names=schema.names)

    return joined.select(*docs.columns, "_ranges").mapInArrow(run, schema)


@query("op5_suffix_array")
def op5_suffix_array(spark, folder):
    out = remove_repeats(table(spark, folder, "documents").select("doc_id", "text"))
    return out.select(
        "doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
        F.aggregate("removed", F.lit(0).cast("long"), lambda x, r: x + r["end"] - r["start"]).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
        F.octet_length("kept").cast("long").alias("n_kept"),
        F.concat_ws(",", F.transform("removed", lambda r: F.concat_ws(":", r["start"], r["end"]))).alias("removed"))
