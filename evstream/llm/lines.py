"""Line dedup: documents that share blocks of lines are aligned by patience, common blocks leave the later."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql import types as T

from evstream.llm.common import grows, query, saved, table, without

MIN_WORDS = 5  # a block of fewer words stays
BASE, PRIME = 0x1F3A5C7E9B2D4861, (1 << 61) - 1


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest run of pairs, given by rising first member, whose second members rise too."""
    tops: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for k, (_, j) in enumerate(pairs):
        p = bisect_left(tops, j)
        back.append(at[p - 1] if p else -1)
        tops[p:p + 1] = [j]
        at[p:p + 1] = [k]
    out, k = [], at[-1] if at else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def _anchors(a: list, b: list) -> list[tuple[int, int]]:
    """Places of lines that occur once on both sides, in common order."""
    def once(x):
        seen: dict = {}
        for i, h in enumerate(x):
            seen[h] = -1 if h in seen else i
        return {h: i for h, i in seen.items() if i >= 0}

    ours, theirs = once(a), once(b)
    return _rising([(i, theirs[h]) for h, i in ours.items() if h in theirs])


def _numbered(x: list) -> list[tuple]:
    """Lines with the number of their occurrence, which makes all of them unique."""
    seen: dict = {}
    out = []
    for h in x:
        seen[h] = seen.get(h, -1) + 1
        out.append((h, seen[h]))
    return out


def aligned(a: list, b: list) -> list[tuple[int, int]]:
    """Patience alignment: pairs (i, j) with a[i] == b[j], both rising.

    Common ends of a stretch are matched, then lines unique on both sides in their longest common
    order, and the stretches between them in the same way. Where no line is unique on both sides,
    the k-th occurrences of lines take their part.
    """
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        i, m, j, n = todo.pop()
        while i < m and j < n and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < m and j < n and a[m - 1] == b[n - 1]:
            m, n = m - 1, n - 1
            out.append((m, n))
        if i == m or j == n:
            continue
        x, y = a[i:m], b[j:n]
        found = _anchors(x, y)
        if not found:
            out += [(i + p, j + q) for p, q in _anchors(_numbered(x), _numbered(y))]
            continue
        p0, q0 = i, j
        for p, q in found:
            out.append((i + p, j + q))
            todo.append((p0, i + p, q0, j + q))
            p0, q0 = i + p + 1, j + q + 1
        todo.append((p0, m, q0, n))
    return sorted(out)


def blocks(pairs: list[tuple[int, int]], words: list[int], least: int) -> list[tuple[int, int]]:
    """Stretches of the later document, ``[start, end)``, whose lines run on in both documents and
    hold at least ``least`` words."""
    out, k = [], 0
    while k < len(pairs):
        e = k + 1
        while e < len(pairs) and pairs[e] == (pairs[e - 1][0] + 1, pairs[e - 1][1] + 1):
            e += 1
        start, end = pairs[k][1], pairs[e - 1][1] + 1
        if sum(words[start:end]) >= least:
            out.append((start, end))
        k = e
    return out


def windows(h: list[int], words: list[int], least: int) -> list[tuple[int, int, int]]:
    """``(key, start, end)``: the shortest stretches of ``least`` words from every line on and up
    to every line, with a hash of their lines.

    They cover every block of ``least`` words, here and in any other document that holds it.
    """
    n, ends = len(h), set()
    end = total = 0
    for start in range(n):
        while end < n and (end <= start or total < least):
            total += words[end]
            end += 1
        if total < least:
            break
        ends.add((start, end))
        total -= words[start]
    start, total = n, 0
    for end in range(n, 0, -1):
        while start > 0 and (start >= end or total < least):
            start -= 1
            total += words[start]
        if total < least:
            break
        ends.add((start, end))
        total -= words[end - 1]
    sums, powers = [0], [1]
    for x in h:
        sums.append((sums[-1] * BASE + x) % PRIME)
        powers.append(powers[-1] * BASE % PRIME)
    return [((sums[e] - sums[s] * powers[e - s]) % PRIME, s, e) for s, e in sorted(ends)]


def _rows(batches, columns):
    for b in batches:
        yield from zip(*[b.column(c).to_pylist() for c in columns], strict=True)


def _batches(rows, schema: pa.Schema, size: int = 20_000):
    """Batches of rows of integers."""
    rows = iter(rows)
    while True:
        part = list(islice(rows, size))
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in part], f.type) for k, f in enumerate(schema)], schema=schema)
        if len(part) < size:
            return


def _mapped(df: DataFrame, run, schema: str) -> DataFrame:
    """``df`` through ``run``, from tuples of its columns to tuples of longs."""
    columns, types = df.columns, pa.schema([(c.split()[0], pa.int64()) for c in schema.split(", ")])
    return df.mapInArrow(lambda b: _batches(run(_rows(b, columns)), types), schema)


def common_blocks(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """``doc_id, text_hash, start, end``: line blocks that an earlier document holds too, each once.

    The result is that of aligning every document with every earlier one. Copies of a text lose all
    of it, and distinct texts take the place of their first document. A block that an alignment
    finds is covered by :func:`windows` that both texts hold; so a text is aligned with the
    earliest holder of each of its windows, then those of its windows that are not deleted yet
    with the next holders, in rounds of four times as many, until no window or no earlier holder is
    left. Most windows go with their first holder, so the number of alignments follows the lines;
    only windows that stay because texts hold them in another order or another number meet all
    their holders. The earliest holder of a window never loses it. Lines are compared by 64-bit
    hashes of their whole text. Rows without an id or text take no part; equal rows are one
    document, and texts of one id come in the order of their hashes.
    """
    t = F.split("text", "\n")
    lines = docs.where("doc_id is not null and text is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"),
        F.transform(t, lambda x: F.xxhash64(x)).alias("h"),
        F.transform(t, lambda x: F.size(F.filter(F.split(x, "[\\x20\\x09-\\x0D]+"), lambda w: w != ""))).alias("w"))
    ids = saved(lines.select("doc_id", "text_hash").distinct(), "line-ids")
    lines = saved(lines.groupBy("text_hash").agg(F.min("doc_id").alias("doc_id"), F.first(F.struct("h", "w")).alias("l"))
                  .select("text_hash", "doc_id", "l.*"), "lines")
    size = F.aggregate("w", F.lit(0).cast("long"), lambda a, x: a + x)
    copied = lines.where(size >= least).select("text_hash", F.col("doc_id").alias("first"), F.size("h").alias("end"))
    copies = ids.join(grows(copied), "text_hash").where("doc_id > first").select("doc_id", "text_hash", F.lit(0).alias("start"), "end")

    held = saved(_mapped(
        lines.select("doc_id", "text_hash", "h", "w"),
        lambda rows: ((key, doc, text, s, e) for doc, text, h, w in rows for key, s, e in windows(h, w, least)),
        "key long, doc_id long, text_hash long, start long, end long"), "windows")
    place = F.struct("doc_id", "text_hash")
    first = held.groupBy("key").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first < last").select("key", "first")
    left = saved(held.join(grows(first), "key").where(F.col("first") < place), "left-windows")
    pairs = saved(left.select(F.col("first.text_hash").alias("a"), F.col("text_hash").alias("b")).distinct(), "pairs")
    left, found, done, holders = left.drop("first"), copies, pairs, None
    low, high = 1, 5
    while True:
        found = found.union(saved(_aligned(lines, pairs, least), "blocks"))
        left = saved(_uncovered(left, found), "left-windows")
        if holders is None:
            # Holders of what is left, numbered in their order.
            every = held.join(grows(left.select("key").distinct()), "key").select("key", "doc_id", "text_hash").distinct()
            order = Window.partitionBy("key").orderBy("doc_id", "text_hash")
            holders = saved(every.withColumn("place", F.row_number().over(order).cast("long") - 1), "holders")
            left = left.join(grows(holders), ["key", "doc_id", "text_hash"])
        left = saved(left.where(F.col("place") > low), "left-windows")
        if not left.head(1):
            return saved(found.distinct(), "blocks")
        tries = left.select("key", F.col("text_hash").alias("b"), "place").distinct().select(
            "key", "b", F.explode(F.sequence(F.lit(low).cast("long"), F.least(F.col("place"), F.lit(high)) - 1)).alias("place"))
        pairs = tries.join(grows(holders.select("key", "place", F.col("text_hash").alias("a"))), ["key", "place"]).select("a", "b").distinct()
        pairs = saved(pairs.join(grows(done), ["a", "b"], "left_anti"), "pairs")
        done, low, high = done.union(pairs), high, high + 4 * (high - low)


def _aligned(lines: DataFrame, pairs: DataFrame, least: int) -> DataFrame:
    """``doc_id, text_hash, start, end``: blocks of the texts ``b`` that their partners ``a`` hold."""
    theirs = lines.select(F.col("text_hash").alias("a"), F.col("h").alias("g"))
    both = pairs.join(grows(lines.withColumnRenamed("text_hash", "b")), "b").join(grows(theirs), "a")
    out = _mapped(
        both.select("doc_id", "b", "g", "h", "w"),
        lambda rows: ((doc, text, s, e) for doc, text, g, h, w in rows for s, e in blocks(aligned(g, h), w, least)),
        "doc_id long, text_hash long, start long, end long")
    return out.select("doc_id", "text_hash", F.col("start").cast("int"), F.col("end").cast("int")).distinct()


def _uncovered(left: DataFrame, found: DataFrame) -> DataFrame:
    """The windows ``left`` with a line that no block of ``found`` holds."""
    by = ["doc_id", "text_hash"]
    spans = found.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
    others = [c for c in left.columns if c not in by]
    rows = left.groupBy(*by).agg(F.collect_list(F.struct(*others)).alias("rows")).join(grows(spans), by, "left")

    def run(rows):
        for doc, text, held, spans in rows:
            merged: list[list[int]] = []
            for s in spans or ():
                if merged and s["start"] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], s["end"])
                else:
                    merged.append([s["start"], s["end"]])
            starts = [s for s, _ in merged]
            for r in held:
                k = bisect_right(starts, r["start"]) - 1
                if k < 0 or merged[k][1] < r["end"]:
                    yield doc, text, *[r[c] for c in others]

    return _mapped(rows.select(*by, "rows", "spans"), run, ", ".join(f"{c} long" for c in [*by, *others]))


def without_common_blocks(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the text that is left, and ``n_deleted``, the number of lines deleted.

    All rows stay: NULL and empty texts as they are, a text of which nothing is left as an empty
    one. ``n_chars``, if there, counts the new text where lines were deleted. Other columns are
    carried, clashing ones replaced.
    """
    docs = without(docs, "n_deleted", "_blocks", "_id", "_hash")
    gone = (common_blocks(docs, least).groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
            .agg(F.collect_list(F.struct("start", "end")).alias("_blocks")))
    same = (F.col("doc_id").cast("long") == F.col("_id")) & (F.xxhash64("text") == F.col("_hash"))
    rows = docs.join(grows(gone), same, "left").drop("_id", "_hash")
    schema = T.StructType([*docs.schema.fields, T.StructField("n_deleted", T.LongType())])

    def run(batches):
        for b in batches:
            columns = dict(zip(b.schema.names, b.columns, strict=True))
            text, counts = columns["text"].to_pylist(), []
            chars = columns["n_chars"].to_pylist() if "n_chars" in columns else None
            for k, ranges in enumerate(columns.pop("_blocks").to_pylist()):
                if not ranges or text[k] is None:
                    counts.append(0)
                    continue
                lines = text[k].split("\n")
                out = {j for r in ranges for j in range(r["start"], min(r["end"], len(lines)))}
                text[k] = "\n".join(x for j, x in enumerate(lines) if j not in out)
                counts.append(len(out))
                if chars is not None:
                    chars[k] = len(text[k])
            columns["text"] = pa.array(text, b.schema.field("text").type)
            if chars is not None:
                columns["n_chars"] = pa.array(chars, b.schema.field("n_chars").type)
            columns["n_deleted"] = pa.array(counts, pa.int64())
            yield pa.RecordBatch.from_arrays([columns[f.name] for f in schema], names=schema.names)

    return rows.select(*docs.columns, "_blocks").mapInArrow(run, schema)


def line_deduped(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """The rows of ``docs`` with what is left of their texts; rows that lost every word go."""
    left = without_common_blocks(docs, least)
    return left.where((F.col("n_deleted") == 0) | F.col("text").rlike("[^\\x20\\x09-\\x0D]")).select(docs.columns)


@query("op6_line_dedup")
def op6_line_dedup(spark, folder):
    out = without_common_blocks(table(spark, folder, "documents").select("doc_id", "text"))
    text = F.coalesce(F.col("text"), F.lit(""))
    return out.select("doc_id", "n_deleted", F.length(text).cast("long").alias("n_chars_left"),
                      F.sha2(text.cast("binary"), 256).alias("kept_sha256"))
