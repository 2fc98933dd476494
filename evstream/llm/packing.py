"""Best-fit packing: sum-of-squares placement of token pieces into sequences of fixed length."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from evstream.llm import tokens
from evstream.llm.common import query, saved, table, without

LENGTH = 1024
GROUP = 20_000  # rows packed together in one task: their last open bins are all that is lost
STEP = 1 << 32  # sequence numbers a group has for itself


def token_pieces(docs: DataFrame, encoder: Callable, limit: int = LENGTH, end: int = tokens.END) -> DataFrame:
    """``doc_id, piece, start, length, ids`` of every row's pieces.

    Ids (little-endian 32-bit) are the text's and one ``end``; a NULL or empty text is ``end``
    alone. Texts over ``limit`` are cut so that the first piece takes what does not fill a whole
    one. Repeated rows give their pieces each; other columns are not carried.
    """
    schema = T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
        T.StructField("ids", T.BinaryType())])
    arrow = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                       ("length", pa.int64()), ("ids", pa.binary())])
    close = tokens.packed([end])

    def run(batches):
        encode = encoder().encode
        for b in batches:
            rows = []
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                ids = encode(text) + close
                n = len(ids) // 4
                cuts = [0, *range(n % limit or limit, n + 1, limit)]
                rows += [(doc, k, i, j - i, ids[4 * i:4 * j])
                         for k, (i, j) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))]
            columns = zip(*rows, strict=True) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def sum_of_squares(lengths: np.ndarray, limit: int = LENGTH) -> list[list[int]]:
    """Bins of item numbers, none fuller than ``limit``.

    Items come longest first. With n(g) open bins of gap g, an item of length s goes where the sum
    of n(g)^2 becomes smallest: into a gap g it changes by 2 (n(g - s) - n(g) + 1), into a gap it
    fills by 1 - 2 n(g), into a new bin by 2 n(limit - s) + 1. Then the emptiest bins are emptied,
    while all they hold fits best into gaps of others.
    """
    n = np.zeros(limit + 1, np.int64)
    open_at: list[list[int]] = [[] for _ in range(limit + 1)]
    bins: list[list[int]] = []
    gap: list[int] = []

    def put(item, s, g):
        if g == limit:
            b = len(bins)
            bins.append([])
            gap.append(limit)
        else:
            b = open_at[g].pop()
            n[g] -= 1
        bins[b].append(item)
        gap[b] = g - s
        if g > s:
            open_at[g - s].append(b)
            n[g - s] += 1

    for item in np.argsort(-lengths, kind="stable").tolist():
        s = int(lengths[item])
        if s >= limit:
            bins.append([item])
            gap.append(0)
            continue
        change = 2 * (n[: limit - s] - n[s:limit] + 1)
        change[0] = 1 - 2 * n[s]
        change[n[s:limit] == 0] = np.iinfo(np.int64).max
        g = int(change.argmin())
        put(item, s, s + g if change[g] <= 2 * n[limit - s] + 1 else limit)

    for b in sorted((b for b in range(len(bins)) if 0 < gap[b] < limit), key=lambda b: -gap[b]):
        if b not in open_at[gap[b]]:
            continue
        # Try the gaps on a copy of the counts before anything moves.
        left, plan = n.copy(), []
        left[gap[b]] -= 1
        for item in sorted(bins[b], key=lambda i: -lengths[i]):
            fits = np.flatnonzero(left[lengths[item]:limit])
            if not len(fits):
                break
            g = int(lengths[item]) + int(fits[0])
            left[g] -= 1
            left[g - int(lengths[item])] += g > lengths[item]
            plan.append((item, g))
        if len(plan) < len(bins[b]):
            break
        open_at[gap[b]].remove(b)
        n[gap[b]] -= 1
        bins[b], gap[b] = [], limit
        for item, g in plan:
            put(item, int(lengths[item]), g)
    return [b for b in bins if b]


def pack(pieces: DataFrame, limit: int = LENGTH) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: sequences of at most ``limit`` ids.

    Rows need a ``length`` from 1 to ``limit``; all other columns are carried, clashing ones
    replaced. Rows are dealt evenly into groups of about :data:`GROUP` by their place in the saved
    table, whatever their ids, and a group is packed in one task; sequences never span groups.
    """
    pieces = without(pieces, "sequence_id", "offset", "_group")
    pieces = saved(pieces, "pieces")
    groups = max(1, -(-pieces.count() // GROUP))
    schema = T.StructType([*pieces.schema.fields, T.StructField("_group", T.LongType()),
                           T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(t: pa.Table) -> pa.Table:
        lengths = t.column("length").to_numpy().astype(np.int64)
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        base = t.column("_group")[0].as_py() * STEP
        for k, items in enumerate(sum_of_squares(lengths, limit)):
            sequence[items] = base + k
            offset[items] = np.cumsum(lengths[items]) - lengths[items]
        return t.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    dealt = pieces.withColumn("_group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))
    return dealt.groupBy("_group").applyInArrow(run, schema).drop("_group")


def packed_documents(docs: DataFrame, encoder: Callable, limit: int = LENGTH) -> DataFrame:
    """The pieces of all documents, their ids, and their places in sequences."""
    return pack(token_pieces(docs, encoder, limit), limit)


def byte_encoder() -> Callable:
    """Encoder of the byte-level vocabulary of 50,257 ids."""
    import public_tokenizers as p

    files = p.path("byte_bpe_50k.json"), p.path("byte_bpe_50k.tiktoken"), p.PATTERN
    return lambda: tokens.byte_level(*files)


@query("op4_best_fit_packing")
def op4_best_fit_packing(spark, folder):
    pieces = token_pieces(table(spark, folder, "documents"), byte_encoder())
    # The ids themselves need not travel for their digest.
    return pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))
