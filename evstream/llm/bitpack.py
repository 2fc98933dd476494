"""Token ids in fixed-width bit-packed files, with block offsets for random access."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from evstream.llm import tokens
from evstream.llm.common import query, table
from evstream.session import scratch_path

BLOCK_IDS = 1 << 16  # a block is closed by the document that reaches so many ids
WHOLE = (8, 16, 32)  # bits of ids that lie in whole machine words
# A file's rows: a block of whole documents; offsets (32-bit) are where they begin in the payload.
BLOCK = T.StructType([
    T.StructField("part", T.IntegerType()), T.StructField("block", T.IntegerType()),
    T.StructField("first", T.LongType()), T.StructField("n_ids", T.LongType()),
    T.StructField("bits", T.IntegerType()), T.StructField("doc_ids", T.ArrayType(T.LongType())),
    T.StructField("offsets", T.BinaryType()), T.StructField("payload", T.BinaryType())])


def pack(ids: np.ndarray, bits: int) -> bytes:
    """``bits`` bits an id, highest first, without gaps; the last byte is filled with zeros."""
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"an id does not fit into {bits} bits")
    if bits in WHOLE:
        return ids.astype(f">u{bits // 8}").tobytes()
    wide = np.unpackbits(ids.astype(">u4").view(np.uint8).reshape(-1, 4), axis=1)
    return np.packbits(wide[:, 32 - bits:]).tobytes()


def unpack(payload: bytes, bits: int, start: int, end: int) -> np.ndarray:
    """Ids ``start`` to ``end`` of a payload; only their own bytes are touched."""
    if bits in WHOLE:
        return np.frombuffer(payload, f">u{bits // 8}", end - start, start * bits // 8).astype("<u4")
    first, last = start * bits // 8, -(-end * bits // 8)
    flat = np.unpackbits(np.frombuffer(payload, np.uint8, last - first, first))
    flat = flat[start * bits - 8 * first:][: (end - start) * bits].reshape(-1, bits)
    wide = np.zeros((end - start, 32), np.uint8)
    wide[:, 32 - bits:] = flat
    return np.packbits(wide, axis=1).view(">u4").ravel().astype("<u4")


def write_ids(docs: DataFrame, path: str, encoder: Callable, vocabulary: int, end: int = tokens.END) -> None:
    """Encode every text, close it with ``end``, and write the ids to files in ``path``.

    Rows go by ranges of ``doc_id`` (NULL first), so parts, blocks and documents ascend; rows of
    one id are told apart by their text's hash, so even an id of many rows is dealt out. A NULL
    or empty text is its end id alone. ``encoder()`` is called in the task; its ``encode_all`` gives
    the ids of each of many texts as little-endian 32-bit bytes. Only one block is in memory at a time.
    """
    bits = max(1, (vocabulary - 1).bit_length())
    close = tokens.packed([end])

    def run(batches):
        from pyspark import TaskContext

        part, encode = TaskContext.get().partitionId(), encoder().encode_all
        ids, names, offsets, held, block, first = [], [], [0], 0, 0, 0

        def row():
            out = {"part": part, "block": block, "first": first, "n_ids": held, "bits": bits, "doc_ids": names,
                   "offsets": np.array(offsets, "<u4").tobytes(),
                   "payload": pack(np.frombuffer(b"".join(ids), "<u4"), bits)}
            return pa.RecordBatch.from_pylist([out], schema=arrow)

        for b in batches:
            for name, one in zip(b.column("doc_id").to_pylist(), encode(b.column("text")), strict=True):
                one += close
                ids.append(one)
                names.append(name)
                held += len(one) // 4
                offsets.append(held)
                if held >= BLOCK_IDS:
                    yield row()
                    first, block = first + held, block + 1
                    ids, names, offsets, held = [], [], [0], 0
        if names:
            yield row()

    arrow = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()),
                       ("bits", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("offsets", pa.binary()),
                       ("payload", pa.binary())])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("_h"))
    rows = rows.repartitionByRange("doc_id", "_h").sortWithinPartitions("doc_id", "_h").select("doc_id", "text")
    rows.mapInArrow(run, BLOCK).write.parquet(path, compression="none")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """The documents of files written by :func:`write_ids`, a row each: ``doc_id, start`` (ids of
    all documents before it), ``n_tokens, ids`` (little-endian 32-bit)."""
    files = spark.read.schema(BLOCK).parquet(path)
    out = T.StructType([
        T.StructField("part", T.IntegerType()), T.StructField("doc_id", T.LongType()),
        T.StructField("_at", T.LongType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("ids", T.BinaryType())])

    def run(batches):
        for b in batches:
            part, first, bits = (b.column(c).to_pylist() for c in ("part", "first", "bits"))
            for k in range(b.num_rows):
                at = np.frombuffer(b.column("offsets")[k].as_buffer(), "<u4").astype(np.int64)
                flat = unpack(b.column("payload")[k].as_buffer(), bits[k], 0, int(at[-1]))
                n = len(at) - 1
                ids = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((4 * at).astype(np.int32)), pa.py_buffer(flat)])
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(n, part[k], np.int32)), b.column("doc_ids")[k].values,
                    pa.array(first[k] + at[:-1]), pa.array(np.diff(at)), ids], names=out.names)

    # A row for each part, so never more than tasks that wrote: safe to broadcast.
    totals = files.groupBy("part").agg(F.sum("n_ids").alias("_n"))
    before = totals.select("part", F.coalesce(F.sum("_n").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return (files.mapInArrow(run, out).join(F.broadcast(before), "part")
            .select("doc_id", (F.col("_before") + F.col("_at")).alias("start"), "n_tokens", "ids"))



@query("op8_bit_packing")
def op8_bit_packing(spark, folder):
    import public_tokenizers

    file = public_tokenizers.path("word_bpe_49k.json")
    path = scratch_path(spark, "token-files")
    write_ids(table(spark, folder, "documents"), path, lambda: tokens.lower_case(file), 49_408)
    return read_ids(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
