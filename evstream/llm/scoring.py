"""Language-model scores by deleted interpolation.

Texts become blocks of word codes once. Every block sends the hashes of its distinct n-grams with
their counts to the range each hash lies in, gets the counts of the whole corpus back for those it
asked about, and can then score its own documents; no table of n-grams is sent whole to anyone.
Mixture weights come from documents that were left out of the counts, by expectation-maximisation.
"""

from __future__ import annotations

import re
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from evstream.llm.common import grows, query, saved, table
from evstream.llm.minhash import mixed

ORDER = 2  # longest n-gram
ADDED = 0.1  # of the base score
BLOCK = 1_000_000  # tokens of a block; a longer document goes on in the next one
RANGE = 2_000_000  # tokens of the corpus for each range of hashes, so that a range fits in a task
READ = 1 << 22  # bytes of a text taken apart at once
DEEPEST = 15  # bucket of contexts seen 2 ** 14 times or more
ROUNDS, SMALL_GAIN = 40, 1e-5  # rounds of expectation-maximisation, and the gain a token that ends them
PRIOR = 1.0  # tokens that every usable component is given beforehand, so that no weight is zero
REST, TUNING, HELD_OUT = 0, 1, 2  # what documents are for
END, BEFORE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)  # stand for the end, and for what is before the start

BLOCKS = ("block long, tuning boolean, tokens long, rest_tokens long, rest_docs long, train_tokens long, train_docs long, "
          "words binary, codes binary, docs array<struct<doc_id:long,row:long,fold:int,skip:int,length:int>>")


def _packed(x: np.ndarray) -> bytes:
    """Little-endian bytes, the lowest bytes of all numbers first, compressed."""
    planes = np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.dtype.itemsize).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes, dtype: str, n: int) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    planes = np.frombuffer(pa.decompress(data, decompressed_size=n * size, codec="zstd"), np.uint8)
    return np.ascontiguousarray(planes.reshape(size, n).T).reshape(-1).view(dtype)


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of the words, A-Z lowered, and of the end. Long texts are taken in parts."""
    from xxhash import xxh3_64_intdigest

    data, parts, at = (text or "").encode().lower(), [], 0
    while at < len(data):
        stop = min(len(data), at + READ)
        if stop < len(data):
            blank = re.compile(rb"[\x20\x09-\x0D]").search(data, stop)
            stop = blank.start() if blank else len(data)
        words = data[at:stop].split()
        parts.append(np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words)))
        at = stop
    return np.concatenate([*parts, np.array([END])])


def _encoded(docs: DataFrame, order: int) -> DataFrame:
    """Documents as blocks of word codes: those that weights are learned from in blocks of their own."""
    context = order - 1

    def run(batches):
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << 33
        made, row = 0, 0
        held: dict[bool, list] = {False: [], True: []}
        size = {False: 0, True: 0}
        schema = pa.schema([
            ("block", pa.int64()), ("tuning", pa.bool_()), *[(n, pa.int64()) for n in ("tokens", "rest_tokens", "rest_docs", "train_tokens", "train_docs")],
            ("words", pa.binary()), ("codes", pa.binary()), ("docs", pa.list_(pa.struct([
                ("doc_id", pa.int64()), ("row", pa.int64()), ("fold", pa.int32()), ("skip", pa.int32()), ("length", pa.int32())])))])

        def close(tuning):
            nonlocal made
            parts, held[tuning], size[tuning] = held[tuning], [], 0
            words, codes = np.unique(np.concatenate([h for *_, h in parts]), return_inverse=True)
            often = np.argsort(-np.bincount(codes), kind="stable")  # frequent words get small codes
            rank = np.empty_like(often)
            rank[often] = np.arange(len(often))
            own = [(fold, len(h) - skip, h[-1] == END) for _, _, fold, skip, h in parts]
            total = lambda *folds: (sum(n for f, n, _ in own if f in folds), sum(e for f, _, e in own if f in folds))
            rest, train = total(REST), total(REST, TUNING)
            made += 1
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((
                first + made, tuning, len(codes), *map(int, rest), *map(int, train), words[often].tobytes(),
                _packed(rank[codes].astype("<u4")),
                [{"doc_id": i, "row": r, "fold": f, "skip": s, "length": len(h)} for i, r, f, s, h in parts]), schema, strict=True)], schema=schema)

        for b in batches:
            for doc_id, fold, text in zip(*[c.to_pylist() for c in b.columns], strict=True):
                h, skip, row, tuning = word_hashes(text), 0, row + 1, fold == TUNING
                while True:
                    # A part that does not start its document repeats the words before it.
                    held[tuning].append((doc_id, first + row, fold, skip, h[:BLOCK]))
                    size[tuning] += min(len(h), BLOCK)
                    if size[tuning] >= BLOCK:
                        yield close(tuning)
                    if len(h) <= BLOCK:
                        break
                    h, skip = h[BLOCK - context:], context
        for tuning, parts in held.items():
            if parts:
                yield close(tuning)

    # A checksum of the id as text says what a document is for; no id counts as an empty text.
    crc = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    fold = F.when(crc % 10 == 0, HELD_OUT).when(F.floor(crc / 10) % 10 == 0, TUNING).otherwise(REST).cast("int")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), fold.alias("fold"), "text").mapInArrow(run, BLOCKS)


class _Block:
    """A block's n-grams: ``keys[k]`` are its distinct hashes of order k + 1, ascending, ``at[k]`` says
    which of them ends at each token."""

    def __init__(self, row: dict, order: int):
        self.docs = row["docs"]
        words = np.frombuffer(row["words"], np.uint64)
        h = words[_unpacked(row["codes"], "<u4", row["tokens"])]
        lengths = np.array([d["length"] for d in self.docs])
        self.start = np.r_[0, np.cumsum(lengths)[:-1]]
        self.doc = np.repeat(np.arange(len(lengths)), lengths)
        self.place = np.arange(len(h)) - self.start[self.doc]
        self.fold = np.array([d["fold"] for d in self.docs])[self.doc]
        skip = np.array([d["skip"] for d in self.docs])
        self.counted = self.place >= skip[self.doc]
        self.opening = (self.place == 0) & (skip[self.doc] == 0)
        self.keys, self.at, gram, before = [], [], None, BEFORE
        for k in range(order):
            with np.errstate(over="ignore"):
                if gram is None:
                    gram = mixed(h + np.uint64(1))
                else:
                    last = np.r_[np.uint64(0), gram[:-1]]
                    last[self.place == 0] = before
                    gram = mixed(last * np.uint64(0x9E3779B97F4A7C15) + h + np.uint64(k + 1))
                    before = mixed(np.array([before * np.uint64(0x9E3779B97F4A7C15)]) + BEFORE + np.uint64(k + 1))[0]
            keys, at = np.unique(gram, return_inverse=True)
            self.keys.append(keys)
            self.at.append(at.astype(np.int32))

    def counts(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """How often each key stands in documents to count, and in those that weights are learned from."""
        n = len(self.keys[k])
        return tuple(np.bincount(self.at[k][self.counted & (self.fold == f)], minlength=n) for f in (REST, TUNING))


def _dicts(batches):
    for b in batches:
        yield from b.to_pylist()


def _asked(order: int, ranges: int):
    """Every block's keys, in ranges of hashes, as gaps of as few bytes as they need; with counts."""
    schema = pa.schema([("range", pa.int64()), ("block", pa.int64()), ("kind", pa.int32()), ("n", pa.int64()), ("width", pa.int32()),
                        ("first", pa.int64()), ("gaps", pa.binary()), ("rest", pa.binary()), ("tuning", pa.binary())])

    def run(batches):
        for row in _dicts(batches):
            b = _Block(row, order)
            for k, keys in enumerate(b.keys):
                rest, tuning = b.counts(k)
                part = ((keys >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)  # rises with the key
                edge = np.r_[0, np.flatnonzero(part[1:] != part[:-1]) + 1, len(keys)].tolist()
                out = []
                for lo, hi in zip(edge[:-1], edge[1:], strict=True):
                    gaps = np.diff(keys[lo:hi])
                    width = (int(gaps.max(initial=0)).bit_length() + 7) // 8
                    out.append((int(part[lo]), row["block"], k, hi - lo, width, int(keys[lo:lo + 1].view(np.int64)[0]),
                                gaps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes(),
                                _packed(rest[lo:hi].astype("<u8")), _packed(tuning[lo:hi].astype("<u8"))))
                    if len(out) >= 100:
                        yield _batch(out, schema)
                        out = []
                if out:
                    yield _batch(out, schema)

    return run


def _batch(rows, schema):
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


ANSWERS = "block long, kind int, range long, n long, train binary, rest binary, known long"


def _answered(rows: pa.Table) -> pa.Table:
    """All that was asked in one range: counts over the corpus, for each block in the order it asked.
    A row with no block says how many different words of training documents the range holds."""
    schema = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("range", pa.int64()), ("n", pa.int64()),
                        ("train", pa.binary()), ("rest", pa.binary()), ("known", pa.int64())])
    out = []
    for kind, group in groupby(sorted(rows.to_pylist(), key=lambda r: r["kind"]), key=lambda r: r["kind"]):
        group, keys = list(group), []
        for r in group:
            gaps = np.zeros((r["n"] - 1, 8), np.uint8)
            gaps[:, :r["width"]] = np.frombuffer(r["gaps"], np.uint8).reshape(r["n"] - 1, r["width"])
            first = np.array([r["first"]], np.int64).view(np.uint64)
            keys.append(np.cumsum(np.r_[first, gaps.reshape(-1).view("<u8")], dtype=np.uint64))
        all_keys, at = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.zeros((2, len(all_keys)), np.int64)
        lo = 0
        for r, own in zip(group, keys, strict=True):
            for f, name in enumerate(("rest", "tuning")):
                total[f, at[lo:lo + len(own)]] += _unpacked(r[name], "<u8", r["n"]).astype(np.int64)
            lo += len(own)
        train, lo = total[0] + total[1], 0
        for r, own in zip(group, keys, strict=True):
            mine, lo = at[lo:lo + len(own)], lo + len(own)
            out.append((r["block"], kind, r["range"], len(own), _packed(train[mine].astype("<u8")), _packed(total[0][mine].astype("<u8")), 0))
        if kind == 0:
            out.append((None, kind, group[0]["range"], 0, b"", b"", int((train > 0).sum())))
    return pa.Table.from_batches([_batch(out, schema)] if out else [], schema)


def _with_answers(blocks: DataFrame, answers: DataFrame) -> DataFrame:
    """Each block with the counts of its keys, a bounded list: it asked in ranges of its own keys."""
    got = answers.where("block is not null").groupBy("block").agg(
        F.collect_list(F.struct("kind", "range", "n", "train", "rest")).alias("answers"))
    return blocks.join(grows(got), "block")


def _tables(row: dict, order: int, name: str) -> list[np.ndarray]:
    """For each order, the counts of the block's keys."""
    out = []
    for k in range(order):
        own = sorted((a for a in row["answers"] if a["kind"] == k), key=lambda a: a["range"])
        out.append(np.concatenate([_unpacked(a[name], "<u8", a["n"]).astype(np.int64) for a in own]) if own else np.zeros(0, np.int64))
    return out


def buckets(counts: np.ndarray) -> np.ndarray:
    """0 for contexts never seen, 1 for once, 2 for twice or three times, and so on by doubling."""
    return np.minimum(np.frexp(counts.astype(np.float64))[1], DEEPEST)


def _estimates(b: _Block, tables: list[np.ndarray], tokens: int, docs: int, vocabulary: int):
    """Of every token: the bucket of its contexts, and a row of estimates, uniform, by word, and by
    context of rising length (zero where a context was never seen)."""
    n = len(b.doc)
    p = np.zeros((len(tables) + 1, n))
    p[0] = 1 / (vocabulary + 1)
    p[1] = tables[0][b.at[0]] / max(tokens, 1)
    bucket = np.zeros(n, np.int64)
    for k in range(1, len(tables)):
        context = np.r_[0, tables[k - 1][b.at[k - 1]][:-1]]
        context[b.opening] = docs  # nothing but what is before the start
        p[k + 1] = np.where(context > 0, tables[k][b.at[k]] / np.maximum(context, 1), 0)
        bucket = bucket * (DEEPEST + 1) + buckets(context)
    return bucket, p


def start_weights(bucket: int, order: int) -> np.ndarray:
    """Equal weights of what a bucket can use: a context of n words only if it was seen."""
    use = [1.0, 1.0]
    for k in range(order - 2, -1, -1):
        use.append(float(bucket // (DEEPEST + 1) ** k % (DEEPEST + 1) > 0))
    return np.array(use) / sum(use)


def _events(order: int, tokens: int, docs: int, vocabulary: int):
    """Tokens of documents that were left out of the counts: bucket and estimates, equal ones once."""
    schema = pa.schema([("bucket", pa.int64()), ("n", pa.int64()), ("times", pa.binary()), ("p", pa.binary())])

    def run(batches):
        for row in _dicts(batches):
            b = _Block(row, order)
            bucket, p = _estimates(b, _tables(row, order, "rest"), tokens, docs, vocabulary)
            own = b.counted & (b.fold == TUNING)
            bucket, p = bucket[own], p[:, own]
            rows, times = np.unique(np.vstack([bucket.astype(np.float64), p[1:]]), axis=1, return_counts=True)
            for k in np.unique(rows[0]):
                at = np.flatnonzero(rows[0] == k)
                yield _batch([(int(k), len(at), _packed(times[at].astype("<i8")), _packed(np.ascontiguousarray(rows[1:, at]).reshape(-1)))], schema)

    return run


def learned(events: DataFrame, order: int, vocabulary: int) -> dict[int, list[float]]:
    """Mixture weights of every bucket, by expectation-maximisation until a token gains next to nothing.
    A round is one pass over the events; the driver gets a sum for each bucket and component."""
    weights: dict[int, list[float]] = {}
    last = None
    for _ in range(ROUNDS):
        now = dict(weights)

        def expect(batches, now=now):
            sums: dict[int, np.ndarray] = {}
            for r in _dicts(batches):
                times = _unpacked(r["times"], "<i8", r["n"])
                p = np.vstack([np.full(r["n"], 1 / (vocabulary + 1)), _unpacked(r["p"], "<f8", r["n"] * order).reshape(order, -1)])
                w = np.array(now.get(r["bucket"], start_weights(r["bucket"], order)))[:, None] * p
                total = w.sum(0)
                got = np.r_[(w / total * times).sum(1), (np.log(total) * times).sum(), times.sum()]
                sums[r["bucket"]] = sums.get(r["bucket"], 0) + got
            if sums:
                yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array([s.tolist() for s in sums.values()], pa.list_(pa.float64()))],
                                                 names=["bucket", "sums"])

        made = events.mapInArrow(expect, "bucket long, sums array<double>").select("bucket", F.posexplode("sums").alias("i", "s"))
        gain, size, found = 0.0, 0.0, {}
        for r in made.groupBy("bucket", "i").agg(F.sum("s").alias("s")).collect():
            found.setdefault(r["bucket"], np.zeros(order + 3))[r["i"]] = r["s"]
        for k, s in found.items():
            prior = PRIOR * (start_weights(k, order) > 0)
            weights[k] = ((s[:order + 1] + prior) / (s[:order + 1] + prior).sum()).tolist()
            gain, size = gain + s[order + 1], size + s[order + 2]
        if not found or last is not None and gain - last < SMALL_GAIN * size:
            break
        last = gain
    return weights


def _scores(order: int, tokens: int, docs: int, vocabulary: int, weights: dict[int, list[float]]):
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
                        ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def run(batches):
        for row in _dicts(batches):
            b = _Block(row, order)
            tables = _tables(row, order, "train")
            bucket, p = _estimates(b, tables, tokens, docs, vocabulary)
            kinds, at = np.unique(bucket, return_inverse=True)
            w = np.array([weights.get(int(k), start_weights(int(k), order)) for k in kinds]).reshape(len(kinds), order + 1)
            mixed_p = np.zeros(len(at))
            for k in range(order + 1):
                mixed_p += w[:, k][at] * p[k]
            each = np.log10(mixed_p) * b.counted
            count = tables[0][b.at[0]]
            base = np.log10((count + ADDED) / (tokens + ADDED * (vocabulary + 1))) * b.counted
            sums = [np.add.reduceat(x, b.start) for x in (b.counted.astype(np.int64), ((count > 0) & b.counted).astype(np.int64), base, each)]
            yield pa.RecordBatch.from_arrays([
                pa.array([d["row"] for d in b.docs], pa.int64()), pa.array([d["doc_id"] for d in b.docs], pa.int64()),
                pa.array([d["fold"] == HELD_OUT for d in b.docs]), *[pa.array(s) for s in sums]], schema=schema)

    return run


def scored(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    Tokens are the words of the text, A-Z lowered, and one end; a NULL or empty text has the end
    alone. Documents whose id's checksum ends in 0 are held out, the others are learned from; a NULL
    id counts as an empty text and is held out. Repeated rows count and come out as often as they
    occur. ``score`` mixes estimates of up to ``order`` words: relative counts over all training
    documents, and 1 / (different words + 1), so that unknown words have a share. Weights depend on how often
    the contexts were seen; they are learned from a tenth of the training documents, with counts
    of the rest. Words are told apart by 64-bit hashes. Without training documents all estimates
    but the last are zero. An empty table gives an empty one; other columns are left out.
    """
    blocks = saved(_encoded(docs, order), "blocks")
    facts = blocks.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in ("tokens", "rest_tokens", "rest_docs", "train_tokens", "train_docs")]).first()
    ranges = max(1, -(-facts["tokens"] // RANGE))
    asked = blocks.mapInArrow(_asked(order, ranges), "range long, block long, kind int, n long, width int, first long, gaps binary, rest binary, tuning binary")
    answers = saved(asked.groupBy("range").applyInArrow(_answered, ANSWERS), "answers")
    vocabulary = answers.where("block is null").agg(F.coalesce(F.sum("known"), F.lit(0))).first()[0]
    tuning = _with_answers(blocks.where("tuning"), answers)
    events = saved(tuning.mapInArrow(_events(order, facts["rest_tokens"], facts["rest_docs"], vocabulary), "bucket long, n long, times binary, p binary"), "events")
    weights = learned(events, order, vocabulary)
    parts = _with_answers(blocks, answers).mapInArrow(
        _scores(order, facts["train_tokens"], facts["train_docs"], vocabulary, weights),
        "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    whole = parts.groupBy("row").agg(  # parts of a long document
        F.first("doc_id").alias("doc_id"), F.first("held_out").alias("held_out"),
        *[F.sum(n).alias(n) for n in ("n_tokens", "n_known", "base_score", "score")])
    return whole.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(facts["train_tokens"]).cast("long").alias("train_tokens"), "base_score", "score")


@query("op13_scoring")
def op13_scoring(spark, folder):
    return scored(table(spark, folder, "documents"))
