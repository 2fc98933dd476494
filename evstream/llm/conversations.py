"""Conversation structure repair: cheapest edits by Four-Russians block tables.

A conversation is a string of row symbols. From right to left, a vector says what the rest costs
from each place of the grammar ``(s?(ua)+)?``; less its last entry it takes few values, so blocks of
symbols are looked up in tables of (vector, block) -> (vector, cost). Only the values at the ends
of blocks are kept: a block is expanded again, backward, when the edits are traced forward.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from evstream.llm.common import grows, query, saved, table
from evstream.llm.tokens import kept_by_worker

BLANKS = " \t\n\x0b\x0c\r"
LEGAL = ("su", "ua", "au")
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
BLOCK = 4  # symbols looked up at once
PIECE = 32_768  # rows of a conversation whose symbols stand in one row
MUST_DELETE = 8  # symbols: initial (s, u, a, other) + 4 if truncated, or this one
SYMBOLS = 9
# Places in the grammar: nothing yet, after s, after u, after a. Rows and inserts move between them.
START, SYSTEM, USER, ASSISTANT = range(4)
EXPECTS = {START: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
AFTER = {"u": USER, "a": ASSISTANT}
FAR = 1 << 20


def _closed(raw: list[int]) -> tuple[int, ...]:
    """Costs with inserts before the next row allowed."""
    user, assistant = min(raw[USER], INSERT + raw[ASSISTANT]), min(raw[ASSISTANT], INSERT + raw[USER])
    return min(raw[START], INSERT + user), min(raw[SYSTEM], INSERT + user), user, assistant


def _row_edits(symbol: int, place: int) -> list[tuple[str, int, int]]:
    """(edit, cost, place after it) of a row, in ASCII order; each letter occurs once at most."""
    out = [("D", DELETE, place)]
    if symbol != MUST_DELETE:
        initial, extra = "sua?"[symbol % 4], TRUNCATED * (symbol // 4)
        if initial == EXPECTS[place]:
            out.append(("K", extra, AFTER[initial]))
        elif initial == "s" and place == START:
            out.append(("K", extra, SYSTEM))
        out.append(("R" + EXPECTS[place], REROLE + extra, AFTER[EXPECTS[place]]))
    return out


class Blocks:
    """Vectors that can occur, less their last entry, and what each block of symbols makes of them."""

    def __init__(self, block: int = BLOCK):
        end = _closed([0, FAR, FAR, 0])
        self.block, self.vectors, ids = block, [end], {end: 0}
        to, off = [], []
        for v in self.vectors:  # grows while it is walked
            for s in range(SYMBOLS):
                b = _closed([min(c + v[q] for _, c, q in _row_edits(s, p)) for p in range(4)])
                off.append(b[ASSISTANT])
                b = tuple(x - b[ASSISTANT] for x in b)
                if b not in ids:
                    ids[b] = len(ids)
                    self.vectors.append(b)
                to.append(ids[b])
        self.to = np.array(to, np.int32).reshape(-1, SYMBOLS)
        self.off = np.array(off, np.int32).reshape(-1, SYMBOLS)
        # The first symbol of a block is the last digit of its number and the last to be passed.
        far_to, far_off = self.to, self.off
        for _ in range(block - 1):
            far_off = (far_off[:, :, None] + self.off[far_to]).reshape(len(self.vectors), -1)
            far_to = self.to[far_to].reshape(len(self.vectors), -1)
        self.far_to, self.far_off = far_to.tolist(), far_off.tolist()
        self.one_to, self.one_off = self.to.tolist(), self.off.tolist()
        self.weights = SYMBOLS ** np.arange(block)
        self.edits = lru_cache(maxsize=None)(self._edits)  # vectors x symbols x places at most

    def back(self, symbols: np.ndarray, vector: int) -> tuple[list[int], int]:
        """Vectors at the ends of blocks, from the right, the last one at the left end of all
        symbols; and the cost gathered on the way."""
        head = len(symbols) % self.block
        ends, cost = [vector], 0
        for code in (symbols[head:].reshape(-1, self.block) @ self.weights)[::-1].tolist():
            cost += self.far_off[vector][code]
            vector = self.far_to[vector][code]
            ends.append(vector)
        for s in symbols[:head][::-1].tolist():
            cost += self.one_off[vector][s]
            vector = self.one_to[vector][s]
        if head:
            ends.append(vector)
        return ends, cost

    def _edits(self, vector: int, symbol: int, place: int) -> tuple[str, int]:
        """Inserts before a row and the row's edit, ASCII-least among the cheapest; ``vector`` is the
        one after the row."""
        after = self.vectors[vector]
        costs = _closed([min(c + after[q] for _, c, q in _row_edits(symbol, p)) for p in range(4)])
        out = ""
        while True:
            steps = {e: q for e, c, q in _row_edits(symbol, place) if c + after[q] == costs[place]}
            role = EXPECTS[place]
            if INSERT + costs[AFTER[role]] == costs[place]:
                steps["I" + role] = AFTER[role]
            edit = min(steps)
            out, place = out + edit, steps[edit]
            if edit[0] != "I":
                return out, place

    def trace(self, symbols: np.ndarray, vector: int, place: int) -> tuple[list[str], int]:
        """The edits of each row, from the left. A block's vectors are made again from the right."""
        ends, _ = self.back(symbols, vector)
        head = len(symbols) % self.block
        starts = [*([0] if head else []), *range(head, len(symbols), self.block)]
        out = []
        for k, first in enumerate(starts):
            v = ends[len(starts) - 1 - k]
            part = symbols[first:head if first < head else first + self.block].tolist()
            inside = [v]
            for s in part[:0:-1]:
                v = self.one_to[v][s]
                inside.append(v)
            for s, v in zip(part, reversed(inside), strict=True):
                edit, place = self.edits(v, s, place)
                out.append(edit)
        return out, place


def finish(place: int) -> str:
    """Inserts after the last row."""
    return {SYSTEM: "IuIa", USER: "Ia"}.get(place, "")


def _tables() -> Blocks:
    return kept_by_worker("conversation-blocks", Blocks)


def _rows(batches):
    for b in batches:
        yield from zip(*[c.to_pylist() for c in b.columns], strict=True)


def _in_batches(rows, schema: pa.Schema, size: int = 1000):
    held = []
    for r in rows:
        held.append(r)
        if len(held) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def _backward(batches):
    """Pieces of conversations, the last first: adds the vector at the right end of each and the cost
    of what follows it. Holds one piece."""

    def found():
        t = _tables()
        for _, pieces in groupby(_rows(batches), key=lambda r: r[0]):
            vector, cost = 0, 0
            for key, piece, symbols in pieces:
                symbols = bytes(s["symbol"] for s in sorted(symbols, key=lambda s: s["pos"]))
                yield key, piece, symbols, vector, cost
                ends, more = t.back(np.frombuffer(symbols, np.uint8).astype(np.int64), vector)
                vector, cost = ends[-1], cost + more

    yield from _in_batches(found(), pa.schema([
        ("key", pa.string()), ("piece", pa.int64()), ("symbols", pa.binary()), ("vector", pa.int32()), ("cost", pa.int64())]), 100)


def _forward(batches):
    """The same pieces, the first first: the edits of each row and, with the first piece, the cost."""

    def found():
        t = _tables()
        for _, pieces in groupby(_rows(batches), key=lambda r: r[0]):
            place, held = START, None
            for key, piece, symbols, vector, cost in pieces:
                if held:
                    yield held
                symbols = np.frombuffer(symbols, np.uint8).astype(np.int64)
                if piece == 0:
                    ends, more = t.back(symbols, vector)
                    cost += more + t.vectors[ends[-1]][START]
                else:
                    cost = None
                edits, place = t.trace(symbols, vector, place)
                held = (key, piece, edits, cost)
            held[2][-1] += finish(place)
            yield held

    yield from _in_batches(found(), pa.schema([
        ("key", pa.string()), ("piece", pa.int64()), ("edits", pa.list_(pa.string())), ("cost", pa.int64())]), 100)


def _edited(batches):
    """Rows (key, piece, kind, pos, role, text, edits, cost), the edits of a piece before its rows:
    (key, edit, role, text, cost) of every edit in order, role and text NULL where a row goes."""
    named = {"u": "user", "a": "assistant"}
    for key, rows in groupby(_rows(batches), key=lambda r: r[0]):
        edits, at, total = [], 0, 0
        for _, _, kind, _, role, text, found, cost in rows:
            if kind == 0:
                edits, at = found, 0
                total = total if cost is None else cost
                continue
            step, at, k = edits[at], at + 1, 0
            while k < len(step):
                edit, to = step[k], named.get(step[k + 1:k + 2])
                k += 2 if edit in "IR" else 1
                if edit == "D":
                    yield key, "D", None, None, total
                else:
                    yield key, edit, (role if edit == "K" else to), ("" if edit == "I" else text), total


def _digests(batches):
    """Cost, audit and SHA-256 of every conversation, its texts streaming by."""

    def found():
        import hashlib

        for key, edits in groupby(_edited(batches), key=lambda e: e[0]):
            digest, audit, first, total = hashlib.sha256(), [], True, 0
            for _, edit, role, text, cost in edits:
                audit.append(edit)
                total = cost
                if role is not None:
                    digest.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                    first = False
            yield key, total, "".join(audit), digest.hexdigest()

    yield from _in_batches(found(), pa.schema([
        ("key", pa.string()), ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())]))


def _repaired(batches):
    """The rows of every repaired conversation, numbered from 0."""

    def found():
        for key, edits in groupby(_edited(batches), key=lambda e: e[0]):
            n = 0
            for _, edit, role, text, _ in edits:
                if role is not None:
                    yield key, n, role, text, edit
                    n += 1

    yield from _in_batches(found(), pa.schema([
        ("key", pa.string()), ("seq", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())]))


def _spaced(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def undamaged(conversations: DataFrame) -> DataFrame:
    """All rows as they are, in the form that :func:`faults` takes."""
    return conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), _spaced("role").alias("role"), _spaced("text").alias("text"),
        _spaced("role").alias("role_was"), F.lit(1).alias("copies"), F.lit(9).alias("harm"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Harm a part of the rows, chosen by a checksum of conversation and turn: 0 drops the row, 1
    empties its text, 2 takes its closing marks, 3 repeats it, 4 calls it a user's."""
    harm = (F.crc32(F.concat(_spaced("conv_id"), F.lit(":"), _spaced("turn")).cast("binary")) % 20).cast("int")
    return undamaged(conversations).withColumn("harm", harm).withColumn(
        "role", F.when(F.col("harm") == 4, "user").otherwise(F.col("role"))).withColumn(
        "copies", F.when(F.col("harm") == 0, 0).when(F.col("harm") == 3, 2).otherwise(1))


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows in order, with what can be said of each by itself. ``h`` names role and text."""
    key, initial = _spaced("conv_id"), F.substring("role", 1, 1)
    order = Window.partitionBy("key").orderBy(F.col("turn").asc_nulls_first(), "role_was", "text", "copy")
    rows = rows.where("copies > 0").select(key.alias("key"), "*", F.explode(F.sequence(F.lit(1), "copies")).alias("copy"))
    rows = rows.select("*", F.row_number().over(order).cast("long").alias("pos"), F.lag(initial).over(order).alias("before"))
    text = F.when(F.col("harm") == 1, "").when(F.col("harm") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    rows = rows.withColumn("text", text)
    bare = F.rtrim(F.col("text"), F.lit(BLANKS))
    last = F.substring(bare, -1, 1)
    return rows.select(
        "key", "turn", "pos", F.floor((F.col("pos") - 1) / PIECE).alias("piece"), "role", "text",
        F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")).alias("h"),
        initial.alias("initial"), (bare == "").alias("blank"), (~last.isin(".", "!", "?")).alias("cut"),
        (F.col("before").isNotNull() & ~F.concat("before", initial).isin(*LEGAL)).alias("illegal"))


def _marked(rows: DataFrame) -> DataFrame:
    """Adds ``duplicate``, ``truncated`` (first faults) and the symbol of each row; texts stay behind."""
    slim = rows.drop("role", "text")
    first = slim.groupBy("key", "h").agg(F.min("pos").alias("first"))
    marked = slim.join(grows(first), ["key", "h"])
    duplicate = ~F.col("blank") & (F.col("pos") > F.col("first"))
    marked = marked.withColumn("duplicate", duplicate).withColumn("truncated", ~F.col("blank") & ~duplicate & F.col("cut"))
    kind = F.when(F.col("initial") == "s", 0).when(F.col("initial") == "u", 1).when(F.col("initial") == "a", 2).otherwise(3)
    symbol = F.when(F.col("blank") | F.col("duplicate"), MUST_DELETE).otherwise(kind + F.when(F.col("truncated"), 4).otherwise(0))
    return marked.select("key", "turn", "pos", "piece", "blank", "duplicate", "truncated", "illegal", symbol.alias("symbol"))


def _with_edits(rows: DataFrame, marked: DataFrame) -> DataFrame:
    """Rows and edits together, dealt by conversation and sorted for :func:`_edited`."""
    pieces = marked.groupBy("key", "piece").agg(F.collect_list(F.struct("pos", "symbol")).alias("symbols"))  # PIECE at most
    chained = pieces.repartition("key").sortWithinPartitions("key", F.desc("piece")).mapInArrow(
        _backward, "key string, piece long, symbols binary, vector int, cost long")
    edits = chained.sortWithinPartitions("key", "piece").mapInArrow(
        _forward, "key string, piece long, edits array<string>, cost long")
    zero, none = F.lit(0).cast("long"), F.lit(None)
    both = edits.select("key", "piece", F.lit(0).alias("kind"), zero.alias("pos"), none.cast("string").alias("role"),
                        none.cast("string").alias("text"), "edits", "cost").union(
        rows.select("key", "piece", F.lit(1), "pos", "role", "text", none.cast("array<string>"), none.cast("long")))
    return both.repartition("key").sortWithinPartitions("key", "piece", "kind", "pos")


def repair(rows: DataFrame) -> DataFrame:
    """``conv_id, seq, role, text, edit`` of every repaired conversation: what stays (K), what has
    another role (R) and what was put in (I, with an empty text). For the rules see :func:`audit`."""
    done = saved(_numbered(rows), "turns")
    out = _with_edits(done, saved(_marked(done), "marks")).mapInArrow(
        _repaired, "key string, seq long, role string, text string, edit string")
    ids = rows.select(_spaced("conv_id").alias("key"), "conv_id").distinct()
    return out.join(grows(ids), "key").drop("key")


def audit(rows: DataFrame) -> DataFrame:
    """Faults and cheapest edits of every conversation: ``conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit, repaired_sha256``.

    ``rows`` come from :func:`damaged` or :func:`undamaged`. NULL roles and texts are one space, so
    the row is blank or of no known role; a NULL turn comes first and counts in no gap; a NULL
    conversation is one of its own. Rows of one turn are in order of role and text as given; repeated rows
    are duplicates of the first. An empty role, like an unknown one, can be kept nowhere.
    Conversations without a row left have zeros, an empty audit and the hash of nothing. Role and
    text are compared by a 128-bit digest. Other columns are left out; an empty table gives an empty one.
    Texts stream by, sorted; of a conversation of any length a task holds one piece's symbols, its
    audit and its hash (the hash of a whole conversation has to be made in order).
    """
    done = saved(_numbered(rows), "turns")
    marked = saved(_marked(done), "marks")
    whole = lambda name: F.sum(F.col(name).cast("long")).alias(name)
    counts = marked.groupBy("key").agg(
        (F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn")).alias("gaps"),
        *[whole(n) for n in ("blank", "duplicate", "truncated", "illegal")])
    digests = _with_edits(done, marked).mapInArrow(_digests, "key string, cost long, audit string, repaired_sha256 string")
    ids = rows.select(_spaced("conv_id").alias("key"), "conv_id").distinct()
    out = ids.join(grows(counts), "key", "left").join(grows(digests), "key", "left")
    numbers = [F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


@query("op12_conversations")
def op12_conversations(spark, folder):
    return audit(damaged(table(spark, folder, "conversations")))
