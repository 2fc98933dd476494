"""SentencePiece encoding and decoding: an automaton over the pieces drives a one-pass Viterbi."""

from __future__ import annotations

import re
from array import array

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from evstream.llm import tokens
from evstream.llm.common import query, table, without

SPACE = "▁"
UNKNOWN_PENALTY = 10.0  # fixed value: below the least score, for a character of no piece


class Pieces:
    """The segmentation of largest total score under a model's pieces and scores.

    Of equal totals the one whose last piece is longer wins, piece by piece from the end. A
    character of no piece is written as its UTF-8 bytes where the model has byte pieces, else as
    the unknown id. No piece crosses a place before a blank that follows something else, nor a
    line end, unless the model has such pieces: so words are segmented alone and remembered.
    """

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        normal = [i for i in range(n)
                  if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.auto = ahocorasick.Automaton()
        for i in normal:
            p = sp.id_to_piece(i)
            self.auto.add_word(p, (len(p), sp.get_score(i), i))
        self.auto.make_automaton()
        names = [sp.id_to_piece(i) for i in normal]
        self.single = {p for p in names if len(p) == 1}
        self.unknown = min(map(sp.get_score, normal)) - UNKNOWN_PENALTY
        self.unk = sp.unk_id()
        self.byte_id = {int(sp.id_to_piece(i)[1:-1], 16): i for i in range(n) if sp.is_byte(i)}
        self.out = [b""] * n
        for i in normal:
            self.out[i] = sp.id_to_piece(i).replace(SPACE, " ").encode()
        for b, i in self.byte_id.items():
            self.out[i] = bytes([b])
        self.out[self.unk] = " ⁇ ".encode()
        self.by_word = not any(re.search(f"[^{SPACE}]{SPACE}|\n", p) for p in names)
        self.words = tokens.Words(lambda w: tokens.packed(self.viterbi(w)))

    def viterbi(self, s: str) -> list[int]:
        """Ids of ``s``, in which blanks are already written as :data:`SPACE`."""
        n = len(s)
        best, back = [0.0] + [None] * n, [None] * (n + 1)
        done = 0

        def unknown_to(end):  # relax the steps over single characters that are no piece
            nonlocal done
            while done < end:
                if s[done] not in self.single:
                    score = best[done] + self.unknown
                    if best[done + 1] is None or score > best[done + 1]:
                        best[done + 1], back[done + 1] = score, (done, -1)
                done += 1

        for last, (length, score, i) in self.auto.iter(s):
            unknown_to(last)  # all that ends before this character is settled
            start = last + 1 - length
            score += best[start]
            if best[last + 1] is None or score > best[last + 1]:
                best[last + 1], back[last + 1] = score, (start, i)
        unknown_to(n)
        ids, at = [], n
        while at:
            start, i = back[at]
            if i >= 0:
                ids.append(i)
            elif self.byte_id:
                ids += [self.byte_id[b] for b in reversed(s[start:at].encode())]
            elif not ids or ids[-1] != self.unk:
                ids.append(self.unk)
            at = start
        return ids[::-1]

    def encode(self, text: str | None) -> bytes:
        """Ids (little-endian 32-bit) of ``text`` after a dummy blank; nothing for NULL or empty."""
        if not text:
            return b""
        if not self.by_word:
            return tokens.packed(self.viterbi(SPACE + text.replace(" ", SPACE)))
        look = self.words.__getitem__
        if "  " in text or SPACE in text or text[0] == " " or "\n " in text:
            marked = SPACE + text.replace(" ", SPACE)
            parts = re.findall(f"\n|{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+", marked)
            return b"".join(map(look, parts))
        # Words after a blank carry it; "\n" comes as a word of its own.
        marked = SPACE + text.replace(" ", " " + SPACE).replace("\n", " \n ")
        return b"".join(map(look, marked.split(" ")))

    def decode(self, ids: bytes) -> str:
        text = b"".join(map(self.out.__getitem__, array("I", ids))).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text


def pieces(path: str) -> Pieces:
    return tokens.kept_by_worker(f"pieces:{path}", lambda: Pieces(path))


def _mapped(df: DataFrame, source: str, into: str, kind, arrow, convert) -> DataFrame:
    df = without(df, into)
    schema = T.StructType([*df.schema.fields, T.StructField(into, kind)])

    def run(batches):
        one = convert()
        for b in batches:
            made = pa.array([one(x) for x in b.column(source).to_pylist()], arrow)
            yield pa.RecordBatch.from_arrays([*b.columns, made], [*b.schema.names, into])

    return df.mapInArrow(run, schema)


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` with ``ids``: the pieces of ``text`` as little-endian 32-bit ids. NULL and empty
    texts get none; an ``ids`` column already there is replaced. Nothing is shuffled."""
    return _mapped(docs, "text", "ids", T.BinaryType(), pa.binary(), lambda: pieces(path).encode)


def decoded(docs: DataFrame, path: str, into: str = "decoded") -> DataFrame:
    """``docs`` with the text of its ``ids``: exact, save that U+2581 comes back as a blank and,
    without byte pieces, unknown characters as the unknown sign. NULL ids give NULL."""
    return _mapped(docs, "ids", into, T.StringType(), pa.string(),
                   lambda: (lambda f: lambda x: None if x is None else f(x))(pieces(path).decode))


@query("op3_sentence_pieces")
def op3_sentence_pieces(spark, folder):
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    both = decoded(encoded(table(spark, folder, "documents").select("doc_id", "text"), path), path)
    text = F.coalesce(F.col("text"), F.lit(""))
    return both.select(
        "doc_id", F.expr("octet_length(ids) div 4").alias("n_pieces"), F.crc32("ids").alias("ids_crc32"),
        F.crc32(F.col("decoded").cast("binary")).alias("decoded_crc32"),
        (F.col("decoded") == F.translate(text, SPACE, " ")).alias("round_trip"))
