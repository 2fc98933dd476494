"""The registered queries and the stages of the pipeline, on a small table, against plain restatements."""

import hashlib
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from evstream.llm import lines, quality, secrets
from evstream.llm.common import saved, table
from evstream.llm.queries import QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] for r in table(spark, DATA, "documents").select("doc_id", "text").collect()}


def rows(spark, name, *columns):
    df = QUERIES[name](spark, DATA)
    assert list(df.columns[:1 + len(columns)]) == [df.columns[0], *columns], df.columns
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_op1(spark):
    vectors = [(r["vec_id"], r["embedding"]) for r in table(spark, DATA, "embeddings").select("vec_id", "embedding").collect()]
    got = rows(spark, "op1_embedding_join", "n_links", "component_id", "kept")
    assert got == {i: (n, c, c == i) for i, (n, c) in brute.vectors(vectors).items()}


def test_op2(spark, texts):
    got = rows(spark, "op2_secret_scan", "n_assign", "n_access", "n_hex", "base_sha256", "spans")
    assert {i: r[:4] for i, r in got.items()} == {i: brute.secrets(t) for i, t in texts.items()}
    for *_, said in got.values():
        own = [s for s in said.split(",") if s.split(":")[0] in secrets.BASE_KINDS]
        assert [int(s.split(":")[1]) for s in said.split(",") if s] == sorted(int(s.split(":")[1]) for s in said.split(",") if s)
        assert sha(",".join(own)) in {r[3] for r in got.values()}


def test_op3(spark, texts):
    got = rows(spark, "op3_sentence_pieces", "n_pieces", "ids_crc32", "decoded_crc32", "round_trip")
    assert set(got) == set(texts) and all(r[3] for r in got.values())
    assert {i: r[2] for i, r in got.items()} == {i: zlib.crc32((t or "").replace("▁", " ").encode()) for i, t in texts.items()}


def encoder(name):
    import public_tokenizers
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path(name))
    return lambda t: [*(whole.encode(t, add_special_tokens=False).ids if t else []), 2]


def test_op4(spark, texts):
    encode = encoder("byte_bpe_50k.json")
    pieces, fill = defaultdict(list), defaultdict(list)
    for r in QUERIES["op4_best_fit_packing"](spark, DATA).collect():
        pieces[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
        fill[r["sequence_id"]].append((r["offset"], r["length"]))
    at = 0
    for i in sorted(texts):
        ids = encode(texts[i])
        cut = 0
        for n, (piece, start, length, crc) in enumerate(sorted(pieces[i])):
            assert (piece, start, crc) == (n, cut, brute.crc(ids[cut:cut + length])), (i, piece)
            assert length == 1024 or n == 0
            cut += length
        assert cut == len(ids)
        at += len(ids)
    for parts in fill.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 1024
    assert len(fill) <= 1.05 * at / 1024 + 1


def test_op5(spark, texts):
    got = rows(spark, "op5_suffix_array", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_kept", "removed")
    want = brute.repeats(list(texts.items()))
    assert {i: r[:4] for i, r in got.items()} == want
    for i, (n_bytes, n_removed, n_spans, kept, n_kept, removed) in got.items():
        data, at, out = (texts[i] or "").encode(), 0, b""
        spans = [tuple(map(int, s.split(":"))) for s in removed.split(",") if s]
        for a, b in spans:
            out, at = out + data[at:a], b
        assert len(spans) == n_spans and n_kept == n_bytes - n_removed and hashlib.sha256(out + data[at:]).hexdigest() == kept


def test_op6(spark, texts):
    got = rows(spark, "op6_line_dedup", "n_deleted", "n_chars_left", "kept_sha256")
    want = brute.common_lines([(i, t) for i, t in texts.items() if t], lines.aligned, lines.blocks)
    assert {i: r for i, r in got.items() if texts[i]} == {i: (n, len(t), sha(t)) for i, (t, n) in want.items()}


def test_op7(spark, texts):
    got = rows(spark, "op7_quality_rules", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    assert {i: r[:6] for i, r in got.items()} == {i: brute.quality(t) for i, t in texts.items()}
    assert not any(r[5] and r[6] for r in got.values())


def test_op8(spark, texts):
    encode, at = encoder("word_bpe_49k.json"), 0
    got = rows(spark, "op8_bit_packing", "start", "n_tokens", "ids_crc32")
    for i in sorted(texts):
        ids = encode(texts[i])
        assert got[i] == (at, len(ids), brute.crc(ids)), i
        at += len(ids)


def test_op10(spark, texts):
    got = rows(spark, "op10_minhash", "n_shingles", "component_id", "kept")
    assert got == {i: (n, c, c == i) for i, (n, c) in brute.near(list(texts.items())).items()}


def test_each_stage_of_the_pipeline(spark):
    docs = table(spark, DATA, "documents")
    outs = []
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        docs = saved(stage(spark, docs, DATA), "stage")
        outs.append((name, before, docs))
    names = [n for n, _, _ in outs]
    assert names == ["quality rules", "line dedup", "MinHash near-dedup", "secret scan", "best-fit packing"]
    after = [{r["doc_id"]: r["text"] for r in d.collect()} for _, _, d in outs[:-1]]

    before = outs[0][1]
    judged = {r["doc_id"] for r in quality.judged(table(spark, DATA, "documents"), table(spark, DATA, "labels")).where("kept").collect()}
    assert after[0] == {i: before[i] for i in judged} and not any(brute.quality(t)[5] for t in after[0].values())

    want = brute.common_lines([(i, t) for i, t in outs[1][1].items()], lines.aligned, lines.blocks)
    assert after[1] == {i: t for i, (t, n) in want.items() if n == 0 or brute.words(t)}

    near = brute.near(list(outs[2][1].items()))
    assert after[2] == {i: t for i, t in outs[2][1].items() if near[i][1] == i}

    assert set(after[3]) == set(outs[3][1])
    for i, t in outs[3][1].items():
        found = brute.secrets(t)
        assert (sum(found[:3]) == 0) or after[3][i] != t
        assert sum(brute.secrets(after[3][i])[1:3]) == 0

    encode = encoder("byte_bpe_50k.json")
    made = defaultdict(list)
    for r in outs[4][2].select("doc_id", "piece", "length", "ids").collect():
        ids = np.frombuffer(r["ids"], "<u4").tolist() if isinstance(r["ids"], (bytes, bytearray)) else list(r["ids"])
        made[r["doc_id"]].append((r["piece"], ids))
    assert {i: [x for _, ids in sorted(p) for x in ids] for i, p in made.items()} == {i: encode(t) for i, t in after[3].items()}
    assert Counter(n for n, _, _ in outs).most_common(1)[0][1] == 1
