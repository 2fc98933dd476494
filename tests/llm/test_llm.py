"""The llm operators against brute force, on generated edge cases and the small tables."""

import json
import base64
import random
import zlib

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from evstream.llm import bitpack, embeddings, lines, minhash, packing, pieces, quality, secrets, sharding, suffixes, tokens
from evstream.llm.common import components, saved, table
from evstream.llm.queries import ORACLE, QUERIES

DATA = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
rng = random.Random(5)
VOCABULARY = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9))) for _ in range(300)]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(VOCABULARY) + r.choice(["", "", ".", ",\n", "\n"]) for _ in range(n))


BASE = prose(150, 1)
NEAR = " ".join([*BASE.split(" ")[:140], *prose(6, 2).split(" ")])
TEXTS = [
    None, "", " ", "\n", "word", "a b c d", BASE, BASE, BASE, NEAR, BASE + " " + prose(40, 3), prose(200, 4) + BASE,
    "x" * 3000, "ab" * 900 + "q" + "ab" * 900, "é" * 700, "\t\x0b token = abcdef12 \x1f", "tie " * 300, prose(12, 7),
    "é ß ſecret: abcdefgh İpassword=abcdef 'quoted' don't 5.5 ... .,", "日本語 text with 🙂 and ▁ sign", prose(5000, 8),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def clashing(docs):
    """Extra columns named like those the operators give out themselves."""
    names = ["spans", "shard", "n_words", "ids", "removed", "kept", "n_deleted", "component_id", "_row", "START"]
    return docs.withColumns({n: F.lit("mine") for n in names})


def by_id(df, *cols):
    return {r[0]: tuple(r)[1:] for r in df.select("doc_id", *cols).collect()}


def test_components(spark):
    links = [(1, 2), (2, 3), (5, 4), (7, 7), (9, 8), (8, 3), (20, 30), *[(40, k) for k in range(41, 80)]]
    edges = spark.createDataFrame([*links, (None, 1), *links], "a long, b long")
    real = [e for e in links if e[0] != e[1]]
    want = brute.smallest_reachable({x for e in real for x in e}, real)
    assert {r[0]: r[1] for r in components(edges).collect()} == want


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, sql, name):
    import compare

    assert compare.differences(sql, QUERIES[name](spark, DATA), ORACLE[name]) == ""


def test_quality_counts(spark, docs, nothing):
    got = by_id(quality.statistics(clashing(docs)).withColumn("f", quality.base_failed()), *quality.BASE, "f")
    assert got == {i: brute.quality(t) for i, t in enumerate(TEXTS)}
    assert quality.statistics(nothing).count() == 0


def test_rules_are_learned_and_clean_documents_stay(spark):
    larger = DATA.replace("sf0.001", "sf0.01")
    d, labels = table(spark, larger, "documents"), table(spark, larger, "labels")
    out = quality.judged(d, labels).join(labels, "doc_id").where("quality is not null and not base_failed")
    wrong = out.where(F.col("kept") != (F.col("quality") == 1)).count()
    assert wrong <= 0.02 * out.count()
    kept = quality.keep_good(clashing(d), labels)
    assert kept.columns == clashing(d).columns
    assert {r[0] for r in kept.select("doc_id").collect()} == {
        r[0] for r in quality.judged(d, labels).where("kept").select("doc_id").collect()}


@pytest.mark.parametrize("limit", [1, 50, 10_000])
def test_rules_are_fitted_on_the_smallest_hashes(spark, monkeypatch, limit):
    d, labels = table(spark, DATA, "documents"), table(spark, DATA, "labels")
    seen = []
    monkeypatch.setattr(quality, "learn", lambda x, bad, held: seen.append(x.tolist()) or [])
    stats = saved(quality.features(quality.statistics(d.select("doc_id", "text"))), "stats")
    quality.fit(stats, labels, limit)
    known = stats.where(~quality.base_failed()).join(labels.where("quality is not null").dropDuplicates(["doc_id"]), "doc_id")
    want = known.orderBy(F.xxhash64("doc_id", F.lit(7))).select(*quality.FEATURES).collect()
    assert seen == [[[float(v) for v in r] for r in want[:limit]]]


def test_rules_without_labels(spark, docs):
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = quality.judged(docs, empty)
    assert out.where("kept = base_failed").count() == 0
    x = np.array([[1.0] * len(quality.FEATURES)] * 9)
    assert quality.learn(x, np.arange(9) < 4, np.arange(9) % 3 == 0) == []  # ties: nothing to part them


def test_secrets(spark, docs, nothing):
    token = "ghp_" + "a1B2" * 7 + "zz"
    good = token + secrets.checksum62(token[4:])
    coded = [base64.urlsafe_b64encode(json.dumps(x).encode()).decode().rstrip("=") for x in ({"alg": "none"}, {"sub": "1"})]
    jwt = ".".join([*coded, "s" * 20])
    scan = secrets.scanner()
    assert [(s, secrets.KINDS[k], e) for s, k, e in scan(f"é {good} {token}zzzzzz {jwt}")] == [
        (2, "github", 42), (84, "jwt", 84 + len(jwt))]
    rows = secrets.find_secrets(clashing(docs)).collect()
    for r in rows:
        said = ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in r["spans"] if s["kind"] in secrets.BASE_KINDS)
        import hashlib

        assert hashlib.sha256(said.encode()).hexdigest() == brute.secrets(r["text"])[3]
    assert secrets.find_secrets(nothing).count() == 0
    masked = by_id(secrets.mask_secrets(docs), "text", "n_chars")
    assert masked[15] == ("\t\x0b [SECRET] \x1f", len("\t\x0b [SECRET] \x1f")) and masked[0] == (None, None)
    assert secrets.masked("abcdef", [(0, 0, 3), (2, 1, 4)], "*") == "*ef"


def test_shards(spark, docs, nothing):
    rows = sharding.shard_documents(clashing(docs).union(clashing(docs))).collect()
    for s in {r["shard"] for r in rows}:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sum(r["shard"] == s for r in rows)))
    for r in rows:
        t = (TEXTS[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(t) + 1, zlib.crc32(t))
        assert r["grown_shard"] in (r["shard"], 8)
    assert sharding.shard_documents(nothing).count() == 0
    many = sharding.place(sharding.place(spark.range(4000).withColumnRenamed("id", "doc_id"), "doc_id", sharding.tree(8)),
                          "doc_id", sharding.grown(sharding.tree(8)), "grown")
    counts = [r["count"] for r in many.groupBy("shard").count().collect()]
    assert len(counts) == 8 and min(counts) > 400
    assert many.where("grown <> shard and grown <> 8").count() == 0
    heavy = [*sharding.tree(8)[:7], sharding.Leaf(1, 3, 7, 3.0)]
    moved = sharding.place(many.drop("grown"), "doc_id", heavy, "after").where("after <> shard")
    assert moved.where("after < 4").count() == 0  # into the region whose weight grew, or within it


def test_slots_of_one_id_are_numbered_by_many_tasks(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(sharding, "saved", lambda df, name: seen.append(saved(df, name)) or seen[-1])
    rows = spark.range(40_000, numPartitions=8).select(F.when(F.col("id") % 2 == 0, 7).alias("doc_id"), F.lit("t").alias("text"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    out = sharding.shard_documents(rows).groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.min("slot").alias("a"), F.max("slot").alias("b"),
                                                               F.countDistinct("slot").alias("d")).collect()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert all((r["a"], r["b"], r["d"]) == (0, r["n"] - 1, r["n"]) for r in out) and sum(r["n"] for r in out) == 40_000
    assert seen[0].where("doc_id = 7").select("_range").distinct().count() > 1


def test_encoders(spark):
    import public_tokenizers as p
    from tokenizers import Tokenizer

    more = [*[t for t in TEXTS if t], "a<|endoftext|>b <|endoftext|>", " a  b\n\nc\td ", "Foo. BAR, baz.,qux ...x", "Σας ΟΣ"]
    for name, make in (("byte_bpe_50k.json", lambda: packing.byte_encoder()()),
                       ("word_bpe_49k.json", lambda: tokens.lower_case(p.path("word_bpe_49k.json")))):
        encode, whole = make().encode, Tokenizer.from_file(p.path(name))
        for t in more:
            assert encode(t) == tokens.packed(whole.encode(t, add_special_tokens=False).ids), (name, t[:60])
        assert encode(None) == encode("") == b""


def test_lower_case_encoder_of_many_texts():
    import public_tokenizers as p
    import pyarrow as pa
    from tokenizers import Tokenizer

    file = p.path("word_bpe_49k.json")
    whole, encoder = Tokenizer.from_file(file), tokens.LowerCase(file)
    # A special token's name counts as it is written, not once it is lowered.
    odd = ["<|ENDOFTEXT|>", "a <|EndOfText|>. b", "x<|endoftext|>.", "foo!. bar", "²,x ½. ª.b º,c ×.x ÷,y", "É.é ÀÞ,C", "it's. 's.'T a.'s",
           "1.5,6 x..y ,, . ,", "a\x85.b \x1d,", "Å.Å Ω,ς. ΟΣ.", "les&&& (415)!'s", ",", " ", "\n.\n"]
    r = random.Random(5)
    odd += ["".join(r.choice("abZs't.,!(09 \n\té×ÿ\xa0²ªΣ<|") for _ in range(r.randint(0, 50))) for _ in range(500)]
    for texts in ([*odd, None, ""], [None], [""], [], odd[5:7]):
        want = [tokens.packed(whole.encode(t or "", add_special_tokens=False).ids) for t in texts]
        for kind in (pa.string(), pa.large_string()):
            assert encoder.encode_all(pa.array(texts, kind)) == want
            assert encoder.encode_all(pa.array(texts, kind)[2:]) == want[2:]
    seen = []
    encoder.words = type("Counted", (tokens.Words,), {"__getitem__": lambda self, w: seen.append(w) or tokens.Words.__getitem__(self, w)})(encoder.word)
    encoder.encode_all(pa.array(["one two, two.\nOne", "two one"] * 50))
    assert sorted(seen) == sorted({",", ".", "one", "two"})


def test_packing_of_whole_machine_words():
    ids = np.array([0, 1, 255, 200, 3], "<u4")
    for bits in bitpack.WHOLE:
        data = bitpack.pack(ids, bits)
        assert data == b"".join(int(i).to_bytes(bits // 8, "big") for i in ids)
        assert bitpack.unpack(data, bits, 1, 4).tolist() == [1, 255, 200] and bitpack.unpack(data, bits, 2, 2).tolist() == []


def test_bit_packing(spark, docs, nothing, tmp_path):
    ids = np.array([0, 1, 5, 1023, 700, 3], "<u4")
    for bits in (10, 13, 32):
        data = bitpack.pack(ids, bits)
        assert len(data) == -(-6 * bits // 8) and bitpack.unpack(data, bits, 2, 5).tolist() == [5, 1023, 700]
    with pytest.raises(ValueError):
        bitpack.pack(ids, 9)
    import public_tokenizers as p

    file = p.path("word_bpe_49k.json")
    encoder = lambda: tokens.lower_case(file)
    by_value = encoder
    bitpack.write_ids(clashing(docs), str(tmp_path / "x"), by_value, 49_408)
    at = 0
    for i, (start, n, data) in sorted(by_id(bitpack.read_ids(spark, str(tmp_path / "x")), "start", "n_tokens", "ids").items()):
        assert start == at and bytes(data) == encoder().encode(TEXTS[i]) + tokens.packed([2])
        at += n
    bitpack.write_ids(nothing, str(tmp_path / "y"), by_value, 49_408)
    assert bitpack.read_ids(spark, str(tmp_path / "y")).count() == 0


def test_packing(spark, docs, nothing):
    out = packing.packed_documents(clashing(docs), packing.byte_encoder()).collect()
    fill = {}
    for r in sorted(out, key=lambda r: r["offset"]):
        assert r["offset"] == fill.get(r["sequence_id"], 0)
        fill[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(fill.values()) <= 1024 and len({r["doc_id"] for r in out}) == len(TEXTS)
    assert packing.packed_documents(nothing, packing.byte_encoder()).count() == 0
    lengths = np.array([random.Random(3).randint(1, 700) for _ in range(1)] + [rng.randint(1, 700) for _ in range(4000)])
    bins = packing.sum_of_squares(lengths)
    assert sorted(i for b in bins for i in b) == list(range(4001)) and max(lengths[b].sum() for b in bins) <= 1024
    assert len(bins) <= 1.01 * lengths.sum() / 1024 + 1


def test_pieces(spark, docs):
    import public_tokenizers as p

    model = pieces.Pieces(p.path("piece_bpe_32k.model"))
    for t in TEXTS:
        if t:
            whole = model.viterbi(pieces.SPACE + t.replace(" ", pieces.SPACE))
            assert model.encode(t) == tokens.packed(whole)
            assert model.decode(model.encode(t)) == t.replace(pieces.SPACE, " ")
    rows = pieces.decoded(pieces.encoded(clashing(docs), p.path("piece_bpe_32k.model")), p.path("piece_bpe_32k.model"))
    assert rows.where("text is not null and decoded <> translate(text, '▁', ' ')").count() == 0
    # Against all segmentations of short strings.
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=p.path("piece_bpe_32k.model"))
    score = {sp.id_to_piece(i): sp.get_score(i) for i in range(259, 32000)}

    def best(s):
        return max([score[s[:k]] + best(s[k:]) for k in range(1, len(s) + 1) if s[:k] in score], default=-9e9) if s else 0

    for w in ("▁token", "▁aabab", "▁hello", "▁▁▁x"):
        assert sum(sp.get_score(i) for i in model.viterbi(w)) == best(w)


def test_suffix_arrays():
    r = random.Random(1)
    for _ in range(1500):
        s = [r.randint(1, r.choice((1, 2, 4))) for _ in range(r.randint(0, 30))]
        s = [*(s[:max(1, len(s) // 3)] * 3 if r.random() < 0.3 else s), 0]
        assert suffixes.suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])


@pytest.mark.parametrize("chunk", [suffixes.CHUNK, 3, 1])
def test_suffix_dedup(spark, docs, nothing, chunk, monkeypatch):
    monkeypatch.setattr(suffixes, "CHUNK", chunk)  # few: crowded anchors are cut by their bytes
    out = suffixes.remove_repeats(clashing(docs))
    want = brute.repeats(list(enumerate(TEXTS)))
    for r in out.collect():
        import hashlib

        n = sum(x["end"] - x["start"] for x in r["removed"])
        assert (n, len(r["removed"]), hashlib.sha256(bytes(r["kept"])).hexdigest()) == want[r["doc_id"]][1:], r["doc_id"]
    assert suffixes.remove_repeats(nothing).count() == 0


@pytest.mark.parametrize("chunk", [suffixes.CHUNK, 5])
def test_suffix_dedup_of_crowded_anchors(spark, chunk, monkeypatch):
    """Parts of one passage in ever other surroundings: anchors with dozens of different stretches,
    of which some share windows and some miss them by a byte."""
    monkeypatch.setattr(suffixes, "CHUNK", chunk)
    r, passage = random.Random(3), prose(160, 77)
    texts = []
    for k in range(70):
        lo = r.randint(0, 250)
        part = passage[lo:lo + r.choice((399, 400, 401, 430, 520, 700))]
        texts.append(prose(r.randint(0, 30), 1000 + k) + part + prose(r.randint(0, 30), 2000 + k))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = brute.repeats(list(enumerate(texts)))
    got = {r["doc_id"]: (sum(x["end"] - x["start"] for x in r["removed"]), len(r["removed"])) for r in suffixes.remove_repeats(df).collect()}
    assert got == {d: w[1:3] for d, w in want.items()}
    assert sum(n > 0 for n, _ in got.values()) > 40


def test_suffix_dedup_of_repeated_ids(spark):
    texts = [None, "short", prose(200, 4) + BASE, BASE + prose(200, 9), BASE + prose(200, 9), prose(300, 10)]
    df = spark.createDataFrame([(7, t) for t in texts] + [(None, BASE)], "doc_id long, text string")
    want = brute.repeats(list(enumerate([*texts, BASE])))
    got = sorted((len((r["text"] or "").encode()), sum(x["end"] - x["start"] for x in r["removed"]), len(r["removed"]))
                 for r in suffixes.remove_repeats(df).collect())
    assert got == sorted(w[:3] for w in want.values())


def test_near_duplicates(spark, docs, nothing):
    family = [(100 + i, " ".join(w for k, w in enumerate(BASE.split(" ")) if (k * 7 + i) % (9 + i % 9))) for i in range(60)]
    more = docs.select("doc_id", "text").union(spark.createDataFrame(family, "doc_id long, text string"))
    more = more.union(spark.createDataFrame([(None, BASE)], "doc_id long, text string"))
    want = brute.near([*enumerate(TEXTS), *family])
    got = by_id(minhash.near_duplicates(clashing(more)), "n_shingles", "component_id", "kept")
    assert got.pop(None) == (want[6][0], None, True)
    assert got == {d: (n, c, c == d) for d, (n, c) in want.items()}
    assert minhash.near_duplicates(nothing).count() == 0
    kept = minhash.keep_one(clashing(docs))
    assert kept.columns == clashing(docs).columns and {7, 8}.isdisjoint({r["doc_id"] for r in kept.collect()})


def test_repeated_ids_with_different_texts(spark):
    other = prose(150, 21)
    rows = [(7, BASE), (7, other), (7, None), (7, BASE), (9, NEAR), (3, other), (11, prose(150, 22))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["n_shingles"] and r["component_id"]) for r in minhash.near_duplicates(df).collect()}
    assert got == {(7, 7), (7, 3), (7, 0), (9, 7), (3, 3), (11, 11)}
    kept = sorted((r["doc_id"], r["text"] or "") for r in minhash.keep_one(df).collect())
    assert kept == sorted([(7, BASE), (7, BASE), (7, ""), (3, other), (11, rows[-1][1])])
    passage = "one two three four five six\nseven eight nine ten"
    rows = [(1, passage), (2, f"a b\n{passage}"), (2, f"x y z\nmore of it\nand the end {'w ' * 9}")]
    left = {r["text"] for r in lines.without_common_blocks(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert passage in left and rows[2][1] in left and left <= {passage, "a b", rows[1][1], rows[2][1]}


def test_families_in_blocks(spark, monkeypatch):
    for name, value in (("BLOCK_DOCS", 5), ("BUCKET", 4)):
        monkeypatch.setattr(minhash, name, value)
    family = [(i, " ".join(w for k, w in enumerate(BASE.split(" ")) if (k * 7 + i) % (12 + i % 30))) for i in range(50)]
    got = by_id(minhash.near_duplicates(spark.createDataFrame(family, "doc_id long, text string")), "component_id")
    assert {d: c for d, (c,) in got.items()} == {d: c for d, (_, c) in brute.near(family).items()}


@pytest.mark.parametrize("bucket", [minhash.BUCKET, 2])
def test_rows_like_a_leader_meet_rows_unlike_it(spark, bucket, monkeypatch):
    monkeypatch.setattr(minhash, "BUCKET", bucket)
    # 2 is like the leader 1, 3 is near 2 and not like 1; they share the first band alone.
    v = np.arange(128, dtype="<u2")
    coarse = [v.copy() for _ in range(3)]
    coarse[1][:60] += 200
    coarse[2][:60] += 200
    coarse[2][96:] += 300
    coarse[2][60:66] += 400
    bands = [np.r_[v[:4], v[4:] + 1000 * i].astype("<u2").tobytes() for i in range(3)]
    rows = [(i + 1, bytearray(bands[i]), bytearray((c & 0xFF).astype(np.uint8).tobytes())) for i, c in enumerate(coarse)]
    assert (coarse[1] == coarse[0]).sum() >= 64 > (coarse[2] == coarse[0]).sum() and (coarse[2] == coarse[1]).sum() >= 74
    got = {tuple(r) for r in minhash._families(spark.createDataFrame(rows, "rep long, bands binary, coarse binary")).collect()}
    assert got == {(1, 1), (2, 1), (3, 1)}


def test_sketches_fill_and_estimate():
    sets = [np.arange(n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) for n in (0, 1, 3, 400)]
    sets.append(np.arange(100, 500, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    s = minhash.sketches(sets)
    assert not s[0].any() and abs((s[3] == s[4]).mean() - 0.6) < 0.15


def test_embeddings(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "CELL", 20)
    r = np.random.default_rng(3)
    rows = [(i, v.tolist()) for i, v in enumerate(r.normal(size=(60, 8)))]
    center = r.normal(size=8)
    rows += [(100 + i, (center + 0.12 * r.normal(size=8)).tolist()) for i in range(80)]
    rows += [(200 + i, rows[3][1]) for i in range(30)] + [(300, [2 * x for x in rows[3][1]])]
    rows += [(400, None), (401, [0.0] * 8), (402, [None] + [1.0] * 7), (403, [float("nan")] * 8), (404, []), (405, [1.0, 2.0]),
             (406, [2.0, 4.0]), (407, [float("inf")] * 8)]
    df = spark.createDataFrame([*rows, (None, rows[3][1])], "vec_id long, embedding array<double>").withColumn("raw", F.lit(1))
    got = {x["vec_id"]: (x["n_links"], x["component_id"]) for x in embeddings.near_vectors(df).collect()}
    assert got.pop(None) == (0, None)
    assert got == brute.vectors(rows)
    assert embeddings.near_vectors(df.limit(0)).count() == 0


def test_embeddings_of_ids_in_steps(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "CELL", 10)
    rows = [(40 * i, v.tolist()) for i, v in enumerate(1 + 0.05 * np.random.default_rng(4).normal(size=(200, 6)))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert {x["vec_id"]: (x["n_links"], x["component_id"]) for x in embeddings.near_vectors(df).collect()} == brute.vectors(rows)


def test_embeddings_of_repeated_ids(spark):
    a, b, c = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.999, 0.01, 0.0]
    rows = [(7, a), (7, b), (8, c), (9, a), (9, [0.01, 0.999, 0.0]), (7, a), (3, [0.0, 0.0, 1.0])]
    got = embeddings.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    want = brute.vectors([(str(k), v) for k, (_, v) in enumerate(rows)])
    classes = {}
    for k, (i, _) in enumerate(rows):
        classes.setdefault(want[str(k)][1], []).append(i)
    expected = [(i, want[str(k)][0], min(classes[want[str(k)][1]])) for k, (i, _) in enumerate(rows)]
    assert sorted((x["vec_id"], x["n_links"], x["component_id"]) for x in got) == sorted(expected)


def test_alignment():
    assert lines.aligned(list("abcxdef"), list("abcydef")) == [(0, 0), (1, 1), (2, 2), (4, 4), (5, 5), (6, 6)]
    assert lines.aligned([1, 2, 1, 2, 9], [7, 1, 2, 1]) == [(0, 1), (1, 2), (2, 3)]
    assert lines.aligned([], [1]) == [] and lines.aligned([1, 1], [1, 1]) == [(0, 0), (1, 1)]
    assert lines.blocks([(0, 3), (1, 4), (4, 5)], [0] * 3 + [2, 3, 4], 5) == [(3, 5)]


def test_line_dedup(spark, nothing):
    passage = "one two three four five six\nseven eight nine ten"
    rows = [(1, f"start of it all\n{passage}\nend"), (2, f"other words here\n{passage}"), (3, passage), (4, None), (5, ""),
            (6, "one two three four five six\nits own line"), (7, "ok\nend"), (None, passage), (8, f"{passage}\n{passage}")]
    df = clashing(spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_chars", F.length("text").cast("long")))
    got = by_id(lines.without_common_blocks(df), "text", "n_deleted")
    assert got[1] == (rows[0][1], 0) and got[2] == ("other words here", 2) and got[3] == ("", 2)
    assert got[4] == (None, 0) and got[5] == ("", 0) and got[6] == ("its own line", 1) and got[7] == ("ok\nend", 0)
    assert got[None] == (passage, 0)
    left = {r["doc_id"]: r["n_chars"] for r in lines.line_deduped(df).collect()}
    assert 3 not in left and left[2] == len("other words here") and left[5] == 0
    assert lines.line_deduped(nothing).count() == 0


def test_line_dedup_of_lines_repeated_in_a_document(spark):
    passage, verse = "one two three four five six\nseven eight nine ten", "a line of the refrain again\n" * 3 + "and again"
    verse += "\nand again"
    rows = [(1, passage), (2, f"{passage}\n{passage}"), (3, verse), (4, verse), (5, "la la la\nla la la"), (6, "la la la\nla la la")]
    got = by_id(lines.without_common_blocks(spark.createDataFrame(rows, "doc_id long, text string")), "text", "n_deleted")
    assert got == {1: (passage, 0), 2: (passage, 2), 3: (verse, 0), 4: ("", 5), 5: (rows[4][1], 0), 6: ("", 2)}


def test_line_dedup_meets_later_holders(spark):
    one, two = "first passage of six words here\nits second line", "then another passage of words follows\nand its end"
    rows = [(1, f"{one}\n{two}"), (2, f"head of it\n{two}\n{one}"), (3, f"{two}\n{one}\ntail of it"),
            (11, "a b\nx\nc d\ny\ne f"), (12, "a b\nc d\ne f"), (13, "z\na b\nc d\ne f"),
            (21, f"u\nother one two three four five\nv"), (22, "other one two three four five"), (23, "other one two three four five\n" * 2 + "w"),
            (24, "t\n" + "other one two three four five\n" * 3 + "s")]
    got = by_id(lines.without_common_blocks(spark.createDataFrame(rows, "doc_id long, text string")), "text", "n_deleted")
    assert got[1][1] == 0 and got[2][1] == 2 and got[3] == ("tail of it", 4)
    assert got[11][1] == got[12][1] == 0 and got[13] == ("z", 3)
    # Against the ends of 21 and 22 the first occurrence goes; the third of 24 has no partner.
    assert got[22] == ("", 1) and got[23][1] == 1 and got[24][1] == 2


def test_line_dedup_against_all_earlier_documents(spark):
    r = random.Random(11)
    short = ["a b", "c", "", "d e f", "g", "h i"]
    parts = [*short, "one two three four five six", "\n".join(short[:4]), "seven eight nine ten eleven\nc\nlast of it"]
    rows = [(i, "\n".join(r.choice(parts) for _ in range(r.randint(1, 7)))) for i in range(150)]
    got = by_id(lines.without_common_blocks(spark.createDataFrame(rows, "doc_id long, text string")), "text", "n_deleted")
    assert got == brute.common_lines(rows, lines.aligned, lines.blocks)


def test_pipeline(spark):
    d = table(spark, DATA, "documents")
    whole = d.count()
    names = d.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        d = stage(spark, d, DATA).persist()
        assert d.columns == names and 0 < d.count() <= whole
    out = corpus_pipeline.run(spark, DATA)
    assert {r[0] for r in out.select("doc_id").distinct().collect()} == {r[0] for r in d.select("doc_id").collect()}
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None


def test_two_sets_under_one_id_in_one_family(spark):
    words = BASE.split(" ")
    a, b = words, [w if k % 9 else "other" for k, w in enumerate(words)]  # alike, not near
    near = lambda w, k: " ".join([*w[:-k], *["tail"] * k])
    rows = [(7, " ".join(a)), (7, " ".join(b)), (9, near(a, 4)), (10, near(b, 4)), (5, prose(90, 31))]
    want = brute.near([(str(k), t) for k, (_, t) in enumerate(rows)])
    classes = {}
    for k, (i, _) in enumerate(rows):
        classes.setdefault(want[str(k)][1], []).append(i)
    expected = sorted((i, min(c)) for c in classes.values() for i in c)
    assert expected == [(5, 5), (7, 7), (7, 7), (9, 7), (10, 7)]
    df = spark.createDataFrame([*rows, *rows[:2] * 20], "doc_id long, text string")
    got = minhash.near_duplicates(df)
    assert sorted({(r["doc_id"], r["component_id"]) for r in got.collect()}) == sorted(set(expected)) and got.count() == 45


def test_ties_grow_with_rows_not_with_their_square():
    import pyarrow as pa

    r = np.random.default_rng(5)
    base = r.integers(0, 255, 128).astype(np.uint8)
    made = []
    for n in (200, 800):
        rows = []
        for i in range(n):
            v = base.copy()
            v[r.choice(128, 45, replace=False)] = r.integers(0, 255, 45)
            rows.append((1, i, v.tobytes()))
        batch = pa.RecordBatch.from_arrays([pa.array([x[k] for x in rows], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.binary()))], names=["key", "rep", "coarse"])
        out = [t for b in minhash._leaders([batch]) for t in zip(*[c.to_pylist() for c in b.columns])]
        links = [(a, b) for a, b, *_ in out if a != b]
        made.append(len(links))
        sketches = [np.frombuffer(x[2], np.uint8) for x in rows]
        real = [(i, j) for i in range(n) for j in range(i) if (sketches[i] == sketches[j]).sum() >= minhash.LINK]
        want, got = brute.smallest_reachable(range(n), real), brute.smallest_reachable(range(n), links)
        assert all(got[i] == got[j] for i, j in real) and len(set(want.values())) >= len(set(got.values()))
    assert made[0] <= 400 and made[1] <= 1600
