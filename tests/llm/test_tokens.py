"""Tokens, pieces, packing, wavelet shards, embeddings, URLs and chats against plain versions."""

import hashlib
import random
import struct
import time
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given as cases, settings, strategies as st
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from finfacts.llm import (
    chat_format as C, embedding_dedup as E, packing as P, sentence_pieces as SP, token_store as T,
    tokens as K, url_filter as U,
)
from finfacts.llm.wavelet import CHUNK, ShardFile, WaveletMatrix, read_file, write_file
from tests.llm.conftest import TEXTS, rows

SF = "/root/testdata/sf0.001"
WORDS, BYTES = (public_tokenizers.path(f"{n}.json") for n in ("word_bpe_49k", "byte_bpe_50k"))
PIECES = public_tokenizers.path("piece_bpe_32k.model")
HARD = [
    "a  b", "a   b", "a \n b", "\n\na", " lead", " trail ", "foo's don't it'S", "x\u00a0\u00a0y", "e\u0301 \u0301x",
    "İstanbul ΑΣ Σ", "12 3456 a1b2", "tab\there\r\nnew", "\x1c a", "naïve Élan", "'s 's'sfoo", "a\x85 b", "ß ẞ",
    "foo.\nBar", "a\n b \nc", "#### $$ ||", "\n\n\nb", "a\n\n", "K ſ a'b", "\u2003 x \u2003", "$12.50", "a_b --c",
]


def many(encoder, given):
    out = []
    for ids, ends in encoder.encode_many(pa.array(given, pa.string())):
        out += [ids[i:j].tolist() for i, j in zip([0, *ends[:-1]], ends)]
    return out


@pytest.mark.parametrize("path, words", [(WORDS, True), (BYTES, False)])
def test_ids_equal_the_library(path, words):
    rng, parts = random.Random(4), ["a", "B", "é", " ", "\n", "  ", "'s", "1", "!", "\u2003", "\u0301", "日", "\t"]
    given = [*TEXTS, *HARD, *("".join(rng.choices(parts, k=rng.randint(1, 20))) for _ in range(2000))]
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    own = K.Encoder(path, words)
    expected = [library.encode(t or "", add_special_tokens=False).ids for t in given]
    assert many(own, given) == expected
    assert [list(struct.unpack(f"<{len(x) // 4}I", x)) for x in (own.encode((t or "").encode()) for t in given)] == expected


def unigram():
    """The library over the same file, told that its scores are those of a unigram model."""
    raw = open(PIECES, "rb").read()

    def number(at):
        value = shift = 0
        while True:
            value, shift, at = value | (raw[at] & 127) << shift, shift + 7, at + 1
            if raw[at - 1] < 128:
                return value, at

    at = 0
    while True:
        tag, start = number(at)
        size, start = number(start)
        if tag >> 3 == 2:
            break
        at = start + size
    kind = raw.index(b"\x18\x02", start, start + size)
    model = SentencePieceProcessor()
    model.LoadFromSerializedProto(raw[:kind] + b"\x18\x01" + raw[kind + 2:])
    return model


@pytest.fixture(scope="module")
def pieces():
    return SP.PieceModel(PIECES)


def test_pieces_are_the_best(pieces):
    library = unigram()
    words = sorted({w for t, in duckdb.sql(f"SELECT text FROM '{SF}/documents.parquet'").fetchall() for w in t.split()})[:1500]
    got = many(SP.PieceEncoder(pieces), words)
    assert got == [library.nbest_encode(w, nbest_size=2)[0] for w in words]


def test_pieces_round_trip(pieces):
    given = [t or "" for t in TEXTS] + HARD
    own = SP.PieceEncoder(pieces)
    got = many(own, given)
    assert [pieces.decode(x) for x in got] == given
    assert [SentencePieceProcessor(model_file=PIECES).decode(x) for x in got[:8]] == given[:8]
    marked = "a\u2581b"
    assert pieces.decode(many(own, [marked])[0]) == "a b"
    word = b" hello" + "é日".encode() * 9
    assert pieces._alone(word) == pieces.best_paths([word])[0]


def test_pieces_of_frames(docs, empty):
    both = SP.decode_pieces(SP.encode_pieces(docs, PIECES), PIECES)
    assert sorted(((r.doc_id, r.decoded) for r in both.collect()), key=repr) == sorted(((i, t or "") for i, t in rows()), key=repr)
    assert SP.encode_pieces(empty, PIECES).count() == 0
    assert all(r.round_trip for r in SP.op3_sentence_pieces(docs.sparkSession, SF).collect())


def library_ids(path, end):
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    return lambda t: library.encode(t or "", add_special_tokens=False).ids + [end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_packing(docs, empty):
    ids = library_ids(WORDS, 1)
    got = P.pack_documents(docs, WORDS).collect()
    expected = Counter()
    for i, t in rows():
        own = ids(t)
        expected.update((i, n, s, len(own[s:s + 4096]), crc(own[s:s + 4096])) for n, s in enumerate(range(0, len(own), 4096)))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == expected
    check_bins(got)
    assert P.pack_documents(empty, WORDS).count() == 0
    with pytest.raises(ValueError):
        P.pack(docs.selectExpr("5000L AS length"))


def test_packing_takes_any_columns(spark):
    given = [(n, str(i), i, -i, {"k": i}, n * 2) for i in range(60) for n in (5, 3000, 1000)]
    frame = spark.createDataFrame(
        given, "length int, rank string, within long, base int, row map<string,int>, sequence_id int")
    got = P.pack(frame)
    assert got.columns == ["length", "rank", "within", "base", "row", "sequence_id", "offset"]
    rows_ = got.collect()
    assert Counter((r.length, r["rank"], r.within, r.base, r.row["k"]) for r in rows_) == Counter(
        (g[0], g[1], g[2], g[3], g[4]["k"]) for g in given)
    assert check_bins(rows_) == 60
    alone = P.pack(frame.select("length").repartition(7)).collect()
    assert len(alone) == len(given) and check_bins(alone) == check_bins(rows_)
    assert P.pack(frame.limit(0)).count() == 0
    with pytest.raises(ValueError):
        P.pack(spark.createDataFrame([(None,)], "length int"))


def check_bins(got):
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for content in bins.values():
        end = 0
        for offset, length in sorted(content):
            assert offset == end
            end += length
        assert end <= 4096
    return len(bins)


def test_query6_needs_the_fewest_sequences(spark):
    got = P.op6_best_fit_packing(spark, SF).collect()
    assert check_bins(got) == -(-sum(r.length for r in got) // 4096)


@settings(max_examples=60, deadline=None)
@cases(st.dictionaries(st.integers(1, 40), st.integers(1, 9), max_size=8))
def test_bins_use_all_lengths(histogram):
    bins = P.pack_lengths(histogram, 40)
    used = Counter()
    for uses, content in bins:
        assert sum(k * n for k, n in content.items()) <= 40
        used.update({k: uses * n for k, n in content.items()})
    assert used == Counter(histogram)
    places = P.Places(bins)
    seen = set()
    for length, number in histogram.items():
        sequence, offset = places.find(np.full(number, length), np.arange(number))
        for s, o in zip(sequence.tolist(), offset.tolist()):
            cells = {(s, o + i) for i in range(length)}
            assert not cells & seen
            seen |= cells


@settings(max_examples=60, deadline=None)
@cases(st.dictionaries(st.integers(1, 20), st.integers(1, 4), max_size=6), st.integers(0, 40))
def test_fill_is_the_fullest(counts, room):
    sums = {0}
    for length, number in counts.items():
        sums = {s + length * k for s in sums for k in range(number + 1) if s + length * k <= room}
    chosen = P.best_fill(counts, room)
    assert sum(k * n for k, n in chosen.items()) == max(sums)
    assert all(n <= counts[k] for k, n in chosen.items())


def test_wavelet():
    rng = np.random.default_rng(0)
    for n in (0, 1, 511, 512, 513, 5000):
        ids = rng.integers(0, 300, n).astype(np.uint32)
        matrix, names, lengths = read_file(write_file(ids, [None, 7], [n, 0], 9))
        assert names == [None, 7] and lengths == [n, 0] and (matrix.all() == ids).all()
        assert all(matrix.access(i) == ids[i] for i in range(0, n, 97))
        for token in (0, 5, 299, 511, 600):
            assert matrix.occurrences(token) == np.flatnonzero(ids == token).tolist()
            assert matrix.count(token, n // 3, n // 2) == (ids[n // 3:n // 2] == token).sum()
    with pytest.raises(ValueError):
        read_file(write_file(np.array([1, 2]), [1], [2], 2) + b"x")


def test_questions_unpack_a_part_of_the_shard():
    ids = np.random.default_rng(1).integers(0, 50_000, 3 * CHUNK + 700).astype(np.uint32)
    data = write_file(ids, [1], [len(ids)], 16)
    for i in (0, CHUNK - 1, CHUNK, len(ids) - 1):
        shard = ShardFile(data)
        assert shard.matrix.access(i) == ids[i] and shard.unpacked < len(data) * 0.4
    shard, token = ShardFile(data), int(ids[CHUNK])
    assert shard.matrix.count(token, 5, CHUNK + 9) == (ids[5:CHUNK + 9] == token).sum()
    assert shard.unpacked < len(data) * 0.7
    hot = np.where(np.arange(len(ids)) % 3 == 0, 7, ids).astype(np.uint32)
    matrix = ShardFile(write_file(hot, [1], [len(ids)], 16)).matrix
    assert matrix.occurrences(7) == np.flatnonzero(hot == 7).tolist()
    assert matrix.select(7, CHUNK) == np.flatnonzero(hot == 7)[CHUNK]
    with pytest.raises(IndexError):
        matrix.select(7, int((hot == 7).sum()))


def test_store(spark, docs, empty, monkeypatch):
    ids = library_ids(BYTES, 2)
    shards = T.write_shards(docs, BYTES)
    got = T.read_documents(shards).orderBy("start").collect()
    assert Counter((r.doc_id, crc(np.frombuffer(r.ids, "<u4"))) for r in got) == Counter((i, crc(ids(t))) for i, t in rows())
    order = [r.doc_id for r in got]
    assert order == sorted(order, key=lambda x: (x is not None, x or 0))
    starts = np.cumsum([0] + [r.n_tokens for r in got])
    assert [r.start for r in got] == starts[:-1].tolist()
    found = T.find_token(shards, 262).collect()
    expected = Counter((i, n) for i, t in rows() for n, x in enumerate(ids(t)) if x == 262)
    assert Counter((r.doc_id, r.place) for r in found) == expected
    assert T.read_documents(T.write_shards(empty, BYTES)).count() == 0


def test_query7_against_plain(spark):
    ids, at, expected = library_ids(BYTES, 2), 0, {}
    for i, t in duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY 1").fetchall():
        own = ids(t)
        expected[i] = (at, len(own), crc(own))
        at += len(own)
    got = T.op7_token_store(spark, SF).collect()
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in got} == expected


def plain_links(given, least):
    good = [(i, np.array(v, float), label) for i, v, label in given if v is not None and label is not None and len(v)
            and None not in v and np.isfinite(np.array(v, float)).all() and np.any(v)]
    parent = {}
    links = Counter()
    for a, (i, v, l) in enumerate(good):
        parent[a] = a
    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, (_, v, l) in enumerate(good):
        for b in range(a):
            _, w, m = good[b]
            if l == m and len(v) == len(w) and v @ w / np.sqrt((v @ v) * (w @ w)) >= least:
                links[a] += 1
                links[b] += 1
                parent[max(find(a), find(b))] = min(find(a), find(b))
    groups = {}
    for a, (i, _, _) in enumerate(good):
        groups.setdefault(find(a), []).append(i)
    bad = [(i, 0, i) for i, v, label in given if not any(i == g[0] for g in good)]
    return sorted([(i, links[a], min(groups[find(a)])) for a, (i, _, _) in enumerate(good)] + bad)


def test_embeddings(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((30, 16))
    vectors = [base[i % 30] * (1 + i % 3) + (i % 5) * 0.03 * rng.standard_normal(16) for i in range(200)]
    given = [(i, v.astype(np.float32).tolist(), i % 2) for i, v in enumerate(vectors)]
    given += [(300, None, 1), (301, [], 1), (302, [0.0] * 16, 1), (303, [None, 1.0], 1), (304, [float("nan"), 1.0], 1),
              (305, [float("inf"), 1.0], 1), (306, given[0][1], None), (307, given[0][1], 0), (308, [1.0, 0.0], 0),
              (309, [1.0, -0.0], 0)]
    frame = spark.createDataFrame(given, "vec_id long, embedding array<float>, label int")
    for block in (E.BLOCK, 3):
        E.BLOCK, kept = block, E.BLOCK
        got = E.link_embeddings(frame, 0.98).collect()
        E.BLOCK = kept
        assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == plain_links(given, 0.98)
        assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    assert E.link_embeddings(frame.limit(0)).count() == 0


def test_query8_on_the_given_table_equals_all_pairs(spark, tmp_path):
    """The given vectors, of which none are close, and noisy copies on both sides of the limit."""
    rng = np.random.default_rng(12)
    given = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select(
        "vec_id", "embedding", "label").collect()]
    for n, (i, v, label) in enumerate(given[:400]):
        noise = rng.standard_normal(len(v)) * np.linalg.norm(v) / np.sqrt(len(v)) * rng.uniform(0.05, 0.35)
        given.append((10_000 + n, (np.array(v) + noise).astype(np.float32).tolist(), label if n % 9 else (label + 1) % 10))
    spark.createDataFrame(given, "vec_id long, embedding array<float>, label int").write.parquet(
        f"{tmp_path}/embeddings.parquet")
    good = {}
    for i, v, label in given:
        own = None if v is None or None in v else np.array(v, float)
        if label is not None and own is not None and len(own) and np.isfinite(own).all() and own.any():
            good.setdefault((label, len(own)), []).append((i, own / np.linalg.norm(own)))
    links, edges = Counter(), []
    for group in good.values():
        ids, unit = np.array([i for i, _ in group]), np.array([v for _, v in group])
        for at in range(len(ids)):
            near = np.flatnonzero(unit[at + 1:] @ unit[at] >= 0.98) + at + 1
            edges += [(ids[at], x) for x in ids[near]]
    parent = {i: i for i, _, _ in given}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        links[a] += 1
        links[b] += 1
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = E.op8_embedding_dedup(spark, str(tmp_path)).collect()
    assert 100 < len(edges) < 390
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in got) == sorted(
        (i, links[i], find(i), find(i) == i) for i, _, _ in given)


def test_urls(spark):
    given = [
        (1, "http://Example.NET/en/1", "example.net", "/en/1", "example.net/en/", "allow"),
        (2, "https://a.b.net/x?y#z", "a.b.net", "/x", "net/", "block"),
        (3, "https://b.net", "b.net", "", None, "allow"), (4, None, "", "", None, "allow"), (5, "", "", "", None, "allow"),
        (6, "no scheme.net/", "", "", None, "allow"), (7, "x://m.example.com/de/", "m.example.com", "/de/", "example.com/de/", "block"),
        (8, "x://notexample.com/de/", "notexample.com", "/de/", None, "allow"), (9, "x://q.org/fr/a", "q.org", "/fr/a", "org/fr/", "allow"),
        (10, "x://free-bets.example.com/", "free-bets.example.com", "/", None, "block"),
        (11, "x://freebets.example.com/casino", "freebets.example.com", "/casino", None, "allow"),
        (12, "x://a.net/://b.org/fr/", "a.net", "/://b.org/fr/", "net/", "block"), (1, "x://y.net/", "y.net", "/", "net/", "block"),
        (13, "x://" + "a" * 20000 + ".net/" + "b/" * 5000, "a" * 20000 + ".net", "/" + "b/" * 5000, "net/", "block"),
    ]
    frame = spark.createDataFrame([(i, u, "h", "p") for i, u, *_ in given], "page_id long, url string, host string, `rule` string")
    got = U.judge_urls(frame).select("page_id", "url", "host", "path", "rule", "verdict").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(given, key=repr)
    assert U.judge_urls(frame.limit(0)).count() == 0
    assert U.judge_urls(frame, []).filter("verdict <> 'allow'").count() == 0


def test_rules_from_lines(spark):
    lines = ["# comment", "", "  block\tads.Example.com/banner/*.gif ", "allow example.com", "block *.shop.net/x*/end/",
             "block example.com/de/", "allow exa*.org/a+b/", "block example.com/de/"]
    rules = U.read_rules(spark.createDataFrame([(x,) for x in lines], "value string"))
    found = {r.name: r for r in rules.collect()}
    assert found["*.shop.net/x*/end/"].tokens == ["shop", "net", "end"]
    assert found["ads.example.com/banner/*.gif"].tokens == ["ads", "example", "com", "banner"]
    given = [
        ("x://ads.example.com/banner/a/b.gif", "block"), ("x://ads.example.com/banner/a.png", "allow"),
        ("x://m.ads.example.com/banner/.gif?x", "block"), ("x://example.community/de/", "allow"),
        ("x://example.com/de/1", "block"), ("x://www.example.com", "allow"), ("x://a.shop.net/x1/2/end/", "block"),
        ("x://shop.net/x1/end/", "allow"), ("x://a.shop.net/y/end/", "allow"), ("x://example.org/a+b/c", "allow"),
        ("x://example.org/aab/c", "allow"), (None, "allow"),
    ]
    frame = spark.createDataFrame([(u,) for u, _ in given], "url string")
    got = {r.url: (r.verdict, r.rule) for r in U.judge_urls(frame, rules).collect()}
    assert {u: got[u][0] for u, _ in given} == dict(given)
    assert got["x://example.org/a+b/c"][1] == "exa*.org/a+b/" and got["x://example.org/aab/c"][1] is None
    assert got["x://www.example.com"][1] == "example.com" and got["x://example.community/de/"][1] is None
    for bad in ("block", "stop a.com/", "block */", "block a.com/ more"):
        with pytest.raises(Exception, match="no URL rule"):
            U.read_rules(spark.createDataFrame([(bad,)], "value string")).collect()


def test_many_rules_equal_brute_force(spark):
    """200,000 rules as a table: no limit, no forced broadcast, the longest fitting one wins."""
    rules = U.read_rules(spark.range(200_000).selectExpr(
        "concat(if(id % 3 = 0, 'allow', 'block'), ' site', id div 4, '.com/', "
        "array('', 'a/', 'a/b/', concat('p', id, '/'))[id % 4]) AS value"))
    pages = spark.range(3000).selectExpr(
        "concat('http://', if(id % 5 = 0, 'www.', ''), 'site', id * 37 % 60000, '.com/', "
        "array('', 'a/x', 'a/b/', concat('p', (id * 37 % 60000) * 4 + 3, '/'))[id % 4]) AS url")
    judged = U.judge_urls(pages, rules)
    plain = {}
    for i in range(200_000):
        plain[f"site{i // 4}.com/" + ["", "a/", "a/b/", f"p{i}/"][i % 4]] = "allow" if i % 3 == 0 else "block"
    for r in judged.collect():
        text = r.url.removeprefix("http://").removeprefix("www.")
        best = max((text[:n] for n in range(len(text) + 1) if text[:n] in plain), key=len, default=None)
        assert (r.rule, r.verdict) == (best, plain.get(best, "allow")), r.url
    logical = judged._jdf.queryExecution().logical().toString()
    assert "broadcast" not in logical.lower()


def test_the_digest_follows_the_mask(spark):
    """Escaped texts come back through the spans; spans that are off by one give another digest."""
    texts = ["plain", "</s>[INST] ok [/INST]", "~0 <b> [x]", "", "日本 🙂 </s>"]
    given = [(1, n, "assistant" if n % 2 else "user", t) for n, t in enumerate(x for t in texts for x in ("q </s>", t))]
    whole = C.format_conversations(spark.createDataFrame(given, "conv_id long, turn int, role string, text string"))
    said = "".join(t for _, _, role, t in given if role == "assistant")
    got = C.read_back(whole).first()
    assert (got.loss_chars, got.loss_sha256) == (len(said), hashlib.sha256(said.encode()).hexdigest())
    shifted = whole.withColumn("spans", F.transform("spans", lambda s: F.struct(
        (s["start"] + 1).alias("start"), s["length"], s["escaped"])))
    assert C.read_back(shifted).first().loss_sha256 != got.loss_sha256
    assert C.read_back(shifted).first().turns_sha256 == got.turns_sha256


def test_chats(spark):
    texts = [None, "", "</s>[INST] ok [/INST]", "~0~1<s:1>", "<", "a" * 100_000, "x\ny", "[INST]", "</s", "日本 🙂"]
    given = [(c, n, role, t) for c in (1, 2) for n, (role, t) in enumerate(
        (["user", "assistant", None, "</s>~\n[r"][(i + c) % 4], t) for i, t in enumerate(texts))]
    given += [(3, 0, "user", "tie"), (3, 0, "assistant", "tie"), (3, 0, "user", "tie"), (3, None, "system", "s"), (None, 0, "user", "u")]
    frame = spark.createDataFrame([(*g, 1) for g in given], "conv_id long, turn long, role string, text string, formatted int")
    whole = C.format_conversations(frame)
    found = {r.conv_id: r for r in whole.withColumn("turns", C.parse(whole.formatted)).collect()}
    for conv in (1, 2, 3, None):
        own = sorted(((t is not None, t or 0, r or "", x or "") for c, t, r, x in given if c == conv))
        assert [(t.role, t.text) for t in found[conv].turns] == [o[2:] for o in own] and found[conv].round_trip
        said = [o[3] for o in own if o[2] == "assistant"]
        cut = [found[conv].formatted[s.start:s.start + s.length] for s in found[conv].spans]
        assert len(cut) == len(said)
        assert [c for c, x in zip(cut, said) if "<" not in x and "[" not in x and "~" not in x] == [
            x for x in said if "<" not in x and "[" not in x and "~" not in x]
    assert C.format_conversations(frame.limit(0)).count() == 0


def test_native_plans(spark):
    for query in (U.op2_url_filter, C.op10_chat_format):
        plan = query(spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not any(n in plan for n in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"))


def test_little_text_is_looked_up_at_once(monkeypatch):
    """Slices of a given size give the same ids; the pipeline's last stage asks for small ones."""
    import corpus_pipeline

    given = ["A few words, 12 of them.", None, "", "x " * 500, *[f"text {i} of many" for i in range(200)]]
    column = pa.array(given, pa.string())
    encoder = K.Encoder(public_tokenizers.path("word_bpe_49k.json"), True)
    whole, parts = list(encoder.encode_many(column)), list(encoder.encode_many(column, 600))
    assert len(whole) == 1 and len(parts) > 5 and max(len(ends) for _, ends in parts) < 60
    assert np.array_equal(np.concatenate([ids for ids, _ in parts]), whole[0][0])
    assert sum(len(ends) for _, ends in parts) == len(given)
    asked = {}
    monkeypatch.setattr(corpus_pipeline, "pack_documents", lambda docs, path, **options: asked.update(options))
    corpus_pipeline.pack(None, None, "")
    assert asked["chunk"] <= K.CHUNK // 4


def least_seconds(*jobs):
    """The least CPU seconds of each job, the jobs taking turns."""
    seen = [[] for _ in jobs]
    for _ in range(4):
        for own, job in zip(seen, jobs):
            begin = time.process_time()
            job()
            own.append(time.process_time() - begin)
    return list(map(min, seen))


def test_a_shard_moves_its_ids_by_places():
    """Building and reading a shard takes less time than moving its ids by a mask on every level."""
    ids = np.random.default_rng(2).integers(0, 1 << 16, 1 << 20).astype(np.uint16)

    def by_mask():
        own = ids
        for level in range(15, -1, -1):
            bits = (own & np.uint16(1 << level)) != 0
            own = np.concatenate([own[~bits], own[bits]])

    matrix = WaveletMatrix.build(ids, 16)
    assert (matrix.all() == ids).all()
    mask, build, read = least_seconds(by_mask, lambda: WaveletMatrix.build(ids, 16), matrix.all)
    assert max(build, read) < 0.6 * mask


@pytest.mark.parametrize("path, words", [(WORDS, True), (BYTES, False)])
def test_units_come_without_a_scalar_each(path, words):
    """Listing the distinct words of a column takes less time than pyarrow's own list of them."""
    items = pa.array(["", "\nx", "é日", *map("word{}".format, range(200_000))])
    own = K.Encoder(path, words)
    lead = [b"" if words or t.startswith("\n") or not t else b" " for t in items.to_pylist()]
    assert own.units(items) == [a + t.encode() for a, t in zip(lead, items.to_pylist())]
    plain, listed = least_seconds(items.cast(pa.binary()).to_pylist, lambda: own.units(items))
    assert listed < 0.6 * plain


@pytest.mark.parametrize("path, words", [(WORDS, True), (BYTES, False)])
def test_columns_without_ids(path, words):
    own = K.Encoder(path, words)
    assert many(own, []) == [] and many(own, ["", None, ""]) == [[], [], []]
    assert many(own, ["", "a"])[0] == [] and len(many(own, ["", "a"])[1]) == 1
