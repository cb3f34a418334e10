"""Periodic runs, the prefix trie and window packing against plain versions."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from finfacts.llm import periodic_runs as R, prefix_trie as P, window_packing as W
from finfacts.llm.tree_contraction import subtree_sums
from tests.llm.conftest import rows

SF = "/root/testdata/sf0.001"


# ---- periodic runs ----------------------------------------------------------------


def plain_runs(words, least=24, periods=3):
    """All maximal runs, period by period."""
    n, found = len(words), {}
    for q in range(1, n // periods + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            begin = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - begin >= max(least, periods * q):
                # The smallest period comes first.
                found.setdefault((begin, i + q - begin), q)
    return sorted(((s, l, q) for (s, l), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_collapse(words, runs):
    gone = {i for s, l, q in runs for i in range(s + q, s + l)}
    return [w for i, w in enumerate(words) if i not in gone]


def random_words(rng):
    kind, letters = rng.random(), rng.choice([1, 2, 3, 9, 50])
    words = [rng.randrange(letters) for _ in range(rng.randrange(0, 150))]
    if kind < 0.7:
        unit = [rng.randrange(letters + 1) for _ in range(rng.randrange(1, 12))]
        words[rng.randrange(len(words) + 1):0] = unit * rng.randrange(2, 9)
        words += words[:rng.randrange(len(words) + 1)] * rng.randrange(1, 4)
    return [b"w%d" % w for w in words]


@pytest.mark.parametrize("least, periods", [(24, 3), (6, 3), (4, 2), (7, 2)])
def test_runs_equal_a_plain_version(least, periods):
    rng = random.Random(least)
    hits = 0
    for _ in range(400):
        words = random_words(rng)
        runs = R.runs_of(words, least, periods)
        assert runs == plain_runs(words, least, periods), words
        assert R.without_repeats(words, runs) == plain_collapse(words, runs)
        hits += bool(runs)
    assert hits > 100


def test_squares_of_fibonacci_and_powers():
    a, b = [0], [0, 1]
    while len(b) < 300:
        a, b = b, b + a
    words = [b"%d" % x for x in b[:300]]
    assert R.runs_of(words, 4, 2) == plain_runs(words, 4, 2)
    assert R.runs_of([b"a"] * 5000) == [(0, 5000, 1)]
    assert R.runs_of([b"a"] * 23) == [] and R.runs_of([]) == []


def test_long_period_runs():
    rng = random.Random(3)
    unit = [b"%d" % rng.randrange(10 ** 6) for _ in range(700)]
    words = unit[5:] + unit * 3 + unit[:9] + [b"end"] + unit
    assert R.runs_of(words) == [(0, 695 + 2109, 700)]


def test_strongest_run_is_exact_and_ties_go_to_the_first():
    assert R.strongest([]) is None
    assert R.strongest([(5, 40, 10), (0, 30, 10), (60, 28, 7), (90, 24, 6)]) == (5, 40, 10)


def plain_row(doc_id, text):
    words = (text or "").encode().split()
    if doc_id is not None and words:
        h = zlib.crc32(str(doc_id).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(runs), *best, None if not runs else 1000 * best[1] // best[2],
            sha("".join("%d,%d,%d\n" % r for r in runs).encode()),
            sha(b" ".join(plain_collapse(words, runs))))


def test_query_on_runs_equals_a_plain_version(spark):
    got = {r.doc_id: tuple(r) for r in R.op12_periodic_runs(spark, SF).collect()}
    given = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(given)
    chosen = [(i, t) for i, t in given if len((t or "").split()) < 2500]
    assert len(chosen) > 0.9 * len(given)
    assert any(got[i][1] for i, _ in chosen)
    for i, t in chosen:
        assert got[i] == plain_row(i, t)


def test_runs_of_odd_rows(docs, empty):
    found = R.periodic_runs(docs)
    assert [c for c in found.columns if c in docs.columns] == [c for c in docs.columns if c != "text"]
    assert sorted(((r.doc_id, r.n_words, r.collapsed) for r in found.collect()), key=repr) == sorted(
        ((i, len(w), b" ".join(plain_collapse(w, plain_runs(w[:60] if len(w) > 9999 else w))).decode())
         for i, t in rows() for w in [(t or "").encode().split()]), key=repr)
    assert R.periodic_runs(empty).count() == 0
    again = docs.withColumn("runs", docs.doc_id)
    assert dict(R.periodic_runs(again).dtypes)["runs"].startswith("array")
    with pytest.raises(ValueError):
        R.periodic_runs(docs, min_periods=1)


# ---- prefix trie ------------------------------------------------------------------


def plain_trie(conversations):
    """Nodes of {id: [(role, text), ...]}, by recursion over prefixes."""
    members = defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = Counter(k[:-1] for k in members if k)
    leaves, saved = Counter(), Counter()
    for k, own in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not children[k]
            saved[k[:d]] += (len(own) - 1) * len(k[-1][1].encode()) if k else 0
    rows = []
    for k, own in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in own if len(conversations[c]) == len(k)))
        rows.append((min(own), len(k), min(members[k[:-1]]) if k else None, len(own), children[k],
                     leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows)


def grouped(given):
    """Conversations of (conv_id, turn, role, text) rows."""
    out = defaultdict(list)
    for c, turn, role, text in given:
        if c is not None:
            out[c].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, t) for *_, r, t in sorted(x)] for c, x in out.items()}


def rebuilt(conversations):
    out = {}
    for c, turns in conversations.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = conversations.get(c - c % 5, [])[:h] + turns[h:]
    return out


def trie_rows(trie):
    nothing = hashlib.sha256(b"").hexdigest()
    digests = {(r.conv_id, r.depth): r.ends_sha256 for r in P.ends_digests(trie.ends).collect()}
    return sorted((*r, digests.get((r.conv_id, r.depth), nothing)) for r in trie.nodes.collect())


def test_query_on_tries_equals_a_plain_version(spark):
    got = P.op11_prefix_trie(spark, SF)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                           "saved_tokens", "ends_sha256"]
    given = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, got.collect())) == plain_trie(rebuilt(grouped(given)))


def test_trie_of_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(P, "BLOCK", 4)
    monkeypatch.setattr(P, "IDS_AT_ONCE", 3)
    given = [(c, t, "u", f"same {t}") for c in range(1, 9) for t in range(c + 12)]
    given += [(20, None, None, None), (20, None, "a", "é"), (20, 1, "u", ""), (20, 1, "u", ""), (20, 2, None, "z")]
    given += [(21, None, "", ""), (22, 0, "u", "same 0"), (None, 0, "u", "lost"), (-3, 5, "u", "same 0")]
    given += [(c, t, "u", f"same {t}") for c in range(30, 42) for t in (1, 0)]
    turns = spark.createDataFrame(
        [(*r, 1, "x") for r in given], "conv_id long, turn int, role string, text string, depth int, k1 string")
    assert trie_rows(P.prefix_trie(turns)) == plain_trie(grouped(given))
    assert trie_rows(P.prefix_trie(turns.limit(0))) == []
    numbered = P.numbered_turns(turns)
    got = P.build_trie(*P.rebuilt_turns(numbered))
    assert trie_rows(got) == plain_trie(rebuilt(grouped(given)))


def plain_sums(parents, values):
    totals = dict(values)
    depth = lambda v: 0 if parents[v] is None else 1 + depth(parents[v])
    for v in sorted(parents, key=depth, reverse=True):
        if parents[v] is not None:
            totals[parents[v]] += totals[v]
    return totals


def test_subtree_sums_of_chains_stars_and_random_trees(spark):
    rng = random.Random(5)
    parents = {0: None, 200: None, 201: None}
    parents |= {i: i - 1 for i in range(1, 90)}                  # a chain
    parents |= {i: 200 for i in range(210, 260)}                 # a star
    parents |= {i: rng.choice([x for x in parents if x < i]) for i in range(300, 400)}
    values = {v: rng.randrange(-5, 100) for v in parents}
    tree = spark.createDataFrame(
        [(v, p, values[v], 1) for v, p in parents.items()], "v long, p long, a long, n long").withColumnRenamed("n", "b")
    got = {r.v: (r.a, r.b) for r in subtree_sums(tree, ["a", "b"]).collect()}
    sums, sizes = plain_sums(parents, values), plain_sums(parents, dict.fromkeys(parents, 1))
    assert got == {v: (sums[v], sizes[v]) for v in parents}
    assert subtree_sums(tree.limit(0), ["a"]).collect() == []


# ---- window packing ---------------------------------------------------------------


def check_windows(found, given, capacity):
    """Every id of every document in one piece; sequences without gaps; no padding."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokenizer.encode_special_tokens = True
    want = Counter()
    for i, t in given:
        want[i, tuple(tokenizer.encode(t or "", add_special_tokens=False).ids) + (1,)] += 1
    sequences, ids = defaultdict(list), defaultdict(list)
    for r in found:
        raw = bytes(r.ids)
        assert len(raw) == 4 * r.length > 0 and zlib.crc32(raw) == r.ids_crc32
        sequences[r.sequence_id].append((r.offset, r.length))
        ids[r.doc_id, r.doc_tokens].append((r.start, tuple(np.frombuffer(raw, "<u4").tolist())))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at == capacity or at & (at - 1) == 0 and at < capacity
    # Pieces of rows with one id and length are told apart by their ids.
    whole = Counter({k: n for k, n in want.items()})
    for (i, n), pieces in ids.items():
        documents = [w for (j, w), k in whole.items() for _ in range(k) if j == i and len(w) == n]
        covered = Counter(at + x for at, p in pieces for x in range(len(p)))
        assert covered == Counter({x: len(documents) for x in range(n)})
        for at, p in pieces:
            assert any(d[at:at + len(p)] == p for d in documents)
    assert sum(len(w) * k for (_, w), k in whole.items()) == sum(r.length for r in found)
    return sequences


@pytest.mark.parametrize("capacity, open_windows, fan_in", [(2048, 32, 8), (64, 3, 2), (32, 1, 2)])
def test_windows(docs, empty, capacity, open_windows, fan_in):
    path = public_tokenizers.path("word_bpe_49k.json")
    options = dict(capacity=capacity, open_windows=open_windows, fan_in=fan_in)
    found = W.pack_windows(docs.repartition(5), path, **options).collect()
    sequences = check_windows(found, rows(), capacity)
    short = [n for own in sequences.values() if (n := sum(x for _, x in own)) < capacity]
    assert len(set(short)) == len(short)
    assert W.pack_windows(empty, path, **options).count() == 0


def test_windows_keep_documents_whole_where_they_fit():
    """A document is cut only to top up a window that no other document fitted."""
    rng = random.Random(1)
    windows, closed = W.OpenWindows(2048, 32), []
    for i in range(3000):
        piece = W.Piece(i, 0, np.zeros(rng.randrange(1, 900), np.uint32), 0)
        closed += windows.place(piece)
    assert len(windows.windows) <= 32
    assert all(sum(len(p.ids) for p in w) == 2048 for w in closed)
    cuts = sum(p.start > 0 for w in closed for p in w)
    assert 0 < cuts <= len(closed)
    rest = sum(len(p.ids) for w in windows.windows for p in w)
    last = [sum(len(p.ids) for p in w) for w in windows.finish()]
    assert sum(last) == rest and all(n == 2048 or n & (n - 1) == 0 for n in last)
    assert list(windows.finish()) == []


def test_query_on_windows(spark):
    found = W.op13_window_packing(spark, SF)
    assert set(found.columns) == {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    path = public_tokenizers.path("word_bpe_49k.json")
    with_ids = W.pack_windows(docs, path)
    given = [tuple(r) for r in docs.collect()]
    check_windows(with_ids.collect(), given, 2048)
    order = found.columns
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, with_ids.select(order).collect()))
