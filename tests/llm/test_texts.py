"""Line dedup, quality rules, the classifier and near copies against plain versions."""

import hashlib
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash

from finfacts.llm import grade_classifier as G, line_dedup as L, quality_rules as Q, simhash_dedup as S
from finfacts.llm.components import connected_components
from tests.llm.conftest import TEXTS, rows

SF = "/root/testdata/sf0.001"
SPACE = "\x20\x09-\x0d"


def key(line):
    stripped = re.sub(f"^[{SPACE}]+|[{SPACE}]+$", "", line)
    return re.sub("[A-Z]", lambda m: m[0].lower(), stripped)


def plain_lines(given, least):
    counts = Counter(k for _, t in given for k in {key(x) for x in (t or "").split("\n")} if k)
    out = []
    for i, t in given:
        lines = (t or "").split("\n")
        stay = [x for x in lines if counts[key(x)] < least]
        out.append((i, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("bits", [L.FILTER_BITS, 1 << 21])
def test_lines(docs, bits):
    got = L.dedup_lines(docs, 2, keep_first=False, bits=bits)
    assert "odd name" in got.columns
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in got.collect()), key=repr) \
        == plain_lines(rows(), 2)


def test_first_line_stays(spark):
    given = spark.createDataFrame([(2, "b\nx"), (1, "X \nx\na"), (3, "x")], "doc_id long, text string")
    got = {r.doc_id: r.text for r in L.dedup_lines(given, 2).collect()}
    assert got == {1: "X \na", 2: "b", 3: ""}


def test_first_lines_equal_a_plain_version(spark):
    """The smallest id keeps a repeated line, once; of many copies of a text one stays whole."""
    given = [(i, "\n".join(f"line {(i * k) % 11}" for k in range(1, 6)) + f"\n\nown {i % 40}") for i in range(60)]
    given += [(100 + i, "copied one\nCopied two") for i in range(12)]
    counts = Counter(k for _, t in given for k in {key(x) for x in t.split("\n")} if k)
    seen, want = set(), {}
    for i, t in given:
        stay = []
        for line in t.split("\n"):
            k = key(line)
            if counts[k] < 3 or k not in seen:
                stay.append(line)
            seen |= {k} if k else set()
        want[i] = "\n".join(stay)
    shuffled = spark.createDataFrame(given[::-1], "doc_id long, text string").repartition(5)
    got = {r.doc_id: r.text for r in L.dedup_lines(shuffled, 3).collect()}
    assert got == want and got[100] == "copied one\nCopied two" and got[111] == ""


def test_full_filter_gives_the_same(spark):
    """A filter too small for the keys makes every key a suspect and changes nothing."""
    given = [(i, f"line {i % 700}\nown {i}") for i in range(1500)]
    frame = spark.createDataFrame(given, "doc_id long, text string")
    got = L.dedup_lines(frame, 3, keep_first=False, bits=1 << 21)
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in got.collect()), key=repr) == plain_lines(given, 3)


def test_empty_tables(spark, empty):
    assert L.dedup_lines(empty).count() == 0
    assert Q.rule_quality(empty).count() == 0
    assert S.dedup_near(empty).count() == 0
    assert S.near_components(empty, 3, 2, None).count() == 0
    ratings = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = G.fit_documents(empty, G.graded(ratings))
    assert model is None and G.grade_documents(empty, model).count() == 0


def plain_figures(t):
    t = t or ""
    words = re.findall(f"[^{SPACE}]+", t)
    seen, duplicates = set(), 0
    for line in t.split("\n"):
        if re.search(f"[^{SPACE}]", line):
            duplicates += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {i + j for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for j in range(8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), duplicates, len(covered)


def test_figures():
    table = duckdb.sql(f"SELECT text FROM '{SF}/documents.parquet'").fetchall()
    for t in [*TEXTS, "a b c d e f g h " * 4, *(t for t, in table)]:
        assert Q.text_figures((t or "").encode())[:5] == plain_figures(t)


def test_rules(docs):
    got = Q.rule_quality(docs, max_docs=1, min_kept_percent=50).collect()
    assert len(got) == len(rows())
    for r in got:
        assert (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) == r.base_failed
        assert not (r.base_failed and r.kept)


def test_common_lines_of_a_host_go(spark):
    common = " ".join(f"c{i}" for i in range(30))
    given = [(i, f"{common}\n{' '.join(f'o{i}_{j}' for j in range(5 if i < 3 else 60))}", "h") for i in range(6)]
    given += [(9, common, "other"), (10, given[0][1], "h")]
    frame = spark.createDataFrame(given, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in Q.rule_quality(frame, max_docs=5, min_kept_percent=50).collect()}
    assert [i for i in got if got[i].kept] == [3, 4, 5, 9] or {i for i in got if got[i].kept} == {3, 4, 5, 9}
    assert common not in got[4].text and got[9].text == common and got[4].n_removed_words == 30


def test_query4_against_plain(spark):
    got = {r.doc_id: r for r in Q.op4_quality_rules(spark, SF).collect()}
    table = duckdb.sql(f"SELECT doc_id, text, source FROM '{SF}/documents.parquet'").fetchall()
    normal = lambda x: " ".join(re.sub("[1-9]", "0", re.sub("[A-Z]", lambda m: m[0].lower(), x)).split())
    distinct = {(s, t) for _, t, s in table}
    counts = Counter((s, k) for s, t in distinct for k in {normal(x) for x in t.split("\n")} if k)
    for i, t, s in table:
        figures = plain_figures(t)
        assert tuple(got[i][n] for n in Q.FIGURES) == figures
        lost = sum(len(x.split()) for x in t.split("\n") if counts[s, normal(x)] > Q.MAX_DOCS)
        failed = figures[0] < 20 or 100 * figures[4] > 30 * figures[0]
        assert got[i].base_failed == failed
        assert got[i].kept == (not failed and 100 * (figures[0] - lost) >= Q.MIN_KEPT_PERCENT * figures[0])


def plain_fingerprint(t, size):
    words = re.findall(f"[^{SPACE}]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    shingles = [" ".join(words[i:i + size]) for i in range(len(words) - size + 1)] or (
        [" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(s.encode(), 42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(points, near):
    parent = list(range(len(points)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(points)):
        for j in range(i):
            if near(points[i], points[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(points))]


@pytest.mark.parametrize("shard, block", [(S.SHARD, S.BLOCK), (20, 5), (10_000, 16)])
def test_query5_against_plain(spark, monkeypatch, shard, block):
    monkeypatch.setattr(S, "SHARD", shard)
    monkeypatch.setattr(S, "BLOCK", block)
    table = sorted(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())
    prints = [plain_fingerprint(t, 3) for _, t in table]
    groups = plain_components(prints, lambda a, b: (a ^ b).bit_count() <= 2)
    expected = {i: (f"{p:016x}", table[g][0]) for (i, _), p, g in zip(table, prints, groups)}
    got = S.op5_simhash_dedup(spark, SF).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == expected


def test_blocks_of_a_crowded_shard_find_all_links(spark, monkeypatch):
    """Close fingerprints share a shard; blocks that hold a few of them give the same components."""
    monkeypatch.setattr(S, "SHARD", 50)
    monkeypatch.setattr(S, "BLOCK", 8)
    rng = np.random.default_rng(9)
    base = rng.integers(0, 1 << 63, 4, dtype=np.uint64)
    flips = [b ^ (np.uint64(1) << np.uint64(i)) ^ (np.uint64(1) << np.uint64(j))
             for b in base for i, j in rng.integers(0, 24, (60, 2)).tolist()]
    points = np.unique(np.array(flips, np.uint64))
    frame = spark.createDataFrame([(int(p),) for p in points.view(np.int64)], "fp long")
    links = S.fingerprint_links(frame, 1)
    groups = plain_components([int(p) for p in points], lambda a, b: (a ^ b).bit_count() <= 1)
    got = {r.node: r.component for r in connected_components(links).collect()}
    signed = points.view(np.int64).tolist()
    least = {}
    for p, g in zip(signed, groups):
        least[g] = min(least.get(g, p), p)
    assert {p: got.get(p, p) for p in signed} == {p: least[g] for p, g in zip(signed, groups)}


@pytest.mark.parametrize("radius", [0, 2, 12])
def test_shards_lose_no_pair(spark, radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    flips = [base] + [base ^ (np.uint64(1) << rng.integers(0, 64, 60).astype(np.uint64)) for _ in range(4)]
    points = np.unique(np.concatenate(flips))
    tree = S.Tree(points, 3)
    home = tree.home(points, 3)
    at, node = tree.visits(points, 3, radius)
    visits = set(zip(at.tolist(), node.tolist()))
    pairs = np.argwhere(np.bitwise_count(points[:, None] ^ points[None, :]) <= radius)
    assert all((int(i), int(home[j])) in visits for i, j in pairs)
    found = set()
    S.search(points, np.ones(len(points), bool), radius, lambda i, j: found.update(zip(i.tolist(), j.tolist())))
    assert found == {(int(i), int(j)) for i, j in pairs if i < j}


def test_near_copies(spark):
    rng = np.random.default_rng(1)
    words = [f"t{i}" for i in range(4000)]
    base = [" ".join(rng.choice(words, 300)) for _ in range(20)]
    near = [" ".join([*b.split()[:-3], "x", "y", "z"]) for b in base]
    given = list(enumerate([*base, *near, *base[:5], "", None]))
    frame = spark.createDataFrame(given, "doc_id long, text string")
    kept = sorted(r.doc_id for r in S.dedup_near(frame).collect())
    assert kept == [*range(20), 45]


def test_clashing_columns_and_repeats(docs):
    got = S.dedup_near(docs)
    assert got.columns == docs.columns
    texts = [r.text for r in got.collect()]
    assert texts.count(TEXTS[5]) == 1 and "same id, other text" in texts


def test_of_rows_with_one_id_and_text_the_same_one_stays(spark):
    given = [(1, "a b c d e f", n) for n in range(40)]
    kept = {S.dedup_near(spark.createDataFrame(given[::order], "doc_id long, text string, n long").repartition(
        6)).first().n for order in (1, -1, 3, -3) if given[::order][0] and len(given[::order]) == 40}
    assert len(kept) == 1


def test_components(spark):
    links = [(i, i + 1) for i in range(200)] + [(500, i) for i in range(501, 700)] + [(900, 900)]
    got = connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == {
        **{i: 0 for i in range(201)}, **{i: 500 for i in range(500, 700)}}


def test_classifier_on_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    grades = G.graded(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"))
    known = grades.filter("doc_id % 3 <> 0")
    model = G.fit_documents(docs, known)
    held = G.grade_documents(docs, model).join(grades.filter("doc_id % 3 = 0"), "doc_id").toPandas()
    assert (held.kept[held.grade == 2]).mean() > 0.95
    assert (~held.kept[held.grade == 0]).mean() > 0.95
    assert (~held.kept[held.grade == 1]).mean() > 0.6
    means = held.groupby("grade").expected_grade.mean()
    assert means[0] < means[1] < means[2]
    tails = np.array(held.tails.tolist())
    assert (tails[:, 0] >= tails[:, 1]).all()


def plain_loss(x, matrix, grades):
    """Mean penalised loss of a cumulative-link model: weights, then ordered thresholds by their steps."""
    weights, bounds = x[:matrix.shape[1]], x[matrix.shape[1]:]
    thresholds = bounds[0] + np.append(0, np.cumsum(np.exp(bounds[1:])))
    score = matrix @ weights
    total = 0.0
    for s, g in zip(score, grades):
        upper = 1.0 if g == 0 else 1 / (1 + np.exp(thresholds[g - 1] - s))
        lower = 0.0 if g == len(thresholds) else 1 / (1 + np.exp(thresholds[g] - s))
        total -= np.log(max(upper - lower, 1e-12))
    return total / len(grades) + G.RIDGE * (weights @ weights) / (2 * len(grades))


def test_fit_reaches_the_optimum_of_the_plain_loss():
    """The model has the least loss of a plain minimiser that only compares losses."""
    rng = np.random.default_rng(6)
    n = 240
    grades = rng.integers(0, 3, n)
    matrix = np.column_stack([
        rng.random(n) < 0.15 + 0.3 * grades, rng.random(n) < 0.9 - 0.35 * grades, rng.random(n) < 0.5 + 0.2 * (grades > 1),
    ]).astype(float) * np.array([1.0, 2.0, 0.5])
    rows_ = [(np.flatnonzero(r).tolist(), r[r > 0].tolist()) for r in matrix]
    model = G.fit(rows_, grades)
    used = np.flatnonzero(model.weights[:3])
    assert len(used) >= 2
    scale = np.sqrt((matrix ** 2).sum(axis=0) / n)[used]
    scaled = matrix[:, used] / scale
    fitted = np.concatenate([model.weights[used] * scale, [model.thresholds[0]], np.log(np.diff(model.thresholds))])
    loss = lambda x: plain_loss(x, scaled, grades)
    best, step = np.zeros(len(fitted)), 1.0
    while step > 1e-4:
        trials = [best + step * e * sign for e in np.eye(len(best)) for sign in (1, -1)]
        new = min(trials, key=loss)
        if loss(new) < loss(best) - 1e-12:
            best = new
        else:
            step /= 2
    assert abs(loss(fitted) - loss(best)) < 1e-4
    assert loss(fitted) <= loss(best) + 1e-4 and np.abs(fitted - best).max() < 0.1


def test_only_useful_features_reach_the_driver(spark):
    """The fit of the features chosen by Spark is that of all features."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    grades = G.graded(spark.read.parquet(f"{SF}/labels.parquet"))
    rated = docs.join(grades, "doc_id").orderBy("doc_id").collect()
    whole = G.fit([G.features((r.text or "").encode()) for r in rated], np.array([r.grade for r in rated]))
    model = G.fit_documents(docs, grades)
    assert (np.flatnonzero(model.weights) == np.flatnonzero(whole.weights)).all()
    assert np.allclose(model.weights, whole.weights, atol=1e-3) and np.allclose(
        model.thresholds, whole.thresholds, atol=1e-3)


def test_query9_scores_equal_a_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = G.fit_documents(docs, G.graded(spark.read.parquet(f"{SF}/labels.parquet")))
    got = {r.doc_id: r for r in G.op9_quality_classifier(spark, SF).collect()}
    given = docs.select("doc_id", "text").collect()
    assert len(got) == len(given)
    for i, t in given:
        score = sum(model.weights[p] * v for p, v in zip(*G.features((t or "").encode())))
        tails = [1 / (1 + np.exp(b - score)) for b in model.thresholds]
        r = got[i]
        assert abs(r.p_at_least_1 - tails[0]) < 1e-6 and abs(r.p_top - tails[-1]) < 1e-6
        assert abs(r.expected_grade - sum(tails)) < 1e-6
        assert r.kept == (r.p_top >= G.KEEP_PROBABILITY)


def test_scores_equal_features(docs):
    rng = np.random.default_rng(0)
    weights = rng.standard_normal(1 << G.HASH_BITS)
    known = G._Weights(weights)
    for t in TEXTS:
        raw = (t or "").encode()
        assert abs(G.score_text(raw, known) - sum(weights[p] * v for p, v in zip(*G.features(raw)))) < 1e-6


def test_grades_keep_rows_and_names(docs):
    model = G.Model(np.zeros(1 << G.HASH_BITS), np.array([-1.0, 0.5]))
    got = G.grade_documents(docs, model)
    assert got.count() == len(rows()) and "odd name" in got.columns
    assert G.select_documents(docs, model, 0.0).columns == docs.columns
    assert G.select_documents(docs, model, 0.9).count() == 0


def test_ordinal_fit_recovers_the_order():
    rng = np.random.default_rng(2)
    grades = rng.integers(0, 4, 800)
    given = [([int(g), 10], [1.0, 1.0]) for g in grades]
    model = G.fit(given, grades)
    scores = [model.weights[g] + model.weights[10] for g in range(4)]
    assert scores == sorted(scores) and (np.diff(model.thresholds) > 0).all()


def test_query1_digest(spark):
    got = L.op1_line_dedup(spark, SF).collect()
    expected = duckdb.sql(L.OP1_SQL.replace("FROM documents", f"FROM '{SF}/documents.parquet'")).fetchall()
    assert sorted(map(tuple, got)) == sorted(expected)
    assert hashlib.sha256(b"").hexdigest() != got[0].kept_sha256


def test_swapped_nulls_are_different_documents(spark):
    """A null source with a text and the same source with a null text share nothing."""
    text = "one two three"
    for order in (1, -1):
        given = [(1, "web", None), (2, None, "web"), (3, "web", text), (4, text, "web")][::order]
        docs = spark.createDataFrame(given, "doc_id long, source string, text string")
        got = {r.doc_id: (r.n_words, r.word_chars) for r in Q.rule_quality(docs).collect()}
        assert got == {1: (0, 0), 2: (1, 3), 3: (3, 11), 4: (1, 3)}
