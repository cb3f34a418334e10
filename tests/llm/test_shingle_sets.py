"""Near copies by exact similarity against plain comparisons of all pairs."""

import numpy as np
import pytest

from finfacts.llm import shingle_sets as X, simhash_dedup as S
from tests.llm.test_texts import plain_components


def plain_set(text, size=5):
    words = text.split()
    return {" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def plain_jaccard(a, b):
    return len(a & b) / len(a | b)


def members(spark, texts, **options):
    given = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component for r in S.near_components(given, min_similarity=0.8, **options).collect()}
    return [min(i for i in got if got[i] == got[k]) for k in range(len(texts))]


def expected(texts):
    sets = [plain_set(t) for t in texts]
    return plain_components(sets, lambda a, b: a == b or plain_jaccard(a, b) >= 0.8)


def edited(rng, words, edits):
    """The words with some of them replaced at random places."""
    out = list(words)
    for k in rng.choice(len(words), edits, replace=False).tolist():
        out[k] = f"new{rng.integers(1 << 40)}"
    return out


def test_links_equal_brute_force_around_the_limit(spark):
    rng = np.random.default_rng(5)
    texts, seen = [], []
    for k in range(400):
        n = int(rng.integers(60, 500))
        base = [f"d{k}w{i}" for i in range(n)]
        # Replaced words cost five shingles each; this spreads pairs over 0.75 to 0.92.
        copy = edited(rng, base, max(1, round(n * rng.uniform(0.008, 0.032))))
        texts += [" ".join(base), " ".join(copy)]
        seen.append(plain_jaccard(plain_set(texts[-2]), plain_set(texts[-1])))
    seen = np.array(seen)
    assert min(((seen >= 0.78) & (seen < 0.8)).sum(), ((seen >= 0.8) & (seen < 0.82)).sum()) >= 10
    got = members(spark, texts)
    assert [got[2 * k + 1] == 2 * k for k in range(400)] == (seen >= 0.8).tolist()


def test_short_texts_and_exact_limit(spark):
    """Four of five shingles are exactly 0.8, four of six are less."""
    nine = " ".join(f"a{i}" for i in range(9))
    eight = " ".join(f"a{i}" for i in range(8))
    other = [" ".join(f"b{i}" for i in range(n)) for n in (8, 10)]
    texts = [nine, eight, *other, "one", "ONE", "two", "", None, " \n"]
    assert members(spark, texts) == [0, 0, 2, 3, 4, 4, 6, 7, 7, 7]


@pytest.mark.parametrize("block", [X.BLOCK, 7])
def test_large_group_is_compared_in_blocks(spark, monkeypatch, block):
    """Edits of one text, most of them apart from each other, give the components of all pairs."""
    monkeypatch.setattr(X, "BLOCK", block)
    rng = np.random.default_rng(8)
    base = [f"w{i}" for i in range(120)]
    texts = [" ".join(edited(rng, base, int(rng.integers(1, 6)))) for _ in range(150)]
    want = expected(texts)
    assert len(set(want)) > 20 and max(map(want.count, want)) > 5
    assert members(spark, texts) == want


def test_no_task_gets_more_than_two_blocks(spark, monkeypatch):
    monkeypatch.setattr(X, "BLOCK", 10)
    met = []
    monkeypatch.setattr(X, "stored", lambda df, keep=X.stored: met.append(keep(df)) or met[-1])
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(100)]
    members(spark, [" ".join(edited(rng, base, 4)) for _ in range(200)])
    joined = next(df for df in met if "left" in df.columns)
    largest = joined.groupBy("band", "key", "left", "right").count().agg({"count": "max"}).first()[0]
    assert joined.filter("right > 1").count() > 0 and largest <= 4 * X.BLOCK


@pytest.mark.parametrize("repeats", [2, 9])
def test_repeated_passage_does_not_part_copies(spark, repeats):
    """The sets are nearly equal, the numbers of shingles with repeats are far apart."""
    texts = []
    for k in range(40):
        body = [f"d{k}w{i}" for i in range(200)]
        texts += [" ".join(body), " ".join([*body, *body[-100:] * repeats])]
    assert members(spark, texts) == [i // 2 * 2 for i in range(80)]


def test_equal_fingerprints_of_different_texts_stay_apart(spark):
    """A line that makes up most of a text sets its fingerprint, and little of its set."""
    line = " ".join(["same"] * 400)
    texts = [f"{line} " + " ".join(f"d{k}w{i}" for i in range(100)) for k in range(6)]
    assert len({S.fingerprint(t.encode(), 5) for t in texts}) == 1
    assert members(spark, texts) == list(range(6))


def test_a_hub_is_carried_once_per_block(spark, monkeypatch):
    """Of 300 near copies every set goes along once, that of the hub once for each block of partners."""
    rng = np.random.default_rng(4)
    base = [f"w{i}" for i in range(400)]
    texts = [" ".join(edited(rng, base, 1)) for _ in range(300)]
    met = []
    monkeypatch.setattr(X, "stored", lambda df, keep=X.stored: met.append(keep(df)) or met[-1])
    assert members(spark, texts) == [0] * 300
    placed = next(df for df in met if "hub" in df.columns)
    pairs, blocks = placed.count(), placed.select("hub", "block").distinct().count()
    hubs = placed.groupBy("hub").count().agg({"count": "max"}).first()[0]
    assert pairs < 2 * len(texts) and hubs > 200
    assert blocks <= pairs / X.PARTNERS * 2 + placed.select("hub").distinct().count()


def test_fingerprint_is_the_majority_among_distinct_shingles():
    """Every bit as a plain count gives it, ties zero; repeats of a passage change nothing."""
    words = [f"w{i}" for i in range(700)]
    for text in ("one", " ".join(words[:9]), " ".join(words), " ".join(words + words[:300])):
        hashes = X.shingle_set(text.encode(), 5)
        got = X.wide_fingerprint(hashes).view(np.uint64)
        each = [X.wide_fingerprint(hashes[k:k + 1]).view(np.uint64) for k in range(len(hashes))]
        want = [sum(int(x[w] >> np.uint64(b)) & 1 for x in each) * 2 > len(hashes)
                for w in range(X.WORDS) for b in range(64)]
        assert [bool(int(got[w] >> np.uint64(b)) & 1) for w in range(X.WORDS) for b in range(64)] == want
    assert len({x.tobytes() for x in each}) == len(each)


def test_radius_holds_pairs_at_the_limit():
    """Sets at 0.8, small ones too, lie within the radius, unrelated ones outside of it."""
    rng = np.random.default_rng(7)
    radius = X.radius_of(0.8)
    differ = lambda a, b: int(np.bitwise_count((X.wide_fingerprint(a) ^ X.wide_fingerprint(b)).view(np.uint64)).sum())
    for both, one, other in ((4, 0, 1), (8, 1, 1), (12, 0, 3), (80, 10, 10), (800, 0, 200), (8000, 1000, 1000)):
        for _ in range(200 if both < 1000 else 20):
            own = rng.integers(0, 1 << 63, both + one + other, np.uint64)
            assert differ(own[:both + one], np.append(own[:both], own[both + one:])) <= radius
            apart = rng.integers(0, 1 << 63, (2, both), np.uint64)
            assert differ(*apart) > radius or both < 80


def test_near_copies_come_from_shards_of_a_tree(spark, monkeypatch):
    """Bands cut into shards by vantage points, and shards into blocks, give the links of all pairs."""
    monkeypatch.setattr(X, "SHARD", 3)
    monkeypatch.setattr(X, "BLOCK", 9)
    met = []
    monkeypatch.setattr(X, "stored", lambda df, keep=X.stored: met.append(keep(df)) or met[-1])
    rng = np.random.default_rng(12)
    texts = []
    for k in range(30):
        base = [f"d{k}w{i}" for i in range(int(rng.integers(100, 180)))]
        texts += [" ".join(edited(rng, base, int(rng.integers(0, 5)))) for _ in range(4)]
        texts.append(" ".join(base + [f"more{k}x{i}" for i in range(int(rng.integers(5, 40)))]))
    want = expected(texts)
    assert members(spark, texts) == want and len(set(want)) > 30
    searched = next(df for df in met if "left" in df.columns)
    assert "print" in searched.columns and searched.select("band").distinct().count() > 1
    assert searched.groupBy("band").agg({"key": "max"}).agg({"max(key)": "max"}).first()[0] > 3
