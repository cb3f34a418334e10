"""The pipeline on small tables: columns, whole results and order of the stages."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from finfacts.llm import grade_classifier as G, quality_rules as Q
from tests.llm.test_shingle_sets import plain_jaccard, plain_set
from tests.llm.test_texts import key, plain_components, plain_figures
from tests.llm.test_tokens import check_bins

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, ids = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        kept = {r.doc_id for r in docs.select("doc_id").collect()}
        assert docs.columns == columns and kept <= ids, name
        ids = kept
    assert len(ids) > 50
    packed = pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == ids


def test_run_is_repeatable_and_takes_empty_tables(spark, tmp_path):
    first, second = (sorted(r[:5] for r in pipeline.run(spark, SF).collect()) for _ in range(2))
    assert first == second
    for name in ("documents", "labels"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert pipeline.run(spark, str(tmp_path)).count() == 0


def test_many_copies_leave_one_whole(spark):
    """A document with more copies than the limit of lines survives line and near dedup once."""
    text = "\n".join(" ".join(f"w{i * 31 + j}" for j in range(12)) for i in range(6))
    given = [(i, text, "en", "s", len(text)) for i in range(3, 18)]
    docs = spark.createDataFrame(given, "doc_id long, text string, lang string, source string, n_chars long")
    lines = pipeline.drop_lines(spark, docs, SF)
    assert lines.count() == 15
    kept = pipeline.drop_near_copies(spark, lines, SF)
    assert [r.doc_id for r in kept.filter("text <> ''").collect()] == [3]


def plain_classify(docs, model):
    def top(text):
        score = sum(model.weights[p] * v for p, v in zip(*G.features(text.encode())))
        return round(1 / (1 + np.exp(model.thresholds[-1] - score)), 9)
    return {i: (t, s) for i, (t, s) in docs.items() if top(t) >= G.KEEP_PROBABILITY}


def plain_rules(docs):
    normal = lambda x: " ".join(x.lower().translate(str.maketrans("123456789", "000000000")).split(" ")).split()
    counts = Counter((s, " ".join(k)) for s, t in {(s, t) for t, s in docs.values()}
                     for k in {tuple(normal(x)) for x in t.split("\n")} if k)
    out = {}
    for i, (t, s) in docs.items():
        n, _, _, _, repeats = plain_figures(t)
        common = [x for x in t.split("\n") if counts[s, " ".join(normal(x))] > Q.MAX_DOCS]
        left = n - sum(len(x.split()) for x in common)
        if n >= 20 and 100 * repeats <= 30 * n and 100 * left >= Q.MIN_KEPT_PERCENT * n:
            out[i] = "\n".join(x for x in t.split("\n") if x not in common)
    return out


def plain_first_lines(docs, least):
    counts = Counter(k for t in docs.values() for k in {key(x) for x in t.split("\n")} if k)
    seen, out = set(), {}
    for i in sorted(docs):
        stay = []
        for line in docs[i].split("\n"):
            k = key(line)
            if counts[k] < least or k not in seen:
                stay.append(line)
            if counts[k] >= least:
                seen.add(k)
        out[i] = "\n".join(stay)
    return out


def plain_near(docs):
    ids = sorted(docs)
    sets = [plain_set(docs[i].lower()) for i in ids]
    groups = plain_components(sets, lambda a, b: a == b or bool(a and b) and plain_jaccard(a, b) >= 0.8)
    return {ids[g]: docs[ids[g]] for g in set(groups)}


def test_run_equals_a_plain_version(spark):
    given = spark.read.parquet(f"{SF}/documents.parquet")
    model = G.fit_documents(given, G.graded(spark.read.parquet(f"{SF}/labels.parquet")))
    docs = {r.doc_id: (r.text or "", r.source) for r in given.collect()}
    want = [plain_classify(docs, model)]
    want.append(plain_rules(want[0]))
    want.append(plain_first_lines(want[1], 2))
    want.append(plain_near(want[2]))
    assert len(docs) >= len(want[0]) >= len(want[1]) > len(want[3]) > 50
    assert want[1] != want[2]
    stage_docs = given
    for (name, stage), plain in zip(pipeline.STAGES, want):
        stage_docs = stage(spark, stage_docs, SF).cache()
        got = {r.doc_id: r.text for r in stage_docs.collect()}
        assert got == {i: t[0] if isinstance(t, tuple) else t for i, t in plain.items()}, name
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.encode_special_tokens = True
    pieces = Counter()
    for i, t in want[3].items():
        own = library.encode(t, add_special_tokens=False).ids + [1]
        for n, at in enumerate(range(0, len(own), 4096)):
            part = np.array(own[at:at + 4096], "<u4")
            pieces[i, n, at, len(part), zlib.crc32(part.tobytes())] += 1
    packed = pipeline.run(spark, SF).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == pieces
    assert check_bins(packed) == -(-sum(r.length for r in packed) // 4096)
