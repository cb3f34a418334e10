"""Loads with history and report, documents as VARIANT, stores kept up in steps."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from conftest import frame, rows
from finfacts.operators.nested import flatten_documents
from finfacts.operators.variants import explode_path, flatten_variants, variant_metadata
from finfacts.operators.aggregates import load_counts
from finfacts.operators.numbering import consecutive
from finfacts.plans import buckets, distinct, filings as P, forms, periods, rewrites, statements as S
from finfacts.plans.catalog import run_sql
from finfacts.schema import DOCUMENT_PARTS, NUM_COLUMNS
from finfacts.sources import loads as L
from finfacts.sources.documents import write_documents
from finfacts.sources.raw import read_raw
from finfacts.sources import sinks
from finfacts.sources.sinks import remove_folder, replace_view
from finfacts.streaming.compaction import compact_landed, landed_table
from finfacts.streaming.landing import ingest_documents
from finfacts.streaming.statements import ingest_statements, ingested_statements


def tsv(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(["\t".join(NUM_COLUMNS), *["\t".join(line) for line in lines]]) + "\n")


def num(tag, value, adsh="f1", uom="USD"):
    return (adsh, tag, "v1", "20191231", "0", uom, "", "", value, "")


@pytest.fixture()
def src(tmp_path):
    root = tmp_path / "src"
    tsv(root / "2020q1" / "num.txt", num("Assets", "1"), num("Assets", "n/a"), num("", "2"), num("Cash", ""))
    tsv(root / "2020q2" / "num.txt", num("Assets", "3"))
    tsv(root / "2020q3" / "num.txt", num("Assets", "x"))
    return root


def values(spark, dst):
    return rows(L.loaded_rows(spark, dst).select("period_folder", "tag", "value"))


def test_a_load_says_what_it_took_and_refused(spark, src, tmp_path):
    dst = str(tmp_path / "dst")
    done = L.load_raw(spark, str(src), "num", dst)
    assert done[1:] == (3, 6, 3, 3)
    assert values(spark, dst) == [("2020q1", "Assets", "1"), ("2020q1", "Cash", None), ("2020q2", "Assets", "3")]
    refused = rows(L.refused_rows(spark, dst).select("period_folder", "tag", "value", "reason"))
    assert refused == [
        ("2020q1", "Assets", "n/a", "value is no decimal(28,4)"), ("2020q1", None, "2", "tag is missing"),
        ("2020q3", "Assets", "x", "value is no decimal(28,4)")]
    report = L.load_report(spark, dst, ["file", "period_folder"]).drop("file")
    assert rows(report) == [
        ("2020q1", 4, 2, 2, "tag is missing", "PARTIALLY_LOADED"), ("2020q2", 1, 1, 0, None, "LOADED"),
        ("2020q3", 1, 0, 1, "value is no decimal(28,4)", "LOAD_FAILED")]
    assert L.load_report(spark, dst).columns[0] == "file"
    loose = L.load_raw(spark, str(src), "num", str(tmp_path / "loose"), types=False)
    assert loose[1:] == (3, 6, 5, 1)


def test_the_load_reads_its_files_in_one_scan(spark, src):
    plan = L.scan_raw(spark, "num", [str(src / "2020q1" / "num.txt")])
    assert plan._jdf.queryExecution().toString().count("FileScan csv") == 1


def test_files_are_taken_once_unless_changed_or_forced(spark, src, tmp_path):
    dst = str(tmp_path / "dst")
    first = L.load_raw(spark, str(src), "num", dst, ["2020q1"])
    assert first.files == 1
    assert L.load_raw(spark, str(src), "num", dst).files == 2
    before = values(spark, dst)
    again = L.load_raw(spark, str(src), "num", dst)
    assert again == (None, 0, 0, 0, 0) and values(spark, dst) == before
    tsv(src / "2020q2" / "num.txt", num("Assets", "4"), num("Assets", "5"))
    changed = L.load_raw(spark, str(src), "num", dst)
    assert changed[1:] == (1, 2, 2, 0)
    after = [("2020q1", "Assets", "1"), ("2020q1", "Cash", None), ("2020q2", "Assets", "4"), ("2020q2", "Assets", "5")]
    assert values(spark, dst) == after
    # The same size at another time is another file too.
    os.utime(src / "2020q1" / "num.txt", (1, 1))
    assert L.load_raw(spark, str(src), "num", dst).files == 1
    assert L.load_raw(spark, str(src), "num", dst, force=True).files == 3
    assert values(spark, dst) == after
    assert L.load_history(spark, dst).count() == 8


def test_a_failed_load_shows_nothing_and_is_made_good(spark, src, tmp_path):
    dst = str(tmp_path / "dst")
    with pytest.raises(Exception, match="refused row in .*2020q1.*value is no decimal"):
        L.load_raw(spark, str(src), "num", dst, ["2020q1"], on_error="abort")
    with pytest.raises(ValueError):
        L.load_raw(spark, str(src), "num", dst, on_error="skip")
    assert L.load_history(spark, dst).isEmpty()
    L.load_raw(spark, str(src), "num", dst, ["2020q2"])
    # Rows of a load that ended before it was noted.
    found = spark.read.parquet(f"{dst}/rows").withColumn("load_id", F.lit("20000101T000000000000-lost"))
    found.withColumn("refused", F.lit(False)).write.mode("append").partitionBy(
        "load_id", "refused", "period_folder").parquet(f"{dst}/rows")
    assert values(spark, dst) == [("2020q2", "Assets", "3")]
    assert L.load_raw(spark, str(src), "num", dst).files == 2
    assert len(values(spark, dst)) == 3


# ---- documents as VARIANT ----------------------------------------------------------


def test_variant_documents_equal_declared_ones(spark, tiny, tmp_path):
    docs = P.filing_documents(tiny)
    write_documents(docs, str(tmp_path / "docs"), "2020q1")
    dst = str(tmp_path / "landed")
    assert L.load_documents(spark, str(tmp_path / "docs"), dst).rows_kept == docs.count()
    landed = L.landed_documents(spark, dst)
    assert dict(landed.dtypes) == {"period_folder": "string", "doc": "variant"}
    flat = flatten_variants(landed, DOCUMENT_PARTS)
    assert "variant_explode" in flat._jdf.queryExecution().toString()
    assert rows(flat.drop("period_folder")) == rows(flatten_documents(docs, DOCUMENT_PARTS).drop("adsh"))
    assert rows(variant_metadata(landed).drop("period_folder")) == rows(P.financial_metadata(tiny))
    assert L.load_documents(spark, str(tmp_path / "docs"), dst).files == 0


def test_odd_fields_leave_the_other_facts_alone(spark, tmp_path):
    folder = tmp_path / "docs" / "2020q1"
    folder.mkdir(parents=True)
    good = {"label": "l", "concept": "c", "info": "i", "unit": "u", "value": 3}
    doc = {"symbol": "A", "year": "x", "startDate": "2020-01-01", "more": [1, {"deep": True}], "data": {
        "bs": [good, good | {"value": "no", "new": 1}, good | {"value": 2.75, "unit": None}, "text", {}, 7],
        "cf": {"label": "no list"}, "ic": None}}
    (folder / "a.json").write_text(json.dumps(doc, indent=1))
    (folder / "b.json").write_text('{"symbol": "B"}')
    (folder / "bad.json").write_text('{"symbol": ')
    (folder / "list.json").write_text("[1, 2]")
    (folder / "empty.json").write_text(" ")
    dst = str(tmp_path / "landed")
    done = L.load_documents(spark, str(tmp_path / "docs"), dst, form="files")
    assert done[1:] == (5, 4, 2, 2)
    assert rows(L.refused_rows(spark, dst).select("value", "reason")) == [
        ('[1, 2]', "no JSON object"), ('{"symbol": ', "no JSON")]
    landed = L.landed_documents(spark, dst)
    assert rows(flatten_variants(landed, DOCUMENT_PARTS).drop("period_folder")) == [
        ("A", "bs", "l", "c", "i", "u", 3), ("A", "bs", "l", "c", "i", "u", None), ("A", "bs", "l", "c", "i", None, 2)]
    exact = flatten_variants(landed, ["bs"], exact=True)
    assert [str(r.value) for r in exact.filter("unit IS NULL").collect()] == ["2.7500"]
    assert rows(variant_metadata(landed).select("symbol", "year", F.col("startDate").cast("string"))) == [
        ("A", None, "2020-01-01"), ("B", None, None)]
    assert rows(explode_path(landed, "more", {"deep": ("deep", "boolean")})) == [("2020q1", True)]


# ---- stores kept up in steps --------------------------------------------------------


def test_a_replaced_view_never_lacks_its_rows(spark, tmp_path):
    root = str(tmp_path / "versions")
    old = replace_view(frame(spark, "a b", ("1", "x")), "replaced", root)
    reader = spark.table("replaced")
    failing = frame(spark, "a b", ("1", "x")).select(F.raise_error(F.lit("midway")).alias("a"))
    with pytest.raises(Exception, match="midway"):
        replace_view(failing, "replaced", root)
    assert rows(spark.table("replaced")) == [("1", "x")]
    replace_view(spark.table("replaced").select("a", F.lit("y").alias("c")), "replaced", root)
    assert rows(spark.table("replaced")) == [("1", "y")] and spark.table("replaced").columns == ["a", "c"]
    assert rows(reader) == [("1", "x")]
    assert remove_folder(spark, old) and not remove_folder(spark, old)
    spark.sql("DROP VIEW replaced")


def of_period(tables, filings):
    kept = F.col("adsh").isin(*filings)
    return {**tables, **{n: tables[n].filter(kept) for n in ("sub", "num", "pre")}}


def test_metrics_of_two_periods_equal_one_full_build(spark, tiny, tmp_path):
    raw = {}
    for period, filings in (("2020q1", ["f1", "f3"]), ("2020q2", ["f2", "f4", "f5", "f9", "gone"])):
        for name in ("sub", "num", "tag"):
            own = of_period(tiny, filings)[name] if name != "tag" else tiny["tag"].filter(
                F.col("tag") != ("Assets" if period == "2020q1" else "Revenues"))
            own.write.parquet(str(tmp_path / period / name))
        raw[period] = {n: spark.read.parquet(str(tmp_path / period / n)) for n in ("sub", "num", "tag")}
    store = str(tmp_path / "store")
    periods.add_period(raw["2020q1"], store, "2020q1")
    first = rows(periods.company_metrics_of_periods(spark, store))
    # The dictionary of the first period lacks a tag that the second one brings.
    assert first == rows(S.company_metrics(raw["2020q1"]))
    files = periods.period_maxima(raw["2020q2"]).inputFiles()
    assert files and all("2020q2" in f for f in files)
    periods.add_period(raw["2020q2"], store, "2020q2")
    merged = periods.company_metrics_of_periods(spark, store)
    assert all(f"{store}/" in f for f in merged.inputFiles())
    whole = {n: raw["2020q1"][n].unionByName(raw["2020q2"][n]) for n in ("sub", "num", "tag")}
    assert rows(merged) == rows(S.company_metrics(whole)) != first
    periods.add_period(raw["2020q2"], store, "2020q2")
    assert rows(periods.company_metrics_of_periods(spark, store)) == rows(merged)


def test_values_bucketed_by_filing_are_not_shuffled(spark, tiny, tmp_path):
    buckets.store_by_filing(tiny, "tiny_", str(tmp_path / "buckets"), 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stored = buckets.tables_by_filing(spark, "tiny_", tuple(tiny))
        data = P.financial_data(stored)
        assert rows(data) == rows(P.financial_data(tiny))
        tree = data._jdf.queryExecution().executedPlan().toString()
        lines = tree[:tree.find("== Initial Plan ==")].split("\n") if "== Initial Plan ==" in tree else tree.split("\n")
        scan = next(i for i, line in enumerate(lines) if "tiny_num" in line and "FileScan" in line)
        depth = lambda line: len(line) - len(line.lstrip(" :+-*|"))
        above, at = [], depth(lines[scan])
        for line in reversed(lines[:scan]):
            if depth(line) < at:
                above.append(line)
                at = depth(line)
        assert not any("Exchange" in line for line in above), tree
        assert rows(flatten_documents(P.filing_documents(stored))) == rows(flatten_documents(P.filing_documents(tiny)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.requireAllClusterKeysForCoPartition")
        for name in tiny:
            spark.sql(f"DROP TABLE tiny_{name}")


def test_reading_by_filing_leaves_the_session_as_it_is(spark, tiny, tmp_path):
    """Later joins of plain tables are still dealt out by all keys; settings of the session reach the stored tables."""
    key, given = "spark.sql.requireAllClusterKeysForCoPartition", "spark.sql.autoBroadcastJoinThreshold"
    buckets.store_by_filing(tiny, "kept_", str(tmp_path / "kept"), 2)
    spark.conf.set(given, "-1")
    try:
        before = spark.conf.get(key)
        stored = buckets.tables_by_filing(spark, "kept_", tuple(tiny))
        assert spark.conf.get(key) == before == "true"
        own = stored["num"].sparkSession.conf
        assert own.get(key) == "false" and own.get(given) == "-1"
        assert own.get("spark.checkpoint.dir") == spark.conf.get("spark.checkpoint.dir")
        assert rows(P.financial_data(stored)) == rows(P.financial_data(tiny))
        assert run_sql(spark, stored, "SELECT count(*) AS n FROM num").first().n == tiny["num"].count()
    finally:
        spark.conf.unset(given)
        spark.conf.unset(key)
        for name in tiny:
            spark.sql(f"DROP TABLE kept_{name}")


def test_only_changed_documents_are_written_again(spark, tiny, tmp_path):
    store = str(tmp_path / "store")
    read = lambda: rows(flatten_documents(rewrites.current_documents(spark, store), DOCUMENT_PARTS))
    want = lambda tables: rows(flatten_documents(P.filing_documents(tables), DOCUMENT_PARTS))
    assert rewrites.update_documents(tiny, store) == 3
    assert read() == want(tiny)
    shuffled = {**tiny, "num": tiny["num"].orderBy(F.rand(1)), "pre": tiny["pre"].orderBy(F.rand(2))}
    assert rewrites.update_documents(shuffled, store) == 0
    value = F.when((F.col("adsh") == "f1") & (F.col("tag") == "Liabilities"), "-4").otherwise(F.col("value"))
    changed = {**tiny, "num": tiny["num"].withColumn("value", value)}
    assert rewrites.update_documents(changed, store) == 1
    assert read() == want(changed) != want(tiny)
    fewer = {**changed, "sub": changed["sub"].filter("adsh <> 'f1'")}
    assert rewrites.update_documents(fewer, store) == 0
    assert read() == want(fewer)
    copied = {**changed, "num": changed["num"].union(changed["num"].filter("adsh = 'f1' AND tag = 'Assets'"))}
    assert rewrites.update_documents(copied, store) == 1
    assert read() == want(copied)
    texts = {**copied, "tag": copied["tag"].withColumn("doc", F.concat("doc", F.lit("!")))}
    assert rewrites.update_documents(texts, store) >= 1
    assert read() == want(texts)


def test_an_update_leaves_no_shuffle_files(spark, tiny, tmp_path):
    before, store = shuffle_files(spark), str(tmp_path / "store")
    assert rewrites.update_documents(tiny, store) == 3
    assert not left_behind(spark, before)
    want = rows(flatten_documents(P.filing_documents(tiny), DOCUMENT_PARTS))
    assert rows(flatten_documents(rewrites.current_documents(spark, store), DOCUMENT_PARTS)) == want


def test_tables_of_some_filings_give_the_same_documents(spark, tiny, monkeypatch):
    wanted = frame(spark, "adsh", ("f1",), ("gone",))
    want = rows(flatten_documents(P.filing_documents(tiny).filter("adsh = 'f1'"), DOCUMENT_PARTS))
    few = rewrites._some_filings(tiny, wanted)
    assert few["num"].select("adsh").distinct().count() == 2 and rows(
        flatten_documents(P.filing_documents(few), DOCUMENT_PARTS)) == want
    monkeypatch.setattr(rewrites, "fits_broadcast", lambda df: False)
    many = rewrites._some_filings(tiny, wanted)
    assert many["num"] is tiny["num"] and many["sub"].count() == 1
    assert rows(flatten_documents(P.filing_documents(many), DOCUMENT_PARTS)) == want


def test_streamed_statements_are_distinct_over_batches(spark, tiny, tmp_path):
    src, dst, seen = tmp_path / "src", str(tmp_path / "dst"), str(tmp_path / "checkpoint")
    given = [[x or "" for x in r] for r in tiny["num"].collect()]
    line = lambda r: (*r[:6], "", "", r[6], "")
    static = {k: tiny[k] for k in ("sub", "tag")}
    tsv(src / "2020q1" / "num.txt", *map(line, given[:7]))
    ingest_statements(spark, str(src), static, dst, seen)
    tables = lambda: {**tiny, "num": read_raw(spark, str(src), "num", on_error="skip")}
    assert rows(ingested_statements(spark, dst)) == rows(S.staging(tables()))
    # Repeated rows in a later batch add nothing; a second run begins where the first ended.
    tsv(src / "2020q2" / "num.txt", *map(line, given[:3]), *map(line, given[7:]))
    tsv(src / "2020q3" / "num.txt", *map(line, given[2:]))
    ingest_statements(spark, str(src), static, dst, seen, files_per_batch=1)
    whole = rows(ingested_statements(spark, dst))
    assert whole == rows(S.staging(tables())) == rows(S.staging(tiny))
    ingest_statements(spark, str(src), static, dst, seen)
    assert rows(ingested_statements(spark, dst)) == whole


def test_numbers_are_consecutive_over_parts(spark):
    given = spark.range(0, 500, 1, 7).select(((F.col("id") * 37) % 250).cast("string").alias("s"), "id")
    found = consecutive(given, ["s", "id"], "n", first=5).collect()
    assert [(r.s, r.id) for r in sorted(found, key=lambda r: r.n)] == sorted((r.s, r.id) for r in found)
    assert sorted(r.n for r in found) == list(range(5, 505))
    assert consecutive(given.limit(0), ["s"], "n").isEmpty()


def test_counts_of_periods_merge_exactly(spark, tiny, tmp_path):
    symbols = spark.range(40_000).select(F.concat(F.lit("s"), F.col("id") % 36_000).alias("symbol"))
    parts = [{"Metadata Count": symbols.limit(n), "Financial Data Count": data} for n, data in (
        (36_000, P.financial_data(tiny)), (40_000, P.financial_data(tiny).limit(2)),
        (0, frame(spark, "symbol", (None,), ("s1",), ("new",))))]
    store = str(tmp_path / "store")
    merged = lambda: rows(distinct.load_counts_of_periods(spark, store))
    for i, part in enumerate(parts):
        for title, df in part.items():
            df.select("symbol").write.parquet(str(tmp_path / f"part{i}" / title.split()[0]))
        own = {t: spark.read.parquet(str(tmp_path / f"part{i}" / t.split()[0])) for t in part}
        distinct.add_counts(own, store, f"2020q{i + 1}")
        whole = lambda t: spark.read.parquet(*[str(tmp_path / f"part{k}" / t) for k in range(i + 1)])
        assert merged() == rows(load_counts(whole("Metadata"), whole("Financial")))
    before = merged()
    distinct.add_counts(own, store, "2020q3")
    assert merged() == before
    assert all(f"{store}/" in f for f in distinct.load_counts_of_periods(spark, store).inputFiles())


def test_merged_batches_have_the_same_rows_in_fewer_files(spark, tiny, tmp_path):
    src, dst, seen = (str(tmp_path / n) for n in ("src", "dst", "checkpoint"))
    docs, name = P.filing_documents(tiny), "financial_data"
    one = lambda n: docs.limit(1).drop("adsh").coalesce(1).write.mode("append").json(f"{src}/period_folder={n}")
    read = lambda: rows(landed_table(spark, dst, name).select("period_folder", "ingest_batch", "concept", "value"))
    for n in ("2020q1", "2020q1", "2020q2", "2020q1"):
        one(n)
        ingest_documents(spark, src, dst, seen)
    before = read()
    assert len({r[1] for r in before}) == 4
    files = lambda: landed_table(spark, dst, name).filter("period_folder = '2020q1'").select(
        F.input_file_name()).distinct().count()
    many, reader = files(), landed_table(spark, dst, name)
    assert compact_landed(spark, dst, name) == 2
    assert read() == before == rows(reader.select("period_folder", "ingest_batch", "concept", "value")) and files() < many
    assert compact_landed(spark, dst, name) is None
    # The last batch may still be repeated: it replaces its own rows.
    tail = spark.read.parquet(f"{dst}/{name}").filter("ingest_batch = 3").cache()
    tail.count()
    tail.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "period_folder", "ingest_batch").parquet(f"{dst}/{name}")
    assert read() == before
    # A merge that was cut short before its note shows nothing.
    tail.write.parquet(f"{dst}/{name}_merged/99")
    assert read() == before
    one("2020q3")
    ingest_documents(spark, src, dst, seen)
    grown = read()
    assert compact_landed(spark, dst, name) == 3 and read() == grown
    # Batches that the note before covered are gone, those behind it are there.
    assert {r[0] for r in spark.read.parquet(f"{dst}/{name}").select("ingest_batch").distinct().collect()} == {3, 4}
    one("2020q1")
    ingest_documents(spark, src, dst, seen)
    assert len(read()) == len(grown) + len([r for r in before if r[1] == 0])


def test_state_of_streamed_statements_lies_on_disk(spark, tiny, tmp_path):
    """Older checkpoints go on with the state they were begun with; the session stays as it is."""
    key, heap = "spark.sql.streaming.stateStore.providerClass", "HDFSBackedStateStoreProvider"
    package = "org.apache.spark.sql.execution.streaming.state."
    given = [[x or "" for x in r] for r in tiny["num"].collect()]
    static, src = {k: tiny[k] for k in ("sub", "tag")}, tmp_path / "src"
    provider = lambda name, batch: json.loads(
        (tmp_path / name / "offsets" / str(batch)).read_text().splitlines()[1])["conf"][key]
    run = lambda name: ingest_statements(spark, str(src), static, f"{tmp_path}/{name}_rows", f"{tmp_path}/{name}")
    before = spark.conf.get(key, None)
    tsv(src / "2020q1" / "num.txt", *[(*r[:6], "", "", r[6], "") for r in given[:7]])
    run("new")
    assert provider("new", 0).endswith("RocksDBStateStoreProvider") and spark.conf.get(key, None) == before
    spark.conf.set(key, package + heap)
    try:
        run("old")
        assert spark.conf.get(key) == package + heap
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
    tsv(src / "2020q2" / "num.txt", *[(*r[:6], "", "", r[6], "") for r in given[2:]])
    run("new"), run("old")
    assert provider("old", 0).endswith(heap) and provider("old", 1).endswith(heap)
    for name in ("new", "old"):
        assert rows(ingested_statements(spark, f"{tmp_path}/{name}_rows")) == rows(S.staging(tiny))


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {n for n in names if n.startswith("shuffle_")}


def left_behind(spark, before):
    """Shuffle files that are there since ``before`` and do not go within some seconds."""
    for _ in range(50):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    return left


def test_a_stored_model_leaves_no_shuffle_files(spark, tiny, tmp_path):
    key, before = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", shuffle_files(spark)
    given = spark.conf.get(key, None)
    stored = forms.store_normalized(tiny, str(tmp_path))
    assert not left_behind(spark, before)
    assert spark.conf.get(key, None) == given
    assert rows(stored["stg_balance_sheet"]) == rows(S.stg_balance_sheet(tiny))
    with pytest.raises(ZeroDivisionError), sinks.shuffles_freed(spark):
        1 / 0
    assert spark.conf.get(key, None) == given


def test_scratch_folders_go_when_told(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "_SCRATCH", [])
    path = sinks.scratch_folder(spark)
    spark.range(3).write.parquet(path)
    sinks.scratch_folder(spark)
    assert sinks.remove_scratch(spark) == 1 and sinks.remove_scratch(spark) == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
