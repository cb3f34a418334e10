import json
import zipfile

import pytest
from pyspark.sql import functions as F

from conftest import frame, rows
from finfacts.plans import filings as P, forms
from finfacts.schema import NUM_COLUMNS, SUB_COLUMNS, TAG_COLUMNS
from finfacts.sources.archives import unpack_archives
from finfacts.sources.documents import read_documents, write_documents
from finfacts.sources.manifest import is_staged, missing_periods, staged_manifest
from finfacts.sources.raw import read_raw, read_tables, read_tickers, typed
from finfacts.sources.sinks import save_model, scratch_folder


def tsv(path, columns, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(["\t".join(columns), *["\t".join(line) for line in lines]]) + "\n")


@pytest.fixture()
def staged(tmp_path):
    num = lambda tag, value: ("f1", tag, "v1", "20191231", "0", "USD", "", "", value, "")
    tsv(tmp_path / "2020q1" / "num.txt", NUM_COLUMNS,
        num(" Assets ", "100.5"), num('"Quoted ""tag"""', "n/a"),
        ("f1", "Short", "v1", "20191231", "0", "USD"), (*num("Long", "7"), "extra", "more"))
    tsv(tmp_path / "2020q2" / "num.txt", NUM_COLUMNS, num("Assets", "9"))
    sub = dict.fromkeys(SUB_COLUMNS, "") | {
        "adsh": "f1", "cik": "c1", "name": "One", "period": "20200101", "fy": "2020", "fp": "FY"}
    tag = dict.fromkeys(TAG_COLUMNS, "") | {
        "tag": "Assets", "version": "v1", "custom": "0", "abstract": "0", "tlabel": "Total", "datatype": "monetary"}
    for period in ("2020q1", "2020q2"):
        tsv(tmp_path / period / "sub.txt", SUB_COLUMNS, tuple(sub.values()))
        tsv(tmp_path / period / "tag.txt", TAG_COLUMNS, tuple(tag.values()))
        tsv(tmp_path / period / "pre.txt", ("adsh",), ("f1",))
    return tmp_path


def test_raw_scan_trims_quotes_and_tolerates_width(spark, staged):
    got = read_raw(spark, str(staged), "num", ["2020q1"]).select("tag", "value", "segments", "period_folder")
    assert rows(got) == [
        ("Assets", "100.5", None, "2020q1"), ("Long", "7", None, "2020q1"),
        ('Quoted "tag"', "n/a", None, "2020q1"), ("Short", None, None, "2020q1")]


def test_raw_scan_reads_only_the_wanted_periods(spark, staged):
    assert read_raw(spark, str(staged), "num").count() == 5
    only = read_raw(spark, str(staged), "num", ["2020q2"])
    assert [f.split("/")[-2] for f in only.inputFiles()] == ["2020q2"]


def test_error_policy_of_required_columns(spark, staged):
    tsv(staged / "2020q3" / "num.txt", NUM_COLUMNS,
        ("f1", "", "v1", "20191231", "0", "USD", "", "", "1", ""),
        ("f1", "Assets", "v1", "20191231", "0", "USD", "", "", "1", ""))
    assert read_raw(spark, str(staged), "num", ["2020q3"], on_error="skip").count() == 1
    with pytest.raises(Exception, match="required column"):
        read_raw(spark, str(staged), "num", ["2020q3"]).count()
    with pytest.raises(ValueError):
        read_raw(spark, str(staged), "num", ["2020q3"], on_error="ignore")


def test_typed_projection_and_its_error_policy(spark, staged):
    raw = read_raw(spark, str(staged), "num", ["2020q1"])
    df = typed(raw, "num")
    assert dict(df.dtypes)["value"] == "decimal(28,4)" and dict(df.dtypes)["ddate"] == "date"
    assert df.filter("value IS NULL").count() == 2
    assert typed(raw, "num", on_error="skip").count() == 3
    with pytest.raises(Exception, match="does not fit its type"):
        typed(raw, "num", on_error="abort").collect()


def test_tickers_keep_the_file_order(spark, tmp_path):
    (tmp_path / "ticker.txt").write_text("aapl\t1\nzz\t2\nab\t2\n")
    from finfacts.operators.joins import lookup_symbol

    assert rows(lookup_symbol(read_tickers(spark, str(tmp_path / "ticker.txt")))) == [("1", "aapl"), ("2", "zz")]


def archive(path, source, period):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.mkdir("notes") if hasattr(z, "mkdir") else None
        for file in sorted((source / period).iterdir()):
            z.write(file, file.name)


def test_unpacked_archives_equal_the_staged_files(spark, staged, tmp_path, monkeypatch):
    monkeypatch.setattr("finfacts.sources.archives.LINES_PER_CHUNK", 2)
    src, dst = tmp_path / "zips", tmp_path / "unpacked"
    src.mkdir()
    for period in ("2020q1", "2020q2"):
        archive(src / f"{period}.zip", staged, period)
    unpack_archives(spark, str(src), str(dst))
    for table in ("num", "sub", "tag", "pre"):
        assert rows(read_raw(spark, str(dst), table, unpacked=True)) == rows(read_raw(spark, str(staged), table))
    unpack_archives(spark, str(src / "2020q1.zip"), str(dst))
    assert read_raw(spark, str(dst), "num", unpacked=True).count() == 5


def test_broken_archive_is_an_error(spark, tmp_path):
    (tmp_path / "2020q1.zip").write_bytes(b"no archive")
    with pytest.raises(Exception, match="invalid archive"):
        unpack_archives(spark, str(tmp_path), str(tmp_path / "out"))


def test_manifest_and_backfill(spark, staged):
    (staged / "2019q4.zip").write_bytes(b"zip")
    manifest = staged_manifest(spark, str(staged))
    got = {r["period_folder"]: r for r in manifest.collect()}
    assert got["2020q1"]["files"] == 4 and got["2020q1"]["archive"] is None
    assert got["2019q4"]["archive"].endswith("2019q4.zip") and got["2019q4"]["bytes"] == 3
    assert is_staged(manifest, "2018q1").isEmpty() and not is_staged(manifest, "2020q2").isEmpty()
    missing = missing_periods(spark, manifest, last=2020, first=2019)
    assert [r[0] for r in missing.select("period_folder").orderBy("period_folder").collect()] == [
        "2019q1", "2019q2", "2019q3", "2020q3", "2020q4"]


def test_document_files(spark, tmp_path):
    folder = tmp_path / "2020q1"
    folder.mkdir()
    fact = {"label": "l", "concept": "c", "info": "i", "unit": "u", "value": 3}
    good = {"startDate": "2020-01-01", "endDate": "2020-12-31", "year": 2020, "quarter": "FY",
            "symbol": "A", "name": "N", "country": None, "city": "X", "data": {"bs": [fact], "cf": [fact], "ic": []}}
    (folder / "a.json").write_text(json.dumps(good, indent=1))
    (folder / "b.json").write_text(json.dumps(good | {"symbol": "B", "data": {"bs": [], "cf": [], "ic": []}}))
    (folder / "bad.json").write_text('{"symbol": "C", ')
    (folder / "type.json").write_text(json.dumps(good | {"year": "x"}))
    (folder / "array.json").write_text(json.dumps([good]))
    (folder / "utf8.json").write_bytes(json.dumps(good | {"symbol": "U", "name": "N?"}).encode().replace(b"N?", b"N\xff"))
    (folder / "note.txt").write_text("no document")
    docs = read_documents(spark, str(tmp_path), form="files")
    meta, data = P.document_tables(docs)
    assert rows(meta.select("symbol", "name", "country")) == [("A", "N", None), ("B", "N", None), ("U", "N�", None)]
    assert rows(data.select("symbol", "data_type", "value")) == [
        ("A", "bs", 3.0), ("A", "cf", 3.0), ("U", "bs", 3.0), ("U", "cf", 3.0)]
    assert rows(docs.select("period_folder").distinct()) == [("2020q1",)]
    with pytest.raises(Exception, match="declared schema"):
        read_documents(spark, str(tmp_path), form="files", on_error="abort").collect()


def test_document_round_trip(spark, tiny, tmp_path):
    docs = P.filing_documents(tiny)
    write_documents(docs, str(tmp_path / "docs"), "2020q1")
    back = read_documents(spark, str(tmp_path / "docs"), ["2020q1"])
    assert back.count() == docs.count() == 3
    meta, data = P.document_tables(back)
    assert rows(data) == rows(P.financial_data(tiny))
    assert rows(meta) == rows(P.financial_metadata(tiny))
    text = (spark.read.text(str(tmp_path / "docs")).filter("value LIKE '%\"TWO\"%'")).first()["value"]
    assert '"country":null' in text
    exact = P.filing_documents(tiny, exact=True)
    write_documents(exact, str(tmp_path / "exact"), "2020q1")
    values = P.document_tables(read_documents(spark, str(tmp_path / "exact"), exact=True))[1]
    assert rows(values) == rows(P.financial_data(tiny, exact=True))


def test_saved_models(spark, tmp_path):
    path = str(tmp_path / "model")
    one = frame(spark, "period_folder v", ("2020q1", "a"), ("2020q2", "b"))
    save_model(one, path, partition_by=["period_folder"])
    save_model(frame(spark, "period_folder v", ("2020q2", "c")), path, partition_by=["period_folder"])
    read = lambda: rows(spark.read.parquet(path).select(F.col("period_folder").cast("string"), "v"))
    assert read() == [("2020q1", "a"), ("2020q2", "c")]
    save_model(frame(spark, "period_folder v", ("2020q3", "d")), path, partition_by=["period_folder"], mode="replace")
    assert read() == [("2020q3", "d")]
    save_model(one, "model_view", materialized="view")
    assert spark.table("model_view").count() == 2
    with pytest.raises(ValueError):
        save_model(one, path, materialized="index")


def test_scratch_folder_is_in_the_shared_place(spark):
    first, second = scratch_folder(spark), scratch_folder(spark)
    assert first != second and first.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_storage_forms(spark, staged, tiny, tmp_path):
    assert forms.period_folder(2020, "Q1") == "2020q1"
    for year, quarter in ((1999, "Q1"), (2020, "q1")):
        with pytest.raises(ValueError):
            forms.period_folder(year, quarter)
    raw = forms.load_form(spark, "raw", str(staged), ["2020q1"])
    assert set(raw) == {"sub", "num", "tag", "pre"}
    marts = forms.load_form(spark, "NORMALIZED", str(staged), ["2020q2"])
    assert marts["company_metrics"].first()["total_assets"] == 9
    assert marts["fct_financial_statements"].count() == 1
    write_documents(P.filing_documents(tiny), str(tmp_path / "docs"), "2020q1")
    docs = forms.load_form(spark, "JSON", str(tmp_path / "docs"))
    assert docs["financial_metadata"].count() == 3 and "id" in docs["financial_data"].columns
    with pytest.raises(ValueError):
        forms.load_form(spark, "CSV", str(staged))


def test_staging_a_period_on_request(spark, staged, tmp_path):
    zips, target = tmp_path / "zips", tmp_path / "target"
    zips.mkdir(), target.mkdir()
    archive(zips / "2020q1.zip", staged, "2020q1")
    assert forms.stage_period(spark, str(zips), str(target), "2020q1")
    assert not forms.stage_period(spark, str(zips), str(target), "2020q1")
    assert read_tables(spark, str(target), ["2020q1"], unpacked=True)["num"].count() == 4
    with pytest.raises(FileNotFoundError):
        forms.stage_period(spark, str(zips), str(target), "2020q2")
