import pytest

from conftest import frame, rows
from finfacts.plans import filings as P
from finfacts.sources.documents import write_documents
from finfacts.streaming.landing import ingest_documents


def landed(spark, dst):
    data = spark.read.parquet(f"{dst}/financial_data")
    return data.select("symbol", "data_type", "concept", "info", "unit", "value")


def test_each_document_is_loaded_once(spark, tiny, tmp_path):
    src, dst, seen = (str(tmp_path / n) for n in ("src", "dst", "checkpoint"))
    docs = P.filing_documents(tiny)
    expected = rows(P.financial_data(tiny))
    write_documents(docs, src, "2020q1")
    ingest_documents(spark, src, dst, seen)
    assert rows(landed(spark, dst)) == expected
    ingest_documents(spark, src, dst, seen)
    assert rows(landed(spark, dst)) == expected
    write_documents(docs, src, "2020q2")
    ingest_documents(spark, src, dst, seen, files_per_batch=1)
    assert rows(landed(spark, dst)) == sorted(expected * 2, key=repr)
    meta = spark.read.parquet(f"{dst}/financial_metadata")
    assert rows(meta.groupBy("period_folder").count()) == [("2020q1", 3), ("2020q2", 3)]


def test_late_files_of_a_period_are_added(spark, tiny, tmp_path):
    src, dst, seen = (str(tmp_path / n) for n in ("src", "dst", "checkpoint"))
    docs = P.filing_documents(tiny)
    write_documents(docs.filter("adsh = 'f1'"), src, "2020q1")
    ingest_documents(spark, src, dst, seen)
    before = landed(spark, dst).count()
    docs.filter("adsh = 'f1'").drop("adsh").write.mode("append").json(f"{src}/period_folder=2020q1")
    ingest_documents(spark, src, dst, seen)
    assert landed(spark, dst).count() == 2 * before


def test_another_checkpoint_on_the_same_target_is_an_error(spark, tiny, tmp_path):
    src, dst = str(tmp_path / "src"), str(tmp_path / "dst")
    write_documents(P.filing_documents(tiny), src, "2020q1")
    ingest_documents(spark, src, dst, str(tmp_path / "one"))
    before = rows(landed(spark, dst))
    with pytest.raises(ValueError, match="filled by the checkpoint"):
        ingest_documents(spark, src, dst, str(tmp_path / "two"))
    assert rows(landed(spark, dst)) == before


def test_an_empty_mark_claims_nothing(spark, tiny, tmp_path):
    src, dst = str(tmp_path / "src"), str(tmp_path / "dst")
    write_documents(P.filing_documents(tiny), src, "2020q1")
    (tmp_path / "dst" / "landed_by").mkdir(parents=True)
    ingest_documents(spark, src, dst, str(tmp_path / "one"))
    assert not landed(spark, dst).isEmpty()
    with pytest.raises(ValueError, match="filled by the checkpoint"):
        ingest_documents(spark, src, dst, str(tmp_path / "two"))


def test_one_file_per_document(spark, tmp_path):
    folder = tmp_path / "src" / "2020q1"
    folder.mkdir(parents=True)
    (folder / "a.json").write_text(
        '{\n "symbol": "A", "data": {"bs": [{"concept": "c",\n "value": 1}], "cf": [], "ic": []}}')
    (folder / "bad.json").write_text('{"symbol": ')
    dst = str(tmp_path / "dst")
    ingest_documents(spark, str(tmp_path / "src"), dst, str(tmp_path / "seen"), form="files")
    assert rows(landed(spark, dst)) == [("A", "bs", "c", None, None, 1.0)]
