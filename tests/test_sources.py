"""Documents, CSV extracts, published loads and logs: what is written comes back, and
what is broken is said."""
import datetime
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidyload.operators import mapping as M
from tidyload.plans.mappings import RELABELLED
from tidyload.sources import csv, publish
from tidyload.sources import sinks as K
from tidyload.sources.legacy import legacy_table


def mapping_document(table, n, **more):
    return {"table_source": table, "table_target": table, "migration_complexity": "low", "unknown": [1],
            "mappings": [{"source_col": f"a{i}", "target_col": f"b{i}", "transform": "direct", "confidence": 0.5, "notes": "é\n\"x\""} for i in range(n)]} | more


# -- documents --------------------------------------------------------------------

def test_mapping_documents_of_any_layout(spark, tmp_path):
    for i, n in enumerate((3, 5, 8)):
        (tmp_path / f"t{i}_mapping.json").write_text(json.dumps(mapping_document(f"t{i}", n), indent=2, ensure_ascii=False), encoding="utf-8")
    (tmp_path / "lines.json").write_text("\n".join(json.dumps(mapping_document(f"l{i}", 2)) for i in range(2)) + "\n\n", encoding="utf-8")
    (tmp_path / "list.json").write_text(json.dumps([mapping_document("k0", 4), mapping_document("k1", 1)], indent=1), encoding="utf-8")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "one.json").write_text(json.dumps({"table": "s"} | {k: v for k, v in mapping_document("s", 6).items() if k != "table_source"}), encoding="utf-8")
    rows = M.mapping_rows(M.read_mapping_documents(spark, str(tmp_path)))
    assert {r.table_name: r.n for r in rows.groupBy("table_name").agg(F.count("*").alias("n")).collect()} == {
        "t0": 3, "t1": 5, "t2": 8, "l0": 2, "l1": 2, "k0": 4, "k1": 1, "s": 6}
    assert rows.where("notes != 'é\n\"x\"' or confidence != 0.5 or position >= 8").count() == 0


@pytest.mark.parametrize("broken", [
    '{"table_source": "t", "mappings": [', "no json", '{"table_source": "t"}', '{"other": 1}', "[1, 2]",
    '{"table_source": "t", "mappings": [{"source_col": "a", "target_col": "b", "confidence": "high"}]}',
    '{"table_source": "t", "mappings": []} rest', '{"table_source": "t", "mappings": [{"target_col": "b"}]}'])
def test_broken_documents_fail_by_name(spark, tmp_path, broken):
    (tmp_path / "good.json").write_text(json.dumps(mapping_document("t", 1)))
    (tmp_path / "the_broken_one.json").write_text(broken)
    with pytest.raises(PySparkException, match="the_broken_one.json"):
        M.mapping_rows(M.read_mapping_documents(spark, str(tmp_path))).collect()
    with pytest.raises(PySparkException, match="the_broken_one.json"):
        M.mapping_rows(M.read_mapping_documents(spark, str(tmp_path))).count()


def test_quality_reports(spark, tmp_path):
    for t, score in (("a", 0.25), ("b", 1)):
        (tmp_path / f"{t}_quality.json").write_text(json.dumps({"table": t, "score": score, "approved": score > 0.8, "anomalies": [{"type": "X"}]}, indent=2))
    assert sorted(map(tuple, K.read_quality_reports(spark, str(tmp_path)).collect())) == [("a", 0.25, False), ("b", 1.0, True)]
    assert K.read_quality_reports(spark, str(tmp_path / "none")).collect() == []
    (tmp_path / "c_quality.json").write_text(json.dumps(mapping_document("t", 1)))
    with pytest.raises(PySparkException, match="c_quality.json"):
        K.read_quality_reports(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("indent", [False, True])
def test_written_mappings_give_the_same_projection(spark, tmp_path, indent):
    rows = M.mapping_rows(M.read_mapping_documents(spark))
    K.write_documents(M.documents(rows), str(tmp_path / "m"), indent=indent)
    again = M.mapping_rows(M.read_mapping_documents(spark, str(tmp_path / "m")))
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, rows.collect()), key=str)
    src = legacy_table(spark, SF_SMALL, "suppliers")
    one, two = (M.apply_mapping(src, r, "suppliers", relabelled=RELABELLED.get("suppliers")).collect() for r in (rows, again))
    assert one == two


# -- CSV ----------------------------------------------------------------------------

ODD = [None, "", " ", "  a ", "\t", "a\nb", "a\r\nb", "a\rb", "\n", '"', '""', 'say "x", y', "a,b", "\\N", "\\\\N", "\\", "\\n", "null", "é€😀", "# x", "-", " "]


def test_extract_gives_back_what_was_written(spark, tmp_path):
    when = datetime.datetime(2024, 2, 29, 23, 59, 59, 123456)
    rows = [(i, t, 0.1 * i if i % 3 else None, t, datetime.date(1, 1, 1) if i % 2 else None, when, i % 2 == 0) for i, t in enumerate(ODD)]
    rows += [(None, None, None, None, None, None, None), (2**63 - 1, "x", 5e-324, "y", None, None, None), (-2**63, "x", 1.7976931348623157e308, "y", None, None, None)]
    df = spark.createDataFrame(rows, "a long, `b,c` string, d double, e string, f date, g timestamp, h boolean").withColumn("i", F.expr("cast(a as decimal(38, 10)) / 3"))
    back = K.csv_extract(df.repartition(3), str(tmp_path / "x"))
    assert back.schema.names == df.schema.names and [f.dataType for f in back.schema] == [f.dataType for f in df.schema]
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    empty = K.csv_extract(df.where("false"), str(tmp_path / "none"))
    assert empty.collect() == []
    with pytest.raises(TypeError, match="z"):
        csv.write_extract(df.select(F.array("a").alias("z")), str(tmp_path / "z"))


def test_other_programs_extracts(spark, tmp_path):
    (tmp_path / "x.csv").write_text('id,t,n\r\n1, fr ,2.5\r\n2,"",\r\n3,,1\r\n4,"two\nlines, ""quoted""",0\r\n', newline="")
    got = csv.read_csv(spark, str(tmp_path / "x.csv"), spark.createDataFrame([], "id int, t string, n double").schema)
    assert [tuple(r) for r in got.orderBy("id").collect()] == [(1, " fr ", 2.5), (2, "", None), (3, None, 1.0), (4, 'two\nlines, "quoted"', 0.0)]
    other = spark.createDataFrame([], "id int, u string, n double").schema
    with pytest.raises(Exception, match="header does not conform"):
        csv.read_csv(spark, str(tmp_path / "x.csv"), other).collect()


# -- published loads ----------------------------------------------------------------

def test_readers_see_the_old_or_the_new_load(spark, tmp_path, monkeypatch):
    path, old, new = str(tmp_path / "target"), spark.range(5), spark.range(5, 25)
    assert K.overwrite_load(old, path).count() == 5

    def crash(*args, **options):
        raise KeyboardInterrupt

    real = K.publish
    monkeypatch.setattr(K, "publish", crash)  # the load is written, the process dies
    with pytest.raises(KeyboardInterrupt):
        K.overwrite_load(new, path)
    assert sorted(r.id for r in publish.read_current(spark, path).collect()) == list(range(5))
    monkeypatch.setattr(K, "publish", lambda *a: (real(*a), crash()))  # it dies right after the swap
    with pytest.raises(KeyboardInterrupt):
        K.overwrite_load(new, path)
    assert sorted(r.id for r in publish.read_current(spark, path).collect()) == list(range(5, 25))
    monkeypatch.setattr(K, "publish", real)
    with pytest.raises(K.EmptyLoadError):
        K.overwrite_load(old.where("false"), path)
    assert publish.read_current(spark, path).count() == 20
    seen = publish.read_current(spark, path)  # a reader of before keeps its table through two more loads
    K.overwrite_load(old, path)
    assert seen.count() == 20
    assert len(publish.vacuum(spark, path, keep=1)) == 4 and publish.read_current(spark, path).count() == 5
    with pytest.raises(publish.NoLoadError):
        publish.current(spark, str(tmp_path / "none"))


def test_a_rerun_logs_the_same(spark, tmp_path):
    stats = spark.createDataFrame([("t", 5, 4), ("u", 1, 1)], "table_name string, source_count long, target_count long")
    path = str(tmp_path / "log")
    first = sorted(map(tuple, K.audit_append(stats, path, "a", "2024-01-15 10:00:00").collect()))
    assert sorted(map(tuple, K.audit_append(stats, path, "a", "2024-01-15 10:00:00").collect())) == first and len(first) == 2
    assert K.audit_append(stats.limit(1), path, "b", "2024-01-16 10:00:00").count() == 3
    rows = spark.createDataFrame([("a", "t", i, i if i % 2 else None, "success", None) for i in range(4)],
                                 "migration_run string, table_name string, legacy_id int, target_id long, status string, error_message string")
    path = str(tmp_path / "rows")
    for _ in range(2):
        assert K.log_rows(rows, path).count() == 4
    assert K.log_rows(rows.withColumn("table_name", F.lit("u")), path).count() == 8


def test_samples_are_heaps_of_k_rows(spark):
    """S-5: no task sorts the values of a table; nulls of the order come last, null values never."""
    from tidyload.sources.tables import column_samples
    df = spark.createDataFrame([(i if i % 5 else None, f"a{i}" if i % 3 else None, None, f"c{i}") for i in range(40)], "k int, a string, b string, c string")
    samples = column_samples(df, "k", k=4)
    assert samples._jdf.queryExecution().executedPlan().toString().count("TakeOrderedAndProject") == 3
    got = sorted((r.column_name, r.position, r.value) for r in samples.collect())
    assert got == [(c, i + 1, f"{c}{n}") for c, ns in (("a", (1, 2, 4, 7)), ("c", (1, 2, 3, 4))) for i, n in enumerate(ns)]
