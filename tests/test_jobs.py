"""The two jobs on copies of the tables: growth, reruns, recovery, odd rows, command lines."""

from __future__ import annotations

import json
import shutil
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from jobs import association_report, cohort_intake, registered

SF = "/root/testdata/sf0.001"


def files(folder: Path, pattern: str = "**/*.parquet") -> dict[str, int]:
    return {str(p.relative_to(folder)): p.stat().st_mtime_ns for p in sorted(folder.glob(pattern))}


def matrix(spark, out):
    return sorted(tuple(r) for r in cohort_intake.result(spark, str(out)).withColumns({c: F.round(c, 9) for c in ("value", "logcpm")}).collect())


@pytest.fixture
def parts(spark, tmp_path):
    """Line items dealt into three files by supplier, and the odd rows of a fourth."""
    rows = spark.read.parquet(f"{SF}/lineitem.parquet")
    for i in range(3):
        rows.where(F.col("l_suppkey") % 3 == i).coalesce(1).write.parquet(str(tmp_path / f"made{i}"))
    odd = spark.createDataFrame([(1, 1, None, 1.0), (1, None, 2, 1.0), (1, 1, 2, None), (1, 1, 2, -5.0), (1, 1, 2, float("nan")), (1, 10**9, 2, 3.0)], "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_quantity double")
    odd.join(rows.limit(0).drop("l_orderkey", "l_partkey", "l_suppkey", "l_quantity"), how="left", on=F.lit(False)).select(rows.columns).coalesce(1).write.parquet(str(tmp_path / "made3"))
    source = tmp_path / "lineitem.parquet"
    source.mkdir()

    def send(i: int) -> None:
        shutil.copy(next((tmp_path / f"made{i}").glob("*.parquet")), source / f"part-{i}.parquet")

    return source, send


def intake(spark, source, tmp_path, **options):
    return cohort_intake.run(spark, str(source), f"{SF}/part.parquet", str(tmp_path / "out"), str(tmp_path / "checkpoint"), options)


def test_intake_takes_only_what_is_new(spark, parts, tmp_path):
    source, send = parts
    send(0)
    send(1)
    first = intake(spark, source, tmp_path)
    before, was = files(tmp_path / "out"), matrix(spark, tmp_path / "out")
    again = intake(spark, source, tmp_path)
    assert again == {"batches": 0, "rows_read": 0, "rows_used": 0, "partials_written": 0, "buckets_written": 0, "matrix_rows": 0, "gene_rows": 0}
    assert files(tmp_path / "out") == before and matrix(spark, tmp_path / "out") == was
    send(2)
    send(3)
    second = intake(spark, source, tmp_path)
    n = {i: spark.read.parquet(str(tmp_path / f"made{i}")).count() for i in range(4)}
    assert (first["rows_read"], second["rows_read"], second["rows_used"]) == (n[0] + n[1], n[2] + n[3], n[2])
    after = files(tmp_path / "out")
    new = {p.split("/")[1] for p in after if p.startswith("partials/") and p not in before}
    kept = [p for p in before if p.startswith("matrix/") and p.split("/")[1] not in new]
    assert kept and all(after[p] == before[p] for p in kept)  # buckets without new rows weren't written
    other = tmp_path / "at_once"
    cohort_intake.run(spark, str(source), f"{SF}/part.parquet", str(other / "out"), str(other / "checkpoint"))
    assert matrix(spark, tmp_path / "out") == matrix(spark, other / "out")


def test_intake_in_small_batches_and_other_buckets(spark, parts, tmp_path):
    source, send = parts
    for i in range(4):
        send(i)
    report = intake(spark, source, tmp_path, files_per_batch=1, buckets=3)
    assert report["batches"] == 4 and report["buckets_written"] <= 3
    con = duckdb.connect()
    want = con.sql(f"select l_suppkey::varchar, p_brand, sum(l_quantity) from read_parquet('{SF}/lineitem.parquet') join read_parquet('{SF}/part.parquet') on l_partkey = p_partkey group by all").fetchall()
    got = [(r["sample"], r["gene"], r["value"]) for r in cohort_intake.result(spark, str(tmp_path / "out")).where("sample <> 'all'").collect()]
    assert sorted(got) == sorted(want)


def test_intake_survives_a_stop_between_its_steps(spark, parts, tmp_path, monkeypatch):
    source, send = parts
    send(0)
    intake(spark, source, tmp_path)
    send(1)
    with monkeypatch.context() as m:
        m.setattr(cohort_intake, "with_cpm", lambda df: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError):
            intake(spark, source, tmp_path)
    healed = intake(spark, source, tmp_path)
    assert healed["batches"] == 0 and healed["buckets_written"] > 0
    # a batch that is repeated replaces its own partial sums
    other = tmp_path / "again"
    calls = []
    real = cohort_intake.write

    def failing(df, path, *by):
        real(df, path, *by)
        if path.endswith("partials") and not calls:
            calls.append(1)
            raise RuntimeError("lost after the write")

    with monkeypatch.context() as m:
        m.setattr(cohort_intake, "write", failing)
        with pytest.raises(Exception, match="lost after the write"):
            cohort_intake.run(spark, str(source), f"{SF}/part.parquet", str(other / "out"), str(other / "checkpoint"))
    cohort_intake.run(spark, str(source), f"{SF}/part.parquet", str(other / "out"), str(other / "checkpoint"))
    assert calls and matrix(spark, other / "out") == matrix(spark, tmp_path / "out")


def test_intake_of_nothing(spark, parts, tmp_path):
    source, send = parts
    send(3)
    report = intake(spark, source, tmp_path)
    assert report["rows_read"] == 6 and report["rows_used"] == 0 and matrix(spark, tmp_path / "out") == []


def report_of(spark, out):
    tests = {(r["var1"], r["var2"]): r for r in spark.read.parquet(f"{out}/tests").collect()}
    cells = sorted(tuple(r) for r in spark.read.parquet(f"{out}/cells").select("var1", "var2", "row", "col", "observed").collect())
    return tests, cells


def test_report_is_the_same_when_rerun(spark, tmp_path, caplog):
    out = str(tmp_path / "out")
    with caplog.at_level("INFO"):
        first = association_report.run(spark, f"{SF}/documents.parquet", f"{SF}/labels.parquet", out)
    tests, cells = report_of(spark, out)
    assert first["rows_read"] == 200 and first["pairs"] == len(tests) and "read" in caplog.text and "wrote" in caplog.text
    assert association_report.run(spark, f"{SF}/documents.parquet", f"{SF}/labels.parquet", out) == first
    assert report_of(spark, out) == (tests, cells)
    assert {p.name.split("=")[0] for p in (tmp_path / "out/tests").iterdir() if p.is_dir()} == {"test"}
    # fewer variables: the tables are replaced as a whole
    small = {"variables": {"lang": "lang", "toxic": "toxic"}, "resamples": 100}
    association_report.run(spark, f"{SF}/documents.parquet", f"{SF}/labels.parquet", out, small)
    assert set(report_of(spark, out)[0]) == {("lang", "toxic")}


def test_report_on_odd_tables(spark, tmp_path, caplog):
    docs = [(1, "a\nb", "en", "s", 3), (2, None, "en", "s", None), (3, "", None, "s", 0), (4, "x1", "de", "s", 2), (None, "y", "de", "s", 1), (4, "x1", "de", "s", 2)]
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(str(tmp_path / "d"))
    spark.createDataFrame([(1, 1, 0), (1, 0, 1), (4, None, 0), (None, 1, 1), (99, 1, 1)], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "l"))
    out = str(tmp_path / "out")
    with caplog.at_level("INFO"):
        report = association_report.run(spark, str(tmp_path / "d"), str(tmp_path / "l"), out, {"resamples": 100})
    assert report["rows_read"] == 6 and "source has 1 levels and is left out" in caplog.text and "quality has 1 levels" in caplog.text
    cells = {(r["row"], r["col"]): r["observed"] for r in spark.read.parquet(f"{out}/cells").where("var1 = 'lang' and var2 = 'toxic'").collect()}
    assert cells == {("en", "1"): 1, ("en", "0"): 0, ("de", "0"): 2, ("de", "1"): 0}
    assert association_report.run(spark, str(tmp_path / "l"), str(tmp_path / "l"), str(tmp_path / "none"), {"variables": {"a": "quality", "b": "toxic"}})["pairs"] <= 1


def plain(rows):
    return sorted(repr([None if v is None or v != v else v if isinstance(v, (str, bool)) else round(float(v), 6) + 0.0 for v in r]) for r in rows)


@pytest.mark.parametrize("name", sorted(registered.QUERIES))
def test_registered_queries(spark, name):
    before = dict(spark.conf.getAll) if isinstance(getattr(spark.conf, "getAll", None), dict) else None
    got = registered.QUERIES[name](spark, SF)
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from read_parquet('{p}')")
    want = con.sql(registered.SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(got.select(*sorted(got.columns)).collect()) == plain(want.project(", ".join(f'"{c}"' for c in sorted(want.columns))).fetchall())
    if before is not None:
        assert dict(spark.conf.getAll) == before


def test_command_lines(spark, tmp_path, monkeypatch):
    """The command line parses, uses the configuration given, and is the only one to stop a session."""
    seen = {}

    class Kept:
        stopped = False

        def stop(self):
            Kept.stopped = True

    monkeypatch.setattr("clustrata.session.session", lambda *a, **b: Kept())
    config = tmp_path / "own.json"
    config.write_text(json.dumps({"buckets": 2}))
    for job, args in ((cohort_intake, ["--measurements", "m", "--features", "f", "--out", "o", "--checkpoint", "c"]), (association_report, ["--documents", "d", "--labels", "l", "--out", "o"])):
        Kept.stopped = False
        monkeypatch.setattr(job, "run", lambda spark, *a, job=job: seen.setdefault(job.__name__, a))
        assert job.main([*args, "--config", str(config)]) == 0 and Kept.stopped
    assert seen["jobs.cohort_intake"] == ("m", "f", "o", "c", {"buckets": 2}) and seen["jobs.association_report"] == ("d", "l", "o", {"buckets": 2})
    with pytest.raises(SystemExit):
        cohort_intake.main([])
