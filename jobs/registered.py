"""The jobs as queries: each runs twice into one new folder, and the whole output is read back; with SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clustrata.operators import crosstabs
from clustrata.plans.queries import HASH, _suite_sql, rounded, with_
from clustrata.sources.tables import new_folder

from . import association_report, cohort_intake

def job1_cohort_intake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as measurements of suppliers, parts as annotation."""
    folder = new_folder(spark, "cohort-intake")
    for _ in range(2):  # the second run finds nothing new
        cohort_intake.run(spark, f"{sf_dir}/lineitem.parquet", f"{sf_dir}/part.parquet", f"{folder}/out", f"{folder}/checkpoint")
    return rounded(cohort_intake.result(spark, f"{folder}/out"))


def job2_association_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages, sources, shapes and labels of the documents. A drawn p, and the q that reads it, are held to plain versions by tests."""
    folder = new_folder(spark, "association-report")
    for _ in range(2):
        association_report.run(spark, f"{sf_dir}/documents.parquet", f"{sf_dir}/labels.parquet", f"{folder}/out")
    found = association_report.result(spark, f"{folder}/out").drop("q", "stars")
    return rounded(found.withColumn("p", F.when(F.col("test") != "monte_carlo", F.col("p"))))


_JOB1_SQL = with_(
    "sums as (select l_suppkey::varchar as sample, p_brand as gene, sum(l_quantity) as value from lineitem join part on l_partkey = p_partkey where l_suppkey is not null and l_quantity >= 0 and p_brand is not null group by all)",
    "matrix as (select s.sample, gene, value, log2(value / greatest(size, 1) * 1e6 + 1) as logcpm from sums s join (select sample, sum(value) as size from sums group by 1) using (sample))",
) + f"""select ({HASH.format("sample")} % 16)::int as bucket, sample, gene, round(value, 6) as value, round(logcpm, 6) as logcpm, (value > 0)::bigint as n_samples from matrix
union all select ({HASH.format("gene")} % 16)::int, 'all', gene, round(sum(value), 6), round(avg(logcpm), 6), count(*) filter (value > 0) from matrix group by gene"""

_NAMES = ["lang", "source", "length", "layout", "numbers", "quality", "toxic"]
_WIDE = """wide_ as (select lang, source, case when length(text) < 600 then 'short' when length(text) < 3000 then 'medium' else 'long' end as length,
  case when contains(text, chr(10)) then 'lines' else 'block' end as layout, case when regexp_matches(text, '[0-9]') then 'yes' else 'no' end as numbers, q as quality, t as toxic
  from documents left join (select doc_id, max(quality) as q, max(toxic) as t from labels group by 1) using (doc_id))"""
_JOB2_SQL = with_(_WIDE, *_suite_sql("wide_", crosstabs.all_pairs([], _NAMES), {"length": ["short", "medium", "long"]})) + """
select t.var1, t.var2, row, col, observed, round(expected, 6) as expected, round(case when isfinite(z) then z else 0 end, 6) as adj_residual, coalesce(test, 'none') as test, round(statistic, 6) as statistic,
  coalesce(dof, 0) as dof, coalesce(ps.n, 0) as n, round(sqrt(chi2 / (ps.n * (least(ps.nr, ps.nc) - 1))), 6) as cramers_v, round(case when test = 'trend' then r end, 6) as trend_r, round(p, 6) as p,
  coalesce(met, false) as conditions_met, round(mn, 6) as min_expected, round(low, 6) as share_low
from tab t left join ps on ps.var1 = t.var1 and ps.var2 = t.var2"""

QUERIES = {"job1_cohort_intake": job1_cohort_intake, "job2_association_report": job2_association_report}
SQL = {"job1_cohort_intake": _JOB1_SQL, "job2_association_report": _JOB2_SQL}
