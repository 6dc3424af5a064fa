"""Every registered query against its DuckDB oracle over the raw test tables.

All keys run at sf0.001; the whole jobs also at sf0.01, the driver's correctness scale.
"""

from __future__ import annotations

import pytest

from demandlens.plans.registry import PIPELINES, QUERIES
import oracle.compare as oracle_compare
from oracle.compare import compare, duck
from oracle.statements import build

oracle_compare.EXACT = True     # floats must agree bit for bit, not only to 6 decimals

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con0001():
    return duck(SF0001)


@pytest.fixture(scope="module")
def con001():
    return duck(SF001)


def queries():
    return QUERIES


def oracle_sql():
    return build()


def test_every_query_has_an_oracle():
    from __spark_entry__ import oracle_sql as entry_sql
    from __spark_entry__ import queries as entry_queries
    assert set(QUERIES) == set(build())
    assert set(QUERIES) <= set(entry_queries()) and set(build()) <= set(entry_sql())


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "date": "DATE"}


@pytest.mark.parametrize("name", sorted(queries()))
def test_column_types_match_oracle(spark, con0001, name):
    spark_types = {c: SPARK_TO_DUCK.get(t, t) for c, t in queries()[name](spark, SF0001).dtypes}
    rel = con0001.sql(oracle_sql()[name])
    assert spark_types == {c: str(t) for c, t in zip(rel.columns, rel.types)}


@pytest.mark.parametrize("name", sorted(queries()))
def test_matches_oracle_sf0001(spark, con0001, name):
    r = compare(spark, name, SF0001, con0001)
    assert r["match"], r


@pytest.mark.parametrize("name", PIPELINES)
def test_jobs_match_oracle_sf001(spark, con001, name):
    r = compare(spark, name, SF001, con001)
    assert r["match"], r


# Row counts measured independently on the fixture derivation (FIXTURES.md section 4).
EXPECTED_SF001 = {"current_snapshot": 1, "system_antipeaks": 434, "old_peaks": 515,
                  "new_peaks": 830, "antipeaks": 478, "dbd_total": 102, "dbd_reg": 102,
                  "ppm_pivot": 2000, "stitched_totals": 33456, "first_violation": 1868,
                  "last_year_sales": 1868}


@pytest.mark.parametrize("name,n", sorted(EXPECTED_SF001.items()))
def test_row_counts_sf001(spark, name, n):
    assert queries()[name](spark, SF001).count() == n


# The same table of FIXTURES.md at the other two scales: what follows the first aggregate
# grows with the tables (ppm_left_joined is the input of the median).
EXPECTED = {
    SF0001: {"current_snapshot": 1, "ppm_pivot": 200, "ppm_left_joined": 3637,
             "system_antipeaks": 47, "first_violation": 190, "old_peaks": 47, "new_peaks": 104,
             "antipeaks": 77, "dbd_total": 18, "dbd_reg": 18},
    "/root/testdata/sf0.1": {"current_snapshot": 1, "ppm_pivot": 20000, "ppm_left_joined": 334980,
                             "system_antipeaks": 4348, "first_violation": 18494,
                             "last_year_sales": 18494, "old_peaks": 5064, "new_peaks": 8483,
                             "antipeaks": 4735, "dbd_total": 140, "dbd_reg": 140},
}


@pytest.mark.parametrize("sf,name,n", [(sf, k, v) for sf, d in EXPECTED.items()
                                       for k, v in sorted(d.items())])
def test_row_counts_other_scales(spark, sf, name, n):
    assert queries()[name](spark, sf).count() == n


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    rows = df.collect()
    assert len(rows) == 18          # 17 groups + total row at sf0.001
    assert df.columns[:3] == ["user", "ui_5", "ui_5_name"]


# --- no plan is kept between calls -------------------------------------------------------------

def _tasks_of(spark, action) -> int:
    """Tasks that the jobs of ``action`` ran, by Spark's status tracker."""
    group = f"tasks-{id(action)}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        action()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}
    return sum(i.numCompletedTasks for i in map(tracker.getStageInfo, stages) if i)


def test_appended_rows_are_seen_by_the_next_call(spark, scratch):
    import os

    from pyspark.sql import functions as F
    for name in ("lineitem", "part"):
        spark.read.parquet(f"{SF0001}/{name}.parquet").write.parquet(
            os.path.join(scratch, f"{name}.parquet"))

    def yesterday() -> float:
        rows = QUERIES["dbd_total"](spark, scratch).where("user = 'Итог'").collect()
        return rows[0].d1
    before = yesterday()
    line = spark.read.parquet(f"{SF0001}/lineitem.parquet")
    (line.limit(5).withColumn("l_shipdate", F.lit("1998-06-14").cast(line.schema["l_shipdate"].dataType))
     .withColumn("l_suppkey", F.lit(1).cast("long"))
     .write.mode("append").parquet(os.path.join(scratch, "lineitem.parquet")))
    assert yesterday() > before


def test_a_second_call_does_all_the_work_again(spark):
    run = lambda: QUERIES["dbd_total"](spark, SF0001).collect()
    run()
    assert _tasks_of(spark, lambda: run()) == _tasks_of(spark, lambda: run()) > 0
