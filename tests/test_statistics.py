import re

from tripmart.operators.load import replace_partitions, write_dimension
from tripmart.plans.catalog import PERIOD, _ctx
from tripmart.plans.runs import register_tables
from tripmart.plans.statistics import STATISTICS_COLUMNS, analyze_tables, cost_session, star_sql
from conftest import SF_SMALL

QUARTER = (PERIOD[0], (PERIOD[1] + 2) // 3)


def _joined(df):
    """Tables in the order in which the optimized plan joins them: the innermost first."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    found = re.findall(r"^([ :+-]*).*Relation \S*?\.(fact_trip|dim_\w+)\[", plan, re.M)
    return [name for _, name in sorted(found, key=lambda x: -len(x[0]))]


def test_statistics_order_the_joins(spark):
    c = _ctx(spark, SF_SMALL)
    paths, star = c.paths(), c.star
    db = "stat_" + paths.gold_fact.split("/")[-2].rpartition("-")[2]
    assert analyze_tables(spark, db) == []  # nothing registered yet
    replace_partitions(star.fact, paths.gold_fact)
    for name, dim in star.dims().items():
        write_dimension(dim, f"{paths.gold_dims}/{name}")
    register_tables(spark, paths, db)
    plain = star_sql(spark, db, *QUARTER)
    want, before = sorted(map(tuple, plain.collect())), _joined(plain)
    assert set(before[:2]) == {"fact_trip", "dim_location"} and before[-1] == "dim_date"  # as written

    assert analyze_tables(spark, db) == [f"{db}.{t}" for t in STATISTICS_COLUMNS]
    assert analyze_tables(spark, db, {"absent": ["x"]}) == []
    stats = dict(spark.sql(f"DESCRIBE EXTENDED {db}.dim_date date_key").collect())
    assert int(stats["distinct_count"]) >= 300 and stats["num_nulls"] == "0"

    costed = star_sql(cost_session(spark), db, *QUARTER)
    assert set(_joined(costed)[:2]) == {"fact_trip", "dim_date"}
    assert sorted(map(tuple, costed.collect())) == want and want
    assert spark.conf.get("spark.sql.cbo.enabled") == "false"  # the caller's session stays as it was
