"""What Spark makes of the plans."""

from callweave.plans.queries import QUERIES, cleaned_rows


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_each_time_is_parsed_once(spark, sf_dir):
    # the three shapes of a date, each parsed in one place, and none formatted and read again
    plan = optimized(cleaned_rows(spark, sf_dir, "edr"))
    raw = optimized(cleaned_rows(spark, sf_dir, "edr").select("event_type"))
    parses = "gettimestamp"
    assert plan.lower().count(parses) - raw.lower().count(parses) <= 5, plan


def test_clean_table_shuffles_once(spark, sf_dir):
    plan = QUERIES["clean_batch_cdr"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
