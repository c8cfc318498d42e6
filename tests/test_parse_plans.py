"""The line regex runs once a line, whatever is read from its fields."""
import pytest

from tidewater.functions.logparse import LOG_PATTERN
from tidewater.operators import weblog as W
from tidewater.sources.tables import weblog, weblog_dense

PLANS = {
    "parse_log": lambda w: W.parse_log(w),
    "log_times": lambda w: W.log_times(w),
    "status_hourly": lambda w: W.status_hourly(w),
    "extract_request": lambda w: W.extract_request(w),
    "strict_urls": lambda w: W.strict_urls(w),
    "request_records": lambda w: W.request_records(w, with_ip=True),
    "status_sliding_counts": lambda w: W.status_sliding_counts(w),
    "parsed and filtered": lambda w: W.parse_log(w).where("status = '200' and agent like 'agent%'"),
}


@pytest.mark.parametrize("name", sorted(PLANS))
def test_one_regex_run_a_line(spark, sf, name):
    # the packing replacement is the run every line takes; the table is written, so that nothing is folded
    lines = weblog(spark, sf) if name != "status_sliding_counts" else weblog_dense(spark, sf)
    plan = PLANS[name](lines)._jdf.queryExecution().optimizedPlan().toString()
    runs = plan.count("regexp_replace(")
    assert runs == 1, (runs, LOG_PATTERN)
