"""Sessions read their input once, whatever is asked of them."""
import re

import pytest

from tidewater.operators import sessions as S
from tidewater.operators import weblog as W
from tidewater.sources.tables import weblog


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("form", [S.sessions, S.session_snapshot, S.running_sessions])
def test_one_scan(spark, sf, form):
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in off}
    try:
        for k, v in off.items():
            spark.conf.set(k, v)
        plan = _final_plan(form(W.requests_by_ip(weblog(spark, sf), keep=("event_id", "ts"))))
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert plan.count("FileScan") == 1
    assert len(re.findall(r"regexp_replace", plan)) <= 3  # once a line, in one projection of the scan
