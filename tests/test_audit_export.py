"""The audit export reads column tables, each written once."""

import __spark_entry__ as entry
from conftest import SF
from ledgerline.session import owned


def test_feed_survivors_and_fact_are_written_once_by_column(spark):
    before = len(owned(spark))
    out = entry.queries()["audit_export"](spark, SF)
    labels = [path.rsplit("/", 1)[-1].rsplit("-", 1)[0] for path in owned(spark)[before:]]
    assert sorted(labels) == ["annotated-feed", "clean-fact", "survivors"]
    found = {r.section for r in out.select("section").distinct().collect()}
    assert len(found) == 9
