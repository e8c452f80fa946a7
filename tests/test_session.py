"""Written tables and their release."""

import os

from ledgerline.session import owned, release, stored


def test_release_keeps_what_is_named_and_what_was_there(spark):
    before = stored(spark.range(3), "before")
    since = len(owned(spark))
    gone, kept = stored(spark.range(4), "gone"), stored(spark.range(5), "kept")
    release(spark, since, [kept])
    assert (before.count(), kept.count()) == (3, 5)
    assert not os.path.exists(gone.stored_at.removeprefix("file:")) and gone.stored_at not in owned(spark)
    release(spark, since)
    assert owned(spark)[since:] == [] and before.count() == 3
