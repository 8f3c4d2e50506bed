"""Session defaults: what adaptive execution gives to one task."""

from __future__ import annotations

from vulnlake.session import TASK_INPUT, apply_defaults


def test_a_task_gets_a_bounded_share_unless_the_session_says_otherwise(spark):
    key, value = TASK_INPUT
    given = spark.conf.get(key, None)
    try:
        spark.conf.unset(key)
        assert apply_defaults(spark).conf.get(key) == value == "16m"
        spark.conf.set(key, "8m")
        assert apply_defaults(spark).conf.get(key) == "8m"
    finally:
        spark.conf.set(key, given or value)
