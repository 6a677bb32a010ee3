import pytest

from sluiceway.operators.quality import (
    Expectation,
    ExpectationFailed,
    check,
    drop_violations,
    report,
    watch,
)

RULES = (
    Expectation("ok_status", "status BETWEEN 200 AND 299", "drop"),
    Expectation("has_key", "key IS NOT NULL", "drop"),
    Expectation("positive", "n > 0"),
)


@pytest.fixture()
def rows(spark):
    return spark.createDataFrame(
        [(200, "a", 1), (404, "b", 2), (None, "c", None), (201, None, -1)], "status int, key string, n int"
    )


def test_null_is_a_violation(rows):
    found = {r["expectation"]: (r["rows"], r["violations"]) for r in report(rows, "t", RULES).collect()}
    assert found == {"ok_status": (4, 2), "has_key": (4, 1), "positive": (4, 2)}


def test_only_drop_rules_drop(rows):
    assert [r["key"] for r in drop_violations(rows, RULES).collect()] == ["a"]


def test_watch_counts_during_the_write(rows, tmp_path):
    watched, seen = watch(rows, RULES)
    drop_violations(watched, RULES).write.parquet(str(tmp_path / "out"))
    assert ("t", "ok_status", "drop", 7, 4, 2) in check(seen, "t", RULES, 7)


def test_fail_rule_raises(rows):
    rules = (Expectation("no_bad", "status <> 404", "fail"),)
    watched, seen = watch(rows, rules)
    watched.count()
    with pytest.raises(ExpectationFailed, match="no_bad"):
        check(seen, "t", rules, 0)


def test_unknown_action_is_refused():
    with pytest.raises(ValueError):
        Expectation("x", "true", "ignore")
