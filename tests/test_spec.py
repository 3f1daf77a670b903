import pytest
from pyspark.sql import functions as F

from tidemark.plans.spec import JdbcSource, Layout, Step, TransferSpec, ordered_steps, trigger_interval


@pytest.mark.parametrize("bad", [
    dict(alias="a b", query="select 1"),
    dict(alias="", query="select 1"),
    dict(alias="a"),
    dict(alias="a", query="select 1", frame=lambda s: s.range(1)),
    dict(alias="a", query="select 1", range_clause="where x > 1"),
    dict(alias="a", frame=lambda s: s.range(1), primary_key="id", range_clause="where x > 1"),
    dict(alias="a", query="q", jdbc=JdbcSource("jdbc:x"), primary_key="x", range_clause="where x > :max_primary_key"),
    dict(alias="a", query="q", primary_key="x", range_clause="where x >= 1", rescan_ties=True),
    dict(alias="a", query="q", database="x; drop"),
])
def test_refused_specs(bad):
    with pytest.raises(ValueError):
        TransferSpec(**bad)


def test_column_lists_are_tuples():
    with pytest.raises(TypeError):
        Layout(sort_by="day")
    with pytest.raises(TypeError):
        TransferSpec(alias="a", query="q", row_key="id")


def test_secrets_stay_out_of_repr():
    source = JdbcSource("jdbc:db", user="me", password="hidden", options={"key": "hidden"})
    spec = TransferSpec(alias="a", query="q", jdbc=source)
    assert "hidden" not in repr(source) + repr(spec) and "me" not in repr(source).replace("fetch", "").split("url")[0]


def test_incremental_follows_the_range_clause():
    assert not TransferSpec(alias="a", query="q").incremental
    assert TransferSpec(alias="a", query="q", primary_key="x", range_clause=lambda m: F.col("x") > m).incremental


def test_steps_are_ordered_by_version():
    steps = [Step("10", "c"), Step("9", "b"), Step("1.2", "a"), Step("1.10", "a2")]
    assert [s.version for s in ordered_steps(steps)] == ["1.2", "1.10", "9", "10"]


def test_duplicate_versions_and_lifecycles_are_refused():
    with pytest.raises(ValueError, match="duplicate"):
        ordered_steps([Step("1", "a"), Step("1", "b")])
    with pytest.raises(ValueError):
        Step("1", "a", "during")


@pytest.mark.parametrize("given, taken", [
    ("30 seconds", "30 seconds"), ("PT30s", "30000 milliseconds"), ("PT1H5M", "3900000 milliseconds"),
    ("P1DT0.5S", "86400500 milliseconds"), ("P", "P"),
])
def test_intervals(given, taken):
    assert trigger_interval(given) == taken
