import pytest

from voltlake.operators import quality as Q


def as_tuple(df):
    return tuple(df.first())


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(
        [(1, "a"), (2, "b"), (2, "b"), (3, None), (None, "z")], "id INT, kind STRING"
    )


def test_each_check_counts_checked_and_failed(spark, people):
    parents = spark.createDataFrame([(1,), (2,), (2,)], "pid INT")
    assert as_tuple(Q.not_null(people, "kind")) == ("not_null(kind)", 5, 1)
    assert as_tuple(Q.unique(people, ["id"])) == ("unique(id)", 4, 1)
    assert as_tuple(Q.accepted_values(people, "kind", ["a", "b"])) == ("accepted_values(kind)", 4, 1)
    assert as_tuple(Q.relationships(people, "id", parents, "pid")) == ("relationships(id)", 4, 1)


def test_checks_on_an_empty_table_pass_with_nothing_checked(people):
    none = people.filter("false")
    results = Q.run_checks(
        [Q.not_null(none, "id"), Q.unique(none, ["id"]), Q.relationships(none, "id", people)]
    )
    assert {tuple(r)[1:] for r in results.collect()} == {(0, 0)}


def test_all_failures_are_named_at_once(people):
    with pytest.raises(Q.QualityError, match=r"not_null\(id\): 1 rows; unique\(id\): 1 rows"):
        Q.require_passed(Q.run_checks([Q.not_null(people, "id"), Q.unique(people, ["id"])]))
    Q.require_passed(Q.not_null(people.filter("id = 1"), "id"))


def test_row_gate_names_every_empty_table(people):
    none = people.filter("false")
    assert Q.require_rows({"a": people, "b": people.limit(1)}) == {"a": 5, "b": 1}
    with pytest.raises(Q.QualityError, match="empty tables: b, c"):
        Q.require_rows({"a": people, "c": none, "b": none})
    with pytest.raises(Q.QualityError):
        Q.require_not_empty(none, "audit_log")
