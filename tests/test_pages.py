"""Numbered pages against the plan that an announced total makes."""

import pytest
from pyspark.sql import functions as F

from frames import as_set, same_rows
from tidemark.sources.pages import complete_snapshot, page_report, read_numbered, write_pages

SCHEMA = "id string, v int"


def paged(spark, rows):
    return spark.createDataFrame(rows, SCHEMA + ", page int")


@pytest.fixture
def whole(spark):
    """23 entities in pages of 10."""
    return paged(spark, [(f"e{i:02}", i, i // 10) for i in range(23)])


def test_whole_pages_make_the_snapshot(spark, whole, folder):
    write_pages(whole, f"{folder}/p")
    landed = read_numbered(spark, f"{folder}/p", whole.drop("page").schema)
    assert same_rows(landed, whole)
    assert as_set(page_report(landed, 23, 10, ["id"])) == {(0, 10, 10, 0, "ok"), (1, 10, 10, 0, "ok"), (2, 3, 3, 0, "ok")}
    assert same_rows(complete_snapshot(landed, 23, 10, ["id"]), whole.drop("page"))


@pytest.mark.parametrize(
    "change, total, status",
    [("page <> 1", 23, {(1, "missing")}), ("id <> 'e22'", 23, {(2, "short")}), ("true", 21, {(2, "extra")}),
     ("true", 20, {(2, "extra")}), ("true", 41, {(2, "short"), (3, "missing"), (4, "missing")}), ("page = 0", 23, {(1, "missing"), (2, "missing")})],
)
def test_pages_that_are_not_as_planned_fail(whole, change, total, status):
    pages = whole.where(change)
    got = {(r.page, r.status) for r in page_report(pages, total, 10, ["id"]).collect() if r.status != "ok"}
    assert got == status
    named = f"{min(status)[0]} {min(status)[1]}"
    with pytest.raises(ValueError, match=named):
        complete_snapshot(pages, total, 10, ["id"])


def test_an_entity_on_two_pages_comes_once_and_means_that_another_was_passed_over(spark, whole):
    # While pages were read, a new entity moved the last of page 0 to page 1, and so on.
    moved = paged(spark, [(f"e{i:02}", i, i // 10) for i in range(10)] + [(f"e{i - 1:02}", 100 + i, i // 10) for i in range(10, 23)])
    report = {r.page: r.repeated for r in page_report(moved, 23, 10, ["id"]).collect()}
    assert report == {0: 0, 1: 1, 2: 0}
    with pytest.raises(ValueError, match="1 entities are on two pages"):
        complete_snapshot(moved, 23, 10, ["id"])
    got = complete_snapshot(moved, 23, 10, ["id"], moved=1)
    assert got.count() == 22 and got.where("id = 'e09'").first().v == 110


def test_a_broken_line_is_an_error(spark, whole, folder):
    write_pages(whole, f"{folder}/p")
    with open(f"{folder}/p/page=1/broken.json", "w") as out:
        out.write('{"id": "e99", "v": ')
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        read_numbered(spark, f"{folder}/p", whole.drop("page").schema).agg(F.sum("v")).collect()


def test_no_entities_at_all(spark, whole):
    none = whole.limit(0)
    assert page_report(none, 0, 10, ["id"]).isEmpty() and complete_snapshot(none, 0, 10, ["id"]).isEmpty()
