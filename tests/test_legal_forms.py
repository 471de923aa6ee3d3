"""Every alternative of the patterns of legal prose."""

import pytest
from pyspark.sql import functions as F

from lexquarry.functions import units


def one(spark, column, text):
    return spark.createDataFrame([(text,)], "x string").select(column.alias("y")).first().y


@pytest.mark.parametrize("modal", ["shall not", "may not", "must not", "is prohibited from", "are prohibited from", "is required to", "are required to", "shall", "must", "may"])
def test_modals(spark, modal):
    got = one(spark, units.action("x"), f"Each owner {modal} keep the old records.")
    assert (got.subject, got.modal, got.rest) == ("Each owner", modal, "keep the old records")


@pytest.mark.parametrize("phrase", ["within 30 days", "within 2 calendar months", "within 1 year", "no later than the first of May", "before the sale", "after the sale", "annually", "quarterly", "monthly", "weekly", "daily"])
def test_times(spark, phrase):
    assert one(spark, units.temporal("x"), f"A report is due {phrase}, in writing.") == phrase


@pytest.mark.parametrize("clause,exception", [("if it is sold", False), ("when it is sold", False), ("provided that it is sold", False), ("unless it is sold", True), ("except the old", True), ("except as provided by law", True)])
def test_clauses(spark, clause, exception):
    assert one(spark, units.clauses("x", exception), f"File it {clause}; then stop.") == [clause]
    assert one(spark, units.clauses("x", not exception), f"File it {clause}; then stop.") == []


@pytest.mark.parametrize("fund", ["general fund", "cash fund", "cash funds", "federal fund", "federal funds", "state education fund", "marijuana tax cash fund", "highway users tax fund", "older-homes repair fund"])
def test_funds(spark, fund):
    assert one(spark, F.lower(F.regexp_extract("x", units.FUND, 1)), f"$5: {fund}.") == fund


@pytest.mark.parametrize("body,action", [
    ("1-1-1 is hereby repealed", "repeal"), ("1-1-1 IS REPEALED", "repeal"), ("a repeal of it", "repeal"), ("repealing it", "repeal"), ("BY THE ADDITION OF a part", "add"), ("1-1 is added", "add"), ("add a new part", "add"),
    ("is amended", "amend"), ("is amended to read", "amend"), ("a new article", "new"), ("new part", "new"), ("new  section", "new"), ("it is enacted", "new"), ("nothing", "other"), ("x" * 1200 + " is amended", "other"),
])
def test_section_actions(spark, body, action):
    assert one(spark, units.section_action(F.col("x")), body) == action


def test_subjects(spark):
    bad = ["it", "This", "that", "there", "These", "those", "abc", "1234", "The following general definitions", "the following definitions", "The purpose of these", "The statutory authority of it"]
    assert [one(spark, units.fit_subject(F.col("x")), s) for s in bad] == [False] * len(bad)
    assert one(spark, units.fit_subject(F.col("x")), "Each owner")
