"""Cases in which less than the whole job was done before."""

import os

import pytest

from tallyforge.operators import evaluate
from tallyforge.plans import queries

DATA = "/root/testdata/sf0.001"


def test_long_ordered_answers(spark):
    spark.range(25_000).selectExpr("id", "id % 7 AS k").createOrReplaceTempView("many")
    right = "SELECT id, k FROM many ORDER BY id"
    assert evaluate.same_rows(spark, "SELECT id, k FROM many WHERE id >= 0 ORDER BY id", right) == (True, True)
    assert evaluate.same_rows(spark, "SELECT id, k FROM many ORDER BY id DESC", right) == (True, False)
    assert evaluate.same_rows(spark, "SELECT id, k FROM many WHERE id < 24999 ORDER BY id", right) == (True, False)
    assert evaluate.same_rows(spark, "SELECT id, IF(id = 24000, 9, k) AS k FROM many ORDER BY id", right) == (True, False)
    assert evaluate.same_rows(spark, "SELECT id FROM many WHERE id < 0", right + " LIMIT 0") == (True, True)
    assert evaluate.same_rows(spark, "SELECT CAST(id AS STRING) AS id, k FROM many ORDER BY id", right) == (True, False)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's tables aren't here")
def test_queries_over_whole_tables(spark):
    run = lambda name: queries.QUERIES[name](spark, DATA)
    events, orders = queries.ev(spark, DATA).count(), queries.od(spark, DATA).count()
    assert run("perplexity_all").count() == events and run("perplexity_all").filter("perplexity = double('Infinity')").count() > 0
    assert run("oversample_minority_all").filter("copy = 0").count() == events < run("oversample_minority_all").count()
    assert run("list_txns_all").count() == run("list_txns_category_all").count() == orders
