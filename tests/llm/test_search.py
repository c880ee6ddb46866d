"""Ranked search against plain Python."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from checks.parity import spark_rows, sql_rows
from tickbars.llm import op12_search as op12

UPPER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def searched(docs, items, top=op12.TOP):
    counts = [(doc, Counter(terms(text))) for doc, text in docs]
    n_docs, total = sum(bool(c) for _, c in counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
    found = []
    for item, text in items:
        scored = []
        for doc, c in counts:
            m = 25 + 75 * c.total() * n_docs // max(1, total)
            score = sum(n * weight[t] * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t, n in Counter(terms(text)).items() if t in c)
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        found += [(item, rank, None if gone else doc, -score) for rank, (score, gone, doc) in enumerate(sorted(scored)[:top], 1)]
    return sorted(found, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def corpus():
    pick = random.Random(12)
    words = [f"w{i}" for i in range(60)] + ["É", "é", "x1", "日本"]
    chance = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, " ".join(pick.choices(words, chance, k=pick.randrange(1, 30)))) for i in range(300)]
    # A third of the rows are copies, and ids repeat.
    docs += [(1000 + i, "w3 W3, w40_w41 copy") for i in range(150)] + [(5, "w50 w51")] * 3 + [(None, "w50 w51 w52"), (7, None), (8, "?! \n")]
    items = [(i, " ".join(pick.choices(words, k=pick.randrange(1, 12)))) for i in range(25)]
    return docs, items + [(90, "w3 copy w3"), (90, "w3 copy w3"), (None, "w50"), (91, None), (92, "nowhere"), (93, "--"), (94, "w0")]


@pytest.mark.parametrize(("shard_terms", "item_block", "stages"), [(op12.SHARD_TERMS, op12.ITEMS, op12.STAGES), (300, 10, 3), (100, 5, 1)])
def test_against_plain_python(spark, corpus, shard_terms, item_block, stages):
    docs, items = (spark.createDataFrame(rows, schema).repartition(5) for rows, schema in zip(corpus, (DOCS, ITEMS)))
    assert result(op12.search(docs, items, op12.TOP, shard_terms, item_block, stages)) == searched(*corpus)


def test_bounds_drop_documents_and_lose_none(spark, corpus):
    """With one result wanted, most documents leave the bundles early."""
    docs, items = (spark.createDataFrame(rows, schema) for rows, schema in zip(corpus, (DOCS, ITEMS)))
    assert result(op12.search(docs, items, 1, 500)) == searched(*corpus, 1)


def test_odd_tables(spark):
    docs = spark.createDataFrame([(1, "Alpha beta " * 50_000), (2, "alpha"), (3, "gamma")], DOCS)
    docs = docs.withColumns({c: F.lit("x") for c in ("row", "id", "n", "term", "names", "item_id", "shard")})
    items = spark.createDataFrame([(1, "ALPHA"), (2, "delta")], ITEMS).withColumns({"doc_id": F.lit(0), "key": F.lit(1), "least": F.lit(2)})
    plain = [(1, "Alpha beta " * 50_000), (2, "alpha"), (3, "gamma")]
    assert result(op12.search(docs, items)) == searched(plain, [(1, "ALPHA"), (2, "delta")])
    empty = (docs.limit(0), items), (docs, items.limit(0)), (docs.filter("doc_id = 3"), items)
    assert [result(op12.search(*pair)) for pair in empty] == [[], [], []]


def test_query_and_sql(spark):
    path = "/root/testdata/sf0.01"
    assert spark_rows(op12.op12_search(spark, path)) == sql_rows(path, op12.OP12_SQL)
