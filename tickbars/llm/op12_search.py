"""Ranked lexical search by pipelined term partitioning.

Postings belong to term owners, which are stages: the first owns the terms of the greatest weight, the last those of the
least. An item's bundle holds what is left of its terms and a sparse accumulator of documents, and goes through the stages in turn:
each groups bundles and its own postings together (cogroup) and adds the integer contributions of its terms. The highest sums of the last
stage are selected.

Documents are dealt by hash into shards of about `SHARD_TERMS` terms, items into blocks of `ITEMS`, and a bundle goes to each
shard, so a group of a stage holds one shard's postings of one owner and one block's bundles at most, however many documents an
item matches. A term in a third of all documents has its postings in all shards.

A document leaves a bundle only if it can't be among the `TOP` any more: with 10**6 for each unit of weight still to come, more than any
document gets, it stays below the bundle's least, which is the `TOP`-th sum of this shard or of another, whichever is greater.
Sums only grow, so this loses nothing, ties included, and a document dropped in a stage can't come back in a later one.

Terms meet by two 64-bit hashes of their bytes. The distinct terms of the items are joined to the postings; Spark broadcasts them by
measured size or shuffles both.

Edge cases: null text has no terms, and a document or item without any has no place and gives no rows; weight 0 adds nothing;
each row of `benchmark` is an item and each row of `documents` a document, also where ids repeat or are null (null ids last among
ties); no documents, no items or no term in common: no rows; further columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickbars.llm.texts import stored, text_chunks, word_letters, word_spans
from tickbars.session import work_dir

TOP = 10
STAGES = 4
SHARD_TERMS = 500_000
ITEMS = 1000
#: More than a term's contribution for a unit of weight.
UNIT = 1_000_000

#: Bytes outside terms: ASCII but its letters and digits.
_OUTSIDE = np.array([b < 0x80 and not chr(b).isalnum() for b in range(256)])
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)
_BUNDLE = "item long, block long, shard long, terms array<long>, gains array<long>, owners array<int>, least long, docs array<long>, ids array<long>, sums array<long>"


def term_counts(rows: DataFrame) -> DataFrame:
    """(key, text) -> (key, n, names, checks, times): how many terms a text has, and how often each of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, bounds in text_chunks(batch.column(1)):
                data = _LOWER[data]
                starts, ends, at = word_spans(data, bounds, _OUTSIDE)
                row = np.repeat(np.arange(last - first), np.diff(at))
                name, check = (word_letters(data, starts, ends, which) for which in (0, 1))
                order = np.lexsort((check, name, row))
                row, name, check = row[order], name[order], check[order]
                new = np.ones(len(row), bool)
                new[1:] = (row[1:] != row[:-1]) | (name[1:] != name[:-1]) | (check[1:] != check[:-1])
                begins = np.flatnonzero(new)
                times = np.diff(np.append(begins, len(row)))
                lists = np.searchsorted(row[begins], np.arange(last - first + 1)).astype(np.int32)
                columns = [name[begins].view(np.int64), check[begins].view(np.int64), times]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        pa.array(np.diff(at)),
                        *(pa.ListArray.from_arrays(pa.array(lists), pa.array(c)) for c in columns),
                    ],
                    ["key", "n", "names", "checks", "times"],
                )

    key = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(run, f"key {key}, n long, names array<long>, checks array<long>, times array<long>")


def numbered(rows: DataFrame, id_column: str) -> DataFrame:
    """(row, id, text) with a number for each row; it is the scan's, so the result must be stored once."""
    return rows.select(F.monotonically_increasing_id().alias("row"), F.col(id_column).cast("long").alias("id"), "text")


def counted(rows: DataFrame, id_column: str, name: str) -> DataFrame:
    """(row, id, n, names, checks, times) of each row, stored."""
    keyed = numbered(rows, id_column).select(F.struct("row", "id").alias("key"), "text")
    return stored(term_counts(keyed).select("key.row", "key.id", "n", "names", "checks", "times"), f"op12-{name}", "zstd")


def search(documents: DataFrame, items: DataFrame, top: int = TOP, shard_terms: int = SHARD_TERMS, item_block: int = ITEMS, stages: int = STAGES) -> DataFrame:
    """doc_id, text and item_id, text -> item_id, rank, doc_id, score of the best documents of each item."""
    docs = counted(documents, "doc_id", "documents")
    asked = counted(items, "item_id", "items")
    each = F.inline(F.arrays_zip("names", "checks", "times"))
    wanted = asked.select("row", each)
    distinct = wanted.select("names", "checks").distinct().withColumn("term", F.monotonically_increasing_id())
    vocabulary = stored(distinct, "op12-vocabulary")

    n_docs, n_terms = docs.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    n_items = asked.count()
    n_terms = n_terms or 0
    n_shards, n_blocks = max(1, -(-n_terms // shard_terms)), max(1, -(-n_items // item_block))

    found = docs.select("row", "id", "n", each).join(vocabulary, ["names", "checks"])
    weight = F.floor(1000 * F.log((2.0 * n_docs + 2) / (2.0 * F.col("df") + 1)))
    most = F.floor(1000 * F.log(F.lit((2.0 * n_docs + 2) / 3.0)))
    owner = F.least(F.lit(stages - 1), F.floor((most - F.col("weight")) * stages / (most + 1))).cast("int")
    weights = found.groupBy("term").agg(F.count(F.lit(1)).alias("df")).select("term", weight.alias("weight")).filter("weight > 0")
    weights = stored(weights.withColumn("owner", owner), "op12-weights")

    scale = 25 + F.floor(F.expr(f"(75L * {n_docs}L * n) div {max(1, n_terms)}L"))
    part = F.expr("(1000000000L * times) div (1000L * times + 8L * scale)")
    postings = found.withColumn("scale", scale).join(weights, "term").select(
        F.pmod(F.xxhash64("row"), F.lit(n_shards)).alias("shard"),
        "term",
        # The last bit tells that the row has no id.
        (F.col("row") * 2 + F.col("id").isNull().cast("long")).alias("doc"),
        F.coalesce("id", F.lit(0)).alias("id"),
        part.alias("part"),
        "owner",
    )
    postings = _by_owner(postings)

    terms = wanted.join(vocabulary, ["names", "checks"]).join(weights, "term")
    lists = F.collect_list(F.struct("term", (F.col("times") * F.col("weight")).alias("gain"), "owner")).alias("list")
    bundles = terms.groupBy("row").agg(lists).select(
        F.col("row").alias("item"),
        F.pmod(F.xxhash64("row"), F.lit(n_blocks)).alias("block"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_shards - 1).cast("long"))).alias("shard"),
        F.col("list.term").alias("terms"),
        F.col("list.gain").alias("gains"),
        F.col("list.owner").alias("owners"),
        F.lit(0).cast("long").alias("least"),
        *(F.array().cast("array<long>").alias(c) for c in ("docs", "ids", "sums")),
    )
    for stage in range(stages):
        mine = postings.filter(F.col("owner") == stage).drop("owner")
        mine = mine.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))))
        passed = bundles.groupBy("shard", "block").cogroup(mine.groupBy("shard", "block")).applyInArrow(_stage(stage, stage == stages - 1, top), _BUNDLE)
        if stage < stages - 1:
            passed = stored(passed, f"op12-stage{stage}", "zstd")
            floors = passed.groupBy("item").agg(F.max("least").alias("floor"))
            passed = passed.join(floors, "item").withColumn("least", F.col("floor")).drop("floor")
        bundles = passed

    best = bundles.select("item", F.inline(F.arrays_zip("docs", "ids", "sums")))
    best = best.select("item", F.when(F.col("docs") % 2 == 0, F.col("ids")).alias("doc_id"), F.col("sums").alias("score"), "docs")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "docs")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(asked.select(F.col("row").alias("item"), F.col("id").alias("item_id")), "item").select("item_id", "rank", "doc_id", "score")


def _by_owner(postings: DataFrame) -> DataFrame:
    """Stored with a folder for each owner, of which a stage reads its own."""
    spark = postings.sparkSession
    path = work_dir(spark, "op12-postings")
    postings.write.partitionBy("owner").parquet(path, compression="zstd")
    return spark.read.schema(postings.schema).parquet(path)


def _flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column, and the bounds of the rows' lists."""
    column = column.combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    counts = np.diff(column.offsets.to_numpy())
    return column.flatten().to_numpy(zero_copy_only=False), np.concatenate(([0], np.cumsum(counts)))


def _lists(parts: list[np.ndarray], kind: pa.DataType = pa.int64()) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*parts, np.zeros(0, np.int64)]).astype(np.int64)).cast(kind))


def _stage(stage: int, last: bool, top: int):
    """The work of an owner on the bundles of one block and its postings of one shard."""
    names = [f.split()[0] for f in _BUNDLE.split(", ")]

    def run(bundles: pa.Table, postings: pa.Table) -> pa.Table:
        terms, at = _flat(bundles["terms"])
        gains, owners = _flat(bundles["gains"])[0], _flat(bundles["owners"])[0]
        held, held_at = _flat(bundles["docs"])
        held_ids, held_sums = _flat(bundles["ids"])[0], _flat(bundles["sums"])[0]
        least = bundles["least"].to_numpy()
        term, doc, id_, part = (postings[c].to_numpy() for c in ("term", "doc", "id", "part"))
        order = np.argsort(term, kind="stable")
        term, part = term[order], part[order]
        # Places of this shard's documents in one dense array of sums.
        docs, places = np.unique(np.concatenate((doc[order], held)), return_inverse=True)
        ids = np.zeros(len(docs), np.int64)
        ids[places] = np.concatenate((id_[order], held_ids))
        posted, kept = places[: len(term)], places[len(term) :]
        mine = owners == stage
        begins, ends = np.searchsorted(term, terms, "left"), np.searchsorted(term, terms, "right")
        out: dict[str, list] = {n: [] for n in ("terms", "gains", "owners", "docs", "ids", "sums")}
        floors = []
        for i in range(bundles.num_rows):
            own = slice(at[i], at[i + 1])
            sums = np.zeros(len(docs), np.int64)
            sums[kept[held_at[i] : held_at[i + 1]]] = held_sums[held_at[i] : held_at[i + 1]]
            for k in np.flatnonzero(mine[own]) + at[i]:
                # A document is once among the postings of a term.
                run_of = slice(begins[k], ends[k])
                sums[posted[run_of]] += gains[k] * part[run_of]
            later = owners[own] > stage
            some = np.flatnonzero(sums)
            floor = least[i]
            if len(some) >= top:
                floor = max(floor, np.partition(sums[some], len(some) - top)[len(some) - top])
            some = some[sums[some] + UNIT * gains[own][later].sum() >= floor]
            if last and len(some) > top:
                some = some[np.lexsort((docs[some], ids[some], docs[some] & 1, -sums[some]))[:top]]
            floors.append(floor)
            for n, values in (("terms", terms[own][later]), ("gains", gains[own][later]), ("owners", owners[own][later]), ("docs", docs[some]), ("ids", ids[some]), ("sums", sums[some])):
                out[n].append(values)
        columns = {n: _lists(v, pa.int32() if n == "owners" else pa.int64()) for n, v in out.items()}
        columns |= {n: bundles[n].combine_chunks() for n in ("item", "block", "shard")} | {"least": pa.array(np.array(floors, np.int64))}
        return pa.table({n: columns[n] for n in names})

    return run


def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(*(spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark")))


_TERMS = r"unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term"

OP12_SQL = f"""WITH doc_rows AS (SELECT row_number() OVER () AS doc, doc_id, text FROM documents),
item_rows AS (SELECT row_number() OVER () AS item, item_id, text FROM benchmark),
doc_terms AS (SELECT doc, doc_id, {_TERMS} FROM doc_rows),
item_terms AS (SELECT item, item_id, {_TERMS} FROM item_rows),
sizes AS (SELECT doc, doc_id, count(*) AS n FROM doc_terms GROUP BY ALL),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes),
tf AS (SELECT doc, term, count(*) AS times FROM doc_terms GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
  FROM tf, total GROUP BY term),
asked AS (SELECT item, item_id, term, count(*) AS repeats FROM item_terms GROUP BY ALL),
scores AS (
  SELECT a.item, a.item_id, s.doc, s.doc_id,
         CAST(sum(repeats * w * ((1000000000 * times) // (1000 * times + 8 * (25 + (75 * n * docs) // terms)))) AS BIGINT) AS score
  FROM asked a JOIN weights USING (term) JOIN tf USING (term) JOIN sizes s USING (doc), total
  GROUP BY a.item, a.item_id, s.doc, s.doc_id),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {TOP}"""
