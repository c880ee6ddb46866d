"""The pipeline against its stages done plainly."""

import corpus_pipeline
import brute
from test_mixing_packing import check_packing
from tickbars.llm import op1_quality

MIDDLE = "/root/testdata/sf0.01"


def test_pipeline(spark):
    rows = {r["doc_id"]: r for r in brute.documents(MIDDLE)}
    kept = [rows[r["doc_id"]] for r in op1_quality.op1_quality(spark, MIDDLE).filter("kept").collect()]
    firsts = {r[1] for r in brute.exact_dedup(kept)}
    kept = [r for r in kept if r["doc_id"] in firsts]
    firsts = {r[2] for r in brute.simhash(kept)}
    kept = [r for r in kept if r["doc_id"] in firsts]
    times = {d: int(taken / size + 0.5) for d, size, _, _, taken in brute.mixing(kept) if size}
    mixed = [r for r in kept for _ in range(times.get(r["doc_id"], 0))]
    assert 0.8 * len(rows) < len(mixed) < 1.6 * len(rows)
    used, tokens = check_packing(corpus_pipeline.run(spark, MIDDLE).collect(), mixed)
    assert used <= 1.01 * tokens / 4096 + 2
    assert corpus_pipeline.ORACLE_SQL is None


COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def run_on(spark, tmp_path, docs, labels):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    return corpus_pipeline.run(spark, str(tmp_path)).collect()


def test_pipeline_on_empty_tables(spark, tmp_path):
    docs = spark.createDataFrame([], COLUMNS)
    assert run_on(spark, tmp_path, docs, spark.createDataFrame([], "doc_id long, quality int, toxic int")) == []


def test_pipeline_on_odd_rows(spark, tmp_path):
    """Nulls in every column, doubled rows, no labels, and columns that clash with the operators' own."""
    words = [" ".join(f"w{i}x{k}" for k in range(40)) for i in range(12)]
    rows = [(i, t, "en", "a" if i % 2 else None, len(t)) for i, t in enumerate(words)]
    rows += [rows[0]] * 5 + [(None, words[1] + " more", None, None, None), (None, None, None, None, None), (50, "", "en", "a", 0), (51, " \n", None, "b", 2), (52, "few words", "en", "b", 9)]
    docs = spark.createDataFrame(rows, COLUMNS).selectExpr("*", "'x' AS shard", "1 AS words", "'k' AS kept", "2 AS size", "3 AS piece", "4 AS sequence_id")
    got = run_on(spark, tmp_path, docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    kept = {r["doc_id"] for r in got}
    # The mix takes texts once or more, or leaves them; what is rejected or a copy is never there.
    assert kept <= {*range(12), None} and len(kept) >= 6
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for placed in by_sequence.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= 4096
