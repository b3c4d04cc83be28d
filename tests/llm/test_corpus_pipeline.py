import random
from pathlib import Path

import corpus_pipeline as cp
import pytest
from llm_helpers import prose
from pyspark.sql import functions as F

from crawlspark.llm import mixing

SMALL = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not Path(SMALL).exists(), reason="needs the test tables")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Every stage's input and output over the smallest tables."""
    if not Path(SMALL).exists():
        pytest.skip("needs the test tables")
    folder = tmp_path_factory.mktemp("pipeline")
    docs, out = spark.read.parquet(f"{SMALL}/documents.parquet"), []
    for name, stage in cp.STAGES:
        stage(spark, docs, SMALL).write.parquet(f"{folder}/{len(out)}")
        after = spark.read.parquet(f"{folder}/{len(out)}")
        out.append((name, docs, after))
        docs = after
    return out


def test_columns_and_order(stages):
    assert [name for name, _, _ in stages] == [
        "language ID", "toxicity", "n-gram Jaccard join", "mixing sources to target weights", "best-fit packing",
    ]
    for _, before, after in stages[:-1]:
        assert before.columns == after.columns


def test_filters_keep_rows_as_they_are(stages):
    for _, before, after in stages[:3]:
        assert after.exceptAll(before).count() == 0


def test_clean_documents_stay_and_toxic_ones_go(spark, stages):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    _, before, after = stages[1]
    kept = after.select("doc_id").join(labels, "doc_id").groupBy("toxic").count().collect()
    given = before.select("doc_id").join(labels, "doc_id").groupBy("toxic").count().collect()
    kept, given = ({r.toxic: r["count"] for r in rows} for rows in (kept, given))
    # There are a dozen labelled toxic documents here to learn from.
    assert kept.get(0, 0) >= 0.97 * given[0] and kept.get(1, 0) <= 0.5 * given[1]


def test_missing_and_repeated_ids_hide_no_copy(spark, documents):
    text, other = prose(21, 60), prose(22, 60)
    near = text.rsplit(" ", 1)[0] + " zz"
    rows = [(1, text), (None, text), (None, near), (1, other), (7, other), (None, prose(23, 60)), (None, prose(23, 60)), (5, ""), (5, ""), (6, "")]
    kept = cp.drop_similar(spark, documents(rows), SMALL).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=repr) == sorted(
        [(1, text), (1, other), (None, prose(23, 60)), (5, ""), (6, "")], key=repr
    )


def test_one_document_of_each_class_stays(stages):
    _, before, after = stages[2]

    def shingles(text):
        words = text.encode().lower().split()
        return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) or frozenset([tuple(words)])

    sets = {r.doc_id: shingles(r.text) for r in before.collect()}
    root = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                low, high = sorted((root[a], root[b]))
                root = {i: low if r == high else r for i, r in root.items()}
    assert {r.doc_id for r in after.collect()} == {i for i, r in root.items() if i == r}


def test_the_mix_spends_its_budget(stages):
    _, before, after = stages[3]
    tokens = [df.agg(F.sum(mixing.n_tokens("text"))).first()[0] for df in (before, after)]
    leaves = mixing.quotas(mixing.described(before, cp.DOMAIN), cp.MIX_WEIGHTS, cp.MIX_PERMILLE, cp.MIX_EPOCHS)
    assert tokens[1] == leaves.agg(F.sum("quota")).first()[0] <= tokens[0]
    whole = {r.doc_id: r.text for r in before.collect()}
    assert all(whole[r.doc_id].startswith(r.text) for r in after.collect())


def test_every_token_is_packed_once(stages):
    _, before, after = stages[4]
    assert after.agg(F.sum("n_tokens")).first()[0] == before.agg(F.sum(mixing.n_tokens("text"))).first()[0]
    ends = after.groupBy("bin_id", "bin_size").agg(F.sum("n_tokens").alias("n"), F.max(F.col("bin_offset") + F.col("n_tokens")).alias("end"))
    assert ends.where("bin_id is not null and (n != end or n > bin_size)").count() == 0


@needs_tables
def test_run_gives_the_last_stages_rows(spark, stages):
    order = ["doc_id", "piece", "start", "n_tokens"]
    assert cp.run(spark, SMALL).select(*order).exceptAll(stages[-1][2].select(*order)).count() == 0


def test_odd_rows_pass_every_stage(spark, documents, tmp_path):
    words = random.Random(1)
    rows = [(i, prose(i, 60), "xx", f"src{words.randint(0, 3)}") for i in range(60)]
    rows += [(100, None), (101, ""), (102, "12 34"), (None, prose(500, 30), None, None), (103, prose(1, 20_000), "xx", None)]
    rows += [(5, *rows[5][1:])] * 2
    docs = documents(rows).selectExpr("*", "1 as score", "2 as predicted", "3 as drawn", "4 as lang_pred")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for empty in (False, True):
        current = docs.limit(0) if empty else docs
        for number, (_, stage) in enumerate(cp.STAGES):
            out = f"{tmp_path}/{empty}-{number}"
            stage(spark, current, str(tmp_path)).write.parquet(out)
            current = spark.read.parquet(out)
            if number < 4:
                assert current.columns == docs.columns
            if number == 2 and not empty:
                assert {100, 101, 102}.isdisjoint(r.doc_id for r in current.collect())
                assert current.where("doc_id = 5").count() == 1 and current.where("doc_id is null").count() == 1
        assert (current.count() == 0) == empty
