"""Every stage of the pipeline on its own input, against plain code."""

import pyarrow as pa
import pytest

import corpus_pipeline
from clickloom.llm import exact_dedup, near_dedup, packing, toxicity
from clickloom.llm.common import BATCH_BYTES, modest_batches
from test_exact_dedup import expected as exact_groups
from test_near_dedup import brute as near_groups
from test_packing import check as check_packing
from test_packing import plain_ids
from test_secret_scan import base, by_entropy

SF = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def texts_of(frame):
    return {r.doc_id: r.text for r in frame.collect()}


def test_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "secret_scan", "packing"]


@pytest.mark.parametrize("name", list(STAGES)[:-1])
def test_columns_stay(spark, documents, name):
    kept = STAGES[name](spark, documents, SF)
    assert kept.dtypes == documents.dtypes


def test_toxicity(spark, documents):
    scored = toxicity.scored_documents(documents, spark.read.parquet(f"{SF}/labels.parquet")).collect()
    kept = texts_of(STAGES["toxicity"](spark, documents, SF))
    assert set(kept) == {r.doc_id for r in scored if not r.predicted} and len(kept) < documents.count()


def test_exact_dedup(spark, documents):
    rows = [(i, t) for i, t in texts_of(documents).items()]
    kept = texts_of(STAGES["exact_dedup"](spark, documents, SF))
    assert kept == {i: t for i, t in rows if i in {r[0] for r in exact_groups(rows) if r[3]}}


def test_near_dedup(spark, documents):
    rows = list(texts_of(documents).items())
    kept = texts_of(STAGES["near_dedup"](spark, documents, SF))
    assert set(kept) == {r[0] for r in near_groups(rows) if r[3]}


def test_secret_scan(spark, documents):
    def masked(text):
        out, at = "", 0
        for start, _, end in sorted([*base(text), *by_entropy(text)], key=lambda s: (s[0], s[2])):
            if start >= at:
                out += text[at:start] + "[SECRET]"
            at = max(at, end)
        return out + text[at:]

    kept = STAGES["secret_scan"](spark, documents, SF).collect()
    assert {r.doc_id: r.text for r in kept} == {i: masked(t) for i, t in texts_of(documents).items()}
    assert all(r.n_chars == len(r.text) for r in kept)


def test_packing(spark, documents):
    texts = texts_of(documents)
    rows = STAGES["packing"](spark, documents, SF).collect()
    end = (1).to_bytes(4, "little")
    from clickloom.llm.packing import Limits

    check_packing(rows, {i: (ids + end, 0) for i, ids in zip(texts, plain_ids(list(texts.values())))}, Limits())


def test_whole_run(spark, documents):
    """The stages one after another, each taking effect."""
    docs, sizes = documents, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        sizes.append(docs.count())
    assert documents.count() > sizes[0] > sizes[1] >= sizes[2] == sizes[3]
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in rows} == set(texts_of(docs))


@pytest.fixture()
def usual_batches(spark):
    """Spark's own limit before a test and, whatever it did, after it."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(name)
    yield name
    spark.conf.unset(name)


@pytest.mark.parametrize(
    "name, module, call",
    [
        ("toxicity", toxicity, "without_toxic"),
        ("exact_dedup", exact_dedup, "without_copies"),
        ("near_dedup", near_dedup, "without_near_copies"),
        ("packing", packing, "pack"),
    ],
)
def test_texts_go_to_python_in_batches_of_few_bytes(spark, usual_batches, monkeypatch, name, module, call):
    """12 MB of texts in one task, in fewer rows than Spark would make a batch of."""

    def sizes(batches):  # in here, as workers cannot import tests
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "size"])

    docs = spark.range(0, 1200, 1, 1).selectExpr("id as doc_id", "repeat(cast(id % 10 as string), 10000) as text")
    monkeypatch.setattr(module, call, lambda docs, *others: docs.select("text").mapInArrow(sizes, "n long, size long"))
    rows = STAGES[name](spark, docs, SF).collect()
    assert sum(row.n for row in rows) == 1200
    assert max(row.size for row in rows) < BATCH_BYTES * 1.1


def test_smaller_batches_stay(spark, usual_batches):
    spark.conf.set(usual_batches, "64k")
    modest_batches(spark)
    assert spark.conf.get(usual_batches) == "64k"
