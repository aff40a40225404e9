"""Stages of the pipeline on odd tables: nulls, repeated rows, long texts, empty tables, columns with clashing names."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quillmill.llm import durable as durable_module
from quillmill.llm.durable import durable
from quillmill.llm.jaccard import keep_one_of_each_class
from quillmill.llm.privacy import sanitise

DATA = "/root/testdata/sf0.001"
SHAPE = "doc_id bigint, text string, lang string, source string, n_chars bigint, text_key bigint, __key string, __spans string, key int, Spans int, known string, row string, node bigint, score double, r int"
TEXTS = [None, "", " \n\t", "word", "write to someone@example.org or +44 20 7946 0958 " * 3, "the same text of a few words and some more", "the same text of a few words and some more", "long " * 40_000, "日本語 İstanbul"]


def odd(spark, texts=TEXTS):
    rows = [(i, t, "en", "s", 1, 2, "k", "p", 3, 4, "x", "y", 5, 0.5, 6) for i, t in enumerate(texts)]
    rows += [(None, "no id here", "en", None, None, 2, None, None, 3, 4, None, None, 5, None, 6), rows[5], (3, "word", "de", "t", 9, 2, "k", "p", 3, 4, "x", "y", 5, 0.5, 6)] if texts else []
    return spark.createDataFrame(rows, SHAPE)


def test_sanitise_keeps_every_row_and_column(spark):
    docs = odd(spark)
    got = sanitise(docs)
    assert got.columns == docs.columns and got.count() == docs.count()
    same = lambda df: sorted(map(str, (tuple(v for k, v in r.asDict().items() if k != "text") for r in df.collect())))
    assert same(got) == same(docs)
    assert got.where("doc_id = 4").first()["text"].startswith("write to [EMAIL] or [PHONE]")


def test_of_one_id_the_same_row_stays_each_time(spark):
    docs = odd(spark)
    for parts in (1, 3, 5):
        kept = {(r["doc_id"], r["lang"]) for r in keep_one_of_each_class(docs.repartition(parts)).collect()}
        assert kept == {*((i, "en") for i in range(9) if i not in (3, 6)), (3, "de"), (None, "en")}  # 6 is a copy of 5, and of the two rows with id 3 "de" comes first


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
@pytest.mark.parametrize("empty", [False, True])
def test_stage(spark, name, empty):
    docs = odd(spark, [] if empty else TEXTS)
    got = dict(corpus_pipeline.STAGES)[name](spark, docs, DATA)
    rows = got.collect()
    if name != "packing":
        assert got.columns == docs.columns
    if empty:
        assert not rows
    elif name == "packing":
        assert {r["doc_id"] for r in rows} == {None, *range(9)} and sum(r["length"] for r in rows if r["doc_id"] == 1) == 1  # an empty text is its closing id
    else:
        assert {r["doc_id"] for r in rows} <= {None, *range(9)}
        assert {r["doc_id"] for r in docs.where(F.col("text").isNull()).collect()} <= {r["doc_id"] for r in rows} or name in ("quality", "toxicity")


def test_the_drivers_garbage_goes_when_a_result_is_written(spark, monkeypatch):
    beans = spark.sparkContext._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
    whole = lambda: sum(b.getCollectionCount() for b in beans if "Old Generation" in b.getName() or "MarkSweep" in b.getName())
    durable(spark.range(3))  # what starting up collects is over
    monkeypatch.setattr(durable_module, "_collected", -1e9, raising=False)
    before = whole()
    assert durable(spark.range(3)).count() == 3
    assert whole() > before


def test_the_driver_keeps_no_bit_maps(spark, monkeypatch):
    told = []
    real = type(spark.sparkContext).broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: told.append(real(self, value)) or told[-1])
    keep_one_of_each_class(odd(spark)).count()
    assert told and not any(hasattr(b, "_value") for b in told)  # it is there once the driver reads it back
