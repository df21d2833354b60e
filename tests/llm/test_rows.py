"""Rows keep their number when a later job cuts the same files into other partitions."""

import random

import pytest
from pyspark.sql import functions as F

from tests.llm.cases import DOCUMENTS, documents, prose
from tidemark.llm import common
from tidemark.llm.common import identified, only_rows
from tidemark.llm.exact_dedup import drop_exact_duplicates, exact_duplicates
from tidemark.llm.jaccard_join import drop_near_duplicates
from tidemark.llm.resharding import reshard
from tidemark.llm.surrogates import with_surrogates
from tidemark.llm.warc import read_warc, write_warc

WIDE = {"spark.sql.files.minPartitionNum": "1", "spark.sql.files.openCostInBytes": str(64 << 20), "spark.sql.files.maxPartitionBytes": str(256 << 20)}
NARROW = {"spark.sql.files.minPartitionNum": "64", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.maxPartitionBytes": "4096"}


def split(spark, how):
    for key, value in how.items():
        spark.conf.set(key, value)


@pytest.fixture
def shaken(spark, monkeypatch):
    """Every table that is written changes how the next job cuts its files."""
    before = {k: spark.conf.get(k, None) for k in WIDE}
    turns = [0]

    def changed(f):
        def run(*args, **options):
            out = f(*args, **options)
            turns[0] += 1
            split(spark, NARROW if turns[0] % 2 else WIDE)
            return out

        return run

    import tidemark.llm.exact_dedup, tidemark.llm.jaccard_join, tidemark.llm.quality, tidemark.llm.resharding, tidemark.llm.surrogates, tidemark.llm.warc  # noqa: E401

    for module in (common, tidemark.llm.exact_dedup, tidemark.llm.jaccard_join, tidemark.llm.quality, tidemark.llm.resharding,
                   tidemark.llm.surrogates, tidemark.llm.warc):
        for name in ("settle", "settle_sized"):
            if hasattr(module, name):
                monkeypatch.setattr(module, name, changed(getattr(module, name)))
    split(spark, WIDE)
    yield turns
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def copies():
    """A hundred texts, three copies each, without identifiers or with the same one."""
    rows = [(None if k % 2 else 7, prose(k, 60)) for k in range(100) for _ in range(3)]
    random.Random(1).shuffle(rows)
    return rows


def test_numbers_stay(spark, folder, shaken):
    docs = documents(spark, folder, copies())
    split(spark, WIDE)
    one = {r.uid: r.text for r in identified(docs, {"text": F.col("text")}).collect()}
    split(spark, NARROW)
    two = {r.number: r.text for r in identified(docs, uid="number").collect()}
    assert one == two and len(one) == 300
    assert only_rows(docs, spark.createDataFrame([(u,) for u in list(one)[:50]], "uid long")).count() == 50


def test_rows_of_other_origin(spark, shaken):
    """A frame that is no file, or whose files' rows were multiplied, is written first."""
    made = spark.createDataFrame([(k % 3, "t") for k in range(20)], "uid long, file0 string")
    frame = identified(made, {"file0": F.col("file0"), "old": F.col("uid")})
    assert sorted(c for c in frame.columns) == ["file0", "old", "uid"] and frame.select("uid").distinct().count() == 20
    read = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for doubled in (read.union(read), read.withColumn("k", F.explode(F.array(F.lit(1), F.lit(2)))), read.join(read.select("doc_id"), "doc_id")):
        assert identified(doubled).select("uid").distinct().count() == doubled.count()


def test_one_row_of_each_group_stays(spark, folder, shaken):
    docs = documents(spark, folder, copies())
    assert sum(r.kept for r in exact_duplicates(docs).collect()) == 100
    for kept in (drop_exact_duplicates(docs), drop_near_duplicates(docs)):
        texts = [r.text for r in kept.collect()]
        assert len(texts) == len(set(texts)) == 100
    assert shaken[0] > 4


def test_archives_and_shards_hold_every_row(spark, folder, shaken):
    docs = documents(spark, folder, copies())
    pages = docs.select(F.xxhash64("doc_id", "text").alias("page_id"), F.lit("http://a/").alias("url"), F.col("text").alias("html"))
    rows = read_warc(spark, write_warc(pages, f"{folder}/warc", least=10)).collect()
    assert len(rows) == 300 and sum(r.record_type == "response" for r in rows) == 100
    placed = reshard(docs, F.pmod(F.length("text"), F.lit(3)), [1.0] * 4, f"{folder}/shards").collect()
    by_shard = {s: sorted(r.slot for r in placed if r.shard == s) for s in {r.shard for r in placed}}
    assert len(placed) == 300 and all(slots == list(range(len(slots))) for slots in by_shard.values())


def test_surrogates_drawn_again_reach_their_rows(spark, folder, shaken):
    real = [v + c for v in "AEIOUY" for c in "bcdfgh"]
    docs = documents(spark, folder, [(k, f"seen by Mr {n} today") for k, n in enumerate(real)])
    new = [r.text for r in with_surrogates(docs, "key", broadcast_bytes=0).select("text").collect()]
    assert len(set(new)) == len(real) and not set(new) & {f"seen by Mr {n} today" for n in real}


def test_a_shard_without_share_gives_up_its_rows(spark, folder):
    docs = documents(spark, folder, copies())
    placed = reshard(docs, F.pmod(F.length("text"), F.lit(3)), [1.0, 0.0, 1.0], f"{folder}/none").collect()
    assert len(placed) == 300 and {r.shard for r in placed} == {0, 2}
    assert DOCUMENTS and reshard(documents(spark, folder, []), F.lit(0), [1.0, 0.0], f"{folder}/empty").count() == 0
