"""The registered queries on the smallest tables, against SQL or brute force."""

import hashlib
import html
import re
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tests.compare import difference, duck
from tests.llm.cases import BYTE_BPE, WORD_BPE
from tests.llm.test_jaccard_join import brute as linked
from tests.llm.test_quality import brute as counted
from tidemark.llm.queries import ORACLE, QUERIES
from tidemark.llm.surrogates import found_entities

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(SF)


@pytest.fixture(scope="module")
def documents(connection):
    return connection.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()


def run(spark, name, types):
    frame = QUERIES[name](spark, SF)
    kinds = dict(frame.dtypes)
    assert {c: kinds[c] for c in types} == types
    return frame


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, connection, name):
    assert difference(QUERIES[name](spark, SF).toPandas(), connection.execute(ORACLE[name]).df()) is None


def test_round_trip(spark, documents):
    frame = run(spark, "op2_bpe_round_trip", {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"})
    library = Tokenizer.from_file(WORD_BPE)
    expected = []
    for doc_id, text in documents:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        expected.append((doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                         hashlib.sha256(decoded.encode()).hexdigest()))
    assert sorted(map(tuple, frame.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect())) == sorted(expected)


def test_packing(spark, documents):
    rows = run(spark, "op3_power_packing", {
        "doc_id": "bigint", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "doc_tokens": "bigint",
        "sequence_id": "bigint", "offset": "bigint"}).collect()
    library, text = Tokenizer.from_file(BYTE_BPE), dict(documents)
    ids = {d: np.array(library.encode(t or "", add_special_tokens=False).ids + [1], "<u4") for d, t in text.items()}
    assert len({r.sequence_id for r in rows}) == len(rows)
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start:r.start + r.length].tobytes())
        assert r.doc_tokens == len(ids[r.doc_id]) and r.offset == 0 and r.length <= 2048 and r.length & (r.length - 1) == 0
    assert sum(r.length for r in rows) == sum(map(len, ids.values()))


def test_toxicity(spark, connection):
    rows = run(spark, "op4_toxicity_chain", {"doc_id": "bigint", "is_toxic": "boolean", "p_toxic": "double"}).collect()
    label = dict(connection.execute("SELECT doc_id, toxic FROM labels").fetchall())
    wrong = sum(r.is_toxic != bool(label[r.doc_id]) for r in rows if r.doc_id in label)
    assert len(rows) == connection.execute("SELECT count(*) FROM documents").fetchone()[0] and wrong <= 0.1 * len(label)


def test_main_text(spark, connection):
    rows = run(spark, "op6_template_text", {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"}).collect()
    pages = dict(connection.execute("SELECT page_id, html FROM pages").fetchall())
    assert len(rows) == len(pages)
    for r in rows:
        body = pages[r.page_id].partition("<article>")[2].partition("</article>")[0]
        body = re.sub("</?b>", "", re.sub("</?(?:p|br|h1)>", " ", body))
        assert r.text == " ".join(html.unescape(body).split()) and r.n_chars == len(r.text)


def test_shards(spark, documents):
    frame = run(spark, "op7_flow_resharding", {
        "doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint",
        "grown_shard": "int"}).toPandas()
    text = {d: (t or "").encode() for d, t in documents}
    assert sorted(frame["doc_id"]) == sorted(text) and set(frame["law"]) == {"bytes"} and frame["grown_shard"].isna().all()
    assert all(s == len(text[d]) + 1 and c == zlib.crc32(text[d]) for d, s, c in zip(frame["doc_id"], frame["size"], frame["text_crc32"]))
    loads = frame.groupby("shard")["size"].sum()
    assert list(loads.index) == list(range(8)) and loads.max() - loads.min() <= 2 * frame["size"].max()
    assert all(sorted(g["slot"]) == list(range(len(g))) for _, g in frame.groupby("shard"))
    assert (frame.assign(text=frame["doc_id"].map(text)).groupby("text")["shard"].nunique() == 1).all()


def test_surrogates(spark, documents):
    rows = run(spark, "op8_pii_surrogates", {"doc_id": "bigint", "text": "string", "n_entities": "bigint"}).collect()
    text, new_of = dict(documents), {}
    assert sorted(r.doc_id for r in rows) == sorted(text)
    for r in rows:
        old, new = found_entities(text[r.doc_id]), found_entities(r.text)
        assert r.n_entities == len(old) and [e[2] for e in old] == [e[2] for e in new]
        assert old or r.text == text[r.doc_id]
        for before, after in zip(old, new):
            assert before[3] not in r.text and new_of.setdefault(before[2:], after[3]) == after[3]
    assert len(set(zip((k for k, _ in new_of), new_of.values()))) == len(new_of)


def test_join(spark, documents):
    rows = run(spark, "op9_jaccard_join", {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"})
    assert sorted(map(tuple, rows.collect())) == sorted(linked(documents, 3, 90, 100))


def test_quality(spark, documents):
    rows = run(spark, "op10_quality_rules", {
        "doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint",
        "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean"}).collect()
    text = dict(documents)
    for r in rows:
        expected = counted(text[r.doc_id] or "")
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected
        assert r.base_failed == (expected[0] < 50 or 100 * expected[4] > 50 * expected[0]) and not (r.base_failed and r.kept)
    assert len(rows) == len(text)
