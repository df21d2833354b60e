import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.cases import BYTE_BPE, prose
from tests.llm.test_jaccard_join import brute
from tidemark.llm.surrogates import found_entities
from tidemark.session import settle

DDL = "doc_id long, text string, lang string, source string, n_chars long"


def rows():
    out = []
    for k in range(120):
        text = prose(k, 80, 4000)
        if k % 10 == 1:
            text = prose(k - 1, 80, 4000)  # a copy
        elif k % 10 == 2:
            words = prose(k - 2, 80, 4000).split()
            words[40] = "other"  # a near copy
            text = " ".join(words)
        elif k % 10 == 3:
            text = f"reach me{k}@mail.example.com " + text
        elif k % 10 == 4:
            text = "same words again " * 40  # fails the base rules
        elif k % 10 == 5:
            text = " ".join(w + "#*" for w in text.split())  # labelled as bad
        out.append((k, text))
    return [(i, t, "en", f"s{i % 3}", len(t)) for i, t in out] + [(None, None, None, None, None), (500, "", "de", "s0", 0)]


def tables(spark, folder, docs):
    spark.createDataFrame(docs, DDL).repartition(3).write.parquet(f"{folder}/documents.parquet")
    labels = [(d[0], 0 if d[0] % 10 == 5 else 1, 0) for d in docs if d[0] is not None]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")


def test_stages_keep_columns_and_their_decisions_take_effect(spark, folder):
    docs = rows()
    tables(spark, folder, docs)
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        result = settle(stage(spark, frame, folder))
        if name != "packing":
            assert result.columns == frame.columns, name
            kept[name] = {r.doc_id: r.text for r in result.collect()}
        frame = result
    text = {d[0]: d[1] for d in docs}
    quality = set(kept["quality rules"])
    # so few labels prove no cutoff: the base rules alone decide
    assert quality == {d for d in text if d is not None and d < 500 and d % 10 != 4}
    exact = set(kept["exact dedup"])
    assert exact == {min(d for d in quality if text[d] == text[e]) for e in quality}
    near = brute([(d, text[d]) for d in sorted(exact)], 5, 80, 100)
    assert set(kept["n-gram Jaccard join"]) == {component for _, _, component in near} == {d for d in exact if d % 10 != 2}
    final = kept["PII surrogates"]
    for d, new in final.items():
        assert (new == text[d]) == (not found_entities(text[d]))
    assert all(f"me{d}@mail" not in final[d] for d in final if d % 10 == 3)
    library, pieces = Tokenizer.from_file(BYTE_BPE), {}
    for r in sorted(frame.collect(), key=lambda r: r.start):
        pieces.setdefault(r.doc_id, []).extend(np.frombuffer(bytes(r.ids), "<u4").tolist())
    assert pieces == {d: library.encode(t, add_special_tokens=False).ids + [1] for d, t in final.items()}


def test_run_and_empty_tables(spark, folder):
    docs = rows()
    tables(spark, f"{folder}/some", docs)
    tables(spark, f"{folder}/none", [])
    assert corpus_pipeline.run(spark, f"{folder}/some").select("doc_id").distinct().count() == 84
    assert corpus_pipeline.run(spark, f"{folder}/none").count() == 0


def test_registration():
    import __spark_entry__ as entry

    names = entry.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names
    assert len(corpus_pipeline.STAGES) == 5 and set(entry.oracle_sql()) <= set(names)
