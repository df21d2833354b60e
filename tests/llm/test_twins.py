"""The queries with long SQL twins over random tables with missing values, ties, repeated rows and blanks."""

import random

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tests.compare import difference
from tidemark.llm.queries import ORACLE, QUERIES


def compare(spark, folder, name, **tables):
    connection = duckdb.connect()
    for table, rows in tables.items():
        path = f"{folder}/{table}.parquet"
        pq.write_table(rows, path)
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    found = QUERIES[name](spark, folder).toPandas()
    assert difference(found.copy(), connection.execute(ORACLE[name]).df()) is None
    return found


def table(columns, rows, **types):
    kinds = {"doc_id": pa.int64(), "conv_id": pa.int64(), "turn": pa.int64(), "quality": pa.int32(), "toxic": pa.int32()}
    schema = pa.schema([(c, kinds.get(c, pa.string())) for c in columns])
    return pa.table([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)


DOCS = ["doc_id", "lang", "source", "text"]


def test_conversations(spark, folder):
    rng = random.Random(5)
    texts = ["", " \n", "yes.", "no", "why?  ", "wow!\t", "a.b", "Ü.", None, "end.\x0b", "…", "x\n."]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "User", "admin"]
    rows = [(c, rng.choice([None, *range(12)]) if rng.random() < 0.2 else t, rng.choice(roles), rng.choice(texts))
            for c in [None, *range(300)] for t in range(rng.choice([1, 1, 2, 3, 5, 9, 14]))]
    found = compare(spark, folder, "op13_audited_conversations", conversations=table(["conv_id", "turn", "role", "text"], rows))
    assert len(found) == 301 and set("".join(found["audit"])) == set("KRD")  # to delete a row costs less than to insert one
    assert (found["illegal"] > 0).any() and (found["cost"] == 0).any()


def test_conversations_of_an_empty_table(spark, folder):
    assert not len(compare(spark, folder, "op13_audited_conversations", conversations=table(["conv_id", "turn", "role", "text"], [])))


def test_spellings(spark, folder):
    rng = random.Random(6)
    words = ["".join(rng.choices("abé", k=rng.choice([4, 5, 5, 6, 7]))) for _ in range(150)]
    weights = [2 ** rng.randrange(8) for _ in words]
    rows = [(k, "en", "s", " ".join(rng.choices(words, weights, k=60))) for k in range(100)]
    rows += [(None, None, None, "Éaaab ABABA ababa×ababa÷ababa"), (7, "en", "s", None), (8, "en", "s", ""), (9, "en", "s", "ababaĀababa 1ababa_")]
    found = compare(spark, folder, "op12_spelling_variants", documents=table(DOCS, rows))
    assert found["form"].notna().sum() > 5 and (found["root"] != found["word"]).any() and (found["n_near"] > 1).any()


def test_joins(spark, folder):
    rng = random.Random(7)
    words = [f"w{k}" for k in range(40)]
    first = [rng.choices(words, k=rng.choice([1, 2, 3, 12, 40, 80])) for _ in range(25)]
    rows = []
    for text in first:
        for _ in range(rng.choice([1, 2, 5])):
            text = list(text)
            if rng.random() < 0.7:
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append((len(rows), "en", "s", rng.choice([" ", "\n", "\t  "]).join(text if rng.random() < 0.8 else map(str.upper, text))))
    rows += [(900, "en", "s", None), (901, "en", "s", ""), (902, "en", "s", " \x0b"), (903, "en", "s", "w1 w2"), (904, "en", "s", "É é")]
    found = compare(spark, folder, "op9_jaccard_join", documents=table(DOCS, rows))
    assert 10 < found["component_id"].nunique() < len(rows) - 5


@pytest.mark.parametrize("labelled", [True, False])
def test_quality(spark, folder, labelled):
    # in one language good and bad documents differ in their symbols, in another in their copied lines; a third has few labels
    rng = random.Random(8)
    rows, labels = [], []
    for k in range(6600):
        lang = ("aa", "bb", None if k % 2 else "cc")[0 if k < 3200 else 1 if k < 6400 else 2]
        good = rng.random() < 0.8
        words = rng.choices(["word", "Text", "ÄRGER", "so", "LOUD", "end!", "why?"] + [f"n{x}" for x in range(200)], k=rng.choice([52, 55, 60] if good else [20, 55]))
        if lang == "aa" and (not good or rng.random() < 0.0005):
            words = [w + rng.choice(["#", "$%", "<>"]) for w in words]
        text = " ".join(words)
        if lang == "bb":
            text = "\n".join(words if good else [w for word in words for w in (word, "same")])
        rows.append((k, lang, "s", text))
        if labelled and rng.random() < 0.98:
            labels.append((k, int(good), 0))
    labels += [(labels[0][0], 0, 0), (None, 1, 0), (99999, 1, 0), (5, None, 0)] if labelled else []
    rows += [(9000, "aa", "s", None), (9001, "aa", "s", " \n\n "), (9002, "aa", "s", "a b c " * 30)]
    found = compare(spark, folder, "op10_quality_rules", documents=table(DOCS, rows), labels=table(["doc_id", "quality", "toxic"], labels))
    assert labelled == (found["failed_rule"].nunique() > 1)
