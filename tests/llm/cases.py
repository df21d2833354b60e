"""Rows that every document operator must bear, and readers of results."""

from __future__ import annotations

import random

import public_tokenizers

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
CLASHING = "uid long, rep long, n long, data string, kept boolean, shard int, _shard int, block int, parts int, `odd name.x` string"
DOCUMENTS = f"doc_id long, text string, lang string, source string, {CLASHING}"
_EXTRA = (7, 7, 7, "d", True, 3, 3, 3, 3, "odd")


def prose(seed: int, words: int, vocabulary: int = 300) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(["w", "Ab", "né", "x"]) + str(rng.randrange(vocabulary)) for _ in range(words))


def texts() -> list[tuple[int | None, str | None]]:
    base = prose(1, 120)
    near = base.split()
    near[60] = "changed"
    return [
        (1, base), (2, base), (9, base), (3, " ".join(near)), (4, prose(2, 80)), (5, prose(2, 80) + " tail"),
        (6, None), (7, ""), (8, ""), (10, " \t\n "), (11, "one"), (12, "One two"),
        (13, prose(3, 30_000)), (14, "a" * 90_000), (15, "ab" * 40_000 + " end"), (16, "中文" * 50),
        (17, "line\nline\nline\n" * 30), (None, base), (None, None), (20, prose(4, 60)), (20, prose(4, 60)),
        (20, prose(5, 60)), (21, "mail me@site.example.com or +1 (555) 123-4567, again me@site.example.com"),
        (22, "<|endoftext|> and <|startoftext|> inside  two   blanks and more"),
    ]


def written(spark, folder: str, rows: list[tuple], ddl: str, files: int = 3):
    """The rows as files, read back, as every query reads its table."""
    path = f"{folder}/{random.getrandbits(64):x}"
    spark.createDataFrame(rows, ddl).repartition(files).write.parquet(path)
    return spark.read.schema(ddl).parquet(path)


def documents(spark, folder: str, rows: list[tuple] | None = None):
    rows = texts() if rows is None else rows
    return written(spark, folder, [(i, t, "en", f"s{k % 3}", *_EXTRA) for k, (i, t) in enumerate(rows)], DOCUMENTS)
