import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.cases import documents, texts, written
from tidemark.llm.resharding import reshard, solve_transfers, whole_blocks


def test_the_flow_moves_the_fewest_bytes():
    rng = np.random.default_rng(4)
    for _ in range(40):
        n, k = 5, 3
        sizes = rng.integers(1, 6, n).astype(float)
        resident = np.zeros((n, k))
        for b in range(n):
            resident[b] = rng.multinomial(int(sizes[b]), [0.3, 0.3, 0.2, 0.2])[:k]
        capacities = np.full(k, np.ceil(sizes.sum() / k))
        flow = solve_transfers(resident, sizes, capacities)
        assert np.allclose(flow.sum(axis=1), sizes) and (flow.sum(axis=0) <= capacities + 1e-6).all()
        moved = (flow * (1 - resident / sizes[:, None])).sum()
        # no whole assignment within the capacities is better than the flow
        for choice in itertools.product(range(k), repeat=n):
            if (np.bincount(choice, sizes, k) <= capacities).all():
                assert moved <= sum(sizes[b] - resident[b, s] for b, s in enumerate(choice)) + 1e-6
        shard = whole_blocks(flow, sizes, capacities)
        assert all(flow[b, s] > 0 for b, s in enumerate(shard))


def test_nothing_moves_that_fits():
    resident = np.array([[4.0, 0], [0, 4], [4, 0], [0, 4]])
    flow = solve_transfers(resident, np.full(4, 4.0), np.full(2, 8.0))
    assert (flow == resident).all()


@pytest.mark.parametrize("shards", [1, 3])
def test_documents(spark, folder, shards):
    old = F.when(F.col("source") == "s0", 0).when(F.col("source") == "s1", 9)
    docs = documents(spark, folder)
    found = reshard(docs, old, [1.0] * shards, f"{folder}/new", blocks=64).collect()
    key = lambda r: tuple(map(str, r))
    expected = [(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts()]
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in found), key=key) == sorted(expected, key=key)
    for s in range(shards):
        assert sorted(r.slot for r in found if r["shard"] == s) == list(range(sum(r["shard"] == s for r in found)))
    written = spark.read.parquet(f"{folder}/new")
    assert set(docs.columns) <= set(written.columns)


def test_loads_are_even_and_untouched_shards_stay(spark, folder):
    rows = [(k, f"text {k} " + "x" * (k % 50)) for k in range(4000)] + [(9000 + k, "hot " * 20) for k in range(1500)]
    docs = documents(spark, folder, rows)
    found = reshard(docs, F.lit(0), [1.0] * 4, f"{folder}/even").toPandas()
    loads = found.groupby("shard")["size"].sum()
    assert loads.max() < 1.02 * loads.min()
    same = reshard(docs, F.pmod(F.col("doc_id"), F.lit(1)), [1.0], f"{folder}/same").toPandas()
    assert len(same) == len(rows) and not list((__import__("pathlib").Path(folder) / "same").glob("*/*.parquet"))


def test_a_large_group_that_the_flow_splits_is_dealt_by_row(spark, folder):
    # five groups for two shards, each under half of one, so that one has to be split
    rows = [(k, f"text {k}") for k in range(300)] + [(1000 * g + k, f"hot {g} " * 20) for g in range(1, 6) for k in range(400)]
    found = reshard(documents(spark, folder, rows), F.lit(0), [1.0] * 2, f"{folder}/even").toPandas()
    loads = found.groupby("shard")["size"].sum()
    assert len(found) == len(rows) and loads.max() < 1.03 * loads.min()


def test_shards_do_not_depend_on_the_files(spark, folder):
    rows = [(k, f"text {k} " + "x" * (k % 50)) for k in range(1500)] + [(9000 + k, "hot " * 20) for k in range(1000)]
    found = [reshard(written(spark, folder, rows[::step], "doc_id long, text string", files), F.lit(0), [1.0] * 4, f"{folder}/{files}").select(
        "doc_id", "shard", "slot").collect() for files, step in ((1, 1), (5, -1))]
    assert len(found[0]) == len(rows) and sorted(found[0]) == sorted(found[1])


def test_a_crowd_of_equal_rows_fills_all_shards(spark, folder):
    rows = [(k, f"text {k} " + "x" * (k % 50)) for k in range(600)] + [(None, "hot " * 20)] * 300 + [(7, "hot " * 20)] * 300
    found = reshard(documents(spark, folder, rows), F.lit(0), [1.0] * 4, f"{folder}/even").toPandas()
    loads = found.groupby("shard")["size"].sum()
    assert len(found) == len(rows) and loads.max() < 1.15 * loads.min()
    assert (found.groupby("shard")["slot"].max() + 1 == found.groupby("shard").size()).all()


@pytest.mark.parametrize("shards", [2, 3])
def test_rounded_moves_against_all_assignments(spark, folder, shards):
    """Of few whole blocks: the rows land where the flow says, and no placement as even moves fewer bytes."""
    rng = np.random.default_rng(shards)
    rows = [(k, "y" * int(n)) for k, n in enumerate(rng.permutation(np.arange(20, 160, 20)))]
    sizes, old = np.array([len(t) + 1 for _, t in rows], float), np.arange(len(rows)) % shards
    docs = documents(spark, folder, rows)
    found = reshard(docs, F.pmod("doc_id", F.lit(shards)), [1.0] * shards, f"{folder}/new", blocks=1 << 20).toPandas()
    shard = found.set_index("doc_id")["shard"].reindex(range(len(rows))).to_numpy()
    worst = np.bincount(shard, sizes, shards).max()
    moved = sizes[shard != old].sum()
    resident = np.zeros((len(rows), shards))
    resident[np.arange(len(rows)), old] = sizes
    flow = solve_transfers(resident, sizes, np.full(shards, sizes.sum() / shards))
    assert (flow[np.arange(len(rows)), shard] > 0).all() or worst <= np.ceil(sizes.sum() / shards) + sizes.max()
    least = min(sum(sizes[b] for b, s in enumerate(choice) if s != old[b]) for choice in itertools.product(range(shards), repeat=len(rows))
                if np.bincount(choice, sizes, shards).max() <= worst)
    assert moved <= least + sizes.max()


def test_empty_table(spark, folder):
    assert reshard(documents(spark, folder, []), F.lit(0), [1.0, 1.0], f"{folder}/none").count() == 0
