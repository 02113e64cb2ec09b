"""The curation queries against their SQL, and operators against small models."""

import random

import pytest

from quarry.operators import pairs, ranks
from quarry.operators.bursts import assign_bursts
from quarry.operators.independent import greedy_keep
from quarry.operators.pairs import hamming_pairs
from quarry.operators.ranks import robust_rank
from quarry.plans import fixtures, queries

SF = "/root/testdata/sf0.001"
TABLES = "part lineitem events documents embeddings pages labels"


@pytest.fixture(scope="module")
def duck():
    import duckdb

    c = duckdb.connect()
    for name in TABLES.split():
        c.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_as_sql(spark, duck, name):
    def key(rows, columns, wanted):
        at = [columns.index(c) for c in wanted]
        return sorted((tuple(r[i] for i in at) for r in rows), key=str)

    got = queries.QUERIES[name](spark, SF)
    rows = duck.execute(queries.ORACLES[name])
    columns = [d[0] for d in rows.description]
    assert sorted(columns) == sorted(got.columns)
    assert key([tuple(r) for r in got.collect()], got.columns, sorted(columns)) == key(rows.fetchall(), columns, sorted(columns))


def test_rank_cases(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 2.0), (3, 5.0), (4, None), (5, float("nan")), (6, float("inf")), (7, -float("inf"))], "i int, v double")
    got = {r["i"]: r["r"] for r in robust_rank(df, "v", "r").collect()}
    assert got == {1: 0.25, 2: 0.25, 3: 1.0, 4: 0.5, 5: 0.5, 6: 0.5, 7: 0.5}
    same = spark.createDataFrame([(1, 2.0), (2, 2.0)], "i int, v double")
    assert {r["r"] for r in robust_rank(same, "v", "r").collect()} == {0.5}


def test_ranks_of_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(ranks, "RANGE_VALUES", 7)
    values = [random.Random(9).randrange(60) for _ in range(300)]
    got = {r["i"]: r["r"] for r in robust_rank(spark.createDataFrame(list(enumerate(map(float, values))), "i int, v double"), "v", "r").collect()}
    at = sorted(values)
    assert all(abs(got[i] - (at.index(v) + (at.count(v) - 1) / 2) / 299) < 1e-12 for i, v in enumerate(values))


def test_long_chain_of_bursts(spark):
    times = sorted(random.Random(3).choices(range(4000), k=3000))
    df = spark.createDataFrame([("d", t, f"{i:05d}") for i, t in enumerate(times)], "dir string, t long, id string").repartition(5)
    got = {r["id"]: (r["burst_start"], r["burst_size"]) for r in assign_bursts(df, ["dir"], "t", "id", 3, 50).collect()}
    starts, last, start = [], None, None
    for t in times:
        if last is None or t - last > 3 or t - start > 50:
            start = t
        last = t
        starts.append(start)
    assert got == {f"{i:05d}": (s, starts.count(s)) for i, s in enumerate(starts) if starts.count(s) > 1}


def test_greedy_keep_is_sequential(spark):
    rng = random.Random(4)
    edges = {tuple(sorted(rng.sample(range(40), 2))) for _ in range(60)}
    kept: list[int] = []
    for i in range(40):
        if not any((min(i, k), max(i, k)) in edges for k in kept):
            kept.append(i)
    nodes = spark.createDataFrame([(i, i) for i in range(40)], "id long, rank long")
    got = greedy_keep(nodes, spark.createDataFrame(sorted(edges), "a long, b long"))
    assert sorted(r["id"] for r in got.where("keep").collect()) == kept


def test_hamming_pairs_are_exact(spark, monkeypatch):
    rng = random.Random(5)
    codes = [rng.getrandbits(63) for _ in range(40)]
    codes += [c ^ (1 << rng.randrange(63)) ^ (1 << rng.randrange(63)) for c in codes]
    want = {(i, j, (codes[i] ^ codes[j]).bit_count()) for i in range(80) for j in range(i + 1, 80) if (codes[i] ^ codes[j]).bit_count() <= 8}
    df = spark.createDataFrame(list(enumerate(codes)), "i long, c long")
    assert sorted(tuple(r) for r in hamming_pairs(df, "i", "c", 8).collect()) == sorted(want)
    monkeypatch.setattr(pairs, "bands", lambda radius, rows: (3, 2))
    assert sorted(tuple(r) for r in hamming_pairs(df, "i", "c", 8).collect()) == sorted(want)


def test_short_tables_are_not_broadcast_with_their_keys(spark, tmp_path):
    """A table of a few KB on disk has hundreds of keys a row, and an events table is mostly other columns: neither goes through the driver."""
    spark.range(3000).selectExpr("id AS i", "xxhash64(id) & 9223372036854775807 AS c").write.parquet(str(tmp_path / "codes"))
    df = spark.read.parquet(str(tmp_path / "codes"))
    for plan in (hamming_pairs(df, "i", "c", 18), fixtures.records(spark, SF).select("record_id")):
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in text and "Broadcast" not in text


def test_pair_joins_grow_with_the_rows():
    """Keys and chance meetings a row, of the bands chosen, at the reference's radius."""
    from math import comb

    def each(rows):
        m, flips = pairs.bands(8, rows)
        keys = m * sum(comb(pairs.BITS // m + 1, i) for i in range(flips + 1))
        return keys + rows * keys / 2.0 ** (pairs.BITS // m)

    assert each(10**6) < 6 * each(10**4) and pairs.bands(8, 10**4) != pairs.bands(8, 10**6)


def test_cells_without_near_pairs_hold_their_own_rows(spark):
    """Rows around far apart centres visit no other cell, so rows that meet are within one centre."""
    import numpy as np

    rng, rows = np.random.default_rng(1), []
    for i in range(400):
        v = np.eye(8)[i % 8] + rng.normal(scale=0.02, size=8)
        rows.append((i, (v / np.linalg.norm(v)).tolist()))
    df = spark.createDataFrame(rows, "i long, v array<double>")
    got = pairs.cosine_pairs(df, "i", "v", 0.9995, pivots=40)
    v = np.array([r[1] for r in rows])
    assert {(r["a"], r["b"]) for r in got.collect()} == {(int(a), int(b)) for a, b in zip(*np.nonzero(np.triu(v @ v.T >= 0.9995, 1)))}


def test_selection_picks(spark):
    rows = queries.select_greedy_train(spark, SF).collect()
    assert [r["pick"] for r in sorted(rows, key=lambda r: r["pick"])] == list(range(1, 41)) and len({r["record_id"] for r in rows}) == 40


def test_validation_picks_share_nothing(spark):
    train = {r["record_id"] for r in queries.select_greedy_train(spark, SF).collect()}
    rows = queries.select_greedy_validate(spark, SF).collect()
    assert len(rows) <= 8 and not train & {r["record_id"] for r in rows}


def test_tables_are_swept_and_kept_off_local_disks(spark, tmp_path, monkeypatch):
    import os

    from quarry import tables

    tables.sweep(spark)
    t = tables.kept_table(spark.range(5), "five")
    top = tables.shared_dir(spark).removeprefix("file://")
    assert t.count() == 5 and any(n.startswith("quarry-five-") for n in os.listdir(top))
    tables.sweep(spark)
    assert not any(n.startswith("quarry-five-") for n in os.listdir(top))

    class Cluster:
        conf = type("", (), {"get": staticmethod(lambda k, d: d)})
        sparkContext = type("", (), {"master": "yarn"})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        tables.shared_dir(Cluster)
