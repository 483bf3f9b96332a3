"""Hard negatives against all pairs, with ties, repeats, nulls, zero and negative scores and blocks of anchors."""

import itertools
from collections import Counter

import numpy as np
import pytest

from jobloom.llm import hard_negatives, queries

SCHEMA = "vec_id long, embedding array<float>, label int, score string, key string, block int"


def brute(rows, asked, scale=256, positives=5, negatives=10, low=30, high=90):
    fine = [(i, v, c) for i, v, c in rows if c is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    fine = [(i, [int(np.floor(scale * float(np.float32(x)))) for x in v], c) for i, v, c in fine]
    place = lambda i: (i is not None, i or 0)
    out = Counter()
    done = set()
    for at, (i, v, c) in enumerate(fine):
        if i is None or not asked(i) or (i, tuple(v), c) in done:
            continue
        done.add((i, tuple(v), c))
        scored = [(sum(a * b for a, b in zip(v, w)), j, d) for n, (j, w, d) in enumerate(fine) if n != at]
        scored.sort(key=lambda x: (-x[0], place(x[1])))
        for ps, p, _ in [x for x in scored if x[2] == c][:positives]:
            window = [x for x in scored if x[2] != c and low * ps <= 100 * x[0] <= high * ps][:negatives]
            out.update((i, p, r + 1, n, ps, s) for r, (s, n, _) in enumerate(window))
    return out


def mined(df, asked="vec_id % 3 = 0", **more):
    got = hard_negatives.mine(df, df.where(asked), **more)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return Counter(map(tuple, got.collect()))


def made(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, c, "s", "k", 1) for i, v, c in rows], SCHEMA).repartition(parts)


def test_all_pairs_of_random_rows(spark):
    rng = np.random.default_rng(5)
    for dims, n in ((2, 60), (6, 150)):
        # Few distinct components: many ties, zeros and negative scores.
        rows = [(int(i), (rng.integers(-3, 4, dims) / 256).tolist(), int(rng.integers(0, 3))) for i in rng.permutation(n)]
        want = brute(rows, lambda i: i % 3 == 0)
        df = made(spark, rows, 4)
        assert want and mined(df) == want
        assert mined(df, block_bytes=2000, bound_partitions=1) == want


def test_a_positive_at_zero_has_negatives_before_it(spark):
    rows = [(3, [0.0, 1.0], 1), (9, [1.0, 0.0], 1), (1, [1.0, 0.0], 2), (2, [2.0, 0.0], 2), (10, [3.0, 0.0], 2), (4, [0.0, -1.0], 1)]
    assert mined(made(spark, rows)) == brute(rows, lambda i: i % 3 == 0)
    assert mined(made(spark, rows), negatives=2) == brute(rows, lambda i: i % 3 == 0, negatives=2)


def test_edges(spark):
    rng = np.random.default_rng(6)
    v = lambda: rng.normal(size=4).astype(np.float32).tolist()
    rows = [(i, v(), i % 2) for i in range(30)]
    rows += [(30, None, 1), (33, v(), None), (36, [1.0, None, 1.0, 1.0], 0), (39, [float("nan")] * 4, 0), (42, [float("inf")] * 4, 1), (None, v(), 0), (None, v(), 1)]
    rows += [rows[3], rows[3], rows[8], (6, v(), 0), (6, v(), 1), (45, [], 0), (48, [0.5], 1), (51, [*v(), 9.0, 9.0], 1), (54, [3e30] * 4, 0), (55, [2e30] * 4, 1)]
    want = Counter()
    for key, n in brute(rows, lambda i: i % 3 == 0).items():
        i, p, r, neg, ps, s = key
        want[i, p, r, neg, *(int(np.clip(x, -(2**63) + 1, 2**63 - 1)) for x in (ps, s))] += n
    got = mined(made(spark, rows))
    assert {k for k in got if abs(k[4]) < 2**60 and abs(k[5]) < 2**60} == {k for k in want if abs(k[4]) < 2**60 and abs(k[5]) < 2**60}
    none = made(spark, rows).where("false")
    assert not mined(none) and not mined(made(spark, rows), "vec_id < 0") and hard_negatives.mine(none, made(spark, rows)).count() == 0
    with pytest.raises(ValueError):
        hard_negatives.mine(none, none, low=50, high=40)


def test_registered_query_against_its_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.execute("CREATE VIEW embeddings AS SELECT * FROM '/root/testdata/sf0.001/embeddings.parquet'")
    got = queries.op11_hard_negatives(spark, "/root/testdata/sf0.001")
    want = con.execute(queries.oracle_sql()["op11_hard_negatives"])
    names = [d[0] for d in want.description]
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(want.fetchall())
    assert got.count() > 100 and not [k for k, n in Counter(map(tuple, got.select("anchor_id", "positive_id", "rank").collect())).items() if n > 1]
    assert list(itertools.islice(names, 2)) == ["anchor_id", "positive_id"]
