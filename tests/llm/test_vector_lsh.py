import math
import random

import numpy as np

from tapewright.llm import vector_lsh as V

SCHEMA = "vec_id long, embedding array<float>, name string, ball int"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "x", 1) for i, v in rows], SCHEMA)


def brute(rows):
    """(id, links, component) of every row, by all pairs."""
    units = []
    for _, v in rows:
        good = v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)
        u = np.array(np.float32(v), np.float64) if good else None
        units.append(u / np.linalg.norm(u) if good else None)
    label = list(range(len(rows)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    links = [0] * len(rows)
    for i, a in enumerate(units):
        for j in range(i):
            b = units[j]
            if a is not None and b is not None and len(a) == len(b) and float(a @ b) >= 0.9:
                links[i] += 1
                links[j] += 1
                label[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (n, _) in enumerate(rows):
        if n is not None:
            least[find(i)] = min(least.get(find(i), n), n)
    return sorted(((n, links[i], least.get(find(i), n)) for i, (n, _) in enumerate(rows)), key=str)


def turned(rng, vector, cosine):
    """A vector at this cosine to another one."""
    other = rng.standard_normal(len(vector))
    other -= other @ vector * vector / (vector @ vector)
    return cosine * vector / np.linalg.norm(vector) + math.sqrt(1 - cosine**2) * other / np.linalg.norm(other)


def corpus(seed):
    rng = np.random.default_rng(seed)
    rows = [(i, rng.standard_normal(32)) for i in range(200)]
    for size, cosine in ((150, 0.995), (12, 0.99), (40, 0.985), (5, 0.98), (2, 0.99)):
        base = rng.standard_normal(32)
        rows += [(len(rows) + k, turned(rng, base, cosine) * rng.uniform(0.1, 9)) for k in range(size)]
    rows += [(1000 + k, rows[3][1]) for k in range(60)]
    rows += [(1100, None), (1101, []), (1102, [0.0] * 32), (1103, [1.0, None] * 16), (1104, [math.nan] * 32), (1105, [math.inf] * 32)]
    rows += [(1106, rows[7][1][:16]), (1107, rows[7][1][:16]), (7, rows[7][1]), (None, rows[7][1]), (None, [0.0] * 32)]
    random.Random(seed).shuffle(rows)
    return rows


def test_equals_brute_force(spark):
    rows = corpus(5)
    found = V.vector_report(frame(spark, rows)).collect()
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in found), key=str) == brute(rows)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found)


def test_recall_at_the_threshold(spark):
    rng = np.random.default_rng(8)
    rows = []
    for k in range(300):
        base = rng.standard_normal(64)
        rows += [(2 * k, base), (2 * k + 1, turned(rng, base, 0.901))]
    want = sum(n for _, n, _ in brute(rows))
    got = sum(r["n_links"] for r in V.vector_report(frame(spark, rows)).collect())
    assert 0.9 * want <= got <= want


def test_parameters_follow_the_number_of_vectors():
    assert V.tables(1000)[0] < V.tables(1_000_000)[0]
    for count in (1000, 1_000_000):
        hashes, number = V.tables(count)
        assert 1 - (1 - V._meets(V.WIDTH) ** hashes) ** number >= V.RECALL


def test_empty(spark):
    assert V.vector_report(frame(spark, [])).count() == 0
    assert V.vector_report(frame(spark, [(3, None)])).collect()[0][:] == (3, 0, 3, True)
