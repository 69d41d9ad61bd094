import numpy as np
import pyarrow as pa
from plumbline.llm import embeddings

RNG = np.random.default_rng(2)


def vectors(spark, rows, kind=None):
    kind = kind or pa.float32()
    ids, values, labels = zip(*rows, strict=True) if rows else ((), (), ())
    table = {"vec_id": pa.array(ids, pa.int64()), "embedding": pa.array(values, pa.list_(kind)), "label": pa.array(labels, pa.int32())}
    table |= {n: pa.array(["?"] * len(rows), pa.string()) for n in ("v", "d", "node", "weight", "caps", "kept", "id")}
    return spark.createDataFrame(pa.table(table))


def slow(rows, cosine=0.98):
    usable = [
        (i, k, np.array(v, np.float64), label) for k, (i, v, label) in enumerate(rows)
        if label is not None and v and None not in v and np.isfinite(v).all() and np.any(v)
    ]
    links, parent = [0] * len(rows), list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (_, i, x, label) in enumerate(usable):
        for _, j, y, other in usable[a + 1 :]:
            if label == other and len(x) == len(y) and x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= cosine:
                links[i] += 1
                links[j] += 1
                parent[root(i)] = root(j)
    least = {}
    for k, (i, *_) in enumerate(rows):
        least[root(k)] = min(least.get(root(k), i), i)
    return sorted((i, links[k], least[root(k)], i == least[root(k)]) for k, (i, *_) in enumerate(rows))


def near(center, spread):
    x = np.asarray(center) + RNG.normal(0, spread, len(center))
    return (x / np.linalg.norm(x)).astype(np.float32).tolist()


def cloud(n=500, d=64):
    rows = []
    for c in range(12):
        center = near(np.zeros(d), 1)
        rows += [(len(rows) + k, near(center, [0.001, 0.01, 0.02][c % 3]), c % 2) for k in range([3, 10, 60][c // 4])]
    return rows + [(len(rows) + k, near(np.zeros(d), 1), k % 3) for k in range(n - len(rows))]


def found(df, **how):
    return sorted(tuple(r) for r in embeddings.near_vectors(df, **how).collect())


def test_all_links_are_found(spark):
    rows = cloud()
    got, want = found(vectors(spark, rows)), slow(rows)
    n, most = sum(r[1] for r in got), sum(r[1] for r in want)
    assert most > 3000 and n >= 0.999 * most
    assert all(a[1] <= b[1] for a, b in zip(got, want, strict=True))  # no link that is none


def test_blocks_give_the_same(spark):
    rows = cloud()
    assert found(vectors(spark, rows), block=7) == found(vectors(spark, rows))


def test_edges(spark):
    x = near(np.zeros(16), 1)
    rows = [
        (1, x, 1), (2, x, 1), (3, [2 * float(v) for v in x], 1), (4, x, 2), (5, x, None), (6, None, 1), (7, [0.0] * 16, 1), (8, [], 1),
        (9, [*x[:-1], None], 1), (10, [*x[:-1], float("nan")], 1), (11, [*x[:-1], float("inf")], 1), (12, x[:8], 1), (2, x, 1), (13, [-float(v) for v in x], 1),
        (14, [1.0, -0.0, 0.0], 1), (15, [1.0, 0.0, -0.0], 1), (16, [5.0], 1), (17, [1.0], 1), (18, [-1.0], 1),
    ]
    assert found(vectors(spark, rows)) == slow(rows)
    huge = [(1, [1e300, 1e300], 1), (2, [2e300, 2e300], 1), (3, [1e-300, 1e-300], 1)]
    assert [r[1] for r in found(vectors(spark, huge, pa.float64()))] == [2, 2, 2]
    assert found(vectors(spark, [])) == []


def test_caps_are_those_that_are_exceeded():
    units = np.array([near(np.zeros(10), 1) for _ in range(40)])
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    got = {(int(i), int(c)) for row, cap in embeddings.caps(units, 8, 2, 1.5, 3) for i, c in zip(row, cap, strict=True)}
    code, want = embeddings.product_code(10, 8, 2, 3), set()
    for r, deal in enumerate(embeddings.deals(10, 2, 3)):
        for i, u in enumerate(units[:, deal]):
            for a in range(8):
                for b in range(8):
                    if u[:5] @ code[r, 0, a] + u[5:] @ code[r, 1, b] >= 1.5 * np.sqrt(2 / 10):
                        want.add((i, (r * 8 + a) * 8 + b))
            if not any(i == j and c // 64 == r for j, c in want):
                a, b = (u[:5] @ code[r, 0].T).argmax(), (u[5:] @ code[r, 1].T).argmax()
                want.add((i, (r * 8 + int(a)) * 8 + int(b)))
    assert got == want and want
