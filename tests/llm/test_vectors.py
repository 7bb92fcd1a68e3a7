import numpy as np
import pytest

from wardflow.llm import vectors

NAN, INF = float("nan"), float("inf")


def brute(rows, threshold=0.93):
    usable = [i for i, (_, v, label) in enumerate(rows) if label is not None and v
              and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = {i: [] for i in range(len(rows))}
    for i in usable:
        for j in usable:
            a, b = np.array(rows[i][1], float), np.array(rows[j][1], float)
            if i != j and rows[i][2] == rows[j][2] and len(a) == len(b):
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= threshold:
                    links[i].append(j)
    out = []
    for i, (vec, _, _) in enumerate(rows):
        reach, todo = {i}, [i]
        while todo:
            new = set(links[todo.pop()]) - reach
            reach |= new
            todo += new
        least = min((rows[j][0] for j in reach if rows[j][0] is not None), default=None)
        out.append((vec, len(links[i]), least))
    return sorted(out, key=repr)


def found(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, kept int")
    out = vectors.near_vectors(df).collect()
    assert all(r.kept == (r.component_id in (None, r.vec_id)) for r in out)
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in out), key=repr)


def test_groups_among_noise(spark, monkeypatch):
    """Pairs, a group far larger than a neighbour list, copies, and everything else apart."""
    monkeypatch.setattr(vectors, "TILE", 32)
    rng = np.random.default_rng(5)
    bases = list(rng.standard_normal((300, 24)))
    every = bases + [b + 0.05 * rng.standard_normal(24) for b in bases[:20]]
    every += [bases[30] + 0.08 * rng.standard_normal(24) for _ in range(90)] + [bases[31]] * 30
    rows = [(i, [float(np.float32(x)) for x in v], i % 2 if i < 300 else 0, 1)
            for i, v in enumerate(every)]
    want = brute([r[:3] for r in rows])
    got = found(spark, rows)
    assert got == want and max(n for _, n, _ in got) > 60


def test_dense_groups_joined_by_one_pair(spark):
    """The pair is the worst entry of both its lists, so no list of bounded length holds it."""
    rng = np.random.default_rng(8)

    def group(degrees, n):
        at = np.zeros(24)
        at[:2] = np.cos(np.radians(degrees)), np.sin(np.radians(degrees))
        noise = rng.standard_normal((n, 24)) * 0.02
        noise[:, :2] = 0
        return list(at + noise)

    every = group(0, 2500) + group(15, 1) + group(50, 2500) + group(35, 1) + group(120, 2500)
    units = np.stack([v / np.sqrt(v @ v) for v in np.float64(np.float32(every))])
    links = units @ units.T >= 0.93
    assert links[:2501, 2501:5002].sum() == 1 and not links[:5002, 5002:].any()
    rows = [(i, [float(np.float32(x)) for x in v], 0, 1) for i, v in enumerate(every)]
    got = found(spark, rows)
    assert [(i, n) for i, n, _ in sorted(got)] == [(i, int(n) - 1) for i, n in enumerate(links.sum(1))]
    assert {(c, i >= 5002) for i, _, c in got} == {(0, False), (5002, True)}


def test_edges(spark):
    rows = [(1, [1.0, 0.0], 0, 1), (2, [2.0, 0.0], 0, 1), (2, [2.0, 0.0], 0, 1), (3, None, 0, 1),
            (4, [0.0, 0.0], 0, 1), (5, [1.0, None], 0, 1), (6, [NAN, 1.0], 0, 1), (7, [INF, 1.0], 0, 1),
            (8, [1.0, 0.0], None, 1), (9, [1.0, 0.0], 1, 1), (10, [1.0], 0, 1), (11, [], 0, 1),
            (None, [1.0, 0.0], 0, 1), (12, [0.0, 1.0], 0, 1)]
    assert found(spark, rows) == brute([r[:3] for r in rows])
    assert found(spark, []) == []


def test_recall_is_measured_against_all_rows(spark):
    rows = [(i, "g", np.eye(4)[i % 2].tobytes(), 1) for i in range(8)]
    classes = spark.createDataFrame(rows, "key long, grp string, unit binary, times long")
    links = spark.createDataFrame([(i, 3) for i in range(4)], "key long, links long")
    assert vectors.audited_recall(classes, links, 0.93) == 0.5


def test_a_large_group_does_not_hide_missed_pairs(spark):
    """All links of a large group are found and none of the pairs elsewhere."""
    eye = np.eye(64)
    rows = [(i, "g", (eye[0] + i * 1e-6 * eye[1]).tobytes(), 1) for i in range(400)]
    rows += [(400 + i, "g", (eye[2 + i // 2] + i % 2 * 1e-6 * eye[1]).tobytes(), 1) for i in range(20)]
    classes = spark.createDataFrame(rows, "key long, grp string, unit binary, times long")
    links = spark.createDataFrame([(i, 399) for i in range(400)], "key long, links long")
    assert vectors.audited_recall(classes, links, 0.93, 64) == 0.0


def test_rare_links_are_looked_for_in_larger_samples(spark):
    rng = np.random.default_rng(1)
    units = rng.standard_normal((3000, 64))
    units /= np.sqrt((units ** 2).sum(1))[:, None]
    units[2990:] = units[:10]
    rows = [(i, "g", u.tobytes(), 1) for i, u in enumerate(units)]
    classes = spark.createDataFrame(rows, "key long, grp string, unit binary, times long")
    none = spark.createDataFrame([], "key long, links long")
    assert vectors.audit(classes, none, 0.93, 16) == {"few": (20, 0.0)}


def test_a_recall_below_the_bar_is_reported(spark, monkeypatch):
    tried = []
    monkeypatch.setattr(vectors, "audited_recall", lambda *a: tried.append(a) or 0.5)
    with pytest.warns(RuntimeWarning, match="0.5"):
        found(spark, [(1, [1.0, 0.0], 0, 1), (2, [1.0, 0.1], 0, 1)])
    assert len(tried) == 4
