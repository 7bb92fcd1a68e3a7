import random

import pytest

from tests.llm import edge
from wardflow.llm import graph, neardup


def brute(rows, size, percent):
    """Sets of word shingles, links, and the least id reachable, by comparing all pairs."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for _, text in rows:
        words = (text or "").translate(lower).encode().split()
        sets.append({tuple(words[i:i + size]) for i in range(len(words) - size + 1)}
                    if len(words) >= size else {tuple(words)} - {()})
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    groups = {}
    for i, (doc, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(doc)
    least = {k: min((d for d in v if d is not None), default=None) for k, v in groups.items()}
    return sorted(((doc, len(sets[i]), least[find(i)]) for i, (doc, _) in enumerate(rows)), key=repr)


def found(df, size, percent):
    out = neardup.near_duplicates(df, size, percent).collect()
    assert all(r.kept == (r.component_id in (None, r.doc_id)) for r in out)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out), key=repr)


@pytest.mark.parametrize("size, percent", [(3, 85), (5, 80)])
def test_chains_of_near_copies(spark, size, percent):
    """Copies with growing numbers of changed words, so that similarities lie on both sides."""
    rng, rows = random.Random(size), []
    for family in range(6):
        words = [f"{family}w{rng.randrange(400)}" for _ in range(120)]
        for _ in range(25):
            rows.append((len(rows), " ".join(words)))
            if rng.random() < 0.8:
                words = list(words)
                words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(df, size, percent) == brute(rows, size, percent)


@pytest.mark.parametrize("few", [0, 200_000])
def test_components(spark, monkeypatch, few):
    monkeypatch.setattr(graph, "FEW", few)
    rng = random.Random(few)
    edges = [(i, i + 1) for i in range(40)] + [(500, i) for i in range(501, 560)] + [(7, 7)]
    edges += [(rng.randrange(1000, 1060), rng.randrange(1000, 1060)) for _ in range(40)]
    rng.shuffle(edges)
    root = {}
    for a, b in edges * 60:
        if a != b:
            root[a] = root[b] = min(root.get(a, a), root.get(b, b))
    df = spark.createDataFrame([(b, a) if a % 2 else (a, b) for a, b in edges], "a long, b long")
    assert {tuple(r) for r in graph.components(df).collect()} == set(root.items())
    assert graph.components(df.limit(0)).count() == 0


def test_a_shared_passage_links_nothing(spark):
    shared = " ".join(f"s{i}" for i in range(40))
    rows = [(i, shared + " " + " ".join(f"{i}x{j}" for j in range(60))) for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(df, 3, 85) == brute(rows, 3, 85)


def test_edges(spark):
    rows = [(r[0], r[1]) for r in edge.rows()]
    assert found(edge.documents(spark), 3, 85) == brute(rows, 3, 85)
    assert found(edge.documents(spark, []), 3, 85) == []
