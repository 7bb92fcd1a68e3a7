import hashlib
import random

import pytest

from tests.llm import edge
from wardflow.llm import substrings


def brute(rows, length):
    seen = {}
    texts = [(text or "").encode().split() for _, text in rows]
    for words in texts:
        for i in range(len(words) - length + 1):
            run = tuple(words[i:i + length])
            seen[run] = seen.get(run, 0) + 1
    out = []
    for (doc, _), words in zip(rows, texts):
        gone = {p for i in range(len(words) - length + 1) if seen[tuple(words[i:i + length])] > 1
                for p in range(i, i + length)}
        kept = b" ".join(w for p, w in enumerate(words) if p not in gone)
        out.append((doc, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def found(df, **options):
    out = substrings.without_repeats(df, **options).drop("kept").collect()
    return sorted((tuple(r) for r in out), key=repr)


def test_random_repeats(spark):
    """Passages of 30 to 45 words at any place, within and across documents."""
    rng = random.Random(7)
    passages = [[f"p{p}.{i}" for i in range(30 + p)] for p in range(16)]
    rows = []
    for doc in range(60):
        words = []
        for _ in range(rng.randrange(4)):
            words += [f"u{rng.randrange(10**9)}" for _ in range(rng.randrange(50))]
            words += rng.choice(passages)[rng.randrange(3):]
        rows.append((doc, rng.choice([" ", "\n", "  "]).join(words)))
    rows.append((60, "same " * 200))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(df) == brute(rows, 35)
    assert found(df, length=20, period=7, cover=(0, 1, 3)) == brute(rows, 20)


def test_edges(spark):
    rows = [(r[0], r[1]) for r in edge.rows()]
    assert found(edge.documents(spark)) == brute(rows, 35)
    assert found(edge.documents(spark, [])) == []


def test_a_set_that_does_not_cover_is_refused(spark):
    with pytest.raises(ValueError):
        substrings.without_repeats(edge.documents(spark), cover=(0, 1, 2))
