"""The Merkle manifest against a plain tree."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tests.llm import edge
from wardflow.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def encoded(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, text):
    return h(*[encoded(v) for v in (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)])


def tree(nodes):
    """The root, and the siblings of each node up to it as (before, after)."""
    paths, place = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i:i + 16] for i in range(0, len(nodes), 16)]
        for i, at in enumerate(place):
            run, k = runs[at // 16], at % 16
            paths[i].append(("".join(run[:k]), "".join(run[k + 1:])))
        place = [at // 16 for at in place]
        nodes = [h(*run) for run in runs]
    return nodes[0], paths


def expected(rows):
    sources = sorted({r["source"] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for source in sources:
        own = sorted((r for r in rows if r["source"] == source), key=lambda r: (
            r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
        trees.append((own, *tree([leaf(r, r["text"]) for r in own])))
    root, over = tree([subroot for _, subroot, _ in trees])
    for (own, subroot, paths), above in zip(trees, over):
        for row, path in zip(own, paths):
            path, text = path + above, row["text"]
            if row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0 and text:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            node = leaf(row, text)
            for before, after in path:
                node = h(before, node, after)
            yield (row["doc_id"], leaf(row, row["text"]), subroot, root,
                   h(*[b + a for b, a in path]), node, node == root)


def found(df):
    got = merkle.verified_documents(df).withColumn(
        "proof_sha256", merkle.digest(merkle.siblings(F.col("proof"))))
    return got.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                      "verified").collect()


def check(df):
    want = list(expected([r.asDict() for r in df.collect()]))
    assert sorted(map(repr, map(tuple, found(df)))) == sorted(map(repr, want))


@pytest.mark.parametrize("sizes", [[1], [2, 16, 17], [256, 257, 1, 4097], [9001, 3] + [1] * 300])
def test_trees_of_many_sizes(spark, sizes):
    random.seed(1)
    rows = [(i * 7 % 100003, random.choice(["Text", "text", "ÀB", "", None]), "en", f"s{s}", 5)
            for s, n in enumerate(sizes) for i in range(n)]
    check(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, "
                                      "n_chars long").repartition(7))


def test_edges(spark):
    check(edge.documents(spark))
    assert found(edge.documents(spark, [])) == []


def test_rows_of_one_id_are_dealt_out(spark):
    rows = spark.range(20_000).selectExpr("7L AS doc_id", "'Same' AS text", "'en' AS lang",
                                          "'a' AS source", "4L AS n_chars")
    got = found(rows)
    assert len(got) == 20_000 and len({r.leaf for r in got}) == 1 == len({r.root for r in got})
    # Equal leaves have equal siblings but in the last, shorter runs; 7 is not tampered with.
    assert all(r.verified for r in got) and len({r.proof_sha256 for r in got}) == 3


def test_tampering_shows_where_the_text_changes(spark):
    rows = [(i, "Upper" if i % 2 else "lower", "en", "a", 5) for i in range(500)]
    got = found(spark.createDataFrame(rows, edge.SCHEMA.split(", score")[0]))
    for r in got:
        assert r.verified == (not (zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and r.doc_id % 2))


def test_carried_columns_keep_their_names(spark):
    df = spark.createDataFrame([(1, "a", "x", 9, 8)], "doc_id long, source string, leaf string, "
                                                      "size long, hash long")
    got = merkle.manifest(df, carry=("size", "hash")).first()
    assert (got["size"], got["hash"], got["proof"], got["root"]) == (9, 8, [], "x")
