import pytest
from pyspark.sql import functions as F

from tests.llm import edge
from wardflow.llm import mixture, urls


def targets(spark, sizes, **options):
    df = spark.createDataFrame(sizes, "source string, size long")
    return {r.source: r.target for r in mixture.source_targets(df, **options).collect()}


def test_targets_stop_at_their_caps_and_share_the_rest(spark):
    sizes = {"a": 10, "b": 1000, "c": 400, None: 100, "z": 0}
    got = targets(spark, list(sizes.items()))
    weights = dict(zip(["a", "b", "c", "z", None], [5, 2, 1, 5, 2]))
    want, total = {}, 1.5 * sum(sizes.values())
    share = {s: total * w / sum(weights.values()) for s, w in weights.items()}
    while any(share[s] > 2 * sizes[s] for s in share if s not in want):
        want |= {s: 2 * sizes[s] for s in share if share[s] > 2 * sizes[s]}
        left = {s: w for s, w in weights.items() if s not in want}
        share = want | {s: (total - sum(want.values())) * w / sum(left.values()) for s, w in left.items()}
    assert got == pytest.approx(share) and sum(got.values()) == pytest.approx(total)


def test_ranks_follow_code_points(spark):
    names = ["b", "a", "B", "é", "\U0001f600", "\uffff", "", None] + [f"s{i}" for i in range(50)]
    df = spark.createDataFrame([(n, 1) for n in names], "source string, source_size long")
    ranked = mixture.ranked_sources(df).orderBy("rank").collect()
    assert [r["rank"] for r in ranked] == list(range(len(names)))
    assert [r.source for r in ranked] == [*sorted(n for n in names if n is not None), None]


def test_mixture_emits_what_it_takes(spark):
    df = spark.createDataFrame([(i, "w " * (1 + i % 7), f"s{i % 4}") for i in range(2000)],
                               "doc_id long, text string, source string")
    plan = mixture.mixed_sizes(df).collect()
    emitted = mixture.mix(df).groupBy("doc_id").agg(F.max("copy").alias("n")).collect()
    times = {r.doc_id: r.n for r in emitted}
    assert all(r.taken == r.size * times.get(r.doc_id, 0) <= 2 * r.size for r in plan)
    for source in range(4):
        own = [r for r in plan if r.doc_id % 4 == source]
        assert sum(r.taken for r in own) == pytest.approx(own[0].target, rel=0.12)
    assert sorted(plan) == sorted(mixture.mixed_sizes(df.repartition(5)).collect())


def test_mixture_edges(spark):
    got = mixture.mixed_sizes(edge.documents(spark)).collect()
    assert len(got) == len(edge.rows())
    assert {r.size for r in got if r.doc_id in (3, 4, 5)} == {0}
    mixed = mixture.mix(edge.documents(spark))
    assert mixed.columns == [*edge.documents(spark).columns, "copy"] and mixed.count() > 0
    assert mixture.mixed_sizes(edge.documents(spark, [])).count() == 0
    assert mixture.mix(edge.documents(spark, [])).count() == 0


def test_columns_of_any_name_pass_through_the_mixture(spark):
    names = ["copy", "Copy_1", "of", "rate", "times", "document", "drawn_by", "source_size", "target"]
    df = spark.createDataFrame([(i, "w " * (1 + i % 3), "a", *range(9)) for i in range(40)],
                               "doc_id long, text string, source string, " + ", ".join(f"`{n}` int" for n in names))
    mixed = mixture.mix(df)
    assert mixed.columns == [*df.columns, "copy_2"]
    assert {tuple(r[n] for n in names) for r in mixed.collect()} == {tuple(range(9))}
    plan = {r.doc_id: r.taken // r.size for r in mixture.mixed_sizes(df).collect()}
    assert mixed.count() == sum(plan.values())


@pytest.mark.parametrize("doc_id", [None, 7])
def test_documents_without_an_id_of_their_own_are_drawn_one_by_one(spark, doc_id):
    df = spark.createDataFrame([(doc_id, f"w{i} x", f"s{i % 2}") for i in range(1500)],
                               "doc_id long, text string, source string")
    plan = mixture.mixed_sizes(df)
    sums = plan.groupBy("target").agg(F.sum("taken").alias("taken"), F.count("*").alias("n")).collect()
    assert sum(r.n for r in sums) == 1500
    assert all(r.taken == pytest.approx(r.target, rel=0.1) for r in sums)
    assert sorted(plan.collect()) == sorted(mixture.mixed_sizes(df.repartition(7)).collect())
    assert mixture.mix(df).count() * 2 == sum(r.taken for r in sums)


CASES = [
    ("https://www.Example.ORG/es/1", "www.example.org", "/es/1", "example.org/es/", "block"),
    ("http://example.org/en/12#t", "example.org", "/en/12", "example.org/en/1", "block"),
    ("http://example.org/en/2?q=/es/", "example.org", "/en/2", "org/", "allow"),
    ("http://example.org?x", "example.org", "", None, "allow"),
    ("http://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
    ("http://a.com/fr/", "a.com", "/fr/", "com/fr/", "allow"),
    ("http://a.com/de/x", "a.com", "/de/x", "com/de/", "block"),
    ("http://com/de/x", "com", "/de/x", "com/de/", "block"),
    ("http://a.com:80/de/x", "a.com:80", "/de/x", None, "allow"),
    ("http://É.NET/%20", "É.net", "/%20", None, "allow"),
    ("http://listed.net/a/?utm_x=1&b=2", "listed.net", "/a/", None, "block"),
    ("https://www.listed.net/a?b=2#c", "www.listed.net", "/a", None, "block"),
    ("http://listed.net/a?b=3", "listed.net", "/a", None, "allow"),
    ("no scheme/de/", "", "", None, "allow"), ("", "", "", None, "allow"), (None, "", "", None, "allow"),
    ("x://", "", "", None, "allow"), ("a://b://c/de/", "b:", "//c/de/", None, "allow")]


@pytest.mark.parametrize("blocks", [1, 1 << 17])
def test_urls(spark, blocks):
    """Also with a filter so small that it lets nearly everything pass to the exact join."""
    rows = [(i, c[0], "x", "y") for i, c in enumerate(CASES)]
    pages = spark.createDataFrame(rows * 2, "page_id long, url string, rule string, listed string")
    names = ["listed.net/a?b=2", "", None] + [f"other{i}.net/" for i in range(500)]
    listed = spark.createDataFrame([(n,) for n in names], "canonical string")
    got = urls.judged_urls(pages, listed, max_blocks=blocks).collect()
    assert sorted(tuple(r) for r in got if r.rule) + sorted(tuple(r) for r in got if not r.rule) == (
        sorted((i, *c[1:]) for i, c in list(enumerate(CASES)) * 2 if c[3])
        + sorted((i, *c[1:]) for i, c in list(enumerate(CASES)) * 2 if not c[3]))


def test_urls_without_rows(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    empty = spark.createDataFrame([], "canonical string")
    assert urls.judged_urls(pages, empty).count() == 0
    one = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    assert urls.judged_urls(one, empty).first().verdict == "allow"


def test_the_filter_misses_no_listed_url(spark):
    listed = spark.range(5000).select(F.concat(F.lit("h.net/"), "id").alias("canonical"))
    probe = spark.range(10000).select("id", F.concat(F.lit("h.net/"), "id").alias("canonical"))
    assert urls.listed_urls(probe, listed).filter("listed <> (id < 5000)").count() == 0
    assert urls.filter_blocks(10**9) == urls.MAX_BLOCKS
