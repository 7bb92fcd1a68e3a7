"""The licence scan against brute force over all blocks and templates."""

import random
import re

import pytest

from tests.llm import edge
from wardflow.llm import licenses

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(text, templates, phrases, containment):
    every = words(text)
    starts = {p: [i for i in range(len(every)) if every[i:i + len(p.split())] == p.split()]
              for p in phrases}
    base = {phrases[p] for p, s in starts.items() if s}
    found, most = set(), 0.0
    for sentence in re.split(r"[.!?;:]+[\x20\x09-\x0D]+|\n[\x20\x09\x0D]*\n", text or ""):
        known = words(sentence)
        runs = [known] if len(known) <= 256 else [known[i:i + 256] for i in range(0, len(known), 128)]
        for run in map(set, runs):
            by_family = {}
            for family, label, t in templates:
                t = set(words(t))
                share = len(run & t) / len(t)
                if len(run & t) >= containment * len(t) - 1e-9:
                    by_family.setdefault(family, []).append((share, len(run & t), label))
            for pairs in by_family.values():
                best = max(pairs)[:2]
                found |= {label for *held, label in pairs if tuple(held) == best}
                most = max(most, best[0])
    places = [i for s in starts.values() for i in s]
    return (len(every), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(base)), ",".join(sorted(base | found)), 1.0 if places else most)


def held(spark, df, templates=licenses.TEMPLATES, phrases=licenses.PHRASES, containment=0.9):
    got = licenses.scanned(df, templates, phrases, containment).collect()
    want = [(r.doc_id, *brute(r.text, templates, phrases, containment)) for r in df.collect()]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    return {r.doc_id: r for r in got}


@pytest.mark.parametrize("containment", [1.0, 0.9, 0.7, 0.5])
def test_scan_equals_brute_force_on_damaged_notices(spark, containment):
    random.seed(5)
    pool = [w for _, _, t in licenses.TEMPLATES for w in t.split()] + "wood rain tin cat".split()

    def text(i):
        parts = []
        for _ in range(random.randrange(1, 6)):
            notice = random.choice(licenses.TEMPLATES)[2].split()
            for _ in range(random.randrange(4)):
                notice[random.randrange(len(notice))] = random.choice(pool)
            random.shuffle(notice) if random.random() < 0.2 else None
            filler = random.choices(pool, k=random.choice([0, 3, 30, 700]))
            parts.append(" ".join(filler + notice) + random.choice([". ", "\n\n", "\n", " "]))
        return "".join(parts)

    rows = [(i, text(i)) for i in range(150)]
    held(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(6),
         containment=containment)


def test_notices_and_clean_texts(spark):
    texts = ["x under the\nMIT-license, under the mit license", "under the mits license",
             "This work is licensed under the GNU General Public License, version 3.",
             "This work is licensed under the GNU General Public License, version 2.",
             "Licensed under CC BY-NC 4.0.", "cc by nc cc by nc", "a word on public work in general",
             "Apache License,\tVersion 2", "éİ UNDER the MIT licenSeK",
             "Redistribution and use in source\nand binary forms, with or without modification,\n"
             "are permitted provided that the following conditions\nare met:"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = held(spark, df)
    assert [got[i].labels for i in range(len(texts))] == [
        "mit", "", "gpl-3", "gpl-2", "cc-by-nc", "cc-by-nc", "", "apache-2", "", "bsd"]


def test_edges(spark):
    held(spark, edge.documents(spark))
    assert licenses.scanned(edge.documents(spark, [])).count() == 0
    held(spark, edge.documents(spark), templates=(), phrases={})


def test_a_third_of_texts_with_one_notice(spark):
    rows = [(i, "Some words. This is free and unencumbered software released into the public domain."
             if i % 3 == 0 else f"clean words {i}") for i in range(3000)]
    got = licenses.scanned(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in got if r.labels == "unlicense"} == set(range(0, 3000, 3))
    assert all(r.labels in ("", "unlicense") for r in got)


def test_many_template_words_are_refused(spark):
    templates = [("f", "l", " ".join(f"w{i}" for i in range(licenses.MOST_WORDS + 1)))]
    with pytest.raises(ValueError):
        licenses.scanned(edge.documents(spark), templates)
