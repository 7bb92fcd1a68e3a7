import hashlib
import random
import re

from tests.llm import edge
from wardflow.llm import secrets as s

RNG = random.Random(11)


def made(alphabet, n):
    return "".join(RNG.choice(alphabet) for _ in range(n))


HEXES, UPPER = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
ROWS = ([(i, f"foo password={made(HEXES, 18)} bar é") for i in range(60)]
        + [(100 + i, f"AKIA{made(UPPER, 16)} and token = \"{made(HEXES, 40)}\"") for i in range(60)]
        + [(200 + i, f"see mail{i}.example.com/internationalisation and {made('abcdefghij', 20)}") for i in range(60)]
        + [(300, f"loose {made(HEXES, 18)} here"), (301, "api_key: short"), (302, "TOKEN='abcdefgh'"),
           (303, "ſecret=abcdefghi"), (304, "secret=token=abcdefghij"), (305, "AKIA" + "A" * 11),
           (306, "x" * 5 + made(HEXES, 32)), (307, None), (308, ""), (309, "passwd=\tabcdefghij")])


def brute(text):
    """The contract's patterns, character by character where they allow."""
    text, found = text or "", []
    for m in re.finditer(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                         r"([A-Za-z0-9+/_.=-]+)", text):
        if len(m[2]) >= 8:
            found.append((m.start(), 0, "assign", m.end()))
    for kind, (name, pattern, least) in enumerate((("access", "AKIA[A-Z0-9]+", 16), ("hex", "[0-9a-f]+", 32)), 1):
        found += [(m.start(), kind, name, m.end()) for m in re.finditer(pattern, text) if len(m[0]) >= least]
    return [(name, start, end) for start, _, name, end in sorted(found)]


def test_fixed_spans_and_inferred_ones(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    for r in s.scanned(docs).collect():
        want = brute(dict(ROWS)[r.doc_id])
        listed = ",".join(f"{n}:{a}:{b}" for n, a, b in want)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(w[0] == k for w in want) for k in s.KINDS[:3])
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        spans = r.spans.split(",") if r.spans else []
        assert [x for x in spans if not x.startswith("inferred")] == [x for x in listed.split(",") if x]
        assert len(spans) - len(want) == r.n_inferred == (r.doc_id in (300, 305)), r


def test_redaction_takes_the_spans_only(spark):
    docs = spark.createDataFrame([(i, t, len(t or ""), "x") for i, t in ROWS],
                                 "doc_id long, text string, n_chars long, spans string")
    formats = s.learned_formats(docs)
    for r in s.redacted(docs, formats).collect():
        text = dict(ROWS)[r.doc_id]
        touched = bool(brute(text)) or r.doc_id in (300, 305)
        assert touched or r.text == text
        assert r.n_chars == len(r.text or "") and not brute(r.text)
        assert ("[SECRET]" in (r.text or "")) == touched


def test_states_merge_only_where_they_agree():
    strings = ["a" + "b" * (i % 3) + "c" for i in range(300)] + ["z" for _ in range(100)]
    tree = s.Automaton(strings, alpha=0.5)
    assert 1 < len(tree.counts) < 12
    assert tree.log_likelihood("abc") > tree.log_likelihood("zbc")


def test_edges(spark):
    out = s.scanned(edge.documents(spark)).collect()
    assert len(out) == len(edge.rows()) and not any(r.spans for r in out)
    assert s.scanned(edge.documents(spark, [])).count() == 0
    same = s.redacted(edge.documents(spark), s.Formats({}, []))
    assert sorted(map(tuple, same.collect()), key=repr) == sorted(map(tuple, edge.documents(spark).collect()), key=repr)


def runs(text):
    """Maximal runs of token characters, found one by one."""
    out, start = [], None
    for i, c in enumerate(text + " "):
        inside = c.isascii() and (c.isalnum() or c in "+/_.=-")
        if inside and start is None:
            start = i
        elif not inside and start is not None:
            out.append((start, i))
            start = None
    return out


def test_inferred_spans_equal_a_plain_scoring_of_all_tokens(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    formats = s.learned_formats(docs)
    texts = [t or "" for _, t in ROWS] + [
        f"{made(HEXES, n)} und {made('abcdefghij', n)} {made('0123456789', n)}.{n}" for n in range(4, 40)]
    n_short = 0
    for text in texts:
        base, want = s.base_spans(text), []
        for a, b in runs(text):
            shape = "".join(s.CLASS[c] for c in text[a:b])
            if b - a < 8 or any(x < b and a < y for x, _, y in base):
                continue
            gain = (max(m.log_likelihood(shape) for m in formats.secret)
                    - max(m.log_likelihood(shape) for m in formats.ordinary)) / (b - a)
            if gain * min(1, (b - a) / 16) > 0.8:
                want.append((a, 3, b))
                n_short += b - a < 16
        assert formats.spans(text, base) == want
    assert n_short > 3


def test_prose_numbers_and_addresses_are_no_secrets(spark):
    clean = ("the information about Sonderzeichen internationalisation 2024-01-15 10.11.12.13 "
             "+49.30.1234567 9807915762804490 mail.example.com/path_to_somewhere well-known "
             "transformations UNDERSTANDING ")
    rows = [(i, f"password={made(HEXES, 18)}") for i in range(80)] + [
        (100 + i, " ".join(RNG.sample((clean * 3).split(), 20)).replace("2024", str(1900 + i))
         .replace("9807915762804490", made("0123456789", 16))) for i in range(200)]
    train = spark.createDataFrame(rows[:60] + rows[80:200], "doc_id long, text string")
    formats = s.learned_formats(train)
    held = [t for i, t in rows[200:]]
    assert sum(len(formats.spans(t, s.base_spans(t))) for t in held) == 0
    assert formats.found(made(HEXES[:10], 6) + "ab" + made(HEXES, 6))


def test_one_text_of_many_megabytes(spark):
    text = "some words of prose " * 300_000 + "password=" + "a1b2c3d4e5" * 4
    docs = spark.createDataFrame([(1, text), (2, "x" * 5_000_000)], "doc_id long, text string")
    got = {r.doc_id: r for r in s.scanned(docs).collect()}
    assert got[1].n_assign == 1 and got[1].spans.startswith("assign:6000000:") and got[2].spans == ""
