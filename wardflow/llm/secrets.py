"""Secret scan: fixed patterns, and formats learned by grammar inference.

Known credentials are read as sequences of character classes. A prefix tree of each kind is folded
into a probabilistic automaton by merging states whose outgoing frequencies do not differ
significantly (Hoeffding bound), as far as all their successors agree. Another automaton is inferred
from ordinary tokens. Every token of ``SHORTEST`` or more characters, with digits or without, is
then scored by how much likelier the format of some kind of credential makes it, per character;
clear cases are added to the spans of the fixed patterns, which always stay. A token of under
``FULL`` characters has to be as clear as a whole as one of that length, so that the bar per
character rises as tokens get shorter.

Defined cases: NULL text is empty text without spans; spans are in code points; a document whose
text repeats is scanned each time; without any known credential no span is added; very long tokens
are scored whole; ties of start go by kind in the order listed; an empty table gives no rows;
columns other than those named are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from wardflow.llm.staging import bounded_batches, frugal, staged

#: Fixed patterns of the contract.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                    r"([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
ACCESS, HEX = re.compile("AKIA[A-Z0-9]+"), re.compile("[0-9a-f]{32,}")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "inferred")
SHORTEST, FULL = 8, 16
CANDIDATE = re.compile("[A-Za-z0-9+/_.=-]{%d,}" % SHORTEST)
#: What the JVM looks for to find documents to learn from: a superset of those with a span.
HINT = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]|AKIA[A-Z0-9]{12}|[0-9a-f]{32}"""
#: Bounds of the sample: documents with a hint, ordinary ones, and tokens of either sort.
SAMPLE, TOKENS = 2000, 4000
#: Confidence of the merge test; nats per character by which a format must be likelier.
ALPHA, LIKELIER = 0.5, 0.8
#: Scores that a worker keeps (some megabytes); others are computed again.
SHAPES = 50_000


def _classes() -> tuple[dict[str, str], dict[str, int]]:
    groups = {"d": "0123456789", "h": "abcdef", "l": "ghijklmnopqrstuvwxyz", "H": "ABCDEF",
              "L": "GHIJKLMNOPQRSTUVWXYZ"} | {c: c for c in "+/_.=-"}
    return {c: k for k, text in groups.items() for c in text}, {k: len(t) for k, t in groups.items()}


CLASS, CLASS_SIZE = _classes()
_TABLE = str.maketrans(CLASS)
END = "$"


class Automaton:
    """Per state: counts of leaving by each class (and of ending), and where each leads."""

    def __init__(self, strings: list[str], alpha: float = ALPHA) -> None:
        self.counts: list[dict[str, int]] = [{}]
        self.moves: list[dict[str, int]] = [{}]
        for text in strings:
            at = 0
            for c in text:
                self.counts[at][c] = self.counts[at].get(c, 0) + 1
                if c not in self.moves[at]:
                    self.counts.append({})
                    self.moves.append({})
                    self.moves[at][c] = len(self.counts) - 1
                at = self.moves[at][c]
            self.counts[at][END] = self.counts[at].get(END, 0) + 1
        self.alpha = alpha
        self._merge()

    def _differ(self, one: int, two: int, c: str) -> bool:
        n, m = sum(self.counts[one].values()), sum(self.counts[two].values())
        if not n or not m:
            return False
        bound = math.sqrt(0.5 * math.log(2 / self.alpha)) * (1 / math.sqrt(n) + 1 / math.sqrt(m))
        return abs(self.counts[one].get(c, 0) / n - self.counts[two].get(c, 0) / m) > bound

    def _compatible(self, one: int, two: int) -> bool:
        todo, seen = [(one, two)], set()
        while todo:
            pair = todo.pop()
            if pair in seen or pair[0] == pair[1]:
                continue
            seen.add(pair)
            p, q = pair
            if any(self._differ(p, q, c) for c in {*self.counts[p], *self.counts[q]}):
                return False
            todo += [(self.moves[p][c], self.moves[q][c])
                     for c in self.moves[p].keys() & self.moves[q].keys()]
        return True

    def _fold(self, into: int, tree: int) -> None:
        """Add a subtree of the prefix tree to a state, and its successors to that one's."""
        todo = [(into, tree)]
        while todo:
            p, q = todo.pop()
            for c, n in self.counts[q].items():
                self.counts[p][c] = self.counts[p].get(c, 0) + n
            for c, to in self.moves[q].items():
                if c in self.moves[p]:
                    todo.append((self.moves[p][c], to))
                else:
                    self.moves[p][c] = to

    def _merge(self) -> None:
        """Settled states grow from the root; each of their successors joins one or settles."""
        settled, fringe = [0], [(0, c) for c in sorted(self.moves[0])]
        while fringe:
            fringe.sort(key=lambda x: -sum(self.counts[self.moves[x[0]][x[1]]].values()))
            source, c = fringe.pop(0)
            state = self.moves[source][c]
            if state in settled:
                continue
            for known in settled:
                if self._compatible(known, state):
                    self.moves[source][c] = known
                    self._fold(known, state)
                    break
            else:
                settled.append(state)
            fringe = [(s, k) for s in settled for k in sorted(self.moves[s])
                      if self.moves[s][k] not in settled]
        number = {state: i for i, state in enumerate(settled)}
        self.counts = [self.counts[s] for s in settled]
        self.moves = [{c: number[to] for c, to in self.moves[s].items()} for s in settled]

    def log_likelihood(self, text: str) -> float:
        """Of the classes and of each character within its class; unseen steps cost a smoothed share."""
        total, at = 0.0, 0
        for c in [*text, END]:
            counts = self.counts[at]
            n = sum(counts.values())
            total += math.log((counts.get(c, 0) + 0.05) / (n + 0.05 * (len(CLASS_SIZE) + 1)))
            total -= math.log(CLASS_SIZE.get(c, 1))
            at = self.moves[at].get(c, 0)
        return total


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the fixed patterns, in order."""
    found = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


SORTS = 3


def sort_of(token: str) -> int:
    """0 without a digit, 1 without a letter, 2 with both: words would outnumber the others."""
    return 2 if re.search("[0-9]", token) and re.search("[A-Za-z]", token) else int(
        not re.search("[A-Za-z]", token))


class Formats:
    """An automaton per kind of credential, and one per sort of ordinary tokens (see ``sort_of``)."""

    def __init__(self, secret: dict[int, list[str]], ordinary: list[str]) -> None:
        self.secret = [Automaton([x.translate(_TABLE) for x in some])
                       for _, some in sorted(secret.items()) if some]
        self._scores: dict[str, float] = {}
        # Ordinary tokens hold unknown credentials too: each half leaves out what the other half's
        # automata find likelier to be one.
        left = []
        for half in (0, 1):
            self.ordinary, self._scores = self._sorted(ordinary[half::2]), {}
            left += [x for x in ordinary[1 - half::2] if not self.found(x)]
        self.ordinary, self._scores = self._sorted(left), {}

    @staticmethod
    def _sorted(tokens: list[str]) -> list[Automaton]:
        sorts = [[x for x in tokens if sort_of(x) == sort] for sort in range(SORTS)]
        return [Automaton([x.translate(_TABLE) for x in some]) for some in sorts if some] or [
            Automaton(["d"])]

    def likelier(self, token: str) -> float:
        """Nats per character by which the likeliest format is likelier than an ordinary token.

        It depends on the token's classes only, of which words of one length share a sequence.
        """
        shape = token.translate(_TABLE)
        known = self._scores.get(shape)
        if known is None:
            best = max((a.log_likelihood(shape) for a in self.secret), default=-math.inf)
            usual = max(a.log_likelihood(shape) for a in self.ordinary)
            known = (best - usual) / len(token)
            if len(self._scores) < SHAPES:
                self._scores[shape] = known
        return known

    def found(self, token: str) -> bool:
        return self.likelier(token) * min(1.0, len(token) / FULL) > LIKELIER

    def spans(self, text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """Further spans, none of which touches a fixed one."""
        return [(m.start(), 3, m.end()) for m in CANDIDATE.finditer(text)
                if self.found(m[0]) and not any(s < m.end() and m.start() < e for s, _, e in base)]


def _training_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Values of the fixed patterns, and candidate tokens that touch none of them."""
    for batch in batches:
        rows = []
        for text in batch.column("text").to_pylist():
            base = base_spans(text)
            for start, kind, end in base:
                part = text[start:end]
                rows.append((kind, ASSIGN.fullmatch(part)[2] if kind == 0 else part))
            rows += [(3 + sort_of(m[0]), m[0]) for m in CANDIDATE.finditer(text)
                     if not any(s < m.end() and m.start() < e for s, _, e in base)]
        kind, token = zip(*rows) if rows else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(token, pa.string())],
                                         names=["kind", "token"])


def learned_formats(documents: DataFrame, sample: int = SAMPLE, tokens: int = TOKENS) -> Formats:
    """Automata from the ``sample`` hinted and as many other documents of least id hash.

    One scan notes which documents are hinted, and the ids are chosen from that, so only the chosen
    texts move; at most ``tokens`` distinct tokens of each kind and sort, of at most 128 characters,
    come to the driver.
    """
    bounded_batches(documents.sparkSession, 8)
    usable = documents.filter("text IS NOT NULL")
    ids = staged(usable.select("doc_id", F.col("text").rlike(HINT).alias("hinted")), "hints")
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = staged(ids.filter("hinted").orderBy(*order).limit(sample)
                    .union(ids.filter("NOT hinted").orderBy(*order).limit(sample))
                    .select("doc_id").distinct(), "chosen")
    found = staged(usable.join(F.broadcast(chosen), "doc_id", "left_semi").select("text")
                   .mapInArrow(frugal(_training_tokens), "kind int, token string")
                   .filter(F.length("token") <= 128).distinct(), "tokens")
    rows = {kind: [r.token for r in found.filter(F.col("kind") == kind)
                   .orderBy(F.xxhash64("token"), "token").limit(tokens).collect()]
            for kind in range(3 + SORTS)}
    return Formats({kind: rows[kind] for kind in range(3)},
                   [token for kind in range(3, 3 + SORTS) for token in rows[kind]])


def _listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def found_secrets(documents: DataFrame, formats: Formats) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_inferred`` per document."""
    bounded_batches(documents.sparkSession, 8)
    kinds = {"doc_id": LongType(), "n_assign": LongType(), "n_access": LongType(),
             "n_hex": LongType(), "base_sha256": StringType(), "spans": StringType(),
             "n_inferred": LongType()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                base = base_spans(text or "")
                more = formats.spans(text or "", base)
                rows.append((*(sum(k == i for _, k, _ in base) for i in range(3)),
                             hashlib.sha256(_listed(base).encode()).hexdigest(),
                             _listed(sorted(base + more)), len(more)))
            columns = list(zip(*rows)) or [()] * 6
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()),
                 *[pa.array(c, t) for c, t in zip(columns, types)]], names=list(kinds))

    return documents.select("doc_id", "text").mapInArrow(
        frugal(run), StructType([StructField(n, t) for n, t in kinds.items()]))


def scanned(documents: DataFrame) -> DataFrame:
    """Learn the formats from ``documents`` and scan all of them."""
    return found_secrets(documents, learned_formats(documents))


def redacted(documents: DataFrame, formats: Formats, mark: str = "[SECRET]") -> DataFrame:
    """``documents`` with every span replaced by ``mark`` and ``n_chars`` counted anew where it was.

    A document without a span keeps its row as it is.
    """
    bounded_batches(documents.sparkSession, 8)
    schema, names = documents.schema, documents.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place, size = names.index("text"), names.index("n_chars") if "n_chars" in names else None
            texts = batch.column(place).to_pylist()
            sizes = batch.column(size).to_pylist() if size is not None else []
            for i, text in enumerate(texts):
                if not text:
                    continue
                base = base_spans(text)
                spans, parts, at = sorted(base + formats.spans(text, base)), [], 0
                for start, _, end in spans:
                    if start >= at:
                        parts += [text[at:start], mark]
                    at = max(at, end)
                if spans:
                    texts[i] = "".join([*parts, text[at:]])
                    if sizes and sizes[i] is not None:
                        sizes[i] = len(texts[i])
            columns = list(batch.columns)
            columns[place] = pa.array(texts, columns[place].type)
            if size is not None:
                columns[size] = pa.array(sizes, columns[size].type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return documents.mapInArrow(frugal(run), schema)
