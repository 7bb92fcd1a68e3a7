"""Benchmark decontamination by template canonicalisation. Only DataFrame functions.

Numbers, names and units of a text become typed placeholders, token for token, so that a question
asked again with other values keeps its template. Windows of ``WINDOW`` template tokens of all
documents are hash-joined with those of the benchmark. A document holds an item if at least
``COVERAGE`` of the item's distinct windows occur in it and the slots agree: along the best
alignment, equal item values must meet equal document values, and different ones different ones;
case and punctuation at the ends of a value don't count.
Items whose template and pattern of equal slots are the same form one class, listed once.

An item without a window to look for, because it is shorter or its windows all hold fewer than
``LITERALS`` words that are no placeholders, is found where it stands whole, word for word; its
class has the items of the same words, and its ``n_windows``, ``n_found`` and ``n_slots`` are 0.

Defined cases: a NULL or empty text has no tokens, holds nothing and is found nowhere; rows that
repeat a document are each judged, those that repeat an item count once each in ``n_items``; empty
tables give no rows. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.llm.staging import SPACE, keyed, let, staged

WINDOW, COVERAGE, LITERALS = 5, 0.8, 2
#: A benchmark of at most so many windows is broadcast (12 MB of hashes); a larger one is shuffled.
BROADCAST_WINDOWS = 500_000
#: Placeholders begin with a private-use character, which no pattern here touches.
NUMBER, NAME, UNIT = "\ue000num", "\ue000name", "\ue000unit"
#: Units of measure that may follow a number.
UNITS = ("mm", "cm", "m", "km", "in", "inch", "inches", "ft", "feet", "yd", "mile", "miles", "mg",
         "g", "kg", "t", "oz", "lb", "lbs", "ml", "l", "s", "sec", "seconds", "min", "minutes", "h",
         "hours", "days", "weeks", "months", "years", "%", "percent", "eur", "euros", "usd",
         "dollars", "cents", "c", "f", "degrees", "kmh", "mph", "w", "kw", "v", "hz", "j", "n", "pa")


#: Numbers in words ("one" is left out, as it is a pronoun too).
NUMBER_WORDS = ("two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven",
                "twelve", "thirteen", "fourteen", "fifteen", "sixteen", "seventeen", "eighteen",
                "nineteen", "twenty", "thirty", "forty", "fifty", "sixty", "seventy", "eighty",
                "ninety", "hundred", "thousand", "million", "billion", "dozen")
#: Words that begin sentences and are no names.
OPENERS = ("The", "An", "This", "That", "These", "Those", "He", "She", "It", "They", "We", "You",
           "His", "Her", "Its", "Their", "Our", "Your", "My", "What", "Which", "Who", "Whose", "When",
           "Where", "Why", "How", "If", "In", "On", "At", "Of", "For", "To", "From", "By", "With",
           "And", "Or", "But", "So", "As", "Each", "Every", "All", "Some", "Any", "No", "Not", "There",
           "Then", "After", "Before", "During", "While", "Is", "Are", "Was", "Were", "Do", "Does", "Did",
           "Has", "Have", "Can", "Could", "Would", "Should", "Let", "Find", "Given", "Suppose", "Now")
GAP, START, END = r"\x20\x09-\x0D", r"(?<![^\x20\x09-\x0D])", r"(?![^\x20\x09-\x0D])"


def parted(text: Column) -> Column:
    """The text with units that are joined to a number (5kg) as tokens of their own."""
    joined = rf"(?<=\p{{Nd}})(?=(?i:{'|'.join(u for u in UNITS if u != '%')})[.,;:!?)\"']*{END})"
    return F.regexp_replace(text, joined, " ")


def template(text: Column) -> Column:
    """A ``parted`` text with placeholders, words lower-cased without punctuation at their ends.

    Each pass replaces within one token, so the tokens keep their places. A number is a token of
    digits with signs, separators or a currency mark around, or a number word; a name is a
    capitalised word, wherever it stands, that is none of ``OPENERS``. So a template doesn't depend
    on what stands before it.
    """
    words = "|".join(NUMBER_WORDS)
    number = (START + rf"[(\"'+\-$€£]*(?:\p{{Nd}}[\p{{Nd}}.,:/]*%?|(?i:(?:{words})(?:-(?:{words}|one))?))"
              + r"[)\"'.,;:!?]*" + END)
    numbered = F.regexp_replace(text, number, NUMBER)
    unit = f"(?<={NUMBER}\\x20)(?i:{'|'.join(UNITS)})(?=[.,;:!?)\"']*{END})"
    marked = F.regexp_replace(numbered, unit, UNIT)
    after = rf"(?=[\p{{P}}{GAP}]|$)"
    named = F.regexp_replace(
        marked, rf"(?<![^\p{{P}}{GAP}])(?!(?:{'|'.join(OPENERS)}){after})\p{{Lu}}\p{{Ll}}+{after}", NAME)
    ends = (rf"(?<=[^{GAP}])[\p{{P}}&&[^%]]+{END}"
            rf"|{START}[\p{{P}}&&[^%\-]]+(?=\p{{P}}*[^\p{{P}}{GAP}])")
    return F.lower(F.regexp_replace(named, ends, ""))


def tokens(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda x: x != "")


def _is_slot(token: Column) -> Column:
    return token.isin(NUMBER, NAME, UNIT)


def window_hashes(parts: Column, size: int = WINDOW) -> Column:
    """One 64-bit hash per window of template tokens, in order; empty for short texts."""
    def hashed(known: Column) -> Column:
        last = F.size(known) - size
        every = F.transform(F.sequence(F.lit(0), last),
                            lambda i: F.xxhash64(*[F.get(known, i + k) for k in range(size)]))
        return F.when(last >= 0, every).otherwise(F.array().cast("array<bigint>"))

    return let(parts, hashed)


def _values(raw: Column) -> Column:
    """The tokens in lower case without punctuation at their ends, which belong to the sentence.

    A token of punctuation alone stays, and so does the sign before a number.
    """
    return F.transform(raw, lambda x: F.lower(F.regexp_replace(F.regexp_replace(
        x, r"(?<=.)[\p{P}&&[^%]]+$", ""), r"^[\p{P}&&[^\-]]+(?=.)", "")))


def _literals(parts: Column) -> Column:
    return F.transform(parts, lambda t: F.when(_is_slot(t), 0).otherwise(1))


def _enough(literals: Column, place: Column) -> Column:
    """Whether the window at a place has enough words that are no placeholders."""
    words = F.slice(literals, place + 1, WINDOW)
    return F.aggregate(words, F.lit(0), lambda total, x: total + x) >= LITERALS


def benchmark_classes(benchmark: DataFrame) -> DataFrame:
    """``item_id`` (least of its class), ``n_items``, template ``parts``, ``raw`` tokens, ``whole``.

    The last marks items without a window to look for.
    """
    text = parted(F.col("text"))
    cut = benchmark.select("item_id", tokens(template(text)).alias("parts"),
                           _values(tokens(text)).alias("raw"))
    slots = F.transform(F.filter(F.arrays_zip("parts", "raw"), lambda x: _is_slot(x["parts"])),
                        lambda x: x["raw"])
    pattern = let(slots, lambda every: F.transform(every, lambda s: F.array_position(every, s)))
    last = F.size("parts") - WINDOW
    sought = let(_literals(F.col("parts")), lambda known: F.exists(
        F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: _enough(known, i)))
    known = cut.filter(F.size("parts") > 0).withColumn("pattern", pattern).withColumn(
        "whole", ~((last >= 0) & sought))
    return (known.groupBy("parts", "pattern", "whole", F.when(F.col("whole"), F.col("raw")))
            .agg(F.min("item_id").alias("item_id"), F.count("*").alias("n_items"),
                 F.min_by("raw", "item_id").alias("raw"))
            .select("item_id", "n_items", "parts", "raw", "whole"))


def item_windows(classes: DataFrame) -> DataFrame:
    """``item_id, place, hash`` of windows with enough literal words."""
    spread = classes.select("item_id", _literals(F.col("parts")).alias("literal"),
                            F.posexplode(window_hashes(F.col("parts"))).alias("place", "hash"))
    return spread.filter(_enough(F.col("literal"), F.col("place"))).select("item_id", "place", "hash")


def _held_whole(docs: DataFrame, classes: DataFrame) -> DataFrame | None:
    """Documents that hold an item without windows word for word; None if there is no such item.

    The first ``WINDOW`` tokens, or all of fewer, are hash-joined. What meets is compared in full.
    """
    size = F.least(F.size("raw"), F.lit(WINDOW)).alias("size")
    whole = classes.filter("whole").select("item_id", "n_items", "raw", size)
    sizes = sorted(r["size"] for r in whole.select("size").distinct().collect())
    if not sizes:
        return None
    values = docs.select("key", "doc_id", _values(tokens(parted(F.col("text")))).alias("doc_raw"))
    near = None
    for n in sizes:
        first = whole.filter(F.col("size") == n).select(
            "item_id", F.xxhash64(*[F.get("raw", F.lit(k)) for k in range(n)]).alias("hash"))
        hashes = F.array_distinct(window_hashes(F.col("doc_raw"), n))
        met = values.select("key", F.explode(hashes).alias("hash")).join(first, "hash")
        near = met.drop("hash") if near is None else near.unionByName(met.drop("hash"))
    both = near.join(values, "key").join(whole.drop("size"), "item_id")
    last = F.size("doc_raw") - F.size("raw")
    held = F.exists(F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
                    lambda i: F.slice("doc_raw", i + 1, F.size("raw")) == F.col("raw"))
    none = F.lit(0)
    return both.filter((last >= 0) & held).select(
        "doc_id", "key", "item_id", "n_items", none.cast("long").alias("n_windows"),
        none.alias("n_found"), none.alias("n_slots"), F.lit(True).alias("same_values"))


def contaminated(documents: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """One row per document and item class found in it.

    ``doc_id, key, item_id, n_items, n_windows, n_found, n_slots, same_values``; the last tells a
    verbatim copy of the slots from a re-parameterised question.
    """
    classes = staged(benchmark_classes(benchmark), "classes")
    windows = staged(item_windows(classes.filter("not whole")), "windows")
    docs = keyed(documents, "doc_id", "text")
    n_windows = windows.count()
    items = windows.groupBy("item_id").agg(F.countDistinct("hash").alias("n_windows"))
    places = F.broadcast(windows) if n_windows <= BROADCAST_WINDOWS else windows
    spread = docs.select("key", F.posexplode(
        window_hashes(tokens(template(parted(F.col("text")))))).alias("doc_place", "hash"))
    met = staged(spread.join(places, "hash").select(
        "key", "item_id", "hash", (F.col("doc_place") - F.col("place")).alias("shift")), "met")
    shifts = (met.groupBy("key", "item_id", "shift").agg(F.count("*").alias("n"))
              .groupBy("key", "item_id")
              .agg(F.max_by("shift", F.struct("n", -F.col("shift"))).alias("shift")))
    found = (met.select("key", "item_id", "hash").distinct()
             .groupBy("key", "item_id").agg(F.count("*").cast("int").alias("n_found"))
             .join(items, "item_id").filter(F.col("n_found") >= coverage * F.col("n_windows"))
             .join(shifts, ["key", "item_id"]))
    found = staged(found, "found")
    texts = docs.join(found.select("key").distinct(), "key", "left_semi").select(
        "key", "doc_id", tokens(template(parted(F.col("text")))).alias("doc_parts"),
        _values(tokens(parted(F.col("text")))).alias("doc_raw"))
    both = found.join(texts, "key").join(classes, "item_id")

    def pair(i: Column) -> Column:
        j = i + F.col("shift")
        inside = (j >= 0) & (j < F.size("doc_raw"))
        return F.struct(F.get("raw", i).alias("item"),
                        F.when(inside, F.get("doc_raw", j)).alias("doc"),
                        (_is_slot(F.get("parts", i)) & inside
                         & (F.get("parts", i) == F.get("doc_parts", j))).alias("slot"))

    pairs = F.filter(F.transform(F.sequence(F.lit(0), F.size("parts") - 1), pair),
                     lambda x: x["slot"])
    kinds = F.array_distinct(F.transform("pairs", lambda x: F.struct(x["item"], x["doc"])))

    def different(field: str) -> Column:
        return F.size(F.array_distinct(F.transform("pairs", lambda x: x[field])))

    judged = both.withColumn("pairs", pairs).withColumn("n_kinds", F.size(kinds))
    judged = (judged.filter((F.col("n_kinds") == different("item")) & (F.col("n_kinds") == different("doc")))
            .select("doc_id", "key", "item_id", "n_items", "n_windows", "n_found",
                    F.size("pairs").alias("n_slots"),
                    F.forall("pairs", lambda x: x["item"] == x["doc"]).alias("same_values")))
    whole = _held_whole(docs, classes)
    return judged if whole is None else judged.unionByName(whole)
