"""Rows that every operator must take: NULLs, empty and very long texts, ties, repeated rows, and
extra columns whose names clash with those of results."""

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "score double, kept boolean, key string, size string, rejected int")
PLAIN = ("the quick brown fox jumps over the lazy dog and then the cat sits down on the mat while "
         "rain falls on the old tin roof and nobody in the house says a word about it at all today "
         "because everyone is asleep or reading")
LONG = " ".join(f"w{i}" for i in range(60_000))


def rows():
    def row(i, text, lang="en", source="a"):
        return (i, text, lang, source, len(text or ""), 0.5, True, "k", "s", 1)

    return [row(1, PLAIN), row(2, PLAIN), row(2, PLAIN), row(3, None), row(4, ""), row(5, " \n\t "),
            row(6, LONG), row(7, "?!"), row(8, "one"), row(9, "One"), row(None, PLAIN, None, None),
            row(10, PLAIN + " and more", None, "b"), row(11, "el perro y el gato", "es", "b"),
            row(12, "x" * 300_000, "de", None)]


def documents(spark, some=None):
    return spark.createDataFrame(rows() if some is None else some, SCHEMA)
