"""Awkward rows that every operator must take: NULLs in any column, empty and
very long texts, ties, repeated rows, extra columns with clashing names."""

LONG = " ".join(f"word{i % 997} the of" for i in range(6000)) + "\nlast line of it"
TEXTS = [None, "", " ", "\n", "the the the the the", "a b c\n\na b c\n A B C ", LONG,
         "é Ü ß\t\x0b\x0c\r x", "<|endoftext|> end", "tab\tand  two spaces \n y", "x" * 5000]


def awkward_docs(spark):
    """documents with clashing extra columns; ids and texts repeat."""
    rows = [(i if i % 5 else None, t, "en" if i % 2 else None, f"src{i}" if i % 3 else None,
             None if t is None else len(t), i, f"row{i}", "k", 7)
            for i, t in enumerate(TEXTS)]
    rows += [rows[4], rows[4], rows[6], (3, "another text under a used id", "xx", "s", 28, 1, "r", "k", 7)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, "
              "k1 long, row string, fp string, _t int")


def empty_docs(spark):
    return awkward_docs(spark).limit(0)
