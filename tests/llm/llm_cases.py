"""Rows and plain-Python counterparts that the tests of this folder share."""

import re
import string

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
COLUMNS = (
    "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, "
    # names that operators use themselves
    "row BIGINT, ids STRING, shard INT, slot INT, half BIGINT, start INT, found STRING, source_row INT, hash INT, m MAP<STRING,INT>"
)


def words(text):
    return WORD.findall(text or "")


def low(text):
    return (text or "").translate(LOWER)


def sentence(n, first=0):
    return " ".join(f"w{first + i}" for i in range(n))


def documents(spark, texts):
    """A documents table of (doc_id, text) pairs, with nulls and clashing names in the other columns."""
    rows = [
        (i, t, None, None if k % 3 == 0 else f"s{k % 2}", None, 7, "x", 1, None, 5, 0, "f", 3, 9, {"a": 1})
        for k, (i, t) in enumerate(texts)
    ]
    return spark.createDataFrame(rows, COLUMNS)


def odd_texts():
    """Nulls, empty and blank texts, repeated rows, ties, very long words and texts."""
    long = sentence(3000)
    return [
        (1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "one"), (5, "one"), (5, "one"), (None, "no id"), (None, None),
        (6, long), (7, long + " tail"), (8, "x" * 5000), (9, "Émile 漢字 🏽 İ ſ K don't <|endoftext|> </w>  two  blanks\n\n"),
        (10, "# * # line\nsame line\nsame line\n"), (-3, "all rights reserved"),
    ]
