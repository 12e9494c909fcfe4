"""Awkward inputs that every operator must take."""

import re

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")

#: Nulls, empty and blank texts, repeated rows, ties, letters beyond ASCII; columns that clash with results.
ROWS = [
    (1, "The cat sat on the mat and looked at the moon for a long while before it slept again.", "en", "a"),
    (2, "The cat sat on the mat and looked at the moon for a long while before it slept again.", "en", "a"),
    (2, "The cat sat on the mat and looked at the moon for a long while before it slept again.", "en", "a"),
    (3, None, "en", "a"),
    (4, "", None, None),
    (5, " \t\n ", "de", "b"),
    (None, "A text without a key, long enough to be more than a few words of nothing in particular.", "en", None),
    (None, None, None, None),
    (6, "Größe für öffentliche Straßen größer größer größer\nzwei\nzwei\n", "de", "b"),
    (7, "one", "en", "c"),
    (8, "word " * 5000, "en", "c"),
    (9, "x" * 20000, "en", "c"),
]
SCHEMA = "doc_id long, text string, lang string, source string"
CLASHES = "size text_crc32 law shard slot grown_shard source_size target taken copies n_words n_hit spans items fp p_toxic toxic n_tokens kept level".split()


def awkward(spark, rows=ROWS, clashes=False):
    docs = spark.createDataFrame(rows, SCHEMA)
    if clashes:
        for name in CLASHES:
            docs = docs.selectExpr("*", f"'own' AS {name}")
    return docs


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return WORDS.findall((text or "").encode())
