"""Small awkward tables that every operator has to take."""

from __future__ import annotations

from functools import reduce

LONG = " ".join(f"word{i % 977} of{i % 13}" for i in range(20_000))
PASSAGE = "the quick brown fox jumps over the lazy dog while seven wise owls look on from a very old oak tree and say nothing at all"
SECRET = 'api_key = "9f8e7d6c5b4a39281706f5e4"'
MAIL = "write to a.person@mail.example.com or +1 (234) 555-6789 now"

#: (doc_id, text): nulls, empties, white space, repeats, ties, a long text, odd letters.
ROWS = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (6, "One  two three"), (7, PASSAGE), (8, PASSAGE + " indeed"),
    (9, PASSAGE), (9, PASSAGE), (10, LONG), (11, LONG + " end"), (12, "Ünïcödé ß İ Σας \u00a0 e\u0301 漢字かな 🎈 ok"), (13, SECRET), (14, MAIL),
    (None, "no id here at all my friends"), (None, PASSAGE), (15, "%%% a&&& b$$$ | c"),
]

#: Columns whose names operators use inside.
EXTRA = ["row", "digest", "n", "token", "score", "kind", "start", "end", "lang", "source", "n_chars", "sequence", "host", "path", "share", "size"]


def documents(spark, rows=ROWS):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return reduce(lambda d, c: d.selectExpr("*", f"cast(NULL AS string) AS `{c}`"), EXTRA, df)


def empty(spark):
    return documents(spark, [])


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
