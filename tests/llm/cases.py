"""Small inputs every text operator must stand: nulls, empty and long texts, ties, repeats, extra columns."""

from __future__ import annotations

from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
#: Names that operators use on the way; a caller's columns may have them too.
CLASHING = ("key", "row", "shard", "kept", "n_words", "text_", "windows", "fingerprint", "score", "ids", "_row", "h", "t")


def documents(spark, texts, first=0, extra=()):
    """Documents of these texts, ids from `first`, with string columns of the `extra` names."""
    rows = [
        (None if text is None and i % 2 else first + i, text, "en", None if i % 5 == 0 else "s", None if text is None else len(text), *(["x"] * len(extra)))
        for i, text in enumerate(texts)
    ]
    schema = T.StructType([*SCHEMA.fields, *(T.StructField(name, T.StringType()) for name in extra)])
    return spark.createDataFrame(rows, schema)


EDGES = [
    None,
    None,
    "",
    " \n\t\r\x0b\x0c ",
    "one",
    "one",
    "a b c d e f g h i j k l.",
    "a b c d e f g h i j k l.",
    "Mail a.b+c@x-y.example.org, or d@e.f@g.h_i@j.k; call +1 (212) 555-0101 or +49 30 1234567, host 10.0.0.255 not 10.0.0.256 or 1.2.3.4.5.",
    "Card 4111 1111 1111 1111 and 4111-1111-1111-1112, 0000000000000, 12 34 56.",
    "línea é ü 😀 x@y.zz 😀 +12345678901 ünï",
    "the same line\nthe same line\n\nother | menu | bar\nTHE BIG SHOUT OF ALL\nA proper sentence stands here, and it is long enough.",
    "word " * 3000,
    "9" * 30000,
    "x." * 20000 + "@" + "a." * 20000,
    " ".join(f"w{i}" for i in range(4000)) + ".",
    "p q r s t u v w p q r s t u v w x y z p q r s t",
]
