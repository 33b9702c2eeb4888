"""Rows every operator must take: nulls, empty and very long texts, ties, repeats, clashing column names."""

LONG = "lorem ipsum dolor " * 4000 + "x" * 3000

TEXTS = [
    (1, "the quick brown fox jumps over the lazy dog and runs away"),
    (2, None), (3, ""), (4, "   \n\t "), (5, "word"), (6, LONG), (7, "1d10t s.t.u.p.i.d l o s e r wooooorld $cum"),
    (1, "the quick brown fox jumps over the lazy dog and runs away"), (8, "ÄÖ ß 執 𝒳\x00\x85end"), (None, "no id here at all"),
    (9, "mail a.b@c.de or +49 30 1234567 ip 10.0.0.1 card 4111 1111 1111 1111"), (10, "a b c"), (11, "a b c"),
]


def frame(spark, rows=TEXTS):
    """(doc_id, text) with further columns whose names an operator might use itself."""
    df = spark.createDataFrame([(i, t, i, "x", 0.5, "y") for i, t in rows],
                               "doc_id long, text string, id long, token string, score double, shard string")
    return df


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, id long, token string, score double, shard string")
