import pytest

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark):
    """Builds ``documents`` from (doc_id, text[, source]) rows; ``extra`` adds clashing column names."""
    def build(rows, extra=False):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1]) if r[1] is not None else None) for r in rows]
        df = spark.createDataFrame(full, DOC)
        if extra:
            from pyspark.sql import functions as F
            for name in ("words", "size", "row", "content", "score", "label", "terms", "component", "n_words", "ids",
                         "_slots", "slots", "_dropped", "dropped", "_text", "_words", "grams", "set_id"):
                df = df.withColumn(name, F.lit("x"))
        return df
    return build


EDGE_ROWS = [(1, None), (2, ""), (3, "   \n\t "), (4, "a"), (5, "x y z"), (6, "word " * 3000), (7, "ä" * 500),
             (8, "same text here twice " * 10), (9, "same text here twice " * 10), (9, "same text here twice " * 10),
             (None, "no id here " * 12)]


@pytest.fixture
def edge_rows():
    return list(EDGE_ROWS)
