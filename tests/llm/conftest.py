import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture()
def folder(spark, tmp_path):
    """Writes tables as an sf folder: folder(documents=[...], ...)."""

    def make(schema=None, **tables):
        kinds = {"documents": DOCS, "labels": LABELS, "embeddings": "vec_id long, embedding array<float>, label int", "pages": "page_id long, url string, html string"} | (schema or {})
        for name, rows in tables.items():
            spark.createDataFrame(rows, kinds[name]).write.mode("overwrite").parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)

    return make


@pytest.fixture()
def odd_docs():
    """Nulls in every column, empty, blank and very long texts, ties and repeated rows."""
    long = " ".join(f"word{i % 977} the of" for i in range(40_000))
    return [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n\t ", "en", "a", 4), (None, "a text without any id at all here", "en", "b", 5), (4, long, "en", "a", len(long)),
        (5, "Twice the same row.", "en", "a", 19), (5, "Twice the same row.", "en", "a", 19), (6, "Ärger 新光 👩‍👧 é", None, "b", 12), (7, "x", "en", None, 1), (8, "<|endoftext|> a <|endoftext|>", "en", "c", 28),
    ]
