import pytest


@pytest.fixture(scope="session")
def frame(spark):
    """Documents with clashing extra columns; columns are (doc_id, text, lang, source)."""

    def make(rows, extra=True):
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
        if extra:
            for c in ("id", "h", "digest", "n", "part", "bucket", "p", "label", "node", "point", "starts", "grp", "host", "path", "epochs", "root"):
                df = df.selectExpr("*", f"'x' as {c}")
        return df

    return make
