import pytest

SF0001 = "/root/testdata/sf0.001"


def documents(spark, rows, extra=""):
    """Documents (doc_id, text[, lang[, source]]) as the operators read them."""
    rows = [(*r, *["en", "src0"][len(r) - 2:], len(r[1] or "")) for r in rows]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, "
                                       "n_chars long")


def texts(spark, sf=SF0001):
    return {r["doc_id"]: r["text"]
            for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}


@pytest.fixture(scope="session")
def corpus(spark):
    return spark.read.parquet(f"{SF0001}/documents.parquet")
