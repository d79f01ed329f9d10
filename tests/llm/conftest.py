import pytest

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture
def documents(spark):
    """Build a documents table from (doc_id, text) pairs, lang and source null or given."""
    def make(pairs, extra=""):
        rows = [(*p, None, None)[:4] if len(p) < 4 else p for p in pairs]
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
        return df.selectExpr("*", "cast(length(text) as long) n_chars", *([extra] if extra else []))
    return make
