import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark):
    """Real texts of the smallest table and the odd cases: nulls, empty and very long texts, repeated rows, further columns with the operators' own names."""
    real = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").where("doc_id < 120")
    odd = [(100000, None), (100001, ""), (100002, " \n\t "), (None, "a row without an id"), (100003, "one two three. " * 3000), (100003, "one two three. " * 3000), (100004, "aaaa" * 9000), (100005, "ü日本🙂 " * 400), (100006, "x<|endoftext|>y"), (100007, "\x00\x1c\x85  z")]
    extra = spark.createDataFrame([(i, t, None, None, None if t is None else len(t)) for i, t in odd], "doc_id long, text string, lang string, source string, n_chars long")
    both = real.unionByName(extra)
    return both.withColumns({k: F.lit("clash") for k in ("sha", "word", "bucket", "candidate", "row_no", "fp", "n", "keep")}).repartition(5).persist()


@pytest.fixture(scope="session")
def rows(docs):
    return [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)
