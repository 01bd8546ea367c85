import pytest

SMALL = "/root/testdata/sf0.001"

EMPTY = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "embeddings": "vec_id long, embedding array<float>, label int",
    "pages": "page_id long, url string, html string",
    "benchmark": "item_id long, text string",
    "labels": "doc_id long, quality int, toxic int",
    "conversations": "conv_id long, turn long, role string, text string",
}


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture
def folder(spark, tmp_path):
    """Writes tables into a fresh folder; tables that are not given are empty."""

    def write(**tables):
        for name, schema in EMPTY.items():
            df = tables.get(name)
            if df is None:
                df = []
            if isinstance(df, list):
                df = spark.createDataFrame(df, schema)
            df.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write
