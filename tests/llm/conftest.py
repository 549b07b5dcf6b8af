import duckdb
import pytest

@pytest.fixture(scope="session")
def table(sf_dir):
    def rows(name, columns="*"):
        return duckdb.sql(f"SELECT {columns} FROM '{sf_dir}/{name}.parquet'").fetchall()

    return rows


@pytest.fixture
def documents(spark):
    """A documents table of (doc_id, text) or (doc_id, text, lang, source), with clashing extra columns."""

    def make(rows):
        full = [(*r, *(("en", "src0") if len(r) == 2 else ())) for r in rows]
        schema = "doc_id long, text string, lang string, source string"
        extra = "n_chars long, kept long, root long, a long, size long, _rank long, target double"
        return spark.createDataFrame([(*r, 1, 2, 3, 4, 5, 6, 7.0) for r in full], f"{schema}, {extra}")

    return make
