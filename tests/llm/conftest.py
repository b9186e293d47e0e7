import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_texts import rows_of  # noqa: E402

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
@pytest.fixture()
def docs(spark):
    """A function: texts or rows -> DataFrame of documents in several partitions."""

    def make(texts, parts: int = 3):
        rows = texts if texts and isinstance(texts[0], tuple) else rows_of(texts)
        return spark.createDataFrame(rows, DOC_SCHEMA).repartition(parts) if rows else spark.createDataFrame([], DOC_SCHEMA)

    return make


@pytest.fixture()
def table_dir(spark, tmp_path):
    """A function: DataFrames by table name -> folder with their Parquet files."""

    def write(**tables) -> str:
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write


@pytest.fixture()
def twin(spark):
    """A function: (module, query, folder) -> (Spark rows, DuckDB rows), columns by name."""

    def both(module, name: str, folder: str):
        import duckdb
        con = duckdb.connect()
        from pathlib import Path
        for p in Path(folder).glob("*.parquet"):
            con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}/*.parquet')")
        theirs = con.sql(module.ORACLES[name])
        cols = sorted(theirs.columns)
        ours = module.QUERIES[name](spark, folder)
        assert sorted(ours.columns) == cols
        key = lambda r: tuple((x is None, str(x)) for x in r)
        return (sorted((tuple(r) for r in ours.select(*cols).collect()), key=key),
                sorted(theirs.project(", ".join(f'"{c}"' for c in cols)).fetchall(), key=key))

    return both
