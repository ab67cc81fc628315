import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """A documents table from texts, or from (doc_id, text, lang, source) rows; columns named
    like the operators' own stand beside it."""

    def make(rows, *, clash=True):
        full = []
        for k, row in enumerate(rows):
            row = row if isinstance(row, tuple) else (k, row)
            row = (*row, *(None, "en", "s")[len(row) - 1 :]) if len(row) < 4 else row
            full.append((*row, None if row[1] is None else len(row[1])))
        df = spark.createDataFrame(full, SCHEMA).repartition(3)
        if clash:
            for name in ("id", "key", "score", "size", "rank", "label", "hash", "_place", "bin", "f0", "th"):
                df = df.selectExpr("*", f"'x' as {name}")
        return df

    return make


@pytest.fixture
def rows_of():
    """A result as a dict from its first column."""

    def collect(df, *columns):
        found = {}
        for row in df.collect():
            found.setdefault(row[0], []).append(tuple(row[c] for c in columns or df.columns[1:]))
        return {k: sorted(v, key=repr) for k, v in found.items()}

    return collect
