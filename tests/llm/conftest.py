import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, note string"
#: Names that the operators use themselves.
CLASHES = ["_cut", "_id", "_key", "_own", "_spans", "_items", "_sid", "h", "fp", "pos", "host", "part", "tie", "bucket", "shard", "slot", "begin", "sketch", "text_key", "component_id", "n_words", "kept", "ids", "key", "o", "turns"]


def rows_of(spark, sf):
    return [(r.doc_id, r.text, r.lang, r.source, r.n_chars, "x") for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]


def clashing(df):
    return df.selectExpr("*", *(f"'clash' AS {c}" for c in CLASHES))


@pytest.fixture(scope="session")
def odd(spark, sf):
    """Documents of the smallest tables plus nulls, empty and very long texts, repeats, ties and a clashing extra column."""
    rows = rows_of(spark, sf)
    long = " ".join(f"w{i * 7919 % 5003} and" for i in range(12000)) + "\n" + "same line here\n" * 300
    rows += [
        (9001, None, None, None, None, None), (9002, "", "en", "src0", 0, None), (9003, long, "en", "src0", len(long), None), (9004, long, "en", "src0", len(long), None),
        (9005, " \t\n\x0b ", "en", None, 5, None), (9006, "one", "en", "src1", 3, None), (9007, rows[3][1], "en", "src1", 1, None), (9008, rows[3][1] + " tail", "en", "src1", 1, None),
        (9009, "İ \x1c ſ <|endoftext|> Σς 日本語 \x85 x y " * 9, "ja", "src2", 9, None), (9010, "a b c d e f g h i j k l m n o p q r s t u " * 3, "en", "src2", 9, None),
    ]
    rows.append(rows[5])
    return rows


@pytest.fixture(scope="session")
def docs(spark, odd):
    return clashing(spark.createDataFrame(odd, SCHEMA).repartition(3))


@pytest.fixture(scope="session")
def no_docs(spark):
    return clashing(spark.createDataFrame([], SCHEMA))
