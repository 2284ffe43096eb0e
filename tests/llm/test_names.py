"""Extra columns whatever their names."""

from pyspark.sql import functions as F

from logpulse.llm import secrets, simhash
from logpulse.llm.common import prepare


def odd(spark):
    prepare(spark)
    rows = [(1, "the cat sat on the mat", 1), (2, "the cat sat on the mat", 2), (None, None, 3), (4, "password = abcdefgh12345678", 4)]
    names = ["a.b", "__root", "__key", "__digest", "__n", "__null", "__text", "_0", "row", "absent", "root", "n", "x y", "tick`"]
    return spark.createDataFrame(rows, "doc_id long, text string, mark int").select("*", *(F.col("mark").alias(n) for n in names)), names


def test_one_of_each_carries_columns_of_any_name(spark):
    df, names = odd(spark)
    got = simhash.one_of_each(df)
    assert got.columns == df.columns
    rows = sorted((tuple(r) for r in got.collect()), key=str)
    assert [r[0] for r in rows] == [1, 4, None] and all(set(r[2:]) == {r[2]} for r in rows)


def test_masking_carries_columns_of_any_name(spark):
    df, _ = odd(spark)
    got = secrets.mask_secrets(df, None)
    assert got.columns == df.columns
    rows = {r[2]: r for r in map(tuple, got.collect())}
    assert rows[3][1] is None and rows[1][1] == "the cat sat on the mat"
    assert "abcdefgh" not in rows[4][1] and all(set(r[2:]) == {k} for k, r in rows.items())
    assert secrets.mask_secrets(df.select("text"), None).columns == ["text"]
