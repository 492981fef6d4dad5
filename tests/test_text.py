import pytest
from pyspark.sql import functions as F

from tablefold.functions import text

CASES = {
    "firstName": "first name", "userID": "user id", "HTMLParser": "html parser", "IDs": "i ds", "Name1": "name 1",
    "A1b": "a 1b", "street_name": "street name", "First_Name": "first   name", "first_Name": "first  name",
    "Postal Code": "postal code", "Unnamed: 3": "unnamed : 3", "URLs2Go": "ur ls 2 go", "aÉb": "a b", "größe": "gr e",
    "x[0]": "x 0", "ABC": "abc", "a٣b": "a٣b", "": "",
}


def cleaned(spark, headers):
    df = spark.createDataFrame([(i, h) for i, h in enumerate(headers)], "i int, h string")
    return [r[0] for r in df.orderBy("i").select(text.clean_header(F.col("h"))).collect()]


def test_clean_header(spark):
    assert cleaned(spark, CASES) == list(CASES.values())


@pytest.mark.parametrize(
    "url, owner, repo",
    [("https://host/own/rep/blob/main/a/b.csv", "own", "rep"), ("https://host/o/r/blob/x/blob.csv", "o", "r")],
)
def test_repo_key(spark, url, owner, repo):
    row = spark.range(1).select(text.repo_key(F.lit(url)).alias("k")).first().k
    assert (row.owner, row.repo) == (owner, repo)


def test_eligible_and_social(spark):
    heads = [("name", True), ("name 2", False), ("Unnamed: x", False), ("Tweet", True), ("x٣", False)]
    df = spark.createDataFrame(heads, "h string, ok boolean")
    assert df.filter(text.eligible_header(F.col("h")) != F.col("ok")).count() == 0
    social = spark.createDataFrame([("retweet_id",), ("Twitter",)], "h string").select(text.social_header(F.col("h")))
    assert [r[0] for r in social.collect()] == [True, False]
