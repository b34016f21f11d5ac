"""Log lines are judged by JSON syntax alone, and NaN fulfils no range."""

from pyspark.sql import functions as F, types as T

from dispatchlens import policy
from dispatchlens.operators import contract
from dispatchlens.sources import jsonl

FIELDS = T.StructType([T.StructField("name", T.StringType()), T.StructField("took", T.LongType()),
                       T.StructField("paths", T.ArrayType(T.StringType())),
                       T.StructField("did", T.StructType([T.StructField("one", T.StringType())]))])


def test_every_json_object_is_a_record(spark):
    lines = ['{"name": "a", "took": "30"}', '{"name": "b", "took": 30.5}', '{"name": "c", "did": "none"}',
             '{"name": "d", "paths": "x"}', '\t{"name": "e", "took": null}', '{"name": 6, "paths": ["p", 1], "did": {"one": "y"}} ',
             '{"name": "cut', "", "   ", "[1]", "null", '"text"', "7"]
    frame = spark.createDataFrame([(x,) for x in lines], "value string")
    found = sorted((r["name"], r["took"], r["paths"], r["did"]["one"] if r["did"] else None)
                   for r in jsonl.parse_lines(frame, FIELDS).collect())
    assert found == [("6", None, ["p", "1"], "y"), ("a", 30, None, None), ("b", 30, None, None), ("c", None, None, None),
                     ("d", None, None, None), ("e", None, None, None)]


def test_not_a_number_is_out_of_range(spark):
    name = next(c for c in policy.NON_NEGATIVE if isinstance(contract.feature_type(c), T.DoubleType))
    records = spark.createDataFrame([(f'{{"{name}": {v}}}',) for v in ('"NaN"', "-1.0", '"Infinity"', "2.0")], "payload string")
    broken = [f"range:{name}" in r["violations"] or "unreadable" in r["violations"]
              for r in contract.check_records(records).select("payload", "violations").collect()]
    assert broken == [True, True, False, False]
