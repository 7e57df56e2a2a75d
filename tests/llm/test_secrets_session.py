"""The secret scan in a session in which something was observed before."""

from pyspark.sql import Observation
from pyspark.sql import functions as F

from tidelog.llm.secrets import candidates, reviewed, scan


def test_the_scan_runs_after_an_observation(spark, docs):
    seen = Observation()
    spark.range(3).observe(seen, F.count("*").alias("n")).write.format("noop").mode("overwrite").save()
    assert seen.get == {"n": 3}
    documents = docs([(i, f'password = "q8Zr{i}TfLw2xVb9" mail someone{i}@example.org seen 2024-01-0{i % 9 + 1}T10:00:00Z')
                      for i in range(30)])
    found = scan(documents, reviewed(candidates(documents)))
    found.write.format("noop").mode("overwrite").save()
    assert {r["secret"] for r in found.collect()} == {True, False}
