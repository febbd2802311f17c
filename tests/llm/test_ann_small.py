"""Every query has k neighbours if there are k candidates, however few rows its leaves hold."""

import numpy as np

from tidemark.llm import ann


def test_leaves_of_one_row(spark):
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(0, 0.01, (300, 4)) + 1, rng.normal(0, 1, (9, 4)) * 1000])
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(308, (x[308] + 0.5).tolist())] * 3
    frame = spark.createDataFrame(rows, "id long, v array<double>").repartition(2)
    index = ann.build_index(frame)
    queries = frame.where("id >= 295").groupBy("id").agg({"v": "min"}).toDF("id", "v")
    made = ann.search(index, queries, 10, 1).groupBy("query_id").count().collect()
    assert {(r.query_id, r["count"]) for r in made} == {(i, 10) for i in range(295, 309)}
