"""Operator 5: repeated rows, against the registered SQL."""

import duckdb

from lakeweave.llm import catalog


def test_repeated_rows_are_candidates(spark, docs, tmp_path):
    rows = [(i, [float((i * 7 + j * 3) % 11) for j in range(4)]) for i in range(70)]
    rows += [(9, [40.0, 40.0, 40.0, 40.0])] * 30  # the best of all, repeated
    rows += [rows[40], rows[40], (20, [1.0, 9.0, 0.0, 2.0])]  # queries: equal rows, another vector under one id
    folder = str(tmp_path)
    spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3).write.parquet(f"{folder}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{folder}/embeddings.parquet/*.parquet')")
    answer = con.sql(catalog.ORACLES["op5_topk"])
    got = catalog.QUERIES["op5_topk"](spark, folder).select(*answer.columns).collect()
    assert sorted(map(tuple, got)) == sorted(answer.fetchall())
    assert sum(r["query_id"] == 0 for r in got) == 20
