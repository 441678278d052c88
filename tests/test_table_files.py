"""Queries on tables whose files are in no order."""

from framewright import file_queries


def test_a_catalog_has_the_order_of_its_ids(spark, tmp_path):
    # Of two documents with one text the one with the smaller id stays, wherever it lies; larger ids lie in larger files, which are read first.
    path = str(tmp_path / "documents.parquet")
    for first in (40, 20, 0):
        rows = [(i, f"text {i % 20}", "en", f"s{i // 20}") for i in range(first, first + 20)]
        rows += [(1000 * (1 + first) + i, f"pad {first} {i}", "en", "pad") for i in range(first * 5)]
        spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").coalesce(1).write.mode("append").parquet(path)
    got = {r.channel_id: r.n for r in file_queries.register_catalog(spark, str(tmp_path)).collect()}
    assert got == {"s0": 20, "pad": 300}
