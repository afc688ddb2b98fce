"""Queries over more rows than the given tables hold in one group."""

from pageloom import registry


def test_md_grid_counts_all_rows(spark, tmp_path):
    keys = spark.range(3000).selectExpr("if(id < 2500, 1L, id) as l_orderkey", "id as l_partkey", "id % 7 as l_suppkey", "'N' as l_returnflag")
    keys.write.parquet(f"{tmp_path}/lineitem.parquet")
    got = {r.page: (r.n_rows, r.n_cols) for r in registry.QUERIES["md_grid"](spark, str(tmp_path)).collect()}
    assert got[1] == (2500, 3) and got[2999] == (None, None) and len(got) == 501


def test_files_without_content_give_an_error_row(spark):
    from pageloom.sources import pdf

    df = spark.createDataFrame([("none", None, None), ("large", b"%PDF", pdf.MAX_BYTES + 1)], "document_id string, content binary, length long")
    assert sorted(r.document_id for r in pdf.errors(pdf.extract(df)).collect()) == ["large", "none"]
    assert pdf.errors(pdf.extract(df.drop("length").where("content is null"))).count() == 1


def test_orders_with_many_rows_a_line_have_one_column(spark, tmp_path):
    rows = spark.range(18).selectExpr("5L as l_orderkey", "id as l_partkey", "id as l_suppkey", "cast(id % 6 + 1 as int) as l_linenumber", "'N' as l_returnflag")
    rows.write.parquet(f"{tmp_path}/lineitem.parquet")
    assert [tuple(r) for r in registry.QUERIES["page_columns"](spark, str(tmp_path)).select("page_num", "cells", "column_num").collect()] == [(5, 54, 0)]


def test_floats_are_written_as_in_sql(spark, tmp_path):
    import duckdb

    odd = [19 / 1024, 0.166015625, -1.52587890625e-05, 139120992.0, 47110397952.0, 8388607.5, 2e-3, 1.1e-5, 0.1, 1.0, -0.0]
    rows = [(0, odd), (1, []), (2, None), (3, [k / 2.0**17 for k in range(1, 20_000, 2)])]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{tmp_path}/embeddings.parquet/*.parquet'")
    want = dict(con.sql(registry.ORACLE_SQL["vector_literal"]).fetchall())
    assert {r.vec_id: r.literal for r in registry.QUERIES["vector_literal"](spark, str(tmp_path)).collect()} == want


def test_similar_texts_are_all_pairs_of_any_blocks(spark):
    """Compared in the JVM: texts of any letters and lengths, in blocks of any size, against edit distances by the book."""
    import random

    from pageloom.functions import folds
    from pageloom.operators import redact

    rng = random.Random(7)
    letters = ["etaoin shrdlu", "eé\U0001f600\U00010348zß ", "".join(map(chr, range(0x4E00, 0x4E78))), "ab"]
    base = ["".join(rng.choice(some) for _ in range(n)) for some in letters for n in (1, 2, 3, 5, 40, 63, 64, 65, 127, 128, 130, 300)] + ["", "Erti " * 90, "Erti, " * 80]

    def edited(t, share):
        kept = [c for c in t if rng.random() > share / 2]
        return "".join(rng.choice("xyz \U0001f600") if rng.random() < share / 2 else c for c in kept)

    texts = sorted({*base, *(edited(t, s) for t in base for s in (0.1, 0.33, 0.38, 0.45)), *(t[len(t) // 3 :] for t in base), *(t[: int(len(t) * 0.65)] for t in base)})
    rng.shuffle(texts)
    want = {(i, j) for i, x in enumerate(texts, 1) for j, y in enumerate(texts[: i - 1], 1) if folds.similar(x, y, 0.65)}
    numbered = spark.createDataFrame([("d", "0.04", t, i) for i, t in enumerate(texts, 1)], "document_id string, y_zone string, text string, number int")
    for rows, chars in ((1 << 20, 1 << 20), (7, 1 << 20), (1 << 20, 500)):
        got = [(r.number, r.other) for r in redact.similar_texts(numbered, rows, chars).collect()]
        assert len(got) == len(set(got)) and set(got) == want and 100 < len(want) < len(texts) ** 2 // 4
