"""Tables of the driver's data set as documents, pages, elements and segments. These mappings are the engine's own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def conversation_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A conversation is a document, a turn a page under a heading of its role."""
    df = table(spark, sf_dir, "conversations")
    return df.select(F.col("conv_id").cast("string").alias("document_id"), (F.col("turn") + 1).cast("int").alias("page_num"), F.concat(F.lit("# "), F.col("role"), F.lit("\n\n"), F.col("text")).alias("markdown"))


def document_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of a document is a page."""
    df = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("document_id"), F.posexplode(F.split("text", "\n")).alias("n", "markdown"))
    return df.select("document_id", (F.col("n") + 1).alias("page_num"), "markdown")


def line_elements(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(elements, pages): a source is a document, each of its documents a page of 800 points, lines from top to bottom.

    The first line lies in the header zone, the last in the footer zone, others in between.
    """
    df = table(spark, sf_dir, "documents").select(F.col("source").alias("document_id"), F.col("doc_id").cast("int").alias("page_num"), F.split("text", "\n").alias("lines"))
    rows = df.select("document_id", "page_num", F.size("lines").alias("n"), F.posexplode("lines").alias("elem_seq", "text"))
    y = F.when(F.col("elem_seq") == 0, 770.0).when(F.col("elem_seq") == F.col("n") - 1, 30.0).otherwise(400.0)
    elements = rows.select("document_id", "page_num", "elem_seq", "text", F.lit(54.0).alias("x_min"), y.alias("y_min"), F.lit(550.0).alias("x_max"), (y + 10.0).alias("y_max"), F.lit(10.0).alias("font_size"))
    pages = df.select("document_id", "page_num", F.lit(800.0).alias("page_height"), F.lit(612.0).alias("page_width"))
    return elements, pages


def order_cells(spark: SparkSession, sf_dir: str, apart: bool = False) -> DataFrame:
    """An order is a page; each of its lines a row of three cells, 12 points apart.

    Rows with one line number lie on each other, or with ``apart`` below each other, as cells of a printed table do.
    """
    df = table(spark, sf_dir, "lineitem")
    if apart:
        df = df.withColumn("l_linenumber", F.row_number().over(W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")))
    cells = F.array(*(F.col(c).cast("string") for c in ("l_partkey", "l_suppkey", "l_returnflag")))
    rows = df.select(F.col("l_orderkey"), "l_linenumber", F.posexplode(cells).alias("k", "text"))
    y = 700.0 - 12.0 * F.col("l_linenumber")
    x = 60.0 + 100.0 * F.col("k")
    return rows.select((F.col("l_orderkey") % 100).cast("string").alias("document_id"), F.col("l_orderkey").cast("int").alias("page_num"), (F.col("l_linenumber") * 3 + F.col("k")).cast("int").alias("elem_seq"), "text", x.alias("x_min"), y.alias("y_min"), (x + 40.0).alias("x_max"), (y + 8.0).alias("y_max"), F.lit(8.0).alias("font_size"))


def order_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order is a page with a lattice: a rule above the first and below every line, and one more upright rule than it has lines, at most five."""
    df = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").cast("int").alias("n"))
    bottom = 700.0 - 20.0 * F.col("n")
    across = F.transform(F.sequence(F.lit(0), F.col("n")), lambda k: F.struct(F.lit(50.0).alias("x0"), (700.0 - 20.0 * k).alias("y0"), F.lit(350.0).alias("x1"), (700.0 - 20.0 * k).alias("y1")))
    down = F.transform(F.sequence(F.lit(0), F.least("n", F.lit(4))), lambda k: F.struct((50.0 + 75.0 * k).alias("x0"), F.lit(700.0).alias("y0"), (50.0 + 75.0 * k).alias("x1"), bottom.alias("y1")))
    rows = df.select("l_orderkey", F.posexplode(F.concat(across, down)).alias("seg_seq", "s"))
    return rows.select((F.col("l_orderkey") % 100).cast("string").alias("document_id"), F.col("l_orderkey").cast("int").alias("page_num"), "seg_seq", "s.*")


OUTLINE = ("o_orderstatus", "o_orderpriority", "year", "quarter", "month", "day")


def outline_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer is a document, an order a page under headings of six levels, from its status to its day."""
    df = table(spark, sf_dir, "orders").withColumns({"year": F.year("o_orderdate"), "quarter": F.quarter("o_orderdate"), "month": F.month("o_orderdate"), "day": F.dayofmonth("o_orderdate")})
    page = F.row_number().over(W.partitionBy("o_custkey").orderBy("o_orderkey"))
    heads = [F.concat(F.lit("#" * n + " "), F.col(c).cast("string")) for n, c in enumerate(OUTLINE, 1)]
    return df.select(F.col("o_custkey").cast("string").alias("document_id"), page.alias("page_num"), F.concat_ws("\n\n", *heads, F.concat(F.lit("Order "), F.col("o_orderkey").cast("string"))).alias("markdown"))


def paired_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten parts are a page, each a line: on odd pages two runs of six words with a gutter between, on even pages one run."""
    df = table(spark, sf_dir, "part").select((F.expr("p_partkey div 10") + 1).cast("int").alias("page_num"), (F.col("p_partkey") % 10).cast("int").alias("line"))
    two = F.col("page_num") % 2 == 1
    runs = F.when(two, F.array(F.struct(F.lit(0).alias("k"), F.lit(50.0).alias("a"), F.lit(290.0).alias("z")), F.struct(F.lit(1).alias("k"), F.lit(330.0).alias("a"), F.lit(570.0).alias("z")))).otherwise(F.array(F.struct(F.lit(0).alias("k"), F.lit(50.0).alias("a"), F.lit(570.0).alias("z"))))
    y = 700.0 - 14.0 * F.col("line")
    rows = df.select("page_num", "line", y.alias("y"), F.explode(runs).alias("r"))
    return rows.select(F.lit("parts").alias("document_id"), "page_num", (F.col("line") * 2 + F.col("r.k")).alias("elem_seq"), F.lit("six words stand in this run").alias("text"), F.col("r.a").alias("x_min"), F.col("y").alias("y_min"), F.col("r.z").alias("x_max"), (F.col("y") + 10.0).alias("y_max"), F.lit(10.0).alias("font_size"))


def part_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A brand is a document, a part an element whose size is its font size."""
    df = table(spark, sf_dir, "part")
    return df.select(F.col("p_brand").alias("document_id"), F.lit(1).alias("page_num"), F.col("p_partkey").cast("int").alias("elem_seq"), F.col("p_name").alias("text"), F.col("p_size").cast("double").alias("font_size"))


def html_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headings, paragraphs and list items of web pages as Markdown."""
    df = table(spark, sf_dir, "pages")
    parts = F.regexp_extract_all("html", F.lit(r"(?s)(<(?:h1|p|li)(?:\s[^>]*)?>.*?)(?=</?(?:h1|p|li|ul|article|footer|nav)\b)"), F.lit(1))

    def block(part):
        text = F.regexp_replace(F.regexp_replace(part, r"(?s)<[^>]*>", " "), r"\s+", " ")
        head = F.when(part.startswith("<h1"), "# ").when(part.startswith("<li"), "- ").otherwise("")
        return F.concat(head, F.trim(text))

    return df.select(F.col("page_id").cast("string").alias("document_id"), F.lit(1).alias("page_num"), F.array_join(F.transform(parts, block), "\n\n").alias("markdown"))
