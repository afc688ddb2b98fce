import datetime as dt
import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark.sql import functions as F

from pageloom.functions import text as T
from pageloom.functions import tokens
from pageloom.operators import chunks, export, fidelity, layout, redact, review, summary
from pageloom.plans.ingest import ingest_pdf
from pageloom.schemas import ELEMENTS, EXPORT_CHUNKS, MARKDOWN, PAGES, QUARANTINE, TRACE_SPANS
from pageloom.sinks import files


def pages(spark, *markdown, doc="d"):
    return spark.createDataFrame([(doc, n, m) for n, m in enumerate(markdown, 1)], MARKDOWN)


def chunked(spark, *markdown):
    return chunks.chunk_pages(pages(spark, *markdown), tokens.words).orderBy("chunk_id").collect()


def words(n):
    return " ".join(f"w{k}" for k in range(n))


def test_inheritance(spark):
    got = chunked(spark, "# Product X\n\n## System Requirements\n\n" + words(700), "One sentence.")
    assert len(got) == 2 and all(r.parent_hierarchy == ["Product X", "System Requirements"] for r in got)


def test_first_level_resets(spark):
    got = chunked(spark, "# Product X\n\n## SysReq\n\ntext", "# Product Y\n\nother")
    assert [r.parent_hierarchy for r in got] == [["Product X", "SysReq"], ["Product Y"]]


def test_budget(spark):
    got = chunked(spark, "# T\n\n" + "\n\n".join([words(200)] * 3))
    assert len(got) == 2 and all(r.token_count <= 512 for r in got)
    assert len(chunked(spark, words(2000))) == 1


def test_repeated_heading_is_one_section(spark):
    got = chunked(spark, *["## Appendix Notes\n\nnote"] * 10)
    assert len(got) == 1 and got[0].source_pages == list(range(1, 11)) and got[0].text == "\n\n".join(["note"] * 10)
    got = chunked(spark, "# A\n\n## S\n\none\n\n# A\n\ntwo")
    assert [(r.parent_hierarchy, r.text) for r in got] == [(["A", "S"], "one\n\ntwo")]


def test_node_types(spark):
    md = "3.14 is pi\n\n**bold**\n\n-5\n\n#\n\n####### x\n\n| a |\n| b |\n\nline one\nline two\n- x\n* y\n2. z\n### H ###"
    got = [(r.node_type, r.level, r.text) for r in chunks.nodes(pages(spark, md)).orderBy("node_seq").collect()]
    assert got == [
        ("list", None, "3.14 is pi"), ("list", None, "**bold**"), ("list", None, "-5"), ("paragraph", None, "#"), ("paragraph", None, "####### x"), ("table", None, "| a |\n| b |"),
        ("paragraph", None, "line one line two"), ("list", None, "- x\n* y\n2. z"), ("header", 3, "H ###"),
    ]
    assert chunks.nodes(pages(spark, "", "  \n ")).count() == 0


def walk(nodes):
    """The heading context by a plain walk."""
    slots, section, out = [None] * 6, 0, []
    for level, text in nodes:
        if level and slots[level - 1] != text:
            slots[level - 1 :] = [text] + [None] * (6 - level)
            section += 1
        out.append((section, [s for s in slots if s is not None]))
    return out


def test_context_against_a_walk(spark):
    import random

    random.seed(5)
    docs = [[(random.choice([None, 1, 2, 3, 6]), random.choice("ab")) for _ in range(25)] for _ in range(40)]
    rows = [(str(d), 1, k, "header" if level else "paragraph", level, text) for d, nodes in enumerate(docs) for k, (level, text) in enumerate(nodes)]
    df = spark.createDataFrame(rows, "document_id string, page_num int, node_seq int, node_type string, level int, text string")
    got = {(r.document_id, r.node_seq): (r.section, list(r.hierarchy)) for r in chunks.with_context(df).collect()}
    assert got == {(str(d), k): x for d, nodes in enumerate(docs) for k, x in enumerate(walk(nodes))}


def test_stitch(spark):
    rows = [("d", 0, ["Product X", "System Requirements"], "first"), ("d", 1, ["Product X", "System Requirements"], "second, same section"), ("d", 2, ["Product X", "Deployment"], "third, new subsection"), ("e", 0, None, "text only")]
    df = spark.createDataFrame(rows, "document_id string, chunk_id int, parent_hierarchy array<string>, text string")
    got = {r.document_id: r.markdown for r in chunks.stitch(df).collect()}
    assert got == {"d": "# Product X\n\n## System Requirements\n\nfirst\n\nsecond, same section\n\n## Deployment\n\nthird, new subsection", "e": "text only"}


def element(doc, page, seq, text, y):
    return (doc, page, seq, text, 0.0, y, 10.0, y + 8.0, 10.0)


def test_redaction(spark):
    rows = [element("ten", p, 0, f"Page {p} of 10", 770.0) for p in range(1, 11)] + [element("ten", p, 1, f"body {p}", 400.0) for p in range(1, 11)]
    rows += [element("once", 1, 0, "only here", 770.0)] + [element("three", p, 0, f"{'abc'[p - 1] * 9}", 770.0) for p in range(1, 4)]
    of_pages = spark.createDataFrame([(d, p, 800.0, 600.0) for d, n in (("ten", 10), ("once", 20), ("three", 3)) for p in range(1, n + 1)], PAGES)
    elements = spark.createDataFrame(rows, ELEMENTS)
    found = redact.candidates(elements, of_pages)
    assert found.where("document_id = 'ten'").count() == 10
    clusters = redact.clusters(found, redact.page_counts(of_pages))
    got = {d: sorted((r.pages_seen, round(r.frequency, 3), r.redact) for r in clusters.where(F.col("document_id") == d).collect()) for d in ("ten", "once", "three")}
    assert got == {"ten": [(10, 1.0, True)], "once": [(1, 0.05, False)], "three": [(1, 0.333, True)] * 3}
    kept = redact.kept_elements(elements, of_pages, clusters)
    assert sorted(r.text for r in kept.collect()) == sorted([f"body {p}" for p in range(1, 11)] + ["only here"])


def test_zone_key_rounds_the_exact_value(spark):
    df = spark.createDataFrame([(0.015,), (0.945,), (0.0375,)], "v double")
    assert [r[0] for r in df.select(redact.zone_key(F.col("v"))).collect()] == ["0.01", "0.94", "0.04"]


def test_fidelity(spark):
    kept = spark.createDataFrame([element("d", p, k, t, 400.0 - 20 * k) for p, texts in ((1, ["Hello world"]), (2, ["a long sentence that goes on and on"]), (3, list("abcdef"))) for k, t in enumerate(texts)], ELEMENTS)
    rendered = spark.createDataFrame([("d", 1, "Hello world", None, None), ("d", 2, "A", None, None), ("d", 3, "a b c d e f", 2, 3), ("d", 4, "", None, None), ("d", 5, "| a | b | c |\n| --- | --- | --- |\n| d | e | f |", 2, 3)], "document_id string, page_num int, markdown string, grid_rows int, grid_cols int")
    got = {r.page_num: r for r in fidelity.score(rendered, kept).collect()}
    assert got[1].c_retention == 1.0 and got[1].quality == "pass"
    assert got[2].c_retention < 0.3 and got[2].quality == "quarantined"
    assert got[3].t_matrix == 0.0 and abs(got[3].s_fidelity - 0.4) < 1e-9 and got[3].quality == "quarantined" and got[3].table_detected_in_pdf and not got[3].table_detected_in_md
    assert got[4].quality == "pass" and got[5].t_matrix == 1.0
    assert [r.markdown is not None for r in fidelity.page_records(fidelity.score(rendered, kept)).orderBy("page_num").collect()] == [False, True, True, False, False]


def test_gate_in_closed_form(spark):
    df = spark.range(0, 1001).select((F.col("id") / 1000).alias("c"))
    df = df.select("c", fidelity.quality(fidelity.fidelity(F.col("c"), F.lit(1.0))).alias("q"), fidelity.quality(fidelity.fidelity(F.col("c"), F.lit(0.0))).alias("lost"))
    for r in df.collect():
        assert r.q == ("pass" if r.c >= 0.75 else "warning_layout_anomaly" if r.c >= 0.25 else "quarantined") and r.lost == "quarantined"


def test_text_functions(spark):
    names = ["../../../etc/passwd", "..", "../", "foo/../../bar", "/etc/passwd", "a/b/c", "..\\..\\windows", "", "x" * 300]
    for r in spark.createDataFrame([(n,) for n in names], "n string").select("n", T.sanitize_path(F.col("n")).alias("s")).collect():
        assert r.s and ".." not in r.s and "/" not in r.s and "\\" not in r.s and len(r.s) <= 200
    df = spark.createDataFrame([([0.1, 0.2, 1.0, 1e-5, 25000000.0],), ([],), (None,)], "v array<float>")
    assert [r[0] for r in df.select(T.vector_literal(F.col("v"))).collect()] == ["[0.1,0.2,1,0.00001,25000000]", "[]", None]
    assert spark.createDataFrame([("  x ",)], "t string").select(T.trim(F.col("t"))).first()[0] == "x"
    assert spark.createDataFrame([("aB1-é²_",)], "t string").select(T.alnum_count(F.col("t"))).first()[0] == 5


def test_body_size_takes_the_smaller_of_several(spark):
    rows = [("d", 1, k, "t", 0.0, 0.0, 0.0, 0.0, s) for k, s in enumerate([12.0, 12.0, 10.0, 10.0, 20.0])]
    body = layout.body_font_size(spark.createDataFrame(rows, ELEMENTS))
    assert body.first().body_size == 10.0
    assert layout.heading_sizes(spark.createDataFrame(rows, ELEMENTS), body).first().sizes == [20.0, 12.0]


def store(spark):
    day = dt.datetime(2024, 1, 1)
    rows = [(i, t, "doc", 1, 0.4, 1.0, 0.0, True, False, f"md {i}", "pending", None, None, None, day + dt.timedelta(k)) for k, (i, t) in enumerate([("r1", "A"), ("r2", "A"), ("r3", "B")])]
    return spark.createDataFrame(rows, QUARANTINE)


def test_review(spark):
    s = store(spark)
    assert [r.id for r in review.records(s, "A").collect()] == ["r1", "r2"] and review.record(s, "B", "r1").count() == 0
    day = dt.datetime(2024, 2, 1)
    events = [("A", "r1", "approved", "better", "ok", day), ("A", "r2", "approved", "x", None, day), ("A", "r2", "rejected", None, None, day + dt.timedelta(1)), ("B", "r1", "rejected", None, None, day)]
    after = review.reviewed(s, spark.createDataFrame(events, "tenant_id string, id string, status string, reviewed_markdown string, review_note string, reviewed_at timestamp"))
    got = {r.id: (r.status, r.reviewed_markdown) for r in after.collect()}
    assert got == {"r1": ("approved", "better"), "r2": ("rejected", None), "r3": ("pending", None)}
    assert [r.id for r in review.records(after, "A", "rejected").collect()] == ["r2"] and review.records(after, "A", "all").count() == 2
    row = review.approved_chunks(after, "A").first()
    assert row.text == "better" and row.metadata == {"tenant_id": "A", "document_id": "doc", "page_num": "1", "source": "approved_quarantine", "s_fidelity": "0.4"}
    assert review.tenant_of(spark, None, "dev-key") == "dev-tenant"
    for key in (None, "wrong"):
        with pytest.raises(review.UnknownKey):
            review.tenant_of(spark, '{"k": "t"}', key)


def test_documents_newest_first(spark):
    rows = [(d, "A", dt.datetime(2024, 1, k), 1.0, True, 3, 3 - q, 0, q, 0, 1, 9) for k, (d, q) in enumerate([("old", 0), ("new", 1)], 1)] + [("other", "B", dt.datetime(2024, 1, 9), 1.0, True, 1, 1, 0, 0, 0, 1, 1)]
    got = review.document_list(spark.createDataFrame(rows, TRACE_SPANS), "A").collect()
    assert [(r.document_id, r.status) for r in got] == [("new", "needs_review"), ("old", "clean")]
    totals = summary.counters(spark.createDataFrame(rows, TRACE_SPANS)).first().asDict()
    text = summary.prometheus(totals, [("5", 1), ("+Inf", 3)], 12.5)
    assert "documents_ingested_total 3" in text and 'ingestion_latency_ms_bucket{le="+Inf"} 3' in text


class Recorder(BaseHTTPRequestHandler):
    seen: list = []

    def do_POST(self):
        body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        self.seen.append((self.command, self.path, body, dict(self.headers)))
        out = {"data": [{"embedding": [1.0, 2.0]} for _ in body.get("input", [])][: 1 if "short" in self.path else None]}
        data = json.dumps(out).encode()
        self.send_response(200)
        self.send_header("Content-Length", str(len(data)))
        self.end_headers()
        self.wfile.write(data)

    do_PUT = do_POST

    def log_message(self, *args):
        pass


@pytest.fixture
def server():
    s = HTTPServer(("127.0.0.1", 0), Recorder)
    Recorder.seen.clear()
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}"
    s.shutdown()


def test_export(spark, server):
    df = spark.createDataFrame([("a", "one", {"k": "v"}, [9.0, 9.0]), ("b", "two", {"text": "wins"}, None)], EXPORT_CHUNKS).coalesce(1)
    result = export.export(export.export_rows(df), export.QdrantExporter(server, "c", "key", 2), export.HTTPEmbedder(server + "/embed", "m", "secret"))
    assert result == {"target": "qdrant", "chunks_exported": 2, "embedder": "HTTPEmbedder"}
    calls = {path: (method, body) for method, path, body, _ in Recorder.seen}
    assert calls["/collections/c"][1] == {"vectors": {"size": 2, "distance": "Cosine"}}
    assert calls["/embed"][1] == {"model": "m", "input": ["two"]}
    points = {p["id"]: p for p in calls["/collections/c/points?wait=true"][1]["points"]}
    assert points["a"]["vector"] == [9.0, 9.0] and points["b"]["vector"] == [1.0, 2.0] and points["b"]["payload"] == {"text": "wins"}
    export.export(df, export.PineconeExporter(server, "k", "ns", 3))
    sent = next(b for _, p, b, _ in Recorder.seen if p == "/vectors/upsert")
    assert sent["namespace"] == "ns" and sent["vectors"][1]["values"] == [0.0, 0.0, 0.0]
    with pytest.raises(ValueError):
        export.PineconeExporter("", "k")
    with pytest.raises(ValueError):
        export.HTTPEmbedder(server + "/short", "m").embed(["x", "y"])
    with pytest.raises(ValueError):
        export.export(df.limit(0), export.QdrantExporter(server, "c"))
    assert [r.id for r in export.check_dimensions(df, 3).collect()] == ["a"]


def test_pgvector_statements():
    done = []

    class Connection:
        def cursor(self):
            return self

        def execute(self, sql, values):
            done.append((sql, values))

        def commit(self):
            done.append("commit")

        def rollback(self):
            done.append("rollback")

        def close(self):
            pass

    e = export.PgvectorExporter(Connection, dimensions=4)
    e.prepare()
    e.upsert([{"id": "t1", "text": "x", "metadata": None, "vector_text": "[1,2,3,4]"}, {"id": "t2", "text": "y", "metadata": {"a": "b"}, "vector_text": None}])
    assert "VECTOR(4)" in done[1][0] and "ON CONFLICT (id) DO UPDATE" in done[3][0] and done[4][1] == ("t2", "y", '{"a": "b"}', None) and done[-1] == "commit"
    with pytest.raises(ValueError):
        export.PgvectorExporter(Connection, "bad; drop")


def test_saved_ingest(spark, tmp_path):
    from pageloom.sources.pdf_writer import text_pdfs

    docs = spark.createDataFrame([(1, "first line\nsecond line"), (2, "other text")], "doc_id long, text string")
    done = ingest_pdf(text_pdfs(docs))
    assert {r.type for r in files.records(done).collect()} == {"page_fidelity", "chunk", "summary"}
    for _ in range(2):
        files.save(done, str(tmp_path), "A")
    assert files.read(spark, str(tmp_path), "traces", "A").count() == 2 and files.read(spark, str(tmp_path), "chunks", "B").count() == 0
    assert files.read(spark, str(tmp_path), "chunks", "A", "2").count() == done.chunks.where("document_id = '2'").count()


def test_repeated_ingests_and_reviews(spark, tmp_path):
    """A repeated ingest leaves nothing of the one before, and reviews outlast it."""
    from pageloom.operators import review
    from pageloom.sources.sample_report import page
    from pageloom.sources.pdf_writer import pdf

    root = str(tmp_path)
    assert files.read(spark, root, "quarantine", "A").count() == 0
    bad, good = pdf([page(13)]), pdf([page(3)])

    def ingest(rows):
        df = spark.createDataFrame(rows, "document_id string, content binary")
        done = ingest_pdf(df)
        files.save(done, root, "A", df)
        done.release()

    ingest([("a/b", bad), ("a_b", bad), ("c", good)])
    records = {r.document_id: r for r in files.quarantined(spark, root, "A").collect()}
    assert {*records} == {"a/b", "a_b"} and {r.status for r in records.values()} == {"pending"}
    files.add_reviews(spark.createDataFrame([("A", records["a_b"].id, "approved", "better", None, None)], "tenant_id string, id string, status string, reviewed_markdown string, review_note string, reviewed_at timestamp"), root)
    ingest([("a/b", good), ("a_b", bad)])
    after = {r.document_id: r for r in files.quarantined(spark, root, "A").collect()}
    assert {*after} == {"a_b"} and after["a_b"].status == "approved" and after["a_b"].reviewed_markdown == "better"
    assert files.read(spark, root, "traces", "A").count() == 3 and files.read(spark, root, "pages", "A", "a/b").first().quality == "pass"
    assert files.source_file(spark, root, "A", "a/b") == good and files.source_file(spark, root, "B", "a/b") is None
    assert files.audit_report(spark, root, "A", "a_b").first().quality == "quarantined"
    listed = review.listing(review.document_list(files.read(spark, root, "traces", "A"), "A"), "documents")
    assert listed["count"] == 3 and len(listed["documents"]) == 3


def test_budgets_are_in_tokens(spark):
    """Unless a counter is given: a word such as w100 has two or three tokens."""
    got = chunks.chunk_pages(pages(spark, "# T\n\n" + "\n\n".join([words(200)] * 3))).orderBy("chunk_id").collect()
    assert len(got) == 3 and all(200 < r.token_count <= 512 for r in got)


def test_frames(spark, tmp_path):
    from pageloom.sources import frames

    rows = [("one", b"%PDF-1"), ("two", b""), ("dre\u00ed", bytes(300))]
    data = frames.encode(rows)
    assert list(frames.decode(data)) == rows and data[:7] == b"\0\0\0\3one"
    for bad in (data[:-1], data[:2], frames.frame(b"id"), b"\xff\xff\xff\xff"):
        with pytest.raises(ValueError):
            list(frames.decode(bad))
    (tmp_path / "a").write_bytes(data)
    (tmp_path / "b").write_bytes(data[:-1])
    got = frames.read_frames(spark, str(tmp_path)).collect()
    assert sorted(r.document_id for r in got if r.error is None) == sorted([*(i for i, _ in rows), "one", "two"]) and sum(r.error is not None for r in got) == 1


def test_spans(spark):
    import io
    import json

    from pageloom.plans import tracing

    log = io.StringIO()
    tracer = tracing.Tracer(log)
    with pytest.raises(KeyError), tracer.span("ingest", document="d"):
        with tracer.span("extract"):
            pass
        raise KeyError("x")
    rows = {r.name: r for r in tracing.table(spark, tracer).collect()}
    assert rows["extract"].parent_span_id == rows["ingest"].span_id and len(rows["ingest"].trace_id) == 32 and len(rows["ingest"].span_id) == 16
    assert rows["ingest"].error.startswith("KeyError") and rows["ingest"].attributes == {"document": "d"} and rows["ingest"].duration_ms >= rows["extract"].duration_ms
    assert [json.loads(x)["name"] for x in log.getvalue().splitlines()] == ["extract", "ingest"]
    assert tracing.health(spark)["status"] == "ok"


def test_vocabularies():
    """Merges made from ranks are those that the tokenizer's own file lists."""
    import base64
    import json

    import public_tokenizers as P

    from pageloom.functions import vocabularies as V

    own = V.byte_characters()
    assert len({*own.values()}) == 256 and V.as_bytes(V.printable(bytes(range(256)))) == bytes(range(256)) and own[32] == "\u0120"
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    with open(P.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        listed = json.load(f)["model"]["merges"]
    listed = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in listed]
    assert V.merges(ranks) == listed
    assert V.widths_of_metrics(["C 65 ; WX 667 ; N A ; B 1 2 3 4 ;", "C -1 ; WX 333 ; N ring ;", "Comment"], {65: "A", 202: "ring"})[64:66] == [500, 667]


def test_core_widths():
    from pageloom.sources.pdf_fonts import core_font, font

    get = lambda x: x
    wide = lambda face, code, encoding="WinAnsiEncoding": round(core_font(face, encoding).by_byte[code] * 1000)
    assert [wide("Helvetica", c) for c in (39, 0xCD, 0xED, 0xE9, 0x96, 0x97, 0xA9, 0xDF, 127)] == [191, 278, 278, 556, 556, 1000, 737, 611, 350]
    assert [wide("Times-Italic", c) for c in (65, 0x93, 0xFC, 0xD7)] == [611, 556, 500, 675] and [wide("Times-BoldItalic", c) for c in (65, 0xAC, 0xDD)] == [667, 606, 611]
    assert [wide("Helvetica", c, "StandardEncoding") for c in (39, 96, 164, 174, 0xE1, 128)] == [222, 222, 167, 500, 1000, 500]
    assert font({"BaseFont": "Helvetica", "Encoding": "MacRomanEncoding"}, get).width(65) == 0.5
    assert font({"BaseFont": "Arial,Italic", "Encoding": "WinAnsiEncoding"}, get).width(0xE9) == 0.556
