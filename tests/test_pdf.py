import io
import time
import zlib
from contextlib import redirect_stdout

import pytest

from terrace import catalogue
from terrace.functions import pdf
from terrace.operators import documents
from terrace.sources.testdata import PAGE_LINES, pdf_of

TEXT = "\n".join(f"Line {i} (with brackets) and \\ and é" for i in range(100))


@pytest.mark.parametrize("deflated", [False, True])
@pytest.mark.parametrize("mapped", [False, True])
def test_round_trip(deflated, mapped):
    pages, reason = pdf.read(pdf_of(TEXT, deflated, mapped))
    assert reason is None
    assert len(pages) == -(-100 // PAGE_LINES)
    assert "\n".join(pages) == TEXT


def test_other_scripts_by_a_map():
    text = "Ελληνικά, русский, 日本語, 𝄞 clef"
    assert pdf.read(pdf_of(text, True, True)) == ([text], None)


def file(*objects):
    return b"%PDF-1.5\n" + b"".join(b"%d 0 obj\n" % n + body + b"\nendobj\n" for n, body in objects)


TREE = ((1, b"<< /Type /Catalog /Pages 2 0 R >>"), (2, b"<< /Type /Pages /Kids [3 0 R 3 0 R 9 0 R] >>"), (3, b"<< /Type /Page /Contents [4 0 R 5 0 R] >>"))


def content(data):
    return b"<< /Length %d >> stream\n" % len(data) + data + b"\nendstream"


def test_operators_and_several_streams():
    one = rb"BT /F1 9 Tf [(Wor) -20 (ld) 120 <21>] TJ 0 -12 Td (a\(b\)\101\n) Tj (next) ' 5 0 Td (same) Tj % (no) Tj" + b"\nET"
    two = b"BT 1 0 0 1 72 600 Tm (x) Tj 1 0 0 1 90 600 Tm (y) Tj 1 0 0 1 72 580 Tm (nested (round) z) Tj ET"
    pages, reason = pdf.read(file(*TREE, (4, content(one)), (5, content(two))))
    assert reason is None
    assert pages == ["World!\na(b)A\n\nnextsamexy\nnested (round) z"]


def test_objects_in_object_streams():
    inner = b" ".join(body for _, body in TREE)
    places, at = [], 0
    for n, body in TREE:
        places.append(b"%d %d" % (n, at))
        at += len(body) + 1
    head = b" ".join(places) + b" "
    packed = zlib.compress(head + inner)
    holder = b"<< /Type /ObjStm /N 3 /First %d /Length %d /Filter /FlateDecode >> stream\n" % (len(head), len(packed)) + packed + b"\nendstream"
    assert pdf.read(file((7, holder), (4, content(b"BT (deep) Tj ET")), (5, content(b"")))) == (["deep"], None)


@pytest.mark.parametrize(
    ("data", "reason"),
    [
        (None, "unknown format"), (b"", "unknown format"), (b"plain text", "unknown format"), (b"%PDF-1.4 nothing", "no page"), (b"%PDF-1.4 trailer << /Encrypt 5 0 R >>", "encrypted"),
        (file(*TREE, (4, b"<< /Filter /LZWDecode /Length 3 >> stream\nabc\nendstream")), "unknown compression LZWDecode"), (file(*TREE, (4, b"<< /Filter /FlateDecode /Length 3 >> stream\nabc\nendstream")), "a stream is broken"),
        (file((1, b"<< /Type /Catalog /Pages 1 0 R >>"), (2, b"<< /Type /Pages /Kids [2 0 R] >>")), "no page"),
    ],
)
def test_reasons(data, reason):
    assert pdf.read(data) == (None, reason)


def test_any_damage_gives_a_result():
    whole = pdf_of(TEXT, True, True)
    for i in range(0, len(whole), 37):
        pages, reason = pdf.read(whole[:i] + b"\xff<(" + whole[i + 5 :])
        assert (pages is None) != (reason is None)


def test_hostile_strings_take_linear_time():
    for data in (b"(" * 200_000, b"<" * 200_000, b"(\\" * 100_000, b"(((" * 60_000 + b")"):
        began = time.time()
        pdf.read(file(*TREE, (4, content(b"BT " + data + b" Tj ET"))))
        assert time.time() - began < 5


def test_unread_documents(spark):
    rows = [("raw_documents/a/b/x.pdf", pdf_of("one\ntwo", True, False)), ("raw_documents/a/b/y.pdf", b"%PDF-"), ("raw_documents/a/b/z.txt", b"plain"), ("raw_documents/a/b/n.pdf", None)]
    files = spark.createDataFrame(rows, "path string, content binary").selectExpr("*", "length(content) AS length", "current_timestamp() AS modificationTime")
    bronze = documents.bronze_documents(files)
    got = {r["file_name"]: r["parsed_text"] for r in documents.parsed_documents(bronze, documents.pdf_pages).collect()}
    assert got == {"x.pdf": "one\ntwo", "z.txt": "plain"}
    why = {r["doc_path"][-5:]: r["reason"] for r in documents.unread_documents(bronze).collect()}
    assert why == {"y.pdf": "no page", "n.pdf": "unknown format"}


def test_files_are_read_once_and_some_at_a_time(spark, sf_dir):
    """Each file goes to Python once, whatever is asked of its pages, and no Arrow batch gathers thousands of files."""
    spark.conf.set("spark.sql.execution.pythonUDF.arrow.enabled", "true")
    try:
        shown = io.StringIO()
        with redirect_stdout(shown):
            catalogue.QUERIES["pdf_extraction"](spark, sf_dir).explain()
    finally:
        spark.conf.unset("spark.sql.execution.pythonUDF.arrow.enabled")
    assert "Arrow" not in shown.getvalue()
    assert shown.getvalue().count("BatchEvalPython") == 2  # pages, and reasons
