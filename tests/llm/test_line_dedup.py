"""Line deduplication against a plain reading of its rule, and against SQL."""

import hashlib

import pytest
from pyspark.sql import functions as F

from martloom.llm import line_dedup
from martloom.llm.queries import QUERIES, SQL
from tests.compare import connect, difference
from tests.plans import plan_text

BLANKS = " \t\n\x0b\x0c\r"
LOWER = {c: c + 32 for c in range(65, 91)}


def by_rule(rows, least=10):
    """(doc_id, kept text, lines, dropped) per row; ids that repeat are one document, none comes last."""
    order = lambda d: (d is None, d or 0)
    holders = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            key = line.strip(BLANKS).translate(LOWER)
            if len(key) >= least:
                holders.setdefault(key, set()).add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if min(holders.get(x.strip(BLANKS).translate(LOWER), {doc}), key=order) == doc]
        out.append((doc, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def digests(docs):
    return sorted((tuple(r) for r in line_dedup.line_digests(docs).select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect()), key=str)


AWKWARD = [
    (5, "Shared line number one\nown line of five here\n\n  SHARED LINE NUMBER TWO\t"),
    (2, "shared line number two\r\nshared line number two\nshort\nsame short"),
    (9, "short\n\x0bShared Line Number One \x0c\nÉtude pour la main gauche"),
    (9, "étude pour la main gauche\nShared line number one"),
    (9, "étude pour la main gauche\nShared line number one"),
    (3, "étude pour la main gauche\nÉtude pour la main gauche"),
    (None, "Shared line number one\na line without an id"),
    (None, "a line without an id\nshared line number two"),
    (4, None),
    (6, ""),
    (7, "\n\n"),
    (8, "\u212aelvin temperature"),
    (10, "Kelvin temperature"),
    (-1, "\n".join(f"line of the long text {i % 700}" for i in range(20_000))),
    (1, "\n".join(f"Line of the LONG text {i}" for i in range(0, 20_000, 3))),
]


def test_awkward_lines(spark):
    docs = spark.createDataFrame(AWKWARD, "doc_id bigint, text string").withColumns({c: F.lit("x") for c in ("key", "line", "slice", "words", "text_hash")})
    assert digests(docs) == by_rule(AWKWARD)
    kept = line_dedup.without_repeats(docs)
    assert kept.columns == docs.columns
    texts = sorted(((r.doc_id, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in kept.collect()), key=str)
    assert texts == sorted(((d, h) for d, _, _, h in by_rule(AWKWARD)), key=str)
    assert kept.where("text is null").count() == 1


def test_empty_and_small_tables(empty_docs, edge_docs):
    assert digests(empty_docs) == []
    assert digests(edge_docs) == by_rule([(r.doc_id, r.text) for r in edge_docs.collect()])


def test_one_line_in_most_documents(spark):
    rows = [(i, f"the line that all of them share\nown line of document {i}\nline of a pair {i // 2}") for i in range(3_000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    assert digests(docs) == by_rule(rows)


def test_bitmaps_skip_words(spark):
    first = "\n".join(f"numbered line {i}" for i in range(500))
    second = "\n".join([f"other numbered line {i}" for i in range(200)] + ["numbered line 7"] + ["x"] * 300)
    docs = spark.createDataFrame([(1, first), (2, second)], "doc_id bigint, text string")
    (row,) = line_dedup.keep_bitmaps(docs).collect()
    assert (row.doc_id, row.n_dropped, [tuple(w) for w in row.words]) == (2, 1, [(3, 1 << 8)])


def test_no_python_and_no_window_exchange(plain_docs):
    plan = plan_text(line_dedup.line_digests(plain_docs))
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("size", ["0.001", "0.01"])
def test_line_dedup_sql(spark, size):
    sf_dir = f"/root/testdata/sf{size}"
    name = "op12_line_dedup"
    assert difference(QUERIES[name](spark, sf_dir), connect(sf_dir), SQL[name]) is None
