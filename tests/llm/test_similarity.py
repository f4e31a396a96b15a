"""Fingerprints, near-duplicate texts and vectors against exhaustive comparison."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from martloom.llm import cap_filters, fingerprints, near_duplicates
from martloom.llm.support import Workspace
from tests.llm.conftest import TEXTS

LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# --- fingerprints -------------------------------------------------------------------------------


def weighted_jaccard(a, b):
    a, b = ({w: n * len(w) for w, n in Counter(words(t)).items()} for t in (a, b))
    most = sum(max(a.get(w, 0), b.get(w, 0)) for w in a.keys() | b.keys())
    return sum(min(a.get(w, 0), b.get(w, 0)) for w in a.keys() | b.keys()) / most if most else 1.0


def test_fingerprints_of_a_corpus(plain_docs):
    texts = sorted((r["doc_id"], r["text"] or "") for r in plain_docs.collect())
    got = {r["doc_id"]: r for r in fingerprints.compare_with_edits(plain_docs).collect()}
    errors = []
    for k, (doc_id, text) in enumerate(texts):
        after, cut = texts[(k + 1) % len(texts)][1], len(text) // 4
        edited, r = text[: len(text) - cut] + after[:cut], got[doc_id]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        errors += [r["near_edited"] - weighted_jaccard(text, edited), r["near_next"] - weighted_jaccard(text, after)]
    assert abs(np.mean(errors)) < 0.02 and np.sqrt(np.mean(np.square(errors))) < 0.09
    prints = defaultdict(set)
    for doc_id, text in texts:
        prints[text].add(got[doc_id]["fingerprint"])
    assert all(len(p) == 1 for p in prints.values())


def test_fingerprint_edges(edge_docs, empty_docs):
    got = fingerprints.compare_with_edits(edge_docs).collect()
    assert len(got) == len(TEXTS)
    seven = [r for r in got if r["doc_id"] in (7, 11)]
    assert len({r["fingerprint"] for r in seven}) == 1
    blank = {r["fingerprint"] for r in got if r["doc_id"] in (1, 2, 3)}
    assert blank == {"0" * 8 * fingerprints.COORDINATES}
    assert fingerprints.compare_with_edits(empty_docs).collect() == []
    one = fingerprints.compare_with_edits(edge_docs.where("doc_id = 9")).first()
    assert one["near_next"] == 1.0 and one["n_chars"] == 3


# --- near-duplicate texts -----------------------------------------------------------------------


def exact_components(texts, width, percent=80):
    """Smallest linked id per row, from all pairs of distinct sets."""
    sets, members = {}, defaultdict(list)
    for doc_id, text in texts:
        w = words((text or "").translate(LOWER))
        s = frozenset(zip(*[w[k:] for k in range(width)])) if len(w) >= width else frozenset([tuple(w)] if w else [])
        members[s].append(doc_id)
        sets[s] = s
    empty = [d for d in members.pop(frozenset(), [])]
    parent = {s: s for s in members}

    def find(s):
        while parent[s] != s:
            s = parent[s]
        return s

    kinds = list(members)
    for i, a in enumerate(kinds):
        for b in kinds[:i]:
            if min(len(a), len(b)) * 100 >= percent * max(len(a), len(b)):
                common = len(a & b)
                if 100 * common >= percent * (len(a) + len(b) - common):
                    parent[find(a)] = find(b)
    groups = defaultdict(list)
    for s in kinds:
        groups[find(s)] += [(d, len(s)) for d in members[s]]
    out = Counter((d, 0, d) for d in empty)
    for g in groups.values():
        least = min((d for d, _ in g if d is not None), default=None)
        out.update((d, n, least) for d, n in g)
    return out


def found(docs, width):
    got = near_duplicates.near_duplicates(docs, width).collect()
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    return Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got)


def test_components_of_a_corpus(plain_docs, edge_docs, empty_docs):
    texts = [(r["doc_id"], r["text"]) for r in plain_docs.collect()]
    for width in (2, 5):
        assert found(plain_docs, width) == exact_components(texts, width)
    assert found(edge_docs, 5) == exact_components([(d, t) for d, t, _ in TEXTS], 5)
    assert found(empty_docs, 5) == Counter()


def test_large_groups_by_hubs(spark):
    """Groups far longer than a short list, chains between them, and texts that share only a passage."""
    draw = np.random.default_rng(3)
    vocabulary = [f"w{k}" for k in range(5000)]
    text = lambda n: list(draw.choice(vocabulary, n))
    rows = []
    for base in (text(120), text(150)):
        for _ in range(60):
            copy = list(base)
            for at in draw.integers(0, len(copy), int(draw.integers(0, 7))):
                copy[at] = str(draw.choice(vocabulary))
            rows.append(" ".join(copy))
    passage = text(90)
    rows += [" ".join(passage + text(15 + 5 * k)) for k in range(40)]
    drift = text(100)
    for _ in range(40):
        drift[int(draw.integers(0, 100))] = str(draw.choice(vocabulary))
        rows.append(" ".join(drift))
    texts = [(k, t) for k, t in enumerate(rows)] + [(1000, rows[0])] * 3
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(3)
    for width in (2, 5):
        assert found(docs, width) == exact_components(texts, width)


@pytest.mark.parametrize("short", [2, 16])
def test_group_of_which_half_is_linked_with_nothing(spark, monkeypatch, short):
    """Copies of two related texts with few to many edits: hubs, their differences and several rounds of hubs."""
    monkeypatch.setattr(near_duplicates, "SHORT_LIST", short)
    draw = np.random.default_rng(8)
    vocabulary = [f"w{k}" for k in range(3000)]
    base = list(draw.choice(vocabulary, 110))
    related = list(base)
    for at in draw.integers(0, 110, 14):
        related[at] = str(draw.choice(vocabulary))
    rows = []
    for k in range(260):
        copy = list(base if k % 3 else related)
        for at in draw.integers(0, 110, int(draw.integers(0, 30))):
            copy[at] = str(draw.choice(vocabulary if k % 5 else vocabulary[:20]))
        rows.append(" ".join(copy[: 110 - int(draw.integers(0, 9))]))
    unlike = [" ".join(base[:8] + list(draw.choice(vocabulary[:60], int(draw.integers(5, 30))))) for _ in range(80)]
    texts = list(enumerate(rows + unlike))
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(5)
    for width in (2, 5):
        assert found(docs, width) == exact_components(texts, width)


def test_few_pairs_of_a_family_far_from_its_hub_are_confirmed(spark):
    """Members of one hub that share nearly as many differences as a link needs: none of their pairs is compared."""
    shared, size = 90, 40
    rows = [(1, k, False, 27, 12780, 7960, list(range(shared)) + [1000 * (k + 1) + j for j in range(52)]) for k in range(size)]
    different = spark.createDataFrame(rows, near_duplicates.DIFFERENT_ROW)
    roots = spark.createDataFrame([], "node bigint, root bigint")
    search = near_duplicates._Search(Workspace(spark, "test"), None, None, 2, 80, near_duplicates.MATCHES)
    posted = search.posted(different, roots)
    # a pair needs (2 * 12780 - 7960) / 180, so 98 common differences
    assert search.near_leaders(posted).count() == 0 and search.near_hubs(posted, roots).count() == 0
    more = spark.createDataFrame([(*r[:6], list(range(98)) + [1000 * (r[1] + 1) + j for j in range(44)]) for r in rows], near_duplicates.DIFFERENT_ROW)
    posted = search.posted(more, roots)
    assert search.near_leaders(posted).count() == size - 1
    assert search.near_hubs(posted, spark.createDataFrame([(k, 0) for k in range(size)], "node bigint, root bigint")).count() == 0
    # each pair meets in the first list only, not in all that the members share
    lists = posted.groupBy("node").count().agg(F.max("count")).first()[0]
    assert lists <= 98 - 12780 // 180


def test_one_of_each_keeps_rows(edge_docs, empty_docs):
    kept = near_duplicates.one_of_each(edge_docs)
    assert kept.columns == edge_docs.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter([7, 3, None, 1, 2, 4, 9, 12, -5])
    assert near_duplicates.one_of_each(empty_docs).collect() == []


def test_one_of_each_where_ids_repeat(spark):
    base = " ".join(f"w{k}" for k in range(60))
    rows = [(7, base), (7, base + " tail"), (5, "another text of some words"), (5, base + " end"), (9, base), (None, base), (3, ""), (3, "")]
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id bigint, text string, hash string")
    kept = [(r["doc_id"], r["text"]) for r in near_duplicates.one_of_each(docs).collect()]
    assert len(kept) == 3 and (5, "another text of some words") in kept and (3, "") in kept
    assert [d for d, t in kept if t.startswith("w0")] == [5]


# --- vectors ------------------------------------------------------------------------------------


def test_cap_filters_find_near_vectors(spark):
    draw = np.random.default_rng(5)
    centers = draw.standard_normal((300, 64))
    vectors = [c + s * draw.standard_normal(64) for c in centers for s in (0, 0.05, 0.12, 0.15, 0.2)]
    vectors += [vectors[0] * 3, vectors[0], vectors[0]]
    odd = [None, [0.0] * 64, [float("nan")] * 64, [float("inf")] + [1.0] * 63, [None] * 64, [], [1.0, 2.0], [2.0, 4.0], [1e-300] * 64]
    rows = [(k, [float(x) for x in v], 1) for k, v in enumerate(vectors)] + [(5000 + k, v, None) for k, v in enumerate(odd)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, node int").repartition(4)
    got = {r["vec_id"]: r for r in cap_filters.near_duplicates(table).collect()}
    unit = np.array(vectors) / np.linalg.norm(vectors, axis=1, keepdims=True)
    close = (unit @ unit.T >= 0.95).sum(1) - 1
    mine = np.array([got[k]["n_links"] for k in range(len(vectors))])
    assert (mine <= close).all() and mine.sum() >= 0.97 * close.sum()
    assert [got[5000 + k]["n_links"] for k in range(9)] == [0, 0, 0, 0, 0, 0, 1, 1, 0]
    assert got[5007]["component_id"] == 5006 and all(got[5000 + k]["kept"] for k in range(6))
    assert len(got) == len(rows)
    assert cap_filters.near_duplicates(table.limit(0)).collect() == []


def test_cap_filter_recall(spark):
    """Near vectors planted in the given table, at cosines from 0.95 to 0.96; the table itself has none."""
    draw = np.random.default_rng(9)
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").orderBy("vec_id").select("vec_id", "embedding").collect()
    x = np.array([r["embedding"] for r in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    chosen = x[draw.choice(len(x), 300, replace=False)]
    away = draw.standard_normal(chosen.shape)
    away -= (away * chosen).sum(1, keepdims=True) * chosen
    cosine = draw.uniform(0.951, 0.96, (300, 1))
    near = cosine * chosen + np.sqrt(1 - cosine**2) * away / np.linalg.norm(away, axis=1, keepdims=True)
    table = spark.createDataFrame(
        [(k, [float(c) for c in v]) for k, v in enumerate(np.concatenate([x, near]))], "vec_id bigint, embedding array<double>"
    )
    y = np.concatenate([x, near])
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    exact = sum(int((y[k : k + 1000] @ y.T >= 0.95).sum()) for k in range(0, len(y), 1000)) - len(y)
    got = cap_filters.near_duplicates(table).agg(F.sum("n_links")).first()[0]
    assert exact >= 600 and 0.97 * exact <= got <= exact


@pytest.mark.parametrize("size", [2, 3, 8, 32, 64])
@pytest.mark.parametrize("count", [10**5, 10**6])
def test_cap_filter_recall_on_large_tables(size, count):
    # whether a pair meets depends on the pair and on the codes for the number of vectors, not on the others
    draw = np.random.default_rng(size)
    x, w = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in draw.standard_normal((2, 200, size)))
    w -= (w * x).sum(1, keepdims=True) * x
    y = 0.955 * x + math.sqrt(1 - 0.955**2) * w / np.linalg.norm(w, axis=1, keepdims=True)
    shared = np.zeros(200)
    for code in cap_filters.product_codes(size, count):
        found = [{f for rows, chosen in code.decode(v) for f in zip(rows.tolist(), chosen.tolist())} for v in (x, y)]
        for row, _ in found[0] & found[1]:
            shared[row] += 1
    assert (shared > 0).mean() >= 0.99
    assert shared.mean() > 0.75 * cap_filters.CODES * cap_filters.SHARED_EACH
