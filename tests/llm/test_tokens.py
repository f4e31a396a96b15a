"""Encoding, token files and packing against plain calls and exhaustive search."""

import tempfile
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from martloom.llm import packing, token_files
from martloom.llm.tokens import CachedEncoder, public_path
from tests.llm.conftest import TEXTS

FILES = ("byte_bpe_50k.json", "word_bpe_49k.json")
ENCODERS = {f: CachedEncoder(public_path(f)) for f in FILES}
PIECES = st.sampled_from(["the", "The.", "don't", "it's,", " ", "  ", "\n", "\t", "\x1c", "\xa0", "Éte", "ß.", "42", "a1.", "...", ",", "İ", "Σας", "é", "<|endoftext|>", "<|ENDOFTEXT|>", "क़", "_x.", "²", "\r\n", "K"])


@pytest.mark.parametrize("file", FILES)
@settings(max_examples=300, deadline=None)
@given(texts=st.lists(st.one_of(st.text(max_size=40), st.lists(PIECES, max_size=12).map("".join)), max_size=4))
def test_cached_ids_equal_plain_ids(file, texts):
    e = ENCODERS[file]
    plain = [x.ids for x in e.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in e.encode(texts)] == plain


@pytest.mark.parametrize("file", FILES)
def test_marks_from_lower_casing_stay_with_the_full_stop(file):
    texts = ["İ.", "aİ, b", "क़.", "é. É, ß.", "İ ."]
    e = CachedEncoder(public_path(file))
    plain = [x.ids for x in e.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in e.encode(texts)] == plain


def ordered_texts():
    return sorted(TEXTS, key=lambda r: (r[0] is not None, r[0] or 0))


def test_token_files_round_trip(spark, edge_docs):
    folder = tempfile.mkdtemp(prefix="run-") + "/shards"
    manifest = token_files.write_token_files(edge_docs, folder, public_path(FILES[0]))
    expected, start = [], 0
    for doc_id, text, _ in ordered_texts():
        ids = np.array(ENCODERS[FILES[0]].tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        expected.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    assert sorted(map(tuple, token_files.read_digests(spark, folder).collect()), key=key) == expected
    whole = {(r["doc_id"], r["start"]): r["ids"] for r in token_files.read_ids(spark, folder).collect()}
    assert all(zlib.crc32(np.array(whole[d, s], "<u4").tobytes()) == c for d, s, _, c in expected)
    assert manifest["dtype"] == "<u2" and sum(s["n_tokens"] for s in manifest["shards"]) == start


def test_token_files_of_an_empty_table(spark, empty_docs):
    folder = tempfile.mkdtemp(prefix="run-") + "/shards"
    assert token_files.write_token_files(empty_docs, folder, public_path(FILES[0]))["shards"] == []
    assert token_files.read_digests(spark, folder).collect() == []


def fewest(sizes: tuple, capacity: int) -> int:
    """The least number of sequences, by trying everything."""

    @lru_cache(None)
    def solve(rest, rooms):
        if not rest:
            return 0
        size, rest = rest[0], rest[1:]
        best = 1 + solve(rest, tuple(sorted((*rooms, capacity - size))))
        for room in set(rooms):
            if room >= size:
                left = list(rooms)
                left.remove(room)
                best = min(best, solve(rest, tuple(sorted((*left, room - size)))))
        return best

    return solve(tuple(sorted(sizes, reverse=True)), ())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=9))
def test_reduction_keeps_the_optimum(sizes):
    fixed, left = packing.reduce_instance(Counter(sizes), 20)
    used = sum(times for _, times in fixed)
    for pattern, _ in fixed:
        assert sum(k * n for k, n in pattern) <= 20
    assert used + fewest(tuple(Counter(left).elements()), 20) == fewest(tuple(sizes), 20)


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 500), min_size=1, max_size=20))
def test_places_are_gapless_and_fit(counts):
    places, sequences = packing.plan(counts, 64)
    filled, numbers = defaultdict(list), Counter()
    for length, lo, hi, copies, base, first in places:
        assert lo == numbers[length]
        numbers[length] = hi
        for n in range(hi - lo):
            filled[base + n // copies].append((first + n % copies * length, length))
    assert numbers == Counter(counts) and len(filled) == sequences
    for spots in filled.values():
        at = 0
        for offset, length in sorted(spots):
            assert offset == at
            at += length
        assert at <= 64


def test_pieces_and_sequences(edge_docs, empty_docs):
    path = public_path(FILES[1])
    got = packing.pack_documents(edge_docs, path, capacity=512).collect()
    expected = Counter()
    for doc_id, text, _ in TEXTS:
        ids = np.array(ENCODERS[FILES[1]].tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        for k, at in enumerate(range(0, len(ids), 512)):
            part = ids[at : at + 512]
            expected[(doc_id, k, at, len(part), zlib.crc32(part.tobytes()))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == expected
    spots = defaultdict(list)
    for r in got:
        spots[r["sequence_id"]].append((r["offset"], r["length"]))
    for s in spots.values():
        assert [o for o, _ in sorted(s)] == np.cumsum([0, *(n for _, n in sorted(s))])[:-1].tolist() and sum(n for _, n in s) <= 512
    assert packing.pack_documents(empty_docs, path).collect() == []
