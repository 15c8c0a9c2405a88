import itertools
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer, models, pre_tokenizers

from hindcast.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def filled(places):
    """Lengths packed, and the pieces of each sequence, gaps and overlaps refused."""
    counts, parts = defaultdict(int), defaultdict(list)
    for length, first, beyond, sequence, each, at in places:
        for i in range(beyond - first):
            parts[sequence + i // each].append((at + i % each * length, length))
            counts[length] += 1
    for held in parts.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
    return dict(counts), {s: sum(n for _, n in held) for s, held in parts.items()}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=200))
def test_plan_places_every_piece_once(lengths):
    counts = {n: lengths.count(n) for n in set(lengths)}
    found, sizes = filled(packing.plan(counts, 64))
    assert found == counts
    assert max(sizes.values(), default=0) <= 64


def test_plan_is_near_the_least_number():
    rng = np.random.default_rng(2)
    lengths = np.clip(rng.lognormal(6, 1.1, 40_000).astype(int), 1, 4096)
    counts = dict(zip(*(x.tolist() for x in np.unique(lengths, return_counts=True)), strict=True))
    _, sizes = filled(packing.plan(counts, 4096))
    assert len(sizes) <= -(-lengths.sum() // 4096) * 1.002
    # no small pieces to fill up with: thirds, halves and rests must be matched
    _, sizes = filled(packing.plan({2000: 300, 1365: 900, 2096: 300}, 4096))
    assert len(sizes) == 600


def test_round_trip(documents):
    rng = random.Random(4)
    odd = ["Ünï", "ABC", "ÉCOLE,", "e\u0301a", "straße.", "µªÿ", "ŒIL", "漢字", "\u2167", "don't", "IT'S", "<|endoftext|>", "<|ENDOFTEXT|>", "a.b,c", "ΟΔΟΣ.", "ΟΔΟΣ,x", "12.", "…", "é", "x" * 90]
    rows = [(i, " ".join(rng.choices(["the", "Reas,", "onth.", *odd], k=rng.randrange(80)))) for i in range(60)]
    rows += [(60, None), (61, ""), (None, "a b"), (None, "a b"), (7, "again"), (99, "long word, " * 5000)]
    packed = packing.pack(documents(rows), PATH, capacity=256, with_ids=True).cache()
    tokenizer = Tokenizer.from_file(PATH)
    want = sorted(tuple(tokenizer.encode(t or "", add_special_tokens=False).ids) + (1,) for _, t in rows)
    got = packed.collect()
    assert sorted(r.start == 256 * r.piece for r in got)[0]
    whole = defaultdict(list)
    for r in got:
        assert len(r.ids) == r.length <= 256
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, dtype="<u4").tobytes())
        whole[r.doc_id].append((r.piece, tuple(r.ids)))
    alone = [(i, t) for i, t in rows if i not in (None, 7)]
    for i, t in alone:
        ids = sum((p for _, p in sorted(whole[i])), ())
        assert ids == (*tokenizer.encode(t or "", add_special_tokens=False).ids, 1)
    assert sum(r.length for r in got) == sum(map(len, want))
    at = defaultdict(int)
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at[r.sequence_id]
        at[r.sequence_id] += r.length
    assert max(at.values()) <= 256
    made = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
    assert {s: len(ids) for s, ids in made.items()} == dict(at)
    assert all(made[r.sequence_id][r.offset : r.offset + r.length] == r.ids for r in got)


def test_letters_reach_the_tokenizer_once(monkeypatch):
    given_to, method = [], packing._Tokens._of_letters

    def counted(self, parts):
        given_to.append(len(parts))
        return method(self, parts)

    monkeypatch.setattr(packing._Tokens, "_of_letters", counted)
    tokens = packing._Tokens(PATH)
    words = ["".join(w) for w in itertools.product("bdfg", "aeiouäé", "lmnr")]
    texts = [f"{w}, {w.title()} {w.upper()}... \"{w}\" {w}" for w in words]
    tokenizer = Tokenizer.from_file(PATH)
    for _ in range(2):
        flat, edges = tokens.of(pa.array(texts))
        got = [flat[a:b].tolist() for a, b in itertools.pairwise(edges.tolist())]
        assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert given_to == [len(words)]  # one call, and none for what is remembered


@pytest.mark.parametrize("remembered, in_a_call", [(0, 1), (6, 9), (1000, 1 << 18)])
def test_ids_are_those_of_the_tokenizer(monkeypatch, remembered, in_a_call):
    monkeypatch.setattr(packing, "REMEMBERED", remembered)
    monkeypatch.setattr(packing, "IN_A_CALL", in_a_call)
    rng, tokens, tokenizer = random.Random(6), packing._Tokens(PATH), Tokenizer.from_file(PATH)
    characters = [*"abzABZ ßÀÖ×÷öøÿªµº\u00ad\u00b7ŒŁ漢ж\u0301\u0345\u200b\u00a0\x1c\x85\n\t\x00'.,<|>_-1²½"]
    parts = [*characters, "the", "'s", "n't", "<|endoftext|>", "<|ENDOFTEXT|>", "İ", "</w>", "x" * 70]
    for many in (0, 1, 40, 40, 40):
        texts = ["".join(rng.choices(parts, k=rng.randrange(30))) for _ in range(many)] + [None, "", " "]
        flat, edges = tokens.of(pa.array(texts, pa.string()))
        got = [flat[a:b].tolist() for a, b in itertools.pairwise(edges.tolist())]
        assert got == [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert len(tokens.parts) == len(tokens.sizes) == len(tokens.used) <= max(remembered, 0)
        assert len(tokens.ids) == tokens.sizes.sum()
    # a model that does not mark the ends of words
    tokens = packing._Tokens(PATH)
    tokens.last[:] = False
    flat, _ = tokens.of(pa.array(["some words, École"]))
    assert flat.tolist() == tokenizer.encode("some words, École", add_special_tokens=False).ids


def test_other_tokenizers_get_whole_texts(tmp_path):
    other = Tokenizer(models.WordLevel({"?": 0, "a": 1, "b": 2}, unk_token="?"))
    other.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    other.save(path := str(tmp_path / "other.json"))
    flat, edges = packing._Tokens(path).of(pa.array(["a b", None, "c a"]))
    assert flat.tolist() == [1, 2, 0, 1] and edges.tolist() == [0, 2, 2, 4]


def test_empty_table_and_extra_columns(documents):
    assert packing.pack(documents([]), PATH).collect() == []
    docs = documents([(1, "a"), (2, "b")]).selectExpr("*", "9 AS length", "8 AS part", "7 AS piece")
    assert [r.length for r in packing.pack(docs, PATH).collect()] == [2, 2]


@pytest.mark.parametrize("many", [1, 5000])
def test_equal_lengths(documents, many):
    docs = documents([(i, "a") for i in range(many)])
    found = packing.pack(docs, PATH, capacity=64).collect()
    assert len({(r.sequence_id, r.offset) for r in found}) == many
    assert len({r.sequence_id for r in found}) == -(-many // 32)
