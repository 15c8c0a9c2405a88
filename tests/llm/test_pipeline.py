"""The pipeline against its stages done plainly, on the driver's smallest tables."""

from collections import Counter

import pytest
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from hindcast.llm import quality
from hindcast.llm.common import table
from tests.llm import test_mixing, test_simhash, test_substring
from tests.llm.brute import words

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plain(spark):
    """Documents after each stage but the last, as (doc_id, text, source)."""
    docs = table(spark, SF, "documents")
    model = quality.fit(docs, table(spark, SF, "labels"))
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    scores = model.scores([r[1].encode() for r in rows])
    rows = [r for r, s in zip(rows, scores, strict=True) if s >= 0.3]
    after = [rows]
    firsts = {i for i, _, c in test_simhash.brute([r[:2] for r in rows]) if i == c}
    after.append([r for r in rows if r[0] in firsts])
    rows, seen = [], set()
    for i, text, source in sorted(after[-1]):
        w = words(text)
        gone = set()
        for p in range(len(w) - 19):
            part = tuple(w[p : p + 20])
            if part in seen:
                gone.update(range(p, p + 20))
            seen.add(part)
        left = [x for p, x in enumerate(w) if p not in gone]
        if left or not gone:
            rows.append((i, " ".join(left) if gone else text, source))
    after.append(rows)
    taken = test_mixing.brute(rows)[1]
    text = {i: (t, s) for i, t, s in rows}
    after.append([
        (i, text[i][0] if len(w) == len(words(text[i][0])) else " ".join(w), text[i][1])
        for i, _, w in taken
    ])
    return after


def test_stages_by_hand(spark, plain):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    for (name, stage), want in zip(corpus_pipeline.STAGES[:-1], plain, strict=True):
        docs = corpus_pipeline.kept(stage(spark, docs, SF), "test")
        assert docs.columns == columns, name
        got = Counter((r.doc_id, r.text, r.source) for r in docs.collect())
        assert got == Counter(want), name
        assert want, name


def test_run(spark, plain):
    found = corpus_pipeline.run(spark, SF).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = sum(len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for _, t, _ in plain[-1])
    assert sum(r.length for r in found) == want
    assert len({r.sequence_id for r in found}) <= -(-want // 4096) + 2
    ends = Counter()
    for r in sorted(found, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends[r.sequence_id]
        ends[r.sequence_id] += r.length
    assert max(ends.values()) <= 4096


def test_stages_on_empty_documents(spark):
    docs = table(spark, SF, "documents").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.collect() == []
        docs = table(spark, SF, "documents").where("false")
