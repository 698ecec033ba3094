"""The pipeline against plain versions of its stages."""

from collections import defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from test_corpus_operators import plain_line_dedup
from test_ppm_and_joins import plain_set
from tokenizers import Tokenizer

import corpus_pipeline
from ledgertone.llm.jaccard_join import one_of_each
from ledgertone.llm.quality_rules import cleaned, line_rule, repeated_words
from ledgertone.llm.secret_scan import Novelty, base_spans, novel_spans, redact, redacted


def plain_quality(rows):
    out = []
    for i, text in rows:
        words = text.encode().split()
        lines = text.encode().split(b"\n")
        repeats = int(repeated_words([words])[0])
        lost = sum(len(w) for x in lines if line_rule(x) for w in x.split())
        left = sum(len(x.split()) for x in lines if not line_rule(x))
        if left >= 20 and 100 * repeats <= 30 * len(words) and 100 * lost <= 50 * sum(map(len, words)):
            out.append((i, b"\n".join(x for x in lines if not line_rule(x)).decode()))
    return out


def plain_near(rows):
    """Pairs that share a shingle are compared; of each group the smallest id stays."""
    sets = {i: plain_set(t) for i, t in rows}
    held = defaultdict(set)
    for i, s in sets.items():
        for g in s:
            held[g].add(i)
    links = defaultdict(set)
    for i, s in sets.items():
        for j in set().union(*(held[g] for g in s)) - {i}:
            if 100 * len(s & sets[j]) >= 80 * len(s | sets[j]):
                links[i].add(j)
    gone, seen = set(), set()
    for i in sorted(sets):
        if i in seen:
            continue
        todo = [i]
        while todo:
            x = todo.pop()
            if x not in seen:
                seen.add(x)
                gone |= {x} - {i}
                todo += links[x]
    return [(i, t) for i, t in rows if i not in gone]


def plain_secrets(rows):
    novelty, out = Novelty(), []
    for i, t in rows:
        base = base_spans(t, t.encode().lower())
        spans = base + novel_spans(t, base, novelty)
        out.append((i, redact(t, [(s, e) for s, _, e in spans])))
    return out


def test_pipeline_against_plain(spark, sf_dir, texts):
    rows = plain_quality(sorted(texts.items()))
    cut = plain_line_dedup(rows)
    rows = [(i, cut[i]) for i, _ in rows if cut[i].split()]
    rows = plain_secrets(plain_near(rows))
    assert 50 < len(rows) < len(texts)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in rows}
    got, spans = {}, defaultdict(list)
    shared = Path(spark.conf.get("spark.checkpoint.dir")) / "ledgertone"
    before = {p for p in shared.glob("*/*") if p.is_dir()}
    result = corpus_pipeline.run(spark, sf_dir)
    assert [p.name for p in shared.glob("*/*") if p.is_dir() and p not in before] == ["packing"]  # all else is removed
    for r in result.collect():
        got[r.doc_id] = r.doc_tokens
        spans[r.doc_id].append((r.start, r.length))
    assert got == want
    for i, parts in spans.items():
        parts.sort()
        assert [s for s, _ in parts] == [0, *np.cumsum([n for _, n in parts])[:-1]]
        assert sum(n for _, n in parts) == want[i]


def test_stages_return_the_columns_of_documents(spark, sf_dir, documents):
    docs = documents.limit(60).cache()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.dtypes == documents.dtypes
        assert docs.where("n_chars <> length(text)").count() == 0


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES], ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_odd_rows(stage, spark, sf_dir, odd, empty):
    result = stage(spark, odd, sf_dir)
    if stage is not corpus_pipeline.sequences:
        assert result.columns == odd.columns and result.count() <= odd.count()
    else:
        assert result.where("start = 0").count() == odd.count()
    assert stage(spark, empty, sf_dir).count() == 0


def test_what_each_stage_keeps_of_odd_rows(odd):
    assert [r.doc_id for r in cleaned(odd).collect()] == []  # too short, or one word again and again
    left = sorted((str(r.doc_id), r.text) for r in one_of_each(odd).select("doc_id", "text").collect())
    assert [i for i, _ in left] == ["1", "2", "3", "4", "5", "6", "7", "None"]
    assert redacted(odd).where("doc_id = 4").count() == 2
