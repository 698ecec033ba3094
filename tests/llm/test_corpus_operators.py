"""Line dedup, exact dedup, language identification and packing against plain versions."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgertone.llm.digest_tree import exact_dedup, merge_runs
from ledgertone.llm.hash_filter import hash_filter, may_hold
from ledgertone.llm.language_id import fit_on, predict
from ledgertone.llm.line_dedup import chunk_ends, line_dedup, line_hash
from ledgertone.llm.packing import Packer, WordIds, pack
from ledgertone.llm.queries import QUERIES

WORDS = public_tokenizers.path("word_bpe_49k.json")


def test_rolling_hash_equals_its_definition():
    draw = random.Random(1)
    lines = [str(draw.random()).encode() for _ in range(200)]
    for window in (1, 2, 4):
        hashes = [line_hash(x) for x in lines]
        plain = [
            i + 1 for i in range(200)
            if sum(31**j * hashes[i - j] for j in range(window) if i >= j) % 2**32 % 3 == 0 or i == 199
        ]
        assert chunk_ends(lines, window, 3) == plain


def test_boundaries_resist_shifts():
    lines = [f"line {i}".encode() for i in range(300)]
    far = [e + 1 for e in chunk_ends(lines) if e > 3]
    assert [e for e in chunk_ends([b"new first line", *lines]) if e > 4] == far


def plain_line_dedup(rows, window=2, spacing=3):
    """rows: (doc_id, text); ids are unique."""
    seen, out = set(), {}
    for doc, text in sorted(rows):
        if not text:
            out[doc] = text
            continue
        lines = text.encode().split(b"\n")
        words = [len(x.split()) for x in lines]
        ends = chunk_ends(lines, window, spacing)
        passages = [("chunk", range(a, b)) for a, b in zip([0, *ends], ends) if sum(n > 0 for n in words[a:b]) >= 2]
        full = [i for i, n in enumerate(words) if n]
        passages += [("two", pair) for pair in zip(full, full[1:]) if sum(words[i] for i in pair) >= 10]
        passages += [("line", [i]) for i in full if words[i] >= 50]
        gone = set()
        for kind, places in passages:
            body = (kind, *(lines[i] for i in places))
            if body in seen:
                gone.update(places)
            seen.add(body)
        out[doc] = b"\n".join(x for i, x in enumerate(lines) if i not in gone).decode()
    return out


def test_line_dedup_against_plain(frame):
    draw = random.Random(5)
    passage = [f"shared line {i} of the passage" for i in range(12)]
    rows = []
    for i in range(60):
        own = [f"own {i} {j} {draw.random()}" for j in range(draw.randint(0, 9))]
        at = draw.randint(0, len(own))
        rows.append((i, "\n".join(own[:at] + (passage if i % 3 else []) + own[at:])))
    want = plain_line_dedup(rows)
    got = {r.doc_id: r for r in line_dedup(frame(rows)).collect()}
    assert {i: r.text for i, r in got.items()} == want
    assert got[1].row == "x" and got[1].removed == 3
    assert sum(len(t) for t in want.values()) < 0.6 * sum(len(t) for _, t in rows)


def test_line_dedup_removes_planted_passages(frame):
    """Passages of one long line and of 2 to 6 lines, each in two documents with other neighbours, go from the second;
    so do exact copies. What is a document's own stays, blank lines between paragraphs do not hide a passage."""
    draw = random.Random(11)

    def line(n):
        return " ".join(f"w{draw.randrange(10**9)}" for _ in range(n))

    rows, own, passages = [], {}, {}
    for i in range(120):
        n = i % 6 + 1
        passages[i] = [line(60 if n == 1 else 12) for _ in range(n)]
        for doc in (i, 1000 + i):
            own[doc] = [line(9) for _ in range(draw.randint(2, 8))]
            at = draw.randint(0, len(own[doc]))
            rows.append((doc, ("\n\n" if i % 2 else "\n").join(own[doc][:at] + passages[i] + own[doc][at:])))
        rows.append((2000 + i, rows[-1][1]))
    got = {r.doc_id: r.text for r in line_dedup(frame(rows)).collect()}
    for i in range(120):
        assert got[i] == dict(rows)[i]
        assert got[1000 + i].split() == " ".join(own[1000 + i]).split()
        assert not got[2000 + i].split()


def test_line_dedup_odd_rows(odd, empty):
    got = defaultdict(list)
    for r in line_dedup(odd).collect():
        got[r.doc_id].append(r.text)
    assert got[1] == [None] and got[2] == [""] and got[4] == ["same\ntext here"] * 2
    assert got[8] in ([""], ["same\ntext here"])  # by whether the two lines are one chunk
    assert line_dedup(empty).columns == empty.columns and line_dedup(empty).count() == 0


def test_hash_filter_loses_no_hash(spark):
    hashes = np.random.default_rng(3).integers(-(2**63), 2**63 - 1, 6000)
    held = spark.createDataFrame([(int(h),) for h in hashes[:3000]], "h long")
    filled = hash_filter(held, "h")
    assert may_hold(filled, hashes[:3000]).all() and may_hold(filled, hashes[3000:]).mean() < 0.05
    full = hash_filter(held, "h", most_bytes=0)  # too small: passes more, still loses none
    assert may_hold(full, hashes[:3000]).all()
    assert not may_hold(hash_filter(held.limit(0), "h"), hashes).any()


def test_merge_keeps_the_winner_and_counts():
    def run(ids, texts):
        return pa.table({
            "sha": [hashlib.sha256(t).digest() for t in texts], "check": texts, "n_bytes": [len(t) for t in texts],
            "keep_id": pa.array(ids, pa.int64()), "keep_row": list(range(len(ids))), "members": [1] * len(ids),
        })

    merged = merge_runs(run([3, None, 9, 5], [b"a", b"a", b"b", b"a"]), largest=True).to_pylist()
    assert {(r["check"], r["keep_id"], r["members"]) for r in merged} == {(b"a", 5, 3), (b"b", 9, 1)}
    same = run([1, 2], [b"a", b"a"]).set_column(1, "check", pa.array([b"x", b"y"]))
    assert merge_runs(same).num_rows == 2  # equal SHA-256 alone does not merge


def test_exact_dedup_both_ways(frame):
    draw = random.Random(2)
    rows = [(i, draw.choice(["A", "a", "É", "é", "b", None, ""]) if i % 3 else "HOT") for i in range(400)]
    for keep, pick in (("smallest", min), ("largest", max)):
        groups = defaultdict(list)
        for i, t in rows:
            groups[(t or "").encode().lower()].append(i)
        result = exact_dedup(frame(rows).repartition(23), keep=keep, fan_in=2).collect()
        assert len(result) == len(rows)
        for r in result:
            mine = groups[(dict(rows)[r.doc_id] or "").encode().lower()]
            assert (r.keep_id, r.group_size, r.kept) == (pick(mine), len(mine), r.doc_id == pick(mine))


def test_exact_dedup_odd_rows(odd, empty):
    rows = exact_dedup(odd, keep="largest").collect()
    assert Counter(r.kept for r in rows if r.text_sha256 == hashlib.sha256(b"").hexdigest()) == {True: 1, False: 1}
    same = [r for r in rows if r.group_size == 3]
    assert len(same) == 3 and [r.doc_id for r in same if r.kept] == [8]
    twins = exact_dedup(odd.where("doc_id = 4")).collect()
    assert [r.kept for r in twins].count(True) == 1
    assert exact_dedup(empty).count() == 0


def test_language_held_out_accuracy(spark, documents, sf_dir):
    lang = {r.doc_id: r.lang for r in documents.select("doc_id", "lang").collect()}
    rows = [r for r in QUERIES["op7_language_id"](spark, sf_dir).collect() if r.held_out]
    assert rows and all(0 <= r.score <= 1 for r in rows)
    assert sum(r.lang_pred == lang[r.doc_id] for r in rows) >= 0.97 * len(rows)


def test_kernel_scores_equal_the_plain_kernel(documents):
    """The matrix of n-gram weights gives what the kernels with all landmarks would."""
    from ledgertone.llm import language_id as li

    rows = [(r.lang, li.present(li.prepared(r.text))) for r in documents.limit(60).collect()]
    model = li.fit(rows, landmarks=8, most_grams=10**6, ridge=1.0)
    marks, seen = [], Counter()
    for lang, grams in rows:
        if seen[lang] < 8:
            marks.append((lang, grams))
            seen[lang] += 1
    known = set(model.grams.tolist())
    weight = {g: li.WEIGHTS[(g >> 24) - 1] for g in known}

    def kernel(a, b):
        a, b = set(a.tolist()) & known, set(b.tolist()) & known
        return sum(weight[g] for g in a & b) / np.sqrt(sum(weight[g] for g in a) * sum(weight[g] for g in b))

    k_nm = np.array([[kernel(x, y) for _, y in marks] for _, x in rows])
    k_mm = np.array([[kernel(x, y) for _, y in marks] for _, x in marks])
    values, vectors = np.linalg.eigh(k_mm)
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    phi = k_nm @ root
    target = np.where(np.array([lang for lang, _ in rows])[:, None] == np.array(model.languages), 1.0, -1.0)
    want = phi @ np.linalg.solve(phi.T @ phi + np.eye(phi.shape[1]), phi.T @ target)
    texts = [li.prepared(r.text) for r in documents.limit(60).collect()]
    assert np.allclose(model.scores(texts, model.tables()), want, atol=2e-3)


def test_language_odd_rows(frame, odd, empty, documents):
    model = fit_on(documents, F.lit(True))
    got = {r.doc_id: r for r in predict(odd, model).collect()}
    assert got[1].lang_pred == got[2].lang_pred == got[3].lang_pred == "und" and got[1].score == 0.0
    assert got[4].lang_pred in model.languages
    assert fit_on(empty, F.lit(True)) is None
    assert {r.lang_pred for r in predict(odd, None).collect()} == {"und"}
    assert predict(empty, model).count() == 0


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(WORDS)


def test_word_ids_equal_the_tokenizer(tokenizer, texts):
    draw = random.Random(4)
    alphabet = list("abKZ.,'!12 \n\t") + ["é", "É", "́", "̱", "İ", "Σ", "ς", " ", " ", "\x1c", "😀",
                                          "'s", "<|endoftext|>", "<|startoftext|>", "中", "゙", "が", "H̱"]
    made = ["".join(draw.choices(alphabet, k=draw.randint(0, 60))) for _ in range(2_000)]
    made += list(texts.values())
    table = WordIds(WORDS, most=3_000)
    for at in range(0, len(made), 50):
        for text, ids in zip(made[at:at + 50], table.encode(made[at:at + 50])):
            want = tokenizer.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(ids, "<u4").tolist() == want, repr(text)


def test_special_tokens_in_capitals_are_ordinary_words(tokenizer):
    draw = random.Random(8)
    parts = ["<|ENDOFTEXT|>", "<|EndOfText|>", "<|endoftext|>", "<|STARTOFTEXT|>", "<|startoftext|>", "<|", "Word", "a.", ",",
             " ", "\n", "É", "́"]
    made = ["<|ENDOFTEXT|>", "a <|STARTOFTEXT|>. B", *("".join(draw.choices(parts, k=12)) for _ in range(500))]
    for text, ids in zip(made, WordIds(WORDS).encode(made), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_words_in_use_stay_in_a_full_table():
    table, learnt = WordIds(WORDS, most=200), defaultdict(int)
    learn = table._learn

    def counted(words):
        for word in words:
            learnt[word] += 1
        learn(words)

    table._learn = counted
    letters = "abcdefghijklmnopqrstuvwxyz"
    for a in letters:
        table.encode([" ".join(["always", *(f"q{a}{b}" for b in letters)])])
        assert len(table._known) + len(table._before) <= 200 + 2 * 27
    assert learnt[b"always"] == 1 and len(learnt) == 1 + 26 * 26


def test_marks_after_words_need_no_whole_tokenizer(tokenizer):
    table = WordIds(WORDS)
    table._encode = lambda text: 1 / 0
    made = ["word### \u00fcber$$$ wort... | && x_, y; (", "", None, " \n ", "word###"]
    for text, ids in zip(made, table.encode(made), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids, repr(text)


def test_word_ids_of_marks_in_any_order(tokenizer):
    draw = random.Random(9)
    parts = ["word", "\u00fcber", "\u00c9", "'s", "'", "###", "<|", "|>", "startoftext", ".", "...", " ", "\t", "\x0b", "\x1c", "\u2003",
             "1", "\u0301", "\u2014", "_", "\\", "\x7f", "\x00", "\u0130"]
    made = ["".join(draw.choices(parts, k=draw.randint(1, 10))) for _ in range(3000)]
    for text, ids in zip(made, WordIds(WORDS).encode(made), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def check_packing(rows, texts, tokenizer, size, most_padding):
    ids = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for i, t in texts.items()}
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
        assert np.frombuffer(r.ids, "<u4").tolist() == ids[r.doc_id][r.start:r.start + r.length]
        assert r.doc_tokens == len(ids[r.doc_id]) and r.length > 0
    assert set(docs) == set(texts)
    for doc, parts in docs.items():
        at = 0
        for r in sorted(parts, key=lambda r: r.start):
            assert r.start == at
            at += r.length
        assert at == len(ids[doc])
    padding = 0
    for parts in sequences.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size
        padding += 0 if at & (at - 1) == 0 else size - at
    total = sum(map(len, ids.values()))
    assert padding <= most_padding * total


@pytest.mark.parametrize("size", [256, 2048])
def test_packing_holds_each_id_once(documents, texts, tokenizer, size):
    rows = pack(documents.repartition(5), WORDS, 1, size=size, least_cut=size // 32).collect()
    check_packing(rows, texts, tokenizer, size, 0.03)


def test_packing_odd_rows(odd, empty):
    rows = pack(odd, WORDS, 1).collect()
    assert sum(r.length for r in rows if r.doc_id == 1) == 1
    assert sum(r.start == 0 for r in rows if r.doc_id == 4) == 2
    assert pack(empty, WORDS, 1).collect() == []


def test_packer_emits_the_fullest():
    packer = Packer(0, size=10, windows=2, least_cut=10)
    for doc, n in (("a", 6), ("b", 7), ("c", 5)):
        packer.add(doc, b"\0\0\0\0" * n, n)
    assert [p[0] for p in packer.taken()] == ["b"]
    packer.add("d", b"\0\0\0\0" * 4, 4)
    assert [p[0] for p in packer.taken()] == ["a", "d"]


def test_packing_reads_small_slices(monkeypatch):
    """The words of a slice lie in memory one by one, so no slice holds more than a megabyte of texts, but for one text."""
    from ledgertone.llm import packing

    seen = {}
    monkeypatch.setattr(packing, "map_slices", lambda *_, **options: seen.update(options) or 1 / 0)
    monkeypatch.setattr(packing, "scratch_path", lambda *_: "")
    monkeypatch.setattr(packing, "id_and_text", lambda *_: None)
    monkeypatch.setattr(packing, "id_type", lambda *_: "bigint")
    with pytest.raises(ZeroDivisionError):
        pack(type("Docs", (), {"sparkSession": None})(), WORDS, 1)
    assert seen["limit"] <= 1 << 20
