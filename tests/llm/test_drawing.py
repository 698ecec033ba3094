"""Personal data, importance resampling and fill-in-the-middle against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgertone.llm import fill_middle
from ledgertone.llm.fill_middle import LAYOUT, arranged, digests, draws, fill_in_middle, fill_in_stored, framed
from ledgertone.llm.fill_middle import output_texts, rebuilt, store
from ledgertone.llm.importance import bucket_counts, drawn, gains, hashed_ngrams, importance_ranks, noise, resampled
from ledgertone.llm.importance import weighted
from ledgertone.llm.pii_scan import KINDS, Rewritten, mask, masked, pii_scan, plain_spans, spans
from ledgertone.llm.queries import QUERIES

# --- personal data ------------------------------------------------------------------------------------------------


def luhn_by_table(digits):
    doubled = [0, 2, 4, 6, 8, 1, 3, 5, 7, 9]
    return sum(doubled[int(d)] if i % 2 else int(d) for i, d in enumerate(reversed(digits))) % 10 == 0


def plain_base(text):
    """The patterns as the contract writes them, dropping matches that fail."""
    found = [(0, m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append((1, m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and luhn_by_table(digits):
            found.append((2, m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append((3, m.start(), m.end()))
    return sorted(found)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(
    ["a", "Bob", "@", ".", "..", "-", "_", "%", "+", "1", "12", "255", "256", "007", "4111", "1111", "4111111111111111",
     " ", "(", ")", "é", "４", "\n", "x.com", "+49 "]), max_size=30))
def test_plain_spans_against_the_patterns(parts):
    text = "".join(parts)
    assert sorted(plain_spans(text)) == plain_base(text)


CYRILLIC_A, WIDE_PLUS, ZERO_WIDTH, NO_BREAK = "а", "＋", "​", " "

DISGUISED = [
    ("email", "john dot smith at example dot com"), ("email", "jane [at] corp [dot] org"), ("email", "jane(at)corp.org"),
    ("email", "name_at_mail_dot_com"), ("email", "bob @ mail.example.com"), ("email", "a&#64;b.com"),
    ("email", f"j{CYRILLIC_A}ne@corp.com"), ("email", "Maria arroba correo punto es"), ("email", "max{at}firma{punkt}de"),
    ("email", "kim＠mail.example.org"), ("ip", "192[.]168[.]1[.]10"), ("ip", "10 dot 0 dot 0 dot 1"),
    ("ip", "one nine two dot one six eight dot one dot one"), ("card", "4111 1111 1111 11l1"),
    ("card", NO_BREAK.join(["4111", "1111", "1111", "1111"])), ("card", ZERO_WIDTH.join(["4111", "1111", "11111111"])),
    ("card", "four one one one, one one one one, one one one one, one one one one"),
    ("phone", f"{WIDE_PLUS}49 1512 3456789"), ("phone", "plus four nine one five one two three four five six seven"),
    ("phone", "plus 44 double two three three four four five five"), ("phone", "+49 151 ٣٤٥٦٧٨"),
]


@pytest.mark.parametrize("kind,disguise", DISGUISED)
def test_disguises_are_found_in_their_place(kind, disguise):
    for before, after in (("", ""), ("Write to ", ", please."), ("é​ 😀 (", ") one two")):
        text = f"{before}{disguise}{after}"
        assert [(KINDS[k], text[s:e]) for k, s, e, hidden in spans(text) if hidden] == [(kind, disguise)]


@pytest.mark.parametrize("text", [
    "look at google.com and meet at noon", "we point at it dot. see you at example. com", "un point important at home",
    "one two three four are numbers, and so is five", "null null null null null null null null null null null null null "
    "null null null", "the answer (at last) is dot product", "version 1.2.3 of 10.5", "Привет, как дела? Всё хорошо 12345",
    "zero one zero one zero one zero one", "at least one of us, at most two dot three",
])
def test_ordinary_text_is_left_alone(text):
    assert spans(text) == [] and mask(text, spans(text)) == text


def test_plain_and_disguised_together():
    text = "bob@mail.example.com or bob at mail dot example dot com, 10.0.0.1 or 10[.]0[.]0[.]2"
    assert [(KINDS[k], text[s:e], h) for k, s, e, h in spans(text)] == [
        ("email", "bob@mail.example.com", False), ("email", "bob at mail dot example dot com", True),
        ("ip", "10.0.0.1", False), ("ip", "10[.]0[.]0[.]2", True),
    ]
    assert mask(text, spans(text)) == "[email] or [email], [ip] or [ip]"


@settings(max_examples=200, deadline=None)
@given(st.text("ab", max_size=30), st.lists(st.tuples(st.integers(0, 4), st.integers(0, 3), st.text("xyz", max_size=3)), max_size=6))
def test_rewritten_places_against_a_list(text, steps):
    edits, at = [], 0
    for skip, size, new in steps:
        start = at + skip
        if start + size > len(text) or (size == 0 and not new):
            break
        edits.append((start, start + size, new))
        at = start + max(size, 1)
    want, at = [], 0
    for start, end, new in edits:
        want += [(c, (i, i + 1)) for i, c in enumerate(text[at:start], at)] + [(c, (start, end)) for c in new]
        at = end
    want += [(c, (i, i + 1)) for i, c in enumerate(text[at:], at)]
    made = Rewritten(text, edits)
    assert made.text == "".join(c for c, _ in want)
    assert [made.source(i) for i in range(len(want))] == [place for _, place in want]


@pytest.mark.parametrize("unit", [
    "a", "1", "1.", "@", " at ", "one ", "+1 ", "a dot ", "a.b@", CYRILLIC_A, "[at]", "a[dot]", "\n", "five 5 ", "x at a dot ",
])
def test_long_runs_take_time_in_proportion(unit):
    from time import perf_counter

    def seconds(size):
        started = perf_counter()
        spans(unit * (size // len(unit)))
        return perf_counter() - started

    seconds(1_000)
    assert seconds(400_000) < 12 * seconds(100_000) + 0.5


def test_pii_query_holds_all_base_spans(spark, sf_dir, texts):
    rows = QUERIES["op11_pii"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = plain_base(texts[r.doc_id])
        told = ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in base)
        assert r.base_sha256 == hashlib.sha256(told.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in KINDS] == [sum(b[0] == i for b in base) for i in range(4)]
        assert set(filter(None, told.split(","))) <= set(r.spans.split(","))
        assert (len(r.spans.split(",")) if r.spans else 0) == len(base) + r.n_hidden


def test_disguises_planted_in_documents(frame, texts):
    draw, rows, want = random.Random(5), [], {}
    for doc_id, text in list(texts.items())[:120]:
        kind, disguise = draw.choice(DISGUISED)
        words = text.split(" ")
        at = draw.randint(0, len(words))
        before = " ".join(words[:at]) + " -- "
        rows.append((doc_id, f"{before}{disguise} -- {' '.join(words[at:])}"))
        want[doc_id] = (kind, len(before), len(before) + len(disguise), True)
    for r in pii_scan(frame(rows)).collect():
        assert want[r.doc_id] in [tuple(s) for s in r.spans]


# --- importance resampling ----------------------------------------------------------------------------------------


def plain_features(text, orders):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", text) if w]
    return words, [" ".join(words[i:i + n]) for n in range(1, orders + 1) for i in range(len(words) - n + 1)]


def plain_ranks(docs, target, orders, buckets, percent=10, min_words=20):
    def counts(texts):
        return Counter(zlib.crc32(f.encode()) % buckets for t in texts for f in plain_features(t, orders)[1])

    s, t = counts([x for _, x in docs]), counts(target)
    all_s, all_t = sum(s.values()), sum(t.values())
    rows = []
    for doc_id, text in docs:
        words, found = plain_features(text, orders)
        each = [zlib.crc32(f.encode()) % buckets for f in found]
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))
                     for b in each)
        weight = weight // len(each) if each else 0
        rows.append([doc_id, len(words), len(found), weight, weight + noise(doc_id, 2024)])
    fit = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], r[0]))
    rank = {id(r): i + 1 for i, r in enumerate(fit[:percent * len(fit) // 100])}
    return sorted((*r, rank.get(id(r))) for r in rows)


@pytest.mark.parametrize("orders,buckets,percent", [(1, 10_000, 10), (2, 97, 50), (3, 10_000, 100)])
def test_importance_against_plain(spark, sf_dir, documents, texts, orders, buckets, percent):
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows = importance_ranks(documents, target, percent=percent, orders=orders, buckets=buckets).collect()
    want = plain_ranks(list(texts.items()), [r.text for r in target.collect()], orders, buckets, percent)
    assert sorted(map(tuple, rows), key=lambda r: r[0]) == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text("aB é1_-ß \n\0\x7f", max_size=20)), max_size=6), st.integers(1, 4))
def test_hashed_ngrams_against_plain(texts, orders):
    got = [(int(o), int(b)) for owner, bucket in hashed_ngrams(pa.array(texts, pa.string()), orders, 1 << 32)
           for o, b in zip(owner, bucket)]
    want = [(i, zlib.crc32(f.encode())) for i, t in enumerate(texts) for f in plain_features(t, orders)[1]]
    assert sorted(got) == sorted(want)


def test_importance_with_odd_rows(frame, odd, empty):
    from conftest import ODD

    rows = importance_ranks(odd, odd, percent=100, min_words=0).collect()
    assert sorted(r["rank"] for r in rows) == list(range(1, len(ODD) + 1))
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(i) for i, _ in ODD)
    assert {r.weight for r in rows} == {0}  # target and corpus are the same
    assert importance_ranks(empty, odd).collect() == []
    alone = importance_ranks(odd, empty, percent=50, min_words=2).collect()
    assert len(alone) == len(ODD) and sum(r["rank"] is not None for r in alone) == 3  # of 6 with two words
    assert all((r.n_features, r.weight, r["rank"]) == (0, 0, None) for r in alone if r.doc_id in (1, 2, 3))
    copies = frame([(7, "the same text")] * 300 + [(i, "another one") for i in range(100, 200)])
    ranks = importance_ranks(copies, copies, percent=50, min_words=1)
    assert sorted(r["rank"] for r in ranks.where("rank IS NOT NULL").collect()) == list(range(1, 201))
    kept = resampled(copies, ranks)
    assert kept.columns == copies.columns and kept.where("doc_id = 7").count() in (0, 300)


def test_ranks_follow_score_then_id(spark):
    scored = spark.createDataFrame(
        [(i, 30, 30, 0, (i * 7919) % 40 - 20) for i in range(500)] + [(None, 30, 30, 0, 19), (900, 5, 5, 0, 99)],
        "doc_id long, n_words long, n_features long, weight long, score long",
    )
    rows = [r for r in drawn(scored, percent=30).collect() if r["rank"]]
    order = sorted(rows, key=lambda r: (-r.score, r.doc_id is not None, r.doc_id or 0))
    assert [r["rank"] for r in order] == list(range(1, 151)) and order[0].doc_id is None


def test_gains_and_noise():
    assert gains(np.array([0, 3]), np.array([0, 3])).tolist() == [0, 0]
    assert gains(np.array([0, 0]), np.array([0, 0])).tolist() == [0, 0]
    assert gains(np.array([1, 0]), np.array([0, 1])).tolist() == [693, -694]
    draws_ = [noise(i, 2024) for i in range(4000)]
    assert abs(sum(draws_) / len(draws_) - 577) < 60 and noise(None, 1) == noise("", 1)


def test_counts_cover_every_text(documents, texts):
    want = Counter(zlib.crc32(f.encode()) % 50 for t in texts.values() for f in plain_features(t, 1)[1])
    counts = bucket_counts(documents, buckets=50)
    assert dict(enumerate(counts.tolist())) == {b: want[b] for b in range(50)}
    rows = weighted(documents, np.zeros(50, np.int64)).collect()
    assert sum(r.n_features for r in rows) == sum(want.values()) and {r.weight for r in rows} == {0}


# --- fill-in-the-middle -------------------------------------------------------------------------------------------

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_middle(doc_id, text, percent=50):
    text = text or ""
    units = UNIT.findall(text)
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in range(0, 32, 8))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= percent:
        return len(units), "plain", None, None, text
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 80:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def transformed(doc_id, text, percent):
    kept = store([text.encode()])
    form, prefix, middle, output = arranged(doc_id, kept, 42, percent, 80)
    told = (kept.n_units, form, prefix, middle, b"".join(output.stream()).decode())
    return told, b"".join(rebuilt(output, form)).decode()


@settings(max_examples=400, deadline=None)
@given(st.text("ab é 😀 \n\t<PSM>", max_size=80), st.integers(0, 10_000), st.integers(3, 90))
def test_frames_of_any_size_against_plain(text, doc_id, size):
    whole, fill_middle.FRAME_BYTES = fill_middle.FRAME_BYTES, size
    try:
        told, back = transformed(doc_id, text, 100)
        kept = store([text.encode()])
        units = UNIT.findall(text)
        cuts = [kept.cut(n) for n in range(len(units) + 1)]
        assert cuts == [(len("".join(units[:n]).encode()), len("".join(units[:n]))) for n in range(len(units) + 1)]
    finally:
        fill_middle.FRAME_BYTES = whole
    assert told == plain_middle(doc_id, text, 100) and back == text


@pytest.mark.parametrize("text", [
    "x" * 300_000, " " * 300_000, "é " * 100_000, ("word and\n\n" * 30_000) + "  ", "<P" * 90_000, "a" * 65_534 + "<M>",
    "b" * 65_536 + " tail", " " * 65_536 + "x",
])
def test_texts_of_many_frames(text):
    for doc_id in range(12):
        told, back = transformed(doc_id, text, 100)
        assert told == plain_middle(doc_id, text, 100) and back == text


def test_only_the_frame_of_a_cut_is_decompressed():
    kept = store([b"some words here " * 100_000])
    read = []
    kept._decompress = lambda data, before=kept._decompress: read.append(len(data)) or before(data)
    assert kept.cut(150_000) == (799_999 - 3 + 3, 799_999) and len(read) == 1
    assert len(kept.ends) == 25 and b"".join(kept.stream(70_000, 70_020)) == (b"some words here " * 5000)[70_000:70_020]
    assert len(read) == 2


def test_outputs_and_restored_texts(frame, odd, empty):
    from conftest import ODD

    outputs = fill_in_middle(odd, percent=100)
    want = [(i, t, *plain_middle(i, t, 100)) for i, t in ODD]
    told = output_texts(outputs).collect()
    assert sorted((str(r.doc_id), r.text) for r in told) == sorted((str(w[0]), w[-1]) for w in want)
    back = output_texts(outputs, restore=True).collect()
    assert sorted((str(r.doc_id), r.text) for r in back) == sorted((str(w[0]), w[1] or "") for w in want)
    stored = fill_in_stored(framed(odd), percent=100)
    assert sorted(map(str, stored.collect())) == sorted(map(str, outputs.collect()))
    rows = fill_in_middle(odd, percent=100, derive=digests, derived="made string, back string").collect()
    assert sorted((str(r.doc_id), r.n, r.form, r.prefix_chars, r.middle_chars, r.made, r.back) for r in rows) == sorted(
        (str(i), n, form, a, b, hashlib.sha256(out.encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
        for i, t, n, form, a, b, out in want)
    assert fill_in_middle(empty).collect() == [] and fill_in_stored(framed(empty)).collect() == []
    assert draws(None, 42) == draws("", 42) and set(LAYOUT) == {"psm", "spm"}


@pytest.mark.parametrize("run", [pii_scan, masked], ids=["spans", "masked"])
def test_pii_of_odd_rows(run, odd, empty):
    from conftest import ODD

    rows = run(odd).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(i) for i, _ in ODD)
    if run is masked:
        assert run(odd).columns == odd.columns
        assert sorted(str((r.doc_id, r.text)) for r in rows) == sorted(str(r) for r in ODD)
    else:
        assert not any(r.spans for r in rows)
    assert run(empty).collect() == []
