"""Quality rules, secrets, byte-level BPE and token counts against plain versions."""

import hashlib
import math
import random
import re

import duckdb
import public_tokenizers
import pytest
from compare import difference
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgertone.llm.byte_bpe import byte_bpe, decode, encode, load_encoding, pieces
from ledgertone.llm.queries import ORACLES, QUERIES
from ledgertone.llm.quality_rules import line_rule, quality_rules, repeated_words
from ledgertone.llm.secret_scan import Novelty, alphabet_bits, base_spans, copies, novel_spans, redact, scanner
from ledgertone.llm.secret_scan import secret_scan
from ledgertone.llm.token_counts import MARK, Counter, LevelTrie, SharedTrie, load_scores, token_counts

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def plain_repeats(words, window=8):
    starts = [tuple(words[i:i + window]) for i in range(len(words) - window + 1)]
    covered = {j for i, w in enumerate(starts) if starts.count(w) > 1 for j in range(i, i + window)}
    return len(covered)


def test_repeated_words_against_plain():
    draw = random.Random(7)
    texts = [[draw.choice([b"a", b"b", b"c"]) for _ in range(draw.randint(0, 120))] for _ in range(60)]
    assert repeated_words(texts).tolist() == [plain_repeats(t) for t in texts]


@pytest.mark.parametrize("line,rule", [
    ("A sentence that says something plain, and ends well.", 0),
    ("", 0), ("-----", 1), ("Buy### now$$$ this%%% thing&&&", 1), ("NOW!! BUY!! THIS!! THING!!", 1),
    ("Home | News | Sport | About", 2), ("so so so so so so", 3), ("Copyright (c) Somebody. All rights reserved.", 4),
    ("Is it so? Yes! It is 5% of all.", 0),
])
def test_line_rules(line, rule):
    assert line_rule(line.encode()) == rule


def test_quality_rules_keep_the_rest_of_a_document(frame):
    good = "\n".join(f"Line {i} says {i * 7} and {i * 11}, {i * 13}, then {i * 17}." for i in range(1, 10))
    rows = [(1, f"{good}\nHome | News | About\nAll rights reserved."), (2, "\n".join(["Home | News | About"] * 9 + ["x y"]))]
    result = {r.doc_id: r for r in quality_rules(frame(rows)).collect()}
    assert result[1].kept and result[1].clean_text == good and result[1].n_bad_lines == 2
    assert not result[2].kept


def test_notices_count_as_lost_text(frame):
    clean = "Twenty-four words of a clean text stand here and say this and that, and then a licence line follows on the next line below."
    notice = "This work is licensed under the GNU General Public License, version 3."
    page = "\n".join([notice, "All rights reserved by us and by nobody else at all, as ever.", "We accept cookies: accept cookies."])
    rows = [
        (1, f"{clean}\n{notice}"), (2, f"{notice}\n{notice[:-1]}!"), (3, f"{page}\nword"),
        (4, f"{clean}\n" + "\n".join([notice] * 3)),  # more lost than kept
        (5, " ".join(clean.split()[:19]) + f"\n{notice}"),  # nineteen words stay
        (6, " ".join(clean.split()[:20]) + f"\n{notice}"),
    ]
    found = {r.doc_id: r for r in quality_rules(frame(rows)).collect()}
    assert {i: r.kept for i, r in found.items()} == {1: True, 2: False, 3: False, 4: False, 5: False, 6: True}
    assert found[1].clean_text == clean and found[1].lost_pct > 30


def test_short_navigation_lines_against_the_twin(spark, tmp_path):
    good = "\n".join(f"Line {i} says {i * 7} and {i * 11}, then {i * 13}." for i in range(1, 5))
    rows = [(0, good)]
    for bar in ("|", "»", "•", "›", ">", "/"):
        for line in (f"Home {bar} News {bar} Sport", f"Login {bar} Help", f"a{bar}b {bar} c", f"{bar} {bar}"):
            rows.append((len(rows), "\n".join([f"{line} {n}" for n in range(9)] + ["x y"])))
            rows.append((len(rows), f"{good}\n{line}"))
        assert line_rule(f"Home {bar} News {bar} Sport {bar} About".encode()) == 2
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert difference(QUERIES["op2_quality_rules"](spark, str(tmp_path)), con, ORACLES["op2_quality_rules"]) is None


def plain_base(text):
    spans = []
    for m in re.finditer(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A
    ):
        if len(m[2]) >= 12:
            spans.append((m.start(), 0, m.end()))
    spans += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    spans += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(spans)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(
    ["password", "Token", "api_key", "ſecret", "secret", ":", "=", " ", '"', "AKIA", "ABCDEF0123456789", "deadbeef", "é",
     "0123456789abcdef", "_x", "\n", "K"]), max_size=25))
def test_base_spans_against_plain(parts):
    text = "".join(parts)
    assert sorted(base_spans(text, text.encode().lower())) == plain_base(text)


def test_novel_strings_are_reported_and_known_words_are_not():
    novelty = Novelty()
    key = "q7Zp0xVd93LmTr5yKw28"
    text = f"the client_id of the service is {key} and the bearer refresh_token_expires_in2 is nothing"
    assert [text[s:e] for s, _, e in novel_spans(text, [], novelty)] == [key]
    assert novel_spans(f"nothing here asks for care: {key}", [], novelty) == []
    again = f"{key} was said before; the credential {key}"
    assert novel_spans(again, [], novelty) == []
    assert redact("abcdef", [(1, 3), (2, 4)]) == "a[secret]ef"


def test_repeated_secrets_are_reported_wherever_they_stand():
    spans, draw = scanner(48, 400, 0.8), random.Random(3)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    for gap in (0, 100, 290, 330, 1_000):
        key = "k7" + "".join(draw.choices(letters, k=38))
        line = f"curl -H 'Authorization: Bearer {key}' https://www.example.com/items"
        text = f"{line}\n{'plain words ' * (gap // 12)}\n{line}\nand once more, beside nothing: {key}\n"
        text += f"bearer /{key}/ follows"
        assert [text[s:e].strip("/") for s, _, e in spans(text)] == [key] * 4
        assert key not in redact(text, [(s, e) for s, _, e in spans(text)])
    said = "q7Zp0xVd93LmTr5yKw28"
    text = f"{said} was said before; the credential {said}"
    assert [(k, text[s:e]) for s, k, e in spans(text)] == [(3, said)] * 2
    assert spans("the bearer refresh_token_expires_in2 and the bearer refresh_token_expires_in2") == []
    many = {key + "x" * n for n in (0, 5)}
    assert copies(f"{key}xxxxx.{key}", many) == [(0, 45), (46, 86)]


HEX, BASE32 = "0123456789ABCDEF", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
BASE36 = "abcdefghijklmnopqrstuvwxyz0123456789"
SETTINGS = {
    "one": (1, "We write that the bearer of this is {} and go on with other words in plain prose."),
    "twice": (1, "bearer {0}\nsomething else\nbearer {0}\n"), "headers": (400, "Authorization: Bearer {}"),
    "variables": (400, "SERVICE_SIGNATURE {}"), "prose": (400, "the client_id is {} here"),
}


@pytest.mark.parametrize("setting", SETTINGS)
@pytest.mark.parametrize("alphabet", [HEX, HEX.lower(), BASE32, BASE36, BASE36 + BASE32[:26]],
                         ids=["HEX", "hex", "base32", "base36", "base62"])
def test_planted_keys_are_found_by_alphabet_and_setting(alphabet, setting):
    draw, spans = random.Random(11), scanner(48, 400, 0.8)
    lines, form = SETTINGS[setting]
    for length in (20, 40, 64):
        keys = ["".join(draw.choices(alphabet, k=length)) for _ in range(max(lines, 100))]
        found = 0
        for first in range(0, len(keys), lines):
            text = "\n".join(form.format(k) for k in keys[first:first + lines])
            covered = spans(text)
            for key in keys[first:first + lines]:
                at = text.find(key)
                found += any(s <= at and at + length <= e for s, _, e in covered)
        assert found >= 0.9 * len(keys)


def test_alphabets():
    assert [alphabet_bits(t) for t in ("0a9f", "0A9F", "AZ27", "az", "z1")] == [
        4, 4, 5, math.log2(26), math.log2(36)]
    assert alphabet_bits("aA1") == math.log2(62) and alphabet_bits("aA1_") == math.log2(69)


def test_names_in_code_cost_less_than_keys():
    spans = scanner(48, 400, 0.8)
    for line in ("token = base_tokenizer_v2.tokenize_line_2(line)", "password_field_2 = form.password_field_2.value",
                 "if secret_manager_v1beta.secret_manager_v1beta_client is None:"):
        assert not any(k == 3 for _, k, _ in spans(f"{line}\n" * 3))


@pytest.mark.parametrize("unit", ["token ", "token", "token_a1", "bearer x1x1x1x1x1x1x1x1x1x1 "])
def test_sensitive_words_all_through_take_time_in_proportion(unit):
    from time import perf_counter

    spans = scanner(48, 400, 0.8)

    def seconds(size):
        started = perf_counter()
        spans(unit * (size // len(unit)))
        return perf_counter() - started

    seconds(1_000)
    assert seconds(400_000) < 12 * seconds(100_000) + 0.5


def test_secret_query_holds_all_base_spans(spark, sf_dir, texts):
    rows = QUERIES["op5_secret_scan"](spark, sf_dir).collect()
    assert len(rows) == len(texts) and sum(r.n_assign + r.n_access + r.n_hex for r in rows) > 0
    for r in rows:
        base = plain_base(texts[r.doc_id])
        told = ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in base)
        assert r.base_sha256 == hashlib.sha256(told.encode()).hexdigest()
        assert set(filter(None, told.split(","))) <= set(r.spans.split(","))


@pytest.fixture(scope="module")
def encoding():
    return load_encoding(RANKS, public_tokenizers.PATTERN)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from(" \n\t 'séa1! "), max_size=400), st.integers(1, 40))
def test_pieces_have_the_ids_of_the_whole(text, size):
    encoding = load_encoding_once()
    assert "".join(pieces(text, size)) == text
    assert [i for p in pieces(text, size) for i in encoding.encode_ordinary(p)] == encoding.encode_ordinary(text)


def load_encoding_once(cache=[]):
    if not cache:
        cache.append(load_encoding(RANKS, public_tokenizers.PATTERN))
    return cache[0]


def test_byte_bpe_round_trip(spark, sf_dir, texts, encoding):
    for r in QUERIES["op6_byte_bpe"](spark, sf_dir).collect():
        ids = encoding.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    long = "word séa \n\n 12 " * 20_000
    assert decode(encoding, encode(encoding, long)) == long.encode()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["a", "\u00e9", "!", "1", "'s", " ", "\n", "\x1c", "\x85", " " * 4095, " " * 4096, "\n" * 5000,
                                 "\u2003" * 4200]), max_size=7))
def test_long_runs_have_the_ids_of_the_whole(parts):
    text = "".join(parts)
    assert encode(load_encoding_once(), text) == load_encoding_once().encode_ordinary(text)


@pytest.mark.parametrize("text", [
    " " * 2_000_000, "\n" * 2_000_000, "a" * 2_000_000, "word" + " " * 2_000_000 + "word", "x\n\n" + "\n" * 2_000_000 + " y",
    "!" * 2_000_000, "\x85" * 1_000_000,
], ids=["blanks", "lines", "letters", "middle", "end", "signs", "other white space"])
def test_bpe_survives_any_long_run(frame, text):
    rows = byte_bpe(frame([(1, text), (2, "plain")], False), RANKS, public_tokenizers.PATTERN,
                    derive=lambda ids, back: (hashlib.sha256(back).hexdigest(),), derived="back string").collect()
    assert {r.doc_id: r.back for r in rows} == {
        1: hashlib.sha256(text.encode()).hexdigest(), 2: hashlib.sha256(b"plain").hexdigest()}


def plain_viterbi(word, scores):
    text = MARK + word
    low = min(scores.values()) - 10.0
    best = [(0.0, 0)]
    for end in range(1, len(text) + 1):
        size = len(text[end - 1].encode())
        options = [(best[end - 1][0] + size * low, best[end - 1][1] + size)]
        for begin in range(end - 1, -1, -1):
            if text[begin:end] in scores:
                options.append((best[begin][0] + scores[text[begin:end]], best[begin][1] + 1))
        top = max(o[0] for o in options)
        best.append((top, min(o[1] for o in options if o[0] == top)))
    return best[-1][1]


def test_shared_trie_against_plain_viterbi():
    scores = load_scores(PIECES)
    assert max(scores.values()) == -math.log(2.0)
    draw = random.Random(3)
    words = ["".join(draw.choices("abcdehilnorstué😀", k=draw.randint(1, 14))) for _ in range(400)]
    words += ["international", "internationally", "internal", "the", "", "a" * 300]
    roomy, tight = SharedTrie(scores), SharedTrie(scores, max_nodes=50)
    for word in words:
        assert roomy.count(word) == tight.count(word) == plain_viterbi(word, scores)
    levels = LevelTrie(scores)
    words += ["the\0", "\0", "a" * 31, "a" * 32, "é" * 31]
    assert levels.counts(list(set(words))) == {w: plain_viterbi(w, scores) for w in words}
    alone = sum(len(w) + 1 for w in ("international", "internationally", "internal"))  # with the space marks
    before = levels.computed
    levels.counts(["international", "internationally", "internal"])
    assert levels.computed - before == len("internationally") + 2 < alone  # each prefix once: two ends differ
    before = roomy.computed
    roomy.count("internationalist")
    assert roomy.computed - before == 3  # only the new letters


def test_long_words_keep_few_prefixes():
    import tracemalloc

    scores, draw = load_scores(PIECES), random.Random(8)
    trie = SharedTrie(scores)
    for word in ("".join(draw.choices("abcdehilnorstu\u00e9\U0001f600", k=400)), "a" * 300, "international" * 30):
        assert trie.count(word) == plain_viterbi(word, scores)
    assert trie.nodes == 1 and not trie.terminal
    word = "".join(draw.choices("abcdehilnorstu", k=300_000))
    tracemalloc.start()
    trie.count(word)
    assert tracemalloc.get_traced_memory()[1] < 3_000_000  # the word itself and a mark in front
    tracemalloc.stop()
    counter = Counter(PIECES)
    assert counter([[word[:5000], "the"]]) == [trie.count(word[:5000]) + trie.count("the")] and list(counter.known) == ["the"]


def test_pieces_are_compared_not_only_hashed():
    levels = LevelTrie(load_scores(PIECES))
    right = levels.counts(["international"])
    levels.spelled[:] = 0  # nothing is spelled like this: every hit is a stranger
    assert levels.counts(["international"])["international"] > right["international"]


def test_token_counts_of_documents(documents, texts):
    scores, known = load_scores(PIECES), {}
    for r in token_counts(documents, PIECES).limit(40).collect():
        words = texts[r.doc_id].split()
        for w in words:
            if w not in known:
                known[w] = plain_viterbi(w, scores)
        assert (r.n_words, r.n_tokens) == (len(words), sum(known[w] for w in words))


@pytest.mark.parametrize("run", [
    quality_rules, secret_scan, lambda d: byte_bpe(d, RANKS, public_tokenizers.PATTERN),
    lambda d: token_counts(d, PIECES),
], ids=["quality", "secrets", "bpe", "counts"])
def test_odd_rows(run, odd, empty):
    from conftest import ODD

    rows = run(odd).collect()
    assert len(rows) == len(ODD)
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(i) for i, _ in ODD)
    by_id = {r.doc_id: r.asDict() for r in rows}
    nothing = [{k: v for k, v in by_id[i].items() if k not in ("doc_id", "clean_text")} for i in (1, 2)]
    assert nothing[0] == nothing[1]
    assert run(empty).collect() == []
