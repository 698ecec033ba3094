"""PPM scores, the shingle join and components against plain versions."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgertone.llm.batches import packed, unpacked
from ledgertone.llm.components import components
from ledgertone.llm.jaccard_join import (
    boundary, crossing_pairs, is_early, jaccard_components, least_overlap, partners, prefix_length, shingle_sets, told_apart,
    tokens,
)
from ledgertone.llm.ppm_scoring import END, ORDER, START, SYMBOLS, ppm_scores
from ledgertone.llm.queries import QUERIES


class PlainPpm:
    """A trie as dictionaries; symbol by symbol."""

    def __init__(self, texts):
        self.counts = defaultdict(Counter)
        for text in texts:
            for context, symbol in self.positions(text):
                for order in range(ORDER + 1):
                    self.counts[context[ORDER - order:]][symbol] += 1

    @staticmethod
    def positions(text):
        symbols = [START] * ORDER + list(text.encode().lower()) + [END]
        return [(tuple(symbols[i - ORDER:i]), symbols[i]) for i in range(ORDER, len(symbols))]

    def score(self, text):
        total = 0.0
        for context, symbol in self.positions(text):
            gone = set()
            for order in range(ORDER, -1, -1):
                seen = {s: n for s, n in self.counts.get(context[ORDER - order:], {}).items() if s not in gone}
                if symbol in seen:
                    total += math.log10(seen[symbol] / (sum(seen.values()) + len(seen)))
                    break
                if seen:
                    total += math.log10(len(seen) / (sum(seen.values()) + len(seen)))
                    gone |= set(seen)
            else:
                total -= math.log10(SYMBOLS - len(gone))
        return total


def plain_base(texts, learn):
    def words(text):
        return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text)) + [None]

    counts = Counter(w for i, t in texts.items() if learn[i] for w in words(t))
    n, v = sum(counts.values()), len(counts)
    return n, {
        i: (len(words(t)), sum(counts[w] > 0 for w in words(t)),
            sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words(t)))
        for i, t in texts.items()
    }


def test_ppm_against_a_plain_trie(frame):
    draw = random.Random(11)
    texts = {i: "".join(draw.choices(["ab", "abc ", "É", "x", "The ", "the", "\n"], k=draw.randint(0, 60)))
             for i in range(60)}
    texts |= {100: "", 101: "zzz unseen ÿ"}
    learn = {i: i % 3 != 0 and i < 100 for i in texts}
    model = PlainPpm([t for i, t in texts.items() if learn[i]])
    total, base = plain_base(texts, learn)
    rows = ppm_scores(frame(texts.items()).repartition(3), (F.col("doc_id") % 3 != 0) & (F.col("doc_id") < 100)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.score == pytest.approx(model.score(texts[r.doc_id]), rel=1e-9)
        n, known, score = base[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert r.base_score == pytest.approx(score, rel=1e-9)


def test_ppm_query_base(spark, sf_dir, texts):
    learn = {i: zlib.crc32(str(i).encode()) % 5 != 1 for i in texts}
    total, base = plain_base(texts, learn)
    rows = QUERIES["op8_ppm_scoring"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    model = PlainPpm([t for i, t in texts.items() if learn[i]])
    for k, r in enumerate(rows):
        n, known, score = base[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (n, known, total, not learn[r.doc_id])
        assert r.base_score == pytest.approx(score, rel=1e-9)
        if k % 40 == 0:
            assert r.score == pytest.approx(model.score(texts[r.doc_id]), rel=1e-9)


def test_ppm_odd_rows(odd, empty, frame):
    rows = ppm_scores(odd, F.lit(True)).collect()
    assert len(rows) == 10
    by = defaultdict(list)
    for r in rows:
        by[r.doc_id].append((r.n_tokens, r.score))
    assert by[1] == by[2] and by[1][0][0] == 1 and len(set(by[4])) == 1
    nothing = ppm_scores(frame([(1, "ab"), (2, None)]), F.lit(None).cast("boolean")).collect()
    assert {r.doc_id: r.score for r in nothing} == pytest.approx({1: -3 * math.log10(257), 2: -math.log10(257)})
    assert [r.base_score for r in nothing] == [0.0, 0.0]
    assert ppm_scores(empty, F.lit(True)).collect() == []


def plain_set(text, size=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)}


def plain_components(rows, percent=80):
    sets = [(i, plain_set(t)) for i, t in rows]
    group = list(range(len(sets)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for x in range(len(sets)):
        for y in range(x):
            a, b = sets[x][1], sets[y][1]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                group[find(x)] = find(y)
    least = {}
    for x, (i, _) in enumerate(sets):
        if i is not None:
            least[find(x)] = min(i, least.get(find(x), i))
    return sorted(((i, len(s), least.get(find(x))) for x, (i, s) in enumerate(sets)), key=str)


def answers(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_join_against_all_pairs(frame, seed):
    """Small and large sets, chains of near copies, a hot group, shared passages, all around the threshold."""
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = draw.choices(vocabulary, k=30)
    rows = []
    for family in range(40):
        words = draw.choices(vocabulary, k=draw.choice([1, 2, 4, 5, 6, 8, 9, 10, 12, 13, 15, 18, 40, 120]))
        if family % 4 == 0:
            words = words + passage
        for _ in range(draw.choice([1, 2, 5, 12])):
            rows.append((len(rows), draw.choice([" ", "\n"]).join(words)))
            words = list(words)
            kind = draw.randint(0, 3)
            at = draw.randrange(len(words))
            if kind == 0:
                words[at] = draw.choice(vocabulary).upper()
            elif kind == 1:
                words.append(draw.choice(vocabulary))
            elif kind == 2 and len(words) > 1:
                del words[-1]
    draw.shuffle(rows)
    got = answers(jaccard_components(frame(rows).repartition(4)))
    assert got == plain_components(rows)
    assert len({c for _, _, c in got}) < len(rows)


def test_texts_of_one_template(frame):
    """Forty texts share 60 words; with 20 words of their own none are alike, with 8 most are."""
    draw = random.Random(4)
    shared = [f"t{i}" for i in range(60)]
    for own in (20, 8, 7, 6):
        rows = [(i, " ".join(shared + [f"u{i}x{j}" for j in range(own + i % 3)])) for i in range(40)]
        draw.shuffle(rows)
        got = answers(jaccard_components(frame(rows).repartition(3)))
        assert got == plain_components(rows)
        assert len({c for _, _, c in got}) == (40 if own > 8 else len({c for _, _, c in plain_components(rows)}))


def test_the_smaller_of_a_pair_is_early(spark):
    places = [(n, p) for n in range(1, 40) for p in range(prefix_length(n, 80))]
    early = {(r.n, r.place) for r in spark.createDataFrame(places, "n int, place int").where(is_early(80)).collect()}
    for n, p in places:
        for m, q in places:
            if n <= m and min(n - p, m - q) >= least_overlap(n, m, 80):
                assert (n, p) in early
    late = [(7, i, 50, 9, i) for i in range(30)]  # met at the tenth shingle: at most 41 of 59 in common
    members = "token long, sig long, n int, place int, comp long"
    assert crossing_pairs(spark.createDataFrame(late, members), 80).count() == 0
    mixed = [*late, (7, 99, 45, 0, 99), (7, 98, 50, 5, 98)]
    got = {(r.a, r.b) for r in crossing_pairs(spark.createDataFrame(mixed, members), 80).collect()}
    want = set()
    for _, a, n, p, _ in mixed:
        for _, b, m, q, _ in mixed:
            if (n, a) < (m, b) and 1 + min(n - p - 1, m - q - 1) >= least_overlap(n, m, 80) and 100 * n >= 80 * m:
                want.add((a, b))
    assert got == want and want


def test_equal_halves_of_a_hash_do_not_merge_sets(spark):
    rows = [(0, 1, 5, 11), (0, 2, 5, 12), (1, 2, 5, 12), (0, 3, 5, 11), (1, 3, 5, 11), (0, 4, 6, 11), (0, 5, None, None)]
    found = spark.createDataFrame(rows, "kind byte, doc_id long, sig long, sig2 long")
    got = {}
    for r in told_apart(found).collect():
        got.setdefault(r.doc_id, set()).add(r.sig)
    assert got[1] == got[3] == {5} and got[4] == {6} and got[5] == {None}
    assert len(got[2]) == 1 and got[2] != {5}


def test_join_odd_rows(odd, empty):
    rows = answers(jaccard_components(odd))
    want = plain_components([
        (1, None), (2, ""), (3, " \n\t "), (None, "a null id"), (4, "same\ntext here"), (4, "same\ntext here"),
        (5, "Éa" * 40_000), (6, "x\n" * 5_000), (7, "   \x1c\x85 ퟿😀"), (8, "same\ntext here"),
    ])
    assert rows == want
    assert answers(jaccard_components(empty)) == []


def test_light_sets_meet_in_a_subset_and_heavy_ones_in_a_list():
    draw = random.Random(9)
    for _ in range(400):
        base = draw.sample(range(1, 200), draw.randint(1, 24))
        other = [x if draw.random() > 0.06 else draw.randint(1, 200) for x in base] + draw.sample(range(200, 230), draw.randint(0, 2))
        a, b = set(base), set(other)
        if a == b or 100 * len(a & b) < 80 * len(a | b):
            continue
        for light in (0, 6, 10, 14):
            met = [
                {t for t, _ in tokens(np.array(sorted(s & (a & b)), np.uint64), len(s - (a & b)), light, 80)}
                for s in (a, b)
            ]
            assert met[0] & met[1], (a, b, light)


def test_bounds():
    for n in range(1, 60):
        for m in range(1, 60):
            t = least_overlap(n, m, 80)
            possible = [i for i in range(min(n, m) + 1) if 100 * i >= 80 * (n + m - i)]
            assert (min(possible) == t) if possible else (t > min(n, m))
            assert bool(possible) == (m in partners(n, 80))
        assert prefix_length(n, 80) == n - min(least_overlap(n, m, 80) for m in partners(n, 80)) + 1
    assert boundary(1.0, 80) < boundary(50.0, 80) <= 14
    keys = np.unique(np.random.default_rng(1).integers(0, 2**35, 5000, dtype=np.uint64))
    assert (unpacked(packed(keys)) == keys).all() and len(unpacked(packed(keys[:0]))) == 0


def test_shingle_sets_have_the_sizes_of_plain_sets(texts):
    some = [t.encode().lower() for t in list(texts.values())[:80]] + [b"a b a b a b a b", b"", b"a", b"b a", b"a b"]
    sets = shingle_sets(some)
    assert [len(s) for s in sets] == [len(plain_set(t.decode())) for t in some]
    assert sets[-1][0] != sets[-2][0]


@pytest.mark.parametrize("edges", [
    [], [(1, 1)], [(i, i + 1) for i in range(200)], [(0, i) for i in range(1, 300)],
    [(i, (i * 7 + 3) % 97) for i in range(97)], [(5, 3), (3, 5), (9, 8), (8, 7)],
])
def test_components(spark, edges):
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    label = {r.node: r.label for r in got}
    group = {x: {x} for e in edges for x in e if e[0] != e[1]}
    for a, b in edges:
        if a != b and group[a] is not group[b]:
            group[a] |= group[b]
            for x in group[a]:
                group[x] = group[a]
    assert set(label) == set(group)
    for x, members in group.items():
        assert label[x] in members and {label[y] for y in members} == {label[x]}
