"""Token counts under a unigram model, by dynamic programming over a trie of distinct pre-tokens.

A pre-token is a space mark and a word, as the vocabulary spells them. Its best segmentation maximises the sum of its
pieces' scores. Forward scores of a prefix are the same for every pre-token that starts with it, so each trie node
holds the forward score and token count of its prefix and is computed once; a pre-token's count is what its last node
holds. Characters that no piece covers cost one token for each UTF-8 byte, at a score below every piece's.

A vocabulary file lists merges by rank rather than probabilities; the unigram score of a piece is minus the logarithm
of its rank (Zipf's law). Equal scores prefer fewer tokens.

Results for unusual rows: null and empty texts count 0; repeated rows give repeated results; a null id is passed
through; other columns are not read. Words of any length are counted whole.
"""

import math

import numpy as np
import sentencepiece
from pyspark.sql import DataFrame

from ledgertone.llm.batches import id_and_text, id_type, map_slices

MARK = "▁"
MAX_NODES = 400_000
LONG_WORD = 256


def load_scores(model_file: str) -> dict[str, float]:
    """Pieces and their unigram scores; control, unknown and byte pieces are left out."""
    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    ranked = [
        model.id_to_piece(i) for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]
    return {piece: -math.log(rank + 2.0) for rank, piece in enumerate(ranked)}


class SharedTrie:
    """Forward scores of all prefixes seen so far; emptied when it grows beyond ``max_nodes``, which costs time only."""

    def __init__(self, scores: dict[str, float], max_nodes: int = MAX_NODES):
        self.scores = scores
        self.longest = max(map(len, scores), default=1)
        # A piece that cannot be begun need not be tried: prefixes of pieces, reversed, end the search early.
        self.tails = {piece[i:] for piece in scores for i in range(len(piece))}
        self.byte_score = min(scores.values(), default=0.0) - 10.0
        self.max_nodes = max_nodes
        self.computed = 0
        self.clear()

    def clear(self):
        self.root = ({}, 0.0, 0)
        self.nodes = 1
        self.terminal: dict[str, int] = {}

    def count(self, word: str) -> int:
        """Tokens of the best segmentation of a word, with the space mark in front."""
        known = self.terminal.get(word)
        if known is not None:
            return known
        if len(word) > LONG_WORD:
            return self.rolling(MARK + word)
        if self.nodes > self.max_nodes:
            self.clear()
        text = MARK + word
        path, node = [self.root], self.root
        for end in range(1, len(text) + 1):
            c = text[end - 1]
            child = node[0].get(c)
            if child is None:
                child = ({}, *self._forward(text, end, path))
                node[0][c] = child
                self.nodes += 1
            path.append(child)
            node = child
        self.terminal[word] = node[2]
        return node[2]

    def rolling(self, text: str) -> int:
        """The same for a word that shares no node: only as many prefixes are kept as the longest piece reaches back."""
        kept: dict[int, tuple] = {0: self.root}
        for end in range(1, len(text) + 1):
            kept[end] = (None, *self._forward(text, end, kept))
            kept.pop(end - self.longest - 1, None)
        return kept[len(text)][2]

    def _forward(self, text: str, end: int, path) -> tuple[float, int]:
        """Best (score, tokens) of text[:end] from those of its prefixes."""
        self.computed += 1
        size = len(text[end - 1].encode("utf-8", "surrogatepass"))
        before = path[end - 1]
        best, tokens = before[1] + size * self.byte_score, before[2] + size
        scores, tails = self.scores, self.tails
        for begin in range(end - 1, max(-1, end - self.longest - 1), -1):
            piece = text[begin:end]
            if piece not in tails:
                break
            score = scores.get(piece)
            if score is not None:
                before = path[begin]
                total, n = before[1] + score, before[2] + 1
                if total > best or (total == best and n < tokens):
                    best, tokens = total, n
        return best, tokens


class LevelTrie:
    """The trie of many words at once, one level after the other, as arrays.

    Sorted words make a trie without pointers: a node of depth d is a run of words that agree in d characters. All
    nodes of a level look for pieces of each length at their ends in one step. Words longer than WIDTH go to a
    SharedTrie.
    """

    WIDTH = 32
    _BASE = np.uint64(0x9E3779B97F4A7C15)
    _FILTER_BITS = np.uint64(22)

    def __init__(self, scores: dict[str, float], max_nodes: int = MAX_NODES):
        self.long_words = SharedTrie(scores, max_nodes)
        self.byte_score = self.long_words.byte_score
        self.longest = min(self.long_words.longest, self.WIDTH)
        pieces = [p for p in scores if len(p) <= self.longest]
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        spelled = self._characters(pieces)
        hashes = self._prefix_hashes(spelled)[np.arange(len(pieces)), lengths]
        hashes += lengths.astype(np.uint64)
        order = np.argsort(hashes)
        self.spelled = spelled[order]
        self.hashes, self.scores = hashes[order], np.fromiter(map(scores.get, pieces), float, len(pieces))[order]
        if len(np.unique(hashes)) < len(hashes):
            raise ValueError("two pieces share a hash")
        self.filter = np.zeros(1 << int(self._FILTER_BITS), bool)
        self.filter[hashes >> (np.uint64(64) - self._FILTER_BITS)] = True
        self.powers = np.cumprod(np.full(self.WIDTH + 1, self._BASE, np.uint64)) * np.uint64(
            pow(int(self._BASE), -1, 1 << 64)
        )
        self.computed = 0

    def _characters(self, words: list[str]) -> np.ndarray:
        return np.array(words, f"U{self.WIDTH}").view(np.uint32).reshape(len(words), self.WIDTH)

    def _prefix_hashes(self, characters: np.ndarray) -> np.ndarray:
        """Polynomial hashes of all prefixes; column d belongs to d characters."""
        out = np.zeros((len(characters), self.WIDTH + 1), np.uint64)
        mixed = (characters.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        mixed ^= mixed >> np.uint64(32)
        mixed *= np.uint64(0xA0761D6478BD642F)
        for d in range(1, self.WIDTH + 1):
            out[:, d] = out[:, d - 1] * self._BASE + mixed[:, d - 1]
        return out

    def counts(self, words: list[str]) -> dict[str, int]:
        """Token counts of distinct words."""
        short = sorted(w for w in words if len(w) < self.WIDTH)
        out = {w: self.long_words.count(w) for w in words if len(w) >= self.WIDTH}
        for at in range(0, len(short), 30_000):
            part = short[at:at + 30_000]
            out.update(zip(part, self._sorted_counts(part)))
        return out

    def _sorted_counts(self, words: list[str]) -> list[int]:
        texts = [MARK + w for w in words]
        n = len(texts)
        length = np.fromiter(map(len, texts), np.int64, n)
        characters = self._characters(texts)
        hashes = self._prefix_hashes(characters)
        agree = np.zeros(n, np.int64)  # characters in common with the word before
        differs = characters[1:] != characters[:-1]
        agree[1:] = np.where(differs.any(axis=1), differs.argmax(axis=1), self.WIDTH)
        width = np.where(characters < 0x80, 1, np.where(characters < 0x800, 2, np.where(characters < 0x10000, 3, 4)))
        node = [np.zeros(n, np.int32)]
        best, tokens = [np.zeros(1)], [np.zeros(1, np.int64)]
        out = np.zeros(n, np.int64)
        for d in range(1, int(length.max()) + 1):
            rows = np.flatnonzero(length >= d)
            new = np.ones(len(rows), bool)
            new[1:] = (np.diff(rows) > 1) | (agree[rows[1:]] < d)
            first = rows[new]
            mine = np.zeros(n, np.int32)
            mine[rows] = np.cumsum(new) - 1
            node.append(mine)
            self.computed += len(first)
            before = node[d - 1][first]
            size = width[first, d - 1]
            score, count = best[d - 1][before] + size * self.byte_score, tokens[d - 1][before] + size
            here = hashes[first, d]
            for k in range(1, min(d, self.longest) + 1):
                piece = here - hashes[first, d - k] * self.powers[k] + np.uint64(k)
                hit = np.flatnonzero(self.filter[piece >> (np.uint64(64) - self._FILTER_BITS)])
                if not len(hit):
                    continue
                at = np.minimum(np.searchsorted(self.hashes, piece[hit]), len(self.hashes) - 1)
                good = self.hashes[at] == piece[hit]
                good[good] = (  # equal hashes only show where to compare
                    self.spelled[at[good], :k] == characters[first[hit[good]], d - k:d]).all(axis=1)
                hit, at = hit[good], at[good]
                begin = node[d - k][first[hit]]
                total, fewer = best[d - k][begin] + self.scores[at], tokens[d - k][begin] + 1
                better = (total > score[hit]) | ((total == score[hit]) & (fewer < count[hit]))
                score[hit[better]], count[hit[better]] = total[better], fewer[better]
            best.append(score)
            tokens.append(count)
            ends = np.flatnonzero(length == d)
            out[ends] = count[mine[ends]]
        return out.tolist()


class Counter:
    """Token counts of words as they come; keeps what it knows, up to ``most`` words."""

    def __init__(self, model_file: str, most: int = 600_000):
        self.trie = LevelTrie(load_scores(model_file))
        self.known: dict[str, int] = {}
        self.most = most

    def __call__(self, lists: list[list[str]]) -> list[int]:
        if len(self.known) > self.most:
            self.known.clear()
        look = self.known.get
        missing = {w for words in lists for w, n in zip(words, map(look, words)) if n is None}
        if missing:
            self.known.update(self.trie.counts(list(missing)))
        counts = [sum(map(look, words)) for words in lists]
        for word in missing:
            if len(word) > LONG_WORD:
                del self.known[word]
        return counts


_COUNTERS: dict[str, Counter] = {}


def counter(model_file: str) -> Counter:
    """One for each Python worker: tasks that follow one another in a worker share what it knows."""
    if model_file not in _COUNTERS:
        _COUNTERS[model_file] = Counter(model_file)
    return _COUNTERS[model_file]


def token_counts(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``n_words`` (pre-tokens) and ``n_tokens``.

    Texts are split at white space (``str.split``). The distinct words of a slice that are not known yet are scored
    together in one trie. The vocabulary file is read once in each worker, from a path that every executor has.
    """

    def start():
        count = counter(model_file)

        def run(piece):
            lists = [t.split() if t else [] for t in piece.column("text").to_pylist()]
            return [piece.column("doc_id"), list(map(len, lists)), count(lists)]

        return run

    schema = f"doc_id {id_type(docs, id_col)}, n_words long, n_tokens long"
    return map_slices(id_and_text(docs, id_col, text_col), schema, start)
