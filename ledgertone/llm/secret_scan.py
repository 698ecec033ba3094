"""Secrets in texts: fixed patterns, plus strings that stay incompressible next to what surrounds them.

A candidate is a long token near a sensitive word. Its novelty is the number of bytes that zstandard needs for it
beyond those for the surrounding text alone, where the compressor is primed with a dictionary of identifiers and
keywords, over the bytes that random characters of the token's own alphabet take. Words, paths and names from the
neighbourhood cost next to nothing; key material costs what its alphabet takes, also in a list of keys, where the
compressor has learned that alphabet.
Other copies of the candidate do not count as surroundings, and every copy of a novel token in the text is a span.

Results for unusual rows: null and empty texts have no spans; repeated rows give repeated results; a null id is passed
through; other columns are not read. Texts are scanned whole. Ties in start are ordered by kind, as listed in KINDS.
"""

import math
import random
import re
from bisect import bisect_left, bisect_right

import zstandard
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructField

from ledgertone.llm.batches import id_and_text, id_type, map_slices, row_schema, whole_rows, with_new_text

KINDS = ("assign", "access", "hex", "novel")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
_ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
# A run shorter than asked for cannot hold a longer one further on, so the minimum can sit in the pattern.
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
# Words that make what follows sensitive.
SENSITIVE = (
    "password", "passwd", "pwd", "secret", "token", "apikey", "api_key", "api-key", "access_key", "private_key",
    "credential", "authorization", "bearer", "signature", "client_id", "passphrase", "conn_str", "connection_string",
)
_SENSITIVE = re.compile("|".join(map(re.escape, SENSITIVE)), re.I | re.A)
_SENSITIVE_BYTES = tuple(w.encode() for w in SENSITIVE)
_LEAST = 16
_TOKEN = re.compile(rf"[A-Za-z0-9+/_=.~-]{{{_LEAST},}}")
_MARKS, _PREFIX = "+/_=.~-", 12
_CHEAP = 0.5  # a share that is no secret's in any surroundings
_LETTERS = "abcdefghijklmnopqrstuvwxyz"
_ALPHABETS = [set("0123456789abcdef"), set("0123456789ABCDEF"), set(_LETTERS.upper() + "234567")]
_CLASSES = [set("0123456789"), set(_LETTERS), set(_LETTERS.upper()), set(_MARKS)]
_RUN = re.compile(rf"[A-Za-z0-9{_MARKS}]{{{_PREFIX},}}")
# Common identifiers and keywords of code and configuration files; the dictionary's content.
IDENTIFIERS = (
    "abstract assert async await boolean break case catch class const continue default def delete elif else enum "
    "except export extends false final finally float for from function global if implements import in int interface "
    "lambda let long match module new null None not object package pass private protected public raise return self "
    "short static string struct super switch synchronized this throw throws true try type typeof undefined union "
    "unsigned var virtual void volatile while with yield "
    "application/json text/plain utf-8 https://www.example.com http://localhost:8080/api/v1/ "
    "access_key access_token account address api_key auth authorization aws_access_key_id aws_secret_access_key "
    "bearer bucket callback certificate charset client client_id client_secret config configuration connection "
    "content-type context cookie created_at credentials customer data database description directory document "
    "element encoding endpoint environment error event exception expires_in filename format handler hash header host "
    "identifier index input instance integration key language length listener location logger manager message method "
    "middleware model name namespace options output parameters parent password path payload permissions port prefix "
    "private_key process production properties protocol provider query redirect_uri reference refresh_token region "
    "registry repository request resource response result role schema scope secret selector service session "
    "settings signature source staging status storage subscription table template timeout timestamp token transaction "
    "update_at url user username value variable version widget window worker xmlns "
    "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 0123456789abcdef "
)

SPAN = "struct<kind:string, start:long, stop:long>"


def base_spans(text: str, low: bytes) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns; ``low`` is the text as lower-cased bytes, to skip most scans."""
    found = []
    if any(w in low for w in _ASSIGN_WORDS):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    if b"akia" in low:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return found


def alphabet_of(token: str) -> set[str]:
    """The smallest usual alphabet that holds the token: hexadecimal, base 32, or the classes of characters that occur."""
    used = set(token)
    for alphabet in _ALPHABETS:
        if used <= alphabet:
            return alphabet
    return set().union(*(kind for kind in _CLASSES if used & kind))


def alphabet_bits(token: str) -> float:
    """Bits of a random character of the token's alphabet."""
    return math.log2(len(alphabet_of(token)))


class Novelty:
    """Marginal compressed bytes of a candidate, given its surroundings and the identifier dictionary."""

    def __init__(self, level: int = 6):
        primed = zstandard.ZstdCompressionDict(IDENTIFIERS.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        primed.precompute_compress(level=level)
        self._compress = zstandard.ZstdCompressor(
            dict_data=primed, level=level, write_content_size=False, write_checksum=False, write_dict_id=False
        ).compress

    def share(self, around: str, candidate: str) -> float:
        """Marginal bytes over those of random characters of the candidate's alphabet. Next to few surroundings the
        compressor spends a byte on each character, so a random token of that alphabet is measured there as well."""
        alone = around.encode("utf-8", "surrogatepass") + b" "
        before = len(self._compress(alone))
        more = len(self._compress(alone + candidate.encode())) - before
        usual = len(candidate) * alphabet_bits(candidate) / 8
        if more > usual * _CHEAP:
            drawn = random.Random(candidate).choices(sorted(alphabet_of(candidate)), k=len(candidate))
            usual = max(usual, len(self._compress(alone + "".join(drawn).encode())) - before)
        return more / usual


def merged(taken: list[tuple[int, int, int]]) -> list[list[int]]:
    """The spans as (start, end), merged where they touch."""
    closed: list[list[int]] = []
    for s, _, e in sorted(taken):
        if closed and s <= closed[-1][1]:
            closed[-1][1] = max(closed[-1][1], e)
        else:
            closed.append([s, e])
    return closed


def candidates(text: str, taken: list[tuple[int, int, int]], reach: int = 48) -> list[tuple[int, int]]:
    """(start, end) of tokens of 16 or more characters, with a digit and a letter, that start within ``reach``
    characters after a sensitive word and lie outside the spans already taken.

    Of a run of token characters that holds sensitive words itself, what follows the first and the last one counts, so
    that a long run costs no more than its length.
    """
    closed = merged(taken)
    starts = [s for s, _ in closed]
    runs: list[tuple[int, int, int]] = []  # first start, last start, end
    for word in _SENSITIVE.finditer(text):
        for m in _TOKEN.finditer(text, word.end(), word.end() + reach + _LEAST):
            if m.start() > word.end() + reach:
                break
            if not runs or m.start() >= runs[-1][2]:
                runs.append((m.start(), m.start(), _TOKEN.match(text, m.start()).end()))
            elif m.start() > runs[-1][1]:
                runs[-1] = (runs[-1][0], m.start(), runs[-1][2])
    found = []
    for first, last, end in runs:
        for start in dict.fromkeys((first, last)):
            before = bisect_left(starts, end) - 1
            if before >= 0 and closed[before][1] > start:
                continue
            token = text[start:end]
            if any(map(str.isdigit, token)) and any(map(str.isalpha, token)):
                found.append((start, end))
    return found


def novel_spans(
    text: str, taken: list[tuple[int, int, int]], novelty: Novelty, reach: int = 48, around: int = 400,
    least: float = 0.8,
) -> list[tuple[int, int, int]]:
    """Candidates whose marginal share, next to all that surrounds them, is at least ``least``."""
    found = []
    for start, end in candidates(text, taken, reach):
        near = text[max(0, start - around):start] + " " + text[end:end + around]
        if novelty.share(near, text[start:end]) >= least:
            found.append((start, 3, end))
    return found


def core(token: str) -> str:
    """The token without marks at its ends, which differ from copy to copy ('=key', '/key'), unless little is left."""
    inner = token.strip(_MARKS)
    return inner if len(inner) >= _PREFIX else token


def without(text: str, start: int, end: int, copy: str, first: int, last: int) -> str:
    """text[start:end] without the copies of ``copy`` in text[first:last], also those that only reach into it."""
    parts, at = [], start
    found = text.find(copy, first, last)
    while found >= 0:
        parts.append(text[at:found])
        at = max(at, found + len(copy))
        found = text.find(copy, found + len(copy), last)
    return " ".join([*parts, text[at:end]])


def copies(text: str, keys: set[str]) -> list[tuple[int, int]]:
    """(start, end) of the places where a key stands, but for those within a longer one; sorted. One pass: lengths of
    keys are looked up by their first characters. Keys hold characters of tokens only."""
    lengths: dict[str, set[int]] = {}
    for key in keys:
        lengths.setdefault(key[:_PREFIX], set()).add(len(key))
    found, reached = [], 0
    for m in _RUN.finditer(text):
        run = m[0]
        for i in range(len(run) - _PREFIX + 1):
            fit = (n for n in lengths.get(run[i:i + _PREFIX], ()) if i + n <= len(run) and run[i:i + n] in keys)
            longest = max(fit, default=0)
            if longest and m.start() + i + longest > reached:
                reached = m.start() + i + longest
                found.append((m.start() + i, reached))
    return found


def repeated_spans(
    text: str, taken: list[tuple[int, int, int]], novelty: Novelty, reach: int = 48, around: int = 400,
    least: float = 0.8,
) -> list[tuple[int, int, int]]:
    """What ``novel_spans`` leaves of tokens that stand more than once: candidates whose share is at least ``least``
    once other copies are taken out of the surroundings, and all copies of any novel token in the text. ``taken`` holds
    the spans of ``novel_spans``, too."""
    keys = {core(text[s:e]) for s, k, e in taken if k == 3}
    found = []
    for start, end in candidates(text, taken, reach):
        key = core(text[start:end])
        if key not in keys:
            low, high = max(0, start - around), end + around
            first, last = max(0, low - len(key) + 1), high + len(key) - 1
            if text.find(key, first, start) < 0 and text.find(key, end, last) < 0:
                continue  # measured before
            near = without(text, low, start, key, first, start) + " " + without(text, end, high, key, end, last)
            if novelty.share(near, text[start:end]) < least:
                continue
            keys.add(key)
        found.append((start, 3, end))
    if keys:
        closed = merged(taken + found)
        starts = [s for s, _ in closed]
        for start, end in copies(text, keys):
            before = bisect_right(starts, start) - 1
            if before < 0 or closed[before][1] < end:
                found.append((start, 3, end))
    return found


def scanner(reach: int, around: int, least: float):
    """A function from a text to its sorted spans (start, kind, stop), for use within a task."""
    novelty = Novelty()

    def spans(text: str | None) -> list[tuple[int, int, int]]:
        if not text:
            return []
        low = text.encode().lower()
        found = base_spans(text, low)
        if any(w in low for w in _SENSITIVE_BYTES):
            found = found + novel_spans(text, found, novelty, reach, around, least)
            found = found + repeated_spans(text, found, novelty, reach, around, least)
        return sorted(found)

    return spans


def secret_scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = 48, around: int = 400,
    least: float = 0.8,
) -> DataFrame:
    """One row per document: ``spans``, an array of (kind, start, stop) in code points, stop exclusive."""

    def start():
        spans = scanner(reach, around, least)
        return lambda piece: [
            piece.column("doc_id"),
            [[{"kind": KINDS[k], "start": s, "stop": e} for s, k, e in spans(t)]
             for t in piece.column("text").to_pylist()],
        ]

    schema = f"doc_id {id_type(docs, id_col)}, spans array<{SPAN}>"
    return map_slices(id_and_text(docs, id_col, text_col), schema, start)


def redact(text: str, spans: list[tuple[int, int]], mask: str = "[secret]") -> str:
    """The text with each span (merged where they overlap) replaced by a mark."""
    out, at = [], 0
    for s, e in sorted(spans):
        if s >= at:
            out += [text[at:s], mask]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redacted(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = 48, around: int = 400,
    least: float = 0.8, mask: str = "[secret]",
) -> DataFrame:
    """The documents, all columns, with every span of ``secret_scan`` replaced by a mark."""
    rows = whole_rows(docs, id_col, text_col)

    def start():
        spans = scanner(reach, around, least)

        def run(piece):
            texts = []
            for t in piece.column("text").to_pylist():
                found = spans(t)
                texts.append(redact(t, [(s, e) for s, _, e in found], mask) if found else t)
            return [piece.column("row"), texts]

        return run

    schema = row_schema(rows, StructField("new_text", StringType()))
    return with_new_text(map_slices(rows.select("row", "text"), schema, start), docs.columns, text_col)
