"""Personal data in texts: e-mail and IP addresses, card and phone numbers, plain or disguised.

Plain ones are found by fixed patterns on the text itself. For disguised ones the text runs through three transducers,
each of which rewrites pieces of its input and knows where every piece came from: homoglyphs (look-alike letters, other
scripts' digits, odd spaces and dashes, invisible characters), spelled digits, and 'at' and 'dot' in words or brackets.
The same patterns then read the result, and spans that hold a rewritten piece are mapped back to source characters.

A disguise in plain words is rewritten only in a context that says so: a spelled number needs three spelled digits and
seven digits, an address a known last label, and 'at' as a bare word also a 'dot' that is spelled or in brackets.

Results for unusual rows: null and empty texts have no spans; repeated rows give repeated results; a null id is passed
through; other columns are not read. Texts are scanned whole, in time that grows with their length, also where a single
run of letters, digits, dots or blanks fills the text. Spans are ordered by kind as listed in KINDS, then by start; equal
ones are told once. A disguised span within a plain one of its kind is not told again.
"""

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Callable
from functools import lru_cache
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructField

from ledgertone.llm.batches import id_and_text, id_type, map_slices, row_schema, whole_rows, with_new_text

KINDS = ("email", "ip", "card", "phone")
SPAN = "struct<kind:string, start:long, stop:long, hidden:boolean>"
Span = tuple[int, int, int]  # kind's place in KINDS, start, end
Edit = tuple[int, int, str]  # start, end, what stands there instead

# --- the patterns -------------------------------------------------------------------------------------------------

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_DOTTED = re.compile(r"(?<![0-9])[0-9]++(?:\.++[0-9]++)++")
_NUMBER = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]+")


def emails(text: str) -> list[Span]:
    """From each @: the local part reaches as far left as its characters do, or to the address before."""
    found, bound, at = [], 0, text.find("@")
    while at >= 0:
        before = text[bound:at]
        start = bound + len(before.rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append((0, start, domain.end()))
        bound = domain.end() if domain else at + 1
        at = text.find("@", bound)
    return found


def addresses(text: str) -> list[Span]:
    """Four numbers up to 255 with single dots between, taken from the left."""
    found = []
    for run in _DOTTED.finditer(text):
        start, held, at = run.start(), [], run.start()
        for part in run[0].split("."):
            if part:
                held.append(part)
                if len(held) == 1:
                    start = at
            else:
                held = []
            at += len(part) + 1
            if len(held) == 4:
                if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in held):
                    found.append((1, start, at - 1))
                held = []
    return found


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def cards(text: str) -> list[Span]:
    found = []
    for m in _NUMBER.finditer(text):
        if 16 <= m.end() - m.start() <= 37:
            digits = _NO_DIGIT.sub("", m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append((2, m.start(), m.end()))
    return found


def phones(text: str) -> list[Span]:
    if "+" not in text:
        return []
    return [
        (3, m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(_NO_DIGIT.sub("", m[0])) <= 15
    ]


def plain_spans(text: str) -> list[Span]:
    return emails(text) + addresses(text) + cards(text) + phones(text)


# --- transducers --------------------------------------------------------------------------------------------------


class Rewritten:
    """A text with pieces replaced, and the way back from its characters to those of the source."""

    def __init__(self, text: str, edits: list[Edit]):
        parts, at = [], 0
        for start, end, new in edits:
            parts += (text[at:start], new)
            at = end
        self.text = "".join([*parts, text[at:]])
        grown = [0, *accumulate(len(new) - (end - start) for start, end, new in edits)]
        self._starts = [start + shift for (start, _, _), shift in zip(edits, grown)]
        self._edits = edits

    def source(self, place: int) -> tuple[int, int]:
        """(start, end) in the source of the piece that this character stands in, or of the character."""
        number = bisect_right(self._starts, place) - 1
        if number < 0:
            return place, place + 1
        start, end, new = self._edits[number]
        beyond = place - self._starts[number] - len(new)
        return (start, end) if beyond < 0 else (end + beyond, end + beyond + 1)


# Letters of other scripts that look like Latin ones, each followed by what it looks like.
LOOKALIKES = (
    "АA ВB ЕE ЅS ІI ЈJ КK МM НH ОO РP СC ТT УY ХX аa вb еe ѕs іi јj кk мm нh оo рp сc тt уy хx һh ԁd ԛq ԝw ґr "
    "ΑA ΒB ΕE ΖZ ΗH ΙI ΚK ΜM ΝN ΟO ΡP ΤT ΥY ΧX αa ιi κk νv οo ρp υu ıi ɑa ɡg ʟl 。."
)
# Characters that show nothing.
INVISIBLE = "\u00ad\u034f\u061c\u180e\u200b\u200c\u200d\u200e\u200f\u2060\u2061\u2062\u2063\u2064\ufe0f\ufeff"


@lru_cache(1)
def homoglyphs() -> dict[str, str]:
    """What characters beyond ASCII stand for: by compatibility forms and decimal values, plus the lists above."""
    table = {}
    for code in range(0x80, 0x20000):
        char = chr(code)
        kind = unicodedata.category(char)
        if kind == "Nd":
            table[char] = str(unicodedata.decimal(char))
        elif kind == "Zs":
            table[char] = " "
        elif kind == "Pd":
            table[char] = "-"
        elif kind[0] in "LNPS":
            same = unicodedata.normalize("NFKC", char)
            if len(same) == 1 and same.isascii() and same != char:
                table[char] = same
    table |= {pair[0]: pair[1] for pair in LOOKALIKES.split()}
    table["−"] = "-"
    return table | dict.fromkeys(INVISIBLE, "")


_DIGIT_LIKE = re.compile(r"[0-9][OoIl]{1,3}(?=[\x20-]?[0-9])")


def homoglyph_edits(text: str) -> list[Edit]:
    edits = []
    if not text.isascii():
        table = homoglyphs()
        odd = table.keys() & set(text)
        if odd:  # a class of the few that occur; one of all of them is slow to search with
            places = re.finditer(f"[{re.escape(''.join(odd))}]", text)
            edits = [(m.start(), m.end(), table[m[0]]) for m in places]
    for m in _DIGIT_LIKE.finditer(text):
        edits += [(i, i + 1, "0" if text[i] in "Oo" else "1") for i in range(m.start() + 1, m.end())]
    edits.sort()
    return edits


# The digits' names in English, German, French and Spanish; a place in a row is the digit.
DIGIT_NAMES = (
    "zero one two three four five six seven eight nine",
    "null eins zwei drei vier fünf sechs sieben acht neun",
    "zéro un deux trois quatre cinq six sept huit neuf",
    "cero uno dos tres cuatro cinco seis siete ocho nueve",
)
SPELLED = {name: str(digit) for row in DIGIT_NAMES for digit, name in enumerate(row.split())} | {"oh": "0", "zwo": "2"}
_MANY = {"double": 2, "triple": 3}
_NAMES = "|".join(sorted(SPELLED, key=lambda n: (-len(n), n)))
_GAP = r"(?:\x20dot\x20|[\x20,.-]{1,3})"
_TWO = re.compile(rf"(?:{_NAMES}){_GAP}(?:(?:double|triple)\x20)?(?:{_NAMES}|[0-9])")
_ITEM = rf"(?:(?:(?:double|triple)\x20)?(?:{_NAMES})\b|[0-9]{{1,24}}(?![0-9]))"
_SPOKEN = re.compile(rf"(?<![^\W_])(?:(?P<plus>plus)\x20)?(?P<run>{_ITEM}(?:{_GAP}{_ITEM})++)")
_PART = re.compile(rf"(?:(?P<many>double|triple)\x20)?(?P<name>{_NAMES})\b|(?P<figure>[0-9]+)|(?P<gap>{_GAP})")


def digit_edits(low: str, names: int = 3, digits: int = 7) -> list[Edit]:
    """Runs with at least ``names`` spelled digits and ``digits`` digits in all; the digits of names are put together."""
    if not _TWO.search(low):
        return []
    edits = []
    for m in _SPOKEN.finditer(low):
        told, spelled, count, was_name, gap = [], 0, 0, False, None
        if m["plus"]:
            told.append((m.start(), m.start("run"), "+"))
        for part in _PART.finditer(low, m.start("run"), m.end("run")):
            if part["gap"]:
                gap = part
                continue
            if gap is not None:
                if was_name and part["name"] and gap[0] != " dot ":
                    told.append((gap.start(), gap.end(), ""))
                elif "," in gap[0] or (len(gap[0]) > 1 and gap[0] != " dot "):
                    told.append((gap.start(), gap.end(), " "))
            was_name = bool(part["name"])
            if was_name:
                digit = SPELLED[part["name"]] * _MANY.get(part["many"], 1)
                told.append((part.start(), part.end(), digit))
                spelled += 1
                count += len(digit)
            else:
                count += len(part[0])
        if spelled >= names and count >= digits:
            edits += told
    return edits


# Last labels of addresses that a disguise is believed for.
LAST_LABELS = frozenset(
    "com org net edu gov mil int info biz name pro io co ai app dev me tv cc xyz online site shop tech cloud example "
    "test invalid localhost ac ad ae ar at au be bg br ca ch cl cn cz de dk ee es eu fi fr gr hk hr hu id ie il in ir is "
    "it jp kr lt lu lv ma mx my nl no nz pe ph pk pl pt ro rs ru sa se sg si sk th tr tw ua uk us uy ve vn za".split()
)
_OPEN, _CLOSE = r"\x20{0,2}[(\[{<]\x20{0,2}", r"\x20{0,2}[)\]}>]\x20{0,2}"
_AT = re.compile(
    rf"(?P<sure>{_OPEN}(?:at|@|ät|arroba|arobase){_CLOSE}|\x20{{1,2}}@\x20{{0,2}}|@\x20{{1,2}}|&\#64;|&\#x40;|&commat;|%40)"
    r"|(?P<bare>[\x20_](?:at|arroba|arobase)[\x20_])|@"
)
_DOT_SPELLED = (
    rf"(?:{_OPEN}(?:dot|\.|punkt|punto|point){_CLOSE}|&\#46;|&\#x2e;|&period;|%2e|[\x20_](?:dot|punkt|punto|point)[\x20_])"
)
_DOT = rf"(?:{_DOT_SPELLED}|\.)"
_SPELLED_DOT = re.compile(_DOT_SPELLED)
_HOST = re.compile(rf"[a-z0-9-]++(?:{_DOT}[a-z0-9-]++)++")
_LABEL = re.compile(rf"(?P<dot>{_DOT})(?P<label>[a-z0-9-]++)")
_FIRST = re.compile(r"[a-z0-9-]++")
_DOT_BEFORE = re.compile(rf"{_DOT_SPELLED}\Z")
_OCTETS = re.compile(rf"(?<![0-9.])[0-9]{{1,3}}(?:{_DOT}[0-9]{{1,3}}){{3}}(?![0-9])")
_DOT_SIGNS = ("dot", "punkt", "punto", "point", "[.]", "(.)", "{.}", "<.>", "&#46", "&#x2e", "&period", "%2e")
_SURE_SIGNS = ("@ ", " @", "(at", "[at", "{at", "<at", "[@", "(@", "{@", "<@", "( at", "[ at", "&#64", "&#x40", "&commat",
               "%40", "ät", "arroba", "arobase")
_DOT_REACH, _LOCAL_LOW = 16, "abcdefghijklmnopqrstuvwxyz0123456789._%+-"


def host_edits(low: str, start: int) -> tuple[list[Edit], bool] | None:
    """Edits of a host name's dots up to its last known label, and whether there is one; None without such a label."""
    host = _HOST.match(low, start)
    if not host:
        return None
    edits, known, known_end = [], None, 0
    for m in _LABEL.finditer(low, _FIRST.match(low, start).end(), host.end()):
        if m["dot"] != ".":
            edits.append((m.start("dot"), m.end("dot"), "."))
        if m["label"] in LAST_LABELS:
            known, known_end = len(edits), m.end()
    return None if known is None else (edits[:known], known_end > start)


def local_start(low: str, end: int, bound: int) -> tuple[int, list[Edit]]:
    """Where the local part that ends at ``end`` begins, with the edits of spelled dots in it."""
    edits = []
    start = end
    while True:
        floor = max(bound, start - 64)  # a local part has 64 characters at most
        word = low[floor:start]
        begin = floor + len(word.rstrip(_LOCAL_LOW))
        if begin == start:
            return (edits[-1][1] if edits else start), edits[:-1]
        start = begin
        near = max(bound, start - _DOT_REACH)
        dot = _DOT_BEFORE.search(low[near:start])
        if not dot or end - start > 64:
            return start, edits
        edits.append((near + dot.start(), start, "."))
        start = near + dot.start()


def address_edits(low: str) -> list[Edit]:
    """'at' and 'dot' in the disguises above, where they make an e-mail or IP address."""
    dots = any(s in low for s in _DOT_SIGNS)
    if not (dots or any(s in low for s in _SURE_SIGNS)):
        return []
    edits, bound = [], 0
    if dots or "@" in low or "at" in low or "&" in low or "%40" in low:
        for m in _AT.finditer(low):
            if m.start() < bound:
                continue
            host = host_edits(low, m.end())
            if host is None:
                continue
            dotted = host[0]
            if not m["sure"] and not dotted:
                continue
            start, inside = local_start(low, m.start(), bound)
            if start == m.start():
                continue
            edits += inside
            if m[0] != "@":
                edits.append((m.start(), m.end(), "@"))
            edits += dotted
            bound = max(m.end(), dotted[-1][1] if dotted else 0)
    if dots:
        for m in _OCTETS.finditer(low):
            edits += [(d.start(), d.end(), ".") for d in _SPELLED_DOT.finditer(low, m.start(), m.end())]
    edits.sort()
    apart, last = [], -1
    for edit in edits:
        if edit[0] >= last:
            apart.append(edit)
            last = edit[1]
    return apart


def lowered(text: str) -> str:
    """Lower case, with every character in its place."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def hidden_spans(text: str, plain: list[Span]) -> list[Span]:
    """Spans that the patterns find only in the rewritten text, in places of the source."""
    steps: list[Rewritten] = []
    now = text
    stages: tuple[Callable[[str], list[Edit]], ...] = (
        homoglyph_edits, lambda t: digit_edits(lowered(t)), lambda t: address_edits(lowered(t)),
    )
    for edits_of in stages:
        edits = edits_of(now)
        if edits:
            steps.append(Rewritten(now, edits))
            now = steps[-1].text
    if not steps:
        return []
    covered: list[list[Span]] = [[s for s in plain if s[0] == k] for k in range(len(KINDS))]
    found = set()
    for kind, start, end in plain_spans(now):
        first, last = (start, start + 1), (end - 1, end)
        for step in reversed(steps):
            first, last = step.source(first[0]), (step.source(last[0])[0], step.source(last[1] - 1)[1])
        at, stop = first[0], last[1]
        told = now[start:end]
        if text[at:stop] == told or (kind == 2 and len(set(_NO_DIGIT.sub("", told))) == 1):
            continue  # nothing rewritten, or one digit all through
        place = bisect_right(covered[kind], (kind, at, len(text) + 1)) - 1
        if place >= 0 and covered[kind][place][2] >= stop:
            continue
        found.add((kind, at, stop))
    return sorted(found)


def spans(text: str | None) -> list[tuple[int, int, int, bool]]:
    """All spans (kind, start, end, hidden) of a text, by kind, then start."""
    if not text:
        return []
    plain = plain_spans(text)
    hidden = hidden_spans(text, plain)
    return sorted([(*s, False) for s in plain] + [(*s, True) for s in hidden])


def pii_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``spans``, an array of (kind, start, stop, hidden) in code points, stop exclusive."""

    def start():
        return lambda piece: [
            piece.column("doc_id"),
            [[{"kind": KINDS[k], "start": s, "stop": e, "hidden": h} for k, s, e, h in spans(t)]
             for t in piece.column("text").to_pylist()],
        ]

    schema = f"doc_id {id_type(docs, id_col)}, spans array<{SPAN}>"
    return map_slices(id_and_text(docs, id_col, text_col), schema, start)


def mask(text: str, found: list[tuple[int, int, int, bool]]) -> str:
    """The text with each span replaced by the name of its kind; spans that overlap become one, named by the first."""
    out, at = [], 0
    for start, end, kind in sorted((s, e, k) for k, s, e, _ in found):
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind]}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def masked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all columns, with every span of ``pii_scan`` replaced by the name of its kind."""
    rows = whole_rows(docs, id_col, text_col)

    def start():
        def run(piece):
            texts = [mask(t, spans(t)) if t else t for t in piece.column("text").to_pylist()]
            return [piece.column("row"), texts]

        return run

    schema = row_schema(rows, StructField("new_text", StringType()))
    return with_new_text(map_slices(rows.select("row", "text"), schema, start), docs.columns, text_col)
