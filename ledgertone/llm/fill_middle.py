"""Fill-in-the-middle over seekable compressed texts.

A text is kept as independent zstandard frames of ``FRAME_BYTES`` bytes each, with the units and code points that end up
to the end of each frame. A unit is a word with the white space before it, or white space that ends the text. Where a
cut falls is looked up in the counts, and only the frame that holds it is decompressed; digests and rebuilt texts stream
over the frames in order, so that no whole text has to be in memory uncompressed beside its frames.

Results for unusual rows: a null text counts as empty; an empty text has no frames, no units and the form ``plain``.
Repeated rows give repeated results. A null id draws as an id without digits does. Other columns are not read, so their
names may clash. A text without white space is one unit and is cut into frames like any other.
"""

import hashlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from itertools import pairwise

import numpy as np
import zstandard
from pyspark.sql import DataFrame

from ledgertone.llm.batches import id_and_text, id_type, map_slices

FRAME_BYTES = 1 << 16
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARKS = (PREFIX, SUFFIX, MIDDLE)
STORED = "data binary, ends array<long>, units array<long>, chars array<long>"
_COLUMNS = ("data", "ends", "units", "chars")
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
# What each form is made of, in order: a mark and the part after it (0 prefix, 1 middle, 2 suffix).
LAYOUT = {"psm": ((PREFIX, 0), (SUFFIX, 2), (MIDDLE, 1)), "spm": ((SUFFIX, 2), (PREFIX, 0), (MIDDLE, 1))}


class Frames:
    """A text as frames: ``data`` holds them one after another, the lists say what ends up to the end of each one."""

    def __init__(self, data: bytes, ends: list[int], units: list[int], chars: list[int]):
        self.data, self.ends, self.units, self.chars = data, ends, units, chars
        self._decompress = zstandard.ZstdDecompressor().decompress

    def row(self) -> tuple:
        return self.data, self.ends, self.units, self.chars

    @property
    def n_units(self) -> int:
        return self.units[-1] if self.units else 0

    def frame(self, number: int) -> bytes:
        return self._decompress(self.data[self.ends[number - 1] if number else 0:self.ends[number]])

    def stream(self, start: int = 0, end: int | None = None) -> Iterator[bytes]:
        """The bytes from ``start`` to ``end``, frame by frame; frames outside are left alone."""
        first = start // FRAME_BYTES
        last = len(self.ends) if end is None else -(-end // FRAME_BYTES)
        for number in range(first, last) if end is None or end > start else ():
            at = number * FRAME_BYTES
            piece = self.frame(number)
            stop = len(piece) if end is None else min(len(piece), end - at)
            yield piece[max(0, start - at):stop]

    def cut(self, unit: int) -> tuple[int, int]:
        """(bytes, code points) before the end of the first ``unit`` units, from one decompressed frame."""
        if unit <= 0 or not self.ends:
            return 0, 0
        number = bisect_left(self.units, unit)
        if unit == self.n_units:
            number = len(self.ends) - 1
        before_units, before_chars = (self.units[number - 1], self.chars[number - 1]) if number else (0, 0)
        piece = np.frombuffer(self.frame(number), np.uint8)
        inside = word_ends(piece)
        wanted = unit - before_units - 1
        # The last unit of a frame may end with it, which only the next frame's first byte shows.
        stop = int(inside[wanted]) if wanted < len(inside) and unit < self.n_units else len(piece)
        return number * FRAME_BYTES + stop, before_chars + code_points(piece[:stop])

    def positions(self, wanted: tuple[bytes, ...]) -> dict[bytes, int]:
        """Where each of the given strings of three bytes stands first; absent ones are left out."""
        found, tail, at = {}, b"", 0
        for piece in self.stream():
            window = tail + piece
            for mark in wanted:
                if mark not in found and (place := window.find(mark)) >= 0:
                    found[mark] = at - len(tail) + place
            at += len(piece)
            tail = window[-2:]
        return found


def word_ends(piece: np.ndarray) -> np.ndarray:
    """Offsets at which a word ends because white space follows within the piece."""
    space = _SPACE[piece]
    return np.flatnonzero(space[1:] & ~space[:-1]) + 1


def code_points(piece: np.ndarray) -> int:
    return int(np.count_nonzero(piece & 0xC0 != 0x80))


def even_pieces(chunks: Iterable[bytes]) -> Iterator[bytes]:
    held = bytearray()
    for chunk in chunks:
        for at in range(0, len(chunk), FRAME_BYTES):
            held += chunk[at:at + FRAME_BYTES]
            if len(held) >= FRAME_BYTES:
                yield bytes(held[:FRAME_BYTES])
                del held[:FRAME_BYTES]
    if held:
        yield bytes(held)


def store(chunks: Iterable[bytes]) -> Frames:
    """Frames of a stream of bytes."""
    compress = zstandard.ZstdCompressor(level=1, write_checksum=False).compress
    data, ends, units, chars, in_word = [], [], [], [], False
    at = n_units = n_chars = 0
    for piece in even_pieces(chunks):
        codes = np.frombuffer(piece, np.uint8)
        if in_word and _SPACE[codes[0]]:
            n_units += 1
            units[-1] += 1
        n_units += len(word_ends(codes))
        n_chars += code_points(codes)
        data.append(compress(piece))
        at += len(data[-1])
        ends.append(at)
        units.append(n_units)
        chars.append(n_chars)
        in_word = not _SPACE[codes[-1]]
    if units:
        units[-1] += 1  # the last word or the white space after it ends with the text
    return Frames(b"".join(data), ends, units, chars)


def draws(doc_id, seed: int) -> tuple[int, int, int, int]:
    """Four 32-bit numbers from the id."""
    told = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(told[i:i + 4], "big") for i in range(0, 16, 4))


def arranged(doc_id, text: Frames, seed: int, percent: int, spm_percent: int) -> tuple:
    """(form, prefix code points, middle code points, frames of the output)."""
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not text.ends or h3 % 100 >= percent or text.positions(MARKS):
        return "plain", None, None, text
    n = text.n_units + 1
    (first, first_chars), (second, second_chars) = map(text.cut, sorted((h1 % n, h2 % n)))
    parts = (0, first), (first, second), (second, None)
    form = "spm" if h4 % 100 < spm_percent else "psm"

    def output():
        for mark, part in LAYOUT[form]:
            yield mark
            yield from text.stream(*parts[part])

    return form, first_chars, second_chars - first_chars, store(output())


def rebuilt(output: Frames, form: str) -> Iterator[bytes]:
    """The original text, from an output and its form alone: marks stand nowhere in a text that was rearranged."""
    if form == "plain":
        yield from output.stream()
        return
    places = output.positions(MARKS)
    starts = [places[mark] for mark, _ in LAYOUT[form]]
    bounds = {part: (a + len(MIDDLE), b) for (_, part), (a, b) in zip(LAYOUT[form], pairwise([*starts, None]))}
    for part in range(3):
        yield from output.stream(*bounds[part])


def _frames(piece) -> Iterator[Frames]:
    return (Frames(*row) for row in zip(*(piece.column(c).to_pylist() for c in _COLUMNS)))


def framed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, frames): each text in frames, ``n`` its units. Write it to keep a store that later runs seek in."""

    def start():
        def run(piece):
            made = [store([t.encode()] if t else ()) for t in piece.column("text").to_pylist()]
            return [piece.column("doc_id"), [m.n_units for m in made], *map(list, zip(*(m.row() for m in made)))]

        return run

    return map_slices(
        id_and_text(docs, id_col, text_col), f"doc_id {id_type(docs, id_col)}, n long, {STORED}", start
    )


def _rearranged(rows: DataFrame, sized_by: str, texts, seed: int, percent: int, spm_percent: int, derive, derived: str):
    def start():
        def run(piece):
            done = []
            for doc_id, text in zip(piece.column("doc_id").to_pylist(), texts(piece)):
                form, prefix, middle, output = arranged(doc_id, text, seed, percent, spm_percent)
                done.append((text.n_units, form, prefix, middle, *(derive(output, form) if derive else output.row())))
            return [piece.column("doc_id"), *map(list, zip(*done))]

        return run

    schema = f"doc_id {id_type(rows)}, n long, form string, prefix_chars long, middle_chars long, {derived}"
    return map_slices(rows, schema, start, text=sized_by)


def fill_in_middle(
    docs: DataFrame, seed: int = 42, percent: int = 50, spm_percent: int = 80, id_col: str = "doc_id",
    text_col: str = "text", derive=None, derived: str = STORED,
) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, frames of the output), from texts.

    About ``percent`` of the documents are rearranged, of these ``spm_percent`` with the suffix first; a text that holds
    a mark stays plain. ``derive(output, form)`` may replace the frames by values made of them where they arise,
    described by ``derived``; a caller who needs only digests then moves no texts.
    """

    def texts(piece):
        return (store([t.encode()] if t else ()) for t in piece.column("text").to_pylist())

    rows = id_and_text(docs, id_col, text_col)
    return _rearranged(rows, "text", texts, seed, percent, spm_percent, derive, derived)


def fill_in_stored(
    stored: DataFrame, seed: int = 42, percent: int = 50, spm_percent: int = 80, derive=None, derived: str = STORED,
) -> DataFrame:
    """The same from a store that ``framed`` made: other draws of one corpus need not frame it again."""
    return _rearranged(stored, "data", _frames, seed, percent, spm_percent, derive, derived)


def digests(output: Frames, form: str) -> tuple[str, str]:
    """SHA-256 of the output and of the text rebuilt from it, frame by frame."""

    def digest(chunks):
        told = hashlib.sha256()
        for chunk in chunks:
            told.update(chunk)
        return told.hexdigest()

    return digest(output.stream()), digest(rebuilt(output, form))


def output_texts(outputs: DataFrame, restore: bool = False) -> DataFrame:
    """(doc_id, text): the outputs as strings, or with ``restore`` the texts that they came from."""

    def start():
        def run(piece):
            forms = piece.column("form").to_pylist()
            read = [rebuilt(o, f) if restore else o.stream() for o, f in zip(_frames(piece), forms)]
            return [piece.column("doc_id"), [b"".join(r).decode() for r in read]]

        return run

    return map_slices(outputs, f"doc_id {id_type(outputs)}, text string", start, text="data")
