"""Token sequences of bounded length from whole documents, with bounded-space online packing.

Each task keeps a fixed number of open windows. A document's ids are cut into full windows and a tail; the tail goes to
the open window that it fills best. When it fits in none and no more windows may be opened, the fullest is emitted, its
gap filled with the head of the tail if both parts are long enough. What is open at the end of the partitions is
gathered and packed again in the same way, some partitions to a task; the windows left there are cut into lengths that
are powers of two, which need no padding.

Results for unusual rows: null and empty texts are the end id alone; repeated rows are packed each for itself; a null
id is passed through; other columns are not read. Texts of any length are encoded whole.
"""

import os
import re
import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgertone.llm.batches import handing_back, id_and_text, id_type, kept_table, map_slices
from ledgertone.session import scratch_path

SIZE = 2048
OPEN_WINDOWS = 16
LEAST_CUT = 64
MERGED_RUNS = 16
ID_BYTES = 4
# Words of a slice lie in memory one by one, at over ten times their text.
SLICE_BYTES = 1 << 20


def _spelling() -> dict[int, int]:
    """Byte-level spelling: printable Latin-1 bytes stand for themselves, the others for U+0100 and on, in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    return dict(zip([b for b in range(256) if b not in plain], range(256, 512)))


class WordIds:
    """Ids of a tokenizer that drops white space, looked up by word.

    A word's ids do not depend on its neighbours, so each distinct word of some texts is looked up once and texts are
    joined from what was found. The table is in two halves of ``most`` words together: when the newer one is full, the
    older one goes, with the words that have not come up since. That costs time only.
    """

    _FENCE = "<|startoftext|>"  # a special token: its id stands for nothing else
    # Printable ASCII but letters, digits and the apostrophe, which may begin an ending.
    _MARKS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
    # A full stop or comma after a letter (a-z, or Latin-1 beyond ASCII) and before white space.
    _STOP = re.compile(rb"(?:(?<=[a-z])|(?<=\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]))([.,])(?=[ \t-\r]|\Z)")
    # One that follows anything else: other marks may belong to its run.
    _OTHER_STOP = re.compile(rb"[.,](?=[ \n]|\Z)(?<![a-z].)(?<!\xc3[\x80-\x96\x98-\xb6\xb8-\xbf].)")
    _STOPS = tuple((c + s, b" " + c + s) for c in (b".", b",") for s in (b" ", b"\n"))

    def __init__(self, tokenizer_file: str, most: int = 900_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(tokenizer_file)
        self._fence_id = self._tokenizer.token_to_id(self._FENCE)
        self._special = [t.content.encode() for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._most = most
        self._known: dict[bytes, bytes] = {}
        self._before: dict[bytes, bytes] = {}

    def _encode(self, text: str) -> np.ndarray:
        found = self._tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return np.asarray(found, "<u4")

    def _learn(self, words: list[bytes]) -> None:
        """Lower-case Latin words are one token run that normalisation leaves alone, and so are the marks that follow
        one: the model gets each as it is spelt. All else goes through the whole tokenizer, many words at once with
        fences between them."""
        tokenize, spelling, others = self._tokenizer.model.tokenize, _spelling(), []
        known, pack_ids = self._known, {n: struct.Struct(f"<{n}I").pack for n in range(33)}
        for word in words:
            stem = word.rstrip(self._MARKS)
            if not stem or stem.isalpha() and stem.islower():  # of bytes: ASCII letters
                spelt = stem.decode()
            else:
                text = stem.decode()
                if not (text.isalpha() and text.islower() and text == text.lower() and max(text) < "\u0250"):
                    others.append(word)
                    continue
                spelt = stem.decode("latin-1").translate(spelling)
            ids = [t.id for run in (spelt, word[len(stem):].decode()) if run for t in tokenize(run)]
            known[word] = pack_ids[len(ids)](*ids) if len(ids) <= 32 else np.array(ids, "<u4").tobytes()
        plain = [w for w in others if self._FENCE.encode() not in w]
        for at in range(0, len(plain), 20_000):
            part = plain[at:at + 20_000]
            ids = self._encode(self._FENCE.join(w.decode() for w in part))
            cuts = np.flatnonzero(ids == self._fence_id)
            data = ids.tobytes()
            starts = [0, *((cuts + 1) * ID_BYTES).tolist()]
            stops = [*(cuts * ID_BYTES).tolist(), len(data)]
            self._known.update((w, data[s:e]) for w, s, e in zip(part, starts, stops, strict=True))
        for word in others:
            if word not in self._known:
                self._known[word] = self._encode(word.decode()).tobytes()

    def parted(self, text: str) -> bytes:
        """The text with white space between parts whose ids, joined, are those of the text.

        The tokenizer lower-cases after composing accents. Lower-casing ASCII letters first changes nothing unless a
        combining accent (U+0300 to U+036F) follows one, or the text has a special token in other letters, as those are
        matched before; then the text stays as it is. A full stop or comma after a letter and before white space is a
        token run of its own, so it may stand alone.
        """
        data = text.encode()
        low = data.lower()
        if b"\xcc" not in data and b"\xcd" not in data and all(low.count(s) == data.count(s) for s in self._special):
            data = low
            if self._OTHER_STOP.search(data) is not None:
                data = self._STOP.sub(rb" \1", data)
            else:  # the same, faster
                for before, after in self._STOPS:
                    data = data.replace(before, after)
                if data.endswith((b".", b",")):
                    data = data[:-1] + b" " + data[-1:]
        return data

    def _ids(self, words: list[bytes]) -> list[bytes]:
        """Ids of distinct words, of which those not seen for long are learnt."""
        if len(self._known) > self._most // 2:
            self._before, self._known = self._known, {}
        found = list(map(self._known.get, words))
        missing = [i for i, ids in enumerate(found) if ids is None]
        again = [(words[i], self._before.get(words[i])) for i in missing]
        self._known.update((word, ids) for word, ids in again if ids is not None)
        self._learn([word for word, ids in again if ids is None])
        for i in missing:
            found[i] = self._known[words[i]]
        return found

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        parted = pa.array([self.parted(t) if t else b"" for t in texts], pa.large_string())
        lists = pc.ascii_split_whitespace(parted)
        words = lists.flatten().dictionary_encode()
        if not len(words):
            return [b""] * len(texts)
        distinct = words.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False).tolist()
        ids = pa.array(self._ids(distinct), pa.large_binary()).take(words.indices)
        _, ends, data = ids.buffers()
        cuts = np.frombuffer(ends, np.int64)[lists.offsets.to_numpy()].tolist()
        return [data[a:b].to_pybytes() for a, b in zip(cuts, cuts[1:])]


def word_ids(tokenizer_file: str) -> WordIds:
    """One table for each Python worker while its tasks ask for it."""
    return kept_table(("word_ids", tokenizer_file), lambda: WordIds(tokenizer_file))


class Packer:
    """Open windows of a task. ``out`` collects pieces: (doc, start, ids, doc_tokens, sequence, offset)."""

    def __init__(self, first_sequence: int, size: int = SIZE, windows: int = OPEN_WINDOWS, least_cut: int = LEAST_CUT):
        self.size, self.windows, self.least_cut = size, windows, least_cut
        self.sequence = first_sequence
        self.open: list[list] = []  # [filled, pieces]
        self.out: list[tuple] = []

    def _emit(self, pieces: list) -> None:
        offset = 0
        for doc, start, ids, tokens in pieces:
            self.out.append((doc, start, ids, tokens, self.sequence, offset))
            offset += len(ids) // ID_BYTES
        self.sequence += 1

    def _put(self, window: list, doc, start: int, ids: bytes, tokens: int) -> None:
        window[0] += len(ids) // ID_BYTES
        window[1].append((doc, start, ids, tokens))
        if window[0] == self.size:
            self.open.remove(window)
            self._emit(window[1])

    def add(self, doc, ids: bytes, tokens: int, start: int = 0) -> None:
        full = self.size * ID_BYTES
        at = 0
        while len(ids) - at >= full:
            self._emit([(doc, start + at // ID_BYTES, ids[at:at + full], tokens)])
            at += full
        ids, start = ids[at:], start + at // ID_BYTES
        if not ids:
            return
        n = len(ids) // ID_BYTES
        fits = [w for w in self.open if w[0] + n <= self.size]
        if fits:
            self._put(max(fits, key=lambda w: w[0]), doc, start, ids, tokens)
            return
        if len(self.open) >= self.windows:
            fullest = max(self.open, key=lambda w: w[0])
            gap = self.size - fullest[0]
            if gap >= self.least_cut and n - gap >= self.least_cut:
                self._put(fullest, doc, start, ids[:gap * ID_BYTES], tokens)
                return self.add(doc, ids[gap * ID_BYTES:], tokens, start + gap)
            self.open.remove(fullest)
            self._emit(fullest[1])
        window = [0, []]
        self.open.append(window)
        self._put(window, doc, start, ids, tokens)

    def taken(self) -> list[tuple]:
        out, self.out = self.out, []
        return out

    def close_in_powers(self) -> None:
        """Emits the open windows, cut into sequences whose lengths are powers of two."""
        for filled, pieces in self.open:
            rest = list(pieces)
            while filled:
                length = 1 << (filled.bit_length() - 1)
                filled -= length
                part = []
                while length:
                    doc, start, ids, tokens = rest.pop(0)
                    n = min(length, len(ids) // ID_BYTES)
                    part.append((doc, start, ids[:n * ID_BYTES], tokens))
                    if n * ID_BYTES < len(ids):
                        rest.insert(0, (doc, start + n, ids[n * ID_BYTES:], tokens))
                    length -= n
                self._emit(part)
        self.open = []


def _first_sequence(level: int) -> int:
    """Sequence numbers of a task: the level and the partition in the high bits."""
    return (level << 61) | (TaskContext.get().partitionId() << 34)


def _columns(pieces: list[tuple], *more) -> list | None:
    if not pieces:
        return None
    doc, start, ids, tokens, sequence, offset = map(list, zip(*pieces))
    return [doc, start, [len(i) // ID_BYTES for i in ids], ids, tokens, sequence, offset, *more]


def pack(
    docs: DataFrame, tokenizer_file: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
    size: int = SIZE, windows: int = OPEN_WINDOWS, least_cut: int = LEAST_CUT,
) -> DataFrame:
    """One row per piece: its place in the document and in a sequence, and its ids as little-endian 32-bit numbers.

    The tokenizer file (a local path on every executor) must belong to a tokenizer that drops white space. Pieces are
    written once to shared storage, since a recomputed task must not pack differently while others read the result.
    """
    spark = docs.sparkSession
    body = (
        f"doc_id {id_type(docs, id_col)}, start long, length long, ids binary, doc_tokens long, sequence_id long, "
        "offset long"
    )

    def start_online():
        table = word_ids(tokenizer_file)
        packer = Packer(_first_sequence(0), size, windows, least_cut)
        end = int(end_id).to_bytes(ID_BYTES, "little")

        def run(piece):
            ids = table.encode(piece.column("text").to_pylist())
            for doc, data in zip(piece.column("doc_id").to_pylist(), ids):
                data += end
                packer.add(doc, data, len(data) // ID_BYTES)
            done = packer.taken()
            return _columns(done, [None] * len(done))

        run.packer = packer
        return run

    def leftovers(run):
        packer = run.packer
        owner = TaskContext.get().partitionId()
        for _, pieces in packer.open:
            packer._emit(pieces)
        left = packer.taken()
        if left:
            yield _columns(left, [owner] * len(left))

    path = scratch_path(spark, "packed")
    first = map_slices(
        id_and_text(docs, id_col, text_col), f"{body}, owner long", start_online, limit=SLICE_BYTES, finish=leftovers
    )
    first.write.option("compression", "zstd").parquet(path)
    packed = spark.read.schema(first.schema).parquet(path)

    def merge_task(batches):
        packer = Packer(_first_sequence(1), size, windows, least_cut)
        schema = None
        for batch in batches:
            schema = batch.schema.remove(batch.schema.get_field_index("owner"))
            for row in batch.to_pylist():
                packer.add(row["doc_id"], row["ids"], row["doc_tokens"], row["start"])
        packer.close_in_powers()
        if done := _columns(packer.taken()):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(done, schema)], schema=schema)

    left = packed.where(F.col("owner").isNotNull()).withColumn("_run", F.expr(f"owner div {MERGED_RUNS}"))
    merged = (
        left.repartition("_run").sortWithinPartitions("_run", "sequence_id", "offset").drop("_run")
        .mapInArrow(handing_back(merge_task), body)
    )
    return packed.where(F.col("owner").isNull()).drop("owner").unionByName(merged)
