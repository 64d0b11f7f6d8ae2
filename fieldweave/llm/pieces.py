"""SentencePiece encoding that knows which source bytes each piece stands for, and decoding."""

from __future__ import annotations

import heapq
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldweave.llm.common import in_parts

SPACE = "▁"
#: Words whose pieces a worker keeps, and the longest of them; beyond that it starts afresh.
KEPT_WORDS, KEPT_LENGTH = 400_000, 48
#: Symbols up to which the scores of all pairs are looked through for each merge; longer words use a heap.
SHORT = 24
NO_MERGE = float("inf")

# Field numbers and piece kinds of the model file.
PIECES, TRAINER, NORMALIZER, DENORMALIZER = 1, 2, 3, 5
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = range(1, 7)
BPE = 2

_WORDS = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")


def _number(raw: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        value |= (raw[at] & 127) << shift
        at, shift = at + 1, shift + 7
        if raw[at - 1] < 128:
            return value, at


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """``(field, value)`` of a protocol buffer message."""
    at = 0
    while at < len(raw):
        tag, at = _number(raw, at)
        if tag & 7 == 0:
            value, at = _number(raw, at)
        else:
            size, at = _number(raw, at) if tag & 7 == 2 else ({1: 8, 5: 4}[tag & 7], at)
            value, at = raw[at:at + size], at + size
        yield tag >> 3, value


class CharacterMap:
    """The compiled character map: a double-array trie over UTF-8 bytes, each key with its replacement."""

    def __init__(self, blob: bytes) -> None:
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if blob else []
        self.texts = blob[4 + size:]

    def longest(self, raw: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest key that ``raw`` holds at ``at``."""
        units, found = self.units, None
        step = lambda unit: (unit >> 10) << ((unit & 512) >> 6)
        place = step(units[0])
        for end in range(at, len(raw)):
            place ^= raw[end]
            unit = units[place]
            if unit & 0x800000FF != raw[end]:
                break
            place ^= step(unit)
            if unit >> 8 & 1:
                found = end + 1 - at, units[place] & 0x7FFFFFFF
        if found is None:
            return None
        return found[0], self.texts[found[1]:self.texts.index(0, found[1])]

    def parts(self, text: str) -> Iterator[tuple[bytes, int]]:
        """The normalised text in parts, each with the number of source bytes that it stands for."""
        raw, at = text.encode(), 0
        while at < len(raw):
            hit = self.longest(raw, at) if self.units else None
            if hit is None:
                lead = raw[at]
                length = 1 if lead < 0xC0 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                hit = length, raw[at:at + length]
            yield hit[1], hit[0]
            at += hit[0]


class _Known(dict):
    """Pieces of words, worked out when first asked for."""

    def __init__(self, work) -> None:
        super().__init__()
        self.work = work

    def __missing__(self, word: str) -> bytes:
        found = self.work(word)
        if len(word) <= KEPT_LENGTH:
            if len(self) >= KEPT_WORDS:
                self.clear()
            self[word] = found
        return found


class Pieces:
    """A byte-pair model with its normaliser. Models of other kinds or with pieces defined by users are refused."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as file:
            self._read(file.read())
        self.spaced, self.plain = _Known(lambda word: self._packed(SPACE + word)), _Known(self._packed)

    def _read(self, raw: bytes) -> None:
        self.pieces: list[str] = []
        kinds, scores, trainer, normalizer = [], [], {}, {}
        for field, value in _fields(raw):
            if field == PIECES:
                own = dict(_fields(value))
                self.pieces.append(own[1].decode())
                scores.append(struct.unpack("<f", own[2])[0] if 2 in own else 0.0)
                kinds.append(own.get(3, NORMAL))
            elif field == TRAINER:
                trainer |= dict(_fields(value))
            elif field == NORMALIZER:
                normalizer |= dict(_fields(value))
            elif field == DENORMALIZER and dict(_fields(value)).get(2):
                raise ValueError("models that denormalise are not supported")
        if trainer.get(3, 1) != BPE or trainer.get(24) or {USER_DEFINED, UNUSED} & set(kinds):
            raise ValueError("only plain byte-pair models are supported")
        self.unknown_text = trainer.get(44, " ⁇ ".encode()).decode()
        self.map = CharacterMap(normalizer.get(2, b""))
        self.prefix, self.trims = bool(normalizer.get(3, 1)), bool(normalizer.get(4, 1))
        self.space = SPACE if normalizer.get(5, 1) else " "
        self.ids = {p: n for n, (p, kind) in enumerate(zip(self.pieces, kinds)) if kind == NORMAL}
        self.scores = {p: -scores[n] for p, n in self.ids.items()}
        self.packed = {p: struct.pack("<2I", n, len(p.encode())) for p, n in self.ids.items()}
        self.unknown = kinds.index(UNKNOWN)
        self.bytes = {int(p[3:5], 16): n for n, (p, kind) in enumerate(zip(self.pieces, kinds)) if kind == BYTE}
        self.by_byte = bool(trainer.get(35))
        self.byte_of = {n: b for b, n in self.bytes.items()}
        self.control = {n for n, kind in enumerate(kinds) if kind == CONTROL}
        self.texts = [self._text(n, p) for n, p in enumerate(self.pieces)]
        # No piece goes on behind a blank, so words can be merged one by one.
        self.by_word = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.ids)

    def _text(self, number: int, piece: str) -> bytes:
        if number in self.byte_of:
            return bytes([self.byte_of[number]])
        if number in self.control:
            return b""
        return (self.unknown_text if number == self.unknown else piece.replace(SPACE, " ")).encode()

    def normalize(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and for each of its bytes, and its end, the source byte where what it stands for begins."""
        if not text:
            return "", np.zeros(1, np.int32)
        if not self.map.units and not self.trims:
            raw = np.frombuffer(text.encode(), np.uint8)
            if self.space == SPACE:
                text = text.replace(" ", SPACE)
                width = np.where(raw == 32, 3, 1)
                source = np.repeat(np.arange(len(raw), dtype=np.int32), width)
            else:
                source = np.arange(len(raw), dtype=np.int32)
            # All bytes of a character begin where the character begins; ends of pieces never fall between them.
            before = np.zeros(len(self.space.encode()) if self.prefix else 0, np.int32)
            return (self.space if self.prefix else "") + text, np.concatenate([before, source, np.array([len(raw)], np.int32)])
        found, source, at, ready = [], [], 0, self.trims
        blank = self.space.encode()
        parts = list(self.map.parts(text))
        if self.trims:
            while parts and parts[0][0].strip(b" ") == b"":
                at += parts.pop(0)[1]
            if not parts:
                return "", np.zeros(1, np.int32)
        if self.prefix:
            found.append(blank)
            source.append(np.full(len(blank), at, np.int32))
        for part, length in parts:
            if ready:
                part = part.lstrip(b" ")
            if part:
                written = part.replace(b" ", blank)
                found.append(written)
                source.append(np.full(len(written), at, np.int32))
                ready = self.trims and part.endswith(b" ")
            at += length
        written, source = b"".join(found), np.concatenate(source)
        end = at
        if self.trims:
            while written.endswith(blank):
                written, end = written[:-len(blank)], int(source[len(written) - len(blank)])
            source = source[:len(written)]
        return written.decode(), np.append(source, np.int32(end))

    def _merged(self, word: str) -> list[str]:
        """The symbols of a word after all merges: best score first, the leftmost of equal ones."""
        symbols, scores = list(word), self.scores
        if len(symbols) <= SHORT:
            # The score of each pair of neighbours; a merge changes those of the pairs beside it only.
            pairs = [scores.get(left + right, NO_MERGE) for left, right in zip(symbols, symbols[1:])]
            while pairs and (best := min(pairs)) < NO_MERGE:
                at = pairs.index(best)
                symbol = symbols[at] + symbols[at + 1]
                symbols[at:at + 2] = [symbol]
                del pairs[at]
                if at:
                    pairs[at - 1] = scores.get(symbols[at - 1] + symbol, NO_MERGE)
                if at < len(pairs):
                    pairs[at] = scores.get(symbol + symbols[at + 1], NO_MERGE)
            return symbols
        after, before = list(range(1, len(symbols) + 1)), list(range(-1, len(symbols) - 1))
        heap = []

        def offer(left: int, right: int) -> None:
            if left >= 0 and right < len(symbols):
                pair = symbols[left] + symbols[right]
                if pair in scores:
                    heap.append((scores[pair], left, right, pair))

        for n in range(len(symbols) - 1):
            offer(n, n + 1)
        heapq.heapify(heap)
        while heap:
            _, left, right, pair = heapq.heappop(heap)
            if not symbols[left] or not symbols[right] or after[left] != right or symbols[left] + symbols[right] != pair:
                continue
            symbols[left], symbols[right] = pair, ""
            after[left] = after[right]
            if after[left] < len(symbols):
                before[after[left]] = left
            size = len(heap)
            offer(before[left], left)
            offer(left, after[left])
            new = heap[size:]
            del heap[size:]
            for entry in new:
                heapq.heappush(heap, entry)
        return [s for s in symbols if s]

    def _packed(self, word: str) -> bytes:
        """``(id, length in bytes)`` of each piece of a normalised word, as 32-bit numbers."""
        symbols = self._merged(word)
        try:
            return b"".join([self.packed[symbol] for symbol in symbols])
        except KeyError:
            pass
        found, run = [], False
        for symbol in symbols:
            number, size = self.ids.get(symbol), len(symbol.encode())
            if number is not None:
                found += number, size
            elif self.by_byte:
                # The last byte stands for the whole character, those before it for nothing.
                for byte in symbol.encode():
                    found += self.bytes[byte], 0
                found[-1] = size
            elif run:
                found[-1] += size
            else:
                found += self.unknown, size
            run = number is None and not self.by_byte
        return struct.pack(f"<{len(found)}I", *found)

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of a text, and the source bytes ``[begin, end)`` that each of them stands for."""
        normal, source = self.normalize(text)
        if not self.by_word or self.space != SPACE:
            packed = self._packed(normal)
        elif normal.startswith(SPACE) and SPACE * 2 not in normal:
            packed = b"".join(map(self.spaced.__getitem__, normal[1:].split(SPACE)))
        else:
            packed = b"".join(map(self.plain.__getitem__, _WORDS.findall(normal)))
        table = np.frombuffer(packed, "<u4").reshape(-1, 2)
        if not self.by_byte and len(table):
            table = self._fused(table)
        ends = np.cumsum(table[:, 1], dtype=np.int64)
        begins = ends - table[:, 1]
        return table[:, 0].astype(np.int32), source[begins], source[ends]

    def _fused(self, table: np.ndarray) -> np.ndarray:
        """Neighbouring unknown pieces as one."""
        unknown = table[:, 0] == self.unknown
        starts = np.flatnonzero(~(unknown & np.r_[False, unknown[:-1]]))
        return np.column_stack([table[starts, 0], np.add.reduceat(table[:, 1], starts)]).astype(np.int64)

    def decode(self, ids: list[int]) -> str:
        """The text of ids. Bytes that are no UTF-8 become U+FFFD one by one."""
        first = 0
        if self.prefix or self.trims:
            while first < len(ids) and ids[first] in self.control:
                first += 1
        head = b""
        if (self.prefix or self.trims) and first < len(ids) and ids[first] not in self.byte_of:
            head = self.texts[ids[first]]
            if ids[first] != self.unknown and head.startswith(b" "):
                head = head[1:]
                first += 1
                # With blanks trimmed those of the next pieces go as well, until there is text.
                while self.trims and not head and first < len(ids) and ids[first] not in self.byte_of and ids[first] != self.unknown:
                    head = self.texts[ids[first]].removeprefix(b" ")
                    first += 1
            else:
                head = b""
        rest = ids[first:] if first else ids
        if self.control.isdisjoint(rest):
            try:
                return (head + b"".join(map(self.texts.__getitem__, rest))).decode()
            except UnicodeDecodeError:
                pass
        return head.decode() + self._repaired(rest)

    def _repaired(self, ids: list[int]) -> str:
        found, run = [], bytearray()

        def close() -> None:
            while run:
                for length in (1, 2, 3, 4):
                    try:
                        found.append(run[:length].decode())
                    except UnicodeDecodeError:
                        continue
                    del run[:length]
                    break
                else:
                    found.append("�")
                    del run[:1]

        for number in ids:
            if number in self.byte_of:
                run.append(self.byte_of[number])
            else:
                close()
                found.append(self.texts[number].decode())
        close()
        return "".join(found)


_loaded: dict[str, Pieces] = {}


def pieces_by(path: str) -> Pieces:
    """The worker's ``Pieces`` of the model at ``path``, which every executor has installed."""
    if path not in _loaded:
        _loaded[path] = Pieces(path)
    return _loaded[path]


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int32), *parts]).astype(np.int32)))


def encode_texts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, ids, begins, ends, decoded`` by the model at ``path``.

    A text is normalised by the longest key of the compiled character map at each place, which gives the source byte of
    each normalised one; merges run word by word, and the ends of pieces are carried back to bytes of the source text in
    UTF-8: piece k stands for the bytes from ``begins[k]`` up to ``ends[k]``. Of the bytes that spell an unknown character
    the last one stands for it. ``decoded`` is the text of the ids.

    NULL counts as empty; an empty text has no ids and decodes to ''. Rows that repeat an id are rows of their own, a
    NULL id stays NULL, no rows give no rows; other columns are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces_by(path)
        for batch in in_parts(batches, 200):
            ids, begins, ends, texts = [], [], [], []
            for text in batch.column(1):
                own = model.encode(text.as_py() or "")
                for all_, part in zip((ids, begins, ends), own):
                    all_.append(part)
                texts.append(model.decode(own[0].tolist()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), _lists(ids), _lists(begins), _lists(ends), pa.array(texts, pa.string())],
                names=["doc_id", "ids", "begins", "ends", "decoded"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>, begins array<int>, ends array<int>, decoded string")
