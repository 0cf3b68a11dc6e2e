"""Encoding and decoding with a merge-type SentencePiece vocabulary, by a score-ordered agenda.

A text is normalised by the model's own rule and begins as a list of characters. All adjacent pairs whose
joined text is a piece stand on an agenda, best score first, of equal scores the leftmost first. The best pair is
merged, the pairs that it was part of are void, and the two new pairs beside it go onto the agenda, until it is
empty. A symbol that is no piece becomes its bytes, or the unknown piece where the vocabulary has no bytes.
Short segments run their agendas side by side in numpy, a merge in each of them per step; long ones have a heap.

Merges never cross a place that no piece crosses. Where no piece has a space mark after another character, a text
falls into segments (space marks, then other characters) that are encoded each by itself; equal segments
are encoded once per memory of a worker. Every segment that enters the memory is checked against the library in
one call per group of rows of an Arrow batch; a difference is an error, never a wrong row. Decoding goes from ids to
bytes by the vocabulary, and is checked likewise.

Each row is encoded where it is, without a shuffle, so no key, hot or not, brings rows together. A worker holds one
Arrow batch and the memory, of MEMORY characters at most beside those of one group of rows; a segment longer than LONGEST is
not kept.

Defined cases: a null or empty text has no pieces but the end id and decodes to ''. Repeated rows and
rows without an id stay, a row each. A vocabulary with unused pieces is refused; with user-defined ones the check
ends the query where they matter.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playmart.llm.common import MULTIPLIER, doc_texts

SPACE = "▁"
MEMORY = 1 << 22  # characters of segments remembered by a worker, in two halves
LONGEST = 256  # characters of a segment that is remembered
SHORT = 32  # characters of a segment whose agenda runs in numpy
WIDTHS = (4, 8, 12, 16, 24, SHORT)  # segments up to each width run together
NONE = np.iinfo(np.int32).max  # rank of two symbols that make no piece
ROWS = 512  # texts handled at a time within an Arrow batch

OUT = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def _each_byte(error: UnicodeError) -> tuple[str, int]:
    return "�" * (error.end - error.start), error.end


codecs.register_error("replace-each-byte", _each_byte)


class Vocabulary:
    """The pieces of a model with their scores, and the library's processor to check against."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(self.library.vocab_size())
        special = [i for i in ids if self.library.is_control(i) or self.library.is_unknown(i)]
        if any(self.library.is_unused(i) for i in ids):
            raise ValueError(f"{path}: vocabularies with unused pieces are not covered")
        self.byte_ids = [i for i in ids if self.library.is_byte(i)]
        skipped = {*special, *self.byte_ids}
        pieces = {i: self.library.id_to_piece(i) for i in ids}
        self.id_of = {p: i for i, p in pieces.items() if i not in skipped}
        self.score = {p: self.library.get_score(i) for p, i in self.id_of.items()}
        self.unknown = self.library.unk_id()
        self.end = self.library.eos_id()
        # A place before a space mark that no piece crosses divides a text.
        self.divided = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.id_of)
        self.segments = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+" if self.divided else r"(?s).+").findall

        controls = {i for i in special if i != self.unknown}
        of_byte = {i: bytes([int(pieces[i][1:-1], 16)]) for i in self.byte_ids}
        self.controls = controls
        self.text_of = {
            i: b"" if i in controls else " ⁇ ".encode() if i == self.unknown else of_byte.get(i) or pieces[i].replace(SPACE, " ").encode()
            for i in ids
        }
        self.byte_set = frozenset(self.byte_ids)
        # The text of a piece that stands for itself; None for bytes, controls and the unknown piece.
        whole = self.controls | self.byte_set | {self.unknown}
        self.plain = [None if i in whole else self.text_of[i].decode() for i in ids]
        # All ways to make a piece of two symbols, with the symbol they give and the rank of its score (the best is 0).
        symbols = dict.fromkeys([*self.id_of, *(c for p in self.id_of for c in p)])
        self.symbol_of = {p: k for k, p in enumerate(symbols)}
        self.n_symbols = len(symbols) + 1  # one more for characters that no piece has
        self.name_of = [str(i) for i in ids]
        self.symbol_of_point = np.full(0x110000, self.n_symbols - 1, np.int32)
        for p, k in self.symbol_of.items():
            if len(p) == 1:
                self.symbol_of_point[ord(p)] = k
        self.piece_lengths = [len(pieces[i]) for i in ids]
        self.piece_of_symbol = np.array([*(self.id_of.get(p, -1) for p in symbols), -1])
        made = [
            (self.symbol_of[p[:k]] * self.n_symbols + self.symbol_of[p[k:]], self.symbol_of[p], -self.score[p])
            for p in self.id_of for k in range(1, len(p)) if p[:k] in symbols and p[k:] in symbols
        ]
        self.pair_keys = np.array([m[0] for m in made], np.int64)
        # One more, which stands for no pair.
        self.pair_symbols = np.array([*(m[1] for m in made), self.n_symbols - 1], np.int32)
        ranks = np.unique(np.array([m[2] for m in made], np.float64), return_inverse=True)[1]
        self.pair_ranks = np.append(ranks, NONE).astype(np.int32)
        self._hash_pairs()
        # Whether a decoded text loses the space of its first piece.
        self.drops_space = self.library.encode("a", out_type=str)[0].startswith(SPACE)

    def agenda(self, segment: str) -> list[int]:
        """Ids of a normalised segment."""
        symbols: list[str | None] = list(segment)
        n = len(symbols)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        agenda: list[tuple[float, int, str]] = []
        score = self.score

        def offer(left: int, right: int) -> None:
            joined = symbols[left] + symbols[right]
            found = score.get(joined)
            if found is not None:
                heapq.heappush(agenda, (-found, left, joined))

        for k in range(n - 1):
            offer(k, k + 1)
        while agenda:
            _, left, joined = heapq.heappop(agenda)
            right = after[left] if symbols[left] is not None else -1
            # Void if one of the two has been merged since.
            if right < 0 or len(symbols[left]) + len(symbols[right]) != len(joined):
                continue
            symbols[left], symbols[right] = joined, None
            after[left] = after[right]
            if after[left] >= 0:
                before[after[left]] = left
                offer(left, after[left])
            if before[left] >= 0:
                offer(before[left], left)
        ids: list[int] = []
        for symbol in symbols:
            if symbol is None:
                continue
            found = self.id_of.get(symbol)
            if found is not None:
                ids.append(found)
            elif self.byte_ids:
                ids += [self.byte_ids[b] for b in symbol.encode()]
            elif not ids or ids[-1] != self.unknown:  # unknown neighbours are one
                ids.append(self.unknown)
        return ids

    def _slots(self, key: np.ndarray) -> np.ndarray:
        return ((key.view(np.uint64) * np.uint64(MULTIPLIER)) >> np.uint64(64 - self.slot_bits)).view(np.int64)

    def _hash_pairs(self) -> None:
        """Lay the pairs out by a hash of their key; of those that meet in a slot all but one move on to the next."""
        self.slot_bits = max(4, (8 * len(self.pair_keys)).bit_length())
        self.slot_keys = np.full(1 << self.slot_bits, -1, np.int64)
        self.slot_pairs = np.full(1 << self.slot_bits, len(self.pair_keys), np.int32)
        left, at = np.arange(len(self.pair_keys)), self._slots(self.pair_keys)
        while len(left):
            free = np.flatnonzero(self.slot_keys[at] < 0)
            taken, first = np.unique(at[free], return_index=True)
            placed = free[first]
            self.slot_keys[taken], self.slot_pairs[taken] = self.pair_keys[left[placed]], left[placed]
            rest = np.ones(len(left), bool)
            rest[placed] = False
            left, at = left[rest], (at[rest] + 1) & (len(self.slot_keys) - 1)

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Numbers of pairs of symbols, the number of all pairs for those that make no piece."""
        key = left.astype(np.int64) * self.n_symbols + right
        at = self._slots(key)
        there = self.slot_keys[at]
        out = self.slot_pairs[at]
        other = np.flatnonzero(there != key)
        out[other] = len(self.pair_keys)
        other = other[there[other] >= 0]  # in an empty slot the search ends
        while len(other):
            at[other] = (at[other] + 1) & (len(self.slot_keys) - 1)
            there = self.slot_keys[at[other]]
            same = there == key[other]
            out[other[same]] = self.slot_pairs[at[other[same]]]
            other = other[~same & (there >= 0)]
        return out

    def agendas(self, segments: list[str]) -> list[list[int]]:
        """Ids of many normalised segments."""
        out: list[list[int]] = [[]] * len(segments)
        lengths = np.fromiter(map(len, segments), np.int64, len(segments))
        short = SHORT if len(self.pair_keys) else 0
        for k in np.flatnonzero(lengths > short).tolist():
            out[k] = self.agenda(segments[k])
        for least, width in zip((0, *WIDTHS), WIDTHS) if short else ():
            rows = np.flatnonzero((lengths > least) & (lengths <= width))
            if not len(rows):
                continue
            symbols = np.full((len(rows), width + 1), self.n_symbols - 1, np.int32)
            left = lengths[rows]
            texts = [segments[k] for k in rows.tolist()]
            points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
            symbols[np.arange(width + 1) < left[:, None]] = self.symbol_of_point[points]
            self._merge(symbols, left)
            pieces = self.piece_of_symbol[symbols[np.arange(width + 1) < left[:, None]]]
            ends = np.cumsum(left)
            lost = np.zeros(len(rows), bool)
            lost[np.searchsorted(ends, np.flatnonzero(pieces < 0), "right")] = True
            flat, begin = pieces.tolist(), 0
            for k, segment, end, odd in zip(rows.tolist(), texts, ends.tolist(), lost.tolist()):
                out[k] = self._with_bytes(segment, flat[begin:end]) if odd else flat[begin:end]
                begin = end
        return out

    def _with_bytes(self, segment: str, pieces: list[int]) -> list[int]:
        """Ids of a segment some of whose characters are no pieces (-1)."""
        ids: list[int] = []
        at = 0
        for piece in pieces:
            if piece >= 0:
                ids.append(piece)
                at += self.piece_lengths[piece]
                continue
            if self.byte_ids:
                ids += [self.byte_ids[b] for b in segment[at].encode()]
            elif not ids or ids[-1] != self.unknown:
                ids.append(self.unknown)
            at += 1
        return ids

    def _merge(self, symbols: np.ndarray, lengths: np.ndarray) -> None:
        """Run the agenda of every row to its end; rows are filled up with symbols that make no pair.

        symbols and lengths are changed in place. All rows still open have had the same number of merges, so a
        column less is looked at after each; what stands behind the length of a row means nothing.
        """
        ranks = np.full(symbols.shape, NONE, np.int32)  # of each symbol with the next
        at = np.flatnonzero(np.arange(symbols.shape[1]) < lengths[:, None] - 1)
        ranks.ravel()[at] = self.pair_ranks[self._pairs(symbols.ravel()[at], symbols.ravel()[at + 1])]
        rows, open_rows = np.arange(len(symbols)), symbols.copy()
        while len(rows):
            best = ranks.argmin(axis=1)  # of equal ranks the leftmost
            going = ranks[np.arange(len(rows)), best] < NONE
            if not going.all():
                symbols[rows[~going], : open_rows.shape[1]] = open_rows[~going]
                rows, open_rows, ranks, best = rows[going], open_rows[going], ranks[going], best[going]
                if not len(rows):
                    break
            here = np.arange(len(rows))
            merged = self.pair_symbols[self._pairs(open_rows[here, best], open_rows[here, best + 1])]
            # What stands behind the pair moves one place to the left.
            behind = np.arange(open_rows.shape[1] - 1) > best[:, None]
            open_rows = np.where(behind, open_rows[:, 1:], open_rows[:, :-1])
            ranks = np.where(behind, ranks[:, 1:], ranks[:, :-1])
            open_rows[here, best] = merged
            ranks[here, best] = self.pair_ranks[self._pairs(merged, open_rows[here, best + 1])]
            inner = np.flatnonzero(best > 0)
            before = best[inner] - 1
            ranks[inner, before] = self.pair_ranks[self._pairs(open_rows[inner, before], merged[inner])]
            lengths[rows] -= 1

    def text(self, ids: list[int]) -> str:
        """The text that ids stand for. Bytes that are no UTF-8 become one replacement character each."""
        parts: list[str] = []
        run = bytearray()
        first = True
        for i in ids:
            if i in self.byte_set:
                run += self.text_of[i]
                first = False
                continue
            if run:
                parts.append(run.decode("utf-8", "replace-each-byte"))
                run.clear()
            if i in self.controls:
                continue
            piece = self.text_of[i].decode()
            if first and self.drops_space and i != self.unknown:
                piece = piece.removeprefix(" ")
            first = False
            parts.append(piece)
        parts.append(run.decode("utf-8", "replace-each-byte"))
        return "".join(parts)

    def inner(self, ids: list[int]) -> str:
        """The text of ids that follow others, so that no space is dropped."""
        try:
            return "".join([self.plain[i] for i in ids])
        except TypeError:  # bytes, controls or unknown pieces
            # Every other piece is whole characters, so bytes never run together with what stands beside them.
            return b"".join([self.text_of[i] for i in ids]).decode("utf-8", "replace-each-byte")

    def checked(self, segments: list[str]) -> tuple[list[list[int]], list[str]]:
        """Ids and texts of normalised segments, after the library has given the same for all of them."""
        if not segments:
            return [], []
        found = self.agendas(segments)
        # The library puts one space mark before a text, which these begin with.
        bare = [s.removeprefix(SPACE) if self.drops_space else s for s in segments]
        expected = self.library.encode(bare, num_threads=1)
        if found != expected:
            for segment, ids, other in zip(segments, found, expected, strict=True):
                if ids != other and not (self.drops_space and segment == SPACE):
                    raise ValueError(f"pieces of {segment[:80]!r} differ from the library's: {ids[:20]}, {other[:20]}")
        texts = [self.inner(ids) for ids in found]
        # All of them are decoded as one text, which loses one space.
        whole = "".join(texts)
        whole = whole.removeprefix(" ") if self.drops_space else whole
        if whole != self.library.decode([i for ids in found for i in ids]):
            raise ValueError(f"texts of {len(found)} segments differ from the library's, the first being {segments[0][:80]!r}")
        return found, texts


_loaded: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a file, read once per worker."""
    if path not in _loaded:
        _loaded[path] = Vocabulary(path)
    return _loaded[path]


class Memory:
    """Segment -> (count of ids, ids as text, text decoded where it is not the first).

    When one half of the memory is full it becomes the older half, whose segments come back as they are met again.
    """

    def __init__(self, words: Vocabulary, characters: int = MEMORY, longest: int = LONGEST) -> None:
        self.words, self.characters, self.longest = words, characters, longest
        self.kept: dict[str, tuple[int, str, str]] = {}
        self.older: dict[str, tuple[int, str, str]] = {}
        self.passing: list[str] = []
        self.size = 0

    def of(self, segments: set[str]) -> dict[str, tuple[int, str, str]]:
        """What is known of the segments, new ones encoded and checked; it holds until the next call."""
        for segment in self.passing:
            del self.kept[segment]
        self.passing = []
        if self.size > self.characters // 2:
            self.older, self.kept, self.size = self.kept, {}, 0
        missing = segments - self.kept.keys()
        back = missing & self.older.keys()
        for segment in back:
            self.kept[segment] = self.older[segment]
        self.size += sum(map(len, back))
        new = list(missing - back)
        names = self.words.name_of
        for segment, ids, text in zip(new, *self.words.checked(new), strict=True):
            self.kept[segment] = len(ids), " ".join([names[i] for i in ids]), text
            if len(segment) > self.longest:
                self.passing.append(segment)
            else:
                self.size += len(segment)
        return self.kept


_memories: dict[tuple[str, int, int], Memory] = {}


def memory(path: str, characters: int = MEMORY, longest: int = LONGEST) -> Memory:
    """The memory of a worker, which lasts from task to task."""
    key = path, characters, longest
    if key not in _memories:
        _memories[key] = Memory(vocabulary(path), characters, longest)
    return _memories[key]


def _encoder(path: str, characters: int, longest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, known_segments = vocabulary(path), memory(path, characters, longest)
        end = str(words.end)
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                rows = batch.slice(first, ROWS)
                texts = [words.segments(words.library.normalize(t)) for t in rows.column(1).to_pylist()]
                known = known_segments.of(set().union(*texts))
                counts, encoded, decoded = [], [], []
                for segments in texts:
                    entries = [known[s] for s in segments]
                    counts.append(1 + sum([e[0] for e in entries]))
                    ids = " ".join([*[e[1] for e in entries], end])
                    text = "".join([e[2] for e in entries])
                    if words.drops_space and entries:
                        text = text.removeprefix(" ")
                    encoded.append(hashlib.sha256(ids.encode()).hexdigest())
                    decoded.append(hashlib.sha256(text.encode()).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(counts, pa.int64()), pa.array(encoded, pa.string()), pa.array(decoded, pa.string())],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return run


def encode_documents(docs: DataFrame, path: str, characters: int = MEMORY, longest: int = LONGEST) -> DataFrame:
    """Per row: doc_id, the number of ids with the end id, and digests of the ids and of the text decoded from them."""
    return doc_texts(docs).mapInArrow(_encoder(path, characters, longest), OUT)


def _pieces(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, known_segments = vocabulary(path), memory(path)
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                rows = batch.slice(first, ROWS)
                texts = [words.segments(words.library.normalize(t)) for t in rows.column(1).to_pylist()]
                known = known_segments.of(set().union(*texts))
                ids = [[int(i) for s in segments for i in known[s][1].split()] + [words.end] for segments in texts]
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return run


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ids of every row, with the end id."""
    return doc_texts(docs).mapInArrow(_pieces(path), "doc_id bigint, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and text of rows with doc_id and ids; null ids give ''."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in batches:
            texts = [words.text(ids) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    rows = encoded.select(F.col("doc_id").cast("bigint"), F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    return rows.mapInArrow(run, "doc_id bigint, text string")
