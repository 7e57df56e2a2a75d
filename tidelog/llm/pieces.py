"""SentencePiece BPE by prefix tables: every prefix of a text has one last token, and the ids are read off backwards."""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SPACE = "▁"
CACHED, CACHED_CHARS = 400_000, 40
SLICE_ROWS = 256
_coders: dict[str, PieceCoder] = {}


def public_pieces() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def coder_of(path: str) -> PieceCoder:
    """The coder of a model file, made once in each Python worker."""
    if path not in _coders:
        _coders[path] = PieceCoder(path)
    return _coders[path]


class Remembered(dict):
    """What a function gave for words of usual length: the last CACHED of them, and those used among the CACHED before."""

    def __init__(self, function: Callable[[str], object]):
        super().__init__()
        self.function, self.older = function, {}

    def __missing__(self, word: str) -> object:
        if word in self.older:
            found = self.older.pop(word)
        else:
            found = self.function(word)
            if len(word) > CACHED_CHARS:
                return found
        if len(self) >= CACHED:
            self.older = dict(self)
            self.clear()
        self[word] = found
        return found


class PieceCoder:
    """Ids and texts of a SentencePiece model of merge type.

    The model merges the best-scored pair of neighbouring symbols, leftmost first, until no pair is a piece. Merges never
    look past their pair, so a sequence of pieces is the model's own as soon as each two neighbours are: the two pieces
    alone, merged from their characters, come out as the same two. A prefix's last piece is therefore the one match
    that ends there and fits behind the last piece of the shorter prefix in front of it.

    No piece holds a space sign behind another character, so a text falls into parts that begin with their space signs and
    are encoded each by itself. A model for which that or the plain normalisation does not hold is refused.
    """

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as spec
        model = spec.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        kinds = spec.ModelProto.SentencePiece
        rule = model.normalizer_spec
        if (model.trainer_spec.model_type != spec.TrainerSpec.BPE or rule.precompiled_charsmap or not rule.add_dummy_prefix
                or rule.remove_extra_whitespaces or not rule.escape_whitespaces or model.trainer_spec.treat_whitespace_as_suffix
                or model.denormalizer_spec.precompiled_charsmap or not model.trainer_spec.byte_fallback
                or any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces)):
            raise ValueError(f"{path} is no merge model with byte fallback and plain normalisation")
        self.score = {p.piece: -p.score for p in model.pieces if p.type == kinds.NORMAL}
        self.id = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kinds.NORMAL}
        if any(re.search(f"[^{SPACE}]{SPACE}", piece) for piece in self.id):
            raise ValueError(f"{path} has pieces that cross a word's begin")
        self.byte_id = {int(p.piece[1:-1], 16): i for i, p in enumerate(model.pieces) if p.type == kinds.BYTE}
        self.begin, self.end = (next(i for i, p in enumerate(model.pieces) if p.piece == mark) for mark in ("<s>", "</s>"))
        plain = {kinds.NORMAL: lambda p: p.piece.replace(SPACE, " ").encode(), kinds.BYTE: lambda p: bytes([int(p.piece[1:-1], 16)]),
                 kinds.CONTROL: lambda p: b"", kinds.UNKNOWN: lambda p: model.trainer_spec.unk_surface.encode()}
        self.bytes = [plain[p.type](p) for p in model.pieces]
        self._normal = np.array([p.type == kinds.NORMAL for p in model.pieces])
        self._byte = np.array([p.type == kinds.BYTE for p in model.pieces])
        self._fit: dict[tuple[str, str], bool] = {}
        self._tail: dict[str, np.ndarray] = {}
        import ahocorasick
        self.matches = ahocorasick.Automaton()
        for piece in self.id:
            if len(piece) > 1 and self.merged(piece) == [piece]:  # others can never come out
                self.matches.add_word(piece, piece)
        self.matches.make_automaton()
        self.parts = Remembered(lambda word: array("I", self.part_ids(SPACE + word)).tobytes())

    def merged(self, text: str) -> list[str]:
        """The symbols left when merging a short text by the model's own rule."""
        symbols = list(text)
        while True:
            best, at = None, -1
            for i in range(len(symbols) - 1):
                score = self.score.get(symbols[i] + symbols[i + 1])
                if score is not None and (best is None or score < best):
                    best, at = score, i
            if best is None:
                return symbols
            symbols[at: at + 2] = [symbols[at] + symbols[at + 1]]

    def fits(self, left: str, right: str) -> bool:
        """Whether right may follow left: merged together they stay apart."""
        if len(self._fit) >= 3 * CACHED:
            self._fit.clear()
        known = self._fit[left, right] = self.merged(left + right) == [left, right]
        return known

    def last_pieces(self, part: str) -> list[str]:
        """By length of the prefix: its last piece. That is its last character where no longer match fits."""
        last, known = ["", *part], self._fit.get
        for at, piece in self.matches.iter(part):
            if len(last[at + 1]) == 1:
                start = at + 1 - len(piece)
                if start:
                    fit = known((last[start], piece))
                    if fit is None:
                        fit = self.fits(last[start], piece)
                    if not fit:
                        continue
                last[at + 1] = piece
        return last

    def part_ids(self, part: str) -> list[int]:
        """The ids of a part, by its prefix table read backwards."""
        last, end, known, out = self.last_pieces(part), len(part), self.id, []
        while end:
            piece = last[end]
            if piece in known:
                out.append(known[piece])
            else:
                out.extend(self.byte_id[b] for b in reversed(piece.encode()))
            end -= len(piece)
        out.reverse()
        return out

    def words(self, text: str) -> list[str]:
        """The parts of a text, each without one leading space sign; the model's own leading sign is the first one's."""
        text = text.replace(" ", SPACE)
        if not text.startswith(SPACE) and SPACE * 2 not in text and not text.endswith(SPACE):
            return text.split(SPACE)
        return [part[1:] for part in re.findall(f"{SPACE}+[^{SPACE}]*", SPACE + text)]

    def encode(self, text: str) -> bytes:
        """The ids of a text without begin and end, as little-endian 32-bit numbers."""
        if not text:
            return b""
        parts = self.parts
        return b"".join([parts[word] for word in self.words(text)])

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: signs become spaces, runs of bytes become characters, and the first piece loses one space."""
        ids = np.asarray(ids, dtype=np.int64)
        table = self.bytes
        mute = np.flatnonzero(~(self._normal[ids] | self._byte[ids] | (ids == 0)))
        inner = mute[(mute > 0) & (mute < len(ids) - 1)]
        if len(inner):  # a control id ends a run of bytes; only the first part that shows something loses a space
            out = ""
            for part in np.split(ids, inner):
                out += self.decode(part) if not out else self._shown(part, 0)
            return out
        first = ids[int(len(mute) and mute[0] == 0):][:1]
        return self._shown(ids, int(len(first) and self._normal[first[0]] and table[first[0]].startswith(b" ")))

    def _shown(self, ids: np.ndarray, skip: int) -> str:
        raw = b"".join([*map(self.bytes.__getitem__, ids.tolist())])[skip:]
        try:
            return raw.decode()
        except UnicodeDecodeError:  # only for ids that no text gives: each byte outside a character becomes U+FFFD
            return re.sub("[\udc80-\udcff]", "�", raw.decode("utf-8", "surrogateescape"))


def encode_decode(documents: DataFrame, model: str) -> DataFrame:
    """(doc_id, ids, decoded) of every row of documents (doc_id, text).

    ids is the binary of little-endian 32-bit ids with the model's begin and end; decoded is the text that these ids
    decode to. Null and empty texts are begin and end alone and decode to the empty text. Null and repeated ids and
    repeated rows are encoded row by row, long texts whole; there are no ties, as each prefix has one last piece; an
    empty table gives no rows; further columns, whatever their names, are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(model)
        begin, end = (np.array([i], dtype="<u4").tobytes() for i in (coder.begin, coder.end))
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                ids = [begin + coder.encode(text or "") + end for text in part.column("text").to_pylist()]
                texts = [coder.decode(np.frombuffer(x, "<u4")) for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(ids, pa.binary()), pa.array(texts, pa.string())], ["doc_id", "ids", "decoded"])

    kept = documents.select("doc_id", "text")
    return kept.mapInArrow(run, f"doc_id {kept.schema['doc_id'].dataType.simpleString()}, ids binary, decoded string")
