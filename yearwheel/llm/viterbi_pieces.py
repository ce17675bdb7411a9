"""SentencePiece vocabulary in batched numpy: segmentation by merges or by Viterbi, and exact decoding.

A text is cut at spaces into units ("▁word", runs of ▁ in front); no piece crosses a unit. Distinct
units of equal length advance together: hashes of all their substrings up to the longest piece probe
the sorted keys of the pieces of that length. A character without a piece becomes its UTF-8 bytes.

The ids are the model's own. A BPE model, whose scores are merge ranks, joins in each step the two
neighbours that make the piece of the best rank, the first of equal ones; a step does this for all units of
the batch, and units of more than ``STEPPED`` characters are merged from a heap instead. With a unigram
model the sum of piece scores is maximised: at each position the maximum over the pieces that end there is
stored with its backpointer, ties going to the longer last piece.

Defined cases: null and empty texts have no ids; a literal ▁ becomes bytes, so that decoding gives back
every text exactly (SentencePiece would take it for a space); a unit of any length is handled whole.
"""

from __future__ import annotations

import re
import zlib
from functools import partial
from hashlib import sha256
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from yearwheel.llm.distinct import DistinctEncoder, slices

SPACE = 0x2581  # ▁
LITERAL = 0x110000  # stands for a ▁ of the text; no code point
_BASE = np.uint64(0x9E3779B97F4A7C15)
# what each piece costs besides the logarithm of its rank, where a model has ranks instead of scores
PIECE_COST = 8.0
_UNIT = re.compile(r"\n| *[^ \n]+| +")
CELLS = 200_000  # positions of one batch
STEPPED = 4000  # longest unit whose merges go in steps over arrays


def _mixed(codes: np.ndarray) -> np.ndarray:
    x = codes.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _prefix_hashes(codes: np.ndarray) -> np.ndarray:
    """Polynomial hash of every prefix of every row."""
    out = np.zeros((codes.shape[0], codes.shape[1] + 1), np.uint64)
    mixed = _mixed(codes)
    for k in range(codes.shape[1]):
        out[:, k + 1] = out[:, k] * _BASE + mixed[:, k]
    return out


class PieceModel:
    """Pieces of a model file, ready for batched encoding and for decoding.

    With ``viterbi`` a BPE model is segmented like a unigram model, its pieces costing PIECE_COST + ln(rank);
    these ids are not the model's own.
    """

    def __init__(self, path: str, viterbi: bool = False):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        n = model.vocab_size()
        special = np.array([model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(n)])
        byte = np.array([model.is_byte(i) for i in range(n)])
        texts = [model.id_to_piece(i) for i in range(n)]
        self.byte_ids = {int(texts[i][1:-1], 16): i for i in np.flatnonzero(byte)}
        if len(self.byte_ids) != 256:
            raise ValueError("the vocabulary has to hold all byte pieces")
        normal = [i for i in range(n) if not special[i] and not byte[i]]
        if any("\n" in texts[i] or "▁" in texts[i].lstrip("▁") for i in normal):
            raise ValueError("a piece crosses the end of a unit")
        given = np.array([model.get_score(i) for i in normal])
        ranked = bool((np.diff(given[given > -1e8]) <= 0).all() and given.min() < -1000)
        self.by_merges = ranked and not viterbi
        scores = -PIECE_COST - np.log(np.arange(len(normal)) + 2.0) if ranked else given
        self.fallback = float(scores.min()) - 10.0
        self.most = max(len(texts[i]) for i in normal)
        self.keys, self.ids, self.scores = [None], [None], [None]
        for size in range(1, self.most + 1):
            own = [k for k, i in enumerate(normal) if len(texts[i]) == size]
            codes = np.array([[ord(c) for c in texts[normal[k]]] for k in own], np.int64).reshape(-1, size)
            keys = _prefix_hashes(codes)[:, -1]
            order = np.argsort(keys)
            if (np.diff(keys[order]) == 0).any():
                raise ValueError("two pieces have the same key")
            self.keys.append(keys[order])
            self.ids.append(np.array([normal[k] for k in own], np.int64)[order])
            self.scores.append((given if self.by_merges else scores)[own][order])
        self.score_of = {texts[i]: (float(s), i) for i, s in zip(normal, scores, strict=True)}
        self.rank_of = {texts[i]: (-float(s), i) for i, s in zip(normal, given, strict=True)}
        self.bytes_of = [t.replace("▁", " ").encode() for t in texts]
        for value, i in self.byte_ids.items():
            self.bytes_of[i] = bytes([value])

    # ------------------------------------------------------------------ units

    @staticmethod
    def units(text: str) -> list[str]:
        return _UNIT.findall(" " + text)

    def encode_units(self, units: list[str]) -> list[list[int]]:
        """Ids of each unit."""
        out: list = [None] * len(units)
        by_length: dict[int, list[int]] = {}
        for k, unit in enumerate(units):
            by_length.setdefault(len(unit), []).append(k)
        for length, all_of in by_length.items():
            if self.by_merges and length > STEPPED:
                for k in all_of:
                    out[k] = self.encode_slowly(units[k])
                continue
            step = max(1, CELLS // length)
            for begin in range(0, len(all_of), step):
                rows = all_of[begin : begin + step]
                codes = np.frombuffer("".join(units[k] for k in rows).encode("utf-32-le"), "<u4").astype(np.int64)
                codes = np.where(codes == SPACE, LITERAL, np.where(codes == 32, SPACE, codes)).reshape(-1, length)
                for k, ids in zip(rows, self._merged(codes) if self.by_merges else self._viterbi(codes), strict=True):
                    # substring hashes may meet by chance: what was found has to spell the unit
                    out[k] = ids if self.joined(ids) == units[k].encode() else self.encode_slowly(units[k])
        return out

    def _found(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores and ids of pieces by end position and piece length; the last column is the longest piece."""
        n, length = codes.shape
        most = min(self.most, length)
        hashes = _prefix_hashes(codes)
        score = np.full((n, length + 1, most), -np.inf)
        piece = np.full((n, length + 1, most), -1, np.int32)
        power = np.uint64(1)
        for size in range(1, most + 1):
            power = np.multiply([power], _BASE)[0]
            keys = self.keys[size]
            if not len(keys):
                continue
            wanted = hashes[:, size:] - hashes[:, :-size] * power
            at = np.minimum(np.searchsorted(keys, wanted.ravel()), len(keys) - 1)
            hit = (keys[at] == wanted.ravel()).reshape(wanted.shape)
            at = at.reshape(wanted.shape)
            score[:, size:, size - 1] = np.where(hit, self.scores[size][at], -np.inf)
            piece[:, size:, size - 1] = np.where(hit, self.ids[size][at], -1)
        return score, piece

    def _merged(self, codes: np.ndarray) -> list[list[int]]:
        n, length = codes.shape
        score, piece = self._found(codes)
        most = score.shape[2]
        # symbols by their first position: size, the symbol before, and the score of joining it with the next
        size, first = np.ones((n, length), np.int64), np.ones((n, length), bool)
        before = np.tile(np.arange(-1, length - 1), (n, 1))
        pair = np.full((n, length), -np.inf)
        if most > 1:
            pair[:, :-1] = score[:, 2:, 1]

        def joined(rows, begin, end):
            return np.where(end - begin <= most, score[rows, end, np.minimum(end - begin, most) - 1], -np.inf)

        live = np.arange(n)
        while True:
            left = (pair if len(live) == n else pair[live]).argmax(1)
            some = pair[live, left] > -np.inf
            live, left = live[some], left[some]
            if not len(live):
                break
            right = left + size[live, left]
            end = right + size[live, right]
            size[live, left] = end - left
            first[live, right] = False
            pair[live, right] = pair[live, left] = -np.inf
            more = end < length
            rows, begin, stop = live[more], left[more], end[more]
            before[rows, stop] = begin
            pair[rows, begin] = joined(rows, begin, stop + size[rows, stop])
            more = left > 0
            rows, begin = live[more], before[live, left][more]
            pair[rows, begin] = joined(rows, begin, end[more])
        out: list[list[int]] = [[] for _ in range(n)]
        rows, begin = np.nonzero(first)
        sizes = size[rows, begin]
        ids = piece[rows, begin + sizes, sizes - 1]
        for row, one, at in zip(rows.tolist(), ids.tolist(), begin.tolist(), strict=True):
            if one >= 0:
                out[row].append(one)
            else:
                out[row] += self._bytes(int(codes[row, at]))
        return out

    def _viterbi(self, codes: np.ndarray) -> list[list[int]]:
        n, length = codes.shape
        score, piece = self._found(codes)
        most = score.shape[2]
        lone = np.isneginf(score[:, 1:, 0])
        score[:, 1:, 0][lone] = self.fallback * (1 + (codes[lone] > 0x7F) + (codes[lone] > 0x7FF) + (codes[lone] > 0xFFFF))
        best = np.full((n, length + 1), -np.inf)
        best[:, 0] = 0
        back = np.zeros((n, length + 1), np.int32)
        rows = np.arange(n)
        for end in range(1, length + 1):
            own = min(end, most)
            # longest first, so that the first maximum is the longest piece
            paths = best[:, end - own : end] + score[:, end, :own][:, ::-1]
            choice = paths.argmax(1)
            best[:, end] = paths[rows, choice]
            back[:, end] = own - choice
        out: list[list[int]] = [[] for _ in range(n)]
        end = np.full(n, length)
        steps = []
        live = rows
        while len(live):
            size = back[live, end[live]]
            steps.append((live, piece[live, end[live], size - 1], end[live]))
            end[live] -= size
            live = live[end[live] > 0]
        for live, ids, ends in reversed(steps):
            for row, one, stop in zip(live.tolist(), ids.tolist(), ends.tolist(), strict=True):
                if one >= 0:
                    out[row].append(one)
                else:
                    out[row] += self._bytes(int(codes[row, stop - 1]))
        return out

    def _bytes(self, code: int) -> list[int]:
        return [self.byte_ids[b] for b in chr(SPACE if code == LITERAL else code).encode()]

    def encode_slowly(self, unit: str) -> list[int]:
        """The same segmentation, by looking every substring up as text."""
        codes = [LITERAL if ord(c) == SPACE else SPACE if c == " " else ord(c) for c in unit]
        text = "".join("\0" if c == LITERAL else chr(c) for c in codes)
        if self.by_merges:
            return self._merged_slowly(text, codes)
        best: list[tuple[float, int, list[int]]] = [(0.0, 0, [])]
        for end in range(1, len(text) + 1):
            found = None
            for size in range(min(end, self.most), 0, -1):
                known = self.score_of.get(text[end - size : end])
                if known:
                    score, ids = known[0], [known[1]]
                elif size == 1:
                    ids = self._bytes(codes[end - 1])
                    score = self.fallback * len(ids)
                else:
                    continue
                total = best[end - size][0] + score
                if found is None or total > found[0]:
                    found = (total, size, ids)
            best.append(found)
        out, end = [], len(text)
        while end:
            out.append(best[end][2])
            end -= best[end][1]
        return [i for ids in reversed(out) for i in ids]

    def _merged_slowly(self, text: str, codes: list[int]) -> list[int]:
        size, before = [1] * len(text), list(range(-1, len(text) - 1))  # size 0: joined with the symbol before

        def joined(left: int, right: int) -> list[tuple[float, int, int, int]]:
            known = self.rank_of.get(text[left : right + size[right]])
            return [(known[0], left, size[left], size[right])] if known else []

        heap = [entry for k in range(len(text) - 1) for entry in joined(k, k + 1)]
        heapify(heap)
        while heap:
            _, left, n, m = heappop(heap)
            right = left + n
            if size[left] != n or size[right] != m:
                continue
            size[left], size[right] = n + m, 0
            end = right + m
            if end < len(text):
                before[end] = left
                for entry in joined(left, end):
                    heappush(heap, entry)
            if left:
                for entry in joined(before[left], left):
                    heappush(heap, entry)
        out: list[int] = []
        for k in filter(size.__getitem__, range(len(text))):
            known = self.rank_of.get(text[k : k + size[k]])
            out += [known[1]] if known else self._bytes(codes[k])
        return out

    # ------------------------------------------------------------------ decoding

    def joined(self, ids: list[int]) -> bytes:
        table = self.bytes_of
        return b"".join([table[i] for i in ids])

    def decode(self, ids: list[int]) -> str:
        return self.joined(ids)[1:].decode()


_models: dict[str, tuple[PieceModel, DistinctEncoder]] = {}


def _loaded(path: str) -> tuple[PieceModel, DistinctEncoder]:
    """One model and encoder for all tasks of a worker process, which keeps the units it knows."""
    if path not in _models:
        pieces = PieceModel(path)
        _models[path] = pieces, DistinctEncoder(pieces.units, pieces.encode_units)
    return _models[path]


def encode_texts(docs: DataFrame, model: str, columns: list[str], text_chars: int = 4 << 20) -> DataFrame:
    """``columns`` of each row with piece_ids array<int>; ``text`` is encoded."""
    kept = docs.select(*columns, F.col("text").cast("string").alias("__text"))
    schema = kept.drop("__text").schema.add("piece_ids", ArrayType(IntegerType()))

    def run(batches):
        encoder = _loaded(model)[1]
        for batch in batches:
            texts = batch.column(len(columns)).to_pylist()
            for part in slices(texts, text_chars):
                ids, n = encoder(texts[part])
                ends = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                column = pa.ListArray.from_arrays(pa.array(ends), pa.array(ids.astype(np.int32)))
                rows = batch.slice(part.start, part.stop - part.start)
                yield pa.RecordBatch.from_arrays([*rows.columns[:-1], column], names=[*columns, "piece_ids"])

    return kept.mapInArrow(run, schema)


def _round_trip(batches, model: str, columns: list[str], text_chars: int):
    pieces, encoder = _loaded(model)
    bytes_first, bytes_last = min(pieces.byte_ids.values()), max(pieces.byte_ids.values())
    table = np.array(pieces.bytes_of, object)
    for batch in batches:
        texts = batch.column(len(columns)).to_pylist()
        for part in slices(texts, text_chars):
            ids, n = encoder(texts[part])
            ends = np.concatenate([[0], np.cumsum(n)])
            spelled = table[ids]
            raw = memoryview(ids.astype("<u4")).cast("B")
            is_byte = np.concatenate([[0], np.cumsum((ids >= bytes_first) & (ids <= bytes_last))])
            crc, sha, same = [], [], []
            for text, begin, end in zip(texts[part], ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                decoded = b"".join(spelled[begin:end].tolist())[1:]
                crc.append(zlib.crc32(raw[4 * begin : 4 * end]))
                sha.append(sha256(decoded).hexdigest())
                same.append(decoded == (text or "").encode())
            rows = batch.slice(part.start, part.stop - part.start)
            values = [
                pa.array(n, pa.int64()),
                pa.array(np.diff(is_byte[ends]), pa.int64()),
                pa.array(crc, pa.int64()),
                pa.array(sha, pa.string()),
                pa.array(same, pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays(
                [*rows.columns[:-1], *values], names=[*columns, "n_pieces", "n_byte_pieces", "ids_crc32", "decoded_sha256", "round_trip"]
            )


def encode_and_check(docs: DataFrame, model: str, columns: list[str], text_chars: int = 4 << 20) -> DataFrame:
    """``columns`` of each row with counts and digests of its ids, decoded again and compared with the text."""
    kept = docs.select(*columns, F.col("text").cast("string").alias("__text"))
    schema = kept.drop("__text").schema
    for name, kind in (("n_pieces", "long"), ("n_byte_pieces", "long"), ("ids_crc32", "long"), ("decoded_sha256", "string")):
        schema = schema.add(name, kind)
    schema = schema.add("round_trip", "boolean")
    return kept.mapInArrow(partial(_round_trip, model=model, columns=columns, text_chars=text_chars), schema)


def decode_ids(rows: DataFrame, model: str, columns: list[str]) -> DataFrame:
    """``columns`` of each row with the text that its piece_ids spell."""
    kept = rows.select(*columns, "piece_ids")

    def run(batches):
        pieces = _loaded(model)[0]
        for batch in batches:
            texts = [pieces.decode(ids or []) for ids in batch.column(len(columns)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], names=[*columns, "text"])

    return kept.mapInArrow(run, kept.drop("piece_ids").schema.add("text", "string"))
