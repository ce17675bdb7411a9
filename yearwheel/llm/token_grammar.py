"""Token ids in grammar-compressed files: Re-Pair per shard, random access by expansion lengths.

``write_tokens`` encodes whole texts, appends an end id to each document and writes blocks of
documents in ascending order of (doc_id, hash of the text). A block is compressed by Re-Pair in
rounds, at most eight: in each round the pairs that occur most often become nonterminals at once, overlaps
going to the more frequent pair, until a round no longer pays. No pair takes in an end id, so a document
begins with a symbol of its own. A block holds its rules, the number of ids each expands to, the
symbols and the documents' ids and symbol counts; ``read_tokens`` decodes whole blocks and
``Block.ids_of`` one document alone.

Defined cases: a null text is an empty one (the end id alone), null doc_ids come first, rows with the
same doc_id follow each other in the order of their texts' hashes, and an empty table writes no file.
"""

from __future__ import annotations

import os
import string
import struct
import zlib
from array import array
from itertools import accumulate, chain
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from yearwheel.llm import files
from yearwheel.llm.distinct import gathered, runs

MAGIC = b"RPAIR001"
HEADER = struct.Struct("<8sIIIIQ")  # magic, first nonterminal, documents, rules, width, symbols
INDEX = "part int, block int, file string, offset long, length long, n_docs long, n_ids long"


# signs that end a word without joining it; an apostrophe may begin a contraction
_SIGNS = "".join(c for c in string.punctuation if c != "'")
_AFTER_LATIN = "\u0250"


def _byte_letters() -> dict[int, int]:
    """Letters by which byte-level models spell bytes: printable ones stand for themselves."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or (b >= 0xA1 and b != 0xAD)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: b for b in plain} | {b: 256 + k for k, b in enumerate(others)}


# the letter of each byte; a line feed stays one, as words joined by it are spelled together
_SPELLING = np.array([c for _, c in sorted((_byte_letters() | {ord("\n"): ord("\n")}).items())], "<u2")
_ID = attrgetter("id")


class WordEncoder:
    """Tokenizer ids of many texts; Arrow numbers the distinct words of a batch, each of which is encoded once.

    Holds for tokenizers that drop white space, fold case and separate letters from signs, so that a
    word of letters with signs after it is the letters' ids and then the signs'. Latin letters go to the
    tokenizer's model directly, lower-cased and spelled in bytes as its normalizer would; that this gives
    the same ids is checked for every such letter at the start. All else takes the whole path.

    Parts of words are remembered until there are ``most`` of them, and those used since then for as long
    again. Their ids are kept as bytes, which Python's garbage collector need not visit.
    """

    def __init__(self, path: str, most: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.most = self.tokenizer.model, most
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.parts: dict[str, bytes] = {"": b""}
        self.older = self.parts
        letters = [c for c in map(chr, range(ord(_AFTER_LATIN))) if c.isalpha()]
        words = [f"x{c}y" for c in letters]
        self.direct = frozenset(c for c, own, ids in zip(letters, self._of_letters(words), self._whole(words), strict=True) if own == ids)
        self.plain = self.direct.issuperset(string.ascii_letters)

    def _of_letters(self, cores: list[str], most: int = 256) -> list[bytes]:
        """Ids of words of letters, which hold no line feed; ``most`` words at a time."""
        out: list[bytes] = []
        for begin in range(0, len(cores), most):
            spelled = "\n".join(cores[begin : begin + most]).lower()
            if not spelled.isascii():
                spelled = _SPELLING[np.frombuffer(spelled.encode(), np.uint8)].tobytes().decode("utf-16-le")
            tokens = list(map(self.model.tokenize, spelled.split("\n")))
            ids = array("I", map(_ID, chain.from_iterable(tokens))).tobytes()
            ends = [4 * n for n in accumulate(map(len, tokens), initial=0)]
            out += [ids[a:b] for a, b in zip(ends, ends[1:], strict=False)]
        return out

    def _whole(self, words: list[str]) -> list[bytes]:
        coded = self.tokenizer.encode(words, is_pretokenized=True, add_special_tokens=False)
        bounds = np.searchsorted(np.array(coded.word_ids, np.int64), np.arange(len(words) + 1)).tolist()
        ids = coded.ids
        return [array("I", ids[begin:end]).tobytes() for begin, end in zip(bounds, bounds[1:], strict=False)]

    def _ids(self, wanted: list[str]) -> list[bytes]:
        """Ids of each part, letters or signs."""
        if len(self.parts) > self.most:
            self.parts, self.older = {"": b""}, self.parts
        parts, older, plain, direct = self.parts, self.older, self.plain, self.direct.issuperset
        found = list(map(parts.get, wanted))
        letters: list[int] = []
        whole: list[int] = []
        for k in [k for k, ids in enumerate(found) if ids is None]:
            part = wanted[k]
            ids = older.get(part)
            if ids is not None:
                parts[part] = found[k] = ids
            elif (plain and part.isascii() and part.isalpha()) or direct(part):
                letters.append(k)
            else:
                whole.append(k)
        for new, encode in (letters, self._of_letters), (whole, self._whole):
            if new:
                for k, ids in zip(new, encode([wanted[k] for k in new]), strict=True):
                    parts[wanted[k]] = found[k] = ids
        return found

    def __call__(self, texts: pa.Array | list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and the number of ids of each text."""
        split = pc.ascii_split_whitespace(pc.fill_null(pa.array(texts, pa.string()), ""))
        coded = split.flatten().dictionary_encode()
        # distinct words, then their distinct parts
        words = coded.dictionary
        cores = pc.utf8_rtrim(words, _SIGNS)
        signs = pc.subtract(pc.binary_length(words), pc.binary_length(cores)).to_numpy()  # all of one byte
        alone = pc.ascii_is_alpha(cores).to_numpy(zero_copy_only=False).copy()
        unsure = np.flatnonzero((signs > 0) & ~alone)
        alone[unsure] = np.fromiter(map(str.isalpha, _strings(cores.take(pa.array(unsure)))), bool, len(unsure))
        tailed = np.flatnonzero((signs > 0) & alone)
        tails = np.full(len(words), "", object)
        tails[tailed] = [w[-n:] for w, n in zip(_strings(words.take(pa.array(tailed))), signs[tailed].tolist(), strict=True)]
        cores = pc.if_else(pa.array(alone), cores, words)
        cores = pc.if_else(pc.string_is_ascii(cores), pc.ascii_lower(cores), cores)
        parts = pa.concat_arrays([cores, pa.array(tails, pa.string())]).dictionary_encode()
        found = self._ids(_strings(parts.dictionary))
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
        two = parts.indices.to_numpy().reshape(2, -1).T.ravel().astype(np.int64)
        pool = gathered(np.frombuffer(b"".join(found), np.uint32), (np.cumsum(lengths) - lengths)[two], lengths[two])
        lengths = lengths[two].reshape(-1, 2).sum(1)
        # all words
        codes = coded.indices.to_numpy()
        of_word = lengths[codes]
        ids = gathered(pool, (np.cumsum(lengths) - lengths)[codes], of_word)
        bounds = np.concatenate([[0], np.cumsum(split.value_lengths().to_numpy())])
        ends = np.concatenate([[0], np.cumsum(of_word)])
        return ids, np.diff(ends[bounds])


def _strings(texts: pa.Array) -> list[str]:
    """As ``to_pylist``, without a scalar for each text."""
    return texts.to_numpy(zero_copy_only=False).tolist()


_encoders: dict[str, WordEncoder] = {}


def word_encoder(path: str) -> WordEncoder:
    """One encoder for all tasks of a worker process, which keeps the words it knows."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def re_pair(
    ids: np.ndarray, first: int, end_id: int, rounds: int = 8, per_round: int = 4096, least: int = 8, gain: float = 0.02
) -> tuple[np.ndarray, np.ndarray]:
    """Symbols and rules (two columns); rule k has symbol ``first + k``.

    Pairs are counted in 2^20 slots; the fullest slots each give the pair seen there last, counted
    exactly, so a pair that shares its slot waits for a later round.
    """
    seq, rules = ids.astype(np.uint32), []
    n_rules = 0
    for _ in range(rounds):
        if len(seq) < 2:
            break
        slot = seq[:-1] * np.uint32(0x9E3779B1)
        slot += seq[1:] * np.uint32(0x85EBCA77)
        slot >>= np.uint32(12)
        slot = slot.astype(np.int64)
        ends = np.flatnonzero(seq == end_id)
        slot[ends[ends < len(slot)]] = slot[ends[ends > 0] - 1] = 1 << 20
        counts = np.bincount(slot, minlength=(1 << 20) + 1)
        counts[1 << 20] = 0
        full = np.flatnonzero(counts >= least)
        if len(full) > per_round:
            full = full[counts[full] >= np.partition(counts[full], -per_round)[-per_round]]
        if not len(full):
            break
        hot = np.zeros((1 << 20) + 1, bool)
        hot[full] = True
        place = np.zeros((1 << 20) + 1, np.int32)
        place[full] = np.arange(len(full))
        at = np.flatnonzero(hot.take(slot))
        own = place.take(slot.take(at))
        keys = (seq.take(at).astype(np.uint64) << np.uint64(32)) | seq.take(at + 1)
        seen = np.zeros(len(full), np.uint64)
        seen[own] = keys
        exact = keys == seen[own]
        at, own = at[exact], own[exact]
        score = np.empty(len(full), np.int32)  # a higher number is more frequent
        score[np.argsort(-np.bincount(own, minlength=len(full)), kind="stable")] = np.arange(len(full), 0, -1)
        own_score = score[own]
        # an occurrence wins against those that begin one symbol before and after it; of equals the first
        near = np.diff(at) == 1
        wins = np.ones(len(at), bool)
        wins[1:] &= ~near | (own_score[1:] > own_score[:-1])
        wins[:-1] &= ~near | (own_score[:-1] >= own_score[1:])
        at, own = at[wins], own[wins]
        used = np.bincount(own, minlength=len(full))
        taken = used[own] >= 2
        at, own = at[taken], own[taken]
        if len(at) < max(2, gain * len(seq)):
            break
        chosen = np.flatnonzero(used >= 2)
        number = np.zeros(len(full), np.uint32)
        number[chosen] = np.arange(first + n_rules, first + n_rules + len(chosen))
        pairs = seen[chosen]
        rules.append(np.stack([pairs >> np.uint64(32), pairs & np.uint64(0xFFFFFFFF)], 1).astype(np.uint32))
        n_rules += len(chosen)
        seq = seq.copy()
        seq[at] = number[own]
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        seq = seq[keep]
    return seq, np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32)


def expansion_lengths(rules: np.ndarray, first: int) -> np.ndarray:
    """Number of ids each rule stands for; a rule only uses symbols of earlier rules."""
    lengths = np.ones(len(rules), np.int64)
    while True:
        sides = np.where(rules >= first, lengths[np.maximum(rules.astype(np.int64) - first, 0)], 1) if len(rules) else rules
        again = sides.sum(1).astype(np.int64)
        if np.array_equal(again, lengths):
            return lengths
        lengths = again


def _packed(values: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width]).tobytes()


def _unpacked(data: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width, 4), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(-1, width)
    return out.view("<u4").ravel()


def block_bytes(doc_ids: list[int | None], ids: np.ndarray, sizes: np.ndarray, first: int, end_id: int) -> bytes:
    """One block: header, rules, expansion lengths, documents, symbols."""
    seq, rules = re_pair(ids, first, end_id)
    lengths = expansion_lengths(rules, first)
    of_symbol = np.ones(len(seq), np.int64)
    high = seq >= first
    of_symbol[high] = lengths[seq[high] - first]
    at = np.searchsorted(np.cumsum(of_symbol), np.cumsum(sizes)) + 1  # symbols up to the end of each document
    width = max(1, (int(seq.max(initial=0)).bit_length() + 7) // 8)
    known = np.array([d is not None for d in doc_ids], np.uint8)
    return b"".join(
        [
            HEADER.pack(MAGIC, first, len(doc_ids), len(rules), width, len(seq)),
            rules.astype("<u4").tobytes(),
            lengths.astype("<u4").tobytes(),
            np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
            known.tobytes(),
            np.diff(at, prepend=0).astype("<u8").tobytes(),
            _packed(seq, width),
        ]
    )


class Block:
    """A block read back."""

    def __init__(self, data: bytes):
        magic, self.first, docs, rules, width, symbols = HEADER.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a token block")
        at = HEADER.size

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, n, at)
            at += out.nbytes
            return out

        self.rules = take("<u4", 2 * rules).reshape(-1, 2)
        self.lengths = take("<u4", rules).astype(np.int64)
        ids, known = take("<i8", docs), take("u1", docs)
        self.doc_ids = [int(d) if k else None for d, k in zip(ids, known, strict=True)]
        self.symbols_to = np.cumsum(take("<u8", docs)).astype(np.int64)
        self.seq = _unpacked(data[at : at + symbols * width], width)
        if len(self.seq) != symbols or (docs and self.symbols_to[-1] != symbols):
            raise ValueError("token block is cut short")
        pool = np.arange(self.first, self.first + rules, dtype=np.uint32)
        while (high := pool >= self.first).any():
            size = 1 + high
            at_ = np.cumsum(size) - size
            out = np.empty(int(size.sum()), np.uint32)
            out[at_[~high]] = pool[~high]
            out[at_[high]], out[at_[high] + 1] = self.rules[pool[high] - self.first].T
            pool = out
        self.pool, self.begin = pool, np.cumsum(self.lengths) - self.lengths

    def _expanded(self, seq: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        high = seq >= self.first
        # terminals are looked up in a table of their own, laid before the pool
        terminals = seq[~high]
        lengths, starts = np.ones(len(seq), np.int64), np.empty(len(seq), np.int64)
        starts[~high] = np.arange(len(terminals))
        lengths[high] = self.lengths[seq[high] - self.first]
        starts[high] = self.begin[seq[high] - self.first] + len(terminals)
        return gathered(np.concatenate([terminals, self.pool]), starts, lengths), lengths

    def all(self) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the end of each document among them."""
        ids, lengths = self._expanded(self.seq)
        return ids, np.concatenate([[0], np.cumsum(lengths)])[self.symbols_to]

    def ids_of(self, k: int) -> np.ndarray:
        """Ids of the k-th document, without expanding the others."""
        begin = self.symbols_to[k - 1] if k else 0
        return self._expanded(self.seq[begin : self.symbols_to[k]])[0]


def write_tokens(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int, block_ids: int = 1 << 20, text_chars: int = 8 << 20
) -> DataFrame:
    """Write ``docs`` (doc_id, text) below ``folder`` and return the index of blocks, kept in ``folder``/index."""

    def write(batches):
        encoder, sink, part = word_encoder(tokenizer), None, TaskContext.get().partitionId()
        names: list = []
        parts: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        block = held = 0

        def flushed():
            nonlocal block, held, sink
            if sink is None:
                sink = files.Sink(f"{folder}/tokens", ".rpair")
            data = block_bytes(names, np.concatenate(parts), np.concatenate(sizes), encoder.size, end_id)
            row = [part, block, sink.path, sink.write(data), len(data), len(names), held]
            block, held = block + 1, 0
            for kept in (names, parts, sizes):
                kept.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(row, _INDEX_TYPES, strict=True)], names=_INDEX_NAMES
            )

        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1)
            sizes_of = pc.fill_null(pc.utf8_length(texts), 0).to_pylist()
            for rows in runs(sizes_of, text_chars):
                ids, n = encoder(texts.slice(rows.start, rows.stop - rows.start))
                ends = np.cumsum(n)
                parts.append(np.insert(ids, ends, end_id).astype(np.uint32))
                sizes.append(n + 1)
                names += doc_ids[rows]
                held += len(parts[-1])
                if held >= block_ids:
                    yield flushed()
        if held:
            yield flushed()
        if sink is not None:
            sink.close()

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    tie = F.xxhash64("text")
    dealt = rows.repartitionByRange(F.col("doc_id"), tie).sortWithinPartitions(F.col("doc_id"), tie)
    dealt.mapInArrow(write, INDEX).write.parquet(f"{folder}/index")
    return docs.sparkSession.read.schema(INDEX).parquet(f"{folder}/index")


_INDEX_NAMES = [c.split()[0] for c in INDEX.split(", ")]
_INDEX_TYPES = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
_DIGEST_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.int64()]


def read_tokens(index: DataFrame, digest: bool = False, task_bytes: int = 16 << 20) -> DataFrame:
    """Documents of the files: doc_id, start (ids before it), n_tokens, and ids or their crc32."""
    parts = index.groupBy("part").agg(F.sum("n_ids").alias("ids"), F.sum("length").alias("bytes"))
    # one row per file: totals of what the tasks wrote, not of what they read
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = index.withColumn("ahead", F.coalesce(F.sum("n_ids").over(within), F.lit(0))).join(parts, "part")
    total = index.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    n = max(index.sparkSession.sparkContext.defaultParallelism, -(-total // task_bytes))
    last, kind = ("ids_crc32 long", pa.int64()) if digest else ("ids array<long>", pa.list_(pa.int64()))

    def read(batches):
        for batch in batches:
            rows = list(zip(*(c.to_pylist() for c in batch.columns), strict=True))
            for k, data in files.coalesced([r[:3] for r in rows]):
                block = Block(data)
                ids, ends = block.all()
                begins = np.concatenate([[0], ends[:-1]])
                if digest:
                    raw = memoryview(ids.astype("<u4")).cast("B")
                    values = [zlib.crc32(raw[4 * b : 4 * e]) for b, e in zip(begins, ends, strict=True)]
                else:
                    values = [ids[b:e].tolist() for b, e in zip(begins, ends, strict=True)]
                columns = [
                    pa.array(block.doc_ids, pa.int64()),
                    pa.array(begins + rows[k][3], pa.int64()),
                    pa.array(ends - begins, pa.int64()),
                    pa.array(values, kind),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", last.split()[0]])

    dealt = blocks.select("file", "offset", "length", (F.col("base") + F.col("ahead")).alias("start"))
    dealt = dealt.repartitionByRange(n, "file", "offset").sortWithinPartitions("file", "offset")
    return dealt.mapInArrow(read, f"doc_id long, start long, n_tokens long, {last}")
