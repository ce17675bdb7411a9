"""Substring dedup: words inside passages that stand earlier in the corpus are removed.

A window is ``window`` consecutive words of one document; it is a repeat if the same words begin at an
earlier place (smaller doc_id, or earlier in the same document). Every word of a repeat goes.

Suffix automata find the repeats, as matching statistics of each passage against those before it. An
automaton of the whole corpus could not be sent to every task, and every document against every shard of
one would be quadratic work, so passages travel to the shard that can hold their repeats:

1. Every window has an anchor, the ``anchor``-word run in it with the smallest hash (the first of equals);
   equal windows have equal anchors. Neighbouring windows with one anchor form a segment.
2. Segments whose anchor occurs once in the corpus cannot be repeats and go no further.
3. Equal segments collapse to the first one; all others are repeats as a whole.
4. What differs around one anchor meets in one shard, in the order of the corpus. The shard's suffix
   automaton takes in each segment after streaming it: where the matching statistic reaches the window,
   a maximal span is removed. An anchor with more than ``shard_segments`` different segments is split by
   the windows' own hashes, so no shard grows with the corpus.

Words are compared by 64-bit hashes of their bytes.

Defined cases: a null text has no words, a text shorter than the window keeps all; a null doc_id comes after
all others; rows with the same doc_id and text are one document (each gets the same result), rows with the
same doc_id and different texts follow each other by the hashes of their texts.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yearwheel.llm.distinct import slices
from yearwheel.llm.words import Words, prefix_sums, range_hashes
from yearwheel.operators.staging import Staging

# position of a segment in one number: first word, words, both below these
_ROOM = 1 << 12


class SuffixAutomaton:
    """Suffix automaton of word sequences that are added one after the other."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def add(self, words: list[int]) -> None:
        """Take in one more sequence; matches do not run from one into the next."""
        next_, link, length = self.next, self.link, self.length
        last = 0
        for word in words:
            known = next_[last].get(word)
            if known is not None:
                if length[known] == length[last] + 1:
                    last = known
                else:
                    last = self._split(last, word, known)
                continue
            state = len(next_)
            next_.append({})
            length.append(length[last] + 1)
            link.append(0)
            at = last
            while at >= 0 and word not in next_[at]:
                next_[at][word] = state
                at = link[at]
            if at >= 0:
                known = next_[at][word]
                link[state] = known if length[known] == length[at] + 1 else self._split(at, word, known)
            last = state

    def _split(self, at: int, word: int, known: int) -> int:
        copy = len(self.next)
        self.next.append(dict(self.next[known]))
        self.length.append(self.length[at] + 1)
        self.link.append(self.link[known])
        self.link[known] = copy
        while at >= 0 and self.next[at].get(word) == known:
            self.next[at][word] = copy
            at = self.link[at]
        return copy

    def statistics(self, words: list[int]) -> list[int]:
        """Length of the longest known run that ends at each word."""
        next_, link, length = self.next, self.link, self.length
        state = size = 0
        out = []
        for word in words:
            to = next_[state].get(word)
            while to is None and state:
                state = link[state]
                size = length[state]
                to = next_[state].get(word)
            if to is None:
                size = 0
            else:
                state, size = to, size + 1
            out.append(size)
        return out


def repeated_spans(automaton: SuffixAutomaton, words: list[int], window: int) -> list[tuple[int, int]]:
    """Maximal runs (first word, words) covered by windows the automaton knows."""
    spans: list[tuple[int, int]] = []
    for end, size in enumerate(automaton.statistics(words), 1):
        if size >= window:
            if spans and sum(spans[-1]) >= end - window:
                spans[-1] = (spans[-1][0], end - spans[-1][0])
            else:
                spans.append((end - window, window))
    return spans


def segments(words: Words, hashes: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Anchor hash, segment hash, first word and number of words of every segment."""
    starts, _ = words.windows(window, hashes)
    if not len(starts):
        return (np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    sums = prefix_sums(hashes)
    grams = np.arange(len(hashes) - anchor + 1)
    best = range_hashes(sums, grams, grams + anchor)
    where, span, wanted = grams, 1, window - anchor + 1

    def joined(best, where, shift):
        left, right = best[:-shift], best[shift:]
        first = left <= right
        return np.where(first, left, right), np.where(first, where[:-shift], where[shift:])

    while 2 * span <= wanted:
        best, where = joined(best, where, span)
        span *= 2
    if span < wanted:
        best, where = joined(best, where, wanted - span)
    best, where = best[starts], where[starts]
    new = np.concatenate([[True], (where[1:] != where[:-1]) | (starts[1:] != starts[:-1] + 1)])
    first = starts[new]
    size = np.diff(np.append(np.flatnonzero(new), len(starts))) + window - 1
    return best[new], range_hashes(sums, first, first + size), first, size


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _segment_rows(batches, window: int, anchor: int, text_chars: int, full: bool):
    names = ["h", "g", "doc", "tie", "at"] if full else ["h"]
    for batch in batches:
        texts, doc, tie = batch.column(2).to_pylist(), batch.column(0).to_numpy(), batch.column(1).to_numpy()
        for part in slices(texts, text_chars):
            words = Words([(t or "").encode() for t in texts[part]])
            h, g, first, size = segments(words, words.hashes(), window, anchor)
            columns = [_signed(h)]
            if full:
                of = np.searchsorted(words.first, first, "right") - 1
                at = (first - words.first[of]) * _ROOM + size
                columns += [_signed(g), pa.array(doc[part][of]), pa.array(tie[part][of]), pa.array(at)]
            yield pa.RecordBatch.from_arrays(columns, names=names)


def _shard_rows(batches, window: int, shard_segments: int, text_chars: int):
    """Words of the wanted segments, whole or, for split anchors, window by window."""
    names = ["h", "shard", "doc", "tie", "first", "words"]
    for batch in batches:
        doc, tie, texts, wanted = (c.to_pylist() for c in batch.columns)
        for part in slices(texts, text_chars):
            words = Words([(t or "").encode() for t in texts[part]])
            hashes = words.hashes()
            sums = prefix_sums(hashes)
            out: list[list] = [[] for _ in names]
            for k, (d, t, segments_) in enumerate(zip(doc[part], tie[part], wanted[part], strict=True)):
                base = int(words.first[k])
                for s in segments_:
                    first, size, shards = s["at"] // _ROOM, s["at"] % _ROOM, -(-s["n"] // shard_segments)
                    if shards == 1:
                        rows = [(0, first, size)]
                    else:
                        starts = np.arange(base + first, base + first + size - window + 1)
                        keys = range_hashes(sums, starts, starts + window) % np.uint64(shards)
                        rows = [(int(key) + 1, first + i, window) for i, key in enumerate(keys)]
                    for shard, begin, n in rows:
                        row = (s["h"], shard, d, t, begin, hashes[base + begin : base + begin + n].tobytes())
                        for column, value in zip(out, row, strict=True):
                            column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names=names)


def _match(batches, window: int):
    """Removed spans; rows come sorted by shard and place, and a shard may run over several batches."""
    key, automaton, held = None, None, None
    for batch in batches:
        spans: list[list[int]] = [[], [], [], []]
        columns = [c.to_pylist() for c in batch.columns]
        for h, shard, doc, tie, first, data in zip(*columns, strict=True):
            words = np.frombuffer(data, np.uint64).tolist()
            if (h, shard) != key:
                key, automaton, held = (h, shard), SuffixAutomaton(), None
            if held is not None:  # the last of a shard is never looked for, so it is added late
                automaton.add(held)
            if held is not None or len(automaton.next) > 1:
                for begin, n in repeated_spans(automaton, words, window):
                    for column, value in zip(spans, (doc, tie, first + begin, n), strict=True):
                        column.append(value)
            held = words
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in spans], names=["doc", "tie", "first", "n"])


def _cut(batches, text_chars: int):
    """Texts without the words in the spans."""
    for batch in batches:
        doc_id, texts, spans = batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()
        for part in slices(texts, text_chars):
            n, removed, kept = [], [], []
            for text, cut in zip(texts[part], spans[part], strict=True):
                words = (text or "").encode().split()
                total = len(words)
                if cut:
                    gone = np.zeros(total, bool)
                    for s in cut:
                        gone[s["first"] : s["first"] + s["n"]] = True
                    words = [words[k] for k in np.flatnonzero(~gone)]
                n.append(total)
                removed.append(total - len(words))
                kept.append(b" ".join(words).decode())
            columns = [doc_id[part.start : part.stop], pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_removed", "kept_text"])


def remove_repeats(
    docs: DataFrame, stage: Staging, window: int = 20, anchor: int = 6, shard_segments: int = 2048, text_chars: int = 2 << 20
) -> DataFrame:
    """doc_id, n_words, n_removed and kept_text of each row of ``docs`` (doc_id, text)."""
    if not 0 < anchor <= window < _ROOM // 2:
        raise ValueError("the anchor has to fit the window")
    named = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    ids = named.agg(F.count(F.lit(1)) == F.count("doc_id"), F.count("doc_id") == F.count_distinct("doc_id")).first()
    # ids that tell documents apart need no tie, and a constant one costs nothing on the way
    tie: Column = F.lit(0).cast("long") if all(ids) else F.xxhash64("text")
    base = named.select("doc_id", F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("doc"), tie.alias("tie"), "text")
    source = base.select("doc", "tie", "text")
    rows = partial(_segment_rows, window=window, anchor=anchor, text_chars=text_chars)
    shared = source.mapInArrow(partial(rows, full=False), "h long").groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")
    occurring = source.mapInArrow(partial(rows, full=True), "h long, g long, doc long, tie long, at long")
    shared = stage(occurring.join(shared, "h"), "shared")
    place = F.struct("doc", "tie", "at")
    firsts = stage(shared.groupBy("h", "g").agg(F.min(place).alias("head")), "firsts")
    copies = shared.join(firsts, ["h", "g"]).where(place != F.col("head"))
    whole = copies.select("doc", "tie", F.expr(f"at div {_ROOM}").alias("first"), (F.col("at") % _ROOM).alias("n"))
    different = firsts.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    wanted = firsts.join(different, "h").select("h", "n", "head.*")
    wanted = wanted.groupBy("doc", "tie").agg(F.collect_list(F.struct("h", "at", "n")).alias("wanted"))
    fetched = base.select("doc", "tie", "text", "doc_id").join(wanted, ["doc", "tie"]).select("doc", "tie", "text", "wanted")
    if not all(ids):  # of rows that are one document, one is enough
        fetched = fetched.dropDuplicates(["doc", "tie"])
    sharded = fetched.mapInArrow(
        partial(_shard_rows, window=window, shard_segments=shard_segments, text_chars=text_chars),
        "h long, shard long, doc long, tie long, first long, words binary",
    )
    dealt = sharded.repartition("h", "shard").sortWithinPartitions("h", "shard", "doc", "tie", "first")
    partly = dealt.mapInArrow(partial(_match, window=window), "doc long, tie long, first long, n long")
    spans = whole.union(partly).groupBy("doc", "tie").agg(F.collect_list(F.struct("first", "n")).alias("spans"))
    cut = base.select("doc", "tie", "text", "doc_id").join(spans, ["doc", "tie"], "left").select("doc_id", "text", "spans")
    return cut.mapInArrow(partial(_cut, text_chars=text_chars), "doc_id long, n_words long, n_removed long, kept_text string")
