"""Quality rules by line labelling: a linear-chain CRF marks content and boilerplate.

Each line with a word gets features (shares of signs and digits, length, ending, repetition of the line
or of its words). Weights of features and of label transitions are fitted by maximum likelihood on a
bounded sample of labelled documents, whose lines take the document's label; Viterbi decoding then labels
the lines of every document, and the share of its words in content lines decides whether it stays.
Documents that fail the counting rules go whatever the lines say.

Defined cases: a null text has no words and fails; blank lines are no lines; without labelled documents of
both kinds all lines are content; rows of the input that are equal get equal outcomes; an empty table gives no rows; a very long
text is labelled whole; equal hashes of doc_ids in the sample are taken by doc_id; rows of ``labels`` for one document count once, the lowest quality being
taken; labels without quality and rows without doc_id teach nothing.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearwheel.llm.distinct import slices
from yearwheel.llm.words import Words, covered, mixed, range_hashes

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 20
REPEAT_WINDOW = 8
MAX_REPEAT_PERCENT = 30
FEATURES = ["bias", "symbols", "many_symbols", "digits", "short", "long", "ends", "capital", "repeated", "repeats", "word_chars"]
CONTENT, BOILERPLATE = 0, 1
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _flags(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_IS_SYMBOL, _IS_DIGIT, _IS_END, _IS_CAPITAL = (
    _flags(SYMBOLS),
    _flags(b"0123456789"),
    _flags(b".!?"),
    _flags(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
)
# À to Þ in UTF-8, without the multiplication sign
_IS_LATIN_CAPITAL = _flags(bytes(b for b in range(0x80, 0x9F) if b != 0x97))


def _again(keys: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys equal an earlier one of their group, and which any other one."""
    salted = keys ^ mixed(groups.astype(np.uint64) + np.uint64(1))
    order = np.argsort(salted, kind="stable")
    same = np.concatenate([[False], salted[order][1:] == salted[order][:-1]]) if len(order) else np.zeros(0, bool)
    later, either = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    later[order] = same
    either[order] = same | np.concatenate([same[1:], [False]]) if len(order) else same
    return later, either


class Lines:
    """Counts of documents, and features of their lines with a word.

    Document d has the lines ``first[d]:first[d + 1]``.
    """

    def __init__(self, texts: list[str | None]):
        words = Words([(t or "").encode() for t in texts])
        data, n_docs = words.data, len(texts)
        # a document's last byte is the space laid behind it, where its last line ends
        ends = np.union1d(np.flatnonzero(data == 0x0A), words.at[1:] - 1)
        begins = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
        of_line = np.searchsorted(begins, words.begins, "right") - 1
        n_words = np.bincount(of_line, minlength=len(begins))
        keep = n_words > 0
        begins, ends, n_words = begins[keep], ends[keep], n_words[keep].astype(float)
        docs = np.searchsorted(words.at, begins, "right") - 1
        self.first = np.searchsorted(docs, np.arange(n_docs + 1))
        self.n_words = n_words

        def per_line(flags: np.ndarray) -> np.ndarray:
            sums = np.concatenate([[0], np.cumsum(flags)])
            return (sums[ends] - sums[begins]).astype(float)

        def per_doc(flags: np.ndarray) -> np.ndarray:
            sums = np.concatenate([[0], np.cumsum(flags)])
            return sums[words.at[1:]] - sums[words.at[:-1]]

        later, either = _again(range_hashes(words.sums, begins, ends), docs)
        of_word = np.repeat(np.arange(n_docs), words.n)
        starts, keys = words.windows(REPEAT_WINDOW, words.hashes())
        twice = _again(keys, of_word[starts])[1]
        repeated = covered(starts[twice], REPEAT_WINDOW, len(words))
        in_word = ~words.space & ((data & 0xC0) != 0x80)
        self.counts = {
            "n_words": words.n,
            "word_chars": per_doc(in_word),
            "n_symbols": per_doc(_IS_SYMBOL[data]),
            "n_dup_lines": np.bincount(docs[later], minlength=n_docs),
            "n_repeat_words": np.bincount(of_word[repeated], minlength=n_docs),
        }
        word_first = np.concatenate([[0], np.cumsum(n_words)]).astype(np.int64)
        # a space is laid behind each text, so a byte follows each initial
        initials = words.begins[word_first[:-1]]
        symbols = per_line(_IS_SYMBOL[data]) / n_words
        sums = np.concatenate([[0], np.cumsum(repeated)])
        self.features = np.stack(
            [
                np.ones(len(begins)),
                np.minimum(symbols, 3.0),
                symbols > 0.25,
                np.minimum(per_line(_IS_DIGIT[data]) / n_words, 3.0),
                n_words < 4,
                n_words > 60,
                _IS_END[data[words.ends[word_first[1:] - 1] - 1]],
                _IS_CAPITAL[data[initials]] | (data[initials] == 0xC3) & _IS_LATIN_CAPITAL[data[initials + 1]],
                either,
                (sums[word_first[1:]] - sums[word_first[:-1]]) / n_words,
                np.minimum(per_line(in_word) / n_words / 10.0, 3.0),
            ],
            1,
        ).astype(float)


class Chain:
    """Linear-chain CRF with two labels."""

    def __init__(self, weights: np.ndarray | None = None, moves: np.ndarray | None = None):
        self.weights = np.zeros((len(FEATURES), 2)) if weights is None else weights
        self.moves = np.zeros((2, 2)) if moves is None else moves

    @staticmethod
    def _rounds(first: np.ndarray):
        """Positions of the t-th line of each document that has one, for t = 0, 1, ...; longest first."""
        sizes = np.diff(first)
        order = np.argsort(-sizes, kind="stable")
        starts, falling = first[:-1][order], sizes[order]
        left = np.searchsorted(-falling, -np.arange(int(sizes.max(initial=0))), "left")
        return [starts[:n] + t for t, n in enumerate(left)]

    def decode(self, features: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Best labels (Viterbi); content where both are as good."""
        scores = features @ self.weights
        rounds, back = self._rounds(first), np.zeros((len(features), 2), np.int8)
        for before, at in zip(rounds, rounds[1:], strict=False):
            paths = scores[before[: len(at)], :, None] + self.moves  # from label, to label
            back[at] = paths.argmax(1)
            scores[at] += paths.max(1)
        labels = np.zeros(len(features), np.int8)
        if not rounds:
            return labels
        last = first[1:][np.diff(first) > 0] - 1
        labels[last] = scores[last].argmax(1)
        for before, at in zip(rounds[-2::-1], rounds[:0:-1], strict=False):
            labels[before[: len(at)]] = back[at, labels[at]]
        return labels

    def _expected(self, features: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Label probabilities of each line and expected label pairs (forward-backward)."""
        own = features @ self.weights
        ahead, after = own.copy(), np.zeros_like(own)
        rounds = self._rounds(first)
        for before, at in zip(rounds, rounds[1:], strict=False):
            ahead[at] += np.logaddexp.reduce(ahead[before[: len(at)], :, None] + self.moves, 1)
        for before, at in zip(rounds[-2::-1], rounds[:0:-1], strict=False):
            after[before[: len(at)]] = np.logaddexp.reduce(self.moves + (own[at] + after[at])[:, None, :], 2)
        total = np.logaddexp.reduce(ahead + after, 1)
        pairs = np.zeros((2, 2))
        for before, at in zip(rounds, rounds[1:], strict=False):
            joint = ahead[before[: len(at)], :, None] + self.moves + (own[at] + after[at])[:, None, :]
            pairs += np.exp(joint - total[at][:, None, None]).sum(0)
        return np.exp(ahead + after - total[:, None]), pairs

    @classmethod
    def fit(cls, features: np.ndarray, first: np.ndarray, labels: np.ndarray, rounds: int = 120, rate: float = 0.1, l2: float = 1e-3):
        """Maximum likelihood with L2 by Adam on the whole sample."""
        chain = cls()
        inner = np.ones(len(labels), bool)
        inner[first[:-1][np.diff(first) > 0]] = False
        seen = np.zeros((2, 2))
        np.add.at(seen, (labels[np.flatnonzero(inner) - 1], labels[inner]), 1)
        gold, n = features.T @ np.eye(2)[labels], max(1, len(labels))
        theta = [chain.weights, chain.moves]
        speed, size = [np.zeros_like(p) for p in theta], [np.zeros_like(p) for p in theta]
        for t in range(1, rounds + 1):
            share, pairs = chain._expected(features, first)
            for k, slope in enumerate(((features.T @ share - gold) / n, (pairs - seen) / n)):
                slope = slope + l2 * theta[k]
                speed[k] = 0.9 * speed[k] + 0.1 * slope
                size[k] = 0.999 * size[k] + 0.001 * slope**2
                theta[k] -= rate * (speed[k] / (1 - 0.9**t)) / (np.sqrt(size[k] / (1 - 0.999**t)) + 1e-8)
        return chain


def line_features(texts: list[str | None], text_chars: int = 1 << 18) -> tuple[np.ndarray, np.ndarray]:
    """Features of the lines of all texts and where each text's lines begin, a few texts at a time to hold little."""
    features, sizes = [np.zeros((0, len(FEATURES)))], [np.zeros(1, np.int64)]
    for part in slices(texts, text_chars):
        lines = Lines(texts[part])
        features.append(lines.features)
        sizes.append(np.diff(lines.first))
    return np.concatenate(features), np.cumsum(np.concatenate(sizes))


def train(docs: DataFrame, labels: DataFrame, train_docs: int = 2000, train_chars: int = 20_000) -> Chain:
    """Fit on up to ``train_docs`` labelled documents, half of each quality: those with the smallest hashes of
    doc_id, without texts of more than ``train_chars`` characters. The sample is all that reaches the driver.
    """
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    ordered = known.select("doc_id", "quality").orderBy(F.xxhash64("doc_id"), "doc_id")
    quality = {r["doc_id"]: r["quality"] for q in (1, 0) for r in ordered.where(F.col("quality") == q).limit(train_docs // 2).collect()}
    # the ids are so few that they filter the scan; no text is shuffled
    texts = docs.where(F.col("doc_id").isin(list(quality))).where(F.length("text") <= train_chars)
    texts = texts.groupBy("doc_id").agg(F.min(F.col("text").cast("string")).alias("text")).orderBy("doc_id")
    sample = [(r["text"], quality[r["doc_id"]]) for r in texts.collect()]
    if len({q for _, q in sample}) < 2:
        return Chain()
    features, first = line_features([t for t, _ in sample])
    marks = np.array([CONTENT if q else BOILERPLATE for _, q in sample])
    return Chain.fit(features, first, np.repeat(marks, np.diff(first)))


def judge(texts: list[str | None], chain: Chain, least_share: float = 0.5) -> dict[str, np.ndarray]:
    """Counts, share of words in content lines, base_failed and kept of each text."""
    lines = Lines(texts)
    content = chain.decode(lines.features, lines.first) == CONTENT
    sums = np.concatenate([[0], np.cumsum(lines.n_words * content)])
    n = lines.counts["n_words"]
    share = (sums[lines.first[1:]] - sums[lines.first[:-1]]) / np.maximum(n, 1)
    failed = (n < MIN_WORDS) | (100 * lines.counts["n_repeat_words"] > MAX_REPEAT_PERCENT * n)
    return lines.counts | {"content_share": share, "base_failed": failed, "kept": ~failed & (share >= least_share)}


def _apply(batches, chain: Chain, kept: list[str], text_at: int, least_share: float, text_chars: int):
    kinds = [pa.int64()] * len(COUNTS) + [pa.float64(), pa.bool_(), pa.bool_()]
    names = [*COUNTS, "content_share", "base_failed", "kept"]
    for batch in batches:
        texts = batch.column(text_at).to_pylist()
        for part in slices(texts, text_chars):
            found = judge(texts[part], chain, least_share)
            rows = batch.slice(part.start, part.stop - part.start)
            added = [pa.array(found[n], t) for n, t in zip(names, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*rows.columns[: len(kept)], *added], names=[*kept, *names])


def label_quality(docs: DataFrame, chain: Chain, columns: list[str], least_share: float = 0.5, text_chars: int = 2 << 20) -> DataFrame:
    """``columns`` of each row of ``docs`` with the outcome of :func:`judge` for its text."""
    # a text that is wanted anyway is not sent twice
    sent = "text" in columns and dict(docs.dtypes)["text"] == "string"
    rows = docs.select(*columns) if sent else docs.select(*columns, F.col("text").cast("string").alias("__text"))
    schema = rows.drop("__text").schema
    text_at = columns.index("text") if sent else len(columns)
    for name in COUNTS:
        schema = schema.add(name, "long")
    schema = schema.add("content_share", "double").add("base_failed", "boolean").add("kept", "boolean")
    return rows.mapInArrow(partial(_apply, chain=chain, kept=columns, text_at=text_at, least_share=least_share, text_chars=text_chars), schema)
