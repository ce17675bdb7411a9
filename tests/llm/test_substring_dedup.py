from hypothesis import given
from hypothesis import strategies as st

from yearwheel.llm.substring_dedup import SuffixAutomaton, remove_repeats, repeated_spans
from yearwheel.operators.staging import Staging


@given(st.lists(st.lists(st.integers(0, 3), max_size=25), min_size=1, max_size=5), st.integers(1, 4))
def test_automaton_finds_all_known_windows(sequences, window):
    automaton, known = SuffixAutomaton(), set()
    for words in sequences:
        gone = [any(tuple(words[k : k + window]) in known for k in range(max(0, i - window + 1), i + 1) if k + window <= len(words)) for i in range(len(words))]
        got = [False] * len(words)
        for first, n in repeated_spans(automaton, words, window):
            got[first : first + n] = [True] * n
        assert got == gone
        automaton.add(words)
        known |= {tuple(words[k : k + window]) for k in range(len(words) - window + 1)}


def brute(rows, window=20):
    """Rows in order; equal (id, text) is one document."""
    seen, out = set(), {}
    for key, text in rows:
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for k in range(len(words) - window + 1):
            w = tuple(words[k : k + window])
            if w in seen:
                gone[k : k + window] = [True] * window
            seen.add(w)
        out[key] = (len(words), sum(gone), b" ".join(w for w, g in zip(words, gone, strict=True) if not g).decode())
    return out


def test_removal(docs, no_docs, stage):
    unique = docs.where("doc_id IS NOT NULL").groupBy("doc_id").agg({"text": "min"}).withColumnRenamed("min(text)", "text")
    rows = sorted(((r.doc_id, r.text) for r in unique.collect()), key=lambda r: r[0])
    got = {r.doc_id: tuple(r)[1:] for r in remove_repeats(unique, stage).collect()}
    assert got == brute(rows) and sum(v[1] for v in got.values()) > 100
    # a small bound of a shard splits it by windows
    again = {r.doc_id: tuple(r)[1:] for r in remove_repeats(unique, Staging(stage.spark), shard_segments=1).collect()}
    assert again == got


def test_repeated_and_missing_ids(spark, docs, no_docs, stage):
    got = remove_repeats(docs, stage).collect()
    assert len(got) == docs.count()
    assert len({tuple(r)[1:] for r in got if r.doc_id == 5}) == 1  # one document, the same result
    late = [r for r in got if r.doc_id is None and r.n_words]
    assert late and all(r.n_removed == r.n_words for r in late)  # null comes last
    assert remove_repeats(no_docs, Staging(spark)).count() == 0
