import re
from itertools import product

import numpy as np

from yearwheel.llm import line_crf


def brute_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    places = {}
    for k in range(len(words) - 7):
        places.setdefault(tuple(words[k : k + 8]), []).append(k)
    twice = {j for at in places.values() if len(at) > 1 for k in at for j in range(k, k + 8)}
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), again, len(twice)


def test_counts(texts):
    lines = line_crf.Lines(texts)
    got = list(zip(*[lines.counts[c].tolist() for c in line_crf.COUNTS], strict=True))
    assert got == [brute_counts(t) for t in texts]


def test_viterbi_and_marginals_against_all_paths():
    rng = np.random.default_rng(0)
    sizes = [4, 0, 1, 6]
    first = np.cumsum([0, *sizes])
    features = rng.normal(size=(first[-1], len(line_crf.FEATURES)))
    chain = line_crf.Chain(rng.normal(size=(len(line_crf.FEATURES), 2)), rng.normal(size=(2, 2)))
    own = features @ chain.weights
    labels, (share, pairs) = chain.decode(features, first), chain._expected(features, first)
    want = np.zeros((2, 2))
    for begin, end in zip(first, first[1:], strict=False):
        if begin == end:
            continue
        paths = list(product((0, 1), repeat=end - begin))
        score = [sum(own[begin + k, y] for k, y in enumerate(p)) + sum(chain.moves[a, b] for a, b in zip(p, p[1:], strict=False)) for p in paths]
        assert tuple(labels[begin:end]) == paths[int(np.argmax(score))]
        weight = np.exp(score) / np.exp(score).sum()
        np.testing.assert_allclose(share[begin, 1], sum(w for w, p in zip(weight, paths, strict=True) if p[0] == 1))
        for w, p in zip(weight, paths, strict=True):
            for a, b in zip(p, p[1:], strict=False):
                want[a, b] += w
    np.testing.assert_allclose(pairs, want)


def labelled(spark, n=120):
    good = "This is a sentence of plain words that goes on for a while.\nAnd here comes another one, about number {i}.\nIt ends well."
    junk = "Menu*** home$$$ {i} | login### | more&&& *** $$$\nclick### here%%% now*** {i} | buy$$$ | cheap*** and### so&&& on***\n$$$ {i} ***"
    rows = [(i, (good if i % 2 else junk).format(i=i) + f"\nend of {i} it is.", i % 2) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, quality int")


def test_held_out_accuracy(spark):
    rows = labelled(spark)
    chain = line_crf.train(rows.select("doc_id", "text"), rows.where("doc_id < 60").select("doc_id", "quality"))
    out = line_crf.label_quality(rows.where("doc_id >= 60"), chain, ["doc_id", "quality"]).collect()
    assert all(r.kept == bool(r.quality) for r in out)


def test_cases(spark, docs, no_docs):
    labels = spark.createDataFrame([(None, 1), (1, None), (2, 1), (2, 1)], "doc_id long, quality int")
    chain = line_crf.train(docs, labels)  # one kind only: every line is content
    out = line_crf.label_quality(docs, chain, ["doc_id"]).collect()
    assert len(out) == docs.count()
    assert all(r.kept == (not r.base_failed) and r.base_failed >= (r.n_words < 20) for r in out)
    assert line_crf.label_quality(no_docs, chain, ["doc_id"]).count() == 0


def test_capitals_of_two_bytes():
    at = line_crf.FEATURES.index("capital")
    lines = ["École", "école", "Über", "×", "a", "A", "þ", "Þ", "日", "É", "é"]
    assert line_crf.Lines(["\n".join(lines)]).features[:, at].tolist() == [1, 0, 1, 0, 0, 1, 0, 1, 0, 1, 0]


def test_features_do_not_depend_on_the_slices():
    texts = [*["A line of words.\n\nmore ### words more words\n" * n for n in range(6)], None, "", "é " * 50]
    whole, parts = line_crf.Lines(texts), line_crf.line_features(texts, 40)
    assert np.array_equal(whole.features, parts[0]) and np.array_equal(whole.first, parts[1])
    assert line_crf.line_features([])[0].shape == (0, len(line_crf.FEATURES))
