"""The hashed Kneser-Ney models against the formula, written out over plain counts."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from cohortloom.llm import language_id


def padded(word):
    return "\2\2\2" + word + "\3"


class Plain:
    """Interpolated Kneser-Ney of order four over the words of one language."""

    def __init__(self, words, alphabet):
        self.alphabet = alphabet
        grams = Counter()
        for word in words:
            line = padded(word)
            grams.update(line[i : i + 4] for i in range(len(line) - 3))
        self.counts = {4: grams}
        for order in (3, 2, 1):  # in how many different contexts one character further left
            seen = defaultdict(set)
            for gram in self.counts[order + 1]:
                seen[gram[1:]].add(gram[0])
            self.counts[order] = Counter({g: len(left) for g, left in seen.items()})
        self.discount = {}
        for order, counts in self.counts.items():
            once, twice = (sum(n == k for n in counts.values()) for k in (1, 2))
            self.discount[order] = min(0.95, once / (once + 2 * twice)) if once and twice else 0.5

    def p(self, gram):
        """Probability of the last character after the others."""
        order = len(gram)
        if not order:
            return 1 / self.alphabet
        counts, d = self.counts[order], self.discount[order]
        same = [n for g, n in counts.items() if g[:-1] == gram[:-1]]
        if not same:
            return self.p(gram[1:])
        own = max(counts[gram] - d, 0) if gram in counts else 0
        return (own + d * len(same) * self.p(gram[1:])) / sum(same)

    def log_p(self, word):
        line = padded(word)
        return sum(math.log(self.p(line[i : i + 4])) for i in range(len(line) - 3))


@pytest.mark.parametrize("seed", range(4))
def test_models_equal_the_formula(seed):
    draw = random.Random(seed)
    letters = {"aa": "abcdé", "bb": "bcdfgß", "cc": "xy漢"}
    corpus = {
        lang: ["".join(draw.choices(own, k=draw.randint(1, 6))) for _ in range(draw.choice([3, 40, 200]))]
        for lang, own in letters.items()
    }
    rows = []
    for lang, words in corpus.items():
        for word in words:
            line = padded(word)
            rows += [(lang, line[i : i + 4], 1) for i in range(len(line) - 3)]
    models = language_id.estimate(rows)
    alphabet = len({gram[-1] for _, gram, _ in rows}) + 1
    plain = {lang: Plain(words, alphabet) for lang, words in corpus.items()}
    every = "".join(letters.values()) + "qz"
    words = [w for own in corpus.values() for w in own[:8]]
    words += ["".join(draw.choices(every, k=draw.randint(1, 8))) for _ in range(30)]
    got = models.word_scores(words)
    want = np.array([[plain[lang].log_p(w) for lang in models.languages] for w in words])
    assert np.allclose(got, want, rtol=1e-9, atol=1e-9)


def test_the_lowest_cross_entropy_of_the_formula_wins(spark):
    """Predictions of the whole operator, fitted by Spark, beside those of the formula."""
    draw = random.Random(9)
    letters = {"aa": "abcde", "bb": "defgh", "cc": "ghabx"}
    text = lambda lang: " ".join("".join(draw.choices(letters[lang], k=5)) for _ in range(12))
    train = [(text(lang), lang) for lang in letters for _ in range(8)]
    models = language_id.fit(spark.createDataFrame(train, "text string, lang string"))
    tests = [text(draw.choice(list(letters))) + " " + text(draw.choice(list(letters))) for _ in range(40)]
    rows = spark.createDataFrame(list(enumerate(tests)), "doc_id long, text string")
    got = {r.doc_id: r.lang_pred for r in language_id.identify(rows, models).collect()}
    for i, content in enumerate(tests):
        entropy = -models.word_scores(content.split()).sum(axis=0)
        assert got[i] == models.languages[int(entropy.argmin())]
