"""Language identification with interpolated Kneser-Ney character models.

Each language has a character model of order four over the words of its texts (letters
only, lower case, with marks at both ends). The n-grams of all languages stand in one
sorted array of 64-bit hashes for each order, beside a matrix of log probabilities with a
column for each language, so that one binary search serves all of them. A text gets the
language of the lowest cross-entropy per character. Its score is the calibrated probability
of that language, and a text is rejected where its cross-entropy is beyond what nearly all
texts of that language reach, or its score is too low.

The models are fitted on a sample of labelled rows whose expected size is a parameter; the
counting is done by Spark, and what the driver gets are the n-grams of that sample.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import GOLDEN, map_arrow, mix64, slices, table, texts, whole_text
from cohortloom.sources.storage import materialize

ORDER = 4
SAMPLE = 2000  # labelled rows of each language to fit on, on average
CALIBRATION = 4  # one in so many of them is kept for calibration
REJECTED = 0.001  # share of calibration texts that may be beyond the bound of cross-entropy
SLACK = 1.25  # what the bound allows beyond that, as unseen texts are not the sample
LOW_SCORE = 0.3
UNDETERMINED = "und"
WORD = re.compile(r"[^\W\d_]+")
BEGIN, END = 2, 3  # code points that are no letters
SLICE = 1 << 20  # bytes of text whose words are scored together
REMEMBERED = 1 << 21  # numbers of remembered word scores in a worker; it starts anew beyond


def words_of(text: str) -> list[str]:
    """Lower-case runs of letters; none if there is no letter at all."""
    found = WORD.findall(text.lower())
    if found and not any(c.isalpha() for w in found for c in w):
        return []  # runs of numerals that aren't letters
    return found


def keys_of(codes: np.ndarray, order: int) -> np.ndarray:
    """Hash of the n-gram that ends at each position; positions before that wrap around."""
    key = np.full(len(codes), order, np.uint64)
    for back in range(order - 1, -1, -1):
        key = mix64(key * GOLDEN + np.roll(codes, back))
    return key


def padded(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words with marks around them, and the length of each."""
    line = [(chr(BEGIN) * (ORDER - 1)) + w + chr(END) for w in words]
    codes = np.frombuffer("".join(line).encode("utf-32-le", "surrogatepass"), np.uint32)
    return codes.astype(np.uint64), np.fromiter(map(len, line), np.int64, len(line))


def _ngrams(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of characters to predict, the word of each, and all code points."""
    codes, lengths = padded(words)
    owner = np.repeat(np.arange(len(words)), lengths)
    place = np.arange(len(codes)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return np.flatnonzero(place >= ORDER - 1), owner, codes


@dataclass
class Models:
    """Sorted hashes of n-grams (orders 1 to 4) and of contexts (orders 1 to 3)."""

    languages: list[str]
    grams: list[np.ndarray]
    log_p: list[np.ndarray]  # by order: n-gram x language
    contexts: list[np.ndarray]
    log_back: list[np.ndarray]
    unseen: np.ndarray  # log probability of a character that no language has, by language
    temperature: float = 1.0
    bound: np.ndarray | None = None  # of cross-entropy, by language

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Log probability of each word in each language."""
        if not words:
            return np.zeros((0, len(self.languages)))
        at, owner, codes = _ngrams(words)
        total = np.zeros((len(at), len(self.languages)), np.float64)
        open_ = np.arange(len(at))
        for order in range(ORDER, 0, -1):
            key = keys_of(codes, order)[at[open_]]
            found = np.searchsorted(self.grams[order - 1], key)
            found = np.minimum(found, len(self.grams[order - 1]) - 1)
            hit = self.grams[order - 1][found] == key
            total[open_[hit]] += self.log_p[order - 1][found[hit]]
            open_ = open_[~hit]
            if order == 1:
                total[open_] += self.unseen
            elif len(open_):
                held = self.contexts[order - 2]
                key = keys_of(codes, order - 1)[at[open_] - 1]
                found = np.minimum(np.searchsorted(held, key), len(held) - 1)
                hit = held[found] == key
                total[open_[hit]] += self.log_back[order - 2][found[hit]]
        first = np.flatnonzero(np.diff(owner[at], prepend=-1))
        return np.add.reduceat(total, first, axis=0)


class Scorer:
    """Scores of texts, word by word, words met before taken from memory."""

    def __init__(self, models: Models):
        self.models = models
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.scores = np.zeros((0, len(self.models.languages)))

    def cross_entropy(self, found: list[list[str]]) -> np.ndarray:
        """Negative log probability per character: text x language, NaN without words."""
        new = list(dict.fromkeys(w for words in found for w in words if w not in self.index))
        if (len(self.index) + len(new)) * len(self.models.languages) > REMEMBERED:
            self.forget()
            new = list(dict.fromkeys(w for words in found for w in words))
        start = len(self.index)
        self.index.update(zip(new, range(start, start + len(new)), strict=True))
        self.scores = np.concatenate([self.scores, self.models.word_scores(new)])
        out = np.full((len(found), len(self.models.languages)), np.nan)
        for i, words in enumerate(found):
            if words:
                rows = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
                characters = sum(map(len, words)) + len(words)
                out[i] = -self.scores[rows].sum(axis=0) / characters
        return out


def probabilities(entropy: np.ndarray, temperature: float) -> np.ndarray:
    shifted = (entropy.min(axis=1, keepdims=True) - entropy) * temperature
    weights = np.exp(shifted)
    return weights / weights.sum(axis=1, keepdims=True)


def estimate(counts: list[tuple[str, str, int]]) -> Models:
    """Interpolated Kneser-Ney from (language, n-gram of order four, count)."""
    languages = sorted({c[0] for c in counts})
    by_language: list[list[dict[str, float]]] = []
    backs: list[list[dict[str, float]]] = []
    alphabet = len({g[-1] for _, g, _ in counts}) + 1
    for language in languages:
        level: dict[str, float] = {}
        for own, gram, n in counts:
            if own == language:
                level[gram] = level.get(gram, 0) + n
        levels = [level]
        for _ in range(ORDER - 1):  # continuation counts: in how many contexts one further left
            lower: dict[str, float] = {}
            for gram in levels[0]:
                lower[gram[1:]] = lower.get(gram[1:], 0) + 1
            levels.insert(0, lower)
        p_lower = {"": 1.0 / alphabet}
        p_levels, back_levels = [], []
        for level in levels:
            once = sum(n == 1 for n in level.values())
            twice = sum(n == 2 for n in level.values())
            discount = min(0.95, once / (once + 2 * twice)) if once and twice else 0.5
            total: dict[str, float] = {}
            kinds: dict[str, int] = {}
            for gram, n in level.items():
                total[gram[:-1]] = total.get(gram[:-1], 0) + n
                kinds[gram[:-1]] = kinds.get(gram[:-1], 0) + 1
            back = {c: discount * kinds[c] / total[c] for c in total}
            p = {
                g: (n - discount) / total[g[:-1]] + back[g[:-1]] * p_lower[g[1:] if len(g) > 1 else ""]
                for g, n in level.items()
            }
            p_levels.append(p)
            back_levels.append(back)
            p_lower = p
        by_language.append(p_levels)
        backs.append(back_levels)

    def hashed(grams: list[str], order: int) -> np.ndarray:
        codes = np.frombuffer("".join(grams).encode("utf-32-le", "surrogatepass"), np.uint32)
        return keys_of(codes.astype(np.uint64), order)[order - 1 :: order]

    grams, log_p, contexts, log_back = [], [], [], []
    for order in range(1, ORDER + 1):
        names = sorted(set().union(*[b[order - 1] for b in by_language]))
        matrix = np.empty((len(names), len(languages)))
        for column, (p, back) in enumerate(zip(by_language, backs, strict=True)):
            for row, gram in enumerate(names):
                weight, part = 1.0, gram
                while part and part not in p[len(part) - 1]:
                    weight *= back[len(part) - 1].get(part[:-1], 1.0)
                    part = part[1:]
                value = p[len(part) - 1][part] if part else 1.0 / alphabet
                matrix[row, column] = np.log(weight * value)
        key = hashed(names, order)
        rank = np.argsort(key)
        grams.append(key[rank])
        log_p.append(matrix[rank])
        if order > 1:
            names = sorted(set().union(*[b[order - 1] for b in backs]))
            key = hashed(names, order - 1)
            rank = np.argsort(key)
            rows = [[b[order - 1].get(c, 1.0) for b in backs] for c in names]
            contexts.append(key[rank])
            log_back.append(np.log(np.array(rows))[rank])
    unseen = np.log(np.array([b[0].get("", 1.0) / alphabet for b in backs]))
    return Models(languages, grams, log_p, contexts, log_back, unseen)


def calibrate(models: Models, entropy: np.ndarray, truth: np.ndarray) -> Models:
    """Set the temperature by likelihood, and for each language the bound of rejection."""
    known = ~np.isnan(entropy[:, 0])
    entropy, truth = entropy[known], truth[known]
    models.bound = np.full(len(models.languages), np.inf)
    if not len(truth):
        return models
    grid = 2.0 ** np.arange(0, 9, 0.5)
    loss = [
        -np.log(np.maximum(probabilities(entropy, t)[np.arange(len(truth)), truth], 1e-12)).mean()
        for t in grid
    ]
    models.temperature = float(grid[int(np.argmin(loss))])
    for k in range(len(models.languages)):
        own = entropy[truth == k, k]
        if len(own):
            models.bound[k] = SLACK * np.quantile(own, 1 - REJECTED)
    return models


def fit(
    labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE
) -> Models | None:
    """Models of all languages in `labelled`; None if it holds no labelled text with letters.

    At most about `sample` rows of a language are used, picked by a hash of the text, so the
    same rows whatever the partitions; their whole texts are.
    """
    rows = labelled.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where(
        "text IS NOT NULL AND lang IS NOT NULL"
    )
    held = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not held:
        return None
    share = F.create_map(
        *[F.lit(x) for lang, n in held.items() for x in (lang, min(1.0, sample / n))]
    )
    draw = F.pmod(F.xxhash64("text", F.lit(7)), F.lit(1_000_000)) / 1_000_000
    chosen = materialize(
        rows.where(draw < share[F.col("lang")]).withColumn(
            "part", F.pmod(F.xxhash64("text", F.lit(11)), F.lit(CALIBRATION))
        ),
        "language-sample",
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 4 << 20):
            words: dict[tuple[str, str], int] = {}
            for lang, text in zip(
                batch.column("lang").to_pylist(), texts(batch.column("text")), strict=True
            ):
                for word in words_of(text):
                    words[lang, word] = words.get((lang, word), 0) + 1
            grams: dict[tuple[str, str], int] = {}
            for (lang, word), n in words.items():
                line = chr(BEGIN) * (ORDER - 1) + word + chr(END)
                for i in range(len(line) - ORDER + 1):
                    key = (lang, line[i : i + ORDER])
                    grams[key] = grams.get(key, 0) + n
            if grams:
                lang, gram = zip(*grams, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lang), pa.array(gram), pa.array(grams.values(), pa.int64())],
                    names=["lang", "gram", "n"],
                )

    # a sample of a few rows may leave nothing for calibration: then it serves for both
    few = chosen.where("part = 0").groupBy("lang").count().count() < len(held)
    fitted = chosen if few else chosen.where("part > 0")
    counts = (
        map_arrow(fitted.select("lang", "text"), count, "lang string, gram string, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
        .toPandas()
        .sort_values(["lang", "gram"])
    )
    if not len(counts):
        return None
    models = estimate(list(counts.itertuples(index=False, name=None)))
    number = {lang: i for i, lang in enumerate(models.languages)}

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(models)
        for batch in slices(batches, "text", SLICE):
            entropy = scorer.cross_entropy([words_of(t) for t in texts(batch.column("text"))])
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), pa.array(entropy.tolist(), pa.list_(pa.float64()))],
                names=["lang", "entropy"],
            )

    kept = chosen if few else chosen.where("part = 0")
    measured = map_arrow(
        kept.select("lang", "text"), measure, "lang string, entropy array<double>"
    ).toPandas()
    measured = measured[measured["lang"].isin(number)]
    if not len(measured):
        return calibrate(models, np.zeros((0, len(number))), np.zeros(0, np.int64))
    entropy = np.array(measured["entropy"].tolist(), dtype=np.float64)
    return calibrate(models, entropy, measured["lang"].map(number).to_numpy())


def judge(models: Models, entropy: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of the best language (-1 without words), score and acceptance of each text."""
    best = np.full(len(entropy), -1)
    score, accepted = np.zeros(len(entropy)), np.zeros(len(entropy), bool)
    known = np.flatnonzero(~np.isnan(entropy[:, 0]))
    if len(known):
        own = entropy[known]
        at, each = own.argmin(axis=1), np.arange(len(known))
        p = probabilities(own, models.temperature)[each, at]
        best[known], score[known] = at, p
        accepted[known] = (own[each, at] <= models.bound[at]) & (p >= LOW_SCORE)
    return best, score, accepted


def identify(
    docs: DataFrame, models: Models | None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row for each row of `docs`: doc_id, lang_pred, score, accepted.

    A null text, or one without a letter, is `und` with score 0 and not accepted, as is every
    text where there are no models. The prediction depends on the whole text and on nothing
    else; equal texts get equal results; ties go to the language first in name order. An empty
    table gives no rows. There is no shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(models) if models else None
        for batch in slices(batches, "text", SLICE):
            found = [words_of(t) for t in texts(batch.column("text"))]
            lang = [UNDETERMINED] * len(found)
            score, accepted = np.zeros(len(found)), np.zeros(len(found), bool)
            if scorer:
                best, score, accepted = judge(models, scorer.cross_entropy(found))
                for i, k in enumerate(best.tolist()):
                    if k >= 0:
                        lang[i] = models.languages[k]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(lang), pa.array(score), pa.array(accepted)],
                names=["doc_id", "lang_pred", "score", "accepted"],
            )

    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text")
    )
    return map_arrow(rows, run, "doc_id long, lang_pred string, score double, accepted boolean")


def accepted_rows(docs: DataFrame, models: Models | None, text_col: str = "text") -> DataFrame:
    """The rows of `docs` whose text is accepted, with all their columns, in one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(models) if models else None
        for batch in slices(batches, text_col, SLICE):
            found = [words_of(t) for t in texts(batch.column(text_col))]
            accepted = np.zeros(len(found), bool)
            if scorer:
                entropy = scorer.cross_entropy(found)
                accepted = judge(models, entropy)[2]
            yield batch.filter(pa.array(accepted))

    return map_arrow(docs, run, docs.schema)


def held_out(id_col: str = "doc_id") -> Column:
    """Rows to test on: the CRC-32 of the identifier as text leaves 2 modulo 4."""
    remainder = F.crc32(F.col(id_col).cast("string").cast("binary")) % 4
    return F.coalesce(remainder == 2, F.lit(False))


def op10_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    models = fit(docs.where(F.col("doc_id").isNotNull() & ~held_out()))
    return identify(docs, models).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score", "accepted"
    )
