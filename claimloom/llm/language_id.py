"""Language identification by error-correcting output codes.

Every learned language has a codeword. For each bit a binary classifier over hashed letter 1- to
3-grams tells languages with the bit from those without: its weights are the log odds of the n-grams
in both sets, its output the weights' mean over the text's n-grams, drawn towards 0 for short texts.
Decoding takes, for each codeword, the logistic loss of every bit's output, weighted by how well the
bit separates its languages in the training sample, and chooses the codeword of least weighted loss.
The score is the softmax share of that codeword. Labels that the classifiers cannot tell apart on
their own training texts (en, EN, en-US) share the mass of a text, so a text is judged by the shares
of all labels alike the chosen one: it is flagged ambiguous if they are below ``AMBIGUOUS``, or below
half of what the label's training texts reach, if that is less.

Codewords are exhaustive for up to five languages (all splits in two) and random splits beyond.
Training counts n-grams over a sample of whole texts, about ``SAMPLE`` a language, chosen by a
hash of the doc_id among rows with text and language whose crc32(doc_id) mod 3 is not 1.

Defined cases: null text or one without a letter is ``und`` with score 0 (also where nothing was
learned); one learned language is predicted with score 1; ties go to the first language; a null
doc_id is not held out and not learned from.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

BUCKETS, SAMPLE, AMBIGUOUS, UNKNOWN = 1 << 14, 1500, 0.4, "und"
#: Labels that are learned at most: the most frequent ones.
LANGUAGES = 256
#: Outputs are sums of weights over (n-grams + PRIOR), times GAIN.
PRIOR, GAIN = 20.0, 8.0
SLICE = 1 << 20
_LETTERS = None


def held_out(doc_id: Column) -> Column:
    rest = F.crc32(doc_id.cast("string").cast("binary")) % 3
    return F.coalesce(rest == 1, F.lit(False))


def _letters() -> np.ndarray:
    """Which code points are letters; built once in a worker."""
    global _LETTERS
    if _LETTERS is None:
        _LETTERS = np.array([chr(c).isalpha() for c in range(0x110000)])
    return _LETTERS


def ngrams(text: str) -> np.ndarray | None:
    """Counts of hashed letter n-grams over the whole text; None if it has no letter."""
    counts, any_letter = np.zeros(BUCKETS, np.int64), False
    for at in range(0, len(text), SLICE):
        part = text[max(0, at - 2) : at + SLICE].lower()
        codes = np.frombuffer(part.encode("utf-32-le"), np.uint32)
        is_letter = _letters()[codes]
        if not is_letter.any():
            continue
        any_letter = True
        codes = np.where(is_letter, codes, 0)
        # Runs of other characters count as one space.
        codes = np.concatenate([[0], codes[is_letter | np.r_[True, is_letter[:-1]]], [0]]).astype(np.uint64)
        for n in (1, 2, 3):
            mixed = np.full(len(codes) - n + 1, n, np.uint64)
            for k in range(n):
                mixed = (mixed ^ codes[k : len(codes) - n + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
                mixed ^= mixed >> np.uint64(31)
            counts += np.bincount((mixed >> np.uint64(7)).astype(np.int64) % BUCKETS, minlength=BUCKETS)
    return counts if any_letter else None


def codewords(n: int) -> np.ndarray:
    """Rows of +1 and -1 for ``n`` languages, all different, no column constant."""
    if n < 2:
        return np.ones((n, 1))
    if n <= 5:
        bits = [[(c >> i) & 1 for i in range(n)] for c in range(1, 1 << (n - 1))]
        return 2.0 * np.array(bits).T - 1
    draw = np.random.default_rng(n)
    for width in range(10 * n.bit_length(), 1 << 20, n.bit_length()):
        code = np.array([draw.permuted(np.arange(n) % 2) for _ in range(width)]).T * 2.0 - 1
        if len(np.unique(code, axis=0)) == n:
            return code
    raise AssertionError("unreachable")


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    bit_weights: np.ndarray
    #: For each language those like it, and the least share of them all of a clear text.
    alike: np.ndarray | None = None
    least: np.ndarray | None = None

    def losses(self, outputs: np.ndarray) -> np.ndarray:
        """Weighted logistic loss of every codeword for the outputs of the bits."""
        return (np.logaddexp(0, -self.code * outputs) * self.bit_weights).sum(axis=1)

    def outputs(self, counts: np.ndarray) -> np.ndarray:
        return GAIN * (counts @ self.weights) / (counts.sum() + PRIOR)

    def shares(self, counts: np.ndarray) -> np.ndarray:
        """Softmax of the codewords' losses, negated."""
        losses = self.losses(self.outputs(counts))
        shares = np.exp(losses.min() - losses)
        return shares / shares.sum()

    def judge(self, counts: dict[str, np.ndarray]) -> None:
        """Which languages are alike, by the training counts of each."""
        own = np.array([self.shares(counts[x].astype(float)) for x in self.languages])
        near = own >= 0.5 * own.diagonal()[:, None]
        self.alike = near | near.T
        self.least = np.minimum(AMBIGUOUS, (own * self.alike).sum(axis=1) / 2)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, ambiguous)."""
        counts = ngrams(text) if text and self.languages else None
        if counts is None:
            return UNKNOWN, 0.0, True
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        shares = self.shares(counts)
        best = int(shares.argmax())
        clear = shares[self.alike[best]].sum() >= self.least[best]
        return self.languages[best], float(shares[best]), not clear

    def keeps(self, text: str | None) -> bool:
        """Whether the text has a clear language, or a letter at least where none was learned."""
        if not self.languages:
            return bool(text) and ngrams(text) is not None
        return not self.predict(text)[2]


def train(counts: dict[str, np.ndarray]) -> Model:
    """Bit classifiers from the n-gram counts of each language."""
    languages = sorted(counts)
    code = codewords(len(languages))
    if len(languages) < 2:
        return Model(languages, code, np.zeros((BUCKETS, 1)), np.ones(1))
    shares = np.array([counts[x] / counts[x].sum() for x in languages])

    def log_share(of: np.ndarray) -> np.ndarray:
        return np.log(shares[of].mean(axis=0) + 0.01 / BUCKETS)

    weights = np.array([log_share(b > 0) - log_share(b < 0) for b in code.T]).T
    model = Model(languages, code, weights, np.ones(code.shape[1]))
    margins = np.array([model.outputs(counts[x].astype(float)) for x in languages]) * code
    strength = np.maximum(margins.min(axis=0), 1e-3)
    model.bit_weights = strength / strength.mean()
    model.judge(counts)
    return model


def fit(docs: DataFrame, sample: int = SAMPLE, languages: int = LANGUAGES) -> Model:
    """Learns from about ``sample`` documents of each language; see the module.

    A label that is not among the ``languages`` most frequent ones (ties by name) is not learned.
    """
    usable = common.documents(docs, "text", "lang").filter(
        F.col("doc_id").isNotNull()
        & ~held_out(F.col("doc_id"))
        & F.col("text").isNotNull()
        & F.col("lang").isNotNull()
    )
    # Some hundred labels at most go to the driver and, with their models, to the tasks.
    there = (
        usable.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages)
    )
    chance = F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    picked = usable.join(F.broadcast(there), "lang").filter(chance * F.col("count") < sample)

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in common.bounded(batches):
            columns = (batch.column(c).to_pylist() for c in ("lang", "text"))
            for lang, text in zip(*columns, strict=True):
                if (found := ngrams(text)) is not None:
                    sums[lang] = sums.get(lang, 0) + found
        for lang, total in sums.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(total[at])],
                ["lang", "bucket", "n"],
            )

    common.prepare(docs.sparkSession)
    rows = (
        picked.select("lang", "text")
        .mapInArrow(count, "lang string, bucket long, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    counts = {}
    for lang, part in rows.groupby("lang"):
        counts[lang] = np.zeros(BUCKETS)
        counts[lang][part["bucket"].to_numpy()] = part["n"].to_numpy()
    return train(counts)


def identify(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, lang_pred, score, ambiguous) for each row."""
    model = fit(docs, sample)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        lang, score, ambiguous = zip(*map(model.predict, batch.column("text").to_pylist()), strict=True)
        return common.record_batch(
            doc_id=batch.column("doc_id"), lang_pred=pa.array(lang, pa.string()),
            score=pa.array(score, pa.float64()), ambiguous=pa.array(ambiguous),
        )

    schema = "doc_id long, lang_pred string, score double, ambiguous boolean"
    return common.map_batches(common.documents(docs, "text"), run, schema)


def keep_identified(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``docs`` without the rows whose language is unknown or ambiguous, columns unchanged.

    Where no language was learned all rows with a letter stay.
    """
    model = fit(docs, sample)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = [model.keeps(t) for t in batch.column("text").to_pylist()]
        return batch.filter(pa.array(keep))

    return common.map_batches(docs, run, docs.schema)
