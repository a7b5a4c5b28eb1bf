"""Language of words and documents by a linear-chain conditional random field.

Every word has features: its byte n-grams between word marks (those that touch a mark are its affixes) and its own
identity, a learned lexicon. The field's weights and its transitions are fitted to sequences that switch language,
spliced from runs of words of labelled documents. Forward-backward gives each word of a text a probability for each
language; a document's language has the largest mean over its words, which is the score. A text is one chain, however long: its words are
worked on in spans of ``SPAN``, side by side, and messages go from span to span through the spans' transfer matrices.

The fit takes a bounded sample: ``SAMPLE_DOCUMENTS`` different labelled texts of each language, chosen by a hash, and at
most ``SAMPLE_WORDS`` words of each, drawn from the whole text where it lies; only these words reach the driver. A model
has a column of weights for each language; more than ``MOST_LANGUAGES`` are refused. Prediction reads whole texts and only texts.

Defined cases: a text that is null or has no letter is ``und`` with score 0, and so is every text if there is no
labelled document; ties go to the language first in order; a null doc_id is not held out and teaches nothing; repeated
rows each return a row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tabloom.llm.common import batch_of, drawn, slices

UNKNOWN = "und"
SAMPLE_DOCUMENTS, SAMPLE_WORDS, SAMPLE_RUN = 250, 160, 16
MOST_LANGUAGES = 512
BITS, GRAMS, SPAN = 17, (2, 3, 4), 32
ROUNDS, RATE, DECAY = 50, 0.3, 1e-6
MOST_KNOWN = 300_000  # spellings a task remembers before it starts anew; bounds memory, not results
WORDS_AT_ONCE = 2_000
OPEN, CLOSE = b"\x01", b"\x02"
MULTIPLIERS = np.random.default_rng(6).integers(0, 2**64, 8, dtype=np.uint64) | np.uint64(1)


def letters(spelling: str) -> str:
    """The letters of a run of text between white space, in lower case."""
    return spelling.lower() if spelling.isalpha() else "".join(filter(str.isalpha, spelling)).lower()


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the features of all words, one word after the other, and where each word's begin."""
    data = np.frombuffer(b"".join([OPEN + w.encode() + CLOSE for w in words]), np.uint8).astype(np.uint64)
    ends = np.flatnonzero(data == 2) + 1
    starts = np.concatenate(([0], ends[:-1]))
    word = np.repeat(np.arange(len(words)), ends - starts)
    found, owners = [], []
    for n in GRAMS:
        size = len(data) - n + 1
        if size <= 0:
            continue
        total = np.full(size, n, np.uint64)
        for i in range(n):
            total += data[i : i + size] * MULTIPLIERS[i]
        inside = word[:size] == word[n - 1 :]
        found.append(total[inside])
        owners.append(word[:size][inside])
    place = (np.arange(len(data)) - starts[word]).astype(np.uint64)
    whole = data * ((place + np.uint64(11)) * MULTIPLIERS[5] ^ ((place + np.uint64(3)) * MULTIPLIERS[6]) >> np.uint64(17))
    found.append(np.add.reduceat(whole, starts) * MULTIPLIERS[7])
    owners.append(np.arange(len(words)))
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    mixed = np.concatenate(found)[order]
    mixed = (mixed ^ (mixed >> np.uint64(31))) * MULTIPLIERS[4]
    return (mixed >> np.uint64(64 - BITS)).astype(np.int64), np.searchsorted(owner[order], np.arange(len(words)))


def span_messages(
    emissions: np.ndarray, valid: np.ndarray, transitions: np.ndarray, first: np.ndarray, runs: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """What comes to each span of a chain from the spans before and after it.

    A chain has ``runs`` spans from ``first`` on. A span's matrix takes what comes to its first word to its last word, so
    a chain of spans is as exact as one of words.
    """
    rows, span, labels = emissions.shape
    before, after = np.ones((rows, labels)), np.ones((rows, labels))
    if not (runs > 1).any():
        return before, after
    scores = np.exp(emissions - emissions.max(2, keepdims=True))
    step = np.exp(transitions - transitions.max())
    matrix = np.zeros((rows, labels, labels))
    matrix[:, range(labels), range(labels)] = scores[:, 0]
    for t in range(1, span):
        moved = (matrix @ step) * scores[:, t, None, :]
        moved /= moved.max((1, 2), keepdims=True)
        matrix = np.where(valid[:, t, None, None], moved, matrix)
    normed = lambda x: x / x.sum(1, keepdims=True)
    for k in range(1, int(runs.max())):
        at = first[runs > k] + k
        before[at] = normed(np.einsum("ri,rij->rj", before[at - 1], matrix[at - 1]) @ step)
    for k in range(int(runs.max()) - 2, -1, -1):
        at = first[runs > k + 1] + k
        after[at] = normed(np.einsum("rij,rj->ri", matrix[at + 1], after[at + 1]) @ step.T)
    return before, after


def forward_backward(
    emissions: np.ndarray, valid: np.ndarray, transitions: np.ndarray, before=None, after=None
) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of words (sequences, span, labels) and expected transitions; ``valid`` is false after the end.

    ``before`` and ``after`` are the messages that come to the first and to the last word.
    """
    rows, span, labels = emissions.shape
    scores = np.exp(emissions - emissions.max(2, keepdims=True))
    step = np.exp(transitions - transitions.max())
    ahead = np.empty_like(scores)
    begin = scores[:, 0] if before is None else scores[:, 0] * before
    ahead[:, 0] = begin / begin.sum(1, keepdims=True)
    for t in range(1, span):
        now = (ahead[:, t - 1] @ step) * scores[:, t]
        now /= now.sum(1, keepdims=True)
        ahead[:, t] = np.where(valid[:, t, None], now, ahead[:, t - 1])
    back = np.ones((rows, labels)) if after is None else after
    marginals = np.empty_like(scores)
    last = ahead[:, -1] * back
    marginals[:, -1] = last / last.sum(1, keepdims=True)
    expected = np.zeros_like(transitions)
    for t in range(span - 2, -1, -1):
        message = scores[:, t + 1] * back
        live = valid[:, t + 1]
        if live.any():
            joint = ahead[live, t][:, :, None] * step[None] * message[live][:, None, :]
            expected += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
        message = message @ step.T
        back = np.where(live[:, None], message / message.sum(1, keepdims=True), back)
        both = ahead[:, t] * back
        marginals[:, t] = both / both.sum(1, keepdims=True)
    return marginals, expected


@dataclass
class Field:
    """Weights of a fitted field; a task's memory of spellings is not part of the model."""

    labels: list[str]
    weights: np.ndarray
    transitions: np.ndarray
    known: dict = field(default_factory=dict, repr=False)
    emitted: list = field(default_factory=list, repr=False)

    def __getstate__(self):
        return self.labels, self.weights, self.transitions

    def __setstate__(self, state):
        self.labels, self.weights, self.transitions = state
        self.known, self.emitted = {}, []

    def forget(self) -> None:
        """Free what a task remembered; its worker lives on and serves other operators."""
        self.known, self.emitted = {}, []

    def emissions(self, words: list[str]) -> np.ndarray:
        """A word's row depends on that word alone, so words are worked on by some thousand, which bounds memory."""
        found = []
        for first in range(0, len(words), WORDS_AT_ONCE):
            buckets, starts = features(words[first : first + WORDS_AT_ONCE])
            found.append(np.add.reduceat(self.weights[buckets], starts, axis=0))
        return np.concatenate(found)

    def _learn(self, spellings: list[str]) -> None:
        words = [letters(s) for s in spellings]
        own = [w for w in words if w]
        at = sum(map(len, self.emitted))
        for spelling, word in zip(spellings, words, strict=True):
            self.known[spelling] = at if word else -1
            at += bool(word)
        if own:
            self.emitted.append(self.emissions(own))

    def word_probabilities(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(words, labels) probabilities of the words of all texts that have letters, and each word's text."""
        split = [t.split() for t in texts]
        if len(self.known) > MOST_KNOWN:
            self.known, self.emitted = {}, []
        self._learn(list(set().union(*split).difference(self.known)))
        table = np.concatenate(self.emitted) if self.emitted else np.zeros((0, len(self.labels)))
        self.emitted = [table] if len(table) else []
        places = [[p for p in map(self.known.__getitem__, words) if p >= 0] for words in split]
        sizes = np.array([len(p) for p in places], np.int64)
        flat = np.fromiter((p for some in places for p in some), np.int64, int(sizes.sum()))
        runs = -(-sizes // SPAN)  # a text's words in spans, the last one short
        begins = np.concatenate(([0], np.cumsum(runs)[:-1])).astype(np.int64)
        owner = np.repeat(np.arange(len(texts)), sizes)
        within = np.arange(len(flat)) - np.repeat(np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes)
        spot = begins[owner] * SPAN + within
        emissions = np.zeros((int(runs.sum()) * SPAN, len(self.labels)))
        valid = np.zeros(len(emissions), bool)
        emissions[spot], valid[spot] = table[flat], True
        spans = emissions.reshape(-1, SPAN, len(self.labels)), valid.reshape(-1, SPAN), self.transitions
        marginals, _ = forward_backward(*spans, *span_messages(*spans, begins, runs))
        return marginals.reshape(-1, len(self.labels))[spot], owner

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        names, scores, _ = self.judge(texts)
        return names, scores

    def judge(self, texts: list[str]) -> tuple[list[str], list[float], list[float]]:
        """Each text's language, its mean probability, and the mean of each word's largest probability: how certain the
        words are, whether or not they agree."""
        if not self.labels:
            return [UNKNOWN] * len(texts), [0.0] * len(texts), [0.0] * len(texts)
        probabilities, owner = self.word_probabilities(texts)
        words = np.bincount(owner, minlength=len(texts))
        sums = np.stack([np.bincount(owner, p, len(texts)) for p in probabilities.T], axis=1)
        means = sums / np.maximum(words, 1)[:, None]
        best = means.argmax(1)
        names = [self.labels[b] if n else UNKNOWN for b, n in zip(best, words, strict=True)]
        certain = np.bincount(owner, probabilities.max(1, initial=0), len(texts)) / np.maximum(words, 1)
        return names, np.clip(means[np.arange(len(texts)), best], 0, 1).tolist(), np.clip(certain, 0, 1).tolist()


def spliced(documents: list[list[str]], labels: list[int], seed: int = 3) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Sequences of ``SPAN`` words from runs of several documents: word types, type indices, labels."""
    random = np.random.default_rng(seed)
    runs = []
    for words, label in zip(documents, labels, strict=True):
        at = 0
        while at < len(words):
            size = int(random.integers(3, SPAN))
            runs.append((words[at : at + size], label))
            at += size
    random.shuffle(runs)
    flat = [(w, label) for words, label in runs for w in words]
    flat = flat[: max(len(flat) // SPAN, 1) * SPAN]
    flat += [flat[-1]] * (-len(flat) % SPAN)
    types = {w: i for i, w in enumerate(dict.fromkeys(w for w, _ in flat))}
    index = np.array([types[w] for w, _ in flat]).reshape(-1, SPAN)
    return list(types), index, np.array([label for _, label in flat]).reshape(-1, SPAN)


def sample_words(text: str) -> list[str]:
    """The words of a text, or ``SAMPLE_WORDS`` of them in whole runs from all of the text, the same ones every time."""
    words = [w for w in map(letters, text.split()) if w]
    if len(words) <= SAMPLE_WORDS:
        return words
    random = np.random.default_rng(crc32(text.encode()))
    begins = np.sort(random.choice(len(words) // SAMPLE_RUN, SAMPLE_WORDS // SAMPLE_RUN, replace=False)) * SAMPLE_RUN
    return [w for b in begins for w in words[b : b + SAMPLE_RUN]]


def fit_field(samples: list[tuple[str, str]]) -> Field:
    """Fit to (text, language) rows by gradient steps on the likelihood of spliced sequences."""
    names = sorted({lang for _, lang in samples})
    documents, labels = [], []
    for text, lang in sorted(samples):
        if words := sample_words(text):
            documents.append(words)
            labels.append(names.index(lang))
    size = len(names)
    weights, transitions = np.zeros((1 << BITS, size)), np.zeros((size, size))
    if not documents:
        return Field([], weights, transitions)
    types, index, target = spliced(documents, labels)
    buckets, starts = features(types)
    lengths = np.diff(np.concatenate((starts, [len(buckets)])))
    valid = np.ones(index.shape, bool)
    truth = np.eye(size)[target]
    switches = np.zeros((size, size))
    np.add.at(switches, (target[:, :-1].ravel(), target[:, 1:].ravel()), 1)
    squares, transition_squares = np.full_like(weights, 1e-8), np.full_like(transitions, 1e-8)
    for _ in range(ROUNDS):
        emitted = np.add.reduceat(weights[buckets], starts, axis=0)
        marginals, expected = forward_backward(emitted[index], valid, transitions)
        error = (truth - marginals).reshape(-1, size) / index.size
        flat = index.ravel()
        by_type = np.stack([np.bincount(flat, e, len(types)) for e in error.T], axis=1)
        spread = np.repeat(by_type, lengths, axis=0)
        gradient = np.stack([np.bincount(buckets, s, 1 << BITS) for s in spread.T], axis=1) - DECAY * weights
        squares += gradient**2
        weights += RATE * gradient / np.sqrt(squares)
        gradient = (switches - expected) / index.size - DECAY * transitions
        transition_squares += gradient**2
        transitions += RATE * gradient / np.sqrt(transition_squares)
    return Field(names, weights.astype(np.float32).astype(np.float64), transitions)


def is_held_out(id_column: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 3 == 1, F.lit(False))


SAMPLED = pa.schema([("doc_id", pa.int64()), ("hash", pa.int64()), ("words", pa.string()), ("lang", pa.string())])


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 2):
        words = [" ".join(sample_words(t)) for t in batch.column(2).to_pylist()]
        yield batch_of(SAMPLED, batch.column(0), batch.column(1), words, batch.column(3))


def learn_field(
    spark: SparkSession, documents: DataFrame, id_column="doc_id", text_column="text", lang_column="lang"
) -> Field:
    """Fit to a bounded sample of the labelled documents that are not held out."""
    taught = documents.select(
        F.col(id_column).cast("long").alias("doc_id"), F.xxhash64(text_column).alias("hash"),
        F.col(text_column).alias("text"), F.col(lang_column).alias("lang"),
    ).where(~is_held_out("doc_id") & F.expr("doc_id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL"))
    # only hashes meet, once for each text
    texts = taught.groupBy("lang", "hash").agg(F.min("doc_id").alias("doc_id"))
    sample = drawn(spark, texts, "lang", "hash", SAMPLE_DOCUMENTS, MOST_LANGUAGES)
    # at most SAMPLE_DOCUMENTS rows for each of MOST_LANGUAGES
    chosen = taught.join(F.broadcast(sample), ["lang", "hash", "doc_id"], "left_semi").select("doc_id", "hash", "text", "lang")
    words = chosen.mapInArrow(_sampled, "doc_id long, hash long, words string, lang string").distinct()
    return fit_field([(r["words"], r["lang"]) for r in words.select("words", "lang").collect()])


RESULT = pa.schema(
    [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())]
)


def predict_languages(
    spark: SparkSession, documents: DataFrame, id_column="doc_id", text_column="text", lang_column="lang"
) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    model = spark.sparkContext.broadcast(learn_field(spark, documents, id_column, text_column, lang_column))  # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in slices(batches, 2, 500_000):
                names, scores = model.value.predict(batch.column(2).to_pylist())
                yield batch_of(RESULT, batch.column(0), batch.column(1), names, scores)
        finally:
            model.value.forget()

    rows = documents.select(
        F.col(id_column).cast("long").alias("doc_id"), is_held_out(id_column).alias("held_out"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def keep_known_languages(
    spark: SparkSession, documents: DataFrame, least: float, id_column="doc_id", text_column="text", lang_column="lang"
) -> DataFrame:
    """The documents whose words have a language with a certainty of at least ``least`` in the mean, with all their columns.

    A text of several languages stays if each of its words has one."""
    model = spark.sparkContext.broadcast(learn_field(spark, documents, id_column, text_column, lang_column))
    place = documents.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in slices(batches, place, 500_000):
                names, _, certain = model.value.judge([t or "" for t in batch.column(place).to_pylist()])
                keep = [n != UNKNOWN and c >= least for n, c in zip(names, certain, strict=True)]
                yield batch.filter(pa.array(keep, pa.bool_()))
        finally:
            model.value.forget()

    return documents.mapInArrow(run, documents.schema)
