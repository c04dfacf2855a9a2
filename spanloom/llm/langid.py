"""Language identification by unigram piece models summed over all segmentations of a word.

The pieces are those of a fixed public vocabulary. Each language has a probability per piece, learnt by expectation
maximisation over the words of a bounded sample of labelled documents; a word's probability is the sum over all its
segmentations (a forward pass), and a text's log-probability is the sum over its words, each distinct word valued once.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, utf8
from .postings import chunk_postings, chunk_sums, chunks_of

#: Labelled documents the model is learnt from, about, at most; chosen by a hash of doc_id.
SAMPLE_DOCS = 12_000
ROUNDS = 3
#: Longer words are learnt from in runs of so many characters, all of which count; scoring takes them whole.
LEARN_CHARS = 31
#: Distinct runs worked on together.
LEARN_RUNS = 50_000
#: Weight of the mean over languages in each language's counts, in expected pieces.
SMOOTHING = 0.2
#: Probability of a character that is no piece, the same in every language.
UNKNOWN = 1e-9
MARK = "▁"
#: Words longer than this are valued in windows of WINDOW characters, BATCH of them at a time; UNKNOWN to that power is still a number.
LONG, WINDOW, BATCH = 64, 32, 512
#: A word's log-probabilities are kept as differences between languages, half-precision numbers of about three digits, this at least.
LOWEST = -60_000
#: Slots of the filter that tells most runs that are no piece, a power of two.
SLOTS = 1 << 20
_BASE = 0x9E3779B97F4A7C15


def vocabulary(model_file: str | None = None) -> list[str]:
    """The normal pieces of the public vocabulary, in order of id."""
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file or public_tokenizers.path("piece_bpe_32k.model"))
    return [model.id_to_piece(k) for k in range(model.get_piece_size()) if not (model.is_control(k) or model.is_unknown(k) or model.is_byte(k) or model.is_unused(k))]


class Lattice:
    """All pieces inside words of one length, a batch of words at a time."""

    def __init__(self, pieces: list[str]):
        # 0: no piece; 1: a character that is no piece
        self.number = {p: k + 2 for k, p in enumerate(pieces)}
        self.longest = max(map(len, pieces), default=1)
        self.table: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None

    def spans(self, words: list[str], n: int) -> Iterator[tuple[int, int, np.ndarray]]:
        """(start, end, piece numbers) for the places where some word has a piece; ends ascend."""
        get = self.number.get
        for end in range(1, n + 1):
            for start in range(max(0, end - self.longest), end):
                missing = 1 if end - start == 1 else 0
                found = np.array([get(w[start:end], missing) for w in words], np.int32)
                if found.any():
                    yield start, end, found

    def forward(self, words: list[str], n: int, probability: np.ndarray) -> np.ndarray:
        """log P(word) for words of ``n`` characters, an array (words, languages)."""
        languages = probability.shape[1]
        alpha: dict[int, np.ndarray] = {0: np.ones((len(words), languages))}
        logs, at = np.zeros((len(words), languages)), 0
        for start, end, found in self.spans(words, n):
            if end != at:
                at = end
                alpha[end] = np.zeros((len(words), languages))
                alpha.pop(end - self.longest - 1, None)
                if end % 8 == 0:
                    scale = np.maximum.reduce([alpha[k] for k in alpha if k < end])
                    logs += np.log(scale)
                    for k in alpha:
                        alpha[k] /= scale
            alpha[end] += alpha[start] * probability[found]
        return logs + np.log(np.maximum(alpha[n], 1e-300))

    def _pieces_in(self, word: str) -> np.ndarray:
        """The piece numbers of all runs of a word, an array (length, end): that of 1 + length characters which ends before end + 1."""
        codes = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
        if self.table is None:
            names = np.array([self._hash(p) for p in self.number], np.uint64)
            order = np.argsort(names)
            seen = np.zeros(SLOTS, bool)
            seen[(names >> np.uint64(40)).astype(np.int64) & (SLOTS - 1)] = True
            self.table = names[order], np.fromiter(self.number.values(), np.int32, len(self.number))[order], seen
        names, numbers, seen = self.table
        n = codes.size
        powers = np.cumprod(np.r_[np.uint64(1), np.full(n, _BASE, np.uint64)])
        sums = np.cumsum(np.r_[np.uint64(0), codes * np.cumprod(np.full(n, pow(_BASE, -1, 1 << 64), np.uint64))])
        found = np.zeros((self.longest, n), np.int32)
        for length in range(1, min(self.longest, n) + 1):
            # a run's hash is the sum of code * base ** (places to its end + 1), as that of a piece
            hashes = (sums[length:] - sums[:-length]) * powers[length:]
            at = np.flatnonzero(seen[(hashes >> np.uint64(40)).astype(np.int64) & (SLOTS - 1)])
            place = np.minimum(np.searchsorted(names, hashes[at]), max(0, names.size - 1))
            good = names[place] == hashes[at] if names.size else np.zeros(at.size, bool)
            found[length - 1, length - 1 + at[good]] = numbers[place[good]]
        found[0][found[0] == 0] = 1
        return found

    @staticmethod
    def _hash(piece: str) -> int:
        total = 0
        for c in piece:
            total = (total * _BASE + ord(c) + 1) % (1 << 64)
        return total

    def forward_long(self, word: str, probability: np.ndarray) -> np.ndarray:
        """log P(word) of one long word, an array (languages): windows side by side, each as the linear map from the sums at its start to
        those at its end, then one after the other. Time follows the word's length."""
        languages, back = probability.shape[1], self.longest
        found, n = self._pieces_in(word), len(word)
        state, logs = np.zeros((back, languages)), np.zeros(languages)
        state[0] = 1  # place k: the sum up to k characters before the window
        size = max(8, BATCH * 4 // languages)
        for a in range(0, n, WINDOW * size):
            part = found[:, a : a + WINDOW * size]
            windows = -(-part.shape[1] // WINDOW)
            part = np.pad(part, ((0, 0), (0, windows * WINDOW - part.shape[1]))).reshape(back, windows, WINDOW)
            last = (min(n, a + WINDOW * size) - 1) % WINDOW + 1
            # sums (place, window, which start is 1, language); places before the window come first
            alpha = np.zeros((back + WINDOW, windows, back, languages))
            for k in range(back):
                alpha[back - 1 - k, :, k] = 1
            for end in range(WINDOW):
                for length in range(1, back + 1):
                    pieces = part[length - 1, :, end]
                    if pieces.any():
                        alpha[back + end] += alpha[back + end - length] * probability[pieces][:, None, :]
            for w in range(windows):
                stop = back + (last if a + (w + 1) * WINDOW > n else WINDOW)
                state = np.einsum("psl,sl->pl", alpha[stop - back : stop, w][::-1], state)
                scale = np.maximum(state.max(axis=0), 1e-300)
                state /= scale
                logs += np.log(scale)
        return logs + np.log(np.maximum(state[0], 1e-300))

    def expected(self, words: list[str], n: int, counts: np.ndarray, probability: np.ndarray, into: np.ndarray) -> None:
        """Adds the expected number of uses of each piece in ``counts`` (words, languages) of the words."""
        spans = list(self.spans(words, n))
        alpha = np.zeros((n + 1, *counts.shape))
        beta = np.zeros_like(alpha)
        alpha[0] = beta[n] = 1
        for start, end, found in spans:
            alpha[end] += alpha[start] * probability[found]
        for start, end, found in reversed(spans):
            beta[start] += probability[found] * beta[end]
        share = counts / np.maximum(alpha[n], 1e-300)
        for start, end, found in spans:
            gain = alpha[start] * probability[found] * beta[end] * share
            for k in range(counts.shape[1]):
                into[:, k] += np.bincount(found, gain[:, k], into.shape[0])


def by_length(words: list[str], most: int | None = None) -> Iterator[tuple[int, np.ndarray, list[str]]]:
    """(length, places, words) for each length, up to ``most``."""
    places = defaultdict(list)
    for k, word in enumerate(words):
        if most is None or len(word) <= most:
            places[len(word)].append(k)
    for n, at in places.items():
        for a in range(0, len(at), 5_000):
            some = at[a : a + 5_000]
            yield n, np.array(some), [words[k] for k in some]


def train(docs: DataFrame, held_out: Callable, pieces: list[str], sample_docs: int = SAMPLE_DOCS, rounds: int = ROUNDS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """(languages, probability of each piece number by language), learnt from texts with a language that are not held out."""
    spark = docs.sparkSession
    labelled = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).filter("lang is not null and text is not null").filter(~held_out(F.col("doc_id")))
    total = labelled.select("doc_id").count()
    share = min(1.0, sample_docs / max(1, total))
    drawn = lambda of, *columns: F.pmod(F.xxhash64(*columns), F.lit(1_000_000)) < int(of * 1_000_000)
    sample = labelled.filter(drawn(share, "doc_id"))
    taken = sample.select("doc_id").count()
    if taken > 2 * sample_docs:
        # rows that share an id, or have none, are drawn all or none: one of each text, drawn from again by text
        sample = sample.withColumn("h", F.xxhash64("text")).filter(drawn(2 * sample_docs / taken, F.lit(2), "doc_id", "h")).dropDuplicates(["doc_id", "lang", "h"]).drop("h")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, Counter] = defaultdict(Counter)
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), utf8(batch), strict=True):
                found[lang].update(chunks_of(text))
        for lang, words in found.items():
            some = Counter()
            for w, n in words.items():
                some[w.decode("utf-8", "replace").lower()] += n
            yield pa.record_batch({"lang": pa.array([lang] * len(some), pa.string()), "word": pa.array(list(some), pa.string()), "n": pa.array(list(some.values()), pa.int64())})

    words = stored(sample.mapInArrow(counted, "lang string, word string, n long").groupBy("word", "lang").agg(F.sum("n").alias("n")), "langwords")
    languages = sorted(r["lang"] for r in words.select("lang").distinct().collect())
    number = {x: k for k, x in enumerate(languages)}
    size = len(pieces) + 2
    probability = np.full((size, max(1, len(languages))), 1.0 / size)
    probability[0], probability[1] = 0, UNKNOWN
    grouped = words.repartition("word").sortWithinPartitions("word")
    for _ in range(rounds if languages else 0):
        model = spark.sparkContext.broadcast((pieces, probability))

        def expectation(batches: Iterator[pa.RecordBatch], model=model) -> Iterator[pa.RecordBatch]:
            lattice, p = Lattice(model.value[0]), model.value[1]
            into = np.zeros_like(p)
            for batch in batches:
                rows: dict[str, np.ndarray] = {}

                def learn(rows: dict[str, np.ndarray]) -> None:
                    values = list(rows.values())
                    for n, at, some in by_length(list(rows)):
                        lattice.expected(some, n, np.array([values[k] for k in at]), p, into)

                for word, lang, n in zip(*(batch.column(c).to_pylist() for c in ("word", "lang", "n")), strict=True):
                    for a in range(0, max(1, len(word)), LEARN_CHARS):
                        run = word[a : a + LEARN_CHARS]
                        rows.setdefault(run if a else MARK + run, np.zeros(p.shape[1]))[number[lang]] += n
                        if len(rows) >= LEARN_RUNS:
                            learn(rows)
                            rows.clear()
                learn(rows)
            piece, lang = np.nonzero(into)
            yield pa.record_batch({"piece": piece.astype(np.int32), "lang": lang.astype(np.int32), "n": into[piece, lang]})

        sums = grouped.mapInArrow(expectation, "piece int, lang int, n double").groupBy("piece", "lang").agg(F.sum("n").alias("n"))
        counts = np.zeros_like(probability)
        for row in sums.collect():  # pieces times languages at most
            counts[row["piece"], row["lang"]] = row["n"]
        counts[:2] = 0
        share_of = counts / np.maximum(counts.sum(axis=0), 1)
        counts += SMOOTHING * size * (share_of.mean(axis=1, keepdims=True) * 0.5 + 0.5 / size)
        probability = counts / counts.sum(axis=0)
        probability[0], probability[1] = 0, UNKNOWN
    return languages, probability


def identify(docs: DataFrame, held_out: Callable | None = None, model_file: str | None = None, sample_docs: int = SAMPLE_DOCS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, lang_pred, score, held_out) per row of ``docs``.

    The model is learnt from about ``sample_docs`` documents at most that have a language and for which ``held_out`` (a function of the id
    column; by default crc32(doc_id as text) mod 4 = 2) is not true. lang_pred is ``und``, with score 0, if a text is null or
    has no letter, or if no document could be learnt from; else the language with the greatest probability (ties: the first by
    name), and score its share among the languages. Null ids are never held out. Repeated rows are returned as often as they
    come; an empty table gives an empty result; other columns are ignored. Log-probabilities are rounded to three digits a distinct word
    and cut at LOWEST below the likeliest language's, which only words of thousands of characters reach.
    """
    held = held_out or (lambda c: F.coalesce(F.crc32(c.cast("string").cast("binary")) % 4 == 2, F.lit(False)))
    pieces = vocabulary(model_file)
    languages, probability = train(docs, held, pieces, sample_docs, ROUNDS, id_col, text_col, lang_col)
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast((pieces, probability))
    width = probability.shape[1]

    def value():
        lattice, p = Lattice(model.value[0]), model.value[1]

        def worth(chunks: list[bytes]) -> np.ndarray:
            words = [MARK + c.decode("utf-8", "replace").lower() for c in chunks]
            out = np.zeros((len(words), width + 1))

            def put(at: np.ndarray, logs: np.ndarray) -> None:
                out[at, :width] = np.maximum(logs - logs.max(axis=1, keepdims=True), LOWEST)  # only differences count

            for n, at, some in by_length(words, LONG):
                put(at, lattice.forward(some, n, p))
            for k, word in enumerate(words):
                if len(word) > LONG:
                    put(np.array([k]), lattice.forward_long(word, p)[None])
            out[:, width] = [any(map(str.isalpha, w)) for w in words]
            return out

        return worth

    sums = chunk_sums(chunk_postings(docs, "langid", id_col, text_col), value, width + 1, "<f2")

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            logs = batch.column("sums").flatten().to_numpy(zero_copy_only=False).reshape(-1, width + 1)
            own = logs[:, :width]
            best = own.argmax(axis=1)
            score = 1 / np.exp(own - own.max(axis=1, keepdims=True)).sum(axis=1)
            known = (logs[:, width] > 0) & bool(languages)
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "lang_pred": pa.array([languages[b] if k else "und" for b, k in zip(best, known, strict=True)], pa.string()), "score": np.where(known, score, 0.0)})

    return sums.mapInArrow(named, "doc_id long, lang_pred string, score double").withColumn("held_out", held(F.col("doc_id")))
