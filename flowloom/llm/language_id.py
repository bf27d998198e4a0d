"""Language ID: unigram pieces marginalised over all segmentations.

Every language has a probability for each piece of one fixed public vocabulary. A word's probability in a
language is the sum, over all ways to cut it into pieces, of the product of the pieces' probabilities;
the forward algorithm adds them up, for all languages and many words at once. A text's score is the sum
of its words' log probabilities, turned into a share among the languages.

The probabilities come from expectation maximisation over the word counts of a bounded sample of rows in
each language: forward and backward sums give the expected number of uses of each piece, partition by
partition. Letters outside the vocabulary count as a piece of one fixed small probability. Sums are scaled as they
go, so words of any length are summed whole.

Edge cases: a NULL text, or one without a letter, is 'und' with score 0; at a tie the first language by name wins;
texts and words of any length are read whole; rows with a NULL language teach nothing; without training rows all is
'und'; repeated rows each get their prediction; an empty table gives an empty result. Other columns are not read
and may have any name.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.llm.common import release, small_batches, staged, table
from flowloom.llm.learning import crc_mod

#: Training rows of each language at most, EM rounds, probability of a letter outside the vocabulary.
FIT_ROWS, ROUNDS, OUTSIDE = 1500, 3, 1e-7
#: Words and their letters that a task keeps scores of, letters of words that are summed at once, steps between two scalings.
CACHE_WORDS, CACHE_LETTERS, GROUP_LETTERS, SCALE_STEPS = 300_000, 6_000_000, 200_000, 8
#: Languages at most, so that what the driver holds (one number a piece and language) is bounded.
LANGUAGES = 1000
BASE = np.uint64(0x100000001B3)
_WORD = re.compile(r"[^\W\d_]+")


def vocabulary(path: str | None = None) -> list[str]:
    """Lower-case letter pieces of the public vocabulary; '▁' stands for a word's beginning."""
    import sentencepiece

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {sp.id_to_piece(i) for i in range(sp.get_piece_size())}
    return sorted(p for p in pieces if p and p == p.lower() and (p.removeprefix("▁").isalpha() or p == "▁"))


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters."""
    found = _WORD.findall((text or "").lower())
    if all(map(str.isalpha, found)):
        return found
    # \w also takes numerals that are neither digits nor letters
    return "".join(c if c.isalpha() else " " for c in " ".join(found)).split()


class Pieces:
    """The vocabulary by hash, and the pieces at every place of words of one length."""

    def __init__(self, pieces: list[str]):
        h = np.array([self._hash(p) for p in pieces], np.uint64)
        order = np.argsort(h)
        self.hashes, self.ids, self.n = h[order], order, len(pieces)
        self.longest = max(map(len, pieces), default=1)
        self.begun = np.unique(np.array([self._hash(p[:2]) for p in pieces if len(p) > 1] or [0], np.uint64))

    @staticmethod
    def _hash(piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * int(BASE) + ord(c) + 1) & (1 << 64) - 1
        return h

    @staticmethod
    def codes(words: list[str]) -> np.ndarray:
        """A row of letters for each '▁' + word."""
        return np.array(["▁" + w for w in words]).view(np.uint32).reshape(len(words), -1).astype(np.uint64) + np.uint64(1)

    def at(self, codes: np.ndarray, start: int):
        """(size, piece number for each word) of the pieces from a place: n for a letter outside the vocabulary, n+1 for no piece."""
        h = np.zeros(len(codes), np.uint64)
        for size in range(1, min(self.longest, codes.shape[1] - start) + 1):
            h = h * BASE + codes[:, start + size - 1]
            if size == 2:
                at = np.minimum(np.searchsorted(self.begun, h), len(self.begun) - 1)
                if not (self.begun[at] == h).any():  # no longer piece begins so
                    return
            at = np.minimum(np.searchsorted(self.hashes, h), self.n - 1)
            hit = self.hashes[at] == h
            if size == 1 or hit.any():
                yield size, np.where(hit, self.ids[at], self.n if size == 1 else self.n + 1)


def forward(codes: np.ndarray, pieces: Pieces, p: np.ndarray) -> np.ndarray:
    """Logarithms of the sums over all segmentations of each word, by language (columns of p, padded)."""
    n, length = codes.shape
    ahead = {0: np.ones((n, p.shape[1]))}  # sums of the prefixes that end at a place, over what scale holds
    scale = np.zeros((n, p.shape[1]))
    for start in range(length):
        here = ahead.pop(start)
        for size, piece in pieces.at(codes, start):
            add = here * p[piece]
            ahead[start + size] = ahead[start + size] + add if start + size in ahead else add
        if start % SCALE_STEPS == SCALE_STEPS - 1:
            most = np.maximum.reduce(list(ahead.values()))
            scale += np.log(most)
            ahead = {k: v / most for k, v in ahead.items()}
    return np.log(ahead[length]) + scale


def padded(p: np.ndarray) -> np.ndarray:
    """Probabilities with two further rows: a letter outside the vocabulary, and no piece."""
    return np.vstack([p, np.full((1, p.shape[1]), OUTSIDE), np.zeros((1, p.shape[1]))])


def by_length(words):
    """Lists of words of one length, of about GROUP_LETTERS letters."""
    found: dict[int, list[str]] = {}
    for w in words:
        found.setdefault(len(w), []).append(w)
    for length, group in found.items():
        most = max(1, GROUP_LETTERS // length)
        for i in range(0, len(group), most):
            yield group[i : i + most]


class Scorer:
    """Log probabilities of words in all languages, kept for the words seen last."""

    def __init__(self, pieces: list[str], p: np.ndarray):
        self.pieces, self.p = Pieces(pieces), padded(p)
        self._clear()

    def _clear(self) -> None:
        self.rows: dict[str, int] = {}
        self.logs, self.letters = np.empty((0, self.p.shape[1])), 0

    def _add(self, words: set[str]) -> None:
        new = [self.logs]
        for part in by_length(words):
            new.append(forward(self.pieces.codes(part), self.pieces, self.p))
            self.rows.update(zip(part, range(len(self.rows), len(self.rows) + len(part))))
            self.letters += len(part) * len(part[0])
        self.logs = np.concatenate(new)

    def score(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(sums of log probabilities by language, words) for each text."""
        words = [words_of(t) for t in texts]
        counts = np.fromiter(map(len, words), np.int64, len(words))
        distinct = set().union(*words)
        if len(self.rows) > CACHE_WORDS or self.letters > CACHE_LETTERS:
            self._clear()
        if missing := distinct.difference(self.rows):
            self._add(missing)
        at = np.fromiter((self.rows[w] for ws in words for w in ws), np.int64, int(counts.sum()))
        sums = np.zeros((len(texts), self.p.shape[1]))
        if counts.any():
            sums[counts > 0] = np.add.reduceat(self.logs[at], np.concatenate([[0], np.cumsum(counts[counts > 0])[:-1]]))
        return sums, counts


def expected(words: list[str], counts: np.ndarray, pieces: Pieces, p: np.ndarray) -> np.ndarray:
    """Expected uses of each piece in words that occur counts times, under p (one language): forward and backward sums
    as logarithms."""
    out, number = np.zeros(pieces.n + 2), dict(zip(words, counts))
    with np.errstate(divide="ignore"):
        q = np.log(padded(p)[:, 0])
    for part in by_length(words):
        codes = pieces.codes(part)
        n, length = codes.shape
        alpha, beta = np.full((length + 1, n), -np.inf), np.full((length + 1, n), -np.inf)
        alpha[0], beta[length] = 0.0, 0.0
        for start in range(length):
            for size, piece in pieces.at(codes, start):
                alpha[start + size] = np.logaddexp(alpha[start + size], alpha[start] + q[piece])
        for start in reversed(range(length)):
            for size, piece in pieces.at(codes, start):
                beta[start] = np.logaddexp(beta[start], q[piece] + beta[start + size])
        times = np.array([number[w] for w in part], float)
        for start in range(length):
            for size, piece in pieces.at(codes, start):
                out += np.bincount(piece, times * np.exp(alpha[start] + q[piece] + beta[start + size] - beta[0]), len(out))
    return out[: pieces.n]


def fit(train: DataFrame, rows: int = FIT_ROWS, rounds: int = ROUNDS, path: str | None = None) -> tuple[list[str], list[str], np.ndarray]:
    """(languages, pieces, probabilities) from (doc_id, text, lang)."""
    pieces = vocabulary(path)
    sizes = {r["lang"]: r["count"] for r in train.groupBy("lang").count().limit(LANGUAGES + 1).collect()}
    langs = sorted(sizes)
    if len(langs) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    if not langs:
        return [], pieces, np.empty((len(pieces), 0))
    share = F.create_map(*[x for k in langs for x in (F.lit(k), F.lit(min(1 << 20, int(rows / sizes[k] * (1 << 20)) + 1)))])
    sample = train.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.element_at(share, F.col("lang")))

    def count(batches):
        for b in batches:
            for lang, t in zip(b["lang"].to_pylist(), b["text"].to_pylist()):
                w = words_of(t)
                yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(w), pa.string()), "word": pa.array(w, pa.string())})

    counted = staged(sample.select("lang", "text").mapInArrow(count, "lang string, word string").groupBy("lang", "word").count(), "language-words")
    p = np.full((len(pieces), len(langs)), 1.0 / len(pieces))
    for _ in range(rounds):

        def expect(batches, p=p):
            index, total = Pieces(pieces), np.zeros((len(langs), len(pieces)))
            for b in batches:
                at, words, n = np.array([langs.index(x) for x in b["lang"].to_pylist()]), b["word"].to_pylist(), b["count"].to_numpy()
                for k in np.unique(at) if len(at) else []:
                    mine = np.flatnonzero(at == k)
                    total[k] += expected([words[i] for i in mine], n[mine], index, p[:, k : k + 1])
            k, i = np.nonzero(total)
            yield pa.RecordBatch.from_pydict({"k": pa.array(k, pa.int64()), "i": pa.array(i, pa.int64()), "v": pa.array(total[k, i])})

        uses = np.full((len(pieces), len(langs)), 0.01)
        for r in counted.mapInArrow(expect, "k long, i long, v double").groupBy("k", "i").agg(F.sum("v").alias("v")).collect():  # pieces x languages numbers
            uses[r["i"], r["k"]] += r["v"]
        p = uses / uses.sum(axis=0)
    return langs, pieces, p


def identify(docs: DataFrame, train: DataFrame, held_out: Column | None = None, rows: int = FIT_ROWS, rounds: int = ROUNDS, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for each row of docs, learned from train's rows that held_out does not mark."""
    small_batches(docs.sparkSession)
    held = F.lit(False) if held_out is None else held_out
    taught = train.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).filter(F.col("lang").isNotNull() & ~held)
    langs, pieces, p = fit(taught, rows, rounds, path)

    def work(batches):
        release()
        scorer = Scorer(pieces, p) if langs else None
        for b in batches:
            names, scores, texts = [], [], b["text"].to_pylist()
            for i in range(0, len(texts), 256):
                part = texts[i : i + 256]
                if scorer is None:
                    names, scores = names + ["und"] * len(part), scores + [0.0] * len(part)
                    continue
                sums, n = scorer.score(part)
                e = np.exp(sums - sums.max(axis=1, keepdims=True))
                best = sums.argmax(axis=1)
                names += [langs[k] if c else "und" for k, c in zip(best, n)]
                scores += np.where(n > 0, e.max(axis=1) / e.sum(axis=1), 0.0).tolist()
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["held_out"], pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return texts.select("doc_id", held.alias("held_out"), "text").mapInArrow(work, "doc_id long, held_out boolean, lang_pred string, score double")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, docs, crc_mod(F.col("doc_id"), 4) == 2)
